"""Plan shape: star joins broadcast the dimensions, no cartesian product,
unused columns stay out of the parquet scan, the fact is read once."""

import pytest

from paramo.operators import dashboard as D
from paramo.sources.star import star_from_tpch

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("fn", [D.precip_by_month_period, D.thermal_range_top15, D.combined_index,
                                D.trend_by_period, D.rainiest_peak_months])
def test_star_queries_broadcast(spark, fn):
    plan = _plan(fn(star_from_tpch(spark, SF_SMALL)))
    assert "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_parameter_pruning_reads_only_needed_columns(spark):
    plan = _plan(D.precip_by_month_period(star_from_tpch(spark, SF_SMALL)))
    assert "l_extendedprice" not in plan and "l_tax" not in plan


@pytest.mark.parametrize("fn", [D.precip_by_month_period, D.thermal_range_top15, D.combined_index, D.trend_by_period])
def test_monthly_and_annual_rows_share_one_scan(spark, fn):
    df = fn(star_from_tpch(spark, SF_SMALL))
    df.collect()
    plan = _plan(df).split("== Initial Plan ==")[0]
    assert plan.count("lineitem.parquet") == 1
