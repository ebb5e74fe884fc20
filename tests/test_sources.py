"""A1 materialised star round trip: the fact is partitioned by parameter and
queries over the read-back star equal the derived star's results."""

import tempfile

from paramo.operators import dashboard as D
from paramo.sources.star import read_star, star_from_tpch, write_star

from .conftest import SF_SMALL


def test_write_read_star_round_trip(spark):
    derived = star_from_tpch(spark, SF_SMALL)
    path = tempfile.mkdtemp(prefix="paramo-star-")
    write_star(derived, path)
    stored = read_star(spark, path)
    for fn in (D.precip_by_month_period, D.rainiest_peak_months, D.thermal_range_top15):
        a = sorted(map(tuple, fn(derived).collect()))
        b = sorted(map(tuple, fn(stored).collect()))
        assert a == b
    a = sorted(map(tuple, D.filter_query(derived, "TEMPERATURA MEDIA", "NATION_1").collect()))
    b = sorted(map(tuple, D.filter_query(stored, "TEMPERATURA MEDIA", "NATION_1").collect()))
    assert a == b
    plan = D.precip_by_month_period(stored)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression" in plan.lower()


def test_read_normals_csv_round_trip(spark):
    """A2: a wide table written as CSV with raw headers reads back and cleans
    to the same rows as the derived one."""
    import os

    from paramo.operators.clean import clean_normals
    from paramo.sources.normals import normals_from_tpch, read_normals

    raw = normals_from_tpch(spark, SF_SMALL)
    path = os.path.join(tempfile.mkdtemp(prefix="paramo-csv-"), "normals")
    raw.toDF(*[(" ALTITUD (m) " if c == "ALTITUD_m" else c) for c in raw.columns]) \
        .write.option("header", True).csv(path)
    back = clean_normals(read_normals(spark, path, "csv"))
    want = clean_normals(raw)
    assert "ALTITUD_m" in back.columns
    assert back.schema["id_fila"].dataType == want.schema["id_fila"].dataType
    assert back.count() == want.count()
    assert sorted(r[0] for r in back.select("id_fila").collect()) == \
        sorted(r[0] for r in want.select("id_fila").collect())
    cols = sorted(want.columns)
    assert sorted(map(tuple, back.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
