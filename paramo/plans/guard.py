"""Free queries: what a caller's SQL may read and call.

A query is analysed in a session of its own, which knows nothing but the
given views: no view, function or setting of the caller.  Spark's parser and
analyser do the work; what they return is checked against lists of what is
allowed, so that whatever is not known to be harmless is refused:

* of the parsed query, every function by name; identifiers that are computed
  (``IDENTIFIER(..)``) are refused, as their names show only later;
* of the analysed query, every relation (one of the views, or rows that the
  query itself spells out), every operator and every expression by its class.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


class FreeQueryRejected(ValueError):
    """Raised when a free query is not a plain read-only SELECT."""


# Functions that a free query may call.
FUNCTIONS = frozenset("""
abs acos add_months any any_value approx_count_distinct approx_percentile array array_agg array_contains array_distinct array_join array_max array_min array_size array_sort
ascii asin atan atan2 avg between bit_and bit_or bit_xor bool_and bool_or bround btrim cardinality case cast cbrt ceil ceiling char_length character_length chr coalesce collect_list
collect_set concat concat_ws contains corr cos cot count count_if covar_pop covar_samp cume_dist current_date date date_add date_format date_part date_sub date_trunc
datediff day dayofmonth dayofweek dayofyear degrees dense_rank double element_at endswith every exp explode extract filter first first_value float floor format_number greatest
grouping grouping_id histogram_numeric hour if ifnull ilike initcap instr int isnan isnotnull isnull kurtosis lag last last_day last_value lcase lead least left len length like ln locate
log log10 log2 lower lpad ltrim make_date map max max_by mean median min min_by minute mod mode month months_between named_struct nth_value ntile nullif nullifzero nvl nvl2
overlay percent_rank percentile percentile_approx percentile_cont percentile_disc pi pmod position posexplode pow power quarter radians range rank regexp_count regexp_extract
regexp_like regexp_replace regr_count regr_intercept regr_r2 regr_slope repeat replace reverse right rint rlike round row_number rpad rtrim second sequence sign signum sin size skewness
slice some sort_array split split_part sqrt startswith std stddev stddev_pop stddev_samp string struct substr substring sum tan to_date transform translate trim trunc try_add
try_avg try_cast try_divide try_element_at try_multiply try_subtract try_sum ucase upper var_pop var_samp variance weekday weekofyear when width_bucket year zeroifnull
""".split())
# Operators of an analysed query that only read and compute.
OPERATORS = frozenset("""
Aggregate CTERelationDef CTERelationRef Distinct Except Expand Filter Generate GlobalLimit Intersect Join LateralJoin LocalLimit LocalRelation Offset OneRowRelation Project Range
Sample Sort SubqueryAlias Union UnresolvedHint View Window WithCTE
""".split())
# Expressions of Spark's own that run code of the caller's choice or tell of the machine.
REFUSED = frozenset("CallMethodViaReflection InputFileName PythonFuncExpression PythonUDAF PythonUDF PythonUDTF ScalaUDAF ScalaUDF TryReflect".split())
EXPRESSIONS = "org.apache.spark.sql.catalyst.expressions."


def _seq(items) -> Iterator:
    for i in range(items.size()):
        yield items.apply(i)


def _nodes(node, stop=lambda node: False) -> Iterator:
    """All plan and expression nodes of a query, those of subqueries and common table expressions included; nothing below a node that ``stop`` names."""
    yield node
    if stop(node):
        return
    for below in (node.children(), node.innerChildren()):
        for child in _seq(below):
            yield from _nodes(child, stop)
    if _plan_class().isInstance(node):
        for expression in _seq(node.expressions()):
            yield from _nodes(expression, stop)


@functools.cache
def _plan_class():
    """The class of nodes that hold expressions besides their children."""
    return SparkContext._active_spark_context._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.plans.QueryPlan")


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def isolated(spark: SparkSession, views: dict[str, DataFrame]) -> SparkSession:
    """A session of the same application that holds just ``views``, with the caller's settings; files cannot be read by name in it."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.runSQLOnFiles", "false")
    dataset = spark._jvm.org.apache.spark.sql.classic.Dataset
    for name, df in views.items():
        dataset.ofRows(own._jsparkSession, df._jdf.queryExecution().analyzed()).createOrReplaceTempView(name)
    return own


def _check_calls(plan) -> None:
    for node in _nodes(plan):
        kind = _kind(node)
        if "UnresolvedIdentifier" in kind:
            raise FreeQueryRejected("names have to be written out")
        names = []
        if kind == "UnresolvedFunction":
            names = list(_seq(node.nameParts()))
        elif kind == "UnresolvedTableValuedFunction":
            names = list(_seq(node.name()))
        elif kind == "UnresolvedGenerator":
            names = [node.name().unquotedString()]
        if names and (len(names) > 1 or names[0].lower() not in FUNCTIONS):
            raise FreeQueryRejected(f"the function {'.'.join(names)} cannot be called")


def _check_reads(plan, views: set[str]) -> None:
    def is_view(node) -> bool:
        return _kind(node) == "View" and node.isTempView() and node.desc().identifier().database().isEmpty() and node.desc().identifier().table().lower() in views

    for node in _nodes(plan, is_view):
        kind, package = _kind(node), node.getClass().getName()
        if "plans.logical" in package or "execution" in package or not package.startswith(EXPRESSIONS):
            if kind not in OPERATORS or (kind == "View" and not is_view(node)):
                raise FreeQueryRejected(f"only {sorted(views)} can be read ({kind})")
        elif kind.rstrip("$") in REFUSED:
            raise FreeQueryRejected(f"the query calls outside the query engine ({kind})")


def checked_query(spark: SparkSession, sql: str, views: dict[str, DataFrame]) -> DataFrame:
    """The rows of a read-only query over ``views``, or :class:`FreeQueryRejected`.

    Nothing of the query is executed before it has passed: it is parsed and
    analysed only.  The result belongs to a session of its own."""
    own = isolated(spark, views)
    state = own._jsparkSession.sessionState()
    try:
        parsed = state.sqlParser().parsePlan(sql)
    except Exception as error:
        raise FreeQueryRejected(f"not a query: {str(error)[:200]}") from None
    _check_calls(parsed)
    try:
        analysed = state.analyzer().execute(parsed)
        state.analyzer().checkAnalysis(analysed)
    except Exception as error:
        raise FreeQueryRejected(f"cannot be resolved: {str(error)[:200]}") from None
    _check_reads(analysed, {name.lower() for name in views})
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(own._jsparkSession, parsed), own)
