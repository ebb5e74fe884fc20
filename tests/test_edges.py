"""Edge frames (FIXTURES F4): thresholds, coercion, band edges, guards."""

import pytest
from pyspark.sql import functions as F

from paramo.functions import altitude_band, altitude_order, round_half_up
from paramo.operators import clean as C
from paramo.operators import dashboard as D
from paramo.sources.star import Star, star_from_tpch

from .conftest import SF_SMALL


def test_clean_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a INT, b INT").toDF(" ALTITUD (m) ", "ANUAL")
    assert C.clean_columns(df).columns == ["ALTITUD_m", "ANUAL"]


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("abc",), ("1,5",), (" 7 ",), (None,)], "ANUAL STRING")
    got = [r[0] for r in C.coerce_numeric(df).collect()]
    assert got == [None, None, 7.0, None]


@pytest.mark.parametrize("n_match,expect_all", [(99, True), (100, False), (101, False)])
def test_min_support(spark, n_match, expect_all):
    rows = [("precipitación" if i % 2 == 0 else "PRECIP", i) for i in range(n_match)] + \
           [("TEMP", 1000 + i) for i in range(10)] + [(None, 5000)]
    df = spark.createDataFrame(rows, "PARAMETRO STRING, v INT")
    out = C.filter_min_support(df)
    assert out.count() == (len(rows) if expect_all else n_match)


@pytest.mark.parametrize("n_complete,keep_complete", [(49, False), (50, True), (51, True)])
def test_drop_incomplete(spark, n_complete, keep_complete):
    full = [(float(i), 1.0, 2.0, 3.0, 4.0) for i in range(n_complete)]
    partial = [(1.0, 1.0, 2.0, 3.0, None) for _ in range(5)]
    missing_core = [(None, 1.0, 2.0, 3.0, 4.0)]
    df = spark.createDataFrame(full + partial + missing_core,
                               "ALTITUD_m DOUBLE, LATITUD DOUBLE, LONGITUD DOUBLE, ANUAL DOUBLE, ENE DOUBLE")
    out = C.drop_incomplete(df)
    assert out.count() == (n_complete if keep_complete else n_complete + 5)


def test_altitude_bands(spark):
    df = spark.createDataFrame([(499.99,), (500.0,), (1500.0,), (2500.0,), (3500.0,), (None,)], "a DOUBLE")
    got = df.select(altitude_band("a").alias("b"), altitude_order("a").alias("o")).collect()
    assert [r.b for r in got] == ["Bajo", "Calido", "Templado", "Frio", "Paramo", "Paramo"]
    assert [r.o for r in got] == [1, 2, 3, 4, 5, 5]


def test_round_half_up_ties(spark):
    df = spark.createDataFrame([(1.005,), (-2.5,), (-0.001,)], "x DOUBLE")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert got[0] == 1.01 and got[1] == -2.5 and str(got[2]) == "0.0"


def test_find_column(spark):
    df = spark.createDataFrame([(1, 2)], "x INT, Departamento_Nombre INT")
    assert C.find_column(df) == "Departamento_Nombre"
    assert C.find_column(df.drop("Departamento_Nombre")) is None


@pytest.mark.parametrize("sql", [
    "WITH t AS (SELECT 1) SELECT * FROM t",
    "DROP TABLE dim_geografia",
    "SELECT TRANSFORM(id_geo) USING 'cat' FROM dim_geografia",
    "SELECT reflect('java.lang.System', 'exit', '0')",
    "SELECT * FROM parquet.`/etc/passwd`",
    "SELECT TRANSFORM(id_geo) USING /**/ 'cat' AS (x) FROM dim_geografia",
    "SELECT reflect/**/('java.lang.System', 'getenv', 'PATH')",
    "SELECT `reflect`('java.lang.System', 'getenv', 'PATH')",
    "SELECT try_reflect('java.lang.System', 'getenv', 'PATH')",
    "SELECT id_geo FROM dim_geografia WHERE java_method('java.lang.System', 'getenv', 'PATH') IS NOT NULL",
    "SELECT * FROM parquet./**/`/etc/passwd`",
    "SELECT (SELECT max(x) FROM csv.`/etc/passwd`)",
    "SELECT * FROM (SELECT 1) t WHERE EXISTS (SELECT 1 FROM text.`/etc/passwd`)",
    "SELECT * FROM somebody_elses_table",
    "SELECT 1; DROP TABLE x",
    "SELECT * FROM (SELECT 1",
    "",
    # computed names, names hidden behind an alias, other catalogs, functions that tell of the machine
    "SELECT IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'user.name')",
    "SELECT IDENTIFIER('ref' || 'lect')('java.lang.System', 'getProperty', 'user.name')",
    "SELECT * FROM IDENTIFIER('secret')",
    "SELECT * FROM IDENTIFIER('sec' || 'ret')",
    "SELECT s.* FROM secret s CROSS JOIN (SELECT 1) secret",
    f"SELECT f.* FROM parquet.`{SF_SMALL}/nation.parquet` f CROSS JOIN (SELECT 1) AS `parquet.{SF_SMALL}/nation.parquet`",
    "SELECT * FROM global_temp.secret",
    "SELECT (SELECT max(id) FROM secret)",
    "SELECT * FROM dim_geografia WHERE id_geo IN (SELECT id FROM secret)",
    "SELECT * FROM dim_geografia, LATERAL (SELECT id FROM secret)",
    "SELECT * FROM (WITH secret AS (SELECT 1 AS a) SELECT * FROM secret) a, secret b",
    "SELECT transform(array(1), x -> reflect('java.lang.System', 'getProperty', 'user.name'))",
    "SELECT builtin.reflect('java.lang.System', 'getProperty', 'user.name')",
    "SELECT mine(1)",
    "SELECT input_file_name()",
    "SELECT current_user()",
    "SELECT * FROM sql_keywords()",
])
def test_free_select_rejects(spark, sql):
    star = star_from_tpch(spark, SF_SMALL)
    spark.range(3).createOrReplaceTempView("secret")
    spark.range(3).createOrReplaceGlobalTempView("secret")
    spark.udf.register("mine", lambda x: x)
    with pytest.raises(D.FreeQueryRejected):
        D.free_select(spark, star, sql)
    spark.catalog.dropTempView("secret")


@pytest.mark.parametrize("sql,n", [
    ("SELECT * FROM (WITH a AS (SELECT id_geo FROM dim_geografia) SELECT a.id_geo FROM a JOIN dim_geografia dim_tiempo USING (id_geo)) x", 25),
    ("SELECT departamento, row_number() OVER (ORDER BY departamento) AS r, (SELECT max(id_tiempo) FROM dim_tiempo) AS m FROM dim_geografia WHERE EXISTS (SELECT 1 FROM dim_periodo) LIMIT 3", 3),
    ("SELECT x, count(*) AS n FROM (VALUES (1), (2)) t(x) GROUP BY ROLLUP(x) HAVING count(*) > 0", 3),
    ("SELECT upper(departamento) || 'x', CAST(id_geo AS DOUBLE) FROM dim_geografia WHERE departamento LIKE 'N%' AND id_geo BETWEEN 0 AND 4", 5),
    ("SELECT * FROM dim_tiempo UNION SELECT * FROM dim_tiempo", 13),
])
def test_free_select_allows_queries_of_its_own_relations(spark, sql, n):
    assert len(D.free_select(spark, star_from_tpch(spark, SF_SMALL), sql).collect()) == n


def test_free_select_does_not_run_what_it_refuses(spark):
    before = {t.name for t in spark.catalog.listTables()}
    for sql in ("SELECT 1; CREATE TABLE made AS SELECT 1", "CREATE TABLE made AS SELECT 1"):
        with pytest.raises(D.FreeQueryRejected):
            D.free_select(spark, star_from_tpch(spark, SF_SMALL), sql)
    assert {t.name for t in spark.catalog.listTables()} == before


def test_free_select_allows_harmless_texts_and_leaves_views_alone(spark):
    star = star_from_tpch(spark, SF_SMALL)
    spark.range(3).createOrReplaceTempView("dim_periodo")
    rows = D.free_select(spark, star, "SELECT 'using \"x' AS a, p.periodo FROM dim_periodo p JOIN (SELECT DISTINCT id_periodo FROM dim_periodo) q USING (id_periodo)").collect()
    assert len(rows) == 2 and {r["a"] for r in rows} == {'using "x'}
    assert [r["id"] for r in spark.table("dim_periodo").orderBy("id").collect()] == [0, 1, 2]
    spark.catalog.dropTempView("dim_periodo")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(("dim_", "hechos"))]


def test_combined_index_keeps_fractions_of_altitude(spark):
    star = star_from_tpch(spark, SF_SMALL)
    dims = dict(star.dims, dim_estacion=star.dim("dim_estacion").withColumn("altitud", F.lit(512.9)))
    got = D.combined_index(Star(star.fact_source, dims, star.catalogs, star.constants)).collect()
    assert {r["altitud_media"] for r in got} == {513.0}


def test_numbers_are_strict(spark):
    texts = ["1d", "2f", "0x1p3", " 1.5 ", "-2e3", ".5", "7.", "", "abc", "1,5", "NaN", "inf", None, "+4", "1 2"]
    got = C.coerce_numeric(spark.createDataFrame([(t,) for t in texts], "ANUAL STRING")).collect()
    want = [None, None, None, 1.5, -2000.0, 0.5, 7.0, None, None, None, float("nan"), float("inf"), None, 4.0, None]
    assert [str(r[0]) for r in got] == [str(w) for w in want]
    kept = spark.createDataFrame([(3, 2.5)], "ANUAL INT, ENE DOUBLE")
    assert C.coerce_numeric(kept).schema.simpleString() == "struct<ANUAL:double,ENE:double>"


def test_boxplots_of_all_features(spark):
    from paramo.operators.profiles import boxplot_data
    names = [f"f{i}" for i in range(6)]
    frame = spark.createDataFrame([(i, 0, *[float(i + j) for j in range(6)]) for i in range(9)], "id_fila long, lab int, " + ", ".join(f"{n} double" for n in names))
    assert {r["feature"] for r in boxplot_data(frame, "lab", names).collect()} == set(names)


def test_empty_blocks_do_not_count_pairs_twice(spark):
    """With blocks of one row most pairs of blocks lack a side; results stay those of one block."""
    from paramo.operators import pairwise as P
    rng = __import__("numpy").random.default_rng(2)
    pts = spark.createDataFrame([(i, [float(v) for v in rng.normal(size=2)], i % 2) for i in range(12)], "id_fila long, x array<double>, lab int")
    for run in (lambda b: P.knn_distance(pts, block_size=b), lambda b: P.dbscan(pts, 0.8, 3, block_size=b), lambda b: P.silhouette_euclid(pts, "lab", block_size=b)):
        assert sorted(tuple(round(v, 9) for v in r) for r in run(1).collect()) == sorted(tuple(round(v, 9) for v in r) for r in run(1000).collect())


def test_free_select_allows_order_by(spark):
    star = star_from_tpch(spark, SF_SMALL)
    rows = D.free_select(spark, star, "select departamento from dim_geografia order by departamento desc").collect()
    assert rows[0][0] >= rows[-1][0]


def test_filter_query_empty_parameter(spark):
    star = star_from_tpch(spark, SF_SMALL)
    assert D.filter_query(star, "").count() == 0


def test_rank_ties_are_broken(spark):
    """D5 tie-breaks: equal means resolve by month then place, deterministically."""
    star = star_from_tpch(spark, SF_SMALL)
    a = D.rainiest_peak_months(star).collect()
    b = D.rainiest_peak_months(star).collect()
    assert a == b and len(a) == 6


def test_dashboard_bundle(spark):
    """The eight dashboard results by name, all runnable."""
    bundle = D.dashboard_bundle(star_from_tpch(spark, SF_SMALL))
    assert sorted(bundle) == sorted(["precip_por_mes_periodo", "amplitud_termica", "indice_combinado",
                                     "tendencia_periodos", "meses_lluviosos", "departamentos",
                                     "parametros", "periodos"])
    n_stations = spark.read.parquet(f"{SF_SMALL}/supplier.parquet").count()
    assert bundle["amplitud_termica"].count() == min(15, n_stations)
    assert bundle["parametros"].count() == 5


def test_row_key_without_business_key(spark):
    """Without a key column, a content hash independent of partitioning."""
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, "c")], "ANUAL DOUBLE, ESTACION STRING")
    a = {r.ESTACION: r.id_fila for r in C.with_row_key(df).collect()}
    b = {r.ESTACION: r.id_fila for r in C.with_row_key(df.repartition(3)).collect()}
    assert a == b and sorted(a.values()) == [0, 1, 2]


def test_row_key_tells_equal_rows_apart(spark):
    df = spark.createDataFrame([(1.0, "a"), (1.0, "a"), (None, None), (2.0, "b")], "ANUAL DOUBLE, ESTACION STRING")
    keyed = C.with_row_key(df).collect()
    assert sorted(r.id_fila for r in keyed) == [0, 1, 2, 3]
