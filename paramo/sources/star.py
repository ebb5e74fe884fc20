"""Star-schema sources (A1): the fact of readings and its five dimensions.

Two ways to obtain a :class:`Star`:

* :func:`read_star` — materialised tables (parquet folders, or JDBC through
  ``spark.read.jdbc`` by the caller).  Write them with :func:`write_star`,
  which partitions the fact by ``id_parametro`` so that a parameter filter on
  the dimension prunes fact files (static pruning when the parameter catalog
  is known, dynamic partition pruning otherwise).
* :func:`star_from_tpch` — the star derived from the TPC-H-shaped test tables
  (nation -> place, supplier -> station, lineitem measures -> readings), so
  that every query's work grows with the given tables.

Joins are left to Catalyst/AQE except for the constant dimensions, whose size
is fixed (13, 2 and 6 rows) and which are broadcast explicitly.  Place and
station dimensions grow with the data and are broadcast only when the
optimizer's size estimate (or AQE's runtime size) is under
``spark.sql.autoBroadcastJoinThreshold``; beyond it they shuffle-join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACT = "hechos_climaticos"
DIMS = ("dim_geografia", "dim_estacion", "dim_tiempo", "dim_periodo", "dim_parametro")
KEYS = {
    "dim_geografia": "id_geo",
    "dim_estacion": "id_estacion",
    "dim_tiempo": "id_tiempo",
    "dim_periodo": "id_periodo",
    "dim_parametro": "id_parametro",
}

# Fixed values of the constant dimensions of the test star (id, name, extra).
PARAMETROS = (
    (1, "PRECIPITACIÓN", "mm"),
    (2, "TEMPERATURA MÁXIMA", "°C"),
    (3, "TEMPERATURA MÍNIMA", "°C"),
    (4, "TEMPERATURA MEDIA", "°C"),
    (5, "No. DE DIAS CON LLUVIA", "días"),
    (6, "BRILLO SOLAR", "h"),
)
MESES = (
    (1, "Enero", 1), (2, "Febrero", 2), (3, "Marzo", 3), (4, "Abril", 4),
    (5, "Mayo", 5), (6, "Junio", 6), (7, "Julio", 7), (8, "Agosto", 8),
    (9, "Septiembre", 9), (10, "Octubre", 10), (11, "Noviembre", 11),
    (12, "Diciembre", 12), (13, "Anual", None),
)
PERIODOS = ((1, "1995-1997"), (2, "1998-2001"))
ANNUAL_ID = 13
LAST_YEAR_OF_FIRST_PERIOD = 1997


def summed(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*KEYS.values()).agg(
        F.sum("valor_medicion").alias("s"), F.count("valor_medicion").alias("c"), F.max("valor_medicion").alias("mx"),
        F.min("valor_medicion").alias("mn"), F.count(F.lit(1)).alias("n"))


@dataclass
class Star:
    """A fact source plus the five dimension DataFrames.

    ``fact(param_ids, tiempo_ids)`` returns the fact restricted to the given
    key sets (``None`` = all).  ``catalogs`` holds the name -> id maps of the
    dimensions that are constant, so a filter on a dimension attribute can be
    turned into a key-set filter at plan time.
    """

    fact_source: Callable[[frozenset | None, frozenset | None], DataFrame]
    dims: dict[str, DataFrame]
    catalogs: dict[str, dict[str, int]] = field(default_factory=dict)
    constants: dict[str, tuple] = field(default_factory=dict)
    cell_source: Callable[[frozenset | None, frozenset | None], DataFrame] | None = None

    def cells(self, param_ids: Iterable[int] | None = None, tiempo_ids: Iterable[int] | None = None) -> DataFrame:
        """The fact summed up on its five keys: ``s, c, mx, mn`` (sum, count, largest, smallest value) and ``n`` (rows)."""
        if self.cell_source is None:
            return summed(self.fact(param_ids, tiempo_ids))
        p = frozenset(param_ids) if param_ids is not None else None
        t = frozenset(tiempo_ids) if tiempo_ids is not None else None
        return self.cell_source(p, t)

    def fact(self, param_ids: Iterable[int] | None = None,
             tiempo_ids: Iterable[int] | None = None) -> DataFrame:
        p = frozenset(param_ids) if param_ids is not None else None
        t = frozenset(tiempo_ids) if tiempo_ids is not None else None
        return self.fact_source(p, t)

    def dim(self, name: str) -> DataFrame:
        return self.dims[name]

    def ids(self, dim: str, include: Iterable[str] | None = None,
            exclude: Iterable[str] | None = None) -> frozenset | None:
        """Key set of a constant dimension matching a name filter, else None."""
        cat = self.catalogs.get(dim)
        if cat is None:
            return None
        names = set(cat) if include is None else set(include)
        names -= set(exclude or ())
        return frozenset(cat[n] for n in names if n in cat)

    def tables(self) -> dict[str, DataFrame]:
        out = {FACT: self.fact()}
        out.update(self.dims)
        return out


def _sql_literal(v, sql_type: str) -> str:
    if v is None:
        return f"CAST(NULL AS {sql_type})"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return f"CAST({v} AS {sql_type})"


def values_frame(spark: SparkSession, rows, schema: list[tuple[str, str]]) -> DataFrame:
    """A constant table as an inline ``VALUES`` relation (a local relation
    with exact size statistics, so the optimizer broadcasts it by itself)."""
    body = ", ".join("(" + ", ".join(_sql_literal(v, t) for v, (_, t) in zip(r, schema)) + ")" for r in rows)
    cols = ", ".join(n for n, _ in schema)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({cols})")


def _constant_dims(spark: SparkSession) -> dict[str, DataFrame]:
    tiempo = values_frame(spark, MESES, [("id_tiempo", "INT"), ("nombre_mes", "STRING"), ("num_mes", "INT")])
    periodo = values_frame(spark, PERIODOS, [("id_periodo", "INT"), ("periodo", "STRING")])
    parametro = values_frame(spark, PARAMETROS, [("id_parametro", "INT"), ("parametro", "STRING"),
                                                 ("unidad_medida", "STRING")])
    return {"dim_tiempo": tiempo, "dim_periodo": periodo, "dim_parametro": parametro}


def _tpch_measures() -> dict[int, F.Column]:
    """Reading value per parameter id, from lineitem columns (``+ 0.0`` drops -0.0)."""
    return {
        1: F.col("l_quantity") * 4,
        2: F.col("l_extendedprice") / 1000,
        3: F.col("l_discount") * 100 + F.lit(0.0),
        4: F.col("l_tax") * 100 + F.lit(0.0),
        5: F.col("l_linenumber").cast("double"),
    }


def star_from_tpch(spark: SparkSession, sf_dir: str) -> Star:
    """Star schema derived from the TPC-H-shaped tables under ``sf_dir``.

    The monthly fact is one scan of lineitem (joined to supplier for the
    place key) unpivoted into one row per measure (an ``Expand``, not five
    scans); the annual pseudo-month rows are ``12 * AVG`` per station, place,
    period and parameter, a partial+final aggregate.  Only the measures and
    months a query asks for are generated.
    """
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")

    dims = _constant_dims(spark)
    dims["dim_geografia"] = nation.select(
        F.col("n_nationkey").alias("id_geo"), F.col("n_name").alias("departamento"))
    dims["dim_estacion"] = supplier.select(
        F.col("s_suppkey").alias("id_estacion"), F.col("s_name").alias("estacion"),
        F.floor(F.abs(F.col("s_acctbal"))).cast("int").alias("altitud"))

    measures = _tpch_measures()
    keys = ["id_estacion", "id_geo", "id_tiempo", "id_periodo"]

    def monthly(param_ids) -> DataFrame | None:
        """The monthly readings of the wanted measures, from one scan of lineitem."""
        pids = sorted(measures if param_ids is None else (set(param_ids) & set(measures)))
        if not pids:
            return None
        obs = (
            lineitem.join(supplier.select("s_suppkey", "s_nationkey"),
                          F.col("l_suppkey") == F.col("s_suppkey"))
            .select(
                F.col("l_suppkey").alias("id_estacion"),
                F.col("s_nationkey").alias("id_geo"),
                F.month("l_shipdate").cast("int").alias("id_tiempo"),
                F.when(F.year("l_shipdate") <= LAST_YEAR_OF_FIRST_PERIOD, F.lit(1))
                .otherwise(F.lit(2)).alias("id_periodo"),
                *[measures[p].alias(f"v{p}") for p in pids],
            )
        )
        if len(pids) == 1:
            (p,) = pids
            return obs.select(*keys, F.lit(p).alias("id_parametro"), F.col(f"v{p}").alias("valor_medicion"))
        return (obs.unpivot(keys, [F.col(f"v{p}").alias(str(p)) for p in pids], "parametro_id", "valor_medicion")
                .select(*keys, F.col("parametro_id").cast("int").alias("id_parametro"), "valor_medicion"))

    empty = "id_estacion BIGINT, id_geo INT, id_tiempo INT, id_periodo INT, id_parametro INT, "

    def wanted(tiempo_ids) -> tuple[set, bool]:
        if tiempo_ids is None:
            return set(range(1, 13)), True
        return set(tiempo_ids) - {ANNUAL_ID}, ANNUAL_ID in tiempo_ids

    def cell_source(param_ids, tiempo_ids) -> DataFrame:
        mensual, (monthly_ids, want_annual) = monthly(param_ids), wanted(tiempo_ids)
        if mensual is None or (not monthly_ids and not want_annual):
            return spark.createDataFrame([], empty + "s DOUBLE, c BIGINT, mx DOUBLE, mn DOUBLE, n BIGINT")
        cells = summed(mensual)
        if monthly_ids != set(range(1, 13)):
            cells = cells.where(F.col("id_tiempo").isin(sorted(monthly_ids))) if not want_annual else cells
        if not want_annual:
            return cells
        # the months of a place and period (twelve at most) and, after them, twelve times their mean: lineitem is read once
        v = F.sum("s") / F.nullif(F.sum("c"), F.lit(0)) * 12
        year = F.struct(F.lit(ANNUAL_ID).alias("id_tiempo"), "v", F.when(F.col("v").isNotNull(), 1).otherwise(0).cast("long").alias("c"),
                        F.col("v").alias("mx"), F.col("v").alias("mn"), F.lit(1).cast("long").alias("n"))
        months = F.filter("months", lambda m: m["id_tiempo"].isin(sorted(monthly_ids))) if monthly_ids else F.slice("months", F.lit(1), F.lit(0))
        by_place = cells.groupBy("id_estacion", "id_geo", "id_periodo", "id_parametro").agg(
            F.collect_list(F.struct("id_tiempo", F.col("s").alias("v"), "c", "mx", "mn", "n")).alias("months"), v.alias("v"))
        return by_place.select("id_estacion", "id_geo", "id_periodo", "id_parametro", F.inline(F.concat(months, F.array(year)))).withColumnRenamed("v", "s")

    def fact_source(param_ids, tiempo_ids) -> DataFrame:
        mensual, (monthly_ids, want_annual) = monthly(param_ids), wanted(tiempo_ids)
        if mensual is None or (not monthly_ids and not want_annual):
            return spark.createDataFrame([], empty + "valor_medicion DOUBLE")
        parts = []
        if monthly_ids:
            m = mensual
            if monthly_ids != set(range(1, 13)):
                m = m.where(F.col("id_tiempo").isin(sorted(monthly_ids)))
            parts.append(m)
        if want_annual:
            parts.append(
                mensual.groupBy("id_estacion", "id_geo", "id_periodo", "id_parametro")
                .agg((F.avg("valor_medicion") * 12).alias("valor_medicion"))
                .select("id_estacion", "id_geo", F.lit(ANNUAL_ID).alias("id_tiempo"),
                        "id_periodo", "id_parametro", "valor_medicion")
            )
        out = parts[0]
        for extra in parts[1:]:
            out = out.unionByName(extra)
        return out

    catalogs = {
        "dim_parametro": {name: pid for pid, name, _ in PARAMETROS},
        "dim_tiempo": {name: tid for tid, name, _ in MESES},
        "dim_periodo": {name: pid for pid, name in PERIODOS},
    }
    constants = {"dim_parametro": PARAMETROS, "dim_tiempo": MESES, "dim_periodo": PERIODOS}
    return Star(fact_source=fact_source, dims=dims, catalogs=catalogs, constants=constants, cell_source=cell_source)


def read_star(spark: SparkSession, path: str, fmt: str = "parquet") -> Star:
    """Materialised star: ``path/<table>`` for the fact and each dimension."""
    reader = spark.read.format(fmt)
    fact = reader.load(f"{path}/{FACT}")
    dims = {d: spark.read.format(fmt).load(f"{path}/{d}") for d in DIMS}

    def fact_source(param_ids, tiempo_ids) -> DataFrame:
        out = fact
        if param_ids is not None:
            out = out.where(F.col("id_parametro").isin(sorted(param_ids)))
        if tiempo_ids is not None:
            out = out.where(F.col("id_tiempo").isin(sorted(tiempo_ids)))
        return out

    return Star(fact_source=fact_source, dims=dims)


def read_star_jdbc(spark: SparkSession, url: str, properties: dict, tables: dict | None = None,
                   fact_partition_column: str = "id_estacion", num_partitions: int = 64) -> Star:
    """Star read from a database over JDBC (credentials come from the caller).

    The fact is read in ``num_partitions`` parallel range slices of
    ``fact_partition_column`` (bounds from one ``MIN/MAX`` query), so no
    single connection streams the whole fact; the dimensions are single
    reads.  ``tables`` maps our names to the database's table names.
    """
    names = {FACT: FACT, **{d: d for d in DIMS}, **(tables or {})}
    bounds = spark.read.jdbc(
        url, f"(SELECT MIN({fact_partition_column}) AS lo, MAX({fact_partition_column}) AS hi "
             f"FROM {names[FACT]}) b", properties=properties).first()
    fact = spark.read.jdbc(url, names[FACT], column=fact_partition_column,
                           lowerBound=int(bounds["lo"] or 0), upperBound=int(bounds["hi"] or 0) + 1,
                           numPartitions=num_partitions, properties=properties)
    dims = {d: spark.read.jdbc(url, names[d], properties=properties) for d in DIMS}

    def fact_source(param_ids, tiempo_ids) -> DataFrame:
        out = fact
        if param_ids is not None:
            out = out.where(F.col("id_parametro").isin(sorted(param_ids)))
        if tiempo_ids is not None:
            out = out.where(F.col("id_tiempo").isin(sorted(tiempo_ids)))
        return out

    return Star(fact_source=fact_source, dims=dims)


def write_star(star: Star, path: str, fmt: str = "parquet") -> None:
    """Persist a star; the fact is partitioned by parameter for pruning."""
    (star.fact().write.mode("overwrite").format(fmt)
     .partitionBy("id_parametro").save(f"{path}/{FACT}"))
    for name, df in star.dims.items():
        df.write.mode("overwrite").format(fmt).save(f"{path}/{name}")
