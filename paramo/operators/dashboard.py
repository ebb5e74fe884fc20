"""Dashboard queries over the star schema.

Every query follows the same physical recipe, chosen for a fact that is
orders of magnitude larger than its dimensions:

1. restrict the fact by the dimension filters — by key set at plan time when
   the dimension is constant (prunes unpivot branches / parquet partitions),
   otherwise by a semi join to the filtered dimension (dynamic pruning);
2. pre-aggregate the fact on surrogate keys (partial + final hash aggregate;
   a hot key is combined map-side before the shuffle, so one place holding a
   third of all readings never lands whole in one task);
3. join the small aggregated table to the dimensions for their attributes and
   re-aggregate by the attribute values (several ids may share a name);
4. rank / sort the handful of result rows.

AVG is carried as (sum, count) through step 2, MAX/MIN directly, and
``COUNT(DISTINCT station)`` by keeping the station key in step 2's grain.
Rounding uses :func:`paramo.functions.round_half_up` (half away from zero on
the decimal value).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paramo.functions import round_half_up
from paramo.plans.guard import FreeQueryRejected, checked_query
from paramo.sources.star import Star

# Parameter names the dashboard asks for.
PRECIPITACION = "PRECIPITACIÓN"
TEMP_MAX = "TEMPERATURA MÁXIMA"
TEMP_MIN = "TEMPERATURA MÍNIMA"
TEMP_MEDIA = "TEMPERATURA MEDIA"
DIAS_LLUVIA = "No. DE DIAS CON LLUVIA"
BRILLO_SOLAR = "BRILLO SOLAR"
ANUAL = "Anual"


def cells(star: Star, parametros: Iterable[str], exclude_meses: Iterable[str] = ()) -> DataFrame:
    """The named parameters' readings summed up on the fact's keys, with ``parametro`` / ``unidad_medida``.

    Inner-join semantics with the parameter (and, when months are excluded,
    the time) dimension; the key-set restriction happens before any join.
    """
    parametros = list(parametros)
    exclude_meses = list(exclude_meses)
    pids = star.ids("dim_parametro", include=parametros)
    tids = star.ids("dim_tiempo", exclude=exclude_meses) if exclude_meses else None
    fact = star.cells(param_ids=pids, tiempo_ids=tids)
    rows = star.constants.get("dim_parametro")
    if pids is not None and rows is not None:
        # Constant dimension, keys already pruned: its attributes are a
        # literal lookup on the key, no join at all.
        name = F.create_map(*[x for pid, n, _ in rows for x in (F.lit(pid), F.lit(n))])
        unit = F.create_map(*[x for pid, _, u in rows for x in (F.lit(pid), F.lit(u))])
        out = fact.withColumns({"parametro": name[F.col("id_parametro")],
                                "unidad_medida": unit[F.col("id_parametro")]})
    else:
        params = (star.dim("dim_parametro")
                  .where(F.col("parametro").isin(parametros))
                  .select("id_parametro", "parametro", "unidad_medida"))
        # broadcast by the planner if the table is small
        out = fact.join(params, "id_parametro")
    if exclude_meses:
        months = (star.dim("dim_tiempo")
                  .where(~F.col("nombre_mes").isin(exclude_meses)).select("id_tiempo"))
        out = out.join(months, "id_tiempo", "left_semi")
    return out


def _avg(s: str, c: str) -> Column:
    return F.sum(s) / F.nullif(F.sum(c), F.lit(0))


def _when_param(name: str, value: str) -> Column:
    return F.when(F.col("parametro") == name, F.col(value))


def precip_by_month_period(star: Star) -> DataFrame:
    """Mean precipitation per place, month and period (annual row last)."""
    pre = (cells(star, [PRECIPITACION])
           .groupBy("id_geo", "id_tiempo", "id_periodo")
           .agg(F.sum("s").alias("s"), F.sum("c").alias("c")))
    return (
        pre.join(star.dim("dim_geografia"), "id_geo")
        .join(star.dim("dim_tiempo"), "id_tiempo")
        .join(star.dim("dim_periodo"), "id_periodo")
        .groupBy("departamento", "nombre_mes", "num_mes", "periodo")
        .agg(round_half_up(_avg("s", "c"), 2).alias("promedio"))
        .orderBy("departamento", F.coalesce(F.col("num_mes"), F.lit(99)), "periodo")
    )


def thermal_range_top15(star: Star, n: int = 15) -> DataFrame:
    """The ``n`` stations with the widest max - min temperature range.

    Ties on the rounded range are broken by station, altitude and place
    (the reference leaves them undefined).
    """
    pre = (cells(star, [TEMP_MAX, TEMP_MIN])
           .groupBy("id_estacion", "id_geo")
           .agg(F.max(_when_param(TEMP_MAX, "mx")).alias("tmax"),
                F.min(_when_param(TEMP_MIN, "mn")).alias("tmin")))
    grouped = (
        pre.join(star.dim("dim_estacion"), "id_estacion")
        .join(star.dim("dim_geografia"), "id_geo")
        .groupBy("estacion", "altitud", "departamento")
        .agg(F.max("tmax").alias("tmax"), F.min("tmin").alias("tmin"))
        .where(F.col("tmax").isNotNull())
    )
    return (
        grouped.select(
            "estacion", "altitud", "departamento",
            round_half_up("tmax", 2).alias("temp_max"),
            round_half_up("tmin", 2).alias("temp_min"),
            round_half_up(F.col("tmax") - F.col("tmin"), 2).alias("amplitud_termica"))
        .orderBy(F.col("amplitud_termica").desc_nulls_last(), "estacion", "altitud", "departamento")
        .limit(n)
    )


def combined_index(star: Star) -> DataFrame:
    """D3: per place, mean precipitation, mean temperature, rainy days and
    fact-row-weighted mean station altitude."""
    r = cells(star, [PRECIPITACION, TEMP_MEDIA, DIAS_LLUVIA])
    aggs = []
    for tag, name in (("p", PRECIPITACION), ("t", TEMP_MEDIA), ("d", DIAS_LLUVIA)):
        aggs += [F.sum(_when_param(name, "s")).alias(f"s_{tag}"), F.sum(_when_param(name, "c")).alias(f"c_{tag}")]
    pre = r.groupBy("id_geo", "id_estacion").agg(*aggs, F.sum("n").alias("n"))
    joined = (pre.join(star.dim("dim_estacion").select("id_estacion", "altitud"), "id_estacion")
              .join(star.dim("dim_geografia"), "id_geo"))
    alt_rows = F.when(F.col("altitud").isNotNull(), F.col("n"))
    return (
        joined.groupBy("departamento")
        .agg(round_half_up(_avg("s_p", "c_p"), 2).alias("precip_promedio"),
             round_half_up(_avg("s_t", "c_t"), 2).alias("temp_promedio"),
             round_half_up(_avg("s_d", "c_d"), 2).alias("dias_lluvia"),
             round_half_up(F.sum(F.col("altitud").cast("double") * F.col("n"))
                           / F.nullif(F.sum(alt_rows), F.lit(0)), 0).alias("altitud_media"))
        .orderBy(F.col("precip_promedio").desc_nulls_last(), "departamento")
    )


def trend_by_period(star: Star) -> DataFrame:
    """Mean of precipitation and mean temperature per period and month."""
    pre = (cells(star, [PRECIPITACION, TEMP_MEDIA])
           .groupBy("id_periodo", "id_tiempo", "parametro")
           .agg(F.sum("s").alias("s"), F.sum("c").alias("c")))
    return (
        pre.join(star.dim("dim_periodo"), "id_periodo")
        .join(star.dim("dim_tiempo"), "id_tiempo")
        .groupBy("periodo", "nombre_mes", "num_mes", "parametro")
        .agg(round_half_up(_avg("s", "c"), 2).alias("valor_promedio"))
        .orderBy("parametro", F.col("num_mes").asc_nulls_first(), "periodo")
    )


def rainiest_peak_months(star: Star, top: int = 3) -> DataFrame:
    """Per period, the ``top`` places by their peak-month mean precipitation.

    Peak month per (period, place) by ``ROW_NUMBER`` on the rounded mean
    (tie: lower month number), then the top places per period (tie: place).
    The annual pseudo-month is excluded.
    """
    # Station semi join after the pre-aggregate: it then meets one row per
    # (place, month, period, station), not every reading.
    pre = (cells(star, [PRECIPITACION], exclude_meses=[ANUAL])
           .join(star.dim("dim_estacion").select("id_estacion"), "id_estacion", "left_semi"))
    monthly = (
        pre.join(star.dim("dim_tiempo"), "id_tiempo")
        .join(star.dim("dim_periodo"), "id_periodo")
        .join(star.dim("dim_geografia"), "id_geo")
        .groupBy("departamento", "nombre_mes", "num_mes", "periodo")
        .agg(round_half_up(_avg("s", "c"), 2).alias("precipitacion_promedio"),
             F.countDistinct("id_estacion").alias("num_estaciones"))
    )
    by_month = Window.partitionBy("periodo", "departamento").orderBy(
        F.col("precipitacion_promedio").desc_nulls_last(), F.col("num_mes").asc_nulls_last())
    by_place = Window.partitionBy("periodo").orderBy(
        F.col("precipitacion_promedio").desc_nulls_last(), F.col("departamento"))
    return (
        monthly.withColumn("rk_mes", F.row_number().over(by_month))
        .where(F.col("rk_mes") == 1)
        .withColumn("rk_depto", F.row_number().over(by_place))
        .where(F.col("rk_depto") <= top)
        .orderBy("periodo", "rk_depto")
        .select("departamento", "nombre_mes", "periodo", "precipitacion_promedio", "num_estaciones")
    )


def list_departamentos(star: Star) -> DataFrame:
    """Distinct place names, sorted."""
    return star.dim("dim_geografia").select("departamento").distinct().orderBy("departamento")


def _in_use(star: Star, dim: str, key: str, used_only: bool) -> DataFrame:
    """The dimension, or those of its rows that some reading refers to (the fact's keys are combined before the shuffle)."""
    rows = star.dim(dim)
    return rows.join(star.fact().select(key).distinct(), key, "left_semi") if used_only else rows


def list_parametros(star: Star, used_only: bool = False) -> DataFrame:
    """Distinct parameter names except sunshine, sorted (NULL rejected); with ``used_only`` those that have readings."""
    return (_in_use(star, "dim_parametro", "id_parametro", used_only).where(F.col("parametro") != BRILLO_SOLAR)
            .select("parametro").distinct().orderBy("parametro"))


def list_periodos(star: Star, used_only: bool = False) -> DataFrame:
    """Distinct period names, sorted; with ``used_only`` those that have readings."""
    return _in_use(star, "dim_periodo", "id_periodo", used_only).select("periodo").distinct().orderBy("periodo")


def dashboard_bundle(star: Star) -> dict[str, DataFrame]:
    """The eight dashboard results by name (lazy; share the star)."""
    return {
        "precip_por_mes_periodo": precip_by_month_period(star),
        "amplitud_termica": thermal_range_top15(star),
        "indice_combinado": combined_index(star),
        "tendencia_periodos": trend_by_period(star),
        "meses_lluviosos": rainiest_peak_months(star),
        "departamentos": list_departamentos(star),
        "parametros": list_parametros(star),
        "periodos": list_periodos(star),
    }


def filter_query(star: Star, parametro: str = "", departamento: str = "", periodo: str = "") -> DataFrame:
    """Parametrised per-month summary.

    ``parametro`` is always applied (an empty one matches nothing); place and
    period only when non-empty.  Filters are values, never SQL text.
    """
    r = cells(star, [parametro or ""])
    if departamento:
        geo = star.dim("dim_geografia").where(F.col("departamento") == departamento).select("id_geo")
        r = r.join(geo, "id_geo", "left_semi")
    if periodo:
        pids = star.ids("dim_periodo", include=[periodo])
        if pids is not None:
            r = r.where(F.col("id_periodo").isin(sorted(pids)))
        per = star.dim("dim_periodo").where(F.col("periodo") == periodo).select("id_periodo")
        r = r.join(per, "id_periodo", "left_semi")
    pre = (r.join(star.dim("dim_estacion").select("id_estacion"), "id_estacion", "left_semi"))
    return (
        pre.join(star.dim("dim_geografia"), "id_geo")
        .join(star.dim("dim_periodo"), "id_periodo")
        .join(star.dim("dim_tiempo"), "id_tiempo")
        .groupBy("departamento", "nombre_mes", "num_mes", "periodo", "parametro", "unidad_medida")
        .agg(round_half_up(_avg("s", "c"), 2).alias("promedio"),
             round_half_up(F.max("mx"), 2).alias("maximo"),
             round_half_up(F.min("mn"), 2).alias("minimo"),
             F.countDistinct("id_estacion").alias("num_estaciones"))
        .orderBy("departamento", F.col("num_mes").asc_nulls_first(), "periodo")
    )


def free_select(spark: SparkSession, star: Star, sql: str) -> DataFrame:
    """A caller's read-only query over the star views.

    The trimmed text must start with ``SELECT`` (case-insensitively) and pass
    :func:`paramo.plans.guard.checked_query`: it is analysed in a session of
    its own that holds the star's views only, and whatever is not known to be
    harmless is refused.  The caller's session is not touched."""
    text = (sql or "").strip()
    if not text.upper().startswith("SELECT"):
        raise FreeQueryRejected("only SELECT queries are allowed")
    return checked_query(spark, text, star.tables())
