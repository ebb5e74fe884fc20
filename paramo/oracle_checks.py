"""DuckDB SQL for the queries of :mod:`paramo.plans.checks`."""

from __future__ import annotations

from paramo import oracle_sql as osql
from paramo.oracle_sql import FEATURES, R, with_star, with_wide

_D = {"precip_por_mes_periodo": osql.D1, "amplitud_termica": osql.D2, "indice_combinado": osql.D3, "tendencia_periodos": osql.D4,
      "meses_lluviosos": osql.D5, "departamentos": osql.D6, "parametros": osql.D7, "periodos": osql.D8}


def _counts(tables: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{name}' AS name, COUNT(*) AS rows FROM ({sql}) t" for name, sql in tables.items())


_USED = """SELECT DISTINCT {name} FROM dim_{dim} WHERE {key} IN (SELECT {key} FROM hechos_climaticos) AND {name} <> 'BRILLO SOLAR' ORDER BY 1"""
D7_USED = with_star(_USED.format(name="parametro", dim="parametro", key="id_parametro"))
D8_USED = with_star(_USED.format(name="periodo", dim="periodo", key="id_periodo"))

# two thirds of 99 or 100 rows with the smallest keys match however they are written; NULL never does
_SUPPORT = """named AS (SELECT id_fila, CASE WHEN row_number() OVER (ORDER BY id_fila) <= {n}
  THEN CASE WHEN id_fila % 2 = 0 THEN 'Precipitación total' ELSE 'PRECIPITACION MEDIA' END
  ELSE CASE WHEN id_fila % 3 = 0 THEN NULL ELSE 'EVAPORACIÓN' END END AS PARAMETRO FROM normales)"""
_TEXTS = {"ENE": "CASE WHEN id_fila % 11 = 0 THEN NULL ELSE ENE END", "FEB": "CASE WHEN id_fila % 13 = 0 THEN NULL ELSE FEB END",
          "MAR": "CASE WHEN id_fila % 7 = 1 THEN NULL ELSE MAR END", "ABR": "CASE WHEN id_fila % 5 = 0 THEN NULL WHEN id_fila % 5 = 1 THEN -25.0 ELSE ABR END"}
# the means are zero, so all squares are those of the values: a feature's are n - 1, or nothing if it does not vary
_SQUARES = " + ".join(f"CASE WHEN MIN({c}) = MAX({c}) THEN 0 ELSE COUNT(*) - 1 END" for c in FEATURES)
_VARYING = " + ".join(f"CASE WHEN MIN({c}) = MAX({c}) THEN 0 ELSE 1 END" for c in FEATURES)


def _c(n: str) -> str:
    """Mean path length of an unsuccessful search among n rows, n > 2; Euler's constant is a fixed value."""
    return f"(2 * (ln({n} - 1) + 0.57721566490153286) - 2 * ({n} - 1.0) / {n})"


ORACLES = {
    "a2_csv": osql.B_CLEAN,
    "a3_labels_round_trip": with_wide("SELECT id_fila, CAST(id_fila % 3 AS INT) AS cluster_kmeans, id_fila % 20 = 0 AS is_anomaly_if, ANUAL / 8 AS PC1 FROM clean"),
    "a4_bundle_round_trip": _counts({"indicadores": osql.E1, "zonas": osql.E2, "cluster_stats": osql.K4}),
    "b1_clean_columns": with_wide("SELECT * FROM normales"),
    "b2_support_99": with_wide("SELECT id_fila, PARAMETRO FROM named", extra=_SUPPORT.format(n=99)),
    "b2_support_100": with_wide("SELECT id_fila, PARAMETRO FROM named WHERE contains(lower(PARAMETRO), 'precip')", extra=_SUPPORT.format(n=100)),
    "b3_coerce_numeric": with_wide("SELECT id_fila, " + ", ".join(f"{_TEXTS.get(c, c)} AS {c}" for c in FEATURES) + " FROM normales"),
    "b6_row_keys": with_wide("SELECT COUNT(*) AS n, COUNT(*) AS n_keys, 0::BIGINT AS lo, COUNT(*) - 1 AS hi FROM normales"),
    "d9_bundle_rows": _counts(_D),
    "j2_label_counts": with_wide(f"SELECT CASE WHEN id_fila % 5 <> 0 THEN CAST(id_fila % 3 AS INT) END AS lab, COUNT(*) AS n, {R('SUM(ANUAL)', 2)} AS anual FROM clean GROUP BY 1"),
    "f1_assembled_rows": with_wide("SELECT id_fila FROM normales WHERE id_fila % 4 <> 0 AND " + " AND ".join(f"{c} IS NOT NULL" for c in FEATURES)),
    "f4_total_variance": f"SELECT {len(FEATURES)}::BIGINT AS components, 1.0::DOUBLE AS total, 100.0::DOUBLE AS last_pct, 80.0::DOUBLE AS line",
    "f5_projected_norms": with_wide(f"SELECT COUNT(*) AS n, ({_VARYING})::DOUBLE AS mean_square, 0.0::DOUBLE AS mean_1, 0.0::DOUBLE AS covar_12 FROM clean"),
    "f6_unit_loadings": f"SELECT 'PC' || i AS PC, {len(FEATURES)}::BIGINT AS n, 1.0::DOUBLE AS length FROM range(1, 4) t(i)",
    "k1_sums_of_squares": with_wide(f"SELECT CAST(k AS INT) AS k, ({_SQUARES})::DOUBLE AS total FROM clean, range(2, 9) t(k) GROUP BY k"),
    "k3_nearest_centres": with_wide("SELECT COUNT(*) AS n, 0::BIGINT AS astray FROM clean"),
    "k11_label_sizes": with_wide("SELECT 3::BIGINT AS clusters, COUNT(*) AS n, true AS agree FROM clean"),
    "k12_ward_rounds": osql.K12_TOTALS,
    "n1_sample_sizes": with_wide("SELECT CAST(t AS INT) AS tree, least(COUNT(*), 256) AS n, least(COUNT(*), 256) AS n_keys FROM clean, range(100) r(t) GROUP BY t"),
    "n1_fixed_tree": with_wide(f"""SELECT id_fila, {R(f"-pow(2, -(CASE WHEN ALTITUD_m > 2000 THEN 1 WHEN ANUAL <= 500 THEN 2 + {_c('3')} ELSE 2 + {_c('40')} END) / {_c('44')})", 6)} AS anomaly_score_if FROM clean"""),
    "r1_prediction_counts": with_wide("SELECT CAST(id_fila % 3 AS INT) AS y, COUNT(*) AS n, COUNT(*) AS known FROM clean GROUP BY 1"),
    "r3_fold_rows": osql.r2_fold_sizes(3),
    "r6_total_importance": f"SELECT {len(FEATURES)}::BIGINT AS features, 1.0::DOUBLE AS total",
    "v3_scatter_counts": with_wide("SELECT CAST(id_fila % 3 AS INT) AS lab, COUNT(*) AS n, COUNT(*) AS n_pc1 FROM clean GROUP BY 1"),
    "k10_dbscan_counts": f"""SELECT CASE WHEN cluster_dbscan = -1 THEN 'Ruido (-1)' ELSE 'Cluster ' || cluster_dbscan END AS etiqueta, cluster_dbscan, COUNT(*) AS registros
FROM ({osql.K9}) t GROUP BY ALL""",
}
