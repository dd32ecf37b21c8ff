"""SQL counterparts of the queries, for DuckDB over the same tables."""

from __future__ import annotations


def _with(*parts: str, then: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + then


def _place(key: str) -> str:
    return (
        f"CAST(7.2 AS DOUBLE) + CAST({key} * 37 % 1130 AS DOUBLE) / CAST(100 AS DOUBLE) AS latitude, "
        f"CAST(-92.2 AS DOUBLE) + CAST({key} * 53 % 1520 AS DOUBLE) / CAST(100 AS DOUBLE) AS longitude"
    )


MAIN = ("sw_dwn", "dni", "ws_50m", "ws_100m")
MEANS = tuple(f"{v}_mean" for v in MAIN)
RANGES = {"sw_dwn": 400, "dni": 900, "ws_50m": 30, "ws_100m": 30}


def _r(column: str) -> str:
    # The shift is explained in queries.rounded.
    return f"round({column} + 3.3e-9, 6) AS {column}"


def _each(names, template: str) -> str:
    return ", ".join(template.format(v=v) for v in names)


ROUNDED_MAIN = _each(MAIN, "round({v} + 3.3e-9, 6) AS {v}")
ROUNDED_MEANS = _each(MEANS, "round({v} + 3.3e-9, 6) AS {v}")
ROUNDED_PLACE = "round(latitude + 3.3e-9, 6) AS latitude, round(longitude + 3.3e-9, 6) AS longitude"

OBS = """obs AS (
  SELECT l_suppkey AS point_id, CAST(l_shipdate AS DATE) AS date,
    l_extendedprice / CAST(250 AS DOUBLE) AS sw_dwn, l_extendedprice / CAST(110 AS DOUBLE) AS dni,
    l_quantity * CAST(0.65 AS DOUBLE) AS ws_50m,
    CASE WHEN l_linenumber = 7 THEN CAST(-999 AS DOUBLE)
         ELSE l_quantity * CAST(0.55 AS DOUBLE) + l_tax * CAST(100 AS DOUBLE) END AS ws_100m
  FROM lineitem)"""
POINTS = f"""points AS (
  SELECT s_suppkey AS point_id, {_place('s_suppkey')}, n_name AS country
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
MORE_POINTS = f"""more_points AS (
  SELECT * FROM points UNION ALL
  SELECT CAST(n_nationkey + 1000000 AS BIGINT), {_place('n_nationkey')}, n_name FROM nation)"""
NULLED = "nulled AS (SELECT point_id, date, " + ", ".join(
    f"CASE WHEN {v} BETWEEN 0 AND {hi} THEN {v} END AS {v}" for v, hi in RANGES.items()
) + " FROM obs)"
CLEAN = "clean AS (SELECT DISTINCT * FROM nulled WHERE " + " OR ".join(f"{v} IS NOT NULL" for v in MAIN) + ")"
# Duplicates are dropped, empty rows kept: points that only have such rows stay known.
MEANS_CTE = (
    "means AS (SELECT point_id, "
    + _each(MAIN, "avg({v}) AS {v}_mean")
    + ", 1 AS seen FROM (SELECT DISTINCT * FROM nulled) GROUP BY point_id)"
)


def _indicator_means(points: str, missing: str) -> str:
    return (
        f"table_means AS (SELECT p.point_id, latitude, longitude, country, "
        + _each(MEANS, f"CASE WHEN seen = 1 THEN {{v}} ELSE {missing} END AS {{v}}")
        + f" FROM {points} p LEFT JOIN means m ON p.point_id = m.point_id)"
    )


def _scored(ws: float = 0.5, ww: float = 0.3, wh: float = 0.2) -> str:
    def minmax(v: str) -> str:
        return (
            f"CASE WHEN hi_{v} > lo_{v} THEN ({v} - lo_{v}) / (hi_{v} - lo_{v}) ELSE CAST(0.5 AS DOUBLE) END"
        )

    return f"""bounds AS (
  SELECT min(sw_dwn_mean) AS lo_sw_dwn_mean, max(sw_dwn_mean) AS hi_sw_dwn_mean,
    min(ws_100m_mean) AS lo_ws_100m_mean, max(ws_100m_mean) AS hi_ws_100m_mean FROM table_means),
single AS (
  SELECT t.*, {minmax('sw_dwn_mean')} AS solar_score, {minmax('ws_100m_mean')} AS wind_score
  FROM table_means t CROSS JOIN bounds),
scored AS (
  SELECT *, CAST({ws} AS DOUBLE) * solar_score + CAST({ww} AS DOUBLE) * wind_score
    + CAST({wh} AS DOUBLE) * (solar_score * wind_score) AS hybrid_score FROM single)"""


BASE = (OBS, POINTS, NULLED, MEANS_CTE)
INDICATORS = (*BASE, _indicator_means("points", "CAST(0 AS DOUBLE)"), _scored())
LABELLED = (*INDICATORS, "labelled AS (SELECT *, point_id % 4 AS cluster_id FROM scored)")
ROUNDED_INDICATORS = (
    f"point_id, {ROUNDED_PLACE}, country, {ROUNDED_MEANS}, {_r('solar_score')}, {_r('wind_score')}, {_r('hybrid_score')}"
)

GAPPY = (OBS, POINTS, MORE_POINTS, NULLED, MEANS_CTE, _indicator_means("more_points", "NULL"))
IMPUTED = (
    *GAPPY,
    "imputed AS (SELECT point_id, "
    + _each(MEANS, "coalesce({v}, (SELECT median({v}) FROM table_means)) AS {v}")
    + " FROM table_means)",
)
GROUPS = (
    POINTS,
    MORE_POINTS,
    "imputed AS (SELECT point_id, " + ", ".join(
        f"point_id % 3 * {gap} + point_id * 7 % 11 / CAST(10 AS DOUBLE) AS {v}" for v, gap in zip(MEANS, (100, 50, 20, 40))
    ) + " FROM more_points)",
)
MOMENTS = (
    "spread AS (SELECT "
    + _each(MEANS, "avg({v}) AS m_{v}, stddev_pop({v}) AS s_{v}")
    + " FROM imputed)",
    "scaled AS (SELECT point_id, "
    + _each(MEANS, "CASE WHEN s_{v} > 0 THEN ({v} - m_{v}) / s_{v} ELSE CAST(0 AS DOUBLE) END AS {v}")
    + " FROM imputed CROSS JOIN spread)",
)
SCALED = (*IMPUTED, *MOMENTS)


def _gap(a: str, b: str, names=MEANS) -> str:
    return "sqrt(" + " + ".join(f"({a}.{v} - {b}.{v}) * ({a}.{v} - {b}.{v})" for v in names) + ")"


def _squares(a: str, b: str) -> str:
    return " + ".join(f"({a}.{v} - {b}.{v}) * ({a}.{v} - {b}.{v})" for v in MEANS)


def _rounds(k: int, rounds: int) -> list[str]:
    """Assignments and means in turn, from the k points with the smallest ids as centers c{k}_0."""
    parts = [f"c{k}_0 AS (SELECT row_number() OVER (ORDER BY point_id) AS j, {', '.join(MEANS)} FROM scaled ORDER BY point_id LIMIT {k})"]
    for r in range(rounds + 1):
        place = f"row_number() OVER (PARTITION BY s.point_id ORDER BY {_squares('s', 'c')}, c.j)"
        parts.append(f"a{k}_{r} AS (SELECT * FROM (SELECT s.*, c.j, {_squares('s', 'c')} AS d, {place} AS place FROM scaled s CROSS JOIN c{k}_{r} c) WHERE place = 1)")
        moved = _each(MEANS, "coalesce(avg(a.{v}), any_value(c.{v})) AS {v}")
        parts.append(f"c{k}_{r + 1} AS (SELECT c.j, {moved} FROM c{k}_{r} c LEFT JOIN a{k}_{r} a ON a.j = c.j GROUP BY c.j)")
    return parts


NEAREST = (
    *SCALED,
    "centers AS (SELECT point_id % 4 AS cluster_id, " + _each(MEANS, "avg({v}) AS {v}") + " FROM scaled GROUP BY 1)",
    "gaps AS (SELECT s.point_id, c.cluster_id, "
    + " + ".join(f"(s.{v} - c.{v}) * (s.{v} - c.{v})" for v in MEANS)
    + " AS distance2 FROM scaled s CROSS JOIN centers c)",
    "nearest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY distance2, cluster_id) AS r"
    " FROM gaps) WHERE r = 1)",
)

LABELS = (
    *SCALED,
    "ks AS (SELECT CAST(i AS BIGINT) AS k FROM range(2, 7) t(i))",
    "labels AS (SELECT k, point_id, point_id % k AS label FROM scaled CROSS JOIN ks)",
)
SILHOUETTE = (
    f"pairs AS (SELECT a.point_id AS i, b.point_id AS j, {_gap('a', 'b')} AS d FROM scaled a CROSS JOIN scaled b)",
    "sums AS (SELECT x.k, i, x.label AS own, y.label AS label, sum(d) AS s, count(*) AS n"
    " FROM pairs JOIN labels x ON x.point_id = i JOIN labels y ON y.point_id = j AND y.k = x.k"
    " GROUP BY x.k, i, x.label, y.label)",
    "sides AS (SELECT k, i, max(CASE WHEN own = label AND n > 1 THEN s / (n - 1) END) AS a,"
    " min(CASE WHEN own <> label THEN s / n END) AS b FROM sums GROUP BY k, i)",
    "silhouettes AS (SELECT k, avg(CASE WHEN b IS NULL THEN NULL WHEN a IS NULL OR greatest(a, b) = 0 THEN 0"
    " ELSE (b - a) / greatest(a, b) END) AS silhouette FROM sides GROUP BY k)",
)
DAVIES_BOULDIN = (
    "label_means AS (SELECT k, label, " + _each(MEANS, "avg({v}) AS {v}")
    + " FROM labels JOIN scaled USING (point_id) GROUP BY k, label)",
    f"spreads AS (SELECT m.k, m.label, avg({_gap('s', 'm')}) AS s FROM labels l JOIN scaled s ON s.point_id = l.point_id"
    " JOIN label_means m ON m.k = l.k AND m.label = l.label GROUP BY m.k, m.label)",
    f"apart AS (SELECT x.k, x.label, max(CASE WHEN x.label = y.label OR {_gap('x', 'y')} = 0 THEN 0"
    f" ELSE (p.s + q.s) / {_gap('x', 'y')} END) AS r FROM label_means x JOIN label_means y ON x.k = y.k"
    " JOIN spreads p ON p.k = x.k AND p.label = x.label JOIN spreads q ON q.k = y.k AND q.label = y.label"
    " GROUP BY x.k, x.label)",
    "db AS (SELECT k, avg(r) AS davies_bouldin FROM apart GROUP BY k)",
)
BEST = (
    *LABELS,
    *SILHOUETTE,
    *DAVIES_BOULDIN,
    "best AS (SELECT silhouettes.k AS recommended_k, silhouette, davies_bouldin FROM silhouettes JOIN db"
    " ON silhouettes.k = db.k ORDER BY silhouette DESC, silhouettes.k LIMIT 1)",
)
RAND = (
    "run_labels AS (SELECT point_id, point_id % 4 AS run_0,"
    " (point_id + CASE WHEN point_id % 10 = 0 THEN 1 ELSE 0 END) % 4 AS run_1,"
    " CAST(floor(point_id / CAST(3 AS DOUBLE)) AS BIGINT) % 4 AS run_2 FROM more_points)",
    "run_pairs AS (SELECT 'run_0' AS run_a, 'run_1' AS run_b, run_0 AS la, run_1 AS lb FROM run_labels UNION ALL"
    " SELECT 'run_0', 'run_2', run_0, run_2 FROM run_labels UNION ALL SELECT 'run_1', 'run_2', run_1, run_2 FROM run_labels)",
    "cells AS (SELECT run_a, run_b, la, lb, CAST(count(*) AS DOUBLE) AS n FROM run_pairs GROUP BY 1, 2, 3, 4)",
    "i_sum AS (SELECT run_a, run_b, sum(n * (n - 1) / 2) AS i, sum(n) AS n FROM cells GROUP BY 1, 2)",
    "a_sum AS (SELECT run_a, run_b, sum(n * (n - 1) / 2) AS a FROM (SELECT run_a, run_b, la, sum(n) AS n FROM cells"
    " GROUP BY 1, 2, 3) GROUP BY 1, 2)",
    "b_sum AS (SELECT run_a, run_b, sum(n * (n - 1) / 2) AS b FROM (SELECT run_a, run_b, lb, sum(n) AS n FROM cells"
    " GROUP BY 1, 2, 3) GROUP BY 1, 2)",
    "rand AS (SELECT run_a, run_b, (i - a * b / (n * (n - 1) / 2)) / ((a + b) / 2 - a * b / (n * (n - 1) / 2)) AS ari"
    " FROM i_sum JOIN a_sum USING (run_a, run_b) JOIN b_sum USING (run_a, run_b))",
)
GATES = (
    *BEST,
    *RAND,
    "gates AS (SELECT best.*, ari_mean, ari_std, silhouette >= 0.5 AS passes_silhouette,"
    " davies_bouldin < 2.0 AS passes_davies_bouldin, ari_mean >= 0.95 AS passes_stability FROM best CROSS JOIN"
    " (SELECT avg(ari) AS ari_mean, stddev_pop(ari) AS ari_std FROM rand))",
)

# Profiles of the fixed clusters within each region.
REGIONS = (
    *LABELLED,
    "regional AS (SELECT labelled.*, n_regionkey AS region FROM labelled JOIN nation ON n_name = country)",
    "profiles AS (SELECT region, cluster_id, count(*) AS size, " + _each(MEANS, "avg({v}) AS {v}")
    + " FROM regional GROUP BY region, cluster_id)",
)


def _z(v: str) -> str:
    over = "OVER (PARTITION BY region)"
    return (
        f"CASE WHEN stddev_pop({v}) {over} > 1e-9 THEN ({v} - avg({v}) {over}) / stddev_pop({v}) {over}"
        f" ELSE CAST(0 AS DOUBLE) END AS {v}_z"
    )


READ = (
    *REGIONS,
    "zs AS (SELECT *, " + ", ".join(_z(v) for v in MEANS) + " FROM profiles)",
    "indices AS (SELECT *, (sw_dwn_mean_z + dni_mean_z) / 2 AS solar_index,"
    " (ws_50m_mean_z + ws_100m_mean_z) / 2 AS wind_index FROM zs)",
    "ranked AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY region) <= 1 THEN CAST(0.5 AS DOUBLE) ELSE"
    " CAST(row_number() OVER (PARTITION BY region ORDER BY solar_index, cluster_id) - 1 AS DOUBLE)"
    " / nullif(count(*) OVER (PARTITION BY region) - 1, 0) END AS solar_percentile,"
    " CASE WHEN count(*) OVER (PARTITION BY region) <= 1 THEN CAST(0.5 AS DOUBLE) ELSE"
    " CAST(row_number() OVER (PARTITION BY region ORDER BY wind_index, cluster_id) - 1 AS DOUBLE)"
    " / nullif(count(*) OVER (PARTITION BY region) - 1, 0) END AS wind_percentile FROM indices)",
    "told AS (SELECT *, CASE WHEN solar_percentile >= 0.5 AND wind_percentile >= 0.5 THEN 'Hybrid-high'"
    " WHEN solar_percentile >= 0.5 THEN 'Solar-dominant' WHEN wind_percentile >= 0.5 THEN 'Wind-dominant'"
    " ELSE 'Lower-resource' END AS label, least(CAST(1 AS DOUBLE), (abs(solar_percentile - CAST(0.5 AS DOUBLE)) * 2"
    " + abs(wind_percentile - CAST(0.5 AS DOUBLE)) * 2) / 2) AS confidence FROM ranked)",
)
ENTRIES = (
    *REGIONS,
    "entries AS (SELECT region, cluster_id, country, count(*) AS count, avg(solar_score) AS avg_solar_score,"
    " avg(wind_score) AS avg_wind_score, avg(hybrid_score) AS avg_hybrid_score FROM regional GROUP BY 1, 2, 3)",
    "placed AS (SELECT e.*, p.size, CAST(e.count AS DOUBLE) / p.size AS percentage,"
    " row_number() OVER (PARTITION BY e.region, e.cluster_id ORDER BY e.count DESC, e.country) AS place"
    " FROM entries e JOIN profiles p ON p.region = e.region AND p.cluster_id = e.cluster_id)",
)

DESCRIPTION = (
    "CASE label"
    " WHEN 'Hybrid-high' THEN 'Potencial hibrido: solar y eolico ambos por encima de la mediana'"
    " WHEN 'Solar-dominant' THEN 'Potencial predominantemente solar'"
    " WHEN 'Wind-dominant' THEN 'Potencial predominantemente eolico'"
    " ELSE 'Potencial bajo relativo a los demas clusters' END || ' (' || CAST(t.size AS VARCHAR) ||"
    " ' puntos). Percentil solar: ' || CAST(CAST(round_even(solar_percentile * 100, 0) AS BIGINT) AS VARCHAR) ||"
    " '%, percentil eolico: ' || CAST(CAST(round_even(wind_percentile * 100, 0) AS BIGINT) AS VARCHAR) ||"
    " '% respecto a los demas clusters de esta corrida.' || ' Pais dominante: ' || country || ' (' ||"
    " CAST(CAST(round_even(percentage * 100, 0) AS BIGINT) AS VARCHAR) || '% de los puntos de este cluster).'"
)
# Profiles of a split at the mean of one feature: the centers lie one deviation to its sides.
HALVES = (
    *INDICATORS,
    *IMPUTED[-1:],
    *MOMENTS,
    "regional AS (SELECT *, 0 AS region, CAST(CASE WHEN sw_dwn_mean > m_sw_dwn_mean THEN 1 ELSE 0 END AS BIGINT) AS cluster_id"
    " FROM scored CROSS JOIN spread)",
    "profiles AS (SELECT region, cluster_id, count(*) AS size, any_value(m_sw_dwn_mean + (2 * cluster_id - 1) * s_sw_dwn_mean)"
    " AS sw_dwn_mean, " + ", ".join(f"any_value(m_{v}) AS {v}" for v in MEANS[1:]) + " FROM regional GROUP BY region, cluster_id)",
)

RUNS = """runs AS (
  SELECT o_orderpriority AS experiment, o_orderkey AS run_seq,
    CASE o_custkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 ELSE 8 END AS worker_count,
    CAST(o_orderkey % 3 + 1 AS INTEGER) AS repeat,
    CASE WHEN o_orderkey % 97 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice / CAST(1000 AS DOUBLE) END AS seconds,
    CAST(o_custkey % 500 AS DOUBLE) * CAST(0.5 AS DOUBLE) - CAST(10 AS DOUBLE) AS memory_mb,
    o_custkey % 300 AS point_count,
    CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'success' END AS status,
    CASE WHEN o_orderstatus = 'P' THEN 'order ' || CAST(o_orderkey AS VARCHAR) END AS error,
    sha256(CAST(o_custkey % 3 AS VARCHAR)) AS checksum
  FROM orders)"""
SPEEDUP = (
    RUNS,
    "based AS (SELECT *, last_value(CASE WHEN worker_count = 1 THEN seconds END IGNORE NULLS) OVER (PARTITION BY"
    " experiment ORDER BY run_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS baseline_seconds FROM runs)",
    "sped AS (SELECT *, CASE WHEN baseline_seconds IS NULL THEN NULL WHEN seconds = 0 THEN CAST(0 AS DOUBLE)"
    " ELSE baseline_seconds / nullif(seconds, 0) END AS speedup FROM based)",
)

PAYLOAD_ROWS = (
    OBS,
    "daily AS (SELECT point_id, date, " + _each(MAIN, "max({v}) AS {v}") + " FROM obs GROUP BY point_id, date)",
)
PAYLOAD_SQL = _with(
    *PAYLOAD_ROWS,
    then="SELECT point_id, date, round(sw_dwn + 3.3e-9, 6) AS sw_dwn, round(dni + 3.3e-9, 6) AS dni,"
    " round(CASE WHEN point_id % 3 <> 0 OR day(date) % 2 = 0 THEN ws_50m END + 3.3e-9, 6) AS ws_50m,"
    " round(nullif(ws_100m, -999) + 3.3e-9, 6) AS ws_100m FROM daily",
)

# What the damage by point and year leaves of each payload.
PAYLOAD_STATUS = (
    *PAYLOAD_ROWS,
    "documents_ AS (SELECT point_id, CAST(year(date) AS INTEGER) AS year, (point_id + year(date)) % 8 AS kind, count(*) AS days,"
    " count(*) FILTER (WHERE month(date) = 2) AS bad FROM daily GROUP BY 1, 2, 3)",
    "status AS (SELECT point_id, year, CAST(CASE WHEN kind BETWEEN 1 AND 4 THEN 0 ELSE days END AS INTEGER) AS n_dates,"
    " CAST(CASE WHEN kind = 5 THEN bad ELSE 0 END AS INTEGER) AS n_bad_dates, CASE WHEN kind = 1 THEN 'unreadable' WHEN kind = 2 THEN 'empty'"
    " WHEN kind = 3 THEN 'no parameters' WHEN kind = 4 THEN 'no dates' WHEN kind = 5 AND bad = days THEN 'no valid date'"
    " WHEN kind = 5 AND bad > 0 THEN 'some invalid dates' END AS reason FROM documents_)",
)

BOXES = (
    f"homes AS (SELECT {_place('c_custkey')}, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey)",
    "boxes AS (SELECT country, row_number() OVER (ORDER BY country) - 1 AS country_ix, min(latitude) AS lat_lo,"
    " max(latitude) AS lat_hi, min(longitude) AS lon_lo, max(longitude) AS lon_hi FROM homes GROUP BY country)",
    "steps AS (SELECT CAST(floor(sqrt(count(*))) AS BIGINT) + 1 AS n, count(*) AS size FROM supplier)",
    "axis AS (SELECT i FROM (SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS i FROM supplier) CROSS JOIN steps"
    " WHERE i < n)",
    "grid AS (SELECT CAST((country_ix * n + y.i) * n + x.i AS BIGINT) AS point_id,"
    " CASE WHEN n = 1 THEN lat_lo WHEN y.i = n - 1 THEN lat_hi"
    " ELSE y.i * ((lat_hi - lat_lo) / nullif(n - 1, 0)) + lat_lo END AS latitude,"
    " CASE WHEN n = 1 THEN lon_lo WHEN x.i = n - 1 THEN lon_hi"
    " ELSE x.i * ((lon_hi - lon_lo) / nullif(n - 1, 0)) + lon_lo END AS longitude, country"
    " FROM boxes CROSS JOIN steps CROSS JOIN axis y CROSS JOIN axis x)",
)
SAMPLE = (
    *BOXES,
    "chosen AS (SELECT i, CASE WHEN i = size - 1 THEN total - 1 ELSE"
    " CAST(floor(i * (CAST(total - 1 AS DOUBLE) / nullif(size - 1, 0))) AS BIGINT) END AS old_id FROM"
    " (SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS i FROM supplier) CROSS JOIN steps"
    " CROSS JOIN (SELECT count(*) AS total FROM grid))",
    "sample AS (SELECT CAST(i AS BIGINT) AS point_id, latitude, longitude, country FROM chosen JOIN grid"
    " ON grid.point_id = old_id)",
)

_COUNTED = (
    "count(*) AS total_rows, count(*) FILTER (WHERE sw_dwn IS NOT NULL AND dni IS NOT NULL AND ws_50m IS NOT NULL"
    " AND ws_100m IS NOT NULL) AS complete_rows"
)
_OK = {v: hi for v, hi in {**RANGES, "ws_50m": 25}.items()}
_FILLED = "filled AS (SELECT point_id, date, sw_dwn, dni, ws_50m, nullif(ws_100m, -999) AS ws_100m FROM obs)"

ORACLES: dict[str, str] = {
    "ingest_payloads": PAYLOAD_SQL,
    "ingest_lines": PAYLOAD_SQL,
    "clean_stored_table": _with(OBS, NULLED, CLEAN, then=f"SELECT point_id, date, {ROUNDED_MAIN} FROM clean"),
    "longest_bright_run": _with(
        OBS, NULLED, CLEAN,
        "marked AS (SELECT point_id, sw_dwn > 200 AS bright, row_number() OVER w AS place, count(*) FILTER (WHERE"
        " coalesce(sw_dwn <= 200, true)) OVER w AS breaks FROM clean WINDOW w AS (PARTITION BY point_id ORDER BY date,"
        " sw_dwn NULLS FIRST))",
        "lengths AS (SELECT point_id, breaks, count(*) FILTER (WHERE bright) AS n FROM marked GROUP BY 1, 2)",
        then="SELECT point_id, CAST(max(n) AS BIGINT) AS longest FROM lengths GROUP BY 1",
    ),
    "sweep_fixed_starts": _with(
        *SCALED, *[part for k in (2, 3, 5) for part in _rounds(k, 3)],
        then=" UNION ALL ".join(
            f"SELECT CAST({k} AS INTEGER) AS k, CAST(row_number() OVER (ORDER BY {', '.join(MEANS)}) - 1 AS INTEGER) AS cluster_id, {ROUNDED_MEANS},"
            f" round((SELECT sum(d) FROM a{k}_3) + 3.3e-9, 6) AS inertia FROM c{k}_3"
            for k in (2, 3, 5)
        ),
    ),
    "kmeans_labels": _with(POINTS, MORE_POINTS, then="SELECT point_id, point_id % 3 AS cluster_id FROM more_points"),
    "kmeans_stability": "SELECT CAST(1 AS DOUBLE) AS ari_mean, CAST(0 AS DOUBLE) AS ari_std",
    "quality_by_k": _with(
        *GROUPS, *MOMENTS, "labels AS (SELECT 3 AS k, point_id, point_id % 3 AS label FROM scaled)",
        *SILHOUETTE, *DAVIES_BOULDIN,
        "centers AS (SELECT label, " + _each(MEANS, "avg({v}) AS {v}") + " FROM scaled JOIN labels USING (point_id) GROUP BY 1)",
        "squares AS (SELECT sum(" + " + ".join(f"(s.{v} - c.{v}) * (s.{v} - c.{v})" for v in MEANS)
        + ") AS inertia FROM scaled s JOIN labels USING (point_id) JOIN centers c ON c.label = labels.label)",
        then="SELECT c.k, c.k AS n_labels, CASE WHEN c.k = 3 THEN round(inertia + 3.3e-9, 6) END AS inertia, CASE WHEN c.k = 3"
        " THEN round(silhouette + 3.3e-9, 6) END AS silhouette, CASE WHEN c.k = 3 THEN round(davies_bouldin + 3.3e-9, 6) END"
        " AS davies_bouldin, true AS inertia_falls FROM (SELECT CAST(unnest([2, 3, 4]) AS INTEGER) AS k) c"
        " CROSS JOIN squares CROSS JOIN silhouettes CROSS JOIN db",
    ),
    "run_all": _with(
        *HALVES,
        *READ[len(REGIONS):],
        *ENTRIES[len(REGIONS):],
        then=f"SELECT t.cluster_id, t.size, label, {DESCRIPTION} AS description, {_r('confidence')}, {_r('solar_percentile')},"
        f" {_r('wind_percentile')}, {ROUNDED_MEANS} FROM told t JOIN placed p ON p.cluster_id = t.cluster_id WHERE place = 1",
    ),
    "stored_model": _with(
        *SCALED, "daily AS (SELECT point_id, date, max(sw_dwn) AS sw_dwn FROM obs GROUP BY 1, 2)",
        then="SELECT point_id, date, CAST(CASE WHEN sw_dwn > m_sw_dwn_mean THEN 1 ELSE 0 END AS BIGINT) AS cluster_id"
        " FROM daily CROSS JOIN spread",
    ),
    "parse_payload": PAYLOAD_SQL,
    "payload_problems": _with(*PAYLOAD_STATUS, then="SELECT * FROM status WHERE reason IS NOT NULL"),
    "readable_payloads": _with(
        *PAYLOAD_STATUS,
        then="SELECT point_id, '' AS reason, CAST(sum(n_dates - n_bad_dates) AS BIGINT) AS n FROM status WHERE point_id % 5 <> 0"
        " GROUP BY 1 HAVING sum(n_dates - n_bad_dates) > 0 UNION ALL SELECT -1, reason, count(*) FROM (SELECT CASE WHEN"
        " point_id % 5 = 0 THEN 'no point' ELSE reason END AS reason FROM status) WHERE reason IS NOT NULL GROUP BY 2",
    ),
    "fill_to_null": _with(OBS, _FILLED, then=f"SELECT point_id, date, {ROUNDED_MAIN} FROM filled"),
    "parse_date_key": """
WITH days AS (SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y%m%d') AS day FROM lineitem),
keys AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 4 THEN substr(day, 1, 7) WHEN 5 THEN day || '10'
  WHEN 6 THEN substr(day, 1, 4) || '13' || substr(day, 7, 2) ELSE day END AS date_key FROM days),
dated AS (SELECT *, TRY_CAST(substr(date_key, 1, 4) || '-' || substr(date_key, 5, 2) || '-' || substr(date_key, 7, 2)
  AS DATE) AS date FROM keys)
SELECT * FROM dated WHERE date IS NOT NULL""",
    "points_without_data": _with(
        OBS, POINTS, MORE_POINTS,
        then=f"SELECT p.point_id, {ROUNDED_PLACE}, country, coalesce(n, 0) AS n_observations FROM more_points p"
        " LEFT JOIN (SELECT point_id, count(*) AS n FROM obs GROUP BY 1) o ON o.point_id = p.point_id",
    ),
    "raw_observations": _with(
        OBS, POINTS,
        then=f"SELECT point_id, {ROUNDED_PLACE}, country, date, {ROUNDED_MAIN} FROM obs JOIN points USING (point_id)",
    ),
    "parquet_roundtrip": _with(OBS, then=f"SELECT point_id, date, {ROUNDED_MAIN} FROM obs"),
    "appended_table": _with(OBS, then=f"SELECT point_id, date, {ROUNDED_MAIN} FROM obs"),
    "dataset_metadata": "SELECT 'point_id,date,sw_dwn,dni,ws_50m,ws_100m' AS columns, count(*) AS num_rows,"
    " count(*) > 0 AS has_size FROM lineitem",
    "labelled_csv": _with(*LABELLED, then=f"SELECT {ROUNDED_INDICATORS}, cluster_id FROM labelled"),
    "labelled_parquet": _with(*LABELLED, then=f"SELECT {ROUNDED_INDICATORS}, cluster_id FROM labelled"),
    "labelled_indicators": _with(*LABELLED, then=f"SELECT {ROUNDED_INDICATORS}, cluster_id FROM labelled"),
    "cluster_profiles": _with(
        *LABELLED,
        then="SELECT cluster_id, 'Cluster ' || CAST(cluster_id AS VARCHAR) AS label, 'Cluster ' ||"
        " CAST(cluster_id AS VARCHAR) || ' with ' || CAST(count(*) AS VARCHAR) || ' points' AS description,"
        " count(*) AS size, " + _each(MEANS, "round(avg({v}) + 3.3e-9, 6) AS {v}") + " FROM labelled GROUP BY cluster_id",
    ),
    "profile_json": _with(
        *ENTRIES,
        then="SELECT region, cluster_id, size, CAST(0 AS DOUBLE) AS confidence, CAST(place - 1 AS INTEGER) AS pos,"
        " country, count, round(percentage + 3.3e-9, 6) AS percentage, round(avg_solar_score + 3.3e-9, 6) AS avg_solar_score,"
        " round(avg_wind_score + 3.3e-9, 6) AS avg_wind_score, round(avg_hybrid_score + 3.3e-9, 6) AS avg_hybrid_score FROM placed",
    ),
    "grid_points": _with(*BOXES, then=f"SELECT point_id, {ROUNDED_PLACE}, country FROM grid"),
    "grid_sample": _with(*SAMPLE, then=f"SELECT point_id, {ROUNDED_PLACE}, country FROM sample"),
    "grid_max_points": _with(
        *SAMPLE,
        then=f"SELECT point_id, {ROUNDED_PLACE}, country FROM sample WHERE point_id < (SELECT size // 2 FROM steps)",
    ),
    "invalid_points": f"""
WITH doubtful AS (SELECT c_custkey AS point_id, c_acctbal / CAST(100 AS DOUBLE) AS latitude,
  c_acctbal / CAST(50 AS DOUBLE) - CAST(10 AS DOUBLE) AS longitude,
  substr(c_mktsegment, 1, c_nationkey % 4) AS country FROM customer)
SELECT point_id, {ROUNDED_PLACE}, country FROM doubtful WHERE NOT (latitude BETWEEN -90 AND 90
  AND longitude BETWEEN -180 AND 180 AND length(country) >= 2)""",
    "points_checksum": _with(
        POINTS,
        "runs AS (SELECT point_id // 65536 AS run, count(*) AS n, sha256(string_agg(printf('%.8f,%.8f,%s', latitude,"
        " longitude, country), chr(10) ORDER BY point_id)) AS digest FROM points GROUP BY 1)",
        then="SELECT CAST(sum(n) AS BIGINT) AS n_points, sha256(string_agg(digest, '' ORDER BY run)) AS checksum FROM runs",
    ),
    "range_null": _with(OBS, NULLED, then=f"SELECT point_id, date, {ROUNDED_MAIN} FROM nulled"),
    "in_years": _with(
        OBS, then=f"SELECT point_id, date, {ROUNDED_MAIN} FROM obs WHERE year(date) BETWEEN 1996 AND 1998"
    ),
    "drop_all_null": _with(
        OBS, NULLED,
        then=f"SELECT point_id, date, {ROUNDED_MAIN} FROM nulled WHERE " + " OR ".join(f"{v} IS NOT NULL" for v in MAIN),
    ),
    "dedup_rows": _with(OBS, then=f"SELECT point_id, date, {ROUNDED_MAIN} FROM (SELECT DISTINCT * FROM obs)"),
    "clean_missing_cols": _with(
        OBS, NULLED,
        then="SELECT point_id, date, round(sw_dwn + 3.3e-9, 6) AS sw_dwn, round(dni + 3.3e-9, 6) AS dni FROM (SELECT DISTINCT point_id,"
        " date, sw_dwn, dni FROM nulled WHERE sw_dwn IS NOT NULL OR dni IS NOT NULL)",
    ),
    "ordered_observations": _with(
        OBS, NULLED, CLEAN, then=f"SELECT point_id, date, {ROUNDED_MAIN} FROM clean ORDER BY point_id, date"
    ),
    "clean_observations": _with(OBS, NULLED, CLEAN, then=f"SELECT point_id, date, {ROUNDED_MAIN} FROM clean"),
    "complete_flag": _with(
        OBS, NULLED,
        then=f"SELECT point_id, date, {ROUNDED_MAIN}, " + " AND ".join(f"{v} IS NOT NULL" for v in MAIN)
        + " AS is_complete FROM nulled",
    ),
    "range_flag": _with(
        OBS, _FILLED,
        then=f"SELECT point_id, date, {ROUNDED_MAIN}, "
        + ", ".join(f"{v} BETWEEN 0 AND {hi} AS {v}_ok" for v, hi in _OK.items())
        + ", " + " AND ".join(f"coalesce({v} BETWEEN 0 AND {hi}, true)" for v, hi in _OK.items())
        + " AS plausible FROM filled",
    ),
    "completeness": _with(
        OBS, NULLED, f"counted AS (SELECT {_COUNTED} FROM nulled)",
        then="SELECT *, round(CAST(complete_rows AS DOUBLE) / total_rows + 3.3e-9, 6) AS completeness_ratio,"
        " CAST(complete_rows AS DOUBLE) / total_rows >= 0.5 AS is_valid FROM counted",
    ),
    "completeness_missing": _with(
        OBS,
        then="SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS complete_rows, CAST(0 AS DOUBLE) AS completeness_ratio,"
        " false AS is_valid FROM obs",
    ),
    "completeness_by_point": _with(
        OBS, NULLED, f"counted AS (SELECT point_id, {_COUNTED} FROM nulled GROUP BY point_id)",
        then="SELECT *, round(CAST(complete_rows AS DOUBLE) / total_rows + 3.3e-9, 6) AS completeness_ratio,"
        " CAST(complete_rows AS DOUBLE) / total_rows >= 0.7 AS is_valid FROM counted",
    ),
    "result_validation": _with(
        POINTS, MORE_POINTS,
        "checked AS (SELECT count(*) AS n_rows, count(cluster_id) AS n_labels,"
        " count(*) FILTER (WHERE m.point_id IS NULL) AS null_point_id, count(*) FILTER (WHERE latitude IS NULL)"
        " AS null_latitude, count(*) FILTER (WHERE longitude IS NULL) AS null_longitude,"
        " count(*) FILTER (WHERE country IS NULL) AS null_country FROM more_points m LEFT JOIN"
        " (SELECT point_id, point_id % 4 AS cluster_id FROM points) l ON l.point_id = m.point_id)",
        then="SELECT *, n_rows = (SELECT count(*) FROM supplier) AND n_labels = (SELECT count(*) FROM supplier)"
        " AS is_complete, n_rows = (SELECT count(*) FROM supplier) AND n_labels = (SELECT count(*) FROM supplier)"
        " AND null_point_id = 0 AND null_latitude = 0 AND null_longitude = 0 AND null_country = 0 AS is_valid"
        " FROM checked",
    ),
    "invalid_runs": _with(
        RUNS,
        then="SELECT experiment, run_seq, round(memory_mb + 3.3e-9, 6) AS memory_mb FROM runs"
        " WHERE NOT (worker_count >= 1 AND seconds >= 0 AND memory_mb >= 0)",
    ),
    "point_means": _with(
        OBS, NULLED,
        "clean AS (SELECT DISTINCT * FROM nulled WHERE " + " OR ".join(f"{v} IS NOT NULL" for v in MAIN) + ")",
        then="SELECT point_id, round(avg(sw_dwn) + 3.3e-9, 6) AS sw_dwn_mean, CAST(0 AS DOUBLE) AS dni_mean,"
        " round(avg(ws_50m) + 3.3e-9, 6) AS ws_50m_mean, round(avg(ws_100m) + 3.3e-9, 6) AS ws_100m_mean FROM clean GROUP BY point_id",
    ),
    "point_position_scores": _with(
        OBS, NULLED, CLEAN,
        "stats AS (SELECT point_id, " + _each(MAIN, "avg({v}) AS {v}_mean, min({v}) AS lo_{v}, max({v}) AS hi_{v}")
        + " FROM clean GROUP BY point_id)",
        "positions AS (SELECT *, " + ", ".join(
            f"CASE WHEN lo_{v} IS NULL THEN CAST(0 AS DOUBLE) WHEN hi_{v} <= lo_{v} THEN CAST(0.5 AS DOUBLE)"
            f" ELSE ({v}_mean - lo_{v}) / (hi_{v} - lo_{v}) END AS {name}_position"
            for v, name in (("sw_dwn", "solar"), ("ws_100m", "wind"))
        ) + " FROM stats)",
        then=f"SELECT point_id, {ROUNDED_MEANS}, {_r('solar_position')}, {_r('wind_position')},"
        " round(CAST(0.5 AS DOUBLE) * solar_position + CAST(0.3 AS DOUBLE) * wind_position + CAST(0.2 AS DOUBLE)"
        " * (solar_position * wind_position) + 3.3e-9, 6) AS hybrid_position FROM positions",
    ),
    "minmax_scores": _with(
        OBS, POINTS, MORE_POINTS, NULLED, MEANS_CTE, _indicator_means("more_points", "CAST(0 AS DOUBLE)"), _scored(),
        then=f"SELECT point_id, {_r('solar_score')}, {_r('wind_score')} FROM scored",
    ),
    "hybrid_score": _with(
        *BASE, _indicator_means("points", "CAST(0 AS DOUBLE)"), _scored(0.4, 0.4, 0.2),
        then=f"SELECT point_id, {_r('hybrid_score')} FROM scored",
    ),
    "indicators_by_day": _with(
        OBS, POINTS, MORE_POINTS, NULLED, MEANS_CTE, _indicator_means("more_points", "CAST(0 AS DOUBLE)"), _scored(),
        then=f"SELECT {ROUNDED_INDICATORS} FROM scored",
    ),
    "indicators": _with(*INDICATORS, then=f"SELECT {ROUNDED_INDICATORS} FROM scored"),
    "per_point_udf": _with(
        OBS, NULLED, CLEAN,
        then="SELECT point_id, round(avg(sw_dwn) + 3.3e-9, 6) AS sw_dwn_mean, count(sw_dwn) AS n_values FROM clean GROUP BY point_id",
    ),
    "cluster_sizes": "SELECT cluster_id, coalesce(n, 0) AS size FROM (SELECT DISTINCT s_suppkey % 5 AS cluster_id"
    " FROM supplier) c LEFT JOIN (SELECT s_suppkey % 4 AS label, count(*) AS n FROM supplier GROUP BY 1) ON"
    " label = cluster_id",
    "country_breakdown": _with(
        *LABELLED,
        "homed AS (SELECT cluster_id, CASE WHEN point_id % 11 <> 0 THEN country END AS country, solar_score, wind_score,"
        " hybrid_score FROM labelled)",
        "totals AS (SELECT cluster_id, count(*) AS total FROM homed GROUP BY 1)",
        "entries AS (SELECT cluster_id, country, count(*) AS count, " + _each(
            ("solar_score", "wind_score", "hybrid_score"), "round(avg({v}) + 3.3e-9, 6) AS avg_{v}"
        ) + " FROM homed WHERE country IS NOT NULL GROUP BY 1, 2)",
        then="SELECT e.cluster_id, country, count, round(CAST(count AS DOUBLE) / total + 3.3e-9, 6) AS percentage,"
        " avg_solar_score, avg_wind_score, avg_hybrid_score, CAST(row_number() OVER (PARTITION BY e.cluster_id"
        " ORDER BY count DESC, country) AS INTEGER) AS country_rank FROM entries e JOIN totals t"
        " ON t.cluster_id = e.cluster_id",
    ),
    "cluster_summary": _with(
        *LABELLED,
        then="SELECT cluster_id, count(point_id) AS points, round(avg(solar_score) + 3.3e-9, 6) AS solar_mean,"
        " round(avg(wind_score) + 3.3e-9, 6) AS wind_mean, round(avg(hybrid_score) + 3.3e-9, 6) AS hybrid_mean FROM labelled GROUP BY 1",
    ),
    "score_series": _with(
        *LABELLED,
        then="SELECT cluster_id, round(avg(solar_score) + 3.3e-9, 6) AS solar_mean, round(avg(wind_score) + 3.3e-9, 6) AS wind_mean"
        " FROM labelled GROUP BY 1",
    ),
    "feature_columns": _with(
        *INDICATORS,
        then="SELECT point_id, round(sw_dwn_mean + 3.3e-9, 6) AS sw_dwn_mean, round(ws_50m_mean + 3.3e-9, 6) AS ws_50m_mean,"
        " round(ws_100m_mean + 3.3e-9, 6) AS ws_100m_mean FROM scored",
    ),
    "impute_median": _with(*IMPUTED, then=f"SELECT point_id, {ROUNDED_MEANS} FROM imputed"),
    "standardize": _with(*SCALED, then=f"SELECT point_id, {ROUNDED_MEANS} FROM scaled"),
    "kmeans_groups": _with(POINTS, MORE_POINTS, then="SELECT point_id, point_id % 3 AS cluster_id FROM more_points"),
    "sweep_groups": _with(
        *GROUPS, *MOMENTS, "labels AS (SELECT 3 AS k, point_id, point_id % 3 AS label FROM scaled)",
        *SILHOUETTE, *DAVIES_BOULDIN,
        then="SELECT 3 AS recommended_k, round(silhouette + 3.3e-9, 6) AS silhouette, round(davies_bouldin + 3.3e-9, 6)"
        " AS davies_bouldin, 3 AS stability_runs, silhouette >= 0.5 AS passes_silhouette, davies_bouldin < 2.0"
        " AS passes_davies_bouldin, silhouette >= 0.5 AND davies_bouldin < 2.0 AS passes_all"
        " FROM silhouettes CROSS JOIN db",
    ),
    "custom_clustering": _with(
        *INDICATORS,
        then="SELECT point_id, CAST(CASE WHEN sw_dwn_mean > (SELECT avg(sw_dwn_mean) FROM scored) THEN 1 ELSE 0 END"
        " AS BIGINT) AS cluster_id FROM scored",
    ),
    "assign_nearest": _with(*NEAREST, then=f"SELECT point_id, cluster_id, {_r('distance2')} FROM nearest"),
    "nearest_part": _with(
        *INDICATORS,
        "parts AS (SELECT l_partkey AS cluster_id, avg(l_extendedprice / CAST(250 AS DOUBLE)) AS sw_dwn_mean,"
        " avg(l_extendedprice / CAST(110 AS DOUBLE)) AS dni_mean, avg(l_quantity * CAST(0.65 AS DOUBLE)) AS ws_50m_mean,"
        " avg(CASE WHEN l_linenumber = 7 THEN CAST(-999 AS DOUBLE) ELSE l_quantity * CAST(0.55 AS DOUBLE)"
        " + l_tax * CAST(100 AS DOUBLE) END) AS ws_100m_mean FROM lineitem GROUP BY 1)",
        f"gaps AS (SELECT s.point_id, c.cluster_id, {_squares('s', 'c')} AS distance2 FROM scored s CROSS JOIN parts c)",
        then=f"SELECT point_id, cluster_id, {_r('distance2')} FROM (SELECT *, row_number() OVER (PARTITION BY point_id"
        " ORDER BY distance2, cluster_id) AS r FROM gaps) WHERE r = 1",
    ),
    "inertia": _with(*NEAREST, then="SELECT round(sum(distance2) + 3.3e-9, 6) AS inertia FROM nearest"),
    "cluster_centroids": _with(
        *IMPUTED,
        then="SELECT point_id % 4 AS cluster_id, " + _each(MEANS, "round(avg({v}) + 3.3e-9, 6) AS {v}")
        + " FROM imputed GROUP BY 1",
    ),
    "valid_k": "WITH limits AS (SELECT count(*) * 4 AS n FROM region) SELECT DISTINCT CAST(l_quantity AS INTEGER) AS k,"
    " n AS n_points, CAST(l_quantity AS INTEGER) >= 2 AND CAST(l_quantity AS INTEGER) < n AS is_valid"
    " FROM lineitem CROSS JOIN limits",
    "silhouette": _with(
        *LABELS, *SILHOUETTE,
        then="SELECT 'l' || CAST(k AS VARCHAR) AS labelling, round(silhouette + 3.3e-9, 6) AS silhouette FROM silhouettes",
    ),
    "silhouette_estimate": _with(
        *LABELS, *SILHOUETTE,
        "valued AS (SELECT i, CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END AS v FROM sides WHERE k = 5)",
        "ranked AS (SELECT label, point_id, count(*) OVER (PARTITION BY label) AS n, row_number() OVER (PARTITION BY label"
        " ORDER BY md5(CAST(point_id AS VARCHAR)), point_id) AS place FROM labels WHERE k = 5)",
        "strata AS (SELECT label, any_value(n) AS n, count(*) AS m, avg(v) AS mean, var_samp(v) AS var FROM ranked JOIN valued ON i = point_id"
        " WHERE place <= 8 GROUP BY label)",
        "whole AS (SELECT sum(n) AS total FROM strata)",
        then="SELECT round(sum(n * mean) / any_value(total) + 3.3e-9, 6) AS silhouette, round(sqrt(sum(CASE WHEN m > 1 AND m < n THEN"
        " (n / total) * (n / total) * var / m * (1 - m / n) ELSE 0 END)) + 3.3e-9, 6) AS standard_error, CAST(sum(m) AS BIGINT) AS n_sampled,"
        " CAST(sum(n) AS BIGINT) AS n_points, CAST(count(*) AS INTEGER) AS n_labels FROM strata CROSS JOIN whole",
    ),
    "silhouette_embeddings": """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings),
sums AS (SELECT a.vec_id, a.label AS own, b.label AS label, sum(list_distance(a.e, b.e)) AS s, count(*) AS n
  FROM v a CROSS JOIN v b GROUP BY 1, 2, 3),
sides AS (SELECT vec_id, max(CASE WHEN own = label AND n > 1 THEN s / (n - 1) END) AS a,
  min(CASE WHEN own <> label THEN s / n END) AS b FROM sums GROUP BY 1)
SELECT 'label' AS labelling, round(avg(CASE WHEN b IS NULL THEN NULL WHEN a IS NULL OR greatest(a, b) = 0 THEN 0
  ELSE (b - a) / greatest(a, b) END) + 3.3e-9, 6) AS silhouette FROM sides""",
    "davies_bouldin": _with(
        *LABELS, *DAVIES_BOULDIN,
        then="SELECT 'l' || CAST(k AS VARCHAR) AS labelling, round(davies_bouldin + 3.3e-9, 6) AS davies_bouldin FROM db",
    ),
    "recommended_k": _with(
        *BEST,
        then="SELECT CAST(recommended_k AS INTEGER) AS recommended_k, round(silhouette + 3.3e-9, 6) AS silhouette,"
        " round(davies_bouldin + 3.3e-9, 6) AS davies_bouldin FROM best",
    ),
    "adjusted_rand": _with(POINTS, MORE_POINTS, *RAND, then="SELECT run_a, run_b, round(ari + 3.3e-9, 6) AS ari FROM rand"),
    "rand_stability": _with(
        POINTS, MORE_POINTS, *RAND,
        then="SELECT round(avg(ari) + 3.3e-9, 6) AS ari_mean, round(stddev_pop(ari) + 3.3e-9, 6) AS ari_std FROM rand",
    ),
    "quality_gates": _with(
        *GATES,
        then="SELECT CAST(recommended_k AS INTEGER) AS recommended_k, passes_silhouette, passes_davies_bouldin,"
        " passes_stability, passes_silhouette AND passes_davies_bouldin AND passes_stability AS passes_all FROM gates",
    ),
    "quality_text": _with(
        *GATES,
        "worded AS (SELECT *, CAST(recommended_k AS VARCHAR) AS k, CASE WHEN passes_silhouette THEN 'PASA' ELSE"
        " 'NO PASA' END AS a, CASE WHEN passes_davies_bouldin THEN 'PASA' ELSE 'NO PASA' END AS b,"
        " CASE WHEN passes_stability THEN 'PASA' ELSE 'NO PASA' END AS c FROM gates)",
        then="SELECT CAST(recommended_k AS INTEGER) AS recommended_k, 'K recomendado: ' || k || chr(10) ||"
        " 'Silhouette(' || k || ') = ' || printf('%.3f', silhouette) || ' (' || a || ', umbral >= 0.5)' || chr(10) ||"
        " 'Davies-Bouldin(' || k || ') = ' || printf('%.3f', davies_bouldin) || ' (' || b || ', umbral < 2.0)' ||"
        " chr(10) || 'Estabilidad (ARI promedio de 3 corridas) = ' || printf('%.3f', ari_mean) || ' +/- ' ||"
        " printf('%.3f', ari_std) || ' (' || c || ', umbral >= 0.95)' || chr(10) ||"
        " 'Nota: K=2 produjo un unico cluster; se omite de silhouette/DB.' AS report FROM worded",
    ),
    "cluster_zscores": _with(
        *READ, then="SELECT region, cluster_id, " + _each(MEANS, "round({v}_z + 3.3e-9, 6) AS {v}_z") + " FROM zs"
    ),
    "composite_index": _with(
        *READ, then=f"SELECT region, cluster_id, {_r('solar_index')}, {_r('wind_index')} FROM indices"
    ),
    "percentile_rank": _with(
        *READ, then=f"SELECT region, cluster_id, {_r('solar_percentile')}, {_r('wind_percentile')} FROM ranked"
    ),
    "quadrant_label": _with(*READ, then="SELECT region, cluster_id, label FROM told"),
    "label_confidence": _with(*READ, then=f"SELECT region, cluster_id, {_r('confidence')} FROM told"),
    "dominant_country": _with(
        *LABELLED,
        "entries AS (SELECT cluster_id, country, count(*) AS n FROM labelled GROUP BY 1, 2)",
        "firsts AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, country) AS place,"
        " CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY cluster_id) AS share FROM entries)",
        then="SELECT cluster_id, country AS dominant_country, round(share + 3.3e-9, 6) AS dominant_share FROM firsts"
        " WHERE place = 1",
    ),
    "cluster_description": _with(
        *READ,
        *ENTRIES[len(REGIONS):],
        then=f"SELECT t.region, t.cluster_id, {DESCRIPTION} AS description FROM told t JOIN placed p"
        " ON p.region = t.region AND p.cluster_id = t.cluster_id WHERE place = 1",
    ),
    "interpret_clusters": _with(
        *READ,
        then=f"SELECT region, cluster_id, label, size, {_r('confidence')}, {_r('solar_percentile')},"
        f" {_r('wind_percentile')}, {ROUNDED_MEANS} FROM told",
    ),
    "run_speedup": _with(
        *SPEEDUP,
        then="SELECT experiment, run_seq, CASE WHEN worker_count = 1 THEN 'sequential' ELSE 'parallel' END AS mode,"
        " worker_count, round(seconds + 3.3e-9, 6) AS seconds, round(greatest(memory_mb, CAST(0 AS DOUBLE)) + 3.3e-9, 6) AS memory_mb,"
        " round(baseline_seconds + 3.3e-9, 6) AS baseline_seconds, round(speedup + 3.3e-9, 6) AS speedup,"
        " round(speedup / worker_count * 100 + 3.3e-9, 6) AS efficiency FROM sped",
    ),
    "runs_by_workers": _with(
        *SPEEDUP,
        then="SELECT worker_count, round(avg(seconds) + 3.3e-9, 6) AS mean_seconds, round(avg(speedup) + 3.3e-9, 6) AS mean_speedup"
        " FROM sped GROUP BY 1",
    ),
    "experiment_summary": _with(
        RUNS,
        then="SELECT experiment, status, worker_count AS workers, repeat, round(seconds + 3.3e-9, 6) AS elapsed_seconds,"
        " point_count, error FROM runs",
    ),
    "experiment_stability": _with(
        RUNS,
        "steady AS (SELECT experiment, run_seq % 1000 AS worker_count, count(*) AS n_runs,"
        " bool_and(status = 'success') AS all_success, count(DISTINCT checksum) = 1 AS same_input FROM runs"
        " GROUP BY 1, 2)",
        then="SELECT *, all_success AND same_input AS is_stable FROM steady",
    ),
}
ORACLES["bright_run_folded"] = ORACLES["longest_bright_run"]
