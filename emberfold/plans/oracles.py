"""SQL statements of the registered queries for an independent engine (DuckDB).

Written from the semantics, not from the Spark plans: joins are plain theta joins, components
come from a recursive closure.
"""

from __future__ import annotations

# Shared table expressions; ``with_tables`` picks the ones a statement needs, in this order.
TABLES: dict[str, str] = {}

SITE_LAT = "(-10.5::DOUBLE + ((user_id * 7919) % 1600)::DOUBLE / 100::DOUBLE)"
SITE_LON = "(95.5::DOUBLE + ((user_id * 104729) % 4500)::DOUBLE / 100::DOUBLE)"
LAT = f"({SITE_LAT} + ((event_id * 31) % 201 - 100)::DOUBLE / 2000::DOUBLE)"
LON = f"({SITE_LON} + ((event_id * 57) % 211 - 105)::DOUBLE / 2000::DOUBLE)"


def run_date(ts: str) -> str:
    """Last local day (UTC+7) of the 7-day window that contains a time."""
    day = f"(({ts}) + INTERVAL 7 HOUR)::DATE"
    return (
        f"(DATE '2024-01-07' + (floor(date_diff('day', DATE '2024-01-01', {day})::DOUBLE / 7::DOUBLE) * 7)::INTEGER)"
    )


def hav(a_lat: str, a_lon: str, b_lat: str, b_lon: str) -> str:
    return (
        f"(pow(sin(radians({b_lat} - {a_lat}) / 2), 2) + cos(radians({a_lat})) * cos(radians({b_lat}))"
        f" * pow(sin(radians({b_lon} - {a_lon}) / 2), 2))"
    )


def within_km(km: str, a: str = "a", b: str = "b") -> str:
    distance = hav(f"{a}.latitude", f"{a}.longitude", f"{b}.latitude", f"{b}.longitude")
    return f"{distance} <= pow(sin({km}::DOUBLE / 6371::DOUBLE / 2), 2)"


def text_time(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {name or column}"


TABLES["golden"] = f"""
  SELECT {LAT} AS latitude, {LON} AS longitude, date_trunc('minute', ts) AS acq_datetime,
         value AS frp_mean, NULL::DOUBLE AS frp_max,
         (CASE event_type WHEN 'signup' THEN 30 WHEN 'error' THEN 100 ELSE 75 END)::DOUBLE AS confidence,
         1::INTEGER AS n_detections, 'FIRMS' AS source, event_type
  FROM events WHERE event_type IN ('click', 'error', 'signup')
  UNION ALL
  SELECT {LAT}, {LON}, date_trunc('hour', ts), value, value * 1.5::DOUBLE,
         ((event_id * 13) % 101)::DOUBLE, (1 + event_id % 9)::INTEGER, 'JAXA', event_type
  FROM events WHERE event_type IN ('view', 'purchase')"""

_BEST = """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY round_even(latitude * 100, 0), round_even(longitude * 100, 0),
                   time_bucket(INTERVAL 10 MINUTE, acq_datetime)
      ORDER BY confidence DESC NULLS LAST, acq_datetime, latitude, longitude, source, frp_mean DESC) AS rn
    FROM {table}) WHERE rn = 1"""

TABLES["confident"] = "SELECT * FROM golden WHERE event_type <> 'signup'"
TABLES["spots"] = f"SELECT *, {run_date('acq_datetime')} AS run_date FROM ({_BEST.format(table='confident')})"

TABLES["corners"] = """
  SELECT n_nationkey AS poly_id, n_name AS layer_revi, c AS corner,
         97::DOUBLE + 9::DOUBLE * (n_nationkey % 5) + 1.2::DOUBLE * cos(radians(45::DOUBLE * c)) AS lon,
         -9::DOUBLE + 3.2::DOUBLE * (n_nationkey // 5) + 1.2::DOUBLE * sin(radians(45::DOUBLE * c)) AS lat
  FROM nation, (SELECT unnest(range(8)) AS c)"""
TABLES["mercator"] = """
  SELECT poly_id, layer_revi, corner, 6378137::DOUBLE * radians(lon) AS x,
         6378137::DOUBLE * ln(tan(pi() / 4 + radians(lat) / 2)) AS y FROM corners"""
TABLES["edges"] = """
  SELECT a.poly_id, a.layer_revi, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM mercator a JOIN mercator b ON a.poly_id = b.poly_id AND b.corner = (a.corner + 1) % 8"""


def _near_polygons(buffer: str, margin: str) -> str:
    return f"""
  SELECT s.* EXCLUDE (sid, x, y), h.poly_id, h.layer_revi FROM (
    SELECT sid, poly_id, layer_revi FROM (
      SELECT s.sid, e.poly_id, e.layer_revi,
             (e.y1 > s.y) <> (e.y2 > s.y)
               AND s.x < (e.x2 - e.x1) * (s.y - e.y1) / (e.y2 - e.y1) + e.x1 AS crosses,
             greatest(0, least(1, ((s.x - e.x1) * (e.x2 - e.x1) + (s.y - e.y1) * (e.y2 - e.y1))
               / (pow(e.x2 - e.x1, 2) + pow(e.y2 - e.y1, 2)))) AS t,
             pow(s.x - e.x1 - t * (e.x2 - e.x1), 2) + pow(s.y - e.y1 - t * (e.y2 - e.y1), 2)
               < pow({buffer}::DOUBLE, 2) AS close
      FROM placed s
      JOIN (SELECT poly_id, min(lon) - {margin} AS w, max(lon) + {margin} AS e,
                   min(lat) - {margin} AS s, max(lat) + {margin} AS n FROM corners GROUP BY poly_id) box
        ON s.longitude BETWEEN box.w AND box.e AND s.latitude BETWEEN box.s AND box.n
      JOIN edges e ON e.poly_id = box.poly_id)
    GROUP BY sid, poly_id, layer_revi
    HAVING count(*) FILTER (WHERE crosses) % 2 = 1 OR bool_or(close)) h
  JOIN placed s USING (sid)"""


TABLES["placed"] = """
  SELECT row_number() OVER () AS sid, *, 6378137::DOUBLE * radians(longitude) AS x,
         6378137::DOUBLE * ln(tan(pi() / 4 + radians(latitude) / 2)) AS y FROM spots"""
TABLES["near"] = _near_polygons("1000", "0.05")
TABLES["near_wide"] = _near_polygons("60000", "1.0")

_ROW_ORDER = "run_date, confidence IS NULL, -confidence, acq_datetime, source, latitude, longitude"


def _dbscan(prefix: str, source: str, km: str = "5", min_samples: int = 5) -> None:
    """Register <prefix>_pts, _pairs, _core, _reach, _clusters and _labels over ``source``."""
    p = prefix
    TABLES[f"{p}_pts"] = f"SELECT row_number() OVER (ORDER BY {_ROW_ORDER}) AS pid, * FROM {source}"
    TABLES[f"{p}_pairs"] = f"""
  SELECT a.pid AS a, b.pid AS b FROM {p}_pts a JOIN {p}_pts b
    ON a.run_date = b.run_date AND b.latitude BETWEEN a.latitude - 0.05 AND a.latitude + 0.05
   AND b.longitude BETWEEN a.longitude - 0.05 AND a.longitude + 0.05 AND {within_km(km)}"""
    TABLES[f"{p}_core"] = f"SELECT a AS pid FROM {p}_pairs GROUP BY a HAVING count(*) >= {min_samples}"
    TABLES[f"{p}_reach"] = f"""
  SELECT pid AS a, pid AS b FROM {p}_core
  UNION
  SELECT r.a, e.b FROM {p}_reach r JOIN {p}_pairs e ON r.b = e.a JOIN {p}_core c ON c.pid = e.b"""
    TABLES[f"{p}_roots"] = f"SELECT a AS pid, min(b) AS root FROM {p}_reach GROUP BY a"
    TABLES[f"{p}_numbers"] = f"""
  SELECT r.pid, dense_rank() OVER (PARTITION BY s.run_date ORDER BY r.root) - 1 AS cluster_id
  FROM {p}_roots r JOIN {p}_pts s USING (pid)"""
    TABLES[f"{p}_border"] = f"""
  SELECT e.a AS pid, min(n.cluster_id) AS cluster_id FROM {p}_pairs e
  JOIN {p}_numbers n ON n.pid = e.b ANTI JOIN {p}_core c ON c.pid = e.a GROUP BY e.a"""
    TABLES[f"{p}_labels"] = f"""
  SELECT s.*, coalesce(n.cluster_id, o.cluster_id)::INTEGER AS cluster_id, n.pid IS NOT NULL AS is_core
  FROM {p}_pts s LEFT JOIN {p}_numbers n USING (pid) LEFT JOIN {p}_border o USING (pid)"""


_dbscan("whole", "spots")
_dbscan("peat", "near")
_dbscan("wide", "spots", "5", 8)
_dbscan("tight", "spots", "2", 3)

def mean(column: str) -> str:
    """Six-place mean from an exact integer sum, so that row order cannot decide a tie."""
    nano = f"(sum(round_even({column} * 1000000000, 0)::BIGINT)::DOUBLE / count(*) / 1000000000::DOUBLE)"
    return f"round_even({nano} * 1000000, 0) / 1000000::DOUBLE"


TABLES["summary"] = f"""
  SELECT run_date, cluster_id AS cluster_no,
         'fire_cluster_' || strftime(run_date, '%Y%m%d') || '_' || cluster_id AS cluster_id,
         count(*) AS point_count, c.lat AS centroid_latitude, c.lon AS centroid_longitude,
         list_sort(list(DISTINCT source)) AS sources, min(acq_datetime) AS first_detected,
         max(acq_datetime) AS last_detected, avg(frp_mean) AS avg_frp,
         min(latitude) AS min_lat, max(latitude) AS max_lat, min(longitude) AS min_lon, max(longitude) AS max_lon
  FROM peat_labels JOIN (
    SELECT run_date, cluster_id, {mean('latitude')} AS lat, {mean('longitude')} AS lon
    FROM (SELECT DISTINCT run_date, cluster_id, latitude, longitude FROM peat_labels WHERE cluster_id IS NOT NULL)
    GROUP BY run_date, cluster_id) c USING (run_date, cluster_id)
  GROUP BY run_date, cluster_id, c.lat, c.lon"""

TABLES["sites"] = f"""
  SELECT run_date, cluster_no, 'fire_cluster_' || strftime(run_date, '%Y%m%d') || '_' || cluster_no AS cluster_id,
         point_count, centroid_latitude, centroid_longitude, first_detected, last_detected, avg_frp
  FROM (
    SELECT {run_date('ts')} AS run_date, user_id AS cluster_no, count(*) AS point_count,
           {SITE_LAT} AS centroid_latitude, {SITE_LON} AS centroid_longitude,
           date_trunc('minute', min(ts)) AS first_detected, date_trunc('minute', max(ts)) AS last_detected,
           avg(value) AS avg_frp
    FROM events GROUP BY 1, 2, 4, 5)"""

TABLES["weather"] = f"""
  SELECT round_even({SITE_LAT}, 0) AS cell_lat, round_even({SITE_LON}, 0) AS cell_lon, date_trunc('hour', ts) AS hour,
         20::DOUBLE + min(value) / 10::DOUBLE AS temperature_2m, max(value) % 100::DOUBLE AS relative_humidity_2m,
         CASE WHEN max(event_id) % 29 = 0 THEN NULL ELSE min(value) % 25::DOUBLE END AS dew_point_2m,
         (min(event_id) % 4)::DOUBLE / 20::DOUBLE AS precipitation,
         ((max(event_id) * 7) % 50)::DOUBLE AS wind_speed_10m,
         ((max(event_id) * 31) % 360)::DOUBLE AS wind_direction_10m,
         ((max(event_id) * 11) % 75)::DOUBLE AS wind_gusts_10m
  FROM events GROUP BY 1, 2, 3"""


def _nearest(left: str, key: str, lat: str, lon: str, ts: str) -> str:
    return f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT l.*, w.* EXCLUDE (cell_lat, cell_lon), row_number() OVER (
      PARTITION BY l.{key} ORDER BY abs(epoch_us(w.hour) - epoch_us(l.{ts})), w.hour) AS rn
    FROM {left} l LEFT JOIN weather w
      ON w.cell_lat = round_even(l.{lat}, 0) AND w.cell_lon = round_even(l.{lon}, 0)) WHERE rn = 1"""


def _rint2(column: str) -> str:
    return f"round_even({column} * 100, 0) / 100::DOUBLE"


def _context(left: str) -> str:
    """Weather columns of an incident, all null when any value is missing."""
    fields = [
        ("temperature_2m", "temperature_celsius"), ("relative_humidity_2m", "relative_humidity_percent"),
        ("dew_point_2m", "dew_point_celsius"), ("precipitation", "precipitation_mm"),
        ("wind_speed_10m", "wind_speed_kmh"), ("wind_direction_10m", "wind_direction_deg"),
        ("wind_gusts_10m", "wind_gusts_kmh"),
    ]
    whole = " AND ".join(f"{source} IS NOT NULL" for source, _ in fields)
    columns = ", ".join(f"CASE WHEN {whole} THEN {_rint2(source)} END AS {name}" for source, name in fields)
    dropped = ", ".join(["hour", *[source for source, _ in fields]])
    nearest = _nearest(left, "cluster_id", "centroid_latitude", "centroid_longitude", "last_detected")
    return f"""
  SELECT * EXCLUDE ({dropped}),
         CASE WHEN {whole} THEN strftime(hour, '%Y-%m-%dT%H:%M:%S+00:00') END AS timestamp_utc, {columns},
         CASE WHEN NOT ({whole}) THEN 'Weather data acquisition failed or returned incomplete data.' END AS error
  FROM ({nearest})"""


TABLES["pixels"] = f"""
  SELECT p.product, e.ts, {LAT} AS lat, {LON} AS lon,
         CASE p.product WHEN 'CO' THEN value / 1000::DOUBLE WHEN 'AEROSOL' THEN value / 20::DOUBLE
              ELSE CASE WHEN event_type <> 'purchase' THEN value / 1000000::DOUBLE END END AS value
  FROM events e, products p"""
TABLES["products"] = """
  SELECT * FROM (VALUES ('CO', 1e6::DOUBLE, 50000::DOUBLE, 100000::DOUBLE, 'Carbon Monoxide', 0),
                        ('AEROSOL', 1::DOUBLE, 1::DOUBLE, 3::DOUBLE, 'Aerosol Index', 1),
                        ('NO2', 1e6::DOUBLE, 20::DOUBLE, 50::DOUBLE, 'Nitrogen Dioxide', 2))
    AS t(product, scale, moderate_above, severe_above, description, product_no)"""
TABLES["coarse"] = """
  SELECT product, ts AS image_ts, floor(lat / 0.045::DOUBLE) AS py,
         floor(lon / 0.045::DOUBLE) AS px, avg(value) AS value,
         (floor(lat / 0.045::DOUBLE) + 0.5::DOUBLE) * 0.045::DOUBLE AS latitude,
         (floor(lon / 0.045::DOUBLE) + 0.5::DOUBLE) * 0.045::DOUBLE AS longitude
  FROM pixels GROUP BY 1, 2, 3, 4"""


def _air(prefix: str, left: str) -> None:
    """Register <prefix>_measured (incident x product) and <prefix>_air (per incident)."""
    disc = hav("a.centroid_latitude", "a.centroid_longitude", "b.latitude", "b.longitude")
    TABLES[f"{prefix}_measured"] = f"""
  SELECT i.cluster_id, p.*, c.images::BIGINT AS images, c.composite * p.scale AS scaled,
         CASE WHEN c.images IS NULL THEN 'no_data' WHEN c.composite IS NULL THEN 'no_valid_pixels'
              ELSE 'success' END AS status,
         CASE WHEN c.composite * p.scale > p.severe_above THEN 'severe'
              WHEN c.composite * p.scale > p.moderate_above THEN 'moderate' END AS severity
  FROM {left} i CROSS JOIN products p LEFT JOIN (
    SELECT cluster_id, product, sum(n) AS images, avg(med) AS composite FROM (
      SELECT a.cluster_id, b.product, b.py, b.px, median(b.value) AS med, count(*) AS n
      FROM {left} a JOIN coarse b
        ON b.image_ts >= a.last_detected - INTERVAL 3 DAY AND b.image_ts < a.last_detected + INTERVAL 3 DAY
       AND b.latitude BETWEEN a.centroid_latitude - 0.5 AND a.centroid_latitude + 0.5
       AND b.longitude BETWEEN a.centroid_longitude - 0.5 AND a.centroid_longitude + 0.5
       AND {disc} <= pow(sin(50::DOUBLE / 6371::DOUBLE / 2), 2)
      GROUP BY 1, 2, 3, 4) GROUP BY 1, 2) c
    ON c.cluster_id = i.cluster_id AND c.product = p.product"""
    TABLES[f"{prefix}_air"] = f"""
  SELECT cluster_id, severe_count, moderate_count, messages,
         CASE WHEN severe_count >= 2 OR (severe_count = 1 AND moderate_count >= 1) THEN 'severe'
              WHEN severe_count >= 1 OR moderate_count >= 2 THEN 'high'
              WHEN moderate_count = 1 THEN 'moderate' ELSE 'low' END AS air_quality_severity
  FROM (SELECT cluster_id, count(*) FILTER (WHERE severity = 'severe') AS severe_count,
               count(*) FILTER (WHERE severity = 'moderate') AS moderate_count,
               coalesce(string_agg(description || CASE severity WHEN 'severe' THEN ' severely' ELSE ' moderately' END
                 || ' elevated', '; ' ORDER BY product_no) FILTER (WHERE severity IS NOT NULL), '') AS messages
        FROM {prefix}_measured GROUP BY cluster_id)"""


def _assessed(prefix: str, left: str) -> None:
    """Register <prefix>_weather, <prefix>_severity and <prefix>_score over incidents ``left``."""
    _air(prefix, left)
    TABLES[f"{prefix}_weather"] = _context(left)
    TABLES[f"{prefix}_severity"] = f"""
  SELECT *, CASE WHEN score >= 8 THEN 'critical' WHEN score >= 6 THEN 'severe' WHEN score >= 4 THEN 'high'
                 WHEN score >= 2 THEN 'moderate' ELSE 'low' END AS overall_severity
  FROM (
    SELECT *, (CASE WHEN point_count >= 15 THEN 3 WHEN point_count >= 5 THEN 2 ELSE 1 END
               + CASE WHEN dry THEN 2 ELSE 0 END + CASE WHEN windy THEN 1 ELSE 0 END
               + CASE air_quality_severity WHEN 'severe' THEN 3 WHEN 'high' THEN 2 WHEN 'moderate' THEN 1
                      ELSE 0 END)::BIGINT AS score,
           concat_ws('; ',
             CASE WHEN point_count >= 15 THEN 'High hotspot density (>=15)'
                  WHEN point_count >= 5 THEN 'Moderate hotspot density (>=5)' ELSE 'Low hotspot density' END,
             CASE WHEN dry THEN 'Low humidity (<40%)' END,
             CASE WHEN windy THEN 'High wind speed (>20km/h)' END,
             CASE air_quality_severity WHEN 'severe' THEN 'Severe air quality impact'
                  WHEN 'high' THEN 'High air quality impact' WHEN 'moderate' THEN 'Moderate air quality impact'
                  END) AS factors,
           CASE WHEN dry OR windy THEN 'high' ELSE 'low' END AS weather_severity
    FROM (SELECT w.*, a.* EXCLUDE (cluster_id), coalesce(relative_humidity_percent < 40, false) AS dry,
                 coalesce(wind_speed_kmh > 20, false) AS windy
          FROM {prefix}_weather w JOIN {prefix}_air a USING (cluster_id)))"""
    TABLES[f"{prefix}_criteria"] = f"""
  SELECT *,
    CASE WHEN avg_frp <= 100 THEN 2 WHEN avg_frp <= 500 THEN 5 WHEN avg_frp <= 1000 THEN 8 ELSE 10 END::DOUBLE AS s1,
    CASE WHEN point_count <= 5 THEN 2 WHEN point_count <= 10 THEN 4 WHEN point_count <= 20 THEN 7
         ELSE 10 END::DOUBLE AS s2,
    CASE air_quality_severity WHEN 'low' THEN 1 WHEN 'moderate' THEN 4 WHEN 'high' THEN 7 ELSE 10 END::DOUBLE AS s3,
    CASE WHEN precipitation_mm IS NULL THEN 5 WHEN precipitation_mm <= 0 THEN 10
         WHEN precipitation_mm <= 0.1::DOUBLE THEN 1 ELSE 10 END::DOUBLE AS s4,
    CASE WHEN relative_humidity_percent IS NULL THEN 5 WHEN relative_humidity_percent <= 30 THEN 10
         WHEN relative_humidity_percent <= 45 THEN 8 WHEN relative_humidity_percent <= 60 THEN 5
         WHEN relative_humidity_percent <= 80 THEN 3 ELSE 1 END::DOUBLE AS s5,
    CASE WHEN wind_speed_kmh IS NULL THEN 5 WHEN wind_speed_kmh <= 10 THEN 1 WHEN wind_speed_kmh <= 20 THEN 3
         WHEN wind_speed_kmh <= 35 THEN 7 ELSE 10 END::DOUBLE AS s6
  FROM {prefix}_severity"""
    TABLES[f"{prefix}_score"] = f"""
  SELECT *, 1::DOUBLE / (1::DOUBLE + exp(-raw_score)) AS confidence_score FROM (
    SELECT *, s1 * 0.3::DOUBLE + s2 * 0.25::DOUBLE + s3 * 0.2::DOUBLE + s4 * 0.15::DOUBLE + s5 * 0.05::DOUBLE
              + s6 * 0.05::DOUBLE - 5::DOUBLE AS raw_score FROM {prefix}_criteria)"""


_assessed("site", "sites")
_assessed("incident", "summary")

TABLES["scenes"] = """
  SELECT 'S' || o_orderkey AS scene_id,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'sentinel2' ELSE 'landsat' END AS data_source,
         1703030400000 + (date_diff('day', DATE '1995-01-01', o_orderdate::DATE) % 50) * 86400000
           + ((o_orderkey * 7919) % 86400) * 1000 AS time_start_ms,
         o_totalprice % 100::DOUBLE AS cloud_cover,
         -10::DOUBLE + ((o_orderkey * 37) % 1700)::DOUBLE / 100::DOUBLE AS lat,
         95::DOUBLE + ((o_orderkey * 101) % 4600)::DOUBLE / 100::DOUBLE AS lon
  FROM orders"""
TABLES["site_predictions"] = """
  SELECT 'fire_cluster_20240107_' || c_custkey AS instance_id, abs(c_acctbal) / 10000::DOUBLE AS confidence_score
  FROM customer"""
TABLES["predictions"] = """
  SELECT CASE WHEN event_type <> 'signup' THEN 'site_' || user_id END AS instance_id,
         value / (1::DOUBLE + value) AS confidence_score, value AS raw_score, event_id AS ingest_order FROM events"""
TABLES["lines"] = """
  SELECT event_type AS file, event_id AS line_id, props AS line FROM events
  UNION ALL SELECT source, doc_id, "text" FROM documents"""

# A table may only use tables named before it, save for these, which are listed in use order.
_ORDER = [
    "golden", "confident", "spots", "corners", "mercator", "edges", "placed", "near", "near_wide",
    *[f"{p}_{t}" for p in ("whole", "peat", "wide", "tight")
      for t in ("pts", "pairs", "core", "reach", "roots", "numbers", "border", "labels")],
    "summary", "sites", "weather", "products", "pixels", "coarse",
    *[f"{p}_{t}" for p in ("site", "incident")
      for t in ("measured", "air", "weather", "severity", "criteria", "score")],
    "scenes", "site_predictions", "predictions", "lines",
]


def with_tables(statement: str) -> str:
    """Prefix a statement with the table expressions it uses, directly or through others."""
    import re

    needed: set[str] = set()
    todo = [statement]
    while todo:
        text = todo.pop()
        for name in _ORDER:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                needed.add(name)
                todo.append(TABLES[name])
    if not needed:
        return statement
    parts = ",\n".join(
        f"{n} AS {'MATERIALIZED ' if not n.endswith('_reach') else ''}({TABLES[n]})" for n in _ORDER if n in needed
    )
    return f"WITH RECURSIVE {parts}\n{statement}"


_GOLDEN_ROW = (
    "round(latitude, 9) AS latitude, round(longitude, 9) AS longitude, "
    f"{text_time('acq_datetime')}, frp_mean, round(frp_max, 6) AS frp_max, confidence, n_detections, source"
)
_FIRMS_ROW = f"""round({LAT}, 9) AS latitude, round({LON}, 9) AS longitude, value AS frp,
  strftime(ts, '%Y-%m-%d') AS acq_date, (hour(ts) * 100 + minute(ts))::INTEGER AS acq_time,
  CASE event_type WHEN 'signup' THEN 'l' WHEN 'error' THEN 'H' ELSE 'n' END AS confidence"""
_LABELLED = f"""run_date::VARCHAR AS run_date, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude,
  {text_time('acq_datetime')}, source, cluster_id, is_core"""
_HIMAWARI_ROW = f"""SELECT year(ts)::INTEGER AS year, month(ts)::INTEGER AS month, day(ts)::INTEGER AS day,
  hour(ts)::INTEGER AS hour, round({LAT}, 9) AS lat, round({LON}, 9) AS lon, value AS ave_frp,
  round(value * 1.5::DOUBLE, 6) AS max_frp, ((event_id * 13) % 101)::DOUBLE AS ave_confidence,
  (1 + event_id % 9)::INTEGER AS n"""
_DAY_START, _DAY_END = "TIMESTAMP '2024-01-04 17:00:00'", "TIMESTAMP '2024-01-05 17:00:00'"
_BEST_ROWS = f"SELECT {_GOLDEN_ROW} FROM ({_BEST.format(table='golden')})"


def _tier(score: str) -> str:
    return f"CASE WHEN {score} > 0.75 THEN 'High' WHEN {score} > 0.5 THEN 'Moderate' ELSE 'Low' END"


def _stretch(band: str, low: str, span: str) -> str:
    return (
        f"round(pow(least(greatest(({band} - {low}::DOUBLE) / {span}::DOUBLE, 0), 1), 1::DOUBLE / 1.4::DOUBLE)"
        " * 255::DOUBLE, 5)"
    )


def _bands(low: str, span: str) -> str:
    return (
        f"{_stretch('l_extendedprice', low, span)} AS B4, {_stretch('(l_extendedprice * 0.5::DOUBLE)', low, span)} AS B3, "
        f"{_stretch('(l_quantity * 600::DOUBLE)', low, span)} AS B2"
    )


def _pixel(value: str, site: str, size: int, invert: bool) -> str:
    low, high = f"({site} - 0.04::DOUBLE)", f"({site} + 0.04::DOUBLE)"
    share = f"((greatest({low}, least({value}, {high})) - {low}) / ({high} - {low}))"
    if invert:
        share = f"(1::DOUBLE - {share})"
    return f"floor({share} * {size})::INTEGER"


def _density(prefix: str, name: str) -> str:
    return f"""SELECT run_date::VARCHAR AS run_date, '{name}' AS density,
  count(*) FILTER (WHERE is_core) AS core_rows, count(cluster_id) AS clustered_rows,
  count(DISTINCT cluster_id) AS clusters FROM {prefix}_labels GROUP BY 1"""


STATEMENTS: dict[str, str] = {
    "golden_union": f"SELECT {_GOLDEN_ROW} FROM golden",
    "golden_by_local_day": """SELECT strftime(acq_datetime + INTERVAL 7 HOUR, '%Y-%m-%d') AS local_day, source,
  count(*) AS n, max(confidence) AS top_confidence FROM golden GROUP BY 1, 2""",
    "local_day_window": f"""SELECT {_GOLDEN_ROW} FROM golden g
  WHERE g.acq_datetime >= {_DAY_START} AND g.acq_datetime < {_DAY_END}""",
    "confident_firms": f"SELECT {_FIRMS_ROW} FROM events WHERE event_type IN ('click', 'error')",
    "distinct_reads": f"""SELECT DISTINCT round({SITE_LAT}, 2) AS latitude, round({SITE_LON}, 2) AS longitude,
  strftime(ts, '%Y-%m-%d') AS acq_date, event_type AS confidence FROM events""",
    "bbox_filter": f"""SELECT {_GOLDEN_ROW} FROM golden g
  WHERE g.longitude BETWEEN 95 AND 118 AND g.latitude BETWEEN -11 AND 0""",
    "dedup_spacetime": _BEST_ROWS,
    "dedup_events": """SELECT user_id AS event_id, min(event_id) AS message_no, arg_min(event_type, event_id) AS event_type
  FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY user_id""",
    "points_in_or_near": f"SELECT {_GOLDEN_ROW}, layer_revi FROM near",
    "points_near_semi": f"SELECT DISTINCT {_GOLDEN_ROW} FROM near_wide",
    "points_near_fanout": """SELECT layer_revi, count(*) AS points, round(sum(frp_mean), 3) AS frp
  FROM near_wide GROUP BY layer_revi""",
    "dbscan_all": f"SELECT {_LABELLED} FROM whole_labels",
    "dbscan_near_polygons": f"SELECT {_LABELLED} FROM peat_labels",
    "core_point_counts": f"{_density('wide', '8 in 5 km')} UNION ALL {_density('tight', '3 in 2 km')}",
    "cluster_summaries": f"""SELECT cluster_id, point_count, round(centroid_latitude, 6) AS centroid_latitude,
  round(centroid_longitude, 6) AS centroid_longitude, array_to_string(sources, ',') AS detected_by,
  {text_time('first_detected')}, {text_time('last_detected')}, round(avg_frp, 6) AS avg_frp,
  round(min_lat, 6) AS min_lat, round(max_lat, 6) AS max_lat, round(min_lon, 6) AS min_lon,
  round(max_lon, 6) AS max_lon FROM summary""",
    "asof_weather": f"""SELECT round(latitude, 9) AS latitude, round(longitude, 9) AS longitude,
  {text_time('acq_datetime')}, frp_mean, source, {text_time('hour', 'weather_hour')},
  round(temperature_2m, 6) AS temperature, round(dew_point_2m, 6) AS dew_point
  FROM ({_nearest('(SELECT row_number() OVER () AS sid, * FROM golden)', 'sid', 'latitude', 'longitude',
                  'acq_datetime')})""",
    "weather_context": """SELECT cluster_id, timestamp_utc, temperature_celsius, relative_humidity_percent,
  dew_point_celsius, precipitation_mm, wind_speed_kmh, wind_direction_deg, wind_gusts_kmh, error FROM site_weather""",
    "aq_composite": """SELECT cluster_id, product, status, images, round(scaled, 9) AS value, severity
  FROM site_measured""",
    "aq_class": """SELECT cluster_id, severe_count, moderate_count, air_quality_severity, messages FROM site_air""",
    "severity": """SELECT cluster_id, overall_severity, score AS severity_score, factors, weather_severity
  FROM site_severity""",
    "criterion_scores": " UNION ALL ".join(
        f"SELECT cluster_id, '{name}' AS criterion, {column} AS score, {weight}::DOUBLE AS weight FROM site_criteria"
        for name, column, weight in (
            ("Fire Intensity (Avg FRP)", "s1", "0.3"), ("Hotspot Density", "s2", "0.25"),
            ("Air Quality Impact", "s3", "0.2"), ("Precipitation (Rain)", "s4", "0.15"),
            ("Relative Humidity", "s5", "0.05"), ("Wind Speed", "s6", "0.05"),
        )
    ),
    "risk_score": """SELECT cluster_id AS instance_id, round(confidence_score, 9) AS confidence_score,
  round(raw_score, 9) AS raw_score FROM site_score""",
    "plugged_in_model": """SELECT cluster_id AS instance_id,
  round(least(greatest((point_count / 10::DOUBLE - 2::DOUBLE) / 8::DOUBLE, 0), 1), 6) AS confidence_score,
  round(point_count / 10::DOUBLE - 2::DOUBLE, 6) AS raw_score FROM sites""",
    "incidents_flat": f"""SELECT cluster_id, point_count, round(centroid_latitude, 6) AS centroid_latitude,
  round(centroid_longitude, 6) AS centroid_longitude, {text_time('first_detected')}, {text_time('last_detected')},
  round(avg_frp, 6) AS avg_frp, temperature_celsius, air_quality_severity, overall_severity,
  score AS severity_score, round(raw_score, 9) AS raw_score, round(confidence_score, 9) AS confidence_score,
  {_tier('confidence_score')} AS risk_level FROM incident_score""",
    "report_markers": f"""SELECT cluster_id, round(centroid_latitude, 6) AS centroid_latitude,
  round(centroid_longitude, 6) AS centroid_longitude, point_count, round(confidence_score, 9) AS score,
  {_tier('confidence_score')} AS risk_level,
  CASE {_tier('confidence_score')} WHEN 'High' THEN 'red' WHEN 'Moderate' THEN 'orange' ELSE 'green' END AS marker_color,
  cluster_id || ' - ' || {_tier('confidence_score')} || ' Risk' AS tooltip,
  upper({_tier('confidence_score')}) || ' RISK FIRE' AS popup_title,
  printf('%.2f, %.2f', centroid_latitude, centroid_longitude) AS popup_place,
  printf('%.0f%%', confidence_score * 100) AS popup_confidence, air_quality_severity, relative_humidity_percent
  FROM site_score""",
    "report_kpis": f"""SELECT count(*) AS total_incidents,
  coalesce(sum(point_count) FILTER (WHERE instance_id IS NOT NULL), 0)::BIGINT AS total_hotspots,
  count(*) FILTER (WHERE instance_id IS NOT NULL AND {_tier('confidence_score')} = 'High') AS high,
  count(*) FILTER (WHERE instance_id IS NOT NULL AND {_tier('confidence_score')} = 'Moderate') AS moderate,
  count(*) FILTER (WHERE instance_id IS NOT NULL AND {_tier('confidence_score')} = 'Low') AS low
  FROM sites LEFT JOIN site_predictions ON instance_id = cluster_id""",
    "unmatched_predictions": """SELECT instance_id, round(confidence_score, 9) AS confidence_score
  FROM site_predictions WHERE instance_id NOT IN (SELECT cluster_id FROM sites)""",
    "prediction_first": """SELECT instance_id, round(arg_min(confidence_score, ingest_order), 9) AS confidence_score,
  arg_min(raw_score, ingest_order) AS raw_score FROM predictions WHERE instance_id <> '' GROUP BY instance_id""",
    "prediction_last": """SELECT instance_id, round(arg_max(confidence_score, ingest_order), 9) AS confidence_score,
  arg_max(raw_score, ingest_order) AS raw_score FROM predictions WHERE instance_id <> '' GROUP BY instance_id""",
    "latest_job": """SELECT 'job_' || o_orderkey AS job_id FROM orders
  ORDER BY o_orderdate DESC, 'job_' || o_orderkey DESC LIMIT 1""",
    "severity_counts": """SELECT run_date::VARCHAR AS run_date, overall_severity, count(*) AS incidents
  FROM site_severity GROUP BY 1, 2""",
    "run_summaries": """SELECT 'incidents_detected' AS status, sum(n)::BIGINT AS incident_count, run_date,
  string_agg(overall_severity || '=' || n, ',' ORDER BY overall_severity) AS severity_summary FROM (
    SELECT run_date::VARCHAR AS run_date, overall_severity, count(*) AS n FROM site_severity GROUP BY 1, 2)
  GROUP BY run_date""",
    "run_counts": """SELECT h.run_date::VARCHAR AS run_date, h.n AS hotspots, coalesce(p.n, 0) AS near_polygons,
  coalesce(p.clusters, 0) AS clusters, coalesce(p.clustered, 0) AS clustered
  FROM (SELECT run_date, count(*) AS n FROM spots GROUP BY 1) h LEFT JOIN (
    SELECT run_date, count(*) AS n, count(DISTINCT cluster_id) AS clusters, count(cluster_id) AS clustered
    FROM peat_labels GROUP BY 1) p USING (run_date)""",
    "overlay_pixels": f"""SELECT event_id, {_pixel(LON, SITE_LON, 800, False)} AS pixel_x,
  {_pixel(LAT, SITE_LAT, 600, True)} AS pixel_y FROM events""",
    "headline": """SELECT user_id,
  CASE WHEN arg_min(event_type, event_id) = 'error' THEN 'FIRE DETECTED' ELSE 'No Fire Detected' END AS status_text,
  printf('Confidence: %d.%d%%', (min(event_id) % 1000) // 10, (min(event_id) % 1000) % 10) AS confidence_text
  FROM events GROUP BY user_id""",
    "incident_boxes": """SELECT cluster_id, round(min_lon - 0.05::DOUBLE, 6) AS min_lon,
  round(min_lat - 0.05::DOUBLE, 6) AS min_lat, round(max_lon + 0.05::DOUBLE, 6) AS max_lon,
  round(max_lat + 0.05::DOUBLE, 6) AS max_lat FROM summary""",
    "best_scene": """SELECT region_id, data_source, scene_id AS original_id,
  strftime(make_timestamp(time_start_ms * 1000), '%Y-%m-%dT%H:%M:%S+00:00') AS acquisition_date_utc,
  round(cloud_cover, 6) AS cloud_cover FROM (
    SELECT r.cluster_id AS region_id, s.*, row_number() OVER (PARTITION BY r.cluster_id, s.data_source
             ORDER BY s.cloud_cover, s.time_start_ms DESC, s.scene_id) AS rn
    FROM sites r JOIN scenes s
      ON s.lon - 0.9::DOUBLE <= r.centroid_longitude + 0.1::DOUBLE
     AND s.lon + 0.9::DOUBLE >= r.centroid_longitude - 0.1::DOUBLE
     AND s.lat - 0.9::DOUBLE <= r.centroid_latitude + 0.1::DOUBLE
     AND s.lat + 0.9::DOUBLE >= r.centroid_latitude - 0.1::DOUBLE
     AND s.time_start_ms >= epoch_ms((r.run_date - 13)::TIMESTAMP)
     AND s.time_start_ms < epoch_ms((r.run_date + 1)::TIMESTAMP)) WHERE rn = 1""",
    "scene_window": """SELECT data_source, count(*) AS scenes, min(time_start_ms) AS first_ms, max(time_start_ms) AS last_ms
  FROM scenes WHERE time_start_ms >= epoch_ms(TIMESTAMP '2024-01-01') AND time_start_ms < epoch_ms(TIMESTAMP '2024-01-15')
  GROUP BY 1""",
    "band_stretch": f"""SELECT l_orderkey, l_linenumber, {_bands('0', '3500')} FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT l_orderkey, l_linenumber, {_bands('8000', '22000')} FROM lineitem WHERE l_returnflag <> 'R'""",
    "jsonl_audit": """SELECT file, count(*) AS lines, count(*) FILTER (WHERE json_valid(line)) AS valid,
  count(*) FILTER (WHERE trim(line) = '') AS empty,
  count(*) FILTER (WHERE NOT json_valid(line) AND trim(line) <> '') AS malformed,
  sum(length(line))::BIGINT AS characters FROM lines GROUP BY file""",
    "jsonl_key_sets": """SELECT file, array_to_string(list_sort(json_keys(line)), ',') AS keys, count(*) AS lines
  FROM lines WHERE json_valid(line) GROUP BY 1, 2""",
    "jsonl_head": """SELECT file, line_no::INTEGER AS line_no, line_id, length(line)::INTEGER AS characters FROM (
    SELECT *, row_number() OVER (PARTITION BY file ORDER BY line_id) AS line_no FROM lines) WHERE line_no <= 5""",
    "firms_csv_scan": f"SELECT {_FIRMS_ROW} FROM events WHERE event_type IN ('click', 'error', 'signup')",
    "firms_local_day_scan": f"""SELECT DISTINCT {_FIRMS_ROW} FROM events
  WHERE event_type IN ('click', 'error') AND ts >= {_DAY_START} AND ts < {_DAY_END}""",
    "himawari_csv_scan": f"""{_HIMAWARI_ROW} FROM events WHERE event_type IN ('view', 'purchase')""",
    "himawari_local_day_scan": f"""SELECT * EXCLUDE (alone) FROM (
  {_HIMAWARI_ROW}, NOT bool_or(event_id % 9 < 4) OVER (PARTITION BY date_trunc('hour', ts)) AS alone
  FROM events WHERE event_type IN ('view', 'purchase') AND ts >= {_DAY_START} AND ts < {_DAY_END})
  WHERE hour <> 5 AND (hour % 6 <> 0 OR n <= 4 OR alone)""",
    "hourly_files": f"""SELECT {text_time("date_trunc('hour', ts)", 'hour')},
  min('feed/' || strftime(ts, '%Y%m/%d/H09_%Y%m%d_%H00_') || lpad(user_id::VARCHAR, 6, '0') || '.csv') AS path
  FROM events WHERE event_type = 'view' AND ts >= {_DAY_START} AND ts < {_DAY_END} GROUP BY 1""",
    "polygon_scan": """SELECT poly_id, layer_revi, corner::INTEGER AS corner, round(lon, 9) AS lon, round(lat, 9) AS lat
  FROM corners""",
    "incident_records": """SELECT cluster_id, point_count, point_count AS nested, round(avg_frp, 6) AS avg_frp,
  overall_severity, strftime(first_detected, '%Y-%m-%dT%H:%M:%S+00:00') AS first_detected_utc FROM incident_severity""",
    "prediction_files": """SELECT instance_id, count(*) AS predictions, max(raw_score) AS top_raw_score
  FROM predictions GROUP BY 1""",
    "stream_best_of_bucket": _BEST_ROWS,
    "stream_process_once": "SELECT DISTINCT user_id::VARCHAR AS event_id FROM events",
    "stream_process_once_within": f"SELECT event_id, {text_time('ts')} FROM events",
}


# Entries that reach the same rows by another way: through files, a stream or another layer.
STATEMENTS |= {
    "firms_mixed_headers": STATEMENTS["firms_csv_scan"],
    "points_of_shared_keys": STATEMENTS["points_in_or_near"],
    "criteria_file": STATEMENTS["criterion_scores"],
    "scored_on_arrival": STATEMENTS["risk_score"],
    "report_on_arrival": f"""SELECT s.run_date::VARCHAR AS run_date, cluster_id, s.point_count, round(confidence_score, 9) AS score,
  {_tier('confidence_score')} AS risk_level, upper({_tier('confidence_score')}) || ' RISK FIRE' AS popup_title
  FROM sites s JOIN (SELECT cluster_id, confidence_score FROM site_score) p USING (cluster_id)
  WHERE s.run_date NOT IN (SELECT run_date FROM sites WHERE regexp_matches(cluster_id, '_20240114_[0-9]*0$'))""",
    "regions_of_records": STATEMENTS["incident_boxes"],
    "emptied_rerun": """SELECT run_date::VARCHAR AS run_date, count(*) AS incidents, sum(point_count)::BIGINT AS points
  FROM sites WHERE run_date <> DATE '2024-01-07' GROUP BY 1""",
    "manifest_job": STATEMENTS["latest_job"],
    "imagery_through_folders": """SELECT region_id, data_source AS source, scene_id AS original_id,
  strftime(make_timestamp(time_start_ms * 1000), '%Y-%m-%dT%H:%M:%S+00:00') AS acquisition_date_utc,
  round(cloud_cover, 6) AS cloud_cover FROM (
    SELECT r.cluster_id AS region_id, s.*, row_number() OVER (PARTITION BY r.cluster_id, s.data_source
             ORDER BY s.cloud_cover, s.time_start_ms DESC, s.scene_id) AS rn
    FROM summary r JOIN scenes s
      ON s.lon - 0.9::DOUBLE <= r.max_lon + 0.05::DOUBLE AND s.lon + 0.9::DOUBLE >= r.min_lon - 0.05::DOUBLE
     AND s.lat - 0.9::DOUBLE <= r.max_lat + 0.05::DOUBLE AND s.lat + 0.9::DOUBLE >= r.min_lat - 0.05::DOUBLE
     AND s.time_start_ms >= epoch_ms((r.run_date - 13)::TIMESTAMP)
     AND s.time_start_ms < epoch_ms((r.run_date + 1)::TIMESTAMP)
    WHERE r.run_date = DATE '2024-01-14') WHERE rn = 1""",
    "stages_through_folders": f"""SELECT cluster_id, round(centroid_latitude, 6) AS centroid_latitude,
  round(centroid_longitude, 6) AS centroid_longitude, point_count, round(confidence_score, 9) AS score,
  {_tier('confidence_score')} AS risk_level FROM incident_score WHERE run_date = DATE '2024-01-14'""",
}


def oracle_statements() -> dict[str, str]:
    return {name: with_tables(statement) for name, statement in STATEMENTS.items()}
