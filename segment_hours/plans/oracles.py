"""Reference answers as DuckDB SQL over the given tables, written from the definitions."""

from __future__ import annotations

_SEGMENT = "event_type || '_' || CAST(user_id // 8 * 8 AS BIGINT)"
_KEYS = "ELR_MIL, year, month, day, hour"
_REASONS = [f"R{i}" for i in range(7)]
_FIRST, _LAST = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-01-30 23:00:00'"
_MIDDLE = "BETWEEN TIMESTAMP '2024-01-08 06:00:00' AND TIMESTAMP '2024-01-20 18:30:00'"


def _parts(ts):
    return ", ".join(f"CAST({p}({ts}) AS INT) AS {p}" for p in ("year", "month", "day", "hour"))


_EVENTS = f"ev AS (SELECT *, {_SEGMENT} AS ELR_MIL, date_trunc('hour', ts) AS h, {_parts('ts')} FROM events)"

_LOG = f"""log AS (
  SELECT ELR_MIL, event_id, ts AS EVENT_DATETIME, year, month, day, hour,
         'R' || (CAST(json_extract_string(props, '$.k') AS INT) % 7) AS INCIDENT_REASON,
         user_id, user_id || ':' || event_type AS SECTION_CODE, event_id // 2 AS INCIDENT_NUMBER, value
  FROM ev)"""


def _pivot(source):
    counts = ", ".join(f"count(*) FILTER (INCIDENT_REASON = '{r}') AS INCIDENT_{r}" for r in _REASONS)
    return f"SELECT {_KEYS}, {counts} FROM {source} WHERE ELR_MIL IS NOT NULL GROUP BY {_KEYS}"


_HOURLY = """hourly AS (
  SELECT ELR_MIL, h AS ts, min(value) - 50 AS min_air_temp, max(value) - 50 AS max_air_temp,
         sum(value) AS prcp_amt, max(value) AS snow_depth
  FROM ev GROUP BY ELR_MIL, h)"""


def _over(hours, key="ELR_MIL"):
    return (
        f"OVER (PARTITION BY {key} ORDER BY ts RANGE BETWEEN INTERVAL '{hours} hours' PRECEDING AND CURRENT ROW)"
    )


def _weather_columns(digits=4):
    return f"""round(min(min_air_temp) {_over(48)}, {digits}) AS min_air_temp_min_48h,
         round(max(max_air_temp) {_over(48)}, {digits}) AS max_air_temp_max_48h,
         round(sum(prcp_amt) {_over(6)}, {digits}) AS prcp_amt_sum_6h,
         round(sum(snow_depth) {_over(24)}, {digits}) AS snow_depth_sum_24h"""


_FLAG_COLUMNS = f"""CASE WHEN min(min_air_temp) {_over(72)} <= 0 THEN 1 ELSE 0 END AS flag_freeze,
         CASE WHEN max(max_air_temp) {_over(72)} >= 25 THEN 1 ELSE 0 END AS flag_heatwave"""

_VALIDITY = """validity AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start_date,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 45 AS INT) AS end_date,
         lpad(bin(o_custkey % 128), 7, '0') AS daysofweek
  FROM orders)"""

_RUNS = """runs AS (
  SELECT v.*, CAST(d AS DATE) AS run_date
  FROM (SELECT *, unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS d FROM validity) v
  WHERE substr(daysofweek, CAST(isodow(d) AS INT), 1) = '1')"""


def _hhmm(minute):
    return f"lpad(CAST(({minute}) // 60 AS VARCHAR), 2, '0') || lpad(CAST(({minute}) % 60 AS VARCHAR), 2, '0')"


_DEP = "((l_partkey * 7 + l_linenumber * 13) % 1440)"
_ARR = f"(({_DEP} + 1435) % 1440)"

_CALENDAR = """calendar AS (
  SELECT CAST(y AS VARCHAR) || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS season,
         'P' || lpad(CAST(n AS VARCHAR), 2, '0') AS period,
         make_date(y, 4, 1) + CAST((n - 1) * 28 AS INT) AS first_day,
         least(make_date(y, 4, 1) + CAST(n * 28 - 1 AS INT), make_date(y + 1, 4, 1) - 1) AS last_day
  FROM range(1990, 2030) t(y), range(1, 15) u(n))"""


def _rounded_hour(ts):
    return f"""date_trunc('hour', {ts}) + CASE
           WHEN epoch_us({ts}) % 3600000000 > 1800000000 THEN INTERVAL 1 HOUR
           WHEN epoch_us({ts}) % 3600000000 = 1800000000 AND hour({ts}) % 2 = 1 THEN INTERVAL 1 HOUR
           ELSE INTERVAL 0 HOUR END"""


def _filled(name, kinds, values):
    """Station hours of some event types, each with the last observation at or before it."""
    columns = ", ".join(f"{v} AS {c}" for c, v in values.items())
    names = ", ".join(values)
    return f"""{name}_obs AS (
  SELECT * FROM (
    SELECT user_id % 15 AS src_id, {_rounded_hour('ts')} AS rh, ts, {columns} FROM events WHERE event_type {kinds})
  QUALIFY row_number() OVER (PARTITION BY src_id, rh ORDER BY ts DESC) = 1),
{name}_hours AS (
  SELECT src_id, unnest(generate_series(min(rh), max(rh), INTERVAL 1 HOUR)) AS meto_stmp_time
  FROM {name}_obs GROUP BY src_id),
{name}_filled AS (
  SELECT h.src_id, h.meto_stmp_time, {names} FROM {name}_hours h ASOF JOIN {name}_obs o
  ON h.src_id = o.src_id AND h.meto_stmp_time >= o.rh)"""


_TD = _filled("td", "= 'view'", {"min_air_temp": "value - 50", "max_air_temp": "value + 50"})
_RH = _filled("rh", "= 'click'", {"prcp_amt": "value"})
_WH = _filled("wh", "= 'purchase'", {"snow_depth": "value"})
_GUSTS = {k: f"CASE WHEN event_type = '{e}' THEN value END" for k, e in (("max_gust_speed", "signup"), ("max_gust_dir", "error"))}
_WM = _filled("wm", "NOT IN ('view', 'click', 'purchase')", _GUSTS)

# All station tables at once, by the table's name.
_STATIONS = f"""obs AS (
  SELECT * FROM (
    SELECT CASE event_type WHEN 'view' THEN 'TD' WHEN 'click' THEN 'RH' WHEN 'purchase' THEN 'WH' ELSE 'WM' END AS station_table,
           user_id % 15 AS src_id, {_rounded_hour('ts')} AS rh, ts, value FROM events)
  QUALIFY row_number() OVER (PARTITION BY station_table, src_id, rh ORDER BY ts DESC, value DESC) = 1),
hours AS (
  SELECT station_table, src_id, unnest(generate_series(min(rh), max(rh), INTERVAL 1 HOUR)) AS meto_stmp_time
  FROM obs GROUP BY station_table, src_id),
filled AS (
  SELECT h.station_table, h.src_id, h.meto_stmp_time, round(value, 4) AS value FROM hours h ASOF JOIN obs o
  ON h.station_table = o.station_table AND h.src_id = o.src_id AND h.meto_stmp_time >= o.rh)"""


def _located(name, shift, values):
    return f"""{name} AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS ELR_MIL, {_parts('meto_stmp_time')}, {values}
  FROM {name}_filled JOIN nation ON src_id = (n_nationkey + {shift}) % 15 WHERE year(meto_stmp_time) = 2024)"""


_RAW_WEATHER = f"""{_TD}, {_RH}, {_WH}, {_WM},
{_located('td', 0, 'min_air_temp, max_air_temp')}, {_located('rh', 7, 'prcp_amt')}, {_located('wh', 3, 'snow_depth')},
{_located('wm', 11, 'max_gust_speed, max_gust_dir')},
raw AS (
  SELECT {_KEYS}, min_air_temp, max_air_temp, prcp_amt, snow_depth, max_gust_speed, max_gust_dir
  FROM td FULL JOIN rh USING ({_KEYS}) FULL JOIN wh USING ({_KEYS}) FULL JOIN wm USING ({_KEYS}))"""


def _backfilled(column):
    return (
        f"first_value({column} IGNORE NULLS) OVER (PARTITION BY ELR_MIL ORDER BY ts "
        f"ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS {column}"
    )


_WEATHER_NAMES = ("min_air_temp_min_48h", "max_air_temp_max_48h", "prcp_amt_sum_6h", "snow_depth_sum_24h")
_FLAG_NAMES = ("flag_freeze", "flag_heatwave")

_SUPPLIER_MAP = "'N' || s_nationkey || '_' || CAST(s_suppkey // 8 * 8 AS BIGINT)"


def _spine(digits):
    angle_doy, angle_hod = "2 * pi() * dayofyear(ts) / 365.25", "2 * pi() * hour(ts) / 24"
    encoded = ", ".join(
        f"round({f}({a}), {digits}) AS {f}_{n}"
        for n, a in (("doy", angle_doy), ("hod", angle_hod))
        for f in ("sin", "cos")
    )
    return f"""spine AS (
  SELECT ELR_MIL, {_parts('ts')}, {encoded}, CAST(dayofweek(ts) AS BIGINT) AS day_of_week
  FROM (SELECT DISTINCT ELR_MIL FROM ev) s, unnest(generate_series({_FIRST}, {_LAST}, INTERVAL 1 HOUR)) t(ts))"""


_OCCUPANCY = """covered AS (
  SELECT ELR_MIL, unnest(generate_series(h, h + to_hours(CAST(user_id % 5 AS INT)), INTERVAL 1 HOUR)) AS run_hour FROM ev),
occupancy AS (
  SELECT s.ELR_MIL, t.run_hour, count(c.run_hour) AS train_count
  FROM (SELECT DISTINCT ELR_MIL FROM covered) s
  CROSS JOIN (SELECT unnest(generate_series(min(run_hour), max(run_hour), INTERVAL 1 HOUR)) AS run_hour FROM covered) t
  LEFT JOIN covered c ON c.ELR_MIL = s.ELR_MIL AND c.run_hour = t.run_hour
  GROUP BY s.ELR_MIL, t.run_hour)"""

# distance of point (x, y) to segment (x1, y1)-(x2, y2), by clamping the projection
_ALONG = "coalesce(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / nullif((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 0), 0)"
_NEAR_X = f"CASE WHEN {_ALONG} <= 0 THEN x1 WHEN {_ALONG} >= 1 THEN x2 ELSE x1 + {_ALONG} * (x2 - x1) END"
_NEAR_Y = f"CASE WHEN {_ALONG} <= 0 THEN y1 WHEN {_ALONG} >= 1 THEN y2 ELSE y1 + {_ALONG} * (y2 - y1) END"


def _coordinate(i):
    return f"CAST(embedding[{i + 1}] AS DOUBLE) * 1e5"


def _degrees(first):
    return (
        f"54.0 + CAST(embedding[{first + 1}] AS DOUBLE) * 10 AS lat, "
        f"-2.0 + CAST(embedding[{first + 2}] AS DOUBLE) * 10 AS lon"
    )


# national grid to WGS84 by Newton steps on the meridian arc, then the seven-parameter shift and
# Newton steps for the latitude
_GRID_CONSTANTS = """k AS (SELECT 6377563.396::DOUBLE AS a, 6356256.909::DOUBLE AS b, 0.9996012717::DOUBLE AS f0, radians(49) AS lat0, radians(-2) AS lon0,
  1 - (6356256.909::DOUBLE / 6377563.396) ** 2 AS e2, (6377563.396 - 6356256.909)::DOUBLE / (6377563.396 + 6356256.909) AS n)"""


def _arc(phi):
    return (
        f"(b * f0 * ((1 + n + 1.25 * n**2 + 1.25 * n**3) * ({phi} - lat0)"
        f" - (3 * n + 3 * n**2 + 2.625 * n**3) * sin({phi} - lat0) * cos({phi} + lat0)"
        f" + (1.875 * n**2 + 1.875 * n**3) * sin(2 * ({phi} - lat0)) * cos(2 * ({phi} + lat0))"
        f" - 35.0 / 24 * n**3 * sin(3 * ({phi} - lat0)) * cos(3 * ({phi} + lat0))))"
    )


def _grid_steps():
    steps = ["g0 AS (SELECT vec_id, ge, gn, (gn + 100000) / (a * f0) + lat0 AS phi, k.* FROM placed, k)"]
    for i in range(8):
        columns = "vec_id, ge, gn, a, b, f0, lat0, lon0, e2, n"
        steps.append(
            f"g{i + 1} AS (SELECT {columns}, phi + (gn + 100000 - {_arc('phi')}) / (a * f0) AS phi FROM g{i})"
        )
    return ",\n".join(steps)


def _latitude_steps():
    steps = [
        "l0 AS (SELECT vec_id, wx, wy, wz, p, w2, atan2(wz, p * (1 - w2)) AS phi FROM "
        "(SELECT *, sqrt(wx * wx + wy * wy) AS p, 1 - (6356752.3141::DOUBLE / 6378137.0) ** 2 AS w2 FROM shifted))"
    ]
    for i in range(6):
        steps.append(
            f"l{i + 1} AS (SELECT vec_id, wx, wy, wz, p, w2, "
            f"atan2(wz + w2 * 6378137.0 / sqrt(1 - w2 * sin(phi) ** 2) * sin(phi), p) AS phi FROM l{i})"
        )
    return ",\n".join(steps)


_OSGB = f"""WITH placed AS (SELECT vec_id, 400000 + {_coordinate(0)} * 3 AS ge, 500000 + {_coordinate(1)} * 8 AS gn FROM embeddings),
{_GRID_CONSTANTS},
{_grid_steps()},
radii AS (SELECT *, a * f0 / sqrt(1 - e2 * sin(phi) ** 2) AS nu, a * f0 * (1 - e2) / (1 - e2 * sin(phi) ** 2) ** 1.5 AS rho,
          tan(phi) AS t, ge - 400000 AS d FROM g8),
geodetic AS (SELECT vec_id, a, e2,
    phi - t / (2 * rho * nu) * d**2
        + t / (24 * rho * nu**3) * (5 + 3 * t**2 + (nu / rho - 1) - 9 * t**2 * (nu / rho - 1)) * d**4
        - t / (720 * rho * nu**5) * (61 + 90 * t**2 + 45 * t**4) * d**6 AS lat,
    lon0 + d / (cos(phi) * nu) - d**3 / (cos(phi) * 6 * nu**3) * (nu / rho + 2 * t**2)
        + d**5 / (cos(phi) * 120 * nu**5) * (5 + 28 * t**2 + 24 * t**4)
        - d**7 / (cos(phi) * 5040 * nu**7) * (61 + 662 * t**2 + 1320 * t**4 + 720 * t**6) AS lon FROM radii),
cartesian AS (SELECT vec_id, a / sqrt(1 - e2 * sin(lat) ** 2) * cos(lat) * cos(lon) AS gx,
    a / sqrt(1 - e2 * sin(lat) ** 2) * cos(lat) * sin(lon) AS gy,
    a / sqrt(1 - e2 * sin(lat) ** 2) * (1 - e2) * sin(lat) AS gz FROM geodetic),
shifted AS (SELECT vec_id,
    446.448 + (1 - 20.4894e-6) * gx - radians(0.8421 / 3600) * gy + radians(0.2470 / 3600) * gz AS wx,
    -125.157 + radians(0.8421 / 3600) * gx + (1 - 20.4894e-6) * gy - radians(0.1502 / 3600) * gz AS wy,
    542.060 - radians(0.2470 / 3600) * gx + radians(0.1502 / 3600) * gy + (1 - 20.4894e-6) * gz AS wz FROM cartesian),
{_latitude_steps()}
SELECT vec_id, round(degrees(phi), 6) AS Latitude, round(degrees(atan2(wy, wx)), 6) AS Longitude FROM l6"""

# stops of a train in order; the hop starts at the latest earlier stop that has a departure
_HOPS = f"""WITH stops AS (
  SELECT l_orderkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos,
         CASE WHEN l_linestatus = 'F' THEN {_hhmm(_ARR)} END AS arr,
         CASE WHEN l_returnflag <> 'N' THEN {_hhmm(_DEP)} END AS dep,
         lpad(bin(l_orderkey % 128), 7, '0') AS mask
  FROM lineitem),
paired AS (
  SELECT s.*, (SELECT max(p.pos) FROM stops p WHERE p.l_orderkey = s.l_orderkey AND p.pos < s.pos AND p.dep IS NOT NULL) AS before
  FROM stops s WHERE arr IS NOT NULL)
SELECT CAST(s.l_orderkey AS VARCHAR) AS train_id, CAST(p.l_suppkey AS VARCHAR) AS stanox_dep, CAST(s.l_suppkey AS VARCHAR) AS stanox_arr,
       CASE WHEN s.dep < p.dep THEN right(s.mask, 1) || left(s.mask, 6) ELSE s.mask END AS daysofweek, p.dep AS dep_time
FROM paired s JOIN stops p ON p.l_orderkey = s.l_orderkey AND p.pos = s.before"""


# the same with timetable text: unmapped stops are left out, the last line number is a terminus
_TIMETABLE = f"""WITH {_VALIDITY}, stops AS (
  SELECT l_orderkey, l_suppkey + 10000 AS stanox, CASE WHEN l_linenumber NOT IN (1, 7) THEN {_hhmm(_ARR)} END AS arr,
         CASE WHEN l_linenumber <> 7 THEN {_hhmm(_DEP)} END AS dep,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos
  FROM lineitem WHERE l_suppkey % 10 <> 0),
paired AS (
  SELECT s.*, (SELECT max(p.pos) FROM stops p WHERE p.l_orderkey = s.l_orderkey AND p.pos < s.pos AND p.dep IS NOT NULL) AS before
  FROM stops s WHERE arr IS NOT NULL)
SELECT lpad(CAST(s.l_orderkey AS VARCHAR), greatest(6, length(CAST(s.l_orderkey AS VARCHAR)))::INT, '0') AS train_id, CAST(p.stanox AS VARCHAR) AS stanox_dep, CAST(s.stanox AS VARCHAR) AS stanox_arr,
       CASE WHEN s.dep < p.dep THEN right(daysofweek, 1) || left(daysofweek, 6) ELSE daysofweek END AS daysofweek, p.dep AS dep_time,
       strftime(start_date, '%y%m%d') AS start_date, strftime(end_date, '%y%m%d') AS end_date
FROM paired s JOIN stops p ON p.l_orderkey = s.l_orderkey AND p.pos = s.before JOIN validity ON o_orderkey = s.l_orderkey"""


def _glm_terms():
    rows = []
    for reason in _REASONS:
        base = f"avg(INCIDENT_{reason}) FILTER (hour >= 6)"
        night = f"avg(INCIDENT_{reason}) FILTER (hour < 6)"
        rows.append(f"SELECT 'INCIDENT_{reason}' AS label, 'const' AS term, round(ln({base}), 3) AS coefficient FROM wide")
        rows.append(f"SELECT 'INCIDENT_{reason}', 'night', round(ln({night} / {base}), 3) FROM wide")
    return " UNION ALL ".join(rows)


def _profile(columns):
    rows = []
    for name, kind in columns.items():
        if kind == "int":
            test = f"count(DISTINCT {name}) + max(CASE WHEN {name} IS NULL THEN 1 ELSE 0 END) <= 20"
            rows.append(f"SELECT '{name}' AS \"column\", CASE WHEN {test} THEN 'categorical' ELSE 'numeric' END AS kind FROM lineitem")
        else:
            rows.append(f"SELECT '{name}' AS \"column\", '{kind}' AS kind")
    return " UNION ALL ".join(rows)


ORACLES = {
    # sources and sinks
    "scan_formats": "SELECT c.*, fmt FROM customer c, (VALUES ('csv'), ('json'), ('parquet')) f(fmt)",
    "scan_partitioned": f"""WITH r AS (SELECT *, {_parts('ts')} FROM events)
SELECT event_id, value, NULL::BIGINT AS user_id, event_type AS ELR_MIL, year, month, day FROM r
UNION ALL SELECT event_id, NULL, user_id, event_type, year, month, day FROM r""",
    "scan_pruned": f"""SELECT event_id, value, event_type AS ELR_MIL, {_parts('ts')} FROM events
WHERE event_type = 'view' AND month(ts) = 1 AND day(ts) IN (3, 9, 17, 26)""",
    "write_partitioned": f"SELECT event_id, value, event_type AS ELR_MIL, {_parts('ts')} FROM events",
    "scan_year_tables": """SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN o_totalprice ELSE 0 END AS prcp_amt,
  CAST(year(o_orderdate) AS INT) AS file_year FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999""",
    "scan_period_files": f"""WITH {_CALENDAR}
SELECT o_orderkey, o_totalprice, season, period FROM orders JOIN calendar ON o_orderdate BETWEEN first_day AND last_day
WHERE first_day <= DATE '1999-06-30' AND last_day >= DATE '1996-04-10'""",
    "normalise_delay_csv": f"""WITH {_EVENTS}, {_LOG}
SELECT date_trunc('minute', EVENT_DATETIME) AS INCIDENT_START_DATETIME, CAST(INCIDENT_NUMBER AS VARCHAR) AS INCIDENT_NUMBER, SECTION_CODE,
       INCIDENT_REASON, date_trunc('minute', EVENT_DATETIME) AS PLANNED_ORIGIN_WTT_DATETIME,
       date_trunc('minute', EVENT_DATETIME) AS EVENT_DATETIME, split_part(SECTION_CODE, ':', 2) AS EVENT_TYPE,
       'TRAIN_SERVICE_CODE' AS TRAIN_SERVICE_CODE, 'REACT_REASON' AS REACT_REASON, 'START_STANOX' AS START_STANOX,
       'END_STANOX' AS END_STANOX, CAST(value AS VARCHAR) AS PFPI_MINUTES
FROM log WHERE event_id % 11 <> 0""",
    "parse_tab_records": """SELECT 'T' || doc_id AS TIPLOC, md5(regexp_replace(text, '[\\t\\r\\n]+', ' ', 'g')) AS name_md5,
  CAST(length(regexp_replace(text, '[\\t\\r\\n]+', ' ', 'g')) AS INT) AS name_length, CAST(n_chars AS VARCHAR) AS EASTING,
  CAST(doc_id AS VARCHAR) AS NORTHING, NULL::VARCHAR AS STANOX FROM documents WHERE lang <> 'en'""",
    "flatten_json_array": "SELECT c_custkey, c_name, c_nationkey FROM customer",
    # projections and filters
    "rename_positional": """SELECT l_orderkey AS C00, l_partkey AS C01, l_suppkey AS C02, l_linenumber AS C03, l_quantity AS C04,
  l_extendedprice AS C05, l_discount AS C06, l_tax AS C07, l_returnflag AS C08, l_linestatus AS C09, l_shipdate AS C10 FROM lineitem""",
    "filter_valid_points": f"""SELECT vec_id, CAST(label AS VARCHAR) AS STANOX, round({_coordinate(0)}) AS EASTING, round({_coordinate(1)}) AS NORTHING
FROM embeddings WHERE label NOT IN (0, 1, 2, 3) AND round({_coordinate(0)}) NOT IN (0, 999999)""",
    "filter_time_range": f"SELECT event_id, ts FROM events WHERE ts {_MIDDLE}",
    "filter_interval_overlap": f"""WITH {_VALIDITY}
SELECT o_orderkey, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, daysofweek
FROM validity WHERE NOT (end_date < DATE '1997-03-01' OR start_date > DATE '1998-02-28')""",
    "clamp_interval": f"""WITH {_VALIDITY}
SELECT o_orderkey, CAST(CASE WHEN start_date < DATE '1997-03-01' THEN DATE '1997-03-01' ELSE start_date END AS VARCHAR) AS start_date,
  CAST(CASE WHEN end_date > DATE '1998-02-28' THEN DATE '1998-02-28' ELSE end_date END AS VARCHAR) AS end_date, daysofweek
FROM validity WHERE end_date >= DATE '1997-03-01' AND start_date <= DATE '1998-02-28'""",
    "filter_finite": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(l_extendedprice / l_tax, 4) AS ratio,
  round(l_quantity / l_discount, 4) AS share FROM lineitem WHERE l_tax <> 0 AND l_discount <> 0""",
    "split_xy": f"WITH {_EVENTS}, {_LOG} {_pivot('log')}",
    # joins
    "join_station_fanout": f"""WITH {_STATIONS}
SELECT CAST(n_nationkey AS VARCHAR) AS ELR_MIL, {_parts('meto_stmp_time')}, station_table, value
FROM filled JOIN nation ON src_id = (n_nationkey + CASE station_table WHEN 'TD' THEN 0 WHEN 'RH' THEN 7 WHEN 'WH' THEN 3 ELSE 11 END) % 15
WHERE year(meto_stmp_time) = 2024""",
    "join_outer_tables": f"""WITH {_EVENTS}, keyed AS (SELECT *, CAST(user_id // 8 AS BIGINT) AS segment FROM ev)
SELECT segment, year, month, day, hour, """
    + ", ".join(f"max(value) FILTER (event_type = '{k}') AS {k}" for k in ("view", "click", "purchase", "signup", "error"))
    + " FROM keyed GROUP BY segment, year, month, day, hour",
    "map_lookup_last_wins": f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_suppkey % 40 AS code,
  (SELECT {_SUPPLIER_MAP} FROM supplier WHERE s_suppkey = m.last) AS ELR_MIL
FROM lineitem LEFT JOIN (SELECT s_suppkey % 37 AS code, max(s_suppkey) AS last FROM supplier GROUP BY 1) m ON m.code = l_suppkey % 40""",
    "nearest_segment": f"""WITH p AS (SELECT vec_id, {_coordinate(0)} AS x, {_coordinate(1)} AS y FROM embeddings),
l AS (SELECT vec_id AS line, 'L' || label || '_' || CAST((vec_id % 40) // 8 * 8 AS BIGINT) AS ELR_MIL, embedding FROM embeddings),
pieces AS (
  SELECT line, ELR_MIL, {_coordinate(2)} AS x1, {_coordinate(3)} AS y1, {_coordinate(4)} AS x2, {_coordinate(5)} AS y2 FROM l
  UNION ALL SELECT line, ELR_MIL, {_coordinate(4)}, {_coordinate(5)}, {_coordinate(6)}, {_coordinate(7)} FROM l),
d AS (
  SELECT vec_id, x, y, line, ELR_MIL, min(sqrt((x - near_x) * (x - near_x) + (y - near_y) * (y - near_y))) AS dist
  FROM (SELECT *, {_NEAR_X} AS near_x, {_NEAR_Y} AS near_y FROM p, pieces) GROUP BY ALL)
SELECT ELR_MIL, vec_id AS STANOX, round(x, 4) AS EASTING, round(y, 4) AS NORTHING FROM d
WHERE dist <= 1000 QUALIFY rank() OVER (PARTITION BY vec_id ORDER BY dist) = 1""",
    "nearest_station": f"""WITH p AS (SELECT vec_id AS loc_id, {_degrees(8)} FROM embeddings),
s AS (SELECT vec_id AS src_id, CAST(2023 + vec_id % 2 AS INT) AS year, {_degrees(12)} FROM embeddings),
d AS (SELECT loc_id, year, src_id, 2 * 6371.0088 * asin(sqrt(sin(radians(s.lat - p.lat) / 2) ** 2
    + cos(radians(p.lat)) * cos(radians(s.lat)) * sin(radians(s.lon - p.lon) / 2) ** 2)) AS km FROM p, s)
SELECT loc_id, year, src_id, round(km, 3) AS distance_km FROM d
QUALIFY row_number() OVER (PARTITION BY loc_id, year ORDER BY km, src_id) = 1""",
    "hourly_spine": f"WITH {_EVENTS}, {_spine(6)} SELECT * FROM spine",
    "asof_hourly_fill": f"WITH {_STATIONS} SELECT station_table, src_id, meto_stmp_time, value FROM filled",
    "missing_partitions": f"""WITH {_CALENDAR},
buckets AS (SELECT DISTINCT CAST(o_custkey // 16 AS BIGINT) AS bucket FROM orders)
SELECT bucket, season || '_' || period AS code FROM buckets, calendar c
WHERE first_day <= DATE '2001-12-31' AND last_day >= DATE '1995-01-01' AND NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey // 16 = bucket AND o_orderdate BETWEEN first_day AND last_day)""",
    "business_period_of": f"""WITH {_CALENDAR}
SELECT o_orderkey, season || '_' || period AS code FROM orders JOIN calendar ON o_orderdate BETWEEN first_day AND last_day""",
    # aggregation and de-duplication
    "segment_centroid": f"""SELECT 'L' || label AS ELR_MIL, round(avg({_coordinate(0)}), 4) AS EASTING,
  round(avg({_coordinate(1)}), 4) AS NORTHING FROM embeddings GROUP BY label""",
    "osgb_to_wgs84": _OSGB,
    "collapse_schedule": f"""SELECT l_orderkey AS train_id, 'S_' || CAST(l_suppkey // 8 * 8 AS BIGINT) AS ELR_MIL,
  min({_hhmm(_DEP)}) AS dep_time, max({_hhmm(_DEP)}) AS arr_time FROM lineitem GROUP BY 1, 2""",
    "incident_pivot": f"WITH {_EVENTS}, {_LOG} {_pivot('log')}",
    "distinct_codes": f"WITH {_EVENTS}, {_LOG} SELECT DISTINCT INCIDENT_REASON FROM log",
    "time_bounds": "SELECT date_trunc('hour', min(ts)) AS min_ts, date_trunc('hour', max(ts)) AS max_ts FROM events",
    "dedup_last": f"""SELECT src_id, hour_ts, event_id, value FROM (
  SELECT user_id % 15 AS src_id, {_rounded_hour('ts')} AS hour_ts, ts, event_id, value FROM events)
QUALIFY row_number() OVER (PARTITION BY src_id, hour_ts ORDER BY ts DESC) = 1""",
    "dedup_first": f"""WITH {_EVENTS}, {_LOG}, {_CALENDAR}
SELECT season || '_' || period AS period, INCIDENT_REASON, EVENT_DATETIME, ELR_MIL, event_id
FROM log JOIN calendar ON CAST(EVENT_DATETIME AS DATE) BETWEEN first_day AND last_day
QUALIFY row_number() OVER (PARTITION BY season, period, INCIDENT_REASON ORDER BY EVENT_DATETIME, ELR_MIL) = 1""",
    "hourly_train_count": f"""WITH {_VALIDITY}, {_RUNS},
trips AS (
  SELECT l_orderkey, 'N' || s_nationkey AS ELR_MIL, min({_DEP}) // 60 AS first, max({_DEP}) // 60 AS last
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2),
present AS (
  SELECT ELR_MIL, run_date + to_hours(CAST(hh AS INT)) AS run_hour, count(*) AS n
  FROM (SELECT *, unnest(range(first, last + 1)) AS hh FROM trips) t JOIN runs ON o_orderkey = l_orderkey GROUP BY 1, 2),
grid AS (
  SELECT s.ELR_MIL, t.run_hour FROM (SELECT DISTINCT ELR_MIL FROM present) s,
  (SELECT unnest(generate_series(min(run_hour), max(run_hour), INTERVAL 1 HOUR)) AS run_hour FROM present) t)
SELECT ELR_MIL, run_hour, coalesce(n, 0) AS train_count FROM grid LEFT JOIN present USING (ELR_MIL, run_hour)""",
    "hourly_occupancy": f"WITH {_EVENTS}, {_OCCUPANCY} SELECT ELR_MIL, {_parts('run_hour')}, train_count FROM occupancy",
    "profile_columns": _profile(
        {
            "l_orderkey": "int", "l_partkey": "int", "l_suppkey": "int", "l_linenumber": "int", "l_quantity": "numeric",
            "l_extendedprice": "numeric", "l_discount": "numeric", "l_tax": "numeric", "l_returnflag": "categorical",
            "l_linestatus": "categorical", "l_shipdate": "numeric",
        }
    ),
    "label_totals": f"WITH {_EVENTS}, {_LOG} SELECT "
    + ", ".join(f"count(*) FILTER (INCIDENT_REASON = '{r}') AS INCIDENT_{r}" for r in _REASONS)
    + " FROM log",
    # windows
    "rolling_range_features": f"""WITH {_EVENTS}, {_HOURLY}
SELECT ELR_MIL, ts, {_weather_columns(8)}, round(avg(prcp_amt) {_over(12)}, 8) AS prcp_amt_mean_12h FROM hourly""",
    "rolling_rows": f"""WITH {_EVENTS}, r AS (SELECT ELR_MIL, event_id, h AS ts, value FROM ev)
SELECT ELR_MIL, event_id, ts, round(min(value) {_over(24)}, 8) AS value_min_24h, round(max(value) {_over(24)}, 8) AS value_max_24h,
  round(sum(value) {_over(24)}, 8) AS value_sum_24h, round(avg(value) {_over(24)}, 8) AS value_mean_24h FROM r""",
    "rolling_flags": f"WITH {_EVENTS}, {_HOURLY} SELECT ELR_MIL, ts, prcp_amt, snow_depth, {_FLAG_COLUMNS} FROM hourly",
    "backfill": f"""WITH {_EVENTS}, {_HOURLY}, gaps AS (SELECT ELR_MIL, ts, CASE WHEN prcp_amt > 60 THEN round(prcp_amt, 4) END AS prcp_amt FROM hourly)
SELECT ELR_MIL, ts, {_backfilled('prcp_amt')} FROM gaps""",
    "schedule_hops": _HOPS,
    "timetable_lines_to_hops": _TIMETABLE,
    # sorting and sets
    "sort_nulls_last": f"""WITH {_EVENTS}, {_LOG}, wide AS ({_pivot('log')})
SELECT {_KEYS}, CASE WHEN INCIDENT_R0 > 0 THEN 'R0' WHEN INCIDENT_R1 > 0 THEN 'R1' END AS first_reason
FROM wide ORDER BY first_reason NULLS LAST, {_KEYS}""",
    "first_segment": f"WITH {_EVENTS} SELECT min(ELR_MIL) AS ELR_MIL FROM ev",
    "union_by_name": """SELECT c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS mktsegment FROM customer
UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL FROM supplier""",
    # scalar expressions
    "fixed_width_slice": """SELECT doc_id, md5(substr(text, 3, 7)) AS code_md5, CAST(length(trim(substr(text, 45, 5))) AS INT) AS trimmed,
  CAST(length(substr(text, 11)) AS INT) AS rest FROM documents""",
    "normalise_hhmm": """WITH r AS (SELECT p_partkey, p_size % 5 = 0 AS bad, p_partkey * 7 % 12000 AS v FROM part),
t AS (SELECT p_partkey, bad, CASE WHEN v < 10000 THEN v // 100 ELSE v // 1000 END AS hh, CASE WHEN v < 10000 THEN v % 100 ELSE v % 1000 END AS mm FROM r)
SELECT p_partkey, CASE WHEN NOT bad AND hh < 24 AND mm < 60
  THEN lpad(CAST(hh AS VARCHAR), 2, '0') || lpad(CAST(mm AS VARCHAR), 2, '0') END AS hhmm FROM t""",
    "split_prefix_int": "SELECT event_id, CASE WHEN event_id % 9 <> 0 THEN user_id END AS section FROM events",
    "segment_bucket": """SELECT event_id, event_type || '_' || CAST(floor(
  coalesce(CAST(trunc(CASE WHEN event_id % 6 <> 0 THEN user_id - 40 + value / 1000 END) AS BIGINT), 0) / 8) * 8 AS BIGINT) AS ELR_MIL FROM events""",
    "parse_period_name": """SELECT page_id, CASE page_id % 5 WHEN 3 THEN '202023' WHEN 4 THEN NULL ELSE '202324' END AS season,
  CASE WHEN page_id % 5 <> 4 THEN 'P' || lpad(CAST(page_id % 13 + 1 AS VARCHAR), 2, '0') END AS period FROM pages""",
    "parse_yymmdd": """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(
  CASE WHEN year(o_orderdate) < 2000 THEN CAST(o_orderdate AS DATE) + INTERVAL 100 YEAR ELSE o_orderdate END AS DATE)::VARCHAR END AS day FROM orders""",
    "parse_dayfirst": """SELECT o_orderkey, CASE WHEN o_custkey % 4 <> 3 THEN o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INT)) END AS parsed FROM orders""",
    "round_half_even_hour": f"""WITH r AS (
  SELECT event_id, CASE WHEN event_id % 2 = 0 THEN date_trunc('hour', ts) + INTERVAL 30 MINUTE ELSE ts END AS ts FROM events)
SELECT event_id, {_rounded_hour('ts')} AS hour_ts FROM r""",
    "date_parts": f"""SELECT event_id, {_parts('ts')}, CAST(minute(ts) AS INT) AS minute, CAST(second(ts) AS INT) AS second,
  CAST(isodow(ts) - 1 AS INT) AS weekday FROM events""",
    "timetable_season_of": """WITH s AS (
  SELECT CAST(y AS VARCHAR) || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') || kind AS season, low, high FROM (
    SELECT y, '_MAY' AS kind, make_date(y, 5, 1) AS low, make_date(y, 11, 30) AS high FROM range(1990, 2010) t(y)
    UNION ALL SELECT y, '_DEC', make_date(y, 12, 1), make_date(y + 1, 4, 30) FROM range(1990, 2010) t(y)))
SELECT o_orderkey, season FROM orders JOIN s ON CAST(o_orderdate AS DATE) BETWEEN low AND high""",
    "explode_day_mask": f"WITH {_VALIDITY}, {_RUNS} SELECT o_orderkey, CAST(run_date AS VARCHAR) AS run_date FROM runs",
    "rotate_day_mask": f"WITH {_VALIDITY} SELECT o_orderkey, right(daysofweek, 1) || left(daysofweek, 6) AS mask FROM validity",
    # incremental
    "stream_incident_counts": f"""WITH {_EVENTS}, {_LOG}
SELECT ELR_MIL, date_trunc('hour', EVENT_DATETIME) AS ts, INCIDENT_REASON, count(*) AS n FROM log GROUP BY ALL""",
    "stream_incident_parts": f"""WITH {_EVENTS}, {_LOG}
SELECT ELR_MIL, date_trunc('hour', EVENT_DATETIME) AS ts, INCIDENT_REASON, count(*) AS n FROM log GROUP BY ALL""",
    "utc_stamps": """SELECT event_id, CASE event_id % 6 WHEN 2 THEN t - INTERVAL 1 HOUR WHEN 3 THEN t + INTERVAL 330 MINUTE
  WHEN 4 THEN t - INTERVAL 2 HOUR WHEN 5 THEN NULL ELSE t END AS utc FROM (SELECT event_id, date_trunc('second', ts) AS t FROM events)""",
    "chunked_equals_full": f"WITH {_EVENTS}, {_spine(6)} SELECT {_KEYS}, day_of_week FROM spine",
    # models
    "encode_levels": """WITH l AS (SELECT DISTINCT 'priority' AS c, o_orderpriority AS v FROM orders
  UNION ALL SELECT DISTINCT 'status', o_orderstatus FROM orders UNION ALL SELECT DISTINCT 'customer', CAST(o_custkey AS VARCHAR) FROM orders),
k AS (SELECT c, v FROM l WHERE v IS NOT NULL QUALIFY row_number() OVER (PARTITION BY c ORDER BY v) > 1),
i AS (SELECT c, v, row_number() OVER (ORDER BY c, v) - 1 AS idx FROM k),
f AS (SELECT o_orderkey, idx FROM orders JOIN i ON c = 'priority' AND v = o_orderpriority
  UNION ALL SELECT o_orderkey, idx FROM orders JOIN i ON c = 'status' AND v = o_orderstatus
  UNION ALL SELECT o_orderkey, idx FROM orders JOIN i ON c = 'customer' AND v = CAST(o_custkey AS VARCHAR))
SELECT o_orderkey, o_totalprice, coalesce(string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx), '') AS indices
FROM orders LEFT JOIN f USING (o_orderkey) GROUP BY o_orderkey, o_totalprice""",
    "one_hot_drop_first": "SELECT o_orderkey, "
    + ", ".join(f"CASE WHEN o_orderstatus = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS o_orderstatus_{v}" for v in ("O", "P"))
    + ", "
    + ", ".join(
        f"CASE WHEN o_orderpriority = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS o_orderpriority_{v.replace('-', '_').replace(' ', '_')}"
        for v in ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    )
    + " FROM orders",
    "poisson_fit": f"WITH {_EVENTS}, {_LOG}, wide AS ({_pivot('log')}) {_glm_terms()}",
    "glm_score": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  round(exp(-1.5 + 4.0 * l_discount - 2.0 * l_tax + 0.03 * l_quantity), 4) AS mean_count FROM lineitem""",
    "hash_split": """SELECT event_id, user_id, CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT % 5 AS BIGINT) AS part FROM events""",
    "rank_auc": """WITH r AS (SELECT event_type AS label, CAST(json_extract_string(props, '$.k') AS INT) % 7 = 0 AS hit, floor(value) AS score FROM events),
ranked AS (SELECT label, hit, rank() OVER (PARTITION BY label ORDER BY score) + (count(*) OVER (PARTITION BY label, score) - 1) / 2.0 AS place
  FROM r WHERE hit IS NOT NULL AND score IS NOT NULL),
summed AS (SELECT label, count(*) FILTER (hit) AS positives, count(*) FILTER (NOT hit) AS negatives, sum(place) FILTER (hit) AS places
  FROM ranked GROUP BY label)
SELECT label, positives, negatives, round((places - positives * (positives + 1) / 2.0) / nullif(positives::DOUBLE * negatives, 0), 9) AS auc FROM summed""",
    # pipelines
    "weather_raw": f"""WITH {_RAW_WEATHER}
SELECT {_KEYS}, round(min_air_temp, 4) AS min_air_temp, round(max_air_temp, 4) AS max_air_temp, round(prcp_amt, 4) AS prcp_amt,
  round(snow_depth, 4) AS snow_depth, round(max_gust_speed, 4) AS max_gust_speed, round(max_gust_dir, 4) AS max_gust_dir FROM raw""",
    "weather_features": f"""WITH {_RAW_WEATHER},
timed AS (SELECT *, make_timestamp(year, month, day, hour, 0, 0) AS ts FROM raw),
rolled AS (SELECT {_KEYS}, ts, {', '.join(f'round({c}, 4) AS {c}' for c in _GUSTS)}, {_weather_columns()}, {_FLAG_COLUMNS} FROM timed),
filled AS (SELECT {_KEYS}, ts, {', '.join(_GUSTS)}, {', '.join(_backfilled(c) for c in (*_WEATHER_NAMES, *_FLAG_NAMES))} FROM rolled)
SELECT * EXCLUDE (ts) FROM filled WHERE ts {_MIDDLE}""",
    "incident_dataset": f"""WITH {_EVENTS}, {_LOG}, {_CALENDAR},
placed AS (SELECT log.* EXCLUDE (ELR_MIL), season, period, {_SUPPLIER_MAP} AS ELR_MIL
  FROM log JOIN calendar ON CAST(EVENT_DATETIME AS DATE) BETWEEN first_day AND last_day LEFT JOIN supplier ON s_suppkey = user_id
  WHERE EVENT_DATETIME {_MIDDLE}),
first AS (SELECT * FROM placed QUALIFY row_number() OVER (PARTITION BY season, period, INCIDENT_REASON ORDER BY EVENT_DATETIME, ELR_MIL NULLS LAST) = 1)
{_pivot('first')}""",
    "incident_dataset_by_number": f"""WITH {_EVENTS}, {_LOG},
placed AS (SELECT log.* EXCLUDE (ELR_MIL), {_SUPPLIER_MAP} AS ELR_MIL FROM log LEFT JOIN supplier ON s_suppkey = user_id),
first AS (SELECT * FROM placed QUALIFY row_number() OVER (PARTITION BY INCIDENT_NUMBER ORDER BY EVENT_DATETIME, ELR_MIL NULLS LAST) = 1)
{_pivot('first')}""",
    "modelling_frame": f"""WITH {_EVENTS}, {_LOG}, {_HOURLY}, {_spine(4)}, {_OCCUPANCY},
rolled AS (SELECT ELR_MIL, {_parts('ts')}, {_weather_columns()}, {_FLAG_COLUMNS} FROM hourly),
trains AS (SELECT ELR_MIL, {_parts('run_hour')}, train_count FROM occupancy), wide AS ({_pivot('log')})
SELECT {_KEYS}, sin_doy, cos_doy, sin_hod, cos_hod, day_of_week, """
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in (*_WEATHER_NAMES, *_FLAG_NAMES, "train_count", *(f"INCIDENT_{r}" for r in _REASONS)))
    + f""" FROM spine LEFT JOIN rolled USING ({_KEYS}) LEFT JOIN trains USING ({_KEYS}) LEFT JOIN wide USING ({_KEYS})""",
}
