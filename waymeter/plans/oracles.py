"""Expected results as SQL over the given tables, one statement per registered query."""

from __future__ import annotations

from waymeter.params import ETA_BOUNDS, NUMERIC, REQUIRED_COLUMNS, TARGET
from waymeter.sources.locations import LOCATION_NAMES, LOCATIONS

# Numeric columns the registered drift queries test.
DRIFT_COLUMNS = (*NUMERIC, TARGET)
CLEAN_COLUMNS = (
    "pickup_location", "drop_location", "pickup_date", "pickup_time", "time_of_day", "season",
    "passenger_count", "surge_multiplier", "trip_distance_km", "traffic_level", TARGET,
)


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def half_up(expression: str, digits: int) -> str:
    """Round the decimal text of a double, ties away from zero."""
    return f"CAST(round(CAST(CAST(({expression}) AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def names(columns, prefix: str = "") -> str:
    return ", ".join(prefix + c for c in columns)


LOC = "loc(idx, name, lat, lon) AS (VALUES {})".format(
    ", ".join(
        f"({i}, {text(n)}, CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE))"
        for i, (n, lat, lon) in enumerate(LOCATIONS)
    )
)
BASE = """base AS (
  SELECT *,
    CASE WHEN l_orderkey < 3 THEN 22 + l_orderkey ELSE l_suppkey % 22 END AS p_idx,
    CASE WHEN l_orderkey BETWEEN 3 AND 5 THEN 19 + l_orderkey ELSE l_partkey % 22 END AS d_idx,
    (l_orderkey + l_partkey) % 24 AS hh,
    (l_partkey + l_linenumber) % 60 AS mi,
    month(l_shipdate) AS mo,
    concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS k
  FROM lineitem)"""
TRIPS = """once AS (
  SELECT k AS trip_id, p.name AS pickup_location, d.name AS drop_location,
    CASE WHEN l_linenumber = 7 THEN strftime(l_shipdate, '%Y-%m-%d')
         ELSE strftime(l_shipdate, '%d-%m-%Y') END AS pickup_date,
    lpad(CAST(hh AS VARCHAR), 2, '0') || ':' || lpad(CAST(mi AS VARCHAR), 2, '0') AS pickup_time,
    CASE WHEN hh < 6 THEN '4. Night' WHEN hh < 12 THEN '1. Morning'
         WHEN hh < 18 THEN '2. Afternoon' ELSE '3. Evening' END AS time_of_day,
    CASE WHEN mo IN (12, 1, 2) THEN '1. Winter' WHEN mo <= 5 THEN '2. Spring'
         WHEN mo <= 8 THEN '3. Summer' ELSE '4. Fall' END AS season,
    CAST(l_linenumber - 1 AS INTEGER) AS passenger_count,
    round(1.0 + l_discount * 10, 2) AS surge_multiplier,
    l_quantity / 2 AS trip_distance_km,
    CASE l_returnflag WHEN 'A' THEN 'Low' WHEN 'N' THEN 'Medium' ELSE 'High' END AS traffic_level,
    CASE WHEN l_quantity <> 50 THEN (floor(l_extendedprice / 5) - 150) / CAST(100 AS DOUBLE) END
      AS actual_eta_minutes,
    l_orderkey % 50 = 0 AS copied
  FROM base JOIN loc p ON p.idx = p_idx JOIN loc d ON d.idx = d_idx),
trips AS (
  SELECT * EXCLUDE (copied) FROM once
  UNION ALL
  SELECT * EXCLUDE (copied) REPLACE ('dup-' || trip_id AS trip_id) FROM once WHERE copied)"""
STANDARD = r"""standard AS (
  SELECT * EXCLUDE (trip_id) REPLACE (
    regexp_replace(time_of_day, '^\d+\.\s*', '') AS time_of_day,
    regexp_replace(season, '^\d+\.\s*', '') AS season)
  FROM trips)"""
CLEANED = """cleaned AS (
  SELECT DISTINCT * FROM standard
  WHERE actual_eta_minutes IS NOT NULL AND actual_eta_minutes BETWEEN 0.5 AND 200
    AND passenger_count > 0 AND trip_distance_km > 0)"""
FEATS = f"""dated AS (
  SELECT *, coalesce(try_strptime(pickup_date, '%d-%m-%Y'), try_strptime(pickup_date, '%Y-%m-%d')) AS dt,
    try_strptime(pickup_time, '%H:%M') AS tm,
    CAST('0x' || substr(md5(concat_ws('|', {names(CLEAN_COLUMNS)})), 1, 8) AS BIGINT) % 10000 < 2000
      AS is_test
  FROM cleaned),
feats AS (
  SELECT * EXCLUDE (dt, tm),
    CAST(month(dt) AS INTEGER) AS month, CAST(day(dt) AS INTEGER) AS day,
    CAST(dayofyear(dt) AS INTEGER) AS day_of_year, dayname(dt) AS weekday,
    CAST(isodow(dt) >= 6 AS INTEGER) AS is_weekend,
    CAST(hour(tm) AS INTEGER) AS pickup_hour, CAST(minute(tm) AS INTEGER) AS pickup_minute
  FROM dated)"""
SCORED = """scored AS (
  SELECT *, greatest(trip_distance_km
      / CAST(CASE traffic_level WHEN 'Low' THEN 45 WHEN 'Medium' THEN 28 ELSE 15 END AS DOUBLE) * 60, 0.5)
      AS predicted
  FROM feats)"""
ORDINAL = "CASE traffic_level WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 ELSE 1 END"
REQUESTS = """requests AS (
  SELECT k AS request_id,
    CASE l_suppkey % 50 WHEN 7 THEN 'NonExistentCity' WHEN 8 THEN '  ' || p.name || ' ' ELSE p.name END
      AS pickup_location,
    d.name AS drop_location,
    CASE WHEN l_linenumber = 6 THEN strftime(l_shipdate, '%d-%m-%Y')
         ELSE strftime(l_shipdate, '%Y-%m-%d') END AS pickup_date,
    CASE l_partkey % 100 WHEN 3 THEN '25:61' WHEN 4 THEN '8:15'
      ELSE lpad(CAST(hh AS VARCHAR), 2, '0') || ':' || lpad(CAST(mi AS VARCHAR), 2, '0') END AS pickup_time,
    CAST(CASE WHEN l_linenumber = 5 THEN NULL WHEN l_linenumber = 4 AND l_partkey % 10 = 0 THEN 9
      ELSE l_linenumber END AS INTEGER) AS passenger_count,
    round(1.0 + l_discount * 50, 1) AS surge_multiplier
  FROM base JOIN loc p ON p.idx = l_suppkey % 22 JOIN loc d ON d.idx = l_partkey % 22)"""
CHECKED = f"""trimmed AS (
  SELECT * REPLACE (trim(pickup_location) AS pickup_location, trim(drop_location) AS drop_location,
    trim(pickup_date) AS pickup_date, trim(pickup_time) AS pickup_time) FROM requests),
checked AS (
  SELECT *, concat_ws(',',
    CASE WHEN pickup_location NOT IN (SELECT name FROM loc) THEN 'pickup_location' END,
    CASE WHEN drop_location NOT IN (SELECT name FROM loc) THEN 'drop_location' END,
    CASE WHEN try_strptime(pickup_date, '%Y-%m-%d') IS NULL THEN 'pickup_date' END,
    CASE WHEN try_strptime(pickup_time, '%H:%M') IS NULL THEN 'pickup_time' END,
    CASE WHEN passenger_count NOT BETWEEN 1 AND 8 THEN 'passenger_count' END,
    CASE WHEN surge_multiplier NOT BETWEEN 1 AND 5 THEN 'surge_multiplier' END) AS reasons
  FROM trimmed)"""
DISTANCE = """6371.0 * 2 * atan2(sqrt({a}), sqrt(1 - ({a})))"""
_A = (
    "pow(sin((radians(d.lat) - radians(p.lat)) / 2), 2) + cos(radians(p.lat)) * cos(radians(d.lat))"
    " * pow(sin((radians(d.lon) - radians(p.lon)) / 2), 2)"
)
KM = f"coalesce(round({DISTANCE.format(a=_A)}, 3), 1.0)"
REQFEATS = f"""reqdated AS (
  SELECT *, strptime(pickup_date, '%Y-%m-%d') AS dt, strptime(pickup_time, '%H:%M') AS tm
  FROM checked WHERE reasons = ''),
reqcal AS (
  SELECT * EXCLUDE (dt, tm, reasons, passenger_count, surge_multiplier),
    CAST(month(dt) AS INTEGER) AS month, CAST(day(dt) AS INTEGER) AS day,
    CAST(dayofyear(dt) AS INTEGER) AS day_of_year, dayname(dt) AS weekday,
    CAST(isodow(dt) >= 6 AS INTEGER) AS is_weekend,
    CAST(hour(tm) AS INTEGER) AS pickup_hour, CAST(minute(tm) AS INTEGER) AS pickup_minute,
    CASE WHEN month(dt) IN (12, 1, 2) THEN 'Winter' WHEN month(dt) <= 5 THEN 'Spring'
         WHEN month(dt) <= 8 THEN 'Summer' ELSE 'Fall' END AS season,
    coalesce(nullif(passenger_count, 0), 1) AS passenger_count,
    coalesce(nullif(surge_multiplier, 0), 1.0) AS surge_multiplier
  FROM reqdated),
reqfeats AS (
  SELECT r.*, {KM} AS trip_distance_km,
    CASE WHEN is_weekend = 1 THEN CASE WHEN pickup_hour BETWEEN 11 AND 18 THEN 'Medium' ELSE 'Low' END
         WHEN pickup_hour BETWEEN 7 AND 10 OR pickup_hour BETWEEN 16 AND 19 THEN 'High'
         WHEN pickup_hour BETWEEN 11 AND 15 THEN 'Medium' ELSE 'Low' END AS traffic_level
  FROM reqcal r LEFT JOIN loc p ON p.name = pickup_location LEFT JOIN loc d ON d.name = drop_location)"""
LOG = """log AS (
  SELECT event_id, ts, CASE WHEN user_id % 2 = 0 THEN '/predict' ELSE '/predict/batch' END AS endpoint,
    CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
    CASE WHEN event_type <> 'error' THEN greatest(value, 0.5) END AS predicted_eta_minutes,
    CASE WHEN event_type <> 'error' AND event_id % 10 <> 0
      THEN greatest(value, 0.5) * (90 + event_id % 21) / CAST(100 AS DOUBLE) END AS actual_eta_minutes,
    CASE WHEN event_type <> 'error' AND event_id % 10 <> 0
      THEN ts + to_minutes(event_id % 180) END AS actual_ts
  FROM events)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def on_trips(body: str, *more: str) -> str:
    return with_ctes(LOC, BASE, TRIPS, *more) + body


def on_clean(body: str, *more: str) -> str:
    return on_trips(body, STANDARD, CLEANED, *more)


def on_feats(body: str, *more: str) -> str:
    return on_clean(body, FEATS, SCORED, *more)


def on_requests(body: str, *more: str) -> str:
    return with_ctes(LOC, BASE, REQUESTS, *more) + body


def on_log(body: str, *more: str) -> str:
    return with_ctes(LOG, *more) + body


def metrics(group: str = "") -> str:
    lead = f"{group}, " if group else ""
    tail = f" GROUP BY {group}" if group else ""
    e = "(actual_eta_minutes - predicted)"
    return (
        f"SELECT {lead}round(1 - avg({e} * {e}) / var_pop(actual_eta_minutes), 6) AS r2,"
        f" round(avg(abs{e}), 6) AS mae, round(sqrt(avg({e} * {e})), 6) AS rmse,"
        f" round(avg(abs{e} / greatest(abs(actual_eta_minutes), 2.220446049250313e-16)), 6) AS mape,"
        f" count(*) AS n FROM scored{tail}"
    )


def equal_width(source: str, column: str, bins: int) -> str:
    """CTEs for an equal-width histogram of ``column`` of ``source``; the result is ``hist``."""
    edge = "CASE WHEN {i} = %d THEN hi ELSE lo + ({i}) * ((hi - lo) / %d) END" % (bins, bins)
    return f"""ends AS (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}),
rough AS (SELECT {column} AS v, lo, hi,
    least(CAST(floor(({column} - lo) / (hi - lo) * {bins}) AS INTEGER), {bins - 1}) AS b
  FROM {source}, ends WHERE {column} IS NOT NULL),
binned AS (SELECT CASE WHEN v < {edge.format(i='b')} THEN b - 1
    WHEN b < {bins - 1} AND v >= {edge.format(i='b + 1')} THEN b + 1 ELSE b END AS bin
  FROM rough),
counted AS (SELECT bin, count(*) AS n FROM binned GROUP BY bin),
hist AS (SELECT CAST(i AS INTEGER) AS bin, round({edge.format(i='i')}, 6) AS lower,
    round({edge.format(i='(i + 1)')}, 6) AS upper, coalesce(n, 0) AS n
  FROM range({bins}) r(i) CROSS JOIN ends LEFT JOIN counted ON bin = i)"""


def cumulative(source: str, column: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT {text(str(b))} AS le, count(*) FILTER ({column} <= {b}) AS cumulative FROM {source}"
        for b in ETA_BOUNDS
    )
    return (
        f"SELECT le, cumulative, round(total, 4) AS total_minutes, n FROM ({rows} UNION ALL"
        f" SELECT '+Inf', count({column}) FROM {source})"
        f" CROSS JOIN (SELECT sum({column}) AS total, count({column}) AS n FROM {source})"
    )


def sides(kind: str) -> str:
    """``sides``: the drift columns with the flag ``cur``.

    ``split``: train rows against changed test rows. ``copy``: all test rows against themselves, changed.
    """
    rush = "(pickup_hour BETWEEN 16 AND 20 OR is_weekend = 1)"
    plain = [c for c in NUMERIC if c != "traffic_level"]
    return f"""numeric_rows AS (
  SELECT {names(plain)}, {ORDINAL} AS traffic_level, actual_eta_minutes, is_test FROM feats),
changed AS (
  SELECT * REPLACE (least(greatest(traffic_level + 1, 0), 2) AS traffic_level,
    (CASE WHEN {rush} THEN actual_eta_minutes * CAST(1.5 AS DOUBLE) ELSE actual_eta_minutes END)
      * CAST(1.15 AS DOUBLE) AS actual_eta_minutes)
  FROM numeric_rows WHERE is_test),
sides AS (
  SELECT *, false AS cur FROM numeric_rows WHERE {'NOT is_test' if kind == 'split' else 'is_test'}
  UNION ALL SELECT *, true AS cur FROM changed)"""


def ks(columns=DRIFT_COLUMNS) -> str:
    """``ks``: one row per drift column from ``sides``."""
    long = " UNION ALL ".join(
        f"SELECT {i} AS position, {text(c)} AS feature, CAST({ident(c)} AS DOUBLE) AS v, cur FROM sides"
        for i, c in enumerate(columns)
    )
    return f"""long AS ({long}),
vals AS (SELECT position, feature, v, count(*) FILTER (NOT cur) AS r, count(*) FILTER (cur) AS c
  FROM long GROUP BY ALL),
tots AS (SELECT position, feature, CAST(sum(r) AS BIGINT) AS rn, CAST(sum(c) AS BIGINT) AS cn,
    sum(v * r) / sum(r) AS ra, sum(v * c) / sum(c) AS ca FROM vals GROUP BY ALL),
runs AS (SELECT position, feature, rn, cn, ra, ca,
    abs(sum(r) OVER w / CAST(rn AS DOUBLE) - sum(c) OVER w / CAST(cn AS DOUBLE)) AS gap,
    lead(v) OVER w - v AS step
  FROM vals JOIN tots USING (position, feature)
  WINDOW w AS (PARTITION BY position ORDER BY v)),
dist AS (SELECT position, feature, rn, cn, ra, ca, max(gap) AS d, coalesce(sum(gap * step), 0) AS wd
  FROM runs GROUP BY ALL),
series AS (SELECT position, sum((CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END)
    * exp(-2.0 * k * k * (CAST(rn AS DOUBLE) * cn / (rn + cn)) * d * d)) AS s
  FROM dist CROSS JOIN range(1, 101) t(k) GROUP BY position),
ks AS (SELECT *, CASE WHEN sqrt(CAST(rn AS DOUBLE) * cn / (rn + cn)) * d < 0.2 THEN 1.0
    ELSE least(greatest(2 * s, 0), 1) END AS p
  FROM dist JOIN series USING (position)),
roll AS (SELECT count(*) AS tested, count(*) FILTER (p < 0.05) AS drifted,
    coalesce(string_agg(feature, ',' ORDER BY position) FILTER (p < 0.05), '') AS names FROM ks)"""


def _one_hot_columns(column: str, values) -> str:
    return ", ".join(
        f"CASE WHEN {column} = {text(v)} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {ident(column + '_' + v)}"
        for v in sorted(values)[1:]
    )


FREQUENT = LOCATION_NAMES[:22]
ONE_HOT = {
    "pickup_location": (*FREQUENT, "Other"),
    "drop_location": (*FREQUENT, "Other"),
    "weekday": ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"),
    "season": ("Winter", "Spring", "Summer", "Fall"),
}
DUMMIES = ",\n".join(_one_hot_columns(c, v) for c, v in ONE_HOT.items())
GROUPED = """grouped AS (
  SELECT f.* REPLACE (
    CASE WHEN count(*) OVER (PARTITION BY pickup_location) < 20 THEN 'Other' ELSE pickup_location END
      AS pickup_location,
    CASE WHEN count(*) OVER (PARTITION BY drop_location) < 20 THEN 'Other' ELSE drop_location END
      AS drop_location)
  FROM feats f)"""
NUMERIC_DOUBLES = ", ".join(
    f"CAST({ORDINAL if c == 'traffic_level' else c} AS DOUBLE) AS {c}" for c in NUMERIC
)


def statements() -> dict[str, str]:
    out: dict[str, str] = {}

    # Cleaning and validation
    out["clean_trips"] = on_clean("SELECT * FROM cleaned")
    out["dedupe_rows"] = on_trips("SELECT DISTINCT * FROM standard", STANDARD)
    out["clean_accounting"] = on_trips(
        """SELECT CAST(sum(n) AS BIGINT) AS initial_rows, CAST(sum(n) - count(*) AS BIGINT) AS duplicate_rows,
  count(*) FILTER (fate = 1) AS missing_rows, count(*) FILTER (fate = 2) AS target_out_of_range_rows,
  count(*) FILTER (fate = 3) AS bad_passenger_count_rows,
  count(*) FILTER (fate = 4) AS bad_trip_distance_km_rows,
  count(*) FILTER (fate = 0) AS kept_rows,
  CAST(sum(n) - count(*) FILTER (fate = 0) AS BIGINT) AS dropped_rows
FROM (SELECT n, CASE WHEN actual_eta_minutes IS NULL THEN 1
    WHEN actual_eta_minutes NOT BETWEEN 0.5 AND 200 THEN 2
    WHEN passenger_count <= 0 THEN 3 WHEN trip_distance_km <= 0 THEN 4 ELSE 0 END AS fate
  FROM (SELECT *, count(*) AS n FROM standard GROUP BY ALL))""",
        STANDARD,
    )
    out["duplicate_report"] = on_trips(
        "SELECT 'duplicate_rows' AS \"check\", '*' AS subject, (SELECT count(*) FROM standard)"
        " - (SELECT count(*) FROM (SELECT DISTINCT * FROM standard)) AS n UNION ALL "
        + " UNION ALL ".join(
            f"SELECT 'missing', {text(c)}, count(*) FILTER ({c} IS NULL) FROM standard" for c in CLEAN_COLUMNS
        ),
        STANDARD,
    )
    trip_columns = ("trip_id", *CLEAN_COLUMNS)
    issue_sql = (
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT 'missing_value' AS \"check\", {text(c)} AS subject, count(*) FILTER ({c} IS NULL) AS n"
            " FROM trips"
            for c in trip_columns
        )
        + " UNION ALL SELECT 'target_out_of_range', 'actual_eta_minutes',"
        " count(*) FILTER (actual_eta_minutes NOT BETWEEN 0.5 AND 200) FROM trips) WHERE n > 0"
    )
    out["dataset_issues"] = on_trips(issue_sql)
    out["validation_messages"] = on_trips(
        "SELECT CASE \"check\" WHEN 'missing_value' THEN 'Found ' || n || ' missing values in column ''' || subject"
        " || '''' ELSE 'Found ' || n || ' rows with ''' || subject || ''' outside [0.5, 200.0]' END AS message"
        f" FROM ({issue_sql})"
    )
    labelled = """labelled AS (SELECT *, CASE passenger_count WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' WHEN 3 THEN 'High'
    ELSE CASE WHEN passenger_count IS NOT NULL THEN 'Standstill' END END AS traffic_level,
    surge_multiplier * 50 AS actual_eta_minutes FROM requests)"""
    columns = ("request_id", "pickup_location", "drop_location", "pickup_date", "pickup_time",
               "passenger_count", "surge_multiplier", "traffic_level", "actual_eta_minutes")
    out["dataset_issues_strict"] = on_requests(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT 'missing_value' AS \"check\", {text(c)} AS subject, count(*) FILTER ({c} IS NULL) AS n"
            " FROM labelled"
            for c in columns
        )
        + """ UNION ALL SELECT 'target_out_of_range', 'actual_eta_minutes',
  count(*) FILTER (actual_eta_minutes NOT BETWEEN 0.5 AND 200) FROM labelled
UNION ALL SELECT 'unexpected_traffic', coalesce(traffic_level, 'null'), count(*) FROM labelled
  WHERE traffic_level IS NULL OR traffic_level NOT IN ('Low', 'Medium', 'High') GROUP BY traffic_level
UNION ALL SELECT 'unknown_pickup', pickup_location, count(*) FROM labelled
  WHERE pickup_location NOT IN (SELECT name FROM loc) GROUP BY pickup_location
UNION ALL SELECT 'unknown_drop', drop_location, count(*) FROM labelled
  WHERE drop_location NOT IN (SELECT name FROM loc) GROUP BY drop_location) WHERE n > 0""",
        labelled,
    )
    out["missing_columns"] = " UNION ALL ".join(
        f"SELECT 'missing_column' AS \"check\", {text(c)} AS subject, CAST(1 AS BIGINT) AS n,"
        " (SELECT count(*) FROM lineitem) AS rows"
        for c in REQUIRED_COLUMNS if c in ("traffic_level", TARGET)
    )
    out["unknown_places"] = on_requests(
        "SELECT DISTINCT pickup_location AS value FROM requests WHERE pickup_location NOT IN (SELECT name FROM loc)"
    )
    out["request_valid"] = on_requests("SELECT * EXCLUDE (reasons) FROM checked WHERE reasons = ''", CHECKED)
    out["request_quarantine"] = on_requests("SELECT * FROM checked WHERE reasons <> ''", CHECKED)
    out["batch_coercion"] = on_requests(
        """SELECT request_id,
  CASE WHEN pickup_location IN (SELECT name FROM loc) THEN pickup_location ELSE 'Upper West Side' END AS pickup_location,
  CASE WHEN drop_location IN (SELECT name FROM loc) THEN drop_location ELSE 'Harlem' END AS drop_location,
  CASE WHEN length(d) = 10 THEN d ELSE '2026-08-27' END AS pickup_date,
  CASE WHEN length(pickup_time) >= 5 THEN pickup_time[:5] ELSE '12:00' END AS pickup_time,
  coalesce(passenger_count, 1) AS passenger_count, coalesce(surge_multiplier, 1.0) AS surge_multiplier
FROM (SELECT *, coalesce(strftime(try_strptime(pickup_date, '%d-%m-%Y'), '%Y-%m-%d'), pickup_date) AS d FROM requests)"""
    )
    out["same_place_trips"] = on_trips(
        "SELECT pickup_location, count(*) AS n FROM trips WHERE pickup_location = drop_location GROUP BY ALL"
    )

    # Features
    feature_columns = ("month", "day", "day_of_year", "weekday", "is_weekend", "season",
                       "pickup_hour", "pickup_minute")
    out["temporal_features"] = on_feats(f"SELECT {names(CLEAN_COLUMNS)}, {names(c for c in feature_columns if c != 'season')} FROM feats")
    out["haversine_distance"] = on_trips(
        f"SELECT trip_id, t.pickup_location, t.drop_location, {KM} AS km FROM trips t"
        " LEFT JOIN loc p ON p.name = t.pickup_location LEFT JOIN loc d ON d.name = t.drop_location"
    )
    out["haversine_unknown_place"] = on_requests(
        f"SELECT request_id, {KM} AS km FROM requests t"
        " LEFT JOIN loc p ON p.name = t.pickup_location LEFT JOIN loc d ON d.name = t.drop_location"
    )
    out["traffic_ordinal"] = on_trips(
        f"SELECT traffic_level, {ORDINAL} AS ordinal, count(*) AS n FROM trips GROUP BY ALL"
    )
    out["traffic_by_clock"] = on_requests(
        "SELECT pickup_hour, is_weekend, traffic_level, count(*) AS n FROM reqfeats GROUP BY ALL", CHECKED, REQFEATS
    )
    out["request_defaults"] = on_requests(
        "SELECT request_id, coalesce(nullif(passenger_count, 0), 1) AS passenger_count,"
        " coalesce(nullif(surge_multiplier, 0), 1.0) AS surge_multiplier FROM requests"
    )
    out["location_frequency"] = on_clean(
        "SELECT 'pickup_location' AS \"column\", pickup_location AS value, count(*) AS n FROM cleaned GROUP BY ALL"
        " UNION ALL SELECT 'drop_location', drop_location, count(*) FROM cleaned GROUP BY ALL"
    )
    out["rare_locations"] = on_clean(
        "SELECT 'pickup_location' AS \"column\", pickup_location AS value, count(*) AS n FROM cleaned GROUP BY ALL"
        " HAVING count(*) < 20 UNION ALL SELECT 'drop_location', drop_location, count(*) FROM cleaned"
        " GROUP BY ALL HAVING count(*) < 20"
    )
    out["rare_grouped"] = on_feats(f"SELECT {names(CLEAN_COLUMNS)} FROM grouped", GROUPED)
    out["train_test_split"] = on_feats(f"SELECT {names(CLEAN_COLUMNS)}, is_test FROM feats")
    out["exact_split"] = on_clean(
        f"SELECT is_test, count(*) AS n, round(sum(actual_eta_minutes), 4) AS total FROM (SELECT *,"
        f" row_number() OVER (ORDER BY md5(concat_ws('|', {names(CLEAN_COLUMNS)})))"
        " <= ceil(0.2 * (SELECT count(*) FROM cleaned)) AS is_test FROM cleaned) GROUP BY ALL"
    )
    out["one_hot"] = on_feats(f"SELECT {DUMMIES}, is_test FROM grouped", GROUPED)
    out["training_features"] = on_feats(
        f"SELECT {NUMERIC_DOUBLES}, {DUMMIES}, actual_eta_minutes, is_test FROM grouped", GROUPED
    )
    out["request_feature_vector"] = on_requests(
        f"SELECT request_id, {NUMERIC_DOUBLES}, {DUMMIES} FROM reqfeats", CHECKED, REQFEATS
    )
    out["union_append"] = on_trips(
        "SELECT * EXCLUDE (copied) REPLACE (CASE WHEN copied THEN NULL ELSE time_of_day END AS time_of_day) FROM once"
    )

    # Metrics
    out["baseline_metrics"] = on_feats(metrics())
    out["metrics_by_traffic"] = on_feats(metrics("traffic_level"))
    out["evaluation_report"] = on_feats(
        "SELECT round(r2, 4) AS test_r2, round(rmse, 4) AS test_rmse, round(mae, 4) AS test_mae,"
        f" round(mape * 100, 2) AS test_mape_percent, n AS num_test_samples FROM (SELECT * FROM ({metrics()}))"
        .replace(", 6)", ", 12)")
    )
    board = (
        "cand AS (SELECT 0 AS ord, 'TrafficSpeed' AS model, actual_eta_minutes AS y, predicted AS p FROM scored"
        " UNION ALL SELECT 1, 'OneSpeed', actual_eta_minutes, trip_distance_km / 28.0::DOUBLE * 60 FROM scored"
        " UNION ALL SELECT 2, 'OneDuration', actual_eta_minutes, 20.0 FROM scored"
        " UNION ALL SELECT 3, 'Copy', actual_eta_minutes, predicted FROM scored),"
        " board AS (SELECT ord, model, 1 - avg((y - p) * (y - p)) / var_pop(y) AS r2,"
        " sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae FROM cand GROUP BY ALL)"
    )
    out["candidate_leaderboard"] = on_feats(
        "SELECT model, round(r2, 6) AS test_r2, round(rmse, 6) AS test_rmse, round(mae, 6) AS test_mae FROM board",
        board,
    )
    out["best_candidate"] = on_feats(
        "SELECT model, CAST(ord AS INTEGER) AS ord, round(rmse, 6) AS rmse FROM board"
        " ORDER BY round(rmse, 9), ord LIMIT 1",
        board,
    )
    out["residual_table"] = on_feats(
        "SELECT actual_eta_minutes, round(predicted, 6) AS predicted,"
        " round(actual_eta_minutes - predicted, 6) AS residual FROM scored"
    )
    out["residual_histogram"] = on_feats(
        "SELECT * FROM hist",
        "resid AS (SELECT actual_eta_minutes - predicted AS residual FROM scored)",
        equal_width("resid", "residual", 40),
    )
    out["eta_histogram"] = on_feats("SELECT * FROM hist", equal_width("scored", "predicted", 25))
    out["bucket_histogram"] = on_feats(cumulative("scored", "predicted"))
    out["batch_summary"] = on_clean(
        "SELECT count(*) AS rows, round(avg(actual_eta_minutes), 6) AS mean_minutes,"
        " round(stddev_samp(actual_eta_minutes), 6) AS std_minutes, round(avg(surge_multiplier), 6) AS mean_surge,"
        " round(avg(CASE WHEN traffic_level = 'High' THEN 1.0 ELSE 0.0 END) * 100, 6) AS high_traffic_percent"
        " FROM cleaned"
    )
    out["score_summary"] = on_feats(
        "SELECT round(avg(predicted), 6) AS mean_predicted, round(min(predicted), 6) AS min_predicted,"
        " round(max(predicted), 6) AS max_predicted FROM scored"
    )
    minutes = (
        "greatest(trip_distance_km / CAST(CASE traffic_level WHEN 'Low' THEN 45 WHEN 'Medium' THEN 28"
        " ELSE 15 END AS DOUBLE) * 60, 0.5)"
    )
    out["score_responses"] = on_requests(
        f"SELECT request_id, true AS success, {half_up(minutes, 2)} AS eta_minutes,"
        f" {half_up(minutes + ' * 60', 1)} AS eta_seconds, trip_distance_km AS calculated_distance_km,"
        " traffic_level AS estimated_traffic_level, pickup_location, drop_location, pickup_date, pickup_time"
        " FROM reqfeats",
        CHECKED, REQFEATS,
    )
    logged = (
        "SELECT request_id, pickup_location, drop_location, pickup_date, pickup_time,"
        f" trip_distance_km AS distance_km, traffic_level, {half_up(minutes, 2)} AS predicted_eta_minutes,"
        " CAST(NULL AS DOUBLE) AS actual_eta_minutes FROM reqfeats"
    )
    out["prediction_log_append"] = on_requests(logged, CHECKED, REQFEATS)
    out["stream_scored"] = out["prediction_log_append"]
    out["request_counters"] = on_log("SELECT status, endpoint, count(*) AS n FROM log GROUP BY ALL")
    per_minute = (
        "SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start, status, endpoint,"
        " count(*) AS n, round(count(*) / 60.0, 6) AS per_second FROM log GROUP BY ALL"
    )
    out["requests_per_minute"] = on_log(per_minute)
    out["stream_counts"] = out["requests_per_minute"]

    def rates(c: str) -> str:
        ends = "least(CASE WHEN f - lo < 1.1 * d / (n - 1) THEN f - lo ELSE d / (n - 1) / 2 END, CASE WHEN inc > 0 THEN d * v0 / inc ELSE 'inf'::DOUBLE END)"
        tail = "CASE WHEN hi - l < 1.1 * d / (n - 1) THEN hi - l ELSE d / (n - 1) / 2 END"
        return f"""{c}_rates AS (SELECT endpoint, w, inc * (d + {ends} + {tail}) / d AS increase FROM (
  SELECT endpoint, w, sum(step) AS inc, count(*) AS n, min(t) AS f, max(t) AS l, max(t) - min(t) AS d, arg_min(v, t) AS v0,
    epoch_us(w) / 1e6 AS lo, epoch_us(w) / 1e6 + 21600 AS hi FROM (
    SELECT endpoint, w, t, v, CASE WHEN p IS NULL THEN 0 WHEN v < p THEN v ELSE v - p END AS step FROM (
      SELECT *, lag(v) OVER (PARTITION BY endpoint, w ORDER BY t) AS p FROM (
        SELECT endpoint, time_bucket(INTERVAL 6 HOURS, ts) AS w, epoch_us(ts) / 1e6 AS t, max({c}) AS v FROM shown GROUP BY ALL)))
  GROUP BY endpoint, w HAVING count(*) > 1))"""

    out["counter_rates"] = on_log(
        "SELECT endpoint, strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, round(r.increase, 4) AS requests_increase,"
        " round(m.increase, 4) AS minutes_increase, round(round(m.increase, 4) / nullif(round(r.increase, 4), 0), 6) AS mean_minutes"
        " FROM requests_rates r JOIN minutes_rates m USING (endpoint, w)",
        """shown AS (SELECT endpoint, ts, CAST(row_number() OVER o AS DOUBLE) AS requests, sum(predicted_eta_minutes) OVER o AS minutes
  FROM log WHERE predicted_eta_minutes IS NOT NULL
  WINDOW o AS (PARTITION BY endpoint, CAST(ts - INTERVAL 3 HOURS AS DATE) ORDER BY ts, event_id))""",
        rates("requests"), rates("minutes"),
    )
    closed = "FROM log WHERE date_trunc('minute', ts) + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM log) - INTERVAL 10 MINUTES"
    out["stream_counts_closed"] = on_log(per_minute.replace("FROM log", closed))
    sliding = (
        "SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, le, cumulative FROM ("
        + " UNION ALL ".join(
            f"SELECT w, {text(str(b))} AS le, count(*) FILTER (x <= {b}) AS cumulative FROM spread GROUP BY w"
            for b in ETA_BOUNDS
        )
        + " UNION ALL SELECT w, '+Inf', count(*) FROM spread GROUP BY w)"
    )
    spread = """spread AS (SELECT date_trunc('minute', ts) - to_minutes(i) AS w, predicted_eta_minutes AS x
  FROM log CROSS JOIN range(5) r(i) WHERE predicted_eta_minutes IS NOT NULL)"""
    out["sliding_histogram"] = on_log(sliding, spread)
    out["stream_histogram"] = out["sliding_histogram"]
    shut = spread.replace("IS NOT NULL)", "IS NOT NULL AND date_trunc('minute', ts) - to_minutes(i) + INTERVAL 5 MINUTE"
                          " <= (SELECT max(ts) FROM log) - INTERVAL 10 MINUTES)")
    out["stream_histogram_closed"] = on_log(sliding, shut)
    monitored = """SELECT round(1 - avg(e * e) / var_pop(a), 6) AS r2, round(avg(abs(e)), 6) AS mae,
  round(sqrt(avg(e * e)), 6) AS rmse, round(avg(abs(e) / greatest(abs(a), 2.220446049250313e-16)), 6) AS mape, count(*) AS n
FROM (SELECT x.actual_eta_minutes AS a, x.actual_eta_minutes - p.predicted_eta_minutes AS e
  FROM log p JOIN log x USING (event_id)
  WHERE p.predicted_eta_minutes IS NOT NULL AND x.actual_ts BETWEEN p.ts AND p.ts + INTERVAL 4 HOURS)"""
    out["coverage_by_window"] = out["stream_coverage"] = on_log(
        """SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS predictions, count(a) AS matched,
  round(count(a) / count(*)::DOUBLE, 6) AS coverage, round(sqrt(avg((a - p) * (a - p))), 6) AS rmse
FROM (SELECT date_trunc('hour', ts) AS w, predicted_eta_minutes AS p,
    CASE WHEN actual_ts BETWEEN ts AND ts + INTERVAL 4 HOURS THEN actual_eta_minutes END AS a FROM log WHERE predicted_eta_minutes IS NOT NULL)
WHERE w + INTERVAL 5 HOURS < (SELECT max(ts) FROM log WHERE predicted_eta_minutes IS NOT NULL) - INTERVAL 11 MINUTES GROUP BY w"""
    )
    out["monitored_rmse"] = on_log(monitored)
    out["stream_monitored_rmse"] = out["monitored_rmse"]
    spread_of = "CASE WHEN var_pop(a) > 0 THEN 1 - avg(e * e) / var_pop(a) WHEN avg(e * e) = 0 THEN 1.0 ELSE 0.0 END"
    out["monitored_by_window"] = on_log(
        monitored.replace("SELECT round(1 - avg(e * e) / var_pop(a), 6)", f"SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, round({spread_of}, 6)")
        .replace("FROM (SELECT x.actual", "FROM (SELECT date_trunc('hour', p.ts) AS w, x.actual") + " GROUP BY w"
    )
    out["stream_monitored_by_window"] = out["monitored_by_window"]
    out["sample_trips"] = on_trips("SELECT * FROM trips ORDER BY trip_id LIMIT 50")

    # Drift and policy
    records = (
        "SELECT CAST(position AS INTEGER) AS position, feature, p < 0.05 AS drift_detected, round(p, 5) AS p_value,"
        " round(d, 5) AS ks_statistic, round(ra, 3) AS ref_mean, round(ca, 3) AS curr_mean,"
        " round(wd, 5) AS wasserstein, rn AS ref_rows, cn AS curr_rows FROM ks"
    )
    summary = (
        "SELECT drifted / tested >= 0.3 AS dataset_drift_detected, round(drifted / tested, 4) AS drift_share,"
        " drifted AS drifted_features_count, names AS drifted_features, tested AS total_features_tested FROM roll"
    )
    out["ks_features"] = on_feats(records, sides("split"), ks())
    out["ks_features_sliced"] = out["ks_features"]
    dummy_columns = [f"{c}_{v}" for c, values in ONE_HOT.items() for v in sorted(values)[1:]]
    out["drift_all_columns"] = on_feats(
        summary,
        GROUPED,
        f"sides AS (SELECT {NUMERIC_DOUBLES}, {DUMMIES}, actual_eta_minutes, is_test AS cur FROM grouped)",
        ks([*NUMERIC, *dummy_columns, TARGET]),
    )
    out["ks_features_auto"] = out["ks_features"]
    out["drift_report"] = on_feats(
        "SELECT 'train' AS reference_dataset, 'test' AS current_dataset,"
        " (SELECT count(*) FROM sides WHERE NOT cur) AS reference_rows,"
        " (SELECT count(*) FROM sides WHERE cur) AS current_rows, s.*, feature, p < 0.05 AS drift_detected,"
        " round(p, 5) AS p_value, round(d, 5) AS ks_statistic, round(ra, 3) AS ref_mean, round(ca, 3) AS curr_mean"
        f" FROM ks CROSS JOIN ({summary}) s",
        f"sides AS (SELECT {NUMERIC_DOUBLES}, actual_eta_minutes, is_test AS cur FROM feats)",
        ks(),
    )
    out["drift_summary"] = on_feats(summary, sides("split"), ks())
    out["stream_drift"] = out["drift_summary"]
    out["chi_square_drift"] = on_feats(
        """SELECT feature, round(statistic, 6) AS statistic, degrees, round(least(CASE WHEN degrees % 2 = 1 THEN
    1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 90), lambda n: CASE WHEN n % 2 = 1 THEN -1 ELSE 1 END
      * exp((2 * n + 1) * ln(sqrt(h)) - lgamma(n + 1)) / (2 * n + 1))) ELSE 0 END
    + coalesce(list_sum(list_transform(range(0, degrees // 2), lambda k: exp((k + degrees % 2 * 0.5) * ln(h) - h - lgamma(k + degrees % 2 * 0.5 + 1)))), 0), 1), 5) AS p_value
FROM (SELECT *, statistic / 2 AS h FROM (SELECT feature, sum(power(r - er, 2) / er + power(c - ec, 2) / ec) AS statistic,
  count(*) - 1 AS degrees FROM (
  SELECT feature, r, c, (r + c) * CAST(rn AS DOUBLE) / (rn + cn) AS er, (r + c) * CAST(cn AS DOUBLE) / (rn + cn) AS ec
  FROM cats JOIN (SELECT feature, sum(r) AS rn, sum(c) AS cn FROM cats GROUP BY feature) USING (feature))
GROUP BY feature))""",
        "cats AS ("
        + " UNION ALL ".join(
            f"SELECT {text(c)} AS feature, {c} AS v, count(*) FILTER (NOT is_test) AS r,"
            f" count(*) FILTER (is_test) AS c FROM feats GROUP BY {c}"
            for c in ("pickup_location", "drop_location", "weekday", "season", "traffic_level")
        )
        + ")",
    )
    moved = "CASE WHEN is_test THEN actual_eta_minutes * CAST(1.5 AS DOUBLE) ELSE actual_eta_minutes END"
    longs = [
        f"SELECT {text(c)} AS feature, CAST({moved if c == 'actual_eta_minutes' else c} AS DOUBLE) AS v, NULL AS label, is_test AS cur FROM feats"
        for c in ("pickup_hour", "trip_distance_km", "passenger_count", "is_weekend", "actual_eta_minutes")
    ] + [
        f"SELECT {text(c)}, NULL, {c}, is_test FROM feats" for c in ("pickup_location", "drop_location", "weekday", "season", "traffic_level")
    ]
    out["drift_by_kind"] = on_feats(
        """SELECT feature, kind, CASE WHEN kind = 'numbers' THEN 'wasserstein' ELSE 'jensen_shannon' END AS test,
  round(CASE WHEN kind = 'numbers' THEN w ELSE js END, 6) AS value, CASE WHEN kind = 'numbers' THEN w ELSE js END >= 0.1 AS drift_detected,
  round(js, 6) AS jensen_shannon, round(w, 6) AS wasserstein,
  round(CASE WHEN kind = 'two-valued' THEN (q - p) / sqrt(pp * (1 - pp) * (1 / rn + 1 / cn)) END, 6) AS z
FROM kinds JOIN (
    SELECT feature, sqrt(greatest(sum(CASE WHEN r > 0 THEN r / rn * log2(2 * (r / rn) / (r / rn + c / cn)) ELSE 0 END
      + CASE WHEN c > 0 THEN c / cn * log2(2 * (c / cn) / (r / rn + c / cn)) ELSE 0 END) / 2, 0)) AS js
    FROM (SELECT feature, rn, cn, CAST(sum(r) AS DOUBLE) AS r, CAST(sum(c) AS DOUBLE) AS c FROM (
      SELECT *, CASE WHEN kind = 'numbers' THEN CAST(least(floor((v - low) / ((high - low) / 30)), 29) AS VARCHAR)
        ELSE coalesce(label, CAST(v AS VARCHAR)) END AS cell FROM vals JOIN kinds USING (feature)) GROUP BY feature, rn, cn, cell)
    GROUP BY feature) USING (feature)
  LEFT JOIN (SELECT feature, sum(gap * step) / any_value(sd) AS w FROM (
    SELECT feature, sd, abs(sum(r) OVER o / rn - sum(c) OVER o / cn) AS gap, lead(v) OVER o - v AS step
    FROM vals JOIN kinds USING (feature) WHERE kind = 'numbers' WINDOW o AS (PARTITION BY feature ORDER BY v)) GROUP BY feature) USING (feature)""",
        "long AS (" + " UNION ALL ".join(longs) + "),"
        """vals AS (SELECT feature, v, label, count(*) FILTER (NOT cur) AS r, count(*) FILTER (cur) AS c FROM long GROUP BY ALL),
kinds AS (SELECT *, CASE WHEN n = 2 THEN 'two-valued' WHEN is_text OR n <= 5 THEN 'categories' ELSE 'numbers' END AS kind,
    tr / rn AS p, tc / cn AS q, (tr + tc) / (rn + cn) AS pp FROM (
  SELECT feature, CAST(sum(r) AS DOUBLE) AS rn, CAST(sum(c) AS DOUBLE) AS cn, count(*) AS n, bool_or(label IS NOT NULL) AS is_text,
    min(v) AS low, max(v) AS high, sqrt(greatest(sum(v * v * r) / sum(r) - power(sum(v * r) / sum(r), 2), 0)) AS sd,
    CAST(arg_max(r, coalesce(v, 0)) AS DOUBLE) AS tr, CAST(arg_max(c, coalesce(v, 0)) AS DOUBLE) AS tc
  FROM vals GROUP BY feature))""",
    )
    out["what_if"] = on_feats(
        f"SELECT {names(NUMERIC)}, round(actual_eta_minutes, 6) AS actual_eta_minutes FROM changed", sides("copy")
    )
    out["what_if_summary"] = on_feats(
        "SELECT round((SELECT ra FROM ks WHERE feature = 'actual_eta_minutes'), 2) AS original_mean_eta,"
        " round((SELECT ca FROM ks WHERE feature = 'actual_eta_minutes'), 2) AS drifted_mean_eta,"
        " drifted / tested >= 0.3 AS dataset_drift_detected, round(drifted / tested, 4) AS drift_share,"
        " names AS drifted_features FROM roll",
        sides("copy"), ks(),
    )
    e = "(actual_eta_minutes - predicted)"
    c = "(actual_eta_minutes * (CASE WHEN pickup_hour BETWEEN 16 AND 20 OR is_weekend = 1 THEN 1.5 ELSE 1 END) * 1.15 - predicted)"
    out["retrain_decision"] = on_feats(
        f"""SELECT round(b, 4) AS baseline_rmse, round(c, 4) AS current_rmse, round(inc * 100, 2) AS rmse_increase_pct,
  CAST(15.0 AS DOUBLE) AS threshold_pct, inc > 0.15 AS rmse_breach_detected, drift AS drift_detected, share AS drift_share,
  inc > 0.15 OR drift AS retraining_triggered,
  CASE WHEN inc > 0.15 OR drift THEN 'ACTION_REQUIRED_RETRAIN' ELSE 'HEALTHY' END AS status,
  concat_ws(' ', CASE WHEN inc > 0.15 THEN printf('The error grew by %.1f%%; up to 15.0%% is allowed.', inc * 100) END,
    CASE WHEN drift THEN printf('Inputs drifted: %.1f%% of the tested features.', share * 100) END,
    CASE WHEN NOT (inc > 0.15 OR drift) THEN 'Error and inputs are within their limits.' END) AS reasons,
  CASE WHEN inc > 0.15 OR drift THEN 'Fit the model anew' ELSE 'Keep the model' END AS recommended_action
FROM (SELECT b, c, (c - b) / b AS inc, drifted / tested >= 0.3 AS drift, round(drifted / tested, 4) AS share
  FROM (SELECT sqrt(avg({e} * {e}) FILTER (NOT is_test)) AS b, sqrt(avg({c} * {c}) FILTER (is_test)) AS c FROM scored)
  CROSS JOIN roll)""",
        sides("split"), ks(),
    )

    out["decision_from_files"] = out["retrain_decision"]
    out["stream_decision"] = out["retrain_decision"]

    # Models
    ridge = f"""xy AS (SELECT trip_distance_km AS x1, CAST({ORDINAL} AS DOUBLE) AS x2, actual_eta_minutes AS y
  FROM feats WHERE NOT is_test),
mom AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(x1) * count(*) + 1.0 AS s11,
    var_pop(x2) * count(*) + 1.0 AS s22, covar_pop(x1, x2) * count(*) AS s12,
    covar_pop(x1, y) * count(*) AS s1y, covar_pop(x2, y) * count(*) AS s2y FROM xy),
sol AS (SELECT m1, m2, my, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
    (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM mom)"""
    out["ridge_fit"] = on_feats(
        """SELECT 'trip_distance_km' AS term, round(b1, 6) AS coefficient FROM sol
UNION ALL SELECT 'traffic_level', round(b2, 6) FROM sol
UNION ALL SELECT 'intercept', round(my - b1 * m1 - b2 * m2, 6) FROM sol""",
        ridge,
    )
    fitted = f"my + b1 * (trip_distance_km - m1) + b2 * ({ORDINAL} - m2)"
    out["ridge_metrics"] = on_feats(
        "SELECT split, 0 AS ord, 'RidgeRegression' AS model, round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2,"
        " round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,"
        " round(avg(abs(y - p) / y), 6) AS mape, count(*) AS n FROM"
        " (SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, actual_eta_minutes AS y,"
        f" {fitted} AS p FROM feats CROSS JOIN sol) GROUP BY split",
        ridge,
    )
    out["ridge_responses"] = on_feats(
        "SELECT request_id, true AS success, round(p, 2) AS eta_minutes, round(p * 60, 1) AS eta_seconds,"
        " trip_distance_km AS calculated_distance_km, traffic_level AS estimated_traffic_level, pickup_location,"
        " drop_location, pickup_date, pickup_time"
        f" FROM (SELECT *, greatest({fitted}, 0.5) AS p FROM reqfeats CROSS JOIN sol)",
        ridge, REQUESTS, CHECKED, REQFEATS,
    )

    errors = (
        f"SELECT sqrt(avg((1.5 * y - p) * (1.5 * y - p))) AS old, sqrt(avg((1.5 * y - 1.5 * p) * (1.5 * y - 1.5 * p))) AS new"
        f" FROM (SELECT actual_eta_minutes AS y, {fitted} AS p FROM feats CROSS JOIN sol WHERE is_test)"
    )
    out["closed_loop"] = on_feats(
        "SELECT 1 AS step, 'promoted' AS action, 2 AS champion, 2 AS candidate, round(old, 4) AS champion_rmse,"
        f" round(new, 4) AS candidate_rmse FROM ({errors})"
        f" UNION ALL SELECT 2, 'kept', 2, NULL, round(new, 4), NULL FROM ({errors})",
        ridge,
    )
    out["stream_followed"] = on_feats(
        "SELECT request_id, 1 + part // 2 AS model_version, round(greatest(CASE WHEN part < 2 THEN p ELSE 1.5 * p END, 0.5), 2) AS predicted_eta_minutes"
        " FROM (SELECT *, CAST(CAST('0x' || substr(md5(request_id), 1, 4) AS INTEGER) % 4 AS INTEGER) AS part,"
        f" {fitted} AS p FROM reqfeats CROSS JOIN sol)",
        ridge, REQUESTS, CHECKED, REQFEATS,
    )

    counts = "SELECT count(*) FILTER (is_test) AS test, count(*) FILTER (NOT is_test) AS train FROM feats"
    out["model_metrics_checks"] = on_feats(
        "SELECT CAST(ord AS INTEGER) AS ord, model, split, CASE split WHEN 'test' THEN test ELSE train END AS n, true AS in_order"
        " FROM (VALUES (0, 'RidgeRegression'), (1, 'RandomForest'), (2, 'GradientBoosting'), (3, 'NewtonBoosting')) m(ord, model)"
        f" CROSS JOIN (VALUES ('train'), ('test')) s(split) CROSS JOIN ({counts})"
    )
    out["leaderboard_checks"] = "SELECT CAST(4 AS BIGINT) AS candidates, true AS record_is_first, true AS record_is_lowest"
    out["importance_checks"] = "SELECT CAST(20 AS BIGINT) AS listed, CAST(1 AS DOUBLE) AS total, true AS are_the_largest"
    out["many_places"] = on_feats(
        """SELECT CAST(10 + row_number() OVER (ORDER BY value) - 2 AS INTEGER) AS position, 'pickup_location_' || value AS feature, n FROM cats
QUALIFY row_number() OVER (ORDER BY value) > 1""",
        """placed AS (SELECT pickup_location || ' ' || pickup_time AS place, is_test FROM feats),
counted AS (SELECT place, count(*) AS n, count(*) FILTER (WHERE NOT is_test) AS n_train FROM placed GROUP BY place),
cats AS (SELECT CASE WHEN n < 2 THEN 'Other' ELSE place END AS value, CAST(sum(n) AS BIGINT) AS n FROM counted
  GROUP BY ALL HAVING sum(n_train) > 0)""",
    )
    out["clean_written"] = out["stream_accounting"] = out["clean_accounting"]
    out["newton_splits"] = on_feats(
        f"""SELECT feature, cut, round(gain, 3) AS gain, round(l, 6) AS left_value, round(r, 6) AS right_value FROM (
  SELECT feature, cut, (gl * gl / (hl + 1) + gr * gr / (hr + 1) - power(gl + gr, 2) / (hl + hr + 1)) / 2 AS gain,
    -gl / (hl + 1) * 0.1 AS l, -gr / (hr + 1) * 0.1 AS r
  FROM (
    SELECT c.feature, c.cut, sum(CASE WHEN v.value <= c.cut THEN g END) AS gl, count(CASE WHEN v.value <= c.cut THEN 1 END) AS hl,
      sum(CASE WHEN v.value > c.cut THEN g END) AS gr, count(CASE WHEN v.value > c.cut THEN 1 END) AS hr
    FROM cells v JOIN (SELECT DISTINCT feature, value AS cut FROM cells) c USING (feature) GROUP BY c.feature, c.cut)
  WHERE hr > 0)""",
        f"""vals AS (
  SELECT (SELECT avg(actual_eta_minutes) FROM feats WHERE NOT is_test) - actual_eta_minutes AS g, unnest([
    {{'feature': 'pickup_hour', 'value': CAST(pickup_hour AS DOUBLE)}}, {{'feature': 'month', 'value': CAST(month AS DOUBLE)}},
    {{'feature': 'passenger_count', 'value': CAST(passenger_count AS DOUBLE)}}, {{'feature': 'traffic_level', 'value': CAST({ORDINAL} AS DOUBLE)}}]) AS e
  FROM feats WHERE NOT is_test),
cells AS (SELECT e.feature AS feature, e.value AS value, g FROM vals)""",
    )
    out["ridge_residuals"] = on_feats(f"SELECT CAST(0 AS BIGINT) AS unbalanced, train AS n FROM ({counts})")
    out["stream_scored_model"] = on_feats(
        "SELECT count(*) AS answers, CAST(0 AS BIGINT) AS unlike FROM reqfeats", REQUESTS, CHECKED, REQFEATS
    )
    out["stored_model_checks"] = "SELECT true AS same"
    out["batch_scoring_checks"] = on_feats(
        "SELECT count(*) AS answers, CAST(0 AS BIGINT) AS unlike FROM reqfeats", REQUESTS, CHECKED, REQFEATS
    )

    # Sources and sinks
    out["append_round_trip"] = on_trips("SELECT * FROM trips")
    out["consumed_batches"] = out["clean_trips"]
    out["csv_round_trip"] = on_trips("SELECT * FROM trips")
    out["staged_batches"] = on_trips("SELECT *, traffic_level AS batch FROM trips")
    out["ragged_log"] = on_log(
        "SELECT status = 'error' AS is_legacy, count(*) AS n, round(sum(CASE WHEN status <> 'error'"
        " THEN floor(predicted_eta_minutes * 100) / CAST(100 AS DOUBLE) END), 4) AS total_minutes FROM log GROUP BY ALL"
    )
    out["report_round_trip"] = out["drift_summary"]
    out["feature_model_round_trip"] = out["request_feature_vector"]

    # Streams that return a batch twin's result
    out["stream_clean"] = out["stream_staged_clean"] = out["clean_trips"]
    out["stream_rejected"] = on_trips(
        "SELECT * FROM standard WHERE NOT coalesce(actual_eta_minutes BETWEEN 0.5 AND 200, false)"
        " OR passenger_count <= 0 OR trip_distance_km <= 0",
        STANDARD,
    )
    out["stream_quarantine"] = out["request_quarantine"]
    out["stream_dedupe"] = on_log(
        "SELECT event_id, endpoint, status, predicted_eta_minutes, actual_eta_minutes FROM log"
    )
    return out
