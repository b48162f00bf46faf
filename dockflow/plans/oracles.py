"""The same results as plain SQL over the driver tables, for checking.

The SQL states the semantics a second time and shares no code with the jobs.
January in Paris is UTC+1, so local times add 3600 s here.
"""

from dockflow.plans.bindings import DAY, DISTRICT, NOW, PRICE, SEARCH

DAY_START = 1706569200
DAY_END = DAY_START + 86400



def _centre(column: str) -> str:
    return (f"sum(CAST(round({column} * 1e7) AS BIGINT))::DOUBLE / count(*) / 1e7::DOUBLE "
            f"AS {column}")


BASE = f"""
WITH facts AS (
  SELECT event_id, user_id, event_type,
         CAST(floor(epoch(ts)) AS BIGINT) AS ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(floor(value / 20) AS INTEGER) AS v
  FROM events),
info AS (
  SELECT s_suppkey AS station_id,
    CASE WHEN s_suppkey % 43 = 9 THEN '' WHEN s_suppkey % 37 = 5 THEN 'N/A'
         ELSE lpad(CAST((s_nationkey + 1) * 1000 + s_suppkey % 1000 AS VARCHAR), 5, '0') END AS station_code,
    CASE WHEN s_suppkey % 41 = 7 THEN ''
         WHEN s_suppkey % 3 = 0 THEN 'Place République ' || s_suppkey
         WHEN s_suppkey % 3 = 1 THEN 'Gare Élysée ' || s_suppkey
         ELSE 'Rue Sainte-Anne ' || s_suppkey END AS name,
    (48800 + (37 * s_suppkey) % 100) / 1000 AS lat,
    (2250 + (53 * s_suppkey) % 170) / 1000 AS lon,
    CASE WHEN s_suppkey % 29 = 3 THEN 0 ELSE CAST(4 + s_suppkey % 5 AS INTEGER) END AS capacity
  FROM supplier),
status AS (
  SELECT user_id AS station_id, ts,
    CASE WHEN k <> 3 THEN v END AS num_bikes_available,
    v - v // 3 AS mechanical, v // 3 AS ebike,
    CASE WHEN k <> 7 THEN greatest(6 - v, 0) END AS num_docks_available,
    CASE WHEN event_type = 'error' AND k < 50 THEN 0 ELSE 1 END AS is_installed,
    CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS is_renting,
    CASE WHEN event_type IN ('error', 'signup') AND k >= 20 THEN 0 ELSE 1 END AS is_returning,
    CASE WHEN k <> 11 THEN ts - k END AS last_reported,
    event_id AS "offset", ts + k % 90 AS publish_ts
  FROM facts),
readings AS (
  SELECT station_id, station_code, name, lat, lon, capacity, ts,
    coalesce(last_reported, ts) AS last_reported, mechanical, ebike,
    coalesce(num_bikes_available, mechanical + ebike) AS bikes_available,
    coalesce(num_docks_available, 0) AS docks_available,
    is_installed <> 0 AS is_installed, is_renting <> 0 AS is_renting,
    is_returning <> 0 AS is_returning, "offset", publish_ts
  FROM status JOIN info USING (station_id)),
compared AS (
  SELECT *,
    row_number() OVER w AS nth,
    lag(bikes_available) OVER w AS bikes_before,
    (mechanical, ebike, bikes_available, docks_available, is_installed, is_renting, is_returning)
      = lag((mechanical, ebike, bikes_available, docks_available, is_installed, is_renting, is_returning))
        OVER w AS same
  FROM readings
  WINDOW w AS (PARTITION BY station_id ORDER BY ts, "offset")),
changes AS (
  SELECT * EXCLUDE (nth, bikes_before, same),
    CASE WHEN nth = 1 THEN 0 ELSE bikes_available - bikes_before END AS bikes_delta,
    CAST(make_timestamp((publish_ts + 3600) * 1000000) AS DATE) AS date,
    CAST(((ts + 3600) // 3600) % 24 AS TINYINT) AS hour,
    greatest(-(CASE WHEN nth = 1 THEN 0 ELSE bikes_available - bikes_before END), 0) AS taken,
    greatest(CASE WHEN nth = 1 THEN 0 ELSE bikes_available - bikes_before END, 0) AS returned
  FROM compared WHERE nth = 1 OR NOT same),
today AS (  -- of the records since the day's start, where a replay begins
  SELECT * FROM changes WHERE ts >= {DAY_START} AND ts < {DAY_END} AND publish_ts >= {DAY_START}),
latest AS (
  SELECT * FROM changes
  QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY ts DESC, "offset" DESC) = 1),
flows AS (
  SELECT station_id, CAST(sum(taken) AS BIGINT) AS taken, CAST(sum(returned) AS BIGINT) AS returned
  FROM today WHERE bikes_delta <> 0 GROUP BY station_id),
minutes AS (
  SELECT ts // 60 * 60 AS t, count(*) AS events, CAST(sum(taken) AS BIGINT) AS taken,
         CAST(sum(returned) AS BIGINT) AS returned
  FROM today GROUP BY 1),
snap AS (
  SELECT l.* EXCLUDE (taken, returned, date, hour, "offset", publish_ts),
    coalesce(f.taken, 0) AS taken, coalesce(f.returned, 0) AS returned,
    coalesce(f.taken, 0) + coalesce(f.returned, 0) AS moves,
    coalesce(f.returned, 0) - coalesce(f.taken, 0) AS net,
    CASE WHEN TRY_CAST(station_code AS BIGINT) BETWEEN 1000 AND 20999
         THEN CAST(TRY_CAST(station_code AS BIGINT) // 1000 AS INTEGER) END AS arr,
    is_installed AND is_renting AND bikes_available = 0 AS is_empty,
    is_installed AND is_returning AND docks_available = 0 AS is_full,
    NOT is_installed OR NOT (is_renting OR is_returning) AS out_of_order
  FROM latest l LEFT JOIN flows f USING (station_id)),
district AS (
  SELECT arr, count(*) AS stations, CAST(sum(bikes_available) AS BIGINT) AS bikes,
    CAST(sum(ebike) AS BIGINT) AS ebike, CAST(sum(capacity) AS BIGINT) AS capacity,
    CAST(sum(docks_available) AS BIGINT) AS docks,
    count(*) FILTER (WHERE is_empty) AS empty, count(*) FILTER (WHERE is_full) AS "full",
    CAST(sum(taken) AS BIGINT) AS taken, CAST(sum(returned) AS BIGINT) AS returned,
    {_centre('lat')}, {_centre('lon')}
  FROM snap WHERE arr IS NOT NULL GROUP BY arr),
daily AS (
  SELECT CAST(date AS VARCHAR) AS date, count(*) AS events, CAST(sum(taken) AS BIGINT) AS taken,
         CAST(sum(returned) AS BIGINT) AS returned
  FROM changes GROUP BY 1),
daily_before AS (SELECT * FROM daily WHERE date < '{DAY}'),
profile AS (
  SELECT hour, CAST(avg(taken) AS BIGINT) AS taken, CAST(avg(returned) AS BIGINT) AS returned
  FROM (SELECT date, hour, sum(taken) AS taken, sum(returned) AS returned
        FROM changes WHERE bikes_delta <> 0 GROUP BY date, hour)
  GROUP BY hour),
profile_before AS (
  SELECT hour, CAST(avg(taken) AS BIGINT) AS taken, CAST(avg(returned) AS BIGINT) AS returned
  FROM (SELECT date, hour, sum(taken) AS taken, sum(returned) AS returned
        FROM changes WHERE bikes_delta <> 0 AND date < DATE '{DAY}' GROUP BY date, hour)
  GROUP BY hour),
marks AS (
  SELECT *,
    CASE WHEN TRY_CAST(station_code AS BIGINT) BETWEEN 1000 AND 20999
         THEN CAST(TRY_CAST(station_code AS BIGINT) // 1000 AS INTEGER) END AS arr,
    is_installed AND is_renting AND bikes_available = 0 AS is_empty,
    is_installed AND is_returning AND docks_available = 0 AS is_full,
    NOT is_installed OR NOT (is_renting OR is_returning) AS out_of_order
  FROM changes),
weather AS (
  SELECT h AS ts, CAST(((h + 3600) // 3600) % 24 AS TINYINT) AS hour, errors / 10 AS precipitation,
    (k_sum % 300) / 10 AS temperature, n * 1.5::DOUBLE AS wind_speed,
    CAST(k_sum % 101 AS DOUBLE) AS humidity, CAST(k_min AS SMALLINT) AS weather_code,
    CAST(make_timestamp(h * 1000000) AS DATE) AS date
  FROM (SELECT ts // 3600 * 3600 AS h, count(*) AS n,
               count(*) FILTER (WHERE event_type = 'error') AS errors,
               CAST(sum(k) AS BIGINT) AS k_sum, min(k) AS k_min
        FROM facts GROUP BY 1)),
wire AS (
  SELECT *, '{{"station_id":' || station_id || ',"station_code":"' || station_code
    || '","name":"' || name || '","lat":' || lat || ',"lon":' || lon || ',"capacity":' || capacity
    || ',"ts":' || ts || ',"last_reported":' || last_reported || ',"mechanical":' || mechanical
    || ',"ebike":' || ebike || ',"bikes_available":' || bikes_available
    || ',"docks_available":' || docks_available || ',"is_installed":' || is_installed
    || ',"is_renting":' || is_renting || ',"is_returning":' || is_returning
    || ',"bikes_delta":' || bikes_delta || '}}' AS value
  FROM changes)
"""

EVENT = ("station_id, station_code, name, lat, lon, capacity, ts, last_reported, mechanical, "
         "ebike, bikes_available, docks_available, is_installed, is_renting, is_returning, "
         "bikes_delta")
ARCHIVE = ("ts, hour, station_id, station_code, name, lat, lon, last_reported, is_installed, "
           "is_renting, is_returning, date, " + ", ".join(
               f"CAST({c} AS SMALLINT) AS {c}" for c in (
                   "capacity", "mechanical", "ebike", "bikes_available", "docks_available",
                   "bikes_delta")))


def _percent(x: str) -> str:
    """One decimal, ties upwards; printf rounds exact ties to even, so they go first."""
    y = f"(100 * ({x})::DOUBLE)"
    tie = f"({y} * 4 = floor({y} * 4) AND {y} * 2 <> floor({y} * 2))"
    return (f"replace(printf('%.1f', CASE WHEN {tie} THEN {y} + 0.01 ELSE {y} END), '.', ',') "
            f"|| ' %'")


def _signed(n: str) -> str:
    """With a plus above zero and French groups of thousands."""
    return f"CASE WHEN {n} > 0 THEN '+' ELSE '' END || replace(format('{{:,}}', {n}), ',', chr(8239))"


def _series(step: int) -> str:
    since = DAY_START // step * step
    return f"""
  SELECT s.t, coalesce(sum(m.events), 0)::BIGINT AS events,
         coalesce(sum(m.taken), 0)::BIGINT AS taken, coalesce(sum(m.returned), 0)::BIGINT AS returned
  FROM (SELECT unnest(range({since}, {NOW + 1}, {step})) AS t) s
  LEFT JOIN (SELECT * FROM minutes WHERE t BETWEEN {since} AND {NOW}) m ON m.t // {step} * {step} = s.t
  GROUP BY s.t"""


def _fill_class(count: str, serving: str) -> str:
    return f"""CASE WHEN NOT is_installed OR NOT {serving} THEN 'closed'
       WHEN {count} = 0 THEN 'critical' WHEN capacity = 0 THEN 'level3'
       ELSE 'level' || least(3, (4 * {count}) // capacity) END"""


def _clusters(count: str) -> str:
    return f"""
  SELECT cluster, in_town, n, bikes, docks, capacity, lat, lon,
    CASE WHEN capacity = 0 THEN 0.0 ELSE {count}::DOUBLE / capacity END AS ratio,
    CASE WHEN NOT in_town THEN 'closed' WHEN {count} = 0 THEN 'critical'
         WHEN capacity = 0 THEN 'level0' ELSE 'level' || least(3, (4 * {count}) // capacity) END AS level
  FROM (SELECT coalesce(CAST(arr AS VARCHAR), CAST(floor(lat / 0.03::DOUBLE + 0.5) AS BIGINT) || '_'
                        || CAST(floor(lon / 0.03::DOUBLE + 0.5) AS BIGINT)) AS cluster,
               arr IS NOT NULL AS in_town, count(*) AS n,
               CAST(sum(bikes_available) AS BIGINT) AS bikes,
               CAST(sum(docks_available) AS BIGINT) AS docks,
               CAST(sum(capacity) AS BIGINT) AS capacity,
               {_centre('lat')}, {_centre('lon')}
        FROM snap GROUP BY 1, 2)"""


def _broken(column: str) -> str:
    return f"""CASE "offset" % 20
      WHEN 1 THEN '{{"broken": ' WHEN 4 THEN '[' || {column} || ']'
      WHEN 7 THEN '{{"shape": "unknown"}}'
      WHEN 10 THEN regexp_replace({column}, ',"bikes_delta":[-0-9]+', '')
      WHEN 13 THEN regexp_replace({column}, '}}$', ',"extra":1}}')
      WHEN 16 THEN regexp_replace({column}, '"capacity":[0-9]+', '"capacity":null')
      ELSE {column} END"""


_MINUTE = NOW // 60 * 60

BODIES = {
    # sources and sinks
    "info_scan": "SELECT * FROM info",
    "status_scan": """
  SELECT station_id, ts, num_bikes_available, num_docks_available, is_installed, is_renting,
         is_returning, last_reported, "offset", publish_ts FROM status""",
    "bike_types": 'SELECT "offset", mechanical, ebike FROM status',
    "weather_hourly": "SELECT * FROM weather",
    "archive_weather": "SELECT * FROM weather",
    "weather_daily": """
  SELECT CAST(date AS VARCHAR) AS date, round(sum(precipitation), 6) AS rain,
         min(temperature) AS temperature_min, max(temperature) AS temperature_max
  FROM weather GROUP BY date""",
    "log_encode": """
  SELECT CAST(station_id AS VARCHAR) AS key, value, CAST(station_id % 3 AS INTEGER) AS partition,
         "offset", publish_ts FROM wire""",
    "log_roundtrip": f'SELECT {EVENT}, "offset", publish_ts FROM changes',
    "log_day_read": f"""
  SELECT {EVENT}, "offset", publish_ts FROM changes
  WHERE publish_ts >= {DAY_START} AND publish_ts < {DAY_END}""",
    "poison_good": f"""
  SELECT {EVENT}, "offset", publish_ts FROM changes
  WHERE "offset" % 20 NOT IN (1, 4, 7, 10, 13, 16)""",
    "poison_rejected": f"""
  SELECT CAST(station_id AS VARCHAR) AS key, {_broken('value')} AS value,
         CAST(station_id % 3 AS INTEGER) AS partition, "offset", publish_ts,
         CASE WHEN "offset" % 20 IN (1, 4) THEN 'not_an_object'
              WHEN "offset" % 20 = 16 THEN 'null_field' ELSE 'wrong_fields' END AS reason
  FROM wire WHERE "offset" % 20 IN (1, 4, 7, 10, 13, 16)""",
    "archive_events": f"SELECT {ARCHIVE} FROM changes",
    "archive_run": """
        SELECT CAST(count(DISTINCT date) AS BIGINT) AS dates, CAST(count(*) AS BIGINT) AS events,
               CAST(coalesce(sum(greatest(-bikes_delta, 0)), 0) AS BIGINT) AS taken,
               CAST(coalesce(sum(greatest(bikes_delta, 0)), 0) AS BIGINT) AS returned
        FROM changes""",
    "archive_repeats": f"SELECT {ARCHIVE} FROM changes",
    "archive_mirror": f"SELECT {ARCHIVE} FROM changes",
    "archive_backfill": f"""
  SELECT {ARCHIVE} FROM changes WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-15'""",
    "monitor_line": """
  SELECT "offset", printf('%-35s %3d vélos (%+d)', left(name, 35), bikes_available, bikes_delta) AS line
  FROM changes""",
    "geo_bbox": """
  SELECT min(lon) - 0.005::DOUBLE AS min_lon, max(lon) + 0.005::DOUBLE AS max_lon,
         min(lat) - 0.005::DOUBLE AS min_lat, max(lat) + 0.005::DOUBLE AS max_lat
  FROM info WHERE TRY_CAST(station_code AS BIGINT) BETWEEN 1000 AND 20999""",
    # readings, changes, state
    "readings": "SELECT * FROM readings",
    "feed_summary": """
  SELECT (SELECT count(*) FROM info) AS info, count(*) AS joined,
         CAST(sum(bikes_available) AS BIGINT) AS bikes,
         count(*) FILTER (WHERE bikes_available = 0 AND is_renting) AS empty
  FROM readings""",
    "detect_changes": f'SELECT {EVENT}, "offset", publish_ts FROM changes',
    "latest_state": f"SELECT {EVENT} FROM latest",
    "snapshot_retype": f"SELECT {EVENT} FROM latest",
    "known_stations": "SELECT DISTINCT station_id FROM changes",
    "freshness": f"""
  SELECT {NOW}::BIGINT AS now, max(ts) AS last_ts, {NOW} - max(ts) AS age, {NOW} - max(ts) > 180 AS stale,
         CASE WHEN {NOW} - max(ts) > 180 THEN 'FLUX INTERROMPU' ELSE 'EN DIRECT' END AS label
  FROM latest""",
    "stations_snapshot": f"SELECT {EVENT}, taken, returned FROM snap",
    # scalar rules
    "flow_split": 'SELECT station_id, "offset", bikes_delta, taken, returned FROM changes',
    "local_hour": 'SELECT "offset", ts, CAST(hour AS INTEGER) AS hour, CAST(make_timestamp((ts + 3600) * 1000000) AS DATE) AS day FROM changes',
    "time_label": """
  SELECT "offset", strftime(make_timestamp((ts + 3600) * 1000000), '%H:%M') AS clock,
         strftime(make_timestamp((ts + 3600) * 1000000), '%d/%m') AS day FROM changes""",
    "station_district": 'SELECT "offset", station_code, arr FROM marks',
    "station_flags": 'SELECT "offset", is_empty, is_full, out_of_order FROM marks',
    "fill_class": f"""
  SELECT "offset", {_fill_class('bikes_available', 'is_renting')} AS bikes_class,
         {_fill_class('docks_available', 'is_returning')} AS docks_class FROM marks""",
    "status_label": """
  SELECT "offset", CASE WHEN NOT is_installed THEN '⛔ Hors service'
    WHEN NOT is_renting AND NOT is_returning THEN '⛔ Fermée (ni location ni retour)'
    WHEN NOT is_renting THEN '⚠️ Location suspendue' WHEN NOT is_returning THEN '⚠️ Retour suspendu'
    ELSE '✅ En service' END AS status FROM marks""",
    "age_label": f"""
  SELECT "offset", age, CASE WHEN age < 60 THEN greatest(0, age) || ' s'
    WHEN age < 3600 THEN CAST(floor(age / 60 + 0.5) AS BIGINT) || ' min'
    ELSE CAST(floor(age / 3600 + 0.5) AS BIGINT) || ' h' END AS label
  FROM (SELECT "offset", {NOW} - CASE WHEN last_reported = 0 THEN ts ELSE last_reported END AS age
        FROM marks)""",
    "fill_percent": """
  SELECT "offset", CASE WHEN capacity = 0 THEN 0.0
    ELSE 100.0::DOUBLE * bikes_available / capacity END AS percent FROM marks""",
    "delta_label": f"""
  SELECT "offset", {_signed('bikes_delta')} AS label FROM marks""",
    "percent_label": f"""
  SELECT "offset", {_percent('CASE WHEN capacity = 0 THEN 0 ELSE bikes_available / capacity END')} AS label
  FROM marks""",
    # activity
    "activity_minutes": "SELECT * FROM minutes",
    "station_flows": "SELECT * FROM flows",
    "activity_series_60": _series(60),
    "activity_series_300": _series(300),
    "activity_series_900": _series(900),
    "activity_series_3600": _series(3600),
    "activity_series_bad_step": _series(300),
    "activity_trimmed": f"""
  SELECT * FROM ({_series(300)}) p
  WHERE t BETWEEN (SELECT min(t) FROM ({_series(300)}) WHERE taken + returned > 0)
              AND (SELECT max(t) FROM ({_series(300)}) WHERE taken + returned > 0)""",
    "activity_top": """
  SELECT f.station_id, coalesce(nullif(l.name, ''), CAST(f.station_id AS VARCHAR)) AS name,
         f.taken + f.returned AS moves
  FROM flows f LEFT JOIN latest l USING (station_id)
  ORDER BY moves DESC, f.station_id LIMIT 8""",
    # operator view
    "business_totals": f"""
  SELECT *, CASE WHEN total_moves = 0 THEN '–' ELSE {_percent('at_risk_moves / total_moves')} END
         AS at_risk_share
  FROM (SELECT (SELECT coalesce(sum(taken), 0)::BIGINT FROM flows) AS today_taken,
          (SELECT coalesce(sum(returned), 0)::BIGINT FROM flows) AS today_returned,
          (SELECT coalesce(sum(taken + returned), 0)::BIGINT FROM flows) AS total_moves,
          coalesce(sum(moves) FILTER (WHERE out_of_order OR is_empty OR is_full), 0)::BIGINT AS at_risk_moves,
          coalesce(sum(abs(net)), 0)::BIGINT // 2 AS to_move
        FROM snap)""",
    "business_rebalance": """
  SELECT station_id, name, lat, lon, CASE WHEN is_empty THEN 'vide' ELSE 'pleine' END AS state, moves,
         capacity, bikes_available AS bikes, docks_available AS docks
  FROM snap WHERE is_empty OR is_full ORDER BY moves DESC, station_id LIMIT 12""",
    "business_sinks": """
  SELECT station_id, name, net, taken, returned, lat, lon FROM snap WHERE net > 0
  ORDER BY net DESC, station_id LIMIT 8""",
    "business_sources": """
  SELECT station_id, name, net, taken, returned, lat, lon FROM snap WHERE net < 0
  ORDER BY net, station_id LIMIT 8""",
    "business_revenue": f"""
  SELECT today_taken, fleet, CAST(floor(today_taken * {PRICE}::DOUBLE + 0.5) AS BIGINT) AS revenue,
    CASE WHEN fleet = 0 THEN '–'
         ELSE replace(printf('%.2f', today_taken / fleet), '.', ',') END AS trips_per_bike
  FROM (SELECT (SELECT coalesce(sum(taken), 0)::BIGINT FROM flows) AS today_taken,
               coalesce(sum(bikes_available), 0)::BIGINT AS fleet FROM latest)""",
    "top_active": "SELECT station_id, name, moves FROM snap ORDER BY moves DESC, station_id LIMIT 5",
    "bottom_active": "SELECT station_id, name, moves FROM snap ORDER BY moves, station_id LIMIT 5",
    "top_active_district": f"""
  SELECT station_id, name, moves FROM snap WHERE arr = {DISTRICT}
  ORDER BY moves DESC, station_id LIMIT 5""",
    "bottom_active_district": f"""
  SELECT station_id, name, moves FROM snap WHERE arr = {DISTRICT} ORDER BY moves, station_id LIMIT 5""",
    "top_fill_district": f"""
  SELECT station_id, name, CAST(floor(100 * (bikes_available / capacity) + 0.5) AS BIGINT) AS percent
  FROM snap WHERE capacity > 0 AND arr = {DISTRICT}
  ORDER BY bikes_available / capacity DESC, station_id LIMIT 3""",
    "bottom_fill_district": f"""
  SELECT station_id, name, CAST(floor(100 * (bikes_available / capacity) + 0.5) AS BIGINT) AS percent
  FROM snap WHERE capacity > 0 AND arr = {DISTRICT}
  ORDER BY bikes_available / capacity, station_id LIMIT 3""",
    "top_fill": """
  SELECT station_id, name, CAST(floor(100 * (bikes_available / capacity) + 0.5) AS BIGINT) AS percent
  FROM snap WHERE capacity > 0 ORDER BY bikes_available / capacity DESC, station_id LIMIT 3""",
    "bottom_fill": """
  SELECT station_id, name, CAST(floor(100 * (bikes_available / capacity) + 0.5) AS BIGINT) AS percent
  FROM snap WHERE capacity > 0 ORDER BY bikes_available / capacity, station_id LIMIT 3""",
    "station_search": f"""
  SELECT rank, station_id, name, coalesce(arr || 'ᵉ arr.', 'banlieue') AS place,
         bikes_available AS count, lat, lon
  FROM (SELECT *, CASE WHEN strip_accents(lower(name)) LIKE '{SEARCH}%' THEN 0
                       WHEN strip_accents(lower(name)) LIKE '%{SEARCH}%' THEN 1 END AS rank FROM snap)
  WHERE rank IS NOT NULL ORDER BY rank, station_id LIMIT 8""",
    # districts
    "districts": "SELECT * FROM district",
    "district_heat": """
  SELECT arr, taken + returned AS moves,
    (taken + returned - min(taken + returned) OVER ())::DOUBLE
      / (greatest(max(taken + returned) OVER (), min(taken + returned) OVER () + 1)
         - min(taken + returned) OVER ()) AS heat, lat, lon FROM district""",
    "district_map": """
  SELECT p.arr, 1::BIGINT AS rings, d.taken + d.returned AS moves,
    (d.taken + d.returned - lo)::DOUBLE / (greatest(hi, lo + 1) - lo) AS heat, d.lat, d.lon
  FROM (SELECT DISTINCT CAST(TRY_CAST(station_code AS BIGINT) // 1000 AS INTEGER) AS arr FROM info
        WHERE TRY_CAST(station_code AS BIGINT) BETWEEN 1000 AND 20999) p
  LEFT JOIN district d USING (arr),
       (SELECT min(taken + returned) AS lo, max(taken + returned) AS hi FROM district)""",
    "city_overview": """
  SELECT *, taken + returned AS moves,
    CASE WHEN capacity <> 0 THEN CAST(floor(100.0::DOUBLE * bikes / capacity + 0.5) AS BIGINT) END AS fill
  FROM (SELECT count(*) AS districts, sum(stations)::BIGINT AS stations, sum(bikes)::BIGINT AS bikes,
          sum(ebike)::BIGINT AS ebike, sum(capacity)::BIGINT AS capacity, sum(empty)::BIGINT AS empty,
          sum(taken)::BIGINT AS taken, sum(returned)::BIGINT AS returned FROM district)""",
    "district_detail": f"""
  SELECT arr, stations, bikes, ebike, docks,
    CASE WHEN capacity = 0 THEN 0 ELSE CAST(floor(100.0::DOUBLE * bikes / capacity + 0.5) AS BIGINT) END AS fill,
    empty, "full", taken + returned AS moves, taken, returned
  FROM district WHERE arr = {DISTRICT}""",
    "map_clusters": _clusters("bikes"),
    "map_clusters_docks": _clusters("docks"),
    # history
    "history_daily": "SELECT * FROM daily",
    "history_profile": "SELECT * FROM profile",
    "archive_summary": """
  SELECT count(*) AS events, sum(taken)::BIGINT AS taken, sum(returned)::BIGINT AS returned FROM changes""",
    # indicators
    "header_stats": """
  SELECT sum(bikes_available)::BIGINT AS bikes, sum(mechanical)::BIGINT AS mechanical,
    sum(ebike)::BIGINT AS ebike, sum(docks_available)::BIGINT AS docks,
    count(*) FILTER (WHERE is_installed AND is_renting AND bikes_available = 0) AS empty,
    count(*) FILTER (WHERE is_installed AND is_returning AND docks_available = 0) AS "full",
    count(*) FILTER (WHERE NOT (is_installed AND is_renting)) AS closed FROM latest""",
    "kpi_instant": f"""
  SELECT *, {_percent('CASE WHEN capacity = 0 THEN 0 ELSE bikes / capacity END')} AS fill,
    {_percent('CASE WHEN ebike + mechanical = 0 THEN 0 ELSE ebike / (ebike + mechanical) END')} AS electric,
    CASE WHEN open = 0 THEN '–' ELSE {_percent('with_bike / open')} END AS availability,
    empty + "full" AS tension,
    CASE WHEN total = 0 THEN '–' ELSE {_percent('open / total')} END AS open_share
  FROM (SELECT (SELECT count(*) FROM latest) AS total, count(*) AS open,
          coalesce(sum(bikes_available), 0)::BIGINT AS bikes, coalesce(sum(mechanical), 0)::BIGINT AS mechanical,
          coalesce(sum(ebike), 0)::BIGINT AS ebike, coalesce(sum(capacity), 0)::BIGINT AS capacity,
          count(*) FILTER (WHERE bikes_available > 0) AS with_bike,
          count(*) FILTER (WHERE NOT bikes_available > 0) AS empty,
          count(*) FILTER (WHERE is_returning AND docks_available = 0) AS "full"
        FROM latest WHERE is_installed AND is_renting)""",
    "kpi_day": f"""
  SELECT *, taken + returned AS rotations, returned - taken AS net,
    {_signed('(returned - taken)')} AS net_label,
    replace(printf('%.1f', last_15_min / 15), '.', ',') AS rate
  FROM (SELECT coalesce(sum(events), 0)::BIGINT AS events, coalesce(sum(taken), 0)::BIGINT AS taken,
          coalesce(sum(returned), 0)::BIGINT AS returned,
          coalesce(sum(taken + returned) FILTER (WHERE t > {_MINUTE - 900} AND t <= {_MINUTE}), 0)::BIGINT AS last_15_min
        FROM minutes)""",
    "kpi_peak_hour": """
  SELECT t, (((t + 3600) // 3600) % 24) || ' h' AS hour, moves
  FROM (SELECT t // 3600 * 3600 AS t, sum(taken + returned)::BIGINT AS moves FROM minutes GROUP BY 1)
  WHERE moves > 0 ORDER BY moves DESC, t LIMIT 1""",
    "kpi_sparkline": f"""
  SELECT s.t, coalesce(m.taken + m.returned, 0) AS moves
  FROM (SELECT unnest(range({_MINUTE - 3540}, {_MINUTE + 60}, 60)) AS t) s LEFT JOIN minutes m USING (t)""",
    "today_vs_average": f"""
  SELECT rotations, days, CAST(floor(mean + 0.5) AS BIGINT) AS average,
    CASE WHEN mean = 0 THEN '–' ELSE {_percent('rotations / mean')} END AS vs_average
  FROM (SELECT (SELECT coalesce(sum(taken + returned), 0)::BIGINT FROM minutes) AS rotations,
               count(*) AS days, avg(taken + returned) AS mean FROM daily_before)""",
    "day_projection": f"""
  SELECT today_taken, round(share, 6) AS share,
    CASE WHEN share > 0.05 THEN CAST(floor(today_taken / share + 0.5) AS BIGINT) END AS projected,
    CASE WHEN share > 0.05 THEN {_percent('share')} ELSE '–' END AS share_label
  FROM (SELECT (SELECT coalesce(sum(taken), 0)::BIGINT FROM flows) AS today_taken,
          sum(CASE WHEN hour + 1 <= 23.75 THEN taken WHEN hour < 23.75 THEN taken * (23.75 - hour) ELSE 0 END)::DOUBLE
            / sum(taken) AS share
        FROM profile_before)""",
    # streams: the batch results; those of the day work on the log as it is when the day ends
    "stream_changes": f'SELECT {EVENT}, "offset", publish_ts FROM changes',
    "stream_state": """
        SELECT station_id, ts, last_reported, mechanical, ebike, bikes_available, docks_available, is_installed, is_renting,
               is_returning, "offset", publish_ts
        FROM readings QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY ts DESC, "offset" DESC) = 1""",
    "stream_log_source": f"""
  SELECT {EVENT}, "offset", publish_ts FROM changes
  WHERE "offset" % 20 NOT IN (1, 4, 7, 10, 13, 16)""",
    "stream_latest_view": f"SELECT {EVENT} FROM latest",
    "stream_flows": f"""
  SELECT station_id, CAST(sum(taken) AS BIGINT) AS taken, CAST(sum(returned) AS BIGINT) AS returned
  FROM today WHERE bikes_delta <> 0 AND publish_ts < {DAY_END} GROUP BY station_id""",
    "stream_activity": f"""
  SELECT ts // 60 * 60 AS t, count(*) AS events, CAST(sum(taken) AS BIGINT) AS taken,
         CAST(sum(returned) AS BIGINT) AS returned
  FROM today WHERE publish_ts < {DAY_END} GROUP BY 1""",
    "stream_push": f"""
  SELECT CAST(station_id AS VARCHAR) AS key, value, CAST(station_id % 3 AS INTEGER) AS partition,
         "offset", publish_ts FROM wire WHERE publish_ts >= {DAY_START}""",
    "stream_replay_live": f"""
  SELECT m.*, coalesce(p.pushed, 0) AS pushed
  FROM minutes m
  LEFT JOIN (SELECT ts // 60 * 60 AS t, count(*) AS pushed
             FROM changes WHERE publish_ts >= {DAY_START + 43200} GROUP BY 1) p USING (t)""",
}


def oracle_sql() -> dict[str, str]:
    return {name: BASE + body for name, body in BODIES.items()}
