"""DuckDB oracle SQL of the queries over raw records, reads and jobs (see ``oracle_queries``).

The raw text that the Spark side writes and reads back does not appear here:
each result is stated from the tables' own columns.
"""

from __future__ import annotations

from oracle_queries import _LOG_NESTED, _PRIMARY_STATS, EVENTS_FACT, STAR
from oracle_queries import ORACLES as OTHERS

ORACLES: dict[str, str] = {}

_EV = """
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id % 5 AS f5 FROM events)
"""

ORACLES["typed_transforms"] = f"""
WITH {_EV},
c AS (SELECT *, date_trunc('second', ts) AS s, CAST(ts AS DATE) AS dy FROM ev)
SELECT event_id,
  CASE f5 WHEN 0 THEN s WHEN 1 THEN NULL ELSE date_trunc('millisecond', ts) END AS stamp_at,
  CASE WHEN f5 <> 1 THEN dy END AS stamp_day,
  CASE WHEN f5 <> 1 THEN dy END AS day,
  CASE WHEN f5 <> 1 THEN s END AS clock_at,
  CAST(CASE f5 WHEN 0 THEN k WHEN 2 THEN k WHEN 3 THEN -CAST('1' || CAST(k AS VARCHAR) AS BIGINT) END AS BIGINT) AS whole,
  CAST(CASE f5 WHEN 0 THEN k WHEN 1 THEN k + 0.5 WHEN 2 THEN k WHEN 3 THEN -CAST('1' || CAST(k AS VARCHAR) AS BIGINT) END
       AS DOUBLE) AS number,
  CASE WHEN f5 < 3 THEN s END AS iso_at,
  CAST(CASE f5 WHEN 0 THEN date_trunc('year', dy) WHEN 1 THEN date_trunc('month', dy) WHEN 2 THEN dy END AS DATE) AS release_day
FROM c
"""

ORACLES["cast_values"] = f"""
WITH {_EV}, c AS (SELECT *, event_id % 6 AS f6 FROM ev)
SELECT event_id,
  CAST(CASE WHEN f6 = 2 THEN 0 END AS BIGINT) AS as_int,
  CAST(CASE f6 WHEN 2 THEN 0 WHEN 3 THEN k + 0.5 END AS DOUBLE) AS as_float,
  CASE f6 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN '0' WHEN 3 THEN CAST(k AS VARCHAR) || '.5' WHEN 4 THEN 'word'
       ELSE '' END AS as_text,
  f6 IN (0, 3, 4) AS as_bool,
  CASE WHEN event_id % 3 > 0 THEN date_trunc('millisecond', ts) END AS ms_at,
  date_trunc('second', ts) AS local_at
FROM c
"""

ORACLES["first_member"] = f"""
WITH {_EV} SELECT event_id, CASE WHEN event_id % 4 > 1 THEN k END AS first_v FROM ev
"""

ORACLES["inherited_entries"] = """
SELECT o_orderkey AS order_key, l_partkey AS part, l_quantity AS quantity,
       strftime(CASE WHEN l_linenumber = 1 THEN l_shipdate ELSE o_orderdate END, '%Y-%m-%d') AS day, l_linestatus AS status
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
"""

_ROWS = """
v AS (SELECT vec_id, embedding AS e, CAST(vec_id % 3 + 2 AS INTEGER) AS w FROM embeddings),
r AS (SELECT vec_id, w, e, unnest(range(0, (len(e) + w - 1) // w)) AS row_no FROM v),
x AS (SELECT vec_id, w, CAST(row_no AS INTEGER) AS row_no,
             CAST(e[row_no * w + 1] AS DOUBLE) AS a, CAST(e[row_no * w + 2] AS DOUBLE) AS b,
             CASE WHEN w > 2 THEN CAST(e[row_no * w + 3] AS DOUBLE) END AS c,
             CASE WHEN w > 3 THEN CAST(e[row_no * w + 4] AS DOUBLE) END AS d
      FROM r)
"""

ORACLES["arrays_by_width"] = f"""
WITH {_ROWS}
SELECT vec_id, row_no, a AS time, CASE WHEN w < 4 THEN b END AS level,
       CASE w WHEN 3 THEN c WHEN 4 THEN d END AS status,
       CASE WHEN w = 4 THEN b END AS low, CASE WHEN w = 4 THEN c END AS high
FROM x
"""

ORACLES["wide_arrays"] = f"""
WITH {_ROWS} SELECT vec_id, row_no, a AS val_0, b AS val_1, c AS val_2, d AS val_3 FROM x
"""

ORACLES["positional_fields"] = f"""
WITH {_EV}
SELECT event_id, 0 AS point, date_trunc('second', ts) AS at, k AS reading FROM ev
UNION ALL SELECT event_id, 1, TIMESTAMP '2024-01-01', NULL FROM ev
"""

ORACLES["repaired_arrays"] = f"""
WITH {_EV}, c AS (SELECT *, event_id % 4 AS f4 FROM ev)
SELECT event_id, CAST(CASE f4 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS INTEGER) AS n_tags,
       CASE f4 WHEN 0 THEN event_type || '|' || CAST(k AS VARCHAR) WHEN 1 THEN event_type ELSE '' END AS tags,
       CAST(CASE f4 WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 2 THEN 1 END AS INTEGER) AS n_entries
FROM c
"""

ORACLES["enriched_orders"] = """
SELECT o_orderkey, o_custkey, c_name, c_acctbal, c_custkey IS NULL AS unknown
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 > 0) c ON c_custkey = o_custkey
"""

ORACLES["recovered_ids"] = """
SELECT event_id AS record_id, user_id,
       CASE WHEN event_id % 7 = 0 THEN '/landing/part.jsonl'
            ELSE '/landing/2024/' || CAST(event_id AS VARCHAR) || '_' || event_type || '.jsonl' END AS source_file
FROM events WHERE event_id % 3 > 0 OR event_id % 7 > 0
"""

ORACLES["body_measures"] = f"""
WITH {_EV},
m AS (SELECT event_id, (k + 50) * 1000 * pow(10.0, -3) AS w, (user_id % 40 + 150) * pow(10.0, -2) AS h,
             CASE WHEN event_id % 6 > 0 THEN (k * 10 + 1) * pow(10.0, -1) END AS y
      FROM ev WHERE f5 IN (0, 2))
SELECT event_id, '2024-02-01' AS date, 'body' AS data_type, w AS weight, round(w / (h * h), 1) AS bmi,
       round(100.0 * y / w, 1) AS hydration_pct
FROM m
"""

ORACLES["epoch_window"] = """
SELECT 'range' AS part, event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS end_epoch
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'
UNION ALL
SELECT 'pull', event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) FROM events WHERE ts >= TIMESTAMP '2024-01-19 22:00:00'
"""

ORACLES["required_and_filled"] = f"""
WITH {_EV}
SELECT event_id, CASE WHEN event_id % 3 > 0 THEN event_type ELSE 'unknown' END AS kind,
       CASE WHEN event_id % 4 > 0 THEN k ELSE -1 END AS k,
       CAST((event_id % 3 = 0)::INTEGER + (event_id % 4 = 0)::INTEGER AS INTEGER) AS n_errors
FROM ev
"""


# ---- reads and exports ------------------------------------------------------------

ORACLES["rankings_together"] = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, rank, CAST({key} AS VARCHAR) AS id, play_count, total_duration_ms "
    f"FROM ({OTHERS[name]}) r WHERE period = 'last_30_days' AND rank <= 10"
    for kind, key, name in (("artists", "artist_id", "top_by_period_entity"), ("tracks", "track_id", "top_by_period_item"),
                            ("albums", "album_id", "top_by_period_brand")))

ORACLES["activity_list"] = f"""
WITH z AS ({OTHERS['zone_percentages']})
SELECT e.user_id, event_id AS activity_id, ts AS start_ts, ts + INTERVAL 30 MINUTE AS end_ts, value / 10 AS distance_km,
       zone1_pct, zone2_pct, zone3_pct, zone4_pct, zone5_pct, CAST(30 AS DOUBLE) AS duration_min
FROM events e LEFT JOIN z ON z.user_id = e.user_id WHERE event_type = 'purchase'
"""

ORACLES["activity_points"] = """
SELECT a.event_id AS activity_id, p.event_id, p.ts, p.value
FROM events a JOIN events p ON p.user_id = a.user_id AND p.ts BETWEEN a.ts AND a.ts + INTERVAL 30 MINUTE
WHERE a.event_type = 'purchase'
"""

for _key, _name in (("profile_overview", "entity_overview_streak"), ("profile_heatmap", "hour_weekday_heatmap"),
                    ("profile_tracks", "top_k_per_group_share"), ("profile_albums", "completion_rate"),
                    ("profile_calendar", "daily_calendar"), ("profile_evolution", "monthly_evolution")):
    ORACLES[_key] = f"SELECT * FROM ({OTHERS[_name]}) r WHERE artist_id = 7"

ORACLES["homepage_sizes"] = "SELECT " + ", ".join(
    f"(SELECT COUNT(*) FROM ({OTHERS[name]}) r) AS {part}"
    for part, name in (
        ("music_time_daily", "day_spine_fill"), ("running_weekly_volume", "week_spine_fill"),
        ("running_by_day", "running_by_day"), ("body_battery", "seven_day_array"), ("hrv", "median_baseline"),
        ("race_prediction", "latest_vs_30_days"), ("vo2max", "weekly_avg_array"), ("sleep_stages", "latest_day_stages"),
        ("steps", "steps_goal"), ("resting_hr", "resting_hr_week"), ("sleep_scores", "sleep_scores_week"),
        ("sleep_body_battery", "sleep_battery_week"), ("stress", "stress_week"), ("top_tracks", "top_tracks_recent"),
        ("top_artists", "top_entity_recent")))

ORACLES["hub_fact_played"] = """
SELECT l_orderkey * 100 + l_linenumber AS play_id, l_shipdate AS "playedAt", l_partkey AS "trackId",
       CAST(CAST(l_shipdate AS DATE) + 1 AS TIMESTAMP) AS _dp_inserted_at
FROM lineitem JOIN part ON p_partkey = l_partkey
"""

ORACLES["hub_bridge_albums_artists"] = f"""
WITH {_LOG_NESTED}
SELECT DISTINCT album_id, a.artistId AS artist_id FROM (SELECT albumId AS album_id, unnest(albumArtists) AS a FROM log)
"""

_SAVES = """
SELECT event_id, ts AS "addedAt", CAST(CAST(ts AS DATE) + CASE WHEN second THEN 2 ELSE 1 END AS DATE) AS _dp_inserted_at,
       CASE WHEN n >= 1 THEN run || '/' || CAST(event_id AS VARCHAR) || '/1' END AS "imageUrlLarge",
       CASE WHEN n >= 2 THEN run || '/' || CAST(event_id AS VARCHAR) || '/2' END AS "imageUrlMedium",
       CASE WHEN n >= 3 THEN run || '/' || CAST(event_id AS VARCHAR) || '/3' END AS "imageUrlSmall"
FROM (SELECT *, event_id % 2 = 0 AS second, event_id % 4 + (event_id % 2 = 0)::INTEGER AS n,
             CASE WHEN event_id % 2 = 0 THEN 'two' ELSE 'one' END AS run FROM events)
"""
ORACLES["staged_saved_albums"] = ORACLES["staged_saved_tracks"] = _SAVES

ORACLES["artist_document_sizes"] = f"""
WITH {STAR}, {EVENTS_FACT}, {_PRIMARY_STATS.format(fact='efact')}
SELECT artist_id, CAST(1 AS BIGINT) AS overview, least(20, COUNT(DISTINCT track_id)) AS top_tracks,
       COUNT(DISTINCT album_id) AS albums, COUNT(DISTINCT CAST(played_at AS DATE)) AS calendar,
       COUNT(DISTINCT dayofweek(played_at) * 24 + hour(played_at)) AS heatmap,
       COUNT(DISTINCT strftime(played_at, '%Y-%m')) AS evolution
FROM pstats GROUP BY artist_id
"""

ORACLES["exported_artists"] = f"""
WITH {STAR},
s AS (SELECT artist_id, COUNT(*) AS plays, MAX(played_at) AS last_played_at
      FROM fact JOIN primary_bridge USING (track_id) GROUP BY artist_id),
r AS (SELECT *, row_number() OVER (ORDER BY plays DESC, artist_id) AS place FROM s)
SELECT artist_id, plays, last_played_at FROM r WHERE place <= 20 OR last_played_at >= TIMESTAMP '2001-10-01'
"""

ORACLES["json_round_trip"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate, o_totalprice, o_custkey, o_orderpriority FROM orders
"""

ORACLES["csv_round_trip"] = """
SELECT o_orderkey, '{"o_custkey":' || CAST(o_custkey AS VARCHAR) || ',"o_orderstatus":"' || o_orderstatus || '"}' AS customer FROM orders
"""

ORACLES["pending_months"] = """
WITH b AS (SELECT MIN(CAST(o_orderdate AS DATE)) AS lo, MAX(CAST(o_orderdate AS DATE)) AS hi FROM orders),
m AS (SELECT CAST(unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) AS DATE) AS m, lo, hi FROM b),
s AS (SELECT greatest(m, lo) AS slice_start, least(last_day(m), hi) AS slice_end FROM m)
SELECT slice_start, slice_end FROM s
WHERE month(slice_start) % 3 > 0
   OR date_trunc('month', slice_start) NOT IN (SELECT date_trunc('month', o_orderdate) FROM orders)
"""

ORACLES["pending_chunks"] = """
WITH b AS (SELECT MIN(CAST(ts AS DATE)) AS lo, MAX(CAST(ts AS DATE)) AS hi FROM events),
s AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS slice_start, hi FROM b)
SELECT slice_start, least(slice_start + 6, hi) AS slice_end FROM s
WHERE day(slice_start) % 2 > 0 OR slice_start NOT IN (SELECT CAST(ts AS DATE) FROM events)
"""


# ---- landing files, streams, written tables ------------------------------------------

ORACLES["landing_names"] = """
SELECT event_id, date_trunc('minute', ts) AS file_at, 'app' AS service, event_type AS type_in_name,
       CASE WHEN event_type = 'purchase' THEN 'sales' WHEN event_type IN ('click', 'view') THEN 'traffic' END AS route,
       CASE event_type WHEN 'error' THEN 'faults' WHEN 'signup' THEN 'accounts' ELSE 'unknown' END AS keyword,
       CASE WHEN event_id % 3 = 0 THEN 'unknown' ELSE 'u' || CAST(user_id AS VARCHAR) END AS username,
       CASE WHEN event_id % 3 > 0 OR event_type IN ('click', 'view') THEN event_type ELSE 'unknown' END AS data_type
FROM events
"""

ORACLES["parsed_lines"] = """
SELECT CASE WHEN event_id % 6 IN (0, 4) THEN 'good' ELSE 'bad' END AS part, event_id,
       CASE WHEN event_id % 6 = 0 THEN event_id END AS id, CASE WHEN event_id % 6 IN (0, 4) THEN event_type END AS kind
FROM events WHERE event_id % 6 <> 1
"""

ORACLES["raw_envelopes"] = """
WITH t AS (
  SELECT *, CASE event_id % 6 WHEN 0 THEN '{"id": ' || CAST(event_id AS VARCHAR) || ', "kind": "' || event_type || '", "more": [1, {"a": null}]}'
                              ELSE '{"id": "no number", "kind": "' || event_type || '"}' END AS raw_data
  FROM events WHERE event_id % 6 IN (0, 4))
SELECT event_id, raw_data, 'event' AS data_type,
       'user_' || CAST(user_id AS VARCHAR) || '_' || CAST(event_id % 6 AS VARCHAR) AS source_file,
       CAST(length(raw_data) AS INTEGER) AS size, true AS stamped
FROM t
"""

ORACLES["files_without_records"] = """
SELECT DISTINCT 'user_' || CAST(user_id AS VARCHAR) || '_' || CAST(event_id % 6 AS VARCHAR) AS source_file
FROM events WHERE event_id % 6 NOT IN (0, 4)
"""

ORACLES["declared_fields"] = f"""
WITH {_EV}
SELECT event_id AS id, user_id AS uid, k AS n, 2 AS n_items, k AS first_n, 'z' AS second_t, k AS point_a, value AS point_b FROM ev
"""

ORACLES["inferred_fields"] = """
WITH e AS (SELECT event_id % 2 = 1 AS half, event_type, json_extract_string(props, '$.k') IS NOT NULL AS has_k FROM events),
s AS (SELECT bool_or(half AND has_k) AS halves, bool_or(has_k) AS ks, bool_or(event_type IS NOT NULL) AS kinds, COUNT(*) AS n FROM e)
SELECT 'id' AS field, 'bigint' AS type FROM s WHERE n > 0
UNION ALL SELECT 'reading', CASE WHEN halves THEN 'double' ELSE 'bigint' END FROM s WHERE ks
UNION ALL SELECT 'deep', 'struct<n:bigint>' FROM s WHERE ks
UNION ALL SELECT 'kind', 'string' FROM s WHERE kinds
UNION ALL SELECT 'flag', 'boolean' FROM s WHERE n > 0
UNION ALL SELECT 'list', 'array<string>' FROM s WHERE n > 0
"""

ORACLES["ingested_events"] = """
SELECT CASE WHEN length(event_type) <= 6 AND value BETWEEN 10 AND 180 THEN 'accepted' ELSE 'rejected' END AS part,
       event_id, date_trunc('millisecond', ts) AS at, event_type AS kind, value AS reading
FROM events WHERE event_id % 10 < 7
"""

ORACLES["streamed_windows"] = """
WITH mark AS (SELECT MAX(date_trunc('millisecond', ts)) - INTERVAL 1 DAY AS m FROM events),
w AS (
  SELECT 'day' AS unit, date_trunc('day', ts) AS s, date_trunc('day', ts) + INTERVAL 1 DAY AS e, event_type FROM events
  UNION ALL
  SELECT 'week', date_trunc('week', ts), date_trunc('week', ts) + INTERVAL 7 DAY, event_type FROM events
  UNION ALL
  SELECT 'slide', date_trunc('day', ts) - to_days(CAST(i AS INTEGER)), date_trunc('day', ts) - to_days(CAST(i AS INTEGER)) + INTERVAL 7 DAY,
         event_type
  FROM events, range(7) AS r(i))
SELECT unit, CAST(s AS TIMESTAMP) AS window_start, CAST(e AS TIMESTAMP) AS window_end, event_type, COUNT(*) AS events
FROM w, mark WHERE e <= m GROUP BY ALL
"""

ORACLES["streamed_dedupe"] = "SELECT event_id, ts, user_id FROM events"

ORACLES["streamed_merge"] = """
SELECT event_id, date_trunc('millisecond', ts + CASE WHEN event_id % 2 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END) AS at,
       event_type AS kind, value + CASE WHEN event_id % 2 = 0 THEN 1000 ELSE 0 END AS reading
FROM events
"""

ORACLES["merged_days"] = """
SELECT event_id, value + (event_id % 3 = 0)::INTEGER AS value, CAST(CAST(ts AS DATE) + (event_id % 3 = 0)::INTEGER AS DATE) AS day,
       true AS stamped
FROM events
"""

ORACLES["model_run"] = """
SELECT user_id, COUNT(*) AS events, COUNT(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY user_id
"""

ORACLES["streamed_window_dedupe"] = OTHERS["window_dedupe"]

ORACLES["streamed_chain_dedupe"] = OTHERS["window_dedupe"]

ORACLES["streamed_months"] = """
WITH mark AS (SELECT MAX(l_shipdate) - INTERVAL 1 DAY AS m FROM lineitem)
SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS window_start,
       CAST(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS TIMESTAMP) AS window_end, l_returnflag,
       COUNT(*) AS events, SUM(l_quantity) AS quantity
FROM lineitem, mark WHERE date_trunc('month', l_shipdate) + INTERVAL 1 MONTH <= m GROUP BY ALL
"""

ORACLES["evolved_table"] = """
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id % 4 AS form FROM events)
SELECT event_id, CASE WHEN form = 2 THEN value ELSE CAST(k AS DOUBLE) END AS reading, user_id AS owner_id,
       CASE WHEN form = 2 THEN k END AS owner_n, CASE WHEN form = 1 THEN event_type END AS event_type,
       CASE WHEN form >= 2 THEN k END AS mark_a, CASE WHEN form = 3 THEN event_type END AS mark_b,
       CAST(form AS INTEGER) AS version
FROM e
"""

ORACLES["ingest_outcome"] = """
WITH e AS (
  SELECT event_type, CASE WHEN event_id % 10 = 7 THEN 'blank' WHEN event_id % 10 > 7 THEN 'bad'
                          WHEN length(event_type) <= 6 AND value BETWEEN 10 AND 180 THEN 'accepted' ELSE 'rejected' END AS s
  FROM events),
f AS (
  SELECT event_type, COUNT(*) FILTER (s = 'accepted') AS accepted, COUNT(*) FILTER (s = 'rejected') AS rejected,
         COUNT(*) FILTER (s = 'bad') AS bad
  FROM e GROUP BY event_type),
t AS (SELECT COUNT(*) AS n, CAST(SUM(accepted) AS BIGINT) AS a, CAST(SUM(rejected) AS BIGINT) AS r, CAST(SUM(bad) AS BIGINT) AS b FROM f)
SELECT 'file' AS part, event_type AS name, accepted, rejected, bad, CAST(NULL AS BIGINT) AS moved FROM f
UNION ALL SELECT 'dry run', CAST(n AS VARCHAR), a, r, b, 0 FROM t
UNION ALL SELECT 'run', CAST(n AS VARCHAR), a, r, b, n FROM t
UNION ALL SELECT 'alert', 'rejection rate ' || printf('%.3f', r / (a + r)) || ' > 0.1', NULL, NULL, NULL, NULL
FROM t WHERE r / (a + r) > 0.1
"""

ORACLES["clustered_table"] = """
SELECT user_id, COUNT(*) AS events, true AS pruned FROM events WHERE event_type <> 'error' GROUP BY user_id
"""

ORACLES["ranking_documents"] = ORACLES["rankings_together"]

ORACLES["model_increments"] = """
WITH m AS (SELECT MAX(CAST(ts AS DATE)) AS mark FROM events WHERE ts < TIMESTAMP '2024-01-15')
SELECT event_id,
       CASE WHEN event_id % 7 = 0 THEN value + 5000 WHEN CAST(ts AS DATE) > mark THEN value + 1000 ELSE value END AS reading,
       CAST(CASE WHEN event_id % 7 = 0 THEN DATE '2024-02-01' ELSE CAST(ts AS DATE) END AS DATE) AS delivered,
       CAST(CASE WHEN event_id % 7 = 0 OR CAST(ts AS DATE) > mark THEN DATE '2024-02-01' ELSE mark END AS DATE) AS high_water
FROM events, m
"""

ORACLES["legacy_arrays"] = """
WITH v AS (SELECT vec_id AS id, embedding AS e FROM embeddings),
pair AS (SELECT id, 'pair' AS part, CAST(i AS INTEGER) AS row_no, CAST(e[2 * i + 1] AS DOUBLE) AS v0, CAST(e[2 * i + 2] AS DOUBLE) AS v1,
                CAST(NULL AS DOUBLE) AS v2
         FROM (SELECT id, e, unnest(range(0, len(e) // 2)) AS i FROM v)),
deep AS (SELECT id, 'deep' AS part, CAST(i AS INTEGER) AS row_no, CAST(e[3 * i + 1] AS DOUBLE) AS v0, CAST(e[3 * i + 2] AS DOUBLE) AS v1,
                CAST(e[3 * i + 3] AS DOUBLE) AS v2
         FROM (SELECT id, e, unnest(range(0, (len(e) + 2) // 3)) AS i FROM v)),
cell AS (SELECT id, 'list' AS part, CAST(i AS INTEGER) AS row_no, CAST(e[2 * i + 1] AS DOUBLE) AS v0, CAST(e[2 * i + 2] AS DOUBLE) AS v1,
                CAST(NULL AS DOUBLE) AS v2
         FROM (SELECT id, e, unnest(range(0, len(e) // 2)) AS i FROM v))
SELECT * FROM pair UNION ALL SELECT * FROM deep UNION ALL SELECT * FROM cell
"""

_TILES = {
    "music_time_daily": ("day_spine_fill", "date", "total_duration_ms", "bar_height_percent"),
    "running_weekly_volume": ("week_spine_fill", "week_start", "total_km", "runs"),
    "running_by_day": ("running_by_day", "date", "km", "runs", "aerobic"),
    "body_battery": ("seven_day_array", "date", "highest", "lowest", "gain"),
    "hrv": ("median_baseline", "date", "hrv", "baseline", "height_pct"),
    "race_prediction": ("latest_vs_30_days", "metric", "current_value", "previous_value", "delta"),
    "vo2max": ("weekly_avg_array", "week_start", "weekly_avg", "current_value", "delta"),
    "sleep_stages": ("latest_day_stages", "date", "total", "pct"),
    "steps": ("steps_goal", "date", "steps", "goal", "goal_pct"),
    "resting_hr": ("resting_hr_week", "date", "value", "display_height_percent", "average"),
    "sleep_scores": ("sleep_scores_week", "date", "score", "average"),
    "sleep_body_battery": ("sleep_battery_week", "date", "sleep_score", "battery_at_bedtime", "battery_gain"),
    "stress": ("stress_week", "date", "avg_stress", "max_stress", "average_stress"),
    "top_tracks": ("top_tracks_recent", "rank", "play_count", "track_id"),
    "top_artists": ("top_entity_recent", "rank", "total_duration_ms", "play_count", "artist_id"),
}


def _tile(tile: str, query: str, key: str, *figures: str) -> str:
    cells = [f"CAST(r.{c} AS DOUBLE)" for c in figures] + ["CAST(NULL AS DOUBLE)"] * (3 - len(figures))
    named = ", ".join(f"{c} AS v{i}" for i, c in enumerate(cells, 1))
    return f"SELECT '{tile}' AS tile, substr(CAST(r.{key} AS VARCHAR), 1, 10) AS name, {named} FROM ({OTHERS[query]}) r"


ORACLES["home_page_tiles"] = " UNION ALL ".join(_tile(t, *spec) for t, spec in _TILES.items())

for _part, _same in (("overview", "entity_overview_streak"), ("top_tracks", "top_k_per_group_share"), ("albums", "completion_rate"),
                     ("calendar", "daily_calendar"), ("heatmap", "hour_weekday_heatmap"), ("evolution", "monthly_evolution")):
    ORACLES[f"artist_documents_{_part}"] = OTHERS[_same]

_SOURCES = [  # name, number of key columns, whether another column orders before the delivery time
    *[(f"activity_{x}" if x else "activities", 1, False) for x in ("", "details", "exercise_sets", "hr_zones", "splits", "weather")],
    ("all_day_events", 2, False), ("body_battery", 1, False), ("body_composition", 1, False), ("endurance_score", 1, False),
    ("floors", 1, False), ("heart_rate", 1, False), ("hill_score", 1, True), ("hrv", 1, False), ("intensity_minutes", 1, False),
    ("max_metrics", 1, False), ("race_predictions", 1, False), ("respiration", 1, False), ("rhr_daily", 1, False),
    ("sleep", 1, False), ("spo2", 1, False), ("stats_and_body", 1, False), ("steps", 1, False), ("stress", 1, False),
    ("training_readiness", 2, False), ("training_status", 1, False), ("user_summary", 1, False), ("weight", 1, False),
    ("artist_enrichment", 1, True), ("recently_played", 1, False), ("saved_albums", 1, False), ("saved_tracks", 1, False),
]
ORACLES["staged_sources"] = " UNION ALL ".join(
    f"""
SELECT '{name}' AS dataset, {f"CAST(event_id // {6 + 2 * (n % 4)} AS VARCHAR) || '/' || " if keys == 2 else ""}
       CAST(event_id // {3 + n % 4} AS VARCHAR) AS key,
       arg_max(event_id, ({"(event_id * 7) % 5, " if extra else ""}ts, 0)) AS event_id
FROM events GROUP BY event_id // {3 + n % 4}{f", event_id // {6 + 2 * (n % 4)}" if keys == 2 else ""}"""
    for n, (name, keys, extra) in enumerate(_SOURCES))

ORACLES["explicit_schema_load"] = f"""
WITH {_EV}
SELECT event_id AS id, user_id AS athlete_id, event_type AS kind, CASE WHEN event_id % 3 > 0 THEN props END AS line,
       CAST(CASE WHEN event_id % 4 > 0 THEN 2 END AS INTEGER) AS n_points,
       CASE WHEN event_id % 4 > 0 THEN date_trunc('second', ts) END AS first_at,
       CASE WHEN event_id % 4 > 0 THEN CAST(k AS DOUBLE) END AS second_v, event_type || '|z' AS tags,
       CASE WHEN event_id % 5 > 0 THEN CAST(ts AS DATE) END AS day
FROM ev
"""

ORACLES["selected_datasets"] = """
WITH f AS (SELECT user_id, CASE WHEN event_type = 'purchase' THEN 'sales' WHEN event_type IN ('click', 'view') THEN 'traffic'
                                ELSE 'other' END AS dataset FROM events)
SELECT 'list' AS mode, dataset, COUNT(*) AS files FROM f WHERE dataset IN ('sales', 'traffic') GROUP BY dataset
UNION ALL SELECT 'owner', dataset, COUNT(*) FROM f WHERE user_id = 7 GROUP BY dataset
UNION ALL SELECT 'all', dataset, COUNT(*) FROM f GROUP BY dataset
"""
