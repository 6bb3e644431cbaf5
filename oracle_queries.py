"""DuckDB oracle SQL for every registered query (see ``__spark_entry__.oracle_sql``).

Each string runs on DuckDB views named after the provided tables.  The SQL
is written independently of the Spark code, straight from the query's
definition, so a match is evidence both are right.  DuckDB traps handled
here: ``||`` instead of ``concat`` (null-propagating), floor() cast to
BIGINT before text, explicit tie-breaks, ``NULLS`` ordering stated.
"""

STAR = """
fact AS (
  SELECT l_orderkey * 100 + l_linenumber AS play_id, l_shipdate AS played_at, l_partkey AS track_id
  FROM lineitem),
tracks AS (
  SELECT p_partkey AS track_id, p_name AS track_name, p_brand AS album_id,
         CAST(p_size AS BIGINT) * 6000 AS duration_ms
  FROM part),
albums AS (
  SELECT p_brand AS album_id, p_brand AS album_name, COUNT(*) AS total_tracks FROM part GROUP BY p_brand),
artists AS (SELECT s_suppkey AS artist_id, s_name AS artist_name FROM supplier),
bridge AS (
  SELECT track_id, artist_id,
         CAST(row_number() OVER (PARTITION BY track_id ORDER BY artist_id) - 1 AS INTEGER) AS artist_position
  FROM (SELECT DISTINCT l_partkey AS track_id, l_suppkey AS artist_id FROM lineitem)),
primary_bridge AS (SELECT track_id, artist_id FROM bridge WHERE artist_position = 0)
"""

EVENTS_FACT = """
efact AS (
  SELECT event_id AS play_id, ts AS played_at,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS track_id, user_id AS listener_id
  FROM events)
"""


def hms(x: str) -> str:
    return (f"(CAST(CAST(floor({x} / 3600000) AS BIGINT) AS VARCHAR) || 'h ' || "
            f"CAST(CAST(floor(({x} % 3600000) / 60000) AS BIGINT) AS VARCHAR) || 'm ' || "
            f"CAST(CAST(floor(({x} % 60000) / 1000) AS BIGINT) AS VARCHAR) || 's')")


def hm(x: str) -> str:
    return (f"(CASE WHEN floor({x} / 3600000) > 0 THEN "
            f"CAST(CAST(floor({x} / 3600000) AS BIGINT) AS VARCHAR) || 'h ' || "
            f"CAST(CAST(floor(({x} % 3600000) / 60000) AS BIGINT) AS VARCHAR) || 'm' "
            f"ELSE CAST(CAST(floor({x} / 60000) AS BIGINT) AS VARCHAR) || 'm' END)")


def ell(x: str) -> str:
    return f"(CASE WHEN length({x}) > 40 THEN substr({x}, 1, 37) || '...' ELSE {x} END)"


PERIODS_SQL = """
periods AS (
  SELECT * FROM (VALUES ('all_time', NULL, 20, 1), ('last_365_days', 365, 20, 2), ('last_30_days', 30, 20, 3),
                        ('last_7_days', 7, 20, 4), ('yesterday', 1, 10, 5)) AS p(period, days, lim, ord))
"""

ORACLES: dict[str, str] = {}

ORACLES["top_by_period_item"] = f"""
WITH {STAR}, {PERIODS_SQL},
per AS (
  SELECT p.period, p.lim, f.track_id, COUNT(*) AS n
  FROM fact f JOIN periods p
    ON p.days IS NULL OR CAST(f.played_at AS DATE) >= DATE '2001-11-05' - CAST(p.days AS INTEGER)
  GROUP BY p.period, p.lim, f.track_id),
ranked AS (
  SELECT per.*, t.track_name, per.n * t.duration_ms AS total_duration_ms,
         row_number() OVER (PARTITION BY per.period ORDER BY per.n * t.duration_ms DESC, per.track_id) AS rank
  FROM per LEFT JOIN tracks t USING (track_id)),
names AS (
  SELECT b.track_id,
         string_agg(a.artist_name, ', ' ORDER BY b.artist_position) AS all_artist_names,
         string_agg(CAST(b.artist_id AS VARCHAR), ',' ORDER BY b.artist_position) AS artist_ids
  FROM bridge b LEFT JOIN artists a USING (artist_id) GROUP BY b.track_id)
SELECT CAST(rank AS INTEGER) AS rank, period, {ell('track_name')} AS track_name, {ell('all_artist_names')} AS all_artist_names,
       {hms('total_duration_ms')} AS total_duration, total_duration_ms, n AS play_count, track_id, artist_ids
FROM ranked LEFT JOIN names USING (track_id)
WHERE rank <= lim
"""

_PER_TRACK_PERIOD = """
per AS (
  SELECT p.period, p.lim, f.track_id, COUNT(*) AS n
  FROM fact f JOIN periods p
    ON p.days IS NULL OR CAST(f.played_at AS DATE) >= DATE '2001-11-05' - CAST(p.days AS INTEGER)
  GROUP BY p.period, p.lim, f.track_id)
"""

ORACLES["top_by_period_entity"] = f"""
WITH {STAR}, {PERIODS_SQL}, {_PER_TRACK_PERIOD},
fan AS (
  SELECT per.period, per.lim, b.artist_id,
         CAST(SUM(per.n * t.duration_ms) AS BIGINT) AS total_duration_ms, CAST(SUM(per.n) AS BIGINT) AS play_count
  FROM per LEFT JOIN tracks t USING (track_id) LEFT JOIN bridge b USING (track_id)
  GROUP BY per.period, per.lim, b.artist_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY period ORDER BY total_duration_ms DESC, artist_id) AS rank FROM fan)
SELECT CAST(rank AS INTEGER) AS rank, period, {ell('artist_name')} AS artist_name, {hms('total_duration_ms')} AS total_duration,
       total_duration_ms, play_count, artist_id
FROM ranked LEFT JOIN artists USING (artist_id) WHERE rank <= lim
"""

ORACLES["top_by_period_brand"] = f"""
WITH {STAR}, {PERIODS_SQL}, {_PER_TRACK_PERIOD},
per_album AS (
  SELECT per.period, per.lim, t.album_id,
         CAST(SUM(per.n * t.duration_ms) AS BIGINT) AS total_duration_ms, CAST(SUM(per.n) AS BIGINT) AS play_count,
         COUNT(*) AS tracks_played
  FROM per LEFT JOIN tracks t USING (track_id)
  GROUP BY per.period, per.lim, t.album_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY period ORDER BY total_duration_ms DESC, album_id) AS rank
  FROM per_album)
SELECT CAST(rank AS INTEGER) AS rank, period, album_name, {hms('total_duration_ms')} AS total_duration, total_duration_ms, play_count,
       tracks_played, album_id
FROM ranked LEFT JOIN albums USING (album_id) WHERE rank <= lim
"""

_TRACK_TOTALS = """
totals AS (
  SELECT f.track_id, t.track_name, t.album_id, COUNT(*) AS play_count,
         COUNT(*) * t.duration_ms AS total_duration_ms
  FROM fact f LEFT JOIN tracks t USING (track_id)
  GROUP BY f.track_id, t.track_name, t.album_id, t.duration_ms)
"""

ORACLES["top_k_all_time"] = f"""
WITH {STAR}, {_TRACK_TOTALS},
names AS (
  SELECT b.track_id, string_agg(a.artist_name, ', ' ORDER BY b.artist_position) AS all_artist_names
  FROM bridge b JOIN artists a USING (artist_id) GROUP BY b.track_id),
top AS (SELECT *, row_number() OVER (ORDER BY total_duration_ms DESC, track_id) AS rank FROM totals)
SELECT CAST(rank AS INTEGER) AS rank, {ell('track_name')} AS track_name, {ell('all_artist_names')} AS all_artist_names,
       {hms('total_duration_ms')} AS total_duration, total_duration_ms, play_count, track_id
FROM top LEFT JOIN names USING (track_id) WHERE rank <= 20
"""

ORACLES["top_album_all_time"] = f"""
WITH {STAR}, {_TRACK_TOTALS},
per_album AS (
  SELECT album_id, CAST(SUM(total_duration_ms) AS BIGINT) AS total_duration_ms,
         CAST(SUM(play_count) AS BIGINT) AS play_count
  FROM totals GROUP BY album_id),
top AS (SELECT *, row_number() OVER (ORDER BY total_duration_ms DESC, album_id) AS rank FROM per_album)
SELECT CAST(rank AS INTEGER) AS rank, album_name, {hms('total_duration_ms')} AS total_duration, total_duration_ms, play_count, album_id
FROM top LEFT JOIN albums USING (album_id) WHERE rank <= 20
"""

ORACLES["top_entity_with_nested_items"] = f"""
WITH {STAR}, {_TRACK_TOTALS},
names AS (
  SELECT b.track_id, string_agg(a.artist_name, ', ' ORDER BY b.artist_position) AS all_artist_names
  FROM bridge b JOIN artists a USING (artist_id) GROUP BY b.track_id),
fan AS (SELECT t.*, b.artist_id FROM totals t LEFT JOIN bridge b USING (track_id)),
stats AS (
  SELECT fan.artist_id, names.all_artist_names,
         CAST(SUM(fan.total_duration_ms) AS BIGINT) AS total_duration_ms,
         CAST(SUM(fan.play_count) AS BIGINT) AS play_count
  FROM fan LEFT JOIN names USING (track_id) GROUP BY fan.artist_id, names.all_artist_names),
credit_ids AS (SELECT all_artist_names, MIN(track_id) AS credit_id FROM names GROUP BY all_artist_names),
ranking AS (
  SELECT stats.*, row_number() OVER (ORDER BY total_duration_ms DESC, artist_id, credit_id) AS rank
  FROM stats JOIN credit_ids USING (all_artist_names)),
top AS (SELECT * FROM ranking WHERE rank <= 20),
best AS (
  SELECT artist_id, track_name, total_duration_ms AS track_ms, play_count AS track_plays,
         row_number() OVER (PARTITION BY artist_id ORDER BY total_duration_ms DESC, track_id) AS track_rank
  FROM fan WHERE artist_id IN (SELECT artist_id FROM top)),
best10 AS (SELECT * FROM best WHERE track_rank <= 10)
SELECT CAST(top.rank AS INTEGER) AS rank, {ell('a.artist_name')} AS artist_name, {hms('top.total_duration_ms')} AS total_duration,
       top.play_count, top.artist_id,
       CAST(to_json(list(struct_pack(rank := best10.track_rank, track_name := best10.track_name,
                                percentage := round(best10.track_ms / top.total_duration_ms * 100, 1),
                                duration := {hm('best10.track_ms')}, play_count := best10.track_plays)
               ORDER BY best10.track_rank)) AS VARCHAR) AS tracks
FROM top LEFT JOIN artists a USING (artist_id) LEFT JOIN best10 USING (artist_id)
GROUP BY top.rank, a.artist_name, top.all_artist_names, top.total_duration_ms, top.play_count, top.artist_id
"""

_PRIMARY_STATS = """
pstats AS (
  SELECT f.*, pb.artist_id, t.album_id, t.track_name, t.duration_ms
  FROM {fact} f JOIN primary_bridge pb USING (track_id) JOIN tracks t USING (track_id))
"""

ORACLES["top_k_per_group_share"] = f"""
WITH {STAR}, {_PRIMARY_STATS.format(fact='fact')},
ts AS (
  SELECT artist_id, track_id, track_name, COUNT(*) AS play_count,
         CAST(SUM(duration_ms) AS BIGINT) AS total_duration_ms,
         MIN(played_at) AS first_played_at, MAX(played_at) AS last_played_at
  FROM pstats GROUP BY artist_id, track_id, track_name),
shared AS (
  SELECT *, round(CAST(100 AS DOUBLE) * total_duration_ms
                  / nullif(SUM(total_duration_ms) OVER (PARTITION BY artist_id), 0), 1) AS pct_of_artist_time,
         row_number() OVER (PARTITION BY artist_id ORDER BY total_duration_ms DESC, track_id) AS track_rank
  FROM ts)
SELECT artist_id, CAST(track_rank AS INTEGER) AS track_rank, track_id, track_name, play_count, {hms('total_duration_ms')} AS total_duration,
       total_duration_ms, CAST(first_played_at AS VARCHAR) AS first_played_at,
       CAST(last_played_at AS VARCHAR) AS last_played_at, pct_of_artist_time
FROM shared WHERE track_rank <= 20
"""

ORACLES["completion_rate"] = f"""
WITH {STAR}, {_PRIMARY_STATS.format(fact='fact')},
ap AS (
  SELECT artist_id, album_id, COUNT(DISTINCT track_id) AS tracks_heard, COUNT(*) AS total_plays,
         CAST(SUM(duration_ms) AS BIGINT) AS total_duration_ms,
         MIN(played_at) AS first_played_at, MAX(played_at) AS last_played_at
  FROM pstats GROUP BY artist_id, album_id),
j AS (
  SELECT ap.*, al.album_name, al.total_tracks,
         round(CAST(100 AS DOUBLE) * ap.tracks_heard / nullif(al.total_tracks, 0), 1) AS completion_rate
  FROM ap JOIN albums al USING (album_id))
SELECT artist_id, album_id, album_name, total_tracks, tracks_heard, total_plays,
       {hms('total_duration_ms')} AS total_duration, total_duration_ms,
       CAST(first_played_at AS VARCHAR) AS first_played_at, CAST(last_played_at AS VARCHAR) AS last_played_at,
       completion_rate,
       CASE WHEN completion_rate >= 90 THEN 'complete' WHEN completion_rate >= 50 THEN 'partial'
            ELSE 'shallow' END AS listen_depth
FROM j
"""

ORACLES["monthly_evolution"] = f"""
WITH {STAR}, {_PRIMARY_STATS.format(fact='fact')},
m AS (
  SELECT artist_id, strftime(played_at, '%Y-%m') AS year_month, COUNT(*) AS play_count,
         COUNT(DISTINCT track_id) AS unique_tracks, CAST(SUM(duration_ms) AS BIGINT) AS total_duration_ms
  FROM pstats GROUP BY artist_id, strftime(played_at, '%Y-%m'))
SELECT artist_id, year_month, play_count, unique_tracks, total_duration_ms, {hm('total_duration_ms')} AS total_duration
FROM m
"""

ORACLES["daily_calendar"] = f"""
WITH {STAR}, {_PRIMARY_STATS.format(fact='fact')},
d AS (
  SELECT artist_id, CAST(played_at AS DATE) AS listen_date, COUNT(*) AS play_count,
         CAST(SUM(duration_ms) AS BIGINT) AS total_duration_ms
  FROM pstats GROUP BY artist_id, CAST(played_at AS DATE))
SELECT artist_id, CAST(listen_date AS VARCHAR) AS listen_date, play_count, total_duration_ms,
       {hm('total_duration_ms')} AS total_duration
FROM d
"""

ORACLES["hour_weekday_heatmap"] = f"""
WITH {STAR}, {EVENTS_FACT}, {_PRIMARY_STATS.format(fact='efact')}
SELECT artist_id, CAST(hour(played_at) AS INTEGER) AS hour_of_day,
       CAST(dayofweek(played_at) + 1 AS INTEGER) AS day_of_week, dayname(played_at) AS day_name,
       COUNT(*) AS play_count, CAST(SUM(duration_ms) AS BIGINT) AS total_duration_ms
FROM pstats GROUP BY ALL
"""

ORACLES["entity_overview_streak"] = f"""
WITH {STAR}, {EVENTS_FACT}, {_PRIMARY_STATS.format(fact='efact')},
s AS (
  SELECT artist_id, COUNT(*) AS total_plays, CAST(SUM(duration_ms) AS BIGINT) AS total_duration_ms,
         COUNT(DISTINCT track_id) AS unique_tracks, COUNT(DISTINCT album_id) AS unique_albums,
         MIN(CAST(played_at AS DATE)) AS first_played_date, MAX(CAST(played_at AS DATE)) AS last_played_date,
         COUNT(DISTINCT CAST(played_at AS DATE)) AS days_with_listens
  FROM pstats GROUP BY artist_id),
days AS (
  SELECT DISTINCT artist_id, CAST(played_at AS DATE) AS d FROM pstats WHERE CAST(played_at AS DATE) <= DATE '2024-01-30'),
numbered AS (
  SELECT artist_id, DATE '2024-01-30' - d AS days_ago,
         row_number() OVER (PARTITION BY artist_id ORDER BY d DESC) AS rn
  FROM days),
streaks AS (SELECT artist_id, COUNT(*) AS current_streak FROM numbered WHERE days_ago = rn - 1 GROUP BY artist_id)
SELECT s.artist_id, a.artist_name, s.total_plays, {hms('s.total_duration_ms')} AS total_duration,
       s.total_duration_ms, s.unique_tracks, s.unique_albums,
       CAST(s.first_played_date AS VARCHAR) AS first_heard, CAST(s.last_played_date AS VARCHAR) AS last_heard,
       s.days_with_listens,
       CAST(DATE '2024-01-30' - s.first_played_date AS INTEGER) AS days_since_discovery,
       round(CAST(100 AS DOUBLE) * s.days_with_listens / nullif(DATE '2024-01-30' - s.first_played_date, 0), 1)
         AS consistency_score,
       round(s.total_plays / nullif(s.days_with_listens, 0), 1) AS avg_plays_per_active_day,
       CAST(COALESCE(st.current_streak, 0) AS BIGINT) AS current_streak
FROM s JOIN artists a USING (artist_id) LEFT JOIN streaks st USING (artist_id)
"""

ORACLES["top_tracks_recent"] = f"""
WITH {STAR}, {EVENTS_FACT},
totals AS (
  SELECT f.track_id, t.track_name, COUNT(*) AS play_count, COUNT(*) * t.duration_ms AS total_duration_ms
  FROM efact f LEFT JOIN tracks t USING (track_id)
  WHERE f.played_at >= CAST(DATE '2024-01-31' - 7 AS TIMESTAMP)
  GROUP BY f.track_id, t.track_name, t.duration_ms),
top AS (SELECT *, row_number() OVER (ORDER BY total_duration_ms DESC, track_id) AS rank FROM totals),
names AS (
  SELECT b.track_id, string_agg(a.artist_name, ', ' ORDER BY b.artist_position) AS all_artist_names,
         string_agg(CAST(b.artist_id AS VARCHAR), ',' ORDER BY b.artist_position) AS artist_ids
  FROM bridge b LEFT JOIN artists a USING (artist_id) GROUP BY b.track_id)
SELECT CAST(rank AS INTEGER) AS rank, {ell('track_name')} AS track_name, {ell('all_artist_names')} AS all_artist_names,
       {hms('total_duration_ms')} AS total_duration, play_count, track_id, artist_ids
FROM top LEFT JOIN names USING (track_id) WHERE rank <= 10
"""

ORACLES["top_entity_recent"] = f"""
WITH {STAR}, {EVENTS_FACT},
per_artist AS (
  SELECT pb.artist_id, CAST(SUM(t.duration_ms) AS BIGINT) AS total_duration_ms, COUNT(*) AS play_count
  FROM efact f JOIN primary_bridge pb USING (track_id) LEFT JOIN tracks t USING (track_id)
  WHERE f.played_at >= CAST(DATE '2024-01-31' - 7 AS TIMESTAMP)
  GROUP BY pb.artist_id),
top AS (SELECT *, row_number() OVER (ORDER BY total_duration_ms DESC, artist_id) AS rank FROM per_artist)
SELECT CAST(rank AS INTEGER) AS rank, {ell('artist_name')} AS artist_name, {hms('total_duration_ms')} AS total_duration,
       total_duration_ms, play_count, artist_id
FROM top LEFT JOIN artists USING (artist_id) WHERE rank <= 10
"""

# ---- lake layer: keep-latest, incremental, merge -------------------------

ORACLES["keep_latest_single"] = """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1
"""

ORACLES["keep_latest_composite"] = """
SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey
                               ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn
  FROM lineitem) WHERE rn = 1
"""

ORACLES["keep_latest_two_orders"] = """
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1
"""

ORACLES["incremental_filter"] = """
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20')
"""

ORACLES["merge_upsert"] = """
WITH target AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders
  WHERE o_orderdate < TIMESTAMP '2000-01-01'),
source AS (
  SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 100.0 AS o_totalprice, o_orderdate
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM source
"""

# ---- quality ----------------------------------------------------------------

_LI_ERRORS = """
list_filter([
  CASE WHEN l_shipdate IS NULL THEN 'l_shipdate: is null' END,
  CASE WHEN l_quantity < 1 OR l_quantity > 45 THEN 'l_quantity: outside [1, 45]' END,
  CASE WHEN l_discount < 0.0 OR l_discount > 0.08 THEN 'l_discount: outside [0.0, 0.08]' END,
  CASE WHEN l_tax <= 0 THEN 'l_tax: must be positive' END,
  CASE WHEN length(l_returnflag) > 1 THEN 'l_returnflag: longer than 1' END,
  CASE WHEN CAST(l_shipdate AS DATE) < DATE '1995-01-01' OR CAST(l_shipdate AS DATE) > DATE '2001-06-30'
       THEN 'l_shipdate: date outside [1995-01-01, 2001-06-30]' END
], lambda x: x IS NOT NULL)
"""

ORACLES["quality_errors"] = f"""
SELECT l_orderkey, l_linenumber, CAST(len(errs) AS INTEGER) AS n_errors, array_to_string(errs, '; ') AS errors
FROM (SELECT *, {_LI_ERRORS} AS errs FROM lineitem) WHERE len(errs) > 0
"""

ORACLES["quality_split"] = f"""
SELECT CASE WHEN len(errs) = 0 THEN 'accepted' ELSE 'quarantined' END AS status, COUNT(*) AS records
FROM (SELECT {_LI_ERRORS} AS errs FROM lineitem) GROUP BY 1
"""

ORACLES["unique_violations"] = """
SELECT l_partkey, l_suppkey, COUNT(*) AS occurrences FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1
"""

_CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORACLES["not_null_violations"] = " UNION ALL ".join(
    [f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
     f"'customer' AS table_name FROM customer" for c in _CUSTOMER_COLS]
    + [f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
       f"'orders' AS table_name FROM orders" for c in _ORDERS_COLS])

ORACLES["rejection_rate"] = f"""
SELECT records_read, records_valid, records_rejected,
       round(records_valid / nullif(records_read, 0), 4) AS success_rate,
       round(records_rejected / nullif(records_read, 0), 4) AS rejection_rate
FROM (SELECT COUNT(*) AS records_read, count(*) FILTER (WHERE len(errs) = 0) AS records_valid,
             count(*) FILTER (WHERE len(errs) > 0) AS records_rejected
      FROM (SELECT {_LI_ERRORS} AS errs FROM lineitem))
"""

# ---- nested values ----------------------------------------------------------

ORACLES["json_extract_scalar"] = """
SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, COUNT(*) AS events, round(sum(value), 2) AS total_value
FROM events GROUP BY 1
"""

ORACLES["array_explode_offset"] = """
SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS line_no, CAST(length(unnest(parts)) AS INTEGER) AS line_chars
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
"""

ORACLES["array_safe_index"] = """
SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words, w[1] AS first_word, w[3] AS third_word,
       CASE WHEN len(w) > 0 THEN w[-1] END AS last_word, w[100001] AS far_word
FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)
"""

ORACLES["nested_struct_build"] = """
SELECT o_orderkey,
       CAST(to_json(struct_pack(order_key := o_orderkey, status := o_orderstatus,
               customer := struct_pack(key := c_custkey, name := c_name,
                                       nation := struct_pack(key := n_nationkey, name := n_name)))) AS VARCHAR) AS order_json
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
"""

ORACLES["flatten_pairs"] = """
SELECT vec_id, CAST(i AS INTEGER) AS pair_idx, CAST(embedding[2 * i + 1] AS DOUBLE) AS timestamp,
       CAST(embedding[2 * i + 2] AS DOUBLE) AS value
FROM embeddings, range(0, len(embedding) // 2) AS r(i)
"""

ORACLES["descriptor_expand"] = """
WITH e AS (SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
SELECT event_id, 0 AS idx, value, k, 2 AS n_keys FROM e
UNION ALL SELECT event_id, 1, -value, k + 1, 2 FROM e
UNION ALL SELECT event_id, 2, NULL, k, 1 FROM e
"""

ORACLES["measure_pivot"] = """
SELECT user_id, CAST(ts AS DATE) AS day,
       round(sum(value) FILTER (WHERE event_type = 'click'), 2) AS click,
       round(sum(value) FILTER (WHERE event_type = 'error'), 2) AS error,
       round(sum(value) FILTER (WHERE event_type = 'purchase'), 2) AS purchase,
       round(sum(value) FILTER (WHERE event_type = 'signup'), 2) AS signup,
       round(sum(value) FILTER (WHERE event_type = 'view'), 2) AS view
FROM events GROUP BY 1, 2
"""

ORACLES["window_dedupe"] = """
WITH RECURSIVE kept(user_id, ts) AS (
  SELECT user_id, MIN(ts) FROM events GROUP BY user_id
  UNION ALL
  SELECT e.user_id, MIN(e.ts) FROM events e JOIN kept k ON e.user_id = k.user_id AND e.ts >= k.ts + INTERVAL 24 HOUR
  GROUP BY e.user_id)
SELECT e.user_id, e.event_id, e.ts FROM kept k JOIN events e ON e.user_id = k.user_id AND e.ts = k.ts
"""

ORACLES["minute_anti_join"] = """
SELECT s.event_id, s.user_id, s.ts FROM events s
WHERE s.ts >= TIMESTAMP '2024-01-20' AND NOT EXISTS (
  SELECT 1 FROM events t WHERE t.ts < TIMESTAMP '2024-01-25' AND t.user_id = s.user_id
    AND date_trunc('minute', t.ts) = date_trunc('minute', s.ts))
"""


def rnd(x: str, d: int) -> str:
    """Decimal half-up rounding (mirrors ``round_half_up``)."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,9)), {d}) AS DOUBLE)"


# ---- activities (events re-aim) ------------------------------------------------

_ACTS = """
acts AS (
  SELECT event_id AS activity_id, user_id, ts AS start_ts, ts + INTERVAL 30 MINUTE AS end_ts, value / 10 AS distance_km
  FROM events WHERE event_type = 'purchase'),
plays AS (
  SELECT e.event_id AS play_id, e.ts AS played_at, CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS track_id,
         e.user_id, t.duration_ms
  FROM events e LEFT JOIN tracks t ON t.track_id = CAST(json_extract_string(e.props, '$.k') AS BIGINT)
  WHERE e.event_type <> 'purchase'),
pairs AS (
  SELECT a.activity_id, p.* FROM acts a JOIN plays p
    ON p.user_id = a.user_id AND p.played_at >= a.start_ts AND p.played_at <= a.end_ts)
"""

ORACLES["interval_join_counts"] = f"""
WITH {STAR}, {_ACTS},
agg AS (
  SELECT activity_id, COUNT(*) AS plays_heard, COUNT(DISTINCT track_id) AS distinct_tracks,
         CAST(SUM(duration_ms) AS BIGINT) AS music_ms
  FROM pairs GROUP BY activity_id)
SELECT a.activity_id, a.user_id, a.start_ts, a.distance_km,
       COALESCE(plays_heard, 0) AS plays_heard, COALESCE(distinct_tracks, 0) AS distinct_tracks,
       COALESCE(music_ms, 0) AS music_ms, {hms('COALESCE(music_ms, 0)')} AS music_duration,
       '0h 30m 0s' AS activity_duration
FROM acts a LEFT JOIN agg USING (activity_id)
"""

ORACLES["interval_join_array"] = f"""
WITH {STAR}, {_ACTS},
recent AS (SELECT * FROM acts ORDER BY start_ts DESC, activity_id DESC LIMIT 100),
lists AS (
  SELECT p.activity_id, CAST(to_json(list(struct_pack(play_id := p.play_id, track_id := p.track_id)
                                     ORDER BY p.played_at, p.play_id, p.track_id)) AS VARCHAR) AS plays
  FROM pairs p WHERE p.activity_id IN (SELECT activity_id FROM recent) GROUP BY p.activity_id)
SELECT r.activity_id, r.user_id, r.start_ts, l.plays FROM recent r LEFT JOIN lists l USING (activity_id)
"""

_LISTEN = f"""
lf AS (
  SELECT f.play_id, f.played_at, f.track_id, f.listener_id, t.track_name, t.duration_ms,
         lead(f.played_at) OVER (PARTITION BY f.listener_id ORDER BY f.played_at, f.play_id) AS next_played_at
  FROM efact f JOIN tracks t USING (track_id)),
heard AS (
  SELECT *, CASE WHEN next_played_at IS NOT NULL THEN
              CASE WHEN duration_ms IS NULL THEN NULL
                   ELSE least(duration_ms, (epoch_us(next_played_at) - epoch_us(played_at)) // 1000) END
            ELSE duration_ms END AS real_listen_duration_ms
  FROM lf)
"""

ORACLES["real_duration_lead"] = f"""
WITH {STAR}, {EVENTS_FACT}, {_LISTEN}
SELECT played_at, listener_id, track_id, track_name, CAST(played_at AS DATE) AS played_date,
       strftime(played_at, '%H:%M:%S') AS played_time, duration_ms, real_listen_duration_ms
FROM heard WHERE real_listen_duration_ms > 30000 ORDER BY played_at DESC, play_id DESC LIMIT 100
"""

ORACLES["real_duration_daily"] = f"""
WITH {STAR}, {EVENTS_FACT}, {_LISTEN}
SELECT listener_id, CAST(played_at AS DATE) AS played_date, COUNT(*) AS plays,
       count(*) FILTER (WHERE real_listen_duration_ms > 30000) AS plays_over_30s,
       CAST(SUM(real_listen_duration_ms) AS BIGINT) AS real_listen_ms
FROM heard GROUP BY 1, 2
"""

ORACLES["sampled_polyline"] = """
WITH n AS (
  SELECT user_id, event_id, ts, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS point_idx,
         CAST(ceil(COUNT(*) OVER (PARTITION BY user_id) / 80.0) AS BIGINT) AS step
  FROM events)
SELECT user_id, CAST(point_idx AS BIGINT) AS point_idx, ts, value, step FROM n WHERE point_idx % step = 0
"""

ORACLES["zone_percentages"] = """
SELECT user_id,
  round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE value < 50) / COUNT(*), 1) AS zone1_pct,
  round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE value >= 50 AND value < 100) / COUNT(*), 1) AS zone2_pct,
  round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE value >= 100 AND value < 150) / COUNT(*), 1) AS zone3_pct,
  round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE value >= 150 AND value < 200) / COUNT(*), 1) AS zone4_pct,
  round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE value >= 200) / COUNT(*), 1) AS zone5_pct
FROM events GROUP BY user_id
"""

# ---- home page (events re-aim, as_of 2024-01-31) ---------------------------------------

ORACLES["day_spine_fill"] = f"""
WITH {STAR}, {EVENTS_FACT},
spine AS (SELECT CAST(DATE '2024-01-31' - CAST(i AS INTEGER) AS DATE) AS date FROM range(0, 11) r(i)),
per_day AS (
  SELECT CAST(f.played_at AS DATE) AS date, CAST(SUM(t.duration_ms) AS BIGINT) AS total_duration_ms
  FROM efact f LEFT JOIN tracks t USING (track_id)
  WHERE f.played_at >= CAST(DATE '2024-01-31' - 14 AS TIMESTAMP) GROUP BY 1),
filled AS (
  SELECT s.date, COALESCE(p.total_duration_ms, 0) AS total_duration_ms FROM spine s LEFT JOIN per_day p USING (date)),
stats AS (SELECT *, MAX(total_duration_ms) OVER () AS max_ms, AVG(total_duration_ms) OVER () AS avg_ms FROM filled)
SELECT date, total_duration_ms,
       CASE WHEN max_ms > 0 THEN {rnd('total_duration_ms / max_ms * 100', 2)} ELSE 0.0 END AS bar_height_percent,
       substr(dayname(date), 1, 1) AS day_letter,
       CAST(CAST(floor(total_duration_ms / 3600000) AS BIGINT) AS VARCHAR) || 'h' ||
         lpad(CAST(CAST(floor((total_duration_ms % 3600000) / 60000) AS BIGINT) AS VARCHAR), 2, '0') || 'm'
         AS duration_formatted,
       CAST(CAST(floor(round(avg_ms) / 3600000) AS BIGINT) AS VARCHAR) || 'h ' ||
         CAST(CAST(floor((CAST(round(avg_ms) AS BIGINT) % 3600000) / 60000) AS BIGINT) AS VARCHAR) || 'm'
         AS avg_duration_formatted
FROM stats
"""

ORACLES["week_spine_fill"] = f"""
WITH spine AS (
  SELECT CAST(CAST(date_trunc('week', DATE '2024-01-31') AS DATE) - CAST(7 * i AS INTEGER) AS DATE) AS week_start
  FROM range(0, 7) r(i)),
weekly AS (
  SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, {rnd('SUM(value) / 10', 1)} AS total_km, COUNT(*) AS runs
  FROM events
  WHERE event_type = 'purchase'
    AND ts >= CAST(CAST(date_trunc('week', DATE '2024-01-31') AS DATE) - 42 AS TIMESTAMP)
  GROUP BY 1)
SELECT s.week_start, COALESCE(w.total_km, 0.0) AS total_km, COALESCE(w.runs, 0) AS runs
FROM spine s LEFT JOIN weekly w USING (week_start)
"""

ORACLES["running_by_day"] = f"""
SELECT CAST(ts AS DATE) AS date, {rnd('SUM(value) / 10', 2)} AS km, COUNT(*) AS runs,
       {rnd('MAX(value) / 100', 1)} AS aerobic,
       substr(dayname(CAST(ts AS DATE)), 1, 1) AS day_letter,
       CAST(dayofweek(CAST(ts AS DATE)) + 1 AS INTEGER) AS day_of_week
FROM events
WHERE event_type = 'purchase' AND ts >= CAST(CAST(date_trunc('week', DATE '2024-01-31') AS DATE) AS TIMESTAMP)
GROUP BY CAST(ts AS DATE)
"""

ORACLES["seven_day_array"] = f"""
WITH daily AS (
  SELECT CAST(ts AS DATE) AS date, MAX(value) AS highest, MIN(value) AS lowest
  FROM events WHERE event_type = 'view' AND ts >= CAST(DATE '2024-01-31' - 7 AS TIMESTAMP) GROUP BY 1),
g AS (SELECT *, {rnd('highest - lowest', 2)} AS gain FROM daily)
SELECT date, highest, lowest, gain, {rnd('AVG(gain) OVER ()', 2)} AS avg_gain, dayname(date) AS day_name FROM g
"""

ORACLES["median_baseline"] = f"""
WITH daily AS (
  SELECT CAST(ts AS DATE) AS date, {rnd('AVG(value)', 1)} AS hrv
  FROM events WHERE event_type = 'click' AND ts >= CAST(DATE '2024-01-31' - 30 AS TIMESTAMP) GROUP BY 1),
b AS (SELECT quantile_disc(hrv, 0.5) AS baseline, MAX(hrv) AS top FROM daily)
SELECT date, hrv, baseline, hrv > baseline AS above_baseline,
       {rnd('CASE WHEN top = 0 THEN NULL ELSE hrv / top END * 100', 1)} AS height_pct
FROM daily, b
"""

_WIDE = f"""
wide AS (
  SELECT CAST(ts AS DATE) AS date,
    {rnd("AVG(value) FILTER (WHERE event_type = 'click')", 2)} AS click,
    {rnd("AVG(value) FILTER (WHERE event_type = 'error')", 2)} AS error,
    {rnd("AVG(value) FILTER (WHERE event_type = 'purchase')", 2)} AS purchase,
    {rnd("AVG(value) FILTER (WHERE event_type = 'signup')", 2)} AS signup,
    {rnd("AVG(value) FILTER (WHERE event_type = 'view')", 2)} AS view
  FROM events GROUP BY 1)
"""

ORACLES["latest_vs_30_days"] = f"""
WITH {_WIDE},
cur AS (SELECT * FROM wide ORDER BY date DESC LIMIT 1),
prev AS (SELECT * FROM wide WHERE date <= DATE '2024-01-31' - 30 ORDER BY date DESC LIMIT 1),
cl AS (SELECT metric, current_value FROM cur
       UNPIVOT INCLUDE NULLS (current_value FOR metric IN (click, error, purchase, signup, view))),
pl AS (SELECT metric, previous_value FROM prev
       UNPIVOT INCLUDE NULLS (previous_value FOR metric IN (click, error, purchase, signup, view)))
SELECT cl.metric, cl.current_value, pl.previous_value,
       {rnd('cl.current_value - pl.previous_value', 2)} AS delta
FROM cl LEFT JOIN pl USING (metric)
"""

ORACLES["weekly_avg_array"] = f"""
WITH daily AS (SELECT CAST(ts AS DATE) AS date, AVG(value) AS v FROM events WHERE event_type = 'signup' GROUP BY 1),
weekly AS (SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, {rnd('AVG(v)', 2)} AS weekly_avg
           FROM daily GROUP BY 1),
latest AS (SELECT v AS current, date AS latest_date FROM daily ORDER BY date DESC LIMIT 1),
past AS (SELECT d.v AS past FROM daily d, latest l WHERE d.date = l.latest_date - 21)
SELECT week_start, weekly_avg, {rnd('(SELECT current FROM latest)', 2)} AS current_value,
       {rnd('COALESCE((SELECT current FROM latest) - (SELECT past FROM past), 0.0)', 2)} AS delta
FROM weekly
"""

ORACLES["latest_day_stages"] = f"""
WITH latest AS (SELECT MAX(CAST(ts AS DATE)) AS d FROM events),
per AS (
  SELECT event_type AS stage, {rnd('SUM(value)', 2)} AS total FROM events
  WHERE CAST(ts AS DATE) = (SELECT d FROM latest) GROUP BY event_type)
SELECT (SELECT d FROM latest) AS date, stage, total,
       {rnd('CAST(100 AS DOUBLE) * total / SUM(total) OVER ()', 1)} AS pct
FROM per
"""

ORACLES["steps_goal"] = f"""
WITH daily AS (
  SELECT CAST(ts AS DATE) AS date, CAST(round(CAST(SUM(value) AS DECIMAL(38,9))) AS BIGINT) AS steps
  FROM events WHERE event_type = 'click' AND ts >= CAST(DATE '2024-01-31' - 7 AS TIMESTAMP) GROUP BY 1)
SELECT date, steps, 5000 AS goal, {rnd('CAST(100 AS DOUBLE) * steps / 5000', 1)} AS goal_pct,
       CAST(round(AVG(steps) OVER ()) AS BIGINT) AS avg_steps
FROM daily
"""

# ---- read queries -------------------------------------------------------------

_LOG = f"""
{STAR}, {EVENTS_FACT},
log AS (
  SELECT f.play_id, f.played_at, CAST(f.played_at AS DATE) AS played_date,
         strftime(f.played_at, '%H:%M:%S') AS played_time, f.track_id, t.track_name, t.album_id, t.duration_ms,
         pa.artist_id, pa.artist_name
  FROM efact f LEFT JOIN tracks t USING (track_id)
  LEFT JOIN (SELECT pb.track_id, pb.artist_id, a.artist_name FROM primary_bridge pb JOIN artists a USING (artist_id)) pa
    USING (track_id)),
flt AS (
  SELECT * FROM log WHERE played_at >= TIMESTAMP '2024-01-10' AND played_at < TIMESTAMP '2024-01-21'
    AND contains(lower(artist_name), lower('SUPPLIER#0000000')))
"""

ORACLES["paged_log"] = f"""
WITH {_LOG}
SELECT * FROM flt ORDER BY played_at DESC, play_id DESC LIMIT 50 OFFSET 50
"""

ORACLES["paged_total"] = f"""
WITH {_LOG}
SELECT COUNT(*) AS total, greatest(CAST(ceil(COUNT(*) / 50.0) AS BIGINT), 1) AS pages FROM flt
"""

ORACLES["facet_values"] = f"""
WITH {_LOG}
SELECT DISTINCT artist_name FROM log WHERE artist_name IS NOT NULL
"""

ORACLES["search_contains"] = f"""
WITH {STAR},
per_artist AS (
  SELECT pb.artist_id, COUNT(*) AS play_count FROM fact f JOIN primary_bridge pb USING (track_id) GROUP BY 1)
SELECT a.artist_id, a.artist_name, p.play_count
FROM artists a JOIN per_artist p USING (artist_id)
WHERE contains(lower(a.artist_name), lower('plier#00000001'))
ORDER BY p.play_count DESC, a.artist_id LIMIT 50
"""

# ---- enrichment work lists ------------------------------------------------------

_ENRICH = f"""
{STAR},
enrichment AS (
  SELECT s_suppkey AS artist_id, CAST(floor(s_acctbal / 100) AS INTEGER) AS popularity,
         CAST(s_nationkey AS BIGINT) * 1000 + s_suppkey AS followers, n_name AS genre,
         CAST(DATE '2024-01-31' - CAST((s_suppkey * 7) % 200 AS INTEGER) AS DATE) AS enriched_at
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0),
played AS (
  SELECT b.artist_id, COUNT(*) AS play_count, MIN(f.played_at) AS first_played_at
  FROM fact f JOIN bridge b USING (track_id) GROUP BY b.artist_id),
work AS (SELECT * FROM played p WHERE NOT EXISTS (SELECT 1 FROM enrichment e WHERE e.artist_id = p.artist_id))
"""

# the catalogue has every supplier; work lists take those without a positive balance as not enriched
_ENRICH_ALL = _ENRICH.replace(" WHERE s_acctbal > 0", "")

ORACLES["anti_join_worklist"] = f"WITH {_ENRICH} SELECT * FROM work"

ORACLES["batch_ids"] = f"""
WITH {_ENRICH}
SELECT artist_id, play_count, row_number() OVER (ORDER BY play_count DESC, artist_id) AS position,
       CAST(floor((row_number() OVER (ORDER BY play_count DESC, artist_id) - 1) / 50) AS BIGINT) AS batch_id
FROM work
"""

ORACLES["coverage_pct"] = f"""
WITH {_ENRICH}
SELECT COUNT(*) AS played_artists, count(*) FILTER (WHERE e.artist_id IS NULL) AS missing,
       round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE e.artist_id IS NULL) / nullif(COUNT(*), 0), 2) AS pct_missing
FROM played p LEFT JOIN enrichment e USING (artist_id)
"""

ORACLES["stale_rows"] = f"""
WITH {_ENRICH_ALL}
SELECT artist_id, enriched_at, CAST(DATE '2024-01-31' - enriched_at AS INTEGER) AS days_old
FROM enrichment WHERE DATE '2024-01-31' - enriched_at > 90
"""

ORACLES["genre_summary"] = f"""
WITH {_ENRICH_ALL}
SELECT genre, COUNT(DISTINCT artist_id) AS artists, CAST(SUM(followers) AS BIGINT) AS total_followers,
       {rnd('AVG(popularity)', 1)} AS avg_popularity
FROM enrichment GROUP BY genre
"""

ORACLES["tier_histogram"] = f"""
WITH {_ENRICH_ALL},
t AS (
  SELECT e.*, s.s_name AS artist_name,
    CASE WHEN popularity >= 80 THEN '80-100 very high' WHEN popularity >= 60 THEN '60-79 high'
         WHEN popularity >= 40 THEN '40-59 medium' WHEN popularity >= 20 THEN '20-39 low' ELSE '0-19 very low' END AS tier
  FROM enrichment e JOIN supplier s ON s.s_suppkey = e.artist_id),
c AS (SELECT tier, COUNT(*) AS artists, MIN(popularity) AS min_pop FROM t GROUP BY tier),
r AS (SELECT tier, artist_name, row_number() OVER (PARTITION BY tier ORDER BY artist_name) AS rn FROM t),
s AS (SELECT tier, string_agg(artist_name, ', ' ORDER BY artist_name) AS samples FROM r WHERE rn <= 3 GROUP BY tier)
SELECT c.tier, c.artists, c.min_pop, s.samples FROM c JOIN s USING (tier)
"""

# ---- documented analytic queries --------------------------------------------------

ORACLES["running_total"] = f"""
WITH m AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, COUNT(*) AS items FROM lineitem GROUP BY 1)
SELECT month, items,
       CAST(SUM(items) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_total,
       {rnd('AVG(items) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 2)} AS rolling_3
FROM m
"""

ORACLES["duration_histogram"] = """
WITH t AS (SELECT CAST(p_size AS BIGINT) * 6000 AS ms FROM part)
SELECT CASE WHEN ms < 60000 THEN '< 1 min' WHEN ms < 180000 THEN '1-3 min' WHEN ms < 300000 THEN '3-5 min'
            ELSE '>= 5 min' END AS bucket, COUNT(*) AS tracks, MIN(ms) AS min_ms
FROM t GROUP BY 1
"""

ORACLES["decade_buckets"] = f"""
SELECT CAST(floor(year(o_orderdate) / 10) * 10 AS INTEGER) AS decade, CAST(year(o_orderdate) AS INTEGER) AS year,
       COUNT(*) AS orders, {rnd('AVG(o_totalprice)', 2)} AS avg_price
FROM orders GROUP BY 1, 2
"""

ORACLES["explicit_share"] = """
SELECT p_brand AS album_id, COUNT(*) AS items, count(*) FILTER (WHERE l_returnflag = 'R') AS flagged,
       round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE l_returnflag = 'R') / nullif(COUNT(*), 0), 1) AS flagged_pct
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
"""

ORACLES["oldest_newest_union"] = """
(SELECT o_orderkey, o_orderdate, o_totalprice, 'oldest' AS edge FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10)
UNION ALL
(SELECT o_orderkey, o_orderdate, o_totalprice, 'newest' AS edge FROM orders
 ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10)
"""

ORACLES["distinct_sample_array"] = """
WITH pairs AS (
  SELECT DISTINCT p_brand AS album_id, s_name AS artist_name
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
r AS (SELECT *, row_number() OVER (PARTITION BY album_id ORDER BY artist_name) AS rn FROM pairs)
SELECT album_id, COUNT(*) AS artists,
       string_agg(artist_name, ', ' ORDER BY artist_name) FILTER (WHERE rn <= 3) AS sample_artists
FROM r GROUP BY album_id
"""

ORACLES["collaborations"] = f"""
WITH {STAR}, per AS (SELECT track_id, COUNT(*) AS artists FROM bridge GROUP BY track_id)
SELECT artists, COUNT(*) AS tracks FROM per GROUP BY artists
"""

ORACLES["habits_by_hour"] = f"""
WITH {EVENTS_FACT}
SELECT CAST(hour(played_at) AS INTEGER) AS hour, COUNT(*) AS plays, COUNT(DISTINCT track_id) AS tracks,
       COUNT(DISTINCT listener_id) AS listeners
FROM efact GROUP BY 1
"""

ORACLES["plays_by_context"] = """
SELECT event_type AS context, COUNT(*) AS plays, COUNT(DISTINCT user_id) AS listeners,
       round(CAST(100 AS DOUBLE) * COUNT(*) / SUM(COUNT(*)) OVER (), 1) AS share_pct
FROM events GROUP BY event_type
"""

ORACLES["daily_listening"] = f"""
WITH {STAR}, {EVENTS_FACT}
SELECT CAST(f.played_at AS DATE) AS day, COUNT(*) AS plays, COUNT(DISTINCT f.track_id) AS tracks,
       {rnd('SUM(t.duration_ms) / 60000', 1)} AS minutes
FROM efact f LEFT JOIN tracks t USING (track_id) GROUP BY 1
"""

# ---- hub layer over the nested play log ----------------------------------------------

_LOG_NESTED = f"""
{STAR},
credits AS (
  SELECT b.track_id, list(struct_pack(artistId := b.artist_id, artistName := a.artist_name)
                          ORDER BY b.artist_position) AS artists
  FROM bridge b JOIN artists a USING (artist_id) GROUP BY b.track_id),
log AS (
  SELECT l_orderkey * 100 + l_linenumber AS play_id, l_shipdate AS playedAt, l_partkey AS trackId,
         p_name AS trackName, CAST(p_size AS BIGINT) * 6000 AS trackDurationMs, p_brand AS albumId,
         p_brand AS albumName, c.artists AS artists, c.artists AS albumArtists
  FROM lineitem JOIN part ON p_partkey = l_partkey LEFT JOIN credits c ON c.track_id = l_partkey)
"""

ORACLES["hub_bridge_tracks_artists"] = f"""
WITH {_LOG_NESTED},
ex AS (SELECT trackId, unnest(artists) AS a, generate_subscripts(artists, 1) - 1 AS pos FROM log)
SELECT trackId AS track_id, a.artistId AS artist_id, CAST(MIN(pos) AS INTEGER) AS artist_position,
       CASE WHEN MIN(pos) = 0 THEN 'primary' ELSE 'featuring' END AS artist_role
FROM ex GROUP BY trackId, a.artistId
"""

ORACLES["hub_dim_tracks"] = f"""
WITH {_LOG_NESTED},
stats AS (
  SELECT trackId, COUNT(*) AS play_count, CAST(SUM(trackDurationMs) AS BIGINT) AS total_listen_duration,
         MIN(playedAt) AS first_played_at, MAX(playedAt) AS last_played_at
  FROM log GROUP BY trackId),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trackId ORDER BY playedAt DESC, play_id DESC) AS rn FROM log)
  WHERE rn = 1)
SELECT l.trackId AS track_id, l.trackName AS track_name, l.trackDurationMs AS duration_ms, l.albumId AS album_id,
       s.play_count, s.total_listen_duration, s.first_played_at, s.last_played_at,
       array_to_string(list_transform(l.artists, lambda x: x.artistName), ', ') AS all_artist_names
FROM latest l LEFT JOIN stats s USING (trackId) WHERE len(l.artists) > 0
"""

ORACLES["hub_dim_albums"] = f"""
WITH {_LOG_NESTED},
stats AS (
  SELECT albumId, COUNT(*) AS play_count, CAST(SUM(trackDurationMs) AS BIGINT) AS total_listen_duration,
         MIN(playedAt) AS first_played_at, MAX(playedAt) AS last_played_at
  FROM log GROUP BY albumId),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY albumId ORDER BY playedAt DESC, play_id DESC) AS rn FROM log)
  WHERE rn = 1)
SELECT l.albumId AS album_id, l.albumName AS album_name, s.play_count, s.total_listen_duration,
       s.first_played_at, s.last_played_at,
       array_to_string(list_transform(l.albumArtists, lambda x: x.artistName), ', ') AS all_artist_names
FROM latest l LEFT JOIN stats s USING (albumId) WHERE len(l.albumArtists) > 0
"""

ORACLES["hub_dim_artists"] = f"""
WITH {_LOG_NESTED},
enrichment AS (
  SELECT s_suppkey AS artist_id, CAST(floor(s_acctbal / 100) AS INTEGER) AS popularity,
         CAST(s_nationkey AS BIGINT) * 1000 + s_suppkey AS followers, n_name AS genre
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
ex AS (SELECT play_id, playedAt, trackDurationMs, unnest(artists) AS a FROM log),
per AS (
  SELECT a.artistId AS artist_id, COUNT(*) AS play_count, CAST(SUM(trackDurationMs) AS BIGINT) AS total_listen_duration,
         MIN(playedAt) AS first_played_at, MAX(playedAt) AS last_played_at,
         arg_max(a.artistName, (playedAt, play_id)) AS artist_name
  FROM ex GROUP BY a.artistId)
SELECT per.*, e.genre, e.popularity, e.followers FROM per LEFT JOIN enrichment e USING (artist_id)
"""

ORACLES["play_log"] = f"""
WITH {STAR},
prim AS (SELECT b.track_id, b.artist_id, a.artist_name FROM primary_bridge b JOIN artists a USING (artist_id))
SELECT f.play_id, f.played_at, CAST(f.played_at AS DATE) AS played_date, strftime(f.played_at, '%H:%M:%S') AS played_time,
       f.track_id, t.track_name, t.album_id, t.duration_ms, p.artist_id, p.artist_name
FROM fact f LEFT JOIN tracks t USING (track_id) LEFT JOIN prim p USING (track_id)
"""

ORACLES["artists_of_genre"] = f"""
WITH {_ENRICH_ALL}
SELECT e.artist_id, s.s_name AS artist_name, e.popularity, e.followers
FROM enrichment e JOIN supplier s ON s.s_suppkey = e.artist_id WHERE lower(e.genre) = lower('nation_7')
"""

ORACLES["popularity_follower_ratio"] = f"""
WITH {_ENRICH_ALL}
SELECT artist_id, popularity, followers, {rnd('popularity * 1000 / nullif(followers, 0)', 4)} AS pop_per_k_followers
FROM enrichment WHERE popularity >= 50
"""

ORACLES["enrichment_runs_by_day"] = f"""
WITH {_ENRICH_ALL}
SELECT enriched_at AS run_date, COUNT(*) AS artists,
       COUNT(DISTINCT CASE WHEN genre IS NOT NULL THEN artist_id END) AS artists_with_genres,
       {rnd('AVG(popularity)', 1)} AS avg_popularity, {rnd('AVG(followers)', 0)} AS avg_followers
FROM enrichment WHERE enriched_at >= DATE '2024-01-31' - 7 GROUP BY enriched_at
"""

ORACLES["lateral_aggregate"] = """
SELECT doc_id, CAST(len(w) AS INTEGER) AS n_words,
       CAST(list_sum(list_transform(w, lambda x: length(x))) AS BIGINT) AS word_chars,
       CAST(list_max(list_transform(w, lambda x: length(x))) AS INTEGER) AS longest_word
FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)
"""

ORACLES["array_filter_sort"] = """
SELECT doc_id, CAST(len(p) AS INTEGER) AS n_long, array_to_string(p, ' ') AS long_words
FROM (SELECT doc_id, list_sort(list_filter(string_split(text, ' '), lambda x: length(x) > 12)) AS p FROM documents)
"""

# ---- nightly summary (P21, P24, P25, P28) ----------------------------------------

def _long(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,9))) AS BIGINT)"


_NIGHTS = f"""
nights AS (
  SELECT CAST(ts AS DATE) AS date,
         {_long("AVG(value) FILTER (WHERE event_type = 'signup')")} AS sleep_score,
         arg_min(value, ts) FILTER (WHERE event_type = 'view') AS bed,
         arg_max(value, ts) FILTER (WHERE event_type = 'view') AS wake,
         {rnd("AVG(value) FILTER (WHERE event_type = 'click')", 1)} AS avg_hrv,
         {_long("MIN(value) FILTER (WHERE event_type = 'error')")} AS resting_heart_rate
  FROM events WHERE ts >= CAST(DATE '2024-01-31' - 6 AS TIMESTAMP) GROUP BY 1)
"""

ORACLES["resting_hr_week"] = f"""
WITH {_NIGHTS},
d AS (SELECT date, resting_heart_rate AS value FROM nights WHERE resting_heart_rate IS NOT NULL),
s AS (SELECT MAX(value) AS mx, {_long('AVG(value)')} AS average FROM d)
SELECT strftime(date, '%Y-%m-%d') AS date, substr(dayname(date), 1, 1) AS day, value,
       {rnd('CASE WHEN mx = 0 THEN NULL ELSE value * 100 / mx END', 1)} AS display_height_percent, average
FROM (SELECT * FROM d ORDER BY date LIMIT 7), s
"""

ORACLES["sleep_scores_week"] = f"""
WITH {_NIGHTS},
last AS (SELECT date, sleep_score AS score FROM nights WHERE sleep_score IS NOT NULL ORDER BY date DESC LIMIT 7)
SELECT strftime(date, '%Y-%m-%d') AS date, substr(dayname(date), 1, 1) AS day, score,
       {_long('AVG(score) OVER ()')} AS average
FROM last
"""

ORACLES["sleep_battery_week"] = f"""
WITH {_NIGHTS}
SELECT date, substr(dayname(date), 1, 1) AS day_abbr, sleep_score, bed AS battery_at_bedtime,
       wake AS battery_at_waketime, {rnd('wake - bed', 2)} AS battery_gain, avg_hrv,
       resting_heart_rate AS resting_hr
FROM nights WHERE sleep_score IS NOT NULL
"""

ORACLES["stress_week"] = f"""
WITH stress AS (
  SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS calendarDate, {_long('AVG(value)')} AS avg_stress,
         {_long('MAX(value)')} AS max_stress
  FROM events WHERE event_type = 'error' AND ts >= CAST(DATE '2024-01-31' - 6 AS TIMESTAMP) GROUP BY 1),
last AS (
  SELECT strptime(calendarDate, '%Y-%m-%d')::DATE AS date, avg_stress, max_stress FROM stress
  WHERE strptime(calendarDate, '%Y-%m-%d')::DATE >= DATE '2024-01-31' - 6 ORDER BY date DESC LIMIT 7)
SELECT strftime(date, '%Y-%m-%d') AS date, substr(dayname(date), 1, 1) AS day, avg_stress, max_stress,
       {_long('AVG(avg_stress) OVER ()')} AS average_stress
FROM last
"""

# ---- album enrichment (E02, D10–D14, D16–D19) -------------------------------------

_ALBUM_ENRICH = """
brands AS (
  SELECT p_brand AS album_id, COUNT(*) AS total_tracks, CAST(SUM(p_size) % 101 AS INTEGER) AS popularity,
         arg_min(p_type, p_partkey) AS label,
         list_sort(coalesce(list(DISTINCT lower(p_type)) FILTER (WHERE p_size >= 49), [])) AS genres,
         CAST(substr(p_brand, 7) AS INTEGER) AS no
  FROM part GROUP BY p_brand),
album_enrichment AS (
  SELECT album_id, album_id AS album_name, popularity, label, genres, total_tracks,
         CASE no % 4 WHEN 0 THEN 'single' WHEN 1 THEN 'compilation' ELSE 'album' END AS album_type,
         CASE WHEN no % 5 <> 0 THEN strftime(DATE '1990-01-01' + no * 97, '%Y-%m-%d')
              ELSE strftime(DATE '1990-01-01' + no * 97, '%Y') END AS release_date,
         CASE WHEN no % 5 <> 0 THEN 'day' ELSE 'year' END AS release_date_precision,
         CAST(DATE '2024-01-31' - CAST((no * 37) % 200 AS INTEGER) AS TIMESTAMP) AS enriched_at
  FROM brands WHERE no % 3 <> 0)
"""

# the catalogue has every brand; the work list takes every third as not enriched
_ALBUM_GAPS = _ALBUM_ENRICH
_ALBUM_ENRICH = _ALBUM_ENRICH.replace(" WHERE no % 3 <> 0", "")

ORACLES["album_backfill_worklist"] = f"""
WITH {STAR}, {_ALBUM_GAPS}
SELECT t.album_id, t.album_id AS album_name, MIN(f.played_at) AS first_played_at, COUNT(*) AS play_count
FROM fact f JOIN tracks t USING (track_id)
WHERE t.album_id NOT IN (SELECT album_id FROM album_enrichment)
GROUP BY t.album_id
"""

ORACLES["top_enriched_albums"] = f"""
WITH {STAR}, {_ALBUM_ENRICH},
plays AS (SELECT t.album_id, COUNT(*) AS play_count FROM fact f JOIN tracks t USING (track_id) GROUP BY 1)
SELECT CAST(row_number() OVER (ORDER BY p.play_count DESC, e.album_id) AS INTEGER) AS rank, e.album_name,
       e.popularity, e.release_date, e.label, e.album_type, p.play_count, array_to_string(e.genres, ', ') AS genres
FROM plays p JOIN album_enrichment e USING (album_id)
ORDER BY p.play_count DESC, e.album_id LIMIT 30
"""

ORACLES["albums_by_genre"] = f"""
WITH {_ALBUM_ENRICH}
SELECT CAST(row_number() OVER (ORDER BY popularity DESC, album_id) AS INTEGER) AS rank, album_name, popularity,
       release_date, label, array_to_string(genres, ', ') AS genre_list
FROM album_enrichment WHERE list_contains(genres, 'promo')
ORDER BY popularity DESC, album_id LIMIT 20
"""

ORACLES["albums_by_label"] = f"""
WITH {_ALBUM_ENRICH},
stats AS (
  SELECT label, COUNT(DISTINCT album_id) AS album_count, {rnd('AVG(popularity)', 1)} AS avg_popularity,
         array_to_string(list(album_name ORDER BY popularity DESC, album_name)[1:3], ', ') AS top_albums
  FROM album_enrichment WHERE label IS NOT NULL GROUP BY label)
SELECT CAST(row_number() OVER (ORDER BY album_count DESC, label) AS INTEGER) AS rank, label, album_count,
       avg_popularity, top_albums
FROM stats ORDER BY album_count DESC, label LIMIT 20
"""

ORACLES["release_timeline"] = f"""
WITH {_ALBUM_ENRICH}
SELECT CAST(year(strptime(release_date, '%Y-%m-%d')) AS INTEGER) AS release_year, album_type,
       COUNT(*) AS album_count, {rnd('AVG(popularity)', 1)} AS avg_popularity
FROM album_enrichment WHERE release_date_precision = 'day' GROUP BY 1, 2
"""

ORACLES["stale_albums"] = f"""
WITH {_ALBUM_ENRICH}
SELECT album_id, album_name, enriched_at,
       CAST(date_diff('day', CAST(enriched_at AS DATE), DATE '2024-01-31') AS INTEGER) AS days_since_enrichment,
       popularity, release_date
FROM album_enrichment WHERE enriched_at < TIMESTAMP '2024-01-31' - INTERVAL 90 DAY
ORDER BY popularity DESC, album_id LIMIT 100
"""

ORACLES["album_tiers_by_type"] = f"""
WITH {_ALBUM_ENRICH},
t AS (
  SELECT *, CASE WHEN popularity >= 80 THEN '80-100 (Very Popular)' WHEN popularity >= 60 THEN '60-79 (Popular)'
                 WHEN popularity >= 40 THEN '40-59 (Moderate)' WHEN popularity >= 20 THEN '20-39 (Niche)'
                 ELSE '0-19 (Emerging)' END AS popularity_tier
  FROM album_enrichment)
SELECT album_type, popularity_tier, COUNT(*) AS album_count,
       array_to_string(list(album_name ORDER BY popularity DESC, album_name)[1:3], ', ') AS sample_albums,
       MIN(popularity) AS min_popularity
FROM t GROUP BY album_type, popularity_tier
"""

ORACLES["albums_without_genres"] = f"""
WITH {_ALBUM_ENRICH}
SELECT album_name, album_id, album_type, popularity, release_date, label, enriched_at
FROM album_enrichment WHERE len(genres) = 0
"""

ORACLES["singles_vs_albums"] = f"""
WITH {_ALBUM_ENRICH}
SELECT album_type, COUNT(*) AS count, {rnd('AVG(popularity)', 1)} AS avg_popularity,
       {rnd('AVG(total_tracks)', 1)} AS avg_tracks, COUNT(DISTINCT label) AS unique_labels
FROM album_enrichment GROUP BY album_type
"""

# ---- saved library: saved tracks (D36–D42) ---------------------------------------

_SAVED_TRACKS = f"""
{STAR}, {_ALBUM_ENRICH},
saved AS (
  SELECT l.l_orderkey * 100 + l.l_linenumber AS save_id, l.l_shipdate + to_hours(l.l_linenumber) AS added_at,
         l.l_partkey AS track_id, l.l_suppkey AS supplier_id, l.l_returnflag = 'R' AS explicit,
         p.p_name AS track_name, p.p_brand AS album_id, CAST(p.p_size AS BIGINT) * 6000 AS duration_ms,
         CAST((p.p_size * 3 + p.p_partkey) % 101 AS INTEGER) AS popularity,
         pa.artist_id AS primary_artist_id, pa.artist_name AS primary_artist,
         al.album_name, al.total_tracks AS album_total_tracks, e.release_date AS album_release_date, e.album_type
  FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey
  LEFT JOIN (SELECT pb.track_id, pb.artist_id, a.artist_name FROM primary_bridge pb JOIN artists a USING (artist_id)) pa
    ON pa.track_id = l.l_partkey
  LEFT JOIN albums al ON al.album_id = p.p_brand
  LEFT JOIN album_enrichment e ON e.album_id = p.p_brand)
"""

ORACLES["recently_saved_tracks"] = f"""
WITH {_SAVED_TRACKS}
SELECT CAST(row_number() OVER (ORDER BY added_at DESC, save_id DESC, track_id DESC, supplier_id DESC) AS INTEGER)
         AS rank, added_at, track_name, primary_artist, album_name, album_release_date, popularity,
       {rnd('duration_ms / 1000.0 / 60', 2)} AS duration_minutes
FROM saved ORDER BY added_at DESC, save_id DESC, track_id DESC, supplier_id DESC LIMIT 50
"""

ORACLES["top_saved_artists"] = f"""
WITH {_SAVED_TRACKS},
g AS (
  SELECT a.artist_name, COUNT(*) AS tracks_saved, SUM(s.popularity) AS pop, SUM(s.duration_ms) AS ms
  FROM saved s JOIN bridge b ON b.track_id = s.track_id JOIN artists a ON a.artist_id = b.artist_id
  WHERE s.added_at >= TIMESTAMP '2000-01-01' GROUP BY a.artist_name)
SELECT CAST(row_number() OVER (ORDER BY tracks_saved DESC, artist_name) AS INTEGER) AS rank, artist_name,
       tracks_saved, {rnd('pop / tracks_saved', 2)} AS avg_popularity, {rnd('ms / 1000 / 60', 2)} AS total_minutes
FROM g ORDER BY tracks_saved DESC, artist_name LIMIT 20
"""

ORACLES["saved_tracks_by_month"] = f"""
WITH {_SAVED_TRACKS}
SELECT CAST(date_trunc('month', added_at) AS DATE) AS month, COUNT(*) AS tracks_saved,
       COUNT(DISTINCT primary_artist_id) AS unique_artists, COUNT(*) FILTER (WHERE explicit) AS explicit_tracks,
       {rnd('AVG(popularity)', 1)} AS avg_popularity
FROM saved GROUP BY 1
"""

ORACLES["albums_by_share_saved"] = f"""
WITH {_SAVED_TRACKS},
g AS (
  SELECT album_name, primary_artist, album_total_tracks, COUNT(*) AS tracks_saved,
         MIN(added_at) AS first_track_saved, MAX(added_at) AS last_track_saved
  FROM saved GROUP BY album_name, primary_artist, album_total_tracks HAVING COUNT(*) >= 3)
SELECT CAST(row_number() OVER (ORDER BY tracks_saved DESC, album_name, primary_artist NULLS FIRST) AS INTEGER) AS rank,
       album_name, primary_artist, tracks_saved, album_total_tracks,
       {rnd('tracks_saved * 100.0 / album_total_tracks', 1)} AS pct_album_saved, first_track_saved, last_track_saved
FROM g ORDER BY tracks_saved DESC, album_name, primary_artist NULLS FIRST LIMIT 20
"""

ORACLES["saved_by_album_type"] = f"""
WITH {_SAVED_TRACKS}
SELECT album_type, COUNT(*) AS track_count, COUNT(DISTINCT album_id) AS unique_albums,
       {rnd('AVG(popularity)', 1)} AS avg_popularity, {rnd('AVG(duration_ms) / 1000 / 60', 1)} AS avg_track_minutes
FROM saved GROUP BY album_type
"""

# ---- saved library: saved albums with nested tracks (D26–D35) ---------------------

_SAVED_ALBUMS = f"""
{STAR},
credits AS (
  SELECT b.track_id, list(struct_pack(artist_id := b.artist_id, artist_name := a.artist_name)
                           ORDER BY b.artist_position) AS artists
  FROM bridge b JOIN artists a USING (artist_id) GROUP BY b.track_id),
lines AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey AS track_id, l.l_suppkey, p.p_name AS track_name,
         CAST(p.p_size AS BIGINT) * 6000 AS duration_ms, c.artists, s.s_name
  FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey LEFT JOIN credits c ON c.track_id = l.l_partkey
  LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey),
nested AS (
  SELECT l_orderkey,
         list(struct_pack(track_number := l_linenumber, track_id := track_id, track_name := track_name,
                          duration_ms := duration_ms, artists := artists)
              ORDER BY l_linenumber, l_suppkey, track_id) AS tracks,
         list(struct_pack(artist_id := l_suppkey, artist_name := s_name)
              ORDER BY l_linenumber, l_suppkey, track_id) AS line_artists
  FROM lines GROUP BY l_orderkey),
sa AS (
  SELECT o.o_orderkey AS album_id, 'Album #' || CAST(o.o_orderkey AS VARCHAR) AS album_name,
         o.o_orderdate AS added_at, CAST(o.o_orderdate AS DATE) - CAST(o.o_custkey % 3650 AS INTEGER) AS release_date,
         o.o_orderpriority AS label, CAST(o.o_custkey % 101 AS INTEGER) AS popularity,
         CAST(len(n.tracks) AS INTEGER) AS total_tracks,
         CASE WHEN len(n.tracks) = 1 THEN 'single' WHEN o.o_orderstatus = 'F' THEN 'album' ELSE 'compilation' END
           AS album_type,
         n.line_artists[1] AS primary_artist_rec, list_distinct(n.line_artists) AS album_artists, n.tracks,
         o.o_orderdate AS o_orderdate
  FROM orders o JOIN nested n ON n.l_orderkey = o.o_orderkey)
"""

ORACLES["recently_saved_albums"] = f"""
WITH {_SAVED_ALBUMS}
SELECT added_at, album_id, album_name, primary_artist_rec.artist_name AS primary_artist, release_date, total_tracks,
       popularity, label
FROM sa WHERE album_id IN (SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 50)
"""

ORACLES["saved_albums_by_artist"] = f"""
WITH {_SAVED_ALBUMS},
x AS (SELECT unnest(album_artists).artist_name AS artist_name, popularity, release_date FROM sa
      WHERE added_at >= TIMESTAMP '2000-01-01'),
g AS (SELECT artist_name, COUNT(*) AS album_count, {rnd('AVG(popularity)', 2)} AS avg_popularity,
             MIN(release_date) AS earliest_album, MAX(release_date) AS latest_album FROM x GROUP BY artist_name)
SELECT *, CAST(row_number() OVER (ORDER BY album_count DESC, artist_name) AS INTEGER) AS rank
FROM g ORDER BY album_count DESC, artist_name LIMIT 20
"""

ORACLES["albums_saved_by_month"] = f"""
WITH {_SAVED_ALBUMS}
SELECT CAST(date_trunc('month', added_at) AS DATE) AS month, COUNT(*) AS albums_saved,
       COUNT(DISTINCT primary_artist_rec.artist_id) AS unique_artists
FROM sa GROUP BY 1
"""

ORACLES["album_type_distribution"] = f"""
WITH {_SAVED_ALBUMS}
SELECT album_type, COUNT(*) AS count, {rnd('AVG(total_tracks)', 1)} AS avg_tracks,
       {rnd('AVG(popularity)', 1)} AS avg_popularity
FROM sa GROUP BY album_type
"""

ORACLES["longest_albums"] = f"""
WITH {_SAVED_ALBUMS}
SELECT CAST(row_number() OVER (ORDER BY total_tracks DESC, album_id) AS INTEGER) AS rank, album_name,
       primary_artist_rec.artist_name AS primary_artist, total_tracks, release_date, album_type
FROM sa ORDER BY total_tracks DESC, album_id LIMIT 20
"""

ORACLES["track_vs_album_artists"] = f"""
WITH {_SAVED_ALBUMS},
t AS (SELECT album_name, primary_artist_rec.artist_name AS album_artist, unnest(tracks) AS track FROM sa),
ta AS (SELECT album_name, album_artist, track.track_name AS track_name, unnest(track.artists).artist_name AS name
       FROM t WHERE len(track.artists) > 1)
SELECT album_name, album_artist, track_name, array_to_string(list(name ORDER BY name), ', ') AS track_artists
FROM ta GROUP BY album_name, album_artist, track_name
"""

ORACLES["copyright_types"] = f"""
WITH {_SAVED_ALBUMS},
c AS (
  SELECT album_id, 'C' AS type, '(C) ' || CAST(year(release_date) AS VARCHAR) || ' ' || label AS text FROM sa
  UNION ALL
  SELECT album_id, 'P', '(P) ' || CAST(year(o_orderdate) AS VARCHAR) || ' ' || label FROM sa),
y AS (SELECT album_id, type, nullif(regexp_extract(text, '\\d{{4}}', 0), '') AS year FROM c),
s AS (SELECT type, COUNT(DISTINCT album_id) AS album_count FROM y GROUP BY type),
yy AS (SELECT type, array_to_string(list(year ORDER BY year)[1:5], ', ') AS sample_years
       FROM (SELECT DISTINCT type, year FROM y WHERE year IS NOT NULL) GROUP BY type)
SELECT s.type, CASE s.type WHEN 'C' THEN 'Copyright' WHEN 'P' THEN 'Phonographic' ELSE 'Unknown' END
         AS copyright_type_name, s.album_count, yy.sample_years
FROM s LEFT JOIN yy USING (type)
"""

# ---- recent plays (D20, D21, D23) -------------------------------------------------

_CREDIT_NAMES = """
credit_names AS (
  SELECT b.track_id, array_to_string(list(a.artist_name ORDER BY a.artist_name), ', ') AS artists
  FROM bridge b JOIN artists a USING (artist_id) GROUP BY b.track_id)
"""

ORACLES["recent_plays_with_artists"] = f"""
WITH {STAR}, {EVENTS_FACT}, {_CREDIT_NAMES}
SELECT f.played_at, t.track_name, t.album_id AS album_name, c.artists, t.duration_ms / 1000 AS duration_seconds,
       CAST((p.p_size * 3 + p.p_partkey) % 101 AS INTEGER) AS track_popularity
FROM efact f LEFT JOIN tracks t USING (track_id) LEFT JOIN part p ON p.p_partkey = f.track_id
LEFT JOIN credit_names c USING (track_id)
WHERE f.played_at >= TIMESTAMP '2024-01-24'
"""

ORACLES["most_played_recent"] = f"""
WITH {STAR}, {EVENTS_FACT}, {_CREDIT_NAMES},
per AS (SELECT track_id, COUNT(*) AS play_count, MAX(played_at) AS last_played FROM efact
        WHERE played_at >= TIMESTAMP '2024-01-01' GROUP BY track_id),
top AS (SELECT *, CAST(row_number() OVER (ORDER BY play_count DESC, track_id) AS INTEGER) AS rank FROM per
        ORDER BY play_count DESC, track_id LIMIT 20)
SELECT top.rank, top.track_id, t.track_name, t.album_id AS album_name, c.artists, top.play_count, top.last_played
FROM top LEFT JOIN tracks t USING (track_id) LEFT JOIN credit_names c USING (track_id)
"""

ORACLES["favourite_artists_recent"] = f"""
WITH {STAR}, {EVENTS_FACT},
g AS (SELECT b.artist_id, COUNT(*) AS play_count, COUNT(DISTINCT f.track_id) AS unique_tracks_played,
             MAX(f.played_at) AS last_played
      FROM efact f JOIN bridge b USING (track_id) WHERE f.played_at >= TIMESTAMP '2023-11-02' GROUP BY b.artist_id),
top AS (SELECT *, CAST(row_number() OVER (ORDER BY play_count DESC, artist_id) AS INTEGER) AS rank FROM g
        ORDER BY play_count DESC, artist_id LIMIT 20)
SELECT top.rank, top.artist_id, a.artist_name, top.play_count, top.unique_tracks_played, top.last_played
FROM top LEFT JOIN artists a USING (artist_id)
"""

# ---- hub health over derived records (H07, H08) -------------------------------------

ORACLES["hub_running_activities"] = f"""
WITH acts AS (
  SELECT event_id AS activity_id, user_id, ts, value, 1800.0 + (event_id % 600) AS duration,
         ['running', 'trail_running', 'treadmill_running', 'cycling'][user_id % 4 + 1] AS type_key
  FROM events WHERE event_type = 'purchase'),
laps AS (
  SELECT a.activity_id, list(p.value ORDER BY p.ts, p.event_id) AS vs
  FROM acts a JOIN events p ON p.user_id = a.user_id AND p.event_type <> 'purchase'
   AND p.ts >= a.ts AND p.ts <= a.ts + INTERVAL 30 MINUTE
  GROUP BY a.activity_id)
SELECT a.activity_id, 'Run ' || CAST(a.activity_id AS VARCHAR) AS activity_name,
       replace(replace(lower(a.type_key), '_', ' '), 'running', 'run') AS activity_type, a.ts AS start_time,
       {rnd('a.value * 100 / 1000', 2)} AS distance_km, {rnd('a.duration / 60', 1)} AS duration_min,
       {rnd('(1000.0 / 60) / (a.value * 100 / a.duration)', 2)} AS pace_min_per_km,
       {rnd('(a.value * 100 / a.duration) * 3.6', 1)} AS speed_kmh,
       CAST(round(CAST(100.0 + a.value / 5 AS DECIMAL(38,9))) AS BIGINT) AS avg_hr,
       CAST(120 + floor(a.value / 5) AS BIGINT) AS max_hr, a.value * 3 AS calories,
       CAST(coalesce(len(l.vs), 0) AS INTEGER) AS lap_count,
       {rnd('l.vs[1] * 10 / 1000', 2)} AS first_lap_km,
       CAST(round(CAST(100.0 + l.vs[len(l.vs)] / 5 AS DECIMAL(38,9))) AS BIGINT) AS last_lap_hr
FROM acts a LEFT JOIN laps l USING (activity_id)
WHERE lower(a.type_key) IN ('running', 'track_running', 'trail_running', 'treadmill_running')
"""


def _phase_sql(name: str, secs: str, lo: float, hi: float) -> str:
    pct = rnd(f"100.0 * {secs} / total", 1)
    return (f"{rnd(f'{secs} / 3600', 2)} AS {name}_hours, {pct} AS {name}_pct, "
            f"CASE WHEN {pct} < {lo} THEN 'insufficient' WHEN {pct} > {hi} THEN 'excessive' ELSE 'optimal' END "
            f"AS {name}_status")


# one level per ten minutes of a user's day: the first event's
_LEVELS = """
lev AS (
  SELECT user_id, CAST(ts AS DATE) AS date, (hour(ts) * 60 + minute(ts)) // 10 AS slot, MIN(ts) AS ts,
         arg_min(value, (ts, event_id)) AS v
  FROM events GROUP BY ALL)
"""

ORACLES["hub_sleep_nights"] = f"""
WITH d AS (
  SELECT user_id, CAST(ts AS DATE) AS date, COUNT(*) * 1200 AS total,
         COUNT(*) FILTER (WHERE event_type = 'click') * 1200 AS deep,
         COUNT(*) FILTER (WHERE event_type = 'view') * 1200 AS light,
         COUNT(*) FILTER (WHERE event_type = 'signup') * 1200 AS rem,
         COUNT(*) FILTER (WHERE event_type = 'error') AS awake_count,
         MIN(ts) AS start_ts, SUM(value) AS s,
         MAX(value) FILTER (WHERE event_type = 'view') - MIN(value) FILTER (WHERE event_type = 'view') AS bb,
         AVG(value) FILTER (WHERE event_type = 'click') AS hrv,
         MIN(value) FILTER (WHERE event_type = 'error') AS rhr,
         arg_max(value, (ts, event_id)) AS last_v
  FROM events GROUP BY 1, 2),
n AS (SELECT *, CAST(round(CAST(s AS DECIMAL(38,9))) AS BIGINT) % 101 AS score FROM d)
SELECT user_id, date, date_trunc('millisecond', start_ts) AS sleep_start_gmt, {rnd('total / 3600', 2)} AS sleep_hours,
       {_phase_sql('deep', 'deep', 16.0, 33.0)}, {_phase_sql('light', 'light', 30.0, 64.0)},
       {_phase_sql('rem', 'rem', 21.0, 31.0)},
       CAST(awake_count AS BIGINT) AS awake_minutes, CAST(awake_count AS BIGINT) AS awake_count,
       CAST(round(CAST(bb AS DECIMAL(38,9))) AS BIGINT) AS body_battery_change, score,
       CASE WHEN score >= 90 THEN 'excellent' WHEN score >= 80 THEN 'good' WHEN score >= 60 THEN 'fair'
            ELSE 'poor' END AS quality,
       {rnd('hrv', 2)} AS avg_hrv, CAST(round(CAST(rhr AS DECIMAL(38,9))) AS BIGINT) AS resting_hr,
       CAST(total / 1200 AS INTEGER) AS level_count,
       date_trunc('second', start_ts) + INTERVAL 1 HOUR AS first_level_local, last_v / 100 AS last_level
FROM n
"""

ORACLES["hub_sleep_levels"] = f"""
WITH {_LEVELS}
SELECT user_id, date, CAST(row_number() OVER (PARTITION BY user_id, date ORDER BY slot) - 1 AS INTEGER) AS place,
       date_trunc('second', ts) + INTERVAL 1 HOUR AS start_local,
       date_trunc('second', ts + INTERVAL 10 MINUTE) + INTERVAL 1 HOUR AS end_local, v / 100 AS level
FROM lev
"""


_STAGED_ENRICH = """
raw AS (
  SELECT s_suppkey AS artistId, s_name AS artistName, r.run,
         CAST((floor(s_acctbal / 100) + r.run * 3) % 101 + CASE WHEN (floor(s_acctbal / 100) + r.run * 3) % 101 < 0
              THEN 101 ELSE 0 END AS BIGINT) AS popularity,
         CAST(s_nationkey AS BIGINT) * 1000 + s_suppkey + r.run AS followerCount,
         CASE WHEN r.run = 0 THEN lower(n_name) WHEN s_suppkey % 7 = 0 THEN ''
              ELSE lower(n_name) || ', remastered' END AS genres,
         CASE WHEN r.run = 1 AND s_suppkey % 11 = 0 THEN NULL
              ELSE 'https://img/' || CAST(s_suppkey AS VARCHAR) || '/640' END AS imageUrlLarge,
         CASE WHEN r.run = 1 AND s_suppkey % 11 = 0 THEN NULL
              ELSE 'https://img/' || CAST(s_suppkey AS VARCHAR) || '/300' END AS imageUrlMedium,
         CASE WHEN r.run = 1 AND (s_suppkey % 5 = 0 OR s_suppkey % 11 = 0) THEN NULL
              ELSE 'https://img/' || CAST(s_suppkey AS VARCHAR) || '/64' END AS imageUrlSmall,
         CASE WHEN r.run = 0 THEN TIMESTAMP '2024-01-01'
              ELSE CAST(DATE '2024-01-01' + CAST(s_suppkey % 20 - 10 AS INTEGER) AS TIMESTAMP) END AS enrichedAt
  FROM supplier JOIN nation ON s_nationkey = n_nationkey, (SELECT 0 AS run UNION ALL SELECT 1) r),
staged AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY artistId ORDER BY enrichedAt DESC, run DESC) AS rn
                 FROM raw) WHERE rn = 1)
"""

ORACLES["staged_artist_enrichment"] = f"""
WITH {_STAGED_ENRICH}
SELECT artistId, artistName, popularity, followerCount, genres, imageUrlLarge, imageUrlMedium, imageUrlSmall,
       enrichedAt
FROM staged
"""

ORACLES["artists_large_image"] = f"""
WITH {_STAGED_ENRICH},
imgs AS (
  SELECT artistId, artistName, popularity, followerCount, imageUrlLarge AS url, 640 AS h FROM staged
  WHERE imageUrlLarge IS NOT NULL
  UNION ALL
  SELECT artistId, artistName, popularity, followerCount, imageUrlMedium, 300 FROM staged WHERE imageUrlMedium IS NOT NULL
  UNION ALL
  SELECT artistId, artistName, popularity, followerCount, imageUrlSmall, 64 FROM staged WHERE imageUrlSmall IS NOT NULL)
SELECT CAST(row_number() OVER (ORDER BY popularity DESC, artistId) AS INTEGER) AS rank, artistName, popularity,
       followerCount, url AS profile_image, CAST(h AS BIGINT) AS height, CAST(h AS BIGINT) AS width
FROM imgs WHERE h >= 640 ORDER BY popularity DESC, artistId LIMIT 20
"""

ORACLES["artists_without_genres"] = f"""
WITH {_STAGED_ENRICH}
SELECT artistName, artistId, popularity, followerCount, enrichedAt FROM staged WHERE genres = ''
"""

ORACLES["artists_with_profile_image"] = f"""
WITH {_STAGED_ENRICH}
SELECT CAST(row_number() OVER (ORDER BY popularity DESC, artistId) AS INTEGER) AS rank, artistName, popularity,
       followerCount, imageUrlLarge AS profile_image
FROM staged WHERE imageUrlLarge IS NOT NULL ORDER BY popularity DESC, artistId LIMIT 20
"""


def _score_run(cond: str) -> str:
    fields = ", ".join(f"{k} := {rnd(f'AVG(value) FILTER (WHERE event_type = {chr(39)}{k}{chr(39)})', 2)}"
                       for k in ("click", "error", "purchase", "signup", "view"))
    return (f"SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS startDate, CAST(to_json(struct_pack({fields})) AS VARCHAR)"
            f" AS score FROM events WHERE {cond} GROUP BY 1")


ORACLES["staged_scores"] = f"""
WITH r0 AS ({_score_run('TRUE')}), r1 AS ({_score_run('user_id % 2 = 0')})
SELECT startDate, coalesce(r1.score, r0.score) AS score FROM r0 FULL JOIN r1 USING (startDate)
"""

ORACLES["staged_recently_played"] = """
SELECT ts AS playedAt, json_extract_string(props, '$.k') AS trackId,
       'https://img/album/' || json_extract_string(props, '$.k') || CASE WHEN user_id % 2 = 0 THEN '/v1' ELSE '/v0' END
         AS albumImageUrl,
       CAST(300 + (event_id % 3) * 100 AS BIGINT) AS albumImageHeight,
       CAST(300 + (event_id % 3) * 100 AS BIGINT) AS albumImageWidth
FROM events
"""

# ---- read endpoints R01–R03: one period of a ranking, up to a limit -----------------

ORACLES["read_top_tracks"] = (f"SELECT * FROM ({ORACLES['top_by_period_item']}) r "
                              "WHERE period = 'last_30_days' AND rank <= 10")
ORACLES["read_top_artists"] = (f"SELECT * FROM ({ORACLES['top_by_period_entity']}) r "
                               "WHERE period = 'last_365_days' AND rank <= 15")
ORACLES["read_top_albums"] = (f"SELECT * FROM ({ORACLES['top_by_period_brand']}) r "
                              "WHERE period = 'all_time' AND rank <= 5")

ORACLES["activities_with_music"] = f"""
WITH {STAR},
acts AS (
  SELECT event_id AS activity_id, user_id, ts AS start_ts, ts + INTERVAL 30 MINUTE AS end_ts, value / 10 AS distance_km
  FROM events WHERE event_type = 'purchase' ORDER BY event_id DESC LIMIT 100),
plays AS (
  SELECT ts AS played_at, CAST(json_extract_string(props, '$.k') AS BIGINT) AS track_id, user_id
  FROM events WHERE event_type <> 'purchase'),
names AS (
  SELECT b.track_id, string_agg(a.artist_name, ', ' ORDER BY b.artist_position) AS all_artist_names
  FROM bridge b JOIN artists a USING (artist_id) GROUP BY b.track_id),
det AS (
  SELECT a.*, p.played_at, p.track_id, t.track_name, n.all_artist_names, t.duration_ms, ar.artist_name AS primary_artist
  FROM acts a
  LEFT JOIN plays p ON p.user_id = a.user_id AND p.played_at >= a.start_ts AND p.played_at <= a.end_ts
  LEFT JOIN tracks t ON t.track_id = p.track_id
  LEFT JOIN names n ON n.track_id = p.track_id
  LEFT JOIN bridge ba ON ba.track_id = t.track_id AND ba.artist_position = 0
  LEFT JOIN artists ar ON ar.artist_id = ba.artist_id),
g AS (
  SELECT activity_id, user_id, start_ts, end_ts, distance_km,
         array_to_string(list(concat_ws('|', strftime(played_at, '%Y-%m-%d %H:%M:%S'), track_name, all_artist_names,
                                        primary_artist) ORDER BY played_at), '; ') AS tracks_played_during_activity,
         COUNT(DISTINCT track_id) AS unique_tracks_count, CAST(SUM(duration_ms) AS BIGINT) AS total_music_duration_ms
  FROM det GROUP BY activity_id, user_id, start_ts, end_ts, distance_km)
SELECT *, '0h 30m 0s' AS duration_formatted, {hms('total_music_duration_ms')} AS music_duration_formatted FROM g
"""

# ---- documented reports on the saved library, tiles, incremental work list -----------

ORACLES["explicit_vs_clean"] = f"""
WITH {_SAVED_TRACKS}
SELECT explicit, COUNT(*) AS track_count, {rnd('AVG(popularity)', 1)} AS avg_popularity,
       {rnd('AVG(duration_ms) / 1000 / 60', 1)} AS avg_duration_minutes
FROM saved GROUP BY explicit
"""

ORACLES["saved_collaborations"] = f"""
WITH {_SAVED_TRACKS},
names AS (
  SELECT b.track_id, string_agg(a.artist_name, ', ' ORDER BY b.artist_position) AS all_artists, COUNT(*) AS artist_count
  FROM bridge b JOIN artists a USING (artist_id) GROUP BY b.track_id HAVING COUNT(*) > 1)
SELECT track_name, album_name, all_artists, artist_count, popularity, added_at
FROM saved JOIN names USING (track_id)
ORDER BY added_at DESC, save_id DESC, track_id DESC, supplier_id DESC LIMIT 50
"""

ORACLES["release_edges"] = f"""
WITH {_SAVED_TRACKS}, dated AS (SELECT * FROM saved WHERE album_release_date IS NOT NULL)
(SELECT 'Oldest' AS category, track_name, primary_artist AS artist, album_name, album_release_date, added_at
 FROM dated ORDER BY album_release_date, save_id, track_id, supplier_id LIMIT 10)
UNION ALL
(SELECT 'Newest' AS category, track_name, primary_artist AS artist, album_name, album_release_date, added_at
 FROM dated ORDER BY album_release_date DESC, save_id DESC, track_id DESC, supplier_id DESC LIMIT 10)
"""

ORACLES["saves_by_decade"] = f"""
WITH {_SAVED_TRACKS}
SELECT CAST(floor(CAST(substr(album_release_date, 1, 4) AS INTEGER) / 10) * 10 AS INTEGER) AS decade,
       COUNT(*) AS track_count, COUNT(DISTINCT album_id) AS unique_albums,
       COUNT(DISTINCT primary_artist_id) AS unique_artists, {rnd('AVG(popularity)', 1)} AS avg_popularity
FROM saved WHERE album_release_date IS NOT NULL GROUP BY 1
"""

ORACLES["saved_durations"] = f"""
WITH {_SAVED_TRACKS},
r AS (
  SELECT *, CASE WHEN duration_ms < 120000 THEN '< 2 min' WHEN duration_ms < 180000 THEN '2-3 min'
                 WHEN duration_ms < 240000 THEN '3-4 min' WHEN duration_ms < 300000 THEN '4-5 min'
                 WHEN duration_ms < 360000 THEN '5-6 min' ELSE '> 6 min' END AS duration_range FROM saved),
n AS (SELECT *, row_number() OVER (PARTITION BY duration_range ORDER BY popularity DESC, track_id, save_id) AS rn FROM r)
SELECT duration_range, COUNT(*) AS track_count, {rnd('AVG(popularity)', 1)} AS avg_popularity, MIN(duration_ms) AS min_ms,
       string_agg(track_name, '; ' ORDER BY rn) FILTER (WHERE rn <= 3) AS sample_tracks
FROM n GROUP BY duration_range
"""

ORACLES["labels_with_artists"] = f"""
WITH {_SAVED_ALBUMS},
a AS (SELECT label, popularity, primary_artist_rec.artist_name AS artist FROM sa WHERE label IS NOT NULL),
s AS (SELECT label, artist, row_number() OVER (PARTITION BY label ORDER BY artist) AS rn
      FROM (SELECT DISTINCT label, artist FROM a))
SELECT g.label, album_count, avg_popularity, sample_artists
FROM (SELECT label, COUNT(*) AS album_count, {rnd('AVG(popularity)', 1)} AS avg_popularity FROM a GROUP BY label) g
JOIN (SELECT label, string_agg(artist, ', ' ORDER BY artist) AS sample_artists FROM s WHERE rn <= 5 GROUP BY label) x
  USING (label)
ORDER BY album_count DESC, label LIMIT 20
"""

ORACLES["explicit_albums"] = f"""
WITH per AS (
  SELECT l_orderkey, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS explicit_tracks, COUNT(*) AS total_tracks
  FROM lineitem GROUP BY l_orderkey HAVING COUNT(*) FILTER (WHERE l_returnflag = 'R') > 0),
first_line AS (
  SELECT l_orderkey, l_suppkey FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey) = 1)
SELECT 'Album #' || CAST(l_orderkey AS VARCHAR) AS album_name, s_name AS primary_artist, explicit_tracks, total_tracks,
       {rnd('explicit_tracks * 100.0 / total_tracks', 1)} AS pct_explicit
FROM per JOIN first_line USING (l_orderkey) LEFT JOIN supplier ON s_suppkey = l_suppkey
ORDER BY pct_explicit DESC, l_orderkey LIMIT 20
"""

ORACLES["album_minutes_by_year"] = f"""
WITH {_SAVED_ALBUMS},
t AS (SELECT album_id, release_date, list_sum(list_transform(tracks, lambda x: x.duration_ms)) AS total,
             list_avg(list_transform(tracks, lambda x: x.duration_ms)) AS mean FROM sa)
SELECT CAST(year(release_date) AS INTEGER) AS release_year, COUNT(*) AS album_count,
       {rnd('AVG(total) / 1000 / 60', 1)} AS avg_album_minutes, {rnd('AVG(mean) / 1000', 1)} AS avg_track_seconds
FROM t GROUP BY 1
"""

ORACLES["collaborative_albums"] = f"""
WITH {_SAVED_ALBUMS}
SELECT album_name, album_type, popularity, release_date, CAST(len(album_artists) AS INTEGER) AS artist_count,
       array_to_string(list_sort(list_transform(album_artists, lambda x: x.artist_name)), ', ') AS artists
FROM sa WHERE len(album_artists) > 1 ORDER BY popularity DESC, album_id LIMIT 20
"""

ORACLES["runs_last_week"] = f"""
SELECT CAST(ts AS DATE) AS date, {rnd('SUM(value / 10)', 2)} AS total_distance_km,
       {rnd('SUM(COALESCE(value / 100, 0))', 1)} AS aerobic_score,
       {rnd('SUM(COALESCE(CASE WHEN value >= 150 THEN value / 50 - 3 END, 0))', 1)} AS anaerobic_score,
       substr(dayname(CAST(ts AS DATE)), 1, 1) AS day_of_week
FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-24' GROUP BY CAST(ts AS DATE)
"""

ORACLES["trend_with_weeks"] = f"""
WITH daily AS (
  SELECT CAST(ts AS DATE) AS date, AVG(value) AS v FROM events
  WHERE event_type = 'signup' AND ts >= TIMESTAMP '2023-07-31' GROUP BY 1),
cur AS (SELECT date AS current_date, v AS now FROM daily ORDER BY date DESC LIMIT 1),
old AS (SELECT v AS past FROM daily WHERE date <= DATE '2023-07-31' ORDER BY date LIMIT 1),
weeks AS (SELECT date_trunc('week', date) AS week, {rnd('AVG(v)', 2)} AS w FROM daily GROUP BY 1)
SELECT cur.current_date, {rnd('now', 2)} AS current_value,
       '[' || (SELECT string_agg(CAST(w AS VARCHAR), ',' ORDER BY week) FROM weeks) || ']' AS weekly_array,
       {rnd('now - COALESCE(past, now)', 2)} AS delta
FROM cur LEFT JOIN old ON TRUE
"""

ORACLES["incremental_worklist"] = f"""
WITH {_ENRICH} SELECT * FROM work WHERE first_played_at >= TIMESTAMP '1992-01-13'
"""
