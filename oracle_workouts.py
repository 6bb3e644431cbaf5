"""DuckDB oracle SQL of the queries over activities with nested payloads (``tessera/plans/workouts.py``)."""

from oracle_queries import rnd


def whole(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,9))) AS BIGINT)"


_R = """
reading AS (
  SELECT l_suppkey AS id, l_shipdate AS day, count(*) AS n, sum(l_quantity) AS qty, min(l_orderkey) AS k
  FROM lineitem GROUP BY ALL),
hr AS (SELECT *, CASE WHEN k % 9 <> 0 THEN 90 + n * 7 + k % 40 END AS hr, qty / n AS pw FROM reading),
tot AS (
  SELECT id, sum(qty) AS q, CAST(sum(n) AS BIGINT) AS n, min(day) AS d0, max(day) AS d1, max(qty) AS best, min(k) AS k,
         CAST(max(hr) AS BIGINT) AS max_hr, sum(hr) * 1.0 / nullif(count(hr), 0) AS avg_hr,
         sum(60.0) FILTER (hr < 105) AS h1, sum(60.0) FILTER (hr >= 105 AND hr < 115) AS h2,
         sum(60.0) FILTER (hr >= 115 AND hr < 125) AS h3, sum(60.0) FILTER (hr >= 125 AND hr < 135) AS h4,
         sum(60.0) FILTER (hr >= 135) AS h5,
         sum(60.0) FILTER (pw < 10) AS p1, sum(60.0) FILTER (pw >= 10 AND pw < 20) AS p2,
         sum(60.0) FILTER (pw >= 20 AND pw < 30) AS p3, sum(60.0) FILTER (pw >= 30 AND pw < 40) AS p4,
         sum(60.0) FILTER (pw >= 40) AS p5
  FROM hr GROUP BY id),
act AS (
  SELECT t.*, s_name, s_acctbal, q * 10 AS dist,
         ['running', 'trail_running', 'track_running', 'treadmill_running', 'cycling'][s_nationkey % 5 + 1] AS typ,
         CASE WHEN id % 13 <> 5 THEN id % 6 <> 1 END AS has_line
  FROM supplier JOIN tot AS t ON s_suppkey = t.id),
lap AS (
  SELECT l_suppkey AS id, CAST(year(l_shipdate) - 1994 AS BIGINT) AS idx, min(l_shipdate) AS t0, sum(l_quantity) AS qty,
         count(*) AS n, sum(l_linenumber) AS ln, count(*) FILTER (l_returnflag = 'A') AS up,
         count(*) FILTER (l_returnflag = 'R') AS down
  FROM lineitem WHERE l_suppkey % 7 <> 3 GROUP BY ALL),
typed AS (
  SELECT l_suppkey AS id, l_linenumber AS ln0,
         ['INTERVAL_WARMUP', 'INTERVAL_WORK', 'INTERVAL_RECOVERY', 'INTERVAL_COOLDOWN', 'INTERVAL_REST', 'INTERVAL',
          'RWD_RUN'][l_linenumber] AS typ,
         CASE WHEN l_linenumber <> 6 THEN 8 - l_linenumber END AS idx, min(l_shipdate) AS t0, sum(l_quantity) AS qty,
         count(*) AS n, sum(l_linenumber) AS ln, count(*) FILTER (l_returnflag = 'A') AS up,
         count(*) FILTER (l_returnflag = 'R') AS down
  FROM lineitem WHERE l_suppkey % 7 <> 3 GROUP BY ALL),
vec AS (
  SELECT id, day, CAST(epoch_ms(day) AS DOUBLE) AS ms, hr, sum(qty) OVER (PARTITION BY id ORDER BY day) * 10 AS dist,
         CASE WHEN k % 13 = 0 THEN 0.0 WHEN k % 11 <> 0 THEN qty / 8 END AS speed, (k % 5000) / 7 AS alt
  FROM hr WHERE id % 5 <> 2),
pt AS (
  SELECT l_suppkey AS id, l_shipdate AS day, (480000 + l_orderkey % 10000) / 10000.0 AS lat,
         (20000 + l_partkey % 10000) / 10000.0 AS lon
  FROM lineitem WHERE l_suppkey % 5 <> 2
  QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY l_orderkey, l_linenumber, l_partkey) = 1)
"""

_RUNS = "typ IN ('running', 'trail_running', 'track_running', 'treadmill_running')"

ORACLES: dict[str, str] = {}

ORACLES["hub_activity_rows"] = f"""
WITH {_R},
nl AS (SELECT id, CAST(count(*) AS INTEGER) AS n FROM lap GROUP BY id),
ni AS (SELECT id, CAST(count(*) FILTER (typ <> 'RWD_RUN') AS INTEGER) AS n FROM typed GROUP BY id),
nv AS (SELECT id, CAST(count(*) AS INTEGER) AS n FROM vec GROUP BY id),
np AS (SELECT id, CAST(count(*) AS INTEGER) AS n FROM pt GROUP BY id)
SELECT id AS "activityId", 'Activity ' || s_name AS "activityName", d0 AS "startTimeGMT",
       d1 + INTERVAL 1 HOUR AS "endTimeGMT", typ AS "typeKey", dist AS distance, act.n * 60.0::DOUBLE AS duration,
       act.n * 61.0::DOUBLE AS "elapsedDuration", CAST(k % 100 AS DOUBLE) AS "elevationGain",
       CAST(k % 90 AS DOUBLE) AS "elevationLoss", dist / (act.n * 60.0::DOUBLE) AS "averageSpeed", has_line AS "hasPolyline",
       act.n AS calories, CAST(avg_hr AS DOUBLE) AS "averageHR", max_hr AS "maxHR",
       (k % 50) / 10::DOUBLE AS "aerobicTrainingEffect", (k % 30) / 10::DOUBLE AS "anaerobicTrainingEffect",
       k % 10 AS "minElevation", k % 10 + 200 AS "maxElevation", s_acctbal AS "activityTrainingLoad",
       {', '.join(f'CASE WHEN dist >= {m} THEN {m}::DOUBLE / best END AS "fastestSplit_{m}"'
                  for m in (1000, 1609, 5000, 10000, 21098, 42195))},
       {', '.join(f'CAST(h{z} AS DOUBLE) AS "hrTimeInZone_{z}", CAST(p{z} AS DOUBLE) AS "powerTimeInZone_{z}"'
                  for z in range(1, 6))},
       nl.n AS n_kilometer_laps, ni.n AS n_training_intervals, nv.n AS n_time_series, np.n AS n_polyline,
       d1 AS _dp_inserted_at
FROM act LEFT JOIN nl USING (id) LEFT JOIN ni USING (id) LEFT JOIN nv USING (id) LEFT JOIN np USING (id)
WHERE {_RUNS}
"""

_FIELDS = ("qty * 10 AS v2, n * 60.0::DOUBLE AS v3, qty * 10 / (n * 60.0::DOUBLE) AS v4, CAST(ln AS DOUBLE) AS v5, "
           "CAST(100 + n % 60 AS DOUBLE) AS v6, CAST(110 + n % 60 AS DOUBLE) AS v7, CAST(up AS DOUBLE) AS v8, "
           "CAST(down AS DOUBLE) AS v9")

ORACLES["hub_activity_elements"] = f"""
WITH {_R},
el AS (
  SELECT id, 'lap' AS part, row_number() OVER (PARTITION BY id ORDER BY idx) AS place,
         strftime(t0, '%Y-%m-%d %H:%M:%S') AS started, NULL AS kind, CAST(idx AS DOUBLE) AS v1, {_FIELDS} FROM lap
  UNION ALL
  SELECT id, 'interval', row_number() OVER (PARTITION BY id ORDER BY idx NULLS FIRST),
         strftime(t0, '%Y-%m-%d %H:%M:%S'),
         CASE typ WHEN 'INTERVAL_WARMUP' THEN 'warmup|Échauffement' WHEN 'INTERVAL_WORK' THEN 'work|Effort'
                  WHEN 'INTERVAL_RECOVERY' THEN 'recovery|Récupération'
                  WHEN 'INTERVAL_COOLDOWN' THEN 'cooldown|Retour au calme' WHEN 'INTERVAL_REST' THEN 'rest|Repos'
                  ELSE 'work|INTERVAL' END, CAST(idx AS DOUBLE), {_FIELDS}
  FROM typed WHERE typ <> 'RWD_RUN'
  UNION ALL
  SELECT id, 'reading', row_number() OVER (PARTITION BY id ORDER BY day), NULL, NULL, ms, {rnd('dist / 1000', 4)},
         CAST(hr AS DOUBLE), {rnd('1000.0::DOUBLE / nullif(speed, 0) / 60', 4)}, {rnd('alt', 1)},
         {rnd('speed * 3.6::DOUBLE', 2)}, NULL, NULL, NULL
  FROM vec
  UNION ALL
  SELECT id, 'point', row_number() OVER (PARTITION BY id ORDER BY day), NULL, NULL, lat, lon,
         CAST(epoch_ms(day) AS DOUBLE), NULL, NULL, NULL, NULL, NULL, NULL
  FROM pt)
SELECT id AS "activityId", CAST(place AS INTEGER) AS place, part, started, kind, v1, v2, v3, v4, v5, v6, v7, v8, v9
FROM el JOIN act USING (id) WHERE act.{_RUNS}
"""

ORACLES["activity_cards"] = f"""
WITH {_R},
line AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY day) - 1 AS i, count(*) OVER (PARTITION BY id) AS n FROM pt),
thin AS (
  SELECT id, '[' || string_agg('{{"lat":' || CAST(CAST(lat AS DOUBLE) AS VARCHAR) || ',"lng":' ||
                               CAST(CAST(lon AS DOUBLE) AS VARCHAR) || '}}', ',' ORDER BY i) || ']' AS js
  FROM line WHERE n <= 80 OR i % CAST(ceil(n / 80.0) AS BIGINT) = 0 GROUP BY id),
z AS (SELECT *, coalesce(h1, 0) + coalesce(h2, 0) + coalesce(h3, 0) + coalesce(h4, 0) + coalesce(h5, 0) AS h FROM act)
SELECT id AS "activityId", 'Activity ' || s_name AS "activityName", d0 AS "startTimeGMT", typ AS "typeKey",
       {rnd('dist / 1000', 1)} AS distance_km, CAST(n AS DOUBLE) AS duration_minutes, {whole('avg_hr')} AS "averageHR",
       {', '.join(f'''{whole(f'CAST(h{k} AS DOUBLE) / nullif(CAST(h AS DOUBLE), 0) * 100')} AS "hrZone{k}_pct"'''
                  for k in range(1, 6))},
       CASE WHEN has_line THEN js END AS polyline_simplified
FROM z LEFT JOIN thin USING (id)
"""

ORACLES["activity_children"] = f"""
WITH {_R},
l AS (SELECT id, max(qty * 10) AS far FROM lap GROUP BY id),
t AS (SELECT id, CAST(count(*) AS INTEGER) AS n FROM typed GROUP BY id),
v AS (SELECT id, CAST(count(*) AS INTEGER) AS n FROM vec GROUP BY id)
SELECT id AS "activityId", 'Activity ' || s_name AS "activityName", l.id IS NOT NULL AS has_splits,
       v.id IS NOT NULL AS has_details, id % 11 <> 4 AS has_zones, far AS longest_lap, t.n AS n_splits, v.n AS n_readings,
       CASE WHEN id % 11 <> 4 THEN CAST(h3 AS DOUBLE) END AS zone3_seconds
FROM act LEFT JOIN l USING (id) LEFT JOIN t USING (id) LEFT JOIN v USING (id)
"""

ORACLES["activity_documents"] = ORACLES["hub_activity_elements"]
