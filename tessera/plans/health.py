"""Home-page health queries (P17–P28, P31) re-aimed at the events table, plus
the hub transforms for nested activity and sleep records (H07, H08).

Daily metrics come from one aggregate over events per day; every look-back
filter is written on the raw timestamp so it reaches the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import (
    hm_padded,
    round_half_up,
    round_to_long,
    safe_divide,
    weekday_letter,
    weekday_name,
)
from tessera.operators.relational import as_date, date_spine, interval_join, spine_fill, week_spine
from tessera.plans.star import star_from_events
from tessera.sources.tables import Tables

# Fixed values of the re-aimed home page
SPINE_DAYS = 10            # 11-day spine (0..10 days back)
MUSIC_LOOKBACK_DAYS = 14
SPINE_WEEKS = 6            # 7 Monday weeks
RECENT_DAYS = 7
HRV_DAYS = 30
COMPARE_DAYS = 30
STEP_GOAL = 5000
METRIC_TYPES = ("click", "error", "purchase", "signup", "view")


def _since(ts_col: str, as_of, days: int):
    """``DATE(ts) >= as_of - days`` written as a timestamp bound (prunable)."""
    return F.col(ts_col) >= F.date_sub(as_date(as_of), days).cast("timestamp_ntz")


def _events(spark, d):
    return Tables(spark, d).events


def music_time_daily(spark: SparkSession, d: str, as_of) -> DataFrame:
    """Listening time per day on an 11-day spine, bar height vs the max day."""
    star = star_from_events(spark, d)
    recent = star.fact.filter(_since("played_at", as_of, MUSIC_LOOKBACK_DAYS))
    per_day = (
        recent.join(star.tracks.select("track_id", "duration_ms"), "track_id", "left")
        .groupBy(F.to_date("played_at").alias("date"))
        .agg(F.sum("duration_ms").alias("total_duration_ms"))
    )
    filled = spine_fill(date_spine(spark, as_of, SPINE_DAYS), per_day, "date", {"total_duration_ms": 0})
    whole = Window.partitionBy()  # the spine has SPINE_DAYS + 1 rows
    with_stats = filled.withColumn("max_ms", F.max("total_duration_ms").over(whole)).withColumn(
        "avg_ms", F.avg("total_duration_ms").over(whole))
    avg = round_to_long(F.col("avg_ms"))
    return with_stats.select(
        "date", "total_duration_ms",
        F.when(F.col("max_ms") > 0, round_half_up(F.col("total_duration_ms") / F.col("max_ms") * 100, 2)).otherwise(
            F.lit(0.0)).alias("bar_height_percent"),
        weekday_letter("date").alias("day_letter"),
        hm_padded("total_duration_ms").alias("duration_formatted"),
        F.concat(F.floor(avg / 3600000).cast("string"), F.lit("h "),
                 F.floor(F.pmod(avg, F.lit(3600000)) / 60000).cast("string"), F.lit("m")).alias(
            "avg_duration_formatted"),
    )


def running_weekly_volume(spark: SparkSession, d: str, as_of) -> DataFrame:
    """Weekly distance and run count on a 7-week Monday spine."""
    ev = _events(spark, d).filter(F.col("event_type") == "purchase")
    start = F.date_sub(F.to_date(F.date_trunc("week", as_date(as_of))), SPINE_WEEKS * 7)
    runs = ev.filter(F.col("ts") >= start.cast("timestamp_ntz"))
    weekly = runs.groupBy(F.to_date(F.date_trunc("week", "ts")).alias("week_start")).agg(
        round_half_up(F.sum("value") / 10, 1).alias("total_km"), F.count(F.lit(1)).alias("runs"))
    return spine_fill(week_spine(spark, as_of, SPINE_WEEKS), weekly, "week_start", {"total_km": 0.0, "runs": 0})


def running_by_day(spark: SparkSession, d: str, as_of) -> DataFrame:
    """Runs per day of the current week — km, efforts, weekday letter."""
    ev = _events(spark, d).filter(F.col("event_type") == "purchase")
    monday = F.to_date(F.date_trunc("week", as_date(as_of)))
    runs = ev.filter(F.col("ts") >= monday.cast("timestamp_ntz"))
    return runs.groupBy(F.to_date("ts").alias("date")).agg(
        round_half_up(F.sum("value") / 10, 2).alias("km"),
        F.count(F.lit(1)).alias("runs"),
        round_half_up(F.max("value") / 100, 1).alias("aerobic"),
    ).withColumn("day_letter", weekday_letter("date")).withColumn("day_of_week", F.dayofweek("date"))


def body_battery_week(spark: SparkSession, d: str, as_of) -> DataFrame:
    """Last 7 days — daily high, low, gain, and the average gain."""
    ev = _events(spark, d).filter((F.col("event_type") == "view") & _since("ts", as_of, RECENT_DAYS))
    daily = ev.groupBy(F.to_date("ts").alias("date")).agg(
        F.max("value").alias("highest"), F.min("value").alias("lowest"))
    daily = daily.withColumn("gain", round_half_up(F.col("highest") - F.col("lowest"), 2))
    whole = Window.partitionBy()  # at most RECENT_DAYS + 1 rows
    return daily.withColumn("avg_gain", round_half_up(F.avg("gain").over(whole), 2)).withColumn(
        "day_name", weekday_name("date"))


def hrv_baseline(spark: SparkSession, d: str, as_of) -> DataFrame:
    """Daily average vs the median baseline (approximate median = an element).

    The baseline and the maximum are uncorrelated scalar subqueries over
    the small daily aggregate.
    """
    ev = _events(spark, d).filter((F.col("event_type") == "click") & _since("ts", as_of, HRV_DAYS))
    daily = ev.groupBy(F.to_date("ts").alias("date")).agg(round_half_up(F.avg("value"), 1).alias("hrv"))
    baseline = daily.select(F.percentile_approx("hrv", 0.5).alias("b")).scalar()
    top = daily.select(F.max("hrv")).scalar()
    return daily.select(
        "date", "hrv", baseline.alias("baseline"), (F.col("hrv") > baseline).alias("above_baseline"),
        round_half_up(safe_divide(F.col("hrv"), top) * 100, 1).alias("height_pct"))


def _daily_wide(spark, d) -> DataFrame:
    ev = _events(spark, d)
    return ev.groupBy(F.to_date("ts").alias("date")).pivot("event_type", list(METRIC_TYPES)).agg(
        round_half_up(F.avg("value"), 2))


def latest_vs_earlier(spark: SparkSession, d: str, as_of) -> DataFrame:
    """P20: latest metrics vs the latest row at least 30 days before ``as_of``.

    O05/O06 are ``max_by`` global aggregates (partial per task, no sort);
    U02 unpivots both rows, U03 pairs them back by metric name.
    """
    wide = _daily_wide(spark, d)
    cur = wide.agg(F.max_by(F.struct(*METRIC_TYPES), "date").alias("r"))
    prev = wide.filter(F.col("date") <= F.date_sub(as_date(as_of), COMPARE_DAYS)).agg(
        F.max_by(F.struct(*METRIC_TYPES), "date").alias("r"))
    cur_long = cur.select("r.*").unpivot([], list(METRIC_TYPES), "metric", "current_value")
    prev_long = prev.select("r.*").unpivot([], list(METRIC_TYPES), "metric", "previous_value")
    return cur_long.join(prev_long, "metric", "left").withColumn(
        "delta", round_half_up(F.col("current_value") - F.col("previous_value"), 2))


def weekly_average_trend(spark: SparkSession, d: str, as_of, lookback_days: int = 21) -> DataFrame:
    """Weekly averages, the current value, and the change since exactly
    ``lookback_days`` before the latest day (0 when that day has no value)."""
    ev = _events(spark, d).filter(F.col("event_type") == "signup")
    daily = ev.groupBy(F.to_date("ts").alias("date")).agg(F.avg("value").alias("v"))
    weekly = daily.groupBy(F.to_date(F.date_trunc("week", "date")).alias("week_start")).agg(
        round_half_up(F.avg("v"), 2).alias("weekly_avg"))
    latest = daily.agg(F.max_by("v", "date").alias("current"), F.max("date").alias("latest_date"))
    current = latest.select("current").scalar()
    past = daily.join(latest.select(F.date_sub("latest_date", lookback_days).alias("date")), "date").select(
        F.first("v")).scalar()
    return weekly.select(
        "week_start", "weekly_avg", round_half_up(current, 2).alias("current_value"),
        round_half_up(F.coalesce(current - past, F.lit(0.0)), 2).alias("delta"))


def stages_of_latest_day(spark: SparkSession, d: str) -> DataFrame:
    """The latest day's totals per stage (event type) with their share."""
    ev = _events(spark, d)
    # on the raw time, so that the scan can skip all earlier row groups
    last = ev.select(F.max("ts")).scalar()
    latest = F.to_date(last)
    day = ev.filter(F.col("ts") >= latest.cast("timestamp_ntz"))
    per = day.groupBy("event_type").agg(round_half_up(F.sum("value"), 2).alias("total"))
    total = F.sum("total").over(Window.partitionBy())  # one row per stage type
    return per.select(latest.alias("date"), F.col("event_type").alias("stage"), "total",
                      round_half_up(F.lit(100.0) * F.col("total") / total, 1).alias("pct"))


def steps_week(spark: SparkSession, d: str, as_of) -> DataFrame:
    """Last 7 days of 'steps' (rounded sums) against a fixed goal."""
    ev = _events(spark, d).filter((F.col("event_type") == "click") & _since("ts", as_of, RECENT_DAYS))
    daily = ev.groupBy(F.to_date("ts").alias("date")).agg(round_half_up(F.sum("value"), 0).cast("bigint").alias("steps"))
    whole = Window.partitionBy()  # at most RECENT_DAYS + 1 rows
    return daily.select(
        "date", "steps", F.lit(STEP_GOAL).alias("goal"),
        round_half_up(F.lit(100.0) * F.col("steps") / STEP_GOAL, 1).alias("goal_pct"),
        round_to_long(F.avg("steps").over(whole)).alias("avg_steps"))



# ---- nightly summary (hub sleep service re-aimed) and its home-page reads ----------

NIGHT_DAYS = 6             # ``date >= as_of - 6`` → at most 7 nights


def nights(spark: SparkSession, d: str, as_of=None, days: int | None = None) -> DataFrame:
    """One row per day — the hub sleep service shape, from ONE aggregate over events.

    sleep_score = rounded mean of 'signup' values; body_battery = the first
    and last 'view' value of the day (by time) and their difference;
    avg_hrv = mean 'click' value; resting_heart_rate = lowest 'error' value.
    Conditional aggregates share one scan and one small (per-day) shuffle.
    """
    ev = _events(spark, d)
    if days is not None:  # look-back on the raw timestamp: reaches the Parquet scan
        ev = ev.filter(_since("ts", as_of, days))
    t = F.col("event_type")
    view = F.when(t == "view", F.struct("ts", "value"))
    daily = ev.groupBy(F.to_date("ts").alias("date")).agg(
        round_to_long(F.avg(F.when(t == "signup", F.col("value")))).alias("sleep_score"),
        F.min(view)["value"].alias("_bed"), F.max(view)["value"].alias("_wake"),
        round_half_up(F.avg(F.when(t == "click", F.col("value"))), 1).alias("avg_hrv"),
        round_to_long(F.min(F.when(t == "error", F.col("value")))).alias("resting_heart_rate"),
    )
    return daily.select(
        "date", "sleep_score",
        F.struct(F.col("_bed").alias("at_bedtime"), F.col("_wake").alias("at_waketime"),
                 round_half_up(F.col("_wake") - F.col("_bed"), 2).alias("recovery")).alias("body_battery"),
        "avg_hrv", "resting_heart_rate")


def _recent_nights(spark, d, as_of, measure: str) -> DataFrame:
    return nights(spark, d, as_of, NIGHT_DAYS).filter(F.col(measure).isNotNull())


def resting_hr_week(spark: SparkSession, d: str, as_of) -> DataFrame:
    """The 7-day resting heart rate — average, and per day the value with
    its bar height against the week's maximum (J11 scalar, C28 safe divide)."""
    daily = _recent_nights(spark, d, as_of, "resting_heart_rate").select(
        "date", F.col("resting_heart_rate").alias("value"))
    whole = Window.partitionBy()  # at most NIGHT_DAYS + 1 rows
    ranked = daily.select(
        "date", "value", F.row_number().over(whole.orderBy("date")).alias("_n"),
        round_to_long(F.avg("value").over(whole)).alias("average"),
        F.max("value").over(whole).alias("_max"))
    return ranked.filter(F.col("_n") <= 7).select(  # ARRAY_AGG(... ORDER BY date LIMIT 7)
        F.date_format("date", "yyyy-MM-dd").alias("date"), weekday_letter("date").alias("day"), "value",
        round_half_up(safe_divide(F.col("value") * 100, F.col("_max")), 1).alias("display_height_percent"),
        "average")


def _last_seven(daily: DataFrame) -> DataFrame:
    """``ORDER BY date DESC LIMIT 7`` over a per-day frame (bounded: ≤ 7 days in)."""
    return daily.orderBy(F.col("date").desc()).limit(7)


def sleep_scores_week(spark: SparkSession, d: str, as_of) -> DataFrame:
    """P25: the last 7 nightly scores (ascending) and their rounded average."""
    last = _last_seven(_recent_nights(spark, d, as_of, "sleep_score").select("date", F.col("sleep_score").alias("score")))
    whole = Window.partitionBy()
    return last.select(F.date_format("date", "yyyy-MM-dd").alias("date"), weekday_letter("date").alias("day"),
                       "score", round_to_long(F.avg("score").over(whole)).alias("average"))


def sleep_battery_week(spark: SparkSession, d: str, as_of) -> DataFrame:
    """Sleep score, body battery (F04 nested fields), HRV and resting HR per night."""
    n = _recent_nights(spark, d, as_of, "sleep_score")
    return n.select(
        "date", weekday_letter("date").alias("day_abbr"), "sleep_score",
        F.col("body_battery.at_bedtime").alias("battery_at_bedtime"),
        F.col("body_battery.at_waketime").alias("battery_at_waketime"),
        F.col("body_battery.recovery").alias("battery_gain"),
        "avg_hrv", F.col("resting_heart_rate").alias("resting_hr"))


def stress_week(spark: SparkSession, d: str, as_of) -> DataFrame:
    """Daily average and maximum stress ('error' values) of the last 7 days.

    The daily source carries its day as ``yyyy-MM-dd`` text (``calendarDate``)
    and is parsed back with C23 ``to_date(text, fmt)``.
    """
    ev = _events(spark, d).filter((F.col("event_type") == "error") & _since("ts", as_of, NIGHT_DAYS))
    stress = ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("calendarDate")).agg(
        round_to_long(F.avg("value")).alias("avgStressLevel"), round_to_long(F.max("value")).alias("maxStressLevel"))
    daily = stress.select(F.to_date("calendarDate", "yyyy-MM-dd").alias("date"),
                          F.col("avgStressLevel").alias("avg_stress"), F.col("maxStressLevel").alias("max_stress"))
    last = _last_seven(daily.filter(F.col("date") >= F.date_sub(as_date(as_of), NIGHT_DAYS)))
    whole = Window.partitionBy()
    return last.select(F.date_format("date", "yyyy-MM-dd").alias("date"), weekday_letter("date").alias("day"),
                       "avg_stress", "max_stress",
                       round_to_long(F.avg("avg_stress").over(whole)).alias("average_stress"))


# ---- hub transforms over nested records (H07, H08) ---------------------------------

RUNNING_TYPES = ("running", "track_running", "trail_running", "treadmill_running")


def running_activities(activities: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """Running activities with unit conversions and nested laps.

    ``activities``: activityId, activityName, activityType.typeKey, startTimeGMT,
    distance (m), duration (s), averageSpeed (m/s), averageHR, maxHR, calories.
    ``splits``: activityId, lapDTOs array<struct<lapIndex, distance, duration,
    averageSpeed, averageHR>> (optional).
    """
    t = F.lower(F.col("activityType.typeKey"))
    runs = activities.filter(t.isin(list(RUNNING_TYPES)))
    pace = safe_divide(F.lit(1000.0) / 60, F.col("averageSpeed"))
    out = runs.select(
        F.col("activityId").alias("activity_id"), F.col("activityName").alias("activity_name"),
        F.replace(F.replace(t, F.lit("_"), F.lit(" ")), F.lit("running"), F.lit("run")).alias("activity_type"),
        F.col("startTimeGMT").alias("start_time"),
        round_half_up(F.col("distance") / 1000, 2).alias("distance_km"),
        round_half_up(F.col("duration") / 60, 1).alias("duration_min"),
        round_half_up(pace, 2).alias("pace_min_per_km"),
        round_half_up(F.col("averageSpeed") * 3.6, 1).alias("speed_kmh"),
        round_to_long(F.col("averageHR")).alias("avg_hr"),
        round_to_long(F.col("maxHR")).alias("max_hr"),
        F.col("calories"),
    )
    if splits is not None:
        laps = splits.select(
            F.col("activityId").alias("activity_id"),
            F.transform(
                F.array_sort(F.col("lapDTOs"), lambda a, b: F.when(a["lapIndex"] < b["lapIndex"], -1).when(
                    a["lapIndex"] > b["lapIndex"], 1).otherwise(0)),
                lambda x: F.struct(
                    x["lapIndex"].alias("lap"), round_half_up(x["distance"] / 1000, 2).alias("distance_km"),
                    round_half_up(x["duration"] / 60, 1).alias("duration_min"),
                    round_to_long(x["averageHR"]).alias("avg_hr"))).alias("laps"))
        out = out.join(laps, "activity_id", "left")
    return out


def _phase(seconds, total, ideal_start, ideal_end):
    pct = F.round(F.lit(100.0) * seconds / F.nullif(total, F.lit(0)), 1)
    return F.struct(
        F.round(seconds / 3600, 2).alias("hours"), pct.alias("pct"),
        F.when(pct.isNull() | ideal_start.isNull(), F.lit(None))
        .when(pct < ideal_start, "insufficient").when(pct > ideal_end, "excessive").otherwise("optimal").alias("status"),
    )


def sleep_nights(sleep: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One night with three phase structs (hours, %, status), awake time,
    body-battery change, quality tier, and the level array in local time.

    Input follows the sleep export: ``date``, ``dailySleepDTO`` struct,
    ``sleepLevels`` array<struct<startGMT, endGMT, activityLevel>>,
    ``bodyBatteryChange``, ``avgOvernightHrv``, ``restingHeartRate``;
    ``keys`` (e.g. a user id) pass through.
    """
    s = F.col("dailySleepDTO")
    total = s["sleepTimeSeconds"]
    scores = s["sleepScores"]
    offset_h = round_to_long((s["sleepStartTimestampLocal"] - s["sleepStartTimestampGMT"]) / 3600000)
    score = scores["overall"]["value"]
    levels = F.transform(
        F.col("sleepLevels"),
        lambda x: F.struct(
            F.timestamp_add("HOUR", offset_h, F.to_timestamp(x["startGMT"])).alias("start_local"),
            F.timestamp_add("HOUR", offset_h, F.to_timestamp(x["endGMT"])).alias("end_local"),
            x["activityLevel"].alias("level")))
    return sleep.select(
        *keys, F.to_date("date").alias("date"),
        F.timestamp_millis(s["sleepStartTimestampGMT"]).alias("sleep_start_gmt"),
        F.round(total / 3600, 2).alias("sleep_hours"),
        _phase(s["deepSleepSeconds"], total, scores["deepPercentage"]["idealStartInSeconds"],
               scores["deepPercentage"]["idealEndInSeconds"]).alias("deep"),
        _phase(s["lightSleepSeconds"], total, scores["lightPercentage"]["idealStartInSeconds"],
               scores["lightPercentage"]["idealEndInSeconds"]).alias("light"),
        _phase(s["remSleepSeconds"], total, scores["remPercentage"]["idealStartInSeconds"],
               scores["remPercentage"]["idealEndInSeconds"]).alias("rem"),
        F.struct(round_to_long(s["awakeSleepSeconds"] / 60).alias("minutes"), s["awakeCount"].alias("count")).alias("awake"),
        F.col("bodyBatteryChange").alias("body_battery_change"),
        score.alias("score"),
        F.when(score >= 90, "excellent").when(score >= 80, "good").when(score >= 60, "fair").when(
            score.isNotNull(), "poor").alias("quality"),
        F.col("avgOvernightHrv").alias("avg_hrv"),
        F.col("restingHeartRate").alias("resting_hr"),
        levels.alias("levels"),
    )


SLEEP_SCHEMA = T.StructType.fromJson({
    "type": "struct",
    "fields": [
        {"name": "date", "type": "string", "nullable": True, "metadata": {}},
        {"name": "dailySleepDTO", "nullable": True, "metadata": {}, "type": {"type": "struct", "fields": [
            {"name": n, "type": "long", "nullable": True, "metadata": {}} for n in (
                "sleepTimeSeconds", "deepSleepSeconds", "lightSleepSeconds", "remSleepSeconds",
                "awakeSleepSeconds", "awakeCount", "sleepStartTimestampLocal", "sleepEndTimestampLocal",
                "sleepStartTimestampGMT")] + [
            {"name": "sleepScores", "nullable": True, "metadata": {}, "type": {"type": "struct", "fields": [
                {"name": "overall", "nullable": True, "metadata": {}, "type": {"type": "struct", "fields": [
                    {"name": "value", "type": "long", "nullable": True, "metadata": {}}]}}] + [
                {"name": p, "nullable": True, "metadata": {}, "type": {"type": "struct", "fields": [
                    {"name": "idealStartInSeconds", "type": "double", "nullable": True, "metadata": {}},
                    {"name": "idealEndInSeconds", "type": "double", "nullable": True, "metadata": {}}]}}
                for p in ("deepPercentage", "lightPercentage", "remPercentage")]}}]}},
        {"name": "sleepLevels", "nullable": True, "metadata": {}, "type": {"type": "array", "containsNull": True,
            "elementType": {"type": "struct", "fields": [
                {"name": "startGMT", "type": "string", "nullable": True, "metadata": {}},
                {"name": "endGMT", "type": "string", "nullable": True, "metadata": {}},
                {"name": "activityLevel", "type": "double", "nullable": True, "metadata": {}}]}}},
        {"name": "bodyBatteryChange", "type": "long", "nullable": True, "metadata": {}},
        {"name": "avgOvernightHrv", "type": "double", "nullable": True, "metadata": {}},
        {"name": "restingHeartRate", "type": "long", "nullable": True, "metadata": {}},
    ],
})


def homepage_bundle(spark: SparkSession, d: str, as_of) -> DataFrame:
    """The home-page datasets as one row of arrays (each part is
    bounded: day spines, 7-day windows, top-10 lists)."""
    from tessera.plans import music
    from tessera.sources.sinks import bundle

    star = star_from_events(spark, d)
    return bundle({
        "music_time_daily": music_time_daily(spark, d, as_of),
        "running_weekly_volume": running_weekly_volume(spark, d, as_of),
        "running_by_day": running_by_day(spark, d, as_of),
        "body_battery": body_battery_week(spark, d, as_of),
        "hrv": hrv_baseline(spark, d, as_of),
        "race_prediction": latest_vs_earlier(spark, d, as_of),
        "vo2max": weekly_average_trend(spark, d, as_of),
        "sleep_stages": stages_of_latest_day(spark, d),
        "steps": steps_week(spark, d, as_of),
        "resting_hr": resting_hr_week(spark, d, as_of),
        "sleep_scores": sleep_scores_week(spark, d, as_of),
        "sleep_body_battery": sleep_battery_week(spark, d, as_of),
        "stress": stress_week(spark, d, as_of),
        "top_tracks": music.top_tracks_recent(star, as_of),
        "top_artists": music.top_artists_recent(star, as_of),
    })


# ---- hub health over records derived from the events table (H07, H08) --------------

# Fixed values of the re-aim: activity type by user, ideal phase shares (percent)
RUN_TYPES_BY_USER = ("running", "trail_running", "treadmill_running", "cycling")
IDEAL_PHASES = {"deepPercentage": (16.0, 33.0), "lightPercentage": (30.0, 64.0), "remPercentage": (21.0, 31.0)}
LEVEL_MINUTES = 10


def activity_records(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Activity export rows and their splits, derived from 'purchase' events.

    Laps are the same user's other events inside the activity's 30 minutes
    (interval join, J06), nested per activity in time order — bounded by one
    activity's window.
    """
    from tessera.plans import activities as A

    ev = _events(spark, d)
    acts = ev.filter(F.col("event_type") == A.ACTIVITY_TYPE)
    type_key = F.element_at(F.array(*[F.lit(t) for t in RUN_TYPES_BY_USER]),
                            (F.pmod(F.col("user_id"), F.lit(len(RUN_TYPES_BY_USER))) + 1).cast("int"))
    duration = F.lit(1800.0) + F.pmod(F.col("event_id"), F.lit(600)).cast("double")
    records = acts.select(
        F.col("event_id").alias("activityId"), F.concat(F.lit("Run "), F.col("event_id").cast("string")).alias(
            "activityName"),
        F.struct(type_key.alias("typeKey")).alias("activityType"), F.col("ts").alias("startTimeGMT"),
        (F.col("value") * 100).alias("distance"), duration.alias("duration"),
        (F.col("value") * 100 / duration).alias("averageSpeed"), (F.lit(100.0) + F.col("value") / 5).alias("averageHR"),
        (F.lit(120) + F.floor(F.col("value") / 5)).cast("bigint").alias("maxHR"),
        (F.col("value") * 3).alias("calories"))
    spans = acts.select(F.col("event_id").alias("activityId"), "user_id", F.col("ts").alias("start_ts"),
                        (F.col("ts") + F.expr(f"INTERVAL {A.ACTIVITY_MINUTES} MINUTES")).alias("end_ts"))
    points = ev.filter(F.col("event_type") != A.ACTIVITY_TYPE).select("user_id", "event_id", "ts", "value")
    pairs = interval_join(spans, points, "start_ts", "end_ts", "ts", keys=["user_id"],
                          bucket_seconds=A.ACTIVITY_MINUTES * 60)
    lap = F.struct(F.col("ts").alias("_t"), F.col("event_id").alias("_id"), F.col("value").alias("_v"))
    splits = pairs.groupBy("activityId").agg(F.array_sort(F.collect_list(lap)).alias("_laps")).select(
        "activityId",
        F.transform("_laps", lambda x, i: F.struct(
            (i + 1).cast("bigint").alias("lapIndex"), (x["_v"] * 10).alias("distance"), F.lit(300.0).alias("duration"),
            (x["_v"] * 10 / 300).alias("averageSpeed"), (F.lit(100.0) + x["_v"] / 5).alias("averageHR"))).alias(
            "lapDTOs"))
    return records, splits


def hub_running_activities(spark: SparkSession, d: str) -> DataFrame:
    """H07 on derived records: running activities with unit conversions, laps summarised."""
    records, splits = activity_records(spark, d)
    runs = running_activities(records, splits)
    return runs.select(
        "activity_id", "activity_name", "activity_type", "start_time", "distance_km", "duration_min",
        "pace_min_per_km", "speed_kmh", "avg_hr", "max_hr", "calories",
        F.when(F.col("laps").isNull(), F.lit(0)).otherwise(F.size("laps")).alias("lap_count"),
        F.element_at("laps", 1)["distance_km"].alias("first_lap_km"),
        F.element_at("laps", -1)["avg_hr"].alias("last_lap_hr"))


def sleep_records(spark: SparkSession, d: str, slotted: bool = False) -> DataFrame:
    """Sleep export rows (``SLEEP_SCHEMA`` shape), one per user and day of events.

    Phases come from event counts (20 min each).  The levels array holds the
    day's events in time order (bounded by one user-day); ``slotted`` has one
    level per ``LEVEL_MINUTES`` of the day, its first event's: slots are aggregated first.
    """
    t = F.col("event_type")
    day, slot = F.to_date("ts").alias("_date"), F.expr(f"(hour(ts) * 60 + minute(ts)) div {LEVEL_MINUTES}").alias("_slot")
    one = lambda when: F.when(when, 1).otherwise(0)
    of = lambda typ: F.when(t == typ, F.col("value"))
    rows = _events(spark, d).select(
        "user_id", day, slot, F.lit(1).alias("n"), one(t == "click").alias("clicks"), one(t == "view").alias("views"),
        one(t == "signup").alias("signups"), one(t == "error").alias("errors"), F.col("value").alias("s"),
        of("view").alias("hi"), of("view").alias("lo"), of("click").alias("click_s"),
        one(of("click").isNotNull()).alias("click_n"), of("error").alias("rhr"),
        F.struct(F.col("ts").alias("_t"), F.col("event_id").alias("_id"), F.col("value").alias("_v")).alias("level"))
    if slotted:
        rows = rows.groupBy("user_id", "_date", "_slot").agg(
            *[F.sum(c).alias(c) for c in ("n", "clicks", "views", "signups", "errors", "s", "click_s", "click_n")],
            F.max("hi").alias("hi"), *[F.min(c).alias(c) for c in ("lo", "rhr", "level")])
    total = lambda c: F.sum(c).cast("bigint")
    day = rows.groupBy("user_id", "_date").agg(
        total("n").alias("_n"), (total("clicks") * 1200).alias("deep"), (total("views") * 1200).alias("light"),
        (total("signups") * 1200).alias("rem"), total("errors").alias("awake_count"), F.min("level._t").alias("_start"),
        F.sum("s").alias("_sum"), F.max("hi").alias("_hi"), F.min("lo").alias("_lo"),
        (F.sum("click_s") / F.nullif(F.sum("click_n"), F.lit(0))).alias("_hrv"), F.min("rhr").alias("_rhr"),
        F.array_sort(F.collect_list("level")).alias("_levels"))
    start_ms = F.unix_millis(F.col("_start").cast("timestamp"))
    ideal = {p: F.struct(F.lit(lo).alias("idealStartInSeconds"), F.lit(hi).alias("idealEndInSeconds")).alias(p)
             for p, (lo, hi) in IDEAL_PHASES.items()}
    dto = F.struct(
        (F.col("_n").cast("bigint") * 1200).alias("sleepTimeSeconds"), F.col("deep").alias("deepSleepSeconds"),
        F.col("light").alias("lightSleepSeconds"), F.col("rem").alias("remSleepSeconds"),
        (F.col("awake_count").cast("bigint") * 60).alias("awakeSleepSeconds"),
        F.col("awake_count").cast("bigint").alias("awakeCount"),
        (start_ms + 3600000).alias("sleepStartTimestampLocal"), (start_ms + 3600000 + 8 * 3600000).alias(
            "sleepEndTimestampLocal"),
        start_ms.alias("sleepStartTimestampGMT"),
        F.struct(F.struct(F.pmod(round_half_up(F.col("_sum"), 0).cast("bigint"), F.lit(101)).alias("value")).alias(
                     "overall"),
                 *ideal.values()).alias("sleepScores"))
    levels = F.transform("_levels", lambda x: F.struct(
        F.date_format(x["_t"], "yyyy-MM-dd HH:mm:ss").alias("startGMT"),
        F.date_format(x["_t"] + F.expr(f"INTERVAL {LEVEL_MINUTES} MINUTES"), "yyyy-MM-dd HH:mm:ss").alias("endGMT"),
        (x["_v"] / 100).alias("activityLevel")))
    return day.select(
        "user_id", F.date_format("_date", "yyyy-MM-dd").alias("date"), dto.alias("dailySleepDTO"),
        levels.alias("sleepLevels"), round_to_long(F.col("_hi") - F.col("_lo")).alias("bodyBatteryChange"),
        F.col("_hrv").alias("avgOvernightHrv"), round_to_long(F.col("_rhr")).alias("restingHeartRate"))


def hub_sleep_nights(spark: SparkSession, d: str) -> DataFrame:
    """H08 on derived records: one night per user and day, phases flattened for display."""
    n = sleep_nights(sleep_records(spark, d), keys=["user_id"])
    return n.select(
        "user_id", "date", F.col("sleep_start_gmt").cast("timestamp_ntz").alias("sleep_start_gmt"), "sleep_hours",
        *[F.col(f"{p}.{f}").alias(f"{p}_{f}") for p in ("deep", "light", "rem") for f in ("hours", "pct", "status")],
        F.col("awake.minutes").alias("awake_minutes"), F.col("awake.count").alias("awake_count"),
        "body_battery_change", "score", "quality", round_half_up(F.col("avg_hrv"), 2).alias("avg_hrv"), "resting_hr",
        F.size("levels").alias("level_count"),
        F.element_at("levels", 1)["start_local"].cast("timestamp_ntz").alias("first_level_local"),
        F.element_at("levels", -1)["level"].alias("last_level"))


def hub_sleep_levels(spark: SparkSession, d: str) -> DataFrame:
    """Every level of every night (one per ``LEVEL_MINUTES``), in local time."""
    n = sleep_nights(sleep_records(spark, d, slotted=True), keys=["user_id"])
    levels = n.select("user_id", "date", F.posexplode("levels").alias("place", "l"))
    local = lambda c: F.col(f"l.{c}").cast("timestamp_ntz").alias(c)
    return levels.select("user_id", "date", "place", local("start_local"), local("end_local"), F.col("l.level").alias("level"))
