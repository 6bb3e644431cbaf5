import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans import health as H

SLEEP = {
    "date": "2024-01-10",
    "dailySleepDTO": {
        "sleepTimeSeconds": 28800, "deepSleepSeconds": 5760, "lightSleepSeconds": 14400, "remSleepSeconds": 8640,
        "awakeSleepSeconds": 1800, "awakeCount": 2,
        "sleepStartTimestampLocal": 1704844800000 + 3600000, "sleepEndTimestampLocal": 1704873600000 + 3600000,
        "sleepStartTimestampGMT": 1704844800000,
        "sleepScores": {"overall": {"value": 84},
                        "deepPercentage": {"idealStartInSeconds": 16, "idealEndInSeconds": 33},
                        "lightPercentage": {"idealStartInSeconds": 30, "idealEndInSeconds": 64},
                        "remPercentage": {"idealStartInSeconds": 21, "idealEndInSeconds": 31}}},
    "sleepLevels": [{"startGMT": "2024-01-10T00:00:00", "endGMT": "2024-01-10T01:00:00", "activityLevel": 1.0}],
    "bodyBatteryChange": 55, "avgOvernightHrv": 48.0, "restingHeartRate": 52,
}


def test_sleep_night(spark):
    df = spark.createDataFrame([(json.dumps(SLEEP),)], "j string").select(F.from_json("j", H.SLEEP_SCHEMA).alias("s")).select("s.*")
    r = H.sleep_nights(df).first()
    assert r.sleep_hours == 8.0
    assert (r.deep.pct, r.deep.status) == (20.0, "optimal")
    assert (r.light.pct, r.light.status) == (50.0, "optimal")
    assert (r.rem.pct, r.rem.status) == (30.0, "optimal")
    assert r.awake.minutes == 30 and r.quality == "good"
    assert str(r.levels[0].start_local) == "2024-01-10 01:00:00"


def test_running_activities(spark):
    acts = spark.createDataFrame(
        [(1, "Morning Run", ("running",), "2024-01-01 07:00:00", 5000.0, 1800.0, 2.78, 150.4, 175.6, 350.5),
         (2, "Ride", ("cycling",), "2024-01-01 09:00:00", 20000.0, 3600.0, 5.5, 130.0, 160.0, 500.0)],
        "activityId long, activityName string, activityType struct<typeKey:string>, startTimeGMT string, "
        "distance double, duration double, averageSpeed double, averageHR double, maxHR double, calories double")
    splits = spark.createDataFrame(
        [(1, [(2, 2500.0, 900.0, 2.7, 152.0), (1, 2500.0, 900.0, 2.8, 149.0)])],
        "activityId long, lapDTOs array<struct<lapIndex:long,distance:double,duration:double,averageSpeed:double,averageHR:double>>")
    rows = H.running_activities(acts, splits).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.distance_km, r.duration_min, r.pace_min_per_km, r.avg_hr, r.max_hr) == (5.0, 30.0, 6.0, 150, 176)
    assert [lap.lap for lap in r.laps] == [1, 2] and r.activity_type == "run"


def test_every_event_of_a_night_is_a_level(spark, tmp_path):
    rows = [(1, "2024-01-05 22:00:01", 7, "click", 50.0), (2, "2024-01-05 22:03:00", 7, "click", None),
            (3, "2024-01-05 22:09:59", 7, "view", 30.0), (4, "2024-01-05 22:10:00", 7, "error", 20.0)]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    night = H.hub_sleep_nights(spark, str(tmp_path)).first()
    assert (night.level_count, night.last_level, night.avg_hrv) == (4, 0.2, 50.0)
    levels = H.hub_sleep_levels(spark, str(tmp_path)).orderBy("place").collect()
    assert [(x.place, x.level) for x in levels] == [(0, 0.5), (1, 0.2)]  # one per ten minutes
