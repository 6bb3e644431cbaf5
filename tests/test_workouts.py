import json

from pyspark.sql import functions as F

from tessera.operators.records import enrich_all
from tessera.operators.relational import first_per_bucket
from tessera.plans import workouts as W

ACTIVITY = (
    "activityId long, activityName string, startTimeGMT string, endTimeGMT string, activityType struct<typeKey:string>, "
    "distance double, duration double, elapsedDuration double, elevationGain double, elevationLoss double, "
    "averageSpeed double, hasPolyline boolean, calories long, averageHR double, maxHR double, "
    "aerobicTrainingEffect double, anaerobicTrainingEffect double, minElevation double, maxElevation double, "
    "activityTrainingLoad double, " + ", ".join(f"fastestSplit_{m} double" for m in W.FASTEST) + ", "
    + ", ".join(f"{k}TimeInZone_{z} double" for k in ("hr", "power") for z in W.ZONES) + ", _dp_inserted_at string")


def _activity(i, kind, line=True, zones=(60.0, None, 30.0, None, 30.0)):
    return (i, f"a{i}", "2024-01-01 07:00:00", "2024-01-01 08:00:00", (kind,), 5049.0, 1815.0, 1900.0, 10.0, 11.0, 2.5, line,
            300, 150.5, 180.0, 3.0, 1.0, 5.0, 50.0, 99.0, *[float(m) / 4 for m in W.FASTEST], *zones, *zones, "x")


def _payloads(spark):
    acts = spark.createDataFrame(
        [_activity(1, "trail_running"), _activity(2, "cycling", None), _activity(3, "running", False, (None,) * 5)], ACTIVITY)
    lap = "lapIndex:int,startTimeGMT:string,distance:double,duration:double,averageSpeed:double,calories:long," \
          "averageHR:double,maxHR:double,elevationGain:double,elevationLoss:double"
    typed = "type:string,lapIndexes:array<int>,startTimeGMT:string,distance:string,duration:string,averageSpeed:string," \
            "calories:string,averageHR:string,maxHR:string,elevationGain:string,elevationLoss:string"
    numbers = (1000.0, 300.0, 3.0, 70, 140.0, 160.0, 1.0, 2.0)
    text = tuple(str(x) for x in numbers)
    splits = spark.createDataFrame(
        [(1, ([(2, "t2", *numbers), (1, "t1", *numbers)],),
          ([("INTERVAL_WORK", [5, 6], "t5", *text), ("RWD_RUN", [1], "t1", *text), ("INTERVAL", [], "t0", *text),
            ("INTERVAL_ACTIVE", [2], "t2", *text)],))],
        f"activityId long, splits struct<lapDTOs:array<struct<{lap}>>>, typed_splits struct<splits:array<struct<{typed}>>>")
    vectors = [([2.0, 2000.0, 140.0, 100.0, None],), ([0.0, 1000.0, None, 50.0, 12.34],)]
    line = [(48.0 + i / 100, 2.0, 1000 - i) for i in range(170)]
    details = spark.createDataFrame(
        [(1, ([(m, i) for i, m in enumerate(W.METRICS)], vectors, (line,))), (2, ([], [], ([],)))],
        "activityId long, detailed_data struct<metricDescriptors:array<struct<key:string,metricsIndex:int>>,"
        "activityDetailMetrics:array<struct<metrics:array<double>>>,"
        "geoPolylineDTO:struct<polyline:array<struct<lat:double,lon:double,time:long>>>>")
    return acts, splits, details


def test_hub_activities_nest_every_payload(spark):
    rows = {r.activityId: r for r in W.hub_activities(*_payloads(spark)).collect()}
    assert set(rows) == {1, 3}
    r = rows[1]
    assert [x.lapIndex for x in r.kilometer_laps] == [1, 2] and tuple(r.kilometer_laps[0].asDict()) == W.LAP_FIELDS
    # an empty list of lap indexes has a null index and stands first; other interval types keep their own name
    assert [(x.lapIndex, x.intensityType, x.name) for x in r.training_intervals] == [
        (None, "work", "INTERVAL"), (2, "active", "INTERVAL_ACTIVE"), (5, "work", "Effort")]
    assert r.training_intervals[0].distance == 1000.0 and r.training_intervals[0].calories == 70
    assert [tuple(x) for x in r.time_series] == [
        (1000, 0.05, None, None, 12.3, 0.0), (2000, 0.1, 140, 8.3333, None, 7.2)]
    assert [p.time for p in r.polyline] == sorted(1000 - i for i in range(170))
    assert tuple(r.hr_zones) == (60.0, None, 30.0, None, 30.0) and r.fastestSplits.fastestSplit_1000 == 250.0
    assert rows[3].kilometer_laps is None and rows[3].polyline is None


def test_activity_cards_thin_by_index(spark):
    acts, _, details = _payloads(spark)
    rows = {r.activityId: r for r in W.activity_cards(acts, details).collect()}
    assert set(rows) == {1, 2, 3}
    points = json.loads(rows[1].polyline_simplified)
    assert len(points) == 57 and points[0] == {"lat": 49.69, "lng": 2.0}  # every third of 170, from the earliest
    assert (rows[1].hrZone1_pct, rows[1].hrZone2_pct, rows[1].hrZone3_pct) == (50, None, 25)
    assert (rows[1].distance_km, rows[1].duration_minutes, rows[1].averageHR) == (5.0, 30.3, 151)
    assert rows[2].polyline_simplified is None and rows[3].polyline_simplified is None and rows[3].hrZone1_pct is None


def test_thinned_keeps_all_up_to_the_limit(spark):
    df = spark.createDataFrame([(n, list(range(n))) for n in (0, 79, 80, 81, 160, 161)], "n int, a array<int>")
    got = {r.n: r.t for r in df.select("n", W.thinned(F.col("a")).alias("t")).collect()}
    assert got[0] == [] and got[80] == list(range(80)) and got[81] == list(range(0, 81, 2))
    assert got[160] == list(range(0, 160, 2)) and got[161] == list(range(0, 161, 3))


def test_thinned_builds_its_array_once(spark):
    df = spark.createDataFrame([([3, None, 1],)], "a array<int>").select(W.thinned(F.array_sort("a")).alias("t"))
    assert df.first().t == [1, 3, None]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("array_sort(") <= 1  # not once more per element
    plan = spark.range(1).select(W.thinned(F.array_sort(F.array("id"))).alias("t"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("array_sort(") == 1


def test_enrich_all_is_one_shuffle(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    one = spark.createDataFrame([(1, 10), (9, 90)], "id int, v int")
    two = spark.createDataFrame([(1, 1.5), (3, None)], "id int, w double")
    out = enrich_all(parent, {"one": one, "two": two}, "id")
    rows = {r.id: (r.v, r.one and r.one.v, r.two and tuple(r.two)) for r in out.collect()}
    assert rows == {1: ("a", 10, (1.5,)), 2: ("b", None, None), 3: ("c", None, (None,))}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 2


def test_first_per_bucket_bounds_a_hot_key(spark):
    df = spark.range(0, 20_000).select(F.lit(1).alias("k"), (F.col("id") % 7).alias("b"), F.col("id").alias("o"),
                                       (F.col("id") * 2).alias("v"))
    out = first_per_bucket(df, ["k", "b"], ["o", "v"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, b, b, 2 * b) for b in range(7)]
