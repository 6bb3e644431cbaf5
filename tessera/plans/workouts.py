"""Activities with all their nested payloads (H07, N19, P03, R07), re-aimed at lineitem and supplier.

An activity is a supplier; its device readings are the days on which it shipped.
A day is the time bucket: a reading is one aggregate per (activity, day) and a
GPS point the day's first line, so what is gathered into an activity's arrays is
bounded by the days of the log, however many lines one supplier holds, and the
lines themselves are only ever pre-aggregated.

The payload frames have the shape of the exports:

* ``activities``  one row per activity: totals, fastest splits, zone times, flags
* ``splits``      ``splits.lapDTOs[]`` and ``typed_splits.splits[]`` (numbers as text)
* ``details``     ``metricDescriptors[]``, ``activityDetailMetrics[].metrics[]`` (positions
  as the descriptors say, nulls inside) and ``geoPolylineDTO.polyline[]``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.columns import ordered_array, round_half_up, round_to_long, safe_divide, safe_get
from tessera.functions.nested import zip_descriptors
from tessera.operators.records import enrich_all
from tessera.operators.relational import first_per_bucket
from tessera.sources.tables import Tables

# Fixed values of the model: the running types, and the names of typed intervals
RUNNING = ("running", "trail_running", "track_running", "treadmill_running")
INTERVAL_NAMES = {
    "INTERVAL_WARMUP": "Échauffement", "INTERVAL_WORK": "Effort", "INTERVAL_RECOVERY": "Récupération",
    "INTERVAL_COOLDOWN": "Retour au calme", "INTERVAL_REST": "Repos",
}
FASTEST = (1000, 1609, 5000, 10000, 21098, 42195)
ZONES = (1, 2, 3, 4, 5)
MAX_POINTS = 80
# Fixed values of the re-aim: activity type by nation, split type by line number, zone bounds, descriptor positions
TYPES = (*RUNNING, "cycling")
SPLIT_TYPES = ("INTERVAL_WARMUP", "INTERVAL_WORK", "INTERVAL_RECOVERY", "INTERVAL_COOLDOWN", "INTERVAL_REST", "INTERVAL",
               "RWD_RUN")
HR_BOUNDS, POWER_BOUNDS = (105, 115, 125, 135), (10, 20, 30, 40)
METRICS = ("directSpeed", "directTimestamp", "directHeartRate", "sumDistance", "directElevation")


# ---- the model over payload frames ------------------------------------------------


def _sorted(arr: Column, by) -> Column:
    """An array by a key of its elements, null keys first."""
    keyed = F.transform(arr, lambda x, i: F.struct(by(x).alias("k"), i.alias("i"), x.alias("v")))
    return F.transform(F.array_sort(keyed), lambda x: x["v"])  # structs sort by key, null first, then place


LAP_FIELDS = ("lapIndex", "startTimeGMT", "distance", "duration", "averageSpeed", "calories", "averageHR", "maxHR",
              "elevationGain", "elevationLoss")


def kilometer_laps(laps: Column) -> Column:
    """The ten lap fields, by lap index."""
    return F.transform(_sorted(laps, lambda x: x["lapIndex"]), lambda x: F.struct(*[x[f].alias(f) for f in LAP_FIELDS]))


def training_intervals(splits: Column) -> Column:
    """Typed splits whose type begins with INTERVAL: typed numbers, intensity and name, by their first lap index."""

    def one(x: Column) -> Column:
        number = lambda f, t="double": x[f].cast(t).alias(f)
        plain = F.replace(F.replace(x["type"], F.lit("INTERVAL_"), F.lit("")), F.lit("INTERVAL"), F.lit("work"))
        name = x["type"]
        for kind, text in INTERVAL_NAMES.items():
            name = F.when(x["type"] == kind, text).otherwise(name)
        return F.struct(
            safe_get(x["lapIndexes"], 0).alias("lapIndex"), x["startTimeGMT"].alias("startTimeGMT"),
            number("distance"), number("duration"), number("averageSpeed"), number("calories", "bigint"),
            number("averageHR"), number("maxHR"), number("elevationGain"), number("elevationLoss"),
            F.lower(plain).alias("intensityType"), name.alias("name"))

    kept = F.filter(splits, lambda x: x["type"].startswith("INTERVAL"))
    return F.transform(_sorted(kept, lambda x: safe_get(x["lapIndexes"], 0)), one)


def time_series(vectors: Column, descriptors: Column) -> Column:
    """Metric vectors zipped with their descriptors (N08, N09), as typed readings in time order."""
    maps = zip_descriptors(F.transform(vectors, lambda v: v["metrics"]), descriptors)

    def one(m: Column) -> Column:
        get = lambda k: F.try_element_at(m, F.lit(k))
        speed = get("directSpeed")
        return F.struct(
            get("directTimestamp").cast("bigint").alias("timestamp"),
            round_half_up(get("sumDistance") / 1000, 4).alias("distance"),
            round_to_long(get("directHeartRate")).alias("heartRate"),
            round_half_up(safe_divide(F.lit(1000.0), speed) / 60, 4).alias("pace"),
            round_half_up(get("directElevation"), 1).alias("altitude"),
            round_half_up(speed * 3.6, 2).alias("speed"))

    return _sorted(F.transform(maps, one), lambda x: x["timestamp"])


def polyline(points: Column) -> Column:
    """Raw GPS points in time order."""
    return F.transform(_sorted(points, lambda p: p["time"]),
                       lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"), p["time"].alias("time")))


def hub_activities(activities: DataFrame, splits: DataFrame, details: DataFrame) -> DataFrame:
    """Running activities with fastest splits, zones, laps, typed intervals, time series and polyline.

    Each payload has one row per ``activityId`` (keep-latest staging), so its arrays are built inside its row and all
    three frames meet in one shuffle on the id.  A missing payload leaves its arrays null.
    """
    runs = activities.filter(F.col("activityType.typeKey").isin(list(RUNNING)))
    laps = splits.select(
        "activityId", kilometer_laps(F.col("splits.lapDTOs")).alias("kilometer_laps"),
        training_intervals(F.col("typed_splits.splits")).alias("training_intervals"))
    detail = F.col("detailed_data")
    series = details.select(
        "activityId", time_series(detail["activityDetailMetrics"], detail["metricDescriptors"]).alias("time_series"),
        polyline(detail["geoPolylineDTO"]["polyline"]).alias("polyline"))
    joined = enrich_all(runs, {"_s": laps, "_d": series}, "activityId")
    return joined.select(
        "activityId", "activityName", "startTimeGMT", "endTimeGMT", F.col("activityType.typeKey").alias("typeKey"),
        "distance", "duration", "elapsedDuration", "elevationGain", "elevationLoss", "averageSpeed", "hasPolyline",
        "calories", "averageHR", "maxHR", "aerobicTrainingEffect", "anaerobicTrainingEffect", "minElevation",
        "maxElevation", "activityTrainingLoad",
        F.struct(*[f"fastestSplit_{d}" for d in FASTEST]).alias("fastestSplits"),
        F.struct(*[f"hrTimeInZone_{z}" for z in ZONES]).alias("hr_zones"),
        F.struct(*[f"powerTimeInZone_{z}" for z in ZONES]).alias("power_zones"),
        F.col("_s.kilometer_laps").alias("kilometer_laps"), F.col("_s.training_intervals").alias("training_intervals"),
        F.col("_d.time_series").alias("time_series"), F.col("_d.polyline").alias("polyline"), "_dp_inserted_at")


def thinned(points: Column, most: int = MAX_POINTS) -> Column:
    """Every ``ceil(n / most)``-th point of an array in order (all of them up to ``most``), by index inside the row."""
    def thin(ps: Column) -> Column:
        step = F.ceil(F.size(ps) / F.lit(float(most)))
        return F.filter(ps, lambda p, i: (F.size(ps) <= most) | (F.pmod(i, step) == 0))

    # the filter reads its array for every element: bound to a variable, the array is built once
    return F.get(F.transform(F.array(points), thin), F.lit(0))


def activity_cards(activities: DataFrame, details: DataFrame) -> DataFrame:
    """Every activity with km, minutes, zone shares of its own zone time and its thinned track as JSON."""
    acts = activities.filter(F.col("activityId").isNotNull())
    track = details.select(
        "activityId", F.transform(thinned(polyline(F.col("detailed_data.geoPolylineDTO.polyline"))),
                                  lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lng"))).alias("points"))
    total = sum((F.coalesce(F.col(f"hrTimeInZone_{z}"), F.lit(0.0)) for z in ZONES), F.lit(0.0))
    share = lambda z: round_to_long(F.col(f"hrTimeInZone_{z}") / F.nullif(total, F.lit(0.0)) * 100)
    return enrich_all(acts, {"_t": track}, "activityId").select(
        "activityId", "activityName", "startTimeGMT", F.col("activityType.typeKey").alias("typeKey"),
        round_half_up(F.col("distance") / 1000, 1).alias("distance_km"),
        round_half_up(F.col("duration") / 60, 1).alias("duration_minutes"),
        round_to_long("averageHR").alias("averageHR"),
        *[share(z).alias(f"hrZone{z}_pct") for z in ZONES],
        F.when(F.col("hasPolyline") & (F.size("_t.points") > 0), F.to_json("_t.points")).alias("polyline_simplified"))


# ---- payload frames derived from the tables ---------------------------------------


def _readings(spark: SparkSession, d: str) -> DataFrame:
    """One reading per (activity, day): line count, quantity, smallest order and part."""
    lines = Tables(spark, d).lineitem
    return lines.groupBy(F.col("l_suppkey").alias("activityId"), F.col("l_shipdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"), F.min("l_orderkey").alias("k"))


def _millis(day: Column) -> Column:
    return F.unix_millis(day.cast("timestamp"))


def _heart_rate() -> Column:
    return F.when(F.col("k") % 9 != 0, F.lit(90) + F.col("n") * 7 + F.col("k") % 40)


def _zone(value: Column, bounds: tuple[int, ...], z: int) -> Column:
    low, high = (None, *bounds)[z - 1], (*bounds, None)[z - 1]
    inside = F.lit(True) if low is None else value >= low
    return value.isNotNull() & inside & (F.lit(True) if high is None else value < high)


def activity_payload(spark: SparkSession, d: str) -> DataFrame:
    """``activities``: one row per supplier, totals over its readings, zone times of the readings' values."""
    r = _readings(spark, d)
    hr, power = _heart_rate(), F.col("qty") / F.col("n")
    minutes = lambda inside: F.sum(F.when(inside, F.lit(60.0)))
    totals = r.groupBy("activityId").agg(
        F.sum("qty").alias("_qty"), F.sum("n").alias("_n"), F.min("day").alias("startTimeGMT"), F.max("day").alias("_last"),
        F.max("qty").alias("_best"), F.min("k").alias("_k"), F.max(hr).alias("maxHR"), F.sum(hr).alias("_hr"),
        F.count(hr).alias("_hr_n"),
        *[minutes(_zone(hr, HR_BOUNDS, z)).alias(f"hrTimeInZone_{z}") for z in ZONES],
        *[minutes(_zone(power, POWER_BOUNDS, z)).alias(f"powerTimeInZone_{z}") for z in ZONES])
    s = Tables(spark, d).supplier.join(totals, F.col("s_suppkey") == F.col("activityId"))
    distance = F.col("_qty") * 10
    return s.select(
        "activityId", F.concat(F.lit("Activity "), "s_name").alias("activityName"), "startTimeGMT",
        (F.col("_last") + F.expr("INTERVAL 1 HOUR")).alias("endTimeGMT"),
        F.struct(F.element_at(F.array(*[F.lit(t) for t in TYPES]), F.col("s_nationkey") % len(TYPES) + 1).alias("typeKey"))
        .alias("activityType"),
        distance.alias("distance"), (F.col("_n") * 60.0).alias("duration"), (F.col("_n") * 61.0).alias("elapsedDuration"),
        (F.col("_k") % 100).cast("double").alias("elevationGain"), (F.col("_k") % 90).cast("double").alias("elevationLoss"),
        (distance / (F.col("_n") * 60.0)).alias("averageSpeed"),
        F.when(F.col("activityId") % 13 != 5, F.col("activityId") % 6 != 1).alias("hasPolyline"),
        F.col("_n").alias("calories"), (F.col("_hr") / F.nullif(F.col("_hr_n"), F.lit(0))).alias("averageHR"), "maxHR",
        ((F.col("_k") % 50) / 10).alias("aerobicTrainingEffect"), ((F.col("_k") % 30) / 10).alias("anaerobicTrainingEffect"),
        (F.col("_k") % 10).alias("minElevation"), (F.col("_k") % 10 + 200).alias("maxElevation"),
        F.col("s_acctbal").alias("activityTrainingLoad"),
        *[F.when(distance >= m, F.lit(float(m)) / F.col("_best")).alias(f"fastestSplit_{m}") for m in FASTEST],
        *[f"hrTimeInZone_{z}" for z in ZONES], *[f"powerTimeInZone_{z}" for z in ZONES],
        F.col("_last").alias("_dp_inserted_at"))


def splits_payload(spark: SparkSession, d: str) -> DataFrame:
    """``splits``: a lap per year, a typed split per line number; suppliers with ``key % 7 = 3`` deliver none."""
    lines = Tables(spark, d).lineitem.filter(F.col("l_suppkey") % 7 != 3)
    measures = [
        F.min("l_shipdate").alias("first"), F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n"),
        F.sum("l_linenumber").alias("lines"), F.count_if(F.col("l_returnflag") == "A").alias("up"),
        F.count_if(F.col("l_returnflag") == "R").alias("down")]

    def values(kind: str) -> list[Column]:
        number = {
            "distance": F.col("qty") * 10, "duration": F.col("n") * 60.0,
            "averageSpeed": F.col("qty") * 10 / (F.col("n") * 60.0), "calories": F.col("lines"),
            "averageHR": (F.lit(100) + F.col("n") % 60).cast("double"), "maxHR": (F.lit(110) + F.col("n") % 60).cast("double"),
            "elevationGain": F.col("up").cast("double"), "elevationLoss": F.col("down").cast("double")}
        return [F.date_format("first", "yyyy-MM-dd HH:mm:ss").alias("startTimeGMT"),
                *[(c.cast("string") if kind == "text" else c).alias(f) for f, c in number.items()]]

    by = lambda key: lines.groupBy(F.col("l_suppkey").alias("activityId"), key.alias("key")).agg(*measures)
    laps = by(F.year("l_shipdate")).groupBy("activityId").agg(F.collect_list(F.struct(
        (F.col("key") - 1994).alias("lapIndex"), *values("number"))).alias("lapDTOs"))
    kind = F.element_at(F.array(*[F.lit(t) for t in SPLIT_TYPES]), F.col("key"))
    index = F.when(kind == "INTERVAL", F.array().cast("array<int>")).otherwise(F.array(8 - F.col("key"), F.col("key") + 10))
    typed = by(F.col("l_linenumber")).groupBy("activityId").agg(F.collect_list(F.struct(
        kind.alias("type"), index.alias("lapIndexes"), *values("text"))).alias("splits"))
    return laps.join(typed, "activityId").select(
        "activityId", F.struct("lapDTOs").alias("splits"), F.struct(F.col("splits").alias("splits")).alias("typed_splits"))


def details_payload(spark: SparkSession, d: str) -> DataFrame:
    """``details``: a metric vector and a GPS point per day; suppliers with ``key % 5 = 2`` deliver none."""
    so_far = Window.partitionBy("activityId").orderBy("day")  # at most one row per day
    r = _readings(spark, d).filter(F.col("activityId") % 5 != 2).withColumn("total", F.sum("qty").over(so_far))
    value = {
        "directSpeed": F.when(F.col("k") % 13 == 0, F.lit(0.0)).when(F.col("k") % 11 != 0, F.col("qty") / 8),
        "directTimestamp": _millis(F.col("day")), "directHeartRate": _heart_rate(), "sumDistance": F.col("total") * 10,
        "directElevation": (F.col("k") % 5000) / 7}
    vector = F.struct(F.array(*[value[m].cast("double") for m in METRICS]).alias("metrics"))
    # the latest first: the model has to order them
    metrics = r.groupBy("activityId").agg(F.reverse(ordered_array(vector, "day")).alias("activityDetailMetrics"))
    lines = Tables(spark, d).lineitem.filter(F.col("l_suppkey") % 5 != 2)
    first = first_per_bucket(lines, ["l_suppkey", "l_shipdate"], ["l_orderkey", "l_linenumber", "l_partkey"])
    point = F.struct(
        ((F.lit(480000) + F.col("l_orderkey") % 10000) / F.lit(10000.0)).alias("lat"),
        ((F.lit(20000) + F.col("l_partkey") % 10000) / F.lit(10000.0)).alias("lon"), _millis(F.col("l_shipdate")).alias("time"))
    points = first.groupBy(F.col("l_suppkey").alias("activityId")).agg(
        F.reverse(ordered_array(point, "l_shipdate")).alias("polyline"))
    descriptors = F.array(*[F.struct(F.lit(m).alias("key"), F.lit(i).alias("metricsIndex")) for i, m in enumerate(METRICS)])
    return metrics.join(points, "activityId").select("activityId", F.struct(
        descriptors.alias("metricDescriptors"), "activityDetailMetrics",
        F.struct("polyline").alias("geoPolylineDTO")).alias("detailed_data"))


# ---- registered queries -----------------------------------------------------------


def hub(spark: SparkSession, d: str) -> DataFrame:
    """H07 over the derived payloads."""
    return hub_activities(activity_payload(spark, d), splits_payload(spark, d), details_payload(spark, d))


def hub_activity_rows(spark: SparkSession, d: str) -> DataFrame:
    """One row per running activity, structs flattened, arrays by their size (null without a payload)."""
    h = hub(spark, d)
    arrays = ("kilometer_laps", "training_intervals", "time_series", "polyline")
    plain = [c for c in h.columns if c not in (*arrays, "fastestSplits", "hr_zones", "power_zones")]
    return h.select(
        *plain, "fastestSplits.*", "hr_zones.*", "power_zones.*",
        *[F.when(F.col(a).isNotNull(), F.size(a)).alias(f"n_{a}") for a in arrays])


def elements(activities: DataFrame) -> DataFrame:
    """Every element of the four arrays of every activity, at its place."""

    def element(part: str, started: Column, kind: Column, *values: Column):
        filled = [*values, *[F.lit(None)] * (9 - len(values))]
        return [F.lit(part).alias("part"), started.cast("string").alias("started"), kind.cast("string").alias("kind"),
                *[v.cast("double").alias(f"v{i}") for i, v in enumerate(filled, 1)]]

    none, numbers = F.lit(None), [f for f in LAP_FIELDS if f != "startTimeGMT"]

    def placed(arr: str, build) -> Column:
        return F.coalesce(F.transform(F.col(arr), lambda x, i: F.struct((i + 1).alias("place"), *build(x))), F.array())

    parts = F.concat(
        placed("kilometer_laps", lambda x: element("lap", x["startTimeGMT"], none, *[x[f] for f in numbers])),
        placed("training_intervals", lambda x: element(
            "interval", x["startTimeGMT"], F.concat_ws("|", x["intensityType"], x["name"]), *[x[f] for f in numbers])),
        placed("time_series", lambda x: element(
            "reading", none, none, *[x[f] for f in ("timestamp", "distance", "heartRate", "pace", "altitude", "speed")])),
        placed("polyline", lambda x: element("point", none, none, x["lat"], x["lon"], x["time"])))
    return activities.select("activityId", F.explode(parts).alias("e")).select("activityId", "e.*")


def hub_activity_elements(spark: SparkSession, d: str) -> DataFrame:
    """Every element of the four arrays of every running activity."""
    return elements(hub(spark, d))


def activity_card_rows(spark: SparkSession, d: str) -> DataFrame:
    """P03 / R07 over all activities, running or not."""
    return activity_cards(activity_payload(spark, d), details_payload(spark, d))


def activity_children(spark: SparkSession, d: str) -> DataFrame:
    """Activities with three child payloads at once (splits, details, zones), each missing for some."""
    acts = activity_payload(spark, d)
    zones = acts.filter(F.col("activityId") % 11 != 4).select("activityId", *[f"hrTimeInZone_{z}" for z in ZONES])
    whole = enrich_all(acts.select("activityId", "activityName"), {
        "splits": splits_payload(spark, d), "details": details_payload(spark, d), "zones": zones}, "activityId")
    return whole.select(
        "activityId", "activityName", F.col("splits").isNotNull().alias("has_splits"),
        F.col("details").isNotNull().alias("has_details"), F.col("zones").isNotNull().alias("has_zones"),
        F.array_max(F.transform("splits.splits.lapDTOs", lambda x: x["distance"])).alias("longest_lap"),
        F.when(F.col("splits").isNotNull(), F.size("splits.typed_splits.splits")).alias("n_splits"),
        F.when(F.col("details").isNotNull(), F.size("details.detailed_data.activityDetailMetrics")).alias("n_readings"),
        F.col("zones.hrTimeInZone_3").alias("zone3_seconds"))


QUERIES = {
    "hub_activity_rows": hub_activity_rows,
    "hub_activity_elements": hub_activity_elements,
    "activity_cards": activity_card_rows,
    "activity_children": activity_children,
}
