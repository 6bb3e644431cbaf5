import json

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources import jsonl as J
from tessera.sources import schema as S


def _write(dirpath, name, lines):
    p = dirpath / name
    p.write_text("\n".join(lines) + "\n")
    return p


def test_scan_route_and_parse(spark, tmp_path):
    land = tmp_path / "landing"
    (land / "sub").mkdir(parents=True)
    _write(land, "2024_01_02_03_04_spotify_recently_played.jsonl",
           ['{"id": 1, "name": "a"}', '{bad json', '', '[1, 2]', '{"id": 2, "name": "b"}'])
    _write(land / "sub", "2024_01_02_03_05_garmin_sleep.jsonl", ['{"id": 3}'])
    _write(land, "notes.txt", ["ignored"])
    lines = J.scan_jsonl(spark, str(land))
    assert lines.count() == 6
    routed = J.route_by_regex(J.file_name_parts(lines), {"plays": r"recently_played", "sleep": r"_sleep\."})
    got = {(r.file_name, r.dataset, r.service, r.data_type) for r in routed.select(
        "file_name", "dataset", "service", "data_type").distinct().collect()}
    assert ("2024_01_02_03_05_garmin_sleep.jsonl", "sleep", "garmin", "sleep") in got
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    good, bad = J.parse_lines(lines, schema)
    assert sorted(r.id for r in good.collect()) == [1, 2, 3]
    assert sorted(r.raw_line for r in bad.collect()) == ["[1, 2]", "{bad json"]
    assert J.files_without_valid_records(
        lines, F.ltrim("value").startswith("{") & F.try_parse_json("value").isNotNull()).count() == 0


def test_keyword_route_and_user_tokens(spark):
    df = spark.createDataFrame([("x_chess_alice_games.jsonl",), ("x_chess_bob.jsonl",), ("other.jsonl",)], "file_name string")
    out = J.user_and_type_from_name(df, "chess", ["games", "stats"]).collect()
    assert [(r.username, r.data_type) for r in out] == [("alice", "games"), ("bob", "unknown"), ("unknown", "unknown")]
    kw = J.route_by_keyword(df, [("games", "chess_games"), ("chess", "chess_other")])
    assert [r.dataset for r in kw.collect()] == ["chess_games", "chess_other", "unknown"]


def test_schema_evolution_rows(spark):
    rows = ['{"id": 1, "common": "x"}', '{"id": 2, "common": "y"}', '{"id": 3, "common": "z", "late_field": "l"}',
            '{"id": 4, "common": "w", "nested": {"a": 1}}', '{"id": 5, "common": "v", "nested": {"b": 2}}']
    df = spark.createDataFrame([(r,) for r in rows], "value string").repartition(3)
    got = S.infer_schema(df)
    assert got.simpleString() == (
        "struct<common:string,id:bigint,late_field:string,nested:struct<a:bigint,b:bigint>>")


def test_schema_clashes_inside_lists_and_records(spark):
    rows = ['{"l": [1, "x"], "m": [[1, 2], [3, 4.5]], "o": [{"k": 1}, {"k": {"z": true}}], "odd \'key": 1}',
            '{"l": [{"q": 1}], "m": [], "o": null, "big": 12345678901234567890}', "[1]", "{bad", ""]
    got = S.infer_schema(spark.createDataFrame([(r,) for r in rows], "value string"))
    assert got.simpleString() == (
        "struct<big:double,l:array<struct<q:bigint>>,m:array<array<double>>,"
        "o:array<struct<k:struct<z:boolean>>>,odd 'key:bigint>")
    assert S.infer_schema(spark.createDataFrame([("[]",)], "value string")) == T.StructType([])


def test_promotion_rules(spark):
    rows = ['{"n": 1, "s": {"a": 1}, "l": [], "z": null, "b": true}',
            '{"n": 1.5, "s": "text", "l": [{"k": 1}], "z": null, "b": 3}']
    df = spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1)
    got = S.infer_schema(df)
    assert got["n"].dataType == T.DoubleType()
    assert isinstance(got["s"].dataType, T.StructType)
    assert got["l"].dataType == T.ArrayType(T.StructType([T.StructField("k", T.LongType())]))
    assert "z" not in got.fieldNames()
    assert got["b"].dataType == T.StringType()
    # struct wins: the scalar value becomes null when parsed with the promoted schema
    good, _ = J.parse_lines(df, got)
    assert [r.s for r in good.orderBy("n").collect()][1] is None


def test_merge_schema_and_align(spark):
    a = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.StringType())])
    b = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("z", T.BooleanType())])
    m = S.merge_schema(a, b)
    assert m.simpleString() == "struct<x:double,y:string,z:boolean>"
    df = spark.createDataFrame([(1, "q", "extra")], "x long, y string, w string")
    assert S.align_to(df, m).columns == ["x", "y", "z"]


def test_schema_from_config():
    s = S.schema_from_config([
        {"name": "playedAt", "type": "TIMESTAMP", "mode": "REQUIRED"},
        {"name": "artists", "type": "RECORD", "mode": "REPEATED",
         "fields": [{"name": "artistId", "type": "STRING"}]},
    ])
    assert s.simpleString() == "struct<playedAt:timestamp,artists:array<struct<artistId:string>>>"
    assert not s["playedAt"].nullable


PLAY = {
    "played_at": "2024-05-01T10:00:00.123Z",
    "context": {"type": "playlist", "uri": "u"},
    "devices": {"phone": {"deviceId": "d1"}, "tv": {"deviceId": "d2"}},
    "track": {"id": "t1", "name": "Song", "duration_ms": 200000, "popularity": 55, "explicit": False,
              "album": {"id": "al1", "release_date": "1999-07", "images": [{"url": "big", "height": 640}]},
              "artists": [{"id": "ar1", "name": "A"}, {"id": "ar2", "name": "B"}]},
    "series": [[1704067200000, 5], [1704067260000, 6]],
}

SPECS = [J.FieldSpec.from_dict(d) for d in [
    {"name": "playedAt", "json_path": "$.played_at", "type": "TIMESTAMP", "transform": "string_to_timestamp_iso",
     "validations": {"not_null": True}},
    {"name": "trackId", "json_path": "$.track.id"},
    {"name": "trackDurationMs", "json_path": "$.track.duration_ms", "type": "INTEGER",
     "validations": {"min": 0, "max": 7200000}},
    {"name": "trackExplicit", "json_path": "$.track.explicit", "type": "BOOLEAN"},
    {"name": "albumReleaseDate", "json_path": "$.track.album.release_date", "type": "DATE",
     "transform": "string_to_date_flexible"},
    {"name": "firstDevice", "json_path": "$.devices.*.deviceId"},
    {"name": "missing", "json_path": "$.nope.deeper", "type": "INTEGER"},
    {"name": "context", "type": "RECORD", "json_path": "$.context",
     "fields": [{"name": "type", "json_path": "$.type"}, {"name": "uri", "json_path": "$.uri"}]},
    {"name": "artists", "type": "RECORD", "mode": "REPEATED", "json_path": "$.track.artists",
     "fields": [{"name": "artistId", "json_path": "$.id"}, {"name": "artistName", "json_path": "$.name"}]},
    {"name": "series", "type": "RECORD", "mode": "REPEATED", "json_path": "$.series",
     "fields": [{"name": "ts", "type": "TIMESTAMP", "array_index": 0, "transform": "timestamp_ms_to_timestamp"},
                {"name": "v", "type": "INTEGER", "array_index": 1}]},
]]


def test_config_extraction(spark):
    df = spark.createDataFrame([(json.dumps(PLAY), "f.jsonl")], "value string, source_file string")
    r = J.extract_fields(df, SPECS).first()
    assert str(r.playedAt) == "2024-05-01 10:00:00.123000"
    assert (r.trackId, r.trackDurationMs, r.trackExplicit) == ("t1", 200000, False)
    assert str(r.albumReleaseDate) == "1999-07-01"
    assert r.firstDevice == "d1" and r.missing is None
    assert (r.context.type, r.context.uri) == ("playlist", "u")
    assert [(a.artistId, a.artistName) for a in r.artists] == [("ar1", "A"), ("ar2", "B")]
    assert [(str(s.ts), s.v) for s in r.series] == [("2024-01-01 00:00:00", 5), ("2024-01-01 00:01:00", 6)]
    assert json.loads(r.raw_data)["track"]["id"] == "t1"


def test_ingest_job_archives_after_commit(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    ok = dict(PLAY)
    bad_rule = dict(PLAY, track=dict(PLAY["track"], duration_ms=99999999))
    _write(land, "2024_05_01_10_00_spotify_recently_played.jsonl", [json.dumps(ok), json.dumps(bad_rule), "{oops"])
    _write(land, "2024_05_01_11_00_spotify_recently_played.jsonl", ["{nothing valid"])
    target = str(tmp_path / "table")
    res = J.ingest(spark, str(land), SPECS, target, mode="strict", quarantine=str(tmp_path / "q"),
                   archive_dir=str(tmp_path / "archive"), rejected_dir=str(tmp_path / "rejected"),
                   partition_col="playedAt")
    assert res.files == 2 and res.records_read == 2 and res.records_rejected == 1 and res.bad_lines == 2
    assert len(res.rejected_files) == 1 and len(res.archived) == 1
    assert spark.read.parquet(target).count() == 1
    assert spark.read.parquet(str(tmp_path / "q")).count() == 1
    assert sorted(p.name for p in (tmp_path / "archive").iterdir()) == ["2024_05_01_10_00_spotify_recently_played.jsonl"]
    assert list(land.iterdir()) == []


def test_dry_run_writes_nothing(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    _write(land, "a.jsonl", [json.dumps(PLAY)])
    res = J.ingest(spark, str(land), SPECS, str(tmp_path / "t"), dry_run=True)
    assert res.records_read == 1 and not (tmp_path / "t").exists() and (land / "a.jsonl").exists()


def test_raw_envelope(spark):
    df = spark.createDataFrame([('{"a": 1}', "f1"), ("{bad", "f1")], "value string, source_file string")
    out = J.raw_envelope(df, "games", extra={"username": F.lit("alice")}).collect()
    assert len(out) == 1 and out[0].raw_data == '{"a": 1}' and out[0].data_type == "games"
    assert out[0].username == "alice" and out[0]._dp_inserted_at is not None


def test_retransform_legacy_and_select(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    _write(raw, "a.jsonl", ['{"date": "2024-01-01", "stressValuesArray": [[1, 20], [2, 30]]}'])
    n = J.retransform_legacy(spark, str(raw), str(tmp_path / "out"))
    assert n == 2
    out = spark.read.json(str(tmp_path / "out")).first()
    assert [(x.timestamp, x.value) for x in out.stressValuesArray] == [(1, 20), (2, 30)]
    routed = spark.createDataFrame([("a", "u1"), ("b", "u2")], "dataset string, username string")
    assert J.select_datasets(routed, ["b"]).count() == 1
    assert J.select_datasets(routed, owner="u1").first().dataset == "a"
    assert J.select_datasets(routed).count() == 2


def test_list_form_rules_and_bq_type():
    spec = J.FieldSpec.from_dict({
        "name": "ms", "json_path": "$.ms", "bq_type": "INT64", "max_length": 9,
        "validations": [{"type": "not_null"}, {"type": "range", "min": 0, "max": 7200000}]})
    assert spec.type == "INT64"
    assert spec.validations == {"not_null": True, "min": 0, "max": 7200000, "max_length": 9}
    with pytest.raises(ValueError):
        J.FieldSpec.from_dict({"name": "x", "validations": [{"type": "unheard"}]})


def test_files_of_one_name_are_archived_apart(spark, tmp_path):
    land = tmp_path / "land"
    for sub, n in (("a", 1), ("b", 2)):
        (land / sub).mkdir(parents=True)
        _write(land / sub, "same.jsonl", [json.dumps({"id": n})])
    specs = [J.FieldSpec.from_dict({"name": "id", "json_path": "$.id", "type": "INTEGER"})]
    res = J.ingest(spark, str(land), specs, str(tmp_path / "t"), archive_dir=str(tmp_path / "arch"))
    assert len(res.archived) == 2 and not list(land.rglob("*.jsonl"))
    assert sorted(str(p.relative_to(tmp_path / "arch")) for p in (tmp_path / "arch").rglob("*.jsonl")) == [
        "a/same.jsonl", "b/same.jsonl"]


def test_wide_arrays_keep_all_values(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    _write(raw, "a.jsonl", ['{"p": [[1, 2]], "w": [[1, 2, 3], [4, 5, 6, 7]], "in": [{"q": [[1, 2, 3]]}]}'])
    J.retransform_legacy(spark, str(raw), str(tmp_path / "out"))
    r = spark.read.json(str(tmp_path / "out")).first()
    assert [(x.timestamp, x.value) for x in r.p] == [(1, 2)]
    assert [(x.val_0, x.val_1, x.val_2, x.val_3) for x in r.w] == [(1, 2, 3, None), (4, 5, 6, 7)]
    assert r["in"][0].q[0].val_2 == 3
