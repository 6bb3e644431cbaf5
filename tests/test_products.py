import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.plans import activities, enrichment, health, music, reads
from tessera.plans.star import EVENTS_AS_OF, LINEITEM_AS_OF, star_from_events, star_from_tables

SF = "/root/testdata/sf0.001"


def test_homepage_bundle_one_row(spark):
    b = health.homepage_bundle(spark, SF, EVENTS_AS_OF)
    rows = b.collect()
    assert len(rows) == 1 and len(rows[0].music_time_daily) == 11 and len(rows[0].running_weekly_volume) == 7


def test_artist_documents(spark, tmp_path):
    docs = music.artist_documents(star_from_events(spark, SF), "2024-01-30")
    first = docs.orderBy("artist_id").first()
    assert first.overview and first.calendar == sorted(first.calendar, key=lambda r: r.listen_date)
    assert docs.count() == docs.select("artist_id").distinct().count()


def test_reads(spark):
    star = star_from_tables(spark, SF)
    r = reads.music_rankings(star, LINEITEM_AS_OF, "last_365_days", 5)
    assert r["tracks"].count() == 5 and r["artists"].count() == 5
    try:
        reads.top_tracks(star, LINEITEM_AS_OF, "forever")
        raise AssertionError
    except ValueError:
        pass
    prof = reads.artist_profile(star_from_events(spark, SF), "2024-01-30", 0)
    assert set(prof) == {"overview", "tracks", "albums", "calendar", "heatmap", "evolution"}
    assert prof["overview"].count() <= 1


def test_activity_reads(spark):
    lst = activities.activities_list(spark, SF)
    assert lst.count() == activities.activities(spark, SF).count()
    one = lst.select("activity_id").first().activity_id
    det = activities.activity_detail(spark, SF, one)
    assert det["activity"].count() == 1 and det["points"].count() > 0
    act = det["activity"].first()
    assert all(p.user_id == act.user_id and act.start_ts <= p.ts <= act.end_ts for p in det["points"].collect())


def test_limits_outside_their_range_are_refused(spark):
    star = star_from_tables(spark, SF)
    for bad in (0, reads.MAX_RANK_LIMIT + 1):
        with pytest.raises(ValueError):
            reads.top_artists(star, "2001-11-05", "all_time", bad)
    with pytest.raises(ValueError):
        reads.search_artists(star, "x", reads.MAX_SEARCH_LIMIT + 1)


def test_log_by_time_of_day_and_empty_pages(spark):
    star = star_from_events(spark, SF)
    got = reads.recently_played(star, size=200, time_from="10:00", time_to="11:00")
    assert all("10:00" <= r.played_time <= "11:00" for r in got["rows"].collect()) and got["rows"].count() > 0
    none = reads.recently_played(star, artist="nobody at all")
    assert (none["total"].first().total, none["total"].first().pages) == (0, 1) and none["artists"].count() > 0


def test_albums_lacking_enrichment(spark):
    star = star_from_tables(spark, SF)
    album_enrich = star.albums.filter(F.col("album_id") != "Brand#1").select("album_id")
    out = enrichment.albums_lacking_enrichment(star.fact, star.tracks, album_enrich).collect()
    assert [r.album_id for r in out] == ["Brand#1"]
    recent = enrichment.albums_lacking_enrichment(star.fact, star.tracks, album_enrich, since=dt.datetime(2100, 1, 1))
    assert recent.count() == 0
