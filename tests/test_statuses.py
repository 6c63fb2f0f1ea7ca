import json

import pytest
from pyspark.sql import functions as F

from postlens import schemas
from postlens.functions.records import created_epoch, flag
from postlens.operators import statuses as s
from postlens.plans.status_analytics import run_statuses
from postlens.session import scratch_path
from postlens.sources import readers, sinks


def status(number, name, lang="en", followers=1, tags=(), **extra):
    user = {"screen_name": name, "followers_count": followers, "friends_count": 2, "statuses_count": 3, "lang": lang}
    user.update({k: extra.pop(k) for k in ("location", "time_zone") if k in extra})
    entities = {"hashtags": [{"text": t} for t in tags], "user_mentions": [], "urls": [{"expanded_url": "http://a"}]}
    entities.update(extra.pop("entities", {}))
    record = {"id": number, "created_at": "Mon Feb 17 14:14:44 +0000 2014", "lang": lang, "text": "own", "user": user, "entities": entities}
    return json.dumps({**record, **extra})


LINES = [
    status(1, "ann", followers=5, tags=["Irma", "Storm"], location="here", time_zone="UTC"),
    status(2, "ann", followers=5, tags=["Irma"], time_zone="CET"),
    status(3, "ann", followers=7),
    status(4, "bob", followers=9, retweeted_status={"text": "original"}, entities={"media": [{"media_url": "m"}]}),
    status(5, "cid", lang="fr", tags=["Irma"]),
    status(6, "dan", created_at="no date"),
    status(7, "dan", created_at="Tue Feb 4 01:02:03 +0100 2014"),
    '{"id": 8, "lang": "en", "user"',
    "",
]


@pytest.fixture(scope="module")
def raw(spark):
    path = scratch_path(spark, "raw")
    spark.createDataFrame([(line,) for line in LINES], "value STRING").write.text(path)
    return path


@pytest.fixture(scope="module")
def good(spark, raw):
    return readers.read_statuses(spark, raw).filter(F.col(schemas.CORRUPT).isNull())


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_malformed_lines_are_marked(spark, raw):
    lines = readers.read_lines(spark, raw)
    parsed = readers.parse_statuses(lines, schemas.STATUS)
    assert parsed.filter("is_bad").count() == 2
    assert parsed.filter("NOT is_bad").select("parsed.user.screen_name").count() == 7


def test_groups_are_ranked_by_rows_not_by_value(good):
    english = s.in_language(good)
    assert rows(s.user_counts(english)) == [("ann", 3), ("dan", 2), ("bob", 1)]
    assert rows(s.user_value_groups(english, "followers_count", 2)) == [(1, "dan", 2), (5, "ann", 2)]
    assert rows(s.user_value_leaders(english, "followers_count", 2)) == [("bob", 9), ("ann", 7)]


def test_popular_users_lists_a_user_once_per_value(good):
    assert rows(s.popular_users(s.in_language(good))) == [("bob", 9), ("ann", 7), ("ann", 5), ("dan", 1)]


def test_languages_and_hashtags_read_all_rows(good):
    assert rows(s.user_languages(good)) == [("en", 6), ("fr", 1)]
    assert set(rows(s.hashtag_counts(good))) == {("Irma", 3), ("Storm", 1)}
    assert s.hashtag_arrays(good).count() == 3


def test_locations_and_zones(good):
    english = s.in_language(good)
    assert rows(s.user_locations(english)) == [("ann", "here")]
    assert rows(s.user_time_zones(english))[:3] == [("ann", "UTC"), ("ann", "CET"), ("ann", None)]


def test_flat_records(good):
    flat = {r["id"]: r for r in s.flatten_statuses(good).collect()}
    assert set(flat) == {1, 2, 3, 4, 5, 7}  # the row with a bad date is left out, no date is reused
    assert flat[4]["text"] == "original" and flat[4]["media_urls"] == ["m"] and flat[1]["media_urls"] == []
    assert flat[1]["created_epoch"] == 1392646484 and flat[1]["urls"] == ["http://a"]
    assert flat[7]["created_epoch"] == 1391472123  # the offset counts


@pytest.mark.parametrize("value", [None, "", "Mon", "Mon Feb 30 14:14:44 +0000 2014"])
def test_bad_dates_give_null(spark, value):
    frame = spark.createDataFrame([(value,)], "v STRING")
    assert frame.select(created_epoch(F.col("v")).alias("e")).first()["e"] is None


def test_null_flag_is_false(spark):
    frame = spark.createDataFrame([(1,), (0,), (None,)], "v INT")
    assert [r["f"] for r in frame.select(flag(F.col("v")).alias("f")).collect()] == [True, False, False]


def test_whole_job(spark, raw, good):
    out = scratch_path(spark, "status_job")
    names = run_statuses(good, readers.read_lines(spark, raw), out)
    assert set(names) >= {"user_counts", "popular_users", "devices", "events", "hashtag_lists"}
    assert [r["value"] for r in spark.read.text(f"{out}/user_counts").collect()] == ["(ann,3)", "(dan,2)", "(bob,1)"]
    events = {r["value"] for r in spark.read.text(f"{out}/events").collect()}
    assert "(Irma,3)" in events and "(Hurricane,0)" in events
    assert '["Irma","Storm"]' in {r["value"] for r in spark.read.text(f"{out}/hashtag_lists").collect()}


def test_strict_reader_fails_and_tolerant_reader_goes_on(spark):
    path = scratch_path(spark, "posts")
    lines = ['{"id": "1", "title": "t", "selftext": "b"}', "", '{"id": "2", "title": ']
    spark.createDataFrame([(line,) for line in lines], "value STRING").coalesce(1).write.text(path)
    schema = "id STRING, title STRING, selftext STRING"
    tolerant = readers.read_posts(spark, path, schema)
    assert {(r["id"], r["text"]) for r in tolerant.collect()} >= {("1", "t\nb")}
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        readers.read_posts_strict(spark, path, schema).collect()


def test_annotation_columns_are_matched_by_name(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("x,1", "a", 1, "n/a")], "extra STRING, id STRING, Casualty INT, Damage STRING").write.option("header", True).csv(path)
    row = readers.read_annotations(spark, path).first()
    assert (row["id"], row["Casualty"], row["Damage"], row["Advice"]) == ("a", 1, None, None)


def test_reports_go_to_one_file_and_rows_do_not(spark, tmp_path):
    frame = spark.range(100).repartition(4)
    sinks.write_report(frame, str(tmp_path / "report"))
    sinks.write_rows(frame, str(tmp_path / "rows"))
    sinks.write_rows(frame, str(tmp_path / "rows"), mode="append")
    assert len(list((tmp_path / "report").glob("part-*"))) == 1
    assert len(list((tmp_path / "rows").glob("part-*"))) == 8
    assert spark.read.json(str(tmp_path / "rows")).count() == 200
