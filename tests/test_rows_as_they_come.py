"""Rows that real files hold: repeated and null ids, absent fields, repeated tokens, flags in every spelling."""

import json

import pytest
from pyspark.sql import functions as F

from postlens.functions.records import flag_number
from postlens.functions.text import mask_keywords
from postlens.operators import hydrate as h
from postlens.operators.emotion import add_emotions
from postlens.operators.lexicon import Lexicon, affect_table, fits_broadcast, valence_table
from postlens.operators.sentiment import add_plain_sentiment, add_sentiment, sentiment_and_emotion
from postlens.params import SentimentRules
from postlens.plans.hydration import run_hydration
from postlens.plans.post_analytics import PostParams, run_posts
from postlens.session import scratch_path
from postlens.sources import readers

WORDS = {"good": 1.9, "storm": -1.0}
ROWS = [(1, "good"), (1, "table"), (1, "good"), (None, "good"), (None, None), (2, "good"), (2, "a storm"), (None, "good"), (3, "")]


def posts(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id BIGINT, text STRING")


def one_by_one(spark, add):
    """Each row scored in a frame of its own."""
    found = {}
    for text in {t for _, t in ROWS}:
        found[text] = add(posts(spark, [(7, text)])).drop("id", "text").first()
    return sorted((repr((i, t, tuple(found[t]))) for i, t in ROWS))


@pytest.mark.parametrize("add", [add_plain_sentiment, add_sentiment])
def test_scores_are_those_of_each_row(spark, add):
    scored = lambda frame: add(frame, valence_table(spark, WORDS))
    got = sorted(repr((r["id"], r["text"], tuple(r)[2:])) for r in scored(posts(spark)).collect())
    assert got == one_by_one(spark, scored)
    assert any("0.4404" in row for row in got)


def test_emotions_are_those_of_each_row(spark):
    scored = lambda frame: add_emotions(frame, affect_table(spark, {"storm": ["fear"], "good": ["joy", "trust"]}))
    got = sorted(repr((r["id"], r["text"], tuple(r)[2:])) for r in scored(posts(spark)).collect())
    assert got == one_by_one(spark, scored)


def test_both_scores_from_one_pass(spark):
    rows = [(1, "good storm, good!"), (1, "a storm"), (2, "nothing"), (1, "a storm")]
    both = sentiment_and_emotion(posts(spark, rows), valence_table(spark, WORDS), affect_table(spark, {"storm": ["fear"], "good": ["joy"]}))
    got = {(r["id"], r["sentiment_compound"], r["top_emotion"], tuple(sorted((r["emotion_scores"] or {}).items()))) for r in both.collect()}
    alone = add_sentiment(posts(spark, rows), valence_table(spark, WORDS)).select("sentiment_compound").collect()
    assert {g[1] for g in got if g[1] is not None} == {r[0] for r in alone} - {0.0}
    assert {g[2:] for g in got} == {("joy", (("fear", 1), ("joy", 2))), ("fear", (("fear", 1),)), (None, ())}


def test_lexicons_that_contradict_themselves(spark):
    twice = spark.createDataFrame([("good", 1.9), ("good", 1.9), (None, 1.0)], "token STRING, valence DOUBLE")
    assert add_plain_sentiment(posts(spark, [(1, "a good day")]), twice).first()["sentiment_compound"] == 0.4404
    with pytest.raises(ValueError, match="several valences"):
        add_plain_sentiment(posts(spark), spark.createDataFrame([("good", 1.9), ("good", 2.0)], "token STRING, valence DOUBLE"))
    with pytest.raises(ValueError, match="not listed"):
        add_emotions(posts(spark), affect_table(spark, {"abc": ["calm"]}))


def test_empty_word_lists(spark):
    rules = SentimentRules(negations=(), boosters_up=(), boosters_down=(), never_links=(), no_links=(), idioms={}, booster_phrases_down=())
    scored = add_sentiment(posts(spark, [(1, "not good")]), valence_table(spark, WORDS), rules=rules)
    assert scored.first()["sentiment_compound"] == 0.4404
    assert posts(spark, [(1, "abc")]).select(mask_keywords(F.col("text"), [], "*")).first()[0] == "abc"


def test_a_lexicon_of_long_tokens_is_not_broadcast(spark):
    table = valence_table(spark, {"x" * 100 + str(i): 1.0 for i in range(10)})
    assert fits_broadcast(table) and not fits_broadcast(table, max_bytes=500)
    assert Lexicon(table, max_rows=1).salts == int(spark.conf.get("spark.sql.shuffle.partitions"))


def json_file(spark, rows, extra=()):
    path = scratch_path(spark, "json")
    spark.createDataFrame([(line,) for line in [*map(json.dumps, rows), *extra]], "value STRING").coalesce(1).write.text(path)
    return path


def test_text_of_title_and_body_by_record(spark):
    rows = [{"id": "a", "title": "big flood", "selftext": "help"}, {"id": "b", "title": "t", "text": None}, {"id": "c", "title": "t", "text": "own"}, {"id": "d"}]
    path = json_file(spark, rows, ["", "  ", "{broken"])
    got = {r["id"]: r["text"] for r in readers.read_posts(spark, path).collect()}
    assert got == {"a": "big flood\nhelp", "b": "", "c": "own", "d": "", None: ""}
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        readers.read_posts_strict(spark, path).collect()
    named = readers.read_posts(spark, json_file(spark, rows[:1]), fields=("id", "title", "selftext"))
    assert named.columns == ["id", "title", "selftext", "text"] and named.first()["text"] == "big flood\nhelp"


def test_the_job_from_a_file_of_titles_and_bodies(spark):
    topics = ["hurricane winds", "flood water", "wildfire smoke"]
    rows = [{"id": f"p{i}", "author": f"a{i % 4}", "title": topics[i % 3], "selftext": f"number {i}"} for i in range(45)]
    out = scratch_path(spark, "titled")
    summary = run_posts(readers.read_posts(spark, json_file(spark, rows), fields=("id", "author", "title", "selftext")), out, PostParams(max_iter=5))
    assert summary["post_count"] == 45 and summary["ml_metrics"]["train_rows"] > 10
    assert spark.read.json(f"{out}/enriched_posts").where("text like 'flood water%'").count() == 15
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.csv(f"{out}/community_counts")


@pytest.mark.parametrize(
    "text, value",
    [("1", 1), ("0", 0), ("1.0", 1), ("0.0", 0), ("True", 1), ("FALSE", 0), (" yes ", 1), ("n", 0), ("", None), (None, None), ("maybe", None), ("0.5", None), ("nan", None), ("1e99", None)],
)
def test_flags(spark, text, value):
    assert spark.createDataFrame([(text,)], "v STRING").select(flag_number(F.col("v"))).first()[0] == value


def test_flags_that_cannot_be_read_are_counted(spark):
    path = scratch_path(spark, "csv")
    rows = [("a", "1.0", "True"), ("b", "perhaps", ""), ("c", None, "x")]
    spark.createDataFrame(rows, "id STRING, Casualty STRING, Damage STRING").write.option("header", True).csv(path)
    raw = readers.raw_annotations(spark, path)
    assert {tuple(r) for r in readers.unreadable_flags(raw).collect()} == {("Casualty", 1), ("Damage", 1)}
    assert {r["id"]: (r["Casualty"], r["Damage"]) for r in readers.read_annotations(spark, path).collect()} == {"a": (1, 1), "b": (None, None), "c": (None, None)}


def test_the_last_submission_in_a_total_order(spark):
    rows = [("a", "t", None), ("a", "u", None), ("b", "x", 1), ("b", "y", 1), ("b", "z", None), ("c", "old", 2), ("c", "new", 3), (None, "lost", 9)]
    frame = spark.createDataFrame(rows, "id STRING, title STRING, at INT")
    for stored in (frame, frame.repartition(5)):
        assert {r["id"]: r["title"] for r in h.last_by_id(stored, "at").collect()} == {"a": "u", "b": "y", "c": "new"}
        assert len(h.last_by_id(stored).collect()) == 3


def test_repeated_submissions_give_one_post(spark):
    wanted = spark.createDataFrame([("a",), ("b",)], "id STRING")
    fields = "Information_Integrity STRING, Linguistic_Bias INT, Political_Bias INT, Gender_Bias INT, Hate_Speech INT, Racial_Bias INT, Casualty INT, Evacuation INT, Damage INT, Advice INT, Request INT, Assistance INT, Recovery INT"
    for field in fields.split(", "):
        name, kind = field.split(" ")
        wanted = wanted.withColumn(name, F.lit(None).cast(kind))
    bodies = spark.createDataFrame(
        [(i, t, "x", None, None, None, None, None, None, None, None) for i, t in [("a", "one"), ("a", "two"), ("z", "other")]],
        "id STRING, title STRING, selftext STRING, subreddit STRING, author STRING, score BIGINT, num_comments BIGINT, created_utc BIGINT, permalink STRING, full_link STRING, is_self BOOLEAN",
    )
    out = scratch_path(spark, "repeated")
    got = run_hydration(wanted, bodies, out, "forum", "set")
    assert (got["annotation_rows"], got["hydrated_posts"], got["missing_or_empty"]) == (2, 1, 1)
    assert [r["title"] for r in spark.read.json(f"{out}/posts").collect()] == ["two"]
    assert tuple(h.hydration_stats(wanted, bodies).first()) == (2, 1, 1)
