import pytest
from pyspark.sql import functions as F

from postlens.operators.lexicon import valence_table
from postlens.operators.sentiment import (
    SCORES,
    add_plain_sentiment,
    add_sentiment,
    compound,
    plain_scores,
    ruled_scores,
    sentiment_label,
)
from postlens.params import SentimentRules

WORDS = {
    "smart": 1.7, "handsome": 2.2, "funny": 1.9, "good": 1.9, "bad": -2.5, "horrible": -2.5, "great": 3.1, "sux": -1.5,
    "no": -1.2, "kind": 2.4, "like": 1.5, "worst": -3.1,
}
# Sentences with the scores that the publication's own examples give for these valences.
PUBLISHED = [
    ("VADER is smart, handsome, and funny.", 0.8316, 0.746, 0.254, 0.0),
    ("VADER is smart, handsome, and funny!", 0.8439, 0.752, 0.248, 0.0),
    ("VADER is very smart, handsome, and funny.", 0.8545, 0.701, 0.299, 0.0),
    ("VADER is VERY SMART, handsome, and FUNNY.", 0.9227, 0.754, 0.246, 0.0),
    ("VADER is VERY SMART, handsome, and FUNNY!!!", 0.9342, 0.767, 0.233, 0.0),
    ("VADER is not smart, handsome, nor funny.", -0.7424, 0.0, 0.354, 0.646),
    ("The book was good.", 0.4404, 0.492, 0.508, 0.0),
    ("The book was kind of good.", 0.3832, 0.343, 0.657, 0.0),
    ("At least it isn't a horrible book.", 0.431, 0.322, 0.678, 0.0),
    ("A really bad, horrible book.", -0.8211, 0.0, 0.284, 0.716),
    ("Today SUX!", -0.5461, 0.0, 0.221, 0.779),
    ("Not bad at all", 0.431, 0.487, 0.513, 0.0),
]
LONG = "the plot is good but never so bad, least like no kind of great?? " * 300


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id BIGINT, text STRING")


def test_published_examples(spark):
    scored = add_sentiment(frame(spark, [p[0] for p in PUBLISHED]), valence_table(spark, WORDS)).orderBy("id").collect()
    assert [tuple(r[c] for c in SCORES) for r in scored] == [p[1:] for p in PUBLISHED]


@pytest.mark.parametrize("add", [add_sentiment, add_plain_sentiment])
def test_a_text_without_a_hit_is_neutral(spark, add):
    scored = add(frame(spark, ["", None, " \t ", "table chair"]), valence_table(spark, WORDS)).collect()
    assert {(r["sentiment_compound"], r["sentiment_neu"], r["sentiment_label"]) for r in scored} == {(0.0, 1.0, "neutral")}
    assert len(scored) == 4


def score_of(spark, text, words=WORDS, rules=None):
    table = valence_table(spark, words)
    scores = ruled_scores(frame(spark, [text]), table, rules=rules) if rules else ruled_scores(frame(spark, [text]), table)
    return scores.first()["sentiment_compound"]


def normal(total):
    return round(total / (total * total + 15) ** 0.5, 4)


@pytest.mark.parametrize(
    "text, total",
    [
        ("it is no good", -0.74 * 1.9),  # the word "no" negates and has no valence itself
        ("good but bad", 0.5 * 1.9 - 1.5 * 2.5),
        ("never so good", 1.25 * (1.9 + 0.293)),
        ("without doubt good", 1.9),
        ("the least good", -0.74 * 1.9),
        ("at least good", 1.9),
        ("it was yeah right good", -2.0),  # an idiom before the hit replaces its score
        ("good?", 1.9),
        ("good???", 1.9 + 3 * 0.18),
        ("good????????", 1.9 + 0.96),
        ("good!!!!!!!!", 1.9 + 4 * 0.292),
        ("kind of good", 1.9),  # "kind" before "of" is no hit
    ],
)
def test_single_rules(spark, text, total):
    assert score_of(spark, text) == pytest.approx(normal(total), abs=1e-9)


def test_other_word_lists(spark):
    rules = SentimentRules(negations=("kein",), contrast="aber", idioms={}, boosters_up=("sehr",))
    assert score_of(spark, "kein good aber sehr bad", rules=rules) == normal(-0.74 * 1.9 * 0.5 + 1.5 * (-2.5 - 0.293))


def test_quotes_in_words_are_literals(spark):
    rules = SentimentRules(negations=("o'no\\x",), idioms={"it's on good": 3.5})
    assert score_of(spark, "x o'no\\x good", rules=rules) == normal(-0.74 * 1.9)
    assert score_of(spark, "a it's on good", rules=rules) == normal(3.5)


def test_a_lexicon_above_the_broadcast_bound_gives_the_same_scores(spark):
    posts = frame(spark, [p[0] for p in PUBLISHED] + [LONG, "it is no good at all", "no"])
    table = valence_table(spark, WORDS)
    for scores in (ruled_scores, plain_scores):
        small, large = scores(posts, table), scores(posts, table, max_rows=3)
        assert sorted(small.collect()) == sorted(large.collect())


def test_the_path_above_the_bound_has_no_broadcast(spark, explain):
    table = valence_table(spark, WORDS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in explain(ruled_scores(frame(spark, ["a"]), table, max_rows=3))
        assert "BroadcastHashJoin" in explain(ruled_scores(frame(spark, ["a"]), table))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_long_text_is_scored_whole(spark):
    twice = frame(spark, [LONG, LONG + LONG])
    counted = plain_scores(twice, valence_table(spark, {"good": 0.01, "bad": -0.002})).orderBy("id").collect()
    assert counted[0]["sentiment_compound"] == normal(300 * 0.008)
    assert counted[1]["sentiment_compound"] == normal(600 * 0.008)


def test_thresholds_belong_to_their_class(spark):
    values = spark.createDataFrame([(0.05,), (0.0499,), (-0.05,), (-0.0499,)], "s DOUBLE")
    got = [r["l"] for r in values.select(sentiment_label(F.col("s")).alias("l")).collect()]
    assert got == ["positive", "neutral", "negative", "neutral"]


def test_compound_stays_in_range(spark):
    values = spark.createDataFrame([(1e9,), (-1e9,), (0.0,)], "s DOUBLE")
    assert [r["c"] for r in values.select(compound(F.col("s")).alias("c")).collect()] == [1.0, -1.0, 0.0]
