import pytest

from postlens.operators.emotion import add_emotions, emotion_rows, emotion_scores
from postlens.operators.lexicon import affect_table

WORDS = {"storm": ("fear", "negative"), "calm": ("positive", "joy"), "odd": ("surprise",)}


def scored(spark, texts, **options):
    posts = spark.createDataFrame(list(enumerate(texts)), "id BIGINT, text STRING")
    return add_emotions(posts, affect_table(spark, WORDS), **options)


def test_counts_and_top(spark):
    rows = {r["id"]: r for r in scored(spark, ["Storm storm calm", "none", "", None, "odd calm calm"]).collect()}
    assert rows[0]["emotion_scores"] == {"fear": 2, "negative": 2, "positive": 1, "joy": 1}
    assert rows[4]["emotion_scores"] == {"positive": 2, "joy": 2, "surprise": 1}
    assert [rows[i]["top_emotion"] for i in range(5)] == ["fear", "neutral", "neutral", "neutral", "joy"]
    assert [rows[i]["emotion_scores"] for i in (1, 2, 3)] == [{}, {}, {}]


def test_ties_by_first_occurrence_or_by_list(spark):
    texts = ["calm storm", "storm calm", "odd calm"]
    first = [r["top_emotion"] for r in scored(spark, texts).orderBy("id").collect()]
    listed = [r["top_emotion"] for r in scored(spark, texts, ties="listed").orderBy("id").collect()]
    assert first == ["joy", "fear", "surprise"]
    assert listed == ["fear", "fear", "joy"]
    with pytest.raises(ValueError):
        scored(spark, texts, ties="none")


def test_a_polarity_can_be_the_top(spark):
    assert scored(spark, ["calm"], affects=("positive", "negative")).first()["top_emotion"] == "positive"


def test_rows_of_the_map(spark):
    got = {tuple(r) for r in emotion_rows(scored(spark, ["storm calm calm", "x"])).collect()}
    assert got == {(0, "fear", 1), (0, "negative", 1), (0, "positive", 2), (0, "joy", 2)}


def test_a_lexicon_above_the_broadcast_bound(spark):
    posts = spark.createDataFrame(list(enumerate(["storm calm odd odd"] * 40)), "id BIGINT, text STRING")
    table = affect_table(spark, WORDS)
    small, large = emotion_scores(posts, table), emotion_scores(posts, table, max_rows=1)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
