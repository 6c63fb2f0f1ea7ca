import pytest
from pyspark.sql import functions as F

from postlens.operators.lexicon import affect_table, few_tokens, valence_table
from postlens.operators.sentiment import ruled_scores, sentiment_and_emotion, token_places
from postlens.params import SENTIMENT_RULES, SentimentRules

WORDS = {"good": 1.9, "bad": -2.5, "no": -1.2, "kind": 2.4, "οδος": 1.1, "i̇yi": 0.7, ":)": 2.0, "but": 0.3, "very": 0.4}
TEXTS = [
    "", None, " \t\n", "good", "table", "(Good) -- BAD!!", "a very GOOD thing but NOT bad", "ΟΔΟΣ. is GOOD", "İyi GOOD",
    "so   good\x85bad\x1cno kind of :) (:)", "!!! good ???", "bad But good but bad", "GOOD BAD", "never so 'good'", "one two three four five six",
]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id BIGINT, text STRING")


def test_only_known_words_leave_the_text(spark):
    posts = frame(spark, ["the plot is good but very far from anything else, " * 200])
    rows = token_places(posts, "id", "text", SENTIMENT_RULES, ["good", "very"]).groupBy("_w0").count()
    assert {r["_w0"]: r["count"] for r in rows.collect()} == {"good": 200, "but": 200, " ": 1}  # "very" is a degree word
    assert token_places(posts, "id", "text", SENTIMENT_RULES).where("_w0 = 'plot'").count() == 200


def test_affect_tokens_outside_of_the_lexicon_stay(spark):
    posts = frame(spark, ["good it's Good well " * 50])
    rows = token_places(posts, "id", "text", SENTIMENT_RULES, ["good"], True, ["it's"]).groupBy("_w0").count()
    assert {r["_w0"]: r["count"] for r in rows.collect()} == {"good": 100, "\tit's": 50, " ": 1}


@pytest.mark.parametrize("rules", [SENTIMENT_RULES, SentimentRules(symbols={"!": "good", "ο": "no"}), SentimentRules(contrast="very")])
def test_known_words_give_the_scores_of_all_words(spark, rules):
    posts, table = frame(spark, TEXTS), valence_table(spark, WORDS)
    assert sorted(ruled_scores(posts, table, rules=rules).collect()) == sorted(ruled_scores(posts, table, rules=rules, max_rows=3).collect())


def test_known_affects_give_the_scores_of_all_tokens(spark):
    tables = valence_table(spark, WORDS), affect_table(spark, {"good": ("joy",), "bad": ("fear", "anger"), "is": ("trust",), "of": ("joy",), "no": ("fear",)})
    few, all_ = (sentiment_and_emotion(frame(spark, TEXTS), *tables, max_rows=n).withColumn("emotion_scores", F.to_json("emotion_scores")).orderBy("id").collect() for n in (1000, 3))
    assert few == all_ and any(r["top_emotion"] for r in few)


def test_a_large_lexicon_is_not_put_into_an_expression(spark):
    table = valence_table(spark, WORDS)
    assert sorted(few_tokens(table)) == sorted(WORDS) and few_tokens(table, 3) is None
