import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlens.functions import text as t
from postlens.operators.counts import keyword_counts, word_counts
from postlens.operators.labels import add_weak_labels, trainable
from postlens.params import TOPIC_RULES, LabelRules

NBSP = " "
relaxed = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
strings = st.lists(st.text(alphabet=" \t\n\r \x1cabcABéİß'.,fire", max_size=25), min_size=1, max_size=40)


def one(spark, expression, **values):
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} STRING" for k in values))
    return frame.select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "title, body, expected",
    [
        ("a", "b", "a\nb"),
        (None, "b", "b"),
        ("a", None, "a"),
        (None, None, ""),
        (f"\t{NBSP} a", "b \n", "a\nb"),
    ],
)
def test_post_text_joins_and_trims(spark, title, body, expected):
    assert one(spark, t.post_text(F.col("title"), F.col("body")), title=title, body=body) == expected


def test_a_text_column_that_is_present_only_loses_its_nulls(spark):
    frame = spark.createDataFrame([(None, "t"), (" x ", "t")], "text STRING, title STRING")
    assert [r["text"] for r in t.with_text(frame).collect()] == ["", " x "]


def test_a_post_without_title_or_body_column(spark):
    frame = spark.createDataFrame([("t",)], "title STRING")
    assert t.with_text(frame).first()["text"] == "t"


@relaxed
@given(strings)
def test_normalized_text_equals_the_rule_in_plain_words(spark, values):
    values = [v.replace("İ", "i") for v in values]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    got = {r["i"]: r["n"] for r in frame.select("i", t.normalize_text(F.col("v")).alias("n")).collect()}
    assert got == {i: re.sub(r"\s+", " ", v.lower()).strip() for i, v in enumerate(values)}


def java_split(line: str) -> list[str]:
    words = line.split(" ")
    if line == "":
        return [""]
    while words and words[-1] == "":
        words.pop()
    return words


@relaxed
@given(st.lists(st.text(alphabet=" ab", max_size=8), min_size=1, max_size=40))
def test_line_words_drop_trailing_empties_only(spark, lines):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i INT, v STRING")
    got = {r["i"]: r["w"] for r in frame.select("i", t.line_words(F.col("v")).alias("w")).collect()}
    assert got == {i: java_split(v) for i, v in enumerate(lines)}


def test_word_counts_of_edge_lines(spark):
    lines = spark.createDataFrame([("",), ("   ",), (" a  b ",), ("a",)], "value STRING")
    assert {r["word"]: r["count"] for r in word_counts(lines).collect()} == {"": 3, "a": 2, "b": 1}


def test_tokens_are_ascii_runs_with_apostrophes(spark):
    assert one(spark, t.affect_tokens(F.col("v")), v="Don't café 2fast ÉTÉ") == ["don't", "caf", "fast", "t"]


def test_gram_tokens_and_pairs(spark):
    assert one(spark, t.gram_tokens(F.col("v")), v="A é1 _b c dd") == ["é1", "_b", "dd"]
    assert one(spark, t.bigrams(t.gram_tokens(F.col("v"))), v="aa bb cc") == ["aa bb", "bb cc"]
    assert one(spark, t.bigrams(t.gram_tokens(F.col("v"))), v="aa") == []


def test_quoted_is_a_json_string(spark):
    assert one(spark, t.quoted(F.col("v")), v='a"b\n') == '"a\\"b\\n"'


POSTS = [
    (1, "EVACUATION ordered"),
    (2, "storm\nsurge rising"),
    (3, "firefighter and Maria"),
    (4, "nothing here"),
    (5, ""),
    (6, None),
    (7, "puerto\trico"),
    (8, "marian"),
]


def test_rules_are_ordered_and_match_inside_words(spark):
    frame = spark.createDataFrame(POSTS, "id INT, text STRING")
    got = {r["id"]: r["weak_label"] for r in add_weak_labels(frame).collect()}
    assert got == {
        1: "wildfire", 2: "flood", 3: "hurricane", 4: "other", 5: "other", 6: "other", 7: "hurricane", 8: "hurricane",
    }
    whole = {r["id"]: r["weak_label"] for r in add_weak_labels(frame, whole_word=True).collect()}
    assert whole[8] == "other" and whole[3] == "hurricane"
    assert {r["id"] for r in trainable(add_weak_labels(frame)).collect()} == {1, 2, 3, 7, 8}


def test_the_fallback_is_reached_where_no_rule_hits(spark):
    rules = LabelRules(rules=(("a", ("x",)),), fallback=("x", "y"), fallback_label="general")
    frame = spark.createDataFrame([("has x",), ("has y",), ("none",)], "text STRING")
    assert [r["weak_label"] for r in add_weak_labels(frame, rules).collect()] == ["a", "general", "other"]


def test_counts_do_not_collapse_white_space_but_labels_do(spark):
    frame = spark.createDataFrame(POSTS, "id INT, text STRING")
    got = {r["keyword"]: r["count"] for r in keyword_counts(frame, ["storm surge", "maria", "EVACUATION", "zzz"]).collect()}
    assert got == {"storm surge": 0, "maria": 2, "EVACUATION": 1, "zzz": 0}
    strict = {r["keyword"]: r["count"] for r in keyword_counts(frame, ["maria", "Maria"], case_sensitive=True).collect()}
    assert strict == {"maria": 1, "Maria": 1}


def test_masked_text_loses_its_keywords(spark):
    words = [w for _, keywords in TOPIC_RULES.rules for w in keywords]
    masked = one(spark, t.mask_keywords(F.col("v"), words, "*"), v="Storm\nSurge near the FIRE")
    assert masked == "* near the *"


@pytest.mark.parametrize("v, blank", [("", True), (f" {NBSP}\t\n", True), (None, True), (" a", False)])
def test_blank_text(spark, v, blank):
    assert one(spark, t.is_blank(F.col("v")), v=v) is blank


@pytest.mark.parametrize("whole_word", [False, True])
def test_labels_are_those_of_the_collapsed_text(spark, whole_word):
    """Keywords with blanks are found across any white space, and odd keywords as before."""
    texts = [None, "", " \t", "Climate\u00a0 \n change", "climate", "climatechange", "the sea\x1flevel rose", " storm", "a  b", "Storms", "x\ty"]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id BIGINT, text STRING")
    for rules in (
        LabelRules((("first", ("climate change", "x y")), ("second", ("sea level",))), ("storm",)),
        LabelRules((("odd", ("a  b", " storm")),), ("b ",)),
        LabelRules((("tab", ("x\ty",)), ("plain", ("storm",)))),
    ):
        got = {r["id"]: r["weak_label"] for r in add_weak_labels(frame, rules, whole_word=whole_word).collect()}
        for k, value in enumerate(texts):
            plain = " ".join((value or "").lower().replace("\x1f", " ").split())
            hit = lambda w: re.search(rf"(?<!\w){re.escape(w)}(?!\w)" if whole_word else re.escape(w), plain)  # noqa: E731, B023
            label = next((name for name, words in rules.rules if plain and any(map(hit, words))), None)
            assert got[k] == (label or ("general" if plain and any(map(hit, rules.fallback)) else "other")), (k, rules)
