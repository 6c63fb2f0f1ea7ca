"""Many keywords in one pass, symbols as words, records of unknown shape, growing files and bucketed tables."""

import random

import pytest
from pyspark.sql import functions as F

from postlens.functions.matcher import keyword_hits, rule_label_once
from postlens.functions.symbols import symbol_words
from postlens.functions.text import normalize_text, rule_label
from postlens.operators import counts, hydrate, shapes
from postlens.params import LabelRules
from postlens.sources import buckets, tail

TEXTS = ["free freedom reed", "", None, "a.b x a*b", "aaaa", "ünï ß 漢字", "tab\there  two", "[x]^$\\"]
WORDS = ["free", "freedom", "reed", "eed", "a.b", "a", "aa", "aaa", "ß", "漢", "[x]", "^", "\\", "zz"]


def test_overlapping_keywords_are_all_found(spark):
    frame = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    got = [set(r[0]) for r in frame.select(keyword_hits(F.col("text"), WORDS)).collect()]
    assert got == [{w for w in WORDS if w in (t or "")} for t in TEXTS]


@pytest.mark.parametrize("seed", range(4))
def test_keywords_as_contains(spark, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 6))) for _ in range(300)]
    texts = ["".join(rng.choices("abcd ", k=rng.randint(0, 80))) for _ in range(60)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [set(r[0]) for r in frame.select(keyword_hits(F.col("text"), words)).collect()]
    assert got == [{w for w in words if w in t} for t in texts]


def test_keyword_lists_that_are_empty_or_hold_nothing(spark):
    frame = spark.createDataFrame([("a",)], "text string")
    assert frame.select(keyword_hits(F.col("text"), [])).first()[0] == []
    with pytest.raises(ValueError, match="empty keyword"):
        keyword_hits(F.col("text"), ["a", ""])
    with pytest.raises(ValueError, match="no keywords"):
        counts.many_keyword_counts(frame, [])


def test_counts_as_one_scan_with_contains(spark):
    frame = spark.createDataFrame([(t,) for t in TEXTS + ["FREE", "Aa"]], "text string")
    for exact in (True, False):
        words = [*WORDS, "FREE", "Free"]
        assert counts.many_keyword_counts(frame, words, case_sensitive=exact).collect() == counts.keyword_counts(frame, words, case_sensitive=exact).collect()


def test_no_text_gives_zeros(spark):
    frame = spark.createDataFrame([], "text string")
    assert counts.many_keyword_counts(frame, ["b", "a"]).collect() == [("a", 0), ("b", 0)]


@pytest.mark.parametrize("blank", [True, False])
def test_labels_as_rule_by_rule(spark, blank):
    rules = LabelRules(rules=(("x", ("two words",) if blank else ("two",)), ("y", ("free",))), fallback=("a",), fallback_label="some")
    frame = spark.createDataFrame([(t,) for t in ["Two \n WORDS", "free two  words", "freedom", "b a", "z", "", None, " "]], "text string")
    text = F.col("text")
    for once, each in frame.select(rule_label_once(text, rules), rule_label(normalize_text(text), rules)).collect():
        assert once == each


def spelled(text, words):
    out, blank = "", True
    for c in text:
        out += ("" if blank else " ") + words[c] if c in words else c
        blank = c == " "
    return out


@pytest.mark.parametrize("size", [3, 200])
def test_symbols_become_words(spark, size):
    words = {chr(0x1F600 + i): f"face {i}" for i in range(size)}
    rng = random.Random(size)
    texts = ["", "none", *("".join(rng.choices([*words, "a", " ", "-", "]"], k=rng.randint(1, 30))) for _ in range(40))]
    frame = spark.createDataFrame([(t,) for t in [*texts, None]], "text string")
    assert [r[0] for r in frame.select(symbol_words(F.col("text"), words)).collect()] == [*(spelled(t, words) for t in texts), None]
    with pytest.raises(ValueError, match="not one character"):
        symbol_words(F.col("text"), {"\U0001F468‍\U0001F4BB": "technologist"})


def test_fields_whose_type_changes(spark):
    lines = ['{"a":1,"b":{"c":[1,"x",null]}}', '{"a":"12"}', '{"a":', None, "[]", "{}", '{"a":1.5,"b":true}', '{"a":null}', '{"a":"x"}']
    frame = spark.createDataFrame([(t,) for t in lines], "value string")
    got = {(r["path"], r["kind"]): r["count"] for r in shapes.field_kinds(frame).collect()}
    assert got == {
        ("$", "OBJECT"): 6, ("$", "ARRAY"): 1, ("$", "MALFORMED"): 1, ("$", "MISSING"): 1,
        ("$.a", "BIGINT"): 1, ("$.a", "STRING"): 2, ("$.a", "DECIMAL"): 1, ("$.a", "VOID"): 1, ("$.b", "OBJECT"): 1, ("$.b", "BOOLEAN"): 1,
        ("$.b.c", "ARRAY"): 1, ("$.b.c[]", "BIGINT"): 1, ("$.b.c[]", "STRING"): 1, ("$.b.c[]", "VOID"): 1,
    }
    assert {r["path"] for r in shapes.field_kinds(frame, depth=1).collect()} == {"$", "$.a", "$.b"}
    value = F.col("value")
    rows = frame.select(shapes.field(value, "$.a", "double"), shapes.unfit(value, "$.a", "double")).collect()
    assert [tuple(r) for r in rows] == [(1, False), (12, False), (None, False), (None, False), (None, False), (None, False), (1.5, False), (None, False), (None, True)]


@pytest.mark.parametrize("chunk", [1, 7, 1 << 20])
def test_each_line_of_a_growing_file_once(spark, tmp_path, chunk):
    feed, out, mark = tmp_path / "feed", tmp_path / "out", tmp_path / "mark"
    feed.mkdir()
    tail.register_tail(spark)

    def catch_up():
        lines = spark.readStream.format(tail.FORMAT).option("chunk", chunk).option("pattern", "*.log").load(str(feed))
        query = lines.writeStream.format("json").option("checkpointLocation", str(mark)).trigger(availableNow=True).start(str(out))
        query.awaitTermination()
        return sorted((r["value"], r["offset"]) for r in spark.read.schema("value string, file string, offset long").json(str(out)).collect())

    (feed / "other.txt").write_bytes(b"not read\n")
    with open(feed / "a.log", "wb") as file:
        file.write("one\r\n\nünï\nhal".encode())
        file.flush()
        assert catch_up() == [("", 5), ("one", 0), ("ünï", 6)]
        file.write(b"f\nlast\n")
        file.flush()
        (feed / "b.log").write_bytes(b"new\nopen")
        assert catch_up() == [("", 5), ("half", 12), ("last", 17), ("new", 0), ("one", 0), ("ünï", 6)]
        assert len(catch_up()) == 6


def test_the_saved_side_of_a_join_is_not_shuffled(spark, tmp_path, explain):
    name, path = "saved_posts_test", str(tmp_path / "posts")
    rows = spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("text"))
    for part in (rows.where("id < 50"), rows.where("id >= 50 and id < 60")):
        buckets.append_buckets(part, name, path, buckets=8)
    schema = spark.table(name).schema
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spark.sql(f"DROP TABLE {name}")  # as after a restart; the files stay
        saved = buckets.open_buckets(spark, name, path, schema, buckets=8)
        left = hydrate.unsaved(rows, saved)
        assert left.count() == 40
        plan = explain(left)
        assert plan.count("Arguments: hashpartitioning") == 1 and "SelectedBucketsCount: 8 out of 8" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
