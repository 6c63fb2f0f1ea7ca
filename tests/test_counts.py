import pytest

from postlens.operators import counts
from postlens.params import STORM_KEYWORDS


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def posts(spark):
    data = [("b", 5), ("a", 1), ("a", None), ("b", 2), (None, 9), ("c", None)]
    return spark.createDataFrame(data, "author STRING, score BIGINT")


def test_equal_counts_are_ordered_by_key_and_null_is_a_group(spark):
    assert rows(counts.distribution(posts(spark), "author")) == [("a", 2), ("b", 2), (None, 1), ("c", 1)]
    assert rows(counts.top_groups(posts(spark), "author", 1)) == [("a", 2)]


def test_post_count_counts_rows_without_a_score(spark):
    got = rows(counts.top_scores(posts(spark), 20))
    assert got == [(None, 9, 1), ("b", 5, 2), ("a", 1, 2), ("c", None, 1)]


def test_equal_values_at_the_cut_are_ordered_by_id(spark):
    frame = spark.createDataFrame([(3, 0.5), (1, 0.5), (2, 0.5), (4, 0.1)], "id INT, s DOUBLE")
    assert rows(counts.extreme_posts(frame, "s", "id", ["id", "s"], k=2)) == [(1, 0.5), (2, 0.5)]
    assert rows(counts.extreme_posts(frame, "s", "id", ["id"], k=2, highest=False)) == [(4,), (1,)]


def test_reports_of_absent_columns_are_left_out(spark):
    frame = spark.createDataFrame([("a", "x")], "author STRING, text STRING")
    assert set(counts.descriptive_reports(frame, STORM_KEYWORDS)) == {"top_authors", "keyword_counts"}
    full = frame.selectExpr("*", "'s' AS subreddit", "1L AS score", "true AS is_self")
    assert set(counts.descriptive_reports(full, STORM_KEYWORDS)) == {
        "top_authors", "community_counts", "top_scores_by_author", "keyword_counts", "post_type_counts",
    }


def test_grouped_counts_tell_null_keys_from_other_reports(spark):
    frame = spark.createDataFrame([("a", None, 1), ("a", "x", 5), (None, "x", None), (None, None, 2)], "author STRING, kind STRING, score INT")
    reports = {"by_author": ["author"], "by_kind": ["kind"], "both": ["author", "kind"]}
    got = {tuple(r) for r in counts.grouped_counts(frame, reports, max_of="score").collect()}
    assert got == {
        ("by_author", "a", None, 2, 5), ("by_author", None, None, 2, 2), ("by_kind", None, None, 2, 2), ("by_kind", None, "x", 2, 5),
        ("both", "a", None, 1, 1), ("both", "a", "x", 1, 5), ("both", None, "x", 1, None), ("both", None, None, 1, 2),
    }
    assert counts.grouped_counts(frame.limit(0), reports).collect() == []
    with pytest.raises(ValueError, match="same keys"):
        counts.grouped_counts(frame, {"a": ["author", "kind"], "b": ["kind", "author"]})
