"""Counts, distributions and top-k reports. Each is one scan with map-side partial counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.matcher import keyword_hits
from postlens.functions.text import line_words


def top_groups(frame: DataFrame, keys: str | Sequence[str], k: int, count_col: str = "count") -> DataFrame:
    """The k largest groups; equal counts are ordered by the keys."""
    return distribution(frame, keys, count_col).limit(k)


def distribution(frame: DataFrame, keys: str | Sequence[str], count_col: str = "count") -> DataFrame:
    """Rows per group, largest first; equal counts are ordered by the keys. A null key is a group."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    counted = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    return counted.orderBy(F.desc(count_col), *keys)


def grouped_counts(
    frame: DataFrame, reports: Mapping[str, Sequence[str]], count_col: str = "count", max_of: str | None = None
) -> DataFrame:
    """Rows per group for several reports from one scan: ``report``, all key columns, the count, and the greatest ``max_of``.

    ``reports`` names the keys of each report; two reports can't have the same keys. Columns that are no key of a report
    are null in its rows; a null key is a group of its own. Spark expands a row once for each report and counts within
    the task before the shuffle.
    """
    keys = list(dict.fromkeys(c for columns in reports.values() for c in columns))
    if len({frozenset(columns) for columns in reports.values()}) < len(reports):
        raise ValueError("two reports have the same keys")
    # grouping_id has a bit for each key, the first one highest, that is set if the key is not part of the group
    marks = {name: sum(1 << (len(keys) - 1 - i) for i, c in enumerate(keys) if c not in columns) for name, columns in reports.items()}
    aggregates = [F.count(F.lit(1)).alias(count_col), *([F.max(max_of).alias(f"max_{max_of}")] if max_of else [])]
    grouped = frame.groupingSets([[F.col(c) for c in columns] for columns in reports.values()], *keys).agg(
        F.grouping_id().alias("_mark"), *aggregates
    )
    names = F.create_map(*[F.lit(x) for name, mark in marks.items() for x in (mark, name)])
    return grouped.select(F.element_at(names, F.col("_mark").cast("int")).alias("report"), *keys, *grouped.columns[-len(aggregates):])


def report_of(grouped: DataFrame, name: str, keys: Sequence[str], k: int | None = None, count_col: str = "count") -> DataFrame:
    """One report of ``grouped_counts``, largest first; equal counts are ordered by the keys."""
    rows = grouped.filter(F.col("report") == name).select(*keys, count_col).orderBy(F.desc(count_col), *keys)
    return rows.limit(k) if k else rows


def top_scores(frame: DataFrame, k: int = 20, author_col: str = "author", score_col: str = "score") -> DataFrame:
    """Highest score and number of posts per author, the k highest scores first."""
    return (
        frame.groupBy(author_col)
        .agg(F.max(score_col).alias("max_score"), F.count(F.lit(1)).alias("post_count"))
        .orderBy(F.desc("max_score"), author_col)
        .limit(k)
    )


def keyword_counts(
    frame: DataFrame, keywords: Sequence[str], text_col: str = "text", case_sensitive: bool = False
) -> DataFrame:
    """Rows that hold each keyword, zeros kept, most frequent first.

    All keywords are counted in one scan; the one result row is then turned into one row per keyword.
    """
    words = list(dict.fromkeys(keywords))
    text = F.col(text_col) if case_sensitive else F.lower(F.col(text_col))
    hits = [F.count_if(F.col("_text").contains(w if case_sensitive else w.lower())).alias(f"_k{i}") for i, w in enumerate(words)]
    counted = frame.select(text.alias("_text")).agg(*hits)
    pairs = F.array(*[F.struct(F.lit(w).alias("keyword"), F.col(f"_k{i}").alias("count")) for i, w in enumerate(words)])
    return counted.select(F.inline(pairs)).orderBy(F.desc("count"), "keyword")


def many_keyword_counts(
    frame: DataFrame, keywords: Sequence[str], text_col: str = "text", case_sensitive: bool = False
) -> DataFrame:
    """The same for hundreds of keywords: each text is gone through once for all of them together.

    A text becomes a row for each keyword that it holds; these are counted within the task before the shuffle.
    """
    words = list(dict.fromkeys(keywords))
    if not words:
        raise ValueError("no keywords")
    looked_for = {w: w if case_sensitive else w.lower() for w in words}
    text = F.col(text_col) if case_sensitive else F.lower(F.col(text_col))
    hits = frame.select(F.explode(keyword_hits(text, list(looked_for.values()))).alias("_word"))
    found = hits.groupBy("_word").agg(F.count(F.lit(1)).alias("_n"))
    pairs = F.array(*[F.struct(F.lit(w).alias("keyword"), F.lit(as_found).alias("_word")) for w, as_found in looked_for.items()])
    listed = frame.sparkSession.range(1).select(F.inline(pairs))
    counted = listed.join(found, "_word", "left").select("keyword", F.coalesce("_n", F.lit(0)).alias("count"))
    return counted.orderBy(F.desc("count"), "keyword")


def word_counts(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Occurrences of each blank-separated word of the lines."""
    words = lines.select(line_words(F.col(value_col)).alias("_words"))
    # The outer explode keeps Spark from inferring a filter on the size of the array, which would split twice.
    rows = words.select(F.explode_outer("_words").alias("word")).filter(F.col("word").isNotNull())
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def row_count(frame: DataFrame, name: str = "post_count") -> DataFrame:
    return frame.agg(F.count(F.lit(1)).alias(name))


def extreme_posts(
    frame: DataFrame, by: str, id_col: str, columns: Sequence[str], k: int = 50, highest: bool = True
) -> DataFrame:
    """The k posts with the highest or lowest value; equal values are ordered by id."""
    order = F.desc_nulls_last(by) if highest else F.asc_nulls_last(by)
    return frame.select(*columns).orderBy(order, F.asc(id_col)).limit(k)


#: The reports of the post job by the role of their keys, and how many groups each lists.
REPORTS = {
    "top_authors": (("author",), 10),
    "community_counts": (("community",), 15),
    "post_type_counts": (("type",), None),
    "sentiment_distribution": (("sentiment",), None),
    "emotion_distribution": (("emotion",), None),
    "ml_distribution": (("predicted",), None),
    "ml_confusion_summary": (("label", "predicted"), None),
}


def report_keys(columns: Sequence[str], roles: Mapping[str, str]) -> dict[str, list[str]]:
    """The key columns of each report whose columns are there; ``roles`` names the column of each role."""
    named = {name: [roles[r] for r in keys] for name, (keys, _) in REPORTS.items() if all(r in roles for r in keys)}
    return {name: keys for name, keys in named.items() if all(c in columns for c in keys)}


def grouped_reports(grouped: DataFrame, keys: Mapping[str, Sequence[str]], score_col: str | None = None) -> dict[str, DataFrame]:
    """The reports of ``grouped_counts`` by name, with the highest scores by author if there are scores."""
    reports = {name: report_of(grouped, name, columns, REPORTS[name][1]) for name, columns in keys.items()}
    if score_col and "top_authors" in keys:
        (author,) = keys["top_authors"]
        rows = grouped.filter("report = 'top_authors'").select(author, F.col(f"max_{score_col}").alias("max_score"), F.col("count").alias("post_count"))
        reports["top_scores_by_author"] = rows.orderBy(F.desc("max_score"), author).limit(20)
    return reports


def descriptive_reports(
    posts: DataFrame,
    keywords: Sequence[str],
    author_col: str = "author",
    community_col: str = "subreddit",
    score_col: str = "score",
    type_col: str = "is_self",
    text_col: str = "text",
) -> dict[str, DataFrame]:
    """The descriptive reports by name; a report whose column is absent is left out."""
    reports = {"top_authors": top_groups(posts, author_col, 10)}
    if community_col in posts.columns:
        reports["community_counts"] = top_groups(posts, community_col, 15)
    if score_col in posts.columns:
        reports["top_scores_by_author"] = top_scores(posts, 20, author_col, score_col)
    reports["keyword_counts"] = keyword_counts(posts, keywords, text_col)
    if type_col in posts.columns:
        reports["post_type_counts"] = distribution(posts, type_col)
    return reports
