"""Joining annotations to the posts they describe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions.records import flag, true_flags
from postlens.functions.text import trim_whitespace
from postlens.params import BIAS_FLAGS, DELETED_AUTHOR, HUMANITARIAN_FLAGS


def last_by_id(frame: DataFrame, order_col: str | None = None, id_col: str = "id") -> DataFrame:
    """One row per id that is not null: the one with the highest order value.

    A null order value comes before all others, and equal ones are decided by the other columns, so the result does not
    depend on how the rows are stored. Each task keeps one row per id before the shuffle.
    """
    others = sorted(c for c in frame.columns if c not in (id_col, order_col))
    order = [*([F.desc_nulls_last(order_col)] if order_col else []), *[F.desc_nulls_last(c) for c in others]]
    ranked = frame.filter(F.col(id_col).isNotNull()).withColumn("_rank", F.row_number().over(Window.partitionBy(id_col).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def require_unique(frame: DataFrame, id_col: str = "id") -> DataFrame:
    """The frame itself; raises where an id occurs more than once."""
    twice = frame.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(id_col).limit(3).collect()
    if twice:
        raise ValueError(f"ids occur more than once, for example {[row[0] for row in twice]}")
    return frame


def first_rows(frame: DataFrame, limit: int | None, id_col: str = "id") -> DataFrame:
    """The first rows by id for a trial run, or all rows."""
    return frame if limit is None else frame.orderBy(id_col).limit(limit)


def unsaved(annotations: DataFrame, saved: DataFrame | None, id_col: str = "id") -> DataFrame:
    """Annotations whose id an earlier run has not saved."""
    if saved is None:
        return annotations
    return annotations.join(saved.select(id_col), id_col, "left_anti")


def hydrated_text(title: Column, body: Column) -> Column:
    """Title and body joined by a line break and trimmed; without a body the title alone, trimmed."""
    title, body = F.coalesce(title, F.lit("")), F.coalesce(body, F.lit(""))
    return trim_whitespace(F.when(body == "", title).otherwise(F.concat(title, F.lit("\n"), body)))


def or_else(*choices: Column) -> Column:
    """The first choice that is neither null nor empty."""
    return F.coalesce(*[F.when(c != "", c) for c in choices])


def hydrated_post(
    platform: str,
    dataset: str,
    humanitarian: Sequence[str] = HUMANITARIAN_FLAGS,
    bias: Sequence[str] = BIAS_FLAGS,
    submission: str = "s",
    annotation: str = "a",
) -> list[Column]:
    """The columns of a post from an aliased submission and its aliased annotation.

    A flag that is missing is false, and a missing ``is_self`` is true.
    """

    def s(name: str) -> Column:
        return F.col(f"{submission}.{name}")

    def a(name: str) -> Column:
        return F.col(f"{annotation}.{name}")

    named_flags = [F.when(flag(a(name)), F.lit(name)) for name in humanitarian]
    return [
        or_else(s("id"), a("id")).alias("id"),
        F.lit(platform).alias("source"),
        F.lit(platform).alias("platform"),
        F.lit(dataset).alias("dataset"),
        s("subreddit").alias("subreddit"),
        F.coalesce(or_else(s("author")), F.lit(DELETED_AUTHOR)).alias("author"),
        F.coalesce(s("title"), F.lit("")).alias("title"),
        F.coalesce(s("selftext"), F.lit("")).alias("selftext"),
        hydrated_text(s("title"), s("selftext")).alias("text"),
        *[F.coalesce(s(name).cast("bigint"), F.lit(0)).alias(name) for name in ("score", "num_comments", "created_utc")],
        or_else(s("permalink"), s("full_link")).alias("permalink"),
        F.coalesce(s("is_self"), F.lit(True)).alias("is_self"),
        F.array_compact(F.array(*named_flags)).alias("humanitarian_labels"),
        a("Information_Integrity").alias("information_integrity"),
        *[flag(a(name)).alias(name.lower()) for name in bias],
        *[flag(a(name)).alias(name) for name in humanitarian],
    ]


def hydrate(annotations: DataFrame, submissions: DataFrame, platform: str, dataset: str) -> DataFrame:
    """Posts of the annotations that have a submission with a text. Both sides have unique ids."""
    joined = annotations.alias("a").join(submissions.alias("s"), F.col("a.id") == F.col("s.id"))
    return joined.select(*hydrated_post(platform, dataset)).filter(F.length("text") > 0)


def missing_ids(annotations: DataFrame, submissions: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids of the annotations without a submission."""
    return annotations.select(id_col).join(submissions.select(id_col), id_col, "left_anti")


def hydration_stats(
    annotations: DataFrame, submissions: DataFrame, saved: DataFrame | None = None, id_col: str = "id"
) -> DataFrame:
    """One row of counts: annotations, hydrated posts (those of earlier runs included), and posts missing or empty
    among the ones this run tried.

    Only ids and one boolean per submission are shuffled. Annotations are counted, however often a submission repeats
    an id; such an id is usable if one of its submissions is.
    """
    has_text = (F.length(hydrated_text(F.col("title"), F.col("selftext"))) > 0).alias("_usable")
    usable = submissions.select(id_col, has_text).groupBy(id_col).agg(F.max("_usable").alias("_usable"))
    wanted = annotations.select(id_col, F.lit(True).alias("_annotated"))
    marked = wanted.join(usable, id_col, "left")
    if saved is None:
        marked = marked.withColumn("_saved", F.lit(False))
    else:
        marked = marked.join(saved.select(id_col, F.lit(True).alias("_saved")).distinct(), id_col, "full_outer")
    annotated = F.coalesce("_annotated", F.lit(False))
    was_saved = F.coalesce("_saved", F.lit(False))
    tried = annotated & ~was_saved
    good = F.coalesce("_usable", F.lit(False))
    return marked.agg(
        F.count_if(annotated).alias("annotation_rows"),
        F.count_if(was_saved | (tried & good)).alias("hydrated_posts"),
        F.count_if(tried & ~good).alias("missing_or_empty"),
    )


def with_flag_labels(frame: DataFrame, flags: Sequence[str], name: str) -> DataFrame:
    """Add the array of the names of the flags that are set."""
    return frame.withColumn(name, true_flags(flags))
