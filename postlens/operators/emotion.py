"""Affect counts of posts from a (token, affect) lexicon with any number of affects per token."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.text import affect_tokens
from postlens.operators.lexicon import BROADCAST_ROWS, COPY, Lexicon, affect_flags, join_scores, text_key, with_copy
from postlens.params import AFFECTS


def token_rows(posts: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """One row per token occurrence with its position.

    The outer explode keeps Spark from inferring a filter on the size of the array, which would tokenise twice.
    """
    tokens = posts.select(id_col, affect_tokens(F.col(text_col)).alias("_tokens"))
    return tokens.select(id_col, F.posexplode_outer("_tokens").alias("position", "token")).filter(F.col("token").isNotNull())


def affect_aggregates(affects: Sequence[str], token: str, position: str) -> list[Column]:
    """For each affect the number of its tokens in all copies of a text, and the place of the first one; the copies."""
    out = [F.count_if(F.col(token) == COPY).alias("_copies")]
    for i in range(len(affects)):
        out += [F.count_if(F.col(f"_f{i}")).alias(f"_n{i}"), F.min(F.when(F.col(f"_f{i}"), F.col(position))).alias(f"_p{i}")]
    return out


def affect_counts(
    posts: DataFrame,
    lexicon: DataFrame,
    id_col: str = "id",
    text_col: str = "text",
    affects: Sequence[str] = AFFECTS,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Per id and text with a hit: for each affect the number of its tokens in all copies and the place of the first one.

    The lexicon is turned into one row per token with one flag per affect, so the token rows are joined once and
    added up once. Rows with the same id and text are added up together; ``_copies`` is their number.
    """
    words = posts.select(id_col, text_key(F.col(text_col)).alias("_text_key"), F.array_append(affect_tokens(F.col(text_col)), F.lit(COPY)).alias("_tokens"))
    rows = words.select(id_col, "_text_key", F.posexplode_outer("_tokens").alias("position", "_token"))
    hits = Lexicon(with_copy(affect_flags(lexicon, affects)), max_rows).join(rows, "_token", [id_col, "_text_key"])
    return hits.groupBy(id_col, "_text_key").agg(*affect_aggregates(affects, "_token", "position"))


def found_affects(affects: Sequence[str], ties: str) -> Column:
    """The affects that occur, most frequent first, as structs (less, tie, affect, n).

    Equal counts are ordered by first occurrence in the text and then by name (``ties="first_seen"``), or by the
    order of the affect list (``ties="listed"``).
    """
    if ties not in ("first_seen", "listed"):
        raise ValueError(f"unknown order of ties: {ties}")
    entries = [
        F.when(
            F.col(f"_n{i}") > 0,
            F.struct(
                (-F.col(f"_n{i}")).alias("less"),
                (F.col(f"_p{i}") if ties == "first_seen" else F.lit(i)).cast("int").alias("tie"),
                F.lit(a).alias("affect"),
                F.col(f"_n{i}").alias("n"),
            ),
        )
        for i, a in enumerate(affects)
    ]
    return F.array_sort(F.array_compact(F.array(*entries)))


def emotion_scores(
    posts: DataFrame,
    lexicon: DataFrame,
    id_col: str = "id",
    text_col: str = "text",
    affects: Sequence[str] = AFFECTS,
    ties: str = "first_seen",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Top affect and the map affect → count of the ids and texts with a hit."""
    counts = affect_counts(posts, lexicon, id_col, text_col, affects, max_rows)
    return top_and_map(counts, id_col, affects, ties)


def affect_map(found: str = "_found") -> Column:
    """affect → count in one copy of the text."""
    return F.map_from_entries(F.transform(found, lambda e: F.struct(e["affect"], F.floor(e["n"] / F.col("_copies")).alias("n"))))


def top_and_map(counts: DataFrame, id_col: str, affects: Sequence[str], ties: str) -> DataFrame:
    found = counts.select(id_col, "_text_key", "_copies", found_affects(affects, ties).alias("_found")).filter(F.size("_found") > 0)
    return found.select(id_col, "_text_key", F.get("_found", F.lit(0))["affect"].alias("top_emotion"), affect_map().alias("emotion_scores"))


def add_emotions(
    posts: DataFrame,
    lexicon: DataFrame,
    id_col: str = "id",
    text_col: str = "text",
    affects: Sequence[str] = AFFECTS,
    ties: str = "first_seen",
) -> DataFrame:
    """Posts with top affect and affect counts; a post without a hit is neutral with an empty map."""
    return fill_emotions(join_scores(posts, emotion_scores(posts, lexicon, id_col, text_col, affects, ties), id_col, text_col))


def fill_emotions(joined: DataFrame) -> DataFrame:
    return joined.withColumns(
        {
            "top_emotion": F.coalesce("top_emotion", F.lit("neutral")),
            "emotion_scores": F.coalesce("emotion_scores", F.create_map().cast("map<string,bigint>")),
        }
    )


def emotion_rows(scored: DataFrame, id_col: str = "id") -> DataFrame:
    """The affect map as rows (id, affect, n)."""
    return scored.select(id_col, F.explode("emotion_scores").alias("affect", "n"))
