"""Joins of exploded tokens with a lexicon table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.params import AFFECTS

# A lexicon within these bounds is broadcast.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
# The tokens of a lexicon within these bounds can stand in an expression.
KNOWN_ROWS = 20_000
KNOWN_BYTES = 1 << 20
# Not a word, as words hold no blanks: every text has it once, so its hits count the copies of a text.
COPY = " "


def valence_table(spark: SparkSession, valences: Mapping[str, float]) -> DataFrame:
    """A (token, valence) table from a mapping."""
    columns = {"token": pa.array(valences.keys(), pa.string()), "valence": pa.array(map(float, valences.values()), pa.float64())}
    return spark.createDataFrame(pa.table(columns), "token STRING, valence DOUBLE")


def affect_table(spark: SparkSession, affects: Mapping[str, Iterable[str]]) -> DataFrame:
    """A (token, affect) table, one row per pair, from a mapping."""
    pairs = [(token, affect) for token, names in affects.items() for affect in names]
    columns = {name: pa.array([pair[i] for pair in pairs], pa.string()) for i, name in enumerate(("token", "affect"))}
    return spark.createDataFrame(pa.table(columns), "token STRING, affect STRING")


def fits_broadcast(table: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table has at most ``max_rows`` rows and tokens of ``max_bytes``; reads no more than one row beyond that."""
    found = table.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("token")).alias("bytes")).first()
    return found["n"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def few_tokens(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> list[str] | None:
    """The tokens of a table, or None if they are too many for an expression."""
    if not fits_broadcast(table, min(max_rows, KNOWN_ROWS), KNOWN_BYTES):
        return None
    return [row[0] for row in table.select("token").collect()]


def one_valence(lexicon: DataFrame) -> DataFrame:
    """The lexicon with each token once; raises where a token has several valences."""
    table = lexicon.select("token", F.col("valence").cast("double").alias("valence")).where("token IS NOT NULL AND valence IS NOT NULL").distinct()
    twice = table.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("token").limit(3).collect()
    if twice:
        raise ValueError(f"tokens with several valences, for example {[row[0] for row in twice]}")
    return table


def affect_flags(lexicon: DataFrame, affects: Sequence[str]) -> DataFrame:
    """One row per token with one flag per affect.

    A list of the caller's own selects its affects; where the usual list would leave out one of the lexicon, it raises.
    """
    unknown = tuple(affects) == AFFECTS and lexicon.where(F.col("affect").isNotNull() & ~F.col("affect").isin(*affects)).select("affect").distinct().limit(3).collect()
    if unknown:
        raise ValueError(f"affects that are not listed, for example {[row[0] for row in unknown]}")
    flags = [F.max(F.coalesce(F.col("affect") == a, F.lit(False))).alias(f"_f{i}") for i, a in enumerate(affects)]
    return lexicon.where("token IS NOT NULL").groupBy("token").agg(*flags)


def with_copy(table: DataFrame) -> DataFrame:
    """The lookup table with a row for COPY, whose other columns are null."""
    extra = table.sparkSession.range(1).select(F.lit(COPY).alias("token"))
    return table.unionByName(extra, allowMissingColumns=True)


def text_key(text: Column) -> Column:
    """A digest that tells the texts of posts with the same id apart."""
    return F.md5(F.coalesce(text, F.lit("")))


def join_scores(posts: DataFrame, scores: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every post with the scores of its id and text, where there are any; null ids are ids like others."""
    named = scores.withColumnsRenamed({id_col: "_score_id", "_text_key": "_score_key"})
    same = F.col(id_col).eqNullSafe(F.col("_score_id")) & (F.col("_post_key") == F.col("_score_key"))
    return posts.withColumn("_post_key", text_key(F.col(text_col))).join(named, same, "left").drop("_post_key", "_score_id", "_score_key")


class Lexicon:
    """A lookup table keyed by ``token``, with one way of joining that is chosen once.

    A table within the bounds is broadcast. A larger one is joined by a shuffle in which every lexicon row is repeated
    once per salt and every token row takes the salt of its post. There are as many salts as shuffle partitions, so a
    token that holds a large share of all rows, and the rows whose token is null, are spread over all tasks.
    """

    def __init__(self, table: DataFrame, max_rows: int = BROADCAST_ROWS, salts: int | None = None):
        self.columns = [c for c in table.columns if c != "token"]
        self.small = fits_broadcast(table, max_rows)
        self.salts = salts or int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.table = table if self.small else table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1))))

    def join(self, rows: DataFrame, token: str, spread_by: Sequence[str], how: str = "inner", prefix: str = "", columns: Sequence[str] | None = None) -> DataFrame:
        """Add the lexicon columns (or those named), each with the prefix, to the rows whose ``token`` column matches."""
        columns = self.columns if columns is None else list(columns)
        kept = self.table.select("token", *columns, *([] if self.small else ["_salt"]))
        renamed = kept.withColumnsRenamed({c: prefix + c for c in [*columns, "token"]})
        key: Column = F.col(token) == F.col(f"{prefix}token")
        if self.small:
            joined = rows.join(F.broadcast(renamed), key, how)
        else:
            salted = rows.withColumn("_row_salt", F.pmod(F.xxhash64(*spread_by), F.lit(self.salts)).cast("int"))
            joined = salted.join(renamed, key & (F.col("_row_salt") == F.col("_salt")), how).drop("_row_salt", "_salt")
        return joined.drop(f"{prefix}token") if f"{prefix}token" != token else joined
