"""A reproducible shuffle by a keyed permutation of global row numbers; shard and slot are computed, not stored."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import keep, mix64, table, text_of

#: Rounds of the Feistel network.
ROUNDS = 6
SEED = 20240607
SHARDS = 8


def _half_bits(rows: int) -> int:
    """Bits of one half of the smallest balanced domain that holds all row numbers."""
    return max(1, (max(rows - 1, 1).bit_length() + 1) // 2)


def _round_value(half: np.ndarray, turn: int, seed: int, mask: np.uint64) -> np.ndarray:
    salt = np.uint64((seed * 0x9E3779B97F4A7C15 + (turn + 1) * 0xD1B54A32D192ED03) % (1 << 64))
    return mix64(half ^ salt) & mask


def permute(numbers: np.ndarray, rows: int, seed: int = SEED) -> np.ndarray:
    """The place of each row number in the shuffled order: a permutation of 0 .. rows - 1.

    A balanced Feistel network permutes the next even power of two, which is less than four times ``rows`` (or 4). A
    value that falls outside the row numbers is permuted again until it falls inside (cycle walking), which keeps the
    whole a permutation; four passes are expected at most.
    """
    return _walk(numbers, rows, seed, range(ROUNDS), forward=True)


def unpermute(places: np.ndarray, rows: int, seed: int = SEED) -> np.ndarray:
    """The row number that stands at each place: the inverse of ``permute``."""
    return _walk(places, rows, seed, range(ROUNDS - 1, -1, -1), forward=False)


def _walk(values: np.ndarray, rows: int, seed: int, turns: range, forward: bool) -> np.ndarray:
    bits = np.uint64(_half_bits(rows))
    mask = np.uint64((1 << int(bits)) - 1)
    out = np.asarray(values, dtype=np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> bits, out[todo] & mask
        for turn in turns:
            if forward:
                left, right = right, left ^ _round_value(right, turn, seed, mask)
            else:
                left, right = right ^ _round_value(left, turn, seed, mask), left
        out[todo] = (left << bits) | right
        todo = todo[out[todo] >= np.uint64(rows)]
    return out.astype(np.int64)


def row_at(shard: int, slot: int, rows: int, shards: int, seed: int = SEED) -> int:
    """The global row number that a shard holds at a slot."""
    return int(unpermute(np.array([slot * shards + shard]), rows, seed)[0])


def numbered(frame: DataFrame, order: list[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """The rows with global row numbers 0, 1, 2, ... in the order of ``order``, and how many there are, without a window
    over all rows.

    The rows are dealt out by range and written once; only the number of rows of each range is summed up, so no task
    sees more than its range. A range can't split equal values of the whole ``order``: give it columns that differ. Rows
    that are equal in ``order`` are numbered in any order among themselves.
    """
    ranged = frame.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    local = F.monotonically_increasing_id()
    shift = F.lit(1 << 33)
    saved = keep(
        ranged.withColumn("_shard_id", local).select(
            *frame.columns, F.floor(F.col("_shard_id") / shift).cast("int").alias("_shard_part"), (F.col("_shard_id") % shift).alias("_shard_at")
        ),
        "numbered",
    )
    counts = saved.groupBy("_shard_part").agg(F.count(F.lit(1)).alias("_shard_n"))
    base = F.coalesce(F.sum("_shard_n").over(Window.orderBy("_shard_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = counts.select("_shard_part", base.alias("_shard_base"))  # one row for each range
    rows = saved.join(F.broadcast(bases), "_shard_part").select(*frame.columns, (F.col("_shard_base") + F.col("_shard_at")).alias(name))
    return rows, saved.count()


def sharded(frame: DataFrame, order: list[str], shards: int, seed: int = SEED) -> DataFrame:
    """Add ``shard`` and ``slot`` to all rows: place p of the shuffled order is slot p div shards of shard p mod
    shards, so the row counts of two shards differ by one at most and the slots of a shard have no gap.

    Null keys come first. An empty frame stays empty. Equal rows get places of their own. Columns ``shard`` and ``slot``
    that ``frame`` already has are replaced; names that start with ``_shard_`` are reserved.
    """
    frame = frame.select(*[c for c in frame.columns if c.lower() not in ("shard", "slot") or c in order])
    rows, total = numbered(frame, order, "_shard_row")

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), total, seed))

    placed = rows.withColumn("_shard_place", place("_shard_row"))
    return placed.select(
        *frame.columns, (F.col("_shard_place") % shards).cast("int").alias("shard"), F.floor(F.col("_shard_place") / shards).cast("long").alias("slot")
    )


def text_size(column: str = "text") -> Column:
    """UTF-8 bytes of the text plus 1; 1 for null."""
    return (F.octet_length(text_of(column)) + 1).cast("long")


def text_crc(column: str = "text") -> Column:
    """Unsigned CRC-32 of the text's UTF-8 bytes; null counts as empty."""
    return F.crc32(text_of(column).cast("binary"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each row of ``docs``.

    The law is ``rows``. A null text counts as empty; rows with a null doc_id come first in the numbering; repeated rows
    have a slot each; other columns of ``docs`` are not read, whatever their names.
    """
    narrow = docs.select("doc_id", text_size().alias("size"), text_crc().alias("text_crc32"))
    placed = sharded(narrow, ["doc_id", "text_crc32", "size"], shards, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_feistel_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 8 shards."""
    return shard_documents(table(spark, folder, "documents"))


QUERIES = {"op3_feistel_sharding": op3_feistel_sharding}
ORACLES: dict[str, str] = {}
