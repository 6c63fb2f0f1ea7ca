"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.session import scratch_path

#: Bytes that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

#: Lower-cases A-Z and leaves every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Texts are worked on together until their bytes reach this size; a longer text is worked on alone, whole.
BATCH_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keep(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path, **options)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def text_key(column: str = "text") -> Column:
    """128 bits that tell texts apart, as a binary value of 16 bytes."""
    return F.unhex(F.md5(text_of(column)))


def over_texts(
    frame: DataFrame, work: Callable[[list, list[bytes]], Iterator[pa.RecordBatch]], schema: str, key: str, text: str = "text",
    limit: int = BATCH_BYTES,
) -> DataFrame:
    """Apply ``work(keys, texts)`` to the rows of each task in groups of about ``limit`` bytes, whole texts only."""
    rows = frame.select(F.col(key).alias("key"), text_of(text).cast("binary").alias("text"))

    def run(batches):
        keys, texts, size = [], [], 0
        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = t.as_py()
                if texts and size + len(data) > limit:
                    yield from work(keys, texts)
                    keys, texts, size = [], [], 0
                keys.append(k)
                texts.append(data)
                size += len(data)
        if texts:
            yield from work(keys, texts)

    return rows.mapInArrow(run, schema)


def keep_rows(docs: DataFrame, good: Callable[[list[bytes]], np.ndarray], text: str = "text") -> DataFrame:
    """The rows for whose texts ``good`` says so, with all columns as they are; a null text counts as empty."""
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            texts = [(t.as_py() or "").encode() for t in batch.column(at)]
            said, first, size = [], 0, 0
            for i, data in enumerate(texts):
                if i > first and size + len(data) > BATCH_BYTES:
                    said.append(good(texts[first:i]))
                    first, size = i, 0
                size += len(data)
            if texts:
                said.append(good(texts[first:]))
                yield batch.filter(pa.array(np.concatenate(said)))

    return docs.mapInArrow(run, docs.schema)


def joined(texts: list[bytes], gap: bytes = b"\n") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one array of bytes, each followed by ``gap``, with the start and the length of each."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    starts = np.concatenate(([0], np.cumsum(lengths + len(gap))[:-1])).astype(np.int64)
    return np.frombuffer(gap.join(texts) + gap, dtype=np.uint8), starts, lengths


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (multiply and shift rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of undirected edges (``a``, ``b``), both long: one row (``node``, ``component``) for each
    node of an edge, where ``component`` is the smallest node it can reach.

    Alternates large-star and small-star steps until nothing changes; every step is a partial minimum and a join, so a
    node with very many edges is never gathered into one task. Each round is written to the shared folder.
    """
    known = keep(
        edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        f"{name}-edges",
    )
    mark = None
    while True:
        state = known.agg(F.count(F.lit(1)).alias("n"), F.sum((F.xxhash64("a", "b") % F.lit(1 << 40)).cast("decimal(38,0)")).alias("h")).first()
        if state == mark or not state["n"]:
            return known.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                known.select(F.col("b"), F.col("b")).distinct()
            )
        mark = state
        both = known.union(known.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = keep(large, f"{name}-large")
        small = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        links = F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b")))
        known = keep(small.select(F.explode(links).alias("e")).select("e.a", "e.b").where("a != b").distinct(), f"{name}-small")
