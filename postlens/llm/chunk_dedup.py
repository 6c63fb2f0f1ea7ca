"""Substring deduplication: content-defined chunks by a gear rolling hash, deduplicated by digest."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import joined, keep, mix64, over_texts, table, text_of

#: Bytes of a chunk; on average a chunk is MIN_CHUNK + 2 ** CUT_BITS long.
MIN_CHUNK, MAX_CHUNK, CUT_BITS = 16, 128, 4
#: A stretch of repeated chunks is removed from this many bytes on. One or two short chunks also repeat by chance.
#: A text that is shorter and an exact copy of another is removed whole.
MIN_SPAN = 64
#: Tells the digest of a short text from that of an equal chunk.
WHOLE = 1
#: Bytes that decide whether a chunk may end: the width of the gear hash.
WIDTH = 32

GEAR = (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The gear hash after each byte, and starts and lengths of the texts in the common array.

    The hash shifts left by one for each byte and adds a random number for it, so 32 bits forget what lies more than 32
    bytes back. Here the sum is built by doubling its width, for all bytes at once. Gaps between the texts add nothing.
    """
    data, starts, lengths = joined(texts, b"\0" * WIDTH)
    sums = GEAR[data]
    for start, length in zip(starts, lengths):
        sums[start + length : start + length + WIDTH] = 0
    for shift in (1, 2, 4, 8, 16):
        sums[shift:] += sums[:-shift] << np.uint32(shift)
    return sums, starts, lengths


def chunk_ends(marks: np.ndarray, length: int) -> list[int]:
    """Ends of the chunks of a text, from the places after which the hash would let one end.

    Each chunk ends at the first mark that makes it MIN_CHUNK long, or after MAX_CHUNK bytes, or with the text.
    """
    ends, last = [], 0
    for mark in marks.tolist():
        while mark - last > MAX_CHUNK:
            last += MAX_CHUNK
            ends.append(last)
        if mark - last >= MIN_CHUNK:
            last = mark
            ends.append(last)
    while length - last > MAX_CHUNK:
        last += MAX_CHUNK
        ends.append(last)
    if length > last:
        ends.append(length)
    return ends


def chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, end, digest) of all chunks; digest has two long columns (128 bits)."""
    sums, starts, lengths = gear_hashes(texts)
    marks = np.flatnonzero(sums >> np.uint32(32 - CUT_BITS) == 0) + 1
    cut = np.searchsorted(marks, np.concatenate((starts, starts + lengths)), side="right").reshape(2, -1)
    owner, ends, digests = [], [], []
    for i, text in enumerate(texts):
        found = chunk_ends(marks[cut[0, i] : cut[1, i]] - starts[i], len(text))
        owner += [i] * len(found)
        ends += found
        digests += [xxhash.xxh3_128_digest(text[a:b]) for a, b in zip([0, *found], found)]
    return np.array(owner, dtype=np.int64), np.array(ends, dtype=np.int64), np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)


def _first_in_text(owner: np.ndarray, digest: np.ndarray) -> np.ndarray:
    order = np.lexsort((digest[:, 1], digest[:, 0], owner))
    rows = np.column_stack((owner, digest))[order]
    first = np.ones(len(owner), dtype=bool)
    first[order[1:]] = (rows[1:] != rows[:-1]).any(axis=1)  # the sort is stable: the first of equal rows comes first
    return first


def _whole(text: bytes) -> np.ndarray:
    return np.frombuffer(xxhash.xxh3_128_digest(text, seed=WHOLE), dtype=np.int64)


def _emitter(least: int):
    """The distinct chunks of each text, and the whole text if it is shorter than ``least``."""

    def work(keys, texts):
        owner, _, digest = chunks(texts)
        if len(owner):
            first = _first_in_text(owner, digest)
            short = [i for i, text in enumerate(texts) if 0 < len(text) < least]
            ids = np.array(keys, dtype=np.int64)[np.concatenate((owner[first], np.array(short, dtype=np.int64)))]
            found = np.concatenate((digest[first], *(_whole(texts[i])[None] for i in short)))
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1]), pa.array(ids)], names=["a", "b", "id"])

    return work


def _stretches(owner: np.ndarray, ends: np.ndarray, marked: np.ndarray, least: int) -> np.ndarray:
    """Which chunks belong to runs of marked chunks of ``least`` bytes or more."""
    starts = np.where(np.concatenate(([True], owner[1:] != owner[:-1])), 0, np.concatenate(([0], ends[:-1])))
    run = np.cumsum(np.concatenate(([True], (owner[1:] != owner[:-1]) | (marked[1:] != marked[:-1]))))
    size = np.bincount(run, weights=ends - starts)
    return marked & (size[run] >= least)


_RESULT = "key long, n_bytes long, n_chunks long, n_repeated long, n_removed long, n_spans long, kept binary"


def _remover(least: int):
    """Per text: what its repeated chunks (a binary list of digests, with a flag for those first seen elsewhere) leave."""

    def work(keys, texts):
        owner, ends, digest = chunks(texts)
        first = _first_in_text(owner, digest) if len(owner) else np.empty(0, bool)
        out = []
        at = np.searchsorted(owner, np.arange(len(texts) + 1))
        for i, (key, text) in enumerate(zip(keys, texts)):
            a, b = at[i], at[i + 1]
            listed = {(r["a"], r["b"]): r["later"] for r in key["listed"] or ()}
            known = [listed.get(tuple(d)) for d in digest[a:b].tolist()]
            later = np.array([k is True for k in known], dtype=bool) | ~first[a:b]
            shared = np.array([k is not None for k in known], dtype=bool) | ~first[a:b]
            mine, end = owner[a:b], ends[a:b]
            gone = _stretches(mine, end, later, least) if b > a else later
            again = _stretches(mine, end, shared, least) if b > a else shared
            if 0 < len(text) < least and (whole := listed.get(tuple(_whole(text).tolist()))) is not None:
                gone, again = gone | whole, np.ones(b - a, dtype=bool)
            start = np.concatenate(([0], end[:-1])) if b > a else end
            size = end - start
            out.append(
                {"key": key["doc_id"], "n_bytes": len(text), "n_chunks": int(b - a), "n_repeated": int(size[again].sum()), "n_removed": int(size[gone].sum()),
                 "n_spans": int((gone & ~np.concatenate(([False], gone[:-1]))).sum()) if b > a else 0,
                 "kept": b"".join(text[x:y] for x, y, g in zip(start.tolist(), end.tolist(), gone.tolist()) if not g)}
            )
        yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    return work


_ARROW = pa.schema([(n, pa.binary() if t == "binary" else pa.int64()) for n, t in (x.split(" ") for x in _RESULT.split(", "))])
_LAST = (1 << 63) - 1


def dedup_chunks(docs: DataFrame, least: int = MIN_SPAN) -> DataFrame:
    """doc_id, n_bytes, n_chunks, n_repeated, n_removed, n_spans, kept (bytes) of each row of ``docs`` (doc_id, text).

    Of equal chunks the one in the smallest doc_id stays (a null id is the largest), within a text the first; runs of
    other copies of ``least`` bytes or more are removed, shorter ones stay unless they are a whole text that equals another
    whole text. n_repeated counts the bytes of such runs and texts whose chunks occur more than once anywhere, removed or
    not. A null text counts as empty. Rows with equal doc_id count as
    one document for the choice of the copy that stays. Other columns are not read.
    """
    rows = docs.select(F.coalesce(F.col("doc_id"), F.lit(_LAST)).alias("id"), "doc_id", text_of().alias("text"))
    every = over_texts(rows, _emitter(least), "a long, b long, id long", "id")
    again = every.groupBy("a", "b").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    again = keep(again.select("a", "b", "least"), "repeated-chunks")
    marked = every.join(again, ["a", "b"]).select("id", F.struct("a", "b", (F.col("id") > F.col("least")).alias("later")).alias("chunk"))
    listed = marked.groupBy("id").agg(F.collect_list("chunk").alias("listed"))  # at most the chunks of one document
    texts = rows.join(listed, "id", "left").select(F.struct("doc_id", "listed").alias("key"), "text")
    return over_texts(texts, _remover(least), _RESULT, "key").withColumnRenamed("key", "doc_id")


def op1_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents; the text that stays as its digest."""
    found = dedup_chunks(table(spark, folder, "documents"))
    return found.select(*[c for c in found.columns if c != "kept"], F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op1_chunk_dedup": op1_chunk_dedup}
ORACLES: dict[str, str] = {}
