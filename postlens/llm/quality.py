"""Quality by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import LOWER, SPACE, joined, keep_rows, over_texts, table

#: Labelled rows that the model holds at most; the rows with the smallest hash of their doc_id are taken.
SAMPLE = 4000
#: Hashed terms and latent dimensions.
TERMS, DIMENSIONS = 1024, 48
#: Neighbours that vote: all labelled vectors do, with the weight exp(SHARPNESS * (cosine - 1)).
SHARPNESS = 40.0
THRESHOLD = 0.3
#: Documents in one block of cosine products.
BLOCK = 1024


def _byte_class() -> np.ndarray:
    """Fifteen classes of bytes: what a character is, not which letter it is."""
    kind = np.full(256, 14, dtype=np.uint32)
    kind[ord("a") : ord("z") + 1] = 0
    kind[ord("A") : ord("Z") + 1] = 1
    kind[ord("0") : ord("9") + 1] = 2
    kind[128:] = 3
    for i, group in enumerate((" \t\v\f", "\n\r", ".", ",", "!?", "'\"`", "-_", "@#$%&*", "|/\\", "()[]{}<>"), 4):
        kind[[ord(c) for c in group]] = i
    return kind


CLASS = _byte_class()


def term_counts(texts: list[bytes]) -> np.ndarray:
    """Hashed term counts of each whole text. Terms are runs of four byte classes, the shapes of words (length, classes
    of the first and last byte), and whether a word equals one of the seven words before it."""
    data, starts, lengths = joined(texts)
    owner = np.repeat(np.arange(len(texts)), lengths + 1)
    kind = CLASS[data].astype(np.int64)
    # a long run of small letters counts as one term
    gram = kind[:-3] * 3375 + kind[1:-2] * 225 + kind[2:-1] * 15 + kind[3:] if len(data) > 3 else np.empty(0, np.int64)
    inside = owner[:-3] == owner[3:] if len(data) > 3 else np.empty(0, bool)
    half = TERMS // 2
    hashed = (gram * 2654435761 >> 7) % half
    counts = np.bincount(owner[: len(hashed)][inside] * TERMS + hashed[inside], minlength=len(texts) * TERMS).reshape(len(texts), TERMS).astype(np.float64)

    blank = SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank)).astype(np.int8)))
    first, end = edge[0::2], edge[1::2]
    if len(first):
        low = LOWER[data].astype(np.uint64)
        total = np.concatenate(([0], np.cumsum(low * (low + np.uint64(31)) * np.uint64(2654435761)))).astype(np.uint64)
        word = total[end] - total[first] + (end - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        whose = owner[first]
        shape = (np.minimum(end - first, 24) * 225 + kind[first] * 15 + kind[end - 1]).astype(np.int64)
        terms = [half + (shape * 2654435761 >> 5) % (half - 16)]
        owners = [whose]
        for back in range(1, 8):
            same = (word[back:] == word[:-back]) & (whose[back:] == whose[:-back])
            terms.append(np.full(int(same.sum()), TERMS - 16 + back))
            owners.append(whose[back:][same])
        counts += np.bincount(np.concatenate(owners) * TERMS + np.concatenate(terms), minlength=len(texts) * TERMS).reshape(len(texts), TERMS)
    return counts


def weighted(counts: np.ndarray, idf: np.ndarray | None = None) -> np.ndarray:
    """Rates of the terms, damped by a square root, times their weights, as unit vectors (zero for an empty text)."""
    half = TERMS // 2
    out = counts.copy()
    for part in (slice(0, half), slice(half, TERMS - 16)):
        out[:, part] /= np.maximum(out[:, part].sum(axis=1, keepdims=True), 1)
    out[:, TERMS - 16 :] /= np.maximum(counts[:, half : TERMS - 16].sum(axis=1, keepdims=True), 1)
    out = np.sqrt(out)
    return _unit(out if idf is None else out * idf)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


@dataclass(frozen=True)
class Model:
    """Weights of the terms, the projection to the latent space, and the labelled vectors there. At most
    (TERMS + SAMPLE) * DIMENSIONS numbers, about 1 MB. Spark broadcasts it whole with the function that uses it."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, counts: np.ndarray) -> np.ndarray:
        return _unit(weighted(counts, self.idf) @ self.axes).astype(np.float32)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """The share of label 1 in the votes; the mean label for a text without any term, or if no label is known."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        out = np.empty(len(counts))
        for at in range(0, len(counts), BLOCK):
            cosine = self.project(counts[at : at + BLOCK]) @ self.vectors.T
            votes = np.exp(SHARPNESS * (cosine - cosine.max(axis=1, keepdims=True))).astype(np.float64)
            out[at : at + BLOCK] = votes @ self.labels / votes.sum(axis=1)
        return np.where(counts.sum(axis=1) > 0, np.clip(out, 0, 1), self.labels.mean())


def labelled_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """doc_id, text and quality of the training rows: those whose crc32(doc_id) mod 5 is not 0, ``size`` at most.

    A doc_id that labels mark both ways, or that has no label, is left out; so are null ids.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    known = known.where("quality = other and not ({})".format(HELD_OUT)).select("doc_id", "quality")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    texts = docs.select("doc_id", "text").where("doc_id is not null")
    return texts.join(F.broadcast(chosen), "doc_id")  # at most SAMPLE short rows


HELD_OUT = "crc32(cast(cast(doc_id as string) as binary)) % 5 = 0"


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Model:
    """Fit the latent space (a truncated singular value decomposition of the weighted terms) on the labelled sample."""
    sample = labelled_sample(docs, labels, size)

    def count(keys, texts):
        counts = term_counts(texts)
        yield pa.RecordBatch.from_pydict(
            {"quality": pa.array([k["quality"] for k in keys], pa.int32()), "doc_id": pa.array([k["doc_id"] for k in keys], pa.int64()),
             "counts": pa.array([c.astype(np.float32).tobytes() for c in counts], pa.binary())}
        )

    rows = over_texts(sample.withColumn("k", F.struct("doc_id", "quality")), count, "quality int, doc_id long, counts binary", "k")
    got = rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.crc32("counts")).limit(size).toPandas()  # SAMPLE rows of 4 KB
    if not len(got):
        return Model(np.ones(TERMS), np.zeros((TERMS, 1)), np.zeros((0, 1), np.float32), np.zeros(0))
    kept = got["counts"].tolist()

    def blocks():  # a few rows at a time as doubles, so that the driver holds little beside the sample itself
        for at in range(0, len(kept), BLOCK):
            yield np.frombuffer(b"".join(kept[at : at + BLOCK]), dtype=np.float32).reshape(-1, TERMS).astype(np.float64)

    idf = np.log((1 + len(kept)) / (1 + sum((counts > 0).sum(axis=0) for counts in blocks()))) + 0.3
    gram = np.zeros((TERMS, TERMS))
    for counts in blocks():
        terms = weighted(counts, idf)
        gram += terms.T @ terms
    axes = np.linalg.eigh(gram)[1][:, ::-1][:, :DIMENSIONS].copy()
    vectors = np.concatenate([_unit(weighted(counts, idf) @ axes).astype(np.float32) for counts in blocks()])
    return Model(idf, axes, vectors, got["quality"].to_numpy(np.float64))


def scored(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(``key``, score) of each row of ``docs``, from its whole text alone."""
    kind = dict(docs.dtypes)[key]

    def work(keys, texts):
        yield pa.RecordBatch.from_arrays([pa.array(keys, _ARROW[kind]) if kind in _ARROW else pa.array(keys), pa.array(model.score(term_counts(texts)))], names=[key, "score"])

    return over_texts(docs, work, f"`{key}` {kind}, score double", key)


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of ``docs``.

    A null text counts as empty and scores the mean label; equal texts score alike; a null doc_id is scored and not held
    out. Without any labelled row every score is 0.5. Only doc_id and text of ``docs`` are read.
    """
    scores = scored(docs, fit(docs, labels))
    return scores.select(
        "doc_id", F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score THRESHOLD or more, with all their columns; no row is moved."""
    return keep_rows(docs, lambda texts, model=fit(docs, labels): model.score(term_counts(texts)) >= THRESHOLD)


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored by the labelled documents."""
    return judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES = {"op5_quality": op5_quality}
ORACLES: dict[str, str] = {}
