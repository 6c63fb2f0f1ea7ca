"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds the hash of each of its beginnings modulo a prime. The difference of two entries, divided
by a power of the base, is the hash of the span between them, so any two spans are compared in constant time and the
longest common extension of two places is found by binary search. A fingerprint is a short excerpt of the prefix array: the
hash of the whole text, those of beginnings and endings of fixed lengths, and the least hashes of all spans of SPAN code
points.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import keep, mix64, table, text_of

#: Two primes just below 2**31 and a base for each: together they tell texts apart by 62 bits.
PRIMES, BASES = (2147483647, 2147483629), (1103515245, 1664525019)
_INVERSE = {base: pow(base, -1, prime) for prime, base in zip(PRIMES, BASES)}
#: Code points of a sampled span, and how many samples a fingerprint holds.
SPAN, SAMPLES = 24, 32
#: Code points of a text whose prefix arrays are held at a time (about 60 bytes each).
PIECE = 1 << 19
#: Lengths of the beginnings and endings in a fingerprint, four for each doubling; 16 bits are stored of each hash.
MARKS = np.array([(4 + k % 4) << (k // 4 + 1) for k in range(180)], dtype=np.int64)


def _powers(base: int, prime: int, count: int, held: dict = {}) -> np.ndarray:  # noqa: B006
    """base ** 0, 1, 2, ... modulo the prime, by doubling; what was computed is held, up to PIECE + SPAN entries."""
    row = held.get((base, prime), np.ones(1, np.uint64))
    while len(row) < count:
        row = np.concatenate((row, row * np.uint64(pow(base, len(row), prime)) % np.uint64(prime)))
    if count <= 2 * PIECE:
        held[base, prime] = row
    return row[:count]


def _undo(base: int, prime: int, exponents: np.ndarray) -> np.ndarray:
    """base ** -exponents modulo the prime."""
    inverse = _INVERSE[base]
    rounds, rest = np.divmod(exponents, PIECE)
    out = _powers(inverse, prime, int(rest.max(initial=0)) + 1)[rest]
    for k in np.unique(rounds[rounds > 0]).tolist():
        out[rounds == k] = out[rounds == k] * np.uint64(pow(inverse, k * PIECE, prime)) % np.uint64(prime)
    return out


class PrefixHashes:
    """The prefix arrays of one text; places and lengths are in code points and may be arrays."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        self.size = len(codes)
        self.prefix, self.inverse = [], []
        for prime, base in zip(PRIMES, BASES):
            p = np.uint64(prime)
            sums = np.zeros(self.size + 1, np.uint64)
            np.cumsum(codes * _powers(base, prime, self.size) % p, out=sums[1:])
            self.prefix.append(sums % p)
            self.inverse.append(_powers(_INVERSE[base], prime, self.size + 1))

    def spans(self, start, length) -> np.ndarray:
        """The 62-bit hashes of the spans; equal strings have equal hashes wherever they are."""
        start = np.asarray(start, np.int64)
        end = start + length
        parts = [(s[end] + np.uint64(p) - s[start]) * v[start] % np.uint64(p) for s, v, p in zip(self.prefix, self.inverse, PRIMES)]
        return (parts[0] << np.uint64(31)) | parts[1]


def common_extension(one: PrefixHashes, start, other: PrefixHashes, at) -> np.ndarray:
    """For each pair of places, how many code points from there on agree, by binary search over the length."""
    start, at = np.atleast_1d(np.asarray(start, np.int64)), np.atleast_1d(np.asarray(at, np.int64))
    low, high = np.zeros(len(start), np.int64), np.minimum(one.size - start, other.size - at)
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = one.spans(start, middle) == other.spans(at, middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def fingerprint(text: str) -> str:
    """The fingerprint of a text, the same for equal texts; a long text is gone through in pieces."""
    size = len(text)
    marks = MARKS[: np.searchsorted(MARKS, size, side="right")]
    places = np.concatenate(([size], marks, size - marks))
    values = np.zeros((2, len(places)), dtype=np.uint64)
    samples = np.empty(0, np.uint32)
    before, shift = [0, 0], [1, 1]
    for first in range(0, max(size, 1), PIECE):
        piece = PrefixHashes(text[first : first + PIECE + SPAN - 1])
        length = min(PIECE, size - first)
        inside = np.flatnonzero((places >= first) & (places <= first + length))
        for k, prime in enumerate(PRIMES):
            local = piece.prefix[k][places[inside] - first]
            values[k, inside] = (np.uint64(before[k]) + np.uint64(shift[k]) * local) % np.uint64(prime)
            before[k] = (before[k] + shift[k] * int(piece.prefix[k][length])) % prime
            shift[k] = shift[k] * pow(BASES[k], length, prime) % prime
        count = min(length, size - first - SPAN + 1)
        if count > 0:
            mixed = (mix64(piece.spans(np.arange(count), SPAN)) >> np.uint64(32)).astype(np.uint32)
            mixed = np.sort(np.concatenate((samples, mixed)))
            samples = mixed[np.concatenate(([True], mixed[1:] != mixed[:-1]))][:SAMPLES]
    whole = (int(values[0, 0]) << 31) | int(values[1, 0])
    begins = values[:, 1 : 1 + len(marks)]
    ends = np.empty_like(begins)
    for k, (prime, base) in enumerate(zip(PRIMES, BASES)):
        undo = _undo(base, prime, size - marks)
        ends[k] = (values[k, 0] + np.uint64(prime) - values[k, 1 + len(marks) :]) * undo % np.uint64(prime)
    short = [(mix64((h[0] << np.uint64(31)) | h[1]) & np.uint64(0xFFFF)).astype("<u2").tobytes() for h in (begins, ends)]
    if 0 < size < SPAN:
        samples = np.array([int(mix64(np.array([whole], np.uint64))[0]) >> 32], np.uint32)
    raw = size.to_bytes(8, "big") + whole.to_bytes(8, "big") + short[0] + short[1] + samples.astype("<u4").tobytes()
    return base64.b64encode(raw).decode()


def _equal_marks(one: bytes, other: bytes, marks: np.ndarray) -> int:
    """The longest mark up to which both agree, by binary search: texts that agree up to a mark agree at all before it."""
    low, high = 0, len(marks)
    while low < high:
        middle = (low + high + 1) // 2
        if one[2 * middle - 2 : 2 * middle] == other[2 * middle - 2 : 2 * middle]:
            low = middle
        else:
            high = middle - 1
    return int(marks[low - 1]) if low else 0


def likeness(one: str, other: str) -> float:
    """How alike two texts are by their fingerprints, 0 to 1, and 1 only for equal ones.

    The greater of two shares: what the common beginning and the common ending make up of the longer text (rounded down to
    marks), and the common ones among the least span hashes, an estimate of the Jaccard similarity of all their spans.
    """
    if one == other:
        return 1.0
    a, b = base64.b64decode(one), base64.b64decode(other)
    n, m = int.from_bytes(a[:8], "big"), int.from_bytes(b[:8], "big")
    if not n or not m:
        return 0.0
    counts = [int(np.searchsorted(MARKS, s, side="right")) for s in (n, m)]
    marks = MARKS[: min(counts)]
    begin = _equal_marks(a[16:], b[16:], marks)
    end = _equal_marks(a[16 + 2 * counts[0] :], b[16 + 2 * counts[1] :], marks)
    extended = min(begin + end, n, m) / max(n, m)
    left, right = (np.frombuffer(x[16 + 4 * c :], "<u4") for x, c in ((a, counts[0]), (b, counts[1])))
    left, right = set(left.tolist()), set(right.tolist())
    least = sorted(left | right)[:SAMPLES]
    shared = sum(x in left and x in right for x in least) / len(least)
    return float(min(max(extended, shared), max(n, m) / (max(n, m) + 1)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint of each row of ``docs``; no row is moved. A null text counts as empty."""
    kind = dict(docs.dtypes)["doc_id"]

    def work(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(map(fingerprint, texts), pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(work, f"doc_id {kind}, n_chars long, fingerprint string")


def common_extensions(pairs: DataFrame) -> DataFrame:
    """Add ``extension`` to rows (left, left_at, right, right_at): how many code points of both texts agree from the given
    places on; 0 for a null or a place outside of its text."""

    @F.pandas_udf("long")
    def measure(left: pd.Series, left_at: pd.Series, right: pd.Series, right_at: pd.Series) -> pd.Series:
        out = []
        for a, i, b, j in zip(left, left_at, right, right_at):
            fits = a is not None and b is not None and not pd.isna(i) and not pd.isna(j) and 0 <= i <= len(a) and 0 <= j <= len(b)
            out.append(int(common_extension(PrefixHashes(a), int(i), PrefixHashes(b), int(j))[0]) if fits else 0)
        return pd.Series(out, dtype="int64")

    return pairs.withColumn("extension", measure("left", "left_at", "right", "right_at"))


def _edited(text: str, following: str) -> str:
    last = len(text) // 4
    return text[: len(text) - last] + following[:last]


def _judged(text: str, own: str, following: str, next_own: str) -> tuple:
    """edited_sha256, edited_fingerprint, near_edited, near_next"""
    edited = _edited(text, following)
    mark = fingerprint(edited)
    return hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), mark, likeness(own, mark), likeness(own, next_own)


_RESULT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = ["doc_id", *(c.split(" ")[0] for c in _RESULT.split(", "))]


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row of ``docs``.

    The edited text has its last quarter (floor of n_chars / 4) replaced by as many code points from the start of the next
    document's, or all it has; the next of the last document is the first. Documents follow each other by doc_id, null
    first, then by the hash of the text; so equal rows may stand in any order. A null text counts as empty; a text of
    fewer than 4 code points is its own edited text. Other columns are not read.

    The rows are dealt out by range once, ties by their place as well. Each task compares its neighbouring rows and hands
    on its first and last one; those are joined afterwards, one row for each task.
    """
    kind = dict(docs.dtypes)["doc_id"]
    order = ["doc_id", "_hash", "_place"]
    rows = docs.select("doc_id", text_of().alias("text")).withColumns({"_hash": F.xxhash64("text"), "_place": F.monotonically_increasing_id()})
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("part"), "doc_id", "text")

    def work(batches):
        last = None
        for batch in batches:
            parts, ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            out = []
            for part, own, text in zip(parts, ids, texts):
                mark = fingerprint(text)
                if last:
                    sha, edited, near, following = _judged(last[2], last[3], text, mark)
                    out.append((last[1], len(last[2]), sha, last[3], edited, near, following, part, None, None))
                else:
                    out.append((None, None, None, mark, None, None, None, part, "head", text))
                last = (part, own, text, mark)
            yield _batch(out)
        if last:
            yield _batch([(last[1], len(last[2]), None, last[3], None, None, None, last[0], "tail", last[2])])

    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    arrow = pa.schema([("doc_id", types[kind]), ("n_chars", pa.int64()), *((c, pa.string()) for c in _NAMES[2:5]), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("part", pa.int32()), ("edge", pa.string()), ("text", pa.string())])

    def _batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    saved = keep(ranged.mapInArrow(work, f"doc_id {kind}, {_RESULT}, part int, edge string, text string"), "fingerprints", compression="zstd")
    heads = saved.where("edge = 'head'").select(F.col("part").alias("next"), F.col("fingerprint").alias("next_fingerprint"), F.col("text").alias("next_text"))
    tails = saved.where("edge = 'tail'").select("part", "doc_id", "n_chars", "fingerprint", "text")
    around = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.first("part").over(around))  # one row for each task
    ends = tails.join(tails.select("part", following.alias("next")), "part").join(heads, "next")

    def finish(batches):
        for batch in batches:
            columns = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            found = [_judged(*x) for x in zip(columns["text"], columns["fingerprint"], columns["next_text"], columns["next_fingerprint"])]
            if found:
                sha, edited, near, after = map(list, zip(*found))
                out = [columns["doc_id"], columns["n_chars"], sha, columns["fingerprint"], edited, near, after]
                yield pa.RecordBatch.from_arrays([pa.array(c, arrow.field(n).type) for c, n in zip(out, _NAMES)], names=_NAMES)

    return saved.where("edge is null").select(_NAMES).union(ends.mapInArrow(finish, f"doc_id {kind}, {_RESULT}"))


def op11_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, each against its edited text and the next one."""
    return fingerprint_edits(table(spark, folder, "documents"))


QUERIES = {"op11_fingerprints": op11_fingerprints}
ORACLES: dict[str, str] = {}
