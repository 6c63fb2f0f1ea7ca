"""Benchmark decontamination by q-gram lemma filtering and banded alignment."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import keep_rows, over_texts, table

#: Characters of a q-gram. All lengths are bytes of the normalised text (``normalised``).
GRAM = 10
#: A short window starts at each word of an item, and at every STEP bytes within a longer word. It ends after WORDS words,
#: but has LEAST to WINDOW bytes. So a copied passage of WORDS words and LEAST bytes, or of WINDOW bytes from the start of
#: a word on, or of WINDOW + STEP bytes wherever it is cut, holds one.
WORDS, LEAST, WINDOW, STEP = 12, 40, 60, 10
#: Long windows of LONG bytes at every LONG_STEP bytes; an item of up to LONG bytes is one. They find copies whose edits stand
#: closer together than a short window may have them.
LONG, LONG_STEP = 120, 60
#: Edits that a window may have, as a share of its length.
EDITS = 1 / 15
#: Diagonals of a band before its overlap with the next, which is the largest number of edits.
BAND = 16
#: Bytes of benchmark text whose index is broadcast at a time; a larger benchmark is worked through in several passes.
BLOCK_BYTES = 2 << 20
_BITS = 20

_KEEP = np.zeros(256, dtype=np.uint8)
_KEEP[:] = 32
for _first, _last in ((ord("0"), ord("9")), (ord("a"), ord("z")), (128, 255)):
    _KEEP[_first : _last + 1] = np.arange(_first, _last + 1)


def normalised(text: bytes) -> bytes:
    """Lower case, with each run of characters that are no letters or digits as one space, without outer spaces.
    Any character beyond ASCII counts as a letter."""
    data = _KEEP[np.frombuffer(text.decode("utf-8", "replace").lower().encode(), dtype=np.uint8)]
    if not len(data):
        return b""
    blank = data == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    return data[keep].tobytes().strip(b" ")


def gram_codes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes that start at each position."""
    if len(data) < GRAM:
        return np.empty(0, np.uint64)
    two = data[:-1].astype(np.uint64) | (data[1:].astype(np.uint64) << np.uint64(8))
    four = two[:-2] | (two[2:] << np.uint64(16))
    eight = four[:-4] | (four[4:] << np.uint64(32))
    n = len(data) - GRAM + 1
    return (eight[:n] * np.uint64(0x9E3779B97F4A7C15)) ^ (two[8 : 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F))


def _slot(codes: np.ndarray) -> np.ndarray:
    return ((codes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - _BITS)).astype(np.int64)


@dataclass(frozen=True)
class Index:
    """Windows of benchmark items and where their q-grams stand in them."""

    items: np.ndarray  # row of the item of each window
    names: list  # item_id by row
    at: np.ndarray  # offset of the window in its item
    windows: np.ndarray  # (windows, LONG) bytes, zero beyond the length
    lengths: np.ndarray
    edits: np.ndarray  # edits allowed
    bound: np.ndarray  # shared q-grams that a match has at least
    codes: np.ndarray  # distinct, ascending
    first: np.ndarray  # first place of each code in ``window`` and ``offset``, and the end
    window: np.ndarray
    offset: np.ndarray
    seen: np.ndarray  # one flag for each slot


def spans(data: bytes) -> list[tuple[int, int]]:
    """Start and end of the windows of a normalised item."""
    last = max(0, len(data) - LONG)
    found = {(s, min(s + LONG, len(data))) for s in (*range(0, last, LONG_STEP), last)}
    blanks = [i for i, c in enumerate(data) if c == 32]
    ends = [*blanks, len(data)]
    for word, (start, end) in enumerate(zip([0, *(i + 1 for i in blanks)], ends)):
        full = ends[word + WORDS - 1] if word + WORDS <= len(ends) else len(data) + WINDOW
        for s in range(start, end, STEP):
            e = min(max(full, s + LEAST), s + WINDOW)
            if e <= len(data):
                found.add((s, e))
    return sorted(found)


def build_index(items: list[tuple]) -> Index:
    """The index of (item_id, text) rows. Items of fewer than GRAM normalised bytes say nothing and are left out."""
    names, rows, at, windows, codes = [], [], [], [], [np.empty(0, np.uint64)]
    for name, text in items:
        data = normalised((text or "").encode())
        if len(data) < GRAM:
            continue
        grams = gram_codes(np.frombuffer(data, np.uint8))
        for start, end in spans(data):
            rows.append(len(names))
            at.append(start)
            windows.append(data[start:end])
            codes.append(grams[start : end - GRAM + 1])
        names.append(name)
    lengths = np.array([len(w) for w in windows], dtype=np.int64)
    matrix = np.frombuffer(b"".join(w.ljust(LONG, b"\0") for w in windows), np.uint8).reshape(-1, LONG)
    codes, counts = np.concatenate(codes), lengths - GRAM + 1
    window = np.repeat(np.arange(len(windows), dtype=np.int32), counts)
    offset = (np.arange(len(codes)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.int16)
    order = np.argsort(codes, kind="stable")
    distinct, first = np.unique(codes[order], return_index=True)
    edits = np.floor(lengths * EDITS).astype(np.int64)
    # the bound must be positive; a shorter window gets fewer edits
    edits = np.minimum(edits, np.maximum(0, (lengths - GRAM) // GRAM))
    seen = np.zeros(1 << _BITS, dtype=bool)
    seen[_slot(distinct)] = True
    return Index(
        np.array(rows, dtype=np.int64), names, np.array(at, dtype=np.int64), matrix, lengths, edits, lengths + 1 - GRAM * (edits + 1),
        distinct, np.append(first, len(codes)), window[order], offset[order], seen,
    )


def _regions(data: np.ndarray, index: Index, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, band) pairs that share enough q-grams: band b has the diagonals from b * BAND on, BAND + overlap of them.

    A match with at most ``overlap`` edits keeps to as many diagonals, so one band holds all of its shared q-grams, of
    which there are at least length + 1 - GRAM * (edits + 1).
    """
    codes = gram_codes(data)
    places = np.flatnonzero(index.seen[_slot(codes)])
    found = np.searchsorted(index.codes, codes[places])
    found[found == len(index.codes)] = 0
    same = index.codes[found] == codes[places]
    places, found = places[same], found[same]
    times = index.first[found + 1] - index.first[found]
    hit = np.repeat(index.first[found] - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum())
    window = index.window[hit].astype(np.int64)
    diagonal = np.repeat(places, times) - index.offset[hit] + LONG
    band = diagonal // BAND
    also = diagonal - band * BAND < overlap  # in the overlap with the band before
    bands = len(data) // BAND + 2 * LONG
    keys, counts = np.unique(np.concatenate((window * bands + band, window[also] * bands + band[also] - 1)), return_counts=True)
    window, band = keys // bands, keys % bands
    enough = counts >= index.bound[window]
    return window[enough], band[enough] * BAND - LONG


def _aligned(data: np.ndarray, index: Index, window: np.ndarray, diagonal: np.ndarray, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """Least edits between each window and any part of the text within its band, and where that part ends."""
    width = BAND + 3 * overlap
    column = np.arange(width)
    pad = LONG + width
    padded = np.concatenate((np.zeros(pad, np.uint8), data, np.zeros(pad + width, np.uint8)))
    text = padded[(diagonal - overlap + pad)[:, None] + np.arange(LONG + width)]
    pattern, lengths = index.windows[window], index.lengths[window]
    costs = np.zeros((len(window), width), np.int32)
    best, end = np.zeros(len(window), np.int64), np.zeros(len(window), np.int64)
    for row in range(int(lengths.max(initial=0))):
        changed = costs + (text[:, row : row + width] != pattern[:, row][:, None])
        changed[:, :-1] = np.minimum(changed[:, :-1], costs[:, 1:] + 1)
        costs = np.minimum.accumulate(changed - column, axis=1) + column
        done = np.flatnonzero(lengths == row + 1)
        if len(done):
            at = costs[done].argmin(axis=1)
            best[done] = costs[done, at]
            end[done] = diagonal[done] - overlap + at + row + 1
    return best, end


def find_leaks(texts: list[bytes], index: Index) -> list[tuple[int, int, int, int, int, int]]:
    """(text, item row, windows, start, end, edits) for each pair of a text and an item with a window in common: how many
    windows, the stretch of the normalised text from the first to the last, and the fewest edits."""
    if not len(index.lengths):
        return []
    overlap = int(index.edits.max())
    gap = b"\0" * (overlap + GRAM + 1)  # more edits than any match may have
    plain = [normalised(t) for t in texts]
    sizes = np.array([len(p) + len(gap) for p in plain])
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    data = np.frombuffer(gap.join(plain) + gap, np.uint8)
    window, diagonal = _regions(data, index, overlap)
    out: dict[tuple[int, int], list[int]] = {}
    for at in range(0, len(window), 4096):
        w = window[at : at + 4096]
        edits, end = _aligned(data, index, w, diagonal[at : at + 4096], overlap)
        for i in np.flatnonzero(edits <= index.edits[w]):
            text = int(np.searchsorted(starts, end[i] - 1, side="right")) - 1
            stop = int(end[i] - starts[text])
            got = out.setdefault((text, int(index.items[w[i]])), [stop, 0, 10**9, set()])
            got[0] = min(got[0], max(0, stop - int(index.lengths[w[i]])))
            got[1] = max(got[1], stop)
            got[2] = min(got[2], int(edits[i]))
            got[3].add(int(w[i]))
    return [(t, item, len(seen), start, end, edits) for (t, item), (start, end, edits, seen) in sorted(out.items())]


def indexes(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES):
    """The indexes of the items of (item_id, text), block by block of about ``block_bytes``: items are dealt out by a hash
    of their text, and one block at a time is held."""
    rows = benchmark.select("item_id", "text").where("text is not null").distinct()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    for block in range(blocks):
        yield build_index([tuple(r) for r in rows.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()])


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``key``, item_id, n_windows, start, end, edits: one row for each row of ``docs`` and item that share a passage.

    A passage is a window of the item, short (WORDS words of LEAST to WINDOW bytes) or long (LONG bytes, the whole item if
    it is shorter), that occurs in the text with at most a fifteenth of its length in edits, case, punctuation and spaces
    aside. Shorter passages are not looked for. n_windows counts the windows found, which overlap. Null and empty texts hold none; null
    items and those of fewer than GRAM normalised bytes are in none; repeated items with the same id count once;
    repeated documents have a row each. An empty benchmark gives no rows. Other columns are not read.
    """
    kinds = dict(docs.dtypes)[key], dict(benchmark.dtypes)["item_id"]
    schema = f"`{key}` {kinds[0]}, item_id {kinds[1]}, n_windows int, start long, `end` long, edits int"
    arrow = [{"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(k) for k in kinds]
    found = None
    for index in indexes(benchmark, block_bytes):  # Spark broadcasts an index with the function that uses it

        def work(keys, texts, index=index):
            rows = find_leaks(texts, index)
            if rows:
                t, item, n, start, end, edits = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[i] for i in t], arrow[0]), pa.array([index.names[i] for i in item], arrow[1]), pa.array(n, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(edits, pa.int32())],
                    names=[key, "item_id", "n_windows", "start", "end", "edits"],
                )

        part = over_texts(docs, work, schema, key)
        found = part if found is None else found.union(part)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` without a passage of the benchmark, with all their columns; no row is moved."""
    for index in indexes(benchmark, block_bytes):

        def clean(texts, index=index):
            good = np.ones(len(texts), dtype=bool)
            good[[row[0] for row in find_leaks(texts, index)]] = False
            return good

        docs = keep_rows(docs, clean)
    return docs


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """All documents against all items."""
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES = {"op7_decontamination": op7_decontamination}
ORACLES: dict[str, str] = {}
