"""Removal of byte strings that occur again, by most-significant-digit passes over depth-limited suffixes.

Only the first DEPTH bytes of a suffix count, so two suffixes that agree in them are one group, and groups of two or
more are exactly the repeated windows. The passes never order all suffixes:

1. The first digit of a suffix is the GRAM bytes at its anchor, the place in its window where a hash of GRAM bytes is
   least. Equal windows have equal anchors, so suffixes whose digit occurs once are done. Neighbouring suffixes share
   their anchor, so a row stands for a whole run of suffixes.
2. The second digit is the whole string that the windows of a run cover. Runs that agree in it are repeated as a whole.
3. Runs that agree in the first digit only are split into their single suffixes, and the last digit is the window itself.

The same passes over words instead of bytes find passages of ``PASSAGE`` words that occur again. They are counted only:
many are shorter than DEPTH bytes, and nothing below that depth is removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import SPACE, joined, keep, mix64, over_texts, table, text_of

DEPTH = 400
#: Bytes of the first digit; any that are shorter than the depth give the same result.
GRAM = 32
#: Words of a repeated passage that ``n_repeated`` counts, and of its first digit.
PASSAGE = 50
PASSAGE_GRAM = 8
#: Texts are worked on together until their bytes reach this size; the arrays of larger groups leave the processor's cache.
TOGETHER = 1 << 18
#: Distinct runs with one first digit that a task compares; beyond, their windows are counted by a shuffle.
GROUP = 20_000

_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_STEP = 0x9FB21C651E98DF25
_BACK = pow(_STEP, -1, 1 << 64)


def block_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the ``length`` bytes or words (64 bits each) that start at each position, built by doubling."""
    count = len(data) - length + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    power, width, out, done = _BYTE[data] if data.dtype == np.uint8 else data, 1, None, 0
    rest = length
    while rest:
        if rest & 1:
            part = power[done : done + count]
            out = part.copy() if out is None else mix64(out * np.uint64(0x9E3779B97F4A7C15) + part)
            done += width
        rest >>= 1
        if rest:
            ahead = power[width:]
            power = power[:-width] * np.uint64(0xE7037ED1A0B428DB + 2 * width) + (ahead ^ (ahead >> np.uint64(29)))
            power ^= power >> np.uint64(32)
            width *= 2
    return out


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """The least of the ``span`` values from each position on."""
    width = 1
    while 2 * width <= span:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    if span > width:
        values = np.minimum(values[: -(span - width)], values[span - width :])
    return values


def _powers(base: int, count: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(count, base, np.uint64))))


def cut_words(texts: list[bytes]):
    """(64-bit hashes, first word of each text, number of words of each text, first byte and end of each word in its text)."""
    data, starts, lengths = joined(texts)
    space = np.concatenate(([True], SPACE[data]))  # each text ends with a line feed
    edges = np.flatnonzero(space[1:] != space[:-1])
    begin, end = edges[::2], edges[1::2]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * _powers(_STEP, len(data) - 1))))
    back = _powers(_BACK, len(data))
    hashes = mix64(mix64((sums[end] - sums[begin]) * back[begin]) + (end - begin).astype(np.uint64))
    first = np.searchsorted(begin, starts)
    counts = np.diff(np.append(first, len(begin)))
    base = np.repeat(starts, counts)
    return hashes, first, counts, begin - base, end - base


def runs(texts: list[bytes], depth: int = DEPTH, gram: int = GRAM):
    """(owner, first digit, second digit, start, end, anchor) of the runs of suffixes that share an anchor.

    ``start`` to ``end`` (inclusive) are the starts of the windows, in bytes of the text. Of equal hashes in a window the
    leftmost is its anchor, which depends on nothing but the window.
    """
    return _runs(*joined(texts), depth, gram)


def _runs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int, gram: int):
    """The same for texts in one array, of bytes or of hashed words."""
    valid = np.maximum(lengths - depth + 1, 0)
    if not valid.sum():
        return None
    hashes = block_hashes(data, gram)
    keyed = (mix64(hashes) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (_least(keyed, depth - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    owner = np.repeat(np.arange(len(lengths)), valid)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(valid) - valid, valid) + starts[owner]
    anchor = anchor[place]
    fresh = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]))))
    last = np.append(fresh[1:], len(owner)) - 1
    owner, start, end, anchor = owner[fresh], place[fresh], place[last], anchor[fresh]
    raw, size = data.tobytes(), data.itemsize
    digest = xxhash.xxh3_64_intdigest
    cuts = zip((start * size).tolist(), ((end + depth) * size).tolist(), (anchor - start).tolist())
    second = np.array([digest(raw[s:e], a) for s, e, a in cuts], dtype=np.uint64)
    base = starts[owner]
    return owner, hashes[anchor].view(np.int64), second.view(np.int64), start - base, end - base, anchor - base


def _word_runs(texts: list[bytes], passage: int):
    """The same for passages, counted in words, with what ``cut_words`` gives."""
    hashes, first, counts, *_ = cut = cut_words(texts)
    return _runs(hashes, first, counts, passage, min(PASSAGE_GRAM, passage)) if passage and len(hashes) else None, cut


def _emit(depth: int, gram: int, passage: int):
    """Each run of a text once, with how often it occurs there."""

    def work(keys, texts):
        for found in (runs(texts, depth, gram), _word_runs(texts, passage)[0] if passage else None):
            if not found:
                continue
            owner, first, second = found[:3]
            order = np.lexsort((second, first, owner))
            owner, first, second = owner[order], first[order], second[order]
            fresh = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (first[1:] != first[:-1]) | (second[1:] != second[:-1]))))
            times = np.diff(np.append(fresh, len(owner)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(first[fresh]), pa.array(second[fresh]), pa.array(keys, pa.int64()).take(pa.array(owner[fresh])), pa.array(times)],
                names=["first", "second", "id", "times"],
            )

    return work


_CONTEXT = "first long, second long, id long, one boolean, words boolean, data binary, anchor int"


def _contexts(depth: int, gram: int, passage: int):
    """The bytes, or the words, that the listed runs of each text cover."""

    def work(keys, texts):
        out = []
        listed = [{(r["first"], r["second"]): r["one"] for r in k["listed"]} for k in keys]
        for o, first, second, start, end, anchor in zip(*(x.tolist() for x in runs(texts, depth, gram) or ())):
            one = listed[o].pop((first, second), None)
            if one is not None:
                out.append((first, second, keys[o]["id"], one, False, texts[o][start : end + depth], anchor - start))
        if passage and any(listed):
            found, (_, base, _, begins, ends) = _word_runs(texts, passage)
            for o, first, second, start, end, anchor in zip(*(x.tolist() for x in found or ())):
                one = listed[o].pop((first, second), None)
                if one is not None:
                    covered = texts[o][begins[base[o] + start] : ends[base[o] + end + passage - 1]]
                    out.append((first, second, keys[o]["id"], one, True, covered, anchor - start))
        if out:
            types = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[c.split(" ")[0] for c in _CONTEXT.split(", ")])

    return work


def _windows(data: list[bytes], anchors: np.ndarray, depth: int, words: bool = False):
    """(row, offset of the window before its anchor, hash) of all windows of the contexts."""
    flat, starts, lengths = cut_words(data)[:3] if words else joined(data)
    counts = lengths - depth + 1
    row = np.repeat(np.arange(len(data)), counts)
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return row, anchors[row] - within, within, block_hashes(flat, depth)[starts[row] + within]


def _as_runs(row: np.ndarray, within: np.ndarray) -> dict[int, np.ndarray]:
    """First and last of the runs of neighbouring windows, by row."""
    if not len(row):
        return {}
    fresh = np.concatenate(([True], (row[1:] != row[:-1]) | (within[1:] != within[:-1] + 1)))
    first, last = within[fresh], within[np.append(np.flatnonzero(fresh)[1:] - 1, len(row) - 1)]
    whose = row[fresh]
    return {int(r): np.column_stack((first, last))[whose == r] for r in np.unique(whose)}


_FOUND = "first long, second long, id long, starts binary"


def _kinds(rows: list[tuple], depth: int, passage: int):
    """The contexts of bytes and those of words, each with the depth of its windows."""
    for words, deep in ((False, depth), (True, passage)):
        if part := [r for r in rows if r[4] == words]:
            yield words, deep, part


def _comparer(depth: int, passage: int):
    """The windows that occur again among contexts with the same first digit, which come one after the other."""

    def compare(rows):
        for words, deep, part in _kinds(rows, depth, passage):
            yield from compare_kind(part, words, deep)

    def compare_kind(rows, words, deep):
        first, second, ids, one, _, data, anchors = map(list, zip(*rows))
        names, group = np.unique(np.array(first, dtype=np.int64), return_inverse=True)
        row, before, within, value = _windows(data, np.array(anchors, dtype=np.int64), deep, words)
        order = np.lexsort((value, before, group[row]))
        g, b, v = group[row][order], before[order], value[order]
        same = (g[1:] == g[:-1]) & (b[1:] == b[:-1]) & (v[1:] == v[:-1])
        again = np.zeros(len(row), dtype=bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        again &= np.array(one, dtype=bool)[row]
        found = _as_runs(row[again], within[again])
        if found:
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array([x[r] for r in found], pa.int64()) for x in (first, second, ids)),
                    pa.array([x.astype(np.int64).tobytes() for x in found.values()]),
                ],
                names=["first", "second", "id", "starts"],
            )

    def work(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if size > 1 << 20 and row[0] != held[-1][0]:
                    yield from compare(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield from compare(held)

    return work


def _counted(contexts: DataFrame, depth: int, passage: int) -> DataFrame:
    """The same for first digits with very many contexts: a row for each window, counted by a shuffle."""

    def expand(batches):
        for batch in batches:
            every = list(zip(*(batch.column(i).to_pylist() for i in range(7))))
            for at in range(0, len(every), 256):
                for words, deep, part in _kinds(every[at : at + 256], depth, passage):
                    first, second, ids, one, _, data, anchors = map(list, zip(*part))
                    row, before, within, value = _windows(data, np.array(anchors, dtype=np.int64), deep, words)
                    pick = lambda x, t: pa.array(np.array(x, dtype=t)[row])  # noqa: E731, B023
                    yield pa.RecordBatch.from_arrays(
                        [pick(first, np.int64), pick(second, np.int64), pa.array(ids, pa.int64()).take(pa.array(row)), pick(one, bool), pa.array(before), pa.array(within), pa.array(value.view(np.int64))],
                        names=["first", "second", "id", "one", "before", "within", "value"],
                    )

    rows = contexts.mapInArrow(expand, "first long, second long, id long, one boolean, before long, within long, value long")
    again = rows.groupBy("first", "before", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    hits = rows.where("one").join(again, ["first", "before", "value"]).groupBy("first", "second", "id").agg(F.sort_array(F.collect_list("within")).alias("w"))

    def merge(batches):
        for batch in batches:
            arrays = [np.array(x) for x in batch.column(3).to_pylist()]
            starts = pa.array([_as_runs(np.zeros(len(w), int), w)[0].astype(np.int64).tobytes() for w in arrays], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], starts], names=["first", "second", "id", "starts"])

    return hits.mapInArrow(merge, _FOUND)


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, n_repeated long"
_ARROW = pa.schema([(n, pa.binary() if t == "binary" else pa.int64()) for n, t in (x.split(" ") for x in _RESULT.split(", "))])


def _covered(listed: list[dict], found, places) -> dict[int, list[tuple[int, int]]]:
    """The bytes, from and up to, that the repeated windows of each text cover."""
    spans = {}
    for o, first, second, start, end, _ in zip(*(x.tolist() for x in found or ())):
        if (first, second) in listed[o]:
            starts = listed[o][first, second]
            for a, b in [(0, end - start)] if starts is None else np.frombuffer(starts, np.int64).reshape(-1, 2).tolist():
                spans.setdefault(o, []).append(places(o, start + a, start + b))
    return spans


def _gone(length: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which bytes of a text the spans cover."""
    mark = np.zeros(length + 1, np.int64)
    for a, b in spans:
        mark[a] += 1
        mark[b] -= 1
    return np.cumsum(mark[:-1]) > 0


def _remover(depth: int, gram: int, passage: int):
    def work(keys, texts):
        asked = [i for i, k in enumerate(keys) if k["listed"]]
        own = [texts[i] for i in asked]
        listed = [{(r["first"], r["second"]): r["starts"] for r in keys[i]["listed"]} for i in asked]
        bytes_gone, words_again = {}, {}
        if asked:
            bytes_gone = _covered(listed, runs(own, depth, gram), lambda o, a, b: (a, b + depth))
        if asked and passage:
            found, (_, base, _, begin, end) = _word_runs(own, passage)
            words_again = _covered(listed, found, lambda o, a, b: (int(begin[base[o] + a]), int(end[base[o] + b + passage - 1])))
        order = {i: o for o, i in enumerate(asked)}
        out = []
        for i, (key, text) in enumerate(zip(keys, texts)):
            row = {"doc_id": key["doc_id"], "n_bytes": len(text), "n_removed": 0, "n_spans": 0, "kept": text, "n_repeated": 0}
            o = order.get(i)
            if o in bytes_gone:
                gone = _gone(len(text), bytes_gone[o])
                row["n_removed"] = int(gone.sum())
                row["n_spans"] = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[0])
                row["kept"] = np.frombuffer(text, np.uint8)[~gone].tobytes()
            if o in words_again:
                row["n_repeated"] = int(_gone(len(text), words_again[o]).sum())
            out.append(row)
        yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    return work


def remove_repeated(docs: DataFrame, depth: int = DEPTH, gram: int = GRAM, group: int = GROUP, passage: int = 0) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes) of each row of ``docs`` (doc_id, text).

    Every byte is removed that a string of ``depth`` bytes covers which also starts anywhere else: in the same text,
    overlapping or not, or in another row, repeated rows included. A null text counts as empty. n_spans counts the
    maximal removed stretches. Rows with equal or null doc_id are judged one by one. Other columns are not read.

    With ``passage``, n_repeated follows: the bytes, from first to last word, that ``passage`` neighbouring words cover
    which also start anywhere else, whatever space is between them. They are removed only if they are in ``depth`` bytes.
    """
    rows = docs.select("doc_id", text_of().alias("text"))
    every = over_texts(rows, _emit(depth, gram, passage), "first long, second long, id long, times long", "doc_id", limit=TOGETHER)
    # one shuffle by the first digit serves all counts: n runs with both digits, the first of them leads; distinct strings of a first digit
    same, alike = Window.partitionBy("first", "second"), Window.partitionBy("first")
    counted = every.repartition("first").withColumn("lead", F.row_number().over(same.orderBy("id")) == 1).withColumn("n", F.sum("times").over(same))
    counted = counted.withColumn("strings", F.sum(F.col("lead").cast("long")).over(alike)).withColumn("any_one", F.max(F.col("n") == 1).over(alike))
    split = (F.col("strings") > 1) & F.col("any_one")
    counted = keep(counted.where((F.col("n") > 1) | split).select("first", "second", "id", "lead", "n", "strings", split.alias("split")), "window-runs")
    whole = counted.where("n > 1").select("first", "second", "id", F.lit(None).cast("binary").alias("starts"))

    def contexts(which: Column) -> DataFrame:
        # the leading text gives the bytes of a run (rows that share its id give copies of repeated runs); all joins with the texts use one shuffle of them
        wanted = counted.where(F.col("split") & F.col("lead") & which).select("id", F.struct("first", "second", (F.col("n") == 1).alias("one")).alias("run"))
        wanted = wanted.groupBy("id").agg(F.collect_list("run").alias("listed"))
        asked = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("id"))).select(F.struct("id", "listed").alias("key"), "text")
        return over_texts(asked, _contexts(depth, gram, passage), _CONTEXT, "key", limit=TOGETHER)

    small, large = F.col("strings") <= group, F.col("strings") > group
    found = contexts(small).repartition("first").sortWithinPartitions("first").mapInArrow(_comparer(depth, passage), _FOUND)
    if not counted.where(F.col("split") & large).isEmpty():
        found = found.union(_counted(contexts(large), depth, passage))

    # only runs that occur once are split, so what is found belongs to one text
    listed = whole.union(found).groupBy("id").agg(F.collect_list(F.struct("first", "second", "starts")).alias("listed"))
    texts = rows.join(listed, F.col("doc_id").eqNullSafe(F.col("id")), "left").select(F.struct("doc_id", "listed").alias("key"), "text")
    result = over_texts(texts, _remover(depth, gram, passage), _RESULT, "key", limit=TOGETHER)
    return result if passage else result.drop("n_repeated")


def op9_window_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents; the bytes that stay as their digest, and the bytes in passages of 50 words that occur again."""
    found = remove_repeated(table(spark, folder, "documents"), passage=PASSAGE)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_repeated")


QUERIES = {"op9_window_dedup": op9_window_dedup}
ORACLES: dict[str, str] = {}
