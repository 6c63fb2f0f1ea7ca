import random

import numpy as np
import pytest

from postlens.llm import chunk_dedup as c

from .conftest import edge_rows


def plain_chunks(text: bytes) -> list[bytes]:
    """The chunks by a rolling hash, byte by byte."""
    out, start, value = [], 0, 0
    for i, b in enumerate(text):
        value = ((value << 1) + int(c.GEAR[b])) & 0xFFFFFFFF
        size = i + 1 - start
        if size == c.MAX_CHUNK or (size >= c.MIN_CHUNK and value >> (32 - c.CUT_BITS) == 0):
            out.append(text[start : i + 1])
            start = i + 1
    return out + ([text[start:]] if start < len(text) else [])


def chunks_of(texts):
    owner, ends, _ = c.chunks(texts)
    out = []
    for i, text in enumerate(texts):
        mine = ends[owner == i].tolist()
        out.append([text[a:b] for a, b in zip([0, *mine], mine)])
    return out


def noise(seed, n):
    return bytes(random.Random(seed).choices(b"abcdefghij klm", k=n))


@pytest.mark.parametrize("seed", range(5))
def test_as_a_rolling_hash(seed):
    texts = [noise(seed, 3000), b"", b"x", b"\0" * 700, noise(seed + 9, 31), b"ab" * 900, "é漢".encode() * 200]
    assert chunks_of(texts) == [plain_chunks(t) for t in texts]
    assert all(b"".join(x) == t for x, t in zip(chunks_of(texts), texts))


def test_an_insertion_moves_few_chunks():
    text = noise(1, 20_000)
    before, after = chunks_of([text, text[:5000] + b"inserted" + text[5000:]])
    assert len(set(after) - set(before)) <= 8


def expected(rows):
    last = 1 << 63
    own = [((last if i is None else i), i, (t or "").encode()) for i, t, *_ in rows]
    where = {}
    for key, _, text in own:
        for x in set(plain_chunks(text)):
            where.setdefault(x, set()).add(key)
    out = []
    for key, i, text in own:
        parts, seen, gone, again = plain_chunks(text), set(), [], []
        for x in parts:
            gone.append(x in seen or min(where[x]) < key)
            again.append(x in seen or len(where[x]) > 1)
            seen.add(x)

        def long_runs(flags):
            flags = list(flags)
            a = 0
            while a < len(flags):
                b = a
                while b < len(flags) and flags[b] == flags[a]:
                    b += 1
                if flags[a] and sum(map(len, parts[a:b])) < c.MIN_SPAN:
                    flags[a:b] = [False] * (b - a)
                a = b
            return flags

        gone, again = long_runs(gone), long_runs(again)
        size = lambda flags: sum(len(p) for p, f in zip(parts, flags) if f)  # noqa: E731, B023
        spans = sum(g and not before for g, before in zip(gone, [False, *gone]))
        out.append((i, len(text), len(parts), size(again), size(gone), spans, b"".join(p for p, g in zip(parts, gone) if not g)))
    return sorted(out, key=repr)


def test_edge_rows(edge):
    got = c.dedup_chunks(edge)
    assert sorted(((*tuple(r)[:-1], bytes(r["kept"])) for r in got.collect()), key=repr) == expected(edge_rows())


def test_shared_passages(spark):
    passage = noise(7, 400).decode()
    rows = [(i, noise(100 + i, 500).decode() + (passage if i % 2 else "") + noise(200 + i, 500).decode()) for i in range(30)]
    got = {r["doc_id"]: r for r in c.dedup_chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, r in got.items():
        assert (r["n_repeated"] > 0) == bool(i % 2)
        assert (r["n_removed"] > 0) == bool(i % 2 and i > 1)


def test_empty(no_docs):
    assert c.dedup_chunks(no_docs).collect() == []


def test_gear_values_are_spread():
    assert len(np.unique(c.GEAR)) == 256


def removed(spark, rows):
    return {r["doc_id"]: (r["n_repeated"], r["n_removed"]) for r in c.dedup_chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_short_exact_copies(spark):
    texts = {n: noise(300 + n, n).decode() for n in (1, 5, 15, 16, 40, 63, 64, 95)}
    rows = [(k * 1000 + n, t) for n, t in texts.items() for k in (0, 1, 2)]
    tail = noise(1, 700)
    last = plain_chunks(tail)[-1].decode()
    assert len(last) < c.MIN_SPAN
    rows += [(5000, tail.decode()), (5001, last), (5002, ""), (5003, ""), (5004, None)]  # an end of a text is no whole text
    got = removed(spark, rows)
    assert got == {k * 1000 + n: (n, n if k else 0) for n in texts for k in (0, 1, 2)} | {i: (0, 0) for i in range(5000, 5005)}


def test_passages_of_fifty_words(spark):
    rows, sizes = [], {}
    for k in range(200):
        passage = noise(4000 + k, 315 + k % 64).decode()
        rows += [(2 * k + j, noise(6000 + 2 * k + j, 200 + 7 * k % 300).decode() + passage + noise(8000 + 2 * k + j, 300).decode()) for j in (0, 1)]
        sizes[2 * k + 1] = len(passage)
    got = removed(spark, rows)
    assert all(got[i][1] > 0 for i in sizes)
    assert sum(got[i][1] for i in sizes) > 0.7 * sum(sizes.values())
    assert not any(got[i - 1][1] for i in sizes)
