import random
import re

import numpy as np
import pytest

from postlens.llm import ngram_join as nj

from .conftest import edge_rows, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))) if found else frozenset()


def expected(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    out = []
    for i, row in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((row[0], len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def found(frame, **more):
    return sorted(map(tuple, nj.near_duplicates(frame, **more).collect()), key=repr)


def near_copies(seed):
    """Copies of a few texts with edits at random, passages that many texts share, and a common line."""
    rng = random.Random(seed)
    line = words(999, 14)
    bases = [words(seed * 100 + k, rng.choice([30, 60, 150]), 5000) for k in range(8)]
    rows = []
    for i in range(150):
        text = list(rng.choice(bases)) if rng.random() < 0.7 else words(seed * 7919 + i, rng.randint(0, 80), 5000)
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            if text:
                text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
        if rng.random() < 0.3:
            at = rng.randrange(len(text) + 1)
            text[at:at] = line
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("seed, block, frequent", [(1, 1024, 1 << 17), (2, 4, 1 << 17), (3, 16, 40), (4, 3, 200)])
def test_as_all_pairs(spark, monkeypatch, seed, block, frequent):
    monkeypatch.setattr(nj, "FREQUENT", frequent)
    rows = near_copies(seed)
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, set long, component long").repartition(6)
    assert found(frame, block=block, salts=3) == expected(rows)


def test_a_chain_of_links(spark):
    text = words(5, 200, 10**6)
    rows = []
    for i in range(12):
        rows.append((50 - i, " ".join(text)))
        for at in range(i * 16, i * 16 + 4):
            text[at] = f"n{i}{at}"
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == expected(rows)


def test_edge_rows(edge):
    assert found(edge) == expected(edge_rows())


def test_empty(no_docs):
    assert found(no_docs) == []
    assert nj.one_of_each(no_docs).collect() == []


def test_one_of_each(edge):
    kept = nj.one_of_each(edge)
    assert kept.columns == edge.columns
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    ids = sorted((i for i, _ in rows), key=repr)
    assert ids == sorted([1, 4, 5, 6, 7, 9, 11, 12, 12, 13, 14, -5, None, None], key=repr)
    assert len(set(rows)) == len(rows)


def test_shingle_sets_count_like_sets():
    texts = [t for _, t, *_ in edge_rows() if t is not None] + [" ".join(words(k, 40, 3)) for k in range(20)]
    got = nj.shingle_sets([t.encode() for t in texts])
    assert [len(s) for s in got] == [len(shingles(t)) for t in texts]
    for a, x in zip(got[-20:], texts[-20:]):
        for b, y in zip(got[-20:], texts[-20:]):
            assert len(np.intersect1d(a, b)) == len(shingles(x) & shingles(y))


@pytest.mark.parametrize("seed", range(4))
def test_linked_sets_share_reported_tokens(seed):
    rng = np.random.default_rng(seed)
    for n in (1, 2, 3, 4, 7, 20, 21, 79, 80, 333):
        both = rng.integers(0, 2**63, n, dtype=np.uint64)
        extra = n // 3
        a = np.unique(np.concatenate((both, rng.integers(0, 2**63, extra // 2, dtype=np.uint64))))
        b = np.unique(np.concatenate((both, rng.integers(0, 2**63, extra - extra // 2, dtype=np.uint64))))
        frequent = np.sort(rng.choice(a, len(a) // 3, replace=False))
        assert nj.linked(a, b)
        shared = len(np.intersect1d(nj.reported(a, frequent)[0], nj.reported(b, frequent)[0]))
        for s in (a, b):
            assert shared >= len(s) * nj.PERCENT // (100 * nj.EXTRA) + 1


def test_groups_open_for_every_partner():
    rng = random.Random(3)
    rows = [sorted({rng.randrange(60) for _ in range(rng.randint(1, 30))}) for _ in range(300)]
    sets = [np.array(r, np.uint64) for r in rows]
    matrix = nj.TokenGroupMatrix(sets, 8)
    for query in sets:
        opened = {i for g in matrix.qualifying(query) for i in matrix.groups[g]}
        assert {i for i, s in enumerate(sets) if nj.linked(query, s)} <= opened


def test_tokens_counted_together_are_held_in_little_memory(monkeypatch):
    """The tokens of a task are counted exactly, in under four times their own bytes."""
    import tracemalloc

    monkeypatch.setattr(nj, "COUNTED", 1 << 18)
    common = " ".join(words(998, 30, 10**6))
    texts = [f"{common} {' '.join(words(k, 900, 10**6))}".encode() for k in range(310)]
    given = [([{"id": k, "mark": 0}], [t]) for k, t in enumerate(texts)]
    counted = np.concatenate([nj.shingle_sets([t])[0] for t in texts])
    assert len(counted) > 1 << 18
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    out = [batch for batch in nj._survey(lambda _: given)(None)]
    peak = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    times = {}
    for r in (r for batch in out for r in batch.to_pylist() if r["is_token"]):
        times[r["set"]] = times.get(r["set"], 0) + r["n"]
    assert list(times.values()) == [310] * 26  # the shingles of the common passage
    assert peak < 4 * 8 * (1 << 18)


@pytest.mark.parametrize("least", [1, 2, 4, 50])
def test_often_held_equals_plain_counts(least):
    tokens = np.array([random.Random(least).randrange(200) ** 2 for _ in range(3000)] + [7] * 90, dtype=np.uint64)
    values, counts = np.unique(tokens, return_counts=True)
    got, times = nj.often_held(tokens.copy(), least)
    assert got.tolist() == values[counts >= least].tolist() and times.tolist() == counts[counts >= least].tolist()
    assert nj.often_held(np.empty(0, np.uint64), least)[0].tolist() == []
