import math
import random
from statistics import NormalDist

import numpy as np
import pytest

from postlens.llm import embedding_dedup

SCHEMA = "vec_id long, embedding array<float>, label int, node long, copies long"


def clusters(seed=1, groups=12, dims=64):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = np.array([rng.gauss(0, 1) for _ in range(dims)])
        for k in range(rng.choice([1, 2, 5, 40])):
            v = base + rng.choice([0, 0.1, 0.25, 0.4]) * np.array([rng.gauss(0, 1) for _ in range(dims)])
            rows.append((g * 100 + k, (v * rng.choice([1, 3])).astype(np.float32).tolist(), g % 3))
    return rows


def brute(rows):
    good = {}
    for i, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            good[i] = x / np.linalg.norm(x)
    links = {i: [j for j in good if j != i and rows[j][2] == rows[i][2] and len(good[j]) == len(good[i]) and good[i] @ good[j] >= 0.93] for i in good}
    return links


def components(rows, links):
    out = {}
    for i in range(len(rows)):
        if i in out:
            continue
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        for j in seen:
            out[j] = min(ids) if ids else None
    return out


def found(spark, rows, **more):
    frame = spark.createDataFrame([(i, v, l, 1, 2) for i, v, l in rows], SCHEMA)
    return embedding_dedup.near_duplicates(frame, **more).collect()


@pytest.mark.parametrize("block", [8, 1024])
def test_as_brute_force_with_many_filters(spark, block):
    rows = clusters()
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found(spark, rows, wanted=120, block=block)}
    links = brute(rows)
    names = components(rows, links)
    assert got == {rows[i][0]: (len(links[i]), names[i], names[i] == rows[i][0]) for i in range(len(rows))}


def test_recall_and_no_false_links(spark):
    rows = clusters(2, 30)
    links = brute(rows)
    want = sum(map(len, links.values()))
    got = {r["vec_id"]: r["n_links"] for r in found(spark, rows)}
    assert all(got[rows[i][0]] <= len(links[i]) for i in links)
    assert sum(got.values()) >= 0.95 * want


def test_edge_rows(spark):
    v = [1.0, 2.0, -1.0, 0.5]
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, v, 0), (2, v, 0), (3, [2 * x for x in v], 0), (4, v, 1), (5, v, None), (6, None, 0), (7, [0.0] * 4, 0), (8, [1.0, None, 1.0, 1.0], 0), (9, [nan, 1.0, 1.0, 1.0], 0),
        (10, [inf, 1.0, 1.0, 1.0], 0), (11, [], 0), (12, v + [1.0], 0), (12, v + [1.0], 0), (None, v, 2), (None, v, 2), (None, v, 0), (13, [-x for x in v], 0), (14, [1e38] * 4, 3),
        (15, [1e38] * 4, 3), (16, [-0.0, 1.0, 0.0, 0.0], 4), (17, [0.0, 1.0, -0.0, 0.0], 4), (18, [5.0], 5), (19, [3.0], 5),
    ]
    links = brute(rows)
    names = components(rows, links)
    want = sorted(((rows[i][0], len(links.get(i, ())), names[i], names[i] == rows[i][0]) for i in range(len(rows))), key=repr)
    assert sorted(map(tuple, found(spark, rows)), key=repr) == want


def test_empty(spark):
    assert found(spark, []) == []


def test_list_decoding_finds_all_filters():
    rng = np.random.default_rng(5)
    units = rng.standard_normal((50, 64))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    least = NormalDist().inv_cdf(1 - embedding_dedup.FILTERS / (embedding_dedup.TABLES * embedding_dedup.CODES**2))
    sums = []
    for number in range(embedding_dedup.TABLES):
        rotation, book = embedding_dedup.codes(64, number)
        scores = units @ rotation @ book
        sums.append((scores[:, : embedding_dedup.CODES, None] + scores[:, None, embedding_dedup.CODES :]).reshape(50, -1))
    for row, filters in zip(np.hstack(sums), embedding_dedup.list_decode(units, 64)):
        want = np.flatnonzero(row >= least)
        assert list(filters) == list(want) or (not len(want) and len(filters) == 1)
