import zlib

import numpy as np
import pytest

from postlens.llm import quality

from .conftest import edge_rows, words

LABELS = "doc_id long, quality int, toxic int"


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def corpus(n=400):
    rows, labels = [], []
    for i in range(n):
        text = words(i, 30 + i % 90)
        if i % 4 == 0:
            text = [w.upper() + "!!" for w in text]
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 4 != 0), 0))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, LABELS)
    got = {r["doc_id"]: r for r in quality.judge(frame, known).collect()}
    assert all(r["held_out"] == held_out(i) and r["predicted"] == (r["score"] >= 0.3) for i, r in got.items())
    tested = [i for i in got if held_out(i)]
    assert np.mean([got[i]["predicted"] == labels[i][1] for i in tested]) > 0.97 and len(tested) > 50
    kept = {r["doc_id"] for r in quality.accepted(frame, known).collect()}
    assert kept == {i for i, r in got.items() if r["predicted"]}


def test_held_out_labels_do_not_matter(spark):
    rows, labels = corpus(200)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    score = lambda known: {r["doc_id"]: r["score"] for r in quality.judge(frame, spark.createDataFrame(known, LABELS)).collect()}
    changed = [(i, 1 - q, t) if held_out(i) else (i, q, t) for i, q, t in labels]
    a, b = score(labels), score([x for x in changed if not (held_out(x[0]) and x[0] % 2)])
    assert a == pytest.approx(b)


def test_sf_accuracy(spark, sf):
    folder = sf.replace("sf0.001", "sf0.01")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = [r for r in quality.op5_quality(spark, folder).collect() if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in got]) > 0.95


def test_edge_rows(spark, edge, no_docs):
    known = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 1), (3, 1, None), (3, 1, 0), (7, 0, 0), (8, 0, 0), (None, 1, 1), (9, None, 1), (11, 5, 0), (13, 0, 0)], LABELS)
    rows = quality.judge(edge, known).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    by_text = {}
    for i, t, *_ in edge_rows():
        by_text.setdefault(t or "", []).append(i)
    scores = {(r["doc_id"], round(r["score"], 9)) for r in rows}
    assert len({s for i, s in scores if i in (4, 5)}) == 1
    assert {r["held_out"] for r in rows if r["doc_id"] is None} == {False}
    assert quality.judge(no_docs, known).collect() == []
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in quality.judge(edge, none).collect()} == {0.5}
    assert quality.accepted(edge, none).count() == len(edge_rows())


def test_blocks_do_not_matter():
    texts = [" ".join(words(i, 5 + i)).encode() for i in range(50)]
    model = quality.Model(np.ones(quality.TERMS), np.eye(quality.TERMS)[:, :8], quality._unit(np.random.default_rng(1).random((9, 8))).astype(np.float32), np.arange(9) % 2.0)
    whole = model.score(quality.term_counts(texts))
    parts = np.concatenate([model.score(quality.term_counts(texts[i : i + 7])) for i in range(0, 50, 7)])
    assert whole == pytest.approx(parts)
