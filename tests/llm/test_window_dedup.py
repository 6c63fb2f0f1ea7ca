import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from postlens.llm import window_dedup as w

from .conftest import edge_rows


def expected(rows, depth):
    own = [(i, (t or "").encode()) for i, t, *_ in rows]
    counts = collections.Counter(t[k : k + depth] for _, t in own for k in range(len(t) - depth + 1))
    out = []
    for i, t in own:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - depth + 1):
            if counts[t[k : k + depth]] > 1:
                gone[k : k + depth] = True
        spans = sum(a and not b for a, b in zip(gone, [False, *gone]))
        out.append((i, len(t), int(gone.sum()), spans, np.frombuffer(t, np.uint8)[~gone].tobytes()))
    return sorted(out, key=repr)


def found(frame, **more):
    return sorted(((*tuple(r)[:-1], bytes(r["kept"])) for r in w.remove_repeated(frame, **more).collect()), key=repr)


def rows_with_shared_parts(seed):
    rng = random.Random(seed)
    parts = ["".join(rng.choices("abcd", k=rng.randint(10, 80))) for _ in range(12)]
    rows = []
    for i in range(60):
        text = "".join(rng.choice(parts)[rng.randint(0, 6) :] + "".join(rng.choices("abcd", k=rng.randint(0, 9))) for _ in range(rng.randint(0, 5)))
        rows.append((i if rng.random() < 0.9 else None, text))
    return rows


@pytest.mark.parametrize("depth, gram, group", [(20, 4, 20_000), (20, 4, 0), (20, 7, 3), (33, 33, 20_000), (24, 1, 2)])
def test_as_brute_force(spark, depth, gram, group):
    rows = rows_with_shared_parts(depth + gram)
    frame = spark.createDataFrame([(i, t, 1, b"") for i, t in rows], "doc_id long, text string, first long, data binary")
    assert found(frame, depth=depth, gram=gram, group=group) == expected(rows, depth)


def test_edge_rows(edge):
    rows = [r for r in edge_rows()]
    assert found(edge) == expected(rows, w.DEPTH)


def test_empty(no_docs):
    assert found(no_docs) == []


@pytest.mark.parametrize("length", [1, 2, 3, 5, 32, 33, 100])
def test_hashes_depend_on_the_block_alone(length):
    data = np.frombuffer(bytes(random.Random(1).choices(b"ab", k=3000)), np.uint8)
    values = w.block_hashes(data, length)
    blocks = [data[i : i + length].tobytes() for i in range(len(values))]
    assert len(values) == len(data) - length + 1
    assert len(set(values.tolist())) == len(set(blocks)) == len(set(zip(values.tolist(), blocks)))


def test_the_texts_are_shuffled_once(spark, edge):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = w.remove_repeated(edge)
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "ReusedExchange" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def passages(rows, count):
    """Brute force of n_repeated, by (doc_id, text)."""
    cut = [[(m.group(), m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for _, t, *_ in rows]
    keys = [[tuple(x[0] for x in c[k : k + count]) for k in range(len(c) - count + 1)] for c in cut]
    seen = collections.Counter(k for each in keys for k in each)
    out = []
    for (i, t, *_), c, each in zip(rows, cut, keys):
        gone = np.zeros(len((t or "").encode()), bool)
        for k, key in enumerate(each):
            if seen[key] > 1:
                gone[c[k][1] : c[k + count - 1][2]] = True
        out.append((i, t, int(gone.sum())))
    return out


@pytest.mark.parametrize("count, group", [(3, 20_000), (6, 0), (9, 3), (12, 20_000)])
def test_passages_as_brute_force(spark, count, group):
    rng = random.Random(count)
    letters = ["a", "b", "\u00e9", "long-word", "\u0416" * 9, "x\u00a0y"]
    parts = [[rng.choice(letters) for _ in range(rng.randint(3, 25))] for _ in range(15)]
    space = [" ", "  ", "\n", "\t \r\n", "\x0b"]
    rows = [(None, None), (1, ""), (2, " \n"), (3, "a"), (3, "a b a b a b a b a b a b a b a b"), (4, " b"), (None, "b ")]
    for i in range(60):
        own = [x for _ in range(rng.randint(0, 4)) for x in rng.choice(parts)[rng.randint(0, 4) :]]
        rows.append((i + 9 if rng.random() < 0.9 else None, rng.choice(["", " "]) + "".join(x + rng.choice(space) for x in own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = w.remove_repeated(frame, depth=30, gram=6, group=group, passage=count).collect()
    size = lambda t: len((t or "").encode())
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_repeated"]) for r in got), key=repr) == sorted(((i, size(t), n) for i, t, n in passages(rows, count)), key=repr)
    assert sorted(((*tuple(r)[:4], bytes(r["kept"])) for r in got), key=repr) == expected(rows, 30)


def test_query_counts_passages_of_fewer_bytes_than_the_depth(spark, tmp_path):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    passage = " ".join(word() for _ in range(60))  # 299 bytes
    texts = [" ".join(word() for _ in range(80)) for _ in range(6)]
    rows = [(i, f"{t} {passage} {t[::-1]}" if i < 2 else t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in w.op9_window_dedup(spark, str(tmp_path)).select("doc_id", "n_bytes", "n_removed", "n_repeated").collect())
    assert got == [(i, len(t), 0, 299 if i < 2 else 0) for i, t in rows]


def test_words_depend_on_their_bytes_alone():
    texts = [b" ab\n", b"", b"ab abc", b"ba", b"\t"]
    hashes, first, counts, begin, end = w.cut_words(texts)
    assert counts.tolist() == [1, 0, 2, 1, 0] and first.tolist() == [0, 1, 1, 3, 4]
    assert begin.tolist() == [1, 0, 3, 0] and end.tolist() == [3, 2, 6, 2]
    assert hashes[0] == hashes[1] and len(set(hashes.tolist())) == 3


def test_runs_that_repeat_within_a_text_are_sent_once():
    texts = [b"one two three four\n" * 300, b"", b"one two three four\n" * 200]
    rows = pa.Table.from_batches(w._emit(40, 8, 6)([7, 8, None], texts)).to_pylist()
    assert len(rows) < 60 and len({(r["first"], r["second"], r["id"]) for r in rows}) == len(rows)
    assert sum(r["times"] for r in rows) == len(w.runs(texts, 40, 8)[0]) + len(w._word_runs(texts, 6)[0][0])


@pytest.mark.parametrize("group", [20_000, 0])
def test_repeats_within_texts_as_brute_force(spark, group):
    line = "one two three four\n"
    rows = [(1, line * 30), (2, line * 20 + "five " + line * 3), (3, "other words that stay alone here"), (4, "six seven " * 9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = w.remove_repeated(frame, depth=40, gram=8, group=group, passage=6).collect()
    assert sorted((r["doc_id"], r["n_repeated"]) for r in got) == [(i, n) for i, _, n in passages(rows, 6)]
    assert sorted(((*tuple(r)[:4], bytes(r["kept"])) for r in got), key=repr) == expected(rows, 40)
