import zlib

import numpy as np
import pytest

from postlens.llm import sharding

from .conftest import edge_rows


@pytest.mark.parametrize("rows", [1, 2, 3, 4, 5, 15, 16, 17, 255, 1000, 4097])
def test_permutation_and_inverse(rows):
    numbers = np.arange(rows)
    places = sharding.permute(numbers, rows)
    assert sorted(places) == list(numbers)
    assert (sharding.unpermute(places, rows) == numbers).all()


def test_seeds_differ():
    numbers = np.arange(1000)
    assert (sharding.permute(numbers, 1000, 1) != sharding.permute(numbers, 1000, 2)).mean() > 0.9


def test_no_numbers():
    assert len(sharding.permute(np.arange(0), 0)) == 0


def placed(frame):
    return sorted(map(tuple, sharding.shard_documents(frame).collect()), key=repr)


def test_edge_rows(edge):
    rows = placed(edge)
    texts = [(i, (t or "").encode()) for i, t, *_ in edge_rows()]
    assert sorted(((r[0], r[1], r[2]) for r in rows), key=repr) == sorted(((i, len(t) + 1, zlib.crc32(t)) for i, t in texts), key=repr)
    slots = {}
    for row in rows:
        assert row[3] == "rows" and row[6] is None
        slots.setdefault(row[4], []).append(row[5])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(k, [])) for k in range(8)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(texts)


def test_same_places_however_stored(edge):
    assert placed(edge) == placed(edge.repartition(5).orderBy("n_chars"))


def test_rows_can_be_located(spark):
    frame = spark.range(100)
    rows = sharding.sharded(frame, ["id"], 7).collect()
    for row in rows:
        assert sharding.row_at(row["shard"], row["slot"], 100, 7) == row["id"]


def test_empty(no_docs):
    assert placed(no_docs) == []


def test_own_shard_column_is_replaced(edge):
    out = sharding.sharded(edge, ["doc_id", "text"], 3)
    assert out.columns.count("shard") == 1 and out.count() == len(edge_rows())
    assert {r["shard"] for r in out.collect()} == {0, 1, 2}
