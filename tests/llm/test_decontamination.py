import random

import numpy as np
import pytest

from postlens.llm import decontamination as d

from .conftest import edge_rows, words


def text_of(seed, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))


ITEMS = [(i, text_of(i, 12 + 5 * i)) for i in range(8)] + [(8, None), (9, ""), (10, "tiny"), (11, "twelve chars"), (11, "twelve chars"), (None, text_of(77))]
ITEM_SCHEMA = "item_id long, text string, doc_id long"


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame([(i, t, 5) for i, t in items], ITEM_SCHEMA)


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, item_id string")


def pairs(frame):
    return sorted(((r["doc_id"], r["item_id"]) for r in frame.collect()), key=repr)


def edited(text, edits, seed=3):
    rng, out = random.Random(seed), list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        out[at : at + (kind != 0)] = [] if kind == 1 else [rng.choice("xyz")]
    return "".join(out)


def test_planted_passages(spark):
    noise = [text_of(1000 + i, 80) for i in range(20)]
    texts = [(i, t) for i, t in enumerate(noise)]
    texts += [
        (100, f"{noise[0]} {ITEMS[3][1]} {noise[1]}"),
        (101, f"{noise[2]}\n\n{ITEMS[4][1].upper().replace(' ', ', ')}!! {noise[3]}"),
        (102, noise[4] + " " + edited(ITEMS[7][1], 4)),
        (103, ITEMS[5][1]),
        (104, noise[5] + " " + ITEMS[6][1][40:240] + " " + noise[6]),
        (105, ITEMS[2][1] + " . " + ITEMS[1][1]),
        (106, "Twelve -- CHARS"),
        (107, text_of(77)),
        (100, f"{ITEMS[3][1]}"),
        (None, ITEMS[0][1]),
        (108, None),
        (109, ""),
    ]
    want = [(100, 3), (100, 3), (101, 4), (102, 7), (103, 5), (104, 6), (105, 1), (105, 2), (106, 11), (107, None), (None, 0)]
    frame = docs(spark, texts)
    for block_bytes in (d.BLOCK_BYTES, 300):
        assert pairs(d.leaks(frame, benchmark(spark), block_bytes=block_bytes)) == sorted(want, key=repr)
        clean = d.without_leaks(frame, benchmark(spark), block_bytes=block_bytes)
        assert clean.columns == frame.columns
        assert sorted((r["doc_id"] for r in clean.collect()), key=repr) == sorted([*range(20), 108, 109], key=repr)


def test_a_match_never_crosses_documents():
    index = d.build_index([(1, "the quick brown fox jumps over it")])
    assert d.find_leaks([b"the quick brown fox", b"jumps over it"], index) == []
    assert [r[0] for r in d.find_leaks([b"x", b"The QUICK brown, fox jumps over it!", b""], index)] == [1]


def semi_global(pattern: bytes, text: bytes) -> int:
    row = np.zeros(len(text) + 1, int)
    for i, p in enumerate(pattern, 1):
        new = np.empty_like(row)
        new[0] = i
        for j, t in enumerate(text, 1):
            new[j] = min(row[j - 1] + (p != t), row[j] + 1, new[j - 1] + 1)
        row = new
    return int(row.min())


@pytest.mark.parametrize("seed", range(6))
def test_as_full_alignment(seed):
    item = d.normalised(text_of(seed, 20).encode())[: d.WINDOW].strip()
    index = d.build_index([(1, item.decode())])
    found = []
    for edits in range(0, 14):
        text = (text_of(seed + 50, 30) + " " + edited(item.decode(), edits, seed * 31 + edits) + " " + text_of(seed + 60, 30)).encode()
        least = semi_global(item, d.normalised(text))
        got = d.find_leaks([text], index)
        found.append((bool(got), got[0][5] if got else None) == (least <= int(index.edits[0]), least if got else None))
    assert all(found)


def test_normalised():
    assert d.normalised("  Ab--C\n\n1É!".encode()) == "ab c 1é".encode()
    assert d.normalised(b"") == d.normalised(b" !? ") == b""


def test_edge_rows(spark, edge, no_docs):
    assert d.leaks(no_docs, benchmark(spark)).count() == 0
    assert d.leaks(edge, benchmark(spark, [])).count() == 0
    assert d.without_leaks(edge, benchmark(spark, [])).count() == len(edge_rows())
    want = sorted(((i, 1) for i, t, *_ in edge_rows() if t and t.startswith(" ".join(words(1, 20)))), key=repr)
    assert pairs(d.leaks(edge, benchmark(spark, [(1, " ".join(words(1, 250)))]))) == want


def quotes(item, least_words, most_words):
    parts = item.split()
    return [" ".join(parts[i : i + n]) for n in range(least_words, most_words + 1) for i in range(len(parts) - n + 1)]


@pytest.mark.parametrize("name, item", [(1, text_of(41, 50)), (2, " ".join(["of"] * 3 + text_of(42, 9).split()) + " " + text_of(43, 30)), (3, "漢字" * 60)])
def test_quotes_at_every_offset(name, item):
    index = d.build_index([(0, text_of(44, 50)), (name, item)])
    parts = [q for q in quotes(item, 12, 30) if len(d.normalised(q.encode())) >= d.LEAST]
    data = d.normalised(item.encode())
    size = d.WINDOW + d.STEP
    cut = [data[i : i + n].decode("utf-8", "ignore") for n in (size + 6, 80, 110, 126, 158, 170) for i in range(len(data) - n + 1)]
    texts = [f"{text_of(500 + i, 12)} {q} {text_of(900 + i, 12)}".encode() for i, q in enumerate(parts + cut)]
    found = d.find_leaks(texts, index)
    assert [r[0] for r in found] == list(range(len(texts)))
    assert {r[1] for r in found} == {1}
    assert all(r[5] == 0 for r in found)


def test_an_edited_item_of_middle_length():
    item = text_of(45, 40)[:90]
    close = item[:33] + "0" + item[34:38] + "1" + item[39:43] + "2" + item[44:48] + "3" + item[49:53] + "4" + item[54:58] + "5" + item[59:]
    assert [r[1] for r in d.find_leaks([close.encode()], d.build_index([(1, item)]))] == [0]


def test_short_passages_are_not_looked_for():
    assert d.find_leaks([b"1 2 3 4 5 6 7 8 9 10 11 12 and other words"], d.build_index([(1, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20")])) == []
