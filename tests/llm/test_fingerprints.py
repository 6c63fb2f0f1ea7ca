import hashlib
import random

import pytest
import xxhash

from postlens.llm import fingerprints as f

from .conftest import edge_rows

TEXTS = ["", "a", "abc", "漢字ß\U0001f600" * 30, "ab" * 5000, "a\u0000b", " ".join(f"w{random.Random(3).randrange(900)}" for _ in range(3000))]


def spans_of(text):
    return {text[i : i + f.SPAN] for i in range(len(text) - f.SPAN + 1)}


def test_spans_are_equal_where_the_strings_are():
    text = "".join(random.Random(1).choices("ab", k=400))
    hashes = f.PrefixHashes(text)
    for length in (1, 2, 7, 30):
        values = hashes.spans(range(len(text) - length + 1), length).tolist()
        strings = [text[i : i + length] for i in range(len(values))]
        assert len(set(values)) == len(set(strings)) == len(set(zip(values, strings)))


def test_common_extension_as_brute_force():
    rng = random.Random(2)
    one, other = ("".join(rng.choices("ab", k=300)) for _ in range(2))
    other = other[:100] + one[50:200] + other[100:]
    places = [(rng.randint(0, len(one)), rng.randint(0, len(other))) for _ in range(500)] + [(50, 100), (len(one), 0)]
    found = f.common_extension(f.PrefixHashes(one), [i for i, _ in places], f.PrefixHashes(other), [j for _, j in places])
    for (i, j), n in zip(places, found.tolist()):
        assert one[i : i + n] == other[j : j + n] and (i + n == len(one) or j + n == len(other) or one[i + n] != other[j + n])


def test_pieces_do_not_matter(monkeypatch):
    whole = [f.fingerprint(t) for t in TEXTS]
    for piece in (30, 64, 1000):
        monkeypatch.setattr(f, "PIECE", piece)
        assert [f.fingerprint(t) for t in TEXTS] == whole


def test_different_texts_differ():
    texts = [*TEXTS, *(t + "x" for t in TEXTS), *("x" + t for t in TEXTS if t), "ba" * 5000, "ab" * 4999]
    assert len({f.fingerprint(t) for t in texts}) == len(set(texts))


@pytest.mark.parametrize("share", [0.1, 0.25, 0.5])
def test_likeness_follows_the_texts(share):
    rng = random.Random(4)
    for _ in range(20):
        text, other = (" ".join(f"w{rng.randrange(900)}" for _ in range(300)) for _ in range(2))
        cut = int(len(text) * (1 - share))
        tail, head, middle = text[:cut] + other[cut:], other[: len(text) - cut] + text[len(text) - cut :], text[: cut // 2] + other[:50] + text[cut // 2 :]
        own = f.fingerprint(text)
        for edited in (tail, head):
            assert 0.8 * (1 - share) - 0.05 <= f.likeness(own, f.fingerprint(edited)) < 1
        assert f.likeness(own, f.fingerprint(middle)) > 0.6
        assert f.likeness(own, f.fingerprint(other)) < 0.2
        assert f.likeness(own, own) == 1


def test_likeness_estimates_the_shared_spans():
    rng = random.Random(5)
    words = [f"w{rng.randrange(900)}" for _ in range(600)]
    for step in (20, 40, 80):
        changed = " ".join("new" if i % step == 7 else w for i, w in enumerate(words))
        a, b = spans_of(" ".join(words)), spans_of(changed)
        assert abs(f.likeness(f.fingerprint(" ".join(words)), f.fingerprint(changed)) - len(a & b) / len(a | b)) < 0.3


def expected(rows):
    order = sorted(rows, key=lambda r: ((r[0] is not None, r[0] or 0), _signed(r[1] or "")))
    out = []
    for k, row in enumerate(order):
        text, following = row[1] or "", order[(k + 1) % len(order)][1] or ""
        last = len(text) // 4
        edited = "".join([*text][: len(text) - last] + [*following][:last])
        marks = [f.fingerprint(t) for t in (text, edited, following)]
        out.append((row[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), marks[0], marks[1], f.likeness(marks[0], marks[1]), f.likeness(marks[0], marks[2])))
    return sorted(out, key=repr)


def _signed(text):
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def found(frame):
    return sorted(map(tuple, f.fingerprint_edits(frame).collect()), key=repr)


def test_edits_as_brute_force(edge):
    assert found(edge) == expected(edge_rows())


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_neighbours_across_tasks(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.choice([None, 5, k, k]), "".join(rng.choices("abc ", k=rng.randint(0, 60)))) for k in range(40)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert found(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_one_row_and_none(spark, no_docs):
    assert found(no_docs) == []
    (row,) = found(spark.createDataFrame([(3, "abcdefgh")], "doc_id long, text string"))
    assert row[2] == hashlib.sha256(b"abcdefab").hexdigest() and row[6] == 1


def test_plain_fingerprints(edge):
    assert sorted(map(tuple, f.fingerprints(edge).collect()), key=repr) == sorted(((r[0], len(r[1] or ""), f.fingerprint(r[1] or "")) for r in edge_rows()), key=repr)


def test_common_extensions(spark):
    rows = [("abcabc", 0, "abcabd", 0), ("abcabc", 3, "abcabd", 0), (None, 0, "a", 0), ("a", 2, "a", 0), ("a", None, "a", 0), ("x" * 100, 10, "x" * 50, 0)]
    frame = spark.createDataFrame(rows, "left string, left_at long, right string, right_at long")
    assert [r["extension"] for r in f.common_extensions(frame).collect()] == [5, 3, 0, 0, 0, 50]
