import collections
import random
import re

import pytest

from postlens.llm import source_audit as a

from .conftest import edge_rows


def expected(rows, least=a.LEAST_DOCS, top=a.TOP):
    rows = [(r[1] or "", r[2] or "", r[3] or "") for r in rows]
    out = []
    for lang in {r[1] for r in rows}:
        words = [(s, re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))) for t, l, s in rows if l == lang]
        seen = collections.Counter(w for _, ws in words for w in set(ws))
        kept = sorted(w for w in seen if seen[w] >= least)
        counts = {s: collections.Counter(w for o, ws in words if o == s for w in ws if seen[w] >= least) for s in {o for o, _ in words}}
        whole = sum(counts.values(), collections.Counter())
        share = lambda c, w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept))  # noqa: E731, B023
        for s in counts:
            pairs = [(sum((share(counts[s], w) - share(counts[o], w)) ** 2 // share(counts[o], w) for w in kept), o) for o in counts if o != s]
            terms = [((share(counts[s], w) - share(whole, w)) ** 2 // share(whole, w), w) for w in kept if counts[s][w] and share(counts[s], w) > share(whole, w)]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out)


def found(frame, **more):
    return sorted(map(tuple, a.audit(frame, **more).collect()))


def some_docs(seed, sources=9, docs=120):
    rng = random.Random(seed)
    names = ["", None, *(f"s{k}" for k in range(sources))]
    vocabulary = ["".join(rng.choices("abÄß漢Zz", k=rng.randint(1, 3))) for _ in range(60)]
    text = lambda: rng.choice([" ", "1", "-", "\n"]).join(rng.choices(vocabulary, k=rng.randint(0, 30)))
    return [(k, rng.choice([None, "", text(), text(), text()]), rng.choice(["en", "de", None]), rng.choice(names)) for k in range(docs)]


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.mark.parametrize("peers, part, chunk, held", [(256, 1 << 20, 1 << 16, 200_000), (4, 50, 30, 20), (3, 7, 1, 1)])
def test_as_brute_force(spark, monkeypatch, peers, part, chunk, held):
    for name, value in (("PEERS", peers), ("PART", part), ("CHUNK", chunk), ("HELD", held)):
        monkeypatch.setattr(a, name, value)
    rows = some_docs(peers)
    assert found(spark.createDataFrame(rows, SCHEMA), top=5) == expected(rows, top=5)


def test_edge_rows(edge):
    assert found(edge) == expected(edge_rows())
    assert found(edge, least=1) == expected(edge_rows(), least=1)


def test_no_kept_terms_and_single_source(spark):
    rows = [(1, "a b", "en", "x"), (2, None, "en", "y"), (3, "c", "de", "only")]
    assert found(spark.createDataFrame(rows, SCHEMA)) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_empty(no_docs):
    assert found(no_docs) == []


def test_pieces_of_a_long_text(monkeypatch):
    text = b"One two-three4four" + "漢字 ".encode() * 40 + b"x" * 90 + b" end"
    whole = [w for words in a.terms_of(text) for w in words]
    assert whole == [w for w in re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.lower())]
    for piece in (1, 5, 64):
        monkeypatch.setattr(a, "PIECE", piece)
        assert [w for words in a.terms_of(text) for w in words] == whole


def test_shares_do_not_overflow(spark):
    row = spark.range(1).selectExpr(f"{a.share('9000000000000000000L', '9000000000000000000L', '5L')} as p", f"{a.share('3L', '7L', '0L')} as none").first()
    assert row["p"] == 1 + 10**9 * (9 * 10**18 + 1) // (9 * 10**18 + 5) and row["none"] == 0
