import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, tokens string, shard int, id string, key string"


def words(seed: int, n: int, kinds: int = 400) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(kinds)}" for _ in range(n)]


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties and repeated rows; extra columns with clashing names."""
    base = " ".join(words(1, 300))
    near = " ".join(words(1, 300)[:-8] + words(2, 8))
    texts = [
        (1, base), (2, base), (3, near), (4, None), (5, ""), (6, " \t\n"), (7, "one"), (8, "ONE"), (9, "a b c d e"), (10, "A  b\tc d e"),
        (11, "x " * 30_000), (12, " ".join(words(3, 20_000, 5000))), (12, " ".join(words(4, 50))), (13, "Ünïcode ß é 漢字 " * 9), (13, "Ünïcode ß é 漢字 " * 9),
        (None, base), (None, None), (None, "only here " + " ".join(words(5, 60))), (14, "a\u0000b WARC/1.1\r\n\r\n" * 3), (-5, "ab" * 300),
    ]
    return [
        (i, t, ("en", "de", None)[k % 3], ("src0", "src7", None, "odd")[k % 4], None if t is None else len(t), None, None, None, None, None)
        for k, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
