"""The pipeline against a version without Spark, on a small table that has every case."""

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

import duckdb  # noqa: E402
import numpy as np  # noqa: E402
import pandas as pd  # noqa: E402

from postlens.llm import decontamination, mixing, quality, sharding  # noqa: E402

from .conftest import words  # noqa: E402
from .test_ngram_join import expected as classes_of  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    item = " ".join(words(4242, 40, 9999))
    docs, labels = [], []
    for i in range(300):
        text = " ".join(words(i, 20 + i % 60, 3000))
        if i % 7 == 0:
            text = text.upper().replace(" ", "!! ") + "!!"
        if i % 11 == 1:
            text = " ".join(words(i - 1 if (i - 1) % 7 else i, 90, 3000)) + f" end{i}"
        if i % 13 == 2:
            text = " ".join(words(13, 100, 3000)[: 100 - i % 3])
        if i % 17 == 3:
            text = f"{text} {item.title()} {text[::-1]}"
        docs.append((i, text, ("en", "de", None)[i % 3], f"src{i % 9}" if i % 5 else "src0", len(text)))
        labels.append((i, int(i % 7 != 0), 0))
    docs += [(300, None, "en", "src1", None), (301, "", None, None, 0), (302, "", "en", "src1", 0), (5, docs[5][1], *docs[5][2:])]
    spark.createDataFrame(docs, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, item


def plain_pipeline(spark, path, docs, item):
    tables = [spark.read.parquet(f"{path}/{n}.parquet") for n in ("documents", "labels")]
    model = quality.fit(*tables)
    rows = [r for r in docs if model.score(quality.term_counts([(r[1] or "").encode()]))[0] >= quality.THRESHOLD]
    assert len(rows) < len(docs)

    named = {}
    for (i, n, component), row in zip(classes_of(rows), sorted(rows, key=lambda r: repr((r[0],)))):
        named.setdefault(i, (n, component))
    seen, stay = set(), []
    for row in rows:
        n, component = named[row[0]]
        if (n == 0 or component == row[0]) and row[0] not in seen:
            seen.add(row[0])
            stay.append(row)
    assert len(stay) < len(rows)

    index = decontamination.build_index([(1, item)])
    clean = [r for r in stay if not decontamination.find_leaks([(r[1] or "").encode()], index)]
    assert len(clean) < len(stay)

    connection = duckdb.connect()
    connection.register("documents", pd.DataFrame(clean, columns=["doc_id", "text", "lang", "source", "n_chars"]))
    taken = connection.execute(mixing._ORACLE).fetchall()
    by_id = {r[0]: r for r in clean}
    mixed = sorted(t[0] for t in taken)
    places = sharding.permute(np.arange(len(mixed)), len(mixed))
    return sorted((*by_id[i], int(p) % 8, int(p) // 8) for i, p in zip(mixed, places))


def test_as_plain_version(spark, folder):
    got = corpus_pipeline.run(spark, folder[0])
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(plain_pipeline(spark, *folder), key=repr)


def test_stages_keep_the_columns_and_take_extra_ones(spark, folder, edge):
    for name, stage in corpus_pipeline.STAGES:
        for rows in (edge, edge.limit(0)):
            out = stage(spark, rows, folder[0])
            columns = [c for c in edge.columns if c != "shard"] + ["shard", "slot"] if name == "sharding" else edge.columns
            assert out.columns == columns
            out.collect()


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert names["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names)
