import duckdb
import pandas as pd
import pytest

from postlens.llm import mixing

from .conftest import DOCS, edge_rows


def sql_rows(rows):
    frame = pd.DataFrame([r[:4] for r in rows], columns=["doc_id", "text", "lang", "source"])
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    connection = duckdb.connect()
    connection.register("documents", frame)
    return sorted(connection.execute(mixing._ORACLE).fetchall(), key=repr)


def spark_rows(frame):
    narrow = mixing.narrow_rows(frame)
    taken = mixing.take(narrow, mixing.mixing_plan(narrow))
    return sorted(map(tuple, taken.select("doc_id", *mixing.NODES, "_mix_tokens", "epoch").collect()), key=repr)


def test_edge_rows_as_in_sql(edge):
    got = spark_rows(edge)
    assert got == sql_rows(edge_rows()) and got


def test_many_leaves_as_in_sql(spark):
    rows = [(i, "w " * (i * 7 % 50), ("en", "de", "fr", "es")[i % 4 if i % 3 else 0], f"src{i % 20 if i % 4 else 0}", 0, None, None, None, None, None) for i in range(600)]
    assert spark_rows(spark.createDataFrame(rows, DOCS)) == sql_rows(rows)


def test_mix_keeps_columns_and_prefixes(edge):
    out = mixing.mix(edge)
    assert out.columns == edge.columns
    assert out.count() == len(spark_rows(edge))


def test_empty(no_docs):
    assert mixing.mix(no_docs).count() == 0


def children(spark, rows):
    return spark.createDataFrame(rows, "p string, c string, cap long, weight long")


@pytest.mark.parametrize("budget, expected", [(100.0, {"a": 10.0, "b": 45.0, "c": 45.0}), (12.0, {"a": 4.0, "b": 4.0, "c": 4.0}), (230.0, {"a": 10.0, "b": 100.0, "c": 120.0})])
def test_shortages_go_to_siblings(spark, budget, expected):
    parents = spark.createDataFrame([("x", budget)], "p string, budget double")
    rows = [("x", "a", 10, 1), ("x", "b", 100, 1), ("x", "c", 300, 1), ("x", "zero", 5, 0)]
    got = {r["c"]: r["budget"] for r in mixing.share_out(parents, children(spark, rows), ["p"], "c").collect()}
    assert got == pytest.approx(expected)


def test_a_family_in_need_gives_the_rest_to_its_uncles(spark):
    leaves = spark.createDataFrame([("d1", "l", "s1", 10), ("d2", "l", "s2", 500), ("d2", "l", "s3", 500)], [*mixing.NODES, "tokens"])
    got = {r[mixing.NODES[2]]: r["budget"] for r in mixing.leaf_budgets(leaves, {"domain": {"d1": 9, "d2": 1}}, 0.5, 1).collect()}
    assert got == {"s1": 10, "s2": 247, "s3": 247}


@pytest.mark.parametrize("level, zero", [("lang", "l0"), ("source", "s0")])
def test_leaves_of_weight_zero_leave_their_share_to_others(spark, level, zero):
    rows = [("d1", "l0", "s0", 1000), ("d1", "l1", "s1", 10), ("d2", "l1", "s1", 1000)]
    leaves = spark.createDataFrame(rows, [*mixing.NODES, "tokens"])
    for share, want in ((0.2, {"d1": 10, "d2": 392}), (1.0, {"d1": 10, "d2": 1000})):
        got = mixing.leaf_budgets(leaves, {level: {zero: 0}}, share, 1).collect()
        assert {r[mixing.NODES[0]]: r["budget"] for r in got} == want
        assert all(r[mixing.NODES[1]] == "l1" for r in got)


def test_whole_epochs_then_a_prefix(spark):
    rows = [(i, "a b c", "en", "src0", 0, None, None, None, None, None) for i in range(40)] + [(100 + i, "a b c", "de", "src0", 0, None, None, None, None, None) for i in range(400)]
    narrow = mixing.narrow_rows(spark.createDataFrame(rows, DOCS))
    plan = mixing.mixing_plan(narrow, {"lang": {"en": 1, "de": 1}}, 1.0, 3)
    counts = {}
    for row in mixing.take(narrow, plan).collect():
        counts.setdefault(row["_mix_lang"], []).append(row["epoch"])
    assert sorted(counts["en"]) == [0] * 40 + [1] * 40 + [2] * 40  # all it has
    assert len(counts["de"]) == 320 and set(counts["de"]) == {0}


def test_no_python_on_the_executors(spark, sf, explain):
    plan = explain(mixing.mix(spark.read.parquet(f"{sf}/documents.parquet"))) + explain(mixing.op10_mixing(spark, sf))
    assert "Python" not in plan and "Arrow" not in plan
