"""What the plans must and must not hold."""

import re

import pytest

from postlens.plans import catalog
from postlens.session import scratch_path

LAZY = [
    key
    for key in catalog.QUERIES
    if not key.startswith(("ml_", "stream_", "json_", "hydrate_append")) and key not in
    ("status_json", "text_lines", "annotation_csv", "report_csv", "pair_text", "hashtag_lists", "metrics_json", "word_count_text")
]


@pytest.mark.parametrize("key", LAZY)
def test_no_python_and_no_cross_join(spark, sf, explain, key):
    plan = explain(catalog.QUERIES[key](spark, sf))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInArrow"):
        assert word not in plan


@pytest.mark.parametrize(
    "key, columns",
    [
        ("top_authors", {"source"}),
        ("community_counts", {"lang"}),
        ("top_scores_by_author", {"source", "n_chars"}),
        ("keyword_counts", {"text"}),
        ("post_count", set()),
        ("split_hash", {"doc_id"}),
    ],
)
def test_scans_read_only_what_is_needed(spark, sf, explain, key, columns):
    found = re.findall(r"ReadSchema: struct<(.*?)>\n", explain(catalog.QUERIES[key](spark, sf)))
    assert {c.split(":")[0] for part in found for c in part.split(",") if c} == columns


def test_all_keywords_are_counted_in_one_scan(spark, sf, explain):
    assert explain(catalog.keyword_counts(spark, sf)).count("Scan parquet") <= 2  # once in the tree, once in the details


@pytest.mark.parametrize("key", ["top_authors", "top_scores_by_author", "most_positive", "status_followers", "ngram_vocab"])
def test_top_k_is_one_node(spark, sf, explain, key):
    assert "TakeOrderedAndProject" in explain(catalog.QUERIES[key](spark, sf))


def test_scores_without_the_text_do_not_shuffle_the_text(spark, sf, explain):
    plan = explain(catalog.sentiment_labels(spark, sf))
    shuffled = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: hashpartitioning", plan)
    assert shuffled and not any(re.search(r"\btext#", columns) for columns in shuffled)


def test_enrichment_shuffles_the_text_once(spark, sf, explain):
    plan = explain(catalog.enriched(spark, sf))
    shuffled = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: hashpartitioning", plan)
    assert sum(bool(re.search(r"\btext#", columns)) for columns in shuffled) == 1


def test_enrichment_reads_the_text_twice_and_hashes_nothing_unbounded(spark, sf, explain):
    plan = explain(catalog.enriched(spark, sf))
    assert plan.count("ReadSchema") <= 2 and "ShuffledHashJoin" not in plan


@pytest.mark.parametrize("key", ["tfidf_terms", "split_stratified"])
def test_text_is_read_twice_at_most(spark, sf, explain, key):
    found = re.findall(r"ReadSchema: struct<(.*?)>\n", explain(catalog.QUERIES[key](spark, sf)))
    assert sum("text" in columns for columns in found) <= 2


def test_no_id_of_a_stratum_meets_in_one_task(spark, sf, explain):
    plan = explain(catalog.split_stratified(spark, sf))
    by_label = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: hashpartitioning\(_label#\d+, \d+\)", plan)
    assert by_label and not any(re.search(r"_id#|_hash#|collect", columns) for columns in by_label)


def test_all_reports_come_from_one_expand(spark, sf, explain):
    plan = explain(catalog.post_reports(spark, sf))
    assert plan.count("Location: ") == 2 and len(set(re.findall(r"\(\d+\) Expand", plan))) == 1


def test_functions_of_the_engine_become_part_of_the_plan(spark, sf, explain):
    plan = explain(catalog.sql_functions(spark, sf))
    assert "contains(" in plan.lower() or "Contains(" in plan


def test_no_folder_no_scratch(spark, monkeypatch):
    monkeypatch.setattr("postlens.session.CHECKPOINT_KEY", "spark.not.set")
    monkeypatch.setattr("postlens.session._named", [])
    with pytest.raises(RuntimeError, match="executors share"):
        scratch_path(spark, "x")


def test_scratch_folder_is_the_one_the_session_names(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_names():
    assert not [key for key in catalog.QUERIES if key == "pipeline" or re.match(r"op\d", key)]
