import collections
import hashlib
import math

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from postlens.operators import classify, features, splits
from postlens.operators.evaluate import classification_metrics, confusion_summary
from postlens.operators.labels import add_weak_labels, label_index
from postlens.plans.post_analytics import PostParams, run_posts
from postlens.session import scratch_path
from postlens.sources.sinks import load_model, save_model

TOPICS = {"hurricane": "hurricane winds tonight", "flood": "flood water rising", "wildfire": "smoke over the hills"}


def posts(spark, per_topic=20, others=6):
    rows = [(f"{n}{i}", f"{text} number {i}") for n, text in TOPICS.items() for i in range(per_topic)]
    rows += [(f"o{i}", f"a quiet day {i}") for i in range(others)]
    return spark.createDataFrame(rows, "id STRING, text STRING")


def train_side(i):
    return int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:8], 16) % 100 < 80


def test_split_depends_on_the_id_only(spark):
    frame = posts(spark)
    got = {r["id"]: r["split"] for r in splits.add_split(frame).collect()}
    assert got == {i: "train" if train_side(i) else "test" for i in got}
    assert got == {r["id"]: r["split"] for r in splits.add_split(frame.repartition(7)).collect()}


def test_stratified_split_against_sorting_each_label(spark):
    frame = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 < 2 THEN 'hot' WHEN id < 40 THEN 'rare' ELSE 'some' END AS weak_label")
    got = splits.add_stratified_split(frame).collect()
    by_label = {}
    for row in got:
        by_label.setdefault(row["weak_label"], []).append(row)
    for rows in by_label.values():
        ordered = sorted(rows, key=lambda r: (hashlib.md5(f"42:{r['id']}".encode()).hexdigest(), r["id"]))
        cut = math.floor(len(rows) * 0.2)
        assert [r["split"] for r in ordered] == ["test"] * cut + ["train"] * (len(rows) - cut)
    assert len(got) == 5000


@pytest.mark.parametrize("kind", ["hashed", "grams"])
def test_every_post_gets_a_label_of_the_training_rows(spark, kind):
    frame = splits.add_stratified_split(add_weak_labels(posts(spark)))
    trained = classify.train(frame, features=kind, max_iter=15)
    assert (trained.metrics["train_rows"], trained.metrics["test_rows"]) == (48, 12)
    assert trained.metrics["accuracy"] == 1.0 and trained.metrics["f1"] == 1.0
    predicted = classify.apply_model(trained.model, frame.drop("weak_label"))
    assert {r[classify.PREDICTED] for r in predicted.collect()} <= set(TOPICS)
    loaded = load_model(save_model(trained.model, scratch_path(spark, "model")))
    again = classify.apply_model(loaded, frame)
    key = ["id", classify.PREDICTED]
    assert sorted(again.select(*key).collect()) == sorted(predicted.select(*key).collect())


def test_too_few_rows(spark):
    frame = splits.add_split(add_weak_labels(posts(spark, 3, 9)))
    with pytest.raises(ValueError, match="not enough"):
        classify.train(frame)
    enough = splits.add_split(add_weak_labels(posts(spark, 4, 0)))
    assert classify.train(enough, min_rows=12, max_iter=2).metrics["train_rows"] > 0


def test_metrics_equal_the_evaluator(spark):
    rows = [(a, b) for a, b, n in [(0, 0, 7), (0, 1, 2), (1, 1, 4), (1, 3, 1), (2, 0, 3), (2, 2, 5)] for _ in range(n)]
    frame = spark.createDataFrame([(float(a), float(b)) for a, b in rows], "label DOUBLE, prediction DOUBLE")
    got = classification_metrics(frame, "label", "prediction").first()
    for name in ("f1", "accuracy"):
        evaluator = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=name)
        assert got[name] == round(evaluator.evaluate(frame), 4)
    assert got["rows"] == len(rows)
    assert tuple(confusion_summary(frame, "label", "prediction").first()) == (0.0, 0.0, 7)


def test_label_index_order(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "weak_label STRING")
    assert [tuple(r) for r in label_index(frame).orderBy("label_index").collect()] == [("c", 0, 2), ("a", 1, 1), ("b", 2, 1)]


def test_tfidf_with_a_word_in_every_post(spark):
    frame = spark.createDataFrame([(i, "all all " + ("even" if i % 2 == 0 else "odd")) for i in range(50)], "id BIGINT, text STRING")
    got = {(r["id"], r["term"]): (r["tf"], r["df"], r["tfidf"]) for r in features.tfidf_terms(frame).collect()}
    assert len(got) == 100
    assert got[(3, "all")] == (2, 50, 0.0)
    assert got[(4, "even")] == (1, 25, round(math.log(51 / 26), 6))


def test_tfidf_is_the_same_however_rows_are_joined(spark):
    frame = spark.createDataFrame([(i, f"all w{i % 7} w{i % 11} x{i}") for i in range(80)], "id BIGINT, text STRING")
    results = []
    for bound in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
        results.append(sorted(features.tfidf_terms(frame).collect()))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert results[0] == results[1] and len(results[0]) > 200


def test_a_null_text_gets_a_label_and_stays_null(spark):
    frame = splits.add_split(add_weak_labels(posts(spark)))
    model = classify.train(frame, max_iter=3).model
    rows = spark.createDataFrame([("x", None), ("y", "flood water")], "id STRING, text STRING")
    got = classify.apply_model(model, rows)
    assert got.columns == ["id", "text", classify.PREDICTED]
    assert {r["id"]: r["text"] for r in got.collect() if r[classify.PREDICTED]} == {"x": None, "y": "flood water"}


def test_gram_features_have_unit_length(spark):
    frame = spark.createDataFrame([(1, "aa bb aa"), (2, "bb cc")], "id BIGINT, text STRING")
    vocabulary = [(r["term"], r["count"]) for r in features.gram_vocabulary(frame, size=3).collect()]
    assert vocabulary == [("aa", 2), ("bb", 2), ("aa bb", 1)]
    model = features.gram_features(frame, size=3)
    vectors = {r["id"]: r["features"].toArray() for r in model.transform(frame).collect()}
    aa, bb, pair = 2 * (math.log(3 / 2) + 1), 1.0, math.log(3 / 2) + 1
    length = math.sqrt(aa * aa + bb * bb + pair * pair)
    assert vectors[1] == pytest.approx([aa / length, bb / length, pair / length])
    assert vectors[2] == pytest.approx([0, 1, 0])


def test_whole_post_job(spark):
    frame = posts(spark).select(
        "id", F.substring("id", 1, 2).alias("author"), F.lit("s").alias("subreddit"), F.length("text").alias("score"),
        "text", F.lit(True).alias("is_self"),
    )
    out = scratch_path(spark, "post_job")
    summary = run_posts(frame, out, PostParams(stratified=True, max_iter=10))
    assert summary["post_count"] == 66 and summary["ml_metrics"]["train_rows"] == 48

    def report(name):
        return [tuple(r) for r in spark.read.option("header", True).csv(f"{out}/{name}").collect()]

    assert report("top_authors")[0][1] == "20"
    assert report("keyword_counts")[0] == ("hurricane", "20")
    assert sum(int(n) for _, n in report("ml_distribution")) == 66
    assert ("other", "hurricane") in {r[:2] for r in report("ml_confusion_summary")} or len(report("ml_confusion_summary")) >= 4
    assert len(report("most_positive_posts")) == 50 and len(report("most_negative_posts")[0]) == 5
    enriched = spark.read.json(f"{out}/enriched_posts")
    assert {"weak_label", "ml_predicted_label", "sentiment_compound", "top_emotion", "emotion_scores"} <= set(enriched.columns)
    assert enriched.count() == 66 and enriched.select("id").distinct().count() == 66
    assert spark.read.json(f"{out}/ml_metrics").first()["accuracy"] == summary["ml_metrics"]["accuracy"]


def test_one_label_for_all_rows_is_cut_by_counts(spark):
    frame = spark.range(20_000).select(F.col("id").cast("string").alias("id"), F.lit("only").alias("weak_label"))
    rows = splits.add_stratified_split(frame).collect()
    digest = lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest()
    order = sorted((digest(r["id"]), r["id"]) for r in rows)
    assert {r["id"] for r in rows if r["split"] == "test"} == {i for _, i in order[:4000]}


def test_a_fit_on_single_words_is_the_majority(spark):
    rows = [(f"{w}{k}", w, "up" if (k % 10 < 7) == (w in ("aa", "bb")) else "down") for w in ("aa", "bb", "cc", "dd") for k in range(60)]
    frame = splits.add_split(spark.createDataFrame(rows, "id STRING, text STRING, weak_label STRING"))
    for kind in ("hashed", "grams"):
        trained = classify.train(frame, features=kind)
        got = classify.apply_model(trained.model, frame).collect()
        assert {(r["text"], r[classify.PREDICTED]) for r in got} == {("aa", "up"), ("bb", "up"), ("cc", "down"), ("dd", "down")}
        tested = [r for r in got if r["split"] == "test"]
        assert trained.metrics["accuracy"] == round(sum(r["weak_label"] == r[classify.PREDICTED] for r in tested) / len(tested), 4)


def test_texts_are_read_once_for_training(spark, tmp_path, monkeypatch):
    rows = [(f"i{k}", f"word{k % 4} and more", f"l{k % 2}") for k in range(80)]
    spark.createDataFrame(rows, "id STRING, text STRING, weak_label STRING").write.parquet(f"{tmp_path}/posts")
    read = []

    def recorded(frame, name, write=classify.kept):
        read.append((name, any("/posts/" in f for f in frame.inputFiles())))
        return write(frame, name)

    monkeypatch.setattr(classify, "kept", recorded)
    classify.train(splits.add_split(spark.read.parquet(f"{tmp_path}/posts")), features="grams", max_iter=3)
    assert read == [("training-words", True), ("training-rows", False)]


@pytest.mark.parametrize("buckets, size", [(1 << 20, 10), (64, 10), (1, 3), (128, 1), (4096, 500)])
def test_frequent_terms_are_exact(spark, buckets, size):
    terms = [f"t{int(1000 / (1 + k % 97))}" for k in range(3000)] + [f"rare{k}" for k in range(300)]
    frame = spark.createDataFrame([(t,) for t in terms], "term STRING").repartition(5)
    expected = sorted(collections.Counter(terms).items(), key=lambda x: (-x[1], x[0]))[:size]
    assert [tuple(r) for r in features.frequent_terms(frame, size, buckets).collect()] == expected


def test_no_frequent_terms(spark):
    assert features.frequent_terms(spark.createDataFrame([], "term STRING"), 5).collect() == []


@pytest.mark.parametrize("kind", ["hashed", "grams"])
def test_predictions_from_the_table_are_those_of_the_texts(spark, tmp_path, monkeypatch, kind):
    rows = [(f"{n}{i}", f"{text} number {i % 7}", n) for n, text in TOPICS.items() for i in range(30)]
    rows += [("null", None, "other"), ("empty", "", "flood"), ("o", "water in the hills", "other"), ("no", "smoke", None)]
    spark.createDataFrame(rows, "id STRING, text STRING, weak_label STRING").write.parquet(f"{tmp_path}/posts")
    frame = splits.add_split(spark.read.parquet(f"{tmp_path}/posts"))
    read = []

    def recorded(frame, name, write=classify.kept):
        read.append(any("/posts/" in f for f in frame.inputFiles()))
        return write(frame, name)

    monkeypatch.setattr(classify, "kept", recorded)
    trained = classify.train(frame, features=kind, max_iter=10, predict=("id", "split"))
    assert read.count(True) == 1 and not any("/posts/" in f for f in trained.predicted.inputFiles())
    assert trained.predicted.columns == ["id", "split", classify.PREDICTED]
    applied = classify.apply_model(trained.model, frame).select(*trained.predicted.columns)
    assert sorted(trained.predicted.collect()) == sorted(applied.collect()) and applied.count() == 94
    alone = classify.train(frame, features=kind, max_iter=10)
    assert alone.metrics == trained.metrics and alone.predicted is None


@pytest.mark.parametrize("size, most", [(5, 1000), (40, 1000), (5, 2), (10_000, 1000)])
def test_frequent_grams_count_only_pairs_that_can_be_among_them(spark, monkeypatch, size, most):
    texts = [" ".join(f"w{int(40 / (1 + (i * 7 + k * k) % 31))}" for k in range(i % 9)) for i in range(300)]
    expected = collections.Counter(g for t in texts for w in [t.split()] for g in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))])
    best = sorted(expected.items(), key=lambda x: (-x[1], x[0]))[:size]
    words = spark.createDataFrame([(t.split(),) for t in texts], "words ARRAY<STRING>").repartition(3)
    plain = []
    monkeypatch.setattr(features, "gram_counts_of", lambda *a, count=features.gram_counts_of: plain.append(1) or count(*a))
    got = features.frequent_grams(words, size, most=most)
    assert [tuple(r) for r in got.collect()] == best and len(plain) == (most == 2)


def test_words_of_unlike_ids_are_counted_without_a_shuffle(spark, explain):
    texts = ["b a b", "", None, " a  a", "x", "\n", "é e É"]
    expected = collections.Counter((i, w) for i, t in enumerate(texts) if t is not None for w in (t.lower().rstrip().replace("\n", " ").split(" ") if t.strip() or not t else []))
    once = spark.createDataFrame(list(enumerate(texts)), "id BIGINT, text STRING").repartition(3)
    found = features.term_counts(once)
    assert {(r["id"], r["term"]): r["tf"] for r in found.collect()} == expected and found.count() == len(expected)
    assert "hashpartitioning" not in explain(found)
    twice = once.union(once.filter("id > 3")).union(spark.createDataFrame([(None, "n n"), (None, "n m")], once.schema))
    got = {(r["id"], r["term"]): r["tf"] for r in features.term_counts(twice).collect()}
    assert got == {**{k: n * (2 if k[0] > 3 else 1) for k, n in expected.items()}, (None, "n"): 3, (None, "m"): 1}
