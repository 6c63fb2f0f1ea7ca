"""The whole post job: enrich, report, label, classify, write."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens import params
from postlens.operators import classify, counts
from postlens.operators.emotion import fill_emotions
from postlens.operators.labels import add_weak_labels
from postlens.operators.lexicon import affect_table, join_scores, valence_table
from postlens.operators.sentiment import fill_scores, sentiment_and_emotion
from postlens.operators.splits import add_split, add_stratified_split
from postlens.sources.sinks import save_model, write_metrics, write_report, write_rows


@dataclass(frozen=True)
class PostParams:
    """What the post job is run with; the column names are those of the post schema by default."""

    keywords: Sequence[str] = params.STORM_KEYWORDS
    rules: params.LabelRules = params.TOPIC_RULES
    sentiment_rules: params.SentimentRules = params.SENTIMENT_RULES
    affects: Sequence[str] = params.AFFECTS
    ties: str = "first_seen"
    id_col: str = "id"
    text_col: str = "text"
    author_col: str = "author"
    community_col: str = "subreddit"
    score_col: str = "score"
    type_col: str = "is_self"
    stratified: bool = False
    features: str = "hashed"
    max_iter: int | None = None
    min_rows: int = 10


def enrich(posts: DataFrame, valences: DataFrame, affects: DataFrame, p: PostParams = PostParams()) -> DataFrame:
    """Posts with sentiment, emotion and weak label.

    All scores come from one pass over the text, and one join adds them to the posts.
    """
    scores = sentiment_and_emotion(posts, valences, affects, p.id_col, p.text_col, p.sentiment_rules, p.affects, p.ties)
    scored = fill_emotions(fill_scores(join_scores(posts, scores, p.id_col, p.text_col)))
    return add_weak_labels(scored, p.rules, p.text_col)


def report_roles(p: PostParams = PostParams()) -> dict[str, str]:
    """The columns that the reports group by."""
    return {
        "author": p.author_col, "community": p.community_col, "type": p.type_col, "sentiment": "sentiment_label",
        "emotion": "top_emotion", "label": "weak_label", "predicted": "ml_predicted_label",
    }


def nlp_reports(enriched: DataFrame, p: PostParams = PostParams()) -> dict[str, DataFrame]:
    """Distributions of sentiment and emotion, and the most positive and most negative posts."""
    return {
        "sentiment_distribution": counts.distribution(enriched, "sentiment_label"),
        "emotion_distribution": counts.distribution(enriched, "top_emotion"),
        **extreme_reports(enriched, p),
    }


def extreme_reports(enriched: DataFrame, p: PostParams = PostParams()) -> dict[str, DataFrame]:
    """The most positive and most negative posts."""
    shown = [c for c in (p.author_col, p.community_col) if c in enriched.columns]
    shown += ["sentiment_label", "top_emotion", "sentiment_compound"]
    columns = [p.id_col, *shown]
    return {
        name: counts.extreme_posts(enriched, "sentiment_compound", p.id_col, columns, highest=highest).select(*shown)
        for name, highest in (("most_positive_posts", True), ("most_negative_posts", False))
    }


def with_split(labeled: DataFrame, p: PostParams = PostParams()) -> DataFrame:
    if p.stratified:
        return add_stratified_split(labeled, "weak_label", p.id_col)
    return add_split(labeled, p.id_col)


def run_posts(
    posts: DataFrame, out: str, p: PostParams = PostParams(), valences: DataFrame | None = None, affects: DataFrame | None = None
) -> dict:
    """Write all reports, the model and the enriched posts below ``out``; return a short summary.

    The enriched posts are written once as a table, and every later step reads that table: nothing is
    scored twice, and a lost executor costs no recomputation. All counts by author, community, type, sentiment, emotion
    and label, and their number, come from one scan by grouping sets, written as a small table that the reports read.
    """
    spark = posts.sparkSession
    valences = valences if valences is not None else valence_table(spark, params.SEED_VALENCES)
    affects = affects if affects is not None else affect_table(spark, params.SEED_AFFECTS)
    enrich(posts, valences, affects, p).write.mode("overwrite").parquet(f"{out}/enriched_table")
    enriched = spark.read.parquet(f"{out}/enriched_table")

    trained = classify.train(
        with_split(enriched, p), "weak_label", p.text_col, features=p.features, other=p.rules.default,
        min_rows=p.min_rows, max_iter=p.max_iter,
    )
    model_path = save_model(trained.model, f"{out}/model")
    classify.apply_model(trained.model, enriched).write.mode("overwrite").parquet(f"{out}/predicted_table")
    predicted = spark.read.parquet(f"{out}/predicted_table")
    write_rows(predicted.withColumn("emotion_scores", F.to_json("emotion_scores")), f"{out}/enriched_posts")

    keys = counts.report_keys(predicted.columns, report_roles(p))
    score = p.score_col if p.score_col in predicted.columns else None
    counts.grouped_counts(predicted, keys, max_of=score).write.mode("overwrite").parquet(f"{out}/post_groups")
    reports = counts.grouped_reports(spark.read.parquet(f"{out}/post_groups"), keys, score)
    reports["keyword_counts"] = counts.keyword_counts(predicted, p.keywords, p.text_col)
    reports.update(extreme_reports(predicted, p))
    for name, report in reports.items():
        write_report(report, f"{out}/{name}")
    write_metrics(classify.metrics_frame(posts, trained, model_path=model_path), f"{out}/ml_metrics")
    return {
        "output_dir": out,
        "post_count": reports["sentiment_distribution"].agg(F.sum("count")).first()[0] or 0,
        "ml_metrics": {**trained.metrics, "model_path": model_path},
    }
