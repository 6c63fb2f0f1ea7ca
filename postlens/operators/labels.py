"""Topic labels from ordered keyword rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.text import is_plain, normalize_text, rule_label
from postlens.params import TOPIC_RULES, LabelRules


def add_weak_labels(
    posts: DataFrame, rules: LabelRules = TOPIC_RULES, text_col: str = "text", label_col: str = "weak_label", whole_word: bool = False
) -> DataFrame:
    """Label each post by the first rule one of whose keywords its text holds.

    The text is lower-cased once, in a projection of its own, and then tested by every rule. White space is collapsed
    for keywords that hold a blank only, where their longest word occurs; and in the text for whole words or odd keywords.
    """
    keywords = [w for _, words in rules.rules for w in words] + list(rules.fallback)
    simple = not whole_word and all(map(is_plain, keywords))
    prepared = F.lower(F.coalesce(F.col(text_col), F.lit(""))) if simple else normalize_text(F.col(text_col))
    normalized = posts.withColumn("_normalized", prepared)
    return normalized.withColumn(label_col, rule_label(F.col("_normalized"), rules, whole_word, simple)).drop("_normalized")


def trainable(posts: DataFrame, text_col: str = "text", label_col: str = "weak_label", other: str = TOPIC_RULES.default) -> DataFrame:
    """Posts with a text and a label other than the default."""
    return posts.filter(is_trainable(text_col, label_col, other))


def is_trainable(text_col: str = "text", label_col: str = "weak_label", other: str = TOPIC_RULES.default) -> Column:
    return (F.length(text_col) > 0) & (F.col(label_col) != other)


def label_index(labeled: DataFrame, label_col: str = "weak_label") -> DataFrame:
    """Labels with their index: most frequent first, equal counts in alphabetic order."""
    counts = labeled.groupBy(label_col).agg(F.count(F.lit(1)).alias("count"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("less"), F.col(label_col).alias("label"))))
    return counts.agg(ordered.alias("_labels")).select(F.posexplode("_labels").alias("label_index", "_entry")).select(
        F.col("_entry.label").alias(label_col), F.col("label_index"), (-F.col("_entry.less")).alias("count")
    )
