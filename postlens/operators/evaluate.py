"""Classification metrics from one count of (label, prediction) pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.operators.counts import distribution


def confusion_summary(predicted: DataFrame, label_col: str = "weak_label", prediction_col: str = "ml_predicted_label") -> DataFrame:
    return distribution(predicted, [label_col, prediction_col])


def classification_metrics(predicted: DataFrame, label_col: str = "weak_label", prediction_col: str = "ml_predicted_label") -> DataFrame:
    """One row: accuracy and F1 weighted by the size of the true classes, rounded to 4 places, and the rows.

    The posts are counted once; all else is arithmetic on the small confusion table.
    """
    pairs = predicted.groupBy(F.col(label_col).alias("_truth"), F.col(prediction_col).alias("_guess")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    both = F.explode(
        F.array(
            F.struct(F.col("_truth").alias("class"), F.col("_n").alias("support"), F.lit(0).cast("bigint").alias("guessed")),
            F.struct(F.col("_guess").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("_n").alias("guessed")),
        )
    )
    hit = F.when(F.col("_truth") == F.col("_guess"), F.col("_n")).otherwise(0)
    classes = (
        pairs.select(hit.alias("_hit"), both.alias("_side"))
        .groupBy("_side.class")
        .agg(
            F.sum("_side.support").alias("support"),
            F.sum("_side.guessed").alias("guessed"),
            # A hit is on both sides of its class.
            (F.sum("_hit") / 2).alias("hits"),
        )
    )
    f1 = F.when(F.col("support") + F.col("guessed") > 0, 2 * F.col("hits") / (F.col("support") + F.col("guessed")))
    rows = F.sum("support")
    return classes.agg(
        F.round(F.sum(F.coalesce(f1, F.lit(0.0)) * F.col("support")) / rows, 4).alias("f1"),
        F.round(F.sum("hits") / rows, 4).alias("accuracy"),
        rows.alias("rows"),
    )
