"""Train and test splits that depend on the id only, not on how the rows are partitioned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.session import kept

SEED = 42
TRAIN_PERCENT = 80
# Leading hex digits of the hash that make a histogram bucket: 65,536 buckets per label.
BUCKET_DIGITS = 4


def split_hash(id_col: str, seed: int = SEED) -> Column:
    """A hash of seed and id in 32 hex digits."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def is_train(id_col: str, seed: int = SEED, percent: int = TRAIN_PERCENT) -> Column:
    """True for about ``percent`` of the ids. A post keeps its side when other posts are added."""
    return F.conv(F.substring(split_hash(id_col, seed), 1, 8), 16, 10).cast("bigint") % 100 < percent


def add_split(posts: DataFrame, id_col: str = "id", seed: int = SEED, percent: int = TRAIN_PERCENT) -> DataFrame:
    return posts.withColumn("split", F.when(is_train(id_col, seed, percent), "train").otherwise("test"))


def stratum_cuts(posts: DataFrame, label_col: str, id_col: str, seed: int = SEED, test_share: float = 0.2) -> DataFrame:
    """For each label the (hash, id) of its last test row: that of rank floor(share * rows) in hash order.

    Hashes and ids are written once. A histogram of counts, 65,536 buckets for each label, tells which bucket holds the
    rank; only the rows of this one are read again, ordered and numbered. So no task sees more of a label than counts
    and one bucket, also if most rows have the same label.
    """
    hashed = kept(posts.select(F.col(label_col).alias("_label"), split_hash(id_col, seed).alias("_hash"), F.col(id_col).alias("_id")), "strata")
    hashed = hashed.withColumn("_bucket", F.substring("_hash", 1, BUCKET_DIGITS))
    sizes = hashed.groupBy("_label", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    by_label = Window.partitionBy("_label")
    upto = F.sum("_n").over(by_label.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    wanted = F.floor(F.sum("_n").over(by_label) * F.lit(test_share))
    placed = sizes.select("_label", "_bucket", "_n", upto.alias("_upto"), wanted.alias("_wanted"))
    cut = placed.filter((F.col("_upto") - F.col("_n") < F.col("_wanted")) & (F.col("_wanted") <= F.col("_upto")))
    cut = cut.select("_label", "_bucket", (F.col("_wanted") - F.col("_upto") + F.col("_n")).alias("_rank"))  # one row for each label
    inside = hashed.join(cut, ["_label", "_bucket"])
    number = F.row_number().over(Window.partitionBy("_label", "_bucket").orderBy("_hash", "_id"))
    last = inside.withColumn("_number", number).filter(F.col("_number") == F.col("_rank"))
    return last.select("_label", F.col("_hash").alias("_cut_hash"), F.col("_id").alias("_cut_id"))


def add_stratified_split(
    posts: DataFrame, label_col: str = "weak_label", id_col: str = "id", seed: int = SEED, test_share: float = 0.2
) -> DataFrame:
    """Mark the same share of every label as test rows.

    The cuts are one row per label; Spark broadcasts them while they are small, so the posts are then not shuffled.
    """
    cuts = stratum_cuts(posts, label_col, id_col, seed, test_share)
    joined = posts.join(cuts, F.col(label_col) == F.col("_label"), "left")
    upto = F.struct(split_hash(id_col, seed), F.col(id_col)) <= F.struct("_cut_hash", "_cut_id")
    marked = joined.withColumn("split", F.when(F.col("_cut_hash").isNotNull() & upto, "test").otherwise("train"))
    return marked.drop("_label", "_cut_hash", "_cut_id")
