"""Readers. Each takes an explicit schema, so no read infers a schema by scanning the data first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens import schemas
from postlens.functions.records import flag_number
from postlens.functions.text import first_field, is_blank, post_text, with_text


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table."""
    return spark.read.parquet(path)


def read_posts(spark: SparkSession, path: str, schema: str = schemas.POST, fields: Sequence[str] | None = None, mode: str = "PERMISSIVE") -> DataFrame:
    """Posts from JSON Lines; blank lines are skipped, and a malformed line gives a row of nulls with an empty text.

    Each record without a field ``text`` gets the text of its title and body; one whose text is null gets the empty
    text. ``fields`` names the fields that the file has: the columns of all others are left out, so that later steps can
    see that they are absent. Nothing is guessed from a part of the data.
    """
    known = T.StructType.fromDDL(schema)
    if fields is not None:
        known = T.StructType([f for f in known.fields if f.name in set(fields)])
    lines = spark.read.text(path).where(~is_blank(F.col("value")))
    parsed = lines.select("value", F.from_json("value", known, {"mode": mode}).alias("_post"))
    rows = parsed.select("_post.*", F.array_contains(F.json_object_keys("value"), "text").alias("_has_text"))
    if "text" not in known.names:
        return with_text(rows.drop("_has_text"))
    title, body = (F.col(c) if c in known.names else F.lit("") for c in ("title", "selftext"))
    text = F.when(F.col("_has_text"), F.coalesce("text", F.lit(""))).otherwise(post_text(title, body))
    return rows.withColumn("text", text).drop("_has_text")


def read_posts_strict(spark: SparkSession, path: str, schema: str = schemas.POST, fields: Sequence[str] | None = None) -> DataFrame:
    """Posts from JSON Lines; blank lines are skipped, a malformed line fails the read."""
    return read_posts(spark, path, schema, fields, mode="FAILFAST")


def read_statuses(spark: SparkSession, path: str, schema: str = schemas.STATUS) -> DataFrame:
    """Nested status records; a malformed line keeps its text in the corrupt-record column."""
    return (
        spark.read.schema(f"{schema}, {schemas.CORRUPT} STRING")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .json(path)
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw text, one row per line in the column ``value``."""
    return spark.read.text(path)


def read_annotations(spark: SparkSession, path: str, schema: str = schemas.ANNOTATION) -> DataFrame:
    """Annotations from CSV with a header. Columns are matched by name, extra file columns are ignored.

    Flags may be written as whole numbers, as decimals or as words (``flag_number``).
    """
    frame = raw_annotations(spark, path)
    fields = T.StructType.fromDDL(schema).fields
    known = {name.lower(): name for name in frame.columns}

    def value(field: T.StructField) -> Column:
        if field.name.lower() not in known:
            return F.lit(None).cast(field.dataType)
        given = F.col(f"`{known[field.name.lower()]}`")
        return flag_number(given).cast(field.dataType) if isinstance(field.dataType, T.IntegerType) else given.try_cast(field.dataType)

    return frame.select(*[value(f).alias(f.name) for f in fields])


def raw_annotations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').option("multiLine", False).csv(path)


def unreadable_flags(raw: DataFrame, schema: str = schemas.ANNOTATION) -> DataFrame:
    """For each flag column of the raw annotations, the number of values that are neither empty nor a flag."""
    names = [f.name for f in T.StructType.fromDDL(schema).fields if isinstance(f.dataType, T.IntegerType)]
    known = {name.lower(): name for name in raw.columns}
    present = [n for n in names if n.lower() in known]
    bad = [F.count_if(~is_blank(F.col(f"`{known[n.lower()]}`")) & flag_number(F.col(f"`{known[n.lower()]}`")).isNull()).alias(n) for n in present]
    counted = raw.agg(*bad)
    return counted.select(F.inline(F.array(*[F.struct(F.lit(n).alias("flag"), F.col(n).alias("unreadable")) for n in present])))


def read_saved_ids(spark: SparkSession, path: str, id_col: str = "id") -> DataFrame:
    """Ids an earlier run has saved; only that column is parsed."""
    return spark.read.schema(f"{id_col} STRING").json(path).select(id_col)


def first_field_table(lines: DataFrame, name: str, value_col: str = "value", delimiter: str = ",") -> DataFrame:
    """One string column with the first delimited field of each line."""
    return lines.select(first_field(F.col(value_col), delimiter).alias(name))


def parse_statuses(lines: DataFrame, schema: str, value_col: str = "value") -> DataFrame:
    """Parse JSON text; ``parsed`` is a struct, and ``is_bad`` tells the lines that are no record.

    A line that is null, blank or malformed is bad.
    """
    with_corrupt = f"{schema}, {schemas.CORRUPT} STRING"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT}
    parsed = lines.withColumn("parsed", F.from_json(F.col(value_col), with_corrupt, options))
    return parsed.withColumn("is_bad", is_bad(F.col("parsed")))


def is_bad(parsed: Column) -> Column:
    return parsed.isNull() | parsed[schemas.CORRUPT].isNotNull()


def register_views(frames: dict[str, DataFrame]) -> None:
    """Give each frame a view name, so that it can be queried with ``spark.sql``."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
