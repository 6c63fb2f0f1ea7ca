"""Nested records of unknown shape, as VARIANT values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Levels of nesting that a report goes down.
DEPTH = 4


def record(value: Column) -> Column:
    """A JSON text as a VARIANT; null where it is no JSON."""
    return F.try_parse_json(value)


def kind_of(value: Column) -> Column:
    """Kind of a VARIANT: OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, VOID and so on, without its content."""
    return F.regexp_extract(F.schema_of_variant(value), r"^[A-Z_]+", 0)


def field_kinds(records: DataFrame, value_col: str = "value", depth: int = DEPTH) -> DataFrame:
    """(path, kind, count) of the fields of JSON texts: ``$`` is the whole record, ``.name`` a field of an object and
    ``[]`` an element of an array.

    A text that is no JSON counts under ``$`` as kind MALFORMED, a null text as MISSING. Fields below ``depth`` levels are
    not looked at. Counts are partial before the shuffle, so it carries one row for each path and kind of a task.
    """
    text = F.col(value_col)
    tops = records.select(text.alias("_text"), record(text).alias("_value"))
    kind = F.when(F.col("_text").isNull(), "MISSING").when(F.col("_value").isNull(), "MALFORMED").otherwise(kind_of(F.col("_value")))
    level = tops.select(F.lit("$").alias("path"), kind.alias("kind"), "_value")
    found = level.select("path", "kind")
    for _ in range(depth):
        inside = level.where("kind IN ('OBJECT', 'ARRAY')")
        exploded = inside.lateralJoin(inside.sparkSession.tvf.variant_explode(F.col("_value").outer()))
        name = F.when(F.col("key").isNull(), "[]").otherwise(F.concat(F.lit("."), "key"))
        level = exploded.select(F.concat("path", name).alias("path"), kind_of(F.col("value")).alias("kind"), F.col("value").alias("_value"))
        found = found.union(level.select("path", "kind"))
    return found.groupBy("path", "kind").agg(F.count(F.lit(1)).alias("count"))


def field(value: Column, path: str, kind: str) -> Column:
    """A field of a JSON text as ``kind``, whatever its type there; null where it is absent or can't be read so."""
    return F.try_variant_get(record(value), path, kind)


def unfit(value: Column, path: str, kind: str) -> Column:
    """True where a field is present and not null, but can't be read as ``kind``."""
    whole = record(value)
    there = F.try_variant_get(whole, path, "variant")
    return F.coalesce(there.isNotNull() & ~F.is_variant_null(there) & F.try_variant_get(whole, path, kind).isNull(), F.lit(False))
