"""Writers. A result that grows with the data is never forced into one task."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_report(frame: DataFrame, path: str) -> None:
    """A small report (a top-k or a distribution) as CSV with a header, in one part file.

    Only for results that are already aggregated: the single task reads the last, small stage.
    """
    frame.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_rows(frame: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Rows as JSON Lines, one part file per task."""
    frame.write.mode(mode).json(path)


def write_pairs(frame: DataFrame, path: str, first: str, second: str, one_file: bool = False) -> None:
    """Two columns as text lines of the form ``(first,second)``; a null is written as ``null``."""
    lines = frame.select(F.concat(F.lit("("), shown(F.col(first)), F.lit(","), shown(F.col(second)), F.lit(")")).alias("value"))
    (lines.coalesce(1) if one_file else lines).write.mode("overwrite").text(path)


def shown(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("null"))


def write_lists(frame: DataFrame, path: str, column: str) -> None:
    """One array column as text, one JSON list per line."""
    frame.select(F.to_json(F.col(column)).alias("value")).write.mode("overwrite").text(path)


def write_metrics(frame: DataFrame, path: str) -> None:
    """A one-row frame of metrics as a JSON document."""
    frame.coalesce(1).write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
