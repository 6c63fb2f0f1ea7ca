"""Continuous capture of records that hold a tracked term."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlens.functions.text import quoted

# Session settings that keep the state of a stream on disk and not in the heap.
DISK_STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
# Folder names of the three copies of a captured record.
QUOTED, RAW, LINES = "quoted", "raw", "lines"


def file_stream(spark: SparkSession, folder: str, schema, file_format: str = "json", pattern: str | None = None, per_trigger: int | None = None) -> DataFrame:
    """Files that arrive in a folder, as a stream."""
    reader = spark.readStream.schema(schema).format(file_format)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.load(folder)


def table_stream(spark: SparkSession, path: str, schema, file_format: str = "parquet") -> DataFrame:
    """A table as a stream, be it one file or a folder with files.

    A pattern for file names finds nothing if the table is a folder, and a plain path must not be a file. A path with a
    wildcard may be both: Spark lists whatever it stands for. This one stands for the table only.
    """
    return spark.readStream.schema(schema).format(file_format).load(f"{path[:-1]}[{path[-1]}]")


def tracks(value: Column, terms: Sequence[str], case_sensitive: bool = False) -> Column:
    """True where the text holds one of the tracked terms."""
    text = value if case_sensitive else F.lower(value)
    found = F.lit(False)
    for term in terms:
        found = found | text.contains(term if case_sensitive else term.lower())
    return F.coalesce(found, F.lit(False))


def start_capture(
    records: DataFrame,
    terms: Sequence[str],
    out: str,
    checkpoint: str,
    value_col: str = "value",
    case_sensitive: bool = False,
    available_now: bool = False,
) -> StreamingQuery:
    """Write every record that holds a tracked term three times: as a JSON string, as it is, and as a line of text.

    Each batch goes to folders named after its number and replaces what is there, so a batch that is run again after
    a failure leaves no second copy. A null record is skipped and does not stop the stream.
    """
    tracked = records.select(F.col(value_col).alias("value")).filter(tracks(F.col("value"), terms, case_sensitive))

    def write_batch(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            part = f"batch={number}"
            kept.select(quoted(F.col("value")).alias("value")).write.mode("overwrite").text(f"{out}/{QUOTED}/{part}")
            kept.write.mode("overwrite").json(f"{out}/{RAW}/{part}")
            kept.write.mode("overwrite").text(f"{out}/{LINES}/{part}")
        finally:
            kept.unpersist()

    writer = tracked.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_new_posts(
    posts: DataFrame, out: str, checkpoint: str, id_col: str = "id", time_col: str | None = None, delay: str = "7 days", available_now: bool = False
) -> StreamingQuery:
    """Append each post once, however often its id arrives.

    With a time column the state of old ids is dropped after ``delay``; without one all ids are kept as state, so set
    ``DISK_STATE`` in the session of a stream that runs for long.
    """
    if time_col:
        unseen = posts.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col])
    else:
        unseen = posts.dropDuplicates([id_col])
    writer = unseen.writeStream.format("json").option("path", out).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_captured(spark: SparkSession, out: str) -> DataFrame:
    """The records of a capture as they came in."""
    return spark.read.schema("value STRING, batch BIGINT").json(f"{out}/{RAW}").select("value")


def read_copies(spark: SparkSession, out: str) -> DataFrame:
    """The quoted and the line copy of a capture as (copy, value), as they stand in their files."""
    parts = [spark.read.schema("value STRING, batch BIGINT").text(f"{out}/{name}").select(F.lit(name).alias("copy"), "value") for name in (QUOTED, LINES)]
    return parts[0].union(parts[1])
