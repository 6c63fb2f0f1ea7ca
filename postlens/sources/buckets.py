"""Saved posts as a table that is bucketed and sorted by id, so that joins on the id don't shuffle it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Buckets of a saved table. A join reads them in as many tasks, so take some 200 MB of posts for each.
BUCKETS = 64


def append_buckets(frame: DataFrame, name: str, path: str, id_col: str = "id", buckets: int = BUCKETS) -> None:
    """Append rows to the bucketed table ``name``, whose files are below ``path``; it is made if there is none.

    Rows are dealt out by the bucket before they are written, so each bucket gets one file an append and not one a task.
    """
    dealt = frame.repartition(buckets, id_col)
    dealt.write.mode("append").format("parquet").option("path", path).bucketBy(buckets, id_col).sortBy(id_col).saveAsTable(name)


def open_buckets(spark: SparkSession, name: str, path: str, schema: T.StructType, id_col: str = "id", buckets: int = BUCKETS) -> DataFrame:
    """The bucketed table below ``path``, also where the session's catalog doesn't know it, as after a restart.

    ``schema``, ``id_col`` and ``buckets`` must be those it was written with.
    """
    if not spark.catalog.tableExists(name):
        place = path.replace("'", "\\'")
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY (`{id_col}`) SORTED BY (`{id_col}`) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
    return spark.table(name)
