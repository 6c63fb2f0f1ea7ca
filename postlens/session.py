"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app_name: str = "postlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times and adaptive execution (skew splitting included)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_named: list[str] = []


def name_scratch(folder: str) -> None:
    """Name the scratch folder of sessions that leave ``spark.checkpoint.dir`` unset, for runs on a single machine."""
    _named[:] = [folder]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder the cluster names in ``spark.checkpoint.dir``, or on a single machine
    below the one that ``name_scratch`` names. Raises if there is neither."""
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base and _named and spark.sparkContext.master.startswith("local"):
        base = _named[0]
    if not base:
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and read it from there: later steps share it, and a lost executor costs no
    recomputation."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
