"""The whole hydration job: annotations joined to submissions, appended to what earlier runs saved."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from postlens.operators import hydrate as h
from postlens.sources.buckets import BUCKETS, append_buckets, open_buckets
from postlens.sources.readers import read_saved_ids
from postlens.sources.sinks import write_rows


def run_hydration(
    annotations: DataFrame,
    submissions: DataFrame,
    out: str,
    platform: str,
    dataset: str,
    order_col: str | None = None,
    resume: bool = False,
    limit: int | None = None,
    table: str | None = None,
    buckets: int = BUCKETS,
) -> dict:
    """Write the hydrated posts below ``out`` and return the counts.

    Of several submissions of one id the last by ``order_col`` counts, or without it the greatest by all columns. With ``resume`` the ids already saved are
    left out and new posts are appended; a first run finds nothing saved. With ``table`` (which implies ``resume``) the
    posts are kept as a table of this name, in ``buckets`` buckets by id, so that a resumed run doesn't shuffle them.
    """
    spark = annotations.sparkSession
    wanted = h.require_unique(h.first_rows(annotations, limit))
    bodies = h.last_by_id(submissions, order_col)
    if table:
        shape = h.hydrate(wanted, bodies, platform, dataset).schema
        saved = open_buckets(spark, table, f"{out}/posts", shape, buckets=buckets).select("id")
    else:
        saved = saved_ids(spark, out) if resume else None
    # The counts need the ids as they were before this run.
    stats = h.hydration_stats(wanted, bodies, saved).first().asDict()
    posts = h.hydrate(h.unsaved(wanted, saved), bodies, platform, dataset)
    if table:
        append_buckets(posts, table, f"{out}/posts", buckets=buckets)
    else:
        write_rows(posts, f"{out}/posts", mode="append" if saved is not None else "overwrite")
    return {"output": f"{out}/posts", **stats}


def saved_ids(spark: SparkSession, out: str) -> DataFrame | None:
    """Ids of the posts below ``out``, or None where there are none yet."""
    try:
        return read_saved_ids(spark, f"{out}/posts")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
