"""Time the headline queries: one untimed run to warm up, then the median of the timed runs.

Beside the seconds of each key the line has, from Spark's event log, how many stages read a table and how many MB were
shuffled in one run, and the seconds of a naive form of some keys: one scan for each keyword, one Python call for each row.

Settings from the environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS, and BENCH_KEYS (comma-separated query names).
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from postlens.operators.lexicon import affect_table, valence_table  # noqa: E402
from postlens.plans import catalog  # noqa: E402
from postlens.plans.post_analytics import run_posts  # noqa: E402
from postlens.session import build_session, scratch_path  # noqa: E402

HEADLINE = (
    "top_authors",
    "top_scores_by_author",
    "keyword_counts",
    "word_count",
    "hashtag_counts",
    "status_followers",
    "popular_users",
    "status_flatten",
    "weak_label_distribution",
    "sentiment_scores",
    "sentiment_rules",
    "emotion_distribution",
    "enriched_posts",
    "hydrate_join",
    "hydrate_stats",
    "hydrate_append",
    "split_stratified",
    "tfidf_terms",
    "ngram_vocab",
    "stream_track",
    "ml_metrics",
    "ml_ngram_model",
    "post_job",
)
#: Keys that are timed once, as they train a model.
LONG = {"ml_metrics", "ml_ngram_model", "post_job"}


def post_job(spark: SparkSession, folder: str) -> DataFrame:
    """The whole post job, with all of its files."""
    valences, affects = valence_table(spark, catalog.VALENCES), affect_table(spark, catalog.AFFECT_WORDS)
    run_posts(catalog.posts(spark, folder), scratch_path(spark, "job"), catalog.PARAMS, valences, affects)
    return spark.range(1)


def scan_per_keyword(spark: SparkSession, folder: str) -> DataFrame:
    rows = catalog.posts(spark, folder)
    found = [(k, rows.where(F.lower("text").contains(k)).count()) for k in catalog.KEYWORDS]
    return spark.createDataFrame(found, "keyword STRING, count BIGINT")


def label_by_row(spark: SparkSession, folder: str) -> DataFrame:
    rules = catalog.RULES

    @F.udf("string")
    def label(text):
        plain = " ".join((text or "").lower().split())
        for name, words in rules.rules:
            if any(w in plain for w in words):
                return name
        return rules.fallback_label if any(w in plain for w in rules.fallback) else rules.default

    return catalog.posts(spark, folder).groupBy(label("text").alias("weak_label")).count()


NAIVE = {"keyword_counts": scan_per_keyword, "weak_label_distribution": label_by_row}


def run_once(spark: SparkSession, name: str, query, folder: str) -> float:
    spark.sparkContext.setJobGroup(name, name)
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def measured(events: str) -> tuple[dict[str, int], dict[str, float]]:
    """Stages that read a table, and MB shuffled, by job group."""
    groups, scans, moved = {}, defaultdict(set), defaultdict(float)
    for path in glob.glob(f"{events}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        for line in open(path, errors="replace"):
            if '"SparkListenerJobStart"' in line:
                event = json.loads(line)
                groups.update(dict.fromkeys(event["Stage IDs"], event.get("Properties", {}).get("spark.jobGroup.id", "")))
            elif '"SparkListenerTaskEnd"' in line:
                event = json.loads(line)
                metrics, group = event.get("Task Metrics") or {}, groups.get(event["Stage ID"], "")
                if metrics.get("Input Metrics", {}).get("Records Read", 0):
                    scans[group].add(event["Stage ID"])
                moved[group] += metrics.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0) / 1e6
    return {k: len(v) for k, v in scans.items()}, moved


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    keys = [k for k in os.environ.get("BENCH_KEYS", "").split(",") if k] or list(HEADLINE)
    scratch = tempfile.mkdtemp(prefix="bench-")
    events = tempfile.mkdtemp(prefix="bench-events-")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.checkpoint.dir": scratch,
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{events}",
            "spark.eventLog.compress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times, naive, counted = {}, {}, {}
    for key in keys:
        query = post_job if key == "post_job" else catalog.QUERIES[key]
        counted[key] = 1 if key in LONG else runs
        if key not in LONG:
            run_once(spark, f"{key} warm-up", query, folder)
        times[key] = round(statistics.median(run_once(spark, key, query, folder) for _ in range(counted[key])), 3)
        if key in NAIVE:
            run_once(spark, f"{key} warm-up", NAIVE[key], folder)
            naive[key] = round(statistics.median(run_once(spark, f"{key} naive", NAIVE[key], folder) for _ in range(runs)), 3)
        print(key, times[key], naive.get(key, ""), file=sys.stderr, flush=True)
    spark.stop()
    scans, moved = measured(events)
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder,
        "scan_stages": {k: round(scans.get(k, 0) / counted[k], 1) for k in times},
        "shuffle_mb": {k: round(moved.get(k, 0.0) / counted[k], 2) for k in times},
        "naive_seconds": naive,
    }
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
