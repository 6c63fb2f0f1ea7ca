"""The whole status job: all status reports, written as text pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from postlens import params
from postlens.operators.statuses import flatten_statuses, in_language, status_reports
from postlens.sources.sinks import write_lists, write_pairs

# Report → its two columns in the written pair, and whether it is small enough for one file.
PAIRS = {
    "hashtags": ("hashtag", "count", False),
    "user_counts": ("screen_name", "row_count", True),
    "followers": ("followers_count", "screen_name", True),
    "friends": ("friends_count", "screen_name", True),
    "statuses": ("statuses_count", "screen_name", True),
    "languages": ("user_lang", "row_count", True),
    "locations": ("screen_name", "location", False),
    "popular_users": ("screen_name", "followers_count", True),
    "time_zones": ("screen_name", "time_zone", False),
    "devices": ("keyword", "count", True),
    "events": ("keyword", "count", True),
}


def run_statuses(
    statuses: DataFrame,
    lines: DataFrame,
    out: str,
    devices: Sequence[str] = params.RAW_DEVICES,
    events: Sequence[str] = params.RAW_EVENTS,
    lang: str = "en",
) -> list[str]:
    """Write every status report and the hashtag lists of the chosen language; return the report names."""
    reports = status_reports(statuses, lines, devices, events, lang)
    for name, report in reports.items():
        first, second, one_file = PAIRS[name]
        write_pairs(report, f"{out}/{name}", first, second, one_file)
    write_lists(flatten_statuses(in_language(statuses, lang)), f"{out}/hashtag_lists", "hashtags")
    return [*reports, "hashtag_lists"]
