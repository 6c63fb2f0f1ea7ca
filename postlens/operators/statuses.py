"""Operators on nested status records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.records import created_epoch, created_timestamp, names_of, original_text
from postlens.operators.counts import keyword_counts, top_groups


def in_language(statuses: DataFrame, lang: str = "en") -> DataFrame:
    return statuses.filter(F.col("lang") == lang)


def user_counts(statuses: DataFrame, k: int = 10) -> DataFrame:
    """Users with the most rows."""
    return top_groups(statuses.select(F.col("user.screen_name").alias("screen_name")), "screen_name", k, "row_count")


def user_value_groups(statuses: DataFrame, field: str, k: int) -> DataFrame:
    """(value, user) groups with the most rows; a user whose value changed has several groups."""
    pairs = statuses.select(F.col(f"user.{field}").alias(field), F.col("user.screen_name").alias("screen_name"))
    return top_groups(pairs, [field, "screen_name"], k, "row_count")


def user_value_leaders(statuses: DataFrame, field: str, k: int) -> DataFrame:
    """Users with the highest value of a field, one row per user."""
    return (
        statuses.groupBy(F.col("user.screen_name").alias("screen_name"))
        .agg(F.max(f"user.{field}").alias(field))
        .orderBy(F.desc_nulls_last(field), "screen_name")
        .limit(k)
    )


def user_languages(statuses: DataFrame, k: int = 15) -> DataFrame:
    """User languages with the most rows."""
    return top_groups(statuses.select(F.col("user.lang").alias("user_lang")), "user_lang", k, "row_count")


def user_locations(statuses: DataFrame) -> DataFrame:
    """User and location of the rows that have a location."""
    return statuses.filter(F.col("user.location").isNotNull()).select(
        F.col("user.screen_name").alias("screen_name"), F.col("user.location").alias("location")
    )


def user_time_zones(statuses: DataFrame) -> DataFrame:
    """User and time zone, sorted by zone descending with nulls last, then by user.

    The user is part of the sort key, so a zone that holds a large share of the rows spans several range
    partitions.
    """
    return statuses.select(
        F.col("user.screen_name").alias("screen_name"), F.col("user.time_zone").alias("time_zone")
    ).orderBy(F.desc_nulls_last("time_zone"), "screen_name")


def popular_users(statuses: DataFrame, users: int = 10, groups: int = 50) -> DataFrame:
    """Follower counts of the most active users: two top-k lists joined on the user, most followers first.

    Both sides end in a limit, so the broadcast side has at most ``groups`` rows.
    """
    active = user_counts(statuses, users).select("screen_name")
    followers = user_value_groups(statuses, "followers_count", groups).select("screen_name", "followers_count")
    return (
        active.join(F.broadcast(followers), "screen_name")
        .distinct()
        .orderBy(F.desc_nulls_last("followers_count"), "screen_name")
    )


def hashtag_arrays(statuses: DataFrame, *keep: str) -> DataFrame:
    """Hashtag names per row, rows without hashtags left out."""
    tags = names_of(F.col("entities.hashtags.text"))
    return statuses.select(*keep, tags.alias("hashtags")).filter(F.size("hashtags") > 0)


def hashtag_rows(statuses: DataFrame, *keep: str) -> DataFrame:
    """One row per hashtag occurrence."""
    # The outer explode keeps Spark from inferring a filter on the size of the array, which would build it twice.
    rows = statuses.select(*keep, F.explode_outer("entities.hashtags.text").alias("hashtag"))
    return rows.filter(F.col("hashtag").isNotNull())


def hashtag_counts(statuses: DataFrame) -> DataFrame:
    return hashtag_rows(statuses).groupBy("hashtag").agg(F.count(F.lit(1)).alias("count"))


def flatten_statuses(statuses: DataFrame) -> DataFrame:
    """One flat record per status.

    A row whose date cannot be parsed is left out. A caller that wants one language only filters before.
    """
    flat = statuses.select(
        "id",
        "created_at",
        created_epoch(F.col("created_at")).alias("created_epoch"),
        original_text(F.col("text"), F.col("retweeted_status.text")).alias("text"),
        names_of(F.col("entities.hashtags.text")).alias("hashtags"),
        names_of(F.col("entities.user_mentions.screen_name")).alias("mentions"),
        names_of(F.col("entities.urls.expanded_url")).alias("urls"),
        names_of(F.col("entities.media.media_url")).alias("media_urls"),
        F.col("user.followers_count").alias("followers_count"),
        F.col("user.friends_count").alias("friends_count"),
    )
    return flat.filter(F.col("created_epoch").isNotNull())


def with_created_timestamp(statuses: DataFrame, name: str = "created_ts") -> DataFrame:
    return statuses.withColumn(name, created_timestamp(F.col("created_at")))


def status_reports(
    statuses: DataFrame, lines: DataFrame, devices: Sequence[str], events: Sequence[str], lang: str = "en"
) -> dict[str, DataFrame]:
    """The status reports by name. ``lines`` holds the raw records, one per row."""
    chosen = in_language(statuses, lang)
    return {
        "hashtags": hashtag_counts(statuses),
        "user_counts": user_counts(chosen, 10),
        "followers": user_value_groups(chosen, "followers_count", 50),
        "friends": user_value_groups(chosen, "friends_count", 50),
        "statuses": user_value_groups(chosen, "statuses_count", 10),
        "languages": user_languages(statuses, 15),
        "locations": user_locations(chosen),
        "popular_users": popular_users(chosen),
        "time_zones": user_time_zones(chosen),
        "devices": keyword_counts(lines, devices, "value", case_sensitive=True),
        "events": keyword_counts(lines, events, "value", case_sensitive=True),
    }
