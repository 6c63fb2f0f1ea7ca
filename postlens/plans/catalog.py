"""Every operator as a named query over the star-schema, event and document tables.

Each query reads whole tables. Parameters (keywords, rules, lexicons) are chosen so that they hit the words that occur
in the documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import partial, reduce

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens import schemas
from postlens.functions import records, text
from postlens.functions.matcher import rule_label_once
from postlens.functions.sql import register_functions
from postlens.functions.symbols import symbol_words
from postlens.operators import classify, counts, emotion, evaluate, features, hydrate, labels, sentiment, shapes, splits, statuses
from postlens.operators.lexicon import affect_table, valence_table
from postlens.params import LabelRules, SentimentRules
from postlens.plans import hydration
from postlens.plans.post_analytics import PostParams, enrich, report_roles
from postlens.session import kept, scratch_path
from postlens.sources import readers, sinks, tail
from postlens.streaming import capture

Query = Callable[[SparkSession, str], DataFrame]

KEYWORDS = ("license", "apache", "token", "free", "ment", "thing", "nicht", "plus", "zzz")
RAW_TERMS = ("Apache", "License", "Thing", "The")
# Three-letter keywords by rule, most of which occur somewhere, and the keywords above: 405 in all.
MANY_KEYWORDS = (*KEYWORDS, *(a + b + c for a in "bcdfglmnprst" for b in "aeiou" for c in "lmnrst"), *(a + b for a in "lmnrst" for b in "aeiouy"))
SYMBOLS = {"é": "thing", "%": "is it", "$": "no", "*": "not", "É": "LICENSE"}
DEVICES = ("click", "error", "purchase", "view")
RULES = LabelRules(
    rules=(
        ("legal", ("license", "apache")),
        ("de_func", ("nicht", "ungen")),
        ("es_suffix", ("mente", "queque")),
        ("en_stem", ("thanedble", "eriner")),
    ),
    fallback=("free", "token", "thing"),
    fallback_label="general",
)
VALENCES = {
    "is": 0.8,
    "that": 1.9,
    "are": -0.7,
    "be": 2.1,
    "it": -1.9,
    "no": -1.2,
    "der": 1.1,
    "que": -2.4,
    "thing": 2.7,
    "in": -0.9,
    "than": 1.3,
    "le": 0.9,
    "license": 1.7,
}
SENTIMENT = SentimentRules(
    boosters_up=("with", "by", "la", "nd"),
    boosters_down=("as", "de", "ou"),
    booster_phrases_down=("of the", "to the", "the for"),
    negations=("was", "en", "not"),
    idioms={"is the": 2.5, "and that": -1.5, "the is": 0.5, "that the of": 1.4, "the to": -0.6, "is and": 3.0},
    contrast="from",
    never="and",
    never_links=("to", "this"),
    doubt=("for", "on"),
    least="at",
    least_lead=("the", "of"),
    not_a_booster=("it", "is"),
)
MASKED = ("license", "apache", "mente", "queque")
AFFECT_WORDS = {
    "is": ("joy", "positive"),
    "that": ("fear",),
    "de": ("anger", "negative"),
    "of": ("trust",),
    "and": ("anticipation", "surprise"),
    "la": ("joy", "sadness"),
    "license": ("disgust", "trust", "positive"),
    "der": ("fear", "negative"),
    "el": ("sadness",),
}
PARAMS = PostParams(keywords=KEYWORDS, rules=RULES, sentiment_rules=SENTIMENT)


# --- tables in the roles of posts, statuses, annotations and submissions ---------------------------------------------


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return readers.read_table(spark, f"{sf}/{name}.parquet")


def posts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as posts."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("author"),
        F.col("lang").alias("subreddit"),
        F.col("n_chars").alias("score"),
        "text",
    )


def post_reports(spark: SparkSession, sf: str) -> DataFrame:
    """All counts of the post job but those of the model, from one scan: report, keys, number of posts, highest score."""
    rows = labels.add_weak_labels(typed_posts(spark, sf), RULES)
    rows = rows.withColumn("sentiment_label", sentiment.sentiment_label(F.length("text") % 7 - 3.0)).withColumn("ml_predicted_label", F.col("subreddit"))
    keys = counts.report_keys(rows.columns, report_roles(PARAMS))
    grouped = counts.grouped_counts(rows, keys, max_of="score")
    shown = F.create_map(*[x for name, columns in keys.items() for x in (F.lit(name), F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]))])
    return grouped.select("report", F.element_at(shown, F.col("report")).alias("keys"), "count", "max_score")


def sql_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Labels and sentiment by functions of the engine in one SQL text on a view."""
    register_functions(spark, RULES)
    readers.register_views({"all_posts": typed_posts(spark, sf)})
    return spark.sql(
        "SELECT id, weak_label(text) AS weak_label, sentiment_label(score / 5000 - 1.0D) AS sentiment_label, "
        "length(normalized_text(text)) AS normalized_length, is_set(CAST(is_self AS STRING)) AS is_self FROM all_posts"
    )


def ml_single_words(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions for posts of one word each, whose best label is known: the one that most training rows of the word have.

    The word is the last digit of the id. One post in ten has the other label, so no word is pure.
    """
    word = F.col("id") % 10
    label = F.when((word < 5) != (F.floor(F.col("id") / 10) % 10 == 3), "low").otherwise("high")
    rows = posts(spark, sf).select("id", F.concat(F.lit("word"), word.cast("string")).alias("text"), label.alias("weak_label"))
    split = splits.add_split(rows)
    return classify.apply_model(classify.train(split).model, split).select("id", "weak_label", "split", classify.PREDICTED)


def first_line(value: Column) -> Column:
    return F.substring_index(value, "\n", 1)


def other_lines(value: Column) -> Column:
    return F.substring(value, F.length(first_line(value)) + 2, F.length(value))


def titled_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as posts with title and body in place of a text."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("author"),
        F.col("lang").alias("subreddit"),
        first_line(F.col("text")).alias("title"),
        other_lines(F.col("text")).alias("selftext"),
        F.col("n_chars").alias("score"),
    )


def typed_posts(spark: SparkSession, sf: str) -> DataFrame:
    flags = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), (F.col("toxic") == 1).alias("is_self"))
    return posts(spark, sf).join(flags, "id", "left")


def labeled(spark: SparkSession, sf: str) -> DataFrame:
    return labels.add_weak_labels(posts(spark, sf), RULES)


def names(*values: Column) -> Column:
    return F.array_compact(F.array(*values))


def order_statuses(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customer as nested status records."""
    region = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    places = table(spark, sf, "nation").join(region, "n_regionkey").withColumnRenamed("n_nationkey", "c_nationkey")
    users = table(spark, sf, "customer").join(places, "c_nationkey").withColumnRenamed("c_custkey", "o_custkey")
    orders = table(spark, sf, "orders").join(users, "o_custkey")
    day = F.col("o_orderdate")
    tags = names(F.col("c_mktsegment"), F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority")))
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.date_format(day, "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "), F.date_format(day, "yyyy")).alias("created_at"),
        F.when(F.col("o_orderstatus") == "F", "en").otherwise(F.lower("o_orderstatus")).alias("lang"),
        F.col("o_orderpriority").alias("text"),
        F.struct(
            F.col("c_name").alias("screen_name"),
            F.floor("c_acctbal").cast("bigint").alias("followers_count"),
            F.col("c_nationkey").cast("bigint").alias("friends_count"),
            F.floor(F.col("o_totalprice") / 50000).cast("bigint").alias("statuses_count"),
            F.col("c_mktsegment").alias("lang"),
            F.when(F.col("c_acctbal") >= 0, F.col("n_name")).alias("location"),
            F.col("r_name").alias("time_zone"),
        ).alias("user"),
        F.struct(
            F.transform(tags, lambda t: F.struct(t.alias("text"))).alias("hashtags"),
            F.array(F.struct(F.col("n_name").alias("screen_name"))).alias("user_mentions"),
            F.array(F.struct(F.concat(F.lit("http://"), F.col("n_name")).alias("expanded_url"))).alias("urls"),
            F.when(
                F.col("c_acctbal") > 5000, F.array(F.struct(F.concat(F.lit("img/"), F.col("c_name")).alias("media_url")))
            ).alias("media"),
        ).alias("entities"),
        F.when(F.col("c_nationkey") > 12, F.struct(F.col("c_mktsegment").alias("text"))).alias("retweeted_status"),
    )


def document_statuses(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as status records: long words are hashtags, capitalised words are mentions."""

    def found(pattern: str, field: str) -> Column:
        hits = F.array_distinct(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
        return F.transform(hits, lambda t: F.struct(t.alias(field)))

    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        "lang",
        F.struct(
            found("[A-Za-z]{8,}", "text").alias("hashtags"),
            found("[A-Z][a-z]{4,}", "screen_name").alias("user_mentions"),
            F.when(F.col("text").contains("http"), found(r"https?://[A-Za-z0-9./_-]+", "expanded_url")).alias("urls"),
        ).alias("entities"),
    )


def annotations(spark: SparkSession, sf: str) -> DataFrame:
    """Labels as annotations; the flags that labels do not have are null."""
    given = {
        "id": F.col("doc_id").cast("string"),
        "Information_Integrity": F.concat(F.lit("q"), F.col("quality")),
        "Linguistic_Bias": F.col("toxic"),
        "Casualty": F.col("quality"),
        "Damage": 1 - F.col("quality"),
        "Recovery": F.col("toxic"),
    }
    fields = spark.createDataFrame([], schemas.ANNOTATION).schema.fields
    return table(spark, sf, "labels").select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )


def submissions(spark: SparkSession, sf: str) -> DataFrame:
    return titled_posts(spark, sf).select(
        "id",
        "title",
        "selftext",
        "subreddit",
        F.when(F.col("author") != "src1", F.col("author")).alias("author"),
        F.when(F.col("subreddit") != "fr", F.col("score")).alias("score"),
        F.lit(None).cast("bigint").alias("num_comments"),
        F.lit(0).cast("bigint").alias("created_utc"),
        F.when(F.col("subreddit") == "en", F.concat(F.lit("/p/"), "id")).otherwise("").alias("permalink"),
        F.concat(F.lit("/full/"), "id").alias("full_link"),
        F.when(F.col("subreddit") != "es", F.col("subreddit") == "en").alias("is_self"),
    )


def turn_submissions(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as submissions of which several share an id."""
    return table(spark, sf, "conversations").select(
        F.col("conv_id").cast("string").alias("id"), "turn", F.col("role").alias("title"), F.col("text").alias("selftext")
    )


def saved_pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("id"))


# --- sources and sinks, each through files in the shared scratch folder ----------------------------------------------


def view_sql(spark: SparkSession, sf: str) -> DataFrame:
    readers.register_views({"all_statuses": order_statuses(spark, sf)})
    readers.register_views({"english_statuses": spark.sql("SELECT * FROM all_statuses WHERE lang = 'en'")})
    return spark.sql(
        "SELECT user.time_zone AS time_zone, user.lang AS user_lang, count(*) AS row_count, "
        "max(user.followers_count) AS most_followers FROM english_statuses GROUP BY user.time_zone, user.lang"
    )


def titled_file(spark: SparkSession, sf: str) -> str:
    """Posts with title and body and without a text, as JSON Lines."""
    path = scratch_path(spark, "posts")
    sinks.write_rows(titled_posts(spark, sf), path)
    return path


def json_posts(spark: SparkSession, sf: str) -> DataFrame:
    return readers.read_posts(spark, titled_file(spark, sf)).select("id", "author", "subreddit", "score", "text")


def json_titled_strict(spark: SparkSession, sf: str) -> DataFrame:
    return readers.read_posts_strict(spark, titled_file(spark, sf)).select("id", "author", "subreddit", "score", "text")


def json_posts_strict(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "posts")
    sinks.write_rows(posts(spark, sf).withColumn("id", F.col("id").cast("string")), path)
    return readers.read_posts_strict(spark, path).select("id", "author", "subreddit", "score", "text")


def json_optional_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The reports of a file whose posts have no community and no type, with their rows."""
    given = ("id", "author", "title", "selftext", "score")
    rows = readers.read_posts(spark, titled_file(spark, sf), fields=given)
    reports = counts.descriptive_reports(rows, KEYWORDS)
    parts = [f.agg(F.count(F.lit(1)).alias("report_rows")).select(F.lit(n).alias("report"), "report_rows") for n, f in reports.items()]
    return reduce(DataFrame.union, parts)


def status_json(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "statuses")
    sinks.write_rows(order_statuses(spark, sf), path)
    read = readers.read_statuses(spark, path).filter(F.col(schemas.CORRUPT).isNull())
    return projected(read)


def text_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    table(spark, sf, "documents").select("text").write.text(path)
    return readers.read_lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("count"))


def annotation_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "annotations")
    written = annotations(spark, sf).withColumns(
        {
            "Linguistic_Bias": F.when(F.col("Linguistic_Bias") == 1, "True").otherwise("no"),
            "Casualty": F.col("Casualty").cast("double").cast("string"),
        }
    )
    written.write.option("header", True).csv(path)
    return readers.read_annotations(spark, path).select("id", "Information_Integrity", "Linguistic_Bias", "Casualty", "Damage", "Advice")


def report_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "report")
    sinks.write_report(counts.distribution(posts(spark, sf), ["author", "subreddit"]), path)
    return spark.read.option("header", True).schema("author STRING, subreddit STRING, count BIGINT").csv(path)


def pair_text(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "pairs")
    statuses_en = statuses.in_language(order_statuses(spark, sf))
    flat = statuses_en.select(F.col("user.screen_name").alias("screen_name"), F.col("user.location").alias("location"))
    sinks.write_pairs(flat, path, "screen_name", "location")
    return readers.read_lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("count"))


def hashtag_lists(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "lists")
    sinks.write_lists(statuses.hashtag_arrays(order_statuses(spark, sf)), path, "hashtags")
    return readers.read_lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("count"))


def first_fields(spark: SparkSession, sf: str) -> DataFrame:
    return readers.first_field_table(table(spark, sf, "documents"), "first_field", "text")


# --- projections and filters -----------------------------------------------------------------------------------------


def post_text(spark: SparkSession, sf: str) -> DataFrame:
    return text.with_text(titled_posts(spark, sf)).select("id", "text")


def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    return posts(spark, sf).select("id", text.normalize_text(F.col("text")).alias("normalized"))


def projected(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id",
        "lang",
        F.col("user.screen_name").alias("screen_name"),
        F.col("user.followers_count").alias("followers_count"),
        F.col("user.friends_count").alias("friends_count"),
        F.col("user.statuses_count").alias("statuses_count"),
        F.col("user.location").alias("location"),
        F.col("user.time_zone").alias("time_zone"),
    )


def nested_project(spark: SparkSession, sf: str) -> DataFrame:
    return projected(order_statuses(spark, sf))


def lang_filter(spark: SparkSession, sf: str) -> DataFrame:
    return statuses.in_language(order_statuses(spark, sf)).select("id", "lang", "text")


def joined(value: Column) -> Column:
    return F.array_join(F.array_sort(value), ",")


def entity_arrays(spark: SparkSession, sf: str) -> DataFrame:
    rows = document_statuses(spark, sf).select(
        "id",
        records.names_of(F.col("entities.hashtags.text")).alias("hashtags"),
        records.names_of(F.col("entities.user_mentions.screen_name")).alias("mentions"),
        records.names_of(F.col("entities.urls.expanded_url")).alias("urls"),
    )
    return rows.select(
        "id",
        F.size("hashtags").cast("bigint").alias("hashtag_count"),
        *[joined(F.col(c)).alias(c) for c in ("hashtags", "mentions", "urls")],
    )


def status_flatten(spark: SparkSession, sf: str) -> DataFrame:
    flat = statuses.flatten_statuses(statuses.in_language(order_statuses(spark, sf)))
    lists = ("hashtags", "mentions", "urls", "media_urls")
    return flat.withColumns({c: joined(F.col(c)) for c in lists})


def created_epoch(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("ts")
    written = F.concat(F.date_format(ts, "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "), F.date_format(ts, "yyyy"))
    rows = table(spark, sf, "events").select("event_id", written.alias("created_at"))
    return rows.select("event_id", records.created_epoch(F.col("created_at")).alias("created_epoch"))


def reshare_text(spark: SparkSession, sf: str) -> DataFrame:
    """Odd turns share the turn before them."""
    turns = table(spark, sf, "conversations")
    shared = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("original"))
    rows = turns.join(shared, ["conv_id", "turn"], "left")
    original = F.when(F.col("turn") % 2 == 1, F.col("original"))
    return rows.select("conv_id", "turn", records.original_text(F.col("text"), original).alias("shown_text"))


def event_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Event properties as raw JSON lines; those of the error events are cut off in the middle."""
    broken = F.substring(F.col("props"), F.lit(1), F.length("props") - 2)
    value = F.when(F.col("event_type") == "error", broken).otherwise(F.col("props"))
    return table(spark, sf, "events").select("event_id", "event_type", value.alias("value"))


def bad_record_filter(spark: SparkSession, sf: str) -> DataFrame:
    parsed = readers.parse_statuses(event_lines(spark, sf), "k BIGINT")
    return parsed.filter(~F.col("is_bad")).select("event_id", F.col("parsed.k").alias("k"))


def bad_record_counts(spark: SparkSession, sf: str) -> DataFrame:
    parsed = readers.parse_statuses(event_lines(spark, sf), "k BIGINT")
    return parsed.groupBy("event_type").agg(
        F.count_if("is_bad").alias("dropped"), F.count_if(~F.col("is_bad")).alias("kept")
    )


def loose_records(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON lines whose field ``user`` has another type in each type of event; errors are cut off."""
    user = F.col("user_id").cast("string")
    kinds = {
        "click": user,
        "view": F.concat(F.lit('"'), user, F.lit('"')),
        "purchase": F.concat(F.lit('{"n":'), user, F.lit("}")),
        "signup": F.concat(F.lit('["u",'), user, F.lit(",null]")),
    }
    shown = reduce(lambda chain, kind: chain.when(F.col("event_type") == kind, kinds[kind]), kinds, F.when(F.lit(False), user))
    line = F.concat(F.lit('{"user":'), F.coalesce(shown, F.lit("")), F.lit(',"props":'), F.col("props"), F.lit("}"))
    return table(spark, sf, "events").select("event_id", line.alias("value"))


def record_fields(spark: SparkSession, sf: str) -> DataFrame:
    return shapes.field_kinds(loose_records(spark, sf))


def record_typed(spark: SparkSession, sf: str) -> DataFrame:
    """The user of each record as a number, and whether it has one that is none."""
    value = F.col("value")
    return loose_records(spark, sf).select(
        "event_id", shapes.field(value, "$.user", "bigint").alias("user"), shapes.unfit(value, "$.user", "bigint").alias("is_unfit")
    )


def flag_labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = hydrate.with_flag_labels(table(spark, sf, "labels"), ["quality", "toxic"], "names")
    return rows.select("doc_id", F.array_join("names", ",").alias("names"))


def trainable_rows(spark: SparkSession, sf: str) -> DataFrame:
    return labels.trainable(labeled(spark, sf)).select("id", "weak_label")


# --- counts ----------------------------------------------------------------------------------------------------------


def top_authors(spark: SparkSession, sf: str) -> DataFrame:
    return counts.top_groups(posts(spark, sf), "author", 10)


def community_counts(spark: SparkSession, sf: str) -> DataFrame:
    return counts.top_groups(posts(spark, sf), "subreddit", 15)


def top_scores_by_author(spark: SparkSession, sf: str) -> DataFrame:
    return counts.top_scores(posts(spark, sf))


def keyword_counts(spark: SparkSession, sf: str) -> DataFrame:
    return counts.keyword_counts(posts(spark, sf), KEYWORDS)


def keyword_counts_cs(spark: SparkSession, sf: str) -> DataFrame:
    return counts.keyword_counts(posts(spark, sf), RAW_TERMS, case_sensitive=True)


def keyword_counts_many(spark: SparkSession, sf: str) -> DataFrame:
    return counts.many_keyword_counts(posts(spark, sf), MANY_KEYWORDS)


def device_counts(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "events").select(F.to_json(F.struct("event_id", "event_type", "props")).alias("value"))
    return counts.keyword_counts(lines, DEVICES, "value", case_sensitive=True)


def post_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    return counts.distribution(typed_posts(spark, sf), "is_self")


def word_count(spark: SparkSession, sf: str) -> DataFrame:
    lines = posts(spark, sf).select(F.explode_outer(F.split("text", "\n", -1)).alias("value"))
    return counts.word_counts(lines)


def post_count(spark: SparkSession, sf: str) -> DataFrame:
    return counts.row_count(posts(spark, sf))


def from_statuses(operator: Callable[..., DataFrame], *args, english: bool = True) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = order_statuses(spark, sf)
        return operator(statuses.in_language(rows) if english else rows, *args)

    return query


def hashtag_rows(spark: SparkSession, sf: str) -> DataFrame:
    return statuses.hashtag_rows(document_statuses(spark, sf), "id")


def hashtag_counts(spark: SparkSession, sf: str) -> DataFrame:
    return statuses.hashtag_counts(document_statuses(spark, sf))


# --- labels, sentiment, emotion --------------------------------------------------------------------------------------


def weak_labels(spark: SparkSession, sf: str) -> DataFrame:
    return labeled(spark, sf).select("id", "weak_label")


def weak_labels_once(spark: SparkSession, sf: str) -> DataFrame:
    """The weak labels from one pass over each text for the keywords of all rules."""
    return posts(spark, sf).select("id", rule_label_once(F.col("text"), RULES).alias("weak_label"))


def weak_label_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return counts.distribution(labeled(spark, sf), "weak_label")


def masked_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Labels that are left once the keywords of two rules are masked: those of the other rules."""
    masked = posts(spark, sf).withColumn("text", text.mask_keywords(F.col("text"), MASKED, "*"))
    return counts.distribution(labels.add_weak_labels(masked, RULES), "weak_label")


def turn_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as posts whose id is that of the conversation, so that ids repeat."""
    return table(spark, sf, "conversations").select(F.col("conv_id").alias("id"), "turn", "text")


def sentiment_repeated_ids(spark: SparkSession, sf: str) -> DataFrame:
    scored = sentiment.add_plain_sentiment(turn_posts(spark, sf), valence_table(spark, VALENCES))
    return scored.select("id", "turn", "sentiment_compound", "sentiment_pos", "sentiment_label")


def emotion_repeated_ids(spark: SparkSession, sf: str) -> DataFrame:
    scored = emotion.add_emotions(turn_posts(spark, sf), affect_table(spark, AFFECT_WORDS))
    return scored.select("id", "turn", "top_emotion", F.to_json("emotion_scores").alias("emotion_scores"))


def sentiment_large_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    """Scores by the way that lexicons above the broadcast bounds take."""
    rows = posts(spark, sf)
    scores = sentiment.plain_scores(rows, valence_table(spark, VALENCES), max_rows=3)
    return sentiment.add_scores(rows, scores).select("id", *sentiment.SCORES)


def plain(spark: SparkSession, sf: str) -> DataFrame:
    return sentiment.add_plain_sentiment(posts(spark, sf), valence_table(spark, VALENCES))


def ruled(spark: SparkSession, sf: str) -> DataFrame:
    return sentiment.add_sentiment(posts(spark, sf), valence_table(spark, VALENCES), rules=SENTIMENT)


def sentiment_scores(spark: SparkSession, sf: str) -> DataFrame:
    return plain(spark, sf).select("id", *sentiment.SCORES)


def sentiment_labels(spark: SparkSession, sf: str) -> DataFrame:
    return plain(spark, sf).select("id", "sentiment_label")


def sentiment_rules(spark: SparkSession, sf: str) -> DataFrame:
    return ruled(spark, sf).select("id", *sentiment.SCORES, "sentiment_label")


def symbol_texts(spark: SparkSession, sf: str) -> DataFrame:
    return posts(spark, sf).select("id", symbol_words(F.col("text"), SYMBOLS).alias("text"))


def sentiment_symbols(spark: SparkSession, sf: str) -> DataFrame:
    """Scores by the rules with symbols that are read as words."""
    rules = replace(SENTIMENT, symbols=SYMBOLS)
    scored = sentiment.add_sentiment(posts(spark, sf), valence_table(spark, VALENCES), rules=rules)
    return scored.select("id", *sentiment.SCORES, "sentiment_label")


def sentiment_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return counts.distribution(ruled(spark, sf), "sentiment_label")


def extreme(highest: bool) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        columns = ["id", "author", "subreddit", "sentiment_label", "sentiment_compound"]
        return counts.extreme_posts(plain(spark, sf), "sentiment_compound", "id", columns, highest=highest)

    return query


def emotions(spark: SparkSession, sf: str, ties: str = "first_seen") -> DataFrame:
    return emotion.add_emotions(posts(spark, sf), affect_table(spark, AFFECT_WORDS), ties=ties)


def affect_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return emotion.token_rows(posts(spark, sf)).groupBy("id", "token").agg(F.count(F.lit(1)).alias("count"))


def emotion_scores(spark: SparkSession, sf: str) -> DataFrame:
    return emotion.emotion_rows(emotions(spark, sf))


def top_emotion(spark: SparkSession, sf: str, ties: str = "first_seen") -> DataFrame:
    return emotions(spark, sf, ties).select("id", "top_emotion")


def emotion_json(spark: SparkSession, sf: str) -> DataFrame:
    return emotions(spark, sf).select("id", F.to_json("emotion_scores").alias("emotion_scores"))


def emotion_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return counts.distribution(emotions(spark, sf), "top_emotion")


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrich(posts(spark, sf), valence_table(spark, VALENCES), affect_table(spark, AFFECT_WORDS), PARAMS)


def enriched_posts(spark: SparkSession, sf: str) -> DataFrame:
    return enriched(spark, sf).withColumn("emotion_scores", F.to_json("emotion_scores"))


def label_sentiment_summary(spark: SparkSession, sf: str) -> DataFrame:
    return counts.distribution(enriched(spark, sf), ["weak_label", "sentiment_label"])


# --- hydration -------------------------------------------------------------------------------------------------------


def hydrated(rows: DataFrame) -> DataFrame:
    return rows.withColumn("humanitarian_labels", F.array_join("humanitarian_labels", ","))


def hydrate_join(spark: SparkSession, sf: str) -> DataFrame:
    return hydrated(hydrate.hydrate(annotations(spark, sf), submissions(spark, sf), "forum", "labels"))


def hydrate_missing(spark: SparkSession, sf: str) -> DataFrame:
    return hydrate.missing_ids(annotations(spark, sf), turn_submissions(spark, sf))


def hydrate_last(spark: SparkSession, sf: str) -> DataFrame:
    last = hydrate.last_by_id(turn_submissions(spark, sf), "turn")
    return last.select("id", hydrate.hydrated_text(F.col("title"), F.col("selftext")).alias("text"))


def hydrate_resume(spark: SparkSession, sf: str) -> DataFrame:
    return hydrate.unsaved(annotations(spark, sf), saved_pages(spark, sf)).select("id")


def hydrate_stats(spark: SparkSession, sf: str) -> DataFrame:
    last = hydrate.last_by_id(turn_submissions(spark, sf), "turn")
    return hydrate.hydration_stats(annotations(spark, sf), last, saved_pages(spark, sf))


def hydrate_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job over submissions that repeat their ids: the last turn counts."""
    out = scratch_path(spark, "hydrated")
    given = turn_submissions(spark, sf)
    fields = [f for f in spark.createDataFrame([], schemas.SUBMISSION).schema.fields if f.name not in given.columns]
    bodies = given.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    hydration.run_hydration(annotations(spark, sf), bodies, out, "forum", "labels", order_col="turn")
    return spark.read.schema("id STRING, text STRING").json(f"{out}/posts")


def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    return hydrate.first_rows(annotations(spark, sf), 100).select("id")


def hydrate_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of the whole job into one folder: the good annotations first, then all of them, resumed."""
    out = scratch_path(spark, "hydrated")
    wanted, bodies = annotations(spark, sf), submissions(spark, sf)
    hydration.run_hydration(wanted.filter(F.col("Casualty") == 1), bodies, out, "forum", "labels", resume=True)
    hydration.run_hydration(wanted, bodies, out, "forum", "labels", resume=True)
    return spark.read.schema("id STRING, information_integrity STRING, Casualty BOOLEAN").json(f"{out}/posts")


def hydrate_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The same two runs with the posts in a table that is bucketed by id."""
    out = scratch_path(spark, "hydrated")
    name = f"posts_{uuid.uuid4().hex}"
    wanted, bodies = annotations(spark, sf), submissions(spark, sf)
    for some in (wanted.filter(F.col("Casualty") == 1), wanted):
        hydration.run_hydration(some, bodies, out, "forum", "labels", table=name, buckets=8)
    return spark.table(name).select("id", "information_integrity", "Casualty")


# --- features and classification -------------------------------------------------------------------------------------


def label_index(spark: SparkSession, sf: str) -> DataFrame:
    index = labels.label_index(labels.trainable(labeled(spark, sf)))
    return index.withColumn("label_index", F.col("label_index").cast("bigint"))


def split_hash(spark: SparkSession, sf: str) -> DataFrame:
    return splits.add_split(posts(spark, sf)).select("id", "split")


def split_stratified(spark: SparkSession, sf: str) -> DataFrame:
    return splits.add_stratified_split(labeled(spark, sf)).select("id", "weak_label", "split")


def tfidf_terms(spark: SparkSession, sf: str) -> DataFrame:
    return features.tfidf_terms(posts(spark, sf))


def ngram_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return features.gram_vocabulary(posts(spark, sf))


def ngram_vocab_bounded(spark: SparkSession, sf: str) -> DataFrame:
    """The same vocabulary without a shuffle of every pair of words."""
    return features.gram_vocabulary(posts(spark, sf), bounded=True)


def ml_hashed_features(spark: SparkSession, sf: str) -> DataFrame:
    """Posts, and the words that the hashed counts of all posts add up to."""
    rows = posts(spark, sf)
    stages = features.hashed_stages()
    hashed = Pipeline(stages=stages[:2]).fit(rows).transform(rows)
    summed = hashed.agg(F.count(F.lit(1)).alias("post_count"), Summarizer.sum(F.col("raw_features")).alias("total"))
    return summed.select(
        "post_count", F.aggregate(vector_to_array("total"), F.lit(0.0), lambda a, x: a + x).cast("bigint").alias("word_count")
    )


def guessed_language(spark: SparkSession, sf: str) -> DataFrame:
    """The language a weak label speaks for, as a prediction of the true language."""
    guess = F.when(F.col("weak_label") == "de_func", "de").when(F.col("weak_label") == "es_suffix", "es").otherwise("en")
    return labeled(spark, sf).select(F.col("subreddit").alias("label"), guess.alias("prediction"))


def confusion_summary(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.confusion_summary(guessed_language(spark, sf), "label", "prediction")


def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.classification_metrics(guessed_language(spark, sf), "label", "prediction")


def trained(spark: SparkSession, sf: str, kind: str = "hashed", stratified: bool = False) -> tuple[classify.TrainedModel, DataFrame]:
    """A model that is trained on the posts, and the posts. Its predictions come from the table it was fitted on."""
    rows = labeled(spark, sf).select("id", "text", "weak_label")
    split = splits.add_stratified_split(rows) if stratified else splits.add_split(rows)
    return classify.train(split, features=kind, predict=("id", "weak_label", "split")), split


def training_labels(rows: DataFrame) -> DataFrame:
    return rows.where("split = 'train' and weak_label <> 'other'").select(F.col("weak_label").alias(classify.PREDICTED)).distinct()


def predictions(spark: SparkSession, sf: str, kind: str = "hashed", stratified: bool = False) -> DataFrame:
    """The side of each post, and whether its predicted label is one of the training rows."""
    model, _ = trained(spark, sf, kind, stratified)
    known = training_labels(model.predicted).withColumn("is_known", F.lit(True))
    predicted = model.predicted.join(known, classify.PREDICTED, "left")
    return predicted.select("id", "weak_label", "split", F.coalesce("is_known", F.lit(False)).alias("is_known"))


def ml_distribution(spark: SparkSession, sf: str) -> DataFrame:
    """Posts in the distribution of predicted labels, and labels in it that no training row has."""
    model, _ = trained(spark, sf)
    found = counts.distribution(model.predicted, classify.PREDICTED)
    strange = found.join(training_labels(model.predicted), classify.PREDICTED, "left_anti").agg(F.count(F.lit(1)).alias("unknown_labels"))
    return found.agg(F.sum("count").alias("post_count")).join(strange)


def ml_confusion(spark: SparkSession, sf: str) -> DataFrame:
    """Posts of each weak label in the confusion summary."""
    model, _ = trained(spark, sf)
    return evaluate.confusion_summary(model.predicted).groupBy("weak_label").agg(F.sum("count").alias("count"))


def ml_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of both sides, and whether accuracy and F1 are those of Spark's evaluator on the test rows.

    A post without a text has the label "other", so the labels tell the test rows. They are written once for the evaluators.
    """
    model, rows = trained(spark, sf)
    tested = kept(model.predicted.where("split = 'test' and weak_label <> 'other'").select("weak_label", classify.PREDICTED), "tested")
    known = model.model.stages[-2].getLabels()
    indexed = StringIndexerModel.from_labels(known, inputCol="weak_label", outputCol="truth", handleInvalid="keep").transform(tested)
    indexed = StringIndexerModel.from_labels(known, inputCol=classify.PREDICTED, outputCol="guess", handleInvalid="keep").transform(indexed)
    measure = {m: MulticlassClassificationEvaluator(labelCol="truth", predictionCol="guess", metricName=m).evaluate(indexed) for m in ("f1", "accuracy")}
    same = [F.lit(abs(measure[m] - model.metrics[m]) < 0.0001).alias(f"same_{m}") for m in ("f1", "accuracy")]
    return classify.metrics_frame(rows, model).select("train_rows", "test_rows", *same)


def ml_model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Posts, and those for which the model that was saved and loaded says something else about the text."""
    model, rows = trained(spark, sf)
    loaded = sinks.load_model(sinks.save_model(model.model, scratch_path(spark, "model")))
    now = model.predicted.select("id", F.col(classify.PREDICTED).alias("now"))
    later = classify.apply_model(loaded, rows).select("id", F.col(classify.PREDICTED).alias("later"))
    return now.join(later, "id").agg(F.count(F.lit(1)).alias("post_count"), F.count_if(~F.col("now").eqNullSafe(F.col("later"))).alias("differing"))


def metrics_json(spark: SparkSession, sf: str) -> DataFrame:
    """The metrics of the language guess, written as a JSON document and read again."""
    path = scratch_path(spark, "metrics")
    sinks.write_metrics(classification_metrics(spark, sf), path)
    return spark.read.schema("f1 DOUBLE, accuracy DOUBLE, rows BIGINT").json(path)


def word_count_text(spark: SparkSession, sf: str) -> DataFrame:
    """Word counts as text lines."""
    path = scratch_path(spark, "words")
    sinks.write_pairs(word_count(spark, sf), path, "word", "count")
    return readers.read_lines(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("count"))


# --- streams ---------------------------------------------------------------------------------------------------------


def stream_of(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return capture.table_stream(spark, f"{sf}/{name}.parquet", table(spark, sf, name).schema)


def stream_track(spark: SparkSession, sf: str) -> DataFrame:
    """Events whose record holds a tracked term, captured by a stream that runs until the input is used up."""
    out = scratch_path(spark, "capture")
    lines = stream_of(spark, sf, "events").select(F.to_json(F.struct("event_id", "event_type", "user_id")).alias("value"))
    query = capture.start_capture(lines, ["ERROR", "signup"], out, f"{out}/_checkpoint", available_now=True)
    query.awaitTermination()
    parsed = F.from_json("value", "event_id BIGINT, event_type STRING, user_id BIGINT")
    return capture.read_captured(spark, out).select(parsed.alias("r")).select("r.*")


def stream_new_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of a stream in which an id arrives several times, each appended once."""
    out = scratch_path(spark, "new_posts")
    turns = stream_of(spark, sf, "conversations").select(F.col("conv_id").alias("id"))
    capture.start_new_posts(turns, f"{out}/posts", f"{out}/_checkpoint", available_now=True).awaitTermination()
    return spark.read.schema("id BIGINT").json(f"{out}/posts")


def stream_copies(spark: SparkSession, sf: str) -> DataFrame:
    """The quoted and the line copy of a capture: the events they tell of."""
    out = scratch_path(spark, "capture")
    lines = stream_of(spark, sf, "events").select(F.to_json(F.struct("event_id", "event_type")).alias("value"))
    capture.start_capture(lines, ["purchase"], out, f"{out}/_checkpoint", available_now=True).awaitTermination()
    read = capture.read_copies(spark, out)
    plain = F.when(F.col("copy") == capture.QUOTED, F.get_json_object(F.concat(F.lit('{"v":'), "value", F.lit("}")), "$.v")).otherwise(F.col("value"))
    return read.select("copy", F.get_json_object(plain, "$.event_id").cast("bigint").alias("event_id"))


def stream_new_posts_timed(spark: SparkSession, sf: str) -> DataFrame:
    """Users of the event stream, each appended once, with state that a watermark bounds and the disk holds."""
    before = spark.conf.get(STATE, None)
    spark.conf.set(STATE, capture.DISK_STATE[STATE])
    try:
        out = scratch_path(spark, "new_users")
        users = stream_of(spark, sf, "events").select(F.col("user_id").alias("id"), F.col("ts").cast("timestamp").alias("at"))
        capture.start_new_posts(users, f"{out}/posts", f"{out}/_checkpoint", time_col="at", delay="3650 days", available_now=True).awaitTermination()
    finally:
        spark.conf.set(STATE, before) if before else spark.conf.unset(STATE)
    return spark.read.schema("id BIGINT").json(f"{out}/posts")


def stream_growing(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of events in files that a stream follows by byte offsets, captured by a tracked term."""
    out = scratch_path(spark, "growing")
    table(spark, sf, "events").select(F.to_json(F.struct("event_id", "event_type")).alias("value")).write.text(f"{out}/feed")
    tail.register_tail(spark)
    lines = spark.readStream.format(tail.FORMAT).option("pattern", "part-*").load(f"{out}/feed".removeprefix("file:"))
    capture.start_capture(lines, ["signup"], f"{out}/copies", f"{out}/_checkpoint", available_now=True).awaitTermination()
    parsed = F.from_json("value", "event_id BIGINT, event_type STRING")
    return capture.read_captured(spark, f"{out}/copies").select(parsed.alias("r")).select("r.*")


STATE = "spark.sql.streaming.stateStore.providerClass"

QUERIES: dict[str, Query] = {
    # sources and sinks
    "view_sql": view_sql,
    "json_posts": json_posts,
    "json_posts_strict": json_posts_strict,
    "json_titled_strict": json_titled_strict,
    "json_optional_columns": json_optional_columns,
    "status_json": status_json,
    "text_lines": text_lines,
    "annotation_csv": annotation_csv,
    "report_csv": report_csv,
    "pair_text": pair_text,
    "hashtag_lists": hashtag_lists,
    "first_field_table": first_fields,
    # projections and filters
    "post_text": post_text,
    "normalize_text": normalize_text,
    "nested_project": nested_project,
    "lang_filter": lang_filter,
    "user_locations": from_statuses(statuses.user_locations),
    "entity_arrays": entity_arrays,
    "hashtag_rows": hashtag_rows,
    "reshare_text": reshare_text,
    "status_flatten": status_flatten,
    "bad_record_filter": bad_record_filter,
    "bad_record_counts": bad_record_counts,
    "record_fields": record_fields,
    "record_typed": record_typed,
    "created_epoch": created_epoch,
    "flag_labels": flag_labels,
    "trainable_rows": trainable_rows,
    # counts and top-k
    "top_authors": top_authors,
    "community_counts": community_counts,
    "top_scores_by_author": top_scores_by_author,
    "keyword_counts": keyword_counts,
    "keyword_counts_cs": keyword_counts_cs,
    "keyword_counts_many": keyword_counts_many,
    "device_counts": device_counts,
    "post_type_counts": post_type_counts,
    "post_count": post_count,
    "word_count": word_count,
    "hashtag_counts": hashtag_counts,
    "status_user_counts": from_statuses(statuses.user_counts),
    "status_followers": from_statuses(statuses.user_value_groups, "followers_count", 50),
    "status_friends": from_statuses(statuses.user_value_groups, "friends_count", 50),
    "status_statuses": from_statuses(statuses.user_value_groups, "statuses_count", 10),
    "status_top_followers": from_statuses(statuses.user_value_leaders, "followers_count", 50),
    "status_languages": from_statuses(statuses.user_languages, english=False),
    "popular_users": from_statuses(statuses.popular_users),
    "user_timezones": from_statuses(statuses.user_time_zones),
    # labels, sentiment, emotion
    "weak_labels": weak_labels,
    "weak_labels_once": weak_labels_once,
    "weak_label_distribution": weak_label_distribution,
    "masked_labels": masked_labels,
    "sentiment_scores": sentiment_scores,
    "sentiment_labels": sentiment_labels,
    "sentiment_repeated_ids": sentiment_repeated_ids,
    "sentiment_large_lexicon": sentiment_large_lexicon,
    "sentiment_rules": sentiment_rules,
    "symbol_texts": symbol_texts,
    "sentiment_symbols": sentiment_symbols,
    "sentiment_distribution": sentiment_distribution,
    "most_positive": extreme(True),
    "most_negative": extreme(False),
    "affect_tokens": affect_tokens,
    "emotion_scores": emotion_scores,
    "top_emotion": top_emotion,
    "top_emotion_listed": partial(top_emotion, ties="listed"),
    "emotion_json": emotion_json,
    "emotion_repeated_ids": emotion_repeated_ids,
    "emotion_distribution": emotion_distribution,
    "enriched_posts": enriched_posts,
    "label_sentiment_summary": label_sentiment_summary,
    # hydration
    "hydrate_join": hydrate_join,
    "hydrate_missing": hydrate_missing,
    "hydrate_last": hydrate_last,
    "hydrate_resume": hydrate_resume,
    "hydrate_stats": hydrate_stats,
    "hydrate_append": hydrate_append,
    "hydrate_append_repeated": hydrate_repeated,
    "hydrate_append_bucketed": hydrate_bucketed,
    "first_rows": first_rows,
    # features and classification
    "label_index": label_index,
    "post_reports": post_reports,
    "sql_functions": sql_functions,
    "ml_single_words": ml_single_words,
    "split_hash": split_hash,
    "split_stratified": split_stratified,
    "tfidf_terms": tfidf_terms,
    "ngram_vocab": ngram_vocab,
    "ngram_vocab_bounded": ngram_vocab_bounded,
    "confusion_summary": confusion_summary,
    "classification_metrics": classification_metrics,
    "ml_hashed_features": ml_hashed_features,
    "ml_predictions": predictions,
    "ml_ngram_model": partial(predictions, kind="grams", stratified=True),
    "ml_distribution": ml_distribution,
    "ml_confusion": ml_confusion,
    "ml_metrics": ml_metrics,
    "ml_model_roundtrip": ml_model_roundtrip,
    "metrics_json": metrics_json,
    "word_count_text": word_count_text,
    # streams
    "stream_track": stream_track,
    "stream_copies": stream_copies,
    "stream_growing": stream_growing,
    "stream_new_posts": stream_new_posts,
    "stream_new_posts_timed": stream_new_posts_timed,
}
