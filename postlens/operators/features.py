"""Term features: hashed counts, inverse document frequency, n-gram vocabulary."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    ElementwiseProduct,
    HashingTF,
    NGram,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    Tokenizer,
)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.text import GRAM_TOKEN, bigrams, gram_tokens, space_words
from postlens.operators.lexicon import BROADCAST_ROWS, fits_broadcast
from postlens.session import kept

# Sizes of the hashed and of the n-gram feature space.
HASHED_SIZE = 65_536
GRAM_SIZE = 4_096
#: Buckets of the counts that bound those of terms.
TERM_BUCKETS = 1 << 20


def hashed_stages(text_col: str = "text", features_col: str = "features", size: int = HASHED_SIZE) -> list:
    """Unfitted stages: words, hashed counts, smoothed inverse document frequency."""
    return [
        Tokenizer(inputCol=text_col, outputCol="words"),
        HashingTF(inputCol="words", outputCol="raw_features", numFeatures=size),
        IDF(inputCol="raw_features", outputCol=features_col),
    ]


def term_counts(posts: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Occurrences of each word in each post.

    Words are counted within their row, as runs of its sorted words, without a shuffle. Rows with the same id are one
    post: only if an id is repeated, which a count of the ids tells first, the counts are added up.
    """
    words = posts.select(id_col, F.sort_array(space_words(F.col(text_col))).alias("_words"))
    first = F.array_compact(F.transform("_words", lambda w, i: F.when((i == 0) | (F.get("_words", i - 1) != w), i)))
    runs = F.transform("_starts", lambda s, k: F.struct(F.get("_words", s).alias("term"), (F.coalesce(F.get("_starts", k + 1), F.size("_words")) - s).cast("bigint").alias("tf")))
    counted = words.select("*", first.alias("_starts")).select(id_col, F.explode_outer(runs).alias("_run")).select(id_col, "_run.term", "_run.tf")
    counted = counted.filter(F.col("term").isNotNull())
    repeated = posts.groupBy(id_col).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 1)
    return counted if repeated.isEmpty() else counted.groupBy(id_col, "term").agg(F.sum("tf").alias("tf"))


def term_frequency(posts: DataFrame, text_col: str = "text") -> DataFrame:
    """Posts that hold each word. Words are counted within each task before the shuffle."""
    words = posts.select(F.array_distinct(space_words(F.col(text_col))).alias("_words"))
    terms = words.select(F.explode_outer("_words").alias("term")).filter(F.col("term").isNotNull())
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def tfidf_terms(posts: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Weight tf * ln((n + 1) / (df + 1)) of each word in each post.

    Counts meet frequencies by word in one join. A word that is in a third of all posts makes a skewed partition on the
    side of the counts only, which adaptive execution splits.
    """
    counts = term_counts(posts, id_col, text_col)
    size = posts.agg(F.count(F.lit(1)).alias("_posts"))
    joined = counts.join(term_frequency(posts, text_col), "term").withColumn("_posts", size.scalar())
    weight = F.col("tf") * F.log((F.col("_posts") + 1) / (F.col("df") + 1))
    return joined.select(id_col, "term", "tf", "df", F.round(weight, 6).alias("tfidf"))


def gram_counts(posts: DataFrame, text_col: str = "text") -> DataFrame:
    """Occurrences of each word and each pair of neighbouring words in all posts."""
    return gram_counts_of(posts.select(gram_tokens(F.col(text_col)).alias("words")))


def gram_counts_of(tokens: DataFrame, words_col: str = "words") -> DataFrame:
    """The same for lists of words."""
    return occurrences(gram_rows(tokens, words_col))


def gram_rows(tokens: DataFrame, words_col: str = "words") -> DataFrame:
    """One row ``term`` for each word and each pair of neighbouring words."""
    grams = tokens.select(F.concat(words_col, bigrams(F.col(words_col))).alias("_grams"))
    return grams.select(F.explode_outer("_grams").alias("term")).filter(F.col("term").isNotNull())


def occurrences(rows: DataFrame) -> DataFrame:
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("count"))


def frequent_terms(rows: DataFrame, size: int, buckets: int = TERM_BUCKETS) -> DataFrame:
    """The ``size`` most frequent values of ``term`` with their exact counts; equal counts are ordered by term.

    Most terms are rare, and only what can still be among the most frequent is counted one by one:

    1. Rows are counted by a hash of their term. A bucket's total bounds the count of each of its terms from above.
    2. The terms of the largest buckets are counted. The smallest of the ``size`` best counts among them is a bound from
       below for what the most frequent terms have.
    3. The terms of all buckets whose total reaches this bound are counted. No other term can be in the result, so it
       is exact whatever the input; if the bound is low, more terms are counted.

    Step 1 shuffles ``buckets`` short rows for each task at most, the others the few terms that matter.
    """
    place = F.pmod(F.xxhash64("term"), F.lit(buckets))
    totals = kept(rows.groupBy(place.alias("bucket")).agg(F.count(F.lit(1)).alias("n")), "term-buckets")
    likely = occurrences(in_buckets(rows, totals.orderBy(F.desc("n"), "bucket").limit(2 * size), place, buckets))
    bound = most_frequent(likely, size).agg(F.count(F.lit(1)).alias("terms"), F.min("count").alias("least")).first()
    least = bound["least"] if bound["terms"] == size else 0
    return most_frequent(occurrences(in_buckets(rows, totals.filter(F.col("n") >= least), place, buckets)), size)


def in_buckets(rows: DataFrame, chosen: DataFrame, place: Column, buckets: int) -> DataFrame:
    """The rows whose bucket is a chosen one, by a bitmap of all buckets: one row of ``buckets`` / 8 bytes, no join."""
    bits = F.expr("shiftleft(1L, cast(bucket % 64 as int))")
    words = chosen.groupBy(F.floor(F.col("bucket") / 64).alias("word")).agg(F.bit_or(bits).alias("bits"))
    every = rows.sparkSession.range((buckets + 63) // 64).withColumnRenamed("id", "word").join(words, "word", "left").na.fill(0, ["bits"])
    bitmap = every.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("map")).select("map.bits").scalar()
    return rows.filter(F.getbit(F.element_at(bitmap, (F.floor(place / 64) + 1).cast("int")), place % 64) == 1)


def frequent_grams(tokens: DataFrame, size: int = GRAM_SIZE, words_col: str = "words", most: int = BROADCAST_ROWS) -> DataFrame:
    """The ``size`` most frequent words and pairs of neighbouring words with their exact counts, ordered by count and term.

    A pair is at most as frequent as each of its words, and ``size`` words alone reach the count of the ``size``-th one. So
    only words with this count, and pairs of two such words, can be among the most frequent. These few words are
    broadcast, and the pairs are counted by numbers; no other pair is counted or shuffled. Should more than ``most``
    words have that count, all pairs are counted.
    """
    words = kept(occurrences(tokens.select(F.explode_outer(words_col).alias("term")).filter(F.col("term").isNotNull())), "words")
    bound = most_frequent(words, size).agg(F.count(F.lit(1)).alias("terms"), F.min("count").alias("least")).first()
    least = bound["least"] if bound["terms"] == size else 0
    often = kept(words.filter(F.col("count") >= least).select("term", "count", F.monotonically_increasing_id().alias("number")), "often")
    if not fits_broadcast(often.withColumnRenamed("term", "token"), most):
        return most_frequent(gram_counts_of(tokens, words_col), size)
    first, second = (F.broadcast(often.select(F.col("term").alias(c), F.col("number").alias(f"{c}_number"))) for c in "ab")
    following = F.concat(F.slice(words_col, 2, F.greatest(F.size(words_col) - 1, F.lit(0))), F.array(F.lit(None).cast("string")))
    near = tokens.select(F.explode_outer(F.arrays_zip(F.col(words_col).alias("a"), following.alias("b"))).alias("_near")).select("_near.a", "_near.b")
    numbered = near.filter("b IS NOT NULL").join(first, "a").join(second, "b")
    counted = numbered.groupBy("a_number", "b_number").agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") >= least)
    pairs = counted.join(first, "a_number").join(second, "b_number").select(F.concat_ws(" ", "a", "b").alias("term"), "count")
    return most_frequent(often.select("term", "count").union(pairs), size)


def gram_vocabulary(posts: DataFrame, text_col: str = "text", size: int = GRAM_SIZE, bounded: bool = False) -> DataFrame:
    """The most frequent words and pairs; equal counts are ordered by term.

    Pairs are left out by the counts of their words (see ``frequent_grams``). ``bounded`` counts by buckets instead (see
    ``frequent_terms``), which also bounds the distinct words that are shuffled.
    """
    if not bounded:
        return frequent_grams(posts.select(gram_tokens(F.col(text_col)).alias("words")), size)
    words = kept(posts.select(gram_tokens(F.col(text_col)).alias("words")), "vocabulary-words")
    return frequent_terms(gram_rows(words), size)


def most_frequent(counted: DataFrame, size: int = GRAM_SIZE) -> DataFrame:
    return counted.orderBy(F.desc("count"), "term").limit(size)


def gram_features(train: DataFrame, text_col: str = "text", features_col: str = "features", size: int = GRAM_SIZE) -> PipelineModel:
    """Fitted 1- and 2-gram features: counts over the vocabulary, weighted by ln((n + 1) / (df + 1)) + 1, unit length."""
    splitting = word_stage(text_col)
    words = splitting.transform(train)
    counting = gram_counting(words, size)
    return PipelineModel([splitting, *counting, *gram_weighting(PipelineModel(counting).transform(words), features_col)])


def word_stage(text_col: str = "text") -> RegexTokenizer:
    return RegexTokenizer(inputCol=text_col, outputCol="words", pattern=GRAM_TOKEN, gaps=False, toLowercase=True)


def gram_counting(words: DataFrame, size: int = GRAM_SIZE) -> list:
    """Stages that count the most frequent words and pairs of the column ``words``."""
    vocabulary = [row["term"] for row in frequent_grams(words, size).collect()]
    if not vocabulary:
        raise ValueError("no words to build a vocabulary from")
    return [
        NGram(n=2, inputCol="words", outputCol="pairs"),
        SQLTransformer(statement="SELECT *, concat(words, pairs) AS grams FROM __THIS__"),
        CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="raw_features"),
    ]


def gram_weighting(counted: DataFrame, features_col: str = "features") -> list:
    """Stages that weight the column ``raw_features`` as its rows ask for."""
    idf = IDF(inputCol="raw_features", outputCol="unused").fit(counted).idf
    weights = Vectors.dense(idf.toArray() + 1.0)
    weighting = ElementwiseProduct(scalingVec=weights, inputCol="raw_features", outputCol="weighted_features")
    return [weighting, Normalizer(inputCol="weighted_features", outputCol=features_col, p=2.0)]
