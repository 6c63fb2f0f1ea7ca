"""Sentiment scores of posts from a (token, valence) lexicon.

Tokens are exploded, joined with the lexicon and added up per post. Rows without a lexicon hit leave at the join, and
all rows of a post are in one input partition, so the partial aggregation leaves one short row per post for the
shuffle. The scores are joined to the posts by id and a digest of the text, so ids may repeat and may be null: rows with
the same id and text are added up together and divided by their number.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from string import punctuation

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.symbols import symbol_words
from postlens.functions.text import NOT_SPACE, affect_tokens
from postlens.operators.emotion import affect_aggregates, affect_map, found_affects
from postlens.operators.lexicon import BROADCAST_ROWS, COPY, Lexicon, affect_flags, few_tokens, join_scores, one_valence, text_key, with_copy
from postlens.params import AFFECTS, NEGATIVE_UPTO, POSITIVE_FROM, SENTIMENT_RULES, SentimentRules

SCORES = ("sentiment_compound", "sentiment_pos", "sentiment_neu", "sentiment_neg")


def compound(total: Column, alpha: float = SENTIMENT_RULES.alpha) -> Column:
    """A sum of valences brought into -1..1, rounded to 4 places."""
    scaled = total / F.sqrt(total * total + F.lit(float(alpha)))
    return F.round(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), scaled)), 4)


def sentiment_label(score: Column, positive_from: float = POSITIVE_FROM, negative_upto: float = NEGATIVE_UPTO) -> Column:
    """Both thresholds belong to their class."""
    return F.when(score >= positive_from, "positive").when(score <= negative_upto, "negative").otherwise("neutral")


def plain_scores(posts: DataFrame, lexicon: DataFrame, id_col: str = "id", text_col: str = "text", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Scores of the ids and texts with a lexicon hit: the sum of valences, and the shares of the tokens by sign."""
    words = posts.select(id_col, text_key(F.col(text_col)).alias("_text_key"), affect_tokens(F.col(text_col)).alias("_tokens"))
    sized = words.select(id_col, "_text_key", F.size("_tokens").alias("_n"), F.array_append("_tokens", F.lit(COPY)).alias("_tokens"))
    rows = sized.select(id_col, "_text_key", "_n", F.explode_outer("_tokens").alias("_token"))
    hits = Lexicon(with_copy(one_valence(lexicon)), max_rows).join(rows, "_token", [id_col, "_text_key"])
    copies = F.count_if(F.col("_token") == COPY)
    sums = hits.groupBy(id_col, "_text_key").agg(
        (F.sum("valence") / copies).alias("_total"),
        (F.count_if(F.col("valence") > 0) / copies).alias("_pos"),
        (F.count_if(F.col("valence") < 0) / copies).alias("_neg"),
        F.max("_n").alias("_n"),
    )
    return sums.where("_total IS NOT NULL").select(
        id_col,
        "_text_key",
        compound(F.round("_total", 9)).alias("sentiment_compound"),
        F.round(F.col("_pos") / F.col("_n"), 4).alias("sentiment_pos"),
        F.round((F.col("_n") - F.col("_pos") - F.col("_neg")) / F.col("_n"), 4).alias("sentiment_neu"),
        F.round(F.col("_neg") / F.col("_n"), 4).alias("sentiment_neg"),
    )


#: Before a token of the affect lexicon, so that words and affect tokens can be looked up at once. No word holds it.
AFFECT_MARK = "\t"


def rule_sums(
    posts: DataFrame,
    lexicon: DataFrame,
    id_col: str,
    text_col: str,
    rules: SentimentRules,
    max_rows: int,
    affect_lexicon: DataFrame | None = None,
    affects: Sequence[str] = (),
) -> DataFrame:
    """Sums over the hits of each id and text under the published context rules, and with an affect lexicon also the
    counts of its tokens, from one pass over the text.

    Each token is exploded together with the three words before it and the two after it, so the rules need neither a
    window nor a shuffle by position, and no row carries more than six words. Of a lexicon with few tokens only the words
    that are in it are exploded at all.
    """
    table = one_valence(lexicon)
    known = few_tokens(table, max_rows)
    known_affects = None
    if affect_lexicon is not None:
        flagged = affect_flags(affect_lexicon, affects)
        known_affects = few_tokens(flagged, max_rows)
        marked = flagged.withColumn("token", F.concat(F.lit(AFFECT_MARK), "token"))
        table = table.unionByName(marked, allowMissingColumns=True)
    lookup = Lexicon(with_copy(table), max_rows)
    tokens = token_places(posts, id_col, text_col, rules, known, affect_lexicon is not None, known_affects)
    flags = [f"_f{i}" for i in range(len(affects))] if affect_lexicon is not None else []
    hits = lookup.join(tokens, "_w0", [id_col, "_text_key"]).selectExpr(
        f"`{id_col}`",
        *["_text_key", "_n", "_caps", "_turn", "_emphasis", "_i", "_w0", "valence AS _valence", *flags],
        *[f"lower(get(_near, {k})) AS _{name}" for k, name in enumerate(NEAR) if name != "w0"],
        # As an array function this also ends the generated loop over all tokens here: with the rules in it, the loop
        # would be too long for the JVM to compile.
        f"transform(array(_near[3], _near[2], _near[1], _near[0]), w -> {all_caps('w')}) AS _ups",
    )
    for name in ("_b1", "_b2", "_b3", "_a1"):
        hits = lookup.join(hits, name, [id_col, "_text_key"], "left", prefix=f"{name}_", columns=["valence"])
    scored = apply_rules(hits, rules)
    return scored.groupBy(id_col, "_text_key").agg(
        F.sum("_score").alias("_total"),
        F.sum(F.when(F.col("_score") > 0, F.col("_score") + 1.0).when(F.col("_score").isNotNull(), 0.0)).alias("_pos"),
        F.sum(F.when(F.col("_score") < 0, 1.0 - F.col("_score")).when(F.col("_score").isNotNull(), 0.0)).alias("_neg"),
        F.count_if(F.col("_score") != 0).alias("_signed"),
        F.max("_n").alias("_n"),
        F.max("_emphasis").alias("_emphasis"),
        *affect_aggregates(affects if flags else (), "_w0", "_i"),
    )


def token_places(
    posts: DataFrame,
    id_col: str,
    text_col: str,
    rules: SentimentRules,
    known: Sequence[str] | None = None,
    affects: bool = False,
    known_affects: Sequence[str] | None = None,
) -> DataFrame:
    """One row for each word ``_w0`` that is no degree word, with its place ``_i`` and its neighbours ``_near``; one for
    each affect token, if wanted, and one for each post. Words and affect tokens outside of the known ones are left out
    before the explode.
    """
    said = posts.select(
        id_col,
        text_key(F.col(text_col)).alias("_text_key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_own"),
        symbol_words(F.coalesce(F.col(text_col), F.lit("")), rules.symbols).alias("_text"),
    )
    felt = affect_tokens(F.col("_own")) if affects else F.array().cast("array<string>")
    listened = said.select(
        id_col,
        "_text_key",
        F.expr(spoken("_text", rules, known)).alias("_spoken"),
        emphasis(F.col("_text"), rules).alias("_emphasis"),
        felt.alias("_felt"),
    )
    # What belongs to the whole post is computed before the explode: beside it, it would be computed per token. The
    # outer explode keeps Spark from inferring a filter on the size of the array, which would build the array twice.
    # Capitals count next to a hit only, so a text without any there has none.
    shouted = f"coalesce(exists(_spoken.places, p -> exists(slice(p.near, 1, 4), w -> {all_caps('w')})), false)"
    kept = "_felt" if known_affects is None else f"filter(_felt, w -> w IN {listed(known_affects)})"
    prepared = listened.selectExpr(
        f"`{id_col}`",
        "_text_key",
        "_spoken.n AS _n",
        f"_spoken.small AND {shouted} AS _caps",
        f"get(filter(_spoken.places, p -> lower(get(p.near, {AT})) = {literal(rules.contrast)}), 0).i AS _turn",
        "_emphasis",
        "_spoken.places AS _said",
        f"{kept} AS _felt",
    )
    whole = [id_col, "_text_key", "_n", "_caps", "_turn", "_emphasis"]
    alone = F.lit(None).cast("array<string>")
    added = F.concat(
        F.transform("_felt", lambda t, i: F.struct(i.alias("i"), F.concat(F.lit(AFFECT_MARK), t).alias("token"), alone.alias("near"))),
        F.array(F.struct(F.lit(None).cast("int").alias("i"), F.lit(COPY).alias("token"), alone.alias("near"))),
    )
    placed = prepared.select(*whole, F.concat("_said", added).alias("_places"))
    rows = placed.select(*whole, F.explode_outer("_places").alias("_place"))
    tokens = rows.select(*whole, F.col("_place.i").alias("_i"), F.coalesce("_place.token", F.lower(F.get("_place.near", F.lit(AT)))).alias("_w0"), F.col("_place.near").alias("_near"))
    return tokens.filter(f"_w0 IS NOT NULL AND _w0 NOT IN {listed(boosters(rules))}")


def scores_of_sums(sums: DataFrame, id_col: str, rules: SentimentRules, *more: str) -> DataFrame:
    """The scores from the sums; null where an id and text has no hit."""
    # Rounded, so that the signs do not depend on the order in which the scores were added up.
    e = F.col("_emphasis")
    total, pos, neg = (F.round(F.col(name) / F.col("_copies"), 9) for name in ("_total", "_pos", "_neg"))
    parts = sums.select(
        id_col,
        "_text_key",
        F.when(total > 0, total + e).when(total < 0, total - e).otherwise(total).alias("_total"),
        F.when(pos > neg, pos + e).otherwise(pos).alias("_pos"),
        F.when(pos < neg, neg + e).otherwise(neg).alias("_neg"),
        F.expr("_n - _signed div _copies").alias("_neu"),
        *more,
    )
    whole = F.col("_pos") + F.col("_neg") + F.col("_neu")
    return parts.select(
        id_col,
        "_text_key",
        F.when(F.col("_total").isNotNull(), compound(F.col("_total"), rules.alpha)).alias("sentiment_compound"),
        F.round(F.col("_pos") / whole, 3).alias("sentiment_pos"),
        F.round(F.col("_neu") / whole, 3).alias("sentiment_neu"),
        F.round(F.col("_neg") / whole, 3).alias("sentiment_neg"),
        *more,
    )


def ruled_scores(
    posts: DataFrame,
    lexicon: DataFrame,
    id_col: str = "id",
    text_col: str = "text",
    rules: SentimentRules = SENTIMENT_RULES,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Scores of the ids and texts with a lexicon hit under the published context rules."""
    sums = rule_sums(posts, lexicon, id_col, text_col, rules, max_rows)
    return scores_of_sums(sums.where("_total IS NOT NULL"), id_col, rules)


def sentiment_and_emotion(
    posts: DataFrame,
    lexicon: DataFrame,
    affect_lexicon: DataFrame,
    id_col: str = "id",
    text_col: str = "text",
    rules: SentimentRules = SENTIMENT_RULES,
    affects: Sequence[str] = AFFECTS,
    ties: str = "first_seen",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Ruled scores and affects of every id and text, from one pass over the text."""
    sums = rule_sums(posts, lexicon, id_col, text_col, rules, max_rows, affect_lexicon, affects)
    scores = scores_of_sums(sums.withColumn("_found", found_affects(affects, ties)), id_col, rules, "_found", "_copies")
    return scores.withColumns({"top_emotion": F.get("_found", F.lit(0))["affect"], "emotion_scores": affect_map()}).drop("_found", "_copies")


def fill_scores(joined: DataFrame) -> DataFrame:
    """A post without scores is neutral."""
    filled = joined.withColumns({c: F.coalesce(F.col(c), F.lit(1.0 if c == "sentiment_neu" else 0.0)) for c in SCORES})
    return filled.withColumn("sentiment_label", sentiment_label(F.col("sentiment_compound")))


def add_scores(posts: DataFrame, scores: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Posts with their scores and label; a post without scores is neutral."""
    return fill_scores(join_scores(posts, scores, id_col, text_col))


def add_plain_sentiment(posts: DataFrame, lexicon: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    return add_scores(posts, plain_scores(posts, lexicon, id_col, text_col), id_col, text_col)


def add_sentiment(
    posts: DataFrame,
    lexicon: DataFrame,
    id_col: str = "id",
    text_col: str = "text",
    rules: SentimentRules = SENTIMENT_RULES,
) -> DataFrame:
    return add_scores(posts, ruled_scores(posts, lexicon, id_col, text_col, rules), id_col, text_col)


# --- words and their context ---------------------------------------------------------------------------------------

#: Distances of the three words before a word, itself, and the two after it.
NEAR = {"b3": -3, "b2": -2, "b1": -1, "w0": 0, "a1": 1, "a2": 2}
AT = list(NEAR).index("w0")


def spoken(text: str, rules: SentimentRules, known: Iterable[str] | None) -> str:
    """Number of words of a text (n), whether some are not in capitals (small), and place and neighbours of each word that
    is known or a contrast word (places).

    Words are cut, kept and dropped within one expression, since an array of all words that is passed from one
    projection to the next costs more than cutting it. The lambda over one element stands for the words, which are used
    several times.
    """
    wanted = "true" if known is None else f"w IN {listed({*known, rules.contrast})}"
    marks = f"transform(transform(ws, w -> lower({stripped('w')})), (w, i) -> CASE WHEN {wanted} THEN i END)"
    near = f"transform(array({', '.join(f'get(ws, i + {k})' for k in NEAR.values())}), w -> {stripped('w')})"
    at = f"filter({marks}, i -> i IS NOT NULL)"
    places = f"transform({at}, i -> named_struct('i', i, 'token', CAST(NULL AS STRING), 'near', {near}))"
    whole = f"named_struct('n', size(ws), 'small', exists(ws, w -> NOT ({all_caps('w')})), 'places', {places})"
    return f"transform(array(regexp_extract_all({text}, {literal(NOT_SPACE)}, 0)), ws -> {whole})[0]"


def boosters(rules: SentimentRules) -> list[str]:
    return [*rules.boosters_up, *rules.boosters_down]


def stripped(word: str) -> str:
    """A word without outer punctuation, unless two or fewer characters would remain."""
    inner, marks = f"btrim({word}, {literal(punctuation)})", listed(punctuation)
    edged = f"substr({word}, 1, 1) IN {marks} OR substr({word}, -1, 1) IN {marks}"
    return f"CASE WHEN ({edged}) AND length({inner}) > 2 THEN {inner} ELSE {word} END"


def all_caps(word: str) -> str:
    return f"{word} = upper({word}) AND {word} <> lower({word})"


def emphasis(text: Column, rules: SentimentRules) -> Column:
    """Weight of exclamation marks (up to a number) and of two or more question marks."""
    marks = F.least(count_of(text, "!"), F.lit(rules.exclamation_most)) * F.lit(rules.exclamation_weight)
    asked = count_of(text, "?")
    questions = (
        F.when(asked <= 1, F.lit(0.0))
        .when(asked <= rules.question_most, asked * F.lit(rules.question_weight))
        .otherwise(F.lit(rules.question_top))
    )
    return marks + questions


def count_of(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


# --- the rules, as SQL expressions ----------------------------------------------------------------------------------


def apply_rules(hits: DataFrame, rules: SentimentRules) -> DataFrame:
    """Give every hit its ``_score``: valence, "no", capitals, three words before, idioms, "least", contrast.

    Each rule reads the score the former one left, so each is a column of its own.
    """
    skipped = f"{is_word('_w0', rules.not_a_booster[0])} AND {is_word('_a1', rules.not_a_booster[1])}"
    scored = hits.filter(f"NOT ({skipped})").withColumn("_score", F.expr(plain_valence(rules)))
    caps = number(rules.caps_weight)
    raised = f"CASE WHEN _ups[0] AND _caps THEN _score + CASE WHEN _score > 0 THEN {caps} ELSE -{caps} END ELSE _score END"
    scored = scored.withColumn("_score", F.expr(raised)).selectExpr(
        "*", *[f"{degree(k, rules)} AS _degree{k}" for k in (1, 2, 3)], *[f"{factor(k, rules)} AS _factor{k}" for k in (1, 2, 3)]
    )
    for k, share in ((1, 1.0), (2, rules.second_word_share), (3, rules.third_word_share)):
        scored = scored.withColumn("_score", F.expr(f"(_score + {moved(k, share, rules)}) * _factor{k}"))
    lone_least = f"{in_reach(1)} AND {is_word('_b1', rules.least)} AND NOT {is_word('_b2', *rules.least_lead)}"
    steps = (
        with_idioms(rules),
        f"CASE WHEN {lone_least} THEN _score * {number(rules.negation_weight)} ELSE _score END",
        f"CASE WHEN _i < _turn THEN _score * {number(rules.before_contrast)} "
        f"WHEN _i > _turn THEN _score * {number(rules.after_contrast)} ELSE _score END",
    )
    for step in steps:
        scored = scored.withColumn("_score", F.expr(step))
    return scored


def number(value: float) -> str:
    return f"{float(value)!r}D"


def literal(word: str) -> str:
    return "'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed(words: Iterable[str]) -> str:
    """A SQL list; an empty one holds a line break, which no word is."""
    return "(" + ", ".join(literal(word) for word in list(words) or ["\n"]) + ")"


def is_word(name: str, *words: str) -> str:
    return f"coalesce({name} IN {listed(words)}, false)"


def in_reach(k: int) -> str:
    """The k-th word before the hit exists and is no lexicon word itself."""
    return f"(_b{k} IS NOT NULL AND _b{k}_valence IS NULL)"


def plain_valence(rules: SentimentRules) -> str:
    """The valence of a hit; a "no" before a lexicon word has none of its own but negates that word."""
    no = rules.no_word
    linked = f"({is_word('_b3', no)} AND {is_word('_b1', *rules.no_links)})"
    return (
        f"CASE WHEN {is_word('_b1', no)} OR {is_word('_b2', no)} OR {linked} THEN _valence * {number(rules.negation_weight)} "
        f"WHEN {is_word('_w0', no)} AND _a1_valence IS NOT NULL THEN 0D ELSE _valence END"
    )


def degree(k: int, rules: SentimentRules) -> str:
    """Weight of the k-th word before as a degree word, or null."""
    weight = number(rules.booster_weight)
    return (
        f"CASE WHEN NOT {in_reach(k)} THEN NULL WHEN {is_word(f'_b{k}', *rules.boosters_up)} THEN {weight} "
        f"WHEN {is_word(f'_b{k}', *rules.boosters_down)} THEN -{weight} END"
    )


def moved(k: int, share: float, rules: SentimentRules) -> str:
    """What a degree word adds: away from zero or towards it, more in capitals, less with distance."""
    caps = number(rules.caps_weight)
    signed = f"CASE WHEN _score < 0 THEN -_degree{k} ELSE _degree{k} END"
    shouted = f"CASE WHEN NOT (_ups[{k}] AND _caps) THEN 0D WHEN _score > 0 THEN {caps} ELSE -{caps} END"
    return f"coalesce(({signed} + {shouted}) * {number(share)}, 0D)"


def factor(k: int, rules: SentimentRules) -> str:
    """What the k-th word before multiplies the score with: a negation flips and damps it.

    A "never so" raises it and a "without doubt" leaves it. As published, a link such as "so" right before the hit
    raises it at the third place even without the leading word.
    """
    (without, doubt), links = rules.doubt, rules.never_links
    raised, kept = "false", "false"
    if k == 2:
        raised = f"{is_word('_b2', rules.never)} AND {is_word('_b1', *links)}"
        kept = f"{is_word('_b2', without)} AND {is_word('_b1', doubt)}"
    if k == 3:
        raised = f"({is_word('_b3', rules.never)} AND {is_word('_b2', *links)}) OR {is_word('_b1', *links)}"
        kept = f"{is_word('_b3', without)} AND ({is_word('_b2', doubt)} OR {is_word('_b1', doubt)})"
    negated = f"{is_word(f'_b{k}', *rules.negations)} OR coalesce(contains(_b{k}, {literal(rules.negation_part)}), false)"
    return (
        f"CASE WHEN NOT {in_reach(k)} THEN 1D WHEN {raised} THEN {number(rules.never_weight)} WHEN {kept} THEN 1D "
        f"WHEN {negated} THEN {number(rules.negation_weight)} ELSE 1D END"
    )


def with_idioms(rules: SentimentRules) -> str:
    """Idioms replace the score of a hit with three words before it: a phrase that starts at the hit, the longer one
    first, else the first of the phrases that end at it or before it. Degree phrases before it then lower it."""

    def phrase(names: str) -> str:
        return "concat(" + ", ' ', ".join(f"_{name}" for name in names.split()) + ")"

    def phrases(*groups: str) -> str:
        return "array(" + ", ".join(phrase(names) for names in groups) + ")"

    weights = "map(" + ", ".join(f"{literal(i)}, {number(w)}" for i, w in rules.idioms.items()) + ")"
    places = phrases("w0 a1 a2", "w0 a1", "b1 w0", "b2 b1 w0", "b2 b1", "b3 b2 b1", "b3 b2")
    found = f"filter(transform({places}, p -> try_element_at({weights}, p)), w -> w IS NOT NULL)"
    lowered = f"size(filter({phrases('b3 b2 b1', 'b3 b2', 'b2 b1')}, p -> p IN {listed(rules.booster_phrases_down)}))"
    score = f"coalesce(get({found}, 0), _score)" if rules.idioms else "_score"
    return f"CASE WHEN {in_reach(3)} THEN {score} - {lowered} * {number(rules.booster_weight)} ELSE _score END"
