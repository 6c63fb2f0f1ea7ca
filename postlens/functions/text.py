"""Column expressions on text. All of them are native Spark expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.params import LabelRules

# Unicode white space, and the four separator controls that Python's str.strip also removes.
SPACE = r"[\s\x1C-\x1F]"
COLLAPSE = rf"(?U){SPACE}+"
EDGES = rf"(?U)\A{SPACE}+|{SPACE}+\z"
NOT_SPACE = r"(?U)[^\s\x1C-\x1F]+"

# Token patterns.
AFFECT_TOKEN = r"[A-Za-z']+"
GRAM_TOKEN = r"[\p{L}\p{N}_]{2,}"


def trim_whitespace(text: Column) -> Column:
    """Trim all white space, not only blanks."""
    return F.regexp_replace(text, EDGES, "")


def normalize_text(text: Column) -> Column:
    """Lower case, white space runs to one blank, trimmed; null gives the empty string."""
    return trim_whitespace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COLLAPSE, " "))


def post_text(title: Column, body: Column) -> Column:
    """Title and body joined by a line break, null as empty, trimmed."""
    return trim_whitespace(F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(body, F.lit(""))))


def with_text(posts: DataFrame, text_col: str = "text", title_col: str = "title", body_col: str = "selftext") -> DataFrame:
    """Give every post a non-null text. A text column that is present is kept; only its nulls become empty."""
    if text_col in posts.columns:
        return posts.withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))
    title = F.col(title_col) if title_col in posts.columns else F.lit("")
    body = F.col(body_col) if body_col in posts.columns else F.lit("")
    return posts.withColumn(text_col, post_text(title, body))


def is_blank(text: Column) -> Column:
    return ~F.coalesce(text, F.lit("")).rlike(NOT_SPACE)


def is_plain(keyword: str) -> bool:
    """Whether a keyword can be looked for in a text whose white space is as it came: no word of it is empty."""
    return all(keyword.split(" ")) and not re.search(r"[^\S ]", keyword)


def holds(lowered: Column, keyword: str) -> Column:
    """True where a text holds a plain keyword, any white space for each blank of it."""
    words = keyword.split(" ")
    if len(words) == 1:
        return lowered.contains(keyword)
    # the regular expression runs only where the longest word was found
    pattern = COLLAPSE.join(re.escape(w) for w in words).replace("(?U)", "")
    return lowered.contains(max(words, key=len)) & lowered.rlike("(?U)" + pattern)


def contains_any(text: Column, keywords: Iterable[str], whole_word: bool = False, any_space: bool = False) -> Column:
    """True where the text holds one of the keywords, as a substring or as a whole word; with ``any_space`` a blank of a
    plain keyword stands for any white space."""
    found = F.lit(False)
    for keyword in keywords:
        if whole_word:
            found = found | text.rlike(rf"(?U)(?<!\w){re.escape(keyword)}(?!\w)")
        else:
            found = found | (holds(text, keyword) if any_space and is_plain(keyword) else text.contains(keyword))
    return found


def rule_label(normalized: Column, rules: LabelRules, whole_word: bool = False, any_space: bool = False) -> Column:
    """The label of the first rule that hits, else the fallback label, else the default. With ``any_space`` the text need
    not have its white space collapsed, only its letters in lower case."""
    chain = F.when(normalized == "", rules.default)
    for label, keywords in rules.rules:
        chain = chain.when(contains_any(normalized, keywords, whole_word, any_space), label)
    if rules.fallback:
        chain = chain.when(contains_any(normalized, rules.fallback, whole_word, any_space), rules.fallback_label)
    return chain.otherwise(rules.default)


def mask_keywords(text: Column, keywords: Iterable[str], mask: str = " ") -> Column:
    """Remove the labelling keywords from a text, so that a classifier cannot relearn the rules from them."""
    if not (keywords := set(keywords)):
        return text
    parts = [re.escape(k).replace(r"\ ", COLLAPSE.removeprefix("(?U)")) for k in sorted(keywords, key=lambda k: (-len(k), k))]
    return F.regexp_replace(text, "(?iU)" + "|".join(parts), mask)


def line_words(line: Column) -> Column:
    """Words of a line between single blanks.

    Leading and inner empty words are kept, trailing ones are dropped; an empty line is one empty word and a line
    of blanks only has no words.
    """
    kept = F.regexp_replace(line, r" +\z", "")
    return (
        F.when(line == "", F.array(F.lit("")))
        .when(kept == "", F.array().cast("array<string>"))
        .otherwise(F.split(kept, " ", -1))
    )


def affect_tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and apostrophes."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(AFFECT_TOKEN), F.lit(0))


def gram_tokens(text: Column) -> Column:
    """Lower-case words of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(GRAM_TOKEN), F.lit(0))


def bigrams(tokens: Column) -> Column:
    """Pairs of neighbouring tokens, joined by a blank."""
    return F.zip_with(
        F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))),
        F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda left, right: F.concat_ws(" ", left, right),
    )


def space_words(text: Column) -> Column:
    """Lower-case words split at each single white space character.

    Leading and inner empty words are kept and trailing ones dropped, as ``pyspark.ml.feature.Tokenizer`` does.
    """
    kept = F.regexp_replace(F.lower(text), r"\s+\z", "")
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(kept == "", F.array().cast("array<string>"))
        .otherwise(F.split(kept, r"\s", -1))
    )


def first_field(line: Column, delimiter: str = ",") -> Column:
    """The part of a line before the first delimiter."""
    return F.substring_index(line, delimiter, 1)


def quoted(value: Column) -> Column:
    """A string as a JSON string literal."""
    listed = F.to_json(F.array(value))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)
