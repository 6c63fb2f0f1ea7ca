"""Many keywords looked for in one pass over a text, with native expressions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens.functions.text import normalize_text
from postlens.params import LabelRules


def _char(c: str) -> str:
    return c if c.isascii() and c.isalnum() else f"\\x{{{ord(c):X}}}"


def _branches(node: dict) -> str:
    """The pattern of what may follow; the longest keyword is taken, as every end but the last is optional."""
    ways = [_char(c) + _branches(child) for c, child in sorted(node.items()) if c]
    if not ways:
        return ""
    return "(?:" + "|".join(ways) + ")" + ("?" if "" in node else "")


def keyword_pattern(keywords: Sequence[str]) -> str:
    """A pattern that matches nothing itself, but at each place captures the longest keyword that starts there.

    The keywords form a tree by their characters, so a place costs a look at its first character, whatever their number.
    """
    tree: dict = {}
    for word in keywords:
        if not word:
            raise ValueError("an empty keyword")
        node = tree
        for c in word:
            node = node.setdefault(c, {})
        node[""] = {}
    return f"(?=({_branches(tree)}))"


def keyword_hits(text: Column, keywords: Sequence[str]) -> Column:
    """The distinct keywords that occur in a text as substrings, in no order; a null text holds none.

    Overlapping keywords are all found: those that start at different places by the pattern, and those that start with
    one another by a table of the shorter ones.
    """
    words = sorted(set(keywords))
    if not words:
        return F.array().cast("array<string>")
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(keyword_pattern(words)), F.lit(1)))
    inner = {w: [p for p in (w[:i] for i in range(1, len(w) + 1)) if p in set(words)] for w in words}
    longer = {w: parts for w, parts in inner.items() if len(parts) > 1}
    if longer:
        table = F.create_map(*[c for w, parts in longer.items() for c in (F.lit(w), F.array(*map(F.lit, parts)))])
        found = F.array_distinct(F.flatten(F.transform(found, lambda w: F.coalesce(F.try_element_at(table, w), F.array(w)))))
    return F.coalesce(found, F.array().cast("array<string>"))


def rule_label_once(text: Column, rules: LabelRules) -> Column:
    """The label that ``rule_label`` gives the normalised text, from one pass over it for the keywords of all rules."""
    groups = [*rules.rules, *([(rules.fallback_label, rules.fallback)] if rules.fallback else [])]
    words = [w for _, listed in groups for w in listed]
    # without a blank in any keyword, white space can stay as it is
    base = normalize_text(text) if any(not w.isalnum() for w in words) else F.lower(text)

    def chain(hits: Column) -> Column:
        label = F.when(F.lit(False), rules.default)
        for name, listed in groups:
            if listed:
                label = label.when(F.arrays_overlap(hits, F.array(*map(F.lit, listed))), name)
        return label.otherwise(rules.default)

    # a lambda over one element: the hits are computed once and not for each rule
    return F.get(F.transform(F.array(keyword_hits(base, words)), chain), F.lit(0))
