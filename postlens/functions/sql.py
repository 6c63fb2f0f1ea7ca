"""The scorers that are plain expressions, as functions to call in SQL texts."""

from __future__ import annotations

from pyspark.sql import SparkSession

from postlens.functions.text import COLLAPSE, EDGES
from postlens.operators.sentiment import NEGATIVE_UPTO, POSITIVE_FROM
from postlens.params import TOPIC_RULES, LabelRules


def literal(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def label_body(rules: LabelRules, text: str = "normalized_text(value)") -> str:
    """The rules as a CASE expression over a normalised text, in their order."""
    tests = [(label, words) for label, words in (*rules.rules, (rules.fallback_label, rules.fallback)) if words]
    cases = " ".join(f"WHEN {' OR '.join(f'contains({text}, {literal(w)})' for w in words)} THEN {literal(label)}" for label, words in tests)
    return f"CASE WHEN {text} = '' THEN {literal(rules.default)} {cases} ELSE {literal(rules.default)} END"


def register_functions(
    spark: SparkSession, rules: LabelRules = TOPIC_RULES, positive_from: float = POSITIVE_FROM, negative_upto: float = NEGATIVE_UPTO
) -> None:
    """Make ``normalized_text``, ``weak_label``, ``sentiment_label`` and ``is_set`` callable in SQL on the session's views.

    They are SQL functions, so their bodies become part of the plan and no Python runs. Functions of these names that the
    session has are replaced.
    """
    bodies = {
        "normalized_text(value STRING) RETURNS STRING": f"regexp_replace(regexp_replace(lower(coalesce(value, '')), {literal(COLLAPSE)}, ' '), {literal(EDGES)}, '')",
        "weak_label(value STRING) RETURNS STRING": label_body(rules),
        "sentiment_label(score DOUBLE) RETURNS STRING": f"CASE WHEN score >= {positive_from!r}D THEN 'positive' WHEN score <= {negative_upto!r}D THEN 'negative' ELSE 'neutral' END",
        "is_set(flag STRING) RETURNS BOOLEAN": "coalesce(try_cast(flag AS BOOLEAN), false)",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
