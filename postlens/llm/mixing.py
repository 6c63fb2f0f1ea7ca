"""Mixing sources to target weights: budgets go down a domain-language-source tree, each leaf takes a token prefix.

Only DataFrame operations; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import keep, table, text_of

SEED = 7
#: Target of the mix as a share of the tokens at hand, and how often a document may be taken.
BUDGET_SHARE = 1.0
MAX_EPOCHS = 3

#: The domain of a source is the first whose pattern it matches, else OTHER.
DOMAINS = (("web", "^src[0-9]$"), ("books", "^src1[0-4]$"), ("forums", "^src1[5-9]$"))
OTHER = "other"

#: Weights of the nodes by level; a node that is not listed weighs 1, a node that weighs 0 gets nothing.
WEIGHTS = {"domain": {"web": 5, "books": 3, "forums": 2}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 2}, "source": {"src0": 2}}

LEVELS = ("domain", "lang", "source")
#: Hexadecimal digits of a document's key that make its bucket.
BUCKET_DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


def _internal(level: str) -> str:
    return f"_mix_{level}"


NODES = [_internal(level) for level in LEVELS]


def _name(column: Column) -> Column:
    return F.coalesce(column, F.lit("unknown"))


def source_domain(source: Column, domains=DOMAINS) -> Column:
    out = F.lit(OTHER)
    for name, pattern in reversed(domains):
        out = F.when(source.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def with_nodes(docs: DataFrame, domains=DOMAINS) -> DataFrame:
    """Add the names of the three nodes of each row; a null language or source counts as ``unknown``."""
    return docs.withColumns(
        {NODES[0]: source_domain(_name(F.col("source")), domains), NODES[1]: _name(F.col("lang")), NODES[2]: _name(F.col("source"))}
    )


def _weight(level: str, weights) -> Column:
    listed = weights.get(level, {})
    out = F.lit(1)
    for name, weight in listed.items():
        out = F.when(F.col(_internal(level)) == name, F.lit(weight)).otherwise(out)
    return out.cast("long")


def share_out(parents: DataFrame, children: DataFrame, by: list[str], order: str) -> DataFrame:
    """Give each parent's ``budget`` to its children by ``weight``, none above its ``cap``.

    What a child can't use goes to its siblings by their weights, and so on until nobody is short (the level of a
    water-fill, found in one pass over the children in the order of cap / weight). ``budget`` never exceeds the sum of
    the caps of the children, so a shortage of the whole family was given to the parent's siblings one level up.
    """
    family = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    before = family.orderBy(F.col("cap") / F.col("weight"), order).rowsBetween(Window.unboundedPreceding, -1)
    rows = children.where("weight > 0 and cap > 0")
    rows = rows.join(parents, by) if by else rows.crossJoin(F.broadcast(parents))  # one row at the root
    rows = rows.withColumns(
        {
            "all_weight": F.sum("weight").over(family),
            "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    )
    full = F.col("cap") * (F.col("all_weight") - F.col("weight_before")) <= F.col("weight") * (F.col("budget") - F.col("cap_before"))
    rows = rows.withColumn("full", full)
    rows = rows.withColumns(
        {
            "full_cap": F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(family), F.lit(0)),
            "full_weight": F.coalesce(F.sum(F.when(F.col("full"), F.col("weight"))).over(family), F.lit(0)),
        }
    )
    rest = F.col("weight") * ((F.col("budget") - F.col("full_cap")) / (F.col("all_weight") - F.col("full_weight")))
    given = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(rest)
    return rows.select(*by, order, given.alias("budget"))


def leaf_budgets(leaves: DataFrame, weights=WEIGHTS, budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Tokens to take from each leaf (``budget``), from its tokens at hand (``tokens``): one row for each leaf that gets any.

    A leaf under a node of weight 0 can't be used, so it adds nothing to the caps; its tokens still count for the target.
    """
    usable = F.lit(True)
    for level in LEVELS:
        usable = usable & (_weight(level, weights) > 0)
    caps = leaves.where(usable).select(*NODES, (F.col("tokens") * max_epochs).cast("long").alias("cap"))
    total = leaves.agg(
        F.coalesce(F.sum("tokens") * F.lit(float(budget_share)), F.lit(0.0)).alias("wanted"),
        F.coalesce(F.sum(F.when(usable, F.col("tokens"))), F.lit(0)).alias("tokens"),
    )
    budgets = total.select(F.least("wanted", (F.col("tokens") * max_epochs).cast("double")).alias("budget"))
    for depth, level in enumerate(LEVELS):
        by = NODES[: depth + 1]
        nodes = caps.groupBy(*by).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(level, weights))
        budgets = share_out(budgets, nodes, by[:-1], by[-1])
    return budgets.select(*NODES, F.floor("budget").cast("long").alias("budget")).join(leaves, NODES).where("budget > 0")


def _key(identity: str, seed: int) -> Column:
    """The place of a document in the seeded order of one epoch of its leaf."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_mix_full").cast("string"), F.coalesce(F.col(identity).cast("string"), F.lit("null"))))


def mixing_plan(narrow: DataFrame, weights=WEIGHTS, budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED, identity: str = "doc_id") -> DataFrame:
    """What to take from each leaf: its whole epochs (``_mix_full``) and the last key of the epoch after them (``_mix_cut``).

    The key that ends a prefix is found in two steps, so that a leaf with a third of all rows is never sorted in one
    task: sums of a leaf's buckets of keys, then an order within the one bucket that holds the end.
    """
    leaves = narrow.groupBy(*NODES).agg(F.sum("_mix_tokens").alias("tokens"))
    plan = leaf_budgets(leaves, weights, budget_share, max_epochs)
    plan = keep(
        plan.select(*NODES, F.floor(F.col("budget") / F.col("tokens")).cast("int").alias("_mix_full"), (F.col("budget") % F.col("tokens")).alias("_mix_rest")),
        "mix-budgets",
    )
    keyed = narrow.join(plan.where("_mix_rest > 0"), NODES).select(*NODES, "_mix_tokens", "_mix_rest", _key(identity, seed).alias("key"))
    keyed = keyed.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    sums = keyed.groupBy(*NODES, "bucket").agg(F.sum("_mix_tokens").alias("tokens"), F.first("_mix_rest").alias("rest"))
    upto = F.sum("tokens").over(Window.partitionBy(*NODES).orderBy("bucket"))
    ends = sums.withColumn("upto", upto).where("upto >= rest and upto - tokens < rest")
    ends = keep(ends.select(*NODES, "bucket", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("left")), "mix-buckets")
    inside = keyed.join(ends, [*NODES, "bucket"])
    upto = F.sum("_mix_tokens").over(Window.partitionBy(*NODES).orderBy("key"))
    cuts = inside.withColumn("upto", upto).where("upto >= left").groupBy(*NODES).agg(F.min("key").alias("_mix_cut"))
    return keep(plan.join(cuts, NODES, "left").select(*NODES, "_mix_full", "_mix_cut"), "mix-plan")


def with_tokens(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_mix_tokens", F.regexp_count(text_of(), F.lit(WORD)).cast("long"))


def take(docs: DataFrame, plan: DataFrame, seed: int = SEED, identity: str = "doc_id", epoch: str = "epoch") -> DataFrame:
    """The rows of ``docs`` (with their nodes) as often as the plan takes them, with the number of the epoch."""
    rows = docs.join(plan, NODES)
    copies = F.col("_mix_full") + F.coalesce((_key(identity, seed) <= F.col("_mix_cut")).cast("int"), F.lit(0))
    rows = rows.withColumn("_mix_copies", copies).where("_mix_copies > 0")
    columns = [c for c in docs.columns if c != epoch]
    return rows.select(*columns, F.explode(F.sequence(F.lit(0), F.col("_mix_copies") - 1)).alias(epoch))


def narrow_rows(docs: DataFrame, domains=DOMAINS) -> DataFrame:
    """Identity, nodes and number of tokens of each row: the text is read once."""
    return keep(with_tokens(with_nodes(docs, domains)).select("doc_id", *NODES, "_mix_tokens"), "mix-rows")


def mix(docs: DataFrame, weights=WEIGHTS, budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED, domains=DOMAINS) -> DataFrame:
    """The rows of ``docs`` that the mix takes, one row for each copy, with all their columns; the text is not shuffled
    as long as the plan, a row for each leaf, is small enough for Spark to broadcast.

    ``docs`` needs doc_id, text, lang and source. A null language or source is a leaf of its own, ``unknown``. A null
    text has no tokens; leaves without tokens give nothing. Rows with equal doc_id stand or fall together, each with its
    own tokens; a null doc_id counts as one such id. A prefix ends with the document that reaches the leaf's budget. An
    empty table gives an empty result.
    """
    plan = mixing_plan(narrow_rows(docs, domains), weights, budget_share, max_epochs, seed)
    return take(with_nodes(docs, domains), plan, seed, epoch="_mix_epoch").select(*docs.columns)


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to the weights: a row for each copy that is taken."""
    narrow = narrow_rows(table(spark, folder, "documents"))
    taken = take(narrow, mixing_plan(narrow))
    return taken.select("doc_id", *[F.col(_internal(level)).alias(level) for level in LEVELS], F.col("_mix_tokens").alias("n_tokens"), "epoch")


def _case(column: str, listed) -> str:
    return "CAST(CASE " + " ".join(f"WHEN {column} = '{k}' THEN {v}" for k, v in listed.items()) + " ELSE 1 END AS BIGINT)"


def _oracle_level(depth: int) -> str:
    by, level = ", ".join(LEVELS[:depth]), LEVELS[depth]
    family = f"PARTITION BY {by}" if by else ""
    keys = ", ".join(LEVELS[: depth + 1])
    join = f"JOIN b{depth} USING ({by})" if by else "CROSS JOIN b0"
    return f"""
n{depth} AS (SELECT {keys}, CAST(sum(tokens * {MAX_EPOCHS}) AS BIGINT) AS cap, {_case(level, WEIGHTS[level])} AS weight FROM leaves GROUP BY ALL),
s{depth} AS (
  SELECT *, sum(weight) OVER ({family}) AS all_weight,
    coalesce(sum(cap) OVER ({family} ORDER BY cap / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
    coalesce(sum(weight) OVER ({family} ORDER BY cap / weight, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_before
  FROM n{depth} {join} WHERE weight > 0 AND cap > 0),
f{depth} AS (SELECT *, cap * (all_weight - weight_before) <= weight * (budget - cap_before) AS is_full FROM s{depth}),
b{depth + 1} AS (
  SELECT {keys}, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE weight * (
    (budget - coalesce(sum(cap) FILTER (is_full) OVER ({family}), 0)) / (all_weight - coalesce(sum(weight) FILTER (is_full) OVER ({family}), 0))) END AS budget
  FROM f{depth})"""


_ORACLE = f"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
rows_ AS (SELECT *, CASE {' '.join(f"WHEN regexp_matches(source, '{p}') THEN '{d}'" for d, p in DOMAINS)} ELSE '{OTHER}' END AS domain FROM docs),
leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM rows_ GROUP BY ALL),
b0 AS (SELECT least(sum(tokens) * CAST({BUDGET_SHARE} AS DOUBLE), CAST(sum(tokens) * {MAX_EPOCHS} AS DOUBLE)) AS budget FROM leaves),
{','.join(_oracle_level(i) for i in range(3))},
plan AS (SELECT domain, lang, source, CAST(floor(budget) AS BIGINT) // tokens AS full_, CAST(floor(budget) AS BIGINT) % tokens AS rest FROM b3 JOIN leaves USING (domain, lang, source)
  WHERE floor(budget) > 0),
keyed AS (SELECT *, md5('{SEED}:' || full_ || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM rows_ JOIN plan USING (domain, lang, source)),
summed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS upto FROM keyed),
cuts AS (SELECT domain, lang, source, min(key) AS cut FROM summed WHERE rest > 0 AND upto >= rest GROUP BY ALL),
taken AS (SELECT *, full_ + CASE WHEN key <= cut THEN 1 ELSE 0 END AS copies FROM keyed LEFT JOIN cuts USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, CAST(unnest(range(copies)) AS INTEGER) AS epoch FROM taken
"""

QUERIES = {"op10_mixing": op10_mixing}
ORACLES = {"op10_mixing": _ORACLE}
