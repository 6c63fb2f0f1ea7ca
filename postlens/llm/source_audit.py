"""How the words of each source diverge from those of the other sources of its language.

A row of the divergence table is accumulated as in Gustavson's sparse matrix product: a source goes through its terms,
looks each one up in the term-major index, and adds what the term contributes for each peer in that entry to a dense
accumulator with one place for each peer. Pairs of postings are never written as rows. Terms that one or both sides lack
are worth the same for all of them, so they are added as a baseline: the value of a pair without any term, corrected by
the distinct counts of either side.
"""

from __future__ import annotations

import string

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import keep, table, text_of

#: Documents of a language that must hold a term, the scale of the shares, and the terms reported for each group.
LEAST_DOCS, SCALE, TOP = 3, 1_000_000_000, 200
#: Sources of a language on one side of an accumulator, postings of a part of the index, and rows of the index at a time.
PEERS, PART, CHUNK = 256, 1 << 16, 1 << 16
#: Entries of a task's table of counts, and bytes of a text that are split at a time.
HELD, PIECE = 200_000, 1 << 22

_OTHER = bytes(b for b in range(128) if not chr(b).isalpha())
_TERMS = bytes.maketrans(string.ascii_uppercase.encode() + _OTHER, string.ascii_lowercase.encode() + b" " * len(_OTHER))


def terms_of(text: bytes):
    """Lists of the terms of a text: runs of A-Z, a-z (lower-cased) and bytes from 128 on."""
    text, at = text.translate(_TERMS), 0
    while at < len(text):
        end = len(text) if len(text) - at <= PIECE else text.rfind(b" ", at, at + PIECE)
        if end < 0:
            end = text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end + 1


def term_counts(docs: DataFrame) -> DataFrame:
    """Partial counts (lang, source, term, count, docs), and one row with a null term for each group of a task."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], text_of().cast("binary").alias("text"))
    names = ["lang", "source", "term", "count", "docs"]

    def flush(groups):
        for (lang, source), (counts, docs) in groups.items():
            terms = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(terms) + 1)), pa.array([source] * (len(terms) + 1)), pa.array([None, *(t.decode() for t in terms)], pa.string()),
                 pa.array([0, *counts.values()], pa.int64()), pa.array([0, *(docs[t] for t in terms)], pa.int64())], names=names)

    def work(batches):
        from collections import Counter

        groups, held = {}, 0
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                counts, docs = groups.setdefault((lang, source), (Counter(), Counter()))
                held -= len(counts)
                seen = None
                for terms in terms_of(text.as_py()):
                    counts.update(terms)
                    seen = seen | set(terms) if seen else set(terms)
                docs.update(seen or ())
                held += len(counts)
                if held > HELD:
                    yield from flush(groups)
                    groups, held = {}, 0
        yield from flush(groups)

    return rows.mapInArrow(work, "lang string, source string, term string, count long, docs long")


def term_index(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """The term-major index: lang, term, source, count (in the source), total (in the language), term_number (unique at
    all), first (of its term) for each kept term of each source; and a row with a null term for each source.

    One shuffle by (lang, term) serves the sums, the number of documents and the order.
    """
    dealt = term_counts(docs).repartition("lang", "term")
    counts = dealt.groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    counts = counts.withColumn("place", F.monotonically_increasing_id())
    of_term = Window.partitionBy("lang", "term")
    totals = counts.withColumns({"total": F.sum("count").over(of_term), "docs": F.sum("docs").over(of_term), "term_number": F.min("place").over(of_term)})
    kept = totals.where((F.col("docs") >= least) | F.col("term").isNull())
    return kept.select("lang", "term", "source", "count", "total", "term_number", (F.col("place") == F.col("term_number")).alias("first"))


def share(count: str, total: str, kinds: str) -> str:
    """1 + floor(SCALE * (count + 1) / (total + kinds)) without overflow; 0 if there is no term."""
    scaled = f"cast({SCALE} as decimal(10,0)) * (cast({count} as decimal(19,0)) + 1)"
    return f"if({kinds} = 0, 0L, 1L + ({scaled} div cast({total} + {kinds} as decimal(19,0))))"


def excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)² / q); exact, as no share is over SCALE + 1."""
    return (p - q) ** 2 // q


def _scattered(batches):
    """(lang, row, peer, value) for each source and peer of a cell, summed over the parts of the index a task reads.

    The rows come in order of cell and term. A row of the table goes through its postings in the chunk; each finds the
    entry of its term, whose peers get what differs from the baseline at their places of the row's accumulator.
    """
    cell, sums, held, size = None, None, [], 0

    def add(rows):
        number, source, p, zero, as_row, as_peer = rows
        peers = np.flatnonzero(as_peer)
        starts = np.searchsorted(number[peers], number)
        lengths = np.searchsorted(number[peers], number, side="right") - starts
        own = np.flatnonzero(as_row)
        order = own[np.argsort(source[own], kind="stable")]
        cuts = np.flatnonzero(np.diff(source[order])) + 1
        for mine in np.split(order, cuts) if len(order) else ():
            n = lengths[mine]
            at = np.repeat(starts[mine] - np.cumsum(n) + n, n) + np.arange(n.sum())
            other = peers[at]
            mp, mz, q, qz = np.repeat(p[mine], n), zero[mine[0]], p[other], zero[other]
            value = excess(mp, q) - excess(mp, qz) - excess(mz, q) + excess(mz, qz)
            np.add.at(sums[source[mine[0]] % PEERS], source[other] % PEERS, value)

    def done():
        row, peer = np.nonzero(sums)
        lang, r, c = cell
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(row), pa.string()), pa.array(row + r * PEERS), pa.array(peer + c * PEERS), pa.array(sums[row, peer])], names=["lang", "row", "peer", "value"]
        )

    for batch in batches:
        langs = batch.column(0)
        r, c, *rest = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 9))
        codes = langs.dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(r) != 0) | (np.diff(c) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(r)]):
            if a == b:
                continue
            this = (langs[a].as_py(), int(r[a]), int(c[a]))
            if this != cell:
                if held:
                    add([np.concatenate(x) for x in zip(*held)])
                if cell:
                    yield done()
                cell, sums, held, size = this, np.zeros((PEERS, PEERS), np.int64), [], 0
            held.append([x[a:b] for x in rest])
            size += b - a
            if size >= CHUNK:  # whole terms only: the last one stays
                rows = [np.concatenate(x) for x in zip(*held)]
                cut = np.searchsorted(rows[0], rows[0][-1])
                add([x[:cut] for x in rows])
                held, size = [[x[cut:] for x in rows]], int(len(rows[0]) - cut)
    if held:
        add([np.concatenate(x) for x in zip(*held)])
    if cell:
        yield done()


def _baselines(cells: pd.DataFrame) -> pd.DataFrame:
    """(lang, row, peer, value) of all pairs of a cell as if no term were in both, by the distinct shares of either side."""
    kinds = int(cells["kinds"].iloc[0])
    rows, peers = cells[cells["as_row"]], cells[cells["as_peer"]]
    own, theirs = (x.drop_duplicates("number").sort_values("number") for x in (rows, peers))
    p, q = own["zero"].to_numpy(), theirs["zero"].to_numpy()
    if kinds:
        none = excess(p[:, None], q[None, :])
        value = none * kinds
        at = np.searchsorted(own["number"], rows["number"])
        for i, share_, n in zip(at, rows["share"].to_numpy(), rows["n"].to_numpy()):
            if n:
                value[i] += n * (excess(share_, q) - none[i])
        at = np.searchsorted(theirs["number"], peers["number"])
        for i, share_, n in zip(at, peers["share"].to_numpy(), peers["n"].to_numpy()):
            if n:
                value[:, i] += n * (excess(p, share_) - none[:, i])
    else:
        value = np.zeros((len(p), len(q)), np.int64)
    r, c = np.repeat(own["number"].to_numpy(), len(q)), np.tile(theirs["number"].to_numpy(), len(p))
    out = pd.DataFrame({"lang": cells["lang"].iloc[0], "row": r, "peer": c, "value": value.ravel()})
    return out[out["row"] != out["peer"]]


def _in_cells(frame: DataFrame) -> DataFrame:
    """Each row of a source once for each cell (r, c) that holds it as a row, as a peer, or as both."""
    own, blocks = F.floor(F.col("source") / PEERS).cast("int"), F.ceil(F.col("sources") / PEERS).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = frame.withColumns({"own": own, "blocks": blocks}).withColumn("other", other)
    side = lambda r, c, as_row, as_peer: F.struct(r.alias("r"), c.alias("c"), as_row.alias("as_row"), as_peer.alias("as_peer"))
    same = F.col("own") == F.col("other")
    places = F.when(same, F.array(side(F.col("own"), F.col("own"), F.lit(True), F.lit(True)))).otherwise(
        F.array(side(F.col("own"), F.col("other"), F.lit(True), F.lit(False)), side(F.col("other"), F.col("own"), F.lit(False), F.lit(True)))
    )
    return rows.withColumn("cell", F.explode(places)).select(*frame.columns, "cell.*")


_PAIRS = "lang string, row long, peer long, value long"


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: for each group of ``docs`` (lang, source) its divergence from each other
    source of its language (part ``pair``) and the terms that are more frequent than in the language (``term``, ``top`` at
    most).

    Null text, lang and source count as ''. Groups without terms, and languages without kept terms (all values 0), are
    there too; a language with one source has no pairs. Repeated rows count as documents of their own. Equal values are
    ranked by the item's bytes. Other columns are not read. All arithmetic is exact; a value that does not fit in 64 bits
    raises. The pairs of a language are as many as its sources squared, as the result is.
    """
    index = keep(term_index(docs, least), "audit-index")
    terms = index.where("term is not null")
    langs = terms.groupBy("lang").agg(
        F.count_if("first").alias("kinds"), F.sum(F.when(F.col("first"), F.col("total"))).alias("lang_count"), F.ceil(F.count(F.lit(1)) / PART).alias("parts")
    )
    groups = index.groupBy("lang", "source").agg(F.sum("count").alias("own_count")).join(langs, "lang", "left")
    groups = groups.na.fill(0, ["kinds", "lang_count"]).na.fill(1, ["parts"])
    groups = groups.withColumns(
        {"number": F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1, "sources": F.count(F.lit(1)).over(Window.partitionBy("lang")),
         "zero": F.expr(share("0", "own_count", "kinds"))}
    )
    groups = keep(groups, "audit-groups")

    postings = terms.join(groups, ["lang", "source"]).withColumn("p", F.expr(share("count", "own_count", "kinds")))
    narrow = postings.select("lang", F.col("number").alias("source"), F.col("term_number").alias("term"), "p", "zero", "sources", F.pmod(F.xxhash64("term_number"), F.col("parts")).alias("part"))
    cells = _in_cells(narrow).repartition("lang", "r", "c", "part").sortWithinPartitions("lang", "r", "c", "term")
    met = cells.select("lang", "r", "c", "term", "source", "p", "zero", "as_row", "as_peer").mapInArrow(_scattered, _PAIRS)

    distinct = narrow.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("n"))
    sides = groups.select("lang", F.col("number").alias("source"), "sources", "zero", "kinds").join(distinct, ["lang", "source"], "left").na.fill(0, ["n", "p"])
    base = _in_cells(sides).select("lang", "r", "c", F.col("source").alias("number"), "zero", "kinds", F.col("p").alias("share"), "n", "as_row", "as_peer")
    base = base.groupBy("lang", "r", "c").applyInPandas(_baselines, _PAIRS)

    summed = base.union(met.where("row <> peer")).groupBy("lang", "row", "peer").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))
    names = groups.select("lang", F.col("number").alias("row"), "source")
    pairs = summed.join(names, ["lang", "row"]).join(names.select("lang", F.col("row").alias("peer"), F.col("source").alias("item")), ["lang", "peer"])
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))

    words = postings.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "p", F.expr(share("total", "lang_count", "kinds")).alias("q"))
    words = words.where("p > q").withColumn("value", F.expr("(p - q) * (p - q) div q")).drop("p", "q")
    words = words.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
    return pairs.unionByName(words)


def op12_source_audit(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, by language and source."""
    return audit(table(spark, folder, "documents"))


QUERIES = {"op12_source_audit": op12_source_audit}
ORACLES: dict[str, str] = {
    "op12_source_audit": r"""
with docs as (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
words as (select id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
kept as (select lang, term, count(*) as total from words group by lang, term having count(distinct id) >= 3),
counts as (select lang, source, term, count(*) as n from words semi join kept using (lang, term) group by lang, source, term),
langs as (select lang, count(*) as kinds, sum(total) as lang_count from kept group by lang),
groups as (
  select g.lang, g.source, coalesce(c.own, 0) as own, coalesce(l.kinds, 0) as kinds, coalesce(l.lang_count, 0) as lang_count
  from (select distinct lang, source from docs) g left join (select lang, source, sum(n) as own from counts group by lang, source) c using (lang, source)
  left join langs l using (lang)),
shares as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (g.own + g.kinds) as p,
    1 + (1000000000::hugeint * (k.total + 1)) // (g.lang_count + g.kinds) as q
  from groups g join kept k using (lang) left join counts c using (lang, source, term)),
sums as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(s.value, 0) as bigint) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),
terms as (select lang, source, 'term' as part, term as item, cast(((p - q) * (p - q)) // q as bigint) as value from shares where n > 0 and p > q)
select * from (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, encode(item)) as integer) as rank
  from (select * from pairs union all select * from terms))
where part = 'pair' or rank <= 200
"""
}
