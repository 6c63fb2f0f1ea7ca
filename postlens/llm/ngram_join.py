"""Jaccard join on word shingles with token-group matrices.

Similar documents are put into groups; a group is known by the union of its members' tokens, and a query opens only the
groups whose union shares enough tokens with it to hold a partner. The steps:

1. Documents with equal shingle sets become one set. Tokens that a large share of all sets hold are found on the way.
2. Each set reports the first tokens of one common order (frequent tokens last). Linked sets have a known number of them
   in common, so sets that share fewer with all others are done.
3. Sets of fitting sizes that share a token form a group, which elects a leader. Each set is compared with the leader it
   shares most tokens with, and links make components.
4. For each set the tokens are counted that sets of other components hold, too; sets with too few of them are done. The
   rest form groups again. Each is cut into small groups of similar members with a token-group matrix, and only members
   of qualifying groups are compared, and none that are connected already.

All comparisons are of whole sets; every link between different components is found.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import LOWER, SPACE, components, joined, keep, mix64, table

WORDS = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: A token is frequent if at least one in so many counted tokens is the same; there can be no more than that of them.
FREQUENT = 1 << 17
#: Tokens that are counted together before rare ones are left out of the counts.
COUNTED = 1 << 22
#: One in EXTRA tokens of a set is reported beyond the least number.
EXTRA = 12
#: Members on one side of a cell, and members of a small group.
BLOCK, SMALL = 1024, 16

_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))
_ODD = mix64(np.arange(1, WORDS + 2, dtype=np.uint64)) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct shingles of each whole text as ascending 64-bit hashes. A text of fewer than WORDS words has one
    shingle, its words; a text without words has none."""
    data, starts, _ = joined(texts)
    blank = SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank)).astype(np.int8)))
    first, end = edge[0::2], edge[1::2]
    if not len(first):
        return [np.empty(0, np.uint64)] * len(texts)
    inside = np.flatnonzero(~blank)
    place = inside - np.repeat(first, end - first)
    powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(int(place.max()), _BASE))))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[LOWER[data[inside]]] * powers[place])))
    upto = np.cumsum(end - first)
    words = mix64(total[upto] - total[upto - (end - first)] + (end - first).astype(np.uint64) * _ODD[WORDS])
    owner = np.searchsorted(starts, first, side="right") - 1
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    sums = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
    for j in range(WORDS):
        sums += words[j : j + len(sums)] * _ODD[j]
    shingles = mix64(sums)
    out = []
    for a, b in zip(cut[:-1], cut[1:]):
        if b - a >= WORDS:
            out.append(np.unique(shingles[a : b - WORDS + 1]))
        else:
            out.append(mix64((words[a:b] * _ODD[: b - a]).sum(keepdims=True) + np.uint64(b - a))[: min(1, b - a)])
    return out


def set_id(tokens: np.ndarray) -> int:
    return np.int64(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes(), len(tokens)))).item() if len(tokens) else 0


def reported(tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first tokens of the common order, and which of them are frequent.

    Of n tokens, n - ceil(0.75 n) + 1 are such that sets that link share one; with k more of both they share k + 1.
    """
    n = len(tokens)
    often = np.zeros(n, dtype=bool)
    if len(frequent):
        at = np.searchsorted(frequent, tokens)
        at[at == len(frequent)] = 0
        often = frequent[at] == tokens
    order = np.concatenate((np.flatnonzero(~often), np.flatnonzero(often)))[: n + (-n * PERCENT // 100) + 1 + n // EXTRA]
    return tokens[order], often[order]


#: Tokens that a set with n shingles shares with others at least, if it links: its partner has 0.75 n shingles or more.
NEEDED = f"floor(n * {PERCENT} / {100 * EXTRA}) + 1"


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if len(small) * 100 < PERCENT * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= PERCENT * (len(a) + len(b) - both)

def often_held(tokens: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The values that occur ``least`` times or more, ascending, and their counts. Sorts the array in place and makes no
    other of its size, since all tokens that a task counts together lie in it."""
    tokens.sort()
    if len(tokens) < least:
        return tokens[:0], np.empty(0, np.int64)
    values = np.unique(tokens[: len(tokens) - least + 1][tokens[: len(tokens) - least + 1] == tokens[least - 1 :]])
    return values, (np.searchsorted(tokens, values, "right") - np.searchsorted(tokens, values)).astype(np.int64)


def _survey(batches_of):
    """Rows of the texts (id, mark, n, set) and of tokens that occur often among the sets of a task (set: the token)."""

    def run(batches):
        held, size, seen = [], 0, set()

        def counted():
            tokens = np.concatenate(held)
            held.clear()
            values, counts = often_held(tokens, max(4, size // FREQUENT))
            none = pa.nulls(len(values), pa.int64())
            return pa.RecordBatch.from_arrays(
                [none, none, pa.array(counts), pa.array(values.view(np.int64)), pa.array(np.ones(len(values), bool))], names=["id", "mark", "n", "set", "is_token"]
            )

        for keys, texts in batches_of(batches):
            sets = shingle_sets(texts)
            ids = [set_id(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k["id"] for k in keys], pa.int64()), pa.array([k["mark"] for k in keys], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.int64()), pa.array([False] * len(sets))],
                names=["id", "mark", "n", "set", "is_token"],
            )
            for s, i in zip(sets, ids):
                if len(s) and i not in seen:
                    seen.add(i)
                    held.append(s)
                    size += len(s)
            if size >= COUNTED:
                yield counted()
                held, size, seen = [], 0, set()
        if size:
            yield counted()

    return run


def _grouped_texts(batches):
    """(keys, texts) of about a megabyte."""
    keys, texts, size = [], [], 0
    for batch in batches:
        for k, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = t.as_py()
            if texts and size + len(data) > 1 << 20:
                yield keys, texts
                keys, texts, size = [], [], 0
            keys.append(k)
            texts.append(data)
            size += len(data)
    if texts:
        yield keys, texts


def _reporter(frequent: np.ndarray):
    """(token, set, n) of each set once in a task; the lowest bit of a token tells whether it is frequent."""

    def run(batches):
        seen = set()
        for _, texts in _grouped_texts(batches):
            tokens, sets, sizes = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int32)]
            for s in shingle_sets(texts):
                i = set_id(s)
                if len(s) and i not in seen:
                    seen.add(i)
                    got, often = reported(s, frequent)
                    tokens.append(((got & ~np.uint64(1)) | often.astype(np.uint64)).view(np.int64))
                    sets.append(np.full(len(got), i))
                    sizes.append(np.full(len(got), len(s), np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, sets, sizes)], names=["token", "set", "n"])

    return run


def _shared(batches):
    """From rows in the order of their tokens: those of sets that share their token with one of fitting size, with the
    least set of such a run as the leader. Rows of frequent tokens all stay and have no leader yet."""
    held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)]

    def several(token, sets, n):
        order = np.lexsort((sets, n, token))
        token, sets, n = token[order], sets[order], n[order]
        fresh = np.concatenate(([True], (token[1:] != token[:-1]) | (sets[1:] != sets[:-1])))[: len(token)]
        token, sets, n = token[fresh], sets[fresh], n[fresh]
        often = (token & 1).astype(bool)
        starts = np.ones(len(token), dtype=bool)  # of runs of sets such that each fits the next
        starts[1:] = (token[1:] != token[:-1]) | (100 * n[:-1] < PERCENT * n[1:])
        run = np.cumsum(starts) - 1
        first = np.flatnonzero(starts)
        leader = np.minimum.reduceat(sets, first)[run] if len(first) else sets
        stay = often | (np.bincount(run)[run] > 1) if len(run) else often
        return pa.RecordBatch.from_arrays(
            [pa.array(token[stay]), pa.array(sets[stay]), pa.array(n[stay]), pa.array(leader[stay], mask=often[stay])], names=["token", "set", "n", "leader"]
        )

    for batch in batches:
        held = [np.concatenate((old, batch.column(i).to_numpy().astype(np.int64))) for i, old in enumerate(held)]
        token = held[0]
        cut = 0
        if len(token) and token[0] != token[-1]:
            cut = int(np.flatnonzero(token != token[-1])[-1]) + 1
        elif len(token) and token[-1] & 1:  # a frequent token needs no look at its other rows
            cut = len(token)
        if cut:
            yield several(*[x[:cut] for x in held])
            held = [x[cut:] for x in held]
    if len(held[0]):
        yield several(*held)


def _teller(batches_of):
    """The tokens of the asked sets."""

    def run(batches):
        for keys, texts in batches_of(batches):
            out = []
            for asked, s in zip(keys, shingle_sets(texts)):
                i = set_id(s)
                out += [(i, s.tobytes(), r["leader"], r["leads"]) for r in asked if r["set"] == i]
            if out:
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], names=["set", "tokens", "leader", "leads"])

    return run


def _with_leader(batches):
    for batch in batches:
        sets, tokens, leaders, theirs = (batch.column(i) for i in range(4))
        hit = [linked(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)) for a, b in zip(tokens, theirs)]
        yield pa.RecordBatch.from_arrays([sets, leaders], names=["a", "b"]).filter(pa.array(hit, pa.bool_()))


class TokenGroupMatrix:
    """Small groups of similar sets, with the groups of each token."""

    def __init__(self, sets: list[np.ndarray], size: int = SMALL):
        order = sorted(range(len(sets)), key=lambda i: (int(sets[i][0]), len(sets[i])))  # by least token: similar ones meet
        self.groups = [order[i : i + size] for i in range(0, len(order), size)]
        self.shortest = np.array([min(len(sets[i]) for i in g) for g in self.groups])
        self.longest = np.array([max(len(sets[i]) for i in g) for g in self.groups])
        unions = [np.unique(np.concatenate([sets[i] for i in g])) for g in self.groups]
        tokens = np.concatenate(unions)
        which = np.repeat(np.arange(len(unions)), [len(u) for u in unions])
        order = np.argsort(tokens, kind="stable")
        self.which = which[order]
        self.tokens, self.first = np.unique(tokens[order], return_index=True)
        self.first = np.append(self.first, len(tokens))

    def qualifying(self, query: np.ndarray) -> np.ndarray:
        """Groups whose union holds 75 of 100 tokens of the query, and that have members of fitting size."""
        at = np.searchsorted(self.tokens, query)
        at[at == len(self.tokens)] = 0
        at = at[self.tokens[at] == query]
        times = self.first[at + 1] - self.first[at]
        places = np.repeat(self.first[at] - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum())
        overlap = np.bincount(self.which[places], minlength=len(self.groups))
        n = len(query)
        return np.flatnonzero((100 * overlap >= PERCENT * n) & (100 * self.longest >= PERCENT * n) & (PERCENT * self.shortest <= 100 * n))


def _opened(cell: pd.DataFrame) -> pd.DataFrame:
    """Components that are linked, as found by opening groups: the sets of one block of a cell against the other's, or
    against each other where both are the same."""
    row, col = int(cell["row"].iloc[0]), int(cell["col"].iloc[0])
    queries, members = cell[cell["part"] == row], cell[cell["part"] == col]
    edges: list[tuple[int, int]] = []
    if len(members) and len(queries):
        sets = [np.frombuffer(t, np.uint64) for t in members["tokens"]]
        ids, parts = members["set"].tolist(), members["component"].tolist()
        root: dict[int, int] = {}

        def find(x):
            while x in root:
                x = root[x]
            return x

        matrix = TokenGroupMatrix(sets)
        for q, component, tokens in zip(queries["set"].tolist(), queries["component"].tolist(), queries["tokens"]):
            query = np.frombuffer(tokens, np.uint64)
            for g in matrix.qualifying(query):
                for i in matrix.groups[g]:
                    if row == col and ids[i] >= q:
                        continue  # this pair is compared once, with the other one asking
                    mine, theirs = find(component), find(parts[i])
                    if mine != theirs and linked(query, sets[i]):
                        edges.append((component, parts[i]))
                        root[max(mine, theirs)] = min(mine, theirs)
    return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")


def _open_groups(shared: DataFrame, able: DataFrame, parts: DataFrame, tokens: DataFrame, block: int) -> DataFrame:
    """Edges between components: sets whose shared tokens reach into other components far enough, against the groups of
    these tokens.

    A set can link with another component only if enough of its tokens are in that component's union; the tokens that
    any other component holds are counted, and sets with too few of them are done. The rest form groups anew, and each
    group is worked on in cells of at most two blocks of sets: one block asks, the other is asked.
    """
    named = able.select("set").join(parts, "set", "left").withColumn("component", F.coalesce("component", "set"))
    own = shared.select("token", "set", "n").join(named, "set")
    mixed = own.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("token")
    own = keep(own.join(mixed, "token"), "ngram-mixed")
    for _ in range(2):  # sets that are done leave their tokens, which may settle others
        some = own.groupBy("set", "n").agg(F.count(F.lit(1)).alias("found")).where(f"found >= {NEEDED}").select("set")
        own = own.join(some, "set")
        mixed = own.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.min("set").alias("leader")).where("a < b")
        own = keep(own.join(mixed.select("token", "leader"), "token").select("token", "set", "n", "component", "leader"), "ngram-mixed")
        groups = own
        own = own.drop("leader")
    # Partners share NEEDED tokens of either. If each leaves its smallest groups, with less than half as many tokens
    # together, they still meet in one.
    groups = groups.groupBy("leader", "set", "component", "n").agg(F.count(F.lit(1)).alias("together"))
    upto = F.sum("together").over(Window.partitionBy("set").orderBy("together", "leader"))
    groups = keep(groups.withColumn("upto", upto).where(f"upto > floor(({NEEDED} - 1) / 2)").select("leader", "set", "component"), "ngram-open")
    sizes = groups.groupBy("leader").agg(F.count(F.lit(1)).alias("m"), F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
    own = groups.join(sizes.select("leader", "m"), "leader")
    blocks, spread = F.ceil(F.col("m") / block).cast("int"), F.xxhash64("set", F.lit(1))
    own = own.withColumns({"blocks": blocks, "part": F.pmod(spread, blocks).cast("int")})
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.withColumns({"row": F.least("part", "other"), "col": F.greatest("part", "other")})
    cells = own.select("leader", "row", "col", "part", "set", "component").join(tokens.select("set", "tokens"), "set")
    return cells.groupBy("leader", "row", "col").applyInPandas(_opened, "a long, b long")


def text_mark(text: str = "text") -> Column:
    """Tells rows with the same doc_id and different texts apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def classes(docs: DataFrame, block: int = BLOCK, salts: int = 64) -> DataFrame:
    """id, mark, n, component (a set of the class, null without shingles) and component_id of each row of ``docs``."""
    whole = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    marked = docs.select(F.struct(F.col("doc_id").alias("id"), text_mark().alias("mark")).alias("key"), whole)
    rows = docs.select(F.col("doc_id").alias("key"), whole)
    survey = keep(marked.mapInArrow(_survey(_grouped_texts), "id long, mark long, n long, set long, is_token boolean"), "ngram-survey")
    known = survey.where("not is_token").select("id", "mark", "n", "set")
    sets = keep(known.where("n > 0").groupBy("set").agg(F.max("n").alias("n"), F.min("id").alias("id")), "ngram-sets")
    least = max(16, (sets.agg(F.sum("n")).first()[0] or 0) // FREQUENT)
    often = survey.where("is_token").groupBy("set").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("set")
    frequent = np.sort(np.array([r[0] for r in often.collect()], dtype=np.int64).view(np.uint64))  # at most FREQUENT tokens, 1 MB

    report = rows.mapInArrow(_reporter(frequent), "token long, set long, n int")
    salt = F.when(F.col("token").bitwiseAND(1) == 1, F.pmod("set", F.lit(salts)))  # spreads the rows of frequent tokens
    ordered = report.repartition("token", salt).sortWithinPartitions("token")
    shared = keep(ordered.mapInArrow(_shared, "token long, set long, n long, leader long"), "ngram-shared")
    first = shared.where("leader is null").groupBy("token").agg(F.min("set").alias("first"))  # at most FREQUENT rows
    led = shared.join(F.broadcast(first), "token", "left").withColumn("leader", F.coalesce("leader", "first"))
    groups = keep(led.groupBy("set", "n", "leader").agg(F.count(F.lit(1)).alias("together")), "ngram-groups")
    able = keep(groups.groupBy("set", "n").agg(F.sum("together").alias("found")).where(f"found >= {NEEDED}"), "ngram-able")

    # each group elects the set with most of its tokens in common with any other: an original rather than its edited
    # copies. A set is compared with the head of fitting size that it shares most tokens with.
    voters = groups.join(able.select("set", "found"), "set")
    rank = F.struct(F.col("found") / F.col("n"), "together", "set")
    elected = voters.groupBy("leader").agg(F.max_by(F.struct("set", "n"), rank).alias("head")).select("leader", F.col("head.set").alias("head"), F.col("head.n").alias("m"))
    fits = F.lit(100) * F.least("n", "m") >= F.lit(PERCENT) * F.greatest("n", "m")
    led = voters.join(elected, "leader").where((F.col("set") != F.col("head")) & fits).groupBy("set", "head").agg(F.sum("together").alias("together"))
    best = keep(led.groupBy("set").agg(F.max_by("head", F.struct("together", "head")).alias("leader")), "ngram-best")
    heads = best.select(F.col("leader").alias("set")).distinct().withColumn("leads", F.lit(True))
    asked = able.select("set").join(sets, "set").join(best, "set", "left").join(heads, "set", "left")
    asked = asked.groupBy("id").agg(F.collect_list(F.struct("set", "leader", F.coalesce("leads", F.lit(False)).alias("leads"))).alias("asked"))
    found = rows.join(asked, F.col("key").eqNullSafe(F.col("id"))).select(F.col("asked").alias("key"), "text")
    tokens = keep(found.mapInArrow(_teller(_grouped_texts), "set long, tokens binary, leader long, leads boolean"), "ngram-tokens")
    theirs = tokens.where("leads").select(F.col("set").alias("leader"), F.col("tokens").alias("leader_tokens"))
    pairs = tokens.where("leader is not null").select("set", "tokens", "leader").join(theirs, "leader").select("set", "tokens", "leader", "leader_tokens")
    star = keep(pairs.mapInArrow(_with_leader, "a long, b long"), "ngram-star")
    parts = keep(components(star, "ngram-star").select(F.col("node").alias("set"), "component"), "ngram-parts")
    more = keep(_open_groups(shared, able, parts, tokens, block), "ngram-more")

    # the groups link whole components, so only these are put together; most often there are few
    merged = components(more, "ngram").select(F.col("node").alias("component"), F.col("component").alias("whole"))
    placed = sets.join(parts, "set", "left").withColumn("component", F.coalesce("component", "set"))
    placed = placed.join(merged, "component", "left").withColumn("component", F.coalesce("whole", "component")).drop("whole")
    names = placed.groupBy("component").agg(F.min("id").alias("component_id"))
    named = keep(placed.join(names, "component").select("set", "component", "component_id"), "ngram-named")
    some = known.where("n > 0").join(named, "set").select("id", "mark", "n", "component", "component_id")
    none = known.where("n = 0").select("id", "mark", "n", F.lit(None).cast("long").alias("component"), F.col("id").alias("component_id"))
    return some.union(none)


def near_duplicates(docs: DataFrame, block: int = BLOCK, salts: int = 64) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of ``docs`` (doc_id, text).

    A null text counts as empty; a text without words has no shingle and links with nothing, so its component is its own
    doc_id. Equal sets link. component_id is the smallest doc_id of the component; a null doc_id takes part and is named
    only if there is no other. Repeated rows have a row each. Other columns are not read.
    """
    return classes(docs, block, salts).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, block: int = BLOCK, salts: int = 64) -> DataFrame:
    """One row of each class of near-duplicates, with all its columns: the one with the smallest doc_id, and of several
    texts with this doc_id one. Rows without words all stay, but for copies with the same doc_id.
    Names that start with ``_near_`` are reserved."""
    none = F.lit(-(1 << 63))
    found = classes(docs, block, salts).withColumns({"_near_id": F.coalesce("id", none), "_near_least": F.coalesce("component_id", none)})
    chosen = found.where("component is not null and _near_id = _near_least").groupBy("component", "_near_id").agg(F.min("mark").alias("_near_mark")).select("_near_id", "_near_mark")
    chosen = keep(chosen.union(found.where("component is null").select("_near_id", F.col("mark").alias("_near_mark"))).distinct(), "ngram-chosen")
    rows = docs.withColumns({"_near_id": F.coalesce("doc_id", none), "_near_mark": text_mark()})
    return rows.join(chosen, ["_near_id", "_near_mark"], "left_semi").dropDuplicates(["_near_id", "_near_mark"]).select(*docs.columns)


def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """All documents."""
    return near_duplicates(table(spark, folder, "documents"))


QUERIES = {"op4_ngram_jaccard": op4_ngram_jaccard}
ORACLES: dict[str, str] = {}
