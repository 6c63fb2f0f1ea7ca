"""Near-duplicate embeddings by spherical-cap filters with structured random product codes."""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import components, keep, table

THRESHOLD = 0.93
#: Independent rotations, each with its own codes; codes of each half of a vector. A filter is a rotation and a pair of
#: codes, so there are TABLES * CODES * CODES filters.
TABLES, CODES = 8, 32
#: Filters that a vector exceeds on average. In a simulation with random pairs of 64 dimensions at cosine 0.93, 99 of 100
#: pairs share one; one rotation with as many filters gives 92, as its sums depend on each other.
FILTERS = 24
SEED = 11
#: Vectors on one side of a product, and filters of at most one block that a task takes at a time.
BLOCK, TOGETHER = 1024, 64


def codes(dims: int, table: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """A random rotation and the codes of both halves: (dims, dims) and (dims, 2 * CODES)."""
    rng = np.random.default_rng([seed, dims, table])
    rotation, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
    half = (dims + 1) // 2
    book = np.zeros((dims, 2 * CODES))
    book[:half, :CODES] = rng.standard_normal((half, CODES))
    book[half:, CODES:] = rng.standard_normal((dims - half, CODES))
    return rotation, book


def list_decode(units: np.ndarray, dims: int, wanted: float = FILTERS, seed: int = SEED) -> list[np.ndarray]:
    """The filters whose direction each unit vector exceeds, in ascending order; the best of the first rotation if it
    exceeds none.

    The sum over both halves is a standard normal value for each filter, which gives the threshold. A code of the first
    half is paired only for vectors that the best code of the second half can lift over the threshold.
    """
    least = NormalDist().inv_cdf(1 - wanted / (TABLES * CODES**2))
    who, what, top = [], [], None
    for number in range(TABLES):
        rotation, book = codes(dims, number, seed)
        scores = units @ rotation @ book
        left, right = scores[:, :CODES], scores[:, CODES:]
        best = right.max(axis=1)
        top = left.argmax(axis=1) * CODES + right.argmax(axis=1) if top is None else top
        for code in range(CODES):
            rows = np.flatnonzero(left[:, code] + best >= least)
            hit, other = np.nonzero(right[rows] >= least - left[rows, code][:, None])
            who.append(rows[hit])
            what.append((number * CODES + code) * CODES + other)
    who, what = np.concatenate(who), np.concatenate(what)
    order = np.lexsort((what, who))
    found = np.split(what[order], np.searchsorted(who[order], np.arange(1, len(units))))
    return [f if len(f) else top[i : i + 1] for i, f in enumerate(found)]


def _units(values: pd.Series, dtype: str, dims: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(values), dtype=dtype).reshape(len(values), dims).astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow in the norm
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def valid_vector(column: str) -> Column:
    """Not null, not zero, and made of finite numbers only."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(column) > 0) & finite & F.exists(column, lambda x: x != 0), F.lit(False))


def _filtered(vectors: DataFrame, dtype: str, wanted: float) -> DataFrame:
    """One row for each vector and filter that it exceeds, with all of the vector's filters."""

    def work(batches):
        for batch in batches:
            out = []
            for dims, rows in batch.groupby("dims"):
                held = np.array([np.asarray(v, dtype=dtype).tobytes() for v in rows["v"]], dtype=object)
                lists = list_decode(_units(held, dtype, dims), dims, wanted)
                at = np.repeat(np.arange(len(rows)), [len(f) for f in lists])
                frame = rows[["node", "label", "dims", "copies"]].iloc[at].copy()
                frame["filter"] = np.concatenate(lists).astype(np.int32)
                frame["v"] = held[at]
                frame["filters"] = np.array([f.astype(np.int32).tobytes() for f in lists], dtype=object)[at]
                out.append(frame)
            if out:
                yield pd.concat(out)

    kind = dict(vectors.dtypes)["label"]
    return vectors.mapInPandas(work, f"node long, label {kind}, dims int, copies long, filter int, v binary, filters binary")


def _smaller_shared(lists: list[np.ndarray], this: int) -> np.ndarray:
    """Which pairs share a filter below ``this``."""
    smaller = [f[f < this] for f in lists]
    names, at = np.unique(np.concatenate(smaller), return_inverse=True)
    holds = np.zeros((len(lists), max(1, len(names))), np.float32)
    holds[np.repeat(np.arange(len(lists)), [len(f) for f in smaller]), at] = 1
    return holds @ holds.T > 0


def _verified(dtype: str, threshold: float):
    def cell(units, node, copies, block, filters, number, mixed):
        """(node, links, root) of one cell: pairs whose smallest shared filter is this one, so that each pair counts once."""
        linked = units @ units.T >= threshold
        if mixed:
            linked &= block[:, None] != block[None, :]
        np.fill_diagonal(linked, False)
        if not linked.any():
            return None
        linked &= ~_smaller_shared([np.frombuffer(f, np.int32) for f in filters], number)
        rows = np.flatnonzero(linked.any(axis=1))
        if not len(rows):
            return None
        links = linked[rows].astype(np.float64) @ copies
        label, near = rows.copy(), linked[np.ix_(rows, rows)]
        while True:
            least = np.minimum(label, np.where(near, label[None, :], len(node)).min(axis=1))
            if (least == label).all():
                return node[rows], links.astype(np.int64), node[label]
            # a row takes the label of the row that its label stands for
            label = least[np.searchsorted(rows, least)]

    def work(cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values(["filter", "node"]).drop_duplicates(["filter", "node"])
        units = _units(cells["v"], dtype, int(cells["dims"].iloc[0]))
        node, copies, block = (cells[c].to_numpy() for c in ("node", "copies", "block"))
        numbers, filters = cells["filter"].to_numpy(), cells["filters"].to_numpy()
        mixed = bool(cells["row"].iloc[0] != cells["col"].iloc[0])
        cuts = np.append(np.flatnonzero(np.concatenate(([True], numbers[1:] != numbers[:-1]))), len(numbers))
        found = [cell(units[a:b], node[a:b], copies[a:b].astype(np.float64), block[a:b], filters[a:b], int(numbers[a]), mixed) for a, b in zip(cuts[:-1], cuts[1:])]
        found = [f for f in found if f]
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 3
        return pd.DataFrame(dict(zip(("node", "links", "root"), columns)))

    return work


def near_links(vectors: DataFrame, dtype: str, threshold: float = THRESHOLD, wanted: float = FILTERS, block: int = BLOCK) -> DataFrame:
    """Partial results (node, links, root) whose sums and unions give the links of all vectors (node, label, dims, v, copies).

    A filter that holds many vectors is cut into blocks, and each pair of blocks is a task of its own with at most two
    blocks of vectors; nothing is capped.
    """
    rows = keep(_filtered(vectors, dtype, wanted), "cap-filters")
    sizes = rows.groupBy("label", "dims", "filter").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(sizes, ["label", "dims", "filter"])
    blocks = F.ceil(F.col("n") / block).cast("int")
    rows = rows.withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("node"), blocks).cast("int")})
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({"row": F.least("block", "other"), "col": F.greatest("block", "other")})
    # small filters are handed over several at a time
    several = F.when(F.col("blocks") == 1, -1 - F.floor(F.col("filter") / TOGETHER)).otherwise(F.col("filter"))
    cells = rows.withColumn("hand", several).select("node", "label", "dims", "copies", "hand", "filter", "v", "filters", "block", "row", "col")
    return cells.groupBy("label", "dims", "hand", "row", "col").applyInPandas(_verified(dtype, threshold), "node long, links long, root long")


def near_duplicates(table_: DataFrame, threshold: float = THRESHOLD, wanted: float = FILTERS, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of (vec_id, embedding, label).

    Rows are compared only when their labels are equal and not null and their lengths are equal. Null or zero vectors and
    those with a null or non-finite component link with nothing. Equal vectors are one node that counts as often as it
    occurs, and link with each other. component_id is the smallest vec_id of a component (a null id never is, unless the
    component has no other); kept tells whether it is the row's own. Other columns are not read.
    """
    kind = dict(table_.dtypes)["embedding"]
    dtype = "<f4" if kind == "array<float>" else "<f8"
    # the key is empty for rows that link with nothing; zeros of both signs are made one
    own = table_.select("vec_id", "label", F.when(valid_vector("embedding") & F.col("label").isNotNull(), F.transform("embedding", lambda x: x + F.lit(0).cast(kind[6:-1]))).alias("v"))
    unique = own.where("v is not null").groupBy("label", "v").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    unique = keep(unique.withColumns({"node": F.monotonically_increasing_id(), "dims": F.size("v")}), "vectors")
    partial = keep(near_links(unique, dtype, threshold, wanted, block), "cap-links")
    links = partial.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(partial.select(F.col("node").alias("a"), F.col("root").alias("b")), "caps")
    nodes = unique.select("label", "v", "copies", "least", "node").join(links, "node", "left").join(groups, "node", "left")
    nodes = keep(nodes.withColumn("component", F.coalesce("component", "node")), "cap-nodes")
    smallest = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    nodes = nodes.join(smallest, "component").select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = own.where("v is not null").join(nodes, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = own.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op8_cap_filters(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings against all others of their label."""
    return near_duplicates(table(spark, folder, "embeddings"))


QUERIES = {"op8_cap_filters": op8_cap_filters}
ORACLES: dict[str, str] = {}
