"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred vectors.

Each step multiplies the centred rows X by a block of vectors of their space (U = XV) and their transpose by the result
(XᵀU). Both products are made in one pass, as a row needs only its own entries of U. Vectors of U are as long as the table,
so they are never stored: each is X times a short vector y, and a row gives its entries again for the inner products by
which U is made orthonormal and reorthogonalised against all earlier blocks. The driver holds short vectors only. The
(block) bidiagonal matrix of the coefficients has the singular values of X, from which come the components and their
deviations. Blocks need fewer passes than single vectors, and find equal singular values.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import keep, table

#: Components that are returned, steps of a vector entry to one, and the seed of the first vector.
COMPONENTS, GRID, SEED = 4, 256, 13
#: Vectors of a block: with d entries to a vector there are d / BLOCK steps, of one pass each in most cases.
BLOCK = 8
#: A norm below this share of the greatest counts as 0: nothing is left in this direction.
NOTHING = 1e-11


def grid_vector(column: str = "embedding") -> Column:
    """floor(GRID * entry) as long, in double precision; null for a null vector or one with a null or non-finite entry.

    Entries beyond the range of a long are taken as its ends."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(F.col(column).isNotNull() & finite, F.transform(column, lambda x: F.floor(x.cast("double") * GRID)))


def summed(rows: DataFrame, size: int, add) -> np.ndarray:
    """The sum of ``add(x)``, ``size`` doubles for the vectors of a batch, over all rows: one short row for each task."""

    def part(batches):
        total = np.zeros(size)
        for batch in batches:
            total += add(_matrix(batch.column(0)))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["sums"])

    def whole(batches):
        total = np.zeros(size)
        for batch in batches:
            for part_ in batch.column(0).to_pylist():
                total += np.frombuffer(part_)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["sums"])

    parts = rows.select("x").mapInArrow(part, "sums binary")
    return np.frombuffer(parts.repartition(1).mapInArrow(whole, "sums binary").first()["sums"])


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy()
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def bidiagonalised(rows: DataFrame, mean: np.ndarray, seed: int = SEED, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, float]:
    """(singular values, right singular vectors in columns, sum of all squares) of the centred rows ``x``.

    The steps go on until the vectors span their space, so nothing is left out, whatever the spectrum. Where nothing is
    left in a direction the next vector is a random one, orthogonal to all before.
    """
    dims = len(mean)
    rng = np.random.default_rng([seed, dims])
    right, back, through = (np.zeros((dims, dims)) for _ in range(3))  # columns v, the y of each u, Xᵀu
    matrix, squares = np.zeros((dims, dims)), 0.0

    def orthonormal(found, done, width):
        """``width`` columns that are orthonormal, also to the first ``done`` v: those found, filled up with random ones."""
        axes, size, _ = np.linalg.svd(found, full_matrices=False)
        out = axes[:, size > NOTHING * np.sqrt(squares)]
        for scale in (None, *[1.0] * 3):
            if scale:
                out = np.hstack((out, rng.standard_normal((dims, width - out.shape[1]))))
            for _ in range(2):
                out, _ = np.linalg.qr(out - right[:, :done] @ (right[:, :done].T @ out))
            if out.shape[1] == width:
                return out
        raise ArithmeticError("no further direction")

    right[:, :block] = orthonormal(np.zeros((dims, 1)), 0, min(block, dims))
    for start in range(0, dims, block):
        now, before = slice(start, min(start + block, dims)), slice(0, start)
        earlier, passed = back[:, before].copy(), through[:, before]
        y = right[:, now] - earlier @ matrix[before, now]
        upper = np.eye(y.shape[1])  # the block of XV is U times this
        for again in range(4):

            def add(x, y=y):
                x = x - mean
                u = x @ y
                return np.concatenate(((x.T @ u).ravel(), ((x @ earlier).T @ u).ravel(), (u.T @ u).ravel(), [np.einsum("ij,ij", x, x)]))

            width = y.shape[1]
            cuts = np.cumsum([dims * width, start * width, width * width])
            product, inner, gram, squares = np.split(summed(rows, int(cuts[-1]) + 1, add), cuts)
            product, inner, gram, squares = product.reshape(dims, width), inner.reshape(start, width), gram.reshape(width, width), float(squares[0])
            y, product, rest = y - earlier @ inner, product - passed @ inner, gram - inner.T @ inner
            value, turn = np.linalg.eigh(rest)
            root = np.sqrt(np.maximum(value, 0))
            live = root > (1e-3 if again else NOTHING * np.sqrt(squares))
            root, turn = root[live], turn[:, live]
            y, product, upper = y @ turn / root, product @ turn / root, (root[:, None] * turn.T) @ upper
            if not len(root) or np.linalg.norm(inner) <= 1e-9 * np.sqrt(np.trace(gram)) and root[0] > 1e-3 * root[-1]:
                break  # else once more: so much was taken off that the rest has to be made orthogonal again
        width = len(root)
        at = slice(start, start + width)
        matrix[at, now], back[:, at], through[:, at] = upper, y, product
        if now.stop == dims:
            break
        after = slice(now.stop, min(now.stop + block, dims))
        left = through[:, now] - right[:, now] @ matrix[now, now].T
        for _ in range(2):
            left -= right[:, : now.stop] @ (right[:, : now.stop].T @ left)
        right[:, after] = orthonormal(left, now.stop, after.stop - after.start)
        matrix[now, after] = left.T @ right[:, after]
    _, values, turned = np.linalg.svd(matrix)
    return values, right @ turned.T, squares


_RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(n x - sums as double, the sum of its squares) of each row, exact; null for a sum beyond the range of a long."""
    most = int(np.abs(x).max(initial=0)) if x.size and x.min() > np.iinfo(np.int64).min else 1 << 63
    bound = most * n + max(map(abs, sums), default=0)
    if bound * bound * max(1, len(sums)) < 1 << 63:
        moved = x * n - np.array(sums, dtype=np.int64)
        return moved.astype(np.float64), pa.array((moved * moved).sum(axis=1))
    moved = x.astype(object) * n - np.array(sums, dtype=object)
    found = [int(d) for d in (moved * moved).sum(axis=1)]
    return moved.astype(np.float64), pa.array([d if d < 1 << 63 else None for d in found], pa.int64())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of each row of ``vectors`` (vec_id, embedding)
    and each of the first ``components``.

    Rows whose vector is null or holds a null or non-finite entry are dropped; repeated rows stay, but count once in the
    fit. Vectors of different lengths are whitened apart, each length by its own vectors. A component whose deviation
    vanishes has no row: none has for equal vectors or ones without entries, and ties of eigenvalues may be turned in any way. A null vec_id
    stays null. Other columns are not read. A deviation that does not fit into 64 bits is null.
    """
    kind = dict(vectors.dtypes)["vec_id"]
    own = vectors.select("vec_id", grid_vector().alias("x")).where("x is not null").withColumn("dims", F.size("x"))
    fit = keep(own.select("dims", "x").distinct(), "whitening-fit")
    sizes = {r["dims"]: r["n"] for r in fit.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = own.sparkSession.createDataFrame([], f"vec_id {kind}, {_RESULT}")
    for dims in sorted(d for d in sizes if d):
        out = out.union(_whitened(own.where(F.col("dims") == dims), fit.where(F.col("dims") == dims), dims, sizes[dims], components, kind))
    return out


def _whitened(own: DataFrame, fit: DataFrame, dims: int, n: int, components: int, kind: str) -> DataFrame:
    places = fit.select(F.posexplode("x").alias("place", "value")).groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total"))
    sums = [int(r["total"]) for r in places.orderBy("place").collect()]
    mean = np.array([s / n for s in sums])
    values, axes, squares = bidiagonalised(fit, mean)
    found = int((values > 1e-9 * values[0]).sum()) if values[0] > 0 else 0
    found = min(found, components)
    eigen, axes = values[:found] ** 2 / n, np.ascontiguousarray(axes[:, :found])
    shares = (values[:found] ** 2 / squares).tolist()

    def place(x):
        moved, deviations = _deviations(x, n, sums)
        return (moved / n) @ axes / np.sqrt(eigen), deviations

    def moments(x):
        white, _ = place(x)
        return np.concatenate((white.sum(axis=0), (white.T @ white).ravel()))

    error = 0.0
    if found:
        got = summed(fit, found + found * found, moments) / n
        error = float(np.abs(got[found:].reshape(found, found) - np.outer(got[:found], got[:found]) - np.eye(found)).max())

    def rows(batches):
        names = ["vec_id", *(c.split(" ")[0] for c in _RESULT.split(", "))]
        for batch in batches:
            white, deviations = place(_matrix(batch.column(1)))
            at = pa.array(np.repeat(np.arange(len(white)), found))
            m = len(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), len(white))), pa.array(np.full(m, n)), deviations.take(at),
                 pa.array(white.ravel()), pa.array(shares * len(white), pa.float64()), pa.array(np.full(m, error))], names=names)

    return own.select("vec_id", "x").mapInArrow(rows, f"vec_id {kind}, {_RESULT}")


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """All embeddings on their first components."""
    return whiten(table(spark, folder, "embeddings"))


QUERIES = {"op13_whitening": op13_whitening}
ORACLES: dict[str, str] = {}
