"""Embedding whitening: the leading eigenpairs of the covariance by Jacobi-Davidson.

The covariance is never formed.  The distinct vectors are written as blocks; a product with up to a few
vectors is one Spark job in which every task centres its blocks, multiplies, and returns one small
partial sum.  The driver holds vectors of the embedding's dimension only: the search space, the Ritz
vectors and the state of the inner MINRES runs, which solve the correction equations of all open
pairs in step, so that each inner iteration is one pass over the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import col, materialise

#: Partial sums that the driver adds itself; more are first added in tasks.
DRIVER_PARTS = 64
#: An eigenvalue below this share of the largest counts as zero.
NEGLIGIBLE = 1e-12

OUT_SCHEMA = "{id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Params:
    components: int = 4
    #: An entry c becomes floor(scale * c).
    scale: int = 256
    #: Pairs beyond the wanted ones in the search space: they keep the correction equations well-conditioned.
    guard: int = 4
    #: Inner MINRES steps for each correction.
    inner: int = 4
    #: Search directions before a restart from the leading Ritz vectors, in units of the pairs sought.
    width: int = 5
    #: Residual norm, relative to the largest eigenvalue, at which a pair is locked.
    tolerance: float = 1e-14
    #: Outer steps without a smaller residual before a pair at rounding level (1e-12) is accepted.
    patience: int = 3
    most_outer: int = 300
    block_rows: int = 4096
    seed: int = 0


@dataclass(frozen=True)
class Model:
    n: int
    dim: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float
    products: int = 0


def grid(df: DataFrame, params: Params, id_col: str, vec_col: str) -> DataFrame:
    """(id, x) of the rows whose vector is not null and holds finite numbers only; x in whole numbers."""
    v = col(vec_col)

    def finite(e):
        e = e.cast("double")
        return e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))

    x = F.transform(v, lambda e: F.floor(e.cast("double") * params.scale))
    return df.where(v.isNotNull() & F.forall(v, finite)).select(col(id_col).alias("vec_id"), x.alias("x"))


def _padded(rows: DataFrame, dim: int) -> DataFrame:
    return rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("x"))))


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _blocks(rows: DataFrame, dim: int, block_rows: int) -> DataFrame:
    """The rows as blocks: a binary of whole numbers in the narrowest type that holds them."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), dim)
            for lo in range(0, len(x), block_rows):
                part = x[lo : lo + block_rows]
                kind = np.result_type(np.min_scalar_type(int(part.min())), np.min_scalar_type(int(part.max())), np.int8)
                kind = kind if kind.kind == "i" else np.dtype(np.int64)
                yield pa.RecordBatch.from_pydict({"kind": [kind.str], "data": [part.astype(kind).tobytes()]})

    return rows.select("x").mapInArrow(pack, "kind string, data binary")


def _each_block(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data"), strict=True):
            yield np.frombuffer(data.as_buffer(), np.dtype(kind)).reshape(-1, dim)


class Fit:
    """The fit list as blocks, and sums over all of them."""

    def __init__(self, blocks: DataFrame, dim: int):
        self.blocks, self.dim, self.products = blocks, dim, 0
        self.n, self.sums, self.squares = self._moments()
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.zeros(dim)

    def _moments(self) -> tuple[int, list[int], int]:
        """Rows, exact sums and the exact sum of squares, as whole numbers of any size."""
        dim = self.dim

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, sums, squares = 0, [0] * dim, 0
            for x in _each_block(batches, dim):
                most = int(np.abs(x.astype(np.float64)).max(initial=0)) + 1
                x = x.astype(np.int64 if most * most * x.size < 1 << 62 else object)
                n += len(x)
                sums = [a + int(b) for a, b in zip(sums, x.sum(axis=0), strict=True)]
                squares += int((x * x).sum())
            yield pa.RecordBatch.from_pydict({"n": [n], "sums": [[str(s) for s in sums]], "squares": [str(squares)]})

        n, sums, squares = 0, [0] * dim, 0
        for row in self.blocks.mapInArrow(add, "n long, sums array<string>, squares string").toLocalIterator():
            n, squares = n + row["n"], squares + int(row["squares"])
            sums = [a + int(b) for a, b in zip(sums, row["sums"], strict=True)]
        return n, sums, squares

    @property
    def trace(self) -> float:
        return (self.n * self.squares - sum(s * s for s in self.sums)) / (self.n * self.n)

    def _sum(self, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """The sum of ``of(centred block)`` over all blocks; each task returns one partial sum."""
        dim, mean = self.dim, self.mean

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for x in _each_block(batches, dim):
                total += of(x - mean)
            yield pa.RecordBatch.from_pydict({"part": [total.tobytes()]})

        def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                for part in batch.column("part"):
                    total += np.frombuffer(part.as_buffer()).reshape(shape)
            yield pa.RecordBatch.from_pydict({"part": [total.tobytes()]})

        parts = self.blocks.mapInArrow(partial, "part binary")
        tasks = parts.rdd.getNumPartitions() if self.products == 0 else self.tasks
        self.tasks, self.products = tasks, self.products + 1
        if tasks > DRIVER_PARTS:
            parts = parts.repartition(isqrt(tasks)).mapInArrow(again, "part binary")
        return sum((np.frombuffer(r["part"]).reshape(shape) for r in parts.collect()), np.zeros(shape))

    def product(self, vectors: np.ndarray) -> np.ndarray:
        """The covariance times each column: one pass."""
        return self._sum(lambda x: x.T @ (x @ vectors), vectors.shape) / self.n

    def whitened_moments(self, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean and covariance of the centred rows times ``basis``: one pass."""
        k = basis.shape[1]

        def of(x: np.ndarray) -> np.ndarray:
            z = x @ basis
            return np.vstack([z.sum(axis=0), z.T @ z])

        total = self._sum(of, (k + 1, k)) / self.n
        return total[0], total[1:] - np.outer(total[0], total[0])


def _orthonormal(new: np.ndarray, *held: np.ndarray) -> np.ndarray:
    """Orthonormal columns spanning ``new`` outside the held orthonormal columns; dependent ones go."""
    out = np.empty((len(new), 0))
    for v in new.T:
        size = np.linalg.norm(v)
        for _ in range(3):
            for basis in (*held, out):
                v = v - basis @ (basis.T @ v)
        if size > 0 and np.linalg.norm(v) > 1e-10 * size:
            v = v / np.linalg.norm(v)
            for basis in (*held, out):
                v = v - basis @ (basis.T @ v)
            out = np.column_stack([out, v / np.linalg.norm(v)])
    return out


def minres(apply: Callable[[np.ndarray], np.ndarray], rhs: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of B_j t_j = rhs_j for all columns in step: ``apply`` multiplies column j by its
    own symmetric operator B_j.  Each step is one ``apply``; a column whose Krylov space is used up rests."""
    beta = np.linalg.norm(rhs, axis=0)
    live = beta > 0
    v_old, v = np.zeros_like(rhs), rhs / np.where(live, beta, 1.0)
    t, d_old, d_older = np.zeros_like(rhs), np.zeros_like(rhs), np.zeros_like(rhs)
    rest, k = beta.copy(), rhs.shape[1]
    c_old, s_old, c_older, s_older = np.ones(k), np.zeros(k), np.ones(k), np.zeros(k)
    beta = np.zeros(k)
    first = np.linalg.norm(rhs, axis=0)
    for _ in range(steps):
        if not live.any():
            break
        p = apply(v) - beta * v_old
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v
        after = np.linalg.norm(p, axis=0)
        # The tridiagonal column (beta, alpha, after) by the last two rotations and a new one.
        eps, high = s_older * beta, c_older * beta
        delta, low = c_old * high + s_old * alpha, -s_old * high + c_old * alpha
        size = np.hypot(low, after)
        live &= size > 1e-14 * first
        size = np.where(size > 0, size, 1.0)
        c, s = low / size, after / size
        d = (v - delta * d_old - eps * d_older) / size
        t = t + np.where(live, c * rest, 0.0) * d
        rest = np.where(live, -s * rest, rest)
        live &= after > 1e-14 * first
        v_old, v = v, p / np.where(after > 0, after, 1.0)
        beta, d_older, d_old = after, d_old, d
        c_older, s_older, c_old, s_old = c_old, s_old, c, s
    return t


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dim: int, params: Params) -> tuple[np.ndarray, np.ndarray]:
    """The ``components`` largest eigenvalues, falling, and their unit eigenvectors (columns).

    Outer steps: Rayleigh-Ritz in the search space, lock the pairs whose residual is at rounding
    level, solve the projected correction equations of the open pairs, and extend the space.
    """
    wanted = min(params.components, dim)
    sought = min(wanted + params.guard, dim)
    locked, values = np.empty((dim, 0)), np.empty(0)
    space = _orthonormal(np.random.default_rng(params.seed).standard_normal((dim, sought)))
    image = product(space)
    least, stuck, scale = np.inf, 0, 0.0
    for _ in range(params.most_outer):
        # Rayleigh-Ritz, largest first.
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        scale = max(scale, float(theta[0]) if len(theta) else 0.0, float(values.max(initial=0.0)))
        rest = image - space * theta
        norms = np.linalg.norm(rest, axis=0)
        lead = max(wanted - len(values), 1)  # with all locked: the next pair shows that none is missing
        now = float(norms[:lead].max(initial=0.0))
        stuck = 0 if now < least / 2 else stuck + 1
        least = min(least, now)
        level = params.tolerance if stuck < params.patience else 1e-12
        done = np.flatnonzero(norms[:lead] <= level * scale)
        if len(values) >= wanted and (not len(theta) or theta[0] <= np.sort(values)[-wanted] + 1e-12 * scale):
            break
        if len(done):
            new = _orthonormal(space[:, done], locked)
            locked, values = np.column_stack([locked, new]), np.append(values, theta[done][: new.shape[1]])
            space, image, theta, rest = (np.delete(a, done, axis=-1) for a in (space, image, theta, rest))
            least, stuck = np.inf, 0
            lead = max(wanted - len(values), 0)
            if locked.shape[1] + space.shape[1] >= dim and not space.shape[1]:
                break
        if locked.shape[1] + space.shape[1] >= dim:
            if not len(done) and stuck >= params.patience:  # the whole space is searched: these are the pairs
                values, locked = np.append(values, theta[:lead]), np.column_stack([locked, space[:, :lead]])
                break
            continue
        if space.shape[1] + sought > params.width * sought:  # restart
            keep = 2 * sought
            space, image, theta, rest = space[:, :keep], image[:, :keep], theta[:keep], rest[:, :keep]
        # Corrections of the open pairs (of the next one when all are locked), outside the leading Ritz vectors.
        k = max(min(lead, space.shape[1]), 1)
        front = np.column_stack([locked, space[:, : min(sought, space.shape[1])]])

        def outside(a: np.ndarray) -> np.ndarray:
            a = a - front @ (front.T @ a)
            return a - front @ (front.T @ a)

        shifts = theta[:k]
        step = minres(lambda a: outside(product(a) - a * shifts), -outside(rest[:, :k]), params.inner) if len(theta) else np.zeros((dim, 0))
        fresh = _orthonormal(step, locked, space)
        if not fresh.shape[1]:  # nothing new: a direction of the complement that is left
            fresh = _orthonormal(np.random.default_rng(params.seed + 1 + space.shape[1]).standard_normal((dim, 1)), locked, space)
        space, image = np.column_stack([space, fresh]), np.column_stack([image, product(fresh)])
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], locked[:, order]


def fit(df: DataFrame, params: Params = Params(), id_col: str = "vec_id", vec_col: str = "embedding") -> Model:
    """The model of the distinct vectors of ``df``: sums, trace, leading eigenpairs, identity error."""
    rows = grid(df, params, id_col, vec_col)
    dim = rows.agg(F.max(F.size("x")).alias("dim")).first()["dim"] or 0
    if not dim:
        return Model(0, 0, [], 0.0, np.empty(0), np.empty((0, 0)), 0.0)
    once = _padded(rows, dim).select("x").distinct()
    data = Fit(materialise(_blocks(once, dim, params.block_rows), "vectors"), dim)
    values, vectors = jacobi_davidson(data.product, dim, params)
    held = values > NEGLIGIBLE * max(values.max(initial=0.0), 0.0)
    values, vectors = values[held], vectors[:, held]
    top = np.abs(vectors).argmax(axis=0) if vectors.size else np.empty(0, int)
    vectors = vectors * np.sign(vectors[top, np.arange(len(values))])
    error = 0.0
    if len(values):
        _, spread = data.whitened_moments(vectors / np.sqrt(values))
        error = float(np.abs(spread - np.eye(len(values))).max())
    return Model(data.n, dim, data.sums, data.trace, values, vectors, error, data.products)


def transform(df: DataFrame, model: Model, params: Params = Params(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row for each usable row of ``df`` and component of ``model``; see ``whiten``."""
    kind = df.select(col(id_col)).dtypes[0][1]
    schema = OUT_SCHEMA.format(id=f"vec_id {kind}")
    n, dim, k = model.n, model.dim, len(model.values)
    rows = grid(df, params, id_col, vec_col)
    if not k:
        return df.sparkSession.createDataFrame([], schema)
    sums, biggest = model.sums, max(map(abs, model.sums))
    mean = np.array([s / n for s in sums])
    basis = model.vectors / np.sqrt(model.values)
    explained, error = (model.values / model.trace), model.identity_error

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = batch.column("vec_id"), _matrix(batch.column("x"), dim)
            most = n * (int(np.abs(x.astype(np.float64)).max(initial=0)) + 1) + biggest
            whole = x.astype(np.int64 if most * most * dim < 1 << 62 else object)
            apart = whole * n - np.array(sums, whole.dtype)
            deviation = [int(d) if d < 1 << 63 else None for d in (apart * apart).sum(axis=1)]
            at = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(at)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(at), n, np.int64)),
                    pa.array(deviation, pa.int64()).take(pa.array(at)),
                    pa.array(((x - mean) @ basis).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(at), error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return _padded(rows, dim).mapInArrow(project, schema)


def whiten(df: DataFrame, params: Params = Params(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable row.

    Rows whose vector is null or holds a null or non-finite entry are dropped.  The others, repeated
    rows and null ids included, give one row for each of the first ``components`` components, fewer where
    the dimension or the rank of the covariance is smaller (a single distinct vector gives no rows).
    Shorter vectors count as followed by zeros; entries beyond 64 bits stop there; a deviation beyond 64
    bits is null.  Components of equal eigenvalues are any unit vectors of their space, the same for all rows.
    Columns other than the two named are not read.  An empty table gives no rows.
    """
    return transform(df, fit(df, params, id_col, vec_col), params, id_col, vec_col)
