"""Whitening of embeddings by their leading components, found by Golub-Kahan-Lanczos bidiagonalisation."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapwise.llm.scratch import stored
from tapwise.llm.top_k import sound

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
# Entries beyond this are no whole numbers that a long holds exactly after all that is done with them.
LARGEST = 2.0**62
# A triplet has settled when its residual is this part of the largest singular value.
SETTLED = 1e-14
SEED = 13
BLOCK_ENTRIES = 1 << 19

SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whole_vectors(vectors: DataFrame, id_column: str, vector: str, scale: int, offset: int) -> DataFrame:
    """`vec_id` and `x`, the entries as whole numbers: floor(scale * c) + offset."""
    scaled = F.transform(vector, lambda c: c.cast("double") * scale)
    rows = vectors.where(sound(vector)).select(F.col(id_column).cast("long").alias("vec_id"), scaled.alias("y"))
    held = rows.where(F.forall("y", lambda y: F.abs(y) < LARGEST))
    return held.select("vec_id", F.transform("y", lambda y: F.floor(y) + offset).alias("x"))


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows, some at once, with their entries as a matrix of whole numbers."""
    step = max(1, BLOCK_ENTRIES // d)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _exact_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of rows, and the sums of their entries."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for _, x in _blocks(batches, d):
            high, low = x >> 32, x & 0xFFFFFFFF
            total = [t + (int(h) << 32) + int(l) for t, h, l in zip(total, high.sum(axis=0), low.sum(axis=0))]
            n += len(x)
        values = pa.array([Decimal(t) for t in (n, *total)], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 1), pa.int32()), values], names=["at", "value"])

    sums = rows.select("x").mapInArrow(add, "at int, value decimal(38,0)").groupBy("at").agg(F.sum("value").alias("value"))
    found = {r.at: int(r.value) for r in sums.collect()}
    return found.get(0, 0), [found.get(i + 1, 0) for i in range(d)]


@dataclass(frozen=True)
class Centre:
    """n rows with sums S. Each mean is a whole number and the rest / n, so that centring loses no digits."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, n: int, sums: list[int]) -> Centre:
        split = [divmod(s, n) for s in sums]
        return cls(n, np.array([q for q, _ in split], np.int64), np.array([r for _, r in split], np.int64))

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sum over all entries of (n * x - S) ** 2, exact; what is beyond a long counts as its end."""
        off = x - self.whole
        most = self.n * (int(np.abs(off).max(initial=0)) + 1)
        if most * most * x.shape[1] < 2**63:
            return ((off * self.n - self.rest) ** 2).sum(axis=1).tolist()
        exact = off.astype(object) * self.n - self.rest.astype(object)
        return [min(int(s), 2**63 - 1) for s in (exact * exact).sum(axis=1)]


def _sums(rows: DataFrame, centre: Centre, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """`of` blocks of centred rows, summed over all: within tasks, then between them by number of the entry."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _blocks(batches, len(centre.whole)):
            found = of(centre.centred(x))
            total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "value"])

    sums = rows.select("x").mapInArrow(add, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    return np.array([r.value for r in sorted(sums.collect())])


class Bidiagonal:
    """X V = U B, with V and U orthonormal and B upper bidiagonal, one column more at each step.

    X is distributed by rows and never leaves the executors. U has as many rows, so only W is kept,
    with U = X W; V and W are as large as X has columns. One sweep over the rows yields t = X w, the next column of U
    before it is orthogonal to the others, with U't for that and X't for the next column of V; both are linear in t.
    """

    def __init__(self, sweep: Callable[[np.ndarray, np.ndarray], tuple[float, np.ndarray, np.ndarray]], d: int):
        self.sweep, self.d = sweep, d
        self.rng = np.random.default_rng(SEED)
        self.v, self.w, self.z = np.empty((d, 0)), np.empty((d, 0)), np.empty((d, 0))
        self.alpha, self.beta = [], []
        # Where the vectors begin that come from the last new start.
        self.start = 0
        self.largest = 0.0
        self.next = self._new_direction()

    def _orthogonal(self, v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - self.v @ (self.v.T @ v)
        return v

    def _new_direction(self) -> np.ndarray | None:
        """At random, of those orthogonal to all so far; None if there is none."""
        if self.v.shape[1] >= self.d:
            return None
        v = self._orthogonal(self.rng.standard_normal(self.d))
        return v / np.linalg.norm(v)

    def restart(self) -> None:
        """What follows is found from a new direction, so that equal singular values are all found."""
        self.beta[-1] = 0.0
        self.start = len(self.alpha)
        self.next = self._new_direction()

    def step(self) -> None:
        """One more column of V, U and B."""
        v, k = self.next, len(self.alpha)
        linked = k > self.start
        w = v - self.beta[-1] * self.w[:, -1] if linked else v
        for _ in range(3):
            square, h, z = self.sweep(w, self.w)
            w, z = w - self.w @ h, z - self.z @ h
            left = square - h @ h
            # What was taken off is no rounding: the rest must be made orthogonal once more.
            if left > 0.25 * square:
                break
        alpha = float(np.sqrt(max(left, 0.0)))
        self.largest = max(self.largest, alpha, *self.beta[-1:])
        self.v = np.column_stack([self.v, v])
        if alpha <= 1e-13 * self.largest or alpha == 0:
            alpha, w, z = 0.0, np.zeros(self.d), np.zeros(self.d)
        else:
            w, z = w / alpha, z / alpha
        self.w, self.z = np.column_stack([self.w, w]), np.column_stack([self.z, z])
        self.alpha.append(alpha)
        following = self._orthogonal(z - alpha * v)
        beta = float(np.linalg.norm(following))
        if self.v.shape[1] >= self.d or beta <= 1e-13 * self.largest or beta == 0:
            self.beta.append(0.0)
            self.start = k + 1
            self.next = self._new_direction()
        else:
            self.beta.append(beta)
            self.next = following / beta

    def triplets(self, first: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Singular values of B from its column `first` on, right vectors, and residuals."""
        size = len(self.alpha) - first
        b = np.diag(self.alpha[first:]) + np.diag(self.beta[first:-1], 1)[:size, :size]
        left, values, right = np.linalg.svd(b)
        return values, self.v[:, first:] @ right.T, self.beta[-1] * np.abs(left[-1])


def leading_components(
    sweep: Callable[[np.ndarray, np.ndarray], tuple[float, np.ndarray, np.ndarray]], d: int, wanted: int, every: int = 8
) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest singular values of X, and its right singular vectors as columns.

    Steps are taken until these have settled, and until a new start at random finds nothing larger
    than the least of them; or until V spans everything, after which nothing is left out.
    """
    found = Bidiagonal(sweep, d)
    while found.next is not None:
        found.step()
        k = len(found.alpha)
        if k % every or k < wanted or found.next is None:
            continue
        values, _, residuals = found.triplets()
        if np.any(residuals[:wanted] > SETTLED * values[0]):
            continue
        if found.start in (0, k):
            if found.start == 0:
                found.restart()
            continue
        others, _, loose = found.triplets(found.start)
        if loose[0] <= 1e-6 * others[0]:
            if others[0] < values[wanted - 1] * (1 - 1e-6):
                break
            found.restart()
    values, vectors, _ = found.triplets()
    values, vectors = values[:wanted], vectors[:, :wanted]
    real = values > 1e-12 * values[0]
    vectors = vectors[:, real]
    # One of the two signs, the same in every run.
    vectors = vectors * np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])])
    return values[real], vectors


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Each vector along the leading components of all of them, scaled to variance 1: SCHEMA.

    Entries c become whole numbers x = floor(scale * c) + offset. The components are the right singular vectors of
    the centred rows, the variances the squares of the singular values over the number of rows n. Per row and
    component (from 1): n, `deviation`, the exact sum of (n * x - sum of x) ** 2 over all entries (what is beyond a long
    counts as its end), `whitened`, the component's share of the variance, and the largest entry by which the
    whitened rows' covariance differs from the identity. Only sums as long as a vector, or the number of steps,
    come to the driver, and only matrices of that size go out; every sweep reads the rows where they are stored.

    Vectors that are null, empty, or hold null, NaN, infinite or hardly representable entries (2 ** 62 and more) drop
    out, and so do those of another length than the most frequent one (of equally frequent ones the longest).
    Repeated rows count each; a null id stays null. Components of no variance do not exist: where all
    vectors are equal, or there are none, there are no rows. Of equal variances any directions may be found. Other
    columns are not used.
    """
    rows = stored(whole_vectors(vectors, id_column, vector, scale, offset))
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return rows.sparkSession.createDataFrame([], SCHEMA)
    d = lengths.d
    rows = rows.where(F.size("x") == d)
    centre = Centre.of(*_exact_sums(rows, d))

    def sweep(w: np.ndarray, known: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def products(x: np.ndarray) -> np.ndarray:
            t = x @ w
            return np.concatenate([[t @ t], (x @ known).T @ t, x.T @ t])

        found = _sums(rows, centre, products)
        return found[0], found[1 : 1 + known.shape[1]], found[1 + known.shape[1] :]

    trace = _sums(rows, centre, lambda x: np.array([(x * x).sum()]))[0] / centre.n
    if not trace:
        return rows.sparkSession.createDataFrame([], SCHEMA)
    values, directions = leading_components(sweep, d, min(components, d))
    variances = values**2 / centre.n
    k, to_white = len(values), directions / np.sqrt(variances)

    def moments(x: np.ndarray) -> np.ndarray:
        white = x @ to_white
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    found = _sums(rows, centre, moments) / centre.n
    covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
    error = float(np.abs(covariance - np.eye(k)).max())
    explained = variances / trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in SCHEMA.split(", ")]
        for part, x in _blocks(batches, d):
            m = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, centre.n, np.int64)),
                    pa.array(np.repeat(np.array(centre.deviations(x), np.int64), k)),
                    pa.array((centre.centred(x) @ to_white).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                names=names,
            )

    return rows.mapInArrow(project, SCHEMA)
