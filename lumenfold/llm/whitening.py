"""Whitening of embeddings: principal components by a blockwise QR and a one-sided Jacobi SVD, in double precision.

Entries become integers first, so that sums, means and distances from the mean are exact at any number of rows. The fit
takes every distinct vector once, from all rows. Blocks of centred rows are compressed to triangular factors (TSQR): each
task folds its rows into one R of d x d numbers, and the R of up to FAN tasks are stacked and factored again until one is
left, whatever the number of rows. Plane rotations then make R's columns orthogonal; the rotations multiplied together are
the components, the columns' lengths over sqrt(n) the standard deviations. No product of the data with itself is formed,
which would halve the digits of small deviations.

What reaches the driver has a fixed size: sums of d entries, one R, and the covariance of the whitened components.

A vector that is null or holds null or non-finite entries is dropped. All others must be of one dimension to have a
covariance: it is the most frequent one (of equally frequent ones the greatest), and vectors of other dimensions are dropped.
Vectors without entries, and components without variance (below 1e-12 of the largest deviation), give no rows. Entries of
2^46 and more count as 2^46. Repeated rows get equal results each, null ids too; an empty table gives an empty one; other
columns are not read, whatever their names. The distance from the mean is a decimal in fit results and a long in the digest,
where one that doesn't fit raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenfold.plans.shared import materialize

SCALE, SHIFT, TOP = 64, 1_000_000, 1 << 52
COMPONENTS = 16
#: Factors that one task stacks, at most, and bytes of them.
FAN, FAN_BYTES = 64, 1 << 27


@dataclass
class Whitener:
    """n vectors, exact sums without SHIFT, components as columns, standard deviations, shares of the variance."""

    n: int
    sums: list[int]
    components: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened values of integer vectors without SHIFT."""
        return (x - self.mean) @ self.components / self.deviations


def integers(df: DataFrame, keep: list[str], column: str = "embedding") -> DataFrame:
    """The kept columns and x, the scaled integer vectors without SHIFT, of the rows whose vector is whole."""
    finite = f"`{column}` is not null and forall(`{column}`, c -> c is not null and not isnan(c) and abs(cast(c as double)) < double('Infinity'))"
    x = f"transform(`{column}`, c -> cast(greatest(least(floor(cast(c as double) * {SCALE}D), {TOP}L), -{TOP}L) as bigint))"
    return df.where(finite).select(*keep, F.expr(x).alias("x"))


def matrix(b: pa.RecordBatch, d: int) -> np.ndarray:
    return b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def fold(r: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """R of the rows that r stands for and some more."""
    return np.linalg.qr(np.concatenate([r, rows]), mode="r")


def square(r: np.ndarray, d: int) -> np.ndarray:
    return np.concatenate([r, np.zeros((d - len(r), d))]) if len(r) < d else r


def totals(x: DataFrame, d: int) -> tuple[int, list[int], int]:
    """(rows, exact sum of each entry, partitions). High and low halves of the entries are summed apart as longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for b in batches:
            m = matrix(b, d)
            n, high, low = n + len(m), high + (m >> 24).sum(axis=0), low + (m & 0xFFFFFF).sum(axis=0)
        at = np.arange(-1, d)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(np.append(n, high)), pa.array(np.append(1, low))], ["i", "high", "low"])

    rows = x.mapInArrow(run, "i int, high long, low long").groupBy("i").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    by = {r["i"]: (int(r["high"]), int(r["low"])) for r in rows}
    n, parts = by.get(-1, (0, 0))
    return n, [(by.get(i, (0, 0))[0] << 24) + by.get(i, (0, 0))[1] for i in range(d)], parts


def triangle(x: DataFrame, mean: np.ndarray, parts: int) -> np.ndarray:
    """R of all centred rows: one a task, then of FAN tasks at a time."""
    import pandas as pd
    from pyspark import TaskContext

    d = len(mean)
    fan = max(2, min(FAN, FAN_BYTES // (8 * d * d)))
    schema = "id long, r binary"

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, seen = np.zeros((0, d)), False
        for b in batches:
            if b.num_rows:
                r, seen = fold(r, matrix(b, d) - mean), True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([square(r, d).tobytes()], pa.binary())], ["id", "r"])

    def merge(g: pd.DataFrame) -> pd.DataFrame:
        r = np.zeros((0, d))
        for one in g.sort_values(["id", "r"])["r"]:
            r = fold(r, np.frombuffer(one).reshape(d, d))
        return pd.DataFrame({"id": [int(g.id.iloc[0]) // fan], "r": [square(r, d).tobytes()]})

    out = x.mapInArrow(leaves, schema)
    while parts > fan:
        out = out.groupBy(F.expr(f"id div {fan}")).applyInPandas(merge, schema)
        parts = -(-parts // fan)
    out = out.groupBy().applyInPandas(merge, schema)
    return np.frombuffer(out.first()["r"]).reshape(d, d)


def jacobi(r: np.ndarray, sweeps: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, right singular vectors as columns) by falling value. Rotations of disjoint pairs of columns are
    done at once, in the order of a round-robin tournament, until a sweep finds all columns orthogonal."""
    d = r.shape[1]
    a, v = r.astype(float).copy(), np.eye(d)
    ring = np.arange(d + d % 2)
    eps = np.finfo(float).eps
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(ring) - 1):
            p, q = ring[: len(ring) // 2], ring[len(ring) // 2 :][::-1]
            real = (p < d) & (q < d)
            p, q = p[real], q[real]
            x, y = a[:, p], a[:, q]
            alpha, beta, gamma = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            size = np.sqrt(alpha * beta)
            angle = np.divide(np.abs(gamma), size, out=np.zeros_like(gamma), where=size > 0)
            worst = max(worst, float(angle.max(initial=0)))
            turn = angle > eps
            p, q, x, y = p[turn], q[turn], x[:, turn], y[:, turn]
            zeta = (beta - alpha)[turn] / (2 * gamma[turn])
            t = np.where(zeta >= 0, 1, -1) / (np.abs(zeta) + np.hypot(1, zeta))
            c = 1 / np.hypot(1, t)
            s = c * t
            a[:, p], a[:, q] = c * x - s * y, s * x + c * y
            vp, vq = v[:, p], v[:, q]
            v[:, p], v[:, q] = c * vp - s * vq, s * vp + c * vq
            ring[1:] = np.roll(ring[1:], 1)
        if worst < max(4.0, d**0.5) * eps:
            break
    sigma = np.sqrt((a * a).sum(axis=0))
    order = np.argsort(-sigma, kind="stable")
    return sigma[order], v[:, order]


def identity_error(x: DataFrame, w: Whitener) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, over all of them."""
    k, d = w.components.shape[1], len(w.sums)
    i, j = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, one = np.zeros((k, k)), np.zeros(k)
        for b in batches:
            z = w.project(matrix(b, d))
            both, one = both + z.T @ z, one + z.sum(axis=0)
        cols = (np.append(i, np.arange(k)), np.append(j, np.full(k, -1)), np.append(both[i, j], one))
        yield pa.RecordBatch.from_arrays([pa.array(cols[0].astype(np.int32)), pa.array(cols[1].astype(np.int32)), pa.array(cols[2])], ["i", "j", "s"])

    got = {(r["i"], r["j"]): r["s"] / w.n for r in x.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}
    return max(abs(got[a, b] - got[a, -1] * got[b, -1] - (a == b)) for a, b in zip(i.tolist(), j.tolist(), strict=True))


def dimension(x: DataFrame) -> int:
    sizes = x.groupBy(F.size("x").alias("d")).count().where("d > 0").orderBy(F.desc("count"), F.desc("d")).first()
    return sizes["d"] if sizes else 0


def fit(df: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitener | None:
    """The whitener of all distinct vectors; None where there are none. Distinct vectors are written once to the shared
    folder; three passes over them follow (sums, factors, check)."""
    whole = integers(df, [], column)
    d = dimension(whole)
    if not d:
        return None
    x = materialize(whole.where(F.size("x") == d).distinct(), "distinct_vectors")
    n, sums, parts = totals(x, d)
    mean = np.array([s / n for s in sums])
    sigma, v = jacobi(triangle(x, mean, parts))
    k = min(components, int((sigma > 1e-12 * sigma[0]).sum()))
    v = v[:, :k] * np.where(v[np.abs(v[:, :k]).argmax(axis=0), np.arange(k)] < 0, -1, 1)
    w = Whitener(n, sums, v, sigma[:k] / np.sqrt(n), sigma[:k] ** 2 / max((sigma**2).sum(), 1e-300))
    if k:
        w.identity_error = identity_error(x, w)
    return w


def exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over entries of (n x - sums)^2, exact at any size."""
    if max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums))) < 1 << 62:
        far = x * n - np.array(sums, np.int64)
        if int(np.abs(far).max(initial=0)) ** 2 * x.shape[1] < 1 << 62:
            return pa.array((far * far).sum(axis=1)).cast(pa.decimal128(38, 0))
    far = x.astype(object) * n - np.array(sums, object)
    return pa.array([Decimal(int(v)) for v in (far * far).sum(axis=1)], pa.decimal128(38, 0))


def whiten(df: DataFrame, w: Whitener | None, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained, identity_error: a row for every component of every row that
    has a whole vector. No shuffle."""
    kind = dict(df.dtypes)[id_col]
    schema = f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if w is None or not w.components.shape[1]:
        return df.sparkSession.createDataFrame([], schema)
    d, k = len(w.sums), w.components.shape[1]
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b, d)
            z, m = w.project(x), len(x)
            rows = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(rows), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n)), exact_deviation(x, w.n, w.sums).take(rows), pa.array(z.ravel()), pa.array(np.tile(w.explained, m)), pa.array(np.full(m * k, w.identity_error))],
                names,
            )

    whole = integers(df, [F.col(id_col).alias("id")], column)
    return whole.where(F.size("x") == d).mapInArrow(run, schema)


def digest(df: DataFrame) -> DataFrame:
    """vec_id, component, n, deviation (long), whitened, explained, identity_error of every row and component."""
    return whiten(df, fit(df)).withColumn("deviation", F.col("deviation").cast("long"))
