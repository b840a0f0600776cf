"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

X has a centred vector in each row.  A step multiplies by X and by its transpose:

    p = X v_j - beta u_(j-1),   alpha = |p|,   u_j = p / alpha
    z = X' u_j - alpha v_j,     beta = |z|,    v_(j+1) = z / beta

and both sides are made orthogonal to all earlier vectors.  The small upper triangular
matrix T = U' X V (bidiagonal but for rounding and restarts) has the singular values of X;
its right singular vectors, carried back by V, are the components.

The rows of u stay in the tasks.  Every u_j is X w_j for a vector w_j of as many numbers
as there are dimensions, so a task makes the entries of all u for its own rows, and one
pass over the vectors gives |p|^2, U'p and X'p together.  The part of p along earlier u
(of the size of rounding errors) is then taken out of the sums.  A step is one pass whose
tasks return a few hundred numbers each, added up by Spark.

Steps end when the residual of every wanted triple, taken against its distance from the
neighbouring singular values, is at the level of rounding.  A vector that the start
misses, as with equal singular values, would not show in a residual: unless the variance
not yet covered is too small for one, ``CHECK_STEPS`` more steps then follow from a new
vector orthogonal to all.  After as many steps as dimensions everything is covered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelframe.functions.checkpoints import materialize
from labelframe.llm.batches import bounded

COMPONENTS = 8
CHECK_STEPS = 8
CLOSE = 1e-12
ROUNDING = 1e-14
RANK = 1e-10
LONG = 2**63 - 1


def grid(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, x) of the rows with a whole vector of finite numbers; x = floor(1024 c) + 100000 of each entry c."""
    own = df.select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("c"))
    finite = own.where(F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    return finite.select("id", F.transform("c", lambda v: F.floor(v * 1024).cast("long") + 100000).alias("x"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def totals(vectors: DataFrame, dims: int, width: int, measure: Callable[[np.ndarray], np.ndarray], kind: str = "double") -> np.ndarray:
    """The sum over all rows of what ``measure`` gives for each matrix of rows, ``width`` numbers."""
    dtype = {"double": np.float64, "long": np.int64}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype)
        for batch in batches:
            if batch.num_rows:
                total += measure(matrix(batch.column(0), dims))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(total)], names=["place", "value"])

    found = vectors.select("x").mapInArrow(run, f"place int, value {kind}").groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros(width, dtype)
    for place, value in found.collect():
        out[place] = value
    return out


def centred(n: int, sums: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """x - S / n with an exact numerator."""
    return lambda x: (n * x - sums) / n


def orthogonal_to(basis: np.ndarray, v: np.ndarray) -> np.ndarray:
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


class Bidiagonal:
    """V, W, G = X'U and T after some steps; X V = U T and U = X W."""

    def __init__(self, dims: int, seed: int) -> None:
        self.dims, self.rng = dims, np.random.default_rng(seed)
        self.v, self.w, self.g = (np.zeros((dims, 0)) for _ in range(3))
        self.t = np.zeros((0, 0))
        self.norm2 = 0.0
        self.since_restart = 0
        self.restart()

    @property
    def steps(self) -> int:
        return self.v.shape[1]

    def restart(self) -> None:
        """Go on from a random vector orthogonal to all so far."""
        v = orthogonal_to(self.v, self.rng.standard_normal(self.dims))
        self.next, self.beta, self.since_restart = v / np.linalg.norm(v), 0.0, 0

    def direction(self) -> np.ndarray:
        """w of X v_j - beta u_(j-1)."""
        return self.next - (self.beta * self.w[:, -1] if self.beta else 0.0)

    def measure(self, centre: Callable[[np.ndarray], np.ndarray]) -> Callable[[np.ndarray], np.ndarray]:
        """|X|^2, |p|^2, U'p and X'p of some rows."""
        columns = np.column_stack([self.w, self.direction()])

        def run(x: np.ndarray) -> np.ndarray:
            rows = centre(x)
            u = rows @ columns
            p = u[:, -1]
            return np.concatenate([[np.einsum("ij,ij->", rows, rows), p @ p], u[:, :-1].T @ p, rows.T @ p])

        return run

    def advance(self, sums: np.ndarray) -> None:
        j = self.steps
        self.norm2, pp, r, q = sums[0], sums[1], sums[2 : 2 + j], sums[2 + j :]
        alpha = np.sqrt(max(pp - r @ r, 0.0))
        if alpha <= 1e-13 * np.sqrt(self.norm2):
            alpha, w, g = 0.0, np.zeros(self.dims), np.zeros(self.dims)
        else:
            w, g = (self.direction() - self.w @ r) / alpha, (q - self.g @ r) / alpha
        column = np.append(r, alpha)
        if self.beta:
            column[j - 1] += self.beta
        grown = np.zeros((j + 1, j + 1))
        grown[:j, :j], grown[:, j] = self.t, column
        self.t, self.v = grown, np.column_stack([self.v, self.next])
        self.w, self.g = np.column_stack([self.w, w]), np.column_stack([self.g, g])
        self.since_restart += 1
        z = orthogonal_to(self.v, g)
        self.beta = float(np.linalg.norm(z))
        if self.beta > 1e-13 * np.sqrt(self.norm2):
            self.next = z / self.beta
        elif self.steps < self.dims:
            since = self.since_restart
            self.restart()
            self.since_restart = since

    def singular(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Singular values, right vectors, and the residuals of the triples."""
        p, s, q = np.linalg.svd(self.t)
        right = self.v @ q.T
        return s, right, np.linalg.norm(self.g @ p - s * right, axis=0)

    def settled(self, wanted: int) -> bool:
        if self.steps == self.dims:
            return True
        if self.steps < wanted:
            return False
        s, _, residual = self.singular()
        distance = np.abs(s[:, None] - s[None, :]) + np.diag(np.full(len(s), np.inf))
        near = np.minimum(distance.min(axis=1), s) if len(s) > 1 else s
        return bool((residual[:wanted] <= np.maximum(CLOSE * near[:wanted], ROUNDING * s[0])).all())

    def covered(self, wanted: int) -> bool:
        """Whether the variance outside of V is too small to hold a wanted component."""
        s = np.linalg.svd(self.t, compute_uv=False)
        rest = self.norm2 - (self.t**2).sum()
        return rest <= max(s[wanted - 1] ** 2 if len(s) >= wanted else 0.0, 1e-13 * self.norm2)


def bidiagonalise(vectors: DataFrame, dims: int, centre: Callable[[np.ndarray], np.ndarray], wanted: int, seed: int = 42) -> Bidiagonal:
    """Steps until the ``wanted`` greatest singular values of the centred rows are found."""
    made, checked = Bidiagonal(dims, seed), False
    while True:
        made.advance(totals(vectors, dims, 2 + made.steps + dims, made.measure(centre)))
        if not made.settled(wanted):
            continue
        if made.steps == dims or made.covered(wanted) or checked and made.since_restart >= CHECK_STEPS:
            return made
        if not checked:
            checked = True
            made.restart()


def whiten(df: DataFrame, components: int = COMPONENTS, seed: int = 42, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector and component: (id, component, n, deviation, whitened, explained, identity_error).

    Entries become whole numbers x = floor(1024 c) + 100000.  Rows whose vector is null or
    holds a null, NaN or infinite entry are left out; the ``n`` others, with sums S, are
    all fitted.  ``deviation`` is the sum of (n x - S)^2 over the dimensions, exactly; null
    where a long cannot hold it.  ``whitened`` is x - S / n along the unit eigenvector of
    the covariance, over the root of its eigenvalue, eigenvalues falling from component 1;
    ``explained`` is the eigenvalue's share of the total variance.  ``identity_error`` is
    the largest entry of the covariance of all whitened rows minus the identity.

    There are as many components as asked for, dimensions, or directions with a spread
    above 1e-10 of the widest, whichever is least; without any (an empty table, one
    vector, equal vectors, no dimensions) there are no rows.  Equal eigenvalues have any
    orthonormal vectors of their space.  Repeated rows and null ids count as rows.  Other
    columns are not read.  Vectors of unequal lengths are an error.

    The vectors are written to the shared folder once and read by each step.
    """
    vectors = materialize(grid(bounded(df), id_column, vector))
    n, dims, most, least, greatest = vectors.agg(
        F.count("*"), F.min(F.size("x")), F.max(F.size("x")), F.min(F.array_min("x")), F.max(F.array_max("x"))
    ).first()
    kind = df.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if dims != most:
        raise ValueError(f"{vector} has vectors of {dims} and of {most} entries")
    if not n or not dims:
        return df.sparkSession.createDataFrame([], schema)
    if n * max(abs(least), abs(greatest)) > LONG // 2:
        raise ValueError(f"{vector} has entries too large for exact sums over {n} vectors")
    sums = totals(vectors, dims, dims, lambda x: x.sum(axis=0), "long")
    centre, wanted = centred(n, sums), min(components, dims)
    made = bidiagonalise(vectors, dims, centre, wanted, seed)
    values, right, _ = made.singular()
    wanted = int((values[:wanted] > RANK * values[0]).sum()) if made.norm2 > 0 else 0
    if not wanted:
        return df.sparkSession.createDataFrame([], schema)
    eigen = values[:wanted] ** 2 / n
    project = right[:, :wanted] / np.sqrt(eigen)
    explained = values[:wanted] ** 2 / made.norm2

    def spread(x: np.ndarray) -> np.ndarray:
        z = centre(x) @ project
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    moments = totals(vectors, dims, wanted + wanted**2, spread) / n
    mean, square = moments[:wanted], moments[wanted:].reshape(wanted, wanted)
    error = float(np.abs(square - np.outer(mean, mean) - np.eye(wanted)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            x = matrix(batch.column(1), dims)
            by = n * x - sums
            about = (by.astype(np.float64) ** 2).sum(axis=1)
            exact = (by * by).sum(axis=1)
            deviation = pa.array(exact.tolist(), pa.int64())
            if (about > 9.2e18).any():
                whole = [sum(v * v for v in row) for row in by.tolist()]
                deviation = pa.array([d if d <= LONG else None for d in whole], pa.int64())
            of = pa.array(np.repeat(np.arange(rows), wanted))
            z = (by / n) @ project
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(of),
                    pa.array(np.tile(np.arange(1, wanted + 1), rows), pa.int32()),
                    pa.array(np.full(len(of), n)),
                    deviation.take(of),
                    pa.array(z.ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(len(of), error)),
                ],
                names=[id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return vectors.select("id", "x").mapInArrow(run, schema)
