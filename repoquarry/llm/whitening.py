"""Embedding whitening by shifted CholeskyQR.

Entries become whole numbers, so that sums and means are exact. The centred rows A are never gathered: each
pass over them adds up one Gram matrix, as many rows and columns as a vector is long, whose Cholesky factor
orthogonalises the rows by a triangular solve in the next pass. The first Gram matrix gets a small shift, without
which the factor of ill-conditioned rows does not exist; the passes after it remove what the shift left. The
product R of all factors has R'R = A'A without A'A ever being decomposed, and its singular values and vectors are
the deviations and the components. Each task sends one partial Gram matrix row by row, and rows of equal number
are added up by Spark, so the driver receives one matrix a pass.

Vectors that are null or hold null or non-finite entries take no part, nor do those of another length than most
have (of equally frequent lengths the longer). Components along which nothing varies cannot be whitened and
are not returned; so one vector, or equal vectors only, give no rows, as does an empty table. Repeated rows count
each time; a null id stays null. Entries beyond +-2^40 count as that. Other columns of the table do not pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repoquarry.session import materialize, ship_package

COMPONENTS, SCALE, OFFSET, PASSES = 32, 64, 1_000_000, 3
_LARGEST = 2.0**46  # of a scaled entry
_ROWS = 4_096  # worked on at once
_TASKS_A_CORE = 4
_FLAT = 2.0**-40  # deviation along a component, relative to the largest and a dimension, that counts as none


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the vectors that take part."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    usable = vectors.select(F.col(id_col).alias("id"), vector.alias("v")).where(F.col("v").isNotNull() & finite)
    bounded = lambda c: F.greatest(F.least(c * SCALE, F.lit(_LARGEST)), F.lit(-_LARGEST))
    return usable.select("id", F.transform("v", lambda c: F.floor(bounded(c)).cast("long") + OFFSET).alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy().reshape(len(column), -1)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _few_tasks(table: DataFrame) -> DataFrame:
    """As many tasks as keep all cores busy: each of them sends a whole Gram matrix."""
    return table.coalesce(_TASKS_A_CORE * table.sparkSession.sparkContext.defaultParallelism)


def exact_sums(table: DataFrame) -> list[int]:
    """Sum of each dimension, as Python integers."""

    def run(batches):
        total = 0
        for batch in _pieces(batches):
            total = total + _matrix(batch).sum(0).astype(object)
        if not isinstance(total, int):
            slots = pa.array(range(len(total)), pa.int32())
            yield pa.RecordBatch.from_arrays([slots, pa.array(list(map(Decimal, total)), pa.decimal128(38, 0))], ["slot", "total"])

    parts = _few_tasks(table.select("x")).mapInArrow(run, "slot int, total decimal(38, 0)")
    rows = parts.groupBy("slot").agg(F.sum("total").alias("total")).collect()
    return [int(r["total"]) for r in sorted(rows, key=lambda r: r["slot"])]


def _added(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        part = np.sum([np.frombuffer(b) for b in batch.column("values").to_pylist()], axis=0)
        total = part if total is None else total + part
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()])], ["i", "values"])


def gram(table: DataFrame, rows_of: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum of r'r over the rows r that rows_of makes of the vectors."""

    def run(batches):
        total = np.zeros((width, width))
        for batch in _pieces(batches):
            r = rows_of(_matrix(batch))
            total += r.T @ r
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([t.tobytes() for t in total])], ["i", "values"])

    schema = "i int, values binary"
    parts = _few_tasks(table.select("x")).mapInArrow(run, schema)
    found = np.zeros((width, width))
    for row in parts.groupBy("i").applyInArrow(_added, schema).collect():
        found[row["i"]] = np.frombuffer(row["values"])
    return found


@dataclass
class Whitening:
    n: int
    sums: list[int]  # exact, one for each dimension
    components: np.ndarray  # (components, dimensions), unit rows
    variances: np.ndarray
    trace: float  # of the covariance
    identity_error: float = 0.0

    def __post_init__(self):
        self.middle = np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)
        self.rest = [s - self.n * int(m) for s, m in zip(self.sums, self.middle, strict=True)]
        self.fraction = np.array([r / self.n for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: whole numbers first, so nothing is lost to the size of the mean."""
        return (x - self.middle).astype(np.float64) - self.fraction

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.variances)[:, None]).T

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Exact sum of (n x - S)^2 of each row; null beyond 38 digits."""
        y = x - self.middle
        most, rest = int(np.abs(y).max(initial=0)), max(map(abs, self.rest), default=0)
        if most * max(most, rest) * max(1, len(self.rest)) >= 2**62:
            y = y.astype(object)
        squares, mixed = (y * y).sum(1).astype(object), (y * np.array(self.rest, y.dtype)).sum(1).astype(object)
        found = self.n**2 * squares - 2 * self.n * mixed + sum(r * r for r in self.rest)
        if max(found, default=0) < 2**63:
            return pa.array(found.astype(np.int64)).cast(pa.decimal128(38, 0), safe=False)
        return pa.array([Decimal(v) if v < 10**38 else None for v in found], pa.decimal128(38, 0))


def _cholesky(g: np.ndarray, n: int, first: bool) -> np.ndarray:
    """Upper factor of a Gram matrix of n rows, shifted where it has none."""
    d = len(g)
    unit = 2.0**-53 * np.trace(g)
    if not first:
        try:
            factor = np.linalg.cholesky(g).T
            if np.diag(factor).min() > 2.0**-20 * np.diag(factor).max():
                return factor
        except np.linalg.LinAlgError:
            pass
    shift = 11 * (min(n, _ROWS) * d + d * (d + 1)) * unit
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 4


def fit(table: DataFrame, components: int = COMPONENTS, passes: int = PASSES) -> Whitening | None:
    """Mean, components and variances of a table of whole numbers; None where nothing varies."""
    n, sums = table.count(), exact_sums(table)
    d = len(sums)
    if not d:
        return None
    fitted = Whitening(n, sums, np.zeros((0, d)), np.zeros(0), 0.0)
    factors: list[np.ndarray] = []

    def orthogonal(x: np.ndarray) -> np.ndarray:
        rows = fitted.centred(x).T
        for factor in factors:
            rows = np.linalg.solve(factor.T, rows)
        return rows.T

    r = np.eye(d)
    for number in range(passes):
        g = gram(table, orthogonal, d)
        if not g.any():
            return None
        factors.append(_cholesky(g, n, first=number == 0))
        r = factors[-1] @ r
    _, deviation, axes = np.linalg.svd(r)
    varies = deviation > deviation[0] * d * _FLAT
    k = min(components, int(varies.sum()))
    axes = axes[:k] * np.sign(axes[np.arange(k), np.abs(axes[:k]).argmax(1)])[:, None]
    variances = deviation**2 / n
    fitted = Whitening(n, sums, axes, variances[:k], float(variances.sum()))
    fitted.identity_error = float(np.abs(gram(table, fitted.whitened, k) / n - np.eye(k)).max())
    return fitted


def apply(table: DataFrame, fitted: Whitening, id_col: str = "vec_id") -> DataFrame:
    """One row for each vector and component; deviation and whitened as the module says."""
    kind = table.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, deviation decimal(38, 0), whitened double, explained double"
    k = len(fitted.variances)

    def run(batches):
        explained = fitted.variances / fitted.trace
        for batch in _pieces(batches):
            x = _matrix(batch)
            row = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(row),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    fitted.deviations(x).take(row),
                    pa.array(fitted.whitened(x).ravel()),
                    pa.array(np.tile(explained, len(x))),
                ],
                ["id", "component", "deviation", "whitened", "explained"],
            )

    out = table.select("id", "x").mapInArrow(run, schema).withColumnRenamed("id", id_col)
    return out.withColumns({"n": F.lit(fitted.n).cast("long"), "identity_error": F.lit(fitted.identity_error)})


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, passes: int = PASSES
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error). Runs jobs: one a pass and three more."""
    spark = vectors.sparkSession
    ship_package(spark)
    table, _ = materialize(whole_numbers(vectors, id_col, vector_col), "whole_numbers")
    lengths = table.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    table = table.where(F.size("x") == (lengths[0]["length"] if lengths else 0))
    fitted = fit(table, components, passes)
    columns = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if fitted is None:
        empty = Whitening(1, [], np.zeros((0, 0)), np.zeros(0), 1.0)
        return apply(table.limit(0), empty, id_col).select(*columns)
    return apply(table, fitted, id_col).select(*columns)
