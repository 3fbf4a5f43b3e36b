"""Embedding whitening by polarisation covariance.

A cross-covariance needs no product of two dimensions: var(a + b) = var(a) + var(b) + 2 cov(a, b). So
the squared centred values of every dimension and of the sum of every two dimensions are added up, and
differences of those variances give the whole matrix, which ``numpy.linalg.eigh`` takes apart.

All sums are exact. Entries become whole numbers floor(scale * c) + offset. A first pass adds them up
per dimension; the second centres each entry on the whole part of its mean *before* squaring, so that
squares stay small, and the fraction of the mean that is left is settled with whole numbers of any
size at the end. Only then one division rounds each covariance to a double.

Tasks add up their own rows and send one row per pair of dimensions; ``groupBy`` adds those up. The
driver gets dims * (dims + 1) / 2 numbers, whatever the number of vectors. Three passes read the vectors
(sums, squares, check of the result) before the one that writes; none shuffles them.

Defined results. Set aside are vectors that are null or empty, hold null or non-finite entries, entries
whose whole number reaches 2**50 (their squares would not fit Spark's decimals), or another number of
entries than most vectors have (of equally many, the longer ones are kept). Repeated rows and ids count
each; a null id stays null. Components without variance (an eigenvalue of rounding error or less) can't
be scaled to one and are left out, so a table of equal vectors, one vector, or none gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
# Whole numbers of this size or more are set aside.
LARGEST = 1 << 50
# Entries that one slice of a batch may hold; it bounds the memory of a worker.
SLICE_ENTRIES = 1 << 18


@dataclass
class Fit:
    """What whitening needs of the fit list."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    eigenvalues: np.ndarray  # of the kept components, falling
    vectors: np.ndarray  # a column per kept component

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / np.trace(self.covariance)


def whole_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, x): the entries of every vector that counts as whole numbers."""
    scaled = F.transform(F.col(vector_column), lambda c: F.floor(c.cast("double") * SCALE))

    def sound(c: Column) -> Column:
        value = c.cast("double") * SCALE
        return c.isNotNull() & ~F.isnan(value) & (F.abs(value) < float(LARGEST))

    # ``forall`` is null for a null vector only, as ``sound`` is never null.
    usable = vectors.filter(F.forall(vector_column, sound) & (F.size(vector_column) > 0))
    x = F.transform(scaled, lambda c: c.cast("long") + F.lit(OFFSET).cast("long"))
    rows = usable.select(F.col(id_column).alias("id"), x.alias("x"))
    lengths = rows.groupBy(F.size("x").alias("dims")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("dims")).first()
    return rows.filter(F.size("x") == (most["dims"] if most else 0))


def matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and vectors of bounded slices, a row per vector."""
    for batch in batches:
        if not batch.num_rows:
            continue
        dims = len(batch.column("x")[0])
        step = max(1, SLICE_ENTRIES // dims)
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield part.column("id"), part.column("x").flatten().to_numpy().reshape(part.num_rows, dims)


def pair_squares(rows: np.ndarray) -> np.ndarray:
    """Sums over the rows of squared entries (diagonal) and of squared pair sums (above it)."""
    dims = rows.shape[1]
    sums = np.zeros((dims, dims), rows.dtype)
    for i in range(dims):
        sums[i, i] = (rows[:, i] ** 2).sum()
        sums[i, i + 1 :] = ((rows[:, i : i + 1] + rows[:, i + 1 :]) ** 2).sum(axis=0)
    return sums


def _in_range(rows: np.ndarray) -> np.ndarray:
    """The same numbers as 64-bit ones if sums of squared pair sums stay exact in them, else as Python's."""
    most = int(np.abs(rows).max(initial=0))
    return rows if (2 * most) ** 2 * max(len(rows), 1) < 1 << 63 else rows.astype(object)


def _column_sums(batches):
    total: np.ndarray | None = None
    n = 0
    for _, x in matrices(batches):
        sums = x.astype(object).sum(axis=0) if int(np.abs(x).max()) * len(x) >= 1 << 62 else x.sum(axis=0)
        total = sums.astype(object) if total is None else total + sums
        n += len(x)
    if total is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()),
             pa.array([int(t) for t in total], pa.decimal128(38, 0))],
            ["i", "n", "total"],
        )


def _pairs(total: np.ndarray, kind: pa.DataType) -> pa.RecordBatch:
    i, j = np.triu_indices(len(total))
    convert = int if pa.types.is_decimal(kind) else float
    return pa.RecordBatch.from_arrays(
        [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([convert(t) for t in total[i, j]], kind)],
        ["i", "j", "total"],
    )


def _summed_pairs(parts: DataFrame, dims: int) -> np.ndarray:
    """The sums of all tasks as one matrix, symmetric."""
    out = np.zeros((dims, dims), object)
    for row in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        value = row["total"]
        out[row["i"], row["j"]] = out[row["j"], row["i"]] = value if isinstance(value, float) else int(value)
    return out


def polarised(squares: np.ndarray, sums: list, n: int) -> np.ndarray:
    """n**2 times the covariance matrix, exact for whole numbers.

    ``squares`` holds the summed squares of dimensions and of pair sums, ``sums`` the sums of the
    dimensions the squares were taken of: n**2 var = n * squares - sums**2, also for a pair sum.
    """
    dims = len(sums)
    variance = np.array([n * squares[i, i] - sums[i] ** 2 for i in range(dims)], object)
    out = np.zeros((dims, dims), object)
    for i in range(dims):
        out[i, i] = variance[i]
        for j in range(i + 1, dims):
            both = n * squares[i, j] - (sums[i] + sums[j]) ** 2
            # For whole numbers the difference is twice a whole number.
            twice = both - variance[i] - variance[j]
            out[i, j] = out[j, i] = twice // 2 if isinstance(twice, int) else twice / 2
    return out


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Means, covariance and components of ``whole_vectors``; None if there is no vector."""
    sums = (
        rows.mapInArrow(_column_sums, "i int, n long, total decimal(38,0)")
        .groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        .collect()
    )
    if not sums:
        return None
    n = sums[0]["n"]
    totals = [int(row["total"]) for row in sorted(sums, key=lambda row: row["i"])]
    middle = np.array([total // n for total in totals], np.int64)

    def squares(batches):
        total = 0
        for _, x in matrices(batches):
            total = total + pair_squares(_in_range(x - middle)).astype(object)
        if isinstance(total, np.ndarray):
            yield _pairs(total, pa.decimal128(38, 0))

    parts = rows.mapInArrow(squares, "i int, j int, total decimal(38,0)")
    rest = [total - n * int(m) for total, m in zip(totals, middle)]
    exact = polarised(_summed_pairs(parts, len(totals)), rest, n)
    # Python divides whole numbers of any size with one rounding.
    covariance = np.array([[value / n**2 for value in line] for line in exact], float)
    values, vectors = np.linalg.eigh(covariance)
    falling = np.argsort(-values, kind="stable")[:components]
    falling = falling[values[falling] > len(totals) * np.finfo(float).eps * max(values.max(), 0)]
    return Fit(n, totals, covariance, values[falling], vectors[:, falling])


def _deviations(x: np.ndarray, sums: list[int], n: int) -> np.ndarray:
    """n * x - S, exact: as 64-bit numbers if sums of their squares fit those, else as Python's."""
    middle = np.array([total // n for total in sums], np.int64)
    centred = x - middle
    most = (int(np.abs(centred).max(initial=0)) + 1) * n
    if most**2 * len(sums) < 1 << 63:
        return centred * n - np.array([total % n for total in sums], np.int64)
    return centred.astype(object) * n - np.array([total % n for total in sums], object)


def _projected(deviations: np.ndarray, fitted: Fit) -> np.ndarray:
    return (deviations / fitted.n).astype(float) @ fitted.vectors / np.sqrt(fitted.eigenvalues)


def identity_error(rows: DataFrame, fitted: Fit) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, from all rows."""

    def squares(batches):
        total = 0.0
        for _, x in matrices(batches):
            total = total + pair_squares(_projected(_deviations(x, fitted.sums, fitted.n), fitted))
        if isinstance(total, np.ndarray):
            yield _pairs(total, pa.float64())

    dims = len(fitted.eigenvalues)
    parts = rows.mapInArrow(squares, "i int, j int, total double")
    # Whitened vectors are centred already, so the sums of their dimensions are zero.
    covariance = polarised(_summed_pairs(parts, dims), [0.0] * dims, fitted.n).astype(float) / fitted.n**2
    return float(np.abs(covariance - np.eye(dims)).max())


def whiten(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """A row per vector and component: (id, component, n, deviation, whitened, explained, identity_error).

    ``deviation`` is a decimal(38,0), the sum over dimensions of (n * x - S) ** 2.
    """
    rows = whole_vectors(vectors, id_column, vector_column)
    kind = vectors.schema[id_column].dataType.simpleString()
    fitted = fit(rows, components)
    if fitted is None or not len(fitted.eigenvalues):
        return rows.sparkSession.createDataFrame(
            [],
            f"`{id_column}` {kind}, component int, n long, deviation decimal(38,0), whitened double,"
            " explained double, identity_error double",
        )

    def projected(batches):
        for ids, x in matrices(batches):
            deviations = _deviations(x, fitted.sums, fitted.n)
            whitened = _projected(deviations, fitted)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([int(d) for d in (deviations**2).sum(axis=1)], pa.decimal128(38, 0)),
                    pa.FixedSizeListArray.from_arrays(whitened.ravel(), whitened.shape[1]).cast(pa.list_(pa.float64())),
                ],
                ["id", "deviation", "all"],
            )

    out = rows.mapInArrow(projected, f"id {kind}, deviation decimal(38,0), all array<double>")
    shares = F.array(*[F.lit(float(share)) for share in fitted.explained])
    return out.select("id", "deviation", F.posexplode("all").alias("place", "whitened")).select(
        F.col("id").alias(id_column),
        (F.col("place") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(identity_error(rows, fitted)).alias("identity_error"),
    )
