"""Whitening of embeddings: principal components by incremental eigendecomposition, refined over all vectors.

Entries c become whole numbers x = floor(64 * c) + 1000000. The fit list holds each distinct x vector once. A task
reads its part of the list and keeps the number of vectors, their exact sums, and the spectrum (eigenvalues, eigenvectors) of
their scatter about their mean. A vector changes the scatter by a matrix of rank one, centred on the mean so far: the new
eigenvalues are the roots of a secular equation between the old ones, after entries that do not change are deflated, and
the eigenvectors follow from them. ``block`` vectors at a time are first turned into as many as there are dimensions
with the same scatter (the triangle of a QR factorisation), so a block costs one update for each dimension; a block of one is
the plain update by each vector. Spectra of tasks are combined alike: an eigenvector of one, scaled, is a rank-one
update of the other, and so is the step between their means. They combine in a tree, some at a time.

That basis is then refined: a pass over the list projects the centred vectors on it, and the small matrix of their
products (Rayleigh-Ritz), summed up in the same tree, is diagonalised. Its size is that of the dimensions squared, whatever
the number of vectors; nothing else reaches the driver.

Defined results: rows whose vector is null, or has null or non-finite entries, entries whose x no long holds, no entry at all,
or another length than most rows that remain (ties: the longer) are dropped. A deviation that no long holds is null. A component whose
eigenvalue is zero to rounding (at most 1e-12 of the largest) has no whitened value and is left out, so one distinct
vector gives no rows. Rows that repeat are whitened each. Other columns do not matter. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import stored

SCALE, SHIFT = 64, 1_000_000
FAN_IN = 8
BLOCK = 4096
ZERO = 1e-12


# --- eigendecomposition of a matrix changed by rank one ---------------------------------------------------

def _secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(weights / (poles - root)), one above each pole: the nearest pole's number and the distance from it.

    Poles ascend strictly, weights are above 0. Distances are found by bisection from the nearer
    pole, so that none is lost beside large poles.
    """
    n = len(poles)
    gaps = np.append(np.diff(poles), weights.sum())
    middle = poles + gaps / 2
    with np.errstate(divide="ignore"):
        at_middle = 1 + (weights / (poles - middle[:, None])).sum(axis=1)
    left = at_middle >= 0  # the equation grows from -inf to its end: a value above 0 means that the root lies before
    left[-1] = True
    near = np.where(left, np.arange(n), np.minimum(np.arange(n) + 1, n - 1))
    low = np.where(left, 0.0, -gaps / 2)
    high = np.where(left, np.where(np.arange(n) == n - 1, gaps, gaps / 2), 0.0)
    distance = poles - poles[near][:, None]  # row: root, column: pole
    for _ in range(64):
        step = (low + high) / 2
        with np.errstate(divide="ignore", over="ignore"):
            value = 1 + (weights / (distance - step[:, None])).sum(axis=1)
        above = value >= 0
        high, low = np.where(above, step, high), np.where(above, low, step)
    return near, np.where(left, high, low)


def rank_one_update(values: np.ndarray, vectors: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending eigenvalues and eigenvectors (columns) of vectors @ diag(values) @ vectors.T + outer(change, change)."""
    z = vectors.T @ change
    norm = float(z @ z)
    if norm == 0.0:
        return values, vectors
    size = max(float(np.abs(values).max()), norm)
    tiny = 8 * np.finfo(float).eps * size
    values, vectors = values.copy(), vectors.copy()
    last = -1
    moving = np.zeros(len(z), bool)
    for i in range(len(z)):  # deflation: equal values are turned so that one of them does not change
        if abs(z[i]) * np.sqrt(norm) <= tiny:
            z[i] = 0.0
            continue
        if last >= 0 and values[i] - values[last] <= tiny:
            length = np.hypot(z[last], z[i])
            c, s = z[i] / length, z[last] / length
            a, b = vectors[:, last].copy(), vectors[:, i].copy()
            vectors[:, last], vectors[:, i] = c * a - s * b, s * a + c * b
            z[last], z[i], moving[last] = 0.0, length, False
        moving[i], last = True, i
    places = np.flatnonzero(moving)
    if not len(places):
        return values, vectors
    poles, weights = values[places], z[places] ** 2
    near, step = _secular_roots(poles, weights)
    apart = (poles[near] - poles[:, None]) + step  # root minus pole; row: pole, column: root
    # weights for which the computed roots are exact keep the eigenvectors orthogonal
    others = poles - poles[:, None]
    np.fill_diagonal(others, 1.0)
    ratio = apart / np.where(others == 1.0, 1.0, others)
    ratio[np.diag_indices_from(ratio)] = np.diag(apart)
    off = ~np.eye(len(poles), dtype=bool)
    ratio[off] = apart[off] / others[off]
    exact = np.sqrt(np.abs(np.prod(ratio, axis=1))) * np.sign(z[places])
    turned = exact[:, None] / -apart
    turned /= np.linalg.norm(turned, axis=0)
    values[places] = poles[near] + step
    vectors[:, places] = vectors[:, places] @ turned
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Number, exact sums, mean and eigendecomposition of the scatter of the vectors seen so far."""

    def __init__(self, dimensions: int):
        self.n, self.sums = 0, np.zeros(dimensions, object)
        self.values, self.vectors = np.zeros(dimensions), np.eye(dimensions)

    @property
    def mean(self) -> np.ndarray:
        return (self.sums / max(self.n, 1)).astype(float)

    def change(self, vector: np.ndarray) -> None:
        self.values, self.vectors = rank_one_update(self.values, self.vectors, vector)

    def _step_to(self, n: int, mean: np.ndarray) -> None:
        if self.n:
            self.change(np.sqrt(self.n * n / (self.n + n)) * (mean - self.mean))

    def add(self, block: np.ndarray) -> None:
        """Vectors (rows, whole numbers), centred on their mean and then moved to the common one."""
        n, sums = len(block), _exact_sums(block)
        self._step_to(n, (sums / n).astype(float))
        if n > 1:
            centred = _centred(block, n, sums)
            for row in np.linalg.qr(centred, mode="r") if n > len(sums) else centred:
                self.change(row)
        self.n, self.sums = self.n + n, self.sums + sums

    def combine(self, other: Spectrum) -> None:
        if not other.n:
            return
        self._step_to(other.n, other.mean)
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.change(np.sqrt(value) * vector)
        self.n, self.sums = self.n + other.n, self.sums + other.sums

    def row(self, part: int) -> pd.DataFrame:
        return pd.DataFrame({
            "part": [part], "n": [self.n], "sums": [[str(s) for s in self.sums]], "values": [self.values.tobytes()],
            "vectors": [self.vectors.tobytes()],
        })

    @classmethod
    def of(cls, row) -> Spectrum:
        d = len(row.sums)
        spectrum = cls(d)
        spectrum.n, spectrum.sums = int(row.n), np.array([int(s) for s in row.sums], object)
        spectrum.values, spectrum.vectors = np.frombuffer(row.values), np.frombuffer(row.vectors).reshape(d, d)
        return spectrum


# --- tasks ---------------------------------------------------------------------------------------------

SPECTRUM = "part long, n long, sums array<string>, values binary, vectors binary"


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """A list column of one length as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _blocks(batches: Iterator[pa.RecordBatch], dimensions: int, block: int) -> Iterator[np.ndarray]:
    for batch in batches:
        rows = _matrix(batch.column("x"), dimensions)
        for start in range(0, len(rows), block):
            yield rows[start:start + block]


def _part_number(parts: int) -> int:
    return TaskContext.get().partitionId() % parts


def _spectrum_of(dimensions: int, block: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum = Spectrum(dimensions)
        for rows in _blocks(batches, dimensions, block):
            spectrum.add(rows)
        if spectrum.n:
            yield pa.RecordBatch.from_pandas(spectrum.row(_part_number(parts)), preserve_index=False)

    return run


def _combined(frame: pd.DataFrame) -> pd.DataFrame:
    rows = list(frame.sort_values("part").itertuples(index=False))
    spectrum = Spectrum.of(rows[0])
    for row in rows[1:]:
        spectrum.combine(Spectrum.of(row))
    return spectrum.row(int(rows[0].part) // FAN_IN)


def _added(frame: pd.DataFrame) -> pd.DataFrame:
    products = sum(np.frombuffer(p) for p in frame.sort_values("part")["products"])
    return pd.DataFrame({"part": [int(frame["part"].iloc[0]) // FAN_IN], "products": [products.tobytes()]})


def _joined(parts: DataFrame, together, schema: str, most: int) -> DataFrame:
    """One row out of a row for each part, numbered from 0 to most - 1: FAN_IN at a time, in a tree."""
    while most > 1:
        parts = parts.groupBy(F.floor(F.col("part") / FAN_IN).alias("group")).applyInPandas(together, schema)
        most = -(-most // FAN_IN)
    return parts


def _products_of(dimensions: int, n: int, sums: np.ndarray, basis: np.ndarray, parts: int):
    """Products of the centred vectors, projected on a basis (columns), summed up over a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((basis.shape[1], basis.shape[1]))
        for rows in _blocks(batches, dimensions, BLOCK):
            projected = _centred(rows, n, sums) @ basis
            total += projected.T @ projected
        yield pa.RecordBatch.from_pandas(
            pd.DataFrame({"part": [_part_number(parts)], "products": [total.tobytes()]}), preserve_index=False
        )

    return run


# --- whole numbers ---------------------------------------------------------------------------------------

LONG = 1 << 62


def _most(numbers: np.ndarray) -> int:
    return max(int(numbers.max(initial=0)), -int(numbers.min(initial=0)))


def _exact_sums(rows: np.ndarray) -> np.ndarray:
    wide = _most(rows) * max(len(rows), 1) >= LONG
    return (rows.astype(object) if wide else rows).sum(axis=0).astype(object)


def _exact_deviations(rows: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, as whole numbers; beyond a long as Python's."""
    if n * _most(rows) + _most(sums) >= LONG:
        return n * rows.astype(object) - sums
    return n * rows - sums.astype(np.int64)


def _centred(rows: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (_exact_deviations(rows, n, sums) / n).astype(float)


def _squares(deviations: np.ndarray) -> list:
    """Sums of squares of the rows; null where no long holds one."""
    if _most(deviations) ** 2 * deviations.shape[1] < LONG:
        return (deviations * deviations).sum(axis=1).tolist()
    sums = [sum(int(v) ** 2 for v in row) for row in deviations]
    return [s if s < 1 << 63 else None for s in sums]


# --- fit ---------------------------------------------------------------------------------------------------

def coded_vectors(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """The remaining rows: their columns as ``row``, and x, an array of longs."""
    row = F.struct(*[F.col(f"`{c}`") for c in table.columns])
    doubles = F.transform(F.col(f"`{vector}`"), lambda c: SCALE * c.cast("double"))
    fine = F.forall("scaled", lambda c: c.isNotNull() & (F.abs(c) < float(LONG)))  # what is not a number is above all
    kept = table.select(row.alias("row"), doubles.alias("scaled")).where(
        F.col("scaled").isNotNull() & (F.size("scaled") > 0) & F.coalesce(fine, F.lit(False))
    )
    return kept.select("row", F.transform("scaled", lambda c: F.floor(c) + SHIFT).alias("x"))


def _sign(vectors: np.ndarray) -> np.ndarray:
    """Columns turned so that their largest entry is above 0."""
    return vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)


class Fit:
    """What the fit list gave: its size, sums, eigenvalues (falling) and components (columns) above zero, and the error."""

    def __init__(self, fit: DataFrame, dimensions: int, most: int, block: int = BLOCK):
        parts = fit.select(F.spark_partition_id().alias("part")).agg(F.max("part")).first()[0] + 1
        spectra = fit.mapInArrow(_spectrum_of(dimensions, block, parts), SPECTRUM)
        first = Spectrum.of(_joined(spectra, _combined, SPECTRUM, parts).first())
        self.n, self.sums = first.n, first.sums

        def covariance(basis: np.ndarray) -> np.ndarray:
            products = fit.mapInArrow(_products_of(dimensions, self.n, self.sums, basis, parts), "part long, products binary")
            row = _joined(products, _added, "part long, products binary", parts).first()
            return np.frombuffer(row.products).reshape(basis.shape[1], -1) / self.n

        basis = first.vectors[:, ::-1]
        values, turn = np.linalg.eigh(covariance(basis))
        self.trace = float(values.sum())
        order = np.argsort(values)[::-1]
        order = order[values[order] > ZERO * max(values.max(initial=0.0), 0.0)][:most]
        self.values, self.components = values[order], _sign((basis @ turn)[:, order])
        self.identity_error = 0.0
        if len(order):
            self.identity_error = float(np.abs(covariance(self.scaled) - np.eye(len(order))).max())

    @property
    def scaled(self) -> np.ndarray:
        return self.components / np.sqrt(self.values)


def _whitened(fit_n, sums, scaled, explained, error, dimensions):
    k = scaled.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), BLOCK):
                part = batch.slice(start, BLOCK)
                deviations = _exact_deviations(_matrix(part.column("x"), dimensions), fit_n, sums)
                white = (deviations / fit_n).astype(float) @ scaled
                rows = np.repeat(np.arange(len(part)), k)
                yield pa.RecordBatch.from_arrays([
                    part.column("row").take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))),
                    pa.array(np.full(len(rows), fit_n)), pa.array(_squares(deviations), pa.int64()).take(pa.array(rows)), pa.array(white.ravel()),
                    pa.array(np.tile(explained, len(part))), pa.array(np.full(len(rows), error)),
                ], ["row", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whitened(table: DataFrame, vector: str = "embedding", components: int = 16, block: int = BLOCK) -> DataFrame:
    """Each remaining row once for each component: ``row`` (its columns), component, n, deviation, whitened, explained,
    identity_error."""
    rows = coded_vectors(table, vector)
    schema = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    nothing = rows.select("row", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in schema.split(", ")]).where("false")
    length = rows.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    if length is None:
        return nothing
    dimensions = length["length"]
    rows = rows.where(F.size("x") == dimensions)
    fit = Fit(stored(rows.select("x").distinct(), "whitening-fit"), dimensions, components, block)
    if not len(fit.values):
        return nothing
    run = _whitened(fit.n, fit.sums, fit.scaled, fit.values / fit.trace, fit.identity_error, dimensions)
    with_row = rows.select("row").schema
    for column in nothing.schema.fields[1:]:
        with_row = with_row.add(column)
    return rows.mapInArrow(run, with_row)


def whitening_report(table: DataFrame) -> DataFrame:
    """vec_id in place of the row's columns."""
    return whitened(table.select("vec_id", "embedding")).select(
        "row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    )
