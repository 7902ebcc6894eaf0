"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred vectors.

Vectors become whole numbers, ``floor(1024 * c) + 100000``, so count and sums per dimension are exact. With X the rows
minus their mean, each step multiplies X by the newest right vector v and the result's transpose by X, in one job: a
task multiplies its rows, takes out the part along all earlier left vectors u, and adds up what its rows give to
``X'u``, to ``u'u`` and to the products with the earlier u. The driver, which holds the right vectors and these sums,
orthogonalises again on both sides (twice for the right vectors, the rest of the left ones from the measured products)
and scales. ``X V = U R`` then holds with orthonormal U and V, R being bidiagonal up to rounding, and the singular
values of this small matrix give components and deviations.

Left vectors are as long as the table and never stored: a task makes its rows of U again from X, V and R by the same
operations, so it gets the same numbers to rounding, also after an executor is lost.

A chain of steps ends when the wanted singular triplets leave a residual at rounding level. As one chain sees a single
component of several with equal deviations, another one of the same length starts in a random direction orthogonal to
all before, until a chain changes nothing or all dimensions are used up. Driver and tasks hold dimensions x steps
numbers and one row of sums per task, whatever the number of vectors.

Vectors that are null or hold null or non-finite entries are left out. A vector shorter than the longest one is
continued with zeros. Components without deviation (below ``RANK`` of the greatest) don't exist: one vector, or equal
ones only, give no rows. Repeated vectors and ids count as often as they come; a null id stays null. Only the named
columns are read. An empty table gives no rows. An entry beyond 2^41 is an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.shared import written

SCALE, SHIFT = 1024, 100_000
#: Least deviation of a component as a share of the greatest.
RANK = 1e-9
#: Residual of a singular triplet at which it counts as found, as a share of the greatest squared singular value.
ROUNDING = 2e-14


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def whole_numbers(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """id, x (array of long) of the rows whose vector is complete and finite."""
    too_large = F.raise_error(F.lit("an entry of a vector is beyond 2^41")).cast("long")

    def number(c: Column) -> Column:
        c = c.cast("double")
        return F.when(F.abs(c) <= float(1 << 41), F.floor(c * SCALE) + SHIFT).otherwise(too_large)

    rows = vectors.where(_usable(F.col(vector_column)))
    return rows.select(F.col(id_column).alias("id"), F.transform(vector_column, number).alias("x"))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """Rows as a matrix; missing places hold the number of a zero."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dimensions).all():
        return values.reshape(len(lengths), dimensions)
    found = np.full((len(lengths), dimensions), SHIFT, np.int64)
    found[np.arange(dimensions) < lengths[:, None]] = values
    return found


def encoded(rows: DataFrame) -> DataFrame:
    """id, data: the numbers of a vector as little-endian 64-bit integers, all of one length; written for the passes."""
    dimensions = rows.agg(F.max(F.size("x")).alias("d")).first()["d"] or 0

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [x.tobytes() for x in _matrix(batch.column("x"), dimensions).astype("<i8")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(data, pa.binary())], ["id", "data"])

    kind = rows.schema["id"].dataType.simpleString()
    return written(rows.mapInArrow(encode, f"id {kind}, data binary"), "whitening-rows")


def _decoded(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as a matrix, without a copy."""
    places = np.frombuffer(column.buffers()[1], "<i4")[column.offset : column.offset + len(column) + 1]
    numbers = np.frombuffer(column.buffers()[2] or b"", "<i8")[places[0] // 8 : places[-1] // 8]
    return numbers.reshape(len(column), -1)


def _summed(rows: DataFrame, of_matrix, size: int) -> np.ndarray:
    """Sum of ``of_matrix`` over the batches of all rows; each task sends ``size`` numbers."""

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if len(batch):
                total += of_matrix(_decoded(batch.column("data")))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["sums"])

    parts = [np.frombuffer(row["sums"]) for row in rows.select("data").mapInArrow(sums, "sums binary").collect()]
    return np.array([math.fsum(column) for column in zip(*parts, strict=True)]) if parts else np.zeros(size)


@dataclass(frozen=True)
class Whitening:
    """What ``fit`` learns: count, exact sums per dimension, components (rows), their variances and shares."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _left(x: np.ndarray, right: np.ndarray, steps: np.ndarray, scales: np.ndarray) -> np.ndarray:
    """Rows of the left vectors, and last the newest one before it is scaled.

    ``steps[j]`` holds what is taken out of ``x v_j`` along the earlier left vectors; ``scales`` their lengths.
    """
    found = x @ right.T
    for j in range(len(right)):
        if j:
            found[:, j] -= found[:, :j] @ steps[j, :j]
        if j < len(scales):
            found[:, j] = found[:, j] / scales[j] if scales[j] else 0.0
    return found


class _Chain:
    """The bidiagonalisation so far. ``rows`` are the data, ``mean`` what they are centred by."""

    def __init__(self, rows: DataFrame, mean: np.ndarray):
        self._rows, self._mean = rows, mean
        size = len(mean)
        self.right = np.zeros((0, size))
        self._products = np.zeros((size, 0))  # X'U
        self._steps = np.zeros((size, size))  # row j: x v_j along the earlier left vectors
        self._scales = np.zeros(0)
        self._greatest = 0.0

    def _orthogonal(self, vector: np.ndarray) -> np.ndarray:
        for _ in range(2):
            vector = vector - self.right.T @ (self.right @ vector)
        return vector

    def step(self, direction: np.ndarray) -> np.ndarray | None:
        """Take ``direction`` in; the next one, or None if nothing of it is new."""
        vector = self._orthogonal(direction)
        vector = self._orthogonal(vector / np.linalg.norm(vector))
        self.right = np.vstack([self.right, vector / np.linalg.norm(vector)])
        k = len(self.right)
        self._steps[k - 1, : k - 1] = self._products.T @ self.right[-1]
        mean, right, steps, scales = self._mean, self.right, self._steps, self._scales

        def both_products(rows: np.ndarray) -> np.ndarray:
            x = rows - mean
            left = _left(x, right, steps, scales)
            return np.concatenate([x.T @ left[:, -1], left.T @ left[:, -1]])

        sums = _summed(self._rows, both_products, len(mean) + k)
        product, along, square = sums[: len(mean)], sums[len(mean) : -1], sums[-1]
        self._steps[k - 1, : k - 1] += along  # the second orthogonalisation of the left vector
        length = math.sqrt(max(0.0, square - along @ along))
        self._greatest = max(self._greatest, length)
        if length <= 1e-14 * self._greatest:
            length, product = 0.0, np.zeros(len(mean))
        else:
            product = (product - self._products @ along) / length
        self._scales = np.append(self._scales, length)
        self._products = np.column_stack([self._products, product])
        following = self._orthogonal(product)
        return following if np.linalg.norm(following) > 1e-13 * self._greatest else None

    def triplets(self, wanted: int) -> tuple[np.ndarray, np.ndarray, bool]:
        """Right singular vectors (rows), singular values, and whether they leave a residual at rounding level."""
        k = len(self.right)
        small = np.triu(self._steps[:k, :k].T, 1) + np.diag(self._scales)
        left, values, turn = np.linalg.svd(small)
        components, values = (turn @ self.right)[:wanted], values[:wanted]
        residual = values[:, None] * (self._products @ left[:, :wanted]).T - values[:, None] ** 2 * components
        found = np.linalg.norm(residual, axis=1).max() <= ROUNDING * max(values[0] ** 2, 1e-300)
        return components, values, bool(found) and k >= wanted


def _bidiagonalised(rows: DataFrame, mean: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (rows) and singular values of the centred rows, greatest first."""
    rng = np.random.default_rng(len(mean))
    chain, direction, first, taken, before = _Chain(rows, mean), None, None, 0, None
    while True:
        direction = chain.step(rng.standard_normal(len(mean)) if direction is None else direction)
        components, values, found = chain.triplets(wanted)
        taken += 1
        if len(chain.right) == len(mean):
            return components, values
        if found and taken >= (first or 0):
            if before is not None and np.allclose(values, before, rtol=1e-12, atol=0):
                return components, values
            first, before, taken, direction = first or taken, values, 0, None


def fit(rows: DataFrame, wanted: int = 8) -> Whitening | None:
    """Count, sums and up to ``wanted`` components of ``rows`` (of ``encoded``); None without any number."""

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            if len(batch):
                own = _decoded(batch.column("data")).sum(axis=0).astype(object)
                total, n = own if total is None else total + own, n + len(batch)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([[str(s) for s in total]])], ["n", "sums"])

    parts = rows.select("data").mapInArrow(sums, "n long, sums array<string>").collect()
    n = sum(part["n"] for part in parts)
    total = tuple(sum(int(s) for s in column) for column in zip(*(part["sums"] for part in parts), strict=True))
    if not total:
        return None
    mean = np.array([s / n for s in total])
    trace = _summed(rows, lambda x: np.array([((x - mean) ** 2).sum()]), 1)[0] / n
    components, values = _bidiagonalised(rows, mean, wanted)
    kept = (values > RANK * values[0]) & (values > 0)
    components, variances = components[kept], values[kept] ** 2 / n
    if not len(components):
        return Whitening(n, total, components, variances, variances, 0.0)
    scaled = components / np.sqrt(variances)[:, None]
    size = len(scaled)
    centre = _summed(rows, lambda x: ((x - mean) @ scaled.T).sum(axis=0), size) / n

    def covariance(x: np.ndarray) -> np.ndarray:
        white = (x - mean) @ scaled.T - centre
        return (white.T @ white).ravel()

    found = _summed(rows, covariance, size * size).reshape(size, size) / n
    error = float(np.abs(found - np.eye(size)).max())
    return Whitening(n, total, components, variances, variances / trace, error)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int]:
    """Sum of (n * x - sum) ** 2 over the dimensions, exact."""
    reach = int(np.abs(x).max(initial=0)) * n + max(abs(s) for s in sums)
    if reach < 1 << 62:
        difference = n * x - np.array(sums, np.int64)
        if int(np.abs(difference).max(initial=0)) ** 2 * len(sums) < 1 << 62:
            return (difference**2).sum(axis=1).tolist()
    difference = n * x.astype(object) - np.array(sums, object)
    return (difference**2).sum(axis=1).tolist()


def whitened(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained, identity_error: a row per vector and component.

    ``deviation`` is a decimal; it is null where it has more than 38 digits.
    """
    kind = rows.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
        "identity_error double"
    )
    sent = rows.sparkSession.sparkContext.broadcast(model)  # some vectors

    def white(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        size = len(model.components) if model else 0
        if not size:
            return
        mean, scaled = model.mean, model.components / np.sqrt(model.variances)[:, None]
        for batch in batches:
            if not len(batch):
                continue
            x = _decoded(batch.column("data"))
            deviations = [d if d < 10**38 else None for d in _deviations(x, model.n, model.sums)]
            row = pa.array(np.repeat(np.arange(len(x)), size))
            wide = pa.array(deviations, pa.decimal128(38, 0)).take(row)
            arrays = [
                batch.column("id").take(row),
                pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(row), model.n, np.int64)),
                wide,
                pa.array(((x - mean) @ scaled.T).ravel()),
                pa.array(np.tile(model.explained, len(x))),
                pa.array(np.full(len(row), model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(
                arrays, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            )

    return rows.mapInArrow(white, schema)
