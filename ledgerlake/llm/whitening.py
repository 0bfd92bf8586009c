"""Whitening of embeddings from an exact, bit-sliced scatter matrix.

Entries become whole numbers. In blocks of rows each dimension is shifted to start at 0 and cut
into bit planes, every plane packed over the rows into 64-bit words. The sum over the rows of
a product of two dimensions is then the sum over their planes of 2^(a + b) times the number of
rows with both bits set: an AND and a population count. All sums stay whole numbers, through
the merge of the tasks to the centring n * sum(xy) - sum(x) * sum(y); only that is divided.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.arrow import record_batch
from ledgerlake.llm.tables import written

SCALE = 64
COMPONENTS = 16
BLOCK_ROWS = 4_096
# Whole numbers of any size travel as signed parts of this many bits, which Spark can sum.
PART_BITS, PARTS = 30, 6
LARGEST = float(1 << 62)  # entries whose scaled value is beyond have no whole number


def whole_numbers(vector: str, scale: int) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale))


def usable(vector: str, scale: int) -> Column:
    """Vectors with entries, all of them finite and within the range of whole numbers."""
    within = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < LARGEST)
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, within)


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows of a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def bit_planes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed planes of non-negative rows, the dimension of each plane and its bit."""
    n, dims = rows.shape
    packed, owner, bits = [], [], []
    for bit in range(int(rows.max(initial=0)).bit_length()):
        plane = (rows >> bit) & 1
        used = np.flatnonzero(plane.any(axis=0))
        packed.append(np.packbits(plane[:, used].astype(np.uint8), axis=0).T)
        owner.append(used)
        bits.append(np.full(len(used), bit))
    if not packed:
        none = np.zeros(0, np.int64)
        return np.zeros((0, 0), np.uint64), none, none
    planes = np.concatenate(packed)
    words = np.zeros((len(planes), -(-planes.shape[1] // 8) * 8), np.uint8)
    words[:, : planes.shape[1]] = planes
    return words.view(np.uint64), np.concatenate(owner), np.concatenate(bits)


def scatter(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums and cross-products of the columns of `rows`, as Python integers."""
    n, dims = rows.shape
    low = rows.min(axis=0)
    planes, owner, bits = bit_planes((rows - low).astype(np.uint64))
    weights = np.array([1 << int(b) for b in bits], object)
    sums = np.zeros(dims, object)
    np.add.at(sums, owner, np.bitwise_count(planes).sum(axis=1, dtype=np.int64).astype(object) * weights)
    products = np.zeros((dims, dims), object)
    wide = 2 * int(bits.max(initial=0)) + n.bit_length() + 2 * len(planes).bit_length() >= 63
    kind = object if wide else np.int64
    weighing = np.zeros((len(planes), dims), kind)
    weighing[np.arange(len(planes)), owner] = weights.astype(kind)
    if len(planes):
        both = np.empty((len(planes), len(planes)), np.int64)
        for k, plane in enumerate(planes):
            both[k, k:] = np.bitwise_count(planes[k:] & plane).sum(axis=1, dtype=np.int64)
            both[k:, k] = both[k, k:]
        products = (weighing.T @ (both.astype(kind) @ weighing)).astype(object)
    low = low.astype(object)
    # Back from the shifted entries to the given ones.
    products = products + np.outer(low, sums) + np.outer(sums, low) + n * np.outer(low, low)
    return sums + n * low, products


def parts_of(number: int) -> list[int]:
    sign, size = (-1, -number) if number < 0 else (1, number)
    return [sign * (size >> PART_BITS * k & (1 << PART_BITS) - 1) for k in range(PARTS)]


def scatter_batches(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Per task one row for each cross-product (i <= j), each sum (i, -1) and the count (-1, -1)."""
    n, sums, products = 0, 0, 0
    for batch in batches:
        rows = matrix(batch.column(0))
        for begin in range(0, len(rows), BLOCK_ROWS):
            block = rows[begin : begin + BLOCK_ROWS]
            block_sums, block_products = scatter(block)
            n, sums, products = n + len(block), sums + block_sums, products + block_products
    if n == 0:
        return
    i, j = np.triu_indices(len(sums))
    numbers = [n, *sums, *products[i, j]]
    first = np.concatenate([[-1], np.arange(len(sums)), i])
    second = np.concatenate([[-1], np.full(len(sums), -1), j])
    parts = np.array([parts_of(int(x)) for x in numbers], np.int64)
    yield record_batch(schema, [first, second, *parts.T])


@dataclass
class Moments:
    """Count, sums and cross-products of the fit list: whole numbers without rounding."""

    n: int
    sums: np.ndarray
    products: np.ndarray

    @property
    def dims(self) -> int:
        return len(self.sums)

    def covariance(self) -> np.ndarray:
        centred = self.n * self.products - np.outer(self.sums, self.sums)
        return np.array([[int(c) / self.n**2 for c in row] for row in centred], float)


def moments(vectors: DataFrame, dims: int) -> Moments:
    """Moments of all rows of a one-column table of whole-number vectors of length `dims`.

    A task gives dims * (dims + 1) / 2 numbers and Spark adds them up, so the driver gets as
    many, whatever the number of rows.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ddl = "i int, j int, " + ", ".join(f"p{k} bigint" for k in range(PARTS))
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    partial_sums = vectors.mapInArrow(partial(scatter_batches, schema=schema), ddl)
    totals = partial_sums.groupBy("i", "j").agg(*(F.sum(f"p{k}").alias(f"p{k}") for k in range(PARTS)))
    found = Moments(0, np.zeros(dims, object), np.zeros((dims, dims), object))
    for i, j, *parts in totals.collect():
        number = sum(part << PART_BITS * k for k, part in enumerate(parts))
        if i < 0:
            found.n = number
        elif j < 0:
            found.sums[i] = number
        else:
            found.products[i, j] = found.products[j, i] = number
    return found


def principal(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The largest eigenvalues with their unit vectors as columns, and the trace.

    Directions in which the rows do not vary beyond rounding have no component.
    """
    trace = float(np.trace(covariance))
    if not trace > 0:
        return np.zeros(0), np.zeros((len(covariance), 0)), trace
    # Scaled by its trace, so that huge entries stay within the range of doubles.
    values, directions = np.linalg.eigh(covariance / trace)
    values, directions = values[::-1][:most], directions[:, ::-1][:, :most]
    varies = values > len(covariance) * np.finfo(float).eps * values[0]
    return values[varies] * trace, directions[:, varies], trace


@dataclass
class Whitener:
    n: int
    sums: np.ndarray
    weights: np.ndarray  # unit vectors divided by the root of their eigenvalue, as columns

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """n * x - sums, in Python integers where 64 bits may not hold it."""
        reach = max(int(rows.max(initial=0)), -int(rows.min(initial=0)))
        reach = self.n * reach + max((abs(int(s)) for s in self.sums), default=0)
        if reach < 1 << 62:
            return self.n * rows - self.sums.astype(np.int64)
        return self.n * rows.astype(object) - self.sums

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(float) @ self.weights

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        """Exact sums of squares; None where 64 bits do not hold one."""
        reach = int(np.abs(centred).max(initial=0))
        if reach <= isqrt(((1 << 63) - 1) // max(centred.shape[1], 1)):
            return (centred * centred).sum(axis=1).tolist()
        exact = centred.astype(object)
        sums = (exact * exact).sum(axis=1)
        return [int(s) if s < 1 << 63 else None for s in sums]


def gram_batches(
    batches: Iterator[pa.RecordBatch], whitener: Whitener, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Per task the whitened rows' sums (j = -1) and cross-products."""
    size = whitener.weights.shape[1]
    sums, products = np.zeros(size), np.zeros((size, size))
    for batch in batches:
        rows = matrix(batch.column(0))
        for begin in range(0, len(rows), BLOCK_ROWS):
            white = whitener.whitened(whitener.centred(rows[begin : begin + BLOCK_ROWS]))
            sums, products = sums + white.sum(axis=0), products + white.T @ white
    i, j = np.indices((size, size)).reshape(2, -1)
    yield record_batch(schema, [
        np.append(np.arange(size), i), np.append(np.full(size, -1), j),
        np.append(sums, products.ravel()),
    ])


def identity_error(vectors: DataFrame, whitener: Whitener) -> float:
    """Largest entry by which the covariance of the whitened rows differs from the identity."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ddl = "i int, j int, total double"
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    parts = vectors.mapInArrow(partial(gram_batches, whitener=whitener, schema=schema), ddl)
    size = whitener.weights.shape[1]
    mean, products = np.zeros(size), np.zeros((size, size))
    for i, j, total in parts.groupBy("i", "j").agg(F.sum("total")).collect():
        if j < 0:
            mean[i] = total / whitener.n
        else:
            products[i, j] = total / whitener.n
    return float(np.abs(products - np.outer(mean, mean) - np.eye(size)).max())


def whitened_batches(
    batches: Iterator[pa.RecordBatch], whitener: Whitener, explained: np.ndarray, error: float,
    schema: pa.Schema,
) -> Iterator[pa.RecordBatch]:
    size = len(explained)
    for batch in batches:
        for begin in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(begin, BLOCK_ROWS)
            rows = part.num_rows
            centred = whitener.centred(matrix(part.column(1)))
            deviations = pa.array(whitener.deviations(centred), pa.int64())
            each = pa.array(np.repeat(np.arange(rows), size))
            yield record_batch(schema, [
                part.column(0).take(each), np.tile(np.arange(1, size + 1), rows),
                np.full(rows * size, whitener.n), deviations.take(each),
                whitener.whitened(centred).ravel(), np.tile(explained, rows),
                np.full(rows * size, error),
            ])


def whiten(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", *,
    components: int = COMPONENTS, scale: int = SCALE,
) -> DataFrame:
    """Whitened principal components of all vectors, fitted on the distinct ones.

    An entry c counts as the whole number x = floor(scale * c); a constant added to all x would
    change no result, since each is centred. Per row and component:
    id, component (from 1, by falling eigenvalue), n (distinct vectors), deviation
    (sum over the dimensions of (n x - sum)^2, exact; NULL beyond 64 bits), whitened, explained
    (share of the variance) and identity_error.

    Left out are null and empty vectors, vectors with null or non-finite entries or with
    entries of 2^62 / scale and beyond, and, should there be vectors of several lengths, all but
    those of the most frequent length (the smallest of several). Repeated rows and null ids are
    kept and count once in the fit. A component without variance has no rows: copies of one
    vector give an empty result, and so does an empty table. Further columns play no part.

    The distinct vectors are a table in the shared folder; what the driver gets is bounded by
    the square of the dimensions, of which there are a few thousand at most.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType

    spark = vectors.sparkSession
    kind = vectors.schema[id_column].dataType
    schema = StructType([
        StructField(id_column, kind),
        *StructType.fromDDL(
            "component int, n bigint, deviation bigint, whitened double, explained double, "
            "identity_error double"
        ).fields,
    ])
    rows = vectors.select(id_column, vector_column).where(usable(vector_column, scale)).select(
        F.col(id_column), (whole_numbers(vector_column, scale)).alias("_x")
    )
    lengths = rows.groupBy(F.size("_x").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("_x") == lengths["dims"])
    distinct = written(rows.select("_x").distinct(), "distinct-vectors")
    found = moments(distinct, lengths["dims"])
    values, directions, trace = principal(found.covariance(), components)
    if not len(values):
        return spark.createDataFrame([], schema)
    whitener = Whitener(found.n, found.sums, directions / np.sqrt(values))
    error = identity_error(distinct, whitener)
    run = partial(
        whitened_batches, whitener=whitener, explained=values / trace, error=error,
        schema=to_arrow_schema(schema),
    )
    return rows.mapInArrow(run, schema)
