"""Whitening of embeddings by spectral divide and conquer.

Two passes over the vectors give exact sums and the centred covariance, summed up per task. Its
eigenvectors are found on the driver, from a matrix of the size of the dimension squared: the polar factor of the
covariance less a shift (dynamically weighted Halley steps) is the sign of the shifted matrix, which
gives the projectors on the eigenvectors above and below the shift; both subspaces are divided again until
they hold one direction, or directions of one variance, among which any basis will do. The components go to the
tasks with the code, and a third pass measures the covariance of the whitened vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanwork.llm.common import table

SCALE = 64
ORIGIN = 1_000_000
COMPONENTS = 32
#: Entries beyond this could not be told from their neighbours.
LARGEST = 2.0**52
EPS = float(np.finfo(float).eps)
#: Rows that are whitened at once.
STEP = 4096


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a square matrix, by the QR-based weighted Halley iteration.

    The lower bound of the singular values starts at the rounding error; steps with large weights use a QR
    decomposition, later ones Cholesky's.
    """
    size = len(a)
    x = a / max(math.sqrt(np.abs(a).sum(0).max() * np.abs(a).sum(1).max()), np.finfo(float).tiny)
    least, unit = EPS, np.eye(size)
    for _ in range(12):
        square = least * least
        d = (4 * (1 - square) / square**2) ** (1 / 3)
        root = math.sqrt(1 + d)
        wa = root + 0.5 * math.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([math.sqrt(wc) * x, unit]))
            following = wb / wc * x + (wa - wb / wc) / math.sqrt(wc) * (q[:size] @ q[size:].T)
        else:
            low = np.linalg.cholesky(unit + wc * (x.T @ x))
            solved = np.linalg.solve(low.T, np.linalg.solve(low, x.T)).T
            following = wb / wc * x + (wa - wb / wc) * solved
        change = np.linalg.norm(following - x)
        x, least = following, min(1.0, least * (wa + wb * square) / (1 + wc * square))
        if abs(1 - least) < 10 * EPS and change < EPS ** (1 / 3):
            break
    return x


def _shifts(a: np.ndarray):
    """Where to divide: the median variance first, then points around the mean, which lies inside the spectrum."""
    diagonal = np.diag(a)
    mean = float(diagonal.mean())
    spread = math.sqrt(max(0.0, float(np.linalg.norm(a - mean * np.eye(len(a))) ** 2) / len(a)))
    yield float(np.median(diagonal))
    for part in (0.0, 0.1, -0.1, 0.3, -0.3, 0.6, -0.6, 0.05, -0.05, 0.9, -0.9):
        yield mean + part * spread


def _divide(a: np.ndarray, noise: float) -> np.ndarray:
    """An orthogonal basis of eigenvectors of the symmetric ``a``; ``noise`` is the rounding error of its entries."""
    size = len(a)
    if size == 1 or np.linalg.norm(a - np.diag(np.diag(a))) <= noise:
        return np.eye(size)
    best = None
    for shift in _shifts(a):
        sign = polar_factor(a - shift * np.eye(size))
        upper = ((sign + sign.T) / 2 + np.eye(size)) / 2
        rank = round(float(np.trace(upper)))
        if not 0 < rank < size:
            continue
        start = np.random.default_rng(size).standard_normal((size, rank))
        first, _ = np.linalg.qr(upper @ start)
        whole, _ = np.linalg.qr(upper @ first, mode="complete")
        # What is left between the two subspaces tells how well they are divided.
        left = np.linalg.norm(whole[:, rank:].T @ a @ whole[:, :rank])
        if best is None or left < best[0]:
            best = (left, whole, rank)
        if left <= noise:
            break
    if best is None:  # the spectrum is one point, but for rounding
        return np.eye(size)
    _, whole, rank = best
    parts = []
    for basis in (whole[:, :rank], whole[:, rank:]):
        inner = basis.T @ a @ basis
        parts.append(basis @ _divide((inner + inner.T) / 2, noise))
    return np.hstack(parts)


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors (columns) of a symmetric matrix, to double precision."""
    a = (a + a.T) / 2
    basis = _divide(a, 4 * len(a) * EPS * float(np.linalg.norm(a)))
    for _ in range(2):
        # A correction of the first order, where the values are apart; then the basis is made orthogonal again.
        inner = basis.T @ a @ basis
        values = np.diag(inner)
        apart = values[None, :] - values[:, None]
        near = np.abs(apart) <= 1e-6 * max(np.abs(values).max(), np.finfo(float).tiny)
        turn = np.where(near, 0.0, (inner + inner.T) / 2 / np.where(near, 1.0, apart))
        np.fill_diagonal(turn, 0.0)
        basis, upper = np.linalg.qr(basis + basis @ turn)
        basis = basis * np.sign(np.diag(upper))
    values = np.einsum("ij,ij->j", basis, a @ basis)
    order = np.argsort(-values, kind="stable")
    return values[order], basis[:, order]


def _whole_numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows that remain, their numbers of entries, and their entries as whole numbers, one row each.

    Shorter vectors end in entries of 0.
    """
    lengths = column.value_lengths().fill_null(0).to_numpy()
    there = column.is_valid().to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    lengths = np.where(there, lengths, 0)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    keep = there.copy()
    keep[owner[~np.isfinite(values)]] = False
    kept = keep[owner]
    scaled = np.floor(SCALE * values[kept])
    if len(scaled) and np.abs(scaled).max() >= LARGEST:
        raise ValueError("an entry of a vector is too large for exact sums")
    rows, sizes = np.flatnonzero(keep), lengths[keep]
    whole = np.full((len(rows), int(sizes.max(initial=0))), ORIGIN, np.int64)
    whole[np.arange(whole.shape[1]) < sizes[:, None]] = scaled.astype(np.int64) + ORIGIN
    return rows, sizes, whole


SUMS = pa.schema([("i", pa.int32()), ("total", pa.int64()), ("rows", pa.int64())])
MOMENTS = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("value", pa.float64())])


def _sum_entries(batches):
    """Sum and number of the entries of each place; place -1 counts the vectors."""
    for batch in batches:
        rows, sizes, whole = _whole_numbers(batch.column(0))
        width = whole.shape[1]
        counts = (np.arange(width) < sizes[:, None]).sum(axis=0)
        totals = whole.sum(axis=0) - (len(rows) - counts) * ORIGIN
        columns = [np.arange(-1, width, dtype=np.int32), np.append(0, totals), np.append(len(rows), counts)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SUMS)], schema=SUMS)


class Centre:
    """Exact sums of ``n`` whole vectors: their mean as a whole number and a rest below one."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.floor = np.asarray([s // n for s in sums], np.int64)
        self.rest = [s % n for s in sums]
        self.part = np.asarray([r / n for r in self.rest])

    def offsets(self, whole: np.ndarray) -> np.ndarray:
        """The vectors less the whole part of the mean."""
        if whole.shape[1] < len(self.floor):
            more = np.full((len(whole), len(self.floor) - whole.shape[1]), ORIGIN, np.int64)
            whole = np.hstack([whole, more])
        return whole - self.floor

    def deviations(self, offsets: np.ndarray) -> list[int | None]:
        """``sum((n * x - S) ** 2)`` of each vector, exact; None beyond 64 bits."""
        largest = int(np.abs(offsets).max(initial=0))
        safe = largest * max(largest, self.n) * max(1, len(self.rest)) < 2**62
        exact = offsets if safe else offsets.astype(object)
        squares = (exact * exact).sum(axis=1).tolist()
        crosses = (exact @ np.asarray(self.rest, np.int64 if safe else object)).tolist()
        rest = sum(r * r for r in self.rest)
        found = [self.n * (self.n * square - 2 * cross) + rest for square, cross in zip(squares, crosses)]
        return [value if value < 2**63 else None for value in found]


def _moments(centre: Centre, components: np.ndarray | None):
    """Sums of the products of the centred entries, or of the whitened ones with their sums as row -1."""

    def run(batches):
        total, sums, n = 0.0, 0.0, 0
        for batch in batches:
            _, _, whole = _whole_numbers(batch.column(0))
            centred = centre.offsets(whole) - centre.part
            if components is not None:
                centred = centred @ components
            total, sums, n = total + centred.T @ centred, sums + centred.sum(axis=0), n + len(centred)
        if n:
            i, j = np.triu_indices(len(total))
            columns = [np.append(i, [-1] * len(sums)), np.append(j, np.arange(len(sums))), np.append(total[i, j], sums)]
            yield pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip(columns, MOMENTS)], schema=MOMENTS)

    return run


def _covariance(vectors: DataFrame, centre: Centre, components: np.ndarray | None = None) -> np.ndarray:
    size = len(centre.floor) if components is None else components.shape[1]
    sums = vectors.mapInArrow(_moments(centre, components), "i int, j int, value double")
    products, mean = np.zeros((size, size)), np.zeros(size)
    for row in sums.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        if row["i"] < 0:
            mean[row["j"]] = row["value"] / centre.n
        else:
            products[row["i"], row["j"]] = products[row["j"], row["i"]] = row["value"] / centre.n
    return products - np.outer(mean, mean)


def _whiten_rows(centre: Centre, sent, explained: np.ndarray, error: float, schema: pa.Schema):
    """``sent``: the scaled components, broadcast."""
    many = len(explained)

    def run(batches):
        components = sent.value
        for batch in batches:
            rows, _, whole = _whole_numbers(batch.column(1))
            for at in range(0, len(rows), STEP):
                offsets = centre.offsets(whole[at : at + STEP])
                here = len(offsets)
                whitened = (offsets - centre.part) @ components
                columns = [
                    batch.column(0).take(pa.array(np.repeat(rows[at : at + STEP], many))),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), here)),
                    pa.array(np.full(here * many, centre.n)),
                    pa.array(centre.deviations(offsets), pa.int64()).take(pa.array(np.repeat(np.arange(here), many))),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, here)),
                    pa.array(np.full(here * many, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def whiten(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per vector and component.

    Vectors that are null or hold a null, an infinity or NaN are left out; all others are fitted and whitened,
    repeated ones and those with a null id too. A vector shorter than the longest one counts as if it ended in zeros.
    Components without variance (beyond the rounding error) are left out, as nothing can give them the variance
    1: with fewer vectors than dimensions, or equal ones, there are fewer components, or none and so no rows.
    ``deviation`` is null where it exceeds 64 bits. An entry of 2 ** 46 or more in size raises an error.

    The driver gets one number per pair of dimensions, whatever the number of vectors.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    only = rows.select("embedding")
    sums = only.mapInArrow(_sum_entries, "i int, total long, rows long").groupBy("i").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("rows").alias("rows")
    )
    found = {row["i"]: (int(row["total"]), row["rows"]) for row in sums.collect()}
    n = found.pop(-1, (0, 0))[1]
    schema = T.StructType(
        [
            T.StructField("vec_id", rows.schema["vec_id"].dataType), T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    if not n or not found:
        return spark.createDataFrame([], schema)
    centre = Centre(n, [found[i][0] + (n - found[i][1]) * ORIGIN for i in range(len(found))])
    covariance = _covariance(only, centre)
    values, basis = eigenvectors(covariance)
    trace = float(np.trace(covariance))
    many = min(components, int((values > len(values) * EPS * max(trace, np.finfo(float).tiny)).sum()))
    if not many:
        return spark.createDataFrame([], schema)
    scaled = basis[:, :many] / np.sqrt(values[:many])
    error = float(np.abs(_covariance(only, centre, scaled) - np.eye(many)).max())
    sent = spark.sparkContext.broadcast(scaled)
    run = _whiten_rows(centre, sent, values[:many] / trace, error, to_arrow_schema(schema))
    return rows.mapInArrow(run, schema)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


BOOK = {"op12_embedding_whitening": (op12_embedding_whitening, None)}
