"""Embedding whitening over exact, bit-sliced cross-products.

Every entry c becomes the integer x = floor(1024 * c) + 100000.  The covariance
of x needs the sums of products of all pairs of dimensions; they are taken from
bit planes:

1. One pass gives the row count and each dimension's smallest and largest x.
2. Less its dimension's smallest value, x is a non-negative integer of few
   bits.  A task packs bit b of dimension d over its rows, 64 rows to a machine
   word (a plane).  The sum over rows of x_i * x_j is the sum over pairs of
   planes of 2^(a+b) * popcount(plane_ia AND plane_jb), and the sum of x_i that
   of 2^a * popcount(plane_ia): integers, exact in any order and number of
   tasks.  Spark adds the tasks' sums as decimals.
3. The driver, which gets dims * (dims + 3) / 2 numbers whatever the number of
   rows, centres them as integers (n * sum(xy) - sum(x) * sum(y)) and only then
   divides, so `eigh` sees a covariance correctly rounded in every entry.
4. A last pass projects the rows.  `identity_error` is measured on the whitened
   values as they are returned.

Rows whose vector is null, has no entries or holds null or non-finite entries
are left out; null or repeated ids and repeated vectors are rows like any
other.  Vectors of several lengths are an error.  Components without variance
(less than 1e-12 of the largest eigenvalue) cannot be whitened and are left
out, so one row alone, or equal rows, give no rows; an empty table gives an
empty one.  Other columns, whatever their names, are not read.  Entries up to
2^52 / 1024 in size are exact; larger ones raise an error.  A deviation beyond
a signed 64-bit integer (it grows with the square of n) is null, never rounded.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, stored, table

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
# Plane bits (rows x planes) that are packed at a time.
PACKED = 1 << 25
NO_VARIANCE = 1e-12


def finite(df: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector has entries, all of them finite numbers."""
    v = F.col(vector)
    ok = F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return df.where(v.isNotNull() & (F.size(v) > 0) & ok)


def _integers(column: pa.Array, dims: int | None) -> np.ndarray:
    """A column of vectors as rows of integers x."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    if len(flat) != len(column) * (dims or len(flat) // max(1, len(column))) or len(set(np.diff(column.offsets))) > 1:
        raise ValueError("vectors of several lengths")
    scaled = np.floor(flat * SCALE)
    if len(scaled) and np.abs(scaled).max() > 2.0 ** 52:
        raise OverflowError("an entry is too large for exact integers")
    return scaled.astype("int64").reshape(len(column), -1) + SHIFT


def value_ranges(df: DataFrame, vector: str) -> list[tuple[int, int, int]]:
    """(n, smallest, largest x) of every dimension; empty without rows."""
    def ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, None, None
        for batch in batches:
            if len(batch):
                x = _integers(batch.column(0), None if low is None else len(low))
                n += len(x)
                low = x.min(0) if low is None else np.minimum(low, x.min(0))
                high = x.max(0) if high is None else np.maximum(high, x.max(0))
        if n:
            yield pa.RecordBatch.from_pydict({"dim": np.arange(len(low)), "n": np.full(len(low), n), "low": low, "high": high})

    parts = df.select(vector).mapInArrow(ranges, "dim bigint, n bigint, low bigint, high bigint")
    rows = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect()
    rows = [(r.n, r.low, r.high) for r in sorted(rows, key=lambda r: r.dim)]
    if len({n for n, _, _ in rows}) > 1:
        raise ValueError("vectors of several lengths")
    return rows


def packed_planes(y: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Rows of non-negative integers -> one row of 64-bit words per (dimension,
    bit), dimension by dimension, lowest bit first; absent rows are zero."""
    planes = np.empty((int(bits.sum()), len(y)), bool)
    at = 0
    for d, b in enumerate(bits):
        planes[at:at + b] = (y[:, d] >> np.arange(b)[:, None]) & 1
        at += b
    packed = np.packbits(planes, axis=1, bitorder="little")
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view("<u8")


def plane_counts(words: np.ndarray) -> np.ndarray:
    """popcount(plane_p AND plane_q) of all pairs p <= q (upper triangle)."""
    out = np.zeros((len(words), len(words)), "int64")
    for p in range(len(words)):
        out[p, p:] = np.bitwise_count(words[p] & words[p:]).sum(axis=1, dtype="int64")
    return out


def scatter(df: DataFrame, vector: str, ranges: list[tuple[int, int, int]]) -> DataFrame:
    """(i, j, s), i <= j: the exact sums over all rows of y_i * y_j, and with
    j = -1 those of y_i, where y = x less the dimension's smallest x."""
    low = np.array([lo for _, lo, _ in ranges], "int64")
    bits = np.array([max(1, int(hi - lo).bit_length()) for _, lo, hi in ranges])
    dim_of = np.repeat(np.arange(len(bits)), bits)
    bit_of = np.concatenate([np.arange(b) for b in bits])
    full = max(64, PACKED // len(dim_of))  # rows

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(dim_of), len(dim_of)), "int64")
        held, size, some = [], 0, False
        for batch in chain(batches, [None]):
            if batch is not None:
                held.append(_integers(batch.column(0), len(low)) - low)
                size += len(batch)
            if size >= (full if batch is not None else 1):
                counts += plane_counts(packed_planes(np.concatenate(held), bits))
                held, size, some = [], 0, True
        if not some:
            return
        both = counts + np.triu(counts, 1).T  # every ordered pair of planes
        rows = []
        for i in range(len(low)):
            a = dim_of == i
            rows.append((i, -1, sum(int(c) << int(k) for c, k in zip(np.diag(counts)[a], bit_of[a]))))
            for j in range(i, len(low)):
                block = both[np.ix_(a, dim_of == j)]
                rows.append((i, j, sum(int(c) << (p + q) for p, line in enumerate(block) for q, c in enumerate(line))))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                          pa.array([r[2] for r in rows], pa.decimal128(38, 0))], ["i", "j", "s"])

    parts = df.select(vector).mapInArrow(sums, "i int, j int, s decimal(38,0)")
    return parts.groupBy("i", "j").agg(F.sum("s").cast("decimal(38,0)").alias("s"))


@dataclass
class Whitening:
    """The model: row count, the sums of x, the components (one a row, by
    falling eigenvalue), their eigenvalues and their shares of the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    widest: int  # the largest |n * x - S|


def fitted(df: DataFrame, vector: str, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all rows of `df`; None without rows."""
    small_batches(df.sparkSession)
    ranges = value_ranges(df, vector)
    if not ranges:
        return None
    n, dims = ranges[0][0], len(ranges)
    s = {(r.i, r.j): int(r.s) for r in scatter(df, vector, ranges).collect()}  # dims * (dims + 3) / 2 rows
    v = np.empty((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            v[i, j] = v[j, i] = (n * s[i, j] - s[i, -1] * s[j, -1]) / (n * n)  # integers divided once
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    good = [k for k in range(min(components, dims)) if e[k] > max(0.0, NO_VARIANCE * e[0])]
    sums = [s[i, -1] + n * lo for i, (_, lo, _) in enumerate(ranges)]
    widest = max(max(abs(n * lo - t), abs(n * hi - t)) for (_, lo, hi), t in zip(ranges, sums))
    return Whitening(n, sums, u[:, good].T.copy(), e[good], e[good] / np.trace(v), widest)


def whitened(df: DataFrame, vector: str, model: Whitening, out: str = "whitened", deviation: str = "deviation") -> DataFrame:
    """`df` with `out` (array<double>: a value per component) and `deviation`
    (the sum over dimensions of (n * x - S)^2).  Both must be new columns."""
    if {out.lower(), deviation.lower()} & {c.lower() for c in df.columns}:
        raise ValueError(f"the input already has a column {out} or {deviation}")
    n, sums = model.n, np.array(model.sums, dtype=object)
    whole, part = np.array([int(t) // n for t in model.sums], "int64"), np.array([int(t) % n / n for t in model.sums])
    project = (model.components / np.sqrt(model.eigenvalues)[:, None]).T
    narrow = model.widest ** 2 * len(model.sums) < 2 ** 63
    place, names = df.columns.index(vector), [*df.columns, out, deviation]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _integers(batch.column(place), len(whole))
            if narrow:
                far = x * n - sums.astype("int64")
            else:  # too wide for 64 bits on the way: Python integers
                far = x.astype(object) * n - sums
            total = (far * far).sum(axis=1)
            values = ((x - whole) - part) @ project
            column = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), max(1, project.shape[1])).cast(pa.list_(pa.float64())) \
                if project.shape[1] else pa.array([[]] * len(x), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column, pa.array([t if t < 1 << 63 else None for t in total.tolist()], pa.int64())], names)

    schema = df.select("*", F.lit(None).cast("array<double>").alias(out), F.lit(None).cast("bigint").alias(deviation)).schema
    return df.mapInArrow(rows, schema)


def identity_error(df: DataFrame, whitened_col: str, k: int) -> float:
    """The largest absolute entry of the covariance of the whitened values
    minus the identity.  Every batch centres its rows before it multiplies;
    the batches' sums and means are joined by Spark."""
    def moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            if len(w):
                mean = w.mean(0)
                m = (w - mean).T @ (w - mean) + len(w) * np.outer(mean, mean)
                i, j = np.triu_indices(k)
                yield pa.RecordBatch.from_pydict({"i": i, "j": j, "n": np.full(len(i), len(w)), "a": len(w) * mean[i],
                                                  "b": len(w) * mean[j], "m": m[i, j]})

    parts = df.select(whitened_col).mapInArrow(moments, "i bigint, j bigint, n bigint, a double, b double, m double")
    total = F.sum("n")
    cov = F.sum("m") / total - F.sum("a") / total * (F.sum("b") / total)
    err = F.abs(cov - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    return parts.groupBy("i", "j").agg(err.alias("err")).agg(F.max("err")).first()[0]


SCHEMA = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error)
    of every usable vector and component; a null id stays null."""
    rows = finite(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding")
    model = fitted(rows, "embedding")
    if model is None or not len(model.eigenvalues):
        return spark.createDataFrame([], SCHEMA)
    done = stored(whitened(rows, "embedding", model).drop("embedding"), "whitened")
    error = identity_error(done, "whitened", len(model.eigenvalues))
    share = F.array(*[F.lit(float(x)) for x in model.explained])
    out = done.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(F.col("vec_id").cast("bigint"), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"),
                      "deviation", "whitened", F.element_at(share, F.col("at") + 1).alias("explained"),
                      F.lit(float(error)).alias("identity_error"))
