"""Whitening of embeddings on exact integer cross-products from bit-sliced popcounts.

Entries become integers x = floor(``SCALE`` * c) + ``SHIFT``. One pass gathers the count, the sums S and
the cross-products P of all vectors, exactly:

* A block of rows is shifted by each dimension's smallest x in it. Bit b of a dimension, over all
  rows, is packed into 64-bit words: its bit plane.
* Planes i, b and j, c share popcount(AND) rows in which both bits are set; weighted by 2**(b + c) and
  added up these are the block's cross-products. The shift is undone on exact integers.
* Tasks emit one row per pair of dimensions; Spark adds them as decimals. The driver gets D * (D + 1) / 2
  integers, whatever the number of vectors.

The covariance is (n * P - S S') / n**2, divided only after the exact subtraction, and its eigenvectors
give the components. A second pass projects every vector.

Defined cases: vectors that are null or hold null, NaN or infinite entries are dropped; the remaining
vectors of the most frequent length (of equally frequent ones the longest) are fitted and returned,
others have no covariance with them and are dropped too; x stays within +-2**52 (entries beyond
2**46 count as that); repeated rows count as often as they are there; null ids are kept; a table
without a remaining vector gives an empty result; a component without variance (an eigenvalue under D *
2**-52 of the largest) has whitened 0 and is left out of identity_error; a deviation that no long can hold is
null; other columns are ignored.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ordertide.llm.shared import saved

#: Fixed values of the contract: entries are scaled and shifted to integers; components that are returned.
SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Rows whose bit planes are packed at a time.
BLOCK = 1 << 12
#: Bound of the integers, so that 128-bit sums hold.
MOST = 1 << 52
#: Bytes of planes that one popcount step may expand to.
STEP_BYTES = 1 << 24


def integers(array):
    """x of a float array, within +-MOST."""
    return np.clip(np.floor(array * float(SCALE)), -MOST, MOST).astype(np.int64) + SHIFT


def matrices(batch):
    """(row numbers, matrix of doubles) of the vectors of column 1 that count, by their length."""
    lists = batch.column(1)
    lists = lists.cast(pa.large_list(pa.float64()))
    flat = lists.flatten()
    sizes = np.diff(lists.offsets.to_numpy())
    valid = np.array(lists.is_valid())
    sizes = np.where(valid, sizes, 0)
    values = flat.to_numpy(zero_copy_only=False)  # nulls become NaN
    first = np.concatenate(([0], np.cumsum(sizes)))
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    good = valid & (bad[first[1:]] == bad[first[:-1]]) & (sizes > 0)
    for size in np.unique(sizes[good]).tolist():
        rows = np.flatnonzero(good & (sizes == size))
        yield rows, values[first[rows][:, None] + np.arange(size)]


def bit_planes(x):
    """Packed planes of a matrix of non-negative integers: (dimension, bit, words by plane), without empty planes."""
    n, dims = x.shape
    room = np.zeros((-(-n // 64) * 64, dims), np.int64)
    room[:n] = x
    owner, weight, planes = [], [], []
    for b in range(int(x.max()).bit_length()):
        bits = ((room >> b) & 1).astype(np.uint8)
        held = np.flatnonzero(bits.any(axis=0))
        packed = np.packbits(bits[:, held].T, axis=1, bitorder="little")
        planes.append(np.ascontiguousarray(packed).view(np.uint64))
        owner.append(held)
        weight.append(np.full(len(held), b))
    if not planes:
        return np.zeros(0, int), np.zeros(0, int), np.zeros((0, len(room) // 64), np.uint64)
    return np.concatenate(owner), np.concatenate(weight), np.concatenate(planes)


def cross_products(x):
    """Sums and cross-products of a matrix of integers as exact Python integers (object arrays)."""
    n, dims = x.shape
    low = x.min(axis=0)
    owner, weight, planes = bit_planes(x - low)
    counts = np.array([int(v) for v in np.bitwise_count(planes).sum(axis=1)], object)
    rest = np.zeros(dims, object)
    np.add.at(rest, owner, counts << weight.astype(object))
    out = np.zeros((dims, dims), object)
    step = max(1, STEP_BYTES // max(1, planes.nbytes))
    small = 2 * int(weight.max(initial=0)) + n.bit_length() + 8 < 62
    kind = np.int64 if small else object
    by_dim = np.zeros((len(owner), dims), kind)  # 2**bit at (plane, its dimension)
    by_dim[np.arange(len(owner)), owner] = np.left_shift(1, weight) if small else [1 << int(w) for w in weight]
    for at in range(0, len(owner), step):
        here = slice(at, at + step)
        shared = np.bitwise_count(planes[here, None, :] & planes[None, :, :]).sum(axis=2, dtype=np.int64)
        out += (by_dim[here].T @ (shared.astype(kind) @ by_dim)).astype(object)
    low = low.astype(object)
    shifted = np.outer(low, rest)
    return rest + low * n, out + shifted + shifted.T + n * np.outer(low, low)


@dataclass
class Whitening:
    """Exact moments of the fitted vectors and the components of their covariance."""

    n: int
    sums: list
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float


def model_of(n, sums, products):
    """The whitening of n vectors with these exact sums and cross-products."""
    dims = len(sums)
    v = np.empty((dims, dims))
    for i in range(dims):
        for j in range(dims):
            v[i, j] = (n * products[i][j] - sums[i] * sums[j]) / n**2  # of integers: rounded once
    values, vectors = np.linalg.eigh(v)
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    held = values > values[0] * dims * 2.0**-52
    scale = np.where(held, 1 / np.sqrt(np.where(held, values, 1)), 0)
    whitened = (vectors * scale).T @ v @ (vectors * scale)
    top = min(dims, COMPONENTS)
    off = (whitened - np.diag(held.astype(float)))[:top, :top]
    trace = np.trace(v)
    explained = values / trace if trace > 0 else np.zeros(dims)
    return Whitening(n, sums, values[:top], (vectors * scale)[:, :top], explained[:top], float(np.abs(off).max()))


def fit(rows, column):
    """The ``Whitening`` of all vectors of a column, or None without any."""

    def run(batches):
        total = {}
        for batch in batches:
            for _, matrix in matrices(batch):
                for at in range(0, len(matrix), BLOCK):
                    x = integers(matrix[at : at + BLOCK])
                    sums, products = cross_products(x)
                    n, s, p = total.get(x.shape[1], (0, 0, 0))
                    total[x.shape[1]] = (n + len(x), s + sums, p + products)
        for dims, (n, sums, products) in total.items():
            high, low = np.triu_indices(dims)
            values = [n, *sums, *products[high, low]]
            first = [-1] * (1 + dims) + high.tolist()
            second = [-1, *range(dims), *low.tolist()]
            columns = [[dims] * len(values), first, second]
            columns = [pa.array(c, pa.int32()) for c in columns]
            columns.append(pa.array([str(v) for v in values]))
            yield pa.RecordBatch.from_arrays(columns, ["dims", "i", "j", "v"])

    parts = rows.select(F.lit(0).alias("at"), F.col(column).alias("v"))
    parts = parts.mapInArrow(run, "dims int, i int, j int, v string")
    parts = parts.groupBy("dims", "i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    parts = saved(parts, "cross-products")
    counts = parts.where("i = -1 AND j = -1").orderBy(F.desc("v"), F.desc("dims")).first()
    if counts is None:
        return None
    dims = counts.dims
    got = {(r.i, r.j): int(r.v) for r in parts.where(F.col("dims") == dims).collect()}
    products = [[got[min(i, j), max(i, j)] for j in range(dims)] for i in range(dims)]
    return model_of(got[-1, -1], [got[-1, j] for j in range(dims)], products)


def project(rows, column, model):
    """The rows whose vector counts, with ``deviation`` and ``whitened`` (one double per component)."""
    names = [c for c in rows.columns if c not in ("deviation", "whitened")]
    kept = rows.select(F.struct(*[rows[c] for c in names]).alias("row"), rows[column].alias("v"))
    kinds = kept.schema["row"].dataType
    if model is None:
        out = kept.where(F.lit(False)).select("row.*")
        return out.select("*", F.lit(0).cast("long").alias("deviation"), F.array(F.lit(0.0)).alias("whitened"))
    model = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        fitted = model.value
        sums = np.array(fitted.sums, object)
        for batch in batches:
            for at, matrix in matrices(batch):
                if matrix.shape[1] != len(sums):
                    continue
                x = integers(matrix)
                if int(np.abs(x).max()) * fitted.n + int(np.abs(sums).max()) >= 1 << 62:
                    x = x.astype(object)
                centred = x * fitted.n - (sums if x.dtype == object else sums.astype(np.int64))
                exact = centred
                if len(sums) * int(np.abs(centred).max()) ** 2 >= 1 << 63:
                    exact = centred.astype(object)
                deviation = (exact * exact).sum(axis=1).tolist()
                deviation = [d if d < 1 << 63 else None for d in deviation]
                whitened = (centred / fitted.n).astype(float) @ fitted.vectors
                parts = [
                    batch.column(0).take(pa.array(at)),
                    pa.array(deviation, pa.int64()),
                    pa.array(list(whitened), pa.list_(pa.float64())),
                ]
                yield pa.RecordBatch.from_arrays(parts, ["row", "deviation", "whitened"])

    schema = f"row {kinds.simpleString()}, deviation bigint, whitened array<double>"
    return kept.mapInArrow(run, schema).select("row.*", "deviation", "whitened")


def whitening_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    model = fit(rows, "embedding")
    out = project(rows, "embedding", model).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")
    )
    explained = F.array(*[F.lit(float(e)) for e in model.explained]) if model else F.array(F.lit(0.0))
    return out.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )
