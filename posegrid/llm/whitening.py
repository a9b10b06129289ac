"""Operator 12: whitening of embeddings by their leading principal components.

Entries become whole numbers first (``floor(64 * entry) + 1000000``). The fit list holds each distinct vector once.
Its sums are exact; the covariance is a distributed sum of products of vectors that were centred first, by the mean's
nearest whole number, which keeps the products exact, and the rest of the mean is taken off after. One task per vector
length, whose input is the square matrix alone, takes it to tridiagonal form by Householder reflections, finds the
leading eigenvalues by bisection on Sturm counts, their vectors by inverse iteration, reorthogonalised within
clusters of close eigenvalues, and turns them back. The components (``TOP`` vectors of one length) go to all tasks;
the projection is a map. A last distributed sum over the fit list measures how far the whitened covariance is from
the identity.

Scale: one shuffle of distinct vectors, pre-aggregated in the maps, so a vector that a third of all rows share is a
row per task; then a square matrix per task. The distinct vectors and the models are tables in the shared folder, so
every row sees the same signs. The driver holds the models, at most ``MODEL_BYTES``.

Results for odd inputs: a vector that is null or empty, or that holds a null, a NaN, an infinity or an entry of
2^53 or more, is dropped; vectors of each length are a fit list of their own; rows that share an id or a vector
each have their result; a null id stays; components are those with an eigenvalue above the rounding of the
largest, so where all vectors are equal there are none and no rows; equal eigenvalues have some orthogonal basis of
their space; a deviation beyond a long is null; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from posegrid.llm.common import written

TOP = 16
SCALE, SHIFT = 64, 1_000_000
#: whole numbers are exact in doubles below this
EXACT = float(1 << 53)
#: eigenvalues nearer than this share of the matrix's norm are a cluster
CLUSTER = 1e-3
MODEL_BYTES = 64 << 20
#: rows of which one task sums products at once
ROWS = 4096


# ------------------------------------------------------------------ eigenvalues of a symmetric matrix

def householder(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and side diagonal of the tridiagonal matrix that is similar to ``matrix``, and the unit vectors of the
    reflections, first one first; reflection k leaves the first k + 1 places alone."""
    a = matrix.copy()
    size = len(a)
    mirrors = []
    for k in range(size - 2):
        column = a[k + 1:, k]
        length = np.linalg.norm(column)
        v = column.copy()
        v[0] += np.copysign(length, v[0])
        norm = np.linalg.norm(v)
        if norm == 0 or not np.any(column[1:]):
            mirrors.append(np.zeros(size - k - 1))
            continue
        v /= norm
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1, k] = -np.copysign(length, column[0])
        mirrors.append(v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), mirrors


def turned_back(vectors: np.ndarray, mirrors: list[np.ndarray]) -> np.ndarray:
    """Columns ``vectors`` of the tridiagonal matrix as vectors of the first one."""
    out = vectors.copy()
    for k in range(len(mirrors) - 1, -1, -1):
        v = mirrors[k]
        out[k + 1:] -= 2 * np.outer(v, v @ out[k + 1:])
    return out


def sturm_counts(diagonal: np.ndarray, side: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues are smaller than each of ``at``: negative terms of the Sturm sequence."""
    floor = np.finfo(float).tiny ** 0.5
    squares = side * side
    below = np.zeros(len(at), np.int64)
    q = np.inf
    for i in range(len(diagonal)):
        q = diagonal[i] - at - (squares[i - 1] if i else 0.0) / q
        q = np.where(np.abs(q) < floor, -floor, q)
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, side: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, each bisected until its ends are neighbours or equal in the double
    sense of the matrix's norm."""
    size = len(diagonal)
    around = np.concatenate(([0.0], np.abs(side), [0.0]))
    radius = around[:-1] + around[1:]
    low = np.full(count, (diagonal - radius).min())
    high = np.full(count, (diagonal + radius).max())
    reach = max(abs(low[0]), abs(high[0]))
    low -= reach * 1e-12
    high += reach * 1e-12
    wanted = size - np.arange(count)  # so many eigenvalues lie at or below the k-th largest
    while True:
        middle = (low + high) / 2
        open_ = (middle > low) & (middle < high) & (high - low > np.finfo(float).eps * np.maximum(np.abs(middle), 1e-8 * reach))
        if not open_.any():
            return middle
        full = sturm_counts(diagonal, side, middle) >= wanted
        high = np.where(open_ & full, middle, high)
        low = np.where(open_ & ~full, middle, low)


def solved(diagonal: np.ndarray, side: np.ndarray, value: float, right: np.ndarray, least: float) -> np.ndarray:
    """Solution of (T - value) x = right by elimination with row exchanges; pivots are at least ``least``."""
    size = len(diagonal)
    d, e = (diagonal - value).tolist(), side.tolist() + [0.0]
    b = right.tolist()
    upper = [[0.0, 0.0, 0.0] for _ in range(size)]
    row = [d[0], e[0], 0.0]
    for i in range(size - 1):
        following = [e[i], d[i + 1], e[i + 1]]
        if abs(following[0]) > abs(row[0]):
            row, following = following, row
            b[i], b[i + 1] = b[i + 1], b[i]
        if abs(row[0]) < least:
            row[0] = least if row[0] >= 0 else -least
        factor = following[0] / row[0]
        upper[i] = row
        row = [following[1] - factor * row[1], following[2] - factor * row[2], 0.0]
        b[i + 1] -= factor * b[i]
    if abs(row[0]) < least:
        row[0] = least if row[0] >= 0 else -least
    upper[-1] = row
    x = [0.0] * (size + 2)
    for i in range(size - 1, -1, -1):
        x[i] = (b[i] - upper[i][1] * x[i + 1] - upper[i][2] * x[i + 2]) / upper[i][0]
    return np.array(x[:size])


def leading_vectors(diagonal: np.ndarray, side: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix for ``values`` (falling) by inverse iteration; a vector is
    made orthogonal to those of its cluster after each step."""
    size = len(diagonal)
    norm = max(np.abs(diagonal).max(), np.abs(side).max() if len(side) else 0.0, np.finfo(float).tiny)
    least = np.finfo(float).eps * norm
    rng = np.random.default_rng(size)
    out = np.zeros((size, len(values)))
    begin = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            begin = k
        cluster = out[:, begin:k]
        x = rng.standard_normal(size)
        # equal shifts would give equal vectors before they are made orthogonal
        shift = min(value, values[k - 1] - least) if k > begin else value
        for _ in range(4):
            x = solved(diagonal, side, shift, x / np.linalg.norm(x), least)
            x /= np.linalg.norm(x)
            for _ in range(2):
                x -= cluster @ (cluster.T @ x)
                x /= np.linalg.norm(x)
        out[:, k] = x
    return out


def leading_components(matrix: np.ndarray, count: int = TOP) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``count`` largest eigenvalues of a covariance that are above rounding, and their unit vectors as rows."""
    diagonal, side, mirrors = householder(matrix)
    values = leading_values(diagonal, side, min(count, len(matrix)))
    values = values[values > len(matrix) * 4 * np.finfo(float).eps * max(values[0], 0.0)]
    vectors = turned_back(leading_vectors(diagonal, side, values), mirrors)
    vectors /= np.linalg.norm(vectors, axis=0)
    return values, vectors.T


# ------------------------------------------------------------------ distributed sums

def whole_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """``rows`` with usable vectors only, with ``x`` (array of long) and ``length``."""
    scaled = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    usable = F.forall(F.col(vector), lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                      & (F.abs(c.cast("double") * SCALE) < EXACT))
    kept = rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & usable)
    return kept.withColumn("x", scaled.cast("array<long>")).withColumn("length", F.size("x"))


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, their vectors) of a batch."""
    lengths = batch.column("length").to_numpy()
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        for begin in range(0, len(at), ROWS):
            part = at[begin:begin + ROWS]
            yield int(length), part, _matrix(batch.column("x").take(pa.array(part)), int(length))


def products(fit: DataFrame, per_length: dict[int, tuple[np.ndarray, np.ndarray | None]]) -> DataFrame:
    """``length, i, total, row``: for each length the sum of the i-th places of all vectors y and of their products
    with y. ``per_length`` has what is taken off each vector and, if there is one, the matrix that projects the rest.
    A task gives a row for each place, so the result of all tasks is summed by place."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for length, _, x in _by_length(batch):
                off, onto = per_length[length]
                y = (x - off).astype(float) if onto is None else (x - off) @ onto
                if length not in sums:
                    sums[length] = [np.zeros(y.shape[1]), np.zeros((y.shape[1],) * 2)]
                sums[length][0] += y.sum(axis=0)
                sums[length][1] += y.T @ y
        for length, (total, square) in sums.items():
            size = len(total)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(size, length, np.int32)), pa.array(np.arange(size, dtype=np.int32)), pa.array(total),
                pa.array(list(square), pa.list_(pa.float64()))], names=["length", "i", "total", "row"])

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.iloc[:1].assign(total=pdf["total"].sum(), row=[np.sum(np.stack(pdf["row"].to_list()), axis=0)])

    schema = "length int, i int, total double, row array<double>"
    return fit.mapInArrow(partial, schema).groupBy("length", "i").applyInPandas(added, schema)


def _held(models: DataFrame) -> list:
    """All rows of a small table whose size has been checked."""
    size = models.agg(F.sum(F.col("length") * (TOP + 2) * 8)).first()[0] or 0
    if size > MODEL_BYTES:
        raise ValueError(f"models of {size} bytes: vectors have too many lengths or places")
    return models.collect()


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` of every usable vector."""
    usable = whole_vectors(rows.select(F.col(f"`{key}`").alias(key), F.col(f"`{vector}`").alias("__v")), "__v")
    fit = written(usable.select("length", "x").distinct())
    sums = fit.select("length", F.posexplode("x").alias("i", "value")).groupBy("length", "i").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("sum"),
        F.min("value").alias("least"), F.max("value").alias("most"))
    sums = sums.groupBy("length").agg(F.max("n").alias("n"), F.sort_array(
        F.collect_list(F.struct("i", "sum", "least", "most"))).alias("places"))
    means = {r["length"]: (r["n"], [int(p["sum"]) for p in r["places"]],
                           [(p["least"], p["most"]) for p in r["places"]]) for r in _held(sums)}

    middle = {length: np.array([round(s / n) for s in total], np.int64) for length, (n, total, _) in means.items()}
    second = products(fit, {length: (m, None) for length, m in middle.items()})
    sizes = {length: n for length, (n, _, _) in means.items()}

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        length = int(pdf["length"].iloc[0])
        rest = pdf["total"].to_numpy() / sizes[length]
        cov = np.stack(pdf["row"].to_list()) / sizes[length] - np.outer(rest, rest)
        values, vectors = leading_components((cov + cov.T) / 2)
        return pd.DataFrame({"length": length, "component": np.arange(1, len(values) + 1), "value": values,
                             "explained": values / np.trace(cov), "vector": pd.Series(list(vectors), dtype=object)})

    models = written(second.groupBy("length").applyInPandas(
        solve, "length int, component int, value double, explained double, vector array<double>"))
    found: dict[int, list] = {}
    for r in _held(models.orderBy("length", "component")):
        found.setdefault(r["length"], []).append(r)

    # (n * x - S) / n is centred exactly; the vectors are scaled so that the projection is white
    onto = {length: (np.array([r["vector"] for r in parts]) / np.sqrt([[r["value"]] for r in parts])).T
            for length, parts in found.items()}
    off = {length: (middle[length], np.array([(s - n * int(m)) / n for s, m in zip(total, middle[length])]))
           for length, (n, total, _) in means.items()}
    white = products(fit.where(F.col("length").isin(list(found))),
                     {length: (sum(off[length]), onto[length]) for length in found})
    error = 0.0
    for r in _held(white):
        mean_row = np.array(r["row"]) / sizes[r["length"]]
        mean_row[r["i"]] -= 1
        error = max(error, float(np.abs(mean_row).max()))

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, at, x in _by_length(batch):
                if length not in found:
                    continue
                n, total, _ = means[length]
                count = len(found[length])
                w = ((x - off[length][0]) - off[length][1]) @ onto[length]
                each = np.repeat(np.arange(len(at)), count)
                ids = batch.column(key).take(pa.array(at[each]))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(each), n, np.int64)),
                    deviations(x, *means[length]).take(pa.array(each)), pa.array(w.ravel()),
                    pa.array(np.tile([r["explained"] for r in found[length]], len(at))),
                    pa.array(np.full(len(each), error))], names=out_names)

    out_names = [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    kind = rows.schema[key].dataType.simpleString()
    return usable.select(key, "length", "x").mapInArrow(
        projected, f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, "
                   "identity_error double")


def deviations(x: np.ndarray, n: int, total: list[int], ends: list[tuple[int, int]]) -> pa.Array:
    """Exact sums of (n * x - S)^2 as longs, null where one doesn't fit."""
    bound = sum(max(abs(n * low - s), abs(n * high - s)) ** 2 for s, (low, high) in zip(total, ends))
    if bound < 1 << 63 and n * max(max(abs(low), abs(high)) for low, high in ends) < 1 << 62:
        y = x * n - np.array(total, np.int64)
        return pa.array((y * y).sum(axis=1))
    out = [sum((n * v - s) ** 2 for v, s in zip(row, total)) for row in x.tolist()]
    return pa.array([v if v < 1 << 63 else None for v in out], pa.int64())
