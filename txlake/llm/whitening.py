"""Embedding whitening by FEAST contour integration.

Vectors become integers x = floor(1024 c) + 100000. Sums are exact; the
covariance is summed from vectors centred on the rounded mean, in whole numbers
that are exact in doubles, whichever task adds them, while rows times the
square of the largest centred entry stay below 2^53; what the mean was rounded
by is then taken off. It is one matrix of dimensions squared, whatever the rows.

1. Inertia: the matrix is made tridiagonal by reflections; the negative pivots
   of T - s count the eigenvalues below s, for many s at once. Intervals of a
   few eigenvalues each are cut in the widest gaps near.
2. FEAST: for each interval, the resolvent at points of a circle around it,
   applied to a basis, is a quadrature of the projector on its eigenvectors.
   The shifted complex solves, one row per (interval, point), are Spark's tasks.
   Rayleigh-Ritz in the projected basis gives eigenpairs; projection is repeated
   until the residuals are at rounding level.
3. The eigenvalues found in an interval must be as many as its inertia count;
   until they are, and while residuals shrink slowly, the basis grows.

The whitened vectors are written, and their own covariance is summed from them
for ``identity_error``.

Cases: vectors null, or with null or non-finite entries, are dropped; a shorter
vector counts as ended by zeros, an empty one as all zeros; |1024 c| is held at
2^61; null and repeated vec_ids are rows like others; a component without
variance (beyond the rank, or of a single row) has whitened null and explained
0, and does not count for identity_error; equal eigenvalues give any orthonormal
vectors; a deviation beyond a long is null; an empty table, or one of empty
vectors only, gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.llm.common import scratch

#: Fixed values.
SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8

#: Eigenvalues in an interval, and points of its half circle, to start with.
PER_INTERVAL, POINTS = 4, 8
#: Residual of an eigenpair, in units of the largest eigenvalue.
RESIDUAL = 1e-13
MOST_ROUNDS = 40
_HELD = 1 << 61


# ------------------------------------------------------------------- the rows

def _finite(vectors: DataFrame) -> DataFrame:
    e = F.col("embedding")
    whole = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vectors.select("vec_id", "embedding").where(e.isNotNull() & whole)


def _integers(column: pa.Array, dims: int) -> np.ndarray:
    """x of a list column, (rows, dims) int64."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    flat = np.clip(flat, -_HELD, _HELD).astype(np.int64) + OFFSET
    if (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.full((len(column), dims), OFFSET, np.int64)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _sums(rows: DataFrame, dims: int) -> list[int]:
    """Exact sum of each dimension: high and low halves are added apart."""
    def run(batches):
        high, low = np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for b in batches:
            x = _integers(b.column("embedding"), dims)
            high += (x >> 31).sum(axis=0)
            low += (x & 0x7FFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(high), pa.array(low)], ["i", "high", "low"])
    total = (rows.select("embedding").mapInArrow(run, "i int, high long, low long")
             .groupBy("i").agg(F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect())
    out = [0] * dims
    for r in total:
        out[r["i"]] = (int(r["high"]) << 31) + int(r["low"])
    return out


def _products(rows: DataFrame, dims: int, read) -> np.ndarray:
    """Sum over all rows of the outer product of ``read(batch)``, (rows, dims)
    doubles. Tasks add up their rows, Spark the tasks' entries."""
    i, j = np.triu_indices(dims)

    def run(batches):
        total = np.zeros((dims, dims))
        for b in batches:
            z = read(b)
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "v"])
    got = rows.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((dims, dims))
    a, b, v = (got.column(c).to_numpy() for c in ("i", "j", "v"))
    out[a, b] = out[b, a] = v
    return out


# -------------------------------------------------------------------- inertia

def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix similar to symmetric
    ``v``, by Householder reflections."""
    a, n = v.copy(), len(v)
    for k in range(n - 2):
        u = a[k + 1:, k].copy()
        size = np.linalg.norm(u)
        if size == 0:
            continue
        u[0] += np.copysign(size, u[0])
        u /= np.linalg.norm(u)
        p = a[k + 1:, k + 1:] @ u
        p -= (u @ p) * u
        a[k + 1:, k + 1:] -= 2 * (np.outer(u, p) + np.outer(p, u))
        a[k + 1, k] = -np.copysign(size, a[k + 1, k])
        a[k + 2:, k] = 0
    return np.diag(a).copy(), np.diag(a, -1).copy()


def counts_below(d: np.ndarray, e: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Inertia: negative pivots of T - s for every shift s, that is how many
    eigenvalues lie below it."""
    shifts = np.asarray(shifts, float)
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    out, pivot = np.zeros(len(shifts), np.int64), np.ones(len(shifts))
    for i in range(len(d)):
        pivot = d[i] - shifts - (e[i - 1]**2 / pivot if i else 0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        out += pivot < 0
    return out


def _nth_largest(d: np.ndarray, e: np.ndarray, top: float, n: int) -> list[tuple[float, float]]:
    """Brackets of the ``n`` largest eigenvalues, falling, by bisection."""
    low, high = np.full(n, -1e-9 * top), np.full(n, top)
    want = len(d) - np.arange(1, n + 1)  # so many lie below the i-th largest
    for _ in range(48):
        mid = (low + high) / 2
        under = counts_below(d, e, mid) <= want
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    return list(zip(low.tolist(), high.tolist(), strict=True))


def intervals(d: np.ndarray, e: np.ndarray, top: float, wanted: int) -> list[tuple[float, float, int]]:
    """Intervals (from, to, inertia count), falling, that hold the ``wanted``
    largest eigenvalues. An end lies in the widest gap among the few next to
    the place it is due at."""
    n = len(d)
    most = min(n, 2 * wanted + PER_INTERVAL)
    near = _nth_largest(d, e, top, most)
    while True:
        # gaps[i]: between the i-th and the next, i from 1; the last one is open if it is the least of all
        gaps = [near[i - 1][0] - near[i][1] for i in range(1, most)] + ([np.inf] if most == n else [])
        if max(gaps[wanted - 1:], default=0) > 1e-8 * top or most == n:
            break
        most = min(n, 2 * most)
        near = _nth_largest(d, e, top, most)
    out, at, upper = [], 0, top
    while at < wanted:
        due = min(at + PER_INTERVAL, wanted)
        ahead = range(due, min(due + PER_INTERVAL, len(gaps)) + 1)
        cut = max(ahead, key=lambda i: gaps[i - 1], default=len(gaps))
        if gaps[cut - 1] <= 1e-8 * top:  # a bunch: on to the first gap after it
            cut = next((i for i in range(cut + 1, len(gaps) + 1) if gaps[i - 1] > 1e-8 * top), len(gaps))
        lower = near[cut - 1][0] - 0.01 * top if cut == n else (near[cut - 1][0] + near[cut][1]) / 2
        below = counts_below(d, e, np.array([lower, upper]))
        out.append((lower, upper, int(below[1] - below[0])))
        at, upper = cut, lower
    return out


# ---------------------------------------------------------------------- FEAST

def _projected(spark: SparkSession, v: np.ndarray, work: list[tuple[int, float, float, int, np.ndarray]]) -> dict[int, np.ndarray]:
    """For each (name, from, to, points, basis): the quadrature of its
    projector, applied to the basis. One Spark task row per shifted solve."""
    shared = spark.sparkContext.broadcast((v, {w[0]: w for w in work}))
    rows = [(w[0], p) for w in work for p in range(w[3])]

    def run(batches):
        matrix, by_name = shared.value
        for b in batches:
            names, out = b.column("name").to_pylist(), []
            for name, p in zip(names, b.column("point").to_pylist(), strict=True):
                _, low, high, points, basis = by_name[name]
                turn = np.exp(1j * np.pi * (p + 0.5) / points) * (high - low) / 2
                shifted = ((low + high) / 2 + turn) * np.eye(len(matrix)) - matrix
                out.append((turn * np.linalg.solve(shifted, basis)).real.astype(np.float64).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), b.column("point"), pa.array(out, pa.binary())], ["name", "point", "part"])
    table = spark.createDataFrame(rows, "name int, point int").repartition(len(rows), "name", "point")
    # added in the points' order: a rerun gives the same bits
    parts = sorted(table.mapInArrow(run, "name int, point int, part binary").collect(), key=lambda r: (r["name"], r["point"]))
    shared.unpersist()
    out = {w[0]: np.zeros_like(w[4]) for w in work}
    for r in parts:
        _, _, _, points, basis = next(w for w in work if w[0] == r["name"])
        out[r["name"]] += np.frombuffer(r["part"]).reshape(basis.shape) / points
    return out


def feast(spark: SparkSession, v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of symmetric,
    positive semidefinite ``v``: the ``wanted`` largest ones above rounding."""
    n = len(v)
    d, e = tridiagonal(v)
    # no eigenvalue exceeds the largest row sum; a little more is safe to rounding
    top = float(np.abs(v).sum(axis=1).max(initial=0)) * (1 + 1e-9)
    if top == 0:
        return np.zeros(0), np.zeros((n, 0))
    biggest = _nth_largest(d, e, top, 1)[0][1]
    floor = 4 * n * np.finfo(float).eps * biggest
    wanted = min(wanted, n - int(counts_below(d, e, np.array([floor]))[0]))
    rng = np.random.default_rng(0)
    open_, found = {}, {}
    for name, (low, high, count) in enumerate(intervals(d, e, min(top, biggest * 1.01), wanted)):
        size = min(n, count + max(2, count // 2))
        open_[name] = (low, high, count, POINTS, rng.normal(size=(n, size)), np.inf)
    for _ in range(MOST_ROUNDS):
        bases = _projected(spark, v, [(name, w[0], w[1], w[3], w[4]) for name, w in open_.items()])
        for name, basis in bases.items():
            low, high, count, points, old, before = open_.pop(name)
            q, r = np.linalg.qr(basis)
            value, small = np.linalg.eigh(q.T @ v @ q)
            vector = q @ small
            inside = (value > low) & (value < high)
            left = np.linalg.norm(v @ vector - vector * value, axis=0)
            if inside.sum() == count and left[inside].max(initial=0) <= max(RESIDUAL, 4 * n * np.finfo(float).eps) * biggest:
                found[name] = value[inside], vector[:, inside]
                continue
            if inside.sum() > count:  # a ghost: more points tell it from the others
                points *= 2
            # eigenvalues crowded at an end slow it down until the basis holds them too
            worst = np.sort(left)[min(count, len(left)) - 1]
            if worst > before / 10 and old.shape[1] < n:
                vector = np.column_stack([vector, rng.normal(size=(n, min(n, 2 * old.shape[1]) - old.shape[1]))])
            open_[name] = (low, high, count, points, vector, worst)
        if not open_:
            break
    else:
        raise ArithmeticError("contour integration did not find as many eigenvalues as the inertia counts")
    value = np.concatenate([found[k][0] for k in sorted(found)] or [np.zeros(0)])
    vector = np.column_stack([found[k][1] for k in sorted(found)]) if found else np.zeros((n, 0))
    order = np.argsort(-value, kind="stable")[:wanted]
    return value[order], vector[:, order]


# ------------------------------------------------------------------ whitening

def _deviations(y: np.ndarray, rest: np.ndarray, n: int) -> pa.Array:
    """Sum of (n y - rest)^2 by row, exact: longs wrap, which is right modulo
    2^64, and a rough sum tells which ones are too large for a long."""
    with np.errstate(over="ignore"):
        term = y * np.int64(n) - rest
        exact = (term * term).sum(axis=1)
    rough = ((y.astype(np.float64) * n - rest)**2).sum(axis=1)
    edge = np.flatnonzero(np.abs(rough / 2.0**63 - 1) < 1e-6)
    over = rough >= 2.0**63
    for i in edge.tolist():
        over[i] = sum((n * int(a) - int(b))**2 for a, b in zip(y[i], rest, strict=True)) >= 1 << 63
    return pa.array(exact, mask=over)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, n, deviation, whitened (array), explained (array),
    identity_error: a row for each remaining vector."""
    spark = vectors.sparkSession
    rows = _finite(vectors)
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dims")).first()
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    n, dims = stats["n"], stats["dims"] or 0
    schema = f"vec_id {id_type}, deviation long, w array<double>"
    if not n or not dims:
        return spark.createDataFrame([], f"vec_id {id_type}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double")
    sums = _sums(rows, dims)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    rest = np.array([s - n * int(c) for s, c in zip(sums, centre, strict=True)], np.int64)
    shift = rest / n

    def centred(b: pa.RecordBatch) -> np.ndarray:
        return _integers(b.column("embedding"), dims) - centre
    v = _products(rows.select("embedding"), dims, lambda b: centred(b).astype(np.float64)) / n - np.outer(shift, shift)
    value, vector = feast(spark, v, min(components, dims))
    matrix = vector / np.sqrt(value)

    def project(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = centred(b)
            w = (y - shift) @ matrix
            lists = pa.ListArray.from_arrays(np.arange(len(y) + 1, dtype=np.int32) * w.shape[1], pa.array(w.reshape(-1)))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), _deviations(y, rest, n), lists], ["vec_id", "deviation", "w"])
    done = scratch(rows.mapInArrow(project, schema), "whitened")
    k, error = len(value), 0.0
    if k:
        mean = np.array(done.agg(*[F.avg(F.col("w")[i]).alias(f"m{i}") for i in range(k)]).first())

        def off_mean(b: pa.RecordBatch) -> np.ndarray:
            return b.column("w").flatten().to_numpy().reshape(-1, k) - mean
        error = float(np.abs(_products(done.select("w"), k, off_mean) / n - np.eye(k)).max())
    wide = min(components, dims)
    total = float(np.trace(v))
    share = [float(x) / total for x in value] + [0.0] * (wide - k)
    padded = F.concat("w", F.array_repeat(F.lit(None).cast("double"), wide - k)) if wide > k else F.col("w")
    return done.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", padded.alias("whitened"),
                       F.array(*[F.lit(x) for x in share]).alias("explained"), F.lit(error).alias("identity_error"))


def whitened_components(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained,
    identity_error: a row per vector and component."""
    wide = whiten(vectors, components)
    return (wide.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c"))
            .select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
                    F.col("c.explained").alias("explained"), "identity_error"))
