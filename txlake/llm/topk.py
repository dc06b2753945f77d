"""Exact top-k inner products by a pivot-distance index.

Vectors are floored to integers and lifted onto a sphere by one more component,
so that a larger inner product is a smaller distance: for lifted candidate x
and query q (lifted with 0), |q - x|^2 = |q|^2 + M - 2 q.x, M being the largest
squared norm. Every vector is keyed by its nearest of ``PIVOTS`` pivots and its
distance to it; sorted by that key, vectors form blocks that know their cell
and the annulus they lie in.

1. Each query block scores the two blocks of its own cell nearest in pivot
   distance: the k-th score found bounds its radius r.
2. By the triangle inequality a better vector of cell c has a distance to the
   pivot within [d(q, c) - r, d(q, c) + r]; only blocks whose annulus meets that
   are scored, nearest first, r shrinking on the way, and those beyond r are
   skipped. Query blocks meet candidate blocks, never all rows at once.

Cases: null vectors and those with a null or non-finite component take no part;
a shorter vector counts as ended by zeros; equal scores go to the smaller
vec_id; a vec_id's own row is not its candidate (equal ids count as the same
row); with fewer than k candidates all are returned; an empty table gives an
empty result; extra columns are not looked at. Products are exact while they
fit in a long, whatever the vectors' length; the bounds' slack grows with the
largest norm. Components so large that a product leaves the longs have none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlake.llm.common import scratch

SCALE = 64
TOP = 20
PIVOTS = 48
#: Rows the pivots are chosen from.
SAMPLE = 2048
CANDIDATES = 1024
QUERIES = 256
#: Distances are rounded: the least slack of the bounds, see ``slack`` below.
SLACK = 1e-3


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """(rows, dims) int64 of a list column, short rows ended by zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if (sizes == dims).all():
        return flat.reshape(len(column), dims)
    out = np.zeros((len(column), dims), np.int64)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _small(m: np.ndarray) -> bytes:
    """A matrix in the narrowest integer type, the item size in front."""
    top = int(np.abs(m).max(initial=0))
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if top <= np.iinfo(t).max)
    return bytes([np.dtype(kind).itemsize]) + m.astype(kind).tobytes()


def _large(data: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(data, f"i{data[0]}", offset=1).reshape(-1, dims).astype(np.int64)


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products; through floats only where these are exact."""
    bound = int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0)) * q.shape[1]
    if bound < 1 << 24:
        return (q.astype(np.float32) @ x.T.astype(np.float32)).astype(np.int64)
    return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64) if bound < 1 << 53 else q @ x.T


def _to_pivots(x: np.ndarray, last: np.ndarray, pivots: np.ndarray, norm: float) -> np.ndarray:
    """Distances of vectors with last component ``last`` to lifted pivots."""
    own = (x.astype(np.float64)**2).sum(axis=1) + last**2
    d2 = own[:, None] + norm - 2 * (x @ pivots[:, :-1].T + last[:, None] * pivots[:, -1])
    return np.sqrt(np.maximum(d2, 0))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's k best, ties to the smaller id (ids ascending
    order is not assumed); rows of fewer finite scores repeat low ones."""
    order = np.argsort(ids, kind="stable")
    return order[np.argsort(-scores[:, order], axis=1, kind="stable")[:, :k]]


class _Running:
    """The k best (score, id) of every query of a block so far."""
    LOW = np.iinfo(np.int64).min + 1  # its negative is a long too

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor
        self.score = np.full((n, k), self.LOW)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def least(self) -> np.ndarray:
        return np.maximum(self.score[:, -1], self.floor)

    def add(self, s: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        s = np.where(own[:, None] == ids[None, :], self.LOW, s)
        rows = np.flatnonzero((s >= self.least()[:, None]).any(axis=1) & (s > self.LOW).any(axis=1))
        if not len(rows):
            return
        at = _best(s[rows], ids, self.k)
        score = np.concatenate([self.score[rows], np.take_along_axis(s[rows], at, 1)], axis=1)
        name = np.concatenate([self.id[rows], ids[at]], axis=1)
        name = np.where(score == self.LOW, np.iinfo(np.int64).max, name)
        order = np.lexsort((name, -score.astype(np.float64)), axis=1) if np.abs(score[score > self.LOW]).max(initial=0) < 1 << 53 else np.array([sorted(range(score.shape[1]), key=lambda j: (-int(a[j]), int(b[j]))) for a, b in zip(score, name, strict=True)])
        order = order[:, :self.k]
        self.score[rows], self.id[rows] = np.take_along_axis(score, order, 1), np.take_along_axis(name, order, 1)


def _blocks(rows: DataFrame, size: int, dims: int) -> DataFrame:
    """Sorted rows packed into blocks of one cell: cell, dmin, dmax, ids, q."""
    def run(batches):
        rest = None
        for batch in [*batches, None]:
            t = rest if batch is None else pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            if t is None or t.num_rows == 0:
                continue
            cell = t.column("cell").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]])
            cuts = sorted({int(c) for a, b in zip(edges[:-1], edges[1:], strict=True) for c in range(a, b, size)} | {len(cell)})
            done = 0
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b == len(cell) and batch is not None:
                    break  # may go on in the next batch
                g = t.slice(a, b - a)
                d = g.column("dist").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array([int(cell[a])], pa.int32()), pa.array([float(d.min())]), pa.array([float(d.max())]), pa.array([g.column("vec_id").to_numpy().tobytes()], pa.binary()),
                                                  pa.array([_small(_matrix(g.column("q"), dims))], pa.binary())], ["cell", "dmin", "dmax", "ids", "q"])
                done = b
            rest = t.slice(done) if batch is not None else None
    return (rows.repartitionByRange("cell", "dist", "vec_id").sortWithinPartitions("cell", "dist", "vec_id")
            .mapInArrow(run, "cell int, dmin double, dmax double, ids binary, q binary").withColumn("bid", F.monotonically_increasing_id()))


def top_products(vectors: DataFrame, k: int = TOP, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of every row whose vec_id
    is divisible by ``every``, among all other rows."""
    spark = vectors.sparkSession
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    whole = (vectors.select("vec_id", "embedding").where("vec_id is not null and embedding is not null").where(finite)
             .select("vec_id", F.transform(e, lambda x: F.floor(x.cast("double") * SCALE)).alias("q")))
    base = scratch(whole.withColumn("norm", F.aggregate("q", F.lit(0.0), lambda a, x: a + x.cast("double") * x)), "topk-base")
    stats = base.agg(F.max("norm").alias("m"), F.max(F.size("q")).alias("dims")).first()
    if stats["m"] is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    m, dims = float(stats["m"]), max(1, int(stats["dims"]))
    # a squared distance near 0 is a difference of numbers up to 4 m, each of them a sum over the dimensions
    slack = SLACK + float(np.sqrt(8 * (dims + 4) * np.finfo(float).eps * m))
    # pivots: a bounded sample by hash of the row, thinned to the farthest ones
    sample = base.orderBy(F.xxhash64("vec_id", "q")).limit(SAMPLE).select("q", "norm").toArrow()
    x = _matrix(sample.column("q"), dims).astype(np.float64)
    x = np.column_stack([x, np.sqrt(np.maximum(m - (x**2).sum(axis=1), 0))])
    picked, far = [0], ((x - x[0])**2).sum(axis=1)
    while len(picked) < PIVOTS and far.max() > 0:
        picked.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[picked[-1]])**2).sum(axis=1))
    pivots = x[picked]

    def key(batches):
        for b in batches:
            q = _matrix(b.column("q"), dims)
            d = _to_pivots(q, np.sqrt(np.maximum(m - b.column("norm").to_numpy(), 0)), pivots, m)
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("q"), pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(cell)), cell])], ["vec_id", "q", "cell", "dist"])
    keyed = base.mapInArrow(key, "vec_id long, q array<long>, cell int, dist double")
    blocks = scratch(_blocks(keyed, CANDIDATES, dims), "topk-blocks")
    queries = scratch(_blocks(keyed.where(F.col("vec_id") % every == 0), QUERIES, dims), "topk-queries")
    meta = blocks.select("bid", "cell", F.col("dmin").alias("lo"), F.col("dmax").alias("hi"))
    ask = queries.select(F.col("bid").alias("qid"), "cell", "dmin", "dmax")

    def scored(batches, emit):
        """Streams rows sorted by (qid, salt, gap): one block at a time."""
        state = None
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if state is None or state[0] != (r["qid"], r["salt"]):
                    if state is not None:
                        yield from emit(*state)
                    own, q = np.frombuffer(r["qids"], np.int64), _large(r["qq"], dims)
                    floor = np.frombuffer(r["floor"], np.int64) if r.get("floor") else np.full(len(own), _Running.LOW)
                    state = ((r["qid"], r["salt"]), own, q, _Running(len(own), k, floor), _to_pivots(q, np.zeros(len(own)), pivots, m), (q.astype(np.float64)**2).sum(axis=1))
                _, own, q, best, dist, norm = state
                least = best.least()
                radius = np.where(least == _Running.LOW, np.inf, np.sqrt(np.maximum(norm + m - 2.0 * np.where(least == _Running.LOW, 0, least), 0)) + slack)
                d = dist[:, r["cell"]]
                near = np.flatnonzero((d - radius <= r["hi"] + slack) & (d + radius >= r["lo"] - slack))
                if len(near):
                    ids = np.frombuffer(r["ids"], np.int64)
                    s = np.full((len(own), len(ids)), _Running.LOW)
                    s[near] = _scores(q[near], _large(r["bq"], dims))
                    best.add(s, ids, own)
        if state is not None:
            yield from emit(*state)

    def pairs(chosen, with_floor=None):
        p = (chosen.join(queries.select(F.col("bid").alias("qid"), F.col("ids").alias("qids"), F.col("q").alias("qq")), "qid")
             .join(blocks.select("bid", "ids", F.col("q").alias("bq")), "bid"))
        p = p.join(with_floor, "qid", "left") if with_floor is not None else p
        return p.repartition("qid", "salt").sortWithinPartitions("qid", "salt", "gap", "bid")

    # 1: a radius from the query's own cell
    gap = F.greatest(F.lit(0.0), F.col("lo") - F.col("dmax"), F.col("dmin") - F.col("hi"))
    first = (ask.join(meta, "cell").withColumn("gap", gap).withColumn("n", F.row_number().over(Window.partitionBy("qid").orderBy("gap", "bid")))
             .where("n <= 2").withColumn("salt", F.lit(0)).select("qid", "bid", "salt", "gap", "cell", "lo", "hi"))

    def bounds(batches):
        def emit(name, own, q, best, dist, norm):
            yield pa.RecordBatch.from_arrays([pa.array([name[0]], pa.int64()), pa.array([best.least().tobytes()], pa.binary())], ["qid", "floor"])
        return scored(batches, emit)
    floor = scratch(pairs(first).mapInArrow(bounds, "qid long, floor binary"), "topk-floor")

    # 2: the annuli that can hold anything better
    def annuli(batches):
        for b in batches:
            for qid, data, kth in zip(*(b.column(c).to_pylist() for c in ("qid", "q", "floor")), strict=True):
                q = _large(data, dims)
                least = np.frombuffer(kth, np.int64)
                norm = (q.astype(np.float64)**2).sum(axis=1)
                r = np.where(least == _Running.LOW, np.inf, np.sqrt(np.maximum(norm + m - 2.0 * np.where(least == _Running.LOW, 0, least), 0)) + slack)
                d = _to_pivots(q, np.zeros(len(q)), pivots, m)
                yield pa.RecordBatch.from_arrays([pa.array([qid] * len(pivots), pa.int64()), pa.array(np.arange(len(pivots), dtype=np.int32)), pa.array((d - r[:, None]).min(axis=0)), pa.array((d + r[:, None]).max(axis=0)), pa.array(d.min(axis=0)), pa.array(d.max(axis=0))], ["qid", "cell", "from", "to", "dmin", "dmax"])
    rings = queries.select(F.col("bid").alias("qid"), "q").join(floor, "qid").mapInArrow(annuli, "qid long, cell int, from double, to double, dmin double, dmax double")
    chosen = (rings.join(meta, (rings["cell"] == meta["cell"]) & (F.col("hi") >= F.col("from") - slack) & (F.col("lo") <= F.col("to") + slack))
              .withColumn("gap", gap).withColumn("salt", F.pmod(F.xxhash64("bid"), F.lit(8)).cast("int"))
              .select("qid", "bid", "salt", "gap", meta["cell"], "lo", "hi"))

    def results(batches):
        def emit(name, own, q, best, dist, norm):
            ok = (best.score > _Running.LOW) & (best.score >= best.floor[:, None])
            row = np.nonzero(ok)[0]
            yield pa.RecordBatch.from_arrays([pa.array(own[row]), pa.array(best.id[ok]), pa.array(best.score[ok])], ["query_id", "vec_id", "score"])
        return scored(batches, emit)
    found = pairs(chosen, floor).mapInArrow(results, "query_id long, vec_id long, score long")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
