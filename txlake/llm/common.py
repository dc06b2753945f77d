"""Helpers shared by the corpus operators: scratch tables, text tokens,
Bloom filters, streamed groups, connected components."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.session import scratch_path

_WORD = re.compile(r"\w+")

#: Largest Bloom filter ever broadcast, in bits (16 MiB). Past it the false
#: positive rate rises, so more rows take the exact path; results never change.
MAX_BLOOM_BITS = 1 << 27


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared folder and read back: the lineage ends
    here, and a lost executor costs no recomputation of what went before."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes scratch tables after their last reader: what was derived from
    them must be written, or it could not be recomputed."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Spark removes the files of shuffles nothing refers to any more when the
    driver collects its garbage, which a driver with much memory seldom does."""
    spark._jvm.System.gc()


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the column as text, mod ``n`` (null counts as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def words(text: str | None) -> list[str]:
    """Lower-cased word tokens of a text (null: none)."""
    return _WORD.findall(text.lower()) if text else []


def word_hashes(tokens: list[str]) -> np.ndarray:
    """crc32 of each token, uint32."""
    return np.fromiter(map(zlib.crc32, map(str.encode, tokens)), np.uint32, len(tokens))


#: An ASCII character of a word, lower-cased; of others a blank.
_LOWER = bytes(ord(c.lower()) if _WORD.match(c) else 32 for c in map(chr, range(128))) + bytes(128)


@cache
def _word_points() -> np.ndarray:
    """Of every code point whether it belongs to a word."""
    out = np.zeros(0x110000, bool)
    for m in _WORD.finditer("".join(map(chr, range(len(out))))):
        out[m.start():m.end()] = True
    return out


def text_hashes(text: str | None) -> np.ndarray:
    """``word_hashes(words(text))``, whose words are told apart by blanks put
    for all that is between them."""
    if not text:
        return np.zeros(0, np.uint32)
    if text.isascii():
        tokens = text.encode().translate(_LOWER).split()
    else:
        points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
        tokens = np.where(_word_points()[points], points, np.uint32(32)).astype("<u4").tobytes().decode("utf-32-le").encode().split()
    return np.fromiter(map(zlib.crc32, tokens), np.uint32, len(tokens))


#: What empties the memory that a worker keeps between tasks for an operator.
KEPT: list[Callable[[], None]] = []


def let_go() -> None:
    """Empties a worker's memory of earlier operators' tasks: workers outlive
    stages, and a stage that needs the room calls this first."""
    for clear in KEPT:
        clear()
    pa.default_memory_pool().release_unused()


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def grams(tokens: list[str], size: int) -> np.ndarray:
    """64-bit hash of every run of ``size`` words. A text of one to
    ``size - 1`` words has one run: all its words; one without words none."""
    return gram_hashes(word_hashes(tokens), size)


def gram_hashes(w: np.ndarray, size: int) -> np.ndarray:
    """``grams`` of words given by their hashes."""
    h = w.astype(np.uint64)
    if len(h) == 0:
        return h
    size = min(size, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for j in range(size):
        out = mix64(out + h[j:len(h) - size + 1 + j] + np.uint64(0x9E3779B97F4A7C15))
    return out


# --------------------------------------------------------------- Bloom filter

def _positions(h: Column, bits: int, k: int) -> Column:
    low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    return F.array(*[(low + high * j).bitwiseAND(F.lit(bits - 1)) for j in range(k)])


def bloom_filter(df: DataFrame, column: str, repeated: bool = False,
                 bits_per_row: int = 16, k: int = 4):
    """A function Column -> Column telling which 64-bit hashes may be among
    those of ``df`` -- or, with ``repeated``, may occur in it at least twice
    (all their positions were set twice). No false negatives.

    Positions are counted by a grouped, map-side combined aggregate; only the
    packed bits reach the driver, at most ``MAX_BLOOM_BITS``.
    """
    spark = df.sparkSession
    rows = df.select(column).na.drop().count()
    bits = 1 << 16
    while bits < min(rows * bits_per_row, MAX_BLOOM_BITS):
        bits *= 2
    pos = df.select(F.explode(_positions(F.col(column), bits, k)).alias("p")).where("p is not null")
    pos = (pos.groupBy("p").count().where("count > 1") if repeated else pos.distinct())
    packed = (pos.groupBy(F.shiftright("p", 6).alias("w"))
              .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b")).toPandas())
    array = np.zeros(bits // 64, np.uint64)
    array[packed["w"].to_numpy(np.int64)] = packed["b"].to_numpy(np.int64).view(np.uint64)
    shared = spark.sparkContext.broadcast(array.tobytes())

    @F.pandas_udf("boolean")
    def member(h: pd.Series) -> pd.Series:
        a = np.frombuffer(shared.value, np.uint64)
        x = h.fillna(0).to_numpy(np.int64).view(np.uint64)
        low, high = x & np.uint64(0xFFFFFFFF), (x >> np.uint64(32)) | np.uint64(1)
        ok = h.notna().to_numpy()
        for j in range(k):
            p = (low + high * np.uint64(j)) & np.uint64(bits - 1)
            ok &= ((a[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1)).astype(bool)
        return pd.Series(ok)

    return member


def row_key() -> Column:
    """Identity of a document row for verdicts: its id and whole text."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def keep_rows(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``docs`` without the rows a verdict drops. ``verdicts`` (doc_id, __key,
    kept; one row per document) name members of groups only: a Bloom filter of
    them lets every other row pass straight through, unshuffled. Rows equal in
    id and text are one document: if it is kept, one of them stays."""
    member = bloom_filter(verdicts, "__key")
    keyed = docs.withColumn("__key", row_key()).withColumn("__maybe", member("__key"))
    v = verdicts.select(F.col("__key").alias("__vkey"), F.col("doc_id").alias("__vid"),
                        F.col("kept").alias("__kept"))
    checked = (keyed.where("__maybe")
               .join(v, (F.col("__key") == F.col("__vkey")) & F.col("doc_id").eqNullSafe(F.col("__vid")), "left")
               .where("__kept is null or __kept")
               .withColumn("__one", F.when(F.col("__kept"), F.lit(-1)).otherwise(F.monotonically_increasing_id()))
               .dropDuplicates(["__key", "doc_id", "__one"]))
    return keyed.where(~F.col("__maybe")).select(docs.columns).unionByName(checked.select(docs.columns))


# ------------------------------------------------------------ streamed groups

def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal ``keys`` in record batches that arrive sorted by them."""
    rest: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if rest is not None:
            t = pa.concat_tables([rest, t])
        if t.num_rows == 0:
            continue
        change = np.zeros(t.num_rows - 1, bool)
        for k in keys:
            c = t.column(k).combine_chunks()
            c = c.dictionary_encode().indices if not pa.types.is_integer(c.type) else c
            v = c.to_numpy(zero_copy_only=False)
            change |= v[1:] != v[:-1]
        starts = np.concatenate([[0], np.flatnonzero(change) + 1])
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            g = t.slice(a, b - a)
            yield tuple(g.column(k)[0].as_py() for k in keys), g
        rest = t.slice(int(starts[-1])).combine_chunks()
    if rest is not None and rest.num_rows:
        yield tuple(rest.column(k)[0].as_py() for k in keys), rest


def by_group(df: DataFrame, keys: list[str], step, schema: str, order: list[str] | None = None) -> DataFrame:
    """Runs ``step(iterator of (key, pa.Table)) -> iterator of RecordBatch``
    over the groups of ``df``; a task streams through its sorted partition and
    holds one group at a time."""
    def run(batches):
        return step(sorted_groups(batches, keys))
    return (df.repartition(*keys).sortWithinPartitions(*keys, *(order or []))
            .mapInArrow(run, schema))


# ------------------------------------------------------- connected components

def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b, any orderable
    type): (node, comp), comp being the component's smallest node.

    Every round hooks each node, and the node it points to, to the smallest
    label among its neighbours, then halves the paths. Each round's labels are
    a table in the shared folder, so both join sides are plain scans and
    adaptive execution can split a hub's rows. Ends when nothing changes.
    """
    both = scratch(edges.where("a <> b").select("a", "b")
                   .union(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                   f"{name}-edges")
    labels = scratch(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("comp")), f"{name}-cc")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m")))
        seen = labels.join(near, "node")
        hooked = scratch(seen.select(F.explode(F.array(
            F.struct("node", F.least("comp", "m").alias("c")),
            F.struct(F.col("comp").alias("node"), F.least("comp", "m").alias("c")))).alias("x"))
            .select("x.*").groupBy("node").agg(F.min("c").alias("comp")), f"{name}-hook")
        jump = hooked.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
        old = labels.select("node", F.col("comp").alias("old"))
        new = scratch(hooked.join(jump, "comp").select("node", F.least("comp", "next").alias("comp"))
                      .join(old, "node").select("node", "comp", (F.col("comp") < F.col("old")).alias("moved")),
                      f"{name}-cc")
        labels = new.select("node", "comp")
        if new.where("moved").limit(1).count() == 0:
            return labels
