"""Near-duplicate join on word five-grams with Bayesian candidate pruning.

Two texts are linked when the Jaccard similarity of their sets of five-word
runs (lower-cased words) is at least 0.8. Texts with the same set form one
class; everything after runs on one row per class, so copies are never expanded.

1. Sketch: 128 MinHash values of 16 bits, as 32 band keys of four values. Two
   texts at the threshold share no band with probability below 5e-8.
2. Buckets of a band hold candidates. They are dealt into blocks, so a task
   never holds more than two blocks of a bucket. Inside, MinHash values are
   compared 16 at a time, and a pair is dropped when the posterior probability
   of reaching the threshold (uniform prior) falls below ``TOLERANCE``; what
   survives is passed on as spanning edges, not pairs: from the least class of
   the bucket, which is the same one for most bands of a group of copies.
3. Connected survivors form clusters. In each, again block against block, all
   pairs are verified exactly on the whole sets of 64-bit run hashes; a text's
   links are counted there, and only counts and spanning edges leave the task.
   Sets are large, blocks hold ``BLOCK`` of them, so a class's text is read by
   one task more for every ``BLOCK`` classes of its cluster.

Cases: a text of one to four words has one run, all its words; texts without
words (null, empty, punctuation) are linked to nothing and are their own class;
equal rows are linked; an empty table gives an empty result; extra columns are
not looked at. A null doc_id counts as a document; a class's id is its smallest.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import bloom_filter, by_group, components, grams, keep_rows, mix64, row_key, scratch, words

SIZE = 5
THRESHOLD = 0.8
HASHES = 128
STEP = 16
TOLERANCE = 1e-6
#: Classes, and run hashes, in one block.
BLOCK = 2048
BLOCK_GRAMS = 2_000_000
BUCKET_BLOCK = 16_384
#: Rows and columns of the matrices that a task multiplies.
TILE = 1024

_A = (mix64(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)).astype(np.uint32)
_B = mix64(np.arange(1001, HASHES + 1001, dtype=np.uint64)).astype(np.uint32)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """Matches needed after 16, 32, ... values: with fewer, the posterior
    P(similarity >= threshold) = P(Binomial(h + 1, threshold) <= matches) is
    below the tolerance."""
    out = []
    for h in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, 0
        while True:
            total += comb(h + 1, m) * threshold**m * (1 - threshold)**(h + 1 - m)
            if total >= tolerance:
                break
            m += 1
        out.append(m)
    return out


def sketch(runs: np.ndarray) -> np.ndarray:
    """MinHash values (uint16) of a set of run hashes."""
    x = mix64(runs).astype(np.uint32)
    least = np.full(HASHES, np.uint32(0xFFFFFFFF))
    for i in range(0, len(x), 2048):
        least = np.minimum(least, (x[i:i + 2048, None] * _A + _B).min(axis=0))
    return (mix64(least.astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)


def set_id(runs: np.ndarray) -> bytes:
    return hashlib.blake2b(np.sort(runs).tobytes(), digest_size=16).digest()


def _sketches(docs: DataFrame) -> DataFrame:
    """doc_id, __key, cls (id of the set, null without words), n, sig."""
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                cls, n, sig = [], [], []
                for text in part.column("text").to_pylist():
                    runs = np.unique(grams(words(text), SIZE))
                    cls.append(set_id(runs) if len(runs) else None)
                    n.append(len(runs))
                    sig.append(sketch(runs).view(np.int64) if len(runs) else None)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("__key"), pa.array(cls, pa.binary()), pa.array(n, pa.int64()), pa.array(sig, pa.list_(pa.int64()))], ["doc_id", "__key", "cls", "n", "sig"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", row_key().alias("__key"), "text").mapInArrow(run, f"doc_id {kind}, __key long, cls binary, n long, sig array<long>")


def _signatures(t: pa.Table) -> np.ndarray:
    flat = t.column("sig").combine_chunks().flatten().to_numpy()
    return flat.view(np.uint16).reshape(t.num_rows, HASHES)


def _survivors(groups):
    """Spanning edges of the pairs in a bucket block that survive pruning."""
    need = least_matches()
    for _, t in groups:
        names, sig = t.column("cls").to_pylist(), _signatures(t)
        left = np.arange(len(names))
        a, b = [], []
        while len(left) > 1:
            # one connected group of survivors: grow it from its first member
            queue, left = [int(left[0])], left[1:]
            while queue and len(left):
                i = queue.pop()
                alive, got = left, np.zeros(len(left), np.int64)
                for step, least in enumerate(need):
                    at = slice(step * STEP, (step + 1) * STEP)
                    got = got + (sig[alive, at] == sig[i, at]).sum(axis=1)
                    ok = got >= least
                    alive, got = alive[ok], got[ok]
                    if not len(alive):
                        break
                if len(alive):
                    left = left[~np.isin(left, alive, assume_unique=True)]
                    a += [names[i]] * len(alive)
                    b += [names[j] for j in alive]
                    queue += alive.tolist()
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _first_reached(linked: np.ndarray) -> np.ndarray:
    """For each member of a symmetric relation, the first one it is connected
    with."""
    root = np.full(len(linked), -1)
    for first in range(len(linked)):
        if root[first] >= 0:
            continue
        root[first], queue = first, [first]
        while queue:
            new = np.flatnonzero(linked[queue.pop()] & (root < 0))
            root[new] = first
            queue += new.tolist()
    return root


def _verified(groups):
    """Per class of a cluster block pair: links to other classes, weighted by
    their copies, and an edge to the first class it is linked with."""
    for (_, i, j), t in groups:
        seen: dict[bytes, tuple[int, int, np.ndarray]] = {}
        for cls, blk, w, text in zip(*(t.column(c).to_pylist() for c in ("cls", "blk", "w", "text")), strict=True):
            if cls not in seen:
                runs = np.unique(grams(words(text), SIZE))
                if set_id(runs) == cls:  # another text may carry the same doc_id
                    seen[cls] = (blk, w, runs)
        names = sorted(seen)
        if len(names) < 2:
            continue
        blk = np.array([seen[c][0] for c in names])
        w = np.array([seen[c][1] for c in names], np.int64)
        n = np.array([len(seen[c][2]) for c in names], np.int64)
        _, ids = np.unique(np.concatenate([seen[c][2] for c in names]), return_inverse=True)
        row = np.repeat(np.arange(len(names)), n)
        # a run that one set has links nothing
        shared = np.bincount(ids) > 1
        keep = shared[ids]
        ids, row = (np.cumsum(shared) - 1)[ids[keep]], row[keep]
        order = np.argsort(ids, kind="stable")
        ids, row = ids[order], row[order]
        both = np.zeros((len(names), len(names)), np.float32)
        for lo in range(0, int(ids[-1]) + 1 if len(ids) else 0, TILE):
            a, b = np.searchsorted(ids, [lo, lo + TILE])
            x = np.zeros((len(names), TILE), np.float32)
            x[row[a:b], ids[a:b] - lo] = 1
            for at in range(0, len(names), TILE):
                both[at:at + TILE] += x[at:at + TILE] @ x.T
        linked = np.zeros(both.shape, bool)
        for at in range(0, len(names), TILE):
            some = np.rint(both[at:at + TILE]).astype(np.int64)
            linked[at:at + TILE] = 5 * some >= 4 * (n[at:at + TILE, None] + n[None, :] - some)
        np.fill_diagonal(linked, False)
        root = _first_reached(linked)
        if i != j:
            linked &= blk[:, None] != blk[None, :]
        links = np.concatenate([linked[at:at + TILE] @ w for at in range(0, len(names), TILE)])
        hit = np.flatnonzero(linked.any(axis=1))
        if len(hit):
            yield pa.RecordBatch.from_arrays([pa.array([names[k] for k in hit], pa.binary()), pa.array([names[k] for k in root[hit]], pa.binary()), pa.array(links[hit])], ["a", "b", "links"])


def _blocked(rows: DataFrame, key: str, blocks) -> DataFrame:
    """Deals each ``key``'s rows into blocks by hash of the class, and repeats
    a row for every block pair (i <= j) its block is in."""
    return (rows.withColumn("blk", F.pmod(F.xxhash64("cls"), blocks).cast("int"))
            .withColumn("o", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))))
            .withColumn("i", F.least("blk", "o")).withColumn("j", F.greatest("blk", "o")).drop("o"))


def near_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): doc_id, __key, cls of every row; and for each class
    copies, links (to documents of other classes), first (least (doc_id, __key)
    of its component) and size (documents of its component)."""
    rows = scratch(_sketches(docs), "near-rows")
    ident = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "__key")
    reps = scratch(rows.where("cls is not null").groupBy("cls")
                   .agg(F.count(F.lit(1)).alias("w"), F.min(ident).alias("least"), F.first("n").alias("n"), F.first("sig").alias("sig")), "near-reps")

    bands = reps.select("cls", F.posexplode("sig").alias("band", "v")).select("cls", F.xxhash64("band", "v").alias("bucket"))
    many = scratch(bands.groupBy("bucket").count().where("count > 1"), "near-buckets")
    member = bands.join(many, "bucket")
    member = _blocked(member, "bucket", F.expr(f"(count + {BUCKET_BLOCK - 1}) div {BUCKET_BLOCK}")).select("bucket", "i", "j", "cls")
    found = by_group(member.join(reps.select("cls", "sig"), "cls"), ["bucket", "i", "j"], _survivors, "a binary, b binary", order=["cls"])
    # a class's least neighbour stands for the others, which it is tied to: about one edge a class, whatever the bands
    ties = found.groupBy(F.greatest("a", "b").alias("b")).agg(F.collect_set(F.least("a", "b")).alias("near"))
    a = F.array_min("near")
    edges = scratch(ties.select(a.alias("a"), F.explode(F.concat(F.array("b"), F.filter("near", lambda x: x != a))).alias("b")).distinct(), "near-edges")

    cluster = components(edges, "near").withColumnRenamed("node", "cls")
    sizes = scratch(reps.drop("sig").join(cluster, "cls"), "near-cluster")
    total = sizes.groupBy("comp").agg(F.greatest(F.expr(f"(count(1) + {BLOCK - 1}) div {BLOCK}"), F.expr(f"(sum(n) + {BLOCK_GRAMS - 1}) div {BLOCK_GRAMS}")).alias("blocks"))
    dealt = _blocked(sizes.join(scratch(total, "near-sizes"), "comp"), "comp", F.col("blocks"))
    dealt = scratch(dealt.select("comp", "i", "j", "blk", "cls", "w", F.col("least.doc_id").alias("id"), F.col("least.__key").alias("k")), "near-dealt")
    wanted = bloom_filter(dealt, "k")
    texts = docs.select("text", row_key().alias("k")).where(wanted("k")).dropDuplicates(["k"])
    found = scratch(by_group(dealt.join(texts, "k").select("comp", "i", "j", "blk", "cls", "w", "text"), ["comp", "i", "j"], _verified,
                             "a binary, b binary, links long"), "near-links")
    joined = components(found.select("a", "b"), "near-joined").withColumnRenamed("node", "cls")
    links = found.groupBy(F.col("a").alias("cls")).agg(F.sum("links").alias("links"))
    classes = scratch(reps.drop("sig", "n").join(links, "cls", "left").join(joined, "cls", "left")
                      .withColumn("comp", F.coalesce("comp", "cls")).withColumn("links", F.coalesce("links", F.lit(0).cast("long"))), "near-classes")
    whole = scratch(classes.groupBy("comp").agg(F.min("least").alias("first"), F.sum("w").alias("size")), "near-comps")
    return rows.select("doc_id", "__key", "cls"), scratch(classes.drop("least").join(whole, "comp"), "near-result")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size, n_links of every row of ``docs``."""
    rows, classes = near_classes(docs)
    one = F.lit(1).cast("long")
    return (rows.join(classes, "cls", "left")
            .select("doc_id", F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
                    F.coalesce("size", one).alias("class_size"), F.coalesce(F.col("w") - 1 + F.col("links"), F.lit(0).cast("long")).alias("n_links")))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of linked documents, the one of
    the smallest doc_id; all columns kept."""
    rows, classes = near_classes(docs)
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("__key") == F.col("first.__key"))
    verdicts = scratch(rows.join(classes.where("size > 1"), "cls").groupBy("doc_id", "__key").agg(F.max(same).alias("kept")), "near-verdicts")
    return keep_rows(docs, verdicts)
