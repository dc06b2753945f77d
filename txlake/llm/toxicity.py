"""Toxicity by class-conditional Kneser-Ney models.

Word bigrams of the labelled training rows are counted per class (toxic,
ordinary) by Spark, over all such rows. From the counts come two interpolated
models: class bigrams, discounted, back off to the class's continuation counts
(after how many different words a word follows there), discounted, which back
off to the continuation counts both classes share. Continuations, unlike
occurrences, do not grow when a text is copied. The larger class's counts are
first scaled to the smaller one's size, so that neither has more unseen mass by
sample size alone, and up to ``DISCOUNT`` continuations, of a bigram so many
standard errors, go to the back-off: a rare expression is judged by shared
counts. What the classes' texts differ in by more than ``NOISE`` standard errors
is no passage of a few copies: of such a word the texts that have it count as
evidence too, not only the words before it, and such a bigram is explicit
whatever else its words stand in; the others join words that both stand in at
least ``PARTNERS`` repeated ones. A text is scored by the difference of its length-normalised
log-likelihoods, over the whole text and over its most suspicious runs of
``WINDOWS`` words and its ``TOP`` most suspicious words; a logistic function of these, fitted on rows the models have
not seen, gives the score.

No part of the model is bounded: all bigram, context and continuation counts
are tables keyed by 64-bit hashes, and so is what follows from them, the log
ratio of every bigram, context and word that has one of its own. Texts are cut
into blocks of about ``BLOCK_WORDS`` words; a block asks the table once for each
of its distinct words and bigrams, its keys packed by key range, and the packed
answers meet the block's texts. A Bloom filter spares it asking for what the
table does not have. The logistic fit reads all its rows, in Spark.

Cases: null and empty texts score like a text without evidence; labels with a
null doc_id or null class teach nothing; several labels of a document count as
toxic if one does; equal texts of a class and fold teach once; where the folds that
feed the models lack a class every score is 0; where only the fit fold does, the length-normalised
log ratio is the score's logit; very long texts are one block, read whole; texts that tie score alike;
an empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import bloom_filter, by_group, crc_mod, discard, keep_rows, let_go, mix64, row_key, scratch, words

FOLDS = 5
HELD_OUT = 0
#: The fold the logistic function is fitted on; the others feed the models.
FIT_FOLD = 4
DISCOUNT = 3.0
WINDOWS = (2, 16)
PARTNERS = 3
NOISE = 6.0
#: Weight, in occurrences, of the back-off in every context.
PRIOR = 200.0
#: So many words count as a text's most suspicious ones.
TOP = 4
#: Words of the texts that are looked up, or counted, together.
BLOCK_WORDS = 1 << 20
COUNT_WORDS = 1 << 18
#: Rows of the model in one key range, about; and the fewest ranges.
RANGE_ROWS = 1 << 17
RANGES = 16
#: Stands before a text's first word.
START = 1
#: Words of a row of texts.
CHUNK_WORDS = 1 << 16
_ANSWER = np.dtype([("number", np.uint32), ("a", np.float32), ("b", np.float32)])


class _Block:
    """Texts as runs of word numbers, and the 64-bit hashes of the words; the
    last number is that of ``START``."""

    def __init__(self, size: int):
        self.size = size
        self.codes: defaultdict = defaultdict()
        self.codes.default_factory = self.codes.__len__
        self.runs: list[np.ndarray] = []
        self.rows: list[tuple] = []
        self.n = 0

    def add(self, text: str | None, *row) -> bool:
        """Takes a text; True when the block is full."""
        found = words(text)
        self.runs.append(np.fromiter(map(self.codes.__getitem__, found), np.int32, len(found)))
        self.rows.append(row)
        self.n += len(found)
        return self.n >= self.size or len(self.rows) >= self.size // 16

    def close(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, sizes, word number, number of the word before). The block's
        strings and runs are let go first: what follows needs the memory."""
        h = np.fromiter((int.from_bytes(blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for w in self.codes), np.uint64, len(self.codes))
        self.codes.clear()
        sizes = np.fromiter(map(len, self.runs), np.int64, len(self.runs))
        flat = np.concatenate([*self.runs, np.zeros(0, np.int32)]).astype(np.int64)
        self.runs.clear()
        before = np.concatenate([[0], flat[:-1]])[:len(flat)]
        before[(np.cumsum(sizes) - sizes)[sizes > 0]] = len(h)
        return np.append(h, np.uint64(START)), sizes, flat, before


def _blocks(batches, columns, size):
    let_go()
    block = _Block(size)
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            part = batch.slice(a, 256)
            for text, *row in zip(part.column("text").to_pylist(), *(part.column(c).to_pylist() for c in columns), strict=True):
                if block.add(text, *row):
                    yield block
                    block = _Block(size)
    if block.rows:
        yield block


def bigram_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """64-bit key of a bigram by its words' hashes."""
    return mix64(mix64(v + np.uint64(0x9E3779B97F4A7C15)) + w)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic, fold of the labelled rows outside the held-out fold: one
    per distinct text, class and fold, found on hashes alone."""
    known = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .withColumn("fold", crc_mod("doc_id", FOLDS)).where(F.col("fold") != HELD_OUT))
    # labels grow with the documents, so no join may broadcast them
    hashed = docs.select("doc_id", F.xxhash64("text").alias("h"))
    return scratch(hashed.join(known.hint("merge"), "doc_id").groupBy("h", "toxic", "fold").agg(F.min("doc_id").alias("doc_id")).drop("h"), "toxic-labels")


def training_rows(docs: DataFrame, once: DataFrame) -> DataFrame:
    """text, toxic of the rows that feed the models. A Bloom filter of their
    ids keeps other texts out of the shuffle."""
    once = once.where(F.col("fold") != FIT_FOLD).select("doc_id", "toxic")
    may = bloom_filter(once.withColumn("k", F.xxhash64("doc_id")), "k")
    return docs.select("doc_id", "text").where(may(F.xxhash64("doc_id"))).join(once.hint("merge"), "doc_id").select("text", "toxic")


def count_bigrams(rows: DataFrame) -> DataFrame:
    """v, w, n0, n1, d0, d1: occurrences of each bigram in ordinary and toxic
    rows, and rows that have it."""
    def run(batches):
        for block in _blocks(batches, ["toxic"], COUNT_WORDS):
            h, sizes, flat, before = block.close()
            toxic, row = np.array([bool(r[0]) for r in block.rows]), np.repeat(np.arange(len(sizes)), sizes)
            pairs, at = np.unique(before * len(h) + flat, return_inverse=True)
            each = np.unique(at * len(sizes) + row)
            n = [np.bincount(x[toxic[r] == c], minlength=len(pairs)) for x, r in ((at, row), (each // len(sizes), each % len(sizes))) for c in (False, True)]
            cols = [h[pairs // len(h)].view(np.int64), h[pairs % len(h)].view(np.int64), *n]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["v", "w", "n0", "n1", "d0", "d1"])
    return (rows.mapInArrow(run, "v long, w long, n0 long, n1 long, d0 long, d1 long")
            .groupBy("v", "w").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "d0", "d1")]))


def model(counts: DataFrame) -> tuple[DataFrame, float]:
    """(key, a, b) and the log ratio of a word without evidence. A bigram's row
    has its log ratio as a; a word's has what it gives as a context, a, and as
    the word, b, to bigrams without a row. Left out is only what has no ratio of
    its own: bigrams that differ by noise and lack ``PARTNERS``, or of which the
    discount leaves nothing in either class, and words without evidence before which there are only such."""
    of = {c: [F.col(f"{c}{i}") for i in (0, 1)] for c in ("n", "d", "t", "e", "own", "total", "mass", "word")}
    sums = counts.agg(*[F.coalesce(F.sum(x), F.lit(0)).alias(f"n{c}") for c, x in enumerate(of["n"])],
                      *[F.coalesce(F.sum(x), F.lit(0)).alias(f"d{c}") for c, x in enumerate(of["d"])],
                      *[F.coalesce(F.sum(F.signum(x)), F.lit(0)).alias(f"t{c}") for c, x in enumerate(of["n"])], F.count(F.lit(1)).alias("t")).first()
    scale = {k: [min(sums[f"{k}0"], sums[f"{k}1"]) / max(sums[f"{k}{c}"], 1) for c in (0, 1)] for k in "ndt"}
    texts = [x * scale["d"][c] for c, x in enumerate(of["d"])]
    differs = F.abs(texts[1] - texts[0]) > NOISE * F.sqrt(texts[1] + texts[0])

    repeated = F.col("n0") + F.col("n1") > 1
    by_word = counts.groupBy("w").agg(*[F.sum(x).alias(f"d{c}") for c, x in enumerate(of["d"])], *[F.sum(F.signum(x)).alias(f"t{c}") for c, x in enumerate(of["n"])], F.count(F.lit(1)).alias("t"), F.count_if(repeated).alias("after"))
    by_word = by_word.select("w", "t", "after", *[(x * scale["t"][c]).alias(f"t{c}") for c, x in enumerate(of["t"])], *[F.when(differs, x).otherwise(0.0).alias(f"d{c}") for c, x in enumerate(texts)])
    by_word = scratch(by_word.select("w", "t", "after", *[F.greatest(t, d).alias(f"t{c}") for c, (t, d) in enumerate(zip(of["t"], of["d"], strict=True))],
                                     *[F.greatest(t - DISCOUNT, d - DISCOUNT * F.sqrt(d), F.lit(0.0)).alias(f"own{c}") for c, (t, d) in enumerate(zip(of["t"], of["d"], strict=True))]), "toxic-words")
    owned = by_word.agg(F.count(F.lit(1)).alias("words"), *[F.coalesce(F.sum(x), F.lit(0.0)).alias(f"{k}{c}") for k in ("t", "own") for c, x in enumerate(of[k])]).first()
    size = [owned[f"t{c}"] for c in (0, 1)]
    left = [size[c] - owned[f"own{c}"] + 1 for c in (0, 1)]
    shared = (F.col("t") + 0.5) / (sums["t"] + 0.5 * (owned["words"] + 1))
    word = by_word.select("w", "after", (F.col("own0") + F.col("own1") > 0).alias("evident"), *[((x + left[c] * shared) / (size[c] + 1)).alias(f"word{c}") for c, x in enumerate(of["own"])])
    base = float(np.log(left[1] / (size[1] + 1)) - np.log(left[0] / (size[0] + 1)))

    scaled = [x * scale["n"][c] for c, x in enumerate(of["n"])]
    rest = [F.greatest(x - DISCOUNT * F.sqrt(x), F.lit(0.0)).alias(f"e{c}") for c, x in enumerate(scaled)]
    by_context = scratch(counts.groupBy("v").agg(*[F.sum(x).alias(f"total{c}") for c, x in enumerate(scaled)], F.count_if(repeated).alias("before")), "toxic-sides")
    kept = scratch(counts.select("v", "w", differs.alias("differs"), *rest).where("e0 > 0 or e1 > 0").join(word.drop("evident"), "w").join(by_context, "v")
                   .where(F.col("differs") | (F.col("before") >= PARTNERS) & (F.col("after") >= PARTNERS)).drop("differs", "before", "after"), "toxic-kept")
    # what the kept bigrams leave of the context goes to the back-off
    gone = kept.groupBy("v").agg(*[F.first(x).alias(f"total{c}") for c, x in enumerate(of["total"])], *[F.sum(x).alias(f"s{c}") for c, x in enumerate(of["e"])])
    context = scratch(gone.select("v", *[x.alias(f"total{c}") for c, x in enumerate(of["total"])], *[(x - F.col(f"s{c}")).alias(f"mass{c}") for c, x in enumerate(of["total"])]), "toxic-contexts")

    def ratio(p):
        return F.log(p[1]) - F.log(p[0])
    bigrams = (kept.drop("total0", "total1").join(context, "v")
               .select("v", "w", ratio([(of["e"][c] + (of["mass"][c] + PRIOR) * of["word"][c]) / (of["total"][c] + PRIOR) for c in (0, 1)]).alias("a")))

    def keyed(batches):
        for batch in batches:
            v, w = (batch.column(c).to_numpy().view(np.uint64) for c in "vw")
            yield pa.RecordBatch.from_arrays([pa.array(bigram_key(v, w).view(np.int64)), batch.column("a"), pa.nulls(len(v), pa.float64())], ["key", "a", "b"])
    before = context.select(F.col("v").alias("key"), ratio([(of["mass"][c] + PRIOR) / (of["total"][c] + PRIOR) for c in (0, 1)]).alias("a"))
    single = (word.where("evident").select(F.col("w").alias("key"), ratio(of["word"]).alias("b")).join(before, "key", "full")
              .select("key", F.coalesce("a", F.lit(0.0)).alias("a"), F.coalesce("b", F.lit(base)).alias("b")))
    out = scratch(bigrams.mapInArrow(keyed, "key long, a double, b double").unionByName(single), "toxic-model")
    discard(by_word, by_context, kept, context)
    return out, base


def _planes(records: np.ndarray) -> bytes:
    """Records as bytes: all first bytes, all second ones and so on, which pack
    well where some bytes are small or alike."""
    return pa.compress(np.ascontiguousarray(records.view(np.uint8).reshape(len(records), -1).T).tobytes(), "zstd", asbytes=True) if len(records) else b""


def _unplanes(data: bytes, n: int, kind) -> np.ndarray:
    if n == 0:
        return np.zeros(0, kind)
    flat = np.frombuffer(pa.decompress(data, np.dtype(kind).itemsize * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(-1, n).T).view(kind).ravel()


def _pairs(flat: np.ndarray, sizes: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct bigrams, ascending; the bigram of each word; the word before),
    ``h - 1`` being the number of ``START``. The same for a block's texts in any
    order, so a reader of the words finds the writer's numbers."""
    before = np.concatenate([[0], flat[:-1]])[:len(flat)]
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = h - 1
    pairs, pair = np.unique(before * h + flat, return_inverse=True)
    return pairs, pair, before


def _asked(docs: DataFrame, table: DataFrame, ranges: int) -> DataFrame:
    """Blocks of texts. Part 0 asks for the keys of one range, each under a
    number of its block (``sizes``: how many, and the bytes of the numbers);
    part 1 says which of the block's words and bigrams asked; part 2 are the
    texts as word numbers, about ``CHUNK_WORDS`` words a row."""
    may, kind = bloom_filter(table, "key").func, docs.schema["doc_id"].dataType.simpleString()
    names = ["block", "part", "range", "ids", "keys", "sizes", "text"]

    def run(batches):
        at, id_type = TaskContext.get().partitionId() << 32, None

        def seen(batches):
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field("doc_id").type
                yield batch
        for block in _blocks(seen(batches), ["doc_id", "__key"], BLOCK_WORDS):
            h, sizes, flat, _ = block.close()
            # common words first; START, which is no text's word, stays last
            order = np.argsort(-np.bincount(flat, minlength=len(h)), kind="stable")
            rank = np.empty(len(h), np.int64)
            rank[order] = np.arange(len(h))
            h, flat = h[order], rank[flat]
            pairs = _pairs(flat, sizes, len(h))[0]
            keys = np.concatenate([h, bigram_key(h[pairs // len(h)], h[pairs % len(h)])]).view(np.int64)
            hit = np.concatenate([may(pd.Series(keys[i:i + 65536])).to_numpy(bool) for i in range(0, len(keys), 65536)])
            asked = keys[hit]
            del keys, pairs, rank, order

            def batch(part, of_range, ids=None, of=None, size=None, text=None, at=at):
                k = len(of_range)
                values = [pa.nulls(k, t) if x is None else pa.array(x, t) for x, t in (
                    (ids, pa.list_(id_type)), (of, pa.list_(pa.int64())), (size, pa.list_(pa.int64())), (text, pa.binary()))]
                return pa.RecordBatch.from_arrays([pa.array(np.full(k, at)), pa.array(np.full(k, part, np.int32)), pa.array(of_range, pa.int32()), *values], names)
            # a range's keys in the order of their numbers, which are differences
            of_key = (asked.view(np.uint64) >> np.uint64(64 - ranges.bit_length() + 1)).astype(np.int64)
            order = np.argsort(of_key, kind="stable")
            found, first = np.unique(of_key[order], return_index=True)
            for r, at_range in zip(found.tolist(), np.split(order, first[1:]), strict=True):
                steps = _planes(np.diff(at_range + 1, prepend=0).astype(np.uint32))
                yield batch(0, [r], size=[[len(at_range), len(steps)]], text=[steps + asked[at_range].tobytes()])
            yield batch(1, [0], size=[[len(h), len(hit)]], text=[pa.compress(np.packbits(hit).tobytes(), "zstd", asbytes=True)])
            ends = np.cumsum(sizes)
            a = 0
            while a < len(sizes):
                b = max(a + 1, int(np.searchsorted(ends, ends[a] - sizes[a] + CHUNK_WORDS)))
                rows = block.rows[a:b]
                yield batch(2, [0], ids=[[r[0] for r in rows]], of=[[r[1] for r in rows]], size=[sizes[a:b].tolist()], text=[_planes(flat[ends[a] - sizes[a]:ends[b - 1]].astype(np.uint32))])
                a = b
            at += 1
    rows = docs.select("doc_id", row_key().alias("__key"), "text")
    return scratch(rows.mapInArrow(run, f"block long, part int, range int, ids array<{kind}>, keys array<long>, sizes array<long>, text binary"), "toxic-asked")


def _features(r: np.ndarray) -> list[float]:
    n = len(r)
    if n == 0:
        return [0.0] * (3 + len(WINDOWS))
    sums = np.concatenate([[0.0], np.cumsum(r)])
    runs = [float((sums[min(k, n):] - sums[:n + 1 - min(k, n)]).max() / min(k, n)) for k in WINDOWS]
    return [float(r.mean()), *runs, float(np.sort(r)[-TOP:].mean()), float(np.log1p(n))]


def features(docs: DataFrame, table: DataFrame, base: float) -> DataFrame:
    """doc_id, __key, x (the text's features) for every row of ``docs``."""
    ranges = RANGES
    while ranges * RANGE_ROWS < table.count():
        ranges *= 2
    asked, kind = _asked(docs, table, ranges), docs.schema["doc_id"].dataType.simpleString()
    schema = f"block long, part int, ids array<{kind}>, keys array<long>, sizes array<long>, text binary"
    id_type = docs.select("doc_id").limit(0).toArrow().schema.field("doc_id").type

    def answered(batches):
        """A range's part of the table, sorted, then what blocks ask of it."""
        held, own, known = [], None, None
        for batch in batches:
            of, asks = batch.column("range").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
            cut = np.flatnonzero((np.diff(of) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(of)], strict=True):
                if a == b:
                    continue
                if own != of[a]:
                    held, own, known = [], of[a], None
                part = batch.slice(a, b - a)
                if not asks[a]:
                    held.append([part.column(c).to_numpy(zero_copy_only=False) for c in ("key", "a", "b")])
                    continue
                if known is None:
                    known = [np.concatenate(x) for x in zip(*held, strict=True)] or [np.zeros(0, np.int64)] + [np.zeros(0)] * 2
                key, log_a, log_b = known
                blocks, sizes, texts = [], [], []
                for block, (n, size), text in zip(*(part.column(c).to_pylist() for c in ("block", "sizes", "text")), strict=True):
                    number = np.cumsum(_unplanes(text[:size], n, np.uint32), dtype=np.int64)
                    ask = np.frombuffer(text, np.int64, n, size)
                    at = np.minimum(np.searchsorted(key, ask), max(len(key) - 1, 0))
                    hit = np.flatnonzero(key[at] == ask) if len(key) else np.zeros(0, np.int64)
                    if len(hit):
                        out = np.empty(len(hit), _ANSWER)
                        out["number"], out["a"], out["b"] = np.diff(number[hit], prepend=0), log_a[at[hit]], log_b[at[hit]]
                        blocks.append(block)
                        sizes.append([len(hit)])
                        texts.append(_planes(out))
                k = len(blocks)
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(np.zeros(k, np.int32)), pa.nulls(k, pa.list_(id_type)), pa.nulls(k, pa.list_(pa.int64())),
                                                  pa.array(sizes, pa.list_(pa.int64())), pa.array(texts, pa.binary())], ["block", "part", "ids", "keys", "sizes", "text"])
    none = F.lit(None)
    rows = table.select(F.shiftrightunsigned("key", 64 - ranges.bit_length() + 1).cast("int").alias("range"), F.lit(False).alias("asks"), "key", "a", "b",
                        none.cast("long").alias("block"), none.cast("array<long>").alias("sizes"), none.cast("binary").alias("text"))
    asks = asked.where("part = 0").select("range", F.lit(True).alias("asks"), none.cast("long").alias("key"), none.cast("double").alias("a"), none.cast("double").alias("b"), "block", "sizes", "text")
    answers = (rows.unionByName(asks).repartitionById(ranges, "range").sortWithinPartitions("range", "asks", "key")
               .mapInArrow(answered, schema))
    texts = asked.where("part > 0").select(*[c.split()[0] for c in schema.split(", ")])

    def run(groups):
        for _, t in groups:
            part = t.column("part").to_numpy()
            blobs, (head,), rows = t.filter(part == 0), t.filter(part == 1).to_pylist(), t.filter(part == 2)
            h, n_keys = head["sizes"]
            hit = np.unpackbits(np.frombuffer(pa.decompress(head["text"], -(-n_keys // 8), "zstd", asbytes=True), np.uint8), count=n_keys).astype(bool)
            number = np.where(hit, np.cumsum(hit), 0)
            m = int(number.max(initial=0)) + 1
            a, b, own = np.zeros(m, np.float32), np.full(m, base, np.float32), np.full(m, np.nan, np.float32)
            for blob, (k,) in zip(blobs.column("text"), blobs.column("sizes").to_pylist(), strict=True):
                hits = _unplanes(blob.as_py(), k, _ANSWER)
                at = np.cumsum(hits["number"], dtype=np.int64)
                a[at] = own[at] = hits["a"]
                b[at] = hits["b"]
            per = [np.array(x, np.int64) for x in rows.column("sizes").to_pylist()]
            sizes = np.concatenate(per)
            flat = np.concatenate([_unplanes(x.as_py(), int(n.sum()), np.uint32).astype(np.int64) for x, n in zip(rows.column("text"), per, strict=True)])
            _, pair, before = _pairs(flat, sizes, h)
            r = own[number[h + pair]]
            r = np.where(np.isnan(r), a[number[before]] + b[number[flat]], r).astype(np.float64)
            ends = np.cumsum(sizes)
            x = [_features(r[e - n:e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
            ids, keys = (pa.concat_arrays([c.flatten() for c in rows.column(k).chunks]) for k in ("ids", "keys"))
            for lo in range(0, len(x), 4096):
                yield pa.RecordBatch.from_arrays([ids.slice(lo, 4096), keys.slice(lo, 4096), pa.array(x[lo:lo + 4096], pa.list_(pa.float64()))], ["doc_id", "__key", "x"])
    out = scratch(by_group(answers.unionByName(texts), ["block"], run, f"doc_id {kind}, __key long, x array<double>", order=["part"]), "toxic-features")
    discard(asked)
    return out


def logistic(rows: DataFrame, rounds: int = 30, ridge: float = 1e-3) -> np.ndarray:
    """Newton steps for ridge logistic regression of toxic on x, features
    scaled inside; every step sums over all rows in Spark."""
    wide = 3 + len(WINDOWS)
    moments = rows.agg(F.count(F.lit(1)), *[f(F.col("x")[i]) for f in (F.avg, F.stddev_pop) for i in range(wide)]).first()
    n, mean, scale = moments[0], np.array(moments[1:wide + 1]), np.array(moments[wide + 1:]) + 1e-9
    b = np.zeros(wide + 1)
    for _ in range(rounds):
        def run(batches, b=b):
            h, g = np.zeros((wide + 1, wide + 1)), np.zeros(wide + 1)
            for batch in batches:
                x, y = batch.column("x").flatten().to_numpy().reshape(-1, wide), batch.column("toxic").to_numpy() > 0
                z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
                p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
                h, g = h + (z * (p * (1 - p))[:, None]).T @ z, g + z.T @ (y - p)
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([h.ravel(), g]).tolist()], pa.list_(pa.float64()))], ["s"])
        s = rows.mapInArrow(run, "s array<double>").agg(*[F.sum(F.col("s")[i]) for i in range((wide + 1) * (wide + 2))]).first()
        h, g = np.array(s[:-wide - 1]).reshape(wide + 1, -1), np.array(s[-wide - 1:])
        step = np.linalg.solve(h + ridge * n * np.eye(wide + 1), g - ridge * n * b)
        b = b + step
        if np.abs(step).max() < 1e-7:
            break
    w = b[1:] / scale
    return np.concatenate([[b[0] - (w * mean).sum()], w])


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, __key, score for every row of ``docs``, trained on ``labels``."""
    once = labelled(docs, labels)
    fitted, toxic = F.col("fold") == FIT_FOLD, F.col("toxic") > 0
    seen = once.agg(F.count_distinct(F.when(~fitted, toxic)).alias("models"), F.count_distinct(F.when(fitted, toxic)).alias("fit")).first()
    if seen["models"] < 2:
        return docs.select("doc_id", row_key().alias("__key"), F.lit(0.0).alias("score"))
    counts = scratch(count_bigrams(training_rows(docs, once)), "toxic-bigrams")
    table, base = model(counts)
    discard(counts)
    found = features(docs, table, base)
    discard(table)
    if seen["fit"] < 2:  # nothing to fit on: the length-normalised log ratio itself
        return found.select("doc_id", "__key", (1 / (1 + F.exp(-F.col("x")[0]))).alias("score"))
    fit = once.where(F.col("fold") == FIT_FOLD).select("doc_id", F.col("toxic").cast("long").alias("toxic"))
    w = logistic(scratch(found.join(fit.hint("merge"), "doc_id").select("x", "toxic"), "toxic-fit"))
    z = sum((F.col("x")[i] * float(x) for i, x in enumerate(w[1:])), F.lit(float(w[0])))
    return found.select("doc_id", "__key", (1 / (1 + F.exp(-F.least(F.greatest(z, F.lit(-30.0)), F.lit(30.0))))).alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    held: Column = crc_mod("doc_id", FOLDS) == HELD_OUT
    return (scored(docs, labels).select("doc_id", held.alias("held_out"), "score")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns kept."""
    toxic = scored(docs, labels).where("score >= 0.5").select("doc_id", "__key").distinct()
    return keep_rows(docs, scratch(toxic.withColumn("kept", F.lit(False)), "toxic-drop"))
