"""Packing documents into sequences by cutting-stock column generation.

A document's ids are cut after every ``SEQ`` ids; the pieces' lengths, rounded
up to ``STEP`` ids, form a histogram of at most ``SEQ / STEP`` classes, counted
over all documents. On it the driver solves the linear program "cover every
class with the fewest sequences" by column generation: the simplex method keeps
one pattern per class, and a knapsack dynamic program prices new patterns.
Patterns are rounded down; the few pieces left (fewer than one pattern per
class) are packed best-fit on the histogram. Each class's pieces are ranked by
distributed counts and running sums, and a rank decides pattern, sequence and
place.

Cases: null and empty texts have the end id alone; a sequence is at most SEQ
long and gapless; repeated rows are separate documents; an empty table gives an
empty result; extra columns are not looked at. A text is tokenised in runs of
whole white-space-separated strings, which the tokenizer never joins, so a very
long text needs no large encoding at once.
"""

from __future__ import annotations

import zlib
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txlake.llm.common import KEPT, scratch

SEQ = 2048
STEP = 8
END_ID = 1
#: The linear program ends when no pattern promises more than this share.
GAP = 2e-4
#: Strings whose ids a worker remembers, and the characters of the longest.
REMEMBER = 1_000_000
LONGEST = 64
#: Bytes of text that are cut at once.
RUN = 4 << 20


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


#: The tokenizer's own cut of lower-cased text into the strings it encodes one
#: by one (a fixed value of its file).
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
#: Texts with these are not cut here: from U+0130 on, and for the signs left
#: out, lower case or normal form may need context; "<|" may begin a special id.
_ODD = r"[^\x20-\x7E\t\n\r\x{A1}-\x{12F}]|<\|"


@lru_cache(maxsize=2)
def _encoder(path: str):
    """Arrow array of texts -> each text's ids with the end id, as
    little-endian unsigned 32-bit bytes.

    Arrow cuts the texts at white space and numbers the different strings.
    Those already met come from memory, which a worker keeps between tasks; the
    pieces of new ones are encoded together, in one text. Strings of a text
    that matches ``_ODD`` are encoded whole."""
    import regex
    from tokenizers import Tokenizer
    tokenizer, known = Tokenizer.from_file(path), {}
    cut = regex.compile(_PIECES).findall

    def learn(new: list[str], plainly: bool) -> None:
        for i in range(0, len(new), 4096):
            part = new[i:i + 4096]
            if plainly:
                e = tokenizer.encode(" ".join(part), add_special_tokens=False)
                word = np.asarray(e.word_ids, np.int64)
                if len(word) and word[-1] == len(part) - 1 and (np.diff(word) <= 1).all() and word[0] == 0:
                    ids, ends = np.asarray(e.ids, "<u4"), np.searchsorted(word, np.arange(len(part) + 1))
                    known.update((w, ids[a:b].tobytes()) for w, a, b in zip(part, ends[:-1].tolist(), ends[1:].tolist(), strict=True))
                    continue
            for w, e in zip(part, tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                known[w] = np.asarray(e.ids, "<u4").tobytes()

    def find(strings: list[str]) -> list[bytes]:
        """The ids of different strings; a space before one asks for it whole."""
        new = [w for w in strings if w not in known]
        if len(known) + len(new) > REMEMBER:
            # the strings met first are the commonest as a rule
            first = list(islice(known.items(), REMEMBER // 2))
            known.clear()
            known.update(first)
            new = [w for w in strings if w not in known]
        pieces = {w: [w] if w.isalpha() else cut(w) for w in new if w[:1] != " "}
        learn(list(set().union(*pieces.values()).difference(known)), True)
        learn([w for w in new if w[:1] == " "], False)
        got = known.__getitem__
        known.update([(w, b"".join(map(got, p))) for w, p in pieces.items() if p != [w]])
        out = list(map(got, strings))
        for w in new:
            if len(w) > LONGEST:
                del known[w]
        return out

    def encode(texts: pa.Array) -> list[bytes]:
        texts = pc.fill_null(texts, "")
        split = pc.utf8_split_whitespace(pc.utf8_lower(texts))
        odd = pc.match_substring_regex(texts, _ODD)
        if odd.true_count:
            whole = [[" " + w.decode() for w in t.as_py().encode().split()] if o else None for t, o in zip(texts, odd.to_pylist(), strict=True)]
            split = pc.coalesce(pa.array(whole, split.type), split)
        strings = split.flatten().dictionary_encode()
        data = find(strings.dictionary.to_pylist())
        ids, size = np.frombuffer(b"".join(data), "<u4"), np.fromiter(map(len, data), np.int64, len(data)) // 4
        # string by string, its run of ids
        start, at = np.cumsum(size) - size, strings.indices.to_numpy()
        n = size[at]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
        ids = ids[np.arange(ends[-1]) + np.repeat(start[at] - ends[:-1], n)]
        bounds = ends[np.concatenate([np.zeros(1, np.int64), np.cumsum(pc.list_value_length(split).to_numpy())])].tolist()
        end = END_ID.to_bytes(4, "little")
        return [ids[a:b].tobytes() + end for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return encode


KEPT.append(_encoder.cache_clear)


def _runs(texts: pa.Array) -> list[tuple[int, int]]:
    """(first row, rows) of runs of up to ``RUN`` bytes; a longer text is alone."""
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    out, a = [], 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + RUN, "right")))
        out.append((a, b - a))
        a = b
    return out


def tokenized(docs: DataFrame, tokenizer: str, ids: bool = False) -> DataFrame:
    """doc_id, doc_tokens, crcs (one per piece), and with ``ids`` the pieces' ids."""
    def run(batches):
        encode = _encoder(tokenizer)
        for batch in batches:
            texts = batch.column("text")
            for a, n in _runs(texts):
                data = encode(texts.slice(a, n))
                cuts = [[d[i:i + 4 * SEQ] for i in range(0, len(d), 4 * SEQ)] for d in data]
                cols = [batch.column("doc_id").slice(a, n), pa.array([len(d) // 4 for d in data], pa.int64()),
                        pa.array([[zlib.crc32(c) for c in cs] for cs in cuts], pa.list_(pa.int64()))]
                if ids:
                    cols.append(pa.array([[np.frombuffer(c, "<u4").astype(np.int32) for c in cs] for cs in cuts], pa.list_(pa.list_(pa.int32()))))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "doc_tokens", "crcs", "ids"][:len(cols)])
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, doc_tokens long, crcs array<long>"
    return docs.select("doc_id", "text").mapInArrow(run, schema + (", ids array<array<int>>" if ids else ""))


# ------------------------------------------------------- the linear program

def _price(value: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern (count per class 1..room) of most value."""
    best, take = np.zeros(room + 1), np.zeros(room + 1, np.int64)
    for r in range(1, room + 1):
        v = value[:r] + best[r - 1::-1][:r]
        k = int(v.argmax())
        best[r], take[r] = (v[k], k + 1) if v[k] > best[r - 1] + 1e-12 else (best[r - 1], 0)
    pattern, r = np.zeros(room, np.int64), room
    while r > 0:
        if take[r]:
            pattern[take[r] - 1] += 1
            r -= take[r]
        else:
            r -= 1
    return best[room], pattern


def _best_fit(count: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """Packs a histogram greedily, largest first, repeating each pattern as
    often as it fits."""
    count, out = count.copy(), []
    while count.any():
        pattern, left = np.zeros(room, np.int64), room
        for c in np.flatnonzero(count)[::-1]:
            n = min(left // (c + 1), count[c])
            pattern[c], left = n, left - n * (c + 1)
        times = int((count[pattern > 0] // pattern[pattern > 0]).min())
        out.append((pattern, times))
        count -= pattern * times
    return out


def patterns(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """(pattern, times): patterns over classes 1..room of total size <= room
    that together cover ``histogram`` exactly."""
    count = np.zeros(room, np.int64)
    for c, n in histogram.items():
        count[c - 1] = n
    have = np.flatnonzero(count)
    m = len(have)
    left, out = count.copy(), []
    if m:
        # basis: for each class the pattern of that class alone
        cols = [np.where(np.arange(room) == c, room // (c + 1), 0) for c in have]
        inverse = np.diag([1.0 / (room // (c + 1)) for c in have])
        x = count[have] * np.diag(inverse)
        for _ in range(40 * m):
            dual = inverse.sum(axis=0)
            value = np.zeros(room)
            value[have] = np.maximum(dual, 0)
            worth, pattern = _price(value, room)
            if worth <= 1 + GAP:
                break
            d = inverse @ pattern[have]
            ok = d > 1e-9
            ratio = np.where(ok, x / np.where(ok, d, 1), np.inf)
            out_row = int(ratio.argmin())
            step = ratio[out_row]
            x = np.maximum(x - step * d, 0)
            x[out_row] = step
            inverse[out_row] /= d[out_row]
            rest = d.copy()
            rest[out_row] = 0
            inverse -= np.outer(rest, inverse[out_row])
            cols[out_row] = pattern
        for pattern, times in zip(cols, np.floor(x + 1e-6).astype(np.int64), strict=True):
            use = pattern > 0
            times = min(int(times), int((left[use] // pattern[use]).min()))
            if times > 0:
                out.append((pattern, times))
                left -= pattern * times
    out += _best_fit(left, room)
    return [({int(c) + 1: int(p[c]) for c in np.flatnonzero(p)}, t) for p, t in out]


# ------------------------------------------------------------------ assigning

def _ranked(pieces: DataFrame) -> DataFrame:
    """Numbers the pieces of each class from 0: parts by hash are counted
    first, so no task holds a whole class."""
    parts = max(1, int(pieces.count() ** 0.5))
    p = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "rid"), F.lit(parts)))
    counts = p.groupBy("cls", "part").count()
    base = counts.select("cls", "part", (F.sum("count").over(Window.partitionBy("cls").orderBy("part")) - F.col("count")).alias("base"))
    own = Window.partitionBy("cls", "part").orderBy("doc_id", "start", "rid")
    return (p.withColumn("nth", F.row_number().over(own) - 1).join(base, ["cls", "part"])
            .withColumn("rank", F.col("base") + F.col("nth")).drop("part", "nth", "base"))


def pack(docs: DataFrame, tokenizer: str | None = None, ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (and ids)."""
    spark = docs.sparkSession
    tokens = scratch(tokenized(docs, tokenizer or default_tokenizer(), ids).withColumn("rid", F.monotonically_increasing_id()), "pack-tokens")
    at = tokens.select("doc_id", "doc_tokens", "rid", F.posexplode("crcs").alias("k", "ids_crc32"), *(["ids"] if ids else []))
    pieces = (at.withColumn("start", F.col("k").cast("long") * SEQ)
              .withColumn("length", F.least(F.col("doc_tokens") - F.col("start"), F.lit(SEQ).cast("long")))
              .withColumn("cls", F.expr(f"(length + {STEP - 1}) div {STEP}")))
    if ids:
        pieces = pieces.withColumn("ids", F.col("ids")[F.col("k")])
    # at most SEQ / STEP rows reach the driver
    histogram = {r["cls"]: r["count"] for r in pieces.groupBy("cls").count().collect()}
    plan, used, sequence = [], dict.fromkeys(histogram, 0), 0
    for pattern, times in patterns(histogram, SEQ // STEP):
        for c, n in pattern.items():
            plan.append((c, used[c], used[c] + n * times, n, sequence))
            used[c] += n * times
        sequence += times
    # by class, the first ranks of its patterns: a few rows per class and pattern
    slots = (spark.createDataFrame(plan, "cls long, lo long, hi long, n long, seq long")
             .groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("lo", "n", "seq"))).alias("plan")))
    ranked = _ranked(pieces).join(F.broadcast(slots), "cls")
    own = ranked.withColumn("p", F.element_at(F.filter("plan", lambda s: s["lo"] <= F.col("rank")), -1))
    placed = own.withColumn("sequence_id", F.col("p.seq") + F.expr("(rank - p.lo) div p.n"))
    run = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "rid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         (F.sum("length").over(run) - F.col("length")).alias("offset"), *(["ids"] if ids else []))
