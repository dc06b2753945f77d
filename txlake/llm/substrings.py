"""Substring deduplication by collinear chaining.

1. Seeds: every run of ``K`` words, so equal runs of ``K`` words always share
   one, however often a passage is changed elsewhere.
2. Every seed occurrence is joined with one anchor, the occurrence in the least
   document that has it (that document's own occurrences with the greatest), so
   the number of matches is that of the occurrences, however common a passage
   is. Texts are written as their words' hashes; blocks of them name their distinct seeds packed by range of hashes, the
   ranges answer with the anchors of those that another document has, and only
   these become rows: one for each run of matches on one diagonal.
3. The matches of a document with an anchor document are chained: increasing
   in both texts, gaps costing ``GAP_COST`` a word, the best predecessor found
   in a Fenwick tree of prefix maxima.
4. Chains are aligned word by word: gaps by edit distance, ends extended over
   short differences. Aligned spans of both documents, where at least
   ``IDENTITY`` of the words match, are merged per document; passages of
   ``MIN_WORDS`` or more are the result.

Cases: null and short texts have no passages; rows equal in id and text are one
document; repeats inside one document do not count; an empty table gives an
empty result; extra columns are not looked at; whole texts are read, however
long.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import bloom_filter, by_group, discard, free_shuffles, mix64, row_key, scratch, text_hashes, word_hashes

K = 5
#: Of neighbouring equal runs (one word over and over) one in so many is a seed.
SAME = 16
GAP_COST = 0.1
MAX_GAP = 64
MARGIN = 64
#: Words beyond a chain that are read first; only where an alignment looks farther
#: are ``MARGIN`` words read.
NARROW = 12
SKIP = 6
RESUME = 3
IDENTITY = 0.75
MIN_WORDS = 50
#: Spans of a document that are this near belong to one passage.
NEAR = 8
#: Chains of two documents that begin in the same so many words of both are one
#: row, whose words are read once: a line repeated all over a document asks for
#: its surroundings once, not at every repeat.
REGION = 256
#: Words of the texts whose seeds are named together; seeds of one range of
#: hashes, about, and the fewest ranges; characters of a word, about. A block has
#: a row for every range, and rows of few seeds cost more than the seeds in them:
#: from so many ranges on they are larger ones, of up to so many seeds.
BLOCK_WORDS = 1 << 20
RANGE_SEEDS = 1 << 20
RANGES = 16
MANY_RANGES = 512
MOST_SEEDS = 1 << 22
CHARS = 6
#: Bytes by which a range tells its seeds apart: with the range's size fixed, one
#: in some two million seeds is taken for another, whatever the table's size.
TAIL = 5
#: Up to so many numbers are written plain.
PLAIN = 512
#: What the words of a run are multiplied by, each spread over 64 bits before.
_FACTORS = mix64(np.arange(1, K + 1)) | np.uint64(1)
CHAINS = "k long, anchor long, xs array<array<int>>, ys array<array<int>>, lo0 long, hi0 long, lo1 long, hi1 long"
_COLUMNS = ("block", "base", "part", "range", "n", "m", "a", "b", "c", "d", "e", "f")
_SCHEMA = "block long, base long, part int, range int, n int, m int, a binary, b binary, c binary, d binary, e binary, f binary"
#: Span requests of one document answered by one reading of its text.
REQUESTS = 256
#: Words of the spans that are handed on together, about.
SLICE_WORDS = 1 << 16


def seeds_of(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the chosen runs of a text."""
    return _seeds(word_hashes(tokens))


def _seeds(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if len(w) < K:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    w = mix64(w + np.uint64(0x9E3779B97F4A7C15))
    n = len(w) - K + 1
    h = w[:n] * _FACTORS[0]
    for j in range(1, K):
        h += w[j:n + j] * _FACTORS[j]
    h = mix64(h)
    at = np.arange(n)
    if (h[1:] != h[:-1]).all():
        return at, h
    new = np.concatenate([[True], h[1:] != h[:-1]])
    at = at[(at - np.maximum.accumulate(np.where(new, at, 0))) % SAME == 0]
    return at, h[at]


def _once(docs: DataFrame) -> DataFrame:
    """key, text: rows equal in id and text once. Only rows whose key stands
    twice, found on keys alone, are shuffled with their texts."""
    keyed = docs.select(row_key().alias("key"), "text")
    twice = scratch(keyed.groupBy("key").count().where("count > 1").select("key"), "sub-twice")
    if twice.isEmpty():
        return keyed
    may = bloom_filter(twice, "key")
    return keyed.where(~may("key")).unionByName(keyed.where(may("key")).dropDuplicates(["key"]))


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers below 2^32: all first bytes, all second ones and so on. Few
    are written plain behind their width, no byte that packed ones begin with."""
    if len(values) == 0:
        return b""
    if len(values) <= PLAIN:
        most = int(values.max())
        width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
        return b"%c%b" % (width, values.astype(f"<u{width}").tobytes())
    return pa.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def _unpack(data: bytes, n: int) -> np.ndarray:
    if n == 0:
        return np.zeros(0, np.int64)
    if data[0] <= 4:
        return np.frombuffer(data, f"<u{data[0]}", n, 1).astype(np.int64)
    flat = np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def _pack_places(doc: np.ndarray, pos: np.ndarray) -> tuple[bytes, bytes]:
    """Places in reading order, as steps."""
    step = np.diff(doc, prepend=0)
    return _pack(step), _pack(np.where(step == 0, np.diff(pos, prepend=0), pos))


def _unpack_places(doc: bytes, pos: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    step, p = _unpack(doc, n), _unpack(pos, n)
    sums = np.cumsum(p)
    new = step != 0
    # a document's first position is given whole
    base = np.maximum.accumulate(np.where(new, np.arange(n), 0)) if n else np.zeros(0, np.int64)
    return np.cumsum(step), sums - (sums[base] - p[base])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 6)
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], list(_COLUMNS))


def _batches(rows, size: int = 1 << 18):
    """Rows together, up to about ``size`` bytes."""
    part, total = [], 0
    for r in rows:
        part.append(r)
        total += sum(map(len, r[6:]))
        if total >= size:
            yield _rows(part)
            part, total = [], 0
    if part:
        yield _rows(part)


def _order(values: np.ndarray, bits: int) -> np.ndarray:
    """The stable order of whole numbers below 2^``bits``. Each is sorted as one
    number with its place, far quicker than places by values; of long ones the
    last bits are left out, and all is sorted again if that puts different ones
    in one."""
    place = np.uint64(len(values).bit_length())
    cut = np.uint64(max(bits + int(place) - 64, 0))
    keys = ((values >> cut) << place) | np.arange(len(values), dtype=np.uint64)
    keys.sort()
    order = (keys & ((np.uint64(1) << place) - np.uint64(1))).astype(np.int32 if place < 32 else np.int64)
    if cut:
        keys >>= place
        found = values[order]
        if ((found[1:] != found[:-1]) & (keys[1:] == keys[:-1])).any():
            return np.argsort(values, kind="stable")
    return order


def _equal(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(the stable order by value, whether a value is new there, the first and
    the last place of each value)."""
    order = _order(h, bits)
    found = h[order]
    new = np.concatenate([[True], found[1:] != found[:-1]])
    starts = np.flatnonzero(new)
    return order, new, order[starts], order[np.append(starts[1:], len(h)) - 1]


def _block_rows(block: int, base: int, found: list[tuple[np.ndarray, np.ndarray]], ranges: int):
    """A block's rows of ``_asked``."""
    doc = np.repeat(np.arange(len(found), dtype=np.int32), [len(at) for at, _ in found])
    pos, h = (np.concatenate([f[i] for f in found], dtype=t) for i, t in ((0, np.int32), (1, np.uint64)))
    group, new, first, last = _equal(h, 64)
    number = np.empty(len(h), group.dtype)
    number[group] = np.cumsum(new, dtype=group.dtype) - 1
    seeds, place = h[first], len(h).bit_length()
    del h
    bits = np.uint64(ranges.bit_length() - 1)
    of = (seeds >> (np.uint64(64) - bits)).astype(np.int64)
    cuts = np.arange(ranges + 1) << place
    # seeds by range and first place
    first = np.sort((of << place) | first)
    starts = np.searchsorted(first, cuts).tolist()
    first &= (1 << place) - 1
    order = number[first]
    entry = np.empty(len(seeds), np.int32)
    entry[order] = np.arange(len(seeds)) - np.repeat(starts[:-1], np.diff(starts))
    tail = np.ascontiguousarray(((seeds[order] << bits) >> np.uint64(64 - 8 * TAIL)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TAIL])
    d, p, last = doc[first], pos[first], last[order]
    more = np.flatnonzero(doc[last] != d)
    last = last[more]
    del seeds, order, first
    stops = np.searchsorted(more, starts).tolist()
    again = group[~new]
    again = np.sort((of[number[again]] << place) | again)
    cuts = np.searchsorted(again, cuts).tolist()
    again &= (1 << place) - 1
    del of, group, new
    for r, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
        if a == b:
            continue
        m = slice(stops[r], stops[r + 1])
        yield (block, base, 0, r, b - a, m.stop - m.start, *_pack_places(d[a:b], p[a:b]), tail[a:b].tobytes(),
               _pack(np.diff(more[m] - a, prepend=0)), _pack(doc[last[m]]), _pack(pos[last[m]]))
        m = again[cuts[r]:cuts[r + 1]]
        if len(m):
            yield block, base, 1, r, len(m), 0, *_pack_places(doc[m], pos[m]), _pack(entry[number[m]]), b"", b"", b""


def _hashed(texts: DataFrame) -> DataFrame:
    """k, key, words: the documents with seeds, numbered, a task's one after the
    other, and the hashes of their words."""
    def run(batches):
        k = TaskContext.get().partitionId() << 40
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                rows = [(key, text_hashes(text)) for key, text in zip(part.column("key").to_pylist(), part.column("text").to_pylist(), strict=True)]
                rows = [(key, w.tobytes()) for key, w in rows if len(w) >= K]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, k + len(rows))), *(pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.binary())))],
                                                 ["k", "key", "words"])
                k += len(rows)
    return scratch(texts.mapInArrow(run, "k long, key long, words binary"), "sub-words")


def _asked(hashes: DataFrame, ranges: int) -> DataFrame:
    """Blocks of about ``BLOCK_WORDS`` words of documents numbered on end, from
    ``base`` on. Part 0 names the block's distinct seeds of one range of hashes,
    each where it stands first and, if several documents have it, where it
    stands last; part 1 says where else they stand. However common a seed is, a
    block names it twice at most."""
    def run(batches):
        block, base, found, size = TaskContext.get().partitionId() << 32, 0, [], 0
        for batch in batches:
            for k, packed in zip(batch.column("k").to_pylist(), batch.column("words"), strict=True):
                if found and (size >= BLOCK_WORDS or k != base + len(found)):
                    yield from _batches(_block_rows(block, base, found, ranges))
                    block, found, size = block + 1, [], 0
                if not found:
                    base = k
                found.append(_seeds(np.frombuffer(packed.as_buffer(), np.uint32)))
                size += len(found[-1][0])
        if found:
            yield from _batches(_block_rows(block, base, found, ranges))
    return hashes.select("k", "words").mapInArrow(run, _SCHEMA)


def _answered(groups):
    """Tells every block which of its seeds of a range another document has, and
    where: in the anchor, the least document that has it, or, where the block's
    first is the anchor, in the greatest. Also where else in the block these stand."""
    for (r,), t in groups:
        asked, elsewhere = [], {}
        for part, *row in zip(*(t.column(c).to_pylist() for c in ("part", "block", "base", "n", "m", "a", "b", "c", "d", "e", "f")), strict=True):
            if part == 0:
                asked.append(row)
            else:
                elsewhere[row[0]] = row
        # blocks by their documents, a block's first places before its last: places
        # of one seed then follow each other by document, which is named once
        asked.sort(key=lambda row: row[1])
        seeds, docs, places, begins, size = [], [], [], [], 0
        for _, base, n, m, a, b, c, d, e, f in asked:
            doc, pos = _unpack_places(a, b, n)
            h = np.zeros((n, 8), np.uint8)
            h[:, :TAIL] = np.frombuffer(c, np.uint8).reshape(n, TAIL)
            seeds.append(h.view("<u8").ravel())
            docs.append(base + doc)
            places.append(pos.astype(np.int32))
            begins.append(size)
            size += n + m
            if m:
                seeds.append(seeds[-1][np.cumsum(_unpack(d, m))])
                docs.append(base + _unpack(e, m))
                places.append(_unpack(f, m).astype(np.int32))
        h, doc, pos = map(np.concatenate, (seeds, docs, places))
        del seeds, docs, places
        order, new, low, high = _equal(h, 8 * TAIL)
        shared = doc[low] != doc[high]
        group = np.cumsum(new, dtype=order.dtype) - 1
        stand = shared[group]
        group, at = group[stand], order[stand]
        target = np.full(size, -1, order.dtype)
        target[at] = np.where(doc[low[group]] != doc[at], low[group], high[group])
        del h, order, new, low, high, group, stand, at
        yield from _batches(_answers(r, asked, elsewhere, begins, doc, pos, target))


def _answers(r, asked, elsewhere, begins, doc, pos, target):
    """A range's rows of ``_answered``: of place i, of all that are named, the
    other document's is ``target[i]`` (-1: none)."""
    for (block, base, n, *_), begin in zip(asked, begins, strict=True):
        entry = np.flatnonzero(target[begin:begin + n] >= 0)
        if len(entry) == 0:
            continue
        at = begin + entry
        to = target[at]
        others, which = np.unique(doc[to], return_inverse=True)
        yield (block, base, 0, r, len(at), len(others), *_pack_places(doc[at] - base, pos[at]),
               _pack(np.diff(entry, prepend=0)), _pack(which), others.astype("<i8").tobytes(), _pack(pos[to]))
        if block in elsewhere:
            _, _, m, _, a, b, c, *_ = elsewhere[block]
            asks = _unpack(c, m)
            keep = target[begin + asks] >= 0
            if keep.any():
                yield block, base, 1, r, int(keep.sum()), 0, *_pack_places(*(x[keep] for x in _unpack_places(a, b, m))), _pack(asks[keep]), b"", b"", b""


def _runs(groups):
    """Of each block the runs (k, anchor, pos, apos, n) of its matches: ``n``
    seeds from ``pos`` on are those from ``apos`` on of the anchor."""
    for _, t in groups:
        hits, parts = {}, []
        for part, r, base, n, _, a, b, c, d, e, f in zip(*(t.column(x).to_pylist() for x in ("part", "range", "base", "n", "m", "a", "b", "c", "d", "e", "f")), strict=True):
            doc, pos = _unpack_places(a, b, n)
            if part == 0:
                other = np.frombuffer(e, "<i8")[_unpack(d, n)]
                hits[r] = np.cumsum(_unpack(c, n)), base + doc, pos, other, _unpack(f, n)
                parts.append((base + doc, pos, other, hits[r][4]))
            else:
                entry, doc0, pos0, other, apos = hits[r]
                asks = _unpack(c, n)
                i, doc = np.searchsorted(entry, asks), base + doc
                # others than the anchor go with it, which may be the block's own
                own = (other[i] > doc0[i]) & (doc != doc0[i])
                parts.append((doc, pos, np.where(own, doc0[i], other[i]), np.where(own, pos0[i], apos[i])))
        if not parts:
            continue
        doc, pos, other, apos = (np.concatenate(x) for x in zip(*parts, strict=True))
        # a diagonal and the place on it in one key: positions are below 2^31
        order = np.lexsort((((pos - apos) << 32) + pos, other, doc))
        doc, pos, other, apos = doc[order], pos[order], other[order], apos[order]
        start = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(other) != 0) | (np.diff(pos) != 1) | (np.diff(apos) != 1)]))
        size = np.diff(np.append(start, len(doc)))
        yield doc[start], other[start], pos[start], apos[start], size


def _matched(groups):
    for runs in _runs(groups):
        yield from _chained(*runs)


def _ranges(chars: int) -> int:
    ranges = RANGES
    while ranges * (RANGE_SEEDS if ranges < MANY_RANGES else MOST_SEEDS) * CHARS < chars:
        ranges *= 2
    return ranges


def _chains(docs: DataFrame, step=_matched, schema: str = CHAINS) -> tuple[DataFrame, DataFrame]:
    """(chains between numbered documents, the numbers with keys and words)."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = _ranges(chars)
    hashes = _hashed(_once(docs))
    answers = scratch(by_group(_asked(hashes, ranges), ["range"], _answered, _SCHEMA), "sub-answers")
    free_shuffles(docs.sparkSession)
    chains = by_group(answers, ["block"], step, schema, order=["part"])
    chains = scratch(chains.withColumn("cid", F.monotonically_increasing_id()), "sub-chains")
    discard(answers)
    free_shuffles(docs.sparkSession)
    return chains, hashes


def chains_of(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Index arrays of the chains among matches sorted by (x, y)."""
    n = len(x)
    if n == 1 or (np.diff(x) > 0).all() and (np.diff(y) > 0).all() and (np.diff(x) <= MAX_GAP).all() and (np.diff(y) <= MAX_GAP).all():
        return [np.arange(n)]
    rank = np.unique(y, return_inverse=True)[1] + 1
    top = int(rank.max())
    tree: list[tuple[float, int]] = [(-1.0, -1)] * (top + 1)
    score, back = [0.0] * n, [-1] * n
    xs, ys, rs = x.tolist(), y.tolist(), rank.tolist()
    i = 0
    while i < n:
        j = i
        while j < n and xs[j] == xs[i]:
            best, r = (-1.0, -1), rs[j] - 1
            while r > 0:
                if tree[r] > best:
                    best = tree[r]
                r -= r & -r
            gain = best[0] - GAP_COST * (xs[j] + ys[j])
            score[j], back[j] = (K + gain, best[1]) if best[1] >= 0 and gain > 0 else (float(K), -1)
            j += 1
        for m in range(i, j):
            item, r = (score[m] + GAP_COST * (xs[m] + ys[m]), m), rs[m]
            while r <= top:
                if item > tree[r]:
                    tree[r] = item
                r += r & -r
        i = j
    used, out = [False] * n, []
    for end in sorted(range(n), key=lambda m: -score[m]):
        path = []
        while end >= 0 and not used[end]:
            used[end] = True
            path.append(end)
            end = back[end]
        if path:
            p = np.array(path[::-1])
            cut = np.flatnonzero((np.diff(x[p]) > MAX_GAP) | (np.diff(y[p]) > MAX_GAP)) + 1
            out += np.split(p, cut)
    return out


def _corners(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of a chain the first and last match of every stretch of one diagonal:
    alignment compares the words between them one by one."""
    turn = np.diff(x - y) != 0
    return np.concatenate([[True], turn]) | np.concatenate([turn, [True]])


def _regions(x: np.ndarray, y: np.ndarray) -> list[list[np.ndarray]]:
    """The chains of two documents' matches, corners only, by the regions they
    begin in."""
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    regions = defaultdict(list)
    for p in chains_of(x, y):
        p = p[_corners(x[p], y[p])]
        regions[int(x[p[0]]) // REGION, int(y[p[0]]) // REGION].append((x[p], y[p]))
    return list(regions.values())


def _chained(k: np.ndarray, anchor: np.ndarray, pos: np.ndarray, apos: np.ndarray, n: np.ndarray):
    """Rows of chains from runs of matches sorted by (k, anchor): all of a
    document's runs are its block's."""
    start = np.flatnonzero(np.concatenate([[True], (np.diff(k) != 0) | (np.diff(anchor) != 0)]))
    end = np.append(start[1:], len(k))
    lists = pa.list_(pa.list_(pa.int32()))

    def batch(rows):
        xs, ys = ([[c[i].tolist() for c in r] for _, r in rows] for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(k[[i for i, _ in rows]]), pa.array(anchor[[i for i, _ in rows]]), pa.array(xs, lists), pa.array(ys, lists),
                                           *(pa.array(side, pa.int64()) for z in (xs, ys) for side in ([min(c[0] for c in r) for r in z], [max(c[-1] for c in r) + K for r in z]))],
                                          ["k", "anchor", "xs", "ys", "lo0", "hi0", "lo1", "hi1"])
    alone = start[end - start == 1]
    for i in range(0, len(alone), 1 << 13):
        at = alone[i:i + (1 << 13)]
        # a run has one corner or two
        two = (n[at] > 1).astype(np.int64)
        offsets = pa.array(np.concatenate([[0], np.cumsum(1 + two)]).astype(np.int32))
        outer = pa.array(np.arange(len(at) + 1, dtype=np.int32))
        first = np.cumsum(1 + two) - 1 - two
        columns = [pa.array(k[at]), pa.array(anchor[at])]
        for z in (pos, apos):
            corners = np.repeat(z[at], 1 + two)
            corners[first + two] += n[at] - 1
            columns.append(pa.ListArray.from_arrays(outer, pa.ListArray.from_arrays(offsets, pa.array(corners.astype(np.int32)))))
        columns += [pa.array(c) for z in (pos, apos) for c in (z[at], z[at] + n[at] - 1 + K)]
        yield pa.RecordBatch.from_arrays(columns, ["k", "anchor", "xs", "ys", "lo0", "hi0", "lo1", "hi1"])
    rows = []
    for a, b in zip(start.tolist(), end.tolist(), strict=True):
        if b - a > 1:
            step = np.arange(n[a:b].sum()) - np.repeat(np.cumsum(n[a:b]) - n[a:b], n[a:b])
            rows += [(a, r) for r in _regions(*(np.repeat(z[a:b], n[a:b]) + step for z in (pos, apos)))]
            if len(rows) >= 4096:
                yield batch(rows)
                rows = []
    if rows:
        yield batch(rows)


def _edits_matched(a: list, b: list) -> int:
    """Equal words in a cheapest edit script of two short word runs."""
    if not a or not b:
        return 0
    row = [(j, 0) for j in range(len(b) + 1)]
    for i, w in enumerate(a, 1):
        new = [(i, 0)]
        for j, v in enumerate(b, 1):
            d = row[j - 1]
            d = (d[0], d[1] - 1) if w == v else (d[0] + 1, d[1])
            new.append(min(d, (row[j][0] + 1, row[j][1]), (new[-1][0] + 1, new[-1][1])))
        row = new
    return -row[-1][1]


def _extend(a: list, b: list) -> tuple[int, int, int, int, int]:
    """(words of a, words of b, matches) an alignment reaches from the start of
    both, over differences of up to ``SKIP`` words that ``RESUME`` equal words
    follow; and how far in a and b it looked for them."""
    i = j = matched = 0
    end = (0, 0, 0)
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            i, j, matched = i + 1, j + 1, matched + 1
            end = (i, j, matched)
            continue
        if {tuple(a[m:m + RESUME]) for m in range(i, i + SKIP + 1)}.isdisjoint(tuple(b[m:m + RESUME]) for m in range(j, j + SKIP + 1)):
            break
        for total in range(1, 2 * SKIP + 1):
            hit = next(((d, total - d) for d in sorted(range(max(0, total - SKIP), min(SKIP, total) + 1), key=lambda d: abs(total - 2 * d))
                        if (w := a[i + d:i + d + RESUME]) == b[j + total - d:j + total - d + RESUME] and len(w) == RESUME), None)
            if hit:
                i, j = i + hit[0], j + hit[1]
                break
        else:
            break
    return *end, i + SKIP + RESUME, j + SKIP + RESUME


def align(a: np.ndarray, b: np.ndarray, xs: np.ndarray, ys: np.ndarray) -> tuple[int, ...]:
    """(start, end, start, end, matches) of the alignment through the seeds
    (start positions xs in a, ys in b), and the first and last word looked at in
    a and in b, which may lie outside."""
    x, y = int(xs[0]), int(ys[0])
    li, lj, matched, back, aback = _extend(a[:x][::-1].tolist(), b[:y][::-1].tolist())
    start, astart, low, alow = x - li, y - lj, x - back, y - aback
    for nx, ny in zip(xs[1:].tolist(), ys[1:].tolist(), strict=True):
        if nx - x == ny - y:
            matched += int((a[x:nx] == b[y:ny]).sum())
        else:
            p, q = min(x + K, nx), min(y + K, ny)
            both = min(p - x, q - y)
            matched += both + _edits_matched(a[x + both:nx].tolist(), b[y + both:ny].tolist())
        x, y = nx, ny
    ri, rj, more, on, aon = _extend(a[x:].tolist(), b[y:].tolist())
    return start, x + ri, astart, y + rj, matched + more, low, x + on, alow, y + aon


def _words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all words of a column of packed words, where each row's start, how many)."""
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) // 4
    flat = np.frombuffer(data, np.uint32, o[-1]) if data is not None else np.zeros(0, np.uint32)
    return flat, o[:-1], np.diff(o)


def _unextended(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Of a batch of ``_aligner`` the rows with one chain that is one run of equal
    words, next to which no alignment could go on: the words beside it differ, and
    no ``RESUME`` words stand within ``SKIP`` in both texts. Also (start, end,
    start, end) of all rows' first chains."""
    bounds, words_at, outside = [], [], []
    for z, f, w in (("xs", "f0", "w0"), ("ys", "f1", "w1")):
        chains = batch.column(z)
        outer = chains.offsets.to_numpy()
        inner = chains.values.offsets.to_numpy()[outer[0]:]
        one, corners = np.diff(outer) == 1, chains.values.values.to_numpy()
        outer = outer[:-1] - outer[0]
        bounds += [corners[inner[outer]].astype(np.int64), corners[inner[outer + 1] - 1].astype(np.int64) + K]
        flat, at, size = _words_of(batch.column(w))
        start, end = (x - batch.column(f).to_numpy() for x in bounds[-2:])
        # a place outside of the texts is equal to none of the other text
        for places in (start[:, None] - 1 - np.arange(SKIP + RESUME), end[:, None] + np.arange(SKIP + RESUME)):
            there = (places >= 0) & (places < size[:, None])
            outside.append(np.where(there, flat[np.where(there, at[:, None] + places, 0)].astype(np.int64), -1 - len(words_at)))
        words_at.append((flat, at + start))
    x0, x1, y0, y1 = bounds
    plain = one & (x1 - x0 == y1 - y0)
    for a, b in ((outside[0], outside[2]), (outside[1], outside[3])):
        ga, gb = (mix64(mix64(g[:, :-2].astype(np.uint64)) + g[:, 1:-1].astype(np.uint64)) + g[:, 2:].astype(np.uint64) for g in (a, b))
        plain &= (a[:, 0] != b[:, 0]) & ~(ga[:, :, None] == gb[:, None, :]).any((1, 2))
    rows = np.flatnonzero(plain)
    if len(rows):
        n = (x1 - x0)[rows]
        starts = np.cumsum(n) - n
        step = np.arange(n.sum()) - np.repeat(starts, n)
        (a, i), (b, j) = words_at
        equal = a[np.repeat(i[rows], n) + step] == b[np.repeat(j[rows], n) + step]
        rows = rows[np.logical_and.reduceat(equal, starts)]
    return rows, np.array(bounds)


def _aligner(margin: int):
    """Aligns chains on words up to ``margin`` beyond them. A row whose
    alignments looked farther, where the texts go on, comes back by its ``cid``
    alone, unless ``margin`` is the last. Lone runs that no alignment goes beyond
    are told apart first, all of a batch together."""
    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            done, (x0, x1, y0, y1) = _unextended(batch)
            if len(done):
                k, anchor = (batch.column(c).to_numpy()[done] for c in ("k", "anchor"))
                yield pa.RecordBatch.from_arrays([pa.nulls(2 * len(done), pa.int64()), *(pa.array(np.concatenate(c)) for c in (
                    (k, anchor), (anchor, k), (x0[done], y0[done]), (x1[done], y1[done])))], ["cid", "k", "other", "start", "end"])
                batch = batch.take(pa.array(np.setdiff1d(np.arange(batch.num_rows), done)))
            rows = []
            for cid, k, anchor, chains, others, f0, w0, f1, w1 in zip(*(batch.column(c).to_pylist() for c in ("cid", "k", "anchor", "xs", "ys", "f0", "w0", "f1", "w1")), strict=True):
                found, wide = [], False
                for xs, ys in zip(chains, others, strict=True):
                    f, g = max(xs[0] - margin, 0), max(ys[0] - margin, 0)
                    a, b = np.frombuffer(w0, np.uint32)[f - f0:xs[-1] + K + margin - f0], np.frombuffer(w1, np.uint32)[g - f1:ys[-1] + K + margin - f1]
                    s, e, u, v, matched, low, high, alow, ahigh = align(a, b, np.array(xs) - f, np.array(ys) - g)
                    if margin < MARGIN and (low < 0 < f or alow < 0 < g or high > len(a) == xs[-1] + K + margin - f or ahigh > len(b) == ys[-1] + K + margin - g):
                        wide = True
                        break
                    if matched >= IDENTITY * max(e - s, v - u):
                        found += [(None, k, anchor, f + s, f + e), (None, anchor, k, g + u, g + v)]
                rows += [(cid, None, None, None, None)] if wide else found
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(5)], ["cid", "k", "other", "start", "end"])
    return run


def _slices(batches):
    """The words asked of each document."""
    def rows(parts):
        cid, side, lo, n, flat = (np.concatenate(c) for c in zip(*parts, strict=True))
        offsets = np.concatenate([[0], np.cumsum(4 * n)]).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(cid), pa.array(side), pa.array(lo), pa.Array.from_buffers(
            pa.binary(), len(n), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())])], ["cid", "side", "lo", "w"])
    parts, size = [], 0
    for batch in batches:
        for packed, asked in zip(batch.column("words"), batch.column("asked"), strict=True):
            h = np.frombuffer(packed.as_buffer(), np.uint32)
            cid, side, lo, hi = (asked.values.field(c).to_numpy() for c in ("cid", "side", "lo", "hi"))
            n = np.minimum(hi, len(h)) - lo
            ends = np.cumsum(n)
            parts.append((cid, side, lo, n, h[np.arange(ends[-1]) + np.repeat(lo - ends + n, n)]))
            size += int(ends[-1])
            if size >= SLICE_WORDS:
                yield rows(parts)
                parts, size = [], 0
    if parts:
        yield rows(parts)


def _merged(groups):
    """Joins a document's overlapping or neighbouring spans to passages."""
    for (k,), t in groups:
        s, e, o = (t.column(c).to_numpy() for c in ("start", "end", "other"))
        order = np.lexsort((e, s))
        s, e, o = s[order], e[order], o[order]
        reach = np.maximum.accumulate(e)
        first = np.concatenate([[0], np.flatnonzero(s[1:] > reach[:-1] + NEAR) + 1])
        last = np.concatenate([first[1:], [len(s)]]) - 1
        ok = reach[last] - s[first] >= MIN_WORDS
        if ok.any():
            size = np.maximum.reduceat(e - s, first)
            # the partner of the longest span
            pick = [int(o[a:b + 1][(e - s)[a:b + 1] == m].min()) for a, b, m in zip(first, last, size, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([k] * int(ok.sum()), pa.int64()), pa.array(s[first][ok]), pa.array(reach[last][ok]), pa.array(np.array(pick)[ok])], ["k", "start", "end", "other"])


def _alignments(chains: DataFrame, hashes: DataFrame, margin: int) -> DataFrame:
    """cid, k, other, start, end as of ``_aligner``, the words read by document."""
    asked = chains.select("cid", F.explode(F.array(*[
        F.struct(F.lit(i).alias("side"), F.col(c).alias("k"), F.greatest(F.col(f"lo{i}") - margin, F.lit(0)).alias("lo"), (F.col(f"hi{i}") + margin).alias("hi"))
        for i, c in enumerate(("k", "anchor"))])).alias("r")).select("cid", "r.*")
    count = scratch(asked.groupBy("k").agg(F.expr(f"(count(1) + {REQUESTS - 1}) div {REQUESTS}").alias("n"))
                    .withColumn("h", F.xxhash64("k")), "sub-count")
    wanted = bloom_filter(count, "h")
    lists = scratch(asked.join(count.drop("h"), "k").groupBy("k", F.pmod(F.xxhash64("cid"), F.col("n")).alias("part"))
                    .agg(F.collect_list(F.struct("cid", "side", "lo", "hi")).alias("asked")), "sub-asked-words")
    read = hashes.select("k", "words", F.xxhash64("k").alias("h")).where(wanted("h")).drop("h")
    spans = scratch(lists.join(read, "k").select("words", "asked").mapInArrow(_slices, "cid long, side int, lo long, w binary"), "sub-spans")
    one = [spans.where(F.col("side") == s).select("cid", F.col("lo").alias(f"f{s}"), F.col("w").alias(f"w{s}")) for s in (0, 1)]
    found = scratch(chains.join(one[0], "cid").join(one[1], "cid").select("cid", "k", "anchor", "xs", "ys", "f0", "w0", "f1", "w1")
                    .mapInArrow(_aligner(margin), "cid long, k long, other long, start long, end long"), "sub-aligned")
    discard(count, lists, spans)
    free_shuffles(chains.sparkSession)
    return found


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, start_word, end_word, n_words, other_id: passages that also stand
    in another document; other_id is one that shares it."""
    chains, hashes = _chains(docs)
    near = _alignments(chains, hashes, NARROW)
    far = _alignments(chains.join(near.where("cid is not null").select("cid"), "cid", "left_semi"), hashes, MARGIN)
    # equal spans of a document meet in a map-side combined aggregate
    found = near.unionByName(far).where("k is not null").groupBy("k", "start", "end").agg(F.min("other").alias("other"))
    passages = scratch(by_group(found, ["k"], _merged, "k long, start long, end long, other long"), "sub-passages")
    ends = passages.select("k").union(passages.select("other")).distinct().join(hashes.select("k", "key"), "k")
    wanted = bloom_filter(ends, "key")
    ids = docs.select(row_key().alias("key"), "doc_id").where(wanted("key")).distinct()
    names = scratch(ends.join(ids, "key").select("k", "doc_id"), "sub-names")
    discard(hashes)
    other = names.select(F.col("k").alias("other"), F.col("doc_id").alias("other_id"))
    return (passages.join(names, "k").join(other, "other")
            .select("doc_id", F.col("start").alias("start_word"), F.col("end").alias("end_word"), (F.col("end") - F.col("start")).alias("n_words"), "other_id"))
