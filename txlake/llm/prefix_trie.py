"""Conversation prefix trie, rolled up by centroid decomposition.

Every distinct run of a conversation's first d turns is a node of depth d; its
parent is the run without the last turn. A node is named by the smallest
conversation beginning with it, and its depth.

1. Turns are numbered, and prefixes hashed (128 bits: the turns' hashes, each
   with its position, joined by exclusive or), in slices of a range sort with a
   carry per slice, so that a conversation of any length is spread over tasks.
2. Sums over subtrees come from a centroid decomposition of the forest of
   parent edges. A node's weight is the number of turns at and below it, over
   all its conversations, which one aggregate gives. In every component the
   deepest node with half of the component's weight is the centroid: the total
   of what lies at and below it in the component is its sum, and is added to
   the nodes from the centroid to the component's top. The centroid goes; its
   children's parts and the part above it, each of at most half the weight, are
   split alike. So rounds grow with the logarithm of the turns, whatever the
   depth. Components of at most ``LOCAL`` nodes are summed inside one task.

Cases: rows without conv_id take no part; a null role or text is empty; turns
are ordered null first, equal ones by the role's, then the text's first 64
characters, then the SHA-256 of both; repeated rows are turns of their own;
texts count whole at any length; an empty table gives no node, not even a root;
extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.llm.common import discard, scratch

#: Components of at most so many nodes are summed inside one task.
LOCAL = 512
#: Conversations borrow the first turns of the first one of their hundred.
GROUP = 100
MOST_BORROWED = 5

_COMP = ["top", "top_depth"]
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _sliced(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """``df`` range-sorted by (key, order) and written; ``__at`` ascends in that
    order, ``__slice`` is the row's partition."""
    return scratch(df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
                   .withColumn("__at", F.monotonically_increasing_id())
                   .withColumn("__slice", F.shiftright("__at", 33)), name)


def _earlier(key: str):
    """The key's slices before a slice."""
    return Window.partitionBy(key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, i (from 1), role, text."""
    rows = (conversations.where("conv_id is not null")
            .select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            .withColumns({"__role": F.left("role", F.lit(64)), "__text": F.left("text", F.lit(64)),
                          "__sha": F.sha2(F.concat_ws("\0", "role", "text").cast("binary"), 256),
                          # equal rows are alike: any order will do, but they need not share a task
                          "__tie": F.monotonically_increasing_id()}))
    t = _sliced(rows, "conv_id", ["turn", "__role", "__text", "__sha", "__tie"], "trie-turns")
    slices = (t.groupBy("conv_id", "__slice").agg(F.min("__at").alias("first"), F.count(F.lit(1)).alias("n"))
              .withColumn("carry", F.coalesce(F.sum("n").over(_earlier("conv_id")), F.lit(0))))
    return (t.join(slices, ["conv_id", "__slice"])
            .select("conv_id", (F.col("__at") - F.col("first") + F.col("carry") + 1).alias("i"), "role", "text"))


def borrowed(conv_id: str = "conv_id") -> Column:
    """How many turns a conversation borrows: unsigned crc32 of its decimal id, mod 6."""
    return F.crc32(F.col(conv_id).cast("string").cast("binary")) % (MOST_BORROWED + 1)


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns: conv_id, pos, role, text, len; conversations: conv_id, len):
    each conversation begins with the first turns of the first one of its
    hundred, in place of its own."""
    turns = scratch(numbered_turns(conversations), "trie-numbered")
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    heads = turns.where((F.col("conv_id") % GROUP == 0) & (F.col("i") <= MOST_BORROWED)).withColumnRenamed("conv_id", "base")
    known = heads.groupBy("base").agg(F.count(F.lit(1)).alias("base_n"))
    convs = (turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("h", borrowed()).withColumn("base", base)
             .join(known, "base", "left").withColumn("lent", F.least("h", F.coalesce("base_n", F.lit(0).cast("long"))))
             .withColumn("len", F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    convs = scratch(convs.select("conv_id", "h", "base", "lent", "len"), "trie-conversations")
    first = convs.join(heads, "base").where("i <= lent").select("conv_id", F.col("i").alias("pos"), "role", "text", "len")
    rest = (turns.join(convs, "conv_id").where("i > h")
            .select("conv_id", (F.col("i") - F.col("h") + F.col("lent")).alias("pos"), "role", "text", "len"))
    return first.unionByName(rest), convs.select("conv_id", "len")


def _prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, pos, len, chars, k1, k2 (hash of the first pos turns), p1, p2
    (of those before the last)."""
    t = _sliced(turns.select("conv_id", "pos", "len", F.length("text").cast("long").alias("chars"),
                             *[F.xxhash64(F.lit(s), "pos", "role", "text").alias(f"t{s}") for s in (1, 2)]),
                "conv_id", ["pos"], "trie-rebuilt")
    carry = (t.groupBy("conv_id", "__slice").agg(F.bit_xor("t1").alias("s1"), F.bit_xor("t2").alias("s2"))
             .select("conv_id", "__slice", *[F.coalesce(F.bit_xor(f"s{s}").over(_earlier("conv_id")), F.lit(0).cast("long")).alias(f"c{s}") for s in (1, 2)]))
    upto = Window.partitionBy("conv_id", "__slice").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    k = {f"k{s}": F.bit_xor(f"t{s}").over(upto) for s in (1, 2)}
    out = t.withColumns(k).join(carry, ["conv_id", "__slice"])
    for s in (1, 2):
        out = out.withColumn(f"k{s}", F.col(f"k{s}").bitwiseXOR(F.col(f"c{s}"))).withColumn(f"p{s}", F.col(f"k{s}").bitwiseXOR(F.col(f"t{s}")))
    out = scratch(out.select("conv_id", "pos", "len", "chars", "k1", "k2", "p1", "p2"), "trie-prefixes")
    discard(t)
    return out


def _nodes(prefixes: DataFrame, root: int) -> DataFrame:
    """conv, depth, up (the parent's conv), n_convs, weight, chars, k1, k2."""
    groups = scratch(prefixes.groupBy("pos", "k1", "k2").agg(
        F.min("conv_id").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("len") - F.col("pos") + 1).alias("weight"),
        F.min("chars").alias("chars"), F.min("p1").alias("p1"), F.min("p2").alias("p2")), "trie-groups")
    above = groups.select((F.col("pos") + 1).alias("pos"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("up"))
    deep = groups.where("pos > 1").join(above, ["pos", "p1", "p2"])
    top = groups.where("pos = 1").withColumn("up", F.lit(root).cast("long"))
    out = scratch(top.unionByName(deep).select("conv", F.col("pos").alias("depth"), "up", "n_convs", "weight", "chars", "k1", "k2"), "trie-nodes")
    discard(groups)
    return out


def _end_hashes(ends: DataFrame) -> DataFrame:
    """conv, depth, ends_sha256 of the conversations (conv_id) that end at a
    node, ascending. Each slice's ids are joined by a task of its own; one task
    then hashes a node's few joined strings in order, as a stream."""
    t = _sliced(ends, "conv", ["depth", "conv_id"], "trie-ends")
    parts = (t.groupBy("conv", "depth", "__slice")
             .agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")))

    def run(batches):
        key, digest = None, None
        for b in batches:
            done = []
            for conv, depth, ids in zip(*(b.column(c).to_pylist() for c in ("conv", "depth", "ids")), strict=True):
                if key == (conv, depth):
                    digest.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = (conv, depth), hashlib.sha256(ids.encode())
            if done:
                yield _hash_rows(done)
        if key is not None:
            yield _hash_rows([(*key, digest.hexdigest())])
    return (parts.repartition("conv", "depth").sortWithinPartitions("conv", "depth", "__slice")
            .select("conv", "depth", "ids").mapInArrow(run, "conv long, depth long, ends_sha256 string"))


def _hash_rows(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    conv, depth, sha = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(depth, pa.int64()), pa.array(sha, pa.string())], ["conv", "depth", "ends_sha256"])


def _whole_components(batches) -> Iterator[pa.Table]:
    """Record batches sorted by component, cut so that components stay whole."""
    rest: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
        if t.num_rows == 0:
            continue
        a, d = (t.column(c).to_numpy() for c in _COMP)
        cut = int(np.flatnonzero((a == a[-1]) & (d == d[-1]))[0])
        if cut:
            yield t.slice(0, cut)
        rest = t.slice(cut).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest


def _sum_small(batches):
    """Sums over the subtrees of whole small components, deepest nodes first."""
    for t in _whole_components(batches):
        conv, depth, up, top, top_depth, leaves, saved = (t.column(c).to_pylist() for c in ("conv", "depth", "up", *_COMP, "leaves", "saved"))
        at = {n: i for i, n in enumerate(zip(conv, depth, strict=True))}
        for i in np.argsort(-np.array(depth), kind="stable").tolist():
            if (conv[i], depth[i]) != (top[i], top_depth[i]):
                p = at[up[i], depth[i] - 1]
                leaves[p] += leaves[i]
                saved[p] += saved[i]
        add = [t.column(c).to_numpy() for c in ("more_leaves", "more_saved")]
        yield pa.RecordBatch.from_arrays([pa.array(conv, pa.int64()), pa.array(depth, pa.int64()), pa.array(np.array(leaves) + add[0]), pa.array(np.array(saved) + add[1])],
                                         ["conv", "depth", "n_leaves", "saved_tokens"])


def subtree_sums(nodes: DataFrame, paths: DataFrame, local: int = LOCAL) -> DataFrame:
    """conv, depth, n_leaves, saved_tokens: ``leaves`` and ``saved`` of nodes
    (conv, depth, up, weight, leaves, saved; one tree) summed over subtrees by
    centroid decomposition. ``paths`` (conv_id, pos, own, up) names the node
    ``own`` that conversation conv_id has at depth pos, from 1, and the one
    above."""
    zero = F.lit(0).cast("long")
    start = nodes.agg(F.min_by("conv", "depth").alias("c"), F.min("depth").alias("d")).first()
    active = scratch(nodes.select("conv", "depth", "up", "weight", "leaves", "saved", zero.alias("more_leaves"), zero.alias("more_saved"),
                                  F.lit(start["c"]).cast("long").alias("top"), F.lit(start["d"]).cast("long").alias("top_depth")), "trie-state")
    state = active.columns
    small, sums = [], []
    while True:
        sizes = active.groupBy(*_COMP).agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("total")).where(F.col("n") > local)
        centroid = scratch(active.join(sizes, _COMP).where(F.col("weight") * 2 >= F.col("total"))
                           .groupBy(*_COMP).agg(F.min(F.struct("weight", "conv", "depth")).alias("c"))
                           .select(*_COMP, F.col("c.conv").alias("c"), F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight")), "trie-centroids")
        if centroid.isEmpty():
            small.append(active)
            break
        above, below = F.col("depth") < F.col("c_depth"), F.col("depth") > F.col("c_depth")
        look = (F.when(above, F.col("c")).otherwise(F.col("conv")),
                F.when(above, F.col("depth")).when(below, F.col("c_depth") + 1).otherwise(zero))
        step = paths.select(F.col("conv_id").alias("at"), F.col("pos").alias("at_pos"), "own", F.col("up").alias("own_up"))
        moved = scratch(
            active.join(centroid, _COMP, "left").withColumns({"at": look[0], "at_pos": look[1]}).join(step, ["at", "at_pos"], "left")
            .withColumn("part", F.when(F.col("c").isNull(), "small").when((F.col("depth") == F.col("c_depth")) & (F.col("conv") == F.col("c")), "centroid")
                        .when(below & (F.col("own_up") == F.col("c")), "below")
                        .when(above & ((F.col("depth") == 0) | (F.col("own") == F.col("conv"))), "path").otherwise("rest"))
            .select(*state, "c", "c_depth", "c_weight", "own", "part"), "trie-moved")
        total = (moved.where("part in ('centroid', 'below')").groupBy(*_COMP)
                 .agg(F.sum("leaves").alias("sum_leaves"), F.sum("saved").alias("sum_saved")))
        hit = F.col("part") == "path"
        # the part of a centroid's child is named by the child
        under = F.col("part") == "below"
        done = moved.where("part = 'centroid'").join(total, _COMP)
        sums.append(scratch(done.select("conv", "depth", (F.col("sum_leaves") + F.col("more_leaves")).alias("n_leaves"), (F.col("sum_saved") + F.col("more_saved")).alias("saved_tokens")), "trie-sums"))
        small.append(scratch(moved.where("part = 'small'").select(state), "trie-small"))
        on = moved.where("part in ('path', 'below', 'rest')").join(total, _COMP)
        following = scratch(on.select(
            "conv", "depth", "up", F.when(hit, F.col("weight") - F.col("c_weight")).otherwise(F.col("weight")).alias("weight"), "leaves", "saved",
            F.when(hit, F.col("more_leaves") + F.col("sum_leaves")).otherwise(F.col("more_leaves")).alias("more_leaves"),
            F.when(hit, F.col("more_saved") + F.col("sum_saved")).otherwise(F.col("more_saved")).alias("more_saved"),
            F.when(under, F.col("own")).otherwise(F.col("top")).alias("top"),
            F.when(under, F.col("c_depth") + 1).otherwise(F.col("top_depth")).alias("top_depth")), "trie-state")
        discard(active, moved, centroid)
        active = following
    out = None
    for t in small:
        out = t if out is None else out.unionByName(t)
    out = (out.repartition(*_COMP).sortWithinPartitions(*_COMP)
           .mapInArrow(_sum_small, "conv long, depth long, n_leaves long, saved_tokens long"))
    for t in sums:
        out = out.unionByName(t)
    return out


def prefix_trie(conversations: DataFrame, local: int = LOCAL, texts: bool = True) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256 and, with ``texts``, the role and text
    of its last turn (the root's: null)."""
    turns, convs = rebuilt_turns(conversations)
    if texts:
        turns = scratch(turns, "trie-texts")
    root = convs.agg(F.min("conv_id").alias("conv"), F.count(F.lit(1)).alias("n"), F.sum(F.col("len") + 1).alias("weight")).first()
    prefixes = _prefixes(turns)
    nodes = _nodes(prefixes, root["conv"])
    paths = scratch(prefixes.join(nodes.select(F.col("depth").alias("pos"), "k1", "k2", F.col("conv").alias("own"), "up"), ["pos", "k1", "k2"])
                    .select("conv_id", "pos", "own", "up", "len"), "trie-paths")
    discard(prefixes)
    # the conversations that end at a node; those without a turn at the root
    ends = (paths.where("pos = len").select(F.col("own").alias("conv"), F.col("pos").alias("depth"), "conv_id")
            .unionByName(convs.where("len = 0").select(F.lit(root["conv"]).cast("long").alias("conv"), F.lit(0).cast("long").alias("depth"), "conv_id")))
    shas = scratch(_end_hashes(ends), "trie-hashes")
    rows = nodes.select("conv", "depth", "up", "n_convs", "weight", "chars")
    if root["conv"] is not None:
        rows = rows.unionByName(convs.sparkSession.range(1).select(
            F.lit(root["conv"]).cast("long").alias("conv"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("up"),
            F.lit(root["n"]).cast("long").alias("n_convs"), F.lit(root["weight"]).cast("long").alias("weight"), F.lit(0).cast("long").alias("chars")))
    children = nodes.groupBy(F.col("up").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    rows = scratch(rows.join(children, ["conv", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
                   .withColumn("leaves", (F.col("n_children") == 0).cast("long"))
                   .withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")), "trie-rows")
    # only conversations that name a node are ever looked up
    owners = nodes.select(F.col("conv").alias("conv_id")).distinct()
    sums = subtree_sums(rows, scratch(paths.drop("len").join(owners, "conv_id", "left_semi"), "trie-owners"), local) if root["conv"] is not None else None
    if sums is None:
        sums = rows.select("conv", "depth", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    out = (rows.join(sums, ["conv", "depth"]).join(shas, ["conv", "depth"], "left")
           .select(F.col("conv").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
                   F.coalesce("ends_sha256", F.lit(_EMPTY_SHA)).alias("ends_sha256")))
    if texts:
        last = turns.select("conv_id", F.col("pos").alias("depth"), "role", "text")
        out = out.join(last, ["conv_id", "depth"], "left")
    return out
