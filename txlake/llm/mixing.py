"""Mixing sources to target weights, DataFrame functions only.

The words of a source, in document order, are packed into blocks of equal
length (``BLOCK_WORDS``, fewer in a source of under ``BLOCK_WORDS`` blocks, so
that whole blocks come near any target). A source's target decides how many
slots of the mix it fills. Each slot falls into one of ``SHARDS`` output shards,
and only the counts are kept: one multinomial draw per source. A shard's slots
of a source are then numbered through, shard after shard. Slot number i is pass
``i div blocks`` over the source's blocks; within a pass the number goes through
a pseudorandom permutation of the block indices (swap-or-not rounds, a
bijection on any domain), so no block repeats before all were used, and none is
taken more than twice. Blocks then join the slots by index: which shard a block
stands in is decided by the counts.

Cases: null or wordless text has size 0 and is never taken; the null source is
a source and comes last; documents of the same id and source stand in order of
size and text hash, equal rows in any; very long texts reach over many blocks;
an empty table gives an empty result; extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.llm.common import scratch

BLOCK_WORDS = 64
SHARE = 1.5
MOST = 2.0
WEIGHTS = (3, 1, 2)
ROUNDS = 16
SHARDS = 1024
#: Slots one generating row expands to; keeps a large source's slots apart.
SLOT_RUN = 4096
_GAP = r"[\x20\x09-\x0D]+"


def n_words() -> Column:
    return F.coalesce(F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, sno, source_size, target: one row per source. The windows run
    over these rows alone. Sharing by weight under caps has a closed form: with
    sources ordered by cap / weight, every cut into "capped" and "by weight"
    gives a level; the largest of these levels is the one that adds up."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    every = Window.partitionBy(F.lit(0))
    s = (s.withColumn("sno", F.row_number().over(order) - 1)
         .withColumn("w", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("sno") % len(WEIGHTS) + 1).cast("int")).cast("double"))
         .withColumn("cap", F.col("source_size") * MOST)
         .withColumn("total", F.sum("source_size").over(every) * SHARE))
    rise = Window.orderBy(F.col("cap") / F.col("w"), "sno")
    capped = F.coalesce(F.sum("cap").over(rise.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("w").over(rise.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    s = (s.withColumn("at", (F.col("total") - capped) / left)
         .withColumn("level", F.max("at").over(every)))
    return s.select("source", "sno", "source_size", F.least("cap", F.col("level") * F.col("w")).alias("target"))


def place(rows: DataFrame) -> DataFrame:
    """Gives each row of size > 0 its first word's number in its source. Rows
    are dealt by hash into about sqrt(rows) parts per source; parts are summed
    first, so the running sums never gather a whole source in one task."""
    parts = max(1, int(rows.count() ** 0.5))
    dealt = rows.where("size > 0").withColumn("part", F.pmod(F.xxhash64("doc_id", "__key"), F.lit(parts)))
    sums = dealt.groupBy("sno", "part").agg(F.sum("size").alias("sum"))
    starts = sums.select("sno", "part", (F.sum("sum").over(Window.partitionBy("sno").orderBy("part")) - F.col("sum")).alias("base"))
    own = Window.partitionBy("sno", "part").orderBy("doc_id", "size", "__key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (dealt.withColumn("run", F.sum("size").over(own) - F.col("size")).join(starts, ["sno", "part"])
            .withColumn("first", F.col("base") + F.col("run")).drop("base", "run", "part"))


def permuted(index: Column, size: Column, *key: Column) -> Column:
    """The swap-or-not permutation of [0, size) keyed by ``key``."""
    def swap(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(r, *key), size) - x, size)
        return F.when(F.xxhash64(r, F.greatest(x, other), *key) % 2 == 0, other).otherwise(x)
    return F.aggregate(F.array(*[F.lit(r) for r in range(ROUNDS)]), index.cast("long"), swap)


def block_words() -> Column:
    """Words of a block of a source, by ``source_size``."""
    return F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.expr(f"source_size div {BLOCK_WORDS}"))).cast("long")


def _numbers(rows: DataFrame, start: Column, end: Column, name: str) -> DataFrame:
    """A row per number from ``start`` up to ``end``, made in runs that are
    spread over the tasks."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = (rows.withColumn("__end", end).withColumn("__from", F.explode(F.sequence(start, end - 1, F.lit(SLOT_RUN).cast("long"))))
            .repartition(n, "sno", "__from"))
    return runs.withColumn(name, F.explode(F.sequence("__from", F.least(F.col("__from") + SLOT_RUN, F.col("__end")) - 1))).drop("__from", "__end")


def shard_counts(targets: DataFrame, seed: int = 17) -> DataFrame:
    """sno, shard, blocks, first, n: how many slots of a shard each source
    fills, drawn, and the number of the first of them."""
    t = (targets.where("source_size > 0").withColumn("words", block_words())
         .withColumn("blocks", F.expr("(source_size + words - 1) div words"))
         .withColumn("slots", F.least(F.round(F.col("target") / F.col("words")).cast("long"), F.col("blocks") * int(MOST)))
         .where("slots > 0").select("sno", "blocks", "slots"))
    zero = F.lit(0).cast("long")
    drawn = (_numbers(t, zero, F.col("slots"), "draw")
             .groupBy("sno", "blocks", F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "sno", "draw"), F.lit(SHARDS)).alias("shard"))
             .agg(F.count(F.lit(1)).alias("n")))
    # at most SHARDS rows a source
    before = Window.partitionBy("sno").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return scratch(drawn.withColumn("first", F.coalesce(F.sum("n").over(before), zero)), "mix-shards")


def slots(targets: DataFrame, seed: int = 17) -> DataFrame:
    """sno, shard, slot, pass, block: every slot of the mix."""
    each = _numbers(shard_counts(targets, seed), F.col("first"), F.col("first") + F.col("n"), "slot")
    index = F.col("slot") - F.col("pass") * F.col("blocks")
    return (each.withColumn("pass", F.expr("slot div blocks"))
            .withColumn("block", permuted(index, F.col("blocks"), F.lit(seed), F.col("sno"), F.col("pass")))
            .select("sno", "shard", "slot", "pass", "block"))


def pieces(placed: DataFrame) -> DataFrame:
    """One row per document and block it reaches into: from_word, n."""
    p = placed.withColumn("words", block_words()).withColumn("block", F.explode(F.sequence(
        F.expr("first div words"), F.expr("(first + size - 1) div words"))))
    begin = F.greatest(F.col("block") * F.col("words"), F.col("first"))
    end = F.least((F.col("block") + 1) * F.col("words"), F.col("first") + F.col("size"))
    return p.select("sno", "block", "first", "doc_id", "__key", "size", (begin - F.col("first")).alias("from_word"), (end - begin).alias("n"))


def mix(docs: DataFrame, seed: int = 17) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, placed, drawn): every row of ``docs`` with its size and source
    target; those of size > 0 with their place; one row per document piece and
    slot that took it (sno, first, doc_id, __key, size, block, from_word, n,
    shard, slot, pass)."""
    key = F.xxhash64("doc_id", "text", "source").alias("__key")
    sizes = scratch(docs.select("doc_id", "source", n_words().alias("size"), key), "mix-sizes")
    targets = scratch(source_targets(sizes), "mix-targets")
    t = targets.withColumnRenamed("source", "s")
    rows = scratch(sizes.join(t, F.col("source").eqNullSafe(F.col("s"))).drop("s", "source"), "mix-rows")
    placed = scratch(place(rows), "mix-placed")
    # the slots come from a row per source, so their estimated size is far too
    # small: a merge join keeps them from being broadcast
    return rows, placed, pieces(placed).join(slots(targets, seed).hint("merge"), ["sno", "block"])


def mix_report(docs: DataFrame, seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target, taken, shards (output shards with
    words of it) of every row of ``docs``."""
    rows, placed, drawn = mix(docs, seed)
    # a document in many blocks is summed by shard first
    sums = (drawn.groupBy("sno", "first", "shard").agg(F.sum("n").alias("n"))
            .groupBy("sno", "first").agg(F.sum("n").alias("taken"), F.count(F.lit(1)).alias("shards")))
    none = F.lit(0).cast("long")
    cols = ["doc_id", "size", "source_size", "target"]
    return (placed.join(sums, ["sno", "first"], "left").select(*cols, F.coalesce("taken", none).alias("taken"), F.coalesce("shards", none).alias("shards"))
            .unionByName(rows.where("size = 0").select(*cols, none.alias("taken"), none.alias("shards"))))


def mix_documents(docs: DataFrame, seed: int = 17) -> DataFrame:
    """The mix as rows of ``docs``' own columns: one row for each pass in which
    a document was drawn. A wholly drawn document keeps its text; of another,
    the drawn words stand in their order, one space between. n_chars, where
    present, follows the text. Documents of size 0 and undrawn ones are absent.
    Rows equal in id, text and source are drawn separately, and their drawn
    rows take the other columns from one of them."""
    _, _, drawn = mix(docs, seed)
    cid = F.coalesce(F.col("doc_id"), F.lit(-1)).alias("__cid")
    taken = (drawn.groupBy("sno", "first", "doc_id", "__key", "size", "pass")
             .agg(F.sort_array(F.collect_list(F.struct("from_word", "n"))).alias("__runs"), F.sum("n").alias("taken"))
             .select(cid, "__key", "__runs", (F.col("taken") == F.col("size")).alias("__whole")))
    one = (docs.withColumn("__key", F.xxhash64("doc_id", "text", "source")).withColumn("__cid", cid)
           .dropDuplicates(["__key", "__cid"]))
    tokens = F.split(F.regexp_replace(F.col("text"), rf"\A{_GAP}|{_GAP}\z", ""), _GAP)
    cut = F.transform(F.array(tokens), lambda t: F.array_join(F.flatten(F.transform(
        "__runs", lambda r: F.slice(t, (r["from_word"] + 1).cast("int"), r["n"].cast("int")))), " "))[0]
    out = one.join(taken, ["__key", "__cid"]).withColumn("__text", F.when(F.col("__whole"), F.col("text")).otherwise(cut))
    own = {"text": F.col("__text").alias("text")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.length("__text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*[own.get(c, F.col(c)) for c in docs.columns])
