"""Exact deduplication by two-pass Bloom filtering.

Pass one counts, for every text's 64-bit hash, the positions it sets; the
positions set at least twice form a filter of hashes that may repeat. Pass two
tests each row against it: a row that fails is certainly unique and passes
straight through, and only the others are shuffled and resolved exactly, by
their whole SHA-256.

Cases: null text equals the empty text; all texts without other characters
than ``[\\x20\\x09-\\x0D]`` are equal; of repeated rows exactly one is kept; a
null doc_id stays only where its group has no other row of that length; an
empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import bloom_filter, keep_rows, row_key, scratch


def _fingerprints(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    sha = F.sha2(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "").cast("binary"), 256)
    return scratch(docs.select("doc_id", F.length(text).alias("n"), row_key().alias("__key"), sha.alias("sha"))
                   .withColumn("h", F.xxhash64("sha")).withColumn("rid", F.monotonically_increasing_id()),
                   "exact-dedup")


def _groups(maybe: DataFrame) -> DataFrame:
    """One row per text among the possibly repeated ones: its size and the row
    that stays (longest original, then smallest doc_id)."""
    rank = F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("z"), "doc_id", "rid", "__key")
    return scratch(maybe.groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"), F.min(rank).alias("k"))
                   .select("sha", "group_size", F.col("k.doc_id").alias("keep_id"), F.col("k.rid").alias("keep_rid"),
                           F.col("k.__key").alias("keep_key")), "exact-groups")


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``."""
    rows = _fingerprints(docs)
    repeated = bloom_filter(rows, "h", repeated=True)
    tested = rows.withColumn("maybe", repeated("h"))
    maybe = scratch(tested.where("maybe").drop("maybe", "h"), "exact-maybe")
    resolved = maybe.join(_groups(maybe), "sha").select(
        "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"),
        F.col("sha").alias("text_sha256"))
    unique = tested.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    return unique.unionByName(resolved)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    rows = _fingerprints(docs)
    repeated = bloom_filter(rows, "h", repeated=True)
    maybe = scratch(rows.where(repeated("h")).drop("h"), "exact-maybe")
    same = F.col("__key") == F.col("keep_key")
    verdicts = scratch(maybe.join(_groups(maybe).where("group_size > 1"), "sha")
                       .groupBy("doc_id", "__key").agg(F.max(same & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept")),
                       "exact-verdicts")
    return keep_rows(docs, verdicts)
