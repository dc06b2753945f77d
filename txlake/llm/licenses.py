"""Licence scan by a positional rare-token index, DataFrame functions only.

The templates' words form a small positional index, weighted by inverse document
frequency over all files. A template's rarest words, without which its others
weigh less than ``SHARE`` of it, propose places of the template wherever they
stand in a file; each place is then looked up for all the template's index
words. Where those found weigh at least ``SHARE``, the template's mandatory
key phrase is verified word by word there. Function words are no index words
but must stand in the key phrase where the template has them.

Cases: a null text is empty; a file without words has no places, no labels and
score 0; places and positions count words from 0; repeated rows are scanned
each; an empty table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txlake.llm.common import scratch

SHARE = 0.5

#: Label, notice text, and its mandatory key phrase.
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license", "lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license", "affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("bsd", "released under the bsd license", "bsd license"),
    ("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    ("cc-by", "licensed under cc by 4 0", "cc by"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "dedicated to the public domain under cc0", "cc0"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)
#: Base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Words too common to be index words.
FUNCTION_WORDS = ("a and any are by forms free in is into of or person released source subject terms the this to under use "
                  "version with without work charge copy public domain 0 2 3 4").split()

_SEP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _constants(templates):
    """Postings, key words and template sizes, all bounded by the templates."""
    words = [t[1].split() for t in templates]
    index = sorted({w for t in words for w in t} - set(FUNCTION_WORDS))
    known = sorted({w for t in words for w in t} | {w for p, _ in BASE for w in p.split()})
    postings = [(i, n, w) for i, t in enumerate(words) for n, w in enumerate(t) if w in index]
    keys = []
    for i, (_, text, key) in enumerate(templates):
        first = re.search(rf"(?<!\S){re.escape(key)}(?!\S)", text).start()
        at = len(text[:first].split())
        keys += [(i, at + n, w) for n, w in enumerate(key.split())]
    return index, known, postings, keys


def fixed_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """``rows`` as a relation of the driver: a plain list would be read by
    Python workers, which an executor then has beside its own memory."""
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(names, r, strict=True)) for r in rows]), schema)


def file_words(text: Column) -> Column:
    """The words of a file, in order; translate() and a pattern for both ends of
    the text would make an object of every character and another copy of it."""
    # A-Z only: the Kelvin sign is the one other character that lower() turns
    # into a lone ASCII letter
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u2126")))
    return F.filter(F.split(low, _SEP), lambda w: w != "")


def licence_hits(docs: DataFrame, known: list[str], trigger: list[str]) -> DataFrame:
    """rid, doc_id, n_words, hits (position, word): licence words of every file
    that holds at least one trigger word."""
    base = docs.select("doc_id", file_words(F.col("text")).alias("w")).select("doc_id", "w", F.size("w").cast("long").alias("n_words"))
    near = F.exists("w", lambda w: w.isin(trigger))
    # a row is made of a licence word only, not of every word of the file
    hits = F.filter(F.transform("w", lambda w, i: F.when(w.isin(known), F.struct(i.cast("long").alias("pos"), w.alias("word")))), lambda x: x.isNotNull())
    return scratch(base.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "n_words", F.when(near, hits).alias("hits")), "licence-hits")


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, matches (template, position, share) for every row of ``docs``."""
    spark = docs.sparkSession
    index, known, postings, keys = _constants(templates)
    files = licence_hits(docs, known, sorted(set(index) | {w for p, _ in BASE for w in p.split()} - {"public", "general"}))
    hits = scratch(files.where("hits is not null").select("rid", F.explode("hits").alias("h")).select("rid", "h.pos", "h.word"), "licence-words")

    # base phrases: runs of consecutive words
    nearby = Window.partitionBy("rid").orderBy("pos")
    ahead = hits.select("rid", "pos", "word", *[F.lead(c, n).over(nearby).alias(f"{c}{n}") for n in (1, 2) for c in ("pos", "word")])
    label = F.lit(None).cast("string")
    for phrase, name in BASE:
        ws = phrase.split()
        same = F.col("word") == ws[0]
        for n, w in enumerate(ws[1:], 1):
            same &= (F.col(f"word{n}") == w) & (F.col(f"pos{n}") == F.col("pos") + n)
        label = F.when(same, F.lit(name)).otherwise(label)
    base = (ahead.withColumn("label", label).where("label is not null").groupBy("rid")
            .agg(F.count(F.lit(1)).alias("n_base"), F.min("pos").alias("first_word"), F.max("pos").alias("last_word"), F.collect_set("label").alias("base")))

    # document frequencies over all files; a row per index word
    n_files = files.count()
    df = hits.where(F.col("word").isin(index)).select("rid", "word").distinct().groupBy("word").count()
    idf = df.select("word", F.log((F.lit(n_files) + 1) / F.col("count")).alias("idf"))
    posting = fixed_table(spark, postings, "tid int, tpos long, word string")
    weight = scratch(posting.join(F.broadcast(idf), "word", "left").withColumn("idf", F.coalesce("idf", F.log(F.lit(n_files + 1.0)))), "licence-index")
    total = weight.groupBy("tid").agg(F.sum("idf").alias("total"))

    # a template's rarest words propose its places; a place without any of them
    # cannot reach SHARE
    on = Window.partitionBy("tid").orderBy("idf", F.desc("tpos")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = weight.withColumn("rest", F.sum("idf").over(on)).join(total, "tid").where(F.col("rest") >= SHARE * (1 - 1e-9) * F.col("total"))
    places = hits.join(F.broadcast(starts.select("tid", "tpos", "word")), "word").select("rid", "tid", (F.col("pos") - F.col("tpos")).alias("at")).distinct()
    looked = (places.join(F.broadcast(weight), "tid").select("rid", "tid", "at", (F.col("at") + F.col("tpos")).alias("pos"), "word", "idf")
              .join(hits, ["rid", "pos", "word"]))
    votes = (looked.groupBy("rid", "tid", "at").agg(F.sum("idf").alias("votes"))
             .join(F.broadcast(total), "tid").withColumn("share", F.col("votes") / F.col("total")).where(F.col("share") >= SHARE))

    # mandatory key phrases, word by word
    key = fixed_table(spark, keys, "tid int, kpos long, kword string")
    need = key.groupBy("tid").agg(F.count(F.lit(1)).alias("need"))
    asked = votes.join(F.broadcast(key), "tid").select("rid", "tid", "at", "share", (F.col("at") + F.col("kpos")).alias("pos"), F.col("kword").alias("word"))
    verified = (asked.join(hits, ["rid", "pos", "word"]).groupBy("rid", "tid", "at", "share").count()
                .join(F.broadcast(need), "tid").where("count = need")
                # a key phrase inside a longer one at the same place gives way to it
                .withColumn("longest", F.max("need").over(Window.partitionBy("rid", "at"))).where("need = longest"))
    names = fixed_table(spark, [(i, t[0]) for i, t in enumerate(templates)], "tid int, name string")
    found = (verified.join(F.broadcast(names), "tid").groupBy("rid")
             .agg(F.collect_set("name").alias("names"), F.max("share").alias("best"),
                  F.sort_array(F.collect_list(F.struct(F.col("name").alias("template"), F.col("at").alias("position"), "share"))).alias("matches")))
    none = F.array().cast("array<string>")
    # files without a trigger word have neither and are not shuffled
    marked = files.where("hits is not null").select("rid", "doc_id", "n_words").join(base, "rid", "left").join(found, "rid", "left")
    each = marked.unionByName(files.where("hits is null").select("rid", "doc_id", "n_words"), allowMissingColumns=True)
    both = F.array_union(F.coalesce("base", none), F.coalesce("names", none))
    return each.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.array_join(F.sort_array(F.coalesce("base", none)), ",").alias("base_labels"),
        F.array_join(F.sort_array(both), ",").alias("labels"),
        F.least(F.lit(1.0), F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, 0.5).otherwise(0.0))).alias("score"), "matches")
