import random
import uuid

from pyspark.sql import functions as F

from txlake.functions import parse_event_time, status_rank, uuid5, uuid5_from_parts
from txlake.schemas import UUID_NAMESPACE


def test_uuid5_of_joined_parts(spark):
    df = spark.createDataFrame([(31, 32, "2021-03-14 00:00:00")], "a int, b int, d string")
    got = df.select(uuid5_from_parts(F.col("a"), F.col("b"), F.col("d"))).first()[0]
    assert got == str(uuid.uuid5(uuid.UUID(UUID_NAMESPACE), "31322021-03-14 00:00:00"))


def test_uuid5_equals_python(spark):
    rnd = random.Random(7)
    alphabet = "abcXYZ019 -_:é漢🙂"
    names = ["", "x"] + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 40)))
                         for _ in range(300)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = dict(df.select("n", uuid5(F.col("n")).alias("u")).collect())
    ns = uuid.UUID(UUID_NAMESPACE)
    for n in names:
        assert got[n] == str(uuid.uuid5(ns, n)), n


def test_uuid5_parts_collision_and_separator(spark):
    df = spark.createDataFrame([(51, 260), (512, 60)], "a int, b int")
    joined = [r[0] for r in df.select(uuid5_from_parts(F.col("a"), F.col("b"), F.lit("d"))).collect()]
    assert joined[0] == joined[1]  # parity: parts joined without separator
    sep = [r[0] for r in df.select(uuid5_from_parts(F.col("a"), F.col("b"), F.lit("d"), sep="|")).collect()]
    assert sep[0] != sep[1]


def test_uuid5_null_part(spark):
    df = spark.createDataFrame([(None, 1)], "a int, b int")
    assert df.select(uuid5_from_parts(F.col("a"), F.col("b"))).first()[0] is None


def test_status_rank_and_order(spark):
    df = spark.createDataFrame([("done",), ("queued",), ("weird",), (None,), ("chargeback",)], "s string")
    rows = df.select("s", status_rank(F.col("s")).alias("r")) \
        .orderBy(F.col("r").asc_nulls_last(), F.col("s").asc_nulls_last()).collect()
    assert [(r.s, r.r) for r in rows] == [("queued", 1), ("done", 4), ("chargeback", 5),
                                          ("weird", None), (None, None)]


def test_parse_event_time(spark):
    df = spark.createDataFrame([("2021-03-09T05:42:17",), ("2021-03-09 05:42:17",),
                                ("garbage",), ("2021-03-09 05:42:58.321",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_event_time(F.col("t")).cast("string")).collect()]
    assert got == ["2021-03-09 05:42:17", "2021-03-09 05:42:17", None, None, None]
