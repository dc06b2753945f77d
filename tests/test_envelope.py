import datetime as dt
import json
import random
import uuid

from tests.fixtures import CUR, TX_SPACE, TX_T, dumps
from txlake.operators import (
    clean_currencies,
    clean_transactions,
    decode_envelopes,
    encode_currencies,
    encode_transactions,
    normalize_messages,
    split_rejects,
)
from txlake.schemas import UUID_NAMESPACE


def _records(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def _msgs(spark, values):
    return normalize_messages(decode_envelopes(_records(spark, values)))


def test_t_and_space_give_same_time(spark):
    m = _msgs(spark, [dumps(TX_T), dumps({**TX_T, "sent_dttm": "2021-03-09 05:42:17"})])
    times = [r.sent_dttm for r in m.collect()]
    assert times[0] == times[1] == dt.datetime(2021, 3, 9, 5, 42, 17)


def test_key_order_does_not_matter(spark):
    m = _msgs(spark, [dumps(dict(reversed(TX_SPACE.items())))]).first()
    assert m.object_type == "transaction"
    assert m.sent_dttm == dt.datetime(2021, 3, 9, 16, 25, 4)
    assert json.loads(m.payload) == TX_SPACE["payload"]


def test_rejects_keep_text(spark):
    bad = ["not json", None, "[" + dumps(TX_T) + "]", "{}"]
    m = _msgs(spark, [dumps(TX_T)] + bad)
    good, rejects = split_rejects(m)
    assert good.count() == 1
    got = {(r.raw_value, r.reject_reason) for r in rejects.collect()}
    assert got == {("not json", "malformed"), (None, "null_value"),
                   ("[" + dumps(TX_T) + "]", "malformed"), ("{}", "missing_object_id")}


def test_garbage_time_is_null_not_error(spark):
    m = _msgs(spark, [dumps({**TX_T, "sent_dttm": "garbage"}),
                      dumps({**TX_T, "sent_dttm": "2021-03-09 05:42:58.321"})])
    assert [r.sent_dttm for r in m.collect()] == [None, None]


def test_unknown_and_null_type_are_not_routed(spark):
    m = _msgs(spark, [dumps({**TX_T, "object_type": "REFUND"}),
                      dumps({**TX_T, "object_type": None})])
    assert clean_transactions(m).count() == 0
    assert {r.object_type for r in m.collect()} == {"refund", None}


def test_wrong_typed_field_nulls_only_itself(spark):
    p = {**TX_T["payload"], "amount": 12.5}
    m = _msgs(spark, [dumps({**TX_T, "payload": p})])
    r = clean_transactions(m).first()
    assert r.amount is None
    assert r.account_number_from == 5001 and r.status == "queued"
    assert r.transaction_dt == dt.datetime(2021, 3, 9, 5, 42, 17)


def test_currency_time_of_day_and_float_rate(spark):
    p = {**CUR["payload"], "date_update": "2021-03-14 10:11:12"}
    m = _msgs(spark, [dumps({**CUR, "payload": p})])
    ours = clean_currencies(m).first()
    parity = clean_currencies(m, date_only=True).first()
    assert ours.date_update == dt.datetime(2021, 3, 14, 10, 11, 12)
    assert parity.date_update == dt.datetime(2021, 3, 14, 0, 0, 0)
    assert ours.currency_with_div == 2.359999895095825
    assert ours.object_id == CUR["object_id"]
    exact = clean_currencies(m, exact_rate=True)
    assert dict(exact.dtypes)["currency_with_div"] == "decimal(18,6)"
    assert str(exact.first().currency_with_div) == "2.360000"
    both = clean_currencies(m, date_only=True, exact_rate=True).first()
    assert both.date_update == dt.datetime(2021, 3, 14, 0, 0, 0)
    assert str(both.currency_with_div) == "2.360000"


def test_payload_as_json_string(spark):
    m = _msgs(spark, [dumps({**TX_T, "payload": "just text"})])
    assert m.first().payload == "just text"
    r = clean_transactions(m).first()
    assert r.operation_id is None and r.amount is None


def test_round_trip_transactions(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(200):
        rows.append((
            f"op-{i}", rnd.choice([None, -1, rnd.randint(0, 10**9)]),
            rnd.randint(0, 10**9), rnd.choice([None, 11, 12]),
            rnd.choice(["freedonia", "sylvania", None, 'quo"te\\']),
            rnd.choice(["queued", "done", "in_progress"]),
            rnd.choice(["sbp_incoming", "sbp_outgoing"]),
            rnd.randint(-10**6, 10**6),
            dt.datetime(2021, 3, 9) + dt.timedelta(seconds=rnd.randint(0, 10**7)),
        ))
    dump = spark.createDataFrame(rows, "operation_id string, account_number_from long, "
                                 "account_number_to long, currency_code int, country string, "
                                 "status string, transaction_type string, amount long, "
                                 "transaction_dt timestamp")
    back = clean_transactions(normalize_messages(decode_envelopes(encode_transactions(dump))))
    assert sorted(back.collect()) == sorted(dump.collect())


def test_round_trip_currencies(spark):
    rows = [(31, 32, dt.datetime(2021, 3, 14, 10, 11, 12), 2.36),
            (1, 2, dt.datetime(2023, 1, 1), 0.5)]
    dump = spark.createDataFrame(rows, "currency_code int, currency_code_with int, "
                                 "date_update timestamp, currency_with_div double")
    env = encode_currencies(dump)
    back = clean_currencies(normalize_messages(decode_envelopes(env)))
    got = sorted((r.currency_code, r.currency_code_with, r.date_update, r.currency_with_div)
                 for r in back.collect())
    assert got[0][:3] == (1, 2, dt.datetime(2023, 1, 1))
    assert got[1][3] == 2.359999895095825
    ids = {r.object_id for r in back.collect()}
    midnight = str(uuid.uuid5(uuid.UUID(UUID_NAMESPACE), "31322021-03-14 00:00:00"))
    assert midnight not in ids  # 10:11:12, not midnight
    mid = spark.createDataFrame([(31, 32, dt.datetime(2021, 3, 14), 2.36)], dump.schema)
    mid_id = clean_currencies(normalize_messages(decode_envelopes(encode_currencies(mid)))) \
        .first().object_id
    assert mid_id == midnight


def test_binary_kafka_value_decodes_like_text(spark):
    recs = spark.createDataFrame([(bytearray(dumps(TX_T).encode()), 0, 7)],
                                 "value binary, partition int, offset long")
    m = normalize_messages(decode_envelopes(recs, keep=("offset",))).first()
    assert m.object_id == TX_T["object_id"] and m.offset == 7
    assert json.loads(m.payload) == TX_T["payload"]


from decimal import Decimal  # noqa: E402

from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 999), st.integers(0, 999),
                          st.datetimes(dt.datetime(2000, 1, 1), dt.datetime(2030, 1, 1)),
                          st.decimals(min_value=Decimal("0.000001"), max_value=Decimal("99999"),
                                      places=6)),
                min_size=1, max_size=40))
def test_round_trip_currencies_property(spark, rows):
    rows = [(a, b, t.replace(microsecond=0), float(r)) for a, b, t, r in rows]
    dump = spark.createDataFrame(rows, "currency_code int, currency_code_with int, "
                                 "date_update timestamp, currency_with_div double")
    msgs = normalize_messages(decode_envelopes(encode_currencies(dump)))
    back = clean_currencies(msgs, exact_rate=True).collect()
    got = sorted((r.currency_code, r.currency_code_with, r.date_update,
                  r.currency_with_div) for r in back)
    want = sorted((a, b, t, Decimal(repr(r)).quantize(Decimal("0.000001")))
                  for a, b, t, r in rows)
    assert got == want
