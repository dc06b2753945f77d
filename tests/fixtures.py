"""Hand-made messages: the wire format's field names with invented values, and
the malformed cases of FIXTURES.md section 3."""

import json


def message(oid, otype, sent, **payload):
    """An envelope: its own fields first, then the payload's by name."""
    return {"object_id": oid, "object_type": otype, "sent_dttm": sent,
            "payload": dict(sorted(payload.items()))}


def transaction(n, sent, **fields):
    oid = f"11111111-aaaa-4bbb-8ccc-{n:012d}"
    return message(oid, "TRANSACTION", sent, operation_id=oid,
                   transaction_dt=sent.replace("T", " "), **fields)


TX_T = transaction(1, "2021-03-09T05:42:17", account_number_from=5001, account_number_to=7002,
                   currency_code=11, country="freedonia", status="queued",
                   transaction_type="test_outgoing", amount=-345)

TX_SPACE = transaction(2, "2021-03-09 16:25:04", account_number_from=5003, account_number_to=7004,
                       currency_code=12, country="sylvania", status="in_progress",
                       transaction_type="test_incoming", amount=67890)

CUR = message("11111111-aaaa-5bbb-8ccc-000000000003", "CURRENCY", "2021-03-14T00:00:00",
              date_update="2021-03-14 00:00:00", currency_code=11, currency_code_with=12,
              currency_with_div=2.36)


def dumps(m):
    return json.dumps(m)


def failing_once(sink):
    """``sink``, but the first callback fails after its writes, as a crash
    between the write and the commit would."""
    call, failed = sink.__call__, []

    class Failing(type(sink)):
        def __call__(self, df, batch_id):
            call(df, batch_id)
            if not failed:
                failed.append(batch_id)
                raise RuntimeError(f"injected failure after writing batch {batch_id}")
    sink.__class__ = Failing
    return sink
