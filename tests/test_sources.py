import pytest

from txlake.sources import KafkaSettings


def test_kafka_settings_validate_each_value():
    with pytest.raises(ValueError):
        KafkaSettings(bootstrap_servers="None:None", topic="t").validate()
    with pytest.raises(ValueError):
        KafkaSettings(bootstrap_servers="host:9091", topic="t", username="u").validate()
    o = KafkaSettings("host:9091", "t", "u", "p", "/ca.pem").reader_options()
    assert o["maxOffsetsPerTrigger"] == "10000" and o["minPartitions"] == "8"
    assert o["startingOffsets"] == "earliest" and o["failOnDataLoss"] == "false"
    assert o["kafka.sasl.mechanism"] == "SCRAM-SHA-512"


def test_tail_positions():
    import json

    from txlake.sources import tail_options
    s = KafkaSettings("host:9091", "tx-in")
    assert tail_options(s)["startingOffsets"] == "earliest"
    o = tail_options(s, 42, partitions=3)
    assert json.loads(o["startingOffsets"]) == {"tx-in": {"0": 42, "1": 42, "2": 42}}
    assert "maxOffsetsPerTrigger" not in o and o["minPartitions"] == "8"
    assert tail_options(s, "s@1700000000000")["startingTimestamp"] == "1700000000000"
    assert tail_options(s, "e@1700000000000")["endingTimestamp"] == "1700000000000"
    for bad in ((42, None), ("end", None), ("s@x", None), (-1, 3)):
        with pytest.raises(ValueError):
            tail_options(s, *bad)
