"""Readers: batch Parquet, partition-pruned tables, file streams, Kafka."""

from txlake.sources.files import read_parquet, read_partitioned, read_table, spread
from txlake.sources.stream import record_stream
from txlake.sources.kafka import (
    KafkaSettings,
    kafka_stream,
    kafka_tail,
    tail_options,
    write_kafka,
)

__all__ = [
    "read_parquet",
    "read_partitioned",
    "read_table",
    "spread",
    "record_stream",
    "KafkaSettings",
    "kafka_stream",
    "kafka_tail",
    "tail_options",
    "write_kafka",
]
