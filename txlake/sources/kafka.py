"""Kafka source and sink options.

The Kafka connector jar is not bundled; these functions build the reader and
writer and validate settings, and work wherever the connector is on the
classpath.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from txlake.schemas import DEFAULT_MAX_OFFSETS_PER_TRIGGER, DEFAULT_MIN_PARTITIONS


@dataclass(frozen=True)
class KafkaSettings:
    """Connection and admission settings of one topic."""

    bootstrap_servers: str
    topic: str
    username: str | None = None
    password: str | None = None
    truststore_pem: str | None = None
    max_offsets_per_trigger: int = DEFAULT_MAX_OFFSETS_PER_TRIGGER
    min_partitions: int = DEFAULT_MIN_PARTITIONS
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False

    def validate(self) -> None:
        """Check every value on its own (an f-string of empty parts is still
        truthy, so a joined ``host:port`` cannot be validated as a whole)."""
        host, _, port = self.bootstrap_servers.rpartition(":")
        problems = []
        if not host or not port.isdigit():
            problems.append("bootstrap_servers must be host:port")
        if not self.topic:
            problems.append("topic is empty")
        secured = [self.username, self.password, self.truststore_pem]
        if any(secured) and not all(secured):
            problems.append("username, password and truststore go together")
        if self.max_offsets_per_trigger <= 0 or self.min_partitions <= 0:
            problems.append("admission limits must be positive")
        if problems:
            raise ValueError("; ".join(problems))

    def reader_options(self) -> dict[str, str]:
        self.validate()
        o = {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "maxOffsetsPerTrigger": str(self.max_offsets_per_trigger),
            "minPartitions": str(self.min_partitions),
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        return {**o, **self._security()}

    def writer_options(self) -> dict[str, str]:
        self.validate()
        return {"kafka.bootstrap.servers": self.bootstrap_servers,
                "topic": self.topic, **self._security()}

    def _security(self) -> dict[str, str]:
        if not self.username:
            return {}
        return {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "SCRAM-SHA-512",
            "kafka.sasl.jaas.config": (
                "org.apache.kafka.common.security.scram.ScramLoginModule "
                f'required username="{self.username}" password="{self.password}";'
            ),
            "kafka.ssl.truststore.type": "PEM",
            "kafka.ssl.truststore.location": self.truststore_pem,
        }


def kafka_stream(spark: SparkSession, settings: KafkaSettings) -> DataFrame:
    """Streaming frame of the topic's records (``key, value, topic,
    partition, offset, timestamp, timestampType``)."""
    return spark.readStream.format("kafka").options(**settings.reader_options()).load()


def tail_options(settings: KafkaSettings, position: str | int = "beginning",
                 partitions: int | None = None) -> dict[str, str]:
    """Batch reader options for a topic tail starting at ``position``:

    * ``"beginning"`` -- every partition from its earliest offset;
    * an absolute offset ``n`` -- every partition from ``n``, as a consumer's
      ``-o n`` does (Spark takes offsets per partition, so ``partitions``,
      the topic's partition count, is needed);
    * ``"s@<ms>"`` / ``"e@<ms>"`` -- start at / stop before a timestamp in
      epoch milliseconds, on every partition.
    """
    o = settings.reader_options()
    # admission control is for streams; minPartitions still splits the read
    o.pop("maxOffsetsPerTrigger", None)
    if position == "beginning":
        o["startingOffsets"] = "earliest"
    elif isinstance(position, int):
        if position < 0 or not partitions:
            raise ValueError("an absolute offset needs offset >= 0 and the partition count")
        o["startingOffsets"] = json.dumps(
            {settings.topic: {str(p): position for p in range(partitions)}})
    elif isinstance(position, str) and position[:2] in ("s@", "e@") \
            and position[2:].isdigit():
        o["startingTimestamp" if position[0] == "s" else "endingTimestamp"] = position[2:]
    else:
        raise ValueError(f"unsupported tail position {position!r}")
    return o


def kafka_tail(spark: SparkSession, settings: KafkaSettings,
               position: str | int = "beginning",
               partitions: int | None = None) -> DataFrame:
    """Batch read of the topic from ``position`` (see ``tail_options``) with
    the record metadata, key and value as text."""
    o = tail_options(settings, position, partitions)
    return (spark.read.format("kafka").options(**o).load()
            .selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value",
                        "partition", "offset", "timestamp"))


def write_kafka(envelopes: DataFrame, settings: KafkaSettings) -> None:
    """Publish a frame with a ``value`` column (JSON text) to the topic; one
    distributed write, every task its own producer."""
    envelopes.select("value").write.format("kafka").options(
        **settings.writer_options()).save()
