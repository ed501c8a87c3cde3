"""Keyed JSON publish to a message bus (B-12).

Uses Spark's public Kafka sink; the connector jar must be on the classpath.
Records come from ``functions.codec.encode_*`` (``key``, ``value``, ``topic``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def publish(records: DataFrame, servers: str, topic: str | None = None) -> None:
    out = records.select("key", "value", *(["topic"] if topic is None else []))
    writer = out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all")
    if topic is not None:
        writer = writer.option("topic", topic)
    writer.save()


def publish_stream(records: DataFrame, servers: str, checkpoint: str, topic: str | None = None):
    out = records.select("key", "value", *(["topic"] if topic is None else []))
    writer = (out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("kafka.acks", "all").option("checkpointLocation", checkpoint))
    if topic is not None:
        writer = writer.option("topic", topic)
    return writer.start()
