"""Envelopes sent to their topics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_topics(messages: DataFrame, options: Mapping[str, str]) -> None:
    """Send `topic, key, value` rows to Kafka.

    The key keeps the events of one record in one partition, and so in order.
    """
    messages.select("topic", "key", "value").write.format("kafka").options(**options).save()


def write_topic_folders(messages: DataFrame, path: str) -> None:
    """Append the same rows as JSON lines, one folder per topic."""
    messages.select("topic", "key", "value").write.mode("append").partitionBy("topic").json(path)
