"""Tick messages: Kafka source and decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom import schemas


def kafka_ticks(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Stream of ``key, value``. Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
    )
    return reader.options(**options).load()


def decode_ticks(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON messages to tick columns. Works on a batch and on a stream.

    A message that does not parse yields NULL fields and is left out, as is one
    without symbol or price. A time that does not parse is NULL.
    """
    tick = F.from_json(F.col(value).cast("string"), schemas.TICK_MESSAGE)
    return (
        messages.select(tick.alias("tick")).select("tick.*")
        .withColumn("event_time", F.try_to_timestamp("timestamp"))
        .withColumn("event_date", F.to_date("event_time"))
        .filter(F.col("symbol").isNotNull() & F.col("price").isNotNull())
    )
