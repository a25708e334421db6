"""Kafka transport: options only. The connector package must be on the cluster's classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from txnwatch import schemas as S


def read_topic(
    spark: SparkSession, servers: str, topic: str = S.TRANSACTIONS_TOPIC, max_offsets: int = 1_000_000
) -> DataFrame:
    """Records of a topic from the earliest offset; ``timestamp`` becomes ``ingest_ts``.

    ``max_offsets`` bounds one micro-batch, and with it the rows one user's
    state function sees at a time.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
        .select("key", "value", "partition", "offset", F.col("timestamp").alias("ingest_ts"))
    )


def write_topic(
    records: DataFrame, servers: str, checkpoint: str, topic: str = S.ALERTS_TOPIC, interval: str = "60 seconds"
) -> DataStreamWriter:
    """A writer for encoded records. Delivery is at least once; alert ids make repeats harmless."""
    writer = (
        records.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=interval)
    )
    return writer.option("includeHeaders", "true") if "headers" in records.columns else writer
