"""The event log as a Spark source: a Kafka topic, or a folder of JSON-lines files that stands in for it."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.schemas import TOPIC
from tripflow.sources.files import exists, make_folder


@dataclass(frozen=True)
class KafkaLog:
    servers: str
    topic: str


# Messages repeat their field names: packed they take about a ninth. A packed file is read by one task, so it is kept short.
PACKED_ROWS = 250_000


@dataclass(frozen=True)
class FileLog:
    """A folder of JSON lines, packed unless its files are batches of their own (`packed=False`: any file may be long)."""

    folder: str
    files_per_batch: int | None = None
    packed: bool = True


class ConnectorMissing(RuntimeError):
    """The Kafka source is not on the classpath of this Spark application."""


# Fixed value: the Kafka client's error for a topic that nobody has created yet.
ABSENT_TOPIC = re.compile(r"unknown_?topic_?or_?partition", re.IGNORECASE)


def diagnose(error: Exception) -> str | None:
    """'connector' or 'topic' when the error is one of the two expected conditions, else None."""
    text = str(error).lower()
    if "failed to find data source: kafka" in text or "failed to find the data source: kafka" in text:
        return "connector"
    if ABSENT_TOPIC.search(text):
        return "topic"
    return None


def connector_hint(error: Exception) -> ConnectorMissing:
    return ConnectorMissing(
        "Kafka source not found. Submit the application with the spark-sql-kafka-0-10 package that "
        "matches this Spark version (spark-submit --packages org.apache.spark:...)."
    )


def _kafka(reader, log: KafkaLog):
    return (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", log.servers)
        .option("subscribe", log.topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
    )


def _load(reader) -> DataFrame:
    try:
        return reader.load()
    except Exception as error:
        if diagnose(error) == "connector":
            raise connector_hint(error) from error
        raise


def empty_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], TOPIC)


def read_log(spark: SparkSession, log: KafkaLog | FileLog) -> DataFrame:
    """The whole log so far as (key, value). A log nobody has written to yet is empty, not an error."""
    if isinstance(log, FileLog):
        if not exists(spark, log.folder):
            return empty_log(spark)
        return _lines(spark.read.text(log.folder))
    reader = _kafka(spark.read, log).option("endingOffsets", "latest")
    try:
        records = _load(reader)
        records.isEmpty()  # offsets are looked up when a job runs: an absent topic shows here, not later
    except ConnectorMissing:
        raise
    except Exception as error:
        if diagnose(error) == "topic":
            return empty_log(spark)
        raise
    return _key_value(records)


def follow_log(spark: SparkSession, log: KafkaLog | FileLog) -> DataFrame:
    """The log as a stream from its beginning. Each query keeps its own position in its checkpoint."""
    if isinstance(log, FileLog):
        if not exists(spark, log.folder):
            make_folder(spark, log.folder)
        reader = spark.readStream.format("text")
        if log.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", log.files_per_batch)
        return _lines(reader.load(log.folder))
    return _key_value(_load(_kafka(spark.readStream, log)))


def write_log(messages: DataFrame, log: KafkaLog | FileLog) -> None:
    """Append (key, value) messages. The file form keeps the value only, as a JSON-lines reader expects."""
    if isinstance(log, FileLog):
        writer = messages.select("value").write.mode("append")
        if log.packed:
            writer = writer.option("compression", "gzip").option("zlib.compress.level", "DEFAULT_COMPRESSION")
            writer = writer.option("maxRecordsPerFile", PACKED_ROWS)
        writer.text(log.folder)
        return
    try:
        (
            messages.select("key", "value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", log.servers)
            .option("topic", log.topic)
            .save()
        )
    except Exception as error:
        if diagnose(error) == "connector":
            raise connector_hint(error) from error
        raise


def _lines(text: DataFrame) -> DataFrame:
    return text.select(F.lit(None).cast("string").alias("key"), "value")


def _key_value(records: DataFrame) -> DataFrame:
    return records.select(F.col("key").cast("string"), F.col("value").cast("string"))
