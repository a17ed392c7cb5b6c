"""Kafka topics as streams of text values.

The connector is Spark's own ``spark-sql-kafka-0-10`` package, to be named
in ``spark.jars.packages`` of the session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_BROKERS = "localhost:9092"
DEFAULT_TOPIC = "xcse"


def kafka_reader_options(
    brokers: str = DEFAULT_BROKERS,
    topic: str = DEFAULT_TOPIC,
    group: str | None = None,
    start: str = "earliest",
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    ``start`` is ``earliest``, ``latest`` or ``committed``. Spark keeps
    committed positions in the checkpoint of the query: with a checkpoint
    every start resumes there, and ``committed`` without one means the
    earliest record. ``max_offsets`` bounds one micro-batch. Without ``group``
    every query gets a group of its own, as it must to see all records.
    """
    if start not in ("earliest", "latest", "committed"):
        raise ValueError(f"unknown start position: {start}")
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "earliest" if start == "committed" else start,
    }
    if group:
        options["kafka.group.id"] = group
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_kafka(spark: SparkSession, streaming: bool = True, **options) -> DataFrame:
    """Columns ``value`` (text) and ``seq`` (offset) of a topic.

    A topic keyed by symbol keeps the ticks of one symbol in one Kafka
    partition, so the offset orders ticks with the same event time.
    """
    reader = spark.readStream if streaming else spark.read
    records = reader.format("kafka").options(**kafka_reader_options(**options)).load()
    return records.select(F.col("value").cast("string").alias("value"), F.col("offset").alias("seq"))
