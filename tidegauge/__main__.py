"""Runs a job between two Kafka topics: python -m tidegauge ticks --topics-in xcse

The session needs Spark's Kafka package (``spark-sql-kafka-0-10``) and, for a
JDBC target, the driver of the database.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from .plans.jobs import ADVICE_COLUMNS, RECORDS, SALE_COLUMNS, rejected, rejected_sales, sales_job, start_to, tick_job, window_job
from .session import pin_utc, ship_package, use_rocksdb
from .sources.kafka import DEFAULT_BROKERS, DEFAULT_TOPIC, read_kafka
from .streaming.sinks import JdbcTarget, kafka_batch, to_kafka_value, write_files, write_jdbc, write_kafka

JOBS = {"ticks": tick_job, "windows": window_job}


class RejectLog(StreamingQueryListener):
    """Warns of each micro-batch that left records out, and keeps the sums."""

    def __init__(self):
        self.read = self.rejected = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(RECORDS)
        if found is not None:
            self.read += found["read"]
            self.rejected += found["rejected"]
            if found["rejected"]:
                logging.warning("batch %s: %s of %s records rejected", event.progress.batchId, found["rejected"], found["read"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tidegauge", description=__doc__)
    parser.add_argument("job", choices=[*JOBS, "sales"])
    parser.add_argument("--kafka-brokers", default=DEFAULT_BROKERS, help="bootstrap servers of the source and the target")
    parser.add_argument("--kafka-group-id", help="only where access rules ask for one; never the same for two jobs")
    parser.add_argument("--topics-in", default=DEFAULT_TOPIC, help="topic to subscribe to")
    parser.add_argument("--topics-out", default="ema", help="topic that results are written to")
    parser.add_argument("--start", default="earliest", choices=["earliest", "latest", "committed"])
    parser.add_argument("--checkpoint", required=True, help="folder of offsets and state, shared by all nodes; a restart goes on from it")
    parser.add_argument("--rejects", help="folder for records that cannot be used, as text")
    parser.add_argument("--max-offsets", type=int, default=5_000_000, help="records per micro-batch")
    parser.add_argument("--jdbc-url", help="sales: also append to a table of this database")
    parser.add_argument("--jdbc-table", default="aggregated_sales")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = use_rocksdb(ship_package(pin_utc(SparkSession.builder.appName(f"tidegauge-{args.job}").getOrCreate())))
    values = read_kafka(
        spark,
        brokers=args.kafka_brokers,
        topic=args.topics_in,
        group=args.kafka_group_id,
        start=args.start,
        max_offsets=args.max_offsets,
    )
    spark.streams.addListener(RejectLog())
    checkpoint = f"{args.checkpoint.rstrip('/')}/{args.job}"
    if args.rejects:
        reject = rejected_sales if args.job == "sales" else rejected
        write_files(reject(values), args.rejects, f"{checkpoint}-rejects", format="text")
    if args.job == "sales":
        writers = [kafka_batch(args.kafka_brokers, args.topics_out, columns=SALE_COLUMNS)]
        if args.jdbc_url:
            writers.insert(0, write_jdbc(JdbcTarget(args.jdbc_url, args.jdbc_table)))
        query = start_to(sales_job(values), checkpoint, *writers)
    else:
        advice = to_kafka_value(JOBS[args.job](values), epoch=["timestamp"], columns=ADVICE_COLUMNS)
        query = write_kafka(advice, checkpoint, args.kafka_brokers, args.topics_out)
    spark.streams.awaitAnyTermination()
    query.stop()


if __name__ == "__main__":
    main()
