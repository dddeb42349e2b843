"""Run history as a stream (an extension; the batch operators define the results).

Events are appended as files; a streaming query keeps their latest state in a table, so reports need no full scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tracking import latest

EVENTS = "source_uuid string, parser_run_id string, status string, last_updated timestamp, file_extension string, ncn string, error_message string"


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(EVENTS).json(path)


def keep_latest(events: DataFrame, table: str, checkpoint: str):
    """A query that merges each batch into the table of latest states, written anew under the batch's number: a batch that
    is repeated after a failure gives the same table."""
    spark = events.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        before = batch.limit(0) if number == 0 else spark.read.schema(batch.schema).parquet(f"{table}/batch={number - 1}")
        latest(before.unionByName(batch)).select(batch.columns).write.mode("overwrite").parquet(f"{table}/batch={number}")

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_hour(events: DataFrame) -> DataFrame:
    """Events by status in hours, late ones up to two hours."""
    return events.withWatermark("last_updated", "2 hours").groupBy(F.window("last_updated", "1 hour"), "status").count()
