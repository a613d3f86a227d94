"""Streaming ingest: new files -> validated flat rows and quarantine; dedupe with a lateness bound.

Every batch writes into partitions named after its query and batch id with an overwrite, so a batch
that is run again after a failure replaces what its first attempt left behind, and a second query or
a new checkpoint, whose batches count from 0 again, leaves what others wrote.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.operators import contracts, flatten
from pulsegrid.operators.contracts import Contract
from pulsegrid.operators.device_events import RAW_SCHEMA
from pulsegrid.plans.device_tables import DeviceTables
from pulsegrid.sources import scratch
from pulsegrid.sources.readers import stream_new_files


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the query of this checkpoint; it outlives restarts."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def batch_writer(root: str, contract: Contract, registry: DataFrame | None = None,
                 query: Callable[[], str] = lambda: "batch") -> Callable[[DataFrame, int], None]:
    """Writer of one batch of text lines to ``root/records`` and ``root/quarantine``.

    ``query`` names the query whose batches are written; batches of different queries lie apart. The
    judged batch is written to the shared folder once and read back for both outputs, so an executor
    that is lost takes none of it along; quarantine rows keep the raw text, which is not written for
    valid ones, as their fields are.
    """
    def write(lines: DataFrame, batch_id: int) -> None:
        judged = contracts.validate_records(lines, contract).withColumns(
            {"query_id": F.lit(query()), "batch_id": F.lit(batch_id).cast("long"),
             "value": F.when(F.col("error_code").isNotNull(), F.col("value"))}).drop("errors")
        with scratch.kept(judged, "judged") as rows:
            good = contracts.valid_records(rows)
            flat = (flatten.flatten_app(good, keep=("query_id", "batch_id")) if contract.stream == "app"
                    else flatten.flatten_device(good, registry, keep=("query_id", "batch_id")))
            flat = flat.withColumn("dt", F.date_format("event_timestamp", "yyyy-MM-dd"))
            bad = contracts.failures(rows, keep=("query_id", "batch_id")).withColumn(
                "stream_type", F.lit(contract.stream))
            dynamic = {"partitionOverwriteMode": "dynamic"}
            (flat.write.mode("overwrite").options(**dynamic).partitionBy("query_id", "batch_id", "dt")
             .parquet(f"{root}/records"))
            (bad.write.mode("overwrite").options(**dynamic).partitionBy("stream_type", "query_id", "batch_id")
             .json(f"{root}/quarantine"))

    return write


def ingest_stream(spark: SparkSession, path: str, root: str, checkpoint: str, contract: Contract,
                  registry: DataFrame | None = None, available_now: bool = True,
                  every: timedelta | None = None, files_per_batch: int | None = None
                  ) -> StreamingQuery:
    """Start ingest of files appearing under ``path``.

    ``available_now`` handles what is there and stops, which is the incremental batch run;
    otherwise the query keeps running, triggered ``every`` so often.
    """
    lines = stream_new_files(spark, path, files_per_batch=files_per_batch)
    write = batch_writer(root, contract, registry, lambda: query_id(spark, checkpoint))
    writer = (lines.writeStream.foreachBatch(write)
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every is not None:
        writer = writer.trigger(processingTime=f"{int(every.total_seconds())} seconds")
    return writer.start()


def device_stream(spark: SparkSession, path: str, tables: DeviceTables, registry: DataFrame,
                  checkpoint: str, written: Callable[[str], None] = lambda table: None
                  ) -> StreamingQuery:
    """Decode raw device files not seen before into the event, invalid and subject tables, and stop.

    A batch that failed on its way through the tables is run again by the next query with this
    checkpoint, and then replaces its own rows in all of them (``DeviceTables.ingest_once``).
    """
    records = stream_new_files(spark, path, RAW_SCHEMA)

    def write(batch: DataFrame, batch_id: int) -> None:
        tables.ingest_once(batch, registry, query_id(spark, checkpoint), batch_id, written)

    return (records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def first_copy_stream(events: DataFrame, key: str = "event_guid", time: str = "event_timestamp",
                      lateness: str = "3 days") -> DataFrame:
    """First copy of every event in a stream.

    Copies arriving within ``lateness`` of each other are recognised; state older than that is
    dropped, so it stays bounded by the events of that span. Events later than that are dropped
    altogether, first copies too: the batch jobs take them in by running their date window again.
    """
    return events.withWatermark(time, lateness).dropDuplicatesWithinWatermark([key])
