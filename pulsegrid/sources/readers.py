"""Readers: raw files by day or incrementally, and date-bounded table reads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pulsegrid.operators.date_windows import DateWindow, as_date


def day_path(root: str, day: str | dt.date) -> str:
    d = as_date(day)
    return f"{root.rstrip('/')}/year={d.year}/month={d.month:02d}/day={d.day:02d}/"


def read_raw_day(spark: SparkSession, root: str, day: str | dt.date | None,
                 schema: T.StructType) -> DataFrame:
    """One day of (gzip) JSON lines, read with a fixed schema."""
    if not day:
        raise ValueError("a date is required to read one day")
    return spark.read.schema(schema).json(day_path(root, day))


def read_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as text in ``value``, for jobs that validate the record themselves."""
    return spark.read.text(path)


def stream_new_files(spark: SparkSession, path: str, schema: T.StructType | None = None,
                     files_per_batch: int | None = None, fmt: str = "json") -> DataFrame:
    """Files not seen by an earlier run; the checkpoint of the query is the bookmark.

    Without a schema the files are read as text lines.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if schema is None:
        return reader.text(path)
    return reader.schema(schema).format(fmt).load(path)


def read_table_window(table: DataFrame, window: DateWindow, columns: Sequence[str],
                      date: str = "event_local_date", valid: str | None = "decode_success"
                      ) -> DataFrame:
    """Date-bounded projection, valid rows only; bounds are literals, so partitions are pruned."""
    rows = table.where(window.holds(date))
    if valid is not None:
        rows = rows.where(valid)
    return rows.select(*columns)


def read_events_window(spark: SparkSession, path: str, window: DateWindow, key: str = "event_guid"
                       ) -> DataFrame:
    """Partitioned event files with ``dt`` in ``window`` and a non-blank key."""
    from pulsegrid.functions.predicates import present

    reader = spark.read.option("mergeSchema", "false")
    rows = reader.parquet(path)
    in_window = (window.holds("dt") if isinstance(rows.schema["dt"].dataType, T.DateType)
                 else window.holds_text("dt"))
    return rows.where(in_window & present(key))
