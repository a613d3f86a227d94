"""Intermediate results in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.session import shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path nobody uses yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once and read back: a lost executor costs its own tasks, not the lineage,
    and several consumers do not compute it again."""
    spark = frame.sparkSession
    path = new_folder(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def kept(frame: DataFrame, name: str, partition_by: Sequence[str] = ()) -> Iterator[DataFrame]:
    """``written`` for the length of a block; the folder goes with it. Readers of a value of the few
    that ``partition_by`` columns have read that part alone."""
    spark = frame.sparkSession
    path = new_folder(spark, name)
    frame.write.partitionBy(*partition_by).parquet(path)
    try:
        yield spark.read.schema(frame.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
