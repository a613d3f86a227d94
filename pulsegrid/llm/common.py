"""What several operators share: tables, staged results, words."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.session import shared_folder

# A word is a run of characters other than space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path nobody uses yet, in the folder that all executors share."""
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"


def staged(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back: a lost executor costs its own
    tasks, not the lineage, and several consumers do not compute it again."""
    spark = frame.sparkSession
    path = new_folder(spark, name)
    frame.write.parquet(path)
    out = spark.read.schema(frame.schema).parquet(path)
    out.staged_path = path
    return out


def released(frame: DataFrame, name: str) -> DataFrame:
    """``staged``, after which the shuffle files of the writing go at once instead of when the driver
    happens to collect its garbage."""
    conf, key = frame.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return staged(frame, name)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def discard(*frames: DataFrame) -> None:
    """Remove what ``staged`` wrote and nothing reads any more; of a frame made from a staged one,
    the folders of its files."""
    for frame in frames:
        jvm = frame.sparkSession._jvm
        conf = frame.sparkSession._jsc.hadoopConfiguration()
        known = getattr(frame, "staged_path", None)
        for folder in [known] if known else {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
            if "/llm-" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)


def word_count(text: Column) -> Column:
    """Words of a text; no text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether a row belongs to the fold that is never learned from; a null id counts as empty."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus == remainder


@contextmanager
def small_batches(spark: SparkSession, records: int = 2000, size: int = 32 << 20) -> Iterator[None]:
    """Arrow batches small enough that a batch of long texts fits a Python worker, for what runs
    inside the block; the session's own settings are back after it."""
    keys = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(records),
            "spark.sql.execution.arrow.maxBytesPerBatch": str(size)}
    before = {key: spark.conf.get(key, None) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches small enough that a batch of long texts fits a Python worker. Results do not
    depend on it; settings made elsewhere are kept."""
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "2000"),
                       ("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))):
        if spark.conf.get(key, None) in (None, "10000", str((1 << 63) - 1), str((1 << 31) - 1)):
            spark.conf.set(key, value)


def first_by_hash(rows: DataFrame, hashed: str, most: int, *order: str) -> DataFrame:
    """The first ``most`` rows by a 64-bit hash column (then ``order``), or all if there are fewer. A
    cut on the hash ahead of the sort leaves little more than that many to be sorted, whatever the
    number of partitions; it may leave a few less than ``most``."""
    n = rows.count()
    share = min(1.0, (most + 8 * most ** 0.5 + 50) / max(n, 1))
    low = rows.where(F.col(hashed) <= int(-(1 << 63) + ((1 << 64) - 1) * share)) if share < 1 else rows
    return low.orderBy(hashed, *order).limit(most)
