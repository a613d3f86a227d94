"""Session defaults and the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.compression.codec": "zstd",
    # the JVM never compiles a method above 8000 bytes of code, so a stage whose generated method
    # is longer runs interpreted; below this limit Spark splits the expressions instead (record
    # validation runs twice as fast for it)
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # streaming state on local disk with changes in the checkpoint, not on the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "pulsegrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; ``master`` is left to spark-submit if unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_defaults(spark: SparkSession) -> None:
    """Set those defaults that results or speed depend on in a session made elsewhere."""
    for key in ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit",
                "spark.sql.streaming.stateStore.providerClass"):
        spark.conf.set(key, DEFAULTS[key])


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Where that is unset it lies beside the tables of
    the warehouse, which all executors reach as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return folder.rstrip("/")
