"""Report files, their catalogue partitions, views, quarantine files and SQL databases."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.values import EXPORT_BATCH_ROWS, EXPORT_KEEP_DAYS
from pulsegrid.operators.date_windows import as_date
from pulsegrid.operators.quality import assert_checks, check_export_rows
from pulsegrid.sources.publish import Files


def report_path(root: str, name: str, report_date: str) -> str:
    dt.datetime.strptime(report_date, "%Y%m%d")
    return f"{root.rstrip('/')}/vw_device_{name}/{report_date}/"


def export_parquet(frame: DataFrame, root: str, name: str, report_date: str,
                   sort_by: Sequence[str] = ()) -> int:
    """Write a report snapshot and return its row count."""
    path = report_path(root, name, report_date)
    counted = Observation()
    rows = frame.sortWithinPartitions(*sort_by) if sort_by else frame
    rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").parquet(path)
    return int(counted.get["rows"])


def register_partition(spark: SparkSession, table: str, frame: DataFrame, report_date: str,
                       location: str) -> None:
    """Make a snapshot a partition of a catalogue table; an existing one is left as it is."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)
    root = location.rstrip("/").rsplit("/", 1)[0]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, report_date string) USING parquet "
              f"PARTITIONED BY (report_date) LOCATION '{root}'")
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS "
              f"PARTITION (report_date='{report_date}') LOCATION '{location}'")


def publish_report(frame: DataFrame, table: str, root: str, name: str, report_date: str,
                   sort_by: Sequence[str] = (), during: Callable[[str], None] = lambda step: None) -> int:
    """Write a report snapshot into a folder of its own, then make it the table's partition of that
    date in one catalogue change; the row count.

    Readers see the snapshot of before, whole, until that change, and a failed write changes nothing.
    Folders of earlier runs stay, for readers under way, until ``prune_report_runs``.
    """
    spark = frame.sparkSession
    location = f"{report_path(root, name, report_date)}run-{uuid.uuid4().hex[:12]}/"
    counted = Observation()
    rows = frame.sortWithinPartitions(*sort_by) if sort_by else frame
    rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(location)
    during("written")
    partition = f"PARTITION (report_date='{report_date}')"
    register_partition(spark, table, frame, report_date, location)
    spark.sql(f"ALTER TABLE {table} {partition} SET LOCATION '{location}'")
    spark.catalog.refreshTable(table)
    return int(counted.get["rows"])


def report_location(spark: SparkSession, table: str, report_date: str) -> str:
    """Where the table's partition of that date lies."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (report_date='{report_date}')").where(
        "col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def prune_report_runs(spark: SparkSession, table: str, root: str, name: str, report_date: str) -> int:
    """Remove the folders of runs that the catalogue no longer points to; how many."""
    folder = report_path(root, name, report_date).rstrip("/")
    files, current = Files(spark, folder), report_location(spark, table, report_date)
    gone = [n for n, is_folder in files.children(folder)
            if is_folder and n.startswith("run-") and not current.endswith(f"/{n}")]
    for n in gone:
        files.delete(f"{folder}/{n}")
    return len(gone)


def create_view(frame: DataFrame, name: str) -> None:
    """A view of this session, over any frame."""
    frame.createOrReplaceTempView(name)


def create_stored_view(spark: SparkSession, name: str, table: str, columns: Mapping[str, str],
                       where: str | None = None, order_by: Sequence[str] = ()) -> None:
    """A view in the catalogue that every session reads: ``columns`` (name to SQL expression) of a
    catalogue table."""
    picked = ", ".join(f"{expression} AS `{column}`" for column, expression in columns.items())
    sql = f"CREATE OR REPLACE VIEW {name} AS SELECT {picked} FROM {table}"
    sql += f" WHERE {where}" if where else ""
    spark.sql(sql + (f" ORDER BY {', '.join(order_by)}" if order_by else ""))


def write_quarantine(bad: DataFrame, root: str, stream: str) -> int:
    """Raw text and reason of bad records as JSON files under the stream's prefix."""
    counted = Observation()
    rows = bad.withColumn("stream_type", F.lit(stream)).observe(
        counted, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("append").partitionBy("stream_type").json(root)
    return int(counted.get["rows"])


# --- SQL databases ----------------------------------------------------------------------
def swap_statements(table: str, staging: str, columns: Sequence[str], business_date: str | dt.date,
                    keep_days: int = EXPORT_KEEP_DAYS) -> list[tuple[str, tuple]]:
    """The statements of one transaction: clear the day, insert it, prune old days."""
    day = as_date(business_date)
    names = ", ".join(columns)
    return [
        (f"DELETE FROM {table} WHERE business_date = ?", (day,)),
        (f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}", ()),
        (f"DELETE FROM {table} WHERE business_date < ?", (day - dt.timedelta(days=keep_days),)),
    ]


def export_jdbc(frame: DataFrame, url: str, table: str, business_date: str | dt.date,
                properties: Mapping[str, str] | None = None, connections: int = 8,
                required: Sequence[str] = ("business_date", "client_id", "product_id")) -> None:
    """Copy one day to a SQL database and prune it to the last days.

    Required columns are checked before anything is written. Executors write to a staging table
    in batches over a bounded number of connections; the visible table changes in one
    transaction on the database, so readers never see half a day.
    """
    day = as_date(business_date)
    rows = frame if "business_date" in frame.columns else frame.withColumn(
        "business_date", F.lit(day))
    assert_checks(check_export_rows(rows, table, day, required))
    staging = f"{table}_staging"
    (rows.coalesce(connections).write.mode("overwrite")
     .option("batchsize", EXPORT_BATCH_ROWS)
     .jdbc(url, staging, properties=dict(properties or {})))
    _in_transaction(frame.sparkSession, url, dict(properties or {}),
                    swap_statements(table, staging, rows.columns, day))


def _in_transaction(spark: SparkSession, url: str, properties: Mapping[str, str],
                    statements: Sequence[tuple[str, tuple]]) -> None:
    jvm = spark.sparkContext._jvm
    settings = jvm.java.util.Properties()
    for key, value in properties.items():
        settings.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.setAutoCommit(False)
        for text, values in statements:
            statement = connection.prepareStatement(text)
            for i, value in enumerate(values, 1):
                statement.setDate(i, jvm.java.sql.Date.valueOf(str(value)))
            statement.executeUpdate()
            statement.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()
