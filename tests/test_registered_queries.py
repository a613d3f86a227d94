"""Every registered query against its SQL on the smallest data set."""

import shutil
import time
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

import __spark_entry__ as entry
from workloads import catalog
from tests.oracle_compare import compare, duck

FOLDER = "/root/testdata/sf0.001"


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.fixture(scope="module")
def moved(spark, tmp_path_factory):
    """The smallest data set with events long before, within and long after the month."""
    folder = tmp_path_factory.mktemp("moved") / "t"
    shutil.copytree(FOLDER, folder)
    shift = F.expr("CASE event_id % 3 WHEN 0 THEN INTERVAL '-400' DAY WHEN 1 THEN INTERVAL '0' DAY ELSE INTERVAL '90' DAY END")
    rows = spark.read.parquet(f"{FOLDER}/events.parquet").withColumn("ts", F.col("ts") + shift).toPandas()
    (folder / "events.parquet").unlink()
    rows.to_parquet(folder / "events.parquet", coerce_timestamps="us")
    return str(folder)


@pytest.mark.parametrize("name", [
    "user_active_daily_v1_all_days", "user_active_daily_v2", "product_active_daily_v1", "product_active_daily_v2_all_days",
    "app_events_load", "app_events_union", "user_product_rolling", "retention_d0_d7", "daily_active_users_v1",
    "daily_active_users_v2", "session_sets_daily", "crash_counts_daily", "report_ota_rate", "app_v1_tables"])
def test_events_of_days_outside_the_month(spark, moved, name):
    """Events of all days reach the result."""
    assert compare(spark, duck(moved), name, entry.queries()[name], entry.oracle_sql()[name], moved) == ""
    rows = entry.queries()[name](spark, moved)
    dates = [f.name for f in rows.schema if f.dataType == DateType() and f.name not in ("partition_date", "airflow_ds")]
    column = "partition_date" if not dates or name.startswith(("user_active", "product_active")) else dates[0]
    first, last = rows.agg(F.min(column), F.max(column)).first()
    assert first < date(2023, 1, 1) and last >= date(2024, 3, 1)


@pytest.mark.parametrize("name", ["device_records_flat", "app_records_flat", "device_events_decoded"])
def test_record_queries_are_planned_in_seconds(spark, name):
    """Rules written out at every use once kept the optimizer busy without end."""
    frame = entry.queries()[name](spark, FOLDER)
    started = time.monotonic()
    frame._jdf.queryExecution().optimizedPlan()
    assert time.monotonic() - started < 10


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, con, name):
    query, sql = entry.queries()[name], entry.oracle_sql().get(name)
    assert sql is not None, f"{name} has no SQL"
    assert compare(spark, con, name, query, sql, FOLDER) == ""
