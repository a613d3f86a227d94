"""Daily activity facts of users and of devices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.predicates import guid_shaped, not_flagged_test, not_test_traffic, present
from pulsegrid.functions.values import NO_VARIANT
from pulsegrid.operators.date_windows import DateWindow


def user_daily_by_ingest_date(events: DataFrame, window: DateWindow) -> DataFrame:
    """One row per ingest date, client, app name/variant/version, OS and product.

    OS is set on session-start events only, so one client-day usually spans several rows: count
    clients downstream, never sum ``session_count`` over a day.
    """
    return (
        events.where(window.holds("partition_date") & (F.col("client_id") != "")
                     & not_test_traffic("client_name"))
        .withColumn("client_variant", F.coalesce("client_variant", F.lit(NO_VARIANT)))
        .groupBy("partition_date", "client_id", "client_name", "client_variant", "client_version",
                 "client_os_name", "client_os_version", "product_id", "product_name")
        .agg(
            F.min("event_timestamp").alias("first_event_ts"),
            F.max("event_timestamp").alias("last_event_ts"),
            F.min("client_mono_time").alias("first_event_mono"),
            F.max("client_mono_time").alias("last_event_mono"),
            F.count(F.lit(1)).alias("event_count"),
            F.count_distinct("session_id").alias("session_count"),
        )
    )


def user_daily_by_local_date(events: DataFrame, window: DateWindow) -> DataFrame:
    """One row per local date, client, app name/variant/version/build and platform.

    Hardly two events share all of these and the session, so aggregating ahead of a shuffle cuts
    nothing: events are dealt by date and client once, and sessions and facts are counted where
    they are. A client's events of a date meet in one task, in buffers of fixed width.
    """
    return (
        events.where(window.holds("partition_date") & present("client_id")
                     & not_flagged_test("is_test_event"))
        .repartition("event_local_date", "client_id")
        .groupBy("event_local_date", "client_id", "client_name", "client_variant",
                 "client_version", "client_build", "client_platform")
        .agg(
            F.min("event_timestamp").alias("first_event_timestamp"),
            F.max("event_timestamp").alias("last_event_timestamp"),
            F.min("client_mono_time").alias("first_mono_time"),
            F.max("client_mono_time").alias("last_mono_time"),
            F.count(F.lit(1)).alias("event_count"),
            F.count_distinct("session_id").alias("session_count"),
            F.max("partition_date").alias("partition_date"),
        )
    )


def product_daily_with_catalogue_names(events: DataFrame, window: DateWindow) -> DataFrame:
    """One row per local date and device of the first-generation event table."""
    rows = (
        events.where(window.holds("partition_date") & present("product_guid")
                     & present("product_firmware_version") & not_test_traffic("client_name"))
        .withColumn("client_variant", F.coalesce("client_variant", F.lit(NO_VARIANT)))
        .withColumnRenamed("product_firmware_version", "firmware_version")
    )
    return _product_daily(rows, ("product_id", "product_name", "client_variant"))


def product_daily(events: DataFrame, window: DateWindow) -> DataFrame:
    """One row per local date and device of the second-generation event table."""
    rows = events.where(device_rows(window))
    return _product_daily(rows, ("client_variant",))


def device_rows(window: DateWindow):
    """Rows of the second-generation table that say something about a device."""
    return (window.holds("partition_date") & guid_shaped("product_guid")
            & present("firmware_version") & not_flagged_test("is_test_event"))


def _product_daily(rows: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Last firmware of the day, users and events per device.

    Rows are dealt by date, device and client once, because a client hardly repeats itself: an
    aggregate ahead of that shuffle cuts nothing. The aggregate behind it keeps fixed-width buffers
    only, so it hashes in place and cuts the rows to one per device, client and firmware before
    text maxima and the last-firmware pick are taken there; a device with a third of all rows is
    spread over its clients meanwhile. Firmware reported at one same last instant is settled by the
    greater text.
    """
    keys = ("event_local_date", "product_guid")
    dealt = rows.repartition(*keys, "client_id")
    per_client = dealt.groupBy(*keys, "client_id", "firmware_version", *carried).agg(
        F.min("event_timestamp").alias("first_seen_ts"),
        F.max("event_timestamp").alias("last_seen_ts"),
        F.count(F.lit(1)).alias("events"),
        F.max("partition_date").alias("partition_date"),
    )
    return per_client.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in carried],
        F.max_by("firmware_version", F.struct("last_seen_ts", "firmware_version"))
        .alias("firmware_version"),
        F.min("first_seen_ts").alias("first_seen_ts"),
        F.max("last_seen_ts").alias("last_seen_ts"),
        F.count_distinct("client_id").alias("active_user_count"),
        F.sum("events").alias("event_count"),
        F.max("partition_date").alias("partition_date"),
    )
