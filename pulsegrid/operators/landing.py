"""Landing of flat app events: typing, first copy per event, union of event tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.payloads import payload_object
from pulsegrid.functions.predicates import is_dev_build, platform_of, present
from pulsegrid.functions.times import epoch_millis_whole_seconds, local_date, local_timestamp
from pulsegrid.functions.values import (
    APP_PAYLOAD_COLUMNS,
    CURRENT_RECORD_VERSION,
    EVENT_REGISTRY,
    LEGACY_RECORD_VERSION,
    LEGACY_TABLE,
)
from pulsegrid.operators.date_windows import DateWindow

_UNION_COLUMNS = (
    "event_name", "event_guid", "event_timestamp", "event_local_timestamp", "event_local_date",
    "client_id", "client_name", "client_variant", "client_version", "client_build",
    "client_platform", "product_guid", "firmware_version", "payload", "partition_date",
    "source_schema", "source_table", "record_version", "client_mono_time", "event_sequence_id",
    "session_id", "app_instance_id", "user_id", "is_test_event",
)


def load_app_events(flat: DataFrame, window: DateWindow, received_at: Column) -> DataFrame:
    """Typed staging rows of the flat landing table for ``dt`` in ``window``.

    ``received_at`` is the load time (or an arrival column where the source has one). Payload
    columns that no record carries become JSON nulls.
    """
    zoned = F.col("event_timestamp").cast("timestamp")
    return (
        flat.where(window.holds_text("dt") & present("event_guid"))
        .select(
            "event_name",
            F.col("event_schema_version").cast("string").alias("event_schema_version"),
            "event_guid",
            epoch_millis_whole_seconds(zoned).alias("event_timestamp"),
            local_date(zoned).alias("event_local_date"),
            received_at.alias("event_received_at"),
            "client_name", "client_variant", "client_version", "client_build",
            F.col("client_id").cast("string").alias("client_id"),
            "client_mono_time", "client_is_background",
            F.col("nova_device_os").alias("client_os_name"),
            F.col("nova_device_os_version").alias("client_os_version"),
            "product_name", "product_id", "product_variant",
            F.col("product_guid").cast("string").alias("product_guid"),
            "product_firmware_version",
            F.col("client_session_id").cast("string").alias("session_id"),
            payload_object(APP_PAYLOAD_COLUMNS, flat.columns).alias("payload"),
            F.col("dt").cast("date").alias("partition_date"),
        )
    )


def first_copy(events: DataFrame, key: str = "event_guid",
               order: Sequence[str] = ("event_received_at", "event_timestamp")) -> DataFrame:
    """The earliest copy of every ``key``; equal copies are told apart by a hash of the row. Rows
    without a key are no copies of each other and are all kept.

    A ``row_number() = 1`` filter is planned with a per-task limit ahead of the shuffle, so a key
    that fills a third of the table sends one row per task and not the table to one reducer.
    """
    row_hash = F.xxhash64(*[F.col(c) for c in events.columns if c != key])
    rank = F.row_number().over(Window.partitionBy(key, "_own").orderBy(*order, row_hash))
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    return (events.withColumn("_own", own).withColumn("_copy", rank).where("_copy = 1")
            .drop("_copy", "_own"))


def select_event(flat: DataFrame, event: str, window: DateWindow, source_schema: str,
                 registry: Mapping[str, tuple[bool, Sequence[str]]] = EVENT_REGISTRY,
                 source_table: str | None = None) -> DataFrame:
    """One event table in the shape of the unified table."""
    has_product, payload_columns = registry[event]
    nothing = F.lit(None).cast("string")
    zoned = F.col("event_timestamp").cast("timestamp")
    return (
        flat.where(window.holds_text("dt") & F.col("event_guid").isNotNull())
        .select(
            F.lit(event).alias("event_name"),
            "event_guid",
            zoned.alias("event_timestamp"),
            local_timestamp(zoned).alias("event_local_timestamp"),
            local_date(zoned).alias("event_local_date"),
            "client_id", "client_name", "client_variant", "client_version", "client_build",
            platform_of("client_name").alias("client_platform"),
            (F.col("product_guid") if has_product else nothing).alias("product_guid"),
            (F.col("product_firmware_version") if has_product else nothing).alias("firmware_version"),
            payload_object(payload_columns, flat.columns).alias("payload"),
            F.col("dt").cast("date").alias("partition_date"),
            F.lit(source_schema).alias("source_schema"),
            F.lit(source_table or event).alias("source_table"),
            F.lit(CURRENT_RECORD_VERSION).cast("smallint").alias("record_version"),
            F.col("client_mono_time").cast("long").alias("client_mono_time"),
            F.lit(None).cast("long").alias("event_sequence_id"),
            F.col("client_session_id").cast("string").alias("session_id"),
            nothing.alias("app_instance_id"),
            nothing.alias("user_id"),
            is_dev_build("client_variant").alias("is_test_event"),
        )
    )


def select_legacy(log: DataFrame, window: DateWindow, source_schema: str,
                  event: str | None = None) -> DataFrame:
    """The previous record generation in the shape of the unified table.

    Its event time is the server's receive time while local time and date come from the client.
    """
    nothing = F.lit(None).cast("string")
    rows = log.where(window.holds("log_date") & F.col("event_uuid").isNotNull())
    if event is not None:
        rows = rows.where(F.col("event_type_name") == event)
    return rows.select(
        F.col("event_type_name").alias("event_name"),
        F.col("event_uuid").alias("event_guid"),
        F.col("server_received_at").cast("timestamp").alias("event_timestamp"),
        F.col("client_local_time").cast("timestamp").alias("event_local_timestamp"),
        F.col("client_local_date").cast("date").alias("event_local_date"),
        F.col("app_user_id").alias("client_id"),
        F.col("app_name").alias("client_name"),
        F.col("app_variant").alias("client_variant"),
        F.col("app_version").alias("client_version"),
        F.col("app_build").alias("client_build"),
        F.col("device_platform").alias("client_platform"),
        nothing.alias("product_guid"),
        nothing.alias("firmware_version"),
        F.to_json(F.struct(F.col("raw_payload_json").alias("raw_payload")),
                  {"ignoreNullFields": "false"}).alias("payload"),
        F.col("log_date").cast("date").alias("partition_date"),
        F.lit(f"{source_schema}_v4").alias("source_schema"),
        F.lit(LEGACY_TABLE).alias("source_table"),
        F.lit(LEGACY_RECORD_VERSION).cast("smallint").alias("record_version"),
        F.lit(None).cast("long").alias("client_mono_time"),
        F.col("row_id").cast("long").alias("event_sequence_id"),
        nothing.alias("session_id"),
        nothing.alias("app_instance_id"),
        F.col("app_user_id").alias("user_id"),
        F.coalesce(F.col("is_internal"), F.lit(False)).alias("is_test_event"),
    )


def union_events(read: Callable[[str], DataFrame], window_of: Callable[[str], DateWindow],
                 source_schema: str, legacy: DataFrame | None = None,
                 legacy_window: DateWindow | None = None,
                 read_dev: Callable[[str], DataFrame] | None = None, event: str | None = None,
                 registry: Mapping[str, tuple[bool, Sequence[str]]] = EVENT_REGISTRY) -> DataFrame:
    """All registered event tables, then the legacy log, as one table.

    ``read(name)`` gives the production table of an event, ``read_dev`` (development targets
    only) its development twin. ``event`` limits the run to one type. Branches are plain narrow
    scans; there is no shuffle.
    """
    legs = []
    for name in registry:
        if event not in (None, name):
            continue
        for reader in (read, read_dev):
            if reader is not None:
                legs.append(select_event(reader(name), name, window_of(name), source_schema, registry))
    if legacy is not None:
        legs.append(select_legacy(legacy, legacy_window, source_schema, event))
    if not legs:
        raise ValueError(f"unknown event {event!r}")
    return reduce(DataFrame.unionByName, [leg.select(*_UNION_COLUMNS) for leg in legs])
