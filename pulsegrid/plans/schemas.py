"""Columns and layout of the warehouse tables.

Facts are partitioned by date and sorted by their most filtered columns, so that row-group
statistics prune within a date; dimensions are unpartitioned.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

from pulsegrid.functions.values import NO_VARIANT, SUBJECT_TABLES
from pulsegrid.sources.tables import TableSpec

# of tables whose partitions hold a month or a whole state: the most files a write leaves in one
SPREAD = 64
_EVENT_V1 = (
    "event_name string, event_schema_version string, event_guid string, event_timestamp bigint, "
    "event_local_date date, event_received_at timestamp, client_name string, "
    "client_variant string, client_version string, client_build string, client_id string, "
    "client_mono_time bigint, client_is_background boolean, client_os_name string, "
    "client_os_version string, product_name string, product_id string, product_variant int, "
    "product_guid string, product_firmware_version string, session_id string, payload string, "
    "partition_date date")
_EVENT_V1_REQUIRED = (
    "event_name", "event_schema_version", "event_guid", "event_timestamp", "event_local_date",
    "event_received_at", "client_name", "client_version", "client_build", "client_id",
    "partition_date")
_DEVICE_EVENT = (
    "event_name string, event_timestamp_ms bigint, schema_id string, raw_payload string, "
    "client_variant string, client_firmware_version string, client_locale string, "
    "client_platform string, device_component_guid string, device_session_id string, "
    "device_mono_time bigint, device_schema_name_raw string, product_sku string, "
    "product_model_name string, product_hw_revision string, payload_json string, "
    "decode_success boolean, event_local_timestamp timestamp, client_version_core string, "
    "device_schema_name string, bt_device_state string, ingest_batch string, event_local_date date")


def _spec(database: str, name: str, columns: str, **layout) -> TableSpec:
    return TableSpec(f"{database}.{name}", StructType.fromDDL(columns), **layout)


def app_v1(db: str) -> dict[str, TableSpec]:
    return {
        "staging": _spec(db, "app_events_staging", _EVENT_V1, comment="Loaded rows before dedupe"),
        "events": _spec(db, "app_events", _EVENT_V1, partition_by=("partition_date",),
                        required=_EVENT_V1_REQUIRED, sort_by=("event_name", "client_id"),
                        comment="One row per event_guid of a load"),
        "events_rejected": _spec(
            db, "app_events_rejected", _EVENT_V1.replace(
                ", partition_date date", ", missing string, partition_date date"),
            partition_by=("partition_date",), comment="Rows that lack a column the events need"),
        "user_daily": _spec(
            db, "dwd_user_active_daily",
            "client_id string, client_name string, client_variant string, client_version string, "
            "client_os_name string, client_os_version string, product_id string, "
            "product_name string, first_event_ts bigint, last_event_ts bigint, "
            "first_event_mono bigint, last_event_mono bigint, event_count bigint, "
            "session_count int, partition_date date",
            partition_by=("partition_date",), sort_by=("client_name", "client_id"),
            required=("client_id", "client_name", "client_version", "partition_date"),
            defaults={"client_variant": NO_VARIANT, "event_count": 0, "session_count": 0},
            comment="Users active per ingest date"),
        "product_daily": _spec(
            db, "dwd_product_active_daily",
            "event_local_date date, product_guid string, product_id string, product_name string, "
            "firmware_version string, client_variant string, first_seen_ts bigint, "
            "last_seen_ts bigint, active_user_count int, event_count int, partition_date date",
            partition_by=("partition_date",), sort_by=("product_guid",),
            required=("event_local_date", "product_guid", "partition_date"),
            defaults={"client_variant": NO_VARIANT, "active_user_count": 0, "event_count": 0},
            comment="Devices active per local date"),
        "pairings": _spec(
            db, "dim_user_product_relationship",
            "client_variant string, client_id string, product_name string, product_guid string, "
            "last_active_dt date", defaults={"client_variant": NO_VARIANT}, required=("client_id",),
            comment="Last date of every client and product"),
        "retention": _spec(
            db, "dws_user_retention",
            "partition_date date, days_since_cohort int, client_name string, product_id string, "
            "cohort_size int, retained_users int, retention_rate decimal(7,4), cohort_date date",
            partition_by=("cohort_date",), sort_by=("partition_date", "client_name"),
            required=("cohort_date", "partition_date", "days_since_cohort", "client_name"),
            defaults={"cohort_size": 0, "retained_users": 0}, comment="Retention curves"),
        "activity": _spec(
            db, "dws_user_activity_bits",
            "client_id string, client_name string, product_id string, days bigint, month date",
            partition_by=("month",), sort_by=("client_id",), spread=SPREAD,
            comment="Active days of a month as bits, per client, app and product"),
        **_audience(db, ""),
    }


def _audience(db: str, suffix: str) -> dict[str, TableSpec]:
    return {
        "daily_active": _spec(
            db, f"dws_daily_active_users{suffix}",
            "product_name string, product_category string, lifecycle_status string, "
            "client_variant string, dau_count bigint, new_users bigint, new_products_active bigint, "
            "accumulated_users bigint, report_date date",
            partition_by=("report_date",), sort_by=("product_name",),
            comment="Daily active, new and accumulated users"),
        "first_seen": _spec(
            db, f"dws_user_first_seen{suffix}",
            "client_id string, client_variant string, product_name string, first_date date",
            partition_by=("first_date",), sort_by=("client_id",),
            comment="First date of every client with a product"),
    }


def app_v2(db: str) -> dict[str, TableSpec]:
    return {
        "events": _spec(
            db, "app_events_unified",
            "event_guid string, event_timestamp timestamp, event_local_timestamp timestamp, "
            "event_local_date date, client_id string, client_name string, client_variant string, "
            "client_version string, client_build string, client_platform string, "
            "product_guid string, firmware_version string, payload string, source_schema string, "
            "record_version smallint, client_mono_time bigint, event_sequence_id bigint, "
            "session_id string, app_instance_id string, user_id string, is_test_event boolean, "
            "partition_date date, source_table string, event_name string",
            partition_by=("partition_date", "source_table", "event_name"), sort_by=("client_id",),
            comment="All event types and both record generations"),
        "user_daily": _spec(
            db, "dwd_user_active_daily_v2",
            "event_local_date date, client_id string, client_name string, client_variant string, "
            "client_version string, client_build string, client_platform string, "
            "first_event_timestamp timestamp, last_event_timestamp timestamp, "
            "first_mono_time bigint, last_mono_time bigint, event_count int, session_count int, "
            "partition_date date", partition_by=("partition_date",), sort_by=("client_id",)),
        "product_daily": _spec(
            db, "dwd_product_active_daily_v2",
            "event_local_date date, product_guid string, firmware_version string, "
            "client_variant string, first_seen_ts timestamp, last_seen_ts timestamp, "
            "active_user_count int, event_count int, partition_date date",
            partition_by=("partition_date",), sort_by=("product_guid",)),
        "pairings": _spec(
            db, "dim_user_product_relationship_v2",
            "client_variant string, client_id string, product_name string, product_guid string, "
            "last_active_dt date, airflow_ds date", partition_by=("airflow_ds",),
            sort_by=("client_id",), spread=SPREAD),
        "retention": _spec(
            db, "dws_user_daily_retention",
            "product_name string, client_variant string, d0_users int, d1_users int, d2_users int, "
            "d3_users int, d7_users int, d1_retention_rate double, d7_retention_rate double, "
            "partition_date date, cohort_date date", partition_by=("cohort_date",)),
        **_audience(db, "_v2"),
    }


def device(db: str) -> dict[str, TableSpec]:
    layout = {"partition_by": ("event_local_date",), "sort_by": ("device_component_guid",)}
    extra = {"reboot_info": ", single_session_reboot_cnt int",
             "shutdown_reason": ", single_session_shutdown_cnt int"}
    subjects = {
        kind: _spec(db, name, _DEVICE_EVENT.replace(
            ", event_local_date date", extra.get(kind, "") + ", event_local_date date"), **layout)
        for kind, name in SUBJECT_TABLES.items()}
    return {
        "events": _spec(db, "ods_device_all_events", _DEVICE_EVENT, **layout),
        "invalid": _spec(db, "ods_device_invalid_events", _DEVICE_EVENT, **layout),
        **subjects,
        "session_sets": _spec(
            db, "dwd_device_product_session_sets_daily",
            "client_variant string, device_component_guid string, device_session_id string, "
            "product_sku string, product_model_name string, client_firmware_version string, "
            "client_version_core string, session_mono_time_start bigint, "
            "session_mono_time_end bigint, session_event_count bigint, "
            "final_bt_device_state string, bt_connect_count bigint, bt_disconnect_count bigint, "
            "event_local_date date", **layout),
        "crash_counts": _spec(
            db, "dws_device_product_crash_session_count_daily",
            "device_component_guid string, client_firmware_version string, crash_cnt_total bigint, "
            "crash_cnt_user bigint, crash_cnt_product bigint, session_cnt bigint, "
            "bt_disconnected_cnt bigint, client_variant string, product_sku string, "
            "product_model_name string, client_version_core string, "
            "firmware_version_format string, release_channel string, release_date date, "
            "event_local_date date", **layout),
        "crash_state": _spec(
            db, "dws_device_last_event",
            "device_component_guid string, event_timestamp_ms bigint, device_mono_time bigint, "
            "device_session_id string, bt_device_state string, client_variant string, "
            "client_firmware_version string, client_version_core string, product_sku string, "
            "product_model_name string, decode_success boolean, event_local_date date, "
            "state_date date, order_by string",
            partition_by=("state_date", "order_by"), sort_by=("device_component_guid",), spread=SPREAD,
            comment="The last event of every device up to a date, which the next window looks back to"),
    }
