"""Registered queries: name -> function of (session, data folder)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions.values import CLIENT_NAMES, EVENT_REGISTRY, SUBJECT_TABLES
from pulsegrid.operators import (
    audience,
    contracts,
    daily_activity,
    device_events,
    device_marts,
    device_reports,
    dimensions,
    flatten,
    landing,
    pairings,
    quality,
    retention,
)
from pulsegrid.operators.date_windows import DateWindow, event_window
from pulsegrid.session import use_defaults
from workloads import records, table_jobs, views

Query = Callable[[SparkSession, str], DataFrame]


def neutral(frame: DataFrame) -> DataFrame:
    """Result types that any client reads alike: UTC timestamps without zone, doubles, bigints."""
    def column(f: T.StructField):
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        return F.col(f.name)

    return frame.select(*[column(f) for f in frame.schema])


# --- app tables -------------------------------------------------------------------------
def app_events_load(spark, sf):
    flat = views.flat_events(spark, sf, text_times=True)
    return landing.load_app_events(flat, views.all_days(spark, sf), F.col("received_at"))


def app_events_first_copy(spark, sf):
    return landing.first_copy(views.staging(spark, sf))


def app_events_union(spark, sf):
    """Every event table with the window of its event type, then the legacy log."""
    days = views.all_days(spark, sf)
    span = (days.hi - days.lo).days
    return landing.union_events(
        lambda name: views.event_table(spark, sf, name),
        lambda name: event_window(name, days.hi, 0, {n: span for n in EVENT_REGISTRY}, floor=days.lo),
        "analytics_source", views.legacy_log(spark, sf), days)


def _users_v1(spark, sf):
    days = views.all_days(spark, sf)
    return daily_activity.user_daily_by_ingest_date(views.app_ods(spark, sf, days), days)


def _users_v2(spark, sf):
    return daily_activity.user_daily_by_local_date(
        views.app_events(spark, sf), views.all_days(spark, sf))


def _devices_v1(spark, sf):
    days = views.all_days(spark, sf)
    return daily_activity.product_daily_with_catalogue_names(views.app_ods(spark, sf, days), days)


def _devices_v2(spark, sf):
    return daily_activity.product_daily(views.app_events(spark, sf), views.all_days(spark, sf))


def _pairings_v1(spark, sf):
    return pairings.latest_pairings(_users_v1(spark, sf), views.products(spark, sf))


def _pairings_v2(spark, sf):
    """Pairings of all days, as a state table holds them."""
    events = views.app_events(spark, sf).where(
        daily_activity.device_rows(views.all_days(spark, sf)) & F.col("client_variant").isNotNull()
        & (F.trim("client_id") != ""))
    seen = events.select("client_variant", "client_id", "product_guid").distinct()
    names = views.products(spark, sf).select("product_guid", "product_name")
    return seen.join(names, "product_guid", "left").withColumn(
        "product_name", F.coalesce("product_name", F.lit("Unknown")))


def user_product_rolling(spark, sf):
    """All days: those up to the last but two in one pass, two more rolled one after the other."""
    events, products, days = views.app_events(spark, sf), views.products(spark, sf), views.all_days(spark, sf)
    state = pairings.window_pairings(
        events, products, DateWindow(days.lo, days.hi - dt.timedelta(days=2)))
    for day in (days.hi - dt.timedelta(days=1), days.hi):
        state = pairings.roll_pairings(pairings.days_pairings(events, products, day), state, day)
    return state


def retention_curve(spark, sf):
    """Curves of the cohorts with activity in the last four days."""
    last = views.all_days(spark, sf).hi
    return retention.retention_curve(
        _users_v1(spark, sf), DateWindow(last - dt.timedelta(days=3), last))


def retention_d0_d7(spark, sf):
    days = views.all_days(spark, sf)
    local = DateWindow(days.lo, days.hi + dt.timedelta(days=1))  # local dates may be a day ahead
    return retention.retention_by_day(_users_v2(spark, sf), _pairings_v2(spark, sf), local, ds=days.hi)


def daily_active_users_v1(spark, sf):
    return audience.daily_active_users(
        _users_v1(spark, sf), _devices_v1(spark, sf), _pairings_v1(spark, sf),
        views.products(spark, sf), date="partition_date", name_before_grouping=True)


def daily_active_users_v2(spark, sf):
    return audience.daily_active_users(
        _users_v2(spark, sf), _devices_v2(spark, sf), _pairings_v2(spark, sf),
        views.products(spark, sf))


# --- device tables ----------------------------------------------------------------------
def _valid(spark, sf):
    return views.device_events(spark, sf)


def session_reboot_count(spark, sf):
    return device_marts.session_event_counts(
        views.device_subject(spark, sf, "reboot_info"), views.all_local_days(spark, sf), "single_session_reboot_cnt")


def session_shutdown_count(spark, sf):
    return device_marts.session_event_counts(
        views.device_subject(spark, sf, "shutdown_reason"), views.all_local_days(spark, sf), "single_session_shutdown_cnt")


def session_sets_daily(spark, sf):
    return device_marts.session_sets(_valid(spark, sf), views.all_local_days(spark, sf))


def crash_counts_daily(spark, sf):
    return device_marts.with_firmware_release(
        device_marts.crash_counts(_valid(spark, sf), views.all_local_days(spark, sf)), views.firmware_releases(spark, sf))


def crash_counts_by_event_time(spark, sf):
    return device_marts.crash_counts(_valid(spark, sf), views.all_local_days(spark, sf), "event_time")


def crash_records(spark, sf):
    return device_marts.crash_records(_valid(spark, sf), views.all_local_days(spark, sf), "event_time").select(
        "event_id", "event_local_date", "device_component_guid", "device_session_id",
        "client_firmware_version", "device_mono_time", "prev_mono_time", "prev_bt_device_state",
        "panic_user_experience_ind", "panic_product_experience_ind")


def session_crash_sets(spark, sf):
    return device_marts.session_crash_sets(_valid(spark, sf), views.all_local_days(spark, sf), "event_time")


def connectivity_duration(spark, sf):
    return device_marts.connectivity_duration(_valid(spark, sf), views.all_local_days(spark, sf), bucket_ms=10)


def report_crash_rate(spark, sf):
    return device_reports.crash_rate(device_marts.crash_counts(_valid(spark, sf), views.all_local_days(spark, sf)))


def report_crash_count_daily(spark, sf):
    return device_reports.crash_count_daily(
        device_marts.crash_counts(_valid(spark, sf), views.all_local_days(spark, sf), "event_time"))


def report_connectivity_rate_daily(spark, sf):
    return device_reports.connectivity_rate_daily(session_sets_daily(spark, sf))


def report_ota_rate(spark, sf):
    updates = views.device_subject(spark, sf, "ota_status").where(views.all_local_days(spark, sf).holds("event_local_date"))
    return device_reports.ota_rate(updates)


# --- records ----------------------------------------------------------------------------
def _judged(spark, sf, stream):
    if stream == "app":
        return contracts.validate_records(records.app_lines(spark, sf), contracts.APP)
    return contracts.validate_records(records.device_lines(spark, sf), contracts.DEVICE)


def _verdict(spark, sf, stream):
    complaints = F.when(F.col("error_code") == "SCHEMA_VALIDATION_ERROR",
                        F.size("errors")).otherwise(0).cast("long")
    return _judged(spark, sf, stream).select(
        "event_id", "error_code", complaints.alias("error_count"))


def app_records_flat(spark, sf):
    return flatten.flatten_app(contracts.valid_records(_judged(spark, sf, "app")), keep=("dt",))


def device_records_flat(spark, sf):
    return flatten.flatten_device(
        contracts.valid_records(_judged(spark, sf, "device")), records.registry(spark))


def app_flat_contracts(spark, sf):
    """Rows of every flat kind and how many of them meet its contract."""
    flat = app_records_flat(spark, sf)
    kinds = {"session": "device_session_record", "pairing": "device_pairing_record",
             "auth": "user_auth_record"}
    parts = [
        contracts.check_flat_contract(flat.where(F.col("nova_event_name") == record), kind)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.size("errors") == 0).alias("clean_rows"))
        .withColumn("kind", F.lit(kind))
        for kind, record in kinds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def device_events_decoded(spark, sf):
    raw = device_events.parse_raw(records.raw_device_lines(spark, sf))
    return device_events.enrich(device_events.decode_payload(
        device_events.flatten_raw(raw), records.registry(spark)))


def device_events_invalid(spark, sf):
    return device_events_decoded(spark, sf).where(~F.col("decode_success")).select(
        "event_name", "event_timestamp_ms", "schema_id", "raw_payload", "event_local_timestamp",
        "event_local_date", "device_component_guid", "decode_success", "payload_json")


def device_subject_counts(spark, sf):
    rows = device_events_decoded(spark, sf)
    return rows.where(F.col("decode_success") & F.col("event_name").isin(*SUBJECT_TABLES)).groupBy(
        "event_name").agg(F.count(F.lit(1)).alias("n_rows"))


RECORDS: dict[str, Query] = {
    "app_records_verdict": lambda s, d: _verdict(s, d, "app"),
    "app_records_counts": lambda s, d: contracts.batch_counts(_judged(s, d, "app")),
    "app_records_flat": app_records_flat,
    "app_flat_contracts": app_flat_contracts,
    "device_records_verdict": lambda s, d: _verdict(s, d, "device"),
    "device_records_counts": lambda s, d: contracts.batch_counts(_judged(s, d, "device")),
    "device_records_flat": device_records_flat,
    "device_events_decoded": device_events_decoded,
    "device_events_invalid": device_events_invalid,
    "device_subject_counts": device_subject_counts,
}
# --- dimensions and checks --------------------------------------------------------------
def dim_date(spark, sf):
    """Calendar around the last day of the given events."""
    last = views.base_events(spark, sf).agg(F.max(F.to_date("ts")).alias("ds"))
    return dimensions.calendar(last)


def dim_device_model(spark, sf):
    return dimensions.device_models(views.app_ods(spark, sf), views.all_days(spark, sf).hi)


def dim_product_lifecycle(spark, sf):
    return dimensions.with_lifecycle(views.products(spark, sf), views.all_days(spark, sf).hi)


def dim_product_active(spark, sf):
    return dimensions.active_products(views.products(spark, sf))


def check_non_null(spark, sf):
    return quality.check_not_null(
        _devices_v1(spark, sf), "dwd_product_active_daily", ["product_id", "product_name", "client_variant"]
    ).unionByName(quality.check_export_rows(
        _users_v1(spark, sf).withColumn("business_date", F.col("partition_date")),
        "dwd_user_active_daily", views.all_days(spark, sf).hi))


def check_schema_tests(spark, sf):
    events, products = views.app_ods(spark, sf), views.products(spark, sf)
    return (
        quality.check_unique(views.staging(spark, sf), "staging", ["event_guid"])
        .unionByName(quality.check_accepted_values(events, "events", "client_name", CLIENT_NAMES))
        .unionByName(quality.check_relationship(events, "events", "product_id", products, "product_id"))
        .unionByName(quality.check_not_null(events, "events", ["event_guid", "client_variant"])))


DIMENSIONS_AND_CHECKS: dict[str, Query] = {
    "dim_date": dim_date,
    "dim_device_model": dim_device_model,
    "dim_product_lifecycle": dim_product_lifecycle,
    "dim_product_active": dim_product_active,
    "check_non_zero": lambda s, d: quality.check_non_zero(
        views.app_ods(s, d), "events", views.all_days(s, d).hi),
    "check_day_ratio": lambda s, d: quality.check_day_ratio(
        views.app_ods(s, d), "events", views.all_days(s, d).hi),
    "check_report_rows": lambda s, d: quality.check_report_rows(
        _devices_v1(s, d), "dwd_product_active_daily", "2024-02-01"),
    "check_non_null": check_non_null,
    "check_schema_tests": check_schema_tests,
}
APP: dict[str, Query] = {
    "app_events_load": app_events_load,
    "app_events_first_copy": app_events_first_copy,
    "app_events_union": app_events_union,
    "user_active_daily_v1": _users_v1,
    "user_active_daily_v2": _users_v2,
    "product_active_daily_v1": _devices_v1,
    "product_active_daily_v2": _devices_v2,
    "user_active_daily_v1_all_days": _users_v1,
    "user_active_daily_v2_all_days": _users_v2,
    "product_active_daily_v1_all_days": _devices_v1,
    "product_active_daily_v2_all_days": _devices_v2,
    "user_product_pairings": _pairings_v1,
    "user_product_rolling": user_product_rolling,
    "retention_curve": retention_curve,
    "retention_d0_d7": retention_d0_d7,
    "daily_active_users_v1": daily_active_users_v1,
    "daily_active_users_v2": daily_active_users_v2,
}
DEVICE: dict[str, Query] = {f.__name__: f for f in (
    session_reboot_count, session_shutdown_count, session_sets_daily, crash_counts_daily,
    crash_counts_by_event_time, crash_records, session_crash_sets, connectivity_duration,
    report_crash_rate, report_crash_count_daily, report_connectivity_rate_daily, report_ota_rate)}


def queries() -> dict[str, Query]:
    def in_utc(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_defaults(spark)
            return neutral(query(spark, sf_dir))
        return run

    return {name: in_utc(q) for name, q in {**APP, **DEVICE, **RECORDS, **DIMENSIONS_AND_CHECKS, **table_jobs.QUERIES}.items()}
