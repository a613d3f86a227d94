"""The given tables seen as telemetry: every view is derived from them by Spark, so its size grows
with theirs. ``workloads.oracle`` states the same views in SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.predicates import is_dev_build, platform_of
from pulsegrid.functions.times import local_date, local_timestamp
from pulsegrid.operators import landing
from pulsegrid.operators.date_windows import DateWindow

# event_type of the given table -> event table of the registry
EVENT_TABLES = {
    "signup": "nova_session_start",
    "view": "nova_bt_connect_result",
    "click": "nova_login_successful",
    "purchase": "nova_onboarding_last_flow",
    "error": "nova_bt_error_result",
}
# event_type -> device event
DEVICE_EVENTS = {
    "error": "reboot_info",
    "view": "shutdown_reason",
    "purchase": "ota_status",
    "click": "bt_connection",
    "signup": "heartbeat",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mapped(pairs: dict[str, str]):
    flat = [F.lit(x) for item in pairs.items() for x in item]
    return F.try_element_at(F.create_map(*flat), F.col("event_type"))


def base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number in ``props`` as ``k``."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("uid"),
        "event_type", "value",
        F.regexp_extract("props", r"(\d+)", 1).cast("int").alias("k"),
    )


def all_days(spark: SparkSession, sf_dir: str) -> DateWindow:
    """First to last day of the given events; empty if there are none."""
    return _span(table(spark, sf_dir, "events").select(F.to_date(F.col("ts").cast("timestamp")).alias("d")))


def all_local_days(spark: SparkSession, sf_dir: str) -> DateWindow:
    """First to last local date of the device events."""
    return _span(device_events(spark, sf_dir).select(F.col("event_local_date").alias("d")))


def _span(days: DataFrame) -> DateWindow:
    first, last = days.agg(F.min("d"), F.max("d")).first()
    return DateWindow(first, last) if first else DateWindow(dt.date(1970, 1, 2), dt.date(1970, 1, 1))


def flat_events(spark: SparkSession, sf_dir: str, text_times: bool = False) -> DataFrame:
    """The flat landing table of app events: a text ``dt``, sparse payload columns, and times as
    text if ``text_times``."""
    rows = base_events(spark, sf_dir).withColumn("n", F.expr("(uid + k % 2) % 25 + 1"))
    product = "CASE WHEN event_type <> 'signup' THEN {} END"
    only = "CASE WHEN event_type = '{}' THEN {} END"
    return rows.selectExpr(
        "'nova-telemetry-record' AS event_name",
        "2 AS event_schema_version",
        "CASE WHEN event_id % 41 = 0 THEN '  ' ELSE concat('e-', event_id) END AS event_guid",
        ("date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")" if text_times else "ts")
        + " AS event_timestamp",
        "CASE WHEN uid % 29 = 0 THEN 'nova_test_app' WHEN uid % 31 = 0 THEN 'app_internal' "
        "WHEN uid % 37 = 0 THEN NULL WHEN uid % 3 = 0 THEN 'nova-ios' "
        "WHEN uid % 3 = 1 THEN 'nova-android' ELSE 'nova-ohos' END AS client_name",
        "CASE WHEN uid % 17 = 0 THEN 'dev' WHEN uid % 3 = 0 THEN 'prod' "
        "WHEN uid % 3 = 1 THEN 'staging' END AS client_variant",
        "concat('3.', uid % 4, '.0') AS client_version",
        "concat('2024.', uid % 7) AS client_build",
        "CASE WHEN uid % 43 = 0 THEN '' ELSE concat(uid, '-', k % 20) END AS client_id",
        "CAST(k * 1000 AS BIGINT) AS client_mono_time",
        "k % 2 = 0 AS client_is_background",
        "concat(uid, '-', unix_date(CAST(ts AS DATE)), '-', hour(ts) div 6) AS client_session_id",
        only.format("signup", "element_at(array('iPhone 14', 'iPad Air', 'samsung S23', 'Pixel 8', "
                              "'OnePlus 12', 'Mate 60'), CAST(uid % 6 + 1 AS INT))") + " AS nova_device_os",
        only.format("signup", "concat(k % 20, '.', k % 5)") + " AS nova_device_os_version",
        only.format("signup", "'2.0.0'") + " AS nova_sdk_version",
        "CASE WHEN event_type = 'view' THEN 'connected' WHEN event_type = 'error' THEN 'failed' END "
        "AS nova_oob_bt_connect",
        only.format("error", "concat('code ', k)") + " AS nova_error_details",
        only.format("click", "'google'") + " AS nova_identity_provider",
        only.format("click", "CAST(uid AS STRING)") + " AS nova_user_id",
        only.format("purchase", "concat('screen ', k % 5)") + " AS nova_screen_name",
        product.format("concat('Brand#', n)") + " AS product_name",
        product.format("concat('p', n)") + " AS product_id",
        product.format("CAST(n % 20 AS INT)") + " AS product_variant",
        product.format("CASE WHEN uid % 23 = 0 THEN 'short' ELSE "
                       "concat('00000000-0000-4000-8000-', lpad(n, 12, '0')) END") + " AS product_guid",
        product.format("CASE WHEN k = 50 THEN ' ' ELSE concat('1.', k % 4, '.0') END")
        + " AS product_firmware_version",
        "CAST(CAST(ts AS DATE) AS STRING) AS dt",
        "ts + INTERVAL 5 MINUTES AS received_at",
        "event_id", "event_type",
    )


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded staging rows; every seventh event arrives a second time later."""
    flat = flat_events(spark, sf_dir)
    again = flat.where("event_id % 7 = 0").withColumn(
        "received_at", F.expr("received_at + INTERVAL 1 HOUR"))
    return landing.load_app_events(
        flat.unionByName(again), all_days(spark, sf_dir), F.col("received_at"))


def app_ods(spark: SparkSession, sf_dir: str, window: DateWindow | None = None) -> DataFrame:
    """First-generation event table."""
    window = window or all_days(spark, sf_dir)
    return landing.load_app_events(flat_events(spark, sf_dir), window, F.col("received_at"))


def app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second-generation event table, in one scan."""
    ts = F.col("event_timestamp").cast("timestamp")
    with_product = F.col("event_type").isin("view", "purchase", "error")
    return flat_events(spark, sf_dir).select(
        _mapped(EVENT_TABLES).alias("event_name"), "event_guid",
        ts.alias("event_timestamp"), local_timestamp(ts).alias("event_local_timestamp"),
        local_date(ts).alias("event_local_date"),
        "client_id", "client_name", "client_variant", "client_version", "client_build",
        platform_of("client_name").alias("client_platform"),
        F.when(with_product, F.col("product_guid")).alias("product_guid"),
        F.when(with_product, F.col("product_firmware_version")).alias("firmware_version"),
        F.col("dt").cast("date").alias("partition_date"),
        "client_mono_time", F.col("client_session_id").alias("session_id"),
        is_dev_build("client_variant").alias("is_test_event"),
    )


def event_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One physical event table of the second generation."""
    kinds = [t for t, n in EVENT_TABLES.items() if n == name]
    flat = flat_events(spark, sf_dir)
    return flat.where(F.col("event_type") == kinds[0]) if kinds else flat.where(F.lit(False))


def legacy_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The previous generation's log, from the given events with a large value."""
    return base_events(spark, sf_dir).where("value > 100").selectExpr(
        "concat('old_', event_type) AS event_type_name",
        "CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('v4-', event_id) END AS event_uuid",
        "ts AS server_received_at", "ts + INTERVAL 7 HOURS AS client_local_time",
        "CAST(ts + INTERVAL 7 HOURS AS DATE) AS client_local_date",
        "CAST(uid AS STRING) AS app_user_id", "'nova-ios' AS app_name", "'prod' AS app_variant",
        "'2.9.0' AS app_version", "'b1' AS app_build", "'iOS' AS device_platform",
        "concat('k=', k) AS raw_payload_json", "CAST(ts AS DATE) AS log_date",
        "event_id AS row_id", "CASE WHEN k % 3 = 0 THEN NULL ELSE k % 3 = 1 END AS is_internal",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product per brand of the given parts; brand 25 is left out, so that some events have an
    unknown product."""
    number = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    return (
        table(spark, sf_dir, "part").groupBy("p_brand")
        .agg(F.min("p_type").alias("product_category"), F.max("p_size").alias("size"))
        .withColumn("n", number).where("n <> 25")
        .selectExpr(
            "concat('p', n) AS product_id",
            "concat('00000000-0000-4000-8000-', lpad(n, 12, '0')) AS product_guid",
            "p_brand AS product_name", "product_category", "concat('line ', n % 3) AS product_line",
            "date_add(DATE'2020-01-15', n * 40 + size) AS launch_date", "n % 6 <> 0 AS is_active",
        )
    )


def device_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded device events, as the device event table holds them."""
    ts = F.timestamp_seconds(F.unix_seconds("ts"))
    return (
        base_events(spark, sf_dir).withColumn("n", F.expr("(uid + k % 2) % 25 + 1"))
        .withColumn("event_name", _mapped(DEVICE_EVENTS))
        .withColumn("event_local_date", F.to_date(local_timestamp(ts)))
        .selectExpr(
            "event_name", "unix_millis(ts) AS event_timestamp_ms", "event_local_date",
            "CASE WHEN uid % 3 = 0 THEN 'prod' WHEN uid % 3 = 1 THEN 'staging' END AS client_variant",
            "concat('1.', k % 4, '.0-rc') AS client_firmware_version",
            "concat('1.', k % 4, '.0') AS client_version_core",
            "concat('d-', uid) AS device_component_guid",
            "CASE WHEN k % 11 = 0 THEN NULL ELSE concat(uid, '-', unix_date(CAST(ts AS DATE)), '-', "
            "hour(ts) div 6) END AS device_session_id",
            "CAST(k AS BIGINT) AS device_mono_time",
            "concat('Brand#', n) AS product_sku", "concat('m', n % 5) AS product_model_name",
            "CASE WHEN event_type = 'click' THEN 'connected' "
            "WHEN event_type = 'error' THEN 'disconnected' END AS bt_device_state",
            "CASE WHEN event_type = 'purchase' THEN concat('{\"status\": \"', "
            "CASE WHEN k % 3 = 0 THEN 'failed' ELSE 'success' END, '\"}') ELSE '{}' END AS payload_json",
            "event_id % 19 <> 0 AS decode_success", "event_id",
        )
    )


def device_subject(spark: SparkSession, sf_dir: str, event_name: str) -> DataFrame:
    return device_events(spark, sf_dir).where(
        (F.col("event_name") == event_name) & F.col("decode_success"))


def firmware_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release dates of the firmware versions seen in the events; version 1.3 has none."""
    return (
        device_events(spark, sf_dir).where("client_version_core <> '1.3.0'")
        .groupBy(F.col("client_firmware_version").alias("firmware_version"))
        .agg(F.min("event_local_date").alias("release_date"))
        .withColumn("firmware_version_format", F.concat(F.lit("v"), F.col("firmware_version")))
        .withColumn("release_channel", F.lit("stable"))
    )
