"""Nested JSON records, valid and broken ones, made from the given events.

The text templates are SQL that Spark and DuckDB both read; ``iso`` is the event time as text.
Every 53rd kind of row is broken in its own way. Firmware payloads are protobuf bytes put together
from the event by SQL as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workloads import views


# texts that ids are cut from, computed once per row
SEEDS = {
    "m_client": "md5(concat('c', CAST(uid AS STRING)))",
    "m_product": "md5(concat('p', CAST(n AS STRING)))",
    "m_event": "md5(concat('e', CAST(event_id AS STRING)))",
    "m_device": "md5(concat('d', CAST(uid AS STRING)))",
}
SEED_COLUMNS = ", ".join(f"{sql} AS {name}" for name, sql in SEEDS.items())


def _uuid(m: str) -> str:
    return (f"concat(substr({m}, 1, 8), '-', substr({m}, 9, 4), '-', substr({m}, 13, 4), '-', "
            f"substr({m}, 17, 4), '-', substr({m}, 21, 12))")


_CLIENT = f"""concat(
  '{{"name":"', CASE uid % 3 WHEN 0 THEN 'nova-ios' WHEN 1 THEN 'nova-android' ELSE 'nova-ohos' END,
  '","variant":"', CASE uid % 3 WHEN 0 THEN 'prod' WHEN 1 THEN 'staging' ELSE 'dev' END,
  '","version":"', CASE WHEN bad = 3 THEN 'not_a_semver' ELSE concat('3.', CAST(uid % 4 AS STRING), '.0') END,
  '","build":', CASE WHEN bad = 8 THEN '7' ELSE '"2024.01.15"' END,
  ',"client_id":"', CASE WHEN bad = 2 THEN 'nobody' ELSE {_uuid("m_client")} END,
  '","mono_time":', CAST(k * 1000 AS STRING),
  ',"is_background":', CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END,
  ',"session_id":', CASE WHEN bad = 9 THEN '0' WHEN bad = 14 THEN '"5"' ELSE CAST(uid + 1 AS STRING) END,
  ',"time_since_last_event":', CASE WHEN bad = 15 THEN '"long"' WHEN k % 4 = 0 THEN 'null' ELSE CAST(k AS STRING) END,
  '}}')"""

_PRODUCT = f"""concat(
  '{{"name":"Brand#', CAST(n AS STRING), '","product_id":"',
  CASE WHEN bad = 16 THEN '1A2B' ELSE concat('0x00', lpad(CAST(n AS STRING), 2, '0')) END,
  '","variant":', CASE WHEN bad = 12 THEN '20' ELSE CAST(n % 20 AS STRING) END,
  CASE WHEN bad = 17 THEN '' ELSE concat(',"guid":"', {_uuid("m_product")}, '"') END,
  ',"firmware_version":"1.', CAST(k % 4 AS STRING), '.0-rc.1+b7"}}')"""

_PAYLOAD = f"""CASE
  WHEN event_type IN ('signup', 'error') THEN concat(
    '{{"event_name":"device_session_record","sdk_version":"', CASE WHEN bad = 18 THEN '2' ELSE '2.0.0' END,
    '","device_os":"', CASE WHEN k % 10 = 0 THEN 'Windows' ELSE 'iOS' END,
    '","device_os_version":', CASE WHEN bad = 19 THEN '17' ELSE '"17.4.1"' END,
    ',"device_brand":"Apple","device_model":"iPhone15,2"}}')
  WHEN event_type IN ('view', 'purchase') THEN concat(
    '{{"event_name":"device_pairing_record","oob_bt_connect":"',
    CASE WHEN bad = 5 THEN 'pending' ELSE 'connected' END, '","product_ctx":', {_PRODUCT}, '}}')
  ELSE concat(
    '{{"event_name":"', CASE WHEN bad = 20 THEN 'login' ELSE 'user_auth_record' END,
    '","identity_provider":"google","user_id":"',
    CASE WHEN bad = 6 THEN 'tooshort' ELSE concat(md5(CAST(uid AS STRING)), md5(CAST(uid + 1 AS STRING))) END,
    '","user_metadata":', CASE WHEN bad = 21 THEN '"text"' WHEN k % 3 = 0 THEN 'null'
      ELSE concat('{{"plan":"premium","k":', CAST(k AS STRING), '}}') END, '}}')
  END"""


def _envelope(name: str, context: str, body: str) -> str:
    return f"""CASE WHEN bad = 10 THEN '[1,2]' WHEN bad = 13 THEN '{{"event_name":"cut' ELSE concat(
  '{{"event_name":"', CASE WHEN bad = 1 THEN 'other' ELSE '{name}' END,
  '","event_schema_version":2',
  CASE WHEN bad = 11 THEN '' ELSE concat(',"event_guid":"', {_uuid("m_event")}, '"') END,
  ',"event_timestamp":"', iso, CASE WHEN bad = 7 THEN '' WHEN k % 5 = 0 THEN '+08:00' ELSE 'Z' END,
  '","client_ctx":', {_CLIENT},
  CASE WHEN bad = 4 THEN '' ELSE concat(',"{context}":', {body}) END, '}}') END"""


APP_TEXT = _envelope("nova-telemetry-record", "nova_ctx", _PAYLOAD)

# message: bt_device_state = 1 (text), status = 2 (text), uptime = 3 (integer below 128)
STATE = "CASE event_type WHEN 'click' THEN 'connected' WHEN 'error' THEN 'disconnected' END"
STATUS = "CASE WHEN event_type = 'purchase' THEN CASE WHEN k % 3 = 0 THEN 'failed' ELSE 'success' END END"
_SCHEMA_NAME = """CASE event_type WHEN 'error' THEN 'reboot_info' WHEN 'view' THEN 'shutdown_reason'
  WHEN 'purchase' THEN 'ota_status' WHEN 'click' THEN 'bt_connection' ELSE 'heartbeat' END"""
SCHEMA_ID = f"""concat({_SCHEMA_NAME}, CASE WHEN k = 13 THEN '-0000000' ELSE '-a1b2c3d' END)"""

_DEVICE_BODY = f"""concat(
  '{{"schema_id":"', CASE WHEN bad = 22 THEN 'reboot_info-v3' ELSE {SCHEMA_ID} END,
  '","mono_time":', CAST(k AS STRING), ',"session_id":', CAST(uid % 9 + 1 AS STRING),
  ',"firmware_platform_id":', CASE WHEN bad = 23 THEN '1' ELSE '"arm-v1"' END,
  ',"is_signed":true,"is_encrypted":', CASE WHEN bad = 24 THEN '"no"' ELSE 'false' END,
  ',"component_guid":', CASE WHEN k % 2 = 0 THEN 'null' WHEN bad = 25 THEN '"g"'
    ELSE concat('"', {_uuid("m_device")}, '"') END,
  ',"product_ctx":', {_PRODUCT},
  ',"payload":"', CASE WHEN bad = 26 THEN '!!' WHEN bad = 27 THEN '' WHEN bad = 28 THEN 'CAE' ELSE payload64 END,
  '"}}')"""

DEVICE_TEXT = _envelope("sentinel-telemetry-record", "sentinel_ctx", _DEVICE_BODY)

RAW_DEVICE_TEXT = f"""concat(
  '{{"event_name":"', {_SCHEMA_NAME}, '","event_timestamp_ms":', CAST(ms AS STRING),
  ',"schema_id":"', {SCHEMA_ID}, '","raw_payload":"',
  CASE WHEN event_id % 19 = 0 THEN '!!' ELSE payload64 END,
  '","client_ctx":{{"variant":"prod","firmware_version":"1.', CAST(k % 4 AS STRING),
  '.0-rc","locale":"en","platform":"arm"}},"device_ctx":{{"component_guid":"d-', CAST(uid AS STRING),
  '","session_id":"s-', CAST(k % 7 AS STRING), '","mono_time":', CAST(k AS STRING),
  '}},"product_ctx":{{"sku":"Brand#', CAST(n AS STRING), '","model_name":"m1","hw_revision":"r1"}}}}')"""


def _text_field(tag: str, value: str) -> str:
    """Wire bytes of a short text field, nothing for null."""
    return (f"coalesce(concat(unhex('{tag}'), unhex(lpad(hex(length({value})), 2, '0')), "
            f"encode({value}, 'UTF-8')), unhex(''))")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = (f"base64(concat({_text_field('0A', STATE)}, {_text_field('12', STATUS)}, "
               f"unhex('18'), unhex(lpad(hex(k), 2, '0'))))")
    rows = views.base_events(spark, sf_dir).selectExpr("*", "(uid + k % 2) % 25 + 1 AS n")
    return rows.selectExpr(
        "*", *[f"{sql} AS {name}" for name, sql in SEEDS.items()], "event_id % 53 AS bad", "unix_millis(ts) AS ms",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") AS iso", f"{payload} AS payload64")


def app_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(
        "event_id", "date_format(ts, 'yyyy-MM-dd') AS dt", f"{APP_TEXT} AS value")


def device_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr("event_id", f"{DEVICE_TEXT} AS value")


def raw_device_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).selectExpr(f"{RAW_DEVICE_TEXT} AS value")


def registry(spark: SparkSession) -> DataFrame:
    """Message types of the payloads above: schema_id, message_name, descriptor."""
    from google.protobuf import descriptor_pb2

    file = descriptor_pb2.FileDescriptorProto(
        name="telemetry.proto", package="telemetry", syntax="proto2")
    message = file.message_type.add(name="Report")
    kinds = descriptor_pb2.FieldDescriptorProto
    for number, (name, kind) in enumerate((
            ("bt_device_state", kinds.TYPE_STRING), ("status", kinds.TYPE_STRING),
            ("uptime", kinds.TYPE_INT64)), 1):
        message.field.add(name=name, number=number, type=kind, label=kinds.LABEL_OPTIONAL)
    descriptor = descriptor_pb2.FileDescriptorSet(file=[file]).SerializeToString()
    rows = [(f"{name}-a1b2c3d", "telemetry.Report", bytearray(descriptor))
            for name in sorted(set(views.DEVICE_EVENTS.values()))]
    return spark.createDataFrame(rows, "schema_id string, message_name string, descriptor binary")
