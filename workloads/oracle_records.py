"""SQL of the record-contract and device-decoding queries for DuckDB."""

from __future__ import annotations

from workloads import records as R

_EVENTS = r"""
lines AS (
  SELECT *, """ + R.SEED_COLUMNS + r""", event_id % 53 AS bad, epoch_us(ts) // 1000 AS ms,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso,
    base64(unhex(
      coalesce('0A' || printf('%02X', length(state)) || hex(state), '')
      || coalesce('12' || printf('%02X', length(status)) || hex(status), '')
      || '18' || printf('%02X', k))) AS payload64,
    '{' || coalesce('"bt_device_state": "' || state || '", ', '')
      || coalesce('"status": "' || status || '", ', '') || '"uptime": "' || k || '"}' AS message
  FROM (
    SELECT *, (uid + k % 2) % 25 + 1 AS n, """ + R.STATE + """ AS state, """ + R.STATUS + r""" AS status
    FROM (SELECT event_id, ts, user_id AS uid, event_type,
                 CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k FROM events))
)"""

_SEMVER = (r"^(0|[1-9]\d*)\.(0|[1-9]\d*)\.(0|[1-9]\d*)(?:-((?:0|[1-9]\d*|\d*[a-zA-Z-][0-9a-zA-Z-]*)"
           r"(?:\.(?:0|[1-9]\d*|\d*[a-zA-Z-][0-9a-zA-Z-]*))*))?(?:\+([0-9a-zA-Z-]+(?:\.[0-9a-zA-Z-]+)*))?$")
_UUID = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"


def text(path: str) -> str:
    return f"json_extract_string(v, '$.{path}')"


def kind(path: str) -> str:
    return f"json_type(v, '$.{path}')"


def whole(path: str) -> str:
    return f"({kind(path)} IN ('UBIGINT', 'BIGINT'))"


def number(path: str) -> str:
    return f"TRY_CAST({text(path)} AS BIGINT)"


def like(path: str, pattern: str) -> str:
    return f"({kind(path)} = 'VARCHAR' AND regexp_full_match({text(path)}, '{pattern.strip('^$')}'))"


def is_text(path: str) -> str:
    return f"({kind(path)} = 'VARCHAR')"


def among(path: str, values: str) -> str:
    return f"({text(path)} IN ({', '.join(repr(x) for x in values.split())}))"


def null_or(path: str, ok: str) -> str:
    return f"({kind(path)} IS NULL OR {kind(path)} = 'NULL' OR {ok})"


def missing(path: str) -> str:
    return f"coalesce({kind(path)} <> 'OBJECT', TRUE)"


def errors(rules: list[str]) -> str:
    return " + ".join(f"(CASE WHEN coalesce({r}, FALSE) THEN 0 ELSE 1 END)" for r in rules)


def context(path: str, count: str) -> str:
    return f"(CASE WHEN {missing(path)} THEN 1 ELSE {count} END)"


def _envelope(name: str) -> str:
    return errors([
        f"{text('event_name')} = '{name}'", f"{text('event_schema_version')} = '2'",
        like("event_guid", _UUID),
        f"regexp_full_match({text('event_timestamp')}, "
        r"'\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}(Z|\+08:00)')"])


def _client() -> str:
    c = "client_ctx"
    return context(c, errors([
        among(f"{c}.name", "nova-ios nova-android nova-ohos"),
        among(f"{c}.variant", "dev staging prod"), like(f"{c}.version", _SEMVER),
        is_text(f"{c}.build"), like(f"{c}.client_id", _UUID), whole(f"{c}.mono_time"),
        f"{kind(f'{c}.is_background')} = 'BOOLEAN'",
        f"{whole(f'{c}.session_id')} AND {number(f'{c}.session_id')} > 0",
        null_or(f"{c}.time_since_last_event", whole(f"{c}.time_since_last_event"))]))


def _product(p: str) -> str:
    return context(p, errors([
        is_text(f"{p}.name"), like(f"{p}.product_id", "^0x[0-9A-Fa-f]{4}$"),
        f"{whole(f'{p}.variant')} AND {number(f'{p}.variant')} BETWEEN 0 AND 19",
        like(f"{p}.guid", _UUID), like(f"{p}.firmware_version", _SEMVER)]))


def _payload() -> str:
    n = "nova_ctx"
    session = errors([
        like(f"{n}.sdk_version", _SEMVER), among(f"{n}.device_os", "Android iOS HarmonyOS"),
        like(f"{n}.device_os_version", r"^\d+(\.\d+)*$"), is_text(f"{n}.device_brand"),
        is_text(f"{n}.device_model")])
    pairing = f"{errors([among(f'{n}.oob_bt_connect', 'connected')])} + {_product(f'{n}.product_ctx')}"
    auth = errors([
        among(f"{n}.identity_provider", "apple_id anonymous wechat google"),
        like(f"{n}.user_id", "^[0-9a-f]{64}$"),
        null_or(f"{n}.user_metadata", f"{kind(f'{n}.user_metadata')} = 'OBJECT'")])
    return context(n, f"""(CASE {text(f'{n}.event_name')}
      WHEN 'device_session_record' THEN {session} WHEN 'device_pairing_record' THEN {pairing}
      WHEN 'user_auth_record' THEN {auth} ELSE 1 END)""")


def _device() -> str:
    s = "sentinel_ctx"
    p = text(f"{s}.payload")
    return context(s, errors([
        like(f"{s}.schema_id", "^[a-z_]+-[0-9a-f]{7}$"), whole(f"{s}.mono_time"),
        f"{whole(f'{s}.session_id')} AND {number(f'{s}.session_id')} > 0",
        is_text(f"{s}.firmware_platform_id"), f"{kind(f'{s}.is_signed')} = 'BOOLEAN'",
        f"{kind(f'{s}.is_encrypted')} = 'BOOLEAN'",
        null_or(f"{s}.component_guid", like(f"{s}.component_guid", _UUID)),
        f"CASE WHEN {p} <> '' AND regexp_full_match({p}, "
        "'([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?') "
        f"THEN octet_length(from_base64({p})) <= 16384 END"]) + f" + {_product(f'{s}.product_ctx')}")


def _judged(template: str, count: str) -> str:
    return f"""WITH {_EVENTS.strip()},
made AS MATERIALIZED (
  SELECT event_id, CAST(ts AS DATE) AS day, k, message, {template} AS value FROM lines
), parsed AS MATERIALIZED (
  SELECT event_id, day, k, message,
    CASE WHEN json_valid(value) AND value LIKE '{{%' THEN CAST(value AS JSON) END AS v FROM made
), counted AS MATERIALIZED (
  SELECT *, {count} AS n_errors FROM parsed
), judged AS (
  SELECT event_id, day, k, message, v, n_errors,
    CASE WHEN v IS NULL THEN 'INVALID_TYPE' WHEN n_errors > 0 THEN 'SCHEMA_VALIDATION_ERROR' END
      AS error_code
  FROM counted
)
"""


_VERDICT = """SELECT event_id, error_code,
  CASE WHEN error_code = 'SCHEMA_VALIDATION_ERROR' THEN n_errors ELSE 0 END AS error_count FROM judged"""
_COUNTS = """SELECT count(*) AS received, count(*) FILTER (error_code IS NULL) AS valid,
  count(error_code) AS invalid, count(*) FILTER (error_code = 'INVALID_TYPE') AS invalid_type,
  count(*) FILTER (error_code = 'SCHEMA_VALIDATION_ERROR') AS invalid_schema FROM judged"""

_TIME = ("CAST(CAST(" + text("event_timestamp") + " AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) "
         "AS event_timestamp")
_HEAD = ", ".join([
    f"{text('event_name')} AS event_name",
    f"CAST({text('event_schema_version')} AS INTEGER) AS event_schema_version",
    f"{text('event_guid')} AS event_guid", _TIME,
    *[f"{text(f'client_ctx.{f}')} AS client_{f}" for f in ("name", "variant", "version", "build")],
    f"{text('client_ctx.client_id')} AS client_id",
    f"{number('client_ctx.mono_time')} AS client_mono_time",
    f"CAST({text('client_ctx.is_background')} AS BOOLEAN) AS client_is_background",
    f"CAST({number('client_ctx.session_id')} AS INTEGER) AS client_session_id",
    f"{number('client_ctx.time_since_last_event')} AS client_time_since_last_event"])


def _product_columns(path: str) -> str:
    return ", ".join([
        f"{text(f'{path}.name')} AS product_name", f"{text(f'{path}.product_id')} AS product_id",
        f"CAST({number(f'{path}.variant')} AS INTEGER) AS product_variant",
        f"{text(f'{path}.guid')} AS product_guid",
        f"{text(f'{path}.firmware_version')} AS product_firmware_version"])


def _flat_app() -> str:
    fields = ("event_name sdk_version device_os device_os_version device_brand device_model "
              "oob_bt_connect identity_provider user_id").split()
    return (f"SELECT strftime(day, '%Y-%m-%d') AS dt, {_HEAD}, "
            + ", ".join(f"{text(f'nova_ctx.{f}')} AS nova_{f}" for f in fields)
            + f", {_product_columns('nova_ctx.product_ctx')}, "
            + f"CASE WHEN {kind('nova_ctx.user_metadata')} = 'OBJECT' "
            + "THEN '{\"k\":' || k || ',\"plan\":\"premium\"}' END AS nova_user_metadata "
            + "FROM judged WHERE error_code IS NULL")


def _flat_device() -> str:
    s = "sentinel_ctx"
    return (f"SELECT {_HEAD}, {text(f'{s}.schema_id')} AS sentinel_schema_id, "
            f"{number(f'{s}.mono_time')} AS sentinel_mono_time, "
            f"CAST({number(f'{s}.session_id')} AS INTEGER) AS sentinel_session_id, "
            f"{text(f'{s}.firmware_platform_id')} AS sentinel_firmware_platform_id, "
            f"CAST({text(f'{s}.is_signed')} AS BOOLEAN) AS sentinel_is_signed, "
            f"CAST({text(f'{s}.is_encrypted')} AS BOOLEAN) AS sentinel_is_encrypted, "
            f"{text(f'{s}.component_guid')} AS sentinel_component_guid, "
            f"{_product_columns(f'{s}.product_ctx')}, {text(f'{s}.payload')} AS raw_payload, "
            f"regexp_replace({text(f'{s}.schema_id')}, '-[^-]*$', '') AS schema_name, "
            f"CASE WHEN {text(f'{s}.schema_id')} NOT LIKE '%-0000000' THEN message END AS payload "
            "FROM judged WHERE error_code IS NULL")


def _decoded() -> str:
    return f"""WITH {_EVENTS.strip()},
decoded AS (
  SELECT {R._SCHEMA_NAME} AS event_name, ms AS event_timestamp_ms, {R.SCHEMA_ID} AS schema_id,
    CASE WHEN event_id % 19 = 0 THEN '!!' ELSE payload64 END AS raw_payload,
    'prod' AS client_variant, '1.' || (k % 4) || '.0-rc' AS client_firmware_version,
    'en' AS client_locale, 'arm' AS client_platform, 'd-' || uid AS device_component_guid,
    's-' || (k % 7) AS device_session_id, CAST(k AS BIGINT) AS device_mono_time,
    CAST(NULL AS VARCHAR) AS device_schema_name_raw, 'Brand#' || n AS product_sku,
    'm1' AS product_model_name, 'r1' AS product_hw_revision,
    CASE WHEN event_id % 19 <> 0 AND k <> 13 THEN message END AS payload_json,
    event_id % 19 <> 0 AND k <> 13 AS decode_success,
    date_trunc('second', ts) + INTERVAL 8 HOUR AS event_local_timestamp,
    CAST(ts + INTERVAL 8 HOUR AS DATE) AS event_local_date,
    '1.' || (k % 4) || '.0' AS client_version_core, {R._SCHEMA_NAME} AS device_schema_name,
    CASE WHEN event_id % 19 <> 0 AND k <> 13 THEN state END AS bt_device_state
  FROM lines
)
"""


def record_sql() -> dict[str, str]:
    app = _judged(R.APP_TEXT, f"{_envelope('nova-telemetry-record')} + {_client()} + {_payload()}")
    device = _judged(R.DEVICE_TEXT,
                     f"{_envelope('sentinel-telemetry-record')} + {_client()} + {_device()}")
    per_kind = {"session": "device_session_record", "pairing": "device_pairing_record",
                "auth": "user_auth_record"}
    flat_check = app + " UNION ALL ".join(
        f"SELECT '{name}' AS kind, count(*) AS n_rows, count(*) AS clean_rows FROM judged "
        f"WHERE error_code IS NULL AND {text('nova_ctx.event_name')} = '{record}'"
        for name, record in per_kind.items())
    device_columns = """SELECT event_name, event_timestamp_ms, schema_id, raw_payload,
      event_local_timestamp, event_local_date, device_component_guid, decode_success, payload_json
      FROM decoded WHERE """
    return {
        "app_records_verdict": app + _VERDICT,
        "app_records_counts": app + _COUNTS,
        "app_records_flat": app + _flat_app(),
        "app_flat_contracts": flat_check,
        "device_records_verdict": device + _VERDICT,
        "device_records_counts": device + _COUNTS,
        "device_records_flat": device + _flat_device(),
        "device_events_decoded": _decoded() + "SELECT * FROM decoded",
        "device_events_invalid": _decoded() + device_columns + "NOT decode_success",
        "device_subject_counts": _decoded() + """SELECT event_name, count(*) AS n_rows FROM decoded
          WHERE decode_success AND event_name <> 'heartbeat' GROUP BY event_name""",
    }
