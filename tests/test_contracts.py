"""Record contracts, flattening and decoding, on records built here."""

import base64
import copy
import json

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import contracts, device_events, flatten
from workloads import records

GUID = "0b5e7d1c-3a44-4f7e-9c11-2d3c4b5a6978"
CLIENT = {"name": "nova-ios", "variant": "prod", "version": "4.1.0", "build": "b.77",
          "client_id": GUID, "mono_time": 1500, "is_background": False, "session_id": 3,
          "time_since_last_event": None}
PRODUCT = {"name": "Speaker", "product_id": "0x1A2B", "variant": 4, "guid": GUID,
           "firmware_version": "2.3.4"}
PAYLOADS = {
    "session": {"event_name": "device_session_record", "sdk_version": "1.2.3", "device_os": "iOS",
                "device_os_version": "17.4", "device_brand": "Apple", "device_model": "iPhone"},
    "pairing": {"event_name": "device_pairing_record", "oob_bt_connect": "connected",
                "product_ctx": PRODUCT},
    "auth": {"event_name": "user_auth_record", "identity_provider": "wechat",
             "user_id": "0123456789abcdef" * 4, "user_metadata": {"plan": "free", "n": [1, 2]}},
}


def app_record(kind, **changes):
    record = {"event_name": "nova-telemetry-record", "event_schema_version": 2, "event_guid": GUID,
              "event_timestamp": "2024-05-06T07:08:09+08:00", "client_ctx": CLIENT,
              "nova_ctx": PAYLOADS[kind]}
    return changed(record, changes)


def device_record(**changes):
    record = {"event_name": "sentinel-telemetry-record", "event_schema_version": 2,
              "event_guid": GUID, "event_timestamp": "2024-05-06T07:08:09Z", "client_ctx": CLIENT,
              "sentinel_ctx": {
                  "schema_id": "bt_connection-a1b2c3d", "mono_time": 9, "session_id": 1,
                  "firmware_platform_id": "arm", "is_signed": True, "is_encrypted": False,
                  "component_guid": None, "product_ctx": PRODUCT,
                  "payload": base64.b64encode(b"\x0a\x09connected\x18\x05").decode()}}
    return changed(record, changes)


MISSING = object()


def changed(record, changes):
    record = copy.deepcopy(record)
    for path, value in changes.items():
        at = record
        *parents, last = path.split("__")
        for p in parents:
            at = at[p]
        if value is MISSING:
            del at[last]
        else:
            at[last] = value
    return record


def judge(spark, contract, *items):
    texts = [(i, t if isinstance(t, str) or t is None else json.dumps(t)) for i, t in enumerate(items)]
    frame = spark.createDataFrame(texts, "i int, value string")
    return contracts.validate_records(frame, contract).orderBy("i")


def test_valid_payload_types(spark):
    got = judge(spark, contracts.APP, *[app_record(k) for k in PAYLOADS])
    assert [(r.error_code, r.errors) for r in got.collect()] == [(None, [])] * 3


NEGATIVE = [
    ("session", {"event_name": "other"}, "event_name"),
    ("session", {"event_schema_version": 3}, "event_schema_version"),
    ("session", {"client_ctx__client_id": "not-a-uuid"}, "client_ctx.client_id"),
    ("session", {"client_ctx__name": "web"}, "client_ctx.name"),
    ("session", {"client_ctx__variant": "beta"}, "client_ctx.variant"),
    ("session", {"client_ctx__session_id": 0}, "client_ctx.session_id"),
    ("session", {"client_ctx__session_id": "3"}, "client_ctx.session_id"),
    ("session", {"client_ctx__mono_time": 1.5}, "client_ctx.mono_time"),
    ("session", {"client_ctx__build": 7}, "client_ctx.build"),
    ("session", {"client_ctx__time_since_last_event": "x"}, "client_ctx.time_since_last_event"),
    ("session", {"client_ctx": MISSING}, "client_ctx"),
    ("pairing", {"nova_ctx__product_ctx__guid": "short"}, "nova_ctx.product_ctx.guid"),
    ("pairing", {"nova_ctx__product_ctx__variant": 20}, "nova_ctx.product_ctx.variant"),
    ("pairing", {"nova_ctx__product_ctx__product_id": "1A2B"}, "nova_ctx.product_ctx.product_id"),
    ("pairing", {"nova_ctx__product_ctx__firmware_version": "1.2"},
     "nova_ctx.product_ctx.firmware_version"),
    ("pairing", {"nova_ctx__product_ctx": MISSING}, "nova_ctx.product_ctx"),
    ("pairing", {"nova_ctx__oob_bt_connect": "pending"}, "nova_ctx.oob_bt_connect"),
    ("session", {"event_guid": MISSING}, "event_guid"),
    ("session", {"client_ctx__version": "one"}, "client_ctx.version"),
    ("session", {"client_ctx__version": "1.02.3"}, "client_ctx.version"),
    ("session", {"nova_ctx__sdk_version": "1.2"}, "nova_ctx.sdk_version"),
    ("session", {"nova_ctx__device_os": "Windows"}, "nova_ctx.device_os"),
    ("session", {"nova_ctx__device_os_version": "17.x"}, "nova_ctx.device_os_version"),
    ("session", {"nova_ctx__device_brand": None}, "nova_ctx.device_brand"),
    ("session", {"nova_ctx": MISSING}, "nova_ctx"),
    ("session", {"nova_ctx__event_name": "unknown_record"}, "nova_ctx.event_name"),
    ("auth", {"nova_ctx__user_id": "abc"}, "nova_ctx.user_id"),
    ("auth", {"nova_ctx__user_id": "A" * 64}, "nova_ctx.user_id"),
    ("auth", {"nova_ctx__identity_provider": "mail"}, "nova_ctx.identity_provider"),
    ("auth", {"nova_ctx__user_metadata": "text"}, "nova_ctx.user_metadata"),
    ("session", {"event_timestamp": "2024-05-06T07:08:09"}, "event_timestamp"),
    ("session", {"event_timestamp": "2024-13-06T07:08:09Z"}, "event_timestamp"),
]


def test_negative_app_records(spark):
    got = judge(spark, contracts.APP, *[app_record(k, **c) for k, c, _ in NEGATIVE]).collect()
    for row, (_, change, field) in zip(got, NEGATIVE):
        assert row.error_code == "SCHEMA_VALIDATION_ERROR", change
        assert len(row.errors) == 1 and row.errors[0].startswith(f"{field}: "), (change, row.errors)


def test_accepted_spellings(spark):
    good = [app_record("session", client_ctx__version="1.0.0-rc.1+build.5"),
            app_record("session", event_timestamp="2024-05-06T07:08:09.123456Z"),
            app_record("session", event_timestamp="2024-05-06T07:08:09-0530"),
            app_record("session", client_ctx__time_since_last_event=MISSING),
            app_record("auth", nova_ctx__user_metadata=None),
            app_record("session", client_ctx__extra="ignored")]
    assert [r.errors for r in judge(spark, contracts.APP, *good).collect()] == [[]] * len(good)


def test_not_an_object(spark):
    texts = ["[1]", '[{"event_name": 1}]', "5", '"text"', '{"event_name": "cut', "", None,
             json.dumps(app_record("session")) + " trailing"]
    got = judge(spark, contracts.APP, *texts).collect()
    assert len(got) == len(texts)
    assert {r.error_code for r in got} == {"INVALID_TYPE"}
    assert {r.error_message for r in got} == {"not a JSON object"}


DEVICE_NEGATIVE = [
    ({"sentinel_ctx__schema_id": "bt_connection-v3"}, "sentinel_ctx.schema_id"),
    ({"sentinel_ctx__schema_id": "bt_connection-a1b2c3d\n"}, "sentinel_ctx.schema_id"),
    ({"sentinel_ctx__payload": base64.b64encode(b"x" * 16385).decode()}, "sentinel_ctx.payload"),
    ({"sentinel_ctx__payload": "!!"}, "sentinel_ctx.payload"),
    ({"sentinel_ctx__payload": ""}, "sentinel_ctx.payload"),
    ({"sentinel_ctx__payload": "CAE"}, "sentinel_ctx.payload"),
    ({"sentinel_ctx__payload": "CA E"}, "sentinel_ctx.payload"),
    ({"sentinel_ctx__session_id": 0}, "sentinel_ctx.session_id"),
    ({"sentinel_ctx__product_ctx__guid": MISSING}, "sentinel_ctx.product_ctx.guid"),
    ({"sentinel_ctx__component_guid": "x"}, "sentinel_ctx.component_guid"),
    ({"sentinel_ctx__is_signed": "yes"}, "sentinel_ctx.is_signed"),
]


def test_device_records(spark):
    good = [device_record(), device_record(sentinel_ctx__component_guid=GUID),
            device_record(sentinel_ctx__payload=base64.b64encode(b"x" * 16384).decode())]
    assert [r.errors for r in judge(spark, contracts.DEVICE, *good).collect()] == [[]] * 3
    got = judge(spark, contracts.DEVICE, *[device_record(**c) for c, _ in DEVICE_NEGATIVE]).collect()
    for row, (change, field) in zip(got, DEVICE_NEGATIVE):
        assert [e.split(":")[0] for e in row.errors] == [field], change


@pytest.mark.parametrize("level,record,bad", [
    ("base", {}, []), ("base", {"variant": 30}, ["variant"]), ("base", {"guid": "x"}, ["guid"]),
    ("basic", {"name": "a", "product_id": "0x0001", "variant": 0}, []),
    ("basic", {"name": "a", "variant": 0}, ["product_id"]),
    ("extended", {"name": "a", "product_id": "0x0001", "variant": 0}, ["guid", "firmware_version"]),
])
def test_product_context_levels(spark, level, record, bad):
    from pulsegrid.functions.rules import errors_of

    frame = spark.createDataFrame([(json.dumps({"p": record}),)], "t string").select(
        F.from_json("t", f"struct<p:{contracts.PRODUCT_CTX.simpleString()}>").alias("r")).select("r.*")
    (row,) = frame.select(errors_of(contracts.product_rules("p", level)).alias("e")).collect()
    assert [e.split(":")[0].removeprefix("p.") for e in row.e] == bad


def test_counts_add_up(spark):
    judged = judge(spark, contracts.APP, app_record("session"), "[1]", app_record("session", event_name="x"))
    assert contracts.batch_counts(judged).first().asDict() == {
        "received": 3, "valid": 1, "invalid": 2, "invalid_type": 1, "invalid_schema": 1}
    assert contracts.valid_records(judged).count() == 1
    bad = contracts.failures(judged, keep=("i",)).orderBy("i").collect()
    assert [r.i for r in bad] == [1, 2] and bad[0].raw == "[1]"


def test_flatten_app(spark):
    judged = judge(spark, contracts.APP, *[app_record(k) for k in ("session", "pairing", "auth")])
    session, pairing, auth = flatten.flatten_app(
        contracts.valid_records(judged), keep=("i",)).orderBy("i").collect()
    assert session.client_id == GUID and session.client_session_id == 3
    assert session.nova_device_model == "iPhone" and session.product_name is None
    assert str(session.event_timestamp) == "2024-05-05 23:08:09"
    assert (pairing.product_id, pairing.product_variant, pairing.product_firmware_version) == (
        "0x1A2B", 4, "2.3.4")
    assert json.loads(auth.nova_user_metadata) == {"plan": "free", "n": [1, 2]}
    assert session.nova_user_metadata is None


def test_flat_contracts(spark):
    judged = judge(spark, contracts.APP, *[app_record(k) for k in ("session", "pairing", "auth")])
    flat = flatten.flatten_app(contracts.valid_records(judged), keep=("i",))
    dated = flat.withColumn("dt", F.lit("2024-05-06"))
    for i, kind in enumerate(("session", "pairing", "auth")):
        (row,) = contracts.check_flat_contract(dated.where(f"i = {i}"), kind).collect()
        assert row.errors == []
    (row,) = contracts.check_flat_contract(flat.where("i = 0"), "session").collect()
    assert [e.split(":")[0] for e in row.errors] == ["dt"]


def test_flatten_names_twice():
    from pyspark.sql import types as T

    both = T.StructType.fromDDL("a_id string, a_ctx struct<id: string>")
    with pytest.raises(ValueError, match="a_id"):
        flatten.flat_names(both)


def test_decode(spark):
    rows = [
        ("bt_connection-a1b2c3d", base64.b64encode(b"\x0a\x09connected\x18\x05").decode()),
        ("bt_connection-a1b2c3d", "!!"),
        ("bt_connection-a1b2c3d", ""),
        ("bt_connection-a1b2c3d", base64.b64encode(b"\x0a\xff").decode()),
        ("unknown-0000000", base64.b64encode(b"\x18\x05").decode()),
        (None, base64.b64encode(b"\x18\x05").decode()),
        ("bt_connection-a1b2c3d", None),
    ]
    frame = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "i int, schema_id string, raw_payload string")
    got = device_events.decode_payload(frame, records.registry(spark)).orderBy("i").collect()
    assert [r.decode_success for r in got] == [True] + [False] * 6
    assert json.loads(got[0].payload_json) == {"bt_device_state": "connected", "uptime": "5"}
    assert {r.payload_json for r in got[1:]} == {None}
    twice = records.registry(spark).unionByName(records.registry(spark))
    with pytest.raises(Exception, match="listed twice"):
        device_events.decode_payload(frame, twice).collect()


def test_flatten_raw_from_text_contexts(spark):
    frame = spark.createDataFrame(
        [("e", "5", "s", "p", '{"variant": "v"}', '{"mono_time": "7"}', "{}")],
        "event_name string, event_timestamp_ms string, schema_id string, raw_payload string, "
        "client_ctx string, device_ctx string, product_ctx string")
    row = device_events.flatten_raw(frame).first()
    assert (row.client_variant, row.device_mono_time, row.event_timestamp_ms) == ("v", 7, 5)


def test_enrich(spark):
    frame = spark.createDataFrame(
        [(1704067199999, "1.2.3-rc1", "reboot_info-a1b2c3d", '{"bt_device_state": "connected"}'),
         (1704067200000, "bad", "a-b-c", None)],
        "event_timestamp_ms long, client_firmware_version string, schema_id string, payload_json string")
    first, second = device_events.enrich(frame).orderBy("event_timestamp_ms").collect()
    assert str(first.event_local_timestamp) == "2024-01-01 07:59:59"
    assert (first.client_version_core, first.device_schema_name, first.bt_device_state) == (
        "1.2.3", "reboot_info", "connected")
    assert (second.client_version_core, second.device_schema_name, second.bt_device_state) == (
        "", "a", None)
