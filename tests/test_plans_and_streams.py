"""Whole table jobs on a small event table, and streams run in several goes."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import contracts
from pulsegrid.operators.date_windows import DateWindow
from pulsegrid.plans.app_tables import AppTablesV1, AppTablesV2, export_user_active
from pulsegrid.plans.device_tables import DeviceTables
from pulsegrid.sources import readers
from pulsegrid.streaming import ingest
from tests.test_contracts import app_record

D = dt.date.fromisoformat
GUID = "00000000-0000-4000-8000-00000000000{}"
FLAT = ("event_name string, event_schema_version int, event_guid string, event_timestamp string, "
        "client_name string, client_variant string, client_version string, client_build string, "
        "client_id string, client_mono_time long, client_is_background boolean, "
        "client_session_id int, nova_device_os string, nova_device_os_version string, "
        "product_name string, product_id string, product_variant int, product_guid string, "
        "product_firmware_version string, dt string")
PRODUCTS = [(f"p{i}", GUID.format(i), f"P{i}", "speaker", i != 2) for i in (1, 2)]


def flat(spark, *events):
    """(guid, client, product number, day of January)"""
    return spark.createDataFrame(
        [("nova-telemetry-record", 2, g, f"2024-01-{d:02d}T01:00:00Z", "nova-ios", "prod", "1.0.0", "b",
          c, 5, False, 1, None, None, f"P{p}", f"p{p}", 1, GUID.format(p), "1.0.0", f"2024-01-{d:02d}")
         for g, c, p, d in events], FLAT)


def products(spark):
    return spark.createDataFrame(
        PRODUCTS, "product_id string, product_guid string, product_name string, "
                  "product_category string, is_active boolean")


FIRST = [("g1", "a", 1, 1), ("g2", "b", 1, 1), ("g2", "b", 1, 1), ("g3", "a", 1, 2), ("g4", "c", 2, 3)]


def test_first_generation(spark, database, as_rows):
    job = AppTablesV1(spark, database)
    at = F.lit("2024-01-09 00:00:00").cast("timestamp")
    for _ in range(2):
        job.run(flat(spark, *FIRST), products(spark), "2024-01-03", 2, at)
        assert as_rows(job.table("events"), "event_guid") == [("g1",), ("g2",), ("g3",), ("g4",)]
        assert as_rows(job.table("pairings"), "client_id", "product_guid") == [
            ("a", GUID.format(1)), ("b", GUID.format(1)), ("c", GUID.format(2))]
        assert as_rows(job.table("retention"), "cohort_date", "partition_date", "product_id",
                       "cohort_size", "retained_users") == [
            (D("2024-01-01"), D("2024-01-01"), "p1", 2, 2), (D("2024-01-01"), D("2024-01-02"), "p1", 2, 1),
            (D("2024-01-03"), D("2024-01-03"), "p2", 1, 1)]
    # the next day touches only the cohort that was active
    job.load(flat(spark, ("g5", "b", 1, 4)), "2024-01-04", 0, at)
    job.user_daily("2024-01-04", 0)
    job.retention("2024-01-04", 0)
    got = as_rows(job.table("retention"), "cohort_date", "partition_date", "retained_users")
    assert got == [(D("2024-01-01"), D("2024-01-01"), 2), (D("2024-01-01"), D("2024-01-02"), 1),
                   (D("2024-01-01"), D("2024-01-04"), 1), (D("2024-01-03"), D("2024-01-03"), 1)]
    assert export_user_active(job.table("retention"), "2024-01-04").columns[-1] == "business_date"


def tables_by_event(spark, events):
    def read(name):
        return flat(spark, *events) if name == "nova_bt_connect_result" else flat(spark)
    return read


def legacy(spark):
    return spark.createDataFrame(
        [("old", "v4", "2024-01-03 01:00:00", "2024-01-03 02:00:00", "2024-01-03", "z", "nova-ios", "prod",
          "0.9", "b", "iOS", "k=1", D("2024-01-03"), 7, None)],
        "event_type_name string, event_uuid string, server_received_at string, client_local_time string, "
        "client_local_date string, app_user_id string, app_name string, app_variant string, "
        "app_version string, app_build string, device_platform string, raw_payload_json string, "
        "log_date date, row_id long, is_internal boolean")


def test_second_generation(spark, database, as_rows):
    job = AppTablesV2(spark, database)
    events = [e for e in FIRST if e[0] != "g2"] + [("g2", "b", 1, 1)]
    for _ in range(2):
        job.backfill(tables_by_event(spark, events), products(spark), "2024-01-03", 2, legacy(spark),
                     per_event={"nova_login_attempt": 5})
        assert as_rows(job.table("events"), "event_guid") == [("g1",), ("g2",), ("g3",), ("g4",), ("v4",)]
        assert as_rows(job.table("user_daily"), "client_id", "event_local_date") == [
            ("a", D("2024-01-01")), ("a", D("2024-01-02")), ("b", D("2024-01-01")), ("c", D("2024-01-03")),
            ("z", D("2024-01-03"))]
        assert as_rows(job.current_pairings(), "client_id", "product_name") == [
            ("a", "P1"), ("b", "P1"), ("c", "P2")]
    # one event type alone leaves the legacy rows and other types in place
    job.load(tables_by_event(spark, [("n1", "a", 1, 3)]), "2024-01-03", 0, legacy(spark),
             event="nova_bt_connect_result")
    assert as_rows(job.table("events"), "event_guid") == [("g1",), ("g2",), ("g3",), ("n1",), ("v4",)]
    with pytest.raises(ValueError):
        job.load(tables_by_event(spark, []), "2024-01-03", 0, event="none")
    # the state of an earlier date is gone and cannot be built on
    with pytest.raises(ValueError):
        job.pairings(products(spark), "2024-01-02")


def test_device_tables(spark, database, tmp_path, as_rows):
    from pulsegrid.operators.device_events import parse_raw
    from workloads import records

    def line(name, ms, payload, session="s"):
        return (json.dumps({
            "event_name": name, "event_timestamp_ms": ms, "schema_id": f"{name}-a1b2c3d",
            "raw_payload": payload, "client_ctx": {"variant": "prod", "firmware_version": "1.0.0"},
            "device_ctx": {"component_guid": "d", "session_id": session, "mono_time": ms % 1000},
            "product_ctx": {"sku": "A", "model_name": "m"}}),)

    start = 1704067200000
    lines = spark.createDataFrame(
        [line("reboot_info", start + 900, "GAU="), line("reboot_info", start + 86400100, "GAU="),
         line("reboot_info", start + 5, "!!"), line("heartbeat", start + 7, "GAU="),
         line("ota_status", start + 8, "EgdzdWNjZXNzGAU=")], "value string")
    job = DeviceTables(spark, database)
    reports = job.ingest(parse_raw(lines), records.registry(spark), "b1")
    assert {k: r.rows for k, r in reports.items()} == {
        "events": 5, "invalid": 1, "reboot_info": 2, "shutdown_reason": 0, "ota_status": 1,
        "bt_connection": 0}
    window = DateWindow(D("2024-01-01"), D("2024-01-02"))
    for _ in range(2):
        job.session_counts("reboot_info", window)
        assert as_rows(job.table("reboot_info"), "single_session_reboot_cnt") == [(2,), (2,)]
        job.session_sets(window)
        assert job.table("session_sets").count() == 2
    releases = spark.createDataFrame([("1.0.0", "f", "beta", D("2024-01-01"))],
                                     "firmware_version string, firmware_version_format string, "
                                     "release_channel string, release_date date")
    job.crash_counts(releases, window)
    assert as_rows(job.table("crash_counts"), "crash_cnt_total", "release_channel") == [
        (0, "beta"), (1, "beta")]
    rows = job.export_reports(str(tmp_path / "out"), "20240102")
    assert rows == {"crash_rate": 1, "crash_count_daily": 1, "connectivity_rate_daily": 1, "ota_rate": 0}
    assert spark.table(f"{database}.vw_device_crash_rate").first().crash_rate == 1.0
    with pytest.raises(ValueError):
        job.export_reports(str(tmp_path / "out"), "20240102", only="nothing")


def test_ingest_stream_in_two_runs(spark, tmp_path, as_rows):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))

    def arrive(*records):
        texts = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
        spark.createDataFrame(texts, "value string").coalesce(1).write.mode("append").text(source)

    def run():
        ingest.ingest_stream(spark, source, out, mark, contracts.APP).awaitTermination()
        good = spark.read.parquet(f"{out}/records")
        return as_rows(good, "nova_event_name"), spark.read.json(f"{out}/quarantine").count()

    arrive(app_record("session"), app_record("auth"), "[1]")
    assert run() == ([("device_session_record",), ("user_auth_record",)], 1)
    assert run() == ([("device_session_record",), ("user_auth_record",)], 1)
    arrive(app_record("pairing"), app_record("session", event_name="x"))
    assert run() == (
        [("device_pairing_record",), ("device_session_record",), ("user_auth_record",)], 2)


def test_new_checkpoint_leaves_earlier_batches(spark, tmp_path, as_rows):
    out = str(tmp_path / "out")
    for n, kind in enumerate(("session", "auth")):
        source = str(tmp_path / f"in{n}")
        spark.createDataFrame([(json.dumps(app_record(kind)),), ("[1]",)], "value string").write.text(source)
        ingest.ingest_stream(spark, source, out, str(tmp_path / f"mark{n}"), contracts.APP).awaitTermination()
    assert as_rows(spark.read.parquet(f"{out}/records"), "nova_event_name") == [
        ("device_session_record",), ("user_auth_record",)]
    assert spark.read.json(f"{out}/quarantine").count() == 2


def test_batch_written_again_replaces_itself(spark, tmp_path):
    lines = spark.createDataFrame([(json.dumps(app_record("session")),), ("[1]",)], "value string")
    write = ingest.batch_writer(str(tmp_path), contracts.APP)
    for batch in (0, 0, 1):
        write(lines, batch)
    assert spark.read.parquet(f"{tmp_path}/records").count() == 2
    assert spark.read.json(f"{tmp_path}/quarantine").count() == 2


def test_raw_text_is_kept_for_bad_records_alone(spark, tmp_path, monkeypatch, as_rows):
    """The judged batch is written in between; of valid records it needs the fields only."""
    judged, kept = [], ingest.scratch.kept

    def watched(frame, name):
        judged.extend(frame.select("value", "error_code").collect())
        assert "errors" not in frame.columns
        return kept(frame, name)

    monkeypatch.setattr(ingest.scratch, "kept", watched)
    lines = spark.createDataFrame([(json.dumps(app_record("session")),), ("[1]",)], "value string")
    ingest.batch_writer(str(tmp_path), contracts.APP)(lines, 0)
    assert sorted((r.value, r.error_code is None) for r in judged if r.value) == [("[1]", False)]
    assert len(judged) == 2
    assert as_rows(spark.read.json(f"{tmp_path}/quarantine"), "raw") == [("[1]",)]


def test_first_copy_stream(spark, tmp_path, as_rows):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = "event_guid string, event_timestamp timestamp"

    def arrive(*rows):
        spark.createDataFrame([(g, dt.datetime(2024, 1, d)) for g, d in rows], schema).coalesce(
            1).write.mode("append").parquet(source)

    def run():
        rows = readers.stream_new_files(spark, source, spark.createDataFrame([], schema).schema, fmt="parquet")
        (ingest.first_copy_stream(rows).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination())
        return as_rows(spark.read.parquet(out), "event_guid")

    arrive(("a", 1), ("a", 1), ("b", 2))
    assert run() == [("a",), ("b",)]
    arrive(("b", 2), ("c", 3))
    assert run() == [("a",), ("b",), ("c",)]


def test_device_stream_in_two_runs(spark, database, tmp_path, as_rows):
    from workloads import records

    source, mark = str(tmp_path / "in"), str(tmp_path / "mark")
    job = DeviceTables(spark, database)

    def arrive_and_run(*payloads):
        lines = [(json.dumps({
            "event_name": "reboot_info", "event_timestamp_ms": 1704067200000, "schema_id": "reboot_info-a1b2c3d",
            "raw_payload": p, "client_ctx": {}, "device_ctx": {"mono_time": 1}, "product_ctx": {}}),)
            for p in payloads]
        if lines:
            spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(source)
        ingest.device_stream(spark, source, job, records.registry(spark), mark).awaitTermination()
        return [job.table(t).count() for t in ("events", "invalid", "reboot_info")]

    assert arrive_and_run("GAU=", "!!") == [2, 1, 1]
    assert arrive_and_run() == [2, 1, 1]
    assert arrive_and_run("GAY=") == [3, 1, 2]
