"""File-level merges, interrupted publishing, exactly-once batches and crash state across windows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators.date_windows import DateWindow
from pulsegrid.operators.device_events import parse_raw
from pulsegrid.plans.device_tables import DeviceTables
from pulsegrid.sources import publish, tables
from pulsegrid.sources.tables import TableSpec
from pulsegrid.streaming import ingest
from workloads import records

D = dt.date.fromisoformat
DAYS = DateWindow(D("2024-01-01"), D("2024-01-09"))


def table(spark, database):
    """Two appends over two dates: even keys, then odd ones."""
    spec = TableSpec(f"{database}.t", spark.createDataFrame([], "k int, n int, s string, d date").schema, ("d",))
    for odd in (0, 1):
        tables.append_table(spark.range(20).where(f"id % 2 = {odd}").selectExpr(
            "int(id) k", "0 n", "'x' s", "date_add(DATE'2024-01-01', int(id % 4 div 2)) d").coalesce(1), spec)
    return spec


def files_of(spark, spec):
    return {r[0]: r[1] for r in spark.table(spec.name).select(
        publish.FILE, "_metadata.file_modification_time").distinct().collect()}


def test_merge_rewrites_only_files_with_changes(spark, database, as_rows):
    spec = table(spark, database)
    before = files_of(spark, spec)
    assert len(before) == 4
    source = spark.createDataFrame([(1, 5), (5, 6), (99, 7), (None, 8)], "k int, n int")
    report = tables.merge_update(source, spec, ["k"], ["n"], DAYS)
    after = files_of(spark, spec)
    kept = {f: t for f, t in before.items() if f not in report.files}
    assert len(report.files) == 1 and kept.items() <= after.items() and len(after) == 4
    assert as_rows(spark.table(spec.name), "k", "n") == sorted(
        ((k, {1: 5, 5: 6}.get(k, 0)) for k in range(20)), key=repr)
    # the same values again touch nothing, nor do keys outside the window
    assert tables.merge_update(source, spec, ["k"], ["n"], DAYS).files == []
    late = spark.createDataFrame([(2, 9)], "k int, n int")
    assert tables.merge_update(late, spec, ["k"], ["n"], DateWindow(D("2024-01-01"), D("2024-01-01"))).files == []
    assert files_of(spark, spec) == after


def test_a_file_filter_reads_those_files_alone(spark, database):
    spec = table(spark, database)
    one = sorted(files_of(spark, spec))[:1]
    rows = tables._rows_of(spark, spec, one)
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan()
    scan = plan.collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 1


def test_delete_rows_and_odd_partition_values(spark, database, as_rows):
    spec = TableSpec(f"{database}.odd", spark.createDataFrame([], "k int, p string").schema, ("p",))
    values = ["a b", "a%20b", "x=y/z", "it's", "ü", None]
    tables.append_table(spark.createDataFrame([(i, v) for i, v in enumerate(values)] * 2, "k int, p string"), spec)
    report = tables.delete_rows(spark, spec, F.col("k") % 2 == 0)
    assert len(report.files) == 3
    assert as_rows(spark.table(spec.name), "k", "p") == sorted([(i, v) for i, v in enumerate(values) if i % 2] * 2, key=repr)
    assert tables.delete_rows(spark, spec, F.col("k") > 100).files == []


@pytest.mark.parametrize("step", ["staged", "journal", "removed", "moved"])
def test_interrupted_publishing_is_taken_up(spark, database, as_rows, step):
    spec = table(spark, database)
    whole = as_rows(spark.table(spec.name))
    files = publish.touched_files(spark.table(spec.name).where("k = 1"))
    changed = tables._rows_of(spark, spec, files).withColumn("n", F.lit(1))
    folder, _ = publish.stage(changed.select("k", "n", "s", "d"), spec.name, spec.partition_by, tables._metrics(spec))

    def fail(at):
        if at == step:
            raise KeyboardInterrupt(at)

    with pytest.raises(KeyboardInterrupt):
        publish.publish(spark, spec.name, folder, files, fail)
    if step == "staged":
        assert as_rows(spark.table(spec.name)) == whole
    for _ in range(2):
        publish.recover(spark, spec.name)
    spark.catalog.refreshTable(spec.name)
    assert len(files_of(spark, spec)) == 4
    got = as_rows(spark.table(spec.name), "k", "n")
    assert [k for k, _ in got] == sorted(range(20), key=repr) or len(got) == 20
    assert sum(n for _, n in got) == (0 if step == "staged" else len([r for r in whole if r[0] in (1, 5, 9, 13, 17)]))


def test_ledger(spark, tmp_path):
    ledger = publish.BatchLedger(spark, f"{tmp_path}/ledger")
    assert ledger.state("q", 0) == "new"
    ledger.start("q", 0)
    ledger.start("q", 0)
    assert ledger.state("q", 0) == "started" and ledger.state("other", 0) == "new"
    ledger.done("q", 0)
    assert [ledger.state("q", n) for n in (0, 1)] == ["done", "new"]
    ledger.start("q", 11)
    ledger.done("q", 11)
    assert [ledger.state("q", n) for n in (0, 5, 11, 12)] == ["done", "done", "done", "new"]


def raw_line(name, ms, payload="GAU=", device="d", mono=None):
    return json.dumps({
        "event_name": name, "event_timestamp_ms": ms, "schema_id": f"{name}-a1b2c3d", "raw_payload": payload,
        "client_ctx": {"variant": "prod", "firmware_version": "1.0.0"},
        "device_ctx": {"component_guid": device, "session_id": "s", "mono_time": ms % 1000 if mono is None else mono},
        "product_ctx": {"sku": "A", "model_name": "m"}})


@pytest.mark.parametrize("target", DeviceTables.INGEST_TARGETS)
def test_failed_batch_is_repeated_without_doubles(spark, database, tmp_path, target):
    job, registry = DeviceTables(spark, database), records.registry(spark)
    start = 1704067200000

    def deliver(number):
        kinds = ("reboot_info", "shutdown_reason", "ota_status", "bt_connection", "heartbeat")
        lines = [raw_line(k, start + number * 1000 + i, "!!" if i == 3 else "GAU=") for i, k in enumerate(kinds)]
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{number}.json").write_text("\n".join(lines))

    def fail(at):
        if at == target:
            raise RuntimeError(at)

    def run(written=lambda table: None):
        ingest.device_stream(spark, f"{tmp_path}/in", job, registry, f"{tmp_path}/check", written).awaitTermination()

    deliver(0)
    run()
    deliver(1)
    for _ in range(2):
        with pytest.raises(Exception):
            run(fail)
    run()
    run()
    counts = {t: job.table(t).count() for t in DeviceTables.INGEST_TARGETS}
    assert counts == {"events": 10, "invalid": 2, "reboot_info": 2, "shutdown_reason": 2, "ota_status": 2, "bt_connection": 0}


def crash_lines():
    day = 86_400_000
    start = 1704067200000 - 8 * 3_600_000  # midnight in the local zone
    out = []
    for i, (date, device, mono) in enumerate([
            (0, "a", 900), (0, "b", 50), (1, "a", 10), (1, "a", 20), (3, "b", 40), (3, "a", 5), (4, "c", 1), (5, "c", 0), (5, "b", 60),
            (6, "a", 4), (6, "b", 7)]):
        out.append(raw_line("heartbeat", start + date * day + i, device=device, mono=mono))
    return out


@pytest.mark.parametrize("order_by", ["uptime", "event_time"])
def test_crash_counts_do_not_depend_on_windows(spark, database, as_rows, order_by):
    releases = spark.createDataFrame(
        [], "firmware_version string, firmware_version_format string, release_channel string, release_date date")
    lines = spark.createDataFrame([(x,) for x in crash_lines()], "value string")

    def job_of(name):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}_{name}")
        job = DeviceTables(spark, f"{database}_{name}")
        job.ingest(parse_raw(lines), records.registry(spark), "one")
        return job

    day = lambda n: D("2024-01-01") + dt.timedelta(days=n)
    whole, parts = job_of("whole"), job_of("parts")
    whole.crash_counts(releases, DateWindow(day(0), day(6)), order_by)
    want = as_rows(whole.table("crash_counts"))
    assert sum(r[2] for r in want) >= 5
    # from the third day on only: the days before are read once for their last events
    for lo, hi in ((2, 3), (4, 4), (5, 6)):
        parts.crash_counts(releases, DateWindow(day(lo), day(hi)), order_by)
    assert as_rows(parts.table("crash_counts")) == [r for r in want if r[-1] >= day(2)]
    # the first days late, which also moves the days after them along, then a day in between again
    parts.crash_counts(releases, DateWindow(day(0), day(1)), order_by)
    assert as_rows(parts.table("crash_counts")) == want
    parts.crash_counts(releases, DateWindow(day(3), day(3)), order_by)
    assert as_rows(parts.table("crash_counts")) == want
    for name in ("whole", "parts"):
        spark.sql(f"DROP DATABASE {database}_{name} CASCADE")


def test_audited_write_shows_all_or_nothing(spark, database, as_rows):
    spec = TableSpec(f"{database}.a", spark.createDataFrame([], "k int, n int, d date").schema, ("d",))
    day = lambda n: D(f"2024-01-0{n}")
    rows = lambda *r: spark.createDataFrame(r, "k int, n int, d date")
    checks = {"no key": F.col("k").isNull(), "negative": F.col("n") < 0}
    two = DateWindow(day(1), day(2))
    assert tables.audited_replace(rows((1, 1, day(1)), (2, None, day(2))), spec, two, checks) == {
        "rows": 2, "outside the window": 0, "no key": 0, "negative": 0}
    before, files = as_rows(spark.table(spec.name)), files_of(spark, spec)
    for bad, name in ((rows((None, 1, day(1))), "no key"), (rows((1, -1, day(1))), "negative"), (rows(), "rows"),
                      (rows((1, 1, day(3))), "outside the window")):
        with pytest.raises(tables.AuditFailed) as failed:
            tables.audited_replace(bad, spec, two, checks)
        assert failed.value.broken == [name]
        assert as_rows(spark.table(spec.name)) == before and files_of(spark, spec) == files
    # what replaces a window leaves none of its dates behind
    tables.audited_replace(rows((5, 5, day(2))), spec, two, checks)
    assert as_rows(spark.table(spec.name)) == [(5, 5, day(2))]
    assert tables.partitions(spark, spec) == [(day(2),)]
    third = DateWindow(day(3), day(3))
    with pytest.raises(tables.AuditFailed):
        tables.audited_replace(rows(*[(i, 1, day(3)) for i in range(3)]), spec, third, checks, ratio=(0.5, 2.0))
    tables.audited_replace(rows(*[(i, 1, day(3)) for i in range(2)]), spec, third, checks, ratio=(0.5, 2.0))
    names = [n for n, _ in publish.Files(spark, publish.location(spark, spec.name)).children(publish.location(spark, spec.name))]
    assert not [n for n in names if n.startswith(publish.STAGING)]


def test_report_is_published_in_one_step(spark, database, tmp_path, as_rows):
    from pulsegrid.sources import exports

    name, root = f"{database}.vw_device_r", f"{tmp_path}/reports"
    frame = lambda *k: spark.createDataFrame([(i,) for i in k], "k int")
    seen = []
    look = lambda step: seen.append(as_rows(spark.table(name), "k"))
    exports.publish_report(frame(1, 2), name, root, "r", "20240101")
    assert exports.publish_report(frame(3), name, root, "r", "20240101", during=look) == 1
    assert seen == [[(1,), (2,)]] and as_rows(spark.table(name), "k") == [(3,)]
    broken = frame(1).select(F.raise_error(F.lit("no")).cast("int").alias("k"))
    with pytest.raises(Exception):
        exports.publish_report(broken, name, root, "r", "20240101")
    assert as_rows(spark.table(name), "k") == [(3,)]
    assert exports.prune_report_runs(spark, name, root, "r", "20240101") == 2
    assert as_rows(spark.newSession().table(name), "k", "report_date") == [(3, "20240101")]
    exports.publish_report(frame(), name, root, "r", "20240101")
    assert as_rows(spark.table(name), "k") == []


def test_stored_view_is_read_by_other_sessions(spark, database, as_rows):
    from pulsegrid.sources import exports

    spec = table(spark, database)
    exports.create_stored_view(spark, f"{database}.v", spec.name, {"key": "k", "twice": "2 * k"}, where="k < 3")
    assert as_rows(spark.newSession().table(f"{database}.v")) == [(0, 0), (1, 2), (2, 4)]
    exports.create_stored_view(spark, f"{database}.v", spec.name, {"key": "k"}, where="k = 1")
    assert as_rows(spark.newSession().table(f"{database}.v")) == [(1,)]


def test_sketches_merge(spark):
    from pulsegrid.operators import sketches

    rows = spark.range(200_000).selectExpr(
        "date_add(DATE'2024-01-01', int(id % 4)) AS partition_date", "id % 2 AS g", "int(id % 50000) AS client_id")
    rows = rows.unionByName(rows.limit(0)).unionByName(spark.createDataFrame(
        [(D("2024-01-01"), 0, None)], "partition_date date, g long, client_id int"))
    daily = sketches.daily_sketches(rows, ["g"], "client_id")
    whole = {r.g: r.distinct_count for r in sketches.distinct_in(daily, ["g"], DAYS).collect()}
    exact = {r.g: r.n for r in rows.groupBy("g").agg(F.count_distinct("client_id").alias("n")).collect()}
    assert whole.keys() == exact.keys() and all(abs(whole[g] - exact[g]) <= 0.02 * exact[g] for g in exact)
    assert sketches.distinct_in(daily, ["g"], DateWindow(D("2025-01-01"), D("2025-01-02"))).count() == 0


def test_activity_bits(spark, as_rows):
    from pulsegrid.operators import activity, retention

    days = [("2023-12-31", "a", "p"), ("2024-01-01", "a", "p"), ("2024-01-31", "a", None), ("2024-02-29", "b", "p"),
            ("2024-01-31", "b", "q"), ("2024-01-31", "b", "q"), ("2024-02-01", None, "p"), ("2024-03-01", "a", "q")]
    facts = spark.createDataFrame([(D(d), c, "ios", p) for d, c, p in days],
                                  "partition_date date, client_id string, client_name string, product_id string")
    whole = DateWindow(D("2023-12-01"), D("2024-03-31"))
    bits = activity.day_bits(facts, whole)
    got = sorted({(d, r.client_id, r.product_id) for r in bits.select("*", activity.dates_of().alias("dates")).collect()
                  for d in r.dates}, key=repr)
    assert got == sorted({(D(d), c, p) for d, c, p in days if c}, key=repr)
    for window in (whole, DateWindow(D("2024-01-31"), D("2024-02-01")), DateWindow(D("2024-03-01"), D("2024-03-01"))):
        assert as_rows(activity.retention_curve(bits.where(F.col("month") <= F.lit(window.hi)), window)) == as_rows(
            retention.retention_curve(facts.where(F.col("partition_date") <= F.lit(window.hi)), window))
        # days of a window taken away and put back
        gone = activity.replace_days(bits, bits.limit(0), window)
        kept = facts.where(~window.holds("partition_date"))
        assert as_rows(gone) == as_rows(activity.day_bits(kept, whole))
        assert as_rows(activity.replace_days(gone, activity.day_bits(facts, window), window)) == as_rows(bits)


def test_curves_from_bits_send_nothing_through_the_driver(spark, as_rows):
    """Clients of several months, days and products; cohorts after the window's end are left out."""
    from pulsegrid.operators import activity, retention

    start = D("2024-01-25")
    facts = spark.createDataFrame(
        [(f"c{i % 9}", "ios", f"p{i % 3}" if i % 4 else None, start + dt.timedelta(days=i * i % 50)) for i in range(90)],
        "client_id string, client_name string, product_id string, partition_date date")
    bits = activity.day_bits(facts, DateWindow(start, D("2024-04-01")))
    window = DateWindow(D("2024-02-20"), D("2024-02-25"))
    cells = activity.cohort_cells(bits, window)
    got = retention.curve_of_cells(cells)
    assert as_rows(got) == as_rows(retention.retention_curve(
        facts.where(F.col("partition_date") <= F.lit(window.hi)), window))
    assert "Broadcast" not in cells._jdf.queryExecution().executedPlan().toString()
    visited = activity.visited_cohorts(bits, window)
    assert as_rows(visited) == as_rows(retention.visited_cohorts(facts, window))
    assert "Join" not in visited._jdf.queryExecution().executedPlan().toString()


def test_rows_of_one_partition_are_written_by_several_tasks(spark, database, as_rows):
    rows = spark.range(100000).selectExpr("concat('c', id) AS client_id", "md5(string(id)) AS text", "DATE'2024-01-01' AS month")
    spec = tables.spec_of(rows, f"{database}.spread", partition_by=("month",), sort_by=("client_id",), spread=64)
    tables.full_refresh(rows, spec)
    assert spark.table(spec.name).count() == 100000 and len(spark.table(spec.name).inputFiles()) > 1
    assert spark.table(spec.name).columns == ["client_id", "text", "month"]


def test_a_further_attempt_takes_what_is_decoded(spark, database, tmp_path):
    """Complete targets keep their files, payloads are not decoded again, and nothing of the batch stays
    beside the ledger."""
    job = DeviceTables(spark, database)
    lines = spark.createDataFrame([(raw_line(k, 1704067200000),) for k in ("reboot_info", "ota_status")], "value string")

    def stop(target):
        if target == "reboot_info":
            raise RuntimeError(target)

    with pytest.raises(RuntimeError):
        job.ingest_once(parse_raw(lines), records.registry(spark), "q", 0, stop)
    files = {t: job.table(t).inputFiles() for t in ("events", "reboot_info")}
    told = []
    empty = records.registry(spark).where("false")
    reports = job.ingest_once(parse_raw(lines), empty, "q", 0, told.append)
    assert list(reports) == ["shutdown_reason", "ota_status", "bt_connection"]
    assert told == list(DeviceTables.INGEST_TARGETS)
    assert {t: job.table(t).inputFiles() for t in files} == files
    assert [job.table(t).count() for t in DeviceTables.INGEST_TARGETS] == [2, 0, 1, 0, 1, 0]
    ledger = job.ledger()
    assert ledger.files.children(f"{ledger.root}/q") == [("000000000000.done", False)]


def test_rows_are_not_dealt_by_schema_ids(spark):
    """A registry of few ids would bring all rows to as many tasks."""
    from pulsegrid.operators import device_events

    lines = spark.range(100).selectExpr(f"'{raw_line('reboot_info', 1704067200000)}' AS value")
    decoded = device_events.decode_payload(device_events.flatten_raw(parse_raw(lines)), records.registry(spark))
    assert decoded.where("decode_success").count() == 100
    assert "Exchange hashpartitioning" not in decoded._jdf.queryExecution().executedPlan().toString()
