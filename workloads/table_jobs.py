"""Queries that write tables, files or streams in the shared folder and give what was written."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.operators import contracts, daily_activity, landing, pairings, sketches
from pulsegrid.operators.date_windows import DateWindow
from pulsegrid.plans import app_tables, device_tables
from pulsegrid.session import shared_folder
from pulsegrid.sources import exports, publish, readers, tables
from pulsegrid.sources.scratch import kept, written
from pulsegrid.streaming import ingest
from workloads import records, views


def scratch(spark: SparkSession) -> tuple[str, str]:
    """A new database and its folder, under the folder all executors share."""
    name = f"run_{uuid.uuid4().hex[:12]}"
    folder = f"{shared_folder(spark)}/{name}"
    tables.create_database(spark, name, f"{folder}/tables")
    return name, folder


def _days(spark: SparkSession, sf: str) -> tuple[DateWindow, dt.date, int]:
    """All days of the given events, the last one, and how many lie before it."""
    days = views.all_days(spark, sf)
    return days, days.hi, max((days.hi - days.lo).days, 0)


def _before(day: dt.date, n: int) -> dt.date:
    return day - dt.timedelta(days=n)


def app_v1_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The whole first-generation chain; gives the retention table."""
    db, _ = scratch(spark)
    days, last, span = _days(spark, sf)
    job = app_tables.AppTablesV1(spark, db, days.lo)
    job.run(views.flat_events(spark, sf), views.products(spark, sf), last, span, F.col("received_at"))
    job.retention(last, 3)
    return job.table("retention")


def app_v1_rejected(spark: SparkSession, sf: str) -> DataFrame:
    """Events that the first-generation event table takes, and those that it does not by what they
    lack."""
    db, _ = scratch(spark)
    days, last, span = _days(spark, sf)
    job = app_tables.AppTablesV1(spark, db, days.lo)
    job.load(views.flat_events(spark, sf), last, span, F.col("received_at"))
    taken = job.table("events").select("partition_date", F.lit("").alias("missing"))
    return taken.unionByName(job.table("events_rejected").select("partition_date", "missing")).groupBy(
        "partition_date", "missing").agg(F.count(F.lit(1)).alias("n_rows"))


def retention_day_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """The retention table after a run over all days but three and a run for each of these: facts are
    read for the window alone, all other days come from the activity bits."""
    db, _ = scratch(spark)
    days, last, span = _days(spark, sf)
    job = app_tables.AppTablesV1(spark, db, days.lo)
    facts = daily_activity.user_daily_by_ingest_date(views.app_ods(spark, sf, days), days)
    with tables.staged(facts, f"{db}.all_facts", ("partition_date",)) as known:
        named = known.where("client_name IS NOT NULL AND client_id IS NOT NULL")
        for day, back in ((_before(last, 3), max(span - 3, 0)), *((_before(last, n), 0) for n in (2, 1, 0))):
            window = DateWindow(_before(day, back), day)
            tables.replace_window(named.where(window.holds("partition_date")), job.specs["user_daily"], window)
            job.retention(day, back)
    return job.table("retention")


def _daily_active_runs(job, products: DataFrame, days: DateWindow) -> DataFrame:
    """All dates but the last four, these one by one, then the last six once more."""
    runs = [(_before(days.hi, 4), max((days.hi - days.lo).days - 4, 0)),
            *((_before(days.hi, n), 0) for n in (3, 2, 1, 0)), (days.hi, 5)]
    for day, back in runs:
        job.daily_active(products, day, back)
    spec = job.specs["daily_active"]
    view = f"{spec.name.split('.')[0]}.vw_app_daily_active_users"
    app_tables.daily_active_view(job.spark, spec, view)
    return job.spark.newSession().table(view)


def daily_active_table_v1(spark: SparkSession, sf: str) -> DataFrame:
    """The first generation's daily-active table, written window by window from its running state."""
    db, _ = scratch(spark)
    days, _, _ = _days(spark, sf)
    job, ods, products = app_tables.AppTablesV1(spark, db, days.lo), views.app_ods(spark, sf, days), views.products(spark, sf)
    users = daily_activity.user_daily_by_ingest_date(ods, days)
    # the table takes named clients only; who has no name still counts as active
    job.specs["user_daily"] = tables.spec_of(users, f"{db}.users", partition_by=("partition_date",))
    tables.replace_window(users, job.specs["user_daily"], days)
    tables.replace_window(
        daily_activity.product_daily_with_catalogue_names(ods, days), job.specs["product_daily"], days)
    tables.full_refresh(pairings.latest_pairings(job.table("user_daily"), products), tables.spec_of(
        pairings.latest_pairings(job.table("user_daily"), products), f"{db}.pairs"))
    job.specs["pairings"] = tables.spec_of(spark.table(f"{db}.pairs"), f"{db}.pairs")
    return _daily_active_runs(job, products, days)


def daily_active_table_v2(spark: SparkSession, sf: str) -> DataFrame:
    """The second generation's daily-active table over local dates, written window by window."""
    db, _ = scratch(spark)
    days, last, span = _days(spark, sf)
    job, products = app_tables.AppTablesV2(spark, db, floor=days.lo), views.products(spark, sf)
    events = views.app_events(spark, sf)
    tables.replace_window(daily_activity.user_daily_by_local_date(events, days), job.specs["user_daily"], days)
    tables.replace_window(daily_activity.product_daily(events, days), job.specs["product_daily"], days)
    tables.snapshot_then_replace(
        spark, job.specs["pairings"], last,
        lambda old: pairings.roll_pairings(pairings.window_pairings(events, products, days), old, last))
    return _daily_active_runs(job, products, DateWindow(days.lo, _before(last, -1)))


def window_replace(spark: SparkSession, sf: str) -> DataFrame:
    """User facts of all days, of which the last four are replaced by one day's phone users."""
    db, _ = scratch(spark)
    days, last, _ = _days(spark, sf)
    job = app_tables.AppTablesV2(spark, db, floor=days.lo)
    facts = daily_activity.user_daily_by_local_date(views.app_events(spark, sf), days)
    tables.replace_window(facts, job.specs["user_daily"], days)
    part = facts.where((F.col("client_platform") == "iOS")
                       & (F.col("partition_date") == F.lit(_before(last, 1))))
    for _ in range(2):
        tables.replace_window(part, job.specs["user_daily"], DateWindow(_before(last, 3), last))
    return job.table("user_daily")


def merge_session_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Reboot counts merged into the last eleven days of the reboot table."""
    db, _ = scratch(spark)
    _, last, _ = _days(spark, sf)
    job = device_tables.DeviceTables(spark, db)
    rows = views.device_subject(spark, sf, "reboot_info").drop("event_id")
    tables.append_table(rows, job.specs["reboot_info"])
    job.session_counts("reboot_info", DateWindow(_before(last, 10), last))
    return job.table("reboot_info").select(
        "event_timestamp_ms", "event_local_date", "client_variant", "device_component_guid",
        "device_session_id", "device_mono_time", "single_session_reboot_cnt")


def merge_touched_files(spark: SparkSession, sf: str) -> DataFrame:
    """A merge into a table that holds devices with even and with odd numbers in files of their own,
    with new values for the odd ones of the last three days: rows by date and group, and how many
    lie in a file that was there before the merge."""
    db, _ = scratch(spark)
    last = views.all_local_days(spark, sf).hi
    rows = views.device_subject(spark, sf, "reboot_info").withColumn(
        "odd", F.substring("device_component_guid", 3, 20).cast("long") % 2 == 1).withColumn("mark", F.lit(0))
    spec = tables.spec_of(rows, f"{db}.marked", partition_by=("event_local_date",))
    for odd in (False, True):
        tables.append_table(rows.where(F.col("odd") == odd), spec)
    before = spark.table(spec.name).select("event_id", F.col(publish.FILE).alias("file")).groupBy("file").count()
    window = DateWindow(_before(last, 2), last)
    new = rows.where(F.col("odd") & window.holds("event_local_date")).select("event_id", F.lit(1).alias("mark"))
    with kept(before.select("file"), "files") as known:
        for _ in range(2):
            tables.merge_update(new, spec, ["event_id"], ["mark"], window)
        now = spark.table(spec.name).withColumn("file", F.col(publish.FILE))
        out = now.join(known.withColumn("old", F.lit(True)), "file", "left").groupBy("event_local_date", "odd").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum("mark").alias("marked"), F.count("old").alias("in_old_files"))
        return written(out, "merged")


def widened_table(spark: SparkSession, sf: str) -> DataFrame:
    """Events by day, written while their source changes: the earlier half of the days has numbers of
    32 bits and a struct of one field; the later half has longer numbers and a struct of two. One
    table takes both and gives them in the later form."""
    db, _ = scratch(spark)
    days, _, span = _days(spark, sf)
    middle = days.lo + dt.timedelta(days=span // 2)
    events = views.base_events(spark, sf).withColumn("day", F.to_date("ts"))
    first = events.where(F.col("day") <= middle).select(
        "event_id", F.col("k").alias("number"), F.struct(F.col("event_type").alias("kind")).alias("source"), "day")
    later = events.where(F.col("day") > middle).select(
        "event_id", (F.col("k").cast("long") * 10_000_000_000).alias("number"),
        F.struct(F.col("uid").alias("user"), F.col("event_type").alias("kind")).alias("source"), "day")
    spec = tables.spec_of(first, f"{db}.events", partition_by=("day",))
    tables.append_table(first, spec)
    tables.append_table(later, tables.sync_columns(spark, spec, later))
    return spark.table(spec.name).groupBy("day", F.col("source.kind").alias("kind")).agg(
        F.sum(F.col("number") % 1_000_003).alias("checksum"), F.max("number").alias("largest"),
        F.count("source.user").alias("n_users"), F.count(F.lit(1)).alias("n_rows"))


def audited_write(spark: SparkSession, sf: str) -> DataFrame:
    """Device facts of all days written under checks, then the last days again with rows of another
    window, which is refused: rows by date, and the violations that the refused write counted."""
    db, _ = scratch(spark)
    days, last, _ = _days(spark, sf)
    job = app_tables.AppTablesV2(spark, db, floor=days.lo)
    spec = job.specs["product_daily"]
    facts = daily_activity.product_daily(views.app_events(spark, sf), days)
    checks = {"no device": F.col("product_guid").isNull(), "no user": F.col("active_user_count") < 1}
    with tables.staged(facts, f"{db}.facts") as rows:
        tables.audited_replace(rows, spec, days, checks)
        counters = {}
        try:
            broken = rows.withColumn("active_user_count", F.when(
                F.col("client_variant") == "prod", 0).otherwise(F.col("active_user_count")))
            tables.audited_replace(broken, spec, DateWindow(_before(last, 2), last), checks)
        except tables.AuditFailed as failed:
            counters = failed.counters
    return job.table("product_daily").groupBy("partition_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("active_user_count").alias("least_users")).withColumns(
        {name: F.lit(counters.get(check)).cast("long") for name, check in (
            ("refused_rows", "rows"), ("no_user", "no user"), ("outside", "outside the window"))})


def active_clients_sketched(spark: SparkSession, sf: str) -> DataFrame:
    """Clients active in the seven days up to each date, counted exactly and from daily sketches, and
    whether the two differ by 2 % at most."""
    days, _, _ = _days(spark, sf)
    facts = daily_activity.user_daily_by_local_date(views.app_events(spark, sf), days)
    rows = written(facts.select("partition_date", "client_platform", "client_id").distinct(), "clients")
    groups = ("client_platform",)
    daily = written(sketches.daily_sketches(rows, groups, "client_id"), "sketches")
    guess = sketches.trailing_distinct(daily, groups, 7)
    dates = rows.select(F.col("partition_date").alias("report_date")).distinct()
    exact = rows.select("*", F.explode(F.sequence("partition_date", F.date_add("partition_date", 6))).alias("report_date")).join(
        dates, "report_date", "left_semi").groupBy("report_date", *groups).agg(F.count_distinct("client_id").alias("clients"))
    same = [exact["report_date"] == guess["report_date"], exact["client_platform"].eqNullSafe(guess["client_platform"])]
    return exact.join(guess, same).select(
        exact["report_date"], exact["client_platform"], "clients",
        (F.abs(F.col("distinct_count") - F.col("clients")) <= 0.02 * F.col("clients")).alias("within_bound"))


def rolling_pairing_state(spark: SparkSession, sf: str) -> DataFrame:
    """Pairing state after a run over all days but two and two daily runs, the last one twice."""
    db, _ = scratch(spark)
    days, last, span = _days(spark, sf)
    job = app_tables.AppTablesV2(spark, db, floor=days.lo)
    tables.replace_window(_events_v2(spark, sf), job.specs["events"], days)
    job.pairings(views.products(spark, sf), _before(last, 2), max(span - 2, 0))
    for day in (_before(last, 1), last, last):
        job.pairings(views.products(spark, sf), day, 0)
    return job.table("pairings")


def _events_v2(spark: SparkSession, sf: str) -> DataFrame:
    days = views.all_days(spark, sf)
    return landing.union_events(
        lambda name: views.event_table(spark, sf, name), lambda _: days, "analytics_source")


def backfill_v2(spark: SparkSession, sf: str) -> DataFrame:
    """Rebuild of all second-generation tables for all days; gives the settled retention table."""
    db, _ = scratch(spark)
    days, last, span = _days(spark, sf)
    job = app_tables.AppTablesV2(spark, db, floor=days.lo)
    job.backfill(lambda name: views.event_table(spark, sf, name), views.products(spark, sf), last, span,
                 legacy=views.legacy_log(spark, sf))
    return job.table("retention")


def device_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Raw device records decoded into event, invalid and subject tables; rows per table and kind."""
    from pulsegrid.operators.device_events import parse_raw

    db, _ = scratch(spark)
    job = device_tables.DeviceTables(spark, db)
    job.ingest(parse_raw(records.raw_device_lines(spark, sf)), records.registry(spark), "one")
    return _rows_by_table(job)


def device_stream_retry(spark: SparkSession, sf: str) -> DataFrame:
    """Raw device records taken in by a stream whose batch fails after its first table, then after its
    third, and is run again; rows per table and kind."""
    db, folder = scratch(spark)
    job = device_tables.DeviceTables(spark, db)
    records.raw_device_lines(spark, sf).select("value").write.text(f"{folder}/incoming")

    def run(until: str | None = None) -> None:
        def fail(table: str) -> None:
            if table == until:
                raise RuntimeError(f"stopped after {table}")

        ingest.device_stream(spark, f"{folder}/incoming", job, records.registry(spark), f"{folder}/checkpoint",
                             fail).awaitTermination()

    for until in ("events", "reboot_info"):
        try:
            run(until)
        except StreamingQueryException as failed:
            if "stopped after" not in str(failed):
                raise
    run()
    run()
    return _rows_by_table(job)


def _rows_by_table(job: device_tables.DeviceTables) -> DataFrame:
    parts = [
        job.table(name).groupBy("event_name", "decode_success").agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("table_name", F.lit(name))
        for name in ("events", "invalid", "reboot_info", "shutdown_reason", "ota_status",
                     "bt_connection")]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def report_files(spark: SparkSession, sf: str) -> DataFrame:
    """Session and crash marts of the device table, exported as report files of one day and read
    back through the catalogue."""
    db, folder = scratch(spark)
    job = device_tables.DeviceTables(spark, db)
    job.create()
    rows = views.device_events(spark, sf).drop("event_id")
    tables.append_table(rows, job.specs["events"])
    tables.append_table(rows.where("event_name = 'ota_status' AND decode_success"), job.specs["ota_status"])
    days = views.all_local_days(spark, sf)
    day = _before(views.all_days(spark, sf).hi, 1).strftime("%Y%m%d")
    job.session_sets(days)
    job.crash_counts(views.firmware_releases(spark, sf), days, "event_time")
    for _ in range(2):
        job.export_reports(f"{folder}/reports", day)
    return spark.table(f"{db}.vw_device_crash_rate")


def _crash_runs(spark: SparkSession, sf: str, order_by: str) -> DataFrame:
    """Crash counts from a table job run over the middle days, the days after them, the days before
    them (late, so that all that follows is run again) and two days in the middle once more."""
    db, _ = scratch(spark)
    job = device_tables.DeviceTables(spark, db)
    tables.append_table(views.device_events(spark, sf).drop("event_id"), job.specs["events"])
    days, releases = views.all_local_days(spark, sf), written(views.firmware_releases(spark, sf), "releases")
    third = max((days.hi - days.lo).days // 3, 1)
    a, b = _before(days.lo, -third), _before(days.lo, -2 * third)
    for window in (DateWindow(a, b), DateWindow(_before(b, -1), days.hi), DateWindow(days.lo, _before(a, 1)),
                   DateWindow(_before(b, 1), b)):
        job.crash_counts(releases, window, order_by)
    return job.table("crash_counts")


def crash_table_by_uptime(spark: SparkSession, sf: str) -> DataFrame:
    return _crash_runs(spark, sf, "uptime")


def crash_table_by_event_time(spark: SparkSession, sf: str) -> DataFrame:
    return _crash_runs(spark, sf, "event_time")


def export_user_active(spark: SparkSession, sf: str) -> DataFrame:
    from pulsegrid.operators.retention import retention_curve

    days, last, _ = _days(spark, sf)
    users = daily_activity.user_daily_by_ingest_date(views.app_ods(spark, sf, days), days)
    curves = retention_curve(users, DateWindow(_before(last, 3), last))
    return app_tables.export_user_active(curves, last)


def export_product_active(spark: SparkSession, sf: str) -> DataFrame:
    days, last, _ = _days(spark, sf)
    devices = daily_activity.product_daily_with_catalogue_names(views.app_ods(spark, sf, days), days)
    return app_tables.export_product_active(devices, last)


def stream_records(spark: SparkSession, sf: str) -> DataFrame:
    """App records arriving as text files in two deliveries, each followed by a run of the stream;
    rows per outcome of both."""
    _, folder = scratch(spark)
    lines = records.app_lines(spark, sf)
    for delivery in (0, 1):
        (lines.where(F.col("event_id") % 2 == delivery).select("value")
         .write.mode("append").text(f"{folder}/incoming"))
        ingest.ingest_stream(spark, f"{folder}/incoming", f"{folder}/out", f"{folder}/checkpoint",
                             contracts.APP).awaitTermination()
    return _outcomes(spark, folder)


def stream_two_checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    """App records in two deliveries, each taken in by a stream with a checkpoint of its own; rows per
    outcome of both."""
    _, folder = scratch(spark)
    lines = records.app_lines(spark, sf)
    for delivery in ("0", "1"):
        (lines.where(F.col("event_id") % 2 == int(delivery)).select("value")
         .write.text(f"{folder}/incoming{delivery}"))
        ingest.ingest_stream(spark, f"{folder}/incoming{delivery}", f"{folder}/out",
                             f"{folder}/checkpoint{delivery}", contracts.APP).awaitTermination()
    return _outcomes(spark, folder)


def _outcomes(spark: SparkSession, folder: str) -> DataFrame:
    good = spark.read.parquet(f"{folder}/out/records").groupBy(
        F.col("nova_event_name").alias("outcome")).agg(F.count(F.lit(1)).alias("n_rows"))
    bad = spark.read.json(f"{folder}/out/quarantine").groupBy(
        F.col("error_code").alias("outcome")).agg(F.count(F.lit(1)).alias("n_rows"))
    return good.unionByName(bad)


def retention_rerun_moved_cohort(spark: SparkSession, sf: str) -> DataFrame:
    """The retention table after a run without the first week's facts and a run with them: clients
    whose first day moved are in one cohort only."""
    db, _ = scratch(spark)
    days, last, span = _days(spark, sf)
    job = app_tables.AppTablesV1(spark, db, days.lo)
    facts = daily_activity.user_daily_by_ingest_date(views.app_ods(spark, sf, days), days)
    # the fact table takes clients with a name and an id, as the event table before it does
    known, _ = tables.split_required(facts, job.specs["user_daily"])
    for part in (known.where(F.col("partition_date") > F.lit(_before(days.lo, -7))), known):
        tables.full_refresh(part, job.specs["user_daily"])
        job.retention(last, span)
    return job.table("retention")


def stream_first_copy(spark: SparkSession, sf: str) -> DataFrame:
    """Events and late copies of every seventh of them, deduplicated as a stream of files."""
    _, folder = scratch(spark)
    events = views.base_events(spark, sf).select("event_id", "ts", "event_type")
    copies = events.unionByName(events.where("event_id % 7 = 0"))
    copies.write.parquet(f"{folder}/incoming")
    source = readers.stream_new_files(spark, f"{folder}/incoming", copies.schema, fmt="parquet")
    (ingest.first_copy_stream(source, "event_id", "ts", "40 days")
     .writeStream.format("parquet").option("path", f"{folder}/out")
     .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
     .start().awaitTermination())
    return spark.read.parquet(f"{folder}/out")


def quarantine_files(spark: SparkSession, sf: str) -> DataFrame:
    """Bad device records written under their stream's prefix; files read back."""
    _, folder = scratch(spark)
    judged = contracts.validate_records(records.device_lines(spark, sf), contracts.DEVICE)
    exports.write_quarantine(contracts.failures(judged, keep=("event_id",)), f"{folder}/bad", "device")
    return spark.read.json(f"{folder}/bad").select(
        F.col("event_id"), "error_code", "stream_type", F.col("raw"))


QUERIES = {f.__name__: f for f in (
    audited_write, active_clients_sketched, widened_table,
    app_v1_rejected, retention_day_by_day, daily_active_table_v1, daily_active_table_v2, merge_touched_files,
    device_stream_retry, crash_table_by_uptime, crash_table_by_event_time,
    app_v1_tables, window_replace, merge_session_counts, rolling_pairing_state, backfill_v2,
    device_ingest, report_files, export_user_active, export_product_active, stream_records,
    stream_two_checkpoints, retention_rerun_moved_cohort, stream_first_copy, quarantine_files)}
