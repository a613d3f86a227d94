"""Table jobs of the device warehouse."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.values import SUBJECT_TABLES
from pulsegrid.operators import device_events, device_marts, device_reports
from pulsegrid.operators.date_windows import DateWindow, as_date
from pulsegrid.plans import schemas
from pulsegrid.sources import exports, publish, scratch, tables
from pulsegrid.sources.publish import BatchLedger
from pulsegrid.sources.tables import WriteReport


_ROUTE = "_route"


def _decoded(records: DataFrame, registry: DataFrame, batch: str) -> DataFrame:
    """Decoded and enriched records of a batch, each with the target it has besides the event table:
    ``invalid``, the kind of its subject table, or ``other``."""
    ok = F.coalesce(F.col("decode_success"), F.lit(False))
    route = F.when(~ok, "invalid").when(F.col("event_name").isin(*SUBJECT_TABLES), F.col("event_name")).otherwise("other")
    return device_events.enrich(device_events.decode_payload(device_events.flatten_raw(records), registry)).withColumns(
        {"ingest_batch": F.lit(batch), _ROUTE: route})


class DeviceTables:
    def __init__(self, spark: SparkSession, database: str):
        self.spark = spark
        self.database = database
        self.specs = schemas.device(database)

    def table(self, name: str) -> DataFrame:
        """The table as it is now; a stream writes from a session of its own, whose commits this
        session's cached file listing does not show."""
        self.spark.catalog.refreshTable(self.specs[name].name)
        return self.spark.table(self.specs[name].name)

    def create(self) -> None:
        for spec in self.specs.values():
            tables.create_table(self.spark, spec)

    def ingest(self, records: DataFrame, registry: DataFrame, batch: str,
               written: Callable[[str], None] = lambda table: None) -> dict[str, WriteReport]:
        """Decode raw records and append them to the event, invalid and subject tables.

        The decoded batch is written once and read back for each target, so payloads are decoded
        once and a lost executor does not send them through Python again. The event table keeps
        undecodable rows too, as the invalid table does. Rows carry ``batch`` as their
        ``ingest_batch``. ``written`` is told each target once its rows are in.
        """
        self.create()
        with scratch.kept(_decoded(records, registry, batch), "device-batch", (_ROUTE,)) as rows:
            reports = {}
            for target in self.INGEST_TARGETS:
                reports[target] = self._append(rows, target)
                written(target)
            return reports

    def _append(self, decoded: DataFrame, target: str) -> WriteReport:
        part = decoded if target == "events" else decoded.where(F.col(_ROUTE) == target)
        return tables.append_table(part.drop(_ROUTE), self.specs[target])

    INGEST_TARGETS = ("events", "invalid", *SUBJECT_TABLES)

    def ledger(self) -> BatchLedger:
        """The ledger of batches, beside the tables."""
        return BatchLedger(self.spark, f"{publish.location(self.spark, self.specs['events'].name)}_batches")

    def ingest_once(self, records: DataFrame, registry: DataFrame, query: str, batch: int,
                    written: Callable[[str], None] = lambda table: None) -> dict[str, WriteReport]:
        """``ingest`` of a numbered batch whose rows are in all six tables exactly once, however often
        it is begun.

        The ledger tells a batch that is done, which is left alone, from one that was started. The
        decoded rows of the latter stay beside the ledger until it is done: a further attempt takes
        them instead of decoding again, so that all targets hold what one decoding gave, and goes on
        with the first target that is not known to be complete. Such a target may hold rows, so the
        batch's rows are deleted from it first, which rewrites only the files that hold some.
        ``written`` is told of complete targets in every attempt. Readers between a failure and the next
        run can see a batch in part. Gives the reports of the targets written by this attempt.
        """
        self.create()
        ledger, key = self.ledger(), f"{query}/{batch}"
        state = ledger.state(query, batch)
        if state == "done":
            return {}
        ledger.start(query, batch)
        folder, reports = ledger.rows(query, batch), {}
        rows = _decoded(records, registry, key)
        if not ledger.passed(query, batch, "decoded"):
            rows.write.mode("overwrite").partitionBy(_ROUTE).parquet(folder)
            ledger.passes(query, batch, "decoded")
        rows = self.spark.read.schema(rows.schema).parquet(folder)
        for target in self.INGEST_TARGETS:
            if not ledger.passed(query, batch, target):
                if state == "started":
                    tables.delete_rows(self.spark, self.specs[target], F.col("ingest_batch") == key)
                reports[target] = self._append(rows, target)
                ledger.passes(query, batch, target)
            written(target)
        ledger.done(query, batch)
        return reports

    def session_counts(self, kind: str, window: DateWindow) -> WriteReport:
        """Write the session counts of a subject table into its own rows."""
        column = {"reboot_info": "single_session_reboot_cnt",
                  "shutdown_reason": "single_session_shutdown_cnt"}[kind]
        counts = device_marts.session_event_counts(self.table(kind), window, column)
        return tables.merge_update(counts, self.specs[kind], device_marts.SESSION_DAY, [column], window)

    def session_sets(self, window: DateWindow) -> WriteReport:
        return tables.replace_window(
            device_marts.session_sets(self.table("events"), window),
            self.specs["session_sets"], window)

    def crash_counts(self, releases: DataFrame, window: DateWindow, order_by: str = "uptime"
                     ) -> WriteReport:
        """Replace the window's crash counts; they equal those of one run over all dates.

        The newest state before the window, with the events between the two, gives every device's
        last event before it; without a state the events before the window do. A window that lies
        before a stored state is run up to that state's date, since its events can be predecessors
        of later ones; states inside it are replaced by one at its end.
        """
        spec, events = self.specs["crash_state"], self.table("events")
        tables.create_table(self.spark, spec)
        known = sorted(d for d, order in tables.partitions(self.spark, spec) if order == order_by)
        before = [d for d in known if d < window.lo]
        window = DateWindow(window.lo, max([window.hi, *known]))
        between = DateWindow(before[-1] + dt.timedelta(days=1) if before else dt.date(1000, 1, 1),
                             window.lo - dt.timedelta(days=1))
        carried = device_marts.valid_events(events, between).select(*device_marts.STATE_COLUMNS)
        if before:
            state = self.table("crash_state").where(
                (F.col("state_date") == F.lit(before[-1])) & (F.col("order_by") == order_by))
            carried = carried.unionByName(state.select(*device_marts.STATE_COLUMNS))
        carried = scratch.written(device_marts.last_events(carried, order_by), "carried")
        counts = device_marts.crash_counts(events, window, order_by, carried=carried)
        report = tables.replace_window(
            device_marts.with_firmware_release(counts, releases), self.specs["crash_counts"], window)
        own = device_marts.valid_events(events, window).select(*device_marts.STATE_COLUMNS)
        last = device_marts.last_events(own.unionByName(carried), order_by)
        tables.replace_window(
            last.withColumns({"state_date": F.lit(window.hi), "order_by": F.lit(order_by)}), spec,
            window, {"order_by": order_by})
        return report

    def reports(self, day: str | dt.date) -> dict[str, DataFrame]:
        on = F.col("event_local_date") == F.lit(as_date(day))
        crashes, sessions = self.table("crash_counts").where(on), self.table("session_sets").where(on)
        return {
            "crash_rate": device_reports.crash_rate(crashes),
            "crash_count_daily": device_reports.crash_count_daily(crashes),
            "connectivity_rate_daily": device_reports.connectivity_rate_daily(sessions),
            "ota_rate": device_reports.ota_rate(self.table("ota_status").where(on)),
        }

    def export_reports(self, root: str, report_date: str, only: str | None = None,
                       register: bool = True) -> dict[str, int]:
        """Write the day's reports as files; ``register`` makes them catalogue partitions, each in one
        step once its files are complete."""
        day = dt.datetime.strptime(report_date, "%Y%m%d").date()
        reports: dict[str, Callable] = self.reports(day)
        if only is not None and only not in reports:
            raise ValueError(f"no report {only!r}; there are {', '.join(reports)}")
        rows = {}
        for name, frame in reports.items():
            if only not in (None, name):
                continue
            if register:
                rows[name] = exports.publish_report(
                    frame, f"{self.database}.vw_device_{name}", root, name, report_date)
            else:
                rows[name] = exports.export_parquet(frame, root, name, report_date)
        return rows
