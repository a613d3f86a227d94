"""Table jobs of the app warehouse. Each reads its inputs, computes one table and replaces exactly
the part of it that it recomputed; running a job twice gives the same table."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.values import EVENT_REGISTRY, FIRST_PARTITION_DATE, LEGACY_TABLE, RETENTION_DAYS
from pulsegrid.operators import activity, audience, daily_activity, landing, pairings, retention
from pulsegrid.operators.date_windows import DateWindow, backfill_window, event_window
from pulsegrid.plans import schemas
from pulsegrid.sources import exports, scratch, tables
from pulsegrid.sources.tables import WriteReport


class AppTablesV1:
    """First generation: one landing table, facts by ingest date."""

    def __init__(self, spark: SparkSession, database: str, floor: str | dt.date = FIRST_PARTITION_DATE):
        self.spark = spark
        self.specs = schemas.app_v1(database)
        self.floor = floor

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.specs[name].name)

    def _window(self, ds, days: int) -> DateWindow:
        return backfill_window(ds, days, self.floor)

    def load(self, flat: DataFrame, ds: str | dt.date, days: int, received_at: Column) -> WriteReport:
        """Refill staging from the landing table and replace the window's deduplicated events.

        Both steps use one window; deleting a window other than the one loaded loses rows. Rows that
        lack a column the event table needs go to ``events_rejected`` instead, with its name.
        """
        window = self._window(ds, days)
        tables.full_refresh(landing.load_app_events(flat, window, received_at), self.specs["staging"])
        spec = self.specs["events"]
        with scratch.kept(landing.first_copy(self.table("staging")), "first-copies") as rows:
            good, bad = tables.split_required(rows, spec)
            tables.replace_window(bad, self.specs["events_rejected"], window)
            return tables.replace_window(good, spec, window)

    def user_daily(self, ds: str | dt.date, days: int) -> WriteReport:
        window = self._window(ds, days)
        return tables.replace_window(
            daily_activity.user_daily_by_ingest_date(self.table("events"), window),
            self.specs["user_daily"], window)

    def product_daily(self, ds: str | dt.date, days: int) -> WriteReport:
        window = self._window(ds, days)
        return tables.replace_window(
            daily_activity.product_daily_with_catalogue_names(self.table("events"), window),
            self.specs["product_daily"], window)

    def pairings(self, products: DataFrame) -> WriteReport:
        return tables.full_refresh(
            pairings.latest_pairings(self.table("user_daily"), products), self.specs["pairings"])

    def activity(self, ds: str | dt.date, days: int) -> WriteReport:
        """Replace the window's days in the activity bits; all days up to it if there are none yet."""
        spec, window = self.specs["activity"], self._window(ds, days)
        tables.create_table(self.spark, spec)
        if not tables.partitions(self.spark, spec):
            first = self.table("user_daily").agg(F.min("partition_date")).first()[0]
            window = DateWindow(min(first or window.lo, window.lo), window.hi)
        reached = activity.months(window)
        bits = activity.replace_days(self.table("activity").where(reached.holds("month")),
                                     activity.day_bits(self.table("user_daily"), window), window)
        return tables.replace_window(bits, spec, reached)

    def retention(self, ds: str | dt.date, days: int) -> WriteReport:
        """Bring the activity bits up to date, then replace the curves the window can have changed.

        These are the cohorts with activity in the window, with a stored figure in it, and, as late
        facts can move a client to an earlier cohort, stored cohorts that a client active in the
        window may have left; cohorts nobody is left in go. Facts are read for the window alone: all
        other days come from the bits.
        """
        spec, window = self.specs["retention"], self._window(ds, days)
        keys = ("cohort_date", "client_name", "product_id")
        tables.create_table(self.spark, spec)
        self.activity(ds, days)
        bits = self.table("activity").where(F.col("month") <= F.lit(window.hi))
        stored = self.spark.table(spec.name).select(*keys, "partition_date")
        touched = stored.where(window.holds("cohort_date") | window.holds("partition_date")).select(*keys)
        left = stored.select(*keys).distinct().join(
            activity.visited_cohorts(bits, window), list(keys), "left_semi")
        # the bits are read once for both: cells are few, a row per cohort and date
        with scratch.kept(activity.cohort_cells(bits, window), "cells") as cells:
            reached = cells.where("_affected").select(*keys)
            with scratch.kept(reached.unionByName(left).unionByName(touched).distinct(), "affected") as affected:
                fresh = retention.curve_of_cells(cells.withColumn("_affected", F.lit(True))).join(
                    affected, list(keys), "left_semi")
                return tables.replace_keys(fresh, spec, keys, affected)

    def daily_active(self, products: DataFrame, ds: str | dt.date, days: int) -> WriteReport:
        """Replace the window's daily active users; see ``_daily_active``."""
        return _daily_active(
            self.spark, self.specs, self.table("user_daily"), self.table("product_daily"),
            self.table("pairings"), products, self._window(ds, days), "partition_date", True)

    def run(self, flat: DataFrame, products: DataFrame, ds: str | dt.date, days: int,
            received_at: Column) -> dict[str, WriteReport]:
        return {
            "events": self.load(flat, ds, days, received_at),
            "user_daily": self.user_daily(ds, days),
            "product_daily": self.product_daily(ds, days),
            "pairings": self.pairings(products),
            "retention": self.retention(ds, days),
        }


class AppTablesV2:
    """Second generation: one table per event type, facts by local date, rolling pairings."""

    def __init__(self, spark: SparkSession, database: str, source_schema: str = "analytics_source",
                 floor: str = FIRST_PARTITION_DATE):
        self.spark = spark
        self.specs = schemas.app_v2(database)
        self.source_schema = source_schema
        self.floor = floor

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.specs[name].name)

    def _window(self, ds, days: int) -> DateWindow:
        return backfill_window(ds, days, self.floor)

    def load(self, read: Callable[[str], DataFrame], ds: str | dt.date, days: int = 1,
             legacy: DataFrame | None = None, read_dev: Callable[[str], DataFrame] | None = None,
             event: str | None = None, per_event: Mapping[str, int] | None = None
             ) -> list[WriteReport]:
        """Replace per event type exactly the dates read for it.

        Event types with equal windows are written together. With ``event`` only that type is
        touched, in both record generations.
        """
        groups: dict[DateWindow, list[str]] = defaultdict(list)
        for name in EVENT_REGISTRY:
            if event in (None, name):
                groups[event_window(name, ds, days, per_event, floor=self.floor)].append(name)
        common = self._window(ds, days)
        reports = []
        for window, names in groups.items():
            legs = landing.union_events(
                read, lambda _: window, self.source_schema, read_dev=read_dev,
                registry={n: EVENT_REGISTRY[n] for n in names})
            reports.append(tables.replace_window(
                legs, self.specs["events"], window, {"source_table": names}))
        if legacy is not None:
            rows = landing.select_legacy(legacy, common, self.source_schema, event)
            scope = {"source_table": LEGACY_TABLE, **({"event_name": event} if event else {})}
            reports.append(tables.replace_window(rows, self.specs["events"], common, scope))
        if not reports:
            raise ValueError(f"unknown event {event!r}")
        return reports

    def user_daily(self, ds: str | dt.date, days: int = 1) -> WriteReport:
        window = self._window(ds, days)
        return tables.replace_window(
            daily_activity.user_daily_by_local_date(self.table("events"), window),
            self.specs["user_daily"], window)

    def product_daily(self, ds: str | dt.date, days: int = 1) -> WriteReport:
        window = self._window(ds, days)
        return tables.replace_window(
            daily_activity.product_daily(self.table("events"), window),
            self.specs["product_daily"], window)

    def pairings(self, products: DataFrame, ds: str | dt.date, days: int = 0) -> WriteReport:
        """Merge the pairings of ``ds`` and the ``days`` before it into the state, in one pass."""
        today = pairings.window_pairings(self.table("events"), products, self._window(ds, days))
        return tables.snapshot_then_replace(
            self.spark, self.specs["pairings"], ds,
            lambda old: pairings.roll_pairings(today, old, ds))

    def current_pairings(self) -> DataFrame:
        return tables.current_state(self.spark, self.specs["pairings"])

    def retention(self, ds: str | dt.date, days: int = 1, settled: bool = False) -> WriteReport:
        """Replace the cohorts of the window; ``settled`` also those of the seven days before, whose
        day-7 figures only now are known."""
        window = self._window(ds, days)
        rows = retention.retention_by_day(
            self.table("user_daily"), self.current_pairings(), window, settled, ds)
        replaced = window.earlier(max(RETENTION_DAYS)) if settled else window
        return tables.replace_window(rows, self.specs["retention"], replaced)

    def daily_active(self, products: DataFrame, ds: str | dt.date, days: int = 1) -> WriteReport:
        """Replace the daily active users of the window's local dates; see ``_daily_active``.

        A local date's facts arrive on it or on the day before."""
        window = self._window(ds, days)
        arrived = window.earlier(1).holds("partition_date")
        return _daily_active(
            self.spark, self.specs, self.table("user_daily").where(arrived),
            self.table("product_daily").where(arrived), self.current_pairings(), products, window,
            "event_local_date", False)

    def backfill(self, read: Callable[[str], DataFrame], products: DataFrame, ds: str | dt.date,
                 days: int = 1, legacy: DataFrame | None = None, event: str | None = None,
                 per_event: Mapping[str, int] | None = None, settled: bool = True
                 ) -> dict[str, object]:
        """Rebuild every table for a window, optionally from one reloaded event type."""
        return {
            "events": self.load(read, ds, days, legacy, event=event, per_event=per_event),
            "user_daily": self.user_daily(ds, days),
            "product_daily": self.product_daily(ds, days),
            "pairings": self.pairings(products, ds, days),
            "retention": self.retention(ds, days, settled),
        }


def _daily_active(spark: SparkSession, specs: Mapping[str, tables.TableSpec], users: DataFrame,
                  devices: DataFrame, pairs: DataFrame, products: DataFrame, window: DateWindow,
                  date: str, name_before_grouping: bool) -> WriteReport:
    """Replace the window's rows of the daily-active table, from its own facts and the state of who was
    seen before.

    The state has a row per client and product, under its first date; a window replaces the state of
    its own dates and reads that of the dates before, so runs are repeatable. A window that ends
    before the state does is refused: it can make first dates earlier and totals larger on all later
    dates, so these have to be in the window too.
    """
    state = specs["first_seen"]
    tables.create_table(spark, state)
    stored = [p[0] for p in tables.partitions(spark, state) if p[0]]
    if max(stored, default=window.hi) > window.hi:
        raise ValueError(f"{state.name} has later dates than {window.hi}: run up to {max(stored)}")
    before = spark.table(state.name).where(F.col("first_date") < F.lit(window.lo))
    own, own_devices = users.where(window.holds(date)), devices.where(window.holds(date))
    seen = audience.seen_users(own, pairs, date, name_before_grouping, before)
    with scratch.kept(seen, "seen-users") as seen:
        rows = audience.daily_active_users(own, own_devices, pairs, products, date, name_before_grouping,
                                           first_seen=before, seen=seen)
        report = tables.replace_window(rows, specs["daily_active"], window)
        tables.replace_window(audience.first_seen_of(seen), state, window)
    return report


def daily_active_view(spark: SparkSession, spec: tables.TableSpec, name: str) -> None:
    """The daily-active table as a stored view, newest dates first."""
    columns = ("report_date", *(c for c in spec.schema.names if c != "report_date"))
    exports.create_stored_view(spark, name, spec.name, {c: f"`{c}`" for c in columns},
                               order_by=("report_date DESC", "product_name", "client_variant"))


def export_user_active(retention_table: DataFrame, ds: str | dt.date) -> DataFrame:
    """The day's rows of the retention table, as exported to the reporting database."""
    return _export(retention_table, ds, (
        "cohort_date", "partition_date", "days_since_cohort", "client_name", "product_id",
        "cohort_size", "retained_users", "retention_rate"),
        ("cohort_date", "client_name", "product_id"))


def export_product_active(product_daily: DataFrame, ds: str | dt.date) -> DataFrame:
    return _export(product_daily, ds, (
        "event_local_date", "product_guid", "product_id", "product_name", "firmware_version",
        "client_variant", "first_seen_ts", "last_seen_ts", "active_user_count", "event_count",
        "partition_date"), ("product_guid",))


def _export(table: DataFrame, ds, columns, order) -> DataFrame:
    day = backfill_window(ds, 0)
    return (table.where(day.holds("partition_date")).select(*columns)
            .withColumn("business_date", F.col("partition_date")).orderBy(*order))
