"""Retention: full curves of first-day cohorts, and day-N rates of daily-active cohorts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.values import RETENTION_DAYS, UNKNOWN
from pulsegrid.operators.date_windows import DateWindow, as_date


def retention_curve(user_daily: DataFrame, window: DateWindow) -> DataFrame:
    """Cohort size, users retained and rate for every later date of the affected cohorts.

    A cohort is (first active date, app name, product); it is affected if one of its members was
    active in ``window``. A member counts as retained on a date it used the app with any product,
    up to ``window.hi``. Cohorts without a product drop out.

    One pass, no joins: user rows are cut to one per client, name, product and date, so what
    meets per client is bounded by dates times products however many rows it has. Each client and
    product then carries the client's dates, which are unfolded and counted. Every member is
    active on its cohort date, so the count on that date is the cohort's size.
    """
    client = ("client_id", "client_name")
    cohort = ("cohort_date", "client_name", "product_id")
    days = (
        user_daily.where(F.col("client_id").isNotNull() & F.col("client_name").isNotNull())
        .select(*client, "product_id", "partition_date").distinct()
    )
    of_client = Window.partitionBy(*client)
    members = (
        days
        .withColumn("cohort_date",
                    F.min("partition_date").over(Window.partitionBy(*client, "product_id")))
        .withColumn("_dates", F.collect_set("partition_date").over(of_client))
        .withColumn("_affected", F.max(window.holds("partition_date")).over(of_client))
        .where((F.col("partition_date") == F.col("cohort_date")) & F.col("product_id").isNotNull())
    )
    later = F.filter("_dates", lambda d: (d >= F.col("cohort_date")) & (d <= F.lit(window.hi)))
    grid = (
        members.select(*cohort, "_affected", F.explode(later).alias("partition_date"))
        .groupBy(*cohort, "partition_date")
        .agg(F.count(F.lit(1)).alias("retained_users"), F.max("_affected").alias("_affected"))
    )
    return curve_of_cells(grid)


def curve_of_cells(grid: DataFrame) -> DataFrame:
    """Curves from counts per cohort and date; cohorts without an ``_affected`` cell are left out."""
    cohort = ("cohort_date", "client_name", "product_id")
    whole = Window.partitionBy(*cohort)
    first_day = F.col("partition_date") == F.col("cohort_date")
    grid = (
        grid.withColumn("cohort_size", F.max(F.when(first_day, F.col("retained_users"))).over(whole))
        .withColumn("_affected", F.max("_affected").over(whole))
        .where("_affected")
    )
    rate = F.round(F.try_divide(F.col("retained_users").cast("decimal(18,0)"),
                                F.col("cohort_size").cast("decimal(18,0)")), 4)
    return grid.select(
        "cohort_date", "partition_date",
        F.datediff("partition_date", "cohort_date").alias("days_since_cohort"),
        "client_name", "product_id", "cohort_size", "retained_users",
        rate.cast("decimal(7,4)").alias("retention_rate"),
    )


def visited_cohorts(user_daily: DataFrame, window: DateWindow) -> DataFrame:
    """Every cohort that a client active in ``window`` can belong to or have belonged to: one for each
    date it used a product."""
    client = ("client_id", "client_name")
    days = user_daily.where(F.col("client_id").isNotNull() & F.col("client_name").isNotNull())
    active = days.where(window.holds("partition_date")).select(*client).distinct()
    return days.join(active, list(client), "left_semi").select(
        F.col("partition_date").alias("cohort_date"), "client_name", "product_id").distinct()


def retention_by_day(user_daily: DataFrame, pairings: DataFrame, window: DateWindow,
                     settled: bool = False, ds: str | dt.date | None = None) -> DataFrame:
    """Users of a day, and how many of them came back 1, 2, 3 and 7 days later.

    Cohort dates lie in ``window``; a user paired with two products counts for both, and coming
    back under another variant counts. By default days that have not happened yet count as zero
    and only the window's own cohorts are given. ``settled`` also recomputes the cohorts of the
    seven days before, and leaves days after ``window.hi`` null.

    One window over a client's few distinct dates replaces four self-joins. Facts and pairings are
    dealt by client once and joined there, so neither is sent through the driver: the facts of a
    client are bounded by dates, variants and versions, its pairings by variants and products.
    """
    reach = max(RETENTION_DAYS)
    cohorts = window.earlier(reach) if settled else window
    ds = as_date(ds) if ds is not None else window.hi
    per_client = Window.partitionBy("client_id")
    visits = (
        user_daily.where(window.earlier(reach + (reach if settled else 0)).holds("partition_date")
                         & (F.coalesce("client_id", F.lit("")) != ""))
        .select("client_id", "client_variant", "event_local_date").repartition("client_id").distinct()
        .withColumn("_dates", F.collect_set("event_local_date").over(per_client))
        .where(cohorts.holds("event_local_date"))
    )
    back = {n: F.array_contains("_dates", F.date_add("event_local_date", n)) for n in RETENTION_DAYS}
    visits = visits.select("client_id", "client_variant", "event_local_date",
                           *[back[n].alias(f"_d{n}") for n in RETENTION_DAYS])
    unnamed = F.coalesce("product_name", F.lit(UNKNOWN)).alias("product_name")
    names = pairings.groupBy("client_id").agg(F.collect_set(F.struct("client_variant", unnamed)).alias("_names"))
    own = F.filter("_names", lambda n: n["client_variant"] == F.col("client_variant"))
    users = visits.join(names.hint("merge"), "client_id", "left").withColumn("_name", F.explode_outer(own)).withColumn(
        "product_name", F.coalesce("_name.product_name", F.lit(UNKNOWN)))
    counts = users.groupBy(F.col("event_local_date").alias("cohort_date"), "product_name",
                           "client_variant").agg(
        F.count(F.lit(1)).alias("d0_users"),
        *[F.count_if(f"_d{n}").alias(f"d{n}_users") for n in RETENTION_DAYS],
    )
    for n in RETENTION_DAYS if settled else ():
        due = F.date_add("cohort_date", n) <= F.lit(window.hi)
        counts = counts.withColumn(f"d{n}_users", F.when(due, F.col(f"d{n}_users")))
    rate = {n: F.round(F.try_divide(F.col(f"d{n}_users").cast("double"), F.col("d0_users")), 4)
            for n in (1, 7)}
    return counts.select(
        "cohort_date", "product_name", "client_variant", "d0_users",
        *[f"d{n}_users" for n in RETENTION_DAYS],
        *[rate[n].alias(f"d{n}_retention_rate") for n in (1, 7)],
        F.lit(ds).alias("partition_date"),
    )
