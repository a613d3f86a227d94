"""Clients' active days as bits: a row per client, app, product and month instead of one per day,
version and operating system."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.operators.date_windows import DateWindow
from pulsegrid.operators.retention import curve_of_cells

CLIENT = ("client_id", "client_name")
KEY = ("month", *CLIENT, "product_id")


def months(window: DateWindow) -> DateWindow:
    """First day of the first to first day of the last month that a window reaches into."""
    return DateWindow(window.lo.replace(day=1), window.hi.replace(day=1))


def day_bits(user_daily: DataFrame, window: DateWindow) -> DataFrame:
    """``KEY`` and ``days``, the days of the window with activity, as bits from the first of the month
    up. Rows without a client or app name are left out; a missing product is a product of its own."""
    bit = F.expr("shiftleft(1L, day(partition_date) - 1)")
    rows = user_daily.where(window.holds("partition_date") & F.col("client_id").isNotNull()
                            & F.col("client_name").isNotNull())
    return (rows.withColumn("month", F.trunc("partition_date", "month"))
            .groupBy(*KEY).agg(F.bit_or(bit).alias("days")))


def window_bits(window: DateWindow) -> Column:
    """The bits of ``month`` that lie in the window; none for other months."""
    low = F.greatest(F.datediff(F.lit(window.lo), "month"), F.lit(0))
    high = F.least(F.datediff(F.lit(window.hi), "month"), F.lit(30))
    one = F.lit(1).cast("long")
    upto = F.call_function("shiftleft", one, high + 1) - F.call_function("shiftleft", one, low)
    return F.when(low <= high, upto).otherwise(F.lit(0).cast("long"))


def replace_days(stored: DataFrame, fresh: DataFrame, window: DateWindow) -> DataFrame:
    """Stored bits with those of the window's days replaced by the fresh ones; rows left without a day
    are gone."""
    outside = F.col("days").bitwiseAND(F.bitwise_not(window_bits(window)))
    both = stored.select(*KEY, outside.alias("days")).unionByName(fresh.select(*KEY, "days"))
    return both.groupBy(*KEY).agg(F.bit_or("days").alias("days")).where("days != 0")


def dates_of(month: str = "month", days: str = "days") -> Column:
    """The dates of set bits, as an array in order."""
    place = F.filter(F.sequence(F.lit(0), F.lit(30)), lambda i: F.getbit(F.col(days), i) == 1)
    return F.transform(place, lambda i: F.date_add(F.col(month), i))


def _of_clients(bits: DataFrame, window: DateWindow) -> DataFrame:
    """``bits`` and whether the row's client was active in the window (``_affected``). Rows are dealt by
    client once; what meets per client is a row per month and product."""
    active = F.col("days").bitwiseAND(window_bits(window)) != 0
    return bits.repartition(*CLIENT).withColumn("_affected", F.max(active).over(Window.partitionBy(*CLIENT)))


def visited_cohorts(bits: DataFrame, window: DateWindow) -> DataFrame:
    """Every cohort that a client active in the window can belong to or have belonged to."""
    days = _of_clients(bits, window).where("_affected").groupBy("month", "client_name", "product_id").agg(
        F.bit_or("days").alias("days"))
    return days.select(F.explode(dates_of()).alias("cohort_date"), "client_name", "product_id").distinct()


def cohort_cells(bits: DataFrame, window: DateWindow) -> DataFrame:
    """Users of every cohort retained on every date up to ``window.hi``, and whether the cohort has a
    member that was active in the window (``_affected``).

    What is shuffled per client is a row per month and product. Of these the one of the cohort's own
    month carries the client's months; days are counted bit by bit ahead of the shuffle, so dates
    appear only in the counts.
    """
    client = Window.partitionBy(*CLIENT)
    first = F.date_add("month", F.expr("bit_count((days & -days) - 1)").cast("int"))
    members = (
        _of_clients(bits, window)
        .withColumn("_any", F.bit_or("days").over(Window.partitionBy(*CLIENT, "month")))
        .withColumn("_months", F.collect_set(F.struct("month", F.col("_any").alias("days"))).over(client))
        .withColumn("_first", first)
        .withColumn("cohort_date", F.min("_first").over(Window.partitionBy(*CLIENT, "product_id")))
        .where((F.col("_first") == F.col("cohort_date")) & F.col("product_id").isNotNull()
               & (F.col("cohort_date") <= F.lit(window.hi))))
    cohort = ("cohort_date", "client_name", "product_id")
    met = members.select(*cohort, "_affected", F.explode("_months").alias("_m")).select(
        *cohort, "_affected", "_m.month", "_m.days")
    counts = met.groupBy(*cohort, "month").agg(
        *[F.sum(F.getbit("days", F.lit(i)).cast("long")).alias(f"_{i}") for i in range(31)],
        F.max("_affected").alias("_affected"))
    users = F.array(*[F.col(f"_{i}") for i in range(31)])
    return (counts.select(*cohort, "month", "_affected", F.posexplode(users).alias("_day", "retained_users"))
            .withColumn("partition_date", F.date_add("month", F.col("_day")))
            .where((F.col("retained_users") > 0) & (F.col("partition_date") >= F.col("cohort_date"))
                   & (F.col("partition_date") <= F.lit(window.hi)))
            .select(*cohort, "partition_date", "retained_users", "_affected"))


def retention_curve(bits: DataFrame, window: DateWindow) -> DataFrame:
    """``retention.retention_curve`` from bits: curves, up to ``window.hi``, of the cohorts with a member
    that was active in the window."""
    return curve_of_cells(cohort_cells(bits, window))
