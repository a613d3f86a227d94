"""Data checks. Every check is a frame of result rows; ``assert_checks`` turns them into an error."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.values import DAY_RATIO_BOUNDS
from pulsegrid.operators.date_windows import as_date

PASS = "PASS"


class CheckFailed(Exception):
    """At least one check did not pass."""


def _day_counts(table: DataFrame, ds: str | dt.date, date: str) -> DataFrame:
    """Row counts of ``ds`` and the day before in one pass over those two dates."""
    day = as_date(ds)
    before = day - dt.timedelta(days=1)
    return table.where(F.col(date).isin(day, before)).agg(
        F.count_if(F.col(date) == F.lit(day)).alias("today_rows"),
        F.count_if(F.col(date) == F.lit(before)).alias("yesterday_rows"),
    )


def _result(counts: DataFrame, check: str, name: str, ds, status: Column) -> DataFrame:
    ratio = F.round(F.try_divide(F.col("today_rows").cast("double"), F.col("yesterday_rows")), 4)
    return counts.select(
        F.lit(check).alias("check_name"), F.lit(name).alias("table_name"),
        F.lit(as_date(ds)).alias("check_date"),
        "today_rows", "yesterday_rows", ratio.alias("day_ratio"), status.alias("status"),
    )


def _ratio_status() -> Column:
    ratio = F.try_divide(F.col("today_rows").cast("double"), F.col("yesterday_rows"))
    low, high = DAY_RATIO_BOUNDS
    return F.when(
        (F.col("yesterday_rows") > 0) & ~ratio.between(low, high),
        F.concat(F.lit("FAIL: day-over-day ratio out of bounds ("),
                 F.round(ratio, 2).cast("string"), F.lit("x)")),
    ).otherwise(PASS)


def check_non_zero(table: DataFrame, name: str, ds: str | dt.date,
                   date: str = "partition_date") -> DataFrame:
    """Rows were delivered for ``ds``."""
    status = F.when(F.col("today_rows") == 0, "FAIL: zero rows for business date").otherwise(PASS)
    return _result(_day_counts(table, ds, date), "non_zero_delivery", name, ds, status)


def check_day_ratio(table: DataFrame, name: str, ds: str | dt.date,
                    date: str = "partition_date") -> DataFrame:
    """Today's rows are half to double of yesterday's; a missing yesterday passes."""
    return _result(_day_counts(table, ds, date), "day_volume_ratio", name, ds, _ratio_status())


def check_report_rows(table: DataFrame, name: str, ds: str | dt.date,
                      date: str = "partition_date") -> DataFrame:
    """Both of the above for a report table."""
    status = F.when(F.col("today_rows") == 0, "FAIL: zero rows for business date").otherwise(
        _ratio_status())
    return _result(_day_counts(table, ds, date), "report_rows", name, ds, status)


def _violations(frame: DataFrame, check: str, name: str, column: str) -> DataFrame:
    return frame.select(
        F.lit(check).alias("check_name"), F.lit(name).alias("table_name"),
        F.lit(column).alias("column_name"), F.col("n").cast("long").alias("violations"),
        F.when(F.col("n") > 0, "FAIL").otherwise(PASS).alias("status"),
    )


def check_not_null(table: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Null count of every column, all in one pass."""
    counts = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in columns])
    rows = counts.select(F.inline(pairs))
    return rows.select(
        F.lit("not_null").alias("check_name"), F.lit(name).alias("table_name"), "column_name",
        F.col("n").alias("violations"),
        F.when(F.col("n") > 0, "FAIL").otherwise(PASS).alias("status"),
    )


def check_export_rows(table: DataFrame, name: str, ds: str | dt.date,
                      required: Sequence[str] = ("business_date", "client_id", "product_id"),
                      date: str = "business_date") -> DataFrame:
    """Required columns of an export hold no nulls on ``ds``; a column the export lacks counts as
    null in every row, and as one violation at least."""
    rows = table.where(F.col(date) == F.lit(as_date(ds)))
    lacking = [c for c in required if c not in table.columns]
    found = check_not_null(rows.withColumns({c: F.lit(None) for c in lacking}), name, list(required))
    worst = F.when(F.col("column_name").isin(lacking), F.greatest("violations", F.lit(1))).otherwise(
        F.col("violations"))
    return found.withColumn("violations", worst).withColumn(
        "status", F.when(F.col("violations") > 0, "FAIL").otherwise(F.col("status")))


def check_unique(table: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Number of key values that occur more than once (null keys are left out)."""
    keys = table.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    repeated = keys.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.count_if(F.col("_n") > 1).alias("n"))
    return _violations(repeated, "unique", name, ",".join(columns))


def check_accepted_values(table: DataFrame, name: str, column: str, values: Iterable) -> DataFrame:
    bad = table.agg(F.count_if(~F.col(column).isin(*values)).alias("n"))
    return _violations(bad, "accepted_values", name, column)


def check_relationship(table: DataFrame, name: str, column: str, parent: DataFrame,
                       parent_column: str) -> DataFrame:
    """Rows whose non-null ``column`` has no parent. Values are counted before the anti join."""
    values = table.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("_n"))
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    orphans = values.join(known, column, "left_anti").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))
    return _violations(orphans, "relationship", name, column)


def failing(results: DataFrame) -> DataFrame:
    return results.where(F.col("status") != PASS)


def assert_checks(*results: DataFrame) -> None:
    """Raise with the failing rows; each result frame holds a handful of aggregate rows."""
    rows = [row.asDict() for frame in results for row in failing(frame).collect()]
    if rows:
        raise CheckFailed("; ".join(str(r) for r in rows))
