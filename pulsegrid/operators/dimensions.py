"""Calendar, device-model and product dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.times import months_between_calendar
from pulsegrid.functions.values import (
    ACTIVE_MODEL_DAYS,
    MODEL_PREFIXES,
    OTHER_MODEL,
    PRODUCTS_V1,
    PRODUCTS_V2,
)
from pulsegrid.operators.date_windows import as_date
from pulsegrid.operators.numbering import numbered

_V1_SCHEMA = ("product_id string, product_guid string, product_name string, "
              "product_category string, product_line string, launch_date date, is_active boolean")
_V2_SCHEMA = ("product_id int, product_code string, product_name string, product_category string, "
              "launch_date date, is_active boolean, product_guid string")


def calendar(anchor: DataFrame, years: int = 4) -> DataFrame:
    """Every day within ``years`` years of the date in the one-row frame ``anchor`` (first column).

    Both ends are included. Fiscal columns equal the calendar ones; Sunday is day 0; names are
    not blank-padded.
    """
    (name,) = anchor.columns[:1]
    centre = F.col(name)
    days = anchor.select(F.explode(F.sequence(
        F.add_months(centre, -12 * years), F.add_months(centre, 12 * years))).alias("full_date"))
    d = F.col("full_date")
    dow = F.dayofweek(d) - 1
    small = lambda c: c.cast("smallint")
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        d,
        small(F.year(d)).alias("year"),
        small(F.quarter(d)).alias("quarter"),
        small(F.month(d)).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        small(F.weekofyear(d)).alias("week_of_year"),
        small(F.dayofyear(d)).alias("day_of_year"),
        small(F.dayofmonth(d)).alias("day_of_month"),
        small(dow).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.isin(0, 6).alias("is_weekend"),
        (~dow.isin(0, 6)).alias("is_weekday"),
        small(F.year(d)).alias("fiscal_year"),
        small(F.quarter(d)).alias("fiscal_quarter"),
    )


def calendar_around(spark: SparkSession, ds: str | dt.date, years: int = 4) -> DataFrame:
    return calendar(spark.range(1).select(F.lit(as_date(ds)).alias("ds")), years)


def device_models(events: DataFrame, ds: str | dt.date, model: str = "client_os_name",
                  numeric_versions: bool = False) -> DataFrame:
    """Device models with version bounds, first and last date, activity flag and a key.

    ``model`` is the column holding the model. Version bounds compare as text ('9' > '17') unless
    ``numeric_versions``, which compares them part by part as numbers. The key numbers all models
    in the order of platform, manufacturer and name; models are written once for that.
    """
    seen = (
        events.where(F.col(model) != "")
        .groupBy(F.col(model).alias("device_model_name"), "client_os_version")
        .agg(F.min("partition_date").alias("first_seen_date"),
             F.max("partition_date").alias("last_seen_date"))
    )
    name = F.col("device_model_name")
    version = F.col("client_os_version")
    low, high = F.min(version), F.max(version)
    if numeric_versions:
        parts = F.transform(F.split(version, r"\."), lambda x: x.try_cast("bigint"))
        low, high = F.min_by(version, parts), F.max_by(version, parts)
    manufacturer, platform = _by_prefix(name, 0), _by_prefix(name, 1)
    models = seen.groupBy("device_model_name").agg(
        low.alias("os_version_min"), high.alias("os_version_max"),
        F.min("first_seen_date").alias("first_seen_date"),
        F.max("last_seen_date").alias("last_seen_date"),
    )
    keyed = numbered(
        models.withColumn("manufacturer", manufacturer).withColumn("platform", platform),
        ("platform", "manufacturer", "device_model_name"), "_key")
    return keyed.select(
        F.col("_key").cast("int").alias("device_model_key"),
        "device_model_name", "manufacturer", "platform", "os_version_min", "os_version_max",
        "first_seen_date", "last_seen_date",
        (F.col("last_seen_date") >= F.date_sub(F.lit(as_date(ds)), ACTIVE_MODEL_DAYS))
        .alias("is_active"),
    )


def _by_prefix(name: Column, position: int) -> Column:
    found = F.lit(OTHER_MODEL[position])
    for prefix, values in reversed(MODEL_PREFIXES.items()):
        found = F.when(name.ilike(f"{prefix}%"), F.lit(values[position])).otherwise(found)
    return found


def literal_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """Rows written in code, as a table; date texts are cast."""
    names = [f.strip().split(" ") for f in schema.split(",")]
    text = ", ".join(f"{n} {'string' if t == 'date' else t}" for n, t in names)
    frame = spark.createDataFrame(list(rows), text)
    return frame.select(*[F.col(n).cast(t).alias(n) for n, t in names])


def product_catalogue_v1(spark: SparkSession) -> DataFrame:
    return literal_table(spark, PRODUCTS_V1, _V1_SCHEMA)


def product_catalogue_v2(spark: SparkSession, ds: str | dt.date) -> DataFrame:
    return with_lifecycle(literal_table(spark, PRODUCTS_V2, _V2_SCHEMA), ds)


def with_lifecycle(products: DataFrame, ds: str | dt.date) -> DataFrame:
    """Months since launch and lifecycle status of a product table."""
    return (
        products
        .withColumn("months_since_launch",
                    months_between_calendar(F.col("launch_date"), F.lit(as_date(ds))))
        .withColumn("lifecycle_status",
                    F.when(F.col("is_active"), "Active").otherwise("End of Life"))
    )


def active_products(products: DataFrame) -> DataFrame:
    """Active products only. No broadcast hint: Spark broadcasts it when its size allows."""
    return products.where(F.col("is_active") == F.lit(True))
