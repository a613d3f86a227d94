"""Which client was last seen with which product."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.predicates import present
from pulsegrid.functions.values import UNKNOWN
from pulsegrid.operators.daily_activity import device_rows
from pulsegrid.operators.date_windows import as_date, DateWindow

_PAIR = ("client_variant", "client_id", "product_name", "product_guid")


def latest_pairings(user_daily: DataFrame, products: DataFrame) -> DataFrame:
    """Last active date of every client and product name found in the user facts.

    A product id missing from the catalogue keeps its row with a null guid.
    """
    catalogue = products.select("product_id", "product_guid")
    return (
        user_daily.where(present("product_name"))
        .join(catalogue, "product_id", "left")
        .groupBy(*_PAIR)
        .agg(F.max("partition_date").alias("last_active_dt"))
    )


def days_pairings(events: DataFrame, products: DataFrame, ds: str | dt.date) -> DataFrame:
    """Pairings seen on ``ds``, read from events that carry both a client and a device."""
    day = as_date(ds)
    return window_pairings(events, products, DateWindow(day, day))


def window_pairings(events: DataFrame, products: DataFrame, window: DateWindow) -> DataFrame:
    """Pairings seen on any date of the window, with the latest date of each.

    The user and device facts share no client key; joining them on date and variant would pair
    every user of a variant with every device of it. Rows without a variant pair with nothing.
    """
    seen = (
        events.where(device_rows(window) & present("client_id")
                     & F.col("client_variant").isNotNull())
        .groupBy("client_variant", "client_id", "product_guid")
        .agg(F.max("event_local_date").alias("last_active_dt"))
    )
    names = products.select("product_guid", "product_name")
    return seen.join(names, "product_guid", "left").select(
        "client_variant", "client_id",
        F.coalesce("product_name", F.lit(UNKNOWN)).alias("product_name"),
        "product_guid", "last_active_dt",
    )


def roll_pairings(today: DataFrame, previous: DataFrame, ds: str | dt.date) -> DataFrame:
    """Latest date per pairing over the previous state and ``ds``, stamped with ``ds``."""
    columns = (*_PAIR, "last_active_dt")
    return (
        today.select(*columns).unionByName(previous.select(*columns))
        .groupBy(*_PAIR)
        .agg(F.max("last_active_dt").alias("last_active_dt"))
        .withColumn("airflow_ds", F.lit(as_date(ds)))
    )
