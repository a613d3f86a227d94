"""Daily active, new and accumulated users per product and app variant."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.values import UNKNOWN


_PERSON = ("client_id", "client_variant", "product_name")


def seen_users(user_daily: DataFrame, pairings: DataFrame, date: str = "event_local_date",
               name_before_grouping: bool = False, first_seen: DataFrame | None = None) -> DataFrame:
    """``report_date``, ``_PERSON`` and whether this is the person's first date (``is_new``), once each;
    users without a pairing have no product name, or that of the unknown product.

    ``first_seen`` is the state of earlier dates: who was first seen when with which product.

    Facts, pairings and state grow with the clients, so they are never sent whole through the driver:
    they are dealt by client and variant together, once. What meets there is a client's dates and
    products, which are then paired in place."""
    client = ("client_id", "client_variant")
    unnamed = F.lit(UNKNOWN) if name_before_grouping else F.lit(None).cast("string")
    name = F.coalesce("product_name", unnamed)
    # in structs, because sets leave nulls out
    days = user_daily.select(*client, F.struct(F.col(date).alias("report_date")).alias("_day"))
    named = pairings.dropna(subset=list(client)).select(*client, F.struct(name.alias("product_name")).alias("_name"))
    parts = days.unionByName(named, allowMissingColumns=True)
    if first_seen is not None:
        known = F.struct("product_name", "first_date").alias("_known")
        parts = parts.unionByName(first_seen.select(*client, known), allowMissingColumns=True)
    else:
        parts = parts.withColumn("_known", F.lit(None).cast("struct<product_name: string, first_date: date>"))
    clients = parts.groupBy(*client).agg(
        *[F.collect_set(c).alias(f"{c}s") for c in ("_day", "_name", "_known")]).where(F.size("_days") > 0)
    names = F.when(F.size("_names") > 0, F.col("_names")).otherwise(F.array(F.struct(unnamed.alias("product_name"))))
    own = F.array_min(F.transform("_days", lambda d: d["report_date"]))
    before = F.array_min(F.transform(
        F.filter("_knowns", lambda k: k["product_name"].eqNullSafe(F.col("_name.product_name"))),
        lambda k: k["first_date"]))
    people = clients.select(*client, "_days", "_knowns", own.alias("_own"), F.explode(names).alias("_name"))
    return people.select(
        *client, F.col("_name.product_name").alias("product_name"), F.least("_own", before).alias("_first"),
        F.explode("_days").alias("_day")).select(
        F.col("_day.report_date").alias("report_date"), *_PERSON,
        (F.col("_day.report_date") == F.col("_first")).alias("is_new"))


def first_seen_of(seen: DataFrame) -> DataFrame:
    """The state rows, ``_PERSON`` and ``first_date``, that ``seen_users`` adds to the earlier state."""
    return seen.where("is_new").select(*_PERSON, F.col("report_date").alias("first_date"))


def daily_active_users(user_daily: DataFrame, product_daily: DataFrame, pairings: DataFrame,
                       products: DataFrame, date: str = "event_local_date",
                       name_before_grouping: bool = False, carry_forward: bool = False,
                       first_seen: DataFrame | None = None, seen: DataFrame | None = None) -> DataFrame:
    """One row per report date, product name and variant.

    ``date`` is the report date in both fact tables: ``partition_date`` for the first table
    generation, which also names unpaired users before grouping (``name_before_grouping``), and
    ``event_local_date`` for the second, where users without a pairing and users paired with a
    product called 'Unknown' are two rows.

    New users are those whose first date with a product and variant this is. Rows without a
    variant have no new users and no total, since nulls never join. ``accumulated_users`` is 0 on
    dates without new users unless ``carry_forward``, which repeats the last total instead.

    ``first_seen`` is the state of earlier dates: who was first seen when with which product (the
    columns of ``first_seen_of``). With it the facts need to cover the report dates only, and those
    dates' rows equal the ones of a run over all facts. ``seen`` gives the ``seen_users`` of the same
    arguments where they are known already.

    Everything after the first distinct works on one row per client, product and date; the grid
    of dates, products and variants that follows is small.
    """
    if seen is None:
        seen = seen_users(user_daily, pairings, date, name_before_grouping, first_seen)
    cell = ("product_name", "client_variant")
    grid = seen.groupBy("report_date", *cell).agg(
        F.count("client_id").alias("dau_count"),
        F.count_if(F.col("is_new") & F.col("client_id").isNotNull()).alias("_new"),
    ).withColumn("_own", F.lit(True))
    if first_seen is not None:
        grid = grid.unionByName(first_seen.groupBy(F.col("first_date").alias("report_date"), *cell).agg(
            F.lit(0).cast("long").alias("dau_count"), F.count("client_id").alias("_new"),
        ).withColumn("_own", F.lit(False)))
    grid = grid.withColumn("product_name", F.coalesce("product_name", F.lit(UNKNOWN)))

    slice_ = ("report_date", "product_name", "client_variant")
    running = (Window.partitionBy("product_name", "client_variant").orderBy("report_date")
               .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    has_variant = F.col("client_variant").isNotNull()
    grid = (
        grid.withColumn("_total", F.sum("_new").over(running))
        .withColumn("_new", F.sum("_new").over(Window.partitionBy(*slice_)))
        .where("_own").drop("_own")
    )
    shows_total = has_variant if carry_forward else has_variant & (F.col("_new") > 0)

    devices = product_daily.groupBy(F.col(date).alias("report_date"), "client_variant").agg(
        F.count_distinct("product_guid").alias("_devices"))
    meta = products.select(
        "product_name", "product_category",
        F.when(F.col("is_active"), "Active").otherwise("End of Life").alias("lifecycle_status"))
    return (
        grid.join(meta, "product_name", "left")
        .join(devices, ["report_date", "client_variant"], "left")
        .select(
            "report_date", "product_name",
            F.coalesce("product_category", F.lit(UNKNOWN)).alias("product_category"),
            F.coalesce("lifecycle_status", F.lit(UNKNOWN)).alias("lifecycle_status"),
            "client_variant", "dau_count",
            F.when(has_variant, F.col("_new")).otherwise(0).alias("new_users"),
            F.coalesce("_devices", F.lit(0)).alias("new_products_active"),
            F.when(shows_total, F.col("_total")).otherwise(0).alias("accumulated_users"),
        )
        .orderBy(F.desc("report_date"), "product_name", "client_variant")
    )
