"""Device reports. The warehouse names them and their grain; the formulas are this library's own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _share(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole), 4)


def crash_rate(crashes: DataFrame) -> DataFrame:
    """Crashes per session by product, firmware and day."""
    return crashes.groupBy("event_local_date", "product_sku", "client_firmware_version").agg(
        F.sum(F.coalesce("crash_cnt_total", F.lit(0))).alias("crash_cnt"),
        F.sum("session_cnt").alias("session_cnt"),
    ).withColumn("crash_rate", _share(F.col("crash_cnt"), F.col("session_cnt")))


def crash_count_daily(crashes: DataFrame) -> DataFrame:
    return crashes.groupBy("event_local_date", "product_sku").agg(
        *[F.sum(F.coalesce(c, F.lit(0))).alias(c)
          for c in ("crash_cnt_total", "crash_cnt_user", "crash_cnt_product")])


def connectivity_rate_daily(sessions: DataFrame) -> DataFrame:
    """Share of sessions that end connected, by product and day."""
    return sessions.groupBy("event_local_date", "product_sku").agg(
        F.count(F.lit(1)).alias("session_cnt"),
        F.count_if(F.col("final_bt_device_state") == "connected").alias("connected_cnt"),
    ).withColumn("connectivity_rate", _share(F.col("connected_cnt"), F.col("session_cnt")))


def ota_rate(updates: DataFrame, succeeded: Sequence[str] = ("success",)) -> DataFrame:
    """Share of update events whose payload status is a success, by product, firmware and day."""
    status = F.get_json_object("payload_json", "$.status")
    return updates.groupBy("event_local_date", "product_sku", "client_firmware_version").agg(
        F.count(F.lit(1)).alias("ota_cnt"),
        F.count_if(status.isin(*succeeded)).alias("ota_success_cnt"),
    ).withColumn("ota_rate", _share(F.col("ota_success_cnt"), F.col("ota_cnt")))
