"""Session summaries, crash counts and connection time of devices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.operators.date_windows import DateWindow
from pulsegrid.operators.previous_row import with_previous

SESSION = ("client_variant", "device_component_guid", "device_session_id")
SESSION_DAY = (*SESSION, "event_local_date")
_PRODUCT = ("product_sku", "product_model_name")
_VERSION = ("client_firmware_version", "client_version_core")


def valid_events(events: DataFrame, window: DateWindow) -> DataFrame:
    return events.where(window.holds("event_local_date") & F.col("decode_success"))


def session_event_counts(subject: DataFrame, window: DateWindow, count_name: str) -> DataFrame:
    """Events per session, one row per session and date.

    The count spans all dates of the session in ``window`` and so grows with the window. Rows are
    counted per session and date first; the window then sums a few rows per session.
    """
    per_day = subject.where(window.holds("event_local_date")).groupBy(*SESSION_DAY).agg(
        F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(*SESSION))
    return per_day.select(*SESSION_DAY, total.cast("int").alias(count_name))


def session_sets(events: DataFrame, window: DateWindow) -> DataFrame:
    """Uptime bounds, event counts and connection states of every session and date.

    Values are those of the whole session and day and repeat for every product and firmware seen
    in it. The last state is the one at the highest uptime; of several at one uptime, the
    greatest text.

    The first aggregate has fixed-width buffers and leaves one row per session, product, firmware
    and state, so no session is ever sorted whole.
    """
    attributes = (*_PRODUCT, *_VERSION)
    state = F.col("bt_device_state")
    fine = valid_events(events, window).groupBy(*SESSION_DAY, *attributes, "bt_device_state").agg(
        F.min("device_mono_time").alias("_lo"),
        F.max("device_mono_time").alias("_hi"),
        F.count(F.lit(1)).alias("_n"),
    )
    session = Window.partitionBy(*SESSION_DAY)
    of_state = lambda s: F.sum(F.when(state == s, F.col("_n")).otherwise(0)).over(session)
    last = F.max_by(state, F.when(state.isNotNull(), F.struct("_hi", "bt_device_state")))
    return fine.select(
        *SESSION_DAY, *attributes,
        F.min("_lo").over(session).alias("session_mono_time_start"),
        F.max("_hi").over(session).alias("session_mono_time_end"),
        F.sum("_n").over(session).alias("session_event_count"),
        last.over(session).alias("final_bt_device_state"),
        of_state("connected").alias("bt_connect_count"),
        of_state("disconnected").alias("bt_disconnect_count"),
    ).distinct()


_TIES = ("client_firmware_version", "device_session_id", "bt_device_state")


def crash_order(order_by: str) -> tuple[str, ...]:
    """The columns that order a device's events."""
    if order_by not in ("uptime", "event_time"):
        raise ValueError(f"order_by is 'uptime' or 'event_time', not {order_by!r}")
    first = "event_local_date" if order_by == "uptime" else "event_timestamp_ms"
    return (first, "device_mono_time", *_TIES)


def detect_crashes(events: DataFrame, order_by: str = "uptime", bucket: Column | None = None,
                   lookback: DataFrame | None = None) -> DataFrame:
    """Mark events whose uptime is below that of the device's preceding event.

    ``order_by="uptime"`` orders by date and uptime, the warehouse's order: inside a date uptime
    never falls, so only changes of date can show a crash. ``order_by="event_time"`` orders by
    ``event_timestamp_ms`` and finds them all. ``lookback`` gives earlier events, so that the
    first event of the window has a predecessor; its own rows are not returned.

    A device is cut into buckets for the look back: dates, cut further by the second of uptime, or
    minutes of event time, which need no further cut and so one shuffle less.
    """
    order = crash_order(order_by)
    if order_by == "uptime":
        bucket = F.col("event_local_date") if bucket is None else bucket
        finer = F.floor(F.col("device_mono_time") / 1000)
    else:
        finer = None if bucket is None else F.floor(F.col("event_timestamp_ms") / 1000)
        bucket = F.floor(F.col("event_timestamp_ms") / 60_000) if bucket is None else bucket
    rows = events
    if lookback is not None:
        rows = events.withColumn("_own", F.lit(True)).unionByName(
            lookback.select(*events.columns).withColumn("_own", F.lit(False)))
    rows = with_previous(rows, ("device_component_guid",), bucket, order,
                         ("device_mono_time", "bt_device_state"), "_prev", finer)
    if lookback is not None:
        rows = rows.where("_own").drop("_own")
    before = F.col("_prev.device_mono_time")
    crash = before.isNotNull() & (before > F.col("device_mono_time"))
    in_session = F.col("device_session_id").isNotNull() & (F.col("device_session_id") != "")
    return (
        rows.withColumn("prev_mono_time", before)
        .withColumn("prev_bt_device_state", F.col("_prev.bt_device_state"))
        .withColumn("is_crash", crash)
        .drop("_prev")
        .withColumn("panic_user_experience_ind",
                    F.col("is_crash") & (F.col("prev_bt_device_state") == "connected"))
        .withColumn("panic_product_experience_ind", F.col("is_crash") & in_session)
    )


_DEVICE_DAY = ("event_local_date", "device_component_guid", "client_firmware_version")
_FLAGS = {
    "is_crash": "crash_cnt_total",
    "panic_user_experience_ind": "crash_cnt_user",
    "panic_product_experience_ind": "crash_cnt_product",
}
_CARRIED = ("client_variant", *_PRODUCT, "client_version_core")


def aggregate_crashes(marked: DataFrame, zero_fill: bool = False) -> DataFrame:
    """Crash, session and disconnect counts per date, device and firmware.

    A count whose flags are all unknown is null unless ``zero_fill``. Of several values of a
    carried attribute the least is kept.
    """
    fine = marked.groupBy(*_DEVICE_DAY, "device_session_id", *_CARRIED).agg(
        *[F.sum(F.col(flag).cast("int")).alias(name) for flag, name in _FLAGS.items()],
        F.count_if(F.col("bt_device_state") == "disconnected").alias("_off"),
    )
    counts = fine.groupBy(*_DEVICE_DAY).agg(
        *[F.sum(name).alias(name) for name in _FLAGS.values()],
        F.count_distinct("device_session_id").alias("session_cnt"),
        F.sum("_off").alias("bt_disconnected_cnt"),
        *[F.min(c).alias(c) for c in _CARRIED],
    )
    return counts.fillna(0, list(_FLAGS.values())) if zero_fill else counts


STATE_COLUMNS = ("device_component_guid", "event_timestamp_ms", "device_mono_time", "device_session_id",
                 "bt_device_state", *_CARRIED, "client_firmware_version", "decode_success",
                 "event_local_date")


def last_events(events: DataFrame, order_by: str = "uptime") -> DataFrame:
    """Every device's last event, with the columns that a crash of its next event is judged by. Devices
    without a guid are one, as in the look-back; the aggregate combines ahead of the shuffle."""
    last = F.max_by(F.struct(*STATE_COLUMNS), F.struct(*crash_order(order_by)))
    return events.groupBy(F.col("device_component_guid").alias("_device")).agg(
        last.alias("_last")).select("_last.*")


def crash_counts(events: DataFrame, window: DateWindow, order_by: str = "uptime",
                 zero_fill: bool = False, carried: DataFrame | None = None) -> DataFrame:
    """``detect_crashes`` and ``aggregate_crashes`` over the valid events of ``window``.

    ``carried`` has the ``last_events`` before the window, so that its first events have predecessors;
    the counts then are those of a run over all events.
    """
    rows = valid_events(events, window)
    if carried is None:
        if order_by == "uptime":
            return _crash_counts_by_day(rows, zero_fill)
        return aggregate_crashes(detect_crashes(rows, order_by), zero_fill)
    rows, carried = rows.select(*STATE_COLUMNS), carried.select(*STATE_COLUMNS)
    if order_by == "uptime":
        counts = _crash_counts_by_day(rows.unionByName(carried), zero_fill)
        return counts.where(window.holds("event_local_date"))
    return aggregate_crashes(detect_crashes(rows, order_by, lookback=carried), zero_fill)


def _crash_counts_by_day(rows: DataFrame, zero_fill: bool) -> DataFrame:
    """Crash counts in uptime order from per-day extremes instead of per-event look-backs.

    Ordered by date and uptime only a day's first event can lie below its predecessor, which is
    the last event of the device's preceding day. So one pass with fixed-width buffers gives the
    extremes, and the look-back runs over a device's days and firmware versions.

    Rows are dealt three times: by the first aggregate, by day, device and firmware for the counts, and by
    device for both looks at its days.
    """
    fine = rows.groupBy(*_DEVICE_DAY, "device_session_id", "bt_device_state", *_CARRIED).agg(
        F.min("device_mono_time").alias("_lo"),
        F.max("device_mono_time").alias("_hi"),
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("device_mono_time").isNull()).alias("_unknown"),
    ).repartition(*_DEVICE_DAY)
    # the rows of a session lie together; counting the first of each saves the aggregate by session
    before = F.lag("device_session_id").over(Window.partitionBy(*_DEVICE_DAY).orderBy("device_session_id"))
    fine = fine.withColumn("_session", F.col("device_session_id").isNotNull() & ~F.col(
        "device_session_id").eqNullSafe(before))
    # an event without uptime sorts first in its day
    first_uptime = F.when(F.col("_unknown") == 0, F.col("_lo"))
    counts = fine.groupBy(*_DEVICE_DAY).agg(
        F.sum("_n").alias("_events"),
        F.count_if("_session").alias("session_cnt"),
        F.sum(F.when(F.col("bt_device_state") == "disconnected", F.col("_n")).otherwise(0))
        .alias("bt_disconnected_cnt"),
        *[F.min(c).alias(c) for c in _CARRIED],
        F.min(F.struct(first_uptime.alias("t"), *_TIES)).alias("_first"),
        F.max(F.struct(F.col("_hi").alias("t"), *_TIES)).alias("_last"),
    )
    device = Window.partitionBy("device_component_guid").orderBy(F.unix_date("event_local_date").cast("long"))
    looked = counts.withColumns({
        "_opening": F.min("_first").over(device.rangeBetween(0, 0)),
        "_back": F.max(F.struct("event_local_date", "_last")).over(
            device.rangeBetween(Window.unboundedPreceding, -1))["_last"],
    })
    opens_day = F.col("_first") == F.col("_opening")
    crash = F.coalesce(opens_day & (F.col("_back.t") > F.col("_first.t")), F.lit(False))
    was_connected = F.col("_back.bt_device_state") == "connected"
    session = F.col("_first.device_session_id")
    in_session = session.isNotNull() & (session != "")
    user = (crash & F.coalesce(was_connected, F.lit(False))).cast("long")
    if not zero_fill:
        # a single event that crashed after an unknown state leaves nothing known to sum
        user = F.when(~(crash & (F.col("_events") == 1) & was_connected.isNull()), user)
    return looked.select(
        *_DEVICE_DAY,
        crash.cast("long").alias("crash_cnt_total"),
        user.alias("crash_cnt_user"),
        (crash & in_session).cast("long").alias("crash_cnt_product"),
        "session_cnt", "bt_disconnected_cnt", *_CARRIED,
    )


def with_firmware_release(counts: DataFrame, releases: DataFrame) -> DataFrame:
    """Release format, channel and date of the firmware; unknown firmware keeps its row."""
    named = releases.select("firmware_version", "firmware_version_format", "release_channel",
                            "release_date")
    return counts.join(
        named, counts["client_firmware_version"] == named["firmware_version"], "left"
    ).drop("firmware_version")


def crash_records(events: DataFrame, window: DateWindow, order_by: str = "uptime") -> DataFrame:
    """The events at which a crash shows."""
    return detect_crashes(valid_events(events, window), order_by).where("is_crash")


def session_crash_sets(events: DataFrame, window: DateWindow, order_by: str = "uptime") -> DataFrame:
    """Session summaries with the crashes of the session and date (0 where there are none)."""
    crashes = crash_records(events, window, order_by).groupBy(*SESSION_DAY).agg(
        F.count(F.lit(1)).alias("crash_cnt"),
        F.count_if("panic_user_experience_ind").alias("crash_cnt_user"),
    ).toDF(*[f"_k{i}" for i in range(len(SESSION_DAY))], "crash_cnt", "crash_cnt_user")
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(SESSION_DAY)]
    keys = [f"_k{i}" for i in range(len(SESSION_DAY))]
    return (session_sets(events, window).join(crashes, same, "left").drop(*keys)
            .fillna(0, ["crash_cnt", "crash_cnt_user"]))


def connectivity_duration(events: DataFrame, window: DateWindow,
                          bucket_ms: int = 3_600_000) -> DataFrame:
    """Uptime a session spent connected: from each connected event to the session's next event."""
    rows = valid_events(events, window).select(*SESSION_DAY, "device_mono_time", "bt_device_state")
    marked = with_previous(rows, SESSION_DAY, F.floor(F.col("device_mono_time") / bucket_ms),
                           ("device_mono_time", "bt_device_state"),
                           ("device_mono_time", "bt_device_state"), "_prev",
                           F.col("device_mono_time"))
    spent = F.when(F.col("_prev.bt_device_state") == "connected",
                   F.col("device_mono_time") - F.col("_prev.device_mono_time")).otherwise(0)
    return marked.groupBy(*SESSION_DAY).agg(F.sum(spent).alias("connected_ms"))
