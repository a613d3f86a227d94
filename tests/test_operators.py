"""Operators on small hand-made frames; results are recomputed here in plain Python."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulsegrid.functions import predicates, times
from pulsegrid.operators import (
    audience,
    daily_activity,
    device_marts,
    dimensions,
    landing,
    pairings,
    quality,
    retention,
)
from pulsegrid.operators.date_windows import DateWindow, backfill_window
from pulsegrid.operators.previous_row import with_previous

D = dt.date.fromisoformat
ALL = DateWindow(D("2024-01-01"), D("2024-01-31"))


def day(n):
    return D("2024-01-01") + dt.timedelta(days=n - 1)


# --- scalars ----------------------------------------------------------------------------
def test_predicates(spark, as_rows):
    names = spark.createDataFrame([("atest",), ("test",), ("app_internal",), ("ok",), (None,), (" ",)], "n string")
    assert as_rows(names.where(predicates.not_test_traffic("n"))) == [(" ",), ("ok",), ("test",)]
    assert as_rows(names.where(predicates.present("n")).select(F.count("n"))) == [(4,)]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert flags.where(predicates.not_flagged_test("f")).count() == 2
    apps = spark.createDataFrame([("nova-ios",), ("nova-ohos",), ("web",), (None,)], "n string")
    assert [r[0] for r in apps.select(predicates.platform_of("n")).collect()] == [
        "iOS", "HarmonyOS", None, None]


def test_times(spark):
    (row,) = spark.sql("SELECT timestamp'2024-02-28 17:30:00.987' AS t, date'2024-02-28' AS a, "
                       "date'2024-03-01' AS b").select(
        times.epoch_millis_whole_seconds(F.col("t")), times.local_date(F.col("t")),
        times.months_between_calendar(F.col("a"), F.col("b"))).collect()
    assert tuple(row) == (1709141400000, D("2024-02-29"), 1)


# --- landing ----------------------------------------------------------------------------
def test_first_copy_with_equal_times(spark, as_rows):
    rows = [("a", 2, 1, "late"), ("a", 1, 5, "x"), ("a", 1, 5, "y"), ("b", 1, 1, "only")]
    frame = spark.createDataFrame(rows, "event_guid string, event_received_at int, event_timestamp int, v string")
    once = as_rows(landing.first_copy(frame))
    assert [r[0] for r in once] == ["a", "b"] and once[0][3] in ("x", "y")
    again = landing.first_copy(frame.repartition(7).orderBy(F.rand(3)))
    assert as_rows(again) == once


def test_first_copy_of_a_hot_key_is_cut_before_the_shuffle(spark):
    rows = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id) END AS event_guid",
        "id AS event_received_at", "id AS event_timestamp")
    once = landing.first_copy(rows)
    assert once.count() == 2001
    assert once.where("event_guid = 'hot'").first().event_received_at == 0
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange"), "the limit per task comes below the exchange"


def flat_event(spark, **values):
    columns = ("event_guid string, event_timestamp string, client_id string, client_name string, "
               "client_variant string, client_version string, client_build string, "
               "client_mono_time long, client_session_id int, product_guid string, "
               "product_firmware_version string, nova_oob_bt_connect string, dt string")
    row = {"event_guid": "g", "event_timestamp": "2024-01-02T20:00:00Z", "client_id": "c",
           "client_name": "nova-ios", "client_variant": "dev", "client_version": "1",
           "client_build": "b", "client_mono_time": 1, "client_session_id": 2,
           "product_guid": "pg", "product_firmware_version": "1.0.0",
           "nova_oob_bt_connect": "connected", "dt": "2024-01-02", **values}
    return spark.createDataFrame([row], columns)


def test_select_event(spark):
    window = backfill_window("2024-01-02", 0)
    with_product = landing.select_event(flat_event(spark), "nova_bt_connect_result", window, "src").first()
    assert (with_product.product_guid, with_product.payload, with_product.is_test_event) == (
        "pg", '{"nova_oob_bt_connect":"connected"}', True)
    assert with_product.event_local_date == D("2024-01-03")
    without = landing.select_event(flat_event(spark), "nova_login_attempt", window, "src").first()
    assert without.product_guid is None and without.payload == '{"nova_identity_provider":null}'
    empty = landing.select_event(flat_event(spark), "nova_bt_connect_attempt", window, "src").first()
    assert empty.payload == "{}"


def test_union_of_one_event_and_dev_leg(spark):
    window = backfill_window("2024-01-02", 0)
    read = lambda name: flat_event(spark, event_guid=name)
    every = landing.union_events(read, lambda _: window, "src")
    assert every.count() == 11
    one = landing.union_events(read, lambda _: window, "src", event="nova_login_attempt", read_dev=read)
    assert [r.event_name for r in one.collect()] == ["nova_login_attempt"] * 2
    with pytest.raises(ValueError):
        landing.union_events(read, lambda _: window, "src", event="nothing")


# --- daily activity ---------------------------------------------------------------------
def test_last_firmware_of_the_day(spark):
    rows = [("c1", 10, "1.0"), ("c2", 20, "1.1"), ("c1", 20, "1.2"), ("c1", 15, "9.9"), (None, 1, "1.0")]
    frame = spark.createDataFrame(
        [(day(1), "g", c, t, f, "prod", "x", "nova-ios", "p", "n", day(1)) for c, t, f in rows],
        "event_local_date date, product_guid string, client_id string, event_timestamp long, "
        "product_firmware_version string, client_variant string, other string, client_name string, "
        "product_id string, product_name string, partition_date date")
    (row,) = daily_activity.product_daily_with_catalogue_names(frame, ALL).collect()
    assert (row.firmware_version, row.active_user_count, row.event_count) == ("1.2", 2, 5)
    assert (row.first_seen_ts, row.last_seen_ts) == (1, 20)


def test_daily_facts_deal_events_once(spark, as_rows):
    """Clients, sessions and firmware of a date and client are counted where its events were dealt to."""
    pick = random.Random(5)
    events = [(day(pick.randint(1, 2)), pick.choice(["a", "b", "c"]), pick.choice(["x", None]),
               pick.choice(["s", "t", "u", None]), "0" * 35 + pick.choice("12"), pick.choice(["1.0", "1.1"]), i)
              for i in range(60)]
    frame = spark.createDataFrame(
        events, "event_local_date date, client_id string, client_variant string, session_id string, "
        "product_guid string, firmware_version string, client_mono_time long").selectExpr(
        "*", "timestamp_seconds(client_mono_time) AS event_timestamp", "event_local_date AS partition_date",
        "'n' AS client_name", "'1' AS client_version", "'b' AS client_build", "'iOS' AS client_platform",
        "false AS is_test_event")
    users = daily_activity.user_daily_by_local_date(frame, ALL)
    of_user = lambda d, c, v: [e for e in events if e[:3] == (d, c, v)]
    assert as_rows(users, "event_local_date", "client_id", "client_variant", "event_count", "session_count") == sorted(
        [(*k, len(of_user(*k)), len({e[3] for e in of_user(*k)} - {None})) for k in {e[:3] for e in events}], key=repr)
    devices = daily_activity.product_daily(frame, ALL)
    of_device = lambda d, g: [e for e in events if (e[0], e[4]) == (d, g)]
    assert as_rows(devices, "event_local_date", "product_guid", "firmware_version", "active_user_count",
                   "event_count") == sorted(
        [(*k, of_device(*k)[-1][5], len({e[1] for e in of_device(*k)}), len(of_device(*k)))
         for k in {(e[0], e[4]) for e in events}], key=repr)
    for facts, exchanges in ((users, 1), (devices, 2)):
        plan = spark._jvm.PythonSQLUtils.explainString(facts._jdf.queryExecution(), "simple")
        assert plan.count("Exchange hashpartitioning") == exchanges


# --- retention --------------------------------------------------------------------------
def user_days(spark, rows):
    return spark.createDataFrame(
        [(c, n, p, day(d)) for c, n, p, d in rows],
        "client_id string, client_name string, product_id string, partition_date date")


def brute_curve(rows, lo, hi):
    first, active = {}, defaultdict(set)
    for c, n, p, d in rows:
        if c is None or n is None:
            continue
        active[c, n].add(d)
        first[c, n, p] = min(d, first.get((c, n, p), d))
    cohorts = defaultdict(set)
    for (c, n, p), d in first.items():
        if p is not None:
            cohorts[d, n, p].add(c)
    out = []
    for (d, n, p), members in cohorts.items():
        if not any(lo <= x <= hi for c in members for x in active[c, n]):
            continue
        for later in range(d, hi + 1):
            kept = sum(later in active[c, n] for c in members)
            if kept:
                out.append((day(d), day(later), n, p, len(members), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_retention_curve(spark, as_rows, seed):
    pick = random.Random(seed)
    rows = [(pick.choice(["a", "b", "c", "d", None]), pick.choice(["x", "y", None]),
             pick.choice(["p", "q", None]), pick.randint(1, 9)) for _ in range(60)]
    got = retention.retention_curve(user_days(spark, rows), DateWindow(day(6), day(8)))
    columns = ("cohort_date", "partition_date", "client_name", "product_id", "cohort_size", "retained_users")
    assert as_rows(got, *columns) == brute_curve(rows, 6, 8)
    assert got.where("days_since_cohort = 0 AND retention_rate <> 1").count() == 0


def test_retention_by_day_settled(spark):
    users = spark.createDataFrame(
        [(c, v, day(d), day(d)) for c, v, d in [
            ("a", "prod", 1), ("a", "dev", 8), ("b", "prod", 1), ("b", "prod", 2), ("a", "prod", 9)]],
        "client_id string, client_variant string, event_local_date date, partition_date date")
    pairs = spark.createDataFrame(
        [("a", "prod", "P"), ("a", "prod", "P"), ("a", "prod", "Q")],
        "client_id string, client_variant string, product_name string")
    window = DateWindow(day(8), day(9))
    got = {(r.cohort_date, r.product_name): r for r in retention.retention_by_day(
        users, pairs, window, settled=True).collect() if r.client_variant == "prod"}
    first = got[day(1), "P"]
    assert (first.d0_users, first.d1_users, first.d7_users, first.d7_retention_rate) == (1, 0, 1, 1.0)
    assert got[day(1), "Q"].d0_users == 1
    assert (got[day(1), "Unknown"].d1_users, got[day(1), "Unknown"].d7_users) == (1, 0)
    assert (got[day(9), "P"].d1_users, got[day(9), "P"].d7_retention_rate) == (None, None)
    literal = retention.retention_by_day(users, pairs, window).collect()
    assert {r.cohort_date for r in literal} == {day(8), day(9)}
    assert {r.d7_users for r in literal} == {0}


def test_retention_by_day_deals_facts_and_pairings_by_client_once(spark, as_rows):
    """However small the pairings are measured: they grow with the clients."""
    pick = random.Random(6)
    facts = [(pick.choice(["a", "b", "c", "", None]), pick.choice(["x", "y", None]), day(pick.randint(1, 9)))
             for _ in range(40)]
    paired = [(pick.choice(["a", "b", "", None]), pick.choice(["x", "y", None]), pick.choice(["P", "Q", "Unknown", None]))
              for _ in range(12)]
    users = spark.createDataFrame([(*f, f[2]) for f in facts],
                                  "client_id string, client_variant string, event_local_date date, partition_date date")
    pairs = spark.createDataFrame(paired, "client_id string, client_variant string, product_name string")
    rows = retention.retention_by_day(users, pairs, DateWindow(day(1), day(9)))
    named = lambda c, v: {p or "Unknown" for c2, v2, p in paired if v and (c2, v2) == (c, v)} or {"Unknown"}
    seen = {(c, d) for c, _, d in facts}
    want = {}
    for c, v, d in {f for f in facts if f[0]}:
        for p in named(c, v):
            cell = want.setdefault((d, p, v), [0, 0, 0])
            for i, n in enumerate((0, 1, 7)):
                cell[i] += (c, d + dt.timedelta(days=n)) in seen
    assert as_rows(rows, "cohort_date", "product_name", "client_variant", "d0_users", "d1_users", "d7_users") == sorted(
        [(*k, *n) for k, n in want.items()], key=repr)
    assert "Broadcast" not in rows._jdf.queryExecution().executedPlan().toString()
    plan = spark._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "simple")
    assert plan.count("Exchange hashpartitioning") == 3


# --- audience ---------------------------------------------------------------------------
def audience_of(spark, **options):
    users = spark.createDataFrame(
        [(c, v, day(d), day(d)) for c, v, d in [
            ("a", "prod", 1), ("b", "prod", 1), ("a", "prod", 2), ("c", "prod", 3), ("a", "prod", 3),
            ("n", None, 1), ("a", "prod", 1)]],
        "client_id string, client_variant string, event_local_date date, partition_date date")
    devices = spark.createDataFrame(
        [("g", "prod", day(1), day(1)), ("h", "prod", day(1), day(1))],
        "product_guid string, client_variant string, event_local_date date, partition_date date")
    pairs = spark.createDataFrame([("a", "prod", "P"), ("a", "prod", "Unknown")],
                                  "client_id string, client_variant string, product_name string")
    products = spark.createDataFrame([("P", "speaker", False)],
                                     "product_name string, product_category string, is_active boolean")
    return audience.daily_active_users(users, devices, pairs, products, **options)


def test_audience(spark):
    got = audience_of(spark).collect()
    p = {r.report_date: r for r in got if r.product_name == "P"}
    assert [(r.dau_count, r.new_users, r.accumulated_users) for _, r in sorted(p.items())] == [
        (1, 1, 1), (1, 0, 0), (1, 0, 0)]
    assert (p[day(1)].lifecycle_status, p[day(1)].new_products_active) == ("End of Life", 2)
    # a user paired with a product named Unknown and an unpaired user are two rows of one total
    unknown = [r for r in got if r.product_name == "Unknown" and r.client_variant and r.report_date == day(1)]
    assert [(r.dau_count, r.new_users, r.accumulated_users) for r in unknown] == [(1, 2, 2)] * 2
    (nobody,) = [r for r in got if r.client_variant is None]
    assert (nobody.dau_count, nobody.new_users, nobody.accumulated_users) == (1, 0, 0)
    assert [r.report_date for r in got] == sorted((r.report_date for r in got), reverse=True)


def test_audience_carry_forward_and_early_names(spark):
    got = audience_of(spark, carry_forward=True, name_before_grouping=True).collect()
    p = [r.accumulated_users for r in reversed(got) if r.product_name == "P"]
    assert p == [1, 1, 1]
    unknown = [(r.report_date, r.dau_count, r.new_users, r.accumulated_users) for r in got
               if r.product_name == "Unknown" and r.client_variant]
    assert sorted(unknown) == [(day(1), 2, 2, 2), (day(2), 1, 0, 2), (day(3), 2, 1, 3)]


def test_pairings_are_not_sent_through_the_driver(spark):
    """However small they are measured: they grow with the clients, and every window joins them."""
    users = spark.range(50).selectExpr("concat('c', id) AS client_id", "'prod' AS client_variant",
                                       "DATE'2024-01-01' AS event_local_date")
    pairs = users.selectExpr("client_id", "client_variant", "concat('P', length(client_id)) AS product_name")
    seen = audience.seen_users(users, pairs)
    assert len(seen.collect()) == 50
    assert "Broadcast" not in seen._jdf.queryExecution().executedPlan().toString()


def test_seen_users_after_a_state(spark, as_rows):
    rows = [("a", "prod", day(5)), ("a", "prod", day(6)), ("b", "prod", day(6)), (None, None, day(6))]
    users = spark.createDataFrame(rows, "client_id string, client_variant string, event_local_date date")
    pairs = spark.createDataFrame([("a", "prod", "P")], "client_id string, client_variant string, product_name string")
    state = spark.createDataFrame([("a", "prod", "P", day(1)), ("z", "prod", "P", day(2))],
                                  "client_id string, client_variant string, product_name string, first_date date")
    seen = audience.seen_users(users, pairs, first_seen=state)
    assert as_rows(seen, "report_date", "client_id", "is_new") == sorted([
        (day(5), "a", False), (day(6), "a", False), (day(6), "b", True), (day(6), None, True)], key=repr)
    assert as_rows(audience.first_seen_of(seen), "client_id", "first_date") == sorted(
        [("b", day(6)), (None, day(6))], key=repr)


@pytest.mark.parametrize("early", [False, True])
def test_seen_users_deal_facts_pairings_and_state_once(spark, as_rows, early):
    pick = random.Random(early)
    person = lambda: (pick.choice(["a", "b", "c", "", None]), pick.choice(["x", "y", None]))
    facts = [(*person(), pick.choice([day(5), day(6), day(7), None])) for _ in range(25)]
    paired = [(*person(), pick.choice(["P", "Q", "Unknown", None])) for _ in range(12)]
    known = [(*person(), pick.choice(["P", "Unknown", None]), day(pick.randint(1, 3))) for _ in range(5)]
    users = spark.createDataFrame(facts, "client_id string, client_variant string, event_local_date date")
    pairs = spark.createDataFrame(paired, "client_id string, client_variant string, product_name string")
    state = spark.createDataFrame(known, "client_id string, client_variant string, product_name string, first_date date")
    seen = audience.seen_users(users, pairs, name_before_grouping=early, first_seen=state)
    named = {(c, v): {p or ("Unknown" if early else None) for c2, v2, p in paired if (c2, v2) == (c, v)}
             for c, v, _ in facts if None not in (c, v)}
    all_seen = {(d, c, v, p) for c, v, d in facts for p in named.get((c, v)) or {"Unknown" if early else None}}
    first = {}
    for d, *who in [*all_seen, *[(d, c, v, p) for c, v, p, d in known]]:
        first[tuple(who)] = min(d or day(9), first.get(tuple(who), day(9)))
    new = lambda d, who: None if d is None or first[who] == day(9) else d == first[who]
    assert as_rows(seen, "report_date", "client_id", "client_variant", "product_name", "is_new") == sorted(
        [(*row, new(row[0], row[1:])) for row in all_seen], key=repr)
    plan = spark._jvm.PythonSQLUtils.explainString(seen._jdf.queryExecution(), "simple")
    assert plan.count("Exchange hashpartitioning") == 1


# --- pairings ---------------------------------------------------------------------------
def test_roll_pairings(spark, as_rows):
    schema = "client_variant string, client_id string, product_name string, product_guid string, last_active_dt date"
    old = spark.createDataFrame([("v", "a", "P", "g", day(1)), ("v", "b", "P", "g", day(5))], schema)
    new = spark.createDataFrame([("v", "a", "P", "g", day(3)), ("v", "b", "P", "g", day(3))], schema)
    got = pairings.roll_pairings(new, old, "2024-01-03")
    assert as_rows(got, "client_id", "last_active_dt", "airflow_ds") == [
        ("a", day(3), day(3)), ("b", day(5), day(3))]


def test_latest_pairings_keep_unknown_products(spark, as_rows):
    users = spark.createDataFrame(
        [("v", "a", "p1", "N", day(1)), ("v", "a", "p9", "N", day(2)), ("v", "a", "p8", "N", day(3)),
         ("v", "a", None, " ", day(3))],
        "client_variant string, client_id string, product_id string, product_name string, partition_date date")
    products = spark.createDataFrame([("p1", "g1")], "product_id string, product_guid string")
    assert as_rows(pairings.latest_pairings(users, products), "product_guid", "last_active_dt") == [
        ("g1", day(1)), (None, day(3))]


# --- look back and crashes --------------------------------------------------------------
@pytest.mark.parametrize("width,fine", [(1, None), (7, 3), (1000, None), (1000, 5), (40, 1)])
def test_previous_row_equals_lag(spark, as_rows, width, fine):
    pick = random.Random(width)
    rows = [(pick.choice(["a", "a", "b", None]), t, pick.choice([None, 1, 2])) for t in range(120)]
    frame = spark.createDataFrame(rows, "k string, t int, v int").repartition(5)
    bucketed = with_previous(frame, ["k"], F.floor(F.col("t") / width), ["t"], ["t", "v"],
                             finer=fine and F.floor(F.col("t") / fine))
    lag = F.lag(F.struct("t", "v")).over(Window.partitionBy("k").orderBy("t"))
    assert as_rows(bucketed, "k", "t", "prev.t", "prev.v") == as_rows(
        frame.withColumn("prev", lag), "k", "t", "prev.t", "prev.v")


DEVICE = ("event_local_date date, device_component_guid string, device_session_id string, "
          "device_mono_time long, client_variant string, client_firmware_version string, "
          "client_version_core string, product_sku string, product_model_name string, "
          "bt_device_state string, event_name string, event_timestamp_ms long, decode_success boolean")


def device_rows(spark, seed, n=300):
    pick = random.Random(seed)
    out = []
    for i in range(n):
        fw = pick.choice(["1.0", "1.1", None])
        out.append((day(pick.randint(1, 6)), pick.choice(["d1", "d2", "d3", None]),
                    pick.choice(["s1", "s2", "", None]), pick.choice([None, *range(40)]), "prod", fw, fw,
                    pick.choice(["A", "B"]), "m", pick.choice(["connected", "disconnected", None]),
                    "e", i, pick.random() > 0.05))
    return spark.createDataFrame(out, DEVICE)


COUNTS = ("event_local_date", "device_component_guid", "client_firmware_version", "crash_cnt_total",
          "crash_cnt_product", "session_cnt", "bt_disconnected_cnt", "product_sku")


@pytest.mark.parametrize("seed", range(4))
def test_crash_counts_from_day_extremes_equal_event_look_back(spark, as_rows, seed):
    events = device_rows(spark, seed, 300 if seed else 25)
    fast = device_marts.crash_counts(events, ALL, zero_fill=True)
    slow = device_marts.aggregate_crashes(
        device_marts.detect_crashes(device_marts.valid_events(events, ALL)), zero_fill=True)
    assert as_rows(fast, *COUNTS, "crash_cnt_user") == as_rows(slow, *COUNTS, "crash_cnt_user")


def test_crash_counts_in_uptime_order_deal_rows_thrice(spark, as_rows):
    """Also sessions without a name, or seen with several states, count as they did."""
    events = device_rows(spark, 9).withColumn("product_sku", F.lit("A")).repartition(3)
    counts = device_marts.crash_counts(events, ALL)
    distinct = device_marts.valid_events(events, ALL).groupBy(*COUNTS[:3]).agg(
        F.count_distinct("device_session_id").alias("session_cnt"))
    assert as_rows(counts, *COUNTS[:3], "session_cnt") == as_rows(distinct)
    plan = spark._jvm.PythonSQLUtils.explainString(counts._jdf.queryExecution(), "simple")
    assert plan.count("Exchange hashpartitioning") == 3


def test_crash_orders(spark):
    uptimes = [(1, 100), (1, 5), (1, 50), (2, 20)]
    events = spark.createDataFrame(
        [(day(d), "d", "s", up, "prod", "1.0", "1.0", "A", "m", "connected", "e", i, True)
         for i, (d, up) in enumerate(uptimes)], DEVICE)
    total = lambda f: f.agg(F.sum("crash_cnt_total")).first()[0]
    assert total(device_marts.crash_counts(events, ALL)) == 1
    assert total(device_marts.crash_counts(events, ALL, "event_time")) == 2
    one_day = DateWindow(day(2), day(2))
    assert total(device_marts.crash_counts(events, one_day)) == 0
    looked = device_marts.detect_crashes(
        events.where(F.col("event_local_date") == F.lit(day(2))), "event_time",
        lookback=events.where(F.col("event_local_date") == F.lit(day(1))))
    assert [r.is_crash for r in looked.collect()] == [True]
    with pytest.raises(ValueError):
        device_marts.detect_crashes(events, "other")


def test_look_back_by_event_time_deals_rows_twice(spark):
    """By device and minute, then the edges of minutes by device."""
    rows = spark.range(200).selectExpr(
        "concat('d', id % 3) AS device_component_guid", "id * 37000 AS event_timestamp_ms", "(id * 7) % 50 AS device_mono_time",
        "'1.0' AS client_firmware_version", "concat('s', id % 5) AS device_session_id", "'connected' AS bt_device_state",
        "DATE'2024-01-01' AS event_local_date")
    marked = device_marts.detect_crashes(rows, "event_time")
    plain = F.lag("device_mono_time").over(Window.partitionBy("device_component_guid").orderBy("event_timestamp_ms"))
    wrong = marked.withColumn("_lag", plain).where("NOT (_lag <=> prev_mono_time)")
    assert marked.count() == 200 and wrong.count() == 0
    plan = spark._jvm.PythonSQLUtils.explainString(marked._jdf.queryExecution(), "simple")
    assert plan.count("Exchange hashpartitioning") == 2


def test_crash_flags_with_unknown_state(spark):
    events = spark.createDataFrame(
        [(day(1), "d", None, 50, "prod", "1.0", "1.0", "A", "m", None, "e", 1, True),
         (day(2), "d", "", 10, "prod", "1.0", "1.0", "A", "m", None, "e", 2, True)], DEVICE)
    (row,) = device_marts.crash_counts(events, ALL).where(F.col("event_local_date") == F.lit(day(2))).collect()
    assert (row.crash_cnt_total, row.crash_cnt_user, row.crash_cnt_product) == (1, None, 0)
    (row,) = device_marts.crash_counts(events, ALL, zero_fill=True).where(
        F.col("event_local_date") == F.lit(day(2))).collect()
    assert row.crash_cnt_user == 0


def test_session_sets_repeat_session_values(spark, as_rows):
    events = spark.createDataFrame(
        [(day(1), "d", "s", up, "prod", fw, fw, "A", "m", state, "e", i, True)
         for i, (up, fw, state) in enumerate([
             (5, "1.0", "connected"), (9, "1.1", None), (7, "1.0", "disconnected"),
             (7, "1.1", "connected"), (None, "1.0", "connected")])], DEVICE)
    got = device_marts.session_sets(events, ALL)
    assert as_rows(got, "client_firmware_version", "session_mono_time_start", "session_mono_time_end",
                   "session_event_count", "final_bt_device_state", "bt_connect_count",
                   "bt_disconnect_count") == [
        ("1.0", 5, 9, 5, "disconnected", 3, 1), ("1.1", 5, 9, 5, "disconnected", 3, 1)]


def test_session_counts_span_dates(spark, as_rows):
    rows = spark.createDataFrame(
        [(day(1), "s"), (day(1), "s"), (day(2), "s"), (day(9), "s"), (day(1), None)],
        "event_local_date date, device_session_id string").withColumn(
        "client_variant", F.lit("v")).withColumn("device_component_guid", F.lit("d"))
    got = device_marts.session_event_counts(rows, DateWindow(day(1), day(2)), "n")
    assert as_rows(got, "device_session_id", "event_local_date", "n") == [
        ("s", day(1), 3), ("s", day(2), 3), (None, day(1), 1)]


def test_connectivity_duration(spark):
    events = spark.createDataFrame(
        [(day(1), "d", "s", up, "prod", "1", "1", "A", "m", state, "e", up, True)
         for up, state in [(0, "connected"), (10, None), (15, "connected"), (40, "disconnected"), (50, None)]],
        DEVICE)
    for width in (1, 20, 10_000):
        assert device_marts.connectivity_duration(events, ALL, width).first().connected_ms == 35


# --- dimensions -------------------------------------------------------------------------
def test_calendar(spark):
    got = dimensions.calendar_around(spark, "2024-06-15")
    assert got.count() == 2923
    (row,) = got.where("date_key = 20241230").collect()
    assert (row.week_of_year, row.day_of_week, row.day_name, row.month_name, row.is_weekend) == (
        1, 1, "Monday", "December", False)
    assert got.where("is_weekend = is_weekday").count() == 0


def test_catalogues(spark):
    assert dimensions.active_products(dimensions.product_catalogue_v1(spark)).count() == 4
    got = {r.product_code: r for r in dimensions.product_catalogue_v2(spark, "2024-01-01").collect()}
    assert (got["PRODUCT_A"].months_since_launch, got["PRODUCT_D"].lifecycle_status) == (34, "End of Life")


def test_device_models(spark):
    events = spark.createDataFrame(
        [("iPhone 15", "9.1", day(1)), ("iPhone 15", "17.4", day(2)), ("Mate", "4", day(3)), ("", "1", day(1))],
        "client_os_name string, client_os_version string, partition_date date")
    text = {r.device_model_name: r for r in dimensions.device_models(events, "2024-04-02").collect()}
    assert (text["iPhone 15"].os_version_min, text["iPhone 15"].os_version_max) == ("17.4", "9.1")
    assert (text["iPhone 15"].platform, text["iPhone 15"].manufacturer) == ("iOS", "Apple")
    assert (text["Mate"].device_model_key, text["iPhone 15"].device_model_key) == (1, 2)
    assert (text["Mate"].is_active, text["iPhone 15"].is_active) == (True, False)
    numeric = {r.device_model_name: r for r in dimensions.device_models(
        events, "2024-04-02", numeric_versions=True).collect()}
    assert (numeric["iPhone 15"].os_version_min, numeric["iPhone 15"].os_version_max) == ("9.1", "17.4")
    plan = dimensions.device_models(events, "2024-04-02")._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


def test_numbered(spark):
    from pulsegrid.operators.numbering import numbered

    rows = spark.range(1000).selectExpr("(id * 37) % 1000 AS x", "id % 3 AS y").repartition(7)
    got = numbered(rows, ("y", "x"), "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 1001))
    assert [(r.y, r.x) for r in got] == sorted((r.y, r.x) for r in got)
    assert numbered(rows.limit(0), ("y", "x"), "n").count() == 0


# --- checks -----------------------------------------------------------------------------
def test_checks(spark):
    rows = [day(1)] * 10 + [day(2)] * 4 + [day(3)] * 4
    table = spark.createDataFrame([(d, i) for i, d in enumerate(rows)], "partition_date date, i int")
    quality.assert_checks(quality.check_non_zero(table, "t", day(2)), quality.check_day_ratio(table, "t", day(3)))
    (bad,) = quality.check_day_ratio(table, "t", day(2)).collect()
    assert bad.status == "FAIL: day-over-day ratio out of bounds (0.4x)" and bad.day_ratio == 0.4
    with pytest.raises(quality.CheckFailed, match="zero rows"):
        quality.assert_checks(quality.check_report_rows(table, "t", day(4)))
    assert quality.check_day_ratio(table, "t", day(1)).first().status == "PASS"


def test_schema_checks(spark):
    table = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("c", None)], "k string, v int")
    parent = spark.createDataFrame([("a",)], "k string")
    status = lambda f: [(r.violations, r.status) for r in f.collect()]
    assert status(quality.check_not_null(table, "t", ["k", "v"])) == [(1, "FAIL"), (1, "FAIL")]
    assert status(quality.check_unique(table, "t", ["k"])) == [(1, "FAIL")]
    assert status(quality.check_unique(table, "t", ["v"])) == [(0, "PASS")]
    assert status(quality.check_accepted_values(table, "t", "k", ["a", "c"])) == [(0, "PASS")]
    assert status(quality.check_relationship(table, "t", "k", parent, "k")) == [(1, "FAIL")]
    assert status(quality.check_relationship(parent, "t", "k", table, "k")) == [(0, "PASS")]
