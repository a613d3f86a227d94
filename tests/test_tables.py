"""Table writes: every one is run twice, and dates or keys without new rows are looked at."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulsegrid.operators.date_windows import DateWindow, backfill_window, event_window, logical_date
from pulsegrid.sources import exports, readers, tables
from pulsegrid.sources.tables import TableSpec

D = dt.date.fromisoformat


def spec(database, **layout):
    return TableSpec(f"{database}.facts", StructType.fromDDL("k string, v int, d date"),
                     partition_by=("d",), **layout)


def frame(spark, *rows):
    return spark.createDataFrame([(k, v, D(d)) for k, v, d in rows], "k string, v int, d date")


def content(spark, table, as_rows):
    return as_rows(spark.table(table.name), "k", "v", F.col("d").cast("string"))


def test_windows():
    assert backfill_window("2024-03-10", 3) == DateWindow(D("2024-03-07"), D("2024-03-10"))
    assert backfill_window("2023-01-02", 9).lo == D("2023-01-01")
    assert event_window("a", "2024-03-10", 1, {"a": 5}).lo == D("2024-03-05")
    assert event_window("b", "2024-03-10", 1, {"a": 5}).lo == D("2024-03-09")
    assert event_window("a", "2024-03-10", 1, {"a": 5}, override=2).lo == D("2024-03-08")
    assert backfill_window("2022-01-01", 1).dates() == []
    assert logical_date(None, dt.datetime(2024, 3, 1, 5)) == D("2024-03-01")
    assert logical_date("2024-03-02", dt.datetime(2024, 3, 1, 5)) == D("2024-03-02")
    with pytest.raises(ValueError):
        logical_date(None)


def test_replace_window(spark, database, as_rows):
    t = spec(database)
    tables.append_table(frame(spark, ("a", 1, "2024-01-01"), ("b", 2, "2024-01-02"),
                              ("c", 3, "2024-01-03"), ("d", 4, "2024-01-04")), t)
    window = DateWindow(D("2024-01-02"), D("2024-01-03"))
    for _ in range(2):
        report = tables.replace_window(frame(spark, ("n", 9, "2024-01-02")), t, window)
        assert report.rows == 1
        assert content(spark, t, as_rows) == [
            ("a", 1, "2024-01-01"), ("d", 4, "2024-01-04"), ("n", 9, "2024-01-02")]
    tables.replace_window(frame(spark).where("false"), t, window)
    assert content(spark, t, as_rows) == [("a", 1, "2024-01-01"), ("d", 4, "2024-01-04")]


def test_replace_window_over_many_days(spark, database, as_rows):
    t = spec(database)
    tables.append_table(frame(spark, ("a", 1, "2024-01-01"), ("b", 2, "2024-01-20")), t)
    tables.replace_window(frame(spark, ("n", 9, "2024-01-15")), t,
                          DateWindow(D("2024-01-02"), D("2024-01-31")))
    assert content(spark, t, as_rows) == [("a", 1, "2024-01-01"), ("n", 9, "2024-01-15")]


def test_replace_window_refuses_rows_outside(spark, database, as_rows):
    t = spec(database)
    tables.append_table(frame(spark, ("a", 1, "2024-01-01"), ("b", 2, "2024-01-02")), t)
    with pytest.raises(Exception, match="outside the replaced part"):
        tables.replace_window(frame(spark, ("x", 1, "2024-01-01"), ("y", 1, "2024-01-02")), t,
                              DateWindow(D("2024-01-02"), D("2024-01-02")))
    assert content(spark, t, as_rows) == [("a", 1, "2024-01-01"), ("b", 2, "2024-01-02")]


def test_replace_window_of_one_event(spark, database, as_rows):
    t = TableSpec(f"{database}.events", StructType.fromDDL("v int, d date, event string"),
                  partition_by=("d", "event"))
    make = lambda *rows: spark.createDataFrame(
        [(v, D(d), e) for v, d, e in rows], "v int, d date, event string")
    tables.append_table(make((1, "2024-01-01", "x"), (2, "2024-01-01", "y"), (3, "2024-01-02", "x")), t)
    window = DateWindow(D("2024-01-01"), D("2024-01-02"))
    tables.replace_window(make((9, "2024-01-02", "x")), t, window, {"event": "x"})
    assert as_rows(spark.table(t.name), "v", "event") == [(2, "y"), (9, "x")]
    with pytest.raises(ValueError):
        tables.replace_window(make(), t, window, {"v": 1})


def test_full_refresh(spark, database, as_rows):
    t = spec(database)
    tables.full_refresh(frame(spark, ("a", 1, "2024-01-01"), ("b", 2, "2024-01-02")), t)
    tables.full_refresh(frame(spark, ("c", 3, "2024-01-02")), t)
    assert content(spark, t, as_rows) == [("c", 3, "2024-01-02")]
    flat = TableSpec(f"{database}.flat", StructType.fromDDL("k string"))
    tables.full_refresh(spark.createDataFrame([("a",)], "k string"), flat)
    tables.full_refresh(spark.createDataFrame([("b",)], "k string"), flat)
    assert as_rows(spark.table(flat.name)) == [("b",)]


def test_merge_update(spark, database, as_rows):
    t = TableSpec(f"{database}.target", StructType.fromDDL("k string, n int, d date"), ("d",))
    tables.append_table(spark.createDataFrame(
        [("a", None, D("2024-01-01")), ("a", 5, D("2024-01-02")), (None, 7, D("2024-01-02")),
         ("b", 6, D("2024-01-02"))], "k string, n int, d date"), t)
    source = spark.createDataFrame(
        [("a", D("2024-01-01"), 1), ("a", D("2024-01-02"), 2), (None, D("2024-01-02"), 3)],
        "k string, d date, n int")
    for _ in range(2):
        tables.merge_update(source, t, ["k", "d"], ["n"], DateWindow(D("2024-01-02"), D("2024-01-02")))
        assert as_rows(spark.table(t.name), "k", "n") == [("a", 2), ("a", None), ("b", 6), (None, 7)]


def test_merge_update_refuses_repeated_keys(spark, database, as_rows):
    t = TableSpec(f"{database}.target", StructType.fromDDL("k string, n int, d date"), ("d",))
    day = D("2024-01-01")
    tables.append_table(spark.createDataFrame([("a", 1, day), ("b", 2, day)], "k string, n int, d date"), t)
    source = spark.createDataFrame([("a", day, 5), ("a", day, 6)], "k string, d date, n int")
    with pytest.raises(Exception, match="several new values"):
        tables.merge_update(source, t, ["k", "d"], ["n"], DateWindow(day, day))
    assert as_rows(spark.table(t.name), "k", "n") == [("a", 1), ("b", 2)]


def test_replace_keys(spark, database, as_rows):
    t = spec(database)
    tables.append_table(frame(spark, ("a", 1, "2024-01-01"), ("b", 2, "2024-01-01"),
                              ("a", 3, "2024-01-02"), ("c", 4, "2024-01-03")), t)
    affected = frame(spark, ("a", 0, "2024-01-01"), ("c", 0, "2024-01-03"))
    for _ in range(2):
        tables.replace_keys(frame(spark, ("a", 9, "2024-01-01")), t, ["d", "k"], affected)
        assert content(spark, t, as_rows) == [
            ("a", 3, "2024-01-02"), ("a", 9, "2024-01-01"), ("b", 2, "2024-01-01")]


def test_snapshot_then_replace(spark, database, as_rows):
    t = TableSpec(f"{database}.state", StructType.fromDDL("k string, v int, run date"), ("run",))

    def adding(k, v):
        new = spark.createDataFrame([(k, v)], "k string, v int")
        return lambda old: new.unionByName(old.select("k", "v")).groupBy("k").agg(F.max("v").alias("v"))

    tables.snapshot_then_replace(spark, t, "2024-01-01", adding("a", 1))
    tables.snapshot_then_replace(spark, t, "2024-01-02", adding("a", 3))
    tables.snapshot_then_replace(spark, t, "2024-01-02", adding("b", 2))
    assert as_rows(spark.table(t.name), "k", "v", F.col("run").cast("string")) == [
        ("a", 3, "2024-01-02"), ("b", 2, "2024-01-02")]
    with pytest.raises(ValueError):
        tables.snapshot_then_replace(spark, t, "2024-01-01", adding("z", 1))
    assert as_rows(tables.current_state(spark, t), "k", "v") == [("a", 3), ("b", 2)]


def test_conform(spark, database, as_rows):
    t = spec(database, required=("k",), defaults={"v": 0})
    partial = spark.createDataFrame([("a", D("2024-01-01"))], "k string, d date")
    tables.append_table(partial, t)
    assert content(spark, t, as_rows) == [("a", 0, "2024-01-01")]
    with pytest.raises(Exception, match="k is null"):
        tables.append_table(frame(spark, (None, 1, "2024-01-01")), t)
    with pytest.raises(ValueError, match="no column"):
        tables.append_table(partial.withColumn("extra", F.lit(1)), t)


def test_sync_columns(spark, database, as_rows):
    t = spec(database)
    tables.append_table(frame(spark, ("a", 1, "2024-01-01")), t)
    wider = frame(spark, ("b", 2, "2024-01-02")).drop("v").withColumn("w", F.lit("new"))
    tables.append_table(wider, tables.sync_columns(spark, t, wider))
    assert as_rows(spark.table(t.name), "k", "v", "w") == [("a", 1, None), ("b", None, "new")]


def test_sync_widens_types_and_structs(spark, database, as_rows):
    first = "k string, v int, r float, m decimal(5,2), s struct<a:int,b:array<struct<x:int>>>, t map<string,int>, d date"
    then = "k string, v long, r double, m decimal(9,3), s struct<b:array<struct<x:long,y:string>>,c:string>, t map<string,long>, d date"
    t = TableSpec(f"{database}.evolving", StructType.fromDDL(first), partition_by=("d",))
    old = spark.createDataFrame([("old", 7, 0.5, Decimal("1.25"), (1, [(2,), None]), {"p": 3}, D("2024-01-01")),
                                 ("void", None, None, None, None, None, D("2024-01-01"))], first)
    tables.append_table(old, t)
    before = set(spark.table(t.name).inputFiles())
    big = 1 << 40
    new = spark.createDataFrame([("new", big, 0.1, Decimal("123456.125"), ([(big, "y")], "c"), {"q": big}, D("2024-01-02"))], then)
    wide = tables.sync_columns(spark, t, new)
    assert wide.schema["s"].dataType.simpleString() == "struct<a:int,b:array<struct<x:bigint,y:string>>,c:string>"
    tables.append_table(new, wide)
    tables.append_table(old.withColumn("d", F.lit(D("2024-01-03"))), tables.sync_columns(spark, wide, old))
    early = [("old", 7, 0.5, Decimal("1.250"), (1, [(2, None), None], None), {"p": 3}), ("void", *[None] * 5)]
    late = ("new", big, 0.1, Decimal("123456.125"), (None, [(big, "y")], "c"), {"q": big})

    def plain(vectors):
        spark.conf.set("spark.sql.parquet.enableVectorizedReader", vectors)
        return spark.table(t.name).drop("d").collect()

    try:
        for vectors in ("true", "false"):
            got = sorted((tuple(r) for r in plain(vectors)), key=lambda r: r[0])
            assert got == [late, early[0], early[0], early[1], early[1]]
    finally:
        spark.conf.unset("spark.sql.parquet.enableVectorizedReader")
    # filters reach old files as the wider type, and these are the files that were there
    assert as_rows(spark.table(t.name).where(f"v < {big} AND s.a = 1"), "v") == [(7,), (7,)]
    assert before <= set(spark.table(t.name).inputFiles())
    # another session of the same catalogue sees the wide types
    assert spark.newSession().table(t.name).schema == spark.table(t.name).schema


def test_sync_refuses_what_loses_values(spark, database, as_rows):
    t = spec(database)
    tables.append_table(frame(spark, ("a", 1, "2024-01-01")), t)
    was = spark.table(t.name).schema
    for change, message in (("k int, d date", "k is string"), ("v string, d date", "v is int"),
                            ("v long, k array<string>, d date", "k is string"), ("d timestamp", "d is date")):
        with pytest.raises(ValueError, match=message):
            tables.sync_columns(spark, t, spark.createDataFrame([], change))
    assert spark.table(t.name).schema == was
    by_number = TableSpec(f"{database}.by_number", StructType.fromDDL("k string, n int"), ("n",))
    tables.append_table(spark.createDataFrame([("a", 1)], "k string, n int"), by_number)
    with pytest.raises(ValueError, match="partitioned by n"):
        tables.sync_columns(spark, by_number, spark.createDataFrame([("a", 1)], "k string, n long"))
    # a narrower type needs no change, and struct fields that a table lacks are not dropped silently
    small = spark.createDataFrame([("b", 2, D("2024-01-02"))], "k string, v short, d date")
    tables.append_table(small, tables.sync_columns(spark, t, small))
    assert content(spark, t, as_rows) == [("a", 1, "2024-01-01"), ("b", 2, "2024-01-02")]
    nested = TableSpec(f"{database}.nested", StructType.fromDDL("s struct<a:int>"))
    with pytest.raises(ValueError, match="no field b"):
        tables.append_table(spark.createDataFrame([((1, 2),)], "s struct<a:int,b:int>"), nested)


def test_widened_table_is_merged_and_replaced(spark, database, as_rows):
    t = spec(database)
    tables.append_table(frame(spark, ("a", 1, "2024-01-01"), ("b", 2, "2024-01-02")), t)
    big = 1 << 40
    new = spark.createDataFrame([("b", big, D("2024-01-02"))], "k string, v long, d date")
    wide = tables.sync_columns(spark, t, new)
    tables.merge_update(new.drop("d"), wide, ["k"], ["v"], DateWindow(D("2024-01-01"), D("2024-01-02")))
    assert content(spark, t, as_rows) == [("a", 1, "2024-01-01"), ("b", big, "2024-01-02")]
    tables.replace_window(new.withColumn("d", F.lit(D("2024-01-01"))), wide, DateWindow(D("2024-01-01"), D("2024-01-01")))
    assert content(spark, t, as_rows) == [("b", big, "2024-01-01"), ("b", big, "2024-01-02")]


def test_prune_and_route(spark, database, as_rows):
    t = spec(database)
    tables.append_table(frame(spark, *[("a", i, f"2024-01-0{i}") for i in range(1, 6)]), t)
    tables.prune_before(spark, t, "2024-01-05", 2)
    assert [r[1] for r in content(spark, t, as_rows)] == [3, 4, 5]
    routes = {k: TableSpec(f"{database}.route_{k}", t.schema, ("d",)) for k in ("x", "y")}
    rows = frame(spark, ("x", 1, "2024-01-01"), ("y", 2, "2024-01-01"), ("z", 3, "2024-01-01"))
    assert {k: r.rows for k, r in tables.route_by_type(rows, routes, "k").items()} == {
        f"{database}.route_x": 1, f"{database}.route_y": 1}


def test_report_files(spark, database, tmp_path, as_rows):
    root = str(tmp_path / "reports")
    for _ in range(2):
        assert exports.export_parquet(frame(spark, ("a", 1, "2024-01-01")), root, "rate", "20240101") == 1
    exports.export_parquet(frame(spark, ("b", 2, "2024-01-02")), root, "rate", "20240102")
    for day in ("20240101", "20240102", "20240102"):
        exports.register_partition(spark, f"{database}.vw", frame(spark), day,
                                   exports.report_path(root, "rate", day))
    assert as_rows(spark.table(f"{database}.vw"), "k", "report_date") == [
        ("a", "20240101"), ("b", "20240102")]
    with pytest.raises(ValueError):
        exports.report_path(root, "rate", "2024-01-01")


def test_swap_statements():
    got = exports.swap_statements("ads", "ads_staging", ["a", "b"], "2024-01-10")
    assert [v for _, v in got] == [(D("2024-01-10"),), (), (D("2024-01-08"),)]
    assert got[1][0] == "INSERT INTO ads (a, b) SELECT a, b FROM ads_staging"


def test_read_raw_day(spark, tmp_path, as_rows):
    import gzip

    folder = tmp_path / "year=2024" / "month=01" / "day=02"
    folder.mkdir(parents=True)
    with gzip.open(folder / "part.json.gz", "wt") as out:
        out.write('{"a": 1}\n{"a": 2}\n')
    schema = StructType.fromDDL("a int")
    assert as_rows(readers.read_raw_day(spark, str(tmp_path), "2024-01-02", schema)) == [(1,), (2,)]
    with pytest.raises(ValueError):
        readers.read_raw_day(spark, str(tmp_path), None, schema)


def test_partition_pruning(spark, tmp_path):
    path = str(tmp_path / "events")
    frame(spark, ("a", 1, "2024-01-01"), (" ", 2, "2024-01-02"), ("c", 3, "2024-01-02")).withColumn(
        "dt", F.col("d").cast("string")).write.partitionBy("dt").parquet(path)
    rows = readers.read_events_window(spark, path, backfill_window("2024-01-02", 0), "k")
    assert [r.k for r in rows.collect()] == ["c"]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
