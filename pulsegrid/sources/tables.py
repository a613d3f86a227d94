"""Catalogue tables and the writes the warehouse jobs need, on plain Parquet.

Parquet tables know neither DELETE nor MERGE. A date window is replaced by a dynamic partition
overwrite followed by dropping the window's partitions that got no rows. Old files stay until the
write commits, so a lost executor or a failed job leaves the old rows in place, and a second run
gives the same table. Merges and deletes rewrite only the files that hold rows they change
(``publish``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.operators.date_windows import DateWindow, as_date
from pulsegrid.sources import evolution, publish, scratch


@dataclass(frozen=True)
class TableSpec:
    """Name, columns and layout of a table.

    ``required`` columns reject nulls, ``defaults`` replace them, and rows are sorted by
    ``sort_by`` within a file so that row-group statistics prune. ``spread`` is for tables of few, large
    partitions: rows of one are dealt by ``sort_by`` to as many tasks at most as it says, where
    otherwise one task would write all that lies below the size that is split.
    """

    name: str
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    defaults: Mapping[str, object] = field(default_factory=dict)
    sort_by: tuple[str, ...] = ()
    comment: str = ""
    columns_comment: Mapping[str, str] = field(default_factory=dict)
    spread: int = 1


@dataclass(frozen=True)
class WriteReport:
    """Rows written, partitions written and dropped, and the files that were rewritten one by one."""

    rows: int
    partitions: list[tuple]
    dropped: list[tuple]
    files: list[str] = field(default_factory=list)


def spec_of(frame: DataFrame, name: str, **layout) -> TableSpec:
    """A spec with the columns of ``frame``."""
    return TableSpec(name, T.StructType([T.StructField(f.name, f.dataType) for f in frame.schema]),
                     **layout)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def create_table(spark: SparkSession, spec: TableSpec) -> None:
    def column(f: T.StructField) -> str:
        note = spec.columns_comment.get(f.name)
        text = f"`{f.name}` {f.dataType.simpleString()}"
        return f"{text} COMMENT '{_quoted(note)}'" if note else text

    ddl = f"CREATE TABLE IF NOT EXISTS {spec.name} ({', '.join(column(f) for f in spec.schema)})"
    ddl += " USING parquet"
    if spec.partition_by:
        ddl += f" PARTITIONED BY ({', '.join(f'`{c}`' for c in spec.partition_by)})"
    if spec.comment:
        ddl += f" COMMENT '{_quoted(spec.comment)}'"
    spark.sql(ddl)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def conform(frame: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns of ``spec`` in order: missing ones null, nulls defaulted, required ones checked."""
    have = {f.name: f.dataType for f in frame.schema}
    extra = have.keys() - set(spec.schema.names)
    if extra:
        raise ValueError(f"{spec.name} has no column {', '.join(sorted(extra))}")

    def column(f: T.StructField) -> Column:
        value = evolution.shaped(F.col(f.name), have[f.name], f.dataType, f"{spec.name}.{f.name}") if f.name in have else (
            F.lit(None).cast(f.dataType))
        if f.name in spec.defaults:
            value = F.coalesce(value, F.lit(spec.defaults[f.name]).cast(f.dataType))
        if f.name in spec.required:
            refuse = F.raise_error(F.lit(f"{spec.name}.{f.name} is null")).cast(f.dataType)
            value = F.coalesce(value, refuse)
        return value.alias(f.name)

    names = [c for c in spec.schema.names if c not in spec.partition_by] + list(spec.partition_by)
    return frame.select(*[column(spec.schema[n]) for n in names])


def sync_columns(spark: SparkSession, spec: TableSpec, frame: DataFrame) -> TableSpec:
    """Make the table take ``frame``: columns and struct fields that it has more are added, types are
    widened, and what it lacks will be written as null. Files stay as they are and are read as the
    wider type; types that would lose values are refused before anything changes."""
    create_table(spark, spec)
    evolution.widen(spark, spec.name, frame.schema, spec.partition_by)
    schema = spark.table(spec.name).schema
    return TableSpec(spec.name, schema, spec.partition_by, spec.required, spec.defaults,
                     spec.sort_by, spec.comment, spec.columns_comment, spec.spread)


# --- writing ----------------------------------------------------------------------------
@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _insert(frame: DataFrame, spec: TableSpec, overwrite: bool) -> tuple[int, list[tuple]]:
    """Write, and learn row count and partitions from the write itself instead of a second job.

    Rows of one partition are brought together with a rebalance, which AQE splits where a
    partition is large and merges where it is small; a date with a third of the rows is written
    by many tasks.
    """
    seen = Observation()
    frame = _laid_out(frame, spec).observe(seen, *[c.alias(n) for n, c in _metrics(spec).items()])
    with _dynamic_overwrite(frame.sparkSession):
        frame.write.insertInto(spec.name, overwrite=overwrite)
    written = seen.get
    return int(written["rows"]), [tuple(p) for p in written.get("partitions", [])]


def _laid_out(frame: DataFrame, spec: TableSpec) -> DataFrame:
    parts = list(spec.partition_by)
    if parts and spec.spread > 1:
        share = F.pmod(F.xxhash64(*spec.sort_by), F.lit(spec.spread))
        dealt = frame.withColumn("_share", share).hint("rebalance", *[F.col(p) for p in (*parts, "_share")])
        return dealt.sortWithinPartitions(*parts, *spec.sort_by).drop("_share")
    if parts:
        frame = frame.hint("rebalance", *[F.col(p) for p in parts])
    return frame.sortWithinPartitions(*parts, *spec.sort_by) if parts or spec.sort_by else frame


def _metrics(spec: TableSpec) -> dict[str, Column]:
    metrics = {"rows": F.count(F.lit(1))}
    if spec.partition_by:
        metrics["partitions"] = F.collect_set(F.struct(*spec.partition_by))
    return metrics


def append_table(frame: DataFrame, spec: TableSpec) -> WriteReport:
    create_table(frame.sparkSession, spec)
    rows, parts = _insert(conform(frame, spec), spec, overwrite=False)
    return WriteReport(rows, parts, [])


def full_refresh(frame: DataFrame, spec: TableSpec) -> WriteReport:
    """Replace all rows of a table."""
    spark = frame.sparkSession
    create_table(spark, spec)
    new = conform(frame, spec)
    if not spec.partition_by:
        rows, parts = _insert(new, spec, overwrite=True)
        return WriteReport(rows, parts, [])
    rows, parts = _insert(new, spec, overwrite=True)
    dropped = [p for p in partitions(spark, spec) if p not in set(parts)]
    _drop(spark, spec, dropped)
    return WriteReport(rows, parts, dropped)


def replace_window(frame: DataFrame, spec: TableSpec, window: DateWindow,
                   where: Mapping[str, object] | None = None) -> WriteReport:
    """Make ``frame`` the only content of the window's dates.

    The first partition column is the date. ``where`` limits the replacement to given values (one
    or a list) of further partition columns, such as one event name. A row outside that scope
    fails the job before anything is committed. Dates of the window without new rows end up empty.
    """
    spark = frame.sparkSession
    create_table(spark, spec)
    date = spec.partition_by[0]
    scope = {c: list(v) if isinstance(v, (list, tuple, set)) else [v]
             for c, v in (where or {}).items()}
    inside = window.holds(date)
    for column, values in scope.items():
        if column not in spec.partition_by:
            raise ValueError(f"{column} is not a partition column of {spec.name}")
        inside = inside & F.col(column).isin(values)
    refuse = F.raise_error(F.lit(f"row outside the replaced part of {spec.name}")).cast("date")
    new = conform(frame, spec)
    guarded = F.when(F.coalesce(inside, F.lit(False)), F.col(date)).otherwise(refuse)
    new = new.withColumn(date, guarded)
    rows, parts = _insert(new, spec, overwrite=True)
    written = set(parts)
    position = {c: spec.partition_by.index(c) for c in scope}
    stale = [
        p for p in _window_partitions(spark, spec, window)
        if p not in written and all(p[position[c]] in values for c, values in scope.items())]
    _drop(spark, spec, stale)
    return WriteReport(rows, parts, stale)


class AuditFailed(ValueError):
    """A write that was not published; ``counters`` has the rows and every check's violations."""

    def __init__(self, table: str, counters: Mapping[str, int], broken: Sequence[str]):
        super().__init__(f"{table} is unchanged: " + ", ".join(f"{n} {counters[n]}" for n in broken))
        self.counters, self.broken = dict(counters), list(broken)


def audited_replace(frame: DataFrame, spec: TableSpec, window: DateWindow, checks: Mapping[str, Column],
                    least_rows: int = 1, ratio: tuple[float, float] | None = None) -> dict[str, int]:
    """``replace_window`` that readers see only if the written rows pass: write, audit, publish.

    ``checks`` names conditions that no row may meet. They and the row count are gathered in the one
    pass that writes the rows, into files that are not visible yet. ``ratio`` bounds the rows of the
    window against those of as many days before it, if there are any. Null conditions are not met.
    On failure the files are gone and ``AuditFailed`` tells the counts; else they are returned.
    """
    spark = frame.sparkSession
    create_table(spark, spec)
    publish.recover(spark, spec.name)
    date, rows = spec.partition_by[0], conform(frame, spec)
    outside = ~F.coalesce(window.holds(date), F.lit(False))
    metrics = {**_metrics(spec), "outside the window": F.count_if(outside),
               **{name: F.count_if(F.coalesce(bad, F.lit(False))) for name, bad in checks.items()}}
    folder, seen = publish.stage(_laid_out(rows, spec), spec.name, spec.partition_by, metrics)
    counters = {name: int(seen[name]) for name in metrics if name != "partitions"}
    broken = [name for name in ("outside the window", *checks) if counters[name]]
    broken += ["rows"] if counters["rows"] < least_rows else []
    if ratio is not None:
        days = (window.hi - window.lo).days + 1
        before = DateWindow(window.lo - dt.timedelta(days=days), window.lo - dt.timedelta(days=1))
        counters["rows before"] = spark.table(spec.name).where(before.holds(date)).count()
        known = counters["rows before"]
        broken += ["rows before"] if known and not ratio[0] <= counters["rows"] / known <= ratio[1] else []
    if broken:
        publish.Files(spark, folder).delete(folder)
        raise AuditFailed(spec.name, counters, broken)
    old = publish.touched_files(spark.table(spec.name).where(window.holds(date)))
    publish.publish(spark, spec.name, folder, old)
    written = {tuple(p) for p in seen.get("partitions", [])}
    _drop(spark, spec, [p for p in _window_partitions(spark, spec, window) if p not in written])
    return counters


def merge_update(source: DataFrame, spec: TableSpec, keys: Sequence[str], set_columns: Sequence[str],
                 window: DateWindow) -> WriteReport:
    """Set columns of matching rows from ``source`` (one row per key) in the window's partitions.

    Null keys match nothing. A key that ``source`` has twice fails the job before anything is
    committed. Only files with a row that gets another value are rewritten; all others keep their
    name and time, so a second run touches none.
    """
    spark = source.sparkSession
    publish.recover(spark, spec.name)
    refuse = F.raise_error(F.lit(f"several new values for a key of {spec.name}")).cast("boolean")
    updates = scratch.written(source.dropna(subset=list(keys)).groupBy(*keys).agg(
        *[F.first(c).alias(f"_new_{c}") for c in set_columns],
        F.when(F.count(F.lit(1)) > 1, refuse).otherwise(True).alias("_hit")), "updates")
    target = spark.table(spec.name).where(window.holds(spec.partition_by[0]))
    kinds = {c: spec.schema[c].dataType for c in set_columns}
    differs = reduce(lambda a, b: a | b, [
        ~F.col(c).eqNullSafe(F.col(f"_new_{c}").cast(kinds[c])) for c in set_columns])
    files = publish.touched_files(
        target.withColumn("_file", F.col(publish.FILE)).join(updates, list(keys)).where(differs), "_file")
    joined = _rows_of(spark, spec, files).join(updates, list(keys), "left")
    merged = joined.select(*[
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        if c in set_columns else F.col(c)
        for c in target.columns])
    return _rewrite(conform(merged, spec), spec, files)


def delete_rows(spark: SparkSession, spec: TableSpec, condition: Column) -> WriteReport:
    """Delete the rows that meet ``condition``; only the files that hold one are rewritten."""
    publish.recover(spark, spec.name)
    gone = F.coalesce(condition, F.lit(False))
    files = publish.touched_files(spark.table(spec.name).where(gone))
    return _rewrite(conform(_rows_of(spark, spec, files).where(~gone), spec), spec, files)


def _rows_of(spark: SparkSession, spec: TableSpec, files: Sequence[str]) -> DataFrame:
    """All rows of some files of a table; a filter on the path keeps the scan from all others."""
    return spark.table(spec.name).where(F.col(publish.FILE).isin(list(files)))


def _rewrite(frame: DataFrame, spec: TableSpec, files: Sequence[str]) -> WriteReport:
    """Put the rows of ``frame`` in place of some files of a table."""
    if not files:
        return WriteReport(0, [], [])
    folder, seen = publish.stage(_laid_out(frame, spec), spec.name, spec.partition_by, _metrics(spec))
    publish.publish(frame.sparkSession, spec.name, folder, files)
    return WriteReport(int(seen["rows"]), [tuple(p) for p in seen.get("partitions", [])], [], list(files))


def replace_keys(frame: DataFrame, spec: TableSpec, keys: Sequence[str], affected: DataFrame
                 ) -> WriteReport:
    """Delete the rows whose ``keys`` are in ``affected`` and insert ``frame``.

    ``keys`` must include the first partition column; only the partitions that ``affected`` or
    ``frame`` name are rewritten.
    """
    spark = frame.sparkSession
    create_table(spark, spec)
    date = spec.partition_by[0]
    if date not in keys:
        raise ValueError(f"keys must include {date}")
    gone = affected.select(*keys).distinct()
    new = conform(frame, spec)
    touched = gone.select(date).union(new.select(date)).distinct()
    old = spark.table(spec.name).join(touched, date, "left_semi")
    kept = old.join(gone, list(keys), "left_anti")
    rows, parts = _insert(conform(kept, spec).unionByName(new), spec, overwrite=True)
    # of the touched dates, those that exist as partitions and got no rows
    written = {p[0] for p in parts}
    emptied = {r[0] for r in touched.collect()} - written
    stale = [p for p in partitions(spark, spec) if p[0] in emptied] if emptied else []
    _drop(spark, spec, stale)
    return WriteReport(rows, parts, stale)


def snapshot_then_replace(spark: SparkSession, spec: TableSpec, ds: str | dt.date,
                          build: Callable[[DataFrame], DataFrame]) -> WriteReport:
    """State table partitioned by run date: ``build(old state)`` becomes the state of ``ds``.

    The state is read from the newest partition, and older partitions are dropped only after the
    new one is committed. A rerun for ``ds`` builds on its own first result, which merges by maximum
    leave unchanged. A date before the newest state is refused: the state it would build on is gone.
    """
    create_table(spark, spec)
    date = spec.partition_by[0]
    day = as_date(ds)
    runs = sorted(p[0] for p in partitions(spark, spec) if p[0])
    if runs and runs[-1] > day:
        raise ValueError(f"{spec.name} already has the state of {runs[-1]}, later than {day}")
    table = spark.table(spec.name)
    old = table.where(F.col(date) == F.lit(runs[-1])) if runs else table.where(F.lit(False))
    new = build(old).withColumn(date, F.lit(day))
    rows, parts = _insert(conform(new, spec), spec, overwrite=True)
    stale = [p for p in partitions(spark, spec) if p[0] and p[0] < day]
    _drop(spark, spec, stale)
    return WriteReport(rows, parts, stale)


def current_state(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """The newest state of such a table."""
    runs = [p[0] for p in partitions(spark, spec) if p[0]]
    table = spark.table(spec.name)
    return table.where(F.col(spec.partition_by[0]) == F.lit(max(runs))) if runs else table


def prune_before(spark: SparkSession, spec: TableSpec, ds: str | dt.date, days: int) -> list[tuple]:
    """Drop partitions dated before ``ds - days``."""
    first = as_date(ds) - dt.timedelta(days=days)
    stale = [p for p in partitions(spark, spec) if p[0] and p[0] < first]
    _drop(spark, spec, stale)
    return stale


# --- partitions -------------------------------------------------------------------------
def partitions(spark: SparkSession, spec: TableSpec, fixed: Mapping[str, object] | None = None
               ) -> list[tuple]:
    """Partition values of the table, optionally only those with the ``fixed`` values."""
    where = ""
    if fixed:
        where = " PARTITION (" + ", ".join(_equals(spec, c, v) for c, v in fixed.items()) + ")"
    rows = spark.sql(f"SHOW PARTITIONS {spec.name}{where}").collect()
    return [tuple(_typed(spec, *piece.split("=", 1)) for piece in r[0].split("/")) for r in rows]


def _window_partitions(spark: SparkSession, spec: TableSpec, window: DateWindow) -> list[tuple]:
    """Partitions dated in the window."""
    return [p for p in partitions(spark, spec) if p[0] and window.lo <= p[0] <= window.hi]


def _typed(spec: TableSpec, column: str, text: str):
    from urllib.parse import unquote

    kind = spec.schema[column].dataType
    if text == "__HIVE_DEFAULT_PARTITION__" or text == "null":
        return None
    if isinstance(kind, T.DateType):
        return dt.date.fromisoformat(text)
    if isinstance(kind, (T.IntegerType, T.LongType, T.ShortType)):
        return int(text)
    if isinstance(kind, T.BooleanType):
        return text == "true"
    return unquote(text)


def _equals(spec: TableSpec, column: str, value) -> str:
    if value is None:
        return f"`{column}`=null"
    if isinstance(value, dt.date):
        return f"`{column}`=DATE'{value}'"
    if isinstance(value, bool):
        return f"`{column}`={str(value).lower()}"
    if isinstance(value, int):
        return f"`{column}`={value}"
    return f"`{column}`='{_quoted(str(value))}'"


def _drop(spark: SparkSession, spec: TableSpec, values: Sequence[tuple]) -> None:
    for start in range(0, len(values), 200):
        pieces = ", ".join(
            "PARTITION (" + ", ".join(_equals(spec, c, v) for c, v in zip(spec.partition_by, p)) + ")"
            for p in values[start:start + 200])
        spark.sql(f"ALTER TABLE {spec.name} DROP IF EXISTS {pieces}")


# --- fan-out ----------------------------------------------------------------------------
@contextmanager
def staged(frame: DataFrame, name: str, partition_by: Sequence[str] = ()) -> Iterator[DataFrame]:
    """``frame`` written once to a managed table and read back, dropped at the end.

    For a frame that feeds several writes: the work behind it is done once, a lost executor costs
    nothing of it, and each reader prunes to its partitions.
    """
    spark = frame.sparkSession
    spec = spec_of(frame, name, partition_by=tuple(partition_by))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_table(spark, spec)
    try:
        _insert(conform(frame, spec), spec, overwrite=True)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def split_valid_invalid(frame: DataFrame, flag: str = "decode_success"
                        ) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) views of a frame that should be staged or read from a table."""
    ok = F.coalesce(F.col(flag), F.lit(False))
    return frame.where(ok), frame.where(~ok)


def split_required(frame: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(rows that ``spec`` takes, the others with ``missing``, the names of the columns they lack)."""
    lacking = F.concat_ws(",", *[
        F.when(F.col(c).isNull(), F.lit(c)) for c in spec.required if c not in spec.defaults])
    marked = frame.withColumn("missing", lacking)
    return marked.where("missing = ''").drop("missing"), marked.where("missing != ''")


def route_by_type(frame: DataFrame, routes: Mapping[str, TableSpec], column: str = "event_name"
                  ) -> dict[str, WriteReport]:
    """Append the rows of every routed type to its table; other types are left out."""
    return {spec.name: append_table(frame.where(F.col(column) == kind), spec)
            for kind, spec in routes.items()}
