"""Row predicates shared by the daily tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrid.functions.values import CLIENT_PLATFORMS, TEST_TRAFFIC_PATTERNS


def present(column: str | Column) -> Column:
    """Neither null nor blank; a null yields null and so never passes a filter."""
    return F.trim(_col(column)) != ""


def not_test_traffic(name: str | Column) -> Column:
    """Name matches no test pattern.

    ``_`` is LIKE's one-character wildcard, so ``atest`` is dropped and ``test`` is kept, and a
    null name drops the row, as in the warehouse queries.
    """
    return reduce(lambda a, b: a & b, [~_col(name).like(p) for p in TEST_TRAFFIC_PATTERNS])


def not_flagged_test(flag: str | Column) -> Column:
    return F.coalesce(_col(flag), F.lit(False)) == F.lit(False)


def is_dev_build(variant: str | Column) -> Column:
    return F.when(_col(variant) == "dev", F.lit(True)).otherwise(F.lit(False))


def guid_shaped(guid: str | Column) -> Column:
    return F.length(_col(guid)) == 36


def platform_of(client_name: str | Column) -> Column:
    pairs = [F.lit(x) for item in CLIENT_PLATFORMS.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), _col(client_name))


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
