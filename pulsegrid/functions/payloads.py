"""Event-specific columns folded into one JSON text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def payload_object(columns: Iterable[str], available: Iterable[str] | None = None) -> Column:
    """JSON object of the named columns in their order; nulls are kept as JSON nulls.

    Columns absent from ``available`` become JSON nulls too, which is what an external table
    returns for a column that no record carries. No columns give ``{}``.
    """
    columns = list(columns)
    if not columns:
        return F.lit("{}")
    have = set(columns if available is None else available)
    fields = [(F.col(c) if c in have else F.lit(None).cast("string")).alias(c) for c in columns]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
