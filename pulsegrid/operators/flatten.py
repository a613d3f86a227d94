"""Nested records as flat tables with prefixed column names."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.operators.contracts import APP_RECORD, DEVICE_RECORD, typed_leaf
from pulsegrid.operators.device_events import decode_payload


def flat_names(schema: T.StructType, skip: tuple[str, ...] = ()) -> list[tuple[str, str]]:
    """(path, column name) of every leaf.

    A context's prefix is the first word of its key; a field that already begins with the prefix
    keeps its name. Two leaves of one name are an error.
    """
    found: list[tuple[str, str]] = []

    def walk(struct: T.StructType, path: str, prefix: str | None) -> None:
        for field in struct.fields:
            here = f"{path}{field.name}"
            if here in skip:
                continue
            if isinstance(field.dataType, T.StructType):
                walk(field.dataType, f"{here}.", field.name.split("_")[0])
            elif prefix is None or field.name.startswith(prefix):
                found.append((here, field.name))
            else:
                found.append((here, f"{prefix}_{field.name}"))

    walk(schema, "", None)
    twice = [n for n, c in Counter(name for _, name in found).items() if c > 1]
    if twice:
        raise ValueError(f"columns named twice: {', '.join(twice)}")
    return found


def _select(records: DataFrame, schema: T.StructType, skip: tuple[str, ...],
            keep: tuple[str, ...]) -> DataFrame:
    columns: list[Column] = [F.col(c) for c in keep]
    columns += [typed_leaf(path).alias(name) for path, name in flat_names(schema, skip)]
    return records.select(*columns)


def flatten_app(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Valid app records as flat rows; fields of other payload types are null.

    ``keep`` names further columns to carry along, such as ``dt``.
    """
    return _select(records, APP_RECORD, (), keep)


def flatten_device(records: DataFrame, registry: DataFrame | None = None,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Valid device records as flat rows with ``schema_name`` and ``raw_payload``.

    With a ``registry`` the decoded message is added as JSON text in ``payload`` (null where it
    cannot be decoded).
    """
    flat = _select(records, DEVICE_RECORD, (), keep).withColumnRenamed(
        "sentinel_payload", "raw_payload")
    flat = flat.withColumn("schema_name", F.regexp_replace("sentinel_schema_id", "-[^-]*$", ""))
    if registry is None:
        return flat
    decoded = decode_payload(flat.withColumnRenamed("sentinel_schema_id", "schema_id"), registry)
    return (decoded.withColumnRenamed("schema_id", "sentinel_schema_id")
            .withColumnRenamed("payload_json", "payload").drop("decode_success"))
