"""Device events: raw JSON -> flat columns -> decoded payload -> enriched rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions.times import timestamp_of_millis, local_timestamp
from pulsegrid.functions.values import VERSION_CORE
from pulsegrid.sources import scratch

RAW_SCHEMA = T.StructType([
    T.StructField("event_name", T.StringType()),
    T.StructField("event_timestamp_ms", T.LongType()),
    T.StructField("schema_id", T.StringType()),
    T.StructField("raw_payload", T.StringType()),
    T.StructField("client_ctx", T.StructType([
        T.StructField(c, T.StringType())
        for c in ("variant", "firmware_version", "locale", "platform")])),
    T.StructField("device_ctx", T.StructType([
        T.StructField("component_guid", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("mono_time", T.LongType()),
        T.StructField("schema_name", T.StringType())])),
    T.StructField("product_ctx", T.StructType([
        T.StructField(c, T.StringType()) for c in ("sku", "model_name", "hw_revision")])),
])

DECODED = T.StructType([
    T.StructField("payload_json", T.StringType()),
    T.StructField("decode_success", T.BooleanType()),
])


def parse_raw(lines: DataFrame, column: str = "value") -> DataFrame:
    """Raw JSON text in ``column`` as the nested record, with a fixed schema and no inference."""
    return lines.select(F.from_json(column, RAW_SCHEMA).alias("r")).select("r.*")


def flatten_raw(records: DataFrame) -> DataFrame:
    """Top-level and context fields as flat columns; a context may be a struct or JSON text."""
    contexts = ("client_ctx", "device_ctx", "product_ctx")
    texts = [c for c in contexts if isinstance(records.schema[c].dataType, T.StringType)]
    for c in texts:
        records = records.withColumn(c, F.from_json(c, "map<string,string>"))
    pick = lambda path: F.col(path)
    return records.select(
        "event_name",
        F.col("event_timestamp_ms").cast("long").alias("event_timestamp_ms"),
        "schema_id", "raw_payload",
        pick("client_ctx.variant").alias("client_variant"),
        pick("client_ctx.firmware_version").alias("client_firmware_version"),
        pick("client_ctx.locale").alias("client_locale"),
        pick("client_ctx.platform").alias("client_platform"),
        pick("device_ctx.component_guid").alias("device_component_guid"),
        pick("device_ctx.session_id").alias("device_session_id"),
        pick("device_ctx.mono_time").try_cast("long").alias("device_mono_time"),
        pick("device_ctx.schema_name").alias("device_schema_name_raw"),
        pick("product_ctx.sku").alias("product_sku"),
        pick("product_ctx.model_name").alias("product_model_name"),
        pick("product_ctx.hw_revision").alias("product_hw_revision"),
    )


def strict_base64(text: Column) -> Column:
    """Only the alphabet, padded to a multiple of four. No nested groups, so long texts are safe."""
    return text.rlike(r"^[A-Za-z0-9+/]*={0,2}\z") & (F.length(text) % 4 == 0)


def base64_bytes(text: Column) -> Column:
    """Decoded length of a strict base64 text, without decoding it."""
    padding = F.length(text) - F.length(F.rtrim(text, F.lit("=")))
    return F.length(text) / 4 * 3 - padding


def decode_payload(flat: DataFrame, registry: DataFrame) -> DataFrame:
    """Add ``payload_json`` and ``decode_success`` by the message type of ``schema_id``.

    ``registry`` holds schema_id, message_name and descriptor (a compiled file descriptor set); an id
    that it lists twice fails the job. It is joined to the rows, whatever its size; it is written
    first, so that Spark knows a small one as small and does not deal all rows by their few ids. Only
    the columns needed cross to Python, in Arrow batches. Message classes, the ids that have none, and
    the latest short texts with what they decode to are kept for the life of a task. Text that is not
    strict base64 fails rather than decoding to an empty message.
    """
    refuse = F.raise_error(F.lit("a schema id is listed twice")).cast("string")
    known = registry.groupBy("schema_id").agg(
        F.when(F.count(F.lit(1)) > 1, refuse).otherwise(F.first("message_name")).alias("_message"),
        F.first("descriptor").alias("_descriptor"))
    known = scratch.written(known, "registry")
    usable = F.when(strict_base64(F.col("raw_payload")) & (F.col("raw_payload") != "")
                    & (F.col("schema_id") != ""), F.col("raw_payload"))
    rows = flat.join(known, "schema_id", "left").withColumn("_decoded", _decoder()(
        F.col("schema_id"), usable, F.col("_message"), F.col("_descriptor")))
    return rows.select(*[F.col(c) for c in flat.columns], "_decoded.payload_json",
                       F.coalesce("_decoded.decode_success", F.lit(False)).alias("decode_success"))


def _decoder():
    """Arrow UDF; self-contained, so that executors need protobuf but not this package."""

    @F.pandas_udf(DECODED)
    def decode(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        import base64
        import json as _json
        from functools import lru_cache

        import pandas as _pd
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
        from google.protobuf.json_format import MessageToDict

        classes = {}

        def message_class(schema_id, name, descriptor):
            if schema_id not in classes:
                try:
                    files = descriptor_pb2.FileDescriptorSet()
                    files.ParseFromString(descriptor)
                    pool = descriptor_pool.DescriptorPool()
                    for file in files.file:
                        pool.Add(file)
                    classes[schema_id] = message_factory.GetMessageClass(
                        pool.FindMessageTypeByName(name))
                except Exception:
                    classes[schema_id] = None
            return classes[schema_id]

        def one(schema_id, text, name, descriptor):
            if schema_id is None or text is None or descriptor is None:
                return None, False
            if schema_id not in classes:
                message_class(schema_id, name, bytes(descriptor))
            return short(schema_id, text) if len(text) <= 1024 else decoded(schema_id, text)

        def decoded(schema_id, text):
            kind = classes[schema_id]
            if kind is None:
                return None, False
            try:
                message = kind()
                message.ParseFromString(base64.b64decode(text))
                fields = MessageToDict(message, preserving_proto_field_name=True,
                                       always_print_fields_with_no_presence=True)
                return _json.dumps(fields, ensure_ascii=False), True
            except Exception:
                return None, False

        short = lru_cache(8192)(decoded)
        for batch in batches:
            rows = [one(*r) for r in zip(*batch)]
            yield _pd.DataFrame(rows, columns=["payload_json", "decode_success"])

    return decode


def enrich(decoded: DataFrame) -> DataFrame:
    """Local time and date, version core, schema name and connection state."""
    local = local_timestamp(timestamp_of_millis(F.col("event_timestamp_ms")))
    return (
        decoded
        .withColumn("event_local_timestamp", local)
        .withColumn("event_local_date", F.to_date(local))
        .withColumn("client_version_core",
                    F.regexp_extract("client_firmware_version", VERSION_CORE, 1))
        .withColumn("device_schema_name", F.split("schema_id", "-").getItem(0))
        .withColumn("bt_device_state", F.get_json_object("payload_json", "$.bt_device_state"))
    )
