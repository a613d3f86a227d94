"""Record contracts: which raw JSON records are valid, and why the others are not.

JSON types are strict: a number in a text field, digits in quotes for an integer or a UUID in a
spelling other than the hyphenated one make a record invalid. Unknown fields are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions import rules as R
from pulsegrid.functions import values as V
from pulsegrid.functions.rules import Rule
from pulsegrid.operators.device_events import base64_bytes, strict_base64

_TEXT, _INT, _LONG, _BOOL, _ANY = (
    T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.VariantType())


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


PRODUCT_CTX = _struct(name=_ANY, product_id=_TEXT, variant=_ANY, guid=_TEXT, firmware_version=_TEXT)
CLIENT_CTX = _struct(name=_TEXT, variant=_TEXT, version=_TEXT, build=_ANY, client_id=_TEXT,
                     mono_time=_LONG, is_background=_BOOL, session_id=_INT,
                     time_since_last_event=_ANY)
PAYLOAD_CTX = _struct(event_name=_TEXT, sdk_version=_TEXT, device_os=_TEXT, device_os_version=_ANY,
                      device_brand=_ANY, device_model=_ANY, oob_bt_connect=_TEXT,
                      product_ctx=PRODUCT_CTX, identity_provider=_TEXT, user_id=_TEXT,
                      user_metadata=_ANY)
DEVICE_CTX = _struct(schema_id=_TEXT, mono_time=_LONG, session_id=_INT, firmware_platform_id=_ANY,
                     is_signed=_BOOL, is_encrypted=_BOOL, component_guid=_TEXT,
                     product_ctx=PRODUCT_CTX, payload=_TEXT)


def _envelope(**contexts) -> T.StructType:
    return _struct(event_name=_TEXT, event_schema_version=_INT, event_guid=_TEXT,
                   event_timestamp=_TEXT, **contexts)


APP_RECORD = _envelope(client_ctx=CLIENT_CTX, nova_ctx=PAYLOAD_CTX)
DEVICE_RECORD = _envelope(client_ctx=CLIENT_CTX, sentinel_ctx=DEVICE_CTX)


# --- rule lists -------------------------------------------------------------------------
def envelope_rules(event_name: str) -> list[Rule]:
    return [R.equals("event_name", event_name),
            R.equals("event_schema_version", V.ENVELOPE_VERSION),
            R.uuid("event_guid"), R.zoned_time("event_timestamp")]


def _context(path: str, rules: list[Rule]) -> list[Rule]:
    """A missing context is one complaint; its fields are looked at only if it is there."""
    return [R.given(path)] + [r.only_if(F.col(path).isNotNull()) for r in rules]


def client_rules(path: str = "client_ctx") -> list[Rule]:
    at = lambda f: f"{path}.{f}"
    return _context(path, [
        R.one_of(at("name"), V.CLIENT_NAMES), R.one_of(at("variant"), V.CLIENT_VARIANTS),
        R.semver(at("version")), R.text_given(at("build")), R.uuid(at("client_id")),
        R.given(at("mono_time")), R.given(at("is_background")), R.positive(at("session_id")),
        R.optional(at("time_since_last_event"), "BIGINT", "an integer"),
    ])


def product_rules(path: str, level: str = "extended") -> list[Rule]:
    """``base``: all optional; ``basic``: name, id and variant needed; ``extended``: all needed."""
    at = lambda f: f"{path}.{f}"
    number = R.variant_long(at("variant"))
    in_range = (R._json_type(F.col(at("variant"))) == "BIGINT") & number.between(*V.PRODUCT_VARIANT_RANGE)
    identity = [R.text_given(at("name")),
                R.matches(at("product_id"), V.HEX_PRODUCT_ID, "0x and four hex digits"),
                Rule(at("variant"), in_range, "must be an integer 0 to 19")]
    firmware = [R.uuid(at("guid")), R.semver(at("firmware_version"))]
    loose = {"base": identity + firmware, "basic": firmware, "extended": []}[level]
    needed = [r for r in identity + firmware if r not in loose]
    void = lambda r: F.col(r.path).isNotNull() & (
        (R._json_type(F.col(r.path)) != "VOID")
        if r.path in (at("name"), at("variant")) else F.lit(True))
    return _context(path, needed + [r.only_if(void(r)) for r in loose])


def payload_rules(path: str = "nova_ctx") -> list[Rule]:
    """Rules of the payload type that ``event_name`` names; an unnamed type is invalid."""
    at = lambda f: f"{path}.{f}"
    by_type = {
        V.SESSION_RECORD: [
            R.semver(at("sdk_version")), R.one_of(at("device_os"), V.DEVICE_OS_NAMES),
            R.text_matches(at("device_os_version"), V.NUMERIC_VERSION, "digits and dots"),
            R.text_given(at("device_brand")), R.text_given(at("device_model"))],
        V.PAIRING_RECORD: [
            R.equals(at("oob_bt_connect"), V.PAIRED_STATE), *product_rules(at("product_ctx"))],
        V.AUTH_RECORD: [
            R.one_of(at("identity_provider"), V.IDENTITY_PROVIDERS),
            R.matches(at("user_id"), V.SHA256_HEX, "a lowercase hex SHA-256 digest"),
            R.optional(at("user_metadata"), "OBJECT", "an object")],
    }
    kind = F.col(at("event_name"))
    rules = [R.one_of(at("event_name"), tuple(by_type))]
    for name, listed in by_type.items():
        rules += [r.only_if(kind == name) for r in listed]
    return _context(path, rules)


def device_ctx_rules(path: str = "sentinel_ctx") -> list[Rule]:
    at = lambda f: f"{path}.{f}"
    payload = F.col(at("payload"))
    size = base64_bytes(payload)
    return _context(path, [
        R.matches(at("schema_id"), V.SCHEMA_ID, "a lower-case name, a dash and seven hex digits"),
        R.given(at("mono_time")), R.positive(at("session_id")),
        R.text_given(at("firmware_platform_id")), R.given(at("is_signed")),
        R.given(at("is_encrypted")),
        R.uuid(at("component_guid")).only_if(F.col(at("component_guid")).isNotNull()),
        *product_rules(at("product_ctx")),
        Rule(at("payload"), strict_base64(payload) & size.between(1, V.MAX_PAYLOAD_BYTES),
             f"must be base64 of 1 to {V.MAX_PAYLOAD_BYTES} bytes"),
    ])


# --- jobs -------------------------------------------------------------------------------
@dataclass(frozen=True)
class Contract:
    stream: str
    schema: T.StructType

    def rules(self) -> list[Rule]:
        if self.stream == "app":
            return envelope_rules(V.APP_EVENT_NAME) + client_rules() + payload_rules()
        return envelope_rules(V.DEVICE_EVENT_NAME) + client_rules() + device_ctx_rules()


APP = Contract("app", APP_RECORD)
DEVICE = Contract("device", DEVICE_RECORD)


def validate_records(lines: DataFrame, contract: Contract, raw: str = "value") -> DataFrame:
    """Parse JSON text and judge every record.

    The record's fields are added as columns together with ``errors`` (complaints, empty if
    valid), ``error_code`` (null if valid) and ``error_message``. Text that is not a JSON object
    has the code for a wrong type.
    """
    text = F.col(raw)
    record = F.from_json(text, contract.schema)
    parsed = _computed_once(lines, record)
    # text that fails to parse leaves every field null; only such rows are parsed once more
    nothing = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in contract.schema.names])
    broken = nothing & F.expr(f"try_parse_json(`{raw}`)").isNull()
    shaped = F.coalesce(text.rlike(r"(?s)^\s*\{.*\}\s*\z"), F.lit(False))
    wrong = F.when(~shaped | broken, V.INVALID_TYPE)
    judged = _computed_once(parsed, F.struct(
        R.complaints_of(contract.rules()).alias("_complaints"), wrong.alias("_wrong")))
    code = F.coalesce("_wrong", F.when(F.col("_complaints") != "", V.SCHEMA_VALIDATION_ERROR))
    message = F.when(F.col("error_code") == V.INVALID_TYPE, "not a JSON object").when(
        F.col("error_code").isNotNull(), F.to_json("errors"))
    errors = R.complaint_list(F.col("_complaints"))
    return (judged.select(*parsed.columns, errors.alias("errors"), code.alias("error_code"))
            .withColumn("error_message", message))


def _computed_once(rows: DataFrame, record: Column) -> DataFrame:
    """Add the fields of ``record`` as columns that later filters do not evaluate again.

    A filter on a projected column is pushed down with the column's whole expression written out
    at every use, which would parse a record once for every rule and, above a verdict, has the
    optimizer infer further filters from all its branches. It cannot be pushed below a generator,
    and a generator of one row costs next to nothing.
    """
    once = rows.select(*rows.columns, F.explode(F.array(record)).alias("_record"))
    return once.select(*rows.columns, "_record.*")


def valid_records(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("error_code").isNull()).drop("errors", "error_code", "error_message")


def failures(judged: DataFrame, raw: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Quarantine rows: what identifies the record, code, message and the raw text."""
    return judged.where(F.col("error_code").isNotNull()).select(
        *keep, "error_code", "error_message", F.col(raw).alias("raw"))


def batch_counts(judged: DataFrame) -> DataFrame:
    """Records received, valid and invalid, and how many of each failure code."""
    bad = F.col("error_code").isNotNull()
    return judged.agg(
        F.count(F.lit(1)).alias("received"), F.count_if(~bad).alias("valid"),
        F.count_if(bad).alias("invalid"),
        F.count_if(F.col("error_code") == V.INVALID_TYPE).alias("invalid_type"),
        F.count_if(F.col("error_code") == V.SCHEMA_VALIDATION_ERROR).alias("invalid_schema"),
    )


# --- flat contracts ---------------------------------------------------------------------
def flat_rules(kind: str) -> list[Rule]:
    """Rules of the flat session, pairing or auth table."""
    common = [
        R.equals("event_name", V.APP_EVENT_NAME),
        R.equals("event_schema_version", V.ENVELOPE_VERSION),
        R.uuid("event_guid"), R.given("event_timestamp"),
        R.one_of("client_name", V.CLIENT_NAMES), R.one_of("client_variant", V.CLIENT_VARIANTS),
        R.given("client_version"), R.given("client_build"), R.uuid("client_id"),
        R.given("client_mono_time"), R.given("client_is_background"),
        R.positive("client_session_id"), R.given("dt"),
    ]
    own = {
        "session": [
            R.equals("nova_event_name", V.SESSION_RECORD), R.given("nova_sdk_version"),
            R.one_of("nova_device_os", V.DEVICE_OS_NAMES), R.given("nova_device_os_version"),
            R.given("nova_device_brand"), R.given("nova_device_model")],
        "pairing": [
            R.equals("nova_event_name", V.PAIRING_RECORD),
            R.equals("nova_oob_bt_connect", V.PAIRED_STATE), R.given("product_name"),
            R.given("product_id"), R.within("product_variant", *V.PRODUCT_VARIANT_RANGE),
            R.uuid("product_guid"), R.given("product_firmware_version")],
        "auth": [
            R.equals("nova_event_name", V.AUTH_RECORD),
            R.one_of("nova_identity_provider", V.IDENTITY_PROVIDERS), R.given("nova_user_id")],
    }
    return common + own[kind]


def check_flat_contract(flat: DataFrame, kind: str) -> DataFrame:
    """Add ``errors`` to a flat table; a column the table lacks is missing in every row."""
    have = set(flat.columns)
    rules = [r if r.path in have else Rule(r.path, F.lit(False), r.problem) for r in flat_rules(kind)]
    return flat.withColumn("errors", R.errors_of(rules))


def typed_leaf(path: str) -> Column:
    """A record field in the type of the flat table."""
    field = path.rsplit(".", 1)[-1]
    if field == "event_timestamp":
        return R.zoned_timestamp(F.col(path))
    if field in ("time_since_last_event",):
        return R.variant_long(path)
    if path.endswith("product_ctx.variant"):
        return R.variant_long(path).cast("int")
    if field == "user_metadata":
        return R.variant_json(path)
    if field in ("build", "device_os_version", "device_brand", "device_model",
                 "firmware_platform_id") or path.endswith("product_ctx.name"):
        return R.variant_text(path)
    return F.col(path)
