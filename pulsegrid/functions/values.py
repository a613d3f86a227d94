"""Fixed values. They must equal those of the records and tables in the field, so they are
stated as they are; nothing here is logic."""

from __future__ import annotations

# --- record envelopes -------------------------------------------------------------------
APP_EVENT_NAME = "nova-telemetry-record"
DEVICE_EVENT_NAME = "sentinel-telemetry-record"
ENVELOPE_VERSION = 2

# --- enumerations -----------------------------------------------------------------------
CLIENT_NAMES = ("nova-ios", "nova-android", "nova-ohos")
CLIENT_VARIANTS = ("dev", "staging", "prod")
CLIENT_PLATFORMS = {"nova-ios": "iOS", "nova-android": "Android", "nova-ohos": "HarmonyOS"}
DEVICE_OS_NAMES = ("Android", "iOS", "HarmonyOS")
IDENTITY_PROVIDERS = ("apple_id", "anonymous", "wechat", "google")
PAIRED_STATE = "connected"
PAIRING_RECORD = "device_pairing_record"
SESSION_RECORD = "device_session_record"
AUTH_RECORD = "user_auth_record"
PRODUCT_VARIANT_RANGE = (0, 19)
MAX_PAYLOAD_BYTES = 16_384
INVALID_TYPE = "INVALID_TYPE"
SCHEMA_VALIDATION_ERROR = "SCHEMA_VALIDATION_ERROR"

# --- text patterns ----------------------------------------------------------------------
SEMVER = (
    r"^(0|[1-9]\d*)\.(0|[1-9]\d*)\.(0|[1-9]\d*)"
    r"(?:-((?:0|[1-9]\d*|\d*[a-zA-Z-][0-9a-zA-Z-]*)"
    r"(?:\.(?:0|[1-9]\d*|\d*[a-zA-Z-][0-9a-zA-Z-]*))*))?"
    r"(?:\+([0-9a-zA-Z-]+(?:\.[0-9a-zA-Z-]+)*))?\z"
)
NUMERIC_VERSION = r"^\d+(\.\d+)*\z"
HEX_PRODUCT_ID = r"^0x[0-9A-Fa-f]{4}\z"
SHA256_HEX = r"^[0-9a-f]{64}\z"
SCHEMA_ID = r"^[a-z_]+-[0-9a-f]{7}\z"
UUID = r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}\z"
ZONED_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?([Zz]|[+-]\d{2}:?\d{2})\z"
VERSION_CORE = r"^(\d+\.\d+\.\d+)"

# --- time -------------------------------------------------------------------------------
LOCAL_ZONE = "Asia/Shanghai"
FIRST_PARTITION_DATE = "2023-01-01"
RETENTION_DAYS = (1, 2, 3, 7)
ACTIVE_MODEL_DAYS = 90
DAY_RATIO_BOUNDS = (0.5, 2.0)
EXPORT_KEEP_DAYS = 2
EXPORT_BATCH_ROWS = 20_000

# --- sentinels --------------------------------------------------------------------------
NO_VARIANT = "__none__"
UNKNOWN = "Unknown"
TEST_TRAFFIC_PATTERNS = ("%_test%", "%_internal%")

# --- payload columns of the flat landing table ------------------------------------------
APP_PAYLOAD_COLUMNS = (
    "nova_sdk_version", "nova_device_brand", "nova_device_model", "nova_oob_bt_connect",
    "nova_error_details", "nova_identity_provider", "nova_error_description",
    "nova_error_detail", "nova_user_id", "nova_user_metadata", "nova_screen_name",
    "nova_screen_rank", "nova_subtask_grouping", "nova_subtask_rank",
    "nova_onboarding_duration", "nova_client_timestamp_enter", "nova_client_timestamp_exit",
)

# --- event registry: name -> (carries product context, payload columns) -----------------
EVENT_REGISTRY = {
    "nova_session_start": (False, ("nova_sdk_version", "nova_device_os", "nova_device_os_version",
                                   "nova_device_brand", "nova_device_model")),
    "nova_bt_connect_attempt": (True, ()),
    "nova_bt_connect_result": (True, ("nova_oob_bt_connect",)),
    "nova_bt_incomplete_result": (True, ("nova_oob_bt_connect",)),
    "nova_bt_error_result": (True, ("nova_oob_bt_connect", "nova_error_details")),
    "nova_login_attempt": (False, ("nova_identity_provider",)),
    "nova_login_incomplete": (False, ("nova_identity_provider", "nova_error_description")),
    "nova_login_failure": (False, ("nova_identity_provider", "nova_error_description",
                                   "nova_error_detail")),
    "nova_login_successful": (False, ("nova_identity_provider", "nova_user_id")),
    "nova_onboarding_first_flow": (False, ("nova_screen_name", "nova_screen_rank",
                                           "nova_subtask_grouping", "nova_subtask_rank",
                                           "nova_onboarding_duration")),
    "nova_onboarding_last_flow": (True, ("nova_screen_name", "nova_screen_rank",
                                         "nova_subtask_grouping", "nova_subtask_rank",
                                         "nova_onboarding_duration")),
}
LEGACY_TABLE = "nova_v4_event_log"
CURRENT_RECORD_VERSION = 5
LEGACY_RECORD_VERSION = 4

# --- device subjects: event name -> table -----------------------------------------------
SUBJECT_TABLES = {
    "reboot_info": "dwd_device_events_reboot_info",
    "shutdown_reason": "dwd_device_events_shutdown_reason",
    "ota_status": "dwd_device_events_ota_status",
    "bt_connection": "dwd_device_events_bt_connection",
}

# --- product catalogue, first generation:
#     id, guid, name, category, line, launch date, active --------------------------------
PRODUCTS_V1 = (
    ("a1b2c3d4", "f47ac10b-58cc-4372-a567-0e02b2c3d479", "PRODUCT_A", "wireless_headphones",
     "nova_audio", "2021-03-15", True),
    ("e5f6a7b8", "550e8400-e29b-41d4-a716-446655440001", "PRODUCT_B", "earbuds",
     "nova_audio", "2022-06-01", True),
    ("c9d0e1f2", "6ba7b810-9dad-11d1-80b4-00c04fd430c9", "PRODUCT_C", "wireless_headphones",
     "nova_audio_pro", "2023-01-10", True),
    ("33445566", "6ba7b811-9dad-11d1-80b4-00c04fd430ca", "PRODUCT_D", "over_ear_headphones",
     "nova_audio", "2020-09-22", False),
    ("77889900", "6ba7b812-9dad-11d1-80b4-00c04fd430cb", "PRODUCT_E", "soundbar",
     "nova_home", "2023-09-05", True),
)

# --- product catalogue, second generation:
#     id, code, name, category, launch date, active, guid --------------------------------
PRODUCTS_V2 = (
    (1, "PRODUCT_A", "Nova Alpha", "wireless_headphones", "2021-03-15", True,
     "f47ac10b-58cc-4372-a567-0e02b2c3d479"),
    (2, "PRODUCT_B", "Nova Beta", "earbuds", "2022-06-01", True,
     "550e8400-e29b-41d4-a716-446655440001"),
    (3, "PRODUCT_C", "Nova Compact", "wireless_headphones", "2023-01-10", True,
     "6ba7b810-9dad-11d1-80b4-00c04fd430c9"),
    (4, "PRODUCT_D", "Nova Pro", "over_ear_headphones", "2020-09-22", False,
     "6ba7b811-9dad-11d1-80b4-00c04fd430ca"),
    (5, "PRODUCT_E", "Nova Legacy", "soundbar", "2023-09-05", True,
     "6ba7b812-9dad-11d1-80b4-00c04fd430cb"),
)

# --- device models: name prefix -> (manufacturer, platform) -----------------------------
MODEL_PREFIXES = {
    "iphone": ("Apple", "iOS"),
    "ipad": ("Apple", "iOS"),
    "samsung": ("Samsung", "Android"),
    "pixel": ("Google", "Android"),
    "oneplus": ("OnePlus", "Android"),
}
OTHER_MODEL = ("Other", "Android")
