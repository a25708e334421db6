"""Record layouts and the fixed values every other module shares."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values ---------------------------------------------------------
SCHEMA_VERSION = "1.0"
CURRENCY = "KRW"
HOME_COUNTRY = "KR"
MIN_AMOUNT = 1_000
MAX_AMOUNT = 1_500_000
HIGH_VALUE_THRESHOLD = 1_000_000
FREQUENCY_THRESHOLD = 5
HISTORY_POINTS = 720
FREQUENCY_WINDOW_MS = 60_000
MULTI_COUNTRY_THRESHOLD = 3
MULTI_COUNTRY_WINDOW_MS = 600_000
WATERMARK_DELAY = "5 seconds"

HIGH_VALUE = "HIGH_VALUE"
FOREIGN_COUNTRY = "FOREIGN_COUNTRY"
HIGH_FREQUENCY = "HIGH_FREQUENCY"
MULTI_COUNTRY = "MULTI_COUNTRY"
RULE_NAMES = (HIGH_VALUE, FOREIGN_COUNTRY, HIGH_FREQUENCY)
RULE_ALIASES = {"HIGH_AMOUNT": HIGH_VALUE, "RAPID_TRANSACTION": HIGH_FREQUENCY}

SIMPLE_RULE = "SIMPLE_RULE"
STATEFUL_RULE = "STATEFUL_RULE"
RULE_TYPES = (SIMPLE_RULE, STATEFUL_RULE)

STATUSES = {"UNREAD": "미확인", "IN_PROGRESS": "확인중", "COMPLETED": "완료"}
SEVERITIES = {"LOW": "낮음", "MEDIUM": "보통", "HIGH": "높음", "CRITICAL": "긴급"}
SEVERITY_PRIORITY = {"LOW": 1, "MEDIUM": 2, "HIGH": 3, "CRITICAL": 4}
DETECTOR_SEVERITIES = ("HIGH", "MEDIUM", "LOW")

MAX_ASSIGNEE_CHARS = 100
MAX_NOTE_CHARS = 2_000
MAX_REASON_CHARS = 200
HISTORY_REASON_CHARS = (10, 1_000)
RECENT_ALERTS = 100
MAX_PAGE_SIZE = 100
DEFAULT_PAGE_SIZE = 50
DEFAULT_SEARCH_DAYS = 7
ARCHIVE_DAYS = 90

SERVICES = (
    "transaction-generator",
    "fraud-detector",
    "alert-service",
    "websocket-gateway",
    "frontend-dashboard",
)

TRANSACTIONS_TOPIC = "virtual-transactions"
ALERTS_TOPIC = "transaction-alerts"
STATUS_TOPIC = "alert-status-changed"
SOURCE_SERVICE = "fraud-detector"
STATUS_EVENT_TYPE = "ALERT_STATUS_CHANGED"

RULE_FIELDS = ("amount", "countryCode", "userId")
RULE_OPERATORS = (">", "<", "=", "!=", "IN")

# --- wire names -> column names -------------------------------------------
TRANSACTION_FIELDS = {
    "schemaVersion": "schema_version",
    "transactionId": "transaction_id",
    "userId": "user_id",
    "amount": "amount",
    "currency": "currency",
    "countryCode": "country_code",
    "timestamp": "timestamp",
}
ALERT_FIELDS = {
    "schemaVersion": "schema_version",
    "alertId": "alert_id",
    "originalTransaction": "original_transaction",
    "ruleType": "rule_type",
    "ruleName": "rule_name",
    "reason": "reason",
    "severity": "severity",
    "alertTimestamp": "alert_timestamp",
}


def _struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_text, _long, _time = T.StringType(), T.LongType(), T.TimestampType()

TRANSACTION_JSON = _struct({name: _long if name == "amount" else _text for name in TRANSACTION_FIELDS})
ALERT_JSON = _struct(
    {name: TRANSACTION_JSON if name == "originalTransaction" else _text for name in ALERT_FIELDS}
)

HISTORY = _struct(
    {
        "alert_id": _text,
        "schema_version": _text,
        "transaction_id": _text,
        "user_id": _text,
        "amount": _long,
        "currency": _text,
        "country_code": _text,
        "rule_name": _text,
        "reason": _text,
        "severity": _text,
        "alert_timestamp": _time,
        "status": _text,
        "assigned_to": _text,
        "action_note": _text,
        "processed_at": _time,
        "created_at": _time,
    }
)

COMMANDS = _struct(
    {
        "seq": _long,
        "ts": _time,
        "alert_id": _text,
        "cmd": _text,
        "status": _text,
        "assigned_to": _text,
        "action_note": _text,
        "complete": T.BooleanType(),
    }
)

RULES = _struct(
    {
        "rule_id": _text,
        "rule_name": _text,
        "description": _text,
        "rule_type": _text,
        "severity": _text,
        "is_active": T.BooleanType(),
        "condition_json": _text,
        "created_at": _time,
        "updated_at": _time,
    }
)

RULE_CONDITION_JSON = _struct({"type": _text, "field": _text, "operator": _text, "value": _text})
