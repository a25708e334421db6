"""Records on the wire: JSON decode with quarantine, and the encoders for the sinks.

Frames follow the Kafka source and sink layout (``key``, ``value``,
``headers``), so the same frame goes to Kafka or to files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnwatch import schemas as S
from txnwatch.functions import times
from txnwatch.operators import quality

_CORRUPT = "_corrupt_record"


def _parse(text: Column, layout: T.StructType, mode: str) -> Column:
    options = {"mode": mode.upper()}
    if mode == "permissive":
        layout = T.StructType([*layout.fields, T.StructField(_CORRUPT, T.StringType())])
        options["columnNameOfCorruptRecord"] = _CORRUPT
    return F.from_json(text, layout, options)


def _problem(text: Column, parsed: str, fields, mode: str, reject_unknown: bool) -> Column:
    missing = F.concat_ws(",", *[F.when(F.col(f"{parsed}.{name}").isNull(), F.lit(name)) for name in fields])
    known = F.array(*[F.lit(name) for name in fields])
    extra = F.array_except(F.json_object_keys(text), known)
    problem = F.when(text.isNull(), F.lit("NULL_PAYLOAD")).when(F.length(text) == 0, F.lit("EMPTY_PAYLOAD"))
    if mode == "permissive":
        problem = problem.when(F.col(f"{parsed}.{_CORRUPT}").isNotNull(), F.lit("BAD_JSON"))
    problem = problem.when(F.col(parsed).isNull(), F.lit("BAD_JSON"))
    problem = problem.when(missing != "", F.concat(F.lit("MISSING_FIELD: "), missing))
    if reject_unknown:
        problem = problem.when(
            F.size(extra) > 0, F.concat(F.lit("UNKNOWN_FIELD: "), F.array_join(F.sort_array(extra), ","))
        )
    return problem


def decode(
    records: DataFrame, layout: T.StructType, mode: str = "permissive", reject_unknown: bool = True
) -> DataFrame:
    """Append ``record`` (the parsed struct) and ``problem`` (NULL when usable).

    ``mode="failfast"`` makes the job fail on unreadable JSON instead.
    """
    if mode not in ("permissive", "failfast"):
        raise ValueError("mode is 'permissive' or 'failfast'")
    text = F.col("value").cast("string")
    return _once(records, "record", _parse(text, layout, mode)).withColumn(
        "problem", _problem(text, "record", layout.fieldNames(), mode, reject_unknown)
    )


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Append a costly column so that it is computed once per row.

    As a plain projection the optimizer would copy the parse into every filter
    and field that uses it; it does not move expressions through a generator.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _passed_on(records: DataFrame) -> list[str]:
    return [name for name in records.columns if name not in ("key", "value", "headers")]


def decoded_transactions(
    records: DataFrame, ingest_ts: str = "ingest_ts", mode: str = "permissive", reject_unknown: bool = True
) -> DataFrame:
    """Every record with its transaction columns and ``problem``, in one pass.

    ``time_ok``, ``schema_ok`` and ``is_valid`` describe usable records. An
    unreadable time falls back to ``ingest_ts``: unlike the wall clock it is the
    same in a replay.
    """
    decoded = decode(records, S.TRANSACTION_JSON, mode, reject_unknown)
    usable = F.col("problem").isNull()
    fields = [F.when(usable, F.col(f"record.{wire}")).alias(name) for wire, name in S.TRANSACTION_FIELDS.items()]
    own = times.parse_instant(F.col("timestamp"))
    event_ts = F.when(usable, F.coalesce("_own", F.col(ingest_ts)))
    return (
        decoded.select(*_passed_on(records), "value", "problem", *fields)
        .withColumn("_own", own)
        .select(
            *_passed_on(records), "value", "problem", *S.TRANSACTION_FIELDS.values(),
            event_ts.alias("event_ts"),
            F.unix_millis(event_ts).alias("event_ms"),
            F.when(usable, F.col("_own").isNotNull()).alias("time_ok"),
            F.when(usable, quality.schema_ok()).alias("schema_ok"),
            F.when(usable, quality.transaction_valid()).alias("is_valid"),
        )
    )


def decode_transactions(
    records: DataFrame,
    ingest_ts: str = "ingest_ts",
    mode: str = "permissive",
    drop_invalid: bool = False,
    reject_unknown: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(transactions, quarantine) from records with a binary or text ``value``.

    Invalid transactions are kept and flagged unless ``drop_invalid``.
    """
    decoded = decoded_transactions(records, ingest_ts, mode, reject_unknown)
    good = decoded.filter(F.col("problem").isNull()).drop("value", "problem")
    if drop_invalid:
        good = good.filter("is_valid")
    return good, quarantine(decoded, _passed_on(records))


def quarantine(decoded: DataFrame, kept) -> DataFrame:
    return decoded.filter(F.col("problem").isNotNull()).select(
        *kept, "problem", F.col("value").cast("string").alias("value")
    )


def decode_alerts(records: DataFrame, mode: str = "permissive") -> tuple[DataFrame, DataFrame]:
    """(alerts, quarantine); bad records are skipped by the reader, never lost."""
    decoded = decode(records, S.ALERT_JSON, mode, reject_unknown=False)
    kept = _passed_on(records)
    fields = []
    for wire, name in S.ALERT_FIELDS.items():
        if wire == "originalTransaction":
            inner = [F.col(f"record.{wire}.{w}").alias(n) for w, n in S.TRANSACTION_FIELDS.items()]
            fields.append(F.struct(*inner).alias(name))
        else:
            fields.append(F.col(f"record.{wire}").alias(name))
    return decoded.filter(F.col("problem").isNull()).select(*kept, *fields), quarantine(decoded, kept)


def decode_status_events(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, rejected). ``change`` keeps which keys were present; the type tag is added."""
    kept = _passed_on(records)
    parsed = _once(records, "change", F.from_json(F.col("value").cast("string"), "map<string,string>"))
    has_keys = F.coalesce(
        F.map_contains_key("change", "alertId") & F.map_contains_key("change", "status"), F.lit(False)
    )
    events = parsed.filter(has_keys).select(
        *kept,
        F.lit(S.STATUS_EVENT_TYPE).alias("type"),
        F.col("change")["alertId"].alias("alert_id"),
        F.col("change")["status"].alias("status"),
        "change",
    )
    return events, parsed.filter(~has_keys).select(*kept, F.col("value").cast("string").alias("value"))


def _wire(fields: dict[str, str], row: str = "") -> list[Column]:
    return [F.col(f"{row}{name}").alias(wire) for wire, name in fields.items()]


def encode_transactions(transactions: DataFrame) -> DataFrame:
    value = F.to_json(F.struct(*_wire(S.TRANSACTION_FIELDS)), {"ignoreNullFields": "false"})
    return transactions.select(F.col("user_id").alias("key"), value.alias("value"))


def _header(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("key"), F.encode(value, "UTF-8").alias("value"))


def encode_alerts(alerts: DataFrame) -> DataFrame:
    """Key by user so that one user's alerts stay in order on the topic."""
    inner = F.struct(*_wire(S.TRANSACTION_FIELDS, "original_transaction."))
    body = F.struct(
        *[
            inner.alias(wire) if wire == "originalTransaction" else F.col(name).alias(wire)
            for wire, name in S.ALERT_FIELDS.items()
        ]
    )
    return alerts.select(
        F.col("original_transaction.user_id").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
        F.array(
            _header("schema-version", F.lit(S.SCHEMA_VERSION)),
            _header("source-service", F.lit(S.SOURCE_SERVICE)),
            _header("rule-name", F.col("rule_name")),
        ).alias("headers"),
    )


def encode_status_events(events: DataFrame, keep=()) -> DataFrame:
    """``alertId`` and ``status`` always; the other fields only when they hold a value."""
    body = F.struct(
        F.col("alert_id").alias("alertId"),
        F.col("status"),
        times.iso_instant(F.col("processed_at")).alias("processedAt"),
        F.col("assigned_to").alias("assignedTo"),
        F.col("action_note").alias("actionNote"),
    )
    return events.select(
        F.col("alert_id").alias("key"), F.to_json(body, {"ignoreNullFields": "true"}).alias("value"), *keep
    )
