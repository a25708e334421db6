"""Rules kept in a table: validation, matching, dry runs.

A rule's condition is JSON ``{"type", "field", "operator", "value"}`` on
``amount``, ``countryCode`` or ``userId`` with ``>``, ``<``, ``=``, ``!=`` or ``IN``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnwatch import schemas as S
from txnwatch.functions import texts
from txnwatch.operators import quality, rules as detection


def parse(rules: DataFrame) -> DataFrame:
    """Append the parsed condition and ``violations``."""
    condition = F.from_json("condition_json", S.RULE_CONDITION_JSON)
    value = F.col("condition.value")
    listed = F.from_json(value, "array<string>")
    parsed = rules.withColumn("condition", condition).withColumn(
        "operands", F.when(F.col("condition.operator") == "IN", listed).otherwise(F.array(value))
    )
    numeric = F.forall("operands", lambda v: F.coalesce(v.try_cast("bigint").isNotNull(), F.lit(False)))
    checks = {
        "BAD_JSON": F.coalesce(F.col("condition.field"), F.col("condition.operator"), value).isNotNull(),
        "BAD_FIELD": F.col("condition.field").isin(*S.RULE_FIELDS),
        # a condition of another type, or a stateful rule, cannot run as a comparison
        "BAD_TYPE": F.coalesce(F.col("condition.type") == "simple", F.col("condition.field").isNull())
        & (F.coalesce("rule_type", F.lit(S.SIMPLE_RULE)) == S.SIMPLE_RULE),
        "BAD_OPERATOR": F.col("condition.operator").isin(*S.RULE_OPERATORS),
        "BAD_VALUE": value.isNotNull()
        & (F.size("operands") > 0)
        & ((F.coalesce("condition.field", F.lit("")) != "amount") | numeric),
        "BAD_SEVERITY": F.col("severity").isin(*S.SEVERITIES),
        "MISSING_NAME": F.length("rule_name") > 0,
        # alert ids derive from the rule's name
        "DUPLICATE_NAME": F.col("_same_name") == 1,
    }
    parsed = parsed.withColumn("_same_name", F.count("*").over(Window.partitionBy("rule_name")))
    return quality.with_violations(parsed, checks).drop("_same_name")


def usable(rules: DataFrame) -> DataFrame:
    """Active rules without violations, narrowed to what matching needs."""
    return (
        parse(rules)
        .filter((F.size("violations") == 0) & F.coalesce("is_active", F.lit(True)))
        .select(
            "rule_id",
            "rule_name",
            F.coalesce("description", "rule_name").alias("description"),
            F.coalesce("rule_type", F.lit(S.SIMPLE_RULE)).alias("rule_type"),
            "severity",
            F.col("condition.field").alias("field"),
            F.col("condition.operator").alias("operator"),
            "operands",
            F.transform("operands", lambda v: v.try_cast("bigint")).alias("numbers"),
        )
    )


def _compare(actual: Column, operands: Column) -> Column:
    first, operator = operands[0], F.col("operator")
    return (
        F.when(operator == ">", actual > first)
        .when(operator == "<", actual < first)
        .when(operator == "=", actual == first)
        .when(operator == "!=", actual != first)
        .when(operator == "IN", F.array_contains(operands, actual))
    )


def matches() -> Column:
    """Whether a transaction row meets the rule row it is joined with."""
    texts_, field = F.col("operands"), F.col("field")
    return F.coalesce(
        F.when(field == "amount", _compare(F.col("amount"), F.col("numbers")))
        .when(field == "countryCode", _compare(F.col("country_code"), texts_))
        .when(field == "userId", _compare(F.col("user_id"), texts_)),
        F.lit(False),
    )


def _facts() -> Column:
    """What equality conditions can ask of a transaction, as (field, text)."""
    fields = {"amount": "amount", "countryCode": "country_code", "userId": "user_id"}
    return F.array(
        *[F.struct(F.lit(name).alias("_field"), F.col(column).cast("string").alias("_text")) for name, column in fields.items()]
    )


def join_rules(transactions: DataFrame, rules: DataFrame) -> DataFrame:
    """Transactions with each usable rule they meet.

    ``=`` and ``IN`` are equality joins on (field, value), whatever the number of rules and
    values; only ``>``, ``<`` and ``!=`` compare rows with rules. Which side is sent to the
    other is left to Spark, which knows their sizes.
    """
    equal = F.col("operator").isin("=", "IN")
    operands = F.when(F.col("field") == "amount", F.col("numbers").cast("array<string>")).otherwise(F.col("operands"))
    listed = rules.filter(equal).withColumn("_operand", F.explode(F.array_distinct(operands)))
    row = F.struct(*[F.col(name) for name in transactions.columns]).alias("_txn")
    asked = transactions.select(row, F.inline(_facts()))
    by_value = asked.join(listed, (F.col("_field") == F.col("field")) & (F.col("_text") == F.col("_operand")))
    by_order = transactions.join(rules.filter(~equal), matches())
    return by_order.unionByName(by_value.select("_txn.*", *rules.columns))


def _actual() -> Column:
    return (
        F.when(F.col("field") == "amount", texts.won(F.col("amount")))
        .when(F.col("field") == "countryCode", F.col("country_code"))
        .otherwise(F.col("user_id"))
    )


def dynamic_alerts(
    transactions: DataFrame,
    rules: DataFrame,
    alert_ts: Column | None = None,
) -> DataFrame:
    """An alert for every transaction and active rule that match."""
    matched = join_rules(transactions, usable(rules))
    reason = F.concat(F.col("description"), F.lit(": "), _actual())
    return matched.select(
        *detection._alert_columns(
            F.col("rule_type"), F.col("rule_name"), reason, F.col("severity"), alert_ts, keep=("rule_id",)
        )
    )


def dry_run(transactions: DataFrame, rule: DataFrame) -> DataFrame:
    """Every sample transaction with whether one rule (active or not) matches, and why."""
    if len(rule.limit(2).collect()) > 1:
        raise ValueError("a dry run takes one rule")
    one = usable(rule.withColumn("is_active", F.lit(True)))
    joined = transactions.join(F.broadcast(one), matches(), "left")  # one row
    hit = F.col("rule_id").isNotNull()
    # fixed texts
    return joined.select(
        "transaction_id",
        hit.alias("matched"),
        F.when(hit, F.concat(F.lit("매칭됨 - "), F.col("description"), F.lit(": "), _actual()))
        .otherwise("매칭 안됨")
        .alias("result"),
    )
