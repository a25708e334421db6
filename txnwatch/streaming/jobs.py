"""Streaming jobs with state in order of arrival, and sinks. Answers by event time: ``upkeep``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnwatch import schemas as S
from txnwatch.functions import texts
from txnwatch.operators import cases, rules
from txnwatch.session import session_settings
from txnwatch.sources import tables
from txnwatch.sources.ledger import PART, VERSION, Ledger
from txnwatch.streaming.state import TrailingCounter
from txnwatch.streaming.upkeep import each_batch

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# --- detection ----------------------------------------------------------------
def high_frequency(
    transactions: DataFrame,
    threshold: int = S.FREQUENCY_THRESHOLD,
    window_ms: int = S.FREQUENCY_WINDOW_MS,
    time_mode: str = "None",
    ttl_ms: int | None = None,
    order: Sequence[str] = ("event_ms", "transaction_id"),
    alert_ts: Column | None = None,
) -> DataFrame:
    """Alerts of the trailing-window rule in order of arrival, one state per user.

    Rows are folded one by one in the order of the ``order`` columns. Give the source's own
    (``partition`` and ``offset`` of a topic), and the borders of micro-batches don't matter: a
    user's rows arrive in the order of their offsets. The default orders a batch by time.

    ``time_mode="None"`` evaluates late rows against the state as it is. ``"EventTime"`` (needs
    a watermark) cleans up idle users with timers but drops rows behind the watermark;
    ``"ProcessingTime"`` with ``ttl_ms`` cleans up by idle time. A micro-batch bounds the rows
    one state call sees: cap it at the source. For users with a large part of the traffic, and
    for answers by event time, use ``upkeep.detect``.
    """
    columns = ["event_ts", "event_ms", *S.TRANSACTION_FIELDS.values()]
    # what the state doesn't look at goes through it as one text, with its times in microseconds
    stamps = [c for c in columns if isinstance(transactions.schema[c].dataType, T.TimestampType)]
    packed = transactions.select(columns).withColumns({c: F.unix_micros(c) for c in stamps}).schema
    row = F.to_json(F.struct(*[F.unix_micros(c).alias(c) if c in stamps else F.col(c) for c in columns]))
    watermarked = ["event_ts"] if time_mode == "EventTime" else []
    counted = transactions.filter("event_ms IS NOT NULL").select(
        "user_id", "event_ms", *watermarked, *[F.col(c).alias(f"order{i}") for i, c in enumerate(order)], row.alias("row")
    ).groupBy("user_id").transformWithStateInPandas(
        TrailingCounter(window_ms, threshold, ttl_ms, time_mode == "EventTime"),
        "row string, n bigint",
        "Append",
        time_mode,
    )
    counted = counted.select(F.from_json("row", packed, {"mode": "FAILFAST"}).alias("row"), "n").select("row.*", "n")
    counted = counted.withColumns({c: F.timestamp_micros(c) for c in stamps})
    reason = texts.high_frequency_reason(F.col("user_id"), F.col("n"), threshold, window_ms)
    return counted.select(
        *rules._alert_columns(
            F.lit(S.STATEFUL_RULE), F.lit(S.HIGH_FREQUENCY), reason, F.lit("HIGH"), alert_ts, keep=()
        )
    )


def kept_times(spark: SparkSession, checkpoint: str) -> DataFrame:
    """What ``high_frequency`` keeps, read back from its checkpoint: ``user_id, event_ms``."""
    # the reader needs the provider that wrote the state
    with session_settings(spark, {"spark.sql.streaming.stateStore.providerClass": _ROCKSDB}):
        state = spark.read.format("statestore").option("stateVarName", "times").load(checkpoint)
    return state.select(F.col("key.user_id").alias("user_id"), F.explode("value.ms").alias("event_ms"))


# --- sinks ----------------------------------------------------------------------
def to_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = True,
    interval: str = "60 seconds",
    idle_batches: bool = True,
):
    """Append the stream to a Parquet table, exactly once; state lives in RocksDB.

    ``idle_batches`` lets batches without data run, which is what closes the last
    windows. State with a processing-time expiry would run them without end, so
    a job that should finish switches them off.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    settings = {
        "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
        "spark.sql.streaming.noDataMicroBatches.enabled": str(idle_batches).lower(),
    }
    with session_settings(stream.sparkSession, settings):
        return writer.trigger(**trigger).start()


def to_history(stream: DataFrame, path: str, checkpoint: str, **trigger):
    """Append flat alert rows to the history; a replayed batch adds nothing."""

    def append(batch: DataFrame, _batch_id: int) -> None:
        tables.append_history(batch, path)

    return each_batch(stream, append, checkpoint, **trigger)


def to_recent(stream: DataFrame, path: str, checkpoint: str, arrival: str = "alert_timestamp", **trigger):
    """Keep the newest alerts (at most ``RECENT_ALERTS`` rows) as a table in two alternating slots.

    Batch n reads the slot of batch n-1 and overwrites its own, so a replayed
    batch gives the same table. Read it with ``read_recent``.
    """
    layout = stream.schema

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        merged = batch
        if batch_id > 0:
            merged = merged.unionByName(spark.read.schema(layout).parquet(f"{path}/slot={(batch_id - 1) % 2}"))
        newest = cases.recent(merged.dropDuplicates(["alert_id"]), arrival=arrival).withColumn("_batch", F.lit(batch_id))
        newest.coalesce(1).write.mode("overwrite").parquet(f"{path}/slot={batch_id % 2}")

    return each_batch(stream, merge, checkpoint, **trigger)


def to_live_list(alerts: DataFrame, changes: DataFrame, path: str, checkpoint: str, arrival: str = "alert_timestamp", **trigger):
    """The newest alerts with their status changes merged in, as ``to_recent`` keeps them.

    ``changes``: decoded status events (``alert_id, seq, status, change``). A batch's new alerts
    join the list before its changes apply; a change to an alert that isn't listed has no effect.
    Read it with ``read_recent``.
    """
    layout, given = alerts.schema, changes.select("alert_id", "seq", "status", "change")
    nothing = lambda schema: F.lit(None).cast(schema)
    both = alerts.select(F.struct(*alerts.columns).alias("alert"), nothing(given.schema).alias("change")).unionByName(
        given.select(nothing(layout).alias("alert"), F.struct(*given.columns).alias("change"))
    )

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        listed = batch.filter("alert IS NOT NULL").select("alert.*")
        if batch_id > 0:
            old = spark.read.schema(layout).parquet(f"{path}/slot={(batch_id - 1) % 2}")
            # an alert that comes again keeps its state
            listed = old.unionByName(listed.join(old.select("alert_id"), "alert_id", "left_anti").select(old.columns))
        # the list is written first: of the changes only those to its few rows are aggregated
        staged = f"{path}/_newest/slot={batch_id % 2}"
        cases.recent(listed.dropDuplicates(["alert_id"]), arrival=arrival).coalesce(1).write.mode("overwrite").parquet(staged)
        newest = spark.read.schema(layout).parquet(staged)
        named = F.broadcast(newest.select("alert_id"))
        changes = batch.filter("change IS NOT NULL").select("change.*").join(named, "alert_id", "left_semi")
        changed = cases.apply_status_events(newest, changes)
        changed.withColumn("_batch", F.lit(batch_id)).coalesce(1).write.mode("overwrite").parquet(f"{path}/slot={batch_id % 2}")

    return each_batch(both, merge, checkpoint, **trigger)


def read_recent(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest complete slot; ``schema`` is that of the stream."""
    layout = T.StructType([*schema.fields, T.StructField("_batch", T.IntegerType())])
    try:
        slots = spark.read.schema(layout).parquet(path).drop("slot")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # no batch has run yet
    last = slots.agg(F.max("_batch").alias("_last"))
    return slots.join(F.broadcast(last), F.col("_batch") == F.col("_last")).drop("_batch", "_last")


def dynamic_rules_to_table(stream: DataFrame, rules_path: str, path: str, checkpoint: str, **trigger):
    """Match each micro-batch against the rule table as it is when the batch first runs.

    The rules a batch uses are stored under its number before it matches anything, so a batch
    that is run again gives the same alerts, whatever became of the rules. With a short
    ``interval`` a changed rule acts on the next batch, without a restart. ``used_rules`` reads
    the stored versions.
    """
    from txnwatch.operators import dynamic_rules

    def match(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        book = Ledger(spark, f"{path}/_rules")
        if book.last() < batch_id:  # else this batch ran before
            version = book.begin(batch_id)
            now = tables.read_rules(spark, rules_path).withColumn("version", F.lit(batch_id).cast("long"))
            version.append("rules", now.withColumn(PART, F.lit(0).cast("long")))
            version.compact("rules", _USED_RULES)
            version.commit()
        used = used_rules(spark, path).filter(F.col("version") == batch_id).drop("version")
        alerts = dynamic_rules.dynamic_alerts(batch, used, alert_ts=F.col("event_ts"))
        alerts.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").partitionBy("batch").option(
            "partitionOverwriteMode", "dynamic"
        ).parquet(path)

    return each_batch(stream, match, checkpoint, **trigger)


_USED_RULES = T.StructType([*S.RULES.fields, T.StructField("version", T.LongType())])


def used_rules(spark: SparkSession, path: str) -> DataFrame:
    """The rules of every batch, with its number as ``version``."""
    return Ledger(spark, f"{path}/_rules").read("rules", _USED_RULES).drop(PART, VERSION)


# --- watermark ------------------------------------------------------------------
def split_by_watermark(stream: DataFrame, path: str, checkpoint: str, time: str = "event_ts", delay_ms: int = 5_000, **trigger):
    """Rows in time and rows behind the watermark, as two tables that together hold every row.

    The watermark of a batch is the greatest time of the batches before it less ``delay_ms``, as
    Spark's own; it is kept in the manifest's table, so a batch that is run again splits alike.
    A windowed count with that watermark over the rows in time (``kept``) drops none of them.
    Rows without a time are in time.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        book = Ledger(spark, path).begin(batch_id)
        so_far = book.read("reached", _REACHED).agg(F.max("ms")).first()[0]
        edge = None if so_far is None else so_far - delay_ms
        late = F.lit(False) if edge is None else F.coalesce(F.unix_millis(time) < edge, F.lit(False))
        rows = batch.withColumn(PART, F.lit(batch_id).cast("long"))
        book.append("kept", rows.filter(~late))
        book.append("late", rows.filter(late))
        here = batch.agg(F.max(F.unix_millis(time)).alias("ms")).filter("ms IS NOT NULL")
        book.append("reached", here.withColumn(PART, F.lit(0).cast("long")))
        book.compact("reached", _REACHED, lambda r: r.groupBy(PART).agg(F.max("ms").alias("ms")))
        book.commit()

    return each_batch(stream, split, checkpoint, **trigger)


_REACHED = T.StructType([T.StructField("ms", T.LongType())])


def split_rows(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """Every row with ``late``: whether it came behind the watermark."""
    book = Ledger(spark, path)
    kept = book.read("kept", schema).withColumn("late", F.lit(False))
    return kept.unionByName(book.read("late", schema).withColumn("late", F.lit(True))).drop(PART, VERSION)


# --- latency ---------------------------------------------------------------------
def join_latency(alerts: DataFrame, transactions: DataFrame, bound: str = "10 minutes", delay: str = "5 seconds") -> DataFrame:
    """Alerts with their transaction's time, both as streams; ``event_ts`` is null where none came within ``bound``.

    Matches leave at once. State is dropped, and an alert without a transaction is reported, when
    the watermark passes the bound. Give transactions unique ids.
    """
    left = alerts.withWatermark("alert_timestamp", delay)
    right = transactions.select(F.col("transaction_id").alias("_txn"), "event_ts").withWatermark("event_ts", delay)
    near = F.col("event_ts").between(
        F.col("alert_timestamp") - F.expr(f"INTERVAL {bound}"), F.col("alert_timestamp") + F.expr(f"INTERVAL {bound}")
    )
    return left.join(right, (F.col("transaction_id") == F.col("_txn")) & near, "left").drop("_txn")
