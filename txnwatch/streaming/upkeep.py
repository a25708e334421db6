"""Stream results that don't depend on how rows fall into micro-batches.

No watermark decides about a row, so none is dropped, however late it comes. Rows are stored
in parts (a time slab, a date, a bucket of keys). A micro-batch adds its rows, then the parts it
touched are computed again from what is stored and replaced; the result after any split of the
input into batches is that of the batch operator over all of it. Counts need no rows: partial
counts are added on reading. Cases carry each alert's state, so a batch looks up the alerts it
names and computes nothing else again.

What is stored is kept in a ``ledger``: a batch reads the folders it needs by name and counts
from the moment its manifest is written, so a batch that is run again changes nothing, and a
reader sees whole batches only. Folders are merged as batches come, and parts can expire.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnwatch import schemas as S
from txnwatch.functions.times import floor_to
from txnwatch.operators import cases, rules, trailing
from txnwatch.session import session_settings
from txnwatch.sources.ledger import PART, VERSION, Batch, Ledger, bucket, unseen

INTERVAL = "60 seconds"
NO_PART = -(1 << 62)
"""The part of rows without a time (or key)."""
KEY, AT = "_key", "_at"
"""In tables whose rows replace one another: what names a row, and the batch that wrote it."""


TASK_ROWS = 100_000
"""Rows of a task of a shuffle, about; results don't depend on it."""


def _tasks(spark: SparkSession, rows: int) -> int:
    """Shuffle partitions for so many rows, the session's number at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


def _dealt(spark: SparkSession, rows: int):
    """A micro-batch has no adaptive execution: its partitions follow its rows, so a task's memory doesn't."""
    return session_settings(spark, {"spark.sql.shuffle.partitions": str(_tasks(spark, rows))})


def each_batch(stream: DataFrame, handle, checkpoint: str, available_now: bool = True, interval: str = INTERVAL):
    """Runs ``handle(batch, batch_id)``: once over what is there, or without end."""
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**trigger).start()


# --- parts that are computed again ----------------------------------------------------
def keep_up(
    stream: DataFrame,
    part: Column,
    evaluate: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    width: int = 1,
    reach: int = 0,
    retain: int | None = None,
    **trigger,
):
    """Keeps ``evaluate`` of all rows so far as a table below ``path``; read it with ``current``.

    ``part`` is a long; rows without one are a part of their own. ``evaluate`` gets stored rows
    with ``_part`` and returns rows with the ``_part`` they belong to. The result of a part may
    need the rows of up to ``reach`` parts before it, ``width`` apart.

    ``retain``: results more than this below the newest part expire, and with them the rows that
    no later result can need. Rows that come later than that are kept, but not evaluated: see
    ``set_aside``.
    """
    layout = stream.schema

    def refresh(batch: DataFrame, batch_id: int) -> None:
        book = Ledger(batch.sparkSession, path).begin(batch_id)
        placed = F.coalesce(part.cast("long"), F.lit(NO_PART))
        parts = book.append("rows", batch.withColumn(PART, placed))
        if retain is not None:
            newest = max((p.part for p in book.of("rows")), default=NO_PART)
            edge, needs = newest - retain, newest - retain - reach * width
            behind = [p for p in parts if NO_PART < p < needs]
            if behind:
                late = book.read("rows", layout, behind).filter(F.col(VERSION).startswith(f"{batch_id:012d}-"))
                book.append("set_aside", late.drop(VERSION))
            parts = [p for p in parts if p == NO_PART or p >= needs]
        touched = sorted({p + i * width for p in parts for i in range(reach + 1 if p > NO_PART else 1)})
        needed = {p - i * width for p in touched for i in range(reach + 1 if p > NO_PART else 1)}
        wanted = batch.sparkSession.createDataFrame([(p,) for p in touched], f"{PART} long")
        result = evaluate(book.read("rows", layout, needed).drop(VERSION))
        result = result.withColumn(PART, F.coalesce(PART, F.lit(NO_PART))).join(wanted, PART, "left_semi")
        book.replace("result", result, touched)
        if retain is not None:
            book.expire("rows", needs, keep=NO_PART)
            book.expire("result", edge, keep=NO_PART)
        book.compact("rows", layout)
        book.commit()

    return each_batch(stream, refresh, checkpoint, **trigger)


def current(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """The table that a job maintains; ``schema`` without the part."""
    book = Ledger(spark, path)
    whole = book.read("result", schema).drop(PART, VERSION)
    replaced = book.read("replaced", _keyed(schema)).repartition(_tasks(spark, book.rows("replaced")), KEY)
    return whole.unionByName(latest(replaced).drop(PART, VERSION))


def set_aside(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """Rows that came after the results they belong to had expired."""
    return Ledger(spark, path).read("set_aside", schema).drop(PART, VERSION)


def _keyed(schema: T.StructType) -> T.StructType:
    fields = [f for f in schema.fields if f.name not in (KEY, AT)]
    return T.StructType([*fields, T.StructField(KEY, T.StringType()), T.StructField(AT, T.LongType())])


def latest(rows: DataFrame, keep: bool = False) -> DataFrame:
    """Of rows with one key those of the last batch; aggregates before its shuffle."""
    others = [c for c in rows.columns if c != KEY]
    newest = rows.groupBy(KEY).agg(F.max_by(F.struct(*others), AT).alias("_row")).select(KEY, "_row.*")
    return newest if keep else newest.drop(KEY, AT)


def detect(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    stateless=rules.STATELESS_RULES,
    windows=(rules.high_frequency(),),
    window_ms: int = S.FREQUENCY_WINDOW_MS,
    slab_ms: int | None = None,
    alert_ts: Column | None = None,
    **trigger,
):
    """All rules on one stream, by event time, one table of alerts.

    ``windows``: any trailing-window rules that look back at most ``window_ms``. Parts are time
    slabs, at least a window wide. Late rows complete the windows they belong to: alerts appear,
    or their counts are corrected, as in the batch detection over all rows. Rows without a time
    meet the stateless rules only. ``retain`` is in milliseconds.
    """
    width = trailing.slab_width(window_ms, slab_ms)
    evaluate = detection(width, stateless, windows, alert_ts)
    return keep_up(stream, floor_to(F.col("event_ms"), width), evaluate, path, checkpoint, width, 1, **trigger)


def detection(width: int, stateless, windows, alert_ts: Column | None = None) -> Callable[[DataFrame], DataFrame]:
    """What ``detect`` does with stored rows: the alerts of all rules, each in the slab of its time."""

    def evaluate(rows: DataFrame) -> DataFrame:
        found = rules.stateless_alerts(rows, stateless, alert_ts, keep=("event_ms",))
        for rule in windows:
            found = found.unionByName(rules.window_alerts(rows, rule, alert_ts, keep=("event_ms",)))
        return found.withColumn(PART, floor_to(F.col("event_ms"), width)).drop("event_ms")

    return evaluate


def tumbling(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    threshold: int = S.FREQUENCY_THRESHOLD,
    window_ms: int = S.FREQUENCY_WINDOW_MS,
    alert_ts: Column | None = None,
    **trigger,
):
    """The frequency rule on fixed windows; a window's alert follows the rows it has so far."""
    start = floor_to(F.col("event_ms"), window_ms)

    def evaluate(rows: DataFrame) -> DataFrame:
        found = rules.tumbling_alerts(rows, threshold, window_ms, alert_ts, keep=("event_ms",))
        return found.withColumn(PART, start).drop("event_ms")

    return keep_up(stream, start, evaluate, path, checkpoint, **trigger)


def once(stream: DataFrame, path: str, checkpoint: str, time: str = "alert_ts", **trigger):
    """Each alert id once, however far apart its copies come and whatever times they carry.

    The first copy counts: of the earliest batch, there of the earliest time. A batch reads the
    buckets of ids that its own ids fall into.
    """
    first = F.struct(F.col(time).isNull().alias("none"), F.col(time).alias("time"), F.struct(*stream.columns).alias("row"))

    def add(batch: DataFrame, batch_id: int) -> None:
        book = Ledger(batch.sparkSession, path).begin(batch_id)
        named = batch.filter(F.col("alert_id").isNotNull())
        rows = named.groupBy("alert_id").agg(F.min(first).alias("_first")).select("_first.row.*")
        rows = _stored(book, rows)
        day = F.coalesce(F.unix_date(F.to_date(time)).cast("long"), F.lit(NO_PART))
        book.append("result", unseen(book, rows, "alert_id").withColumn(PART, day))
        book.compact("result", stream.schema)
        book.commit()

    return each_batch(stream, add, checkpoint, **trigger)


def _stored(book: Batch, rows: DataFrame, name: str = "staged") -> DataFrame:
    """Rows of one batch, written so that several uses share the work."""
    path = f"{book.ledger.path}/{name}/slot{book.version % 2}"
    rows.write.mode("overwrite").parquet(path)
    return book.ledger.spark.read.schema(rows.schema).parquet(path)


# --- cases -------------------------------------------------------------------------------
STATE = ("status", "assigned_to", "action_note", "processed_at")


def case_states(alerts: DataFrame, commands: DataFrame, path: str, checkpoint: str, require_assignee: bool = False, **trigger):
    """The state after each accepted command; alerts and commands both arrive as streams.

    Each alert's state after its last command is carried. Commands later than that start from
    it. Only an alert that gets an earlier command, or whose commands came before the alert
    itself, is computed again, from its own commands. So a batch reads the buckets of the alerts
    it names and writes what changed. ``(alert_id, ts, seq)`` names a command.
    """
    opening = ("alert_id", *STATE)
    both = alerts.select("alert_id", F.struct(*STATE).alias("opening"), F.lit(None).cast(_struct(commands)).alias("command"))
    both = both.unionByName(
        commands.select(
            "alert_id", F.lit(None).cast(_struct(alerts, STATE)).alias("opening"),
            F.struct(*[c for c in commands.columns if c != "alert_id"]).alias("command"),
        )
    )
    begun = T.StructType([alerts.schema[c] for c in opening])
    carried = _keyed(T.StructType([*begun.fields, commands.schema["ts"], commands.schema["seq"]]))
    last = F.struct("ts", "seq")

    def refresh(batch: DataFrame, batch_id: int) -> None:
        book = Ledger(batch.sparkSession, path).begin(batch_id)
        arrived = _stored(book, batch)
        spark, n = batch.sparkSession, arrived.count()
        with _dealt(spark, n):
            given = arrived.filter("command IS NOT NULL").select("alert_id", "command.*").select(commands.columns)
            given = given.filter(cases.accepted(require_assignee)).dropDuplicates(["alert_id", "ts", "seq"])
            depth = book.deepen(
                given.count(),
                {"commands": (given.schema, "alert_id"), "opened": (begun, "alert_id"), "states": (carried, "alert_id"),
                 "replaced": (_keyed(_events_schema(begun, given.schema)), "alert_id")},
            )
            place = bucket(F.col("alert_id"), depth)
            touched = [r[0] for r in arrived.select(place.alias("part")).distinct().collect()]
        met_rows = sum(p.rows for name in ("commands", "opened", "states") for p in book.of(name, touched))
        with _dealt(spark, n + met_rows):
            known = _stored(book, latest(book.read("states", carried, touched)), "known")
            opened = arrived.filter("opening IS NOT NULL").select("alert_id", "opening.*").dropDuplicates(["alert_id"])
            opened = opened.join(known, "alert_id", "left_anti")
            earlier = book.read("commands", given.schema, touched).drop(PART, VERSION)

            first = given.groupBy("alert_id").agg(F.min(last).alias("_first"))
            met = known.join(first, "alert_id")
            in_order = met.filter(F.col("ts").isNull() | (F.col("_first") > last)).drop("_first", "ts", "seq")
            behind = met.filter(F.col("ts").isNotNull() & (F.col("_first") <= last)).select("alert_id")
            restarted = book.read("opened", begun, touched).drop(PART, VERSION).join(behind, "alert_id", "left_semi")
            restarted = restarted.unionByName(opened)
            again = earlier.unionByName(given).join(restarted.select("alert_id"), "alert_id", "left_semi")
            again = again.dropDuplicates(["alert_id", "ts", "seq"])
            work = _stored(book, given.join(in_order, "alert_id", "left_semi").unionByName(again), "work")
            starts = _stored(book, in_order.select(*opening).unionByName(restarted.select(*opening)), "starts")

            events = cases.status_events(starts, work, require_assignee)
            key = F.concat_ws("|", "alert_id", F.unix_micros("ts"), "seq")
            at = F.lit(batch_id).cast("long")
            states = cases.apply_commands(starts, work, require_assignee).join(
                work.groupBy("alert_id").agg(F.max(last).alias("_last")), "alert_id", "left"
            ).select(*opening, F.col("_last.ts").alias("ts"), F.col("_last.seq").alias("seq"))
            book.append("replaced", events.withColumns({KEY: key, AT: at, PART: place}))
            book.append("states", states.withColumns({KEY: F.col("alert_id"), AT: at, PART: place}))
            book.append("commands", given.withColumn(PART, place))
            book.append("opened", opened.withColumn(PART, place))
            newest = lambda rows: latest(rows.drop(VERSION), keep=True)
            book.compact("replaced", _keyed(events.schema), newest)
            book.compact("states", carried, newest)
            book.compact("commands", given.schema)
            book.compact("opened", begun)
            book.commit()

    return each_batch(both, refresh, checkpoint, **trigger)


def _events_schema(begun: T.StructType, given: T.StructType) -> T.StructType:
    return T.StructType([begun["alert_id"], given["ts"], given["seq"], given["cmd"], *[begun[c] for c in STATE]])


def _struct(rows: DataFrame, names: tuple[str, ...] | None = None) -> T.StructType:
    return T.StructType([rows.schema[c] for c in names or [c for c in rows.columns if c != "alert_id"]])


# --- counts ----------------------------------------------------------------------------
COUNTS = T.StructType([T.StructField(n, T.LongType()) for n in ("point_ms", "end_ms", "n")])
COUNTS_PART_MS = 86_400_000


def counts(
    stream: DataFrame, path: str, checkpoint: str, time: str = "event_ts", step: str = "5 seconds", slide: str | None = None,
    retain_ms: int | None = None, **trigger,
):
    """Rows per window as partial counts, merged as batches come; read them with ``total_counts``.

    Parts are days; with ``retain_ms`` days older than that, seen from the newest, expire.
    """

    def total(rows: DataFrame) -> DataFrame:
        return rows.groupBy("point_ms", "end_ms", PART).agg(F.sum("n").alias("n"))

    def add(batch: DataFrame, batch_id: int) -> None:
        book = Ledger(batch.sparkSession, path).begin(batch_id)
        windows = F.window(time, step, slide) if slide else F.window(time, step)
        partial = batch.groupBy(windows.alias("w")).agg(F.count("*").alias("n")).select(
            F.unix_millis("w.start").alias("point_ms"), F.unix_millis("w.end").alias("end_ms"), "n"
        )
        book.append("counts", partial.withColumn(PART, floor_to(F.col("point_ms"), COUNTS_PART_MS)))
        book.compact("counts", COUNTS, total)
        if retain_ms is not None:
            newest = max((p.part for p in book.of("counts")), default=0)
            book.expire("counts", newest - retain_ms)
        book.commit()

    return each_batch(stream, add, checkpoint, **trigger)


def total_counts(spark: SparkSession, path: str) -> DataFrame:
    """``point_ms, end_ms, n`` of every window that has rows, the last ones too."""
    return Ledger(spark, path).read("counts", COUNTS).groupBy("point_ms", "end_ms").agg(F.sum("n").alias("n"))
