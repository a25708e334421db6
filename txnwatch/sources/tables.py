"""Tables on a shared file system: the alert history, its archive, rules, CSV reports."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnwatch import schemas as S
from txnwatch.functions import times
from txnwatch.session import session_settings
from txnwatch.sources.ledger import Batch, Ledger, unseen

def stream_table(spark: SparkSession, folder: str, name: str, files_per_batch: int = 64) -> DataFrame:
    """A Parquet table (a folder of files, or one file) as a stream of its files.

    ``files_per_batch`` bounds a micro-batch. The jobs in ``streaming.upkeep`` give the same
    result for any bound.
    """
    path = f"{folder.rstrip('/')}/{name}.parquet"
    table = spark.read.parquet(path)
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files_per_batch)
    if [file.rsplit("/", 1)[1] for file in table.inputFiles()] == [f"{name}.parquet"]:
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return reader.parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """History rows plus the partition column ``alert_date``."""
    layout = T.StructType([*S.HISTORY.fields, T.StructField("alert_date", T.DateType())])
    return spark.read.schema(layout).parquet(path)


def _stored_history(spark: SparkSession, path: str) -> DataFrame | None:
    """The history, or nothing where none is stored yet."""
    try:
        return read_history(spark, path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def append_history(rows: DataFrame, path: str) -> None:
    """Add rows whose id is not stored yet; appending the same rows again adds nothing.

    Ids are compared with those of the whole history, since an alert that is detected again may
    carry any other time. They are kept beside it, in buckets of bounded size (``ledger``): an
    append reads the buckets its own ids fall into and writes its ids, whatever the history holds.

    New rows are stored first, then added to the history, then their ids count. An append that
    failed on the way is finished by the next one: of its stored rows those are added that the
    history doesn't hold at their dates.
    """
    spark = rows.sparkSession
    index = Ledger(spark, f"{path.rstrip('/')}/_ids")
    batch = index.begin()
    left = _staged(spark, index, batch.version)
    if left is not None and not left.isEmpty():
        _finish(batch, left, path, interrupted=True)
        batch = index.begin()
    slot = f"{index.path}/staged/slot{batch.version % 2}"
    new = rows.select(*S.HISTORY.names).dropDuplicates(["alert_id"])
    new.withColumn("_append", F.lit(batch.version).cast("long")).write.mode("overwrite").parquet(slot)
    _finish(batch, _staged(spark, index, batch.version), path)


def _staged(spark: SparkSession, index: Ledger, version: int) -> DataFrame | None:
    """The rows of an append that was begun."""
    layout = T.StructType([*S.HISTORY.fields, T.StructField("_append", T.LongType())])
    try:
        stored = spark.read.schema(layout).parquet(f"{index.path}/staged/slot{version % 2}")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return stored.filter(F.col("_append") == version).drop("_append")


def _finish(batch: Batch, staged: DataFrame, path: str, interrupted: bool = False) -> None:
    """Adds the staged rows with new ids to the history, then commits their ids.

    The rebalance hint splits a busy day over several files and keeps quiet days in one; rows are
    sorted by time inside a file so that its statistics prune, and bloom filters on user and id
    let equality searches skip row groups.
    """
    new = unseen(batch, staged, "alert_id").withColumn("alert_date", F.to_date("alert_timestamp"))
    if interrupted:
        stored = _stored_history(staged.sparkSession, path)
        if stored is not None:
            there = stored.select(F.col("alert_id").alias("_id"), F.col("alert_date").alias("_date"))
            same = (F.col("alert_id") == F.col("_id")) & F.col("alert_date").eqNullSafe(F.col("_date"))
            new = new.join(there, same, "left_anti")
    writer = (
        new.hint("rebalance", "alert_date")
        .sortWithinPartitions("alert_date", F.col("alert_timestamp").desc())
        .select(*S.HISTORY.names, "alert_date")
        .write.mode("append")
        .option("parquet.bloom.filter.enabled#user_id", "true")
        .option("parquet.bloom.filter.enabled#alert_id", "true")
        .option("parquet.bloom.filter.fpp#alert_id", "0.0001")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .partitionBy("alert_date")
    )
    # the default timestamp layout has no minimum and maximum to prune by
    with session_settings(staged.sparkSession, {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}):
        writer.parquet(path)
    batch.commit()


def archive_split(
    history: DataFrame, as_of: datetime, days: int = S.ARCHIVE_DAYS, time: str = "alert_timestamp"
) -> tuple[DataFrame, DataFrame]:
    """(kept, archived): alerts older than ``days`` go to the archive."""
    edge = times.at(as_of) - F.make_dt_interval(days=F.lit(days))
    by_month = history.withColumn("alert_month", F.date_format(time, "yyyy-MM"))
    return by_month.filter(F.col(time) >= edge), by_month.filter(F.col(time) < edge)


def write_by_month(rows: DataFrame, path: str, mode: str = "append") -> None:
    rows.hint("rebalance", "alert_month").write.mode(mode).partitionBy("alert_month").parquet(path)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """The rule table as it is now. Call it per micro-batch to pick up changes without a restart."""
    return spark.read.schema(S.RULES).parquet(path)


def report_name(kind: str, start: date, end: date | None = None) -> str:
    span = start.isoformat() if end is None else f"{start.isoformat()}-to-{end.isoformat()}"
    return f"{kind}-alerts-{span}.csv"


def export_csv(report: DataFrame, folder: str, kind: str, start: date, end: date | None = None) -> str:
    """Write an aggregated report as one CSV with header; returns the folder of that name.

    The first header starts with a byte-order mark, which is what spreadsheet
    programs need to read UTF-8. Reports have one row per hour or rule.
    """
    target = f"{folder.rstrip('/')}/{report_name(kind, start, end)}"
    first, *others = report.columns
    marked = report.select(F.col(first).alias("\ufeff" + first), *others)
    marked.coalesce(1).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(target)
    return target
