"""Session settings and the shared folder that checkpoints and written tables use."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_local_scratch: str | None = None


def build_session(app: str = "txnwatch", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings this library relies on; ``conf`` wins over them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]):
    """Settings that hold for what is started inside, put back afterwards."""
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder.

    Only a session that names no folder (tests, one machine) falls back to the
    local temporary folder.
    """
    global _local_scratch
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="txnwatch-")
        root = _local_scratch
    return f"{root.rstrip('/')}/txnwatch-{name}-{uuid.uuid4().hex}"


def local_cpus() -> int:
    return int(os.environ.get("BENCH_CPUS", os.cpu_count() or 1))
