"""Session settings the engine relies on."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Results depend on the first two: timestamps are rendered in UTC, and a JSON key given twice
# keeps its last value.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# The default of this one follows the live core count. It is pinned, unless the session has its own
# value, so that every scan of one run cuts a file into the same splits while executors come and go.
SPLIT_KEY = "spark.sql.files.minPartitionNum"

CHECKPOINT_KEY = "spark.checkpoint.dir"


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session that somebody else built."""
    for key, value in RESULT_CONF.items():
        spark.conf.set(key, value)
    if spark.conf.get(SPLIT_KEY, None) is None:
        spark.conf.set(SPLIT_KEY, str(spark.sparkContext.defaultParallelism))
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session that holds meanwhile."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def build_session(app_name: str = "logwarden", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **RESULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare_session(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder for written intermediate tables: the cluster's own, or a fresh one in local tests."""
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    folder = os.path.join(tempfile.mkdtemp(prefix="logwarden-"), "work")
    spark.sparkContext.setCheckpointDir(folder)
    return folder
