"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings the library relies on or profits from. None of them depends on the
# size of the data: from the sizes it measures, AQE merges small reduce tasks
# and splits skewed ones. (It never makes more reduce tasks than
# spark.sql.shuffle.partitions, so a large cluster raises that.)
SETTINGS = {
    # Times without an offset are read as UTC.
    "spark.sql.session.timeZone": "UTC",
    # The default, INT96, has no min/max in the Parquet footer, so that a
    # filter on a time could not skip anything.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Stream state on local disk instead of the executor heap.
    STATE_STORE: ROCKSDB,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Files that a task holds open at once, one for each value the rows are split by. Up to
# that many, rows are not sorted before they are written.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def with_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings for a write or for the start of a stream, which keeps them."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def build_session(
    app: str, master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    """A session with the recommended settings; ``extra`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers find this package at the place where the driver has it.

    Enough on one machine and where the place is shared; elsewhere the package is
    shipped with ``--py-files``. Called by whatever runs Python in tasks.
    """
    root = str(Path(__file__).resolve().parents[1])
    settings = spark.sparkContext.environment
    known = [p for p in settings.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        settings["PYTHONPATH"] = os.pathsep.join([root, *known])


def new_workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that all executors can reach, for written tables.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``. Only
    a local session, whose executors share the driver's disk, may do without
    that setting. Where the folder is a mounted one, what is in it goes when the
    driver's program ends; an object store needs a rule that removes old ones.
    """
    name = f"assayer-{purpose}-{uuid.uuid4().hex}"
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared:
        path = f"{shared.rstrip('/')}/{name}"
        mounted = path.removeprefix("file://").removeprefix("file:")
        if mounted.startswith("/"):
            atexit.register(shutil.rmtree, mounted, ignore_errors=True)
        return path
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    path = tempfile.mkdtemp(prefix=f"{name}-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path
