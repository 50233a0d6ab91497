"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Rows handed to Python are counted into batches, and with a byte limit each row is also measured,
# which costs several times the transfer itself for narrow points. Sessions may lift the limit for
# points; whatever hands over whole series or requests sets it again for its own action.
BATCH_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
NO_BATCH_BYTES = str(2**31 - 1)
WIDE_BATCH_BYTES = str(64 << 20)


def local_session(app: str = "seriesloom", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings the session."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        BATCH_BYTES_CONF: NO_BATCH_BYTES,
        **conf,
    }
    if CHECKPOINT_CONF not in settings:
        settings[CHECKPOINT_CONF] = tempfile.mkdtemp(prefix="seriesloom-")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder would be invisible to other executors, so without the setting
    this works on a local master only.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="seriesloom-")
        spark.conf.set(CHECKPOINT_CONF, base)
    path = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    return path if "://" in path or path.startswith("file:") else os.path.abspath(path)


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """Bound the bytes of a batch while an action hands large rows to Python."""
    before = spark.conf.get(BATCH_BYTES_CONF)
    spark.conf.set(BATCH_BYTES_CONF, WIDE_BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES_CONF, before)
