"""Rows of a stream sent one by one by a streaming writer, outcomes committed per epoch.

Beside ``SendSink``, which builds requests of points within ``foreachBatch``: here every row is a request already, such
as a series with its arrays. Tasks send, and tell Spark in their commit messages which file of outcomes they wrote;
what the commit of an epoch publishes is what the tasks that count have sent. Only file names and counts reach the driver.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter

from seriesloom.sources.series_avro import open_fs
from seriesloom.streaming.sinks import _PARALLEL_MOVES, BACKOFF_S, RETRIES, _attempt

STAGING = "_staging"
OUTCOMES_DDL = (
    "channel string, request_key string, points bigint, attempts int, ok boolean, credentials boolean, "
    "millis bigint, error string"
)
_OUTCOMES = pa.schema(
    [
        ("channel", pa.string()), ("request_key", pa.string()), ("points", pa.int64()), ("attempts", pa.int32()),
        ("ok", pa.bool_()), ("credentials", pa.bool_()), ("millis", pa.int64()), ("error", pa.string()),
    ]
)


class NotDelivered(Exception):
    """Some rows of a task could not be sent."""


@dataclass
class Sent(WriterCommitMessage):
    name: str  # file of outcomes in the staging folder; empty for a task without rows


class OutcomeWriter(DataSourceStreamArrowWriter):
    """``deliver(payload, request_key)`` gives attempts, ok, credentials and error of one row."""

    def __init__(self, path: str, deliver: Callable, fail: bool):
        self.path, self.deliver, self.fail = path, deliver, fail

    def write(self, iterator):
        fs, plain = open_fs(self.path)
        name, file, failed, last = f"part-{uuid.uuid4().hex}.parquet", None, 0, None
        try:
            for batch in iterator:
                rows = []
                for row in batch.to_pylist():
                    started = time.monotonic()
                    attempts, ok, credentials, error = self.deliver(row["payload"], row["request_key"])
                    millis = int(1000 * (time.monotonic() - started))
                    rows.append((row["channel"], row["request_key"], row["points"], attempts, ok, credentials, millis, error))
                    failed, last = failed + (not ok), error or last
                if not rows:
                    continue
                if file is None:
                    fs.create_dir(f"{plain}/{STAGING}", recursive=True)
                    file = pq.ParquetWriter(f"{plain}/{STAGING}/{name}", _OUTCOMES, filesystem=fs)
                columns = [pa.array(column, f.type) for column, f in zip(zip(*rows), _OUTCOMES)]
                file.write_batch(pa.RecordBatch.from_arrays(columns, schema=_OUTCOMES))
        finally:
            if file is not None:
                file.close()
        if failed and self.fail:
            raise NotDelivered(f"{failed} rows were not sent; the last error: {last}")
        return Sent(name if file is not None else "")

    def commit(self, messages, batchId):
        """Publish an epoch's outcomes; a repeated commit replaces what an unfinished one has left."""
        fs, plain = open_fs(self.path)
        target = f"{plain}/epoch={batchId}"
        if fs.get_file_info(target).type == pafs.FileType.Directory:
            fs.delete_dir(target)
        names = [m.name for m in messages if m is not None and m.name]
        if names:
            fs.create_dir(target, recursive=True)
            with ThreadPoolExecutor(_PARALLEL_MOVES) as pool:
                list(pool.map(lambda name: fs.move(f"{plain}/{STAGING}/{name}", f"{target}/{name}"), names))
        self._clear(fs, plain)

    def abort(self, messages, batchId):
        self._clear(*open_fs(self.path))

    def _clear(self, fs, plain: str) -> None:
        """Epochs follow each other, so what is still staged belongs to lost or repeated tasks."""
        if fs.get_file_info(f"{plain}/{STAGING}").type == pafs.FileType.Directory:
            fs.delete_dir_contents(f"{plain}/{STAGING}")


def _source(format_name: str, path: str, deliver: Callable, fail: bool) -> type[DataSource]:
    class Requests(DataSource):
        @classmethod
        def name(cls):
            return format_name

        def streamWriter(self, schema, overwrite):
            return OutcomeWriter(path, deliver, fail)

    return Requests


def send_stream(
    rows: DataFrame, send: Callable[[bytes, dict[str, Any]], None], checkpoint: str, channel: Column, payload: Column,
    points: Column, options: dict[str, Any] | None = None, outcomes: str | None = None, stream: str | None = None,
    dispatchers: int | None = None, retries: int = RETRIES, backoff: float = BACKOFF_S, on_failure: str = "fail",
) -> DataStreamWriter:
    """A stream that calls ``send(payload, meta)`` once per row on the executors; start it with a trigger of your choice.

    ``meta`` holds the options, the stream and an idempotency key made of the stream, the channel and the payload, so
    that a killed task, a repeated epoch and a restarted query send a row under the key it had; equal rows of a stream
    have the same key. ``stream`` defaults to a digest of the checkpoint's path. A null payload is an error.

    ``on_failure='fail'``: a task that could not send all its rows fails after trying each, its epoch is repeated,
    and its outcomes are not listed; ``'drop'``: rows not sent are listed as not ok, and the stream goes on. Outcomes lie
    under ``outcomes`` (default: beside the checkpoint), a folder per committed epoch; see ``read_outcomes``.
    """
    if on_failure not in ("fail", "drop"):
        raise ValueError(f"on_failure is fail or drop, not {on_failure}")
    spark = rows.sparkSession
    stream = stream or hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    meta = {**(options or {}), "stream_id": stream}

    def deliver(payload: bytes, key: str):
        return _attempt(send, payload, {**meta, "idempotency_key": key}, retries, backoff)

    name = f"requests_{uuid.uuid4().hex}"
    spark.dataSource.register(_source(name, outcomes or outcomes_path(checkpoint), deliver, on_failure == "fail"))
    body = F.coalesce(payload.cast("binary"), F.raise_error(F.lit("a request without payload")).cast("binary"))
    requests = rows.select(channel.alias("channel"), points.cast("bigint").alias("points"), body.alias("payload"))
    digest = F.sha2(F.concat(F.coalesce(F.col("channel"), F.lit("")).cast("binary"), F.lit(b"\x00"), F.col("payload")), 256)
    requests = requests.withColumn("request_key", F.concat(F.lit(f"{stream}-"), digest))
    if dispatchers:
        requests = requests.repartition(dispatchers)
    return requests.writeStream.format(name).option("checkpointLocation", checkpoint).outputMode("append")


def outcomes_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-outcomes"


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """The outcome of every row of the committed epochs, with its ``epoch``."""
    return spark.read.schema(f"{OUTCOMES_DDL}, epoch bigint").parquet(path)
