"""Where requests go.

A sink takes the series of a batch, each with its ``shard`` and ``request_id``, and raises when
it cannot deliver. The rows stay on the executors: what reaches the driver are counts and
whether anything failed. Delivery is at-least-once; every write is keyed by stream and batch id,
so a repeated batch replaces itself and nothing else.
"""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any, Protocol

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from seriesloom.operators.packing import build_requests
from seriesloom.session import scratch_dir, wide_rows
from seriesloom.sources import series_avro

log = logging.getLogger(__name__)

REQUEST_KEY = ["shard", "request_id"]
RETRIES = 2  # fixed value: repeated attempts after the first
BACKOFF_S = 0.01  # fixed value: one back-off slot
_PARALLEL_MOVES = 32  # file renames under way at once when a batch is published


class MissingCredential(Exception):
    """The user gave no credential: reported even when a fallback took the data."""


class DeliveryFailed(Exception):
    """Some requests were not delivered; ``failed`` lists them (shard, request_id, error)."""

    def __init__(self, message: str, failed: DataFrame, credentials: bool = False):
        super().__init__(message)
        self.failed = failed
        self.credentials = credentials


class Sink(Protocol):
    def write(self, series: DataFrame, batch_id: int) -> None: ...


MAIN_STREAM = "main"  # the stream of batches that are numbered by hand


class BatchId(int):
    """The number of a batch that also knows its stream: two jobs may both have a batch 0.

    ``stream`` is the id that the checkpoint keeps, so a restarted job repeats its own batches.
    """

    stream: str

    def __new__(cls, number: int, stream: str) -> BatchId:
        self = super().__new__(cls, number)
        self.stream = stream
        return self


def stream_of(batch_id: int) -> str:
    return getattr(batch_id, "stream", MAIN_STREAM)


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/stream_id={stream_of(batch_id)}/batch_id={int(batch_id)}"


@dataclass
class TableSink:
    """Series as Parquet, one folder per stream and batch, replaced when the batch is repeated."""

    path: str

    def _folder(self, batch_id: int) -> str:
        return batch_folder(self.path, batch_id)

    def write(self, series: DataFrame, batch_id: int) -> None:
        series.write.mode("overwrite").parquet(self._folder(batch_id))

    def holds(self, spark: SparkSession, batch_id: int) -> bool:
        """Whether a batch was written to its end."""
        fs, plain = series_avro.open_fs(self._folder(batch_id))
        return fs.get_file_info(f"{plain}/_SUCCESS").is_file

    def staging(self, batch_id: int) -> str:
        """Where a batch is prepared; readers of the table pass over it."""
        return batch_folder(f"{self.path}/_staging", batch_id)

    def publish(self, folder: str, batch_id: int) -> None:
        """Make the Parquet files of ``folder``, on the table's file system, the batch, by renaming them."""
        fs, source = series_avro.open_fs(folder)
        _, target = series_avro.open_fs(self._folder(batch_id))
        if fs.get_file_info(target).type == pafs.FileType.Directory:
            fs.delete_dir(target)  # of an attempt that was not finished
        fs.create_dir(target, recursive=True)
        names = [f.base_name for f in fs.get_file_info(pafs.FileSelector(source)) if f.base_name.endswith(".parquet")]
        with ThreadPoolExecutor(_PARALLEL_MOVES) as pool:
            list(pool.map(lambda name: fs.move(f"{source}/{name}", f"{target}/{name}"), names))
        fs.open_output_stream(f"{target}/_SUCCESS").close()

    def drop_staging(self, batch_id: int) -> None:
        fs, plain = series_avro.open_fs(self.staging(batch_id))
        if fs.get_file_info(plain).type == pafs.FileType.Directory:
            fs.delete_dir(plain)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def exists(folder: str) -> bool:
    fs, plain = series_avro.open_fs(folder)
    return fs.get_file_info(plain).type == pafs.FileType.Directory


@dataclass
class FileSink:
    """Series containers, one folder per stream and batch."""

    path: str
    dataset_id: str | None = None

    def write(self, series: DataFrame, batch_id: int) -> None:
        series_avro.write_series(series, batch_folder(self.path, batch_id), True, self.dataset_id)

    def read(self, spark: SparkSession) -> DataFrame:
        return series_avro.read_series(spark, self.path)


def _json_payload() -> Column:
    return F.to_json(F.struct("series", "session_name")).cast("binary")


_STATUS = pa.schema(
    [
        ("shard", pa.string()), ("request_id", pa.int64()), ("points", pa.int64()), ("attempts", pa.int32()),
        ("ok", pa.bool_()), ("credentials", pa.bool_()), ("millis", pa.int64()), ("error", pa.string()),
    ]
)
_STATUS_DDL = (
    "shard string, request_id bigint, points bigint, attempts int, "
    "ok boolean, credentials boolean, millis bigint, error string"
)


def _attempt(send, payload: bytes, meta: dict, retries: int, backoff: float):
    for attempt in range(1, retries + 2):
        try:
            send(payload, meta)
            return attempt, True, False, None
        except MissingCredential as e:
            return attempt, False, True, str(e)
        except Exception as e:  # noqa: BLE001 - whatever the user's sender raises is a failed attempt
            error = f"{type(e).__name__}: {e}"
            if attempt <= retries:
                time.sleep(backoff * attempt)
    return retries + 1, False, False, error


def _sender(send, meta: dict, retries: int, backoff: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                key = f"{meta['stream_id']}-{meta['batch_id']}-{row['shard']}-{row['request_id']}"
                started = time.monotonic()
                result = _attempt(send, row["payload"], {**meta, "idempotency_key": key}, retries, backoff)
                attempts, ok, credentials, error = result
                millis = int(1000 * (time.monotonic() - started))
                rows.append((row["shard"], row["request_id"], row["points"], attempts, ok, credentials, millis, error))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, f.type) for column, f in zip(zip(*rows) if rows else [[]] * len(_STATUS), _STATUS)],
                schema=_STATUS,
            )

    return run


@dataclass
class SendSink:
    """Calls ``send(payload, meta)`` once per request on the executors.

    ``meta`` holds the options, the batch id and an idempotency key that is the same whenever
    the request is sent again. ``payload`` is built by ``encode``, a column expression over the
    request; the default is its JSON. ``dispatchers`` is the number of parallel senders; by default
    the cluster's cores.
    The outcome of each request is written to the shared folder, because sending must not be
    repeated by whoever looks at the outcome.
    """

    send: Callable[[bytes, dict[str, Any]], None]
    options: dict[str, Any] | None = None
    encode: Callable[[], Column] = _json_payload
    dispatchers: int | None = None
    retries: int = RETRIES
    backoff: float = BACKOFF_S
    status_path: str | None = None

    def write(self, series: DataFrame, batch_id: int) -> None:
        spark = series.sparkSession
        requests = build_requests(series)
        requests = requests.repartition(self.dispatchers or spark.sparkContext.defaultParallelism)
        encoded = requests.select(
            F.col("shard").cast("string").alias("shard"), "request_id",
            F.col("point_count").alias("points"), self.encode().alias("payload"),
        )
        meta = {**(self.options or {}), "batch_id": int(batch_id), "stream_id": stream_of(batch_id)}
        worker = _sender(self.send, meta, self.retries, self.backoff)
        self.status_path = self.status_path or scratch_dir(spark, "sent")
        folder = batch_folder(self.status_path, batch_id)
        with wide_rows(spark):
            encoded.mapInArrow(worker, _STATUS_DDL).write.mode("overwrite").parquet(folder)
        failed = spark.read.parquet(folder).where("not ok")
        n, credentials = failed.agg(F.count(F.lit(1)), F.coalesce(F.bool_or("credentials"), F.lit(False))).first()
        if n:
            raise DeliveryFailed(f"{n} requests of batch {batch_id} were not delivered", failed, credentials)

    def status(self, spark: SparkSession) -> DataFrame:
        """Outcome, attempts and time of every request so far."""
        return spark.read.parquet(self.status_path)


@dataclass
class FallbackSink:
    """What the primary cannot deliver goes to the fallback.

    When the primary tells which requests failed, only those are passed on. The result is the
    fallback's, but a missing credential is reported after the fallback has written.
    """

    primary: Sink
    fallback: Sink

    def write(self, series: DataFrame, batch_id: int) -> None:
        try:
            self.primary.write(series, batch_id)
        except DeliveryFailed as e:
            log.warning("primary sink: %s; using the fallback", e)
            lost = e.failed.select(F.col("shard").alias("_shard"), F.col("request_id").alias("_request"))
            same = (F.col("shard").cast("string") == F.col("_shard")) & (F.col("request_id") == F.col("_request"))
            self.fallback.write(series.join(lost, same, "left_semi"), batch_id)
            if e.credentials:
                raise MissingCredential(str(e)) from e
        except Exception as e:  # noqa: BLE001 - any failure of the primary means the fallback
            log.warning("primary sink failed: %s; using the fallback", e)
            self.fallback.write(series, batch_id)
            if isinstance(e, MissingCredential):
                raise


@dataclass
class DualSink:
    """Both sinks are always tried; the primary's error is reported first."""

    primary: Sink
    secondary: Sink

    def write(self, series: DataFrame, batch_id: int) -> None:
        errors = []
        for sink in (self.primary, self.secondary):
            try:
                sink.write(series, batch_id)
            except Exception as e:  # noqa: BLE001 - the other sink must still be tried
                log.warning("sink %s failed: %s", type(sink).__name__, e)
                errors.append(e)
        if errors:
            raise errors[0]


class Listener(Protocol):
    """Told about every delivered or failed batch; gets a summary, never the rows."""

    def on_success(self, summary: dict) -> None: ...

    def on_error(self, error: Exception, summary: dict) -> None: ...


def summarise(series: DataFrame, batch_id: int) -> dict:
    counts = series.groupBy(*REQUEST_KEY).agg(F.sum("n").alias("p")).agg(F.count(F.lit(1)), F.sum("p")).first()
    return {"batch_id": batch_id, "requests": counts[0], "points": counts[1] or 0}


#: Seconds in which what a finished write has observed must be there; a sink that reads nothing observes nothing.
OBSERVED_S = 10.0


def observed(watch: Observation) -> dict | None:
    """What a finished action has observed; none if none ran over the observed rows, or there were no rows."""
    found: list[dict] = []

    def wait() -> None:  # it waits for an action
        try:
            found.append(watch.get)
        except Exception:  # noqa: BLE001 - a plan that turned out empty has lost what observes it
            log.debug("nothing was observed")

    waiting = threading.Thread(target=wait, daemon=True)
    waiting.start()
    waiting.join(OBSERVED_S)
    return found[0] if found else None


@dataclass
class ListeningSink:
    """Tells all listeners, in order, how a write went, and passes the error on.

    With ``shards`` known, requests and points are observed while the sink's own job reads the series: request
    numbers of a shard have no gap, so the largest of each tells how many there are (E10). Otherwise, and
    for a failed write, they are counted by a job of its own.
    """

    sink: Sink
    listeners: list
    shards: int | None = None

    def _watched(self, series: DataFrame) -> tuple[DataFrame, Observation | None]:
        if self.shards is None:
            return series, None
        watch = Observation()
        highest = [F.max(F.when(F.col("shard") == i, F.col("request_id"))).alias(f"shard_{i}") for i in range(self.shards)]
        return series.observe(watch, F.sum("n").alias("points"), *highest), watch

    def write(self, series: DataFrame, batch_id: int) -> None:
        rows, watch = self._watched(series)
        started = time.monotonic()
        try:
            self.sink.write(rows, batch_id)
        except Exception as e:
            summary = summarise(series, batch_id)
            for listener in self.listeners:
                listener.on_error(e, summary)
            raise
        millis = int(1000 * (time.monotonic() - started))
        seen = observed(watch) if watch else None
        if seen is None:
            summary = summarise(series, batch_id)
        else:
            requests = sum(1 + seen[f"shard_{i}"] for i in range(self.shards) if seen[f"shard_{i}"] is not None)
            summary = {"batch_id": batch_id, "requests": requests, "points": seen["points"] or 0}
        summary["millis"] = millis
        for listener in self.listeners:
            if hasattr(listener, "on_success"):
                listener.on_success(summary)


def delivery_stats(delivered: DataFrame) -> DataFrame:
    """Requests and points per delivered batch of each stream."""
    batch = ["stream_id", "batch_id"]
    return (
        delivered.groupBy(*batch, *REQUEST_KEY).agg(F.sum("n").alias("p"))
        .groupBy(*batch).agg(F.count(F.lit(1)).alias("requests"), F.sum("p").alias("points"))
    )
