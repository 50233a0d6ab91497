"""The ingest job: streaming points, options and targets in one query."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from seriesloom.operators.packing import BLOCK_KEY, pack_series, request_blocks, with_shard
from seriesloom.schema import check_points
from seriesloom.streaming.sinks import BatchId, DualSink, FallbackSink, FileSink, ListeningSink, SendSink, Sink, observed

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class IngestOptions:
    """The defaults users of such streams expect."""

    max_points_per_record: int = 250_000  # points per series and per request
    max_request_delay: float = 0.1  # seconds between micro-batches
    max_buffered_requests: int = 4  # new files admitted per micro-batch, where points are not bounded
    request_dispatcher_tasks: int = 8  # parallel request sequences and senders
    max_points_in_flight: int | None = None  # points admitted per micro-batch
    max_bytes_per_record: int | None = None  # bytes per series and per request, for wide values


def points_per_byte(rows: DataFrame) -> float:
    """The most rows that a byte of a source file holds, over all files of a static DataFrame; 0 without rows."""
    files = rows.select("_metadata.file_path", "_metadata.file_size").groupBy("file_path", "file_size").count()
    return files.agg(F.coalesce(F.max(F.col("count") / F.col("file_size")), F.lit(0.0))).first()[0]


def admitted(reader: DataStreamReader, options: IngestOptions, density: float | None = None) -> DataStreamReader:
    """Back-pressure: a micro-batch takes a bounded number of points, or of new files.

    With ``max_points_in_flight`` and a ``density``, the points in a byte of the densest file, Spark admits files up to the
    bytes that can hold so many points, however unequal they are. A file is never divided: one that is larger by
    itself is a micro-batch of its own.
    """
    if options.max_points_in_flight and density:
        return reader.option("maxBytesPerTrigger", max(1, int(options.max_points_in_flight / density)))
    return reader.option("maxFilesPerTrigger", options.max_buffered_requests)


class _Log:
    def on_success(self, summary: dict) -> None:
        log.debug("delivered %s", summary)

    def on_error(self, error: Exception, summary: dict) -> None:
        log.error("failed to deliver %s: %s", summary, error)


class _Gauge:
    """Points taken up, and points whose fate is decided: delivered, or given up under ``drop``."""

    def __init__(self, drop: bool):
        self.accepted = self.settled = 0
        self.drop = drop

    def on_success(self, summary: dict) -> None:
        self.settled += summary["points"]

    def on_error(self, error: Exception, summary: dict) -> None:
        if self.drop:
            self.settled += summary["points"]


class IngestJob:
    """Streaming points delivered in requests.

        job = IngestJob(points, checkpoint).to_remote(send).with_file_fallback(path)
        with job:
            ...

    Targets: remote, file, remote and file (both written), remote or file with a file fallback.
    ``on_failure='fail'`` ends the query when a batch cannot be delivered, and a restart repeats
    it from the checkpoint; ``'drop'`` logs the error and goes on.
    """

    def __init__(
        self, points: DataFrame, checkpoint: str, options: IngestOptions = IngestOptions(), on_failure: str = "fail"
    ):
        self.points = check_points(points)
        self.checkpoint = checkpoint
        self.options = options
        self.on_failure = on_failure
        self.remote: Sink | None = None
        self.file: Sink | None = None
        self.fallback: Sink | None = None
        self.listeners: list = []
        self.query: StreamingQuery | None = None
        self._gauge = _Gauge(on_failure == "drop")
        self._known = threading.Event()  # the query is there to tell its id

    # -- definition (F1) -------------------------------------------------------------------

    @classmethod
    def from_files(
        cls, spark: SparkSession, path: str, schema: T.StructType | str, to_points: Callable[[DataFrame], DataFrame],
        checkpoint: str, options: IngestOptions = IngestOptions(), on_failure: str = "fail", format: str = "parquet",
        points_per_row: int = 1,
    ) -> IngestJob:
        """A job over the files under ``path``, admitted as the options say.

        ``to_points`` makes points of rows, ``points_per_row`` at most. The files' density is measured once, when the job
        is defined; for the columnar formats this reads no column.
        """
        density = None
        if options.max_points_in_flight:
            density = points_per_row * points_per_byte(spark.read.schema(schema).format(format).load(path))
        rows = admitted(spark.readStream.schema(schema).format(format), options, density).load(path)
        return cls(to_points(rows), checkpoint, options, on_failure)

    def with_options(self, **changes) -> IngestJob:
        self.options = replace(self.options, **changes)
        return self

    def to_remote(self, send, options: dict | None = None, **settings) -> IngestJob:
        """A function called per request on the executors, or any sink object."""
        self.remote = send if hasattr(send, "write") else SendSink(
            send, options, dispatchers=self.options.request_dispatcher_tasks, **settings
        )
        return self

    def to_file(self, target: str | Sink, dataset_id: str | None = None) -> IngestJob:
        self.file = FileSink(target, dataset_id) if isinstance(target, str) else target
        return self

    def with_file_fallback(self, target: str | Sink, dataset_id: str | None = None) -> IngestJob:
        self.fallback = FileSink(target, dataset_id) if isinstance(target, str) else target
        return self

    def add_listener(self, listener) -> IngestJob:
        self.listeners.append(listener)
        return self

    def with_listeners(self, listeners) -> IngestJob:
        self.listeners = list(listeners)
        return self

    def sink(self) -> Sink:
        """The sink that the chosen targets mean; impossible choices are refused."""
        if not self.remote and not self.file:
            raise ValueError("the job needs a remote or a file target")
        if self.remote and self.file and self.fallback:
            raise ValueError("choose one of file target and file fallback next to a remote target")
        if self.remote and self.file:
            target: Sink = DualSink(self.remote, self.file)
        else:
            target = self.remote or self.file
            if self.fallback:
                target = FallbackSink(target, self.fallback)
        return ListeningSink(target, [*self.listeners, _Log(), self._gauge], self.options.request_dispatcher_tasks)

    # -- one micro-batch -------------------------------------------------------------------

    def _deliver(self, target: Sink):
        options = self.options

        def deliver(batch: DataFrame, number: int) -> None:
            self._known.wait()
            batch_id = BatchId(number, str(self.query.id))
            points = batch.persist()  # read by the hot-key pass and by the packing
            taken = Observation()
            # the hot-key pass reads every point and counts them on its way
            packed = pack_series(points.observe(taken, F.count(F.lit(1)).alias("points")), options.max_points_per_record, max_bytes=options.max_bytes_per_record)
            packed = with_shard(packed, options.request_dispatcher_tasks).persist()
            requests = request_blocks(packed, options.max_points_per_record, max_bytes=options.max_bytes_per_record).persist()
            try:
                seen = observed(taken)
                accepted = seen["points"] if seen else points.count()
                if accepted:  # an empty buffer sends nothing (C9)
                    self._gauge.accepted += accepted
                    target.write(packed.join(requests, BLOCK_KEY), batch_id)
            except Exception as e:  # noqa: BLE001 - the policy decides
                if self.on_failure != "drop":
                    raise
                log.error("batch %s is dropped: %s", number, e)
            finally:
                for cached in (requests, packed, points):
                    cached.unpersist()

        return deliver

    # -- life cycle (F2 to F4) -------------------------------------------------------------

    @property
    def is_open(self) -> bool:
        return self.query is not None and self.query.isActive

    def _start(self, **trigger) -> StreamingQuery:
        if self.is_open:
            raise RuntimeError("the job is already open")
        target = self.sink()
        self._known.clear()
        writer = self.points.writeStream.option("checkpointLocation", self.checkpoint)
        self.query = writer.trigger(**trigger).foreachBatch(self._deliver(target)).start()
        self._known.set()
        return self.query

    def open(self) -> IngestJob:
        """Start; a micro-batch begins at most every ``max_request_delay``."""
        self._start(processingTime=f"{int(self.options.max_request_delay * 1000)} milliseconds")
        return self

    def run(self) -> None:
        """Deliver what the source holds now, then end."""
        self._start(availableNow=True).awaitTermination()

    def close(self, wait: bool = True) -> None:
        """Deliver everything that has arrived, then stop; ``wait=False`` is cancel.

        A waiting close raises what ended the query, so it returns only when every point taken is
        delivered, or given up under ``drop``.
        """
        if self.query is None:
            return
        try:
            if wait and self.query.isActive:
                self.query.processAllAvailable()
        finally:
            self.query.stop()
        if wait and (error := self.query.exception()):
            raise error

    def cancel(self) -> None:
        """Stop without draining; the checkpoint lets a later job take up the rest."""
        self.close(wait=False)

    def unflushed(self) -> int:
        """Points taken from the source whose delivery is not settled (C10); 0 after a drain."""
        return self._gauge.accepted - self._gauge.settled

    def __enter__(self) -> IngestJob:
        return self.open()

    def __exit__(self, kind, error, trace) -> None:
        self.close(wait=kind is None)
