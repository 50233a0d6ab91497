"""Registered queries that deliver whole tables through the streaming job and the sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesloom.operators import packing, reports
from seriesloom.plans import tables as t
from seriesloom.session import scratch_dir
from seriesloom.sources import points as src
from seriesloom.sources import series_avro
from seriesloom.streaming import (
    DualSink,
    FallbackSink,
    FileSink,
    IngestJob,
    IngestOptions,
    LiveBatches,
    SendSink,
    SpoolIngest,
    TableSink,
    batch_stream,
    read_outcomes,
    send_stream,
)
from seriesloom.streaming.sinks import delivery_stats as stats_of

CAPACITY = 50
BATCH = 4


def _live_events(spark, sf):
    """The events table as a file stream, normalised by the same function as in batch."""
    schema = t.table(spark, sf, "events").schema
    # as a pattern, the path may be one file or a folder of part files
    rows = spark.readStream.schema(schema).parquet(f"{sf}/[e]vents.parquet")
    return src.points_from_rows(
        rows, t.named("ev.", "event_type"), "ts", "value", {"user_id": F.col("user_id")}, "event_id"
    )


def stream_equals_batch(spark, sf):
    """All events through a streaming job into a table, counted there."""
    table = TableSink(scratch_dir(spark, "delivered"))
    IngestJob(_live_events(spark, sf), scratch_dir(spark, "job")).to_file(table).run()
    return reports.series_counts_by_channel(table.read(spark))


def batch_stream_q(spark, sf):
    """Live count- and delay-bounded batches, state carried per channel."""
    points = _live_events(spark, sf).select("channel", "tags_key", "seq", F.col("ts_ns").alias("arrival_ns"))
    out = scratch_dir(spark, "batches")
    numbered = batch_stream(points, out, scratch_dir(spark, "state"), BATCH, t.DAY_NS)
    numbered.trigger(availableNow=True).start().awaitTermination()
    return LiveBatches(out, BATCH).read(spark).groupBy("channel", "tags_key", "batch").agg(F.count(F.lit(1)).alias("n"))


def _requests(spark, sf):
    """Event series in requests, one request sequence per channel."""
    return packing.requests_from_points(t.ev(spark, sf), F.col("channel"), BATCH, CAPACITY, kinds=("double",))


def _refuse_clicks(payload: bytes, meta: dict) -> None:
    if b'"channel":"ev.click"' in payload:
        raise TimeoutError("the receiver does not answer")


def fallback_route(spark, sf):
    """A receiver that never takes clicks: their requests end up in the fallback table."""
    fallback = TableSink(scratch_dir(spark, "fallback"))
    remote = SendSink(_refuse_clicks, retries=1, backoff=0.0, status_path=scratch_dir(spark, "sent"))
    requests = _requests(spark, sf).persist()
    FallbackSink(remote, fallback).write(requests, 0)
    requests.unpersist()
    sent = remote.status(spark).where("ok").groupBy(F.col("shard").alias("channel")).agg(
        F.count(F.lit(1)).alias("requests"), F.sum("points").alias("n")
    )
    kept = fallback.read(spark).groupBy("channel").agg(
        F.count_distinct("request_id").alias("requests"), F.sum("n").alias("n")
    )
    return sent.select(F.lit("primary").alias("sink"), "channel", "requests", "n").unionByName(
        kept.select(F.lit("fallback").alias("sink"), "channel", "requests", "n")
    )


def _accept(payload: bytes, meta: dict) -> None:
    if not payload or not meta["idempotency_key"]:
        raise ValueError("an empty request")


def streamed_requests(spark, sf):
    """Every vector is a request of its own, sent by the streaming writer; outcomes of the committed epochs."""
    schema = t.table(spark, sf, "embeddings").schema
    vectors = spark.readStream.schema(schema).parquet(f"{sf}/[e]mbeddings.parquet")
    checkpoint, outcomes = scratch_dir(spark, "sender"), scratch_dir(spark, "outcomes")
    sent = send_stream(
        vectors, _accept, checkpoint, t.named("emb.", "label"), F.to_json(F.struct("vec_id", "embedding")),
        F.size("embedding"), outcomes=outcomes,
    )
    sent.trigger(availableNow=True).start().awaitTermination()
    return read_outcomes(spark, outcomes).groupBy("channel", "ok").agg(
        F.count(F.lit(1)).alias("requests"), F.count_distinct("request_key").alias("keys"), F.sum("points").alias("n")
    )


def dual_write(spark, sf):
    """The same series in a table and in containers."""
    table, files = TableSink(scratch_dir(spark, "table")), FileSink(scratch_dir(spark, "files"))
    requests = _requests(spark, sf).persist()
    DualSink(table, files).write(requests, 0)
    requests.unpersist()
    counted = lambda df, name: df.groupBy("channel").agg(
        F.sum(F.size("timestamps")).alias("n")
    ).select(F.lit(name).alias("sink"), "channel", "n")
    return counted(table.read(spark), "table").unionByName(counted(files.read(spark), "files"))


def spool_ingest(spark, sf):
    """Containers of every kind picked up from a spool folder."""
    spool = scratch_dir(spark, "spool")
    series_avro.write_series(packing.pack_series(t.all_kinds(spark, sf)), spool)
    table = TableSink(scratch_dir(spark, "dataset"))
    SpoolIngest(spool, table, scratch_dir(spark, "spool-state")).run(spark)
    return table.read(spark).groupBy("channel").agg(F.sum("n").alias("n"))


def delivery_stats(spark, sf):
    """Requests and points of every batch that a job delivered."""
    table = TableSink(scratch_dir(spark, "delivered"))
    options = IngestOptions(max_points_per_record=CAPACITY, request_dispatcher_tasks=1)
    IngestJob(_live_events(spark, sf), scratch_dir(spark, "job"), options).to_file(table).run()
    return stats_of(table.read(spark)).select(F.col("batch_id").cast("bigint").alias("batch"), "requests", "points")


def admitted_points(spark, sf):
    """Events in files of unequal size, a bounded number of points per micro-batch; channels and whether the bound held."""
    folder = scratch_dir(spark, "unequal")
    events = t.table(spark, sf, "events")
    # eight small files and four large ones; the bound is half of all rows
    groups = events.withColumn("part", F.when(F.col("event_id") % 7 < 2, F.col("event_id") % 8).otherwise(8 + F.col("event_id") % 4))
    groups.repartition("part").write.partitionBy("part").parquet(folder)
    bound = max(1, events.count() // 2)
    options = IngestOptions(max_points_in_flight=bound)
    table = TableSink(scratch_dir(spark, "delivered"))

    def to_points(rows):
        return src.points_from_rows(rows, t.named("ev.", "event_type"), "ts", "value", {"user_id": F.col("user_id")}, "event_id")

    job = IngestJob.from_files(spark, folder, groups.schema, to_points, scratch_dir(spark, "job"), options).to_file(table)
    job.run()
    taken = [p["numInputRows"] for p in job.query.recentProgress if p["numInputRows"]]
    counts = reports.series_counts_by_channel(table.read(spark))
    return counts.withColumn("bounded", F.lit(bool(taken) and max(taken) <= bound and len(taken) > 1))


DELIVERY_QUERIES = {
    "admitted_points": admitted_points,
    "stream_equals_batch": stream_equals_batch,
    "batch_stream": batch_stream_q,
    "fallback_route": fallback_route,
    "streamed_requests": streamed_requests,
    "dual_write": dual_write,
    "spool_ingest": spool_ingest,
    "delivery_stats": delivery_stats,
}
