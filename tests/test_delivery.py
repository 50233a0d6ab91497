"""Sinks, the ingest job and spool ingest (E1 to E10, F1 to F5, C3 live, C9, C10)."""

import os
import random
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from seriesloom.operators import packing, reports, segments
from seriesloom.operators.encoding import file_records
from seriesloom.sources import points as src
from seriesloom.sources import series_avro
from seriesloom.streaming import (
    DeliveryFailed,
    DualSink,
    FallbackSink,
    FileSink,
    IngestJob,
    IngestOptions,
    ListeningSink,
    LiveBatches,
    MissingCredential,
    SendSink,
    SpoolIngest,
    TableSink,
    batch_stream,
)
from seriesloom.streaming import sinks
from seriesloom.streaming.job import admitted
from seriesloom.streaming.sinks import summarise

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # senders run on workers


def points_of(spark, n, channel="c"):
    df = spark.range(n).selectExpr("id", "cast(id as double) as v")
    return src.points_typed(df, "double", F.lit(channel), "id", "v")


def series_of(spark, n, cap, channel="timeout_double"):
    series = packing.pack_series(points_of(spark, n, channel), cap).withColumn("shard", F.lit(0))
    return packing.assign_requests(series, cap)


def broken(payload, meta):
    raise TimeoutError("no answer")


def no_token(payload, meta):
    raise MissingCredential("no token")


class Failing:
    def __init__(self, error):
        self.error = error

    def write(self, series, batch_id):
        raise self.error


class Recorder:
    def __init__(self, log, name):
        self.log, self.name = log, name

    def on_success(self, summary):
        self.log.append((self.name, "ok", summary["requests"], summary["points"]))

    def on_error(self, error, summary):
        self.log.append((self.name, type(error).__name__, summary["requests"], summary["points"]))


def logging_sender(folder):
    """Appends each call to a file, so that calls made on executors can be counted."""

    def send(payload, meta):
        with open(os.path.join(folder, meta["idempotency_key"]), "ab") as f:
            f.write(payload + b"\n")

    return send


def failing_first(folder, times):
    """Fails the first calls for every request, then takes it."""

    def send(payload, meta):
        path = os.path.join(folder, meta["idempotency_key"])
        with open(path, "ab") as f:
            f.write(b".")
        if os.path.getsize(path) <= times:
            raise ConnectionError("try again")

    return send


def test_e8_each_request_is_sent_once(spark, tmp_path):
    sink = SendSink(logging_sender(str(tmp_path)), {"dataset": "d"}, dispatchers=3)
    sink.write(series_of(spark, 12, 2), 5)
    assert sorted(os.listdir(tmp_path)) == [f"main-5-0-{i}" for i in range(6)]
    for name in os.listdir(tmp_path):
        lines = (tmp_path / name).read_bytes().splitlines()
        assert len(lines) == 1 and b'"timeout_double"' in lines[0]
    status = sink.status(spark)
    assert status.agg(F.sum("points"), F.sum("attempts")).first()[:] == (12, 6)


def test_e7_retry_fixture(spark, tmp_path):
    """12 points, capacity 4, two failures each: all are delivered with two retries."""
    sink = SendSink(failing_first(str(tmp_path), 2), retries=2, backoff=0.0)
    sink.write(series_of(spark, 12, 4, "networked_double"), 0)
    rows = sink.status(spark).collect()
    assert [(r.ok, r.attempts, r.points) for r in rows] == [(True, 3, 4)] * 3


def test_e7_retries_are_bounded(spark):
    sink = SendSink(broken, retries=2, backoff=0.0)
    with pytest.raises(DeliveryFailed, match="3 requests"):
        sink.write(series_of(spark, 12, 4), 0)
    assert {r.attempts for r in sink.status(spark).collect()} == {3}


def test_e2_fallback_fixture(spark, tmp_path):
    """Primary always fails: 6 requests with 12 points reach the fallback."""
    fallback = TableSink(str(tmp_path / "fb"))
    FallbackSink(SendSink(broken, retries=0), fallback).write(series_of(spark, 12, 2), 0)
    sizes = reports.request_sizes(fallback.read(spark)).collect()
    assert [r.n_points for r in sizes] == [2] * 6
    assert reports.total_double_points(packing.unpack_series(fallback.read(spark)), "timeout_double").first().n == 12


def test_e2_only_failed_requests_fall_back(spark, tmp_path):
    def odd_fails(payload, meta):
        if int(meta["idempotency_key"].split("-")[-1]) % 2:
            raise ValueError("odd")

    fallback = TableSink(str(tmp_path / "fb"))
    FallbackSink(SendSink(odd_fails, retries=0), fallback).write(series_of(spark, 12, 2), 0)
    assert sorted(r.request_id for r in fallback.read(spark).collect()) == [1, 3, 5]


def test_e2_missing_credential_is_reported_after_the_fallback(spark, tmp_path):
    for i, primary in enumerate((SendSink(no_token, retries=5), Failing(MissingCredential("no token")))):
        fallback = TableSink(str(tmp_path / f"fb{i}"))
        with pytest.raises(MissingCredential):
            FallbackSink(primary, fallback).write(series_of(spark, 12, 2), 0)
        assert fallback.read(spark).count() == 6
    assert {r.attempts for r in SendSinkStatus(spark)} == {1}


def SendSinkStatus(spark):
    sink = SendSink(no_token, retries=5)
    with pytest.raises(DeliveryFailed):
        sink.write(series_of(spark, 4, 2), 0)
    return sink.status(spark).collect()


def test_e2_other_failures_pass_everything_on(spark, tmp_path):
    fallback = TableSink(str(tmp_path / "fb"))
    FallbackSink(Failing(OSError("disk")), fallback).write(series_of(spark, 12, 2), 0)
    assert fallback.read(spark).count() == 6
    with pytest.raises(ValueError, match="second"):
        FallbackSink(Failing(OSError("disk")), Failing(ValueError("second"))).write(series_of(spark, 4, 2), 0)


def test_e3_dual_write_tries_both(spark, tmp_path):
    good = TableSink(str(tmp_path / "t"))
    with pytest.raises(OSError, match="first"):
        DualSink(Failing(OSError("first")), good).write(series_of(spark, 12, 2), 0)
    assert good.read(spark).count() == 6
    with pytest.raises(OSError, match="second"):
        DualSink(good, Failing(OSError("second"))).write(series_of(spark, 12, 2), 0)
    with pytest.raises(OSError, match="first"):
        DualSink(Failing(OSError("first")), Failing(OSError("second"))).write(series_of(spark, 4, 2), 0)


def test_e4_listeners_in_order(spark, tmp_path):
    log = []
    both = [Recorder(log, "a"), Recorder(log, "b")]
    ListeningSink(TableSink(str(tmp_path / "t")), both).write(series_of(spark, 12, 2), 0)
    with pytest.raises(OSError):
        ListeningSink(Failing(OSError("x")), both).write(series_of(spark, 12, 2), 0)
    assert log == [("a", "ok", 6, 12), ("b", "ok", 6, 12), ("a", "OSError", 6, 12), ("b", "OSError", 6, 12)]


def test_e1_repeated_batch_replaces_itself(spark, tmp_path):
    for sink in (TableSink(str(tmp_path / "t")), FileSink(str(tmp_path / "f"))):
        for batch in (0, 1, 1):
            sink.write(series_of(spark, 12, 2), batch)
        assert sink.read(spark).agg(F.sum(F.size("timestamps"))).first()[0] == 24


# -- the job -------------------------------------------------------------------------------


def add_file(spark, folder, first, n):
    df = spark.range(first, first + n).selectExpr("id", "concat('c', id % 3) as ch", "cast(id as double) as v")
    df.coalesce(1).write.mode("append").parquet(folder)


def live(spark, folder, options=IngestOptions()):
    reader = spark.readStream.schema("id bigint, ch string, v double")
    return src.points_typed(admitted(reader, options).parquet(folder), "double", "ch", "id", "v", None, "id")


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "in")
    for i in range(6):
        add_file(spark, path, i * 100, 100)
    return path


def test_b17_f3_stream_equals_batch(spark, folder, tmp_path):
    table = TableSink(str(tmp_path / "out"))
    job = IngestJob(live(spark, folder), str(tmp_path / "cp")).to_file(table)
    job.run()
    static = src.points_typed(spark.read.parquet(folder), "double", "ch", "id", "v", None, "id")
    got = packing.unpack_series(table.read(spark)).select("channel", "ts_ns", "kind", "v_double")
    assert got.exceptAll(static.select(*got.columns)).isEmpty() and got.count() == 600
    # six files, four admitted per micro-batch
    assert {r.batch_id for r in table.read(spark).select("batch_id").collect()} == {0, 1}
    assert job.unflushed() == 0


def test_f2_f3_context_manager_drains(spark, folder, tmp_path):
    table = TableSink(str(tmp_path / "out"))
    job = IngestJob(live(spark, folder), str(tmp_path / "cp")).to_file(table)
    with job:
        assert job.is_open
        with pytest.raises(RuntimeError, match="already open"):
            job.open()
        add_file(spark, folder, 600, 50)
    assert not job.is_open
    assert table.read(spark).agg(F.sum("n")).first()[0] == 650
    assert job.unflushed() == 0  # C10


def test_f5_points_of_unequal_files_are_bounded(spark, tmp_path):
    """Files of very different size: no micro-batch takes more points than asked for, unless one file has more."""
    folder, sizes = str(tmp_path / "in"), [900, 20, 500, 40, 40, 700, 30, 2_000, 100]
    for i, n in enumerate(sizes):
        add_file(spark, folder, i * 10_000, n)
        time.sleep(0.02)
    schema, points = "id bigint, ch string, v double", lambda df: src.points_typed(df, "double", "ch", "id", "v", None, "id")
    table, options = TableSink(str(tmp_path / "out")), IngestOptions(max_points_in_flight=1_500)
    job = IngestJob.from_files(spark, folder, schema, points, str(tmp_path / "cp"), options).to_file(table)
    job.run()
    taken = [p["numInputRows"] for p in job.query.recentProgress if p["numInputRows"]]
    assert sum(taken) == sum(sizes) and all(n <= 1_500 or n == 2_000 for n in taken) and max(sorted(taken)[:-1]) > 500
    assert table.read(spark).agg(F.sum("n")).first()[0] == sum(sizes) and job.unflushed() == 0
    # an empty folder has no density: files are admitted by number until the job is defined anew
    os.makedirs(tmp_path / "none")
    IngestJob.from_files(spark, str(tmp_path / "none"), schema, points, str(tmp_path / "cp2"), options).to_file(table).run()


def test_e10_observed_figures_equal_counted_ones(spark, tmp_path, monkeypatch):
    """The sink's own job tells requests and points; a sink that reads nothing has them counted."""
    monkeypatch.setattr(sinks, "OBSERVED_S", 2.0)
    series = packing.pack_series(src.union_points(*[points_of(spark, n, f"c{n}") for n in (10, 25, 3, 40)]), 8)
    series = packing.assign_requests(packing.with_shard(series, 3), 16).persist()
    for sink, quick in ((TableSink(str(tmp_path / "t")), True), (Recorder([], "x"), False)):
        if not quick:
            sink = type("Idle", (), {"write": lambda self, rows, batch_id: None})()
        log = []
        ListeningSink(sink, [type("L", (), {"on_success": lambda self, summary: log.append(summary)})()], 3).write(series, 4)
        want = summarise(series, 4)
        assert [{k: v for k, v in s.items() if k != "millis"} for s in log] == [want] and want["points"] == 78


def test_f4_cancel_then_resume(spark, folder, tmp_path):
    table = TableSink(str(tmp_path / "out"))
    options = IngestOptions(max_buffered_requests=1)
    job = IngestJob(live(spark, folder, options), str(tmp_path / "cp"), options).to_file(table).open()
    deadline = time.time() + 60
    while not os.path.exists(tmp_path / "out") and time.time() < deadline:
        time.sleep(0.05)
    job.cancel()
    assert not job.is_open
    IngestJob(live(spark, folder, options), str(tmp_path / "cp"), options).to_file(table).run()
    assert table.read(spark).agg(F.sum("n")).first()[0] == 600


def test_c9_an_empty_source_sends_nothing(spark, tmp_path):
    folder = str(tmp_path / "empty")
    os.makedirs(folder)
    log = []
    job = IngestJob(live(spark, folder), str(tmp_path / "cp")).to_file(TableSink(str(tmp_path / "out")))
    job.add_listener(Recorder(log, "a"))
    job.run()
    assert log == [] and not os.path.exists(tmp_path / "out")


def test_e6_policies(spark, folder, tmp_path):
    log = []
    job = IngestJob(live(spark, folder), str(tmp_path / "cp1"), on_failure="drop").to_file(Failing(OSError("x")))
    job.add_listener(Recorder(log, "a")).run()
    assert [entry[1] for entry in log] == ["OSError", "OSError"] and job.unflushed() == 0
    table = TableSink(str(tmp_path / "out"))
    with pytest.raises(Exception, match="disk is full"):
        IngestJob(live(spark, folder), str(tmp_path / "cp2")).to_file(Failing(OSError("disk is full"))).run()
    IngestJob(live(spark, folder), str(tmp_path / "cp2")).to_file(table).run()  # repeated from the checkpoint
    assert table.read(spark).agg(F.sum("n")).first()[0] == 600


def test_f1_targets(spark, folder, tmp_path):
    job = lambda: IngestJob(live(spark, folder), str(tmp_path / "cp"))
    sink = lambda j: j.sink().sink
    file = str(tmp_path / "f")
    assert isinstance(sink(job().to_remote(broken)), SendSink)
    assert isinstance(sink(job().to_file(file)), FileSink)
    assert isinstance(sink(job().to_remote(broken).to_file(file)), DualSink)
    for j in (job().to_remote(broken), job().to_file(file)):
        assert isinstance(sink(j.with_file_fallback(file)), FallbackSink)
    with pytest.raises(ValueError, match="needs a remote or a file"):
        job().sink()
    with pytest.raises(ValueError, match="needs a remote or a file"):
        job().with_file_fallback(file).sink()
    with pytest.raises(ValueError, match="choose one"):
        job().to_remote(broken).to_file(file).with_file_fallback(file).sink()
    with pytest.raises(TypeError, match="points need"):
        IngestJob(spark.range(3), "cp")


def test_f1_remote_with_file_fallback_end_to_end(spark, folder, tmp_path):
    job = IngestJob(live(spark, folder), str(tmp_path / "cp")).to_remote(broken, retries=0)
    job.with_file_fallback(str(tmp_path / "fb"), "ds").with_options(max_points_per_record=50).run()
    files = series_avro.read_series(spark, str(tmp_path / "fb"))
    assert reports.file_point_total(files).first().total == 600
    assert files.agg(F.max(F.size("timestamps")), F.min("dataset_id")).first()[:] == (50, "ds")


def fold(arrivals, cap, delay):
    last, waiting, batch, out = arrivals[0], 0, 0, []
    for a in arrivals:
        out.append(batch)
        waiting += 1
        if waiting >= cap or (delay is not None and a > last + delay):
            last, waiting, batch = a, 0, batch + 1
    return out


LIVE = "channel string, tags_key string, seq bigint, arrival_ns bigint"


def add_arrivals(spark, folder, rows):
    time.sleep(0.02)  # files are admitted in the order of their times
    spark.createDataFrame(rows, LIVE).coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("per_cell", [10**6, 2])
def test_c2_c3_live_batches_continue_across_micro_batches(spark, tmp_path, monkeypatch, per_cell):
    monkeypatch.setattr(segments, "_SEGMENTS_PER_CELL", 0)
    arrivals = [0, 101, 202, 203, 204, 205, 500, 501, 502, 503]
    for i in range(0, len(arrivals), 3):
        add_arrivals(spark, str(tmp_path / "in"), [("c", "", i + k, a) for k, a in enumerate(arrivals[i : i + 3])])
    for name, delay, want in (("d", 100, [0, 0, 1, 1, 1, 2, 2, 3, 3, 3]), ("n", None, [0, 0, 0, 0, 1, 1, 1, 1, 2, 2])):
        stream = spark.readStream.schema(LIVE).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        out = str(tmp_path / name)
        query = batch_stream(stream, out, str(tmp_path / f"cp{name}"), 4, delay, rows_per_cell=per_cell)
        query.trigger(availableNow=True).start().awaitTermination()
        got = LiveBatches(out, 4).read(spark).orderBy("seq").collect()
        assert [r.batch for r in got] == fold(arrivals, 4, delay), name


def test_c3_live_batches_of_a_hot_channel_in_many_tasks(spark, tmp_path, monkeypatch):
    """One channel has nearly all points of each micro-batch, out of order; others are silent at times."""
    monkeypatch.setattr(segments, "_SEGMENTS_PER_CELL", 0)
    monkeypatch.setattr(segments, "FAN", 4)
    rnd = random.Random(5)
    arrivals = sorted(rnd.randrange(3_000) for _ in range(3_000))
    rows = [("hot", "", i, a) for i, a in enumerate(arrivals)] + [("b", "", 0, 7), (None, "", 1, 8), ("b", "", 2, 2_900)]
    live = LiveBatches(str(tmp_path / "out"), 5, 2, rows_per_cell=60)
    batch = lambda lo, hi: spark.createDataFrame(rnd.sample(part := [r for r in rows if lo <= r[3] < hi], len(part)), LIVE)
    for number, (lo, hi) in enumerate([(0, 1), (1, 1_000), (1_000, 2_500), (2_500, 3_000)]):
        live.write(batch(lo, hi), number)
        if number == 2:
            before = sorted(map(str, live.read(spark).collect()))
            live.write(batch(lo, hi), number)  # a repeated micro-batch gives the same numbers
            assert sorted(map(str, live.read(spark).collect())) == before
    got = {(r.channel, r.seq): r.batch for r in live.read(spark).collect()}
    assert len(got) == len(rows)
    assert [got["hot", i] for i in range(3_000)] == fold(arrivals, 5, 2)
    assert (got["b", 0], got[None, 1], got["b", 2]) == (0, 0, 0)
    state = {r.channel: (r._x, r._y, r._first) for r in live.state(spark, 4).collect()}
    assert state[None] == (8, 1, 0) and state["b"] == (2_900, 0, 1) and len(state) == 3
    with pytest.raises(Exception, match="state before micro-batch 2 is missing"):
        live.write(batch(1_000, 2_500), 2)  # its state was replaced long ago


def test_e9_spool(spark, tmp_path):
    spool, table = str(tmp_path / "spool"), TableSink(str(tmp_path / "table"))
    os.makedirs(spool)
    for i in range(3):
        series_avro.write_series(packing.pack_series(points_of(spark, 10, f"c{i}")), str(tmp_path / "w" / str(i)))
        for f in os.listdir(tmp_path / "w" / str(i)):
            if f.endswith(".avro"):
                os.rename(tmp_path / "w" / str(i) / f, os.path.join(spool, f))
    bad = os.path.join(spool, "bad.avro")
    good = open(os.path.join(spool, os.listdir(spool)[0]), "rb").read()
    with open(bad, "wb") as f:
        f.write(good[:-5])
    ingest = SpoolIngest(spool, table, str(tmp_path / "cp"))
    ingest.run(spark)
    assert table.read(spark).agg(F.sum("n")).first()[0] == 30
    assert os.listdir(spool) == ["bad.avro"]  # kept: it could not be read
    assert [r.path.endswith("bad.avro") for r in ingest.errors(spark).collect()] == [True]
    series_avro.write_series(packing.pack_series(points_of(spark, 7, "late")), str(tmp_path / "w" / "late"))
    for f in os.listdir(tmp_path / "w" / "late"):
        if f.endswith(".avro"):
            os.rename(tmp_path / "w" / "late" / f, os.path.join(spool, f))
    ingest.run(spark)
    assert table.read(spark).agg(F.sum("n")).first()[0] == 37


def test_e9_large_files_are_decoded_in_splits(spark, tmp_path):
    """One file in many splits: its series arrive once, and a bad block in its midst keeps all of it out."""
    spool, table = str(tmp_path / "spool"), TableSink(str(tmp_path / "table"))
    os.makedirs(spool)
    rows = src.points_typed(
        spark.range(20_000).selectExpr("concat('c', id % 40) as c", "id", "cast(hash(id) as double) as v"), "double", F.col("c"), "id", "v"
    )
    series_avro.register(spark)
    packed = packing.pack_series(rows, 100)
    write = file_records(packed.coalesce(1)).write.format(series_avro.FORMAT).mode("append")
    write.option("blockBytes", 4_000).save(str(tmp_path / "w"))
    (name,) = [f for f in os.listdir(tmp_path / "w") if f.endswith(".avro")]
    data = (tmp_path / "w" / name).read_bytes()
    middle = len(data) // 2
    with open(os.path.join(spool, "bad.avro"), "wb") as f:
        f.write(data[:middle] + bytes(40) + data[middle + 40 :])
    with open(os.path.join(spool, "good.avro"), "wb") as f:
        f.write(data)
    ingest = SpoolIngest(spool, table, str(tmp_path / "cp"), split_bytes=20_000)
    listed = spark.read.format("binaryFile").load(f"{spool}/good.avro").select("path", "length")
    splits = sorted((r.start, r.stop) for r in ingest.splits(listed).collect())
    assert len(splits) >= 8 and splits[0][0] == 0 and splits[-1][1] == len(data)
    assert all(a[1] == b[0] for a, b in zip(splits, splits[1:]))
    ingest.run(spark)
    assert os.listdir(spool) == ["bad.avro"]
    assert [r.path.endswith("bad.avro") for r in ingest.errors(spark).collect()] == [True]

    def sums(df):
        point = F.explode(F.arrays_zip("timestamps", "values"))
        flat = df.select("channel", point.alias("p")).select("channel", "p.timestamps", "p.values.d")
        return sorted(flat.groupBy("channel").agg(F.count("*"), F.sum("timestamps"), F.sum("d")).collect())

    assert sums(table.read(spark)) == sums(series_avro.read_series(spark, str(tmp_path / "w")))
    assert set(table.read(spark).columns) == {"channel", "tags", "timestamps", "values", "dataset_id", "file", "n", "stream_id", "batch_id"}
    assert not os.listdir(tmp_path / "table" / "_staging" / os.listdir(tmp_path / "table" / "_staging")[0])


@pytest.mark.parametrize("damage", ["empty", "header", "short", "all"])
def test_e9_bad_files_stay(spark, tmp_path, damage):
    spool, table = str(tmp_path / "spool"), TableSink(str(tmp_path / "table"))
    series_avro.write_series(packing.pack_series(points_of(spark, 10)).coalesce(1), spool)
    (name,) = [f for f in os.listdir(spool) if f.endswith(".avro")]
    data = open(os.path.join(spool, name), "rb").read()
    broken = {"empty": b"", "header": data[:20], "short": data[:-3], "all": b"no container"}[damage]
    with open(os.path.join(spool, "bad.avro"), "wb") as f:
        f.write(broken)
    if damage == "all":  # and no sound file beside it
        os.rename(os.path.join(spool, name), str(tmp_path / "kept"))
    ingest = SpoolIngest(spool, table, str(tmp_path / "cp"))
    ingest.run(spark)
    assert table.read(spark).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] == (0 if damage == "all" else 10)
    assert [f for f in os.listdir(spool) if f.endswith(".avro")] == ["bad.avro"]
    # a file of no bytes is not listed at all
    assert ingest.errors(spark).count() == (0 if damage == "empty" else 1)


def test_e9_repeated_batch_does_not_lose_or_double(spark, tmp_path):
    spool, table = str(tmp_path / "spool"), TableSink(str(tmp_path / "table"))
    series_avro.write_series(packing.pack_series(points_of(spark, 10)), spool)
    files = [os.path.join(spool, f) for f in os.listdir(spool) if f.endswith(".avro")]
    paths = spark.createDataFrame([(f, os.path.getsize(f)) for f in files], "path string, length bigint")
    ingest = SpoolIngest(spool, table, str(tmp_path / "cp"), errors_path=str(tmp_path / "checks"))
    ingest._ingest(paths, 0)
    ingest._ingest(paths, 0)  # as after a failure between the deletion and the commit
    assert table.read(spark).agg(F.sum("n")).first()[0] == 10


def test_two_jobs_do_not_share_folders(spark, tmp_path):
    """Each job has a batch 0; the second one must not replace what the first delivered."""
    table, files = TableSink(str(tmp_path / "table")), FileSink(str(tmp_path / "files"))
    for number, rows in enumerate((100, 10)):
        source = str(tmp_path / f"source-{number}")
        points_of(spark, rows).write.parquet(source)
        live = spark.readStream.schema(points_of(spark, 1).schema).parquet(source)
        job = IngestJob(live, str(tmp_path / f"job-{number}")).to_file(table)
        job.run()
        live = spark.readStream.schema(points_of(spark, 1).schema).parquet(source)
        IngestJob(live, str(tmp_path / f"files-{number}")).to_file(files).run()
    assert table.read(spark).agg(F.sum("n")).first()[0] == 110
    assert files.read(spark).agg(F.sum(F.size("timestamps"))).first()[0] == 110


class _Refusing:
    def write(self, series, batch_id):
        raise OSError("disk is gone")


def test_close_tells_what_ended_the_query(spark, tmp_path):
    source = str(tmp_path / "source")
    points_of(spark, 10).write.parquet(source)
    live = spark.readStream.schema(points_of(spark, 1).schema).parquet(source)
    job = IngestJob(live, str(tmp_path / "job")).to_file(_Refusing())
    with pytest.raises(Exception, match="disk is gone"):
        with job:
            time.sleep(0.5)
    assert job.unflushed() == 10
