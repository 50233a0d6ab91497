"""Rows sent by the streaming writer, outcomes by epoch."""

import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from seriesloom.streaming import read_outcomes, send_stream
from seriesloom.streaming.sender import OutcomeWriter, Sent, outcomes_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # senders run on workers


def _keeping(folder, refused=None, gate=None):
    """Notes what it is sent; refuses one payload while the gate file is not there."""

    def send(payload, meta):
        row = json.loads(payload)
        with open(os.path.join(folder, f"{os.getpid()}.txt"), "a") as f:
            f.write(f"{meta['idempotency_key']} {row['id']}\n")
        if row["id"] == refused and not (gate and os.path.exists(gate)):
            raise OSError("refused")

    return send


def _sent(folder):
    return sorted(tuple(line.split()) for f in os.listdir(folder) for line in open(os.path.join(folder, f)))


def _stream(spark, tmp_path, n=30, files=3):
    source = str(tmp_path / "source")
    if not os.path.exists(source):
        spark.range(n).selectExpr("id", "concat('c', id % 3) as name").repartition(files).write.parquet(source)
    return spark.readStream.schema("id long, name string").option("maxFilesPerTrigger", 1).parquet(source)


def _start(rows, send, tmp_path, **more):
    args = dict(channel=F.col("name"), payload=F.to_json(F.struct("id")), points=F.lit(2), backoff=0.0, **more)
    writer = send_stream(rows, send, str(tmp_path / "cp"), **args)
    return writer.trigger(availableNow=True).start()


def _folder(tmp_path):
    folder = str(tmp_path / "sent")
    os.makedirs(folder, exist_ok=True)
    return folder


def test_every_row_is_sent_and_listed_by_epoch(spark, tmp_path):
    folder = _folder(tmp_path)
    _start(_stream(spark, tmp_path), _keeping(folder), tmp_path, dispatchers=2).awaitTermination()
    sent = _sent(folder)
    assert sorted(int(i) for _, i in sent) == list(range(30)) and len({k for k, _ in sent}) == 30
    found = read_outcomes(spark, outcomes_path(str(tmp_path / "cp")))
    assert sorted(r.request_key for r in found.collect()) == sorted(k for k, _ in sent)
    assert found.where("ok and attempts = 1 and points = 2").count() == 30
    assert found.select("epoch").distinct().count() == 3
    assert not os.listdir(tmp_path / "cp-outcomes" / "_staging")


def test_a_repeated_epoch_sends_under_the_same_keys(spark, tmp_path):
    folder, gate = _folder(tmp_path), str(tmp_path / "open")
    send = _keeping(folder, refused=7, gate=gate)
    with pytest.raises(Exception, match="rows were not sent"):
        _start(_stream(spark, tmp_path, files=1), send, tmp_path, retries=1).awaitTermination()
    first = _sent(folder)
    assert len({i for _, i in first}) == 30 and sum(i == "7" for _, i in first) == 2
    assert not [d for d in os.listdir(tmp_path / "cp-outcomes") if d.startswith("epoch=")]
    open(gate, "w").close()
    _start(_stream(spark, tmp_path), send, tmp_path).awaitTermination()
    assert set(_sent(folder)) == set(first)
    found = read_outcomes(spark, outcomes_path(str(tmp_path / "cp")))
    assert found.count() == 30 and found.where("not ok").count() == 0


def test_dropped_rows_are_listed(spark, tmp_path):
    send = _keeping(_folder(tmp_path), refused=7)
    _start(_stream(spark, tmp_path), send, tmp_path, retries=2, on_failure="drop").awaitTermination()
    found = read_outcomes(spark, outcomes_path(str(tmp_path / "cp")))
    assert found.count() == 30
    (bad,) = found.where("not ok").collect()
    assert (bad.attempts, bad.error, bad.credentials) == (3, "OSError: refused", False)


def test_null_payload_and_policy_are_refused(spark, tmp_path):
    rows = _stream(spark, tmp_path, n=3)
    with pytest.raises(ValueError, match="fail or drop"):
        _start(rows, _keeping(_folder(tmp_path)), tmp_path, on_failure="ignore")
    writer = send_stream(rows, _keeping(_folder(tmp_path)), str(tmp_path / "cp"), F.col("name"), F.lit(None).cast("string"), F.lit(1))
    with pytest.raises(Exception, match="without payload"):
        writer.trigger(availableNow=True).start().awaitTermination()


def test_commit_replaces_an_unfinished_one(tmp_path):
    path = str(tmp_path / "out")
    staging = tmp_path / "out" / "_staging"
    staging.mkdir(parents=True)
    (tmp_path / "out" / "epoch=4").mkdir()
    (tmp_path / "out" / "epoch=4" / "old.parquet").write_text("left over")
    for name in ("a", "b", "lost"):
        (staging / name).write_text(name)
    writer = OutcomeWriter(path, None, True)
    writer.commit([Sent("a"), Sent(""), None, Sent("b")], 4)
    assert sorted(os.listdir(tmp_path / "out" / "epoch=4")) == ["a", "b"] and not os.listdir(staging)
    (staging / "c").write_text("c")
    writer.abort([Sent("c")], 5)
    assert not os.listdir(staging) and not (tmp_path / "out" / "epoch=5").exists()
