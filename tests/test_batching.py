"""Batches and requests against plain folds, with and without hot keys."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import packing, segments
from seriesloom.operators.packing import batch_by_count
from seriesloom.operators.spread import hot_cuts, rank_in_key, split_hot_keys
from seriesloom.sources import points as src


def delay_fold(arrivals, max_points, delay):
    last, waiting, batch, out = arrivals[0], 0, 0, []
    for a in arrivals:
        out.append(batch)
        waiting += 1
        if waiting >= max_points or a > last + delay:
            last, waiting, batch = a, 0, batch + 1
    return out


def fit_fold(sizes, capacity):
    filled, request, out = 0, 0, []
    for n in sizes:
        if filled == 0 or filled + n <= capacity:
            filled += n
        else:
            filled, request = n, request + 1
        out.append(request)
    return out


def size_fold(sizes, max_points, max_bytes):
    points = filled = batch = 0
    out = []
    for n in sizes:
        if points and (points == max_points or filled + n > max_bytes):
            points, filled, batch = 0, 0, batch + 1
        points, filled = points + 1, filled + n
        out.append(batch)
    return out


@pytest.mark.parametrize("seed", range(300))
def test_rules_equal_folds_whole_and_in_cells(seed):
    rnd = random.Random(seed)
    length = rnd.randint(1, 60)
    if seed % 2:
        rows = np.sort(np.array([rnd.randint(0, rnd.choice([30, 300])) for _ in range(length)], dtype=np.int64))
        rule = segments.DelayRule(rnd.randint(1, 9), rnd.randint(0, 40))
        want = delay_fold(rows.tolist(), rule.max_points, rule.delay)
    elif seed % 4:
        rows = np.array([rnd.choice([1, 1, rnd.randint(1, 12), rnd.randint(1, 4)]) for _ in range(length)], dtype=np.int64)
        rule = segments.SizeRule(rnd.randint(1, 8), rnd.randint(1, 20))
        want = size_fold(rows.tolist(), rule.max_points, rule.max_bytes)
    else:
        rows = np.array([rnd.choice([0, 0, rnd.randint(0, 12), rnd.randint(0, 4)]) for _ in range(length)], dtype=np.int64)
        rule = segments.FitRule(rnd.randint(1, 10))
        want = fit_fold(rows.tolist(), rule.capacity)
    cuts = sorted(rnd.sample(range(1, length), min(length - 1, rnd.randint(0, 6)))) if length > 1 else []
    if seed % 2:  # cells are cut by arrival time, so equal times stay together
        cuts = [c for c in cuts if rows[c] != rows[c - 1]]
    state, first, got = rule.start(rows), 0, []
    whole = None  # all cells composed, as one function of the state that the key starts from
    for cell in np.split(rows, cuts):
        jump = rule.jumps(cell, np.full(len(cell), len(cell))).tolist()
        numbers, _, _ = segments.walk(rule, cell, jump, 0, state, first)
        got += numbers.tolist()
        summary, at = segments.Summariser(rule), 0
        while at < len(cell):  # batches of any size
            size = rnd.randint(1, 9)
            summary.feed(cell[at : at + size])
            at += size
        state, made = segments.step(rule, summary.result(), state)
        first += made
        whole = summary.result() if whole is None else segments.compose(rule, int(rows[0]), whole, summary.result())
        assert segments.step(rule, whole, rule.start(rows)) == (state, first)
    assert got == want


@pytest.fixture(scope="module")
def arrivals(spark):
    """One channel has most rows, in bursts; some channels have one row."""
    rnd = random.Random(7)
    rows, clock = [], 0
    for i in range(6000):
        clock += rnd.choice([0, 1, 1, 2, 40]) if (i // 500) % 2 else rnd.choice([1, 900])
        channel = "hot" if rnd.random() < 0.7 else f"c{rnd.randint(0, 400)}"
        rows.append((channel, f"t={rnd.randint(0, 1)}" if channel != "hot" else "", clock, i, rnd.choice([0, 1, 3, 9])))
    rnd.shuffle(rows)
    schema = "channel string, tags_key string, arrival_ns long, seq long, n long"
    return spark.createDataFrame(rows, schema).repartition(5), rows


def by_key(rows):
    keyed = {}
    for row in sorted(rows, key=lambda r: r[3]):
        keyed.setdefault((row[0], row[1]), []).append(row)
    return keyed


@pytest.mark.parametrize("per_cell", [10**6, 300, 3])
def test_c2_rank_and_count_batches(arrivals, per_cell):
    df, rows = arrivals
    want = {r[3]: i for group in by_key(rows).values() for i, r in enumerate(group)}
    ranked = rank_in_key(df, ["channel", "tags_key"], "seq", rows_per_cell=per_cell)
    assert {r.seq: r["rank"] for r in ranked.collect()} == want
    batched = batch_by_count(df, 7, per_cell)
    assert {r.seq: r.batch for r in batched.collect()} == {s: i // 7 for s, i in want.items()}


@pytest.mark.parametrize("per_cell, fan", [(10**6, 64), (300, 64), (20, 64), (20, 3)])
@pytest.mark.parametrize("max_points, delay", [(5, 10), (1000, 45), (3, 0), (1, 5)])
def test_c3_delay_batches(arrivals, monkeypatch, per_cell, fan, max_points, delay):
    df, rows = arrivals
    monkeypatch.setattr(segments, "FAN", fan)
    want = {}
    for group in by_key(rows).values():
        want.update(zip([r[3] for r in group], delay_fold([r[2] for r in group], max_points, delay)))
    monkeypatch.setattr(segments, "_SEGMENTS_PER_CELL", 0)
    got = segments.batch_by_delay(df, max_points, delay, rows_per_cell=per_cell)
    assert {r.seq: r.batch for r in got.collect()} == want
    assert got.columns == [*df.columns, "batch"]


@pytest.mark.parametrize("per_cell, fan", [(10**6, 64), (300, 64), (20, 64), (20, 3)])
@pytest.mark.parametrize("capacity", [1, 10, 250])
def test_c4_requests(arrivals, monkeypatch, per_cell, fan, capacity):
    df, rows = arrivals
    monkeypatch.setattr(segments, "FAN", fan)
    want = {}
    for group in by_key(rows).values():
        want.update(zip([r[3] for r in group], fit_fold([r[4] for r in group], capacity)))
    monkeypatch.setattr(segments, "_SEGMENTS_PER_CELL", 0)
    got = segments.pack_next_fit(df, ["channel", "tags_key"], ["seq"], "n", capacity, per_cell)
    assert {r.seq: r.request_id for r in got.collect()} == want


@pytest.mark.parametrize("per_cell, fan", [(10**6, 64), (20, 3)])
def test_c1_batches_bounded_by_points_and_bytes(spark, monkeypatch, per_cell, fan):
    """Wide values: no series of more than the bytes but single points; many narrow ones end by number."""
    monkeypatch.setattr(segments, "_SEGMENTS_PER_CELL", 0)
    monkeypatch.setattr(segments, "FAN", fan)
    rnd = random.Random(11)
    texts = [("x" * rnd.choice([0, 1, 5, 5, 90, 700, 2_000]), i) for i in range(600)]
    points = src.points_from_rows(spark.createDataFrame(texts, "v string, i long").repartition(4), F.lit("c"), "i", "v")
    series = packing.pack_series(points, 12, rows_per_cell=per_cell, max_bytes=1_000)
    want = size_fold([16 + len(v) for v, _ in texts], 12, 1_000)
    got = {ts: r.batch for r in series.select("batch", "timestamps").collect() for ts in r.timestamps}
    assert [got[i] for i in range(600)] == want
    sizes = series.select("n", packing.series_bytes().alias("bytes"), F.size("strings").alias("k")).collect()
    assert all(r.bytes <= 1_000 or r.n == 1 for r in sizes) and all(r.n == r.k <= 12 for r in sizes) and max(r.n for r in sizes) == 12
    blocks = packing.with_shard(series, 1)
    assigned = blocks.join(packing.request_blocks(blocks, 30, max_bytes=3_000), packing.BLOCK_KEY)
    requests = assigned.groupBy("request_id").agg(F.sum("n").alias("n"), F.sum(packing.series_bytes()).alias("bytes"), F.count("*").alias("k")).collect()
    assert all((r.n <= 30 and r.bytes <= 3_000) or r.k == 1 for r in requests) and max(r.k for r in requests) > 1


def test_c4_after_a_join_on_the_same_keys(spark, arrivals):
    """The join below may lose its partitioning at run time; numbering must not rely on it."""
    df, rows = arrivals
    facts = df.groupBy("channel", "tags_key").agg(F.count(F.lit(1)).alias("k"))
    joined = df.hint("merge").join(facts, ["channel", "tags_key"])
    got = segments.pack_next_fit(joined, ["channel", "tags_key"], ["seq"], "n", 10, 300)
    want = {}
    for group in by_key(rows).values():
        want.update(zip([r[3] for r in group], fit_fold([r[4] for r in group], 10)))
    assert {r.seq: r.request_id for r in got.collect()} == want


def test_fixture_time_flush(spark):
    """Points at 0, 101 and 202 ms with a delay of 100 ms give two batches."""
    df = spark.createDataFrame([("c", "", t * 10**6, i) for i, t in enumerate((0, 101, 202))],
                               "channel string, tags_key string, arrival_ns long, seq long")
    got = segments.batch_by_delay(df, 1000, 100 * 10**6).orderBy("seq").collect()
    assert [r.batch for r in got] == [0, 0, 1]


def test_fixture_writer_double(spark):
    df = spark.range(5000).select("id", (F.col("id") % 50).cast("double").alias("v"))
    points = src.points_from_rows(df, F.lit("channel_1"), "id", "v")
    sizes = batch_by_count(points, 1000, rows_per_cell=400).groupBy("batch").count().collect()
    assert sorted((r.batch, r["count"]) for r in sizes) == [(i, 1000) for i in range(5)]


def test_there_are_no_cuts_without_hot_keys(arrivals):
    df, _ = arrivals
    assert hot_cuts(df, ["channel"], ["seq"], 10**6).num_rows == 0
    assert hot_cuts(df, ["channel"], ["seq"], 1000).num_rows in (3, 4, 5)


def test_cuts_are_thinned_before_they_leave(arrivals, monkeypatch):
    """With room for few cuts, cells grow evenly; every hot key keeps some."""
    from seriesloom.operators import spread

    df, _ = arrivals
    whole = hot_cuts(df, ["channel"], ["seq"], 50)
    monkeypatch.setattr(spread, "MAX_CUTS", 10)
    thin = hot_cuts(df, ["channel"], ["seq"], 50)
    assert whole.num_rows > 60 and 5 <= thin.num_rows <= 10
    numbers = thin.column("seq").to_pylist()
    assert numbers == sorted(numbers)
    assert max(b - a for a, b in zip(numbers, numbers[1:], strict=False)) < 2 * 6000 / len(numbers)


@pytest.mark.parametrize("per_cell, fan", [(10**6, 64), (20, 3)])
def test_keys_go_on_from_carried_states(spark, monkeypatch, per_cell, fan):
    monkeypatch.setattr(segments, "_SEGMENTS_PER_CELL", 0)
    monkeypatch.setattr(segments, "FAN", fan)
    rnd = random.Random(3)
    times = sorted(rnd.randrange(900) for _ in range(400))
    df = spark.createDataFrame([(c, t, i) for c in ("a", None) for i, t in enumerate(times)] + [("new", 5, 0)], "k string, t long, seq long")
    rule = segments.DelayRule(7, 20)
    state, first = (int(times[150]), 3), 40
    states = spark.createDataFrame([(c, *state, first) for c in ("a", None)], "k string, _x long, _y long, _first long")
    late = df.where((F.col("seq") > 150) | (F.col("k") == "new"))
    got = segments.segment(late, ["k"], ["t", "seq"], "t", rule, "batch", per_cell, states)
    rows = np.array(times[151:])
    want = segments.walk(rule, rows, rule.jumps(rows, np.full(len(rows), len(rows))).tolist(), 0, state, first)[0].tolist()
    for key in ("a", None):
        assert [r.batch for r in got.where(F.col("k").eqNullSafe(F.lit(key))).orderBy("seq").collect()] == want
    assert got.where("k = 'new'").first().batch == 0 and got.columns == ["k", "t", "seq", "batch"]


def test_hot_channel_is_spread_over_cells(arrivals):
    """No cell of the hot channel is much larger than asked for, whatever the bursts."""
    df, _ = arrivals
    cells, any_hot = split_hot_keys(df, ["channel"], ["arrival_ns", "seq"], 300)
    assert any_hot
    assert cells.where("channel = 'hot'").groupBy("_cell").count().agg(F.max("count")).first()[0] <= 600


@pytest.mark.parametrize("outlier", [0, 2**62])
def test_one_outlier_does_not_undo_the_cells(spark, outlier):
    """Nanosecond stamps and one row at the epoch or far ahead: cells stay even, ranks right."""
    stamps = F.when(F.col("id") == 7, F.lit(outlier)).otherwise(F.lit(1_700_000_000 * 10**9) + F.col("id") * 1000)
    df = spark.range(100_000).select(F.lit("a").alias("k"), "id", stamps.alias("seq"))
    cells, _ = split_hot_keys(df, ["k"], ["seq"], 1000)
    assert cells.groupBy("_cell").count().agg(F.max("count")).first()[0] <= 2000
    ranked = rank_in_key(df, ["k"], "seq", rows_per_cell=1000)
    place = 0 if outlier == 0 else 99_999
    assert ranked.where("id = 7").first()["rank"] == place
    moved = ranked.where("id != 7").select((F.col("rank") - F.col("id")).alias("d")).distinct().collect()
    assert {r.d for r in moved} <= ({0, 1} if outlier == 0 else {0, -1})


@pytest.mark.parametrize("per_cell", [10**6, 4])
def test_null_keys_are_keys_and_a_null_order_is_refused(spark, monkeypatch, per_cell):
    """The same results with and without cells; the shard or channel may be null."""
    monkeypatch.setattr(segments, "_SEGMENTS_PER_CELL", 0)
    df = spark.createDataFrame([(None, i, 1) for i in range(40)] + [("b", i, 1) for i in range(3)], "shard string, seq long, n long")
    packed = segments.pack_next_fit(df, ["shard"], ["seq"], "n", 4, per_cell)
    assert sorted((r.seq, r.request_id) for r in packed.where("shard is null").collect()) == [(i, i // 4) for i in range(40)]
    ranked = rank_in_key(df, ["shard"], "seq", rows_per_cell=per_cell)
    assert sorted(r["rank"] for r in ranked.where("shard is null").collect()) == list(range(40))
    missing = df.withColumn("seq", F.when(F.col("seq") % 10 != 0, F.col("seq")))
    with pytest.raises(Exception, match="seq must not be null"):
        rank_in_key(missing, ["shard"], "seq", rows_per_cell=per_cell).collect()
    with pytest.raises(Exception, match="seq must not be null"):
        segments.pack_next_fit(missing, ["shard"], ["seq"], "n", 4, per_cell).collect()


@pytest.mark.parametrize("per_cell", [10**6, 10])
def test_equal_stamps_are_ordered_the_same_way_every_time(spark, per_cell):
    df = spark.range(100).select("id", (F.col("id") % 5).alias("ts"), F.col("id").cast("double").alias("v"))
    points = src.points_from_rows(df, F.lit("c"), "ts", "v")
    ways = [batch_by_count(points.repartition(k), 7, per_cell) for k in (1, 5, 9)]
    results = [sorted((r.batch, r.v_double) for r in w.collect()) for w in ways]
    assert results[0] == results[1] == results[2]
