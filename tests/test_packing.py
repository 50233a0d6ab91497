"""Series, requests, checks and reports (C1, C5 to C8, G1 to G5) on the known fixtures."""

import pytest
from pyspark.sql import functions as F

from seriesloom.operators import checks, packing, reports
from seriesloom.schema import KINDS, check_points
from seriesloom.sources import points as src

MAKE = {
    "double": "cast(id % 50 as double)", "string": "cast(id % 50 as string)", "int": "id % 50",
    "double_array": "array(cast(id % 50 as double), cast((id + 1) % 50 as double))",
    "string_array": "array(cast(id % 50 as string))",
    "struct": "concat('{\"v\":', id % 50, '}')", "uint64": "cast(id % 50 as decimal(20,0))",
}


def blocks(spark, kind, n_blocks=5, size=1000, tagged=True):
    """Blocks of one channel, each with its own batch tag."""
    df = spark.range(n_blocks * size).selectExpr("id", f"{MAKE[kind]} as v", f"cast(id div {size} as string) as b")
    tags = {"batch_id": F.col("b")} if tagged else None
    name = "channel_1" if tagged else kind
    return src.points_typed(df, kind, F.lit(name), "id", "v", tags)


def requests_of(points, cap):
    series = packing.pack_series(points, cap).withColumn("shard", F.lit(0))
    return packing.assign_requests(series, cap)


def test_blocks_double_give_five_requests(spark):
    series = requests_of(blocks(spark, "double"), 1000)
    requests = packing.build_requests(series).orderBy("request_id").collect()
    assert [r.point_count for r in requests] == [1000] * 5
    assert len(requests[0].series[0].doubles) == 1000
    assert requests[0].series[0].doubles[:60] == [float(i % 50) for i in range(60)]
    assert all(r.session_name is None for r in requests)


def test_blocks_all_kinds_give_35_requests(spark):
    total = 0
    for kind in KINDS:
        sizes = reports.request_sizes(requests_of(blocks(spark, kind), 1000)).collect()
        assert [r.n_points for r in sizes] == [1000] * 5
        total += len(sizes)
    assert total == 35


def test_writer_all_kinds_counts(spark):
    points = src.union_points(*[blocks(spark, k, tagged=False) for k in KINDS])
    want = {k: (k, 5000) for k in KINDS}
    assert {r.channel: (r.kind, r.n) for r in reports.point_counts_by_channel(points).collect()} == want
    series = packing.pack_series(points, 1000)
    assert {r.channel: (r.kind, r.n) for r in reports.series_counts_by_channel(series).collect()} == want
    assert series.count() == 35


def clash(spark):
    df = spark.sql("select 1L as ts, array(1d, 2d) as d, array('a') as s")
    return src.union_points(
        src.points_from_double_arrays(df, F.lit("mixed_array"), "ts", "d"),
        src.points_from_string_arrays(df, F.lit("mixed_array"), F.col("ts") + 1, "s"),
    )


def test_clash_is_refused(spark):
    points = clash(spark)
    with pytest.raises(Exception, match="mismatched types"):
        packing.pack_series(points, 1000).collect()
    with pytest.raises(TypeError, match="mismatched types: mixed_array"):
        checks.refuse_conflicts(points)
    with pytest.raises(Exception, match="mismatched point type"):
        reports.point_counts_by_channel(points).collect()
    row = checks.kind_conflicts(points).first()
    assert (row.channel, row.kinds, row.n_kinds) == ("mixed_array", ["double_array", "string_array"], 2)
    assert sorted(r.kind for r in packing.pack_series(points, 1000, on_conflict="split").collect()) == [
        "double_array", "string_array"]


def test_kind_may_change_between_batches(spark):
    points = clash(spark)
    batched = packing.batch_by_count(points, 1)
    assert checks.kind_conflicts(batched, "batch").count() == 0
    assert packing.pack_series(points, 1).count() == 2


def test_kinds_may_not_clash_inside_a_request(spark):
    """Two blocks of one channel, each of its own kind, in one request; in two requests they may."""
    series = packing.pack_series(clash(spark), 1).withColumn("shard", F.lit(0))
    together, apart = packing.assign_requests(series, 10), packing.assign_requests(series, 1)
    assert checks.kind_conflicts(together, "request").count() == 1
    with pytest.raises(Exception, match="mismatched types"):
        packing.build_requests(together).collect()
    assert checks.kind_conflicts(apart, "request").count() == 0
    assert packing.build_requests(apart).count() == 2


@pytest.mark.parametrize("kind", list(KINDS))
def test_blocks_of_a_channel_are_one_series_in_a_request(spark, kind):
    points = blocks(spark, kind, 1, 20, tagged=False)
    series = packing.pack_series(points, 5).withColumn("shard", F.lit(0))
    request = packing.build_requests(packing.assign_requests(series, 100)).collect()
    assert len(request) == 1 and len(request[0].series) == 1 and request[0].point_count == 20
    whole = packing.pack_series(points, 100).first()
    one = request[0].series[0]
    assert one.timestamps == whole.timestamps == list(range(20))
    assert all(one[column] == whole[column] for _, _, column, _ in KINDS.values())
    sizes = reports.request_sizes(packing.assign_requests(series, 100)).first()
    assert (sizes.n_series, sizes.n_points) == (1, 20)


def test_null_values_are_refused(spark):
    df = spark.sql("select 1L as ts, cast(null as double) as v, array(1d, null) as a, array(1L) as t, cast(null as array<double>) as vs")
    for made in (src.points_from_rows(df, F.lit("c"), "ts", "v"), src.points_typed(df, "double", F.lit("c"), "ts", "v"),
                 src.points_from_double_arrays(df, F.lit("c"), "ts", "a")):
        with pytest.raises(Exception, match="got null"):
            made.collect()
    with pytest.raises(Exception, match="must not be null"):
        src.points_from_series(df, F.lit("c"), "t", "vs").collect()
    whole = blocks(spark, "double", 1, 4)
    with pytest.raises(Exception, match="got null"):
        packing.pack_series(whole.withColumn("v_double", F.when(F.col("seq") != 2, F.col("v_double")))).collect()


@pytest.mark.parametrize("kind", list(KINDS))
def test_pack_and_unpack_keep_order_and_values(spark, kind):
    points = blocks(spark, kind, 1, 300).withColumn("seq", 1000 - F.col("seq"))  # arrival order is not time order
    series = packing.pack_series(points, 128)
    assert sorted(r.n for r in series.select("n").collect()) == [44, 128, 128]
    first = series.where("batch = 0").first()
    assert first.timestamps == list(range(299, 171, -1))
    assert first.tags == {"batch_id": "0"}
    back = check_points(packing.unpack_series(series))
    column = KINDS[kind][0]
    same = ["channel", "tags_key", "ts_ns", "seq", "kind", column]
    assert back.select(same).exceptAll(points.select(same)).isEmpty()
    assert points.select(same).exceptAll(back.select(same)).isEmpty()
    again = packing.pack_series(back.select(points.columns), 128)
    rows = lambda s: sorted(map(str, s.collect()))
    assert rows(again) == rows(series)


@pytest.mark.parametrize("per_sum", [4096, 2])
def test_equal_arrivals_stay_in_order_when_packed_again(spark, monkeypatch, per_sum):
    """Eight points at one instant, and a channel whose ``seq`` has gaps."""
    monkeypatch.setattr(packing, "SERIES_PER_SUM", per_sum)
    rows = [("a", 5, float(i), 9) for i in range(8)] + [("b", i, float(i), 100 * i) for i in range(7)]
    df = spark.createDataFrame(rows, "ch string, ts long, v double, seq long")
    series = packing.pack_series(src.points_from_rows(df, "ch", "ts", "v", seq="seq"), 3)
    back = packing.unpack_series(series)
    numbers = {c: sorted(r.seq for r in back.where(F.col("channel") == c).collect()) for c in "ab"}
    assert numbers == {"a": list(range(9, 17)), "b": list(range(7))}
    values = lambda s: sorted((r.channel, r.batch, r.v_double) for r in packing.unpack_series(s).collect())
    again = packing.pack_series(check_points(back).drop("batch", "pos"), 3)
    assert values(again) == values(series)
    arrays = lambda s: sorted((r.channel, r.batch, r.doubles) for r in s.collect())
    assert arrays(again) == arrays(series)


def test_deliveries_follow_each_other_when_unpacked(spark):
    """Batches begin again at 0 with every delivery."""
    df = spark.range(10).selectExpr("id", "cast(id as double) as v")
    series = packing.pack_series(src.points_typed(df, "double", F.lit("c"), "id", "v"), 4)
    both = series.withColumn("batch_id", F.lit(0)).unionByName(series.withColumn("batch_id", F.lit(1)))
    assert sorted(r.seq for r in packing.unpack_series(both).collect()) == list(range(20))


def test_requests_round_trip(spark):
    series = requests_of(src.union_points(*[blocks(spark, k, 1, 100, tagged=False) for k in KINDS]), 150)
    requests = packing.build_requests(series)
    assert requests.count() == 7
    back = packing.unpack_requests(requests).collect()
    assert {r.kind for r in back} == set(KINDS) and len(back) == 7
    given = {r.channel: r for r in series.collect()}
    for row in back:
        assert all(row[c] == given[row.channel][c] for c in ("tags", "timestamps", *(c for _, _, c, _ in KINDS.values())))


def test_one_oversize_block_exceeds_the_capacity(spark):
    rows = [(0, i, n) for i, n in enumerate([3, 30, 4, 4, 2, 0, 30])]
    blocks_ = spark.createDataFrame(rows, "shard long, last_seq long, n long")
    got = packing.pack_requests(blocks_, 10, order=("last_seq",)).orderBy("last_seq").collect()
    assert [r.request_id for r in got] == [0, 1, 2, 2, 2, 2, 3]


def test_c7_missing_payload_counts_zero(spark):
    df = spark.sql("select cast(null as array<bigint>) as a union all select array(1L, 2L)")
    assert sorted(r[0] for r in df.select(packing.block_point_count(F.col("a"))).collect()) == [0, 2]


def test_g3_other_kinds_count_zero(spark):
    points = src.union_points(blocks(spark, "double", 1, 10, tagged=False), blocks(spark, "int", 1, 10, tagged=False))
    assert reports.total_double_points(points, "double").first().n == 10
    assert reports.total_double_points(points, "int").first().n == 0


def test_g5_last_request_wins(spark):
    series = requests_of(blocks(spark, "double", 1, 50, tagged=False), 20)
    last = reports.last_series_per_channel(packing.merge_requests(series)).first()
    assert (last.channel, last.request_id, last.n) == ("double", 2, 10)


def test_a14_report(spark):
    df = spark.sql("select 'c' as ch, array(1) as t, array(1) as v union all select 'c', array(1), array(1, 2) union all select 'c', null, array(1)")
    row = checks.length_report(df, F.col("ch"), F.col("t"), F.col("v")).first()
    assert (row.ok_n, row.bad_n) == (1, 2)
