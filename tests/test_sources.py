"""Constructors of points."""

import pytest
from pyspark.sql import functions as F

from seriesloom.schema import POINTS, check_points
from seriesloom.sources import points as src


def test_b1_rows_by_type(spark):
    df = spark.sql("select 'c' as ch, 5L as ts, 7 as i, 's' as s, map('k','v') as tags, 3L as seq")
    p = src.points_from_rows(df, "ch", "ts", "i", "tags", "seq")
    assert check_points(p).first().asDict()["v_double"] == 7.0
    row = src.points_from_rows(df, "ch", "ts", "i", preserve_int=True).first()
    assert (row.kind, row.v_long, row.v_double, row.seq, row.tags_key) == ("int", 7, None, 5, "")
    assert src.points_from_rows(df, "ch", "ts", "s", {"a": F.col("ch")}).first().tags_key == "a=c"


def test_b2_series_positions_and_guards(spark):
    df = spark.sql("select 'c' as ch, array(1L,2L,3L) as ts, array(1,2,3) as v, 10L as base")
    rows = src.points_from_series(df, "ch", "ts", "v", seq_base="base").orderBy("seq").collect()
    assert [(r.ts_ns, r.seq, r.kind, r.v_double) for r in rows] == [(1, 10, "double", 1.0), (2, 11, "double", 2.0), (3, 12, "double", 3.0)]
    stamps = spark.sql("select 'c' as ch, array('2024-01-01T00:00:00Z') as ts, array('x') as v")
    row = src.points_from_series(stamps, "ch", "ts", "v").first()
    assert (row.ts_ns, row.kind, row.v_string) == (1_704_067_200 * 10**9, "string", "x")
    for bad, message in (("array(1)", "same length"), ("array(1,2)", None)):
        broken = spark.sql(f"select 'c' as ch, array(1L,2L) as ts, {bad} as v")
        if message:
            with pytest.raises(Exception, match=message):
                src.points_from_series(broken, "ch", "ts", "v").collect()


def test_b3_wide_is_typed_per_value_and_all_or_nothing(spark):
    df = spark.createDataFrame([(1, 1.5, "a"), (2, None, "b")], "ts long, x double, y string")
    channels = {"cx": "x", "cy": "y"}
    with pytest.raises(Exception, match="value must be"):
        src.points_from_wide(df, "ts", channels).collect()
    rows = src.points_from_wide(df, "ts", channels, on_bad="drop").collect()
    assert sorted((r.channel, r.kind, r.v_double, r.v_string) for r in rows) == [
        ("cx", "double", 1.5, None), ("cy", "string", None, "a")]
    maps = spark.createDataFrame([(1, {"a": 1.0, "b": 2.0}), (2, {"a": None})], "ts long, m map<string,double>")
    assert src.points_from_map(maps, "ts", "m", on_bad="drop").count() == 2
    with pytest.raises(Exception, match="value must be"):
        src.points_from_map(maps, "ts", "m").collect()


def test_b4_structs(spark):
    df = spark.sql("select 'c' as ch, 1L as ts, struct(1 as i, 'l' as label, struct(true as ok) as nested) as v")
    assert src.points_from_structs(df, "ch", "ts", "v").first().v_json == '{"i":1,"label":"l","nested":{"ok":true}}'
    with pytest.raises(TypeError):
        src.points_from_structs(df, "ch", "ts", "ts")


def test_b5_b6_arrays(spark):
    df = spark.sql("select 'c' as ch, 1L as ts, array(1,2) as ints, array('a','b') as texts")
    assert src.points_from_double_arrays(df, "ch", "ts", "ints").first().v_double_array == [1.0, 2.0]
    assert src.points_from_string_arrays(df, "ch", "ts", "texts").first().v_string_array == ["a", "b"]
    with pytest.raises(TypeError):
        src.points_from_double_arrays(df, "ch", "ts", "texts")
    with pytest.raises(TypeError):
        src.points_from_string_arrays(df, "ch", "ts", "ints")


def test_b7_to_b10_typed(spark):
    df = spark.sql(f"select 'c' as ch, 1L as ts, 7L as l, 1.5d as d, 's' as s, {2**64 - 1} as u, {2**64} as big, -1 as neg")
    for kind, col in (("int", "l"), ("double", "d"), ("string", "s"), ("struct", "s"), ("uint64", "u"), ("uint64", "l")):
        assert src.points_typed(df, kind, "ch", "ts", col).first().kind == kind
    for kind, col in (("int", "d"), ("double", "l"), ("string", "l"), ("uint64", "d")):
        with pytest.raises(TypeError):
            src.points_typed(df, kind, "ch", "ts", col)
    for col in ("big", "neg"):
        with pytest.raises(Exception, match="outside of uint64"):
            src.points_typed(df, "uint64", "ch", "ts", col).collect()


def test_a12_json_is_checked_on_demand(spark):
    df = spark.sql("select 'c' as ch, 1L as ts, '{\"v\": 1}' as good, '{v' as bad")
    assert src.points_typed(df, "struct", "ch", "ts", "bad").first().v_json == "{v"
    assert src.points_typed(df, "struct", "ch", "ts", "good", check_json=True).first().v_json == '{"v": 1}'
    with pytest.raises(Exception, match="is not JSON"):
        src.points_typed(df, "struct", "ch", "ts", "bad", check_json=True).collect()


def test_b14_union_checks_the_schema(spark):
    p = src.points_from_rows(spark.sql("select 'c' as ch, 1L as ts, 1d as v"), "ch", "ts", "v")
    assert src.union_points(p, p).count() == 2
    with pytest.raises(TypeError, match="points need"):
        src.union_points(p, p.drop("v_json"))
    with pytest.raises(TypeError, match="points need seq"):
        src.union_points(p.withColumn("seq", F.lit("x")))


def test_rows_do_not_read_unused_columns(spark):
    p = src.points_from_rows(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), "event_type", "ts", "value")
    plan = p.groupBy("channel").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_type:string>" in plan
    assert [f.name for f in POINTS.fields] == p.columns
