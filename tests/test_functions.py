"""Scalar normalisation."""

import random

import pytest
from pyspark.sql import functions as F

from seriesloom import functions as fn


def one(spark, *cols, sql="select 1 as x"):
    return spark.sql(sql).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def test_a1_absent_and_empty_tags_are_the_same_key(spark):
    row = one(spark, fn.tags_key(None), fn.tags_key(F.lit(None).cast("map<string,string>")), fn.tags_key({}))
    assert list(row) == ["", "", ""]
    assert one(spark, fn.tag_map(F.lit(None).cast("map<string,string>")))[0] == {}


def test_a2_tags_are_sorted_and_last_duplicate_wins(spark):
    entries = F.expr("array(struct('b' as key, '1' as value), struct('a' as key, '2' as value), struct('b' as key, '3' as value))")
    tags = fn.tag_map(entries, entries=True)
    row = one(spark, tags, fn.tags_key(tags))
    assert list(row.c0.items()) == [("a", "2"), ("b", "3")]
    assert row.c1 == "a=2;b=3"


def test_a2_tag_text_is_injective_and_reversible(spark):
    maps = [{"a": "1;b=2"}, {"a": "1", "b": "2"}, {"a;b": "="}, {"x\\": ";"}, {"x": "\\;"}, {}, {"": ""}, {"é": "ü=\n"}]
    df = spark.createDataFrame([(m,) for m in maps], "tags map<string,string>").withColumn("key", fn.tags_key(F.col("tags")))
    rows = df.select("tags", "key", fn.tags_from_key(F.col("key")).alias("back")).collect()
    assert len({r.key for r in rows}) == len(maps)
    assert all(r.tags == r.back for r in rows)


def test_a2_dict_and_map_give_the_same_key(spark):
    given = {"z": F.lit("1=;"), "a": F.lit("x")}
    row = one(spark, fn.tags_key(given), fn.tags_key(fn.tag_map(given)))
    assert row.c0 == row.c1 == "a=x;z=1\\=\\;"


def test_a2_null_tag_value_is_refused(spark):
    for tags in ({"a": F.lit(None)}, F.create_map(F.lit("a"), F.lit(None).cast("string"))):
        with pytest.raises(Exception, match="tag values must be strings"):
            one(spark, fn.tags_key(tags))


def test_a2_entries_equal_a_plain_fold(spark):
    rnd = random.Random(4)
    names, values = ["b", "a", "ä", "", "k=", "k;", "\\", "Z"], ["1", "", "=;\\", "é"]
    given = [[(rnd.choice(names), rnd.choice(values)) for _ in range(rnd.randint(0, 12))] for _ in range(200)] + [None, [("a", None), ("a", "1")]]
    df = spark.createDataFrame([(g,) for g in given], "given array<struct<key:string,value:string>>").repartition(3)
    # a list that is computed gives the same as one that is stored
    made = F.transform("given", lambda e: F.struct(F.concat(e["key"], F.lit("")).alias("key"), e["value"].alias("value")))
    both = [(fn.tags_key(c, entries=True), F.map_entries(fn.tag_map(c, entries=True))) for c in (F.col("given"), made)]
    rows = df.select("given", *(c.alias(f"{name}{n}") for n, pair in enumerate(both) for name, c in zip(("key", "tags"), pair, strict=True))).collect()
    escaped = lambda t: t.replace("\\", "\\\\").replace("=", "\\=").replace(";", "\\;")
    for r in rows:
        want = dict(sorted(dict(map(tuple, r.given or [])).items()))
        assert r.tags0 == r.tags1 == list(want.items())
        assert r.key0 == r.key1 == ";".join(f"{escaped(k)}={escaped(v)}" for k, v in want.items())


@pytest.mark.parametrize("last", ["struct('a' as key, cast(null as string) as value)", "struct(cast(null as string) as key, '1' as value)"])
def test_a2_null_entries_are_refused(spark, last):
    with pytest.raises(Exception, match="must be strings"):
        one(spark, fn.tags_key(F.expr(f"array(struct('a' as key, '1' as value), {last})"), entries=True))


def test_a3_truncating_split(spark):
    ns = F.lit(-1_500_000_000).cast("bigint")
    assert tuple(one(spark, fn.ts_split_trunc(ns))[0]) == (-1, -500_000_000)


def test_a4_euclidean_split_refuses_negative(spark):
    assert tuple(one(spark, fn.ts_split_euclid(F.lit(1_500_000_001).cast("bigint")))[0]) == (1, 500_000_001)
    with pytest.raises(Exception, match="must not be negative"):
        one(spark, fn.ts_split_euclid(F.lit(-1).cast("bigint")))


def test_a5_interval(spark):
    col = F.expr("interval '2 03:04:05.000006' day to second")
    assert one(spark, fn.ts_from_interval(col))[0] == ((2 * 24 + 3) * 3600 + 4 * 60 + 5) * 10**9 + 6000


def test_a6_datetime_any_zone_and_float_rounding(spark):
    col = F.expr("timestamp'2024-01-01 02:00:07.179575+02:00'")
    row = one(spark, fn.ts_from_datetime(col), fn.ts_from_datetime(col, float_compat=True))
    assert row.c0 == 1_704_067_207_179_575_000
    assert row.c1 == int(1_704_067_207.179575 * 1e9) != row.c0


def test_a6_naive_time_is_utc_in_any_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        col = F.expr("timestamp_ntz'2024-03-10 02:30:00'")  # does not exist in that zone
        assert one(spark, fn.ts_from_datetime(col, ntz=True))[0] == 1_710_037_800 * 10**9
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "text, ns",
    [
        ("2024-01-01T00:00:00Z", 1_704_067_200 * 10**9),
        ("2024-01-01T00:00:00.123456789Z", 1_704_067_200 * 10**9 + 123_456_789),
        ("2024-01-01 01:00:00.5+01:00", 1_704_067_200 * 10**9 + 500_000_000),
        ("2024-01-01", 1_704_067_200 * 10**9),
        ("2024-01-01T00:00:00.1234567891", 1_704_067_200 * 10**9 + 123_456_789),
        ("1969-12-31T23:59:59.25Z", -750_000_000),
    ],
)
def test_a7_iso_text(spark, text, ns):
    assert one(spark, fn.ts_from_iso(F.lit(text)))[0] == ns


def test_a7_bad_text_is_refused(spark):
    with pytest.raises(Exception, match="cannot be cast|CAST_INVALID"):
        one(spark, fn.ts_from_iso(F.lit("not a time")))


def test_a8_recombine_with_excess_nanos(spark):
    assert one(spark, fn.ts_recombine(F.lit(1), F.lit(1_000_000_001)))[0] == 2_000_000_001


def test_a9_a10_kind_inference(spark):
    df = spark.sql("select 1 as i, 1.5d as d, true as b, 's' as s, array(1) as ai, array('x') as a_s, date'2024-01-01' as dt")
    kind = {f.name: f.dataType for f in df.schema.fields}
    assert [fn.kind_of_scalar(kind[c]) for c in ("i", "d", "b", "s")] == ["double", "double", "double", "string"]
    assert fn.kind_of_scalar(kind["i"], preserve_int=True) == "int"
    assert [fn.kind_of_array(kind[c]) for c in ("ai", "a_s")] == ["double", "string"]
    with pytest.raises(TypeError, match="must be float, int, or str"):
        fn.kind_of_scalar(kind["dt"])
    with pytest.raises(TypeError):
        fn.kind_of_array(kind["i"])


def test_a11_json_keeps_nulls_and_order_and_refuses_nan(spark):
    df = spark.sql("select struct(1 as z, cast(null as int) as a, array(1.5d) as l, struct('ü' as t) as n) as s")
    text = df.select(fn.struct_to_json(F.col("s"), df.schema["s"].dataType)).first()[0]
    assert text == '{"z":1,"a":null,"l":[1.5],"n":{"t":"ü"}}'
    for bad in ("double('nan')", "double('infinity')", "-double('infinity')"):
        for shape in ("struct({} as v)", "struct(array(1d, {}) as v)", "struct(struct({} as w) as v)", "map('k', {})"):
            df = spark.sql(f"select {shape.format(bad)} as s")
            with pytest.raises(Exception, match="not JSON compliant"):
                df.select(fn.struct_to_json(F.col("s"), df.schema["s"].dataType)).collect()


def test_a13_u64_wrap(spark):
    values = {0: 0, 2**63 - 1: 2**63 - 1, 2**63: -(2**63), 2**64 - 1: -1, 12345678901234567890: -6101065172474983726}
    for value, want in values.items():
        assert one(spark, fn.u64_wrap(F.lit(str(value)).cast("decimal(20,0)")))[0] == want


def test_a14_length_guard(spark):
    with pytest.raises(Exception, match="must have same length"):
        one(spark, fn.same_length(F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))))
    with pytest.raises(Exception, match="must not be empty"):
        one(spark, fn.same_length(F.array(), F.array()))


def test_a15_default_channel(spark):
    assert list(one(spark, fn.channel_or_default(F.lit(None)), fn.channel_or_default(F.lit("c")))) == ["values", "c"]
