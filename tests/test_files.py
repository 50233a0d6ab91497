"""Series containers (B15, B16, D1 to D8, G6 to G8), also read by the JVM's own Avro reader."""

import io
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seriesloom.operators import encoding, packing, reports
from seriesloom.sources import codec, series_avro
from seriesloom.sources import points as src

SECOND = 10**9


def two_points(spark, kind, channel, first, second):
    df = spark.sql(f"select 1000 * {SECOND}L as ts, {first} as v union all select 1001 * {SECOND}L, {second}")
    return src.points_typed(df, kind, F.lit(channel), "ts", "v")


@pytest.fixture(scope="module")
def all_kinds(spark):
    return src.union_points(
        two_points(spark, "double", "doubles", "1.5d", "2.5d"),
        two_points(spark, "int", "longs", "42L", "-100L"),
        two_points(spark, "string", "strings", "'hello'", "'wörld'"),
        two_points(spark, "double_array", "double_arrays", "array(1d,2d,3d)", "array(4d,5d)"),
        two_points(spark, "string_array", "string_arrays", "array('a','b')", "array('c','d','e')"),
        two_points(spark, "struct", "structs", "'{\"key\": \"value\"}'", "'{\"count\": 42}'"),
        two_points(spark, "uint64", "uint64s", f"{2**64 - 1}", "12345678901234567890"),
    )


EXPECTED = {
    "doubles": (0, [1.5, 2.5]), "longs": (2, [42, -100]), "strings": (1, ["hello", "wörld"]),
    "double_arrays": (3, [[1.0, 2.0, 3.0], [4.0, 5.0]]), "string_arrays": (4, [["a", "b"], ["c", "d", "e"]]),
    "structs": (5, ['{"key": "value"}', '{"count": 42}']), "uint64s": (2, [-1, -6101065172474983726]),
}
FIELD = {0: "d", 1: "s", 2: "l", 3: "da", 4: "sa", 5: "json"}


def check_records(rows):
    assert len(rows) == 7
    for r in rows:
        branch, values = EXPECTED[r.channel]
        assert list(r.timestamps) == [1000 * SECOND, 1001 * SECOND]
        assert [v.tag for v in r["values"]] == [branch] * 2
        assert [v[FIELD[branch]] for v in r["values"]] == values
        assert all(v[f] is None for v in r["values"] for f in FIELD.values() if f != FIELD[branch])


def test_d1_union_encoding(spark, all_kinds):
    check_records(encoding.union_records(packing.pack_series(all_kinds)).collect())


def test_file_all_kinds(spark, all_kinds, tmp_path):
    path = str(tmp_path / "out")
    series_avro.write_series(packing.pack_series(all_kinds), path, dataset_id="ds-7")
    back = series_avro.read_series(spark, path)
    rows = back.collect()
    check_records(rows)
    assert {r.dataset_id for r in rows} == {"ds-7"}
    assert reports.file_point_total(back).first().total == 14
    assert {r.channel for r in reports.file_channels(back).collect()} == set(EXPECTED)
    assert reports.file_values(back).where("tag = 2").count() == 4


def test_jvm_avro_reader_agrees(spark, all_kinds, tmp_path):
    path = str(tmp_path / "out")
    series_avro.write_series(packing.pack_series(all_kinds).coalesce(1), path, dataset_id="ds-7", dataset_key="my.key")
    (file,) = [f for f in os.listdir(path) if f.endswith(".avro")]
    jvm = spark._jvm
    reader = jvm.org.apache.avro.file.DataFileReader(
        jvm.java.io.File(f"{path}/{file}"), jvm.org.apache.avro.generic.GenericDatumReader()
    )
    assert reader.getMetaString("my.key") == "ds-7"
    assert reader.getMetaString("avro.codec") == "snappy"
    seen = {}
    while reader.hasNext():
        record = reader.next()
        seen[record.get("channel").toString()] = record.get("values").toString()
    assert seen["doubles"] == "[1.5, 2.5]"
    assert seen["uint64s"] == "[-1, -6101065172474983726]"
    assert seen["double_arrays"] == '[{"items": [1.0, 2.0, 3.0]}, {"items": [4.0, 5.0]}]'
    assert len(seen) == 7


def ints(spark, n):
    df = spark.range(n)
    return packing.pack_series(src.points_typed(df, "int", F.lit("ch"), F.col("id") * SECOND, "id"))


def size_of(path):
    return sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.endswith(".avro"))


def test_d6_overwrite_leaves_only_the_new_content(spark, tmp_path):
    path = str(tmp_path / "out")
    series_avro.write_series(ints(spark, 500), path)
    before = size_of(path)
    series_avro.write_series(ints(spark, 5), path)
    assert reports.file_point_total(series_avro.read_series(spark, path)).first().total == 5
    assert size_of(path) < before
    assert not [f for f in os.listdir(os.path.join(path, "_staging"))]


def test_d7_existing_target_is_refused_untouched(spark, tmp_path):
    path = str(tmp_path / "out")
    series_avro.write_series(ints(spark, 3), path, overwrite=False)
    before = {f: open(os.path.join(path, f), "rb").read() for f in os.listdir(path) if f.endswith(".avro")}
    with pytest.raises(FileExistsError):
        series_avro.write_series(ints(spark, 9), path, overwrite=False)
    assert before == {f: open(os.path.join(path, f), "rb").read() for f in os.listdir(path) if f.endswith(".avro")}
    assert reports.file_point_total(series_avro.read_series(spark, path)).first().total == 3


def test_d8_no_dataset_id_no_metadata(spark, tmp_path):
    path = str(tmp_path / "out")
    series_avro.write_series(ints(spark, 1), path)
    assert series_avro.read_series(spark, path).first().dataset_id is None


def test_d2_d3_missing_payload_and_null_stamp(spark, tmp_path):
    columns = "'c' as channel, map() as tags, {} as kind, {} as timestamps, {} as doubles"
    rest = ", ".join(f"cast(null as {t}) as {c}" for c, t in (
        ("strings", "array<string>"), ("longs", "array<bigint>"), ("u64s", "array<decimal(20,0)>"),
        ("double_arrays", "array<array<double>>"), ("string_arrays", "array<array<string>>"), ("jsons", "array<string>")))
    empty = spark.sql("select " + columns.format("cast(null as string)", "cast(null as array<bigint>)", "cast(null as array<double>)") + ", " + rest)
    empty = empty.withColumn("tags", F.col("tags").cast("map<string,string>"))
    row = encoding.union_records(empty).first()
    assert (row.timestamps, row["values"]) == ([], [])
    path = str(tmp_path / "out")
    series_avro.write_series(empty, path)
    row = series_avro.read_series(spark, path).first()
    assert (row.channel, row.timestamps, row["values"], row.tags) == ("c", [], [], {})
    bad = spark.sql("select " + columns.format("'double'", "array(cast(null as bigint))", "array(1d)") + ", " + rest)
    bad = bad.withColumn("tags", F.col("tags").cast("map<string,string>"))
    with pytest.raises(Exception, match="point without timestamp"):
        encoding.union_records(bad).collect()


def test_large_files_are_split_at_blocks(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(20_000).selectExpr("id", "cast(id as double) * 1.37 as v", "cast(id % 97 as string) as t")
    points = src.points_typed(df, "double", F.lit("c"), "id", "v", {"t": F.col("t")})
    records = encoding.file_records(packing.pack_series(points, 10)).coalesce(1)
    series_avro.register(spark)
    records.write.format("series_avro").option("blockBytes", 2000).mode("append").save(path)
    split = series_avro.read_series(spark, path, splitBytes="5000")
    assert split.rdd.getNumPartitions() > 10
    values = reports.file_values(split).select("ts_ns", F.col("d").alias("v"))
    assert values.exceptAll(df.select("id", "v")).isEmpty() and values.count() == 20_000


def test_channel_filters(spark, all_kinds, tmp_path):
    path = str(tmp_path / "out")
    series_avro.write_series(packing.pack_series(all_kinds), path)
    back = series_avro.read_series(spark, path)
    assert back.where("channel = 'longs'").count() == 1
    assert back.where("channel in ('longs', 'structs')").count() == 2
    assert back.where("channel like 'double%'").count() == 2


def test_reading_does_not_depend_on_session_settings(spark, all_kinds, tmp_path):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    path = str(tmp_path / "out")
    series_avro.write_series(packing.pack_series(all_kinds), path)
    assert series_avro.read_series(spark, path).where("channel = 'longs'").count() == 1


def test_lake_is_partitioned_by_kind(spark, all_kinds, tmp_path):
    path = str(tmp_path / "lake")
    encoding.write_lake(packing.pack_series(all_kinds), path)
    one = spark.read.parquet(path).where("kind = 'int'")
    assert one.first().longs == [42, -100]
    assert "PartitionFilters: [isnotnull(kind" in one._jdf.queryExecution().executedPlan().toString()


def test_codec_integers_round_trip():
    rnd = random.Random(3)
    for _ in range(200):
        values = [rnd.choice([0, -1, 63, 64, -64, -65, 2**63 - 1, -(2**63), rnd.randint(-(2**40), 2**40)]) for _ in range(rnd.randint(1, 40))]
        raw = codec.longs(values)
        assert raw == b"".join(codec.long(v) for v in values)
        cursor = codec.Cursor(codec.array(len(values), raw))
        assert cursor.longs().tolist() == values and cursor.at == len(cursor.raw)


def test_codec_reads_mixed_branches_and_sized_chunks():
    kind = pa.struct([("tag", pa.int32()), ("d", pa.float64()), ("s", pa.string()), ("l", pa.int64()),
                      ("da", pa.list_(pa.float64())), ("sa", pa.list_(pa.string())), ("json", pa.string())])
    one = codec.long(0) + np.float64(2.5).tobytes()
    two = codec.long(2) + codec.long(-7)
    three = codec.long(1) + codec.text("x")
    body = codec.long(2) + one + two + codec.long(-1) + codec.long(len(three)) + three + b"\x00"
    parts = codec.read_values(codec.Cursor(body), kind)
    got = [v for p in parts for v in p.to_pylist()]
    assert [(v["tag"], v["d"], v["l"], v["s"]) for v in got] == [(0, 2.5, None, None), (2, None, -7, None), (1, None, None, "x")]


def test_damaged_container_is_refused(spark, tmp_path):
    path = tmp_path / "bad.avro"
    for content in (b"", b"nothing", b"Obj\x01"):
        path.write_bytes(content)
        with pytest.raises(Exception):
            series_avro.read_series(spark, str(path)).collect()


def test_nulls_are_refused_and_whole_numbers_kept():
    """A null has no branch; next to one, large whole numbers used to lose their last digits."""
    for kind, items in (("int", [2**53 + 1, None]), ("double", [1.0, None]), ("string", ["a", None])):
        with pytest.raises(ValueError, match="null"):
            codec.values(kind, pa.array(items))
    assert codec.values("int", pa.array([2**53 + 1])) == codec.longs(np.array([2, 2**53 + 1]))


def test_counts_only_and_channel_tests_decode_no_values(spark, tmp_path, monkeypatch):
    points = src.union_points(*[two_points(spark, "string", f"c{i}", "'a'", "'b'") for i in range(3)])
    series_avro.write_series(packing.pack_series(points), str(tmp_path / "x"))
    counts = series_avro.read_series(spark, str(tmp_path / "x"), countsOnly="true")
    assert sorted((r.channel, r.n) for r in counts.collect()) == [(f"c{i}", 2) for i in range(3)]
    assert counts.where("channel = 'c1'").count() == 1
    whole = series_avro.read_series(spark, str(tmp_path / "x")).where("channel = 'c1'").collect()
    assert [(r.channel, [v.s for v in r["values"]]) for r in whole] == [("c1", ["a", "b"])]


@pytest.mark.parametrize("sized", [True, False])
def test_records_are_skipped_with_and_without_lengths(monkeypatch, sized):
    if not sized:
        monkeypatch.setattr(codec, "sized_array", codec.array)
    items = {"string": pa.array(["x" * 200, "", "é"]), "double": pa.array([1.5]), "int": pa.array([2**60, -1]),
             "double_array": pa.array([[1.0, 2.0], []]), "string_array": pa.array([["a", "b" * 70], []]), "struct": pa.array(['{"k": 1}'])}
    records = [codec.record(k, [("t", "v")], np.arange(len(v)), k, v) for k, v in items.items()]
    cursor, value_type = codec.Cursor(b"".join(records)), series_avro_values()
    for kind, given in items.items():
        if kind in ("double", "string_array"):
            channel, stamps, parts, tags = codec.read_record(cursor, value_type)
            assert (channel, len(stamps), tags) == (kind, len(given), [("t", "v")])
        elif kind == "int":
            assert codec.read_record(cursor, value_type, lambda c: False) is None
        else:
            assert codec.read_record(cursor, value_type, counts_only=True) == (kind, len(given), None, [("t", "v")])
    assert cursor.at == len(cursor.raw)


def series_avro_values():
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(series_avro.READ_DDL)).field("values").type.value_type


def test_overwrite_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    """A writer that dies before it publishes leaves the old data; leftovers of it do not count."""
    path = str(tmp_path / "x")
    series_avro.write_series(packing.pack_series(two_points(spark, "int", "old", "1", "2")), path)
    new = packing.pack_series(two_points(spark, "int", "new", "1", "2"))
    other = str(tmp_path / "y")
    series_avro.write_series(new, other)
    for name in os.listdir(other):
        if name.endswith(".avro"):  # moved into place, not published
            os.rename(f"{other}/{name}", f"{path}/{name}")
    assert [r.channel for r in series_avro.read_series(spark, path).collect()] == ["old"]
    series_avro.write_series(new, path)
    assert [r.channel for r in series_avro.read_series(spark, path).collect()] == ["new"]


def test_a_long_series_is_encoded_in_parts(monkeypatch):
    """Small parts and packs give the same records, and a long series is never encoded whole."""
    texts = pa.array([f"text {n} é " + "x" * (n % 50) for n in range(3000)])
    items = {
        "string": texts, "double": pa.array(np.arange(3000) / 7), "int": pa.array(np.arange(3000) * 10**9),
        "double_array": pa.array([[float(n)] * (n % 5) for n in range(3000)]),
        "string_array": pa.array([["a", f"b{n}"] for n in range(3000)]),
    }
    monkeypatch.setattr(codec, "PART_BYTES", 4000, raising=False)
    monkeypatch.setattr(codec, "PACK_BYTES", 1 << 16, raising=False)
    kind = pa.struct([("tag", pa.int32()), ("d", pa.float64()), ("s", pa.string()), ("l", pa.int64()), ("da", pa.list_(pa.float64())), ("sa", pa.list_(pa.string())), ("json", pa.string())])
    field = {"string": "s", "double": "d", "int": "l", "double_array": "da", "string_array": "sa"}
    longest = 0
    made = codec.Block()
    for k, v in items.items():
        parts = list(codec.pieces(k, [("t", "v")], np.arange(len(v)), k, v))
        longest = max(longest, *map(len, parts))
        made.add(parts)
    assert longest < 10_000
    out = io.BytesIO()
    out.write(codec.header(b"s" * 16, {}))
    made.write(out, b"s" * 16)
    container = codec.Container(out, out.tell())
    (count, raw), = container.blocks()
    assert count == len(items)
    cursor = codec.Cursor(raw)
    for k, v in items.items():
        channel, stamps, values, tags = codec.read_record(cursor, kind)
        assert channel == k and stamps.tolist() == list(range(len(v))) and tags == [("t", "v")]
        assert pa.concat_arrays(values).field(field[k]).to_pylist() == v.to_pylist()
    cursor = codec.Cursor(raw)
    assert [codec.read_record(cursor, kind, counts_only=True)[1] for _ in items] == [3000] * len(items)
