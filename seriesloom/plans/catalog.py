"""The registered queries: each reads whole tables and exercises one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.functions import (
    channel_or_default,
    struct_to_json,
    tag_map,
    tags_key,
    ts_from_datetime,
    ts_from_interval,
    ts_from_iso,
    ts_recombine,
    ts_split_euclid,
    ts_split_trunc,
    u64_wrap,
)
from seriesloom.operators import checks, encoding, packing, reports, segments
from seriesloom.plans import tables as t
from seriesloom.session import scratch_dir
from seriesloom.sources import points as src
from seriesloom.sources import series_avro

BATCH = 4  # points per batch in the packing queries, small enough to give many batches
CAPACITY = 50  # points per request in the packing queries
PIVOT_NS = 1_705_000_000_000_000_000  # an instant inside the events, to get both signs


# -- scalar functions ----------------------------------------------------------------------


def channel_key_plain(spark, sf):
    events = t.table(spark, sf, "events")
    keyed = events.select(t.named("ev.", "event_type").alias("channel"), tags_key(None).alias("tags_key"))
    return keyed.groupBy("channel", "tags_key").agg(F.count(F.lit(1)).alias("n"))


def channel_key_tagged(spark, sf):
    """Tags given in reverse order with a repeated key: the later value counts."""
    entry = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    given = F.array(
        entry("returnflag", F.lit("replaced")), entry("returnflag", F.col("l_returnflag")),
        entry("linestatus", F.col("l_linestatus")),
    )
    lines = t.table(spark, sf, "lineitem")
    keyed = lines.select(F.lit("li").alias("channel"), tags_key(given, entries=True).alias("tags_key"))
    return keyed.groupBy("channel", "tags_key").agg(F.count(F.lit(1)).alias("n"))


def _event_times(spark, sf):
    return t.table(spark, sf, "events").select("event_id", "ts", t.ntz_ns("ts").alias("ns"))


def _id_time(df, ns):
    return df.select(F.col("event_id").alias("id"), ns.alias("ts_ns"))


def ts_split_trunc_q(spark, sf):
    parts = _event_times(spark, sf).withColumn("p", ts_split_trunc(F.col("ns") - PIVOT_NS))
    return parts.select(F.col("event_id").alias("id"), F.col("p.seconds").alias("secs"), "p.nanos")


def ts_split_euclid_q(spark, sf):
    parts = _event_times(spark, sf).withColumn("p", ts_split_euclid(F.col("ns")))
    return parts.select(F.col("event_id").alias("id"), F.col("p.seconds").alias("secs"), "p.nanos")


def ts_from_interval_q(spark, sf):
    since = F.col("ts") - F.lit("1970-01-01").cast("timestamp_ntz")
    return _id_time(t.table(spark, sf, "events"), ts_from_interval(since))


def ts_from_datetime_q(spark, sf):
    utc = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
    return _id_time(t.table(spark, sf, "events"), ts_from_datetime(utc))


def ts_from_iso_q(spark, sf):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("123Z"))
    return _id_time(t.table(spark, sf, "events"), ts_from_iso(text))


def ts_recombine_q(spark, sf):
    parts = _event_times(spark, sf).withColumn("p", ts_split_trunc(F.col("ns")))
    return _id_time(parts, ts_recombine(F.col("p.seconds"), F.col("p.nanos")))


def _kind_counts(points):
    return points.groupBy("channel", "kind").agg(F.count(F.lit(1)).alias("n"))


def infer_kind_scalar(spark, sf):
    lines = t.table(spark, sf, "lineitem")
    mixed = {"quantity": "l_quantity", "orderkey": "l_orderkey", "returnflag": "l_returnflag"}
    kept = {"linenumber": "l_linenumber", "suppkey": "l_suppkey"}
    return _kind_counts(src.points_from_wide(lines, "l_shipdate", mixed)).unionByName(
        _kind_counts(src.points_from_wide(lines, "l_shipdate", kept, preserve_int=True))
    )


def infer_kind_batch(spark, sf):
    lines = t.table(spark, sf, "lineitem")
    stamps = F.array(F.lit(0).cast("bigint"), F.lit(1).cast("bigint"))
    pairs = {
        "prices": F.array("l_extendedprice", "l_tax"),
        "keys": F.array("l_partkey", "l_suppkey"),
        "flags": F.array("l_returnflag", "l_linestatus"),
    }
    out = None
    for name, values in pairs.items():
        one = _kind_counts(src.points_from_series(lines, F.lit(name), stamps, values))
        out = one if out is None else out.unionByName(one)
    return out


def struct_to_json_q(spark, sf):
    events = t.table(spark, sf, "events").withColumn(
        "s", F.struct(F.col("event_id").alias("k"), "event_type", "value")
    )
    json = struct_to_json(F.col("s"), events.schema["s"].dataType)
    return events.select(
        F.col("event_id").alias("id"), F.get_json_object(json, "$.k").alias("k"),
        F.get_json_object(json, "$.event_type").alias("event_type"),
    )


def struct_passthrough(spark, sf):
    return t.evs(spark, sf).select(F.col("seq").alias("id"), "v_json")


def u64_wrap_q(spark, sf):
    return t.u64(spark, sf).select(F.col("seq").alias("id"), u64_wrap(F.col("v_u64")).alias("v"))


def series_len_guard(spark, sf):
    """Line items as two-value series, one timestamp missing on every finished line."""
    ns = t.ntz_ns("l_shipdate")
    stamps = F.when(F.col("l_linestatus") == "O", F.array(ns, ns + 1)).otherwise(F.array(ns))
    lines = t.table(spark, sf, "lineitem")
    return checks.length_report(lines, F.col("l_returnflag"), stamps, F.array("l_quantity", "l_tax"))


def default_channel(spark, sf):
    events = t.table(spark, sf, "events")
    name = channel_or_default(F.nullif(F.col("event_type"), F.lit("error")))
    return events.groupBy(name.alias("channel")).agg(F.count(F.lit(1)).alias("n"))


# -- sources -------------------------------------------------------------------------------


def points_from_rows(spark, sf):
    return t.ev(spark, sf).select("channel", "tags_key", "ts_ns", "v_double")


def points_from_series(spark, sf):
    """Each embedding as a series of its items, one nanosecond apart."""
    vectors = t.table(spark, sf, "embeddings")
    stamps = F.transform(
        F.sequence(F.lit(0).cast("bigint"), (F.size("embedding") - 1).cast("bigint")),
        lambda i: F.col("vec_id") * 1_000_000_000 + i,
    )
    points = src.points_from_series(vectors, t.named("emb.", "label"), stamps, "embedding")
    return points.select("channel", "ts_ns", "seq", "v_double")


def points_from_wide(spark, sf):
    return t.li(spark, sf).select("channel", "tags_key", "ts_ns", "kind", "v_double", "v_string")


def points_from_map(spark, sf):
    lines = t.table(spark, sf, "lineitem")
    record = F.create_map(F.lit("li.tax"), F.col("l_tax"), F.lit("li.discount"), F.col("l_discount"))
    points = src.points_from_map(lines, "l_shipdate", record, {"returnflag": F.col("l_returnflag")})
    return points.select("channel", "tags_key", "ts_ns", "v_double")


def points_from_struct(spark, sf):
    events = t.table(spark, sf, "events").withColumn("s", F.from_json("props", "k bigint"))
    points = src.points_from_structs(events, t.named("evs.", "event_type"), "ts", "s", None, "event_id")
    return points.select("channel", "ts_ns", F.get_json_object("v_json", "$.k").cast("bigint").alias("k"))


def _items(points, column):
    flat = points.select("channel", "ts_ns", F.posexplode(column).alias("idx", "v"))
    return flat.withColumn("idx", F.col("idx").cast("bigint"))


def points_from_double_array(spark, sf):
    return _items(t.emb(spark, sf), "v_double_array")


def points_from_string_array(spark, sf):
    return _items(t.conva(spark, sf), "v_string_array")


def points_int(spark, sf):
    return t.ordi(spark, sf).select("channel", "ts_ns", F.col("v_long").alias("value"))


def points_uint64(spark, sf):
    return t.u64(spark, sf).select("channel", "ts_ns", F.col("v_u64").cast("string").alias("value"))


def points_double(spark, sf):
    lines = t.table(spark, sf, "lineitem")
    points = src.points_typed(lines, "double", F.lit("li.tax"), "l_shipdate", "l_tax")
    return points.select("channel", "ts_ns", F.col("v_double").alias("value"))


def points_string(spark, sf):
    return t.conv(spark, sf).select("channel", "ts_ns", F.col("v_string").alias("value"))


def points_from_typed_blocks(spark, sf):
    block = lambda points, i: points.withColumn("block_id", F.lit(i).cast("bigint"))
    both = src.union_points(block(t.ev(spark, sf), 0), block(t.evs(spark, sf), 1), block(t.ordi(spark, sf), 2))
    return both.groupBy("channel", "block_id").agg(F.count(F.lit(1)).alias("n"))


# -- grouping and packing ------------------------------------------------------------------


def _series_rows(series):
    return series.select(
        "channel", "tags_key", "batch", "kind", "n",
        F.element_at("timestamps", 1).alias("first_ts"), F.element_at("timestamps", -1).alias("last_ts"),
    )


def pack_series(spark, sf):
    return _series_rows(packing.pack_series(t.all_kinds(spark, sf)))


def batch_by_count(spark, sf):
    return (
        packing.batch_by_count(t.ev(spark, sf), BATCH)
        .groupBy("channel", "tags_key", "batch").agg(F.count(F.lit(1)).alias("n"))
    )


def batch_by_delay(spark, sf):
    arrivals = t.ev(spark, sf).select("channel", "tags_key", "seq", F.col("ts_ns").alias("arrival_ns"))
    return (
        segments.batch_by_delay(arrivals, BATCH, t.DAY_NS)
        .groupBy("channel", "tags_key", "batch").agg(F.count(F.lit(1)).alias("n"))
    )


def batch_by_delay_busy(spark, sf):
    """Few long channels: the whole event stream of each type."""
    arrivals = t.ev(spark, sf).select("channel", "seq", F.col("ts_ns").alias("arrival_ns"))
    return (
        segments.batch_by_delay(arrivals, 100, 3600 * 10**9, keys=("channel",))
        .groupBy("channel", "batch").agg(F.count(F.lit(1)).alias("n"))
    )


def pack_requests_next_fit(spark, sf):
    """Orders as blocks of line items, packed per priority."""
    lines = t.table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    blocks = t.table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderpriority").alias("shard"), F.col("o_orderkey").alias("block_id"), F.coalesce("n", F.lit(0)).alias("n")
    )
    packed = segments.pack_next_fit(blocks, ["shard"], ["block_id"], "n", CAPACITY)
    return packed.groupBy("shard", "request_id").agg(
        F.count(F.lit(1)).alias("n_blocks"), F.sum("n").alias("n_points")
    )


def _request_series(spark, sf):
    return packing.requests_from_points(t.ev(spark, sf), F.col("channel"), BATCH, CAPACITY, kinds=("double",))


def build_requests(spark, sf):
    requests = packing.build_requests(_request_series(spark, sf))
    return requests.select(
        "shard", "request_id", F.size("series").cast("bigint").alias("n_series"),
        F.col("point_count").alias("n_points"),
        F.aggregate("series", F.lit(0).cast("bigint"), lambda a, s: a + F.size(s["doubles"])).alias("n_values"),
    )


def request_sizes(spark, sf):
    sizes = reports.request_sizes(_request_series(spark, sf))
    return sizes.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_requests"), F.min("n_points").alias("least"), F.max("n_points").alias("most"),
        F.sum("n_series").alias("n_series"),
    )


def kind_conflicts(spark, sf):
    """Events with a clashing JSON copy of one channel."""
    points = t.ev(spark, sf)
    events = t.table(spark, sf, "events").where("event_type = 'error'")
    clash = src.points_typed(
        events, "struct", t.named("ev.", "event_type"), "ts", "props", {"user_id": F.col("user_id")}, "event_id"
    )
    return checks.kind_conflicts(src.union_points(points, clash)).select("channel", "tags_key", "n_kinds")


def block_point_count(spark, sf):
    """Embeddings as blocks; those of label 0 carry no payload."""
    payload = F.when(F.col("label") != 0, F.col("embedding"))
    return t.table(spark, sf, "embeddings").select(
        t.named("emb.", "label").alias("channel"), F.col("vec_id").alias("block_id"),
        packing.block_point_count(payload).alias("n"),
    )


def unpack_series(spark, sf):
    points = packing.unpack_series(packing.pack_series(t.ev(spark, sf), kinds=("double",)), kinds=("double",))
    return points.select("channel", "tags_key", "ts_ns", "v_double")


def pack_series_by_size(spark, sf):
    """Texts of documents as points: series end with 50 points or 20 000 bytes."""
    docs = t.table(spark, sf, "documents")
    points = src.points_from_rows(docs, t.named("doc.", "lang"), "doc_id", "text", {}, "doc_id")
    series = packing.pack_series(points, 50, kinds=("string",), max_bytes=20_000)
    return series.select("channel", "batch", "n", packing.series_bytes(("string",)).alias("bytes"))


def unpack_series_ties(spark, sf):
    """Line items arrive by the day, many at a time: unpacked numbers are unique and without a gap all the same."""
    tax = src.points_from_rows(t.table(spark, sf, "lineitem"), F.lit("li.tax"), "l_shipdate", "l_tax", {"returnflag": F.col("l_returnflag")})
    points = packing.unpack_series(packing.pack_series(tax, 1000, kinds=("double",)), kinds=("double",))
    return points.groupBy("channel", "tags_key").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("seq").alias("n_seq"),
        (F.max("seq") - F.min("seq") + 1).alias("span"),
    )


# -- file encoding -------------------------------------------------------------------------


def _branch_values(records):
    """One row per stored value, nested values told by size and ends."""
    return reports.file_values(records).select(
        "channel", "ts_ns", "tag", "d", "l", "s", "json",
        F.size("da").alias("da_n"), F.element_at("da", 1).alias("da_first"),
        F.array_join("sa", "|").alias("sa"),
    ).withColumn("da_n", F.when(F.col("tag") == 3, F.col("da_n")))


def encode_union(spark, sf):
    return _branch_values(encoding.union_records(packing.pack_series(t.all_kinds(spark, sf))))


def encode_empty(spark, sf):
    """Series whose payload is missing are stored as two empty arrays."""
    kind = F.when(F.col("label") != 0, F.lit("double"))
    series = t.table(spark, sf, "embeddings").select(
        t.named("emb.", "label").alias("channel"), tag_map(None).alias("tags"), kind.alias("kind"),
        F.when(kind.isNotNull(), F.transform("embedding", lambda v: F.lit(0).cast("bigint"))).alias("timestamps"),
        F.when(kind.isNotNull(), F.col("embedding").cast("array<double>")).alias("doubles"),
    )
    records = encoding.union_records(series, kinds=("double",))
    return records.groupBy("channel").agg(
        F.sum(F.size("timestamps")).alias("n_ts"), F.sum(F.size("values")).alias("n_vals")
    )


def _record_rows(records):
    return records.select(
        "channel", tags_key(F.col("tags")).alias("tags_key"), F.size("timestamps").cast("bigint").alias("n"),
        F.element_at("timestamps", 1).alias("first_ts"), F.element_at("timestamps", -1).alias("last_ts"),
    )


def file_records(spark, sf):
    return _record_rows(encoding.file_records(packing.pack_series(t.all_kinds(spark, sf))))


def _write_all(spark, sf) -> str:
    path = scratch_dir(spark, "series")
    series_avro.write_series(packing.pack_series(t.all_kinds(spark, sf)), path, dataset_id="dataset-1")
    return path


def _file(spark, sf, **options) -> DataFrame:
    """Every query writes the series file that it reads."""
    return series_avro.read_series(spark, _write_all(spark, sf), **options)


def file_roundtrip(spark, sf):
    return _record_rows(series_avro.read_series(spark, _write_all(spark, sf)))


def read_series_file(spark, sf):
    return _file(spark, sf).groupBy("channel", "dataset_id").agg(
        F.sum(F.size("timestamps")).alias("n"), F.sum(F.size("values")).alias("n_values")
    )


def file_point_total(spark, sf):
    return reports.file_point_total(_file(spark, sf, countsOnly="true"))


def file_channels(spark, sf):
    return reports.file_channels(_file(spark, sf, countsOnly="true"))


def file_values_by_branch(spark, sf):
    return _branch_values(_file(spark, sf))


# -- reports -------------------------------------------------------------------------------


def point_counts_by_channel(spark, sf):
    return reports.point_counts_by_channel(t.all_kinds(spark, sf))


def series_counts_by_channel(spark, sf):
    series = packing.pack_series(t.ev(spark, sf), BATCH, kinds=("double",))
    return reports.series_counts_by_channel(series)


def total_double_points(spark, sf):
    return reports.total_double_points(t.all_kinds(spark, sf), "ev.click")


def last_series_per_channel(spark, sf):
    series = packing.merge_requests(_request_series(spark, sf)).select("channel", "request_id", "last_seq", "n")
    last = reports.last_series_per_channel(series.withColumn("order", F.struct("request_id", "last_seq")), "order")
    return last.select("channel", "request_id", "n")


QUERIES = {
    "channel_key_plain": channel_key_plain,
    "channel_key_tagged": channel_key_tagged,
    "ts_split_trunc": ts_split_trunc_q,
    "ts_split_euclid": ts_split_euclid_q,
    "ts_from_interval": ts_from_interval_q,
    "ts_from_datetime": ts_from_datetime_q,
    "ts_from_iso": ts_from_iso_q,
    "ts_recombine": ts_recombine_q,
    "infer_kind_scalar": infer_kind_scalar,
    "infer_kind_batch": infer_kind_batch,
    "struct_to_json": struct_to_json_q,
    "struct_passthrough": struct_passthrough,
    "u64_wrap": u64_wrap_q,
    "series_len_guard": series_len_guard,
    "default_channel": default_channel,
    "points_from_rows": points_from_rows,
    "points_from_series": points_from_series,
    "points_from_wide": points_from_wide,
    "points_from_map": points_from_map,
    "points_from_struct": points_from_struct,
    "points_from_double_array": points_from_double_array,
    "points_from_string_array": points_from_string_array,
    "points_int": points_int,
    "points_uint64": points_uint64,
    "points_double": points_double,
    "points_string": points_string,
    "points_from_typed_blocks": points_from_typed_blocks,
    "pack_series": pack_series,
    "batch_by_count": batch_by_count,
    "batch_by_delay": batch_by_delay,
    "batch_by_delay_busy": batch_by_delay_busy,
    "pack_requests_next_fit": pack_requests_next_fit,
    "build_requests": build_requests,
    "request_sizes": request_sizes,
    "kind_conflicts": kind_conflicts,
    "block_point_count": block_point_count,
    "unpack_series": unpack_series,
    "unpack_series_ties": unpack_series_ties,
    "pack_series_by_size": pack_series_by_size,
    "encode_union": encode_union,
    "encode_empty": encode_empty,
    "file_records": file_records,
    "file_roundtrip": file_roundtrip,
    "read_series_file": read_series_file,
    "file_point_total": file_point_total,
    "file_channels": file_channels,
    "file_values_by_branch": file_values_by_branch,
    "point_counts_by_channel": point_counts_by_channel,
    "series_counts_by_channel": series_counts_by_channel,
    "total_double_points": total_double_points,
    "last_series_per_channel": last_series_per_channel,
}
