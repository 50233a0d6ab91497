"""Points to series and requests, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.functions.identity import tags_from_key
from seriesloom.functions.values import u64_unwrap, u64_wrap
from seriesloom.operators.segments import SizeRule, pack_next_fit, segment
from seriesloom.operators.spread import ROWS_PER_CELL, null_safe, rank_in_key
from seriesloom.schema import CHANNEL_KEY, KINDS, NULL_VALUE

MAX_POINTS = 250_000  # fixed value: default points per record

_MISMATCH = "mismatched types"


def batch_by_count(
    points: DataFrame, max_points: int = MAX_POINTS, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Number the batches of each channel: a batch closes when it holds ``max_points``.

    Points with the same ``seq`` go by time stamp and then by a hash of their values, so that a
    point has the same batch in every evaluation. A null ``seq`` is an error.
    """
    return _numbered(_tied(points), max_points, rows_per_cell)


def _tied(points: DataFrame) -> DataFrame:
    """``points`` with ``_tie``, a hash of their values."""
    return points.withColumn("_tie", F.xxhash64(*[f.name for f in points.schema.fields if not isinstance(f.dataType, T.MapType)]))


def _numbered(tied: DataFrame, max_points: int, rows_per_cell: int) -> DataFrame:
    """``batch`` in place of ``_tie``."""
    ties = [c for c in ("ts_ns", "_tie") if c in tied.columns]
    ranked = rank_in_key(tied, CHANNEL_KEY, "seq", "_rank", rows_per_cell, tuple(ties))
    batch = F.call_function("div", F.col("_rank"), F.lit(max_points).cast("bigint"))
    return ranked.withColumn("batch", batch).drop("_rank", "_tie")


#: Bytes that a point counts besides its payload: time stamp and order.
POINT_BYTES = 16


def _payload(kind: str, value: Column) -> Column:
    if kind in ("string", "struct"):
        return F.octet_length(value)
    if kind == "string_array":
        return F.aggregate(value, F.lit(0), lambda total, s: total + F.lit(8) + F.coalesce(F.octet_length(s), F.lit(0)))
    return 8 * F.size(value) if kind == "double_array" else F.when(value.isNotNull(), 8)


def point_bytes(kinds: tuple[str, ...] = tuple(KINDS)) -> Column:
    """What a point counts against a bound in bytes: ``POINT_BYTES`` and its payload."""
    return (F.lit(POINT_BYTES) + F.coalesce(*[_payload(k, F.col(KINDS[k][0])) for k in kinds], F.lit(0))).cast("bigint")


def series_bytes(kinds: tuple[str, ...] = tuple(KINDS)) -> Column:
    """The same for a whole series."""

    def whole(kind: str) -> Column:
        return F.aggregate(KINDS[kind][2], F.lit(0).cast("bigint"), lambda total, value: total + _payload(kind, value).cast("bigint"))

    return POINT_BYTES * F.col("n") + F.coalesce(*map(whole, kinds), F.lit(0))


def batch_by_size(
    points: DataFrame, max_points: int, max_bytes: int, kinds: tuple[str, ...] = tuple(KINDS), rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Number the batches of each channel, bounded by points and bytes.

    A batch takes the next point unless it has ``max_points``, or the point does not fit into ``max_bytes``; a larger point
    is a batch of its own. Points go as in :func:`batch_by_count`, and hot channels are walked by many tasks.
    """
    tied = _tied(points).withColumn("_bytes", point_bytes(kinds))
    order = ["seq", *[c for c in ("ts_ns", "_tie") if c in tied.columns]]
    numbered = segment(tied, CHANNEL_KEY, order, "_bytes", SizeRule(max_points, max_bytes), "batch", rows_per_cell)
    return numbered.drop("_tie", "_bytes")


# Slots that the values of a batch are collected in: text and JSON share one, as do both
# integer kinds (an unsigned number travels as its two's complement).
_SLOTS = {
    "double": ("d", "double"), "string": ("s", "string"), "struct": ("s", "string"), "int": ("l", "bigint"),
    "uint64": ("l", "bigint"), "double_array": ("da", "array<double>"), "string_array": ("sa", "array<string>"),
}


def _slots(kinds: tuple[str, ...]) -> list[Column]:
    filled: dict[str, list[Column]] = {}
    for kind in kinds:
        value = F.col(KINDS[kind][0])
        filled.setdefault(_SLOTS[kind][0], []).append(u64_wrap(value) if kind == "uint64" else value)
    return [F.coalesce(*values).alias(slot) for slot, values in filled.items()]


def _typed_array(kind: str) -> Column:
    values = F.col("_points")[_SLOTS[kind][0]]
    if kind == "uint64":
        values = F.transform(values, u64_unwrap)
    return F.when(F.col("kind") == kind, values)


def pack_batches(batched: DataFrame, kinds: tuple[str, ...] = tuple(KINDS), on_conflict: str = "fail") -> DataFrame:
    """One series per channel and batch, points in arrival order.

    The input must carry ``batch``, so that an array never holds more than one batch. Values
    sit in one typed array per kind. Two kinds in one batch are refused (C6) unless
    ``on_conflict`` is ``split``, which makes one series per kind. ``kinds`` may name the kinds
    that occur, to spare the unused slots; other kinds are refused then, and so is a null value.
    """
    return _collected(_slotted(batched, kinds, "batch"), kinds, on_conflict)


def _slotted(points: DataFrame, kinds: tuple[str, ...], *more: str) -> DataFrame:
    """Points with the slots of their values and the bit of their kind: fewer and narrower columns to move and sort."""
    missing = F.raise_error(F.lit(NULL_VALUE)).cast("int")
    seen = [F.when(F.col("kind") == k, F.when(F.col(KINDS[k][0]).isNull(), missing).otherwise(1 << i)) for i, k in enumerate(kinds)]
    bit = F.coalesce(*seen, F.lit(1 << len(kinds)))
    return points.select(*CHANNEL_KEY, "seq", "ts_ns", bit.alias("_kind"), *_slots(kinds), *more)


def _collected(slotted: DataFrame, kinds: tuple[str, ...], on_conflict: str) -> DataFrame:
    """The series of :func:`pack_batches`, from slots with ``batch``."""
    slots = [s for s in dict.fromkeys(slot for slot, _ in _SLOTS.values()) if s in slotted.columns]
    keys = [*CHANNEL_KEY, "batch", *(["_kind"] if on_conflict == "split" else [])]
    collected = slotted.groupBy(*keys).agg(
        F.bit_or("_kind").alias("_kinds"),  # the kinds seen, as a set of bits
        F.collect_list(F.struct("seq", "ts_ns", *slots)).alias("_points"),
    )
    one_kind = F.coalesce(
        *[F.when(F.col("_kinds") == 1 << i, F.lit(k)) for i, k in enumerate(kinds)], F.raise_error(F.lit(_MISMATCH))
    )
    packed = collected.select(
        *CHANNEL_KEY, "batch", one_kind.alias("kind"), F.sort_array("_points").alias("_points")
    )
    return packed.select(
        "channel", tags_from_key(F.col("tags_key")).alias("tags"), "tags_key", "batch", "kind",
        F.element_at("_points", 1)["seq"].alias("first_seq"),
        F.element_at("_points", -1)["seq"].alias("last_seq"),
        F.size("_points").cast("bigint").alias("n"),
        F.col("_points")["ts_ns"].alias("timestamps"),
        *[
            (_typed_array(k) if k in kinds else F.lit(None)).cast(f"array<{ddl}>").alias(column)
            for k, (_, ddl, column, _) in KINDS.items()
        ],
    )


def pack_series(
    points: DataFrame, max_points: int = MAX_POINTS, kinds: tuple[str, ...] = tuple(KINDS),
    on_conflict: str = "fail", rows_per_cell: int = ROWS_PER_CELL, max_bytes: int | None = None,
) -> DataFrame:
    """Points to series of at most ``max_points``, and of ``max_bytes`` where given (C2 then C1)."""
    if max_bytes is None:  # as batch_by_count and pack_batches, but what moves are slots
        slotted = _slotted(_tied(points), kinds, "_tie")
        return _collected(_numbered(slotted, max_points, rows_per_cell), kinds, on_conflict)
    return pack_batches(batch_by_size(points, max_points, max_bytes, kinds, rows_per_cell), kinds, on_conflict)


def block_point_count(timestamps: Column) -> Column:
    """Points in a block; a block without payload counts 0."""
    return F.coalesce(F.size(timestamps), F.lit(0)).cast("bigint")


#: Series of a channel whose sizes are added up in one window; a hot channel has many such windows.
SERIES_PER_SUM = 4096


def _numbered_series(series: DataFrame) -> DataFrame:
    """``series`` with ``_start``, the ``seq`` of its first point: the points of the channel's series before it, added up.

    The first series of a channel keeps its ``first_seq``. Only sizes and plain columns are added up, in runs of
    ``SERIES_PER_SUM`` series and then over the runs; each start is joined back on the plain columns.
    """
    plain = [f.name for f in series.schema.fields if isinstance(f.dataType, T.AtomicType)]
    deliveries = [c for c in ("stream_id", "batch_id") if c in plain]
    order = [*deliveries, "batch", "kind", *[c for c in plain if c not in (*deliveries, "batch", "kind", *CHANNEL_KEY)]]
    sizes = series.select(*plain, F.size("timestamps").cast("bigint").alias("_size"))
    sizes = sizes.groupBy(*plain).agg(F.sum("_size").alias("_size"))
    run = [*CHANNEL_KEY, *deliveries, "_run"]
    sizes = sizes.withColumn("_run", F.call_function("div", F.col("batch"), F.lit(SERIES_PER_SUM).cast("bigint")))
    before = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("_size").over(before(W.partitionBy(*run).orderBy(*order))), F.lit(0))
    runs = sizes.groupBy(*run).agg(F.sum("_size").alias("_all"), F.min("first_seq").alias("_low"))
    earlier = F.coalesce(F.sum("_all").over(before(W.partitionBy(*CHANNEL_KEY).orderBy(*deliveries, "_run"))), F.lit(0))
    lowest = F.first("_low").over(W.partitionBy(*CHANNEL_KEY).orderBy(*deliveries, "_run"))
    runs = runs.select(*run, (earlier + lowest).alias("_earlier"))
    starts = null_safe(sizes.withColumn("_inside", inside), runs, run)
    starts = starts.select(*plain, (F.col("_earlier") + F.col("_inside")).alias("_start"))
    return null_safe(series, starts, plain)


def unpack_series(series: DataFrame, kinds: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """Series back to canonical points; ``seq`` numbers a channel's points in the order of its series.

    The numbers begin with the channel's least ``first_seq`` and have no gap, so the points are packed again in their order
    whatever their ``seq`` was: equal arrivals don't mix. Series alike in all plain columns share numbers.
    """
    arrays = [  # the arrays of the other kinds are null, which would make the whole zip null
        F.coalesce(column, F.array().cast(f"array<{ddl}>")).alias(column)
        for k, (_, ddl, column, _) in KINDS.items() if k in kinds
    ]
    flat = _numbered_series(series).select(
        "channel", "tags", "tags_key", "kind", "batch", "_start",
        F.posexplode(F.arrays_zip(F.col("timestamps"), *arrays)).alias("pos", "p"),
    )
    return flat.select(
        "channel", "tags", "tags_key", F.col("p.timestamps").alias("ts_ns"),
        (F.col("_start") + F.col("pos")).alias("seq"), "kind",
        *[
            (F.col("p")[column] if k in kinds else F.lit(None)).cast(ddl).alias(name)
            for k, (name, ddl, column, _) in KINDS.items()
        ],
        "batch", F.col("pos").cast("bigint").alias("pos"),
    )


def with_shard(series: DataFrame, shards: int) -> DataFrame:
    """Spread channels over ``shards`` independent request sequences."""
    return series.withColumn("shard", F.pmod(F.xxhash64(*CHANNEL_KEY), F.lit(shards)))


def pack_requests(
    blocks: DataFrame, max_points: int = MAX_POINTS, rows_per_cell: int = ROWS_PER_CELL,
    order: tuple[str, ...] = ("last_seq", "channel", "tags_key", "batch"),
) -> DataFrame:
    """Assign whole blocks to requests of at most ``max_points``, per shard, next-fit (C4)."""
    return pack_next_fit(blocks, ["shard"], list(order), "n", max_points, rows_per_cell)


BLOCK_KEY = [*CHANNEL_KEY, "batch"]


def request_blocks(
    series: DataFrame, max_points: int = MAX_POINTS, rows_per_cell: int = ROWS_PER_CELL, max_bytes: int | None = None,
    kinds: tuple[str, ...] = tuple(KINDS),
) -> DataFrame:
    """The request of every series, by key (C4). Only keys and sizes go through the packing.

    With ``max_bytes`` a series counts as many points as it has, or as its share of the bytes is worth, whichever
    is more, so a request stays within both bounds.
    """
    sizes = series.select("shard", *BLOCK_KEY, "last_seq", "n")
    if max_bytes is not None:
        worth = F.ceil(series_bytes(kinds) * F.lit(max_points) / F.lit(max_bytes)).cast("bigint")
        sizes = series.select("shard", *BLOCK_KEY, "last_seq", F.greatest("n", worth).alias("n"))
    return pack_requests(sizes, max_points, rows_per_cell).select(*BLOCK_KEY, "request_id")


def assign_requests(
    series: DataFrame, max_points: int = MAX_POINTS, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """Give every series its request. ``series`` carries shard.

    The series are joined back on the key they are already partitioned by, so their arrays are
    not shuffled again.
    """
    return series.join(request_blocks(series, max_points, rows_per_cell), BLOCK_KEY)


def requests_from_points(
    points: DataFrame, shard: Column, max_points: int = MAX_POINTS, capacity: int = MAX_POINTS,
    kinds: tuple[str, ...] = tuple(KINDS), rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """Points to series that carry shard and request_id (C2, C1 and C4 in one).

    ``shard`` is an expression over channel and tags_key. Block sizes come from the packed rows,
    whose exchange both uses share; their arrays do not go through the packing.
    """
    packed = pack_series(points, max_points, kinds, rows_per_cell=rows_per_cell).withColumn("shard", shard)
    return assign_requests(packed, capacity, rows_per_cell)


def merge_requests(series: DataFrame) -> DataFrame:
    """One series per channel and request: its blocks appended in arrival order.

    ``series`` carries shard and request_id. Two kinds of one channel in one request are an
    error. A request is bounded by the packing capacity (or one oversize block), and so is what
    is gathered here.
    """
    arrays = ["timestamps", *[column for _, _, column, _ in KINDS.values() if column in series.columns]]
    key = ["shard", "request_id", *CHANNEL_KEY]
    block = F.struct("last_seq", "batch", "first_seq", "kind", *arrays)
    gathered = series.groupBy(*key).agg(F.sort_array(F.collect_list(block)).alias("_b"), F.sum("n").alias("n"))

    def appended(column: str) -> Column:
        given = F.filter(F.col("_b")[column], lambda a: a.isNotNull())
        return F.when(F.size(given) > 0, F.flatten(given)).alias(column)

    kinds = F.array_compact(F.array_distinct(F.col("_b")["kind"]))
    one_kind = F.when(F.size(kinds) > 1, F.raise_error(F.lit(_MISMATCH))).otherwise(F.get(kinds, F.lit(0)))
    return gathered.select(
        "shard", "request_id", "channel", tags_from_key(F.col("tags_key")).alias("tags"), "tags_key",
        one_kind.alias("kind"), F.array_min(F.col("_b")["first_seq"]).alias("first_seq"),
        F.element_at("_b", -1)["last_seq"].alias("last_seq"), "n", *map(appended, arrays),
    )


def build_requests(series: DataFrame) -> DataFrame:
    """One row per request with one series per channel (C5). ``series`` carries shard and request_id.

    A request holds at most the packing capacity in points (or one oversize block), so the
    nested array is bounded.
    """
    merged = merge_requests(series)
    arrays = [c for c in merged.columns if c not in ("shard", "request_id", "first_seq", "last_seq", "n", "tags")]
    return (
        merged.groupBy("shard", "request_id")
        .agg(
            F.sort_array(F.collect_list(F.struct("last_seq", *arrays))).alias("_s"),
            F.sum("n").alias("point_count"),
        )
        .select(
            "shard",
            "request_id",
            F.transform(
                "_s",
                lambda s: F.struct(
                    s["channel"].alias("channel"), tags_from_key(s["tags_key"]).alias("tags"),
                    *[s[p].alias(p) for p in arrays if p not in ("channel", "tags_key")],
                ),
            ).alias("series"),
            F.lit(None).cast("string").alias("session_name"),
            "point_count",
        )
    )


def unpack_requests(requests: DataFrame) -> DataFrame:
    """Requests back to series."""
    return requests.select("shard", "request_id", F.inline("series"))
