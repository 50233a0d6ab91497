"""User data to canonical points.

Every function is a stateless select, so it serves batch and streaming DataFrames alike (B17).
``channel``, ``ts``, ``value`` and ``seq`` are column names or columns; ``seq`` is the arrival
order inside a channel and defaults to ``ts_ns``.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.functions.identity import channel_or_default, tag_map, tags_key
from seriesloom.functions.time import to_ts_ns
from seriesloom.functions.values import (
    checked_uint64,
    kind_of_array,
    kind_of_scalar,
    same_length,
    struct_to_json,
)
from seriesloom.schema import KINDS, NULL_VALUE, POINTS, check_points, point_columns

ColumnLike = str | Column
Tags = str | Column | Mapping[str, Column] | None


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _dtype(df: DataFrame, c: Column) -> T.DataType:
    return df.select(c).schema[0].dataType


def _identity(df: DataFrame, channel: ColumnLike, ts: ColumnLike, tags: Tags, seq: ColumnLike | None):
    ts = _col(ts)
    ns = to_ts_ns(ts, _dtype(df, ts))
    tags = _col(tags) if isinstance(tags, str) else tags
    order = ns if seq is None else _col(seq)
    return channel_or_default(_col(channel)), tag_map(tags), tags_key(tags), ns, order


def _rows(df, channel, ts, kind, value, tags, seq) -> DataFrame:
    name, tag_col, key, ns, order = _identity(df, channel, ts, tags, seq)
    return df.select(*point_columns(name, tag_col, key, ns, order, kind, value))


def points_from_rows(
    df: DataFrame, channel: ColumnLike, ts: ColumnLike, value: ColumnLike,
    tags: Tags = None, seq: ColumnLike | None = None, preserve_int: bool = False,
) -> DataFrame:
    """One point per row; the kind follows from the column type."""
    value = _col(value)
    kind = kind_of_scalar(_dtype(df, value), preserve_int)
    return _rows(df, channel, ts, kind, value, tags, seq)


def points_typed(
    df: DataFrame, kind: str, channel: ColumnLike, ts: ColumnLike, value: ColumnLike,
    tags: Tags = None, seq: ColumnLike | None = None, check_json: bool = False,
) -> DataFrame:
    """Points of a declared kind; the column must already have its type.

    JSON text of a ``struct`` is taken as it is (A12); ``check_json`` refuses text that is not JSON.
    """
    value = _col(value)
    dtype = _dtype(df, value)
    want = KINDS[kind][1]
    if kind == "uint64":
        if not isinstance(dtype, (T.IntegralType, T.DecimalType)):
            raise TypeError(f"uint64 needs a whole number, got {dtype.simpleString()}")
        value = checked_uint64(value)
    elif kind == "int" and isinstance(dtype, T.IntegralType):
        value = value.cast("bigint")
    elif dtype.simpleString() != want:
        raise TypeError(f"{kind} needs {want}, got {dtype.simpleString()}")
    if kind == "struct" and check_json:
        is_json = F.try_parse_json(value).isNotNull() | value.isNull()
        value = F.when(is_json, value).otherwise(F.raise_error(F.lit("struct value is not JSON")))
    return _rows(df, channel, ts, kind, value, tags, seq)


def points_from_series(
    df: DataFrame, channel: ColumnLike, timestamps: ColumnLike, values: ColumnLike,
    tags: Tags = None, seq_base: ColumnLike | None = None, preserve_int: bool = False,
) -> DataFrame:
    """Per-channel arrays of timestamps and values (B2); ``seq`` is ``seq_base`` plus the position."""
    timestamps, values = _col(timestamps), _col(values)
    kind = kind_of_array(_dtype(df, values), preserve_int)
    stamp = _dtype(df, timestamps).elementType
    tags = _col(tags) if isinstance(tags, str) else tags
    base = F.lit(0) if seq_base is None else _col(seq_base)
    flat = df.select(
        channel_or_default(_col(channel)).alias("channel"),
        tag_map(tags).alias("tags"),
        tags_key(tags).alias("tags_key"),
        base.alias("base"),
        F.posexplode(same_length(timestamps, values)).alias("pos", "point"),
    )
    return flat.select(
        *point_columns(
            F.col("channel"), F.col("tags"), F.col("tags_key"), to_ts_ns(F.col("point.ts"), stamp),
            F.col("base") + F.col("pos"), kind, F.col("point.v"),
        )
    )


def _record_check(values: list[Column], on_bad: str) -> Column:
    """All values of a record must be present: the whole record is refused before any is sent."""
    whole = reduce(lambda a, b: a & b, [v.isNotNull() for v in values])
    if on_bad == "drop":
        return whole
    return F.when(whole, F.lit(True)).otherwise(F.raise_error(F.lit(NULL_VALUE)))


def points_from_wide(
    df: DataFrame, ts: ColumnLike, channels: Mapping[str, ColumnLike], tags: Tags = None,
    seq: ColumnLike | None = None, preserve_int: bool = False, on_bad: str = "fail",
) -> DataFrame:
    """One timestamp and many channels per row, each value typed on its own.

    A record with a missing value is refused as a whole: ``on_bad`` is ``fail`` or ``drop``.
    """
    cols = {name: _col(c) for name, c in channels.items()}
    kinds = {name: kind_of_scalar(_dtype(df, c), preserve_int) for name, c in cols.items()}
    _, tag_col, key, ns, order = _identity(df, F.lit(""), ts, tags, seq)
    used = sorted(set(kinds.values()))
    cells = [
        F.struct(
            F.lit(name).alias("channel"),
            F.lit(kinds[name]).alias("kind"),
            *[
                (c if kinds[name] == k else F.lit(None)).cast(KINDS[k][1]).alias(KINDS[k][0])
                for k in used
            ],
        )
        for name, c in cols.items()
    ]
    flat = df.where(_record_check(list(cols.values()), on_bad)).select(
        tag_col.alias("tags"), key.alias("tags_key"), ns.alias("ts_ns"), order.cast("bigint").alias("seq"),
        F.inline(F.array(*cells)),
    )
    have = set(flat.columns)
    return flat.select(
        *[
            F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in POINTS.fields
        ]
    )


def points_from_map(
    df: DataFrame, ts: ColumnLike, values: ColumnLike, tags: Tags = None,
    seq: ColumnLike | None = None, preserve_int: bool = False, on_bad: str = "fail",
) -> DataFrame:
    """A wide record given as one map column of channel -> value."""
    values = _col(values)
    kind = kind_of_scalar(_dtype(df, values).valueType, preserve_int)
    whole = ~F.exists(F.map_values(values), lambda v: v.isNull())
    if on_bad != "drop":
        whole = F.when(whole, F.lit(True)).otherwise(
            F.raise_error(F.lit(NULL_VALUE))
        )
    _, tag_col, key, ns, order = _identity(df, F.lit(""), ts, tags, seq)
    flat = df.where(whole).select(
        tag_col.alias("tags"), key.alias("tags_key"), ns.alias("ns"), order.alias("ord"),
        F.explode(values).alias("name", "v"),
    )
    return flat.select(
        *point_columns(F.col("name"), F.col("tags"), F.col("tags_key"), F.col("ns"), F.col("ord"), kind, F.col("v"))
    )


def points_from_structs(
    df: DataFrame, channel: ColumnLike, ts: ColumnLike, value: ColumnLike,
    tags: Tags = None, seq: ColumnLike | None = None,
) -> DataFrame:
    """Struct or map values stored as JSON text."""
    value = _col(value)
    dtype = _dtype(df, value)
    if not isinstance(dtype, (T.StructType, T.MapType)):
        raise TypeError(f"a struct value is needed, got {dtype.simpleString()}")
    return _rows(df, channel, ts, "struct", struct_to_json(value, dtype), tags, seq)


def points_from_double_arrays(
    df: DataFrame, channel: ColumnLike, ts: ColumnLike, value: ColumnLike,
    tags: Tags = None, seq: ColumnLike | None = None,
) -> DataFrame:
    """Array values; numeric elements become doubles."""
    value = _col(value)
    dtype = _dtype(df, value)
    if not isinstance(dtype, T.ArrayType) or not isinstance(dtype.elementType, (T.NumericType, T.BooleanType)):
        raise TypeError(f"Values must be floats, got {dtype.simpleString()}")
    return _rows(df, channel, ts, "double_array", value.cast("array<double>"), tags, seq)


def points_from_string_arrays(
    df: DataFrame, channel: ColumnLike, ts: ColumnLike, value: ColumnLike,
    tags: Tags = None, seq: ColumnLike | None = None,
) -> DataFrame:
    """Array-of-text values; other element types are refused, not cast."""
    return points_typed(df, "string_array", channel, ts, value, tags, seq)


def union_points(*blocks: DataFrame) -> DataFrame:
    """Ready-made points appended as they are; extra columns such as a block id are kept."""
    return reduce(lambda a, b: a.unionByName(b), [check_points(b) for b in blocks])
