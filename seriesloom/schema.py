"""Canonical schemas of points, series and requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A channel is identified by its name and its whole tag map.
CHANNEL_KEY = ["channel", "tags_key"]

U64 = "decimal(20,0)"

# Kind -> (point column, its type, series column, union branch in files).
KINDS = {
    "double": ("v_double", "double", "doubles", 0),
    "string": ("v_string", "string", "strings", 1),
    "int": ("v_long", "bigint", "longs", 2),
    "double_array": ("v_double_array", "array<double>", "double_arrays", 3),
    "string_array": ("v_string_array", "array<string>", "string_arrays", 4),
    "struct": ("v_json", "string", "jsons", 5),
    "uint64": ("v_u64", U64, "u64s", 2),
}

# Fixed text: users match on it.
NULL_VALUE = "value must be float, int, or str, got null"

_DOUBLES = T.ArrayType(T.DoubleType())
_STRINGS = T.ArrayType(T.StringType())
_VALUE_TYPES = {
    "double": T.DoubleType(), "string": T.StringType(), "bigint": T.LongType(),
    "array<double>": _DOUBLES, "array<string>": _STRINGS, U64: T.DecimalType(20, 0),
}

POINTS = T.StructType(
    [
        T.StructField("channel", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("tags_key", T.StringType()),
        T.StructField("ts_ns", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("kind", T.StringType()),
        *[T.StructField(col, _VALUE_TYPES[ddl]) for col, ddl, _, _ in KINDS.values()],
    ]
)

UNION_DDL = (
    "struct<tag:int,d:double,s:string,l:bigint,da:array<double>,sa:array<string>,json:string>"
)


def point_columns(
    channel: Column, tags: Column, tags_key: Column, ts_ns: Column, seq: Column, kind: str, value: Column
) -> list[Column]:
    """The canonical select list for points of one kind. A null value, or item of an array, is refused."""
    missing = value.isNull()
    if kind in ("double_array", "string_array"):
        missing = missing | F.exists(value, lambda v: v.isNull())
    value = F.when(missing, F.raise_error(F.lit(NULL_VALUE))).otherwise(value)
    values = [
        (value if k == kind else F.lit(None)).cast(ddl).alias(col)
        for k, (col, ddl, _, _) in KINDS.items()
    ]
    return [
        channel.cast("string").alias("channel"),
        tags.alias("tags"),
        tags_key.alias("tags_key"),
        ts_ns.cast("bigint").alias("ts_ns"),
        seq.cast("bigint").alias("seq"),
        F.lit(kind).alias("kind"),
        *values,
    ]


def check_points(df: DataFrame) -> DataFrame:
    """Refuse a DataFrame that is not in the canonical point schema (extra columns are kept)."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for field in POINTS.fields:
        want = field.dataType.simpleString()
        if have.get(field.name) != want:
            raise TypeError(f"points need {field.name} {want}, got {have.get(field.name)}")
    return df
