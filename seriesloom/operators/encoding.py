"""Series in the file layout: parallel arrays with tagged-union values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.functions.identity import channel_or_default, tag_map
from seriesloom.functions.values import u64_wrap
from seriesloom.schema import KINDS, UNION_DDL

# Union branch -> field of the value struct that is set.
_FIELD = {0: "d", 1: "s", 2: "l", 3: "da", 4: "sa", 5: "json"}
_FIELD_TYPES = {
    "d": "double", "s": "string", "l": "bigint", "da": "array<double>", "sa": "array<string>", "json": "string",
}


def _union(branch: int, value: Column) -> Column:
    fields = [
        (value if field == _FIELD[branch] else F.lit(None)).cast(ddl).alias(field)
        for field, ddl in _FIELD_TYPES.items()
    ]
    return F.struct(F.lit(branch).alias("tag"), *fields).cast(UNION_DDL)


def _encoded(kind: str) -> Column:
    _, _, column, branch = KINDS[kind]
    if kind == "uint64":
        return F.transform(column, lambda v: _union(branch, u64_wrap(v)))
    return F.transform(column, lambda v: _union(branch, v))


def union_values(kinds: tuple[str, ...] = tuple(KINDS)) -> Column:
    """The values of a series as tagged unions, one of six branches (D1); no payload gives []."""
    arrays = [F.when(F.col("kind") == kind, _encoded(kind)) for kind in kinds]
    return F.coalesce(*arrays, F.array().cast(f"array<{UNION_DDL}>"))


def stamps_present(timestamps: Column) -> Column:
    """Timestamps, [] when there is no payload (D2); a null stamp is refused (D3)."""
    bad = F.exists(timestamps, lambda t: t.isNull())
    checked = F.when(bad, F.raise_error(F.lit("point without timestamp"))).otherwise(timestamps)
    return F.coalesce(checked, F.array().cast("array<bigint>"))


def union_records(series: DataFrame, kinds: tuple[str, ...] = tuple(KINDS)) -> DataFrame:
    """Series as the four-field records of the file, values as tagged unions."""
    return series.select(
        channel_or_default(F.col("channel")).alias("channel"),
        stamps_present(F.col("timestamps")).alias("timestamps"),
        union_values(kinds).alias("values"),
        tag_map(F.col("tags")).alias("tags"),
    )


def file_records(series: DataFrame) -> DataFrame:
    """Series as the container writer takes them: typed arrays, uint64 wrapped into longs."""
    wrapped = F.when(F.col("kind") == "uint64", F.transform("u64s", u64_wrap)).otherwise(F.col("longs"))
    return series.select(
        channel_or_default(F.col("channel")).alias("channel"),
        tag_map(F.col("tags")).alias("tags"),
        F.when(F.col("kind") == "uint64", "int").otherwise(F.col("kind")).alias("kind"),
        stamps_present(F.col("timestamps")).alias("timestamps"),
        "doubles", "strings", wrapped.alias("longs"), "double_arrays", "string_arrays", "jsons",
    )


def write_lake(series: DataFrame, path: str, mode: str = "append") -> None:
    """Series as Parquet partitioned by kind, so that reads by kind prune folders."""
    series.write.mode(mode).partitionBy("kind").parquet(path)
