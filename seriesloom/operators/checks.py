"""Consistency checks (C6, G2, A14 in report mode)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.schema import CHANNEL_KEY


def kind_conflicts(points: DataFrame, scope: str = "all") -> DataFrame:
    """Channels that show two kinds: in one batch, in one request, or anywhere (``all``).

    ``request`` takes series that carry shard and request_id, ``batch`` points or series with ``batch``.

    A set of at most seven kinds per channel is merged map-side, so hot channels do not matter.
    """
    keys = [*CHANNEL_KEY, *{"all": [], "batch": ["batch"], "request": ["shard", "request_id"]}[scope]]
    kinds = F.sort_array(F.collect_set("kind"))
    return (
        points.groupBy(*keys).agg(kinds.alias("kinds"))
        .withColumn("n_kinds", F.size("kinds").cast("bigint"))
        .where("n_kinds > 1")
    )


def refuse_conflicts(points: DataFrame, scope: str = "all") -> DataFrame:
    """The points, or a "mismatched types" error naming one offender."""
    for bad in kind_conflicts(points, scope).take(1):
        raise TypeError(f"mismatched types: {bad['channel']} {bad['tags_key']} has {list(bad['kinds'])}")
    return points


def length_report(df: DataFrame, channel: Column, timestamps: Column, values: Column) -> DataFrame:
    """Per channel how many series have as many timestamps as values."""
    equal = F.size(timestamps) == F.size(values)
    return df.groupBy(channel.alias("channel")).agg(
        F.count_if(equal).alias("ok_n"), F.count_if(~F.coalesce(equal, F.lit(False))).alias("bad_n")
    )
