"""Questions asked of delivered data (G1 to G8). All are partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.schema import CHANNEL_KEY, KINDS


def _one_kind():
    same = F.min("kind") == F.max("kind")
    return F.when(same, F.min("kind")).otherwise(F.raise_error(F.lit("mismatched point type for channel")))


def point_counts_by_channel(points: DataFrame) -> DataFrame:
    """Kind and number of points per channel name; two kinds in one channel are an error."""
    return points.groupBy("channel").agg(_one_kind().alias("kind"), F.count(F.lit(1)).alias("n"))


def series_counts_by_channel(series: DataFrame) -> DataFrame:
    """The same from packed series, without unpacking them (G1)."""
    return series.groupBy("channel").agg(
        _one_kind().alias("kind"), F.sum(F.coalesce(F.size("timestamps"), F.lit(0))).alias("n")
    )


def total_double_points(points: DataFrame, channel: str) -> DataFrame:
    """Number of double points of one channel; other kinds count 0."""
    return points.where(F.col("channel") == channel).agg(F.count_if(F.col("kind") == "double").alias("n"))


def request_sizes(series: DataFrame) -> DataFrame:
    """How many requests there are and how full; a channel's blocks in a request are one series."""
    merged = series.groupBy("shard", "request_id", *CHANNEL_KEY).agg(F.sum("n").alias("n"))
    return merged.groupBy("shard", "request_id").agg(
        F.count(F.lit(1)).alias("n_series"), F.sum("n").alias("n_points")
    )


def last_series_per_channel(series: DataFrame, order: str = "request_id") -> DataFrame:
    """The last series of each channel name, later requests replacing earlier ones.

    ``series`` has one row per channel and request, as ``merge_requests`` gives them.
    """
    rest = [F.col(c) for c in series.columns if c != "channel"]
    return series.groupBy("channel").agg(F.max_by(F.struct(*rest), F.col(order)).alias("s")).select("channel", "s.*")


def file_point_total(records: DataFrame) -> DataFrame:
    """Points in a series file, from whole records or from counts only."""
    n = F.col("n") if "n" in records.columns else F.size("timestamps")
    return records.agg(F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("total"))


def file_channels(records: DataFrame) -> DataFrame:
    """Channels present in a series file with their record counts."""
    return records.groupBy("channel").agg(F.count(F.lit(1)).alias("n"))


def file_values(records: DataFrame) -> DataFrame:
    """One row per stored value with its union branch."""
    flat = records.select(
        "channel", "tags", F.posexplode(F.arrays_zip("timestamps", "values")).alias("pos", "p")
    )
    return flat.select(
        "channel", "tags", F.col("pos").cast("bigint").alias("pos"),
        F.col("p.timestamps").alias("ts_ns"), "p.values.*",
    )

