"""Batches of an unbounded stream: count and delay bounds carried from micro-batch to micro-batch (C2, C3 live)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from seriesloom.operators.segments import DelayRule, segment
from seriesloom.operators.spread import ROWS_PER_CELL, null_safe
from seriesloom.schema import CHANNEL_KEY

_NEVER = 2**62  # a delay that no clock reaches
_CARRIED = ["_x", "_y", "_first"]  # time of the last close, points waiting, number of the open batch


@dataclass(frozen=True)
class LiveBatches:
    """Numbers the batches of every channel of a stream of micro-batches.

    What a channel carries to the next micro-batch are three numbers, a row of the state table: the time of its last
    close, the points waiting and the open batch. Within a micro-batch Spark sorts the points and walks them as in
    :func:`segment`, so a hot channel is worked on by many tasks. Nothing fires without a point, so no timer is needed.

    Both tables lie under ``path``: ``batches/batch_id=N`` and two states, the one that a micro-batch started from and
    the one it leaves. A repeated micro-batch starts from the same state and replaces its own rows, so its numbers are
    the same. The state has a row per channel seen so far and is written whole each time.
    """

    path: str
    max_points: int
    delay_ns: int | None = None
    arrival: str = "arrival_ns"
    rows_per_cell: int = ROWS_PER_CELL

    @property
    def clock(self) -> str:
        return "seq" if self.delay_ns is None else self.arrival

    @property
    def rule(self) -> DelayRule:
        return DelayRule(self.max_points, _NEVER if self.delay_ns is None else self.delay_ns)

    def _state_folder(self, number: int) -> str:
        return f"{self.path}/states/{number % 2}"

    def state(self, spark: SparkSession, number: int) -> DataFrame | None:
        """What micro-batch ``number`` starts from."""
        if number == 0:
            return None
        state = spark.read.parquet(self._state_folder(number - 1))
        other = F.raise_error(F.lit(f"the state before micro-batch {number} is missing under {self.path}")).cast("bigint")
        return state.where(F.when(F.col("batch_id") == number - 1, True).otherwise(other.isNotNull()))

    def write(self, points: DataFrame, number: int) -> None:
        """Number one micro-batch; points go by ``arrival``, then ``seq``."""
        spark, folder = points.sparkSession, f"{self.path}/batches/batch_id={number}"
        before = self.state(spark, number)
        order = list(dict.fromkeys([self.clock, "seq"]))
        points = points.persist()  # read by the hot-key pass and by the walk
        try:
            numbered = segment(points, CHANNEL_KEY, order, self.clock, self.rule, "batch", self.rows_per_cell, before)
            numbered.write.mode("overwrite").parquet(folder)
        finally:
            points.unpersist()
        after = self._after(spark.read.parquet(folder), before).withColumn("batch_id", F.lit(number).cast("bigint"))
        after.write.mode("overwrite").parquet(self._state_folder(number))

    def _after(self, numbered: DataFrame, before: DataFrame | None) -> DataFrame:
        """The state that numbered points leave, from their last two batches, and that of channels that had none.

        A batch ends with the point that closes it, so the last close is the end of the batch before the last one, or
        of the last one if that is full or ended late. Batches are counted where their points are; of each channel
        the last two meet.
        """
        batches = numbered.groupBy(*CHANNEL_KEY, "batch").agg(
            F.count(F.lit(1)).alias("n"), F.min(self.clock).alias("begin"), F.max(self.clock).alias("end")
        )
        place = F.row_number().over(W.partitionBy(*CHANNEL_KEY).orderBy(F.desc("batch")))
        last = batches.withColumn("_place", place).where(F.col("_place") <= 2)
        at = lambda place, value: F.max(F.when(F.col("_place") == place, F.col(value)))
        last = last.groupBy(*CHANNEL_KEY).agg(
            at(1, "batch").alias("batch"), at(1, "n").alias("n"), at(1, "begin").alias("begin"),
            at(1, "end").alias("end"), at(2, "end").alias("closed"),
        )
        if before is None:
            last = last.select("*", *[F.lit(None).cast("bigint").alias(c) for c in _CARRIED])
        else:
            last = null_safe(last, before.select(*CHANNEL_KEY, *_CARRIED), CHANNEL_KEY)
        same = F.col("_first").eqNullSafe(F.col("batch"))  # the batch was open before
        waiting = F.col("n") + F.when(same, F.col("_y")).otherwise(0)
        # a channel's clock starts with its first point
        start = F.coalesce("closed", F.when(F.col("_first").isNotNull(), F.col("_x")).otherwise(F.col("begin")))
        full = (waiting >= self.max_points) | (F.col("end") - start > self.rule.delay)
        after = last.select(
            *CHANNEL_KEY, F.when(full, F.col("end")).otherwise(start).cast("bigint").alias("_x"),
            F.when(full, 0).otherwise(waiting).cast("bigint").alias("_y"),
            (F.col("batch") + full.cast("int")).cast("bigint").alias("_first"),
        )
        if before is None:
            return after
        seen = after.select(*CHANNEL_KEY, F.lit(True).alias("_seen"))
        silent = null_safe(before.select(*CHANNEL_KEY, *_CARRIED), seen, CHANNEL_KEY).where("_seen is null").drop("_seen")
        return after.unionByName(silent)

    def read(self, spark: SparkSession) -> DataFrame:
        """All numbered points so far."""
        return spark.read.parquet(f"{self.path}/batches")


def batch_stream(
    points: DataFrame, path: str, checkpoint: str, max_points: int, delay_ns: int | None = None,
    arrival: str = "arrival_ns", rows_per_cell: int = ROWS_PER_CELL,
) -> DataStreamWriter:
    """Number the batches of each channel of a streaming DataFrame into tables under ``path``.

    The result is a writer to trigger and start; :class:`LiveBatches` tells what it writes and reads it.
    """
    live = LiveBatches(path, max_points, delay_ns, arrival, rows_per_cell)
    return points.writeStream.option("checkpointLocation", checkpoint).foreachBatch(live.write)
