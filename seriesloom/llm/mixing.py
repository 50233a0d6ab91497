"""Mixing sources to target weights by capped water-filling, with seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, words

#: Weights given to the sources in code point order, over and over.
WEIGHTS = (3, 1, 2)
#: Words of the mix, in words of all sources.
SHARE = 1.5
#: Times a source may be repeated.
EPOCHS = 2
#: Ranges of the seeded order in which words are counted before rows are.
RANGES = 4096


def _order(id_col: str, text_col: str, seed: int) -> Column:
    """A number of 60 bits per row, the same in every run and wherever the row lies."""
    parts = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col), F.lit("")))
    return F.conv(F.substring(F.md5(parts), 1, 15), 16, 10).cast("long")


def water_fill(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size, target from one row per source with its size.

    A source gets ``level * weight`` words, ``epochs`` times its size at most; the level is the one at which the
    targets use up ``share`` of all words. It is found from the sources in order of cap by weight: those before
    it are clamped, and what they leave is dealt to the others by weight, which is where repeated clamping and
    resharing ends. A share above ``epochs`` clamps every source. One row per source passes through one task.
    """
    ranked = sizes.withColumn("nth", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1)
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("nth") % len(weights) + 1).cast("int"))
    caps = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * epochs)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "nth").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    clamped, used = F.coalesce(F.sum("cap").over(by_ratio), F.lit(0)), F.coalesce(F.sum("weight").over(by_ratio), F.lit(0))
    level = (F.sum("source_size").over(everything) * share - clamped) / (F.sum("weight").over(everything) - used)
    levels = caps.withColumn("here", level)
    free = F.col("here") * F.col("weight") < F.col("cap")
    levels = levels.withColumn("level", F.min(F.when(free, F.struct((F.col("cap") / F.col("weight")).alias("r"), "nth", "here"))).over(everything)["here"])
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap").cast("double")))
    return levels.select("source", "source_size", target.alias("target"))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, **fill) -> tuple[DataFrame, DataFrame]:
    """Per row (doc_id, source, size, place) and per source (source_size, target, whole, cut).

    Every row of a source is taken ``whole`` times and the rows up to place ``cut`` once more. The place is a
    seeded hash of id and text, and the cut is where the words in that order come closest to the target: words
    are summed per range of places, and only the rows of the one range that holds the cut are put in order, so
    no task sees a source. Rows alike in id and text share a place and go together.
    """
    place = _order(id_col, text_col, seed)
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"), place.alias("place")), "mix-rows")
    sums = stored(rows.withColumn("range", F.shiftright("place", 48).cast("int")).groupBy("source", "range").agg(F.sum("size").alias("words")), "mix-ranges")
    targets = water_fill(sums.groupBy("source").agg(F.sum("words").alias("source_size")), **fill)
    size, want = F.col("source_size"), F.col("target")
    times = sum((want >= size * k).cast("int") for k in range(1, fill.get("epochs", EPOCHS) + 1))
    whole = F.when(size > 0, times).otherwise(0)
    targets = stored(targets.withColumn("whole", whole).withColumn("goal", want - F.col("whole") * size), "mix-targets")
    alike = F.col("source").eqNullSafe(F.col("s"))
    facts = targets.select(F.col("source").alias("s"), "goal")
    in_order = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    held = sums.withColumn("before", F.coalesce(F.sum("words").over(in_order), F.lit(0))).join(facts, alike)
    held = held.where((F.col("before") <= F.col("goal")) & (F.col("before") + F.col("words") > F.col("goal"))).select("s", "range", "before", "goal")
    fine = rows.withColumn("r", F.shiftright("place", 48).cast("int")).join(held, alike & (F.col("r") == F.col("range")))
    fine = fine.groupBy("source", "before", "goal", "place").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    fine = fine.withColumn("after", F.col("before") + F.sum("words").over(upto))
    near = F.abs(F.col("after") - F.col("goal")) < F.abs(F.col("after") - F.col("words") - F.col("goal"))
    taken = (F.col("after") <= F.col("goal")) | (near & (F.col("after") - F.col("words") <= F.col("goal")))
    cuts = fine.groupBy(F.col("source").alias("s")).agg(F.max(F.when(taken, F.col("place"))).alias("cut"), F.min("place").alias("first"))
    # no row of the range is taken: the cut lies just before its first row
    cuts = cuts.select("s", F.coalesce("cut", F.col("first") - 1).alias("cut"))
    known = targets.join(cuts, alike, "left").drop("s").withColumn("cut", F.coalesce("cut", F.when(F.col("goal") > 0, F.lit(1 << 60)).otherwise(F.lit(-1))))
    return rows, stored(known, "mix-cuts")


def copies(place: Column) -> Column:
    return F.col("whole") + (place <= F.col("cut")).cast("int")


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, **fill) -> DataFrame:
    """doc_id, source, size, source_size, target, copies for every row; see :func:`plan_mix`.

    A null text has no words, null is a source of its own, a source without words has target 0 and its rows no
    copies. An empty table gives no rows.
    """
    rows, plan = plan_mix(docs, id_col, text_col, source_col, seed, **fill)
    plan = plan.withColumnRenamed("source", "s")
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("s")))
    return joined.select("doc_id", "source", "size", "source_size", "target", copies(F.col("place")).alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, **fill) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns; texts are not shuffled."""
    _, plan = plan_mix(docs, id_col, text_col, source_col, seed, **fill)
    plan = plan.select(F.col("source").alias("_mix_s"), F.col("whole").alias("_mix_whole"), F.col("cut").alias("_mix_cut"))
    n = F.col("_mix_whole") + (_order(id_col, text_col, seed) <= F.col("_mix_cut")).cast("int")
    joined = docs.join(plan, F.col(source_col).eqNullSafe(F.col("_mix_s"))).withColumn("_mix_n", n).where("_mix_n > 0")
    return joined.withColumn("_mix_i", F.explode(F.sequence(F.lit(1), F.col("_mix_n")))).select(*docs.columns)
