"""Split hot keys into ordered cells, so that no task ever holds a whole hot channel.

Batching needs the order of points inside a channel. A window over the channel would put a
channel with a third of all rows into one task. Here every hot key is cut into cells at sampled
quantiles of its order columns: cells follow each other in order and hold about as many rows
each, however the order column is spread; each is worked on in its own task, and small per-cell
facts (counts, states) are carried from cell to cell.

Which cuts are used changes the balance only, never the result.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesloom.session import scratch_dir

ROWS_PER_CELL = 1_000_000

# Sampled rows per cell: a cell is then off its size by an eighth or so.
SAMPLES = 64

# Bytes of texts and arrays after which a cell is full, however few its rows are.
CELL_BYTES = 128 << 20

SEED = 7  # of the sample

# At most this many cuts are broadcast; beyond them, cells grow. Sixteen bytes and the order each.
MAX_CUTS = 1 << 18

# A row is compared with the bounds of this many cells of its key, or groups of cells, at a time.
CELLS_PER_JOIN = 32


def present(column: str) -> Column:
    """The column, refused where it is null: rows without an order have no place."""
    return F.when(F.col(column).isNull(), F.raise_error(F.lit(f"{column} must not be null"))).otherwise(F.col(column))


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on keys that may be null; the right side's copies of the keys are dropped."""
    other = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return left.join(other, on, how).drop(*[f"_r_{k}" for k in keys])


def row_bytes(df: DataFrame) -> Column | None:
    """Bytes of a row's texts and arrays, about; None where all columns are narrow."""

    wide = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            wide.append(F.octet_length(F.col(f.name)))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            add = lambda total, v: total + F.coalesce(F.octet_length(v), F.lit(0)) + 8
            wide.append(F.aggregate(F.col(f.name), F.lit(0).cast("bigint"), add))
        elif isinstance(f.dataType, T.ArrayType):
            wide.append(8 * F.size(F.col(f.name)))
    total = F.lit(0).cast("bigint")
    for size in wide:
        total = total + F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).cast("bigint")
    return total if wide else None


def hot_cuts(df: DataFrame, keys: list[str], order: list[str], rows_per_cell: int) -> pa.Table:
    """``_kid`` and the order columns of every cut of the hot keys, in order; the first of them alone if it tells the cuts apart.

    One pass keeps a random sample, in which a row stands for ``rows_per_cell / SAMPLES`` rows or for
    ``CELL_BYTES / SAMPLES`` bytes, whichever is reached first: wide rows are drawn more often, and rows that are
    alike no more often than others. All else reads the kept sample. It is counted per key; without hot keys that is
    all, and the caller's plan needs neither the cuts nor a join. The sampled rows of hot keys are then sorted into ranges
    of key and order, which Spark keeps even whatever the keys are, and numbered by their place in the range and the rows
    of the key in ranges before; every row that closes a cell's share is a cut. No key's sample gathers in a task, and as
    the counts tell the number of cuts beforehand, they are thinned before any leaves the executors: ``MAX_CUTS`` at most.
    Keys are kept as hashes: a collision would merely cut another key too.
    """
    rate = max(1, rows_per_cell // SAMPLES)
    share = max(1, rows_per_cell // rate)
    sample = df
    if rate > 1:
        chance, size = F.lit(1.0 / rate), row_bytes(df)
        if size is not None:
            chance = F.greatest(chance, size * F.lit(SAMPLES / CELL_BYTES))
        sample = df.where(F.rand(SEED) < chance)
    sample = kept(sample.select(F.xxhash64(*keys).alias("_kid"), *order), "sample")
    counts = sample.groupBy("_kid").agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") >= share)
    known = hot.agg(F.count(F.lit(1)), F.sum(F.call_function("div", F.col("_n"), F.lit(share).cast("bigint")))).first()
    if not known[0]:
        return sample.limit(0).toArrow()
    share *= max(1, -(-known[1] // MAX_CUTS))
    ranged = sample.join(hot.select("_kid"), "_kid", "left_semi").repartitionByRange("_kid", *order)
    ranged = kept(ranged.withColumn("_range", F.spark_partition_id()), "cuts")
    sizes = ranged.groupBy("_kid", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("_kid").orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.select("_kid", "_range", F.coalesce(before, F.lit(0)).alias("_before"))  # a row per range of a hot key
    here = W.partitionBy("_range", "_kid").orderBy(*order)
    alike = F.lag(order[0], max(1, share // 8)).over(here).eqNullSafe(F.col(order[0]))  # with an eighth of the cell before
    placed = ranged.withColumn("_i", F.row_number().over(here)).withColumn("_alike", alike).join(sizes, ["_kid", "_range"])
    placed = placed.withColumn("_i", F.col("_i") + F.col("_before")).where(F.col("_i") % share == 0)
    return _shortest(placed.orderBy("_kid", "_i").select("_kid", *order, "_alike").toArrow(), order[0])


def _shortest(cuts: pa.Table, first: str) -> pa.Table:
    """``cuts`` by ``first`` alone where that serves as well: rows are then told apart without their other columns."""
    short = cuts.select(["_kid", first])
    apart = short.group_by(["_kid", first]).aggregate([]).num_rows == cuts.num_rows
    return short if apart and not pc.any(cuts["_alike"]).as_py() else cuts.drop_columns(["_alike"])


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read from there."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _cell_bounds(cuts: DataFrame) -> DataFrame:
    """``_cell`` with ``_from`` and ``_upto``, its first place and that of the next cell; null where there is none."""
    lowest = F.lit(None).cast(cuts.schema["_from"].dataType).alias("_from")
    along = W.partitionBy("_kid").orderBy("_from")
    return cuts.unionByName(cuts.select("_kid", lowest).distinct()).select(
        "_kid", (F.row_number().over(along) - 1).cast("bigint").alias("_cell"), "_from", F.lead("_from").over(along).alias("_upto")
    )


def split_hot_keys(
    df: DataFrame, keys: list[str], order: list[str], rows_per_cell: int = ROWS_PER_CELL
) -> tuple[DataFrame, int]:
    """Add ``_cell`` (null for an ordinary key); also tell how many cells a key may have, 0 if no key is hot.

    A row's cell is found by joins with broadcast bounds, which Spark compiles: of the groups of cells first where a
    key has more than ``CELLS_PER_JOIN``, then of the cells of that group.
    """
    cuts = hot_cuts(df, keys, order, rows_per_cell)
    if cuts.num_rows == 0:
        return df.withColumn("_cell", F.lit(None).cast("bigint")), 0
    by = cuts.column_names[1:]
    here = F.col(by[0]) if len(by) == 1 and cuts[by[0]].null_count == 0 else F.struct(*by)
    bounds = _cell_bounds(df.sparkSession.createDataFrame(cuts).select("_kid", here.alias("_from")))
    most, width = pc.max(pc.value_counts(cuts["_kid"]).field("counts")).as_py() + 1, 1
    while width * CELLS_PER_JOIN < most:
        width *= CELLS_PER_JOIN
    placed = df.withColumn("_row_kid", F.xxhash64(*keys)).withColumn("_here", here)
    # a null place comes before all cuts
    inside = F.coalesce(F.col("_here") >= F.col("_from"), F.col("_from").isNull()) & F.coalesce(F.col("_here") < F.col("_upto"), F.lit(True))
    top = True
    while width:
        part = lambda w: F.call_function("div", F.col("_cell"), F.lit(w).cast("bigint"))
        groups = bounds.groupBy("_kid", part(width * CELLS_PER_JOIN).alias("_above"), part(width).alias("_part")).agg(
            F.min_by("_from", "_cell").alias("_from"), F.max_by("_upto", "_cell").alias("_upto")
        )
        on = (F.col("_row_kid") == F.col("_kid")) & inside
        placed = placed.join(F.broadcast(groups), on if top else on & (F.col("_cell") == F.col("_above")), "left")
        placed = placed.withColumn("_cell", F.col("_part")).drop("_kid", "_above", "_part", "_from", "_upto")
        top, width = False, width // CELLS_PER_JOIN
    return placed.drop("_row_kid", "_here"), cuts.num_rows + 1


def rank_in_key(
    df: DataFrame, keys: list[str], order: str, name: str = "rank",
    rows_per_cell: int = ROWS_PER_CELL, ties: tuple[str, ...] = (),
) -> DataFrame:
    """Exact 0-based position of each row inside its key, in ``order``, without a task per key.

    Position = position inside the cell + number of rows in earlier cells. The second term is a
    running sum over one row per cell of hot keys only, which is broadcast like the cuts; without hot keys this is a plain window.
    A null in ``order`` is an error; keys may be null.
    """
    df = df.withColumn(order, present(order))
    by = [order, *ties]
    cells, any_hot = split_hot_keys(df, keys, by, rows_per_cell)
    if not any_hot:
        inside = F.row_number().over(W.partitionBy(*keys).orderBy(*by)) - 1
        return df.withColumn(name, inside.cast("bigint"))
    place = ["_cell", *keys]  # the cell first: it tells the rows of a hot key apart when sorting
    inside = F.row_number().over(W.partitionBy(*place).orderBy(*by)) - 1
    earlier = W.partitionBy(*keys).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    before = (
        cells.where(F.col("_cell").isNotNull())
        .groupBy(*place)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*place, F.sum("_n").over(earlier).alias("_before"))
    )
    return (
        null_safe(cells.withColumn("_inside", inside), F.broadcast(before), place)
        .withColumn(name, (F.col("_inside") + F.coalesce("_before", F.lit(0))).cast("bigint"))
        .drop("_cell", "_inside", "_before")
    )
