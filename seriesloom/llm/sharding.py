"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Rows are numbered within so many hash buckets.
BUCKETS = 4096
#: Equal rows are numbered in blocks of this many.
BLOCK = 4096
#: A prime under 2^31; products of two residues fit a long.
PRIME = (1 << 31) - 1
#: Multiplier and addend of each round, with the seed added.
ROUNDS = ((1_103_515_245, 12_345), (1_664_525, 1_013_904_223), (22_695_477, 1_566_083_941), (134_775_813, 907_633_385), (214_013, 2_531_011), (69_069, 362_437), (1_140_671_485, 12_820_163), (16_843_009, 826_366_247))
#: Walks are at most this long: below 1024 rows there are not more places outside, and above it the chance
#: of a longer one is under 2^-256. A longer one would raise an error.
WALK = 64


def _quotient(number: Column, by: int) -> Column:
    """Whole quotient, exact below 2^53."""
    return ((number - number % by) / by).cast("long")


def feistel(number: Column, side: int, seed: int, inverse: bool = False) -> Column:
    """A permutation of 0 .. side^2 - 1: in each round a mixed half is added, modulo ``side``, to the other half."""

    def mixed(half: Column, k: Column) -> Column:
        first = (half % PRIME * k["multiplier"] + k["addend"]) % PRIME
        return (first * first + k["addend"]) % PRIME % side

    def forward(halves: Column, k: Column) -> Column:
        return F.struct(halves["right"].alias("left"), ((halves["left"] + mixed(halves["right"], k)) % side).alias("right"))

    def back(halves: Column, k: Column) -> Column:
        return F.struct(((halves["right"] - mixed(halves["left"], k) + side) % side).alias("left"), halves["left"].alias("right"))

    rounds = [F.struct(F.lit(m).cast("long").alias("multiplier"), F.lit((a + seed) % PRIME).cast("long").alias("addend")) for m, a in ROUNDS]
    begin = F.struct(_quotient(number, side).alias("left"), (number % side).cast("long").alias("right"))
    return F.aggregate(F.array(*(rounds[::-1] if inverse else rounds)), begin, back if inverse else forward, lambda h: h["left"] * side + h["right"])


def permuted(number: Column, rows: int, seed: int, inverse: bool = False) -> Column:
    """A permutation of 0 .. rows - 1: numbers that fall outside walk on along their cycle.

    The square of ``side`` exceeds ``rows`` by less than twice its root, so hardly any number walks; the
    walk's expression is evaluated for those alone.
    """
    side = isqrt(max(rows - 1, 0)) + 1
    once = feistel(number.cast("long"), side, seed, inverse)
    again = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), once, lambda at, _: F.when(at < rows, at).otherwise(feistel(at, side, seed, inverse)))
    landed = F.when(again < rows, again).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long"))
    return F.when(once < rows, once).otherwise(landed)


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """doc_id, size, text_crc32, row_number of every row, and the number of rows.

    Row numbers follow from the rows' content alone, not from files, partitions or executors: rows are hashed
    into buckets, ordered within them, and offset by the rows of the buckets before, of which there are
    ``BUCKETS`` whatever the table. Rows alike in id and text are counted first and then numbered in blocks, so
    they don't meet in one bucket. Texts stay where they are; their size and hashes travel.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.octet_length(text).cast("long") + 8
    rows = docs.select(F.col(id_col).alias("doc_id"), size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_text"))
    same = ["doc_id", "size", "text_crc32", "_text"]
    blocks = rows.groupBy(*same).agg(F.count("*").alias("_n"))
    starts = F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(BLOCK).cast("long"))
    blocks = blocks.withColumn("_start", F.explode(starts)).withColumn("_n", F.least(F.lit(BLOCK), F.col("_n") - F.col("_start")))
    blocks = blocks.withColumn("_bucket", F.pmod(F.xxhash64(*same, "_start"), F.lit(BUCKETS)).cast("int"))
    blocks = stored(blocks, "shard-blocks")
    totals = blocks.groupBy("_bucket").agg(F.sum("_n").alias("_rows"))
    total = totals.agg(F.sum("_rows")).first()[0] or 0
    offsets = totals.select("_bucket", (F.sum("_rows").over(Window.orderBy("_bucket")) - F.col("_rows")).alias("_offset"))
    before = Window.partitionBy("_bucket").orderBy(*(F.col(c).asc_nulls_first() for c in same), "_start").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(F.broadcast(offsets), "_bucket")
    first = F.col("_offset") + F.col("_first")
    return placed.select(*same, F.explode(F.sequence(first, first + F.col("_n") - 1)).alias("row_number")).drop("_text"), total


def shards(docs: DataFrame, n_shards: int, seed: int = 17, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row.

    A row's number is permuted; the place modulo ``n_shards`` is its shard and the quotient its slot, so shards
    differ by one row at most and slots have no gap. Null ids are numbered like others, a null text is empty,
    rows alike in everything get places of their own. An empty table gives no rows; more shards than rows
    leave some empty.
    """
    rows, total = numbered(docs, id_col, text_col)
    place = rows.withColumn("_place", permuted(F.col("row_number"), total, seed))
    return place.select("doc_id", "size", "text_crc32", (F.col("_place") % n_shards).cast("int").alias("shard"), _quotient(F.col("_place"), n_shards).alias("slot"))


def row_at(shard: Column, slot: Column, rows: int, n_shards: int, seed: int = 17) -> Column:
    """The row number that lies in a slot of a shard."""
    return permuted(slot.cast("long") * n_shards + shard, rows, seed, inverse=True)


def write_shards(docs: DataFrame, path: str, n_shards: int, seed: int = 17, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write id and text as Parquet, a folder per shard, in order of slots within each file."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.crc32(text.cast("binary")).alias("text_crc32")).distinct()
    place = shards(docs, n_shards, seed, id_col, text_col).withColumnRenamed("doc_id", "_id").withColumnRenamed("text_crc32", "_crc")
    joined = place.join(texts, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_crc") == F.col("text_crc32")))
    dealt = joined.select("shard", "slot", "doc_id", "text").repartition("shard", F.shiftright("slot", 16)).sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").parquet(path)
