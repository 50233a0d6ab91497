"""Cells of hot keys: by rows, however many are alike, and by bytes."""

from contextlib import redirect_stdout
from io import StringIO

import pytest
from pyspark.sql import functions as F

from seriesloom.operators import packing, spread


def largest(cells, size):
    return cells.groupBy("_cell").agg(F.sum(size).alias("n")).agg(F.max("n")).first()[0]


def test_rows_that_are_alike_are_cut(spark):
    """Ten instants of 6400 equal rows: a cell holds a few instants."""
    rows = spark.range(64_000).select(F.lit("c").alias("k"), (F.col("id") % 10).alias("seq"))
    cells, n = spread.split_hot_keys(rows, ["k"], ["seq"], 6400)
    assert n > 5 and largest(cells, F.lit(1)) <= 3 * 6400
    ranked = spread.rank_in_key(rows, ["k"], "seq", rows_per_cell=6400)
    assert ranked.agg(F.count_distinct("rank"), F.min("rank"), F.max("rank")).first() == (64_000, 0, 63_999)
    assert ranked.where("seq != rank div 6400").isEmpty()


def test_wide_rows_are_cut_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(spread, "CELL_BYTES", 1 << 17, raising=False)
    sizes = [37 * n % 1900 for n in range(2000)]
    texts = spark.range(2000).select(
        F.lit("c").alias("channel"), F.lit("").alias("tags_key"), F.col("id").alias("seq"), F.col("id").alias("ts_ns"),
        F.repeat(F.lit("x"), (37 * F.col("id") % 1900).cast("int")).alias("v_string"),
    )
    cells, n = spread.split_hot_keys(texts, ["channel"], ["seq"])
    assert n > 5 and largest(cells, F.length("v_string")) < 3 << 17
    found = packing.batch_by_size(texts, 50, 20_000, ("string",)).orderBy("seq").select("batch").collect()
    want, batch, points, held = [], 0, 0, 0
    for size in sizes:
        if points and (points == 50 or held + size + packing.POINT_BYTES > 20_000):
            batch, points, held = batch + 1, 0, 0
        points, held = points + 1, held + size + packing.POINT_BYTES
        want.append(batch)
    assert [r.batch for r in found] == want


@pytest.mark.parametrize("alike", [1, 400])
def test_cells_of_many_cuts_are_found_by_joins(spark, monkeypatch, alike):
    """Sixty cells of one key, by several levels of joins; other columns are read only where the first does not suffice."""
    monkeypatch.setattr(spread, "CELLS_PER_JOIN", 3, raising=False)
    rows = spark.range(6000).select(
        F.when(F.col("id") < 5990, "hot").otherwise("rare").alias("k"), F.expr(f"id div {alike}").alias("seq"),
        F.xxhash64("id").alias("tie"),
    )
    cells, n = spread.split_hot_keys(rows, ["k"], ["seq", "tie"], 100)
    found = cells.orderBy("seq", "tie").collect()
    assert [r._cell for r in found if r.k == "rare"] == [None] * 10
    hot = [r._cell for r in found if r.k == "hot"]
    sizes = [hot.count(c) for c in range(n)]
    assert n == 60 and hot == sorted(hot) and sum(sizes) == 5990 and max(sizes) <= 200
    with redirect_stdout(StringIO()) as plan:
        cells.select("k", "_cell").explain()
    assert "lambda" not in plan.getvalue() and ("xxhash64(id" in plan.getvalue()) == (alike > 1)
