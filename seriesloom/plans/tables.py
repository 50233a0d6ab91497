"""Channel tables derived from the given test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.functions.time import ts_from_datetime
from seriesloom.sources.points import (
    points_from_double_arrays,
    points_from_rows,
    points_from_string_arrays,
    points_from_wide,
    points_typed,
)

DAY_NS = 86_400 * 10**9


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(prefix: str, column: str):
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def ntz_ns(column: str):
    return ts_from_datetime(F.col(column), ntz=True)


def ev(spark, sf_dir) -> DataFrame:
    """Events: one double channel per event type, tagged with the user."""
    return points_from_rows(
        table(spark, sf_dir, "events"), named("ev.", "event_type"), "ts", "value",
        {"user_id": F.col("user_id")}, "event_id",
    )


def evs(spark, sf_dir) -> DataFrame:
    """Event properties: JSON text taken as it is, no tags."""
    return points_typed(
        table(spark, sf_dir, "events"), "struct", named("evs.", "event_type"), "ts", "props", None, "event_id"
    )


def li(spark, sf_dir) -> DataFrame:
    """Line items: a wide record of four channels."""
    return points_from_wide(
        table(spark, sf_dir, "lineitem"), "l_shipdate",
        {
            "li.quantity": "l_quantity", "li.extendedprice": "l_extendedprice",
            "li.discount": "l_discount", "li.returnflag": "l_returnflag",
        },
        {"returnflag": F.col("l_returnflag"), "linestatus": F.col("l_linestatus")},
    )


def emb(spark, sf_dir) -> DataFrame:
    """Embeddings: arrays of floats as double arrays."""
    return points_from_double_arrays(
        table(spark, sf_dir, "embeddings"), named("emb.", "label"),
        F.col("vec_id") * 1_000_000_000, "embedding", None, "vec_id",
    )


def conv(spark, sf_dir) -> DataFrame:
    """Conversation texts as string points."""
    stamp = F.col("conv_id") * 1_000_000_000 + F.col("turn")
    return points_from_rows(
        table(spark, sf_dir, "conversations"), named("conv.", "role"), stamp, "text",
        {"conv_id": F.col("conv_id")}, "turn",
    )


def conva(spark, sf_dir) -> DataFrame:
    """Role and text of each turn as a string array."""
    stamp = F.col("conv_id") * 1_000_000_000 + F.col("turn")
    return points_from_string_arrays(
        table(spark, sf_dir, "conversations"), F.lit("conva"), stamp, F.array("role", "text"), None, stamp
    )


def ordi(spark, sf_dir) -> DataFrame:
    """Orders: integer points."""
    return points_typed(
        table(spark, sf_dir, "orders"), "int", named("ord.", "o_orderpriority"), "o_orderdate", "o_custkey",
        {"status": F.col("o_orderstatus")}, "o_orderkey",
    )


def u64(spark, sf_dir) -> DataFrame:
    """Numbers near both ends of the unsigned 64 bit range."""
    top = F.lit(str(2**64 - 1)).cast("decimal(20,0)")
    number = F.when(F.col("event_id") % 2 == 0, top - F.col("event_id")).otherwise(F.col("event_id"))
    return points_typed(
        table(spark, sf_dir, "events"), "uint64", F.lit("u64"), "ts", number.cast("decimal(20,0)"), None, "event_id"
    )


def all_kinds(spark, sf_dir) -> DataFrame:
    """Points of every stored kind."""
    parts = [t(spark, sf_dir) for t in (ev, evs, emb, conv, conva, ordi, u64)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
