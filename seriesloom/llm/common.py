"""What the operators of this folder share: bounded Arrow slices, stored intermediates, salted joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import scratch_dir

#: Bytes of text that a Python step turns into objects at a time; a longer text stands alone.
SLICE_BYTES = 2 << 20

#: The six characters of ``[\x20\x09-\x0D]``.
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write to the shared folder and read again: later reads neither repeat the work nor need its executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``limit`` bytes in ``column``, one row at least."""
    begin, held = 0, 0
    for row, size in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
        if row > begin and held + size > limit:
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


def map_texts(docs: DataFrame, schema: str, work: Callable, id_col: str = "doc_id", text_col: str = "text", raw: bool = False) -> DataFrame:
    """``work(list of texts) -> dict of columns`` over every row, a bounded slice at a time.

    Only the id and the text are read, so other columns and their names don't matter. A null text is the
    empty text. ``raw`` hands over UTF-8 bytes. ``schema`` has the result's columns after the id.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (text.cast("binary") if raw else text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    types = arrow_types(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                made = work(part.column("text").to_pylist())
                yield pa.record_batch([part.column("doc_id"), *(pa.array(made[name], type=of) for name, of in types.items())], names=["doc_id", *types])
            pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, f"doc_id {kind}, {schema}")


def arrow_types(schema: str) -> dict[str, pa.DataType]:
    return {field.name: field.type for field in to_arrow_schema(StructType.fromDDL(schema))}


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], purpose: str = "groups") -> DataFrame:
    """Inner join of per-group facts back to the rows of their groups, for groups of any size.

    The facts, one row per key, are written and read again, so that both sides of the join come from an exchange
    of its own: adaptive execution then splits the partitions of large groups, and broadcasts the facts only when
    it has measured them to be small.
    """
    return rows.join(stored(groups, purpose), keys)


def words(text: Column) -> Column:
    """Number of runs of other than white space; null counts as empty."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]++", "x")
    return F.length(F.translate(marked, WHITE, "")).cast("long")


def kept_rows(docs: DataFrame, decide: Callable[[DataFrame, str], DataFrame], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that ``decide(rows, id column)`` marks ``kept`` in its ``doc_id`` and ``kept``.

    Rows are told apart by id and text, a null id last; of rows that agree in both, one stays.
    """
    mark = "_kept_rows_id"
    own = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text"))
    marked = docs.withColumn(mark, own)
    kept = decide(marked, mark).where("kept").select(F.col("doc_id").alias(mark))
    return marked.dropDuplicates([mark]).join(kept, mark, "left_semi").select(*docs.columns)
