"""Spool folder of finished series files into a dataset table."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from seriesloom.sources import codec, series_avro
from seriesloom.sources.series_avro import READ_DDL, open_fs
from seriesloom.streaming.sinks import BatchId, TableSink, batch_folder, exists

_LISTING = "path string, modificationTime timestamp, length bigint, content binary"
SPLIT_BYTES = 128 << 20  # bytes of a file that one task decodes
_ERROR_CHARS = 1000
# Rows of a split are its series, marked ``part='series'``, and one row ``part='verdict'`` with its error, if any.
_SPLIT_DDL = f"{READ_DDL}, start bigint, error string, part string"
# Two writers are open per task, so that series need no sort by ``part`` before they are written.
_OPEN_WRITERS_CONF = "spark.sql.maxConcurrentOutputFileWriters"


def _split_rows(batch: pa.RecordBatch, schema: pa.Schema, made: dict[str, pa.Array]) -> pa.RecordBatch:
    given = {name: batch.column(name) for name in batch.schema.names} if batch is not None else {}
    count = batch.num_rows if batch is not None else 1
    columns = {**given, **made}
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(count, f.type) for f in schema], schema=schema)


def _decoder(schema: pa.Schema, read_schema: pa.Schema):
    """Decode the blocks that begin in each split; sizes, sync markers and checksums are tested on the way."""

    def series(path: str, start: int, length: int, stop: int) -> Iterator[pa.RecordBatch]:
        fs, plain = open_fs(path)
        with fs.open_input_file(plain) as file:
            if file.size() != length:
                raise ValueError(f"the file has {file.size()} bytes and was listed with {length}")
            container = codec.Container(file, length)
            dataset = container.metadata.get(series_avro.DATASET_KEY)
            extra = {"dataset_id": dataset and dataset.decode(), "file": path}
            yield from series_avro.record_batches(container, start, stop, read_schema, extra)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for split in batch.to_pylist():
                error = None
                try:
                    for rows in series(**split):
                        yield _split_rows(rows, schema, {"part": pa.array(["series"] * rows.num_rows)})
                except Exception as e:  # noqa: BLE001 - a bad file stays, the others go on
                    error = f"{type(e).__name__}: {e}"[:_ERROR_CHARS]
                verdict = {
                    "file": [split["path"]], "start": [split["start"]], "error": [error], "part": ["verdict"]
                }
                yield _split_rows(None, schema, {n: pa.array(v, schema.field(n).type) for n, v in verdict.items()})

    return decode


def _delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            fs, plain = open_fs(path)
            if fs.get_file_info(plain).is_file:
                fs.delete_file(plain)
        yield batch


@dataclass
class SpoolIngest:
    """Watch ``spool`` for finished files, append their series to ``table``, then delete them.

    A file is deleted only after its batch is in the table. A file that cannot be read stays
    where it is, is listed in ``errors``, and does not hold up the others. A batch repeated
    after a failure finds itself complete in the table and only deletes what is left. A file of no bytes is
    passed over by Spark's listing: it stays and is no error.

    Every file is read once, in splits of ``split_bytes`` decoded by tasks of their own. Series and a verdict per
    split are staged by one job; a file counts only if all its splits are sound. Without a bad file, the staged
    series become the batch by renaming; otherwise those of sound files are copied from the staged table.
    """

    spool: str
    table: TableSink
    checkpoint: str
    delete: bool = True
    max_files: int = 1000
    errors_path: str | None = None
    split_bytes: int = SPLIT_BYTES

    def _paths(self, spark: SparkSession) -> DataFrame:
        # The content column is pruned, so the listing reads no file.
        files = spark.readStream.format("binaryFile").schema(_LISTING).option("pathGlobFilter", "*.avro")
        return files.option("maxFilesPerTrigger", self.max_files).load(self.spool).select("path", "length")

    def splits(self, paths: DataFrame) -> DataFrame:
        """path, start, length, stop: the ranges of bytes whose blocks one task decodes."""
        last = F.greatest(F.col("length") - F.lit(1), F.lit(0)).cast("bigint")
        starts = F.sequence(F.lit(0).cast("bigint"), last, F.lit(self.split_bytes).cast("bigint"))
        split = paths.select("path", "length", F.explode(starts).alias("start"))
        return split.select("path", "start", "length", F.least(F.col("start") + F.lit(self.split_bytes), "length").alias("stop"))

    def _stage(self, paths: DataFrame, batch_id: int, checks: str) -> str:
        """Decode the splits once: their series into the staging folder of the batch, their verdicts into ``checks``."""
        spark = paths.sparkSession
        schema = to_arrow_schema(StructType.fromDDL(_SPLIT_DDL))
        read_schema = to_arrow_schema(StructType.fromDDL(READ_DDL))
        splits = self.splits(paths)
        # The number is given because splits are tiny rows: left to itself, adaptive execution would put
        # them all into one partition.
        splits = splits.repartition(max(1, splits.count()))
        decoded = splits.mapInArrow(_decoder(schema, read_schema), _SPLIT_DDL)
        staging = self.table.staging(batch_id)
        before = spark.conf.get(_OPEN_WRITERS_CONF)
        spark.conf.set(_OPEN_WRITERS_CONF, "2")
        try:
            sized = decoded.withColumn("n", F.size("timestamps").cast("bigint"))
            sized.write.mode("overwrite").partitionBy("part").parquet(staging)
        finally:
            spark.conf.set(_OPEN_WRITERS_CONF, before)
        verdicts = spark.read.schema(_SPLIT_DDL).parquet(f"{staging}/part=verdict").groupBy(F.col("file").alias("path"))
        found = verdicts.agg(F.min_by("error", F.when(F.col("error").isNotNull(), F.col("start"))).alias("error"))
        found.select("path", F.col("error").isNull().alias("ok"), "error").write.mode("overwrite").parquet(checks)
        return staging

    def _ingest(self, paths: DataFrame, batch_id: int) -> None:
        spark = paths.sparkSession
        checks = batch_folder(self.errors_path, batch_id)
        if not self.table.holds(spark, batch_id):
            staging = self._stage(paths, batch_id, checks)
            ddl = f"{READ_DDL}, n bigint"
            series, found = f"{staging}/part=series", spark.read.parquet(checks)
            if found.where("not ok").isEmpty() and exists(series):
                self.table.publish(series, batch_id)
            else:
                staged = spark.read.schema(ddl).parquet(series) if exists(series) else spark.createDataFrame([], ddl)
                sound = found.where("ok").select(F.col("path").alias("file"))
                self.table.write(staged.join(sound, "file", "left_semi").select(*staged.columns), batch_id)
            self.table.drop_staging(batch_id)
        if self.delete:
            done = spark.read.parquet(checks).where("ok").select("path")
            done.mapInArrow(_delete, "path string").write.format("noop").mode("overwrite").save()

    def start(self, spark: SparkSession, **trigger) -> StreamingQuery:
        self.errors_path = self.errors_path or f"{self.checkpoint}-checks"
        writer = self._paths(spark).writeStream.option("checkpointLocation", self.checkpoint)
        known, queries = threading.Event(), []

        def ingest(paths: DataFrame, number: int) -> None:
            known.wait()
            self._ingest(paths, BatchId(number, str(queries[0].id)))

        queries.append(writer.trigger(**(trigger or {"processingTime": "1 second"})).foreachBatch(ingest).start())
        known.set()
        return queries[0]

    def run(self, spark: SparkSession) -> None:
        """Take up what lies in the spool now."""
        self.start(spark, availableNow=True).awaitTermination()

    def errors(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.errors_path).where("not ok").select("path", "error")
