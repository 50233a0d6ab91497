"""Data source ``series_avro``: series as Avro object containers.

    register(spark)
    write_series(series, path, dataset_id="d1")                # one file per task, snappy
    spark.read.format("series_avro").load(path)                # one row per series

Reading splits large files at block boundaries. Writing stages every task attempt's file under
its own name and publishes the files of successful attempts on commit, so lost executors and
repeated tasks leave no trace. A manifest, replaced by one rename, tells which files count, so an
overwrite is seen whole or not at all. Only file names pass through the driver.
"""

from __future__ import annotations

import json
import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    StringStartsWith,
    WriterCommitMessage,
)

from seriesloom.operators.encoding import file_records
from seriesloom.schema import UNION_DDL
from seriesloom.session import wide_rows
from seriesloom.sources import codec

FORMAT = "series_avro"
DATASET_KEY = "dataset_rid"
STAGING = "_staging"
MANIFEST = "_files.json"  # the data files of a folder; without it, all that lie there
_BLOCK_BYTES = 1 << 20
_PARALLEL_MOVES = 32  # file renames under way at once on commit
_BATCH_POINTS, _BATCH_BYTES, _BATCH_RECORDS = 250_000, 32 << 20, 10_000
_ARRAYS = {
    "double": "doubles", "string": "strings", "int": "longs",
    "double_array": "double_arrays", "string_array": "string_arrays", "struct": "jsons",
}

READ_DDL = (
    "channel string, tags map<string,string>, timestamps array<bigint>, "
    f"values array<{UNION_DDL}>, dataset_id string, file string"
)
COUNTS_DDL = "channel string, tags map<string,string>, n bigint, dataset_id string, file string"


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and plain path of a URI or a local path."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    if path.startswith("s3a://"):  # the name Hadoop gives to the same store
        path = "s3://" + path[len("s3a://"):]
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), os.path.abspath(path)


def list_files(path: str) -> list[pafs.FileInfo]:
    """Data files of a folder, or the file itself."""
    fs, plain = open_fs(path)
    info = fs.get_file_info(plain)
    if info.type == pafs.FileType.File:
        return [info]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = fs.get_file_info(pafs.FileSelector(plain, recursive=True))
    hidden = lambda f: any(p[:1] in "_." for p in f.path[len(plain):].strip("/").split("/"))
    published = {
        os.path.dirname(f.path): _published(fs, f.path) for f in found if os.path.basename(f.path) == MANIFEST
    }
    listed = lambda f: os.path.basename(f.path) in published.get(os.path.dirname(f.path), (os.path.basename(f.path),))
    return sorted(
        (f for f in found if f.type == pafs.FileType.File and f.path.endswith(".avro") and not hidden(f) and listed(f)),
        key=lambda f: f.path,
    )


def _published(fs: pafs.FileSystem, manifest: str) -> set[str]:
    with fs.open_input_file(manifest) as file:
        return set(json.loads(file.read()))


def record_batches(
    container: codec.Container, start, stop, schema: pa.Schema, extra: dict, keep=None, counts_only: bool = False
):
    """Rows of a split, in batches of bounded points, bytes and records."""
    value_type = None if counts_only else schema.field("values").type.value_type
    rows: list = []
    points = size = 0

    def flush():
        if counts_only:
            channels, counts, _, tags = zip(*rows)
            columns = {
                "channel": pa.array(channels, pa.string()), "tags": pa.array(tags, schema.field("tags").type),
                "n": pa.array(counts, pa.int64()),
                **{name: pa.array([value] * len(rows), pa.string()) for name, value in extra.items()},
            }
            return pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema)
        channels, stamps, items, tags = zip(*rows)
        offsets = [0]
        for s in stamps:
            offsets.append(offsets[-1] + len(s))
        item_offsets, flat = [0], []
        for part in items:
            flat += part
            item_offsets.append(item_offsets[-1] + sum(len(p) for p in part))
        unions = pa.concat_arrays(flat) if flat else pa.array([], value_type)
        tag_type = schema.field("tags").type
        columns = {
            "channel": pa.array(channels, pa.string()),
            "tags": pa.array(tags, tag_type),
            "timestamps": pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.concat_arrays([pa.array(s, pa.int64()) for s in stamps]),
                type=schema.field("timestamps").type,
            ),
            "values": pa.ListArray.from_arrays(pa.array(item_offsets, pa.int32()), unions, type=schema.field("values").type),
        }
        for name, value in extra.items():
            columns[name] = pa.array([value] * len(rows), pa.string())
        return pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema)

    for count, raw in container.blocks(start, stop):
        cursor = codec.Cursor(raw)
        for _ in range(count):
            begin = cursor.at
            row = codec.read_record(cursor, value_type, keep, counts_only)
            if row is not None:
                rows.append(row)
                size += cursor.at - begin
                points += 0 if counts_only else len(row[1])
            if points >= _BATCH_POINTS or len(rows) >= _BATCH_RECORDS or (size >= _BATCH_BYTES and not counts_only):
                made = flush()
                row, rows, points, size = None, [], 0, 0  # the decoded parts are not held while Spark takes the batch
                yield made
                del made
    if rows:
        yield flush()


@dataclass
class Split(InputPartition):
    path: str
    start: int
    stop: int

    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


class SeriesReader(DataSourceReader):
    def __init__(self, options: dict, schema: pa.Schema):
        self.path = options["path"]
        self.split_bytes = int(options.get("splitbytes", 128 << 20))
        self.dataset_key = options.get("datasetkey", DATASET_KEY)
        self.counts_only = _on(options, "countsonly")
        self.schema = schema
        self.tests: list[tuple[str, tuple]] = []

    def pushFilters(self, filters):
        """Channel tests skip records before they are decoded; Spark still applies them itself."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("channel",):
                self.tests.append(("in", (f.value,)))
            elif isinstance(f, In) and f.attribute == ("channel",):
                self.tests.append(("in", tuple(f.value)))
            elif isinstance(f, StringStartsWith) and f.attribute == ("channel",):
                self.tests.append(("starts", (f.value,)))
            yield f

    def partitions(self):
        out = []
        for f in list_files(self.path):
            for start in range(0, max(f.size, 1), self.split_bytes):
                out.append(Split(f.path, start, min(start + self.split_bytes, f.size)))
        return out or [Split("", 0, 0)]

    def _keep(self, channel: str) -> bool:
        return all(
            channel in values if test == "in" else channel.startswith(values[0]) for test, values in self.tests
        )

    def read(self, partition: Split):
        if not partition.path:
            return
        fs, _ = open_fs(self.path)
        with fs.open_input_file(partition.path) as file:
            container = codec.Container(file, file.size())
            dataset = container.metadata.get(self.dataset_key)
            extra = {"dataset_id": None if dataset is None else dataset.decode(), "file": partition.path}
            keep = self._keep if self.tests else None
            yield from record_batches(
                container, partition.start, partition.stop, self.schema, extra, keep, self.counts_only
            )


@dataclass
class Written(WriterCommitMessage):
    name: str
    records: int


class SeriesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"]
        self.overwrite = overwrite
        self.metadata = {}
        if options.get("datasetid"):
            self.metadata[options.get("datasetkey", DATASET_KEY)] = options["datasetid"]
        self.job = uuid.uuid4().hex
        self.block_bytes = int(options.get("blockbytes", _BLOCK_BYTES))

    def _staging(self, plain: str) -> str:
        return f"{plain}/{STAGING}/{self.job}"

    def write(self, iterator):
        fs, plain = open_fs(self.path)
        staging = self._staging(plain)
        name, records = f"part-{uuid.uuid4().hex}.avro", 0
        sync, file, block = uuid.uuid4().bytes, None, codec.Block()
        try:
            for batch in iterator:
                columns = {n: batch.column(n) for n in batch.schema.names}
                for i in range(batch.num_rows):
                    if file is None:
                        fs.create_dir(staging, recursive=True)
                        file = fs.open_output_stream(f"{staging}/{name}")
                        file.write(codec.header(sync, self.metadata))
                    kind = columns["kind"][i].as_py()
                    items = columns[_ARRAYS[kind]][i].values if kind else None
                    stamps = columns["timestamps"][i].values.to_numpy(zero_copy_only=False)
                    block.add(codec.pieces(columns["channel"][i].as_py(), columns["tags"][i].as_py(), stamps, kind, items))
                    records += 1
                    if block.size >= self.block_bytes:
                        block.write(file, sync)
                        block = codec.Block()
                del batch, columns  # not held while the next one is read
                items = stamps = None
            if block.records:
                block.write(file, sync)
        finally:
            if file is not None:
                file.close()
        return Written(name if records else "", records)

    def commit(self, messages):
        fs, plain = open_fs(self.path)
        staging = self._staging(plain)
        fs.create_dir(plain, recursive=True)
        old = [f.path for f in list_files(self.path)]
        names = [m.name for m in messages if m is not None and m.name]
        kept = [] if self.overwrite else [os.path.basename(f) for f in old if os.path.dirname(f) == plain]
        with ThreadPoolExecutor(_PARALLEL_MOVES) as pool:
            list(pool.map(lambda name: fs.move(f"{staging}/{name}", f"{plain}/{name}"), names))
            # one rename publishes the new files and withdraws the old ones; what fails before leaves the old
            with fs.open_output_stream(f"{plain}/{MANIFEST}.{self.job}") as file:
                file.write(json.dumps(sorted(names + kept)).encode())
            fs.move(f"{plain}/{MANIFEST}.{self.job}", f"{plain}/{MANIFEST}")
            if self.overwrite:
                list(pool.map(fs.delete_file, old))
        self._drop_staging(fs, staging)

    def abort(self, messages):
        fs, plain = open_fs(self.path)
        self._drop_staging(fs, self._staging(plain))

    def _drop_staging(self, fs, staging: str) -> None:
        if fs.get_file_info(staging).type == pafs.FileType.Directory:
            fs.delete_dir(staging)


def _on(options: dict, name: str) -> bool:
    return str(options.get(name, "false")).lower() == "true"


class SeriesAvro(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return COUNTS_DDL if _on(self._lowered(), "countsonly") else READ_DDL

    def reader(self, schema):
        from pyspark.sql.pandas.types import to_arrow_schema

        return SeriesReader(self._lowered(), to_arrow_schema(schema))

    def writer(self, schema, overwrite):
        return SeriesWriter(self._lowered(), overwrite)

    def _lowered(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}


def register(spark: SparkSession) -> None:
    """Make the format known; Spark refuses readers with filter push-down unless it is switched on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SeriesAvro)


def write_series(
    series: DataFrame, path: str, overwrite: bool = True, dataset_id: str | None = None,
    dataset_key: str = DATASET_KEY,
) -> None:
    """Write packed series to containers (D5); ``overwrite`` replaces older files as a whole.

    Without ``overwrite`` an existing target is refused and left as it is (D7). The dataset id
    goes into the file metadata, and is left out when there is none (D8).
    """
    register(series.sparkSession)
    if not overwrite:
        fs, plain = open_fs(path)
        if fs.get_file_info(plain).type != pafs.FileType.NotFound:
            raise FileExistsError(path)
    write = file_records(series).write.format(FORMAT).mode("overwrite" if overwrite else "append")
    write = write.option("datasetKey", dataset_key)
    if dataset_id:
        write = write.option("datasetId", dataset_id)
    with wide_rows(series.sparkSession):
        write.save(path)


def read_series(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Records of series files: channel, tags, timestamps, values, dataset_id, file.

    Tests of the channel are made before a record is decoded. ``countsOnly="true"`` gives the number
    of points ``n`` in place of timestamps and values, which are then passed over.
    """
    register(spark)
    return spark.read.format(FORMAT).options(**options).load(path)
