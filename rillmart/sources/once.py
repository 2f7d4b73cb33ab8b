"""Summary tables to which every micro-batch adds its rows exactly once.

The sink is a Python data source. Each task writes one Parquet file and tells its name in its commit message; only when all
tasks are done does the driver publish the batch by a marker that lists these files. A batch that fails
half-way has no marker and readers pass over its files; a batch that is repeated finds its marker and computes nothing.
Readers meet files and markers in a join, so no list of files goes through the driver.

Paths may be URIs that pyarrow can open on driver and executors. One query writes a table at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .tiers import NEWER, last_of

FORMAT = "rillmart_once"


@dataclass
class Written(WriterCommitMessage):
    """What one task left: a file's name, or nothing."""
    file: str | None
    rows: int = 0


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


class OnceWriter(DataSourceArrowWriter):
    """Adds one batch: ``path``, ``run`` and ``batch`` are options."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.schema = options["path"].rstrip("/"), schema
        self.place = f"run={int(options['run'])}/batch={int(options['batch'])}"

    @property
    def marker(self) -> str:
        return f"{self.path}/batches/{self.place}/files.json"

    def done(self) -> bool:
        files, at = _opened(self.marker)
        return files.get_file_info(at).type == fs.FileType.File

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        if self.done():
            return Written(None)
        files, folder = _opened(f"{self.path}/data/{self.place}")
        name, rows, out, schema = f"{uuid.uuid4().hex}.parquet", 0, None, to_arrow_schema(self.schema)
        try:
            for batch in iterator:
                if out is None:
                    files.create_dir(folder, recursive=True)
                    out = pq.ParquetWriter(f"{folder}/{name}", schema, filesystem=files)
                out.write_table(pa.Table.from_batches([batch]).cast(schema))
                rows += batch.num_rows
        finally:
            if out is not None:
                out.close()
        return Written(None if out is None else name, rows)

    def commit(self, messages: list[Written | None]) -> None:
        if self.done():
            return self.abort(messages)
        files, at = _opened(self.marker)
        files.create_dir(at.rsplit("/", 1)[0], recursive=True)
        hidden = f"{at.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}"        # readers pass over names that start so
        with files.open_output_stream(hidden) as out:
            for m in messages:
                if m is not None and m.file is not None:
                    out.write((json.dumps({"file": m.file, "rows": m.rows}) + "\n").encode())
        files.move(hidden, at)

    def abort(self, messages: list[Written | None]) -> None:
        """Drop what the tasks of this attempt left; files of lost tasks stay and are never read."""
        files, folder = _opened(f"{self.path}/data/{self.place}")
        for m in messages:
            if m is not None and m.file is not None:
                files.delete_file(f"{folder}/{m.file}")


class OnceSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> OnceWriter:
        return OnceWriter(self.options, schema)


def add_once(path: str, columns: Sequence[str] = (), transient: Sequence[str] = (),
             run: int = 0) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` that adds summary rows to the table at ``path``, transient columns left out.

    ``columns`` names the table's columns in order; batch columns are bound to them by position. A new
    checkpoint takes a greater ``run``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.sparkSession.dataSource.register(OnceSource)
        rows = batch.drop(*transient)
        if columns:
            rows = rows.toDF(*columns)
        at = {"path": path, "run": str(run), "batch": str(batch_id)}
        if OnceWriter(at, rows.schema).done():       # else the stages before the sink's would run for nothing
            return
        rows.write.format(FORMAT).mode("append").options(**at).save()

    return write


def read_once(spark: SparkSession, path: str, schema: StructType | str, keys: Sequence[str] = ()) -> DataFrame:
    """The rows of all published batches, or the newest of each key: windows in update mode are written again as they grow."""
    shape = spark.createDataFrame([], schema).schema
    placed = StructType([*shape.fields, StructField("run", IntegerType()), StructField("batch", LongType())])
    published = spark.read.schema("file string, rows long, run int, batch long").json(f"{path}/batches").select("file", *NEWER)
    files, where = _opened(f"{path}/data")
    if files.get_file_info(where).type == fs.FileType.NotFound:       # only empty batches so far
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(placed).parquet(f"{path}/data").withColumn("file", F.col("_metadata.file_name"))
    rows = rows.join(published, ["file", *NEWER], "left_semi").drop("file")
    if keys:
        rows = last_of(keys)(rows)
    return rows.select(*shape.names)
