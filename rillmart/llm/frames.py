"""Session helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


#: Python workers give large arrays back to the system when they are freed, so one that waits for the next stage holds little.
LEAN = {"MALLOC_MMAP_THRESHOLD_": "1048576", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def ready(spark: SparkSession, batch_rows: int = 256, lean: bool = False) -> SparkSession:
    """Let Python workers import this package, and keep Arrow batches small for long texts; ``lean`` for jobs of many stages."""
    env = spark.sparkContext.environment
    if lean:
        env.update(LEAN)
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), ROOT) if x)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    return spark


def checkpointed(df: DataFrame, few: bool = False) -> DataFrame:
    """``df`` cut from its lineage, in the shared folder of ``spark.checkpoint.dir``.

    A folder of this machine serves only where the session names none, as in tests. ``few`` is for
    frames that are short next to the input, such as links: they are written by no more tasks
    than twice those that run at once, so that rounds over them don't leave thousands of small files.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="rillmart-"))
    return (df.coalesce(2 * context.defaultParallelism) if few else df).checkpoint()


def gathered(batches: Iterator[pa.RecordBatch], rows: int = 16_384) -> Iterator[pa.RecordBatch]:
    """Batches of at least ``rows`` short rows, where there are as many: those of :func:`ready` are cut for long texts."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.concat_batches(held)
            held, size = [], 0
    if size:
        yield pa.concat_batches(held)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
