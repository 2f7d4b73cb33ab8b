"""Keyed tables that micro-batches add to, kept in a bounded number of folders.

A micro-batch adds one part, ``tier=0/run=<r>/first=<b>/batch=<b>``. When ``FAN_IN`` parts of a tier are there, they are
folded to one row per key in a part of the next tier, whose folder names the first and last batch it covers. So a table of n
batches has some ``FAN_IN * log(n)`` parts, every row is rewritten once per tier, and readers fold what is left.

A part counts once its ``_SUCCESS`` file is there, and a part that lies within a greater one no longer counts; it is
deleted by the merge after next, so that a reader that listed it can finish. The newest batch is never merged: after a
failure it is the one that is written again, and replaces its own part. Runs are never merged with each other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FAN_IN = 8
NEWER = ["run", "batch"]
PLACE = ["tier", "run", "first", "batch"]


@dataclass(frozen=True, order=True)
class Part:
    run: int
    first: int
    batch: int
    tier: int

    @property
    def folder(self) -> str:
        return f"tier={self.tier}/run={self.run}/first={self.first}/batch={self.batch}"

    def covers(self, other: Part) -> bool:
        return self.run == other.run and self.tier > other.tier and self.first <= other.first and other.batch <= self.batch


def last_of(keys: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Fold to the newest row per key; one aggregate, combined on the map side."""
    def fold(rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in (*keys, *PLACE)]
        if not rest:
            return rows.select(*keys).distinct()
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*NEWER)).alias("_last"))
        return last.select(*keys, "_last.*")

    return fold


@dataclass(frozen=True)
class KeyedTable:
    """``fold`` maps rows of several parts (with ``run`` and ``batch``) to one row per key.

    Rows are laid out in one folder per value of ``by`` within a part, for readers that want few of them.
    """
    path: str
    keys: Sequence[str]
    by: Sequence[str] = ()
    fold: Callable[[DataFrame], DataFrame] | None = None
    fan_in: int = field(default=FAN_IN)

    def put(self, rows: DataFrame, run: int, batch: int) -> None:
        """Add a micro-batch that has one row per key, then merge older parts where a tier is full."""
        self._write(rows, Part(run, batch, batch, 0))
        self._merge(rows.sparkSession, run, batch)

    def parts(self, spark: SparkSession) -> list[Part]:
        """The parts that count now, oldest first."""
        known = self._listed(spark)
        return [p for p in known if not any(q.covers(p) for q in known)]

    def read(self, spark: SparkSession, where: Column | None = None) -> DataFrame | None:
        """One row per key, or None while no part is there; ``where`` is applied before the fold."""
        found = self._rows(spark, self.parts(spark))
        if found is None:
            return None
        return self._folded(found if where is None else found.where(where))

    def read_keys(self, wanted: DataFrame) -> DataFrame | None:
        """One row for each key of ``wanted`` that is there; only their rows are folded."""
        found = self._rows(wanted.sparkSession, self.parts(wanted.sparkSession))
        return None if found is None else self._folded(found.join(wanted.select(*self.keys), list(self.keys), "left_semi"))

    def _folded(self, rows: DataFrame) -> DataFrame:
        return (self.fold or last_of(self.keys))(rows)

    def _rows(self, spark: SparkSession, parts: Sequence[Part]) -> DataFrame | None:
        if not parts:
            return None
        folders = [f"{self.path}/{p.folder}" for p in parts]
        return spark.read.option("basePath", self.path).option("mergeSchema", "true").parquet(*folders)

    def _write(self, rows: DataFrame, part: Part) -> None:
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(*self.by) if self.by else writer).parquet(f"{self.path}/{part.folder}")

    def _merge(self, spark: SparkSession, run: int, newest: int) -> None:
        known = self._listed(spark)
        covered = [p for p in known if any(q.covers(p) for q in known)]
        tier = 0
        while True:
            live = [p for p in self.parts(spark) if p.run == run and p.tier == tier and p.batch < newest]
            if len(live) < self.fan_in:
                return
            merged = live[: self.fan_in]
            self._write(self._folded(self._rows(spark, merged)), Part(run, merged[0].first, merged[-1].batch, tier + 1))
            while covered:
                self._delete(spark, covered.pop())
            tier += 1

    def _listed(self, spark: SparkSession) -> list[Part]:
        fs, top = file_system(spark, f"{self.path}/{'/'.join(f'{c}=*' for c in PLACE)}/_SUCCESS")
        found = []
        for status in fs.globStatus(top) or []:
            values = dict(piece.split("=", 1) for piece in status.getPath().getParent().toString().split("/")[-len(PLACE):])
            found.append(Part(int(values["run"]), int(values["first"]), int(values["batch"]), int(values["tier"])))
        return sorted(found)

    def _delete(self, spark: SparkSession, part: Part) -> None:
        fs, folder = file_system(spark, f"{self.path}/{part.folder}")
        fs.delete(folder, True)


def file_system(spark: SparkSession, path: str) -> tuple:
    """(file system of a path, the path), both of the JVM; any store that Spark can write to."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at
