"""The log job on a stream, with first days of visitors in a table of their own.

State is one short row per visitor, in a keyed table that micro-batches add to. Records never pass through it: they meet
the first days of their micro-batch's visitors in a join that deals out the rows of heavy visitors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import keyed, parse, routing
from ..operators.skew import HOT_ROWS
from ..sources.tiers import KeyedTable


def _earliest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("mid").agg(F.min(F.struct("at", "first_day")).alias("_f")).select("mid", "_f.*")


def first_day_table(path: str) -> KeyedTable:
    """``mid, at, first_day``: the place of a visitor's earliest record so far, and the day it tells."""
    return KeyedTable(path, ["mid"], fold=_earliest)


def log_batches(days_path: str, topics_path: str, order: Sequence[str] = ("ts",), run: int = 0, text: str = "value",
                hot_rows: int = HOT_ROWS) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` over raw log text: five log topics and the dirty text, as text files by topic.

    1. The micro-batch is parsed once and kept while it is worked on.
    2. Its visitors' earliest records are merged with what the table knows of these visitors; only visitors
       that are new, or that turn out to have come earlier, are added to the table.
    3. Flags are repaired by the merged days and records written whole, as :func:`rillmart.plans.ingest.log_topics` does.

    Records written before an earlier one of their visitor arrived stay as they are. A repeated micro-batch replaces
    its rows in both places; a new checkpoint takes a greater ``run``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        table = first_day_table(days_path)
        log = parse.mark_log(batch, text).withColumn("mid", F.when(F.col("ok"), F.col("mid"))).persist()
        here = keyed.first_days(log, order=order).persist()
        try:
            known = table.read_keys(here)
            if known is None:
                merged, added = here, here
            else:
                both = here.join(known.select("mid", F.struct("at", "first_day").alias("_known")), "mid", "left")
                mine = F.struct("at", "first_day")
                first = F.least(mine, "_known")          # skips a null
                merged = both.select("mid", "n", first["first_day"].alias("first_day"))
                added = both.where(F.col("_known").isNull() | (mine < F.col("_known")))
            merged = merged.select("mid", "n", "first_day").persist()
            merged.count()                               # what was known, before this batch is added
            table.put(added.select("mid", "at", "first_day"), run, batch_id)
            fixed = keyed.with_first_days(log, merged, order=order, hot_rows=hot_rows)
            routing.fan_out(fixed, text).write.mode("overwrite").partitionBy("topic").text(
                f"{topics_path}/run={run}/batch={batch_id}")
            merged.unpersist()
        finally:
            here.unpersist()
            log.unpersist()

    return write
