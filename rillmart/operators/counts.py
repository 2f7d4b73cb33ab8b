"""Counts of what a job lets go: dirty, unmatched and late rows, taken while rows pass.

Conditions are counted by ``observe``: no second reading, no shuffle, a few numbers per task.
"""

from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

LATE = "late"


def _counts(conditions: dict[str, Column]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), *(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items())]


def counted(df: DataFrame, name: str | Observation, **conditions: Column) -> DataFrame:
    """The same rows; ``rows`` and, for each condition, how many rows meet it are reported under ``name``.

    A batch gives an ``Observation`` and asks it after its action; a stream gives a name, and :class:`Totals` listens.
    """
    return df.observe(name, *_counts(conditions))


class Totals(StreamingQueryListener):
    """Adds up the counts of all micro-batches, by query name: ``totals[query][name, condition]``.

    Rows dropped behind the watermark are added under ``(operator, "late")`` for each stateful operator. A micro-batch that Spark
    repeats after a failure is counted once: by the last progress of its number.
    """

    def __init__(self) -> None:
        self._seen: dict[tuple[str, int], Counter] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p, found = event.progress, Counter()
        for name, row in p.observedMetrics.items():
            for condition, n in row.asDict().items():
                found[name, condition] += n
        for op in p.stateOperators:
            found[op.operatorName, LATE] += op.numRowsDroppedByWatermark
        self._seen[p.name or str(p.id), p.batchId] = found

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    @property
    def totals(self) -> dict[str, Counter]:
        out: dict[str, Counter] = defaultdict(Counter)
        for (query, _), found in list(self._seen.items()):
            out[query].update(found)
        return out
