"""Tumbling event-time windows and the late-row rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clock
from .skew import running_max

WIDTH = "10 seconds"


def tumble(df: DataFrame, aggs: Mapping[str, Column], keys: Sequence[str] = (),
           t: str = "t", width: str = WIDTH) -> DataFrame:
    """Aggregate per window and key; ``stt``/``edt`` label the window.

    Without keys this is a global window: every task still reduces its own rows
    first, so only one row per task and window is shuffled.
    """
    return label(windowed(df, aggs, keys, t, width), keys, list(aggs))


def windowed(df: DataFrame, aggs: Mapping[str, Column], keys: Sequence[str] = (), t: str = "t", width: str = WIDTH) -> DataFrame:
    """:func:`tumble` without labels: ``_w``, the window, with keys and sums. In a batch only its start is shuffled."""
    made = [c.alias(name) for name, c in aggs.items()]
    if df.isStreaming:
        return df.groupBy(F.window(t, width).alias("_w"), *keys).agg(*made)
    grouped = df.groupBy(F.window(t, width)["start"].alias("_start"), *keys).agg(*made)
    return grouped.select(F.window("_start", width).alias("_w"), *keys, *aggs)


def label(grouped: DataFrame, keys: Sequence[str], names: Sequence[str],
          window: str = "_w") -> DataFrame:
    return grouped.select(
        clock.second_text(f"{window}.start").alias("stt"),
        clock.second_text(f"{window}.end").alias("edt"), *keys, *names)


def total(*names: str) -> dict[str, Column]:
    """Sums of counters or amounts under their own names."""
    return {n: F.sum(n) for n in names}


def stamped(df: DataFrame) -> DataFrame:
    """Add ``ts``, the time the summary row was produced."""
    return df.withColumn("ts", clock.emit_time_ms())


def watermarked(df: DataFrame, t: str = "t", delay_s: int = 0, lateness_s: int = 0) -> DataFrame:
    """Watermark for a stream; allowed lateness simply keeps windows open longer.

    With update mode and a sink keyed by window and dimensions, a late row
    within the lateness refreshes the row written before.
    """
    if not df.isStreaming:
        return df
    return df.withWatermark(t, f"{delay_s + lateness_s} seconds")


def mark_late(df: DataFrame, arrival: str = "arrival", t: str = "t", width: str = WIDTH,
              delay_s: int = 0, lateness_s: int = 0, block: int = 100_000) -> DataFrame:
    """Which rows a watermark would drop, given the order of arrival.

    A row is late when its window, plus the allowed lateness, ends at or before the
    largest event time seen earlier minus the delay.
    """
    seen = running_max(df.withColumn("_end", F.window(t, width)["end"]), arrival, t, "_seen", block)
    slack = F.expr(f"interval {int(delay_s + lateness_s)} seconds")
    late = F.coalesce(F.col("_end") + slack <= F.col("_seen"), F.lit(False))
    return seen.withColumn("late", late).drop("_end", "_seen")
