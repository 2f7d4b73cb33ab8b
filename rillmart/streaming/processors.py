"""Keyed state for streams.

Two small state machines serve the keyed operators. Rows of one key in a
micro-batch arrive in any order and are put in order first; how many there can be is
bounded by the source's limit per trigger, and the first-of-day operators thin
them out before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

NO_GAP = -1


def thin(keys: Sequence[str], order: Sequence[str]) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Keep the first row per key and day of each Arrow batch.

    This is the map-side combine of the first-of-day operators: however many rows a hot
    key has, only a few per task and day reach its state.
    """
    by, sort = [*keys, "_day"], [*order]

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.sort_values(sort, kind="stable", na_position="first").drop_duplicates(by)

    return run


def _place(order: Sequence[str]) -> Callable[[Row], tuple]:
    """Sort key of a row; nulls come first, as in Spark."""
    return lambda row: tuple((row[c] is not None, row[c]) for c in order)


WORD_DAYS = 64


def _ms(t: datetime) -> int:
    return int(t.timestamp() * 1000)


class Kept(StatefulProcessor):
    """State that ends ``keep_ms`` after the last event time of its key, once the watermark has passed that.

    A timer is set when a key gets state. When it fires and the key was seen again meanwhile, it is set anew, so input
    rows cost no timer calls. Without ``keep_ms`` there are no timers and state stays.
    """
    keep_ms: int | None = None

    def init_kept(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        if self.keep_ms is not None:
            self.until = handle.getValueState("until", StructType([StructField("ms", LongType())]))

    def seen(self, last_ms: int) -> None:
        if self.keep_ms is None:
            return
        end = last_ms + self.keep_ms
        known = self.until.get()[0] if self.until.exists() else None
        if known is None:
            self.handle.registerTimer(end)
        if known is None or end > known:
            self.until.update((end,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        end = self.until.get()[0] if self.until.exists() else None
        if end is not None and end > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(end)
        elif end is not None:
            self.until.clear()
            self.forget()
        return iter(())

    def forget(self) -> None:
        raise NotImplementedError

    def close(self) -> None:
        pass


class DayFirsts(Kept):
    """Emit the first row of each day, with ``first_ever`` and ``gap_days``.

    Days seen are bits of 64-day words, and only the words that the rows at hand ask for are read and written.
    ``gap_days`` is the distance to the latest earlier day seen, or ``NO_GAP``; finding it may read earlier words, down to the
    first one of the key, and is left out (``NO_GAP``) without ``gaps``.
    """

    def __init__(self, columns: Sequence[str], order: Sequence[str], gaps: bool = False, keep_ms: int | None = None,
                 t: str = "t"):
        self.out, self.order, self.gaps = Row(*columns, "first_ever", "gap_days"), list(order), gaps
        self.keep_ms, self.t = keep_ms, t

    def init(self, handle: StatefulProcessorHandle) -> None:
        number = lambda name: StructField(name, LongType())
        self.words = handle.getMapState("words", StructType([number("word")]), StructType([number("bits")]))
        self.span = handle.getValueState("span", StructType([number("first"), number("last")]))
        self.init_kept(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        span = tuple(self.span.get()) if self.span.exists() else None
        held: dict[int, int] = {}
        changed: set[int] = set()

        def bits(word: int) -> int:
            if word not in held:
                known = span is not None and span[0] <= word <= span[1] and self.words.containsKey((word,))
                held[word] = self.words.getValue((word,))[0] % (1 << WORD_DAYS) if known else 0
            return held[word]

        def gap(day: int) -> int:
            word, below = day // WORD_DAYS, bits(day // WORD_DAYS) & ((1 << day % WORD_DAYS) - 1)
            while not below:
                word = min(word - 1, span[1]) if span is not None else -1
                if span is None or word < span[0]:
                    return NO_GAP
                below = bits(word)
            return day - (word * WORD_DAYS + below.bit_length() - 1)

        last_ms = None
        for row in sorted(rows, key=_place(self.order)):
            if self.keep_ms is not None:
                last_ms = max(last_ms or 0, _ms(row[self.t]))
            day = row["_day"]
            word, bit = day // WORD_DAYS, 1 << day % WORD_DAYS
            if bits(word) & bit:
                continue
            yield self.out(*row, int(span is None), gap(day) if self.gaps else NO_GAP)
            held[word] |= bit
            changed.add(word)
            span = (word, word) if span is None else (min(span[0], word), max(span[1], word))
        for word in changed:
            value = held[word]
            self.words.updateValue((word,), (value - (1 << WORD_DAYS) if value >> (WORD_DAYS - 1) else value,))
        if changed:
            self.span.update(span)
        if last_ms is not None:
            self.seen(last_ms)

    def forget(self) -> None:
        self.words.clear()
        self.span.clear()


class Retraction(Kept):
    """Emit each version, and before it the version it replaces with negated amounts.

    With event-time state, a retraction whose window the watermark has closed is left out: Spark takes no row from state that is
    behind the watermark, and the window would drop it.
    """

    def __init__(self, columns: StructType, order: Sequence[str], amounts: Sequence[str], keep_ms: int | None = None,
                 t: str = "t"):
        self.columns, self.order, self.out = columns, list(order), Row(*columns.names, "sign")
        self.at = [columns.names.index(a) for a in amounts]
        self.keep_ms, self.t = keep_ms, t

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", self.columns)
        self.init_kept(handle)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = tuple(self.last.get()) if self.last.exists() else None
        closed = timerValues.getCurrentWatermarkInMs() if self.keep_ms is not None else None
        when = self.columns.names.index(self.t) if self.keep_ms is not None else None
        last_ms = 0
        for row in sorted(rows, key=_place(self.order)):
            if last is not None and (closed is None or _ms(last[when]) > closed):
                yield self.out(*[-v if i in self.at else v for i, v in enumerate(last)], -1)
            yield self.out(*row, 1)
            last = tuple(row)
            if when is not None:
                last_ms = max(last_ms, _ms(last[when]))
        self.last.update(last)
        if when is not None:
            self.seen(last_ms)

    def forget(self) -> None:
        self.last.clear()


def with_day(df: DataFrame, t: str = "t") -> DataFrame:
    return df.withColumn("_day", F.unix_date(F.to_date(t)))


def _mode_of(keep_s: int | None, t: str) -> dict[str, str]:
    """How ``transformWithState`` keeps time: state that ends needs the watermark that ``df`` has on ``t``."""
    return {"timeMode": "None"} if keep_s is None else {"timeMode": "EventTime", "eventTimeColumnName": t}


def day_firsts(df: DataFrame, keys: Sequence[str], order: Sequence[str], mode: str = "append",
               keep_s: int | None = None, gaps: bool = False, t: str = "t") -> DataFrame:
    """First rows of each key and day of a stream (``df`` needs ``_day``).

    With ``keep_s`` a key's days are forgotten that long after its last row, in event time; ``df`` then has a watermark
    on ``t``, and so does the result.
    """
    out = StructType([*df.schema.fields, StructField("first_ever", IntegerType()),
                      StructField("gap_days", IntegerType())])
    few = df if keep_s is not None else df.mapInPandas(thin(keys, order), df.schema)
    return few.groupBy(*keys).transformWithState(
        DayFirsts(df.columns, order, gaps, None if keep_s is None else keep_s * 1000, t), out, mode, **_mode_of(keep_s, t))


def retractions(df: DataFrame, key: str, order: Sequence[str], amounts: Sequence[str],
                mode: str = "append", keep_s: int | None = None, t: str = "t") -> DataFrame:
    """``df`` has text and bigint columns, and ``t`` where ``keep_s`` is given; amounts are never null."""
    out = StructType([*df.schema.fields, StructField("sign", IntegerType())])
    return df.groupBy(key).transformWithState(
        Retraction(df.schema, order, amounts, None if keep_s is None else keep_s * 1000, t), out, mode, **_mode_of(keep_s, t))
