"""Per-key work that stays spread when one key holds a large part of all rows.

Three shapes cover the keyed operators of the warehouse:

* a fact about a key (its first row, its last row) is an aggregate, combined on
  the map side, and is brought back to the rows by :func:`join_per_key`;
* a "previous row" is found by :func:`with_previous` in pieces of time, so a
  key is never sorted in one task;
* a running maximum over arrivals is a maximum per block plus a prefix over the
  blocks (:func:`running_max`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Below this many rows a key is not worth treating apart.
HOT_ROWS = 100_000


def join_per_key(rows: DataFrame, per_key: DataFrame, key: str, count: str, value: str,
                 spread_by: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join ``rows`` to a table with one row per key: ``key, count, value``.

    The keys of ``hot_rows`` rows or more, of which there are few for that reason, give their
    value to the rows in a join that Spark broadcasts if their measured size allows it. All other
    rows find theirs in a shuffle join; rows already served are dealt over all tasks by a hash of
    ``spread_by`` instead of following their key, and so are rows without a key.
    The result has every row once whatever the bounds are.
    """
    hot = (
        per_key.where(F.col(count) >= hot_rows)
        .select(F.col(key).alias("_hot_key"), F.col(value).alias("_hot_value"), F.lit(1).alias("_hot"))
    )
    # Always 0, but not a literal: the optimizer would take a literal out of the join key.
    # It also keeps the count in use, so both uses of per_key share one exchange.
    zero = F.when(F.col(count) < 0, 1).otherwise(0)
    rest = per_key.select(
        F.col(key).alias("_key"), zero.alias("_part"), F.col(value).alias("_cold_value"))
    marked = rows.join(hot, F.col(key) == F.col("_hot_key"), "left")
    follows_key = F.col("_hot").isNull() & F.col(key).isNotNull()
    part = F.when(follows_key, F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*spread_by), F.lit(1 << 20)).cast("int") + 1)
    # One key of both, so that rows which already lie by ``key`` are dealt anew.
    joined = marked.withColumn("_row_part", part).join(
        rest, F.struct(F.col(key).alias("k"), F.col("_row_part").alias("p")) == F.struct(F.col("_key").alias("k"), F.col("_part").alias("p")), "left")
    found = F.when(F.col("_hot") == 1, F.col("_hot_value")).otherwise(F.col("_cold_value"))
    return joined.select(*rows.columns, found.alias(value))


def hot_keys_of(rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys that have ``hot_rows`` rows or more."""
    return rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= hot_rows).select(*keys)


def with_previous(rows: DataFrame, keys: Sequence[str], order: Sequence[str],
                  pieces: Sequence[Column], keep: Sequence[str], out: str = "prev",
                  hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add struct ``out`` with the ``keep`` columns of the preceding row of the key.

    ``order`` must be a total order within a key. Most keys are ordered whole.
    The rows of the heaviest keys are ordered in ``pieces``, given from fine to coarse
    (seconds, hours); a piece never decreases along the order, and a finer one lies
    within a coarser one. What precedes a piece is handed to it as one extra row.
    """
    hot = hot_keys_of(rows, keys, hot_rows).withColumn("_hot", F.lit(True))
    names = [f"_piece{i}" for i in range(len(pieces))]
    marked = rows.join(hot, list(keys), "left").select(
        *rows.columns, F.struct(*keep).alias("_held"), F.col("_hot"),
        *[F.when(F.col("_hot"), p).alias(n) for p, n in zip(pieces, names)])
    carry = _before_pieces(marked.where("_hot"), keys, order, names)
    inside = Window.partitionBy(*keys, names[0]).orderBy(F.desc("_carried"), *order)
    both = marked.drop("_hot").withColumn("_carried", F.lit(0)).unionByName(
        carry.withColumn("_carried", F.lit(1)), allowMissingColumns=True)
    return (
        both.withColumn(out, F.lag("_held").over(inside)).where(F.col("_carried") == 0)
        .select(*rows.columns, out)
    )


def _before_pieces(rows: DataFrame, keys: Sequence[str], order: Sequence[str],
                   pieces: Sequence[str]) -> DataFrame:
    """Per key and finest piece, the ``_held`` of the last row before the piece.

    Last rows of pieces are ordered within the next coarser piece, and so on; only
    the coarsest pieces of a key are ordered all together.
    """
    # Fine pieces hold few rows: dealt out first, they are sorted in many tasks and not in the few that read the input.
    last = rows.repartition(*keys, *pieces).groupBy(*keys, *pieces).agg(F.max_by("_held", F.struct(*order)).alias("_held"))
    if len(pieces) == 1:
        along = Window.partitionBy(*keys).orderBy(pieces[0])
        found = last.withColumn("_before", F.lag("_held").over(along))
    else:
        coarse = _before_pieces(last, keys, [pieces[0]], pieces[1:])
        along = Window.partitionBy(*keys, pieces[1]).orderBy(pieces[0])
        inner = last.withColumn("_inner", F.lag("_held").over(along))
        found = inner.join(
            coarse.select(*keys, pieces[1], F.col("_held").alias("_outer")), [*keys, pieces[1]], "left"
        ).withColumn("_before", F.coalesce("_inner", "_outer"))
    return found.where(F.col("_before").isNotNull()).select(
        *keys, *pieces, F.col("_before").alias("_held"))


def running_max(rows: DataFrame, arrival: str, value: str, out: str,
                block: int = 100_000, levels: int | None = None) -> DataFrame:
    """Maximum of ``value`` over all rows that arrived before, null on the first.

    ``arrival`` is a dense arrival number. Each block of arrivals is scanned on
    its own; what came before a block is the running maximum of the block maxima, found
    the same way, for as many levels as leave one block at the top.
    """
    block = max(block, 2)
    if levels is None:
        last, levels = rows.agg(F.max(arrival)).first()[0] or 0, 0
        while last // block ** levels >= block:
            levels += 1
    mine, top, seen, before = (f"_{n}{levels}" for n in ("block", "top", "seen", "before"))
    if levels == 0:
        ahead = Window.orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn(out, F.max(value).over(ahead))
    cut = rows.withColumn(mine, F.floor(F.col(arrival) / block))
    per_block = cut.groupBy(mine).agg(F.max(value).alias(top))
    prefix = running_max(per_block, mine, top, before, block, levels - 1).select(mine, before)
    inside = Window.partitionBy(mine).orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumn(seen, F.max(value).over(inside))
        .join(prefix, mine)
        .withColumn(out, F.greatest(seen, before))
        .drop(mine, seen, before)
    )
