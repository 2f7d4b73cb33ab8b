"""Joins of the detail tables and the dimension enrichment.

Nothing here forces a broadcast: dictionaries and dimensions are broadcast by
Spark when their size, estimated or measured at run time, is under
``spark.sql.autoBroadcastJoinThreshold``; above it they become shuffle joins, whose
oversized partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, dic: DataFrame, code: str, name_as: str) -> DataFrame:
    """Add the dictionary name of a code; rows without an entry are dropped."""
    d = dic.select(F.col("dic_code").alias("_code"), F.col("dic_name").alias(name_as))
    return df.join(d, F.col(code) == F.col("_code")).drop("_code")


def bounded_join(left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str = "inner",
                 t_left: str = "t", t_right: str = "t", ttl_s: int | None = None) -> DataFrame:
    """Equi join with a bound on the distance of the two event times.

    ``on`` maps left to right columns. Right columns that also exist on the
    left (and the right keys and time) are left out of the result. Without ``ttl_s`` it is a plain join
    that keeps every pair. A stream must give it: it is what lets Spark forget old rows.
    """
    if ttl_s is None:
        if left.isStreaming or right.isStreaming:
            raise ValueError("a join of streams needs ttl_s")
        tagged = right.select(*[F.col(c).alias(f"_r_{c}") for c in right.columns])
        return _tidy(left, right, left.join(tagged, _equal(on), how))
    return _near_join(left, right, on, how, t_left, t_right, ttl_s, ttl_s)


def bounded_joins(left: DataFrame, rights: Sequence[DataFrame], on: Mapping[str, str], how: str = "inner",
                  ttl_s: int | None = None) -> DataFrame:
    """:func:`bounded_join` with several frames by the same keys, one after the other.

    The bucket of a left row is made once, so that rows which met one frame lie where they meet the next.
    """
    if ttl_s is not None:
        left = _bucketed(left, "t", ttl_s, ttl_s)
    for right in rights:
        if ttl_s is None:
            left = bounded_join(left, right, on, how)
        else:
            left = _meet(left, right, on, how, "t", "t", ttl_s, ttl_s)
    return left.drop("_bucket") if ttl_s is not None else left


def interval_join(left: DataFrame, right: DataFrame, on: Mapping[str, str],
                  before_s: int = 15 * 60, after_s: int = 5,
                  t_left: str = "t", t_right: str = "t") -> DataFrame:
    """Rows of ``left`` from ``before_s`` ahead of a right row to ``after_s`` behind it."""
    return _near_join(left, right, on, "inner", t_left, t_right, before_s, after_s)


# Buckets are this many times the join interval: a right row is looked up in one or two
# buckets, and a key compares only rows of a bucket.
BUCKET_SPANS = 2


def _near_join(left: DataFrame, right: DataFrame, on: Mapping[str, str], how: str, t_left: str,
               t_right: str, before_s: int, after_s: int) -> DataFrame:
    """Join rows with ``right - before_s <= left <= right + after_s`` and equal keys.

    Both sides are also cut into buckets of time, and the bucket is part of the join
    key: a key with very many rows is spread over its buckets, and only rows
    near each other in time are compared. A left row is in one bucket; a right row is
    in every bucket its interval touches, so each pair meets exactly once.
    """
    return _meet(_bucketed(left, t_left, before_s, after_s), right, on, how, t_left, t_right, before_s, after_s).drop("_bucket")


def _width(before_s: int, after_s: int) -> int:
    return max(1, (before_s + after_s) * BUCKET_SPANS)


def _bucketed(left: DataFrame, t_left: str, before_s: int, after_s: int) -> DataFrame:
    seconds = F.unix_seconds(F.col(t_left).cast("timestamp"))
    return left.withColumn("_bucket", F.floor(seconds / _width(before_s, after_s)))


def _meet(mine: DataFrame, right: DataFrame, on: Mapping[str, str], how: str, t_left: str, t_right: str,
          before_s: int, after_s: int) -> DataFrame:
    """:func:`_near_join` of rows that have their bucket, which the result has too."""
    width = _width(before_s, after_s)
    seconds = F.unix_seconds(F.col(t_right).cast("timestamp"))
    touched = F.sequence(F.floor((seconds - before_s) / width), F.floor((seconds + after_s + 1) / width))
    theirs = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in right.columns], F.explode(touched).alias("_r__bucket"))
    at = F.col(f"_r_{t_right}")
    cond = (
        _equal({**on, "_bucket": "_bucket"})
        & (F.col(t_left) >= at - F.expr(f"interval {int(before_s)} seconds"))
        & (F.col(t_left) <= at + F.expr(f"interval {int(after_s)} seconds"))
    )
    return _tidy(mine, right, mine.join(theirs, cond, how))


def enrich(df: DataFrame, dim: DataFrame, key: str | Mapping[str, str],
           take: Mapping[str, str], default: str | None = None) -> DataFrame:
    """Add dimension columns; rows without a dimension row stay.

    ``key`` is the column matching the dimension's ``id``, or a mapping of
    several columns to dimension columns. ``take`` maps dimension columns to output names.
    """
    on = {key: "id"} if isinstance(key, str) else dict(key)
    d = dim.select(*[F.col(v).alias(f"_k{i}") for i, v in enumerate(on.values())],
                   *[F.col(src).alias(out) for src, out in take.items()])
    cond = None
    for i, mine in enumerate(on):
        part = F.col(mine) == F.col(f"_k{i}")
        cond = part if cond is None else cond & part
    out = df.join(d, cond, "left").drop(*[f"_k{i}" for i in range(len(on))])
    if default is not None:
        out = out.fillna(default, subset=list(take.values()))
    return out


def enrich_sku(df: DataFrame, dims: Mapping[str, DataFrame], key: str = "sku_id") -> DataFrame:
    """Columns of the sku itself: name, spu, trademark and third-level category ids."""
    return enrich(df, dims["sku"], key, {
        "sku_name": "sku_name", "spu_id": "spu_id", "tm_id": "trademark_id",
        "category3_id": "category3_id"})


def enrich_categories(df: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Trademark name and the three category levels, whose chain is joined before it meets ``df``."""
    out = enrich(df, dims["trademark"], "trademark_id", {"tm_name": "trademark_name"})
    return enrich(out, flat_categories(dims), "category3_id", {c: c for c in CATEGORIES})


CATEGORIES = ("category3_name", "category2_id", "category2_name", "category1_id", "category1_name")
FLAT = ("sku_name", "spu_id", "trademark_id", "category3_id", "spu_name", "trademark_name", *CATEGORIES)

#: What each level points to: (column, level).
PARENTS = {"sku": (("spu_id", "spu"), ("tm_id", "trademark"), ("category3_id", "category3")),
           "category3": (("category2_id", "category2"),), "category2": (("category1_id", "category1"),)}


def flat_categories(dims: Mapping[str, DataFrame]) -> DataFrame:
    """``id`` of each third-level category with its name and the levels above; what is missing above is null."""
    third = dims["category3"].select("id", F.col("name").alias("category3_name"), "category2_id")
    out = enrich(third, dims["category2"], "category2_id", {"name": "category2_name", "category1_id": "category1_id"})
    return enrich(out, dims["category1"], "category1_id", {"name": "category1_name"})


def flat_skus(dims: Mapping[str, DataFrame], only: DataFrame | None = None) -> DataFrame:
    """``id`` of each sku with the columns of its whole snowflake; ``only`` has the ids asked for."""
    sku = dims["sku"] if only is None else dims["sku"].join(only.select("id"), "id", "left_semi")
    own = sku.select("id", "sku_name", "spu_id", F.col("tm_id").alias("trademark_id"), "category3_id")
    out = enrich(own, dims["spu"], "spu_id", {"spu_name": "spu_name"})
    return enrich_categories(out, dims).select("id", *FLAT)


def touched(dims: Mapping[str, DataFrame], changed: Mapping[str, DataFrame], level: str = "sku") -> DataFrame | None:
    """Distinct ``id`` of a level's rows that ``changed`` (ids by level) holds, or that hang below such rows; None if there can be none."""
    found = changed[level].select("id") if level in changed else None
    for column, parent in PARENTS.get(level, ()):
        above = touched(dims, changed, parent)
        if above is not None:
            ids = above.select(F.col("id").alias("_above"))
            below = dims[level].join(ids, F.col(column) == F.col("_above"), "left_semi").select("id")
            found = below if found is None else found.union(below)
    return None if found is None else found.distinct()


def enrich_snowflake(df: DataFrame, dims: Mapping[str, DataFrame], key: str = "sku_id") -> DataFrame:
    """sku -> spu, trademark, category 3 -> 2 -> 1, in a single join with the flattened dimension.

    That is ``dims["flat"]`` where the caller keeps one (see :func:`..sources.flat.keep_flat`), or made from the others,
    which are joined with each other only.
    """
    flat = dims["flat"] if "flat" in dims else flat_skus(dims)
    return enrich(df, flat, key, {c: c for c in FLAT})


def by_key(dim: DataFrame, matches: Sequence[tuple[str, str]] | str) -> DataFrame:
    """Dimension rows by primary key, or by several column/value pairs."""
    pairs = [("id", matches)] if isinstance(matches, str) else list(matches)
    for column, value in pairs:
        dim = dim.where(F.col(column) == value)
    return dim


def _equal(on: Mapping[str, str]) -> Column:
    cond = None
    for mine, theirs in on.items():
        part = F.col(mine) == F.col(f"_r_{theirs}")
        cond = part if cond is None else cond & part
    return cond


def _tidy(left: DataFrame, right: DataFrame, joined: DataFrame) -> DataFrame:
    new = [c for c in right.columns if c not in left.columns]
    return joined.select(*left.columns, *[F.col(f"_r_{c}").alias(c) for c in new])
