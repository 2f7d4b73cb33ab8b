"""Keyed measures in their batch form.

Each answer is what a row-by-row state machine would give on rows in time
order. None of them sorts all rows of a key: first rows of days are aggregates
with a map-side combine, and only what remains - at most one row per key and
day - is looked at in sequence.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clock
from .skew import HOT_ROWS, join_per_key, with_previous


def repair_visitor_flag(df: DataFrame, mid: str = "mid", flag: str = "is_new",
                        order: Sequence[str] = ("ts",), t: str = "t",
                        hot_rows: int = HOT_ROWS) -> DataFrame:
    """Clear ``flag`` on rows that claim a new visitor on a day after the first one.

    The first day is the day of the first row if that row says new, else the day
    before it.
    """
    days = first_days(df, mid, flag, order, t).select(mid, "n", "first_day")
    return with_first_days(df, days, mid, flag, order, t, hot_rows)


def first_days(df: DataFrame, mid: str = "mid", flag: str = "is_new", order: Sequence[str] = ("ts",), t: str = "t") -> DataFrame:
    """``mid, at, first_day, n``: where each visitor's first row is in ``order``, the day it tells, and how many rows there are."""
    said_new = F.col("_first")[flag] == "1"
    first_day = F.when(said_new, clock.day("_first._t")).otherwise(clock.yesterday("_first._t"))
    per_mid = df.where(F.col(mid).isNotNull()).groupBy(mid).agg(
        F.min(F.struct(*order, F.col(t).alias("_t"), F.col(flag))).alias("_first"), F.count("*").alias("n"))
    return per_mid.select(mid, F.struct(*[F.col("_first")[c].alias(c) for c in order]).alias("at"),
                          first_day.alias("first_day"), "n")


def with_first_days(df: DataFrame, days: DataFrame, mid: str = "mid", flag: str = "is_new", order: Sequence[str] = ("ts",),
                    t: str = "t", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows of ``df`` with the flag cleared where it claims a new visitor after the first day; ``days`` has ``mid, n, first_day``."""
    joined = join_per_key(df, days, mid, "n", "first_day", list(order), hot_rows)
    wrong = (F.col(flag) == "1") & (F.col("first_day") != clock.day(t))
    return joined.withColumn(flag, F.when(wrong, F.lit("0")).otherwise(F.col(flag))).drop("first_day")


def repair_log(log: DataFrame, order: Sequence[str] = ("ts",), **hot: int) -> DataFrame:
    """:func:`repair_visitor_flag` on the good records of a marked log; dirty ones keep no visitor."""
    known = log.withColumn("mid", F.when(F.col("ok"), F.col("mid")))
    return repair_visitor_flag(known, "mid", "is_new", order, **hot)


def first_of_day(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("t",),
                 t: str = "t") -> DataFrame:
    """The first row of each key and day, whole."""
    rest = [c for c in df.columns if c not in keys]
    first = df.withColumn("_day", clock.day(t)).groupBy(*keys, "_day").agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return first.select(*keys, "_row.*").select(*df.columns)


def first_times(df: DataFrame, keys: Sequence[str], t: str = "t") -> DataFrame:
    """``keys, day, t`` of the first row of each key and day; a plain hash aggregate."""
    return df.groupBy(*keys, clock.day(t).alias("day")).agg(F.min(t).alias(t))


def user_day_measures(df: DataFrame, user: str, unique: str, new: str, t: str = "t",
                      width: str = "10 seconds") -> DataFrame:
    """Rows ``t, unique, new``: 1 on a user's first row of a day / first row ever.

    Every window with rows also gets a row of zeros, so a window in which nobody is
    unique is still reported. Windows and user days come out of one pass over
    the input, as two grouping sets of one aggregate.
    """
    cut = df.select(F.col(user).alias("_u"), clock.day(t).alias("_day"), F.window(t, width)["start"].alias("_w"), F.col(t).alias("_t"))
    both = cut.groupingSets([["_w"], ["_u", "_day"]], "_w", "_u", "_day").agg(
        (F.grouping("_w") == 1).alias("_by_user"), F.min("_t").alias(t)).where(~F.col("_by_user") | F.col("_u").isNotNull())
    # A row of a window has no user; its window keeps such rows apart.
    earlier = F.lag("_day").over(Window.partitionBy("_u", "_w").orderBy("_day"))
    return both.withColumn("_earlier", earlier).select(
        t, F.col("_by_user").cast("bigint").alias(unique),
        (F.col("_by_user") & F.col("_earlier").isNull()).cast("bigint").alias(new))


def page_first_visits(df: DataFrame, mid: str, page: str, names: Mapping[str, str],
                      t: str = "t") -> DataFrame:
    """One 0/1 column per page value, set on a visitor's first row of a day there."""
    firsts = first_times(df.where(F.col(page).isin(*names)), [mid, page], t)
    return firsts.select(mid, t, *[
        (F.col(page) == value).cast("bigint").alias(out) for value, out in names.items()])


def login_flags(df: DataFrame, uid: str, t: str = "t", gap_days: int = 8) -> DataFrame:
    """A user's first login of each day, and whether the one before is ``gap_days`` ago."""
    firsts = first_times(df.where(F.col(uid).isNotNull()), [uid], t)
    before = F.lag("day").over(Window.partitionBy(uid).orderBy("day"))
    back = F.coalesce(clock.days_between("day", before) >= gap_days, F.lit(False))
    return firsts.select(
        uid, t, F.lit(1).cast("bigint").alias("uu_ct"), back.cast("bigint").alias("back_ct"))


def visit_measures(df: DataFrame, mid: str, dims: Sequence[str], last_page: str, during: str,
                   order: Sequence[str] = ("ts",), t: str = "t") -> DataFrame:
    """Rows ``t, dims, uv_ct, sv_ct, pv_ct, dur_sum`` to be summed per window.

    Every page counts one view, a page without predecessor one visit; a visitor's
    first page of a day counts one visitor, with the dimensions of that page.
    """
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    views = df.select(
        t, *dims, zero.alias("uv_ct"), F.col(last_page).isNull().cast("bigint").alias("sv_ct"),
        one.alias("pv_ct"), F.coalesce(F.col(during), zero).alias("dur_sum"))
    ordered = [F.col(c) for c in order]
    first = df.groupBy(mid, clock.day(t).alias("_day")).agg(
        F.min(F.struct(*ordered, *[F.col(c).alias(f"_v{i}") for i, c in enumerate([t, *dims])]))
        .alias("_f"))
    visitors = first.select(
        F.col("_f._v0").alias(t), *[F.col(f"_f._v{i + 1}").alias(d) for i, d in enumerate(dims)],
        one.alias("uv_ct"), zero.alias("sv_ct"), zero.alias("pv_ct"), zero.alias("dur_sum"))
    return views.unionByName(visitors)


def retract_changelog(df: DataFrame, key: str, order: Sequence[str], amounts: Sequence[str],
                      t: str = "t", pieces: Sequence[Column] | None = None, **hot: int) -> DataFrame:
    """Each version of a row, preceded by the version it replaces with negated amounts.

    ``sign`` is 1 for a version and -1 for a retraction, which keeps the event time of
    the version it takes back. Null amounts count as zero. ``pieces`` cut the
    versions of very heavy keys, see :func:`..skew.with_previous`.
    """
    if pieces is None:
        pieces = [F.date_trunc("second", F.col(t)), F.date_trunc("hour", F.col(t))]
    zero_filled = df.select(*[
        F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)).alias(c) if c in amounts
        else F.col(c) for c in df.columns])
    held = [c for c in df.columns if c != key]
    paired = with_previous(zero_filled, [key], order, pieces, held, "_prev", **hot)
    back = [
        (-F.col(f"_prev.{c}")).cast(df.schema[c].dataType).alias(c) if c in amounts
        else F.col(c) if c == key else F.col(f"_prev.{c}").alias(c) for c in df.columns]
    sides = F.array(
        F.struct(*[F.col(c) for c in df.columns], F.lit(1).alias("sign")),
        F.when(F.col("_prev").isNotNull(), F.struct(*back, F.lit(-1).alias("sign"))))
    return paired.select(F.explode(F.array_compact(sides)).alias("_e")).select("_e.*")


def net_measures(df: DataFrame, key: str, order: Sequence[str], amounts: Sequence[str], keep: Sequence[str], t: str = "t",
                 width: str = "10 seconds", once: str | None = None, out: str = "once") -> DataFrame:
    """Rows ``t, keep, amounts`` to be summed per window and ``keep`` columns: what the changelog sums up to.

    That is zero for every window that has a version, and the amounts of each key's last version. Equal to summing
    :func:`retract_changelog`, but no key is put in sequence. With ``once``, column ``out`` has 1 in one more row per value
    of that column, where it was first seen, and 0 elsewhere.

    All of it comes out of one pass over the input and one aggregate with a map-side combine: every row is there once for its window,
    once for its key and once for ``once``, each time with no more than that group looks at. Versions that ``order`` does not tell apart
    go by their other columns.
    """
    zeros = {a: F.lit(0).cast(df.schema[a].dataType) for a in amounts}
    held = [F.col(c) for c in dict.fromkeys([*order, t, *keep])]
    last = F.struct(*held, *[F.coalesce(a, z).alias(a) for a, z in zeros.items()])
    values = {"_w": F.window(t, width)["start"], **{f"_g{i}": F.col(c) for i, c in enumerate(keep)}, "_key": F.col(key), "_last": last}
    if once:
        values |= {"_once": F.col(once), "_first": F.struct(*held)}
    groups = [n for n in values if n.startswith("_g")]
    sets = [["_w", *groups], ["_key", "_last"]] + ([["_once", "_first"]] if once else [])
    typed = df.select(*[c.alias(n) for n, c in values.items()]).schema
    cut = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("_set"), *[(c if n in own else F.lit(None).cast(typed[n].dataType)).alias(n) for n, c in values.items()])
        for i, own in enumerate(sets)])).alias("_m")).select("_m.*")
    found = cut.groupBy("_set", *[n for n in values if n not in ("_last", "_first")]).agg(
        F.max("_last").alias("_last"), *([F.min("_first").alias("_first")] if once else []))
    one_of = F.when(F.col("_set") == 0, F.struct(
        F.col("_w").alias(t), *[F.col(g).alias(c) for g, c in zip(groups, keep, strict=True)], *[z.alias(a) for a, z in zeros.items()]))
    one_of = one_of.when(F.col("_set") == 1, F.struct(*[F.col("_last")[c].alias(c) for c in (t, *keep, *amounts)]))
    if not once:
        return found.select(one_of.alias("_m")).select("_m.*")
    one_of = one_of.otherwise(F.struct(*[F.col("_first")[c].alias(c) for c in (t, *keep)], *[z.alias(a) for a, z in zeros.items()]))
    return found.select(one_of.alias("_m"), (F.col("_set") == 2).cast("bigint").alias(out)).select("_m.*", out)


def count_once(df: DataFrame, key: str, order: Sequence[str], out: str,
               keep: Sequence[str], t: str = "t") -> DataFrame:
    """Rows ``t, keep, out``: one row with 1 per key, where the key was first seen."""
    first = df.groupBy(key).agg(F.min_by(F.struct(t, *keep), F.struct(*order)).alias("_first"))
    return first.select("_first.*", F.lit(1).cast("bigint").alias(out))


def mark_once(df: DataFrame, key: str, order: Sequence[str], out: str = "once",
              hot_rows: int = HOT_ROWS) -> DataFrame:
    """All rows, with 1 on the first row of each key and 0 on the others."""
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min(F.struct(*order)).alias("_first"), F.count("*").alias("_n")).select(
        key, "_n", "_first")
    joined = join_per_key(df, per_key, key, "_n", "_first", list(order), hot_rows)
    return joined.withColumn(out, (F.struct(*order) == F.col("_first")).cast("bigint")).drop("_first")
