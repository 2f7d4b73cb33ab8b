"""The jobs on streams, with the results of their batch forms.

A job's keyed rows come out of state without event-time rules; one watermark is set
right before the window. Rows behind it are dropped there and counted by Spark as
``numRowsDroppedByWatermark``. The watermark delay must cover how far apart two
versions of a detail row may be, or a late retraction is among the dropped rows.

State stays unless a job is given ``keep_s``: then a key's state ends that long after its last row, in event time, once
the watermark has passed. The watermark is set before the state in that case, so rows behind it are dropped there.

Jobs with allowed lateness are meant for update mode and a sink keyed by window and
dimensions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import amount_or_zero
from ..functions.words import words_of
from ..operators import parse
from ..operators.joins import enrich, enrich_categories, enrich_sku, enrich_snowflake
from ..operators.windows import WIDTH, label, total, tumble, watermarked
from ..plans.summary import CHANNEL, PAGE_NAMES, REFUND_COLUMNS, SKU_AMOUNTS, SKU_COLUMNS, VISITS, channel_rows
from .processors import day_firsts, retractions, with_day



def _before_state(df: DataFrame, keep_s: int | None, delay_s: int, lateness_s: int = 0) -> DataFrame:
    return df if keep_s is None else watermarked(df, delay_s=delay_s, lateness_s=lateness_s)


def _before_window(df: DataFrame, keep_s: int | None, delay_s: int, lateness_s: int = 0) -> DataFrame:
    return watermarked(df, delay_s=delay_s, lateness_s=lateness_s) if keep_s is None else df


def _one() -> Column:
    return F.lit(1).cast("bigint")


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def keyword_page_view(log: DataFrame, dictionary: Iterable[str] | None = None, delay_s: int = 3,
                      width: str = WIDTH) -> DataFrame:
    searches = log.where(parse.is_keyword_search()).select(F.col("page.item").alias("_item"), "t")
    words = words_of(searches, "_item", "keyword", dictionary)
    return tumble(watermarked(words, delay_s=delay_s), {"keyword_count": F.count("*")}, ["keyword"],
                  width=width)


def channel_page_view(log: DataFrame, delay_s: int = 0, lateness_s: int = 10,
                      keep_s: int | None = None, width: str = WIDTH, mode: str = "update") -> DataFrame:
    """``keep_s`` of a day or more forgets visitors without changing a visitor's first page of a day."""
    rows = _before_state(channel_rows(log), keep_s, delay_s, lateness_s)
    views = rows.select(
        "t", *CHANNEL, _zero().alias("uv_ct"), F.col("last_page_id").isNull().cast("bigint").alias("sv_ct"),
        _one().alias("pv_ct"), F.coalesce("during", _zero()).alias("dur_sum"))
    firsts = day_firsts(with_day(rows.select("mid", "t", "ts", *CHANNEL)), ["mid"], ["ts", *CHANNEL],
                        mode, keep_s)
    visitors = firsts.select("t", *CHANNEL, _one().alias("uv_ct"), _zero().alias("sv_ct"),
                             _zero().alias("pv_ct"), _zero().alias("dur_sum"))
    both = _before_window(views.unionByName(visitors), keep_s, delay_s, lateness_s)
    return tumble(both, total(*VISITS), CHANNEL, width=width)


def page_view(log: DataFrame, delay_s: int = 0, width: str = WIDTH, mode: str = "append",
              keep_s: int | None = None) -> DataFrame:
    rows = _before_state(log.where(parse.is_home_or_detail()).select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "t"), keep_s, delay_s)
    firsts = day_firsts(with_day(rows), ["mid", "page_id"], ["t"], mode, keep_s)
    flags = firsts.select("t", *[
        (F.col("page_id") == value).cast("bigint").alias(out) for value, out in PAGE_NAMES.items()])
    return tumble(_before_window(flags, keep_s, delay_s), total(*PAGE_NAMES.values()), width=width)


def user_login(log: DataFrame, delay_s: int = 0, gap_days: int = 8, width: str = WIDTH,
               mode: str = "append") -> DataFrame:
    rows = log.where(parse.is_login()).select(F.col("common.uid").alias("uid"), "t")
    firsts = day_firsts(with_day(rows), ["uid"], ["t"], mode, gaps=True)
    flags = firsts.select("t", (F.col("gap_days") >= gap_days).cast("bigint").alias("back_ct"),
                          _one().alias("uu_ct"))
    return tumble(watermarked(flags, delay_s=delay_s), total("back_ct", "uu_ct"), width=width)


def user_register(rows: DataFrame, delay_s: int = 0, width: str = WIDTH) -> DataFrame:
    return tumble(watermarked(rows.select("t"), delay_s=delay_s), {"register_ct": F.count("*")},
                  width=width)


def cart_add_users(carts: DataFrame, delay_s: int = 0, width: str = WIDTH, mode: str = "append",
                   keep_s: int | None = None) -> DataFrame:
    rows = _before_state(carts.where(F.col("user_id").isNotNull()).select("user_id", "t"), keep_s, delay_s)
    firsts = day_firsts(with_day(rows), ["user_id"], ["t"], mode, keep_s)
    return tumble(_before_window(firsts, keep_s, delay_s), {"cart_add_uu_ct": F.count("*")}, width=width)


def _user_days(rows: DataFrame, unique: str, new: str, delay_s: int, width: str, mode: str) -> DataFrame:
    zeros = rows.select("t", _zero().alias(unique), _zero().alias(new))
    known = rows.where(F.col("user_id").isNotNull())
    flagged = day_firsts(with_day(known), ["user_id"], ["t"], mode).select(
        "t", _one().alias(unique), F.col("first_ever").cast("bigint").alias(new))
    return tumble(watermarked(zeros.unionByName(flagged), delay_s=delay_s), total(unique, new), width=width)


def order_users(details: DataFrame, delay_s: int = 0, width: str = WIDTH, mode: str = "append") -> DataFrame:
    rows = parse.complete_orders(details).select("user_id", "t")
    return _user_days(rows, "order_unique_user_count", "order_new_user_count", delay_s, width, mode)


def payment_users(paid: DataFrame, delay_s: int = 0, width: str = WIDTH, mode: str = "append") -> DataFrame:
    return _user_days(paid.select("user_id", "t"), "payment_suc_unique_user_count",
                      "payment_suc_new_user_count", delay_s, width, mode)


def _cents(c: str) -> Column:
    return (amount_or_zero(c) * 100).cast("bigint")


def _amount(c: str) -> Column:
    return (F.col(c).cast("decimal(18,0)") / 100).cast("decimal(16,2)")


def _changelog(details: DataFrame, keep: Sequence[str], amounts: Mapping[str, str],
               order: Sequence[str], mode: str, keep_s: int | None = None) -> DataFrame:
    """Retraction changelog of detail rows: ``t, keep, amounts``."""
    time = [] if keep_s is None else ["t"]
    plain = details.select(
        "id", *keep, *[_cents(c).alias(a) for c, a in amounts.items()],
        F.unix_micros("t").alias("_us"), *[F.col(c).cast("bigint").alias(c) for c in order], *time)
    moved = retractions(plain, "id", ["_us", *order], list(amounts.values()), mode, keep_s)
    t = F.timestamp_micros("_us").alias("t") if keep_s is None else F.col("t")
    return moved.select(t, *keep, *[_amount(a).alias(a) for a in amounts.values()])


def province_orders(details: DataFrame, province: DataFrame, order: Sequence[str] = ("seq",),
                    delay_s: int = 0, lateness_s: int = 5, keep_s: int | None = None,
                    width: str = WIDTH, mode: str = "update") -> DataFrame:
    """``keep_s`` ends both what is remembered of a detail row's last version and of an order being counted."""
    details = _before_state(details, keep_s, delay_s, lateness_s)
    amounts = _changelog(details, ["province_id"], {"split_total_amount": "order_amount"}, order, mode, keep_s)
    once = details.select("order_id", "province_id", "t", "id", *order).withColumn("_day", F.lit(0))
    orders = day_firsts(once, ["order_id"], ["t", *order, "id"], mode, keep_s).select(
        "t", "province_id", _one().alias("order_count"), F.lit(0).cast("decimal(16,2)").alias("order_amount"))
    both = amounts.withColumn("order_count", _zero()).unionByName(orders)
    per_window = tumble(_before_window(both, keep_s, delay_s, lateness_s),
                        total("order_count", "order_amount"), ["province_id"], width=width)
    named = enrich(per_window, province, "province_id", {"name": "province_name"}, default="")
    return named.select("stt", "edt", "province_id", "province_name", "order_count", "order_amount")


def sku_orders(details: DataFrame, dims: Mapping[str, DataFrame], order: Sequence[str] = ("seq",),
               delay_s: int = 5, lateness_s: int = 5, width: str = WIDTH, mode: str = "update",
               keep_s: int | None = None) -> DataFrame:
    details = _before_state(parse.complete_orders(details), keep_s, delay_s, lateness_s)
    rows = _changelog(details, ["sku_id"], SKU_AMOUNTS, order, mode, keep_s)
    per_window = tumble(_before_window(rows, keep_s, delay_s, lateness_s),
                        total(*SKU_AMOUNTS.values()), ["sku_id"], width=width)
    return enrich_snowflake(per_window, dims).select("stt", "edt", *SKU_COLUMNS)


def refund_users(refunds: DataFrame, dims: Mapping[str, DataFrame], delay_s: int = 0,
                 width: str = WIDTH) -> DataFrame:
    """Distinct orders per window: repeats of an order within its window are dropped, then rows are counted.

    The window is part of what makes a row a repeat, so Spark forgets an order when its window closes, and no set of
    orders is held by a group.
    """
    rows = enrich_sku(refunds.select("order_id", "user_id", "sku_id", "t"), dims)
    keys = ["trademark_id", "category3_id", "user_id"]
    placed = watermarked(rows, delay_s=delay_s).select(F.window("t", width).alias("_w"), *keys, "order_id")
    once = placed.dropDuplicates(["_w", *keys, "order_id"])
    counted = label(once.groupBy("_w", *keys).agg(F.count("order_id").alias("refund_count")), keys, ["refund_count"])
    return enrich_categories(counted, dims).select("stt", "edt", *REFUND_COLUMNS)
