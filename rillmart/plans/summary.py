"""Summary tables in their batch form: ten-second windows over detail rows.

Page logs come in with columns ``common, page, ts, t``; detail tables with
their columns and ``t``. Results lack the emit time; :func:`..operators.windows.stamped`
adds it where rows are written.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import amount_or_zero
from ..functions.words import words_of
from ..operators import keyed, parse
from ..operators.joins import enrich, enrich_categories, enrich_sku, enrich_snowflake
from ..operators.windows import WIDTH, label, total, tumble, windowed

PAGE_NAMES = {"home": "home_uv_ct", "good_detail": "good_detail_uv_ct"}
CHANNEL = ["vc", "ch", "ar", "is_new"]
VISITS = ["uv_ct", "sv_ct", "pv_ct", "dur_sum"]
SKU_AMOUNTS = {"split_original_amount": "original_amount",
               "split_activity_amount": "activity_amount",
               "split_coupon_amount": "coupon_amount", "split_total_amount": "order_amount"}
SKU_COLUMNS = ["trademark_id", "trademark_name", "category1_id", "category1_name", "category2_id",
               "category2_name", "category3_id", "category3_name", "sku_id", "sku_name", "spu_id",
               "spu_name", *SKU_AMOUNTS.values()]
REFUND_COLUMNS = ["trademark_id", "trademark_name", "category1_id", "category1_name",
                  "category2_id", "category2_name", "category3_id", "category3_name", "user_id",
                  "refund_count"]


def keyword_page_view(log: DataFrame, dictionary: Iterable[str] | None = None,
                      width: str = WIDTH) -> DataFrame:
    """Search words per window."""
    searches = log.where(parse.is_keyword_search()).select(F.col("page.item").alias("_item"), "t")
    words = words_of(searches, "_item", "keyword", dictionary)
    return tumble(words, {"keyword_count": F.count("*")}, ["keyword"], width=width)


def channel_page_view(log: DataFrame, width: str = WIDTH) -> DataFrame:
    """Visitors, visits, views and duration per version, channel, area and new flag."""
    rows = channel_rows(log)
    measures = keyed.visit_measures(rows, "mid", CHANNEL, "last_page_id", "during")
    return tumble(measures, total(*VISITS), CHANNEL, width=width)


def channel_rows(log: DataFrame) -> DataFrame:
    return log.select(
        F.col("common.mid").alias("mid"), *[F.col(f"common.{c}").alias(c) for c in CHANNEL],
        F.col("page.last_page_id").alias("last_page_id"),
        F.col("page.during_time").try_cast("bigint").alias("during"), "ts", "t")


def page_view(log: DataFrame, width: str = WIDTH) -> DataFrame:
    """First visits of the day to the home and the detail page."""
    rows = log.where(parse.is_home_or_detail()).select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "t")
    firsts = keyed.page_first_visits(rows, "mid", "page_id", PAGE_NAMES)
    return tumble(firsts, total(*PAGE_NAMES.values()), width=width)


def user_login(log: DataFrame, width: str = WIDTH) -> DataFrame:
    """Users logging in for the first time of a day, and those back after eight days."""
    rows = log.where(parse.is_login()).select(F.col("common.uid").alias("uid"), "t")
    return tumble(keyed.login_flags(rows, "uid"), total("back_ct", "uu_ct"), width=width)


def user_register(rows: DataFrame, width: str = WIDTH) -> DataFrame:
    return tumble(rows.select("t"), {"register_ct": F.count("*")}, width=width)


def cart_add_users(carts: DataFrame, width: str = WIDTH) -> DataFrame:
    """Users adding to a cart for the first time of a day."""
    firsts = keyed.first_times(carts.where(F.col("user_id").isNotNull()), ["user_id"])
    return tumble(firsts, {"cart_add_uu_ct": F.count("*")}, width=width)


def order_users(details: DataFrame, width: str = WIDTH) -> DataFrame:
    """Users ordering for the first time of a day, and for the first time at all."""
    unique, new = "order_unique_user_count", "order_new_user_count"
    rows = parse.complete_orders(details).select("user_id", "t")
    measures = keyed.user_day_measures(rows, "user_id", unique, new, width=width)
    return tumble(measures, total(unique, new), width=width)


def payment_users(paid: DataFrame, width: str = WIDTH) -> DataFrame:
    """Users paying for the first time of a day, and for the first time at all."""
    unique, new = "payment_suc_unique_user_count", "payment_suc_new_user_count"
    rows = paid.select("user_id", "t")
    measures = keyed.user_day_measures(rows, "user_id", unique, new, width=width)
    return tumble(measures, total(unique, new), width=width)


def province_orders(details: DataFrame, province: DataFrame, order: Iterable[str] = ("t", "seq"),
                    width: str = WIDTH) -> DataFrame:
    """Orders and their amount per province; the amount is that of each line's last version."""
    order = list(order)
    rows = details.select(
        "id", "order_id", "province_id", amount_or_zero("split_total_amount").alias("order_amount"),
        *dict.fromkeys(["t", *order]))
    measures = keyed.net_measures(rows, "id", order, ["order_amount"], ["province_id"], width=width,
                                  once="order_id", out="order_count")
    per_window = tumble(measures, total("order_count", "order_amount"), ["province_id"], width=width)
    named = enrich(per_window, province, "province_id", {"name": "province_name"}, default="")
    return named.select("stt", "edt", "province_id", "province_name", "order_count", "order_amount")


def sku_orders(details: DataFrame, dims: Mapping[str, DataFrame],
               order: Iterable[str] = ("t", "seq"), width: str = WIDTH) -> DataFrame:
    """Amounts per sku, enriched after aggregation so each window and sku is looked up once."""
    order = list(order)
    rows = parse.complete_orders(details).select(
        "id", "sku_id", *[amount_or_zero(c).alias(a) for c, a in SKU_AMOUNTS.items()],
        *dict.fromkeys(["t", *order]))
    net = keyed.net_measures(rows, "id", order, list(SKU_AMOUNTS.values()), ["sku_id"], width=width)
    per_window = windowed(net, total(*SKU_AMOUNTS.values()), ["sku_id"], width=width)
    started = per_window.select(F.col("_w.start").alias("_start"), "sku_id", *SKU_AMOUNTS.values())     # labels come after the join
    return label(enrich_snowflake(started, dims).withColumn("_w", F.window("_start", width)), SKU_COLUMNS, [])


def refund_users(refunds: DataFrame, dims: Mapping[str, DataFrame], width: str = WIDTH) -> DataFrame:
    """Distinct refunded orders per trademark, category and user."""
    rows = enrich_sku(refunds.select("order_id", "user_id", "sku_id", "t"), dims)
    keys = ["trademark_id", "category3_id", "user_id"]
    counted = tumble(rows, {"refund_count": F.count_distinct("order_id")}, keys, width=width)
    return enrich_categories(counted, dims).select("stt", "edt", *REFUND_COLUMNS)
