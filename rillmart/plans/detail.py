"""Detail tables: from change records to wide rows.

Every function takes the change frame of :mod:`rillmart.operators.parse` (batch or
stream, read once) and returns the columns of its detail table plus the event
time ``t``. A batch joins whatever is there. Streams bound their joins in event time by ``ttl_s``
(``ORDER_TTL_S`` or ``CANCEL_TTL_S``), and need a watermark on ``t``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clock
from ..functions.values import packed, product_text, unpacked
from ..operators import parse
from ..operators.joins import bounded_join, bounded_joins, interval_join, lookup
from ..operators.routing import last_per_key

ORDER_TTL_S = 5
CANCEL_TTL_S = 15 * 60 + 5

AMOUNTS = ["split_original_amount", "split_activity_amount", "split_coupon_amount",
           "split_total_amount"]
CART_COLUMNS = ["id", "user_id", "sku_id", "source_id", "source_type_code", "source_type_name",
                "sku_num", "ts"]
ORDER_COLUMNS = ["id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
                 "activity_rule_id", "coupon_id", "date_id", "create_time", "source_id",
                 "source_type", "source_type_name", "sku_num", *AMOUNTS, "ts"]
CANCEL_COLUMNS = [{"create_time": "cancel_time", "source_type": "source_type_code"}.get(c, c)
                  for c in ORDER_COLUMNS]
PAY_COLUMNS = ["order_detail_id", "order_id", "user_id", "sku_id", "sku_name", "province_id",
               "activity_id", "activity_rule_id", "coupon_id", "payment_type_code",
               "payment_type_name", "callback_time", "source_id", "source_type_code",
               "source_type_name", "sku_num", *AMOUNTS[:3], "split_payment_amount", "ts"]
REFUND_COLUMNS = ["id", "user_id", "order_id", "sku_id", "province_id", "date_id", "create_time",
                  "refund_type_code", "refund_type_name", "refund_reason_type_code",
                  "refund_reason_type_name", "refund_reason_txt", "refund_num", "refund_amount",
                  "ts"]
REFUND_PAY_COLUMNS = ["id", "user_id", "order_id", "sku_id", "province_id", "payment_type_code",
                      "payment_type_name", "date_id", "callback_time", "refund_num",
                      "refund_amount", "ts"]


def cart_add(cdc: DataFrame, dic: DataFrame) -> DataFrame:
    """Goods put into carts: inserts, and the growth of updates that raised the number."""
    rows = parse.changes_of(cdc, "cart_info").where(parse.grew("sku_num")).select(
        *parse.fields("id", "user_id", "sku_id", "source_id", source_type_code="source_type"),
        parse.growth_text("sku_num").alias("sku_num"), "ts", "t")
    return lookup(rows, dic, "source_type_code", "source_type_name").select(*CART_COLUMNS, "t")


def order_lines(cdc: DataFrame) -> DataFrame:
    """Inserted order lines with their original amount."""
    return parse.changes_of(cdc, "order_detail", "insert").select(
        *parse.fields("id", "order_id", "sku_id", "sku_name", "create_time", "source_id",
                      "source_type", "sku_num", "split_total_amount", "split_activity_amount",
                      "split_coupon_amount"),
        product_text(F.col("data")["sku_num"], F.col("data")["order_price"])
        .alias("split_original_amount"), "ts", "t")


def _offers(cdc: DataFrame) -> list[DataFrame]:
    """Activities and coupons of lines."""
    return [parse.changes_of(cdc, "order_detail_activity", "insert").select(
                *parse.fields("order_detail_id", "activity_id", "activity_rule_id"), "t"),
            parse.changes_of(cdc, "order_detail_coupon", "insert").select(
                *parse.fields("order_detail_id", "coupon_id"), "t")]


def _with_offers(lines: DataFrame, cdc: DataFrame, ttl_s: int | None) -> DataFrame:
    """Left join the activity and the coupon of each line."""
    return bounded_joins(lines, _offers(cdc), {"id": "order_detail_id"}, "left", ttl_s).drop("order_detail_id")


def _with_offers_by_order(lines: DataFrame, cdc: DataFrame) -> DataFrame:
    """:func:`_with_offers` that brings the lines to their order, in place of their id.

    Offers learn the orders of their line from narrow rows, each pair of line and order once; so wide rows meet their offers where they
    meet their order, and are shuffled and sorted once for both.
    """
    own = parse.changes_of(cdc, "order_detail", "insert").select(*parse.fields(_line="id", _lies="order_id"))
    placed = own.where(F.col("_line").isNotNull() & F.col("_lies").isNotNull()).repartition("_line").distinct()
    met = []
    for offer in _offers(cdc):
        met.append(f"_met{len(met)}")
        placed = placed.join(offer.drop("t").withColumnRenamed("order_detail_id", met[-1]), F.col("_line") == F.col(met[-1]), "left")
    placed = placed.where(F.coalesce(*met).isNotNull()).drop(*met).repartition("_lies")
    return bounded_join(lines, placed, {"order_id": "_lies", "id": "_line"}, "left").drop("_lies", "_line")


def order_detail(cdc: DataFrame, dic: DataFrame, ttl_s: int | None = None, whole: bool = False) -> DataFrame:
    """Order lines with their order, activity, coupon and source type.

    Rows of a batch without ``ttl_s`` meet their order last, so that they lie by it: what joins them by order does not shuffle them again.
    ``whole`` says that all columns are wanted: what no join looks at is then shuffled as one text, and in such a batch only once, for which ids
    of lines are read a second time. Without it, columns that nobody reads are not shuffled.
    """
    lines = lookup(order_lines(cdc), dic, "source_type", "source_type_name")
    rest = [c for c, kind in lines.dtypes if kind == "string" and c not in ("id", "order_id")] if whole else []
    if whole:
        lines = lines.select(*[c for c in lines.columns if c not in rest], packed(*rest).alias("_rest"))
    orders = parse.changes_of(cdc, "order_info", "insert").select(
        *parse.fields("user_id", "province_id", _order="id"), "t")
    on = {"order_id": "_order"}
    if ttl_s is None:
        wide = bounded_join(_with_offers_by_order(lines, cdc) if whole else _with_offers(lines, cdc, ttl_s), orders, on)
    else:
        wide = _with_offers(bounded_join(lines, orders, on, ttl_s=ttl_s), cdc, ttl_s)
    if whole:
        wide = wide.select("*", *unpacked("_rest", *rest))
    return wide.withColumn(
        "date_id", clock.day_of_text("create_time")).select(*ORDER_COLUMNS, "t")


def cancel_detail(cdc: DataFrame, dic: DataFrame, ttl_s: int | None = None) -> DataFrame:
    """Lines of orders whose status moved to cancelled; the time is the cancellation's."""
    lines = lookup(order_lines(cdc), dic, "source_type", "source_type_name")
    cancelled = parse.changes_of(cdc, "order_info").where(parse.moved_to("order_status", "1003")).select(
        *parse.fields("user_id", "province_id", "operate_time", _order="id"),
        F.col("ts").alias("_cancel_ts"), F.col("t").alias("_cancel_t"))
    wide = bounded_join(lines, cancelled, {"order_id": "_order"}, t_right="_cancel_t", ttl_s=ttl_s)
    return (
        _with_offers(wide, cdc, ttl_s)
        .drop("ts", "t", "create_time")
        .withColumnsRenamed({"operate_time": "cancel_time", "_cancel_ts": "ts", "_cancel_t": "t",
                             "source_type": "source_type_code"})
        .withColumn("date_id", clock.day_of_text("cancel_time"))
        .select(*CANCEL_COLUMNS, "t")
    )


def pay_detail(details: DataFrame, cdc: DataFrame, dic: DataFrame, strict: bool = False,
               tie: Sequence[str] = ()) -> DataFrame:
    """Order detail rows paid from 15 minutes after the order row to 5 seconds before it.

    ``details`` is the order detail table with its event time ``t``. ``strict`` asks
    for an update that sets the payment status to successful. A batch keeps the last payment of
    each detail row (by ``ts``, then the columns of ``tie``); a stream emits each, for a sink keyed
    by ``order_detail_id``.
    """
    paid = parse.changes_of(cdc, "payment_info")
    if strict:
        paid = paid.where((F.col("type") == "update") & (F.col("data")["payment_status"] == "1602"))
    paid = lookup(
        paid.select(*parse.fields("callback_time", _order="order_id",
                                  payment_type_code="payment_type"),
                    F.col("ts").alias("_pay_ts"), F.col("t").alias("_pay_t")),
        dic, "payment_type_code", "payment_type_name")
    joined = interval_join(details, paid, {"order_id": "_order"}, t_right="_pay_t")
    rows = (
        joined.drop("ts", "t")
        .withColumnsRenamed({"id": "order_detail_id", "_pay_ts": "ts", "_pay_t": "t",
                             "source_type": "source_type_code",
                             "split_total_amount": "split_payment_amount"})
        .select(*PAY_COLUMNS, "t")
    )
    if rows.isStreaming:
        return rows
    numbered = rows.withColumn("_s", F.col("ts").cast("long"))
    return last_per_key(numbered, ["order_detail_id"], ["_s", *tie]).drop("_s")


def order_refund(cdc: DataFrame, dic: DataFrame, ttl_s: int | None = None) -> DataFrame:
    """Refund requests of orders whose status moved to refunding, with both code names."""
    asked = parse.changes_of(cdc, "order_refund_info", "insert").select(
        *parse.fields("id", "user_id", "order_id", "sku_id", "refund_num", "refund_amount",
                      "refund_reason_txt", "create_time", refund_type_code="refund_type",
                      refund_reason_type_code="refund_reason_type"), "ts", "t")
    asked = lookup(asked, dic, "refund_type_code", "refund_type_name")
    asked = lookup(asked, dic, "refund_reason_type_code", "refund_reason_type_name")
    orders = parse.changes_of(cdc, "order_info").where(parse.moved_to("order_status", "1005")).select(
        *parse.fields("province_id", _order="id"), "t")
    wide = bounded_join(asked, orders, {"order_id": "_order"}, ttl_s=ttl_s)
    return wide.withColumn("date_id", clock.day_of_text("create_time")).select(*REFUND_COLUMNS, "t")


def refund_pay(cdc: DataFrame, dic: DataFrame, ttl_s: int | None = None,
               strict: bool = False) -> DataFrame:
    """Paid refunds with the refunded number of their request.

    ``strict`` admits only the updates that changed each status to its final code;
    without it any update of the order matches, one row each.
    """
    paid = parse.changes_of(cdc, "refund_payment").where(F.col("data")["refund_status"] == "0702")
    orders = parse.changes_of(cdc, "order_info", "update")
    asked = parse.changes_of(cdc, "order_refund_info")
    if strict:
        paid = paid.where(parse.moved_to("refund_status", "0702"))
        orders = orders.where(parse.moved_to("order_status", "1006"))
        asked = asked.where(parse.moved_to("refund_status", "0705"))
    paid = lookup(
        paid.select(*parse.fields("id", "order_id", "sku_id", "callback_time",
                                  payment_type_code="payment_type", refund_amount="total_amount"),
                    "ts", "t"),
        dic, "payment_type_code", "payment_type_name")
    orders = orders.select(*parse.fields("user_id", "province_id", _order="id"), "t")
    asked = asked.select(*parse.fields("refund_num", _order="order_id", _sku="sku_id"), "t")
    wide = bounded_join(paid, asked, {"order_id": "_order", "sku_id": "_sku"}, ttl_s=ttl_s)
    wide = bounded_join(wide.drop("_order"), orders, {"order_id": "_order"}, ttl_s=ttl_s)
    return wide.withColumn("date_id", clock.day_of_text("callback_time")).select(
        *REFUND_PAY_COLUMNS, "t")
