"""Log and change feeds derived from the driver tables.

Each feed is a plain projection of whole tables, so it grows with them; the SQL
twins in :mod:`rillmart.checks.sql` state the same rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clock

ORDER_EPOCH = 1_704_067_200  # fixed value: order 0 is placed at 2024-01-01 00:00:00
ORDER_STEP_S = 7

# A Han character for each letter.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
HAN = "".join(chr(0x4E00 + i) for i in range(26))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def entries(**columns: Column) -> Column:
    """A map<string,string> of the given columns."""
    return F.create_map(*[x for k, v in columns.items() for x in (F.lit(k), v.cast("string"))])


# --- logs ------------------------------------------------------------------

def visits(spark: SparkSession, sf: str, dealt: bool = False) -> DataFrame:
    """``events`` as page views, one flat row each; ``dealt`` over all tasks, for work that costs more than the few tasks that read a
    table of few row groups should do."""
    e = table(spark, sf, "events")
    if dealt:
        e = e.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "event_id", "ts")
    k = F.get_json_object("props", "$.k").cast("int")
    page = (F.when(F.col("event_type") == "view", "home").when(F.col("event_type") == "click", "good_detail")
            .when(F.col("event_type") == "signup", "login").otherwise("order"))
    last = F.when(k % 4 == 1, "login").when(k % 4 == 2, "search").when(k % 4 == 3, "home")
    flat = e.select(
        "event_id", "event_type", "value", k.alias("k"), F.col("user_id").cast("string").alias("mid"),
        F.col("ts").cast("timestamp").alias("t"), page.alias("page_id"), last.alias("last_page_id"))
    return flat.select(
        "*",
        F.when(F.col("k") % 5 != 0, F.col("mid")).alias("uid"),
        F.concat(F.lit("v"), F.col("k") % 2).alias("vc"),
        F.concat(F.lit("ch"), F.col("k") % 3).alias("ch"),
        F.concat(F.lit("ar"), F.col("mid").cast("bigint") % 5).alias("ar"),
        F.when(F.col("k") % 2 == 0, "1").otherwise("0").alias("is_new"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("during"),
        F.unix_millis("t").alias("ts"))


def crowded(df: DataFrame, key: str, number: str = "event_id") -> DataFrame:
    """The same rows, a third of which belong to one key."""
    return df.withColumn(key, F.when(F.col(number) % 3 == 0, F.lit("crowd")).otherwise(F.col(key)))


def log_frame(spark: SparkSession, sf: str, dealt: bool = False) -> DataFrame:
    """Visits in the shape of parsed log records, plus ``event_id``."""
    v = visits(spark, sf, dealt)
    return v.select(
        "event_id",
        F.struct("mid", "uid", "vc", "ch", "ar", "is_new").alias("common"),
        F.struct("page_id", "last_page_id",
                 F.when(F.col("k") % 7 != 0, F.concat(F.lit("red "), F.col("event_type"), F.lit(" No."),
                                                     F.col("k"))).alias("item"),
                 F.when(F.col("k") % 3 != 0, "keyword").otherwise("sku_id").alias("item_type"),
                 F.col("during").cast("string").alias("during_time")).alias("page"),
        F.when(F.col("k") % 10 == 0, F.lit('{"entry":"icon"}')).alias("start"),
        F.when(F.col("k") % 6 == 0, F.lit('{"error_code":1}')).alias("err"),
        F.when(F.col("k") % 4 != 0, F.transform(
            F.sequence(F.lit(1), F.greatest(F.col("k") % 4, F.lit(1))),
            lambda i: F.concat(F.lit('{"order":'), i, F.lit("}")))).alias("displays"),
        F.when(F.col("k") % 3 != 0, F.transform(
            F.sequence(F.lit(1), F.greatest(F.col("k") % 3, F.lit(1))),
            lambda i: F.concat(F.lit('{"action_id":'), i, F.lit("}")))).alias("actions"),
        "ts", "t")


def log_text(spark: SparkSession, sf: str) -> DataFrame:
    """The raw log: JSON text with fields that no reader names, numbers and nested bodies.

    Of ten records one is cut short and two have something behind the object; two more have white
    space behind it, which does no harm.
    """
    def body(name: str) -> Column:
        return F.try_parse_json(F.col(name)).alias(name)

    def bodies(name: str) -> Column:
        return F.transform(name, lambda x: F.try_parse_json(x)).alias(name)

    number = F.col("event_id") % 10
    raw = F.to_json(F.struct(
        F.col("common").withField("os", F.concat(F.lit("os "), F.col("event_id") % 4)).alias("common"),
        F.col("page").withField("during_time", F.col("page.during_time").cast("bigint"))
        .withField("source_type", F.col("event_id") % 9).alias("page"),
        body("start"), body("err"), bodies("displays"), bodies("actions"), "ts",
        F.struct((F.col("event_id") % 100).alias("n"), F.array(F.lit("a"), F.lit("b")).alias("list")).alias("extra")))
    tail = (F.when(number == 4, "\n").when(number == 5, " \t").when(number == 6, " garbage}")
            .when(number == 7, ' {"x":1}').otherwise(""))
    return log_frame(spark, sf, dealt=True).select("event_id", F.explode(F.array(
        F.when(number == 3, F.substring(raw, 1, 40)).otherwise(F.concat(raw, tail)))).alias("value"))


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    return visits(spark, sf).where(F.col("event_type") == "purchase").select(
        F.col("mid").alias("user_id"), "event_id", "t", "value")


# --- changes ---------------------------------------------------------------

def order_time(key: Column | str) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.lit(ORDER_EPOCH).cast("bigint") + key * ORDER_STEP_S


def _envelope(df: DataFrame, name: str, kind: Column | str, data: Column, seconds: Column,
              old: Column | None = None) -> DataFrame:
    nothing = F.lit(None).cast("map<string,string>")
    return df.select(
        F.lit("shop").alias("database"), F.lit(name).alias("table"),
        (F.lit(kind) if isinstance(kind, str) else kind).alias("type"), data.alias("data"),
        (nothing if old is None else old).alias("old"), seconds.cast("string").alias("ts"),
        F.timestamp_seconds(seconds).alias("t"))


def line_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(16,2)")


def code(n: Column) -> Column:
    """Dictionary codes 2400..2424; the dictionary has nearly all of them."""
    return (n % 25 + 2400).cast("string")


def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation")
    return n.where(~F.col("n_nationkey").isin(7, 13)).select(
        (F.col("n_nationkey") + 2400).cast("string").alias("dic_code"),
        F.col("n_name").alias("dic_name"), F.col("n_regionkey").cast("string").alias("parent_code"))


def _time_text(seconds: Column) -> Column:
    return clock.second_text(F.timestamp_seconds(seconds))


def line_changes(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    at = order_time("l_orderkey") + F.col("l_linenumber")
    total, activity = money("l_extendedprice"), money("l_tax")
    coupon = F.when(F.col("l_linenumber") > 4, money("l_discount"))
    return _envelope(li, "order_detail", "insert", entries(
        id=line_id(), order_id=F.col("l_orderkey"), sku_id=F.col("l_partkey"),
        sku_name=F.concat(F.lit("sku "), F.col("l_partkey")), create_time=_time_text(at),
        source_id=F.col("l_suppkey"), source_type=code(F.col("l_suppkey")),
        sku_num=F.col("l_quantity").cast("int"), order_price=total, split_total_amount=total,
        split_activity_amount=activity, split_coupon_amount=coupon), at)


def order_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Per order an insert, and an update to 1003, 1005 or 1006 by its status."""
    o = table(spark, sf, "orders")
    at = order_time("o_orderkey")
    base = dict(id=F.col("o_orderkey"), user_id=F.col("o_custkey"), province_id=F.col("o_custkey") % 25)
    made = _envelope(o, "order_info", "insert", entries(**base, order_status=F.lit("1001")), at)
    status = (F.when(F.col("o_orderstatus") == "F", "1003").when(F.col("o_orderstatus") == "P", "1005")
              .otherwise("1006"))
    later = at + F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey") % 1800).otherwise(
        F.lit(22)).cast("bigint")
    old = F.when(F.col("o_orderkey") % 3 != 0, entries(order_status=F.lit("1001"))).otherwise(
        entries(operate_time=_time_text(at)))
    moved = _envelope(o, "order_info", "update", entries(
        **base, order_status=status, operate_time=_time_text(later)), later, old)
    return made.unionByName(moved)


def offer_changes(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    at = order_time("l_orderkey") + F.col("l_linenumber") + 1
    act = _envelope(
        li.where((F.col("l_orderkey") + F.col("l_linenumber")) % 3 == 0), "order_detail_activity",
        "insert", entries(order_detail_id=line_id(), activity_id=F.col("l_orderkey") % 5,
                          activity_rule_id=F.col("l_linenumber") % 4), at + F.when(F.col("l_linenumber") == 2, 8).otherwise(0))
    cou = _envelope(
        li.where((F.col("l_orderkey") + F.col("l_linenumber")) % 4 == 0), "order_detail_coupon",
        "insert", entries(order_detail_id=line_id(), coupon_id=F.col("l_orderkey") % 9), at)
    return act.unionByName(cou)


def payment_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Per order an update to successful; some are inserted before it, fail after it, or are repeated."""
    o = table(spark, sf, "orders").where(F.col("o_orderstatus") != "F")
    key = F.col("o_orderkey")
    what = lambda when, kind, status, later: F.when(when, F.struct(
        F.lit(kind).alias("kind"), F.lit(status).alias("status"), F.lit(later).alias("later")))
    every = o.withColumn("_p", F.explode(F.array_compact(F.array(
        what(F.lit(True), "update", "1602", 0), what(key % 3 == 0, "insert", "1601", -2),
        what(key % 5 == 0, "update", "1603", 1), what(key % 4 == 0, "update", "1602", 4)))))
    at = order_time("o_orderkey") + key % 1000 + F.col("_p.later")
    return _envelope(every, "payment_info", F.col("_p.kind"), entries(
        order_id=key, user_id=F.col("o_custkey"),
        payment_type=code(F.col("o_custkey")), callback_time=_time_text(at),
        payment_status=F.col("_p.status")), at,
        F.when(F.col("_p.kind") == "update", entries(payment_status=F.lit("1601"))))


def refund_changes(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
    asked_at = order_time("l_orderkey") + F.col("l_linenumber") + 18
    request = dict(
        id=line_id(), user_id=F.col("l_orderkey") % 997, order_id=F.col("l_orderkey"),
        sku_id=F.col("l_partkey"), refund_type=code(F.col("l_linenumber")),
        refund_num=F.col("l_quantity").cast("int"), refund_amount=money("l_extendedprice"),
        refund_reason_type=code(F.col("l_partkey")), refund_reason_txt=F.concat(F.lit("reason "), F.col("l_suppkey")),
        create_time=_time_text(asked_at))
    asked = _envelope(li, "order_refund_info", "insert", entries(**request), asked_at)
    done = _envelope(li.where(F.col("l_partkey") % 2 == 0), "order_refund_info", "update", entries(
        **request, refund_status=F.lit("0705")), asked_at + 3, entries(refund_status=F.lit("0701")))
    paid_at = asked_at + 2
    status = F.when(F.col("l_linestatus") == "F", "0702").otherwise("0701")
    payment = dict(
        id=line_id(), order_id=F.col("l_orderkey"), sku_id=F.col("l_partkey"),
        payment_type=code(F.col("l_suppkey")), callback_time=_time_text(paid_at),
        total_amount=money("l_extendedprice"), refund_status=status)
    kind = F.when(F.col("l_suppkey") % 3 == 0, "update").otherwise("insert")
    paid = _envelope(li, "refund_payment", kind, entries(**payment), paid_at,
                     F.when(F.col("l_suppkey") % 3 == 0, entries(refund_status=F.lit("0701"))))
    return asked.unionByName(done).unionByName(paid)


def cart_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Line 1 is an insert, others update the number; line 7 updates something else."""
    li = table(spark, sf, "lineitem")
    at = order_time("l_orderkey") + F.col("l_linenumber")
    before = ((F.col("l_partkey") * 7 + F.col("l_linenumber")) % 50 + 1).cast("int")
    old = (F.when(F.col("l_linenumber") == 7, entries(source_id=F.lit("0")))
           .when(F.col("l_linenumber") != 1, entries(sku_num=before)))
    return _envelope(li, "cart_info", F.when(F.col("l_linenumber") == 1, "insert").otherwise("update"), entries(
        id=line_id(), user_id=F.col("l_orderkey") % 997, sku_id=F.col("l_partkey"),
        source_id=F.col("l_suppkey"), source_type=code(F.col("l_suppkey")),
        sku_num=F.col("l_quantity").cast("int")), at, old)


def cdc_frame(spark: SparkSession, sf: str) -> DataFrame:
    """The change topic of the shop, parsed. A reader of one table prunes the others."""
    parts = [f(spark, sf) for f in (line_changes, order_changes, offer_changes, payment_changes,
                                    refund_changes, cart_changes)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def shop_text(spark: SparkSession, sf: str) -> DataFrame:
    """The change topic of the shop as JSON text."""
    return cdc_frame(spark, sf).select(F.to_json(F.struct("database", "table", "type", "data", "old", "ts")).alias("value"))


def cdc_text(spark: SparkSession, sf: str) -> DataFrame:
    """Order changes as JSON text with bootstrap records and broken text among them."""
    o = table(spark, sf, "orders")
    kinds = F.array(*[F.lit(x) for x in ("insert", "update", "bootstrap-start", "bootstrap-insert",
                                         "bootstrap-complete", "delete")])
    raw = F.to_json(F.struct(
        F.lit("shop").alias("database"), F.lit("order_info").alias("table"),
        F.element_at(kinds, (F.col("o_orderkey") % 6 + 1).cast("int")).alias("type"),
        entries(id=F.col("o_orderkey"), user_id=F.col("o_custkey")).alias("data"),
        order_time("o_orderkey").cast("string").alias("ts")))
    return o.select(F.when(F.col("o_orderkey") % 11 == 0, F.substring(raw, 1, 30)).otherwise(raw).alias("value"))


def line_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Order detail rows of which many share an id: versions, ordered by ``t, seq``."""
    seq = ((F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")) * 100 + F.col("l_quantity").cast("bigint")
           ) * 100 + F.round(F.col("l_discount") * 100).cast("bigint")
    at = order_time("l_orderkey") + F.col("l_linenumber") + F.col("l_partkey") % 30
    return table(spark, sf, "lineitem").select(
        line_id().alias("id"), F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("sku_id"),
        (F.col("l_suppkey") % 25).cast("string").alias("province_id"),
        F.when(F.col("l_suppkey") % 17 != 0, (F.col("l_orderkey") % 997).cast("string")).alias("user_id"),
        F.when(F.col("l_suppkey") % 19 != 0, F.col("l_linestatus")).alias("source_type_name"),
        (money("l_extendedprice") * F.col("l_quantity").cast("int")).cast("string").alias("split_original_amount"),
        F.when(F.col("l_linenumber") > 2, money("l_tax").cast("string")).alias("split_activity_amount"),
        F.when(F.col("l_linenumber") > 4, money("l_discount").cast("string")).alias("split_coupon_amount"),
        money("l_extendedprice").cast("string").alias("split_total_amount"),
        at.alias("ts"), F.timestamp_seconds(at).alias("t"), seq.alias("seq"))


# --- dimensions ------------------------------------------------------------

def dimensions(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """sku, spu, trademark and three category levels; some parents are missing."""
    p, s = table(spark, sf, "part"), table(spark, sf, "supplier")
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    text = lambda c: F.col(c).cast("string")
    return {
        "sku": p.where(F.col("p_partkey") % 101 != 0).select(
            text("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
            F.col("p_brand").alias("tm_id"), text("p_size").alias("category3_id"),
            (F.col("p_partkey") % 100).cast("string").alias("spu_id")),
        "spu": s.select(text("s_suppkey").alias("id"), F.col("s_name").alias("spu_name")),
        "trademark": p.groupBy(F.col("p_brand").alias("id")).agg(F.min("p_type").alias("tm_name")),
        "category3": n.select(
            text("n_nationkey").alias("id"), F.col("n_name").alias("name"),
            ((F.col("n_nationkey") + 1) % 8).cast("string").alias("category2_id")),
        "category2": n.where(F.col("n_nationkey") < 7).select(
            text("n_nationkey").alias("id"), F.col("n_name").alias("name"),
            text("n_regionkey").alias("category1_id")),
        "category1": r.select(text("r_regionkey").alias("id"), F.col("r_name").alias("name")),
        "province": n.where(F.col("n_nationkey") != 3).select(
            text("n_nationkey").alias("id"), F.col("n_name").alias("name")),
    }


def rules(spark: SparkSession, sf: str) -> DataFrame:
    """Routing rules named after the tables: one per nation for facts, a few for dimensions."""
    n = table(spark, sf, "nation")
    fact = n.select(
        F.concat(F.lit("t"), F.col("n_nationkey") % 10).alias("source_table"),
        F.when(F.col("n_nationkey") < 10, "insert").when(F.col("n_nationkey") < 20, "update")
        .otherwise("delete").alias("source_type"),
        F.concat(F.lit("dwd_"), F.lower("n_name")).alias("sink_table"), F.lit("dwd").alias("sink_type"),
        F.when(F.col("n_nationkey") % 2 == 0, "id,user_id").otherwise("id, status").alias("sink_columns"),
        F.lit(None).cast("string").alias("sink_pk"), F.lit(None).cast("string").alias("sink_extend"))
    dim = n.where(F.col("n_nationkey") < 6).select(
        F.concat(F.lit("t"), F.col("n_nationkey")).alias("source_table"),
        F.lit(None).cast("string").alias("source_type"),
        F.concat(F.lit("dim_"), F.lower("n_name")).alias("sink_table"), F.lit("dim").alias("sink_type"),
        F.lit("user_id,status").alias("sink_columns"),
        F.when(F.col("n_nationkey") > 2, "user_id").alias("sink_pk"),
        F.lit(None).cast("string").alias("sink_extend"))
    return fact.unionByName(dim)


def rule_feed(spark: SparkSession, sf: str) -> DataFrame:
    """A change log of rules out of ``events``: put, delete or re-key, three at a time of equal ``seq``."""
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    name = lambda n: F.concat(F.lit("s"), n)

    def rule(n: Column) -> Column:
        none = F.lit(None).cast("string")
        return F.struct(
            name(n).alias("source_table"), F.when(k % 2 == 0, "insert").otherwise("update").alias("source_type"),
            F.concat(F.lit("k"), F.col("event_id")).alias("sink_table"),
            F.when(F.col("user_id") % 5 == 0, "dim").otherwise("dwd").alias("sink_type"),
            F.lit("id,name").alias("sink_columns"), none.alias("sink_pk"), none.alias("sink_extend"))

    key, moved = F.col("user_id"), F.col("user_id") + 5
    gone = F.col("event_type") == "error"
    rekey = F.col("event_type") == "signup"
    return e.select(
        F.when(gone | rekey, rule(key)).alias("before"),
        F.when(rekey, rule(moved)).when(~gone, rule(key)).alias("after"),
        F.when(gone, "d").when(rekey, "u").otherwise("c").alias("op"),
        F.floor(F.col("event_id") / 3 + 1).alias("seq"), F.col("event_id").alias("pos"))


def routed_text(spark: SparkSession, sf: str) -> DataFrame:
    """:func:`routed_changes` as the JSON text of a change log, with fields that no rule names and numbers."""
    c = routed_changes(spark, sf)
    number = lambda n: F.col("data")[n].cast("bigint").alias(n)
    return c.select(F.to_json(F.struct(
        "database", "table", "type", F.col("ts").cast("bigint").alias("ts"), (F.col("ts").cast("bigint") % 1000).alias("xid"),
        F.lit(0).alias("xoffset"), F.struct(number("id"), number("user_id"), F.col("data")["status"].alias("status"),
                                            F.col("data")["note"].alias("note")).alias("data"))).alias("value"))


def routed_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of ten tables t0..t9 out of ``orders``."""
    o = table(spark, sf, "orders")
    kind = (F.when(F.col("o_orderstatus") == "F", "insert").when(F.col("o_orderstatus") == "O", "update")
            .otherwise("delete"))
    at = order_time("o_orderkey")
    return o.select(
        F.lit("shop").alias("database"), F.concat(F.lit("t"), F.col("o_orderkey") % 10).alias("table"),
        kind.alias("type"),
        entries(id=F.col("o_orderkey"), user_id=F.col("o_custkey"), status=F.col("o_orderstatus"),
                note=F.col("o_orderpriority")).alias("data"),
        at.cast("string").alias("ts"), F.timestamp_seconds(at).alias("t"))
