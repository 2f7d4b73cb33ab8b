"""One query per operator or job, over whole driver tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clock, payload, values, words
from ..operators import joins, keyed, parse, routing, windows
from ..plans import detail, ingest, summary, warehouse
from ..session import prepare
from ..sources import dims as dim_sources
from ..sources import flat, once, sinks, topics
from . import feeds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return f(prepare(spark), sf)

    QUERIES[f.__name__] = run
    return f


def plain_amounts(df: DataFrame) -> DataFrame:
    """Sums as decimal(18,2) text, so both engines print the same digits."""
    return df.select(*[
        F.col(n).cast("decimal(18,2)").cast("string").alias(n) if t.startswith("decimal") else F.col(n)
        for n, t in df.dtypes])


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the one that all executors see; a folder of this machine serves a local session only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        shared = tempfile.mkdtemp(prefix="rillmart-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- parsing ---------------------------------------------------------------

@query
def log_dirty_split(spark, sf):
    good, dirty = parse.split_log(feeds.log_text(spark, sf).select("value"))
    return good.select(F.lit("good").alias("route")).unionAll(
        dirty.select(F.lit("dirty").alias("route"))).groupBy("route").agg(F.count("*").alias("n"))


@query
def object_split(spark, sf):
    good, bad = parse.split_objects(feeds.log_text(spark, sf))
    return good.select("event_id", F.lit("object").alias("route")).unionAll(
        bad.select("event_id", F.lit("other").alias("route")))


@query
def log_topics(spark, sf):
    """The whole log job: every message of every topic, read back to its leaves."""
    out = ingest.log_topics(feeds.log_text(spark, sf), order=["ts", "event_id"])
    good = F.col("topic") != routing.DIRTY_TOPIC
    paths = [*(f"common.{n}" for n in ("mid", "uid", "vc", "ch", "ar", "is_new", "os")),
             *(f"page.{n}" for n in ("page_id", "last_page_id", "item", "item_type", "during_time", "source_type")),
             "start", "err", "display", "action", "ts", "extra"]
    leaves = [p.replace(".", "_") for p in paths]
    read = payload.get_texts(out.select("topic", F.when(good, F.col("value")).alias("_good")), "_good", paths, leaves)
    return read.select("topic", F.when(good, F.concat_ws(",", F.array_sort(F.json_object_keys("_good")))).alias("keys"), *leaves)


@query
def log_split_routes(spark, sf):
    routes = routing.split_routes(feeds.log_frame(spark, sf))
    rows = None
    for name, df in routes.items():
        part = df.select(F.lit(name).alias("route"), F.col("page.page_id").alias("page_id"))
        rows = part if rows is None else rows.unionAll(part)
    return rows.groupBy("route", "page_id").agg(F.count("*").alias("n"))


@query
def log_display_explode(spark, sf):
    return routing.displays(feeds.log_frame(spark, sf)).select(
        payload.get_text("display", "$.order").alias("display_order"),
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts")


@query
def log_action_explode(spark, sf):
    return routing.actions(feeds.log_frame(spark, sf)).select(
        payload.get_text("action", "$.action_id").alias("action_id"),
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"))


@query
def log_error_records(spark, sf):
    return routing.errors(feeds.log_frame(spark, sf)).select("event_id", "err", "start")


@query
def visitor_flag_repair(spark, sf):
    v = feeds.visits(spark, sf).select("event_id", "mid", "is_new", "t")
    return keyed.repair_visitor_flag(v, order=["t", "event_id"]).select("event_id", "mid", "is_new")


@query
def cdc_valid_rows(spark, sf):
    rows = parse.valid_changes(parse.parse_cdc(feeds.cdc_text(spark, sf)))
    return rows.select(F.col("data")["id"].alias("id"), "table", "type",
                       clock.second_text("t").alias("event_time"))


@query
def cdc_insert_select(spark, sf):
    return detail.order_lines(feeds.cdc_frame(spark, sf)).drop("t")


@query
def cdc_map_project(spark, sf):
    return parse.changes_of(feeds.cdc_frame(spark, sf), "order_info").select(
        *parse.fields("id", "user_id", "operate_time", "no_such_key", status="order_status"))


@query
def cdc_status_transition(spark, sf):
    rows = parse.changes_of(feeds.cdc_frame(spark, sf), "order_info").where(
        parse.moved_to("order_status", "1003"))
    return rows.select(*parse.fields("id", "operate_time"), "ts")


@query
def cart_delta(spark, sf):
    rows = parse.changes_of(feeds.cdc_frame(spark, sf), "cart_info").where(parse.grew("sku_num"))
    return rows.select(*parse.fields("id", "sku_id"), parse.growth_text("sku_num").alias("sku_num"))


@query
def line_amount(spark, sf):
    li = feeds.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", values.product_text(
        F.col("l_quantity").cast("int").cast("string"),
        feeds.money("l_extendedprice").cast("string")).alias("amount"))


# --- rules -----------------------------------------------------------------

def _rule_view(df: DataFrame) -> DataFrame:
    return df.select("source_table", "source_type", "sink_table", "sink_columns")


@query
def rule_fold_facts(spark, sf):
    changes = routing.rule_changes(None, feeds.rule_feed(spark, sf))
    return _rule_view(routing.fold_rules(changes, "dwd"))


@query
def rule_fold_dims(spark, sf):
    changes = routing.rule_changes(None, feeds.rule_feed(spark, sf))
    return _rule_view(routing.fold_rules(changes, "dim"))


@query
def rule_precedence(spark, sf):
    preload = feeds.rules(spark, sf).withColumn(
        "source_table", F.regexp_replace("source_table", "^t", "s"))
    changes = routing.rule_changes(preload, feeds.rule_feed(spark, sf))
    return _rule_view(routing.fold_rules(changes, "dwd"))


@query
def rule_route_facts(spark, sf):
    """Raw changes to the text of their topics, read back to its leaves."""
    out = ingest.routed_fact_lines(feeds.routed_text(spark, sf), feeds.rules(spark, sf), None)
    leaf = lambda path, name: payload.get_text("value", f"$.{path}").alias(name)
    return out.select(
        "sink_table", F.concat_ws(",", F.array_sort(F.json_object_keys("value"))).alias("keys"),
        F.get_json_object("value", "$.data").alias("data"),
        *(leaf(n, n) for n in ("database", "table", "type", "ts", "xid", "xoffset")), leaf("sink_table", "said_sink"))


@query
def rule_route_dims(spark, sf):
    out = ingest.routed_dims(feeds.routed_changes(spark, sf), feeds.rules(spark, sf), None)
    return out.select("sink_table", "sink_pk", "type", *parse.fields("id", "user_id", "status"))


@query
def dim_table_from_rule(spark, sf):
    p = feeds.table(spark, sf, "part")
    data = feeds.entries(p_partkey=F.col("p_partkey"), p_name=F.col("p_name"), p_size=F.col("p_size"),
                         p_brand=F.col("p_brand"))
    return dim_sources.rows_as_text(p.select(data.alias("data")), "p_partkey,p_name, p_size")


@query
def dim_upsert_latest(spark, sf):
    v = feeds.visits(spark, sf)
    routed = v.select(feeds.entries(id=F.col("mid"), name=F.col("page_id"), channel=F.col("ch")).alias("data"),
                      "t", "event_id")
    return ingest.dim_rows(routed, ["id", "name", "channel"], ["t", "event_id"])


# --- joins -----------------------------------------------------------------

@query
def dict_lookup(spark, sf):
    li = feeds.table(spark, sf, "lineitem").select(
        feeds.line_id().alias("id"), feeds.code(F.col("l_suppkey")).alias("source_type"))
    return joins.lookup(li, feeds.dictionary(spark, sf), "source_type", "source_type_name")


@query
def dict_lookup_twice(spark, sf):
    li = feeds.table(spark, sf, "lineitem").select(
        feeds.line_id().alias("id"), feeds.code(F.col("l_suppkey")).alias("source_type"),
        feeds.code(F.col("l_partkey")).alias("reason"))
    dic = feeds.dictionary(spark, sf)
    return joins.lookup(joins.lookup(li, dic, "source_type", "source_type_name"), dic, "reason",
                        "reason_name")


@query
def within_ttl_join(spark, sf):
    cdc = feeds.cdc_frame(spark, sf)
    lines = parse.changes_of(cdc, "order_detail", "insert").select(*parse.fields("id", "order_id"), "ts", "t")
    orders = parse.changes_of(cdc, "order_info", "insert").select(
        *parse.fields("user_id", _order="id"), "t")
    return joins.bounded_join(lines, orders, {"order_id": "_order"}, ttl_s=5).select(
        "id", "order_id", "user_id", "ts")


@query
def left_ttl_join(spark, sf):
    cdc = feeds.cdc_frame(spark, sf)
    lines = parse.changes_of(cdc, "order_detail", "insert").select(*parse.fields("id"), "ts", "t")
    acts = parse.changes_of(cdc, "order_detail_activity", "insert").select(
        *parse.fields("activity_id", _line="order_detail_id"), "t")
    return joins.bounded_join(lines, acts, {"id": "_line"}, "left", ttl_s=5).select(
        "id", "activity_id", "ts")


@query
def two_key_join(spark, sf):
    cdc = feeds.cdc_frame(spark, sf)
    paid = parse.changes_of(cdc, "refund_payment").select(
        *parse.fields("id", "order_id", "sku_id", "total_amount"), "t")
    asked = parse.changes_of(cdc, "order_refund_info").select(
        *parse.fields("refund_num", _order="order_id", _sku="sku_id"), "t")
    return joins.bounded_join(paid, asked, {"order_id": "_order", "sku_id": "_sku"}, ttl_s=None).select(
        "id", "order_id", "sku_id", "total_amount", "refund_num")


@query
def interval_join(spark, sf):
    v = feeds.visits(spark, sf).select("event_id", "event_type", "mid", "t")
    clicks = v.where("event_type = 'click'").select("event_id", "mid", "t")
    bought = v.where("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"), F.col("mid").alias("_mid"), F.col("t").alias("_pt"))
    return joins.interval_join(clicks, bought, {"mid": "_mid"}, 15 * 3600, 300, t_right="_pt").select("event_id", "purchase_id", "mid")


@query
def dim_enrich(spark, sf):
    o = feeds.table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 25).cast("string").alias("province_id"))
    return joins.enrich(o, feeds.dimensions(spark, sf)["province"], "province_id",
                        {"name": "province_name"}, default="")


@query
def dim_enrich_two_keys(spark, sf):
    li = feeds.table(spark, sf, "lineitem").select(
        feeds.line_id().alias("id"), F.col("l_partkey").cast("string").alias("sku_id"),
        (F.col("l_partkey") % 100).cast("string").alias("spu"))
    return joins.enrich(li, feeds.dimensions(spark, sf)["sku"], {"sku_id": "id", "spu": "spu_id"},
                        {"sku_name": "sku_name"})


@query
def dim_by_pairs(spark, sf):
    sku = feeds.dimensions(spark, sf)["sku"]
    return joins.by_key(sku, [("tm_id", "Brand#2"), ("category3_id", "11")])


@query
def snowflake_enrich(spark, sf):
    li = feeds.table(spark, sf, "lineitem").select(
        feeds.line_id().alias("id"), F.col("l_partkey").cast("string").alias("sku_id"))
    return joins.enrich_snowflake(li, feeds.dimensions(spark, sf))


# --- sinks, read back -------------------------------------------------------

@query
def topic_append_reread(spark, sf):
    """A detail topic: rows appended in two writes, read again as text with their event time."""
    rows = feeds.visits(spark, sf).select(
        "event_id", "mid", "page_id", "last_page_id", F.floor(F.col("ts") / 1000).cast("string").alias("ts"))
    path = shared_folder(spark, "topic")
    for half in (0, 1):
        sinks.append(rows.where(F.col("event_id") % 2 == half), path)
    again = topics.read_detail(topics.read_topic(spark, path), "event_id long, mid string, page_id string, last_page_id string, ts string")
    return _timed(again)


@query
def topic_per_row(spark, sf):
    """Each row goes to the topic it names; a reader of one topic opens its folder only."""
    rows = feeds.visits(spark, sf).select("event_id", "mid", F.concat(F.lit("dwd_"), "event_type").alias("topic"))
    path = shared_folder(spark, "topics")
    sinks.append(rows, path, by="topic")
    out = None
    for kind in ("view", "click", "purchase"):
        part = topics.read_json_table(topics.read_topic(spark, f"{path}/topic=dwd_{kind}"), "event_id long, mid string").withColumn(
            "topic", F.lit(f"dwd_{kind}"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def keyed_upsert(spark, sf):
    """Three micro-batches, one of them repeated, with deletions; the newest row of each key is left."""
    rows = feeds.visits(spark, sf).select(
        "mid", "event_id", "page_id", "t", (F.col("event_type") == "error").alias(sinks.DELETED))
    path = shared_folder(spark, "keyed")
    write = sinks.upsert(path, ["mid"], ["t", "event_id"])
    for number in (0, 1, 1, 2):
        write(rows.where(F.col("event_id") % 3 == number), number)
    return _timed(sinks.read_upserts(spark, path, ["mid"]))


@query
def dim_tombstones(spark, sf):
    """A keyed topic in which deletions are empty messages, read without them."""
    rows = feeds.visits(spark, sf).select("event_id", "page_id", (F.col("k") % 4 == 0).alias(sinks.DELETED))
    messages = parse.not_tombstone(sinks.kafka_rows(rows, "dim_visit", ["event_id"]))
    body = F.from_json("value", "event_id long, page_id string")
    return messages.select("topic", "key", body.alias("_b")).select("topic", "key", "_b.*")


@query
def log_maps(spark, sf):
    """The good records of the log as maps, with event time in whole seconds."""
    good, _ = parse.split_objects(feeds.log_text(spark, sf))
    return parse.parse_log_maps(good).select(
        "event_id", F.col("common")["mid"].alias("mid"), F.col("common")["ch"].alias("ch"), F.col("page")["page_id"].alias("page_id"),
        F.unix_micros("t").alias("us"))


@query
def rules_preloaded(spark, sf):
    """Rules of one sink type, from the table that they are kept in."""
    path = shared_folder(spark, "rules")
    feeds.rules(spark, sf).write.parquet(path)
    return dim_sources.read_rules(spark, "dwd", path).select("source_table", "source_type", "sink_table", "sink_columns")


@query
def dictionary_table(spark, sf):
    """Source type names by the dictionary table; the line's code has no name in it sometimes."""
    path = shared_folder(spark, "dic")
    feeds.dictionary(spark, sf).write.parquet(path)
    lines = detail.order_lines(feeds.cdc_frame(spark, sf)).select("id", "source_type")
    return joins.lookup(lines, dim_sources.read_dictionary(spark, path), "source_type", "source_type_name")


@query
def emit_and_processing_time(spark, sf):
    """Windows of changes: the time a row is written, and the latest processing time, lie within ten minutes of now."""
    changes = topics.read_cdc(feeds.routed_text(spark, sf))
    sums = windows.tumble(changes, {"n": F.count("*"), "_proc": F.max("proc_time")}, width="1 hour")
    near = lambda ms: F.abs(ms - F.unix_millis(F.current_timestamp())) < 600_000
    return windows.stamped(sums).select(
        "stt", "edt", "n", near(F.col("ts")).alias("stamped"), near(F.unix_millis("_proc")).alias("processed"))


@query
def flat_goods(spark, sf):
    """The flattened goods dimension after two micro-batches of routed rows: skus and categories, then what lies above them."""
    place = shared_folder(spark, "goods")
    goods = flat.FlatGoods(f"{place}/flat", f"{place}/dims", {level: f"dim_{level}" for level in flat.COLUMNS})
    dims, write = feeds.dimensions(spark, sf), flat.keep_flat(goods, ["ts"])
    for number, levels in enumerate((("sku", "category3"), ("spu", "trademark", "category2", "category1"))):
        batch = None
        for level in levels:
            pairs = [x for c in dims[level].columns for x in (F.lit(c), F.col(c))]
            rows = dims[level].select(F.lit(f"dim_{level}").alias("sink_table"), F.lit("id").alias("sink_pk"),
                                      F.lit("insert").alias("type"), F.create_map(*pairs).alias("data"), F.lit(0).alias("ts"))
            batch = rows if batch is None else batch.unionByName(rows)
        write(batch, number)
    return goods.read(spark)


@query
def summary_added_once(spark, sf):
    """Windows of three micro-batches, two of them repeated; a column that is not for the table is left out."""
    rows, path = feeds.visits(spark, sf), shared_folder(spark, "once")
    add = once.add_once(path, transient=["seen"])
    for number in (0, 0, 1, 2, 1):
        part = rows.where(F.col("event_id") % 3 == number)
        sums = windows.tumble(part, {"n": F.count("*"), "seen": F.max("event_id")}, ["page_id"], width="1 hour")
        add(sums.withColumn("part", F.lit(number)), number)
    return once.read_once(spark, path, "stt string, edt string, page_id string, n bigint, part int")


# --- jobs from topic to sink ------------------------------------------------

def _warehouse(spark, sf, width):
    w = warehouse.Warehouse(spark, shared_folder(spark, "warehouse"), width=width)
    sinks.land_text(feeds.shop_text(spark, sf), w.place("raw/topic_db"))
    feeds.dictionary(spark, sf).write.parquet(w.place("dim/base_dic"))
    for name, rows in feeds.dimensions(spark, sf).items():
        rows.write.parquet(w.place(f"dim/{name}"))
    return w


def _job(spark, sf, name, width=windows.WIDTH):
    w = _warehouse(spark, sf, width)
    warehouse.run_all(w, name)
    warehouse.run(w, name)                  # as after a failure: the batch is there already
    return w.rows(name)


@query
def job_cart_users(spark, sf):
    """Change text to the cart topic to windows of its users, each job reading what the one before wrote."""
    return _job(spark, sf, "cart_add_users")


@query
def job_refund_users(spark, sf):
    """Change text to the refund topic to windows of refunded orders with their goods."""
    return _job(spark, sf, "refund_users", "1 hour")


# --- detail tables ---------------------------------------------------------

def _wide(f, spark, sf, **kw):
    return _timed(f(feeds.cdc_frame(spark, sf), feeds.dictionary(spark, sf), **kw))


def _timed(df: DataFrame) -> DataFrame:
    return df.withColumn("t", clock.second_text("t"))


@query
def cart_add_detail(spark, sf):
    return _wide(detail.cart_add, spark, sf)


@query
def order_detail_wide(spark, sf):
    return _wide(detail.order_detail, spark, sf, whole=True)


@query
def order_detail_text(spark, sf):
    """From the text of the change topic: parsed once and landed by source table, then read by the joins."""
    landed = shared_folder(spark, "cdc")
    sinks.land_cdc(parse.valid_changes(topics.read_cdc(feeds.shop_text(spark, sf))), landed)
    return _timed(detail.order_detail(spark.read.parquet(landed), feeds.dictionary(spark, sf), whole=True))


@query
def order_detail_bounded(spark, sf):
    """As a stream joins: partners more than five seconds apart do not meet."""
    return _wide(detail.order_detail, spark, sf, ttl_s=detail.ORDER_TTL_S, whole=True)


@query
def order_cancel_wide(spark, sf):
    return _wide(detail.cancel_detail, spark, sf)


@query
def order_refund_wide(spark, sf):
    return _wide(detail.order_refund, spark, sf)


@query
def refund_pay_wide(spark, sf):
    return _wide(detail.refund_pay, spark, sf)


@query
def refund_pay_strict(spark, sf):
    """Only updates that set each status to its final code."""
    return _wide(detail.refund_pay, spark, sf, strict=True)


def _paid(spark, sf, strict=False):
    cdc, dic = feeds.cdc_frame(spark, sf), feeds.dictionary(spark, sf)
    return detail.pay_detail(detail.order_detail(cdc, dic, whole=True), cdc, dic, strict,
                             tie=["sku_id", "source_id", "split_payment_amount", "sku_num"])


@query
def pay_detail_strict(spark, sf):
    """Only updates to the successful status: no inserts and no failed payments."""
    return _timed(_paid(spark, sf, strict=True))


@query
def pay_detail_wide(spark, sf):
    return _timed(_paid(spark, sf))


@query
def order_detail_upsert(spark, sf):
    wide = feeds.line_versions(spark, sf).drop("t", "source_type_name")
    return routing.latest_per_key(wide, ["id"], ["ts", "seq"]).drop("seq")


# --- words -----------------------------------------------------------------

def _han(c):
    return F.translate(F.lower(c), feeds.LETTERS, feeds.HAN)


def _han_titles(spark, sf):
    return feeds.table(spark, sf, "part").select("p_partkey", _han(F.col("p_name")).alias("title"))


def _pieces(df, column, places, sizes):
    return df.select(F.explode(F.array(*[
        _han(F.substring(column, at, size)) for at in places for size in sizes])).alias("word"))


@query
def keyword_tokens_listed(spark, sf):
    """Titles in Han characters, a letter each, cut by a word list out of the nations' names, the longest word first."""
    names = _pieces(feeds.table(spark, sf, "nation"), "n_name", (1, 2, 3), (2, 3))
    return words.words_of(_han_titles(spark, sf), "title", dictionary=names, mode="longest").select("p_partkey", "word")


@query
def keyword_tokens_smart(spark, sf):
    """The same titles, cut to cover most characters by fewest words; the list has words that overlap, out of brands' and nations' names."""
    parts = _pieces(feeds.table(spark, sf, "part").where("p_partkey % 5 = 1").select(
        F.regexp_replace("p_name", "[^A-Za-z]", "").alias("name")), "name", (1, 2, 4, 7), (2, 3, 5))
    listed = parts.unionAll(_pieces(feeds.table(spark, sf, "nation"), "n_name", (1, 2, 3), (2, 3, 4))).distinct()
    return words.words_of(_han_titles(spark, sf), "title", dictionary=listed).select("p_partkey", "word")


@query
def keyword_tokens(spark, sf):
    docs = feeds.table(spark, sf, "documents").select("lang", "text")
    return words.words_of(docs, "text").groupBy("lang", "word").agg(F.count("*").alias("n"))


@query
def keyword_tokens_name(spark, sf):
    return words.words_of(feeds.table(spark, sf, "part").select("p_partkey", "p_name"), "p_name").select(
        "p_partkey", "word")


@query
def keyword_table_function(spark, sf):
    """The table function in SQL, as a lateral join."""
    words.register_words(spark)
    feeds.table(spark, sf, "part").createOrReplaceTempView("rillmart_part")
    return spark.sql(
        "select p_partkey, w.word, count(*) as n from rillmart_part, lateral split_words(p_name) as w "
        "group by p_partkey, w.word")


@query
def keyword_window(spark, sf):
    return summary.keyword_page_view(feeds.log_frame(spark, sf))


# --- keyed measures and windows --------------------------------------------

@query
def first_of_day(spark, sf):
    v = feeds.visits(spark, sf).select("mid", "event_id", "event_type", "t")
    return keyed.first_of_day(v, ["mid"], ["t", "event_id"]).drop("t")


@query
def cart_uu_window(spark, sf):
    carts = detail.cart_add(feeds.cdc_frame(spark, sf), feeds.dictionary(spark, sf))
    return summary.cart_add_users(carts)


@query
def order_user_window(spark, sf):
    wide = detail.order_detail(feeds.cdc_frame(spark, sf), feeds.dictionary(spark, sf))
    return summary.order_users(wide)


@query
def purchase_user_window(spark, sf):
    return summary.payment_users(feeds.purchases(spark, sf), width="1 hour")


@query
def payment_user_window(spark, sf):
    return summary.payment_users(_paid(spark, sf))


@query
def page_uv_window(spark, sf):
    return summary.page_view(feeds.log_frame(spark, sf))


@query
def login_back_window(spark, sf):
    return summary.user_login(feeds.log_frame(spark, sf))


@query
def register_window(spark, sf):
    return summary.user_register(feeds.visits(spark, sf).where("event_type = 'signup'"))


@query
def channel_pv_window(spark, sf):
    return summary.channel_page_view(feeds.log_frame(spark, sf))


@query
def channel_pv_hour(spark, sf):
    return summary.channel_page_view(feeds.log_frame(spark, sf), width="1 hour")


@query
def retract_changelog(spark, sf):
    v = feeds.line_versions(spark, sf).select(
        "id", "sku_id", values.amount("split_total_amount").alias("order_amount"),
        values.amount("split_coupon_amount").alias("coupon_amount"), "t", "seq")
    log = keyed.retract_changelog(v, "id", ["t", "seq"], ["order_amount", "coupon_amount"])
    return plain_amounts(log.withColumn("event_time", clock.second_text("t")).drop("t"))


@query
def order_count_once(spark, sf):
    v = feeds.line_versions(spark, sf).select("order_id", "id", "t", "seq")
    return keyed.mark_once(v, "order_id", ["t", "seq", "id"]).select("order_id", "id", "seq", "once")


@query
def sku_order_window(spark, sf):
    return plain_amounts(summary.sku_orders(feeds.line_versions(spark, sf), feeds.dimensions(spark, sf)))


@query
def province_order_window(spark, sf):
    return plain_amounts(summary.province_orders(
        feeds.line_versions(spark, sf), feeds.dimensions(spark, sf)["province"], ["t", "seq", "id"]))


@query
def refund_distinct_window(spark, sf):
    refunds = detail.order_refund(feeds.cdc_frame(spark, sf), feeds.dictionary(spark, sf))
    return summary.refund_users(refunds, feeds.dimensions(spark, sf), width="1 hour")


def _disordered(spark, sf):
    return feeds.visits(spark, sf).select(
        F.col("event_id").alias("arrival"), (F.col("t") - F.make_dt_interval(mins=F.col("k"))).alias("t"))


@query
def watermark_late_drop(spark, sf):
    return windows.mark_late(_disordered(spark, sf)).where("late").select(
        "arrival", clock.second_text("t").alias("event_time"))


@query
def watermark_lateness(spark, sf):
    kept = windows.mark_late(_disordered(spark, sf), delay_s=5, lateness_s=1800).where("not late")
    return windows.tumble(kept, {"n": F.count("*")}, width="1 hour")


# --- one key with a third of all rows -----------------------------------------

CROWD = dict(hot_rows=300)


@query
def visitor_flag_crowded(spark, sf):
    v = feeds.crowded(feeds.visits(spark, sf).select("event_id", "mid", "is_new", "t"), "mid")
    return keyed.repair_visitor_flag(v, order=["t", "event_id"], **CROWD).select("event_id", "mid", "is_new")


@query
def count_once_crowded(spark, sf):
    v = feeds.crowded(feeds.visits(spark, sf).select("event_id", "mid", "t"), "mid")
    return keyed.mark_once(v, "mid", ["t", "event_id"], **CROWD).select("event_id", "mid", "once")


@query
def retract_crowded(spark, sf):
    v = feeds.crowded(feeds.visits(spark, sf).select(
        F.col("mid").alias("id"), feeds.money("value").alias("amount"), "page_id", "t", "event_id"), "id")
    log = keyed.retract_changelog(v, "id", ["t", "event_id"], ["amount"], **CROWD)
    return plain_amounts(log.withColumn("event_time", clock.second_text("t")).drop("t"))


@query
def interval_join_crowded(spark, sf):
    v = feeds.crowded(feeds.visits(spark, sf).select("event_id", "event_type", "mid", "t"), "mid")
    clicks = v.where("event_type = 'click'").select("event_id", "mid", "t")
    bought = v.where("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"), F.col("mid").alias("_mid"), F.col("t").alias("_pt"))
    return joins.interval_join(clicks, bought, {"mid": "_mid"}, 3600, 300, t_right="_pt").select(
        "event_id", "purchase_id", "mid")


@query
def order_users_crowded(spark, sf):
    return summary.payment_users(feeds.crowded(feeds.purchases(spark, sf), "user_id"), width="1 hour")


# --- scalars ---------------------------------------------------------------

@query
def scalar_dates(spark, sf):
    v = feeds.visits(spark, sf)
    sec = clock.second_text("t")
    return v.select(
        "event_id", clock.to_epoch_ms(sec, full=True).alias("full_ms"),
        clock.to_epoch_ms(clock.day_text("t")).alias("day_ms"), clock.day_text_ms("ts").alias("day"),
        clock.second_text_ms("ts").alias("second"), clock.day_of_text(sec).alias("day_of_text"),
        F.date_format(clock.yesterday("t"), clock.DAY).alias("yesterday"),
        clock.second_text(clock.from_epoch_s((F.col("ts") / 1000).cast("bigint").cast("string"))).alias("from_s"),
        clock.second_text(clock.from_epoch_ms_whole_s("ts")).alias("whole_s"),
        clock.second_text(F.expr("t - interval 15 minutes")).alias("minus_15m"),
        clock.days_between("t", F.lit("2023-12-25").cast("date")).cast("bigint").alias("days"))


@query
def scalar_json(spark, sf):
    e = feeds.table(spark, sf, "events")
    rec = F.struct(F.col("event_type").alias("a"), F.col("user_id").alias("b"))
    return e.select(
        "event_id", payload.get_long("props", "$.k").alias("k"),
        payload.get_text("props", "$.none").alias("missing"),
        payload.text_of(payload.remove(rec, "b")).alias("removed"),
        payload.text_of(payload.put(rec, "c", F.lit("x"))).alias("added"),
        payload.put_entry(feeds.entries(a=F.col("event_type")), "a", F.lit("y"))["a"].alias("replaced"))


@query
def scalar_strings(spark, sf):
    p = feeds.table(spark, sf, "part")
    data = feeds.entries(id=F.col("p_partkey"), user_id=F.col("p_size"), x=F.lit("1"))
    kept = values.listed_only(data, F.lit("user_id,x"))
    return p.select(
        "p_partkey", F.upper("p_name").alias("upper_name"), F.lower("p_type").alias("lower_type"),
        F.concat_ws("-", "p_name", "p_brand").alias("joined"),
        F.array_join(F.array_sort(F.map_keys(kept)), ",").alias("kept_keys"),
        values.upper_keys(data)["ID"].alias("upper_key"),
        F.size(values.names_of(F.col("p_name"))).cast("bigint").alias("parts"),
        values.set_size(F.split("p_name", " ")).cast("bigint").alias("distinct_words"),
        F.col("p_name").contains("red").alias("has_red"))


@query
def scalar_amounts(spark, sf):
    li = feeds.table(spark, sf, "lineitem")
    bad = F.when(F.col("l_linenumber") == 3, F.lit("n/a")).otherwise(
        feeds.money("l_extendedprice").cast("string"))
    amount = values.amount_or_zero(bad)
    return li.select(
        "l_orderkey", "l_linenumber", amount.cast("string").alias("amount"),
        (-amount).cast("decimal(16,2)").cast("string").alias("negated"),
        (amount + feeds.money("l_tax")).cast("decimal(17,2)").cast("string").alias("added"),
        F.when(F.col("l_quantity") > 25, "big").otherwise("small").alias("size"),
        F.coalesce(values.whole(F.when(F.col("l_linenumber") != 3, F.col("l_quantity").cast("int").cast("string"))
                                .otherwise("n/a")), F.lit(-1)).cast("bigint").alias("whole"))


@query
def version_time_latest(spark, sf):
    """Last version per key by UTC texts whose fractions have different lengths."""
    v = feeds.visits(spark, sf)
    text = F.concat(clock.second_text("t").substr(1, 10), F.lit("T"), clock.second_text("t").substr(12, 8),
                    F.when(F.col("k") % 2 == 0, F.concat(F.lit("."), F.col("k"), F.lit("Z"))).otherwise("Z"))
    return v.select("mid", "event_id", values.version_time(text).alias("vt")).groupBy("mid").agg(
        F.max_by("event_id", F.struct("vt", "event_id")).alias("event_id"))
