"""Jobs wired from topic to sink, the sink that adds a batch once, and counts of rows let go."""

import pytest
from pyspark.sql import functions as F

from rillmart.checks import feeds
from rillmart.operators import parse, windows
from rillmart.operators.counts import LATE, Totals, counted
from rillmart.plans import detail, summary, warehouse
from rillmart.sources import once, sinks, topics

SCHEMA = "stt string, n bigint"


def some(spark, rows, parts=2):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "s")
    add = once.add_once(path, transient=["note"])
    first = some(spark, [("a", 1), ("b", 2), ("b", 2)]).withColumn("note", F.lit("x"))
    add(first, 0)
    add(first, 0)
    add(some(spark, [("other", 9)]).withColumn("note", F.lit("x")), 0)      # published already: nothing is added
    add(some(spark, []).withColumn("note", F.lit("x")), 1)
    add(some(spark, [("a", 7)]).withColumn("note", F.lit("x")), 2)
    got = once.read_once(spark, path, SCHEMA)
    assert got.columns == ["stt", "n"]
    assert sorted(map(tuple, got.collect())) == [("a", 1), ("a", 7), ("b", 2), ("b", 2)]
    assert sorted(map(tuple, once.read_once(spark, path, SCHEMA, ["stt"]).collect())) == [("a", 7), ("b", 2)]


def test_a_batch_that_fails_half_way_is_not_read(spark, tmp_path):
    path = str(tmp_path / "s")
    add = once.add_once(path)
    add(some(spark, [("a", 1)]), 0)
    bad = spark.range(0, 8, 1, 4).select(F.col("id").cast("string").alias("stt"),
                                         F.when(F.col("id") == 7, F.raise_error("lost")).otherwise(F.col("id")).cast("bigint").alias("n"))
    with pytest.raises(Exception, match="lost"):
        add(bad, 1)
    left = tmp_path / "s" / "data" / "run=0" / "batch=1"
    left.mkdir(parents=True, exist_ok=True)
    some(spark, [("lost task", 5)]).coalesce(1).write.mode("append").parquet(str(left))     # as a killed executor leaves it
    assert [tuple(r) for r in once.read_once(spark, path, SCHEMA).collect()] == [("a", 1)]
    add(spark.range(0, 8, 1, 4).select(F.col("id").cast("string").alias("stt"), F.col("id").alias("n")), 1)
    assert once.read_once(spark, path, SCHEMA).count() == 9


def test_columns_are_bound_by_position(spark, tmp_path):
    once.add_once(str(tmp_path / "s"), columns=["stt", "n"])(spark.createDataFrame([("a", 1)], "x string, y bigint"), 0)
    assert [r.asDict() for r in once.read_once(spark, str(tmp_path / "s"), SCHEMA).collect()] == [{"stt": "a", "n": 1}]


def landed(spark, sf, root, width="1 hour"):
    w = warehouse.Warehouse(spark, str(root), width=width)
    feeds.log_text(spark, sf).select("value").write.parquet(w.place("raw/topic_log"))
    feeds.shop_text(spark, sf).unionAll(feeds.routed_text(spark, sf).select("value")).write.parquet(w.place("raw/topic_db"))
    register = spark.createDataFrame([("t1", "insert", "dwd_user_register", "dwd", "id,user_id", None, None)],
                                     feeds.rules(spark, sf).schema)
    feeds.rules(spark, sf).where("source_table <> 't1'").unionAll(register).write.parquet(w.place("raw/rules"))
    spark.createDataFrame([], "value string, pos bigint").write.parquet(w.place("raw/rule_changes"))
    feeds.dictionary(spark, sf).write.parquet(w.place("dim/base_dic"))
    for name, rows in feeds.dimensions(spark, sf).items():
        rows.write.parquet(w.place(f"dim/{name}"))
    return w


def same(got, want):
    want = want.select(*got.columns)
    return got.exceptAll(want).count() == 0 == want.exceptAll(got).count() and got.count() > 0


def test_all_jobs_from_topic_to_sink(spark, sf, tmp_path):
    w = landed(spark, sf, tmp_path)
    warehouse.run_all(w)
    for name in ("order_detail", "cart_add", "page_view", "log"):
        warehouse.run(w, name)                                             # the same batch again
    cdc, dic, dims = feeds.cdc_frame(spark, sf), feeds.dictionary(spark, sf), feeds.dimensions(spark, sf)
    good, dirty = parse.split_log(feeds.log_text(spark, sf).select("value"))
    good = good.where("start is null")                 # what the log job sends to the page topic
    wide = warehouse.last_versions(detail.order_detail(cdc, dic), ["id"])
    paid = detail.pay_detail(wide, cdc, dic, tie=["sku_id", "source_id", "split_payment_amount", "sku_num"])
    refunds = detail.order_refund(cdc, dic)
    assert same(w.messages("log", "dirty_data").select("value"), dirty)
    tables = {"order_detail": wide, "cancel_detail": warehouse.last_versions(detail.cancel_detail(cdc, dic), ["id"]), "pay_detail": paid,
              "order_refund": refunds, "cart_add": detail.cart_add(cdc, dic), "refund_pay": detail.refund_pay(cdc, dic)}
    for name, rows in tables.items():
        assert same(w.rows(name), rows), name
    want = {
        "keyword_page_view": summary.keyword_page_view(good, width=w.width), "page_view": summary.page_view(good, w.width),
        "user_login": summary.user_login(good, w.width),
        "cart_add_users": summary.cart_add_users(detail.cart_add(cdc, dic), w.width),
        "order_users": summary.order_users(wide, w.width), "payment_users": summary.payment_users(paid, w.width),
        "province_orders": summary.province_orders(wide, dims["province"], ["t", "ts"], w.width),
        "sku_orders": summary.sku_orders(wide, dims, ["t", "ts"], w.width),
        "refund_users": summary.refund_users(refunds, dims, w.width)}
    for name, rows in want.items():
        assert same(w.rows(name), rows), name
    channel = w.rows("channel_page_view").agg(F.sum("pv_ct")).first()[0]
    assert channel == good.count()                     # flags differ: the log job has repaired them
    registered = w.rows("user_register").agg(F.sum("register_ct")).first()[0]
    assert registered == w.messages("routed_facts", "dwd_user_register").count() > 0


def test_every_job_comes_after_what_it_reads():
    seen = set()
    for name, job in warehouse.JOBS.items():
        assert all(r in seen or r.startswith("raw/") for r in job.reads)
        seen.add(name)
    assert warehouse.needed("payment_users") == ["order_detail", "pay_detail", "payment_users"]


def test_counts_of_dirty_and_late_rows(spark, sf, tmp_path):
    from pyspark.sql import Observation
    seen = Observation("late")
    e = feeds.visits(spark, sf).select(F.col("event_id").alias("arrival"), (F.col("t") - F.make_dt_interval(mins=F.col("k"))).alias("t"))
    marked = windows.mark_late(e)
    kept = counted(marked, seen, late=F.col("late")).where("not late").count()
    assert (seen.get["rows"], seen.get["late"]) == (marked.count(), marked.where("late").count()) and kept < seen.get["rows"]

    listener, text = Totals(), feeds.log_text(spark, sf).select("value")
    spark.streams.addListener(listener)
    try:
        for cut in (0, 1):
            text.where(F.crc32("value") % 2 == cut).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        log = counted(parse.mark_log(topics.read_topic(spark, str(tmp_path / "in"), fmt="parquet", stream=True, files_per_trigger=1)),
                      "log", dirty=~F.col("ok"))
        hours = windows.tumble(windows.watermarked(log.where("ok").select("t")), {"n": F.count("*")}, width="1 hour")
        q = (hours.writeStream.queryName("hours").outputMode("append").format("noop").option("checkpointLocation", str(tmp_path / "c"))
             .trigger(availableNow=True).start())
        assert q.awaitTermination(120)
        dirty, all_rows = parse.split_log(text)[1].count(), text.count()
        late = sum(o.numRowsDroppedByWatermark for p in q.recentProgress for o in p.stateOperators)
        for _ in range(100):
            got = listener.totals["hours"]
            if got["log", "rows"] == all_rows:
                break
            __import__("time").sleep(0.1)
        assert (got["log", "rows"], got["log", "dirty"]) == (all_rows, dirty) and dirty > 0
        assert sum(n for (_, what), n in got.items() if what == LATE) == late
    finally:
        spark.streams.removeListener(listener)


def test_a_repeated_batch_runs_no_stage_before_its_sink(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(n):
        seen.add(1)
        return n

    rows = spark.range(20).select(counted("id").alias("n")).groupBy((F.col("n") % 3).alias("k")).agg(F.sum("n").alias("n"))
    add = once.add_once(str(tmp_path / "s"))
    add(rows, 0)
    first = seen.value
    add(rows, 0)
    assert first >= 20 and seen.value == first
    assert once.read_once(spark, str(tmp_path / "s"), "k bigint, n bigint").count() == 3


def test_changes_of_some_tables_parse_only_text_that_may_be_theirs(spark, tmp_path):
    """Escapes, other quotes and spaces hide no change; a table's name elsewhere in the text brings none."""
    lines = ['{"table":"cart_info","type":"insert","data":{"id":"1"},"ts":"1"}',
             '{ "table" : "cart_info" , "type":"update","data":{"id":"2","note":"order_info"},"ts":"1"}',
             '{"table":"cart\\u005finfo","type":"insert","data":{"id":"3"},"ts":"1"}',
             "{'table':'cart_info','type':'insert','data':{'id':'4'},'ts':'1'}",
             '{"table":"order_info","type":"insert","data":{"id":"5","note":"cart_info"},"ts":"1"}',
             '{"table":"user_info","type":"insert","data":{"id":"6"},"ts":"1"}', "cart_info", None]
    w = warehouse.Warehouse(spark, str(tmp_path))
    spark.createDataFrame([(x,) for x in lines], "value string").write.parquet(w.place("raw/topic_db"))
    ids = lambda df: sorted((r["table"], r.id) for r in df.select("table", F.col("data")["id"].alias("id")).collect())
    assert ids(w.changes("cart_info", "order_info")) == [x for x in ids(w.changes()) if x[0] != "user_info"]
    assert len(ids(w.changes("cart_info"))) == 4
    of_one = parse.changes_of(w.changes("cart_info", "order_info"), "cart_info")
    assert of_one._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_landed_text_and_topics_are_packed(spark, sf, tmp_path):
    """Text of changes and a topic of rows take a fraction of their size on disk, and are read back whole."""
    w = warehouse.Warehouse(spark, str(tmp_path))
    text = feeds.shop_text(spark, sf).unionAll(spark.createDataFrame([("",), (None,), ("no change",)], "value string"))
    sinks.land_text(text, w.place("raw/topic_db"))
    feeds.dictionary(spark, sf).write.parquet(w.place("dim/base_dic"))
    assert same(w.change_text(), text)
    warehouse.run(w, "cart_add")
    assert same(w.rows("cart_add"), detail.cart_add(feeds.cdc_frame(spark, sf), feeds.dictionary(spark, sf)))
    size = lambda name, kind: sum(f.stat().st_size for f in (tmp_path / name).rglob(f"part-*{kind}"))
    plain = text.agg(F.sum(F.octet_length("value"))).first()[0]
    assert 0 < size("raw/topic_db", ".zstd.parquet") < 0.2 * plain
    rows = w.rows("cart_add").select(F.to_json(F.struct(*detail.CART_COLUMNS)).alias("value"))
    assert 0 < size("cart_add", ".json.gz") < 0.25 * rows.agg(F.sum(F.octet_length("value"))).first()[0]
