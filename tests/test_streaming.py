"""Stream forms give what the batch forms give on the same rows."""

import pandas as pd
from pyspark.sql import Row
from pyspark.sql import functions as F

from rillmart.checks import feeds
from rillmart.operators import parse, routing
from rillmart.plans import detail, summary
from rillmart.streaming import jobs
from rillmart.streaming.processors import _place, thin
from streams import as_stream, rows, run_keyed

WINDOW = ["stt", "edt"]



def log(spark, sf):
    return feeds.log_frame(spark, sf).select("common", "page", "ts", "t")


def same(stream_df, batch_df, tmp, keys, mode="update"):
    got, query = run_keyed(stream_df, tmp, keys, mode)
    want = rows(batch_df)
    assert want and rows(got, batch_df.columns) == want
    return query


def test_order_puts_nulls_first():
    made = [Row(ts=1, vc="a"), Row(ts=1, vc=None), Row(ts=0, vc=None), Row(ts=1, vc=None)]
    assert [(r.ts, r.vc) for r in sorted(made, key=_place(["ts", "vc"]))] == [(0, None), (1, None), (1, None), (1, "a")]
    batch = pd.DataFrame({"k": ["u"] * 3, "_day": [1, 1, 2], "ts": [5, 5, 6], "vc": ["a", None, "b"]})
    kept = next(thin(["k"], ["ts", "vc"])([batch]))
    assert kept["_day"].tolist() == [1, 2] and kept["vc"].isna().tolist() == [True, False]


def test_page_view(spark, sf, tmp_path):
    src = log(spark, sf)
    live = jobs.page_view(as_stream(src, tmp_path / "in", "ts"), mode="update")
    same(live, summary.page_view(src), tmp_path, WINDOW)


def test_user_login(spark, sf, tmp_path):
    src = log(spark, sf)
    live = jobs.user_login(as_stream(src, tmp_path / "in", "ts"), mode="update")
    same(live, summary.user_login(src), tmp_path, WINDOW)


def test_channel_page_view_with_late_rows(spark, sf, tmp_path):
    src = log(spark, sf)
    live = jobs.channel_page_view(as_stream(src, tmp_path / "in", "ts"), width="1 hour")
    same(live, summary.channel_page_view(src, width="1 hour"), tmp_path, [*WINDOW, *summary.CHANNEL])


def test_keyword_and_register(spark, sf, tmp_path):
    src = log(spark, sf)
    live = jobs.keyword_page_view(as_stream(src, tmp_path / "in", "ts"))
    same(live, summary.keyword_page_view(src), tmp_path, [*WINDOW, "keyword"])
    src = feeds.visits(spark, sf).where("event_type = 'signup'").select("ts", "t")
    live = jobs.user_register(as_stream(src, tmp_path / "in2", "ts"))
    same(live, summary.user_register(src), tmp_path / "2", WINDOW)


def test_order_users_update_and_append(spark, sf, tmp_path):
    src = feeds.purchases(spark, sf).withColumn("source_type_name", F.lit("x"))
    batch = summary.order_users(src)
    live = jobs.order_users(as_stream(src, tmp_path / "in", "event_id", 4), mode="update")
    same(live, batch, tmp_path, WINDOW)
    live = jobs.order_users(as_stream(src, tmp_path / "in2", "event_id", 4), mode="append")
    got, _ = run_keyed(live, tmp_path / "2", WINDOW, "append")
    last = batch.agg(F.max("stt")).first()[0]
    assert rows(got, batch.columns) == rows(batch.where(F.col("stt") < last))  # last window still open


def test_cart_and_payment_users(spark, sf, tmp_path):
    src = feeds.purchases(spark, sf)
    live = jobs.cart_add_users(as_stream(src, tmp_path / "in", "event_id"), mode="update")
    same(live, summary.cart_add_users(src), tmp_path, WINDOW)
    live = jobs.payment_users(as_stream(src, tmp_path / "in2", "event_id"), mode="update")
    same(live, summary.payment_users(src), tmp_path / "2", WINDOW)




def test_sku_orders_retract(spark, sf, tmp_path):
    src, dims = feeds.line_versions(spark, sf), feeds.dimensions(spark, sf)
    live = jobs.sku_orders(as_stream(src, tmp_path / "in", "ts"), dims, delay_s=3600, width="1 hour")
    same(live, summary.sku_orders(src, dims, width="1 hour"), tmp_path, [*WINDOW, "sku_id"])


def test_province_orders_retract(spark, sf, tmp_path):
    src, dims = feeds.line_versions(spark, sf), feeds.dimensions(spark, sf)
    live = jobs.province_orders(as_stream(src, tmp_path / "in", "ts"), dims["province"], delay_s=3600,
                                width="1 hour")
    want = summary.province_orders(src, dims["province"], ["t", "seq", "id"], width="1 hour")
    same(live, want, tmp_path, [*WINDOW, "province_id"])


def test_late_retraction_is_dropped(spark, tmp_path):
    """Without a delay the old version's window is closed and keeps its amount."""
    schema = "id string, sku_id string, user_id string, source_type_name string, split_original_amount string, " \
             "split_activity_amount string, split_coupon_amount string, split_total_amount string, seq long, ts long"
    data = [("1", "s", "u", "x", None, None, None, "10.00", 1, 100), ("2", "s", "u", "x", None, None, None, "1.00", 2, 500),
            ("3", "s", "u", "x", None, None, None, "1.00", 3, 700), ("1", "s", "u", "x", None, None, None, "12.50", 4, 900)]
    src = spark.createDataFrame(data, schema).withColumn("t", F.timestamp_seconds("ts"))
    live = jobs._changelog(as_stream(src, tmp_path / "in", "ts", 4), ["sku_id"],
                           {"split_total_amount": "order_amount"}, ["seq"], "update")
    from rillmart.operators.windows import total, tumble, watermarked
    out = tumble(watermarked(live), total("order_amount"), ["sku_id"])
    got, q = run_keyed(out, tmp_path, [*WINDOW, "sku_id"])
    amounts = {r["stt"][-5:]: str(r["order_amount"]) for r in got.collect()}
    assert amounts["01:40"] == "10.00" and amounts["15:00"] == "12.50"
    dropped = sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"])
    assert dropped == 1


class Store:
    """What a processor asks of its state, held in dicts."""

    def __init__(self):
        self.values, self.maps, self.timers, self.read = {}, {}, set(), 0

    def getValueState(self, name, schema, ttl=None):
        store = self

        class Value:
            exists = staticmethod(lambda: name in store.values)
            get = staticmethod(lambda: store.values[name])
            update = staticmethod(lambda v: store.values.__setitem__(name, tuple(v)))
            clear = staticmethod(lambda: store.values.pop(name, None))
        return Value

    def getMapState(self, name, key, value, ttl=None):
        store = self
        held = store.maps.setdefault(name, {})

        def fetch(k):
            store.read += 1
            return held[k]

        class Map:
            containsKey = staticmethod(lambda k: k in held)
            getValue = staticmethod(fetch)
            updateValue = staticmethod(lambda k, v: held.__setitem__(k, tuple(v)))
            clear = staticmethod(held.clear)
        return Map

    def registerTimer(self, ms):
        self.timers.add(ms)


def test_days_are_kept_as_bits_of_words():
    """Days in any order, before 1970 too, over many calls: as a set of all days would tell, with a 64th of its entries."""
    import random

    from rillmart.streaming.processors import NO_GAP, DayFirsts
    made = random.Random(5)
    days = [made.randint(-300, 700) for _ in range(1500)]
    machine, store, known, entry = DayFirsts(["_day", "n"], ["n"], gaps=True), Store(), set(), Row("_day", "n")
    machine.init(store)
    at = 0
    while at < len(days):
        size = made.randint(1, 30)
        part = [(d, at + i) for i, d in enumerate(days[at: at + size])]
        want = []
        for d, n in part:
            if d not in known:
                want.append((d, n, int(not known), min((d - k for k in known if k < d), default=NO_GAP)))
                known.add(d)
        given = [entry(*p) for p in part]
        made.shuffle(given)
        assert [tuple(r) for r in machine.handleInputRows(None, iter(given), None)] == want
        at += size
    held = store.maps["words"]
    assert len(known) > 500 and len(held) == len({d // 64 for d in known}) <= 17
    assert {w * 64 + b for (w,), (bits,) in held.items() for b in range(64) if bits >> b & 1} == known
    store.read = 0
    assert list(machine.handleInputRows(None, iter([entry(days[0], 9999)]), None)) == [] and store.read == 1


def test_user_login_over_several_words(spark, tmp_path):
    """Logins up to two years apart, micro-batches not in order of days, against the batch."""
    day = 86_400
    logins = [(f"u{i % 7}", (i * 37 % 701) * day + i) for i in range(300)]
    src = spark.createDataFrame(logins, "uid string, s long").select(
        F.struct("uid").alias("common"), F.struct(F.lit(None).cast("string").alias("last_page_id")).alias("page"),
        "s", F.timestamp_seconds("s").alias("t"))
    live = jobs.user_login(as_stream(src, tmp_path / "in", "s", 4), mode="update")
    same(live, summary.user_login(src), tmp_path, WINDOW)


def far_row(src, path, **values):
    """One more file with a single row a year later, so that the watermark passes all others."""
    row = src.limit(1).withColumn("t", F.timestamp_seconds(F.lit(4_000_000_000)))
    for c, v in values.items():
        row = row.withColumn(c, F.lit(v).cast(src.schema[c].dataType))
    row.coalesce(1).write.mode("append").parquet(str(path))


def test_state_ends_behind_the_watermark(spark, sf, tmp_path):
    """Retractions and orders counted once: results as before, and only the last row's state is left."""
    src, dims = feeds.line_versions(spark, sf), feeds.dimensions(spark, sf)
    want = {"sku": summary.sku_orders(src, dims, width="1 hour"),
            "province": summary.province_orders(src, dims["province"], ["t", "seq", "id"], width="1 hour")}
    for name, keys in (("sku", [*WINDOW, "sku_id"]), ("province", [*WINDOW, "province_id"])):
        left = {}
        for keep in (3600, None):
            live = as_stream(src, tmp_path / f"{name}{keep}", "ts")
            far_row(src, tmp_path / f"{name}{keep}", id="far", order_id="far", ts=4_000_000_000)
            far_row(src, tmp_path / f"{name}{keep}", id="far", order_id="far", ts=4_000_000_001)
            out = (jobs.sku_orders(live, dims, delay_s=3600, width="1 hour", keep_s=keep) if name == "sku" else
                   jobs.province_orders(live, dims["province"], delay_s=3600, width="1 hour", keep_s=keep))
            got, q = run_keyed(out, tmp_path / f"{name}{keep}out", keys)
            assert rows(got.where("stt < '2050'"), want[name].columns) == rows(want[name])
            left[keep] = [s["numRowsTotal"] for s in q.recentProgress[-1]["stateOperators"] if s["operatorName"].startswith("transformWithState")]
        assert left[3600] and max(left[3600]) < 10 < min(left[None])


def test_visitor_state_ends_a_day_after(spark, sf, tmp_path):
    src, left = log(spark, sf), {}
    for keep in (86_400 * 2, None):
        live = as_stream(src, tmp_path / f"in{keep}", "ts")
        far_row(src, tmp_path / f"in{keep}", ts=4_000_000_000_000)
        far_row(src, tmp_path / f"in{keep}", ts=4_000_000_000_001)
        out = jobs.channel_page_view(live, width="1 hour", keep_s=keep)
        got, q = run_keyed(out, tmp_path / f"out{keep}", [*WINDOW, *summary.CHANNEL])
        want = summary.channel_page_view(src, width="1 hour")
        assert rows(got.where("stt < '2050'"), want.columns) == rows(want)
        left[keep] = [s["numRowsTotal"] for s in q.recentProgress[-1]["stateOperators"] if s["operatorName"].startswith("transformWithState")]
    assert left[86_400 * 2] and max(left[86_400 * 2]) < 10 < min(left[None]), left


def test_distinct_refunds_forget_orders(spark, tmp_path):
    """Repeats within a window count once, also in later micro-batches; a null order counts nothing; closed windows hold no orders."""
    made = [(i % 5 and f"o{i % 13}", f"u{i % 2}", "1", i) for i in range(200)] + [("end", "u", "1", 10_000), ("end", "u", "1", 10_001)]
    src = spark.createDataFrame([(o or None, u, s, n) for o, u, s, n in made], "order_id string, user_id string, sku_id string, s long").withColumn(
        "t", F.timestamp_seconds("s"))
    dims = feeds.dimensions(spark, "/root/testdata/sf0.001")
    got, q = run_keyed(jobs.refund_users(as_stream(src, tmp_path / "in", "s", 5), dims, width="40 seconds"), tmp_path,
                       [*WINDOW, "trademark_id", "category3_id", "user_id"])
    want = summary.refund_users(src, dims, width="40 seconds")
    assert rows(got, want.columns) == rows(want)
    held = {s["operatorName"]: s["numRowsTotal"] for s in q.recentProgress[-1]["stateOperators"]}
    assert held["dedupe"] <= 1 and len(held) == 2


def test_order_detail_stream(spark, sf, tmp_path):
    """Inner and left joins with bounds: all rows whose partners can no longer come."""
    cdc = feeds.cdc_frame(spark, sf).withColumn("s", F.col("ts").cast("long"))
    cdc = cdc.where(F.col("table").startswith("order_"))
    far = cdc.limit(1).select(
        F.lit("shop").alias("database"), F.explode(F.array(*map(F.lit, ["order_detail", "order_info",
            "order_detail_activity", "order_detail_coupon"]))).alias("table"), F.lit("insert").alias("type"),
        feeds.entries(id=F.lit("end"), order_id=F.lit("end"), order_detail_id=F.lit("end"),
                      source_type=F.lit("2401")).alias("data"),
        F.lit(None).cast("map<string,string>").alias("old"), F.lit("4000000000").alias("ts"),
        F.timestamp_seconds(F.lit(4000000000)).alias("t"), F.lit(4000000000).cast("long").alias("s"))
    dic = feeds.dictionary(spark, sf)
    live = as_stream(cdc, tmp_path / "in", "s")
    far.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    live = detail.order_detail(live.withWatermark("t", "10 seconds"), dic, detail.ORDER_TTL_S)
    got = []

    def keep(batch, _):
        got.extend(batch.drop("t").collect())

    q = live.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None
    want = rows(detail.order_detail(cdc, dic, detail.ORDER_TTL_S).drop("t"))
    have = sorted(tuple(str(r[c]) for c in sorted(detail.ORDER_COLUMNS)) for r in got if r["id"] != "end")
    assert want and have == want


def run_log(spark, src, tmp, order, by="event_id", files=3, **how):
    from rillmart.sources.sinks import start_batches
    from rillmart.streaming.visitors import log_batches
    write = log_batches(str(tmp / "days"), str(tmp / "out"), order, **how)
    q = start_batches(as_stream(src, tmp / "in", by, files), write, str(tmp / "c"), "append", once=True)
    assert q.awaitTermination(300) and q.exception() is None
    assert len(q.recentProgress) >= files and not any(p["stateOperators"] for p in q.recentProgress)
    assert sum(p["numInputRows"] for p in q.recentProgress) == src.count()       # every record is read once
    return write, lambda: spark.read.option("basePath", str(tmp / "out")).text(str(tmp / "out")).select("topic", "value")


def test_log_topics_stream(spark, sf, tmp_path):
    from rillmart.plans import ingest
    src = feeds.log_text(spark, sf)
    _, got = run_log(spark, src, tmp_path, ["ts", "event_id"])
    assert rows(got()) == rows(ingest.log_topics(src, order=["ts", "event_id"]))


def test_log_topics_with_a_third_of_all_rows_on_one_visitor(spark, tmp_path):
    """Heavy visitors are dealt out; flags over several days and micro-batches, a repeat, and a new run."""
    import json

    from rillmart.plans import ingest
    from rillmart.streaming.visitors import first_day_table, log_batches
    day = 86_400_000

    def text(i):
        mid = "hot" if i % 3 == 0 else f"m{i % 11}"
        return json.dumps({"common": {"mid": mid, "is_new": "1" if i % 4 else "0", "os": "x"}, "page": {"page_id": "p", "n": i}, "ts": 10 * day + i * day // 150})

    src = spark.createDataFrame([(i, text(i) if i % 50 else "{broken") for i in range(600)], "n long, value string")
    order = ["ts", "n"]
    write, got = run_log(spark, src, tmp_path, order, "n", 4, hot_rows=50)
    want = rows(ingest.log_topics(src, order=order))
    assert rows(got()) == want and any('"is_new":"0"' in v for _, v in want)
    days = first_day_table(str(tmp_path / "days"))
    assert days.read(spark).count() == 12 and {p.tier for p in days.parts(spark)} == {0}
    write(src.where("n > 449"), 3)                                               # as the last micro-batch again
    assert rows(got()) == want and days.read(spark).count() == 12
    again = log_batches(str(tmp_path / "days"), str(tmp_path / "out2"), order, run=1)
    again(src.where("n > 449"), 0)
    late = spark.read.option("basePath", str(tmp_path / "out2")).text(str(tmp_path / "out2"))
    assert not [v for v in (r.value for r in late.where("topic like '%page%'").collect()) if '"is_new":"1"' in v]


def test_lateness_refreshes_a_window(spark, tmp_path):
    """A row behind the watermark delay but within the lateness updates its window.

    Spark drops by the watermark of the batch before, hence the row in between.
    """
    from rillmart.operators.windows import tumble, watermarked
    src = spark.createDataFrame([(1, 5), (2, 25), (3, 8), (4, 200), (5, 201), (6, 9)], "n long, s long").withColumn(
        "t", F.timestamp_seconds("s"))
    live = tumble(watermarked(as_stream(src, tmp_path / "in", "n", 6), lateness_s=60), {"c": F.count("*")})
    got, q = run_keyed(live, tmp_path, WINDOW)
    assert sorted((r.stt[-5:], r.c) for r in got.collect()) == [("00:00", 2), ("00:20", 1), ("03:20", 2)]
    assert sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"]) == 1


TTL = detail.ORDER_TTL_S


def latest(df):
    """What a sink keyed by the detail row holds."""
    return routing.latest_per_key(df.withColumn("s", F.col("ts").cast("long")), ["order_detail_id"], [
        "s", "sku_id", "source_id", "split_payment_amount", "sku_num"]).drop("s")


def test_pay_and_refund_streams(spark, sf, tmp_path):
    """Interval join and chained two-key inner joins."""
    cdc = feeds.cdc_frame(spark, sf).withColumn("s", F.col("ts").cast("long"))
    dic = feeds.dictionary(spark, sf)
    details = detail.order_detail(cdc, dic).withColumn("s", F.col("ts").cast("long"))
    live_cdc = as_stream(cdc.where(F.col("table").isin("payment_info", "refund_payment", "order_refund_info", "order_info")),
                         tmp_path / "cdc", "s", 2).withWatermark("t", "1 hour")
    live_details = as_stream(details, tmp_path / "details", "s", 2).withWatermark("t", "1 hour")
    paid = detail.pay_detail(live_details, live_cdc, dic)
    for name, live, want in (("pay", paid, detail.pay_detail(details.drop("s"), cdc, dic, tie=["sku_id", "source_id", "split_payment_amount", "sku_num"])),
                             ("refund", detail.refund_pay(live_cdc, dic, TTL), detail.refund_pay(cdc, dic, TTL)),
                             ("asked", detail.order_refund(live_cdc, dic, TTL), detail.order_refund(cdc, dic, TTL))):
        out = str(tmp_path / name)
        q = live.drop("t").writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", out + "_c").trigger(availableNow=True).start()
        assert q.awaitTermination(120) and q.exception() is None
        got = spark.read.parquet(out)
        assert rows(want) and rows(latest(got) if name == "pay" else got) == rows(want.drop("t"))


def test_cart_and_refund_user_streams(spark, sf, tmp_path):
    cdc = feeds.cdc_frame(spark, sf).withColumn("s", F.col("ts").cast("long"))
    dic, dims = feeds.dictionary(spark, sf), feeds.dimensions(spark, sf)
    carts = as_stream(cdc.where(F.col("table") == "cart_info"), tmp_path / "cart", "s", 2)
    q = detail.cart_add(carts, dic).drop("t").writeStream.format("parquet").option(
        "path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert q.awaitTermination(120) and q.exception() is None
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(detail.cart_add(cdc, dic).drop("t"))
    asked = detail.order_refund(cdc, dic).withColumn("s", F.col("ts").cast("long"))
    live = jobs.refund_users(as_stream(asked, tmp_path / "refund", "s"), dims, width="1 hour")
    want = summary.refund_users(asked, dims, width="1 hour")
    same(live, want, tmp_path / "2", [*WINDOW, "trademark_id", "category3_id", "user_id"])


def test_cancel_detail_stream(spark, sf, tmp_path):
    """Lines wait up to fifteen minutes for their cancellation."""
    cdc = feeds.cdc_frame(spark, sf).withColumn("s", F.col("ts").cast("long"))
    cdc = cdc.where(F.col("table").startswith("order_") & (F.col("table") != "order_refund_info"))
    dic = feeds.dictionary(spark, sf)
    live = as_stream(cdc, tmp_path / "in", "s")
    cdc.where(F.col("table") != "order_info").dropDuplicates(["table"]).withColumn(
        "data", feeds.entries(id=F.lit("end"), order_id=F.lit("end"), order_detail_id=F.lit("end"))).withColumn(
        "t", F.timestamp_seconds(F.lit(4000000000))).unionByName(
        cdc.where(parse.moved_to("order_status", "1003")).limit(1).withColumn(
            "data", feeds.entries(id=F.lit("end"), order_status=F.lit("1003"))).withColumn(
            "t", F.timestamp_seconds(F.lit(4000000000)))).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    live = detail.cancel_detail(live.withWatermark("t", "10 seconds"), dic, detail.CANCEL_TTL_S)
    q = live.drop("t").writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    assert q.awaitTermination(200) and q.exception() is None
    want = rows(detail.cancel_detail(cdc, dic, detail.CANCEL_TTL_S).drop("t"))
    assert want and rows(spark.read.parquet(str(tmp_path / "out"))) == want
