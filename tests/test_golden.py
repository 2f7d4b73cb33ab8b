"""Hand-computed scenarios, one or more per operator."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rillmart.functions import clock, payload, values, words
from rillmart.operators import joins, keyed, parse, routing, skew, windows
from rillmart.plans import detail, ingest
from rillmart.session import prepare
from rillmart.sources import dims, topics


def one(df, column=None):
    return [r[0] if column is None else r[column] for r in df.collect()]


def text(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def at(spark, data, schema):
    """Rows with ``s`` seconds as event time ``t``."""
    return spark.createDataFrame(data, schema).withColumn("t", F.timestamp_seconds("s"))


DAY = 86_400


def test_dirty_split(spark):
    df = text(spark, '{"a":1}', "oops", "[1]", "null", None)
    good, bad = parse.split_objects(df)
    assert one(good) == ['{"a":1}'] and bad.count() == 4


def test_log_split_is_strict(spark):
    ok = '{"common":{"mid":"m","is_new":"1"},"page":{"page_id":"home","during_time":12},"ts":1000}'
    assert parse.split_log(text(spark, ok + "\n", ok + " \t", "\r\n " + ok))[0].count() == 3
    assert parse.split_log(text(spark, ok + ' {"x":1}', ok + " }", ok + ',"x":1', ok + "]", ok + "} x}"))[1].count() == 5
    df = text(spark, ok, ok + " x", '[' + ok + ']', '{"common":{"mid":"m"}}', '{"ts":1}', ok[:-1], "null", None)
    good, dirty = parse.split_log(df)
    row = good.collect()
    assert len(row) == 1 and row[0].page.during_time == "12" and row[0].ts == 1000
    assert dirty.count() == 7


def test_valid_changes(spark):
    lines = [json.dumps({"database": "d", "table": "x", "type": t, "data": {"id": "1"}, "ts": "5"}) for t in
             ("insert", "update", "bootstrap-start", "bootstrap-insert", "bootstrap-complete")]
    lines += ["{bad", json.dumps({"type": "insert", "data": None}), json.dumps({"data": {"id": "1"}})]
    got = parse.valid_changes(topics.read_cdc(text(spark, *lines)))
    assert sorted(one(got, "type")) == ["insert", "update"]
    assert one(got.select(clock.second_text("t")))[0] == "1970-01-01 00:00:05"


def cdc(spark, *rows):
    schema = "`table` string, type string, data map<string,string>, old map<string,string>, ts string, database string"
    return parse.with_cdc_times(spark.createDataFrame([(*r, "d") for r in rows], schema))


def test_status_transition(spark):
    df = cdc(spark, ("o", "update", {"order_status": "1003", "id": "a"}, {"order_status": "1001"}, "1"),
             ("o", "update", {"order_status": "1003", "id": "b"}, {"operate_time": "x"}, "1"),
             ("o", "insert", {"order_status": "1003", "id": "c"}, None, "1"))
    assert one(df.where(parse.moved_to("order_status", "1003")).select(F.col("data")["id"])) == ["a"]


def test_cart_delta_and_lookup(spark):
    def cart(n, kind, num, old, source="2401"):
        return ("cart_info", kind, {"id": n, "sku_num": num, "source_type": source}, old, "1")
    df = cdc(spark, cart("1", "insert", "2", None), cart("2", "update", "5", {"sku_num": "2"}),
             cart("3", "update", "3", {"sku_num": "5"}), cart("4", "update", "9", {"source_id": "1"}),
             cart("5", "insert", "1", None, "9999"), cart("6", "update", "n/a", {"sku_num": "1"}))
    dic = spark.createDataFrame([("2401", "search")], "dic_code string, dic_name string")
    got = detail.cart_add(df, dic).collect()
    assert sorted((r.id, r.sku_num, r.source_type_name) for r in got) == [("1", "2", "search"), ("2", "3", "search")]


def test_amounts(spark):
    df = spark.createDataFrame([("3", "19.9", "x")], "n string, p string, bad string")
    assert one(df.select(values.product_text("n", "p"))) == ["59.7000"]
    assert one(df.select(values.amount_or_zero("bad"))) == [Decimal("0.00")]


def test_prune_by_list(spark):
    df = spark.createDataFrame([({"id": "1", "user_id": "2", "x": "3"}, "user_id, x")], "d map<string,string>, l string")
    assert one(df.select(values.listed_only("d", "l"))) == [{"user_id": "2", "x": "3"}]


def log_line(**kw):
    base = {"common": {"mid": "m", "is_new": "1"}, "ts": 1000}
    return json.dumps({**base, **kw})


def test_log_routes(spark):
    df = text(spark, log_line(err={"code": 1}, start={"entry": "icon"}),
              log_line(page={"page_id": "home"}, displays=[{"order": 1}, {"order": 2}], actions=[{"id": "a"}]),
              log_line(err={"code": 2}, page={"page_id": "x"}), "dirty")
    out = ingest.log_topics(df)
    by = {}
    for r in out.collect():
        by.setdefault(r.topic, []).append(r.value)
    assert {k: len(v) for k, v in by.items()} == {
        "dwd_traffic_error_log": 2, "dwd_traffic_start_log": 1, "dwd_traffic_display_log": 2,
        "dwd_traffic_action_log": 1, "dwd_traffic_page_log": 2, "dirty_data": 1}
    assert by["dirty_data"] == ["dirty"]
    start = json.loads(by["dwd_traffic_start_log"][0])
    assert start["start"] == {"entry": "icon"} and "err" not in start
    shown = [json.loads(x) for x in by["dwd_traffic_display_log"]]
    assert sorted(x["display"]["order"] for x in shown) == [1, 2] and all(x["ts"] == 1000 for x in shown)
    assert "ts" not in json.loads(by["dwd_traffic_action_log"][0])
    page = [json.loads(x) for x in by["dwd_traffic_page_log"]]
    assert all(not {"displays", "actions", "err"} & set(p) for p in page)
    errors = [json.loads(x) for x in by["dwd_traffic_error_log"]]
    assert sorted(e["err"]["code"] for e in errors) == [1, 2]
    good, _ = parse.split_log(df)
    assert {k: v.count() for k, v in routing.split_routes(good).items()} == {
        "error": 2, "start": 1, "display": 2, "action": 1, "page": 2}


def test_log_keeps_every_field_and_type(spark):
    said = {"common": {"mid": "m", "is_new": "1", "os": "A 11", "n": 1.5}, "page": {"page_id": "home", "during_time": 12, "source": None},
            "err": {"a": [1, {"b": True}]}, "extra": 5, "displays": [{"order": 1, "x": [2]}], "ts": 1000}
    later = {**said, "ts": 1000 + 2 * DAY * 1000}
    out = {}
    for r in ingest.log_topics(text(spark, json.dumps(said), json.dumps(later))).collect():
        got = json.loads(r.value)
        out[r.topic, got["ts"]] = got
    assert out["dwd_traffic_error_log", 1000] == said
    repaired = {**later, "common": {**said["common"], "is_new": "0"}}
    assert out["dwd_traffic_error_log", later["ts"]] == repaired
    assert out["dwd_traffic_page_log", 1000] == {k: said[k] for k in ("common", "page", "extra", "ts")}
    assert out["dwd_traffic_display_log", later["ts"]] == {
        "display": said["displays"][0], **{k: repaired[k] for k in ("common", "page", "ts")}}


def test_rules_of_equal_time_follow_their_position(spark):
    made = spark.createDataFrame([(None, rule("a", "insert", "t1"), "c", 5, 1), (rule("a", "insert", "t1"), None, "d", 5, 2),
                                  (None, rule("b", "insert", "t2"), "c", 5, 4), (None, rule("b", "insert", "t3"), "u", 5, 3)],
                                 f"before {routing._rule_type()}, after {routing._rule_type()}, op string, seq bigint, pos bigint")
    alive = routing.fold_rules(routing.rule_changes(None, made), "dwd").collect()
    assert [(r.source_table, r.sink_table) for r in alive] == [("b", "t2")]


def test_routed_fact_is_whole(spark):
    said = {"database": "d", "table": "a", "type": "insert", "ts": 7, "xid": 3, "xoffset": 4.5, "data": {"id": 159, "x": "1"}, "old": None}
    preload = spark.createDataFrame([rule("a", "insert", "t1")], routing.RULE_SCHEMA)
    got = ingest.routed_fact_lines(text(spark, json.dumps(said), "{bad", json.dumps({**said, "data": 1})), preload, None).collect()
    assert [json.loads(r.value) for r in got] == [{**said, "data": {"id": 159}, "sink_table": "t1"}]


def test_cancel_carries_its_own_time(spark):
    line = {"id": "1", "order_id": "o", "source_type": "2401", "sku_num": "1", "order_price": "2"}
    df = cdc(spark, ("order_detail", "insert", line, None, "10"),
             ("order_info", "update", {"id": "o", "order_status": "1003", "operate_time": "1970-01-01 00:30:00"}, {"order_status": "1001"}, "1800"))
    dic = spark.createDataFrame([("2401", "search")], "dic_code string, dic_name string")
    row = detail.cancel_detail(df, dic).select("ts", F.col("t").cast("long").alias("s")).collect()
    assert [(r.ts, r.s) for r in row] == [("1800", 1800)]


def test_last_payment_of_a_detail_row(spark):
    line = {"id": "1", "order_id": "o", "source_type": "2401", "sku_num": "1", "order_price": "2"}
    def pay(kind, status, at):
        return ("payment_info", kind, {"order_id": "o", "payment_type": "2401", "payment_status": status, "callback_time": at},
                {"payment_status": "x"} if kind == "update" else None, at)
    df = cdc(spark, ("order_detail", "insert", line, None, "10"), ("order_info", "insert", {"id": "o", "user_id": "u"}, None, "10"),
             pay("insert", "1601", "20"), pay("update", "1602", "30"), pay("update", "1603", "40"), pay("update", "1602", "2000"))
    dic = spark.createDataFrame([("2401", "search")], "dic_code string, dic_name string")
    details = detail.order_detail(df, dic)
    assert one(detail.pay_detail(details, df, dic), "ts") == ["40"]
    assert one(detail.pay_detail(details, df, dic, strict=True), "ts") == ["30"]


def rule(table, kind, sink, sink_type="dwd"):
    return (table, kind, sink, sink_type, "id", None, None)


def rules(spark, *changes):
    t = f"struct<{routing.RULE_SCHEMA.replace(' string', ':string')}>"
    return spark.createDataFrame([(b, a, op, i + 1) for i, (b, a, op) in enumerate(changes)],
                                 f"before {t}, after {t}, op string, seq bigint")


def test_rule_fold(spark):
    a1, a3, b = rule("a", "insert", "t1"), rule("a", "insert", "t3"), rule("b", "insert", "t2")
    changes = rules(spark, (None, a1, "c"), (None, b, "c"), (a1, a3, "u"), (b, None, "d"))
    got = routing.fold_rules(routing.rule_changes(None, changes), "dwd").collect()
    assert [(r.source_table, r.sink_table) for r in got] == [("a", "t3")]


def test_rule_fold_key_and_type_changes(spark):
    a, moved = rule("a", "insert", "t1"), rule("a2", "insert", "t1")
    dim = rule("d", None, "x", "dim")
    to_fact = rule("d", "insert", "x", "dwd")
    changes = routing.rule_changes(None, rules(spark, (None, a, "c"), (a, moved, "u"), (None, dim, "c"), (dim, to_fact, "u")))
    assert sorted(one(routing.fold_rules(changes, "dwd"), "source_table")) == ["a2", "d"]
    assert one(routing.fold_rules(changes, "dim"), "source_table") == []


def test_rule_precedence(spark):
    preload = spark.createDataFrame([rule("a", "insert", "t1"), rule("z", "insert", "t9")], routing.RULE_SCHEMA)
    changes = rules(spark, (None, rule("a", "insert", "t2"), "c"))
    got = routing.fold_rules(routing.rule_changes(preload, changes), "dwd").collect()
    assert sorted((r.source_table, r.sink_table) for r in got) == [("a", "t2"), ("z", "t9")]


def test_left_join(spark):
    lines = at(spark, [("1", 0), ("2", 0)], "id string, s long")
    acts = at(spark, [("1", "x", 3), ("2", "y", 9)], "line string, act string, s long")
    got = joins.bounded_join(lines, acts, {"id": "line"}, "left", ttl_s=5).collect()
    assert sorted((r.id, r.act) for r in got) == [("1", "x"), ("2", None)]


def test_interval_join(spark):
    noon = 43_200
    rows = at(spark, [("o", noon - 900), ("o", noon - 901), ("o", noon + 5), ("o", noon + 6)], "k string, s long")
    pay = at(spark, [("o", noon)], "pk string, s long").withColumnRenamed("t", "pt").drop("s")
    got = joins.interval_join(rows, pay, {"k": "pk"}, t_right="pt")
    assert sorted(one(got, "s")) == [noon - 900, noon + 5]


def test_near_join_meets_every_pair_once(spark):
    left = at(spark, [("k", i * 37 % 1000) for i in range(120)], "k string, s long")
    right = spark.createDataFrame(
        [("k", i * 53 % 1000) for i in range(80)], "rk string, rs long").withColumn("rt", F.timestamp_seconds("rs"))
    for before, after in ((0, 0), (3, 1), (50, 20)):
        got = joins.interval_join(left, right, {"k": "rk"}, before, after, t_right="rt")
        want = sorted((a, b) for a in {i * 37 % 1000 for i in range(120)} for b in {i * 53 % 1000 for i in range(80)}
                      if b - before <= a <= b + after)
        assert sorted((r.s, r.rs) for r in got.collect()) == want


def test_snowflake_with_gap(spark):
    def table(rows, *cols):
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    d = {"sku": table([("1", "phone", "7", "30", "9")], "id", "sku_name", "tm_id", "category3_id", "spu_id"),
         "spu": table([("9", "line")], "id", "spu_name"), "trademark": table([("7", "acme")], "id", "tm_name"),
         "category3": table([("30", "mobile", "20")], "id", "name", "category2_id"),
         "category2": table([("21", "other", "10")], "id", "name", "category1_id"),
         "category1": table([("10", "all")], "id", "name")}
    got = joins.enrich_snowflake(table([("1",), ("2",)], "sku_id"), d).orderBy("sku_id").collect()
    assert (got[0].category3_name, got[0].category2_id, got[0].category2_name, got[0].category1_name) == (
        "mobile", "20", None, None)
    assert got[1].sku_name is None and len(got) == 2


def test_distinct_and_windows(spark):
    df = at(spark, [("o1", 9), ("o1", 9), ("o2", 8), ("o3", 10)], "o string, s long")
    got = windows.tumble(df, {"n": F.count_distinct("o")}).orderBy("stt").collect()
    assert [(r.stt[-2:], r.edt[-2:], r.n) for r in got] == [("00", "10", 2), ("10", "20", 1)]


@pytest.mark.parametrize("lateness, late", [(0, [2]), (10, [])])
def test_late_rows(spark, lateness, late):
    df = at(spark, [(0, 5), (1, 25), (2, 15)], "arrival long, s long")
    assert one(windows.mark_late(df, lateness_s=lateness, block=1).where("late"), "arrival") == late


@pytest.mark.parametrize("hot", [dict(hot_rows=1), dict(hot_rows=10**9)])
def test_flag_repair(spark, hot):
    data = [("m", "1", 1), ("m", "1", 2), ("m", "1", DAY + 1), ("m", "0", 2 * DAY), ("z", "0", DAY), ("z", "1", DAY + 5),
            (None, "1", 5)]
    df = at(spark, data, "mid string, is_new string, s long")
    got = keyed.repair_visitor_flag(df, order=["s"], **hot)
    assert sorted((str(r.mid), r.s, r.is_new) for r in got.collect()) == [
        ("None", 5, "1"), ("m", 1, "1"), ("m", 2, "1"), ("m", DAY + 1, "0"), ("m", 2 * DAY, "0"),
        ("z", DAY, "0"), ("z", DAY + 5, "0")]


def test_first_of_day(spark):
    df = at(spark, [("u", 1), ("u", 2), ("u", DAY + 1), ("u", 3)], "u string, s long")
    assert sorted(one(keyed.first_of_day(df, ["u"]), "s")) == [1, DAY + 1]


def test_user_days(spark):
    df = at(spark, [("u", 1), ("u", 11), ("u", DAY + 1)], "u string, s long")
    got = windows.tumble(keyed.user_day_measures(df, "u", "uq", "nw"), windows.total("uq", "nw")).orderBy("stt").collect()
    assert [(r.uq, r.nw) for r in got] == [(1, 1), (0, 0), (1, 0)]


def test_two_page_flags(spark):
    df = at(spark, [("m", "home", 1), ("m", "good_detail", 2), ("m", "home", 3)], "mid string, p string, s long")
    got = keyed.page_first_visits(df, "mid", "p", {"home": "h", "good_detail": "g"}).orderBy("t").collect()
    assert [(r.h, r.g) for r in got] == [(1, 0), (0, 1)]


def test_returning_user(spark):
    df = at(spark, [("u", DAY), ("u", 8 * DAY), ("u", 16 * DAY)], "uid string, s long")
    got = keyed.login_flags(df, "uid").orderBy("t").collect()
    assert [(r.uu_ct, r.back_ct) for r in got] == [(1, 0), (1, 0), (1, 1)]


@pytest.mark.parametrize("first, second, want", [
    ("10.00", "12.50", ["-10.00", "10.00", "12.50"]), ("-1.00", "2.00", ["-1.00", "1.00", "2.00"]),
    (None, "3.00", ["0.00", "0.00", "3.00"])])
def test_retract(spark, first, second, want):
    df = at(spark, [("1", first, 1), ("1", second, 100)], "id string, a string, s long")
    df = df.withColumn("a", values.amount("a"))
    log = keyed.retract_changelog(df, "id", ["s"], ["a"], hot_rows=1)
    assert sorted(str(r.a) for r in log.collect()) == want
    back = log.where("sign = -1").collect()
    assert len(back) == 1 and back[0].s == 1
    net = keyed.net_measures(df, "id", ["s"], ["a"], [])
    assert net.agg(F.sum("a")).first()[0] == log.agg(F.sum("a")).first()[0] == Decimal(second)


def test_net_measures_shuffle_only_what_a_group_looks_at(spark):
    """A window's row carries no version, and versions of equal order are told apart alike in any order of rows."""
    rows = [("1", "p", "a", "1.00", 5), ("1", "p", "b", "2.00", 5), ("2", "q", "b", "4.00", 25), ("2", "p", "b", "3.00", 5)]
    results = []
    for data in (rows, rows[::-1]):
        df = at(spark, data, "id string, p string, o string, a string, s long").withColumn("a", values.amount("a")).coalesce(1)
        net = keyed.net_measures(df, "id", ["s"], ["a"], ["p"], once="o")
        plan = net._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "max_by" not in plan
        results.append(sorted((r.t.timestamp(), r.p, str(r.a), r.once) for r in net.collect()))
    assert results[0] == results[1]
    assert sorted(a for _, _, a, _ in results[0] if a != "0.00") == ["2.00", "4.00"]
    assert sum(n for *_, n in results[0]) == 2


@pytest.mark.parametrize("hot", [dict(hot_rows=10), dict(hot_rows=1), dict(hot_rows=10**9)])
def test_previous_across_pieces(spark, hot):
    """Pieces of one row, of many rows and of all rows give the same previous rows."""
    data = [("k", i * 7 % 50) for i in range(50)] + [("j", i) for i in range(5)] + [("i", 3)]
    df = spark.createDataFrame(data, "k string, s long")
    want = sorted((k, s, s - 1 if s and k != "i" else -1) for k, s in data)
    for sizes in ((1,), (7,), (1000,), (1, 10), (2, 6, 30), (7, 1000)):
        pieces = [F.floor(F.col("s") / n) for n in sizes]
        got = skew.with_previous(df, ["k"], ["s"], pieces, ["s"], **hot)
        assert sorted((r.k, r.s, r.prev.s if r.prev else -1) for r in got.collect()) == want


def test_pieces_are_dealt_out_before_they_are_sorted(spark):
    """Last rows of pieces are not found by sorting all of an input task's rows."""
    df = spark.createDataFrame([("k", i, i // 5) for i in range(20)], "k string, s long, p long").select("*", F.struct("s").alias("_held"))
    found = skew._before_pieces(df, ["k"], ["s"], ["p"])
    assert "REPARTITION_BY_COL" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.p, r._held.s) for r in found.collect()) == [(1, 4), (2, 9), (3, 14)]


@pytest.mark.parametrize("hot", [dict(hot_rows=10**9)])
def test_count_once(spark, hot):
    df = at(spark, [("o1", 3), ("o1", 1), ("o1", 2), ("o2", 9)], "o string, s long")
    got = keyed.mark_once(df, "o", ["s"], **hot).collect()
    assert sorted((r.o, r.s, r.once) for r in got) == [("o1", 1, 1), ("o1", 2, 0), ("o1", 3, 0), ("o2", 9, 1)]
    assert keyed.count_once(df, "o", ["s"], "n", ["o"]).count() == 2


def test_visit_measures(spark):
    df = at(spark, [("m", None, 1), ("m", "home", 2), ("m", None, 3)], "mid string, last string, s long").withColumns(
        {"vc": F.lit("v"), "d": F.lit(5).cast("bigint")})
    got = keyed.visit_measures(df, "mid", ["vc"], "last", "d", ["s"]).agg(
        *[F.sum(c) for c in ("uv_ct", "sv_ct", "pv_ct", "dur_sum")]).first()
    assert tuple(got) == (1, 2, 3, 15)


def test_zone(spark):
    df = spark.createDataFrame([("2022-01-01", "2022-01-01 08:00:01")], "d string, f string")
    try:
        prepare(spark, "Asia/Shanghai")
        got = df.select(clock.to_epoch_ms("d"), clock.to_epoch_ms("f", full=True),
                        clock.second_text_ms(F.lit(1640966400000)), clock.day_of_text(F.lit("junk"))).first()
        assert tuple(got) == (1640966400000, 1640995201000, "2022-01-01 00:00:00", None)
    finally:
        prepare(spark)


def test_version_time(spark):
    df = spark.createDataFrame([(1, "2022-04-18T02:04:55.04Z"), (2, "2022-04-18T02:04:55.039Z")], "i int, x string")
    assert df.orderBy(F.desc(values.version_time("x"))).first().i == 1


def test_words(spark):
    df = spark.createDataFrame([("Oak Table T9 (round) 120cm 木桌圆形 客厅餐桌X2 大大小小",), ("...",), (None,)],
                               "x string")
    plain = one(words.words_of(df, "x"), "word")
    assert {"oak", "table", "t9", "120cm", "x2", "木", "桌"} <= set(plain)
    listed = ["木桌", "圆形", "客厅", "餐桌", "客厅餐桌"]
    cut = one(words.words_of(df, "x", dictionary=listed), "word")
    assert sorted(w for w in cut if w in "大小") == ["大", "大", "小", "小"]
    assert {"木桌", "圆形", "客厅餐桌", "oak"} <= set(cut) and "客厅" not in cut
    row = words.han_cutter(listed)(words.han_runs("x"))
    by_row = [w for r in df.where("x is not null").select(row.alias("w")).collect() for w in r.w]
    assert sorted(by_row) == sorted(w for w in cut if not w.isascii())


def test_smart_cut_where_the_longest_word_first_is_wrong(spark):
    """Most characters covered, then fewest words, then the longest first word; both forms against all ways to cut."""
    import random
    listed = ["研究", "研究生", "生命", "命", "起源", "甲乙", "乙丙丁", "丙丁", "丁戊", "子丑寅", "子丑", "丑寅卯", "寅卯"]
    df = spark.createDataFrame([("研究生命起源",), ("甲乙丙丁戊",), ("子丑寅卯",)], "x string")
    assert one(words.words_of(df, "x", dictionary=listed, mode="longest"), "word").count("命") == 1
    assert best_cut("研究生命起源", listed) == ["研究", "生命", "起源"] and best_cut("甲乙丙丁戊", listed) == ["甲乙", "丙丁", "戊"]
    assert best_cut("子丑寅卯", listed) == ["子丑", "寅卯"]
    assert sorted(one(words.words_of(df, "x", dictionary=listed), "word")) == sorted(
        w for run in ("研究生命起源", "甲乙丙丁戊", "子丑寅卯") for w in best_cut(run, listed))
    made = random.Random(2)
    pool = ["".join(made.choice("甲乙丙") for _ in range(made.randint(2, 4))) for _ in range(12)]
    texts = ["".join(made.choice("甲乙丙丁") for _ in range(made.randint(1, 9))) for _ in range(60)]
    want = sorted(w for t in texts for w in best_cut(t, pool))
    many = spark.createDataFrame([(t,) for t in texts], "x string")
    assert sorted(one(words.words_of(many, "x", dictionary=pool), "word")) == want
    by_row = many.select(words.han_cutter(pool)(words.han_runs("x")).alias("w")).collect()
    assert sorted(w for r in by_row for w in r.w) == want


def best_cut(run, listed):
    """The best of all ways to cut a run, tried one by one."""
    def ways(rest):
        if not rest:
            yield []
        for n in range(1, len(rest) + 1):
            if n == 1 or rest[:n] in listed:
                for tail in ways(rest[n:]):
                    yield [rest[:n], *tail]
    return max(ways(run), key=lambda w: (sum(len(x) for x in w if len(x) > 1), -len(w), [len(x) for x in w]))


def test_json_edits(spark):
    df = spark.createDataFrame([("x", 1)], "a string, b int").select(F.struct("a", "b").alias("r"))
    assert one(df.select(payload.text_of(payload.remove("r", "b")))) == ['{"a":"x"}']
    assert one(df.select(payload.text_of(payload.put("r", "c", F.lit(2))))) == ['{"a":"x","b":1,"c":2}']


def test_rule_table(spark):
    df = spark.createDataFrame([({"id": "1", "name": "n", "x": "y"},)], "data map<string,string>")
    out = dims.rows_as_text(df, "id, name,gone")
    assert out.columns == ["id", "name", "gone"] and tuple(out.first()) == ("1", "n", None)
    dims.create_table(spark, "dim_made", "id,name")
    dims.create_table(spark, "dim_made", "id,name")
    assert spark.table("dim_made").dtypes == [("id", "string"), ("name", "string")]
    spark.sql("drop table dim_made")
