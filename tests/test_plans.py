"""How often executed plans read their input, and the flattened dimension against the joins level by level."""

import json

import pytest
from pyspark.sql import functions as F

from rillmart.checks import feeds
from rillmart.functions import payload, values
from rillmart.operators import joins, parse, routing, skew
from rillmart.plans import detail, summary
from rillmart.sources import sinks
from rillmart.sources.flat import COLUMNS, FlatGoods, keep_flat


@pytest.fixture
def tables(spark, sf, tmp_path):
    """Changes, dictionary and dimensions as files, so that every reading of one is a scan."""
    def kept(df, name):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    dims = {n: kept(d, n) for n, d in feeds.dimensions(spark, sf).items()}
    return kept(feeds.cdc_frame(spark, sf), "cdc"), kept(feeds.dictionary(spark, sf), "dic"), dims


def scans(df):
    """(file scans of the executed plan of ``df``, exchanges that are used again not counted)."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("FileScan parquet")


def versions(tables):
    cdc, dic, _ = tables
    return detail.order_detail(cdc, dic).withColumn("seq", F.lit(0))


@pytest.mark.parametrize("name, lookups", [("sku", 6), ("province", 1), ("users", 0)])
def test_measures_read_the_wide_table_once(spark, tables, name, lookups):
    wide, dims = versions(tables), tables[2]
    branches = scans(wide)
    assert branches == 5                    # lines, orders, activities, coupons, dictionary
    made = {"sku": lambda: summary.sku_orders(wide, dims), "users": lambda: summary.order_users(wide),
            "province": lambda: summary.province_orders(wide, dims["province"])}[name]()
    assert scans(made) == branches + lookups


def test_facts_meet_the_snowflake_in_one_join(spark, tables):
    dims = tables[2]
    facts = spark.range(5000).select((F.col("id") % 250).cast("string").alias("sku_id"), "id")
    want = joins.enrich_sku(facts, dims)
    want = joins.enrich(want, dims["spu"], "spu_id", {"spu_name": "spu_name"})
    want = joins.enrich(want, dims["trademark"], "trademark_id", {"tm_name": "trademark_name"})
    want = joins.enrich(want, dims["category3"], "category3_id", {"name": "category3_name", "category2_id": "category2_id"})
    want = joins.enrich(want, dims["category2"], "category2_id", {"name": "category2_name", "category1_id": "category1_id"})
    want = joins.enrich(want, dims["category1"], "category1_id", {"name": "category1_name"})
    got = joins.enrich_snowflake(facts, dims)
    assert got.exceptAll(want.select(got.columns)).count() == 0 and got.count() == 5000
    flat = joins.enrich_snowflake(facts, {"flat": joins.flat_skus(dims)})
    assert flat.exceptAll(got).count() == 0


def test_flat_goods_follow_changes_at_any_level(spark, tmp_path):
    goods = FlatGoods(str(tmp_path / "flat"), str(tmp_path / "dims"), {level: f"dim_{level}" for level in COLUMNS})
    write = keep_flat(goods, ["ts"])

    def batch(number, *rows):
        schema = "sink_table string, sink_pk string, type string, data map<string,string>, ts long"
        df = spark.createDataFrame([(f"dim_{level}", "id", kind, data, number) for level, kind, data in rows], schema)
        write(df, number)
        return {r.id: r.asDict() for r in goods.read(spark).collect()}

    def sku(i, **more):
        return "sku", "insert", {"id": i, "sku_name": f"n{i}", "spu_id": "p", "tm_id": "t", "category3_id": "c3", **more}

    now = batch(0, sku("1"), sku("2", category3_id="d3"), sku("3", spu_id=None))
    assert set(now) == {"1", "2", "3"} and now["1"]["spu_name"] is None
    now = batch(1, ("category1", "insert", {"id": "c1", "name": "all"}), ("category2", "insert", {"id": "c2", "name": "some", "category1_id": "c1"}),
                ("category3", "insert", {"id": "c3", "name": "few", "category2_id": "c2"}), ("trademark", "insert", {"id": "t", "tm_name": "acme"}))
    assert (now["1"]["category1_name"], now["1"]["trademark_name"], now["2"]["category1_name"], now["2"]["trademark_name"]) == (
        "all", "acme", None, "acme")
    batch(2, ("category1", "update", {"id": "c1", "name": "everything"}))
    part = spark.read.parquet(str(tmp_path / "flat/tier=0/run=0/first=2/batch=2"))
    assert sorted(r.id for r in part.collect()) == ["1", "3"]           # sku 2 hangs below another category
    now = batch(3, ("sku", "delete", {"id": "1"}), ("spu", "insert", {"id": "p", "spu_name": "line"}), ("category2", "delete", {"id": "c2"}))
    assert set(now) == {"2", "3"}
    assert (now["2"]["spu_name"], now["3"]["spu_name"], now["3"]["category2_id"], now["3"]["category2_name"]) == ("line", None, "c2", None)
    assert batch(3, ("sku", "delete", {"id": "1"}), ("spu", "insert", {"id": "p", "spu_name": "line"}), ("category2", "delete", {"id": "c2"})) == now
    assert batch(4) == now
    want = {r.id: r.asDict() for r in joins.flat_skus(goods.levels(spark)).collect()}
    assert now == want


def test_records_are_parsed_once_and_leaves_by_one_reading_each(spark, sf):
    marked = parse.mark_log(feeds.log_text(spark, sf).select("value"))
    plan = marked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count('concat({"r":') == 1
    assert "hashpartitioning(event_id" in plan      # dealt before it is made and parsed, also from one row group
    texts = ['{"a":{"b":1.50,"c":null,"d":"x\\"y"},"e":[1,{"f":2}],"g":true}', '{"a":"text","e":null}', '{"a":{"b":{"z":1}}}',
             '{"a":null,"g":12345678901234567890}', "{}", "[]", "broken", "", None]
    paths = ["a.b", "a.c", "a.d", "e", "g", "none", "none.b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    read = payload.get_texts(df, "value", paths, [f"o{n}" for n in range(len(paths))]).orderBy("i").collect()
    want = df.select("i", "value", *[payload.get_text("value", f"$.{p}").alias(f"o{n}") for n, p in enumerate(paths)]).orderBy("i").collect()
    assert read == want


def wide_exchanges(df, capsys):
    """Shuffles of rows that have a sku's name, in the plan of ``df``."""
    capsys.readouterr()
    df.explain("formatted")
    blocks = capsys.readouterr().out.split("\n\n")
    return sum(") Exchange" in b.strip().split("\n")[0] and "sku_name#" in b for b in blocks)


def test_paid_rows_stay_where_they_met_their_order(spark, tables, capsys):
    cdc, dic, _ = tables
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        details = detail.order_detail(cdc, dic.hint("broadcast"))
        paid = detail.pay_detail(details, cdc, dic.hint("broadcast"))
        assert wide_exchanges(details, capsys) == 2                          # by line, by order
        assert wide_exchanges(paid, capsys) == 3                             # and by line for the last payment
        assert wide_exchanges(paid.select("user_id", "t"), capsys) == 0      # nor is carried what nobody reads
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_keys_are_dealt_anew_where_rows_lie_by_their_key(spark):
    """Rows that already lie by the key of a per-key join do not stay there: the keys of the join are one value."""
    rows = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(300)] + [(None, 300)], "key string, n int")
    per = rows.where("key is not null").groupBy("key").agg(F.count("*").alias("c"), F.min("n").alias("v"))
    got = skew.join_per_key(rows.repartition("key"), per, "key", "c", "v", ["n"], hot_rows=50)
    want = {(i, (1 if i % 3 else i) if i < 300 else None) for i in range(301)}
    assert {(r.n, r.v) for r in got.collect()} == want and got.count() == 301
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.join_per_key(rows.repartition("key"), per, "key", "c", "v", ["n"], hot_rows=50)
        assert "_row_part" in [x for x in joined._jdf.queryExecution().executedPlan().toString().split("\n")
                               if "hashpartitioning(" in x and "_row_part" in x][0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("times", [1, 2])
def test_last_row_of_a_key(spark, times):
    """As the aggregate has it, also for null keys, null orders and repeated rows."""
    rows = [(1, 5, "a", "x"), (1, 7, "a", "y"), (1, 7, "b", "z"), (1, None, "c", "w"), (2, None, None, "u"), (2, None, "a", "v"), (None, 1, "a", "p"), (None, 2, None, "q")]
    df = spark.createDataFrame(rows * times, "id int, s long, tie string, rest string")
    want = routing.latest_per_key(df, ["id"], ["s", "tie"])
    assert sorted(routing.last_per_key(df, ["id"], ["s", "tie"]).collect(), key=str) == sorted(want.collect(), key=str)


def test_bounded_rows_meet_both_offers_where_they_lie(spark, tables, capsys):
    """Wide rows are shuffled for their order and once for their offers."""
    cdc, dic, _ = tables
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert wide_exchanges(detail.order_detail(cdc, dic.hint("broadcast"), detail.ORDER_TTL_S), capsys) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("ttl", [None, detail.ORDER_TTL_S])
def test_whole_rows_are_shuffled_as_one_text(spark, tables, capsys, ttl):
    cdc, dic, _ = tables
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        some = detail.order_detail(cdc, dic.hint("broadcast"), ttl)
        whole = detail.order_detail(cdc, dic.hint("broadcast"), ttl, whole=True)
        assert wide_exchanges(some, capsys) == 2 and wide_exchanges(whole, capsys) == 0
        assert whole.schema == some.schema
        assert sorted(whole.collect(), key=str) == sorted(some.collect(), key=str) != []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_packed_texts_come_back_as_they_were(spark):
    odd = [None, "", "a", "\x01", "\x02", "\x02n", "\x02a", "\x02b", "n", "\x01\x02", "\x02\x01b", "\\", "é日", "a\x00b", " "]
    rows = [(x, y, z) for x in odd for y in odd for z in (None, "", "z")]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    names = ["x", "y", "z"]
    again = df.select(values.packed(*names).alias("p")).repartition(3).select(*values.unpacked("p", *names))
    assert sorted(map(tuple, again.collect()), key=str) == sorted(rows, key=str)


def test_whole_rows_meet_order_and_offers_after_one_shuffle(spark, capsys):
    """Lines that come twice, share an id between orders or lack one, repeated offers and orders: all pairs as by a join each."""
    change = lambda table, ts, **data: ("shop", table, "insert", data, None, str(ts))
    line = lambda i, order, sku, ts: change("order_detail", ts, id=i, order_id=order, sku_id=sku, sku_name=f"s{sku}", create_time="2024-01-01 00:00:00",
                                            source_type="1", sku_num="2", order_price="1.50")
    rows = [line("a", "1", "x", 1), line("a", "1", "x", 1), line("a", "2", "y", 2), line("b", "1", "z", 3), line(None, "1", "n", 4), line("c", None, "m", 5),
            line("d", "9", "o", 6), line("e", "2", None, 7), line("f", "3", "p", 8),
            *[change("order_info", 1, id=i, user_id=f"u{i}", province_id="7") for i in ("1", "2", "2", "3", None)],
            *[change("order_detail_activity", 1, order_detail_id=i, activity_id=n, activity_rule_id="r")
              for i, n in (("a", "p"), ("a", "q"), ("a", "q"), ("e", "p"), (None, "p"), ("none", "p"))],
            *[change("order_detail_coupon", 1, order_detail_id=i, coupon_id=n) for i, n in (("a", "k"), ("b", "k"), ("b", "l"), (None, "k"))]]
    cdc = parse.with_cdc_times(spark.createDataFrame(rows, parse.CDC_SCHEMA)).drop("proc_time")
    dic = spark.createDataFrame([("1", "one")], "dic_code string, dic_name string").hint("broadcast")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    found = []
    try:
        for threshold in ("-1", "10MB"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            whole = detail.order_detail(cdc, dic, whole=True)
            found += [sorted(whole.collect(), key=str), sorted(detail.order_detail(cdc, dic).collect(), key=str)]
        assert all(x == found[0] for x in found) and len(found[0]) == 3 + 3 + 6 + 2 + 1 + 2 + 1
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        capsys.readouterr()
        whole.select("*").explain("formatted")
        blocks = capsys.readouterr().out.split("\n\n")
        for kind in ("Exchange", "Sort"):
            assert sum(f") {kind}" in b.strip().split("\n")[0] and ") SortMerge" not in b and "_rest#" in b for b in blocks) == 1, kind
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
