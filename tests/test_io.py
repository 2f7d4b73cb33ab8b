"""Sources and sinks, on files."""

import json

from pyspark.sql import functions as F

from rillmart.operators import parse, routing
from rillmart.session import prepare
from rillmart.sources import dims, sinks, topics


def lines(*rows):
    return [(json.dumps(r) if r is not None else None,) for r in rows]


def change(table, kind, ts, **data):
    return {"database": "d", "table": table, "type": kind, "data": data, "ts": str(ts)}


def test_topic_and_cdc_landing(spark, tmp_path):
    src = spark.createDataFrame(lines(change("a", "insert", 1, id="1"), change("b", "insert", 2, id="2"), None), "value string")
    src.write.parquet(str(tmp_path / "t"))
    text = topics.read_topic(spark, str(tmp_path / "t"), fmt="parquet")
    assert text.where("value is null").count() == 1
    sinks.land_cdc(parse.valid_changes(topics.read_cdc(text)), str(tmp_path / "cdc"))
    back = parse.changes_of(spark.read.parquet(str(tmp_path / "cdc")), "b")
    assert [r.data["id"] for r in back.collect()] == ["2"]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(table" in plan  # only that table's directory is read


def test_detail_topic_keeps_every_version(spark):
    src = spark.createDataFrame(lines({"id": "1", "ts": "5"}, {"id": "1", "ts": "6"}, None), "value string")
    got = topics.read_detail(src, "id string, ts string")
    assert got.count() == 2 and got.where("t is null").count() == 0


def test_append_by_topic(spark, tmp_path):
    df = spark.createDataFrame([("x", "1"), ("y", "2")], "sink_table string, v string")
    sinks.append(df, str(tmp_path), by="sink_table")
    assert spark.read.json(str(tmp_path / "sink_table=y")).first().v == "2"


def test_upsert_is_idempotent_and_last_wins(spark, tmp_path):
    path = str(tmp_path / "u")
    put = sinks.upsert(path, ["id"], ["s"])
    schema = "id string, v string, s int, _deleted boolean"
    first = spark.createDataFrame([("1", "a", 1, False), ("1", "b", 2, False), ("2", "c", 1, False)], schema)
    put(first, 0)
    put(first, 0)
    put(spark.createDataFrame([("2", "d", 1, False), ("3", "e", 1, False), ("1", "b", 9, True)], schema), 1)

    def now(p):
        return sorted((r.id, r.v) for r in sinks.read_upserts(spark, p, ["id"]).collect())

    assert now(path) == [("2", "d"), ("3", "e")]
    restarted = sinks.upsert(path, ["id"], ["s"], run=1)      # a new checkpoint counts from 0 again
    restarted(spark.createDataFrame([("2", "new", 1, False)], schema), 0)
    assert now(path) == [("2", "new"), ("3", "e")]
    put(spark.createDataFrame([("2", "d", 1, False)], schema), 2)
    assert now(path) == [("2", "new"), ("3", "e")]
    restarted(spark.createDataFrame([("2", "d", 1, False)], schema), 1)
    sinks.compact(spark, path, str(tmp_path / "v"), ["id"], 1)
    assert now(str(tmp_path / "v")) == [("2", "d"), ("3", "e")]


def test_kafka_rows(spark):
    df = spark.createDataFrame([("1", "a", False), ("2", "b", True)], "id string, v string, _deleted boolean")
    got = {r.key: r.value for r in sinks.kafka_rows(df, "t", ["id"]).collect()}
    assert got == {'{"id":"1"}': '{"id":"1","v":"a"}', '{"id":"2"}': None}
    by_row = sinks.kafka_rows(df.drop("_deleted"), F.col("v")).collect()
    assert sorted(r.topic for r in by_row) == ["a", "b"]


def rule_change(i, op, before, after):
    row = [dict(zip(["source_table", "source_type", "sink_table", "sink_type", "sink_columns", "sink_pk"], x)) if x else None
           for x in (before, after)]
    return json.dumps({"before": row[0], "after": row[1], "op": op, "ts_ms": i})


def feed_text(spark, folder, texts, write, checkpoint, read=lambda s: s, mode="append"):
    """Land texts as one more file and run the query over what is new."""
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").text(str(folder))
    q = sinks.start_batches(read(topics.read_topic(spark, str(folder), stream=True)), write, str(checkpoint), mode, once=True)
    assert q.awaitTermination(120) and q.exception() is None
    return q


def test_routing_stream_writes_whole_records_in_one_pass(spark, tmp_path):
    """Facts and dimensions of a change stream, with rules that change between micro-batches, against the batch form."""
    from rillmart.plans import ingest
    from rillmart.streaming.routing import fold_changes, preload_rules, read_facts, route_batches

    rules_path, facts_path, dims_path = (str(tmp_path / n) for n in ("rules", "facts", "dims"))
    first = [("order", "insert", "dwd_order", "dwd", "id,a,deep", None, None), ("user", None, "dim_user", "dim", "id,name", "id", None)]
    preload = spark.createDataFrame(first, routing.RULE_SCHEMA)
    preload_rules(rules_path, preload)
    preload_rules(rules_path, preload)
    write = route_batches(rules_path, facts_path, dims_path)

    def order(i, **more):
        return ('{"database":"d","table":"order","type":"insert","ts":%d,"xid":9,"xoffset":%d,"commit":true,'
                '"data":{"id":%d,"a":1.50,"x":null,"deep":{"k":[1,2.0,"z"]}},"note":{"n":[1,null]}}' % (i, i, i))

    moved = ("order", "insert", "dwd_order_2", "dwd", "id,x")
    feeds = [
        [order(1), json.dumps(change("user", "insert", 1, id="u1", name="a")), json.dumps(change("order", "bootstrap-insert", 1, id="o0")),
         "{bad", order(1)[:-1], json.dumps(change("order", "insert", 1)).replace('{}', "5")],
        [order(2), json.dumps(change("user", "update", 2, id="u1", name="b")), json.dumps(change("user", "insert", 2, id="u2", name="c"))],
        [json.dumps(change("user", "delete", 3, id="u2", name="c")), order(3)]]
    want = []
    for i, texts in enumerate(feeds):
        if i == 1:
            feed_text(spark, tmp_path / "config", [rule_change(7, "u", ("order", "insert", "dwd_order", "dwd", "id"), moved)],
                      fold_changes(rules_path), tmp_path / "cc", topics.read_rule_changes)
        q = feed_text(spark, tmp_path / "in", texts, write, tmp_path / "check")
        assert q.recentProgress[-1]["numInputRows"] == len(texts)     # read and parsed once for both sinks
        changes = None if i == 0 else topics.read_rule_changes(
            spark.createDataFrame([(rule_change(7, "u", ("order", "insert", "dwd_order", "dwd", "id"), moved),)], "value string"))
        want += [tuple(r) for r in ingest.routed_fact_lines(
            spark.createDataFrame([(t,) for t in texts], "value string"), preload, changes).collect()]
    got = sorted(tuple(r) for r in read_facts(spark, facts_path).collect())
    assert got == sorted(want) and len(got) == 3
    said = json.loads(got[0][1])
    assert said == {**json.loads(order(1)), "data": {"id": 1, "a": 1.5, "deep": {"k": [1, 2, "z"]}}, "sink_table": "dwd_order"}
    now = sinks.read_dim(spark, dims_path, "dim_user", "id,name")
    assert sorted((r.id, r.name) for r in now.collect()) == [("u1", "b")]
    last = spark.createDataFrame([(t,) for t in feeds[0]], "value string")
    write(last, 0)                                                  # a repeat meets the rules of its first attempt
    assert sorted(tuple(r) for r in read_facts(spark, facts_path).collect()) == got


def test_rule_change_feed(spark):
    rec = {"before": None, "after": {"source_table": "shelf", "source_type": None, "sink_table": "dim_shelf",
                                     "sink_type": "dim", "sink_columns": "id,label,room", "sink_pk": "id",
                                     "sink_extend": None}, "op": "c", "ts_ms": 12}
    changes = topics.read_rule_changes(spark.createDataFrame(lines(rec), "value string"))
    alive = routing.fold_rules(routing.rule_changes(None, changes), "dim").collect()
    assert [(r.source_table, r.sink_columns) for r in alive] == [("shelf", "id,label,room")]


def test_rules_from_a_change_stream(spark, tmp_path):
    """Config changes arrive as a stream; each is folded once, whatever their order."""
    from rillmart.streaming.routing import alive_rules, fold_changes, preload_rules, rule_snapshot

    path = str(tmp_path / "rules")
    assert alive_rules(spark, path).count() == 0
    preload_rules(path, spark.createDataFrame([("a", "insert", "t1", "dwd", "id", None, None)], routing.RULE_SCHEMA))

    def feed(*texts):
        feed_text(spark, tmp_path / "in", texts, fold_changes(path), tmp_path / "c", topics.read_rule_changes)
        return sorted((r.source_table, r.sink_table) for r in alive_rules(spark, path).where("sink_type = 'dwd'").collect())

    old, new = ("a", "insert", "t1", "dwd", "id"), ("a", "insert", "t2", "dwd", "id")
    assert feed(rule_change(5, "u", old, new)) == [("a", "t2")]
    assert feed(rule_change(6, "c", None, ("b", "insert", "t3", "dwd", "id")), rule_change(7, "c", None, ("c", None, "d", "dim", "id"))) == [("a", "t2"), ("b", "t3")]
    assert feed(rule_change(9, "d", new, None)) == [("b", "t3")]
    assert feed(rule_change(8, "u", new, ("a", "insert", "t9", "dwd", "id"))) == [("b", "t3")]   # came late, ended since
    assert [r.sink_table for r in alive_rules(spark, path).where("sink_type = 'dim'").collect()] == ["d"]
    write = fold_changes(path)
    for i in range(100, 120):
        write(topics.read_rule_changes(spark.createDataFrame([(rule_change(i, "c", None, (f"n{i}", "insert", "t", "dwd", "id")),)], "value string")), i)
    assert alive_rules(spark, path).count() == 22 and len(rule_snapshot(path).parts(spark)) < 16


def test_a_keyed_table_of_many_batches_opens_few_folders(spark, tmp_path):
    """200 micro-batches, some repeated, with updates and deletions; as if every batch had been replayed."""
    from rillmart.sources.tiers import KeyedTable

    path, want = str(tmp_path / "k"), {}
    put = sinks.upsert(path, ["id"])
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for b in range(200):
            rows = [(f"k{b % 17}", f"v{b}", b % 5 == 4), (f"only{b}", "x", False)]
            df = spark.sql("select * from values " + ", ".join(f"('{k}', '{v}', {gone})" for k, v, gone in rows) + " as r(id, v, _deleted)")
            put(df, b)
            if b % 9 == 0:
                put(df, b)
            for k, v, gone in rows:
                want.pop(k, None) if gone else want.__setitem__(k, v)
        table = KeyedTable(path, ["id"])
        assert {r.id: r.v for r in sinks.read_upserts(spark, path, ["id"]).collect()} == want
        parts = table.parts(spark)
        assert len(parts) <= 3 * 8 and max(p.tier for p in parts) >= 2 and parts[0].first == 0 and parts[-1].batch == 199
        assert len(table._listed(spark)) < 60                       # merged parts are deleted in time
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_landed_changes_are_packed_and_not_sorted_by_table(spark, tmp_path):
    prepare(spark)
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 0
    rows = [(t, str(i)) for i in range(5) for t in ("a", "b", "c")]
    sinks.land_cdc(spark.createDataFrame(rows, "table string, ts string").coalesce(1), str(tmp_path / "cdc"))
    files = list((tmp_path / "cdc").glob("table=*/*.parquet"))
    assert len(files) == 3 and all(".zstd." in f.name for f in files)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "cdc")).select("table", "ts").collect())) == sorted(rows)
