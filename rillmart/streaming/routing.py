"""Rule-driven routing of a change stream.

Two queries share a folder of rules. The one over config changes folds each of its micro-batches into a keyed table
(:func:`fold_changes`), whose parts are merged as they pile up: what was folded is not folded again, and how far the log is
folded is the last batch of its newest part. The other routes raw changes by the rules alive when its micro-batch starts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import parse, routing
from ..sources.flat import FlatGoods, keep_flat
from ..sources.sinks import upsert_dims
from ..sources.tiers import KeyedTable

SINK_TYPES = ("dwd", "dim")
PRELOADED = -1           # the run that preloaded rules are kept under; seq 0 makes them older than any change


def rule_snapshot(path: str) -> KeyedTable:
    """The last event of every rule key, folded so far."""
    return KeyedTable(path, routing.RULE_KEY, fold=routing.last_events)


def folded(changes: DataFrame) -> DataFrame:
    facts, dims = (routing.rule_events(changes, kind) for kind in SINK_TYPES)
    return routing.last_events(facts.unionByName(dims))


def preload_rules(path: str, rules: DataFrame) -> None:
    """Put a snapshot of the rule table below all changes; repeating it replaces it."""
    rule_snapshot(path).put(folded(routing.rule_changes(rules, None)), PRELOADED, 0)


def fold_changes(path: str, run: int = 0) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` over config changes (``before, after, op, seq, pos``): folds only the new ones."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rule_snapshot(path).put(folded(routing.rule_changes(None, batch)), run, batch_id)

    return write


def alive_rules(spark: SparkSession, path: str) -> DataFrame:
    """The rules that hold now, of facts and dimensions."""
    events = rule_snapshot(path).read(spark)
    if events is None:
        return spark.createDataFrame([], routing.RULE_SCHEMA)
    return routing.alive(events)


def route_batches(rules_path: str, facts_path: str, dims_path: str, run: int = 0,
                  text: str = "value", flat: FlatGoods | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` over raw change text: facts to topics, dimensions to keyed tables.

    Rules are read once per micro-batch and hold for all of it; they are kept beside its facts, so that a
    micro-batch that is repeated after a failure meets the rules of its first attempt. The text is parsed and
    joined once; the joined rows are kept while both sinks are written, and written records are those of
    :func:`rillmart.plans.ingest.routed_fact_lines`. Facts of a batch go to a directory of their own, which a repeat
    replaces. A new checkpoint takes a greater ``run``. With ``flat``, skus that a dimension row touches are flattened anew.
    """
    write_dims = keep_flat(flat, ["t", "ts"], run) if flat else upsert_dims(dims_path, ["t", "ts"], run)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        place = f"run={run}/batch={batch_id}"
        used = f"{rules_path}_used/{place}"
        alive_rules(spark, rules_path).coalesce(1).write.mode("ignore").parquet(used)
        rules = spark.read.schema(routing.RULE_SCHEMA).parquet(used)
        routed = routing.route_lines(parse.mark_changes(batch, text), rules).persist()
        try:
            facts = routed.where("sink_type = 'dwd'").select("sink_table", "value")
            facts.write.mode("overwrite").partitionBy("sink_table").text(f"{facts_path}/{place}")
            write_dims(routed.where("sink_type = 'dim'").select(
                "data", "sink_table", "sink_pk", "type", "t", "ts"), batch_id)
        finally:
            routed.unpersist()

    return write


def read_facts(spark: SparkSession, path: str, sink_table: str | None = None) -> DataFrame:
    """``sink_table, value`` of the records routed so far."""
    lines = spark.read.option("basePath", path).text(path)
    lines = lines if sink_table is None else lines.where(F.col("sink_table") == sink_table)
    return lines.select(F.col("sink_table").cast("string"), "value")
