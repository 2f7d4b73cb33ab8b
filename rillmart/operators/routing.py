"""Splitting one stream into many, by content or by rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clock import from_epoch_s
from ..functions.payload import VARIANTS, leaf, put_entry
from ..functions.values import listed_only
from .parse import once

RULE_SCHEMA = (
    "source_table string, source_type string, sink_table string, sink_type string, "
    "sink_columns string, sink_pk string, sink_extend string"
)
RULE_CHANGE_SCHEMA = f"before struct<{RULE_SCHEMA.replace(' string', ':string')}>, " \
    f"after struct<{RULE_SCHEMA.replace(' string', ':string')}>, op string, ts_ms bigint"

# The topics of the log job.
LOG_TOPICS = {
    "page": "dwd_traffic_page_log", "start": "dwd_traffic_start_log",
    "display": "dwd_traffic_display_log", "action": "dwd_traffic_action_log",
    "error": "dwd_traffic_error_log",
}
DIRTY_TOPIC = "dirty_data"

# --- log split -------------------------------------------------------------

def errors(log: DataFrame) -> DataFrame:
    """Records that carry an error, whole."""
    return log.where(F.col("err").isNotNull())


def starts(log: DataFrame) -> DataFrame:
    return log.where(F.col("start").isNotNull()).drop("err")


def displays(log: DataFrame) -> DataFrame:
    """One row per displayed item, with the record's common part, page and time."""
    return _pages_raw(log).select(
        F.explode("displays").alias("display"), "common", "page", "ts")


def actions(log: DataFrame) -> DataFrame:
    """One row per action; the output has no ``ts`` by contract."""
    return _pages_raw(log).select(F.explode("actions").alias("action"), "common", "page")


def pages(log: DataFrame) -> DataFrame:
    """Every record that is no start record, with or without a page part."""
    return _pages_raw(log).drop("displays", "actions", "start", "err")


def split_routes(log: DataFrame) -> dict[str, DataFrame]:
    """The five log topics of one parsed log."""
    return {"error": errors(log), "start": starts(log), "display": displays(log),
            "action": actions(log), "page": pages(log)}


def fan_out(log: DataFrame, raw: str = "value") -> DataFrame:
    """``topic, value`` rows of the five routes and of dirty text, in one pass.

    ``log`` is a marked log with its raw text. Records are written whole, with every field
    and type they came with; only a visitor flag that was repaired is set anew.
    """
    rec, common = F.col("rec"), F.col("rec")["common"]
    wrong = F.coalesce(F.col("is_new") != leaf(common, "$.is_new"), F.lit(False))
    repaired = F.to_variant_object(put_entry(common.try_cast(VARIANTS), "is_new", F.col("is_new").cast("variant")))
    whole = F.when(wrong, put_entry(rec, "common", repaired)).otherwise(rec)

    def line(topic: str, entries: Column) -> Column:
        return F.struct(F.lit(LOG_TOPICS[topic]).alias("topic"), F.to_json(entries).alias("value"))

    def without(*names: str) -> Column:
        return F.map_filter(F.col("_whole"), lambda k, v: ~k.isin(*names))

    def items(topic: str, column: str, *kept: str) -> Column:
        rest = F.map_filter(F.col("_whole"), lambda k, v: k.isin(*kept))
        made = F.transform(F.col("_whole")[column].try_cast("array<variant>"), lambda x: line(
            topic, F.map_concat(F.create_map(F.lit(topic), x), rest)))
        return F.when(F.col("_whole")["start"].isNull(), made)

    start = F.col("_whole")["start"].isNotNull()
    main = F.when(start, line("start", without("err"))).otherwise(line("page", without("displays", "actions", "err")))
    single = F.array(F.when(F.col("_whole")["err"].isNotNull(), line("error", F.col("_whole"))), main)
    none = F.array().cast("array<struct<topic:string,value:string>>")
    lines = F.concat(F.array_compact(single), F.coalesce(items("display", "displays", "common", "page", "ts"), none),
                     F.coalesce(items("action", "actions", "common", "page"), none))
    dirty = F.array(F.struct(F.lit(DIRTY_TOPIC).alias("topic"), F.col(raw).alias("value")))
    written = once(log.select("ok", raw, whole.alias("_w")), F.col("_w"), "_whole")
    return written.select(F.explode(F.when(F.col("ok"), lines).otherwise(dirty)).alias("_l")).select("_l.*")


def _pages_raw(log: DataFrame) -> DataFrame:
    return log.where(F.col("start").isNull())


# --- rules -----------------------------------------------------------------

def rule_changes(preload: DataFrame | None, changes: DataFrame | None) -> DataFrame:
    """One ordered change list: preloaded rules first, then streamed changes.

    ``changes`` needs ``before, after, op`` and an order column ``seq`` >= 1. Changes of equal ``seq`` follow
    ``pos``, their position in the log, if there is such a column.
    """
    parts = []
    if preload is not None:
        rule = F.struct(*[F.col(c) for c in _rule_columns()])
        parts.append(preload.select(
            F.lit(None).cast(_rule_type()).alias("before"), rule.alias("after"),
            F.lit("r").alias("op"), F.lit(0).cast("bigint").alias("seq"), F.lit(0).cast("bigint").alias("pos")))
    if changes is not None:
        parts.append(changes.select(
            F.col("before").cast(_rule_type()).alias("before"),
            F.col("after").cast(_rule_type()).alias("after"),
            "op", F.col("seq").cast("bigint").alias("seq"),
            (F.col("pos") if "pos" in changes.columns else F.lit(0)).cast("bigint").alias("pos")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def rule_events(changes: DataFrame, sink_type: str) -> DataFrame:
    """What each change does to the rules of fact (``dwd``) or dimension (``dim``) sinks.

    ``sink_type, source_table, source_type`` is the rule's key (no ``source_type`` for dimensions), ``rule`` what it is
    from then on, null when it ends. A deletion ends the rule under its old key. An update that changes the key or the
    sink type ends the old one as well and opens the new one.
    """
    def at(side: str, step: int, rule: Column) -> list[Column]:
        kind = F.col(f"{side}.source_type") if sink_type == "dwd" else F.lit(None).cast("string")
        return [F.lit(sink_type).alias("sink_type"), F.col(f"{side}.source_table").alias("source_table"),
                kind.alias("source_type"), "seq", "pos", F.lit(step).alias("step"), rule.alias("rule")]

    ends = changes.where(F.col("before").isNotNull() & (F.col("before.sink_type") == sink_type)).select(
        *at("before", 0, F.lit(None).cast(_rule_type())))
    opens = changes.where((F.col("op") != "d") & (F.col("after.sink_type") == sink_type)).select(
        *at("after", 1, F.col("after")))
    return ends.unionByName(opens)


RULE_KEY = ["sink_type", "source_table", "source_type"]


def last_events(events: DataFrame) -> DataFrame:
    """The last event of each rule; within one change the opening (step 1) outranks the ending (step 0).

    Endings stay, so that events that come later but were earlier do not bring a rule back. The fold may be taken in any
    order and in parts: folding what was folded before with new events gives the same.
    """
    last = events.groupBy(*RULE_KEY).agg(
        F.max_by(F.struct("seq", "pos", "step", "rule"), F.struct("seq", "pos", "step")).alias("last"))
    return last.select(*RULE_KEY, "last.*")


def alive(events: DataFrame) -> DataFrame:
    """The rules that hold after folded events."""
    return events.where(F.col("rule").isNotNull()).select("rule.*")


def fold_rules(changes: DataFrame, sink_type: str) -> DataFrame:
    """Rules alive after all changes, for fact (``dwd``) or dimension (``dim``) sinks.

    The last change of a key wins; the fold is one aggregate per key, combined on the map side.
    """
    return alive(last_events(rule_events(changes, sink_type)))


def route_facts(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Match table and type to a rule; keep the envelope, its listed columns, the target.

    Unmatched changes are dropped. Rules are few, but nothing depends on it: Spark
    broadcasts them when their measured size is below its threshold.
    """
    r = rules.select(
        F.col("source_table").alias("_st"), F.col("source_type").alias("_sty"),
        "sink_table", F.col("sink_columns").alias("_cols"))
    joined = changes.join(r, (F.col("table") == F.col("_st")) & (F.col("type") == F.col("_sty")))
    return joined.withColumn("data", listed_only("data", "_cols")).drop("_st", "_sty", "_cols")


def route_fact_lines(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """``sink_table, value``: :func:`route_facts` on whole records, written as they came.

    ``changes`` comes from :func:`rillmart.operators.parse.mark_changes`. The envelope keeps all its fields
    and types; only ``data`` is cut to the listed columns, and ``sink_table`` is added.
    """
    return route_lines(changes, rules.where("sink_type = 'dwd'")).select("sink_table", "value")


def route_lines(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per change and rule it meets, fact and dimension rules in one join.

    ``changes`` comes from :func:`rillmart.operators.parse.mark_changes`. ``sink_type`` tells what the row is for: facts
    match table and type and have ``value``, the whole record as text with ``data`` cut to the listed columns and
    ``sink_table`` added; dimensions match the table and have ``data`` as a map of text, ``sink_pk``, ``type``, ``ts`` and ``t``.
    """
    r = rules.select(
        F.col("source_table").alias("_st"), F.col("source_type").alias("_sty"), "sink_table", "sink_type",
        F.col("sink_columns").alias("_cols"), F.coalesce(F.col("sink_pk"), F.lit("id")).alias("sink_pk"))
    fact = F.col("sink_type") == "dwd"
    joined = changes.join(r, (F.col("table") == F.col("_st")) & (~fact | (F.col("type") == F.col("_sty"))))
    listed = listed_only(F.col("rec")["data"].try_cast(VARIANTS), "_cols")
    named = put_entry(put_entry("rec", "data", F.to_variant_object(listed)), "sink_table", F.col("sink_table").cast("variant"))
    ts = leaf(F.col("rec")["ts"], "$", "string")
    return joined.select(
        "sink_type", "sink_table", F.when(fact, F.to_json(named)).alias("value"), "type", "sink_pk",
        F.when(~fact, F.transform_values(listed, lambda k, v: leaf(v, "$"))).alias("data"), ts.alias("ts"),
        from_epoch_s(ts).alias("t"))


def route_dims(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Match the table alone; emit listed data, target, key column and change type."""
    r = rules.select(
        F.col("source_table").alias("_st"), "sink_table",
        F.col("sink_columns").alias("_cols"),
        F.coalesce(F.col("sink_pk"), F.lit("id")).alias("sink_pk"))
    keep: Sequence[str] = [c for c in ("t", "ts", "seq") if c in changes.columns]
    return changes.join(r, F.col("table") == F.col("_st")).select(
        listed_only("data", "_cols").alias("data"), "sink_table", "sink_pk", "type", *keep)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last version of each key; one aggregate, combined on the map side."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return last.select(*keys, "_last.*").select(*df.columns)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """As :func:`latest_per_key` for wide rows of few versions: columns that nobody reads are not shuffled, nor is the order twice.

    A task passes on one row per key.
    """
    last_first = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_n", F.row_number().over(last_first)).where(F.col("_n") == 1).drop("_n")


def _rule_columns() -> list[str]:
    return [part.split()[0] for part in RULE_SCHEMA.split(", ")]


def _rule_type() -> str:
    return "struct<" + RULE_SCHEMA.replace(" string", ":string") + ">"
