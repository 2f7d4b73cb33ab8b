"""Raw topics to clean topics: the log job and the rule-driven change job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import keyed, parse, routing


def log_topics(raw: DataFrame, text: str = "value", order: Sequence[str] = ("ts",)) -> DataFrame:
    """Rows ``topic, value`` of a batch of raw log: five log topics and the dirty text.

    Every record yields its topics' rows in one pass, with all the fields and types it came with.
    The first days of visitors are a second reading of the log.
    """
    marked = parse.mark_log(raw, text)
    return routing.fan_out(keyed.repair_log(marked, order), text)


def routed_facts(cdc: DataFrame, preload: DataFrame | None, changes: DataFrame | None) -> DataFrame:
    """Valid changes with the fact rules alive after all rule changes."""
    rules = routing.fold_rules(routing.rule_changes(preload, changes), "dwd")
    return routing.route_facts(parse.valid_changes(cdc), rules)


def routed_fact_lines(text: DataFrame, preload: DataFrame | None, changes: DataFrame | None,
                      column: str = "value") -> DataFrame:
    """``sink_table, value`` of raw changes: what :func:`routed_facts` writes, with every field and type."""
    rules = routing.fold_rules(routing.rule_changes(preload, changes), "dwd")
    return routing.route_fact_lines(parse.mark_changes(text, column), rules)


def routed_dims(cdc: DataFrame, preload: DataFrame | None, changes: DataFrame | None) -> DataFrame:
    """Valid changes of dimension tables, as rows for their dimension tables."""
    rules = routing.fold_rules(routing.rule_changes(preload, changes), "dim")
    return routing.route_dims(parse.valid_changes(cdc), rules)


def dim_rows(routed: DataFrame, columns: Sequence[str], order: Sequence[str],
             pk: str = "id") -> DataFrame:
    """Routed rows of one dimension as all-text columns, the last version per key."""
    rows = routed.select(*[F.col("data")[c].alias(c) for c in columns],
                         *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    last = routing.latest_per_key(rows, [pk], [f"_o{i}" for i in range(len(order))])
    return last.select(*columns)
