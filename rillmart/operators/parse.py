"""From raw text to log records and change records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clock, values
from ..functions.payload import VARIANTS, is_object, leaf, record

# Leaves read out of a log record are text: numbers keep their digits and a leaf of the
# wrong type does not spoil the record. The record itself is kept whole.
COMMON_LEAVES = ("mid", "uid", "vc", "ch", "ar", "is_new")
PAGE_LEAVES = ("page_id", "last_page_id", "item", "item_type", "during_time")
LOG_MAP_SCHEMA = "common map<string,string>, page map<string,string>, ts bigint"
CDC_SCHEMA = (
    "database string, `table` string, type string, data map<string,string>, "
    "old map<string,string>, ts string"
)
# Change types that only frame a snapshot.
BOOTSTRAP_TYPES = ("bootstrap-start", "bootstrap-complete", "bootstrap-insert")


def once(df: DataFrame, value: Column, out: str) -> DataFrame:
    """Add a costly column so that it is computed once per row.

    A plain column would be inlined into every filter and projection that uses it;
    the row generator in between keeps the optimizer from copying it.
    """
    return df.select("*", F.explode(F.array(value)).alias(out))


def split_objects(df: DataFrame, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """(rows whose text is one JSON object, all other rows)."""
    marked = once(df, is_object(text), "_ok")
    return marked.where("_ok").drop("_ok"), marked.where("not _ok").drop("_ok")


def mark_log(df: DataFrame, text: str = "value") -> DataFrame:
    """Parse log text once: the whole record ``rec``, its ``mid, is_new, ts``, event time ``t``, and ``ok``.

    ``ok`` is false for text that is no JSON object or has no visitor or time.
    """
    parsed = once(df, record(text), "rec")
    out = parsed.select(
        *df.columns, "rec", leaf(F.col("rec")["common"], "$.mid").alias("mid"),
        leaf(F.col("rec")["common"], "$.is_new").alias("is_new"),
        leaf(F.col("rec")["ts"], "$", "bigint").alias("ts"))
    ok = F.col("rec").isNotNull() & F.col("mid").isNotNull() & F.col("ts").isNotNull()
    return out.select("*", clock.from_epoch_ms("ts").alias("t"), ok.alias("ok"))


def split_log(df: DataFrame, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """(parsed log records, dirty text)."""
    marked = mark_log(df, text)
    return typed_log(marked.where("ok")).drop("ok", text), marked.where("not ok").select(text)


def typed_log(marked: DataFrame) -> DataFrame:
    """The fields that readers of the log use as columns; bodies that nobody looks into as JSON text."""
    rec = F.col("rec")

    def bodies(name: str) -> Column:
        return F.transform(rec[name].try_cast("array<variant>"), lambda x: F.to_json(x)).alias(name)

    return marked.select(
        *[c for c in marked.columns if c not in ("rec", "mid", "is_new", "ts", "t", "ok")],
        *(F.struct(*(leaf(rec[part], f"$.{n}").alias(n) for n in names)).alias(part)
          for part, names in (("common", COMMON_LEAVES), ("page", PAGE_LEAVES))),
        F.to_json(rec["start"]).alias("start"), F.to_json(rec["err"]).alias("err"),
        bodies("displays"), bodies("actions"), "ts", "t", "ok")


def parse_log_maps(df: DataFrame, text: str = "value") -> DataFrame:
    """Log records as maps of ``common`` and ``page`` with event time in whole seconds."""
    rec = F.from_json(text, LOG_MAP_SCHEMA)
    return once(df, rec, "_rec").select(
        *[c for c in df.columns if c != text], "_rec.common", "_rec.page", "_rec.ts",
        clock.from_epoch_ms_whole_s("_rec.ts").alias("t"))


def parse_cdc(df: DataFrame, text: str = "value") -> DataFrame:
    """Change records: envelope columns, ``t`` from epoch seconds, ``proc_time``."""
    rec = F.from_json(text, CDC_SCHEMA)
    parsed = once(df, rec, "_rec")
    return with_cdc_times(parsed.select(*[c for c in df.columns if c != text], "_rec.*"))


def may_name(text: Column | str, *words: str) -> Column:
    """False only for JSON text in which no string is one of ``words``: it has none of them in quotes, and no escapes.

    Cheap to tell before text is parsed. Null for null text.
    """
    c = F.col(text) if isinstance(text, str) else text
    found = c.contains("\\")
    for word in words:
        found = found | c.contains(f'"{word}"') | c.contains(f"'{word}'")
    return found


def with_cdc_times(df: DataFrame) -> DataFrame:
    return df.withColumn("t", clock.from_epoch_s("ts")).withColumn(
        "proc_time", F.current_timestamp())


def mark_changes(df: DataFrame, text: str = "value") -> DataFrame:
    """Whole change records ``rec`` with ``table, type``: valid ones only, see :func:`valid_changes`."""
    parsed = once(df, record(text), "rec").select(
        "rec", leaf(F.col("rec")["table"], "$").alias("table"), leaf(F.col("rec")["type"], "$").alias("type"))
    has_data = F.col("rec")["data"].try_cast(VARIANTS).isNotNull()
    return parsed.where(has_data & ~F.col("type").isin(*BOOTSTRAP_TYPES))


def valid_changes(df: DataFrame) -> DataFrame:
    """Changes with a data object and a type that is not part of a bootstrap."""
    return df.where(F.col("data").isNotNull() & ~F.col("type").isin(*BOOTSTRAP_TYPES))


def changes_of(df: DataFrame, table: str, kind: str | None = None) -> DataFrame:
    """Changes of one source table, of one type or of any."""
    chosen = df.where(F.col("table") == table)
    return chosen if kind is None else chosen.where(F.col("type") == kind)


def moved_to(column: str, code: str) -> Column:
    """An update that changed ``column`` to ``code``; ``old`` has changed columns only."""
    return (
        (F.col("type") == "update")
        & F.col("old")[column].isNotNull()
        & (F.col("data")[column] == code)
    )


def grew(column: str) -> Column:
    """An insert, or an update that raised a whole-number column."""
    new, old = values.whole(F.col("data")[column]), values.whole(F.col("old")[column])
    return (F.col("type") == "insert") | (
        (F.col("type") == "update") & F.col("old")[column].isNotNull() & (new > old))


def growth_text(column: str) -> Column:
    """The inserted value, or what an update added, as text."""
    new, old = values.whole(F.col("data")[column]), values.whole(F.col("old")[column])
    return F.when(F.col("type") == "insert", F.col("data")[column]).otherwise(
        (new - old).cast("string"))


def fields(*names: str, **renamed: str) -> list[Column]:
    """``data`` map entries as columns; keywords rename, ``out=source``."""
    return [F.col("data")[n].alias(n) for n in names] + [
        F.col("data")[src].alias(out) for out, src in renamed.items()]


def is_home_or_detail() -> Column:
    return F.col("page.page_id").isin("home", "good_detail")


def is_login() -> Column:
    """First page of a visit, or the page after the login page, of a known user."""
    return F.col("common.uid").isNotNull() & (
        F.col("page.last_page_id").isNull() | (F.col("page.last_page_id") == "login"))


def is_keyword_search() -> Column:
    return (
        F.col("page.item").isNotNull()
        & (F.col("page.last_page_id") == "search")
        & (F.col("page.item_type") == "keyword")
    )


def complete_orders(df: DataFrame, *required: str) -> DataFrame:
    """Detail rows with a user and a source type name (tombstones have neither)."""
    for name in required or ("user_id", "source_type_name"):
        df = df.where(F.col(name).isNotNull())
    return df


def not_tombstone(df: DataFrame, text: str = "value") -> DataFrame:
    return df.where(F.col(text).isNotNull())
