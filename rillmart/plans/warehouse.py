"""The jobs from topic to sink, in one table: what each reads, computes, and writes under which keys.

A :class:`Warehouse` is a folder. ``raw/topic_log`` and ``raw/topic_db`` are landed text, ``raw/rules`` and ``raw/rule_changes``
the routing configuration, ``dim/<name>`` dictionary and dimensions as Parquet. ``JOBS`` is in an order in which every job
comes after those that it reads. A job writes one of

- ``text``: ready messages, a folder for each topic;
- ``topic``: rows as JSON, packed by gzip, every version kept;
- ``keyed``: the last row of each key (:mod:`..sources.tiers`);
- ``summary``: window rows with their emit time, each batch added once (:mod:`..sources.once`).

:func:`run` computes a job from all that has landed and writes it as one batch. Repeating a batch changes nothing for
``summary`` and replaces the batch's own rows elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators import parse
from ..operators.routing import LOG_TOPICS, latest_per_key
from ..operators.windows import stamped
from ..sources import dims, sinks, topics
from ..sources.once import add_once, read_once
from . import detail, ingest, summary

DIMENSIONS = ("sku", "spu", "trademark", "category3", "category2", "category1", "province")
WINDOW = ["stt", "edt"]


@dataclass(frozen=True)
class Warehouse:
    """Named inputs and outputs of jobs below ``root``; ``width`` is that of all windows."""
    spark: SparkSession
    root: str
    words: Sequence[str] | None = None
    width: str = summary.WIDTH

    def place(self, name: str) -> str:
        return f"{self.root}/{name}"

    def log_text(self) -> DataFrame:
        return topics.read_topic(self.spark, self.place("raw/topic_log"), fmt="parquet")

    def change_text(self) -> DataFrame:
        return topics.read_topic(self.spark, self.place("raw/topic_db"), fmt="parquet")

    def changes(self, *tables: str) -> DataFrame:
        """Valid changes, or those of some source tables. Each of these parses only text that may be its own, and a reader of
        one passes over the others."""
        text = self.change_text()
        if not tables:
            return parse.valid_changes(topics.read_cdc(text))
        parts = [parse.changes_of(parse.valid_changes(topics.read_cdc(text.where(parse.may_name("value", t)))), t).withColumn("table", F.lit(t))
                 for t in tables]
        return reduce(DataFrame.unionByName, parts)

    def rules(self) -> DataFrame:
        return dims.read_table(self.spark, self.place("raw/rules"))

    def rule_changes(self) -> DataFrame:
        return topics.read_rule_changes(topics.read_topic(
            self.spark, self.place("raw/rule_changes"), "value string, pos bigint", "parquet"), position="pos")

    def dictionary(self) -> DataFrame:
        return dims.read_dictionary(self.spark, self.place("dim/base_dic"))

    def dimensions(self) -> dict[str, DataFrame]:
        return {n: dims.read_table(self.spark, self.place(f"dim/{n}")) for n in DIMENSIONS}

    def pages(self) -> DataFrame:
        """The page log, out of the log job's topic."""
        good, _ = parse.split_log(self.messages("log", LOG_TOPICS["page"]).select("value"))
        return good

    def messages(self, name: str, topic: str | None = None) -> DataFrame:
        """``topic, value`` of a ``text`` job; one topic is one folder of each batch."""
        rows = self.spark.read.schema("value string, batch bigint, topic string").text(self.place(name)).select("topic", "value")
        return rows if topic is None else rows.where(F.col("topic") == topic)

    def registered(self) -> DataFrame:
        """Rows that the routing job sent to the register topic, whole records with ``ts`` in seconds."""
        return topics.read_detail(self.messages("routed_facts", "dwd_user_register").select("value"), "ts string")

    def rows(self, name: str) -> DataFrame:
        """What a ``topic``, ``keyed`` or ``summary`` job has written, without its emit time."""
        job = JOBS[name]
        if job.sink == "topic":
            text = StructType([StructField(c, StringType()) for c in job.columns])
            return topics.read_detail(topics.read_topic(self.spark, self.place(name)), text.simpleString()[7:-1].replace(":", " "))
        if job.sink == "keyed":
            return sinks.read_upserts(self.spark, self.place(name), job.keys)
        return read_once(self.spark, self.place(name), job.made(self).schema, job.keys)


@dataclass(frozen=True)
class Job:
    """``made`` computes the job's rows; ``keys`` are those of its sink, ``columns`` those of a topic."""
    reads: tuple[str, ...]
    made: Callable[[Warehouse], DataFrame]
    sink: str
    keys: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()


ORDER_TABLES = ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon")


def _topic(f: Callable[[DataFrame, DataFrame], DataFrame], columns: Sequence[str], *tables: str) -> Job:
    return Job(("raw/topic_db",), lambda w: f(w.changes(*tables), w.dictionary()), "topic", columns=tuple(columns))


def _keyed(f: Callable[[DataFrame, DataFrame], DataFrame], *tables: str) -> Job:
    return Job(("raw/topic_db",), lambda w: f(w.changes(*tables), w.dictionary()), "keyed", ("id",))


def _summary(reads: str, f: Callable[[Warehouse], DataFrame], *keys: str) -> Job:
    return Job((reads,), f, "summary", (*WINDOW, *keys))


def last_versions(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The latest row of each key; rows of one time are ordered by their other columns, so that reruns agree."""
    return latest_per_key(rows, list(keys), ["t", *(c for c in rows.columns if c not in ("t", *keys))])


def _paid(w: Warehouse) -> DataFrame:
    return detail.pay_detail(w.rows("order_detail"), w.changes("payment_info"), w.dictionary(), tie=["sku_id", "source_id", "split_payment_amount", "sku_num"])


JOBS: dict[str, Job] = {
    "log": Job(("raw/topic_log",), lambda w: ingest.log_topics(w.log_text()), "text"),
    "routed_facts": Job(("raw/topic_db", "raw/rules", "raw/rule_changes"), lambda w: ingest.routed_fact_lines(
        w.change_text(), w.rules(), w.rule_changes()).withColumnRenamed("sink_table", "topic"), "text"),
    "routed_dims": Job(("raw/topic_db", "raw/rules", "raw/rule_changes"), lambda w: ingest.routed_dims(
        w.changes(), w.rules(), w.rule_changes()), "dims"),
    "cart_add": _topic(detail.cart_add, detail.CART_COLUMNS, "cart_info"),
    "order_detail": _keyed(detail.order_detail, *ORDER_TABLES),
    "cancel_detail": _keyed(detail.cancel_detail, *ORDER_TABLES),
    "pay_detail": Job(("order_detail", "raw/topic_db"), _paid, "keyed", ("order_detail_id",)),
    "order_refund": _topic(detail.order_refund, detail.REFUND_COLUMNS, "order_refund_info", "order_info"),
    "refund_pay": _topic(detail.refund_pay, detail.REFUND_PAY_COLUMNS, "refund_payment", "order_info", "order_refund_info"),
    "keyword_page_view": _summary("log", lambda w: summary.keyword_page_view(w.pages(), w.words, w.width), "keyword"),
    "channel_page_view": _summary("log", lambda w: summary.channel_page_view(w.pages(), w.width), *summary.CHANNEL),
    "page_view": _summary("log", lambda w: summary.page_view(w.pages(), w.width)),
    "user_login": _summary("log", lambda w: summary.user_login(w.pages(), w.width)),
    "user_register": _summary("routed_facts", lambda w: summary.user_register(w.registered(), w.width)),
    "cart_add_users": _summary("cart_add", lambda w: summary.cart_add_users(w.rows("cart_add"), w.width)),
    "order_users": _summary("order_detail", lambda w: summary.order_users(w.rows("order_detail"), w.width)),
    "payment_users": _summary("pay_detail", lambda w: summary.payment_users(w.rows("pay_detail"), w.width)),
    "province_orders": _summary("order_detail", lambda w: summary.province_orders(
        w.rows("order_detail"), w.dimensions()["province"], ["t", "ts"], w.width), "province_id"),
    "sku_orders": _summary("order_detail", lambda w: summary.sku_orders(
        w.rows("order_detail"), w.dimensions(), ["t", "ts"], w.width), "sku_id"),
    "refund_users": _summary("order_refund", lambda w: summary.refund_users(
        w.rows("order_refund"), w.dimensions(), w.width), "trademark_id", "category3_id", "user_id"),
}


def run(warehouse: Warehouse, name: str, batch: int = 0) -> None:
    """Compute one job and write it as batch ``batch``; later batches have greater numbers."""
    job, path = JOBS[name], warehouse.place(name)
    rows = job.made(warehouse)
    if job.sink == "text":
        rows.select("topic", "value").write.mode("overwrite").partitionBy("topic").text(f"{path}/batch={batch}")
    elif job.sink == "topic":
        rows.select(*job.columns).write.mode("overwrite").option("compression", "gzip").json(f"{path}/batch={batch}")
    elif job.sink == "keyed":
        sinks.upsert(path, list(job.keys))(last_versions(rows, job.keys), batch)
    elif job.sink == "dims":
        sinks.upsert_dims(path, ["t", "ts"])(rows, batch)
    else:
        add_once(path)(stamped(rows), batch)


def needed(name: str) -> list[str]:
    """The jobs that ``name`` reads from, directly or not, and itself, in order."""
    wanted = {name}
    for other in reversed(JOBS):
        if other in wanted:
            wanted |= {r for r in JOBS[other].reads if r in JOBS}
    return [n for n in JOBS if n in wanted]


def run_all(warehouse: Warehouse, *names: str, batch: int = 0) -> None:
    """Run the named jobs, or all, after those that they read from."""
    wanted = {n for name in names or JOBS for n in needed(name)}
    for name in JOBS:
        if name in wanted:
            run(warehouse, name, batch)
