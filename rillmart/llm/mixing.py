"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

1. Targets: sources in code point order (null last) weigh ``weights`` in turn and share the words of
   all documents; a target stops at ``most`` times its source's words and the excess is shared anew.
2. Inclusion: a document of weight class c is wanted ``a = min(most, rate * c)`` times, where its
   source's rate makes the wanted words equal the target. ``floor(a)`` copies are certain.
3. Pareto order sampling of the rest: with u uniform and f = a - floor(a), documents rank by
   ``(u / (1 - u)) / (f / (1 - f))``; they get one more copy in that order until the words still
   missing are filled, to the nearest document. The sample's size in words is so fixed.

A source may hold most rows: documents are never ordered by source. Sizes are summed over rank
bins, in number from the source's documents and at most ``BINS``, which names the bin where the target is met; bins below are taken whole,
and only the rows of that one bin are ordered. Joins to per-source figures are salted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .frames import checkpointed

BINS = 65536             # at most, of a source; one for PER_BIN documents below that
PER_BIN = 256
SALTS = 16
WORD = r"[^\x20\x09-\x0D]+"
KEY = ["no_source", "source_key"]


def bit_class(size: Column) -> Column:
    """1 for 0 or 1 words, one more for each doubling: longer documents are wanted more often."""
    return F.length(F.bin(size))


def ranked_sources(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """``weight`` by the rank of each source in code point order.

    Ranks come from a range-partitioned sort: place in the partition plus the rows of those
    before it. No task sees all sources, only a row for each partition.
    """
    placed = checkpointed(sources.orderBy(*KEY).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")))
    counts = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights)).cast("int") + 1)
    return placed.join(before, "part").select(*KEY, "source_size", "bins", weight.alias("weight"))


def source_targets(sources: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``sources`` with ``target``: the share by weight, capped at ``most`` times the size.

    Each round is one aggregate over the sources: those whose cap lies below their share keep
    the cap, the rest share what is left. Rounds end when no further cap is reached.
    """
    ranked = checkpointed(ranked_sources(sources, weights), few=True)
    cap, weight = F.col("source_size") * most, F.col("weight")
    total = ranked.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w")).first()
    if total.t is None:
        return ranked.withColumn("target", F.lit(0.0))
    rate, capped = total.t / total.w, -1
    while True:
        over = cap < F.lit(rate) * weight
        row = ranked.agg(F.count_if(over).alias("n"), F.coalesce(F.sum(F.when(over, cap)), F.lit(0)).alias("words"),
                         F.coalesce(F.sum(F.when(~over, weight)), F.lit(0)).alias("w")).first()
        if row.n == capped or not row.w:
            break
        capped, rate = row.n, (total.t - row.words) / row.w
    return ranked.withColumn("target", F.least(cap.cast("double"), F.lit(rate) * weight))


def class_rates(sized: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """For each source and weight class: certain copies, and the chance of one more.

    The classes from the highest that reach ``most`` form a prefix; the shortest prefix that
    leaves no other class above it gives the source's rate. A source has at most 64 classes.
    """
    down = Window.partitionBy(*KEY).orderBy(F.col("class").desc())
    words, next_class = F.col("class_size"), F.lead("class").over(down)
    classes = sized.groupBy(*KEY, "class").agg(F.sum("size").alias("class_size")).join(targets, KEY)
    upto = classes.select(
        "*", F.sum(words).over(down).alias("head"), next_class.alias("next_class"),
        (F.sum(words * F.col("class")).over(Window.partitionBy(*KEY))
         - F.sum(words * F.col("class")).over(down)).alias("tail"),
        F.sum(words * F.col("class")).over(Window.partitionBy(*KEY)).alias("all"),
        F.first("class").over(down).alias("top"))
    none_capped = F.col("target") / F.col("all")
    after_head = (F.col("target") - most * F.col("head")) / F.col("tail")
    rate = (F.when(F.col("all") == 0, 0.0)
            .when(none_capped * F.col("top") <= most, none_capped)
            .otherwise(F.min(F.when((F.col("tail") > 0) & (after_head * F.col("next_class") <= most), F.struct(
                F.col("class") * -1, after_head.alias("r")))).over(Window.partitionBy(*KEY)).getField("r")))
    wanted = F.least(F.lit(float(most)), F.coalesce(rate, F.lit(float(most))) * F.col("class"))
    return (upto.withColumn("wanted", wanted)
            .select(*KEY, "class", "source_size", "bins", "target", F.floor("wanted").alias("certain"),
                    (F.col("wanted") - F.floor("wanted")).alias("f")))


def row_sign(seed: str) -> Column:
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text)))


def salted(rows: DataFrame, figures: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined to per-source ``figures``, a source's rows being dealt over ``SALTS`` keys."""
    copies = figures.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(copies, [*on, "salt"], how)


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: str = "mix",
                weight_class=bit_class, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, sign, size, source_size, target, copies, taken, and ``keep``) of every row.

    ``sign`` tells rows of different doc_id or text apart; ``size`` counts words; ``taken`` is copies * size. ``weight_class`` maps the size to a
    whole number from 1 to 64, the document's weight within its source. The uniform number of a row
    comes from an MD5 of seed, doc_id and text, so reruns agree; equal rows get equal numbers and
    are ranked in any order, which cannot be told apart.

    Null text: size 0. Null source: a source of its own. Null doc_id: a row like others.
    Empty table: empty result. Other columns are read only if named in ``keep``.
    """
    text, sign = F.coalesce(F.col("text"), F.lit("")), row_sign(seed)
    sized = checkpointed(docs.select(
        F.struct("doc_id", "source", *keep).alias("row"), F.col("source").isNull().alias("no_source"),
        F.coalesce("source", F.lit("")).alias("source_key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), sign.alias("sign")).withColumn(
            "class", weight_class(F.col("size"))).withColumn(
            "salt", F.conv(F.substring("sign", 13, 4), 16, 10).cast("int") % SALTS))
    bins = F.least(F.lit(BINS), F.ceil(F.count("*") / PER_BIN))
    sources = sized.groupBy(*KEY).agg(F.sum("size").alias("source_size"), bins.alias("bins"))
    rates = checkpointed(class_rates(sized, source_targets(sources, weights, most), most), few=True)
    u = (F.conv(F.substring("sign", 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    f = F.col("f")
    ranked = salted(sized, rates, [*KEY, "class"]).withColumn(
        "q", F.when(f > 0, (u * (1 - f)) / ((1 - u) * f))).withColumn(
        "bin", F.when(F.col("q").isNotNull(), F.least(F.floor(F.col("q") / (1 + F.col("q")) * F.col("bins")), F.col("bins") - 1)))
    sums = ranked.groupBy(*KEY, "bin").agg(
        F.coalesce(F.sum(F.when(F.col("q").isNotNull(), F.col("size"))), F.lit(0)).alias("words"),
        F.sum(F.col("certain") * F.col("size")).alias("certain_words"), F.first("target").alias("target"))
    up = Window.partitionBy(*KEY).orderBy(F.col("bin").asc_nulls_first())
    missing = F.col("target") - F.sum("certain_words").over(Window.partitionBy(*KEY))
    cuts = sums.select(*KEY, "bin", (F.sum("words").over(up) - F.col("words")).alias("before"), "words",
                       missing.alias("missing")).groupBy(*KEY).agg(
        F.max(F.when(F.col("before") <= F.col("missing"), F.col("bin"))).alias("cut"),
        F.max_by("before", F.when(F.col("before") <= F.col("missing"), F.col("bin"))).alias("before"),
        F.first("missing").alias("missing"))
    cut = salted(ranked, cuts, KEY)
    outside = cut.filter(~F.coalesce(F.col("bin") == F.col("cut"), F.lit(False))).withColumn(
        "extra", F.coalesce((F.col("bin") < F.col("cut")).cast("int"), F.lit(0)))
    order = Window.partitionBy(*KEY).orderBy("q", "sign").rowsBetween(Window.unboundedPreceding, 0)
    inside = cut.filter(F.col("bin") == F.col("cut")).withColumn(
        "upto", F.sum("size").over(order)).withColumn(
        "extra", (2 * (F.col("before") + F.col("upto")) - F.col("size") <= 2 * F.col("missing")).cast("int")).drop("upto")
    return outside.unionByName(inside).select(
        "row.*", "sign", "size", "source_size", "target", (F.col("certain") + F.col("extra")).alias("copies"),
        ((F.col("certain") + F.col("extra")) * F.col("size")).alias("taken"))


def take_mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: str = "mix") -> DataFrame:
    """The mix itself: every row of ``docs``, with all its columns, whatever their names, as many times as it is taken.

    Rows of equal doc_id and text share their copies: together they come as often as they were taken.
    """
    signed = docs.select(row_sign(seed).alias("sign"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole"))
    once = mix_sources(docs, weights, most, seed).filter(F.col("copies") > 0).groupBy("sign").agg(F.sum("copies").alias("copies"))
    return signed.join(once, "sign").dropDuplicates(["sign"]).select(
        "whole", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("whole.*")
