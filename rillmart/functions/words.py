"""Search words out of free text.

Latin and digit runs are cut by a regular expression. Runs of Han characters need a word list. Mode ``smart`` takes, of
all ways to cut a run, one that covers most characters by listed words of two or more; of these, one of fewest words (single
characters, which stand where no listed word is, included); of these, the one whose first word is longest, then whose second is,
and so on. Mode ``longest`` is forward maximum matching.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What counts as a word without a word list, and as a Han run.
PLAIN_WORD = r"([\p{L}\p{N}&&[^\p{IsHan}]]+)"
HAN_RUN = r"(\p{IsHan}+)"


def plain_words(text: Column | str) -> Column:
    """Lower-case Latin/digit words of a text, in order, with repeats."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(PLAIN_WORD), F.lit(1))


def han_runs(text: Column | str) -> Column:
    return F.regexp_extract_all(_col(text), F.lit(HAN_RUN), F.lit(1))


def _cut(run: str, words: frozenset[str], longest: int) -> list[str]:
    out, at = [], 0
    while at < len(run):
        size = next((n for n in range(min(longest, len(run) - at), 1, -1)
                     if run[at:at + n] in words), 1)
        out.append(run[at:at + size])
        at += size
    return out


def _best_cut(run: str, words: frozenset[str], longest: int) -> list[str]:
    """(covered, fewer words, first size) is best for the rest of the run from each place, found from its end."""
    n = len(run)
    best, size_at = [(0, 0)] * (n + 1), [1] * n
    for at in range(n - 1, -1, -1):
        covered, less, size = max(
            (best[at + k][0] + (k if k > 1 else 0), best[at + k][1] - 1, k)
            for k in range(1, min(longest, n - at) + 1) if k == 1 or run[at:at + k] in words)
        best[at], size_at[at] = (covered, less), size
    out, at = [], 0
    while at < n:
        out.append(run[at:at + size_at[at]])
        at += size_at[at]
    return out


def han_cutter(words: Iterable[str], mode: str = "smart"):
    """Column function cutting arrays of Han runs by a list that the driver holds; for streams."""
    listed = frozenset(w for w in words if w)
    longest = max(map(len, listed), default=1)
    one = _best_cut if mode == "smart" else _cut

    @F.pandas_udf("array<string>")
    def cut(runs: pd.Series) -> pd.Series:
        return runs.map(lambda rs: [w for r in rs for w in one(r, listed, longest)])

    return cut


def _smart_sizes(longest: int) -> Column:
    """The size of the word that starts at each place of ``_run``, if one does, from the listed sizes in ``_sizes``."""
    def step(done: Column, at: Column) -> Column:
        best = done["best"]
        rest = lambda size: best[size - 1]
        listed = F.transform(F.coalesce(F.try_element_at("_sizes", at), F.array().cast("array<int>")), lambda size: F.struct(
            (rest(size)["covered"] + size).alias("covered"), (rest(size)["less"] - 1).alias("less"), size.alias("size")))
        single = F.struct(best[0]["covered"].alias("covered"), (best[0]["less"] - 1).alias("less"), F.lit(1).alias("size"))
        top = F.array_max(F.array_append(listed, single))
        kept = F.array_prepend(best, F.struct(top["covered"].alias("covered"), top["less"].alias("less")))
        return F.struct(F.slice(kept, 1, longest).alias("best"), F.array_prepend(done["pick"], top["size"]).alias("pick"))

    start = F.struct(F.array(F.struct(F.lit(0).alias("covered"), F.lit(0).alias("less"))).alias("best"),
                     F.array().cast("array<int>").alias("pick"))
    return F.aggregate(F.sequence(F.length("_run"), F.lit(1), F.lit(-1)), start, step, lambda done: done["pick"])


def _longest_sizes() -> Column:
    return F.transform(F.sequence(F.lit(1), F.length("_run")), lambda at: F.coalesce(
        F.array_max(F.try_element_at("_sizes", at)), F.lit(1)))


def han_words(df: DataFrame, text: str, dictionary: DataFrame, out: str, mode: str = "smart") -> DataFrame:
    """One row per word of the Han runs of ``text``, cut as ``mode`` says.

    ``dictionary`` has one column of words and may be of any size: the distinct runs are taken
    apart into the substrings that could be words, and a join with the dictionary leaves those that are: the lattice from
    which words are chosen, run by run.
    """
    word = F.col(dictionary.columns[0])
    listed = dictionary.select(word.alias("_word")).where(F.length("_word") > 1).distinct()
    longest = listed.agg(F.max(F.length("_word"))).first()[0] or 1
    rows = df.select("*", F.explode(han_runs(text)).alias("_run"))
    runs = rows.select("_run").distinct()
    tried = runs.select("*", F.explode(F.sequence(F.lit(1), F.length("_run"))).alias("_at")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(longest))).alias("_size")).where(
        (F.col("_size") > 1) & (F.col("_at") + F.col("_size") <= F.length("_run") + 1)).withColumn(
        "_word", F.substring("_run", F.col("_at"), F.col("_size")))
    fitting = tried.join(listed, "_word", "left_semi").groupBy("_run", "_at").agg(F.collect_list("_size").alias("_fit"))
    lattice = fitting.groupBy("_run").agg(F.map_from_entries(F.collect_list(F.struct("_at", "_fit"))).alias("_sizes"))

    def step(done: Column, at: Column) -> Column:
        size = F.col("_pick")[at - 1]
        return F.when(at < done["next"], done).otherwise(F.struct(
            (at + size).alias("next"), F.array_append(done["words"], F.substring(F.col("_run"), at, size)).alias("words")))

    start = F.struct(F.lit(1).alias("next"), F.array().cast("array<string>").alias("words"))
    sized = runs.join(lattice, "_run", "left").select(
        "_run", F.explode(F.array(_smart_sizes(longest) if mode == "smart" else _longest_sizes())).alias("_pick"))
    cut = sized.select("_run", F.aggregate(
        F.sequence(F.lit(1), F.length("_run")), start, step, lambda done: done["words"]).alias("_cut"))
    return rows.join(cut, "_run").withColumn(out, F.explode("_cut")).drop("_run", "_cut")


def words_of(df: DataFrame, text: str, out: str = "word",
             dictionary: DataFrame | Iterable[str] | None = None, mode: str = "smart") -> DataFrame:
    """One row per word; a row whose text has no word is dropped.

    ``dictionary`` is a table of words for Han text, or a list of them; without it every Han
    character is a word. ``mode`` is ``smart`` or ``longest``, see the module.
    """
    if dictionary is None:
        return df.withColumn(out, F.explode(F.concat(plain_words(text), _han_singles(text))))
    if df.isStreaming:     # a row at a time: nothing may be gathered over rows
        if isinstance(dictionary, DataFrame):
            raise ValueError("a stream needs the dictionary as a list")
        cut = han_cutter(dictionary, mode)
        return df.withColumn(out, F.explode(F.concat(plain_words(text), cut(han_runs(text)))))
    if not isinstance(dictionary, DataFrame):
        dictionary = df.sparkSession.createDataFrame([(w,) for w in dictionary if w], "word string")
    plain = df.withColumn(out, F.explode(plain_words(text)))
    return plain.unionByName(han_words(df, text, dictionary, out, mode))


def register_words(spark: SparkSession, name: str = "split_words") -> None:
    """Register the words as a SQL table function, for use in a lateral join."""
    plain, han = (p.replace("\\", "\\\\") for p in (PLAIN_WORD, r"(\p{IsHan})"))
    spark.sql(
        f"create or replace temporary function {name}(line string) returns table(word string) return "
        f"select explode(concat(regexp_extract_all(lower(line), '{plain}', 1), "
        f"regexp_extract_all(line, '{han}', 1))) as word")


def _han_singles(text: str) -> Column:
    return F.regexp_extract_all(F.col(text), F.lit(r"(\p{IsHan})"), F.lit(1))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
