import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from pyspark.sql import functions as F

import corpus_pipeline
from rillmart.llm import bpe
from rillmart.llm.queries import QUERIES

MEAN = ["vile", "crud", "grot"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, docs_of):
    """Documents with toxic ones, near copies and shared passages among them, and labels."""
    made = random.Random(9)
    words = lambda n: ["".join(made.choice("abcdefghij") for _ in range(5)) for _ in range(n)]
    rows, toxic = [], []
    for i in range(400):
        own = words(made.randint(60, 120))
        if i % 5 == 0:
            for _ in range(4):
                own.insert(made.randrange(len(own)), made.choice(MEAN))
            toxic.append(i)
        rows.append((i, " ".join(own), "en", f"s{i % 4}"))
    rows += [(1000 + i, rows[i][1] + " more", "en", "s1") for i in (1, 2, 3)] + [(2000, rows[4][1], "en", "s0")]
    passage = " ".join(words(60))
    rows += [(3000 + i, " ".join(words(80)) + " " + passage + " " + " ".join(words(80)), "de", "s2") for i in range(3)]
    rows += [(4000, None, None, None), (4001, "", "en", "s3")]
    path = str(tmp_path_factory.mktemp("tables"))
    odd = ["spans", "__copies", "__times", "__first", "sign", "tie", "whole", "row", "id", "copies", "again", "doubt", "text_", "toxic", "label"]
    docs_of(rows).select("*", *(F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias(c) for c in odd)).write.parquet(
        f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i in toxic)) for i in range(0, 400) if i % 3], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, toxic, passage


def test_stages_in_order(spark, folder, tmp_path):
    path, rows, toxic, passage = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, kept, counts = docs.columns, {}, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        out = str(tmp_path / name)
        stage(spark, docs, path).write.parquet(out)
        docs = spark.read.parquet(out)
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "byte_bpe":
            assert docs.columns == columns
    every = {r[0] for r in rows}
    assert every - kept["toxicity"] <= set(toxic) and len(every - kept["toxicity"]) >= 0.95 * len(toxic)
    assert kept["toxicity"] - kept["ngram_jaccard_join"] == {1001, 1002, 1003, 2000} | ({1002} & kept["toxicity"])
    assert kept["ngram_jaccard_join"] == kept["substring_dedup"]
    texts = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "substring_dedup")).collect()}
    for r in [*texts.values(), *before.collect()]:          # columns whose names the stages use are carried as they are
        assert r["score"] == "x" and r["__row"] == "y" and all(r[c] == f"{c}{r.doc_id}" for c in ("spans", "__copies", "__times", "whole", "tie", "label"))
    given = {r[0]: r[1] for r in rows}
    assert passage in texts[3000].text and passage not in texts[3001].text and passage not in texts[3002].text
    assert all(r.text == given[i] for i, r in texts.items() if i not in (3001, 3002))
    assert all(r.n_chars == len(r.text or "") for r in texts.values())
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=bpe.Vocabulary(
        open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read()).ranks)
    mixed = {}
    for r in before.collect():
        mixed.setdefault(r.doc_id, []).append(r.text)
    for r in docs.collect():
        assert r.n_tokens == len(encoder.encode_ordinary(mixed[r.doc_id][0] or ""))
        assert r.decoded_sha256 == hashlib.sha256((mixed[r.doc_id][0] or "").encode()).hexdigest()
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts == {i: len(t) for i, t in mixed.items()} and max(counts.values()) <= 3


def test_run_is_the_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder[0])
    assert out.count() > 100 and set(out.columns) >= {"doc_id", "n_tokens", "ids"}
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "substring_dedup", "source_mix", "byte_bpe"]


def test_each_operator_has_its_query():
    import __spark_entry__
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert len([q for q in QUERIES if q.startswith(f"op{n}_")]) == 1
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(__spark_entry__.oracle_sql()) <= set(names)
