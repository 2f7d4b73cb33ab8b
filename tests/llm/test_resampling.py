import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from rillmart.llm import resampling


def features(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(resampling.LOWER))
    return words, words + [a + b" " + b for a, b in zip(words, words[1:])]


def plain(docs, target, share, least, buckets):
    bucket = lambda f: zlib.crc32(f) % buckets
    s, t = (Counter(bucket(f) for x in texts for f in features(x)[1]) for texts in ([d[1] for d in docs], target))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
    out = []
    for doc_id, text, *_ in docs:
        words, found = features(text)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, len(words) >= least])
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    ranks = {id(r): i + 1 for i, r in enumerate(order[: share * len(order) // 100])}
    return sorted((str(r[0]), *r[1:4], ranks.get(id(r), 0)) for r in out)


def got(frame):
    return sorted((str(r.doc_id), r.n_features, r.weight, r.score, r["rank"] or 0) for r in frame.collect())


def texts(n, seed):
    made = random.Random(seed)
    return [(i, " ".join(made.choice(["red", "Blue", "g1", "né", "x-y", "日本"]) for _ in range(made.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("chunk,probes,share", [(1 << 20, 15, 25), (40, 1, 60), (9, 3, 100)])
def test_scores_and_ranks_equal_a_plain_version(spark, docs_of, odd, monkeypatch, chunk, probes, share):
    monkeypatch.setattr(resampling, "CHUNK", chunk)
    monkeypatch.setattr(resampling, "PROBES", probes)
    rows = [*texts(150, chunk), *odd, (7, "w" * 700 + " b " + "c" * 300 + " d e " * 30)]
    target = [t for _, t in texts(20, 5)] + [None, ""]
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    assert got(resampling.importance_ranks(docs_of(rows), aim, share=share, buckets=97)) == plain(rows, target, share, 20, 97)


def test_ties_go_to_the_smaller_id_and_equal_rows_share_ranks(spark, docs_of, monkeypatch):
    """A third of all rows are one row, and scores tie over many ids."""
    monkeypatch.setattr(resampling, "gumbel", lambda seed, doc_id: doc_id.isNull().cast("bigint") * 0)
    rows = [(i, "a b c d") for i in range(60, 0, -1)] + [(30, "a b c d")] * 30 + [(None, "a b c d")] * 5
    aim = spark.createDataFrame([("a b",)], "text string")
    found = resampling.importance_ranks(docs_of(rows), aim, share=50, least_words=2).collect()
    ranks = sorted((r["rank"], r.doc_id) for r in found if r["rank"])
    assert [r for r, _ in ranks] == list(range(1, 48))
    assert [d for _, d in ranks] == [*range(1, 30), *[30] * 18]


def test_drawn_rows_keep_their_columns_and_lean_to_the_target(spark, docs_of):
    docs = docs_of([(i, ("apple pear " if i % 2 else "iron steel ") * 15) for i in range(400)])
    aim = spark.createDataFrame([("pear apple pear",)] * 5, "text string")
    taken = resampling.resampled(docs, aim, share=40)
    rows = taken.collect()
    assert taken.columns == docs.columns and len(rows) == 160 and all(r["score"] == "x" and r["__row"] == "y" for r in rows)
    assert sum("apple" in r.text for r in rows) > 120


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "text string")
    assert resampling.importance_ranks(docs_of([]), none).count() == 0
    assert resampling.resampled(docs_of([]), none).count() == 0
    rows = texts(30, 1)
    assert got(resampling.importance_ranks(docs_of(rows), none)) == plain(rows, [], 25, 20, 10_000)
