import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillmart.llm import lm


def corpus():
    made = random.Random(1)
    after = {}
    rows = []
    for i in range(300):
        w, words = "w0", []
        for _ in range(made.randint(0, 60)):
            w = after.setdefault(w, [f"w{made.randrange(80)}" for _ in range(3)])[made.randrange(3)] if made.random() < 0.9 else f"x{made.randrange(10**6)}"
            words.append(w if made.random() < 0.8 else w.upper())
        rows.append((i, " ".join(words)))
    return rows


def test_counts_base_and_gain_on_held_out_rows(docs_of, odd):
    rows = corpus() + [(None if i is None else 1000 + i, t) for i, t, *_ in odd]
    docs = docs_of(rows)
    learnt = (F.coalesce("doc_id", F.lit(0)) % 5) != 1
    out = lm.score(docs, learnt).collect()
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    counts = Counter(w for i, ws in tokens if (i or 0) % 5 != 1 for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), (i or 0) % 5 == 1, len(ws), sum(w in counts for w in ws), n,
                   round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)) for i, ws in tokens)
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out)
    assert got == want
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 for r in out)


def test_scores_do_not_depend_on_partitions(spark, docs_of):
    """Eight shards on any number of tasks, and texts in any number of blocks."""
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (2, 8, 40):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            out = lm.score(docs_of(corpus()).repartition(n), F.col("doc_id") % 5 != 1, shards=8, classes=512)
            found.append([r.score for r in out.orderBy("doc_id").collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[1] == pytest.approx(found[0], abs=1e-9) and found[2] == pytest.approx(found[0], abs=1e-9)


def test_probabilities_against_a_plain_seating():
    """The predictive probability of every dish, from the tables of each sample, in plain loops; a message at a time or all in one."""
    made = np.random.default_rng(5)
    words = np.sort(made.integers(0, 2 ** 63, 12).astype(np.uint64))
    rows, learnt = [], Counter()
    for _ in range(3):
        counts, contexts = made.integers(1, 5, 24), np.tile(np.array([1, 300]), 12)
        train = made.random(24) < 0.7
        rows.append({"words": words.tobytes(), "each": lm.packed(np.full(12, 2)), "contexts": lm.packed(contexts), "docs": lm.packed(np.arange(24)),
                     "counts": lm.packed(counts), "train": train.astype(np.uint8).tobytes()})
        for i in range(24):
            learnt[i // 2, int(contexts[i])] += int(counts[i]) * bool(train[i])
    bucket, total = lm.Bucket(0, 1, 512, rows), lm.Totals(512)
    lm.Bucket(0, 1, 512, rows).add_to(total)
    assert {(int(w), int(c)): int(n) for w, c, n in zip(bucket.word, bucket.context, bucket.customers)} == dict(learnt)
    v = len({w for (w, _), n in learnt.items() if n})
    want = np.zeros(len(bucket.dishes))
    for tables, up, top in lm.Bucket(0, 1, 512, rows).samples():
        for i, (w, c) in enumerate(zip(bucket.word, bucket.context)):
            here = [j for j in range(len(want)) if bucket.context[j] == c]
            parent = (up[w] - 0.7 * top[w] + (1 + 0.7 * top.sum()) / (v + 1)) / (1 + up.sum())
            want[i] += (learnt[w, c] - 0.8 * tables[i] + (1 + 0.8 * tables[here].sum()) * parent) / (1 + sum(learnt[bucket.word[j], c] for j in here)) / lm.SAMPLES
    assert bucket.probabilities(total) == pytest.approx(want)


def test_sizes_grow_with_the_corpus():
    sizes = [lm.sizes_for(n) for n in (0, 10 ** 6, 10 ** 8, 10 ** 9, 10 ** 12)]
    assert sizes[0] == (1, 256) and sizes == sorted(sizes) and sizes[3][1] > sizes[2][1] and sizes[4][1] == lm.CLASSES[1]


def test_nothing_to_learn_from_and_empty_table(docs_of):
    out = lm.score(docs_of([(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.score) for r in out) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert lm.score(docs_of([]), F.lit(True)).count() == 0


def test_probabilities_of_a_context_sum_to_one():
    """One bucket with every known word asked for in one context, and one unknown word."""
    words = np.sort(np.random.default_rng(1).integers(0, 2 ** 63, 40).astype(np.uint64))
    made = np.random.default_rng(2)
    contexts = np.tile(np.array([3, 9]), 41)
    learnt = made.integers(0, 6, 82)
    learnt[-2:] = 0
    rows = [{"words": np.append(words, np.uint64(2 ** 64 - 1)).tobytes(), "each": lm.packed(np.full(41, 2)), "contexts": lm.packed(contexts),
             "docs": lm.packed(np.arange(82)), "counts": lm.packed(np.maximum(learnt, 1)), "train": (learnt > 0).astype(np.uint8).tobytes()}]
    total = lm.Totals(256)
    lm.Bucket(0, 1, 256, rows).add_to(total)
    again = lm.Totals(256)
    for row in total.rows():
        again.add(*row)
    _, _, _, score, _ = next(lm.Bucket(0, 1, 256, rows).scores(again))
    score = score / np.maximum(learnt, 1)
    known = len({i // 2 for i in range(82) if learnt[i]})
    unknown = 41 - known
    for at in (0, 1):
        p = 10 ** score[at::2]
        assert p.sum() - (unknown - 1) * p[-1] == pytest.approx(1)


def test_seating_keeps_its_bounds():
    rng = np.random.default_rng(3)
    customers = rng.integers(0, 500, 2000)
    tables = lm.seated(customers, np.full(2000, 0.5), 0.8, rng)
    assert (tables[customers == 0] == 0).all() and (tables[customers == 1] == 1).all()
    assert (tables >= np.minimum(customers, 1)).all() and (tables <= customers).all()
    few = lm.seated(np.full(4000, 3), np.full(4000, 1.0), 0.5, rng).mean()
    one, two = 1 / (1 - 0.5 + 1), lambda t: 1 / (2 - 0.5 * t + 1)
    assert few == pytest.approx(1 + one + (1 - one) * two(1) + one * two(2), abs=0.05)


def test_contexts_are_words_in_any_number_of_classes(docs_of):
    """After each of 40 words its own word follows; contexts told apart by their class alone would mix them."""
    made = random.Random(4)
    text = lambda: " ".join(f"a{(i := made.randrange(40))} b{i}" for _ in range(60))
    rows = [(i, text()) for i in range(60)] + [(1000 + i, f"a{i} b{i}") for i in range(40)] + [(2000 + i, f"a{i} b{(i + 1) % 40}") for i in range(40)]
    found = []
    for shards, classes in ((4, 1), (4, 512), (4, 2 ** 20)):
        out = {r.doc_id: r.score for r in lm.score(docs_of(rows), F.col("doc_id") < 1000, shards=shards, classes=classes).collect()}
        assert all(out[1000 + i] > out[2000 + i] + 1 for i in range(40))
        found.append(out)
    assert found[0] == pytest.approx(found[1], abs=1e-9) and found[0] == pytest.approx(found[2], abs=1e-9)


def test_packed_forms_keep_numbers():
    made = np.random.default_rng(6)
    for x in (np.zeros(0, np.int64), np.array([0]), made.integers(0, 2 ** 63 - 1, 1000), made.integers(0, 300, 1000)):
        assert (lm.from_planes(lm.planes(x)) == x).all()
        assert (lm.risen(lm.rising(np.unique(x))) == np.unique(x)).all()
    numbers = made.integers(0, 2 ** 40, (1 + lm.SAMPLES, 50))
    assert (lm.heard(lm.told(numbers)) == numbers).all() and lm.heard(lm.told(numbers[:, :0])).shape == (1 + lm.SAMPLES, 0)


def test_rows_in_another_order_are_told():
    """Answers belong to the block that asked; a block of other tokens is no silent mistake."""
    own = lm.table_of(lm.OWN, [(0, 5, [1], b"\x01", lm.packed(np.array([1])), lm.planes(np.array([1])), lm.planes(np.array([0])))])
    answer = lambda mark: lm.table_of(lm.ANSWER, [(0, 0, mark, lm.planes(np.array([1])), np.zeros(1, "<f4").tobytes(), lm.planes(np.ones(10, np.int64)))])
    assert lm._scored(own, answer(5)).num_rows == 1
    with pytest.raises(ValueError, match="another order"):
        lm._scored(own, answer(6))


def test_samples_are_seated_at_the_tables_of_other_shards():
    """A shard with one dish of each context, the other with fifty: its tables are as if all dishes lay in one shard."""
    words = np.sort(np.random.default_rng(8).integers(0, 2 ** 63, 51).astype(np.uint64))
    heads = np.arange(1, 301)

    def shard(number, buckets, each):
        of = words[:1] if len(each) == 1 else words[-len(each):]
        contexts = np.tile(np.arange(len(heads)), len(of))
        return lm.Bucket(number, buckets, 512, [{
            "words": of.tobytes(), "each": lm.planes(np.full(len(of), len(heads))), "heads": lm.rising(heads),
            "contexts": lm.planes(contexts), "counts": lm.planes(np.repeat(each, len(heads)))}])

    counts = np.append(12, np.ones(50, np.int64))
    cut = lambda: [shard(0, 2, counts[:1]), shard(1, 2, counts[1:])]
    begun, told = lm.Totals(512, 1), lm.Totals(512)
    for s in cut():
        s.begin(begun)
    assert begun.few[:2].tolist() == [300 * 62, 51]
    for s in cut():
        s.add_to(told, begun)
    tables = lambda b, **kw: np.mean([t[b.word == 0].sum() for t, _, _ in b.samples(**kw)])
    want = tables(shard(0, 1, counts))
    assert tables(cut()[0], begun=begun) == pytest.approx(want, rel=0.05)
    assert tables(cut()[0]) < 0.9 * want                        # by its own dishes alone
    p = [10 ** x for s in cut() for *_, x, _ in s.answers(told, begun)]
    assert sum(x.reshape(-1, 300).sum(axis=0) for x in p) == pytest.approx(np.ones(300), abs=0.02)
