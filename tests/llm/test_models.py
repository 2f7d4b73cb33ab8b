"""Toxicity and language ID: held-out accuracy, odd rows, and that labels are no inputs of a score."""

import random

from pyspark.sql import functions as F

from rillmart.llm import langid, toxicity

MEAN = ["vile", "crud", "grot", "snarl"]


def texts(n, seed=1):
    made = random.Random(seed)
    plain = ["".join(made.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    rows = []
    for i in range(n):
        words = [made.choice(plain) for _ in range(made.randint(20, 80))]
        bad = i % 4 == 0
        for _ in range(3 * bad):
            words.insert(made.randrange(len(words)), made.choice(MEAN))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_toxic_words_are_learnt(spark, docs_of, odd):
    rows = texts(800)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (4, None)], "doc_id long, toxic int")
    docs = docs_of([(i, t) for i, t, _ in rows] + [(None if i is None else 10_000 + i, t) for i, t, *_ in odd])
    model = toxicity.train(docs, labels, F.col("doc_id") % 3 != 0)
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in out)
    scores = {r.doc_id: r.score for r in out}
    held = [(scores[i] >= 0.5) == bool(y) for i, _, y in rows if i % 3 == 0]
    assert sum(held) >= 0.97 * len(held)
    assert scores[10_001] == scores[10_002] == scores[10_004] < 0.5


def test_bounded_sample_and_no_labels(spark, docs_of):
    rows = texts(60)
    docs = docs_of([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    assert len(toxicity.train(docs, labels, sample=10)[0]) > 0
    nothing = toxicity.train(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), nothing).count() == 0


def test_text_is_carried(docs_of, spark):
    docs = docs_of([(1, "some text"), (2, None)])
    out = toxicity.score(docs, toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int")), tuple(docs.columns), carry_text=True)
    assert sorted(map(str, out.drop("score").collect())) == sorted(map(str, docs.drop("score").collect()))


LANGUAGES = {"aa": "abcde", "bb": "cdefg", "cc": "ghijk"}


def test_languages_are_told_apart(docs_of, odd):
    made = random.Random(3)
    rows = []
    for i in range(400):
        lang = list(LANGUAGES)[i % 3]
        words = ["".join(made.choice(LANGUAGES[lang]) for _ in range(made.randint(2, 7))) for _ in range(made.randint(5, 60))]
        rows.append((i, " ".join(words), lang, "s"))
    rows += [(1000, None, "aa", "s"), (1001, "", "aa", "s"), (1002, "123 !?", "bb", "s"), (1003, "ghijk ghki", None, "s")]
    docs = docs_of(rows)
    model = langid.train(docs, F.col("doc_id") % 4 != 2)
    assert model.languages == ["aa", "bb", "cc"] and model.temperature > 0
    assert (model.weights == 0).mean() > 0.5
    out = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    held = [out[i].lang_pred == lang for i, _, lang, _ in rows[:400] if i % 4 == 2]
    assert sum(held) >= 0.97 * len(held)
    assert [out[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "cc"] and out[1000].score == 0
    assert all(0 <= r.score <= 1 for r in out.values())
    assert langid.predict(docs_of(odd), model).count() == len(odd)


def test_no_language_learnt(docs_of):
    docs = docs_of([(1, "abc", None, None)])
    assert [tuple(r) for r in langid.predict(docs, langid.train(docs)).collect()] == [(1, "und", 0.0)]
    assert langid.predict(docs.limit(0), langid.train(docs.limit(0))).count() == 0
