import random
from collections import Counter, defaultdict

import pytest

from rillmart.llm import ngram_join


def brute(rows, k, least):
    sets = []
    for i, (doc, text, *_) in enumerate(rows):
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[j: j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in holders[g]).items():
            if 100 * n >= least * (len(s) + len(sets[j]) - n):
                root[find(i)] = find(j)
        for g in s:
            holders[g].append(i)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min((d for d in groups[find(i)] if d is not None), default=None)) for i in range(len(rows))]


def edited(made, words, n):
    words = list(words)
    for _ in range(n):
        words[made.randrange(len(words))] = f"new{made.randrange(10 ** 9)}"
    return " ".join(words)


@pytest.mark.parametrize(("k", "least"), [(3, 90), (5, 80), (2, 60)])
def test_groups_equal_brute_force(docs_of, odd, k, least):
    made = random.Random(k)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = list(odd)
    for _ in range(12):
        base = [made.choice(vocabulary) for _ in range(made.choice([3, 9, 12, 20, 45, 160, 700]))]
        rows += [(len(rows) + 10 * (j + 1), edited(made, base, made.randrange(1 + len(base) // 8))) for j in range(12)]
    shared = " ".join(made.choice(vocabulary) for _ in range(60))
    rows += [(5000 + i, shared + " " + " ".join(made.choice(vocabulary) for _ in range(90))) for i in range(60)]
    made.shuffle(rows)
    out = ngram_join.jaccard_components(docs_of(rows), k, least).collect()
    assert sorted(map(repr, ((r.doc_id, r.n_shingles, r.component_id) for r in out))) == sorted(map(repr, brute(rows, k, least)))


def test_one_of_each_group_stays(docs_of, odd):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [*odd, (20, text), (21, text + " more"), (22, text), (22, text), (None, text), (30, "some other words that stand alone here")]
    out = ngram_join.without_near_duplicates(docs_of(rows))
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "20", "3", "30", "4", "5", "6", "None"]
    assert out.columns == docs_of(rows).columns


def test_empty_table(docs_of):
    assert ngram_join.jaccard_components(docs_of([])).count() == 0
    assert ngram_join.without_near_duplicates(docs_of([])).count() == 0


def test_size_classes_meet():
    for least in (60, 80, 90):
        sizes = ngram_join.Sizes(least, 10 ** 6)
        for n in list(range(1, 400)) + [1000, 5000, 77777]:
            for m in {n, n + 1, n * 100 // least}:
                may = sizes.may_differ(n + m)
                if m >= n and n * 100 >= least * m and may:
                    met = {c: d for c, d, _ in sizes.classes(n)}
                    assert any(d >= may for c, d, _ in sizes.classes(m) if c in met), (least, n, m)
