import math
import random
from collections import defaultdict

import pytest

from rillmart.llm import mixing


def targets(sizes, most):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        rate = (total - sum(most * sizes[s] for s in capped)) / max(1, sum(weight[s] for s in free))
        more = {s for s in free if most * sizes[s] < rate * weight[s]}
        if not more:
            return {s: most * sizes[s] if s in capped else rate * weight[s] for s in order}
        capped |= more


@pytest.mark.parametrize("bins", [mixing.BINS, 8])
def test_targets_copies_and_words_taken(docs_of, monkeypatch, bins):
    monkeypatch.setattr(mixing, "BINS", bins)
    made = random.Random(bins)
    rows = [(i, " ".join("w" * made.randint(0, 90)), "en", None if i % 11 == 0 else f"s{made.choice([0] * 6 + list(range(9)))}") for i in range(900)]
    rows += [(5000, None, "en", "tiny"), (5001, "one two", "en", "tiny"), (5002, "", "en", "none"), (None, "a b c", "en", "s1"), (5003, "a b", "en", "s1"), (5003, "a b", "en", "s1")]
    rows = [(i, t and " ".join(t.split()), lang, s) for i, t, lang, s in rows]
    out = mixing.mix_sources(docs_of(rows)).collect()
    size = lambda t: len((t or "").split())
    assert sorted((str(r.doc_id), r["size"], str(r.source)) for r in out) == sorted((str(i), size(t), str(s)) for i, t, _, s in rows)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, t, _, s in rows:
        sizes[s] += size(t)
        largest[s] = max(largest[s], size(t))
    want = targets(sizes, 3)
    for r in out:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], abs_tol=1e-6)
        assert 0 <= r.taken == r.copies * r["size"] <= 3 * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
    again = mixing.mix_sources(docs_of(rows[::-1])).collect()
    assert sorted((str(r.doc_id), r.copies) for r in out) == sorted((str(r.doc_id), r.copies) for r in again)


def test_inclusion_follows_the_odds(docs_of):
    """Longer documents of a source are taken more often, in proportion to their class."""
    rows = [(i, " ".join(["w"] * (3 if i % 2 else 12)), "en", "a" if i < 4000 else "b") for i in range(8000)]
    out = [r for r in mixing.mix_sources(docs_of(rows), weights=(1, 9)).collect() if r.source == "a"]
    short, long = ([r.copies for r in out if r["size"] == n] for n in (3, 12))
    assert sum(long) / len(long) == pytest.approx(2 * sum(short) / len(short), rel=0.15)


def test_take_mix_and_empty_table(docs_of):
    docs = docs_of([(i, " ".join(["w"] * (i % 7)), "en", f"s{i % 3}") for i in range(100)] + [(7, "w " * 7, "en", "s1")] * 2)
    wanted = {(r.doc_id, r.sign): r.copies for r in mixing.mix_sources(docs).collect()}
    got = mixing.take_mix(docs).collect()
    assert len(got) >= sum(wanted.values()) and mixing.take_mix(docs).columns == docs.columns
    assert mixing.mix_sources(docs_of([])).count() == 0 and mixing.take_mix(docs_of([])).count() == 0
