import random

import numpy as np
import pyarrow as pa
import pytest

from rillmart.llm import passages, words
from rillmart.llm.frames import gathered


def made_words(made, n):
    return ["".join(made.choice("abcdefgh") for _ in range(6)) for _ in range(n)]


def edited(made, words, every):
    out = []
    for i, w in enumerate(words):
        out += [] if i % (3 * every) == every else ["odd" + w] if i % every == every - 1 else [w]
    return out


@pytest.fixture(scope="module")
def corpus():
    made = random.Random(5)
    exact, fuzzy, short = made_words(made, 70), made_words(made, 120), made_words(made, 40)
    rows, want = [], {}
    for i in range(60):
        words = made_words(made, made.choice([60, 200, 500]))
        at = made.randrange(len(words))
        if i % 4 == 0:
            words[at:at] = exact
            want[i] = (at, at + 70)
        elif i % 4 == 1:
            words[at:at] = fuzzy if i == 1 else edited(made, fuzzy, 15)
            want[i] = (at, at + (120 if i == 1 else len(edited(made, fuzzy, 15))))
        elif i % 4 == 2:
            words[at:at] = short
        rows.append((i, " ".join(words)))
    return rows, want


def test_planted_passages_and_nothing_else(docs_of, corpus):
    rows, want = corpus
    out = passages.shared_passages(docs_of(rows)).collect()
    found = {}
    for r in out:
        assert r.other_id < r.doc_id and r.end - r.start >= 50 and r.equal >= 0.8 * (r.end - r.start)
        found.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    assert set(found) == set(want) - {0, 1}
    for i, spots in found.items():
        start, end = want[i]
        assert len(spots ^ set(range(start, end))) <= (0 if i % 4 == 0 else 6)


def test_cut_texts_keep_the_first_and_all_else(docs_of, corpus):
    rows, want = corpus
    texts = {r.doc_id: r for r in passages.without_passages(docs_of(rows)).collect()}
    for i, text in rows:
        words = text.split(" ")
        if i in want and i > 1:
            left = texts[i].text.split()
            assert len(left) <= len(words) - (want[i][1] - want[i][0]) + 6 and texts[i].n_chars == len(texts[i].text)
        else:
            assert texts[i].text == text


def test_odd_rows(docs_of, odd):
    long = " ".join(f"w{i}" for i in range(300))
    rows = [*odd, (20, long), (21, long), (21, long), (None, long), (22, "same same " * 100), (23, "same same " * 90)]
    out = passages.without_passages(docs_of(rows))
    assert out.columns == docs_of(rows).columns
    left = sorted(((str(r.doc_id), r.text) for r in out.collect()), key=str)
    assert sum(t == long for _, t in left) == 2 and "21" not in [i for i, _ in left]
    assert [t for i, t in left if i in ("1", "2", "3", "4", "5")] == [None, "", "a b c d", "a b c d", " \t\n", "A B c D " * 4000]
    assert passages.without_passages(docs_of([])).count() == 0


def test_chain_is_the_best_of_all():
    made = np.random.default_rng(3)
    for _ in range(30):
        n = made.integers(1, 9)
        x, y, size = made.integers(0, 60, n), made.integers(0, 60, n), made.integers(3, 9, n)
        best = 0.0

        def extend(i, score):
            nonlocal best
            best = max(best, score)
            for j in range(n):
                if x[j] >= x[i] + size[i] and y[j] >= y[i] + size[i]:
                    extend(j, score + size[j] - passages.GAP * (x[j] - x[i] - size[i] + y[j] - y[i] - size[i]))
        for i in range(n):
            extend(i, float(size[i]))
        chain = passages.chains_of(x, y, size)[0]
        score = float(size[chain].sum()) - passages.GAP * sum(
            float(x[b] - x[a] - size[a] + y[b] - y[a] - size[a]) for a, b in zip(chain[:-1], chain[1:], strict=True))
        assert score == pytest.approx(best)


@pytest.mark.parametrize("gap, other_gap", [(80, 80), (0, 160)])
def test_two_passages_of_one_pair_far_apart(docs_of, gap, other_gap):
    made = random.Random(gap)
    first, second = made_words(made, 100), made_words(made, 100)
    rows = [(1, " ".join(first + made_words(made, other_gap) + second)), (2, " ".join(first + made_words(made, gap) + second))]
    out = passages.shared_passages(docs_of(rows)).collect()
    assert sorted((r.start, r.end, r.other_start, r.other_end, r.equal) for r in out) == [
        (0, 100, 0, 100, 100), (100 + gap, 200 + gap, 100 + other_gap, 200 + other_gap, 100)]


def test_sparse_chain_hides_no_exact_passage(docs_of):
    made = random.Random(11)
    form = [made_words(made, 14) for _ in range(40)]
    passage = made_words(made, 90)

    def letter(at):
        words = [w for f in form for w in f + made_words(made, 14)]
        return words[:at] + passage + words[at + 90:] if at else words
    rows = [(1, " ".join(letter(0))), (2, " ".join(made_words(made, 80) + passage)), (3, " ".join(letter(600)))]
    out = passages.shared_passages(docs_of(rows)).collect()
    assert [(r.doc_id, r.start, r.end, r.other_id, r.equal) for r in out] == [(3, 600, 690, 2, 90)]


def test_exact_repeat_whose_parts_others_hold_first(docs_of):
    made = random.Random(12)

    def filled(words):
        return " ".join(made_words(made, 60) + words + made_words(made, 60))
    rows = []
    for g in range(0, 800, 100):
        one, two = made_words(made, 40), made_words(made, 40)
        rows += [(g + i, filled(w)) for i, w in ((1, one), (11, one), (2, two), (12, two), (10, one + two), (20, one + two))]
    out = passages.shared_passages(docs_of(rows)).collect()
    assert sorted((r.doc_id, r.start, r.end, r.other_id, r.other_start, r.equal) for r in out) == [
        (g + 20, 60, 140, g + 10, 60, 80) for g in range(0, 800, 100)]


def test_every_exact_run_is_covered(docs_of):
    """Against brute force: stretches of few texts, so that most seeds have holders elsewhere, and periodic words."""
    made = random.Random(13)
    pool = [made_words(made, 130) for _ in range(3)] + [["same"] * 90, ["a", "b", "c"] * 40]
    rows = []
    for i in range(40):
        words = []
        for _ in range(made.randint(1, 6)):
            some = made.choice(pool)
            at = made.randrange(len(some) - 30)
            words += some[at: at + made.randint(20, 100)] + made_words(made, made.choice([0, 3, 40]))
        rows.append((i, " ".join(words)))
    covered = {}
    for r in passages.shared_passages(docs_of(rows)).collect():
        covered.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    seen = set()
    for i, text in rows:
        words = text.split(" ")
        own = [tuple(words[s: s + 50]) for s in range(len(words) - 49)]
        missed = [s for s, run in enumerate(own) if run in seen and len(set(range(s, s + 50)) - covered.get(i, set())) >= passages.K]
        assert not missed, i
        seen.update(own)


def test_seeds_of_many_texts_are_those_of_each():
    made = np.random.default_rng(3)
    for trial in range(300):
        runs = made.integers(0, (4, 30, 80)[trial % 3], made.integers(0, 9))
        grams = made.integers(0, (2, 5, 2 ** 40)[trial % 4 % 3], runs.sum()).astype(np.uint64)
        at, of = passages.all_seeds(grams, runs)
        starts = np.cumsum(runs) - runs
        want = [(int(x + starts[i]), i) for i, own in enumerate(words.by_text(grams, runs)) for x in passages.seeds_of(own)]
        assert list(zip(at.tolist(), of.tolist(), strict=True)) == want


def test_runs_of_any_length_are_hashed_as_word_by_word():
    hashes = np.random.default_rng(4).integers(0, 2 ** 63, 120).astype(np.uint64)
    for k in (1, 2, 3, 5, 12, 13, 50):
        run = hashes[: 120 - k + 1].copy()
        for j in range(1, k):
            run = run * np.uint64(words.BASE) + hashes[j: len(run) + j]
        got, counts = words.shingle_hashes(hashes, np.array([70, 0, 50]), k)
        inside = np.repeat([0, 1], [70, 50])
        assert counts.tolist() == [71 - k, 0, 51 - k]
        assert got.tolist() == words.mix(run[inside[: len(run)] == inside[k - 1:]]).tolist()


def test_short_rows_are_gathered():
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, i + n), pa.int64())], names=["x"]) for i, n in ((0, 3), (3, 0), (3, 4), (7, 2))]
    for rows, sizes in ((1, [3, 4, 2]), (5, [7, 2]), (100, [9])):
        got = list(gathered(iter(batches), rows))
        assert [b.num_rows for b in got] == sizes and [x for b in got for x in b.column("x").to_pylist()] == list(range(9))
    assert list(gathered(iter([]))) == []
