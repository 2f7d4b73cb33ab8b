import random
import re
from collections import Counter, defaultdict

import pytest

from rillmart.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def normal(line):
    return re.sub("[0-9]+", "0", re.sub("[A-Z]", lambda m: m[0].lower(), " ".join(WORD.findall(line))))


def plain(rows, limit):
    holders = defaultdict(set)
    for doc_id, text, _, host in rows:
        for line in (text or "").split("\n"):
            if WORD.search(line):
                holders[host, normal(line)].add(doc_id)
    out = []
    for doc_id, text, _, host in rows:
        text = text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        twice = {w for w, n in Counter(windows).items() if n > 1}
        inside = {j for i, w in enumerate(windows) if w in twice for j in range(i, i + 5)}
        gone = sum(len(WORD.findall(x)) for x in lines if len(holders[host, normal(x)]) > limit)
        failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
        kept = not failed and 2 * gone <= len(words) and len(words) - gone >= 10
        out.append((str(doc_id), len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
                    len(lines) - len(set(lines)), len(inside), gone, failed, kept))
    return sorted(out)


def got(frame):
    return sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.removed_words,
                   r.base_failed, r.kept) for r in frame.collect())


def made(n, seed):
    r = random.Random(seed)
    lines = ["All rights reserved 2024", "all  rights RESERVED 7", "Menu | home | about us now", "né à Paris #1 <b>", "x", "\t"]
    words = [f"w{i}" for i in range(40)]
    fresh = lambda: " ".join(r.choice(words) for _ in range(r.randint(1, 25)))
    return [(i, "\n".join(r.choice(lines) if r.random() < 0.3 else fresh() for _ in range(r.randint(0, 6))), "en",
             None if i % 7 == 0 else f"s{i % 3}") for i in range(n)]


@pytest.mark.parametrize("limit", [2, 10])
def test_measures_and_verdicts_equal_a_plain_version(docs_of, odd, limit):
    rows = made(120, limit) + [(i, t, "en", "s") for i, t in odd]
    rows += [(5, rows[5][1], "en", rows[5][3])] * 20 + [(None, "lone line of a text without an id", "en", "s1")] * 20
    rows += [(900 + i, "the same line in many documents of one host\n" + " ".join(f"u{i}x{j}" for j in range(30)), "en", "hot") for i in range(40)]
    assert got(quality.judged(docs_of(rows), limit=limit)) == plain(rows, limit)


def test_cleaned_texts_lack_the_frequent_lines(docs_of):
    own = lambda i: " ".join(chr(97 + i % 26) + "own" * (1 + j) for j in range(20))
    rows = [(i, f"Menu {i}\n{own(i)}\n\nmenu  {i + 1}", "en", "a") for i in range(12)]
    rows += [(50 + i, f"Menu 3\n{own(i)}", "en", "b") for i in range(3)] + [(90, "Menu 1 " * 30, "en", "a")]
    docs = docs_of(rows)
    out = quality.cleaned(docs)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == docs.columns and set(texts) == {*range(12), 50, 51, 52}
    assert all(texts[i] == f"{own(i)}\n" for i in range(12)) and texts[50] == f"Menu 3\n{own(0)}"


def test_empty_table(docs_of):
    assert quality.judged(docs_of([])).count() == 0 and quality.cleaned(docs_of([])).count() == 0
