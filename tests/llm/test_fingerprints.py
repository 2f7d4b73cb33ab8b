import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rillmart.llm import fingerprints as fp

LINES = st.lists(st.text(alphabet="ab cé", max_size=12), min_size=1, max_size=6)


def of(*texts):
    return fp.vectors([t.encode() for t in texts])


def same(a, b):
    return all((x == y).all() for x, y in zip(a, b, strict=True))


@settings(max_examples=40, deadline=None)
@given(LINES, LINES, st.randoms())
def test_sums_of_lines(lines, more, shuffled):
    mixed = [*lines, *more]
    shuffled.shuffle(mixed)
    whole = of("\n".join(mixed))
    assert same(whole, fp.insert(of("\n".join(lines)), of("\n".join(more))))
    assert same(fp.delete(whole, of("\n".join(more))), of("\n".join(lines)))
    assert same(fp.unpacked(fp.packed(whole)), whole)


def test_likeness():
    made = random.Random(1)
    words = ["".join(made.choice("abcdefgh") for _ in range(5)) for _ in range(3000)]
    text = lambda a, b: " ".join(words[a:b])
    pairs = [(text(0, 1000), text(0, 1000)), (text(0, 1000), text(250, 1250)), (text(0, 1000), text(1000, 2000)), ("", ""), ("", "a b c")]
    got = fp.likeness(of(*(a for a, _ in pairs)), of(*(b for _, b in pairs)))
    assert got[0] == got[3] == 1 and abs(got[1] - 0.75) < 0.2 and got[2] < 0.3 and got[4] == 0


def by_hand(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for i, (doc, text, *_) in enumerate(order):
        text, follower = text or "", order[(i + 1) % len(order)][1] or ""
        edited = text[: len(text) - len(text) // 4] + follower[: len(text) // 4]
        mark = lambda t: fp.packed(of(t))[0]
        out.append((str(doc), len(text), hashlib.sha256(edited.encode()).hexdigest(), mark(text), mark(edited)))
    return sorted(out)


def test_every_row_against_its_next(docs_of):
    made = random.Random(2)
    rows = [(i * 7 % 101, "\n".join(" ".join(made.choice("ab cd é".split()) for _ in range(made.randint(0, 9))) for _ in range(made.randint(0, 9))))
            for i in range(101)]
    rows += [(500, None), (501, ""), (502, "é日" * 9000), (None, "last of all")]
    made.shuffle(rows)
    out = fp.edit_likeness(docs_of(rows)).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in out) == by_hand(rows)
    assert all(0 <= x <= 1 for r in out for x in (r.near_edited, r.near_next))


def test_repeated_rows_one_row_and_none(docs_of, odd):
    out = fp.edit_likeness(docs_of(odd)).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, *_ in odd)
    assert len({r.fingerprint for r in out if r.doc_id == 3}) == 1
    alone = fp.edit_likeness(docs_of([(1, "abcdefgh")])).collect()
    assert [(r.n_chars, r.near_next) for r in alone] == [(8, 1.0)] and alone[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert fp.edit_likeness(docs_of([])).count() == 0
    assert np.array_equal([r.fingerprint for r in fp.fingerprints(docs_of([(1, None)])).collect()], fp.packed(of("")))
