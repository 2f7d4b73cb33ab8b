import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from rillmart.llm import words


@given(st.lists(st.text(alphabet="aBé \t\n\x0b\x1c　", max_size=40), max_size=8))
def test_words_are_those_of_bytes_split(texts):
    raw = [t.encode() for t in texts]
    hashes, counts = words.word_hashes(raw)
    want = [t.lower().split() for t in raw]
    assert counts.tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    assert len(hashes) == len(flat)
    assert len(set(hashes.tolist())) == len(set(flat))
    assert all((a == b) == (x == y) for a, x in zip(hashes, flat, strict=True) for b, y in zip(hashes, flat, strict=True))


def test_chunks_do_not_cut_words(monkeypatch):
    texts = [b"alpha beta gamma " * 50, b"", b"x" * 9000 + b" y", b"  lead"]
    whole = words.word_hashes(texts)
    monkeypatch.setattr(words, "CHUNK", 64)
    parts = words.word_hashes(texts)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_shingles_stay_within_a_text():
    hashes, counts = words.word_hashes([b"a b c", b"a b", b"a b c d"])
    grams, runs = words.shingle_hashes(hashes, counts, 3)
    assert runs.tolist() == [1, 0, 2] and grams[0] == grams[1] != grams[2]
    assert words.shingle_hashes(np.empty(0, np.uint64), np.zeros(2, np.int64), 3)[1].tolist() == [0, 0]
