import base64
import random
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from rillmart.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_library_and_decode_to_the_text(docs_of, odd, reference):
    letters = "abcdefghij éß\n\t 日.,'s1"
    made = random.Random(1)
    rows = odd + [(10 + i, "".join(made.choice(letters) for _ in range(made.randint(0, 400)))) for i in range(60)]
    rows += [(90, "<|endoftext|> it's"), (91, "x" * 1000), (92, "".join(made.choice("abcdef") for _ in range(3000))), (93, "a\x85b  c ")]
    out = bpe.decode(bpe.encode(docs_of(rows), PATH, public_tokenizers.PATTERN), PATH).collect()
    assert len(out) == len(rows)
    got = sorted((str(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), r.n_tokens, r.decoded) for r in out)
    want = sorted((str(i), ids := reference.encode_ordinary(t or ""), len(ids), (t or "").encode()) for i, t, *_ in rows)
    assert got == [(i, ids, n, bytearray(t)) for i, ids, n, t in want]


def test_matrix_and_heap_merge_alike():
    with open(PATH, "rb") as f:
        vocabulary = bpe.Vocabulary(f.read())
    made = random.Random(2)
    pieces = ["".join(made.choice("abehrstn ") for _ in range(n)) for n in range(1, 200)]
    packed = vocabulary.encode_pieces(pieces)
    for p in pieces:
        if p.encode() not in vocabulary.ranks:
            assert np.frombuffer(packed[p], "<u4").tolist() == vocabulary.merge_long(p.encode())


def test_empty_table(docs_of):
    assert bpe.decode(bpe.encode(docs_of([]), PATH, public_tokenizers.PATTERN), PATH).count() == 0


def test_decoding_loads_no_table_of_pairs(monkeypatch):
    """A worker that decodes holds the tokens only; what heaps need of the pairs is made when a piece needs it."""
    monkeypatch.setattr(bpe, "vocabulary", None)
    with open(PATH, "rb") as f:
        content = f.read()
    ids = np.array([5, 300, 49_000], "<u4").tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([ids, None], pa.binary())], names=["ids"])
    out, = bpe._decode(SimpleNamespace(value=content), iter([batch]))
    ranks = {int(r): base64.b64decode(t) for t, r in map(bytes.split, content.splitlines())}
    assert out.column("decoded").to_pylist() == [ranks[5] + ranks[300] + ranks[49_000], b""]
    vocabulary = bpe.Vocabulary(content)
    assert "pairs" not in vars(vocabulary)
    assert vocabulary.pairs == {vocabulary.ranks[t[:i]] << 20 | vocabulary.ranks[t[i:]]: r for t, r in vocabulary.ranks.items()
                                for i in range(1, len(t)) if t[:i] in vocabulary.ranks and t[i:] in vocabulary.ranks}


def test_pieces_are_the_same_when_the_worker_starts_anew(monkeypatch):
    """A worker that remembers no piece of earlier batches encodes as one that does."""
    with open(PATH, "rb") as f:
        content = SimpleNamespace(value=f.read())
    made = random.Random(3)
    batches = [pa.RecordBatch.from_arrays([pa.array([b" ".join(str(made.randrange(300)).encode() for _ in range(40))])], names=["text"]) for _ in range(6)]
    found = []
    for cache in (0, 50, bpe.CACHE):
        monkeypatch.setattr(bpe, "CACHE", cache)
        found.append([b.column("ids").to_pylist() for b in bpe._encode(content, public_tokenizers.PATTERN, iter(batches))])
    assert found[0] == found[1] == found[2]
