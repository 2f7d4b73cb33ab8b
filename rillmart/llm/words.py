"""Word hashes of whole texts in numpy, without making a Python string of each word."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

#: A-Z to a-z, and the six white space characters of ``[^\x20\x09-\x0D]+`` to a blank.
FOLD = bytes(32 if b == 32 or 9 <= b <= 13 else b + 32 if 65 <= b <= 90 else b for b in range(256))
BLANK = bytes(32 if b == 32 or 9 <= b <= 13 else b for b in range(256))
CHUNK = 1 << 17          # what is made of a chunk stays near the processor
LONG = 4096              # longer words are hashed one by one
BASE = 0x9E3779B97F4A7C15

with np.errstate(over="ignore"):
    POWERS = np.cumprod(np.full(LONG, BASE, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _chunk_hashes(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each word of a folded buffer that cuts no word."""
    data = np.frombuffer(buffer, np.uint8)
    word = data != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
    starts, sizes = edge[::2], edge[1::2] - edge[::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    letters = data[word]
    offsets = np.cumsum(sizes) - sizes
    place = np.arange(len(letters)) - np.repeat(offsets, sizes)
    if sizes.max() > LONG:
        np.minimum(place, LONG - 1, out=place)
    sums = np.add.reduceat((letters.astype(np.uint64) + np.uint64(1)) * POWERS[place], offsets)
    hashes = mix(sums + sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    for i in np.flatnonzero(sizes > LONG):
        hashes[i] = xxhash.xxh64_intdigest(buffer[starts[i]: starts[i] + sizes[i]])
    return hashes, starts


def word_hashes(texts: Iterable[bytes | None], fold: bytes = FOLD) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word ``[^\\x20\\x09-\\x0D]+`` of A-Z lower-cased texts, words in each text).

    ``BLANK`` for ``fold`` keeps the case of letters.

    Texts are worked on a chunk at a time, cut between words, so memory follows the chunk, the
    longest word and the result.
    """
    folded = [(t or b"").translate(fold) for t in texts]
    sizes = np.array([len(t) + 1 for t in folded], np.int64)
    buffer = b" ".join(folded)
    found, places, at = [], [], 0
    while at < len(buffer):
        end = buffer.find(b" ", at + CHUNK)
        end = len(buffer) if end < 0 else end
        hashes, starts = _chunk_hashes(buffer[at:end])
        found.append(hashes)
        places.append(starts + at)
        at = end
    hashes = np.concatenate(found) if found else np.empty(0, np.uint64)
    starts = np.concatenate(places) if places else np.empty(0, np.int64)
    counts = np.diff(np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes)))))
    return hashes, counts


def shingle_hashes(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of ``k`` words within a text, runs in each text); none in shorter texts."""
    if len(hashes) < k:
        return np.empty(0, np.uint64), np.zeros(len(counts), np.int64)
    n = len(hashes) - k + 1
    run, size = hashes, 1                # runs of the leading bits of k, each time doubled
    for bit in bin(k)[3:]:
        run, size = run[: len(run) - size] * np.uint64(pow(BASE, size, 1 << 64)) + run[size:], 2 * size
        if bit == "1":
            run, size = run[: len(run) - 1] * np.uint64(BASE) + hashes[size:], size + 1
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = owner[:n] == owner[k - 1:]
    return mix(run[inside]), np.maximum(counts - k + 1, 0)


def by_text(values: np.ndarray, counts: np.ndarray) -> Iterator[np.ndarray]:
    """The slice of ``values`` that belongs to each text."""
    ends = np.cumsum(counts)
    for start, end in zip((ends - counts).tolist(), ends.tolist(), strict=True):
        yield values[start:end]
