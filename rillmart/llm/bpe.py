"""Byte-level BPE encoding and decoding with a public rank file.

Texts are cut into pieces by a pattern; pieces repeat, so each task encodes the distinct ones.
These are laid out as padded matrices, one per length bucket: a row is a piece, a cell a token id.
In each round every row merges its leftmost pair of minimum rank; rows are compacted to the left,
finished rows leave the matrix. Ranks of pairs come from an open-addressing hash table in numpy.
Documents stay in their partition, so there is no shuffle and no hot key.
"""

from __future__ import annotations

import array
import base64
import functools
import heapq
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NONE = np.int64(1 << 40)
WIDTHS = (2, 3, 4, 5, 6, 8, 10, 12, 16, 24, 32, 64, 128, 256)
BUCKET = [next(i for i, w in enumerate(WIDTHS) if w >= n) for n in range(WIDTHS[-1] + 1)]
CELLS = 1 << 17          # cells of one matrix
CACHE = 60_000           # distinct pieces that a worker remembers; then it starts anew
BITS = 20


def ranks_of(content: bytes) -> dict[bytes, int]:
    """Rank of each token of a tiktoken file."""
    return {base64.b64decode(t): int(r) for t, r in map(bytes.split, content.splitlines()) if t}


class Vocabulary:
    """Ranks of a tiktoken file, byte ids, and the hashed table of mergeable pairs."""

    def __init__(self, content: bytes):
        self.ranks = ranks_of(content)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        pairs, ranks = array.array("q"), array.array("q")
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left << 20 | right)
                    ranks.append(rank)
        self.keys = np.full(1 << BITS, -1, np.int64)
        self.values = np.full(1 << BITS, NONE, np.int64)
        key, value = np.array(pairs, np.int64), np.array(ranks, np.int64)
        slot = self.slots(key)
        while len(key):
            free = self.keys[slot] == -1
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            put = first[free[first]]
            self.keys[slot[put]], self.values[slot[put]] = key[put], value[put]
            left = np.ones(len(key), bool)
            left[put] = False
            key, value, slot = key[left], value[left], (slot[left] + 1) & ((1 << BITS) - 1)

    @functools.cached_property
    def pairs(self) -> dict[int, int]:
        """Rank of each mergeable pair; only pieces too long for a matrix need it."""
        at = self.keys >= 0
        return dict(zip(self.keys[at].tolist(), self.values[at].tolist(), strict=True))

    @staticmethod
    def slots(key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each merged pair, ``NONE`` where it cannot merge or an id is -1 (padding)."""
        out = np.full(left.shape, NONE, np.int64)
        at = np.flatnonzero(((left >= 0) & (right >= 0)).ravel())
        key = left.ravel()[at] << 20 | right.ravel()[at]
        slot, flat = self.slots(key), out.ravel()
        while len(at):
            there = self.keys[slot]
            hit = there == key
            flat[at[hit]] = self.values[slot[hit]]
            more = ~hit & (there != -1)
            at, key, slot = at[more], key[more], (slot[more] + 1) & ((1 << BITS) - 1)
        return flat.reshape(left.shape)

    def merge_rows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges a padded matrix of ids to the end; returns (matrix, length of each row)."""
        done = rows.copy()
        at = np.arange(len(rows))
        ranks = self.pair_ranks(rows[:, :-1], rows[:, 1:])
        while True:
            j = ranks.argmin(axis=1)
            best = ranks[np.arange(len(ranks)), j]
            live = best < NONE
            done[at[~live], : rows.shape[1]] = rows[~live]
            done[at[~live], rows.shape[1]:] = -1
            if not live.any():
                return done, (done >= 0).sum(axis=1)
            rows, ranks, at, j, best = rows[live], ranks[live], at[live], j[live], best[live]
            n, each = np.arange(len(rows)), np.arange(rows.shape[1] - 1)
            shift = each[None, :] + (each[None, :] > j[:, None])
            rows[n, j] = best
            rows = np.take_along_axis(rows, shift, axis=1)
            if rows.shape[1] == 1:
                ranks = np.full((len(rows), 1), NONE)
                continue
            ranks = np.take_along_axis(ranks, shift[:, :-1], axis=1)
            after = j < rows.shape[1] - 1
            ranks[n[after], j[after]] = self.pair_ranks(rows[n[after], j[after]], rows[n[after], j[after] + 1])
            before = j > 0
            ranks[n[before], j[before] - 1] = self.pair_ranks(rows[n[before], j[before] - 1], rows[n[before], j[before]])

    def merge_long(self, piece: bytes) -> list[int]:
        """The same merges for one piece too long for a matrix, by a heap of (rank, position)."""
        ids, size = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist(), len(piece)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(size - 1)
                if (r := self.pairs.get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            k = after[i]
            if ids[i] != left or k >= size or ids[k] != right:
                continue
            ids[i], ids[k] = rank, -1
            after[i] = after[k]
            if after[i] < size:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < size and (r := self.pairs.get(ids[a] << 20 | ids[b])) is not None:
                    heapq.heappush(heap, (r, a, ids[a], ids[b]))
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Packed ids (little-endian unsigned 32 bits) of distinct pieces."""
        out: dict[str, bytes] = {}
        buckets = [([], []) for _ in WIDTHS]
        rank_of = self.ranks.get
        for piece in pieces:
            raw = piece.encode("utf-8", "replace")
            if (rank := rank_of(raw)) is not None:
                out[piece] = rank.to_bytes(4, "little")
            elif len(raw) > WIDTHS[-1]:
                out[piece] = np.array(self.merge_long(raw), "<u4").tobytes()
            else:
                texts, raws = buckets[BUCKET[len(raw)]]
                texts.append(piece)
                raws.append(raw)
        for width, (texts, raws) in zip(WIDTHS, buckets, strict=True):
            step = max(1, CELLS // width)
            for at in range(0, len(texts), step):
                some = raws[at: at + step]
                sizes = np.fromiter(map(len, some), np.int64, len(some))
                rows = np.full((len(some), width), -1, np.int64)
                rows[np.arange(width)[None, :] < sizes[:, None]] = self.byte_ids[
                    np.frombuffer(b"".join(some), np.uint8)]
                rows, sizes = self.merge_rows(rows)
                packed, ends = rows[rows >= 0].astype("<u4").tobytes(), np.cumsum(sizes) * 4
                spans = map(slice, (ends - sizes * 4).tolist(), ends.tolist())
                out.update(zip(texts[at: at + step], map(packed.__getitem__, spans), strict=True))
        return out


@functools.lru_cache(maxsize=2)
def vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(content)


@functools.lru_cache(maxsize=2)
def tokens_of(content: bytes) -> list[bytes]:
    """Bytes of each rank: all that decoding needs."""
    ranks = ranks_of(content)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


@functools.lru_cache(maxsize=4)
def splitter(pattern: str):
    """The pattern with white space as Unicode's White_Space, as the public encoders take it."""
    import regex

    spaces = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    return regex.compile(spaces.replace(r"\s", r"\p{White_Space}"))


def _encode(content, pattern: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocab, find = vocabulary(content.value), splitter(pattern).findall
    cache: dict[str, bytes] = {}
    for batch in batches:
        texts = [find((text or b"").decode("utf-8", "replace")) for text in batch.column("text").to_pylist()]
        new = set().union(*texts)
        if len(cache) > CACHE:
            cache = {x: cache[x] for x in new if x in cache}
        cache.update(vocab.encode_pieces([x for x in new if x not in cache]))
        packed = [b"".join(map(cache.__getitem__, pieces)) for pieces in texts]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array([len(x) // 4 for x in packed], pa.int64()), pa.array(packed, pa.binary())],
            names=[*batch.schema.names[:-1], "n_tokens", "ids"])


def _decode(content, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    token = tokens_of(content.value).__getitem__
    for batch in batches:
        texts = [b"".join(map(token, np.frombuffer(x or b"", "<u4").tolist()))
                 for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())],
                                         names=[*batch.schema.names, "decoded"])


def _content(spark, path: str):
    """The rank file, read on the driver; its size is the vocabulary's, not the data's."""
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def encode(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(``keep``, n_tokens long, ids binary) of every row's whole ``text``.

    ``ids`` packs the token ids as little-endian unsigned 32-bit integers. Special tokens are
    never made; their strings are ordinary text. Null text counts as empty: no ids. Bytes that
    are no UTF-8 become U+FFFD. Repeated rows are each encoded; rows with a null id too. An empty
    table gives an empty result. Other columns are not read. A piece longer than the widest matrix is merged
    by a heap, with the same result.
    """
    content = _content(docs.sparkSession, path)
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(*keep, F.col("text").cast("binary").alias("text")).mapInArrow(
        lambda it: _encode(content, pattern, it), f"{kinds}n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded binary``: the bytes of the tokens of ``ids`` (null: empty)."""
    content = _content(encoded.sparkSession, path)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != "decoded")
    return encoded.drop("decoded").mapInArrow(lambda it: _decode(content, it), f"{schema}, decoded binary")
