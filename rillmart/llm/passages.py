"""Substring dedup by collinear chaining: fuzzy passages that several documents share.

1. Seeds: of every ``WINDOW`` consecutive word k-mers the one of least hash. Any ``K + WINDOW - 1`` equal
   words share a seed.
2. Matches: a seed's occurrences are joined in doc_id order, each with the first document that holds it
   and with the one just before. That is at most two matches for each occurrence, also for a seed that
   most documents hold.
3. Exact runs: a run of ``least`` words that an earlier document holds has only seeds that several documents
   hold. Such runs, at every word, are joined with the run's first holder; equality is
   transitive, so that one partner is enough for every word of an exact repeat.
4. Chains: matches of two documents that rise in both are chained; a Fenwick tree over the places in
   the earlier document keeps the best prefix, less a cost for the words skipped in either.
5. Alignment: chains and exact runs are aligned word by word, through their gaps and outwards from both ends. A
   passage counts if it has at least ``least`` words, of which ``IDENTITY`` are equal in order. A chain
   with less is cut, at its words that differ, into the longest parts that have as much. Only then are
   passages dropped that longer ones of their document cover. Only texts that a bitmap of bounded size shows to have a
   chain or a run are shuffled for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import checkpointed, gathered, partitions
from .ngram_join import is_marked, marked_spots, spot_of
from .words import FOLD, by_text, shingle_hashes, word_hashes

K, WINDOW = 5, 12
GAP = 0.4                # cost of a skipped word, in either document
NEAR = 32                # seeds on one diagonal at most this far apart are one anchor
MARGIN = 256             # words around a chain that an alignment may grow into
REACH = 8                # words an alignment may skip at once
IDENTITY = 0.8
NO_SKIP = 1 << 20


def _skips() -> np.ndarray:
    """Rank of each skip (words of a, words of b): the shorter the longer side, then the shorter in all, then in a."""
    made = np.full((REACH + 1, REACH + 1), NO_SKIP)
    every = [(s, t) for s in range(REACH + 1) for t in range(REACH + 1) if s or t]
    for n, skip in enumerate(sorted(every, key=lambda p: (max(p), sum(p)))):
        made[skip] = n
    return made


SKIPS = _skips()


def seeds_of(grams: np.ndarray) -> np.ndarray:
    """Places of the least hash of each window; of a run of equal seeds the last, and the first in each ``WINDOW`` places."""
    if len(grams) <= WINDOW:
        at = np.array([grams.argmin()]) if len(grams) else np.empty(0, np.int64)
    else:
        views = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
        at = np.unique(views.argmin(axis=1) + np.arange(len(views)))
    h = grams[at]
    inner = np.zeros(len(at), bool)
    inner[1:-1] = (h[1:-1] == h[:-2]) & (h[1:-1] == h[2:]) & (at[1:-1] // WINDOW == at[:-2] // WINDOW)
    return at[~inner]


def all_seeds(grams: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, text) of :func:`seeds_of` each text's grams, places ascending from the start of all grams."""
    owner = np.repeat(np.arange(len(runs)), runs)
    least, at, size = grams, np.arange(len(grams)), 1
    while size < WINDOW and len(least):      # first place of the least hash of the ``size`` from each on
        step = min(size, WINDOW - size)
        later = least[step:] < least[:-step]
        at, least, size = np.where(later, at[step:], at[:-step]), np.minimum(least[step:], least[:-step]), size + step
    at = at[owner[: len(at)] == owner[len(owner) - len(at):]] if size == WINDOW else at[:0]
    at = at[np.flatnonzero(np.diff(at, prepend=-1))]         # they only rise
    starts = np.cumsum(runs) - runs
    short = [int(s + grams[s: s + n].argmin()) for s, n in zip(starts.tolist(), runs.tolist(), strict=True) if 0 < n < WINDOW]
    if short:
        at = np.sort(np.append(at, short))
    h, of = grams[at], owner[at]
    place = (at - starts[of]) // WINDOW
    inner = np.zeros(len(at), bool)
    inner[1:-1] = (h[1:-1] == h[:-2]) & (h[1:-1] == h[2:]) & (place[1:-1] == place[:-2]) & (of[1:-1] == of[:-2]) & (of[1:-1] == of[2:])
    return at[~inner], of[~inner]


def _seeds(shortest: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seed, doc_id, place); place is the tie of rows of equal doc_id, then the word."""
    for batch in batches:
        grams, runs = shingle_hashes(*word_hashes(batch.column("text").to_pylist()), K)
        ids, ties = batch.column("doc_id").to_numpy(), batch.column("tie").to_numpy().astype(np.int64)
        at, of = all_seeds(grams, runs)
        some = runs[of] + K - 1 >= shortest
        at, of = at[some], of[some]
        places = at - (np.cumsum(runs) - runs)[of] + (ties[of] << 32)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (grams[at].view(np.int64), ids[of], places)],
                                         names=["seed", "doc_id", "place"])


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True at the first row of every run of equal values."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (seed, doc_id, place): each occurrence with those in the seed's first document
    and in the one before, the n-th with the n-th. Occurrences of a seed of several rows that meet no other
    come with ``other_place`` -1. Held over a batch: one document's rows for each of the
    first, the one before and the last of the seed at its end."""
    names = ("seed", "doc_id", "place")
    held = {c: np.empty(0, np.int64) for c in names}
    done = np.empty(0, bool)

    def out(rows: dict[str, np.ndarray], done: np.ndarray) -> Iterator[pa.RecordBatch]:
        seed, doc, place = (rows[c] for c in names)
        if not len(seed):
            return
        new = _changes(seed, doc, place >> 32)
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(seed)))
        group = np.cumsum(new) - 1
        run = _changes(seed[starts])
        first = np.maximum.accumulate(np.where(run, np.arange(len(starts)), 0))
        rank = np.arange(len(seed)) - starts[group]
        found = []
        for partner, fits in ((first, first < np.arange(len(starts))),
                              (np.arange(len(starts)) - 1, first < np.arange(len(starts)) - 1)):
            row = np.flatnonzero(fits[group] & ~done)
            p = partner[group[row]]
            other = starts[p] + np.minimum(rank[row], sizes[p] - 1)
            apart = doc[row] != doc[other]
            found.append((row[apart], other[apart]))
        row, other = (np.concatenate(x) for x in zip(*found, strict=True))
        alone = ~done & (first < np.arange(len(starts)))[group]
        alone[row] = False
        second = np.flatnonzero((first == np.arange(len(starts)) - 1) & ~done[starts])
        followed = np.zeros(len(starts), bool)
        followed[second - 1] = True
        alone |= followed[group]
        alone = np.flatnonzero(alone)
        for start in range(0, len(alone), 100_000):
            a = alone[start: start + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[a], place[a], doc[a], np.full(len(a), -1))],
                                             names=["doc_id", "place", "other_id", "other_place"])
        for start in range(0, len(row), 100_000):
            a, b = row[start: start + 100_000], other[start: start + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[a], place[a], doc[b], place[b])],
                                             names=["doc_id", "place", "other_id", "other_place"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {c: np.concatenate([held[c], batch.column(c).to_numpy()]) for c in names}
        done = np.append(done, np.zeros(batch.num_rows, bool))
        new = _changes(rows["seed"], rows["doc_id"], rows["place"] >> 32)
        starts = np.flatnonzero(new)
        last = starts[-1]
        yield from out({c: v[:last] for c, v in rows.items()}, done[:last])
        done = np.ones(len(done), bool)
        done[last:] = False
        run = np.searchsorted(rows["seed"][starts], rows["seed"][last])
        keep = np.arange(len(done)) >= last
        for g in {run, len(starts) - 2}:
            if run <= g < len(starts) - 1:
                keep[starts[g]: starts[g + 1]] = True
        held, done = {c: v[keep] for c, v in rows.items()}, done[keep]
    yield from out(held, done)


class Prefix:
    """Fenwick tree of the best (value, item) over a prefix of places."""

    def __init__(self, size: int):
        self.best = [(-1e18, -1)] * (size + 1)

    def put(self, at: int, value: float, item: int) -> None:
        at += 1
        while at < len(self.best):
            if value > self.best[at][0]:
                self.best[at] = (value, item)
            at += at & -at

    def upto(self, at: int) -> tuple[float, int]:
        found = (-1e18, -1)
        while at > 0:
            found = max(found, self.best[at])
            at -= at & -at
        return found


def chains_of(x: np.ndarray, y: np.ndarray, size: np.ndarray) -> list[list[int]]:
    """Collinear chains of anchors, best first; each anchor is in one chain at most.

    An anchor follows another that ends before it in both documents; the cost of the words skipped is
    linear, so the best to follow is the prefix maximum of score + GAP * (ends).
    """
    ends = np.unique(y + size)
    tree, score, before = Prefix(len(ends)), [0.0] * len(x), [-1] * len(x)
    rank = np.searchsorted(ends, y + size)
    upto = np.searchsorted(ends, y, side="right")
    order = sorted([(int(x[i]), 1, i) for i in range(len(x))] + [(int(x[i] + size[i]), 0, i) for i in range(len(x))])
    for _, starts, i in order:
        if starts:
            value, j = tree.upto(int(upto[i]))
            gain = value - GAP * float(x[i] + y[i])
            score[i], before[i] = float(size[i]) + max(gain, 0.0), j if gain > 0 else -1
        else:
            tree.put(int(rank[i]), score[i] + GAP * float(x[i] + y[i] + 2 * size[i]), i)
    used, found = [False] * len(x), []
    for i in sorted(range(len(x)), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            found.append(chain[::-1])
    return found


def _chained(shortest: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of matches sorted by document and partner: each document's chains that are long enough for a passage; and for a
    document that may hold a run of ``shortest`` words twice seeded, the places of such seeds as ``xs``, without ``ys``."""
    names = ("doc_id", "place", "other_id", "other_place")
    held = None

    def document(rows: dict[str, np.ndarray]) -> list[tuple]:
        found, places = [], np.unique(rows["place"] & 0xFFFFFFFF)
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(places) > 2 * WINDOW) + 1, [len(places)]))
        wide = places[cuts[1:] - 1] - places[cuts[:-1]] >= shortest - K - 3 * (WINDOW - 1)
        if wide.any():
            at = places[np.repeat(wide, np.diff(cuts))]
            found.append((int(rows["doc_id"][0]), int(rows["place"][0] >> 32), None, None, at.tolist(), None, None))
        met = rows["other_place"] != -1
        if not met.any():
            return found
        rows = {k: v[met] for k, v in rows.items()}
        tie, x = rows["place"][0] >> 32, rows["place"] & 0xFFFFFFFF
        other_tie, y = rows["other_place"] >> 32, rows["other_place"] & 0xFFFFFFFF
        pair = _changes(rows["other_id"], other_tie)
        new = pair | _changes(x - y)
        new[1:] |= x[1:] - x[:-1] > NEAR
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(x)) - 1
        size = x[tails] + K - x[heads]
        cuts = np.append(np.flatnonzero(pair[heads]), len(heads))
        for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            some = heads[start:end]
            if int(size[start:end].sum()) + 2 * WINDOW < shortest // 2:
                continue
            for chain in chains_of(x[some], y[some], size[start:end]) if end - start > 1 else [[0]]:
                at, sizes = some[chain], size[start:end][chain]
                span = x[at[-1]] + sizes[-1] - x[at[0]]
                if span + 2 * WINDOW >= shortest:
                    found.append((int(rows["doc_id"][0]), int(tie), int(rows["other_id"][at[0]]), int(other_tie[at[0]]),
                                  x[at].tolist(), y[at].tolist(), sizes.tolist()))
        return found

    def out(rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        cuts = np.append(np.flatnonzero(_changes(rows["doc_id"], rows["place"] >> 32)), len(rows["doc_id"]))
        found = [c for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)
                 for c in document({k: v[s:e] for k, v in rows.items()})]
        if found:
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32()] + [pa.list_(pa.int32())] * 3
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)],
                                             names=["doc_id", "tie", "other_id", "other_tie", "xs", "ys", "sizes"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {c: batch.column(c).to_numpy() for c in names}
        if held is not None:
            rows = {c: np.concatenate([held[c], rows[c]]) for c in names}
        last = np.flatnonzero(_changes(rows["doc_id"], rows["place"] >> 32))[-1]
        if last:
            yield from out({c: v[:last] for c, v in rows.items()})
        held = {c: v[last:] for c, v in rows.items()}
    if held is not None:
        yield from out(held)


def _runs(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(run, doc_id, place) of each run of ``least`` words, at every word, that has no seed of ``single``."""
    held, size = [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held, strict=True)],
                                          names=["run", "doc_id", "place"])

    for batch in batches:
        for doc, tie, words, single in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tie", "words", "single")), strict=True):
            own = np.frombuffer(words, "<u4").astype(np.uint64)
            if len(own) < least:
                continue
            runs, _ = shingle_hashes(own, np.array([len(own)]), least)
            alone = np.zeros(len(own) - K + 2, np.int64)
            alone[np.frombuffer(single, "<i4") + 1] = 1
            alone = np.cumsum(alone)
            at = np.flatnonzero(alone[least - K + 1:] == alone[: len(runs)])
            for start in range(0, len(at), 100_000):
                some = at[start: start + 100_000]
                held.append((runs[some].view(np.int64), np.full(len(some), doc), some + (tie << 32)))
                size += len(some)
                if size >= 16_384:
                    yield out()
                    held, size = [], 0
    if held:
        yield out()


def _first_held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (run, doc_id, place): each row of another document with the run's first row."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(c).to_numpy() for c in ("run", "doc_id", "place")]
        if held is not None:
            rows = [np.append(h, r) for h, r in zip(held, rows, strict=True)]
        run, doc, place = rows
        first = np.maximum.accumulate(np.where(_changes(run), np.arange(len(run)), 0))
        at = np.flatnonzero(doc != doc[first])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[at], place[at], doc[first[at]], place[first[at]])],
                                         names=["doc_id", "place", "other_id", "other_place"])
        held = [r[first[-1]: first[-1] + 1] for r in rows]


def _exact(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of runs with their first holders, sorted by document, partner and diagonal: a chain for each stretch."""
    names = ("doc_id", "place", "other_id", "other_place")
    held = None

    def out(rows: dict[str, np.ndarray], starts: np.ndarray) -> pa.RecordBatch:
        n = np.diff(np.append(starts, len(rows["doc_id"])))
        doc, place, other, other_place = (rows[c][starts] for c in names)
        size = rows["place"][starts + n - 1] - place + least
        lists = [[[v] for v in x.tolist()] for x in (place & 0xFFFFFFFF, other_place & 0xFFFFFFFF, size)]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32()] + [pa.list_(pa.int32())] * 3
        columns = [doc, place >> 32, other, other_place >> 32, *lists]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                          names=["doc_id", "tie", "other_id", "other_tie", "xs", "ys", "sizes"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {c: batch.column(c).to_numpy() for c in names}
        if held is not None:
            rows = {c: np.concatenate([held[c], rows[c]]) for c in names}
        place, other = rows["place"], rows["other_place"]
        new = _changes(rows["doc_id"], place >> 32, rows["other_id"], other >> 32, place - other)
        new[1:] |= place[1:] > place[:-1] + 1
        starts = np.flatnonzero(new)
        last = starts[-1]
        if last:
            yield out({c: v[:last] for c, v in rows.items()}, starts[:-1])
        held = {c: v[last:] for c, v in rows.items()}
    if held is not None:
        yield out(held, np.array([0]))


def gap_matches(a: np.ndarray, b: np.ndarray) -> int:
    """Words equal in order (longest common subsequence) of two gaps, by bits of whole numbers: a step for each word of ``b``."""
    if not len(a) or not len(b):
        return 0
    places: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full
    for w in b.tolist():
        if met := free & places.get(w, 0):
            free = ((free + met) | (free - met)) & full
    return len(a) - free.bit_count()


def grown(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs of equal words (place in a, place in b, words) of an alignment from the start of both.

    Equal words are taken; at a difference the shortest skip in either that is followed by
    ``K - 1`` equal words is taken, else the alignment ends.
    """
    i = j = 0
    runs = []
    while i < len(a) and j < len(b):
        n = min(len(a) - i, len(b) - j)
        differ = np.flatnonzero(a[i: i + n] != b[j: j + n])
        run = int(differ[0]) if len(differ) else n
        if run:
            runs.append((i, j, run))
        i, j = i + run, j + run
        if run == n:
            break
        near = REACH + K - 1
        rows, columns = min(len(a) - i, near) - K + 2, min(len(b) - j, near) - K + 2
        if rows < 1 or columns < 1:
            break
        equal = a[i: i + near, None] == b[None, j: j + near]
        if np.count_nonzero(equal) < K - 1:
            break
        starts = equal[:rows, :columns]
        for d in range(1, K - 1):
            starts = starts & equal[d: rows + d, d: columns + d]
        if not starts.any():
            break
        rank = np.where(starts, SKIPS[:rows, :columns], NO_SKIP)
        best = int(rank.argmin())
        i, j = i + best // columns, j + best % columns
    return runs


def reach(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """(words of a, words of b, words equal) of an alignment from the start of both."""
    return (runs[-1][0] + runs[-1][2], runs[-1][1] + runs[-1][2], sum(r[2] for r in runs)) if runs else (0, 0, 0)


def equal_runs(a: np.ndarray, b: np.ndarray, xs: list[int], ys: list[int], sizes: list[int]) -> tuple[np.ndarray, ...]:
    """A chain's alignment as runs of equal words: (place, other place, words, words equal between a run and the next).

    Gaps are grown into from both sides; what else their longest common subsequence holds counts for
    passages that go through the gap.
    """
    runs, between = [], {}

    def grow(px: int, x: int, py: int, y: int, back: bool) -> list[tuple[int, int, int]]:
        if not back:
            return [(px + i, py + j, n) for i, j, n in grown(a[px:x], b[py:y])]
        return [(x - i - n, y - j - n, n) for i, j, n in grown(a[px:x][::-1], b[py:y][::-1])][::-1]

    runs += grow(0, xs[0], 0, ys[0], True)
    for n, (x, y, size) in enumerate(zip(xs, ys, sizes, strict=True)):
        if n:
            px, py = xs[n - 1] + sizes[n - 1], ys[n - 1] + sizes[n - 1]
            left = grow(px, x, py, y, False)
            lx, ly = (left[-1][0] + left[-1][2], left[-1][1] + left[-1][2]) if left else (px, py)
            right = grow(lx, x, ly, y, True)
            runs += left
            if runs:
                between[len(runs) - 1] = gap_matches(a[px:x], b[py:y]) - sum(r[2] for r in left + right)
            runs += right
        edge = np.flatnonzero(np.diff(np.concatenate(([False], a[x: x + size] == b[y: y + size], [False])).astype(np.int8)))
        runs += [(x + s, y + s, e - s) for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
    runs += grow(xs[-1] + sizes[-1], len(a), ys[-1] + sizes[-1], len(b), False)
    extra = np.zeros(len(runs), np.int64)
    extra[list(between)] = list(between.values())
    return *np.array(runs, np.int64).reshape(-1, 3).T, extra


def parts_of(runs: tuple[np.ndarray, ...], least: int) -> list[tuple[int, int, int, int, int]]:
    """(start, end, other start, other end, words equal): the longest part, from run to run, of at least ``least`` words
    of which ``IDENTITY`` are equal, and those of what is left before and after it."""
    x, y, n, extra = runs
    ends, other_ends = x + n, y + n
    equal = np.cumsum(n) + np.cumsum(extra) - extra
    found, rest = [], [(0, len(x))]
    while rest:
        lo, hi = rest.pop()
        best = (0, 0, 0)
        for i in range(lo, hi):
            if ends[hi - 1] - x[i] < max(least, best[0] + 1):
                break
            span = ends[i:hi] - x[i]
            fits = equal[i:hi] - equal[i] + n[i] >= IDENTITY * np.maximum(span, other_ends[i:hi] - y[i])
            at = np.flatnonzero(fits & (span >= max(least, best[0] + 1)))
            if len(at):
                best = (int(span[at[-1]]), i, i + int(at[-1]))
        if best[0]:
            _, i, j = best
            found.append((int(x[i]), int(ends[j]), int(y[i]), int(other_ends[j]), int(equal[j] - equal[i] + n[i])))
            rest += [(lo, i), (j + 1, hi)]
    return sorted(found)


def aligned(a: np.ndarray, b: np.ndarray, xs: list[int], ys: list[int], sizes: list[int],
            least: int) -> list[tuple[int, int, int, int, int]]:
    """(start, end, other start, other end, words equal) of a chain aligned in word arrays, or, if less than ``IDENTITY``
    of the whole is equal, of its parts that reach it."""
    equal = 0
    for n, (x, y, size) in enumerate(zip(xs, ys, sizes, strict=True)):
        equal += int((a[x: x + size] == b[y: y + size]).sum())
        if n:
            px, py = xs[n - 1] + sizes[n - 1], ys[n - 1] + sizes[n - 1]
            equal += gap_matches(a[px:x], b[py:y])
    left_a, left_b, more = reach(grown(a[: xs[0]][::-1], b[: ys[0]][::-1]))
    ex, ey = xs[-1] + sizes[-1], ys[-1] + sizes[-1]
    right_a, right_b, most = reach(grown(a[ex:], b[ey:]))
    s, e, os, oe, equal = xs[0] - left_a, ex + right_a, ys[0] - left_b, ey + right_b, equal + more + most
    if e - s < least:
        return []
    if equal >= IDENTITY * max(e - s, oe - os):
        return [(s, e, os, oe, equal)]
    return parts_of(equal_runs(a, b, xs, ys, sizes), least)


def _aligned(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for r in batch.to_pylist():
            a, b = np.frombuffer(r["words"], "<u4"), np.frombuffer(r["other_words"], "<u4")
            dx, dy = r["first"], r["other_first"]
            for s, e, os, oe, equal in aligned(a, b, [x - dx for x in r["xs"]], [y - dy for y in r["ys"]], r["sizes"], least):
                found.append((r["doc_id"], r["tie"], s + dx, e + dx, r["other_id"], os + dy, oe + dy, equal))
        columns = zip(*found, strict=True) if found else [[]] * 8
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)],
                                         names=["doc_id", "tie", "start", "end", "other_id", "other_start", "other_end", "equal"])


def _covering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of passages sorted by document: each document's that cover ``K`` words that its longer ones don't."""
    held = None

    def out(rows: pa.Table) -> pa.Table:
        doc, tie, start, end, other = (rows[c].to_numpy() for c in ("doc_id", "tie", "start", "end", "other_id"))
        cuts = np.append(np.flatnonzero(_changes(doc, tie)), len(doc))
        keep = []
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            covered = np.zeros(int(end[lo:hi].max()), bool)
            for i in lo + np.lexsort((start[lo:hi], other[lo:hi], start[lo:hi] - end[lo:hi])):
                if (~covered[start[i]: end[i]]).sum() >= K:
                    covered[start[i]: end[i]] = True
                    keep.append(i)
        return rows.take(keep)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
        last = int(np.flatnonzero(_changes(rows["doc_id"].to_numpy(), rows["tie"].to_numpy()))[-1])
        if last:
            yield from out(rows.slice(0, last)).combine_chunks().to_batches()
        held = rows.slice(last)
    if held is not None:
        yield from out(held).combine_chunks().to_batches()


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each text, and where ``seeded`` is given the places of its other seeds, which are in no other text."""
    for batch in batches:
        hashes, counts = word_hashes(batch.column("text").to_pylist())
        packed = [x.astype("<u4").tobytes() for x in by_text(hashes & np.uint64(0xFFFFFFFF), counts)]
        grams, runs = shingle_hashes(hashes, counts, K)
        at, of = all_seeds(grams, runs)
        seeds = by_text(at - (np.cumsum(runs) - runs)[of], np.bincount(of, minlength=len(runs)))
        single = [None if seeded is None else np.setdiff1d(own, seeded, assume_unique=True).astype("<i4").tobytes()
                  for own, seeded in zip(seeds, batch.column("seeded").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), pa.array(packed, pa.binary()), pa.array(single, pa.binary())],
                                         names=["doc_id", "tie", "words", "single"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.hash("text").alias("tie"), F.col("text").cast("binary").alias("text"))


def shared_passages(docs: DataFrame, least: int = 50) -> DataFrame:
    """(doc_id, tie, start, end, other_id, other_start, other_end, equal), a row for each passage.

    Words ``start`` to ``end`` (counted from 0, end not included) of the document repeat a passage of ``other_id``, a
    document of smaller doc_id; ``equal`` of them are equal in order. A document's passages
    can overlap where they repeat different documents. ``tie`` is a hash of the text.

    Rows of equal doc_id are one source and aren't compared with each other. Null doc_id, null text and
    texts of fewer than ``least`` words have no passage. Empty table: empty result. Only doc_id and text are read.
    """
    spread = partitions(docs.sparkSession)
    texts = _texts(docs)
    seeds = texts.mapInArrow(lambda it: _seeds(least, it), "seed long, doc_id long, place long")
    matches = seeds.repartition(spread, "seed").sortWithinPartitions("seed", "doc_id", "place").mapInArrow(
        lambda it: _matches(gathered(it)), "doc_id long, place long, other_id long, other_place long")
    order = [F.shiftright("place", 32), "other_id", F.shiftright("other_place", 32), "place", "other_place"]
    found = checkpointed(matches.repartition(spread, "doc_id").sortWithinPartitions("doc_id", *order).mapInArrow(
        lambda it: _chained(least, gathered(it)),
        "doc_id long, tie int, other_id long, other_tie int, xs array<int>, ys array<int>, sizes array<int>"))
    chains = found.filter(F.col("ys").isNotNull())
    none = F.lit(None).cast("array<int>").alias("seeded")
    needed = chains.select("doc_id", "tie", none).unionByName(
        chains.select(F.col("other_id").alias("doc_id"), F.col("other_tie").alias("tie"), none)).unionByName(
        found.filter(F.col("ys").isNull()).select("doc_id", "tie", F.col("xs").alias("seeded"))).groupBy("doc_id", "tie").agg(
        F.first("seeded", ignorenulls=True).alias("seeded"))
    needed = checkpointed(needed)
    bits, marked = marked_spots(needed, "doc_id", "tie")

    @F.pandas_udf("boolean")
    def may_be_needed(spot: pd.Series) -> pd.Series:
        return pd.Series(is_marked(marked.value, spot.to_numpy()))

    some = texts.filter(may_be_needed(spot_of(bits, "doc_id", "tie")))
    both = checkpointed(some.join(needed, ["doc_id", "tie"]).dropDuplicates(["doc_id", "tie"]).mapInArrow(
        _words, "doc_id long, tie int, words binary, single binary"))
    words = both.drop("single")
    runs = both.filter(F.col("single").isNotNull()).mapInArrow(lambda it: _runs(least, it), "run long, doc_id long, place long")
    held = runs.repartition(spread, "run").sortWithinPartitions("run", "doc_id", "place").mapInArrow(
        lambda it: _first_held(gathered(it)), "doc_id long, place long, other_id long, other_place long")

    def low(column: str) -> Column:
        return F.col(column).bitwiseAND(0xFFFFFFFF)
    exact = held.repartition(spread, "doc_id").sortWithinPartitions(
        "doc_id", *order[:3], low("place") - low("other_place"), "place").mapInArrow(lambda it: _exact(least, gathered(it)), chains.schema)
    chains = chains.unionByName(exact)

    def cut(frame: DataFrame, starts: str, held: str, to: str, first_name: str) -> DataFrame:
        first = F.greatest(F.element_at(starts, 1) - MARGIN, F.lit(0))
        end = F.element_at(starts, -1) + F.element_at("sizes", -1) + MARGIN
        framed = frame.withColumn(first_name, first).withColumn("__end", end)
        return framed.withColumn(to, F.substring(held, F.col(first_name) * 4 + 1, (F.col("__end") - F.col(first_name)) * 4)).drop(
            "__end", held)

    # Both joins read words under new names, so that they share one exchange of them.
    other = words.toDF("_id", "_tie", "_words")
    own = words.toDF("_own_id", "_own_tie", "_own_words")
    with_other = cut(chains.join(other, (F.col("other_id") == F.col("_id")) & (F.col("other_tie") == F.col("_tie"))),
                     "ys", "_words", "other_words", "other_first").drop("_id", "_tie")
    with_both = cut(with_other.join(own, (F.col("doc_id") == F.col("_own_id")) & (F.col("tie") == F.col("_own_tie"))),
                    "xs", "_own_words", "words", "first").drop("_own_id", "_own_tie")
    schema = "doc_id long, tie int, start int, end int, other_id long, other_start int, other_end int, equal int"
    passages = with_both.mapInArrow(lambda it: _aligned(least, it), schema)
    return passages.repartition(spread, "doc_id").sortWithinPartitions("doc_id", "tie").mapInArrow(_covering, schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            if spans:
                data = np.frombuffer(text.translate(FOLD), np.uint8) != 32
                edge = np.flatnonzero(np.diff(np.concatenate(([False], data, [False])).astype(np.int8)))
                starts, ends = edge[::2], edge[1::2]
                keep = np.ones(len(text), bool)
                for s in spans:
                    keep[starts[s["start"]]: starts[s["end"]] if s["end"] < len(starts) else ends[-1]] = False
                text = np.frombuffer(text, np.uint8)[keep].tobytes()
            kept.append(None if text is None else text.decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()) if n == "text" else batch.column(n)
                                          for n in batch.schema.names], names=batch.schema.names)


def without_passages(docs: DataFrame, least: int = 50) -> DataFrame:
    """``docs`` with every passage taken out that repeats a document of smaller doc_id.

    Other rows are returned as they are, with all their columns, whatever their names. ``n_chars`` is counted anew where
    the text changed. Rows that had words and have none left go. A text is held whole by a task, however long.
    """
    spans = shared_passages(docs, least).groupBy("doc_id", "tie").agg(
        F.collect_set(F.struct("start", "end")).alias("spans")).withColumnRenamed("doc_id", "id")
    plain = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*plain).alias("row"), F.col("text").cast("binary").alias("text"), F.hash("text").alias("tie"),
                       F.col("doc_id").cast("long").alias("id")).join(spans, ["id", "tie"], "left").select("row", "text", "spans")
    fields = [rows.schema["row"], T.StructField("text", T.StringType()), rows.schema["spans"]]
    cut = rows.mapInArrow(_cut, T.StructType(fields))
    changed = F.col("spans").isNotNull()
    left = cut.filter(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.select(*(F.col("text") if c == "text" else
                         F.when(changed, F.length("text").cast(docs.schema[c].dataType)).otherwise(F.col("row")[c]).alias(c)
                         if c == "n_chars" else F.col("row")[c].alias(c) for c in docs.columns))
