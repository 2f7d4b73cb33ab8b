"""LM scoring by a hierarchical Pitman-Yor model, seated by Gibbs sampling in blocks.

Every token is a customer of the restaurant of its context: the word before it, told apart by 63 bits of its hash. The
restaurants share one parent: each table they open sends a customer there. The parent's base is uniform over the V
training words and one for all unknown words.

Blocks of documents send their distinct (word, context) pairs, with how often they learn them, to shards of words, as
packed arrays: a shard has all occurrences of its words, in every context, so a word's dishes and its tables in the
parent are seated together. A context's dishes lie in many shards, so its totals are exchanged by context, twice.

- Every shard is seated for the burn-in, and tells the customers and the tables of each of its contexts. These are added up by
  context, and each shard gets the sums for the contexts that it told.
- Every shard goes on from there, by the same seed. In the sweeps of the samples a context has the tables that all other shards told,
  and its own as they are now. The tables of each sample are told and added up in the same way.
- Every shard is seated once more, by the same seed and sums, and turns each sample's tables and totals into predictive probabilities.
  Their average over samples, for each pair that a block sent, goes back to the block, which adds it up by document.

This approximates Gibbs sampling: all customers of a dish leave at once and are seated anew at the weights of the sweep
before, and the tables of other shards are those after the burn-in. In the burn-in alone, a shard takes others to be like itself.

Shards are cut by the size of the corpus and seeded by their number, so scores do not depend on Spark's partitions.
A shard keeps messages packed and unpacks one at a time. A pair is one entry of a block's message, however often it
occurs, and the answer is a number for each entry, so neither grows with the documents that ask times the shards. A block's own
row tells which pair each of its tokens is. What is gathered grows with the corpus: every word of every document takes part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import partitions
from .words import word_hashes

CLASSES = 2 ** 8, 2 ** 26                  # least and most classes that contexts are dealt to when their totals are added up
BYTES_OF_CLASS = 2 ** 13                  # text for each class between these
BYTES_OF_SHARD = 2 ** 24
SLICE = 4096                              # classes of one row of totals
END = np.uint64(0x2545F4914F6CDD1D)       # the token that ends a text; also the context of the first
BLOCK = 3_000_000                         # tokens of one block
BURN, SAMPLES = 3, 4
DISCOUNT, STRENGTH = 0.8, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.7, 1.0
SINGLY = 16                               # customers of a dish seated one by one; later ones in runs


def sizes_for(n_bytes: int) -> tuple[int, int]:
    """(shards of words, classes of contexts) for so much text: powers of two that grow with it."""
    def power(x: float) -> int:
        return 1 << max(0, int(np.ceil(np.log2(max(x, 1)))))

    return power(n_bytes / BYTES_OF_SHARD), min(max(power(n_bytes / BYTES_OF_CLASS), CLASSES[0]), CLASSES[1])


def tokens_of(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hash, context, tokens of each text): words, then one end; the context is the word before, by 63 bits of its hash."""
    hashes, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    tokens = np.insert(hashes, ends, END)
    before = np.insert(hashes, ends - counts, END)
    return tokens, (before >> np.uint64(1)).astype(np.int64), counts + 1


def least_type(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def packed(x: np.ndarray) -> bytes:
    """Whole numbers in the least unsigned type that holds them, whose size is the first byte."""
    x = least_type(x)
    return bytes([x.itemsize]) + x.tobytes()


def unpacked(b: bytes) -> np.ndarray:
    return np.frombuffer(b, f"<u{b[0]}", offset=1).astype(np.int64)


def planes(x: np.ndarray) -> bytes:
    """Whole numbers, least bytes of all first: high bytes that are mostly zero lie together."""
    x = np.ascontiguousarray(x, "<u8")
    size = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return bytes([size]) + x.view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes()


def from_planes(b: bytes) -> np.ndarray:
    out = np.zeros(((len(b) - 1) // b[0], 8), np.uint8)
    out[:, : b[0]] = np.frombuffer(b, np.uint8, offset=1).reshape(b[0], -1).T
    return out.view("<i8").ravel()


def rising(x: np.ndarray) -> bytes:
    """Ascending whole numbers by their differences."""
    return planes(np.diff(x, prepend=0))


def risen(b: bytes) -> np.ndarray:
    return np.cumsum(from_planes(b))


MESSAGE = "bucket int, block long, mark long, words binary, each binary, heads binary, contexts binary, counts binary"
OWN = "block long, mark long, ids array<long>, train binary, sizes binary, each binary, pairs binary"


def batch_of(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    names, types = zip(*(x.split() for x in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], names=list(names))


def table_of(schema: str, rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([batch_of(schema, rows)])


def _messages(buckets: int, own: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block: its messages to shards, or its own row. Words ascend in a block, so shards have ranges of its pairs."""
    part, made, held, size = TaskContext.get().partitionId(), 0, [], 0

    def block(rows: list[tuple]) -> pa.RecordBatch:
        nonlocal made
        tokens, contexts, sizes, ids, train = (np.concatenate(x) if i != 3 else [v for y in x for v in y]
                                               for i, x in enumerate(zip(*rows, strict=True)))
        mark, number, made = xxhash.xxh64_intdigest(tokens.tobytes()) >> 1, (part << 32) + made, made + 1
        words, at = np.unique(tokens, return_inverse=True)
        heads, of = np.unique(contexts, return_inverse=True)
        pairs, at = np.unique(at * len(heads) + of, return_inverse=True)
        word, head = pairs // len(heads), pairs % len(heads)
        each = np.bincount(word, minlength=len(words))
        if own:
            return batch_of(OWN, [(number, mark, ids, train.astype(np.uint8).tobytes(), packed(sizes), planes(each), planes(at))])
        counts = np.bincount(at, np.repeat(train, sizes), len(pairs)).astype(np.int64)
        cuts = np.searchsorted(((words >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets + 1).astype(np.uint64))
        bounds = np.searchsorted(word, cuts)
        out = []
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            w, e = slice(cuts[b], cuts[b + 1]), slice(bounds[b], bounds[b + 1])
            some, contexts = np.unique(head[e], return_inverse=True)
            out.append((b, number, mark, words[w].tobytes(), planes(each[w]), rising(heads[some]), planes(contexts), planes(counts[e])))
        return batch_of(MESSAGE, out)

    for batch in batches:
        tokens, contexts, sizes = tokens_of(batch.column("text").to_pylist())
        if len(sizes):
            held.append((tokens, contexts, sizes, batch.column("doc_id").to_pylist(),
                         batch.column("train").to_numpy(zero_copy_only=False)))
            size += len(tokens)
        if size >= BLOCK:
            yield block(held)
            held, size = [], 0
    if held:
        yield block(held)


def seated(customers: np.ndarray, opening: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables that the customers of each dish take when all leave and are seated anew in turn.

    A customer opens a table with weight ``opening`` and joins one with weight (customers - discount * tables)
    of those seated before. From the ``SINGLY``-th on they come in runs, each as long as half of those seated, at the
    rate that holds when the run starts.
    """
    tables = np.minimum(customers, 1)
    at, seats = np.flatnonzero(customers > 1), 1
    while len(at):
        run = np.minimum(1 if seats < SINGLY else seats // 2, customers[at] - seats)
        weight = opening[at]
        tables[at] += rng.binomial(run, weight / (seats - discount * tables[at] + weight))
        seats += 1 if seats < SINGLY else seats // 2
        at = at[customers[at] > seats]
    return tables


def told(numbers: np.ndarray) -> bytes:
    """Customers and tables of contexts; each row by its difference from the one before, which is mostly small."""
    x = np.diff(numbers, axis=0, prepend=0).ravel()
    return planes((x << 1) ^ (x >> 63))


def heard(b: bytes, rows: int = 1 + SAMPLES) -> np.ndarray:
    x = from_planes(b)
    return np.cumsum(((x >> 1) ^ -(x & 1)).reshape(rows, -1), axis=0)


class Totals:
    """Whole numbers summed over shards: N, V, for each of ``samples`` seatings the parent's customers and tables; and of each
    context its customers and, for each seating, its tables. ``classes`` deal contexts to rows."""

    def __init__(self, classes: int, samples: int = SAMPLES):
        self.classes, self.few = classes, np.zeros(2 + 2 * samples, np.int64)
        self.contexts, self.numbers, self.held = np.zeros(0, np.int64), np.zeros((1 + samples, 0), np.int64), []

    def settle(self) -> None:
        if self.held:
            all_, numbers = (np.concatenate(x, axis=-1) for x in zip((self.contexts, self.numbers), *self.held, strict=True))
            self.contexts, at = np.unique(all_, return_inverse=True)
            self.numbers = np.stack([np.bincount(at, x, len(self.contexts)) for x in numbers]).astype(np.int64)
            self.held = []

    def of(self, contexts: np.ndarray) -> np.ndarray:
        """Customers and tables of contexts that are there."""
        self.settle()
        return self.numbers[:, np.searchsorted(self.contexts, contexts)]

    def parted(self) -> tuple[Totals, Totals]:
        """(those of the first seating, those of the others)."""
        self.settle()
        first, rest = Totals(self.classes, 1), Totals(self.classes, len(self.numbers) - 2)
        first.contexts = rest.contexts = self.contexts
        first.few, rest.few = self.few[:4], np.delete(self.few, [2, 3])
        first.numbers, rest.numbers = self.numbers[:2], np.delete(self.numbers, 1, axis=0)
        return first, rest

    def slices(self, contexts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(slice, which of ``contexts`` are its)."""
        of = (contexts & (self.classes - 1)) // SLICE
        order = np.argsort(of, kind="stable")
        cuts = np.flatnonzero(np.diff(of[order], prepend=-1))
        for at in np.split(order, cuts[1:]) if len(order) else ():
            yield int(of[at[0]]), at

    def rows(self) -> Iterator[tuple[int, bytes, bytes]]:
        yield -1, b"", planes(self.few)
        self.settle()
        for slice_, at in self.slices(self.contexts):
            yield slice_, rising(self.contexts[at]), told(self.numbers[:, at])

    def add(self, slice_: int, contexts: bytes, numbers: bytes) -> None:
        if slice_ < 0:
            self.few += from_planes(numbers)
        else:
            self.held.append((risen(contexts), heard(numbers, len(self.numbers))))


class Bucket:
    """All messages of one shard of words, kept packed: its dishes, and who asks for them."""

    def __init__(self, number: int, buckets: int, classes: int, rows: list[dict]):
        self.rows, self.buckets, self.classes = rows, buckets, classes
        self.words = np.unique(np.concatenate([np.frombuffer(r["words"], np.uint64) for r in rows]))
        self.heads = np.unique(np.concatenate([self.heads_of(r) for r in rows]))
        dishes, customers, held, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0
        for i, r in enumerate(rows):
            keys, starts = self.runs(r)
            learnt = self.learnt(r)
            held.append((keys, np.add.reduceat(learnt, starts) if len(starts) else learnt))
            size += len(keys)
            if size > len(dishes) or i == len(rows) - 1:
                dishes, at = np.unique(np.concatenate([dishes, *(k for k, _ in held)]), return_inverse=True)
                customers = np.bincount(at, np.concatenate([customers, *(c for _, c in held)]), len(dishes)).astype(np.int64)
                held, size = [], 0
        self.dishes, self.customers = dishes, customers
        self.word, self.head = dishes // len(self.heads), dishes % len(self.heads)
        self.known = np.bincount(self.word, customers, len(self.words)).astype(np.int64)
        self.rng = np.random.default_rng([number, buckets])

    @property
    def context(self) -> np.ndarray:
        return self.heads[self.head]

    @staticmethod
    def heads_of(r: dict) -> np.ndarray:
        """A message's contexts: by name, or as its entries have them if it tells no names."""
        return risen(r["heads"]) if "heads" in r else np.unique(unpacked(r["contexts"]))

    @staticmethod
    def learnt(r: dict) -> np.ndarray:
        """How often each entry is learnt; of a message that names its documents, those that are learnt from count."""
        if "docs" not in r:
            return from_planes(r["counts"])
        return np.where(np.frombuffer(r["train"], np.uint8)[unpacked(r["docs"])] > 0, unpacked(r["counts"]), 0)

    def runs(self, r: dict) -> tuple[np.ndarray, np.ndarray]:
        """(word and context of each run of a message's entries, ascending; where the run starts)."""
        at, heads = np.searchsorted(self.words, np.frombuffer(r["words"], np.uint64)), np.searchsorted(self.heads, self.heads_of(r))
        if "heads" in r:
            each, contexts = from_planes(r["each"]), heads[from_planes(r["contexts"])]
        else:
            each, contexts = unpacked(r["each"]), np.searchsorted(self.heads, unpacked(r["contexts"]))
        keys = np.repeat(at, each) * len(self.heads) + contexts
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[starts], starts

    def per_head(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.head, x, len(self.heads)).astype(np.int64)

    def sweeps(self, begun: Totals | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(tables of each dish, customers and tables of each word in the parent): after the burn-in, then a sample at a time.

        ``begun`` has what all shards told after the burn-in. From there on a context has the tables of the other shards, and
        its own as they are now; the parent likewise. Before, and without ``begun``, other shards are taken to be like this one: words are
        dealt by hash, and a context's tables are those of the dish itself and, for each shard, those of the context's other dishes here.
        """
        n, words = self.buckets, len(self.words)
        v, theirs = (self.known > 0).sum() * n, None
        tables = np.minimum(self.customers, 1)
        up = np.bincount(self.word, tables, words).astype(np.int64)
        top = np.minimum(up, 1)
        for sweep in range(BURN + SAMPLES):
            if begun is not None and sweep == BURN:
                v, theirs = begun.few[1], begun.of(self.heads)[1] - self.per_head(tables)
                up_there, top_there = begun.few[2] - up.sum(), begun.few[3] - top.sum()
            here = self.per_head(tables)
            if theirs is None:
                all_tables, all_up, all_top = tables + n * (here[self.head] - tables), up.sum() * n, top.sum() * n
            else:
                all_tables, all_up, all_top = (theirs + here)[self.head], up_there + up.sum(), top_there + top.sum()
            of_base = (ROOT_STRENGTH + ROOT_DISCOUNT * all_top) * (1.0 / (v + 1))
            root = (up - ROOT_DISCOUNT * top + of_base) / (ROOT_STRENGTH + all_up)
            tables = seated(self.customers, (STRENGTH + DISCOUNT * all_tables) * root[self.word], DISCOUNT, self.rng)
            up = np.bincount(self.word, tables, words).astype(np.int64)
            top = seated(up, np.full(words, of_base), ROOT_DISCOUNT, self.rng)
            if sweep >= BURN - 1:
                yield tables, up, top

    def samples(self, begun: Totals | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """:meth:`sweeps` without the burn-in."""
        return islice(self.sweeps(begun), 1, None)

    def begin(self, totals: Totals) -> None:
        """Add what this shard tells after the burn-in."""
        self._tell(totals, [next(self.sweeps())])

    def add_to(self, totals: Totals, begun: Totals | None = None) -> None:
        """Add what this shard tells of the samples."""
        self._tell(totals, self.samples(begun))

    def _tell(self, totals: Totals, seatings: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        numbers, few = [self.per_head(self.customers)], [self.customers.sum(), (self.known > 0).sum()]
        for tables, up, top in seatings:
            numbers.append(self.per_head(tables))
            few += [up.sum(), top.sum()]
        totals.held.append((self.heads, np.stack(numbers)))
        totals.few += np.array(few)

    def probabilities(self, totals: Totals, begun: Totals | None = None) -> np.ndarray:
        """Of each dish: the predictive probability of its word after its context, averaged over samples."""
        p, v, ups = np.zeros(len(self.dishes)), totals.few[1], totals.few[2:].reshape(SAMPLES, 2)
        customers, *of_heads = totals.of(self.heads)
        for (tables, up, top), of_head, (all_up, all_top) in zip(self.samples(begun), of_heads, ups, strict=True):
            root = (up - ROOT_DISCOUNT * top + (ROOT_STRENGTH + ROOT_DISCOUNT * all_top) / (v + 1)) / (ROOT_STRENGTH + all_up)
            share = (STRENGTH + DISCOUNT * of_head[self.head]) * root[self.word]
            p += (self.customers - DISCOUNT * tables + share) / (STRENGTH + customers[self.head])
        return p / SAMPLES

    def answers(self, totals: Totals, begun: Totals | None = None) -> Iterator[tuple[dict, np.ndarray, np.ndarray, np.ndarray]]:
        """For each message: how often its words are learnt, and of its runs the log10 probability and where they start."""
        logs = np.log10(self.probabilities(totals, begun))
        for r in self.rows:
            keys, starts = self.runs(r)
            yield r, self.known[np.searchsorted(self.words, np.frombuffer(r["words"], np.uint64))], logs[np.searchsorted(self.dishes, keys)], starts

    def scores(self, totals: Totals) -> Iterator[tuple[dict, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each message that names its documents: these, and their parts of base_score, score and n_known."""
        for r, known, logs, starts in self.answers(totals):
            asked, docs = unpacked(r["counts"]), unpacked(r["docs"])
            known = np.repeat(known, unpacked(r["each"]))
            logs = np.repeat(logs, np.diff(starts, append=len(docs)))
            some, at = np.unique(docs, return_inverse=True)
            yield r, some, *(np.bincount(at, x * asked, len(some)) for x in (base_of(known, totals.few), logs, known > 0))


def base_of(known: np.ndarray, few: np.ndarray) -> np.ndarray:
    """log10 probability of words that are learnt so often, by the unigram model."""
    n, v = few[:2]
    return np.log10((known + 0.5) / (n + 0.5 * (v + 1)))


TOLD = "bucket int, slice int, contexts binary, numbers binary"
SUMS = "bucket int, slice int, numbers binary"
ANSWER = "block long, bucket int, mark long, known binary, logs binary, few binary"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _begun(buckets: int, classes: int, messages: pa.Table) -> pa.Table:
    """Of a shard's messages: the totals of its contexts after the burn-in, a row for each slice."""
    rows, totals = messages.to_pylist(), Totals(classes, 1)
    Bucket(rows[0]["bucket"], buckets, classes, rows).begin(totals)
    return table_of(TOLD, [(rows[0]["bucket"], *r) for r in totals.rows()])


def _summed(classes: int, told_: pa.Table) -> pa.Table:
    """Of what shards told of a slice: the sums over shards, to each shard for its own contexts in their order."""
    totals, rows = Totals(classes, 1), told_.to_pylist()
    for r in rows:
        totals.add(r["slice"], r["contexts"], r["numbers"])
    return table_of(SUMS, [(r["bucket"], r["slice"], planes(totals.few) if r["slice"] < 0 else told(totals.of(risen(r["contexts"])))) for r in rows])


def _totals_of(bucket: Bucket, sums: pa.Table, samples: int) -> Totals:
    """The sums that a shard got for its contexts."""
    totals, numbers = Totals(bucket.classes, samples), {r["slice"]: r["numbers"] for r in sums.to_pylist()}
    totals.few += from_planes(numbers[-1])
    totals.held = [(bucket.heads[at], heard(numbers[slice_], 1 + samples)) for slice_, at in totals.slices(bucket.heads)]
    return totals


def _learnt(buckets: int, classes: int, messages: pa.Table, sums: pa.Table) -> pa.Table:
    """Of a shard's messages and the sums after the burn-in: the tables of its contexts in each sample, a row for each slice, without names."""
    rows, totals = messages.to_pylist(), Totals(classes)
    bucket = Bucket(rows[0]["bucket"], buckets, classes, rows)
    bucket.add_to(totals, _totals_of(bucket, sums, 1))
    return table_of(TOLD, [(rows[0]["bucket"], -1, b"", planes(totals.few[2:]))]
                    + [(rows[0]["bucket"], slice_, b"", told(totals.of(bucket.heads[at])[1:])) for slice_, at in totals.slices(bucket.heads)])


def _summed_all(classes: int, begun: pa.Table, told_: pa.Table) -> pa.Table:
    """Of what shards told of a slice, after the burn-in and of the samples: as :func:`_summed`, one seating after the other."""
    totals, rows = Totals(classes, 1 + SAMPLES), []
    later = {r["bucket"]: r["numbers"] for r in told_.to_pylist()}
    for r in begun.to_pylist():
        if r["slice"] < 0:
            totals.few += np.concatenate([from_planes(r["numbers"]), from_planes(later[r["bucket"]])])
            contexts = None
        else:
            contexts = risen(r["contexts"])
            totals.held.append((contexts, np.concatenate([heard(r["numbers"], 2), heard(later[r["bucket"]], SAMPLES)])))
        rows.append((r["bucket"], r["slice"], contexts))
    return table_of(SUMS, [(b, slice_, planes(totals.few) if contexts is None else told(totals.of(contexts))) for b, slice_, contexts in rows])


def _answers(buckets: int, classes: int, messages: pa.Table, sums: pa.Table) -> pa.Table:
    """Of a shard's messages and the sums for its contexts: an answer to each block."""
    rows = messages.to_pylist()
    bucket = Bucket(rows[0]["bucket"], buckets, classes, rows)
    begun, totals = _totals_of(bucket, sums, 1 + SAMPLES).parted()
    return table_of(ANSWER, [(r["block"], r["bucket"], r["mark"], planes(known), logs.astype("<f4").tobytes(), planes(totals.few))
                             for r, known, logs, _ in bucket.answers(totals, begun)])


def _scored(own: pa.Table, answers: pa.Table) -> pa.Table:
    """Of a block's own row and the answers of all shards to it: a row for each document."""
    block, = own.to_pylist()
    rows = sorted(answers.to_pylist(), key=lambda r: r["bucket"])
    each, pairs, sizes = from_planes(block["each"]), from_planes(block["pairs"]), unpacked(block["sizes"])
    known = np.concatenate([from_planes(r["known"]) for r in rows])
    logs = np.concatenate([np.frombuffer(r["logs"], "<f4") for r in rows]).astype(np.float64)
    if {r["mark"] for r in rows} != {block["mark"]} or len(known) != len(each):
        raise ValueError("the rows came in another order when they were read again; checkpoint them first")
    few, starts = from_planes(rows[0]["few"]), np.cumsum(sizes) - sizes
    words = np.repeat(np.arange(len(each)), each)
    base, score, n_known = (np.add.reduceat(x[pairs], starts) for x in (base_of(known, few)[words], logs, (known > 0).astype(np.int64)[words]))
    return pa.table([pa.array(block["ids"], pa.int64()), pa.array(np.frombuffer(block["train"], np.uint8) == 0), pa.array(sizes), pa.array(n_known),
                     pa.array(np.full(len(sizes), few[0])), pa.array(base), pa.array(score)], names=[x.split()[0] for x in RESULT.split(", ")])


def score(docs: DataFrame, learn_from: Column, shards: int | None = None, classes: int | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row's whole text.

    Tokens are words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, then one end. Rows for which
    ``learn_from`` holds are learnt from, the others are held out. ``score`` is the log10 probability of
    the tokens, ``base_score`` that of a unigram model with 0.5 added to all counts. ``shards`` and ``classes``, powers of
    two, are set by the size of all texts unless they are given; contexts are dealt to ``classes`` only to add up their totals.

    Null text: empty, so only the end. Repeated rows are each learnt from and scored. Null doc_id: a row
    like others. Empty table: empty result. Very long texts are whole within one block. Only doc_id, text and what ``learn_from`` names are read.
    Rows are read twice and must come in the same order; if they don't, the job fails and says so. A pair's log10 probability has single precision.
    """
    spark = docs.sparkSession
    for_size = sizes_for(docs.agg(F.sum(F.octet_length(F.col("text").cast("binary")))).first()[0] or 0)
    buckets, classes = shards or for_size[0], classes or for_size[1]
    tasks = max(partitions(spark), buckets)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                        F.coalesce(learn_from, F.lit(False)).alias("train"))

    messages = texts.mapInArrow(lambda it: _messages(buckets, False, it), MESSAGE).repartition(tasks, "bucket")
    begun = messages.groupBy("bucket").applyInArrow(lambda t: _begun(buckets, classes, t), TOLD).repartition(tasks, "slice")
    first = begun.groupBy("slice").applyInArrow(lambda t: _summed(classes, t), SUMS).repartition(tasks, "bucket")
    told_ = messages.groupBy("bucket").cogroup(first.groupBy("bucket")).applyInArrow(
        lambda a, b: _learnt(buckets, classes, a, b), TOLD).repartition(tasks, "slice")
    sums = begun.groupBy("slice").cogroup(told_.groupBy("slice")).applyInArrow(
        lambda a, b: _summed_all(classes, a, b), SUMS).repartition(tasks, "bucket")
    answers = messages.groupBy("bucket").cogroup(sums.groupBy("bucket")).applyInArrow(lambda a, b: _answers(buckets, classes, a, b), ANSWER)
    own = texts.mapInArrow(lambda it: _messages(buckets, True, it), OWN)
    return own.repartition(tasks, "block").groupBy("block").cogroup(answers.repartition(tasks, "block").groupBy("block")).applyInArrow(_scored, RESULT)
