"""N-gram Jaccard join: a blocked sparse matrix product of documents by
n-grams.

The incidence matrix has a row for each distinct shingle set and a column for
each shingle. It is cut into blocks of rows, and within a block the product of
the rows with each other accumulates their overlaps; pairs below the bound that
their sizes set are discarded, and the rest are links.

*Blocks.* Rows of sizes n and m that link differ in at most
``d = (n + m) (den - num) / (den + num)`` columns. The columns are dealt by hash
into two and a half times as many parts, so all but d parts are the same in both rows.
In any fixed order of the parts both rows share k of their first d + k, and
these are a row's keys. Two rows that share k keys are joined: one shared passage
gives a few keys, so chains of passages do not run through the corpus. A key of
many rows, which would make too many pairs, joins its rows by itself. Parts come first that hold a rare column, and many of
them; those of frequent columns alone say little and come last, by counts over
the whole corpus. (Cells of row sizes have their own numbers of parts, and a row
near the end of a cell has the keys of the next one too.) Rows that are
joined make a block; every link lies in one. Keys of many rows are combined in
the task that makes them, so a part that a third of all rows share leaves each
task once.

*Products.* Blocks of a bounded size are multiplied in one task. A larger one is
cut into slices: each slice is multiplied by itself; the rows of most links in
any slice are then multiplied with all slices; and rows outside the block's
largest component at last with all slices, tile by tile. Rows that are already
in one component need no product, so a group of near copies costs about one
pass. No link that could change a component is left out.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.llm.common import bounded_batches, dropped, lean, parts, written
from annospark.llm.graph import components

#: Factor from one cell of row sizes to the next.
CELL_GROWTH = 1.6
#: Columns of at least so many rows count as frequent, and so many of the most
#: frequent ones are known to all tasks (12 bytes each). Columns are counted in
#: stretches of so many ones; in each, what has fewer rows than LEAST_COUNT is
#: left out. Any such table gives the same links.
FREQUENT, FREQUENT_KEPT, STRETCH, LEAST_COUNT = 32, 1_000_000, 1 << 21, 3
#: Keys that a task combines at once, and signatures whose keys it remembers to
#: have sent (a forgotten one is sent again).
KEYS_AT_ONCE, SIGNATURES_KEPT = 1 << 20, 200_000
#: Keys of up to so many rows count for each pair of them; so much is the count
#: of a pair that has all keys it needs, and so many counts a task adds up at once.
PAIRED, WHOLE, PAIRS_AT_ONCE = 16, 1 << 20, 1 << 20
#: Entries of keys that are joined at once.
KEYS_JOINED = 1 << 16
#: Edges that a task reduces to a spanning forest at once.
EDGES_AT_ONCE = 1 << 20
#: Bits of the sieve for the rows that are in blocks, at most (8 MB).
SIEVE_BITS = 1 << 26
#: Rows and bytes of hashes that are multiplied with each other at most.
BLOCK_ROWS, BLOCK_BYTES = 3072, 24 << 20
#: Rows of a block that are tried as its centre before the product, and those
#: of most links that a slice names.
CENTRES = 8
#: Columns of up to so many rows add their pairs one by one; those of more rows
#: are multiplied, so many at once.
LIGHT, DENSE_COLUMNS = 16, 2048
#: Kinds of rows in the table of keys: a key, an edge between rows of one block.
#: All other values are a document's size, or -3 less it where the id is null,
#: the key of many rows of a task, or PAIR less what two rows have of WHOLE.
KEY, EDGE, CROWD, PAIR = -1, -2, -(1 << 40), -(1 << 41)

_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Where a key holds its cell.
_CELL = np.uint64(63)


_NEXT_BLANK = re.compile(rb"[\t-\r ]")
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
#: Bytes of text that are hashed together.
GROUP_BYTES = 1 << 18
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, GROUP_BYTES) * 5 // 4
        _powers.clear()
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size + 1, base, np.uint64)
            table[0] = 1
            _powers.append(np.multiply.accumulate(table))
    return _powers


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts and its 64-bit hash, for bytes that end blank:
    differences of one running sum of powers, so a word costs nothing by
    itself."""
    up, down = _power_tables(len(data) + 1)
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(blank.view(np.int8), prepend=1))
    starts, ends = edge[::2], edge[1::2]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[: len(data)], out=total[1:])
    words = (total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)
    words ^= words >> np.uint64(32)
    words *= _MIX
    return starts, words ^ words >> np.uint64(29)


def shingle_sets(texts: list[str | None], shingle: int) -> list[np.ndarray]:
    """For each text the ascending distinct 64-bit hashes of its shingles:
    ``shingle`` words (separated by ASCII white space, A-Z lower-cased), or a
    shorter text's words as one; empty without words."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    size = 0
    for text in texts:
        raw = text.encode().lower() if text else b""  # bytes.lower() changes A-Z alone
        if len(raw) > 4 * GROUP_BYTES:
            out += _group_sets(group, shingle)
            out.append(_long_set(raw, shingle))
            group, size = [], 0
            continue
        group.append(raw)
        size += len(group[-1]) + 1
        if size >= GROUP_BYTES:
            out += _group_sets(group, shingle)
            group, size = [], 0
    return out + _group_sets(group, shingle)


def _group_sets(raw: list[bytes], shingle: int) -> list[np.ndarray]:
    if not raw:
        return []
    starts, words = _word_hashes(np.frombuffer(b" ".join(raw) + b" ", np.uint8))
    past = np.cumsum([len(r) + 1 for r in raw])
    bounds = np.concatenate(([0], np.searchsorted(starts, past)))
    rolled = _rolled(words, shingle)
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        n = hi - lo
        out.append(np.unique(rolled[lo : hi - shingle + 1] if n >= shingle else _rolled(words[lo:hi], n)) if n else np.zeros(0, np.uint64))
    return out


def _long_set(raw: bytes, shingle: int) -> np.ndarray:
    """The set of a long text, its words hashed piece by piece."""
    words, at = [], 0
    while at < len(raw):
        blank = _NEXT_BLANK.search(raw, at + GROUP_BYTES)
        end = blank.start() if blank else len(raw)
        words.append(_word_hashes(np.frombuffer(raw[at:end] + b" ", np.uint8))[1])
        at = end
    every = np.concatenate(words)
    return np.unique(_rolled(every, min(shingle, len(every)))) if len(every) else every


def _rolled(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k words."""
    n = max(0, len(words) - k + 1)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = (out ^ words[j : j + n]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _signature(hashes: np.ndarray) -> int:
    """A set's own hash, its size included."""
    return int.from_bytes(blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


class Cells:
    """Cells of row sizes, each with its number of parts. ``frequent``: frequent
    columns, ascending, and their counts."""

    def __init__(self, num: int, den: int, frequent: tuple[np.ndarray, np.ndarray] | None = None):
        self.frequent = frequent if frequent and len(frequent[0]) else None
        tops = [1]
        while tops[-1] < 1 << 31:
            tops.append(max(tops[-1] + 1, int(tops[-1] * CELL_GROWTH)))
        self.num, self.den = num, den
        self.tops = np.array(tops)
        #: how many columns two rows of a cell may differ in and still link
        self.differ = 2 * self.tops * (den - num) // (den + num)
        self.parts = (2 + self.differ * 5 // 2).astype(np.uint64)
        #: how many keys two rows of a cell share at least where they link
        self.need = 1 + self.differ // 8

    def keys(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Keys, and for each the place of its row in ``sets``. Equal rows need
        none; a row that links with no other than its equals yields none."""
        n = np.array([len(s) for s in sets], np.int64)
        counts = [self._counts(s) for s in sets]
        first = np.searchsorted(self.tops, n)
        last = np.searchsorted(self.tops, n * self.den // self.num)
        keys, owners = [], []
        for cell in range(int(first.min(initial=0)), int(last.max(initial=0)) + 1):
            here = np.flatnonzero((first <= cell) & (cell <= last) & (n > 0))
            if len(here) and self.differ[cell]:
                k, o = self._cell_keys([sets[i] for i in here], [counts[i] for i in here], cell)
                keys.append(k)
                owners.append(here[o])
        if not keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(keys), np.concatenate(owners)

    def _counts(self, row: np.ndarray) -> np.ndarray:
        """The counts of a row's frequent columns, 0 for the others."""
        if self.frequent is None:
            return np.zeros(len(row), np.int32)
        column, count = self.frequent
        at = np.minimum(np.searchsorted(column, row), len(column) - 1)
        return np.where(column[at] == row, count[at], np.int32(0))

    def _cell_keys(self, sets: list[np.ndarray], counts: list[np.ndarray], cell: int) -> tuple[np.ndarray, np.ndarray]:
        count, most = self.parts[cell], int(self.differ[cell] + self.need[cell])
        token = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        part = (token >> np.uint64(32)) * count >> np.uint64(32)  # ascending in each row, as its hashes are
        new = np.ones(len(token), bool)
        new[1:] = (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(token)))
        mixed = token ^ token >> np.uint64(29)
        mixed *= _MIX
        total = np.add.reduceat(mixed ^ mixed >> np.uint64(32), start)
        often = np.concatenate(counts)
        least, rare = np.minimum.reduceat(often, start), np.add.reduceat((often == 0).astype(np.int64), start)
        owner, part = owner[start], part[start]
        key = _part_keys(total, part, size, cell)
        order = np.lexsort((key, -np.where(rare, rare, size), least, owner))
        owner, key = owner[order], key[order]
        filled = np.bincount(owner, minlength=len(sets))
        keep = np.arange(len(owner)) - (np.cumsum(filled) - filled)[owner] < most
        owner, key = owner[keep], key[keep]
        bare = np.flatnonzero(filled < most)  # rows whose shared parts may be empty ones
        if len(bare):
            ends = np.cumsum(filled)
            empty = [np.setdiff1d(np.arange(count, dtype=np.uint64), part[ends[i] - filled[i] : ends[i]]) for i in bare]
            key = np.concatenate([key, *(_part_keys(np.zeros_like(e), e, np.zeros(len(e), np.int64), cell) for e in empty)])
            owner = np.concatenate([owner, np.repeat(bare, [len(e) for e in empty])])
        return key, owner


def _part_keys(total: np.ndarray, part: np.ndarray, size: np.ndarray, cell: int) -> np.ndarray:
    out = (total ^ part * np.uint64(0xD6E8FEB86659FD93)) * _MIX + size.astype(np.uint64) + np.uint64(cell << 40)
    out ^= out >> np.uint64(31)
    out *= _MIX
    return (out ^ out >> np.uint64(29)) & ~_CELL | np.uint64(cell)


def _united(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Components, as the smallest place in each, after linking places a and b;
    ``root``: the components before."""
    root = root.copy()
    while True:
        x, y = root[a], root[b]
        differ = x != y
        if not differ.any():
            return root
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while ((then := root[root]) != root).any():
            root = then


def _combined(key: np.ndarray, owner: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, ...]:
    """The keys of a task with their rows: a, b, n. A key of many rows has one
    entry, and edges that join them."""
    order = np.argsort(key, kind="stable")
    key, owner = key[order], owner[order]
    first = np.ones(len(key), bool)
    first[1:] = key[1:] != key[:-1]
    start = np.flatnonzero(first)
    size = np.diff(np.append(start, len(key)))
    many = np.repeat(size > PAIRED, size)
    again = np.flatnonzero(~first & many)
    root = _united(np.arange(len(sig)), owner[again - 1], owner[again])
    moved = np.flatnonzero(root != np.arange(len(sig)))
    few, crowd = ~many, first & many
    a = np.concatenate((key[few].view(np.int64), key[crowd].view(np.int64), sig[moved]))
    b = np.concatenate((sig[owner[few]], sig[root[owner[crowd]]], sig[root[moved]]))
    return a, b, np.repeat([KEY, CROWD, EDGE], [few.sum(), crowd.sum(), len(moved)])


_TRIPLE = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
_TRIPLE_DDL = "a bigint, b bigint, n bigint"


def _triples(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_TRIPLE)


def _frequent(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent columns, ascending, and their counts. Copies count
    about once in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, held, size = set(), [], 0

        def counted() -> pa.RecordBatch:
            column, count = np.unique(np.concatenate(held), return_counts=True)
            keep = count >= LEAST_COUNT
            return pa.RecordBatch.from_arrays([pa.array(column[keep].view(np.int64)), pa.array(count[keep])], ["token", "count"])

        for batch in batches:
            if len(sent) > SIGNATURES_KEPT:
                sent.clear()
            for s in shingle_sets(batch.column(0).to_pylist(), shingle):
                own = _signature(s)
                if own not in sent:
                    sent.add(own)
                    held.append(s)
                    size += len(s)
            if size >= STRETCH:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    counts = docs.select("text").mapInArrow(lean(run), "token bigint, count bigint").groupBy("token").agg(F.sum("count").alias("count"))
    often, often_at = written(counts.where(F.col("count") >= FREQUENT).withColumn("step", F.floor(8 * F.log2("count"))), "frequent")
    kept, least = 0, 1 << 20  # whole steps of counts, from the highest down
    for r in sorted(often.groupBy("step").agg(F.count("*").alias("columns")).collect(), reverse=True):
        if (kept := kept + r.columns) > FREQUENT_KEPT:
            break
        least = r.step
    often = often.where(F.col("step") >= least).toArrow()
    dropped(docs.sparkSession, often_at)
    column = often.column("token").to_numpy().view(np.uint64)
    order = np.argsort(column)
    return column[order], np.minimum(often.column("count").to_numpy(), 1 << 30).astype(np.int32)[order]


def _entries(docs: DataFrame, shingle: int, num: int, den: int) -> DataFrame:
    """a, b, n: keys (key, signature, KEY), edges (signature, signature, EDGE)
    and documents (id, signature, size)."""

    shared = docs.sparkSession.sparkContext.broadcast(_frequent(docs, shingle))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, sent, rows = Cells(num, den, shared.value), set(), 0
        keys, owners, sigs, held = [], [], [], 0
        spread = TaskContext.get().partitionId() << 40
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), shingle)
            sig = np.fromiter(map(_signature, sets), np.int64, len(sets))
            size = np.fromiter(map(len, sets), np.int64, len(sets))
            null = np.asarray(batch.column(0).is_null())
            # rows without an id are dealt out evenly
            ids = np.where(null, spread + rows + np.arange(len(sets)), batch.column(0).fill_null(0).to_numpy())
            rows += len(sets)
            yield _triples(ids, sig, np.where(null, -3 - size, size))
            if len(sent) > SIGNATURES_KEPT:
                sent.clear()
            fresh = []
            for i, s in enumerate(sig.tolist()):
                if s not in sent:
                    sent.add(s)
                    fresh.append(i)
            key, owner = cells.keys([sets[i] for i in fresh])
            keys.append(key)
            owners.append(owner + sum(map(len, sigs)))
            sigs.append(sig[fresh])
            held += len(key)
            if held >= KEYS_AT_ONCE:
                yield _triples(*_combined(*map(np.concatenate, (keys, owners, sigs))))
                keys, owners, sigs, held = [], [], [], 0
        if held:
            yield _triples(*_combined(*map(np.concatenate, (keys, owners, sigs))))

    return docs.select("doc_id", "text").mapInArrow(lean(run), _TRIPLE_DDL)


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few edges as join what the edges a, b join."""
    node, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    root = _united(np.arange(len(node)), *np.split(place, 2))
    moved = np.flatnonzero(root != np.arange(len(node)))
    return node[moved], node[root[moved]]


def _shared(key: np.ndarray, sig: np.ndarray, crowd: np.ndarray, need: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, ...]]:
    """Edges, and pairs with what a shared key counts for them: a, b, count.
    All entries of each key are given; ``need``: by cell."""
    order = np.lexsort((sig, key))
    key, sig, crowd = key[order], sig[order], crowd[order]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    crowd = np.repeat(np.logical_or.reduceat(crowd, start), np.diff(np.append(start, len(key)))) if len(key) else crowd
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])
    key, sig, crowd = key[new], sig[new], crowd[new]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else start
    size = np.diff(np.append(start, len(key)))
    count = -(-WHOLE // need[(key[start].view(np.uint64) & _CELL).astype(np.int64)])
    joins = crowd[start] | (size > PAIRED)
    inner = np.repeat(joins, size)
    inner[start] = False
    again = np.flatnonzero(inner)
    a, b, counts = [], [], []
    for n in np.unique(size[~joins & (size > 1)]).tolist():
        here = np.flatnonzero(~joins & (size == n))
        x, y = np.triu_indices(n, 1)
        a.append(sig[start[here][:, None] + x].ravel())
        b.append(sig[start[here][:, None] + y].ravel())
        counts.append(np.repeat(count[here], len(x)))
    pairs = tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b, counts))
    return (sig[again - 1], sig[again]), pairs


def _added(pairs: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Each pair once, with the sum of its counts."""
    a, b, count = map(np.concatenate, zip(*pairs))
    order = np.lexsort((b, a))
    a, b, count = a[order], b[order], count[order]
    start = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, np.int64)
    return a[start], b[start], np.add.reduceat(count, start) if len(a) else count


def _joined(num: int, den: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From entries sorted by ``a``: edges that join the entries of crowded
    keys, counts of the pairs of the other keys, and all that are no keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        need = Cells(num, den).need
        waiting, n_waiting = [], 0  # entries of keys, what there is of the last key before them
        held, size, pairs, n_pairs = [], 0, [], 0

        def add(edges: tuple[np.ndarray, np.ndarray], more: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
            nonlocal held, size, pairs, n_pairs
            if len(more[0]):
                pairs.append(more)
                n_pairs += len(more[0])
            if n_pairs >= PAIRS_AT_ONCE:
                a, b, count = _added(pairs)
                part = count < WHOLE
                held.append((a[~part], b[~part]))
                size += int((~part).sum())
                yield _triples(a[part], b[part], PAIR - count[part])
                pairs, n_pairs = [], 0
            if len(edges[0]):
                held.append(edges)
                size += len(edges[0])
            if size >= EDGES_AT_ONCE:
                held = [_spanning(*map(np.concatenate, zip(*held)))]
                size = len(held[0][0])
                if size >= EDGES_AT_ONCE // 2:
                    yield _triples(*held[0], np.full(size, EDGE))
                    held, size = [], 0

        none = (np.zeros(0, np.int64),) * 3
        for batch in batches:
            a, b, n = (batch.column(i).to_numpy() for i in range(3))
            other, keys = n == EDGE, (n == KEY) | (n == CROWD)
            if other.any():
                yield from add((a[other], b[other]), none)
            if not (other | keys).all():
                yield batch.filter(pa.array(~(other | keys)))
            if keys.any():
                waiting.append((a[keys], b[keys], n[keys] == CROWD))
                n_waiting += len(waiting[-1][0])
            if n_waiting >= KEYS_JOINED:
                every = tuple(map(np.concatenate, zip(*waiting)))
                last = every[0] == every[0][-1]
                yield from add(*_shared(*(x[~last] for x in every), need))
                key, sig, crowd = (x[last] for x in every)
                edges, _ = _shared(key, sig, crowd, need)
                yield from add(edges, none)
                sig = edges[0][:1] if len(edges[0]) else np.unique(sig)  # one row stands for a crowd
                waiting, n_waiting = [(key[: len(sig)], sig, np.full(len(sig), len(edges[0]) > 0 or crowd.any()))], 0
        if waiting:
            yield from add(*_shared(*map(np.concatenate, zip(*waiting)), need))
        if n_pairs:
            a, b, count = _added(pairs)
            part = count < WHOLE
            held.append((a[~part], b[~part]))
            yield _triples(a[part], b[part], PAIR - count[part])
        if held:
            a, b = _spanning(*map(np.concatenate, zip(*held)))
            yield _triples(a, b, np.full(len(a), EDGE))

    return run


def _sieve(sigs: DataFrame) -> np.ndarray:
    """One bit for each residue of the given signatures. It lets some others
    through, never stops one of them, and its size is bounded."""
    n = max(1, sigs.count())
    bits = min(SIEVE_BITS, max(1 << 12, 1 << (16 * n).bit_length()))
    place = F.pmod("sig", F.lit(bits))
    words = sigs.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))).alias("set")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words.column("word").to_numpy()] = words.column("set").to_numpy().view(np.uint64)
    return out


def _whole_rows(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """sig and the whole set (its ascending hashes as bytes) of every signature
    in ``wanted``, and of a few others: the texts are read again, and all but
    the wanted rows stay where they are. A row of many copies leaves each task
    about once."""
    shared = docs.sparkSession.sparkContext.broadcast(_sieve(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve, sent = shared.value, set()
        bits = len(sieve) * 64
        for batch in batches:
            sig, hashes = [], []
            if len(sent) > SIGNATURES_KEPT:
                sent.clear()
            for s in shingle_sets(batch.column(0).to_pylist(), shingle):
                own = _signature(s)
                place = own % bits
                if len(s) and int(sieve[place >> 6]) >> (place & 63) & 1 and own not in sent:
                    sent.add(own)
                    sig.append(own)
                    hashes.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sig, pa.int64()), pa.array(hashes, pa.binary())], ["sig", "hashes"])

    found = docs.select("text").mapInArrow(lean(run), "sig bigint, hashes binary")
    return found.groupBy("sig").agg(F.first("hashes").alias("hashes"))


def _overlaps(owner: np.ndarray, column: np.ndarray, count: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """How many columns each of ``rows`` shares with each of the k rows of a
    block. owner, column: the ones of the block, by column; count: the ones of
    each column."""
    out = np.zeros((len(rows), k), np.int32)
    place = np.full(k, -1)
    place[rows] = np.arange(len(rows))
    light = count[column] <= (LIGHT if k > 4 * LIGHT else 0)
    if light.any():
        flat = out.reshape(-1)
        of = owner[light]
        sizes = count[column[light]]
        for c in np.unique(sizes).tolist():
            members = of[sizes == c].reshape(-1, c)
            for i, j in combinations(range(c), 2):
                for x, y in ((members[:, i], members[:, j]), (members[:, j], members[:, i])):
                    at = place[x]
                    np.add.at(flat, (at * k + y)[at >= 0], 1)
    owner, column = owner[~light], column[~light]
    if len(column):
        column = np.cumsum(np.diff(column, prepend=column[0]) != 0)
        edges = np.searchsorted(column, np.arange(0, column[-1] + 1 + DENSE_COLUMNS, DENSE_COLUMNS))
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            ones = np.zeros((k, min(DENSE_COLUMNS, int(column[-1] - column[lo]) + 1) if hi > lo else 0), "f4")
            ones[owner[lo:hi], column[lo:hi] - column[lo]] = 1
            for at in range(0, len(rows), 1024):
                out[at : at + 1024] += (ones[rows[at : at + 1024]] @ ones.T).astype(np.int32)
    return out


def block_links(rows: list[np.ndarray], label: np.ndarray, side: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Components of a block before and after its product, as the smallest place
    in each, and the places of some rows of most links. Rows of one label are in
    one component already. Where both sides are given, only pairs of a row of
    either side count."""
    k, n = len(rows), np.array([len(r) for r in rows], np.int64)
    _, first, back = np.unique(label, return_index=True, return_inverse=True)
    before = root = first[back]
    links = lambda shared, x, y: den * shared >= num * (x + y - shared)
    if k == 2:
        x, y = sorted(rows, key=len)
        shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
        if links(shared, *n.tolist()) and side[0] + side[1] != 2:
            root = np.zeros(2, np.int64)
        return before, root, [0]
    two = bool(side.any())
    token, owner = np.concatenate(rows), np.repeat(np.arange(k), n)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    new = np.ones(len(token), bool)
    new[1:] = token[1:] != token[:-1]
    column = np.cumsum(new) - 1
    many = np.bincount(column)[column] > 1
    owner, column = owner[many], column[many]
    if not len(column):
        return before, root, [0]
    column = np.cumsum(np.diff(column, prepend=column[0]) != 0)
    count = np.bincount(column)
    degree = np.zeros(k, np.int64)
    if k > CENTRES and not two:
        # what shares most with the others first: all that link with it are one
        # component and need no product with each other
        weight = np.bincount(owner, count[column], k) / n
        for _ in range(CENTRES):
            centre = int(weight.argmax())
            if weight[centre] <= 0:
                break
            has = np.zeros(len(count), bool)
            has[column[owner == centre]] = True
            shared = np.bincount(owner, has[column], k).astype(np.int64)
            linked = np.flatnonzero(links(shared, n, n[centre]))
            degree[centre] = len(linked)
            root = _united(root, linked, np.full(len(linked), centre))
            weight[root == root[centre]] = -1
            weight[centre] = -1
    sizes = np.bincount(root, minlength=k)
    rest = np.flatnonzero(side == 1) if two else np.flatnonzero(root != sizes.argmax())
    if len(rest):
        shared = _overlaps(owner, column, count, rest, k).astype(np.int64)
        good = links(shared, n[rest][:, None], n[None, :])
        if two:
            good &= side[None, :] == 0
        degree[rest] = good.sum(1)
        x, y = np.nonzero(good)
        root = _united(root, rest[x], y)
    return before, root, np.argsort(-degree, kind="stable")[:CENTRES].tolist()


_BLOCK = ["block", "sig", "label", "side", "sliced", "hashes"]


def _products(rows: DataFrame, num: int, den: int) -> DataFrame:
    """a, b, n of the given blocks (``_BLOCK``): links that join their
    components (n = EDGE), and some rows of most links of sliced blocks (a; n
    = KEY)."""

    def product(held: list[tuple]) -> pa.RecordBatch:
        sig = np.array([h[0] for h in held], np.int64)
        label, side = np.array([h[1] for h in held], np.int64), np.array([h[2] for h in held])
        before, after, centres = block_links([h[4] for h in held], label, side, num, den)
        moved = np.unique(before)
        moved = moved[after[moved] != moved]
        named = sig[centres if held[0][3] else []]
        return _triples(np.concatenate((sig[moved], named)), np.concatenate((sig[after[moved]], named)), np.repeat([EDGE, KEY], [len(moved), len(named)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:5]]
            for block, sig, label, side, sliced, hashes in zip(*columns, batch.column(5)):
                if block != now:
                    if len(held) > 1:
                        yield product(held)
                    held, now = [], block
                held.append((sig, label, side, sliced, np.frombuffer(hashes.as_buffer(), np.uint64)))
        if len(held) > 1:
            yield product(held)

    dealt = rows.select(*_BLOCK).repartition(parts(rows.sparkSession), "block").sortWithinPartitions("block")
    return dealt.mapInArrow(lean(run), _TRIPLE_DDL)


def _edges(triples: DataFrame) -> DataFrame:
    return triples.where(F.col("n") == EDGE).select("a", "b").distinct()


def _slices(rows: DataFrame) -> DataFrame:
    """comp, slices: into how many slices a block of these rows (comp, n) is
    cut."""
    total = rows.groupBy("comp").agg(F.count("*").alias("rows"), (8 * F.sum("n")).alias("bytes"))
    return total.select("comp", F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("bytes") / BLOCK_BYTES)).alias("slices"))


def _block(*place: str | Column) -> Column:
    return F.xxhash64(*place).alias("block")


def _sliced_links(rows: DataFrame, firsts: DataFrame, num: int, den: int) -> DataFrame:
    """The links of sliced blocks that no slice has in itself, as edges.
    ``rows``: sig, n, comp, slices, slice, hashes; ``firsts``: what the products
    of the slices gave."""
    slices = rows.where("slices > 1")
    centres = firsts.where(F.col("n") == KEY).select(F.col("a").alias("sig")).distinct()
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1))
    own = slices.select(_block("comp", "slice"), "sig", F.col("sig").alias("label"), F.lit(0).alias("side"), F.lit(False).alias("sliced"), "hashes")
    others = slices.join(centres, "sig").withColumn("slice", each)
    others = others.select(_block("comp", "slice"), "sig", F.col("sig").alias("label"), F.lit(1).alias("side"), F.lit(False).alias("sliced"), "hashes")
    seconds, _ = written(_products(own.unionByName(others), num, den), "centre-links")

    found = _edges(firsts).unionByName(_edges(seconds))
    labels = components(found).select(F.col("node").alias("sig"), F.col("comp").alias("label"))
    of = slices.join(labels, "sig", "left").withColumn("label", F.coalesce("label", "sig"))
    of, of_at = written(of, "slices")
    largest = of.groupBy("comp", "label").count().groupBy("comp").agg(F.max_by("label", "count").alias("largest"))
    rest = of.join(largest, "comp").where("label <> largest").drop("largest")
    chunks = _slices(rest).withColumnRenamed("slices", "chunks")
    each_chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))
    own = of.join(chunks, "comp").withColumn("chunk", each_chunk)
    own = own.select(_block("comp", "slice", "chunk"), "sig", "label", F.lit(0).alias("side"), F.lit(False).alias("sliced"), "hashes")
    others = rest.join(chunks, "comp").withColumn("chunk", F.pmod(F.xxhash64("sig", F.lit(1)), F.col("chunks"))).withColumn("slice", each)
    others = others.select(_block("comp", "slice", "chunk"), "sig", "label", F.lit(1).alias("side"), F.lit(False).alias("sliced"), "hashes")
    thirds, _ = written(_products(own.unionByName(others), num, den), "tile-links")
    dropped(rows.sparkSession, of_at)
    return _edges(seconds).unionByName(_edges(thirds))


def similar_sets(docs: DataFrame, shingle: int = 4, num: int = 85, den: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, sig, component_id for every row of ``docs``.

    A document's set holds its distinct shingles of ``shingle`` words (a
    shorter text is one shingle). Two documents link when ``den`` times the
    intersection is at least ``num`` times the union; component_id is the
    smallest doc_id reachable over links, the document's own included. Equal
    sets are one matrix row, so exact copies cost nothing.

    Null texts and those without words are empty sets, linked with nothing.
    Repeated rows give a row each; rows that share an id but not a text are
    taken by their texts. A null doc_id takes part in links and gets its
    component's smallest id, null where no other member has one. Other columns
    are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    dealt = _entries(docs, shingle, num, den).repartition(parts(spark), "a").sortWithinPartitions("a")
    joined, _ = written(dealt.mapInArrow(lean(_joined(num, den)), _TRIPLE_DDL), "documents")
    size = F.when(F.col("n") < EDGE, -3 - F.col("n")).otherwise(F.col("n"))
    known = joined.where((F.col("n") != EDGE) & (F.col("n") > CROWD)).select(F.when(F.col("n") >= 0, F.col("a")).alias("doc_id"), F.col("b").alias("sig"), size.alias("n"))

    paired = joined.where(F.col("n") < PAIR).groupBy("a", "b").agg(F.sum(PAIR - F.col("n")).alias("count")).where(F.col("count") >= WHOLE)
    blocks = components(_edges(joined).unionByName(paired.select("a", "b")), "blocks")
    sizes = known.groupBy("sig").agg(F.max("n").alias("n"))
    in_block = sizes.join(blocks.withColumnRenamed("node", "sig"), "sig")
    in_block, in_block_at = written(in_block, "block-rows")
    in_block = in_block.join(_slices(in_block), "comp").withColumn("slice", F.pmod(F.xxhash64("sig"), F.col("slices")))
    rows = in_block.join(_whole_rows(docs, in_block.select("sig"), shingle), "sig")
    rows, rows_at = written(rows.select("sig", "n", "comp", "slices", "slice", "hashes"), "whole-rows")
    own = rows.select(_block("comp", "slice"), "sig", F.col("sig").alias("label"), F.lit(0).alias("side"), (F.col("slices") > 1).alias("sliced"), "hashes")
    firsts, _ = written(_products(own, num, den), "links")
    links = _edges(firsts)
    if not rows.where("slices > 1").isEmpty():
        links = links.unionByName(_sliced_links(rows, firsts, num, den))
    labels = components(links)
    dropped(spark, rows_at, in_block_at)

    of_set = known.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("least"))
    of_set = of_set.join(labels.withColumnRenamed("node", "sig"), "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))
    least = of_set.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = of_set.join(least, "comp").select("sig", "component_id")
    out = known.join(named, "sig", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), "sig", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def brute_force(docs: list[tuple[int, str | None]], shingle: int = 4, num: int = 85, den: int = 100) -> dict[int, tuple[int, int]]:
    """doc_id -> (n_shingles, component_id) by comparing all pairs, for tests."""
    sets = {}
    for doc, text in docs:
        words = [w for w in (text or "").encode().lower().split()]
        sets[doc] = {tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))} if words else set()
    up = {doc: doc for doc in sets}

    def top(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {doc: (len(s), top(doc)) for doc, s in sets.items()}
