"""Benchmark decontamination: a broadcast hash set of the benchmark's word
windows, one scan over the training texts, every hash hit verified word by
word, then spans or whole documents go.

The benchmark is a stated query set. Its window table is broadcast in blocks of
a checked size (``BLOCK_WORDS``); a benchmark of more words is taken in several
blocks of items, each against all documents, and their hits are united. So no
broadcast grows with either input and no item is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.llm.common import bounded_batches, dropped, only, written

#: Words of benchmark text in one broadcast block (some 100 bytes for each).
BLOCK_WORDS = 2_000_000

#: A-Z to a-z; 0-9, a-z and everything beyond ASCII stay; other ASCII separates.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def split_words(text: str | None) -> list[bytes]:
    """Runs of digits, letters and non-ASCII characters, A-Z lower-cased."""
    return text.encode().translate(_FOLD).split() if text else []


def _rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n word numbers."""
    out = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out = (out ^ ids[j : len(ids) - n + 1 + j].astype(np.uint64)) * _MIX
            out ^= out >> np.uint64(29)
    return out


class Windows:
    """The windows of one block of items, by length: sorted hashes, the word
    numbers behind each, and the items that hold it."""

    def __init__(self, items: list[tuple[object, str | None]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary
        found: dict[int, dict[tuple[int, ...], set[str]]] = {}
        for item, text in items:
            ids = [number.setdefault(w, len(number)) for w in split_words(text)]
            n = min(width, len(ids))
            if n and item is not None:
                for i in range(len(ids) - n + 1):
                    found.setdefault(n, {}).setdefault(tuple(ids[i : i + n]), set()).add(str(item))
        self.tables = []
        for n, windows in sorted(found.items()):
            words = np.array(list(windows), np.int32).reshape(-1, n)
            hashes = np.array([_rolling(w, n)[0] for w in words], np.uint64)
            order = np.argsort(hashes, kind="stable")
            holders = list(windows.values())
            self.tables.append((n, hashes[order], words[order], [holders[i] for i in order]))

    def scan(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
        """For each text its number of words and the items found; and for all
        texts' words together (texts divided by one missing word) whether a
        window covers them."""
        sizes, ids = [], []
        get = self.vocabulary.get
        for text in texts:
            words = split_words(text)
            sizes.append(len(words))
            ids.append(np.fromiter(map(get, words, [-1] * len(words)), np.int32, len(words)))
            ids.append(np.array([-1], np.int32))
        sizes = np.array(sizes, np.int64)
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        starts = np.concatenate(([0], np.cumsum(sizes + 1)))
        hit = np.zeros(len(flat) + 1, np.int32)  # +1 where a window begins, -1 behind its end
        items: list[set[str]] = [set() for _ in texts]
        known = np.concatenate(([0], np.cumsum(flat >= 0)))
        for n, hashes, words, holders in self.tables:
            at = np.flatnonzero(known[n:] - known[:-n] == n)
            if not len(at):
                continue
            own = np.lib.stride_tricks.sliding_window_view(flat, n)[at]
            h = np.zeros(len(at), np.uint64)
            with np.errstate(over="ignore"):
                for j in range(n):
                    h = (h ^ own[:, j].astype(np.uint64)) * _MIX
                    h ^= h >> np.uint64(29)
            lo, hi = np.searchsorted(hashes, h), np.searchsorted(hashes, h, "right")
            for i in np.flatnonzero(hi > lo):
                for k in range(lo[i], hi[i]):
                    if np.array_equal(words[k], own[i]):  # verified
                        hit[at[i]] += 1
                        hit[at[i] + n] -= 1
                        items[np.searchsorted(starts, at[i], "right") - 1] |= holders[k]
        return sizes, np.cumsum(hit[:-1]) > 0, items


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list]:
    """The items in blocks of at most so many words (one item at least). The
    driver holds one block at a time."""
    block, words = [], 0
    for item, body in benchmark.select(item_id, text).toLocalIterator():
        n = len(split_words(body))
        if block and words + n > block_words:
            yield block
            block, words = [], 0
        block.append((item, body))
        words += n
    yield block


def _scanner(shared, kind: pa.DataType, share: float | None = None):
    """Hits of one block of items, united with those of earlier blocks. With a
    ``share`` also the text without its hits, where these are not more than
    that share of its words."""

    def scan(texts: pa.Array, before: pa.Array) -> pa.Array:
        only()
        sizes, hit, items = shared.value.scan(texts.to_pylist())
        earlier, rows, at = before.to_pylist(), [], 0
        for n, own, was, text in zip(sizes.tolist(), items, earlier, texts):
            mine = hit[at : at + n]
            at += n + 1
            if was:
                own = own | set(was["items"])
                if was["spans"]:
                    mine = mine.copy()
                    for s in was["spans"]:
                        mine[s["first"] : s["past"]] = True
            spans = []
            if own:
                edge = np.flatnonzero(np.diff(np.concatenate(([0], mine, [0]))))
                spans = [{"first": a, "past": b} for a, b in edge.reshape(-1, 2).tolist()]
            rows.append({"n_words": n, "spans": spans, "items": sorted(own)})
            if share is not None:
                few = spans and sum(s["past"] - s["first"] for s in spans) <= share * n
                rows[-1]["clean"] = cut_spans(text.as_py(), [(s["first"], s["past"]) for s in spans]) if few else None
        return pa.array(rows, kind)

    return scan


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """row (all columns of ``docs`` as a struct, so that no name can clash) and
    found: n_words, spans (word places, half-open, sorted and disjoint) and
    items (ids as strings, sorted).

    A window is ``width`` consecutive words of an item, or a shorter item
    whole. Null and empty texts have no words; items without words or with a
    null id have no windows. Repeated items count once by id; repeated rows of
    ``docs`` and null ids give a row each. Nothing is shuffled.
    """
    return _found(docs, benchmark, width, text, item_id, item_text, block_words)


def _found(
    docs: DataFrame, benchmark: DataFrame, width: int, text: str, item_id: str, item_text: str, block_words: int, share: float | None = None,
) -> DataFrame:
    """``find_contamination``, with a ``share`` also the cut texts: found.clean."""
    spark = docs.sparkSession
    bounded_batches(spark)
    kind = "struct<n_words:bigint,spans:array<struct<first:int,past:int>>,items:array<string>"
    fields = [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))),
        ("items", pa.list_(pa.string())),
    ]
    if share is not None:
        kind, fields = f"{kind},clean:string", [*fields, ("clean", pa.string())]
    kind += ">"
    out, earlier = docs.select(F.struct("*").alias("row")), []
    for i, block in enumerate(_blocks(benchmark, item_id, item_text, block_words)):
        if i:  # one block in a task at a time
            out, at = written(out, "found")
            dropped(spark, *earlier)
            earlier = [at]
        scan = F.arrow_udf(_scanner(spark.sparkContext.broadcast(Windows(block, width)), pa.struct(fields), share), kind)
        before = F.col("found") if i else F.lit(None).cast(kind)
        # not deterministic: else a filter on it would make Spark call it twice
        out = out.withColumn("found", scan.asNondeterministic()(F.col("row")[text], before))
    return out


def report(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("found.spans", F.lit(0).cast("bigint"), lambda n, s: n + (s["past"] - s["first"]))
    return found.select(
        F.col("row")[doc_id].alias("doc_id"),
        F.col("found.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def cut_spans(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """``text`` without the words of the spans and what stands between them;
    what stands around a span stays."""
    if not spans or not text:
        return text
    raw = text.encode()
    folded = np.frombuffer(raw.translate(_FOLD), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([0], folded.view(np.int8), [0])))).reshape(-1, 2)
    out, at = [], 0
    for first, past in spans:
        out.append(raw[at : edge[first][0]])
        at = edge[past - 1][1]
    return b"".join([*out, raw[at:]]).decode()


def remove_contamination(
    docs: DataFrame, benchmark: DataFrame, mode: str = "spans", share: float = 0.5, width: int = 10,
    text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``docs`` with the same columns, decontaminated. ``documents``: documents
    with any hit go. ``spans``: the hit words are cut from the texts, and a
    document of which more than ``share`` of the words are hit goes. Null texts
    stay null."""
    if mode not in ("spans", "documents"):
        raise ValueError(f"mode {mode!r} is neither spans nor documents")
    by_spans = mode == "spans"
    found = _found(docs, benchmark, width, text, item_id, item_text, BLOCK_WORDS, share if by_spans else None)
    if not by_spans:
        return found.where(F.size("found.spans") == 0).select("row.*")
    stays = found.where((F.size("found.spans") == 0) | F.col("found.clean").isNotNull())
    return stays.select(F.col("row").withField(text, F.coalesce("found.clean", F.col("row")[text])).alias("row")).select("row.*")


def brute_force(docs: list[tuple], items: list[tuple], width: int = 10) -> list[tuple]:
    """The report's rows by comparing every place with every window, for tests."""
    windows = {}
    for item, text in items:
        words = split_words(text)
        n = min(width, len(words))
        for i in range(len(words) - n + 1 if n and item is not None else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        words, hit, own = split_words(text), set(), set()
        for n in range(1, width + 1):
            for i in range(len(words) - n + 1):
                if held := windows.get(tuple(words[i : i + n])):
                    own |= held
                    hit |= set(range(i, i + n))
        out.append((doc, len(words), len(hit), len(own), sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit)))
    return out
