"""Token counts by heap-and-linked-list byte-pair merging.

A text's symbols are a doubly linked list and its mergeable neighbours a heap.
The pair of the lowest rank (the leftmost among equals) is merged until none
is left; the count is the initial symbols minus the merges. No identifier is
ever made.

Merges never cross a place where no piece of the vocabulary holds the two
characters side by side. Texts are therefore cut there, beginning with the
white space before words, and the counts of the cut parts are remembered in a
bounded table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.llm.common import bounded_batches, lean, tables

#: The character that stands for a space inside pieces.
SPACE = "▁"
#: Counts of words and of cut parts that a worker remembers at most; beyond it
#: starts anew. Parts repeat more and cost more to count.
REMEMBERED_WORDS = 800_000
REMEMBERED_PARTS = 1_000_000


class PieceCounter(dict):
    """Counts of words (without their leading space) under a piece vocabulary
    with byte fallback, a space put before the text and white space kept."""

    def __init__(self, pieces: dict[str, float], words: int = REMEMBERED_WORDS, parts: int = REMEMBERED_PARTS):
        super().__init__()
        order = {score: i for i, score in enumerate(sorted(set(pieces.values()), reverse=True))}
        self.rank = {p: order[score] for p, score in pieces.items()}
        self.beside = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        self.most_words, self.most_parts = words, parts
        self.part_counts: dict[str, int] = {}
        lone = {c for p in pieces if len(p) > 1 for c in p} - pieces.keys()
        if lone:
            raise ValueError(f"pieces of {len(lone)} characters that are no pieces themselves")
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece goes on over the space after a word")

    @classmethod
    def load(cls, model_file: str) -> PieceCounter:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        odd = "ﬁ Ⅳ  é\n"
        if model.decode(model.encode(odd)) != odd:
            raise ValueError("models that normalise their input are not supported")
        ids = range(model.get_piece_size())
        return cls({
            model.id_to_piece(i): model.get_score(i)
            for i in ids
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        })

    def merges(self, part: str) -> int:
        """How many merges the heap yields for one part. A heap entry is the
        pair's rank and, in its low 32 bits, the place of its left symbol; an
        entry whose pair has changed meanwhile is passed over."""
        get, n = self.rank.get, len(part)
        sym: list = list(part)
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [get(a + b, -1) << 32 | i for i, (a, b) in enumerate(zip(part, part[1:])) if a + b in self.rank]
        heapify(heap)
        done = 0
        while heap:
            entry = heappop(heap)
            i = entry & 0xFFFFFFFF
            left, j = sym[i], nxt[i]
            if left is None or j >= n:
                continue
            pair = left + sym[j]
            if get(pair) != entry >> 32:
                continue
            sym[i], sym[j] = pair, None
            done += 1
            k = nxt[i] = nxt[j]
            if k < n:
                prev[k] = i
                made = get(pair + sym[k])
                if made is not None:
                    heappush(heap, made << 32 | i)
            h = prev[i]
            if h >= 0:
                made = get(sym[h] + pair)
                if made is not None:
                    heappush(heap, made << 32 | h)
        return done

    def part_count(self, part: str) -> int:
        found = self.part_counts.get(part)
        if found is None:
            rank = self.rank
            found = sum(1 if c in rank else len(c.encode()) for c in part) - (self.merges(part) if len(part) > 1 else 0)
            if len(part) < 64:
                if len(self.part_counts) >= self.most_parts:
                    self.part_counts.clear()
                self.part_counts[part] = found
        return found

    def __missing__(self, word: str) -> int:
        """``word`` may hold spaces at its start only; one more precedes it."""
        text = SPACE + word.replace(" ", SPACE)
        beside, at, total = self.beside, 0, 0
        for i, (a, b) in enumerate(zip(text, text[1:]), 1):
            if a + b not in beside:
                total += self.part_count(text[at:i])
                at = i
        total += self.part_count(text[at:])
        if len(word) < 64:
            if len(self) >= self.most_words:
                self.clear()
            self[word] = total
        return total

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        text = text.replace(SPACE, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            words = [x[1:] for x in re.findall(" +[^ ]*", " " + text)]
        else:
            words = text.split(" ")
        return sum(map(self.__getitem__, words))


_counters: dict[str, PieceCounter] = tables("token counts")


def counter(model_file: str) -> PieceCounter:
    """The worker's counter of this model; loaded once."""
    if model_file not in _counters:
        _counters[model_file] = PieceCounter.load(model_file)
    return _counters[model_file]


def count_tokens(docs: DataFrame, model_file: str, limit: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs``.

    The plan is one scan without a shuffle; a row's cost follows its own
    length (n log n), so very long texts need no special way.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows and null ids
    give a row each. Other columns are not read. An empty table gives an empty
    result.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(model_file)
        for batch in batches:
            n = pa.array([own.count(t.as_py()) for t in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], ["doc_id", "n_bytes", "n_tokens"])
        own.clear()  # counts of words; those of parts cost more to make and stay

    given = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.col(text).alias("text"),
    )
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(lean(run, "token counts"), f"doc_id {kind}, n_bytes bigint, n_tokens bigint").select(
        "*", (F.col("n_tokens") > limit).alias("over_limit")
    )
