"""Order-preserving packing of documents into fixed windows of tokens.

Documents are taken in the order in which their partition is read, in shards of
a bounded number of tokens. In a shard the cuts between windows are chosen by
dynamic programming over document and sentence ends: the cost of a plan is its
padding plus a penalty for each document that a cut divides. The padding of a
window from j to k is linear in both ends, so the best j for each k is the
front of a monotone queue, and a shard costs time linear in its boundaries.

Tokenising dominates. A text is cut before each single space, where the
byte-level pre-tokeniser always begins anew, and the ids of the cut parts are
remembered in a bounded table.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator
from functools import cached_property
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.llm.common import bounded_batches, lean, tables

#: Parts (of fewer than 64 characters) whose ids a task remembers at most, some
#: 100 MB; beyond it starts anew.
REMEMBERED = 600_000
#: Tokens after which a shard is closed (at the end of a document).
SHARD_TOKENS = 1_000_000
#: Penalties, in tokens of padding: a cut at a sentence end, and one inside a
#: sentence of more than twice HARD_STEP tokens (offered at each such step).
SENTENCE_CUT, HARD_CUT, HARD_STEP = 4, 12, 16
#: Bytes that end a sentence.
ENDS = (b".", b"!", b"?", b"\n")


def _byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies:
    printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class TextIds(dict):
    """The ids of texts under a ``tokenizers`` file without added special
    tokens, as little-endian unsigned 32-bit bytes."""

    def __init__(self, file: str, remembered: int = REMEMBERED):
        super().__init__()
        self.file, self.remembered = file, remembered
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [x["content"] for x in spec.get("added_tokens") or ()]
        self.bytes_of = self._bytes(spec)
        self.fast = self._fast(spec)

    @cached_property
    def whole(self):
        """The library's own tokenizer, for texts that hold special strings and
        vocabularies of another kind."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.file)

    @staticmethod
    def _bytes(spec: dict) -> dict[int, bytes]:
        alphabet = _byte_alphabet()
        return {
            i: bytes(alphabet[c] for c in piece) if all(c in alphabet for c in piece) else piece.encode()
            for piece, i in spec["model"]["vocab"].items()
        }

    def _fast(self, spec: dict):
        """An equal encoder for plain byte-level vocabularies whose merges
        follow the order of their ids; None for others."""
        import public_tokenizers
        import tiktoken

        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        special = set(self.special)
        vocab = {p: i for p, i in model["vocab"].items() if p not in special}
        made = [vocab.get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model.get("merges") or ()]
        if (
            pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)
            or spec.get("normalizer") or model.get("ignore_merges") or model.get("byte_fallback")
            or model.get("dropout") or made != sorted(set(made)) or len(made) + 256 != len(vocab) or min(made, default=0) < 256
        ):
            return None
        ranks = {self.bytes_of[i]: i for i in vocab.values()}
        return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def sentence_ends(self) -> np.ndarray:
        """For each id, whether its bytes end a sentence."""
        out = np.zeros(max(self.bytes_of) + 1, bool)
        for i, b in self.bytes_of.items():
            out[i] = b.endswith(ENDS)
        return out

    def __missing__(self, part: str) -> bytes:
        ids = np.array(self.fast.encode_ordinary(" " + part), "<u4").tobytes()
        if len(part) < 64:
            if len(self) >= self.remembered:
                self.clear()
            self[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if "  " in text:  # runs of spaces do not part before their last one alone
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        first, *rest = text.split(" ")
        head = np.array(self.fast.encode_ordinary(first), "<u4").tobytes() if first else b""
        return b"".join(chain((head,), map(self.__getitem__, rest)))


def boundaries(sizes: list[int], ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a shard may be cut and their penalties. ``ends``: for each
    token, whether it ends a sentence."""
    total = len(ends)
    penalty = np.full(total + 1, -1, np.int32)
    penalty[1:][ends] = SENTENCE_CUT
    penalty[np.cumsum(sizes)] = 0
    penalty[0] = 0
    at = np.flatnonzero(penalty >= 0)
    long = np.diff(at) > 2 * min(HARD_STEP, window // 2)
    steps = np.arange(0, total, min(HARD_STEP, window // 2))
    inside = steps[long[np.searchsorted(at, steps, "right") - 1]]
    penalty[inside[penalty[inside] < 0]] = HARD_CUT
    at = np.flatnonzero(penalty >= 0)
    return at, penalty[at]


def best_cuts(at: np.ndarray, penalty: np.ndarray, window: int) -> list[int]:
    """Ends of the windows of least padding plus penalties, by a monotone queue
    over cost[j] + at[j] among the boundaries j within one window."""
    places, extra = at.tolist(), penalty.tolist()
    back = [0] * len(places)
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])  # (cost + place, place, index)
    for k in range(1, len(places)):
        place = places[k]
        while place - queue[0][1] > window:
            queue.popleft()
        least, _, back[k] = queue[0]
        value = least + window + extra[k]  # cost[k] + place
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, place, k))
    cuts, k = [], len(places) - 1
    while k > 0:
        cuts.append(places[k])
        k = back[k]
    return cuts[::-1]


def power_tail(cuts: list[int], window: int) -> list[int]:
    """Divides the last window into powers of two, which are not padded, where
    that costs less than its padding."""
    start = cuts[-2] if len(cuts) > 1 else 0
    length = cuts[-1] - start
    if length < 1 or length == window or (length.bit_count() - 1) * HARD_CUT >= window - length:
        return cuts
    out, place = cuts[:-1], start
    for bit in range(length.bit_length() - 1, -1, -1):
        if length >> bit & 1:
            place += 1 << bit
            out.append(place)
    return out


_PIECE = pa.schema([
    ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
])
_encoders: dict[str, tuple[TextIds, np.ndarray]] = tables("packing")


def encoder(file: str) -> tuple[TextIds, np.ndarray]:
    if file not in _encoders:
        ids = TextIds(file)
        _encoders[file] = ids, ids.sentence_ends()
    return _encoders[file]


def pack_shard(docs: list[bytes], ends: np.ndarray, window: int, first_sequence: int) -> tuple[list[int], list[tuple], list[bytes]]:
    """For each piece the document's place in the shard, its row of ``_PIECE``
    and its ids; ``docs``: the ids of each document, its end id included."""
    sizes = [len(d) // 4 for d in docs]
    flat = np.frombuffer(b"".join(docs), "<u4")
    cuts = power_tail(best_cuts(*boundaries(sizes, ends[np.minimum(flat, len(ends) - 1)], window), window), window)
    owner, rows, pieces = [], [], []
    doc, start, place, sequence = 0, 0, 0, first_sequence
    for cut in cuts:
        offset = 0
        while place < cut:
            length = min(cut - place, sizes[doc] - start)
            ids = docs[doc][4 * start : 4 * (start + length)]
            owner.append(doc)
            rows.append((start, length, crc32(ids), sizes[doc], sequence, offset))
            pieces.append(ids)
            place, start, offset = place + length, start + length, offset + length
            if start == sizes[doc]:
                doc, start = doc + 1, 0
        sequence += 1
    return owner, rows, pieces


def pack(
    docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, keep_ids: bool = False,
    shard_tokens: int = SHARD_TOKENS, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and with ``keep_ids`` the ids themselves.

    A document's ids are its text's and ``end_id``; null and empty texts have
    that id alone. Each partition is packed by itself in the order in which it
    is read, so nothing is shuffled and one task holds one shard at a time (a
    document longer than a shard is a shard of its own). sequence_id holds the
    partition in its high bits. Repeated rows and null ids are documents of
    their own. Other columns are not read. An empty table gives an empty
    result.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    bounded_batches(docs.sparkSession)
    given = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    id_field = pa.field("doc_id", pa.string() if given.schema["doc_id"].dataType.typeName() == "string" else pa.int64())
    schema = pa.schema([id_field, *_PIECE, *([("ids", pa.list_(pa.int64()))] if keep_ids else [])])
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, ends = encoder(tokenizer)
        sequence = TaskContext.get().partitionId() << 36

        def closed() -> pa.RecordBatch:
            nonlocal sequence
            owner, rows, pieces = pack_shard(held, ends, window, sequence)
            sequence = rows[-1][4] + 1
            columns = [pa.array([names[i] for i in owner], id_field.type), *(pa.array(c, pa.int64()) for c in zip(*rows))]
            if keep_ids:
                columns.append(pa.array([np.frombuffer(p, "<u4").astype("i8") for p in pieces], pa.list_(pa.int64())))
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        names, held, tokens = [], [], 0
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                names.append(name)
                held.append(ids.encode(body.as_py()) + last)
                tokens += len(held[-1]) // 4
                if tokens >= shard_tokens:
                    yield closed()
                    names, held, tokens = [], [], 0
        if held:
            yield closed()
        ids.clear()

    kind = "string" if pa.types.is_string(id_field.type) else "bigint"
    columns = ", ".join(f"{f.name} bigint" for f in _PIECE) + (", ids array<bigint>" if keep_ids else "")
    if kind == "bigint":
        given = given.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return given.mapInArrow(lean(run, "packing"), f"doc_id {kind}, {columns}")
