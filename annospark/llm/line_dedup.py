"""Line de-duplication: of each line that several documents hold, only the
smallest document keeps its copies.

The keys' hashes are range-partitioned together with the document, so that one
very common line is spread over many partitions, and sorted by document and
position. A streaming pass over each partition sees every key's first document
first and reports the lines of all later ones. Only the first run of a
partition can have begun in an earlier partition; its first document is left
open and settled by comparing the partitions' last and first keys, one row
each. The result is a compressed keep bitmap for each document, without text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.llm.common import bounded_batches, dropped, lean, parts, written

#: What a key loses at both ends.
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"

DROP, OPEN, EDGE = 0, 1, 2
_LINES = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("row", pa.int64()), ("pos", pa.int32())])
_FOUND = pa.schema([("kind", pa.int8()), ("part", pa.int32()), *_LINES, ("last1", pa.int64()), ("last2", pa.int64())])


def _keys(min_chars: int):
    """Hashes of the lines whose keys are long enough, with their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, docs, rows, at = [], [], [], []
            for doc, row, text in zip(*(c.to_pylist() for c in batch.columns)):
                for i, line in enumerate(text.split("\n")):
                    key = line.strip(BLANK)
                    if len(key) >= min_chars:
                        # bytes.lower() changes A-Z alone
                        hashes.append(blake2b(key.encode().lower(), digest_size=16).digest())
                        docs.append(doc)
                        rows.append(row)
                        at.append(i)
            both = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(docs, pa.int64()), pa.array(rows, pa.int64()), pa.array(at, pa.int32())],
                schema=_LINES,
            )

    return run


def _later_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reports, from rows sorted by (hash, document, position), the lines that
    are not in their key's first document. ``OPEN``: lines of the first
    document of this partition's first key. ``EDGE``: one row with that key and
    the last one."""
    part = TaskContext.get().partitionId()
    first = last = None  # (h1, h2, first document of the key)
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, doc = (batch.column(i).to_numpy() for i in range(3))
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        goes_on = last is not None and last[:2] == (h1[0], h2[0])
        start = np.maximum.accumulate(np.where(new, np.arange(len(h1)), 0))
        head = doc[start]
        if goes_on:
            head[start == 0] = last[2]
        if first is None:
            first = (h1[0], h2[0], doc[0])
        last = (h1[-1], h2[-1], head[-1])
        unsure = (h1 == first[0]) & (h2 == first[1]) & (doc == first[2])
        kind = np.where(unsure, OPEN, DROP).astype("i1")
        keep = (doc != head) | unsure
        n = int(keep.sum())
        if n:
            kept = batch.filter(pa.array(keep))
            none = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(kind[keep]), pa.array(np.full(n, part, "i4")), *kept.columns, none, none], schema=_FOUND)
    if first is not None:
        row = [EDGE, part, first[0], first[1], None, None, None, last[0], last[1]]
        yield pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(row, _FOUND)], schema=_FOUND)


def _ddl(schema: pa.Schema) -> str:
    names = {"int64": "bigint", "int32": "int", "int8": "tinyint"}
    return ", ".join(f"{f.name} {names[str(f.type)]}" for f in schema)


def dropped_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """doc_id, row (the text's hash), at (sorted places of lines to drop), for
    the documents that lose lines. ``docs``: doc_id bigint, row bigint, text
    string without nulls."""
    spark = docs.sparkSession
    lines, lines_at = written(docs.mapInArrow(lean(_keys(min_chars)), _ddl(_LINES)), "lines")
    dealt = lines.repartitionByRange(parts(spark), "h1", "h2", "doc_id").sortWithinPartitions("h1", "h2", "doc_id", "row", "pos")
    found, _ = written(dealt.mapInArrow(lean(_later_copies), _ddl(_FOUND)), "later-copies")
    dropped(spark, lines_at)
    # one row for each partition
    edges = found.where(F.col("kind") == EDGE).select("part", "h1", "h2", "last1", "last2").orderBy("part").collect()
    begun = [b.part for a, b in zip(edges, edges[1:]) if (a.last1, a.last2) == (b.h1, b.h2)]
    begun_before = spark.createDataFrame([(p,) for p in begun], "part int")
    out = found.where(F.col("kind") == DROP)
    if begun:
        out = out.unionByName(found.where(F.col("kind") == OPEN).join(F.broadcast(begun_before), "part", "left_semi"))
    return out.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("pos")).alias("at"))


def _bitmap(n_lines: int, at: list[int] | None) -> bytes:
    keep = np.ones(n_lines, bool)
    if at:
        keep[at] = False
    return zlib.compress(np.packbits(keep).tobytes())


def keep_lines(bitmap: bytes, n_lines: int) -> np.ndarray:
    """The keep flags of a document's lines."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def _identified(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(body).alias("row"), body.alias("text"))


def keep_bitmaps(docs: DataFrame, min_chars: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row (the text's 64-bit hash), n_lines, n_dropped, bitmap
    (zlib-compressed packed bits, 1 for a line that stays), one row for each
    distinct (document, text).

    A key is the line without blanks (space, tab to carriage return) at both
    ends, A-Z lower-cased. Keys of ``min_chars`` code points or more that at
    least two documents hold lose all lines but those of the smallest doc_id.
    A null or empty text is one empty line. Rows that share a doc_id are one
    document: a line that several of them hold is no copy. Rows with a null
    doc_id keep all lines and make no line a copy. Other columns are not read.
    An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    given = _identified(docs, doc_id, text)
    lost = dropped_lines(given.where("doc_id is not null"), min_chars)
    n_lines = (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("bigint")
    heads = given.select("doc_id", "row", n_lines.alias("n_lines")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, at = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([len(a or ()) for a in at], pa.int64()), pa.array(map(_bitmap, n, at), pa.binary())],
                ["doc_id", "row", "n_lines", "n_dropped", "bitmap"],
            )

    return heads.join(lost, ["doc_id", "row"], "left").mapInArrow(lean(run), "doc_id bigint, row bigint, n_lines bigint, n_dropped bigint, bitmap binary")


def kept_text(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row, n_lines, n_dropped and the kept text (lines that stay,
    joined by line feeds) of every row of ``docs``."""
    given = _identified(docs, doc_id, text)
    some = bitmaps.where("n_dropped > 0 and doc_id is not null").select("doc_id", "row", "n_dropped", "bitmap")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, kept = [], []
            for body, bitmap in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist()):
                lines = body.split("\n")
                n_lines.append(len(lines))
                kept.append(body if bitmap is None else "\n".join(x for x, k in zip(lines, keep_lines(bitmap, len(lines))) if k))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(n_lines, pa.int64()), batch.column(3).fill_null(0), pa.array(kept, pa.string())],
                ["doc_id", "row", "n_lines", "n_dropped", "kept"],
            )

    return given.join(some, ["doc_id", "row"], "left").mapInArrow(lean(run), "doc_id bigint, row bigint, n_lines bigint, n_dropped bigint, kept string")


def dedup_lines(docs: DataFrame, min_chars: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents' kept text, by way of their bitmaps; rules as in
    ``keep_bitmaps``."""
    bitmaps, _ = written(keep_bitmaps(docs, min_chars, doc_id, text), "bitmaps")
    return kept_text(docs, bitmaps, doc_id, text)


def drop_copied_lines(docs: DataFrame, min_chars: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the same columns and the kept texts. Documents that held
    some text and keep none go; null texts stay null. Texts are shuffled
    once."""
    bitmaps, _ = written(keep_bitmaps(docs, min_chars, doc_id, text).where("n_dropped > 0 and doc_id is not null"), "bitmaps")

    @F.arrow_udf("string")
    def kept(texts: pa.Array, maps: pa.Array) -> pa.Array:
        out = []
        for body, bitmap in zip(texts.to_pylist(), maps.to_pylist()):
            if body is not None and bitmap is not None:
                lines = body.split("\n")
                body = "\n".join(x for x, k in zip(lines, keep_lines(bitmap, len(lines))) if k)
            out.append(body)
        return pa.array(out, pa.string())

    named = docs.select(
        F.struct("*").alias("doc"), F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("row")
    )
    both = named.join(bitmaps.select("doc_id", "row", "bitmap"), ["doc_id", "row"], "left")
    kept = kept.asNondeterministic()  # else the filter would make Spark call it twice
    both = both.select("doc", "bitmap", kept(F.col("doc")[text], F.col("bitmap")).alias("kept"))
    both = both.where(F.col("bitmap").isNull() | (F.btrim("kept", F.lit(BLANK)) != ""))
    return both.select(F.col("doc").withField(text, F.col("kept")).alias("doc")).select("doc.*")


def digests(kept: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256."""
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(docs: list[tuple[int | None, str | None]], min_chars: int = 10) -> list[tuple]:
    """The same result with dictionaries, for tests."""
    holder: dict[bytes, set[int]] = {}
    key = lambda line: line.strip(BLANK).encode().lower()
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if doc is not None and len(line.strip(BLANK)) >= min_chars:
                holder.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        stays = [x for x in lines if doc is None or len(x.strip(BLANK)) < min_chars or min(holder[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(stays), sha256("\n".join(stays).encode()).hexdigest()))
    return out
