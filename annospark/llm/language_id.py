"""Language identification by a byte convolutional network.

A text's UTF-8 bytes are cut into windows of a fixed length that overlap by the
widest filter, so that every byte of the whole text is seen. Windows of many
texts are scored together; a document's distribution is its windows' mean,
weighted by their lengths.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.llm.cnn import ConvNet
from annospark.llm.common import bounded_batches

#: Documents of each language that the network is fitted on, at most, and the
#: bytes of one window.
TRAINING_DOCS = 2000
WINDOW = 512
WIDTHS, FILTERS, DIM = (3, 5), 12, 8
OVERLAP = max(WIDTHS) - 1

_MAYBE_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    """Whether a text holds a letter; digits of other forms (½, ², ①) are none."""
    return bool(text) and any(m[0].isalpha() for m in _MAYBE_LETTER.finditer(text))


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded windows of byte + 1 (0 pads), the text of each, and its bytes."""
    rows, owner, size = [], [], []
    for i, raw in enumerate(texts):
        at = 0
        while True:
            part = raw[at : at + WINDOW]
            rows.append(part)
            owner.append(i)
            size.append(len(part))
            at += WINDOW - OVERLAP
            if at + OVERLAP >= len(raw):
                break
    out = np.zeros((len(rows), WINDOW), np.int16)
    for i, part in enumerate(rows):
        out[i, : len(part)] = np.frombuffer(part, np.uint8)
        out[i, : len(part)] += 1
    return out, np.array(owner), np.array(size, float)


class LanguageModel:
    """The languages in order and the network; fitted on (text slice, lang)."""

    def __init__(self, seed: int = 7):
        self.langs: list[str] = []
        self.net: ConvNet | None = None
        self.seed = seed

    def fit(self, labelled: list[tuple[str, str]], steps: int = 900, batch: int = 96) -> LanguageModel:
        by: dict[str, list[bytes]] = {}
        for text, lang in sorted(labelled):
            if has_letter(text):
                by.setdefault(lang, []).append(text.encode()[: 4 * WINDOW])
        self.langs = sorted(by)
        if len(self.langs) < 2:
            return self
        self.net = ConvNet([257], DIM, WIDTHS, FILTERS, len(self.langs), self.seed)
        rnd = np.random.default_rng(self.seed)

        def draw(_: int):
            lang = rnd.integers(len(self.langs), size=batch)
            # windows of all lengths, so that short texts are known too
            length = np.exp(rnd.uniform(np.log(12), np.log(WINDOW), batch)).astype(int)
            x = np.zeros((batch, max(length.max(), OVERLAP + 1)), np.int16)
            for i, (k, n) in enumerate(zip(lang, length)):
                raw = by[self.langs[k]][rnd.integers(len(by[self.langs[k]]))]
                at = rnd.integers(max(1, len(raw) - n + 1))
                part = np.frombuffer(raw[at : at + n], np.uint8)
                x[i, : len(part)] = part
                x[i, : len(part)] += 1
            return [x], np.eye(len(self.langs), dtype="f4")[lang], np.ones(batch, "f4")

        self.net.train(draw, steps)
        return self

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The likeliest language of each text and its probability; ``und`` and
        0 without a letter, or without anything learned."""
        lang, score = ["und"] * len(texts), [0.0] * len(texts)
        some = [i for i, t in enumerate(texts) if has_letter(t)]
        if not some or not self.langs:
            return lang, score
        if self.net is None:
            for i in some:
                lang[i], score[i] = self.langs[0], 1.0
            return lang, score
        total = np.zeros((len(some), len(self.langs)))
        x, owner, size = windows([texts[i].encode() for i in some])
        for at in range(0, len(x), 64):
            logit = self.net.logits([x[at : at + 64]])
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            np.add.at(total, owner[at : at + 64], p * size[at : at + 64, None])
        total /= total.sum(1, keepdims=True)
        for i, k, p in zip(some, total.argmax(1).tolist(), total.max(1).tolist()):
            lang[i], score[i] = self.langs[k], min(p, 1.0)
        return lang, score


def training_slices(labelled: DataFrame, most: int = TRAINING_DOCS) -> list[tuple[str, str]]:
    """(slice, lang) of at most ``most`` documents of each language, taken by
    hash: 1024 characters from a place that the hash chooses, so that every
    part of long texts can be met. ``labelled``: doc_id, text, lang."""
    known = labelled.where("text is not null and lang is not null and doc_id is not null")
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.create_map(*(x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(min(1.0, 0.9 * most / n) if n > most else 1.0)))) if counts else None
    if share is None:
        return []
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("language")), 11) / F.lit(float(1 << 53))
    at = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - 1023, F.lit(1))) + 1
    rows = known.where(draw < share[F.col("lang")]).select(F.substring("text", at, F.lit(1024)).alias("slice"), "lang").collect()
    return [(r.slice, r.lang) for r in rows]


def identify(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row of ``docs``.

    Null, empty and letterless texts are ``und`` with score 0. Long texts are
    seen whole. Repeated rows and null ids give a row each; other columns are
    not read; an empty table gives an empty result. Nothing is shuffled.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                lang, score = shared.value.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
