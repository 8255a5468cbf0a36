"""Toxicity by a convolutional network over hashed word embeddings.

A word's embedding is the sum of rows by the hashes of the word and of its first
three, four and six letters, so that inflected and compounded forms of a word
are known by its stem, and a word which shares one row with a marked word is
still told from it. Filters of several widths, max pooling and a sigmoid follow.
Long texts are cut into overlapping windows of words whose filter responses are
pooled. Rare languages weigh more in training. Scores are calibrated on documents
kept out of the fitting, and each language gets the threshold that suits it best
there.
"""

from __future__ import annotations

import copy
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.llm.cnn import ConvNet
from annospark.llm.common import bounded_batches, lean

#: Labelled documents that the network is fitted on, at most, and the characters
#: of them all together; fewer documents by hash where they would have more.
TRAINING_DOCS = 12_000
TRAINING_CHARS = 40_000_000
#: Words of a training step, about; longer texts make smaller batches.
STEP_WORDS, LEAST_BATCH = 1 << 17, 8
#: Letters that a part of a word has (0: all), and the bits of its table.
PARTS = ((0, 17), (3, 13), (4, 15), (6, 17))
ROWS = [1 << bits for _, bits in PARTS]
#: Words of a window.
WINDOW = 256
WIDTHS, FILTERS, DIM = (1, 2, 3), 16, 8
OVERLAP = max(WIDTHS) - 1
#: Words whose rows a worker remembers at most while it scores.
REMEMBERED = 100_000

_WORD = re.compile(r"[^\W_]+")


class WordRows(dict):
    """The table rows of a word's parts, in one number; row 0 pads."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        out = 0
        for i, (letters, bits) in enumerate(PARTS):
            part = word[:letters] if letters else word
            out = out << bits | crc32(part.encode(), i + 1) % ((1 << bits) - 1) + 1
        self[word] = out
        return out


def _inputs(x: np.ndarray) -> list[np.ndarray]:
    out = []
    for _, bits in reversed(PARTS):
        out.append(x & (1 << bits) - 1)
        x = x >> bits
    return out[::-1]


_rows = WordRows()


def forget() -> None:
    """Empties the worker's table of words."""
    _rows.clear()


def word_rows(text: str | None) -> np.ndarray:
    """The rows of a text's words (runs of letters and digits, lower-cased)."""
    words = _WORD.findall(text.lower()) if text else []
    return np.fromiter(map(_rows.__getitem__, words), np.int64, len(words))


def _windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    rows, owner = [], []
    for i, words in enumerate(texts):
        for at in range(0, max(1, len(words) - OVERLAP), WINDOW - OVERLAP):
            rows.append(words[at : at + WINDOW])
            owner.append(i)
    # padding after every window, so that no score depends on the texts around
    out = np.zeros((len(rows), max(map(len, rows), default=0) + OVERLAP + 1), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out, np.array(owner, np.int64)


class ToxicityModel:
    def __init__(self, seed: int = 11):
        self.net: ConvNet | None = None
        self.scale, self.shift, self.prior = 1.0, 0.0, 0.0
        self.thresholds: dict[str, float] = {}
        self.seed = seed

    def fit(self, labelled: list[tuple[str, int, str | None]], rounds: int = 14, steps: int = 120, batch: int = 64) -> ToxicityModel:
        """On (text, 1 for toxic, language). A fifth says after each round how
        good the network is, so that the best one is kept, and calibrates it."""
        labelled = sorted(labelled, key=lambda r: (crc32(r[0].encode()), r[0], r[1]))
        texts = [word_rows(t) for t, _, _ in labelled]
        y = np.array([v for _, v, _ in labelled], "f4")
        self.prior = float(y.mean()) if len(y) else 0.0
        aside = np.arange(len(y)) % 5 == 0
        fit_on = np.flatnonzero(~aside)
        langs = np.array([lang or "" for _, _, lang in labelled])
        if not len(fit_on) or y[fit_on].min() == y[fit_on].max():
            return self
        self.net = ConvNet(ROWS, DIM, WIDTHS, FILTERS, 1, self.seed)
        rnd = np.random.default_rng(self.seed)
        one, none = fit_on[y[fit_on] == 1], fit_on[y[fit_on] == 0]
        share_one, share_none = _even(langs[one]), _even(langs[none])
        # whole texts, half of them toxic, rare languages more often
        size = np.array([len(t) for t in texts])
        words = (size[one].mean() + size[none].mean()) / 2
        batch = int(min(batch, max(LEAST_BATCH, STEP_WORDS / max(1, words))))

        def draw(_: int):
            pick = np.concatenate([rnd.choice(one, batch // 2, p=share_one), rnd.choice(none, batch // 2, p=share_none)])
            x, owner = _windows([texts[k] for k in pick])
            rows = _inputs(x)
            for r in rows:  # no part of a word may be relied on alone
                r[rnd.random(x.shape, "f4") < 0.5] = 0
            return rows, y[pick][:, None], np.ones(len(pick), "f4"), np.searchsorted(owner, np.arange(len(pick)))

        held, wanted = [texts[i] for i in np.flatnonzero(aside)], y[aside]
        least, best, worse = np.inf, None, 0
        for _ in range(rounds):
            self.net.train(draw, steps, rate=0.004, decay=1e-4)
            raw = self._raw(held)
            # classes and languages weigh as in the draws
            loss = sum((np.logaddexp(0, sign * raw[wanted == v]) * _even(langs[aside][wanted == v])).sum() for v, sign in ((1, -1), (0, 1)) if (wanted == v).any())
            if loss < least:
                least, best, worse = loss, copy.deepcopy(self.net), 0
            elif (worse := worse + 1) == 3:
                break
        self.net = best
        self._calibrate(self._raw(held), wanted, [labelled[i][2] for i in np.flatnonzero(aside)])
        return self

    def _raw(self, texts: list[np.ndarray]) -> np.ndarray:
        out = np.full((len(texts), len(self.net.bias)), -np.inf, "f4")
        x, owner = _windows(texts)
        for at in range(0, len(x), 64):
            part = x[at : at + 64]
            part = part[:, : int((part != 0).sum(1).max()) + OVERLAP + 1]
            np.maximum.at(out, owner[at : at + 64], self.net.pooled(_inputs(part)))
        return (out @ self.net.top + self.net.top_bias)[:, 0].astype(float)

    def _calibrate(self, raw: np.ndarray, y: np.ndarray, langs: list[str | None]) -> None:
        """Platt scaling, then the best threshold (by F1) of each language."""
        if not len(y) or y.min() == y.max():
            return
        target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
        middle, spread = float(raw.mean()), float(raw.std()) or 1.0
        x = np.stack([(raw - middle) / spread, np.ones_like(raw)], 1)
        w = np.array([1.0, 0.0])

        def loss(w: np.ndarray) -> float:
            z = x @ w
            return float((np.logaddexp(0, z) - target * z).sum() + 0.5e-3 * w @ w)

        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            step = np.linalg.solve(hess, x.T @ (p - target) + 1e-3 * w)
            size = 1.0  # where classes part cleanly, whole steps can overshoot
            while size > 1e-6 and loss(w - size * step) > loss(w):
                size /= 2
            w = w - size * step
        self.scale = max(float(w[0]) / spread, 1e-3)
        self.shift = float(w[1]) - self.scale * middle
        score = 1 / (1 + np.exp(-np.clip(self.scale * raw + self.shift, -30, 30)))
        for lang in sorted({v for v in langs if v is not None}):
            own = np.array([v == lang for v in langs])
            s, t = score[own], y[own]
            if t.sum() >= 5:
                cuts = np.linspace(0.05, 0.95, 19)
                f1 = [2 * (t * (s >= c)).sum() / max(1, t.sum() + (s >= c).sum()) for c in cuts]
                best = np.flatnonzero(np.isclose(f1, max(f1)))
                self.thresholds[lang] = float(cuts[best[len(best) // 2]])

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts), self.prior)
        raw = self._raw([word_rows(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip(self.scale * raw + self.shift, -30, 30)))


def _even(langs: np.ndarray) -> np.ndarray:
    """Weights of documents, 1 in all: half of it alike for each document, half
    alike for each language."""
    _, back, count = np.unique(langs, return_inverse=True, return_counts=True)
    return 0.5 / count[back] / max(1, len(count)) + 0.5 / max(1, len(langs))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAINING_DOCS, chars: int = TRAINING_CHARS) -> list[tuple[str, int, str | None]]:
    """(text, toxic, lang) of at most ``most`` labelled documents, half of them
    for either class where there are so many, and of those as many as have
    ``chars`` characters together. Documents are taken by hash alone, whatever
    their length, and whole. ``docs``: doc_id, text, lang; ``labels``: doc_id,
    toxic. Ids are drawn from the labels first; only the drawn documents' sizes
    and then texts leave the tasks.
    """
    marked = labels.where("toxic in (0, 1) and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    counts = {r.toxic: r.n for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("toxicity")), 11) / F.lit(float(1 << 53))
    share = {y: 0.45 * most / n if n > most / 2 else 1.0 for y, n in counts.items()}
    some = marked.where(draw < F.when(F.col("toxic") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0)))
    drawn = docs.where("text is not null").join(F.broadcast(some), "doc_id")
    sizes = drawn.select("doc_id", "toxic", draw.alias("draw"), F.length("text").alias("size")).collect()
    total = {y: sum(r["size"] for r in sizes if r.toxic == y) for y in (0, 1)}
    kept = {
        (r.doc_id, r.toxic) for r in sizes
        if total[r.toxic] <= chars / 2 or r.draw < share[r.toxic] * 0.45 * chars / total[r.toxic]
    }
    chosen = docs.sparkSession.createDataFrame(sorted(kept), some.schema)
    rows = docs.where("text is not null").join(F.broadcast(chosen), "doc_id").select("text", "toxic", "lang").collect()
    return [(r.text, r.toxic, r.lang) for r in rows]


def score_toxicity(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text", lang: str | None = None) -> DataFrame:
    """doc_id, score (0 to 1) of every row of ``docs``; with a ``lang`` column
    also flagged, by that language's calibrated threshold (0.5 where none was
    learned). The score itself never depends on the language.

    Null and empty texts score as a text without words. Long texts are seen
    whole, window by window. Repeated rows and null ids give a row each; other
    columns are not read; an empty table gives an empty result. Nothing is
    shuffled.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                s = shared.value.score(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(s, pa.float64())], ["doc_id", "lang", "score"])
        forget()

    given = docs.select(F.col(doc_id).alias("doc_id"), (F.col(lang) if lang else F.lit(None)).cast("string").alias("lang"), F.col(text).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    out = given.mapInArrow(lean(run), f"doc_id {kind}, lang string, score double")
    if lang is None:
        return out.drop("lang")
    cut = F.lit(0.5)
    for name, t in sorted(model.thresholds.items()):
        cut = F.when(F.col("lang") == name, t).otherwise(cut)
    return out.select("doc_id", "score", (F.col("score") >= cut).alias("flagged"))
