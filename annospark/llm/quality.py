"""Quality by co-training: two classifiers on separate views teach each other.

The content view sees a text's characters and words, the metadata view what is
known about the document beside its text (source, language, size and layout).
Both are fitted on the labelled documents. In each round every view labels the
unlabelled documents it is most sure of, and the other view learns from them.
The views' scores are calibrated on documents kept out of the fitting and
combined there; all documents are then scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.llm.boosting import BoostedTrees
from annospark.llm.common import bounded_batches, only

#: Labelled and unlabelled documents that co-training sees, at most; its rounds
#: and the pseudo-labels of each class and round, as a share of the labelled.
LABELLED, UNLABELLED = 8000, 8000
ROUNDS, SHARE, SURE = 3, 0.05, 0.9
#: Cells of the hashed source statistics.
SOURCES = 4096

_WORD = re.compile(r"[^\W_]+")
_VOWELS = set("aeiouyäöüáéíóúàèùâêîôû")


def content_view(text: str | None) -> list[float]:
    """Ratios of the whole text's characters, words and lines."""
    text = text or ""
    n = max(1, len(text))
    pieces = text.split()
    words = _WORD.findall(text)
    lines = text.split("\n")
    p, w = max(1, len(pieces)), max(1, len(words))
    letters = sum(map(len, words))
    upper = sum(1 for x in words if x[0].isupper())
    return [
        letters / n,
        len(pieces) / n,
        len(words) / p,
        letters / w,
        len(set(pieces)) / p,
        len(set(lines)) / len(lines),
        upper / w,
        sum(1 for x in words if x.isupper() and len(x) > 1) / w,
        sum(1 for x in words if x.isdigit()) / w,
        sum(1 for x in pieces if not x[-1].isalnum()) / p,
        sum(1 for x in pieces if len(x) > 1 and not (x[-1].isalnum() or x[-2].isalnum())) / p,
        sum(1 for x in pieces if not any(map(str.isalnum, x))) / p,
        sum(1 for x in words if not _VOWELS.intersection(x.lower())) / w,
        max(map(len, pieces), default=0) ** 0.5,
        len(text) ** 0.25,
    ]


def metadata_view(source: str | None, lang: str | None, text_bytes: int, lines: int, sources: np.ndarray, langs: np.ndarray) -> list[float]:
    """Size, layout and the labelled shares of the source and the language."""
    return [
        np.log1p(text_bytes), np.log1p(lines), np.log1p(text_bytes / max(1, lines)),
        sources[_cell(source)], langs[_cell(lang)],
    ]


def _cell(name: str | None) -> int:
    return crc32((name or "").encode()) % SOURCES


def _shares(cells: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Each cell's share of good documents, drawn to the overall one."""
    prior = float(y.mean()) if len(y) else 0.5
    good, all_ = np.bincount(cells, y, SOURCES), np.bincount(cells, minlength=SOURCES)
    return (good + 20 * prior) / (all_ + 20)


def _platt(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and intercept of a logistic regression with a light ridge. Steps
    are halved until the loss falls: whole ones can overshoot where the classes
    part cleanly."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - target * z).sum() + 0.5e-2 * w @ w)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hess, x.T @ (p - target) + 1e-2 * w)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
    return w


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


class CoTrained:
    """Both views' trees, each view's calibration, and the weights that combine
    the calibrated views."""

    def __init__(self) -> None:
        self.views: list[BoostedTrees] = []
        self.prior = 0.5
        self.sources = self.langs = np.full(SOURCES, 0.5)
        self.scales = [np.array([1.0, 0.0])] * 2
        self.weights = np.zeros(3)

    def fit(self, labelled: list[tuple], unlabelled: list[tuple]) -> CoTrained:
        """``labelled``: (doc_id, content view, source, lang, bytes, lines,
        quality 0/1); ``unlabelled``: the same without quality."""
        labelled = sorted(labelled, key=lambda r: (crc32(str(r[0]).encode()), str(r[0])))
        unlabelled = sorted(unlabelled, key=lambda r: (crc32(str(r[0]).encode()), str(r[0])))
        y = np.array([r[6] for r in labelled], float)
        self.prior = float(y.mean()) if len(y) else 0.5
        aside = np.arange(len(y)) % 5 == 0
        if not len(y) or y[~aside].min(initial=1) == y[~aside].max(initial=0):
            return self
        own = [r for r, a in zip(labelled, aside) if not a]
        self.sources = _shares(np.array([_cell(r[2]) for r in own]), y[~aside])
        self.langs = _shares(np.array([_cell(r[3]) for r in own]), y[~aside])
        known, pool = self._both(labelled), self._both(unlabelled)
        given = [known[v][~aside] for v in (0, 1)]
        answers = [y[~aside], y[~aside]]
        left = np.ones(len(unlabelled), bool)
        for turn in range(ROUNDS + 1):
            self.views = [BoostedTrees(trees=40, depth=3).fit(given[v], answers[v]) for v in (0, 1)]
            if turn == ROUNDS or not left.any():
                break
            most = max(1, int(SHARE * len(own)))
            score = [self.views[v].predict(pool[v]) for v in (0, 1)]
            for v in (0, 1):
                for label, sure in ((1.0, score[v]), (0.0, 1 - score[v])):
                    # as many of each class as its share of the labelled
                    n = max(1, int(most * (self.prior if label else 1 - self.prior)))
                    order = np.argsort(-np.where(left, sure, -1), kind="stable")[:n]
                    pick = order[left[order] & (sure[order] >= SURE)]
                    given[1 - v] = np.concatenate([given[1 - v], pool[1 - v][pick]])
                    answers[1 - v] = np.concatenate([answers[1 - v], np.full(len(pick), label)])
                    left[pick] = False
        held = [_logit(self.views[v].predict(known[v][aside])) for v in (0, 1)]
        self.scales = [_platt(h[:, None], y[aside]) for h in held]
        self.weights = _platt(np.column_stack(self._calibrated(held)), y[aside])
        return self

    def _both(self, rows: list[tuple]) -> list[np.ndarray]:
        meta = [metadata_view(r[2], r[3], r[4], r[5], self.sources, self.langs) for r in rows]
        return [np.array([r[1] for r in rows], float).reshape(len(rows), -1), np.array(meta, float).reshape(len(rows), -1)]

    def _calibrated(self, logits: list[np.ndarray]) -> list[np.ndarray]:
        return [h * a + b for h, (a, b) in zip(logits, self.scales)]

    def score(self, rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Combined, content and metadata scores, all calibrated; the prior
        without a model."""
        if not self.views or not rows:
            return (np.full(len(rows), self.prior),) * 3
        one, two = self._calibrated([_logit(v.predict(x)) for v, x in zip(self.views, self._both(rows))])
        both = np.column_stack([one, two, np.ones(len(one))]) @ self.weights
        both, one, two = (1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (both, one, two))
        return both, one, two


def _features(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, content view, source, lang, bytes, lines and further columns."""

    @F.arrow_udf("array<double>")
    def view(texts: pa.Array) -> pa.Array:
        only()
        return pa.array([content_view(t.as_py()) for t in texts], pa.list_(pa.float64()))

    body = F.coalesce(F.col("text"), F.lit(""))
    lines = F.length(body) - F.length(F.replace(body, F.lit("\n"), F.lit(""))) + 1
    return docs.select("doc_id", view(F.col("text")).alias("content"), "source", "lang", F.octet_length(body).alias("bytes"), lines.alias("lines"), *more)


def fit_quality(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, unlabelled: int = UNLABELLED) -> CoTrained:
    """Co-trains on at most so many documents, taken by hash. ``docs``: doc_id,
    text, source, lang; ``labels``: doc_id, quality (rows with another value
    than 0 and 1 do not count; of contradicting labels the larger holds)."""
    bounded_batches(docs.sparkSession)
    labels = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    n_labels, n_docs = labels.count(), docs.count()
    draw = lambda salt: F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(salt)), 11) / F.lit(float(1 << 53))
    some = labels if n_labels <= labelled else labels.where(draw("labelled") < 0.9 * labelled / n_labels)
    docs = docs.where("doc_id is not null").select("doc_id", "text", "source", "lang")
    known = _features(docs.join(F.broadcast(some), "doc_id"), "quality").collect()
    pool = docs.where(draw("unlabelled") < 0.9 * unlabelled / max(n_docs, 1)) if n_docs > unlabelled else docs
    rest = _features(pool.join(labels.select("doc_id"), "doc_id", "left_anti")).collect()
    return CoTrained().fit([tuple(r) for r in known], [tuple(r) for r in rest])


def score_quality(docs: DataFrame, model: CoTrained, threshold: float = 0.5) -> DataFrame:
    """``row`` (all columns of ``docs``), score, content, metadata, keep for
    every row. A document stays where its combined score reaches ``threshold``.

    ``docs`` must have text, source and lang; each may be null: a null text
    counts as empty, null sources and languages are a group of their own.
    Repeated rows and null ids give a row each. Long texts are seen whole. An
    empty table gives an empty result. Nothing is shuffled.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    kind = "struct<score:double,content:double,metadata:double>"

    @F.arrow_udf(kind)
    def scores(text: pa.Array, source: pa.Array, lang: pa.Array) -> pa.Array:
        only()
        rows = []
        for t, s, g in zip(text.to_pylist(), source.to_pylist(), lang.to_pylist()):
            t = t or ""
            rows.append((None, content_view(t), s, g, len(t.encode()), t.count("\n") + 1))
        return pa.StructArray.from_arrays([pa.array(x, pa.float64()) for x in shared.value.score(rows)], ["score", "content", "metadata"])

    row = docs.select(F.struct("*").alias("row"))
    out = row.select("row", scores(F.col("row.text"), F.col("row.source").cast("string"), F.col("row.lang").cast("string")).alias("s"))
    return out.select("row", "s.*", (F.col("s.score") >= threshold).alias("keep"))
