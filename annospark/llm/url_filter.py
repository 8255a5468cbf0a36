"""URL filters: rules where one fits, gradient-boosted trees elsewhere.

The trees see lexical features only: lengths, depth, digit ratio, entropy,
parameter counts and smoothed statistics of suffixes. They are trained on URLs
that carry a verdict, by default those that a rule fits.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.llm.boosting import BoostedTrees
from annospark.llm.common import bounded_batches

#: URLs with a verdict that the trees are fitted on, at most.
TRAINING_URLS = 40_000

_URL = re.compile(r"(?s).*?://([^/?#]*)([^?#]*)")
_UPPER = {c: c + 32 for c in range(65, 91)}
_LETTERS = re.compile(r"[a-z]+")


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null and for URLs
    without ``://``."""
    found = _URL.match(url or "")
    return (found[1].translate(_UPPER), found[2]) if found else ("", "")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def name(self) -> str:
        return self.host + self.path


class Rules:
    """Rules by host; the longest that fits wins (of equals the first by name).
    A rule fits its host and all subdomains if the path starts with its own."""

    def __init__(self, rules: list[Rule]):
        self.of_host: dict[str, list[Rule]] = {}
        for rule in sorted(rules, key=lambda r: (-len(r.name), r.name)):
            self.of_host.setdefault(rule.host, []).append(rule)

    def fit(self, host: str, path: str) -> Rule | None:
        best, labels = None, host
        while labels:
            for rule in self.of_host.get(labels, ()):
                if path.startswith(rule.path):
                    if best is None or len(rule.name) > len(best.name):
                        best = rule
                    break
            _, _, labels = labels.partition(".")
        return best


def entropy(text: str) -> float:
    """Bits a character."""
    n = len(text)
    return -sum(k / n * math.log2(k / n) for k in Counter(text).values()) if n else 0.0


def _suffixes(host: str, path: str) -> tuple[str, str, str, str]:
    """Last label, last two labels, the path's first step and its file suffix."""
    labels = host.split(".")
    steps = [s for s in path.split("/") if s]
    return labels[-1], ".".join(labels[-2:]), steps[0] if steps else "", steps[-1].rpartition(".")[2] if steps and "." in steps[-1] else ""


class UrlModel:
    """Feature statistics and trees, fitted on (url, 1 for block)."""

    def fit(self, labelled: list[tuple[str | None, int]]) -> UrlModel:
        y = np.array([v for _, v in labelled], float)
        seen: list[dict[str, list[float]]] = [{}, {}, {}, {}]
        for url, v in labelled:
            for table, s in zip(seen, _suffixes(*host_and_path(url))):
                cell = table.setdefault(s, [0.0, 0.0])
                cell[0] += v
                cell[1] += 1
        self.prior = float(y.mean()) if len(y) else 0.5
        # what occurs once or twice tells nothing about others
        self.shares = [{s: (a + 5 * self.prior) / (n + 5) for s, (a, n) in t.items() if n >= 3} for t in seen]
        self.trees = BoostedTrees().fit(self.features([u for u, _ in labelled]), y)
        return self

    def features(self, urls: list[str | None]) -> np.ndarray:
        out = np.zeros((len(urls), 16))
        for i, url in enumerate(urls):
            url = url or ""
            host, path = host_and_path(url)
            query = url.partition("?")[2].partition("#")[0]
            n = max(1, len(url))
            digits = sum(map(str.isdigit, url))
            shares = [t.get(s, self.prior) for t, s in zip(self.shares, _suffixes(host, path))]
            out[i] = [
                len(url), len(host), len(path), path.count("/"), host.count("."), digits / n, sum(map(str.isdigit, host)),
                entropy(url), entropy(host), len(query.split("&")) if query else 0, len(query), url.count("-") + url.count("_"), *shares,
            ]
        return out

    def block(self, urls: list[str | None]) -> np.ndarray:
        """The probability that a URL is to be blocked."""
        return self.trees.predict(self.features(urls)) if urls else np.zeros(0)


def sampled(df: DataFrame, key: str, most: int) -> DataFrame:
    """All rows, or where there are more than ``most`` those of the smallest
    hashes of ``key``, about nine tenths of ``most``: the same rows however the
    table is stored."""
    n = df.count()
    if n <= most:
        return df
    part = int(0.9 * most / n * (1 << 62))
    return df.where(F.shiftrightunsigned(F.xxhash64(key), 2) < part)


def judge(
    pages: DataFrame, rules: list[Rule], threshold: float = 0.5, page_id: str = "page_id", url: str = "url",
    labelled: DataFrame | None = None, most: int = TRAINING_URLS,
) -> DataFrame:
    """page_id, host, path, rule, verdict, block (the trees' probability).

    ``labelled``: (url, block 0/1) to train on; without it the URLs of
    ``pages`` that a rule fits. At most ``most`` of them are taken, by hash.
    Null URLs and those without ``://`` have an empty host and path, no rule,
    and the trees' verdict. Without a labelled URL every block is 0.5, which
    allows. Repeated rows and null ids give a row each. Only the two columns
    are read. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    by_host = Rules(rules)
    given = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
    if labelled is None:
        # a first sieve in SQL: hosts that end like a rule's; then the rules
        ends = [re.escape(h) for h in sorted(by_host.of_host)]
        fits = F.col("url").rlike(rf"(?i)://([^/?#]*\.)?({'|'.join(ends)})([/?#]|$)") if ends else F.lit(False)
        found = [r.url for r in sampled(given.select("url").where(fits), "url", most).collect()]
        pairs = [(u, int(r.verdict == "block")) for u in found if (r := by_host.fit(*host_and_path(u)))]
    else:
        pairs = [(r[0], int(r[1])) for r in sampled(labelled.where("url is not null and block is not null").select("url", "block"), "url", most).collect()]
    model = spark.sparkContext.broadcast((by_host, UrlModel().fit(sorted(pairs))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, trained = model.value
        for batch in batches:
            urls = batch.column(1).to_pylist()
            split = [host_and_path(u) for u in urls]
            rule = [fitted.fit(*s) for s in split]
            block = trained.block(urls)
            verdict = [r.verdict if r else "block" if b > threshold else "allow" for r, b in zip(rule, block)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([h for h, _ in split], pa.string()), pa.array([p for _, p in split], pa.string()),
                    pa.array([r.name if r else None for r in rule], pa.string()), pa.array(verdict, pa.string()), pa.array(block, pa.float64()),
                ],
                ["page_id", "host", "path", "rule", "verdict", "block"],
            )

    kind = given.schema["page_id"].dataType.simpleString()
    return given.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string, block double")
