"""Inventories: exact lengths, counts and densities of documents."""

from __future__ import annotations

from math import gcd

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.functions.text import filled_lines, stratum, token_count


def inventory(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with n_codepoints, n_tokens, n_lines, marks (full stops),
    density (marks * 100 / tokens, null without tokens) and stratum."""
    body = F.coalesce(F.col(text), F.lit(""))
    marks = F.length(body) - F.length(F.replace(body, F.lit("."), F.lit("")))
    out = docs.withColumns({"n_codepoints": F.length(body).cast("bigint"), "n_tokens": token_count(body), "n_lines": filled_lines(body), "marks": marks.cast("bigint")})
    density = F.when(F.col("n_tokens") > 0, F.col("marks") * 100 / F.col("n_tokens"))
    return out.withColumns({"density": density, "stratum": stratum(F.col("n_tokens"))})


def rational(numerator: Column, denominator: Column) -> Column:
    """struct(numerator, denominator), reduced; null for a zero denominator."""
    kind = pa.struct([("numerator", pa.int64()), ("denominator", pa.int64())])

    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        rows = []
        for x, y in zip(a.to_pylist(), b.to_pylist()):
            g = gcd(x, y) if x is not None and y else 0
            rows.append({"numerator": x // g, "denominator": y // g} if g else None)
        return pa.array(rows, kind)

    return F.arrow_udf(run, "struct<numerator:bigint,denominator:bigint>")(numerator.cast("bigint"), denominator.cast("bigint"))


def type_counts(annotations: DataFrame, key: str, kind: str) -> DataFrame:
    """One row for each document: counts ARRAY<STRUCT<name, count>> by name."""
    n = annotations.groupBy(key, kind).agg(F.count("*").alias("count"))
    return n.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(kind).alias("name"), "count"))).alias("counts"))


def marker_counts(annotations: DataFrame, key: str, kind: str, factuality: str, polarity: str) -> DataFrame:
    """Numbers of factual events, negated events and body parts of a document."""
    event = F.col(kind) == "EVENT"
    return annotations.groupBy(key).agg(
        F.count_if(event & F.col(factuality).isNotNull() & (F.trim(factuality) != "")).alias("factuality"),
        F.count_if(event & F.lower(polarity).isin("neg", "negative")).alias("negation"),
        F.count_if(F.col(kind) == "BODYPART").alias("bodypart"),
    )
