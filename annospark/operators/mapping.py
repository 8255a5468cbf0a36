"""Concept mapping: annotations to ontology terms over cross-references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLASSES = ["invalid", "missing", "ambiguous", "obsolete", "unique_active"]


def classify(concepts: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """``concepts`` (key, valid) with candidates ARRAY<STRUCT<id, obsolete>>
    sorted by id, n_candidates and class. In this order: invalid, missing,
    ambiguous (several), obsolete (the only one is), unique_active.

    ``candidates``: key, id, obsolete. They are gathered by key before the
    join, so a concept that many annotations share is gathered once.
    """
    gathered = candidates.groupBy(key).agg(F.sort_array(F.collect_set(F.struct("id", "obsolete"))).alias("candidates"))
    out = concepts.join(gathered, key, "left").withColumn("candidates", F.when(F.col("valid"), F.coalesce("candidates", F.array().cast("array<struct<id:string,obsolete:boolean>>"))).otherwise(F.array().cast("array<struct<id:string,obsolete:boolean>>")))
    n = F.size("candidates")
    kind = F.when(~F.coalesce("valid", F.lit(False)), "invalid").when(n == 0, "missing").when(n > 1, "ambiguous")
    kind = kind.when(F.col("candidates")[0]["obsolete"], "obsolete").otherwise("unique_active")
    return out.withColumn("class", kind).withColumn("n_candidates", n.cast("bigint"))


def summary(classified: DataFrame) -> DataFrame:
    """class, n_rows, n_candidates for every class, zeros included."""
    n = classified.groupBy("class").agg(F.count("*").alias("n_rows"), F.sum("n_candidates").alias("n_candidates"))
    every = classified.sparkSession.createDataFrame([(c,) for c in CLASSES], "class string")
    return every.join(n, "class", "left").select("class", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"))


def map_annotations(sets: DataFrame, documents: DataFrame, terms: DataFrame, kind: str = "CLINENTITY", valid: str = r"^C\d{7}$") -> tuple[DataFrame, DataFrame]:
    """(mapping rows, issues) of annotation sets (document_sha256, annotations
    ARRAY<STRUCT<source_annotation_id, source_type, source_concept_id>>).

    Sets without a document are issues. ``terms``: id, obsolete, umls_cuis.
    """
    lost = sets.join(documents.select("document_sha256"), "document_sha256", "left_anti")
    issues = lost.select(F.lit("mapping").alias("operator"), F.col("document_sha256").alias("key"), F.lit("unknown_document").alias("reason"), F.lit(None).cast("string").alias("detail"))
    a = sets.join(documents.select("document_sha256", "document_id").dropDuplicates(["document_sha256"]), "document_sha256")
    a = a.select("document_id", "document_sha256", F.explode("annotations").alias("a")).where(F.col("a.source_type") == kind)
    a = a.select("document_id", "document_sha256", "a.source_annotation_id", F.col("a.source_concept_id").alias("cui"))
    a = a.withColumn("valid", F.coalesce(F.col("cui").rlike(valid), F.lit(False)))
    xrefs = terms.select(F.col("id"), "obsolete", F.explode("umls_cuis").alias("cui"))
    return classify(a, xrefs, "cui"), issues


def subset(mapping: DataFrame, cases: DataFrame, key: str) -> DataFrame:
    """The mapping rows of the given cases."""
    return mapping.join(cases.select(key), key, "left_semi")
