"""The corpus pipeline: each stage works on all that the one before it kept,
written as Parquet in between. All but the last return the columns of
``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.llm import decontaminate, line_dedup, ngram_join, packing, quality
from annospark.llm.common import dropped, table, written
from annospark.llm.queries import tokenizer_file

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier rejects go."""
    docs = docs.select(*COLUMNS)
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).where("keep").select("row.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a smaller document holds go; a document left without text
    goes with them."""
    return _documents(line_dedup.drop_copied_lines(docs))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or
    more, links followed) the document of the smallest doc_id stays; one
    without an id only where no member has one. Rows equal in id and text are
    one document and stay or go together; among different texts of one id, or
    of none, the smallest hash of the text decides. Documents without words are
    in no group."""
    docs = docs.select(*COLUMNS)
    row = F.xxhash64("doc_id", "text")
    groups = ngram_join.similar_sets(docs.withColumn("row", row), shingle=5, num=80, den=100, doc_id="row")
    groups, groups_at = written(groups.where("n_shingles > 0").select(F.col("doc_id").alias("row"), F.col("component_id").alias("group")).distinct(), "groups")
    crowded = groups.groupBy("group").count().where("count > 1").select("group")
    members = groups.join(crowded, "group").join(docs.select(row.alias("row"), "doc_id").distinct(), "row")
    stays = members.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("least"))
    gone, _ = written(members.join(stays, "group").where("row <> least.row").select("row"), "gone")
    dropped(spark, groups_at)
    return docs.withColumn("row", row).join(gone, "row", "left_anti").select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document that is mostly such goes."""
    return _documents(decontaminate.remove_contamination(docs, table(spark, sf_dir, "benchmark"), mode="spans"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, as pieces with their ids' checksums."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), window=2048, end_id=1)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_copy_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Classifier and tokenizer cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; a stage's table goes once the next stage's
    is written."""
    docs, read = table(spark, sf_dir, "documents"), []
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs, at = written(docs, f"stage-{i}")
            dropped(spark, *read)
            read = [at]
    return docs
