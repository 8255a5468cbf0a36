"""Reading and writing tables: Parquet, JSON lines, JSON arrays, and
intermediate tables that end a lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where none is set, a temporary folder under a
    local master and an error on a cluster, whose machines would not share it."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    if not there:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        there = "file://" + tempfile.mkdtemp(prefix="annospark-")
        spark.conf.set("spark.checkpoint.dir", there)
    return there.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends,
    and lost executors cost no recomputation."""
    path = f"{shared_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Records of a JSON lines file; a record that does not fit is an error."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path, mode="FAILFAST", multiLine=True)


def by_hash(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Stored artifacts whose name is their SHA-256 (name, content), and issues
    for those where it is not."""
    files = spark.read.format("binaryFile").load(folder).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "content")
    right = F.sha2("content", 256) == F.regexp_replace("name", r"\..*$", "")
    return files.where(right), files.where(~right).select(F.lit("store").alias("operator"), F.col("name").alias("key"), F.lit("hash_mismatch").alias("reason"), F.lit(None).cast("string").alias("detail"))


def strict_json(text, kind: str):
    """A column parsed as ``kind``; null where the text is no JSON or repeats a
    key, which the plain parser would not notice."""
    return F.when(F.try_parse_json(text).isNotNull(), F.from_json(text, kind))
