"""What the training-data operators share: reading, bounded Arrow batches,
written intermediate tables and the crc32 split of labelled rows."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes that one Arrow batch handed to Python may hold. Texts have no
#: length limit, so a row count alone would not bound a worker's memory.
BATCH_ROWS = 1024
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table by Spark's own reader, so that any store Spark knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches small whatever the texts' lengths are."""
    for key, most in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
    ):
        now = re.match(r"\d+", spark.conf.get(key) or "")
        if not now or not 0 < int(now[0]) <= most:
            spark.conf.set(key, str(most))


_tables: dict[str, dict] = {}


def tables(owner: str) -> dict:
    """A worker's loaded tables of one operator; they go when a task of another
    one begins."""
    return _tables.setdefault(owner, {})


def only(owner: str = "") -> None:
    """Drops the tables of all other operators."""
    for name, held in _tables.items():
        if name != owner and held:
            held.clear()
            give_back()


def lean(run: Callable[[Iterator], Iterator], owner: str = "") -> Callable[[Iterator], Iterator]:
    """``run``, after which a worker gives back what it holds but for the tables
    of ``owner``: workers outlive their tasks and share the executor's memory
    with what comes next."""

    def bounded(batches: Iterator) -> Iterator:
        only(owner)
        try:
            yield from run(batches)
        finally:
            give_back()

    return bounded


def give_back() -> None:
    """Returns free memory to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or
    a temporary one where nothing is set and all runs in one process (as in
    tests). On a cluster it must be set."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    if not there:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        there = "file://" + tempfile.mkdtemp(prefix="annospark-")
        spark.conf.set("spark.checkpoint.dir", there)
    return there


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Writes ``df`` as Parquet to the shared folder and reads it again. The
    lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, *paths: str) -> None:
    """Deletes tables of ``written`` that no later plan reads."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as decimal text, modulo; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def clear_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not hold, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
