"""Document fingerprints: bottom-k sketches of word-shingle hashes, in SQL
functions alone.

A sketch is the ascending array of the ``k`` smallest distinct 64-bit hashes of
a text's shingles (five words; a shorter text is one shingle; none without
words). Sketches of parts merge into the sketch of the whole, and estimate
resemblance, containment and the number of distinct shingles. Every function
here builds columns; nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.llm.common import parts, written

#: Hashes kept. The standard error of a resemblance J is sqrt(J (1 - J) / K).
K = 128
SHINGLE = 5


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with further columns that are computed once: Spark would otherwise
    copy an expression into every later one that uses it, and into the lambdas
    that run for every element."""
    for name, column in columns.items():
        df = df.select("*", F.explode(F.array(column)).alias(name))
    return df


def with_sketch(df: DataFrame, text: str, name: str, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """``df`` with the sketch of ``text`` (null counts as empty) as ``name``."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\s\p{Z}]+"), lambda w: w != "")
    w = f"_words_{name}"
    df = held(df, **{w: F.transform(words, lambda x: F.xxhash64(x))})
    n = F.size(w)
    rolling = F.transform(F.sequence(F.lit(0), n - shingle), lambda i: F.xxhash64(*(F.get(F.col(w), i + j) for j in range(shingle))))
    hashes = F.when(n >= shingle, rolling).when(n > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))
    return held(df, **{name: F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)}).drop(w)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def _reach(a: Column, b: Column, k: int) -> Column:
    """The largest hash up to which both sketches are complete."""
    top = F.lit((1 << 63) - 1)
    return F.least(*(F.when(F.size(s) >= k, F.element_at(s, -1)).otherwise(top) for s in (a, b)))


def _up_to(hashes: Column, reach: Column) -> Column:
    return F.size(F.filter(hashes, lambda h: h <= reach)).cast("double")


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """The estimated Jaccard similarity: 1 for two empty sketches."""
    reach = _reach(a, b, k)
    every = _up_to(F.array_union(a, b), reach)
    return F.when(every == 0, F.lit(1.0)).otherwise(_up_to(F.array_intersect(a, b), reach) / F.greatest(every, F.lit(1.0)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of a's shingles that b holds: 1 for an empty a."""
    reach = _reach(a, b, k)
    own = _up_to(a, reach)
    return F.when(own == 0, F.lit(1.0)).otherwise(_up_to(F.array_intersect(a, b), reach) / F.greatest(own, F.lit(1.0)))


def distinct_count(sketch: Column, k: int = K) -> Column:
    """The estimated number of distinct shingles; exact below ``k``."""
    share = (F.element_at(sketch, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def text_form(sketch: Column) -> Column:
    """16 hexadecimal digits for each hash, in ascending order of the hashes."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def fingerprints(docs: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, sketch, fingerprint, n_distinct of every row of ``docs``, in one
    scan. Null texts count as empty; an empty sketch is an empty string."""
    out = with_sketch(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", "sketch", k)
    return out.select("doc_id", "sketch", text_form(F.col("sketch")).alias("fingerprint"), distinct_count(F.col("sketch"), k).alias("n_distinct"))


def predecessors(docs: DataFrame) -> DataFrame:
    """doc_id, prev_id, take for each distinct id: the next smaller id (of the
    smallest: the largest) and a quarter of its text's length. Ids are
    range-partitioned, ordered within each partition, and joined over the
    partitions' ends, one row each. ``docs``: doc_id, n_chars."""
    spark = docs.sparkSession
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.max("n_chars").alias("n_chars"))
    ids, _ = written(ids.repartitionByRange(parts(spark), "doc_id").withColumn("part", F.spark_partition_id()), "ids")
    last = ids.groupBy("part").agg(F.max(F.struct("doc_id", "n_chars")).alias("last"))
    by_part = Window.orderBy("part")  # a row for each partition
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = last.select("part", F.coalesce(F.lag("last").over(by_part), F.last("last").over(whole)).alias("before"))
    inside = Window.partitionBy("part").orderBy("doc_id")
    prev = F.coalesce(F.lag(F.struct("doc_id", "n_chars")).over(inside), F.col("before"))
    return ids.join(F.broadcast(before), "part").select("doc_id", prev.alias("prev")).select(
        "doc_id", F.col("prev.doc_id").alias("prev_id"), F.floor(F.col("prev.n_chars") / 4).cast("int").alias("take")
    )


def edited_likeness(docs: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of the texts and of edited texts, in which the last
    quarter (floor of the code points / 4) gives way to as many first code
    points, or all, of the next document by ascending id (after the last: the
    first): doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    Texts are shuffled once, by id; what a document takes from the next one and
    that one's sketch follow to it. Null texts count as empty. Rows that share
    an id are one document to their predecessor, with the longest text's length
    and, as next text, the one that sorts first; each row gives a row. A null
    id has no next document: nothing replaces its last quarter, and near_next
    is null. One document alone is its own next. Other columns are not read.
    """
    # no alias where the name is right: the two uses of the exchange must be equal
    own = F.col(doc_id) if doc_id == "doc_id" else F.col(doc_id).alias("doc_id")
    every = docs.select(own, F.coalesce(F.col(text), F.lit("")).alias("text"))
    given = every.where("doc_id is not null")  # the same exchange of texts serves both joins
    order, _ = written(predecessors(given.select("doc_id", F.length("text").alias("n_chars"))), "order")
    repeated = not given.select("doc_id").groupBy("doc_id").count().where("count > 1").isEmpty()
    heads = given.join(order, "doc_id").select("prev_id", "take", "text")
    if repeated:
        heads = heads.groupBy("prev_id", "take").agg(F.min("text").alias("text"))
    heads = with_sketch(heads, "text", "next_sketch", k).select("prev_id", F.substring("text", F.lit(1), F.col("take")).alias("head"), "next_sketch")
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    both = given.join(heads, given.doc_id == heads.prev_id, "left").drop("prev_id")
    both = both.unionByName(every.where("doc_id is null"), allowMissingColumns=True).withColumn("n_chars", n.cast("bigint"))
    both = held(both, edited=F.concat(F.substring("text", F.lit(1), n - quarter), F.coalesce(F.substring("head", F.lit(1), quarter), F.lit(""))))
    both = with_sketch(with_sketch(both, "text", "sketch", k), "edited", "edited_sketch", k)
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        text_form(F.col("sketch")).alias("fingerprint"), text_form(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        F.when(F.col("next_sketch").isNotNull(), resemblance(F.col("sketch"), F.col("next_sketch"), k)).alias("near_next"),
    )
