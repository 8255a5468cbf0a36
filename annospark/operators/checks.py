"""Errors as data: validating operators give good rows and ``issues``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def issue(operator: str, key: Column, reason: Column | str, detail: Column | None = None) -> list[Column]:
    """The columns of an issues table."""
    said = F.lit(reason) if isinstance(reason, str) else reason
    return [
        F.lit(operator).alias("operator"), key.cast("string").alias("key"), said.alias("reason"),
        (F.lit(None) if detail is None else detail).cast("string").alias("detail"),
    ]


def require_clean(issues: DataFrame) -> None:
    """Raises with the first issues, where there are any."""
    first = issues.limit(5).collect()
    if first:
        raise ValueError("; ".join(f"{r.operator}: {r.key}: {r.reason}" + (f" ({r.detail})" if r.detail else "") for r in first))


def repeated(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def missing(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose keys ``other`` lacks."""
    return df.join(other.select(*on).distinct(), on, "left_anti")


def one_sided(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """One row: only_left, only_right, common numbers of distinct keys. Both
    sides are reduced to keys and combined before the one shuffle."""
    marks = left.select(*on, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(*on, F.lit(0).alias("l"), F.lit(1).alias("r")))
    by_key = marks.groupBy(*on).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return by_key.agg(
        F.count_if((F.col("l") == 1) & (F.col("r") == 0)).alias("only_left"),
        F.count_if((F.col("l") == 0) & (F.col("r") == 1)).alias("only_right"),
        F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("common"),
    )


def resolved_once(refs: DataFrame, targets: DataFrame, ref: str, target: str) -> DataFrame:
    """Issues for references that do not resolve to exactly one target."""
    n = targets.groupBy(F.col(target).alias("_t")).agg(F.count("*").alias("n_targets"))
    found = refs.join(n, F.col(ref) == F.col("_t"), "left").withColumn("n_targets", F.coalesce("n_targets", F.lit(0)))
    reason = F.when(F.col("n_targets") == 0, "unresolved_reference").otherwise("ambiguous_reference")
    return found.where("n_targets <> 1").select(*issue("reference", F.col(ref), reason, F.col("n_targets")))


def merged_sets(*sets: DataFrame, key: str, payload: list[str]) -> tuple[DataFrame, DataFrame]:
    """The union of record sets, each record once; and issues for keys that
    stand for different contents. The order of the sets does not matter."""
    every = sets[0]
    for s in sets[1:]:
        every = every.unionByName(s)
    digest = F.sha2(F.to_json(F.struct(*payload), {"ignoreNullFields": "false"}), 256)
    by_key = every.groupBy(key).agg(F.count_distinct(digest).alias("n_contents"), F.min(F.struct(*payload)).alias("one"))
    good = by_key.where("n_contents = 1").select(key, "one.*")
    return good, by_key.where("n_contents > 1").select(*issue("merge", F.col(key), "conflicting_content", F.col("n_contents")))
