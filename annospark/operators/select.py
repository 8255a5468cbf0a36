"""Deterministic selection: systematic split, pilots, batches and
farthest-first picks."""

from __future__ import annotations

from fractions import Fraction
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annospark.functions.hashing import seeded, seeded_offset
from annospark.functions.text import stratum_order
from annospark.sources.tables import cut


def systematic_split(inventory: DataFrame, seed: str, langs: list[str], into: str = "de", every: int = 4, key: str = "doc_id") -> DataFrame:
    """``inventory`` rows in ``langs`` with ``group``: in each language, ordered
    by stratum, density and seeded hash, every fourth row from a seeded offset
    goes to ``into``, the others stay in their language.

    Texts are counted once, before the rows are dealt.
    """
    rows = inventory.where(F.col("lang").isin(langs)).withColumns({"_by": seeded(seed, F.col(key)), "_s": stratum_order(F.col("stratum"))})
    ranked = ranks(rows, ["lang"], ["_s", "density", "_by", key])
    chosen = F.pmod(F.col("_rank"), F.lit(every)) == seeded_offset(seed, F.col("lang"), every)
    return ranked.withColumn("group", F.when(chosen, into).otherwise(F.col("lang"))).drop("_by", "_s", "_rank")


def ranks(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``_rank`` (from 0) in each group by ``order``. Rows are
    dealt by range and written once; a rank is the place in its partition plus
    the group's rows in the partitions before, so a group of any size is spread
    over tasks. Null keys form a group."""
    dealt = cut(rows.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy(*by, "_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_part")) - F.col("_n")
    starts = sizes.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(by)), F.col("_part").alias("_p"), before.alias("_start"))
    own = F.row_number().over(Window.partitionBy("_part", *by).orderBy(*order)) - 1
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_{i}"))
    return dealt.withColumn("_own", own).join(starts, same).select(*rows.columns, (F.col("_start") + F.col("_own")).alias("_rank"))


def first_by_hash(rows: DataFrame, seed: str, by: list[str], key: str = "doc_id") -> DataFrame:
    """The row of the smallest seeded hash in each group: an aggregate with
    partial results, no sort."""
    return rows.groupBy(*by).agg(F.min_by(key, F.struct(seeded(seed, F.col(key)), F.col(key))).alias(key))


def batches(rows: DataFrame, size: int, by: list[str], order: list[str]) -> DataFrame:
    """``rows`` with batch_no (from 1) and batch_id within each group."""
    no = F.floor(F.col("_rank") / size) + 1
    placed = ranks(rows, by, order).withColumn("batch_no", no.cast("bigint")).drop("_rank")
    return placed.withColumn("batch_id", F.format_string("batch-%02d", F.col("batch_no")))


def global_batches(rows: DataFrame, size: int, order: list[str], parts: int) -> DataFrame:
    """``rows`` with place (from 0) and batch_no over the whole table: ranks
    within range partitions plus the sizes of those before, one row each."""
    dealt = rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    placed = dealt.withColumn("_own", own).join(F.broadcast(starts), "_part").withColumn("place", F.col("_start") + F.col("_own"))
    return placed.withColumn("batch_no", (F.floor(F.col("place") / size) + 1).cast("bigint")).drop("_part", "_own", "_start")


def farthest_first(rows: DataFrame, by: list[str], features: list[tuple[str, str]], counts: dict[str, int], stratum: str, seed: str, key: str = "doc_id") -> DataFrame:
    """From each group as many rows as ``counts`` says for its stratum, each as
    far as possible from those before: exact rationals, min-max scaled; first
    the one farthest from the centroid; ties by seeded hash.

    ``features``: (numerator, denominator) columns. A group's distances are
    kept as running minima, so a pick costs one pass over the group. A group
    that is too small is an error.
    """
    names = [*by, key]
    columns = list(dict.fromkeys([*names, *(c for pair in features for c in pair)]))

    def pick(group: pd.DataFrame) -> pd.DataFrame:
        wanted = counts[group[stratum].iloc[0]]
        if len(group) < wanted:
            raise ValueError(f"a group has {len(group)} rows where {wanted} are to be picked")
        vectors = [[Fraction(int(a), int(b)) for a, b in zip(row[::2], row[1::2])] for row in group[[c for p in features for c in p]].to_numpy()]
        for d in range(len(features)):
            values = [v[d] for v in vectors]
            low, span = min(values), max(values) - min(values)
            for v in vectors:
                v[d] = (v[d] - low) / span if span else Fraction()
        ties = [sha256(f"{seed}\0{k}".encode()).hexdigest() for k in group[key]]
        centre = [sum(v[d] for v in vectors) / len(vectors) for d in range(len(features))]
        far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
        left = set(range(len(vectors)))
        nearest = {i: far(vectors[i], centre) for i in left}
        picked: list[int] = []
        while len(picked) < wanted:
            top = max(nearest[i] for i in left)
            best = min((i for i in left if nearest[i] == top), key=ties.__getitem__)
            left.remove(best)
            away = {i: far(vectors[i], vectors[best]) for i in left}
            nearest = away if not picked else {i: min(nearest[i], away[i]) for i in left}
            picked.append(best)
        out = group.iloc[picked][names].copy()
        out["pick_no"] = range(1, len(picked) + 1)
        return out

    schema = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names) + ", pick_no int"
    return rows.select(*columns).groupBy(*by).applyInPandas(pick, schema)
