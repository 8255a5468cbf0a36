"""Relational operators over event and key tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_per_key(events: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """The latest row of each key: one aggregate with partial results, so a key
    of very many rows is reduced before it is shuffled."""
    picked = F.max_by(F.struct(*values), F.struct(*order)).alias("last")
    return events.groupBy(key).agg(picked).select(key, "last.*")


def asof_backward(left: DataFrame, right: DataFrame, key: str, at: str, value: str, name: str) -> DataFrame:
    """``left`` with the latest ``value`` of ``right`` at or before each row's
    time, per key: one union and one running window, no range join."""
    l = left.withColumns({"_v": F.lit(None).cast(right.schema[value].dataType), "_side": F.lit(1)})
    r = right.select(key, at, F.col(value).alias("_v"), F.lit(0).alias("_side"))
    run = Window.partitionBy(key).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = l.unionByName(r, allowMissingColumns=True)
    return both.withColumn(name, F.last("_v", ignorenulls=True).over(run)).where("_side = 1").drop("_v", "_side")


def sessions(events: DataFrame, key: str, at: str, gap: str = "30 minutes") -> DataFrame:
    """key, session_start, session_end, n_events by gaps of inactivity."""
    w = F.session_window(at, gap)
    n = events.groupBy(key, w.alias("w")).agg(F.count("*").alias("n_events"))
    return n.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_events")


def inverted(rows: DataFrame, key: str, item: str, items: str) -> DataFrame:
    """key and its sorted distinct items."""
    return rows.groupBy(key).agg(F.sort_array(F.collect_set(item)).alias(items))


def counts_by(rows: DataFrame, by: list[str], zero: dict[str, list[str]] | None = None) -> DataFrame:
    """Numbers of rows; with ``zero`` one column's listed values always
    appear."""
    n = rows.groupBy(*by).agg(F.count("*").alias("n_rows"))
    for column, values in (zero or {}).items():
        every = rows.sparkSession.createDataFrame([(v,) for v in values], f"`{column}` string")
        n = every.join(n, column, "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    return n


def overlaps(spans: DataFrame, key: str, width: int = 64) -> DataFrame:
    """Pairs (a, b) of spans (span_id, start, end; half-open) of one key that
    overlap, each once. Spans are dealt to cells of ``width``; a pair is made in
    the cell that holds the later start."""
    cells = spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width))))
    a, b = cells.alias("a"), cells.alias("b")
    meet = (F.col("a.start") < F.col("b.end")) & (F.col("b.start") < F.col("a.end")) & (F.col("a.span_id") < F.col("b.span_id"))
    first = F.floor(F.greatest("a.start", "b.start") / width) == F.col("a.cell")
    on = (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col("a.cell") == F.col("b.cell")) & meet & first
    return a.join(b, on).select(F.col(f"a.{key}").alias(key), F.col("a.span_id").alias("a"), F.col("b.span_id").alias("b"))


def enum_order(column: Column, values: list[str]) -> Column:
    """A sort key that follows the order of ``values``; others come last."""
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for i, v in enumerate(values) for x in (v, i))), column), F.lit(len(values)))
