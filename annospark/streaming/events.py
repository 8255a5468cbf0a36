"""Structured Streaming over an event log: tumbling and session counts,
duplicates within the watermark, and a last-decision table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.operators.relational import last_per_key


def tumbling(events: DataFrame, at: str = "ts", late: str = "10 minutes", width: str = "1 hour", by: str = "event_type") -> DataFrame:
    """window_start, by, n_events, total; late rows beyond the watermark do not
    count. Works on streams and on batches."""
    n = events.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), by).agg(F.count("*").alias("n_events"), F.sum("value").alias("total"))
    return n.select(F.col("w.start").alias("window_start"), by, "n_events", "total")


def session_counts(events: DataFrame, at: str = "ts", late: str = "10 minutes", gap: str = "30 minutes", key: str = "user_id") -> DataFrame:
    n = events.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count("*").alias("n_events"))
    return n.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_events")


def without_repeats(events: DataFrame, at: str = "ts", late: str = "10 minutes", key: str = "event_id") -> DataFrame:
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


class LastDecisions:
    """A table of each key's latest row, kept up by micro-batches: a batch is
    reduced first, united with the table and reduced again into a new version.
    A batch that is repeated after a failure gives the same table."""

    def __init__(self, path: str, key: str, order: list[str], values: list[str]):
        self.path, self.key, self.order, self.values = path.rstrip("/"), key, order, values

    def version(self, epoch: int) -> str:
        return f"{self.path}/epoch={epoch}"

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        values = list(dict.fromkeys([*self.values, *self.order]))
        new = last_per_key(batch, self.key, self.order, values)
        if epoch > 0:
            old = batch.sparkSession.read.schema(new.schema).parquet(self.version(epoch - 1))
            new = last_per_key(old.unionByName(new), self.key, self.order, values)
        new.write.mode("overwrite").parquet(self.version(epoch))
