"""Sinks: artifacts named by their content, canonical JSON lines, pointers,
readable views and append-only events."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.functions.hashing import canonical_json, record_json
from annospark.functions.text import markdown_cell
from annospark.operators.checks import issue, require_clean


def put_bytes(store: str, content: bytes) -> str:
    """Stores a driver-side artifact under its SHA-256; atomic, and idempotent
    by its name. Returns the digest."""
    digest = hashlib.sha256(content).hexdigest()
    target = Path(store) / digest[:2] / digest
    if target.exists():
        if hashlib.sha256(target.read_bytes()).hexdigest() != digest:
            raise ValueError(f"stored artifact {digest} is damaged")
        return digest
    target.parent.mkdir(parents=True, exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=target.parent)
    with os.fdopen(handle, "wb") as f:
        f.write(content)
        f.flush()
        os.fsync(f.fileno())
    os.replace(temporary, target)
    return digest


def get_bytes(store: str, digest: str) -> bytes:
    content = (Path(store) / digest[:2] / digest).read_bytes()
    if hashlib.sha256(content).hexdigest() != digest:
        raise ValueError(f"stored artifact {digest} is damaged")
    return content


def canonical_lines(df: DataFrame, identity: list[str]) -> DataFrame:
    """value: each row as canonical JSON, sorted by its identity; a repeated
    identity is an error."""
    require_clean(df.groupBy(*identity).count().where("count > 1").select(*issue("lines", F.concat_ws("/", *identity), "repeated_identity")))
    return df.select(*identity, record_json(*df.columns).alias("value")).orderBy(*identity).select("value")


def write_canonical_lines(df: DataFrame, identity: list[str], path: str) -> None:
    canonical_lines(df, identity).write.mode("error").text(path)


def publish_pointer(folder: str, stage: str, key: str, outputs: dict[str, str]) -> None:
    """Points a stage's key at its outputs; readers see the old or the new
    pointer, never a part of one."""
    target = Path(folder) / stage / f"{key}.json"
    target.parent.mkdir(parents=True, exist_ok=True)
    temporary = target.with_suffix(".part")
    temporary.write_text(canonical_json({"stage": stage, "key": key, "outputs": outputs}), encoding="utf-8")
    os.replace(temporary, target)


def reusable_pointer(folder: str, stage: str, key: str, store: str) -> dict[str, str] | None:
    """The outputs of a published stage, all of them checked; None without."""
    target = Path(folder) / stage / f"{key}.json"
    if not target.exists():
        return None
    outputs = json.loads(target.read_text(encoding="utf-8"))["outputs"]
    for digest in outputs.values():
        get_bytes(store, digest)
    return outputs


def newest(pointers: DataFrame, at: str) -> DataFrame:
    """The newest of matching pointers."""
    return pointers.orderBy(F.desc(at)).limit(1)


def write_view(pairs: DataFrame, path: str) -> None:
    """A readable view: two texts and their key a row, partitioned by language,
    and a CSV index beside them."""
    pairs.write.mode("error").partitionBy("source_language").json(f"{path}/texts")
    pairs.select("source_case_id", "source_language", "status").orderBy("source_case_id").write.mode("error").csv(f"{path}/index", header=True)


def attribution_table(rows: DataFrame, columns: list[str]) -> DataFrame:
    """value: the lines of a Markdown table, in the order of the first column."""
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *(markdown_cell(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns)), F.lit(" |"))
    spark = rows.sparkSession
    head = spark.createDataFrame([(0, "| " + " | ".join(columns) + " |"), (1, "|" + " --- |" * len(columns))], "o int, value string").withColumn("k", F.lit(""))
    body = rows.select(F.lit(2).alias("o"), cells.alias("value"), F.col(columns[0]).cast("string").alias("k"))
    return head.unionByName(body).orderBy("o", "k").select("value")


def append_events(events: DataFrame, path: str) -> None:
    events.write.mode("append").json(path)
