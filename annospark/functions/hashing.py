"""Content identity: digests, seeded hashes, canonical JSON and derived ids."""

from __future__ import annotations

import json
import unicodedata
from typing import Any

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256(value: Column) -> Column:
    return F.sha2(value, 256)


def seeded(seed: str, value: Column) -> Column:
    """Hex SHA-256 of seed, a zero character and the value; its order is the
    order of the bytes."""
    return F.sha2(F.concat(F.lit(seed + "\0"), value.cast("string")), 256)


def seeded_offset(seed: str, value: Column, modulus: int = 4) -> Column:
    """The hash modulo a power of two up to 16, by its last digit."""
    return F.conv(F.right(seeded(seed, value), F.lit(1)), 16, 10).cast("int") % modulus


def normalized(value: Any) -> Any:
    """NFC in all strings and keys; keys that become equal are an error."""
    if isinstance(value, str):
        return unicodedata.normalize("NFC", value)
    if isinstance(value, list):
        return [normalized(v) for v in value]
    if isinstance(value, dict):
        out = {normalized(k): normalized(v) for k, v in value.items()}
        if len(out) != len(value):
            raise ValueError("keys collide after normalisation")
        return out
    return value


def canonical_json(value: Any) -> str:
    """Keys in UTF-16 order, no spaces, only needed escapes. Integers, strings,
    booleans and null only: a binary float has no place in results."""
    if isinstance(value, float):
        raise ValueError("no binary floats in canonical JSON")
    if isinstance(value, dict):
        items = sorted(value.items(), key=lambda kv: kv[0].encode("utf-16-be"))
        return "{" + ",".join(f"{canonical_json(k)}:{canonical_json(v)}" for k, v in items) + "}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(canonical_json, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


def canonical_json_column(value: Column) -> Column:
    """Canonical JSON of a JSON string column (NFC throughout)."""

    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else canonical_json(normalized(json.loads(v))) for v in values.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")(value)


def record_json(*fields: str) -> Column:
    """Canonical JSON of a row's fields, nulls included."""
    return canonical_json_column(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}))


def derived_id(prefix: str, payload: Column) -> Column:
    """An id that follows from the content."""
    return F.concat(F.lit(prefix), F.sha2(payload, 256))


def collected_sha256(role: str, stable_id: str, sha: str) -> Column:
    """Aggregate: one digest of all (role, id, digest) components, in order."""
    parts = F.sort_array(F.collect_list(F.struct(role, stable_id, sha)))
    return F.sha2(canonical_json_column(F.to_json(parts)), 256)


def decimal_text(value: Column) -> Column:
    """A decimal without trailing zeros or a trailing point."""
    text = value.cast("string")
    return F.when(F.contains(text, F.lit(".")), F.regexp_replace(text, r"\.?0+$", "")).otherwise(text)


def utc_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def strict_date(value: Column) -> Column:
    """A date written YYYY-MM-DD, else null."""
    return F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(value, "yyyy-MM-dd"))
