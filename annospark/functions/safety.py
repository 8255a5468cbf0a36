"""Checks of published text: credentials, forbidden paths, nested strings and
text differences."""

from __future__ import annotations

import difflib
import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.operators.checks import issue

# Names of assignments, forms of well-known credentials, and
# whole values that stand for none. All as in the reference.
_NAME = (
    r"(?<name>(?:[A-Za-z][A-Za-z0-9]*[-_]){0,2}(?:api[-_]?key|client[-_]?secret|secret[-_]?access[-_]?key|secret|token|password"
    r"|credential|private[-_]?key|access[-_]?key(?:[-_]?id)?))"
)
_QUOTE = r"(?<quote>[\"']?)"
_BARE = r"[A-Za-z0-9_./+~=@:%-]+"
# (?d): only line feeds end lines, as in Python. A value is the third group.
ASSIGNMENT = rf"(?imdu)^[ \t]*(?:export[ \t]+)?{_QUOTE}{_NAME}\k<quote>[ \t]*[:=][ \t]*(?<value>\"[^\"\r\n]*\"|'[^'\r\n]*'|{_BARE})[ \t]*,?[ \t]*(?:#[^\r\n]*)?$"
STRUCTURED_ASSIGNMENT = (
    rf"(?idu)(?:(?<=\{{)|(?<=,))[ \t\r\n]*{_QUOTE}{_NAME}\k<quote>[ \t\r\n]*:[ \t\r\n]*"
    rf"(?<value>\"(?:\\.|[^\"\\\r\n])*+\"|'(?:\\.|[^'\\\r\n])*+'|{_BARE})(?=[ \t\r\n]*(?:[,}}\]#]|$))"
)
SIGNATURES = [
    r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])",
    r"(?<![A-Za-z0-9])github_pat_[A-Za-z0-9_]{50,}",
    r"(?<![A-Z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Z0-9])",
    r"(?iU)\bBearer[ \t]+[A-Za-z0-9._~+/=-]{20,}",
    r"-----BEGIN (?:(?:RSA|EC|OPENSSH|DSA|ENCRYPTED) )?PRIVATE KEY-----",
    r"-----BEGIN PGP " + r"PRIVATE KEY BLOCK-----",
]
PLACEHOLDERS = ["changeme", "dummy", "example", "must not be logged", "placeholder", "redacted", "replace-me", "replace_me", "short", "test-only", "test_only"]


#: Whole values that ``safety_issues`` lets pass besides: your_token_goes_here.
YOUR_OWN = r"(?i)^your(?:[_-][a-z]+)+(?:[_-]\d+)?\z"


def _placeholder(value: Column) -> Column:
    bare = value
    for edge in (r"\s", r"[\"']", r"\s"):
        bare = F.regexp_replace(bare, rf"(?U)^{edge}+|{edge}+\z", "")
    whole = r"(?s)^(?:<.*>|\$\{.*\}|\$[A-Za-z_][A-Za-z0-9_]*|[xX]+|0+|\*+)\z"
    return (F.length(bare) < 12) | F.lower(bare).isin(PLACEHOLDERS) | bare.rlike(whole)


def has_credential(text: Column, besides: str | None = None) -> Column:
    """Whether a text holds a credential's signature, or gives a name like
    ``password`` a value that is no placeholder, nor matches ``besides``
    without its quotes."""
    signed = F.lit(False)
    for pattern in SIGNATURES:
        signed = signed | text.rlike(pattern)
    body = F.regexp_replace(text, r"^\uFEFF+", "")
    values = F.concat(*(F.regexp_extract_all(body, F.lit(p), F.lit(3)) for p in (ASSIGNMENT, STRUCTURED_ASSIGNMENT)))
    real = lambda v: ~_placeholder(v) & ~(F.btrim(v, F.lit("\"'")).rlike(besides) if besides else F.lit(False))
    return F.coalesce(signed | F.exists(values, real), F.lit(False))


def safety_issues(files: DataFrame, forbidden: list[str]) -> DataFrame:
    """Issues of files (path, text): paths that are forbidden or lie below a
    forbidden one, and credentials."""
    bad_path = F.lit(False)
    for prefix in forbidden:
        folder = prefix.rstrip("/")
        bad_path = bad_path | (F.col("path") == folder) | F.startswith("path", F.lit(folder + "/"))
    return files.where(bad_path).select(*issue("safety", F.col("path"), "forbidden_path")).unionByName(
        files.where(has_credential(F.col("text"), YOUR_OWN)).select(*issue("safety", F.col("path"), "credential"))
    )


def allowed_fields(json_text: Column, allowed: list[str]) -> Column:
    """Names of a JSON object's fields that are not allowed; null for no
    object."""
    return F.array_except(F.json_object_keys(json_text), F.array(*map(F.lit, allowed)))


def _leaves(value) -> list[str]:
    if isinstance(value, str):
        return [value]
    if isinstance(value, dict):
        value = [x for pair in value.items() for x in pair]
    return [s for v in value for s in _leaves(v)] if not isinstance(value, (int, float, type(None))) else []


def nested_strings(json_text: Column) -> Column:
    """All strings in a JSON text, at any depth, the names of fields among
    them; null where it is no JSON."""

    def run(values: pa.Array) -> pa.Array:
        rows = []
        for v in values.to_pylist():
            try:
                rows.append(None if v is None else _leaves(json.loads(v)))
            except ValueError:
                rows.append(None)
        return pa.array(rows, pa.list_(pa.string()))

    return F.arrow_udf(run, "array<string>")(json_text)


def _difference(a: str, b: str, before: str, after: str) -> str:
    out = []
    for line in difflib.unified_diff(a.splitlines(keepends=True), b.splitlines(keepends=True), before, after):
        out.append(line if line.endswith("\n") else line + "\n\\ No newline at end of file\n")
    return "".join(out)


def unified_diff(before: Column, after: Column, name_before: str = "before", name_after: str = "after") -> Column:
    """A unified difference that marks a missing last line feed; empty for
    equal texts, null where a text is null."""

    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([None if x is None or y is None else _difference(x, y, name_before, name_after) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.string())

    return F.arrow_udf(run, "string")(before, after)
