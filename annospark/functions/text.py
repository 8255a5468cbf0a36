"""Text functions. What Spark has built in is a column expression; Unicode
normalisation, case folding and offset maps are Arrow functions."""

from __future__ import annotations

import re
import unicodedata
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points that count as white space.
WHITE_SPACE = r"[\t-\r\x1c-\x20\x85\xa0  -     　]"
OTHER = "[^" + WHITE_SPACE[1:]

# Typographic variants and the plain character each stands for.
DOUBLE_QUOTES = "«»“”„‟"
SINGLE_QUOTES = "‘’‚‛‹›"
DASHES = "‐‑‒–—―−"

PLAIN = {ord(c): plain for chars, plain in ((DOUBLE_QUOTES, '"'), (SINGLE_QUOTES, "'"), (DASHES, "-")) for c in chars}


def _over(kind: str, arrow: pa.DataType, one):
    """An Arrow function of one string column; null stays null."""

    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else one(v) for v in values.to_pylist()], arrow)

    return F.arrow_udf(run, kind)


def line_feeds(text: Column) -> Column:
    """CR LF and CR become LF."""
    return F.regexp_replace(text, r"\r\n?", "\n")


def canonical(text: Column) -> Column:
    """NFC with line feeds. ASCII rows stay in the JVM's expression; only others
    are worth normalising, but both give the same text."""
    nfc = _over("string", pa.string(), lambda v: unicodedata.normalize("NFC", v))
    lf = line_feeds(text)
    return F.when(F.octet_length(lf) == F.length(lf), lf).otherwise(nfc(lf))


def tokens(text: Column) -> Column:
    """The runs of characters between white space."""
    return F.filter(F.split(text, WHITE_SPACE + "+"), lambda t: t != "")


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(OTHER + "+")).cast("bigint")


def stratum(n_tokens: Column) -> Column:
    """short below 200 tokens, medium to 400, long above."""
    return F.when(n_tokens < 200, "short").when(n_tokens <= 400, "medium").otherwise("long")


def stratum_order(name: Column) -> Column:
    return F.when(name == "short", 0).when(name == "medium", 1).otherwise(2)


def filled_lines(text: Column) -> Column:
    """Lines that hold more than white space: places where one first does, each
    up to the line's end."""
    return F.regexp_count(text, F.lit(OTHER + r"[^\n]*")).cast("bigint")


def plain_typography(text: Column) -> Column:
    """Quotes and dashes in their plain form, white space runs as one space."""
    for chars, plain in ((DOUBLE_QUOTES, '"'), (SINGLE_QUOTES, "'"), (DASHES, "-")):
        text = F.translate(text, chars, plain * len(chars))
    return F.regexp_replace(text, WHITE_SPACE + "+", " ")


def positions(text: Column, needle: Column) -> Column:
    """All places (from 0, overlapping ones too) of ``needle``; none for an
    empty needle."""
    n = F.length(needle)
    every = F.sequence(F.lit(0), F.greatest(F.length(text) - n, F.lit(0)))
    found = F.filter(every, lambda i: F.substring(text, i + 1, n) == needle)
    return F.when((n > 0) & F.contains(text, needle), found).otherwise(F.array().cast("array<int>"))


def slice_of(text: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to before ``end``."""
    return F.substring(text, start + 1, end - start)


def snippet_holds(text: Column, start: Column, end: Column, snippet: Column) -> Column:
    """Whether a span lies inside the text, is not empty and reads ``snippet``."""
    inside = (start >= 0) & (end > start) & (end <= F.length(text))
    return F.coalesce(inside & (slice_of(text, start, end) == snippet), F.lit(False))


_FOLD_WORD = re.compile(r"\w+")


def fold_text(value: str) -> str:
    """Case folded, without marks, its words joined by single spaces."""
    open_form = unicodedata.normalize("NFKD", value.casefold())
    return " ".join(_FOLD_WORD.findall("".join(c for c in open_form if not unicodedata.combining(c))))


def fold(value: Column) -> Column:
    return _over("string", pa.string(), fold_text)(value)


def percent_encode(value: Column) -> Column:
    """UTF-8 percent encoding of all but unreserved characters."""
    return _over("string", pa.string(), lambda v: quote(v, safe=""))(value)


def utf16_length(text: Column) -> Column:
    return F.octet_length(F.encode(text, "UTF-16LE")) / 2


def markdown_cell(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(text, F.lit("|"), F.lit("\\|")), r"\s*\n\s*", " "))


def filled_prompt(template: Column, values: dict[str, Column]) -> Column:
    """``{{name}}`` places of a template filled in."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{{" + name + "}}"), value)
    return template


def is_identifier(value: Column) -> Column:
    """Trimmed, not empty, without control characters."""
    return F.coalesce(~value.rlike(rf"^{WHITE_SPACE}|{WHITE_SPACE}\z") & (value != "") & ~value.rlike(r"\p{C}"), F.lit(False))


def id_list(value: Column, pattern: str = r"^HP:\d{7}$") -> Column:
    """ids (trimmed parts of a comma list) and whether all fit ``pattern``."""
    ids = F.transform(F.split(value, ","), lambda v: F.regexp_replace(v, rf"^{WHITE_SPACE}+|{WHITE_SPACE}+\z", ""))
    return F.struct(ids.alias("ids"), F.forall(ids, lambda v: v.rlike(pattern)).alias("valid"))


def canonical_offsets(text: str) -> tuple[str, list[int | None]]:
    """The canonical text without one final line feed, and for each UTF-16
    offset of ``text`` its canonical offset, or None inside a character that
    normalisation composes."""
    out, at = [], [0]
    i, n = 0, len(text)
    length = 0
    while i < n:
        j = i + 1
        if text[i] == "\r" and j < n and text[j] == "\n":
            j += 1
            piece = "\n"
        elif text[i] == "\r":
            piece = "\n"
        else:
            # a cluster ends where the next character neither combines nor composes
            while j < n and (unicodedata.combining(text[j]) or unicodedata.normalize("NFC", text[i : j + 1]) != unicodedata.normalize("NFC", text[i:j]) + unicodedata.normalize("NFC", text[j])):
                j += 1
            piece = unicodedata.normalize("NFC", text[i:j])
        units = sum(2 if ord(c) > 0xFFFF else 1 for c in text[i:j])
        at.extend([None] * (units - 1))
        length += len(piece)
        at.append(length)
        out.append(piece)
        i = j
    value = "".join(out)
    return (value[:-1] if value.endswith("\n") else value), at


def utf16_spans(text: Column, spans: Column) -> Column:
    """For each (first, past) UTF-16 span of a text its canonical span, null
    where an end is no boundary or lies outside: one map for each text."""
    kind = pa.list_(pa.struct([("start_char", pa.int32()), ("end_char", pa.int32()), ("text_snippet", pa.string())]))

    def run(texts: pa.Array, all_spans: pa.Array) -> pa.Array:
        rows = []
        for body, own in zip(texts.to_pylist(), all_spans.to_pylist()):
            if body is None or own is None:
                rows.append(None)
                continue
            value, at = canonical_offsets(body)
            found = []
            for s in own:
                first, past = s["first"], s["past"]
                ok = 0 <= first < past < len(at) and at[first] is not None and at[past] is not None and at[past] <= len(value)
                found.append({"start_char": at[first], "end_char": at[past], "text_snippet": value[at[first] : at[past]]} if ok else None)
            rows.append(found)
        return pa.array(rows, kind)

    return F.arrow_udf(run, "array<struct<start_char:int,end_char:int,text_snippet:string>>")(text, spans)
