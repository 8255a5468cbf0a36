"""Translation checks, reuse, cost and recheck."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.functions.text import WHITE_SPACE, filled_lines

# Units that count behind a number, longer ones before those they
# begin with.
UNITS = ["mmhg", "mmol", "mosm", "bpm", "u/l", "µg", "ug", "µl", "ul", "mg", "kg", "ng", "ml", "dl", "mm", "cm", "hz", "ui", "iu", "ie", r"°\s*c", "%", "g", "l", "m"]

#: A number that is no part of a word or of a longer number, with its unit if
#: one follows; neither may run into a word. Letters may be decomposed.
_WORD = r"[\p{L}\p{N}_]"
QUANTITY = rf"(?iU)(?<!{_WORD}|\.|{_WORD}\p{{M}})(\p{{Nd}}+(?:[.,]\p{{Nd}}+)?)\s*({'|'.join(UNITS)})?(?!{_WORD})"

CHECKS = ["nonempty_output", "source_changed", "length_ratio", "units_added", "target_language_de"]
CHECK_KIND = "array<struct<code:string,passed:boolean,detail:string>>"


def quantities(text: Column) -> Column:
    """The distinct (value, unit) of a text's numbers, unit empty where none
    follows. A decimal comma is a point, and a point before three digits only
    parts groups of digits; units are lower-cased without spaces."""
    value, unit = (F.regexp_extract_all(text, F.lit(QUANTITY), F.lit(i)) for i in (1, 2))
    point = lambda v: F.regexp_replace(F.translate(v, ",", "."), r"^(\p{Nd}{1,3})\.(\p{Nd}{3})$", "$1$2")
    plain = lambda u: F.translate(F.lower(u), "µ ", "μ")
    return F.array_distinct(F.zip_with(value, unit, lambda v, u: F.struct(point(v).alias("value"), plain(u).alias("unit"))))


def added_units(source: Column, target: Column) -> Column:
    """Units that the translation puts to a value which the source has without
    them, sorted; values that only one side has do not count."""
    known = quantities(source)
    new = F.filter(F.array_except(quantities(target), known), lambda q: (q["unit"] != "") & F.array_contains(known["value"], q["value"]))
    return F.array_sort(F.array_distinct(new["unit"]))


def checks(source: Column, target: Column, added: Column, language: Column) -> Column:
    """The five checks as ARRAY<STRUCT<code, passed, detail>>."""
    ratio = F.when(F.length(source) > 0, F.length(target) / F.length(source)).otherwise(0.0)
    lines = F.format_string("ratio=%.3f paragraphs=%d/%d", ratio, filled_lines(source), filled_lines(target))
    none = F.lit(None).cast("string")
    rows = [
        (~target.rlike(rf"^{WHITE_SPACE}*\z"), none), (target != source, none), (ratio.between(0.35, 3.0), lines),
        (F.size(added) == 0, F.when(F.size(added) > 0, F.array_join(added, ", "))), (F.coalesce(language == "de", F.lit(False)), none),
    ]
    return F.array(*(F.struct(F.lit(c).alias("code"), p.alias("passed"), d.alias("detail")) for c, (p, d) in zip(CHECKS, rows)))


def all_passed(checked: Column) -> Column:
    return F.forall(checked, lambda c: c["passed"])


def checked(pairs: DataFrame, detector) -> DataFrame:
    """``pairs`` (source_text, translated_text, nulls as empty) with
    added_units, checks and status. ``detector``: a column function that names
    a text's language, such as a Pandas or Arrow function."""
    source, target = (F.coalesce(F.col(c), F.lit("")) for c in ("source_text", "translated_text"))
    out = pairs.withColumns({"added_units": added_units(source, target), "detected": detector(target)})
    out = out.withColumn("checks", checks(source, target, F.col("added_units"), F.col("detected")))
    return out.withColumn("status", F.when(all_passed(F.col("checks")), "ready_for_review").otherwise("flagged"))


def recheck(records: DataFrame, detector) -> DataFrame:
    """Checks anew; a human verdict (reviewed, accepted) and a failed call keep
    their status. Adds changed."""
    again = checked(records.withColumnsRenamed({"checks": "old_checks", "status": "old_status"}), detector)
    fixed = F.col("old_status").isin("reviewed", "accepted", "failed")
    again = again.withColumn("status", F.when(fixed, F.col("old_status")).otherwise(F.col("status")))
    changed = ~F.col("checks").eqNullSafe(F.col("old_checks")) | ~F.col("status").eqNullSafe(F.col("old_status"))
    return again.withColumn("changed", changed).drop("old_checks", "old_status")


REUSED = ["source_language", "document_sha256", "provider", "model", "model_version", "location", "glossary", "target_language", "recipe_sha256"]
REUSABLE = ["ready_for_review", "flagged", "reviewed", "accepted"]


def to_translate(inputs: DataFrame, previous: DataFrame, key: str = "source_case_id", same: list[str] = REUSED) -> tuple[DataFrame, DataFrame]:
    """(inputs to translate, earlier records that still hold): an earlier record
    is reused where its status allows and all of ``same`` agree."""
    p = previous.where(F.col("status").isin(REUSABLE))
    hold = p.join(inputs.select(key, *same), [key, *same], "left_semi")
    return inputs.join(hold.select(key), key, "left_anti"), hold


def cost(texts: DataFrame, text: str, price_per_million: str, fixed: str = "0") -> DataFrame:
    """n_texts, code_points, usd: exact decimals."""
    n = F.coalesce(F.sum(F.length(text).cast("bigint")), F.lit(0))
    usd = n.cast("decimal(20,0)") * F.lit(price_per_million).cast("decimal(12,6)") / F.lit(1000000).cast("decimal(7,0)") + F.lit(fixed).cast("decimal(12,6)")
    return texts.agg(F.count("*").alias("n_texts"), n.alias("code_points"), usd.cast("decimal(28,10)").alias("usd"))


def translate(inputs: DataFrame, provider) -> DataFrame:
    """``inputs`` (source_case_id, source_language, source_text) with
    translated_text and error. ``provider()`` gives a worker's translating
    function (text, language) -> text; a text it fails on is a row with its
    error, not a failed run."""
    def run(batches):
        call = provider()
        for batch in batches:
            out, errors = [], []
            for text, lang in zip(batch.column("source_text").to_pylist(), batch.column("source_language").to_pylist()):
                try:
                    out.append(call(text, lang))
                    errors.append(None)
                except Exception as error:  # noqa: BLE001  the provider is foreign code
                    out.append(None)
                    errors.append(f"{type(error).__name__}: {error}")
            yield batch.append_column("translated_text", pa.array(out, pa.string())).append_column("error", pa.array(errors, pa.string()))

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inputs.schema)
    return inputs.mapInArrow(run, f"{kind}, translated_text string, error string")
