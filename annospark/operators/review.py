"""Human review: imports with all issues, decision tables, last decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annospark.functions.hashing import strict_date
from annospark.functions.text import canonical, utf16_length
from annospark.functions.text import WHITE_SPACE
from annospark.operators.checks import issue
from annospark.operators.relational import last_per_key

DECISIONS = ["accept_unchanged", "accept_corrected", "reject"]
CHANGES = ["none", "minor", "major"]
ACCEPTED = ["accept_unchanged", "accept_corrected"]
CELL_LIMIT = 32767


def decision_fits(decision: Column, proposed: Column, machine: Column, change: Column, rationale: Column) -> Column:
    """Unchanged needs the machine's text and no clinical change; corrected
    needs another text; rejected needs a rationale. A change that is not none
    needs a rationale as well."""
    filled = lambda c: ~c.rlike(rf"^{WHITE_SPACE}*\z")
    said = F.coalesce(filled(rationale), F.lit(False))
    fits = (
        F.when(decision == "accept_unchanged", (proposed == machine) & (change == "none"))
        .when(decision == "accept_corrected", (proposed != machine) & filled(proposed))
        .when(decision == "reject", said)
    )
    return F.coalesce(fits & ((change == "none") | said), F.lit(False))


def import_review(rows: DataFrame, export: DataFrame, meta: dict[str, str], expected: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(decisions, issues). ``rows`` and ``export`` share source_case_id,
    source_text and tllm_text; rows add proposed_text, decision,
    clinical_change, clinical_change_rationale. Use the decisions only where
    there are no issues."""
    spark = rows.sparkSession
    key = F.col("source_case_id")
    wrong = [(k, "missing" if not meta.get(k) else "mismatch") for k, v in expected.items() if meta.get(k) != v]
    heads = spark.createDataFrame([("review", k, f"metadata_{w}", None) for k, w in wrong], "operator string, key string, reason string, detail string")
    both = rows.alias("r").join(export.alias("e"), F.col("r.source_case_id") == F.col("e.source_case_id"), "full_outer")
    case = F.coalesce("r.source_case_id", "e.source_case_id")
    lost = both.where("r.source_case_id is null or e.source_case_id is null")
    found = lost.select(*issue("review", case, F.when(F.col("r.source_case_id").isNull(), "missing_case").otherwise("unknown_case")))
    twice = rows.groupBy("source_case_id").count().where("count > 1").select(*issue("review", key, "repeated_case"))
    hit = both.where("r.source_case_id is not null and e.source_case_id is not null")
    rules = [
        ("source_text_changed", F.col("r.source_text") != F.col("e.source_text")),
        ("machine_text_changed", F.col("r.tllm_text") != F.col("e.tllm_text")),
        ("unknown_decision", ~F.coalesce(F.col("r.decision").isin(DECISIONS), F.lit(False))),
        ("unknown_clinical_change", ~F.coalesce(F.col("r.clinical_change").isin(CHANGES), F.lit(False))),
        ("cell_too_long", F.octet_length(F.encode("r.proposed_text", "UTF-16LE")) / 2 > CELL_LIMIT),
        ("decision_not_allowed", ~decision_fits(F.col("r.decision"), F.col("r.proposed_text"), F.col("e.tllm_text"), F.col("r.clinical_change"), F.col("r.clinical_change_rationale"))),
    ]
    broken = hit.select(case.alias("k"), F.explode(F.filter(F.array(*(F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in rules)), lambda v: v.isNotNull())).alias("why"))
    issues = heads.unionByName(found).unionByName(twice).unionByName(broken.select(*issue("review", F.col("k"), F.col("why"))))
    return hit.select("r.*"), issues


#: Values of a translation review's workbook.
WORKBOOK_DECISIONS = ["unverändert akzeptiert", "korrigiert akzeptiert", "Rückfrage", "abgelehnt"]
WORKBOOK_CHANGES = ["keine", "vorhanden"]
WORKBOOK_CATEGORIES = ["Auslassung", "Hinzufügung", "Negation oder Aussagesicherheit", "Zahl oder Einheit", "Anatomie oder Lateralität", "Terminologie", "Quellproblem"]
_METADATA = ["selection_id", "review_policy_id", "reviewer_id", "reviewer_qualification", "reviewed_languages", "review_date"]
_CELLS = ["source_case_id", "source_language", "source_text", "tllm_text", "proposed_text", "decision", "clinical_change", "clinical_change_category", "clinical_change_rationale", "reviewer_comment"]


def workbook_decision_fits(decision: Column, changed: Column, change: Column, category: Column, rationale: Column) -> Column:
    """The reference's decision table. Unchanged: the machine's text, no change
    and no details. Corrected: another text, and no change without details or a
    change with both. Question and rejection: a change with both."""
    both, neither = category.isNotNull() & rationale.isNotNull(), category.isNull() & rationale.isNull()
    plain, present = (change == "keine") & neither, (change == "vorhanden") & both
    fits = F.when(decision == WORKBOOK_DECISIONS[0], ~changed & plain).when(decision == WORKBOOK_DECISIONS[1], changed & (plain | present)).otherwise(present)
    return F.coalesce(fits, F.lit(False))


def import_translation_review(rows: DataFrame, export: DataFrame, meta: dict[str, str], expected: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(decisions, issues) of a translation review's workbook, by all the
    reference's checks of metadata and rows; use the decisions only where there
    are no issues. ``rows``: the workbook's ten columns and nmt_text (null where
    it has none), null cells being empty; ``export``: source_case_id,
    source_language, source_text, tllm_text, nmt_text; ``expected``:
    selection_id and review_policy_id. An issue's detail is its field."""
    spark = rows.sparkSession
    heads = []
    for field in _METADATA:
        value = meta.get(field) or ""
        heads += [(field, "required")] * (not value) + [(field, "cell_too_long")] * (len(value.encode("utf-16-le")) // 2 > CELL_LIMIT)
        heads += [(field, "mismatch")] * (field in expected and value != expected[field])
    day = meta.get("review_date") or ""
    if day and spark.range(1).select(valid_review_date(F.lit(day)).alias("ok")).first().ok is not True:
        heads.append(("review_date", "invalid_date"))
    issues = spark.createDataFrame([("review", f, f"metadata_{w}", f) for f, w in heads], "operator string, key string, reason string, detail string")

    r = rows.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in _CELLS), "nmt_text").alias("r")
    e = export.alias("e")
    has = lambda df: df.agg(F.coalesce(F.bool_or(F.col("nmt_text").isNotNull()), F.lit(False)).alias("has"))
    column = has(rows).alias("a").crossJoin(has(export).alias("b")).where("a.has <> b.has")
    issues = issues.unionByName(column.select(*issue("review", F.lit(None), "column_presence_differs", F.lit("nmt_text"))))
    twice = r.groupBy("source_case_id").count().where("count > 1").select(*issue("review", F.col("source_case_id"), "repeated_case", F.lit("source_case_id")))
    lost = e.join(r, F.col("e.source_case_id") == F.col("r.source_case_id"), "left_anti")
    issues = issues.unionByName(twice).unionByName(lost.select(*issue("review", F.col("source_case_id"), "missing_case", F.lit("source_case_id"))))

    both = r.join(e.withColumn("known", F.lit(True)).alias("e"), F.col("r.source_case_id") == F.col("e.source_case_id"), "left")
    known = F.col("e.known").isNotNull()
    cell = {c: F.col(f"r.{c}") for c in [*_CELLS, "nmt_text"]}
    given = lambda c, values: F.when(cell[c].isin(values), cell[c])
    decision, change, category = given("decision", WORKBOOK_DECISIONS), given("clinical_change", WORKBOOK_CHANGES), given("clinical_change_category", WORKBOOK_CATEGORIES)
    changed = canonical(cell["proposed_text"]) != canonical(F.col("e.tllm_text"))
    differs = lambda c: known & F.col(f"e.{c}").isNotNull() & (cell[c].isNull() | (canonical(cell[c]) != canonical(F.col(f"e.{c}"))))
    rules = [
        ("unknown_case", "source_case_id", ~known),
        *(("cell_too_long", c, utf16_length(v) > CELL_LIMIT) for c, v in cell.items()),
        *(("required", c, cell[c] == "") for c in ("proposed_text", "decision", "clinical_change")),
        *(("not_allowed_value", c, (cell[c] != "") & v.isNull()) for c, v in (("decision", decision), ("clinical_change", change), ("clinical_change_category", category))),
        ("export_differs", "source_language", known & ~cell["source_language"].eqNullSafe(F.col("e.source_language"))),
        *(("export_differs", c, differs(c)) for c in ("source_text", "tllm_text", "nmt_text")),
        ("decision_not_allowed", "decision", decision.isNotNull() & change.isNotNull() & changed & ~workbook_decision_fits(decision, F.lit(True), change, category, F.nullif(cell["clinical_change_rationale"], F.lit("")))),
        ("decision_not_allowed", "decision", decision.isNotNull() & change.isNotNull() & ~changed & ~workbook_decision_fits(decision, F.lit(False), change, category, F.nullif(cell["clinical_change_rationale"], F.lit("")))),
    ]
    found = F.filter(F.array(*(F.when(c, F.struct(F.lit(why).alias("why"), F.lit(field).alias("field"))) for why, field, c in rules)), lambda v: v.isNotNull())
    broken = both.select(cell["source_case_id"].alias("k"), F.explode(found).alias("x"))
    return both.where(known).select("r.*"), issues.unionByName(broken.select(*issue("review", F.col("k"), F.col("x.why"), F.col("x.field"))))


def valid_review_date(value: Column) -> Column:
    return strict_date(value).isNotNull()


def accepted_cases(decisions: DataFrame, key: str = "case_id", order: list[str] = ["decided_at", "decision_id"]) -> DataFrame:
    """Cases whose last decision accepts them; a later rejection removes one."""
    rest = [c for c in decisions.columns if c != key]
    return last_per_key(decisions, key, order, rest).where(F.col("decision").isin(ACCEPTED))


def status_counts(decisions: DataFrame, key: str, order: list[str], status: str) -> DataFrame:
    return last_per_key(decisions, key, order, [status]).groupBy(status).agg(F.count("*").alias("n_cases"))
