"""Corpus building, curation checks and single-term sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annospark.functions.hashing import derived_id, record_json
from annospark.functions.text import snippet_holds
from annospark.operators.checks import issue, resolved_once
from annospark.operators.review import accepted_cases


def build_corpus(groups: DataFrame, native: DataFrame, reviews: DataFrame, target: str = "de") -> tuple[DataFrame, DataFrame]:
    """(entries, pending). ``groups``: case_id, lang, group; ``native``: case_id,
    text; ``reviews``: case_id, decision, proposed_text, decided_at,
    decision_id. Cases of ``target`` take the reviewed text and cite the
    decision, or wait; others take their own text."""
    done = accepted_cases(reviews).select("case_id", "proposed_text", F.col("decision_id").alias("review"))
    all_ = groups.join(native, "case_id").join(done, "case_id", "left")
    translated = F.col("group") == target
    entry = all_.select(
        F.concat_ws(":", "group", "case_id").alias("document_id"), "case_id", F.col("group").alias("language"),
        F.when(translated, F.col("proposed_text")).otherwise(F.col("text")).alias("text"), F.when(translated, F.col("review")).alias("review"),
    )
    wait = (F.col("language") == target) & F.col("review").isNull()
    return entry.where(~wait).withColumn("document_sha256", F.sha2("text", 256)), entry.where(wait).select("case_id")


METHODS = ["direct_mapping", "contextual_refinement", "source_hpo", "manual_annotation", "revision"]
#: Kinds of sources and the tables and keys that their references resolve by.
SOURCES = {
    "e3c_source_annotation": ("source_annotations", ["artifact_sha256", "set_id", "record_id"]),
    "umls_hpo_mapping_record": ("mappings", ["artifact_sha256", "record_id"]),
    "raghpo_source_annotation": ("raghpo", ["artifact_sha256", "set_id", "record_id"]),
    "curated_annotation": ("curated", ["artifact_sha256", "record_id"]),
}
_DOCUMENT, _ONTOLOGY = ["documents_sha256", "document_id", "document_sha256"], ["hpo_release", "ontology_sha256"]


def _resolved(refs: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """``refs`` with n_found, the number of targets, and ``to``, one of them."""
    one = target.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.count("*").alias("n_found"), F.first(F.struct(*target.columns)).alias("to"))
    on = [F.col(k) == F.col(f"_{k}") for k in keys]
    return refs.join(one, on, "left").drop(*(f"_{k}" for k in keys)).withColumn("n_found", F.coalesce("n_found", F.lit(0)))


def curated_issues(annotations: DataFrame, documents: DataFrame, terms: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """All issues of curated annotations: annotation_set_id, annotation_id,
    term_id, documents_sha256, document_id, document_sha256, hpo_release,
    ontology_sha256, spans ARRAY<STRUCT<start, end, phrase>> and derivations
    ARRAY<STRUCT<method, sources ARRAY<STRUCT<kind, artifact_sha256, set_id,
    record_id, sidecar_sha256, row_id>>>>.

    ``documents``: documents_sha256, document_id, document_sha256, text;
    ``terms``: hpo_release, ontology_sha256, term_id (obsolete ones are allowed).
    ``tables``: source_annotations (artifact_sha256, set_id, record_id,
    concept_id, document_sha256), mappings (artifact_sha256, record_id,
    documents_sha256, hpo_release, ontology_sha256, source_annotations_sha256,
    source_set_id, source_annotation_id, concept_id, candidates ARRAY<STRING>),
    raghpo (artifact_sha256, set_id, record_id, term_id, document_sha256,
    hpo_release), sidecars (sidecar_sha256, row_id, derived ARRAY<STRING>) and
    curated (artifact_sha256, record_id, document_sha256, hpo_release,
    ontology_sha256). A key is set/annotation, or set/annotation/activity.
    """
    own = annotations.withColumn("key", F.concat_ws("/", "annotation_set_id", "annotation_id"))
    say = lambda df, why, detail=None: df.select(*issue("curation", F.col("key"), why, detail))
    how_many = F.when(F.col("n_found") == 0, "unresolved_reference").otherwise("ambiguous_reference")

    read = _resolved(own, documents.select(*_DOCUMENT, "text"), _DOCUMENT[:2])
    out = say(read.where("n_found <> 1"), how_many, F.lit("document"))
    read = read.where("n_found = 1")
    out = out.unionByName(say(read.where(~F.col("document_sha256").eqNullSafe(F.col("to.document_sha256"))), "document_differs"))
    spans = read.select("key", F.col("to.text").alias("text"), F.explode("spans").alias("s"))
    held = F.coalesce(snippet_holds(F.col("text"), F.col("s.start"), F.col("s.end"), F.col("s.phrase")), F.lit(False))
    out = out.unionByName(say(spans.where(~held), "span_does_not_hold", F.col("s.start")))
    lost = own.join(terms.select(*_ONTOLOGY).distinct(), _ONTOLOGY, "left_anti")
    out = out.unionByName(say(lost, "unknown_ontology")).unionByName(say(own.join(terms.select(*_ONTOLOGY, "term_id").distinct(), [*_ONTOLOGY, "term_id"], "left_anti"), "unknown_term", F.col("term_id")))

    context = ["term_id", "documents_sha256", "document_sha256", *_ONTOLOGY]
    acts = own.select("key", *context, F.posexplode_outer("derivations").alias("nr", "d"))
    acts = acts.select(F.concat_ws("/", "key", "nr").alias("key"), *context, F.col("d.method").alias("method"), F.col("d.sources").alias("sources"))
    out = out.unionByName(say(acts.where(~F.coalesce(F.col("method").isin(METHODS), F.lit(False))), "unknown_method", F.col("method")))
    out = out.unionByName(say(acts.where(F.coalesce(F.size("sources"), F.lit(0)) < 1), "no_sources"))
    refs = acts.select("key", *context, F.explode("sources").alias("s")).select("key", *context, "s.*")
    out = out.unionByName(say(refs.where(~F.coalesce(F.col("kind").isin(*SOURCES, "bound_document"), F.lit(False))), "unknown_source_kind", F.col("kind")))
    found = {}
    for kind, (name, keys) in SOURCES.items():
        at = _resolved(refs.where(F.col("kind") == kind), tables[name], keys)
        out = out.unionByName(say(at.where("n_found <> 1"), how_many, F.lit(kind)))
        found[kind] = at.where("n_found = 1")
        same = [c for c in context if c != "term_id" and c in tables[name].columns]
        differs = F.lit(False)
        for c in same:
            differs = differs | ~F.col(c).eqNullSafe(F.col(f"to.{c}"))
        out = out.unionByName(say(found[kind].where(differs), "source_inputs_differ", F.lit(kind)))
    e3c, mapped, rag, revised = (found[k] for k in SOURCES)
    rows = _resolved(rag.drop("n_found").withColumnRenamed("to", "hit"), tables["sidecars"], ["sidecar_sha256", "row_id"])
    out = out.unionByName(say(rows.where("n_found <> 1"), how_many, F.lit("sidecar")))
    out = out.unionByName(say(rows.where((F.col("n_found") == 1) & ~F.coalesce(F.array_contains("to.derived", F.col("record_id")), F.lit(False))), "row_does_not_derive_annotation"))

    a = e3c.select("key", F.col("artifact_sha256").alias("sha"), F.col("set_id").alias("source_set"), F.col("record_id").alias("source_id"), F.col("to.concept_id").alias("concept")).alias("a")
    m = mapped.select("key", "term_id", "to").alias("m")
    pairs = a.join(
        m,
        (F.col("a.key") == F.col("m.key")) & (F.col("a.sha") == F.col("m.to.source_annotations_sha256")) & (F.col("a.source_set") == F.col("m.to.source_set_id"))
        & (F.col("a.source_id") == F.col("m.to.source_annotation_id")) & F.col("a.concept").eqNullSafe(F.col("m.to.concept_id")),
    )
    proven = {
        "direct_mapping": (pairs.where(F.array_contains("m.to.candidates", F.col("m.term_id"))).select("a.key"), "not_a_mapping_candidate"),
        "source_hpo": (rag.where(F.col("term_id") == F.col("to.term_id")).select("key"), "term_differs_from_source"),
        "revision": (revised.select("key"), "no_curated_source"),
        "manual_annotation": (refs.where("kind = 'bound_document'").select("key"), "no_bound_document"),
    }
    for method, (good, why) in proven.items():
        out = out.unionByName(say(acts.where(F.col("method") == method).join(good.distinct(), "key", "left_anti"), why))
    return out


def decision_issues(decisions: DataFrame, targets: DataFrame) -> DataFrame:
    """Issues of review decisions (decision_id, target_id, supersedes): repeated
    ids, targets that do not resolve, superseded ids that do not exist."""
    twice = decisions.groupBy("decision_id").count().where("count > 1").select(*issue("decision", F.col("decision_id"), "repeated_id"))
    known = decisions.select(F.col("decision_id").alias("supersedes"))
    lost = decisions.where("supersedes is not null").join(known, "supersedes", "left_anti").select(*issue("decision", F.col("decision_id"), "unknown_superseded", F.col("supersedes")))
    return twice.unionByName(lost).unionByName(resolved_once(decisions, targets, "target_id", "target_id"))


def single_terms(selections: DataFrame, annotations: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, issues) of explicit selections (annotation_id, span_no):
    document_id, term_id, phrase, start, end and an id from the content.
    ``annotations``: annotation_id, document_id, term_id, spans
    ARRAY<STRUCT<start, end>>."""
    issues = resolved_once(selections, annotations, "annotation_id", "annotation_id")
    rows = selections.join(annotations, "annotation_id").join(documents.select("document_id", "text"), "document_id")
    rows = rows.withColumn("s", F.get("spans", F.col("span_no")))
    inside = F.coalesce((F.col("s.start") >= 0) & (F.col("s.end") > F.col("s.start")) & (F.col("s.end") <= F.length("text")), F.lit(False))
    issues = issues.unionByName(rows.where(~inside).select(*issue("single_term", F.col("annotation_id"), "no_such_span", F.col("span_no"))))
    good = rows.where(inside).select("document_id", "term_id", F.expr("substring(text, s.start + 1, s.end - s.start)").alias("phrase"), F.col("s.start").alias("start"), F.col("s.end").alias("end"))
    return good.withColumn("single_term_id", derived_id("single-term-", record_json("document_id", "end", "phrase", "start", "term_id"))), issues


def single_term_candidates(spans: DataFrame) -> DataFrame:
    """language, phrase, term_id, n_spans, several_terms of present patient
    spans (document_id, language, start, end, phrase, term_id, assertion,
    experiencer) that one annotation alone owns; phrases that carry several
    terms are flagged."""
    place = ["document_id", "start", "end"]
    alone = spans.groupBy(*place).agg(F.count("*").alias("n"), F.first(F.struct("language", "phrase", "term_id", "assertion", "experiencer")).alias("x")).where("n = 1").select("x.*")
    n = alone.where("assertion = 'present' and experiencer = 'patient'").groupBy("language", "phrase", "term_id").agg(F.count("*").alias("n_spans"))
    many = n.groupBy("language", "phrase").agg((F.count("*") > 1).alias("several_terms"))
    return n.join(many, ["language", "phrase"])
