import io
import itertools
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from annospark.operators import checks, corpus, mapping, ontology, proposals, relational, review, select, translation
from annospark.sources import documents, sinks, tables
from annospark.streaming.events import LastDecisions, tumbling

OBO = """format-version: 1.2

[Term]
id: HP:0000118
name: Phenotypic abnormality

[Term]
id: HP:0000001
name: Fever
alt_id: HP:0000901
synonym: "Pyrexia" EXACT []
synonym: "High \\"temp\\"" EXACT []
xref: UMLS:C0015967
is_a: HP:0000118 ! Phenotypic abnormality

[Term]
id: HP:0000002
name: Old fever
is_obsolete: true
replaced_by: HP:0000003

[Term]
id: HP:0000003
name: Older fever
is_obsolete: true
replaced_by: HP:0000001

[Term]
id: HP:0000004
name: Split
is_obsolete: true
consider: HP:0000001
consider: HP:0000118

[Term]
id: HP:0000005
name: Gone
is_obsolete: true

[Term]
id: HP:0000006
name: Fever pattern
xref: UMLS:C0015967
is_a: HP:0000001 ! Fever

[Typedef]
id: part_of
"""


@pytest.fixture(scope="module")
def onto(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("obo") / "small.obo"
    path.write_text(OBO)
    return {k: tables.cut(v) for k, v in documents.ontology(spark, str(path)).items()}


def test_ontology_reader(onto):
    terms = {r.id: r for r in onto["terms"].collect()}
    assert len(terms) == 7 and terms["HP:0000001"].synonyms == ["Pyrexia", 'High "temp"'] and terms["HP:0000004"].consider == ["HP:0000001", "HP:0000118"]
    assert [tuple(r) for r in onto["alternates"].collect()] == [("HP:0000901", "HP:0000001")]


def test_audit(spark, onto):
    ids = ["HP:0000001", "HP:0000901", "HP:0000002", "HP:0000003", "HP:0000004", "HP:0000005", "HP:9999999", "x", None]
    values = spark.createDataFrame([(f"a{i}", v) for i, v in enumerate(ids)], "annotation_id string, term_id string")
    out = {r.annotation_id: r for r in ontology.audit_ids(values, onto["terms"], onto["alternates"]).collect()}
    assert [out[f"a{i}"].status for i in range(9)] == [
        "active", "alt_id", "obsolete_replaced", "obsolete_replaced", "obsolete_ambiguous", "obsolete_unresolved", "unknown", "invalid_format", "invalid_format"
    ]
    assert out["a2"].chain == ["HP:0000003", "HP:0000001"] and out["a2"].proposed_ids == ["HP:0000001"] and out["a1"].canonical_id == "HP:0000001"


def test_audit_of_alternates_that_are_obsolete_terms(spark, onto):
    ids = ["HP:0000002", "HP:0000004", "HP:0000005", "HP:0000001"]
    values = spark.createDataFrame([(v, v) for v in ids], "annotation_id string, term_id string")
    plain = {r.term_id: r for r in ontology.audit_ids(values, onto["terms"], onto["alternates"]).collect()}
    alternates = spark.createDataFrame([(v, "HP:0000006") for v in ids], "alternate string, id string")
    out = {r.term_id: r for r in ontology.audit_ids(values, onto["terms"], alternates).collect()}
    assert {(r.status, r.canonical_id, r.reason, r.manual) for r in out.values()} == {("alt_id", "HP:0000006", "alternate_id_canonicalized", False)}
    assert {v: (r.proposed_ids, r.chain) for v, r in out.items()} == {v: (r.proposed_ids, r.chain) for v, r in plain.items()}
    assert out["HP:0000002"].chain == ["HP:0000003", "HP:0000001"] and out["HP:0000004"].proposed_ids and not out["HP:0000001"].proposed_ids


def test_closure_search_and_cycles(spark, onto):
    roots = spark.createDataFrame([("HP:0000118",)], "root string")
    assert {r.node for r in ontology.descendants(onto["edges"], roots).collect()} == {"HP:0000118", "HP:0000001", "HP:0000006"}
    hits = ontology.ranked_names(onto["names"], ["fever", "pyr", "nothing"]).orderBy("query", "place").collect()
    assert [(r.query, r.id) for r in hits] == [("fever", "HP:0000001"), ("fever", "HP:0000006"), ("fever", "HP:0000002"), ("fever", "HP:0000003"), ("pyr", "HP:0000001")]
    assert ontology.replacement_issues(onto["terms"]).isEmpty()
    loop = spark.createDataFrame([("a", True, ["b"], []), ("b", True, ["a"], []), ("c", True, ["z"], [])], "id string, obsolete boolean, replaced_by array<string>, consider array<string>")
    assert {(r.key, r.reason) for r in ontology.replacement_issues(loop).collect()} == {("a", "cycle"), ("b", "cycle"), ("c", "missing_target")}


def test_mapping_classes(spark, onto):
    note = lambda i, kind, cui: (f"x{i}", kind, cui)
    sets = spark.createDataFrame(
        [("h", [note(1, "CLINENTITY", "C0015967"), note(2, "CLINENTITY", "C0000001"), note(3, "CLINENTITY", "bad"), note(4, "EVENT", "C0015967"), note(5, "CLINENTITY", None)]), ("lost", [])],
        "document_sha256 string, annotations array<struct<source_annotation_id:string,source_type:string,source_concept_id:string>>",
    )
    docs = spark.createDataFrame([("d", "h")], "document_id string, document_sha256 string")
    rows, issues = mapping.map_annotations(sets, docs, onto["terms"])
    assert {r.source_annotation_id: r["class"] for r in rows.collect()} == {"x1": "ambiguous", "x2": "missing", "x3": "invalid", "x5": "invalid"}
    assert [r.key for r in issues.collect()] == ["lost"]
    assert {r["class"]: (r.n_rows, r.n_candidates) for r in mapping.summary(rows).collect()}["obsolete"] == (0, 0)


def test_proposals(spark, onto):
    body = "Patient mit Fieber. Kein Husten, aber Fieber."
    item = lambda pid, hpo="HP:0000001", mentions=({"phrase": "Fieber", "context": "mit Fieber"},), **more: json.dumps(
        {"proposal_id": pid, "hpo_id": hpo, "hpo_label": "fever", "assertion": "present", "experiencer": "patient", "temporality": "current", "verbalized": True, "mentions": list(mentions)} | more
    )
    items = [
        item("p1"), item("p2", mentions=[{"phrase": "Fieber", "context": "aber Fieber"}, {"phrase": "mit Fieber", "context": "mit Fieber"}]), item("p1"),
        item("p3", hpo="HP:0000901"), item("p4", hpo="HP:0000002"), "{broken", item("p5", mentions=[{"phrase": "Rash", "context": "mit Fieber"}]), item("p6", hpo_label="Pyrexia", assertion="absent"),
    ]
    reports = spark.createDataFrame([("d", items)], "document_id string, annotations array<string>")
    docs = spark.createDataFrame([("d", body)], "document_id string, text string")
    terms = onto["terms"].withColumn("phenotypic", F.lit(True))
    out = proposals.validate(reports, docs, terms, onto["alternates"])
    assert sorted((r.proposal_id or "", r.reason) for r in out["rejections"].collect()) == [
        ("", "invalid_schema"), ("p1", "duplicate_proposal_id"), ("p2", "overlapping_mention"), ("p3", "unknown_hpo_id"), ("p4", "obsolete_hpo_id"),
        ("p5", "no_valid_mentions"), ("p5", "phrase_not_in_context"),
    ]
    merged = {r.assertion: r for r in out["proposals"].collect()}
    assert merged["present"].source_proposal_ids == ["p1", "p2"] and [(m.start, m.end, m.phrase) for m in merged["present"].mentions] == [(12, 18, "Fieber"), (38, 44, "Fieber")]
    assert [r.proposal_id for r in out["warnings"].collect()] == ["p6"]


def test_proposal_values_are_the_reference_s(spark, onto):
    base = {"assertion": "present", "experiencer": "patient", "temporality": "current"}
    allowed = {"assertion": ["present", "absent", "uncertain"], "experiencer": ["patient", "family_member", "other"], "temporality": ["current", "historical"]}
    refused = [("assertion", "possible"), ("experiencer", "family"), ("temporality", "past"), ("temporality", "unspecified")]
    cases = [(k, v) for k, values in allowed.items() for v in values] + refused
    items = [
        json.dumps({"proposal_id": f"p{i:03d}", "hpo_id": "HP:0000001", "hpo_label": "Fever", "verbalized": True, "mentions": [{"phrase": "Fieber", "context": "Fieber"}]} | base | {k: v})
        for i, (k, v) in enumerate(cases)
    ]
    reports = spark.createDataFrame([(f"d{i}", [item]) for i, item in enumerate(items)], "document_id string, annotations array<string>")
    docs = spark.createDataFrame([(f"d{i}", "Fieber") for i in range(len(items))], "document_id string, text string")
    out = proposals.validate(reports, docs, onto["terms"].withColumn("phenotypic", F.lit(True)), onto["alternates"])
    good = len(cases) - len(refused)
    assert {(r.document_id, r.reason) for r in out["rejections"].collect()} == {(f"d{i}", "invalid_schema") for i in range(good, len(cases))}
    assert {r.document_id for r in out["proposals"].collect()} == {f"d{i}" for i in range(good)}


def test_added_units(spark):
    cases = [
        ("8 to 9 cm", "8 cm to 9 cm", ["cm"]), ("200mg", "200 mg", []), ("5", "5 µg", ["μg"]), ("1.500 g", "1,500 g", []), ("IgM 4", "IgM 4", []), ("7", "8 mg", []), ("", "3 mg", []),
        ("at 39 and 40", "39 ° C, 40 °C, 39 %", ["%", "°c"]), ("12345 cells", "12.345 ml", ["ml"]), ("12345", "12.345 ml", ["ml"]), ("123456", "123.456 ml", ["ml"]), ("2,5", "2.5 KG", ["kg"]),
        ("x5 and v1.2", "5 mg, 1.2 g", []), ("30 years", "30 g", ["g"]), ("30mgs", "30 mg", []), ("é5", "5 ml", []), ("e\u03015", "5 ml", []), ("4 u/l 4", "4 u/l 4 iu", ["iu"]),
    ]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, a string, b string")
    got = dict(rows.select("i", translation.added_units(F.col("a"), F.col("b"))).collect())
    wanted = {i: added for i, (_, _, added) in enumerate(cases)}
    assert got == wanted


def test_blank_translations_do_not_pass(spark):
    pairs = spark.createDataFrame([("a", "text", "\n\t \n", "de"), ("b", "text", "\u00a0\u2003", "de"), ("c", "text", " x ", "de")], "k string, source_text string, translated_text string, l string")
    assert {r.k: r.checks[0].passed for r in translation.checked(pairs, lambda c: F.col("l")).collect()} == {"a": False, "b": False, "c": True}


def test_checks_cost_and_recheck(spark):
    pairs = spark.createDataFrame([("a", "text here", "Text hier", "de"), ("b", "same", "same", "en"), ("c", "x", "", "de")], "k string, source_text string, translated_text string, l string")
    out = {r.k: r for r in translation.checked(pairs, lambda c: F.col("l")).collect()}
    failed = lambda r: [c.code for c in r.checks if not c.passed]
    assert failed(out["a"]) == [] and failed(out["b"]) == ["source_changed", "target_language_de"] and failed(out["c"]) == ["nonempty_output", "length_ratio"]
    row = translation.cost(spark.createDataFrame([("é" * 59517,)], "t string"), "t", "20").first()
    assert (row.code_points, f"{row.usd:f}".rstrip("0")) == (59517, "1.19034")
    again = translation.recheck(translation.checked(pairs, lambda c: F.col("l")).withColumn("status", F.lit("accepted")).drop("added_units", "detected"), lambda c: F.col("l"))
    assert {(r.status, r.changed) for r in again.collect()} == {("accepted", False)}


def test_review_import(spark):
    export = spark.createDataFrame([(c, f"s{c}", f"m{c}") for c in "abcde"], "source_case_id string, source_text string, tllm_text string")
    row = lambda c, p, d, ch="none", why="": (c, f"s{c}", f"m{c}", p, d, ch, why)
    rows = spark.createDataFrame(
        [row("a", "ma", "accept_unchanged"), row("b", "mb", "accept_corrected"), row("c", "x", "accept_corrected", "major"), row("d", "x", "reject", "none", "bad"), row("z", "x", "maybe")],
        "source_case_id string, source_text string, tllm_text string, proposed_text string, decision string, clinical_change string, clinical_change_rationale string",
    )
    _, issues = review.import_review(rows, export, {"reviewer_id": "r"}, {"reviewer_id": "r", "export_sha256": "h"})
    assert {(r.key, r.reason) for r in issues.collect()} == {
        ("b", "decision_not_allowed"), ("c", "decision_not_allowed"), ("e", "missing_case"), ("z", "unknown_case"), ("export_sha256", "metadata_missing")
    }


def test_translation_review_decision_table(spark):
    decisions, changes = ["unverändert akzeptiert", "korrigiert akzeptiert", "Rückfrage", "abgelehnt"], ["keine", "vorhanden"]
    cases = list(itertools.product(decisions, (False, True), changes, ("", "Terminologie"), ("", "why")))
    columns = review._CELLS + ["nmt_text"]
    row = lambda i, d, p, ch, cat, why: (f"c{i}", "en", "s", "m\n", p, d, ch, cat, why, None, None)
    rows = [row(i, d, "x" if new else "m\r\n", ch, cat, why) for i, (d, new, ch, cat, why) in enumerate(cases)]
    n = len(rows)
    odd = [
        row(n, "vielleicht", "", "etwas", "Sonstiges", ""), ("c%d" % (n + 1), "fr", "other", "m", "m", decisions[0], "keine", "", "", "\U0001F600" * 16384, None),
        row(n + 2, decisions[0], "m\n", "keine", "", ""), row(n + 2, decisions[0], "m\n", "keine", "", ""), row("z", decisions[0], "m\n", "keine", "", ""),
    ]
    text = ", ".join(f"{c} string" for c in columns)
    export = spark.createDataFrame([(f"c{i}", "en", "s", "m\n", None) for i in range(n + 4)], "source_case_id string, source_language string, source_text string, tllm_text string, nmt_text string")
    meta = {"selection_id": "s", "review_policy_id": "q", "reviewer_id": "r", "reviewer_qualification": "", "reviewed_languages": "en", "review_date": "2024-02-30"}
    _, issues = review.import_translation_review(spark.createDataFrame(rows + odd, text), export, meta, {"selection_id": "s", "review_policy_id": "p"})
    got = {(r.key, r.reason, r.detail) for r in issues.collect()}
    allowed = {(decisions[0], False, "keine", "", ""), (decisions[1], True, "keine", "", "")} | {(decisions[1], True, "vorhanden", "Terminologie", "why")}
    allowed |= {(d, new, "vorhanden", "Terminologie", "why") for d in decisions[2:] for new in (False, True)}
    want = {(f"c{i}", "decision_not_allowed", "decision") for i, c in enumerate(cases) if c not in allowed}
    want |= {(f"c{n}", "required", "proposed_text")} | {(f"c{n}", "not_allowed_value", c) for c in ("decision", "clinical_change", "clinical_change_category")}
    want |= {(f"c{n + 1}", "export_differs", c) for c in ("source_language", "source_text", "tllm_text")} | {(f"c{n + 1}", "cell_too_long", "reviewer_comment"), (f"c{n + 1}", "decision_not_allowed", "decision")}
    want |= {(f"c{n + 2}", "repeated_case", "source_case_id"), ("cz", "unknown_case", "source_case_id"), (f"c{n + 3}", "missing_case", "source_case_id")}
    want |= {("review_policy_id", "metadata_mismatch", "review_policy_id"), ("reviewer_qualification", "metadata_required", "reviewer_qualification"), ("review_date", "metadata_invalid_date", "review_date")}
    assert got == want


def test_corpus_takes_the_last_decision(spark):
    groups = spark.createDataFrame([("a", "en", "de"), ("b", "en", "de"), ("c", "en", "en")], "case_id string, lang string, group string")
    native = spark.createDataFrame([(c, f"text {c}") for c in "abc"], "case_id string, text string")
    reviews = spark.createDataFrame([("a", "accept_unchanged", "T", 1, "r1"), ("b", "accept_unchanged", "U", 1, "r2"), ("b", "reject", "U", 2, "r3")], "case_id string, decision string, proposed_text string, decided_at int, decision_id string")
    entries, pending = corpus.build_corpus(groups, native, reviews)
    assert {(r.document_id, r.text, r.review) for r in entries.collect()} == {("de:a", "T", "r1"), ("en:c", "text c", None)}
    assert [r.case_id for r in pending.collect()] == ["b"]


def test_curated_derivations(spark):
    ref = lambda kind, sha=None, own=None, rec=None, side=None, line=None: (kind, sha, own, rec, side, line)
    e3c, mapped, rag, old, bound = ref("e3c_source_annotation", "S", "s", "x1"), ref("umls_hpo_mapping_record", "M", None, "m1"), ref("raghpo_source_annotation", "R", "r", "g1", "K", "l1"), ref("curated_annotation", "C", None, "c1"), ref("bound_document")
    cases = [
        ("T1", "direct_mapping", [e3c, mapped], set()), ("T2", "direct_mapping", [e3c, mapped], {"not_a_mapping_candidate"}), ("T1", "direct_mapping", [mapped], {"not_a_mapping_candidate"}),
        ("T1", "direct_mapping", [ref("e3c_source_annotation", "S", "s", "x2"), mapped], {"not_a_mapping_candidate"}), ("T1", "source_hpo", [rag], set()), ("T2", "source_hpo", [rag], {"term_differs_from_source"}),
        ("T1", "source_hpo", [ref("raghpo_source_annotation", "R", "r", "g1", "K", "l2")], {"row_does_not_derive_annotation"}), ("T1", "revision", [old], set()), ("T1", "revision", [bound], {"no_curated_source"}),
        ("T1", "manual_annotation", [bound], set()), ("T1", "manual_annotation", [old], {"no_bound_document"}), ("T2", "contextual_refinement", [e3c], set()), ("T1", "manual", [bound], {"unknown_method"}),
        ("T1", "contextual_refinement", [ref("umls_hpo_mapping_record", "M", None, "m2")], {"source_inputs_differ"}), ("T1", "contextual_refinement", [ref("curated_annotation", "C", None, "none")], {"unresolved_reference"}),
        ("T1", "contextual_refinement", [ref("e3c_source_annotation", "S", "t", "y1")], {"source_inputs_differ"}), ("T9", "contextual_refinement", [bound], {"unknown_term"}), ("T1", "contextual_refinement", [], {"no_sources"}),
    ]
    source = "struct<kind:string,artifact_sha256:string,set_id:string,record_id:string,sidecar_sha256:string,row_id:string>"
    schema = f"annotation_set_id string, annotation_id string, term_id string, documents_sha256 string, document_id string, document_sha256 string, hpo_release string, ontology_sha256 string, spans array<struct<start:int,end:int,phrase:string>>, derivations array<struct<method:string,sources:array<{source}>>>"
    row = lambda i, term, method, sources, sha="h", spans=((0, 5, "fever"),), release="v1": ("a", str(i), term, "D", "d", sha, release, "O", list(spans), [(method, sources)])
    rows = [row(i, *c[:3]) for i, c in enumerate(cases)] + [row("hash", "T1", "manual_annotation", [bound], "other"), row("span", "T1", "manual_annotation", [bound], spans=[(0, 6, "fever")]), row("release", "T1", "manual_annotation", [bound], release="v2")]
    table = lambda rows, schema: spark.createDataFrame(rows, ", ".join(c if " " in c else f"{c} string" for c in schema.split(";")))
    mapping_row = lambda rec, release: ("M", rec, "D", release, "O", "S", "s", "x1", "C1", ["T1", "T3"])
    tables_ = {
        "source_annotations": table([("S", "s", "x1", "C1", "h"), ("S", "s", "x2", "C1", "h"), ("S", "t", "y1", "C1", "other")], "artifact_sha256;set_id;record_id;concept_id;document_sha256"),
        "mappings": table([mapping_row("m1", "v1"), mapping_row("m2", "v0")], "artifact_sha256;record_id;documents_sha256;hpo_release;ontology_sha256;source_annotations_sha256;source_set_id;source_annotation_id;concept_id;candidates array<string>"),
        "raghpo": table([("R", "r", "g1", "T1", "h", "v1")], "artifact_sha256;set_id;record_id;term_id;document_sha256;hpo_release"),
        "sidecars": table([("K", "l1", ["g1"]), ("K", "l2", ["g2"])], "sidecar_sha256;row_id;derived array<string>"),
        "curated": table([("C", "c1", "h", "v1", "O")], "artifact_sha256;record_id;document_sha256;hpo_release;ontology_sha256"),
    }
    docs = table([("D", "d", "h", "fever")], "documents_sha256;document_id;document_sha256;text")
    terms = table([("v1", "O", t) for t in ("T1", "T2", "T3")], "hpo_release;ontology_sha256;term_id")
    got = {}
    for r in corpus.curated_issues(spark.createDataFrame(rows, schema), docs, terms, tables_).collect():
        got.setdefault(r.key.split("/")[1], set()).add(r.reason)
    want = {str(i): c[3] for i, c in enumerate(cases) if c[3]} | {"hash": {"document_differs"}, "span": {"span_does_not_hold"}, "release": {"unknown_ontology", "unknown_term"}}
    assert got == want


def test_single_terms_and_candidates(spark):
    docs = spark.createDataFrame([("d", "high fever")], "document_id string, text string")
    notes = spark.createDataFrame([("n", "d", "T", [(5, 10), (5, 99)])], "annotation_id string, document_id string, term_id string, spans array<struct<start:int,end:int>>")
    picks = spark.createDataFrame([("n", 0), ("n", 1), ("q", 0)], "annotation_id string, span_no int")
    rows, issues = corpus.single_terms(picks, notes, docs)
    assert [(r.phrase, len(r.single_term_id)) for r in rows.collect()] == [("fever", 76)]
    assert {r.reason for r in issues.collect()} == {"unresolved_reference", "no_such_span"}


def test_merge_is_order_free(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "y")], "id string, v string")
    b = spark.createDataFrame([("2", "z"), ("3", "w"), ("1", "x")], "id string, v string")
    for sets in ((a, b), (b, a), (a, b, a)):
        good, issues = checks.merged_sets(*sets, key="id", payload=["v"])
        assert sorted(map(tuple, good.collect())) == [("1", "x"), ("3", "w")] and [r.key for r in issues.collect()] == ["2"]
        with pytest.raises(ValueError):
            checks.require_clean(issues)


def test_split_does_not_depend_on_order(spark):
    rows = [(i, "en" if i % 3 else "fr", 100 + i % 400, "short" if i % 2 else "long", (i % 7) / 3.0) for i in range(200)]
    schema = "doc_id long, lang string, n_tokens long, stratum string, density double"
    run = lambda r, n: sorted((x.doc_id, x.group) for x in select.systematic_split(spark.createDataFrame(r, schema).repartition(n), "s", ["en", "fr"]).collect())
    got = run(rows, 3)
    assert got == run(rows[::-1], 5)
    import hashlib

    for lang in ("en", "fr"):
        own = sorted((r for r in rows if r[1] == lang), key=lambda r: (["short", "medium", "long"].index(r[3]), r[4], hashlib.sha256(f"s\0{r[0]}".encode()).hexdigest()))
        offset = int(hashlib.sha256(f"s\0{lang}".encode()).hexdigest(), 16) % 4
        want = {r[0]: "de" if i % 4 == offset else lang for i, r in enumerate(own)}
        assert want == {d: g for d, g in got if d in want}


def test_overlaps_and_asof(spark):
    spans = spark.createDataFrame([("g", 1, 0, 100), ("g", 2, 99, 200), ("g", 3, 200, 201), ("h", 4, 0, 5)], "k string, span_id int, start int, end int")
    assert [tuple(r) for r in relational.overlaps(spans, "k").collect()] == [("g", 1, 2)]


def test_archives_and_workbooks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("layer1/en/a.xml", "<x/>")
        z.writestr("../evil", "no")
    members = tables.cut(documents.archive_members(documents.files(spark, str(tmp_path), "*.zip")))
    assert {(r.path, r.byte_length) for r in members.collect()} == {("layer1/en/a.xml", 4), ("../evil", 2)}
    assert {(r.key.rpartition("/")[2], r.reason) for r in documents.member_issues(members, 1, 10**6, ["*.txt", "layer1/*.xml"]).collect()} == {
        ("evil", "unsafe_path"), ("a.zip", "too_many_members"), ("a.zip", "required_member_missing")
    }
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    for name, cell in (("good.xlsx", '<c r="B2"><v>7</v></c>'), ("bad.xlsx", '<c r="B2"><f>1+1</f></c>')):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="S" r:id="i"/></sheets></workbook>')
            z.writestr("xl/_rels/workbook.xml.rels", '<R><Relationship Id="i" Target="worksheets/s.xml"/></R>')
            z.writestr("xl/worksheets/s.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>k</t></is></c><c r="B1" t="inlineStr"><is><t>v</t></is></c></row><row r="2">{cell}</row></sheetData></worksheet>')
    rows = tables.cut(documents.workbook_rows(documents.files(spark, str(tmp_path), "*.xlsx")))
    table, issues = documents.sheet_table(rows, "S", ["k", "v"])
    assert [(r.k, r.v) for r in table.collect()] == [(None, "7")] and issues.isEmpty()
    assert [r.error for r in rows.where("error is not null").collect()] == ["ValueError: formula in S"]


def test_annotated_xml(spark):
    good = '<r xmlns:x="u"><x:Sofa sofaString="A b"/><x:EVENT x:id="1" begin="0" end="1" polarity="NEG"/><x:Link x:id="2" src="1"/><x:Token/></r>'
    rows = spark.createDataFrame([("g", good.encode()), ("d", b"<!DOCTYPE x><r/>"), ("u", b"<r><Odd/></r>")], "path string, content binary")
    out = {r.path: r for r in documents.annotated_xml(rows, ["EVENT"], {"Link": ["src"]}).collect()}
    assert out["g"].text == "A b" and out["g"].annotations[0].attributes == {"polarity": "NEG"} and out["g"].relations[0].target == "1" and out["g"].error is None
    assert out["d"].error and out["u"].error == "unknown element Odd"


def test_attributions(spark):
    meta = '<x:METADATA docName="EN1" docAuthor="A | B" docDOI="10.1/x" docLicense="CC BY"/>'
    files = {"good": meta, "none": "", "two": meta * 2, "unnamed": "<x:METADATA/>"}
    rows = spark.createDataFrame([(k, f'<r xmlns:x="u"><p>{v}</p></r>'.encode()) for k, v in files.items()] + [("d", b"<!DOCTYPE x><r/>"), ("broken", b"<r>")], "path string, content binary")
    out = {r.path: r for r in documents.attributions(rows).collect()}
    assert tuple(out["good"]) == ("good", "EN1", "A | B", "10.1/x", "", "CC BY", None)
    assert [out[k].error for k in ("none", "two", "unnamed")] == ["0 METADATA elements", "2 METADATA elements", "METADATA without docName"] and out["d"].error and out["broken"].error


def test_ontology_issues(spark, onto, tmp_path):
    assert onto["issues"].isEmpty()
    term = lambda n, *lines: "\n".join(["", "[Term]", f"id: HP:000000{n}", f"name: n{n}", *lines, ""])
    (tmp_path / "o.obo").write_text("format-version: 1.2\n" + term(1, "xref: UMLS:C0000001", "xref: UMLS:C0000001") + term(2, "xref: UMLS:C12", "xref: UMLS:C0000001", "xref: UMLS:C0000001 x") + term(3) + term(3))
    got = documents.ontology(spark, str(tmp_path / "o.obo"))
    assert {tuple(r)[1:] for r in got["issues"].collect()} == {
        ("HP:0000001", "duplicate_xref", "C0000001"), ("HP:0000002", "malformed_xref", "C12"), ("HP:0000002", "malformed_xref", "C0000001 x"), ("HP:0000003", "duplicate_id", "2")
    }
    assert {r.id: r.umls_cuis for r in got["terms"].collect()}["HP:0000002"] == ["C0000001"]


def test_strict_json_and_store(spark, tmp_path):
    rows = spark.createDataFrame([('{"a":1}',), ('{"a":1,"a":2}',), ("{",)], "t string")
    assert [r.x and r.x.a for r in rows.select(tables.strict_json(F.col("t"), "a int").alias("x")).collect()] == [1, None, None]
    digest = sinks.put_bytes(str(tmp_path), b"abc")
    assert sinks.put_bytes(str(tmp_path), b"abc") == digest and sinks.get_bytes(str(tmp_path), digest) == b"abc"
    sinks.publish_pointer(str(tmp_path), "s", "k", {"o": digest})
    assert sinks.reusable_pointer(str(tmp_path), "s", "k", str(tmp_path)) == {"o": digest} and sinks.reusable_pointer(str(tmp_path), "s", "q", str(tmp_path)) is None
    lines = sinks.canonical_lines(spark.createDataFrame([("b", 1), ("a", 2)], "id string, n int"), ["id"])
    assert [r.value for r in lines.collect()] == ['{"id":"a","n":2}', '{"id":"b","n":1}']


def test_streams(spark, tmp_path):
    rows = [(i, f"2024-01-01 00:{i:02d}:00", i % 3, "ab"[i % 2], 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, "event_id long, t string, user_id long, event_type string, value double").withColumn("ts", F.to_timestamp("t")).drop("t")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    last = LastDecisions(str(tmp_path / "last"), "user_id", ["ts", "event_id"], ["event_type"])
    q = stream.writeStream.foreachBatch(last).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    epochs = q.lastProgress["batchId"]
    got = {r.user_id: r.event_id for r in spark.read.parquet(last.version(epochs)).collect()}
    assert got == {0: 18, 1: 19, 2: 17}
    assert sum(r.n_events for r in tumbling(df).collect()) == 20
