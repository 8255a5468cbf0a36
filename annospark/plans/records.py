"""Registered queries of the record operators, each with its SQL beside it.

The driver's tables stand in for records: parts for ontology terms, events for
decisions, labels for reviews, urls for short documents. Every query calls the
operator itself; the SQL states the result it must have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.functions import hashing, safety, text
from annospark.operators import checks, corpus, inventory, ontology, proposals, relational, review, translation
from annospark.sources import sinks
from annospark.sources.tables import parquet
from annospark.streaming import events as streams

QUERIES: list = []
SQL: dict[str, str] = {}


def states(sql: str):
    """Registers a query with the SQL of its result."""

    def add(f):
        QUERIES.append(f)
        SQL[f.__name__] = sql
        return f

    return add


def _hp(number: Column) -> Column:
    return F.concat(F.lit("HP:"), F.lpad(number.cast("string"), 7, "0"))


_HP = "'HP:' || lpad(CAST({} AS VARCHAR), 7, '0')"


@states("""SELECT CAST(key AS VARCHAR) AS key, CASE WHEN count(DISTINCT nation) = 1 THEN 'merged' ELSE 'conflicting_content' END AS state,
        CAST(CASE WHEN count(DISTINCT nation) = 1 THEN min(nation) ELSE count(DISTINCT nation) END AS VARCHAR) AS value
    FROM (SELECT c_custkey AS key, c_nationkey AS nation FROM customer UNION ALL SELECT s_suppkey, s_nationkey FROM supplier) GROUP BY key""")
def merged_records(spark: SparkSession, d: str) -> DataFrame:
    """Customers and suppliers as two record sets of one key."""
    a = parquet(spark, d, "customer").selectExpr("c_custkey AS key", "c_nationkey AS nation")
    b = parquet(spark, d, "supplier").selectExpr("s_suppkey AS key", "s_nationkey AS nation")
    good, issues = checks.merged_sets(a, b, key="key", payload=["nation"])
    return good.selectExpr("CAST(key AS STRING) AS key", "'merged' AS state", "CAST(nation AS STRING) AS value").unionByName(issues.selectExpr("key", "reason AS state", "detail AS value"))


@states("""SELECT CAST(c_custkey AS VARCHAR) AS key, CASE WHEN n IS NULL THEN 'unresolved_reference' ELSE 'ambiguous_reference' END AS reason, CAST(coalesce(n, 0) AS VARCHAR) AS detail
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey WHERE coalesce(n, 0) <> 1""")
def reference_issues(spark: SparkSession, d: str) -> DataFrame:
    """Customers that do not have exactly one order."""
    return checks.resolved_once(parquet(spark, d, "customer"), parquet(spark, d, "orders"), "c_custkey", "o_custkey").select("key", "reason", "detail")


@states("SELECT l_partkey, l_suppkey, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def repeated_keys(spark: SparkSession, d: str) -> DataFrame:
    return checks.repeated(parquet(spark, d, "lineitem"), "l_partkey", "l_suppkey")


@states("SELECT user_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS counts FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY user_id")
def type_counts(spark: SparkSession, d: str) -> DataFrame:
    n = inventory.type_counts(parquet(spark, d, "events"), "user_id", "event_type")
    return n.select("user_id", F.array_join(F.transform("counts", lambda c: F.concat(c["name"], F.lit("="), c["count"].cast("string"))), ",").alias("counts"))


@states("""SELECT user_id, count(*) FILTER (kind = 'EVENT' AND event_id % 3 = 1) AS factuality, count(*) FILTER (kind = 'EVENT' AND event_id % 4 < 2) AS negation,
        count(*) FILTER (kind = 'BODYPART') AS bodypart
    FROM (SELECT *, CASE WHEN event_type IN ('click', 'purchase') THEN 'EVENT' WHEN event_type = 'error' THEN 'BODYPART' ELSE 'OTHER' END AS kind FROM events) GROUP BY user_id""")
def marker_counts(spark: SparkSession, d: str) -> DataFrame:
    """Events as annotations: blank and missing factualities, both spellings of
    a negative polarity."""
    notes = parquet(spark, d, "events").selectExpr(
        "user_id", "CASE WHEN event_type IN ('click', 'purchase') THEN 'EVENT' WHEN event_type = 'error' THEN 'BODYPART' ELSE 'OTHER' END AS kind",
        "CASE event_id % 3 WHEN 0 THEN ' ' WHEN 1 THEN 'FACT' END AS factuality", "CASE event_id % 4 WHEN 0 THEN 'NEG' WHEN 1 THEN 'Negative' ELSE 'POS' END AS polarity",
    )
    return inventory.marker_counts(notes, "user_id", "kind", "factuality", "polarity")


@states("""WITH latest AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1 AND event_type IN ('purchase', 'signup', 'click')),
    cases AS (
        SELECT doc_id, text, CASE WHEN doc_id % 4 = 0 THEN 'de' ELSE lang END AS language, event_type || ':' || event_id AS proposed, event_id FROM documents LEFT JOIN latest ON doc_id = user_id),
    told AS (SELECT *, coalesce(language = 'de', false) AS translated FROM cases)
    SELECT CAST(doc_id AS VARCHAR) AS case_id, CASE WHEN NOT pending THEN language || ':' || doc_id END AS document_id,
        CASE WHEN translated AND NOT pending THEN event_id END AS review, CASE WHEN NOT pending THEN sha256(CASE WHEN translated THEN proposed ELSE text END) END AS document_sha256
    FROM (SELECT *, translated AND event_id IS NULL AS pending FROM told)""")
def reviewed_corpus(spark: SparkSession, d: str) -> DataFrame:
    """A fourth of the documents, and those in the target language, take the
    text that the last decision about them accepts, or wait for one."""
    docs = parquet(spark, d, "documents").select(F.col("doc_id").cast("string").alias("case_id"), "lang", "text", "doc_id")
    groups = docs.select("case_id", "lang", F.when(F.col("doc_id") % 4 == 0, "de").otherwise(F.col("lang")).alias("group"))
    decision = F.when(F.col("event_type").isin("purchase", "signup"), "accept_unchanged").when(F.col("event_type") == "click", "accept_corrected").otherwise("reject")
    reviews = parquet(spark, d, "events").select(
        F.col("user_id").cast("string").alias("case_id"), decision.alias("decision"), F.concat_ws(":", "event_type", F.col("event_id").cast("string")).alias("proposed_text"),
        F.col("ts").alias("decided_at"), F.col("event_id").alias("decision_id"),
    )
    entries, pending = corpus.build_corpus(groups, docs.select("case_id", "text"), reviews)
    return entries.select("case_id", "document_id", "review", "document_sha256").unionByName(pending, allowMissingColumns=True)


@states(r"""WITH said AS (
        SELECT CAST(doc_id AS VARCHAR) AS key, doc_id, text, coalesce(text, '') AS cell, lang, quality, toxic FROM documents JOIN labels USING (doc_id)),
    sized AS (SELECT *, length(cell) + length(regexp_replace(cell, '[^\x{10000}-\x{10FFFF}]', '', 'g')) AS units FROM said)
    SELECT key, 'decision_not_allowed' AS reason, 'decision' AS detail FROM sized WHERE text IS NOT NULL AND ((toxic = 1 AND quality = 0) OR (toxic = 0 AND doc_id % 5 = 0))
    UNION ALL SELECT key, 'export_differs', 'source_language' FROM sized WHERE CASE WHEN toxic = 1 THEN 'xx' ELSE coalesce(lang, '') END IS DISTINCT FROM lang
    UNION ALL SELECT key, 'required', 'proposed_text' FROM sized WHERE cell = '' AND quality = 1
    UNION ALL SELECT key, 'cell_too_long', unnest(['source_text', 'tllm_text']) FROM sized WHERE units > 32767
    UNION ALL SELECT key, 'cell_too_long', 'proposed_text' FROM sized WHERE units + 1 - quality > 32767
    UNION ALL SELECT key, 'repeated_case', 'source_case_id' FROM sized GROUP BY key HAVING count(*) > 1
    UNION ALL SELECT CAST(doc_id AS VARCHAR), 'missing_case', 'source_case_id' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT 'review_date', 'metadata_invalid_date', 'review_date'""")
def translation_review(spark: SparkSession, d: str) -> DataFrame:
    """The issues of a review workbook filled in from the labels, against an
    export of all documents."""
    docs = parquet(spark, d, "documents")
    export = docs.selectExpr("CAST(doc_id AS STRING) AS source_case_id", "lang AS source_language", "text AS source_text", "text AS tllm_text", "CAST(NULL AS STRING) AS nmt_text")
    unchanged, corrected, _, rejected = review.WORKBOOK_DECISIONS
    rows = docs.join(parquet(spark, d, "labels"), "doc_id").selectExpr(
        "CAST(doc_id AS STRING) AS source_case_id", "IF(toxic = 1, 'xx', lang) AS source_language", "text AS source_text", "text AS tllm_text", "CAST(NULL AS STRING) AS nmt_text",
        "IF(quality = 1, text, concat(text, '!')) AS proposed_text", f"CASE WHEN toxic = 1 THEN '{rejected}' WHEN quality = 1 THEN '{unchanged}' ELSE '{corrected}' END AS decision",
        "IF(toxic = 1, 'vorhanden', 'keine') AS clinical_change", "CASE WHEN toxic = 1 THEN 'Terminologie' WHEN doc_id % 5 = 0 THEN 'Auslassung' END AS clinical_change_category",
        "IF(toxic = 1 AND quality = 1, 'why', '') AS clinical_change_rationale", "CAST(NULL AS STRING) AS reviewer_comment",
    )
    meta = {"selection_id": "s", "review_policy_id": "p", "reviewer_id": "r", "reviewer_qualification": "q", "reviewed_languages": "en", "review_date": "2024-02-30"}
    return review.import_translation_review(rows, export, meta, {"selection_id": "s", "review_policy_id": "p"})[1].select("key", "reason", "detail")


def _terms(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Parts as terms and alternate ids: sizes above 40 are obsolete and point
    to the part before, by one replacement, by a suggestion, or not at all."""
    p = parquet(spark, d, "part").withColumn("before", F.array(_hp(F.col("p_partkey") - 1))).withColumn("old", (F.col("p_size") > 40) & (F.col("p_partkey") > 0))
    none = F.array().cast("array<string>")
    terms = p.select(
        _hp(F.col("p_partkey")).alias("id"), F.col("p_name").alias("label"), F.col("old").alias("obsolete"), (F.col("p_size") > 3).alias("phenotypic"),
        F.when(F.col("old") & (F.col("p_size") <= 46), F.col("before")).otherwise(none).alias("replaced_by"),
        F.when(F.col("old") & F.col("p_size").between(47, 48), F.col("before")).otherwise(none).alias("consider"),
    )
    return terms, p.where("p_size = 10").select(_hp(F.col("p_partkey") + 9000000).alias("alternate"), _hp(F.col("p_partkey")).alias("id"))


_TERMS = f"""terms AS (
    SELECT {_HP.format('p_partkey')} AS id, p_partkey, p_size, p_name AS label, p_size > 40 AND p_partkey > 0 AS old, {_HP.format('p_partkey - 1')} AS before FROM part),
alternates AS (SELECT {_HP.format('p_partkey + 9000000')} AS alternate, id AS own FROM terms WHERE p_size = 10)"""


@states(f"""WITH RECURSIVE {_TERMS},
    walk(start, place, chain) AS (
        SELECT id, before, before FROM terms WHERE old AND p_size <= 46
        UNION ALL SELECT start, before, chain || ',' || before FROM walk JOIN terms ON place = id WHERE old AND p_size <= 46),
    ends AS (
        SELECT start, chain, CASE WHEN old THEN 'obsolete_ambiguous' ELSE 'obsolete_replaced' END AS status,
               CASE WHEN NOT old THEN id WHEN p_size <= 48 THEN before ELSE '' END AS proposed
        FROM walk JOIN terms ON place = id WHERE NOT (old AND p_size <= 46)),
    marked AS (
        SELECT CASE WHEN l_quantity = 1 THEN 'HP:' || l_partkey WHEN l_quantity = 2 THEN {_HP.format('l_partkey + 9000000')} ELSE {_HP.format('l_partkey')} END AS term_id FROM lineitem),
    judged AS (
        SELECT m.term_id, own, t.*, e.chain AS e_chain, e.proposed AS e_proposed,
               CASE WHEN NOT regexp_full_match(m.term_id, 'HP:[0-9]{{7}}') THEN 'invalid_format' WHEN own IS NOT NULL THEN 'alt_id' WHEN id IS NULL THEN 'unknown' WHEN NOT old THEN 'active'
                    WHEN p_size BETWEEN 47 AND 48 THEN 'obsolete_ambiguous' WHEN p_size > 48 THEN 'obsolete_unresolved' ELSE e.status END AS status
        FROM marked m LEFT JOIN alternates ON m.term_id = alternate LEFT JOIN terms t ON m.term_id = id LEFT JOIN ends e ON m.term_id = start)
    SELECT term_id, status, CASE status WHEN 'alt_id' THEN own WHEN 'active' THEN term_id END AS canonical_id,
        CASE WHEN id IS NULL OR NOT old THEN '' WHEN p_size <= 46 THEN e_proposed WHEN p_size <= 48 THEN before ELSE '' END AS proposed_ids,
        CASE WHEN old AND p_size <= 46 THEN e_chain ELSE '' END AS chain, status NOT IN ('alt_id', 'active') AS manual, count(*) AS n_rows
    FROM judged GROUP BY ALL""")
def audited_terms(spark: SparkSession, d: str) -> DataFrame:
    """Term ids of all line items against the parts' release: what each is now,
    and the chain of replacements that says so."""
    terms, alternates = _terms(spark, d)
    term = F.when(F.col("l_quantity") == 1, F.concat(F.lit("HP:"), F.col("l_partkey").cast("string"))).when(F.col("l_quantity") == 2, _hp(F.col("l_partkey") + 9000000)).otherwise(_hp(F.col("l_partkey")))
    values = parquet(spark, d, "lineitem").select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("annotation_id"), term.alias("term_id"))
    out = ontology.audit_ids(values, terms.drop("label", "phenotypic"), alternates)
    flat = out.select("term_id", "status", "canonical_id", F.array_join("proposed_ids", ",").alias("proposed_ids"), F.array_join("chain", ",").alias("chain"), "manual")
    return flat.groupBy(*flat.columns).agg(F.count("*").alias("n_rows"))


@states("""WITH RECURSIVE edges AS (SELECT n_nationkey AS id, n_nationkey * 2 % 30 AS target FROM nation),
    walk(id, place, k) AS (SELECT id, target, 1 FROM edges UNION ALL SELECT w.id, e.target, k + 1 FROM walk w JOIN edges e ON w.place = e.id WHERE k < 40)
    SELECT CAST(id AS VARCHAR) AS key, 'missing_target' AS reason, CAST(target AS VARCHAR) AS detail FROM edges WHERE target NOT IN (SELECT id FROM edges)
    UNION ALL SELECT DISTINCT CAST(id AS VARCHAR), 'cycle', NULL FROM walk WHERE k = 40""")
def replacement_cycles(spark: SparkSession, d: str) -> DataFrame:
    """Nations as terms, each replaced by the one of twice its number."""
    none = F.array().cast("array<string>")
    terms = parquet(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.lit(True).alias("obsolete"), F.array((F.col("n_nationkey") * 2 % 30).cast("string")).alias("replaced_by"), none.alias("consider"))
    return ontology.replacement_issues(terms).select("key", "reason", "detail")


@states(f"""WITH {_TERMS},
    items AS (
        SELECT page_id, k, 'p' || CASE WHEN k = 3 THEN 2 ELSE k END AS proposal_id, NOT (k = 1 AND page_id % 3 = 0) AS whole, k = 0 AND page_id % 4 = 0 AS elsewhere,
               CASE WHEN k = 4 THEN {_HP.format('(page_id * 7 + 52) % 2500 + 9000000')} ELSE {_HP.format('(page_id * 7 + k * 13) % 2500')} END AS hpo_id
        FROM pages, (SELECT unnest(range(5)) AS k)),
    judged AS (
        SELECT page_id, proposal_id, elsewhere, hpo_id,
               CASE WHEN NOT whole THEN 'invalid_schema' WHEN k = 3 THEN 'duplicate_proposal_id' WHEN id IS NULL THEN 'unknown_hpo_id' WHEN old THEN 'obsolete_hpo_id'
                    WHEN p_size <= 3 THEN 'hpo_id_not_phenotypic' END AS reason,
               CASE WHEN whole AND k <> 3 AND id IS NULL THEN 'now named ' || own END AS detail
        FROM items LEFT JOIN terms ON hpo_id = id LEFT JOIN alternates ON hpo_id = alternate)
    SELECT CAST(page_id AS VARCHAR) AS document_id, proposal_id, CAST(NULL AS INT) AS mention_index, reason, detail FROM judged WHERE reason IS NOT NULL
    UNION ALL SELECT CAST(page_id AS VARCHAR), proposal_id, 0, 'phrase_not_in_context', 'the context holds no such phrase' FROM judged WHERE reason IS NULL AND elsewhere
    UNION ALL SELECT CAST(page_id AS VARCHAR), proposal_id, NULL, 'no_valid_mentions', 'all mentions were rejected' FROM judged WHERE reason IS NULL AND elsewhere
    UNION ALL SELECT CAST(page_id AS VARCHAR), proposal_id, 0, 'accepted', '0-4 http ' || hpo_id FROM judged WHERE reason IS NULL AND NOT elsewhere""")
def validated_proposals(spark: SparkSession, d: str) -> DataFrame:
    """Five made-up proposals about each page's url: one of a wrong form, one of
    a repeated id, one by an alternate id, one that quotes what is not there."""
    pages = parquet(spark, d, "pages").select(F.col("page_id"), F.col("page_id").cast("string").alias("document_id"), F.col("url").alias("text"))

    def item(k: int) -> Column:
        no = (F.col("page_id") * 7 + k * 13) % 2500
        return F.to_json(F.struct(
            F.lit(f"p{2 if k == 3 else k}").alias("proposal_id"), _hp(no + (9000000 if k == 4 else 0)).alias("hpo_id"), F.lit("a name").alias("hpo_label"),
            F.when(F.lit(k == 1) & (F.col("page_id") % 3 == 0), "maybe").otherwise("present").alias("assertion"), F.lit("patient").alias("experiencer"), F.lit("current").alias("temporality"),
            F.lit(True).alias("verbalized"),
            F.array(F.struct(F.when(F.lit(k == 0) & (F.col("page_id") % 4 == 0), "not here").otherwise("http").alias("phrase"), F.col("text").alias("context"), F.lit(1).alias("occurrence"))).alias("mentions"),
        ))

    reports = pages.select("document_id", F.array(*(item(k) for k in range(5))).alias("annotations"))
    terms, alternates = _terms(spark, d)
    out = proposals.validate(reports, pages.select("document_id", "text"), terms, alternates)
    m = F.col("m")
    good = out["proposals"].select("document_id", "hpo_id", F.explode("mentions").alias("m")).select(
        "document_id", m["source_proposal_id"].alias("proposal_id"), m["mention_index"].alias("mention_index"), F.lit("accepted").alias("reason"),
        F.concat(m["start"].cast("string"), F.lit("-"), m["end"].cast("string"), F.lit(" "), m["phrase"], F.lit(" "), F.col("hpo_id")).alias("detail"),
    )
    return out["rejections"].unionByName(good)


@states("""WITH reports AS (SELECT CAST(doc_id // 100 + CASE WHEN toxic = 1 THEN 1000 ELSE 0 END AS VARCHAR) || '/' || doc_id AS key, text FROM documents JOIN labels USING (doc_id)),
    expected AS (SELECT CAST(doc_id // 100 AS VARCHAR) || '/' || doc_id AS key FROM documents)
    SELECT key, 'missing_document' AS reason FROM expected WHERE key NOT IN (SELECT key FROM reports)
    UNION ALL SELECT key, 'unknown_document' FROM reports WHERE key NOT IN (SELECT key FROM expected)
    UNION ALL SELECT key, 'repeated_document' FROM reports GROUP BY key HAVING count(*) > 1
    UNION ALL SELECT DISTINCT key, 'string_too_long' FROM reports WHERE length(text) > 300""")
def proposal_batches(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents as reports of a run, toxic ones in a wrong batch,
    against all documents."""
    docs = parquet(spark, d, "documents")
    keys = lambda more: [(F.floor(F.col("doc_id") / 100) + more).cast("string").alias("batch_id"), F.col("doc_id").cast("string").alias("document_id")]
    reports = docs.join(parquet(spark, d, "labels"), "doc_id").select(*keys(F.when(F.col("toxic") == 1, 1000).otherwise(0)), F.array(F.to_json(F.struct("source", "text"))).alias("annotations"))
    return proposals.batch_issues(reports, docs.select(*keys(F.lit(0)))).select("key", "reason")


@states("""WITH decisions AS (
        SELECT CASE WHEN event_id % 97 = 0 THEN 0 ELSE event_id END AS id, user_id, CASE WHEN event_id % 11 = 0 THEN event_id + 5000 END AS supersedes FROM events),
    targets AS (SELECT doc_id, count(*) AS n FROM labels GROUP BY 1)
    SELECT CAST(id AS VARCHAR) AS key, 'repeated_id' AS reason, NULL AS detail FROM decisions GROUP BY id HAVING count(*) > 1
    UNION ALL SELECT CAST(id AS VARCHAR), 'unknown_superseded', CAST(supersedes AS VARCHAR) FROM decisions WHERE supersedes IS NOT NULL AND supersedes NOT IN (SELECT id FROM decisions)
    UNION ALL SELECT CAST(user_id AS VARCHAR), CASE WHEN n IS NULL THEN 'unresolved_reference' ELSE 'ambiguous_reference' END, CAST(coalesce(n, 0) AS VARCHAR)
    FROM decisions LEFT JOIN targets ON user_id = doc_id WHERE coalesce(n, 0) <> 1""")
def decision_issues(spark: SparkSession, d: str) -> DataFrame:
    """Events as review decisions about labelled documents."""
    decisions = parquet(spark, d, "events").selectExpr("IF(event_id % 97 = 0, 0, event_id) AS decision_id", "user_id AS target_id", "IF(event_id % 11 = 0, event_id + 5000, NULL) AS supersedes")
    return corpus.decision_issues(decisions, parquet(spark, d, "labels").select(F.col("doc_id").alias("target_id"))).select("key", "reason", "detail")


@states("""WITH picks AS (SELECT CAST(d.doc_id AS VARCHAR) AS id, d.doc_id % 3 AS no, d.text, d.source, l.n FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM labels GROUP BY 1) l USING (doc_id))
    SELECT id AS key, 'record' AS state, substring(text, 1, 5) AS said,
        'single-term-' || sha256('{"document_id":' || to_json(id) || ',"end":5,"phrase":' || to_json(substring(text, 1, 5)) || ',"start":0,"term_id":' || coalesce(to_json(source), 'null') || '}') AS id
    FROM picks WHERE n = 1 AND no = 0 AND length(text) >= 5
    UNION ALL SELECT id, 'no_such_span', CAST(no AS VARCHAR), NULL FROM picks WHERE n = 1 AND NOT coalesce(no = 0 AND length(text) >= 5, false)
    UNION ALL SELECT id, 'unresolved_reference', '0', NULL FROM picks WHERE n IS NULL""")
def single_terms(spark: SparkSession, d: str) -> DataFrame:
    """One span of each document as an explicit selection; labelled documents
    have an annotation of two spans, the second beyond the text's end."""
    docs = parquet(spark, d, "documents").select(F.col("doc_id").cast("string").alias("document_id"), "text", "source", "doc_id")
    end = F.length("text")
    spans = F.array(F.struct(F.lit(0).alias("start"), F.lit(5).alias("end")), F.struct((end - 3).alias("start"), (end + 1).alias("end")))
    notes = docs.join(parquet(spark, d, "labels").select("doc_id"), "doc_id").select(F.col("document_id").alias("annotation_id"), "document_id", F.col("source").alias("term_id"), spans.alias("spans"))
    picks = docs.select(F.col("document_id").alias("annotation_id"), (F.col("doc_id") % 3).cast("int").alias("span_no"))
    records, issues = corpus.single_terms(picks, notes, docs)
    good = records.select(F.col("document_id").alias("key"), F.lit("record").alias("state"), F.col("phrase").alias("said"), F.col("single_term_id").alias("id"))
    return good.unionByName(issues.select("key", F.col("reason").alias("state"), F.col("detail").alias("said"), F.lit(None).cast("string").alias("id")))


@states("""WITH spans AS (SELECT l_orderkey AS document_id, l_linestatus AS language, l_linenumber AS start, l_linenumber + 5 AS "end", concat(l_returnflag, l_partkey % 50) AS phrase, l_suppkey AS term_id, l_linenumber % 3 AS a, l_suppkey % 7 AS e FROM lineitem),
    alone AS (SELECT document_id, start, "end", min(language) AS language, min(phrase) AS phrase, min(term_id) AS term_id, min(a) AS a, min(e) AS e FROM spans GROUP BY 1, 2, 3 HAVING count(*) = 1),
    n AS (SELECT language, phrase, term_id, count(*) AS n_spans FROM alone WHERE a > 0 AND e > 0 GROUP BY 1, 2, 3)
    SELECT *, count(*) OVER (PARTITION BY language, phrase) > 1 AS several_terms FROM n""")
def term_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Line items as spans of orders."""
    spans = parquet(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("document_id"), F.col("l_linestatus").alias("language"), F.col("l_linenumber").alias("start"), (F.col("l_linenumber") + 5).alias("end"),
        F.concat("l_returnflag", (F.col("l_partkey") % 50).cast("string")).alias("phrase"), F.col("l_suppkey").alias("term_id"),
        F.when(F.col("l_linenumber") % 3 == 0, "absent").otherwise("present").alias("assertion"), F.when(F.col("l_suppkey") % 7 == 0, "family_member").otherwise("patient").alias("experiencer"),
    )
    return corpus.single_term_candidates(spans)


@states("""WITH s AS (SELECT l_orderkey, l_partkey * 1000 + l_suppkey * 10 + l_linenumber AS id, l_partkey % 200 AS x, l_partkey % 200 + CAST(l_quantity AS BIGINT) AS y FROM lineitem)
    SELECT a.l_orderkey, a.id AS a, b.id AS b FROM s a JOIN s b ON a.l_orderkey = b.l_orderkey AND a.id < b.id AND a.x < b.y AND b.x < a.y""")
def overlapping_spans(spark: SparkSession, d: str) -> DataFrame:
    """Line items as spans of their orders."""
    spans = parquet(spark, d, "lineitem").selectExpr("l_orderkey", "l_partkey * 1000 + l_suppkey * 10 + l_linenumber AS span_id", "l_partkey % 200 AS start", "l_partkey % 200 + CAST(l_quantity AS BIGINT) AS end")
    return relational.overlaps(spans, "l_orderkey")


@states("""SELECT doc_id, 'rec-' || sha256('{"doc_id":' || doc_id || ',"lang":' || coalesce(to_json(lang), 'null') || ',"source":' || coalesce(to_json(source), 'null') || '}') AS record_id FROM documents""")
def record_ids(spark: SparkSession, d: str) -> DataFrame:
    return parquet(spark, d, "documents").select("doc_id", hashing.derived_id("rec-", hashing.record_json("source", "lang", "doc_id")).alias("record_id"))


_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@states(rf"""SELECT doc_id, sha256(nfc_normalize(regexp_replace(text, '\r\n?', chr(10), 'g'))) AS canonical_sha256,
        sha256(regexp_replace(translate(translate(translate(text, '{text.DOUBLE_QUOTES}', repeat('"', {len(text.DOUBLE_QUOTES)})), '{text.SINGLE_QUOTES}', repeat('''', {len(text.SINGLE_QUOTES)})),
            '{text.DASHES}', repeat('-', {len(text.DASHES)})), '{_WS}', ' ', 'g')) AS plain_sha256,
        CAST(length(text) + length(regexp_replace(text, '[^\x{{10000}}-\x{{10FFFF}}]', '', 'g')) AS DOUBLE) AS utf16 FROM documents""")
def canonical_texts(spark: SparkSession, d: str) -> DataFrame:
    body = F.col("text")
    return parquet(spark, d, "documents").select(
        "doc_id", F.sha2(text.canonical(body), 256).alias("canonical_sha256"), F.sha2(text.plain_typography(body), 256).alias("plain_sha256"), text.utf16_length(body).alias("utf16")
    )


@states("""SELECT page_id, url_encode(url) AS encoded, 'Read ' || url || ' as page ' || page_id AS prompt, replace(url || ' | ' || page_id, '|', chr(92) || '|') AS cell FROM pages""")
def url_forms(spark: SparkSession, d: str) -> DataFrame:
    """Urls percent-encoded, in a prompt and in a table's cell."""
    number = F.col("page_id").cast("string")
    return parquet(spark, d, "pages").select(
        "page_id", text.percent_encode(F.col("url")).alias("encoded"), text.filled_prompt(F.lit("Read {{url}} as page {{no}}"), {"url": F.col("url"), "no": number}).alias("prompt"),
        text.markdown_cell(F.concat(F.col("url"), F.lit(" | "), number)).alias("cell"),
    )


@states("""SELECT conv_id, turn, sha256('role|' || role || '|text|' || text) AS strings_sha256, 'text' AS more FROM conversations WHERE role IS NOT NULL AND text IS NOT NULL
    UNION ALL SELECT conv_id, turn, sha256(concat_ws('|', CASE WHEN role IS NOT NULL THEN 'role|' || role END, CASE WHEN text IS NOT NULL THEN 'text|' || text END)),
        CASE WHEN text IS NULL THEN '' ELSE 'text' END FROM conversations WHERE role IS NULL OR text IS NULL""")
def nested_fields(spark: SparkSession, d: str) -> DataFrame:
    """All strings of each turn's JSON, and its fields that are not allowed."""
    body = F.to_json(F.struct("role", "text"))
    return parquet(spark, d, "conversations").select(
        "conv_id", "turn", F.sha2(F.array_join(safety.nested_strings(body), "|"), 256).alias("strings_sha256"), F.array_join(safety.allowed_fields(body, ["role"]), ",").alias("more")
    )


@states("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS utc,
        rtrim(rtrim(CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS VARCHAR), '0'), '.') AS price FROM orders""")
def value_texts(spark: SparkSession, d: str) -> DataFrame:
    """Dates written strictly or not, times and prices as texts."""
    written = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-d'x'")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return parquet(spark, d, "orders").select(
        "o_orderkey", hashing.strict_date(written).cast("string").alias("day"), hashing.utc_text(F.col("o_orderdate")).alias("utc"), hashing.decimal_text(F.col("o_totalprice").cast("decimal(15,2)")).alias("price")
    )


@states("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') AS window_start, event_type, count(*) AS n_events FROM events GROUP BY 1, 2")
def hourly_events(spark: SparkSession, d: str) -> DataFrame:
    n = streams.tumbling(parquet(spark, d, "events"))
    return n.select(hashing.utc_text(F.col("window_start")).alias("window_start"), "event_type", "n_events")


@states("""WITH marked AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    numbered AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked)
    SELECT user_id, strftime(min(ts), '%Y-%m-%dT%H:%M:%SZ') AS session_start, strftime(max(ts) + INTERVAL 30 MINUTE, '%Y-%m-%dT%H:%M:%SZ') AS session_end, count(*) AS n_events FROM numbered GROUP BY user_id, s""")
def session_windows(spark: SparkSession, d: str) -> DataFrame:
    n = streams.session_counts(parquet(spark, d, "events"))
    return n.select("user_id", hashing.utc_text(F.col("session_start")).alias("session_start"), hashing.utc_text(F.col("session_end")).alias("session_end"), "n_events")


@states(rf"""WITH inv AS (
        SELECT doc_id, CAST(length(t) - length(replace(t, '.', '')) AS BIGINT) * 100 AS marks,
               CAST(len(list_filter(regexp_split_to_array(t, '{_WS}'), lambda w: w <> '')) AS BIGINT) AS words FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
    SELECT doc_id, CASE WHEN words > 0 THEN marks // gcd(marks, words) END AS numerator, CASE WHEN words > 0 THEN words // gcd(marks, words) END AS denominator FROM inv""")
def exact_density(spark: SparkSession, d: str) -> DataFrame:
    rows = inventory.inventory(parquet(spark, d, "documents").select("doc_id", "text"))
    return rows.select("doc_id", inventory.rational(F.col("marks") * 100, F.col("n_tokens")).alias("r")).select("doc_id", "r.*")


@states("""SELECT '{"n_name":' || to_json(n_name) || ',"n_nationkey":' || n_nationkey || ',"n_regionkey":' || n_regionkey || '}' AS value FROM nation""")
def canonical_lines(spark: SparkSession, d: str) -> DataFrame:
    return sinks.canonical_lines(parquet(spark, d, "nation"), ["n_nationkey"])


@states("""SELECT '| r_name | r_regionkey |' AS value UNION ALL SELECT '| --- | --- |' UNION ALL SELECT '| ' || r_name || ' | ' || r_regionkey || ' |' FROM region""")
def attribution_lines(spark: SparkSession, d: str) -> DataFrame:
    return sinks.attribution_table(parquet(spark, d, "region"), ["r_name", "r_regionkey"])


@states("""SELECT doc_id AS source_case_id, CASE WHEN quality = 1 AND toxic = 0 AND text IS NOT NULL AND lang IS NOT NULL THEN 'reuse' ELSE 'translate' END AS state
    FROM documents LEFT JOIN labels USING (doc_id)""")
def reused_translations(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents as earlier translations, failed where the quality is
    0 and by another model where toxic."""
    fixed = [F.lit("v").alias(c) for c in translation.REUSED if c not in ("source_language", "document_sha256", "model")]
    docs = parquet(spark, d, "documents").select(F.col("doc_id").alias("source_case_id"), F.col("lang").alias("source_language"), F.sha2("text", 256).alias("document_sha256"), *fixed)
    labels = parquet(spark, d, "labels").select(F.col("doc_id").alias("source_case_id"), F.when(F.col("quality") == 1, "accepted").otherwise("failed").alias("status"), F.when(F.col("toxic") == 1, "old").otherwise("new").alias("model"))
    todo, hold = translation.to_translate(docs.withColumn("model", F.lit("new")), docs.join(labels, "source_case_id"))
    return todo.select("source_case_id", F.lit("translate").alias("state")).unionByName(hold.select("source_case_id", F.lit("reuse").alias("state")))
