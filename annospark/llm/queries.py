"""The queries of the training-data operators, with production parameters,
over whole tables; and their SQL where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.llm import decontaminate, fingerprint, language_id, line_dedup, ngram_join, packing, quality, token_count, toxicity, url_filter
from annospark.llm.common import remainder, table


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join.similar_sets(table(spark, sf_dir, "documents"), shingle=4, num=85, den=100)
    return out.select("doc_id", "n_shingles", "component_id")


OP1_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i + 1, i + 4), ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(greatest(1, len(w) - 3))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM shared o JOIN sizes a ON o.x = a.doc_id JOIN sizes b ON o.y = b.doc_id
    WHERE 100 * n_both >= 85 * (a.n + b.n - n_both)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
    WITH RECURSIVE r(a, b) AS (
        SELECT x, y FROM edges UNION SELECT r.a, e.y FROM r JOIN edges e ON r.b = e.x)
    SELECT a, min(b) AS least FROM r GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.least, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id LEFT JOIN reach r ON d.doc_id = r.a
"""


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.report(decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), width=10))


OP2_SQL = r"""
WITH folded AS (
    SELECT 'd' AS side, doc_id AS id, text FROM documents
    UNION ALL SELECT 'b', item_id, text FROM benchmark),
words AS (
    SELECT side, id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM folded),
items AS (
    SELECT id AS item_id, w, least(10, len(w)) AS n, unnest(range(len(w) - least(10, len(w)) + 1)) AS i
    FROM words WHERE side = 'b' AND len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i + 1, i + n), ' ') AS win FROM items),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT id AS doc_id, w, n, unnest(range(len(w) - n + 1)) AS i
    FROM words, lengths WHERE side = 'd' AND len(w) >= n),
hits AS (
    SELECT p.doc_id, p.i, p.n, x.item_id
    FROM (SELECT doc_id, n, i, array_to_string(list_slice(w, i + 1, i + n), ' ') AS win FROM places) p
    JOIN windows x ON p.n = x.n AND p.win = x.win),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS place FROM hits),
n_hits AS (SELECT doc_id, count(*) AS n_hit FROM covered GROUP BY doc_id),
found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.id AS doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words d LEFT JOIN n_hits h ON d.id = h.doc_id LEFT JOIN found f ON d.id = f.doc_id WHERE d.side = 'd'
"""


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_likeness(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    part = remainder(F.col("doc_id"), 3)
    model = language_id.LanguageModel().fit(language_id.training_slices(docs.where(part != 1)))
    out = language_id.identify(docs, model)
    return out.select("doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


#: The standing rules of the URL filter.
URL_RULES = [
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), window=2048, end_id=1)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select("row.doc_id", "score", "content", "metadata", "keep")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    part = remainder(F.col("doc_id"), 4)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.ToxicityModel().fit(toxicity.training_rows(docs.where(part != 2), labels.where(part != 2)))
    out = toxicity.score_toxicity(docs, model, lang="lang")
    return out.select(
        "doc_id", F.coalesce(part == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "flagged"
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(line_dedup.dedup_lines(table(spark, sf_dir, "documents")))


OP9_SQL = """
WITH lines AS (
    SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
firsts AS (SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (
    SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id = f.first_doc, true) AS stays
    FROM keyed k LEFT JOIN firsts f ON k.key = f.key AND length(k.key) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), limit=4096)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": op1_ngram_join,
        "op2_decontamination": op2_decontamination,
        "op3_fingerprints": op3_fingerprints,
        "op4_language_id": op4_language_id,
        "op5_url_filter": op5_url_filter,
        "op6_packing": op6_packing,
        "op7_quality": op7_quality,
        "op8_toxicity": op8_toxicity,
        "op9_line_dedup": op9_line_dedup,
        "op10_token_counts": op10_token_counts,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_join": OP1_SQL,
        "op2_decontamination": OP2_SQL,
        "op9_line_dedup": OP9_SQL,
    }
