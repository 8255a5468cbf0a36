"""The registered queries over the driver's tables, and their SQL.

Each stands for one or more operators, on the table that fits best."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.functions.hashing import sha256
from annospark.functions.locate import passages, without_overlaps
from annospark.operators import checks, mapping, ontology, relational, review, select, translation
from annospark.operators.inventory import inventory
from annospark.plans import records
from annospark.sources.documents import html_text
from annospark.sources.tables import parquet

SEED = "annospark-split-v1"
LANGS = ["en", "fr", "es"]


def _inventory(spark: SparkSession, d: str) -> DataFrame:
    return inventory(parquet(spark, d, "documents").select("doc_id", "lang", "text")).drop("text")


def _ints(*columns: str) -> list:
    return [F.col(c).cast("bigint").alias(c) for c in columns]


def doc_inventory(spark: SparkSession, d: str) -> DataFrame:
    return _inventory(spark, d).select("doc_id", "lang", "n_codepoints", "n_tokens", "n_lines", "marks", "stratum")


def group_split(spark: SparkSession, d: str) -> DataFrame:
    split = select.systematic_split(_inventory(spark, d), SEED, LANGS)
    return split.select("doc_id", "lang", "stratum", F.col("group").alias("annotation_language"))


def group_sizes(spark: SparkSession, d: str) -> DataFrame:
    split = select.systematic_split(_inventory(spark, d), SEED, LANGS)
    return split.groupBy("lang", "group", "stratum").agg(F.count("*").alias("n_docs")).withColumnRenamed("group", "annotation_language")


def pilot_pick(spark: SparkSession, d: str) -> DataFrame:
    return select.first_by_hash(_inventory(spark, d), SEED, ["lang", "stratum"])


def batch_plan(spark: SparkSession, d: str) -> DataFrame:
    docs = parquet(spark, d, "documents").select("doc_id", "lang", "source")
    return select.batches(docs, 10, ["lang", "source"], ["doc_id"]).select("doc_id", "lang", "source", "batch_no", "batch_id")


def duplicate_texts(spark: SparkSession, d: str) -> DataFrame:
    docs = parquet(spark, d, "documents").select("doc_id", sha256(F.col("text")).alias("text_sha256"))
    n = docs.groupBy("text_sha256").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"))
    return n.where("n_docs > 1")


def label_join_pending(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = parquet(spark, d, "documents").select("doc_id", "lang"), parquet(spark, d, "labels")
    both = docs.join(labels, "doc_id", "left")
    state = F.when(F.col("quality").isNull(), "pending").when(F.col("quality") == 1, "accepted").otherwise("rejected")
    return both.groupBy("lang", state.alias("state")).agg(F.count("*").alias("n_docs"))


def passage_spans(spark: SparkSession, d: str) -> DataFrame:
    return passages(parquet(spark, d, "documents"), parquet(spark, d, "benchmark"))


def greedy_spans(spark: SparkSession, d: str) -> DataFrame:
    """Of each document's passages, in item order, those that overlap none
    before them."""
    spans = passage_spans(spark, d).select("doc_id", F.struct("item_id", "start", "end").alias("s"))
    grouped = spans.groupBy("doc_id").agg(F.sort_array(F.collect_list("s")).alias("spans"))
    return grouped.select("doc_id", F.size("spans").cast("bigint").alias("n_spans"), F.size(without_overlaps(F.col("spans"))).cast("bigint").alias("n_kept"))


def _concepts(spark: SparkSession, d: str) -> DataFrame:
    parts = parquet(spark, d, "part").select("p_partkey", (F.col("p_size") <= 45).alias("valid"))
    lines = parquet(spark, d, "lineitem").where("l_quantity = 50 and l_returnflag = 'R'").select("l_partkey", "l_suppkey").distinct()
    found = lines.join(parquet(spark, d, "supplier"), lines.l_suppkey == F.col("s_suppkey"))
    candidates = found.select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").cast("string").alias("id"), (F.col("s_acctbal") < 0).alias("obsolete"))
    return mapping.classify(parts, candidates, "p_partkey")


def concept_classes(spark: SparkSession, d: str) -> DataFrame:
    return _concepts(spark, d).select("p_partkey", "n_candidates", "class")


def concept_summary(spark: SparkSession, d: str) -> DataFrame:
    return mapping.summary(_concepts(spark, d))


def case_subset(spark: SparkSession, d: str) -> DataFrame:
    customers = parquet(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    cases = mapping.subset(parquet(spark, d, "orders"), customers, "o_custkey")
    return cases.groupBy("o_orderstatus").agg(F.count("*").alias("n_orders"), F.count_distinct("o_custkey").alias("n_customers"))


def fk_missing(spark: SparkSession, d: str) -> DataFrame:
    orders = parquet(spark, d, "orders").select(F.col("o_orderkey").alias("orderkey"))
    return checks.missing(orders, parquet(spark, d, "lineitem").select(F.col("l_orderkey").alias("orderkey")), ["orderkey"])


def key_equality(spark: SparkSession, d: str) -> DataFrame:
    orders = parquet(spark, d, "orders").select(F.col("o_orderkey").alias("k"))
    return checks.one_sided(orders, parquet(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")), ["k"])


def last_decision(spark: SparkSession, d: str) -> DataFrame:
    last = relational.last_per_key(parquet(spark, d, "events"), "user_id", ["ts", "event_id"], ["event_type", "event_id"])
    kind = F.col("event_type")
    state = F.when(kind.isin("purchase", "signup"), "accepted").when(kind.isin("error", "click"), "pending").otherwise("other")
    return last.select("user_id", "event_id", "event_type", state.alias("state"))


def merge_conflicts(spark: SparkSession, d: str) -> DataFrame:
    events = parquet(spark, d, "events").select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type")
    n = events.groupBy("user_id", "day").agg(F.count_distinct("event_type").alias("n_types"))
    return n.where("n_types > 1")


def reason_counts(spark: SparkSession, d: str) -> DataFrame:
    reason = F.get_json_object("props", "$.k").alias("reason")
    return relational.counts_by(parquet(spark, d, "events").select(reason), ["reason"])


def cost_exact(spark: SparkSession, d: str) -> DataFrame:
    out = translation.cost(parquet(spark, d, "documents"), "text", "23")
    return out.select("n_texts", "code_points", F.col("usd").cast("string").alias("usd"))


def label_search(spark: SparkSession, d: str) -> DataFrame:
    parts = parquet(spark, d, "part").where("p_size > 5").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    hits = ontology.ranked_names(parts, ["ring", "red", "hot plate"], limit=5)
    return hits.select("query", "id", "name", F.col("place").cast("bigint").alias("place"))


def _edges(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: parquet(spark, d, n)
    node = lambda kind, key: F.concat(F.lit(kind), F.col(key).cast("string"))
    edge = lambda df, a, b: df.select(a.alias("parent"), b.alias("child"))
    return (
        edge(t("nation"), node("r", "n_regionkey"), node("n", "n_nationkey"))
        .unionByName(edge(t("customer"), node("n", "c_nationkey"), node("c", "c_custkey")))
        .unionByName(edge(t("supplier"), node("n", "s_nationkey"), node("s", "s_suppkey")))
    )


def descendants(spark: SparkSession, d: str) -> DataFrame:
    roots = parquet(spark, d, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("root"))
    below = ontology.descendants(_edges(spark, d), roots)
    return below.groupBy("root", "depth").agg(F.count("*").alias("n_nodes")).select("root", *_ints("depth"), "n_nodes")


def inverted_index(spark: SparkSession, d: str) -> DataFrame:
    lines = parquet(spark, d, "lineitem").select("l_partkey", "l_suppkey")
    index = relational.inverted(lines, "l_partkey", "l_suppkey", "suppliers")
    return index.select("l_partkey", F.array_join("suppliers", ",").alias("suppliers"))


def turn_batches(spark: SparkSession, d: str) -> DataFrame:
    turns = parquet(spark, d, "conversations").select("conv_id", "turn", "role")
    placed = select.global_batches(turns, 10, ["conv_id", "turn", "role"], int(spark.conf.get("spark.sql.shuffle.partitions")))
    return placed.select("conv_id", "turn", *_ints("place", "batch_no"))


def diversity_pick(spark: SparkSession, d: str) -> DataFrame:
    rows = _inventory(spark, d).where(F.col("lang").isin(LANGS) & (F.col("n_tokens") > 0))
    rows = rows.withColumns({"one": F.lit(1), "m": F.col("marks") * 100})
    features = [("n_tokens", "one"), ("m", "n_tokens"), ("n_lines", "one"), ("n_codepoints", "n_tokens")]
    return select.farthest_first(rows, ["lang", "stratum"], features, {"short": 3, "medium": 4, "long": 3}, "stratum", SEED)


def unit_changes(spark: SparkSession, d: str) -> DataFrame:
    """Each text against itself with every digit's unit doubled: what a careless
    translation adds."""
    docs = parquet(spark, d, "documents").select("doc_id", "text")
    target = F.regexp_replace("text", r"(\d+)(?=[\s.,;])", "$1 mg")
    return docs.select("doc_id", translation.added_units(F.col("text"), target).alias("added")).where(F.size("added") > 0).select("doc_id", F.array_join("added", ",").alias("added"))


def translation_status(spark: SparkSession, d: str) -> DataFrame:
    """The five checks of each text against its upper-cased form, the language
    column as detector."""
    docs = parquet(spark, d, "documents").select("doc_id", "lang", "text")
    added = translation.added_units(F.col("text"), F.upper("text"))
    done = docs.select("lang", translation.checks(F.col("text"), F.upper("text"), added, F.col("lang")).alias("c"))
    codes = done.select("lang", F.explode("c").alias("c")).select("lang", "c.code", "c.passed")
    return codes.groupBy("lang", "code").agg(F.count_if("passed").alias("n_passed"), F.count("*").alias("n_docs"))


def html_words(spark: SparkSession, d: str) -> DataFrame:
    pages = parquet(spark, d, "pages").select("page_id", html_text(F.col("html")).alias("text"))
    return pages.select("page_id", F.sha2("text", 256).alias("text_sha256"), F.length("text").cast("bigint").alias("n_chars"))


def rollup_lang_source(spark: SparkSession, d: str) -> DataFrame:
    docs = parquet(spark, d, "documents").select("lang", "source", F.length("text").cast("bigint").alias("n"))
    return docs.rollup("lang", "source").agg(F.count("*").alias("n_docs"), F.sum("n").alias("code_points"))


def asof_events(spark: SparkSession, d: str) -> DataFrame:
    """Each purchase with the user's latest earlier or simultaneous click."""
    e = parquet(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    clicks = e.where("event_type = 'click'").groupBy("user_id", "ts").agg(F.max("event_id").alias("click_id"))
    return relational.asof_backward(left, clicks, "user_id", "ts", "click_id", "last_click").select("event_id", "user_id", "last_click")


def session_events(spark: SparkSession, d: str) -> DataFrame:
    s = relational.sessions(parquet(spark, d, "events"), "user_id", "ts")
    return s.groupBy("user_id").agg(F.count("*").alias("n_sessions"), F.max("n_events").alias("longest"))


def review_states(spark: SparkSession, d: str) -> DataFrame:
    events = parquet(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    return review.status_counts(events, "user_id", ["ts", "event_id"], "event_type")


QUERIES = [
    doc_inventory, group_split, group_sizes, pilot_pick, batch_plan, duplicate_texts, label_join_pending, passage_spans, greedy_spans,
    concept_classes, concept_summary, case_subset, fk_missing, key_equality, last_decision, merge_conflicts, reason_counts, cost_exact,
    label_search, descendants, inverted_index, turn_batches, diversity_pick, unit_changes, translation_status, html_words,
    rollup_lang_source, asof_events, session_events, review_states, *records.QUERIES,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    from annospark.plans.sql import SQL

    return SQL | records.SQL
