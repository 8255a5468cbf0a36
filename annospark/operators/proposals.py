"""Validation of machine proposals: every item is accepted or rejected with a
reason; accepted ones of equal term and status are merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annospark.functions.locate import located, without_overlaps
from annospark.functions.safety import nested_strings
from annospark.sources.tables import cut

STATUS = ["hpo_id", "assertion", "experiencer", "temporality", "verbalized"]
FIELDS = {
    "proposal_id": "string", "hpo_id": "string", "hpo_label": "string", "assertion": "string", "experiencer": "string",
    "temporality": "string", "verbalized": "boolean", "mentions": "array<struct<phrase:string,context:string,occurrence:int>>", "note": "string",
}
ALLOWED = {
    "assertion": ["present", "absent", "uncertain"],
    "experiencer": ["patient", "family_member", "other"],
    "temporality": ["current", "historical"],
}


def _get(name: str) -> Column:
    return F.try_variant_get("item", f"$.{name}", FIELDS[name])


def _rejection(df: DataFrame, reason: Column | str, detail: Column | str | None = None, mention: str | None = None) -> DataFrame:
    said = F.lit(reason) if isinstance(reason, str) else reason
    more = F.lit(detail) if isinstance(detail, str) or detail is None else detail
    return df.select("document_id", "proposal_id", (F.col(mention) if mention else F.lit(None).cast("int")).alias("mention_index"), said.alias("reason"), more.cast("string").alias("detail"))


def validate(reports: DataFrame, documents: DataFrame, terms: DataFrame, alternates: DataFrame) -> dict[str, DataFrame]:
    """proposals, rejections, warnings, summary of ``reports`` (document_id,
    annotations ARRAY<STRING>: one JSON item each, in arrival order).

    ``documents``: document_id, text; ``terms``: id, label, obsolete,
    phenotypic; ``alternates``: alternate, id. A malformed item is rejected by
    itself. Items of unknown documents are rejected too.
    """
    items = reports.select("document_id", F.posexplode("annotations").alias("ord", "raw")).withColumn("item", F.try_parse_json("raw"))
    rows = items.select("document_id", "ord", *(_get(n).alias(n) for n in FIELDS))
    whole = F.lit(True)
    for name in FIELDS:
        if name != "note":
            whole = whole & F.col(name).isNotNull()
    for name, values in ALLOWED.items():
        whole = whole & F.col(name).isin(values)
    mention_ok = F.forall("mentions", lambda m: m["phrase"].isNotNull() & m["context"].isNotNull() & F.coalesce(m["occurrence"] >= 1, F.lit(True)))
    whole = F.coalesce(whole & (F.size("mentions") > 0) & mention_ok & F.col("hpo_id").rlike(r"^HP:\d{7}$"), F.lit(False))
    rows = rows.withColumn("whole", whole)
    nth = F.row_number().over(Window.partitionBy("document_id", "whole", "proposal_id").orderBy("ord"))
    rows = rows.withColumn("nth", nth)
    rows = rows.join(terms.select(F.col("id").alias("hpo_id"), "label", "obsolete", "phenotypic"), "hpo_id", "left")
    rows = rows.join(alternates.select(F.col("alternate").alias("hpo_id"), F.col("id").alias("primary")), "hpo_id", "left")
    rows = rows.join(documents.select("document_id", "text"), "document_id", "left")
    reason = (
        F.when(~F.col("whole"), "invalid_schema").when(F.col("nth") > 1, "duplicate_proposal_id").when(F.col("obsolete").isNull(), "unknown_hpo_id")
        .when(F.col("obsolete"), "obsolete_hpo_id").when(~F.col("phenotypic"), "hpo_id_not_phenotypic").when(F.col("text").isNull(), "unknown_document")
    )
    detail = F.when((reason == "unknown_hpo_id") & F.col("primary").isNotNull(), F.concat(F.lit("now named "), F.col("primary")))
    rows = cut(rows.withColumns({"reason": reason, "why": detail}))
    good = rows.where("reason is null")
    rejected = _rejection(rows.where("reason is not null"), F.col("reason"), F.col("why"))

    mentions = good.select("document_id", "proposal_id", "ord", *STATUS, "label", "note", "text", F.posexplode("mentions").alias("mention_index", "m"))
    spans = cut(mentions.withColumn("at", located(F.col("text"), F.col("m.phrase"), F.col("m.context"), F.col("m.occurrence"))))
    found = spans.where("at.reason is null").withColumns({"start": F.col("at.start"), "end": F.col("at.end")})
    rejected = rejected.unionByName(_rejection(spans.where("at.reason is not null"), F.col("at.reason"), F.col("at.detail"), "mention_index"))
    lost = good.join(found.select("document_id", "proposal_id").distinct(), ["document_id", "proposal_id"], "left_anti")
    rejected = rejected.unionByName(_rejection(lost, "no_valid_mentions", "all mentions were rejected"))

    # one row a mention in arrival order, folded within its group; groups are a document's
    arrival = F.struct("ord", "mention_index", "proposal_id", "start", "end", F.expr("substring(text, start + 1, end - start)").alias("phrase"))
    groups = found.groupBy("document_id", *STATUS).agg(
        F.sort_array(F.collect_list(arrival)).alias("all"),
        F.sort_array(F.collect_set(F.struct("ord", "proposal_id", "note"))).alias("members"),
        F.first("label").alias("hpo_label"),
    )

    groups = cut(groups.withColumn("kept", without_overlaps(F.col("all"))))
    over = groups.select("document_id", F.explode(F.array_except("all", "kept")).alias("x")).select("document_id", "x.proposal_id", "x.mention_index")
    rejected = rejected.unionByName(_rejection(over, "overlapping_mention", "a longer or earlier mention of its group covers it", "mention_index"))
    proposals = groups.select(
        "document_id", F.col("members")[0]["proposal_id"].alias("proposal_id"), F.col("members.proposal_id").alias("source_proposal_ids"),
        *STATUS, F.coalesce("hpo_label", "hpo_id").alias("hpo_label"),
        F.sort_array(F.transform("kept", lambda k: F.struct(k["start"].alias("start"), k["end"].alias("end"), k["phrase"].alias("phrase"), k["proposal_id"].alias("source_proposal_id"), k["mention_index"].alias("mention_index")))).alias("mentions"),
        F.filter(F.transform("members", lambda m: m["note"]), lambda n: n.isNotNull() & (n != "")).alias("notes"),
    )
    rejected = cut(rejected)
    label = F.coalesce(F.lower("label") == F.lower("hpo_label"), F.lit(False))
    warnings = good.where(~label).select("document_id", "proposal_id", "hpo_id", F.col("hpo_label").alias("proposed_label"), F.col("label").alias("pinned_label"))
    counts = rejected.groupBy("reason").agg(F.count("*").alias("n_rows"))
    return {"proposals": proposals, "rejections": rejected, "warnings": warnings, "summary": counts}


def batch_issues(reports: DataFrame, expected: DataFrame, longest: int = 300) -> DataFrame:
    """Issues of one run's batches (batch_id, document_id, annotations) against
    the expected (batch_id, document_id): missing, unknown and repeated
    documents, and strings that are too long (texts and field names at any
    depth, as parsed); all together."""
    kind = lambda df, why: df.select(F.lit("batch").alias("operator"), F.concat_ws("/", "batch_id", "document_id").alias("key"), F.lit(why).alias("reason"), F.lit(None).cast("string").alias("detail"))
    keys = ["batch_id", "document_id"]
    own = reports.select(*keys)
    twice = own.groupBy(*keys).count().where("count > 1")
    strings = reports.select(*keys, F.explode("annotations").alias("a")).select(*keys, nested_strings(F.col("a")).alias("strings"))
    long = strings.where(F.exists("strings", lambda s: F.length(s) > longest)).select(*keys).distinct()
    return (
        kind(expected.select(*keys).join(own, keys, "left_anti"), "missing_document").unionByName(kind(own.join(expected.select(*keys), keys, "left_anti"), "unknown_document"))
        .unionByName(kind(twice, "repeated_document")).unionByName(kind(long, "string_too_long"))
    )
