"""The registered queries in SQL."""

_INVENTORY = r"""
inv AS (
    SELECT doc_id, lang, CAST(length(text) AS BIGINT) AS n_codepoints,
           CAST(len(list_filter(regexp_split_to_array(text, '[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda t: t <> '')) AS BIGINT) AS n_tokens,
           CAST(len(list_filter(string_split(text, chr(10)), lambda t: regexp_replace(t, '[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', '', 'g') <> '')) AS BIGINT) AS n_lines,
           CAST(length(text) - length(replace(text, '.', '')) AS BIGINT) AS marks
    FROM (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents)),
strata AS (
    SELECT *, CASE WHEN n_tokens < 200 THEN 'short' WHEN n_tokens <= 400 THEN 'medium' ELSE 'long' END AS stratum,
           CASE WHEN n_tokens < 200 THEN 0 WHEN n_tokens <= 400 THEN 1 ELSE 2 END AS stratum_no
    FROM inv)"""

_SPLIT = f"""{_INVENTORY},
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY stratum_no,
               CASE WHEN n_tokens > 0 THEN CAST(marks * 100 AS DOUBLE) / n_tokens END NULLS FIRST,
               sha256('annospark-split-v1' || chr(0) || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS i,
           CAST(('0x' || right(sha256('annospark-split-v1' || chr(0) || lang), 1)) AS INT) % 4 AS o
    FROM strata WHERE lang IN ('en', 'fr', 'es')),
split AS (SELECT doc_id, lang, stratum, CASE WHEN i % 4 = o THEN 'de' ELSE lang END AS annotation_language FROM ranked)"""

_PASSAGES = """
places AS (
    SELECT doc_id, item_id, text, passage, unnest(range(length(text) - length(passage) + 1)) AS start
    FROM (SELECT d.doc_id, b.item_id, d.text, b.text AS passage FROM documents d JOIN benchmark b ON contains(d.text, b.text) WHERE length(b.text) > 0)),
spans AS (
    SELECT doc_id, item_id, CAST(start AS BIGINT) AS start, CAST(start + length(passage) AS BIGINT) AS "end"
    FROM places WHERE substring(text, start + 1, length(passage)) = passage)"""

_CONCEPTS = """
candidates AS (
    SELECT DISTINCT l_partkey, l_suppkey, s_acctbal < 0 AS obsolete FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    WHERE l_quantity = 50 AND l_returnflag = 'R'),
gathered AS (SELECT l_partkey, count(*) AS n, bool_or(obsolete) AS obsolete FROM candidates GROUP BY l_partkey),
classes AS (
    SELECT p_partkey, CASE WHEN p_size <= 45 THEN coalesce(n, 0) ELSE 0 END AS n_candidates,
           CASE WHEN p_size > 45 THEN 'invalid' WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'ambiguous' WHEN obsolete THEN 'obsolete' ELSE 'unique_active' END AS class
    FROM part LEFT JOIN gathered ON p_partkey = l_partkey)"""

_LAST = """
placed AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events),
latest AS (SELECT * FROM placed WHERE r = 1)"""

SQL = {
    "doc_inventory": f"WITH {_INVENTORY} SELECT doc_id, lang, n_codepoints, n_tokens, n_lines, marks, stratum FROM strata",
    "group_split": f"WITH {_SPLIT} SELECT * FROM split",
    "group_sizes": f"WITH {_SPLIT} SELECT lang, annotation_language, stratum, count(*) AS n_docs FROM split GROUP BY ALL",
    "pilot_pick": f"WITH {_INVENTORY} SELECT lang, stratum, arg_min(doc_id, sha256('annospark-split-v1' || chr(0) || CAST(doc_id AS VARCHAR))) AS doc_id FROM strata GROUP BY lang, stratum",
    "batch_plan": """SELECT doc_id, lang, source, batch_no, 'batch-' || lpad(CAST(batch_no AS VARCHAR), CAST(greatest(2, length(CAST(batch_no AS VARCHAR))) AS INT), '0') AS batch_id FROM (
        SELECT doc_id, lang, source, CAST((row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) - 1) // 10 + 1 AS BIGINT) AS batch_no FROM documents)""",
    "duplicate_texts": "SELECT sha256(text) AS text_sha256, count(*) AS n_docs, min(doc_id) AS first_doc FROM documents GROUP BY 1 HAVING count(*) > 1",
    "label_join_pending": """SELECT lang, CASE WHEN quality IS NULL THEN 'pending' WHEN quality = 1 THEN 'accepted' ELSE 'rejected' END AS state, count(*) AS n_docs
        FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1, 2""",
    "passage_spans": f"WITH {_PASSAGES} SELECT * FROM spans",
    "concept_classes": f"WITH {_CONCEPTS} SELECT p_partkey, n_candidates, class FROM classes",
    "concept_summary": f"""WITH {_CONCEPTS} SELECT c AS class, count(p_partkey) AS n_rows, CAST(coalesce(sum(n_candidates), 0) AS BIGINT) AS n_candidates
        FROM (SELECT unnest(['invalid', 'missing', 'ambiguous', 'obsolete', 'unique_active']) AS c) LEFT JOIN classes ON c = class GROUP BY c""",
    "case_subset": """SELECT o_orderstatus, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers FROM orders
        WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1""",
    "fk_missing": "SELECT o_orderkey AS orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
    "key_equality": """SELECT count(*) FILTER (l IS NULL) AS only_right, count(*) FILTER (o IS NULL) AS only_left, count(*) FILTER (l IS NOT NULL AND o IS NOT NULL) AS common
        FROM (SELECT DISTINCT l_orderkey AS o FROM lineitem) FULL OUTER JOIN (SELECT DISTINCT o_orderkey AS l FROM orders) ON l = o""",
    "last_decision": f"""WITH {_LAST} SELECT user_id, event_id, event_type,
        CASE WHEN event_type IN ('purchase', 'signup') THEN 'accepted' WHEN event_type IN ('error', 'click') THEN 'pending' ELSE 'other' END AS state FROM latest""",
    "merge_conflicts": "SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT event_type) AS n_types FROM events GROUP BY 1, 2 HAVING count(DISTINCT event_type) > 1",
    "reason_counts": "SELECT json_extract_string(props, '$.k') AS reason, count(*) AS n_rows FROM events GROUP BY 1",
    "cost_exact": """SELECT count(*) AS n_texts, CAST(sum(length(text)) AS BIGINT) AS code_points,
        CAST(CAST(CAST(sum(length(text)) AS DECIMAL(20, 0)) * 23 AS DECIMAL(28, 10)) * CAST(0.000001 AS DECIMAL(7, 6)) AS DECIMAL(28, 10)) :: VARCHAR AS usd FROM documents""",
    "label_search": """SELECT query, id, name, place FROM (
        SELECT q AS query, p_partkey AS id, p_name AS name, row_number() OVER (PARTITION BY q ORDER BY
            CASE WHEN lower(p_name) = q THEN 0 WHEN starts_with(lower(p_name), q) THEN 1 ELSE 2 END, length(p_name), p_partkey) AS place
        FROM part, (SELECT unnest(['ring', 'red', 'hot plate']) AS q)
        WHERE p_size > 5 AND len(list_filter(string_split(q, ' '), lambda w: NOT contains(lower(p_name), w))) = 0) WHERE place <= 5""",
    "descendants": """WITH RECURSIVE edges AS (
            SELECT 'r' || n_regionkey AS parent, 'n' || n_nationkey AS child FROM nation
            UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer UNION ALL SELECT 'n' || s_nationkey, 's' || s_suppkey FROM supplier),
        below(root, node, depth) AS (
            SELECT 'r' || r_regionkey, 'r' || r_regionkey, CAST(0 AS BIGINT) FROM region
            UNION SELECT root, child, depth + 1 FROM below JOIN edges ON node = parent)
        SELECT root, depth, count(*) AS n_nodes FROM below GROUP BY root, depth""",
    "inverted_index": "SELECT l_partkey, array_to_string(list_sort(list(DISTINCT l_suppkey)), ',') AS suppliers FROM lineitem GROUP BY l_partkey",
    "turn_batches": "SELECT conv_id, turn, place, place // 10 + 1 AS batch_no FROM (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn, role) - 1 AS place FROM conversations)",
    "rollup_lang_source": "SELECT lang, source, count(*) AS n_docs, CAST(sum(length(text)) AS BIGINT) AS code_points FROM documents GROUP BY ROLLUP (lang, source)",
    "asof_events": """WITH clicks AS (SELECT user_id, ts, max(event_id) AS click_id FROM events WHERE event_type = 'click' GROUP BY 1, 2)
        SELECT p.event_id, p.user_id, c.click_id AS last_click FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN clicks c ON p.user_id = c.user_id AND p.ts >= c.ts""",
    "session_events": """WITH marked AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        numbered AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked),
        sizes AS (SELECT user_id, s, count(*) AS n FROM numbered GROUP BY user_id, s)
        SELECT user_id, count(*) AS n_sessions, max(n) AS longest FROM sizes GROUP BY user_id""",
    "review_states": f"WITH {_LAST} SELECT event_type, count(*) AS n_cases FROM latest GROUP BY event_type",
}
