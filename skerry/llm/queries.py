"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from skerry.llm import (
    byte_bpe,
    decontaminate,
    infill,
    jaccard_forest,
    line_dedup,
    pii,
    secret_scan,
    suffix_dedup,
    token_counts,
    topk,
    toxicity,
    turns,
    warc,
)
from skerry.llm.shared import read_table

PSEUDONYM_KEY = "corpus-2024"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), cut=0.7)


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(read_table(spark, sf_dir, "embeddings"), factor=64)
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, k=20)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(read_table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(read_table(spark, sf_dir, "pages"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(docs, path, public_tokenizers.PATTERN)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(read_table(spark, sf_dir, "documents"), length=100)


def op9_jaccard_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_forest.near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_repeated_lines(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.restore(infill.fill_in_middle(read_table(spark, sf_dir, "documents"), infill.Plan(seed=7, share=100, suffix_first=50)))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair_turns(turns.damage(read_table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: value for name, value in list(globals().items()) if name.startswith("op")
}

# SHA-1 in base 32: five hex digits are four characters.
_BASE32 = """array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(h, CAST((j // 4) * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (j % 4) AS INT)) & 31 AS INT) + 1, 1)
    FOR j IN range(32)], '')"""

ORACLE_SQL: dict[str, str] = {
    "op4_topk": """
WITH v AS (SELECT vec_id, max(CAST([floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS BIGINT[])) AS z FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 GROUP BY vec_id),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.z AS DOUBLE[]), CAST(c.z AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.z) = len(q.z)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op6_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body)) AS n, sha1(body) AS h FROM p),
w AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
    CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM w""",
    "op10_decontaminate": r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM iw WHERE len(w) > 0)),
dg AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS g
    FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM win) ks WHERE len(w) >= k)),
hit AS (SELECT dg.doc_id, dg.i, win.k, win.item_id FROM dg JOIN win ON dg.k = win.k AND dg.g = win.g),
pos AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS l FROM hit GROUP BY doc_id),
hp AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit)),
runs AS (SELECT doc_id, min(p) AS a, max(p) AS b FROM (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS r FROM hp) GROUP BY doc_id, r),
sp AS (SELECT doc_id, string_agg(CAST(a - 1 AS VARCHAR) || ':' || CAST(b AS VARCHAR), ',' ORDER BY a) AS spans FROM runs GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(pos.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
    sha256(coalesce(its.l, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated, coalesce(spans, '') AS spans
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id) LEFT JOIN sp USING (doc_id)""",
    "op11_line_dedup": r"""
WITH l AS (SELECT doc_id, i, lines[i] AS line, translate(trim(lines[i], E'\t\n\x0b\x0c\r '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
k AS (SELECT key, min(doc_id) AS first FROM l WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT l.*, coalesce(l.doc_id <> k.first, FALSE) AS gone FROM l LEFT JOIN k USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op12_infill": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS l, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
r AS (SELECT doc_id, t, l, CAST('0x' || h[1:8] AS BIGINT) % (len(l) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(l) + 1) AS y,
    t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain, CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 AS spm FROM d),
c AS (SELECT *, array_to_string(l[1:least(x, y)], '') AS p, array_to_string(l[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(l[greatest(x, y) + 1:], '') AS s FROM r)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
    CASE WHEN NOT plain THEN length(p) END AS prefix_chars, CASE WHEN NOT plain THEN length(m) END AS middle_chars,
    sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM c""",
    # CRC-32 bit by bit; then every state of every conversation keeps its cheapest, least edits, row by row.
    "op13_turn_repair": r"""
WITH RECURSIVE d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(4294967295, list_reduce(
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda a, b: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(a, b)), CAST(4294967295 AS BIGINT))) % 20 AS lot
    FROM conversations),
e AS (SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role, unnest(CASE WHEN lot = 3 THEN [1, 2] ELSE [1] END) AS copy,
    CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM d WHERE lot <> 0),
f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, trim(text, E'\t\n\x0b\x0c\r ') AS bare FROM e),
g AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen, bare <> '' AND bare[-1] NOT IN ('.', '!', '?') AS unended,
    lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS former FROM f),
r AS (SELECT *, bare = '' OR seen AS must, CASE WHEN starts_with(role, 's') THEN 's' WHEN starts_with(role, 'u') THEN 'u' WHEN starts_with(role, 'a') THEN 'a' ELSE '-' END AS c FROM g),
t AS (SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (WHERE bare = '') AS blank,
    count(*) FILTER (WHERE bare <> '' AND seen) AS duplicate, count(*) FILTER (WHERE NOT must AND unended) AS truncated,
    count(*) FILTER (WHERE i > 1 AND former[1] || role[1] NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM r GROUP BY conv_id),
edge(q, c, p) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins(q, more, p, said) AS (VALUES (0, 0, 0, []), (1, 0, 1, []), (2, 0, 2, []), (3, 0, 3, []),
    (0, 1, 2, ['user:']), (1, 1, 2, ['user:']), (2, 1, 3, ['assistant:']), (3, 1, 2, ['user:']),
    (0, 2, 3, ['user:', 'assistant:']), (1, 2, 3, ['user:', 'assistant:'])),
w AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, p AS q, CAST(2 * more AS BIGINT) AS cost, repeat('I', more) AS audit, said AS body FROM t, ins WHERE ins.q = 0
    UNION ALL SELECT conv_id, i, q, cost, audit, body FROM (
        SELECT s.conv_id, s.i, ins.p AS q, s.cost + 2 * more AS cost, s.audit || repeat('I', more) AS audit, list_concat(s.body, said) AS body FROM (
            SELECT w.conv_id, r.i, w.q, w.cost + 3 AS cost, w.audit || 'D' AS audit, w.body FROM w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
            UNION ALL SELECT w.conv_id, r.i, edge.p, w.cost + CAST(unended AS INT), w.audit || 'K', list_append(w.body, role || ':' || text)
                FROM w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1 JOIN edge ON edge.q = w.q AND edge.c = r.c WHERE NOT must
            UNION ALL SELECT w.conv_id, r.i, x.p, w.cost + 2 + CAST(unended AS INT), w.audit || 'R', list_append(w.body, x.said[1] || text)
                FROM w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1 JOIN ins x ON x.q = w.q AND x.more = 1 WHERE NOT must) s
        JOIN ins ON ins.q = s.q)
    QUALIFY row_number() OVER (PARTITION BY conv_id, i, q ORDER BY cost, audit) = 1),
z AS (SELECT w.*, row_number() OVER (PARTITION BY w.conv_id ORDER BY cost, audit) AS best FROM w JOIN t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.n = w.i WHERE q IN (0, 3))
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(body, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
    LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM o.conv_id AND best = 1""",
}
