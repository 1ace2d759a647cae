"""DuckDB SQL of the queries that SQL can express.

Left out: main text and languages (learned), slots (a fold over the slot map),
disguised personal data (transducers), byte-level BPE, and the pipeline that is
made of them. Those are tested against brute force, round trips or held-out
accuracy instead.
"""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k FROM d, unnest(range(1, len(w) - 48)) AS t(i) WHERE len(w) >= 50),
least AS (SELECT k, min(doc_id) AS m FROM windows GROUP BY k),
repeats AS (SELECT doc_id, i FROM windows JOIN least USING (k) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM repeats, range(0, 50) AS t(j)),
words AS (SELECT doc_id, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP3 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM d, unnest(range(1, len(w) - 3)) AS t(i) WHERE len(w) >= 5
    UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4
),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, '  ' ORDER BY g)) AS whole FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT links.b, r FROM reach JOIN links ON links.a = reach.doc_id),
root AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id),
class AS (SELECT whole, min(doc_id) AS class_id FROM n GROUP BY whole)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, coalesce(class_id, d.doc_id) AS class_id
FROM d JOIN root USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN class USING (whole)
"""

_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP4 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, {_ALNUM}) AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all({LOWER}, {_ALNUM}) AS w FROM benchmark),
held AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g
         FROM item, unnest(range(1, greatest(len(w) - 8, 2))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM held),
placed AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i) WHERE len(w) >= n),
met AS (SELECT doc_id, item, i, placed.n FROM placed JOIN held ON held.g = placed.g AND held.n = placed.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM met) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP7 = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u AS a JOIN u AS b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a),
reach(vec_id, r) AS (SELECT vec_id, vec_id FROM v UNION SELECT links.b, r FROM reach JOIN links ON links.a = reach.vec_id),
root AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM root LEFT JOIN n USING (vec_id)
"""

_NIBBLE = "(strpos('0123456789abcdef', substr(h, CAST((5 * i) // 4 + {} AS INTEGER), 1)) - 1)"

OP9 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
last AS (SELECT body, max(page_id) AS m FROM p GROUP BY body),
x AS (SELECT page_id, body, m, sha1(body) AS h FROM p JOIN last USING (body))
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((({_NIBBLE.format(1)} * 16 + {_NIBBLE.format(2)}) >> CAST(3 - (5 * i) % 4 AS INTEGER)) & 31 AS INTEGER) + 1, 1) FOR i IN range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = m THEN NULL ELSE m END AS refers_to
FROM x
"""


OP11 = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS n FROM d GROUP BY t)
SELECT doc_id, keep_id, CAST(n AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""


OP12 = rf"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all({LOWER}, {_ALNUM})) AS t FROM documents),
item AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWER}, {_ALNUM})) AS t FROM benchmark),
tf AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY ALL),
size AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM size),
weight AS (SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, whole GROUP BY t, docs),
norm AS (SELECT doc_id, 100 - 50 + (50 * n * docs) // words AS m FROM size, whole),
score AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
          FROM item JOIN tf USING (t) JOIN weight USING (t) JOIN norm USING (doc_id) GROUP BY ALL),
placed AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM score WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 50
"""


def all_queries() -> dict[str, str]:
    return {"op1_substring_dedup": OP1, "op3_ngram_join": OP3, "op4_decontaminate": OP4, "op7_embedding_join": OP7, "op9_warc": OP9, "op11_exact_dedup": OP11, "op12_lexical_search": OP12}
