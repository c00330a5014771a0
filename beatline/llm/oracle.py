"""DuckDB twins of the queries that SQL can express and run on whole tables.

The others hash, score, pack, tokenize or decode in ways that are not SQL;
``tests/llm`` holds them against brute-force versions.
"""

from __future__ import annotations

_BLANK = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _low(text: str) -> str:
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


_OP2 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), {_BLANK}) AS w
           FROM documents),
win AS (SELECT rid, doc_id, p, array_to_string(w[p:p + 12], ' ') AS s
        FROM (SELECT *, unnest(range(1, len(w) - 11)) AS p FROM d)),
least AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
gone AS (SELECT DISTINCT rid, unnest(range(p, p + 13)) AS q FROM win JOIN least USING (s) WHERE m < doc_id),
words AS (SELECT rid, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS q FROM d),
kept AS (SELECT rid, string_agg(x, ' ' ORDER BY q) AS t, count(*) AS n
         FROM words ANTI JOIN gone USING (rid, q) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)"""

_OP4 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_low('text')}, {_ALNUM}) AS w FROM documents),
it AS (SELECT item_id, w, least(len(w), 10) AS k
       FROM (SELECT item_id, regexp_extract_all({_low('text')}, {_ALNUM}) AS w FROM benchmark WHERE item_id IS NOT NULL)
       WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS s
       FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM it)),
dw AS (SELECT rid, p, k, array_to_string(w[p:p + k - 1], ' ') AS s
       FROM (SELECT d.rid, d.w, z.k, unnest(range(1, len(d.w) - z.k + 2)) AS p
             FROM d CROSS JOIN (SELECT DISTINCT k FROM iw) z)),
hits AS (SELECT rid, p, k, item_id FROM dw JOIN iw USING (k, s)),
hit_words AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest(range(p, p + k)) AS q FROM hits) GROUP BY rid),
hit_items AS (SELECT rid, count(*) AS n, string_agg(i, ',' ORDER BY i) AS names
              FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
       sha256(coalesce(i.names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words h USING (rid) LEFT JOIN hit_items i USING (rid)"""

_OP6 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_low('text')}, {_BLANK}) AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS p FROM d)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
          GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
          WHERE 100 * i >= 80 * (p.n + q.n - i)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x AS doc_id, min(y) AS m FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
FROM d LEFT JOIN size USING (doc_id) LEFT JOIN least USING (doc_id)"""

#: A SHA-1 is 40 hex digits, so 32 base32 digits: 5 hex digits make 4 of them.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, {5 * part + 1}, 5) AS INT) >> {shift}) & 31), 1)"
    for part in range(8) for shift in (15, 10, 5, 0))
_OP9 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT html, max(page_id) AS largest FROM p GROUP BY html)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < largest THEN largest END AS refers_to
FROM p JOIN g USING (html)"""

def _op11() -> str:
    """Each round is a pair of tables: ``a`` (assignment) and ``c`` (centroids).
    Squares of whole numbers are exact in doubles below 2^53."""
    near = """(SELECT v.*, c, (ss - 2 * list_inner_product(x, z) + zz) AS dist FROM v CROSS JOIN
  (SELECT c, z, list_inner_product(z, z) AS zz FROM c{r}))"""
    parts = ["""
v AS MATERIALIZED (SELECT vec_id, rid, x, list_inner_product(x, x) AS ss FROM (
  SELECT vec_id, row_number() OVER () AS rid, [floor(1024 * CAST(e AS DOUBLE)) FOR e IN embedding] AS x FROM embeddings
  WHERE len(embedding) = 64 AND len([e FOR e IN embedding IF e IS NOT NULL AND isfinite(e)]) = 64)),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, x AS z FROM v
  WHERE vec_id IS NOT NULL ORDER BY sha256('3:' || vec_id) LIMIT 8)"""]
    for r in range(11):
        parts.append(f"""
a{r} AS MATERIALIZED (SELECT vec_id, rid, x, arg_min(c, (dist, c)) AS c, min(dist) AS dist FROM {near.format(r=r)} GROUP BY ALL)""")
        if r < 10:
            parts.append(f"""
c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m.z, o.z) AS z FROM c{r} o LEFT JOIN
  (SELECT c, list(m ORDER BY d) AS z FROM (SELECT c, d, floor(sum(e) / count(*)) AS m FROM
    (SELECT c, unnest(x) AS e, unnest(range(64)) AS d FROM a{r}) GROUP BY c, d) GROUP BY c) m USING (c))""")
    return "WITH " + ",".join(parts) + """
SELECT vec_id, CAST(c AS INT) AS cluster, CAST(dist AS BIGINT) AS distance,
       CAST(sum(dist) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(dist) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string([CAST(CAST(e AS BIGINT) AS VARCHAR) FOR e IN z], ',')) AS centroid_sha256
FROM a10 JOIN c10 USING (c)"""


_OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_low('text')}, {_ALNUM}) AS w FROM documents),
tf AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(w) AS t FROM d) GROUP BY rid, t),
size AS (SELECT count(*) AS n, sum(len(w)) AS l FROM d WHERE len(w) > 0),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
q AS (SELECT qid, item_id, t, count(*) AS times FROM
      (SELECT row_number() OVER () AS qid, item_id, unnest(regexp_extract_all({_low('text')}, {_ALNUM})) AS t FROM benchmark) GROUP BY ALL),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, size),
norm AS (SELECT rid, doc_id, CAST(25 + (75 * len(w) * n) // l AS BIGINT) AS m FROM d, size WHERE len(w) > 0),
scored AS (SELECT qid, item_id, doc_id, rid, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS score
           FROM q JOIN weight USING (t) JOIN tf USING (t) JOIN norm USING (rid) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id, rid) AS r FROM scored WHERE score > 0)
SELECT item_id, CAST(r AS INT) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE r <= 10"""

ORACLE: dict[str, str] = {
    "op2_substring_dedup": _OP2,
    "op4_decontamination": _OP4,
    "op6_jaccard_join": _OP6,
    "op9_warc": _OP9,
    "op11_centroid_clustering": _op11(),
    "op12_lexical_search": _OP12,
}
