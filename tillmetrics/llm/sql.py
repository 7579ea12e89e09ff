"""DuckDB SQL for the results of the queries that SQL can express."""

OP1 = r"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT vec_id AS node, vec_id AS root FROM embeddings
  UNION
  SELECT p.b, r.root FROM reach r JOIN pairs p ON p.a = r.node
), roots AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
SELECT e.vec_id, (SELECT count(*) FROM pairs p WHERE p.a = e.vec_id) AS n_links, r.component_id,
  e.vec_id = r.component_id AS kept
FROM embeddings e JOIN roots r ON r.node = e.vec_id
"""

OP2 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL
), sets AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
    lambda i: array_to_string(w[i:i + 4], ' ')))) AS s FROM words WHERE len(w) > 0
), classes AS (
  SELECT s, min(doc_id) AS rep, count(*) AS copies FROM sets GROUP BY s
), tokens AS (SELECT rep, len(s) AS n, copies, unnest(s) AS t FROM classes),
pairs AS (
  SELECT a.rep AS a, b.rep AS b, any_value(b.copies) AS copies
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.rep <> b.rep
  GROUP BY a.rep, b.rep, a.n, b.n
  HAVING count(*) * 10 >= 8 * (a.n + b.n - count(*))
), reach AS (
  SELECT rep AS node, rep AS root FROM classes
  UNION
  SELECT p.b, r.root FROM reach r JOIN pairs p ON p.a = r.node
), roots AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node),
links AS (SELECT a, sum(copies) AS links FROM pairs GROUP BY a),
found AS (
  SELECT s.doc_id, c.rep AS class_id, CAST(coalesce(l.links, 0) + c.copies - 1 AS BIGINT) AS n_links, r.component_id
  FROM sets s JOIN classes c ON s.s = c.s JOIN roots r ON r.node = c.rep LEFT JOIN links l ON l.a = c.rep
)
SELECT d.doc_id, coalesce(f.class_id, d.doc_id) AS class_id, coalesce(f.n_links, 0) AS n_links,
  coalesce(f.component_id, d.doc_id) AS component_id, d.doc_id = coalesce(f.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN found f ON f.doc_id = d.doc_id
"""

OP5 = r"""
WITH p AS (
  SELECT page_id, sha1(coalesce(html, '')) AS h, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
), f AS (SELECT h, payload_bytes, min(page_id) AS first FROM p GROUP BY ALL)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT) >> (5 * (3 - i % 4))) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, true AS digest_ok
FROM p JOIN f USING (h, payload_bytes)
"""

OP8 = r"""
WITH base AS (
  SELECT conv_id, turn, role, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations WHERE conv_id IS NOT NULL
), people AS (
  SELECT DISTINCT conv_id, role AS perspective FROM base WHERE role IS NOT NULL AND role <> 'system'
), seg AS (
  SELECT conv_id, perspective, turn, role, text, coalesce(role = perspective, false) AS own,
    CASE WHEN coalesce(role = perspective, false) THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>'
      ELSE '<|user name=' || replace(coalesce(role, 'unknown'), '<|', '< |') || '|>' END || chr(10) || text || '<|end|>' || chr(10) AS s
  FROM base JOIN people USING (conv_id)
), placed AS (
  SELECT *, sum(length(s)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, role NULLS FIRST, text
    ROWS UNBOUNDED PRECEDING) - length(s) AS start,
    CASE WHEN own THEN length(text) + 8 ELSE 0 END AS loss
  FROM seg
)
SELECT conv_id, perspective, count(*) AS n_segments, CAST(sum(length(s)) AS BIGINT) AS n_chars,
  CAST(sum(loss) AS BIGINT) AS n_loss_chars,
  CAST(sum(CAST('0x' || substr(md5(start::VARCHAR || '|' || loss::VARCHAR || '|' || s), 1, 8) AS BIGINT)) AS BIGINT) AS checksum
FROM placed GROUP BY conv_id, perspective
"""

OP9 = r"""
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents WHERE text IS NOT NULL
), spread AS (
  SELECT trim(line, ' ' || chr(9) || chr(13)) AS bare, min(doc_id) AS first_doc FROM lines
  GROUP BY 1 HAVING count(DISTINCT source) >= 5 AND length(bare) > 0
), parts AS (
  SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
    unnest(string_split(text, chr(10))) AS line FROM documents
), judged AS (
  SELECT p.doc_id, p.pos, p.line, s.bare IS NOT NULL AS gone
  FROM parts p LEFT JOIN spread s
    ON trim(p.line, ' ' || chr(9) || chr(13)) = s.bare AND p.doc_id <> s.first_doc
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
  md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS text_md5
FROM judged GROUP BY doc_id
"""

#: A repeat of 8 words or more covers what repeated 8-word windows cover, and the
#: longest repeat is over L words if and only if a window of L + 1 words is found twice.
OP10 = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), sizes AS (
  SELECT doc_id, w, CAST(floor(least(50, greatest(8, CAST(0.04 AS DOUBLE) * len(w)))) AS INTEGER) + 1 AS over FROM base
), windows AS (
  SELECT doc_id, kind, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, unnest([5, 8, 0]) AS kind, unnest([5, 8, over]) AS k FROM sizes),
    LATERAL (SELECT unnest(range(1, len(w) - k + 2)) AS i)
), twice AS (
  SELECT doc_id, kind, k, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, kind, win) AS c FROM windows) WHERE c > 1
), cover AS (
  SELECT doc_id, kind, count(DISTINCT p) AS n FROM (SELECT doc_id, kind, unnest(range(i, i + k)) AS p FROM twice) GROUP BY 1, 2
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM base)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1
), counted AS (
  SELECT b.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(l.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c5.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(c8.n, 0) AS BIGINT) AS covered_words, c0.n IS NOT NULL AS too_long
  FROM base b LEFT JOIN lines l USING (doc_id)
  LEFT JOIN cover c5 ON c5.doc_id = b.doc_id AND c5.kind = 5
  LEFT JOIN cover c8 ON c8.doc_id = b.doc_id AND c8.kind = 8
  LEFT JOIN cover c0 ON c0.doc_id = b.doc_id AND c0.kind = 0
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND covered_words <= CAST(0.1 AS DOUBLE) * n_words
    AND NOT too_long AS kept
FROM counted
"""



def _op12(k: int = 8, rounds: int = 10) -> str:
    """Every round as two steps: a{t} assigns the vectors to the centroids c{t}, c{t+1} replaces them."""
    steps = [
        r"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
)""",
        r"""parts AS MATERIALIZED (SELECT r, unnest(range(1, 65)) AS i, unnest(v) AS x FROM kept)""",
        f"""starts AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)) NULLS LAST, v) - 1 AS c, v FROM kept
  QUALIFY c < {k}
)""",
        r"""c0 AS MATERIALIZED (SELECT c, unnest(range(1, 65)) AS i, unnest(v) AS x FROM starts)""",
    ]
    for t in range(rounds + 1):
        steps.append(
            f"""a{t} AS MATERIALIZED (
  SELECT r, arg_min(c, d * {k} + c) AS c, min(d) AS d FROM (
    SELECT p.r, q.c, CAST(sum((p.x - q.x) * (p.x - q.x)) AS BIGINT) AS d
    FROM parts p JOIN c{t} q ON p.i = q.i GROUP BY p.r, q.c)
  GROUP BY r
)"""
        )
        if t < rounds:
            steps.append(
                f"""c{t + 1} AS MATERIALIZED (
  SELECT o.c, o.i, coalesce(m.x, o.x) AS x FROM c{t} o LEFT JOIN (
    SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x
    FROM (SELECT a.c, p.i, sum(p.x) AS s, count(*) AS n FROM a{t} a JOIN parts p ON a.r = p.r GROUP BY a.c, p.i)
  ) m ON m.c = o.c AND m.i = o.i
)"""
            )
    return (
        "WITH "
        + ", ".join(steps)
        + f""", shas AS (
  SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c
)
SELECT k.vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, s.centroid_sha256
FROM kept k JOIN a{rounds} a ON a.r = k.r JOIN shas s ON s.c = a.c"""
    )


SQL = {
    "op1_embedding_near_dedup": OP1,
    "op2_ngram_jaccard_join": OP2,
    "op5_warc": OP5,
    "op8_chat_formatting": OP8,
    "op9_line_dedup": OP9,
    "op10_quality_rules": OP10,
    "op12_centroid_clustering": _op12(),
}
