"""SQL for DuckDB with the same results, where SQL can express them."""

from __future__ import annotations

OP9 = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, replace(replace(text, '\', '\\'), '<|', '\<|') AS guarded,
    CASE lag(role) OVER w WHEN 'system' THEN 'briefed' WHEN 'user' THEN 'asked'
      WHEN 'assistant' THEN 'answered' END AS state,
    row_number() OVER w AS n, row_number() OVER b AS back
  FROM rows_
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text),
    b AS (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC)
), ruled AS (
  SELECT *, CASE
      WHEN n = 1 THEN role IN ('system', 'user')
      WHEN state = 'briefed' THEN role = 'user' AND n = 2
      WHEN state = 'asked' THEN role = 'assistant'
      WHEN state = 'answered' THEN role = 'user'
      ELSE false END AND (back > 1 OR role = 'assistant') AS fits
  FROM marked
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|turn|>' || role || chr(10) || guarded || '<|end|>' || chr(10)))::BIGINT
    AS formatted_chars,
  bool_and(fits) AS valid
FROM ruled GROUP BY conv_id
"""


OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e)::BIGINT AS score
  FROM v q, v WHERE q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id, score FROM s
QUALIFY rank <= 20
"""

OP5 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3
    THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w
), t AS (SELECT doc_id, len(g) AS n, unnest(g) AS s FROM g),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a
)
SELECT g.doc_id, coalesce(len(g.g), 0)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM g JOIN r ON g.doc_id = r.a GROUP BY g.doc_id, g.g
"""

OP11 = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), firsts AS (SELECT x, min(doc_id) AS first FROM t GROUP BY x),
d AS (
  SELECT t.doc_id, part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 2 * length(x))::INT
    + 8 * regexp_matches(x, '[#$%&*|]')::INT + 16 * coalesce(t.doc_id > first, false)::INT AS fails
  FROM t JOIN firsts USING (x)
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), c AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM d LEFT JOIN l USING (doc_id) GROUP BY part, fails
), f AS (SELECT chr((65 + i)::INT) AS f, (1 << i)::INT AS bit FROM range(5) r(i)),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
    AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), steps AS (
  SELECT filter_order, k::INT AS step, bits[k] AS bit, coalesce(list_sum(bits[1:k - 1]), 0)::INT AS before
  FROM orders, range(1, 6) r(k)
), each AS (
  SELECT part, filter_order, step, bit,
    sum(n) FILTER (fails & (bit | before) = 0) AS kept,
    sum(n) FILTER (fails & bit > 0 AND fails & before = 0) AS removed,
    sum(n) FILTER (fails & bit > 0 AND fails & before > 0) AS redundant,
    sum(n) FILTER (fails = bit) AS unique_fails,
    sum(good) FILTER (fails & bit > 0 AND fails & before = 0) AS good_lost,
    sum(toxic) FILTER (fails & bit > 0 AND fails & before = 0) AS toxic_lost
  FROM c, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM each
"""

OP12 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS body,
    coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS changed,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)),
        lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) AS crc
  FROM documents
), leaf AS (
  SELECT row_number() OVER () AS id, doc_id, tree, sha256(head || body) AS leaf,
    sha256(head || CASE WHEN crc % 3 = 0 THEN changed ELSE body END) AS altered,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, sha256(head || body)) - 1 AS place,
    count(*) OVER (PARTITION BY tree) AS n
  FROM d
), low(level, tree, place, n, h) AS (
  SELECT 0, tree, place, n, leaf FROM leaf
  UNION ALL
  SELECT level + 1, tree, place // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY place))
  FROM low WHERE n > 1 GROUP BY level, tree, place // 8, n
), tops AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM low WHERE n = 1
), high(level, place, n, h) AS (
  SELECT 0, place, n, h FROM tops
  UNION ALL
  SELECT level + 1, place // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY place))
  FROM high WHERE n > 1 GROUP BY level, place // 8, n
), runs AS (
  SELECT false AS upper, tree, level, place // 8 AS run, string_agg(h, '' ORDER BY place) AS h FROM low
  WHERE n > 1 GROUP BY tree, level, place // 8
  UNION ALL
  SELECT true, '', level, place // 8, string_agg(h, '' ORDER BY place) FROM high WHERE n > 1 GROUP BY level, place // 8
), way(id, tree, level, place, siblings, folded) AS (
  SELECT id, tree, 0, place, '', altered FROM leaf
  UNION ALL
  SELECT id, w.tree, w.level + 1, w.place // 8,
    siblings || r.h[1:64 * (w.place % 8)] || r.h[64 * (w.place % 8) + 65:],
    sha256(r.h[1:64 * (w.place % 8)] || folded || r.h[64 * (w.place % 8) + 65:])
  FROM way w JOIN runs r ON NOT r.upper AND r.tree = w.tree AND r.level = w.level AND r.run = w.place // 8
), half AS (
  SELECT id, any_value(tree) AS tree, arg_max(siblings, level) AS siblings, arg_max(folded, level) AS folded
  FROM way GROUP BY id
), rest(id, level, place, siblings, folded) AS (
  SELECT id, 0, place, siblings, folded FROM half JOIN tops USING (tree)
  UNION ALL
  SELECT id, w.level + 1, w.place // 8,
    siblings || r.h[1:64 * (w.place % 8)] || r.h[64 * (w.place % 8) + 65:],
    sha256(r.h[1:64 * (w.place % 8)] || folded || r.h[64 * (w.place % 8) + 65:])
  FROM rest w JOIN runs r ON r.upper AND r.level = w.level AND r.run = w.place // 8
), ends AS (
  SELECT id, arg_max(siblings, level) AS siblings, arg_max(folded, level) AS folded FROM rest GROUP BY id
)
SELECT doc_id, leaf, tops.h AS subroot, (SELECT h FROM high WHERE n = 1) AS root,
  sha256(siblings) AS proof_sha256, folded AS folded_root,
  folded = (SELECT h FROM high WHERE n = 1) AS verified
FROM leaf JOIN ends USING (id) JOIN tops USING (tree)
"""


def all_oracles() -> dict[str, str]:
    return {
        "op1_top_k": OP1,
        "op5_ngram_jaccard": OP5,
        "op9_chat_format": OP9,
        "op11_filter_audit": OP11,
        "op12_merkle_manifest": OP12,
    }
