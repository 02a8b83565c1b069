"""SQL twins (DuckDB) of the queries that SQL can say whole; document ids are distinct there."""

from __future__ import annotations

QUALITY = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
p AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM w, LATERAL (SELECT unnest(range(1, len(w) - 1)) AS i)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM p) WHERE n > 1),
s AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(3) AS x(k) GROUP BY doc_id),
q AS (SELECT w.doc_id, source, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(s.n, 0) AS n_repeat_words FROM w LEFT JOIN s USING (doc_id)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM q),
h AS (SELECT source, count(*) AS nd, count(*) FILTER (base_failed) AS nf FROM j GROUP BY source),
m AS (SELECT sum(nf) / sum(nd) AS mean, greatest(0.0, sum(round(nd * (nf / nd) * (nf / nd) * 1e6)::BIGINT) / 1e6 / sum(nd) - (sum(nf) / sum(nd)) * (sum(nf) / sum(nd))) AS v FROM h),
z AS (SELECT mean, CASE WHEN v > 0 THEN least(1000.0, greatest(1.0, mean * (1 - mean) / v - 1)) ELSE 1000.0 END AS k FROM m),
x AS (SELECT source, (nf + k * mean) / (nd + k) AS rate FROM h, z)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, round(rate, 9) AS host_rate, rate > 0.75 AS host_rejected, NOT base_failed AND NOT rate > 0.75 AS kept
FROM j JOIN x ON j.source IS NOT DISTINCT FROM x.source
"""

NEAR = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i:i + 4] AS x FROM d, LATERAL (SELECT unnest(range(1, greatest(2, len(w) - 3))) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 85 * (na.n + nb.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)
"""

MIX = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 10))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w, 2 * source_size AS cap FROM s),
o AS (SELECT *, row_number() OVER k AS i, (SELECT sum(source_size) * 150 / 100 FROM w) - coalesce(sum(cap) OVER (k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_, (SELECT sum(w) FROM w) - coalesce(sum(w) OVER (k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight FROM w WINDOW k AS (ORDER BY cap / w, source NULLS LAST)),
f AS (SELECT coalesce(min(i) FILTER (NOT w * left_ / weight >= cap), 1000000000) AS first FROM o),
t AS (SELECT o.source, source_size, CASE WHEN i < first THEN cap::DOUBLE ELSE w * (SELECT any_value(left_)::DOUBLE FROM o, f WHERE i = first) / (SELECT any_value(weight)::DOUBLE FROM o, f WHERE i = first) END AS target FROM o, f),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM t),
q AS (SELECT *, target - passes * source_size AS rest FROM p),
g AS (SELECT source, h, sum(size) AS size FROM d WHERE size > 0 GROUP BY ALL),
u AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h) AS upto FROM g),
b AS (SELECT u.source, rest, arg_min(u.h, u.h) AS h, arg_min(upto, u.h) AS upto, arg_min(size, u.h) AS size FROM u JOIN q ON q.source IS NOT DISTINCT FROM u.source WHERE rest > 0 AND upto > rest GROUP BY ALL),
c AS (SELECT source, CASE WHEN upto - rest < rest - (upto - size) THEN h + 1 ELSE h END AS cut FROM b)
SELECT d.doc_id, d.size::BIGINT AS size, q.source_size, q.target, ((q.passes + coalesce(d.h < c.cut, false)::INT) * d.size)::BIGINT AS taken, (q.passes + coalesce(d.h < c.cut, false)::INT)::BIGINT AS copies
FROM d JOIN q ON q.source IS NOT DISTINCT FROM d.source LEFT JOIN c ON c.source IS NOT DISTINCT FROM d.source
"""

LEAKS = r"""
WITH k AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents, k),
b AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark, k),
p AS (SELECT DISTINCT item, w[i:i + 9] AS x FROM b, LATERAL (SELECT unnest(range(1, greatest(2, len(w) - 8))) AS i) WHERE len(w) > 0),
m AS (SELECT DISTINCT len(x) AS m FROM p),
v AS (SELECT doc_id, i, m, w[i:i + m - 1] AS x FROM d, m, LATERAL (SELECT unnest(range(1, len(w) - m + 2)) AS i)),
o AS (SELECT v.doc_id, v.i, v.m, p.item FROM v JOIN p ON p.x = v.x),
h AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM o, LATERAL (SELECT unnest(range(m)) AS j) GROUP BY doc_id),
a AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM o) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN h USING (doc_id) LEFT JOIN a USING (doc_id)
"""

NEAREST = r"""
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM e q JOIN e c ON q.vec_id % 100 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM p QUALIFY rank <= 10
"""

MANIFEST = r"""
WITH RECURSIVE b AS (SELECT row_number() OVER () AS r, doc_id, source, lang, n_chars, text AS t, replace(text, chr(10), '') AS u, doc_id::VARCHAR AS a FROM documents),
c AS (SELECT *, list_reduce([4294967295] || list_transform(string_split(a, ''), lambda x: ascii(x)::BIGINT), lambda c, x: list_reduce([xor(c, x)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))) % 2 = 1 AS even FROM b),
l AS (SELECT *, coalesce(strlen(a) || ':' || a, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head FROM c),
h AS (SELECT r, doc_id, source, sha256(head || coalesce(strlen(t) || ':' || t, '-')) AS leaf, CASE WHEN even THEN sha256(head || coalesce(strlen(u) || ':' || u, '-')) END AS shown FROM l),
k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i, count(*) OVER (PARTITION BY source) AS n, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM h),
up AS (SELECT s, 0 AS level, i, n, leaf AS h FROM k UNION ALL SELECT s, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY s, level, i // 3, n),
sub AS (SELECT s, h, level AS height FROM up WHERE n = 1),
top AS (SELECT 0 AS level, s AS i, (SELECT count(*) FROM sub) AS n, h FROM sub UNION ALL SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 3, n),
run AS (SELECT s, level, i // 3 AS p, list(h ORDER BY i) AS hs FROM up WHERE n > 1 GROUP BY ALL UNION ALL SELECT -1, level, i // 3, list(h ORDER BY i) FROM top WHERE n > 1 GROUP BY ALL),
walk AS (SELECT r, s, 0 AS level, i, n, false AS upper, coalesce(shown, leaf) AS f, '' AS proof FROM k
 UNION ALL SELECT w.r, w.s, CASE WHEN w.n = 1 THEN 0 ELSE w.level + 1 END, CASE WHEN w.n = 1 THEN w.s ELSE w.i // 3 END, CASE WHEN w.n = 1 THEN (SELECT count(*) FROM sub) ELSE (w.n + 2) // 3 END, w.upper OR w.n = 1,
 CASE WHEN w.n = 1 THEN w.f ELSE sha256(array_to_string(hs[:w.i % 3], '') || w.f || array_to_string(hs[w.i % 3 + 2:], '')) END, w.proof || CASE WHEN w.n = 1 THEN '' ELSE array_to_string(hs[:w.i % 3], '') || array_to_string(hs[w.i % 3 + 2:], '') END
 FROM walk w LEFT JOIN run ON run.s = CASE WHEN w.upper THEN -1 ELSE w.s END AND run.level = w.level AND run.p = w.i // 3 WHERE NOT (w.upper AND w.n = 1))
SELECT k.doc_id, k.leaf, sub.h AS subroot, root.h AS root, sha256(w.proof) AS proof_sha256, w.f AS folded_root, w.f = root.h AS verified FROM k JOIN sub USING (s) JOIN (SELECT h FROM top WHERE n = 1) root ON true JOIN walk w ON w.r = k.r AND w.upper AND w.n = 1
"""

MIDDLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (SELECT *, ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4 FROM d),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j, CASE WHEN n = 0 OR h3 % 100 >= 90 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(t, 1, i) AS a, substring(t, i + 1, j - i) AS b, substring(t, j + 1) AS c FROM f),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b ELSE '<S>' || c || '<P>' || a || '<M>' || b END AS output FROM p),
r AS (SELECT *, split_part(output, '<M>', 2) AS m, split_part(output, '<M>', 1)[4:] AS head FROM o)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN i END AS prefix_chars, CASE WHEN form <> 'plain' THEN j - i END AS middle_chars, sha256(output) AS output_sha256,
sha256(CASE form WHEN 'plain' THEN output WHEN 'psm' THEN split_part(head, '<S>', 1) || m || split_part(head, '<S>', 2) ELSE split_part(head, '<P>', 2) || m || split_part(head, '<P>', 1) END) AS restored_sha256 FROM r
"""

#: The others learn a model, run a tokenizer, or build on hashes and statistics beyond SQL; tests hold them against plain Python.
SQL = {"op1_quality_rules": QUALITY, "op2_minhash": NEAR, "op6_mixing": MIX, "op9_decontamination": LEAKS, "op11_metric_tree": NEAREST, "op12_merkle": MANIFEST, "op13_fill_in_middle": MIDDLE}
