"""DuckDB SQL for the text queries that SQL can express."""

ORACLE = {
    "op2_mixing": r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  md5(concat_ws(':', 'mix-1', CAST(doc_id AS VARCHAR))) AS spot FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight
      FROM d GROUP BY source),
c AS (SELECT *, source_size * CAST(2.0 AS DOUBLE) AS cap, CAST(1.5 AS DOUBLE) * sum(source_size) OVER () AS total FROM s),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
f AS (SELECT max(level) FILTER (WHERE k = 1) AS level FROM (
        SELECT level, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS k FROM l WHERE level * weight < cap)),
t AS (SELECT source, source_size, CASE WHEN f.level IS NULL THEN cap ELSE least(cap, f.level * weight) END AS target FROM l, f),
w AS (SELECT *, CAST(round(target) AS BIGINT) AS words,
             CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS whole FROM t),
p AS (SELECT d.*, w.source_size, w.target, w.whole, w.words - w.whole * w.source_size AS rest,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY spot, doc_id NULLS LAST, size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
      FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source)
SELECT doc_id, size, source_size, target, CAST(whole * size + greatest(0, least(size, rest - place)) AS BIGINT) AS taken FROM p
""",
    "op3_exact_dedup": r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT norm, count(*) AS group_size, first(doc_id ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g USING (norm)
""",
    "op11_repetition": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT r, doc_id, t, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
             regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
w AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM l),
h2 AS (SELECT *, md5(w || ' ' || lead(w) OVER (PARTITION BY r ORDER BY i)) AS a2,
              md5(w || ' ' || lead(w) OVER (PARTITION BY r ORDER BY i) || ' ' || lead(w, 2) OVER (PARTITION BY r ORDER BY i)) AS a3 FROM w),
h4 AS (SELECT r, i, a3, md5(a2 || lead(a2, 2) OVER (PARTITION BY r ORDER BY i)) AS x FROM h2),
h8 AS (SELECT r, i, a3, md5(x || lead(x, 4) OVER (PARTITION BY r ORDER BY i)) AS x FROM h4),
h16 AS (SELECT r, i, a3, md5(x || lead(x, 8) OVER (PARTITION BY r ORDER BY i)) AS a16 FROM h8),
h32 AS (SELECT r, i, a3, a16, md5(a16 || lead(a16, 16) OVER (PARTITION BY r ORDER BY i)) AS x FROM h16),
h64 AS (SELECT r, i, a3, a16, md5(x || lead(x, 32) OVER (PARTITION BY r ORDER BY i)) AS x FROM h32),
h128 AS (SELECT r, i, a3, a16, md5(x || lead(x, 64) OVER (PARTITION BY r ORDER BY i)) AS a128 FROM h64),
f AS (SELECT r, i, a3 IS NOT NULL AND count(*) OVER (PARTITION BY r, a3) > 1 AS f3,
             a16 IS NOT NULL AND count(*) OVER (PARTITION BY r, a16) > 1 AS f16,
             a128 IS NOT NULL AND count(*) OVER (PARTITION BY r, a128) > 1 AS f128 FROM h128),
c AS (SELECT r, max(f3::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c3,
             max(f16::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 15 PRECEDING AND CURRENT ROW) AS c16, f128 FROM f),
g AS (SELECT r, CAST(sum(c3) AS BIGINT) AS c3, CAST(sum(c16) AS BIGINT) AS c16, bool_or(f128) AS longer FROM c GROUP BY r),
o AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(c3, 0) AS n_repeat_words,
             coalesce(c16, 0) AS covered_words, coalesce(longer, false) AS longer FROM l LEFT JOIN g USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * covered_words > 30 * n_words OR longer) AS kept FROM o
""",
    "op12_hyperplane_tree": r"""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
             CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
       AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
""",
    "op13_best_position": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
b AS (SELECT row_number() OVER () AS k, item_id, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark),
i AS (SELECT DISTINCT k, item_id, term FROM (SELECT k, item_id, unnest(ts) AS term FROM b)),
z AS (SELECT CAST(count(*) AS BIGINT) AS nd, CAST(sum(len(ts)) AS BIGINT) AS l FROM d WHERE len(ts) > 0),
u AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(ts) AS term FROM d)
      WHERE term IN (SELECT term FROM i) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM u, z GROUP BY term, nd),
m AS (SELECT r, doc_id, 100 - 50 + ((50 * CAST(len(ts) AS BIGINT) * nd) // l) AS m FROM d, z WHERE len(ts) > 0),
x AS (SELECT u.r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS impact FROM u JOIN w USING (term) JOIN m USING (r)),
s AS (SELECT k, item_id, r, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM i JOIN x USING (term) GROUP BY k, item_id, r, doc_id),
t AS (SELECT item_id, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST, r) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM t WHERE rank <= 50
""",
}
