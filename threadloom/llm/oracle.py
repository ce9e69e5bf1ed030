"""DuckDB SQL of the queries that SQL can express."""

# The contracts' white space.
_STRIP = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WS = r"[\x20\x09-\x0D]"
_WORDS = rf"list_filter(regexp_split_to_array(coalesce(text, ''), '{_WS}+'), lambda w: w <> '')"
# CRC-32 of a decimal number, unsigned, bit by bit over its characters.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR))::VARCHAR || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


ORACLE = {
    "op3_line_dedup": f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, i, ls[i] AS line, translate(trim(ls[i], {_STRIP}),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
          FROM docs, unnest(generate_series(1, len(ls))) AS g(i)),
frequent AS (SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN frequent f ON l.k = f.k GROUP BY doc_id""",
    "op5_exact_dedup": f"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS cp,
                  regexp_replace(coalesce(text, ''), '{_WS}', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm ORDER BY cp DESC, doc_id)""",
    "op7_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS w FROM d, unnest(generate_series(1, len(ws) - 12)) AS g(i)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) AS first FROM win) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM dup, unnest(generate_series(0, 12)) AS h(j)),
word AS (SELECT doc_id, p, ws[p] AS word FROM d, unnest(generate_series(1, len(ws))) AS g(p))
SELECT d.doc_id, any_value(len(ws))::BIGINT AS n_words, count(g.p) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY w.p) FILTER (WHERE g.p IS NULL), '')) AS kept_sha256
FROM d LEFT JOIN word w USING (doc_id) LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.p = w.p
GROUP BY d.doc_id""",
    "op6_topk_search": """
WITH v AS (SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT q.row, q.vec_id AS query_id, c.row AS other, c.vec_id,
                  coalesce(list_sum(list_transform(generate_series(1, least(len(q.v), len(c.v))), lambda i: q.v[i] * c.v[i])), 0)::BIGINT AS score
           FROM v q JOIN v c ON c.row <> q.row WHERE q.vec_id % 50 = 0),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST, other)::INTEGER AS rank, vec_id, score FROM scores)
SELECT * FROM ranked WHERE rank <= 5""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE leaf AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
           dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t
    FROM (SELECT doc_id, lang, {_leaf('text')} AS h,
                 CASE WHEN {_CRC32} % 3 = 0 THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS forged
          FROM documents)),
node AS (
    SELECT t, 0 AS lv, i, h, n FROM leaf
    UNION ALL
    SELECT t, lv + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM node WHERE n > 1 GROUP BY t, lv, i // 8, n),
top AS (
    SELECT 0 AS lv, t AS i, h, (SELECT count(*) FROM node WHERE n = 1) AS n FROM node WHERE n = 1
    UNION ALL
    SELECT lv + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY lv, i // 8, n),
path AS (
    SELECT t, i, 0 AS lv, i AS pos, n AS m, false AS up, h, forged FROM leaf
    UNION ALL
    SELECT t, i, CASE WHEN m > 1 THEN lv + 1 WHEN up THEN lv + 1 ELSE 0 END, CASE WHEN m > 1 THEN pos // 8 ELSE t END,
           CASE WHEN m > 1 THEN (m + 7) // 8 ELSE (SELECT max(n) FROM top) END, up OR m = 1, h, forged
    FROM path WHERE m > 1 OR NOT up),
sibling AS (
    SELECT p.t, p.i, p.up, p.lv, coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (WHERE s.i < p.pos), '') AS l,
           coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (WHERE s.i > p.pos), '') AS r
    FROM path p JOIN (SELECT t, lv, i, h, false AS up FROM node UNION ALL SELECT NULL, lv, i, h, true FROM top) s
      ON s.up = p.up AND s.lv = p.lv AND s.i // 8 = p.pos // 8 AND (p.up OR s.t = p.t)
    WHERE p.m > 1 GROUP BY ALL),
proof AS (SELECT t, i, list([l, r] ORDER BY up, lv) AS steps FROM sibling GROUP BY t, i)
SELECT doc_id, leaf.h AS leaf, sub.h AS subroot, root.h AS root, sha256(array_to_string(flatten(coalesce(steps, [])), '')) AS proof_sha256,
       list_reduce(list_prepend([coalesce(forged, leaf.h), ''], coalesce(steps, [])), lambda x, s: [sha256(s[1] || x[1] || s[2]), ''])[1] AS folded_root,
       folded_root = root.h AS verified
FROM leaf LEFT JOIN proof USING (t, i) JOIN (SELECT t, h FROM node WHERE n = 1) sub USING (t), (SELECT h FROM top WHERE n = 1) root""",
    "op12_periodic_runs": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws, coalesce({_CRC32}, 1) AS h FROM documents),
e AS (SELECT doc_id, row_number() OVER () AS row, h, h // 10 AS g, ws, len(ws) AS n, (h // 10) % greatest(len(ws), 1) AS a FROM d),
f AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM e),
word AS (SELECT row, i, CASE WHEN h % 10 = 0 AND i >= a THEN ws[1 + a + (i - a) % p] ELSE ws[1 + i] END AS w
         FROM f, unnest(generate_series(0, n - 1)) AS u(i)),
same AS (SELECT x.row, x.i, y.i - x.i AS q FROM word x JOIN word y ON x.row = y.row AND x.w = y.w AND y.i > x.i),
island AS (SELECT row, q, min(i) AS start, count(*) + q AS length
           FROM (SELECT *, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS k FROM same) GROUP BY row, q, k),
run AS (SELECT row, start, length, min(q) AS period FROM island WHERE length >= greatest(6, 4 * q) GROUP BY row, start, length),
best AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY length DESC, start, period) AS nth FROM run),
lines AS (SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS txt FROM run GROUP BY row),
gone AS (SELECT DISTINCT row, i FROM run, unnest(generate_series(start + period, start + length - 1)) AS u(i)),
kept AS (SELECT row, string_agg(w, ' ' ORDER BY i) AS txt FROM word ANTI JOIN gone USING (row, i) GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, (1000 * length) // period AS exponent_milli,
       sha256(coalesce(lines.txt, '')) AS runs_sha256, sha256(coalesce(kept.txt, '')) AS collapsed_sha256
FROM f LEFT JOIN (FROM best WHERE nth = 1) USING (row) LEFT JOIN lines USING (row) LEFT JOIN kept USING (row)""",
}
