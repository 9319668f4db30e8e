"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

# Words of a text, as the result contracts cut them.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP6_MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
    substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(md5(text), 'null')), 1, 15) AS h
  FROM documents
), sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, 3 * source_size AS cap,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sums
), steps AS (
  SELECT *, cap / CAST(weight AS DOUBLE) AS ratio,
    (SELECT sum(source_size) FROM sums) AS total,
    coalesce(sum(cap) OVER earlier, 0) AS capped,
    sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS free
  FROM weighted
  WINDOW earlier AS (ORDER BY cap / CAST(weight AS DOUBLE), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT CAST(total - capped AS DOUBLE) / CAST(free AS DOUBLE) AS lam FROM steps
  WHERE CAST(total - capped AS DOUBLE) / CAST(free AS DOUBLE) <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1
), targets AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), weight * lam) AS target FROM weighted, level
), parts AS (
  SELECT *, CAST(CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS INTEGER) AS whole FROM targets
), units AS (
  SELECT source, h, sum(size) AS unit FROM sized GROUP BY source, h
), summed AS (
  SELECT *, sum(unit) OVER (PARTITION BY source ORDER BY h) AS upto FROM units
), taken AS (
  SELECT p.source, h, whole < 3 AND (
    upto <= target - whole * source_size
    OR (upto - unit <= target - whole * source_size AND 2 * (target - whole * source_size - (upto - unit)) > unit)) AS extra
  FROM summed s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT d.doc_id, d.source, d.size, p.source_size, p.target,
  CAST(p.whole + CAST(t.extra AS INTEGER) AS INTEGER) AS copies,
  CAST(d.size * (p.whole + CAST(t.extra AS INTEGER)) AS BIGINT) AS taken
FROM sized d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
JOIN taken t ON d.source IS NOT DISTINCT FROM t.source AND d.h = t.h
"""

OP5_LINES = r"""
WITH docs AS (
  SELECT doc_id, text, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS lines FROM documents
), placed AS (
  SELECT doc_id, p, content, len(regexp_extract_all(content, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT doc_id, unnest(lines) AS content, unnest(range(0, len(lines))) AS p FROM docs)
), pairs AS (
  SELECT l.doc_id, l.p, l.words, e.doc_id AS of_doc, l.p - e.p AS shift
  FROM placed l JOIN placed e ON l.content = e.content AND (e.doc_id < l.doc_id OR (e.doc_id = l.doc_id AND e.p < l.p))
), islands AS (
  SELECT *, p - row_number() OVER (PARTITION BY doc_id, of_doc, shift ORDER BY p) AS island FROM pairs
), runs AS (
  SELECT doc_id, min(p) AS a, max(p) + 1 AS b FROM islands GROUP BY doc_id, of_doc, shift, island HAVING sum(words) >= 10
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(a, b)) AS line FROM runs
), numbered AS (
  SELECT doc_id, text, lines, unnest(range(0, greatest(len(lines), 1))) AS line FROM docs
), flagged AS (
  SELECT n.doc_id, n.text, n.line, n.lines[n.line + 1] AS content, g.line IS NOT NULL AS goes, len(n.lines) AS n_lines,
    g.line IS NOT NULL AND coalesce(NOT lag(g.line IS NOT NULL) OVER (PARTITION BY n.doc_id ORDER BY n.line), true) AS opens
  FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.line = g.line
)
SELECT doc_id, CAST(max(n_lines) AS BIGINT) AS n_lines, CAST(sum(CAST(goes AS BIGINT)) AS BIGINT) AS n_removed,
  CAST(sum(CAST(opens AS BIGINT)) AS BIGINT) AS n_runs,
  CASE WHEN bool_or(text IS NULL) THEN NULL
    ELSE sha256(coalesce(string_agg(content, chr(10) ORDER BY line) FILTER (WHERE NOT goes), '')) END AS kept_sha256
FROM flagged GROUP BY doc_id
"""

OP1_DECONTAMINATION = r"""
WITH items AS (
  SELECT DISTINCT item_id, words, len(words) AS n
  FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words FROM benchmark) WHERE len(words) >= 5
), item_shingles AS (
  SELECT item_id, words, n, array_to_string(words[p + 1 : p + 5], ' ') AS s, p
  FROM (SELECT *, unnest(range(0, n - 4)) AS p FROM items)
), item_bags AS (
  SELECT *, row_number() OVER (PARTITION BY item_id, words, s ORDER BY p) AS nth FROM item_shingles
), docs AS (
  SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words FROM documents WHERE text IS NOT NULL
), shingles AS (
  SELECT doc_id, len(words) AS n, p, array_to_string(words[p + 1 : p + 5], ' ') AS s
  FROM (SELECT *, unnest(range(0, len(words) - 4)) AS p FROM docs WHERE len(words) >= 5)
), hits AS (
  SELECT DISTINCT h.doc_id, h.n, h.p, i.item_id, i.words, i.n AS length
  FROM shingles h JOIN item_shingles i ON h.s = i.s
), windows AS (
  SELECT DISTINCT doc_id, item_id, words, length, unnest(range(
    greatest(0, least(p - length + 5, n - length)), greatest(0, least(p, n - length)) + 1)) AS start
  FROM hits
), bags AS (
  SELECT w.doc_id, w.item_id, w.words, w.length, w.start, h.s,
    row_number() OVER (PARTITION BY w.doc_id, w.item_id, w.words, w.start, h.s ORDER BY h.p) AS nth,
    count(*) OVER (PARTITION BY w.doc_id, w.item_id, w.words, w.start) AS size
  FROM windows w JOIN shingles h ON w.doc_id = h.doc_id AND h.p BETWEEN w.start AND w.start + w.length - 5
), shared AS (
  SELECT b.doc_id, b.item_id, b.words, b.length, b.start, max(b.size) AS size, count(*) AS common
  FROM bags b JOIN item_bags i ON b.item_id = i.item_id AND b.words = i.words AND b.s = i.s AND b.nth = i.nth
  GROUP BY ALL
), scored AS (
  SELECT doc_id, item_id, start, max(CAST(common AS DOUBLE) / CAST(size + length - 4 - common AS DOUBLE)) AS similarity, max(length) AS length
  FROM shared WHERE CAST(common AS DOUBLE) / CAST(size + length - 4 - common AS DOUBLE) >= 0.8
  GROUP BY doc_id, item_id, start
)
SELECT doc_id, item_id, max(similarity) AS similarity,
  CAST(arg_min(start, [-similarity, start]) AS INTEGER) AS start_word,
  CAST(arg_min(length, [-similarity, start]) AS INTEGER) AS n_words, count(*) AS n_windows
FROM scored GROUP BY doc_id, item_id
"""

OP2_WINDOWS = f"""
WITH docs AS (
  SELECT doc_id, {WORDS} AS w FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(w[s + 1 : s + 20], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 19)) AS s FROM docs WHERE len(w) >= 20)
), repeated AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS nth FROM windows) WHERE nth > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM repeated
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS p FROM docs
), kept AS (
  SELECT x.doc_id, count(g.p) AS n_removed, string_agg(word, ' ' ORDER BY x.p) FILTER (WHERE g.p IS NULL) AS text
  FROM words x LEFT JOIN gone g ON x.doc_id = g.doc_id AND x.p = g.p GROUP BY x.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

OP3_MINHASH = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(0, len(w) - 2), lambda i: array_to_string(w[i + 1 : i + 3], ' ')) END) AS shingles
  FROM docs
), long AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS s FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
  FROM long a JOIN long b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM pairs WHERE 100 * k >= 85 * (na + nb - k)
), reach AS (
  SELECT doc_id, doc_id AS r FROM docs UNION SELECT l.b, reach.r FROM reach JOIN links l ON l.a = reach.doc_id
)
SELECT d.doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, min(r) AS component_id, min(r) = d.doc_id AS kept
FROM sets d JOIN reach ON reach.doc_id = d.doc_id GROUP BY d.doc_id, shingles
"""

OP9_SUFFIXES = """
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), strings AS (
  SELECT doc_id, s, md5(substr(h, 2 * s + 1, 400)) AS k
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS s FROM docs WHERE len(h) >= 400)
), repeated AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, count(*) OVER (PARTITION BY k) AS n FROM strings) WHERE n > 1
), opened AS (
  SELECT *, CASE WHEN s > lag(s) OVER w + 200 OR lag(s) OVER w IS NULL THEN 1 ELSE 0 END AS opens
  FROM repeated WINDOW w AS (PARTITION BY doc_id ORDER BY s)
), numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM opened
), runs AS (
  SELECT doc_id, min(s) AS a, max(s) + 200 AS b FROM numbered GROUP BY doc_id, run
), pieces AS (
  SELECT r.doc_id, a, b, substr(h, 2 * coalesce(lag(b) OVER w, 0) + 1, 2 * (a - coalesce(lag(b) OVER w, 0))) AS piece
  FROM runs r JOIN docs d ON r.doc_id = d.doc_id WINDOW w AS (PARTITION BY r.doc_id ORDER BY a)
), kept AS (
  SELECT doc_id, string_agg(piece, '' ORDER BY a) AS pieces, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last FROM pieces GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(pieces, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

# Components that take part: none null or not finite.
WHOLE = """len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0"""

OP11_TOPK = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS w
  FROM embeddings WHERE vec_id IS NOT NULL AND {WHOLE}
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.w, d.w) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP12_NEGATIVES = f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS w
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {WHOLE}
), scored AS (
  SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same, CAST(list_inner_product(a.w, d.w) AS BIGINT) AS score
  FROM v a JOIN v d ON a.vec_id <> d.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
    AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""

OP13_SPELLING = """
WITH RECURSIVE runs AS (
  SELECT id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00c0-\u00ff]+')) AS run
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, text FROM documents WHERE text IS NOT NULL)
), counted AS (
  SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY id, run
), hashed AS (
  SELECT run, n, 4294967295 - list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(0, 4 * length(hex)), lambda k: CAST(
      ((strpos('0123456789ABCDEF', substr(hex, 2 * (k // 8) + 2 - (k % 8) // 4, 1)) - 1) >> (k % 4)) & 1 AS BIGINT))),
    lambda c, bit: xor(c >> 1, 3988292384 * (xor(c, bit) & 1))) AS h
  FROM (SELECT run, n, hex(encode(id || ':' || run)) AS hex FROM counted)
), changed AS (
  SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word
  FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), shorter AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
), near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
), forms AS (
  SELECT word, count(*) AS n_near, arg_min(other, struct_pack(a := -other_n, b := other)) AS form, max(other_n) AS form_n, any_value(n) AS n
  FROM near GROUP BY word
), valid AS (
  SELECT word, form FROM forms WHERE form_n >= 10 * n
), chains AS (
  SELECT word, word AS root, 0 AS steps FROM words
  UNION ALL SELECT c.word, v.form, steps + 1 FROM chains c JOIN valid v ON c.root = v.word
), ends AS (
  SELECT word, arg_max(root, steps) AS root FROM chains GROUP BY word
)
SELECT w.word, CASE WHEN form_n >= 10 * w.n THEN form END AS form, e.root, w.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
  CASE WHEN form_n >= 10 * w.n THEN form_n END AS form_n
FROM words w JOIN ends e ON w.word = e.word LEFT JOIN forms f ON w.word = f.word
"""

ORACLES = {
    "op1_decontamination": OP1_DECONTAMINATION, "op2_windows": OP2_WINDOWS, "op3_minhash": OP3_MINHASH, "op5_lines": OP5_LINES,
    "op6_mixing": OP6_MIXING, "op9_suffixes": OP9_SUFFIXES,
    "op11_topk": OP11_TOPK, "op12_negatives": OP12_NEGATIVES, "op13_spelling": OP13_SPELLING,
}
