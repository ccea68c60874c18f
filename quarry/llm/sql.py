"""DuckDB text for the queries that SQL can express; written apart from the operators."""

WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD_LIST = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP3 = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 10
"""

OP6 = f"""
WITH w AS (
    SELECT doc_id, coalesce(text, '') AS text, {WORD_LIST} AS words FROM documents),
lines AS (
    SELECT doc_id, line, count(*) AS n
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id, line),
dup AS (SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines FROM lines GROUP BY doc_id),
grams AS (
    SELECT doc_id, i, list_aggregate(words[i:i + 7], 'string_agg', ' ') AS gram
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
again AS (
    SELECT doc_id, i FROM grams JOIN (SELECT doc_id, gram FROM grams GROUP BY ALL HAVING count(*) > 1) USING (doc_id, gram)),
covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM again, range(0, 8) t(k) GROUP BY doc_id),
m AS (
    SELECT w.doc_id, len(words)::BIGINT AS n_words,
           coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
           (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS n_stutter,
           (length(text) - length(regexp_replace(text, '\\p{{Lu}}', '', 'g'))) AS n_capitals, length(text) AS n_chars
    FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       n_words >= 20 AND 100 * n_repeat_words <= 30 * n_words AND word_chars BETWEEN 2 * n_words AND 15 * n_words
           AND 100 * n_symbols <= 30 * n_words AND 100 * n_capitals <= 50 * n_chars AND 8 * n_dup_lines <= n_words AND 100 * n_stutter <= 30 * n_words AS kept
FROM m
"""

OP7 = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(string_split_regex({FOLD.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, list_aggregate(words[i:i + 4], 'string_agg', ' ') AS gram
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
    SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (
    SELECT doc_id AS id, doc_id AS root FROM documents
    UNION
    SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.id),
root AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN root ON root.id = d.doc_id LEFT JOIN size ON size.doc_id = d.doc_id
"""

OP10 = f"""
WITH parts AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (
    SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS pos FROM parts),
k AS (SELECT *, {FOLD.format(f"trim(line, {WS})")} AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT k.*, f.first IS NOT NULL AND k.doc_id > f.first AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP11 = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex({FOLD.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
w AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM pieces),
grams AS (
    SELECT lang, m, list_aggregate(words[i:i + m - 1], 'string_agg', ' ') AS phrase
    FROM (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM w, range(1, 5) t(m) WHERE len(words) >= m)),
f AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE m > 1 AND f >= 30),
inner_parts AS (
    SELECT DISTINCT lang, list_aggregate(words[i:i + k - 1], 'string_agg', ' ') AS phrase, a AS longer
    FROM (SELECT *, unnest(range(1, m - k + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS k FROM cand WHERE m > 2))),
dropped AS (
    SELECT DISTINCT c.lang, c.phrase FROM cand c JOIN inner_parts p USING (lang, phrase) WHERE 100 * p.longer::HUGEINT >= 80 * c.a::HUGEINT),
cuts AS (
    SELECT lang, phrase, a, k, list_aggregate(words[1:k], 'string_agg', ' ') AS head, list_aggregate(words[k + 1:m], 'string_agg', ' ') AS tail
    FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.tail),
best AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS p FROM scored) WHERE p = 1),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM best ANTI JOIN dropped USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

SQL = {"op3_exact_topk": OP3, "op6_quality_rules": OP6, "op7_minhash_dedup": OP7, "op10_line_dedup": OP10,
       "op11_phrase_collocations": OP11}
