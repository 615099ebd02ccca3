"""DuckDB twins of the registered queries that SQL can express."""

# Words as the operators take them: runs of bytes other than space and 0x09 to 0x0D.
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

_CLASSES = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, other) AS (
    SELECT a, a FROM both_ways
    UNION
    SELECT r.id, b.b FROM reach r JOIN both_ways b ON b.a = r.other
),
least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
"""

OP1 = f"""
WITH RECURSIVE
vectors AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y
      ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.v) = len(y.v)
    WHERE list_cosine_similarity(x.v, y.v) >= 0.93
),
{_CLASSES},
counts AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT e.vec_id,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_links,
       coalesce(l.component_id, e.vec_id) AS component_id,
       coalesce(l.component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e
LEFT JOIN counts c ON c.a = e.vec_id
LEFT JOIN least l ON l.id = e.vec_id
"""

OP2 = f"""
WITH RECURSIVE
lowered AS (
    SELECT doc_id,
           {_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
    FROM documents
),
sets AS (
    SELECT doc_id,
           list_distinct(CASE
               WHEN len(w) >= 3 THEN list_transform(
                   generate_series(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
               WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
               ELSE CAST([] AS VARCHAR[]) END) AS s
    FROM lowered
),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
    SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS both_have
    FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id
     AND 10 * x.n >= 9 * y.n AND 10 * y.n >= 9 * x.n
    GROUP BY x.doc_id, y.doc_id
),
links AS (SELECT a, b FROM pairs WHERE 100 * both_have >= 90 * (na + nb - both_have)),
{_CLASSES},
counts AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
       coalesce(l.component_id, s.doc_id) AS component_id,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_links
FROM sets s LEFT JOIN least l ON l.id = s.doc_id LEFT JOIN counts c ON c.a = s.doc_id
"""

OP3 = """
WITH
bytes AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n
    FROM documents
),
windows AS (
    SELECT doc_id, i, substr(h, CAST(2 * i + 1 AS BIGINT), 100) AS w
    FROM (SELECT doc_id, h, unnest(generate_series(0, n - 50)) AS i FROM bytes WHERE n >= 50)
),
firsts AS (SELECT w, min(doc_id) AS first_doc FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)),
starts AS (
    SELECT v.doc_id, v.i FROM windows v JOIN firsts f ON f.w = v.w WHERE v.doc_id > f.first_doc
),
turns AS (
    SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM starts
),
runs AS (
    SELECT doc_id, i, sum(CASE WHEN gap <= 50 THEN 0 ELSE 1 END) OVER (
        PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run
    FROM turns
),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY doc_id, run),
kept AS (
    SELECT s.doc_id, string_agg(
               substr(y.h, CAST(2 * s.before + 1 AS BIGINT), CAST(2 * (s.a - s.before) AS BIGINT)), ''
               ORDER BY s.a) AS head,
           max(s.b) AS last_end, sum(s.b - s.a) AS n_removed, count(*) AS n_spans
    FROM (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans) s
    JOIN bytes y ON y.doc_id = s.doc_id
    GROUP BY s.doc_id
)
SELECT y.doc_id, CAST(y.n AS BIGINT) AS n_bytes,
       CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(k.n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(k.head, '') || substr(y.h, CAST(2 * coalesce(k.last_end, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM bytes y LEFT JOIN kept k ON k.doc_id = y.doc_id
"""

OP10 = f"""
WITH
texts AS (
    SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents
),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS g
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS i FROM texts WHERE len(w) >= 35)
),
often AS (SELECT g FROM windows GROUP BY g HAVING count(*) > 1),
gone AS (
    SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS pos
    FROM windows SEMI JOIN often ON windows.g = often.g
),
words AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS pos FROM texts),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS left_over, count(*) AS n
    FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.pos = gone.pos
    GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words,
       CAST(len(t.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.left_over, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON k.doc_id = t.doc_id
"""

OP13 = r"""
WITH
pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM words GROUP BY lang),
grams AS (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
    FROM (
        SELECT lang, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i
        FROM words, (VALUES (1), (2), (3), (4), (5)) AS lengths(m) WHERE len(w) >= m
    )
),
counts AS (
    SELECT lang, m, phrase, CAST(count(*) AS HUGEINT) AS a FROM grams
    GROUP BY lang, m, phrase HAVING count(*) >= 100
),
cuts AS (
    SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w, unnest(generate_series(1, m - 1)) AS k
    FROM counts WHERE m > 1
),
scores AS (
    SELECT c.lang, c.m, c.phrase, c.a, c.k, l.a AS l, r.a AS r, t.n, 1000 * c.a * t.n // (l.a * r.a) AS score
    FROM cuts c
    JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
    JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')
    JOIN totals t ON t.lang = c.lang
),
best AS (
    SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
inner_phrases AS (
    SELECT lang, a, array_to_string(w[i:i + s - 1], ' ') AS phrase
    FROM (
        SELECT lang, a, w, s, unnest(generate_series(1, m - s + 1)) AS i
        FROM (
            SELECT lang, m, a, string_split(phrase, ' ') AS w, unnest(generate_series(2, m - 1)) AS s
            FROM counts WHERE m > 2
        )
    )
),
longest AS (SELECT lang, phrase, max(a) AS longer FROM inner_phrases GROUP BY lang, phrase),
ranked AS (
    SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank
    FROM best b LEFT JOIN longest o ON o.lang = b.lang AND o.phrase = b.phrase
    WHERE o.longer IS NULL OR 100 * o.longer < 100 * b.a
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op1_projections": OP1,
    "op2_jaccard_join": OP2,
    "op3_suffix_array": OP3,
    "op10_suffix_trees": OP10,
    "op13_collocations": OP13,
}
