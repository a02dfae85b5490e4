"""DuckDB SQL for the corpus queries that SQL can express on whole tables."""

from __future__ import annotations

from auctionflow.llm.quality import CLASS_LIMIT, COMMON, WORD_LIMIT

# The words taken from a source follow from prefix sums in md5 order; targets level off at twice a source's size.  A document
# is first trained on (first_position, in millionths) when the integral of its source's schedule over three knots reaches
# the share of the words that come before.
OP4 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'text ' || text, '')) AS h
  FROM documents
), s AS (
  SELECT source, source_size, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS INT) + 1] AS DOUBLE) AS weight,
         CAST([[3, 1, 1], [1, 1, 1], [1, 1, 3]][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS INT) + 1] AS DOUBLE[]) AS knots
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source)
), r AS (
  SELECT 0 AS i, CAST((SELECT sum(source_size) FROM s) AS DOUBLE) * 1.5 / (SELECT sum(weight) FROM s) AS level
  UNION ALL
  SELECT i + 1, (CAST((SELECT sum(source_size) FROM s) AS DOUBLE) * 1.5
                 - coalesce((SELECT sum(2.0::DOUBLE * source_size) FROM s WHERE 2.0::DOUBLE * source_size < level * weight), 0))
                / (SELECT sum(weight) FROM s WHERE NOT 2.0::DOUBLE * source_size < level * weight)
  FROM r WHERE i < 64
), t AS (
  SELECT s.*, least(2.0::DOUBLE * source_size, (SELECT max(level) FROM r) * weight) AS target FROM s
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.knots, CAST(round(t.target) AS BIGINT) AS words,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), f AS (
  SELECT *, CAST((size > 0 AND words > before) AS BIGINT) + CAST((size > 0 AND words > before + source_size) AS BIGINT) AS n_copies,
         before / CAST(words AS DOUBLE) * ((knots[1] + knots[2]) / 2 + (knots[2] + knots[3]) / 2) AS area, (knots[1] + knots[2]) / 2 AS half
  FROM p
), g AS (
  SELECT *, CASE WHEN area < half THEN 0 ELSE 1 END AS seg, CASE WHEN area < half THEN area ELSE area - half END AS rest,
         CASE WHEN area < half THEN knots[1] ELSE knots[2] END AS a, CASE WHEN area < half THEN knots[2] ELSE knots[3] END AS b
  FROM f
)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, words - before)) + greatest(0, least(size, words - before - source_size)) AS BIGINT) AS taken, n_copies,
       CASE WHEN n_copies > 0 THEN CAST(round((seg + least(2 * rest / (a + sqrt(greatest(a * a + 2 * (b - a) * rest, 0))), 1)) / 2 * 1000000) AS BIGINT) END AS first_position
FROM g
"""

# Shares of character classes and common words against the sums of the language's longer documents.
OP5 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), tri AS (
  SELECT r, i, w[i:i+2] AS k FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM tri) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + j) AS n FROM twice, range(0, 3) AS x(j) GROUP BY r
), c AS (
  SELECT d.*, regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g') AS c0 FROM d
), c1 AS (SELECT *, regexp_replace(c0, '[a-z]+', '', 'g') AS a1 FROM c
), c2 AS (SELECT *, regexp_replace(a1, '[A-Z]+', '', 'g') AS a2 FROM c1
), c3 AS (SELECT *, regexp_replace(a2, '[0-9]+', '', 'g') AS a3 FROM c2
), c4 AS (SELECT *, regexp_replace(a3, '[#*$%&|<>]+', '', 'g') AS a4 FROM c3
), c5 AS (SELECT *, regexp_replace(a4, '[.,;:!?''\"()-]+', '', 'g') AS a5 FROM c4
), c6 AS (SELECT *, regexp_replace(a5, '\p{L}+', '', 'g') AS a6 FROM c5
), m AS (
  SELECT c6.r, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(c0) AS BIGINT) AS word_chars,
         CAST(length(a3) - length(a4) AS BIGINT) AS n_symbols,
         CAST(len([x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')])
              - len(list_distinct([x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')])) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(v.n, 0) AS BIGINT) AS n_repeat_words,
         [length(c0) - length(a1), length(a1) - length(a2), length(a2) - length(a3), length(a3) - length(a4),
          length(a4) - length(a5), length(a5) - length(a6), length(a6), length(t) - length(c0)] AS classes,
         [len([z FOR z IN low IF z = x]) FOR x IN COMMON_LISTS] AS hits
  FROM (SELECT *, [lower(y) FOR y IN w] AS low FROM c6) c6 LEFT JOIN covered v ON v.r = c6.r
), h AS (
  SELECT *, CASE WHEN len(hits) > 0 THEN list_append(hits, n_words - list_sum(hits)) ELSE hits END AS common FROM m
), bins AS (
  SELECT r, lang, n_words, 'c' AS kind, unnest(range(0, 8)) AS i, unnest(classes) AS n FROM h
  UNION ALL
  SELECT r, lang, n_words, 'w', unnest(range(0, CAST(len(common) AS BIGINT))), unnest(common) FROM h WHERE len(common) > 0
), p AS (
  SELECT *, n / CAST(sum(n) OVER (PARTITION BY r, kind) AS DOUBLE) AS share FROM bins
), q AS (
  SELECT lang, kind, i, sum(n) / CAST(sum(sum(n)) OVER (PARTITION BY lang, kind) AS DOUBLE) AS share
  FROM bins WHERE n_words >= 50 GROUP BY lang, kind, i
), js AS (
  SELECT p.r, p.kind, sqrt(greatest(sum(
    (CASE WHEN p.share > 0 THEN p.share * log2(2 * p.share / (p.share + q.share)) ELSE 0 END
     + CASE WHEN q.share > 0 THEN q.share * log2(2 * q.share / (p.share + q.share)) ELSE 0 END) / 2), 0)) AS x
  FROM p JOIN q USING (lang, kind, i) WHERE p.n_words >= CASE WHEN p.kind = 'c' THEN 50 ELSE 100 END
  GROUP BY p.r, p.kind
), far AS (
  SELECT DISTINCT r FROM js WHERE x > CASE WHEN kind = 'c' THEN CLASS_LIMIT ELSE WORD_LIMIT END
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND far.r IS NULL AS kept
FROM h LEFT JOIN far USING (r)
"""

OP6 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, w[i:i+2] AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM d
  UNION
  SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.other = edges.a
), least_ AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN least_ USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP8 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<turn><text></turn>') + length(replace(replace(role, '\', '\\'), '<', '\l'))
                + length(replace(replace(text, '\', '\\'), '<', '\l'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

OP9 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)
), least_ AS (
  SELECT k, min(doc_id) AS m FROM win GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, i + j AS i FROM win JOIN least_ USING (k), range(0, 13) AS x(j) WHERE doc_id > m
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)
"""

# CRC-32 byte by byte: a table of 256 remainders, by its rule, then one step a byte.
CRC_TABLE = r"""crc_steps AS (
  SELECT i AS n, i AS v, 0 AS k FROM range(0, 256) AS t(i)
  UNION ALL
  SELECT n, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM crc_steps WHERE k < 8
), crc_table AS (
  SELECT list(v ORDER BY n) AS tab FROM crc_steps WHERE k = 8
)"""


def _crc(codes: str) -> str:
    """The CRC-32 of a list of bytes, beside ``crc_table``."""
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)"


# Prefixes are compared as whole strings; subtree sums go from each node to the prefixes of its smallest member.
OP11 = r"""
WITH RECURSIVE CRC_TABLE, t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % 5 AS base, CRC % 9 AS h
  FROM (SELECT DISTINCT c FROM t), crc_table
), r AS (
  SELECT convs.c, 0 AS own, t.p, t.role, t.text FROM convs JOIN t ON t.c = convs.base AND t.p <= convs.h
  UNION ALL
  SELECT convs.c, 1, t.p, t.role, t.text FROM convs JOIN t ON t.c = convs.c AND t.p > convs.h
), o AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, p) AS d, text, length(role) || ':' || role || length(text) || ':' || text AS turn FROM r
), m AS (
  SELECT c, d, text, string_agg(turn, '') OVER (PARTITION BY c ORDER BY d) AS key FROM o
  UNION ALL
  SELECT c, 0, '', '' FROM convs
), e AS (
  SELECT *, d = max(d) OVER (PARTITION BY c) AS ends FROM m
), n AS (
  SELECT d, key, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * strlen(any_value(text)) AS saved,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM e GROUP BY d, key
), up AS (
  SELECT n.d, n.key, p.d AS pd, p.key AS pkey FROM n JOIN m ON m.c = n.conv_id AND m.d = n.d - 1 JOIN n p ON p.d = m.d AND p.key = m.key
), kids AS (
  SELECT pd AS d, pkey AS key, count(*) AS k FROM up GROUP BY pd, pkey
), w AS (
  SELECT n.*, coalesce(kids.k, 0) AS k FROM n LEFT JOIN kids USING (d, key)
), sums AS (
  SELECT m.d, m.key, sum(w.saved) AS saved, count(*) FILTER (WHERE w.k = 0) AS leaves
  FROM w JOIN m ON m.c = w.conv_id AND m.d <= w.d GROUP BY m.d, m.key
)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(w.n_convs AS BIGINT) AS n_convs, CAST(w.k AS BIGINT) AS n_children,
       CAST(sums.leaves AS BIGINT) AS n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens, w.ends_sha256
FROM w JOIN sums USING (d, key) LEFT JOIN up USING (d, key) LEFT JOIN n p ON p.d = up.pd AND p.key = up.pkey
"""

# Words one edit apart agree in what is left when one code point is taken out: of both at the same place, or of the longer only.
OP12 = r"""
WITH RECURSIVE CRC_TABLE, runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY ALL
), coded AS (
  SELECT run, n, [unicode(x) FOR x IN string_split(doc || ':' || run, '')] AS u FROM runs WHERE length(run) >= 5
), hashed AS (
  SELECT run, n, CRC AS h
  FROM (SELECT run, n, CAST(flatten([CASE WHEN x < 128 THEN [x] ELSE [192 + (x >> 6), 128 + (x & 63)] END FOR x IN u]) AS BIGINT[]) AS b FROM coded), crc_table
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)
), pairs AS (
  SELECT DISTINCT a.word AS x, b.word AS y FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word != b.word
  UNION
  SELECT DISTINCT v.word, cut.word FROM v JOIN cut ON cut.rest = v.word
  UNION
  SELECT DISTINCT cut.word, v.word FROM v JOIN cut ON cut.rest = v.word
), near AS (
  SELECT x AS word, count(*) AS n_near, arg_max(y, (v.n, z)) AS best, max(v.n) AS best_n
  FROM (SELECT x, y, -row_number() OVER (ORDER BY encode(y)) AS z FROM pairs) p JOIN v ON v.word = p.y GROUP BY x
), f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * v.n THEN best END AS form, CASE WHEN best_n >= 2 * v.n THEN best_n END AS form_n
  FROM v LEFT JOIN near USING (word)
), chain AS (
  SELECT word, word AS at, form FROM f
  UNION ALL
  SELECT chain.word, f.word, f.form FROM chain JOIN f ON f.word = chain.form
)
SELECT f.word, f.form, chain.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM f JOIN chain ON chain.word = f.word AND chain.form IS NULL
"""


def _op5() -> str:
    lists = "CASE lang " + " ".join(f"WHEN '{lang}' THEN [{', '.join(repr(w) for w in words)}]" for lang, words in COMMON.items()) + " ELSE [] END"
    return OP5.replace("COMMON_LISTS", lists).replace("CLASS_LIMIT", repr(CLASS_LIMIT)).replace("WORD_LIMIT", repr(WORD_LIMIT))


ORACLE: dict[str, str] = {
    "op4_curriculum_mix": OP4,
    "op5_divergence_quality": _op5(),
    "op6_similarity_sketch_dedup": OP6,
    "op8_offset_masks": OP8,
    "op9_lempel_ziv_substrings": OP9,
    "op11_prefix_trie": OP11.replace("CRC_TABLE", CRC_TABLE).replace("CRC", _crc("[CAST(unicode(x) AS BIGINT) FOR x IN string_split(CAST(c AS VARCHAR), '')]")),
    "op12_spelling_variants": OP12.replace("CRC_TABLE", CRC_TABLE).replace("CRC", _crc("b")),
}
