"""One query per operator, with production parameters over the whole intended table."""

from __future__ import annotations

from orderlens.llm.ann import op6_int8_block_neighbours
from orderlens.llm.bpe import op3_distinct_word_bpe
from orderlens.llm.byte_bpe import op12_rank_queue_bpe
from orderlens.llm.collocations import op13_phrase_collocations
from orderlens.llm.line_dedup import op5_fuzzy_line_dedup
from orderlens.llm.lm_score import op7_cross_entropy_difference
from orderlens.llm.near_dups import op4_setsketch_near_dups
from orderlens.llm.packing import op1_best_fit_packing
from orderlens.llm.prefix_trie import op11_prefix_trie
from orderlens.llm.quality_crf import op2_line_crf_quality
from orderlens.llm.quality_rules import op8_adaptive_rules
from orderlens.llm.sharding import op9_virtual_slots
from orderlens.llm.toxicity import op10_kneser_ney_toxicity

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_line_crf_quality": op2_line_crf_quality,
    "op3_distinct_word_bpe": op3_distinct_word_bpe,
    "op4_setsketch_near_dups": op4_setsketch_near_dups,
    "op5_fuzzy_line_dedup": op5_fuzzy_line_dedup,
    "op6_int8_block_neighbours": op6_int8_block_neighbours,
    "op7_cross_entropy_difference": op7_cross_entropy_difference,
    "op8_adaptive_rules": op8_adaptive_rules,
    "op9_virtual_slots": op9_virtual_slots,
    "op10_kneser_ney_toxicity": op10_kneser_ney_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_rank_queue_bpe": op12_rank_queue_bpe,
    "op13_phrase_collocations": op13_phrase_collocations,
}
# All pairs by an inverted index, components by recursion: for small tables only.
NEAR_DUPS_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT c.a, c.b FROM common c JOIN sets x ON c.a = x.doc_id JOIN sets y ON c.b = y.doc_id
  WHERE 100 * c.n >= 80 * (len(x.s) + len(y.s) - c.n)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON r.other = l.a),
smallest AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT s.doc_id, cast(len(s.s) AS BIGINT) AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept
FROM sets s JOIN smallest m ON s.doc_id = m.doc_id
"""

# All n-grams of all pieces, counted as text.
COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, cast(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM words CROSS JOIN (SELECT unnest(range(1, 6)) AS k)),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
cuts AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS c FROM candidates),
scores AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, t.n, c.c,
         cast((cast(1000 AS HUGEINT) * c.a * t.n) // (cast(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN totals t ON c.lang = t.lang
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.c], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.c + 1:c.k], ' ')),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_lengths AS (SELECT lang, a, w, k, unnest(range(2, k)) AS m FROM candidates),
inside AS (
  SELECT DISTINCT lang, a, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM inner_lengths),
left_over AS (SELECT s.* FROM lowest s ANTI JOIN inside i ON s.lang = i.lang AND s.phrase = i.phrase AND i.a >= s.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM left_over QUALIFY rank <= 2000
"""

# Prefixes as joined digests; a node's subtree is found through one member of each of its nodes.
PREFIX_TRIE_SQL = """
WITH turns AS (
  SELECT conv_id AS c, length(coalesce(text, '')) AS chars, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c, list_transform(string_split(cast(c AS VARCHAR), ''), lambda x: cast(ascii(x) AS BIGINT)) AS bytes FROM turns),
convs AS (
  SELECT c, c - c % 100 AS base,
         xor(list_reduce(list_concat([4294967295], bytes), lambda crc, byte:
               list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, step: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
             4294967295) % 6 AS h
  FROM ids),
rebuilt AS (
  SELECT v.c, 0 AS part, t.place, t.key, t.chars FROM convs v JOIN turns t ON t.c = v.base AND t.place <= v.h
  UNION ALL
  SELECT v.c, 1, t.place, t.key, t.chars FROM convs v JOIN turns t ON t.c = v.c AND t.place > v.h),
paths AS (
  SELECT v.c, coalesce(p.keys, []) AS keys, coalesce(p.lengths, []) AS lengths
  FROM convs v LEFT JOIN (SELECT c, list(key ORDER BY part, place) AS keys, list(chars ORDER BY part, place) AS lengths FROM rebuilt GROUP BY c) p ON v.c = p.c),
depths AS (SELECT c, keys, lengths, unnest(range(0, len(keys) + 1)) AS d FROM paths),
prefixes AS (
  SELECT c, d, len(keys) = d AS ends, coalesce(lengths[d], 0) AS chars,
         'k' || array_to_string(keys[1:d], ',') AS node, CASE WHEN d > 0 THEN 'k' || array_to_string(keys[1:d - 1], ',') END AS parent
  FROM depths),
nodes AS (
  SELECT node, d, parent, chars, count(*) AS n, min(c) AS c, coalesce(string_agg(cast(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '') AS members
  FROM prefixes GROUP BY node, d, parent, chars),
children AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY parent),
counted AS (SELECT x.*, coalesce(y.n, 0) AS n_children FROM nodes x LEFT JOIN children y ON x.node = y.node),
subtrees AS (
  SELECT a.node, cast(sum(CASE WHEN x.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, cast(sum((x.n - 1) * x.chars) AS BIGINT) AS saved_tokens
  FROM counted x JOIN prefixes a ON a.c = x.c AND a.d <= x.d GROUP BY a.node)
SELECT x.c AS conv_id, x.d AS depth, p.c AS parent_conv_id, x.n AS n_convs, x.n_children, s.n_leaves, s.saved_tokens, sha256(x.members) AS ends_sha256
FROM counted x JOIN subtrees s ON x.node = s.node LEFT JOIN nodes p ON x.parent = p.node
"""

ORACLES: dict[str, str] = {"op4_setsketch_near_dups": NEAR_DUPS_SQL, "op11_prefix_trie": PREFIX_TRIE_SQL, "op13_phrase_collocations": COLLOCATIONS_SQL}
