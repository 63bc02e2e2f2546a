"""DuckDB SQL for the operators whose results SQL can express."""

from __future__ import annotations

LLM_ORACLE: dict[str, str] = {}

_CONTROL = r"[<\[]\\*(?:/?s>|/?INST\]|</?SYS>>)"

LLM_ORACLE["op10_chat_formatting"] = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         length('<s>') + length(role) + 1 + length(text) + length('</s>')
           + length(regexp_extract_all(text, '{_CONTROL}')) AS chars
  FROM rows
), said AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY k) AS told,
         coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '') AS loss, sum(chars)::BIGINT AS chars
  FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       chars AS formatted_chars, true AS identical
FROM said
"""

_ITEM_WORDS = (
    "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

LLM_ORACLE["op7_decontamination"] = f"""
WITH items AS (SELECT item_id, {_ITEM_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM items WHERE len(w) > 0)
), docs AS (SELECT doc_id, {_ITEM_WORDS.format("coalesce(text, '')")} AS w FROM documents),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), hits AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, phrase)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

LLM_ORACLE["op9_substring_dedup"] = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)
), repeated AS (
  SELECT doc_id, i FROM windows JOIN (SELECT h, min(doc_id) AS least FROM windows GROUP BY h) USING (h) WHERE doc_id > least
), gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM repeated),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs) ANTI JOIN gone USING (doc_id, p)
  GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LLM_ORACLE["op11_line_dedup"] = rf"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS p FROM split),
keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), '{_UPPER}', '{_LOWER}') AS key
  FROM lines
), common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT keyed.*, common.key IS NOT NULL AS gone FROM keyed LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


# a bit at a time: a character's code goes in, then eight shifts (marked -1)
_CRC32 = (
    "xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),"
    " lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),"
    " lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, 3988292384::BIGINT * (acc & 1)) END))"
)

LLM_ORACLE["op12_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf('n_chars')} AS leaf,
         CASE WHEN {_CRC32} % 7 = 0 THEN {_leaf('n_chars + 1')} END AS other
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves
), low AS (
  SELECT tree, 0 AS level, place, leaf AS digest, count(*) OVER (PARTITION BY tree) AS total FROM placed
  UNION ALL
  SELECT tree, any_value(level) + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (any_value(total) + 1) // 2
  FROM low WHERE total > 1 GROUP BY tree, place // 2
), roots AS (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS number FROM low WHERE total = 1
), high AS (
  SELECT 0 AS level, number AS place, subroot AS digest, count(*) OVER () AS total FROM roots
  UNION ALL
  SELECT any_value(level) + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (any_value(total) + 1) // 2
  FROM high WHERE total > 1 GROUP BY place // 2
), steps AS (
  SELECT p.doc_id, p.leaf, n.level AS k, n.digest AS sibling, n.place % 2 = 0 AS before
  FROM placed p JOIN low n ON n.tree = p.tree AND n.total > 1 AND n.place = xor(p.place >> n.level, 1)
  UNION ALL
  SELECT p.doc_id, p.leaf, 1000 + n.level, n.digest, n.place % 2 = 0
  FROM placed p JOIN roots r USING (tree) JOIN high n ON n.total > 1 AND n.place = xor(r.number >> n.level, 1)
), heights AS (
  SELECT tree, max(level) AS low_levels, (SELECT max(level) FROM high) AS high_levels FROM low GROUP BY tree
), proofs AS (
  SELECT doc_id, leaf, string_agg(sibling, '' ORDER BY k) AS proof FROM steps GROUP BY doc_id, leaf
), folds AS (
  SELECT doc_id, leaf, tree, 0 AS k, coalesce(other, leaf) AS digest FROM placed
  UNION ALL
  SELECT f.doc_id, f.leaf, f.tree, f.k + 1,
         CASE WHEN s.sibling IS NULL THEN sha256(f.digest) WHEN s.before THEN sha256(s.sibling || f.digest) ELSE sha256(f.digest || s.sibling) END
  FROM folds f JOIN heights h USING (tree)
  LEFT JOIN steps s ON s.doc_id = f.doc_id AND s.leaf = f.leaf
    AND s.k = CASE WHEN f.k < h.low_levels THEN f.k ELSE 1000 + f.k - h.low_levels END
  WHERE f.k < h.low_levels + h.high_levels
), ends AS (
  SELECT f.doc_id, f.leaf, f.digest FROM folds f JOIN heights h USING (tree) WHERE f.k = h.low_levels + h.high_levels
)
SELECT p.doc_id, p.leaf, r.subroot, (SELECT digest FROM high WHERE total = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
       e.digest AS folded_root, e.digest = (SELECT digest FROM high WHERE total = 1) AS verified
FROM placed p JOIN roots r USING (tree) JOIN ends e USING (doc_id, leaf) LEFT JOIN proofs USING (doc_id, leaf)
"""

LLM_ORACLE["op13_phrase_mining"] = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM starts, (SELECT unnest([1, 2, 3]) AS m) WHERE i + m - 1 <= len(w) GROUP BY ALL
), sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE m = 1 GROUP BY lang),
often AS (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE f >= 10),
cuts AS (SELECT lang, phrase, w, f AS a, unnest(range(1, m)) AS k FROM often WHERE m > 1),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r,
         (1000000::HUGEINT * c.a * c.a // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts c JOIN often l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN often r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, part AS phrase, max(f) AS most
  FROM (SELECT lang, f, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM often WHERE m = 3)
  GROUP BY ALL
), ranked AS (
  SELECT c.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest c LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
