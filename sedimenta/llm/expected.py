"""DuckDB SQL for the results of registered queries that SQL can state."""

#: CRC-32 (unsigned) of the decimal text of {0}, as a number.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT)"""


def _crc(column: str) -> str:
    return _CRC.format(column)


#: The escape of control strings: one more backslash after the first character.
_LESS = r"<(\\*(?:s>|/s>|\|im_start\|>|\|im_end\|>|\|user\|>|\|assistant\|>|\|system\|>|\|end\|>|\|endoftext\|>))"
_SQUARE = r"\[(\\*(?:INST\]|/INST\]|SYS\]|/SYS\]|ROLE\]|/ROLE\]))"


def _escaped(column: str) -> str:
    return rf"regexp_replace(regexp_replace({column}, '{_LESS}', '<\\\1', 'g'), '{_SQUARE}', '[\\\1', 'g')"


OP11 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
said AS (
  SELECT *, role || chr(10) || text || chr(10) AS line, {_escaped('text')} AS inside, {_escaped('role')} AS named,
    CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 17 ELSE 20 END AS marks
  FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(line, '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(marks + length(inside) + CASE WHEN marks = 20 THEN length(named) ELSE 0 END) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"


_ROW = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))

OP12 = f"""
WITH RECURSIVE tampered AS (
  SELECT *, CASE WHEN doc_id IS NOT NULL AND {_crc('doc_id')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS later
  FROM documents),
leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, sha256({_ROW} || {_field('text')}) AS leaf, sha256({_ROW} || {_field('later')}) AS seen
  FROM tampered),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
nodes AS (
  SELECT g, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY g) AS n FROM placed
  UNION ALL
  SELECT g, level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM nodes WHERE n > 1
  GROUP BY g, level, pos // 3, n),
subroots AS (SELECT g, level AS height, digest AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos FROM nodes WHERE n = 1),
uppers AS (
  SELECT 0 AS level, pos, subroot AS digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM uppers WHERE n > 1
  GROUP BY level, pos // 3, n),
steps AS (  -- the path of every leaf: its place on each level of both trees
  SELECT p.g, p.pos AS leaf_pos, t.level, p.pos // CAST(3 ** t.level AS BIGINT) AS at, s.height, s.pos AS top_pos
  FROM placed p JOIN subroots s USING (g), unnest(range(s.height)) AS t(level)),
upper_steps AS (
  SELECT s.g, t.level, s.pos // CAST(3 ** t.level AS BIGINT) AS at FROM subroots s, unnest(range((SELECT max(level) FROM uppers))) AS t(level)),
entries AS (
  SELECT s.g, s.leaf_pos, s.level, coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (o.pos < s.at), '') AS l,
    coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (o.pos > s.at), '') AS r
  FROM steps s JOIN nodes o ON o.g = s.g AND o.level = s.level AND o.pos // 3 = s.at // 3 GROUP BY ALL),
upper_entries AS (
  SELECT s.g, s.level, coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (o.pos < s.at), '') AS l,
    coalesce(string_agg(o.digest, '' ORDER BY o.pos) FILTER (o.pos > s.at), '') AS r
  FROM upper_steps s JOIN uppers o ON o.level = s.level AND o.pos // 3 = s.at // 3 GROUP BY ALL),
low AS (SELECT g, leaf_pos AS pos, list({{'l': l, 'r': r}} ORDER BY level) AS w FROM entries GROUP BY ALL),
high AS (SELECT g, list({{'l': l, 'r': r}} ORDER BY level) AS w FROM upper_entries GROUP BY ALL),
proofs AS (
  SELECT p.doc_id, p.leaf, p.seen, s.subroot, list_concat(coalesce(low.w, []), coalesce(high.w, [])) AS w
  FROM placed p JOIN subroots s USING (g) LEFT JOIN low ON low.g = p.g AND low.pos = p.pos LEFT JOIN high ON high.g = p.g),
folded AS (
  SELECT doc_id, leaf, subroot, (SELECT digest FROM uppers WHERE n = 1) AS root,
    sha256(list_aggregate(list_prepend('', list_transform(w, lambda e: e.l || e.r)), 'string_agg', '')) AS proof_sha256,
    list_reduce(list_prepend({{'l': seen, 'r': ''}}, w), lambda a, e: {{'l': sha256(e.l || a.l || e.r), 'r': ''}}).l AS folded_root
  FROM proofs)
SELECT *, folded_root = root AS verified FROM folded"""

OP13 = f"""
WITH turns AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, coalesce(text, '') AS text, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS code,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
      sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc('conv_id')} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
parts AS (
  SELECT c.conv_id, 0 AS part, t.place, t.code, strlen(t.text) AS n FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.place, t.code, strlen(t.text) FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h),
prefixes AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(code, '') OVER w AS prefix, n FROM parts
  WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)
  UNION ALL SELECT conv_id, 0, '', 0 FROM convs),
ends AS (SELECT conv_id, arg_max(prefix, depth) AS prefix FROM prefixes GROUP BY conv_id),
ended AS (SELECT prefix, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids FROM ends GROUP BY prefix),
nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) AS bytes, left(prefix, CAST(64 * (depth - 1) AS BIGINT)) AS above
  FROM prefixes GROUP BY prefix, depth),
children AS (SELECT above AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY above),
figured AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (prefix)),
summed AS (
  SELECT left(prefix, CAST(64 * t.d AS BIGINT)) AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
  FROM figured, unnest(range(depth + 1)) AS t(d) GROUP BY 1)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
  sha256(coalesce(e.ids, '')) AS ends_sha256
FROM figured f JOIN summed s USING (prefix) LEFT JOIN ended e USING (prefix)
LEFT JOIN nodes p ON f.depth > 0 AND p.prefix = f.above"""

#: Components of {links} (a, b) over the ids of {nodes} (id): the least id that an id reaches.
_REACH = """
both_ways AS (SELECT a, b FROM {links} UNION SELECT b, a FROM {links}),
reach AS (SELECT id, id AS seen FROM {nodes} UNION SELECT l.b, r.seen FROM reach r JOIN both_ways l ON l.a = r.id),
components AS (SELECT id, min(seen) AS component FROM reach GROUP BY id)"""

OP3 = """
WITH RECURSIVE vectors AS (
  SELECT CAST(vec_id AS BIGINT) AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
valid AS (
  SELECT id, v FROM vectors WHERE id IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
near AS (
  SELECT a.id AS a, b.id AS b FROM valid a JOIN valid b ON a.id < b.id AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) / (sqrt(list_inner_product(a.v, a.v)) * sqrt(list_inner_product(b.v, b.v))) >= 0.9),""" + _REACH.format(
    links="near", nodes="valid") + """,
degrees AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY a)
SELECT v.id AS vec_id, coalesce(d.n, 0) AS n_links, coalesce(c.component, v.id) AS component_id, v.id = coalesce(c.component, v.id) AS kept
FROM vectors v LEFT JOIN components c USING (id) LEFT JOIN degrees d USING (id)"""

_WORDS = r"""regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP6 = f"""
WITH RECURSIVE worded AS (
  SELECT CAST(doc_id AS BIGINT) AS id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
shingles AS (
  SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM worded),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
pairs AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.g = y.g AND x.id < y.id GROUP BY ALL),
near AS (SELECT a, b FROM pairs JOIN sizes p ON p.id = a JOIN sizes q ON q.id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),""" + _REACH.format(
    links="near", nodes="sizes") + """
SELECT w.id AS doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(c.component, w.id) AS component_id
FROM worded w LEFT JOIN sizes s USING (id) LEFT JOIN components c USING (id)"""

OP9 = f"""
WITH worded AS (SELECT CAST(doc_id AS BIGINT) AS id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
starts AS (SELECT id, w, unnest(range(1, len(w) - 48)) AS p FROM worded WHERE len(w) >= 50),
windows AS (SELECT id, p, sha256(array_to_string(w[p:p + 49], ' ')) AS g FROM starts),
firsts AS (SELECT g, min(id) AS first FROM windows GROUP BY g),
repeated AS (SELECT id, p FROM windows JOIN firsts USING (g) WHERE id > first),
words AS (SELECT id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM worded),
marked AS (
  SELECT x.id, x.word, x.p, max(CASE WHEN r.id IS NULL THEN 0 ELSE 1 END) OVER (
    PARTITION BY x.id ORDER BY x.p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM words x LEFT JOIN repeated r ON r.id = x.id AND r.p = x.p),
counted AS (
  SELECT id, count(*) AS n, CAST(sum(gone) AS BIGINT) AS removed, coalesce(string_agg(word, ' ' ORDER BY p) FILTER (gone = 0), '') AS kept
  FROM marked GROUP BY id)
SELECT w.id AS doc_id, coalesce(c.n, 0) AS n_words, coalesce(c.removed, 0) AS n_removed, sha256(coalesce(c.kept, '')) AS kept_sha256
FROM worded w LEFT JOIN counted c USING (id)"""

EXPECTED: dict[str, str] = {
    "op3_embedding_range_join": OP3,
    "op6_ngram_jaccard_join": OP6,
    "op9_substring_dedup": OP9,
    "op11_chat_formatting": OP11,
    "op12_merkle_manifest": OP12,
    "op13_prefix_trie": OP13,
}
