"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from plotline.llm.decontaminate import WINDOW
from plotline.llm.mixing import MOST_COPIES, WEIGHTS
from plotline.llm.rules import CLASSES, COMMON, LEAST_CHARS, LEAST_WORDS, MOST_CHARS, MOST_WORDS

#: Words of the decontamination rule: A-Z lower-cased, the rest as it is.
LOWER_AZ = "translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ITEM_WORDS = (
    "coalesce(regexp_extract_all(" + LOWER_AZ + r", '[0-9a-z\x{{80}}-\x{{10FFFF}}]+'), [])"
)
SPACED_WORDS = r"coalesce(regexp_extract_all({x}, '[^\x20\x09-\x0D]+'), [])"

#: Jensen-Shannon distance over rows (p, q) of a group.
JS = """round(sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
      + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)), 6)"""


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


DECONTAMINATE = f"""
WITH it AS (SELECT item_id::VARCHAR AS item, {ITEM_WORDS.format(x='text')} AS w FROM benchmark),
g AS (SELECT item, least(len(w), {WINDOW}) AS size, w, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS i
      FROM it WHERE len(w) > 0),
gram AS (SELECT DISTINCT item, size, list_slice(w, i, i + size - 1) AS gram FROM g),
d AS (SELECT doc_id, {ITEM_WORDS.format(x='text')} AS w FROM documents),
dw AS (SELECT doc_id, k.size, w, unnest(range(1, len(w) - k.size + 2)) AS i
       FROM d, (SELECT DISTINCT size FROM gram) k WHERE len(w) >= k.size),
hit AS (SELECT dw.doc_id, dw.size, dw.i, gram.item
        FROM (SELECT doc_id, size, i, list_slice(w, i, i + size - 1) AS gram FROM dw) dw JOIN gram USING (size, gram)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM hit WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

#: crc32 of UTF-8 bytes by its rule, one table step per byte.
CRC32 = """
tab AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
bytes AS (SELECT text, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT) AS b
          FROM (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL)),
crc AS (SELECT text, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
        lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS crc FROM bytes, tab)
"""


def shard_sql(shards: int = 24, seed: int = 8) -> str:
    return f"""
WITH {CRC32},
d AS (SELECT doc_id, source, coalesce(octet_length(encode(text)), 0)::BIGINT + 8 AS size, coalesce(crc, 0) AS text_crc32,
      ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k
      FROM documents LEFT JOIN crc USING (text)),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k, doc_id, size, text_crc32) AS r,
      count(*) OVER (PARTITION BY source) AS n FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY (2 * r - 1)::DOUBLE / (2 * n)::DOUBLE, coalesce('=' || source, ''), r) - 1 AS p,
      count(*) OVER () AS total FROM r),
s AS (SELECT *, (p * {shards}) // total AS shard FROM p)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INT AS shard,
       (p - (shard * total + {shards - 1}) // {shards})::BIGINT AS slot, NULL::INT AS grown_shard
FROM s
"""


def mixing_ctes(documents: str, seed: int = 6) -> str:
    """CTEs ending in ``mix``: doc_id, source, size, source_size, target, copies."""
    weights = ", ".join(map(str, WEIGHTS))
    return rf"""
sized AS (SELECT doc_id, source, len({SPACED_WORDS.format(x='text')})::BIGINT AS size,
      (('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
      FROM {documents}),
src AS (SELECT source, sum(size)::BIGINT AS size, ([{weights}])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight
      FROM sized GROUP BY source),
run AS (SELECT *, {MOST_COPIES} * size AS stop, sum(size) OVER () - coalesce(sum({MOST_COPIES} * size) OVER b, 0) AS lw,
      sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS lg, row_number() OVER b AS nth FROM src
      WINDOW b AS (ORDER BY ({MOST_COPIES} * size)::DOUBLE / weight::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
unit AS (SELECT lw::DOUBLE / lg::DOUBLE AS unit FROM run WHERE stop::HUGEINT * lg >= weight::HUGEINT * lw ORDER BY nth LIMIT 1),
goal AS (SELECT source, size AS source_size, least(stop::DOUBLE, weight * unit) AS target,
      CASE WHEN size > 0 THEN least(stop::DOUBLE, weight * unit) / size::DOUBLE ELSE 0 END AS copies FROM run, unit),
part AS (SELECT *, floor(copies)::BIGINT AS whole, copies - floor(copies) AS p, target - floor(copies)::BIGINT * source_size AS rest FROM goal),
ranked AS (SELECT sized.*, source_size, target, whole, p, rest,
      CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank
      FROM sized JOIN part ON sized.source IS NOT DISTINCT FROM part.source),
cum AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM ranked),
mix AS (SELECT doc_id, source, size, source_size, target,
      whole + CASE WHEN p > 0 AND upto - size / 2.0::DOUBLE < rest THEN 1 ELSE 0 END AS copies FROM cum)
"""


MIXING = f"""
WITH {mixing_ctes('documents')}
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken FROM mix
"""

def rules_sql() -> str:
    classes = [f"len(regexp_extract_all(t, {quoted(p)}))" for p in CLASSES.values()]
    n = len(CLASSES) + 1
    return rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t, {SPACED_WORDS.format(x='text')} AS w FROM documents),
base AS (SELECT doc_id, lang, w, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
      len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
      length(t) AS n_chars, [{", ".join(classes)}] AS c FROM d),
counts AS (SELECT *, list_append(c, n_chars - list_sum(c)) AS chars FROM base),
win AS (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5),
gram AS (SELECT doc_id, i, list_slice(w, i, i + 4) AS g FROM win),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
      SELECT doc_id, unnest(range(i, i + 5)) AS p FROM gram
      JOIN (SELECT doc_id, g FROM gram GROUP BY doc_id, g HAVING count(*) > 1) USING (doc_id, g)) GROUP BY doc_id),
tok AS (SELECT doc_id, lang, unnest(w) AS word FROM d),
freq AS (SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS k FROM tok GROUP BY lang, word),
common AS (SELECT * FROM freq WHERE k <= {COMMON}),
size AS (SELECT lang, count(*) AS m FROM common GROUP BY lang),
bin AS (SELECT doc_id, lang, coalesce(k, 0) AS k, count(*) AS n FROM tok LEFT JOIN common USING (lang, word) GROUP BY ALL),
refw AS (SELECT lang, k, n / sum(n) OVER (PARTITION BY lang) AS q FROM (SELECT lang, k, sum(n) AS n FROM bin GROUP BY lang, k)),
wd AS (SELECT b.doc_id, r.k, coalesce(n, 0) / b.n_words AS p, q FROM (SELECT * FROM base WHERE n_words >= {LEAST_WORDS}) b
      JOIN refw r USING (lang) LEFT JOIN bin ON bin.doc_id = b.doc_id AND bin.k = r.k),
cell AS (SELECT doc_id, lang, n_chars, unnest(range(1, {n + 1})) AS k, unnest(chars) AS n FROM counts),
refc AS (SELECT lang, k, CASE WHEN s > 0 THEN n / s ELSE 0 END AS q
      FROM (SELECT lang, k, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY lang) AS s FROM cell GROUP BY lang, k)),
cd AS (SELECT doc_id, k, n / n_chars AS p, q FROM cell JOIN refc USING (lang, k) WHERE n_chars >= {LEAST_CHARS}),
js AS (SELECT 'w' AS kind, doc_id, {JS} AS js FROM wd GROUP BY doc_id UNION ALL SELECT 'c', doc_id, {JS} FROM cd GROUP BY doc_id),
far AS (SELECT doc_id, max(js) FILTER (kind = 'c') AS char_distance, max(js) FILTER (kind = 'w') AS word_distance FROM js GROUP BY doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
      coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
      n_words < 10 OR 100 * coalesce(rep.n, 0) > 20 * n_words AS base_failed,
      NOT (n_words < 10 OR 100 * coalesce(rep.n, 0) > 20 * n_words)
        AND coalesce(char_distance <= {MOST_CHARS}, true) AND coalesce(word_distance <= {MOST_WORDS}, true) AS kept,
      char_distance, word_distance
FROM base b LEFT JOIN rep USING (doc_id) LEFT JOIN far USING (doc_id)
"""


NEAR_DUP = f"""
WITH RECURSIVE d AS (SELECT doc_id, {SPACED_WORDS.format(x=LOWER_AZ.format(x='text'))} AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON e.a = r.b),
low AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
       doc_id <= coalesce(low, doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN low USING (doc_id)
"""


def crc32_sql(column: str, table: str) -> str:
    """CTEs ending in ``checksum``: id, crc (unsigned crc32 of the decimal text)."""
    return f"""
tab AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
checksum AS (SELECT id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS crc
        FROM (SELECT DISTINCT {column} AS id FROM {table} WHERE {column} IS NOT NULL), tab)"""


def cell_sql(x: str) -> str:
    return f"coalesce(octet_length(encode(({x})::VARCHAR))::VARCHAR || ':' || ({x})::VARCHAR, '-')"


#: One level up: digests of every two consecutive nodes of a list.
UP = "list_transform(range(1, len({x}) + 1, 2), lambda i: sha256({x}[i] || coalesce({x}[i + 1], '')))"
_CELLS = [cell_sql(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
_MORE = [*_CELLS[:3], cell_sql("n_chars::HUGEINT + 1"), _CELLS[4]]
MERKLE = f"""
WITH RECURSIVE {crc32_sql('doc_id', 'documents')},
leaf AS (SELECT doc_id, lang, sha256({' || '.join(_CELLS)}) AS leaf,
      CASE WHEN crc % 7 = 0 THEN sha256({' || '.join(_MORE)}) END AS bad
      FROM documents LEFT JOIN checksum ON checksum.id = doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaf),
low(lang, level, nodes) AS (
      SELECT lang, 0, list(leaf ORDER BY pos) FROM placed GROUP BY lang
      UNION ALL SELECT lang, level + 1, {UP.format(x='nodes')} FROM low WHERE len(nodes) > 1),
subroot AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS nth FROM low WHERE len(nodes) = 1),
high(level, nodes) AS (
      SELECT 0, list(subroot ORDER BY nth) FROM subroot
      UNION ALL SELECT level + 1, {UP.format(x='nodes')} FROM high WHERE len(nodes) > 1),
level AS (SELECT lang, level, nodes, FALSE AS upper FROM low WHERE len(nodes) > 1
      UNION ALL SELECT s.lang, h.level, h.nodes, TRUE FROM high h, subroot s WHERE len(nodes) > 1),
row_ AS (SELECT doc_id, lang, leaf, bad, pos, row_number() OVER () AS id FROM placed),
step AS (SELECT r.id, row_number() OVER (PARTITION BY r.id ORDER BY l.upper, l.level) AS n, (CASE WHEN upper THEN s.nth ELSE r.pos END >> l.level) AS p, l.nodes
      FROM row_ r JOIN level l ON r.lang IS NOT DISTINCT FROM l.lang JOIN subroot s ON s.lang IS NOT DISTINCT FROM r.lang),
sibling AS (SELECT id, n, p, nodes[xor(p, 1) + 1] AS s FROM step),
proof AS (SELECT id, list({{'p': p, 's': s}} ORDER BY n) AS steps FROM sibling GROUP BY id),
climb AS (SELECT r.*, coalesce(steps, []) AS steps, coalesce(bad, leaf) AS start FROM row_ r LEFT JOIN proof USING (id)),
folded AS (SELECT *, list_reduce(list_prepend({{'p': 0::BIGINT, 's': start}}, steps),
      lambda a, x: {{'p': 0::BIGINT, 's': CASE WHEN x.s IS NULL THEN sha256(a.s) WHEN x.p % 2 = 1 THEN sha256(x.s || a.s) ELSE sha256(a.s || x.s) END}}).s AS top
      FROM climb)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda x: coalesce(x.s, '')), '')) AS proof_sha256,
      top AS folded_root, top = root AS verified
FROM folded JOIN subroot ON subroot.lang IS NOT DISTINCT FROM folded.lang, (SELECT nodes[1] AS root FROM high WHERE len(nodes) = 1)
"""


TRIE = f"""
WITH {crc32_sql('conv_id', 'conversations')},
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, sha256(octet_length(encode(role))::VARCHAR || ':' || role || text)) AS place FROM t),
c AS (SELECT id AS conv_id, crc % 6 AS head, id - id % 100 AS host FROM checksum),
built AS (SELECT c.conv_id, place, 0 AS part, role, text FROM c JOIN o ON o.conv_id = c.host AND place <= head
      UNION ALL SELECT c.conv_id, place, 1, role, text FROM c JOIN o USING (conv_id) WHERE place > head),
said AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth, text,
      sha256(octet_length(encode(role))::VARCHAR || ':' || role || text) AS content FROM built),
path AS (SELECT conv_id, depth, text, string_agg(content, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS path FROM said),
member AS (SELECT conv_id, depth, sha256(path) AS node, length(text) AS n, CASE WHEN depth = 1 THEN '' ELSE lag(sha256(path)) OVER (PARTITION BY conv_id ORDER BY depth) END AS up FROM path
      UNION ALL SELECT conv_id, 0, '', 0, NULL FROM c),
node AS (SELECT node, any_value(up) AS up, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS saved FROM member GROUP BY node),
kid AS (SELECT up AS node, count(*) AS kids FROM node WHERE up IS NOT NULL GROUP BY up),
under AS (SELECT DISTINCT a.node AS node, b.node AS below FROM member a JOIN member b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
total AS (SELECT u.node, sum(saved) AS saved, count(*) FILTER (kids IS NULL) AS leaves
      FROM under u JOIN node ON node.node = u.below LEFT JOIN kid ON kid.node = u.below GROUP BY u.node),
last AS (SELECT conv_id, max_by(node, depth) AS node FROM member GROUP BY conv_id),
ends AS (SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM last GROUP BY node)
SELECT node.conv_id, node.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, node.n_convs, coalesce(kids, 0)::BIGINT AS n_children,
      leaves::BIGINT AS n_leaves, total.saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node JOIN total USING (node) LEFT JOIN kid USING (node) LEFT JOIN ends USING (node) LEFT JOIN node p ON p.node = node.up
"""


SQL: dict[str, str] = {
    "op11_conversation_trie": TRIE,
    "op12_merkle_manifest": MERKLE,
    "op10_minhash_near_dedup": NEAR_DUP,
    "op5_divergence_rules": rules_sql(),
    "op4_benchmark_decontamination": DECONTAMINATE,
    "op6_pareto_mixing": MIXING,
    "op8_proportional_sharding": shard_sql(),
}
