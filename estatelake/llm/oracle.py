"""DuckDB SQL for the queries of the operators that SQL can express."""

from __future__ import annotations

from estatelake.llm.lookup_sharding import SHARDS, SIZE, fill

# A-Z lower-cased one by one, as the word contract says; `lower` would change other alphabets too.
ASCII_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

OP3 = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {ASCII_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, w[i:least(len(w), i + 9)] AS words, least(len(w), 10) AS n
  FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0),
doc AS (SELECT doc_id, {ASCII_WORDS} AS w FROM documents),
size AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT doc_id, i, n, w[i:i + n - 1] AS words
  FROM doc, size, unnest(range(1, len(w) - n + 2)) AS u(i) WHERE len(w) >= n),
met AS (SELECT doc_id, i, place.n AS n, item FROM place JOIN win USING (words)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM met, unnest(range(i, i + n)) AS u(p) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP7 = f"""
WITH keyed AS (
  SELECT doc_id, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) % {SIZE} AS slot
  FROM documents)
SELECT doc_id, CAST(slot AS INTEGER) AS slot, printf('shard-%02d', {fill(SHARDS)}[slot + 1]) AS shard FROM keyed
"""



def crc32(text: str) -> str:
    """SQL for the unsigned CRC-32 of an ASCII text: bit by bit, as there is no such function."""
    data = f"list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT)))"
    byte = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(4294967295, list_reduce({data}, lambda c, b: {byte}))"


# A node is the list of its turns.
OP11 = f"""
WITH own AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, {{'role': role, 'text': text}} AS said, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(sha256(strlen(role) || ':' || role || text), 1, 32)) AS i
  FROM own),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {crc32('CAST(conv_id AS VARCHAR)')} % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
again AS (
  SELECT c.conv_id, 0 AS part, i, said FROM convs c JOIN turns t ON t.conv_id = c.base AND i <= h
  UNION ALL SELECT conv_id, 1, i, said FROM convs JOIN turns USING (conv_id) WHERE i > h),
paths AS (
  SELECT conv_id, coalesce(path, CAST([] AS STRUCT("role" VARCHAR, "text" VARCHAR)[])) AS path
  FROM convs LEFT JOIN (SELECT conv_id, list(said ORDER BY part, i) AS path FROM again GROUP BY conv_id) USING (conv_id)),
prefixes AS (SELECT conv_id, d, path[1:d] AS node, d = len(path) AS ends FROM paths, unnest(range(0, len(path) + 1)) AS u(d)),
nodes AS (
  SELECT node, d, min(conv_id) AS conv, count(*) AS n, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS ended
  FROM prefixes GROUP BY node, d),
grown AS (
  SELECT nodes.*, coalesce(k, 0) AS k FROM nodes
  LEFT JOIN (SELECT node[1:d - 1] AS node, count(*) AS k FROM nodes WHERE d > 0 GROUP BY 1) USING (node)),
below AS (
  SELECT node[1:j] AS node, count(*) FILTER (k = 0) AS leaves, sum((n - 1) * coalesce(strlen(node[d].text), 0)) AS saved
  FROM grown, unnest(range(0, d + 1)) AS u(j) GROUP BY 1)
SELECT g.conv AS conv_id, CAST(g.d AS BIGINT) AS depth, p.conv AS parent_conv_id, g.n AS n_convs, g.k AS n_children,
  leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(g.ended, '')) AS ends_sha256
FROM grown g JOIN below USING (node) LEFT JOIN nodes p ON g.d > 0 AND p.node = g.node[1:g.d - 1]
"""


def manifest_sql(levels: int = 5) -> str:
    """The manifest over trees of at most ``levels`` levels: 16^5 rows a source, and as many sources."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    columns = ["doc_id", "source", "lang", "n_chars"]
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = lambda text: f"sha256({' || '.join(map(field, [*columns, text]))})"
    tables = [
        f"""leaves AS (
          SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, {leaf('text')} AS leaf,
            CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {leaf(low)} END AS forged FROM documents)""",
        """placed AS (
          SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
            count(*) OVER (PARTITION BY tree) AS n FROM leaves)""",
        "a0 AS (SELECT tree, pos, n, leaf AS hash FROM placed)",
    ]

    def climb(name: str) -> None:
        for k in range(levels):
            run = f"PARTITION BY tree, pos // 16 ORDER BY pos ROWS BETWEEN"
            tables.append(f"""{name}{k}_run AS (
              SELECT *, coalesce(string_agg(hash, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
                coalesce(string_agg(hash, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {name}{k})""")
            tables.append(f"""{name}{k + 1} AS (
              SELECT tree, pos // 16 AS pos, (max(n) + 15) // 16 AS n,
                CASE WHEN max(n) = 1 THEN any_value(hash) ELSE sha256(string_agg(hash, '' ORDER BY pos)) END AS hash
              FROM {name}{k} GROUP BY tree, pos // 16)""")

    climb("a")
    tables.append(f"b0 AS (SELECT 0 AS tree, tree AS pos, count(*) OVER () AS n, hash FROM a{levels})")
    climb("b")
    tables.append("f0 AS (SELECT doc_id, leaf, tree, pos, coalesce(forged, leaf) AS folded, '' AS proof FROM placed)")
    steps = [(f"a{k}_run", "f.tree", f"f.pos // {16**k}") for k in range(levels)] + [(f"b{k}_run", "0", f"f.tree // {16**k}") for k in range(levels)]
    for i, (level, tree, pos) in enumerate(steps):
        tables.append(f"""f{i + 1} AS (
          SELECT doc_id, leaf, f.tree AS tree, f.pos AS pos, CASE WHEN n = 1 THEN folded ELSE sha256(before || folded || after) END AS folded,
            CASE WHEN n = 1 THEN proof ELSE proof || before || after END AS proof
          FROM f{i} f JOIN {level} l ON l.tree = {tree} AND l.pos = {pos})""")
    joined = ",\n".join(tables)
    return f"""WITH {joined}
        SELECT doc_id, leaf, a.hash AS subroot, b.hash AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = b.hash AS verified
        FROM f{2 * levels} f JOIN a{levels} a USING (tree) CROSS JOIN b{levels} b"""


OP13 = """
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS words
  FROM doc, unnest(range(1, len(w) - 11)) AS u(i) WHERE len(w) >= 13),
first AS (SELECT words, min(doc_id) AS earliest FROM win GROUP BY words),
hit AS (
  SELECT DISTINCT doc_id, p FROM (SELECT doc_id, i FROM win JOIN first USING (words) WHERE doc_id > earliest), unnest(range(i, i + 13)) AS u(p)),
left_over AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc) ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM doc LEFT JOIN left_over USING (doc_id)
"""

ORACLE = {
    "op3_decontaminate": OP3,
    "op7_lookup_sharding": OP7,
    "op11_prefix_trie": OP11,
    "op12_merkle_manifest": manifest_sql(),
    "op13_superkmer_dedup": OP13,
}
