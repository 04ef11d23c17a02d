"""DuckDB SQL of the manifest and of the shards, for comparing whole tables."""

from __future__ import annotations

from fleetspark.llm.sharding import DIGITS, HEADER, SEED, SHARDS

#: A table of crc32 remainders and, over it, crc32 of a list of byte values.
#: Fixed value: the reversed polynomial of crc32.
CRC_TABLE = """bits AS (
  SELECT n, list_reduce(list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
  FROM range(256) r(n)
), remainders AS (
  SELECT list(v ORDER BY n) AS crc_table FROM bits
)"""


def crc32_sql(text: str) -> str:
    """crc32 of a text column's UTF-8 bytes; needs ``remainders`` in the FROM list."""
    byte = "(strpos('0123456789ABCDEF', h[1]) - 1) * 16 + strpos('0123456789ABCDEF', h[2]) - 1"
    values = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: {byte})"
    return (f"xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, {values}), "
            "lambda c, b: xor(c // 256, crc_table[xor(c, b) % 256 + 1])))")


def _field(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE octet_length(encode({text})) || ':' || {text} END"


def _levels(name: str, walkers: str, levels: int) -> str:
    """CTEs that fold ``{name}_n0`` (tree, pos, digest) and walk ``{name}_w0``
    (rid, tree, pos, node, siblings) up; a tree of one node stays as it is."""
    out = []
    for k in range(levels):
        out.append(f"""{name}_r{k} AS (
  SELECT tree, pos // 8 AS run, list(digest ORDER BY pos) AS nodes, max(run) OVER (PARTITION BY tree) = 0 AND len(nodes) = 1 AS alone
  FROM {name}_n{k} GROUP BY tree, pos // 8
), {name}_n{k + 1} AS (
  SELECT tree, run AS pos, CASE WHEN alone THEN nodes[1] ELSE sha256(array_to_string(nodes, '')) END AS digest FROM {name}_r{k}
), {name}_v{k} AS (
  SELECT w.rid, w.tree, r.run, w.node, w.siblings, r.alone, array_to_string(nodes[1:w.pos % 8], '') AS l,
         array_to_string(nodes[w.pos % 8 + 2:], '') AS r
  FROM {walkers if k == 0 else f'{name}_w{k}'} w JOIN {name}_r{k} r ON r.tree = w.tree AND r.run = w.pos // 8
), {name}_w{k + 1} AS (
  SELECT rid, tree, run AS pos, CASE WHEN alone THEN node ELSE sha256(l || node || r) END AS node, siblings || l || r AS siblings
  FROM {name}_v{k}
)""")
    return ",\n".join(out)


#: 8 levels hold 16 million leaves a language, 4 levels 4,096 languages.
OP11_SQL = f"""
WITH {CRC_TABLE}, rows AS (
  SELECT row_number() OVER () AS rid, coalesce('=' || lang, '-') AS tree, doc_id, text,
         {_field('doc_id')} || {_field('source')} || {_field('lang')} || {_field('n_chars')} AS head,
         CASE WHEN {crc32_sql("coalesce(CAST(doc_id AS VARCHAR), '')")} % 3 = 0 AND doc_id IS NOT NULL
              THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS seen
  FROM documents, remainders
), hashed AS (
  SELECT rid, tree, doc_id, sha256(head || {_field('text')}) AS leaf, sha256(head || {_field('seen')}) AS node FROM rows
), leaves AS (
  SELECT *, '' AS siblings, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed
), a_n0 AS (
  SELECT tree, pos, leaf AS digest FROM leaves
), {_levels('a', 'leaves', 8)}, tops AS (
  SELECT tree AS name, '' AS tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM a_n8
), climbers AS (
  SELECT w.rid, t.tree, t.pos, w.node, w.siblings FROM a_w8 w JOIN tops t ON t.name = w.tree
), b_n0 AS (
  SELECT tree, pos, digest FROM tops
), {_levels('b', 'climbers', 4)}
SELECT l.doc_id, l.leaf, t.digest AS subroot, n.digest AS root, sha256(w.siblings) AS proof_sha256, w.node AS folded_root,
       w.node = n.digest AS verified, CAST(l.pos AS BIGINT) AS position
FROM leaves l JOIN tops t ON t.name = l.tree JOIN b_w4 w ON w.rid = l.rid, b_n4 n
"""

OP12_SQL = f"""
WITH {CRC_TABLE}, draws AS (
  SELECT doc_id, n, -ln((CAST('0x' || md5('{SEED}:' || n || ':' || doc_id)[1:{DIGITS}] AS BIGINT) + 0.5) / {float(16 ** DIGITS)!r}::DOUBLE) AS t
  FROM (SELECT DISTINCT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id FROM documents), range({SHARDS + 1}) r(n)
), won AS (
  SELECT doc_id AS name, arg_min(n, (t, n)) FILTER (n < {SHARDS}) AS shard, arg_min(n, (t, n)) AS grown_shard FROM draws GROUP BY doc_id
), sized AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + {HEADER} AS BIGINT) AS size, {crc32_sql("coalesce(text, '')")} AS text_crc32
  FROM documents, remainders
)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS BIGINT) AS slot,
       CAST(grown_shard AS INTEGER) AS grown_shard
FROM sized JOIN won ON won.name = coalesce(CAST(doc_id AS VARCHAR), '')
"""
