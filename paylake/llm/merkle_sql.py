"""DuckDB SQL for the Merkle manifest: the tree level by level, by recursion."""

from __future__ import annotations

from paylake.llm.merkle import COLUMNS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _hash(text: str = "text") -> str:
    values = [text if c == "text" else c for c in COLUMNS]
    return "sha256(" + " || ".join(
        f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}::VARCHAR)::VARCHAR || ':' || {v}::VARCHAR END"
        for v in values) + ")"


def _levels(name: str, nodes: str) -> str:
    """All levels over ``nodes`` (s, pos, h, n), 16 nodes to one, and the siblings on each."""
    side = f"coalesce(string_agg(h, '') OVER (PARTITION BY s, lvl, pos // 16 ORDER BY pos ROWS BETWEEN {{}}), '')"
    return f"""
{name} AS (
  SELECT s, 0 AS lvl, pos, h, n FROM {nodes}
  UNION ALL
  SELECT s, lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16
  FROM {name} WHERE n > 1 GROUP BY s, lvl, pos // 16, n),
{name}_steps AS (
  SELECT s, lvl, pos, {side.format('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS l,
         {side.format('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS r
  FROM {name} WHERE n > 1)"""


OP13_SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i] || range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY i) AS crc_of FROM range(256) t(i)),
docs AS (
  SELECT *, xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                            lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM documents, crc_table),
leaves AS (
  SELECT source AS s, doc_id, {_hash()} AS h,
         CASE WHEN crc % 5 = 0 THEN {_hash(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} END AS tampered FROM docs),
placed AS (
  SELECT *, row_number() OVER (ORDER BY s, doc_id) AS rid, count(*) OVER (PARTITION BY s) AS n,
         row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM leaves),
{_levels('up', 'placed')},
subroots AS (
  SELECT s AS source, 0 AS s, h, row_number() OVER (ORDER BY s NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM up WHERE n = 1),
{_levels('top', 'subroots')},
steps AS (
  SELECT rid, lvl, l, r FROM placed p JOIN up_steps u ON u.s IS NOT DISTINCT FROM p.s AND u.pos = p.pos >> 4 * lvl
  UNION ALL
  SELECT rid, 1000 + lvl, l, r FROM placed p JOIN subroots b ON b.source IS NOT DISTINCT FROM p.s
  JOIN top_steps t ON t.pos = b.pos >> 4 * lvl),
proofs AS (SELECT rid, list({{'l': l, 'r': r}} ORDER BY lvl) AS proof FROM steps GROUP BY rid),
folded AS (
  SELECT p.*, b.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root,
         sha256(coalesce(array_to_string(list_transform(proof, lambda x: x.l || x.r), ''), '')) AS proof_sha256,
         list_reduce([{{'l': coalesce(tampered, p.h), 'r': ''}}] || coalesce(proof, []),
                     lambda a, x: {{'l': sha256(x.l || a.l || x.r), 'r': ''}}).l AS folded_root
  FROM placed p JOIN subroots b ON b.source IS NOT DISTINCT FROM p.s LEFT JOIN proofs USING (rid))
SELECT doc_id, h AS leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""
