"""SQL twins, in the dialect of DuckDB, of the queries that SQL can express on whole tables."""

SQL: dict[str, str] = {}


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text of digits: bit by bit, reflected, with the usual polynomial."""
    bits = "list_reduce(list_prepend(xor(c, b), [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]), lambda s, k: if(s & 1 = 1, xor(s >> 1, 3988292384), s >> 1))"
    values = f"list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {values}), lambda c, b: {bits}), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return f"sha256({' || '.join(_field(f) for f in fields)})"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Every level of a tree is made from the one below, runs of 16 at a time; then each leaf is folded up with the
# other nodes of its run, first to its source's node, then to the root.
SQL["op13_manifest"] = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, {_leaf('text')} AS leaf,
         CASE WHEN {_crc32('doc_id::VARCHAR')} % 5 = 0 THEN {_leaf(_LOWER)} ELSE {_leaf('text')} END AS tampered
  FROM documents
),
ranked AS (
  SELECT *, coalesce('+' || source, '-') AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
         count(*) OVER (PARTITION BY source) AS n
  FROM leaves
),
nodes(g, level, r, n, hash) AS (
  SELECT g, 0, r, n, leaf FROM ranked
  UNION ALL
  SELECT g, level + 1, r // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY r)) FROM nodes WHERE n > 1 GROUP BY g, level, r // 16, n
),
subroots AS (
  SELECT g, hash, row_number() OVER (ORDER BY g <> '-', g) - 1 AS r, count(*) OVER () AS n FROM nodes WHERE n = 1
),
tops(level, r, n, hash) AS (
  SELECT 0, r, n, hash FROM subroots
  UNION ALL
  SELECT level + 1, r // 16, (n + 15) // 16, sha256(string_agg(hash, '' ORDER BY r)) FROM tops WHERE n > 1 GROUP BY level, r // 16, n
),
runs AS (SELECT g, level, r // 16 AS run, list(hash ORDER BY r) AS hashes FROM nodes WHERE n > 1 GROUP BY g, level, r // 16),
top_runs AS (SELECT level, r // 16 AS run, list(hash ORDER BY r) AS hashes FROM tops WHERE n > 1 GROUP BY level, r // 16),
folded(row_id, g, level, r, n, hash, proof) AS (
  SELECT row_id, g, 0, r, n, tampered, '' FROM ranked
  UNION ALL
  SELECT f.row_id, f.g, f.level + 1, f.r // 16, (f.n + 15) // 16,
         sha256(array_to_string(hashes[:f.r % 16], '') || f.hash || array_to_string(hashes[f.r % 16 + 2:], '')),
         f.proof || array_to_string(hashes[:f.r % 16], '') || array_to_string(hashes[f.r % 16 + 2:], '')
  FROM folded f JOIN runs ON runs.g = f.g AND runs.level = f.level AND runs.run = f.r // 16 WHERE f.n > 1
),
to_root(row_id, level, r, n, hash, proof) AS (
  SELECT f.row_id, 0, s.r, s.n, f.hash, f.proof FROM folded f JOIN subroots s USING (g) WHERE f.n = 1
  UNION ALL
  SELECT f.row_id, f.level + 1, f.r // 16, (f.n + 15) // 16,
         sha256(array_to_string(hashes[:f.r % 16], '') || f.hash || array_to_string(hashes[f.r % 16 + 2:], '')),
         f.proof || array_to_string(hashes[:f.r % 16], '') || array_to_string(hashes[f.r % 16 + 2:], '')
  FROM to_root f JOIN top_runs t ON t.level = f.level AND t.run = f.r // 16 WHERE f.n > 1
)
SELECT doc_id, leaf, s.hash AS subroot, t.hash AS root, sha256(f.proof) AS proof_sha256, f.hash AS folded_root, f.hash = t.hash AS verified
FROM ranked JOIN subroots s USING (g) JOIN to_root f USING (row_id) JOIN tops t ON t.n = 1 AND f.n = 1
"""


# All pairs of a label; a component is what can be reached over links.
SQL["op1_vector_links"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least_of.b, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(least_of.b, vec_id)) AS kept
FROM embeddings LEFT JOIN counted ON counted.a = vec_id LEFT JOIN least_of ON least_of.a = vec_id
"""


def all_sql() -> dict[str, str]:
    return dict(SQL)
