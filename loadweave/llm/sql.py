"""DuckDB statements that give the rows of this subpackage's queries, where SQL can."""

SPACE = r"[\x20\x09-\x0D]+"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_list(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x20\x09-\x0D]+')"


def shingle_list(words: str, n: int) -> str:
    return f"""CASE WHEN len({words}) >= {n}
  THEN [list_aggregate({words}[i + 1:i + {n}], 'string_agg', ' ') FOR i IN range(len({words}) - {n - 1})]
  WHEN len({words}) > 0 THEN [list_aggregate({words}, 'string_agg', ' ')] ELSE [] END"""


#: The unsigned CRC-32 of a text of ASCII characters, bit by bit.
CRC32 = """xor(list_reduce([4294967295::UBIGINT] || [ascii(substr({0}, i, 1))::UBIGINT FOR i IN range(1, len({0}) + 1)],
  lambda c, b: list_reduce([xor(c, b)] || [0::UBIGINT FOR i IN range(8)],
    lambda r, z: xor(r >> 1, CASE WHEN r % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))), 4294967295::UBIGINT)"""


def leaf(text: str) -> str:
    """The hash of a document's fields."""
    told = [f"coalesce(strlen({f}::VARCHAR) || ':' || {f}::VARCHAR, '-')" for f in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(told)})"


def tree(members: str, name: str) -> str:
    """Every level of each tree of ``members`` (tree, nodes), as one list a level."""
    run = "sha256(list_aggregate(nodes[3 * i + 1:3 * i + 3], 'string_agg', ''))"
    return f"""{name} AS (
  SELECT tree, 0 AS level, nodes FROM {members} UNION ALL
  SELECT tree, level + 1, [{run} FOR i IN range((len(nodes) + 2) // 3)] FROM {name} WHERE len(nodes) > 1
)"""


def climb(rows: str, levels: str, name: str) -> str:
    """Rows (r, tree, pos, node, told) taken from the leaves to the last node: node folded, told the siblings so far."""
    first = "f.pos - f.pos % 3"
    before = f"coalesce(list_aggregate(nodes[{first} + 1:f.pos], 'string_agg', ''), '')"
    after = f"coalesce(list_aggregate(nodes[f.pos + 2:{first} + 3], 'string_agg', ''), '')"
    return f"""{name} AS (
  SELECT r, tree, 0 AS level, pos, node, told FROM {rows} UNION ALL
  SELECT r, f.tree, f.level + 1, f.pos // 3, sha256({before} || node || {after}), told || {before} || {after}
  FROM {name} f JOIN {levels} l ON l.tree = f.tree AND l.level = f.level WHERE len(nodes) > 1
)"""


STATEMENTS = {
    "op3_source_mix": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), o AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS s
  FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][s % 3 + 1] AS weight, sum(source_size) OVER () AS total FROM o
), f AS (
  SELECT *, 3 * source_size * (
      sum(weight) OVER () - coalesce(sum(weight) OVER (
        ORDER BY source_size * 3 / weight, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    ) <= weight * (
      total - 3 * coalesce(sum(source_size) OVER (
        ORDER BY source_size * 3 / weight, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    ) AS capped
  FROM w
), t AS (
  SELECT source, source_size, CASE WHEN capped THEN (3 * source_size)::DOUBLE
    ELSE ((total - sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER ()) * weight)::DOUBLE
      / sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () END AS target
  FROM f
), g AS (SELECT *, least(round(target)::BIGINT, 3 * source_size) AS goal FROM t
), p AS (
  SELECT doc_id, size, source_size, target, goal, coalesce(sum(size) OVER (
    PARTITION BY d.source ORDER BY ('0x' || substr(md5(concat_ws('/', '0', doc_id)), 1, 8))::BIGINT,
      doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
  (greatest(least(goal - start, size), 0) + greatest(least(goal - start - source_size, size), 0)
    + greatest(least(goal - start - 2 * source_size, size), 0))::BIGINT AS taken
FROM p""",
    "op4_decontaminate": f"""
WITH i AS (
  SELECT DISTINCT item_id, unnest({shingle_list("w", 5)}) AS shingle
  FROM (SELECT item_id, {word_list("text")} AS w FROM benchmark)
), n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id
), d AS (
  SELECT DISTINCT doc_id, unnest({shingle_list("w", 5)}) AS shingle
  FROM (SELECT doc_id, {word_list("text")} AS w FROM documents)
), c AS (
  SELECT item_id, doc_id, count(*) AS n_shared FROM i JOIN d USING (shingle) GROUP BY item_id, doc_id
)
SELECT item_id, doc_id, n_item, n_shared, n_shared / n_item AS containment
FROM c JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_item""",
    "op6_exact_dedup": rf"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g')) AS h FROM documents
), g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, h AS text_sha256
FROM n JOIN g USING (h)""",
    "op7_arc_to_warc": f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, unhex(sha1(coalesce(html, '')))::BIT::VARCHAR AS bits FROM pages
), d AS (
  SELECT page_id, strlen(html) AS payload_bytes,
    list_aggregate([substr('{BASE32}', 1 + list_sum([
      CASE substr(bits, 5 * k + j + 1, 1) WHEN '1' THEN 16 >> j ELSE 0 END FOR j IN range(5)
    ])::INTEGER, 1) FOR k IN range(32)], 'string_agg', '') AS payload_digest
  FROM p
), m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM m""",
    "op8_near_dedup": f"""
WITH RECURSIVE w AS (SELECT doc_id, {word_list("text")} AS w FROM documents
), h AS (SELECT DISTINCT doc_id, unnest({shingle_list("w", 3)}) AS shingle FROM w
), n AS (SELECT doc_id, count(*) AS n FROM h GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM h a JOIN h b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  SELECT doc_id, doc_id AS root FROM w UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.root
), c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN c ON c.doc_id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id""",
    "op11_source_audit": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), t AS (SELECT r, lang, source, unnest(terms) AS term FROM d
), k AS (SELECT lang, term, count(*) AS c FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10
), g AS (SELECT DISTINCT lang, source FROM d
), n AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY lang, source, term
), full_counts AS (
  SELECT g.lang, g.source, k.term, coalesce(n.c, 0) AS c, k.c AS lang_c
  FROM g JOIN k ON k.lang = g.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term
), p AS (
  SELECT *, 1 + (1000000000::HUGEINT * (c + 2)) // (sum(c) OVER w + 2 * count(*) OVER w) AS p,
    1 + (1000000000::HUGEINT * (lang_c + 2)) // (sum(lang_c) OVER w + 2 * count(*) OVER w) AS q
  FROM full_counts WINDOW w AS (PARTITION BY lang, source)
), v AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(v.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN v ON v.lang = a.lang AND v.source = a.source AND v.item = b.source
), rising AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM p WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM rising)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE d AS (
  SELECT *, CASE WHEN {CRC32.format("doc_id::VARCHAR")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS altered
  FROM documents
), e AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS tree, {leaf("text")} AS leaf, {leaf("altered")} AS shown
  FROM d
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, shown) - 1 AS pos FROM e
), m AS (SELECT tree, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY tree
), {tree("m", "s")}, ends AS (SELECT tree AS member, nodes[1] AS subroot FROM s WHERE len(nodes) = 1
), tops AS (SELECT 'top' AS tree, list(subroot ORDER BY member) AS nodes FROM ends
), {tree("tops", "u")}, last AS (SELECT nodes[1] AS root FROM u WHERE len(nodes) = 1
), begun AS (SELECT r, tree, pos, shown AS node, '' AS told FROM placed
), {climb("begun", "s", "low")}, reached AS (SELECT r, tree AS member, arg_max(node, level) AS node, arg_max(told, level) AS told FROM low GROUP BY r, tree
), rank AS (SELECT member, row_number() OVER (ORDER BY member) - 1 AS pos FROM ends
), halfway AS (SELECT r, 'top' AS tree, pos, node, told FROM reached JOIN rank USING (member)
), {climb("halfway", "u", "high")}, done AS (SELECT r, arg_max(node, level) AS folded_root, arg_max(told, level) AS told FROM high GROUP BY r)
SELECT doc_id, leaf, subroot, root, sha256(told) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN ends ON member = tree JOIN done USING (r) CROSS JOIN last""",
}
