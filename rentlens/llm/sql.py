"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

#: Fixed values of the contracts.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWERED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def mixing(docs: str = "documents") -> str:
    return rf"""
WITH slim AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{SPACED_WORD}')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 9))::BIGINT AS k
  FROM {docs}),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS nth
  FROM slim GROUP BY source),
capped AS (
  SELECT source, source_size, nth, 2.0::DOUBLE * source_size AS cap,
         (CASE (nth - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS weight
  FROM per_source),
levels AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, nth) AS place,
         ((sum(source_size) OVER ())::DOUBLE * 1.5
           - coalesce(sum(cap) OVER (ORDER BY cap / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / ((sum(weight) OVER ())
           - coalesce(sum(weight) OVER (ORDER BY cap / weight, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev
  FROM capped),
water AS (SELECT min(place) AS p, min_by(lev, place) AS lev FROM levels WHERE cap > weight * lev),
goal AS (
  SELECT source, source_size, CASE WHEN water.p IS NULL OR place < water.p THEN cap ELSE weight * water.lev END AS target
  FROM levels CROSS JOIN water),
plan AS (
  SELECT *, CASE WHEN target >= source_size THEN 1 ELSE 0 END AS base,
         target - CASE WHEN target >= source_size THEN source_size ELSE 0 END AS budget FROM goal),
keys AS (
  SELECT source, k, words, sum(words) OVER (PARTITION BY source ORDER BY k) AS upto
  FROM (SELECT source, k, sum(size) AS words FROM slim GROUP BY source, k)),
met AS (
  SELECT plan.source, any_value(budget) AS budget,
         coalesce(min(k) FILTER (WHERE upto >= budget), max(k)) AS at_key
  FROM plan JOIN keys ON plan.source IS NOT DISTINCT FROM keys.source GROUP BY plan.source),
bound AS (
  SELECT met.source, at_key + CASE WHEN (budget - (upto - words)) * 2 >= words THEN 1 ELSE 0 END AS k_end
  FROM met JOIN keys ON met.source IS NOT DISTINCT FROM keys.source AND k = at_key)
SELECT doc_id, size, source_size, target, (size * (base + CASE WHEN k < k_end THEN 1 ELSE 0 END))::BIGINT AS taken
FROM slim JOIN plan ON slim.source IS NOT DISTINCT FROM plan.source
JOIN bound ON slim.source IS NOT DISTINCT FROM bound.source"""


def exact(docs: str = "documents") -> str:
    low = LOWERED.format("coalesce(text, '')")
    return f"""
WITH t AS (SELECT doc_id, {low} AS body FROM {docs})
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM t WINDOW w AS (PARTITION BY body)"""


def jaccard(docs: str = "documents") -> str:
    low = LOWERED.format("coalesce(text, '')")
    return rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({low}, '{SPACED_WORD}') AS w FROM {docs}),
g AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                            ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS s FROM d),
n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
pairs AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM g x JOIN g y ON x.s = y.s AND x.r < y.r GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON edges.a = reach.b),
least_ AS (SELECT a, min(doc_id) AS m FROM reach JOIN d ON d.r = b GROUP BY a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM d LEFT JOIN n ON n.r = d.r LEFT JOIN least_ ON least_.a = d.r"""


def contamination(docs: str = "documents", bench: str = "benchmark") -> str:
    words = f"regexp_extract_all({LOWERED.format('text')}, '{ALNUM_WORD}')"
    return f"""
WITH d AS (SELECT doc_id, coalesce({words}, []) AS w FROM {docs}),
b AS (SELECT item_id, {words} AS w FROM {bench}),
test AS (
  SELECT DISTINCT item_id, unnest(CASE WHEN len(w) < 13 THEN [w] ELSE [w[i:i + 12] FOR i IN range(1, len(w) - 11)] END) AS g
  FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(g) AS m FROM test),
places AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= m),
hits AS (SELECT doc_id, i, m, item_id FROM places JOIN test ON m = len(g) AND w[i:i + m - 1] = g),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""


def archive(pages: str = "pages") -> str:
    """Base32 by hand: the SHA-1's 160 bits in 32 groups of five."""
    nibbles = "".join(f"{i:04b}" for i in range(16))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM {pages}),
h AS (
  SELECT *, array_to_string(list_transform(string_split(sha1(body), ''),
                lambda c: substr('{nibbles}', 4 * (strpos('0123456789abcdef', c) - 1) + 1, 4)), '') AS bits FROM p),
d AS (
  SELECT page_id, body, strlen(body)::BIGINT AS payload_bytes, max(page_id) OVER (PARTITION BY body) AS first_id,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
             list_sum(list_transform(range(5), lambda j: substr(bits, 5 * i + j + 1, 1)::INTEGER * (16 >> j)))::INTEGER, 1)), '') AS payload_digest
  FROM h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d"""


def crc32(expr: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit (3988292384 is its polynomial)."""
    return f"""xor(4294967295, list_reduce(list_transform(range(1, len({expr}) + 1), lambda i: ascii(substr({expr}, i, 1))::BIGINT),
      lambda c, b: list_reduce(range(8)::BIGINT[], lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)), 4294967295))"""


def merkle(docs: str = "documents") -> str:
    """Levels as lists of nodes; a level's node i has the children 2 i and 2 i + 1."""
    def leaf(n_chars: str) -> str:
        fields = ("doc_id::VARCHAR", "source", "lang", n_chars, "text")
        return "sha256(" + " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"

    grown = "list_transform(range(1, len(hs) + 1, 2), lambda i: sha256(hs[i] || coalesce(hs[i + 1], '')))"
    sibling = "coalesce(hs[xor(place, 1) + 1], '')"
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS grp, {leaf("n_chars::VARCHAR")} AS leaf,
         CASE WHEN {crc32("doc_id::VARCHAR")} % 7 = 0 THEN {leaf("(n_chars + 1)::VARCHAR")} ELSE {leaf("n_chars::VARCHAR")} END AS changed FROM {docs}),
p AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS pos FROM d),
low AS (
  SELECT grp, 0 AS lvl, list(leaf ORDER BY pos) AS hs FROM p GROUP BY grp
  UNION ALL SELECT grp, lvl + 1, {grown} FROM low WHERE len(hs) > 1),
sub AS (SELECT grp, hs[1] AS subroot, lvl AS depth, row_number() OVER (ORDER BY grp) - 1 AS nth FROM low WHERE len(hs) = 1),
top AS (
  SELECT 0 AS lvl, list(subroot ORDER BY nth) AS hs FROM sub
  UNION ALL SELECT lvl + 1, {grown} FROM top WHERE len(hs) > 1),
root AS (SELECT hs[1] AS root, lvl AS height FROM top WHERE len(hs) = 1),
steps AS (
  SELECT pos_of.doc_id, low.lvl, pos_of.pos >> low.lvl AS place, low.hs FROM p AS pos_of JOIN low USING (grp) WHERE len(low.hs) > 1
  UNION ALL SELECT p.doc_id, sub.depth + top.lvl, sub.nth >> top.lvl, top.hs FROM p JOIN sub USING (grp) CROSS JOIN top WHERE len(top.hs) > 1),
paths AS (
  SELECT doc_id, list({{'left': CASE WHEN place & 1 = 1 THEN {sibling} ELSE '' END, 'right': CASE WHEN place & 1 = 0 THEN {sibling} ELSE '' END}} ORDER BY lvl) AS path
  FROM steps GROUP BY doc_id)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(path, lambda x: x.left || x.right), ''), '')) AS proof_sha256,
       list_reduce(list_prepend(changed, coalesce(list_transform(path, lambda x: x.left || '|' || x.right), [])),
                   lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2))) AS folded_root, folded_root = root AS verified
FROM p JOIN sub USING (grp) CROSS JOIN root LEFT JOIN paths USING (doc_id)"""


def trie(conversations: str = "conversations") -> str:
    """Prefixes as lists of texts (role and text, with the role's length)."""
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM {conversations} WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, list(strlen(r)::VARCHAR || ':' || r || x ORDER BY turn NULLS FIRST, sha256(strlen(r)::VARCHAR || ':' || r || x)) AS own,
         list(strlen(x) ORDER BY turn NULLS FIRST, sha256(strlen(r)::VARCHAR || ':' || r || x)) AS own_bytes FROM t GROUP BY conv_id),
h AS (SELECT *, {crc32("conv_id::VARCHAR")} % 9 AS h FROM turns),
built AS (
  SELECT h.conv_id, list_concat(coalesce(b.own, [])[1:h.h], h.own[h.h + 1:]) AS path,
         list_concat(coalesce(b.own_bytes, [])[1:h.h], h.own_bytes[h.h + 1:]) AS bytes
  FROM h LEFT JOIN turns b ON b.conv_id = h.conv_id - h.conv_id % 5),
rows AS (SELECT conv_id, path, bytes, unnest(range(len(path) + 1)) AS depth FROM built),
nodes AS (
  SELECT path[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(coalesce(bytes[depth], 0)) AS n_bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(path) = depth), '')) AS ends_sha256
  FROM rows GROUP BY path[1:depth], depth),
kids AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
whole AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (prefix)),
above AS (SELECT prefix[1:up] AS prefix, n_convs, n_bytes, n_children FROM (SELECT *, unnest(range(depth + 1)) AS up FROM whole)),
sums AS (SELECT prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * n_bytes)::BIGINT AS saved_tokens FROM above GROUP BY prefix)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, w.ends_sha256
FROM whole w JOIN sums USING (prefix) LEFT JOIN nodes p ON w.depth > 0 AND p.prefix = w.prefix[1:w.depth - 1]"""


def oracles() -> dict[str, str]:
    return {
        "op3_jaccard_join": jaccard(),
        "op5_mix_to_weights": mixing(),
        "op8_warc_chunks": archive(),
        "op9_exact_dedup": exact(),
        "op10_decontaminate": contamination(),
        "op11_merkle_midstates": merkle(),
        "op13_prefix_trie": trie(),
    }
