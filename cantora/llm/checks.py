"""DuckDB SQL equal to the queries of this package, written apart from their code."""

from __future__ import annotations


def hilbert_sql() -> str:
    """Skilling's transform for three axes of five bits, one SELECT layer per step."""
    layers = ["""
      SELECT doc_id, lang, source, size, text_crc32,
        CAST(floor((dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1) * 32
          // (SELECT count(*) FROM (SELECT DISTINCT lang FROM documents))) AS BIGINT) AS x0,
        CAST(floor((dense_rank() OVER (ORDER BY source NULLS FIRST) - 1) * 32
          // (SELECT count(*) FROM (SELECT DISTINCT source FROM documents))) AS BIGINT) AS x1,
        CAST(least(31, floor(2 * log2(greatest(size, 64))) - 12) AS BIGINT) AS x2
      FROM sized"""]
    keep = "doc_id, lang, source, size, text_crc32"
    for q in (16, 8, 4, 2):
        p = q - 1
        for i in range(3):
            if i == 0:
                cols = [f"CASE WHEN x0 & {q} > 0 THEN xor(x0, {p}) ELSE x0 END AS x0", "x1", "x2"]
            else:
                swap = f"(xor(x0, x{i}) & {p})"
                cols = [f"CASE WHEN x{i} & {q} > 0 THEN xor(x0, {p}) ELSE xor(x0, {swap}) END AS x0"] + [
                    f"CASE WHEN x{i} & {q} > 0 THEN x{i} ELSE xor(x{i}, {swap}) END AS x{i}" if j == i else f"x{j}"
                    for j in (1, 2)
                ]
            layers.append(f"SELECT {keep}, {', '.join(cols)} FROM l{len(layers) - 1}")
    layers.append(f"SELECT {keep}, x0, xor(x0, x1) AS x1, x2 FROM l{len(layers) - 1}")
    layers.append(f"SELECT {keep}, x0, x1, xor(x1, x2) AS x2 FROM l{len(layers) - 1}")
    turn = "0"
    for q in (16, 8, 4, 2):
        turn = f"xor({turn}, CASE WHEN x2 & {q} > 0 THEN {q - 1} ELSE 0 END)"
    layers.append(f"SELECT {keep}, x0, x1, x2, {turn} AS t FROM l{len(layers) - 1}")
    bits = " + ".join(f"((xor(x{i}, t) >> {b}) & 1) * {1 << (3 * b + 2 - i)}" for b in range(5) for i in range(3))
    layers.append(f"SELECT {keep}, {bits} AS hilbert FROM l{len(layers) - 1}")
    ctes = ",\n".join(f"l{n} AS ({s})" for n, s in enumerate(layers))
    return f"WITH sized AS (SELECT doc_id, lang, source, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, NULL AS text_crc32 FROM documents), {ctes} SELECT * FROM l{len(layers) - 1}"


#: Hosts and paths of the pages, their links, the groups these make, and the verdicts.
OP10 = """
WITH RECURSIVE parsed AS (
  SELECT page_id, url, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), split AS (
  SELECT page_id, html,
    translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parsed
), rules(rule, verdict, rhost, rpath) AS (
  VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
         ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')
), pairs AS (
  SELECT DISTINCT host, path FROM split
), best AS (
  SELECT p.host, p.path, r.rule, r.verdict,
    row_number() OVER (PARTITION BY p.host, p.path ORDER BY length(r.rule) DESC, r.rule) AS n
  FROM pairs p JOIN rules r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath)
)
SELECT s.page_id, s.host, s.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM split s LEFT JOIN best b ON s.host = b.host AND s.path = b.path AND b.n = 1
""".replace("WITH RECURSIVE", "WITH")


#: All phrases of all pieces are counted, then cut, compared with longer ones and ranked.
OP13 = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS phrase
  FROM worded, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k
), f AS (
  SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100
), kept AS (
  SELECT * FROM f p WHERE k >= 2 AND NOT EXISTS (
    SELECT 1 FROM f q WHERE q.lang = p.lang AND q.k > p.k AND 100 * q.a >= 100 * p.a
      AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' '))
), cuts AS (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM kept
), scored AS (
  SELECT c.lang, c.phrase, c.a, l.a AS l, r.a AS r, t.n,
    CAST((1000::HUGEINT * c.a * t.n) // (l.a::HUGEINT * r.a) AS BIGINT) AS score, c.cut
  FROM cuts c JOIN totals t USING (lang)
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:c.cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1:], ' ')
), weakest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM scored
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM weakest WHERE nth = 1
)
SELECT * FROM ranked WHERE rank <= 2000
"""


#: Rebuilt conversations as lists of turn digests; nodes and their descendants by the paths of their smallest members.
OP11 = """
WITH bits AS (
  SELECT list_transform(range(0, 256), lambda b: list_reduce([b] || range(0, 8),
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
), own AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), members AS (
  SELECT c, c - c % 100 AS base, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda s, b: xor(s >> 8, crc[(xor(s, b) & 255) + 1])), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM own), bits
), counted AS (
  SELECT m.*, least(h, coalesce(n, 0)) AS heads FROM members m LEFT JOIN (SELECT c AS base, count(*) AS n FROM own GROUP BY c) USING (base)
), turns AS (
  SELECT m.c, o.pos - m.h + m.heads AS d, role, text FROM counted m JOIN own o ON o.c = m.c AND o.pos > m.h
  UNION ALL
  SELECT m.c, o.pos, role, text FROM counted m JOIN own o ON o.c = m.base AND o.pos <= m.h
), paths AS (
  SELECT c, d, length(text) AS size,
    string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY d) AS key
  FROM turns
  UNION ALL
  SELECT c, 0, 0, '' FROM members
), nodes AS (
  SELECT d, key, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size FROM paths GROUP BY d, key
), kids AS (
  SELECT d - 1 AS d, left(key, -32) AS key, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), valued AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * size AS saved
  FROM nodes n LEFT JOIN kids USING (d, key)
), sums AS (
  SELECT p.d, p.key, sum(v.leaf) AS n_leaves, sum(v.saved) AS saved_tokens
  FROM valued v JOIN paths p ON p.c = v.conv_id AND p.d <= v.d GROUP BY p.d, p.key
), ends AS (
  SELECT d, key, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids
  FROM (SELECT * FROM paths QUALIFY d = max(d) OVER (PARTITION BY c)) GROUP BY d, key
)
SELECT v.conv_id, v.d::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM valued v JOIN sums USING (d, key) LEFT JOIN ends USING (d, key)
LEFT JOIN nodes p ON v.d > 0 AND p.d = v.d - 1 AND p.key = left(v.key, -32)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op11_prefix_trie": OP11,
        "op13_collocations": OP13,
        "op10_redirect_filter": OP10,
    }
