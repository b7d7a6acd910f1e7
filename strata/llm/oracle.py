"""SQL that states the result of those queries that SQL can express."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _bin(x: str) -> str:
    return (
        f"(CASE WHEN {x} < 64 THEN {x} ELSE "
        f"(length(bin({x})) - 6) * 32 + ({x} >> (length(bin({x})) - 6)) END)::BIGINT"
    )


def _start(b: str) -> str:
    return (
        f"(CASE WHEN {b} < 64 THEN {b} ELSE "
        f"({b} - ({b} // 32 - 1) * 32) << ({b} // 32 - 1)::INT END)"
    )


QUALITY = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents
), windows AS (
  SELECT k, p, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c
  FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS p FROM docs)
), again AS (
  SELECT k, p FROM (SELECT k, p, count(*) OVER (PARTITION BY k, a, b, c) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT k, count(DISTINCT p + d) AS n FROM again, (SELECT unnest([0, 1, 2]) AS d) GROUP BY k
), lines AS (
  SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k
), base AS (
  SELECT k, doc_id, lang, source, len(w)::BIGINT AS n_words,
    coalesce(length(array_to_string(w, '')), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines
  FROM docs LEFT JOIN lines USING (k) LEFT JOIN covered USING (k)
), rates AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END AS symbol_rate,
    CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_line_rate,
    CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words ELSE 0 END AS repeat_rate,
    CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END AS word_length
  FROM base
), long AS (
  SELECT lang, source, 'symbol_rate' AS rate, 20 AS slack, symbol_rate AS v FROM rates WHERE n_words > 0
  UNION ALL SELECT lang, source, 'dup_line_rate', 150, dup_line_rate FROM rates WHERE n_words > 0
  UNION ALL SELECT lang, source, 'repeat_rate', 130, repeat_rate FROM rates WHERE n_words > 0
  UNION ALL SELECT lang, source, 'word_length', 50, word_length FROM rates WHERE n_words > 0
), pairs AS (SELECT DISTINCT lang, source FROM long
), levels AS (
  SELECT 1 AS lvl, p.lang, p.source, rate, slack, v FROM pairs p JOIN long l
    ON p.lang IS NOT DISTINCT FROM l.lang AND p.source IS NOT DISTINCT FROM l.source
  UNION ALL SELECT 2, p.lang, p.source, rate, slack, v FROM pairs p JOIN long l ON p.lang IS NOT DISTINCT FROM l.lang
  UNION ALL SELECT 3, p.lang, p.source, rate, slack, v FROM pairs p, long l
), ordered AS (
  SELECT lvl, lang, source, rate, slack, {_start(_bin('v'))} AS v,
    row_number() OVER (PARTITION BY lvl, lang, source, rate ORDER BY v) AS r,
    count(*) OVER (PARTITION BY lvl, lang, source, rate) AS n
  FROM levels
), quartiles AS (
  SELECT lvl, lang, source, rate, slack, n, min(v) FILTER (r >= (n + 3) // 4) AS q1,
    min(v) FILTER (r >= (3 * n + 3) // 4) AS q3
  FROM ordered GROUP BY ALL
), fence AS (
  SELECT lang, source, rate, min_by(q1 - 3 * greatest(q3 - q1, slack), lvl) AS low,
    min_by(q3 + 3 * greatest(q3 - q1, slack), lvl) AS high
  FROM quartiles WHERE n >= 100 OR lvl = 3 GROUP BY ALL
), wide AS (
  SELECT lang, source, max(high) FILTER (rate = 'symbol_rate') AS s, max(high) FILTER (rate = 'dup_line_rate') AS d,
    max(high) FILTER (rate = 'repeat_rate') AS r, max(high) FILTER (rate = 'word_length') AS h,
    max(low) FILTER (rate = 'word_length') AS l
  FROM fence GROUP BY ALL
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(symbol_rate <= s AND dup_line_rate <= d AND repeat_rate <= r
    AND word_length BETWEEN l AND h, false) AS kept,
  symbol_rate::BIGINT AS symbol_rate, dup_line_rate::BIGINT AS dup_line_rate,
  repeat_rate::BIGINT AS repeat_rate, word_length::BIGINT AS word_length
FROM rates LEFT JOIN wide
  ON rates.lang IS NOT DISTINCT FROM wide.lang AND rates.source IS NOT DISTINCT FROM wide.source
"""

MIXING_CTE = rf"""
sizes AS (
  SELECT row_number() OVER () AS k, doc_id, source, len({_WORDS})::BIGINT AS size FROM {{docs}}
), per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source
), weighed AS (
  SELECT source, source_size, 3.0::DOUBLE * source_size AS stop,
    ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM per
), levels AS (
  SELECT *, row_number() OVER full_order AS o,
    (sum(source_size::DOUBLE) OVER () - coalesce(sum(stop) OVER before, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed
  WINDOW full_order AS (ORDER BY stop / weight, source NULLS LAST),
    before AS (ORDER BY stop / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
  SELECT source, source_size,
    least(stop, coalesce((min_by(level, o) FILTER (level * weight <= stop) OVER ()) * weight, stop)) AS target
  FROM levels
), ranks AS (
  SELECT k, doc_id, source, size, row_number() OVER (PARTITION BY source ORDER BY {_bin('size')},
    md5(coalesce(doc_id::VARCHAR, '')), doc_id NULLS FIRST, size) AS r
  FROM sizes
), copies AS (
  SELECT k, doc_id, ranks.source, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS e,
    ('0x' || substr(md5('7|' || coalesce(ranks.source, '')), 1, 5))::BIGINT / 1048576.0::DOUBLE AS u, r
  FROM ranks JOIN chosen ON ranks.source IS NOT DISTINCT FROM chosen.source
)"""

MIXING = f"""
WITH {MIXING_CTE.format(docs='documents')}
SELECT doc_id, source, size, source_size, target,
  (floor(e * r + u) - floor(e * (r - 1) + u))::BIGINT AS copies,
  (floor(e * r + u) - floor(e * (r - 1) + u))::BIGINT * size AS taken
FROM copies
"""

_BITS = "".join(f"{i:04b}" for i in range(16))

WARC = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages
), newest AS (
  SELECT *, max(page_id) OVER (PARTITION BY sha) AS newest FROM p
), bits AS (
  SELECT *, array_to_string(list_transform(range(40),
    lambda i: substr('{_BITS}', (4 * (position(sha[(i + 1)::INT] IN '0123456789abcdef') - 1) + 1)::INT, 4)), '') AS b
  FROM newest
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 + ('0b' || substr(b, (5 * i + 1)::INT, 5))::INT), 1)), '')
    AS payload_digest,
  CASE WHEN newest IS NULL OR page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = newest THEN NULL ELSE newest END AS refers_to,
  true AS intact
FROM bits
"""


def _crc32(x: str) -> str:
    """Unsigned CRC-32 of the digits of ``x``, bit by bit."""
    digits = f"list_transform(string_split(({x})::VARCHAR, ''), lambda d: ascii(d)::BIGINT)"
    bits = "lambda r, z: xor(r >> 1, (r & 1) * 3988292384)"
    step = f"lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), {bits})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), {step}), 4294967295)"


def _framed(x: str) -> str:
    return f"coalesce(strlen(({x})::VARCHAR)::VARCHAR || ':' || ({x})::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_framed, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _tree(name: str, levels: int) -> str:
    """Levels of trees over ``{name}0`` (tree, pos, n, digest), with what stands left and right of each node in its run."""
    out = []
    for k in range(levels):
        run = "(PARTITION BY tree, pos // 8 ORDER BY pos ROWS BETWEEN"
        out.append(
            f"{name}s{k} AS (SELECT *, coalesce(string_agg(digest, '') OVER {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, "
            f"coalesce(string_agg(digest, '') OVER {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k} WHERE n > 1)"
        )
        out.append(
            f"{name}{k + 1} AS (SELECT tree, pos // 8 AS pos, (n + 7) // 8 AS n, sha256(string_agg(digest, '' ORDER BY pos)) "
            f"AS digest FROM {name}{k} WHERE n > 1 GROUP BY ALL)"
        )
    union = " UNION ALL ".join(f"SELECT tree, digest FROM {name}{k} WHERE n = 1" for k in range(levels + 1))
    return ", ".join([*out, f"{name}root AS ({union})"])


def _climb(name: str, levels: int) -> str:
    """From ``{name}f0`` (leafs' tree, pos, node, proof) up the levels of :func:`_tree`."""
    return ", ".join(
        f"{name}f{k + 1} AS (SELECT f.* EXCLUDE (node, proof), CASE WHEN l IS NULL THEN node ELSE sha256(l || node || r) END AS node, "
        f"proof || coalesce(l || r, '') AS proof FROM {name}f{k} f LEFT JOIN {name}s{k} s "
        f"ON f.tree IS NOT DISTINCT FROM s.tree AND f.pos // {8**k} = s.pos)"
        for k in range(levels)
    )


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MERKLE = f"""
WITH docs AS (
  SELECT doc_id, lang AS tree, {_leaf('text')} AS leaf,
    CASE WHEN {_crc32('coalesce(doc_id, 0)')} % 3 = 0 AND doc_id IS NOT NULL
      THEN {_leaf(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} END AS changed
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY tree) AS n FROM docs
), a0 AS (SELECT tree, pos, n, leaf AS digest FROM placed
), {_tree('a', 8)},
b0 AS (SELECT 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, digest, tree AS lang FROM aroot
), {_tree('b', 5)},
af0 AS (SELECT doc_id, tree, pos, leaf, coalesce(changed, leaf) AS node, '' AS proof FROM placed
), {_climb('a', 8)},
bf0 AS (
  SELECT f.doc_id, f.leaf, b.digest AS subroot, b.tree, b.pos, node, proof FROM af8 f JOIN b0 b ON f.tree IS NOT DISTINCT FROM b.lang
), {_climb('b', 5)}
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = digest AS verified
FROM bf5, broot
"""

TRIE = f"""
WITH t AS (
  SELECT conv_id, turn, strlen(text) AS bytes, substr(sha256(strlen(role)::VARCHAR || ':' || role || text), 1, 32) AS key
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) - 1 AS pos FROM t
), convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS first, {_crc32('conv_id')} % 9 AS h FROM t GROUP BY conv_id
), lent AS (
  SELECT c.conv_id, pos + 1 AS depth, key, bytes FROM convs c JOIN placed p ON p.conv_id = c.first AND pos < h
), taken AS (SELECT conv_id, count(depth) AS n FROM convs LEFT JOIN lent USING (conv_id) GROUP BY conv_id
), turns AS (
  SELECT * FROM lent UNION ALL
  SELECT p.conv_id, n + pos - h + 1, key, bytes FROM placed p JOIN convs USING (conv_id) JOIN taken USING (conv_id) WHERE pos >= h
), paths AS (
  SELECT conv_id, coalesce(list(key ORDER BY depth) FILTER (key IS NOT NULL), []) AS path FROM convs LEFT JOIN turns USING (conv_id) GROUP BY conv_id
), members AS (
  SELECT conv_id, d AS depth, len(path) AS length, array_to_string(path[1:d], ',') AS node,
    CASE WHEN d > 0 THEN array_to_string(path[1:d - 1], ',') END AS parent
  FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM paths)
), nodes AS (
  SELECT m.depth, node, parent, min(m.conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id) FILTER (length = m.depth), '')) AS ends_sha256
  FROM members m LEFT JOIN turns USING (conv_id, depth) GROUP BY m.depth, node, parent
), children AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), own AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * bytes ELSE 0 END AS own_saved
  FROM nodes LEFT JOIN children USING (depth, node)
), below AS (
  SELECT m.depth, m.node, sum(own_saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM own JOIN members m ON own.conv_id = m.conv_id AND m.depth <= own.depth GROUP BY ALL
)
SELECT o.conv_id, o.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves, saved_tokens, o.ends_sha256
FROM own o JOIN below USING (depth, node) LEFT JOIN nodes p ON o.depth = p.depth + 1 AND o.parent = p.node
"""

ORACLE = {"op8_warc": WARC, "op1_quality": QUALITY, "op5_mixing": MIXING, "op12_merkle": MERKLE, "op13_prefixtrie": TRIE}
