"""SQL for the queries that SQL can express, in the dialect of DuckDB."""

from __future__ import annotations

from tickloom.llm.quality import (
    BASE_REPEATS,
    BASE_WORDS,
    REPEAT_WINDOW,
    RULES,
    STOP_WORDS,
    Rule,
)
from tickloom.llm.sql_trees import MERKLE_SQL, TRIE_SQL

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def passes(rule: Rule) -> str:
    high = "" if rule.high is None else f" AND 100 * {rule.count} <= {rule.high} * {rule.of}"
    low = f"100 * {rule.count} >= {rule.low} * {rule.of}"
    return f"(n_words < {rule.from_words} OR ({low}{high}))"


def quality_sql(docs: str = "documents") -> str:
    """Counts of every text of a table or sub-query; joined by row, so ids may repeat."""
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    rules = " AND ".join(passes(r) for r in RULES)
    return f"""
    WITH t AS (SELECT row_number() OVER () AS k, * FROM {docs}),
    w AS (SELECT k, {WORDS} AS ws FROM t),
    u AS (SELECT k, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w),
    per_word AS (
        SELECT k, count(*) AS n_words, sum(length(w)) AS word_chars,
            count(*) FILTER (WHERE w IN ({stop})) AS n_stop_words,
            count(*) FILTER (WHERE regexp_matches(w, '\\p{{L}}')) AS n_letter_words
        FROM u GROUP BY k),
    grams AS (
        SELECT k, i, string_agg(w, ' ') OVER five AS g, count(*) OVER five AS c FROM u
        WINDOW five AS (PARTITION BY k ORDER BY i
            ROWS BETWEEN CURRENT ROW AND {REPEAT_WINDOW - 1} FOLLOWING)),
    twice AS (
        SELECT k, i FROM grams WHERE c = {REPEAT_WINDOW}
        QUALIFY count(*) OVER (PARTITION BY k, g) > 1),
    repeats AS (
        SELECT k, count(DISTINCT i + o) AS n_repeat_words
        FROM twice, range({REPEAT_WINDOW}) AS r(o) GROUP BY k),
    l AS (SELECT k, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM t),
    lines AS (
        SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
        FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY k),
    counts AS (
        SELECT t.*,
            coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
            (length(coalesce(text, ''))
                - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::BIGINT
                AS n_symbols,
            coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
            coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
            coalesce(n_lines, 0)::BIGINT AS n_lines,
            coalesce(n_stop_words, 0)::BIGINT AS n_stop_words,
            coalesce(n_letter_words, 0)::BIGINT AS n_letter_words
        FROM t LEFT JOIN per_word USING (k) LEFT JOIN repeats USING (k) LEFT JOIN lines USING (k)),
    judged AS (
        SELECT *, n_words < {BASE_WORDS} OR NOT {passes(BASE_REPEATS)} AS base_failed FROM counts)
    SELECT *, NOT base_failed AND {rules} AS kept FROM judged"""


def shingles_sql(table: str, name: str) -> str:
    """CTEs ``<name>_rows`` (k and the columns of a table) and ``<name>`` (k, s): the distinct
    shingles of each row."""
    folded = (
        "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    )
    return f"""
    {name}_rows AS (SELECT row_number() OVER () AS k, * FROM {table}),
    {name}_words AS (
        SELECT k, regexp_extract_all({folded}, '[^\x20\x09-\x0D]+') AS ws FROM {name}_rows),
    {name}_each AS (
        SELECT k, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM {name}_words),
    {name}_grams AS (
        SELECT k, n, i, string_agg(w, ' ') OVER (PARTITION BY k ORDER BY i
            ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS s FROM {name}_each),
    {name} AS (SELECT DISTINCT k, s FROM {name}_grams WHERE i = 1 OR i + 4 <= n)"""


def contaminated_sql(docs: str = "documents", items: str = "benchmark") -> str:
    return f"""
    WITH {shingles_sql(docs, "d")}, {shingles_sql(items, "b")},
    sizes AS (SELECT k, count(*) AS n FROM b GROUP BY k),
    pairs AS (
        SELECT d.k AS dk, b.k AS bk, count(*) AS shared FROM d JOIN b USING (s) GROUP BY d.k, b.k)
    SELECT doc_id, item_id, n AS n_item_shingles, shared AS n_shared, dk
    FROM pairs JOIN sizes ON bk = sizes.k JOIN d_rows ON dk = d_rows.k JOIN b_rows ON bk = b_rows.k
    WHERE 100 * shared >= 75 * n"""


def classes_sql(docs: str = "documents") -> str:
    """Links by an inverted index over whole sets, components by recursion."""
    return f"""
    WITH RECURSIVE {shingles_sql(docs, "d")},
    sizes AS (SELECT k, count(*) AS n FROM d GROUP BY k),
    pairs AS (
        SELECT a.k AS x, b.k AS y, count(*) AS shared FROM d a JOIN d b ON a.s = b.s AND a.k <> b.k
        GROUP BY a.k, b.k),
    linked AS (
        SELECT x, y FROM pairs JOIN sizes a ON x = a.k JOIN sizes b ON y = b.k
        WHERE 100 * shared >= 75 * (a.n + b.n - shared)),
    reached(k, r) AS (
        SELECT k, k FROM d_rows UNION SELECT reached.k, y FROM reached JOIN linked ON r = x)
    SELECT d_rows.k, any_value(d_rows.doc_id) AS doc_id,
        coalesce(any_value(sizes.n), 0)::BIGINT AS n_shingles, min(other.doc_id) AS component_id
    FROM reached JOIN d_rows USING (k) LEFT JOIN sizes USING (k) JOIN d_rows other ON r = other.k
    GROUP BY d_rows.k"""


ORACLES: dict[str, str] = {
    "op3_quality_rules": f"""
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
    FROM ({quality_sql()})""",
    "op1_decontamination": f"""
    SELECT doc_id, item_id, n_item_shingles, n_shared FROM ({contaminated_sql()})""",
    "op9_jaccard_join": f"""
    SELECT doc_id, n_shingles, component_id FROM ({classes_sql()})""",
    "op12_merkle_manifest": MERKLE_SQL,
    "op13_prefix_trie": TRIE_SQL,
}
