"""The token-set similarity in DuckDB, for checking ours: rows of a CTE ``pairs`` (id, a, b; normalised) to scores."""

from __future__ import annotations

_NEXT = """list_transform(range(1, len(r) + 1), lambda j: CASE WHEN j = 1 THEN 0::BIGINT ELSE
    greatest(r[j], list_max(list_transform(range(2, j + 1), lambda k: r[k - 1] + (ord(y[k - 1]) = c[1])::BIGINT))) END)"""
_WORDS = "list_distinct(list_filter(string_split({0}, ' '), lambda w: w <> ''))"

#: CTEs from ``pairs`` to ``scored`` (id, score): null where a or b is null, 0 where one has no words.
SCORED = f"""
    sets AS (SELECT DISTINCT a, b, {_WORDS.format("a")} AS ta, {_WORDS.format("b")} AS tb FROM pairs WHERE a IS NOT NULL AND b IS NOT NULL),
    parts AS (SELECT a, b, len(ta) = 0 OR len(tb) = 0 AS none, array_to_string(list_sort(list_filter(ta, lambda w: list_contains(tb, w))), ' ') AS shared,
        array_to_string(list_sort(list_filter(ta, lambda w: NOT list_contains(tb, w))), ' ') AS x,
        array_to_string(list_sort(list_filter(tb, lambda w: NOT list_contains(ta, w))), ' ') AS y FROM sets),
    common AS (SELECT *, CASE WHEN shared = '' THEN 0 ELSE 1 END AS gap, length(shared) AS s, length(x) AS lx, length(y) AS ly,
        list_reduce(list_prepend(list_transform(range(0, length(y) + 1), lambda i: 0::BIGINT), list_transform(string_split(x, ''), lambda l: [ord(l)::BIGINT])),
            lambda r, c: {_NEXT})[-1] AS lcs FROM parts),
    rates AS (SELECT a, b, CASE WHEN none THEN 0 WHEN shared <> '' AND (x = '' OR y = '') THEN 1
        WHEN shared = '' THEN 1 - (lx + ly - 2 * lcs) / (lx + ly)::DOUBLE
        ELSE greatest(1 - (lx + ly - 2 * lcs) / (2 * s + 2 * gap + lx + ly)::DOUBLE, 1 - (gap + lx) / (2 * s + gap + lx)::DOUBLE, 1 - (gap + ly) / (2 * s + gap + ly)::DOUBLE) END AS rate FROM common),
    scored AS (SELECT id, CAST(round_even(rate * 10000, 0) AS DOUBLE) / 10000 AS score FROM pairs LEFT JOIN rates USING (a, b))"""
