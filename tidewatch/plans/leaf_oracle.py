"""Penalised leaf values in SQL: one table per tree and Newton step."""

from __future__ import annotations


def sql(trees: int, iterations: int, l2: float, rate: float, leaf: str) -> str:
    """leaf: expression of a row's leaf in tree `t`."""
    leaves = ", ".join(f"{leaf.format(t=t)} AS leaf{t}" for t in range(trees))
    parts = [f"""docs AS (SELECT toxic y, n_chars, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals FROM documents JOIN labels USING (doc_id)),
size AS (SELECT count(*) n, sum(y) k FROM docs),
rows0 AS (SELECT y, CASE WHEN y = 1 THEN (n - k) / k::DOUBLE ELSE 1 END w, 0.0::DOUBLE score, {leaves} FROM docs, size)"""]
    for t in range(trees):
        before = None
        for i in range(iterations):
            old = "0.0" if before is None else f"coalesce({before}.v, 0)"
            join = "" if before is None else f"LEFT JOIN {before} ON {before}.leaf = leaf{t}"
            parts.append(f"""v{t}_{i} AS (SELECT leaf{t} leaf, any_value(old) + sum(w * (y - p)) / (sum(w * p * (1 - p)) + {l2}) v FROM
  (SELECT leaf{t}, y, w, old, 1 / (1 + exp(-(score + old))) p FROM (SELECT leaf{t}, y, w, score, {old} old FROM rows{t} {join})) GROUP BY leaf{t})""")
            before = f"v{t}_{i}"
        kept = ", ".join(f"leaf{s}" for s in range(trees))
        parts.append(f"rows{t + 1} AS (SELECT y, w, score + {rate} * v score, {kept} FROM rows{t} JOIN {before} ON {before}.leaf = leaf{t})")
    chosen = " UNION ALL ".join(f"SELECT {t} AS tree, CAST(leaf AS INTEGER) AS leaf, round({rate} * v, 9) + 0.0 AS leaf_value FROM v{t}_{iterations - 1}" for t in range(trees))
    return f"WITH {', '.join(parts)} {chosen}"
