"""The fusion fits in SQL: Newton steps as a recursive query, each solving its system by elimination."""

from __future__ import annotations

D = 4          # columns and intercept
STEPS = 14

ROWS = """
docs AS (SELECT doc_id, text, n_chars, toxic y, doc_id // 6 subject, doc_id // 3 hadm FROM documents JOIN labels USING (doc_id)),
train AS (SELECT *, ntile(5) OVER (ORDER BY doc_id) - 1 chunk FROM docs WHERE subject % 5 <> 0),
prior AS (SELECT avg(y) rate FROM train),
design AS (SELECT chunk, hadm, y, n_chars / (n_chars + 2000.0::DOUBLE) x1,
             CASE WHEN doc_id % 7 <> 0 AND text IS NOT NULL THEN (length(text) - length(replace(text, 'e', ''))) / (length(text) + 1.0::DOUBLE)
                  ELSE rate END x2, CAST(doc_id % 7 <> 0 AND text IS NOT NULL AS INTEGER) x3, 1 x4 FROM train, prior),
fits AS (SELECT unnest([0, 1, 2, 3, 4]) fold),
member AS (SELECT fold, x1, x2, x3, x4, y FROM design d, fits WHERE fold = 0 OR (chunk < fold AND NOT EXISTS
             (SELECT 1 FROM design v WHERE v.chunk = fold AND v.hadm = d.hadm))),
size AS (SELECT fold, count(*) n, sum(y) k FROM member GROUP BY fold),
weighed AS (SELECT m.*, CASE WHEN y = 1 THEN n / (2.0::DOUBLE * k) ELSE n / (2.0::DOUBLE * (n - k)) END w FROM member m JOIN size USING (fold))"""


def _sums() -> str:
    """Hessian and right side at the coefficients of a step."""
    p = "1 / (1 + exp(-(" + " + ".join(f"b{i} * x{i}" for i in range(1, D + 1)) + ")))"
    cells = [f"sum(w * p * (1 - p) * x{i} * x{j}) + {int(i == j)} a{i}{j}" for i in range(1, D + 1) for j in range(1, D + 1)]
    cells += [f"sum(w * (y - p) * x{i}) - any_value(b{i}) a{i}{D + 1}" for i in range(1, D + 1)]
    b = ", ".join(f"any_value(b{i}) b{i}" for i in range(1, D + 1))
    return f"SELECT fold, step, {b}, {', '.join(cells)} FROM (SELECT *, {p} p FROM steps JOIN weighed USING (fold) WHERE step < {STEPS}) GROUP BY fold, step"


def _eliminated(inner: str, pivot: int) -> str:
    keep = ["fold", "step", *(f"b{i}" for i in range(1, D + 1))]
    for i in range(1, D + 1):
        for j in range(pivot + 1, D + 2):
            own = f"a{pivot}{j} / a{pivot}{pivot}"
            keep.append(f"{own} a{i}{j}" if i == pivot else f"a{i}{j} - a{i}{pivot} * ({own}) a{i}{j}")
    return f"SELECT {', '.join(keep)} FROM ({inner})"


def sql() -> str:
    solved = _sums()
    for pivot in range(1, D + 1):
        solved = _eliminated(solved, pivot)
    zero = ", ".join(f"0.0::DOUBLE b{i}" for i in range(1, D + 1))
    moved = ", ".join(f"b{i} + a{i}{D + 1} b{i}" for i in range(1, D + 1))
    names = ", ".join(f"round(b{i}, 6) + 0.0 {n}" for i, n in enumerate(("b_tab", "b_text", "b_flag", "b_one"), 1))
    return f"""WITH RECURSIVE {ROWS},
steps AS (SELECT fold, 0 step, {zero} FROM size UNION ALL SELECT fold, step + 1 step, {moved} FROM ({solved}))
SELECT fold fold_id, n n_train, CAST(k AS BIGINT) n_pos, {names}, true at_optimum FROM steps JOIN size USING (fold) WHERE step = {STEPS}"""
