"""Hashed terms, their weights and the start of the text fits in SQL."""

from __future__ import annotations

from tidewatch.plans import newton_oracle

BUCKETS = 1 << 20

TERMS = rf"""
words AS (SELECT doc_id, regexp_extract_all(strip_accents(lower(coalesce(text, ''))), '[\p{{L}}\p{{N}}_]{{2,}}') AS w FROM documents),
grams AS (SELECT doc_id, unnest(w) AS term FROM words UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words),
counts AS (SELECT doc_id, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % {BUCKETS} AS bucket, 1.0::DOUBLE + ln(count(*)) AS tf FROM grams GROUP BY ALL)"""

SCORE = f"""
WITH {TERMS},
idf AS (SELECT bucket, ln((1.0::DOUBLE + (SELECT count(*) FROM documents)) / (1.0::DOUBLE + count(*))) + 1.0 AS idf FROM counts GROUP BY bucket),
sums AS (SELECT doc_id, sum(tf * idf * ((bucket * 37 % 101 - 50) / 25.0::DOUBLE)) / sqrt(sum(tf * idf * tf * idf)) AS z FROM counts JOIN idf USING (bucket) GROUP BY doc_id)
SELECT doc_id, round(1 / (1 + exp(-(coalesce(z, 0) + 0.25::DOUBLE))), 9) AS p_text FROM documents LEFT JOIN sums USING (doc_id)"""

START = f"""
WITH {newton_oracle.ROWS}, {TERMS},
folded AS (SELECT t.doc_id, fold, y FROM train t, fits WHERE fold = 0 OR (chunk < fold AND NOT EXISTS
  (SELECT 1 FROM train v WHERE v.chunk = fold AND v.hadm = t.hadm))),
slope AS (SELECT fold, doc_id, 2.0::DOUBLE * CASE WHEN y = 1 THEN -n / (4.0::DOUBLE * k) ELSE n / (4.0::DOUBLE * (n - k)) END AS slope
  FROM folded JOIN size USING (fold)),
used AS (SELECT fold, bucket, n, count(*) AS df FROM folded JOIN counts USING (doc_id) JOIN size USING (fold) GROUP BY ALL),
raw AS (SELECT fold, doc_id, bucket, tf * (ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0) AS x FROM folded JOIN counts USING (doc_id) JOIN used USING (fold, bucket)),
norms AS (SELECT fold, doc_id, sqrt(sum(x * x)) AS norm FROM raw GROUP BY ALL),
gradient AS (SELECT fold, bucket, sum(slope * x / norm) AS g FROM raw JOIN norms USING (fold, doc_id) JOIN slope USING (fold, doc_id) GROUP BY ALL)
SELECT fold AS fold_id, any_value(n) AS n_train, CAST(any_value(k) AS BIGINT) AS n_pos, count(*) AS n_buckets, round(sqrt(sum(g * g)), 6) AS start_norm,
  round(max(abs(g)), 6) AS start_largest, true AS at_optimum FROM gradient JOIN size USING (fold) GROUP BY fold"""
