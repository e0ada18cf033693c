"""Fitted models on labelled documents. SQL states what the fusion and the tree sums come to; the other queries are checked by
properties in the tests."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.keys import row_id
from tidewatch.operators import categories, hashed_text, metrics, newton, staged
from tidewatch.operators import models as MO
from tidewatch.operators.folds import time_chunks, training_folds, with_group_chunks
from tidewatch.plans import catalog, leaf_oracle, newton_oracle, text_oracle
from tidewatch.plans.stacking import evaluate, fuse_inputs, level_one, stack
from tidewatch.sources.storage import fresh_path, stage
from tidewatch.sources.tables import load

query = catalog.query
TABULAR, CATEGORIES = ["n_chars", "lines", "capitals"], ["lang", "source"]


def rows(spark, d) -> DataFrame:
    """Labelled documents as risk rows: subjects of six, admissions of three, half-hourly times, a train/test split."""
    docs = load(spark, d, "documents").join(load(spark, d, "labels"), "doc_id")
    t = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), (F.col("doc_id") * 30).cast("int"))
    out = docs.select(
        F.floor(F.col("doc_id") / 6).alias("subject_id"), F.floor(F.col("doc_id") / 3).alias("hadm_id"),
        F.col("doc_id").alias("icustay_id"), t.alias("t"), F.col("toxic").alias("label6h"), "text", "lang", "source",
        "n_chars", F.regexp_count("text", F.lit("\n")).alias("lines"), F.regexp_count("text", F.lit("[A-Z]")).alias("capitals"))
    return out.withColumn("row_id", row_id(["subject_id", "hadm_id", "icustay_id"], "t")).withColumn(
        "split", F.when(F.pmod("subject_id", F.lit(5)) == 0, "test").otherwise("train"))


def split(spark, d) -> tuple[DataFrame, DataFrame]:
    both = stage(rows(spark, d), "rows")
    return both.filter("split = 'train'"), both.filter("split = 'test'")


def gbt() -> MO.Fit:
    return MO.gbt_classifier(TABULAR, CATEGORIES, patience=120, maxIter=2000, maxDepth=6)


def text_model() -> MO.Fit:
    return MO.text_logistic("text")


def fusion_lr(columns) -> MO.Fit:
    return MO.fusion_logistic(columns)


def fusion_nn(columns) -> MO.Fit:
    return MO.fusion_mlp(columns)


KEYS = ["row_id", "hadm_id", "t", "label6h"]


@query("gbt_oof")
def gbt_oof(spark, d):
    return level_one(split(spark, d)[0], gbt(), "t", "row_id", "hadm_id").select(*KEYS, "p_tab", "fold_id")


TREES = 40
STAND_IN_TREES = f"transform(sequence(0, {TREES - 1}), t -> ((n_chars * (t + 1) + capitals) % 7 - 3) / 64D + if(lines % (t + 2) = 0, 0.125D, 0D))"


@query("best_trees", f"""
WITH docs AS (SELECT doc_id, toxic y, n_chars, length(text) - length(replace(text, chr(10), '')) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals
              FROM documents JOIN labels USING (doc_id)),
parts AS (SELECT doc_id, y, t + 1 AS trees, ((n_chars * (t + 1) + capitals) % 7 - 3) / 64.0::DOUBLE + CASE WHEN n_lines % (t + 2) = 0 THEN 0.125::DOUBLE ELSE 0 END AS part
          FROM docs, range({TREES}) r(t)),
scores AS (SELECT trees, y, sum(part) OVER (PARTITION BY doc_id ORDER BY trees) AS score FROM parts),
counts AS (SELECT trees, score, sum(y) AS pos, count(*) AS n FROM scores GROUP BY trees, score),
ranked AS (SELECT trees, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS upto FROM counts WINDOW w AS (PARTITION BY trees ORDER BY score DESC)),
curve AS (SELECT trees, sum(pos * tp / upto) / sum(pos) AS ap FROM ranked GROUP BY trees),
seen AS (SELECT *, coalesce(ap > max(ap) OVER (ORDER BY trees ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS better FROM curve),
lasts AS (SELECT *, max(CASE WHEN better THEN trees END) OVER (ORDER BY trees) AS latest FROM seen),
lived AS (SELECT *, bool_and(trees - latest < 12) OVER (ORDER BY trees) AS live FROM lasts)
SELECT CAST(trees AS INTEGER) AS trees, round(ap, 9) AS average_precision, trees = (SELECT max(latest) FROM lived WHERE live) AS chosen FROM lived""")
def best_trees(spark, d):
    """Average precision after every number of trees, and the number kept with a patience of 12; what a tree adds is stated in SQL."""
    docs = stage(rows(spark, d).withColumn("parts", F.expr(STAND_IN_TREES)).select("label6h", "parts"), "tree-scores")
    return catalog.rounded(staged.with_choice(staged.prefix_average_precision(docs, "label6h"), 12))


LEAVES = "((n_chars * ({t} + 1) + capitals) % 8)"


@query("leaf_values", leaf_oracle.sql(3, 4, 3.0, 0.05, LEAVES))
def leaf_values(spark, d):
    """Leaf values of three trees, whose leaves SQL can state, with penalty 3 and four steps; positives weigh the class ratio."""
    docs = MO.weighted(rows(spark, d).withColumn("leaves", F.expr("array(" + ", ".join(f"int({LEAVES.format(t=t)})" for t in range(3)) + ")")), "label6h", "ratio")
    values = staged.refit_leaves(docs, "label6h", "leaves", "_weight")
    return catalog.rounded(spark.createDataFrame([(t, k, v) for t, tree in enumerate(values) for k, v in tree.items()], "tree int, leaf int, leaf_value double"))


TARGETS = """CASE WHEN y IS NULL THEN (coalesce(sum(y) OVER (PARTITION BY {c}), 0) + r) / (count(y) OVER (PARTITION BY {c}) + 1)
  ELSE (coalesce(sum(y) OVER {c}_before, 0) + r) / (count(y) OVER {c}_before + 1) END"""


@query("target_statistics", f"""
WITH docs AS (SELECT doc_id, CASE WHEN doc_id // 6 % 5 <> 0 THEN toxic END y, coalesce(lang, 'nan') lang, coalesce(source, 'nan') source,
  md5('42|' || doc_id) h FROM documents JOIN labels USING (doc_id)), prior AS (SELECT avg(y) r FROM docs)
SELECT doc_id AS icustay_id, {", ".join(f"round({TARGETS.format(c=c)}, 9) AS {c}_target" for c in CATEGORIES)} FROM docs, prior
WINDOW {", ".join(f"{c}_before AS (PARTITION BY {c} ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)" for c in CATEGORIES)}""")
def target_statistics(spark, d):
    """Categories as ordered label means; test rows see the labels of all training rows."""
    known = stage(rows(spark, d).select("icustay_id", *CATEGORIES, F.expr("if(split = 'train', label6h, null)").alias("y")), "categories")
    return catalog.rounded(categories.ordered_target_statistics(known, CATEGORIES, "y", "icustay_id"))


@query("text_lr_oof")
def text_lr_oof(spark, d):
    return level_one(split(spark, d)[0], text_model(), "t", "row_id", "hadm_id").select(*KEYS, "p_text", "fold_id")


@query("hashed_fit", text_oracle.START)
def hashed_fit(spark, d):
    """Text fits of every fold (fold 0: all rows) at 2^20 buckets: what they train on, their gradient at zero, and that they end at the
    optimum (no component of the gradient above 1e-7 of the weights' sum)."""
    train = rows(spark, d).filter("split = 'train'").select(*KEYS, "text")
    chunked = with_group_chunks(time_chunks(train, "t", "row_id"), "hadm_id")
    fits = hashed_text.text_fits(chunked, "text", "label6h", F.concat(F.array(F.lit(0)), training_folds(5)), buckets=text_oracle.BUCKETS)
    out = [(f.fit, f.rows, f.positives, f.terms, *f.start, f.at_optimum) for f in fits]
    return spark.createDataFrame(out, "fold_id int, n_train long, n_pos long, n_buckets long, start_norm double, start_largest double, "
                                      "at_optimum boolean").withColumns({c: F.round(c, 6) for c in ("start_norm", "start_largest")})


@query("hashed_score", text_oracle.SCORE)
def hashed_score(spark, d):
    """Every whole text by a shipped model whose coefficients SQL can state; the document frequencies are those of all texts."""
    docs = load(spark, d, "documents")
    counts = hashed_text.text_counts(docs.withColumn("y", F.lit(0)), "text", "y", F.array(F.lit(0)), text_oracle.BUCKETS, ["doc_id"])
    stated = np.append((np.arange(text_oracle.BUCKETS) * 37 % 101 - 50) / 25.0, 0.25)
    model = hashed_text.stated_fit(hashed_text.inverse_frequencies(counts, text_oracle.BUCKETS), stated)
    return catalog.rounded(hashed_text.score_counts(counts, [model], "p_text").select("doc_id", "p_text"))


def level_one_tables(spark, d) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Out-of-fold and test predictions of both models; rows whose text is missing have none of the text model."""
    train, test = split(spark, d)
    tab, known = gbt(), "text is not null"
    chunked = time_chunks(train.filter(known), "t", "row_id")
    text_oof, text_test = MO.oof_and_test(chunked, test.filter(known), text_model(), "hadm_id")
    tab_oof, tab_test = MO.oof_and_test(time_chunks(train, "t", "row_id"), test, tab, "hadm_id")
    return (
        stage(tab_oof.select(*KEYS, "p_tab"), "oof"),
        stage(text_oof.select("row_id", "p_text"), "oof"),
        stage(tab_test.select(*KEYS, "p_tab"), "tab-test"),
        stage(text_test.select("row_id", "p_text"), "text-test"),
    )


def _fused(spark, d, fusion) -> DataFrame:
    oof, test = stack(*level_one_tables(spark, d), fusion, "label6h", "t", "hadm_id")
    columns = ["row_id", "label6h", "p_fused"]
    return oof.select(*columns, F.lit("oof").alias("part")).unionByName(test.select(*columns, F.lit("test").alias("part")))


def level_one_stand_ins(spark, d) -> tuple[DataFrame, DataFrame]:
    """Level-one tables whose predictions SQL can state: a share of length, and a share of a letter that one row in seven lacks."""
    train = rows(spark, d).filter("split = 'train'")
    text = train.filter("pmod(icustay_id, 7) <> 0 and text is not null").select(
        "row_id", F.expr("regexp_count(text, 'e') / (length(text) + 1D)").alias("p_text"))
    return train.select(*KEYS, F.expr("n_chars / (n_chars + 2000D)").alias("p_tab")), text


@query("fusion_newton", newton_oracle.sql())
def fusion_newton(spark, d):
    """Fusion coefficients of every fold (fold 0: all rows), from one aggregate per Newton step over all of them."""
    tab, text = level_one_stand_ins(spark, d)
    tab = stage(tab, "stand-in")
    prior = metrics.class_weights(tab, "label6h").first()["rate"]
    fused = stage(time_chunks(fuse_inputs(tab, text, "p_text", prior), "t", "row_id"), "fused")
    chunked = with_group_chunks(fused, "hadm_id")
    fits = newton.newton_fits(chunked, ["p_tab", "p_text", "has_text"], "label6h", F.concat(F.array(F.lit(0)), training_folds(5)))
    out = [(f.fit, f.rows, f.positives, *[round(float(b), 6) + 0.0 for b in f.coefficients], f.gradient < 1e-6) for f in fits]
    return spark.createDataFrame(out, "fold_id int, n_train long, n_pos long, b_tab double, b_text double, b_flag double, b_one double, at_optimum boolean")


@query("fusion_lr")
def fusion_lr_query(spark, d):
    return _fused(spark, d, fusion_lr)


@query("fusion_mlp")
def fusion_mlp_query(spark, d):
    return _fused(spark, d, fusion_nn)


@query("stacked_eval")
def stacked_eval(spark, d):
    oof, test = stack(*level_one_tables(spark, d), fusion_lr, "label6h", "t", "hadm_id")
    return evaluate(oof, stage(test, "fused-test"), "p_fused", "label6h")


@query("model_roundtrip")
def model_roundtrip(spark, d):
    """A saved and reloaded model scores the held-out rows."""
    train, test = split(spark, d)
    scorer = MO.gbt_classifier(TABULAR, maxIter=3, maxDepth=3)(train)
    path = fresh_path(spark, "model")
    scorer.model.write().overwrite().save(path)
    scored = scorer(test)
    again = MO.gbt_scorer(PipelineModel.load(path), TABULAR)(test)
    return scored.select("row_id", F.col("p_tab").alias("p")).join(
        again.select("row_id", F.col("p_tab").alias("p_again")), "row_id")
