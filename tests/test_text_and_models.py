import datetime as dt
import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidewatch.operators import models as MO
from tidewatch.operators import staged
from tidewatch.operators import text as TX
from tidewatch.operators.folds import fold_train, time_chunks, training_folds, with_group_chunks
from tidewatch.operators.metrics import ranking_metrics
from tidewatch.operators.newton import newton_fits
from tidewatch.plans import catalog

T0 = dt.datetime(2150, 1, 1)


@pytest.mark.parametrize("width", [1, 2, 3, 100])
def test_text_lags_do_not_depend_on_buckets(spark, width):
    rng = random.Random(5)
    rows = [(k, t, rng.choice([None, f"n{k}-{t}"])) for k in range(3) for t in sorted(rng.sample(range(40), 15))]
    rows += [(9, 7, None)]
    df = spark.createDataFrame(rows, "k long, t long, text string").orderBy(F.rand(1))
    got = {(r.k, r.t): r.notes_combo for r in TX.text_lags(df, ["k"], "t", "text", F.floor(F.col("t") / width)).collect()}
    assert len(got) == len(rows)
    by_key = {}
    for k, t, s in rows:
        seen = by_key.setdefault(k, [])
        seen.append(s or "")
        last = ["", "", *seen][-3:]
        assert got[(k, t)] == " [SEP] ".join(last)


def test_tokens_and_pairs(spark):
    df = spark.createDataFrame([("Één test, a b_2 ÀÉ x",), ("",), ("one",)], "s string").select(TX.tokens("s").alias("w"))
    got = df.select("w", TX.unigrams_bigrams("w").alias("g")).collect()
    assert got[0].w == ["een", "test", "b_2", "ae"]
    assert got[0].g == ["een", "test", "b_2", "ae", "een test", "test b_2", "b_2 ae"]
    assert (got[1].g, got[2].g) == ([], ["one"])


def test_vector_tfidf_equals_term_tfidf(spark):
    texts = [(1, "red fish blue fish"), (2, "red red red"), (3, "one fish")]
    df = spark.createDataFrame(texts, "id long, text string")
    counts = TX.term_counts(df, "id", "text")
    terms = {}
    for r in TX.tfidf(counts, TX.fit_idf(counts, 3), "id").collect():
        terms.setdefault(r.id, []).append(r.weight)
    hashed = MO.hashed_ngrams(df, "text")
    for r in MO.fit_hashed_tfidf(hashed)(hashed).collect():
        assert sorted(r.features.values) == pytest.approx(sorted(terms[r.id]))
    assert sum(w * w for w in terms[2]) == pytest.approx(1.0)
    raw = (1 + math.log(3)) * (math.log(4 / 3) + 1), (1 + math.log(2)) * (math.log(4 / 2) + 1)
    assert max(terms[2]) == pytest.approx(max(raw) / math.hypot(*raw))


def newton(X, y, w, C, penalise_last=True):
    beta = np.zeros(X.shape[1])
    reg = np.eye(X.shape[1])
    if not penalise_last:
        reg[-1, -1] = 0
    for _ in range(50):
        p = 1 / (1 + np.exp(-X @ beta))
        grad = reg @ beta + C * X.T @ (w * (p - y))
        beta -= np.linalg.solve(reg + C * (X * (w * p * (1 - p))[:, None]).T @ X, grad)
    return beta


@pytest.fixture(scope="module")
def fused_rows():
    rng = np.random.default_rng(3)
    X = rng.random((300, 2))
    y = (rng.random(300) < 1 / (1 + np.exp(-(4 * X[:, 0] - 3)))).astype(int)
    return X, y


def test_logistic_models_solve_the_stated_objective(spark, fused_rows):
    X, y = fused_rows
    rows = [(float(a), float(b), int(c)) for (a, b), c in zip(X, y)]
    df = spark.createDataFrame(rows, "a double, b double, label6h int")
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    ones = np.c_[X, np.ones(len(y))]
    model = MO.fusion_logistic(["a", "b"])(df).model
    assert model.coefficients == pytest.approx(newton(ones, y, w, 1.0), abs=1e-8) and model.gradient < 1e-6
    vectors = spark.createDataFrame([(Vectors.dense(r[:2]), r[2]) for r in rows], ["features", "label6h"])
    free = MO.weighted_logistic(vectors, "features", "label6h", 2.0, tol=1e-10)
    assert [*free.coefficients, free.intercept] == pytest.approx(newton(ones, y, w, 2.0, False), abs=1e-3)


@pytest.fixture(scope="module")
def risk(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        y = int(rng.random() < 0.25)
        word = "alarm pressure falling" if y else "stable quiet night"
        rows.append((i, i // 4, T0 + dt.timedelta(hours=i), y, y + rng.gauss(0, 0.7), rng.choice([None, 1.0]),
                     rng.choice(["f", "m", None]), f"{word} {rng.choice(['note', 'entry', 'report'])}"))
    df = spark.createDataFrame(
        rows, "i long, hadm_id long, t timestamp_ntz, label6h int, x double, gap double, sex string, text string")
    return df.withColumn("row_id", F.md5(F.col("i").cast("string"))).cache()


def test_oof_is_time_ordered_disjoint_and_repeatable(spark, risk):
    chunks = time_chunks(risk, "t", "row_id")
    fit = MO.gbt_classifier(["x", "gap"], ["sex"], maxIter=3, maxDepth=2)
    a = MO.oof_predict(chunks, fit, "hadm_id").select("row_id", "p_tab", "fold_id", "chunk", "label6h")
    b = MO.oof_predict(chunks, fit, "hadm_id").select("row_id", F.col("p_tab").alias("q"))
    both = a.join(b, "row_id").collect()
    assert len(both) == 320 and {r.fold_id for r in both} == {1, 2, 3, 4}
    assert all(r.fold_id == r.chunk and abs(r.p_tab - r.q) < 1e-12 for r in both)
    assert ranking_metrics(a, "p_tab", "label6h").first().auroc > 0.7


def test_all_folds_at_once_equal_one_fit_per_fold(spark, risk):
    """Missing and infinite values count as zero; a fold's own fit has the same coefficients as the shared aggregate's."""
    odd = risk.withColumn("x", F.expr("CASE WHEN i % 50 = 0 THEN double('inf') WHEN i % 50 = 1 THEN NULL ELSE x END"))
    rows = with_group_chunks(time_chunks(odd, "t", "row_id"), "hadm_id").cache()
    fits = newton_fits(rows, ["x", "gap"], "label6h", training_folds(5))
    assert [f.fit for f in fits] == [1, 2, 3, 4]
    for f in fits:
        train = fold_train(rows, f.fit)
        alone = MO.fusion_logistic(["x", "gap"])(train).model
        assert f.rows == train.count() == alone.rows and f.gradient < 1e-6
        assert f.coefficients == pytest.approx(alone.coefficients, abs=1e-7)
    assert all(r.label6h is not None for r in rows.limit(1).collect())


def test_newton_with_one_class_no_rows_and_a_hard_start(spark):
    one = spark.createDataFrame([(0.5, 1), (1e4, 1), (-1e4, 1), (3.0, None)], "x double, y int")
    fit = newton_fits(one, ["x"], "y", F.array(F.lit(7)))[0]
    assert (fit.fit, fit.rows, fit.positives) == (7, 3, 3) and np.isfinite(fit.coefficients).all()
    assert newton_fits(one.limit(0), ["x"], "y", F.array(F.lit(7))) == []
    wide = spark.createDataFrame([(1e3 * (i % 5) - 2000.0, int(i % 5 > 2)) for i in range(50)], "x double, y int")
    assert newton_fits(wide, ["x"], "y", F.array(F.lit(1)))[0].gradient < 1e-3


def test_trees_are_cut_at_the_best_average_precision(spark, risk):
    train, validation = risk.filter("i % 3 > 0"), risk.filter("i % 3 = 0")
    scorer = MO.gbt_stopped(["x", "gap"], ["sex"], train, validation, maxIter=8, maxDepth=3, patience=3)
    whole = MO.gbt_scorer(scorer.model, ["x", "gap"], ["sex"])(validation).select("i", "p_tab").collect()
    inputs = MO.PipelineModel(scorer.model.stages[:-1]).transform(MO._tree_inputs(validation, ["x", "gap"], ["sex"]))
    parts = staged.tree_scores(scorer.model.stages[-1], inputs).cache()
    all_trees = {r.i: r.p for r in parts.select("i", staged.probability_after("parts", 8).alias("p")).collect()}
    assert all(all_trees[r.i] == pytest.approx(r.p_tab, abs=1e-12) for r in whole)
    curve = {r.trees: r.average_precision for r in staged.prefix_average_precision(parts, "label6h").collect()}
    for n in (1, 5, 8):
        alone = parts.withColumn("p", staged.probability_after("parts", n))
        assert curve[n] == pytest.approx(ranking_metrics(alone, "p", "label6h").first().average_precision, abs=1e-12)
    assert curve[scorer.trees] == max(curve[n] for n in range(1, scorer.trees + 3) if n in curve)
    got = {r.i: r.p_tab for r in scorer(validation).collect()}
    want = {r.i: r.p for r in parts.select("i", staged.probability_after("parts", scorer.trees).alias("p")).collect()}
    assert got == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("curve, patience, want", [([.1, .3, .2, .2, .2, .9], 3, 2), ([.1, .3, .2, .2, .2, .9], 5, 6), ([.2, .2, .2], 9, 1), ([.1, .2], 1, 2)])
def test_patience(spark, curve, patience, want):
    rows = spark.createDataFrame([(i, float(a)) for i, a in enumerate(curve, 1)], "trees int, average_precision double")
    assert staged.best_prefix(rows, patience) == want


def test_prefixes_of_nothing(spark):
    none = spark.createDataFrame([(None, [0.1]), (1, None)], "y int, parts array<double>")
    assert staged.prefix_average_precision(none, "y").count() == 0 and staged.best_prefix(staged.prefix_average_precision(none, "y")) == 0
    negative = spark.createDataFrame([(0, [0.1, 0.2])], "y int, parts array<double>")
    assert [r.average_precision for r in staged.prefix_average_precision(negative, "y").collect()] == [None, None]


def test_leaf_values_are_penalised_newton_steps(spark):
    rng = np.random.default_rng(5)
    leaves, y, w = rng.integers(0, 4, (60, 5)), rng.integers(0, 2, 60), rng.random(60)
    rows = [([int(v) for v in r], int(a), float(b)) for r, a, b in zip(leaves, y, w)] + [(None, 1, 1.0), ([0] * 5, None, 1.0)]
    df = spark.createDataFrame(rows, "leaves array<int>, y int, w double")
    got = staged.refit_leaves(df, "y", "leaves", "w", l2=3.0, rate=0.3, keep=2)
    score = np.zeros(60)
    for t in range(5):
        v = np.zeros(4)
        for _ in range(4):
            p = 1 / (1 + np.exp(-(score + v[leaves[:, t]])))
            v += np.bincount(leaves[:, t], w * (y - p), 4) / (np.bincount(leaves[:, t], w * p * (1 - p), 4) + 3.0)
        assert [got[t][k] for k in range(4)] == pytest.approx(0.3 * v, abs=1e-12)
        score += 0.3 * v[leaves[:, t]]
    assert staged.refit_leaves(df.limit(0), "y", "leaves") == []


def test_text_model_and_mlp_learn(spark, risk):
    scored = MO.fit_full_and_score(MO.text_logistic("text", buckets=1 << 10, max_iter=20), risk, risk)
    assert ranking_metrics(scored, "p_text", "label6h").first().auroc > 0.95
    mlp = MO.fit_full_and_score(MO.fusion_mlp(["x", "gap"], epochs=40, batch=64, rate=0.01), risk, risk)
    assert ranking_metrics(mlp, "p_fused", "label6h").first().auroc > 0.7


def test_batch_scoring_loads_the_model_per_task(spark):
    def make():
        return lambda texts: texts.str.len() / 10.0

    df = spark.createDataFrame([(1, "abc"), (2, None)], "id long, text string")
    got = {r.id: r.p for r in TX.batch_text_score(df, "text", ["id"], make, "p").collect()}
    assert got == {1: 0.3, 2: 0.0}


def test_block_tfidf_equals_term_tfidf(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    rows = [(i % 40 if i % 13 else None, " ".join(f"w{(i * k) % 17} é{k % 3}" for k in range(i % 9))) for i in range(120)]
    rows += [(50, None), (51, ""), (52, "a b c"), (53, "Zoë zoe ZOE"), (53, "zoe x1")]
    df = spark.createDataFrame(rows, "id int, text string")
    try:
        counts = TX.term_counts(df, "id", "text")
        want = {(r.id, r.term): r.weight for r in TX.tfidf(counts, TX.fit_idf(counts, df.count()), "id").collect()}
        got = TX.tfidf_texts(df, "id", "text")
        assert got.dtypes == [("id", "int"), ("term", "string"), ("weight", "double")]
        found = {(r.id, r.term): r.weight for r in got.collect()}
        assert got.count() == len(found) and found == pytest.approx(want, abs=1e-12) and any(i is None for i, _ in found)
        assert TX.tfidf_texts(df.filter("id > 50 and id < 53"), "id", "text").count() == 0
        assert TX.tfidf_texts(df.limit(0), "id", "text").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_tfidf_terms_do_not_travel_with_their_texts(spark, tmp_path):
    """A block of a hundred equal texts sends each term once, and no join or window moves (document, term) rows."""
    words = pa.table({"block": pa.array([0] * 100, pa.int32()), "doc_id": list(range(100)), "words": [["aa", "bb", "aa"]] * 100})
    assert sorted(map(tuple, (r.values() for r in TX._block_terms(words).to_pylist()))) == [
        (0, "aa", 100), (0, "aa bb", 100), (0, "bb", 100), (0, "bb aa", 100)]
    spark.createDataFrame([(i, "aa bb aa") for i in range(100)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = catalog.QUERIES["tfidf_exact"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 4 and "Join" not in plan and "Generate" not in plan  # texts (twice in the plan, reused), terms, shared terms


def test_tfidf_terms_travel_as_packed_lists_and_numbers_come_back():
    """A row per block and part, a few bytes a term; where rows of a block come in another order, the lists are the same."""
    texts = [[f"{a}{b}{len(a) * b % 7}" for a in ("east", "mill", "north") for b in range(i % 60, i % 60 + 40)] for i in range(90)]
    shared = texts[50][5]
    words = pa.table({"block": pa.array([3] * 90, pa.int32()), "doc_id": list(range(90)), "words": texts})
    sent = TX._block_lists(words, 4)
    assert sent.equals(TX._block_lists(words.take(list(range(89, -1, -1))), 4)) and sent.num_rows <= 4 and set(sent["block"].to_pylist()) == {3}
    terms = TX._block_terms(words)
    assert sum(len(v) for c in ("sizes", "spelled", "n") for v in sent[c].to_pylist()) < 0.4 * (terms.nbytes - 4 * terms.num_rows)
    other = pa.table({"block": pa.array([5] * 3, pa.int32()), "doc_id": [7, 8, 9], "words": [[shared, "é" * 300], [shared, "solo", "é" * 300], None]})
    both = [TX._block_lists(w, 4) for w in (words, other)]
    found = [TX._counted_elsewhere(pa.concat_tables([t.filter(pc.equal(t["part"], p)) for t in both])) for p in range(4)]
    back = pa.concat_tables([f for f in found if f.num_rows])
    weights = TX._block_weights(other, back.filter(pc.equal(back["block"], 5)), 93, 4).to_pydict()
    df = sum(shared in t for t in texts) + 2
    idf = {t: np.log(94 / (1 + n)) + 1 for t, n in ((shared, df), ("é" * 300, 2), ("solo", 1), (shared + " " + "é" * 300, 1), (shared + " solo", 1), ("solo " + "é" * 300, 1))}
    for d, own in ((7, [shared, "é" * 300, shared + " " + "é" * 300]), (8, [t for t in idf if t != shared + " " + "é" * 300])):
        norm = np.sqrt(sum(idf[t] ** 2 for t in own))
        got = {t: w for k, t, w in zip(weights["doc_id"], weights["term"], weights["weight"]) if k == d}
        assert got == pytest.approx({t: idf[t] / norm for t in own})


def test_trends_are_made_of_kept_hours_only(spark):
    """Lags and rolling statistics stand above the window that finds the onset, and take no time apart inside their frames."""
    plan = catalog.QUERIES["wide_features"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().split("\n")
    windows = [line for line in plan if "Window [" in line]
    first = {name: next(i for i, line in enumerate(windows) if f"AS {name}#" in line) for name in ("map_slope_6h", "map_lag1", "t_onset")}
    assert first["map_slope_6h"] < first["t_onset"] and first["map_lag1"] < first["t_onset"]
    assert "hour(" not in windows[first["map_slope_6h"]]
