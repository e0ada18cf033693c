"""The corpus pipeline, stage by stage, against brute force over what each stage was given."""

import random
from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline
from tests.llm.test_operators import EDGE, TOKENIZERS, _components, docs, words
from tidewatch.llm import quality_forest, toxicity

STEPS = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng, folder = random.Random(21), tmp_path_factory.mktemp("pipeline")
    voc, rude, rows, marks = [f"word{i}" for i in range(400)], ["scum", "idiot"], [], []
    for i in range(500):
        bad = i % 7 == 0
        text = [rng.choice(rude) if bad and rng.random() < 0.2 else rng.choice(voc) for _ in range(rng.randint(30, 80))]
        rows.append((i, " ".join(text), rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", None])))
        marks.append((i, int(i % 11 != 0), int(bad)))
    for i in range(500, 560):       # exact and near copies
        base = rows[rng.randrange(500)][1].split()
        base[rng.randrange(len(base))] = "changed" if i % 2 else base[0]
        rows.append((i, " ".join(base), "en", "c"))
    rows += [(None if e[0] is None else 1000 + e[0], *e[1:]) for e in EDGE]
    docs(spark, rows).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), docs(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def plain(df):
    return Counter(tuple(r) for r in df.collect())


def test_rejecting_stages_follow_their_models(spark, tables):
    folder, table, labels = tables
    kept = STEPS["toxicity"](spark, table, folder)
    assert kept.columns == table.columns
    judged = toxicity.score(table, toxicity.fit(table, labels)).collect()
    assert Counter(r.doc_id for r in kept.select("doc_id").collect()) == Counter(r.doc_id for r in judged if not r.predicted)
    assert sum(r.predicted for r in judged) > 40
    good = STEPS["quality rules"](spark, table, folder)
    verdict = quality_forest.judge(table, labels).collect()
    assert good.columns == table.columns
    assert Counter(r.doc_id for r in good.select("doc_id").collect()) == Counter(r.doc_id for r in verdict if r.kept)
    assert all(len(words(r.text)) >= 10 for r in good.collect())


def test_near_copies_are_one_row_of_each_group(spark, tables):
    folder, table, _ = tables
    table = table.where("doc_id is null or doc_id < 600")
    kept = STEPS["n-gram Jaccard join"](spark, table, folder)
    want = _components([(r.doc_id, r.text) for r in table.collect() if r.doc_id is not None], 5, 80)
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == {c for _, c in want.values()}
    assert not plain(kept) - plain(table) and kept.columns == table.columns


def test_mix_repeats_whole_documents(spark, tables):
    folder, table, _ = tables
    mixed = STEPS["source mix"](spark, table, folder)
    given = plain(table)
    assert mixed.columns == table.columns and set(plain(mixed)) <= set(given)
    assert all(n <= 2 * given[r] for r, n in plain(mixed).items())


def test_last_stage_is_the_original_encoding(spark, tables):
    folder, table, _ = tables
    own = sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/piece_bpe_32k.model")
    coded = STEPS["SentencePiece"](spark, table, folder)
    want = Counter((r.doc_id, None if r.text is None else tuple(own.encode(r.text))) for r in table.collect())
    assert Counter((r.doc_id, None if r.ids is None else tuple(r.ids)) for r in coded.collect()) == want


def test_run_is_its_stages_and_repeats(spark, tables):
    folder, table, _ = tables
    step = table
    for name, f in corpus_pipeline.STAGES:
        step = corpus_pipeline.stage(f(spark, step, folder), "pipeline-test")
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids", "round_trip", "parity"]
    key = ("doc_id", "n_tokens", "round_trip", "parity")
    assert Counter(tuple(r[c] for c in key) for r in got.collect()) == Counter(tuple(r[c] for c in key) for r in step.collect())
    assert got.count() > 100


def test_empty_tables(spark, tmp_path):
    docs(spark, []).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
