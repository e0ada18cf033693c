"""The text operators against brute force, and their defined cases: nulls, empty tables, ties, repeats, clashing columns."""

import math
import random
import re
import sys
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tidewatch.llm import (backoff_lm, bytetext, html_main, langid, mixing, ngram_join, quality_forest, sentencepiece_backend,
                           token_edits, topk_bitslice, toxicity)

TOKENIZERS = "/opt/tokenizers"
CLASH = ", size long, score double, n long, block long, margin double, h long"
DOCS = "doc_id long, text string, lang string, source string, n_chars long" + CLASH


def docs(spark, rows):
    """rows: (doc_id, text, lang, source)."""
    return spark.createDataFrame([(*r, None, 1, 0.5, 2, 3, 0.1, 4) for r in rows], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


EDGE = [(None, "a b c", None, None), (1, None, None, None), (2, "", "en", "s"), (3, " \t\n", "en", "s"), (4, "x", "en", "s"),
        (5, "x", "en", "s"), (5, "x", "en", "s"), (6, "lang " * 40_000, "fr", "t"), (7, "12 34 .", None, "t")]


def test_top_k(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, -0.51, 0.0, 0.3, 0.999]) for _ in range(5)]) for i in range(150)]
    rows += [(20, rows[3][1]), (200, None), (201, [0.1, None, 0.0, 0.0, 0.0]), (202, [float("nan")] * 5), (203, [float("inf")] * 5), (None, [0.5] * 5),
             (240, []), (260, [0.5])]
    got = topk_bitslice.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), topk_bitslice.F.col("vec_id") % 20 == 0,
                              7, rows=32, queries=4)
    live = [(i, [math.floor(64 * x) for x in v] + [0] * (5 - len(v))) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    per = {}
    for i, q in live:
        if i % 20 == 0:
            best = sorted(((sum(a * b for a, b in zip(q, v)), j) for j, v in live if j != i), key=lambda s: (-s[0], s[1]))[:7]
            per.setdefault(i, []).extend(best)
    want = Counter()
    for i, best in per.items():
        best = sorted(best, key=lambda s: (-s[0], s[1]))[:7]
        want.update((i, r + 1, j, s) for r, (s, j) in enumerate(best))
    assert Counter(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == want


def test_top_k_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk_bitslice.top_k(empty, topk_bitslice.F.col("vec_id") % 20 == 0).count() == 0


def test_mix_reaches_targets(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 300), None, rng.choice(["a", "a", "a", "b", "c", None])) for i in range(900)] + EDGE[:6]
    table = docs(spark, rows)
    got = mixing.mix(table, block=16).collect()
    size, by = Counter(), {}
    for _, text, _, source in rows:
        size[source] += len(words(text))
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, free, rest = {}, set(order), 1.5 * sum(size.values())
    while over := [s for s in free if rest * weight[s] / sum(weight[x] for x in free) > 2 * size[s]]:
        for s in over:
            target[s] = 2.0 * size[s]
        free -= set(over)
        rest = 1.5 * sum(size.values()) - sum(target.values())
    target |= {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
    assert len(got) == len(rows) and all(r.taken <= 2 * r["size"] for r in got)
    source_of = {(i, len(words(t))): s for i, t, _, s in rows}
    for r in got:
        s = source_of[(r.doc_id, r["size"])]
        assert r.source_size == size[s] and r.target == pytest.approx(target[s])
        by[s] = by.get(s, 0) + r.taken
    assert all(by[s] == pytest.approx(target[s], rel=0.05, abs=32) for s in order)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(table, block=16).collect()))
    assert mixing.mix(docs(spark, []).limit(0)).count() == 0


def test_permutation_is_a_bijection(spark):
    F = mixing.F
    for n in (1, 2, 7, 100):
        out = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), [F.lit(5)]).alias("p")).collect()
        assert sorted(r.p for r in out) == list(range(n))


def test_toxicity_learns_and_keeps_clean_texts(spark):
    rng = random.Random(2)
    voc, rude = [f"w{i}" for i in range(200)], ["scum", "idiot"]
    rows, marks = [], []
    for i in range(600):
        bad = i % 6 == 0
        text = " ".join(rng.choice(rude) if bad and rng.random() < 0.15 else rng.choice(voc) for _ in range(60))
        rows.append((i, text, None, None))
        marks.append((i, int(bad)))
    labels = spark.createDataFrame(marks + [(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs(spark, rows), labels)
    found = {r.doc_id: r for r in toxicity.score(docs(spark, rows + [(1000 + i, *e[1:]) for i, e in enumerate(EDGE)]), model).collect()}
    assert np.mean([found[i].predicted == t for i, t in marks]) > 0.95
    assert all(0 <= r.score <= 1 for r in found.values()) and len(found) == 600 + len(EDGE)
    kept = toxicity.keep(docs(spark, rows), model)
    assert kept.columns == docs(spark, rows).columns and {r.doc_id for r in kept.collect()} == {i for i in range(600) if not found[i].predicted}
    none = toxicity.fit(docs(spark, rows), labels.where("false"))
    assert none is None and toxicity.score(docs(spark, EDGE), none).count() == len(EDGE)


def _brute_logs(texts, counts, d, e, k, size, stems):
    """Log-probabilities of the words of texts: interpolated Kneser-Ney over exact words, pairs and stems of class k."""
    pairs, c = counts[k], Counter()
    for (v, w), n in pairs.items():
        c[v] += n
    cont, both = Counter(w for _, w in pairs), Counter(w for _, w in {**counts[0], **counts[1]})
    occur, shared = Counter(), Counter()
    for (v, w), n in pairs.items():
        occur[stems(w)] += n
    for w, n in both.items():
        shared[stems(w)] += n
    total = sum(occur.values())
    free = sum(min(n, 0.75) for n in shared.values())

    def p_shared(s):
        return (max(shared[s] - 0.75, 0) + free / size) / sum(shared.values())

    def p_stem(s):
        return max(occur[s] - d, 0) / total + max(1 - sum(max(n - d, 0) for n in occur.values()) / total, 1e-6) * p_shared(s)

    def p_word(w):
        types = sum(cont.values())
        return max(cont[w] - d, 0) / types + max(1 - sum(max(n - d, 0) for n in cont.values()) / types, 1e-6) * p_stem(stems(w))

    def p(v, w):
        taken = sum(min(n, e) for (a, _), n in pairs.items() if a == v)
        return (max(pairs.get((v, w), 0) - e, 0) + taken * p_word(w)) / c[v] if c[v] else p_word(w)
    return [math.log(p(v, w)) for t in texts for v, w in zip([None] + t[:-1], t)]


def test_toxicity_is_kneser_ney(spark):
    """Every level of the model against the formulas, for usual and large discounts."""
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choice(["idiot", "idea", "ideal", "the", "them", "a", "scum", "Über"]) for _ in range(rng.randint(0, 9))), None, None) for i in range(60)]
    pairs = [Counter(), Counter()]
    for i, t, _, _ in rows:
        w = t.lower().replace("Ü", "ü").split()
        w = [x.replace("ü", "Ü") for x in w]    # only A-Z are lower-cased
        pairs[i % 3 == 0].update(zip([None] + w[:-1], w))
    table = spark.createDataFrame([(t, int(i % 3 == 0)) for i, t, _, _ in rows], "text string, toxic long")
    counts = table.repartition(3).mapInArrow(toxicity._count_batches, "v int, w int, c0 long, c1 long").groupBy("v", "w").agg(
        toxicity.F.sum("c0").alias("c0"), toxicity.F.sum("c1").alias("c1"))
    model = toxicity.Model(counts)
    model.prepared()
    fresh = [["idiot", "scum", "new"], ["the", "idea", "the", "thesis"], ["Über", "a"]]
    data = " ".join(w for t in fresh for w in t).encode()
    at = np.cumsum([0] + [len(" ".join(t).encode()) + 1 for t in fresh])
    at[-1] -= 1
    t = toxicity.Tokens(np.frombuffer(data, np.uint8), at)
    for i, (d, e) in enumerate(model.choices):
        for k, got in enumerate(model.logs(t, i)):
            want = _brute_logs(fresh, pairs, float(d[k]), float(e[k]), k, 1 << toxicity.WORD_BITS, lambda w: w.encode()[:4])
            assert np.allclose(got, want, rtol=1e-4), (i, k)


def _peak_mb(work):
    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_toxicity_counts_leave_a_task_in_small_batches():
    """A task's texts hold more pairs than it may keep: parts of them are handed on, and their sums are whole."""
    rng = np.random.default_rng(5)
    texts = [" ".join(map(str, rng.integers(0, 1 << 40, 30_000))) for _ in range(12)] + ["a b a b", None, ""]
    marks = [i % 3 == 0 for i in range(len(texts))]
    batches = [pa.RecordBatch.from_pydict({"text": [t], "toxic": pa.array([int(m)])}) for t, m in zip(texts, marks)]
    sums = np.zeros(2, np.int64)

    def run():
        found, most = Counter(), 0
        for b in toxicity._count_batches(iter(batches)):
            most = max(most, b.num_rows)
            sums[:] += [b.column(2).to_numpy().sum(), b.column(3).to_numpy().sum()]
            small = b.filter(pc.greater(pc.add(b.column(2), b.column(3)), 1))
            found.update(dict.fromkeys(zip(small.column(0).to_pylist(), small.column(1).to_pylist()), 1))
        return found, most
    (found, most), peak = _peak_mb(run)
    assert most <= 1 << 16 and peak < 70, (most, peak)
    words = [len((t or "").split()) for t in texts]
    assert list(sums) == [2 * sum(n for n, m in zip(words, marks) if m == k) for k in (False, True)]
    t = toxicity.Tokens(np.frombuffer(b"a b", np.uint8), np.array([0, 3]))
    assert (int(t.before[1]), int(t.word[1])) in found      # "a b" stands twice


def test_toxicity_choices_share_their_tables():
    """Trying all choices of discounts takes no tables of its own for each."""
    rng, size = np.random.default_rng(6), 1 << toxicity.WORD_BITS
    model = toxicity.Model.__new__(toxicity.Model)
    model.word, model.stem, model.first, model.pair = (rng.integers(0, 50, (2, n)).astype(np.float32) for n in (size, size, size + 1, 1 << toxicity.PAIR_BITS))
    model.types = model.shared = np.full(size, 1 / size)
    model.choices, model.levels = toxicity.choices(np.array([3000, 1000])), []
    model.taken = [model.first] * len(model._pair_discounts())
    batch = pa.RecordBatch.from_pydict({"text": ["some words of a text", None, "more of them"], "toxic": [0, 1, 0]})
    (out,), peak = _peak_mb(lambda: list(toxicity._margin_batches(model, ["toxic"])(iter([batch]))))
    assert out.num_rows == 3 and out.num_columns == len(model.choices) + 2 and peak < 45, peak


def test_toxicity_query_rounds_before_it_decides(spark):
    model = type("M", (), {"curve": np.array([0.0, 1e-12, 0.0]), "choices": [0], "prepared": lambda s: None, "margins": lambda s, t, i: np.zeros(len(t.words.per)) - 1})()
    found = toxicity.score(docs(spark, [(1, "a", None, None), (1, "b", None, None), (2, "", None, None)]), model).collect()
    assert len(found) == 3 and all(r.score == 0.5 and r.predicted == 1 for r in found)


def test_toxicity_with_one_class_and_empty_tables(spark):
    rows = [(i, f"a b c{i % 5}", None, None) for i in range(40)]
    for mark in (0, 1):
        model = toxicity.fit(docs(spark, rows), spark.createDataFrame([(i, mark) for i in range(40)], "doc_id long, toxic int"))
        assert {r.predicted for r in toxicity.score(docs(spark, rows + EDGE), model).collect()} == {mark}
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.fit(docs(spark, []).limit(0), labels) is None
    assert toxicity.keep(docs(spark, EDGE), None).count() == len(EDGE)


def test_language(spark):
    rng = random.Random(3)
    parts = {"en": ["the", "with", "ing", "th"], "de": ["der", "sch", "ung", "ü"], "fr": ["eau", "les", "é", "que"]}
    rows = [(i, " ".join(rng.choice(parts[g]) + rng.choice(parts[g]) for _ in range(30)), g, None) for i, g in enumerate(rng.choices(list(parts), k=300))]
    net = langid.fit(docs(spark, rows[:200]))
    got = {r.doc_id: r for r in langid.predict(docs(spark, rows[200:] + [(1000 + i, *e[1:]) for i, e in enumerate(EDGE)]), net).collect()}
    assert np.mean([got[i].lang_pred == g for i, _, g, _ in rows[200:]]) > 0.95
    assert [got[1000 + i].lang_pred for i in (1, 2, 3, 8)] == ["und"] * 4 and got[1007].lang_pred in parts
    assert langid.fit(docs(spark, []).limit(0)) is None


def _components(rows, n, percent):
    sets = {}
    for i, t in rows:
        w = [x.lower() for x in words(t)]
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("n, percent, block", [(3, 90, 400_000), (5, 80, 300)])
def test_ngram_join(spark, monkeypatch, n, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng, rows = random.Random(n), []
    for _ in range(30):
        base = [f"W{rng.randrange(300)}" for _ in range(rng.choice([1, 2, 3, 5, 9, 12, 20, 40, 100, 300]))]
        for _ in range(rng.choice([1, 2, 6, 14])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 20))):
                w[rng.randrange(len(w))] = f"w{rng.randrange(300)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, " \n")]
    table = docs(spark, [(i, t, None, None) for i, t in rows] + [(None, "a b c d e f", None, None)])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(table, n, percent).collect()}
    assert got.pop(None)[1] is None
    want = _components(rows, n, percent)
    assert got == want
    kept = ngram_join.keep_one(table, n, percent)
    assert {r.doc_id for r in kept.collect()} == {c for _, c in want.values()} | {None} and kept.columns == table.columns


def test_ngram_join_of_an_empty_table(spark):
    assert ngram_join.join(docs(spark, []).limit(0)).count() == 0


def test_rule_counts_and_forest(spark):
    rng = random.Random(6)
    good = [(i, " ".join("".join(rng.choices("abcdefg", k=rng.randint(3, 7))) for _ in range(40)), None, None) for i in range(300)]
    bad = [(300 + i, " ".join(w + rng.choice(["###", "$$", "%%%"]) for w in words(good[i][1])), None, None) for i in range(30)]
    edge = [(400 + i, *e[1:]) for i, e in enumerate(EDGE)] + [(420, "a b c d e a b c d e\nx\nx\n\nx y", None, None)]
    labels = spark.createDataFrame([(i, 1) for i in range(0, 300, 2)] + [(i, 0) for i in range(300, 330, 2)] + [(2, None)], "doc_id long, quality int")
    rows = good + bad + edge
    got = {r.doc_id: r for r in quality_forest.judge(docs(spark, rows), labels).collect()}
    for i, text, *_ in rows:
        w, text = words(text), text or ""
        grams = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        repeat = {p for k in range(len(w) - 4) if grams[tuple(w[k:k + 5])] > 1 for p in range(k, k + 5)}
        lines = [x for x in text.split("\n") if words(x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 10 or 100 * len(repeat) > 20 * len(w)) and not (r.base_failed and r.kept)
    assert np.mean([got[i].kept for i in range(300)]) > 0.97 and np.mean([got[i].kept for i in range(300, 330)]) < 0.1
    kept = quality_forest.keep(docs(spark, rows), labels)
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept} and kept.columns == docs(spark, rows).columns
    assert quality_forest.judge(docs(spark, []).limit(0), labels).count() == 0


def test_token_counts_follow_edits(spark):
    with open(f"{TOKENIZERS}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = f.read()
    encoder, border, rng = token_edits.tokenizer(ranks), token_edits._border(), random.Random(3)
    old, token_edits.LEAF = token_edits.LEAF, 20
    parts = ["word", "a", "é", " ", "\n", "'s", "12", ".", "日本", "Foo bar", "\n\n"]
    for _ in range(200):
        text = "".join(rng.choice(parts) + rng.choice([" ", ""]) for _ in range(rng.randint(0, 60)))
        tree = token_edits.EditTree(text, encoder, border)
        for _ in range(6):
            a = rng.randint(-2, len(text) + 2)
            b, new = a + rng.choice([0, 1, 3, 30]), rng.choice(["", " ", "zz yy", "\n", "'s", " some longer text that goes on"])
            tree.edit(a, b, new)
            a = min(max(a, 0), len(text))
            text = text[:a] + new + text[min(max(b, a), len(text)):]
            assert "".join(tree.leaves) == text and tree.tokens == len(encoder.encode_ordinary(text)) and tree.chars == len(text)
    token_edits.LEAF = old
    table = token_edits.sample_edits(docs(spark, EDGE))
    for r in token_edits.count_edited(table, ranks).join(table.where("doc_id <> 5"), "doc_id").collect():
        text = r.text
        assert r.n_tokens == len(encoder.encode_ordinary(text or ""))
        if text is not None:
            for e in r.edits:
                a, b = min(e.start, len(text)), min(e.stop, len(text))
                text = text[:a] + (e.text or "") + text[b:]
            assert r.n_tokens_edited == len(encoder.encode_ordinary(text))


def test_backoff_scores(spark, monkeypatch):
    monkeypatch.setattr(backoff_lm, "BLOCK", 300)
    monkeypatch.setattr(backoff_lm, "PART", 100)
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("a b c dd e f".split()) for _ in range(rng.randint(0, 25)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "zz"), (63, "zz yy xx ww"), (5, "a b c")]

    def grams(w):
        return Counter(tuple(w[j:j + k]) for k in (1, 2, 3) for j in range(len(w) - k + 1))
    total, want = Counter(), []
    for _, t in rows:
        total.update(grams(words(t)))
    size = sum(len(words(t)) for _, t in rows)
    for i, t in rows:
        w, s = words(t), 0.0
        own = grams(w)
        for j in range(len(w)):
            top = min(3, j + 1)
            for n in range(top, 0, -1):
                g = tuple(w[j - n + 1:j + 1])
                if total[g] > own[g]:
                    s += math.log((total[g] - own[g]) / (total[g[:-1]] - own[g[:-1]] if n > 1 else size - len(w))) + (top - n) * math.log(0.4)
                    break
            else:
                s += top * math.log(0.4) - math.log(max(size - len(w), 1))
        want.append((i, len(w), round(s, 6)))
    got = backoff_lm.score(docs(spark, [(i, t, None, None) for i, t in rows])).collect()
    assert sorted((r.doc_id, r.n_words, round(r.log_score, 6)) for r in got) == sorted(want)
    assert backoff_lm.score(docs(spark, []).limit(0)).count() == 0


def test_sentencepiece_parity(spark):
    model = sentencepiece_backend.load_model(spark, f"{TOKENIZERS}/piece_bpe_32k.model")
    rng = random.Random(5)
    odd = ["".join(rng.choice(["a", "Wort", " ", "  ", "▁", "\n", "é", "日", "\t", "<s>", "0"]) for _ in range(40)) for _ in range(200)]
    assert sentencepiece_backend.differences(model, odd) == []
    coded = sentencepiece_backend.encode(docs(spark, EDGE), model, verify=1)
    back = {(r.doc_id, r.text) for r in sentencepiece_backend.decode(coded, model).collect()}
    assert back == {(i, t) for i, t, *_ in EDGE}
    assert all(r.ids is None or r.round_trip and r.parity for r in coded.collect())


def test_sentencepiece_compares_every_row(spark, monkeypatch):
    model = sentencepiece_backend.load_model(spark, f"{TOKENIZERS}/piece_bpe_32k.model")
    rows = [(i, f"Wort {i} a  b ", None, None) for i in range(100)] + [(200, "▁ x", None, None), (201, " ", None, None), (202, None, None, None)]
    got = {r.doc_id: r.parity for r in sentencepiece_backend.encode(docs(spark, rows), model).collect()}
    assert got.pop(202) is None and set(got.values()) == {True}
    other = sentencepiece_backend.original(model)
    own = sentencepiece_backend.Backend(model, other)
    learn = own.tokenizer

    class Wrong:
        def encode_batch_fast(self, words, **settings):
            return learn.encode_batch_fast(["▁odd" if w == "▁rare" else w for w in words], **settings)

        def __getattr__(self, name):
            return getattr(learn, name)
    own.tokenizer = Wrong()
    assert own.encode_checked(["a rare b", "a b", "rare", "odd"])[2] == [False, True, False, True]
    monkeypatch.setitem(sys.modules, "sentencepiece", None)
    with pytest.raises(ImportError):
        sentencepiece_backend.differences(model, ["a"])


def test_html_blocks_and_repeated_runs(spark):
    page = ("<html><head><title>t</title></head><body><nav><ul><li>Home</ul></nav><div id='cookie-notice'>We use</div><header>Top</header>"
            "<main><h1>T &lt;x&gt;</h1><p>a <b>b</b><br>c<p class='ad'>buy<p>d<ul><li>1<li>2</ul><div class='comments'><p>no</p></div>"
            "<form><p>x</p></form><script>if (a<b) '</p>'</script>e &amp f</main><aside>s</aside><footer>f</footer>")
    assert [t for where, t in html_main.blocks(page) if where == html_main.ARTICLE] == ["T <x>", "a b c", "d", "1", "2", "e & f"]
    shared = " ".join(f"legal{i}" for i in range(30))
    rows = [(i, f"http://h.example/{i}", f"<body><div>{shared}</div><p>p{i} has text of page {i * 7}</p>") for i in range(9)]
    rows += [(9, "http://h.example/9", page), (10, None, None), (11, "x", ""), (12, "http://h.example/0", rows[0][2]), (None, "http://o.example", f"<p>{shared}</p>")]
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, text string, host long")
    got = {r.page_id: r.text for r in html_main.extract(table).collect()}
    assert [got[i] for i in range(9)] == [f"p{i} has text of page {i * 7}" for i in range(9)] and got[12] == got[0]
    assert got[9] == "T <x>\na b c\nd\n1\n2\ne & f" and got[10] == got[11] == "" and got[None] == shared
    assert html_main.extract(table.limit(0)).count() == 0


def _extract(spark, rows):
    return {r.page_id: r.text for r in html_main.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def _prose(seed, n):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


@pytest.mark.parametrize("tag", ["div class='no-sidebar'", "div id='menu-open'", "div class='page with-sidebar'", "div class='page sidebar'",
                                 "form id='all'"])
def test_html_wrappers_of_the_page_do_not_reject_it(tag):
    end, text = tag.split()[0], _prose(1, 40)

    def kept(page):
        return [t for where, t in html_main.blocks(page) if where != html_main.NEVER]
    for inner in (f"<article><p>{text}</p></article>", f"<main><p>{text}</p><p class='ad'>buy</p></main>", f"<div role='main'>{text}</div>", f"<div><p>{text}</p></div>"):
        page = (f"<body><{tag}><nav>Home</nav>{inner}<div class='sidebar'>more</div><div class='related'><article>teaser</article></div>"
                f"<footer>f</footer></{end}></body>")
        assert kept(page) == [text]
    assert kept(f"<body><div class='sidebar'>side</div><p>{text}</p><div class='comments'><article>{text} {text * 20}</article></div>") == [text]


def test_html_repetition_decides_beside_and_inside_articles(spark):
    call = " ".join(f"subscribe{i}" for i in range(20))
    rows = [(i, f"http://a.example/{i}", f"<main><p>{_prose(i, 60)}</p><div>{call}</div></main><div>{call} x{i}</div>") for i in range(12)]
    rows += [(20 + i, f"http://b.example/{i}", f"<div>{_prose(50 + i, 80)}</div><article>teaser {i}</article>") for i in range(3)]
    got = _extract(spark, rows)
    assert [got[i] for i in range(12)] == [f"{_prose(i, 60)}\nx{i}" for i in range(12)]
    assert [got[20 + i] for i in range(3)] == [f"{_prose(50 + i, 80)}\nteaser {i}" for i in range(3)]


def test_html_copied_articles_count_as_one(spark):
    text = _prose(7, 150)
    rows = [(i, f"http://a.example/{i}", f"<main><p>{text}</p><p>read on {i} may</p></main>") for i in range(8)]
    got = _extract(spark, rows)
    assert [got[i] for i in range(8)] == [f"{text}\nread on {i} may" for i in range(8)]


def test_html_copies_and_quotations_are_not_boilerplate(spark):
    text, quote, notice = _prose(3, 120), _prose(4, 14), " ".join(f"legal{i}" for i in range(30))
    copies = [(i, f"http://a.example/{i}", f"<head><link href='{i}'></head><div id='x{i}'>{text}</div><p>{i} May</p>") for i in range(5)]
    quoted = [(10 + i, f"http://b.example/{i}", f"<p>{_prose(20 + i, 40)} {quote if i < 2 else ''}</p><p>{notice}</p>") for i in range(12)]
    loose = [(30 + i, (None, "x", "/y")[i % 3], f"<p>{text} {_prose(60 + i, 90)}</p>") for i in range(6)]
    got = _extract(spark, copies + quoted + loose)
    assert [got[i] for i in range(5)] == [f"{text}\n{i} May" for i in range(5)]
    assert [got[10 + i] for i in range(12)] == [f"{_prose(20 + i, 40)} {quote if i < 2 else ''}".strip() for i in range(12)]
    assert [got[30 + i] for i in range(6)] == [f"{text} {_prose(60 + i, 90)}" for i in range(6)]


def test_window_order_is_a_suffix_order():
    rng = np.random.default_rng(1)
    streams = [rng.integers(0, 3, n).astype(np.uint64) for n in (0, 3, 30, 50)]
    rank, owner, fits = html_main.window_order(streams, 5)
    flat = [tuple(s[i:i + 5]) for s in streams for i in range(len(s))]
    place = np.flatnonzero(fits)
    assert [flat[i] for i in place[np.argsort(rank[place], kind="stable")]] == sorted(flat[i] for i in place)


def test_words_are_those_of_the_pattern():
    texts = ["", " a\tb\x0bc\x0c\r\n d", "é x", "lone", "\n"]
    import pyarrow as pa
    batch = pa.record_batch({"text": pa.array(texts)})
    (_, buf, at), = bytetext.chunks(batch, "text")
    w = bytetext.Words(buf, at)
    assert [bytes(buf[a:b]).decode() for a, b in zip(w.start, w.end)] == [x for t in texts for x in words(t)]
    assert w.per.tolist() == [len(words(t)) for t in texts]


def test_forest_counts_every_labelled_row_and_cuts_at_the_exact_score(spark):
    """One tree's counts hold all rows, far beyond what a tree tells apart; the threshold equals that of all scores in numpy."""
    assert not hasattr(quality_forest, "LABEL_ROWS")
    names = quality_forest.FEATURES
    rows = spark.range(30_000).selectExpr(*[f"pmod(xxhash64(id, {i}), 1000) / 1000D {f}" for i, f in enumerate(names)])
    points = rows.toPandas().to_numpy()
    laid = quality_forest.lay(points.min(0), points.max(0), trees=2)
    want = [quality_forest.weigh(t, np.bincount(quality_forest.leaves(t, points), minlength=len(t["cut"]))) for t in laid]
    got = quality_forest.grow(rows, points.min(0), points.max(0), trees=2)
    assert all(np.array_equal(a[k], b[k]) for a, b in zip(got, want) for k in ("feature", "path", "cut", "left"))

    table = spark.range(25_000).selectExpr("pmod(xxhash64(id), 5000) / 10000D + if(id % 20 = 0, 0.3D, 0D) score", "id % 20 <> 0 good")
    every = table.toPandas()
    cuts = np.unique(every.score)
    middle = np.append((cuts[1:] + cuts[:-1]) / 2, cuts[-1] + 1)
    ok, bad = every.score[every.good].to_numpy(), every.score[~every.good].to_numpy()
    gains = [(bad > c).mean() - 2 * (ok > c).mean() if (ok > c).mean() <= 0.01 else -1 for c in middle]
    assert quality_forest.threshold(table) == pytest.approx(middle[int(np.argmax(gains))], abs=1e-12)
    assert quality_forest.threshold(table.where("good")) == quality_forest.threshold(table.where("not good")) == 2.0


def test_family_keys_move_once_as_packed_lists(spark):
    """A row per part and piece, no row per key; documents are connected as the rows (document, key) connect them."""
    import random as rnd

    import pyarrow as pa
    rng = rnd.Random(8)
    rows = [(i % 150 - 20, [rng.getrandbits(64) - 2 ** 63 for _ in range(30)] + [7_000 + rng.randrange(90) for _ in range(i % 3)]) for i in range(180)]
    rows += [(None, [7_001, 7_002]), (900, None), (901, []), (902, [-5, -5]), (903, [-5]), (10 ** 12, [2 ** 62]), (-10 ** 12, [2 ** 62])]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([i for i, _ in rows if i is not None]),
                                        "keys": pa.array([k for i, k in rows if i is not None], pa.list_(pa.int64()))})
    sent = list(ngram_join._key_lists(5)(iter([batch])))
    assert sum(b.num_rows for b in sent) == 5
    root = {i: i for i, _ in rows if i is not None}

    def top(i):
        return i if root[i] == i else top(root[i])

    holders = {}
    for i, found in rows:
        for k in found or [] if i is not None else []:
            holders.setdefault(k, []).append(i)
    for nodes in holders.values():
        for i in nodes:
            a, b = sorted((top(i), top(nodes[0])))
            root[b] = a
    want = {i: top(i) for i in root}
    linked = {i for nodes in holders.values() if len(set(nodes)) > 1 for i in nodes}
    got = ngram_join.families(spark.createDataFrame(rows, "doc_id long, keys array<long>").repartition(4)).collect()
    assert len(got) == len(linked) and {r.node: r.root for r in got} == {i: want[i] for i in linked} and 903 in linked and 10 ** 12 in linked
