"""Token alignment against brute force over whole texts, and its defined cases."""

import hashlib
import json
import random
from collections import Counter

import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidewatch.llm import queries, token_align
from tests.llm.test_operators import EDGE, TOKENIZERS, docs

A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"

ODD = ["a  b", " lead", "trail ", "x \n y", "\n\n", "tab\tx y", "a b c", "one  two", "▁ mark", "x▁y z", "café naïve ﬁ Å",
       "你好世界 الع", "\U0001f600\U0001f468‍\U0001f469 ok", "<s> </s> <unk> <|endoftext|> <0x0A>", "x\u0000y\r\n z", "1234567890 3.14,", "don't we'll I'M",
       "\x1c a \x85 b", "A" * 300, "ab" * 5000, "   ", " ", "́ a ́b", "a " * 700 + "▁", "�﻿ x"]


def words_text(rng):
    return "".join(rng.choice(["the", "Tha", "er", "ing", ",", ".", "9", "é", "你", "'s", "-", "_x"]) + rng.choice([" ", " ", " ", "", "\n", "  ", " \t"]) for _ in range(rng.randint(1, 60)))


def brute(rows):
    """rows: (doc_id, text) -> the contract's columns, by whole texts."""
    a_tok, b_tok = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_tok.encode_special_tokens = True
    alphabet = token_align.byte_alphabet()
    names = {i: w for w, i in json.load(open(A))["model"]["vocab"].items()}

    def b_bytes(i):
        p = b_tok.id_to_piece(i)
        return bytes([int(p[1:-1], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode()
    kept, count = [], Counter()
    for i, text in rows:
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        ab, bb = [bytes(alphabet[c] for c in names[x]) for x in a], [b_bytes(x) for x in b]
        if not text or b"".join(ab) != (" " + text).encode() or b"".join(bb) != (" " + text).encode():
            a, b, ab, bb = [], [], [], []
        ends = [[sum(map(len, t[:k + 1])) for k in range(len(t))] for t in (ab, bb)] if len(ab) < 2000 else [_running(t) for t in (ab, bb)]
        links = [(x, y) for x, e in zip(a, ends[0]) for y, f in zip(b, ends[1]) if e == f] if len(a) < 400 else _merged(a, b, *ends)
        cuts, groups = sorted(set(ends[0]) & set(ends[1])), []
        low = 0
        for c in cuts:
            groups.append(",".join(str(x) for x, e in zip(a, ends[0]) if low < e <= c) + "|" + ",".join(str(y) for y, f in zip(b, ends[1]) if low < f <= c)
                          if len(a) < 400 else None)
            low = c
        if len(a) >= 400:
            groups = _groups(a, b, *ends, cuts)
        count.update(links)
        kept.append((i, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return sorted(((i, na, nb, ng, len(ls), sum(count[x] == best[x[1]] for x in ls), sum(count[x] for x in ls), sha) for i, na, nb, ng, ls, sha in kept), key=str)


def _running(tokens):
    out, at = [], 0
    for t in tokens:
        at += len(t)
        out.append(at)
    return out


def _merged(a, b, ea, eb):
    where = dict(zip(eb, b))
    return [(x, where[e]) for x, e in zip(a, ea) if e in where]


def _groups(a, b, ea, eb, cuts):
    out, i, j = [], 0, 0
    for c in cuts:
        x, y = i, j
        while i < len(a) and ea[i] <= c:
            i += 1
        while j < len(b) and eb[j] <= c:
            j += 1
        out.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
    return out


def test_forgotten_words_change_nothing(monkeypatch):
    files = open(A, "rb").read(), open(B, "rb").read()
    rng = random.Random(4)
    texts = [words_text(rng) for _ in range(50)] + ODD
    own, want = token_align.Aligner(*files), []
    for t in texts:
        own.forget()
        want.append([v.tolist() for v, _ in own.lists([t])])
    monkeypatch.setattr(token_align, "WORDS", 20)
    assert [[v.tolist() for v, _ in own.lists([t])] for t in texts] == want and len(own.words) < 1000


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, words_text(rng), None, None) for i in range(120)] + [(500 + i, t, None, None) for i, t in enumerate(ODD)] + EDGE
    docs(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_token_align(spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), *((c, "bigint") for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", "string")]
    want = brute([(i, t) for i, t, _, _ in rows])
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert any(r[1] == 0 and r[0] is not None and r[0] >= 500 for r in want) and sum(r[1] > 0 for r in want) > 130


def test_documents_of_the_tables(spark):
    files = token_align.load_files(spark, A, B)
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = token_align.digests(token_align.align(table, files))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([(r.doc_id, r.text) for r in table.collect()])


def test_lists_give_the_texts_back(spark):
    files = token_align.load_files(spark, A, B)
    own = token_align.Aligner(*files)
    for r in token_align.align(docs(spark, [(i, t, None, None) for i, t in enumerate(ODD)]), files).collect():
        if r.a_ids:
            assert b"".join(own.a_bytes[i] for i in r.a_ids) == b"".join(own.b_bytes[i] for i in r.b_ids) == (" " + ODD[r.doc_id]).encode()
            assert sum(r.a_sizes) == len(r.a_ids) and sum(r.b_sizes) == len(r.b_ids) and len(r.a_sizes) == len(r.b_sizes)


def test_empty_table(spark):
    files = token_align.load_files(spark, A, B)
    assert token_align.digests(token_align.align(docs(spark, []).limit(0), files)).count() == 0
    assert token_align.link_counts(docs(spark, EDGE[1:4]), files).where("n = 0").count() == 0


def test_an_unusable_vocabulary_is_refused(spark):
    files = token_align.load_files(spark, A, B)
    other = json.loads(files[0]) | {"normalizer": {"type": "Lowercase"}}
    with pytest.raises(ValueError):
        token_align.Aligner(json.dumps(other).encode(), files[1])


def test_texts_are_coded_once(spark, tmp_path):
    """Rows are judged from staged lists, not from texts that are read and coded again."""
    docs(spark, [(i, t, None, None) for i, t in enumerate(ODD)]).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_token_align(spark, str(tmp_path))
    assert got.inputFiles() and not any(str(tmp_path) in f for f in got.inputFiles())


@pytest.mark.parametrize("chunk", [4, 1 << 19])
def test_packed_lists_are_the_lists(spark, monkeypatch, chunk):
    files = token_align.load_files(spark, A, B)
    own, texts = token_align.Aligner(*files), [None, *ODD, "", "a b"]
    rows = pa.Table.from_pylist([r.asDict() for r in token_align.code(docs(spark, [(i, t, None, None) for i, t in enumerate(texts)]).coalesce(1), files).collect()],
                                pa.schema([("doc_id", pa.int64()), *((c, pa.binary()) for c in token_align.PACKED)]))
    monkeypatch.setattr(token_align.bt, "CHUNK", chunk)
    found = []
    for ids, lists in token_align._coded(rows.slice(1).to_batches()):
        found += [[i.as_py(), *(v[e[k]:e[k + 1]].tolist() for v, e in lists)] for k, i in enumerate(ids)]
    assert found == [[i, *(v.tolist() for v, _ in own.lists([t or ""]))] for i, t in enumerate(texts)][1:]
