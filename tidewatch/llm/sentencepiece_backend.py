"""SentencePiece encoding and decoding on the tokenizers library.

The model protobuf is read field by field; from it the normaliser, the metaspace marker, the piece table with its scores (a
unigram model, or the merges that the scores of a BPE model imply) and byte fallback are rebuilt. Texts are cut before runs of
the marker where no piece reaches across such a border, so a task encodes a word once, by the library's threads, and keeps its ids. The rebuilt tokenizer is compared with the original
library on probes before any table is encoded, and while it is on every word that a task learns, and on the whole text of one
row in VERIFY and of every text that is normalised, is not cut or holds a marker. Without the original library both fail.

Defined cases: a null text has null ids, an empty one none; equal texts get equal ids; the strings of control pieces in a text
are ordinary text; columns besides doc_id and text are not looked at.
"""

from __future__ import annotations

import os
import re
import struct
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import bytetext as bt

MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6     # piece types
PROBES = ("", " ", "a", " a", "a ", "  two  spaces ", "tab\tline\nend\r\n", "<s> </s> <unk> <0x0A>", "▁ mark ▁▁x",
          "Café naïve Å ﬁ Å", "你好 \U0001f600 الع 12345 3.14", "A" * 70, "x\u0000y", " 　 ​")
WORDS = 200_000   # coded words that a task keeps
THREADS = 2       # of the library, in a task
VERIFY = 64       # the whole text of one row in so many is compared as well


def _fields(data: bytes):
    """(number, value) of a protobuf message: ints of varints, bytes of the rest."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        size = varint() if size is None else size
        yield key >> 3, data[at:at + size]
        at += size


def read_model(data: bytes) -> dict:
    """Pieces as (text, score, type), and the settings that encoding depends on."""
    out = {"pieces": [], "type": UNIGRAM, "byte_fallback": False, "unk_id": 0, "charsmap": b"", "dummy_prefix": True,
           "remove_extra": True, "escape": True, "suffix": False}
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            out["pieces"].append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            spec = dict(_fields(value))
            out |= {"type": spec.get(3, UNIGRAM), "byte_fallback": bool(spec.get(35, 0)), "unk_id": spec.get(40, 0),
                    "suffix": bool(spec.get(24, 0))}
        elif number == 3:
            spec = dict(_fields(value))
            out |= {"charsmap": spec.get(2, b""), "dummy_prefix": bool(spec.get(3, 1)), "remove_extra": bool(spec.get(4, 1)),
                    "escape": bool(spec.get(5, 1))}
    return out


class Backend:
    """encode and decode lists of texts like the original library."""

    def __init__(self, data: bytes, original=None):
        """original: the original library's processor of the model, to compare with."""
        self.original = original
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers
        spec = read_model(data)
        if spec["suffix"] or not spec["escape"]:
            raise ValueError("models with the marker as a suffix, or without one, are not handled")
        self.spec = spec
        pieces = spec["pieces"]
        names = [p for p, _, _ in pieces]
        ids = {p: i for i, p in enumerate(names)}
        if spec["type"] == UNIGRAM:
            model = models.Unigram([(p, s) for p, s, _ in pieces], unk_id=spec["unk_id"], byte_fallback=spec["byte_fallback"])
        elif spec["type"] == BPE:
            usable = {p for p, _, kind in pieces if kind in (NORMAL, USER)}
            merges = []
            for p, score, kind in pieces:
                if kind in (NORMAL, USER):
                    merges += [(-score, ids[p], p[:i], p[i:]) for i in range(1, len(p)) if p[:i] in usable and p[i:] in usable]
            merges.sort(key=lambda m: m[:2])
            model = models.BPE(vocab=ids, merges=[m[2:] for m in merges], unk_token=names[spec["unk_id"]], fuse_unk=True,
                               byte_fallback=spec["byte_fallback"])
        else:
            raise ValueError("only unigram and BPE models are handled")
        self.tokenizer = Tokenizer(model)
        steps = []
        if spec["charsmap"]:
            steps.append(normalizers.Precompiled(spec["charsmap"]))
        if spec["remove_extra"]:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        self.normalizer = normalizers.Sequence(steps) if steps else None
        users = [AddedToken(p, normalized=False, special=False) for p, _, kind in pieces if kind == USER]
        if users:
            self.tokenizer.add_tokens(users)
        self.tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
        # a border before a run of marks is safe if no piece has a mark behind another character
        crosses = any(re.search(f"[^{MARK}]{MARK}", p) for p, _, kind in pieces if kind in (NORMAL, USER))
        self._forget()
        self.cut = None if crosses else re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

    def _marked(self, text: str) -> str:
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        if not text:
            return ""
        return (MARK if self.spec["dummy_prefix"] else "") + text.replace(" ", MARK)

    def _forget(self) -> None:
        self.words, self.flat, self.begin, self.size = {}, np.zeros(0, np.int32), *(np.zeros(0, np.int64) for _ in range(2))
        self.exact, self.alike = np.zeros(0, bool), np.zeros(0, bool)

    def _learn(self, fresh: list[str]) -> None:
        """Codes words not met before and notes which of them decode to themselves and are coded like the original does."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)]
        size = np.array([len(i) for i in ids], np.int64)
        back = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        unk = self.spec["unk_id"]
        exact = np.array([b == w.replace(MARK, " ") and MARK not in b and unk not in i for b, w, i in zip(back, fresh, ids)], bool)
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
        self.alike = np.concatenate([self.alike, self._alike(fresh, ids)])
        self.size, self.exact = np.concatenate([self.size, size]), np.concatenate([self.exact, exact])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum()))])

    def _by_words(self) -> bool:
        """Whether the words' ids are the original's of a text that holds no marker."""
        return self.cut is not None and self.normalizer is None and self.spec["dummy_prefix"]

    def _alike(self, words: list[str], ids: list[list[int]]) -> np.ndarray:
        if self.original is None or not self._by_words():
            return np.zeros(len(words), bool)
        # the first mark is the one the original puts before a text; alone it is no text there, but a piece
        theirs = self.original.encode([w[1:].replace(MARK, " ") for w in words], num_threads=1)
        return np.array([i == ([self.original.piece_to_id(MARK)] if w == MARK else t) for w, i, t in zip(words, ids, theirs)], bool)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        return self.encode_checked(texts)[0]

    def encode_checked(self, texts: list[str]) -> tuple[list[np.ndarray], list[bool], list[bool | None]]:
        """Ids of each text, whether they decode to it, and whether its words have the original's ids (None: only the whole
        text can tell). Words met before are not coded again; at most WORDS are kept."""
        if len(self.words) > WORDS:
            self._forget()
        words, parts, fresh = self.words, [], len(self.words)
        for text in texts:
            text = self._marked(text)
            found = self.cut.findall(text) if self.cut else [text] if text else []
            parts.append(np.array([words.setdefault(w, len(words)) for w in found], np.int64))
        if len(words) > fresh:
            self._learn(list(islice(words, fresh, None)))
        out, exact, alike, by_words = [], [], [], self.original is not None and self._by_words()
        plain = self.normalizer is None
        for text, p in zip(texts, parts):
            n = self.size[p]
            edge = np.cumsum(n)
            ids = self.flat[np.arange(edge[-1] if len(edge) else 0) + np.repeat(self.begin[p] - edge + n, n)]
            out.append(ids)
            # a space is a mark and a mark is a mark: texts that hold marks, or are normalised, are decoded whole
            exact.append(bool(self.exact[p].all()) if plain and MARK not in text and self.spec["dummy_prefix"]
                         else self.decode([ids])[0] == text)
            alike.append(bool(self.alike[p].all()) if by_words and MARK not in text else None)
        return out, exact, alike

    def decode(self, ids: list) -> list[str]:
        """Texts of id lists; control pieces are silent, an unknown piece is the original's sign for it."""
        silent = {i for i, (_, _, kind) in enumerate(self.spec["pieces"]) if kind == CONTROL}
        unk = self.spec["unk_id"]
        runs, shape = [], []
        for row in ids:
            row = [int(i) for i in row if int(i) not in silent]
            pieces = [[]]
            for i in row:
                if i == unk:
                    pieces.append([])
                else:
                    pieces[-1].append(i)
            shape.append(len(pieces))
            runs += pieces
        texts = iter(self.tokenizer.decode_batch(runs, skip_special_tokens=False))
        out = [" ⁇ ".join(next(texts) for _ in range(n)) for n in shape]
        return [t[1:] if self.spec["dummy_prefix"] and t.startswith(" ") else t for t in out]


_made: dict = {}


def original(data: bytes):
    """The original library's processor of a model."""
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_proto=data)


def backend(data: bytes) -> Backend:
    """A Backend that compares with the original, made once per process."""
    key = hash(data)
    if key not in _made:
        _made.clear()
        _made[key] = Backend(data, original(data))
    return _made[key]


def differences(data: bytes, texts) -> list[str]:
    """Texts that the rebuilt tokenizer codes or decodes unlike the original library."""
    own, other = Backend(data), original(data)
    mine = own.encode(list(texts))
    back = own.decode(mine)
    return [t for t, ids, b in zip(texts, mine, back) if ids.tolist() != other.encode(t) or b != other.decode(ids.tolist())]


def load_model(spark: SparkSession, path: str) -> bytes:
    """The model file, after a comparison on the probes. A path without a scheme is the driver's; others are read by Spark."""
    if "://" in path:
        data = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    else:
        with open(path, "rb") as f:
            data = f.read()
    wrong = differences(data, PROBES)
    if wrong:
        raise ValueError(f"rebuilt tokenizer differs on {wrong[:3]!r}")
    return data


def encode(docs: DataFrame, model: bytes, verify: int = VERIFY) -> DataFrame:
    """doc_id, ids, round_trip (decoding gives the text back) and parity (the ids are the original library's; null for a null
    text). Whole texts are compared for one row in verify, 0 for none, besides those that words cannot tell."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        own, row = backend(shared.value), 0
        for batch in batches:
            at_text, at_id = (batch.schema.get_field_index(c) for c in ("text", "doc_id"))
            for lo, buf, at in bt.chunks(batch, "text", 1 << 21):
                part = batch.slice(lo, len(at) - 1)
                texts = part.column(at_text).to_pylist()
                ids, exact, alike = own.encode_checked([t or "" for t in texts])
                parity = []
                for t, i, same in zip(texts, ids, alike):
                    row += 1
                    if t is not None and (same is None or verify and row % verify == 0):
                        same = same is not False and own.original.encode(t) == i.tolist()
                    parity.append(None if t is None else same)
                size = np.array([0 if t is None else len(i) for t, i in zip(texts, ids)], np.int64)
                borders = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(borders), pa.array(flat), mask=pa.array([t is None for t in texts]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(at_id), lists, pa.array([None if t is None else e for t, e in zip(texts, exact)], pa.bool_()),
                     pa.array(parity, pa.bool_())], names=["doc_id", "ids", "round_trip", "parity"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(
        run, "doc_id long, ids array<int>, round_trip boolean, parity boolean")


def decode(coded: DataFrame, model: bytes) -> DataFrame:
    """doc_id and text from doc_id and ids."""
    shared = coded.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = backend(shared.value)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids")).to_pylist()
            texts = iter(own.decode([i for i in ids if i is not None]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), pa.array([None if i is None else next(texts) for i in ids], pa.string())],
                names=["doc_id", "text"])

    return coded.selectExpr("cast(doc_id as long) doc_id", "ids").mapInArrow(run, "doc_id long, text string")
