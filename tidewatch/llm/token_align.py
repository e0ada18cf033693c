"""Alignment of two tokenizers over the bytes of each text.

Tokenizer A is a byte-level BPE of the tokenizers library, B a SentencePiece model; both code a space and the text. Each token has
bytes, so its end is a byte offset. Two dictionaries take ends to token indices; the sorted keys that both hold slice the two id
lists into groups, and each slice is expanded into its links, the token pairs that end together. A token has at least one byte (a
vocabulary with an empty one is refused), so a slice's link is its last pair.

Neither tokenizer reaches across a space between two characters that are no white space (A's pre-tokens end there; for B the pieces,
the normaliser and the settings are inspected), and both have a token end at it. So a text is aligned word by word, and a task aligns
each word once and keeps it, up to WORDS words. If B may reach across, or the words of a text do not give its bytes back, the whole
text is coded at once.

How often a pair of ids is linked is counted over the whole corpus. The bytes of one of a linked pair's tokens end with those of the
other, so there are no more pairs than both vocabularies have suffixes: the counts are small enough to be sent to every task. Texts
are coded once: their ids and group sizes are staged as packed numbers, counted and judged from there.

Defined cases: a null or empty text, and one whose tokens do not give back its bytes, has no tokens; very long texts are coded whole
(a word without white space is one piece of work, however long); ties: every link whose count equals the highest of its B id is a
best one; repeated rows count as often as they occur; an empty table gives empty results; columns besides doc_id and text are not
looked at.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import bytetext as bt
from tidewatch.llm.sentencepiece_backend import BYTE, MARK, read_model
from tidewatch.sources.storage import stage

WORDS = 300_000          # aligned words that a task keeps
RUN = 256               # new words that are coded as one text
FLAT = 1 << 23           # ids that it keeps for them
BORDER = re.compile(r"(?<=\S)(?= \S)")


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable Latin-1 ones for themselves, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Codes texts with both tokenizers and cuts the tokens into groups. Words met before are not coded again."""

    def __init__(self, a_json: bytes, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(a_json.decode())
        self.a.encode_special_tokens = True     # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        alphabet = byte_alphabet()
        names = {i: w for w, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [bytes(alphabet[c] for c in names[i]) if all(c in alphabet for c in names[i]) else names[i].encode()
                        for i in range(max(names) + 1)]
        spec = read_model(b_model)
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in spec["pieces"]]
        self.a_size, self.b_size = ([len(t) for t in table] for table in (self.a_bytes, self.b_bytes))
        if not (min(self.a_size) and min(self.b_size)):
            raise ValueError("a token without bytes ends nowhere of its own")
        settings = json.loads(a_json)
        before = settings.get("pre_tokenizer") or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not settings.get("normalizer")
        still = not spec["charsmap"] and not spec["remove_extra"] and spec["dummy_prefix"] and spec["escape"] and not spec["suffix"]
        if not plain or not spec["escape"]:
            raise ValueError("A must be byte-level without a normaliser, B must write spaces as markers")
        self.by_words = still and not any(re.search(f"[^{MARK}]{MARK}", p) for p, _, _ in spec["pieces"])
        self.forget()

    def forget(self) -> None:
        self.words: dict = {}
        self.shape = np.zeros((4, 0), np.int64)      # of each word: A tokens, B tokens, groups, whether its bytes come back
        self.flat = [np.zeros(0, np.int32)] * 4      # of all words: ids of A, of B, A tokens and B tokens of each group

    def align(self, text: str, a: list[int], b: list[int]):
        """Ids of A and of B, the byte offsets at which tokens of both end, and how many tokens of each end by then. None if the tokens
        do not give a space and the text back."""
        want = b" " + text.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != want or b"".join(map(self.b_bytes.__getitem__, b)) != want:
            return None
        at_a = dict(zip(accumulate(map(self.a_size.__getitem__, a)), range(1, len(a) + 1)))
        at_b = dict(zip(accumulate(map(self.b_size.__getitem__, b)), range(1, len(b) + 1)))
        common = sorted(at_a.keys() & at_b.keys())
        cuts = (np.fromiter(map(at.__getitem__, common), np.int64, len(common)) for at in (at_a, at_b))
        return np.array(a, np.int32), np.array(b, np.int32), np.array(common, np.int64), *cuts

    def _learn(self, fresh: list) -> None:
        """Aligns words. Those without white space at their ends are put into one text, which both tokenizers cut between them."""
        runs = []
        for w in fresh:
            if runs and isinstance(w, str) and isinstance(runs[-1][-1], str) and len(runs[-1]) < RUN:
                runs[-1].append(w)
            else:
                runs.append([w])
        shapes, flats = [self.shape], [[old] for old in self.flat]
        for run in self._aligned_runs(runs):
            shapes.append(np.array(run[0], np.int64))
            for kept, new in zip(flats, run[1:]):
                kept.append(new)
        self.shape = np.concatenate(shapes, axis=1)
        self.flat = [np.concatenate(kept) for kept in flats]

    def _aligned_runs(self, runs: list[list]):
        """Of each run of words: their shapes, and the lists of `flat` for all of them."""
        texts = [" ".join(run) if isinstance(run[0], str) else run[0][0] for run in runs]
        ids_a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        for run, text, a, b in zip(runs, texts, ids_a, self.b.encode(texts, num_threads=1)):
            found = self.align(text, a.ids, b)
            if found is None and len(run) > 1:
                yield from self._aligned_runs([[w] for w in run])
                continue
            if found is None:
                yield [[0]] * 4, *(np.zeros(0, np.int32) for _ in range(4))
                continue
            a, b, common, cut_a, cut_b = found
            border = np.cumsum([len(w.encode()) + 1 for w in run]) if len(run) > 1 else common[-1:]
            at = np.searchsorted(common, border)
            if (common[at] != border).any():
                raise AssertionError("a token reaches across a border between words")
            yield ([np.diff(cut_a[at], prepend=0), np.diff(cut_b[at], prepend=0), np.diff(at, prepend=-1), np.ones(len(at))],
                   a, b, np.diff(cut_a, prepend=0).astype(np.int32), np.diff(cut_b, prepend=0).astype(np.int32))

    def _numbers(self, text: str) -> list[int]:
        """Numbers of a text's words; new ones are put down to be aligned. A word with white space at an end (or a whole text) goes by a
        tuple, as there is no sure border beside it."""
        words = self.words
        if not self.by_words:
            return [words.setdefault((text,), len(words))]
        parts = text.split(" ")
        fresh = set(parts).difference(words)
        if any(not w or w[0].isspace() or w[-1].isspace() for w in fresh):
            parts = [w[1:] for w in BORDER.split(" " + text)]
            parts = [w if w and not w[0].isspace() and not w[-1].isspace() else (w,) for w in parts]
            fresh = set(parts).difference(words)
        for w in fresh:
            words[w] = len(words)
        return list(map(words.__getitem__, parts))

    def words_of(self, texts: list[str]) -> list[np.ndarray]:
        """Numbers of each text's words, all of them aligned; an empty text has none."""
        if len(self.words) > WORDS or len(self.flat[0]) > FLAT:
            self.forget()
        known = len(self.words)
        parts = [np.array(self._numbers(text) if text else [], np.int64) for text in texts]
        if len(self.words) > known:
            self._learn(list(islice(self.words, known, None)))
        for k, p in enumerate(parts):
            if len(p) > 1 and not self.shape[3][p].all():   # only the whole text can tell
                n = len(self.words)
                if self.words.setdefault((texts[k],), n) == n:
                    self._learn([(texts[k],)])
                parts[k] = np.array([self.words[(texts[k],)]], np.int64)
        return parts

    def lists(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and of B, sizes of the groups in A and in B: the values of all texts, and the borders of each text's."""
        parts = self.words_of(texts)
        every = np.concatenate([np.zeros(0, np.int64), *parts])
        owner = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        out = []
        for row, flat in zip((0, 1, 2, 2), self.flat):
            begin = np.cumsum(self.shape[row]) - self.shape[row]
            n = self.shape[row][every]
            edge = np.concatenate([[0], np.cumsum(n)])
            out.append((flat[np.arange(edge[-1]) + np.repeat(begin[every] - edge[:-1], n)], edge[owner]))
        return out


_made: dict = {}


def aligner(files: tuple[bytes, bytes]) -> Aligner:
    """An Aligner, made once per process."""
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
    key = tuple(map(hash, files))
    if key not in _made:
        _made.clear()
        _made[key] = Aligner(*files)
    return _made[key]


def load_files(spark: SparkSession, a_json: str, b_model: str) -> tuple[bytes, bytes]:
    """Both vocabulary files. A path without a scheme is the driver's; others are read by Spark."""
    def read(path):
        if "://" in path:
            return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
        with open(path, "rb") as f:
            return f.read()
    files = read(a_json), read(b_model)
    Aligner(*files)     # refuses what cannot be aligned
    return files


def _aligned(own: Aligner, batches):
    """(ids of documents, lists) of runs of whole texts."""
    for batch in batches:
        ids, texts = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "text"))
        for lo, _, at in bt.chunks(batch, "text"):
            yield ids.slice(lo, len(at) - 1), own.lists([t or "" for t in texts.slice(lo, len(at) - 1).to_pylist()])


def _pairs(lists) -> np.ndarray:
    """Each link's ids of A and B in one number: the last tokens of each group."""
    (a, _), (b, _), (an, _), (bn, _) = lists
    return (a[np.cumsum(an) - 1].astype(np.int64) << 32) | b[np.cumsum(bn) - 1]


class Counts:
    """Links of every linked pair of ids, and whether that is the most of its B id."""

    def __init__(self, pair: np.ndarray, n: np.ndarray):
        order = np.argsort(pair)
        self.pair, self.n = pair[order], n[order]
        b, at = np.unique(self.pair & 0xFFFFFFFF, return_inverse=True)
        top = np.zeros(len(b), np.int64)
        np.maximum.at(top, at, self.n)
        self.best = self.n == top[at]


PACKED = ("a_ids", "a_ends", "b_ids", "b_ends")


def _binary(values: np.ndarray, edge: np.ndarray) -> pa.Array:
    """The bytes of the values between the borders, one row for each pair of them."""
    return pa.Array.from_buffers(pa.binary(), len(edge) - 1, [None, pa.py_buffer((edge * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def code(docs: DataFrame, files: tuple[bytes, bytes]) -> DataFrame:
    """doc_id and, packed, the ids of A and of B and a byte for each that is 1 if its group ends there, for every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(files)

    def run(batches):
        own = aligner(shared.value)
        for ids, lists in _aligned(own, batches):
            packed = []
            for (values, edge), (sizes, _), table in zip(lists[:2], lists[2:], (own.a_bytes, own.b_bytes)):
                ends = np.zeros(len(values), np.uint8)
                ends[np.cumsum(sizes) - 1] = 1
                packed += [_binary(values.astype(np.uint16 if len(table) <= 1 << 16 else np.uint32), edge), _binary(ends, edge)]
            yield pa.RecordBatch.from_arrays([ids, *packed], names=["doc_id", *PACKED])

    text = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return text.mapInArrow(run, ", ".join(["doc_id long", *(f"{c} binary" for c in PACKED)]))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows of a binary column, and the borders of each row's."""
    _, at, data = column.buffers()
    edge = np.frombuffer(at, np.int32, len(column) + 1, 4 * column.offset).astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[edge[0]:edge[-1]], edge - edge[0]


def _coded(batches):
    """(ids of documents, lists as of `Aligner.lists`) of runs of rows of `code`."""
    _made.clear()   # all texts are coded: the words that a reused process kept are of no use
    for batch in batches:
        get = {c: _bytes(batch.column(batch.schema.get_field_index(c))) for c in PACKED}
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        lo, tokens = 0, get["a_ends"][1]
        while lo < len(ids):
            hi = max(lo + 1, int(np.searchsorted(tokens, tokens[lo] + bt.CHUNK // 4, "right")) - 1)
            lists, sizes = [], []
            for c in "ab":
                (ends, edge), (body, at) = get[f"{c}_ends"], get[f"{c}_ids"]
                ends, body, edge = ends[edge[lo]:edge[hi]], body[at[lo]:at[hi]], edge[lo:hi + 1] - edge[lo]
                kind = np.uint32 if len(body) == 4 * len(ends) else np.uint16
                lists.append((body.view(kind).astype(np.int32), edge))
                sizes.append((np.diff(np.flatnonzero(ends), prepend=-1).astype(np.int32), np.concatenate([[0], np.cumsum(ends, dtype=np.int64)])[edge]))
            yield ids.slice(lo, hi - lo), lists + sizes
            lo = hi


def link_counts(docs: DataFrame, files: tuple[bytes, bytes]) -> DataFrame:
    """a, b, n: the links of every linked pair of ids over all rows of docs."""
    return coded_counts(code(docs, files))


def coded_counts(coded: DataFrame) -> DataFrame:
    """`link_counts` of rows of `code`. Each task adds up its own first."""
    def run(batches):
        pair, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for _, lists in _coded(batches):
            new, m = np.unique(_pairs(lists), return_counts=True)
            pair, at = np.unique(np.concatenate([pair, new]), return_inverse=True)
            n = np.bincount(at, np.concatenate([n, m]), len(pair)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array((pair >> 32).astype(np.int32)), pa.array((pair & 0xFFFFFFFF).astype(np.int32)), pa.array(n)], names=["a", "b", "n"])

    found = coded.mapInArrow(run, "a int, b int, n long")
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"))


def collect_counts(counts: DataFrame) -> Counts:
    """The counts in the driver: no more pairs than the tokens of both vocabularies have bytes, counted twice."""
    found = counts.toPandas()
    return Counts((found["a"].to_numpy(np.int64) << 32) | found["b"].to_numpy(np.int64), found["n"].to_numpy(np.int64))


def score(coded: DataFrame, counts: Counts, derive=None, schema: str | None = None) -> DataFrame:
    """doc_id, a_ids, b_ids, a_sizes and b_sizes (tokens of each group), n_best (links that are the most frequent of their B id) and
    count_sum (counts of all links) for every row of `code`. `derive` turns an iterator of these batches into one of `schema`, in the
    same task, for callers that do not need the lists themselves."""
    shared = coded.sparkSession.sparkContext.broadcast(counts)

    def found(batches):
        counts = shared.value
        for ids, lists in _coded(batches):
            at = np.searchsorted(counts.pair, _pairs(lists))
            border = lists[2][1]
            arrays = [pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(values)) for values, edge in lists]
            yield pa.RecordBatch.from_arrays(
                [ids, *arrays, pa.array(bt.doc_sums(counts.best[at].astype(np.int64), border)), pa.array(bt.doc_sums(counts.n[at], border))],
                names=["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes", "n_best", "count_sum"])

    if derive:
        return coded.mapInArrow(lambda batches: derive(found(batches)), schema)
    return coded.mapInArrow(found, "doc_id long, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>, n_best long, count_sum long")


def align(docs: DataFrame, files: tuple[bytes, bytes], derive=None, schema: str | None = None) -> DataFrame:
    """`score` with the counts of all rows of docs, whose lists are staged between."""
    coded = stage(code(docs, files), "token-lists")
    return score(coded, collect_counts(coded_counts(coded)), derive, schema)


def _names(most: int, last: str) -> np.ndarray:
    """Decimal ids followed by a comma (even places) or by `last` (odd ones)."""
    return np.array([f"{i}{end}" for i in range(most + 1) for end in (",", last)], object)


DIGESTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def digest_batches(batches):
    """Batches of DIGESTS from batches of `score`."""
    names = [_names(0, "|"), _names(0, ";")]
    for batch in batches:
        get = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
        values = {c: get[c].flatten().to_numpy(zero_copy_only=False) for c in ("a_ids", "b_ids", "a_sizes", "b_sizes")}
        size = {c: np.diff(get[c].offsets.to_numpy()) for c in values}
        an, bn = (values[c].astype(np.int64) for c in ("a_sizes", "b_sizes"))
        out = np.empty(int(an.sum() + bn.sum()), object)
        for k, (c, n, shift) in enumerate((("a_ids", an, np.cumsum(bn) - bn), ("b_ids", bn, np.cumsum(an)))):
            ids = values[c].astype(np.int64)
            if len(ids) and 2 * ids.max() >= len(names[k]):
                names[k] = _names(2 * int(ids.max()), "|;"[k])
            last = np.zeros(len(ids), np.int64)
            last[np.cumsum(n) - 1] = 1
            out[np.arange(len(ids)) + np.repeat(shift, n)] = names[k][2 * ids + last]
        edge = np.concatenate([[0], np.cumsum(size["a_ids"] + size["b_ids"])])
        sha = [hashlib.sha256("".join(out[x:y].tolist())[:-1].encode()).hexdigest() if y > x else "" for x, y in zip(edge[:-1].tolist(), edge[1:].tolist())]
        groups = pa.array(size["a_sizes"].astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [get["doc_id"], pa.array(size["a_ids"].astype(np.int64)), pa.array(size["b_ids"].astype(np.int64)), groups, groups, get["n_best"], get["count_sum"], pa.array(sha, pa.string())],
            names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def digests(scored: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of rows of `score`."""
    return scored.mapInArrow(digest_batches, DIGESTS)
