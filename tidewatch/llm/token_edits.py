"""Token counts that follow edits.

A text is cut into leaves at borders where the tokenizer's pre-token pattern always splits (a letter, then a blank or line feed,
then a letter), so a leaf's tokens do not depend on its neighbours. A segment tree per document holds characters and tokens
per leaf and their sums. An edit finds its leaves by descending the tree, re-encodes these and as many neighbours as it takes
until both outer borders are borders again, and updates the sums on the way up; the rest of the text is not encoded again.

Defined cases: a null text counts 0 and stays null, edits or not; an empty one counts 0; edit positions outside the text are
moved to its ends and a stop before the start to the start; null positions count as 0, a null replacement as an empty one; edits
apply in order, each to the result of those before; texts without a border are one leaf; columns besides doc_id, text and edits
are not looked at. A document's edits and text are one task's work, as they are one value.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# the pre-token pattern that belongs to the byte-level vocabulary (fixed value)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BORDER = r"(?<=\p{L})(?=[ \n]\p{L})"
LEAF = 256           # characters from which a leaf ends at the next border
OUT = ("doc_id long, n_tokens long, n_tokens_edited long, n_chars long, n_chars_edited long, n_leaves long, n_edits long, "
       "chars_reencoded long")
_made: dict = {}


def tokenizer(ranks: bytes):
    """The encoding of a rank file (base64 token and rank a line); made once per process."""
    key = hash(ranks)
    if key not in _made:
        import tiktoken
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        _made.clear()
        _made[key] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _made[key]


def _border():
    import regex
    return regex.compile(BORDER)


def cut(text: str, border) -> list[str]:
    """Leaves of a text."""
    out, at = [], 0
    while len(text) - at > LEAF and (m := border.search(text, at + LEAF)):
        out.append(text[at:m.start()])
        at = m.start()
    if at < len(text):
        out.append(text[at:])
    return out


class EditTree:
    """Leaves with a segment tree over their (characters, tokens); node 1 is the root, node i has children 2i and 2i + 1."""

    def __init__(self, text: str, encoder, border, counts=None):
        self.encoder, self.border, self.reencoded = encoder, border, 0
        self._plant(cut(text, border), counts)

    def _counts(self, leaves: list[str]) -> list[int]:
        return [len(self.encoder.encode_ordinary(leaf)) for leaf in leaves]

    def _plant(self, leaves: list[str], counts=None) -> None:
        self.leaves = leaves or [""]
        counts = self._counts(self.leaves) if counts is None else list(counts)
        self.base = 1 << (len(self.leaves) - 1).bit_length()
        sums = np.zeros((2 * self.base, 2), np.int64)
        sums[self.base:self.base + len(self.leaves), 0] = [len(t) for t in self.leaves]
        sums[self.base:self.base + len(self.leaves), 1] = counts
        level = self.base
        while level > 1:
            sums[level // 2:level] = sums[level:2 * level:2] + sums[level + 1:2 * level:2]
            level //= 2
        self.sums = sums

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds the character at a position (the last one, past the end) and its place there."""
        node = 1
        while node < self.base:
            node *= 2
            if at >= self.sums[node, 0] and node + 1 < 2 * self.base and self.sums[node + 1, 0] > 0:
                at -= int(self.sums[node, 0])
                node += 1
        return min(node - self.base, len(self.leaves) - 1), at

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        node = self.base + leaf
        change = np.array([len(text), tokens]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def _is_border(self, left: str, right: str) -> bool:
        return self.border.match(left[-1:] + right[:2], len(left[-1:])) is not None

    def edit(self, start: int, stop: int, text: str) -> None:
        """Replace the characters start..stop."""
        start = min(max(start, 0), self.chars)
        stop = min(max(stop, start), self.chars)
        first, into = self._find(start)
        last, upto = self._find(max(stop - 1, start))
        upto += 1 if stop > start else 0
        new = self.leaves[first][:into] + text + self.leaves[last][upto:]
        while first > 0 and not (self.leaves[first - 1] and new and self._is_border(self.leaves[first - 1], new)):
            first -= 1
            new = self.leaves[first] + new
        while last + 1 < len(self.leaves) and not (self.leaves[last + 1] and new and self._is_border(new, self.leaves[last + 1])):
            last += 1
            new += self.leaves[last]
        fresh = cut(new, self.border)
        counts = self._counts(fresh)
        self.reencoded += len(new)
        if len(fresh) > last - first + 1:      # more leaves than there is room for: a new tree from known counts
            tokens = self.sums[self.base:self.base + len(self.leaves), 1].tolist()
            self._plant(self.leaves[:first] + fresh + self.leaves[last + 1:], tokens[:first] + counts + tokens[last + 1:])
            return
        for i in range(first, last + 1):
            j = i - first
            self._set(i, fresh[j] if j < len(fresh) else "", counts[j] if j < len(counts) else 0)


def count_edited(docs: DataFrame, ranks: bytes) -> DataFrame:
    """Counts before and after the edits of each row: docs has doc_id, text and edits (array of start, stop, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        encoder, border = tokenizer(shared.value), _border()
        names = [f.split()[0] for f in OUT.split(", ")]
        for batch in batches:
            ids, texts, edits = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "text", "edits"))
            rows = []
            for i, text, changes in zip(ids, texts, edits):
                tree = EditTree(text or "", encoder, border)
                before, chars, leaves = tree.tokens, tree.chars, len(tree.leaves) if text else 0
                changes = [c for c in changes or () if c is not None] if text is not None else []
                for c in changes:
                    tree.edit(c["start"] or 0, c["stop"] or 0, c["text"] or "")
                rows.append((i, before, tree.tokens, chars, tree.chars, leaves, len(changes), tree.reencoded))
            cols = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text", "edits").mapInArrow(run, OUT)


def sample_edits(docs: DataFrame, seed: int = 21) -> DataFrame:
    """Three edits for each text, placed by hash: a passage is deleted, a phrase inserted, a passage replaced by capitals of its
    neighbour."""
    size = F.length("text")
    at = [F.pmod(F.xxhash64("doc_id", F.lit(seed + i)), F.greatest(size, F.lit(1))).cast("long") for i in range(3)]

    def edit(start, stop, text):
        return F.struct(start.alias("start"), stop.alias("stop"), text.alias("text"))

    edits = F.array(edit(at[0], at[0] + 40, F.lit("")), edit(at[1], at[1], F.lit(" it's 42 new-words\n\n and  more")),
                    edit(at[2], at[2] + 25, F.upper(F.substring("text", 1, 30))))
    return docs.select("doc_id", "text", edits.alias("edits"))
