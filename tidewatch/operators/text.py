"""Note texts: context from earlier rows, tokens, n-grams and TF-IDF weights."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.clock import col

SEPARATOR = " [SEP] "
BLOCK_BYTES = 1 << 24  # text of one block of `tfidf_texts`
HASHED = 1 << 16       # terms hashed at a time
TOKEN = r"[\p{L}\p{N}_]{2,}"  # runs of two or more word characters


def _unaccented() -> tuple[str, str]:
    """Letters of the Latin blocks with their base letter, and combining marks without one, by Unicode decomposition."""
    source, target = "", ""
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(code):
            source, target = source + chr(code), target + base
    return source + "".join(chr(c) for c in range(0x0300, 0x0370)), target


def strip_accents(c: Column | str) -> Column:
    return F.translate(col(c), *_unaccented())


def tokens(c: Column | str) -> Column:
    """Lower-case, accent-free tokens of the whole text."""
    return F.regexp_extract_all(strip_accents(F.lower(col(c))), F.lit(f"({TOKEN})"), F.lit(1))


def unigrams_bigrams(words: str) -> Column:
    """Single words followed by neighbouring pairs."""
    pairs = f"greatest(size({words}) - 1, 0)"
    return F.expr(f"concat({words}, zip_with(slice({words}, 1, {pairs}), slice({words}, 2, {pairs}), "
                  "(a, b) -> concat(a, ' ', b)))")


def truncate_tokens(c: Column | str, n: int = 256) -> Column:
    """First n white-space separated tokens: the input limit of a scoring model."""
    return F.array_join(F.slice(F.split(col(c), r"\s+"), 1, n), " ")


def text_lags(df: DataFrame, keys: Sequence[str], order: str, text: str, bucket: Column, n: int = 2,
              sep: str = SEPARATOR, name: str = "notes_combo") -> DataFrame:
    """Each row's text preceded by the texts of its entity's previous n rows; missing ones count as empty.

    `bucket` must rise with `order`; rows of one entity and time are ordered by their text. Rows are windowed per (entity, bucket), so one entity's texts never meet in one
    task. The last n rows of a bucket are copied into the following buckets of the entity that reach back to them.
    """
    keys = list(keys)
    rows = df.withColumn("_b", bucket).withColumn("_own", F.lit(True))
    tail = Window.partitionBy(*keys, "_b").orderBy(F.col(order).desc(), F.col(text).desc())
    tails = rows.withColumn("_q", F.row_number().over(tail)).filter(F.col("_q") <= n)

    # Per bucket the next n buckets of the entity with the number of rows in between. One narrow row per bucket.
    along = Window.partitionBy(*keys).orderBy("_b")
    sizes = rows.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    nexts = [F.struct(F.lead("_b", i).over(along).alias("_to"),
                      F.coalesce(F.sum("_n").over(along.rowsBetween(1, i - 1)), F.lit(0)).alias("_gap")) if i > 1 else
             F.struct(F.lead("_b", 1).over(along).alias("_to"), F.lit(0).cast("long").alias("_gap"))
             for i in range(1, n + 1)]
    links = sizes.select(*keys, "_b", F.array(*nexts).alias("_nexts")).select(*keys, "_b", F.inline("_nexts"))
    copies = (
        tails.join(links.filter("_to IS NOT NULL"), [*keys, "_b"]).filter(F.col("_q") + F.col("_gap") <= n)
        .withColumn("_b", F.col("_to")).withColumn("_own", F.lit(False)).select(*rows.columns)
    )
    w = Window.partitionBy(*keys, "_b").orderBy(order, text)
    earlier = [F.coalesce(F.lag(text, k).over(w), F.lit("")) for k in range(n, 0, -1)]
    combined = F.concat_ws(sep, *earlier, F.coalesce(F.col(text), F.lit("")))
    return rows.unionByName(copies).withColumn(name, combined).filter("_own").drop("_b", "_own")


def term_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf) over words and word pairs.

    Texts are spread by key before they are split: that moves each text once, where grouping the split terms would move
    every term with its key, and it balances the splitting itself.
    """
    words = df.select(key, text).repartition(key).select(key, tokens(text).alias("_w"))
    return words.select(key, F.explode(unigrams_bigrams("_w")).alias("term")).groupBy(key, "term").agg(
        F.count(F.lit(1)).alias("tf"))


def fit_idf(counts: DataFrame, n_docs: int) -> DataFrame:
    """(term, idf) with idf = ln((1 + n) / (1 + df)) + 1."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select(
        "term", F.expr(f"ln((1D + {n_docs}) / (1D + df)) + 1D").alias("idf"))


def tfidf(counts: DataFrame, idf: DataFrame, key: str) -> DataFrame:
    """(key, term, weight) with weight (1 + ln tf) * idf, scaled to unit length per text; unseen terms drop out.

    Adaptive execution broadcasts the vocabulary while it is small and splits frequent terms otherwise. The length is a
    window over the terms of one text.
    """
    raw = counts.join(idf, "term").select(key, "term", F.expr("(1D + ln(tf)) * idf").alias("_w"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return raw.select(key, "term", (F.col("_w") / norm).alias("weight"))


def _counted(words: pa.Table) -> tuple[pa.ChunkedArray, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Of rows (block, key, words) of a block: its keys, its terms, and per key and term the places of both and tf."""
    keys = words[1].combine_chunks().dictionary_encode(null_encoding="encode")
    lists = words[2].combine_chunks()
    coded = lists.flatten().dictionary_encode()
    word, n = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)
    text = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    key = keys.indices.to_numpy(zero_copy_only=False)[text]
    first = np.flatnonzero(text[1:] == text[:-1])  # words with a next one in their text
    codes, term = np.unique(np.concatenate([word, n + word[first] * n + word[first + 1]]), return_inverse=True)
    single, pair = codes[codes < n], codes[codes >= n] - n
    spelled = coded.dictionary
    if len(codes):
        pairs = pc.binary_join_element_wise(spelled.take(pa.array(pair // n)), spelled.take(pa.array(pair % n)), " ")
        spelled = pa.concat_arrays([spelled.take(pa.array(single)), pairs])
    owned, tf = np.unique(np.concatenate([key, key[first]]) * np.int64(len(codes)) + term, return_counts=True)
    return keys.dictionary, spelled, owned // max(len(codes), 1), owned % max(len(codes), 1), tf


def _block_terms(words: pa.Table) -> pa.Table:
    """(block, term, n): how many keys of the block have the term."""
    _, terms, _, term, _ = _counted(words)
    n = np.bincount(term, minlength=len(terms))
    return pa.table({"block": pa.repeat(words[0][0], len(terms)), "term": terms, "n": pa.array(n.astype(np.int32))})


def squeezed(values: np.ndarray) -> bytes:
    """Size and compressed bytes of an array."""
    return np.int64(values.nbytes).tobytes() + pa.compress(np.ascontiguousarray(values), codec="zstd", asbytes=True)


def spread_out(packed: pa.Scalar, kind: type) -> np.ndarray:
    """The array that `squeezed` took."""
    buffer = packed.as_buffer()
    return np.frombuffer(pa.decompress(buffer[8:], int(np.frombuffer(buffer[:8], np.int64)[0]), codec="zstd"), kind)


def _spelling(terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the terms begin and end in their bytes, and the bytes."""
    ends = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset:terms.offset + len(terms) + 1]
    return ends - ends[0], np.frombuffer(terms.buffers()[2], np.uint8)[ends[0]:ends[-1]]


def _term_parts(terms: pa.Array, n: int) -> np.ndarray:
    """Which of n parts a term belongs to, by a hash of its bytes."""
    out = []
    for first in range(0, len(terms), HASHED):
        ends, spelled = _spelling(terms.slice(first, HASHED))
        size = np.diff(ends)
        power = np.cumprod(np.append(np.uint64(1), np.full(size.max() - 1, 0x9E3779B97F4A7C15, np.uint64)))
        h = np.add.reduceat((spelled + np.uint64(1)) * power[np.arange(len(spelled)) - np.repeat(ends[:-1], size)], ends[:-1])
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        out.append((h >> np.uint64(32)) % np.uint64(n))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def _in_parts(terms: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of distinct terms, ordered by part and spelling, and where the parts 0..n-1 begin and end. The order of rows does not matter."""
    spelled = pc.sort_indices(terms).to_numpy()
    part = _term_parts(terms, n)[spelled]
    return spelled[np.argsort(part, kind="stable")], np.concatenate([[0], np.bincount(part, minlength=n).cumsum()])


def _block_lists(words: pa.Table, n: int) -> pa.Table:
    """(part, block, sizes, spelled, n): the terms of a block as one packed list per part, and how many keys of the block have each."""
    block, terms, count = (c.combine_chunks() for c in _block_terms(words).columns)
    order, borders = _in_parts(terms, n)
    terms, count = terms.take(pa.array(order)), count.to_numpy()[order]
    rows = []
    for part in np.flatnonzero(np.diff(borders)).tolist():
        lo, hi = borders[part:part + 2].tolist()
        ends, spelled = _spelling(terms.slice(lo, hi - lo))
        rows.append((part, block[0].as_py(), *map(squeezed, (np.diff(ends), spelled, count[lo:hi]))))
    columns = list(zip(*rows)) or [()] * 5
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), *[pa.binary()] * 3))], ["part", "block", "sizes", "spelled", "n"])


def _counted_elsewhere(lists: pa.Table) -> pa.Table:
    """(block, part, others): in how many keys of other blocks the terms of each list of a part are, in the list's order."""
    lists = lists.combine_chunks()
    terms, counts = [], []
    for sizes, spelled, n in zip(*(lists[c] for c in ("sizes", "spelled", "n"))):
        ends = np.append(0, spread_out(sizes, np.int32).cumsum()).astype(np.int32)
        terms.append(pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(spread_out(spelled, np.uint8))))
        counts.append(spread_out(n, np.int32))
    coded = pa.chunked_array(terms).cast(pa.large_string()).combine_chunks().dictionary_encode()
    code, count = coded.indices.to_numpy(zero_copy_only=False), np.concatenate(counts)
    others = (np.bincount(code, count, len(coded.dictionary))[code] - count).astype(np.int32)
    packed = [squeezed(o) for o in np.split(others, np.cumsum([len(c) for c in counts])[:-1])]
    return pa.table([lists["block"], lists["part"], pa.array(packed, pa.binary())], ["block", "part", "others"])


def _block_weights(words: pa.Table, elsewhere: pa.Table, n_docs: int, n: int) -> pa.Table:
    """(key, term, weight) of a block; `elsewhere` has what `_counted_elsewhere` found for its lists."""
    keys, terms, key, term, tf = _counted(words)
    df = np.bincount(term, minlength=len(terms))
    lists = elsewhere.combine_chunks().sort_by("part")["others"]
    if len(lists):
        df[_in_parts(terms, n)[0]] += np.concatenate([spread_out(o, np.int32) for o in lists])
    raw = (1.0 + np.log(tf)) * (np.log((1.0 + n_docs) / (1.0 + df)) + 1.0)[term]
    norm = np.sqrt(np.bincount(key, raw * raw, len(keys)))
    out = pa.table([keys.take(pa.array(key)), terms.take(pa.array(term)), pa.array(raw / norm[key])],
                   [words.column_names[1], "term", "weight"])
    return pa.Table.from_batches(out.to_batches(max_chunksize=1 << 16), out.schema)


def tfidf_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """`tfidf` of texts with the idf of the same texts, without moving the terms of every text.

    Keys are dealt into blocks of about BLOCK_BYTES of text. A block sends each of its terms once, with the number of its keys
    that have it, as one packed list of sorted terms per part of all terms; what comes back are numbers only, in the order of the
    lists. Texts move once and stay. Texts of one key count as one.
    """
    n_docs, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK_BYTES))
    block = F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias("block")
    words = df.select(block, key, text).repartitionById(n, F.col("block")).select("block", key, tokens(text).alias("words"))

    def send(mine: pa.Table) -> pa.Table:
        return _block_lists(mine, n)

    sent = words.groupBy("block").applyInArrow(send, "part int, block int, sizes binary, spelled binary, n binary")
    counted = sent.repartitionById(n, F.col("part")).groupBy("part").applyInArrow(_counted_elsewhere, "block int, part int, others binary")

    def weigh(mine: pa.Table, elsewhere: pa.Table) -> pa.Table:
        return _block_weights(mine, elsewhere, n_docs, n)

    kind = df.schema[key].dataType.simpleString()
    return words.groupBy("block").cogroup(counted.repartitionById(n, F.col("block")).groupBy("block")).applyInArrow(
        weigh, f"`{key}` {kind}, term string, weight double")


def batch_text_score(df: DataFrame, text: str, keep: Sequence[str], make_predict: Callable[[], Callable],
                     name: str = "p_text", max_tokens: int | None = None) -> DataFrame:
    """Score texts with a caller-supplied model in Arrow batches.

    `make_predict()` runs once per task, e.g. to load weights, and returns a function from a pandas Series of texts to
    probabilities.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    body = truncate_tokens(body, max_tokens) if max_tokens else body
    narrow = df.select(*keep, body.alias("_text"))

    def score(batches: Iterator) -> Iterator:
        predict = make_predict()
        for pdf in batches:
            yield pdf[list(keep)].assign(**{name: predict(pdf["_text"])})

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema if f.name != "_text")
    return narrow.mapInPandas(score, f"{fields}, {name} double")
