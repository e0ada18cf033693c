"""Registered queries of the subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tidewatch.llm import backoff_lm, html_main, langid, mixing, ngram_join, prefix_trie, quality_forest, sentencepiece_backend, simhash_join, token_align, token_edits, topk_bitslice, toxicity
from tidewatch.session import configure
from tidewatch.sources.tables import load


def text_session(spark):
    """The library's settings, and small Arrow batches: texts may be long, and two tasks share an executor's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return configure(spark)


TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def op1_sliced_topk(spark, sf_dir):
    return topk_bitslice.top_k(load(text_session(spark), sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_source_mix(spark, sf_dir):
    return mixing.mix(load(text_session(spark), sf_dir, "documents"))


def op3_toxicity(spark, sf_dir):
    spark = text_session(spark)
    docs = load(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"),
                                              F.round("score", 9).alias("score"), "predicted")


def op4_language(spark, sf_dir):
    docs = load(text_session(spark), sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    found = langid.predict(docs, langid.fit(docs, ~held_out))
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", F.round("score", 6).alias("score"))


def op5_ngram_join(spark, sf_dir):
    return ngram_join.join(load(text_session(spark), sf_dir, "documents"))


def op6_quality_forest(spark, sf_dir):
    spark = text_session(spark)
    out = quality_forest.judge(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      F.round("score", 6).alias("score"))


def op7_token_edits(spark, sf_dir):
    docs = token_edits.sample_edits(load(text_session(spark), sf_dir, "documents"))
    with open(f"{TOKENIZERS}/byte_bpe_50k.tiktoken", "rb") as f:
        return token_edits.count_edited(docs, f.read())


def op8_backoff_lm(spark, sf_dir):
    scored = backoff_lm.score(load(text_session(spark), sf_dir, "documents"))
    return scored.withColumn("log_score", F.round("log_score", 6))


def op9_sentencepiece(spark, sf_dir):
    spark = text_session(spark)
    model = sentencepiece_backend.load_model(spark, f"{TOKENIZERS}/piece_bpe_32k.model")
    coded = sentencepiece_backend.encode(load(spark, sf_dir, "documents"), model)
    return coded.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
                        F.xxhash64("ids").alias("ids_digest"), "round_trip", "parity")


def op10_html_main(spark, sf_dir):
    text = html_main.extract(load(text_session(spark), sf_dir, "pages"))
    return text.withColumn("n_chars", F.length("text").cast("long"))


def op11_simhash_join(spark, sf_dir):
    out = simhash_join.join(load(text_session(spark), sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op12_prefix_trie(spark, sf_dir):
    nodes = prefix_trie.trie(prefix_trie.rebuild(load(text_session(spark), sf_dir, "conversations")))
    return nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))


def op13_token_align(spark, sf_dir):
    spark = text_session(spark)
    files = token_align.load_files(spark, f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")
    return token_align.align(load(spark, sf_dir, "documents"), files, token_align.digest_batches, token_align.DIGESTS)


QUERIES = {f.__name__: f for f in (op1_sliced_topk, op2_source_mix, op3_toxicity, op4_language, op5_ngram_join, op6_quality_forest, op7_token_edits, op8_backoff_lm, op9_sentencepiece, op10_html_main, op11_simhash_join, op12_prefix_trie, op13_token_align)}
ORACLES: dict[str, str] = {
    "op1_sliced_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) q FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))) IS NOT FALSE),
        d AS (SELECT vec_id, unnest(q) x, generate_subscripts(q, 1) i FROM v),
        s AS (SELECT a.vec_id query_id, b.vec_id, CAST(sum(a.x * b.x) AS BIGINT) score FROM d a JOIN d b USING (i)
              WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id GROUP BY 1, 2)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) "rank", vec_id, score
        FROM s QUALIFY "rank" <= 20""",
    # crc32 in eight steps a byte; a prefix is a list of turns
    "op12_prefix_trie": """
        WITH t AS (SELECT conv_id, turn, {'r': coalesce(role, ''), 'x': coalesce(text, '')} v FROM conversations WHERE conv_id IS NOT NULL),
        own AS (SELECT conv_id, list(v ORDER BY turn NULLS FIRST) turns FROM t GROUP BY conv_id),
        h AS (SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 h FROM own),
        c AS (SELECT h.conv_id, list_concat(coalesce(b.turns[1:h.h], []), h.turns[h.h + 1:]) s FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 100),
        p AS (SELECT conv_id, s, unnest(generate_series(0, len(s))) d FROM c),
        member AS (SELECT conv_id, d, s[1:d] prefix, s[1:d - 1] above, len(s) = d ends FROM p),
        node AS (SELECT prefix, d, min(conv_id) conv_id, count(*) n, any_value(above) above,
                        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) sha
                 FROM member GROUP BY prefix, d),
        kids AS (SELECT above prefix, count(*) n_children FROM node WHERE d > 0 GROUP BY above),
        full_node AS (SELECT node.*, coalesce(n_children, 0) n_children FROM node LEFT JOIN kids USING (prefix)),
        below AS (SELECT prefix[1:up] prefix, n_children, (n - 1) * coalesce(length(prefix[d].x), 0) saved
                  FROM (SELECT *, unnest(generate_series(0, d)) up FROM full_node)),
        total AS (SELECT prefix, count(*) FILTER (n_children = 0) n_leaves, CAST(sum(saved) AS BIGINT) saved_tokens FROM below GROUP BY prefix)
        SELECT a.conv_id, a.d depth, parent.conv_id parent_conv_id, a.n n_convs, a.n_children, n_leaves, saved_tokens, a.sha ends_sha256
        FROM full_node a JOIN total USING (prefix) LEFT JOIN node parent ON a.d > 0 AND parent.prefix = a.above""",
}
