"""Mixing sources to target weights, with DataFrame functions only.

Texts of a source are laid end to end in a pseudorandom order and cut into blocks of a fixed number of words. The mix is a
run of slots, dealt to output shards. Each shard draws how many of its slots every source gets (a multinomial draw with one
uniform per slot, spread evenly over the shard, so that totals stay near the targets). The slots of a source are numbered
through; a pseudorandom permutation of the block numbers (the swap-or-not shuffle, a bijection on any range) tells which
block a slot takes, and blocks meet the texts by block number.

Defined cases: a null or wordless text has size 0 and takes 0; a null source is a source of its own and ranks last; repeated
rows count as texts of their own; an empty table gives no rows; columns besides the three named ones are not looked at.
A source's totals and its weight are rows of a table with one row per source; only that table is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.sources.storage import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BLOCK = 64        # words
SHARD = 1024      # slots of an output shard
ROUNDS = 12       # of the shuffle
TASK_SLOTS = 100_000
CELLS = 1024      # of the grid on [0, 1) by which slots meet sources
RUN = 2048        # rows ordered together
SEED = 7


def _unit(*key: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") / F.lit(float(1 << 53))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """One row per source: sid, source_size, n_rows, target. `share` of all words is dealt by weight; what exceeds `limit`
    times a source's words goes to the others by weight. Sources in order of the ratio limit / weight fill up one by one."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("sid", rank.cast("long"))
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int")))
    per = per.withColumn("top", limit * F.col("source_size")).withColumn("ratio", F.col("top") / F.col("w"))
    every = Window.partitionBy()
    before = Window.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, -1)
    full = (F.coalesce(F.sum("top").over(before), F.lit(0.0))
            + F.col("ratio") * (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
            <= share * F.sum("source_size").over(every))
    per = per.withColumn("full", full)
    rest = share * F.sum("source_size").over(every) - F.sum(F.when(F.col("full"), F.col("top")).otherwise(0.0)).over(every)
    free = F.sum(F.when(~F.col("full"), F.col("w")).otherwise(0.0)).over(every)
    per = per.withColumn("target", F.when(F.col("full"), F.col("top")).otherwise(rest / free * F.col("w")))
    return per.select("source", "sid", "source_size", "n_rows", "target")


def _placed(sizes: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Texts with words, each with the offset of its first word in its source. The order is by hash; runs of about RUN rows
    are summed first, so that no source is ordered in one task."""
    rows = sizes.where("size > 0").join(sources.select("source", "sid", "n_rows"), sizes.source.eqNullSafe(sources.source))
    rows = rows.select("sid", "doc_id", "size", F.xxhash64("doc_id", "size", F.lit(seed)).alias("h"),
                       F.ceil(F.col("n_rows") / RUN).alias("runs"))
    rows = rows.withColumn("run", F.floor(_unit(F.col("h")) * F.col("runs")))
    runs = rows.groupBy("sid", "run").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("sid").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("sid", "run", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("base"))
    within = Window.partitionBy("sid", "run").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("size").over(within))
    return rows.join(runs, ["sid", "run"]).select(
        "sid", "doc_id", "size", (F.col("base") + F.col("upto") - F.col("size")).alias("off"))


def shard_counts(sources: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """(shard, sid, slots): how many of a shard's slots each source gets."""
    spark = sources.sparkSession
    live = sources.where("target > 0").withColumn("blocks", F.ceil(F.col("source_size") / block))
    live = live.withColumn("want", F.col("target") * F.col("blocks") / F.col("source_size"))
    total = live.agg(F.sum("want")).first()[0] or 0.0
    n = round(total)
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    cdf = live.withColumn("hi", F.sum("want").over(upto) / max(total, 1e-300))
    cdf = cdf.withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("sid")), F.lit(0.0)))
    cdf = cdf.withColumn("hi", F.when(F.lead("hi").over(Window.orderBy("sid")).isNull(), 2.0).otherwise(F.col("hi")))
    cell = F.explode(F.sequence(F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1))))
    cells = cdf.where("lo < 1").select("sid", "lo", "hi", cell.alias("cell"))
    slots = spark.range(n).withColumn("shard", F.floor(F.col("id") / shard))
    of = F.least(F.lit(shard), F.lit(n) - F.col("shard") * shard)
    slots = slots.withColumn("u", (F.col("id") % shard + _unit(F.col("id"), F.lit(seed + 1))) / of)
    slots = slots.withColumn("cell", F.least(F.floor(F.col("u") * CELLS), F.lit(CELLS - 1)))
    dealt = slots.join(cells, "cell").where("u >= lo and u < hi")
    return dealt.groupBy("shard", "sid").agg(F.count("*").alias("slots"))


def permuted(x: Column, n: Column, key: list[Column], seed: int = SEED, rounds: int = ROUNDS) -> Column:
    """Swap-or-not shuffle: a pseudorandom bijection of [0, n) chosen by `key`."""
    def turn(acc, r):
        pivot = F.pmod(F.xxhash64(r, *key, F.lit(seed + 2)), n)
        other = F.pmod(pivot - acc, n)
        coin = F.xxhash64(F.greatest(acc, other), r, *key, F.lit(seed + 3))
        return F.when(coin.bitwiseAND(F.lit(1)) == 1, other).otherwise(acc)
    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), x, turn)


def block_takes(sources: DataFrame, limit: float = 2.0, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """(sid, block, times): the blocks that the slots take. No block is taken more than `limit` times."""
    counts = shard_counts(sources, block, shard, seed).withColumn("part", F.floor(F.col("shard") / 1024))
    parts = counts.groupBy("sid", "part").agg(F.sum("slots").alias("n"))
    ahead = Window.partitionBy("sid").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("sid", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))
    within = Window.partitionBy("sid", "part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("first", F.coalesce(F.sum("slots").over(within), F.lit(0)))
    counts = counts.join(parts, ["sid", "part"]).join(
        sources.select("sid", F.ceil(F.col("source_size") / block).alias("blocks")), "sid")
    # a row here stands for up to `shard` slots: few bytes, much work, so the number of tasks goes by the slots
    total = sources.where("target > 0").agg(F.sum(F.col("target") / block)).first()[0] or 0.0
    counts = counts.repartition(max(1, round(total / TASK_SLOTS)), "sid", "shard")
    first = F.col("base") + F.col("first")
    slots = counts.select("sid", "blocks", F.explode(F.sequence(first, first + F.col("slots") - 1)).alias("i"))
    slots = slots.where(F.col("i") < F.floor(F.lit(limit)) * F.col("blocks"))
    place = permuted(F.pmod(F.col("i"), F.col("blocks")), F.col("blocks"), [F.col("sid"), F.floor(F.col("i") / F.col("blocks"))], seed)
    return slots.select("sid", place.alias("block")).groupBy("sid", "block").agg(F.count("*").alias("times"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, limit: float = 2.0, block: int = BLOCK, shard: int = SHARD,
        seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken: the words of each text that the mix takes, repeats counted."""
    sizes = stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    sources = stage(source_targets(sizes, weights, share, limit), "mix-sources")
    end = F.col("off") + F.col("size")
    pieces = _placed(sizes, sources, seed).withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("off") / block), F.floor((end - 1) / block))))
    pieces = pieces.withColumn(
        "words", F.least(end, (F.col("block") + 1) * block) - F.greatest(F.col("off"), F.col("block") * block))
    taken = (pieces.join(block_takes(sources, limit, block, shard, seed), ["sid", "block"], "left")
             .groupBy("sid", "off", "doc_id", "size")
             .agg(F.sum(F.col("words") * F.coalesce(F.col("times"), F.lit(0))).cast("long").alias("taken"))
             .select("sid", "doc_id", "size", "taken"))
    none = sizes.where("size = 0").join(sources, sizes.source.eqNullSafe(sources.source)).select(
        "sid", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    return taken.unionByName(none).join(sources.select("sid", "source_size", "target"), "sid").select(
        "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), "taken")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The documents themselves as the mix has them: each row as often as its words are taken, the fraction settled by a hash.
    Rows that share a doc_id share their count."""
    per = mix(docs, **options).groupBy("doc_id").agg(F.sum("taken").alias("t"), F.sum("size").alias("s"))
    ratio = F.when(F.col("s") > 0, F.col("t") / F.col("s")).otherwise(0.0)
    copies = F.floor(ratio) + (_unit(F.col("doc_id"), F.lit(options.get("seed", SEED) + 4)) < ratio - F.floor(ratio)).cast("long")
    per = per.select(F.col("doc_id").alias("mix_key"), copies.alias("mix_copies")).where("mix_copies > 0")
    out = docs.join(per, docs.doc_id.eqNullSafe(per.mix_key))
    return out.withColumn("mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies")))).select(
        *[out[c] for c in docs.columns])
