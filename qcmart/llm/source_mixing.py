"""Mixing sources to target weights by Sainte-Lague apportionment, in Spark expressions only.

1. Targets: sources in code point order, null last, weigh 5, 2, 1, repeating. They share all words
   of the corpus by weight; a target stops at 3 times its source's words and the excess goes to the
   others by weight. With all sources sorted by size over weight that is one running sum.
2. Quotas: all words make equal blocks of a few words. Sources get blocks by highest quotients
   target / (2k + 1). The same rule divides a source's blocks among its shards, by words. Instead of
   listing all quotients, two divisors that give too few and too many blocks bracket the answer;
   only the at most two quotients a party has in between are ranked.
3. Selection: a shard's documents lie end to end in a fixed order and are cut into blocks. A quota of
   q out of n blocks takes every block q div n times and q mod n of them once more: those whose
   number, multiplied by a prime and moved by an offset, both drawn from the seed, falls below q mod
   n modulo n. A document takes what its words have in these blocks.

A shard holds about SHARD_WORDS words by hashed id, so a source with a third of all rows is many
shards. Only sources and shards, never documents, are ranked in one window.

Defined results: null or empty text has size 0 and takes 0 words. Null is a source of its own. Rows
of a repeated doc_id are mixed each on its own; equal rows can swap places without effect. Targets
of an empty corpus are 0. Other columns are ignored by the sizes and kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qcmart.llm import common

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
SHARD_WORDS = 131_072
BLOCK_WORDS = 8
SEED = 20240229
#: Any primes that no shard has as its number of blocks.
PRIMES = (1000003, 1000033, 1000037, 1000039, 1000081, 1000099, 1000117, 1000121)


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size of each document, and its source as a key that is never null."""
    docs = common.clean_columns(docs, {"doc_id": "long", "source": "string", "text": "string"})
    return docs.select(
        "doc_id",
        "source",
        n_words().alias("size"),
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("key"),
    )


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """key, source_size, target for each source. One row per source is sorted in one window."""
    by_source = sizes.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), place % len(weights))
    by_source = by_source.withColumn("weight", weight)
    full = F.lit(most) * F.col("source_size")
    by_fullness = Window.orderBy(full / F.col("weight"), "key")
    all_ = Window.partitionBy()
    # if this source and all fuller ones stop, the rest share what is left
    left = F.sum("source_size").over(all_) - F.sum(full).over(by_fullness)
    rest = F.sum("weight").over(all_) - F.sum("weight").over(by_fullness)
    level = F.when(rest > 0, left / rest)
    none_stops = F.sum("source_size").over(all_) / F.sum("weight").over(all_)
    by_source = by_source.withColumns({"level": level, "none_stops": none_stops})
    level = F.greatest(F.max("level").over(all_), "none_stops")
    return by_source.withColumn("level", level).select(
        "key", "source_size", F.least(full.cast("double"), F.col("level") * F.col("weight")).alias("target")
    )


def sainte_lague(parties: DataFrame, group: list[str], key: str, weight: str, seats: str) -> DataFrame:
    """(group, key, won): the seats of each group divided among its parties by highest quotients
    weight / (2k + 1), ties to the smaller key."""
    w = Window.partitionBy(*group)
    votes = parties.where(F.col(weight) > 0).select(
        *group,
        key,
        F.col(weight).cast("double").alias("votes"),
        F.col(seats).cast("long").alias("seats"),
        F.sum(F.col(weight).cast("double")).over(w).alias("all_votes"),
        (F.count(F.lit(1)).over(w) / 2).alias("half"),
    )

    def rounded(total: Column) -> Column:
        return F.floor(F.greatest(total, F.lit(0.0)) * F.col("votes") / F.col("all_votes") + 0.5)

    votes = votes.withColumns(
        {"sure": rounded(F.col("seats") - F.col("half")), "most": rounded(F.col("seats") + F.col("half"))}
    )
    votes = votes.withColumn("open", F.col("seats") - F.sum("sure").over(w))
    more = F.when(F.col("most") > F.col("sure"), F.sequence("sure", F.col("most") - 1))
    bids = votes.select("*", F.explode_outer(more).alias("k"))
    quotient = F.when(F.col("k").isNotNull(), F.col("votes") / (2 * F.col("k") + 1))
    rank = F.row_number().over(w.orderBy(quotient.desc_nulls_last(), key, "k"))
    bids = bids.withColumn("gets", (F.col("k").isNotNull() & (rank <= F.col("open"))).cast("long"))
    return bids.groupBy(*group, key).agg((F.first("sure") + F.sum("gets")).cast("long").alias("won"))


def source_quotas(goals: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The blocks that each source wins, beside its target, and the words of a block."""
    total = F.sum("source_size").over(Window.partitionBy())
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(total / 4096))).cast("long")
    goals = goals.withColumn("block", block)
    blocks = F.round(F.sum("target").over(Window.partitionBy()) / F.col("block"))
    goals = goals.withColumns({"blocks": blocks, "all": F.lit(0)})
    won = sainte_lague(goals, ["all"], "key", "target", "blocks").select("key", "won")
    return goals.join(won, "key", "left").select(
        "key", "source_size", "target", "block", F.coalesce("won", F.lit(0)).alias("seats")
    )


def shard_quotas(
    sizes: DataFrame, goals: DataFrame, shard_words: int = SHARD_WORDS
) -> tuple[DataFrame, DataFrame]:
    """Documents with their shard, and (key, shard, blocks, won) of each shard."""
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words))
    shard = F.pmod(F.xxhash64("doc_id", "size", F.lit(SEED)), shards)
    placed = sizes.join(common.small_side(goals), "key").withColumn("shard", shard)
    parts = placed.groupBy("key", "shard").agg(
        F.sum("size").alias("words"), F.first("seats").alias("seats"), F.first("block").alias("block")
    )
    part_won = sainte_lague(parts, ["key"], "shard", "words", "seats")
    count = F.ceil(F.col("words") / F.col("block"))
    parts = parts.join(part_won, ["key", "shard"], "left").select(
        "key",
        "shard",
        count.alias("blocks"),
        F.least(F.coalesce("won", F.lit(0)), MOST_TIMES * count).alias("won"),
    )
    return placed, parts


def taken_words(placed: DataFrame, parts: DataFrame, seed: int = SEED) -> DataFrame:
    """The words that each document gives to the mix."""
    line = Window.partitionBy("key", "shard").orderBy(
        F.xxhash64("doc_id", F.lit(seed)), "doc_id", "size"
    )
    stop = F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0))
    rows = placed.withColumn("stop", stop).join(parts, ["key", "shard"])
    start = F.col("stop") - F.col("size")
    times, extra = F.floor(F.col("won") / F.col("blocks")), F.col("won") % F.col("blocks")
    drawn = F.xxhash64("key", "shard", F.lit(seed))
    prime = F.get(F.array(*[F.lit(p).cast("long") for p in PRIMES]), F.pmod(drawn, F.lit(len(PRIMES))).cast("int"))
    rows = rows.withColumns(
        {"start": start, "times": times, "extra": extra, "prime": prime, "offset": F.pmod(F.shiftright(drawn, 8), "blocks")}
    )

    def shared(j: Column) -> Column:
        low = F.greatest(F.col("start"), j * F.col("block"))
        return F.least(F.col("stop"), (j + 1) * F.col("block")) - low

    def once_more(j: Column) -> Column:
        return (j * F.col("prime") + F.col("offset")) % F.col("blocks") < F.col("extra")

    numbers = F.sequence(F.floor(F.col("start") / F.col("block")), F.floor((F.col("stop") - 1) / F.col("block")))
    more = F.aggregate(
        numbers, F.lit(0).cast("long"), lambda s, j: s + F.when(once_more(j), shared(j)).otherwise(0)
    )
    partly = F.when((F.col("size") > 0) & (F.col("extra") > 0), more).otherwise(0)
    taken = F.when(F.col("size") > 0, F.col("size") * F.col("times") + partly).otherwise(0)
    return rows.withColumn("taken", taken.cast("long"))


def mix_sizes(sizes: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of documents given as sized() returns them."""
    sizes = common.stored(sizes)
    goals = common.stored(source_quotas(targets(sizes)))
    words, empty = sizes.where("size > 0"), sizes.where("size = 0")
    rows = taken_words(*shard_quotas(words, goals))
    columns = ["doc_id", "source", "size", "source_size", "target", "taken"]
    nothing = empty.join(common.small_side(goals), "key").withColumn("taken", F.lit(0).cast("long"))
    return rows.select(*columns).unionByName(nothing.select(*columns))


def op2_source_mixing(spark, sf_dir: str) -> DataFrame:
    """What each document gives to a mix in which sources weigh 5, 2, 1."""
    mixed = mix_sizes(sized(common.read_table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")
