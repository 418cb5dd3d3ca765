"""Benchmark decontamination by spaced seeds, in Spark expressions only.

Tokens are runs of letters and digits, lower-cased. A document leaks an item if, on one alignment,
12 consecutive tokens of both agree in at least 10 places. A shorter item must occur as a whole; one
of fewer than 5 tokens can't identify anything and never matches.

Seeds are hashes of the tokens that a mask keeps: ``11111`` and ``1101011``. However two
substitutions fall into 12 tokens, one of these masks fits between them at some place, so the seeds
find every alignment that the rule accepts. Seeds of documents and items are joined, each hit names an
alignment, and on each alignment the tokens themselves are compared.

The seeds of the items are broadcast if they are few, and shuffled otherwise. A seed that occurs in a
third of all documents is just as many hits; they are made distinct by alignment before a shuffle.

Defined results: null or empty texts on either side leak nothing. An item or document that is
repeated is reported under its own id; rows that share a doc_id are reported together, one row per
doc_id and item_id, with the largest agreement. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qcmart.llm import common

MASKS = ("11111", "1101011")
WINDOW = 12
AGREE = 10
LEAST_TOKENS = 5


def tokens(text: str = "text") -> Column:
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(words, lambda w: w != "")


def seeds(rows: DataFrame, *keep: str) -> DataFrame:
    """(keep, seed, at) for every mask at every place of ``tokens`` where it fits."""
    longest = max(map(len, MASKS))
    hashes = rows.select(*keep, F.transform("tokens", lambda w: F.xxhash64(w)).alias("h"))
    n = F.size("h")
    shifted = [F.slice("h", k + 1, F.greatest(n - k, F.lit(0))) for k in range(longest)]
    zipped = F.arrays_zip(*shifted)
    # one row per place with the tokens that follow it; null beyond the end
    places = hashes.select(*keep, F.posexplode(zipped).alias("at", "w"))

    def seed(number: int, mask: str) -> Column:
        kept = [F.col("w")[str(k)] for k, bit in enumerate(mask) if bit == "1"]
        return F.when(kept[-1].isNotNull(), F.xxhash64(F.lit(number), *kept))

    all_ = F.array(*[seed(k, m) for k, m in enumerate(MASKS)])
    found = places.select(*keep, "at", F.explode(all_).alias("seed"))
    return found.where("seed is not null")


def alignments(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(key, item_id, shift): a seed at place p of an item is at place p + shift of a document."""
    known = common.stored(seeds(items, "item", "item_id").withColumnRenamed("at", "item_at"))
    hits = seeds(docs, "key").join(common.small_side(known), "seed")
    return hits.select("key", "item", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct()


def agreement() -> tuple[Column, Column]:
    """For an alignment: which of the item's tokens agree, and from that the most in a window."""
    n = F.size("item_tokens")
    width = F.least(F.lit(WINDOW), n)
    same = F.transform(
        "item_tokens",
        lambda w, p: F.when(
            (p + F.col("shift") >= 0) & F.coalesce(F.get("tokens", p + F.col("shift")) == w, F.lit(False)), 1
        ).otherwise(0),
    )

    def agreed(p: Column) -> Column:
        part = F.slice(F.col("same"), p, width)
        return F.aggregate(part, F.lit(0), lambda a, b: a + b)

    return same, F.array_max(F.transform(F.sequence(F.lit(1), n - width + 1), agreed))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, key, item_id, n_agree, n_tokens (the item's), first_token (in the document)."""
    docs = common.clean_columns(docs, {"doc_id": "long", "text": "string"})
    docs = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), tokens().alias("tokens"))
    items = common.clean_columns(benchmark, {"item_id": "long", "text": "string"})
    items = items.select(
        "item_id", F.xxhash64("item_id", "text").alias("item"), tokens().alias("item_tokens")
    ).where(F.size("item_tokens") >= LEAST_TOKENS)
    found = common.stored(alignments(docs, items.withColumnRenamed("item_tokens", "tokens")))
    texts = items.select("item", "item_tokens").dropDuplicates(["item"])
    rows = docs.join(common.small_side(found.select("key").distinct()), "key", "left_semi")
    rows = rows.join(common.small_side(found), "key").join(texts, "item")
    same, agreed = agreement()
    rows = rows.withColumn("same", same).withColumn("n_agree", agreed)
    need = F.when(F.size("item_tokens") >= WINDOW, F.lit(AGREE)).otherwise(F.size("item_tokens"))
    rows = rows.where(F.col("n_agree") >= need)
    return rows.select(
        "doc_id",
        "key",
        "item_id",
        F.col("n_agree").cast("long").alias("n_agree"),
        F.size("item_tokens").cast("long").alias("n_tokens"),
        F.aggregate("same", F.lit(0), lambda a, b: a + b).cast("long").alias("n_same"),
    )


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    """The documents that leak benchmark items, with how many of an item's tokens agree."""
    found = leaks(
        common.read_table(spark, sf_dir, "documents"), common.read_table(spark, sf_dir, "benchmark")
    )
    return found.groupBy("doc_id", "item_id").agg(
        F.max("n_agree").alias("n_agree"), F.max("n_same").alias("n_same"), F.max("n_tokens").alias("n_tokens")
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS t
  FROM documents
), i AS (
  SELECT * FROM (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'),
    lambda w: w <> '') AS t FROM benchmark) WHERE len(t) >= 5
), dw AS (SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS p FROM d),
iw AS (SELECT item_id, len(t) AS n, unnest(t) AS w, generate_subscripts(t, 1) AS p FROM i),
m AS (
  SELECT doc_id, item_id, n, dw.p - iw.p AS shift, iw.p AS p FROM dw JOIN iw USING (w)
), c AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id, item_id, shift ORDER BY p
    RANGE BETWEEN CURRENT ROW AND 11 FOLLOWING) AS agree,
    count(*) OVER (PARTITION BY doc_id, item_id, shift) AS same FROM m
)
SELECT doc_id, item_id, max(agree)::BIGINT AS n_agree, max(same)::BIGINT AS n_same, max(n)::BIGINT AS n_tokens
FROM c WHERE agree >= CASE WHEN n >= 12 THEN 10 ELSE n END GROUP BY doc_id, item_id
"""
