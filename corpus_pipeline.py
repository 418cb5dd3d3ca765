"""A training corpus from documents: five stages, each an operator of qcmart.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.

1. toxicity: documents predicted toxic go.
2. near_dedup: of each group of near copies (5-word shingles, similarity 0.8) the smallest doc_id
   stays.
3. decontamination: documents that leak a benchmark item go.
4. secrets: live credentials are replaced in the text; no document goes.
5. mixing: what each document that is left gives to the mix of sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qcmart.llm import common, decontamination, near_dedup, secret_scan, source_mixing, toxicity


def _key():
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the model, fitted on the labels, takes for toxic go."""
    text = docs.select("doc_id", "text")
    model = toxicity.Model(text, common.read_table(spark, sf_dir, "labels"))
    keyed = text.select(_key().alias("key"), "text")
    bad = model.transform(keyed, "key long").where("score >= 0.5").select("key").distinct()
    return docs.join(common.small_side(common.stored(bad)), _key() == F.col("key"), "left_anti")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: its smallest doc_id. Rows are told apart by id
    and text; one without an id goes only if its words are those of one with an id."""
    own = F.col("doc_id").cast("long")
    rows = docs.select(_key().alias("key"), own.alias("own"), F.when(own.isNotNull(), _key()).alias("doc_id"), "text")
    rows = common.stored(near_dedup.near_duplicates(rows, keep="key long, own long"))
    # of groups of one key nothing goes
    smallest = rows.groupBy("component_id").agg(
        F.min("own").alias("smallest"), F.min("key").alias("a"), F.max("key").alias("b")
    )
    smallest = common.small_side(common.stored(smallest.where("a <> b").select("component_id", "smallest")))
    gone = rows.join(smallest, "component_id").where("own is null or own <> smallest")
    gone = common.small_side(common.stored(gone.select("key").distinct()))
    return docs.join(gone, _key() == F.col("key"), "left_anti")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that leak a benchmark item go."""
    found = decontamination.leaks(docs, common.read_table(spark, sf_dir, "benchmark"))
    found = common.small_side(common.stored(found.select("key").distinct()))
    return docs.join(found, _key() == F.col("key"), "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live credentials are replaced."""
    return secret_scan.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of what is left."""
    return source_mixing.mix_sizes(source_mixing.sized(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("mixing", mix),
]

#: The stages learn, sign and draw; SQL can't express that, so run() is tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = common.read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
