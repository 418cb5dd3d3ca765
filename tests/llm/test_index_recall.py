"""Recall of the inverted multi-index, and the share of the vectors that it looks at."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from qcmart.llm import multi_index


def table_of(spark, vectors):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(8)


def test_recall_at_a_small_share(spark):
    """24,000 vectors around 300 centres, and a sixth more that are one vector: of the ten nearest at least
    0.9 are found, looking at under 0.2 of all vectors (the copies' own cell apart)."""
    random = np.random.default_rng(4)
    centers = random.normal(size=(300, 16))
    vectors = centers[random.integers(0, 300, 24_000)] + 0.35 * random.normal(size=(24_000, 16))
    vectors = np.concatenate([vectors, np.repeat(vectors[:1], 4_000, 0)])
    table = table_of(spark, vectors)
    asked = table.where("vec_id % 50 = 0 and vec_id < 24000").select(F.col("vec_id").alias("query_id"))
    got = multi_index.search(table, asked).toPandas()
    queries = sorted(got["query_id"].unique())
    assert queries == list(range(0, 24_000, 50))
    hits = 0
    for q, rows in got.groupby("query_id"):
        away = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        away[q] = np.inf
        near = np.lexsort((np.arange(len(away)), away))[:10]
        hits += len(set(near.tolist()) & set(rows["vec_id"]))
        rows = rows.sort_values("rank")
        assert rows["rank"].tolist() == list(range(1, 11))
        assert np.allclose(rows["score"], away[rows["vec_id"]], rtol=1e-12)
    assert hits >= 0.9 * 10 * len(queries)
    looked_at = got.groupby("query_id")["looked_at"].first().median()
    assert looked_at < 0.2 * len(vectors)


@pytest.mark.parametrize("chunk", [4096, 3])
def test_blocks_of_many_queries_are_sent_in_chunks(spark, monkeypatch, chunk):
    monkeypatch.setattr(multi_index, "CHUNK", chunk)
    monkeypatch.setattr(multi_index, "BLOCK", 50)
    vectors = np.random.default_rng(2).normal(size=(400, 2))
    table = table_of(spark, vectors)
    asked = table.where("vec_id < 60").select(F.col("vec_id").alias("query_id"))
    got = multi_index.search(table, asked).toPandas()
    assert got.groupby("query_id")["rank"].max().tolist() == [10] * 60
    assert not got.duplicated(["query_id", "vec_id"]).any()
    hits = 0
    for q, rows in got.groupby("query_id"):
        away = ((vectors - vectors[q]) ** 2).sum(1)
        away[q] = np.inf
        hits += len(set(np.argsort(away)[:10].tolist()) & set(rows["vec_id"]))
    assert hits >= 0.95 * 600


def test_few_vectors_are_all_found(spark):
    vectors = np.random.default_rng(3).normal(size=(7, 4))
    table = table_of(spark, vectors)
    asked = table.select(F.col("vec_id").alias("query_id"))
    got = multi_index.search(table, asked).toPandas()
    assert got.groupby("query_id").size().tolist() == [6] * 7
    assert multi_index.search(table, asked.limit(0)).count() == 0
