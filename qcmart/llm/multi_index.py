"""Approximate nearest neighbours by an inverted multi-index.

Fitting: both halves of the vectors are clustered apart, on a bounded sample (SAMPLE vectors of the
smallest hashed ids). The number K of centroids of a half grows with the table, so that the K * K cells
hold about CELL vectors each, up to MOST_CENTROIDS, which bounds what the driver keeps of the cells.

Index: every vector goes to the cell of its two nearest centroids. Cells in order are cut into blocks
of BLOCK vectors by hashed id, so a cell with a third of all vectors is many blocks.

Calibration: TRIES of the queries (of the smallest hashed ids) are held against all rows by brute force, in
the tasks that hold the rows. How many vectors a query looks at is the smallest number, at every size of
table, with which the index finds RECALL of their true nearest.

Search: from the two lists of centroids by distance a heap yields cells by increasing sum of the
two squared distances, until they hold that many vectors. A query goes, with its cells, to each
block that holds some; there the entries of its cells are reranked by exact distances and the nearest
kept, and these lists meet. A block that more than CHUNK queries look at is copied for each chunk of
them, any other is sent once, and one that none looks at stays.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor
do those whose length is not the commonest, nor rows without an id. Rows that share an id count as
one, with the smallest vector. Equal distances go to the smaller id. With fewer candidates than asked
for, all are found. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qcmart.llm import common

SAMPLE = 16_384
CELL = 4
MOST_CENTROIDS = 512
ROUNDS = 12
RECALL = 0.95
TRIES = 200
BLOCK = 8_192
CHUNK = 4_096
QUERIES_A_TASK = 128
SEED = 11


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (array of double) of the rows that take part, ids distinct."""
    rows = common.clean_columns(vectors, {"vec_id": "long", "embedding": "array<double>"})
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    )
    rows = rows.where(
        F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    )
    rows = rows.groupBy("vec_id").agg(F.min("embedding").alias("vector"))
    rows = common.stored(rows)
    most = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vector") == (most["n"] if most else 0))


def kmeans(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centroids by Lloyd's rounds; an empty cluster keeps its centroid."""
    random = np.random.default_rng(seed)
    centers = points[random.permutation(len(points))[:k]].copy()
    for _ in range(ROUNDS):
        near = nearest(points, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=len(centers))
        full = counts > 0
        centers[full] = sums[full] / counts[full, None]
    return centers


def squared(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    out = (points**2).sum(1)[:, None] + (centers**2).sum(1) - 2 * points @ centers.T
    return np.maximum(out, 0)


def nearest(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.concatenate(
        [squared(points[a : a + 4096], centers).argmin(1) for a in range(0, len(points), 4096)]
        or [np.empty(0, np.int64)]
    )


class Codebooks:
    """The centroids of both halves."""

    def __init__(self, sample: np.ndarray, total: int) -> None:
        most = min(MOST_CENTROIDS, math.ceil(math.sqrt(total / CELL)))
        self.cut = max(1, sample.shape[1] // 2)
        halves = sample[:, : self.cut], sample[:, self.cut :]
        self.centers = [kmeans(h, most, SEED + k) for k, h in enumerate(halves)]
        self.width = len(self.centers[1])

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        left = nearest(vectors[:, : self.cut], self.centers[0])
        return left * self.width + nearest(vectors[:, self.cut :], self.centers[1])

    def distances(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (
            squared(vectors[:, : self.cut], self.centers[0]),
            squared(vectors[:, self.cut :], self.centers[1]),
        )


def traverse(left: np.ndarray, right: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
    """Cells with vectors, by increasing sum of both distances, until they hold enough vectors."""
    by_left, by_right = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    a, b = left[by_left].tolist(), right[by_right].tolist()
    rows, columns = by_left.tolist(), by_right.tolist()
    width, held, out = len(b), 0, []
    reached = [0] * len(a)  # in each row, the columns taken so far
    heap = [(a[0] + b[0], 0, 0)]
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = rows[i] * width + columns[j]
        n = int(counts[cell])
        if n:
            out.append(cell)
            held += n
        reached[i] = j + 1
        # the next in this row, and in the next row the same column, once their other neighbour is out
        if j + 1 < width and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if i + 1 < len(a) and reached[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
    return out


def exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(((vectors - query) ** 2).sum(1))


def nearest_of(tries: np.ndarray, ids: np.ndarray, entries: DataFrame, k: int) -> DataFrame:
    """(place, cell) for the k true nearest of each of a bounded number of vectors: every task keeps
    the k nearest of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.empty((len(ids), 0), t) for t in (np.float64, np.int64, np.int32)]
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column("vec_id").to_numpy()
            away = squared(tries, _unpacked(batch.column("vector")))
            away[ids[:, None] == names] = np.inf
            new = away, *(np.broadcast_to(x, away.shape) for x in (names, batch.column("cell").to_numpy()))
            best = [np.concatenate(x, 1) for x in zip(best, new, strict=True)]
            order = np.lexsort((best[1], best[0]))[:, :k]
            best = [np.take_along_axis(x, order, 1) for x in best]
        away, names, cells = best
        place = np.repeat(np.arange(len(ids), dtype=np.int32), away.shape[1])
        some = np.isfinite(away.ravel())
        columns = {"place": place, "away": away.ravel(), "vec_id": names.ravel(), "cell": cells.ravel()}
        yield pa.RecordBatch.from_pydict({n: pa.array(x[some]) for n, x in columns.items()})

    near = entries.mapInArrow(run, "place int, away double, vec_id long, cell int")
    by_distance = Window.partitionBy("place").orderBy("away", "vec_id")
    near = near.withColumn("rank", F.row_number().over(by_distance)).where(F.col("rank") <= k)
    return near.select("place", "cell")


def needed(books: Codebooks, counts: np.ndarray, tries: np.ndarray, true: pa.Table) -> int:
    """How many vectors have to be looked at to find RECALL of the true nearest of the tries."""
    places, cells = true.column("place").to_numpy(), true.column("cell").to_numpy()
    if not len(places):
        return 0
    left, right = books.distances(tries)
    before = []
    for t in range(len(tries)):
        away = (left[t][:, None] + right[t]).ravel()
        order = np.argsort(away, kind="stable")
        held = np.empty(len(counts), np.int64)
        held[order] = np.cumsum(counts[order]) - counts[order]
        # a vector is found while the cells before its own don't hold enough
        before.append(held[cells[places == t]])
    before = np.sort(np.concatenate(before))
    return int(before[math.ceil(RECALL * len(before)) - 1]) + 1


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equally long arrays without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _packed(vectors: np.ndarray) -> list[bytes]:
    return [v.tobytes() for v in vectors]


def _unpacked(column: pa.ChunkedArray) -> np.ndarray:
    return np.array([np.frombuffer(x, np.float64) for x in column.to_pylist()])


def search(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score for the vectors whose ids ``queries`` (query_id) lists, and looked_at,
    the number of vectors in the cells that the query visited."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    result = "query_id long, vec_id long, score double, looked_at long"
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, looked_at long")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").toArrow()
    sample = _matrix(sample.column("vector"))
    books = Codebooks(sample, total)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = _matrix(batch.column("vector"))
                cells = pa.array(books.cells(found), pa.int32())
                yield pa.RecordBatch.from_pydict(
                    {"vec_id": batch.column("vec_id"), "cell": cells, "vector": pa.array(_packed(found), pa.binary())}
                )

    entries = common.stored(rows.mapInArrow(index, "vec_id long, cell int, vector binary"))
    n_cells = len(books.centers[0]) * books.width
    counts = np.zeros(n_cells, np.int64)
    for row in entries.groupBy("cell").count().toLocalIterator():  # at most K * K rows
        counts[row["cell"]] = row["count"]
    # cells in order fill blocks; a cell larger than a block is several
    n_blocks = np.maximum(1, -(-counts // BLOCK))
    small = np.where(n_blocks == 1, counts, 0)
    first = (np.cumsum(small) // BLOCK).astype(np.int64)
    large = np.cumsum(np.where(n_blocks > 1, n_blocks, 0)) - np.where(n_blocks > 1, n_blocks, 0)
    first = np.where(n_blocks > 1, first.max() + 1 + large, first)
    table = spark.createDataFrame(
        [(c, int(first[c]), int(n_blocks[c])) for c in np.flatnonzero(counts).tolist()], "cell int, first long, n long"
    )
    asked = queries.select(F.col("query_id").cast("long").alias("vec_id")).distinct()
    asked = common.stored(entries.join(asked, "vec_id", "left_semi"))
    some = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(TRIES).select("vec_id", "vector").toArrow()
    tries, ids = _unpacked(some.column("vector")), some.column("vec_id").to_numpy()
    true = nearest_of(tries, ids, entries, k).toArrow() if len(ids) else None
    wanted = min(total, max(k + 1, needed(books, counts, tries, true) if len(ids) else 0))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = _unpacked(batch.column("vector"))
            left, right = books.distances(found)
            out = {"block": [], "query_id": [], "vector": [], "cells": [], "looked_at": []}
            for t, query in enumerate(batch.column("vec_id").to_pylist()):
                cells = np.array(traverse(left[t], right[t], counts, wanted), np.int32)
                start = np.repeat(first[cells], n_blocks[cells])
                nth = np.concatenate([np.arange(n) for n in n_blocks[cells]])
                blocks, of_cell = start + nth, np.repeat(cells, n_blocks[cells])
                order = np.argsort(blocks, kind="stable")
                kinds, at = np.unique(blocks[order], return_index=True)
                for block, part in zip(kinds, np.split(of_cell[order], at[1:]), strict=True):
                    out["block"].append(int(block))
                    out["query_id"].append(query)
                    out["vector"].append(found[t].tobytes())
                    out["cells"].append(np.unique(part).astype(np.int32).tobytes())
                    out["looked_at"].append(int(counts[cells].sum()))
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(out["block"], pa.int64()),
                    "query_id": pa.array(out["query_id"], pa.int64()),
                    "vector": pa.array(out["vector"], pa.binary()),
                    "cells": pa.array(out["cells"], pa.binary()),
                    "looked_at": pa.array(out["looked_at"], pa.int64()),
                }
            )

    tasks = math.ceil(asked.count() / QUERIES_A_TASK)  # going through cells is slow for its few bytes
    routed = common.stored(
        asked.repartition(max(1, tasks), "vec_id").mapInArrow(route, "block long, query_id long, vector binary, cells binary, looked_at long")
    )
    # by block: how often it is sent
    sent = common.stored(routed.groupBy("block").agg(F.ceil(F.count("*") / CHUNK).alias("chunks")))
    routed = routed.join(sent, "block").withColumn("chunk", F.expr("pmod(xxhash64(query_id), chunks)")).drop("chunks")
    placed = entries.join(F.broadcast(table), "cell").select(  # at most K * K rows
        (F.col("first") + F.pmod(F.xxhash64("vec_id"), "n")).alias("block"), "cell", "vec_id", "vector"
    )
    placed = placed.join(sent, "block").withColumn("chunk", F.expr("explode(sequence(0L, chunks - 1))")).drop("chunks")

    def rerank(key, block: pa.Table, some: pa.Table) -> pa.Table:
        ids, cells = block.column("vec_id").to_numpy(), block.column("cell").to_numpy()
        held = _unpacked(block.column("vector"))
        out = [[], [], [], []]
        asked = [some.column(n).to_pylist() for n in ("query_id", "vector", "cells", "looked_at")]
        for query, vector, visited, looked_at in zip(*asked, strict=True):
            visited = np.frombuffer(visited, np.int32)  # sorted
            at = np.minimum(np.searchsorted(visited, cells), len(visited) - 1)
            at = np.flatnonzero((visited[at] == cells) & (ids != query))
            d = exact(np.frombuffer(vector, np.float64), held[at])
            best = np.lexsort((ids[at], d))[:k]
            out[0] += [query] * len(best)
            out[1] += ids[at][best].tolist()
            out[2] += d[best].tolist()
            out[3] += [looked_at] * len(best)
        types = pa.int64(), pa.int64(), pa.float64(), pa.int64()
        names = "query_id", "vec_id", "score", "looked_at"
        return pa.table({n: pa.array(x, t) for n, x, t in zip(names, out, types, strict=True)})

    near = placed.groupBy("block", "chunk").cogroup(routed.groupBy("block", "chunk"))
    near = near.applyInArrow(rerank, result)
    by_score = Window.partitionBy("query_id").orderBy("score", "vec_id")
    near = near.withColumn("rank", F.row_number().over(by_score).cast("int")).where(F.col("rank") <= k)
    return near.select("query_id", "rank", "vec_id", "score", "looked_at")


def op4_multi_index(spark, sf_dir: str) -> DataFrame:
    """The ten nearest found for every vector whose id is divisible by 100."""
    vectors = common.read_table(spark, sf_dir, "embeddings")
    queries = vectors.where(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("query_id"))
    return search(vectors, queries, 10)
