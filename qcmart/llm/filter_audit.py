r"""Audit of how document filters interact, by path counting on the lattice of their subsets.

A state of the lattice is the set of filters applied so far, an edge is one more filter. Every order
of k filters is a path of k edges from the empty to the full set.

1. Failures. Each document gets a bit per filter that it fails. That a text occurs under a smaller
   doc_id is decided by digests of whole texts; nothing else needs other documents.
2. Counts. Documents are counted by part and failed filters: at most 2^k rows a part, whatever the
   size of the corpus. All that follows reads these.
3. Edges. On the edge from S by f go the documents that fail f and nothing in S.
4. Paths. Forward, the orders that reach a state; backward, those that lead on from it to the full
   set. Their product on an edge's ends is the number of orders through it, so one sum over edges
   gives what a filter removes over all orders: its Shapley value, times the number of orders.
5. Steps. The steps of an order are the edges on its path.

``before`` names filters that must precede others; then only such orders are counted and listed. The
lattice is built on the driver: its size is set by the number of filters alone (5 make 80 edges and
120 orders), of which at most MOST_FILTERS are taken.

Defined results: null text is empty, null lang is the part ''. A document without words fails A and
passes B. A row with a null doc_id has no label, fails E under no other row and makes none fail. Rows
that repeat a doc_id count each; copies under one doc_id don't make each other fail E. A document
labelled several times has what any of its labels says. Without documents there is no part and no
row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qcmart.llm import common

MOST_FILTERS = 8


class Edge(NamedTuple):
    """Filter number ``filter`` applied after those in ``state``, a bit set."""

    state: int
    filter: int
    reaching: int
    leaving: int


def lattice(filters: int, before: Sequence[tuple[int, int]] = ()) -> list[Edge]:
    """The edges that some allowed order takes. before: pairs of filters, the first of which has
    to come first."""
    if filters > MOST_FILTERS:
        raise ValueError(f"{filters} filters have too many orders; at most {MOST_FILTERS} are taken")
    needs = [sum({1 << a for a, b in before if b == f}) for f in range(filters)]
    full = (1 << filters) - 1
    moves = [(s, f) for s in range(full + 1) for f in range(filters) if not s >> f & 1 and needs[f] & ~s == 0]
    reaching, leaving = [1] + [0] * full, [0] * full + [1]
    for s, f in moves:  # a set comes after all its subsets
        reaching[s | 1 << f] += reaching[s]
    for s, f in reversed(moves):
        leaving[s] += leaving[s | 1 << f]
    edges = [Edge(s, f, reaching[s], leaving[s | 1 << f]) for s, f in moves]
    return [e for e in edges if e.reaching and e.leaving]


def orders(edges: Sequence[Edge]) -> Iterator[tuple[Edge, ...]]:
    """All paths from the empty to the full set, in the order of their filters."""
    out: dict[int, list[Edge]] = {}
    for e in sorted(edges):
        out.setdefault(e.state, []).append(e)

    def onward(path: tuple[Edge, ...], state: int) -> Iterator[tuple[Edge, ...]]:
        if state not in out and path:
            yield path
        for e in out.get(state, ()):
            yield from onward((*path, e), state | 1 << e.filter)

    return onward((), 0)


def text_filters(text: Column) -> dict[str, Column]:
    """Whether a text fails each of the filters that need no other document."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return {
        "A": n < 200,
        "B": 100 * distinct < 50 * n,
        "C": 100 * capitals > 3 * F.char_length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def bits(failing: Sequence[Column]) -> Column:
    mask = F.lit(0)
    for k, fails in enumerate(failing):
        mask = mask + F.when(fails, 1 << k).otherwise(0)
    return mask


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, good, toxic of every document; mask has the bits of the filters A to E that it fails.

    Both joins are of narrow rows with stored tables, so Spark can split a text or null id that has very many.
    """
    docs = common.clean_columns(docs, {"doc_id": "long", "text": "string", "lang": "string"})
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    filters = text_filters(F.col("text"))
    rows = common.stored(
        docs.select(
            "doc_id",
            F.coalesce("lang", F.lit("")).alias("part"),
            F.unhex(F.sha2("text", 256)).alias("digest"),
            bits(list(filters.values())).alias("mask"),
        )
    )
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first = common.stored(first.where("first < last").select("digest", "first"))
    labels = common.clean_columns(labels, {"doc_id": "long", "quality": "int", "toxic": "int"})
    labels = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    rows = rows.join(common.stored(labels), "doc_id", "left").join(first, "digest", "left")
    copied = F.when(F.col("doc_id") > F.col("first"), 1 << len(filters)).otherwise(0)
    return rows.select(
        "part",
        (F.col("mask") + copied).alias("mask"),
        F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"),
    )


def edge_counts(counted: DataFrame, edges: Sequence[Edge]) -> DataFrame:
    """What happens to the documents of each part on each edge. counted: (part, mask, n, good, toxic)."""
    kinds = F.array(
        *[
            F.struct(
                F.lit(e.state).alias("state"),
                F.lit(1 << e.filter).alias("bit"),
                F.lit(e.reaching * e.leaving).cast("long").alias("through"),
            )
            for e in edges
        ]
    )
    each = counted.select("*", F.explode(kinds).alias("e")).select("*", "e.*").drop("e")
    fails = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("state")) != 0

    def summed(name: str, where: Column) -> Column:
        return F.sum(F.when(where, F.col(name)).otherwise(0))

    return each.groupBy("part", "state", "bit", "through").agg(
        summed("n", ~fails & ~gone).alias("kept"),
        summed("n", fails & ~gone).alias("removed"),
        summed("n", fails & gone).alias("redundant"),
        summed("n", F.col("mask") == F.col("bit")).alias("unique_fails"),
        summed("good", fails & ~gone).alias("good_lost"),
        summed("toxic", fails & ~gone).alias("toxic_lost"),
    )


def audit(rows: DataFrame, names: str, before: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """part, filter_order, step, counts and shapley, for each part and order. rows: (part, mask, good,
    toxic) of every document; names: a letter for each bit of mask, from the lowest."""
    edges = lattice(len(names), [(names.index(a), names.index(b)) for a, b in before])
    counted = common.stored(
        rows.groupBy("part", "mask").agg(
            F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
        )
    )
    if not edges:
        raise ValueError("no order of the filters is allowed")
    steps = [
        ("".join(names[e.filter] for e in path), k + 1, e.state, 1 << e.filter)
        for path in orders(edges)
        for k, e in enumerate(path)
    ]
    columns = zip(("filter_order", "step", "state", "bit"), zip(*steps, strict=True), strict=True)
    types = {"filter_order": pa.string()}
    table = pa.table({k: pa.array(v, types.get(k, pa.int32())) for k, v in columns})
    spark = rows.sparkSession
    found = edge_counts(counted, edges)
    values = found.groupBy("part", "bit").agg(F.sum(F.col("removed") * F.col("through")).alias("shapley"))
    found = found.drop("through").join(F.broadcast(spark.createDataFrame(table)), ["state", "bit"])
    return found.join(values, ["part", "bit"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    """Every order of the five filters over all documents, by language."""
    rows = failures(common.read_table(spark, sf_dir, "documents"), common.read_table(spark, sf_dir, "labels"))
    return audit(rows, "ABCDE")


ORACLE = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), m AS (
  SELECT doc_id, part, [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'),
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS fails FROM w
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), c AS (
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, fails
), f AS (SELECT unnest(range(1, 6)) AS i),
o AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS path FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), s AS (SELECT path, f.i AS step, path[f.i] AS own, path[1:f.i - 1] AS done FROM o, f),
x AS (
  SELECT c.*, s.*, fails[own] AS hit, list_bool_or(list_transform(done, lambda k: fails[k])) AS gone,
         len(list_filter(fails, lambda b: b)) AS failing
  FROM c, s
), r AS (
  SELECT part, array_to_string(list_transform(path, lambda k: substr('ABCDE', k::INT, 1)), '') AS filter_order,
    step::INT AS step, own,
    sum(CASE WHEN NOT hit AND NOT coalesce(gone, false) THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN hit AND NOT coalesce(gone, false) THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN hit AND coalesce(gone, false) THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN hit AND failing = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN hit AND NOT coalesce(gone, false) THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN hit AND NOT coalesce(gone, false) THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM x GROUP BY part, path, step, own
)
SELECT * EXCLUDE own, sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM r
"""
