"""Empty tables, extra columns with names of the operators' own, very long texts."""

import pytest
from pyspark.sql import functions as F

from qcmart.llm import chat_format, decontamination, multi_index, toxicity, warc
from tests.llm import helpers


@pytest.fixture(scope="module")
def turns(spark):
    rows = [(1, 1, "user", "hi"), (1, 2, "assistant", helpers.LONG * 20), (2, 1, "assistant", "so")]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def with_clashes(df, *names):
    return df.select("*", *[F.lit("x").alias(n) for n in names])


def test_conversations(turns):
    more = with_clashes(turns, "turns", "formatted", "pieces", "at", "head", "p", "start", "loss_spans")
    plain, clashing = (sorted(map(str, chat_format.format_chats(t).collect())) for t in (turns, more))
    assert plain == clashing
    none = chat_format.read_chats(chat_format.format_chats(turns.limit(0)))
    assert none.count() == 0


def test_labels_and_long_texts(spark):
    rows = [(i, "you moron" if i % 3 == 0 else f"good day number {i}") for i in range(60)]
    rows += [(100, "fine words " * 200_000), (101, "x" * 1_000_000), (102, None)]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"), "label", "stands_for", "score", "key")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 1) for i in range(60)], "doc_id long, toxic int, quality int")
    labels = with_clashes(labels, "text", "label", "score", "predicted")
    got = {r.doc_id: r.predicted for r in toxicity.scored(docs, labels).collect()}
    assert len(got) == 63 and got[100] == 0 and got[101] in (0, 1)
    assert all(got[i] == int(i % 3 == 0) for i in range(60))
    assert toxicity.scored(docs.limit(0), labels).count() == 0


def test_pages(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "é" * 3_000_000), (2, "u", "é" * 3_000_000), (3, None, None)], "page_id long, url string, html string")
    more = with_clashes(pages, "payload", "digest", "refers_to", "record_type", "archive")
    manifest = warc.write_archives(warc.with_revisits(more), str(tmp_path))
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_archives(manifest, str(tmp_path)).collect()}
    assert got == {(1, "revisit", 2, 6_000_000), (2, "response", None, 6_000_000), (3, "response", None, 0)}
    empty = tmp_path / "empty"
    empty.mkdir()
    manifest = warc.write_archives(warc.with_revisits(pages.limit(0)), str(empty))
    assert warc.read_archives(manifest, str(empty)).count() == 0


def test_embeddings(spark):
    rows = [(i, [float(i), 1.0, float(i % 7)]) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = table.select(F.col("vec_id").alias("query_id")).where("vec_id % 10 = 0")
    more = with_clashes(table, "query_id", "rank", "score", "block", "cell", "chunk")
    plain, clashing = (sorted(map(str, multi_index.search(t, asked).collect())) for t in (table, more))
    assert plain == clashing and len(plain) == 40


def test_items(spark):
    docs = helpers.documents(spark)
    items = spark.createDataFrame([(1, helpers.PASSAGE)], "item_id long, text string")
    more = with_clashes(items, "key", "doc_id", "tokens", "seed", "at", "item")
    plain, clashing = ({(r.doc_id, r.item_id) for r in decontamination.leaks(docs, t).collect()} for t in (items, more))
    assert plain == clashing == {(9, 1), (10, 1)}
