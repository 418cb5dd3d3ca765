"""The registered training-data queries against their SQL, and the pipeline against brute force."""

import collections

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from qcmart.llm import queries
from tests.compare import connect, duck_rows, spark_rows
from tests.llm import helpers

SF_DIR = "/root/testdata/sf0.001"
SECRET = "q8Zr3nT0vK4Wx7Lw2mPd9sHc5yB1eF6u"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_training_query_matches_sql(spark, name):
    con = connect(SF_DIR)
    assert spark_rows(entry.queries()[name](spark, SF_DIR)) == duck_rows(con, entry.oracle_sql()[name])
    con.close()


def _plain(i, n=40):
    return " ".join(f"d{i}w{k}" for k in range(n))


ITEM = " ".join(f"item{k}" for k in range(15))
ROWS = [
    *[(i, _plain(i), f"s{i % 3}") for i in range(1, 20)],
    (20, f"you idiot {_plain(20)}", "s1"),
    (21, f"{_plain(21)} moron", "s2"),
    (22, f"{_plain(1)} more", "s1"),  # near copies of 1 and 2
    (23, f"{_plain(2)} more", "s2"),
    (24, f"{_plain(24)} {ITEM} end", "s0"),
    (25, f"secret = {SECRET} {_plain(25)}", "s0"),
    (26, None, "s1"),
    (27, "", None),
    (None, _plain(28), "s2"),
    (None, _plain(3), "s2"),  # a copy of 3
]
INSULTS = {"idiot", "moron"}


def _brute(rows):
    rows = [r for r in rows if not INSULTS & set((r[1] or "").split())]
    groups = helpers.near_groups([r[:2] for r in rows if r[0] is not None], 5, 80)
    said = {r[1] for r in rows if r[0] is not None}
    rows = [r for r in rows if (groups[r[0]] == r[0] if r[0] is not None else r[1] not in said)]
    rows = [r for r in rows if ITEM not in (r[1] or "")]
    return [(i, (t or "").replace(f"secret = {SECRET}", "<secret>"), s) for i, t, s in rows]


def test_pipeline_matches_brute_force(spark, tmp_path):
    docs = [(i, t, "en", s, len(t or "")) for i, t, s in ROWS]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    # two toxic, or fewer outside the held-out fold: too few to fit, so common insults decide
    labels = [(i, int(i in (20, 21)), 1) for i in range(1, 28)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns, name
    expected = _brute(ROWS)
    assert collections.Counter((r.doc_id, r.text or "", r.source) for r in kept.collect()) == collections.Counter(expected)
    got = entry.queries()["pipeline"](spark, str(tmp_path)).collect()
    sizes = collections.Counter((i, s, len(t.split())) for i, t, s in expected)
    assert collections.Counter((r.doc_id, r.source, r["size"]) for r in got) == sizes
    by_source = collections.Counter()
    for _, t, s in expected:
        by_source[s] += len(t.split())
    assert all(r.source_size == by_source[r.source] for r in got)
    assert abs(sum({r.source: r.target for r in got}.values()) - sum(by_source.values())) < 1e-6
