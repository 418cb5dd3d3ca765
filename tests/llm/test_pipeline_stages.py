"""Stages of the corpus pipeline on small documents."""

import corpus_pipeline

BASE = [f"n{i}" for i in range(60)]
COPY = " ".join(BASE)
NEAR = " ".join([*BASE[:-1], "other"])
ROWS = [
    (3, COPY),
    (7, COPY),  # a copy of 3
    (7, "a text of its own under an id that is also that of a copy"),
    (8, NEAR),  # a near copy of 3
    (8, "another text of its own under an id that is also that of a near copy"),
    (None, COPY),  # a copy of 3
    (None, "a text of its own without an id"),
    (None, "one more text of its own and no id either"),
    (9, None),
    (10, ""),
    (11, "said once"),
    (11, "said once"),
]
STAY = [r for k, r in enumerate(ROWS) if k not in (1, 3, 5)]


def _texts(rows):
    return sorted(((r[0], r[1]) for r in rows), key=str)


def test_near_copies_go_row_by_row(spark):
    docs = spark.createDataFrame([(i, t, "s") for i, t in ROWS], "doc_id long, text string, source string")
    got = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert got.columns == docs.columns
    assert _texts(got.collect()) == _texts(STAY)
