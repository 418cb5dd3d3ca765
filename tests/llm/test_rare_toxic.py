"""Toxic labels too rare for the bounded sample of labelled documents."""

import random

from qcmart.llm import toxicity
from tests.llm import helpers


def _rows(n, every):
    random.seed(6)
    plain, out = [f"word{i}" for i in range(300)], []
    for i in range(n):
        text = random.choices(plain, k=30)
        if i % every == 0:
            text[3:5] = ["you", random.choice(["idiot", "grobian", "grobians"])]
        out.append((i, " ".join(text), i % every == 0))
    return out


def _scored(spark, rows, most):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int")
    return {r.doc_id: r.predicted for r in toxicity.scored(docs, labels, most).collect()}


def test_rare_toxic_rows_are_kept(spark):
    rows = _rows(4000, 40)
    got = _scored(spark, rows, 100)
    held = [(got[i], y) for i, _, y in rows if helpers.crc(i, 5) == 0]
    assert sum(p for p, y in held if y) >= 0.7 * sum(y for _, y in held)
    assert sum(p for p, y in held if not y) <= 0.05 * len(held)


def test_hardly_any_toxic_rows(spark):
    rows = [(i, "you idiot" if i in (1, 2, 3, 4) else f"plain words {i}", i in (1, 2)) for i in range(60)]
    got = _scored(spark, rows, toxicity.TRAIN_ROWS)
    assert {i for i, p in got.items() if p} == {1, 2, 3, 4}
