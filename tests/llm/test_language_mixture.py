"""Language mixtures against a plain loop, and held-out accuracy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from qcmart.llm import language_mixture as lm
from tests.llm import helpers

WORDS = {
    "aa": ["bato", "kilo", "marina", "tako", "sabi", "loma", "dorito"],
    "bb": ["schrift", "krant", "zwicht", "pflug", "strumpf", "gnarz"],
    "cc": ["ouille", "eaux", "quoique", "geux", "vieille", "oiseau"],
}


def _text(random_, langs, n=60):
    return " ".join(random_.choice(WORDS[random_.choice(langs)]) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(5)
    rows = [(i, _text(r, [lang]), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 40)]
    rows += [
        (500, _text(r, ["aa", "aa", "bb"], 300), None),
        (501, None, "aa"),
        (502, "", "bb"),
        (503, " 12 -- 3² ! ", "cc"),
        (504, _text(r, ["cc"], 60_000), "cc"),
        (505, "krant" * 5_000, None),
        (506, "1" * 5_000 + " bato loma", None),
        (None, _text(r, ["bb"]), "bb"),
        (3, _text(r, ["aa"]), "aa"),
        (3, _text(r, ["aa"]), "aa"),
    ]
    return spark.createDataFrame(
        [(i, t, lang, True, 0.5, "x") for i, t, lang in rows],
        "doc_id long, text string, lang string, held_out boolean, score double, slot string",
    )


def _models(docs):
    return lm.learned(docs.select("doc_id", "text", "lang"))


def test_predictions(docs):
    got = lm.identified(docs, _models(docs)).collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (helpers.crc(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    for i, lang in enumerate(["aa", "bb", "cc"] * 40):
        assert by_id[i].lang_pred == lang
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (501, 502, 503)] == [("und", 0.0)] * 3
    assert [by_id[i].lang_pred for i in (504, 505, 506, None)] == ["cc", "bb", "aa", "bb"]
    mixture = by_id[500].shares
    assert set(mixture) == {"aa", "bb"}
    assert abs(mixture["aa"] - 2 / 3) < 0.1 and abs(sum(mixture.values()) - 1) < 1e-9


def test_models_count_what_is_there(docs):
    models = _models(docs)
    train = [r for r in docs.collect() if r.lang and r.text and helpers.crc(r.doc_id, 5)]
    assert models.names == sorted({r.lang for r in train})
    for name, counts in zip(models.names, models.counts, strict=True):
        text = "".join(f"  {w} " for r in train if r.lang == name for w in r.text.split() if w.isalpha()).encode()
        # every byte but the two blanks before a word is counted once for each order
        n = len(text) - 2 * sum(1 for r in train if r.lang == name for w in r.text.split() if w.isalpha())
        assert [counts[a:b].sum() for a, b in ((0, 256), (lm.UPTO1, lm.UPTO2), (lm.UPTO3, None))] == [n, n, n]


def test_likelihoods_and_mixture_match_loops(docs):
    models = _models(docs)
    words = [b"bato", b"zwicht", "l'eau été".encode().split()[0], b"x9"]

    def loglik(word, k):
        counts, total = models.counts[k], 0.0
        data = b"  " + lm.letters_of(word) + b" "
        for i in range(2, len(data)):
            a, b, c = data[i - 2 : i + 1]
            slot = lm.common.mixed(np.array([a << 16 | b << 8 | c], np.uint64))[0] % np.uint64(lm.SLOTS)
            p = (counts[lm.UPTO1 + c] + 4 / 256) / (models.total[k] + 4)
            p = (counts[lm.UPTO2 + (b << 8 | c)] + 4 * p) / (counts[b] + 4)
            p = (counts[lm.UPTO3 + int(slot)] + 4 * p) / (counts[lm.BEFORE2 + (a << 8 | b)] + 4)
            total += math.log(p)
        return total

    got = models.likelihoods([lm.letters_of(w) for w in words])
    assert np.allclose(got, [[loglik(w, k) for k in range(3)] for w in words], rtol=1e-5)

    # the best shares of a long run of EM, one document at a time, are those found in a batch
    random_ = np.random.default_rng(2)
    logs = random_.normal(size=(80, 3)) * 2
    doc, times = np.repeat(np.arange(4), 20), random_.integers(1, 5, 80)
    batch = lm.Batch(doc, times, logs, 4)
    shares, fit = lm.estimated(batch, np.full((4, 3), 1 / 3))
    for d in range(4):
        like, t, p = np.exp(logs[doc == d]), times[doc == d], np.full(3, 1 / 3)
        for _ in range(2000):
            p = ((p * like / (like @ p)[:, None]) * t[:, None]).sum(axis=0) / t.sum()
        best = (t * np.log(like @ p)).sum() - (t * logs[doc == d].max(axis=1)).sum()
        assert best - 0.2 < fit[d] <= best + 1e-9


def test_nothing_to_learn(spark, docs):
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    got = lm.identified(docs, _models(none)).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert lm.identified(docs.where(F.lit(False)), _models(docs)).count() == 0
    assert lm.identified(docs.where(F.lit(False)), _models(docs.where(F.lit(False)))).count() == 0


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = [r for r in entry.queries()["op12_language_mixture"](spark, path).collect() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) >= 0.98 * len(got)
