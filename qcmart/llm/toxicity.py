"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Training rows are labelled documents outside the held-out fold; at most TRAIN_ROWS of them, those of
the smallest hashed ids, are used, which bounds what fitting costs. A label that fewer than
LEAST_OF_LABEL of these have is filled up to as many from all rows, and rows weigh as many as they
stand for. From them are learned

1. a lexicon: words and word beginnings, with how many toxic and clean documents hold each, kept if
   much likelier in toxic ones (at most LEXICON terms), beside a few common insults;
2. trees (Spark ML) over lexicon densities, closeness of lexicon words to second-person pronouns,
   capitals, punctuation and obfuscation rates. A training document's own label is taken out of the
   lexicon counts before its features are computed, so the trees see what unseen text looks like;
3. a monotone map from the trees' score to a probability, on a fifth of the rows that the trees
   didn't see, pooled to a thousand steps first.

Only the text is an input of a score. Features are computed over whole texts.

Defined results: null or empty text has features of zero and is scored by them. Labels that are null
don't count; a document with several labels is toxic if one says so. Without labels of both kinds
every score is the share of toxic labels, zero if there are none. With fewer than LEAST_TO_FIT of a
kind among all labels, texts with a common insult are toxic. Repeated rows get equal scores.
Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qcmart.llm import common

TRAIN_ROWS = 20_000
LEAST_OF_LABEL = 2_000
LEAST_TO_FIT = 5
LEXICON = 4_096
FOLDS = 5
STEPS = 1_000
LEAST_TOXIC = 2
LEAST_ODDS = math.log(6)
STARTS = (4, 5, 6, 7)
NEAR = 5

#: Common insults, as a lexicon to begin with.
INSULTS = (
    "idiot moron stupid dumb fool loser scum trash garbage worthless pathetic disgusting clown jerk "
    "imbecile dumm idioten arschloch abschaum imbécile crétin connard ordure estúpido imbécil basura"
).split()
#: Second-person pronouns.
YOU = (
    "you your yours yourself youre du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre "
    "vos tú ti usted ustedes vosotros"
).split()
#: Digits and signs that stand for letters.
STANDS_FOR = str.maketrans("013457@$!", "oieastasi")
INSIDE = re.compile(r"[^\W\d_][\d@$*!#]+[^\W\d_]")
EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")
LONG_RUN = re.compile(r"([^\W\d_])\1{2,}")

FEATURES = [
    "words", "hits", "density", "weight", "strongest", "distinct", "strong_density", "insults",
    "you_density", "near_you", "capitals", "shouted", "punctuation", "exclaimed", "obfuscated",
    "stretched", "digits",
]
NAMED = ", ".join(f"{f} double" for f in FEATURES)

_PUNCTUATION = np.array([chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" for b in range(256)])
_UPPER = np.array([65 <= b <= 90 for b in range(256)])
_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_DIGIT = np.array([48 <= b <= 57 for b in range(256)])


def plain(word: str) -> str:
    """A word in lower case, without signs around it, look-alikes inside turned into letters."""
    word = EDGES.sub("", word.lower())
    return word.translate(STANDS_FOR) if INSIDE.search(word) else word


def terms(word: str) -> list[str]:
    """The terms that stand for a plain word: itself and its beginnings."""
    return [f"={word}", *[word[:n] for n in STARTS if len(word) > n]] if len(word) > 1 else []


def odds(toxic: np.ndarray, clean: np.ndarray, all_toxic: float, all_clean: float) -> np.ndarray:
    """Log odds by which a term speaks for toxicity; zero if it doesn't do so clearly."""
    out = np.log((toxic + 0.5) / (all_toxic + 1)) - np.log((clean + 0.5) / (all_clean + 1))
    return np.where((toxic >= LEAST_TOXIC) & (out >= LEAST_ODDS), out, 0.0)


class Lexicon:
    """Terms with the number of toxic and clean documents that hold them."""

    def __init__(self, rows: list[tuple[str, int, int]], toxic: int, clean: int) -> None:
        self.place = {t: k for k, (t, _, _) in enumerate(rows)}
        self.toxic = np.array([0] + [a for _, a, _ in rows], np.float64)
        self.clean = np.array([0] + [b for _, _, b in rows], np.float64)
        self.totals = float(toxic), float(clean)
        self.weight = odds(self.toxic, self.clean, *self.totals)
        self.insults, self.you = frozenset(INSULTS), frozenset(YOU)

    def code(self, word: str) -> int:
        """What is known of a word: number of its best term, and five marks."""
        low = plain(word)
        found = [self.place[t] + 1 for t in terms(low) if t in self.place]
        best = max(found, key=lambda k: self.weight[k]) if found else 0
        shouted = len(word) > 1 and word.isupper()
        marks = (
            (low in self.you)
            | (low in self.insults) << 1
            | bool(INSIDE.search(word)) << 2
            | shouted << 3
            | bool(LONG_RUN.search(word)) << 4
        )
        return best << 5 | int(marks)


class Codes(dict):
    """Codes of words, computed once while the table is small."""

    def __init__(self, lexicon: Lexicon) -> None:
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> int:
        if len(self) > 150_000:
            self.clear()
        value = self[word] = self.lexicon.code(word)
        return value


def features(text: str, codes: Codes, label: int | None) -> list[float]:
    """FEATURES of a text. label: of a document that the lexicon has counted, else None."""
    words, lexicon = text.split(), codes.lexicon
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    code = np.fromiter(map(codes.__getitem__, words), np.int64, n)
    marked = np.flatnonzero(code)
    some = code[marked]
    best, you = some >> 5, (some & 1) > 0
    if label is None:
        weight = lexicon.weight[best]
    else:
        own = np.where(best > 0, 1, 0)
        toxic, clean = lexicon.toxic[best] - own * label, lexicon.clean[best] - own * (1 - label)
        totals = lexicon.totals[0] - label, lexicon.totals[1] - (1 - label)
        weight = np.where(best > 0, odds(np.maximum(toxic, 0), np.maximum(clean, 0), *totals), 0.0)
    hit = weight > 0
    insult = (some & 2) > 0
    bad = marked[hit | insult]
    near = 0
    if len(bad) and you.any():
        at = marked[you]
        right = np.searchsorted(at, bad)
        gap = np.minimum(
            np.abs(bad - at[np.minimum(right, len(at) - 1)]), np.abs(bad - at[np.maximum(right - 1, 0)])
        )
        near = int((gap <= NEAR).sum())
    found = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    letters, chars = max(1, found[_LETTER].sum()), found.sum()
    return [
        math.log1p(n),
        math.log1p(hit.sum()),
        hit.sum() / n,
        weight.sum() / n,
        float(weight.max(initial=0.0)),
        math.log1p(len(np.unique(best[hit]))),
        (weight > 5).sum() / n,
        insult.sum() / n,
        you.sum() / n,
        near / n,
        found[_UPPER].sum() / letters,
        ((some & 8) > 0).sum() / n,
        found[_PUNCTUATION].sum() / chars,
        found[33] / chars,
        ((some & 4) > 0).sum() / n,
        ((some & 16) > 0).sum() / n,
        found[_DIGIT].sum() / chars,
    ]


def fold(mod: int) -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % mod


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, text, label and stands_for of at most so many labelled documents outside the held-out fold, and
    of some more with a rare label."""
    labels = common.clean_columns(labels, {"doc_id": "long", "toxic": "int"})
    labels = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(FOLDS) != 0))
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    labels = common.stored(labels)
    order = F.xxhash64("doc_id"), "doc_id"
    some = common.stored(labels.orderBy(*order).limit(most))
    least, all_, taken = min(LEAST_OF_LABEL, most // 2), _by_label(labels), _by_label(some)
    for label, n in all_.items():
        if taken.get(label, 0) < min(n, least):
            more = labels.where(F.col("label") == label).orderBy(*order).limit(least)
            some = common.stored(some.where(F.col("label") != label).unionByName(more))
            taken[label] = min(n, least)
    weight = {label: n / taken[label] for label, n in all_.items()}
    some = some.withColumn("stands_for", F.when(F.col("label") == 1, weight.get(1, 1.0)).otherwise(weight.get(0, 1.0)))
    rows = docs.join(F.broadcast(some), "doc_id")
    return common.stored(rows.dropDuplicates(["doc_id"]))


def _by_label(rows: DataFrame) -> dict[int, int]:
    return {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}


def learned(rows: DataFrame) -> Lexicon:
    """The lexicon of training rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter(), Counter()

        def told() -> pa.RecordBatch:
            names = list(found[0].keys() | found[1].keys())
            columns = [[f[t] for t in names] for f in found]
            for f in found:
                f.clear()
            return pa.RecordBatch.from_pydict(
                {"term": pa.array(names, pa.string()), "clean": pa.array(columns[0], pa.int64()), "toxic": pa.array(columns[1], pa.int64())}
            )

        for batch in batches:
            for text, label in zip(batch.column("text"), batch.column("label").to_pylist(), strict=True):
                words = {plain(w) for w in set((text.as_py() or "").split())}
                found[label].update({t for w in words for t in terms(w)})
                if len(found[0]) + len(found[1]) > 300_000:
                    yield told()
        yield told()

    totals = _by_label(rows)
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    counts = rows.mapInArrow(count, "term string, clean long, toxic long").groupBy("term")
    counts = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    score = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    kept = counts.where((F.col("toxic") > LEAST_TOXIC) & (score >= LEAST_ODDS))
    kept = kept.orderBy((score * F.sqrt("toxic")).desc(), "term").limit(LEXICON)
    return Lexicon([(r["term"], r["toxic"], r["clean"]) for r in kept.collect()], toxic, clean)


def featured(docs: DataFrame, lexicon: Lexicon, keep: str, with_label: bool = False) -> DataFrame:
    """The kept columns (a DDL list) and FEATURES of each document."""
    names = common.schema_of(keep).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codes(lexicon)
        for batch in batches:
            marks = batch.column("label").to_pylist() if with_label else [None] * batch.num_rows
            rows = [
                features(t.as_py() or "", codes, y)
                for t, y in zip(batch.column("text"), marks, strict=True)
            ]
            found = np.array(rows, np.float64).reshape(-1, len(FEATURES))
            columns = {k: batch.column(k) for k in names}
            columns |= {k: pa.array(found[:, j]) for j, k in enumerate(FEATURES)}
            yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(run, f"{keep}, {NAMED}")


class Model:
    """The fitted parts; transform() adds score to rows of documents."""

    def __init__(self, docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> None:
        rows = training_rows(docs, labels, most)
        self.lexicon = learned(rows)
        toxic, clean = self.lexicon.totals
        self.share = toxic / (toxic + clean) if toxic + clean else 0.0
        self.trees = self.curve = None
        self.assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
        self.few = 0 < min(toxic, clean) < LEAST_TO_FIT
        if min(toxic, clean) < LEAST_TO_FIT:
            return
        known = featured(rows, self.lexicon, "doc_id long, label int, stands_for double", with_label=True)
        known = common.stored(self.assembler.transform(known).select("doc_id", "label", "stands_for", "features"))
        apart = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(5)) == 0
        trees = GBTClassifier(
            labelCol="label", weightCol="stands_for", maxIter=25, maxDepth=4, stepSize=0.2, subsamplingRate=0.8, seed=5, checkpointInterval=-1
        )
        self.trees = trees.fit(known.where(~apart).coalesce(6))
        judged = self.raw(known.where(apart))
        steps = judged.groupBy(F.round(F.col("raw") * STEPS).alias("step")).agg(
            F.avg("raw").alias("raw"),
            (F.sum(F.col("label") * F.col("stands_for")) / F.sum("stands_for")).alias("label"),
            F.sum("stands_for").alias("weight"),
        )
        curve = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight")
        self.curve = curve.fit(common.stored(steps).coalesce(1))

    def raw(self, rows: DataFrame) -> DataFrame:
        """The trees' own probability."""
        rows = self.trees.transform(rows)
        return rows.withColumn("raw", vector_to_array("probability")[1]).drop("rawPrediction", "prediction", "probability")

    def transform(self, docs: DataFrame, keep: str) -> DataFrame:
        rows = featured(docs, self.lexicon, keep)
        if self.few:
            return rows.withColumn("score", F.when(F.col("insults") > 0, 0.5 + F.col("insults") / 2).otherwise(0.0))
        if self.trees is None:
            return rows.withColumn("score", F.lit(self.share))
        rows = self.raw(self.assembler.transform(rows))
        curve = self.curve.copy()
        curve.setPredictionCol("step_score")
        rows = curve.transform(rows)
        # within a flat step the trees' order stays, too little to cross one half
        even = 0.998 * F.col("step_score") + 0.002 * F.col("raw")
        return rows.withColumn("score", F.least(F.greatest(even, F.lit(0.0)), F.lit(1.0)))


def scored(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = common.clean_columns(docs, {"doc_id": "long", "text": "string"})
    rows = Model(docs, labels, most).transform(docs, "doc_id long")
    return rows.select(
        "doc_id",
        (fold(FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    docs, labels = (common.read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return scored(docs, labels)
