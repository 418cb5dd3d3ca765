"""Languages of documents as mixtures, by expectation maximisation over words.

1. Models. For each learned language, counts of the runs of one, two and three bytes in its words
   give the probability of a byte after two others, each order smoothed by the one below. Words are
   runs of letters, lower-cased, between blanks. Runs of three are counted in SLOTS slots by hash, so a
   model has the same size whatever it is learned from.
2. Likelihoods. A word has one under each language; they are computed once per word that a task meets.
3. Mixture. A document draws each word from one of its languages, in proportions that expectation
   maximisation estimates: words are shared out by proportion times likelihood, and the shares are
   the next proportions.
4. Set of languages. It begins with the most likely single one. The language by which the
   likelihood rises most steeply joins if, with proportions estimated anew, the gain exceeds half the
   logarithm of the number of words (the penalty of the Bayesian information criterion), until none does.
5. The language with the largest proportion is predicted; the proportion is the score.

Documents of a batch are estimated together as arrays. Learning takes about ROWS documents of each language
(all, if there are fewer), those with the smallest hashes of id and text, whole; languages are at most
LANGUAGES, beyond which an error says so. So the models, of about 1 MB each, are of a known size.

Defined results: null text, text without a letter, and any text if no language could be learned is
'und' with score 0. Equal proportions or likelihoods go to the language that is first by code points.
A word of over LONG bytes counts as pieces of PIECE letters. Rows with a null or repeated doc_id are
predicted each; the fold of a null id is that of an empty string. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qcmart.llm import common

FOLDS = 5
ROWS = 2_000
LANGUAGES = 400
UNKNOWN = "und"
SLOTS = 1 << 17
#: Where the counts of one and two bytes before a place, one and two up to it, and three begin.
BEFORE1, BEFORE2, UPTO1, UPTO2, UPTO3 = np.cumsum([0, 1 << 8, 1 << 16, 1 << 8, 1 << 16]).tolist()
WIDTH = UPTO3 + SLOTS
#: Counts that the next lower order weighs.
SMOOTHING = 4.0
LONG, PIECE = 64, 32
LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
ROUNDS = 40
CLOSE = 1e-3
#: Part by which a language joins before proportions are estimated anew.
START = 0.1


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def words_of(text: bytes) -> list[bytes]:
    """The words as they stand; of long ones pieces of their letters."""
    words = text.split()
    if len(text) > LONG and max(map(len, words), default=0) > LONG:
        return [p for w in words for p in (pieces(w) if len(w) > LONG else (w,))]
    return words


def pieces(word: bytes) -> list[bytes]:
    runs = LETTERS.findall(word.decode("utf-8", "ignore"))
    return [r[k : k + PIECE].encode() for r in runs for k in range(0, len(r), PIECE)]


def letters_of(word: bytes) -> bytes:
    """The letter runs of a word, lower-cased, a blank between; empty without letters."""
    return " ".join(LETTERS.findall(word.decode("utf-8", "ignore").lower())).encode()


def places(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The word of each place and the five slots of its counts. words: not empty, from letters_of."""
    data = np.frombuffer(b"".join(b"  %b " % w for w in words), np.uint8).astype(np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 3
    first = np.cumsum(sizes) - sizes
    place = np.ones(len(data), bool)
    place[first] = place[first + 1] = False  # nothing precedes the two blanks
    at = np.flatnonzero(place)
    a, b, c = data[at - 2], data[at - 1], data[at]
    three = common.mixed((a << 16 | b << 8 | c).astype(np.uint64)) % np.uint64(SLOTS)
    slots = [BEFORE1 + b, BEFORE2 + (a << 8 | b), UPTO1 + c, UPTO2 + (b << 8 | c), UPTO3 + three.astype(np.int64)]
    return np.repeat(np.arange(len(words)), sizes - 2)[: len(at)], np.stack(slots)


class Models:
    """Counts of runs of bytes, a row per language; log likelihoods of words."""

    def __init__(self, names: list[str], counts: np.ndarray) -> None:
        self.names, self.counts = names, counts
        self.total = counts[:, UPTO1:UPTO2].sum(axis=1)

    def likelihoods(self, words: list[bytes]) -> np.ndarray:
        """Log likelihoods (words x languages) of words from letters_of, 0 for one without letters."""
        out = np.zeros((len(words), len(self.names)))
        some = [k for k, w in enumerate(words) if w]
        if not some:
            return out
        word, (before1, before2, upto1, upto2, upto3) = places([words[k] for k in some])
        for k, counts in enumerate(self.counts):
            p = (counts[upto1] + SMOOTHING / 256) / (self.total[k] + SMOOTHING)
            p = (counts[upto2] + SMOOTHING * p) / (counts[before1] + SMOOTHING)
            p = (counts[upto3] + SMOOTHING * p) / (counts[before2] + SMOOTHING)
            out[some, k] = np.bincount(word, np.log(p), len(some))
        return out


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, slot, n) of a task's documents (lang, text)."""
    tables: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(WIDTH, np.int64))
    for batch in common.batches(batches):
        words: dict[str, Counter] = defaultdict(Counter)
        for lang, text in zip(batch.column("lang").to_pylist(), common.texts(batch.column("text")), strict=True):
            words[lang].update(words_of(text))
        for lang, found in words.items():
            known = [(w, n) for w, n in ((letters_of(w), n) for w, n in found.items()) if w]
            if known:
                word, slots = places([w for w, _ in known])
                often = np.array([n for _, n in known], np.int64)[word]
                for slot in slots:
                    np.add.at(tables[lang], slot, often)
    for lang, table in tables.items():
        slot = np.flatnonzero(table)
        yield pa.RecordBatch.from_pydict(
            {"lang": pa.array([lang] * len(slot)), "slot": pa.array(slot, pa.int32()), "n": pa.array(table[slot])}
        )


def _packed(table: pa.Table) -> pa.Table:
    counts = np.zeros(WIDTH, np.float32)
    counts[table.column("slot").to_numpy()] = table.column("n").to_numpy()
    return pa.table({"lang": table.column("lang")[:1], "counts": pa.array([zlib.compress(counts.tobytes(), 1)])})


def learned(docs: DataFrame, rows: int = ROWS) -> Models:
    """Models of the languages of documents outside the held-out fold. docs: (doc_id, text, lang)."""
    train = docs.where(~held_out() & F.col("lang").isNotNull())
    by_lang = train.groupBy("lang").count().limit(LANGUAGES + 1).collect()
    if len(by_lang) > LANGUAGES:
        raise ValueError(f"over {LANGUAGES} values in lang")
    if not by_lang:
        return Models([], np.zeros((0, WIDTH), np.float32))
    parts = 1 << 30
    below = F.create_map(*[F.lit(x) for r in by_lang for x in (r["lang"], min(parts, rows * parts // r["count"] + 1))])
    some = train.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)) < F.element_at(below, F.col("lang")))
    counts = some.select("lang", "text").mapInArrow(counted, "lang string, slot int, n long")
    counts = counts.groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    found = counts.groupBy("lang").applyInArrow(_packed, "lang string, counts binary").collect()
    found = sorted((r["lang"], np.frombuffer(zlib.decompress(r["counts"]), np.float32)) for r in found)
    return Models([n for n, _ in found], np.array([c for _, c in found]).reshape(-1, WIDTH))


class Words(dict):
    """Numbers of words, and their log likelihoods, each computed once while the table is small."""

    LIMIT = 100_000

    def __init__(self, models: Models) -> None:
        super().__init__()
        self.models = models
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.known, self.table = np.zeros(0, bool), np.zeros((0, len(self.models.names)))

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value

    def numbers(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        if len(self) > self.LIMIT:
            self.clear()
        out = [np.fromiter(map(self.__getitem__, words), np.int64, len(words)) for words in texts]
        new = [letters_of(w) for w in list(self)[len(self.known) :]]
        self.known = np.append(self.known, np.fromiter(map(bool, new), bool, len(new)))
        self.table = np.vstack([self.table, self.models.likelihoods(new)])
        return out


class Batch:
    """Documents as rows (document, word, times) in document order, with the words' likelihoods under
    each language, scaled so that the largest is 1."""

    def __init__(self, doc: np.ndarray, times: np.ndarray, logs: np.ndarray, documents: int) -> None:
        self.doc, self.times, self.documents = doc, times.astype(np.float64), documents
        self.best = logs.max(axis=1)
        self.ratio = np.exp(logs - self.best[:, None])
        self.n = np.bincount(doc, self.times, documents)

    def summed(self, rows: np.ndarray) -> np.ndarray:
        """The sum of a value, or of each column of values, over the rows of each document."""
        if rows.ndim == 1:
            return np.bincount(self.doc, rows, self.documents)
        return np.stack([np.bincount(self.doc, column, self.documents) for column in rows.T], axis=1)

    def mixed(self, shares: np.ndarray) -> np.ndarray:
        return (shares[self.doc] * self.ratio).sum(axis=1)

    def fit(self, shares: np.ndarray) -> np.ndarray:
        """Log likelihood of each document, but for what all proportions have in common."""
        return self.summed(self.times * np.log(np.maximum(self.mixed(shares), 1e-300)))

    def slopes(self, shares: np.ndarray) -> np.ndarray:
        """What each language is worth at these shares: over n if it would raise the likelihood."""
        weight = self.times / np.maximum(self.mixed(shares), 1e-300)
        return self.summed(weight[:, None] * self.ratio)

    def of(self, wanted: np.ndarray) -> Batch:
        """Only these documents (a mask)."""
        rows = wanted[self.doc]
        out = object.__new__(Batch)
        number = np.cumsum(wanted) - 1
        out.doc, out.times, out.best, out.ratio = (
            number[self.doc[rows]], self.times[rows], self.best[rows], self.ratio[rows]
        )
        out.n, out.documents = self.n[wanted], int(wanted.sum())
        return out


def estimated(batch: Batch, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares by expectation maximisation from these on (a language at 0 stays out), and their fit."""
    fit = batch.fit(shares)
    for _ in range(ROUNDS):
        shares = shares * batch.slopes(shares) / batch.n[:, None]
        last, fit = fit, batch.fit(shares)
        if (fit - last).max(initial=0) < CLOSE:
            break
    return shares, fit


def proportions(batch: Batch) -> np.ndarray:
    """The language shares (documents x languages) of documents that all have words."""
    alone = batch.summed(batch.times[:, None] * np.log(np.maximum(batch.ratio, 1e-300)))
    shares = np.eye(batch.ratio.shape[1])[alone.argmax(axis=1)]
    fit = alone.max(axis=1)
    open_ = np.ones(batch.documents, bool)
    while open_.any():
        some = batch.of(open_)
        now, penalty = shares[open_], np.log(some.n) / 2
        gain = np.where(now > 0, 0, some.slopes(now)) - some.n[:, None]
        add = gain.argmax(axis=1)
        # the likelihood is concave in the shares, so it can't gain more than it rises at first
        worth = gain.max(axis=1) > penalty
        open_[np.flatnonzero(open_)[~worth]] = False
        if not worth.any():
            break
        some, now, penalty, add = some.of(worth), now[worth], penalty[worth], add[worth]
        tried = now * (1 - START)
        tried[np.arange(len(add)), add] += START
        tried, better = estimated(some, tried)
        at = np.flatnonzero(open_)
        accepted = better - fit[at] > penalty
        shares[at[accepted]], fit[at[accepted]] = tried[accepted], better[accepted]
        open_[at[~accepted]] = False
    return shares


def languages(texts: list[bytes], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Whether each text has a letter, and the language shares of those that do."""
    numbers = words.numbers([words_of(t) for t in texts])
    sizes = np.fromiter(map(len, numbers), np.int64, len(numbers))
    doc, word = np.repeat(np.arange(len(texts)), sizes), np.concatenate([*numbers, np.zeros(0, np.int64)])
    doc, word = doc[words.known[word]], word[words.known[word]]
    both, times = np.unique(doc * np.int64(len(words) + 1) + word, return_counts=True)
    doc, word = both // (len(words) + 1), both % (len(words) + 1)
    lettered = np.bincount(doc, minlength=len(texts)) > 0
    number = np.cumsum(lettered) - 1
    if not words.models.names or not len(doc):
        return lettered, np.zeros((int(lettered.sum()), 0))
    return lettered, proportions(Batch(number[doc], times, words.table[word], int(lettered.sum())))


def identified(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id, held_out, lang_pred, score and shares (language to proportion) of every document."""
    names = models.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(models)
        for batch in common.batches(batches, 200_000):
            lettered, shares = languages(list(common.texts(batch.column("text"))), words)
            found = [[] for _ in lettered]
            if names:
                for k, row in zip(np.flatnonzero(lettered), shares, strict=True):
                    found[k] = sorted(((names[j], float(row[j])) for j in np.flatnonzero(row)), key=lambda x: (-x[1], x[0]))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "held_out": batch.column("held_out"),
                    "lang_pred": pa.array([f[0][0] if f else UNKNOWN for f in found], pa.string()),
                    "score": pa.array([min(1.0, f[0][1]) if f else 0.0 for f in found]),
                    "shares": pa.array(found, pa.map_(pa.string(), pa.float64())),
                }
            )

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return rows.mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, shares map<string, double>"
    )


def op12_language_mixture(spark, sf_dir: str) -> DataFrame:
    """The predicted language of all documents, learned from four folds of five."""
    docs = common.clean_columns(
        common.read_table(spark, sf_dir, "documents"), {"doc_id": "long", "text": "string", "lang": "string"}
    )
    return identified(docs, learned(docs)).drop("shares")
