"""Substring dedup by relative Lempel-Ziv parsing of documents against all reference blocks.

Documents are dealt into blocks, and the windows of ``width`` words of every block are the reference:
each distinct window is indexed once in the corpus, by its first start (smaller doc_id, then earlier in
the document). A window that isn't at its first start has a match there. Matches of neighbouring windows
on one diagonal (same source document, same distance) that meet or overlap are one match, every word of
which equals its source.

Each document is factored greedily from its first word: the factor at a word is the match that reaches
furthest from it; a word without a match is a literal. At the end of a factor, a match may reach on by
fewer than ``width`` words. It is checked across that boundary: as the window that ends with it and
begins before the boundary starts earlier too, it becomes a factor that overlaps the one before.
So each factor has at least ``width`` words, a source document and a start there, and the factors cover
exactly the words of windows that start earlier. As a window is indexed by its first start alone, a
factor ends where its source has no further window on that diagonal or in reach of it; a passage may
then go on as the next factor, from an earlier source.

The index is exchanged as packed arrays. A window is named by the smallest of its 8-word hashes
(equal windows have equal smallest hashes); first only these, one seventh of the words, meet
across blocks. Only windows whose name occurs in two blocks are exchanged as whole windows, once
per block, and come back with their first start. A passage in every document is thus one entry per
block and never gathers in a task.

Defined results: null or empty text has no words. Rows that share a doc_id lie on top of each
other: a start in one is earlier than a later start in another, and equal starts are level. A null
doc_id comes after all others, and is null as a source. Other columns are ignored. Windows are compared
by 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qcmart.llm import common

WIDTH = 20
NAME_WORDS = 8
BLOCK_BYTES = 8_000_000
LAST = np.iinfo(np.int64).max


def _lowest(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each run of so many values."""
    span = 1
    while span < width:
        step = min(span, width - span)
        x = np.minimum(x[:-step], x[step:])
        span += step
    return x


class Windows:
    """All windows of a block: hash, name, document row and start; and which are first here."""

    def __init__(self, table: pa.Table, width: int, with_words: bool = False) -> None:
        name_words = min(NAME_WORDS, width)
        hashes, found, lengths, self.words = common.WordHashes(), [], [], []
        for text in common.texts(table.column("text")):
            words = text.split()
            found.append(hashes.of(words))
            lengths.append(len(words))
            if with_words:
                self.words.append(words)
        self.lengths = np.array(lengths, np.int64)
        flat = np.concatenate([*found, np.empty(0, np.uint64)])
        at, self.row = common.starts_within(self.lengths, width)
        self.first_word = np.cumsum(self.lengths) - self.lengths
        self.start = at - self.first_word[self.row]
        grams = common.gram_hashes(flat, width)
        self.hash = grams[at] if len(at) else np.empty(0, np.uint64)
        names = common.gram_hashes(flat, name_words)
        span = width - name_words + 1
        self.name = _lowest(names, span)[at] if len(at) else np.empty(0, np.uint64)
        ids = pc.fill_null(table.column("doc_id"), LAST)  # as whole numbers: a double is not exact
        self.doc = ids.to_numpy()[self.row]

    def earliest(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The windows in order of (hash, document, start), the first of the hash of each, and
        which are level with that."""
        order = np.lexsort((self.start, self.doc, self.hash))
        h, d, s = self.hash[order], self.doc[order], self.start[order]
        new = np.ones(len(order), bool)
        new[1:] = h[1:] != h[:-1]
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        level = (d == d[first]) & (s == s[first])
        return order, order[first], level


def _packed(buckets: np.ndarray, block: int, columns: list[np.ndarray]) -> pa.Table:
    """Rows (bucket, block, one packed array per column) of equal buckets."""
    order = np.argsort(buckets, kind="stable")
    kinds, at = np.unique(buckets[order], return_index=True)
    edges = [*at.tolist(), len(order)]
    data = {"bucket": pa.array(kinds.astype(np.int32)), "block": pa.array(np.full(len(kinds), block, np.int32))}
    for k, column in enumerate(columns):
        sorted_ = column[order]
        data[f"data{k}"] = pa.array(
            [sorted_[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)], pa.binary()
        )
    return pa.table(data)


def _unpacked(table: pa.Table, name: str, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), kind) for x in table.column(name)]


def _by_block(blocks: np.ndarray, columns: list[np.ndarray]) -> pa.Table:
    out = _packed(blocks, 0, columns)
    return out.drop_columns(["block"]).rename_columns({"bucket": "block"})


def _all(table: pa.Table) -> np.ndarray:
    """The packed values that came back to a block, sorted."""
    return np.sort(np.concatenate([*_unpacked(table, "data0", np.uint64), np.empty(0, np.uint64)]))


def _among(values: np.ndarray, found: np.ndarray) -> np.ndarray:
    if not len(found):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(found, values), len(found) - 1)
    return found[at] == values


def _names(buckets: int, width: int):
    def run(table: pa.Table) -> pa.Table:
        names = np.unique(Windows(table, width).name)
        block = table.column("block")[0].as_py()
        return _packed((names % np.uint64(buckets)).astype(np.int32), block, [names])

    return run


def _shared_names(table: pa.Table) -> pa.Table:
    """The names that two blocks of a bucket have, for each of these blocks."""
    parts = _unpacked(table, "data0", np.uint64)
    names = np.concatenate(parts)
    blocks = np.repeat(table.column("block").to_numpy(), [len(x) for x in parts])
    order = np.argsort(names, kind="stable")
    names, blocks = names[order], blocks[order]
    same = names[1:] == names[:-1]
    shared = np.zeros(len(names), bool)
    shared[1:] |= same
    shared[:-1] |= same
    return _by_block(blocks[shared], [names[shared]])


def _candidates(buckets: int, width: int):
    def run(key, docs: pa.Table, shared: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _packed(np.empty(0, np.int32), 0, [np.empty(0, np.uint64)] * 3)
        windows = Windows(docs, width)
        order, _, level = windows.earliest()
        pick = order[level]
        pick = pick[_among(windows.name[pick], _all(shared))]
        # level windows of one hash are told once
        _, one = np.unique(windows.hash[pick], return_index=True)
        pick = pick[one]
        hashes = windows.hash[pick]
        return _packed(
            (hashes % np.uint64(buckets)).astype(np.int32),
            docs.column("block")[0].as_py(),
            [hashes, windows.doc[pick], windows.start[pick].astype(np.int32)],
        )

    return run


def _earlier_elsewhere(table: pa.Table) -> pa.Table:
    """The windows of a bucket that start earlier in another block, and where, for each block."""
    hashes = _unpacked(table, "data0", np.uint64)
    blocks = np.repeat(table.column("block").to_numpy(), [len(x) for x in hashes])
    h = np.concatenate(hashes)
    d = np.concatenate(_unpacked(table, "data1", np.int64))
    s = np.concatenate(_unpacked(table, "data2", np.int32))
    order = np.lexsort((s, d, h))
    h, d, s, blocks = h[order], d[order], s[order], blocks[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = (d != d[first]) | (s != s[first])
    first = first[later]
    return _by_block(blocks[later], [h[later], d[first], s[first]])


class Matches:
    """The words of a block that equal words of an earlier start, as runs on one diagonal: document
    row, first word, word after the last, source document and start; by row, then first word."""

    def __init__(self, windows: Windows, earlier: pa.Table, width: int) -> None:
        order, first, level = windows.earliest()
        doc, start = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        doc[order], start[order] = windows.doc[first], windows.start[first]
        found = np.ones(len(order), bool)
        found[order[level]] = False
        hashes = np.concatenate([*_unpacked(earlier, "data0", np.uint64), np.empty(0, np.uint64)])
        if len(hashes):
            by_hash = np.argsort(hashes)
            hashes = hashes[by_hash]
            at = np.minimum(np.searchsorted(hashes, windows.hash), len(hashes) - 1)
            elsewhere = hashes[at] == windows.hash
            at = by_hash[at[elsewhere]]
            doc[elsewhere] = np.concatenate(_unpacked(earlier, "data1", np.int64))[at]
            start[elsewhere] = np.concatenate(_unpacked(earlier, "data2", np.int32))[at]
            found |= elsewhere
        row, word, doc, start = windows.row[found], windows.start[found], doc[found], start[found]
        order = np.lexsort((word, word - start, doc, row))
        row, word, doc, start = row[order], word[order], doc[order], start[order]
        new = np.ones(len(row), bool)
        new[1:] = (
            (row[1:] != row[:-1])
            | (doc[1:] != doc[:-1])
            | (word[1:] - start[1:] != word[:-1] - start[:-1])
            | (word[1:] - word[:-1] > width)
        )
        last = np.ones(len(row), bool)
        last[:-1] = new[1:]
        runs = row[new], word[new], word[last] + width, doc[new], start[new]
        order = np.lexsort((runs[4], runs[3], runs[1], runs[0]))
        self.row, *self.runs = (x[order] for x in runs)

    def of(self, row: int) -> list[tuple[int, int, int, int]]:
        a, b = np.searchsorted(self.row, [row, row + 1])
        return list(zip(*(x[a:b].tolist() for x in self.runs), strict=True))


def parsed(matches: list[tuple[int, int, int, int]], width: int) -> list[tuple[int, int, int, int]]:
    """The greedy factors of a document, as (first word, word after the last, source document, start
    there), from its matches in the same form, each of at least width words, by first word."""
    factors, reach, word, k = [], None, 0, 0
    while True:
        while k < len(matches) and matches[k][0] <= word:
            if reach is None or matches[k][1] > reach[1]:
                reach = matches[k]
            k += 1
        if reach is not None and reach[1] > word:
            first, end, doc, start = reach
            at = min(word, end - width)  # a shorter rest reaches back over the boundary
            factors.append((at, end, doc, start + at - first))
            word = end
        elif k < len(matches):
            word = matches[k][0]
        else:
            return factors


def _kept(words: list[bytes], factors: list[tuple[int, int, int, int]]) -> list[bytes]:
    """The words that no factor covers."""
    out, word = [], 0
    for a, b, _, _ in factors:
        out += words[word:a]
        word = b
    return out + words[word:]


FACTORS = (
    "doc_id long, n_words long, starts array<int>, ends array<int>, source_docs array<long>, "
    "source_starts array<int>, n_removed long, kept_sha256 string"
)


def _factors(width: int):
    def run(key, docs: pa.Table, earlier: pa.Table) -> pa.Table:
        windows = Windows(docs, width, with_words=True)
        matches = Matches(windows, earlier, width)
        flat, sizes, removed, digests = [], [0], [], []
        for row, words in enumerate(windows.words):
            factors = parsed(matches.of(row), width)
            kept = _kept(words, factors)
            flat += factors
            sizes.append(len(flat))
            removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        starts, ends, sources, at = np.array(flat, np.int64).reshape(-1, 4).T

        def lists(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), values)

        return pa.table(
            {
                "doc_id": docs.column("doc_id"),
                "n_words": pa.array(windows.lengths, pa.int64()),
                "starts": lists(pa.array(starts, pa.int32())),
                "ends": lists(pa.array(ends, pa.int32())),
                "source_docs": lists(pa.array(sources, pa.int64(), mask=sources == LAST)),
                "source_starts": lists(pa.array(at, pa.int32())),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
            }
        )

    return run


def duplicate_spans(docs: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each document its words, the factors [starts, ends) in words that repeat earlier
    text, the documents and words that they repeat, how many words they cover and the digest of
    what is left."""
    docs = common.clean_columns(docs, {"doc_id": "long", "text": "string"})
    blocks = common.blocks_of(docs, block_bytes)
    docs = common.dealt(docs.withColumn("block", common.block_number(blocks)), blocks, "block")
    names = docs.groupBy("block").applyInArrow(
        _names(blocks, width), "bucket int, block int, data0 binary"
    )
    shared = common.dealt(names, blocks, "bucket").groupBy("bucket").applyInArrow(
        _shared_names, "block int, data0 binary"
    )
    shared = common.dealt(shared, blocks, "block")
    windows = docs.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        _candidates(blocks, width),
        "bucket int, block int, data0 binary, data1 binary, data2 binary",
    )
    earlier = common.dealt(windows, blocks, "bucket").groupBy("bucket").applyInArrow(
        _earlier_elsewhere, "block int, data0 binary, data1 binary, data2 binary"
    )
    earlier = common.dealt(earlier, blocks, "block")
    return docs.groupBy("block").cogroup(earlier.groupBy("block")).applyInArrow(
        _factors(width), FACTORS
    )


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Words of documents in factors of 20 words or more from earlier text, and the digest of the rest."""
    spans = duplicate_spans(common.read_table(spark, sf_dir, "documents"))
    return spans.select("doc_id", "n_words", "n_removed", "kept_sha256")


#: Every window looked up, which leaves the words that the factors leave.
ORACLE = r"""
with words as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
),
windows as (
    select doc_id, a, md5(array_to_string(w[a : a + 19], ' ')) as h
    from (select doc_id, w, unnest(range(1, len(w) - 18)) as a from words where len(w) >= 20)
),
placed as (
    select doc_id, a, row_number() over (partition by h order by doc_id, a) as place from windows
),
repeated as (
    select distinct doc_id, unnest(range(a, a + 20)) as p from placed where place > 1
),
each as (
    select doc_id, w[p] as word, p from (select doc_id, w, unnest(range(1, len(w) + 1)) as p from words)
),
kept as (
    select doc_id, count(*) as n, string_agg(word, ' ' order by p) as text
    from each anti join repeated using (doc_id, p)
    group by doc_id
)
select doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(text, '')) as kept_sha256
from words left join kept using (doc_id)
"""
