"""Factors of the relative Lempel-Ziv parsing: their sources, boundaries and reach."""

import random

import pytest

from qcmart.llm import substring_dedup
from tests.llm import helpers

WIDTH = 20


def run(name, n):
    return [f"{name}{i}" for i in range(n)]


def factored(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.duplicate_spans(docs, **settings).collect()
    return {
        r.doc_id: list(zip(r.starts, r.ends, r.source_docs, r.source_starts, strict=True)) for r in got
    }, sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got)


# all documents in one block, or about one each
@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_sources_and_boundaries(spark, block_bytes):
    p, q, a, b, c = run("p", 30), run("q", 25), run("a", 15), run("b", 10), run("c", 15)
    line = run("line", 22)
    long = [*run("x", 40), *line, *run("y", 40)]
    texts = {
        1: [*run("h", 5), *p],
        2: [*q, "tail"],
        3: [*a, *b],
        4: ["one", "two", "three", *b, *c],
        5: [*p, *q, "end"],  # passages that abut
        6: [*a, *b, *c],  # the second match reaches on by 15 words
        7: [*a, *c],  # nothing of 20 words
        0: line,
        8: long,
        9: ["new", *long],  # a line of it starts even earlier, but its neighbours overlap
        10: ["again"] * 50,
    }
    got, _ = factored(spark, [(i, " ".join(t)) for i, t in texts.items()], block_bytes=block_bytes)
    assert got[1] == got[2] == got[3] == got[4] == got[7] == got[0] == []
    assert got[5] == [(0, 30, 1, 5), (30, 55, 2, 0)]
    assert got[6] == [(0, 25, 3, 0), (20, 40, 4, 8)]
    assert got[8] == [(40, 62, 0, 0)]
    assert got[9] == [(1, 103, 8, 0)]
    assert got[10] == [(1, 21, 10, 0), (21, 41, 10, 0), (30, 50, 10, 0)]


def test_ids(spark):
    """A null id comes after all others, and ids of 2^53 and more stay exact beside it."""
    text, big = " ".join(["again"] * 21), 2**53
    got, _ = factored(spark, [(None, text)])
    assert got[None] == [(1, 21, None, 0)]
    words = " ".join(run("w", 25))
    got, _ = factored(spark, [(None, words), (big + 1, words), (big, words)])
    assert got == {None: [(0, 25, big, 0)], big + 1: [(0, 25, big, 0)], big: []}


@pytest.mark.parametrize("seed", range(3))
def test_factors_equal_their_sources(spark, seed):
    """Random mosaics: each factor equals the words at its source, which starts earlier; factors leave
    the words that looking every window up leaves."""
    draw = random.Random(seed)
    pieces = [run(f"w{k}", draw.randint(8, 45)) for k in range(30)]
    texts = {
        i: [w for _ in range(draw.randint(0, 9)) for w in draw.choice(pieces)[draw.randint(0, 6) :]]
        for i in range(60)
    }
    rows = [(i, " ".join(t)) for i, t in texts.items()]
    got, summary = factored(spark, rows, block_bytes=4000)
    assert summary == sorted((str(i), n, k, d) for i, n, k, d in helpers.without_repeats(rows))
    assert sum(map(len, got.values())) > 30
    for i, factors in got.items():
        for start, end, doc, at in factors:
            assert end - start >= WIDTH and (doc, at) < (i, start)
            assert texts[i][start:end] == texts[doc][at : at + end - start]
        assert [f[:2] for f in factors] == sorted(f[:2] for f in factors)
