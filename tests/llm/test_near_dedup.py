"""SuperMinHash signatures, and groups of near copies too large for one pair a member."""

import itertools
import random

import numpy as np
import pytest

from qcmart.llm import near_dedup


def _groups(rows, width, percent):
    """Smallest reachable id, all pairs compared once."""
    sets = {}
    for i, text in rows:
        w = text.split()
        sets[i] = {tuple(w[a : a + width]) for a in range(len(w) - width + 1)}
    near = {i: [] for i in sets}
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            near[a].append(b)
            near[b].append(a)
    found = {}
    for i in sorted(sets):
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in found:
                found[j] = i
                todo += near[j]
    return found


def _pair(rng, n, percent):
    """Two sets of n hashes that share this percentage of their union."""
    both = round(2 * n * percent / (100 + percent))
    x = rng.integers(0, 2**63, 2 * n - both, dtype=np.uint64)
    return np.sort(x[:n]), np.sort(x[n - both :])


@pytest.mark.parametrize("n,percent", [(12, 50), (60, 80), (400, 80), (5000, 30)])
def test_signatures_estimate_similarity(n, percent):
    """Unbiased, and with no more variance than independent hashes have."""
    rng = np.random.default_rng(n)
    pairs = [_pair(rng, n, percent) for _ in range(150)]
    signed = near_dedup.signatures([s for pair in pairs for s in pair]).reshape(len(pairs), 2, -1)
    assert (signed != near_dedup.EMPTY).all()
    equal = (signed[:, 0] == signed[:, 1]).mean(axis=1)
    true = np.array([len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for a, b in pairs])
    deviation = np.sqrt(true.mean() * (1 - true.mean()) / near_dedup.SLOTS)
    assert abs((equal - true).mean()) < 4 * deviation / np.sqrt(len(pairs))
    assert (equal - true).std() < 1.2 * deviation


def test_each_shingle_takes_every_slot_once():
    """Alone in a set, a shingle ranks all slots: round j fills one more."""
    signed = near_dedup.signatures([np.array([h], np.uint64) for h in (1, 2, 3)])
    for row in signed:
        assert sorted(row >> 24) == list(range(near_dedup.SLOTS))
    assert len({tuple(row >> 24) for row in signed}) == 3


def test_large_groups_lose_no_link(spark, monkeypatch):
    """Near copies of which many are linked with few others, in chunks of every step."""
    for name, value in (("ALL", 4), ("FEW", 1), ("CHUNK", 40), ("AROUND_HUB", 7), ("CHUNK_SHINGLES", 6_000)):
        monkeypatch.setattr(near_dedup, name, value)
    r = random.Random(11)
    base = [f"b{k}" for k in range(120)]
    rows = [(1000 + k, " ".join(base)) for k in range(20)]
    for k in range(150):
        words = list(base)
        for _ in range(r.randint(1, 8)):
            words[r.randrange(120)] = f"x{r.randrange(60)}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in near_dedup.near_duplicates(docs, 4).collect()}
    assert got == _groups(rows, 4, 80)
    assert len(set(got.values())) > 5


def test_rows_of_one_id(spark):
    rows = [(1, "a b c d e f"), (1, "u v w x y z"), (2, "a b c d e f"), (3, "u v w x y z"), (None, "a b c d e f"), (None, "q r s t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near_dedup.near_duplicates(docs, 4).collect())
    assert got == sorted([("1", "1", True)] * 2 + [("2", "1", False), ("3", "1", False), ("None", "1", False), ("None", "None", True)])
