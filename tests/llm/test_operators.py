"""The operators on small tables with nulls, ties and odd texts, against brute force."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from qcmart.llm import (
    chat_format,
    components,
    decontamination,
    lm_scoring,
    multi_index,
    near_dedup,
    secret_scan,
    source_mixing,
    substring_dedup,
    toxicity,
    warc,
)
from tests.llm import helpers


@pytest.fixture(scope="module")
def docs(spark):
    return helpers.documents(spark).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def test_lm_scores(docs, rows):
    got = lm_scoring.scored(docs, block_bytes=2000).collect()
    counts = collections.Counter()
    for i, t in rows:
        if helpers.crc(i, 7) != 2:
            counts.update([*(t or "").encode().lower().split(), b" "])
    n, v = sum(counts.values()), len(counts)
    expected = collections.Counter()
    for i, t in rows:
        w = [*(t or "").encode().lower().split(), b" "]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        expected[(i, len(w), sum(counts[x] > 0 for x in w), round(base, 6))] += 1
    assert expected == collections.Counter(
        (r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got
    )
    assert all(r.score < 0 and math.isfinite(r.score) and r.train_tokens == n for r in got)


def test_spelling_is_a_distribution():
    """All one-byte continuations of M, and the rest, make one."""
    mixer = lm_scoring.Mixer()
    tables = np.zeros((2, len(lm_scoring.ORDERS), lm_scoring.TABLE), np.float32)
    lm_scoring.count_bits([b"abc", b"abd", b"xyz"], *tables)
    mixer.learn([b"abc", b"abd", b"xyz"], *tables)
    odds = lm_scoring.predictions(*tables)
    levels = [lm_scoring.seen_level(tables[0][k] + tables[1][k]) for k in lm_scoring.GATED]
    spelled = lm_scoring.Spelled([bytes([b]) for b in range(256)])
    assert len(spelled.data) == 512
    cost = mixer.bits([bytes([b]) for b in range(256)], odds, levels)
    assert 0 < np.exp2(-cost).sum() < 1


def test_mix(spark, docs):
    got = source_mixing.mix_sizes(source_mixing.sized(docs)).collect()
    assert len(got) == docs.count()
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    goal = {r.source: r.target for r in got}
    taken = collections.Counter()
    for r in got:
        taken[r.source] += r.taken
    assert all(abs(taken[s] - t) <= 16 for s, t in goal.items())
    assert abs(sum(goal.values()) - sum(r.size for r in got)) < 1e-6


def test_sainte_lague_is_highest_quotients(spark):
    random.seed(3)
    votes = {k: random.randint(1, 5000) for k in range(40)}
    for seats in (1, 7, 40, 1000):
        quotients = sorted(((-v / (2 * k + 1), p) for p, v in votes.items() for k in range(seats)))[:seats]
        expected = collections.Counter(p for _, p in quotients)
        table = spark.createDataFrame([(0, p, float(v), seats) for p, v in votes.items()], "g int, p int, v double, s int")
        got = {r.p: r.won for r in source_mixing.sainte_lague(table, ["g"], "p", "v", "s").collect() if r.won}
        assert got == dict(expected)


def test_chats_round_trip(spark):
    rows = [
        (1, 2, "assistant", "a ### b </turn> \\h \\s \\\\"),
        (1, 1, "user", None),
        (1, 2, "assistant", "a ### b </turn> \\h \\s \\\\"),
        (1, 3, None, ":\n### x:\n"),
        (None, None, "user:\n", ""),
        (2, 1, "assistant", "é" * 5000),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = chat_format.read_chats(chat_format.format_chats(table)).collect()
    turns = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in back}
    loss = {r.conv_id: list(r.loss_texts) for r in back}
    said = "a ### b </turn> \\h \\s \\\\"
    assert turns[1] == [("user", ""), ("assistant", said), ("assistant", said), ("", ":\n### x:\n")]
    assert turns[None] == [("user:\n", "")] and loss[None] == []
    assert loss[1] == [said, said] and loss[2] == ["é" * 5000]


def test_search(spark):
    random_ = np.random.default_rng(1)
    points = random_.normal(size=(300, 6))
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    rows += [(300, None), (301, [0.0] * 6), (302, [math.nan] * 6), (303, [1.0, None] * 3), (304, [1.0])]
    rows += [(400 + k, rows[0][1]) for k in range(20)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = table.select(F.col("vec_id").alias("query_id")).where("vec_id % 100 = 0")
    got = collections.defaultdict(list)
    for r in multi_index.search(table, asked).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, round(r.score, 9)))
    valid = [r for r in rows if r[0] < 300 or r[0] >= 400]
    hits = 0
    for q, v in [r for r in valid if r[0] % 100 == 0]:
        away = {i: round(math.dist(v, w), 9) for i, w in valid if i != q}
        assert got[q] == sorted(((i, away[i]) for i, _ in got[q]), key=lambda r: (r[1], r[0]))
        near = sorted(away, key=lambda i: (away[i], i))[:10]
        hits += len({i for i, _ in got[q]} & set(near))
        assert len(got[q]) == 10
        if q in (0, 400):  # the copies lie in one cell: the smallest ids of them are found
            assert [i for i, _ in got[q]] == near
    assert hits >= 0.9 * 10 * len(got) and set(got) == {0, 100, 200, 400}
    assert multi_index.search(table.limit(0), asked).count() == 0


def test_substring_dedup(docs, rows):
    once = [r for r in dict.fromkeys(rows)]
    got = substring_dedup.duplicate_spans(docs.dropDuplicates(["doc_id"]), block_bytes=3000).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(
        (str(i), n, k, d) for i, n, k, d in helpers.without_repeats(once)
    )


def test_decontamination(spark, docs):
    item = helpers.PASSAGE.split()[3:20]
    item[5] = item[9] = "changed"
    items = [(1, " ".join(item)), (2, "alpha beta gamma delta epsilon"), (3, None), (4, "two words"), (5, "alpha x gamma delta epsilon")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, table).collect()}
    assert got == {(9, 1), (10, 1), (1, 2)}


def test_toxicity(spark):
    random.seed(5)
    plain = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(600):
        text = random.choices(plain, k=40)
        if i % 4 == 0:
            text[3:5] = ["you", random.choice(["idiot", "grobian", "grobians"])]
        rows.append((i, " ".join(text), i % 4 == 0))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(y), None) for i, _, y in rows], "doc_id long, toxic int, quality int")
    got = {r.doc_id: r for r in toxicity.scored(docs, labels).collect()}
    held = [(got[i].predicted, int(y)) for i, _, y in rows if helpers.crc(i, 5) == 0]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)
    assert got[900].score == got[901].score and 0 <= got[900].score <= 1
    assert {r.score for r in toxicity.scored(docs, labels.limit(0)).collect()} == {0.0}


def test_warc_round_trip(spark, tmp_path):
    long = "é" * 800
    rows = [(1, "http://a/\r\nX: y", long), (2, None, long), (3, "u", "short"), (4, "u", "short"), (5, "u", None), (None, "u", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write_archives(warc.with_revisits(pages), str(tmp_path), archive_bytes=300)
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_archives(manifest, str(tmp_path)).collect()}
    assert got == {
        (1, "revisit", 2, 1600),
        (2, "response", None, 1600),
        (3, "response", None, 5),
        (4, "response", None, 5),
        (5, "response", None, 0),
        (None, "revisit", 2, 1600),
    }
    data = warc.record(7, "u", b"abc", "a9993e364706816aba3e25717850c26c9cd0d89d", None)
    assert warc.parse(data)[4:] == (3, "a9993e364706816aba3e25717850c26c9cd0d89d", b"abc")
    with pytest.raises(warc.BadRecord):
        warc.parse(data.replace(b"abc\r\n", b"abd\r\n"))


def test_secrets(docs):
    found = secret_scan.scan(docs)
    got = {r.doc_id: r.spans for r in found.collect()}
    assert got[2] == got[3] == ""
    assert got[13] == "assign:2:32,hex:11:31".replace(":32", ":31")
    assert got[14] == "access:4:24,hex:25:45"
    text = {r.doc_id: r.text for r in secret_scan.redacted(docs).collect()}
    assert text[13].startswith('x <secret>"') and text[1].startswith("alpha")


def test_near_groups(docs, rows):
    got = near_dedup.near_duplicates(docs, 4).collect()
    expected = helpers.near_groups([r for r in rows if r[0] is not None], 4, 80)
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id is not None} == set(expected.items())
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)


def test_components(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, 200), (300, 200), (5, 5)]
    got = dict(components.components(spark.createDataFrame(pairs, "u long, v long")).collect())
    assert all(got[i] == 0 for i in range(61)) and got[300] == got[200] == got[100] == 100


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert lm_scoring.scored(none).count() == 0
    assert source_mixing.mix_sizes(source_mixing.sized(none)).count() == 0
    assert substring_dedup.duplicate_spans(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0
    assert secret_scan.redacted(none).count() == 0
    items = none.select(F.col("doc_id").alias("item_id"), "text")
    assert decontamination.leaks(docs, items).count() == 0
