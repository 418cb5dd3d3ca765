"""The filter audit against plain loops over all orders."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from qcmart.llm import filter_audit
from tests.llm import helpers

LABELS = "doc_id long, quality int, toxic int, text string, mask int"


def _fails(rows):
    """(part, failed letters) of each (doc_id, text, lang)."""
    out = []
    for i, text, lang in rows:
        t = text or ""
        w = t.encode().split()
        failed = set()
        failed |= {"A"} if len(w) < 200 else set()
        failed |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        failed |= {"C"} if 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t) else set()
        failed |= {"D"} if set(t) & set("#$%&*|") else set()
        smaller = [j for j, other, _ in rows if j is not None and i is not None and j < i and (other or "") == t]
        failed |= {"E"} if smaller else set()
        out.append((i, lang or "", failed))
    return out


def _audited(rows, labels, before=()):
    fails, out = _fails(rows), {}
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    orders = [o for o in itertools.permutations("ABCDE") if all(o.index(a) < o.index(b) for a, b in before)]
    for part in {p for _, p, _ in fails}:
        removed_in_all = dict.fromkeys("ABCDE", 0)
        for order in orders:
            left = [(i, f) for i, p, f in fails if p == part]
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                own = [f for _, p, f in fails if p == part and letter in f]
                removed_in_all[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(own) - len(gone), sum(len(f) == 1 for f in own),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_in_all[order[step - 1]])
    return out


def _got(df):
    rows = df.collect()
    assert len({(r.part, r.filter_order, r.step) for r in rows}) == len(rows)
    return {(r.part, r.filter_order, r.step): list(r)[3:] for r in rows}


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in helpers.documents(spark).collect()]
    rows += [
        (20, "LOUD " * 300, "fr"),
        (21, "LOUD " * 300, "en"),  # a copy in another language
        (22, helpers.LONG + " 5 $", "fr"),
        (23, "said once", None),
        (None, "said once", None),  # a copy without an id
        (24, "said once", None),
        (25, helpers.LONG, ""),
    ]
    labels = [(20, 0, 1), (21, 1, 0), (21, None, 1), (22, 1, None), (None, 1, 1), (24, 1, 1), (99, 1, 1)]
    docs = spark.createDataFrame(
        [(i, t, lang, "s", 1, 2) for i, t, lang in rows],
        "doc_id long, text string, lang string, part string, mask int, good int",
    )
    return rows, labels, docs, spark.createDataFrame([(*r, "x", 1) for r in labels], LABELS)


def test_audit_matches_loops(tables):
    rows, labels, docs, label_table = tables
    found = filter_audit.failures(docs, label_table)
    assert _got(filter_audit.audit(found, "ABCDE")) == _audited(rows, labels)


def test_orders_can_be_restricted(tables):
    rows, labels, docs, label_table = tables
    found = filter_audit.failures(docs, label_table)
    before = [("E", "A"), ("B", "C")]
    assert _got(filter_audit.audit(found, "ABCDE", before)) == _audited(rows, labels, before)
    with pytest.raises(ValueError):
        filter_audit.audit(found, "ABCDE", [("A", "B"), ("B", "A")])


def test_nothing_to_audit(tables):
    _, _, docs, label_table = tables
    none = filter_audit.failures(docs.where(F.lit(False)), label_table)
    assert filter_audit.audit(none, "ABCDE").count() == 0
    alone = filter_audit.failures(docs.where("doc_id = 1"), label_table.where(F.lit(False)))
    assert filter_audit.audit(alone, "ABCDE").count() == 600


def test_paths_through_the_lattice():
    for k in (1, 3, 5):
        edges = filter_audit.lattice(k)
        assert len(edges) == k * 2 ** (k - 1)
        for e in edges:
            done = bin(e.state).count("1")
            assert e.reaching * e.leaving == math.factorial(done) * math.factorial(k - 1 - done)
        assert len(list(filter_audit.orders(edges))) == math.factorial(k)
    with pytest.raises(ValueError):
        filter_audit.lattice(filter_audit.MOST_FILTERS + 1)
