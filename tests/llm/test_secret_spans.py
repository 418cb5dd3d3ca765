"""The base spans and owners of secrets against a plain loop over all sample documents."""

import collections
import hashlib
import re

import __spark_entry__ as entry
from qcmart.llm import secret_scan

SF_DIR = "/root/testdata/sf0.01"
PATTERNS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
    ("access", r"AKIA[A-Z0-9]+", 18, 0),
    ("hex", r"[0-9a-f]+", 16, 0),
)


def _base(text):
    out = []
    for order, (kind, pattern, least, group) in enumerate(PATTERNS):
        out += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text, re.ASCII) if len(m[group]) >= least]
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def test_base_spans_of_all_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    expected = {}
    for r in docs:
        spans = _base(r.text or "")
        counts = collections.Counter(k for k, _, _ in spans)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        expected[r.doc_id] = (counts["assign"], counts["access"], counts["hex"], hashlib.sha256(listed.encode()).hexdigest(), spans)
    got = entry.queries()["op9_secret_scan"](spark, SF_DIR).collect()
    assert len(got) == len(docs) and sum(len(e[4]) for e in expected.values()) > 50
    for r in got:
        *counts, spans = expected[r.doc_id]
        assert [r.n_assign, r.n_access, r.n_hex, r.base_sha256] == counts
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(r.spans.split(",")) | {""}


def test_owners_of_values(spark):
    """A value of many owners is an example, one of a single owner a live secret."""
    live, copied = "q8Zr3nT0vK4Wx7Lw2mPd9sHc5yB1eF6u", "Zk3Vn8Qw1Lp6Ty0Rb5Xc9Mh2Df7Gs4Ja"
    rows = [(i, f"doc {i} secret = {copied} end", f"owner{i}") for i in range(40)]
    rows += [(100 + i, f"doc {i} token = {live} end", "one") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    text = {r.doc_id: r.text for r in secret_scan.redacted(docs).collect()}
    assert all(copied in text[i] for i in range(40))
    assert all(live not in text[100 + i] and "<secret>" in text[100 + i] for i in range(3))
