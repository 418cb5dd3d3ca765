"""Secret scans judged by who owns a value.

1. Every whole text is searched for spans of several kinds. A span has a value: what a key is
   assigned, or else the whole span.
2. Over the corpus each value is counted by distinct repositories and distinct owners. Pairs of value
   and owner are made distinct before they are counted, so a value in a third of all documents is a
   few rows per owner.
3. A value that ``widely`` owners hold is a copied example. Any other value that looks random is taken
   for a live credential of its owner; the rest is weak. Placeholders within a value don't count for
   it, and those in private keys, jwt and github tokens not against it.

Here a document is a repository and its source the owner; both are parameters.

Defined results: null or empty text has no spans and is returned with zero counts and the digest of
an empty list. A null owner is one owner without a name. Rows that share id and text are scanned as
one and each returned. Offsets are code points, ends exclusive. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qcmart.llm import common

#: Patterns of the base kinds, in their order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the runs of at least 16
#: Words of which an assignment has one, and the parts by which texts without any are passed over.
ASSIGN_PARTS = ("passw", "secret", "token", "api")

#: Kinds that this method adds, by their published formats.
MORE = {
    "github": (re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}"), ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    "jwt": (re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), ("eyJ",)),
    "slack": (re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}"), ("xox",)),
    "pem": (re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\s]*"), ("PRIVATE KEY",)),
}
BASE = ("assign", "access", "hex")
KINDS = (*BASE, *MORE)

WIDELY = 3
LEAST_ENTROPY = 2.5
#: So many characters must be left of a value without its placeholders: as many as a hex span has.
LEAST_LEFT = 16
#: Kinds whose format proves a value, whatever it spells: encoded keys hold runs of A for their zeros.
PROVEN = frozenset({"github", "jwt", "pem"})
PLACEHOLDER = re.compile(r"example|sample|dummy|changeme|placeholder|your[_-]?|x{4,}|(.)\1{5,}", re.I)

FOUND = (
    "key long, doc_id long, owner string, repository string, n_assign long, n_access long, n_hex long, "
    "base_sha256 string, spans string, "
    "found array<struct<kind: string, start: int, stop: int, value: string, random: boolean>>"
)


def find(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, stop, value) of all spans, sorted."""
    out = []
    lower = text.lower()
    if any(p in lower for p in ASSIGN_PARTS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 12:
                out.append((m.start(), 0, m.end(), m[2]))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 18:
                out.append((m.start(), 1, m.end(), m[0]))
    for m in HEX.finditer(text):
        out.append((m.start(), 2, m.end(), m[0]))
    for k, (pattern, parts) in enumerate(MORE.values(), len(BASE)):
        if any(p in text for p in parts):
            out += [(m.start(), k, m.end(), m[0]) for m in pattern.finditer(text)]
    return sorted(out)


def looks_random(value: str, kind: str) -> bool:
    """Whether the characters of a value vary as those of a random one; those that are left without
    placeholders, if its kind doesn't prove it."""
    if kind not in PROVEN:
        left = PLACEHOLDER.sub("", value)
        if left != value and len(left) < LEAST_LEFT:
            return False
        value = left
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= LEAST_ENTROPY


def listed(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in spans)


def _scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        out = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "found")}
        for value in batch.column("text"):
            spans = find(value.as_py() or "")
            kinds = Counter(s[1] for s in spans)
            base = listed([s for s in spans if s[1] < len(BASE)])
            out["n_assign"].append(kinds[0])
            out["n_access"].append(kinds[1])
            out["n_hex"].append(kinds[2])
            out["base_sha256"].append(hashlib.sha256(base.encode()).hexdigest())
            out["spans"].append(listed(spans))
            out["found"].append(
                [
                    {
                        "kind": KINDS[k],
                        "start": a,
                        "stop": b,
                        "value": hashlib.sha256(v.encode()).hexdigest(),
                        "random": looks_random(v, KINDS[k]),
                    }
                    for a, k, b, v in spans
                ]
            )
        found = pa.list_(
            pa.struct(
                [
                    ("kind", pa.string()),
                    ("start", pa.int32()),
                    ("stop", pa.int32()),
                    ("value", pa.string()),
                    ("random", pa.bool_()),
                ]
            )
        )
        kinds_of = {"n_assign": pa.int64(), "n_access": pa.int64(), "n_hex": pa.int64(), "found": found}
        columns = {k: batch.column(k) for k in ("key", "doc_id", "owner", "repository")}
        columns |= {k: pa.array(v, kinds_of.get(k, pa.string())) for k, v in out.items()}
        yield pa.RecordBatch.from_pydict(columns)


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """The spans of every document; key stands for its id and text."""
    docs = docs.select(
        F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("key"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"),
        F.col("text").cast("string").alias("text"),
    )
    return common.stored(docs.mapInArrow(_scan, FOUND))


def judged(found: DataFrame, widely: int = WIDELY) -> DataFrame:
    """Each span of scan() with the owners and repositories of its value and a verdict: example,
    live or weak."""
    spans = found.where(F.size("found") > 0).select(
        "key", "owner", "repository", F.explode("found").alias("s")
    )
    spans = spans.select("key", "owner", "repository", "s.*")
    held = spans.groupBy("value", "owner", "repository").agg(F.lit(1).alias("one"))
    owners = held.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repositories"))
    counted = owners.groupBy("value").agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("repositories").alias("n_repositories")
    )
    once = spans.select("key", "kind", "start", "stop", "value", "random").distinct()
    verdict = (
        F.when(F.col("n_owners") >= widely, "example").when(F.col("random"), "live").otherwise("weak")
    )
    return once.join(counted, "value").withColumn("verdict", verdict)


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    """The secrets of every document and how many of them are live or copied examples."""
    found = scan(common.read_table(spark, sf_dir, "documents"))
    counts = judged(found).groupBy("key").agg(
        F.count_if(F.col("verdict") == "live").alias("n_live"),
        F.count_if(F.col("verdict") == "example").alias("n_example"),
        F.max("n_owners").alias("most_owners"),
    )
    rows = found.join(counts, "key", "left")
    zero = F.lit(0).cast("long")
    return rows.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        "base_sha256",
        "spans",
        *[F.coalesce(c, zero).alias(c) for c in ("n_live", "n_example", "most_owners")],
    )


def redacted(docs: DataFrame, mark: str = "<secret>", widely: int = WIDELY) -> DataFrame:
    """Documents with every span of a live credential replaced and n_chars counted anew; all rows
    and columns stay. Overlapping spans are replaced as one."""
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    live = judged(scan(docs), widely).where("verdict = 'live'")
    spans = F.array_sort(F.collect_list(F.struct("start", "stop")))
    live = common.small_side(common.stored(live.groupBy("key").agg(spans.alias("live_spans"))))
    # what is kept: before the first span, between spans, after the last
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def cut(done, span):
        kept = F.substr("text", done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        said = F.when(span["start"] >= done["at"], F.concat(kept, F.lit(mark))).otherwise("")
        return F.struct(
            F.greatest(done["at"], span["stop"]).alias("at"), F.concat(done["out"], said).alias("out")
        )

    def rest(done):
        return F.concat(done["out"], F.substr("text", done["at"] + 1))

    names = docs.columns
    rows = docs.withColumn("redact_key", key).join(
        live.withColumnRenamed("key", "redact_key"), "redact_key", "left"
    )
    text = F.when(F.col("live_spans").isNull(), F.col("text")).otherwise(
        F.aggregate("live_spans", start, cut, rest)
    )
    rows = rows.withColumn("text", text)
    if "n_chars" in names:
        n_chars = F.when(F.col("live_spans").isNull(), F.col("n_chars")).otherwise(F.char_length("text"))
        rows = rows.withColumn("n_chars", n_chars.cast("long"))
    return rows.select(*names)
