"""Near-duplicate grouping by SuperMinHash.

1. Signatures. The shingles of a document offer values to the slots of its signature in rounds: in
   round j every shingle offers j plus a fraction of its own to the j-th slot of its own permutation,
   so one shingle's ranks are correlated and no slot is empty for long. Rounds stop as soon as no slot
   of the document can still improve; long documents need one or two. Eight bits of each slot are kept.
2. Equal sets are one class, named by its smallest doc_id; copies count once from here on.
3. Banding. Classes that agree in all slots of a band share a bucket. 32 bands of 5 slots miss a pair
   of similarity 0.8 with a chance of 3e-6.
4. Verification on full sets, exact to the last shingle, in two steps. Two sets are compared in the
   first band that they share only, and only if their signatures agree in as many slots as all but
   1 in 10 million pairs of that similarity do.
   a. Every member of a bucket against its smallest id; in buckets of up to ALL members, all against
      all; in larger ones, each against its FEW most similar by signature, in chunks of CHUNK.
   b. In larger buckets that still hold several components (by union-find, see components), all
      members against all that are not of the bucket's largest component. Their texts meet in a grid
      of chunks, in which only verified links become rows.
   So what is moved grows with the members of a bucket, not with their pairs, and no link is left out.
5. Components of components. The smallest doc_id of each stays.

Texts travel compressed, and shingles are made where they are compared: text is a third of the size
of the hashes of its shingles.

Defined results: null text, or one without words, has an empty set: it is linked with nothing and
kept. With fewer words than a shingle has, all words are one shingle. Rows that repeat a doc_id are
classed each by its own text; classes named by one doc_id are one node. Rows with a null doc_id join
the class of their text, are not kept if it has an id, and connect nothing. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qcmart.llm import common
from qcmart.llm.components import components

BANDS, ROWS = 32, 5
SLOTS = BANDS * ROWS
SEED = 7
EMPTY = np.uint32(0xFFFFFFFF)
STEP = 0xD6E8FEB86659FD93
#: Members of a bucket that are all compared, partners that a member of a larger one proposes, and members
#: in a chunk of a bucket.
ALL, FEW, CHUNK = 16, 2, 1_000
#: Members compared with one hub in one task, and shingles in a chunk of texts (8 MB of hashes).
AROUND_HUB, CHUNK_SHINGLES = 500, 1 << 20
#: Standard deviations below the expected number of equal slots at which a pair is still compared.
DEVIATIONS = 5.4

SIGNED = "doc_id long, n_shingles long, digest binary, sig binary, packed binary"
PAIRS = "u long, v long"


def shingle_sets(texts: list[bytes], width: int, hashes: common.WordHashes) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of each text."""
    out = []
    for text in texts:
        words = text.lower().split()
        found = hashes.of(words)
        out.append(np.unique(common.gram_hashes(found, min(width, len(words)) or width)))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The SuperMinHash signature of each set, as 8 bits of round and 24 of fraction.

    The permutation of a shingle is drawn as far as it is used: round j swaps its place j with one
    of those from j on (Fisher-Yates). Sets that need a second round are short, so the drawn places
    of their shingles are few.
    """
    lengths = np.array([len(s) for s in sets], np.int64)
    element = np.concatenate([*sets, np.empty(0, np.uint64)])
    doc = np.repeat(np.arange(len(sets)), lengths)
    best = np.full((len(sets), SLOTS), EMPTY, np.uint32)
    flat, places = best.reshape(-1), None
    for j in range(SLOTS):
        if not len(element):
            break
        drawn = common.mixed(element + np.uint64((j + 1) * STEP % 2**64))
        fraction = drawn >> np.uint64(40)
        with_ = j + ((drawn & np.uint64(0xFFFFFFFF)) % np.uint64(SLOTS - j)).astype(np.int64)
        slot = with_
        if places is not None:
            each = np.arange(len(element))
            slot = places[each, with_].astype(np.int64)
            places[each, with_] = places[:, j]
        offer = (np.uint64(j << 24) | fraction).astype(np.uint32)
        np.minimum.at(flat, doc * SLOTS + slot, offer)
        open_ = (best.max(axis=1) > ((j + 1) << 24))[doc]
        if places is None:
            element, doc, with_ = element[open_], doc[open_], with_[open_]
            places = np.tile(np.arange(SLOTS, dtype=np.uint8), (len(element), 1))
            places[np.arange(len(element)), with_] = 0
        elif not open_.all():
            element, doc, places = element[open_], doc[open_], places[open_]
    return best


def least_equal(percent: int) -> int:
    """Equal slots that two sets of this similarity have but for chances of about 1e-7."""
    s = percent / 100
    return max(0, math.floor(SLOTS * s - DEVIATIONS * math.sqrt(SLOTS * s * (1 - s))))


def digest_of(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def sign(docs: DataFrame, width: int, keep: str = "") -> DataFrame:
    """doc_id, n_shingles, digest, signature and packed text of every document; the last three null for an
    empty set. keep: more columns to keep (a DDL list)."""
    names = common.schema_of(keep).names if keep else []

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, pack = common.WordHashes(), zstandard.ZstdCompressor(level=1)
        # permutations take SLOTS bytes a shingle
        for batch in common.batches(rows, 50_000):
            texts = list(common.texts(batch.column("text")))
            sets = shingle_sets(texts, width, hashes)
            low = (signatures(sets) & np.uint32(0xFF)).astype(np.uint8)
            full = [len(s) > 0 for s in sets]
            yield pa.RecordBatch.from_pydict(
                {k: batch.column(k) for k in names}
                | {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "digest": pa.array([digest_of(s) if f else None for s, f in zip(sets, full, strict=True)], pa.binary()),
                    "sig": pa.array([x.tobytes() if f else None for x, f in zip(low, full, strict=True)], pa.binary()),
                    "packed": pa.array([pack.compress(t) if f else None for t, f in zip(texts, full, strict=True)], pa.binary()),
                }
            )

    return docs.mapInArrow(run, ", ".join([*([keep] if keep else []), SIGNED]))


def runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """The rows of each run of equal keys of sorted rows."""
    rest, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        edges = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            now = tuple(key[:, a].tolist())
            if rest and now != last:
                yield pa.Table.from_batches(rest)
                rest = []
            rest.append(batch.slice(a, b - a))
            last = now
    if rest:
        yield pa.Table.from_batches(rest)


def together(rows: DataFrame, *keys: str, then: str | None = None) -> DataFrame:
    """Rows of equal keys one after the other in one task, to be read by ``runs``."""
    return rows.repartition(*keys).sortWithinPartitions(*keys, *([then] if then else []))


def similar(size_u, size_v, both, percent: int):
    return 100 * both >= percent * (size_u + size_v - both)


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough. A v with many u is repeated for every AROUND_HUB."""
    many = common.stored(pairs.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / AROUND_HUB).cast("int").alias("chunks")))
    members = pairs.join(many, "v").select("v", F.pmod(F.xxhash64("u"), "chunks").cast("int").alias("chunk"), "u")
    hubs = many.select("v", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    hubs = hubs.withColumn("u", F.lit(None).cast("long"))
    rows = members.withColumn("id", F.col("u")).unionByName(hubs.withColumn("id", F.col("v")))
    rows = rows.join(texts.select("id", "packed"), "id").drop("id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, unpack = common.WordHashes(), zstandard.ZstdDecompressor()
        at, hubs = None, []
        for batch in batches:
            found = []
            for v, chunk, u, packed in zip(*[batch.column(k).to_pylist() for k in ("v", "chunk", "u", "packed")], strict=True):
                if (v, chunk) != at:
                    at, hubs = (v, chunk), []
                own = shingle_sets([unpack.decompress(packed)], width, hashes)[0]
                if u is None:
                    hubs.append(own)
                elif any(linked(own, hub, percent) for hub in hubs):
                    found.append((u, v))
            yield pa.RecordBatch.from_pydict(
                {"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())}
            )

    return together(rows, "v", "chunk", then="u").mapInArrow(run, PAIRS)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    return bool(similar(len(a), len(b), len(np.intersect1d(a, b, assume_unique=True)), percent))


class Members:
    """Members of a bucket with what decides, without their texts, whether two are compared here."""

    def __init__(self, table: pa.Table, percent: int) -> None:
        self.id, self.size, self.component = (table.column(k).to_numpy() for k in ("id", "size", "component"))
        sig = table.column("sig").combine_chunks()
        self.sig = np.frombuffer(b"".join(sig.to_pylist()), np.uint8).reshape(-1, SLOTS)
        self.band, self.percent, self.least = table.column("band")[0].as_py(), percent, least_equal(percent)

    def compared(self, sig: np.ndarray, size: int, component: int, among: slice) -> tuple[np.ndarray, np.ndarray]:
        """Places of members to compare with one of this signature, and their numbers of equal slots."""
        near = 100 * np.minimum(self.size[among], size) >= self.percent * np.maximum(self.size[among], size)
        at = np.flatnonzero(near & (self.component[among] != component)) + (among.start or 0)
        equal = self.sig[at] == sig
        n = equal.sum(axis=1)
        at, equal, n = (x[n >= self.least] for x in (at, equal, n))
        first = equal.reshape(len(at), BANDS, ROWS).all(axis=2).argmax(axis=1) == self.band
        return at[first], n[first]


def proposals(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) of members of a bucket to compare, v its smallest id or one of the most similar by
    signature. rows: (bucket, band, n, pivot, id, size, sig)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "bucket", "chunk"):
            m, u, v = Members(table, percent), [], []
            most = len(m.id) if table.column("n")[0].as_py() <= ALL else FEW
            for k in range(len(m.id) - 1):
                at, n = m.compared(m.sig[k], m.size[k], m.id[k], slice(k + 1, None))
                for other in at[np.argsort(-n, kind="stable")[:most]]:
                    u.append(max(m.id[k], m.id[other]))
                    v.append(min(m.id[k], m.id[other]))
            yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    chunk = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / CHUNK)).cast("int")
    rows = rows.withColumns({"chunk": chunk, "component": F.col("id")})
    found = together(rows, "bucket", "chunk", then="id").mapInArrow(run, PAIRS)
    pivots = rows.where(F.col("n") > ALL).groupBy(F.col("id").alias("u")).agg(F.min("pivot").alias("v"))
    return found.unionByName(pivots.where("u <> v")).distinct()


def in_grids(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (u, v) between different components of a bucket, a link for each member outside the largest
    component and each component it is linked with in a chunk. rows: (bucket, band, n, id, component, size, sig,
    packed)."""

    def parts(size: Column) -> Column:
        return F.ceil(size / CHUNK_SHINGLES).cast("int")

    sums = rows.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    sums = sums.groupBy("bucket").agg(
        F.max(F.struct("n", "component", "size")).alias("top"), F.sum("size").alias("size")
    )
    grid = common.stored(
        sums.select(
            "bucket", F.col("top.component").alias("top"), parts(F.col("size")).alias("across"),
            parts(F.col("size") - F.col("top.size")).alias("down"),
        )
    )
    rows = rows.join(grid, "bucket")
    column, line = F.pmod(F.xxhash64("id"), "across"), F.pmod(F.xxhash64("id", F.lit(1)), "down")
    members = rows.select(
        "*", column.cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("down") - 1)).alias("j"), F.lit(False).alias("guest")
    )
    guests = rows.where("component <> top").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("across") - 1)).alias("i"), line.cast("int").alias("j"), F.lit(True).alias("guest")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, unpack = common.WordHashes(), zstandard.ZstdDecompressor()
        for table in runs(batches, "bucket", "i", "j"):
            guest = table.column("guest").to_numpy()
            if guest.all() or not guest.any():
                continue
            found = _met(table.filter(pa.array(~guest)), table.filter(pa.array(guest)), width, percent, hashes, unpack)
            yield pa.RecordBatch.from_pydict(
                {"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())}
            )

    rows = members.unionByName(guests).drop("n", "top", "across", "down")
    return together(rows, "bucket", "i", "j", then="id").mapInArrow(run, PAIRS).distinct()


def _met(members: pa.Table, guests: pa.Table, width: int, percent: int, hashes, unpack) -> list[tuple[int, int]]:
    """A link (guest, member) for each guest and each component of members that it is linked with."""
    m, g = Members(members, percent), Members(guests, percent)
    wanted = [m.compared(g.sig[k], g.size[k], g.component[k], slice(None))[0] for k in range(len(g.id))]
    needed = np.unique(np.concatenate(wanted)) if wanted else np.zeros(0, np.int64)
    if not len(needed):
        return []

    def sets(table: pa.Table, at: np.ndarray) -> list[np.ndarray]:
        return shingle_sets([unpack.decompress(p) for p in table.column("packed").take(pa.array(at)).to_pylist()], width, hashes)

    own = sets(members, needed)
    shingle = np.concatenate(own)
    order = np.argsort(shingle, kind="stable")
    shingle, owner = shingle[order], np.repeat(needed, [len(s) for s in own])[order]
    asked = np.flatnonzero([len(w) > 0 for w in wanted])
    found = []
    for k, x in zip(asked, sets(guests, asked), strict=True):
        first, stop = np.searchsorted(shingle, x, "left"), np.searchsorted(shingle, x, "right")
        n = stop - first
        at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        both = np.bincount(owner[at], minlength=len(m.id))[wanted[k]]
        hit = wanted[k][similar(len(x), m.size[wanted[k]], both, percent)]
        for member in hit[np.unique(m.component[hit], return_index=True)[1]]:
            found.append((g.id[k], m.id[member]))
    return found


def _undecided(hits: DataFrame, groups: DataFrame) -> DataFrame:
    """The members of buckets that hold several components, with theirs."""
    rows = hits.join(groups, "id", "left")
    rows = common.stored(rows.withColumn("component", F.coalesce("component", "id")))
    split = rows.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"))
    return rows.join(common.stored(split.where("a <> b").select("bucket")), "bucket", "left_semi")


def grouped(classes: DataFrame, signed: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, component) of all classes (id, digest, size, sig) that are linked with another."""
    band = [
        F.struct(F.lit(b).alias("band"), F.xxhash64(F.lit(b), F.substring("sig", b * ROWS + 1, ROWS)).alias("bucket"))
        for b in range(BANDS)
    ]
    bands = classes.select("id", F.explode(F.array(*band)).alias("b")).select("id", "b.*")
    shared = bands.groupBy("bucket").agg(F.min("id").alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1")
    hits = common.stored(bands.join(common.stored(shared), "bucket"))
    members = common.stored(classes.join(hits.select("id").distinct(), "id", "left_semi"))
    # merged whatever the sizes, so that the rows moved are in proportion to the documents at any size
    texts = signed.select(F.col("doc_id").alias("id"), "digest", "packed").dropDuplicates(["id", "digest"])
    texts = common.stored(texts.join(members.hint("merge"), ["id", "digest"]).select("id", "size", "sig", "packed"))

    pairs = common.stored(proposals(hits.join(texts.drop("packed"), "id"), percent))
    # stored first: two steps of Python in one stage would need two workers a task
    groups = common.stored(components(common.stored(verified(pairs, texts, width, percent))))
    # in smaller buckets all have been compared
    large = _undecided(hits.where(F.col("n") > ALL).drop("pivot"), groups)
    found = common.stored(in_grids(large.join(texts, "id"), width, percent))
    named = groups.withColumnRenamed("component", "as")
    joined = found
    for end in ("u", "v"):
        joined = joined.join(named.withColumnRenamed("id", end), end, "left")
        joined = joined.withColumn(end, F.coalesce("as", end)).drop("as")
    joined = components(joined.where("u <> v")).select(F.col("id").alias("component"), F.col("component").alias("last"))
    alone = joined.select(F.col("component").alias("id"), "component", "last").join(groups.select("id"), "id", "left_anti")
    groups = groups.join(joined, "component", "left").select("id", F.coalesce("last", "component").alias("component"))
    return groups.unionByName(alone.select("id", F.col("last").alias("component")))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, keep: str = "") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row, after the columns to keep (a DDL list)."""
    kept = {f.name: f.dataType.simpleString() for f in common.schema_of(keep)} if keep else {}
    docs = common.clean_columns(docs, kept | {"doc_id": "long", "text": "string"})
    signed = common.stored(sign(docs, width, keep))
    full = signed.where("digest is not null")
    classes = common.stored(
        full.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("size"), F.first("sig").alias("sig"))
    )
    named = classes.where("id is not null")
    groups = grouped(named, full, width, percent)
    names = classes.select("digest", "id").join(groups, "id", "left")
    names = common.stored(names.select("digest", F.coalesce("component", "id").alias("component_id")))
    rows = signed.select(*kept, "doc_id", "n_shingles", "digest").join(names, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select(
        *kept, "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def op10_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """The group of near copies of every document, by 4-word shingles."""
    return near_duplicates(common.read_table(spark, sf_dir, "documents"), width=4)


ORACLE = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles
  FROM w
), c AS (SELECT doc_id, len(shingles) AS n, md5(array_to_string(list_sort(shingles), chr(10))) AS digest, shingles FROM s),
k AS (SELECT digest, min(doc_id) AS id, any_value(n) AS n, any_value(shingles) AS shingles FROM c WHERE n > 0 GROUP BY digest),
p AS (SELECT id, n, unnest(shingles) AS shingle FROM k),
f AS (SELECT shingle FROM p GROUP BY shingle HAVING count(*) > 1),
q AS (SELECT p.* FROM p JOIN f USING (shingle)),
l AS (
  SELECT a.id AS u, b.id AS v FROM q a JOIN q b ON a.shingle = b.shingle AND a.id <> b.id
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), r AS (
  WITH RECURSIVE r(id, component) AS (
    SELECT id, id FROM k UNION SELECT l.v, r.component FROM r JOIN l ON l.u = r.id
  ) SELECT id, min(component) AS component FROM r GROUP BY id
)
SELECT c.doc_id, c.n::BIGINT AS n_shingles, coalesce(r.component, c.doc_id) AS component_id,
       coalesce(r.component, c.doc_id) = c.doc_id AS kept
FROM c LEFT JOIN k ON c.digest = k.digest AND c.n > 0 LEFT JOIN r ON r.id = k.id
"""
