"""What the operators of this subpackage share: scratch tables, blocks of documents, hashes."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qcmart.operators.lineage import shared_folder

#: A row count up to which a side with short rows may be broadcast (16 to 64 MB).
BROADCAST_ROWS = 1_000_000

#: Words are runs of bytes outside \x20 and \x09-\x0D, which is what bytes.split() takes.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder name in the folder that driver and executors share."""
    return f"{shared_folder(spark)}/qcmart-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder and read from there: later reads
    neither compute them again nor depend on the executors that made them."""
    path = scratch(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table with a broadcast hint if it has at most so many rows; a larger one
    is left for a shuffle join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def blocks_of(docs: DataFrame, block_bytes: int) -> int:
    """How many blocks of about block_bytes of text the documents make."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, math.ceil(total / block_bytes))


def block_number(blocks: int) -> Column:
    """The block of a row, from its id and text, so that no id or text gathers all rows."""
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")


def dealt(df: DataFrame, parts: int, key: str) -> DataFrame:
    """Rows of a block together; the same exchange wherever the same rows are asked for."""
    return df.repartition(parts, key)


def texts(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    """UTF-8 of each text; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        for chunk in column.chunks:
            yield from texts(chunk)
        return
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


class WordHashes(dict):
    """64-bit hashes of words, each computed once while the table is small."""

    LIMIT = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of so many words, from hashes of the words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out *= _BASE
        out += words[k : k + n]
    return mixed(out)


def starts_within(lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For texts laid end to end: where the runs of so many words that stay within a text
    start, and the text of each."""
    counts = np.maximum(lengths - width + 1, 0)
    text = np.repeat(np.arange(len(lengths)), counts)
    first = np.cumsum(lengths) - lengths
    before = np.cumsum(counts) - counts
    return np.arange(counts.sum()) - before[text] + first[text], text


def batches(rows: Iterable[pa.RecordBatch], words: int = 400_000, text: str = "text"):
    """Slices of record batches with about so many words (at six bytes a word)."""
    for batch in rows:
        sizes = np.fromiter((len(x) for x in texts(batch.column(text))), np.int64, batch.num_rows)
        cut = (np.cumsum(sizes) // (6 * words)).astype(np.int64)
        edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
        del batch, sizes, cut
        pa.default_memory_pool().release_unused()  # or a worker keeps the most that it ever held


def added(df: DataFrame, width: int = 64) -> DataFrame:
    """Sums of equally long packed arrays of doubles (key string, part int, data binary) by key,
    in two steps, so that no task holds the arrays of all parts."""
    schema = "key string, part int, data binary"

    def total(table: pa.Table) -> pa.Table:
        out = 0
        for data in table.column("data"):
            out = out + np.frombuffer(data.as_py(), np.float64)
        return pa.table(
            {"key": table.column("key")[:1], "part": pa.array([0], pa.int32()), "data": pa.array([out.tobytes()], pa.binary())}
        )

    some = df.withColumn("part", F.pmod("part", F.lit(width)).cast("int"))
    some = some.groupBy("key", "part").applyInArrow(total, schema)
    return some.groupBy("key").applyInArrow(total, schema)


def clean_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Only the named columns, with the types they are expected in, whatever else is there."""
    return df.select(*[F.col(f"`{n}`").cast(t).alias(n) for n, t in names.items()])


def schema_of(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


def as_arrow(columns: dict[str, tuple[object, pa.DataType]]) -> pa.Table:
    return pa.table({k: pa.array(v, t) for k, (v, t) in columns.items()})
