"""What the corpus operators share: the shared folder, written tables, id remainders, Arrow text helpers."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One word: no blank, tab, line feed, vertical tab, form feed or carriage return in it.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; where none is named, a local session gets a temporary one and any other an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder: executors and driver need a shared one for written tables")
        named = tempfile.mkdtemp(prefix="marlstone-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def written(df: DataFrame, what: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it again: lineage ends there, and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/marlstone-{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["written_at"] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that no later plan reads."""
    for t in tables:
        path = t.__dict__.get("written_at")
        if path:
            spark = t.sparkSession
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, size: int):
    """While it lasts, Spark hands Python batches of about `size` bytes; then as before. For plans that run inside it, on rows that are large."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def remainder(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, mod k; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % k


def text_of(c: str = "text") -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(batches, max_bytes: int = 1 << 20, column: str = "text"):
    """Cuts Arrow batches so that the texts of each piece come to about max_bytes; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(size) - size) // max_bytes
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


#: Per byte: a random 64-bit value, the same for A-Z and a-z, and 0 for white space.
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BYTE[_SPACE] = 0
_STEP = 0x5851F42D4C957F2D
_powers: dict[int, np.ndarray] = {}


def _power(step: int, n: int) -> np.ndarray:
    """step**0, step**1, ... mod 2**64, n of them at least."""
    have = _powers.get(step)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 21), step, np.uint64)
        have[0] = 1
        _powers[step] = have = np.multiply.accumulate(have)
    return have


class Words:
    """The words of a piece of texts: counts (of each text), starts (in data), hashes (64 bits, A-Z lower-cased), data (all bytes), offsets. space: per byte, whether it parts words."""

    def __init__(self, texts: pa.Array, space: np.ndarray = _SPACE):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
        self.data, self.offsets = data, offsets - offsets[0]
        solid = ~space[data]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        heads = self.offsets[:-1][self.offsets[:-1] < len(data)]
        first[heads] = solid[heads]
        self.starts = np.flatnonzero(first)
        self.solid = solid
        at = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(at)
        if len(self.starts):
            self._terms = np.where(space, np.uint64(0), _BYTE)[data] * _power(_STEP, len(data))[: len(data)]
            self.hashes = self._normal(np.add.reduceat(self._terms, self.starts), self.starts)
        else:
            self.hashes = np.zeros(0, np.uint64)

    def _normal(self, sums: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return mix64(sums * _power(pow(_STEP, -1, 1 << 64), len(self.data))[starts])

    def prefixes(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the first `size` bytes of the words with the given numbers, which have that many: as of a word of these bytes."""
        starts = self.starts[at]
        total = np.zeros(len(at), np.uint64)
        for j in range(size):
            total += self._terms[starts + j]
        return self._normal(total, starts)

    def lengths(self) -> np.ndarray:
        """Bytes of each word."""
        return np.add.reduceat(self.solid.view(np.uint8), self.starts, dtype=np.int64) if len(self.starts) else np.zeros(0, np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers (shifts and odd multipliers)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0x9E3779B97F4A7C15)
        x = x ^ (x >> np.uint64(29))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def shingle_hashes(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every run of k words that stays inside a document; shorter documents give their whole sequence once."""
    n, ends = len(hashes), np.cumsum(counts)
    starts = ends - counts
    doc = np.repeat(np.arange(len(counts)), counts)
    size = np.minimum(counts, k)[doc] if n else np.zeros(0, np.int64)
    first = np.arange(n) + size <= ends[doc] if n else np.zeros(0, bool)
    whole = (counts < k)[doc] if n else first
    first &= ~whole | (np.arange(n) == starts[doc]) if n else first
    acc = np.full(n, 0x243F6A8885A308D3, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            nxt = np.zeros(n, np.uint64)
            nxt[: n - j] = hashes[j:] if j else hashes
            acc = np.where(j < size, mix64(acc * np.uint64(0x100000001B3) ^ nxt), acc)
    return acc[first], doc[first]
