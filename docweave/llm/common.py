"""Shared helpers: session set-up, durable tables, hashing and blob codecs."""

from __future__ import annotations

import ctypes
import functools
import uuid

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

#: A word is a run of anything but ASCII white space (what ``bytes.split`` splits on).
WORD = r"[^\x20\x09-\x0D]+"
U64 = np.uint64
MASK = (1 << 64) - 1


#: Bytes of rows that go to a Python worker at once, where the session says nothing else:
#: both sides hold whole batches beside the heap, and Spark's 64 MB are for one task alone.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def ready(spark: SparkSession) -> SparkSession:
    """Python workers can import the package and get small batches; lineage cuts have
    a shared folder."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    return spark


def packed(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Python workers can import the package."""
    ready(df.sparkSession)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: lineage is
    cut, and what was computed once is never computed differently again."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def total_bytes(docs: DataFrame, col: str) -> int:
    """UTF-8 bytes of a text column over all rows (one aggregated number)."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(col)), F.lit(0))).head()[0]


def chunked(docs: DataFrame, n_chunks: int, *keys: str) -> DataFrame:
    """Deal rows to ``n_chunks`` groups by value, so that every evaluation of the
    plan (and every retry) forms the same groups."""
    return docs.withColumn("chunk", F.pmod(F.xxhash64(*keys), F.lit(n_chunks)))


def ceil_div(a: int, b: int) -> int:
    return max(1, -(-a // b))


# -- memory of Python workers --------------------------------------------------

@functools.lru_cache(maxsize=1)
def _trim():
    """glibc's malloc_trim; elsewhere nothing."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)


def give_back() -> None:
    """Return freed memory to the system: a worker outlives its task, and what it
    keeps counts for the executor beside the workers of other tasks."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def _thrifty(run, tables: tuple, key, least: int = 1 << 20):
    out = run(key, *tables)
    if sum(t.nbytes for t in tables) >= least:         # small groups leave little behind
        give_back()
    return out


def thrifty(run):
    """``run`` of a group, without what it leaves in the worker."""
    return lambda key, tbl: _thrifty(run, (tbl,), key)


def thrifty_pair(run):
    """``thrifty`` for two groups of one key."""
    return lambda key, one, two: _thrifty(run, (one, two), key)


def thrifty_batches(run):
    """``thrifty`` for a whole partition of batches."""
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return tidied


# -- hashing -------------------------------------------------------------------

def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit finalizer (a bijection), vectorised."""
    x = x + U64((0x9E3779B97F4A7C15 * (2 * salt + 1)) & MASK)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_STEP = 0xD6E8FEB86659FD93
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Words of more bytes are hashed one by one.
_LONG_WORD = 64


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    p = np.full(max(n, 1), base & MASK, U64)
    p[0] = 1
    return np.cumprod(p, dtype=U64)


def _slice_hashes(a: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff((~_SPACE[a]).astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    size = end - start
    padded = np.concatenate((a, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(a),), "<u8", padded, strides=(1,))      # the eight bytes from every place on
    h = mix(size.astype(U64), seed + 11)
    live, k = np.flatnonzero(size <= _LONG_WORD), 0
    while len(live):                                                # eight bytes of every word at a time
        left = np.minimum(size[live] - k, 8)
        h[live] = mix(h[live] ^ (eight[start[live] + k] & (U64(MASK) >> (U64(64) - U64(8) * left.astype(U64)))), seed)
        k += 8
        live = live[size[live] > k]
    for i in np.flatnonzero(size > _LONG_WORD).tolist():
        h[i] = xxhash.xxh3_64_intdigest(a[start[i]:end[i]].tobytes(), seed)
    return h, start


def word_hashes(texts: list[bytes], slice_bytes: int = 1 << 20, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """One 64-bit hash per word of all texts in order (hashes of different seeds are
    independent), and each text's number of words.  Memory is bounded by the slice
    (texts are cut between words), whatever the length of a text."""
    a = np.frombuffer(b" ".join([*texts, b""]) if texts else b" ", np.uint8)
    edges = np.cumsum([0] + [len(t) + 1 for t in texts])
    hashes, before, at = [], np.zeros(len(edges), np.int64), 0
    while at < len(a):
        end = min(len(a), at + slice_bytes)
        while end < len(a):                        # go on to the next white space
            gap = np.flatnonzero(_SPACE[a[end:end + slice_bytes]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(a), end + slice_bytes)
        h, s = _slice_hashes(a[at:end], seed)
        hashes.append(h)
        before += np.searchsorted(s, edges - at)
        at = end
    return np.concatenate(hashes), np.diff(before)


def run_hashes(words: np.ndarray, size: int, block: int = 1 << 16) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes, ``block`` runs at a time."""
    n = len(words) - size + 1
    if n <= 0 or not size:
        return np.zeros(0, U64)
    block = max(block, size)
    up, down = powers(_STEP, min(len(words), block + size - 1)), powers(pow(_STEP, -1, 1 << 64), min(n, block))
    out = np.empty(n, U64)
    for a in range(0, n, block):
        mine = words[a:min(n, a + block) + size - 1]
        sums = np.concatenate((np.zeros(1, U64), np.cumsum(mine * up[:len(mine)], dtype=U64)))
        runs = sums[size:] - sums[:-size]
        out[a:a + block] = mix(runs * down[:len(runs)])
    return out


# -- blobs ---------------------------------------------------------------------

def pack_sorted(a: np.ndarray) -> bytes:
    """Sorted uint64 values as differences in byte planes (dense sets shrink to
    little more than their entropy)."""
    d = np.diff(a, prepend=U64(0)) if len(a) else a
    return pack(np.ascontiguousarray(d.astype("<u8").view(np.uint8).reshape(-1, 8).T))


def unpack_sorted(b: bytes) -> np.ndarray:
    planes = unpack(b, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=U64)


def pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def unpack(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)


def pack_bits(flags: np.ndarray) -> bytes:
    return pack(np.packbits(flags))


def unpack_bits(b: bytes, n: int) -> np.ndarray:
    return np.unpackbits(unpack(b, np.uint8), count=n).astype(bool)


def shards_of(values: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """Sorted uint64 values by their leading ``bits``: (shard, from, to)."""
    if not len(values):
        return []
    if bits == 0:
        return [(0, 0, len(values))]
    top = (values >> U64(64 - bits)).astype(np.int64)
    cut = np.flatnonzero(np.diff(top)) + 1
    lo = np.concatenate(([0], cut))
    return list(zip(top[lo].tolist(), lo.tolist(), [*cut.tolist(), len(values)]))
