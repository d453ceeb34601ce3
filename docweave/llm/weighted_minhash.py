"""Near-duplicate detection by consistent weighted sampling over TF-IDF shingles.

1. Document frequencies of all word shingles, over all documents: every chunk
   sends its distinct shingle hashes with counts as packed arrays, which are added
   up by hash range; the frequencies above one go back.  The hashes are as wide as
   the input needs for one shingle in 8,000 to share its count with another.
2. Improved consistent weighted sampling: ``bands * rows`` samples of a document
   from its weights tf * idf.  Two documents agree in a sample with a probability
   equal to their weighted Jaccard similarity.  A band is the hash of ``rows``
   samples; at similarity 0.8 a pair shares none of 16 bands of 4 with probability
   0.0002, at 0.85 0.000007.
3. Texts of equal words are one content from here on.  Contents that share a band
   are candidates; the components of candidates are verified whole: all pairs of a
   component by exact weighted Jaccard similarity.  Components beyond
   ``block_bytes`` are cut into blocks, each pair of blocks being a task of its own,
   that returns a spanning forest of its links.
   Their texts are found again through a bitmap of fixed size (false alarms only
   move more texts to the exact join behind it).
4. Classes are the components of verified links, named by their least doc_id.

Randomness of a shingle comes from one of 65,536 rows of a seeded table picked by
its hash; the sampled shingle itself is told by its full hash.

Edge cases: texts of fewer words than a shingle are one shingle; a text without
words (null, empty) is a class of its own and has no bands; repeated rows are
copies; rows with a null doc_id belong to classes like others (a class of only
such rows has a null name); other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (U64, ceil_div, chunked, durable, mix, pack, pack_bits, pack_sorted, packed, run_hashes, shards_of,
                     thrifty, thrifty_batches, thrifty_pair, total_bytes, unpack, unpack_bits, unpack_sorted, word_hashes)
from .components import components
from .sketch_dedup import _encoded, _table


class Shingles:
    """Per document of a chunk: sorted distinct shingle hashes and their counts."""

    def __init__(self, texts: list[bytes], size: int):
        words, counts = word_hashes(texts)
        ends = np.cumsum(counts)
        self.words, self.ends, self.counts = words, ends, counts
        runs = run_hashes(words, size)
        h, tf = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
        for end, n in zip(ends.tolist(), counts.tolist()):
            if n >= size:
                mine = runs[end - n:end - size + 1]
            else:                                       # short: one shingle of all words
                mine = run_hashes(words[end - n:end], n) if n else words[:0]
            one, times = np.unique(mine, return_counts=True)
            h.append(one)
            tf.append(times)
        self.cut = np.cumsum([0] + [len(x) for x in h[1:]])
        self.h, self.tf = np.concatenate(h), np.concatenate(tf)

    def content(self, d: int) -> bytes:
        """128 bits that tell the word sequence of a document."""
        w = self.words[self.ends[d] - self.counts[d]:self.ends[d]]
        one, two = run_hashes(w, len(w)), run_hashes(mix(w, 77), len(w))
        return (one.tobytes() + two.tobytes()) if len(w) else b""


COUNTS = "shard int, chunk long, h binary, n binary"
FREQUENT = "chunk long, shard int, bits binary, df binary"


def _open(tbl: pa.Table) -> list[bytes]:
    d = zstandard.ZstdDecompressor()
    return [d.decompress(z) for z in tbl.column("z").to_pylist()]


def _short(h: np.ndarray, free: int) -> np.ndarray:
    return h >> U64(free) << U64(free)


def count_chunk(size: int, free: int, bits: int):
    def run(key, tbl):
        h, n = np.unique(_short(Shingles(_open(tbl), size).h, free), return_counts=True)
        return _table(COUNTS, [(s, key[0].as_py(), pack_sorted(h[a:b] >> U64(free)), pack(n[a:b].astype(np.uint32)))
                               for s, a, b in shards_of(h, bits)])
    return run


def merge_counts(key, tbl):
    parts = [unpack_sorted(b) for b in tbl.column("h").to_pylist()]
    n = np.concatenate([unpack(b, np.uint32) for b in tbl.column("n").to_pylist()])
    _, group = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(group, n).astype(np.int64)[group]
    out, a = [], 0
    for c, p in zip(tbl.column("chunk").to_pylist(), parts):
        df = total[a:a + len(p)]
        a += len(p)
        out.append((c, key[0].as_py(), pack_bits(df > 1), pack(df[df > 1])))
    return _table(FREQUENT, out)


def frequencies(h: np.ndarray, free: int, bits: int, told: pa.Table) -> np.ndarray:
    """Document frequency of each of a chunk's shingles (of all its documents)."""
    distinct, inverse = np.unique(_short(h, free), return_inverse=True)
    df = np.ones(len(distinct), np.int64)
    by = {s: (b, d) for s, b, d in zip(*(told.column(c).to_pylist() for c in ("shard", "bits", "df")))}
    for s, a, b in shards_of(distinct, bits):
        flags = unpack_bits(by[s][0], b - a)
        if flags.any():
            df[a:b][flags] = unpack(by[s][1], np.int64)
    return df[inverse]


def idf(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.log((n_docs + 1) / df)


@functools.lru_cache(maxsize=2)
def _tables(samples: int, seed: int):
    rng = np.random.default_rng(seed)
    shape = (1 << 16, samples)
    r, c = rng.gamma(2, 1, shape).astype(np.float32), rng.gamma(2, 1, shape).astype(np.float32)
    return r, rng.random(shape, np.float32), np.log(c) - r


def icws(h: np.ndarray, weight: np.ndarray, samples: int, seed: int = 1) -> np.ndarray:
    """Improved consistent weighted sampling of one document: a hash per sample that
    tells the sampled shingle and its quantised weight."""
    rs, beta, base = _tables(samples, seed)
    log_w = np.log(weight).astype(np.float32)[:, None]
    best = pick_t = pick_h = None
    for a in range(0, len(h), 4096):                 # bounded memory on long texts
        row = (mix(h[a:a + 4096], 21) >> U64(48)).astype(np.int64)
        r, b = rs[row], beta[row]
        t = np.floor(log_w[a:a + 4096] * (1 / r) + b)
        cost = base[row] - r * (t - b)
        i = np.argmin(cost, axis=0)
        j = np.arange(samples)
        low, found_t, found_h = cost[i, j], t[i, j], h[a:a + 4096][i]
        if best is None:
            best, pick_t, pick_h = low, found_t, found_h
        else:
            better = low < best
            best, pick_t, pick_h = (np.where(better, x, y) for x, y in ((low, best), (found_t, pick_t), (found_h, pick_h)))
    return mix(pick_h ^ mix(pick_t.astype(np.int64).view(U64), 5), 9)


SIGNED = "doc_id {id}, text_key long, content binary, df binary, bands array<long>"


def sign_chunk(size: int, free: int, bits: int, n_docs: int, bands: int, rows: int, seed: int):
    place = mix(np.arange(bands, dtype=U64), 31)

    def run(key, docs, told):
        s = Shingles(_open(docs), size)
        df = frequencies(s.h, free, bits, told)
        weight = s.tf * idf(df, n_docs)
        contents, out, made = [], [], {}
        for d in range(docs.num_rows):
            a, b = s.cut[d], s.cut[d + 1]
            c = s.content(d)
            contents.append(c)
            if a == b:
                out.append(None)
                continue
            if c not in made:
                sample = icws(s.h[a:b], weight[a:b], bands * rows, seed).reshape(bands, rows)
                band = place.copy()
                for j in range(rows):
                    band = mix(band ^ sample[:, j], 41)
                made[c] = pack(df[a:b]), band.view(np.int64)
            out.append(made[c])
        return pa.table({"doc_id": docs.column("doc_id"), "text_key": docs.column("text_key"),
                         "content": pa.array(contents, pa.binary()),
                         "df": pa.array([None if x is None else x[0] for x in out], pa.binary()),
                         "bands": pa.array([None if x is None else x[1] for x in out], pa.list_(pa.int64()))})
    return run


VECTOR = "label binary, content binary, h binary, tf binary, df binary, size long"


#: Text whose vectors are made at once (a longer text alone).
VECTOR_BYTES = 2 << 20


def _pieces(batches):
    """Batches of documents in pieces of bounded text."""
    for batch in batches:
        a, held = 0, 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()):
            if i > a and held + n > VECTOR_BYTES:
                yield batch.slice(a, i - a)
                a, held = i, 0
            held += n
        yield batch.slice(a)


def _vectors(size: int):
    def run(batches):
        for batch in _pieces(batches):
            s = Shingles(_encoded(batch), size)
            h = [pack_sorted(s.h[a:b]) for a, b in zip(s.cut, s.cut[1:])]
            tf = [pack(s.tf[a:b].astype(np.uint32)) for a, b in zip(s.cut, s.cut[1:])]
            length = [len(x) + len(y) + len(z) for x, y, z in zip(h, tf, batch.column("df").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("content"), pa.array(h, pa.binary()), pa.array(tf, pa.binary()),
                 batch.column("df"), pa.array(length, pa.int64())], ["label", "content", "h", "tf", "df", "size"])
    return run


def _squeeze(batches):
    """Texts as compressed bytes: what moves in the shuffle."""
    c = zstandard.ZstdCompressor(level=1)
    for batch in _pieces(batches):
        z = [c.compress(t) for t in _encoded(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), batch.column("chunk"), pa.array(z, pa.binary())],
                                         ["doc_id", "text_key", "chunk", "z"])


def among(df: DataFrame, keys: DataFrame, key: str, log_bits: int = 26, without: bool = False) -> DataFrame:
    """Rows of ``df`` whose long ``key`` may be among ``keys`` (``without``: surely is
    not): a test against a bitmap of 2**log_bits bits, whatever the number of keys."""
    place = F.shiftrightunsigned(F.col(key), 64 - log_bits) + 1      # Spark numbers places from 1
    maps = keys.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("n")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("map"))
    maps = maps.select(F.col("n").alias("_map_n"), F.col("map").alias("_map"))      # 4 KB a row, 2**(log_bits - 15) rows at most
    at = F.bitmap_bit_position(place).cast("int")
    byte = F.conv(F.hex(F.substring("_map", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8))) == 1, F.lit(False))
    met = df.join(F.broadcast(maps), F.bitmap_bucket_number(place) == F.col("_map_n"), "left")
    return met.where(~held if without else held).select(*(F.col(f"`{c}`") for c in df.columns))


def similar(h: list[np.ndarray], tf: list[np.ndarray], weight: list[np.ndarray], least: float, slab: int = 1024,
            left: int | None = None):
    """All pairs with weighted Jaccard similarity >= least, as a boolean matrix; with
    ``left``, only those of one of the first ``left`` texts and one of the others.
    A shingle of tf k counts as k features of its weight, so that the sum of minima
    is a product of 0/1 matrices; only features that two texts share are looked at."""
    n = len(h)
    total = np.array([float((t * w).sum()) for t, w in zip(tf, weight)])
    doc = np.repeat(np.arange(n), [int(t.sum()) for t in tf])
    feature = np.concatenate([mix(np.repeat(x, t) ^ mix((np.arange(int(t.sum())) - np.repeat(np.cumsum(t) - t, t)).astype(U64), 3), 7)
                              for x, t in zip(h, tf)])
    value = np.concatenate([np.repeat(w, t) for w, t in zip(weight, tf)])
    _, at, col, counts = np.unique(feature, return_index=True, return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    live = shared[col]
    doc, col, value = doc[live], number[col[live]], value[live]
    order = np.argsort(col, kind="stable")
    doc, col, value = doc[order], col[order], value[order]
    rows, first = (n, 0) if left is None else (left, left)      # columns from ``first`` on
    inter = np.zeros((rows, n - first))
    for a in range(0, int(shared.sum()), slab):
        i, j = np.searchsorted(col, (a, a + slab))
        x = np.zeros((n, slab))
        x[doc[i:j], col[i:j] - a] = np.sqrt(value[i:j])
        for k in range(0, rows, 256):                      # products of all pairs would be one more matrix
            inter[k:k + 256] += x[k:min(k + 256, rows)] @ x[first:].T
    out = np.empty(inter.shape, bool)
    for a in range(0, rows, 256):                          # no further matrices of all pairs
        mine, part = total[a:min(a + 256, rows), None], inter[a:a + 256]
        out[a:a + 256] = part >= least * (mine + total[None, first:] - part) - 1e-9 * mine
    return out


def blocks_of(vectors: DataFrame, block_bytes: int, block_rows: int) -> DataFrame:
    """``label, blocks``: into how many blocks a component goes, so that neither the
    bytes of a block nor its rows (matrices are rows x rows) grow with the component."""
    by_bytes, by_rows = F.ceil(F.sum("size") / block_bytes), F.ceil(F.count("*") / block_rows)
    return vectors.groupBy("label").agg(F.greatest(by_bytes, by_rows).cast("int").alias("blocks"))


LINKS = "a binary, b binary"


def link_block(n_docs: int, least: float):
    def run(key, tbl):
        tbl = tbl.sort_by([("mine", "ascending"), ("content", "ascending")])
        # of two blocks only what links them; each block has a task of its own for the rest
        i, j = key[1].as_py(), key[2].as_py()
        left = None if i == j else pc.sum(pc.equal(tbl.column("mine"), i)).as_py()
        h = [unpack_sorted(b) for b in tbl.column("h").to_pylist()]
        tf = [unpack(b, np.uint32).astype(np.int64) for b in tbl.column("tf").to_pylist()]
        weight = [idf(unpack(b, np.int64), n_docs) for b in tbl.column("df").to_pylist()]
        linked = similar(h, tf, weight, least, left=left)
        names, free, out = tbl.column("content").to_pylist(), np.ones(len(h), bool), []
        for root in range(len(h)):                     # a spanning tree of each class of the block
            if not free[root]:
                continue
            free[root], front = False, [root]
            while front:
                new = []
                for a in front:
                    if left is None:
                        met = np.flatnonzero(linked[a] & free)
                    elif a < left:
                        met = np.flatnonzero(linked[a] & free[left:]) + left
                    else:
                        met = np.flatnonzero(linked[:, a - left] & free[:left])
                    for b in met.tolist():
                        free[b] = False
                        out.append((names[a], names[b]))
                        new.append(b)
                front = new
        cols = list(zip(*out)) if out else [()] * 2
        return pa.table({"a": pa.array(cols[0], pa.binary()), "b": pa.array(cols[1], pa.binary())})
    return run


def near_duplicates(docs: DataFrame, least: float = 0.8, shingle: int = 5, bands: int = 16, rows: int = 4, seed: int = 1,
                    chunk_bytes: int = 8 << 20, shard_words: int = 1 << 21, block_bytes: int = 2 << 20, block_rows: int = 2000) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, text_key, class_id, n_class, is_first``: the
    least doc_id of the class, its number of rows, and whether this is its first row.  ``text_key`` (xxhash64 of the text)
    tells rows of one doc_id apart."""
    docs = packed(docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")))
    size, n_docs = total_bytes(docs, "text"), docs.count()
    words = max(1, size // 5)
    bits = (ceil_div(words, shard_words) - 1).bit_length()
    free = 64 - min(64, max(44, words.bit_length() + 13))
    kind = docs.schema["doc_id"].dataType.simpleString()
    dealt = chunked(docs, ceil_div(size, chunk_bytes), "doc_id", "text").mapInArrow(
        thrifty_batches(_squeeze), f"doc_id {kind}, text_key long, chunk long, z binary").repartition("chunk")
    by_chunk = dealt.groupBy("chunk")
    told = by_chunk.applyInArrow(thrifty(count_chunk(shingle, free, bits)), COUNTS).groupBy("shard").applyInArrow(thrifty(merge_counts), FREQUENT)
    signed = durable(by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(
        thrifty_pair(sign_chunk(shingle, free, bits, n_docs, bands, rows, seed)), SIGNED.format(id=kind)))

    # contents that share a band
    contents = signed.where("bands is not null").groupBy("content").agg(F.first("bands").alias("bands"))
    banded = contents.select("content", F.explode("bands").alias("band"))
    heads = banded.groupBy("band").agg(F.min("content").alias("head"), F.max("content").alias("tail")).where("head < tail")
    candidates = components(banded.join(heads, "band").where("content <> head").select(
        F.col("content").alias("a"), F.col("head").alias("b")))

    # their vectors, from one text of each content
    homes = durable(signed.join(candidates.withColumnRenamed("node", "content"), "content").groupBy("content", "label").agg(
        F.min(F.struct("text_key", "doc_id", "df")).alias("home")).select("content", "label", "home.*"))
    texts = among(docs, homes, "text_key").dropDuplicates(["doc_id", "text_key"])
    asked = homes.withColumnRenamed("doc_id", "id").withColumnRenamed("text_key", "key")
    found = texts.join(asked, (F.col("key") == F.col("text_key")) & F.col("id").eqNullSafe(F.col("doc_id")))
    vectors = durable(found.select("label", "content", "text", "df").mapInArrow(thrifty_batches(_vectors(shingle)), VECTOR))

    # verification, a pair of blocks of a component at a time
    sized = blocks_of(vectors, block_bytes, block_rows)
    mine = F.pmod(F.xxhash64("content"), F.col("blocks")).cast("int")
    pairs = (vectors.join(sized, "label").withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other")))
    links = pairs.select("label", "i", "j", "mine", "content", "h", "tf", "df").groupBy("label", "i", "j").applyInArrow(
        thrifty(link_block(n_docs, least)), LINKS)
    classes = components(links)

    named = signed.join(classes.withColumnRenamed("node", "content"), "content", "left").withColumn(
        "label", F.when(F.col("content") != F.lit(b""), F.coalesce("label", "content")))
    first = F.min(F.struct("doc_id", "text_key"))
    # written, so that the join deals both sides itself and can split a large class
    totals = durable(named.where("label is not null").groupBy("label").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("n_class"), first.alias("first")))
    alone = named.where("label is null").select("doc_id", "text_key", F.col("doc_id").alias("class_id"),
                                                F.lit(1).cast("long").alias("n_class"), F.lit(True).alias("is_first"))
    first_here = F.col("first").eqNullSafe(F.struct("doc_id", "text_key"))
    return named.where("label is not null").join(totals, "label").select(
        "doc_id", "text_key", "class_id", "n_class", first_here.alias("is_first")).unionByName(alone)


def keep_firsts(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay when each class keeps its first row.  Only rows
    that may be in question (by a bitmap of fixed size) meet the classes in a join."""
    contested = durable(classes.groupBy("doc_id", "text_key").agg(F.count("*").alias("copies"), F.max("is_first").alias("is_first"))
                        .where("copies > 1 or not is_first"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.xxhash64("text").alias("text_key"))
    maybe = among(rows, contested, "text_key")
    theirs = contested.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "copies", "is_first")
    met = maybe.join(theirs, (F.col("key") == F.col("text_key")) & F.col("id").eqNullSafe(F.col("row.doc_id")), "left")
    stay = met.where("key is null or (is_first and copies = 1)").select("row.*")
    one = met.where("is_first and copies > 1").dropDuplicates(["id", "text_key"]).select("row.*")
    return among(rows, contested, "text_key", without=True).select("row.*").unionByName(stay).unionByName(one)
