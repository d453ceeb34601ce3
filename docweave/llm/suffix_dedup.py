"""Exact substring dedup over bytes by a range-partitioned sparse suffix array.

A byte goes when it lies in a string of ``size`` bytes that also starts anywhere
else.  Sorting every suffix would move the corpus ``size`` times over, so:

1. Every ``size``-byte string elects an anchor inside it: the place of its least
   ``GRAM``-byte hash (the leftmost, on ties).  Equal strings elect the same
   place, so only suffixes at anchors (about one in 90) need sorting.
2. Of a string, half lies right of its anchor or half left of it.  A string with
   at least ``size / 2`` bytes from its anchor on is looked at from the suffix that
   starts at the anchor, the others from the suffix ``size / 2`` bytes earlier; so
   equal strings start suffixes that share their leading bytes (``LEAD``), and
   suffixes whose leading bytes are unique are dropped (by packed 64-bit hashes of
   all chunks; a bit each goes back).
3. The other suffixes, with the bytes before them that their strings need, are
   range-partitioned by their leading bytes at sampled splitters, sorted in their
   bucket by multikey quicksort on 8-byte words, and compared with their
   neighbours.  Suffixes that share leading bytes share a bucket (the key of the
   range is those bytes), so the last suffix of a bucket and the first of the next
   have no string in common; the comparison across boundaries is settled by the
   splitters.  Common prefixes of neighbours, forwards and backwards, give classes
   of equal strings for every distance to the anchor.
4. The repeated ranges go back to the chunks, which cut the bytes.

A chunk sends equal suffixes (with equal bytes before them) once with a mark, so a
passage that a third of all documents hold is one entry a chunk.

Edge cases: a null text is empty; texts below ``size`` bytes stay whole; matches
never cross documents; repeated rows are documents of their own, so copies remove
each other; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (U64, ceil_div, chunked, durable, mix, pack_bits, pack_sorted, packed, shards_of, total_bytes,
                     unpack_bits, unpack_sorted)
from .sketch_dedup import SPAN, _table, spans

GRAM = 16
_POS = U64((1 << 24) - 1)


def _views(a: np.ndarray) -> np.ndarray:
    """The 8 bytes from every place on, as little-endian integers."""
    return np.ndarray((len(a) - 7,), "<u8", a.tobytes(), strides=(1,))


def _sliding_min(g: np.ndarray, width: int) -> np.ndarray:
    span, m = 1, g
    while span * 2 <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    rest = width - span
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def anchors(a: np.ndarray, size: int, segment: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one document: anchor places, and the first and last string start of each."""
    where, first, last = [], [], []
    for at in range(0, len(a) - size + 1, segment):
        part = a[at:at + segment + size - 1]
        v = _views(part)
        g = mix(v[:len(part) - GRAM + 1] ^ mix(v[8:8 + len(part) - GRAM + 1], 3), 5)
        key = _sliding_min((g & ~_POS) | np.arange(len(g), dtype=U64), size - GRAM + 1)
        place = (key & _POS).astype(np.int64)
        new = np.flatnonzero(np.diff(place, prepend=-1))
        where.append(place[new] + at)
        first.append(new + at)
        last.append(np.append(new[1:], len(place)) - 1 + at)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(where or none), np.concatenate(first or none), np.concatenate(last or none)


class Suffixes:
    """The suffixes to sort in a chunk: document, start, and the distances ``lo..hi``
    (string start = suffix start - distance) that they stand for; distances are at
    most ``size / 2``."""

    def __init__(self, texts: list[bytes], size: int):
        half = size // 2
        self.size, self.half = size, half
        self.base = np.cumsum([0] + [len(t) for t in texts])
        doc, start, kind, lo, hi = [], [], [], [], []
        for d, t in enumerate(texts):
            if len(t) < size:
                continue
            p, a, b = anchors(np.frombuffer(t, np.uint8), size)
            near, far = p - b, p - a                        # distances from the anchor
            for k, (l, h) in enumerate(((near, np.minimum(far, half)), (np.maximum(near, half + 1) - half, far - half))):
                ok = l <= h
                n = int(ok.sum())
                doc.append(np.full(n, d))
                start.append(p[ok] - half * k)
                kind.append(np.full(n, k, np.uint8))
                lo.append(l[ok])
                hi.append(h[ok])
        none = [np.zeros(0, np.int64)]
        self.doc, self.start, self.lo, self.hi = (np.concatenate(x or none).astype(np.int64) for x in (doc, start, lo, hi))
        self.kind = np.concatenate(kind or none).astype(np.uint8)
        self.at = self.base[self.doc] + self.start
        self.bytes = np.frombuffer(b"".join(texts) + bytes(size + 8), np.uint8)

    def take(self, pick: np.ndarray) -> "Suffixes":
        for n in ("doc", "start", "lo", "hi", "kind", "at"):
            setattr(self, n, getattr(self, n)[pick])
        return self

    def _hash(self, at: np.ndarray, n: np.ndarray, most: int) -> np.ndarray:
        """Hash of n bytes (at most ``most``) from each place on, 8 at a time."""
        v = np.ndarray((len(self.bytes) - 7,), "<u8", self.bytes.tobytes(), strides=(1,))
        h = mix(n.astype(U64))
        for j in range(0, most, 8):
            left = np.clip(n - j, 0, 8)
            keep = np.where(left == 8, U64(2**64 - 1), (U64(1) << (U64(8) * (left % 8).astype(U64))) - U64(1))
            h = mix(h ^ (v[np.minimum(at + j, len(v) - 1)] & keep), 9)
        return h

    def lead(self) -> np.ndarray:
        """Hash of the leading half (every string of a suffix holds it)."""
        return self._hash(self.at, np.full(len(self.at), self.half), self.half) ^ mix(self.kind.astype(U64), 11)

    def context(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes that the strings of a suffix span: from its start - hi to its start - lo + size."""
        return self.at - self.hi, self.hi - self.lo + self.size


def _texts(tbl: pa.Table) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in tbl.column("text").to_pylist()]


def _ordered(docs: pa.Table) -> pa.Table:
    """The same order in every pass: rows by value (equal rows are alike)."""
    return docs.sort_by([("doc_id", "ascending"), ("text", "ascending")])


LEADS = "shard int, chunk long, h binary, twice binary"
KEEP = "chunk long, shard int, bits binary"
SUFFIX = "chunk long, doc int, start long, kind int, lo int, hi int, twice boolean, lead binary, context binary"
RANGES = "chunk long, doc int, start long, stop long"


def lead_chunk(size: int, bits: int):
    def run(key, tbl):
        h, n = np.unique(Suffixes(_texts(_ordered(tbl)), size).lead(), return_counts=True)
        return _table(LEADS, [(s, key[0].as_py(), pack_sorted(h[a:b]), pack_bits(n[a:b] > 1)) for s, a, b in shards_of(h, bits)])
    return run


def merge_leads(key, tbl):
    parts = [unpack_sorted(b) for b in tbl.column("h").to_pylist()]
    _, group = np.unique(np.concatenate(parts), return_inverse=True)
    often = (np.bincount(group) > 1)[group]
    out, a = [], 0
    for c, p, b in zip(tbl.column("chunk").to_pylist(), parts, tbl.column("twice").to_pylist()):
        out.append((c, key[0].as_py(), pack_bits(often[a:a + len(p)] | unpack_bits(b, len(p)))))
        a += len(p)
    return _table(KEEP, out)


def suffix_chunk(size: int, bits: int):
    def run(key, docs, verdicts):
        kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
        schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in SUFFIX.split(", ")])
        if not docs.num_rows:
            return schema.empty_table()
        s = Suffixes(_texts(_ordered(docs)), size)
        h, inverse = np.unique(s.lead(), return_inverse=True)
        told = dict(zip(verdicts.column("shard").to_pylist(), verdicts.column("bits").to_pylist()))
        parts = [unpack_bits(told[k], b - a) for k, a, b in shards_of(h, bits)]
        if not parts:
            return schema.empty_table()
        s.take(np.concatenate(parts)[inverse])
        at, n = s.context()
        same = s._hash(at, n, int(n.max(initial=0))) ^ mix((s.lo << 10 | s.hi << 1 | s.kind).astype(U64), 13)
        _, rep, group = np.unique(same, return_index=True, return_inverse=True)
        raw = s.bytes
        context = [raw[a:a + m].tobytes() for a, m in zip(at[rep].tolist(), n[rep].tolist())]
        equal = np.fromiter((raw[a:a + m].tobytes() == context[g] for a, m, g in zip(at.tolist(), n.tolist(), group.tolist())),
                            bool, len(at))
        # equal suffixes of the chunk are sent once; all of them learn the verdict by their place
        sent = np.zeros(len(at), bool)
        sent[rep] = True
        sent |= ~equal
        member = np.flatnonzero(~sent)
        twice = equal & (np.bincount(group, equal) > 1)[group]
        pick = np.concatenate((np.flatnonzero(sent), member))
        lead = [raw[a:a + s.half].tobytes() for a in s.at[pick].tolist()]
        whole = [raw[a:a + m].tobytes() if x else None for a, m, x in zip(at[pick].tolist(), n[pick].tolist(), sent[pick].tolist())]
        keep = np.array([x is not None for x in whole], bool)
        c = key[0].as_py()
        # members are repeated for certain: they need no sorting
        cols = [np.full(len(pick), c), s.doc[pick].astype(np.int32), s.start[pick], s.kind[pick].astype(np.int32),
                s.lo[pick].astype(np.int32), s.hi[pick].astype(np.int32), twice[pick]]
        arrays = [pa.array(x) for x in cols] + [pa.array([x if y else None for x, y in zip(lead, keep)], pa.binary()),
                                                pa.array(whole, pa.binary())]
        return pa.Table.from_arrays(arrays, schema=schema)
    return run


def multikey_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort, 8 bytes at a time: rows that tie on the words so far are
    split by the next word.  Returns (order, common leading words of neighbours)."""
    n, m = words.shape
    order = np.argsort(words[:, 0], kind="stable")
    col = words[order, 0]
    common = np.zeros(n, np.int64)
    tie = np.zeros(n, bool)
    tie[1:] = col[1:] == col[:-1]
    common[tie] = 1
    for w in range(1, m):
        member = tie.copy()
        member[:-1] |= tie[1:]
        at = np.flatnonzero(member)
        if not len(at):
            break
        group = np.cumsum(~tie[at])
        col = words[order[at], w]
        sub = np.lexsort((col, group))
        order[at] = order[at][sub]
        col = col[sub]
        still = np.zeros(len(at), bool)
        still[1:] = (col[1:] == col[:-1]) & (group[1:] == group[:-1])
        tie = np.zeros(n, bool)
        tie[at] = still
        common[tie] = w + 1
    return order, common


def _common_bytes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort padded byte rows; (order, common leading bytes with the row before)."""
    words = rows.view(">u8").astype(U64)
    order, common = multikey_order(words)
    lcp = common * 8
    part = np.flatnonzero((common > 0) & (common < words.shape[1]))
    first = np.flatnonzero(common == 0)
    at = np.union1d(part, first[first > 0])
    if len(at):
        c = common[at]
        differ = (words[order[at], c] ^ words[order[at - 1], c]).astype(">u8").view(np.uint8).reshape(-1, 8)
        lcp[at] += np.argmax(differ != 0, axis=1)
    if len(lcp):
        lcp[0] = 0
    return order, lcp


def repeated_strings(context: list[bytes], kind: np.ndarray, lo: np.ndarray, hi: np.ndarray, size: int) -> np.ndarray:
    """For suffixes with their bytes: flags (suffix, distance) of strings that start
    twice or more among them."""
    n, half = len(context), size // 2
    right, left = np.zeros((n, 8 + -(-size // 8) * 8), np.uint8), np.zeros((n, -(-half // 8) * 8), np.uint8)
    right[:, 0] = kind
    for i, c in enumerate(context):
        a = np.frombuffer(c, np.uint8)
        h = int(hi[i])
        right[i, 8:8 + len(a) - h] = a[h:]
        left[i, :h] = a[:h][::-1]
    order_r, lcp_r = _common_bytes(right)
    order_l, lcp_l = _common_bytes(left)
    lcp_r -= 8                                               # the kind's word
    out = np.zeros((n, half + 1), bool)
    class_r, class_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for t in range(int(lo.min(initial=0)), int(hi.max(initial=-1)) + 1):
        live = np.flatnonzero((lo <= t) & (t <= hi))
        class_r[order_r] = np.cumsum(lcp_r < size - t)
        class_l[order_l] = np.cumsum(lcp_l < t) if t else 0
        _, group, counts = np.unique(class_r[live] * (n + 1) + class_l[live], return_inverse=True, return_counts=True)
        out[live, t] = counts[group] > 1
    return out


def sort_bucket(size: int):
    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        held = pa.Table.from_batches(batches)
        col = {c: held.column(c).to_numpy() for c in ("chunk", "doc", "start", "kind", "lo", "hi", "twice")}
        flags = repeated_strings(held.column("context").to_pylist(), col["kind"], col["lo"], col["hi"], size)
        t = np.arange(flags.shape[1])
        flags |= col["twice"][:, None] & (t >= col["lo"][:, None]) & (t <= col["hi"][:, None])
        row, edge = np.nonzero(np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1))
        row, a, b = row[::2], edge[::2], edge[1::2] - 1       # repeated distances a..b
        yield pa.RecordBatch.from_arrays(
            [pa.array(col["chunk"][row]), pa.array(col["doc"][row]), pa.array(col["start"][row] - b),
             pa.array(col["start"][row] - a + size)], ["chunk", "doc", "start", "stop"])
    return run


RESULT = "doc_id {id}, n_bytes long, kept binary, removed array<struct<start:long,end:long>>"


def cut_chunk(key, docs, found):
    docs = _ordered(docs)
    texts = _texts(docs)
    by_doc = {}
    f = found.select(["doc", "start", "stop"]).to_pydict()
    for d, a, b in zip(f["doc"], f["start"], f["stop"]):
        by_doc.setdefault(d, []).append((a, b))
    kept, cuts = [], []
    for d, t in enumerate(texts):
        ranges = by_doc.get(d)
        if not ranges:
            kept.append(t)
            cuts.append([])
            continue
        step = np.zeros(len(t) + 1, np.int32)
        r = np.array(ranges)
        np.add.at(step, r[:, 0], 1)
        np.add.at(step, r[:, 1], -1)
        gone = np.cumsum(step[:-1]) > 0
        kept.append(np.frombuffer(t, np.uint8)[~gone].tobytes())
        cuts.append(spans(gone))
    return pa.table({"doc_id": docs.column("doc_id"), "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                     "kept": pa.array(kept, pa.binary()), "removed": pa.array(cuts, pa.list_(SPAN))})


def remove_repeated_strings(docs: DataFrame, size: int = 200, chunk_bytes: int = 8 << 20, shard: int = 1 << 21,
                            bucket_bytes: int = 16 << 20) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, n_bytes, kept, removed`` (byte ranges)."""
    docs = packed(docs.select("doc_id", "text"))
    total = total_bytes(docs, "text")
    bits = (ceil_div(total // 60, shard) - 1).bit_length()
    dealt = chunked(docs, ceil_div(total, chunk_bytes), "doc_id", "text").repartition("chunk")
    by_chunk = dealt.groupBy("chunk")
    keep = by_chunk.applyInArrow(lead_chunk(size, bits), LEADS).groupBy("shard").applyInArrow(merge_leads, KEEP)
    suffixes = by_chunk.cogroup(keep.groupBy("chunk")).applyInArrow(suffix_chunk(size, bits), SUFFIX)
    suffixes = durable(suffixes)
    certain = suffixes.where(F.col("lead").isNull()).select(
        "chunk", "doc", (F.col("start") - F.col("hi")).alias("start"), (F.col("start") - F.col("lo") + size).alias("stop"))
    rest = suffixes.where(F.col("lead").isNotNull())
    n = ceil_div(rest.agg(F.coalesce(F.sum(F.length("context") + 64), F.lit(0))).head()[0], bucket_bytes)
    sorted_ = rest.repartitionByRange(n, "kind", "lead").mapInArrow(sort_bucket(size), RANGES)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return by_chunk.cogroup(sorted_.unionByName(certain).groupBy("chunk")).applyInArrow(cut_chunk, RESULT.format(id=kind))
