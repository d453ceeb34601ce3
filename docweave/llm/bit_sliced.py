"""Exact top-k inner products on a bit-sliced index.

Vectors are quantised to integers.  A block of rows is stored as bitmaps: slice b of
attribute d holds bit b of that attribute, one bit a row.  A query's scores over a
block are the weighted sum of attributes, made by adding slices with bitmap
arithmetic (carry-save adders on whole bitmaps), so they come out as score slices.
The top rows are then selected from the most significant slice downward, and the
rows that tie at the boundary are resolved exactly by the smaller id.

Rows and queries are packed into blocks (bounded sizes); a row block meets every
query block by an equi-join on the row block's number, and each task keeps at most
k rows a query.

Edge cases: vectors that are null, or that hold null or non-finite components,
take no part; so do rows with a null id, as rows and as queries.  Rows that repeat
an id are candidates one by one, except for the query of that id.  Vectors whose
length differs from the query's are no candidates for it.  Fewer candidates than k
give fewer rows.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, ceil_div, durable, packed

ONES = U64(0xFFFFFFFFFFFFFFFF)


def quantise(scale: int):
    """floor(scale * x) per component, in 64-bit floats."""
    return lambda v: F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


# -- bitmaps -------------------------------------------------------------------

def to_slices(values: np.ndarray) -> tuple[int, list[np.ndarray]]:
    """One attribute of a block: (least value, bitmaps of value - least)."""
    least = int(values.min())
    rest = (values - least).astype(np.uint64)
    pad = -len(rest) % 64
    rest = np.pad(rest, (0, pad))
    slices = []
    for b in range(int(rest.max()).bit_length()):
        bits = ((rest >> U64(b)) & U64(1)).astype(np.uint8)
        slices.append(np.packbits(bits, bitorder="little").view("<u8"))
    return least, slices


def signed_digits(n: int) -> list[tuple[int, int]]:
    """n as a sum of sign * 2**place with few terms (no two neighbours)."""
    out, place = [], 0
    while n:
        if n & 1:
            d = 2 - (n & 3)
            out.append((place, d))
            n -= d
        n >>= 1
        place += 1
    return out


def add_up(columns: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Carry-save addition: columns[w] holds bitmaps of weight 2**w; the sum as one
    bitmap per weight, least first."""
    out, w = [], 0
    while columns:
        col = columns.pop(w, [])
        up = columns.get(w + 1, [])
        while len(col) > 2:
            a, b, c = col.pop(), col.pop(), col.pop()
            half = a ^ b
            up.append((a & b) | (half & c))
            col.append(half ^ c)
        if len(col) == 2:
            a, b = col
            up.append(a & b)
            col = [a ^ b]
        if up:
            columns[w + 1] = up
        out.append(col[0] if col else None)
        w += 1
    return out


def score_slices(index: list[tuple[int, list[np.ndarray]]], query: list[int]) -> tuple[int, list[np.ndarray]]:
    """Inner products of a block as (constant, slices): score = constant + slices.
    A negative term adds the complement of its slice and corrects the constant."""
    constant, columns = 0, {}
    for q, (least, slices) in zip(query, index):
        constant += q * least
        for place, sign in signed_digits(q):
            for b, s in enumerate(slices):
                columns.setdefault(place + b, []).append(s if sign > 0 else ~s)
                if sign < 0:
                    constant -= 1 << (place + b)
    return constant, add_up(columns)


def count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def top_rows(slices: list[np.ndarray], eligible: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows surely in the top k, rows tied at its boundary) as bitmaps."""
    sure, tied = np.zeros_like(eligible), eligible
    for s in reversed(slices):
        if s is None:
            continue
        hit = tied & s
        n = count(sure) + count(hit)
        if n > k:
            tied = hit
        else:
            sure, tied = sure | hit, tied & ~s
            if n == k:
                break
    return sure, tied


def rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


class Block:
    """The bit-sliced index of a block of rows (ids ascending)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.index = [to_slices(vectors[:, d]) for d in range(vectors.shape[1])]
        full = np.zeros(len(ids) + -len(ids) % 64, np.uint8)
        full[:len(ids)] = 1
        self.full = np.packbits(full, bitorder="little").view("<u8")

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows, ties to the smaller id."""
        _, slices = score_slices(self.index, query.tolist())
        own = self.full
        a, b = np.searchsorted(self.ids, query_id, "left"), np.searchsorted(self.ids, query_id, "right")
        if a < b:
            own = own.copy()
            for r in range(a, b):
                own[r >> 6] &= ~(U64(1) << U64(r & 63))
        sure, tied = top_rows(slices, own, k)
        rows = rows_of(sure)
        rows = np.concatenate((rows, rows_of(tied)[:k - len(rows)]))   # ids ascend, so the first are the smaller
        return self.ids[rows], self.vectors[rows] @ query


# -- Spark ---------------------------------------------------------------------

PACKED = "block long, dims int, n int, ids binary, vectors binary"


def _pack(size: int):
    def run(batches):
        part, made, held = TaskContext.get().partitionId(), 0, {}

        def emit(dims, rows):
            nonlocal made
            ids = np.array([i for i, _ in rows], "<i8")
            vec = np.array([v for _, v in rows], "<i8").reshape(len(rows), dims)
            order = np.argsort(ids, kind="stable")
            made += 1
            return pa.RecordBatch.from_pydict({
                "block": [(part << 32) + made], "dims": pa.array([dims], pa.int32()), "n": pa.array([len(rows)], pa.int32()),
                "ids": [ids[order].tobytes()], "vectors": [vec[order].tobytes()]})
        for batch in batches:
            for i, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist()):
                rows = held.setdefault(len(v), [])
                rows.append((i, v))
                if len(rows) == size:
                    yield emit(len(v), held.pop(len(v)))
        for dims, rows in held.items():
            yield emit(dims, rows)
    return run


FOUND = "query_id long, vec_id long, score long"


def _search(k: int):
    def run(batches):
        at, block = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if r["block"] != at:
                    at, ids = r["block"], np.frombuffer(r["ids"], "<i8")
                    block = Block(ids, np.frombuffer(r["vectors"], "<i8").reshape(r["n"], r["dims"]))
                queries = np.frombuffer(r["q_vectors"], "<i8").reshape(r["q_n"], r["dims"])
                out = [(q, *block.top(q, v, k)) for q, v in zip(np.frombuffer(r["q_ids"], "<i8").tolist(), queries)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([q for q, _, _ in out], [len(i) for _, i, _ in out]), pa.int64()),
                     pa.array(np.concatenate([i for _, i, _ in out])), pa.array(np.concatenate([s for _, _, s in out]))],
                    ["query_id", "vec_id", "score"])
    return run


def top_k(rows: DataFrame, queries: DataFrame, k: int = 20, row_block: int = 1 << 16, query_block: int = 256) -> DataFrame:
    """``rows(id long, v array<long>)`` and ``queries`` alike -> ``query_id, rank, vec_id, score``."""
    def blocks(df, size):
        n = packed(df).count()
        return df.repartition(ceil_div(n, size)).mapInArrow(_pack(size), PACKED)
    stored = durable(blocks(rows, row_block))
    asked = blocks(queries, query_block).select("dims", F.col("n").alias("q_n"), F.col("ids").alias("q_ids"),
                                                F.col("vectors").alias("q_vectors"))
    # the row blocks that a query block meets, by number: block numbers only
    numbers = stored.groupBy("dims").agg(F.collect_list("block").alias("blocks"))
    deals = asked.join(numbers, "dims").withColumn("block", F.explode("blocks")).drop("blocks", "dims")
    n_pairs = ceil_div(queries.count(), query_block) * ceil_div(rows.count(), row_block)
    pairs = deals.join(stored, "block").repartition(max(n_pairs, 1))
    found = pairs.mapInArrow(_search(k), FOUND)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
