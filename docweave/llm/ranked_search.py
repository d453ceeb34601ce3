"""Ranked lexical search: term-at-a-time with a limited number of accumulators.

``build_index`` cuts the documents into chunks and writes an inverted list of every
term a chunk holds (document numbers and term frequencies), with the chunk's share of
the corpus statistics.  ``search`` sums these to document frequencies, weighs every
term of a query and orders the terms rarest first.  A chunk answers a query a term at
a time: each posting adds to its document's accumulator.  Before a term is read, the
sum of the largest scores that this and all later terms can still give is compared
with the k-th best partial score: once it is below, a document without an accumulator
cannot be among the k best any more, and no new accumulators are made; the terms left
only update the survivors, exactly.  The k best of every chunk hold the k best of all.

Score of a document: sum over the query's terms, once each, of
``w * ((1000000000 * tf) div (1000 * tf + 8 * m))``, with
``w = floor(1000 * ln((2 N + 2) / (2 df + 1)))`` and ``m = 10 + ((90 * n * N) div L)``.

The index is built without a shuffle and read where it lies.  Queries are packed into
blocks of bounded size; the blocks, not the index, travel: by broadcast if all of them
are measured to be small, else by a shuffle on parts of the index.

Edge cases: null or empty texts hold no term, count for nothing and are never found;
a query without a known term has no rows; repeated documents are found each, equal
scores by doc_id, null ids last; a repeated query (same id and text) counts once, and
texts that share an id are ranked each on its own; a text of any length lies in one
chunk; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ceil_div, durable, pack, packed, unpack

#: Bytes that are part of a term: ASCII letters (as lower case), digits, and all of
#: every character beyond ASCII; anything else separates.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SLICE = 1 << 20


def terms_of(raw: bytes) -> list[bytes]:
    """The terms of a text, in order, with repeats."""
    return raw.translate(_FOLD).split()


def _term_numbers(raw: bytes, number: dict[bytes, int]) -> np.ndarray:
    """Numbers of a text's terms; a long text is read in slices that end between terms."""
    out, at = [], 0
    while at < len(raw):
        end = min(at + SLICE, len(raw))
        while end < len(raw) and _FOLD[raw[end]] != 32:
            end += 1
        terms = terms_of(raw[at:end])
        out.append(np.fromiter([number.setdefault(t, len(number)) for t in terms], np.int64, len(terms)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.int64)


# -- index ---------------------------------------------------------------------

INDEX = ("chunk long, n_docs long, n_terms long, terms array<string>, dfs array<int>, "
         "ids array<long>, lengths array<long>, postings binary, tfs binary")


def _chunk_row(ids: list, numbers: list[np.ndarray], vocabulary: dict[bytes, int]) -> pa.RecordBatch:
    """One chunk: postings by term, then document."""
    sizes = np.array([len(x) for x in numbers], np.int64)
    keys = np.concatenate(numbers)
    keys *= len(ids)
    keys += np.repeat(np.arange(len(ids)), sizes)
    keys, tfs = np.unique(keys, return_counts=True)
    dfs = np.bincount(keys // len(ids), minlength=len(vocabulary))
    docs = (keys % len(ids)).astype(np.uint32)
    terms = [t.decode() for t in vocabulary]
    chunk = hash_of(docs, sizes)
    return pa.RecordBatch.from_arrays(
        [pa.array([chunk], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([int(sizes.sum())], pa.int64()),
         pa.array([terms], pa.list_(pa.string())), pa.array([dfs], pa.list_(pa.int32())), pa.array([ids], pa.list_(pa.int64())),
         pa.array([sizes], pa.list_(pa.int64())), pa.array([pack(docs)], pa.binary()), pa.array([pack(tfs.astype(np.uint32))], pa.binary())],
        ["chunk", "n_docs", "n_terms", "terms", "dfs", "ids", "lengths", "postings", "tfs"])


def hash_of(docs: np.ndarray, sizes: np.ndarray) -> int:
    """A number that spreads chunks; equal ones do no harm."""
    return int((int(docs.sum(dtype=np.uint64)) * 0x9E3779B97F4A7C15 + int(sizes.sum())) % (1 << 62))


def _index(chunk_bytes: int):
    def run(batches):
        ids, numbers, vocabulary, held = [], [], {}, 0
        for batch in batches:
            texts = batch.column("text")
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for i, (doc_id, size) in enumerate(zip(batch.column("doc_id").to_pylist(), sizes)):
                if held and held + size > chunk_bytes:
                    yield _chunk_row(ids, numbers, vocabulary)
                    ids, numbers, vocabulary, held = [], [], {}, 0
                found = _term_numbers((texts[i].as_py() or "").encode(), vocabulary) if size else ()
                if len(found):
                    ids.append(doc_id)
                    numbers.append(found)
                    held += size
        if ids:
            yield _chunk_row(ids, numbers, vocabulary)
    return run


def build_index(docs: DataFrame, chunk_bytes: int = 16 << 20) -> DataFrame:
    """``docs(doc_id long, text string)`` -> one row per chunk of about ``chunk_bytes``
    of text (a longer text alone).  Row-local; write it (``durable``) before a search."""
    return packed(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_index(chunk_bytes), INDEX)


# -- one chunk, one query --------------------------------------------------------

def best_of(lists: list[tuple[np.ndarray, np.ndarray, int]], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents that can be among the k best, and their exact scores; the number of
    accumulators made.  ``lists``: per term, rarest first, ascending document numbers,
    what each gets, and the largest of it."""
    partial = np.zeros(n_docs, np.int64)
    left, done, survivors = sum(most for _, _, most in lists), 0, None
    for docs, gain, most in lists:
        if survivors is None and done > left:        # the k-th partial score is at most ``done``
            if _kth(partial, k) > left:
                survivors = np.flatnonzero(partial)
        if survivors is None:
            partial[docs] += gain
        else:
            at = np.searchsorted(docs, survivors)
            at[at == len(docs)] = 0
            hit = docs[at] == survivors
            partial[survivors[hit]] += gain[at[hit]]
        left -= most
        done += most
    made = np.flatnonzero(partial) if survivors is None else survivors
    scores = partial[made]
    reach = scores >= max(1, _kth(scores, k))
    return made[reach], scores[reach], len(made)


def _kth(scores: np.ndarray, k: int) -> int:
    """The k-th largest score; 0 if fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


class Chunk:
    """A row of the index, ready to answer."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.number = {t: i for i, t in enumerate(row["terms"])}
        self.edge = np.concatenate(([0], np.cumsum(row["dfs"])))
        self.docs, self.tfs = unpack(row["postings"], np.uint32), unpack(row["tfs"], np.uint32)
        self.ids = row["ids"]
        self.m = 10 + 90 * np.array(row["lengths"], np.int64) * n_docs // n_terms
        self.held: dict = {}

    def postings(self, term: str):
        """(documents, what a weight of one gives them, the largest) of a term."""
        if term not in self.held:
            at = self.number.get(term)
            if at is None:
                self.held[term] = None
            else:
                part = slice(self.edge[at], self.edge[at + 1])
                docs, tf = self.docs[part].astype(np.int64), self.tfs[part].astype(np.int64)
                gain = 1_000_000_000 * tf // (1000 * tf + 8 * self.m[docs])
                self.held[term] = docs, gain, int(gain.max())
        return self.held[term]

    def answer(self, terms: list[dict], k: int) -> list[tuple]:
        """(doc_id, score) of the k best documents of a query's weighted terms."""
        lists = []
        for t in terms:
            if t["w"] > 0 and (found := self.postings(t["term"])):
                docs, gain, most = found
                lists.append((docs, gain * t["w"], most * t["w"]))
        docs, scores, _ = best_of(lists, len(self.ids), k)
        rows = [(self.ids[d], s) for d, s in zip(docs.tolist(), scores.tolist())]
        return sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))[:k]


# -- search ----------------------------------------------------------------------

def _distinct_terms(batches):
    for batch in batches:
        found = [sorted({x.decode() for x in terms_of((t or "").encode())}) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("item"), pa.array(found, pa.list_(pa.string()))],
                                         ["item_id", "item", "terms"])


def _answers(n_docs: int, n_terms: int, k: int):
    def run(batches):
        held = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                number = one.column("chunk")[0].as_py(), one.column("place")[0].as_py()
                if held[0] != number:
                    held = number, Chunk({c: one.column(c)[0].as_py() for c in ("terms", "dfs", "ids", "lengths", "postings", "tfs")}, n_docs, n_terms)
                queries = one.column("queries")[0].as_py()
                rows = [(q["item_id"], q["item"], d, s) for q in queries for d, s in held[1].answer(q["terms"], k)]
                cols = list(zip(*rows)) if rows else [()] * 4
                kind = batch.schema.field("queries").type.value_type.field("item_id").type
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *(pa.array(c, pa.int64()) for c in cols[1:])],
                                                 ["item_id", "item", "doc_id", "score"])
    return run


def search(index: DataFrame, queries: DataFrame, k: int, block_terms: int = 50_000, small: int = 8 << 20) -> DataFrame:
    """The ``k`` best documents of every row of ``queries(item_id, text)``:
    ``item_id, rank, doc_id, score``."""
    kind = queries.schema["item_id"].dataType.simpleString()
    total = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0)), F.count("*")).head()
    n_docs, n_terms, n_chunks = total
    items = packed(queries).select("item_id", F.xxhash64("item_id", "text").alias("item"), "text").distinct()
    wanted = durable(items.mapInArrow(_distinct_terms, f"item_id {kind}, item long, terms array<string>")
                     .select("item_id", "item", F.explode("terms").alias("term")))
    counted = (index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.dfs").alias("df"))
               .join(wanted.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df")))
    weight = F.floor(1000 * F.log((2 * F.lit(float(n_docs)) + 2) / (2 * F.col("df") + 1)))
    plans = durable(wanted.join(counted.select("term", weight.alias("w"), "df"), "term").groupBy("item_id", "item")
                    .agg(F.sort_array(F.collect_list(F.struct("df", "term", "w"))).alias("terms")))     # rarest first
    size, n_weighted = plans.agg(F.coalesce(F.sum(F.aggregate("terms", F.lit(0).cast("long"), lambda n, t: n + F.length(t["term"]) + 24)), F.lit(0)),
                                 F.coalesce(F.sum(F.size("terms")), F.lit(0))).head()
    blocks = plans.groupBy(F.pmod("item", F.lit(ceil_div(n_weighted, block_terms))).alias("block")).agg(
        F.collect_list(F.struct("item_id", "item", "terms")).alias("queries"))
    parts = 4 if size <= small else ceil_div(n_chunks, 8)
    sent = blocks.select("queries", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"))
    chunks = index.withColumn("part", F.pmod(F.xxhash64("chunk"), F.lit(parts).cast("long"))).withColumn("place", F.monotonically_increasing_id())
    met = chunks.join(F.broadcast(sent) if size <= small else sent, "part").drop("part")
    found = met.mapInArrow(_answers(n_docs, max(1, n_terms), k), f"item_id {kind}, item long, doc_id long, score long")
    order = Window.partitionBy("item_id", "item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
