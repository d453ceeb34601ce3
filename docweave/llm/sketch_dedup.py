"""Substring dedup over word windows with a count-min prefilter.

A window is ``window`` consecutive words of one document; a word goes when it lies
in a window whose word sequence also starts anywhere else.

1. Every chunk of documents makes a count-min sketch of its windows: ``depth``
   rows of cells, kept sparse.  Sketches are dealt by cell range and added up.
   The width follows the input, so the share of false alarms does not.
2. A merged cell count is never below the number of windows that fell into the
   cell, so a window with a cell counted once is unique.  The verdicts go back to
   the chunks as one bit per cell; nothing is broadcast.
3. Only windows estimated as repeated are grouped, by a 128-bit fingerprint; each
   chunk sends a fingerprint once however often it holds it (a passage that a
   third of all documents share is one entry a chunk).  The repeated
   ones go back to their chunks, which cut the covered words.

Documents move in one shuffle that all three passes share; everything else moves
as packed arrays.  Edge cases: a null text has no words and an empty kept text;
texts shorter than a window stay whole (white space becomes single spaces);
repeated rows are separate documents, so copies remove each other; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (U64, ceil_div, chunked, mix, pack, pack_bits, pack_sorted, packed, run_hashes, shards_of,
                     thrifty, thrifty_pair, total_bytes, unpack, unpack_bits, unpack_sorted, word_hashes)


def _encoded(tbl: pa.Table) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in tbl.column("text").to_pylist()]


class Windows:
    """The windows of a chunk's documents as two independent hash arrays."""

    def __init__(self, texts: list[bytes], window: int):
        words, self.counts = word_hashes(texts)
        self.texts = texts
        n = max(0, len(words) - window + 1)
        whole = np.ones(n, bool)
        for end in np.cumsum(self.counts).tolist():            # windows must not go on into the next text
            whole[max(0, end - window + 1):end] = False
        self.at = np.flatnonzero(whole)
        self.h1 = run_hashes(words, window)[whole]
        self.n_words, self.window = len(words), window

    def second(self, pick: np.ndarray) -> np.ndarray:
        return run_hashes(word_hashes(self.texts, seed=1)[0], self.window)[self.at[pick]]

    def among(self, r1: np.ndarray, r2: np.ndarray) -> np.ndarray:
        """Numbers of the windows whose two hashes are one of the given pairs."""
        order = np.argsort(r1, kind="stable")
        r1, r2 = r1[order], r2[order]
        first, after = np.searchsorted(r1, self.h1), np.searchsorted(r1, self.h1, "right")
        pick = np.flatnonzero(after > first)
        first, after, h2 = first[pick], after[pick], self.second(pick)
        same = np.zeros(len(pick), bool)
        for k in range(int((after - first).max()) if len(pick) else 0):     # pairs that share the first hash
            same |= (first + k < after) & (r2[np.minimum(first + k, len(r2) - 1)] == h2)
        return pick[same]


def cells_of(h: np.ndarray, row: int, log_width: int) -> np.ndarray:
    """A window's cell in a row, left-aligned."""
    free = U64(64 - log_width)
    return mix(h, row + 1) >> free << free


def sketch_row(h: np.ndarray, row: int, log_width: int):
    """Cells of a row: (cells, window -> cell, counts)."""
    return np.unique(cells_of(h, row, log_width), return_inverse=True, return_counts=True)


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    cols = [c.split() for c in schema.split(", ")]
    data = list(zip(*rows)) if rows else [()] * len(cols)
    return pa.table({n: pa.array(d, kinds[k]) for (n, k), d in zip(cols, data)})


CELLS = "shard int, chunk long, cells binary, counts binary"
BITS = "chunk long, shard int, bits binary"
PRINTS = "shard int, chunk long, h1 binary, h2 binary, twice binary"
REPEATED = "chunk long, shard int, h1 binary, h2 binary"


def sketch_chunk(window: int, depth: int, log_width: int, bits: int):
    def run(key, tbl):
        h, out = Windows(_encoded(tbl), window).h1, []
        for row in range(depth):
            cells, counts = np.unique(cells_of(h, row, log_width), return_counts=True)
            small = np.minimum(counts, 255).astype(np.uint8)
            out += [((row << bits) + s, key[0].as_py(), pack_sorted(cells[a:b] >> U64(64 - log_width)),
                     pack(small[a:b])) for s, a, b in shards_of(cells, bits)]
        return _table(CELLS, out)
    return run


def merge_cells(key, tbl):
    """Add up one cell range of all sketches; a bit per cell and chunk: counted twice or more."""
    cells = [unpack_sorted(b) for b in tbl.column("cells").to_pylist()]
    counts = np.concatenate([unpack(b, np.uint8) for b in tbl.column("counts").to_pylist()])
    _, cell = np.unique(np.concatenate(cells), return_inverse=True)
    often = (np.bincount(cell, weights=counts) >= 2)[cell]
    cut = np.cumsum([len(c) for c in cells])
    return _table(BITS, [(c, key[0].as_py(), pack_bits(often[b - len(x):b])) for c, x, b in
                         zip(tbl.column("chunk").to_pylist(), cells, cut.tolist())])


def fingerprint_chunk(window: int, depth: int, log_width: int, bits: int):
    def run(key, docs, verdicts):
        if not docs.num_rows:
            return _table(PRINTS, [])
        w = Windows(_encoded(docs), window)
        told = dict(zip(verdicts.column("shard").to_pylist(), verdicts.column("bits").to_pylist()))
        maybe = np.ones(len(w.h1), bool)
        for row in range(depth):
            cells, cell = np.unique(cells_of(w.h1, row, log_width), return_inverse=True)
            parts = [unpack_bits(told[(row << bits) + s], b - a) for s, a, b in shards_of(cells, bits)]
            if parts:
                maybe &= np.concatenate(parts)[cell]
        pick = np.flatnonzero(maybe)
        h1, h2 = w.h1[pick], w.second(pick)
        order = np.lexsort((h2, h1))
        h1, h2 = h1[order], h2[order]
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        at = np.flatnonzero(new)
        twice = np.diff(np.append(at, len(h1))) > 1
        h1, h2 = h1[at], h2[at]
        return _table(PRINTS, [(s, key[0].as_py(), pack_sorted(h1[a:b]), pack(h2[a:b]), pack_bits(twice[a:b]))
                               for s, a, b in shards_of(h1, bits)])
    return run


def merge_fingerprints(key, tbl):
    """Group one fingerprint range exactly; the repeated ones go back to their chunks."""
    parts = [unpack_sorted(b) for b in tbl.column("h1").to_pylist()]
    size = [len(p) for p in parts]
    h1 = np.concatenate(parts)
    h2 = np.concatenate([unpack(b, U64) for b in tbl.column("h2").to_pylist()])
    twice = np.concatenate([unpack_bits(b, n) for b, n in zip(tbl.column("twice").to_pylist(), size)])
    order = np.lexsort((h2, h1))
    new = np.ones(len(h1), bool)
    new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
    group = np.cumsum(new) - 1
    repeated = np.empty(len(h1), bool)
    repeated[order] = (np.bincount(group) > 1)[group]
    repeated |= twice
    out, a = [], 0
    for c, n in zip(tbl.column("chunk").to_pylist(), size):
        mine = repeated[a:a + n]
        if mine.any():
            out.append((c, key[0].as_py(), pack_sorted(h1[a:a + n][mine]), pack(h2[a:a + n][mine])))
        a += n
    return _table(REPEATED, out)


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
RESULT = "doc_id {id}, n_words long, n_removed long, kept_text string, removed array<struct<start:long,end:long>>"


def spans(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return [{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()]


def cut_chunk(window: int):
    def run(key, docs, found):
        texts = _encoded(docs)
        gone = counts = None
        if found.num_rows:
            w = Windows(texts, window)
            r1 = np.concatenate([unpack_sorted(b) for b in found.column("h1").to_pylist()])
            r2 = np.concatenate([unpack(b, U64) for b in found.column("h2").to_pylist()])
            at = w.at[w.among(r1, r2)]
            step = np.zeros(w.n_words + 1, np.int32)
            np.add.at(step, at, 1)
            np.add.at(step, at + window, -1)
            gone, counts = np.cumsum(step[:-1]) > 0, w.counts.tolist()
        n_words, n_removed, kept, cuts, a = [], [], [], [], 0
        for i, t in enumerate(texts):
            words = t.split()
            n_words.append(len(words))
            mine = None
            if gone is not None:
                mine = gone[a:a + counts[i]]
                a += counts[i]
            if mine is not None and mine.any():
                cuts.append(spans(mine))
                n_removed.append(int(mine.sum()))
                words = compress(words, (~mine).tolist())
            else:
                cuts.append([])
                n_removed.append(0)
            kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
                         "n_removed": pa.array(n_removed, pa.int64()), "kept_text": pa.array(kept, pa.string()),
                         "removed": pa.array(cuts, pa.list_(SPAN))})
    return run


def remove_repeated_windows(docs: DataFrame, window: int = 35, depth: int = 2, cells_per_word: int = 4,
                            chunk_bytes: int = 8 << 20, shard_words: int = 1 << 22) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, n_words, n_removed, kept_text, removed``
    (word ranges).  ``chunk_bytes`` and ``shard_words`` bound what a task holds."""
    docs = packed(docs.select("doc_id", "text"))
    size = total_bytes(docs, "text")
    words = max(1, size // 5)
    bits = (ceil_div(words, shard_words) - 1).bit_length()
    log_width = max(bits + 1, (cells_per_word * words).bit_length())
    args = (window, depth, log_width, bits)
    dealt = chunked(docs, ceil_div(size, chunk_bytes), "doc_id", "text").repartition("chunk")
    by_chunk = dealt.groupBy("chunk")
    sketches = by_chunk.applyInArrow(thrifty(sketch_chunk(*args)), CELLS)
    verdicts = sketches.groupBy("shard").applyInArrow(thrifty(merge_cells), BITS)
    prints = by_chunk.cogroup(verdicts.groupBy("chunk")).applyInArrow(thrifty_pair(fingerprint_chunk(*args)), PRINTS)
    found = prints.groupBy("shard").applyInArrow(thrifty(merge_fingerprints), REPEATED)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return by_chunk.cogroup(found.groupBy("chunk")).applyInArrow(thrifty_pair(cut_chunk(window)), RESULT.format(id=kind))
