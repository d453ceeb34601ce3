"""Best-fit packing by hierarchical residual packing.

Documents become token pieces of at most ``size``; full pieces are sequences of
their own.  Every partition packs its pieces by best fit (longest first), and bins
that are nearly full are done.  The underfull bins then move on as items of their
own: groups of partitions merge them by best fit again, tree-wise, until one group
is left, or until groups hold ``group_bins`` bins each (so that no task ever holds
more, whatever the input).

Only (bin, length) pairs travel up the tree; pieces learn their sequence and
offset by joining down the rounds.

Edge cases: a null or empty text is the end id alone; ties go to the smaller bin
number; repeated rows are packed one by one; an empty table gives no pieces;
other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ceil_div, durable, packed, thrifty_batches

PIECE = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


class Memory:
    """What was computed for a key, for the last ``size`` to ``2 * size`` keys in use."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def fill(self, keys: set, compute) -> dict:
        """The table that holds all ``keys``; ``compute`` maps a list of missing ones."""
        missing = keys.difference(self.new)
        if missing:
            if len(self.new) > self.size:
                self.old, self.new, missing = self.new, {}, keys
            for k in [k for k in missing if k in self.old]:
                self.new[k] = self.old[k]
            absent = [k for k in missing if k not in self.new]
            if absent:
                self.new.update(zip(absent, compute(absent)))
        return self.new


class WordEncoder:
    """Encode texts with a tokenizer that drops white space and splits letters from
    other characters, a distinct run at a time: ids of a text are the ids of its runs
    of letters, digits and others one after the other."""

    #: Texts of these characters fall into runs as below.  In others, words that hold
    #: other characters, or an apostrophe (endings such as 's), are one unit each.
    PLAIN = re.compile("[\x09-\x0d\x20-\x26\x28-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
    RUNS = re.compile("[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\x09-\x0d a-z0-9\xdf-\xf6\xf8-\xff]+")

    def __init__(self, path: str, max_runs: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark runs a task on every core already
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.known = Memory(max_runs)

        ends = [t.endswith("</w>") for t, _ in sorted(self.tok.get_vocab().items(), key=lambda x: x[1])]
        self.ends = np.array(ends, bool)

    def _encode_runs(self, runs: list[str]) -> list[bytes]:
        """Many runs in one text: the last id of each is one that ends a word."""
        out = []
        for a in range(0, len(runs), 500):
            found, = self.tok.encode_batch_fast([" ".join(runs[a:a + 500])], add_special_tokens=False)     # without offsets
            ids = np.array(found.ids, "<u4")
            cut = (np.flatnonzero(self.ends[ids]) + 1) * 4
            blob = ids.tobytes()
            out += [blob[i:j] for i, j in zip([0, *cut[:-1].tolist()], cut.tolist())]
        return out

    def _encode(self, runs: list) -> list[bytes]:
        """Runs as strings; words that are no plain words as (word,)."""
        plain = [r for r in runs if type(r) is str]
        known = dict(zip(plain, self._encode_runs(plain)))
        other = [r for r in runs if type(r) is tuple]
        for r, e in zip(other, self.tok.encode_batch_fast([w for w, in other], add_special_tokens=False)):
            known[r] = np.array(e.ids, "<u4").tobytes()
        return [known[r] for r in runs]

    def units(self, text: str) -> list:
        if self.PLAIN.fullmatch(text):
            return self.RUNS.findall(text.lower())
        out = []
        for w in map(bytes.decode, text.encode().split()):           # at ASCII white space only
            out += self.RUNS.findall(w.lower()) if self.PLAIN.fullmatch(w) else [(w,)]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, end id 0 included."""
        out = []
        for a in range(0, len(texts), 64):
            split = [self.units(t) for t in texts[a:a + 64]]
            known = self.known.fill(set().union(*split), self._encode)
            out += [b"".join(map(known.__getitem__, units)) + b"\0\0\0\0" for units in split]
        return out


def encode_pieces(path: str, size: int):
    def run(batches):
        enc = WordEncoder(path)
        for batch in batches:
            rows = []
            step, doc_id = 4 * size, batch.column("doc_id")
            for at in range(0, batch.num_rows, 64):
                texts = [t or "" for t in batch.column("text")[at:at + 64].to_pylist()]
                for doc, ids in zip(doc_id[at:at + 64].to_pylist(), enc.encode(texts)):
                    for k, a in enumerate(range(0, len(ids), step)):
                        part = ids[a:a + step]
                        rows.append((doc, k, a // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows)) if rows else [()] * 5
            kinds = [batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)
    return run


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit, longest items first: (bin of each item, offset of each item, fill of
    each bin).  Bins of equal room are kept in stacks, found by a bitmap of rooms."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    rooms, fill = 0, []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                rooms ^= 1 << room
        else:
            b, room = len(fill), size
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += n
        left = room - n
        if left:
            if not stacks[left]:
                rooms |= 1 << left
            stacks[left].append(b)
    return bins, offsets, np.array(fill, np.int64)


def _pack_partition(size: int, limit: int):
    def run(batches):
        part, done = TaskContext.get().partitionId(), 0
        held, rows = [], 0

        def flush():
            nonlocal held, rows, done
            t = pa.Table.from_batches(held)
            b, off, fill = best_fit(t.column("length").to_numpy(), size)
            ids = b + (part << 40) + done
            done += len(fill)
            held, rows = [], 0
            t = t.append_column("bin", pa.array(ids)).append_column("at", pa.array(off))
            return t.append_column("fill", pa.array(fill[b])).to_batches()
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= limit:
                yield from flush()
        if held:
            yield from flush()
    return run


MERGED = "child long, bin long, at long, fill long"


def _merge_group(size: int, level: int):
    def run(key, tbl):
        tbl = tbl.sort_by([("bin", "ascending")])          # one order, whatever the shuffle's
        b, off, fill = best_fit(tbl.column("fill").to_numpy(), size)
        base = (level << 58) + (key[0].as_py() << 28)
        return pa.table({"child": tbl.column("bin"), "bin": pa.array(b + base), "at": pa.array(off),
                         "fill": pa.array(fill[b])})
    return run


def pack(pieces: DataFrame, size: int = 2048, slack: int = 4, fan_in: int = 8, partition_pieces: int = 1 << 19,
         group_bins: int = 1 << 20) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``size``) plus ``sequence_id, offset``.
    Bins with at most ``slack`` free tokens are done in the round that made them."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    local = durable(packed(pieces).mapInArrow(_pack_partition(size, partition_pieces), f"{kinds}, bin long, at long, fill long"))
    waiting = lambda df: df.where(F.col("fill") < size - slack).select("bin", "fill").distinct()
    last = local.agg(F.max(F.shiftright("bin", 40))).head()[0]
    groups, level, rounds, open_bins = (0 if last is None else last + 1), 0, [], waiting(local)
    while groups:
        level += 1
        least = ceil_div(open_bins.count(), group_bins)
        groups = max(least, ceil_div(groups, fan_in))
        group = F.pmod(F.xxhash64("bin"), F.lit(groups))
        merged = durable(open_bins.withColumn("g", group).groupBy("g").applyInArrow(_merge_group(size, level), MERGED))
        rounds.append(merged)
        if groups <= least:
            break
        open_bins = waiting(merged)
    moved = None                                    # bin of the first round -> its last place
    for merged in reversed(rounds):
        step = merged.select("child", "bin", "at")
        if moved is not None:
            up = moved.select(F.col("child").alias("bin"), F.col("bin").alias("up"), F.col("at").alias("more"))
            step = step.join(up, "bin", "left").select(
                "child", F.coalesce("up", "bin").alias("bin"), (F.col("at") + F.coalesce("more", F.lit(0))).alias("at"))
        moved = step
    placed = local.drop("fill")
    if moved is not None:
        up = moved.select(F.col("child").alias("bin"), F.col("bin").alias("up"), F.col("at").alias("more"))
        placed = placed.join(up, "bin", "left").select(
            *pieces.columns, F.coalesce("up", "bin").alias("bin"), (F.col("at") + F.coalesce("more", F.lit(0))).alias("at"))
    return placed.select(*pieces.columns, F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, **how) -> DataFrame:
    """``docs(doc_id, text)`` -> one row per piece: ``doc_id, piece, start, length,
    ids_crc32, sequence_id, offset``.  ``tokenizer``: path of a file that executors see."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = packed(docs).select("doc_id", "text").mapInArrow(thrifty_batches(encode_pieces(tokenizer, size)), PIECE.format(id=kind))
    return pack(pieces, size, **how)
