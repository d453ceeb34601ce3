"""SentencePiece encoding with seeded merge-dropout, and decoding.

Encoding is the BPE of the model file: an agenda of neighbouring pieces whose join
is a piece, best score first, leftmost on ties.  With dropout a candidate that
comes up is skipped when the keyed hash of seed, text, the word's number in the text,
place in the word and joined piece falls below the rate: every occurrence of a word
draws anew.  A text gets other, equally valid pieces under another seed, and the same
ones whenever, wherever and how often it is encoded.  At rate 0 the pieces are those
of the library.

Decoding is lossless for every text: what no piece spells goes as bytes, also the
model's own blank sign when a text holds it.

Words are independent (no piece has a blank sign after another character).  What the
draws do not change is remembered: a root is a word, a first skip is a word with the
one step of its agenda that was skipped, and both hold the joins that follow and the
pieces when none of them is skipped.  An occurrence goes from its root to the first
join that its draws skip; one that skips again has its agenda worked on by its own
draws and leaves nothing behind.  Agendas are worked on as arrays, many at a time.
Beyond ``max_nodes`` those that were met once are forgotten.

Edge cases: a null text gives null pieces, an empty one none; texts of any length
are encoded whole; repeated rows are encoded alike; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import packed

BLANK = "▁"
#: Words up to this length are worked on as arrays.
SHORT = 48
NEVER = np.int32(2 ** 31 - 1)
#: Joins are found in a table of 2**SLOTS slots.
SLOTS = 20
GOLDEN, FULL = 0x9E3779B97F4A7C15, 2 ** 64 - 1
#: Words whose draws are made at a time.
SLICE = 100_000


def scatter(x):
    """The finalizer of splitmix64, of one integer or in place of an array."""
    if isinstance(x, int):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & FULL
        x = (x ^ x >> 27) * 0x94D049BB133111EB & FULL
        return x ^ x >> 31
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def _spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each, as many as counted."""
    ends = np.cumsum(count)
    return np.repeat(start - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.held, self.n = np.zeros(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        while self.n + len(values) > len(self.held):
            self.held = np.concatenate([self.held, np.zeros_like(self.held)])
        self.held[self.n:self.n + len(values)] = values
        self.n += len(values)

    @property
    def now(self) -> np.ndarray:
        return self.held[:self.n]


@lru_cache(maxsize=2)
def _load(path: str):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto
    model = proto.ModelProto()
    model.ParseFromString(sentencepiece.SentencePieceProcessor(model_file=path).serialized_model_proto())
    return model


class Pieces:
    """A BPE model with byte fallback: encoder with dropout, and decoder."""

    def __init__(self, path: str, rate: float = 0.1, seed: int = 0, max_nodes: int = 450_000):
        kinds = _load(path).pieces
        self.id = {p.piece: i for i, p in enumerate(kinds) if p.type == p.NORMAL}
        self.score = {p.piece: p.score for p in kinds if p.type == p.NORMAL and len(p.piece) > 1}
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(kinds) if p.type == p.BYTE}
        if any(BLANK in p.lstrip(BLANK) for p in self.id) or len(self.byte) != 256:
            raise ValueError("the model needs byte pieces, and blank signs only at the start of pieces")
        self.spell = [bytes([int(p.piece[3:5], 16)]) if p.type == p.BYTE else
                      p.piece.replace(BLANK, " ").encode() if p.type == p.NORMAL else b"" for p in kinds]
        joined = {c for p in self.score for c in p}
        alone = "".join(c for c in "\n\r\t" if c not in joined)
        #: a word: blanks and what follows up to the next blank; characters that join nothing stand alone
        self.words = re.compile(f"[{alone}]| *[^ {alone}]+| +" if alone else " *[^ ]+| +")
        self.bar, self.seed, self.max_nodes = int(rate * 2 ** 64), seed, max_nodes
        self._empty()
        self._arrays(len(kinds))

    def _arrays(self, n: int) -> None:
        """The model as arrays: characters, joins of two pieces, agenda order, keys."""
        def piece(p):                                      # of a character that is no piece: a number behind them
            return self.id.get(p, n + ord(p) if len(p) == 1 else None)
        self.n, self.wide = n, n + 0x110000
        self.char = np.arange(n, self.wide, dtype=np.int32)
        for p, i in self.id.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.char[32], self.char[ord(BLANK)] = self.char[ord(BLANK)], n + ord(BLANK)
        self.bytes = np.array([self.byte[b] for b in range(256)], np.int32)
        order = {s: r for r, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        halves = ((piece(p[:k]), piece(p[k:]), order[s], self.id[p]) for p, s in self.score.items() for k in range(1, len(p)))
        join = np.array(sorted((a * self.wide + b, r, i) for a, b, r, i in halves if a is not None and b is not None), np.int64)
        slot = self._slot(join[:, 0]).astype(np.int64)
        join = join[np.argsort(slot, kind="stable")]
        held = np.bincount(slot, minlength=2 ** SLOTS)
        #: joins by slot, and some that are none behind them
        self.most, self.more = int(held.max()), held > 1
        self.first = (np.cumsum(held) - held).astype(np.int32)
        self.join_key, self.join_rank, self.join_id = (np.pad(x, (0, self.most), constant_values=-1) for x in (
            join[:, 0], join[:, 1].astype(np.int32), join[:, 2].astype(np.int32)))
        self.key = np.zeros(n, np.uint64)
        for p, i in self.id.items():
            self.key[i] = xxhash.xxh64_intdigest(p.encode(), self.seed)
        self.rank = {p: order[s] for p, s in self.score.items()}
        self.places = np.array([xxhash.xxh64_intdigest(b"%d" % i, self.seed) for i in range(SHORT)], np.uint64)

    def _empty(self) -> None:
        self.root: dict[str, int] = {}
        #: of each node: where the characters of its word are, its pieces, its joins, and how often it was met
        self.at, self.size, self.met = Grown(np.int64), Grown(np.int64), Grown(np.int64)
        self.ids_at, self.ids_n = Grown(np.int64), Grown(np.int64)
        self.start, self.count = Grown(np.int64), Grown(np.int64)
        self.letters, self.ids = Grown(np.int32), Grown(np.int32)
        #: of each join: its key, and the node where it is skipped (-1: not met yet)
        self.joins, self.child = Grown(np.uint64), Grown(np.int32)

    def _forget(self) -> None:
        """Keeps the roots that were met more than once, the most met if they are many."""
        old, word = self.__dict__.copy(), np.array([*self.root.values()], np.int64)
        met = old["met"].now
        least = max(2, np.partition(met[word], -(self.max_nodes // 2))[-(self.max_nodes // 2)] + 1
                    if len(word) > self.max_nodes // 2 > 0 else 2)
        kept = word[met[word] >= least]
        words = [w for w, k in old["root"].items() if met[k] >= least]
        self._empty()
        self.root = dict(zip(words, range(len(words))))
        for pool, start, count in (("letters", "at", "size"), ("ids", "ids_at", "ids_n"), ("joins", "start", "count")):
            n = old[count].now[kept]
            getattr(self, pool).add(old[pool].now[_spread(old[start].now[kept], n)])
            getattr(self, start).add(np.cumsum(n) - n)
            getattr(self, count).add(n)
        self.child.add(np.full(self.joins.n, -1))
        self.met.add(met[kept] // 2)

    def _event(self, whole: str, i: int) -> int:
        place = int(self.places[i]) if i < SHORT else xxhash.xxh64_intdigest(b"%d" % i, self.seed)
        return int(self.key[self.id[whole]]) ^ place

    def agenda(self, word: str, skip=None, at: int = 0) -> list[str]:
        """The pieces of one word (``at``: its place in a longer one), its agenda as a
        heap; ``skip`` tells of the key of a candidate whether it is skipped."""
        piece = list(word)
        n, rank = len(piece), self.rank
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        todo = [(rank[w], i, i + 1, w) for i in range(n - 1) if (w := piece[i] + piece[i + 1]) in rank]
        heapq.heapify(todo)
        while todo:
            _, i, j, whole = heapq.heappop(todo)
            if after[i] != j or piece[i] + piece[j] != whole:
                continue                                   # one of the two has grown since
            if skip and skip(self._event(whole, at + i)):
                continue
            piece[i], piece[j] = whole, ""
            k = after[i] = after[j]
            after[j] = -2
            if k >= 0:
                before[k] = i
                if (w := whole + piece[k]) in rank:
                    heapq.heappush(todo, (rank[w], i, k, w))
            h = before[i]
            if h >= 0 and (w := piece[h] + whole) in rank:
                heapq.heappush(todo, (rank[w], h, i, w))
        return [p for p in piece if p]

    def _join(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of joining a and b; rank ``NEVER`` where they join to none."""
        key = a.astype(np.int64) * self.wide + b
        slot = self._slot(key)
        at = self.first[slot]
        ok = self.join_key[at] == key
        todo = np.flatnonzero(~ok & self.more[slot])
        for _ in range(1, self.most):
            at[todo] += 1
            ok[todo] = self.join_key[at[todo]] == key[todo]
            todo = todo[~ok[todo]]
        ok &= (a >= 0) & (b >= 0)
        at[~ok] = 0
        return np.where(ok, self.join_rank[at], NEVER), self.join_id[at]

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(GOLDEN)) >> np.uint64(64 - SLOTS)

    def agendas(self, piece: np.ndarray, skip: np.ndarray | None = None, drawn: np.ndarray | None = None):
        """The agendas of many words at a time.  ``piece``: words x characters as piece
        ids, -1 behind their ends; ``skip``: the step of each to skip (-1: none), or
        ``drawn``: the key of the draws of each.  The pieces (-1 also where one has been
        joined to the one before it) and, without draws, the joins after the skipped
        step: their keys, word by word, and how many each has."""
        n, m = piece.shape
        piece, step = piece.copy(), 0
        late, keys = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        after = np.tile(np.arange(1, m + 1), (n, 1))               # m: none
        before = np.tile(np.arange(-1, m - 1), (n, 1))
        padded = np.pad(piece, ((0, 0), (0, 1)), constant_values=-1)
        rank, whole = (x.reshape(n, m) for x in self._join(padded[:, :-1].ravel(), padded[:, 1:].ravel()))
        rows = np.arange(n)
        while len(rows):
            i = np.argmin(rank[rows], axis=1)                      # the best, leftmost of equals
            live = rank[rows, i] != NEVER
            r, c = rows, i = rows[live], i[live]
            w = whole[r, c]
            drop = skip[r] == step if drawn is None else \
                scatter(self.key[w] ^ self.places[c] ^ drawn[r]) < np.uint64(self.bar)
            if drop.any():
                rank[r[drop], c[drop]] = NEVER
                r, c, w = r[~drop], c[~drop], w[~drop]
            if drawn is None:
                told = skip[r] < step
                late.append(r[told])
                keys.append(self.key[w[told]] ^ self.places[c[told]])
            step += 1
            j = after[r, c]
            piece[r, c], piece[r, j] = w, -1
            rank[r, j] = NEVER
            k = after[r, c] = after[r, j]
            inside = k < m
            before[r[inside], k[inside]] = c[inside]
            right = np.where(inside, piece[r, np.minimum(k, m - 1)], -1)
            rank[r, c], whole[r, c] = self._join(w, right)
            h = before[r, c]
            has = h >= 0
            r, h, w = r[has], h[has], w[has]
            rank[r, h], whole[r, h] = self._join(piece[r, h], w)
        late = np.concatenate(late)
        return piece, np.concatenate(keys)[np.argsort(late, kind="stable")], np.bincount(late, minlength=n)

    def _ids(self, word: str, skip=None) -> bytes:
        out, at = [], 0
        for k, part in enumerate(word.split(BLANK)):       # a blank sign in the text itself goes as bytes
            if k:
                out += [self.byte[b] for b in BLANK.encode()]
            for p in self.agenda(part.replace(" ", BLANK), skip, at) if part else ():
                i = self.id.get(p)
                out += [i] if i is not None else [self.byte[b] for b in p.encode()]
            at += len(part) + 1
        return np.array(out, "<i4").tobytes()

    def _blocks(self, at: np.ndarray, size: np.ndarray):
        """Words of like lengths, many at a time: which, and their characters."""
        order = np.argsort(size, kind="stable")
        letters = self.letters.now
        for a in range(0, len(order), 4096):
            part = order[a:a + 4096]
            place = np.arange(size[part[-1]])
            inside = place < size[part][:, None]
            yield part, np.where(inside, letters[np.minimum(at[part][:, None] + place, len(letters) - 1)], -1)

    def _spelled(self, done: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of finished agendas, word by word, and how many each has: characters
        that are no piece go as bytes."""
        keep = done >= 0
        ids, count = done[keep], keep.sum(axis=1)
        odd = ids >= self.n
        if odd.any():
            code = ids - self.n
            width = np.where(odd, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF), 1)
            count = np.bincount(np.repeat(np.arange(len(done)), count), width, len(done)).astype(np.int64)
            text = code[odd].astype("<u4").tobytes().decode("utf-32-le").encode()
            ids, odd = np.repeat(ids, width), np.repeat(odd, width)
            ids[odd] = self.bytes[np.frombuffer(text, np.uint8)]
        return ids, count

    def _grow(self, at: np.ndarray, size: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """New nodes: words by their characters, and the step that is skipped (-1: none)."""
        node = np.empty(len(at), np.int64)
        for part, piece in self._blocks(at, size):
            node[part] = np.arange(self.at.n, self.at.n + len(part))
            done, keys, count = self.agendas(piece, skip[part])
            ids, n = self._spelled(done)
            self.at.add(at[part])
            self.size.add(size[part])
            self.met.add(np.zeros(len(part)))
            self.ids_at.add(self.ids.n + np.cumsum(n) - n)
            self.ids_n.add(n)
            self.ids.add(ids)
            self.start.add(self.joins.n + np.cumsum(count) - count)
            self.count.add(count)
            self.joins.add(keys)
            self.child.add(np.full(len(keys), -1))
        return node

    def _learn(self, words: list[str]) -> None:
        """Roots of words that were not met before."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        at = self.letters.n + np.cumsum(size) - size
        self.letters.add(self.char[np.frombuffer("".join(words).encode("utf-32-le"), "<u4")])
        self.root.update(zip(words, self._grow(at, size, np.full(len(words), -1)).tolist()))

    def _skipped(self, node: np.ndarray, drawn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of occurrences at these nodes those that skip a join, and the first join each skips."""
        count = self.count.now[node]
        of = np.repeat(np.arange(len(node)), count)
        join = _spread(self.start.now[node], count)
        hit = np.flatnonzero(scatter(self.joins.now[join] ^ drawn[of]) < np.uint64(self.bar))
        hit = hit[np.diff(of[hit], prepend=-1) > 0]
        return of[hit], join[hit]

    def _draw(self, words: list[str], drawn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all occurrences of words, and how many each has; ``drawn`` is the key of
        the draws of each."""
        if self.at.n > self.max_nodes:
            self._forget()
        new = [w for w in set(words).difference(self.root) if len(w) <= SHORT]
        if new:
            self._learn(new)
        node = np.fromiter(map(self.root.get, words, repeat(-1)), np.int64, len(words))
        np.add.at(self.met.now, node[node >= 0], 1)
        own, parts, counts = [], [], []                    # occurrences that no node stands for
        for k in np.flatnonzero(node < 0).tolist():        # a long word meets its like too seldom
            mine = int(drawn[k])
            parts.append(np.frombuffer(self._ids(words[k], lambda event: scatter(mine ^ event) < self.bar), "<i4"))  # noqa: B023
            own.append([k])
            counts.append([len(parts[-1])])
        if self.bar:
            live = np.flatnonzero(node >= 0)
            hit, join = self._skipped(node[live], drawn[live])
            live = live[hit]
            first = np.unique(join[self.child.now[join] < 0])
            if len(first):
                owner = np.searchsorted(self.start.now, first, side="right") - 1
                made = self._grow(self.at.now[owner], self.size.now[owner], first - self.start.now[owner])
                self.child.now[first] = made
            node[live] = self.child.now[join]
            again = live[self._skipped(node[live], drawn[live])[0]]
            for part, piece in self._blocks(self.at.now[node[again]], self.size.now[node[again]]):
                ids, n = self._spelled(self.agendas(piece, drawn=drawn[again[part]])[0])
                own.append(again[part])
                parts.append(ids)
                counts.append(n)
        start, count = self.ids_at.now[node], self.ids_n.now[node]
        if own:
            own, counts = np.concatenate(own), np.concatenate(counts)
            start[own], count[own] = self.ids.n + np.cumsum(counts) - counts, counts
        return np.concatenate([self.ids.now, *parts])[_spread(start, count)], count

    def encode_all(self, texts: list[str | None]) -> list[bytes | None]:
        """Ids of each text as little-endian 32-bit integers."""
        out: list[bytes | None] = [None if t is None else b"" for t in texts]
        held: list[int] = []
        words: list[str] = []
        drawn: list[np.ndarray] = []

        def empty():
            key = np.concatenate(drawn)
            done = [self._draw(words[a:a + SLICE], key[a:a + SLICE]) for a in range(0, len(words), SLICE)]
            ids = np.concatenate([d[0] for d in done]).astype("<i4", copy=False)
            ends = np.cumsum(np.concatenate([d[1] for d in done]))[np.cumsum([len(d) for d in drawn]) - 1].tolist()
            for i, a, b in zip(held, [0, *ends], ends):
                out[i] = ids[a:b].tobytes()
            held.clear(), words.clear(), drawn.clear()
        for i, t in enumerate(texts):
            if not t:
                continue
            mine = self.words.findall(" " + t)
            key = np.uint64(xxhash.xxh64_intdigest(t.encode(), self.seed))
            held.append(i)
            words += mine
            drawn.append(scatter(np.arange(1, len(mine) + 1, dtype=np.uint64) * np.uint64(GOLDEN) + key))
            if len(words) >= SLICE:
                empty()
        if held:
            empty()
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.spell.__getitem__, ids)).decode()[1:]


@lru_cache(maxsize=1)
def _pieces(*args, **how) -> Pieces:
    """One for all tasks of a worker: what it remembers holds for any text."""
    return Pieces(*args, **how)


def _lists(blobs: list[bytes | None]) -> pa.Array:
    size = [0 if b is None else len(b) // 4 for b in blobs]
    ends = np.cumsum([0, *size]).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(b or b"" for b in blobs), "<i4"), pa.int32())
    nulls = pa.array([b is None for b in blobs], pa.bool_()) if None in blobs else None
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=nulls)


def encode(docs: DataFrame, model: str, rate: float = 0.1, seed: int = 0, batch_texts: int = 512, **how) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, ids array<int>``; ``model`` is a path that executors see."""
    def run(batches):
        pieces = _pieces(model, rate, seed, **how)
        for batch in batches:
            for a in range(0, batch.num_rows, batch_texts):
                part = batch.slice(a, batch_texts)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _lists(pieces.encode_all(part.column("text").to_pylist()))],
                                                 ["doc_id", "ids"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return packed(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(coded: DataFrame, model: str) -> DataFrame:
    """``coded(doc_id, ids)`` plus ``text``, as it was before encoding."""
    def run(batches):
        pieces = _pieces(model)
        for batch in batches:
            ids = batch.column("ids")
            text = [None if not ids[i].is_valid else pieces.decode(ids[i].values.to_numpy().tolist()) for i in range(len(ids))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(text, pa.string())], ["doc_id", "ids", "text"])
    kind = coded.schema["doc_id"].dataType.simpleString()
    return packed(coded).select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")
