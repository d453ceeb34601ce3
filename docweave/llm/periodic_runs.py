"""Periodic runs of words, found by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q (words q apart are
equal) that is at least ``least`` words and ``exponent`` periods long and that no
neighbouring word extends.  The words of a text are appended one by one.  The nodes
of the automaton on the suffix-link path of the new prefix hold its suffixes; each
remembers where its strings last ended.  That path falls into segments of equal last
end, kept as a link-cut forest: accessing the prefix's node visits one segment after
the other and recolours all of them with the new end.  If the distance d between the
segment's end and the new one is a length that the segment holds, its suffix of d
words stands twice in a row: a square of smallest period d, which is extended to its
run.  All segments visited while n words are appended are O(n log n).

Only stretches that can hold a run are appended.  In a run, every stretch of
``gram`` words (see ``gram_of``) stands again one period away, that is within
1/``exponent`` of the surrounding stretch, so words in no such repeat are cut out by
hashing (equal words hash equally, so nothing is lost), as long as that cuts much.

Memory: a text is held as numbers of its distinct words; an automaton is held for one
stretch at a time, in arrays.

Edge cases: a null or empty text has no words and no runs; repeated rows are judged
one by one; ``exponent`` is at least 2; an empty table gives an empty one; other
columns are ignored; nothing is shuffled.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, mix, packed

SLICE = 1 << 20
_SPACE = b" \t\n\x0b\x0c\r"


# -- one stretch ---------------------------------------------------------------

class Automaton:
    """Suffix automaton of a sequence of numbers: ``link`` and ``length`` of every
    state and, in ``ends``, the state of every prefix.  Most states have one
    transition, which two arrays hold; the others are in ``more``."""

    def __init__(self, s: list[int]):
        link, length = array("l", [-1]), array("l", [0])
        letter, target, more = array("l", [-1]), array("l", [0]), {}
        ends, last = array("l"), 0

        def follow(p, c):
            if letter[p] == c:
                return target[p]
            return more[p].get(c, -1) if p in more else -1

        for c in s:
            cur = len(length)
            length.append(length[last] + 1)
            link.append(0)
            letter.append(-1)
            target.append(0)
            p, q = last, -1
            while p >= 0:
                q = follow(p, c)
                if q >= 0:
                    break
                if letter[p] < 0:
                    letter[p], target[p] = c, cur
                else:
                    more.setdefault(p, {})[c] = cur
                p = link[p]
            if q >= 0:
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    letter.append(letter[q])
                    target.append(target[q])
                    if q in more:
                        more[clone] = dict(more[q])
                    link[q] = link[cur] = clone
                    while p >= 0 and follow(p, c) == q:
                        if letter[p] == c:
                            target[p] = clone
                        else:
                            more[p][c] = clone
                        p = link[p]
            ends.append(cur)
            last = cur
        self.link, self.length, self.ends = link, length, ends


class LastEnds:
    """Link-cut forest over the suffix links.  A splay tree holds a path segment whose
    strings last ended at the same place (``end`` of its root), by depth; its root's
    ``up`` is the state above the segment.  State 0, the empty string, is left out."""

    def __init__(self, link: array):
        self.up = [max(p, 0) for p in link]
        self.left, self.right, self.end = [0] * len(link), [0] * len(link), [-1] * len(link)

    def splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                return
            g = up[p]
            inner = g and (left[g] == p or right[g] == p)
            turns = (x,)
            if inner:
                turns = (p, x) if (left[g] == p) == (left[p] == x) else (x, x)
            for y in turns:
                p = up[y]
                g = up[p]
                if left[p] == y:
                    left[p] = b = right[y]
                    right[y] = p
                else:
                    right[p] = b = left[y]
                    left[y] = p
                if b:
                    up[b] = p
                up[p], up[y] = y, g
                if g:
                    if left[g] == p:
                        left[g] = y
                    elif right[g] == p:
                        right[g] = y
                    else:
                        self.end[y] = self.end[p]
                else:
                    self.end[y] = self.end[p]

    def access(self, state: int, now: int):
        """(deepest state, last end) of every segment of the path to the root, from
        the deepest on; all of them end at ``now`` afterwards."""
        below, x = 0, state
        while x:
            self.splay(x)
            cut, before = self.right[x], self.end[x]
            if cut:
                self.end[cut] = before               # the deeper part stays as it was
            self.right[x] = below
            if below:
                self.up[below] = x
            yield x, before
            below, x = x, self.up[x]
        self.end[below] = now


def squares(s: list[int]):
    """(end, period) of every square whose period is its smallest, by end."""
    machine = Automaton(s)
    ends, length = LastEnds(machine.link), machine.length
    for i, state in enumerate(machine.ends):
        deep = []
        for x, before in ends.access(state, i):
            deep.append((length[x], before))
        for (longest, before), (shorter, _) in zip(deep, [*deep[1:], (0, 0)]):
            if before >= 0 and shorter < i - before <= longest:
                yield i, i - before


def runs_of(s: list[int], least: int, exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence, by start and period."""
    out, known, n = [], {}, len(s)
    for i, d in squares(s):
        if known.get(d, -1) >= i:
            continue
        a, b = i - 2 * d + 1, i + 1
        while a and s[a - 1] == s[a - 1 + d]:
            a -= 1
        while b < n and s[b] == s[b - d]:
            b += 1
        known[d] = b - 1
        if b - a >= max(least, exponent * d):
            out.append((a, b - a, d))
    return sorted(out, key=lambda r: (r[0], r[2]))


# -- stretches that can hold a run ----------------------------------------------

def gram_of(least: int, exponent: int) -> int:
    """How many words repeat one period away wherever they stand in a run: a run of L
    words has L - g + 1 places for g words, and with two periods of places each has
    another a period before or after it."""
    return max(1, min(max(least, exponent * q) - 2 * q + 1 for q in range(1, least + 1)))


def _near_repeats(ids: np.ndarray, part: np.ndarray, reach: np.ndarray, gram: int) -> np.ndarray:
    """Flags of the words inside ``gram`` words of one part that stand again in the
    part, at most ``reach`` words away."""
    n = len(ids) - gram + 1
    inside = np.zeros(len(ids) + 1, np.int64)
    if n <= 0:
        return inside[1:] > 0
    h = mix(part[:n].astype(U64), 7)
    for j in range(gram):
        h = mix(h ^ ids[j:j + n].astype(U64), j)
    whole = np.flatnonzero(part[:n] == part[gram - 1:])
    h = h[whole]
    order = np.argsort(h, kind="stable")             # equal ones by place
    at = whole[order]
    same = (h[order][1:] == h[order][:-1]) & (part[at[1:]] == part[at[:-1]]) & (at[1:] - at[:-1] <= reach[at[1:]])
    hit = np.zeros(n, bool)
    hit[at[1:][same]] = hit[at[:-1][same]] = True
    inside[:n] += hit
    inside[gram:gram + n] -= hit
    return np.cumsum(inside[:-1]) > 0


def stretches(ids: np.ndarray, sizes: np.ndarray, least: int, exponent: int) -> list[tuple[int, int]]:
    """(from, to) of the stretches of words that can hold runs, of texts laid end to
    end; none crosses texts."""
    gram = gram_of(least, exponent)
    place = np.arange(len(ids))
    part = np.repeat(np.arange(len(sizes)), sizes)
    while len(place):
        size = np.bincount(part)
        keep = _near_repeats(ids[place], part, (size // exponent)[part], gram)
        split = np.flatnonzero(keep[1:] & keep[:-1] & (part[1:] == part[:-1])) + 1    # goes on from the word before
        first = keep.copy()
        first[split] = False
        number = np.cumsum(first)[keep] - 1
        long = (np.bincount(number) >= least)[number] if len(number) else np.zeros(0, bool)
        kept, number = place[keep][long], number[long]
        done = len(kept) > 0.9 * len(place)           # the rest is left to the automaton
        place, part = kept, np.unique(number, return_inverse=True)[1] if len(number) else number
        if done:
            break
    if not len(place):
        return []
    edge = np.flatnonzero(np.diff(part)) + 1
    lo = place[np.concatenate(([0], edge))]
    return list(zip(lo.tolist(), (place[np.concatenate((edge - 1, [len(place) - 1]))] + 1).tolist()))


# -- texts -----------------------------------------------------------------------

def word_slices(raw: bytes):
    """The words of a text, a slice at a time (cut at white space)."""
    at = 0
    while at < len(raw):
        end = at + SLICE
        while end < len(raw) and raw[end] not in _SPACE:
            end += 1
        yield raw[at:end].split()
        at = end


class Texts:
    """Some texts as numbers of their distinct words."""

    def __init__(self, raws: list[bytes]):
        number: dict[bytes, int] = {}
        ids, sizes = [], []
        for raw in raws:
            n = 0
            for words in word_slices(raw):
                ids.append(np.fromiter([number.setdefault(w, len(number)) for w in words], np.int64, len(words)))
                n += len(words)
            sizes.append(n)
        self.words = list(number)
        self.ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        self.sizes = np.array(sizes, np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.sizes)))

    def runs(self, least: int, exponent: int) -> list[list[tuple[int, int, int]]]:
        """The runs of every text."""
        out: list[list] = [[] for _ in self.sizes]
        for a, b in stretches(self.ids, self.sizes, least, exponent):
            text = int(np.searchsorted(self.start, a, "right")) - 1
            shift = a - int(self.start[text])
            found = runs_of(np.unique(self.ids[a:b], return_inverse=True)[1].tolist(), least, exponent)
            out[text] += [(s + shift, n, d) for s, n, d in found]
        return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]

    def collapsed(self, text: int, runs: list[tuple[int, int, int]]) -> bytes:
        """The text's words without those after the first period of a run."""
        ids = self.ids[self.start[text]:self.start[text + 1]]
        if runs:
            gone = np.zeros(len(ids), bool)
            for s, n, d in runs:
                gone[s + d:s + n] = True
            ids = ids[~gone]
        return b" ".join(b" ".join([self.words[i] for i in ids[a:a + SLICE].tolist()]) for a in range(0, len(ids), SLICE))


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _find(columns, least, exponent, group_bytes):
    def run(batches):
        for batch in batches:
            texts = batch.column("_text")
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            a = 0
            while a < len(sizes):
                b, held = a, 0
                while b < len(sizes) and (b == a or held + sizes[b] <= group_bytes):
                    held += sizes[b]
                    b += 1
                part = Texts([(t or "").encode() for t in texts.slice(a, b - a).to_pylist()])
                runs = part.runs(least, exponent)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(a, b - a) for c in columns), pa.array(part.sizes, pa.int64()),
                     pa.array([[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in runs], pa.list_(RUN)),
                     pa.array([part.collapsed(i, rs).decode() for i, rs in enumerate(runs)], pa.string())],
                    [*columns, "n_words", "runs", "collapsed"])
                a = b
    return run


def find_runs(docs: DataFrame, text: str = "text", columns: tuple[str, ...] = ("doc_id",), least: int = 6,
              exponent: int = 4, group_bytes: int = 4 << 20) -> DataFrame:
    """``columns`` plus ``n_words``, ``runs`` (start, length, period in words, by start
    and period) and ``collapsed``: the words but those that a run holds after its
    first period, joined by one space.  ``group_bytes`` of text are worked on at once
    (a longer text alone)."""
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    rows = packed(docs).select(*columns, F.col(text).alias("_text"))
    return rows.mapInArrow(_find(columns, least, exponent, group_bytes), f"{kinds}, {FOUND}")
