"""Language identification by multilingual mixture inference.

A language is a distribution over byte n-grams (hashed to a fixed number of
features), learned by counting over all labelled texts.  A document is a mixture
of languages: expectation-maximisation finds the proportions under which its
n-grams are most likely.  The language set is chosen by penalised likelihood:
starting from all languages, the one of the smallest proportion is dropped as long as
the likelihood lost is below ``penalty * log(n-grams)`` (one proportion less to
describe).  The prediction is the language of the largest proportion, the
score that proportion.

The model holds languages x features counts, so its size does not grow with the
documents; counts are summed by Spark.

Edge cases: a null text or one without a letter is ``und`` with score 0; ties go
to the smaller language name; with no labelled text every document is ``und``;
repeated rows are judged one by one; an empty table gives no rows; a text of any length
is counted whole, in slices; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, thrifty_batches


GRAM = 3
FEATURES = 1 << 16
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def features(text: str, n_features: int = FEATURES) -> np.ndarray:
    """Feature of every n-gram of the lower-case text's bytes."""
    a = np.frombuffer(f" {text} ".lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    key = np.zeros(max(0, len(a) - GRAM + 1), np.uint32)
    for j in range(GRAM):
        key = (key << np.uint32(8)) | a[j:j + len(key)]
    return (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - n_features.bit_length() + 1)


COUNTED = "lang string, block int, counts binary"
BLOCK = 1 << 12


def _count(n_features: int):
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                t = total.setdefault(lang, np.zeros(n_features, np.int64))
                for a in range(0, len(text), 1 << 20):     # a long text in slices
                    t += np.bincount(features(text[a:a + (1 << 20)], n_features), minlength=n_features)
        rows = [(lang, b, t[b * BLOCK:(b + 1) * BLOCK].tobytes()) for lang, t in total.items()
                for b in range(-(-n_features // BLOCK))]
        cols = list(zip(*rows)) if rows else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()),
                                          pa.array(cols[2], pa.binary())], ["lang", "block", "counts"])
    return run


def _add(key, tbl):
    total = np.sum([np.frombuffer(b, np.int64) for b in tbl.column("counts").to_pylist()], axis=0)
    return pa.table({"lang": [key[0].as_py()], "block": pa.array([key[1].as_py()], pa.int32()), "counts": [total.tobytes()]})


class Model:
    """Languages in name order and the log-likelihood of every feature in each."""

    def __init__(self, names: list[str], counts: np.ndarray, smoothing: float = 0.5):
        self.names = names
        p = (counts + smoothing) / (counts + smoothing).sum(axis=1, keepdims=True)
        self.p = p.T.astype(np.float64)                    # features x languages

    def mixture(self, text: str, rounds: int = 20, penalty: float = 2.0) -> tuple[list[int], np.ndarray, float]:
        """(languages chosen, their proportions, log-likelihood)."""
        n = np.zeros(len(self.p), np.int64)
        for a in range(0, len(text), 1 << 20):
            n += np.bincount(features(text[a:a + (1 << 20)], len(self.p)), minlength=len(self.p))
        seen = np.flatnonzero(n)
        weight, p = n[seen].astype(np.float64), self.p[seen]
        chosen = list(range(len(self.names)))
        share, fit = expectation_maximisation(p, weight, rounds)
        price = penalty * np.log(max(2.0, weight.sum()))
        while len(chosen) > 1:
            # what goes is the smallest proportion; it costs the least
            rest = [i for i in range(len(chosen)) if i != int(np.argmin(share))]
            less, lower = expectation_maximisation(p[:, rest], weight, rounds)
            if fit - lower > price:
                break
            p, share, fit, chosen = p[:, rest], less, lower, [chosen[i] for i in rest]
        return chosen, share, fit

    def predict(self, text: str | None, **how) -> tuple[str, float, list[dict]]:
        if not self.names or text is None or not _LETTER.search(text):
            return UNKNOWN, 0.0, []
        chosen, share, _ = self.mixture(text, **how)
        best = int(np.argmax(share))
        order = sorted(range(len(chosen)), key=lambda i: (-share[i], chosen[i]))
        found = [{"lang": self.names[chosen[i]], "share": float(share[i])} for i in order]
        return self.names[chosen[best]], float(min(1.0, share[best])), found


def expectation_maximisation(p: np.ndarray, weight: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Proportions that raise sum(weight * log(p @ share)), and that sum."""
    share, total = np.full(p.shape[1], 1 / p.shape[1]), weight.sum()
    for _ in range(rounds if len(share) > 1 else 0):
        share = share * ((weight / (p @ share)) @ p) / total
    return share, float(weight @ np.log(p @ share))


def train(docs: DataFrame, n_features: int = FEATURES) -> Model:
    """Learn from the ``text`` and ``lang`` of all rows that have both."""
    labelled = packed(docs).where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("lang", "text")
    counted = labelled.mapInArrow(thrifty_batches(_count(n_features)), COUNTED).groupBy("lang", "block").applyInArrow(_add, COUNTED)
    parts = counted.orderBy("lang", "block").toArrow().to_pylist()     # languages x features numbers
    names = sorted({r["lang"] for r in parts})
    counts = [np.concatenate([np.frombuffer(r["counts"], np.int64) for r in parts if r["lang"] == x]) for x in names]
    return Model(names, np.array(counts, np.int64).reshape(len(names), -1) if names else np.zeros((0, n_features)))


SHARES = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
GUESS = "lang_pred string, score double, languages array<struct<lang:string,share:double>>"


def identify(docs: DataFrame, model: Model, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` plus ``lang_pred, score, languages`` (the chosen set with shares).
    Only the text is read for a prediction."""
    held = packed(docs).sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            out = [held.value.predict(t) for t in batch.column("text").to_pylist()]
            cols = list(zip(*out)) if out else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()),
                 pa.array(cols[2], SHARES)], [*columns, "lang_pred", "score", "languages"])
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return docs.select(*columns, *(["text"] if "text" not in columns else [])).mapInArrow(thrifty_batches(run), f"{kinds}, {GUESS}")
