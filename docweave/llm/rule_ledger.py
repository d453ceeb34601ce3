"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once for a document: its measurements stay as columns and
its failure becomes one bit of ``bits``.  A policy is a bitmask of the rules it
enforces, with a name and a version, so applying one, comparing two, or asking
what a rule rejects alone is bitwise arithmetic on the ledger; texts are not read
again.

Edge cases: a null or empty text has no words and fails ``few_words``; repeated
rows are judged one by one; an empty table gives an empty ledger; other columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper"]

#: rule -> when it fails, on the measurements; a rule's bit is its place here.
#: New rules are appended, so that stored ledgers keep their meaning.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "upper_case": "100 * n_upper > 40 * word_chars",
    "long_words": "word_chars > 20 * n_words",
}
BIT = {rule: 1 << i for i, rule in enumerate(RULES)}


def mask(*rules: str) -> int:
    return sum(BIT[r] for r in set(rules))


@dataclass(frozen=True)
class Policy:
    """Which rules reject a document; ``version`` tells editions apart."""

    name: str
    version: int
    rules: tuple[str, ...] = field(default=tuple(RULES))

    @property
    def mask(self) -> int:
        return mask(*self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
STANDARD = Policy("standard", 1)


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPLIT))


def _windows(words: Column) -> Column:
    """(hash, place) of every three consecutive words, sorted."""
    n = F.greatest(F.size(words) - 2, F.lit(0))
    pairs = F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    hashes = F.zip_with(pairs, F.slice(words, 3, n), lambda p, c: F.xxhash64(p["a"], p["b"], c))
    return F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def _covered(windows: Column) -> Column:
    """Words in a window that has an equal one; equal windows are neighbours."""
    def again(w, j):
        return (F.get(windows, j - 1)["h"].eqNullSafe(w["h"]) | F.get(windows, j + 1)["h"].eqNullSafe(w["h"]))
    places = F.transform(F.filter(windows, again), lambda w: F.array(w["i"], w["i"] + 1, w["i"] + 2))
    return F.size(F.array_distinct(F.flatten(places)))


def measure(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and the measurements of every row of ``docs``.  Every step is
    row-local: no shuffle, whatever the sizes of documents.  ``key`` may be of any
    type, a struct of the whole row for instance."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    one = docs.select(
        key, _words(t).alias("words"), lines.alias("lines"),
        F.length(F.translate(t, WHITE, "")).alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).alias("n_symbols"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).alias("n_upper"))
    two = one.select(
        key, "word_chars", "n_symbols", "n_upper", F.size("words").alias("n_words"),
        F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _windows(F.col("words")).alias("windows"))
    values = {"n_repeat_words": _covered(F.col("windows"))}
    # as a generated row, so that no filter on a measurement is pushed into the making of it
    row = F.struct(*(values.get(m, F.col(m)).cast("long").alias(m) for m in MEASURES))
    return two.select(key, F.inline(F.array(row)))


def ledger(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key``, the measurements and ``bits``: bit i is set where rule i fails."""
    bits = F.lit(0).cast("long")
    for rule, fails in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(fails), BIT[rule]).otherwise(0).cast("long"))
    return measure(docs, text, key).withColumn("bits", bits)


def kept(policy: Policy, bits: str = "bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def apply_policies(book: DataFrame, policies: list[Policy]) -> DataFrame:
    """One row per document and policy: ``doc_id, policy, version, kept``."""
    verdicts = F.array(*(F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"),
                                  kept(p).alias("kept")) for p in policies))
    return book.select("doc_id", F.explode(verdicts).alias("v")).select("doc_id", "v.*")


def ablations(book: DataFrame, policy: Policy) -> DataFrame:
    """What each rule of a policy does: ``rule, failed`` (documents that fail it),
    ``only`` (rejected by it alone, so kept without it) and ``kept_without``.
    Documents are first counted by bit pattern (at most 2**rules rows)."""
    patterns = book.groupBy("bits").agg(F.count("*").alias("n"))
    hit = F.col("bits").bitwiseAND(F.lit(policy.mask).cast("long"))
    rows = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit"))
                               for r in policy.rules)))
    flat = patterns.select(hit.alias("hit"), "n", rows.alias("r")).select("hit", "n", "r.*")
    count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    return flat.groupBy("rule").agg(
        count(F.col("hit").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        count(F.col("hit") == F.col("bit")).alias("only"),
        count(F.col("hit").bitwiseAND(F.bitwise_not("bit")) == 0).alias("kept_without"))
