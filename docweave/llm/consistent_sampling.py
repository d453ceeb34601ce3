"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A text is its terms with weights: its five-word shingles (one of all words, if it has
fewer) and how often it holds each.  For every term and each of ``SAMPLES`` samples, a
keyed hash gives r and c, distributed as Gamma(2, 1), and a uniform b.  With
``t = floor(ln(weight) / r + b)``, the term's value is ``a = c * exp(-r * (t - b + 1))``:
exponentially distributed at the rate of its weight, and the same for all weights
between two steps of t.  The term of the least value is the sample.  Two texts agree
in a sample with the probability of their generalised Jaccard similarity (sum of the
smaller weights / sum of the larger), so the share of equal samples estimates it.

A fingerprint holds four hexadecimal digits per sample, a hash of the least value
(which names term and step).  Values that cannot be the least are not worked out: the
least of a text of weight W is above 40 / W with probability exp(-40), and a bound by
products, without logarithms, tells most values beyond.

All is Spark SQL without Python.  Texts move once, dealt by (doc_id, hash of the
text); what a document takes from the next is then sent to it, and everything else is
grouped where it lies.  The order of documents is worked out on ids alone.

Edge cases: a null text counts as empty; a text without words has a fingerprint of its
own, equal for all such texts; equal texts have equal fingerprints; rows that repeat
doc_id and text are one document in the order, and each of them gives a row; different
texts of one doc_id stand in the order of their hashes; a null doc_id comes last (the
least long integer is taken for null); a document alone is its own next; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import durable

SAMPLES = 64
SHINGLE = 5
#: Samples that one aggregation row holds.
GROUP = 8
DIGITS = 4
WHITE = " \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"
NULL_ID = -(1 << 63)


# -- terms ----------------------------------------------------------------------

def with_terms(texts: DataFrame, text: str) -> DataFrame:
    """``texts`` without ``text`` but with ``terms``: array of (term, weight), sorted by
    term, and ``total``, the sum of weights.  Row-local."""
    rest = [c for c in texts.columns if c != text]
    trimmed = F.btrim(text, F.lit(WHITE))
    words = texts.select(*rest, F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPLIT)).alias("_w"))
    # the hash of a slice, without making the slice
    windows = F.transform(F.sequence(F.lit(0), F.size("_w") - SHINGLE), lambda i: F.xxhash64(*(F.get("_w", i + k) for k in range(SHINGLE))))
    hashed = words.select(*rest, F.when(F.size("_w") >= SHINGLE, windows).when(F.size("_w") > 0, F.array(F.xxhash64("_w")))
                          .otherwise(F.array().cast("array<long>")).alias("_h"))
    ordered = hashed.select(*rest, F.sort_array("_h").alias("_h"))
    changes = F.filter(F.sequence(F.lit(0), F.size("_h") - 1), lambda i: (i == 0) | (F.get("_h", i) != F.get("_h", i - 1)))
    begun = ordered.select(*rest, "_h", F.when(F.size("_h") > 0, changes).otherwise(F.array().cast("array<int>")).alias("_s"))
    terms = F.transform("_s", lambda s, j: F.struct(
        F.get("_h", s).alias("term"), (F.coalesce(F.get("_s", j + 1), F.size("_h")) - s).cast("double").alias("weight")))
    return begun.select(*rest, F.size("_h").alias("total"), terms.alias("terms"))


# -- samples --------------------------------------------------------------------

def value(term: Column, weight: Column, limit: Column, sample: Column) -> Column:
    """A term's value in a sample; null if it is surely not below ``limit``.  The 64
    bits of one hash are five uniform numbers."""
    bits = F.xxhash64(term, sample)

    def uniform(shift: int, n: int) -> Column:
        return F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << n) - 1)) + 0.5
    both = uniform(51, 13) * uniform(38, 13) * 2.0 ** -26          # exp(-r)
    b = uniform(26, 12) * 2.0 ** -12
    rest = uniform(13, 13) * uniform(0, 13) * 2.0 ** -26           # exp(-c)
    r, c = -F.log(both), -F.log(rest)
    step = F.floor(F.log(weight) / r + b)
    # c >= 2 * (1 - exp(-c)) / (1 + exp(-c)); exp(-r * (t - b + 1)) is exp(-r) ** (1 - b) >= exp(-r) / (exp(-r) + (1 - b) * (1 - exp(-r)))
    # at weight 1, and >= exp(-r) / weight at any
    near = (1 - rest) * both < limit * (0.5 + 0.5 * rest) * F.when(weight > 1, weight).otherwise(both + (1 - b) * (1 - both))
    return F.when(near, c * F.exp(-r * (step - b + 1)))


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and ``fingerprint`` of ``text``; the keys name a row.  Shuffles nothing
    if the rows are already dealt by some of the keys."""
    groups = SAMPLES // GROUP
    flat = (with_terms(texts.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("_t")), "_t")
            .select(*keys, (40.0 / F.nullif("total", F.lit(0))).alias("limit"), F.explode_outer("terms").alias("x"))
            .select(*keys, "limit", "x.*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")))
    least = flat.groupBy(*keys, "group").agg(*(
        F.min(value(F.col("term"), F.col("weight"), F.col("limit"), F.col("group") * GROUP + j)).alias(f"a{j}") for j in range(GROUP)))
    digits = F.concat(*(F.lpad(F.hex(F.pmod(F.xxhash64(f"a{j}"), F.lit(16 ** DIGITS))), DIGITS, "0") for j in range(GROUP)))
    parts = least.select(*keys, F.struct("group", digits.alias("digits")).alias("part"))
    in_order = F.transform(F.sort_array(F.collect_list("part")), lambda p: p["digits"])
    return parts.groupBy(*keys).agg(F.array_join(in_order, "").alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples of two fingerprints, 0 to 1."""
    same = F.filter(F.sequence(F.lit(0), F.lit(SAMPLES - 1)),
                    lambda i: F.substr(a, i * DIGITS + 1, F.lit(DIGITS)) == F.substr(b, i * DIGITS + 1, F.lit(DIGITS)))
    return F.size(same) / F.lit(float(SAMPLES))


# -- the next document --------------------------------------------------------------

def order_of(docs: DataFrame) -> DataFrame:
    """Distinct ``(id, h)`` by descending id, then h: ``id, h, n_chars, copies, place``
    (0, 1, ...).  Places come from range partitions and the sizes of those before."""
    ids = docs.groupBy("id", "h").agg(F.max("n_chars").alias("n_chars"), F.count("*").alias("copies"))
    by = [F.col("id").desc(), F.col("h")]
    dealt = durable(ids.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id())
                    .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    before = dealt.groupBy("part").agg(F.count("*").alias("n")).select(       # a row for each partition
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return dealt.join(before, "part").select("id", "h", "n_chars", "copies", (F.col("before") + F.col("at")).alias("place"))


def links_of(docs: DataFrame) -> DataFrame:
    """``order_of`` with the document before (``before_id, before_h``; of the first: the
    last) and how many code points it takes from this one."""
    order = durable(order_of(docs))
    n = order.count()
    after = order.select(F.pmod(F.col("place") + 1, F.lit(max(1, n))).alias("place"), F.col("id").alias("before_id"),
                         F.col("h").alias("before_h"), F.expr("n_chars div 2").alias("taken"))
    return durable(order.join(after, "place"))


def with_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of ``docs(doc_id, text)`` and of each text whose last half (rounded
    down) of code points is replaced by as many first ones of the next document, by
    descending doc_id: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``."""
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    links = links_of(keyed.select("id", "h", F.length("text").cast("long").alias("n_chars")))
    rows = keyed.dropDuplicates(["id", "h"]).join(links, ["id", "h"])
    heads = F.substr("text", F.lit(1), (F.col("n_chars") - F.expr("n_chars div 2")).cast("int"))
    sent = rows.select(F.col("before_id").alias("id"), F.col("before_h").alias("h"), F.substr("text", F.lit(1), F.col("taken").cast("int")).alias("tail"))
    both = rows.select("id", "h", "n_chars", "text").join(sent, ["id", "h"]).select("id", "h", "text", F.concat(heads, F.col("tail")).alias("edited"))
    found = fingerprints(both.select("id", "h", F.posexplode(F.array("text", "edited")).alias("which", "text")), ["id", "h", "which"])
    pick = lambda which: F.max(F.when(F.col("which") == which, F.unhex("fingerprint")))
    pair = found.groupBy("id", "h").agg(pick(0).alias("fingerprint"), pick(1).alias("edited_fingerprint"))
    digests = both.select("id", "h", F.unhex(F.sha2(F.encode("edited", "UTF-8"), 256)).alias("digest"))
    known = links.select("id", "h", "n_chars", "copies", "before_id", "before_h")
    done = durable(pair.join(digests, ["id", "h"]).join(known, ["id", "h"]))
    following = done.select(F.col("before_id").alias("id"), F.col("before_h").alias("h"), F.col("fingerprint").alias("next"))
    out = done.join(following, ["id", "h"]).withColumns({c: F.hex(c) for c in ("fingerprint", "edited_fingerprint", "next")})
    return out.select(
        F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), "n_chars", F.lower(F.hex("digest")).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).drop("copy")
