"""Fingerprints against the similarity they estimate, and edited texts by hand."""

import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from docweave.llm import consistent_sampling as cs

from . import brute


def weights(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def jaccard(a, b):
    a, b = weights(a), weights(b)
    keys = a.keys() | b.keys()
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys) if keys else 1.0


def test_terms_and_weights(spark):
    texts = ["", " \n", "one two", "a b c d e", "x y " * 20, "p q r s t u v w x", "é f g\x0bh\x1ci j k l m"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in cs.with_terms(df, "t").collect():
        want = weights(texts[r.i])
        assert sorted(t.weight for t in r.terms) == sorted(want.values()) and r.total == sum(want.values())
        assert [t.term for t in r.terms] == sorted({t.term for t in r.terms})


def test_bound_never_drops_a_value_below_the_limit(spark):
    df = spark.range(40_000).select(F.xxhash64("id").alias("term"), (1 + F.col("id") % 7 * (F.col("id") % 2)).cast("double").alias("weight"), (F.col("id") % 64).cast("int").alias("j"))
    both = df.select("weight", cs.value(F.col("term"), F.col("weight"), F.lit(1e9), F.col("j")).alias("all"),
                     cs.value(F.col("term"), F.col("weight"), F.lit(0.05), F.col("j")).alias("near")).collect()
    assert all(r["all"] is not None for r in both)
    assert all(r.near == r["all"] for r in both if r["all"] < 0.05) and any(r.near is None for r in both)
    for w in (1.0, 7.0):                                # exponential at the rate of the weight
        got = [r["all"] for r in both if r.weight == w]
        assert abs(sum(got) / len(got) * w - 1) < 0.05
        assert abs(sum(x * w > 1 for x in got) / len(got) - 0.3679) < 0.03


def test_windows_are_hashed_without_slices_and_values_are_exact(spark):
    texts = ["a b c d e f g", "x y " * 20, "one two", "é f g\x0bh\x1ci j k l m"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    terms = cs.with_terms(df, "t")
    assert "slice(" not in terms._jdf.queryExecution().optimizedPlan().toString()
    words = df.select("i", F.split(F.btrim("t", F.lit(cs.WHITE)), cs.SPLIT).alias("w"))
    sliced = words.where(F.size("w") >= 5).select("i", F.explode(F.sequence(F.lit(1), F.size("w") - 4)).alias("at"), "w")
    want = {(r.i, r.h) for r in sliced.select("i", F.xxhash64(F.slice("w", F.col("at"), 5)).alias("h")).collect()}
    got = {(r.i, t.term) for r in terms.collect() for t in r.terms}
    assert want == {x for x in got if x[0] != 2}

    one = spark.range(5000).select(F.xxhash64("id").alias("t"), F.lit(1.0).alias("w"))
    bits = F.xxhash64("t", F.lit(3))
    u = lambda shift, n: F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << n) - 1)) + 0.5
    r, c = -F.log(u(51, 13) * u(38, 13) * 2.0 ** -26), -F.log(u(13, 13) * u(0, 13) * 2.0 ** -26)
    b = u(26, 12) * 2.0 ** -12
    plain = c * F.exp(-r * (F.floor(F.log("w") / r + b) - b + 1))
    near = one.where(cs.value(F.col("t"), F.col("w"), F.lit(0.05), F.lit(3)).isNotNull())
    assert near.count() < 2.8 * one.where(plain < 0.05).count()              # 2.4 times as many; by 1 - exp(-c) 3.3
    assert one.where(~cs.value(F.col("t"), F.col("w"), F.lit(1e9), F.lit(3)).eqNullSafe(plain)).count() == 0


def test_likeness_is_the_generalised_jaccard_similarity(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randint(0, 10**6)}"
    pairs = []
    for i in range(120):
        common = [word() for _ in range(rng.randint(5, 400))]
        a = common + [word() for _ in range(rng.randint(0, 300))]
        b = common + [word() for _ in range(rng.randint(0, 300))]
        if i % 2:                                       # weights beyond one
            a, b = a + common[:40] * rng.randint(1, 6), b + common[:40] * rng.randint(1, 6)
        pairs.append((i, " ".join(a), " ".join(b)))
    df = spark.createDataFrame(pairs, "i int, a string, b string").repartition(4, "i")
    fa, fb = (cs.fingerprints(df, ["i"], c).withColumnRenamed("fingerprint", c) for c in "ab")
    got = {r.i: r.near for r in fa.join(fb, "i").select("i", cs.likeness(F.col("a"), F.col("b")).alias("near")).collect()}
    off = [got[i] - jaccard(a, b) for i, a, b in pairs]
    assert abs(sum(off) / len(off)) < 0.015                              # 7680 samples
    assert max(map(abs, off)) < 0.28
    assert (sum(x * x for x in off) / len(off)) ** 0.5 < 0.07            # 64 samples of a share


def edited(rows):
    """(doc_id, text) -> the edited text and the next one, by descending doc_id."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    return {r: (r[1][:len(r[1]) - len(r[1]) // 2] + n[1][:len(r[1]) // 2], n[1]) for r, n in zip(order, order[1:] + order[:1])}


def test_edited_texts_and_awkward_documents(spark):
    one_each = {}
    for r in brute.awkward():
        one_each.setdefault(r[0], r)
    rows = [*one_each.values(), one_each[5], one_each[5], one_each[2]]    # repeated rows
    docs = spark.createDataFrame(rows, brute.SCHEMA).withColumn("id", F.lit("x")).withColumn("h", F.lit(1)).repartition(3)
    got = cs.with_edited(docs).collect()
    want = edited([(r[0], r[1] or "") for r in rows])
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    text = {r[0]: r[1] or "" for r in rows}
    prints = {}
    for r in got:
        t = text[r.doc_id]
        e, following = want[(r.doc_id, t)]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 256
        assert abs(r.near_edited - jaccard(t, e)) < 0.25 and abs(r.near_next - jaccard(t, following)) < 0.25
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
    assert len({r.fingerprint for r in got if not text[r.doc_id].split()}) == 1
    assert cs.with_edited(docs.where("false")).count() == 0


def test_one_document_is_its_own_next(spark):
    r = cs.with_edited(spark.createDataFrame([(3, "abcdé fg")], "doc_id long, text string")).head()
    assert r.edited_sha256 == hashlib.sha256("abcdabcd".encode()).hexdigest() and r.near_next == 1.0


def test_order_over_many_partitions(spark):
    ids = [(i * 7919 % 1000 - 500,) for i in range(1000)]
    docs = spark.createDataFrame(ids, "id long").select("id", F.lit(0).cast("long").alias("h"), F.lit(1).cast("long").alias("n_chars"))
    got = cs.order_of(docs.repartition(7)).orderBy("place").collect()
    assert [r.place for r in got] == list(range(1000)) and [r.id for r in got] == sorted((i for i, in ids), reverse=True)


def test_no_python_in_the_plan(spark):
    from docweave.llm.registry import QUERIES
    from docweave.llm import queries  # noqa: F401
    plan = QUERIES["op12_document_fingerprints"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
