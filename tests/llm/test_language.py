"""Language mixtures against expectation-maximisation written out over dictionaries."""

import math
from collections import Counter

import pytest

from docweave.llm import mixture_language as ml
from docweave.llm import queries
from docweave.llm.common import table

SF = "/root/testdata/sf0.001"


def grams(text):
    b = f" {text} ".lower().encode()
    return Counter((((b[i] << 16 | b[i + 1] << 8 | b[i + 2]) * 0x9E3779B1) & 0xFFFFFFFF) >> 16 for i in range(len(b) - 2))


def fitted(n, p, langs, rounds=20):
    share, total = {x: 1 / len(langs) for x in langs}, sum(n.values())
    for _ in range(rounds if len(langs) > 1 else 0):
        new = dict.fromkeys(langs, 0.0)
        for g, k in n.items():
            mix = sum(share[x] * p[x](g) for x in langs)
            for x in langs:
                new[x] += k * share[x] * p[x](g) / mix
        share = {x: v / total for x, v in new.items()}
    return share, sum(k * math.log(sum(share[x] * p[x](g) for x in langs)) for g, k in n.items())


def predicted(text, p):
    if text is None or not any(c.isalpha() for c in text) or not p:
        return "und", 0.0, []
    n, langs = grams(text), sorted(p)
    share, fit = fitted(n, p, langs)
    while len(langs) > 1:
        least = min(langs, key=lambda x: (share[x], x))
        rest = [x for x in langs if x != least]
        less, lower = fitted(n, p, rest)
        if fit - lower > 2 * math.log(max(2.0, sum(n.values()))):
            break
        langs, share, fit = rest, less, lower
    best = max(langs, key=lambda x: share[x])
    return best, share[best], langs


def learned(rows):
    counts = {}
    for lang, text in rows:
        counts.setdefault(lang, Counter()).update(grams(text))
    def likelihood(c):
        total = sum(c.values()) + 0.5 * 65536
        return lambda g: (c[g] + 0.5) / total
    return {x: likelihood(c) for x, c in counts.items()}


def test_query_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    train = docs.where(~queries.held_out()).where("text is not null and lang is not null").select("lang", "text").collect()
    p = learned([(r.lang, r.text) for r in train])
    got = {r.doc_id: r for r in queries.op10(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got.keys() == texts.keys()
    short = [i for i, t in texts.items() if t is None or len(t) < 2500]
    assert len(short) > 100
    for i in short:
        lang, score, langs = predicted(texts[i], p)
        assert got[i].lang_pred == lang and got[i].score == pytest.approx(score, abs=1e-6)
        assert sorted(x.lang for x in got[i].languages) == langs


def test_mixed_and_awkward_texts(spark):
    rows = [("en", "the cat sat on the mat and the dog ran " * 20), ("de", "der hund und die katze sind nicht hier " * 20),
            ("fr", "le chat et le chien ne sont pas ici avec nous " * 20), (None, "ignored"), ("en", None)]
    model = ml.train(spark.createDataFrame(rows, "lang string, text string"))
    p = learned([r for r in rows if None not in r])
    texts = ["the dog and the cat " * 5 + "der hund ist nicht die katze " * 5, "le chat", "", None, "12 34", "the", "katze avec the hund " * 9, "x" * 5000]
    df = spark.createDataFrame([(i, t, "en", 1.0) for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string, score double")
    got = {r.doc_id: r for r in ml.identify(df.select("doc_id", "text"), model).collect()}
    for i, t in enumerate(texts):
        lang, score, langs = predicted(t, p)
        assert (got[i].lang_pred, sorted(x.lang for x in got[i].languages)) == (lang, langs) and got[i].score == pytest.approx(score, abs=1e-6)
    assert len(got[0].languages) > 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = ml.train(none)
    assert model.names == [] and ml.identify(none, model).count() == 0
    some = spark.createDataFrame([(1, "words")], "doc_id long, text string")
    assert [(r.lang_pred, r.score) for r in ml.identify(some, model).collect()] == [("und", 0.0)]
