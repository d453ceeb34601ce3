"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from docweave.llm import ranked_search

from . import brute

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def ranked(docs, items, k):
    held = [(i, terms(t)) for i, t in docs if terms(t)]
    n, total = len(held), sum(len(t) for _, t in held)
    df = Counter(x for _, t in held for x in set(t))
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for doc, t in held:
            tf, m = Counter(t), 10 + 90 * len(t) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (1000000000 * tf[x] // (1000 * tf[x] + 8 * m))
                    for x in set(terms(text)) if x in tf)
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(0, 39), min_size=1), st.integers(1, 50)), max_size=8), st.integers(1, 6), st.randoms())
def test_limited_accumulators_keep_the_best(lists, k, rng):
    lists = [(np.array(sorted(d)), np.array([rng.randint(1, top) for _ in d]), top) for d, top in lists]
    docs, scores, _ = ranked_search.best_of(lists, 40, k)
    total = np.zeros(40, int)
    for d, gain, _ in lists:
        total[d] += gain
    want = sorted(((-s, i) for i, s in enumerate(total.tolist()) if s))[:k]
    assert sorted(zip((-scores).tolist(), docs.tolist()))[:k] == want


def test_common_terms_make_no_accumulators():
    """Once the rare term has filled k places, the common one only updates them."""
    everywhere, rare = np.arange(5000), np.arange(0, 5000, 100)
    docs, scores, made = ranked_search.best_of([(rare, np.full(50, 90), 90), (everywhere, np.full(5000, 5), 5)], 5000, 10)
    assert made == 50 and scores.tolist() == [95] * 50 and docs.tolist() == rare.tolist()
    # a bound that can still reach the k-th best keeps them open
    assert ranked_search.best_of([(rare, np.full(50, 5), 5), (everywhere, np.full(5000, 5), 5)], 5000, 10)[2] == 5000


def test_terms():
    text = "Das Öl, ÀB a_b x y 3.5 <K>\t日本 I'm\x00z{q}"
    assert [t.decode() for t in ranked_search.terms_of(text.encode())] == terms(text)
    number = {}
    ids = ranked_search._term_numbers((text * 9).encode(), number).tolist()
    assert [list(number)[i].decode() for i in ids] == terms(text * 9)


def test_a_long_text_is_cut_between_terms(monkeypatch):
    monkeypatch.setattr(ranked_search, "SLICE", 5)
    number = {}
    ids = ranked_search._term_numbers(b"alphabet be alphabet  ce be", number).tolist()
    assert list(number) == [b"alphabet", b"be", b"ce"] and ids == [0, 1, 0, 2, 1]


def test_search_against_brute_force(spark):
    rng = random.Random(5)
    rows = brute.awkward() + [(100 + i, " ".join(rng.choice("Aa b. c d é f,g h2 i j").strip() for _ in range(rng.randint(0, 9))),
                               "en", "c", 9, "w", "l", 1, "n") for i in range(150)]
    docs = spark.createDataFrame(rows, brute.SCHEMA).withColumnRenamed("words", "terms").withColumnRenamed("label", "chunk2")
    items = [(1, "a B é"), (2, None), (3, ""), (4, "unknown-term-xyz"), (5, rows[5][1]), (5, "h2 h2 J"), (None, "again Q c"), (1, "a B é"), (6, rows[10][1])]
    queries = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(str, ranked([(r[0], r[1]) for r in rows], items, 7)))
    from docweave.llm.common import durable
    for chunk_bytes, block_terms, small in ((16 << 20, 50_000, 8 << 20), (2000, 40, 0)):
        index = durable(ranked_search.build_index(docs.repartition(3), chunk_bytes))
        got = ranked_search.search(index, queries, 7, block_terms, small).collect()
        assert sorted(str((r.item_id, r["rank"], r.doc_id, r.score)) for r in got) == want
    none = durable(ranked_search.build_index(docs.where("false")))
    assert none.count() == 0 and ranked_search.search(none, queries, 7).count() == 0
    assert ranked_search.search(index, queries.where("false"), 7).count() == 0


def test_sql_twin(spark):
    brute.agrees_with_sql(spark, "op13_ranked_lexical_search")
