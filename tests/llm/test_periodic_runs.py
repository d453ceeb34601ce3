"""Periodic runs against a plain search over all periods."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from docweave.llm import periodic_runs

from . import brute


def plain_runs(w, least, exponent):
    out, n = {}, len(w)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q):
                out.setdefault((i, j - i + q), q)
            i = j
    return sorted(((s, l, q) for (s, l), q in out.items()), key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


WORDS = st.one_of(
    st.lists(st.sampled_from("ab"), max_size=40),
    st.tuples(st.lists(st.sampled_from("abcd"), max_size=6), st.lists(st.sampled_from("abcd"), min_size=1, max_size=7),
              st.integers(1, 8), st.lists(st.sampled_from("abcd"), max_size=6)).map(lambda t: t[0] + t[1] * t[2] + t[1][:2] + t[3]))


@settings(max_examples=300, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=4), st.integers(2, 9), st.integers(2, 5))
def test_runs_against_brute_force(texts, least, exponent):
    """With and without cutting out what cannot hold a run."""
    want = [plain_runs(w, least, exponent) for w in texts]
    assert [periodic_runs.runs_of([ord(x) for x in w], least, exponent) for w in texts] == want
    part = periodic_runs.Texts([" \n".join(w).encode() for w in texts])
    assert part.runs(least, exponent) == want
    assert [part.collapsed(i, r).decode() for i, r in enumerate(want)] == [collapsed(w, r) for w, r in zip(texts, want)]


def test_every_square_has_its_smallest_period():
    rng = random.Random(3)
    for _ in range(60):
        s = [rng.randint(0, 1) for _ in range(60)]
        found = set(periodic_runs.squares(s))
        for end, d in found:
            assert s[end - 2 * d + 1:end - d + 1] == s[end - d + 1:end + 1]
        for end in range(60):
            for d in range(1, (end + 1) // 2 + 1):
                u = s[end - d + 1:end + 1]
                power = any(d % k == 0 and u == u[:k] * (d // k) for k in range(1, d))
                assert ((end, d) in found) == (s[end - 2 * d + 1:end - d + 1] == u and not power)


def test_awkward_documents(spark):
    rows = brute.awkward() + [(50, "x " * 7 + "y " + "a b c " * 5, "en", "c", 9, "w", "l", 1, "n")]
    docs = spark.createDataFrame(rows, brute.SCHEMA)
    clashing = docs.withColumn("runs", docs.label).withColumn("collapsed", docs.bits).withColumn("_text", docs.lang)
    out = periodic_runs.find_runs(clashing, group_bytes=3000)
    want = []
    for r in rows:
        w = (r[1] or "").encode().split()
        w = [x.decode() for x in w]
        runs = plain_runs(w, 6, 4)
        want.append((r[0], len(w), runs, collapsed(w, runs)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert periodic_runs.find_runs(docs.where("false")).count() == 0


def test_words_longer_than_a_slice_and_cut_between_words(monkeypatch):
    monkeypatch.setattr(periodic_runs, "SLICE", 7)
    text = b"aa bb  cc\tdddddddddddd aa bb cc dddddddddddd " * 5
    assert [w for s in periodic_runs.word_slices(text) for w in s] == text.split()
    part = periodic_runs.Texts([text])
    assert part.runs(6, 4) == [[(0, 40, 4)]] and part.collapsed(0, [(0, 40, 4)]) == b"aa bb cc dddddddddddd"


def test_sql_twin(spark):
    brute.agrees_with_sql(spark, "op11_periodic_runs")
