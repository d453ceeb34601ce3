"""Plain-Python versions of the operators, and awkward documents."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, chunk string, bits long, words string, label string, `row` long, n_words string"


def awkward(seed: int = 3) -> list[tuple]:
    """Nulls, empty, long and repeated texts, ties, shared passages, clashing columns."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    passage, base = text(60), text(120)
    near = base.split()
    near[50] = "changed"
    texts = [None, "", " \n\t ", "one", "x y z", base, base, " ".join(near), passage + "\n" + text(80), text(70) + " " + passage,
             text(6000) + " " + passage + " " + text(6000), "again " * 90, text(34), text(35), " nb sp▁",
             "q" * 5000, text(40) + "\n" + text(40), base, "日本語 テキスト"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, base), (None, passage), (7, None), (40, text(200))]
    return [(i, t, "en", "c", 9, "w", "l", 1, "n") for i, t in rows]


def words(text):
    return (text or "").encode().split()


def repeated_windows(texts, window):
    """(words, flags of removed words) per text."""
    split = [words(t) for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((w, gone))
    return out


def repeated_strings(texts, size):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + size] for r in raw for i in range(len(r) - size + 1))
    out = []
    for r in raw:
        gone = [False] * len(r)
        for i in range(len(r) - size + 1):
            if seen[r[i:i + size]] > 1:
                gone[i:i + size] = [True] * size
        out.append((r, gone))
    return out


def near_classes(rows, least=0.8, size=5):
    """Class (least index) of each (doc_id, text) under weighted Jaccard of tf-idf shingles."""
    bags = []
    for _, t in rows:
        w = words(t)
        bags.append(Counter(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter())
    df = Counter(g for b in bags for g in b)
    idf = {g: math.log((len(rows) + 1) / n) for g, n in df.items()}
    weight = [sum(n * idf[g] for g, n in b.items()) for b in bags]
    holds = defaultdict(list)
    for i, b in enumerate(bags):
        for g in b:
            holds[g].append(i)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, b in enumerate(bags):
        for j in {j for g in b for j in holds[g] if j > i}:
            inter = sum(min(n, bags[j][g]) * idf[g] for g, n in b.items())
            if inter >= least * (weight[i] + weight[j] - inter) - 1e-9:
                a, c = sorted((find(i), find(j)))
                parent[c] = a
    return [find(i) for i in range(len(rows))]


def agrees_with_sql(spark, name, sf_dir="/root/testdata/sf0.001"):
    """A registered query and its SQL twin give the same rows."""
    import duckdb

    from docweave.llm import queries  # noqa: F401
    from docweave.llm.registry import ORACLE, QUERIES
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    cols = sorted(c[0] for c in cur.description)
    at = [[c[0] for c in cur.description].index(c) for c in cols]
    df = QUERIES[name](spark, sf_dir)
    assert cols == sorted(df.columns)
    show = lambda v: f"{v:.9f}" if isinstance(v, float) else str(v)
    assert sorted(tuple(show(r[c]) for c in cols) for r in df.collect()) == sorted(tuple(show(r[i]) for i in at) for r in cur.fetchall())
