import random
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from docweave.llm import bit_sliced, residual_packing
from docweave.llm.common import ready

from . import brute
from ..conftest import SF001


# -- top-k

def best(rows, queries, k):
    out = []
    for q, v in queries:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(-9, 9), min_size=3, max_size=3), min_size=1, max_size=90),
       st.lists(st.integers(-70, 70), min_size=3, max_size=3), st.integers(1, 8))
def test_block_against_brute_force(vectors, query, k):
    block = bit_sliced.Block(np.arange(len(vectors)), np.array(vectors, np.int64))
    ids, scores = block.top(2, np.array(query), k)
    got = sorted(zip((-scores).tolist(), ids.tolist()))
    assert [(2, r, i, -s) for r, (s, i) in enumerate(got[:k], 1)] == best(list(enumerate(vectors)), [(2, query)], k)


def test_top_k_with_ties_small_blocks_and_lengths(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randint(-3, 3) for _ in range(5)]) for i in range(300)] + [(7, [1] * 5), (900, [2, 2]), (901, [1, 2])]
    table = ready(spark).createDataFrame(rows, "id long, v array<long>")
    queries = [(i, v) for i, v in rows if i % 20 == 0]
    got = bit_sliced.top_k(table, table.where("id % 20 = 0"), 6, row_block=64, query_block=4).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == best(rows, queries, 6)
    assert bit_sliced.top_k(table.where("false"), table.where("false")).count() == 0


def test_unusable_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [0.5, 1.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [1.0, -inf]), (5, [-0.01, 0.02]), (6, [])]
    t = spark.createDataFrame(rows, "i long, e array<float>")
    got = t.where(bit_sliced.usable(F.col("e"))).select("i", bit_sliced.quantise(64)(F.col("e")).alias("v")).collect()
    assert {r.i: r.v for r in got} == {0: [32, 64], 5: [-1, 1], 6: []}


# -- packing

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_fills_bins_gaplessly(lengths):
    a = np.array(lengths, np.int64)
    bins, at, fill = residual_packing.best_fit(a, 20)
    for b in range(len(fill)):
        mine = np.flatnonzero(bins == b)
        order = mine[np.argsort(at[mine])]
        assert at[order].tolist() == (np.cumsum(a[order]) - a[order]).tolist() and a[mine].sum() == fill[b] <= 20
    assert len(fill) <= 1 or (np.sort(fill)[:2].sum() > 20 or len(fill) == 1)


def check_packing(rows, size, n_tokens):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= size
    assert sum(r.length for r in rows) == n_tokens
    return len(bins)


def test_pieces_and_sequences_of_awkward_documents(spark):
    from tokenizers import Tokenizer
    path = __import__("public_tokenizers").path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    docs = ready(spark).createDataFrame(brute.awkward(), brute.SCHEMA).repartition(5)
    rows = residual_packing.pack_documents(docs, path, 64, partition_pieces=40, group_bins=50).collect()
    want = []
    for r in brute.awkward():
        ids = [*tok.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), 64)):
            part = ids[a:a + 64]
            want.append(str((r[0], k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))))
    assert sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows) == sorted(want)
    n = sum(r.length for r in rows)
    assert check_packing(rows, 64, n) <= 1.05 * -(-n // 64) + 1
    assert residual_packing.pack_documents(docs.where("false"), path).count() == 0


def test_rounds_merge_what_partitions_leave(spark):
    rng = random.Random(3)
    rows = [(i, 0, rng.choice((30, 40, 70, 100))) for i in range(900)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, length long").repartition(30)
    out = residual_packing.pack(pieces, 100, slack=0).collect()
    n = sum(r[2] for r in rows)
    whole = residual_packing.best_fit(np.array([r[2] for r in rows]), 100)[2]       # all in one task
    assert check_packing(out, 100, n) <= 1.02 * len(whole) + 2


def test_encoder_is_exact():
    from tokenizers import Tokenizer
    path = __import__("public_tokenizers").path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    rng = random.Random(2)
    alphabet = "aZéÉßÑñ019'.,!?<|>_\"&ÿŒΣσςİıK  \n\t 　́å日٣½ªº×"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(800)] + ["<|endoftext|>", "don't DON'T"]
    got = residual_packing.WordEncoder(path, 300).encode(texts)
    assert got == [np.array([*tok.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes() for t in texts]


def test_encoder_asks_for_no_offsets():
    class Plain:
        """The tokenizer without its slow ``encode``."""
        def __init__(self, tok):
            self.encode_batch_fast = tok.encode_batch_fast

    path = __import__("public_tokenizers").path("word_bpe_49k.json")
    enc = residual_packing.WordEncoder(path)
    texts = ["a b c " * 700, "Word wordier, w0rd!", "don't 日本 x"]
    want = enc.encode(texts)
    enc = residual_packing.WordEncoder(path)
    enc.tok = Plain(enc.tok)
    assert enc.encode(texts) == want


# -- twins

@pytest.mark.parametrize("name", ["op1_exact_top_k", "op2_chat_formatting", "op4_quality_rules", "op5_substring_dedup"])
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    cur = con.execute(E.oracle_sql()[name])
    cols = sorted(c[0] for c in cur.description)
    at = [[c[0] for c in cur.description].index(c) for c in cols]
    df = E.queries()[name](spark, SF001)
    assert cols == sorted(df.columns)
    assert sorted(str([r[c] for c in cols]) for r in df.collect()) == sorted(str([r[i] for i in at]) for r in cur.fetchall())
