import random

import numpy as np
import pytest

from docweave.llm import sketch_dedup, suffix_dedup, weighted_minhash
from docweave.llm.common import mix, run_hashes, word_hashes

from . import brute


def texts_of(rows):
    return [r[1] for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    from docweave.llm.common import ready
    ready(spark)
    return spark.createDataFrame(brute.awkward(), brute.SCHEMA)


def test_word_hashes_across_slices():
    text = ("alpha beta  gamma\n" * 50).encode()
    whole, n = word_hashes([text, b"", b"alpha"])
    cut, m = word_hashes([text, b"", b"alpha"], slice_bytes=37)
    assert (whole == cut).all() and n.tolist() == m.tolist() == [150, 0, 1]
    assert whole[0] == whole[-1] != whole[1]


@pytest.mark.parametrize("window, chunk_bytes, shard", [(35, 8 << 20, 1 << 22), (5, 4000, 1 << 8)])
def test_windows_against_brute_force(docs, window, chunk_bytes, shard):
    rows = brute.awkward()
    out = sketch_dedup.remove_repeated_windows(docs, window, chunk_bytes=chunk_bytes, shard_words=shard).collect()
    want = [(r[0], len(w), sum(g), " ".join(x.decode() for x, y in zip(w, g) if not y))
            for r, (w, g) in zip(rows, brute.repeated_windows(texts_of(rows), window))]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out])) == sorted(map(key, want))
    assert all(r.n_removed == sum(s.end - s.start for s in r.removed) for r in out)


def test_sketch_loses_no_repeat():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 5000).astype(np.uint64)
    h = np.concatenate((h, h[:40]))
    cells, cell, counts = sketch_dedup.sketch_row(h, 0, 10)          # far too narrow: only overestimates
    assert (counts[cell][:40] >= 2).all() and counts.sum() == len(h)


@pytest.mark.parametrize("size, chunk_bytes, bucket", [(200, 8 << 20, 16 << 20), (32, 3000, 2000)])
def test_strings_against_brute_force(docs, size, chunk_bytes, bucket):
    rows = brute.awkward()
    out = suffix_dedup.remove_repeated_strings(docs, size, chunk_bytes=chunk_bytes, shard=1 << 10, bucket_bytes=bucket).collect()
    want = [(r[0], len(b), bytes(x for x, y in zip(b, g) if not y), sum(g))
            for r, (b, g) in zip(rows, brute.repeated_strings(texts_of(rows), size))]
    got = [(r.doc_id, r.n_bytes, bytes(r.kept), sum(s.end - s.start for s in r.removed)) for r in out]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_multikey_order_is_the_byte_order():
    rng = random.Random(2)
    rows = [bytes(rng.choice(b"ab") for _ in range(rng.choice((3, 20, 24)))).ljust(24, b"\0") for _ in range(300)]
    order, lcp = suffix_dedup._common_bytes(np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 24))
    ranked = [rows[i] for i in order]
    assert ranked == sorted(rows)
    for a, b, n in zip(ranked, ranked[1:], lcp[1:]):
        assert a[:n] == b[:n] and (n == 24 or a[n] != b[n])


def test_near_duplicates_against_brute_force(docs):
    rows = [(r[0], r[1]) for r in brute.awkward()]
    out = weighted_minhash.near_duplicates(docs, chunk_bytes=20_000, shard_words=1 << 12, block_bytes=3000)
    classes = brute.near_classes(rows)
    ids = {}
    for (d, _), c in zip(rows, classes):
        ids.setdefault(c, []).append(d)
    least = {c: min((x for x in v if x is not None), default=None) for c, v in ids.items()}
    want = sorted(str((d, least[c], len(ids[c]))) for (d, _), c in zip(rows, classes))
    assert sorted(str((r.doc_id, r.class_id, r.n_class)) for r in out.collect()) == want
    kept = weighted_minhash.keep_firsts(docs, out)
    assert kept.columns == docs.columns and kept.count() == len(ids)


def test_large_group_of_near_copies_is_one_class(spark):
    """A chain of small changes over many blocks: ends differ, links connect them."""
    rng = random.Random(4)
    text = [f"w{rng.randint(0, 9999)}" for _ in range(200)]
    rows = []
    for i in range(120):
        text[rng.randrange(200)] = f"n{i}"
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, " ".join(f"z{rng.randint(0, 9999)}" for _ in range(150))) for i in range(30)]
    out = weighted_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=20_000)
    want = brute.near_classes(rows)
    assert {r.doc_id: r.class_id for r in out.collect()} == {d: rows[c][0] for (d, _), c in zip(rows, want)}


def test_sampling_agrees_as_often_as_the_similarity():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 2**63, 900).astype(np.uint64)
    w = rng.uniform(0.5, 6, 900)
    a, b = slice(0, 700), slice(200, 900)
    wb = w.copy()
    wb[300:400] *= 1.5
    inter = np.minimum(w, wb)[200:700].sum()
    similarity = inter / (w[a].sum() + wb[b].sum() - inter)
    agree = np.mean([(weighted_minhash.icws(h[a], w[a], 512, s) == weighted_minhash.icws(h[b], wb[b], 512, s)).mean() for s in range(6)])
    assert abs(agree - similarity) < 0.03


def test_empty_tables(spark, docs):
    none = docs.where("false")
    assert sketch_dedup.remove_repeated_windows(none).count() == 0
    assert suffix_dedup.remove_repeated_strings(none).count() == 0
    assert weighted_minhash.near_duplicates(none).count() == 0


def test_blocks_are_bounded_by_rows_too(spark, docs):
    short = spark.range(9000).selectExpr("cast('c' as binary) label", "96L size")
    assert weighted_minhash.blocks_of(short, 2 << 20, 2000).head().blocks == 5
    long = spark.range(30).selectExpr("cast('c' as binary) label", "1000000L size")
    assert weighted_minhash.blocks_of(long, 2 << 20, 2000).head().blocks == 15
    rows = [(i, " ".join(f"w{k}" for k in range(150)) + f" end{i}") for i in range(120)]
    rows += [(1000 + i, " ".join(f"x{i}y{k}" for k in range(10))) for i in range(600)]
    near = spark.createDataFrame(rows, "doc_id long, text string")
    few, one = ({(r.doc_id, r.class_id, r.n_class) for r in weighted_minhash.near_duplicates(near, block_rows=n).collect()}
                for n in (20, 2000))
    assert few == one == {(i, 0, 120) for i in range(120)} | {(1000 + i, 1000 + i, 1) for i in range(600)}


def test_words_that_collide_in_polynomial_hashes(spark):
    """Thue-Morse words and their complements: 35 of them in two texts, none repeats."""
    a = "a"
    while len(a) < 4096:
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    hashes = [word_hashes([x.encode()], seed=s)[0][0] for x in (a, b, a[:40], b[:40]) for s in (0, 1)]
    assert len(set(hashes)) == len(hashes)
    one, two = f"{a} " * 34 + a, f"{a} " * 34 + b
    out = sketch_dedup.remove_repeated_windows(spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string"))
    assert {r.doc_id: r.n_removed for r in out.collect()} == {1: 0, 2: 0}


def test_windows_are_told_apart_by_both_hashes():
    w = sketch_dedup.Windows([b"a b c d a b x d"], 2)
    h2 = w.second(np.arange(len(w.h1)))
    assert w.among(w.h1[[1, 1]], h2[[0, 1]]).tolist() == [1]
    assert w.among(w.h1[:1], h2[:1]).tolist() == [0, 4] and not len(w.among(w.h1[:1], h2[1:2]))


def test_word_hashes_depend_on_every_byte():
    rng = random.Random(6)
    words = {bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(1, 70))) for _ in range(4000)}
    hashes, n = word_hashes([b" ".join(words)])
    assert n.tolist() == [len(words)] and len(set(hashes.tolist())) == len(words)
    assert [h for w in words for h in word_hashes([w])[0].tolist()] == hashes.tolist()


def test_strings_sql_twin(spark):
    brute.agrees_with_sql(spark, "op6_suffix_array_dedup")


def test_pieces_of_a_batch_hold_every_row_once(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(weighted_minhash, "VECTOR_BYTES", 10)
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(t, pa.string())}) for t in (["a" * 4, None, "b" * 5, "c" * 50, "d", ""], ["e" * 11], [])]
    pieces = [b.column("text").to_pylist() for b in weighted_minhash._pieces(iter(batches))]
    assert pieces == [["a" * 4, None, "b" * 5], ["c" * 50], ["d", ""], ["e" * 11], []]


def peak_of(run):
    import tracemalloc
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_run_hashes_hold_little_beside_their_result():
    words = np.random.default_rng(4).integers(0, 1 << 63, 400_000).astype(np.uint64)
    step, full = 0xD6E8FEB86659FD93, (1 << 64) - 1
    for size in (1, 5, 300):
        sums = [sum(int(w) * pow(step, k, 1 << 64) for k, w in enumerate(words[a:a + size])) & full for a in (0, 1, 70_000, len(words) - size)]
        got = run_hashes(words, size)
        assert len(got) == len(words) - size + 1
        assert [int(got[a]) for a in (0, 1, 70_000, -1)] == [int(mix(np.array([s], np.uint64))[0]) for s in sums]
        assert (got[:900] == run_hashes(words[:900 + size - 1], size, block=7)).all()
    assert peak_of(lambda: run_hashes(words, 35)) < 2.5 * words.nbytes


def test_a_pair_of_blocks_is_linked_across_only():
    import pyarrow as pa
    from docweave.llm.common import pack, pack_sorted
    rng = np.random.default_rng(5)
    base = np.sort(rng.integers(0, 1 << 63, 40).astype(np.uint64))
    h = [np.sort(np.concatenate((base[:36], rng.integers(0, 1 << 63, 1 + k % 5).astype(np.uint64)))) for k in range(700)]
    one = [np.ones(len(x), np.int64) for x in h]
    whole = weighted_minhash.similar(h, one, one, 0.85)
    assert whole.any() and not whole.all()
    assert (weighted_minhash.similar(h, one, one, 0.85, left=300) == whole[:300, 300:]).all()
    mine = [0] * 300 + [1] * 400
    tbl = pa.table({"content": [bytes([m, *divmod(k, 256)]) for k, m in enumerate(mine)], "h": [pack_sorted(x) for x in h],
                    "tf": [pack(x.astype(np.uint32)) for x in one], "df": [pack(x) for x in one], "mine": mine})
    links = weighted_minhash.link_block(700, 0.8)((pa.scalar(b"x"), pa.scalar(0), pa.scalar(1)), tbl)
    assert links.num_rows == 699 and all(a[0] != b[0] for a, b in zip(*(links.column(c).to_pylist() for c in "ab")))
    whole_peak, pair_peak = (peak_of(lambda: weighted_minhash.similar(h * 2, one * 2, one * 2, 0.8, slab=64, left=left)) for left in (None, 700))
    assert pair_peak < 0.6 * whole_peak
