import math

import numpy as np
import pytest

from docweave.llm import chat_examples, dropout_pieces, mixture_language, rule_ledger, template_extract
from docweave.llm.common import ready

from . import brute


@pytest.fixture(scope="module")
def docs(spark):
    return ready(spark).createDataFrame(brute.awkward(), brute.SCHEMA)


# -- rule ledger

def measured(text):
    t = text or ""
    w = [x.decode() for x in brute.words(t)]
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    again = {p for i, g in enumerate(tri) if tri.count(g) > 1 for p in (i, i + 1, i + 2)} if len(w) < 1000 else None
    lines = [x for x in t.split("\n") if x.strip(" \t\r\x0b\x0c")]
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), None if again is None else len(again)


def test_ledger_against_brute_force(spark, docs):
    extra = [(100 + i, t) for i, t in enumerate(["a b c a b c x", "#tag\n#tag\n  #tag", "A\nB\nA\nA\n\n\n", "x" * 300, "LOUD " * 60, "a a a a"])]
    rows = [(r[0], r[1]) for r in brute.awkward()] + extra
    book = rule_ledger.ledger(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words if r.n_words < 1000 else None)) for r in book)
    assert got == sorted(str((d, *measured(t))) for d, t in rows)
    for r in book:
        assert bool(r.bits & 1) == (r.n_words < 50) and bool(r.bits & 2) == (100 * r.n_repeat_words > 50 * r.n_words)


def test_policies_and_ablations(docs):
    book = rule_ledger.ledger(docs).persist()
    strict, lax = rule_ledger.STANDARD, rule_ledger.Policy("lax", 2, ("repeated_words",))
    bits = [r.bits for r in book.collect()]
    got = rule_ledger.apply_policies(book, [strict, lax]).groupBy("policy", "version", "kept").count().collect()
    assert {(r.policy, r.version, r.kept): r["count"] for r in got} == {
        (p.name, p.version, k): n for p in (strict, lax) for k in (True, False) if (n := sum((b & p.mask == 0) == k for b in bits))}
    for r in rule_ledger.ablations(book, strict).collect():
        bit = rule_ledger.BIT[r.rule]
        assert r.failed == sum(b & bit != 0 for b in bits) and r.only == sum(b & strict.mask == bit for b in bits)
        assert r.kept_without == sum(b & strict.mask & ~bit == 0 for b in bits)
    book.unpersist()


def test_ledger_plan_is_native(docs):
    plan = rule_ledger.ledger(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Arrow" not in plan and "Python" not in plan


# -- chat

TURNS = [(1, 0, "system", "be <|im_end|>"), (1, 1, "user", "hi\n<\\|x"), (1, 2, "assistant", "<\\\\|im_start|> yo"),
         (1, 3, "user", None), (1, 4, "assistant", ""), (1, 5, "user", "bye"), (2, 0, "user", "alone"),
         (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (None, 0, None, "no role"), (4, 1, "a\nb\\n", "x"), (4, 0, "assistant", "é日")]


def test_examples_hold_context_and_one_reply(spark):
    ready(spark)
    turns = spark.createDataFrame([(*t, "clash") for t in TURNS], "conv_id long, turn long, role string, text string, loss string")
    made = chat_examples.expand(turns).collect()
    one = sorted((r for r in made if r.conv_id == 1), key=lambda r: r.example)
    assert [r.n_turns for r in one] == [3, 5, 6] and [len(r.loss) for r in one] == [1, 1, 0]
    assert chat_examples.unescape(one[0].text[one[0].loss[0].start:one[0].loss[0].end]) == "<\\\\|im_start|> yo"
    back = {r.conv_id: r for r in chat_examples.read_back(chat_examples.expand(turns)).collect()}
    assert set(back) == {1, 2, 3, 4, None}
    for conv, r in back.items():
        rows = sorted(((t[1], t[2] or "", t[3] or "") for t in TURNS if t[0] == conv))
        assert r.transcript == "".join(f"{role}\n{text}\n" for _, role, text in rows) and r.n_turns == len(rows)
        assert r.loss_text == "".join(text for _, role, text in rows if role == "assistant")
    assert chat_examples.expand(turns.where("false")).count() == 0


@pytest.mark.parametrize("text", ["<|", "<\\|", "<\\\\|a<|b", "\\", "<", "|>", "<|im_end|><|im_start|>assistant ok"])
def test_escape_is_reversible(text):
    assert chat_examples.unescape(chat_examples.escape(text)) == text and "<|" not in chat_examples.escape(text)


# -- pieces

def model_path():
    return __import__("public_tokenizers").path("piece_bpe_32k.model")


def test_pieces_without_dropout_are_the_library_s():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path())
    plain = dropout_pieces.Pieces(model_path(), 0)
    for t in [r[1] for r in brute.awkward() if r[1] and "▁" not in r[1]] + ["  two  blanks ", "\n\n", "naïve (x), can't 12.5%"]:
        assert np.frombuffer(plain.encode(t), "<i4").tolist() == sp.encode(t)


def test_dropout_is_seeded_varied_and_lossless(spark, docs):
    out = [{r.doc_id: (r.ids, r.text) for r in dropout_pieces.decode(dropout_pieces.encode(docs, model_path(), 0.3, seed), model_path())
            .collect() if r.doc_id not in (None, 5, 7)} for seed in (1, 1, 2)]
    texts = {r[0]: r[1] for r in brute.awkward() if r[0] not in (None, 5, 7)}
    assert {d: t for d, (_, t) in out[0].items()} == texts and {d: t for d, (_, t) in out[2].items()} == texts
    assert out[0] == out[1] and out[0][8][0] != out[2][8][0]
    assert out[0][0][0] is None and out[0][1][0] == []
    model = dropout_pieces.Pieces(model_path(), 0.3, 1)
    legal = set(model.id.values()) | set(model.byte.values())
    assert all(set(ids or []) <= legal for ids, _ in out[0].values())


def test_every_occurrence_of_a_word_draws_anew():
    model = dropout_pieces.Pieces(model_path(), 0.1, 3)
    word = " station"
    plain = dropout_pieces.Pieces(model_path(), 0)
    whole, rng = plain._ids(word), np.random.default_rng(1)
    share = np.mean([plain._ids(word, lambda event: rng.random() < 0.1) == whole for _ in range(5000)])
    one = model.encode(word[1:] + word * 4999)             # one text, and many
    assert len(whole) == 4 and abs(np.mean(np.frombuffer(one, "<i4") == np.frombuffer(whole, "<i4")) * len(one) / 20_000 - share) < 0.03
    many = {i: model.encode(f"{i}" + word) for i in range(3000)}
    assert abs(np.mean([x[-4:] == whole for x in many.values()]) - share) < 0.04
    cuts = {tuple(model.spell[i] for i in np.frombuffer(model.encode("\n" * (k + 1) + word[1:]), "<i4") if model.spell[i] != b"\n")
            for k in range(500)}
    assert len(cuts) > 4
    few = dropout_pieces.Pieces(model_path(), 0.1, 3, max_nodes=1)       # what is remembered does not matter
    text = word * 50 + " caffè▁ñandú " + "x" * 60 + " 日本 station"
    assert model.encode(text) == few.encode(text) == few.encode(text)
    # draws occurrence by occurrence, without nodes
    words = model.words.findall(" " + text)
    key = dropout_pieces.xxhash.xxh64_intdigest(text.encode(), 3)
    mine = [dropout_pieces.scatter((k + 1) * dropout_pieces.GOLDEN + key & dropout_pieces.FULL) for k in range(len(words))]
    assert model.encode(text) == b"".join(
        model._ids(w, lambda e, m=m: dropout_pieces.scatter(m ^ e) < model.bar) for w, m in zip(words, mine))
    assert model.decode(np.frombuffer(model.encode(text), "<i4").tolist()) == text


def test_forgotten_words_are_encoded_alike():
    rng = np.random.default_rng(4)
    known = ["of", "the", "station", "naïve", "日本語", "ꙮꙮ", "a▁b", "🙂ok", "\u07ff\u0800"]
    texts = [" ".join(known[k % len(known)] if k % 3 else f"w{rng.integers(9999)}" for k in rng.integers(0, 999, 400)) for _ in range(12)]
    whole = dropout_pieces.Pieces(model_path(), 0.2, 5)
    few = dropout_pieces.Pieces(model_path(), 0.2, 5, max_nodes=300)
    for t in texts:
        words = whole.words.findall(" " + t)
        key = dropout_pieces.xxhash.xxh64_intdigest(t.encode(), 5)
        mine = [dropout_pieces.scatter((k + 1) * dropout_pieces.GOLDEN + key & dropout_pieces.FULL) for k in range(len(words))]
        plain = b"".join(whole._ids(w, lambda e, m=m: dropout_pieces.scatter(m ^ e) < whole.bar) for w, m in zip(words, mine))
        assert whole.encode(t) == few.encode(t) == plain
        assert few.decode(np.frombuffer(plain, "<i4").tolist()) == t
    assert 0 < len(few.root) < len(whole.root)             # words met again stay


# -- language

def test_languages(spark):
    ready(spark)
    rng = np.random.default_rng(1)
    vocab = {"aa": ["foo", "bar", "bazo", "oof"], "bb": ["ünt", "ölk", "grä", "kmü"], "cc": ["zyx", "wvu", "xyzz", "vwx"]}
    text = lambda lang, n: " ".join(rng.choice(vocab[lang], n))
    rows = [(i, text(lang, 40), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = mixture_language.train(docs)
    assert model.names == ["aa", "bb", "cc"]
    test = [(1, text("aa", 30)), (2, text("bb", 30)), (3, text("cc", 70) + " " + text("aa", 30)), (4, None), (5, "12 !! 3"), (6, ""),
            (7, text("bb", 200_000))]
    out = {r.doc_id: r for r in mixture_language.identify(spark.createDataFrame(
        [(*t, "x") for t in test], "doc_id long, text string, score string"), model).collect()}
    assert [out[i].lang_pred for i in range(1, 8)] == ["aa", "bb", "cc", "und", "und", "und", "bb"]
    assert [x.lang for x in out[3].languages] == ["cc", "aa"] and math.isclose(out[3].score, 0.7, abs_tol=0.12)
    assert len(out[1].languages) == 1 and out[1].score == 1.0
    assert mixture_language.train(docs.where("false")).predict("foo") == ("und", 0.0, [])


def test_counts_are_sums_over_all_texts(spark):
    rows = [(i, t, "aa") for i, t in enumerate(["one two", "two", "three", "one two"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = mixture_language.train(docs)
    n = sum(np.bincount(mixture_language.features(t), minlength=mixture_language.FEATURES) for _, t, _ in rows)
    assert np.allclose(model.p[:, 0], (n + 0.5) / (n + 0.5).sum())


def test_held_out_accuracy(spark):
    import __spark_entry__ as E
    from pyspark.sql import functions as F
    from ..conftest import SF001
    told = E.queries()["op10_language_id"](spark, SF001).where("held_out")
    right = told.join(spark.read.parquet(f"{SF001}/documents.parquet"), "doc_id").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).head()[0]
    assert right > 0.95


# -- templates

def page(body, lang="en"):
    return f"<!DOCTYPE html><html lang={lang}><head><title>t</title><script>var a='</p>'</script></head><body>{body}</body></html>"


def test_main_text_of_sites_with_and_without_articles(spark):
    ready(spark)
    shell = "<nav><ul><li>Home<li>More</ul></nav><div class='ad'>Buy</div>{}<aside>rel</aside><section id=comments><p>me too</p></section><footer>&copy; x</footer>"
    rows = [(i, f"http://a.example/{i}", page(shell.format(
        f"<article><header><h1>Title {i}</h1></header><p>One &amp; <b>two</b>{i}<br>three\n four<p>five<form>f</form></article>"))) for i in range(3)]
    rows += [(10 + i, f"https://b.example:8080/{i}", page(shell.format(
        f"<div class=wrap><div class=content><p>Text {i}</p><div>same &lt;line&gt;</div></div></div>"))) for i in range(4)]
    rows += [(20, "http://a.example/x", None), (21, None, ""), (22, "http://c.example/", "<p>cut off <b>here"),
             (0, "http://a.example/0", rows[0][2]), (23, "http://d.example", "no markup &eacute;"), (24, "http://b.example/l", page("<p>" + "long " * 50_000))]
    pages = spark.createDataFrame([(*r, "s", 1) for r in rows], "page_id long, url string, html string, slot string, n long")
    out = sorted(((r.page_id, r.text) for r in template_extract.extract(pages).collect()), key=str)
    want = [(i, f"Title {i}\nOne & two{i} three four\nfive") for i in range(3)] + [(0, "Title 0\nOne & two0 three four\nfive")]
    want += [(10 + i, f"Text {i}\nsame <line>") for i in range(4)]
    want += [(20, ""), (21, ""), (22, "cut off here"), (23, "no markup é"), (24, ("long " * 50_000).strip())]
    assert out == sorted(want, key=str)
    assert template_extract.extract(pages.where("false")).count() == 0


def test_classes_group_tokens_by_occurrence(spark):
    rows = [(i, f"http://h/{i}", page("<div class=top>x</div>" + ("<div class=opt><p>y</p></div>" if i % 2 else "") + f"<main>{i}</main>")) for i in range(4)]
    t = template_extract.deduce_templates(ready(spark).createDataFrame(rows, "page_id long, url string, html string"))
    by = {r.path: r for r in t.collect()}
    assert by["html"]["class"] == by["html/body"]["class"] == by["html/body/main"]["class"] != by["html/body/div[class=opt]"]["class"]
    assert by["html/body/div[class=opt]"].n_pages == 2 and by["html/body/main"].varies and not by["html/body/div[class=top]"].varies


def test_the_slot_is_of_a_frequent_class(spark):
    rows = [(i, f"http://h/{i}", page(f"<main><p>Story {i}</p></main>")) for i in range(5)]
    rows += [(5, "http://h/5", page("<article><p>" + "odd " * 200 + "</p></article>"))]
    pages = ready(spark).createDataFrame(rows, "page_id long, url string, html string")
    t = template_extract.deduce_templates(pages)
    assert {r.path: r.frequent for r in t.where("main").collect() if not r.path.endswith("/p")} == {"html/body/main": True, "html/body/article": False}
    out = {r.page_id: (r.slot, r.text) for r in template_extract.extract(pages).collect()}
    assert out == {**{i: ("html/body/main", f"Story {i}") for i in range(5)}, 5: ("html/body/main", ("odd " * 200).strip())}


def test_one_odd_page_does_not_move_the_slot_of_its_host(spark):
    shell = "<p>Shop open now {}</p>{}<p>Imprint {}</p>"
    rows = [(i, f"http://h/{i}", page(shell.format(i, f"<article><p>Story {i}</p></article>", i))) for i in range(12)]
    rows += [(12, "http://h/12", page(shell.format(12, "<article><p>One</p></article><article><p>Two</p></article>", 12)))]
    # most pages of this host are listings
    rows += [(20 + i, f"http://l/{i}", page(shell.format(i, "".join(f"<article><p>Part {j}</p></article>" for j in range(1 + i % 3)), i)))
             for i in range(9)]
    out = {r.page_id: r for r in template_extract.extract(ready(spark).createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [out[i].text for i in range(13)] == [f"Story {i}" for i in range(12)] + ["One\nTwo"]
    assert out[0].slot == "html/body/article"
    assert [out[20 + i].text for i in range(9)] == ["\n".join(f"Part {j}" for j in range(1 + i % 3)) for i in range(9)]


@pytest.mark.parametrize("body, want", [
    ("<p><a class='related-link'>Foo</a> said that</p>", "Foo said that"),
    ("<p><span class='search-term'>Word</span> means this</p>", "Word means this"),
    ("<p>Long text <span class='ad'>Buy now</span>goes on</p>", "Long text goes on"),
    ("<p><span class='ad'>Buy now</span>Long text</p>", "Long text"),
    ("<div class='entry-header'><h1>Title</h1></div><div class='header'>By me</div>", "Title\nBy me"),
    ("<div class='code-header'>main.c</div><div class='search-results'>ten</div><div id='social-history'>old</div>", "main.c\nten\nold"),
    ("<p>a</p><div class='share-buttons'>x</div><section id='comments'>y</section><div class='col ad'>z</div>", "a"),
    ("<p>So <math><mi>a</mi><mo>=</mo><mn>2</mn><annotation encoding=tex>a=2</annotation></math> holds</p>", "So a=2 holds"),
    ("<p>An <svg><text>i</text></svg>icon and <script>var a</script>a <noscript>n</noscript>script</p>", "An icon and a script"),
    ("<p>one <a href=x><div>two</div></a> three</p>", "one\ntwo\nthree"),
])
def test_articles_lose_only_what_is_surely_outside(body, want):
    assert template_extract.main_text(page(f"<nav>n</nav><article>{body}</article>"), "html/body/article") == want


def test_a_long_conversation_comes_in_bounded_batches(monkeypatch):
    """1.9 MB in 4,700 turns: 2.2 GB of examples, of which few are held at once."""
    import itertools
    import resource

    import pyarrow as pa
    turns = [{"role": ("user", "assistant")[i % 2], "text": f"{i} " + "x" * 400} for i in range(4700)]
    batch = pa.RecordBatch.from_pylist([{"conv_id": 1, "turns": turns}, {"conv_id": 2, "turns": turns[:3]}])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    n = chars = 0
    for out in chat_examples._expand(iter([batch])):
        assert out.nbytes < 2 * chat_examples.BATCH_CHARS
        n += out.num_rows
        chars += sum(pa.compute.utf8_length(out.column("text")).to_pylist())
    assert n == 2350 + 2 and chars > 2_000_000_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000
    small = [{"conv_id": i, "turns": turns[:7]} for i in range(40)]
    monkeypatch.setattr(chat_examples, "BATCH_CHARS", 3000)
    rows = list(itertools.chain(*(b.to_pylist() for b in chat_examples._expand(iter([pa.RecordBatch.from_pylist(small)])))))
    assert [(r["conv_id"], r["example"], r["n_examples"], r["n_turns"]) for r in rows] == [(i, k, 4, n) for i in range(40) for k, n in enumerate((2, 4, 6, 7))]
