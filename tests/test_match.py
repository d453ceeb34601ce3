"""Spark matching against hand-written cases and against brute force."""

import random

from pyspark.sql import functions as F

from docweave.functions.xpath_grammar import evaluate_tree
from docweave.operators import docnodes as dn
from docweave.operators import xpath_match as xm

MENU = ('<m:menu xmlns:m="urn:m"><m:week no="14"><day name="Mon" open="yes"><dish price="9">Soup of the day</dish>'
        '<dish price="12">Stew</dish></day><day name="Tue"><dish>Pie</dish></day></m:week><note>vegan on request</note></m:menu>')
CASES = [
    ("/m:menu", True),
    ('/m:menu/m:week[@no="14"]/day[@name="Mon"][@open="yes"]', True),
    ('/m:menu/m:week/day/dish[text()="Soup of the day"]', True),
    ('/m:menu/note[contains(text(),"vegan")]', True),
    ('/m:menu[note]/m:week[day[dish[@price="9"]]]', True),
    ("/m:menus", False),
    ('/m:menu/m:week/day/dish[text()="Soup"]', False),
    ('/m:menu/m:week[@no="41"]/day', False),
    ('/m:menu/note[contains(text(),"Vegan")]', False),
    ('/m:menu/m:week/day/dish[text()="Stew"]', False),        # only the first dish counts
]


def _xp(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "xpath string")


def test_cases_by_match_and_truth_vector(spark):
    docs = spark.createDataFrame([(1, MENU), (2, "<broken>"), (3, None)], "doc_id long, body string")
    xs = _xp(spark, [x for x, _ in CASES] + ["//invalid"])
    assert {(r.doc_id, r.xpath) for r in xm.match_documents(docs, xs).collect()} == {(1, x) for x, ok in CASES if ok}
    for block in (1, 200_000):
        tv = {r.doc_id: r for r in xm.truth_vectors(docs, xm.compile_xpaths(xs), block_atoms=block).collect()}
        assert tv[1].n_true == 5 and tv[1].n_false == 6 and tv[2].truth == tv[3].truth == "0" * 11
        names = sorted([x for x, _ in CASES] + ["//invalid"])
        assert {x for x, t in zip(names, tv[1].truth) if t == "1"} == {x for x, ok in CASES if ok}


def test_blocks_of_expressions_give_the_same_matches(spark):
    docs = spark.createDataFrame([(1, MENU)], "doc_id long, body string")
    xs = _xp(spark, [x for x, _ in CASES])
    whole = sorted(tuple(r) for r in xm.match_documents(docs, xs).collect())
    assert whole == sorted(tuple(r) for r in xm.match_documents(docs, xs, block_atoms=3).collect())


def test_repeated_ids_are_decided_row_by_row(spark):
    docs = spark.createDataFrame([("u", "<a/>"), ("u", "<a/>"), ("v", "<a><b/></a>"), ("v", "<a><c/></a>"), (None, "<a/>")],
                                 "url string, body string")
    got = sorted(map(str, xm.match_documents(docs, _xp(spark, ["/a", "/a[b][c]"]), "url").collect()))
    assert got == sorted(["Row(doc_id='u', xpath='/a')"] * 2 + ["Row(doc_id='v', xpath='/a')"] * 2 + ["Row(doc_id=None, xpath='/a')"])


def test_parser_is_picked_by_row(spark):
    docs = spark.createDataFrame([("f.xml", "<r><p>x</p></r>", "xml"), ("g.html", "<p>x", "html"), ("h.xml", "<p>x", "xml")],
                                 "path string, body string, kind string")
    got = xm.match_documents(docs, _xp(spark, ['/r/p[text()="x"]', '/html/body/p[text()="x"]']), "path", kind_col="kind")
    assert sorted(tuple(r) for r in got.collect()) == [("f.xml", '/r/p[text()="x"]'), ("g.html", '/html/body/p[text()="x"]')]


def test_twenty_thousand_expressions(spark):
    docs = spark.createDataFrame([(i, f"<r><k>v{i} w</k></r>") for i in range(40)], "doc_id long, body string")
    xs = spark.range(10_000).select(F.explode(F.array(
        F.concat(F.lit('/r/k[text()="v'), F.col("id").cast("string"), F.lit(' w"]')),
        F.concat(F.lit('/r[k[contains(text(),"v'), F.col("id").cast("string"), F.lit(' ")]]')))).alias("xpath"))
    got = {(r.doc_id, r.xpath) for r in xm.match_documents(docs, xs, block_atoms=15_000).collect()}
    assert got == {(i, x) for i in range(40) for x in (f'/r/k[text()="v{i} w"]', f'/r[k[contains(text(),"v{i} ")]]')}


def test_channels_once_a_document(spark):
    docs = spark.createDataFrame([(1, MENU, "k"), (2, "<x/>", "k")], "doc_id long, body string, extra string")
    subs = spark.createDataFrame([("/m:menu", "all"), ("/m:menu/note", "all"), ("/x", "xs"), ("/none", "never")], "xpath string, channel string")
    for block in (1, 100):
        got = xm.match_channels(docs, subs, keep=["extra"], block_atoms=block).collect()
        assert sorted(tuple(r) for r in got) == [(1, "k", "all"), (2, "k", "xs")]


def test_malformed_document_is_an_error_row(spark):
    docs = spark.createDataFrame([(7, "<a><b></a>")], "doc_id long, body string")
    errs = dn.parse_errors(dn.doc_nodes(docs)).collect()
    assert len(errs) == 1 and errs[0].doc_id == 7


# --- property test: random trees and paths, matching = brute force -----------------

NAMES = ["a", "b", "c"]


def _tree(rng, depth):
    name = rng.choice(NAMES)
    attrs = {k: rng.choice(["1", "2"]) for k in ("x", "y") if rng.random() < 0.4}
    kids = []
    if depth < 4:
        for _ in range(rng.randint(0, 3)):
            kids.append(("#value", rng.choice(["t", "u", "tu"])) if rng.random() < 0.3
                        else _tree(rng, depth + 1))
    merged = []  # adjacent text is one text node in XML
    for k in kids:
        if k[0] == "#value" and merged and merged[-1][0] == "#value":
            merged[-1] = ("#value", merged[-1][1] + k[1])
        else:
            merged.append(k)
    return (name, attrs, merged)


def _xml(node):
    if node[0] == "#value":
        return node[1]
    name, attrs, kids = node
    a = "".join(f' {k}="{v}"' for k, v in attrs.items())
    return f"<{name}{a}>" + "".join(_xml(k) for k in kids) + f"</{name}>"


def _path(rng, depth=0):
    s = rng.choice(NAMES)
    for _ in range(rng.randint(0, 2)):
        r = rng.random()
        if r < 0.25:
            s += f'[text()="{rng.choice(["t", "u", "tu"])}"]'
        elif r < 0.5:
            s += f'[contains(text(),"{rng.choice(["t", "u"])}")]'
        elif r < 0.75:
            s += f'[@{rng.choice(["x", "y"])}="{rng.choice(["1", "2"])}"]'
        elif depth < 2:
            s += "[" + _path(rng, depth + 1) + "]"
    if depth < 2 and rng.random() < 0.6:
        s += "/" + _path(rng, depth + 1)
    return s


def test_random_trees_match_brute_force(spark):
    rng = random.Random(7)
    trees = [_tree(rng, 1) for _ in range(120)]
    paths = sorted({"/" + _path(rng) for _ in range(80)})
    docs = spark.createDataFrame([(i % 50, _xml(t)) for i, t in enumerate(trees)], "doc_id long, body string")   # ids repeat
    expected = sorted((i % 50, p) for i, t in enumerate(trees) for p in paths if evaluate_tree(p, t))
    assert expected, "fixture should produce matches"
    for block in (7, 200_000):
        assert sorted(tuple(r) for r in xm.match_documents(docs, _xp(spark, paths), block_atoms=block).collect()) == expected


def test_blocks_share_one_parse(spark):
    docs = spark.createDataFrame([(1, "<r><a/><b>x</b></r>"), (2, "<r><b>y</b></r>"), (3, "broken"), (4, None)], "doc_id long, body string")
    xs = _xp(spark, ["/r/a", "/r/b", '/r/b[text()="x"]', "/r"])
    got = xm.match_documents(docs, xs, block_atoms=1)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted(map(tuple, got.collect())) == sorted([(1, "/r/a"), (1, "/r/b"), (1, '/r/b[text()="x"]'), (1, "/r"), (2, "/r/b"), (2, "/r")])


def test_slices_hold_bounded_text(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(xm, "SLICE_BYTES", 10)
    monkeypatch.setattr(xm, "SLICE_ROWS", 3)
    bodies = ["x" * 6, None, "y" * 5, "z" * 40, "", "", "", "", "w"]
    pieces = list(xm._slices(pa.RecordBatch.from_pydict({"body": bodies})))
    assert [b for p in pieces for b in p.column("body").to_pylist()] == bodies
    assert all(p.num_rows == 1 or p.num_rows <= 3 and sum(len(b or "") for b in p.column("body").to_pylist()) <= 10 for p in pieces)
