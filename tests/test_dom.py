"""First-chain node extraction and HTML recovery (FIXTURES.md 2 and 4)."""

import random
import time
import tracemalloc

import pytest

from docweave.functions.dom import html_nodes, parse_html, parse_xml, walk, xml_nodes
from docweave.operators.docnodes import trie_of

PORT = ('<p:port xmlns:p="urn:p"><p:berth><p:ship>Northern Light</p:ship></p:berth><log><log day="3">'
        '<log wind="NW" force="5"/><log wind="N" force="4"/></log></log></p:port>')


def as_map(rows):
    return {p: (v, a) for p, _n, _d, v, a in rows}


def test_first_chain_only():
    m = as_map(xml_nodes(PORT))
    assert m["/p:port/p:berth/p:ship"][0] == "Northern Light"
    assert m["/p:port/log/log/log"][1] == {"wind": "NW", "force": "5"}
    assert len([p for p in m if p.endswith("/log/log/log")]) == 1


def test_first_value_node_semantics():
    # whitespace text, comments and PIs are value nodes; element children are not
    m = as_map(xml_nodes("<r><a>\n  <b/>x</a><c><!--note-->t</c><d><e/>late</d></r>"))
    assert m["/r/a"][0] == "\n  "
    assert m["/r/c"][0] == "note"
    assert m["/r/d"][0] == "late"
    assert m["/r"][0] is None


def test_cdata_is_a_separate_node_and_entities_merge():
    m = as_map(xml_nodes("<r><a><![CDATA[c1]]>t</a><b>x &amp; y</b></r>"))
    assert m["/r/a"][0] == "c1"
    assert m["/r/b"][0] == "x & y"


def test_malformed_xml_raises():
    with pytest.raises(ValueError):
        xml_nodes("<a><b></a>")


def test_html_shell_is_recovered():
    m = as_map(html_nodes("<h2>Tide table</h2><body>High at noon<body>"))
    assert "/html/head" in m and "/html/body/h2" in m
    assert m["/html/body/h2"][0] == "Tide table"
    assert m["/html/body"][0] == "High at noon"


def test_html_implied_closes_and_raw_text():
    m = as_map(html_nodes('<title>T &amp; U</title><script>var t="</p>";</script>'
                          '<p><b>one<br><p>two</p><ul><li>a<li>b</ul>'))
    assert m["/html/head/title"][0] == "T & U"
    assert m["/html/head/script"][0] == 'var t="</p>";'
    assert m["/html/body/p"][0] is None          # first p starts with <b>
    assert m["/html/body/p/b"][0] == "one"
    assert m["/html/body/ul/li"][0] == "a"       # second li is a sibling, not a child
    assert "/html/body/ul/li/li" not in m
    assert "/html/body/p/p" not in m


def test_outline_keeps_every_element():
    rows = xml_nodes("<r><a/><a x='1'/></r>", every_node=True)
    assert [(p, n) for p, n, *_ in rows] == [("/r", "r"), ("/r/a", "a"), (None, "a")]


def deep(levels, tag):
    return f"<{tag}>" * levels + "x" + f"</{tag}>" * levels


@pytest.mark.parametrize("parse, body", [(parse_xml, deep(20_000, "div")), (parse_html, deep(20_000, "div")), (parse_html, "<div>" * 20_000),
                                         (parse_html, "<div><p>" * 10_000), (parse_html, "<b><i>" * 10_000 + "</b>" * 10_000)])
def test_deep_markup_is_linear(parse, body):
    for how in ({}, {"trie": trie_of(["/html/body/div/div", "/div/div/div"])}, {"every_node": True}):
        tracemalloc.start()
        began = time.process_time()
        nodes = parse(body, **how)
        took, (_, peak) = time.process_time() - began, tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert took < 5 and peak < 50 << 20                     # under the tracer, which slows it severalfold
        assert len(nodes.names) < 10 if "trie" in how else len(nodes.names) >= 10_000


def test_trie_keeps_what_the_paths_name():
    rng = random.Random(3)
    names = "abc"

    def tree(depth):
        return "".join(f"<{n} k='{rng.randint(0, 9)}'>{rng.choice(['', 't'])}{tree(depth - 1) if depth else ''}</{n}>" for n in rng.choices(names, k=rng.randint(0, 3)))
    for _ in range(200):
        body = f"<a>{tree(4)}</a>"
        whole = parse_xml(body)
        paths = list(whole.paths())
        trie = trie_of(wanted := rng.sample(paths, min(3, len(paths))) + ["/a/x/y"])
        above = {"/".join(p.split("/")[:i]) for p in wanted for i in range(2, 99)}
        kept = parse_xml(body, trie=trie)
        assert list(kept.rows()) == [r for r in whole.rows() if r[0] in above]
        at = walk(whole.names, whole.parents, trie)
        assert [(p, t) for p, t in zip(paths, at) if t >= 0] == list(zip(kept.paths(), kept.at))
