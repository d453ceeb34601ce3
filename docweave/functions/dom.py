"""Per-document helpers: markup text -> first-chain nodes.

Only nodes reachable by "first child with this name" steps are kept, since no
expression can address any other node.  Each node has its name, depth, *value* (the
first child node that has a value: text, CDATA, comment or processing instruction;
whitespace counts), attributes and the number of its parent; paths are put together
only where they are asked for, so memory is linear in the document however deep it is.

Given a *trie* of element names (``trie[node]`` maps a child's name to its node; 0 is
above the root), the parse walks it along: elements off the trie are skipped with all
that is below them.

These helpers run inside an Arrow batch function (``operators.docnodes``);
Spark partitions the documents.  The parsers are the standard library's
``xml.parsers.expat`` and ``html.parser``.
"""

from __future__ import annotations

from collections import Counter
from html.parser import HTMLParser
from xml.parsers import expat


class Nodes:
    """Elements in document order, as parallel lists; ``at`` holds trie nodes."""

    def __init__(self):
        self.names: list[str] = []
        self.parents: list[int] = []
        self.depths: list[int] = []
        self.values: list[str | None] = []
        self.attrs: list[dict] = []
        self.chain: list[bool] = []
        self.at: list[int] = []

    def paths(self):
        """The path of every node (None off the first chains), one at a time."""
        above: list[str] = []                 # names of the latest node of every depth
        for name, depth, chain in zip(self.names, self.depths, self.chain):
            del above[depth - 1:]
            above.append(name)
            yield "/" + "/".join(above) if chain else None

    def rows(self):
        """``(path, name, depth, value, attrs)`` one at a time."""
        return zip(self.paths(), self.names, self.depths, self.values, self.attrs)


def walk(names, parents, trie: list[dict[str, int]]) -> list[int]:
    """Trie node of every first-chain node (-1 off the trie)."""
    at = []
    for name, parent in zip(names, parents):
        above = at[parent] if parent >= 0 else 0
        at.append(trie[above].get(name, -1) if above >= 0 else -1)
    return at


class _Collector:
    """Builds nodes from start/end/value events."""

    def __init__(self, every_node: bool = False, trie: list[dict[str, int]] | None = None):
        self.nodes = Nodes()
        self.open: list[int] = []              # node numbers of the open elements that are kept
        self.seen: list[set | None] = []       # names of their children so far
        self.skipped = 0                       # open elements below the last kept one
        self.run: list[str] | None = None      # open text / CDATA run while a value is being read
        self.root_seen = False
        self.every_node = every_node           # outline mode: keep elements off the first chains too
        self.trie = trie

    def start(self, name: str, attrs: dict) -> None:
        if self.run is not None:
            self._close_run()
        if self.skipped:
            self.skipped += 1
            return
        n, parent, at = self.nodes, self.open[-1] if self.open else -1, 0
        if parent >= 0:
            chain = n.chain[parent]
            if chain and self.trie is not None:
                at = self.trie[n.at[parent]].get(name, -1)
                chain = at >= 0
            if chain:
                seen = self.seen[-1]
                if seen is None:
                    seen = self.seen[-1] = set()
                chain = name not in seen
                seen.add(name)
        else:
            chain, self.root_seen = not self.root_seen, True
            if self.trie is not None:
                at = self.trie[0].get(name, -1)
                chain = chain and at >= 0
        if not chain and not self.every_node:
            self.skipped = 1
            return
        self.open.append(len(n.names))
        self.seen.append(None)
        n.names.append(name)
        n.parents.append(parent)
        n.depths.append(len(self.open))
        n.values.append(None)
        n.attrs.append(attrs)
        n.chain.append(chain)
        n.at.append(at)

    def end(self) -> None:
        if self.skipped:
            self.skipped -= 1
            return
        if self.run is not None:
            self._close_run()
        self.open.pop()
        self.seen.pop()

    def text(self, data: str) -> None:
        if self.skipped or not self.open:
            return
        if self.run is not None:
            self.run.append(data)
        elif self.nodes.values[self.open[-1]] is None:
            self.run = [data]

    def value_node(self, data: str) -> None:
        """A comment or processing instruction: a value node of its own."""
        self.boundary()
        if self.open and not self.skipped and self.nodes.values[self.open[-1]] is None:
            self.nodes.values[self.open[-1]] = data

    def boundary(self) -> None:
        if self.run is not None:
            self._close_run()

    def _close_run(self) -> None:
        self.nodes.values[self.open[-1]] = "".join(self.run)
        self.run = None


def parse_xml(body: str | None, every_node: bool = False, trie=None) -> Nodes:
    """The nodes of an XML document; raises ``ValueError`` if malformed.

    With ``every_node`` all elements are kept in document order (outline).
    """
    if body is None:
        raise ValueError("no document")
    c = _Collector(every_node, trie)
    p = expat.ParserCreate()
    p.buffer_text = True
    p.ordered_attributes = False
    p.StartElementHandler = c.start
    p.EndElementHandler = lambda name: c.end()
    p.CharacterDataHandler = c.text
    p.CommentHandler = c.value_node
    p.ProcessingInstructionHandler = lambda target, data: c.value_node(data)
    # CDATA is a separate value node (non-coalescing DOM): close runs around it.
    p.StartCdataSectionHandler = c.boundary
    p.EndCdataSectionHandler = c.boundary
    try:
        p.Parse(body, True)
    except expat.ExpatError as e:
        raise ValueError(str(e)) from None
    return c.nodes


def xml_nodes(body: str | None, every_node: bool = False):
    """Rows ``(path, name, depth, value, attrs)`` of an XML document."""
    return list(parse_xml(body, every_node).rows())


# --- HTML -------------------------------------------------------------------

# Element classes of the HTML recovery rules.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
        "param", "source", "track", "wbr"}
HEAD_ONLY = {"title", "meta", "link", "style", "script", "base", "noscript"}
CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset",
            "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr",
            "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
SCOPE = {"html", "body", "table", "td", "th", "caption", "button", "object"}
# start tag -> (tags it closes, tags that stop the search)
IMPLIED = {
    "li": ({"li"}, SCOPE | {"ul", "ol"}),
    "dt": ({"dt", "dd"}, SCOPE | {"dl"}),
    "dd": ({"dt", "dd"}, SCOPE | {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "html", "body"}),
    "td": ({"td", "th"}, {"tr", "table", "html", "body"}),
    "th": ({"td", "th"}, {"tr", "table", "html", "body"}),
    "option": ({"option"}, SCOPE | {"select"}),
}


class _HtmlTree(HTMLParser):
    """Tolerant tree builder following the recovery rules in the README."""

    def __init__(self, every_node: bool = False, trie=None):
        super().__init__(convert_charrefs=True)
        self.c = _Collector(every_node, trie)
        self.open: list[str] = []        # names of the open elements
        self.n_open: Counter = Counter()
        self.has_head = self.has_body = False

    # stack helpers
    def _push(self, name, attrs):
        self.c.start(name, attrs)
        self.open.append(name)
        self.n_open[name] += 1

    def _pop_to(self, i):
        while len(self.open) > i:
            self.n_open[self.open.pop()] -= 1
            self.c.end()

    def _ensure_html(self, attrs=None):
        if not self.open:
            self._push("html", attrs or {})
            return True
        return False

    def _ensure_body(self):
        self._ensure_html()
        if not self.has_body:
            if not self.has_head:
                self._push("head", {})
                self.has_head = True
            if self.n_open["head"]:
                self._pop_to(self.open.index("head"))
            self._push("body", {})
            self.has_body = True

    def _close_in_scope(self, targets, stop):
        if not any(self.n_open[t] for t in targets):      # no search through a deep stack for nothing
            return
        for i in range(len(self.open) - 1, -1, -1):
            n = self.open[i]
            if n in targets:
                self._pop_to(i)
                return
            if n in stop:
                return

    def handle_starttag(self, tag, attrs):
        amap = {}
        for k, v in attrs:
            amap.setdefault(k, "" if v is None else v)
        if tag == "html":
            if not self._ensure_html(amap):
                pass  # second <html>: ignored
            return
        if tag == "head":
            self._ensure_html()
            if not self.has_head and not self.has_body:
                self._push("head", amap)
                self.has_head = True
            return
        if tag == "body":
            if not self.has_body:
                self._ensure_html()
                if not self.has_head:
                    self._push("head", {})
                    self.has_head = True
                if self.n_open["head"]:
                    self._pop_to(self.open.index("head"))
                self._push("body", amap)
                self.has_body = True
            return
        if tag in HEAD_ONLY and not self.has_body:
            self._ensure_html()
            if not self.has_head:
                self._push("head", {})
                self.has_head = True
        else:
            self._ensure_body()
        if tag in CLOSES_P:
            self._close_in_scope({"p"}, SCOPE)
        if tag in IMPLIED:
            targets, stop = IMPLIED[tag]
            self._close_in_scope(targets, stop)
        self._push(tag, amap)
        if tag in VOID:
            self._pop_to(len(self.open) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1] == tag:
            self._pop_to(len(self.open) - 1)

    def handle_endtag(self, tag):
        if tag in ("html", "body"):
            return
        if self.n_open[tag]:
            i = len(self.open) - 1
            while self.open[i] != tag:
                i -= 1
            self._pop_to(i)
        # stray end tags are ignored

    def handle_data(self, data):
        if not self.open or not self.has_body and self.open[-1] in ("html", "head"):
            if not data.strip():
                return
            self._ensure_body()
        self.c.text(data)

    # comments, doctype and processing instructions are dropped


def parse_html(body: str | None, every_node: bool = False, trie=None) -> Nodes:
    """The nodes of the recovered HTML tree."""
    if body is None:
        raise ValueError("no document")
    t = _HtmlTree(every_node, trie)
    t.feed(body)
    t.close()
    t._ensure_body()
    t._pop_to(0)
    return t.c.nodes


def html_nodes(body: str | None, every_node: bool = False):
    """Rows ``(path, name, depth, value, attrs)`` of the recovered HTML tree."""
    return list(parse_html(body, every_node).rows())
