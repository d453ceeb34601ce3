"""Strict grammar for the supported XPath subset, and its flattening into atoms.

Supported expressions::

    path  := '/' step ('/' step)*
    step  := NAME pred*
    pred  := '[' test ']'
    test  := ws 'text()' ws '=' ws LIT ws
           | ws '@' NAME ws '=' ws LIT ws
           | ws 'contains' ws '(' ws 'text()' ws ',' ws LIT ws ')' ws
           | step ('/' step)*                 (relative path, nested predicate)
    NAME  := [A-Za-z0-9:_-]+   ('::' is rejected)
    LIT   := '"' [^"]+ '"'     (no escapes; '[', ']' and '/' inside are literal)

Evaluation walks, at every step, to the *first* child element with the wanted
name and never backtracks.  A path string therefore names at most one node of
a document, and a whole expression, nested predicates included, becomes a
conjunction of *atoms* on absolute paths:

    exists(path) | text(path) = lit | contains(text(path), lit) | attr(path, a) = lit

This module is a small per-row helper: it is applied to the (small) expression
table inside an Arrow UDF; matching itself is ``operators.xpath_match``.
"""

from __future__ import annotations

import re
from typing import NamedTuple

_NAME = re.compile(r"[A-Za-z0-9:_\-]+")
_WS = re.compile(r"\s*")
_LIT = re.compile(r'"([^"]+)"')


class Atom(NamedTuple):
    path: str
    kind: str          # exists | text | contains | attr
    attr: str | None
    lit: str | None


class _Fail(Exception):
    pass


class _Parser:
    def __init__(self, s: str):
        self.s = s
        self.i = 0
        self.atoms: list[Atom] = []

    # -- lexing helpers -------------------------------------------------
    def _ws(self) -> None:
        self.i = _WS.match(self.s, self.i).end()

    def _eat(self, tok: str) -> bool:
        if self.s.startswith(tok, self.i):
            self.i += len(tok)
            return True
        return False

    def _need(self, tok: str) -> None:
        if not self._eat(tok):
            raise _Fail(tok)

    def _name(self) -> str:
        m = _NAME.match(self.s, self.i)
        if not m:
            raise _Fail("name")
        name = m.group(0)
        if "::" in name:
            raise _Fail("axis")
        self.i = m.end()
        return name

    def _lit(self) -> str:
        m = _LIT.match(self.s, self.i)
        if not m:
            raise _Fail("literal")
        self.i = m.end()
        return m.group(1)

    # -- grammar ----------------------------------------------------------
    def parse(self) -> list[Atom]:
        self._need("/")
        self._steps("")
        if self.i != len(self.s):
            raise _Fail("trailing")
        return self.atoms

    def _steps(self, base: str) -> None:
        path = self._step(base)
        while self._eat("/"):
            path = self._step(path)

    def _step(self, base: str) -> str:
        path = f"{base}/{self._name()}"
        self.atoms.append(Atom(path, "exists", None, None))
        while self._eat("["):
            self._test(path)
            self._need("]")
        return path

    def _test(self, path: str) -> None:
        start = self.i
        self._ws()
        if self._eat("text()"):
            self._ws(); self._need("="); self._ws()
            self.atoms.append(Atom(path, "text", None, self._lit()))
            self._ws()
            return
        if self._eat("@"):
            attr = self._name()
            self._ws(); self._need("="); self._ws()
            self.atoms.append(Atom(path, "attr", attr, self._lit()))
            self._ws()
            return
        save = self.i
        if self._eat("contains"):
            self._ws()
            if self._eat("("):
                self._ws(); self._need("text()"); self._ws(); self._need(","); self._ws()
                lit = self._lit()
                self._ws(); self._need(")"); self._ws()
                self.atoms.append(Atom(path, "contains", None, lit))
                return
            self.i = save  # a child element whose name starts with "contains"
        if self.i != start:
            raise _Fail("blank before relative path")
        self._steps(path)


def parse_xpath(xpath: str | None) -> list[Atom] | None:
    """All atoms of an expression in written order, or None when it is invalid.

    Trailing blanks are ignored; a leading blank makes the expression invalid.
    """
    if xpath is None:
        return None
    s = xpath.rstrip()
    if not s:
        return None
    try:
        return _Parser(s).parse()
    except _Fail:
        return None


def is_valid(xpath: str | None) -> bool:
    return parse_xpath(xpath) is not None


def distinguishing_atoms(atoms: list[Atom]) -> list[Atom]:
    """Drop duplicates and every ``exists`` atom implied by another atom.

    A node on path ``p`` is only present when all its ancestors are, so
    ``exists(p)`` is implied by any atom on ``p`` or below it.  Dropping these
    keeps hot prefixes such as ``/html/body`` out of the join.
    """
    uniq = list(dict.fromkeys(atoms))
    keep = []
    for a in uniq:
        if a.kind == "exists" and any(
                b is not a and (b.path == a.path and b.kind != "exists"
                                or b.path.startswith(a.path + "/")) for b in uniq):
            continue
        keep.append(a)
    return keep


def compile_xpath(xpath: str | None) -> tuple[bool, list[Atom]]:
    """(valid, distinguishing atoms) for one expression."""
    atoms = parse_xpath(xpath)
    if atoms is None:
        return False, []
    return True, distinguishing_atoms(atoms)


def evaluate_tree(xpath: str, tree) -> bool:
    """Brute-force reference evaluation on a parsed tree (used by tests).

    ``tree`` is a nested ``(name, attrs, children)`` tuple where children are
    either such tuples or ``("#value", text)`` pairs.
    """
    atoms = parse_xpath(xpath)
    if atoms is None:
        return False
    nodes = {}

    def walk(node, path):
        name, attrs, children = node
        p = f"{path}/{name}"
        value = next((c[1] for c in children if c[0] == "#value"), None)
        nodes[p] = (value, attrs)
        seen = set()
        for c in children:
            if c[0] != "#value" and c[0] not in seen:
                seen.add(c[0])
                walk(c, p)

    walk(tree, "")
    for a in atoms:
        if a.path not in nodes:
            return False
        value, attrs = nodes[a.path]
        if a.kind == "text" and value != a.lit:
            return False
        if a.kind == "contains" and (value is None or a.lit not in value):
            return False
        if a.kind == "attr" and attrs.get(a.attr) != a.lit:
            return False
    return True
