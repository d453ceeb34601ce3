"""The strict grammar and the atom flattening (FIXTURES.md section 1)."""

import pytest

from docweave.functions.xpath_grammar import (Atom, compile_xpath, distinguishing_atoms,
                                              is_valid, parse_xpath)

VALID = [
    '/shop',                                              # one step
    '/shop/shelf/item',                                   # steps
    '/ns:shop/ns:item-1/_x9',                             # name characters
    '/shop/item[@sku="A-7"]',                             # attribute
    '/shop/item[text()="blue"]',                          # whole text
    '/shop/item[contains(text(),"lu")]',                  # substring
    '/shop/item[ text() = "blue" ]',                      # blanks inside a test
    '/shop[open]',                                        # child
    '/shop[shelf/item]',                                  # relative path
    '/shop[shelf[@n="1"]/item[text()="x"]]',              # tests inside a relative path
    '/shop[open][shelf[item]]/till[@id="[/]("]',          # quoted brackets
]
INVALID = ['', '   ', '/shop.old', 'shop/item', '/shop[', '/shop]', '/shop[text()="x"', '/shop[@sku=]', '/shop[text()=x]',
           '/shop[contains(text())]', '/shop[contains(text(),"x"]', '/shop[]', '/sh op']
OWN_INVALID = ['/', '//a', '/a//b', '/a/', '/a[@b]', "/a[@b='x']", '/child::a', '/a[text()=""]']


@pytest.mark.parametrize("x", VALID)
def test_valid(x):
    assert is_valid(x)


@pytest.mark.parametrize("x", INVALID + OWN_INVALID + [None, " /a"])
def test_invalid(x):
    assert not is_valid(x)


def test_trailing_blank_is_ignored():
    assert is_valid("/a/b  ")


def test_flattening_of_nested_predicates():
    atoms = parse_xpath('/a/b[foo[text()="x"]][bar]/c[@y="z"]')
    assert atoms == [
        Atom("/a", "exists", None, None), Atom("/a/b", "exists", None, None),
        Atom("/a/b/foo", "exists", None, None), Atom("/a/b/foo", "text", None, "x"),
        Atom("/a/b/bar", "exists", None, None), Atom("/a/b/c", "exists", None, None),
        Atom("/a/b/c", "attr", "y", "z")]
    assert distinguishing_atoms(atoms) == [
        Atom("/a/b/foo", "text", None, "x"), Atom("/a/b/bar", "exists", None, None),
        Atom("/a/b/c", "attr", "y", "z")]


def test_quoted_brackets_are_literal():
    ok, atoms = compile_xpath('/a[@v="]x[/"]')
    assert ok and atoms == [Atom("/a", "attr", "v", "]x[/")]


def test_contains_prefix_is_a_child_name():
    ok, atoms = compile_xpath("/a[containsX]")
    assert ok and atoms == [Atom("/a/containsX", "exists", None, None)]
    ok, atoms = compile_xpath('/a[contains( text() , "q" )]')
    assert ok and atoms == [Atom("/a", "contains", None, "q")]
