"""Compile expressions to atoms and match documents.

Navigation takes the first child of a name, so a path names at most one node of a
document and an expression is a set of atoms on paths.  Documents are parsed and
matched in one ``mapInArrow`` pass: every node looks up its path in an index of all
atoms (exact text and attribute values by hash, substrings by one Aho-Corasick scan
a path), and an expression matches when all its atoms were met.  The decision is
made inside the document, so ids may be of any type and may repeat; nothing is
shuffled and streams need no state.

The paths of an index form a trie of element names that the parser walks along:
subtrees off it are skipped, and no path is ever put together.

The index is broadcast in blocks of at most ``block_atoms`` atoms.  A larger expression
set becomes several blocks.  A pass over the documents parses each once, along the paths
of all its blocks, and matches it against one block after the other; it takes as many
blocks as hold ``BLOCK_ATOMS`` atoms together.  Beyond that documents are parsed once
into a written table of their nodes, and each pass reads that table (in a stream: the
documents), so there is no limit to the set and no task holds more than that.

Documents are worked on in slices of an Arrow batch of bounded text, so what a Python
worker holds does not grow with the batch.
"""

from __future__ import annotations

import functools

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.xpath_grammar import compile_xpath
from ..functions.dom import walk
from .docnodes import parse, spread, trie_of
from .frontier import ranked

ATOM_TYPE = T.ArrayType(T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("attr", T.StringType()),
    T.StructField("lit", T.StringType()),
]))
COMPILED_TYPE = T.StructType([
    T.StructField("valid", T.BooleanType()),
    T.StructField("atoms", ATOM_TYPE),
])

BLOCK_ATOMS = 200_000


@F.pandas_udf(COMPILED_TYPE)
def _compile_udf(xpaths: pd.Series) -> pd.DataFrame:
    valid, atoms = [], []
    for x in xpaths:
        ok, at = compile_xpath(x)
        valid.append(ok)
        atoms.append([a._asdict() for a in at])
    return pd.DataFrame({"valid": valid, "atoms": atoms})


def xpath_valid(df: DataFrame, col: str = "xpath") -> DataFrame:
    """F16: adds ``valid boolean``."""
    from ..session import ship_package
    ship_package(df.sparkSession)
    return df.withColumn("valid", _compile_udf(F.col(col))["valid"])


def compile_xpaths(xpaths: DataFrame, col: str = "xpath") -> DataFrame:
    """One row per distinct expression: ``xpath, valid, n_atoms, atoms``."""
    from ..session import ship_package
    ship_package(xpaths.sparkSession)
    c = (xpaths.select(F.col(col).alias("xpath")).where(F.col("xpath").isNotNull())
         .distinct()
         .withColumn("c", _compile_udf(F.col("xpath"))))
    return c.select("xpath", F.col("c.valid").alias("valid"),
                    F.size("c.atoms").cast("int").alias("n_atoms"),
                    F.col("c.atoms").alias("atoms"))


def atom_table(compiled: DataFrame) -> DataFrame:
    """X1 long form: ``xpath, n_atoms, atom, path, kind, attr, lit`` (valid only)."""
    return (compiled.where("valid")
            .select("xpath", "n_atoms", F.posexplode("atoms").alias("atom", "a"))
            .select("xpath", "n_atoms", F.col("atom").cast("int").alias("atom"),
                    "a.path", "a.kind", "a.attr", "a.lit"))


class AtomIndex:
    """All atoms of a block of expressions by trie node; built on first use in a worker."""

    def __init__(self, rows: list[tuple]):
        self.rows = rows            # (expression, atoms as (path, kind, attr, lit); None: invalid)
        self.trie = None

        self.by_path = None

    def __getstate__(self):
        return {"rows": self.rows, "trie": None, "by_path": None}

    def paths(self) -> dict[str, dict]:
        """The tests of every path."""
        if self.by_path is not None:
            return self.by_path
        by_path: dict[str, dict] = {}
        for x, (_, atoms) in enumerate(self.rows):
            for path, kind, attr, lit in atoms or ():
                at = by_path.setdefault(path, {"exists": [], "text": {}, "attr": {}, "contains": {}})
                if kind == "exists":
                    at["exists"].append(x)
                else:
                    key = (attr, lit) if kind == "attr" else lit
                    at[kind].setdefault(key, []).append(x)
        for at in by_path.values():
            at["scan"] = _scanner(at["contains"])
        self.need = [-1 if atoms is None else len(atoms) for _, atoms in self.rows]
        self.by_path = by_path
        return by_path

    def tests_along(self, trie: list[dict[str, int]]) -> dict[int, dict]:
        """The tests by node of a trie that holds all paths."""
        tests = {}
        for path, at in self.paths().items():
            node = 0
            for name in path.split("/")[1:]:
                node = trie[node][name]
            tests[node] = at
        return tests

    def build(self) -> None:
        trie = trie_of(self.paths())
        self.tests = self.tests_along(trie)
        self.trie = trie

    def matches(self, body, kind) -> list[int]:
        """Numbers of the expressions that hold in a document, ascending."""
        if self.trie is None:
            self.build()
        nodes, error = parse(body, kind, trie=self.trie)
        return self.held(nodes.at, nodes.values, nodes.attrs, self.tests) if error is None else self.held((), (), (), self.tests)

    def matches_parsed(self, names, parents, values, attrs) -> list[int]:
        """The same of a parsed document."""
        if self.trie is None:
            self.build()
        return self.held(walk(names, parents, self.trie), values, map(dict, attrs), self.tests)

    def held(self, at, values, attrs, along) -> list[int]:
        met: dict[int, int] = {}

        def meet(xs):
            for x in xs:
                met[x] = met.get(x, 0) + 1
        for node, text, pairs in zip(at, values, attrs):
            tests = along.get(node)
            if tests is None:
                continue
            meet(tests["exists"])
            if text is not None:
                meet(tests["text"].get(text, ()))
                for xs in tests["scan"](text):
                    meet(xs)
            for key in pairs.items() if tests["attr"] else ():
                meet(tests["attr"].get(key, ()))
        return sorted(x for x, n in met.items() if n == self.need[x])


class Pass:
    """Blocks that are matched over one parse of a document."""

    def __init__(self, numbered: list[tuple[int, object]]):
        self.numbered = numbered    # (number of the block, its broadcast index)
        self.trie = None

    def __getstate__(self):
        return {"numbered": self.numbered, "trie": None}

    def build(self) -> None:
        held = [(n, block.value) for n, block in self.numbered]
        trie = trie_of(path for _, index in held for path in index.paths())
        self.indexes = [(n, index, index.tests_along(trie)) for n, index in held]
        self.trie = trie

    def matches(self, document, from_parsed: bool):
        """``block, index, numbers of its expressions that hold`` of every block."""
        if self.trie is None:
            self.build()
        if from_parsed:
            names, parents, values, attrs = document
            at, attrs = walk(names, parents, self.trie), [dict(a) for a in attrs]
        else:
            nodes, error = parse(*document, trie=self.trie)
            at, values, attrs = (nodes.at, nodes.values, nodes.attrs) if error is None else ((), (), ())
        for n, index, tests in self.indexes:
            yield n, index, index.held(at, values, attrs, tests)


def passes_of(blocks: list, most_atoms: int = BLOCK_ATOMS) -> list[Pass]:
    """Blocks in passes of at most ``most_atoms`` atoms (a larger block alone)."""
    dealt, room = [], 0
    for n, block in enumerate(blocks):
        if not dealt or block.n_atoms > room:
            dealt.append([])
            room = most_atoms
        dealt[-1].append((n, block))
        room -= block.n_atoms
    return [Pass(p) for p in dealt]


def _scanner(literals: dict[str, list[int]]):
    """text -> expressions of each literal that it contains."""
    if not literals:
        return lambda text: ()
    plain = {k: v for k, v in literals.items() if k}
    always = [v for k, v in literals.items() if not k]
    import ahocorasick
    machine = ahocorasick.Automaton()
    for lit, xs in plain.items():
        machine.add_word(lit, (lit, xs))
    if plain:
        machine.make_automaton()

    def scan(text):
        found = {lit: xs for _, (lit, xs) in machine.iter(text)} if plain else {}
        return [*found.values(), *always]
    return scan


def _held(docs: DataFrame, rows: list[tuple]):
    block = docs.sparkSession.sparkContext.broadcast(AtomIndex(rows))
    block.n_atoms = sum(len(atoms or ()) for _, atoms in rows)
    return block


def _blocks_of(rows: DataFrame, name: str, block_atoms: int):
    """``rows(name, n_atoms, atoms)`` as broadcast indexes of about ``block_atoms`` atoms
    each, dealt by name."""
    total = rows.agg(F.coalesce(F.sum("n_atoms"), F.lit(0))).first()[0]
    n = max(1, -(-total // block_atoms))
    if n > 1:
        rows = rows.checkpoint()                       # compiled once for all blocks
    for b in range(n):
        part = rows.where(F.pmod(F.xxhash64(name), F.lit(n)) == b) if n > 1 else rows
        yield [(r[0], [tuple(a) for a in r["atoms"]]) for r in part.select(name, "atoms").orderBy(name).collect()]


def expression_blocks(compiled: DataFrame, block_atoms: int = BLOCK_ATOMS) -> list:
    """The valid expressions as broadcast indexes."""
    return [_held(compiled, rows) for rows in _blocks_of(compiled.where("valid"), "xpath", block_atoms)]


def _source(docs: DataFrame, id_col: str, body_col: str, kind: str, kind_col: str | None, keep) -> DataFrame:
    from ..session import ship_package
    ship_package(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(body_col).alias("body"),
                      (F.col(kind_col) if kind_col else F.lit(kind)).alias("kind"), *keep)
    return src if docs.isStreaming else spread(src)


#: Text of a slice of a batch (a longer document alone), and its most documents.
SLICE_BYTES, SLICE_ROWS = 4 << 20, 1000


def _slices(batch: pa.RecordBatch):
    """A batch in slices of bounded text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("body")), 0).to_pylist() if "body" in batch.schema.names else [0] * batch.num_rows
    a = held = 0
    for i, n in enumerate(sizes):
        if i > a and (held + n > SLICE_BYTES or i - a == SLICE_ROWS):
            yield batch.slice(a, i - a)
            a, held = i, 0
        held += n
    yield batch.slice(a)


PARSED = "names array<string>, parents array<int>, vals array<string>, attrs array<map<string,string>>"
_PARSED_TYPES = [pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.map_(pa.string(), pa.string()))]
PARSED_NAMES = ["names", "parents", "vals", "attrs"]


def parsed(src: DataFrame) -> DataFrame:
    """``doc_id, body, kind, ...`` -> the first-chain nodes of every document in place of
    ``body`` and ``kind`` (none where it does not parse)."""
    keep = [c for c in src.columns if c not in ("body", "kind")]

    def run(batches):
        for b in (piece for batch in batches for piece in _slices(batch)):
            cols = [[], [], [], []]
            for body, k in zip(b.column("body").to_pylist(), b.column("kind").to_pylist()):
                n, _ = parse(body, k)
                for c, v in zip(cols, (n.names, n.parents, n.values, [list(a.items()) for a in n.attrs])):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *(pa.array(c, t) for c, t in zip(cols, _PARSED_TYPES))], [*keep, *PARSED_NAMES])
    fields = T.StructType([src.schema[c] for c in keep] + T.StructType.fromDDL(PARSED).fields)
    return src.mapInArrow(run, fields)


def _emitted(src: DataFrame, out: str, emit, from_parsed: bool) -> DataFrame:
    """``emit(document)`` gives the values of the columns ``out`` that a document yields,
    as tuples, next to its other columns; a document is (body, kind) or its parsed nodes."""
    made = T.StructType.fromDDL(out)
    inputs = PARSED_NAMES if from_parsed else ["body", "kind"]
    keep = [c for c in src.columns if c not in inputs]

    def run(batches):
        for b in (piece for batch in batches for piece in _slices(batch)):
            index, values = [], [[] for _ in made]
            for i, document in enumerate(zip(*(b.column(c).to_pylist() for c in inputs))):
                for row in emit(document):
                    index.append(i)
                    for column, v in zip(values, row):
                        column.append(v)
            rows = b.select(keep).take(pa.array(index, pa.int64()))
            kinds = [pa.int32() if f.dataType == T.IntegerType() else pa.string() for f in made]
            yield pa.RecordBatch.from_arrays([*rows.columns, *(pa.array(v, k) for v, k in zip(values, kinds))], [*keep, *made.names])
    return src.mapInArrow(run, T.StructType([*(src.schema[c] for c in keep), *made]))


def _union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def match_blocks(src: DataFrame, blocks: list, out: str, once: bool = False) -> DataFrame:
    """The names of all that holds in every document, with ``_block``, the number of the
    block it comes from; ``once``: a name that several entries of a block share comes
    once a document and block."""
    passes = passes_of(blocks)
    from_parsed = len(passes) > 1 and not src.isStreaming
    if from_parsed:
        src = parsed(src).checkpoint()

    def emit(one: Pass):
        def run(document):
            for n, index, found in one.matches(document, from_parsed):
                names = [index.rows[x][0] for x in found]
                yield from ((name, n) for name in (dict.fromkeys(names) if once else names))
        return run
    return _union([_emitted(src, f"{out}, _block int", emit(p), from_parsed) for p in passes])


def match_compiled(docs: DataFrame, compiled: DataFrame, id_col: str = "doc_id", body_col: str = "body",
                   kind: str = "xml", kind_col: str | None = None, keep=(), block_atoms: int = BLOCK_ATOMS) -> DataFrame:
    """``(doc_id, xpath)`` (and ``keep``) for every document row and every
    expression that holds in it.  ``kind_col`` names a column that picks the parser of
    each row (``html``, anything else is XML).  Batch or streaming."""
    src = _source(docs, id_col, body_col, kind, kind_col, keep)
    return match_blocks(src, expression_blocks(compiled, block_atoms), "xpath string").drop("_block")


def match_documents(docs: DataFrame, xpaths: DataFrame, id_col: str = "doc_id", body_col: str = "body",
                    kind: str = "xml", xpath_col: str = "xpath", **how) -> DataFrame:
    """Compile, parse and match: ``(doc_id, xpath)``."""
    return match_compiled(docs, compile_xpaths(xpaths, xpath_col), id_col, body_col, kind, **how)


def channel_blocks(subs: DataFrame, block_atoms: int = BLOCK_ATOMS) -> list:
    """Expressions with their channels as broadcast indexes; those of one channel share
    a block."""
    rows = subs.select("xpath", "channel").distinct().join(compile_xpaths(subs).where("valid"), "xpath")
    return [_held(subs, r) for r in _blocks_of(rows.select("channel", "n_atoms", "atoms"), "channel", block_atoms)]


def match_channels(docs: DataFrame, subs: DataFrame, id_col: str = "doc_id", body_col: str = "body", kind: str = "xml",
                   kind_col: str | None = None, keep=(), block_atoms: int = BLOCK_ATOMS) -> DataFrame:
    """X12 + J3: ``(doc_id, channel)``, each channel once a document row."""
    src = _source(docs, id_col, body_col, kind, kind_col, keep)
    return match_blocks(src, channel_blocks(subs, block_atoms), "channel string", once=True).drop("_block")


def truth_vectors(docs: DataFrame, compiled: DataFrame, id_col: str = "doc_id", body_col: str = "body",
                  kind: str = "xml", kind_col: str | None = None, block_atoms: int = BLOCK_ATOMS) -> DataFrame:
    """Per document row ``doc_id, n_true, n_false, truth``: one ``1``/``0`` per
    expression in expression order (invalid ones are false).  A block is a range of that
    order and gives its piece of the vector; only the rows hold vectors whole."""
    rows = compiled.select("xpath", "valid", "n_atoms", "atoms").checkpoint()
    total, count = rows.agg(F.coalesce(F.sum(F.when(F.col("valid"), F.col("n_atoms"))), F.lit(0)), F.count(F.lit(1))).first()
    n = max(1, -(-total // block_atoms))
    if n > 1:
        rows = ranked(rows, ["xpath"], "place").checkpoint()
    src = _source(docs, id_col, body_col, kind, kind_col, ()).withColumn("row", F.monotonically_increasing_id())
    if n > 1:
        src = parsed(src).checkpoint()
    pieces = []
    for b in range(n):
        part = rows.where(F.floor((F.col("place") - 1) * n / count) == b) if n > 1 else rows
        block = _held(docs, [(r["xpath"], [tuple(a) for a in r["atoms"]] if r["valid"] else None) for r in part.orderBy("xpath").collect()])

        def emit(document, block=block):
            index = block.value
            truth = bytearray(b"0" * len(index.rows))
            for x in index.matches_parsed(*document) if n > 1 else index.matches(*document):
                truth[x] = 49
            return [(truth.decode(),)]
        pieces.append(_emitted(src, "truth string", emit, n > 1).withColumn("block", F.lit(b)))
    out = pieces[0]
    if n > 1:                                                # a row's pieces make its vector
        inside = F.transform(F.sort_array(F.collect_list(F.struct("block", "truth"))), lambda p: p["truth"])
        out = _union(pieces).groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.array_join(inside, "").alias("truth"))
    ones = F.length("truth") - F.length(F.translate("truth", "1", ""))
    return out.select("doc_id", ones.cast("long").alias("n_true"),
                      (F.length("truth") - ones).cast("long").alias("n_false"), "truth")
