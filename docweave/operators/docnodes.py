"""Documents -> node table.

``doc_nodes`` is one ``mapInArrow`` pass: each Spark task parses the documents
of its partition with a C-backed standard-library parser and emits Arrow
batches of first-chain nodes.  Malformed documents yield one ``#error`` row
instead of failing the job.  Filters and projections placed *before* this call
reach the parquet scan; nothing after it can be pushed through it.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dom import Nodes, parse_html, parse_xml

NODE_FIELDS = "path string, name string, depth int, text string, attrs map<string,string>"
_NODE_TYPES = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.map_(pa.string(), pa.string())]


def _schema(df: DataFrame, fields: str) -> str:
    """``doc_id`` in its own type (ids may be urls or paths), then ``fields``."""
    return f"doc_id {df.schema['doc_id'].dataType.simpleString()}, {fields}"


def _batch(ids, source: pa.RecordBatch, columns, types, names) -> pa.RecordBatch:
    arrays = [pa.array(ids, type=source.schema.field(0).type)]
    return pa.RecordBatch.from_arrays(arrays + [pa.array(c, type=t) for c, t in zip(columns, types)], names)


#: Text of a batch of node rows at which it is handed on.
BATCH_CHARS = 8 << 20


def parse(body: str | None, kind: str, every_node: bool = False, trie=None) -> tuple[Nodes, str | None]:
    """(nodes, None) of a document, or (no nodes, message) when it does not parse."""
    try:
        return (parse_html if kind == "html" else parse_xml)(body, every_node, trie), None
    except Exception as e:  # malformed input: keep the job alive
        return Nodes(), f"{type(e).__name__}: {e}"


def _row_batches(batch, every_node, names, types, make):
    """Node rows of a batch of documents, in batches of bounded size: a document of deep
    markup has paths far longer than itself, so they are never all held."""
    ids, cols, held = [], [[] for _ in types], 0
    for doc_id, body, kind in zip(*(batch.column(i).to_pylist() for i in range(3))):
        nodes, error = parse(body, kind, every_node)
        rows = nodes.rows() if error is None else [(None, "#error", 0, error, {})]
        for seq, row in enumerate(rows):
            ids.append(doc_id)
            for c, v in zip(cols, make(seq, *row)):
                c.append(v)
            held += len(row[0] or "") + len(row[3] or "") + 64
            if held >= BATCH_CHARS:
                yield _batch(ids, batch, cols, types, names)
                ids, cols, held = [], [[] for _ in types], 0
    yield _batch(ids, batch, cols, types, names)


def _parse_batches(batches):
    names = ["doc_id", "path", "name", "depth", "text", "attrs"]
    for b in batches:
        yield from _row_batches(b, False, names, _NODE_TYPES, lambda seq, path, name, depth, text, attrs: (path, name, depth, text, list(attrs.items())))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Deal a batch input round-robin over at least ``min_partitions`` tasks (default:
    the cluster's default parallelism) before CPU-heavy parsing, when it comes in
    fewer partitions than that.  An input behind a shuffle is left as it is."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if "Exchange" in df._jdf.queryExecution().sparkPlan().toString() or "Join" in df._jdf.queryExecution().sparkPlan().toString():
        return df
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def _source(df: DataFrame, id_col: str, body_col: str, kind: str, kind_col: str | None = None, carry=()) -> DataFrame:
    from ..session import ship_package
    ship_package(df.sparkSession)
    src = df.select(F.col(id_col).alias("doc_id"), F.col(body_col).alias("body"),
                    (F.col(kind_col) if kind_col else F.lit(kind)).alias("kind"), *carry)
    return src if df.isStreaming else spread(src)


def doc_nodes(df: DataFrame, id_col: str = "doc_id", body_col: str = "body",
              kind: str = "xml", kind_col: str | None = None) -> DataFrame:
    """Node table ``(doc_id, path, name, depth, text, attrs)``.

    ``kind`` is ``"xml"`` or ``"html"``; with ``kind_col`` the per-row value
    (``html`` -> HTML parser, anything else -> XML parser) decides.
    """
    src = _source(df, id_col, body_col, kind, kind_col)
    return src.mapInArrow(_parse_batches, _schema(src, NODE_FIELDS))


def node_rows(nodes: DataFrame) -> DataFrame:
    """Drop the per-document ``#error`` markers."""
    return nodes.where(F.col("path").isNotNull())


def parse_errors(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("path").isNull()).select("doc_id", F.col("text").alias("error"))


OUTLINE_FIELDS = "seq int, depth int, path string, name string, value string, attrs string"
_OUTLINE_TYPES = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string()]

_MAP_TYPE = pa.map_(pa.string(), pa.struct([
    ("text", pa.string()), ("attrs", pa.map_(pa.string(), pa.string()))]))
MAP_FIELDS = "nodes map<string, struct<text: string, attrs: map<string,string>>>, error string"


def _attr_text(attrs: dict) -> str:
    return " ".join(f"{k}={attrs[k]}" for k in sorted(attrs))


def _outline_batches(batches):
    names = ["doc_id", "seq", "depth", "path", "name", "value", "attrs"]
    for b in batches:
        yield from _row_batches(b, True, names, _OUTLINE_TYPES,
                                lambda seq, path, name, depth, text, attrs: (seq, depth, path, name, text, _attr_text(attrs)))


def doc_outline(df: DataFrame, id_col: str = "doc_id", body_col: str = "body",
                kind: str = "xml", kind_col: str | None = None) -> DataFrame:
    """X11: every element in document order: ``doc_id, seq, depth, path, name, value, attrs``.

    ``path`` is null for elements that no expression can reach (not first of
    their name); ``attrs`` is ``k=v`` pairs in key order.
    """
    src = _source(df, id_col, body_col, kind, kind_col)
    return src.mapInArrow(_outline_batches, _schema(src, OUTLINE_FIELDS))


def trie_of(paths) -> list[dict[str, int]]:
    """The trie of element names of some paths; node 0 is above the root."""
    trie: list[dict[str, int]] = [{}]
    for path in paths:
        at = 0
        for name in path.split("/")[1:]:
            if name not in trie[at]:
                trie[at][name] = len(trie)
                trie.append({})
            at = trie[at][name]
    return trie


def doc_node_map(df: DataFrame, paths: list[str], id_col: str = "doc_id", body_col: str = "body",
                 kind: str = "xml", carry=(), kind_col: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, nodes map<path, struct<text, attrs>>, error``
    (+ ``carry`` columns passed through unchanged) for the nodes on ``paths`` and above
    them.  Built inside the parsing task: no shuffle, one row in, one row out."""
    trie = trie_of(paths)

    def run(batches):
        for b in batches:
            maps, errs = [], []
            for body, how in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                nodes, error = parse(body, how, trie=trie)
                maps.append([(path, {"text": text, "attrs": list(attrs.items())}) for path, _n, _d, text, attrs in nodes.rows()])
                errs.append(error)
            extra = list(range(3, b.num_columns))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(maps, type=_MAP_TYPE), pa.array(errs, type=pa.string()), *(b.column(i) for i in extra)],
                ["doc_id", "nodes", "error", *(b.schema.field(i).name for i in extra)])
    src = _source(df, id_col, body_col, kind, kind_col, carry)
    fields = MAP_FIELDS + "".join(f", {c} {df.schema[c].dataType.simpleString()}" for c in carry)
    return src.mapInArrow(run, _schema(src, fields))


def node_attrs_text(attrs: F.Column) -> F.Column:
    """``k=v`` pairs of a map column in key order, blank-separated."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(attrs)),
                                    lambda e: F.concat(e["key"], F.lit("="), e["value"])), " ")
