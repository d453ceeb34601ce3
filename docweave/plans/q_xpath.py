"""Registered XPath queries over documents built from the order tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import channels as ch
from ..operators import docnodes as dn
from ..operators import xpath_match as xm
from .catalog import ORDER_SUBSCRIPTIONS, ORDER_XPATHS
from .derived import order_xml
from .registry import query, values_sql

# --- SQL building blocks ------------------------------------------------------

OX_CTE = """
fl AS (
  SELECT l_orderkey, l_returnflag, l_linestatus, l_partkey FROM (
    SELECT l.*, row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_returnflag, l_linestatus, l_partkey) AS rn
    FROM lineitem l) WHERE rn = 1),
ox AS (
  SELECT o.o_orderkey, o.o_orderpriority, o.o_orderstatus,
         strftime(o.o_orderdate, '%Y-%m-%d') AS o_date,
         fl.l_orderkey IS NOT NULL AS has_line,
         fl.l_returnflag AS f_flag, fl.l_linestatus AS f_st,
         CAST(fl.l_partkey AS VARCHAR) AS f_pk
  FROM orders o LEFT JOIN fl ON fl.l_orderkey = o.o_orderkey)"""


def _match_sql(xpaths) -> str:
    parts = [f"SELECT o_orderkey AS doc_id, '{x}' AS xpath FROM ox WHERE {cond}"
             for x, cond in xpaths]
    return "\n  UNION ALL ".join(parts)


MATCH_SQL = f"WITH {OX_CTE},\nm AS ({_match_sql(ORDER_XPATHS)})"
SUBS_SQL = values_sql(ORDER_SUBSCRIPTIONS, ["xpath", "channel"])


def order_xpaths(spark):
    return spark.createDataFrame([(x,) for x, _ in ORDER_XPATHS], "xpath string")


def order_subscriptions(spark):
    return spark.createDataFrame(ORDER_SUBSCRIPTIONS, "xpath string, channel string")


def order_nodes(spark, sf_dir):
    return dn.doc_nodes(order_xml(spark, sf_dir), "id", "xml", "xml")


def order_matches(spark, sf_dir, xpaths=None):
    xpaths = order_xpaths(spark) if xpaths is None else xpaths
    return xm.match_documents(order_xml(spark, sf_dir), xpaths, "id", "xml")


def _only(kind_pred):
    return [(x, c) for x, c in ORDER_XPATHS if kind_pred(x)]


# --- queries ------------------------------------------------------------------

@query("xpath_match", sql=f"{MATCH_SQL}\nSELECT doc_id, xpath FROM m")
def q_xpath_match(spark, sf_dir):
    """X4 (flagship): every (order document, expression) that matches."""
    return order_matches(spark, sf_dir)


@query("channel_hits", sql=f"""{MATCH_SQL}
SELECT s.channel, m.doc_id, min(m.xpath) AS xpath
FROM m JOIN {SUBS_SQL.replace('AS t(', 'AS s(')} ON s.xpath = m.xpath
GROUP BY s.channel, m.doc_id""")
def q_channel_hits(spark, sf_dir):
    """J3 + A6: matches fanned out to channels, one credit per (channel, doc)."""
    return ch.fan_out(order_matches(spark, sf_dir), order_subscriptions(spark)).select("channel", "doc_id", "xpath")


_EXISTS = _only(lambda x: "[" not in x)
_TEXT = _only(lambda x: "text()=" in x and "contains" not in x and "@" not in x)
_CONTAINS = _only(lambda x: "contains(" in x)
_ATTR = _only(lambda x: "@" in x)
_NESTED = _only(lambda x: "[" in x and any(ch.isalpha() for ch in x.split("[", 1)[1][:1]))


def _subset_query(name, subset):
    @query(name, sql=f"WITH {OX_CTE},\nm AS ({_match_sql(subset)})\nSELECT doc_id, xpath FROM m")
    def run(spark, sf_dir):
        xs = spark.createDataFrame([(x,) for x, _ in subset], "xpath string")
        return order_matches(spark, sf_dir, xs)
    run.__name__ = f"q_{name}"
    return run


_subset_query("xpath_exists", _EXISTS)      # X5
_subset_query("xpath_text", _TEXT)          # X6
_subset_query("xpath_contains", _CONTAINS)  # X7
_subset_query("xpath_attr", _ATTR)          # X8
_subset_query("xpath_nested", _NESTED)      # X9


@query("xml_nodes", sql=f"""WITH {OX_CTE}
SELECT o_orderkey AS doc_id, '/g:order' AS path, 1 AS depth, NULL::VARCHAR AS text,
       'pri=' || o_orderpriority AS attrs FROM ox
UNION ALL SELECT o_orderkey, '/g:order/status', 2, o_orderstatus, '' FROM ox
UNION ALL SELECT o_orderkey, '/g:order/date', 2, o_date, '' FROM ox
UNION ALL SELECT o_orderkey, '/g:order/line', 2, NULL, 'flag=' || f_flag FROM ox WHERE has_line
UNION ALL SELECT o_orderkey, '/g:order/line/st', 3, f_st, '' FROM ox WHERE has_line
UNION ALL SELECT o_orderkey, '/g:order/line/pk', 3, f_pk, '' FROM ox WHERE has_line""")
def q_xml_nodes(spark, sf_dir):
    """First-chain node table of the order documents."""
    n = dn.node_rows(order_nodes(spark, sf_dir))
    return n.select("doc_id", "path", "depth", "text", dn.node_attrs_text(F.col("attrs")).alias("attrs"))


@query("xpath_matrix", sql=f"""{MATCH_SQL},
xp AS (SELECT DISTINCT xpath FROM {values_sql([(x,) for x, _ in ORDER_XPATHS], ['xpath'])}),
cell AS (
  SELECT ox.o_orderkey AS doc_id, xp.xpath,
         EXISTS (SELECT 1 FROM m WHERE m.doc_id = ox.o_orderkey AND m.xpath = xp.xpath) AS hit
  FROM ox CROSS JOIN xp)
SELECT doc_id, count(*) FILTER (WHERE hit) AS n_true, count(*) FILTER (WHERE NOT hit) AS n_false,
       string_agg(CASE WHEN hit THEN '1' ELSE '0' END, '' ORDER BY xpath) AS truth
FROM cell GROUP BY doc_id""")
def q_xpath_matrix(spark, sf_dir):
    """Per document the full truth vector over the expression set."""
    return xm.truth_vectors(order_xml(spark, sf_dir), xm.compile_xpaths(order_xpaths(spark)), "id", "xml")


@query("xpath_match_rowwise", sql=f"{MATCH_SQL}\nSELECT doc_id, xpath FROM m")
def q_xpath_match_rowwise(spark, sf_dir):
    """Matches with the expression set cut into blocks of about ten atoms, as one too
    large for a single index would be."""
    return xm.match_documents(order_xml(spark, sf_dir), order_xpaths(spark), "id", "xml", block_atoms=10)


@query("doc_outline", sql=f"""WITH ln AS (
  SELECT l_orderkey, l_returnflag, l_linestatus, l_partkey,
         row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_returnflag, l_linestatus, l_partkey) AS rn
  FROM lineitem),
o AS (SELECT o_orderkey, o_orderpriority, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS o_date
      FROM orders)
SELECT o_orderkey AS doc_id, 0 AS seq, 1 AS depth, '/g:order' AS path, 'g:order' AS name,
       NULL::VARCHAR AS value, 'pri=' || o_orderpriority AS attrs FROM o
UNION ALL SELECT o_orderkey, 1, 2, '/g:order/status', 'status', o_orderstatus, '' FROM o
UNION ALL SELECT o_orderkey, 2, 2, '/g:order/date', 'date', o_date, '' FROM o
UNION ALL SELECT l_orderkey, CAST(3 * rn AS INTEGER), 2, CASE WHEN rn = 1 THEN '/g:order/line' END,
                 'line', NULL, 'flag=' || l_returnflag FROM ln
UNION ALL SELECT l_orderkey, CAST(3 * rn + 1 AS INTEGER), 3, CASE WHEN rn = 1 THEN '/g:order/line/st' END,
                 'st', l_linestatus, '' FROM ln
UNION ALL SELECT l_orderkey, CAST(3 * rn + 2 AS INTEGER), 3, CASE WHEN rn = 1 THEN '/g:order/line/pk' END,
                 'pk', CAST(l_partkey AS VARCHAR), '' FROM ln""")
def q_doc_outline(spark, sf_dir):
    """X11: full outline of every order document, document order."""
    return dn.doc_outline(order_xml(spark, sf_dir), "id", "xml", "xml")
