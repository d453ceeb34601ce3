"""Registered channel-management queries.

Channel requests are derived from ``events``: every event is one request by
user ``user_id`` (``error`` events are delete requests, all others create a
channel with a ``;``-separated expression list built from the event's
``props``).  The SQL twins restate the same derivation and evaluate each
expression template directly on the order tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import functions as F

from ..operators import channels as ch
from ..operators import history as hist
from ..operators import xpath_match as xm
from ..sources.tables import read_table
from .q_xpath import OX_CTE
from .registry import query

CUTOFF = "2024-01-01 04:00:00"   # snapshot boundary for J9 / J5
# Order priorities, line flags/statuses, order statuses.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
FLAGS = ["A", "N", "R"]
LINE_ST = ["F", "O"]
ORDER_ST = ["F", "O", "P"]


def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def channel_requests(spark, sf_dir):
    """``request_id, ts, kind, channel, owner, xsl_url, xpaths`` from ``events``."""
    ev = read_table(spark, sf_dir, "events")
    et, uid = F.col("event_type"), F.col("user_id")
    k = F.regexp_extract("props", r'"k": (\d+)', 1).cast("int")
    u7 = (uid % 7).cast("string")
    xp = (F.when(et == "view", F.concat(
              F.lit('/g:order[@pri="'), _pick(PRIORITIES, k % 5), F.lit('"] ; /g:order/line/pk[contains(text(),"'),
              k.cast("string"), F.lit('")]')))
          .when(et == "click", F.concat(
              F.lit('/g:order/line[@flag="'), _pick(FLAGS, k % 3), F.lit('"]/st[text()="'),
              _pick(LINE_ST, k % 2), F.lit('"]')))
          .when(et == "purchase", F.concat(
              F.lit('/g:order/status[text()="'), _pick(ORDER_ST, k % 3),
              F.lit('"];;/g:order/date[contains(text(),"-'), F.lpad((k % 12 + 1).cast("string"), 2, "0"),
              F.lit('-")]')))
          .when((et == "signup") & (k % 4 == 0), F.lit("/g:order[@pri]"))
          .when(et == "signup", F.concat(
              F.lit('/g:order[status[text()="O"]][line/pk[contains(text(),"'), k.cast("string"),
              F.lit('")]]'))))
    return ev.select(
        F.col("event_id").alias("request_id"), F.col("ts").cast("timestamp").alias("ts"),
        F.when(et == "error", "delete").otherwise("create").alias("kind"),
        F.when(et == "error", F.concat(F.lit("view"), u7))
         .when((et == "signup") & (uid % 10 == 0), F.concat(F.lit("sign-up"), u7))
         .otherwise(F.concat(et, u7)).alias("channel"),
        F.when(uid % 13 == 0, F.concat(F.lit("u"), uid.cast("string")))
         .otherwise(F.concat(F.lit("user"), uid.cast("string"))).alias("owner"),
        F.when((et == "click") & (uid % 9 == 0), F.lit(""))
         .otherwise(F.concat(F.lit("http://xsl.example.com/"), et, F.lit(".xsl"))).alias("xsl_url"),
        xp.alias("xpaths"))


class ChannelState:
    """All derived channel tables of one input directory, made as they are asked for."""

    # every stage is small (one row per request / channel / expression) and feeds
    # several later ones: checkpointed, so none is computed from ``events`` again and
    # nothing stays pinned in executors

    def __init__(self, spark, sf_dir):
        self.requests = channel_requests(spark, sf_dir)

    @cached_property
    def validated(self):
        return ch.validate_requests(self.requests.where(F.col("kind") == "create"))

    @cached_property
    def history(self):
        taken = self.validated.where("status = 'ok'").drop("status")
        return hist.channel_history(taken.unionByName(self.requests.where(F.col("kind") == "delete"))).checkpoint()

    @cached_property
    def registered(self):
        return hist.outcomes(self.validated, self.history)

    @cached_property
    def lives(self):
        return hist.lifetimes(self.history).checkpoint()

    @cached_property
    def valid(self):
        items = ch.subscriptions_of(self.lives)                  # every listed expression
        return xm.xpath_valid(items.select("xpath").distinct()).checkpoint()

    @cached_property
    def subs(self):
        return ch.subscriptions_of(self.lives, self.valid)

    @cached_property
    def live(self):
        return hist.live_at(self.lives)

    @cached_property
    def live_subs(self):
        return ch.subscriptions_of(self.live, self.valid).checkpoint()

    def at(self, moment: str):
        """(channels, subscriptions) as the requests before ``moment`` left them."""
        live = hist.live_at(self.lives, moment)
        return live, ch.subscriptions_of(live, self.valid).checkpoint()


def _matches(spark, sf_dir, subs):
    from .derived import order_xml
    return xm.match_documents(order_xml(spark, sf_dir), subs.select("xpath").distinct(), "id", "xml")


# --- SQL twins ----------------------------------------------------------------

def _arr(values):
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


REQ_CTE = f"""
req AS (
  SELECT event_id AS request_id, ts, event_type AS et, user_id,
    CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) AS k,
    CASE WHEN event_type = 'error' THEN 'delete' ELSE 'create' END AS kind,
    CASE WHEN event_type = 'error' THEN 'view' || (user_id % 7)
         WHEN event_type = 'signup' AND user_id % 10 = 0 THEN 'sign-up' || (user_id % 7)
         ELSE event_type || (user_id % 7) END AS channel,
    CASE WHEN user_id % 13 = 0 THEN 'u' || user_id ELSE 'user' || user_id END AS owner,
    CASE WHEN event_type = 'click' AND user_id % 9 = 0 THEN ''
         ELSE 'http://xsl.example.com/' || event_type || '.xsl' END AS xsl_url
  FROM events),
items AS (
  SELECT request_id, '/g:order[@pri="' || {_arr(PRIORITIES)}[k % 5 + 1] || '"]' AS xpath,
         'pri' AS tk, {_arr(PRIORITIES)}[k % 5 + 1] AS p1, NULL AS p2 FROM req WHERE et = 'view'
  UNION ALL SELECT request_id, '/g:order/line/pk[contains(text(),"' || k || '")]',
         'pk', CAST(k AS VARCHAR), NULL FROM req WHERE et = 'view'
  UNION ALL SELECT request_id, '/g:order/line[@flag="' || {_arr(FLAGS)}[k % 3 + 1] || '"]/st[text()="'
         || {_arr(LINE_ST)}[k % 2 + 1] || '"]', 'flagst', {_arr(FLAGS)}[k % 3 + 1],
         {_arr(LINE_ST)}[k % 2 + 1] FROM req WHERE et = 'click'
  UNION ALL SELECT request_id, '/g:order/status[text()="' || {_arr(ORDER_ST)}[k % 3 + 1] || '"]',
         'status', {_arr(ORDER_ST)}[k % 3 + 1], NULL FROM req WHERE et = 'purchase'
  UNION ALL SELECT request_id, '/g:order/date[contains(text(),"-' || lpad(CAST(k % 12 + 1 AS VARCHAR), 2, '0')
         || '-")]', 'month', '-' || lpad(CAST(k % 12 + 1 AS VARCHAR), 2, '0') || '-', NULL
         FROM req WHERE et = 'purchase'
  UNION ALL SELECT request_id, '/g:order[@pri]', 'bad', NULL, NULL FROM req WHERE et = 'signup' AND k % 4 = 0
  UNION ALL SELECT request_id, '/g:order[status[text()="O"]][line/pk[contains(text(),"' || k || '")]]',
         'openpk', CAST(k AS VARCHAR), NULL FROM req WHERE et = 'signup' AND k % 4 <> 0),
val AS (
  SELECT r.*,
    CASE WHEN r.kind = 'create' AND NOT EXISTS (SELECT 1 FROM items i WHERE i.request_id = r.request_id)
              OR trim(channel) = '' OR trim(xsl_url) = '' THEN 'missing_fields'
         WHEN NOT regexp_full_match(channel, '[A-Za-z0-9]{{1,20}}') THEN 'invalid_channel_name'
         WHEN NOT regexp_full_match(owner, '[A-Za-z0-9]{{5,16}}') THEN 'invalid_user_name'
         ELSE 'ok' END AS status
  FROM req r WHERE kind = 'create'),
ev AS (SELECT request_id, ts, 'create' AS kind, channel, owner, xsl_url FROM val WHERE status = 'ok'
       UNION ALL SELECT request_id, ts, kind, channel, owner, xsl_url FROM req WHERE kind = 'delete'),
num AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY ts, request_id) AS rn FROM ev),
later AS (SELECT *,
    min(CASE WHEN kind = 'delete' THEN rn END) OVER (PARTITION BY channel, owner ORDER BY rn
        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS gone,
    min(CASE WHEN kind = 'create' THEN rn END) OVER (PARTITION BY channel ORDER BY rn
        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS again FROM num),
nx AS (SELECT a.channel, a.rn, a.gone, b.again FROM later a LEFT JOIN later b ON b.channel = a.channel AND b.rn = a.gone
       WHERE a.kind = 'create'),
life AS (SELECT nx.* FROM nx JOIN (SELECT channel, min(rn) AS rn FROM num WHERE kind = 'create' GROUP BY channel) USING (channel, rn)
         UNION ALL SELECT nx.* FROM life JOIN nx ON nx.channel = life.channel AND nx.rn = life.again),
chans AS (SELECT n.channel, n.owner, n.xsl_url, n.ts AS created_at, n.request_id, d.ts AS deleted_at, d.request_id AS delete_id
          FROM life JOIN num n USING (channel, rn) LEFT JOIN num d ON d.channel = life.channel AND d.rn = life.gone),
reg AS (
  SELECT v.*, CASE WHEN status <> 'ok' THEN status WHEN request_id IN (SELECT request_id FROM chans) THEN 'success'
                   ELSE 'association_exists' END AS result
  FROM val v),
subs_all AS (SELECT DISTINCT i.xpath, c.channel, i.tk, i.p1, i.p2 FROM chans c JOIN items i USING (request_id)),
subs AS (SELECT * FROM subs_all WHERE tk <> 'bad'),
dels AS (SELECT d.request_id, d.ts, d.owner, d.channel,
                d.request_id IN (SELECT delete_id FROM chans WHERE delete_id IS NOT NULL) AS deleted
         FROM req d WHERE kind = 'delete'),
live AS (SELECT * FROM chans WHERE delete_id IS NULL),
live_subs AS (SELECT DISTINCT i.xpath, c.channel, i.tk, i.p1, i.p2 FROM live c JOIN items i USING (request_id) WHERE tk <> 'bad'),
live_b AS (SELECT * FROM chans WHERE created_at < TIMESTAMP '{CUTOFF}'
           AND (delete_id IS NULL OR deleted_at >= TIMESTAMP '{CUTOFF}')),
live_subs_b AS (SELECT DISTINCT i.xpath, c.channel, i.tk, i.p1, i.p2 FROM live_b c JOIN items i USING (request_id) WHERE tk <> 'bad')"""

HOLDS = """CASE s.tk WHEN 'pri' THEN ox.o_orderpriority = s.p1
     WHEN 'pk' THEN coalesce(contains(ox.f_pk, s.p1), false)
     WHEN 'flagst' THEN coalesce(ox.f_flag = s.p1 AND ox.f_st = s.p2, false)
     WHEN 'status' THEN ox.o_orderstatus = s.p1
     WHEN 'month' THEN contains(ox.o_date, s.p1)
     WHEN 'openpk' THEN ox.o_orderstatus = 'O' AND coalesce(contains(ox.f_pk, s.p1), false)
     ELSE false END"""

CH_SQL = f"WITH RECURSIVE {OX_CTE},{REQ_CTE}"


def _hits_sql(subs: str) -> str:
    return (f"SELECT s.channel, ox.o_orderkey AS doc_id, min(s.xpath) AS xpath "
            f"FROM {subs} s JOIN ox ON {HOLDS} GROUP BY s.channel, ox.o_orderkey")


# --- queries ------------------------------------------------------------------

@query("src_xpaths", sql=f"""{CH_SQL}
SELECT i.request_id, i.xpath FROM items i JOIN req r USING (request_id) WHERE r.kind = 'create'""")
def q_src_xpaths(spark, sf_dir):
    """``;``-separated expression lists split into one row per expression."""
    from ..functions.urls import split_list
    r = channel_requests(spark, sf_dir).where(F.col("kind") == "create")
    return r.select("request_id", F.explode(split_list(F.col("xpaths"))).alias("xpath"))


@query("xpath_valid", sql=f"{CH_SQL}\nSELECT DISTINCT xpath, tk <> 'bad' AS valid FROM items")
def q_xpath_valid(spark, sf_dir):
    """F16: validity of every requested expression (strict grammar)."""
    st = ChannelState(spark, sf_dir)
    from ..functions.urls import split_list
    r = st.requests.where(F.col("kind") == "create")
    xs = r.select(F.explode(split_list(F.col("xpaths"))).alias("xpath")).distinct()
    return xm.xpath_valid(xs).select("xpath", "valid")


@query("xpath_atoms", sql=f"""{CH_SQL},
xa AS (SELECT DISTINCT xpath, tk, p1, p2 FROM items)
SELECT xpath, 1 AS n_atoms, 0 AS atom, '/g:order' AS path, 'attr' AS kind, 'pri' AS attr, p1 AS lit
  FROM xa WHERE tk = 'pri'
UNION ALL SELECT xpath, 1, 0, '/g:order/line/pk', 'contains', NULL::VARCHAR, p1 FROM xa WHERE tk = 'pk'
UNION ALL SELECT xpath, 2, 0, '/g:order/line', 'attr', 'flag', p1 FROM xa WHERE tk = 'flagst'
UNION ALL SELECT xpath, 2, 1, '/g:order/line/st', 'text', NULL::VARCHAR, p2 FROM xa WHERE tk = 'flagst'
UNION ALL SELECT xpath, 1, 0, '/g:order/status', 'text', NULL::VARCHAR, p1 FROM xa WHERE tk = 'status'
UNION ALL SELECT xpath, 1, 0, '/g:order/date', 'contains', NULL::VARCHAR, p1 FROM xa WHERE tk = 'month'
UNION ALL SELECT xpath, 2, 0, '/g:order/status', 'text', NULL::VARCHAR, 'O' FROM xa WHERE tk = 'openpk'
UNION ALL SELECT xpath, 2, 1, '/g:order/line/pk', 'contains', NULL::VARCHAR, p1 FROM xa WHERE tk = 'openpk'""")
def q_xpath_atoms(spark, sf_dir):
    """Atom table (distinguishing atoms) of every requested expression."""
    from ..functions.urls import split_list
    r = channel_requests(spark, sf_dir).where(F.col("kind") == "create")
    xs = r.select(F.explode(split_list(F.col("xpaths"))).alias("xpath"))
    return xm.atom_table(xm.compile_xpaths(xs))


@query("validate_channels", sql=f"{CH_SQL}\nSELECT request_id, channel, owner, status FROM val")
def q_validate_channels(spark, sf_dir):
    """F17 + F21: name rules and required fields of creation requests."""
    return ChannelState(spark, sf_dir).validated.select("request_id", "channel", "owner", "status")


@query("register_channels", sql=f"{CH_SQL}\nSELECT request_id, channel, result FROM reg")
def q_register_channels(spark, sf_dir):
    """A create succeeds if no channel of the name exists at its time."""
    return ChannelState(spark, sf_dir).registered.select("request_id", "channel", "result")


@query("delete_channels", sql=f"{CH_SQL}\nSELECT request_id, channel, owner, deleted FROM dels")
def q_delete_channels(spark, sf_dir):
    """Deletes take effect only for the owner, at their time."""
    h = ChannelState(spark, sf_dir).history.where("kind = 'delete'")
    return h.select("request_id", "channel", "owner", (F.col("result") == "deleted").alias("deleted"))


@query("channel_history", sql=f"""{CH_SQL}
SELECT request_id, channel, 'create' AS kind, result FROM reg WHERE status = 'ok'
UNION ALL SELECT request_id, channel, 'delete', CASE WHEN deleted THEN 'deleted'
    WHEN EXISTS (SELECT 1 FROM chans c JOIN num a ON a.request_id = c.request_id AND a.kind = 'create'
                 JOIN num d ON d.request_id = dels.request_id AND d.kind = 'delete'
                 LEFT JOIN num g ON g.request_id = c.delete_id AND g.kind = 'delete'
                 WHERE c.channel = dels.channel AND a.rn < d.rn AND (g.rn IS NULL OR g.rn > d.rn)) THEN 'not_owner'
    ELSE 'no_such_channel' END FROM dels""")
def q_channel_history(spark, sf_dir):
    """J10 + J7 in order: what became of every create and delete request."""
    return ChannelState(spark, sf_dir).history.select("request_id", "channel", "kind", "result")


@query("channel_lifetimes", sql=f"""{CH_SQL}
SELECT request_id, channel, owner, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
       coalesce(strftime(deleted_at, '%Y-%m-%d %H:%M:%S'), '') AS deleted_at FROM chans""")
def q_channel_lifetimes(spark, sf_dir):
    """J10 + J7 + J9: every time a channel came to be, whose it was and when it went."""
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return ChannelState(spark, sf_dir).lives.select(
        "request_id", "channel", "owner", shown("created_at").alias("created_at"), F.coalesce(shown("deleted_at"), F.lit("")).alias("deleted_at"))


@query("purge_subscriptions", sql=f"{CH_SQL}\nSELECT xpath, channel FROM live_subs")
def q_purge_subscriptions(spark, sf_dir):
    """Subscriptions of deleted channels are dropped (invalid expressions too)."""
    return ChannelState(spark, sf_dir).live_subs.select("xpath", "channel")


@query("xpath_map", sql=f"""{CH_SQL}
SELECT DISTINCT xpath, channel FROM live_subs""")
def q_xpath_map(spark, sf_dir):
    """A1: expression -> its channels, one row each."""
    return ch.xpath_map(ChannelState(spark, sf_dir).live_subs)


@query("all_channels", sql=f"{CH_SQL}\nSELECT DISTINCT channel FROM live")
def q_all_channels(spark, sf_dir):
    """A2: all live channel names."""
    return ChannelState(spark, sf_dir).live.select("channel").distinct()


@query("user_channels", sql=f"""{CH_SQL}
SELECT DISTINCT owner, channel FROM live""")
def q_user_channels(spark, sf_dir):
    """A3: each user's live channels, one row each."""
    return ch.user_channels(ChannelState(spark, sf_dir).live)


@query("channel_diff", sql=f"""{CH_SQL}
SELECT channel, 'added' AS change FROM live WHERE channel NOT IN (SELECT channel FROM live_b)
UNION ALL SELECT channel, 'deleted' FROM live_b WHERE channel NOT IN (SELECT channel FROM live)""")
def q_channel_diff(spark, sf_dir):
    """Channels added / deleted since the snapshot at ``CUTOFF``."""
    now = ChannelState(spark, sf_dir)
    return ch.channel_diff(now.at(CUTOFF)[0], now.live)


@query("live_hits", sql=f"{CH_SQL}\n{_hits_sql('live_subs')}")
def q_live_hits(spark, sf_dir):
    """J3 + J4 + A6: order documents credited to live channels."""
    st = ChannelState(spark, sf_dir)
    hits = ch.fan_out(_matches(spark, sf_dir, st.live_subs), st.live_subs)     # dead channels are never matched
    return ch.keep_live(hits, st.live).select("channel", "doc_id", "xpath")


@query("new_hits", sql=f"""{CH_SQL},
h AS ({_hits_sql('live_subs')}),
hb AS ({_hits_sql('live_subs_b')})
SELECT channel, doc_id, xpath FROM h
WHERE NOT EXISTS (SELECT 1 FROM hb WHERE hb.channel = h.channel AND hb.doc_id = h.doc_id)""")
def q_new_hits(spark, sf_dir):
    """Associations not present under the earlier snapshot."""
    now = ChannelState(spark, sf_dir)
    _, before = now.at(CUTOFF)
    m = _matches(spark, sf_dir, now.live_subs.select("xpath").union(before.select("xpath")))
    hits = ch.fan_out(m, now.live_subs)
    old = ch.fan_out(m, before)
    return ch.new_associations(hits, old).select("channel", "doc_id", "xpath")


@query("matched_pages", sql=f"""{CH_SQL}
SELECT ox.o_orderkey AS doc_id, count(*) AS n_xpaths
FROM (SELECT DISTINCT xpath, tk, p1, p2 FROM subs) s JOIN ox ON {HOLDS} GROUP BY ox.o_orderkey""")
def q_matched_pages(spark, sf_dir):
    """A5: documents matched by any subscribed expression, channels alive or not."""
    st = ChannelState(spark, sf_dir)
    return ch.matched_any(_matches(spark, sf_dir, st.subs))


@query("channel_status", sql=f"""{CH_SQL},
h AS ({_hits_sql('live_subs')})
SELECT l.channel, CAST(count(DISTINCT h.doc_id) AS BIGINT) AS n_pages,
       CASE WHEN count(h.doc_id) = 0 THEN 'empty' ELSE 'ok' END AS status
FROM live l LEFT JOIN h USING (channel) GROUP BY l.channel""")
def q_channel_status(spark, sf_dir):
    """Per live channel, attached documents and ``empty`` status."""
    st = ChannelState(spark, sf_dir)
    hits = ch.fan_out(_matches(spark, sf_dir, st.live_subs), st.live_subs)
    pages = hits.select("channel", F.concat(F.lit("urn:order:"), F.col("doc_id").cast("string")).alias("url"))
    return ch.channel_status(st.live, pages)


@query("channel_content", sql=f"""{CH_SQL},
h AS ({_hits_sql('live_subs')})
SELECT channel, '!' || xsl_url AS entry FROM live
UNION SELECT channel, 'urn:order:' || doc_id FROM h""")
def q_channel_content(spark, sf_dir):
    """A4: a channel's stylesheet entry plus its document URLs, one row each."""
    st = ChannelState(spark, sf_dir)
    hits = ch.fan_out(_matches(spark, sf_dir, st.live_subs), st.live_subs)
    return (st.live.select("channel", F.concat(F.lit("!"), F.col("xsl_url")).alias("entry"))
            .unionByName(hits.select("channel", F.concat(F.lit("urn:order:"),
                                                         F.col("doc_id").cast("string")).alias("entry")))
            .distinct())


@query("prune_page_channels", sql=f"""{CH_SQL},
hb AS ({_hits_sql('live_subs_b')})
SELECT doc_id, coalesce(string_agg(CASE WHEN channel IN (SELECT channel FROM live) THEN channel END,
                                   ',' ORDER BY channel), '') AS channels
FROM hb GROUP BY doc_id""")
def q_prune_page_channels(spark, sf_dir):
    """A document's recorded channels intersected with the live ones."""
    now = ChannelState(spark, sf_dir)
    _, before = now.at(CUTOFF)
    old = ch.fan_out(_matches(spark, sf_dir, before), before)
    pages = (old.groupBy("doc_id").agg(F.collect_set("channel").alias("channels"))
             .withColumnRenamed("doc_id", "page_key"))
    pruned = ch.prune_page_channels(pages, now.live)
    return pruned.select(F.col("page_key").alias("doc_id"),
                         F.array_join(F.array_sort("channels"), ",").alias("channels"))


@query("merge_page_channels", sql=f"""{CH_SQL},
h AS ({_hits_sql('live_subs')}),
hb AS ({_hits_sql('live_subs_b')})
SELECT doc_id, string_agg(DISTINCT channel, ',' ORDER BY channel) AS channels
FROM (SELECT doc_id, channel FROM hb UNION ALL SELECT doc_id, channel FROM h) GROUP BY doc_id""")
def q_merge_page_channels(spark, sf_dir):
    """U4: recorded channels united with newly gained ones."""
    now = ChannelState(spark, sf_dir)
    _, before = now.at(CUTOFF)
    m = _matches(spark, sf_dir, now.subs)
    old = ch.fan_out(m, before)
    new = ch.fan_out(m, now.live_subs)
    pages = (old.groupBy("doc_id").agg(F.collect_set("channel").alias("channels"))
             .withColumnRenamed("doc_id", "page_key"))
    gained = new.select(F.col("doc_id").alias("page_key"), "channel")
    keys = pages.select("page_key").unionByName(gained.select("page_key")).distinct()
    base = keys.join(pages, "page_key", "left")
    merged = ch.merge_page_channels(base, gained)
    return merged.select(F.col("page_key").alias("doc_id"),
                         F.array_join("channels", ",").alias("channels"))
