"""Parameter sets used by the registered queries.

Expression sets are query *parameters* (the standing queries); the documents
they run over always come from the input tables.  Each order expression is
listed with the SQL predicate that states the same condition on the base
tables (``ox`` = order joined with its first line, see ``q_xpath.OX_CTE``).
"""

from __future__ import annotations

# (xpath, SQL predicate over ox) -- ``ox`` columns: o_orderpriority, o_orderstatus,
# o_date, has_line, f_flag, f_st, f_pk (first line by the document order).
ORDER_XPATHS: list[tuple[str, str]] = [
    ('/g:order[@pri="1-URGENT"]', "o_orderpriority = '1-URGENT'"),
    ('/g:order/status[text()="F"]', "o_orderstatus = 'F'"),
    ('/g:order/line[@flag="R"]/st[text()="F"]', "f_flag = 'R' AND f_st = 'F'"),
    ('/g:order/line/pk[contains(text(),"7")]', "contains(f_pk, '7')"),
    ('/g:order[status[text()="O"]][line/st[text()="O"]]', "o_orderstatus = 'O' AND f_st = 'O'"),
    ('/g:order/date[contains(text(),"1995-")]', "contains(o_date, '1995-')"),
    ('/g:order/line', "has_line"),
    ('/g:orders', "false"),
    ('/g:order/line/line', "false"),
    ('/g:order[@pri="5-LOW"]/line[@flag="A"][st[text()="O"]]/pk',
     "o_orderpriority = '5-LOW' AND f_flag = 'A' AND f_st = 'O'"),
    ('/g:order[@pri]', "false"),
    ('/g:order/status[contains(text(),"P")]', "contains(o_orderstatus, 'P')"),
    ('/g:order/line[@flag="N"]', "f_flag = 'N'"),
    ('/g:order/line[st[text()="F"]][pk]', "f_st = 'F'"),
    ('/g:order[date[contains(text(),"-12-")]]/status[text()="O"]',
     "contains(o_date, '-12-') AND o_orderstatus = 'O'"),
]

# xpath -> channels (many-to-many), as a subscriber would register them.
ORDER_SUBSCRIPTIONS: list[tuple[str, str]] = [
    ('/g:order[@pri="1-URGENT"]', "urgent"),
    ('/g:order[@pri="1-URGENT"]', "escalations"),
    ('/g:order/status[text()="F"]', "fulfilled"),
    ('/g:order/line[@flag="R"]/st[text()="F"]', "returns"),
    ('/g:order/line[@flag="R"]/st[text()="F"]', "escalations"),
    ('/g:order/line/pk[contains(text(),"7")]', "sevens"),
    ('/g:order[status[text()="O"]][line/st[text()="O"]]', "open"),
    ('/g:order/date[contains(text(),"1995-")]', "y1995"),
    ('/g:order/line', "nonempty"),
    ('/g:orders', "nothing"),
    ('/g:order[@pri="5-LOW"]/line[@flag="A"][st[text()="O"]]/pk', "lowopen"),
    ('/g:order[@pri]', "broken"),
    ('/g:order/status[contains(text(),"P")]', "partial"),
    ('/g:order/line[@flag="N"]', "normal"),
    ('/g:order[date[contains(text(),"-12-")]]/status[text()="O"]', "december"),
]
