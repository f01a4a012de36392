"""Datasets of the interactive report, over the whole selection unless a filter is the point of the query."""

from datetime import date

from orderlens.operators import cells, report
from orderlens.plans.registry import star_query
from orderlens.session import scratch_path
from orderlens.sources.star import Star

FILTERS = report.Filters(date(1996, 3, 15), date(1999, 10, 31),
                         tuple(f"NATION_{i}" for i in (1, 2, 3, 5, 8, 13, 21)),
                         ("small widget", "red widget", "cold widget", "unknown", "blue anvil", "small ring"))
WHERE = """
WHERE purchase_ts::date BETWEEN DATE '1996-03-15' AND DATE '1999-10-31'
  AND customer_state IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_5', 'NATION_8', 'NATION_13', 'NATION_21')
  AND category IN ('small widget', 'red widget', 'cold widget', 'unknown', 'blue anvil', 'small ring')"""

VIEW = """
, view AS (SELECT order_id, order_item_id, purchase_ts, rev, delivery_days, is_delivered, is_on_time, review_score,
                  customer_state, f.customer_unique_id, category, year_month AS month
           FROM fact f JOIN cust USING (customer_id) JOIN prod USING (product_id) {where}),
ordv AS (SELECT order_id, any_value(month) AS month, any_value(customer_state) AS customer_state,
                any_value(customer_unique_id) AS pid, any_value(delivery_days) AS delivery_days,
                bool_or(is_delivered) AS is_delivered, bool_or(is_on_time) AS is_on_time,
                any_value(review_score) AS review_score, arg_min(category, order_item_id) AS category,
                sum(rev) AS r FROM view GROUP BY order_id),
ppl AS (SELECT pid, count(*) AS n, sum(r) AS r FROM ordv GROUP BY pid)
"""
ALL = VIEW.format(where="")
SOME = VIEW.format(where=WHERE)


SELECTS = {}  # the SQL of each chart over the selection


def _report(name, function, select, filters=report.Filters()):
    SELECTS[name.removeprefix("report_")] = select

    def build(star: Star):
        return function(report.filtered_items(report.item_view(star), filters))
    star_query(name, build, (ALL if filters == report.Filters() else SOME) + select)


VIEW_COLUMNS = """
SELECT order_id, order_item_id, purchase_ts, rev::double AS item_revenue, delivery_days, is_delivered, is_on_time,
       review_score, customer_state, customer_unique_id, category, month FROM view"""


def _with_double(items):
    return items.withColumn("item_revenue", items["item_revenue"].cast("double"))


star_query("report_item_view", lambda star: _with_double(report.item_view(star)), ALL + VIEW_COLUMNS)
_report("report_filtered_items", _with_double, VIEW_COLUMNS, FILTERS)
SELECTS["filter_domains"] = """
SELECT 'date_min' AS domain, min(purchase_ts)::date::varchar AS value FROM view
UNION ALL SELECT 'date_max', max(purchase_ts)::date::varchar FROM view
UNION ALL SELECT DISTINCT 'state', customer_state FROM view
UNION ALL SELECT DISTINCT 'category', category FROM view"""
star_query("report_filter_domains", lambda star: report.filter_domains(report.item_view(star)), ALL + SELECTS["filter_domains"])
_report("report_orders", report.orders_view, """
SELECT order_id, month, customer_state, pid AS customer_unique_id, delivery_days, is_delivered, is_on_time,
       review_score, category FROM ordv""")

CARDS = """
SELECT coalesce(round(sum(r), 2)::double, 0.0) AS revenue,
       round(100.0::double * count_if(is_on_time) / nullif(count_if(is_delivered), 0), 1) AS on_time_pct,
       round(avg(review_score), 2) AS avg_score,
       (SELECT round(100.0::double * count_if(n > 1) / nullif(count(*), 0), 1) FROM ppl) AS repeat_rate FROM ordv"""
_report("report_kpi_cards", report.kpi_cards, CARDS)
_report("report_kpi_cards_filtered", report.kpi_cards, CARDS, FILTERS)

_report("report_monthly_revenue", report.monthly_revenue, """
SELECT month, round(sum(r), 2)::double AS revenue_brl, count(*) AS orders FROM ordv GROUP BY month""")
_report("report_top_states", report.top_states, """
SELECT customer_state, round(sum(rev), 2)::double AS item_revenue FROM view GROUP BY customer_state
ORDER BY sum(rev) DESC, customer_state LIMIT 15""")
_report("report_top_categories", report.top_categories, """
SELECT category, round(sum(rev), 2)::double AS item_revenue FROM view GROUP BY category
ORDER BY sum(rev) DESC, category LIMIT 15""")
_report("report_delivery_days_by_state", report.delivery_days_by_state, """
SELECT customer_state, round(avg(delivery_days), 1) AS avg_days, count(delivery_days) AS n,
       (SELECT round(avg(delivery_days), 1) FROM ordv) AS natl_avg
FROM ordv GROUP BY customer_state HAVING count(delivery_days) >= 200""")
_report("report_on_time_by_month", report.on_time_by_month, """
SELECT month, round(100.0::double * count_if(is_on_time) / count(is_on_time), 1) AS on_time_pct, count(*) AS n,
       (SELECT round(100.0::double * count_if(is_on_time) / count(is_on_time), 1) FROM ordv) AS overall
FROM ordv WHERE is_delivered GROUP BY month""")
_report("report_late_by_category", report.late_by_category, """
SELECT category, count(*) AS late_orders FROM ordv WHERE is_delivered AND NOT is_on_time GROUP BY category
ORDER BY late_orders DESC, category LIMIT 15""")
_report("report_score_distribution", report.score_distribution, """
SELECT review_score, count(*) AS orders, round(100.0::double * count(*) / (SELECT count(review_score) FROM ordv), 1)
         AS pct FROM ordv WHERE review_score IS NOT NULL GROUP BY review_score""")
_report("report_scores_by_punctuality", report.scores_by_punctuality, """
SELECT if(is_on_time, 'On-time', 'Late') AS label, round(avg(review_score), 2) AS avg_score, count(*) AS n
FROM ordv WHERE is_on_time IS NOT NULL AND review_score IS NOT NULL GROUP BY is_on_time""")
_report("report_worst_reviewed_categories", report.worst_reviewed_categories, """
, c AS (SELECT category, avg(review_score) AS a, count(review_score) AS n FROM ordv GROUP BY category)
SELECT category, round(a, 2) AS avg_score, n FROM c WHERE n >= 200 ORDER BY a, category LIMIT 15""")
_report("report_buyer_types", report.buyer_types, """
SELECT order_id, pid AS customer_unique_id, n AS n_orders_per_cust,
       if(n > 1, 'Repeat (2+ orders)', 'One-time') AS buyer_type FROM ordv JOIN ppl USING (pid)""")
_report("report_buyer_shares", report.buyer_shares, """
, s AS (SELECT if(n > 1, 'Repeat (2+ orders)', 'One-time') AS buyer_type, count(*) AS c, sum(r) AS r
        FROM ppl GROUP BY 1),
t AS (SELECT b.buyer_type, coalesce(c, 0) AS c, coalesce(r, 0) AS r, sum(c) OVER () AS tc, sum(r) OVER () AS tr
      FROM (VALUES ('One-time'), ('Repeat (2+ orders)')) b(buyer_type) LEFT JOIN s USING (buyer_type))
SELECT buyer_type, '% of customers' AS share_type, round(100.0::double * c::double / tc::double, 1) AS pct FROM t
UNION ALL SELECT buyer_type, '% of revenue', round(100.0::double * r::double / tr::double, 1) FROM t""")
_report("report_orders_per_customer", report.orders_per_customer, """
SELECT if(n >= 5, '5+', n::varchar) AS orders, count(*) AS customers FROM ppl GROUP BY 1""")


# ---------------------------------------------------------------- the same charts from stored cells

DATES = report.Filters(date(1994, 2, 14), date(1996, 7, 3))
SOME_DAYS = VIEW.format(where="WHERE purchase_ts::date BETWEEN DATE '1994-02-14' AND DATE '1996-07-03'")


def _from_cells(name, chart, filters, view):
    def build(star: Star):
        spark = star.fact_orders.sparkSession
        folder = scratch_path(spark, "cells")
        cells.write_cells(cells.build_star_cells(star), folder)
        return cells.CHARTS[chart](cells.selected(cells.read_cells(spark, folder), filters))
    star_query(name, build, view + SELECTS[chart])


RARE = ("delivery_days_by_state", "worst_reviewed_categories")  # want many orders, so they get the whole selection
for _chart in cells.CHARTS:
    _from_cells(f"cells_{_chart}", _chart, *((report.Filters(), ALL) if _chart in RARE else (FILTERS, SOME)))
_from_cells("cells_kpi_cards_all", "kpi_cards", report.Filters(), ALL)
_from_cells("cells_kpi_cards_dates", "kpi_cards", DATES, SOME_DAYS)
_from_cells("cells_buyer_shares_dates", "buyer_shares", DATES, SOME_DAYS)
_from_cells("cells_late_by_category_dates", "late_by_category", DATES, SOME_DAYS)
