"""Exploratory reports, derived figures and canned evidence."""

from orderlens.operators import evidence, explore, kpis, shared
from orderlens.plans.kpi import BUYER_REVENUE, REPEAT_RATE, REVIEWS_BY_PUNCTUALITY
from orderlens.plans.registry import STAR_SQL, query, star_query
from orderlens.sources import commerce

star_query("explore_monthly_revenue", kpis.revenue_by_month, """
SELECT year_month, count(DISTINCT order_id) AS orders, round(sum(rev), 2)::double AS revenue_brl
FROM fact GROUP BY year_month""")

RANKED = """
, c AS (SELECT category, count(DISTINCT order_id) AS orders, round(sum(rev), 2) AS r
        FROM fact JOIN prod USING (product_id) GROUP BY category),
k AS (SELECT *, row_number() OVER (ORDER BY r DESC, category) AS rank_desc, count(*) OVER () AS n FROM c),
ranked AS (SELECT CASE WHEN rank_desc <= 10 THEN 'top10' ELSE 'bottom10' END AS side, rank_desc, category,
                  r::double AS revenue_brl, orders FROM k WHERE rank_desc <= 10 OR rank_desc > n - 10)
"""
star_query("explore_category_extremes", explore.category_extremes, RANKED + "SELECT * FROM ranked")

ON_TIME_ALL = """
SELECT count(is_on_time) AS delivered_orders, count_if(is_on_time) AS on_time_orders,
       round(100.0::double * count_if(is_on_time) / count(is_on_time), 2) AS on_time_pct FROM bought"""
star_query("explore_on_time_overall", explore.on_time_overall, ON_TIME_ALL)

ON_TIME_STATES = """
SELECT customer_state, count(is_on_time) AS delivered_orders,
       round(100.0::double * count_if(is_on_time) / count(is_on_time), 1) AS on_time_pct
FROM bought_in GROUP BY customer_state HAVING count(is_on_time) >= 200"""
star_query("explore_on_time_by_state", explore.on_time_by_state, ON_TIME_STATES)

DAYS_BY_STATE = """
SELECT customer_state, count(delivery_days) AS delivered_orders, round(avg(delivery_days), 1) AS avg_delivery_days,
       (SELECT avg(delivery_days) FROM bought) AS natl_avg,
       round(round(avg(delivery_days), 1) - (SELECT avg(delivery_days) FROM bought), 1) AS days_vs_natl_avg
FROM bought_in GROUP BY customer_state HAVING count(delivery_days) >= 200"""
star_query("explore_delivery_days_by_state", explore.delivery_days_by_state, DAYS_BY_STATE)

star_query("explore_review_distribution", explore.review_distribution, """
SELECT review_score, count(*) AS orders,
       round(100.0::double * count(*) / (SELECT count(review_score) FROM bought), 1) AS pct
FROM bought WHERE review_score IS NOT NULL GROUP BY review_score""")

star_query("explore_late_vs_on_time_reviews", kpis.reviews_by_punctuality, REVIEWS_BY_PUNCTUALITY)
star_query("explore_repeat_rate", explore.repeat_rate, REPEAT_RATE.format(digits=3))
star_query("explore_revenue_by_buyer", explore.revenue_by_buyer,
           BUYER_REVENUE.format(label="buyer_type", repeat="repeat", one="one_time"))

query("explore_findings", lambda spark, folder: explore.findings(
    shared.explore_reports(shared.share_scan(commerce.star(spark, folder)))), STAR_SQL + RANKED + f"""
, m AS (SELECT year_month, round(sum(rev), 2)::double AS r FROM fact GROUP BY year_month),
s AS ({ON_TIME_STATES}), d AS ({DAYS_BY_STATE}), v AS ({REVIEWS_BY_PUNCTUALITY}),
o AS ({ON_TIME_ALL}), p AS ({REPEAT_RATE.format(digits=3)}),
b AS ({BUYER_REVENUE.format(label="buyer_type", repeat="repeat", one="one_time")})
SELECT (SELECT year_month FROM m ORDER BY r DESC, year_month LIMIT 1) AS peak_month,
       (SELECT max(r) FROM m) AS peak_month_brl,
       (SELECT round(sum(revenue_brl), 2) FROM ranked WHERE side = 'top10') AS top_brl,
       (SELECT round(sum(revenue_brl), 2) FROM ranked WHERE side = 'bottom10') AS bottom_brl,
       (SELECT category FROM ranked ORDER BY rank_desc LIMIT 1) AS top_category,
       (SELECT category FROM ranked ORDER BY rank_desc DESC LIMIT 1) AS last_category,
       o.on_time_pct, o.on_time_orders, o.delivered_orders,
       (SELECT customer_state FROM s ORDER BY on_time_pct, customer_state LIMIT 1) AS worst_state,
       (SELECT min(on_time_pct) FROM s) AS worst_state_pct,
       (SELECT customer_state FROM s ORDER BY on_time_pct DESC, customer_state DESC LIMIT 1) AS best_state,
       (SELECT max(on_time_pct) FROM s) AS best_state_pct,
       (SELECT customer_state FROM d ORDER BY avg_delivery_days DESC, customer_state LIMIT 1) AS slowest_state,
       (SELECT max(avg_delivery_days) FROM d) AS slowest_days,
       (SELECT round(avg_delivery_days - days_vs_natl_avg, 1) FROM d
        ORDER BY avg_delivery_days DESC, customer_state LIMIT 1) AS national_days,
       (SELECT avg_review_score FROM v WHERE is_on_time) AS on_time_score,
       (SELECT avg_review_score FROM v WHERE NOT is_on_time) AS late_score,
       (SELECT pct_1star FROM v WHERE NOT is_on_time) AS late_pct_1star,
       (SELECT pct_1star FROM v WHERE is_on_time) AS on_time_pct_1star,
       p.repeat_rate_pct, p.repeat_customers, p.total_customers, p.avg_orders_per_customer,
       (SELECT pct_of_revenue FROM b WHERE buyer_type = 'repeat') AS repeat_pct_of_revenue
FROM o, p""")

# ---------------------------------------------------------------- derived figures

star_query("derived_excess_late_orders",
           lambda star: explore.excess_late_orders(explore.on_time_by_state(star), explore.on_time_overall(star)), f"""
, s AS ({ON_TIME_STATES}), o AS ({ON_TIME_ALL}),
e AS (SELECT s.customer_state, s.delivered_orders, s.on_time_pct,
             round(s.delivered_orders * (o.on_time_pct - s.on_time_pct) / 100)::bigint AS excess_late_orders
      FROM s, o WHERE s.on_time_pct < o.on_time_pct)
SELECT * FROM e UNION ALL
SELECT 'Total', sum(delivered_orders)::bigint, NULL, sum(excess_late_orders)::bigint FROM e""")

ONE_STARS = """
, x AS (SELECT count(*) AS one_star_all, count_if(is_delivered) AS one_star_delivered,
               count_if(NOT is_delivered) AS one_star_undelivered, count_if(is_on_time = false) AS one_star_late
        FROM bought WHERE review_score = 1)
"""
star_query("derived_one_star_shares", explore.one_star_shares, ONE_STARS + """
SELECT *, round(100.0::double * one_star_late / nullif(one_star_all, 0), 1) AS late_pct_of_all,
       round(100.0::double * one_star_late / nullif(one_star_delivered, 0), 1) AS late_pct_of_delivered FROM x""")

star_query("derived_customer_value", explore.customer_value, """
, v AS (SELECT avg(revenue::double) FILTER (n_orders > 1) AS a, avg(revenue::double) FILTER (n_orders = 1) AS b
        FROM person)
SELECT round(a, 2) AS repeat_revenue_per_customer, round(b, 2) AS one_time_revenue_per_customer,
       round(a / b, 2) AS ratio FROM v""")

star_query("derived_top_category_share", explore.top_category_share, """
, c AS (SELECT category, round(sum(rev), 2) AS r FROM fact JOIN prod USING (product_id) GROUP BY category),
t AS (SELECT r FROM c ORDER BY r DESC, category LIMIT 10)
SELECT sum(r)::double AS top_revenue_brl,
       round(100.0::double * sum(r)::double / (SELECT sum(r) FROM c)::double, 1) AS pct_of_revenue FROM t""")

star_query("derived_what_if_repeat", explore.what_if_repeat, """
, v AS (SELECT (SELECT count(*) FROM person) AS customers, sum(order_revenue)::double / count(*) AS aov FROM money)
SELECT customers, round(0.01::double * customers)::bigint AS extra_customers, round(aov, 2) AS avg_order_value,
       round(0.01::double * customers * aov, 2) AS added_revenue_brl FROM v""")

star_query("derived_what_if_late_reviews", explore.what_if_late_reviews, ONE_STARS + """
SELECT one_star_late, one_star_late * 0.5::double AS one_stars_avoided FROM x""")

# ---------------------------------------------------------------- canned evidence

TOTAL = """
SELECT sum(order_revenue)::double AS total_revenue_brl, count(*) AS orders FROM money"""
star_query("evidence_total_revenue", evidence.total_revenue, TOTAL)

DENOMINATORS = """
SELECT one_star_all AS one_star_ALL_reviewed_orders_incl_undelivered,
       one_star_delivered AS one_star_DELIVERED_orders_only,
       one_star_undelivered AS one_star_undelivered_orders,
       round(100.0::double * one_star_late / nullif(one_star_all, 0), 1)
         AS late_one_star_pct_of_ALL_one_star_incl_undelivered,
       round(100.0::double * one_star_late / nullif(one_star_delivered, 0), 1)
         AS late_one_star_pct_of_DELIVERED_one_star_only FROM x"""
star_query("evidence_one_star_denominators", evidence.one_star_denominators, ONE_STARS + DENOMINATORS)

PUNCTUAL = """
SELECT if(is_on_time, 'on-time', 'late') AS delivery, round(avg(review_score), 2) AS avg_review_score,
       count_if(review_score = 1) AS one_star_orders, count(*) AS reviewed_orders
FROM bought WHERE is_delivered AND review_score > 0 GROUP BY 1"""
star_query("evidence_punctuality_reviews", evidence.punctuality_reviews, PUNCTUAL)

STATES = """
WITH s AS (SELECT customer_state, count(DISTINCT order_id) AS delivered_orders,
                  count(DISTINCT CASE WHEN is_on_time THEN order_id END) AS ok, avg(delivery_days) AS days
           FROM fact JOIN cust USING (customer_id) WHERE is_delivered GROUP BY customer_state)
SELECT customer_state, delivered_orders, round(100.0::double * ok / delivered_orders, 1) AS ontime_pct,
       round(days, 1) AS avg_delivery_days FROM s WHERE delivered_orders >= 50
ORDER BY ontime_pct, customer_state LIMIT 10"""
star_query("evidence_states_worst_first", evidence.states_worst_first, f"SELECT * FROM ({STATES})")

REPEATERS = """
SELECT count(*) AS total_customers, count_if(n_orders > 1) AS repeat_customers,
       round(100.0::double * count_if(n_orders > 1) / count(*), 2) AS repeat_pct FROM person"""
star_query("evidence_repeat_customers", evidence.repeat_customers, REPEATERS)

CATEGORIES = """
SELECT category, sum(rev)::double AS revenue_brl FROM fact JOIN prod USING (product_id) GROUP BY category
ORDER BY sum(rev) DESC, category LIMIT 10"""
star_query("evidence_top_category_revenue", evidence.top_category_revenue, CATEGORIES)

ITEM_HEADLINE = """
SELECT sum(rev)::double AS revenue_brl, round(100.0::double * count_if(is_on_time) / count(*), 2)
         AS ontime_pct_delivered,
       round(avg(delivery_days), 1) AS avg_delivery_days, round(avg(review_score), 2) AS avg_review_score
FROM fact WHERE is_delivered"""
star_query("evidence_headline_items", evidence.headline_items, ITEM_HEADLINE)


def _block(intent: str, part: int, name: str, source: str, columns: dict[str, int | None], order: str = "1") -> str:
    """SQL of one evidence block: the lines of a report as text."""
    shown = ", ".join(f"concat('{c}=', {c}{f'::decimal(38,{d})' if d else ''})" for c, d in columns.items())
    return (f"SELECT '{intent}' AS intent, {part} AS part, 'SQL: {name}' AS label, "
            f"concat('Result of query ''{name}'':', chr(10), "
            f"string_agg(concat('  ', concat_ws(', ', {shown})), chr(10) ORDER BY {order})) AS content, "
            f"false AS truncated FROM ({source})")


EVIDENCE_SQL = ONE_STARS + ", blocks AS (" + " UNION ALL ".join([
    _block("total revenue", 0, "total revenue", TOTAL, {"total_revenue_brl": 2, "orders": None}),
    _block("on-time delivery by state (worst first)", 0, "on-time delivery by state (worst first)", STATES,
           {"customer_state": None, "delivered_orders": None, "ontime_pct": 1, "avg_delivery_days": 1},
           "ontime_pct, customer_state"),
    _block("review score of late vs on-time orders", 0, "review score of late vs on-time orders", PUNCTUAL,
           {"delivery": None, "avg_review_score": 2, "one_star_orders": None, "reviewed_orders": None}, "delivery"),
    _block("review score of late vs on-time orders", 1, "one-star shares with explicit denominators", DENOMINATORS,
           {"one_star_ALL_reviewed_orders_incl_undelivered": None, "one_star_DELIVERED_orders_only": None,
            "one_star_undelivered_orders": None, "late_one_star_pct_of_ALL_one_star_incl_undelivered": 1,
            "late_one_star_pct_of_DELIVERED_one_star_only": 1}),
    _block("repeat purchase rate and revenue split", 0, "repeat purchase rate and revenue split", REPEATERS,
           {"total_customers": None, "repeat_customers": None, "repeat_pct": 2}),
    _block("revenue by product category (top 10)", 0, "revenue by product category (top 10)", CATEGORIES,
           {"category": None, "revenue_brl": 2}, "revenue_brl DESC, category"),
    _block("headline KPIs (fallback)", 0, "headline KPIs (fallback)", ITEM_HEADLINE,
           {"revenue_brl": 2, "ontime_pct_delivered": 2, "avg_delivery_days": 1, "avg_review_score": 2}),
]) + ")"
query("evidence_blocks", lambda spark, folder: evidence.evidence_table(commerce.stored_star(spark, folder)),
      STAR_SQL + EVIDENCE_SQL + " SELECT * FROM blocks")
