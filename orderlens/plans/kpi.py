"""KPI and service reports."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators import kpis, service, shared
from orderlens.plans.registry import QUERIES, STAR_SQL, query, star_query
from orderlens.session import scratch_path
from orderlens.sources import buckets, commerce

REVENUE_BY_MONTH = """
SELECT year_month, count(*) AS orders, round(sum(order_revenue), 2)::double AS revenue_brl
FROM bought JOIN money USING (order_id) GROUP BY ALL"""
star_query("kpi_revenue_by_month", kpis.revenue_by_month, REVENUE_BY_MONTH)

star_query("kpi_revenue_by_state", kpis.revenue_by_state, """
, s AS (SELECT customer_state, count(*) AS orders, sum(order_revenue) AS r
        FROM bought_in JOIN money USING (order_id) GROUP BY ALL)
SELECT customer_state, orders, round(r, 2)::double AS revenue_brl,
       round(100.0::double * r::double / (SELECT sum(r) FROM s)::double, 1) AS pct_of_total FROM s""")

star_query("kpi_revenue_by_category", kpis.revenue_by_category, """
SELECT category, count(DISTINCT order_id) AS orders, round(sum(rev), 2)::double AS revenue_brl
FROM fact JOIN prod USING (product_id) GROUP BY ALL""")

star_query("kpi_on_time_rate", kpis.on_time_rate, """
SELECT count(is_on_time) AS delivered_orders, count_if(is_on_time) AS on_time_orders,
       round(100.0::double * count_if(is_on_time) / count(is_on_time), 2) AS on_time_pct,
       count_if(NOT is_on_time) AS late_orders FROM bought""")

star_query("kpi_delivery_days_by_month", kpis.delivery_days_by_month, """
SELECT year_month, count(*) AS delivered_orders, round(avg(delivery_days), 1) AS avg_delivery_days,
       round(quantile_cont(delivery_days, 0.5), 1) AS median_delivery_days
FROM bought WHERE delivery_days IS NOT NULL GROUP BY ALL""")

star_query("kpi_review_scores", kpis.review_scores, """
SELECT count(review_score) AS reviewed_orders, round(avg(review_score), 2) AS avg_review_score,
       count_if(review_score = 1) AS score_1, count_if(review_score = 2) AS score_2,
       count_if(review_score = 3) AS score_3, count_if(review_score = 4) AS score_4,
       count_if(review_score = 5) AS score_5 FROM bought""")

REPEAT_RATE = """
SELECT count(*) AS total_customers, count_if(n_orders > 1) AS repeat_customers,
       round(100.0::double * count_if(n_orders > 1) / count(*), 2) AS repeat_rate_pct,
       round(avg(n_orders), {digits}) AS avg_orders_per_customer FROM person"""
star_query("kpi_repeat_rate", kpis.repeat_rate, REPEAT_RATE.format(digits=2))

REVIEWS_BY_PUNCTUALITY = """
SELECT is_on_time, count(*) AS orders, round(avg(review_score), 2) AS avg_review_score,
       round(100.0::double * count_if(review_score = 1) / count(*), 1) AS pct_1star
FROM bought WHERE is_on_time IS NOT NULL AND review_score IS NOT NULL GROUP BY ALL"""
star_query("kpi_reviews_by_punctuality", kpis.reviews_by_punctuality, REVIEWS_BY_PUNCTUALITY)

star_query("kpi_top_categories", kpis.top_categories, """
, c AS (SELECT category, round(sum(rev), 2) AS r FROM fact JOIN prod USING (product_id) GROUP BY ALL),
w AS (SELECT *, sum(r) OVER () AS total, sum(r) OVER (ORDER BY r DESC, category ROWS UNBOUNDED PRECEDING) AS upto,
             row_number() OVER (ORDER BY r DESC, category) AS k FROM c)
SELECT category, r::double AS revenue_brl, round(100.0::double * r::double / total::double, 1) AS pct_of_total,
       round(100.0::double * upto::double / total::double, 1) AS cumulative_pct FROM w WHERE k <= 10""")

star_query("kpi_delivery_distribution", kpis.delivery_distribution, """
, b AS (SELECT CASE WHEN delivery_days > 60 THEN '6. 60+ days (very late)'
                    WHEN delivery_days > 30 THEN '5. 31-60 days' WHEN delivery_days > 14 THEN '4. 15-30 days'
                    WHEN delivery_days > 7 THEN '3. 8-14 days' WHEN delivery_days > 3 THEN '2. 4-7 days'
                    ELSE '1. 0-3 days (fast)' END AS delivery_bucket
        FROM bought WHERE is_delivered)
SELECT delivery_bucket, count(*) AS orders,
       round(100.0::double * count(*) / (SELECT count(*) FROM b), 1) AS pct_of_delivered FROM b GROUP BY ALL""")

star_query("kpi_payment_types", kpis.payment_types, """
SELECT payment_type, count(DISTINCT order_id) AS orders, count(*) AS payment_rows,
       round(sum(payment_value), 2)::double AS paid_brl,
       round(100.0::double * sum(payment_value)::double / (SELECT sum(payment_value) FROM pay)::double, 1)
         AS pct_of_value,
       round(avg(payment_installments), 1) AS avg_installments FROM pay GROUP BY payment_type""")

BUYER_REVENUE = """
SELECT CASE WHEN n_orders > 1 THEN '{repeat}' ELSE '{one}' END AS {label}, sum(n_orders)::bigint AS orders,
       round(sum(revenue), 2)::double AS revenue_brl,
       round(100.0::double * sum(revenue)::double / (SELECT sum(revenue) FROM person)::double, 1) AS pct_of_revenue
FROM person GROUP BY 1"""
star_query("kpi_repeat_vs_one_time_revenue", kpis.repeat_vs_one_time_revenue,
           BUYER_REVENUE.format(label="customer_type", repeat="repeat_customer", one="one_time_customer"))

star_query("kpi_worst_states", kpis.worst_states, """
SELECT customer_state, count(*) AS delivered_orders,
       round(100.0::double * count_if(is_on_time) / count(*), 1) AS on_time_pct,
       round(avg(delivery_days), 1) AS avg_delivery_days
FROM bought_in WHERE is_delivered GROUP BY customer_state HAVING count(*) > 199""")

star_query("kpi_worst_categories", kpis.worst_categories, """
, pairs AS (SELECT order_id, product_id, any_value(is_on_time) AS ok, any_value(delivery_days) AS days
            FROM fact WHERE is_delivered GROUP BY order_id, product_id)
SELECT category, count(*) AS delivered_orders, round(100.0::double * count_if(ok) / count(*), 1) AS on_time_pct,
       round(avg(days), 1) AS avg_delivery_days
FROM pairs JOIN prod USING (product_id) GROUP BY category HAVING count(*) > 199""")

star_query("kpi_monthly_experience", kpis.monthly_experience, """
SELECT year_month, count(*) AS orders, round(100.0::double * count_if(is_on_time) / count(*), 1) AS on_time_pct,
       round(avg(review_score), 2) AS avg_review_score, round(avg(delivery_days), 1) AS avg_delivery_days
FROM bought WHERE is_delivered GROUP BY year_month""")

HEADLINE = """
SELECT (SELECT round(sum(rev), 2)::double FROM fact) AS total_revenue_brl,
       (SELECT round(100.0::double * count_if(is_on_time) / count_if(is_delivered), 2) FROM bought) AS on_time_pct,
       (SELECT round(avg(review_score), 2) FROM bought) AS avg_review_score,
       (SELECT round(100.0::double * count_if(n_orders > 1) / count(*), 2) FROM person) AS repeat_purchase_rate_pct"""
star_query("service_headline_kpis", service.headline_kpis, HEADLINE)

star_query("service_kpis_by_state", service.kpis_by_state, """
SELECT customer_state, count_if(is_delivered) AS delivered_orders,
       round(100.0::double * count_if(is_on_time) / nullif(count_if(is_delivered), 0), 1) AS on_time_pct,
       round(avg(delivery_days), 1) AS avg_delivery_days FROM bought_in GROUP BY customer_state""")

# ---------------------------------------------------------------- all fifteen from one pass over the fact

# The registered report behind each stored name, with its key column where it has one.
STORED = dict(zip(
    ["01_revenue_by_month", "02_revenue_by_state", "03_revenue_by_category", "04_on_time_delivery_pct", "05_avg_delivery_days",
     "06_avg_review_score", "07_repeat_purchase_rate", "08_late_vs_ontime_review_scores", "09_top10_categories",
     "10_delivery_days_distribution", "11_payment_types", "12_repeat_vs_onetime_revenue", "13_worst_states_on_time",
     "14_worst_categories_on_time", "15_monthly_ontime_vs_reviews"],
    [("revenue_by_month", "year_month"), ("revenue_by_state", "customer_state"), ("revenue_by_category", "category"),
     ("on_time_rate", None), ("delivery_days_by_month", "year_month"), ("review_scores", None), ("repeat_rate", None),
     ("reviews_by_punctuality", "is_on_time"), ("top_categories", "category"), ("delivery_distribution", "delivery_bucket"),
     ("payment_types", "payment_type"), ("repeat_vs_one_time_revenue", "customer_type"), ("worst_states", "customer_state"),
     ("worst_categories", "category"), ("monthly_experience", "year_month")]))


def _all_reports(spark, folder):
    """Every figure of every report: (report, key, measure, value)."""
    parts = []
    for name, report in shared.kpi_reports(shared.share_scan(commerce.star(spark, folder))).items():
        key = STORED[name][1]
        figures = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"))
                            for c in report.columns if c != key])
        parts.append(report.select(F.lit(name).alias("report"), (F.col(key) if key else F.lit("")).cast("string").alias("key"),
                                   F.inline(figures)))
    return reduce(DataFrame.unionByName, parts)


def _figures(name, report, key):
    own = QUERIES[f"kpi_{report}"].sql.removeprefix(STAR_SQL).strip()
    own = "WITH" + own[1:] if own.startswith(",") else own
    kept = f"{key}::varchar AS key, COLUMNS(* EXCLUDE ({key}))::double" if key else "'' AS key, COLUMNS(*)::double"
    return f"""SELECT '{name}' AS report, key, measure, value FROM (SELECT {kept} FROM ({own}))
  UNPIVOT INCLUDE NULLS (value FOR measure IN (COLUMNS(* EXCLUDE (key))))"""


query("shared_kpi_reports", _all_reports, STAR_SQL + " UNION ALL ".join(_figures(n, *r) for n, r in STORED.items()))

# ---------------------------------------------------------------- the same reports on the fact in buckets by order


def _bucketed(report):
    def build(spark, folder):
        path = scratch_path(spark, "bucketed")
        buckets.write_bucketed_star(commerce.star(spark, folder), path, 16)
        return report(buckets.open_bucketed_star(spark, path))
    return build


query("layout_headline_kpis", _bucketed(service.headline_kpis), STAR_SQL + HEADLINE)
query("layout_delivery_days_by_month", _bucketed(kpis.delivery_days_by_month), QUERIES["kpi_delivery_days_by_month"].sql)
query("layout_repeat_rate", _bucketed(kpis.repeat_rate), QUERIES["kpi_repeat_rate"].sql)
