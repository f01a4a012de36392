"""Late-delivery risk: training data, split, evaluation, models, batch scoring."""

from functools import lru_cache

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orderlens.operators import quality, risk, service
from orderlens.plans.registry import STAR_SQL, query, star_query
from orderlens.session import scratch_path, shuffles_removed
from orderlens.sources import commerce

# The full forest, fitted on all training rows.
FOREST = risk.ForestSize()
KEYS = ["order_id", "order_item_id"]


def _matrix(star):
    return risk.with_label(risk.with_features(risk.training_set(star)))


TRAINING = """
, t AS (SELECT order_id, order_item_id, product_id, purchase_ts, estimated_delivery_ts, price::double AS price,
               freight_value::double AS freight_value, is_on_time, customer_state, category AS product_category_en,
               product_weight_g, length_cm, height_cm, width_cm, seller_state, promise,
               if(is_on_time, 0, 1)::int AS is_late
        FROM fact JOIN cust USING (customer_id) JOIN prod USING (product_id) JOIN sell USING (seller_id)
        WHERE is_delivered)
"""


def _plain(frame):
    return frame.withColumns({c: F.col(c).cast("double") for c in ("price", "freight_value")})


star_query("risk_training_set", lambda star: _plain(risk.training_set(star)), TRAINING + """
SELECT * EXCLUDE (product_id, promise, is_late) FROM t""")

star_query("risk_features", lambda star: _plain(_matrix(star)).select(*KEYS, *risk.FEATURES, risk.LABEL), TRAINING + """
SELECT order_id, order_item_id, month(purchase_ts)::int AS purchase_month, hour(purchase_ts)::int AS purchase_hour,
       (isodow(purchase_ts) - 1)::int AS purchase_dow,
       round_even(date_diff('microsecond', purchase_ts, estimated_delivery_ts) / 86400000000.0::double, 1)
         AS estimated_lead_days,
       freight_value, price, product_weight_g, length_cm, height_cm, width_cm, customer_state, product_category_en,
       seller_state, is_late FROM t""")


def _split(star):
    rows = risk.stratified_split(_matrix(star).select(*KEYS, risk.LABEL), KEYS)
    return rows.select(*KEYS, risk.LABEL, "is_test")


SPLIT = TRAINING + """
, u AS (SELECT order_id, order_item_id, is_late,
               ('0x' || substr(md5(concat_ws('|', order_id, order_item_id, '42')), 1, 13))::bigint AS u FROM t),
k AS (SELECT *, row_number() OVER (PARTITION BY is_late ORDER BY u) AS n, count(*) OVER (PARTITION BY is_late) AS c
      FROM u),
split AS (SELECT order_id, order_item_id, is_late, n <= floor(0.2::double * (c - 1)) + 1 AS is_test FROM k)
"""
star_query("risk_split", _split, SPLIT + "SELECT * FROM split")


def _medians(star):
    long = _matrix(star).select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double")
                                                            .alias("value")) for c in risk.NUMERIC])))
    return risk.exact_percentile(long, ["feature"], "value", 0.5, name="median")


star_query("risk_medians", _medians, TRAINING + """
, f AS (SELECT month(purchase_ts)::double AS purchase_month, hour(purchase_ts)::double AS purchase_hour,
               (isodow(purchase_ts) - 1)::double AS purchase_dow, promise::double AS estimated_lead_days,
               freight_value, price, product_weight_g, length_cm, height_cm, width_cm FROM t),
u AS (UNPIVOT f ON * INTO NAME feature VALUE value)
SELECT feature, quantile_cont(value, 0.5) AS median FROM u GROUP BY feature""")


def _surrogate(star):
    """A score for every delivered item that follows from its keys, to check the evaluation on known numbers."""
    fact = star.fact_orders.filter("is_delivered")
    score = ((F.col("order_id") * 37 + F.col("product_id") * 11) % 100).cast("double") / 100
    return risk.with_label(fact).select(*KEYS, risk.LABEL, score.alias("late_probability"))


SCORED = """
, s AS (SELECT if(is_on_time, 0, 1) AS y, ((order_id * 37 + product_id * 11) % 100)::double / 100 AS p
        FROM fact WHERE is_delivered)
"""
star_query("risk_evaluation", lambda star: risk.evaluate("surrogate", _surrogate(star)), SCORED + """
, c AS (SELECT count(*) AS n, count_if(y = 1 AND p > 0.5) AS tp, count_if(y = 0 AND p > 0.5) AS fp,
               count_if(y = 1 AND p <= 0.5) AS fn FROM s),
b AS (SELECT p, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM s GROUP BY p),
a AS (SELECT pos, neg, sum(neg) OVER (ORDER BY p) - neg AS below FROM b)
SELECT 'surrogate' AS model, round((n - fp - fn)::double / n, 4) AS accuracy, round(tp::double / (tp + fp), 4)
         AS precision, round(tp::double / (tp + fn), 4) AS recall,
       (SELECT round(sum(pos * (below + neg / 2.0::double))::double / (sum(pos) * sum(neg))::double, 4) FROM a)
         AS roc_auc FROM c""")

star_query("risk_band_quality", lambda star: risk.band_quality(_surrogate(star)), SCORED + """
, c AS (SELECT count(*) AS n, count_if(p >= 0.3) AS f, count_if(y = 1) AS l, count_if(y = 1 AND p >= 0.3) AS h,
               avg(p) AS m FROM s)
SELECT round(100.0::double * f / n, 3) AS flagged_pct, round(100.0::double * h / f, 3) AS flagged_precision,
       round(100.0::double * h / l, 3) AS late_caught_pct, round(m, 3) AS mean_pred,
       round(100.0::double * l / n, 2) AS late_rate_pct,
       round((100.0::double * h / f) / (100.0::double * l / n), 1) AS lift FROM c""")

star_query("service_risk_bands", lambda star: _surrogate(star).groupBy(
    service.risk_band(F.col("late_probability")).alias("risk_band")).agg(F.count("*").alias("items")), SCORED + """
SELECT CASE WHEN p < 0.3 THEN 'Low' WHEN p <= 0.6 THEN 'Medium' ELSE 'High' END AS risk_band, count(*) AS items
FROM s GROUP BY 1""")


@lru_cache(maxsize=4)
def _trained_once(spark, folder):
    """Trained once per session and folder and saved: the queries below ask the same job for different results."""
    trained = risk.train(spark, commerce.star(spark, folder), scratch_path(spark, "risk"), FOREST)
    saved = scratch_path(spark, "risk-model")
    risk.save(trained, saved)
    return trained, saved


def _trained(spark, folder):
    return _trained_once(spark, folder)[0]


def _model_metrics(spark, folder):
    trained = _trained(spark, folder)
    return trained.metrics.withColumn("selected", F.col("model") == trained.name)


def _bands_after_reload(spark, folder):
    """Scores the test rows with the model as loaded from where it was saved."""
    trained, saved = _trained_once(spark, folder)
    name, model = risk.load(spark, saved)
    return risk.band_quality(risk.scores(model, trained.test)).withColumn("model", F.lit(name))


def _training_checks(spark, folder):
    """What must hold for any trained models: size of the forest, mean prediction of the logistic model (its intercept is
    free, so it equals the late rate of the rows it was fitted on), the choice, and the scores after a reload."""
    trained, saved = _trained_once(spark, folder)
    name, model = risk.load(spark, saved)
    keys = ["order_id", "order_item_id"]
    before = stored_rows(spark, risk.scores(trained.model, trained.test).withColumnRenamed("late_probability", "p"))
    after = stored_rows(spark, risk.scores(model, trained.test).select(*keys, "late_probability"))
    gap = before.join(after, keys).agg(F.max(F.abs(F.col("p") - F.col("late_probability"))).alias("v"))
    best = trained.metrics.agg(F.max("roc_auc").alias("top"), F.max(F.when(F.col("model") == name, F.col("roc_auc")))
                               .alias("own"))
    forest = trained.models["random_forest"].stages[-1]
    bounds = trained.metrics.agg(F.min("roc_auc").alias("lo"))
    rows = [
        ("forest has its trees", spark.range(1).select((F.lit(forest.getNumTrees) == 200).alias("ok"))),
        ("models are compared", trained.metrics.agg((F.count("*") == 2).alias("ok"))),
        ("selected model has the highest area", best.select((F.col("top") == F.col("own")).alias("ok"))),
        ("areas are above chance less noise", bounds.select((F.col("lo") > 0.4).alias("ok"))),
        ("scores after reload differ by nothing", gap.select((F.col("v") == 0).alias("ok"))),
    ]
    parts = [frame.select(F.lit(check).alias("check_name"), "ok") for check, frame in rows]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _logistic_mean(spark, folder):
    """Logistic model fitted on all training rows: mean prediction and late rate, equal up to the solver's tolerance."""
    rows = stored_rows(spark, _matrix(commerce.star(spark, folder)).select(*KEYS, *risk.FEATURES, risk.LABEL))
    train = risk.split_of_stored(rows, KEYS).filter("NOT is_test").drop("is_test")
    model = risk.fit_logistic(train)
    mean = risk.scores(model, train).agg(F.avg("late_probability").alias("p"), F.avg(risk.LABEL).alias("r"),
                                         F.count("*").alias("training_rows"))
    return mean.select("training_rows", F.round("r", 6).alias("late_rate"),
                       (F.abs(F.col("p") - F.col("r")) < 1e-3).alias("mean_prediction_agrees"))


def stored_rows(spark, frame):
    path = scratch_path(spark, "rows")
    with shuffles_removed(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def _preprocessed(spark, folder):
    """Imputed and scaled numbers and the position of each category, long: one row per item and feature."""
    rows = stored_rows(spark, _matrix(commerce.star(spark, folder)).select(*KEYS, *risk.FEATURES, risk.LABEL))
    ready = risk.fit_preprocessing(rows).transform(rows)
    numbers = vector_to_array("scaled")
    entries = [F.struct(F.lit(c).alias("feature"), F.round(F.get(numbers, F.lit(i)), 6).alias("value"))
               for i, c in enumerate(risk.NUMERIC)]
    entries += [F.struct(F.lit(c).alias("feature"), F.col(f"{c}_i").alias("value")) for c in risk.CATEGORICAL]
    sums = ready.select(F.inline(F.array(*entries))).groupBy("feature").agg(
        F.count("*").alias("rows"), F.round(F.sum("value"), 2).alias("total"),
        F.round(F.sum(F.col("value") * F.col("value")) / F.count("*"), 4).alias("mean_square"),
        F.round(F.min("value"), 5).alias("lowest"), F.round(F.max("value"), 5).alias("highest"))
    return sums.withColumn("total", F.abs("total"))


def _leakage(spark, folder):
    """Every feature of the model and every column known only later, with the verdict of the guard on each."""
    star = commerce.star(spark, folder)
    columns = star.fact_orders.columns
    names = spark.createDataFrame([(c,) for c in sorted({*risk.FEATURES, *columns})], "column_name string")

    def refused(column):
        try:
            quality.forbidden_features([column], risk.FORBIDDEN)
        except ValueError:
            return True
        return False

    verdicts = F.create_map(*[F.lit(x) for c in sorted({*risk.FEATURES, *columns}) for x in (c, refused(c))])
    return names.select("column_name", F.col("column_name").isin(risk.FEATURES).alias("is_feature"),
                        verdicts[F.col("column_name")].alias("refused"),
                        star.fact_orders.agg(F.count("*")).scalar().alias("items"))


def _order_requests(rows):
    """Every item of a training set as a scoring request; some are impossible (promise before purchase, free, negative size)."""
    broken = F.col("order_id") % 7 == 0
    return rows.select(
        *KEYS, "purchase_ts", F.when(broken, F.col("purchase_ts") - F.make_dt_interval(F.lit(1)))
        .otherwise(F.col("estimated_delivery_ts")).alias("estimated_delivery_ts"),
        "customer_state", "seller_state", "product_category_en",
        F.when(F.col("order_id") % 11 == 0, F.lit(0)).otherwise(F.col("price")).cast("decimal(12,2)").alias("price"),
        "freight_value", "product_weight_g",
        F.when(F.col("order_id") % 13 == 0, -F.col("length_cm")).otherwise(F.col("length_cm")).alias("length_cm"),
        "height_cm", "width_cm")


def _scored_requests(spark, folder):
    requests = _order_requests(stored_rows(spark, risk.training_set(commerce.star(spark, folder))))
    trained = _trained(spark, folder)
    scored, rejected = service.score_orders(requests, trained.model, trained.name)
    scored = stored_rows(spark, scored.select(*KEYS, "late_probability", "risk_band", "model"))
    return (scored.withColumn("reason", F.lit(None).cast("string"))
            .unionByName(rejected.select(*KEYS, F.col("reject_reason").alias("reason")), allowMissingColumns=True))


def _checked_requests(spark, folder):
    """What can be said of every request without the model's numbers: its reason, or a score in range and its band."""
    p, band = F.col("late_probability"), F.col("risk_band")
    agrees = F.when(p.isNull(), F.lit(None)).when(p < 0.2999, band == "Low").when((p > 0.3001) & (p < 0.5999), band == "Medium").when(
        p > 0.6001, band == "High").otherwise(band.isNotNull())
    return _scored_requests(spark, folder).select(*KEYS, "reason", p.between(0, 1).alias("in_range"),
                                                  agrees.alias("band_agrees"))


query("risk_model_metrics", _model_metrics)
query("risk_saved_model_bands", _bands_after_reload)
query("service_risk_scoring", _scored_requests)


def _rejected_requests(star):
    requests = _order_requests(risk.training_set(star))
    return requests.select(*KEYS, service.reject_reason(requests.columns).alias("reason")).filter("reason IS NOT NULL")


star_query("service_rejected_requests", _rejected_requests,
    TRAINING + """
SELECT order_id, order_item_id, CASE WHEN order_id % 7 = 0 THEN 'estimated_delivery_ts must be on or after purchase_ts'
       WHEN order_id % 11 = 0 THEN 'price must be positive' ELSE 'length_cm must not be negative' END AS reason
FROM t WHERE order_id % 7 = 0 OR order_id % 11 = 0 OR order_id % 13 = 0""")

query("risk_training_checks", _training_checks, """
SELECT unnest(['forest has its trees', 'models are compared', 'selected model has the highest area',
               'areas are above chance less noise', 'scores after reload differ by nothing']) AS check_name, true AS ok""")
query("risk_logistic_mean", _logistic_mean, STAR_SQL + SPLIT + """
SELECT count(*) AS training_rows, round(avg(is_late), 6) AS late_rate, true AS mean_prediction_agrees
FROM split WHERE NOT is_test""")
query("risk_preprocessing", _preprocessed, STAR_SQL + TRAINING + """
, raw AS (SELECT month(purchase_ts)::double AS purchase_month, hour(purchase_ts)::double AS purchase_hour,
                 (isodow(purchase_ts) - 1)::double AS purchase_dow, promise::double AS estimated_lead_days,
                 freight_value, price, product_weight_g, length_cm, height_cm, width_cm FROM t),
m AS (SELECT median(COLUMNS(*)) FROM raw),
long AS (UNPIVOT (SELECT r.* REPLACE (coalesce(r.product_weight_g, m.product_weight_g) AS product_weight_g)
                  FROM raw r, m) ON * INTO NAME feature VALUE value),
s AS (SELECT feature, avg(value) AS a, stddev_samp(value) AS d FROM long GROUP BY feature),
scaled AS (SELECT feature, round(if(d = 0, 0, (value - a) / d), 6) AS value FROM long JOIN s USING (feature)),
cat AS (UNPIVOT (SELECT customer_state, product_category_en, seller_state FROM t) ON * INTO NAME feature VALUE name),
place AS (SELECT feature, name, row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, name) - 1 AS value
          FROM cat GROUP BY feature, name),
every AS (SELECT * FROM scaled UNION ALL SELECT feature, value::double FROM cat JOIN place USING (feature, name))
SELECT feature, count(*) AS rows, abs(round(sum(value), 2)) AS total, round(sum(value * value) / count(*), 4)
         AS mean_square, round(min(value), 5) AS lowest, round(max(value), 5) AS highest
FROM every GROUP BY feature""")
query("risk_leakage_guard", _leakage, STAR_SQL + """
, late(c) AS (VALUES ('customer_delivery_ts'), ('delivery_days'), ('review_score'), ('is_delivered'), ('is_on_time'),
                     ('order_status'), ('approved_ts'), ('carrier_delivery_ts')),
model(c) AS (VALUES ('purchase_month'), ('purchase_hour'), ('purchase_dow'), ('estimated_lead_days'), ('freight_value'),
                    ('price'), ('product_weight_g'), ('length_cm'), ('height_cm'), ('width_cm'), ('customer_state'),
                    ('product_category_en'), ('seller_state')),
every AS (SELECT c FROM late UNION SELECT c FROM model UNION SELECT unnest(['order_id', 'order_item_id', 'customer_id',
            'product_id', 'seller_id', 'purchase_date_key', 'purchase_ts', 'estimated_delivery_ts']))
SELECT c AS column_name, c IN (FROM model) AS is_feature, c IN (FROM late) AS refused, (SELECT count(*) FROM fact) AS items
FROM every""")
query("service_scored_requests", _checked_requests, STAR_SQL + TRAINING + """
, r AS (SELECT order_id, order_item_id, CASE
          WHEN order_id % 7 = 0 THEN 'estimated_delivery_ts must be on or after purchase_ts'
          WHEN order_id % 11 = 0 THEN 'price must be positive'
          WHEN order_id % 13 = 0 THEN 'length_cm must not be negative' END AS reason FROM t)
SELECT *, if(reason IS NULL, true, NULL) AS in_range, if(reason IS NULL, true, NULL) AS band_agrees FROM r""")
