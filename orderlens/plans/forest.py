"""The forest as a table of nodes: grown, scored, compared, saved and served, with every number checked by a second engine.

The SQL grows the same trees level by level from the same draws and walks the table of nodes by a recursive join.
"""

from pyspark.sql import functions as F

from orderlens.operators import forest, risk, service
from orderlens.plans.registry import STAR_SQL, query
from orderlens.plans.risk import KEYS, SPLIT, _order_requests, stored_rows
from orderlens.session import scratch_path
from orderlens.sources import commerce

SHAPE, SEED = forest.Shape(), 42
FEATURES = len(risk.FEATURES)


def _training_rows(spark, folder):
    """The items with their outcome, joined once; the split, the trees and the requests read them from where they are stored."""
    return stored_rows(spark, risk.training_set(commerce.star(spark, folder)))


def _grown(rows):
    """The forest and the test rows."""
    matrix = risk.with_label(risk.with_features(rows)).select(*KEYS, *risk.FEATURES, risk.LABEL)
    split = risk.split_of_stored(matrix, KEYS)
    return forest.fit(split.filter("NOT is_test"), SHAPE, SEED), split.filter("is_test")


def _purity(late, n):
    return f"(({late})::double * ({late})::double + ({n} - ({late}))::double * ({n} - ({late}))::double) / ({n})::double"


def _level(k):
    """Counts, tried features, cells, running sums and best split of level k, and the rows one level down."""
    left, right = _purity("ll", "nl"), _purity("late - ll", "(n - nl)")
    return f"""
a{k} AS MATERIALIZED (SELECT tree, node, sum(w)::bigint AS n, sum(w * y)::bigint AS late FROM m{k} GROUP BY tree, node),
q{k} AS (SELECT tree, node, unnest(list_transform(list_sort(list_transform(range(0, {FEATURES}), lambda i:
           {{'u': md5(concat_ws('|', tree, node, i, '{SEED}')), 'f': i}}))[1:{SHAPE.tried}], lambda s: s.f))::int AS f FROM a{k}),
h{k} AS (SELECT tree, node, f, bins[f + 1] AS bin, sum(w) AS w, sum(w * y) AS l
         FROM m{k} JOIN q{k} USING (tree, node) GROUP BY ALL),
s{k} AS (SELECT tree, node, f, bin, (sum(w) OVER up)::bigint AS nl, (sum(l) OVER up)::bigint AS ll FROM h{k}
         WINDOW up AS (PARTITION BY tree, node, f ORDER BY bin)),
b{k} AS MATERIALIZED (SELECT *, {left} + {right} AS g FROM s{k} JOIN a{k} USING (tree, node)
         WHERE nl >= {SHAPE.min_leaf} AND n - nl >= {SHAPE.min_leaf} AND {left} + {right} > {_purity("late", "n")}
         QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY g DESC, f, bin) = 1),
m{k + 1} AS MATERIALIZED (SELECT tree, 2 * node + (bins[f + 1] > bin)::int AS node, w, y, bins
                          FROM m{k} JOIN b{k} USING (tree, node))"""


BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
GROWN = STAR_SQL.replace("WITH", "WITH RECURSIVE", 1) + SPLIT + f"""
, f AS (SELECT order_id, order_item_id, s.is_late, is_test,
               [month(purchase_ts)::double, hour(purchase_ts)::double, (isodow(purchase_ts) - 1)::double,
                round_even(date_diff('microsecond', purchase_ts, estimated_delivery_ts) / 86400000000.0::double, 1),
                freight_value, price, product_weight_g, length_cm, height_cm, width_cm] AS v,
               [customer_state, product_category_en, seller_state] AS c
        FROM t JOIN split s USING (order_id, order_item_id)),
lohi AS (SELECT i, min(x) AS lo, max(x) AS hi FROM (SELECT unnest(v) AS x, generate_subscripts(v, 1) AS i FROM f
         WHERE NOT is_test) GROUP BY i),
ends AS (SELECT list(lo ORDER BY i) AS lo, list(hi ORDER BY i) AS hi FROM lohi),
celled AS (SELECT f.*, list_transform(v, lambda x, i: CASE WHEN x IS NULL THEN -1 WHEN hi[i] <= lo[i] THEN 0
             ELSE least(greatest(floor((x - lo[i]) * {forest.CELLS}::double / (hi[i] - lo[i])), 0), {forest.CELLS - 1}) END::int)
             AS cell FROM f, ends),
cells AS (SELECT i, x AS cell, count(*) AS n FROM (SELECT unnest(cell) AS x, generate_subscripts(cell, 1) AS i FROM celled
          WHERE NOT is_test) GROUP BY ALL),
shares AS (SELECT i, cell, coalesce(sum(n) OVER (PARTITION BY i ORDER BY cell {BEFORE}), 0)::bigint * {SHAPE.bins}
                  // (sum(n) OVER (PARTITION BY i))::bigint AS bin FROM cells),
begins AS (SELECT i, list(cell ORDER BY cell) AS cs FROM (SELECT i, bin, min(cell) AS cell FROM shares GROUP BY i, bin)
           GROUP BY i),
names AS (SELECT i, value, count(*) AS n, sum(is_late) AS late
          FROM (SELECT is_late, unnest(c) AS value, generate_subscripts(c, 1) AS i FROM f WHERE NOT is_test) GROUP BY i, value),
named AS (SELECT i, value, (coalesce(sum(n) OVER (PARTITION BY i ORDER BY late::double / n::double, value {BEFORE}), 0)::bigint
                  * {SHAPE.bins} // (sum(n) OVER (PARTITION BY i))::bigint)::int AS bin FROM names),
known AS (SELECT list(m ORDER BY i) AS ms FROM (SELECT i, map(list(value), list(bin)) AS m FROM named GROUP BY i)),
x AS MATERIALIZED (SELECT order_id, order_item_id, is_late, is_test, list_concat(
       list_transform(cell, lambda q, i: (len(list_filter(b[i], lambda s: s <= q)) - 1)::int),
       [coalesce(ms[1][c[1]], -1), coalesce(ms[2][c[2]], -1), coalesce(ms[3][c[3]], -1)]) AS bins
     FROM celled, known, (SELECT list(cs ORDER BY i) AS b FROM begins)),
drawn AS (SELECT *, ('0x' || substr(md5(concat_ws('|', order_id, order_item_id, tree, '{SEED}')), 1, 13))::bigint AS u
          FROM x, (SELECT unnest(range(1, {SHAPE.trees + 1}))::int AS tree) WHERE NOT is_test),
m0 AS MATERIALIZED (SELECT * FROM (SELECT tree, 1 AS node, {' + '.join(f'(u >= {w})::bigint' for w in forest.WEIGHTS)} AS w,
                                          is_late AS y, bins FROM drawn) WHERE w > 0),""" \
    + ",".join(_level(k) for k in range(SHAPE.depth)) + f""",
nodes AS MATERIALIZED ({" UNION ALL ".join(
        f"SELECT tree, node, a.n, a.late, f AS feature, bin FROM a{k} a LEFT JOIN b{k} USING (tree, node)"
        for k in range(SHAPE.depth))}
  UNION ALL SELECT tree, node, sum(w)::bigint, sum(w * y)::bigint, NULL, NULL FROM m{SHAPE.depth} GROUP BY tree, node),
walk AS (SELECT order_id, order_item_id, is_late, is_test, bins, tree, 1 AS node
         FROM x, (SELECT unnest(range(1, {SHAPE.trees + 1}))::int AS tree)
         UNION ALL SELECT order_id, order_item_id, is_late, is_test, bins, tree, 2 * node + (bins[feature + 1] > bin)::int
         FROM walk JOIN nodes USING (tree, node) WHERE feature IS NOT NULL),
leaf AS MATERIALIZED (SELECT order_id, order_item_id, is_late, is_test, tree, late * {forest.UNIT} // n AS s
                      FROM walk JOIN nodes USING (tree, node) WHERE feature IS NULL),
scored AS MATERIALIZED (
  SELECT 'forest' AS model, order_id, order_item_id, is_late AS y, is_test, sum(s)::bigint AS s,
         sum(s)::double / ({SHAPE.trees} * {forest.UNIT})::double AS p FROM leaf GROUP BY ALL
  UNION ALL SELECT 'single_tree', order_id, order_item_id, is_late, is_test, s, s::double / {forest.UNIT}::double
  FROM leaf WHERE tree = 1)
"""
METRICS = f"""
, c AS (SELECT model, count(*) AS n, count_if(y = 1 AND p > 0.5) AS tp, count_if(y = 0 AND p > 0.5) AS fp,
               count_if(y = 1 AND p <= 0.5) AS fn FROM scored WHERE is_test GROUP BY model),
per AS (SELECT model, p, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM scored WHERE is_test GROUP BY model, p),
below AS (SELECT model, pos, neg, sum(neg) OVER (PARTITION BY model ORDER BY p) - neg AS under FROM per),
area AS (SELECT model, round(sum(pos * (under + neg / 2.0::double))::double / (sum(pos) * sum(neg))::double, 4) AS roc_auc
         FROM below GROUP BY model),
metrics AS (SELECT model, round((n - fp - fn)::double / n, 4) AS accuracy,
                   coalesce(round(tp::double / nullif(tp + fp, 0), 4), 0) AS precision,
                   coalesce(round(tp::double / nullif(tp + fn, 0), 4), 0) AS recall, roc_auc FROM c JOIN area USING (model)),
best AS (SELECT model FROM metrics ORDER BY roc_auc DESC, model LIMIT 1)
"""


def _nodes(spark, folder):
    names = F.array(*[F.lit(c) for c in risk.FEATURES])
    return _grown(_training_rows(spark, folder))[0].nodes.withColumn("feature", F.get(names, F.col("feature")))


def _candidates(grown, test):
    """The forest and its first tree alone, each with its scores of the test rows."""
    alone = forest.Forest(grown.nodes.filter("tree = 1"), grown.numbers, grown.categories, grown.depth)
    scored = {}
    for name, model in (("forest", grown), ("single_tree", alone)):
        path = scratch_path(test.sparkSession, "forest-scores")
        forest.score(test, model, *KEYS, risk.LABEL).write.parquet(path)
        scored[name] = model, test.sparkSession.read.parquet(path)
    return scored


def _compared(scored):
    parts = [risk.evaluate(name, rows) for name, (_, rows) in scored.items()]
    return parts[0].unionByName(parts[1])


def _metrics(spark, folder):
    metrics = _compared(_candidates(*_grown(_training_rows(spark, folder))))
    best = risk.best_model(metrics).select("model").scalar()
    return metrics.withColumn("selected", F.col("model") == best)


def _bands(spark, folder):
    """Band figures of the selected candidate as it is after saving and loading."""
    grown, test = _grown(_training_rows(spark, folder))
    scored = _candidates(grown, test)
    name = risk.best_model(_compared(scored)).first()["model"]  # one row
    saved = scratch_path(spark, "forest-model")
    forest.save(scored[name][0], saved)
    again = stored_rows(spark, forest.score(test, forest.load(spark, saved), *KEYS, risk.LABEL))
    return risk.band_quality(again).withColumn("model", F.lit(name))


def _served(spark, folder):
    rows = _training_rows(spark, folder)
    scored, rejected = service.score_by_forest(_order_requests(rows), _grown(rows)[0], "forest")
    scored = stored_rows(spark, scored.select(*KEYS, "late_probability", "risk_band", "model"))
    return (scored.withColumn("reason", F.lit(None).cast("string"))
            .unionByName(rejected.select(*KEYS, F.col("reject_reason").alias("reason")), allowMissingColumns=True))


query("risk_forest_nodes", _nodes, GROWN + f"""
SELECT tree, node, n, late, [{', '.join(f"'{c}'" for c in risk.FEATURES)}][feature + 1] AS feature, bin FROM nodes""")
query("risk_forest_metrics", _metrics, GROWN + METRICS + """
SELECT metrics.*, model = (SELECT model FROM best) AS selected FROM metrics""")
query("risk_forest_bands", _bands, GROWN + METRICS + """
, flags AS (SELECT count(*) AS n, count_if(p >= 0.3) AS f, count_if(y = 1) AS l, count_if(y = 1 AND p >= 0.3) AS h, avg(p) AS m
        FROM scored WHERE is_test AND model = (SELECT model FROM best)),
r AS (SELECT *, coalesce(100.0::double * h / nullif(f, 0), 0) AS pr FROM flags)
SELECT round(100.0::double * f / n, 3) AS flagged_pct, round(pr, 3) AS flagged_precision,
       round(100.0::double * h / l, 3) AS late_caught_pct, round(m, 3) AS mean_pred,
       round(100.0::double * l / n, 2) AS late_rate_pct, round(pr / (100.0::double * l / n), 1) AS lift,
       (SELECT model FROM best) AS model FROM r""")
query("service_forest_scoring", _served, GROWN + f"""
, r AS (SELECT order_id, order_item_id, s, p, CASE
          WHEN order_id % 7 = 0 THEN 'estimated_delivery_ts must be on or after purchase_ts'
          WHEN order_id % 11 = 0 THEN 'price must be positive'
          WHEN order_id % 13 = 0 THEN 'length_cm must not be negative' END AS reason FROM scored WHERE model = 'forest')
SELECT order_id, order_item_id, reason,
       if(reason IS NULL, ((s * 20000 + {SHAPE.trees * forest.UNIT}) // {2 * SHAPE.trees * forest.UNIT})::double / 10000, NULL)
         AS late_probability,
       if(reason IS NULL, CASE WHEN p < 0.3 THEN 'Low' WHEN p <= 0.6 THEN 'Medium' ELSE 'High' END, NULL) AS risk_band,
       if(reason IS NULL, 'forest', NULL) AS model FROM r""")
