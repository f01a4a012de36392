import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orderlens.functions.percentiles import exact_percentile

VALUES = st.lists(st.floats(-50, 50).map(lambda x: round(x, 2)), min_size=1, max_size=30)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(groups=st.dictionaries(st.sampled_from(["a", "b", None]), VALUES, min_size=1),
       fraction=st.sampled_from([0.0, 0.2, 0.5, 0.9, 1.0]),
       buckets=st.sampled_from([1, 3, 4096]))
def test_equals_numpy(spark, groups, fraction, buckets):
    data = [(k, v) for k, vs in groups.items() for v in vs] + [(k, None) for k in groups]
    frame = spark.createDataFrame(data, "k string, v double")
    found = dict(exact_percentile(frame, ["k"], "v", fraction, buckets, "p").collect())
    assert found == pytest.approx({k: np.percentile(vs, fraction * 100) for k, vs in groups.items()})


def test_one_value_holding_most_rows(spark):
    frame = spark.range(100000).selectExpr("1 AS k", "CASE WHEN id % 3 = 0 THEN 7.0 ELSE CAST(id AS double) END AS v")
    values = [7.0 if i % 3 == 0 else float(i) for i in range(100000)]
    assert exact_percentile(frame, ["k"], "v", 0.5, name="p").first()["p"] == np.percentile(values, 50)


def test_no_values(spark):
    frame = spark.createDataFrame([("a", None)], "k string, v double")
    assert exact_percentile(frame, ["k"], "v", 0.5).count() == 0
