from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from placelake.operators.aggregates import count_per_key, fanout_avg, fanout_count, regression_metrics, summarize

FACTS = "k string, d1 string, d2 int, price double"
OTHERS = "k string, c1 int, c2 string, m double"


def sorted_rows(df, digits=6):
    return sorted((tuple(round(v, digits) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_count_per_key_drops_null_keys_and_carries_the_smallest(spark):
    df = spark.createDataFrame([("a", "y", 1), ("a", "x", 2), ("a", None, 2), ("b", None, 3), (None, "z", 4)], "k string, c string, n int")
    got = count_per_key(df, "k", ["c", "n"])
    assert got.columns == ["k", "c", "n", "count_list"]
    assert sorted_rows(got) == [("a", "x", 1, 3), ("b", None, 3, 1)]
    assert dict(got.dtypes)["count_list"] == "bigint"
    empty = count_per_key(df.limit(0), "k", ["c"])
    assert empty.count() == 0 and empty.columns == ["k", "c", "count_list"]


def test_count_per_key_over_counted_rows(spark):
    df = spark.createDataFrame([("a", "x", 2), ("a", "y", 3)], "k string, c string, w long")
    assert sorted_rows(count_per_key(df, "k", ["c"], weight="w")) == [("a", "x", 5)]


keys = st.sampled_from(["a", "b", "c", None])
fact = st.tuples(keys, st.sampled_from(["x", "y", None]), st.sampled_from([1, None]),
                 st.one_of(st.none(), st.integers(-50, 50).map(float)))
other = st.tuples(keys, st.sampled_from([1, 2, None]), st.sampled_from(["p", None]),
                  st.one_of(st.none(), st.integers(-50, 50).map(float)))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(fact, max_size=12), st.lists(other, max_size=12))
def test_aggregating_first_equals_joining_first(spark, facts, others):
    left, right = spark.createDataFrame(facts, FACTS), spark.createDataFrame(others, OTHERS)
    joined = left.join(right, "k")

    counts = joined.groupBy("k", "c1", "c2", "d1", "d2").agg(F.count("*").alias("n")).select("k", "c1", "c2", "n", "d1", "d2")
    assert sorted_rows(fanout_count(left, right, "k", ["d1", "d2"], ["c1", "c2"], "n")) == sorted_rows(counts)

    averages = joined.groupBy("k", "d1", "d2").agg(F.avg("m").alias("am"), F.avg("price").alias("ap")).select("am", "ap", "k", "d1", "d2")
    assert sorted_rows(fanout_avg(left, right, "k", ["d1", "d2"], "price", "m", "ap", "am")) == sorted_rows(averages)

    per_key = joined.select("k", "d1", "d2").distinct().join(right.groupBy("k", "c1", "c2").count(), "k")
    distinct = per_key.select("k", "c1", "c2", "count", "d1", "d2")
    assert sorted_rows(fanout_count(left, right, "k", ["d1", "d2"], ["c1", "c2"], "n", "distinct_facts")) == sorted_rows(distinct)


def test_counted_facts_stand_for_their_rows(spark):
    left = spark.createDataFrame([("a", "x", 1, 1.0)] * 3 + [("b", None, None, 2.0)], FACTS)
    right = spark.createDataFrame([("a", 1, "p", 0.0)] * 2, OTHERS)
    counted = left.groupBy("k", "d1", "d2").agg(F.count("*").alias("w"))
    plain = fanout_count(left, right, "k", ["d1", "d2"], ["c1"], "n")
    assert sorted_rows(fanout_count(counted, right, "k", ["d1", "d2"], ["c1"], "n", weight="w")) == sorted_rows(plain) == [("a", 1, 6, "x", 1)]


def test_a_fan_out_never_joins_rows(spark):
    left = spark.createDataFrame([("a", "x", 1, 1.0)], FACTS)
    right = spark.createDataFrame([("a", 1, "p", 0.0)], OTHERS)
    plan = fanout_count(left, right, "k", ["d1"], ["c1"], "n")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")


def test_summarize_skips_nothing_but_vectors(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "p double")
    assert {r.summary: r.p for r in summarize(df, ["p"]).collect()}["count"] == "2"


def test_regression_metrics(spark):
    df = spark.createDataFrame([("a", 1.0, 1.5), ("a", 2.0, 1.5), ("b", 2.0, 2.0), ("b", None, 1.0), ("b", 3.0, None)],
                               "g string, price double, prediction double")
    rows = {r.g: r for r in regression_metrics(df, by=["g"]).collect()}
    assert (rows["a"].n, rows["a"].rmse, rows["a"].r2, rows["a"].mae) == (2, 0.5, 0.0, 0.5)
    assert (rows["b"].n, rows["b"].rmse, rows["b"].r2) == (1, 0.0, None)
    overall = regression_metrics(df).first()
    assert overall.n == 3
    assert regression_metrics(df.limit(0)).first().n == 0
