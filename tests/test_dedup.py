from datetime import datetime

from conftest import plan_of, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwork.operators.dedup import latest_per_key
from tillwork.plans.clean import latest_rows

DAY = [None] + [datetime(2025, 1, d) for d in range(1, 5)]
SCHEMA = "customer_id string, ingesttime timestamp, name string, file_name string"


def test_latest_row_per_normalised_key(spark):
    data = [("c1 ", DAY[1], "old", "f1"), ("C1", DAY[2], "new", "f2"),
            ("C2", DAY[1], "a", "f1"), ("C2", DAY[1], "b", "f1"),
            ("C3", None, "no time", "f1"), ("C3", DAY[1], "timed", "f1"),
            (None, DAY[1], "x", "f1"), (None, DAY[2], "y", "f1")]
    df = latest_rows(spark.createDataFrame(data, SCHEMA), "customer_id", ["ingesttime"])
    assert rows(df, "customer_id", "name") == [("C1", "new"), ("C2", "b"), ("C3", "timed"), (None, "y")]


entry = st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from(DAY), st.sampled_from(["x", "y", None]),
                  st.sampled_from(["f1", "f2"]))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(entry, min_size=1, max_size=30))
def test_against_brute_force(spark, data):
    def rank(row):
        return tuple((value is not None, value if value is not None else "") for value in
                     ((row[1].isoformat() if row[1] else None), row[3], row[2]))

    best = {}
    for row in data:
        if row[0] not in best or rank(row) > rank(best[row[0]]):
            best[row[0]] = row
    df = latest_per_key(spark.createDataFrame(data, SCHEMA), ["customer_id"], ["ingesttime"])
    assert rows(df) == sorted(best.values(), key=repr)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A key with half of all rows sends one row per map task."""
    df = spark.range(0, 40000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("t"))
    latest = latest_per_key(df, ["k"], ["t"])
    plan = plan_of(latest)
    below_exchange = plan[plan.index("Exchange hashpartitioning"):]
    assert plan.count("WindowGroupLimit") == 2 and "WindowGroupLimit" in below_exchange
    assert latest.count() == 20001
    assert latest.filter("k = 'hot'").first()["t"] == 39998
