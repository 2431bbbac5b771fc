"""Hot groups take another path and must give the same rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from wrenchlake.operators import skew
from wrenchlake.operators.cost import above_group_average
from wrenchlake.operators.quality import duplicate_rows


def visits(spark, n=600):
    rng = random.Random(7)
    data = []
    for i in range(n):
        # A third of all rows belong to one vehicle and part, many on the same day; some lack a date.
        key = ("HOT", "P") if i % 3 == 0 else (f"V{rng.randrange(60)}", f"P{rng.randrange(3)}")
        day = None if i % 50 == 7 else dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(12))
        data.append((*key, day, rng.choice([None, 10, 20, 30]), f"J{i}"))
    return spark.createDataFrame(data, "v string, p string, day date, km int, jc string").repartition(5)


def lagged(df, hot_rows):
    return skew.lag_in_group(df, ["v", "p"], "day", ["km", "jc"], {"pday": "day", "pkm": "km", "pjc": "jc"}, hot_rows)


def test_lag_over_hot_groups_equals_plain_window(spark, rows):
    df = visits(spark)
    plain = rows(lagged(df, 10_000), "v", "p", "day", "km", "jc", "pday", "pkm", "pjc")
    assert len(plain) == 600
    for hot_rows in (100, 3, 0):
        assert rows(lagged(df, hot_rows), "v", "p", "day", "km", "jc", "pday", "pkm", "pjc") == plain


def test_lag_with_null_keys_in_a_hot_group(spark, rows):
    df = visits(spark).withColumn("v", F.nullif("v", F.lit("HOT")))
    assert rows(lagged(df, 100)) == rows(lagged(df, 10_000))


def test_duplicate_rows_of_hot_keys(spark, rows):
    df = visits(spark).select("v", "p", "day").withColumn("p", F.lit("same"))
    plain = rows(duplicate_rows(df, ["v"], hot_rows=10_000))
    assert len(plain) == 600 - df.select("v").distinct().count()
    assert rows(duplicate_rows(df, ["v"], hot_rows=50)) == plain
    assert rows(duplicate_rows(df, ["v"], hot_rows=0)) == plain


def test_keep_first_limits_before_the_shuffle(spark):
    df = skew.keep_first(visits(spark), ["v", "p"], [F.col("day"), F.col("jc")])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert df.count() == df.select("v", "p").distinct().count()


def test_bounded_broadcasts_only_within_its_limit(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(1000).withColumn("k", F.col("id") % 10)
        means = facts.groupBy("k").agg(F.avg("id").alias("m"))

        def plan(small, limit):
            return facts.join(skew.bounded(small, limit), "k")._jdf.queryExecution().executedPlan().toString()

        assert "BroadcastHashJoin" in plan(means, 1000)
        assert "BroadcastHashJoin" not in plan(means, 50) and "SortMergeJoin" in plan(means, 50)
        wide = means.withColumn("text", F.repeat(F.lit("x"), 100_000))  # few rows that are very wide
        assert "SortMergeJoin" in plan(wide, 900_000) and "BroadcastHashJoin" in plan(wide, 1_100_000)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_above_group_average(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("a", None), (None, 9.0)], "g string, v double")
    assert rows(above_group_average(df, "g", "v")) == [("a", 3.0, 2.0)]


def exchanges(df):
    """Shuffles that the query made; a reused one counts once."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return sum("Exchange hashpartitioning" in line and "Reused" not in line for line in final.split("\n"))


def test_one_pass_for_lag_and_duplicates(spark):
    df = visits(spark)
    assert exchanges(lagged(df, 10_000)) == 1
    # Rows of repeated keys meet their list, are gathered, ranked in parts, and the leaders ranked again.
    assert exchanges(duplicate_rows(df.select("v", "p", "day"), ["v"])) <= 4


def test_hot_key_from_a_single_partition(spark, rows):
    df = visits(spark).select("v", "p", "day").withColumn("p", F.lit("same")).coalesce(1)
    plain = rows(duplicate_rows(df, ["v"], hot_rows=10_000))
    assert rows(duplicate_rows(df, ["v"], hot_rows=20)) == plain
    same = spark.range(500).select(F.lit("k").alias("k"), F.lit(1).alias("x")).coalesce(1)
    assert duplicate_rows(same, ["k"], hot_rows=10).count() == 499


def test_lag_of_ties_does_not_hang_on_the_path(spark, rows):
    df = visits(spark).withColumn("other", F.col("jc")).drop("jc").withColumn("jc", F.lit("same"))
    lag = {"po": "other"}
    plain = rows(skew.lag_in_group(df, ["v", "p"], "day", ["jc"], lag, 10_000))
    assert rows(skew.lag_in_group(df, ["v", "p"], "day", ["jc"], lag, 20)) == plain
