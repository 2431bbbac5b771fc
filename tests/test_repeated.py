"""Only rows whose key may repeat go on, and the checks built on them stay exact."""

import pytest
from pyspark.sql import functions as F

from wrenchlake.operators import quality
from wrenchlake.operators.repeated import may_repeat


def keyed(spark, n=60_000, partitions=6):
    """Keys of two columns, nearly all different: a few twice, one hot, some NULL; some within a task, some across."""
    far = F.when(F.col("id") >= n - 40, F.col("id") - (n - 40)).otherwise(F.col("id"))
    near = F.when(F.col("id") % 3000 == 1, F.col("id") - 1).otherwise(far)
    hot = F.when(F.col("id").between(20_000, 20_500), F.lit(7_000_000)).otherwise(near)
    key = F.when(F.col("id").between(30_000, 30_004), F.lit(None)).otherwise(hot)
    frame = spark.range(0, n, 1, partitions)
    return frame.select(key.alias("a"), F.concat(F.lit("k"), key % 11).alias("b"), (F.col("id") % 5).alias("x y"))


def repeated_rows(df, keys):
    counts = df.groupBy(*keys).count().filter("count > 1").agg(F.sum("count")).first()[0]
    return counts or 0


@pytest.mark.parametrize("places", [1 << 15, 1 << 16, 1 << 28])
def test_every_row_of_a_repeated_key_goes_on(spark, rows, places):
    df = keyed(spark, 30_000) if places < 1 << 16 else keyed(spark)
    some = may_repeat(df, ["a", "b"], least_rows=0, most_places=places)
    assert some.columns == df.columns
    plain = df.groupBy("a", "b").count().filter("count > 1")
    assert rows(some.groupBy("a", "b").count().filter("count > 1")) == rows(plain)


def test_few_others_go_on(spark):
    df = keyed(spark)
    repeated = repeated_rows(df, ["a", "b"])
    passed = may_repeat(df, ["a", "b"], least_rows=0).count()
    assert 500 < repeated <= passed <= repeated + 60_000 / 16 * 1.2


def test_the_result_does_not_hang_on_the_partitions(spark, rows):
    df = keyed(spark, 20_000)
    found = [rows(may_repeat(df.repartition(k), ["a"], least_rows=0)) for k in (1, 7)]
    assert found[0] == found[1] and found[0]


def test_tables_that_come_back_whole(spark):
    df = keyed(spark, 30_000)
    assert may_repeat(df, ["a"]) is df  # small
    assert may_repeat(df, ["a"], least_rows=0, most_places=1 << 14) is df  # more rows than places
    nested = df.withColumn("n", F.array("a"))
    assert may_repeat(nested, ["n"], least_rows=0) is nested
    collated = df.withColumn("b", F.collate("b", "UTF8_LCASE"))
    assert may_repeat(collated, ["b"], least_rows=0) is collated
    none = df.limit(0)
    assert may_repeat(none, ["a"], least_rows=0).count() == 0


def test_checks_are_the_same_on_either_way(spark, rows):
    df = keyed(spark)
    signed = spark.sql("SELECT * FROM VALUES (0.0D), (-0.0D), (double('NaN')), (double('NaN')), (1.5D), (NULL) t(a)")

    def results(least):
        return [
            rows(quality.duplicate_keys(df, ["a", "b"], least_rows=least)),
            rows(quality.duplicate_rows(df, ["a", "b"], least_rows=least)),
            rows(quality.duplicate_rows(df, ["a", "b"], hot_rows=50, least_rows=least)),
            rows(quality.is_unique(df, "a", least_rows=least)),
            rows(quality.is_unique(df.filter("a IS NOT NULL").dropDuplicates(["a"]), "a", least_rows=least)),
            [len(rows(quality.duplicate_keys(signed, ["a"], least_rows=least)))],
        ]

    plain = results(1_000_000)
    assert results(0) == plain
    assert plain[-1] == [2] and plain[3][0][3] is False and plain[4][0][3] is True


def test_a_key_may_be_named_like_an_inner_column(spark, rows):
    df = keyed(spark, 20_000).withColumnsRenamed({"a": "page", "x y": "place"})
    some = may_repeat(df, ["page"], least_rows=0)
    assert some.columns == ["page", "b", "place"]
    assert rows(some.groupBy("page").count().filter("count > 1")) == rows(df.groupBy("page").count().filter("count > 1"))


def test_only_what_may_repeat_is_shuffled(spark):
    df = may_repeat(keyed(spark), ["a", "b"], least_rows=0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "ArrowEvalPython" not in plan
