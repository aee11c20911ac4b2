import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from pathkin.operators import relational as rel
from small import rows


def _hot(spark, n=600):
    """A third of all rows share one key."""
    rng = random.Random(3)
    data = [("hot" if i % 3 == 0 else f"k{rng.randrange(20)}", str(i)) for i in range(n)]
    return spark.createDataFrame(data, "k string, v string")


def test_spread_join_equals_plain_join(spark):
    big = _hot(spark)
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("none", 4)], "k string, w int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = big.join(small, "k", how)
        spread = rel.spread_join(big, small, ["k"], ["v"], how, buckets=5)
        assert rows(spread.na.fill(0), *plain.columns) == rows(plain.na.fill(0), *plain.columns), how


def test_hot_join_equals_plain_join_and_spreads_the_hot_key(spark):
    big = _hot(spark, 3000).unionByName(spark.createDataFrame([(None, "x")], "k string, v string"))
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("none", 4), (None, 5)], "k string, w int")
    assert len(rel.hot_keys(big, ["k"], share=0.2)) == 1
    for share in (0.2, 0.001, 0.9):
        for how in ("inner", "left", "left_semi", "left_anti"):
            plain = big.join(small, "k", how)
            spread = rel.hot_join(big, small, ["k"], ["v"], how, buckets=5, share=share)
            assert rows(spread.na.fill(0).na.fill(""), *plain.columns) == rows(plain.na.fill(0).na.fill(""), *plain.columns)
    assert rel.hot_keys(big.limit(0), ["k"]) == []


def test_hot_join_deals_a_third_of_all_rows_evenly(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        big = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000 + 1).alias("k"), F.col("id").alias("v"))
        small = spark.range(5001).withColumnRenamed("id", "k")
        sizes = lambda df: sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        even, plain = sizes(rel.hot_join(big, small, ["k"], ["v"])), sizes(big.join(small, "k"))
        assert sum(even) == sum(plain) == 60_000
        assert even[-1] < 3 * even[len(even) // 2] and plain[-1] > 6 * plain[len(plain) // 2]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_numbered_rows_of_a_key_larger_than_any_partition(spark):
    big = _hot(spark, 3000).unionByName(spark.createDataFrame([(None, "a"), (None, "b"), ("k1", None)], "k string, v string"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = rel.numbered(big, ["k"], ["v"])
        hot = got.filter("k = 'hot'").groupBy(F.spark_partition_id()).count()
        assert hot.agg(F.max("count")).first()[0] < 0.7 * big.filter("k = 'hot'").count()
        window = Window.partitionBy("k").orderBy("v")
        want = big.withColumn("position", F.row_number().over(window))
        assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
        alone = rel.numbered(big.select("v"), [], ["v"]).orderBy("position").collect()
        assert [r.position for r in alone] == list(range(1, big.count() + 1))
        assert [r.v for r in alone] == sorted([r.v for r in big.collect()], key=lambda v: (v is not None, v))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_running_totals_equal_one_window(spark):
    rng = random.Random(5)
    data = [(i * 0.5, rng.randrange(9), rng.randrange(9)) for i in range(500)]
    df = spark.createDataFrame(data, "s double, a bigint, b bigint").repartition(7)
    got = rel.running_totals(df, F.col("s").desc(), {"a": "ra", "b": "rb"})
    window = Window.orderBy(F.col("s").desc())
    want = df.withColumn("ra", F.sum("a").over(window)).withColumn("rb", F.sum("b").over(window))
    assert rows(got, "s", "ra", "rb") == rows(want, "s", "ra", "rb")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_is_trimmed_before_the_shuffle(spark):
    best = rel.top_k(_hot(spark), ["k"], [F.col("v")], 2)
    plan = _plan(best)
    assert plan.count("WindowGroupLimit") == 2  # one before, one after the exchange
    assert best.filter(F.col("k") == "hot").count() == 2


def test_keep_last_and_marks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "k string, t int")
    assert rows(rel.keep_last(df, ["k"], [F.col("t").desc()]), "k", "t") == [("a", 2), ("b", 5)]
    only_a = df.filter(F.col("k") == "a")
    marked = rel.mark_members(df, only_a, ["k"], "f", 1, -1)
    assert rows(marked, "k", "t", "f") == [("a", 1, 1), ("a", 2, 1), ("b", 5, -1)]


def test_multiset_minus_cancels_one_copy(spark):
    left = spark.createDataFrame([("A",)] * 4 + [("B",)], "x string")
    right = spark.createDataFrame([("A",)], "x string")
    assert rows(rel.multiset_minus(left, right), "x", "n") == [("A", 3), ("B", 1)]


def test_outer_join_all(spark):
    frames = [
        spark.createDataFrame(data, f"k int, {name} int")
        for name, data in [("a", [(1, 1), (2, 2)]), ("b", [(2, 3)]), ("c", [(3, 4)])]
    ]
    joined = rel.outer_join_all(frames, ["k"]).na.fill(0)
    assert rows(joined, "k", "a", "b", "c") == [(1, 1, 0, 0), (2, 2, 3, 0), (3, 0, 0, 4)]


def test_fact_filter_and_columns_reach_the_scan(spark):
    from pathkin.plans.relational_queries import QUERIES

    plan = _plan(QUERIES["filter_eq"](spark, "/root/testdata/sf0.001"))
    assert "EqualTo(o_orderstatus,F)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in plan
