import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from pathkin.operators import evaluate as ev
from pathkin.operators import learn


def test_best_items_of_asked_users_are_those_of_all_pairs(spark):
    ratings = spark.range(3000).select(
        (F.col("id") % 60).cast("int").alias("u"),
        F.pmod(F.xxhash64("id"), F.lit(400)).cast("int").alias("i"),
        (F.col("id") % 5 + 1).cast("float").alias("r"),
    )
    model = learn.fit_als(ratings, "u", "i", "r")
    asked = spark.createDataFrame([(3,), (17,), (17,), (999,)], "user int")
    best = learn.top_items(model, asked, 3)
    got = sorted((r.user, r["rank"], r.item) for r in best.collect())
    a = {r.id: r.features for r in model.userFactors.collect()}
    b = {r.id: r.features for r in model.itemFactors.collect()}
    want = []
    for u in (3, 17):
        order = sorted(b, key=lambda i: (-sum(x * y for x, y in zip(a[u], b[i])), i))[:3]
        want += [(u, n, i) for n, i in enumerate(order, 1)]
    assert got == want
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    users = learn.top_users(model, spark.createDataFrame([(5,)], "item int"), 100).collect()
    assert sorted(r["rank"] for r in users) == list(range(1, 61))
    assert learn.als_rmse(model, ratings, "r") < 1.5


def test_any_ids_are_numbered_from_zero(spark):
    ids = spark.createDataFrame([("b7",), ("a",), (None,), ("b7",), ("é",)], "s string")
    assert sorted(tuple(r) for r in learn.indexed(ids, "s").collect()) == [("a", 0), ("b7", 1), ("é", 2)]


def test_parts_of_a_split_hang_on_the_key_alone(spark):
    df = spark.range(2000).withColumn("x", F.col("id") % 7)
    parts = learn.split(df, ["id"], [0.6, 0.3, 0.1])
    sets = [{r.id for r in p.collect()} for p in parts]
    assert sum(map(len, sets)) == len(set.union(*sets)) == 2000
    assert [round(len(s) / 2000, 1) for s in sets] == [0.6, 0.3, 0.1]
    again = learn.split(df.repartition(9, "x"), ["id"], [0.6, 0.3, 0.1])
    assert [{r.id for r in p.collect()} for p in again] == sets
    with pytest.raises(ValueError):
        learn.split(df, ["id"], [0.5, 0.4])


def test_logistic_separates_two_classes(spark):
    rows = spark.range(40).select(
        (F.col("id") % 2).cast("double").alias("label"),
        array_to_vector(F.array((F.col("id") % 2).cast("double"), F.lit(1.0))).alias("features"),
    )
    model = learn.fit_logistic(rows)
    assert learn.model_accuracy(model, rows).first().accuracy == 1.0
    areas = ev.curve_areas(ev.threshold_curve(learn.scored(model, rows), "score", "label")).first()
    assert (areas.auroc, areas.aupr) == (pytest.approx(1.0), pytest.approx(1.0))


def test_other_predictions_have_a_column_of_their_own(spark):
    df = spark.createDataFrame([(0, 0), (0, 5), (1, None), (1, 1)], "label int, prediction int")
    got = {r.label: r.asDict() for r in ev.confusion_matrix(ev.confusion_counts(df), [0, 1]).collect()}
    assert got[0] == {"label": 0, "pred_0": 1, "pred_1": 0, "pred_other": 1}
    assert got[1] == {"label": 1, "pred_0": 0, "pred_1": 1, "pred_other": 1}


def test_perfect_and_empty_labels(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (2, 1)], "label int, prediction int")
    got = {r.label: r for r in ev.label_metrics(ev.confusion_counts(df)).collect()}
    assert got[2].recall == 0.0 and got[2].precision == 0.0  # never predicted
    assert got[1].recall == 0.0 and got[1].fpr == pytest.approx(2 / 3)  # never true
    assert got[0].precision == 1.0 and got[0].recall == 0.5
