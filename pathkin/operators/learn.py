"""Model-based operators on Spark MLlib."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathkin.operators.evaluate import confusion_counts, weighted_metrics
from pathkin.operators.relational import numbered, top_k


def fold(key: list[str], folds: int = 100, seed: int = 11) -> Column:
    """A number below ``folds`` from the md5 of seed and key as text, which SQL can repeat."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint") % folds


def split(df: DataFrame, key: list[str], shares: list[float], seed: int = 11, folds: int = 100) -> list[DataFrame]:
    """Parts of about the given shares, by a hash of the key.

    The parts of a row never depend on the partitioning, and rows with the same key
    stay together. Shares must add up to 1.
    """
    ends = [round(sum(shares[: i + 1]) * folds) for i in range(len(shares))]
    if ends[-1] != folds:
        raise ValueError("shares must add up to 1")
    number = fold(key, folds, seed)
    return [df.filter((number >= low) & (number < high)) for low, high in zip([0, *ends], ends)]


def indexed(ids: DataFrame, column: str) -> DataFrame:
    """``column`` and ``index``: the distinct ids of any type, numbered from 0 by many tasks."""
    known = ids.select(column).filter(F.col(column).isNotNull()).distinct()
    return numbered(known, [], [column]).select(column, (F.col("position") - 1).cast("int").alias("index"))


def fit_als(
    ratings: DataFrame, user: str, item: str, rating: str, iterations: int = 5, reg: float = 0.01
) -> ALSModel:
    """Factor model over whole-number ids; users unseen in training are dropped."""
    return ALS(
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        maxIter=iterations,
        regParam=reg,
        coldStartStrategy="drop",
        seed=11,
    ).fit(ratings)


def als_rmse(model: ALSModel, test: DataFrame, rating: str) -> float:
    evaluator = RegressionEvaluator(metricName="rmse", labelCol=rating, predictionCol="prediction")
    return evaluator.evaluate(model.transform(test))


def top_items(model: ALSModel, users: DataFrame, k: int = 10) -> DataFrame:
    """user, rank, item, score: the best items of the given users (column ``user``)."""
    return _best(model.userFactors, model.itemFactors, users, "user", "item", k)


def top_users(model: ALSModel, items: DataFrame, k: int = 10) -> DataFrame:
    """item, rank, user, score: the best users of the given items (column ``item``)."""
    return _best(model.itemFactors, model.userFactors, items, "item", "user", k)


def _best(asked: DataFrame, offered: DataFrame, keys: DataFrame, key: str, other: str, k: int) -> DataFrame:
    """The ``k`` best by inner product, found through the lengths of the vectors.

    A first search among the longest offered vectors gives each asked one a score that
    the k-th best reaches at least. Of all others only those long enough to reach it,
    |a| * |b| >= score, are multiplied out. Offered vectors lie on slots that every
    asked vector visits; an equi-join on the slot takes the place of all pairs.
    """
    spark = asked.sparkSession
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    length = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    dot = F.aggregate(F.zip_with("a", "b", lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    wanted = keys.select(F.col(key).cast("int").alias("id")).distinct()
    mine = asked.join(wanted, "id").select(F.col("id").alias(key), F.col("features").alias("a"))
    theirs = offered.select(F.col("id").alias(other), F.col("features").alias("b"), length(F.col("features")).alias("reach"))
    order = [F.col("score").desc(), F.col(other)]

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        spread = left.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
        dealt = right.withColumn("slot", F.pmod(F.xxhash64(other), F.lit(slots)).cast("int"))
        return spread.join(dealt, "slot")

    # the longest vectors, a bounded number
    first = theirs.orderBy(F.desc("reach"), other).limit(16 * k)
    near = top_k(met(mine, first).select(key, other, dot.alias("score")), [key], order, k)
    least = near.groupBy(key).agg(F.when(F.count("*") == k, F.min("score")).alias("least"))
    bounded = mine.join(least, key).withColumn("own", length(F.col("a")))
    able = met(bounded, theirs).filter(F.col("least").isNull() | (F.col("own") * F.col("reach") * (1 + 1e-9) >= F.col("least")))
    best = top_k(able.select(key, other, dot.alias("score")), [key], order, k)
    return best.select(key, "rank", other, "score")


def fit_logistic(
    df: DataFrame, features: str = "features", label: str = "label", iterations: int = 100
) -> LogisticRegressionModel:
    """Logistic regression fitted by L-BFGS, for two or more classes."""
    return LogisticRegression(featuresCol=features, labelCol=label, maxIter=iterations).fit(df)


def scored(model: LogisticRegressionModel, df: DataFrame, label: str = "label") -> DataFrame:
    """label, prediction and the probability of class 1 as ``score``."""
    return model.transform(df).select(
        F.col(label).cast("double").alias("label"),
        "prediction",
        F.get(vector_to_array("probability"), 1).alias("score"),
    )


def model_accuracy(model: LogisticRegressionModel, df: DataFrame, label: str = "label"):
    """One row of accuracy and weighted metrics of a fitted model over a frame."""
    return weighted_metrics(confusion_counts(scored(model, df, label)))
