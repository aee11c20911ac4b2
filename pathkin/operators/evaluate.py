"""Ground truth, hit metrics and classification metrics as grouped frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathkin.domain import Domain
from pathkin.functions.scalars import COMPLETED, zero_safe_div
from pathkin.operators.facts import Facts, facts_of
from pathkin.operators.features import members
from pathkin.operators.relational import running_totals, top_k
from pathkin.params import Params


def popular_courses(domain: Domain | Facts, params: Params = Params()) -> DataFrame:
    """dept, item, n, rank: the most completed courses of each department."""
    counts = (
        facts_of(domain).taken
        .groupBy("dept", F.col("course").alias("item"))
        .agg(F.count("*").alias("n"))
    )
    return top_k(counts, ["dept"], [F.col("n").desc(), F.col("item")], params.truth_items)


def popular_programmes(domain: Domain | Facts, params: Params = Params()) -> DataFrame:
    """dept, item, n, rank: the most completed programmes of each department."""
    enrolled = (
        domain.enrolments.filter(F.col("state") == COMPLETED)
        .select("std_no", "enrol_id", "programme")
        .distinct()
        .groupBy("std_no", F.col("programme").alias("item"))
        .agg(F.count("*").alias("n"))
    )
    counts = enrolled.join(members(domain), "std_no").groupBy("dept", "item").agg(
        F.sum("n").alias("n")
    )
    return top_k(counts, ["dept"], [F.col("n").desc(), F.col("item")], params.truth_items)


def truth_for(domain: Domain | Facts, users: DataFrame, params: Params = Params()) -> DataFrame:
    """query_std, item: the popular courses of each query student's department."""
    asking = members(domain).join(users.select("std_no"), "std_no", "left_semi")
    return (
        popular_courses(domain, params)
        .join(asking, "dept")
        .select(F.col("std_no").alias("query_std"), "item")
    )


def hit_metrics(recommended: DataFrame, truth: DataFrame) -> DataFrame:
    """Per query_std: hits, sizes, precision, recall, f_measure.

    ``ref_precision`` and ``ref_recall`` are the same two numbers under the names
    the original swaps. No hit gives an f_measure of 0.0.
    """
    tagged = (
        recommended.select("query_std", "item", F.lit(1).alias("r"), F.lit(0).alias("t"))
        .unionByName(truth.select("query_std", "item", F.lit(0).alias("r"), F.lit(1).alias("t")))
        .groupBy("query_std", "item")
        .agg(F.max("r").alias("r"), F.max("t").alias("t"))
        .groupBy("query_std")
        .agg(
            F.sum(F.col("r") * F.col("t")).alias("hits"),
            F.sum("r").alias("n_recommended"),
            F.sum("t").alias("n_truth"),
        )
    )
    precision = zero_safe_div(F.col("hits").cast("double"), F.col("n_recommended").cast("double"))
    recall = zero_safe_div(F.col("hits").cast("double"), F.col("n_truth").cast("double"))
    p, r = F.col("precision"), F.col("recall")
    return (
        tagged.withColumn("precision", precision)
        .withColumn("recall", recall)
        .withColumn("f_measure", zero_safe_div(F.lit(2.0) * (r * p), r + p))
        .withColumn("ref_precision", r)
        .withColumn("ref_recall", p)
    )


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction"):
    """label, prediction, n; at most classes x classes rows."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def confusion_matrix(counts: DataFrame, classes: list) -> DataFrame:
    """One row per label, one column per class and one, ``pred_other``, for all other predictions.

    The classes are given, not searched for; a null prediction counts as other.
    """
    cells = [
        F.coalesce(F.sum(F.when(F.col("prediction") == c, F.col("n"))), F.lit(0)).alias(f"pred_{c}")
        for c in classes
    ]
    known = F.coalesce(F.col("prediction").isin(classes), F.lit(False))
    cells.append(F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("pred_other"))
    return counts.groupBy("label").agg(*cells)


def label_metrics(counts: DataFrame) -> DataFrame:
    """Per label: support and precision, recall, false positive rate, f1, share of rows."""
    rows = counts.select(
        F.col("label").alias("l"),
        F.col("n").alias("actual"),
        F.lit(0).cast("bigint").alias("predicted"),
        F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp"),
    ).unionByName(
        counts.select(
            F.col("prediction").alias("l"),
            F.lit(0).cast("bigint").alias("actual"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("bigint").alias("tp"),
        )
    )
    total = counts.agg(F.sum("n").cast("double").alias("total")).scalar()
    per_label = (
        rows.groupBy(F.col("l").alias("label"))
        .agg(*[F.sum(c).cast("double").alias(c) for c in ("actual", "predicted", "tp")])
        .withColumn("total", total)
    )
    tp, actual, predicted = F.col("tp"), F.col("actual"), F.col("predicted")
    p, r = F.col("precision"), F.col("recall")
    return (
        per_label.withColumn("precision", zero_safe_div(tp, predicted))
        .withColumn("recall", zero_safe_div(tp, actual))
        .withColumn("fpr", zero_safe_div(predicted - tp, F.col("total") - actual))
        .withColumn("f1", zero_safe_div(F.lit(2.0) * p * r, p + r))
        .select("label", "actual", "tp", "total", "precision", "recall", "fpr", "f1")
    )


def weighted_metrics(counts: DataFrame) -> DataFrame:
    """One row: accuracy and the label metrics weighted by how often a label occurs."""
    share = F.col("actual") / F.col("total")
    weighted = [
        F.sum(F.col(c) * share).alias(f"weighted_{c}") for c in ("precision", "recall", "f1", "fpr")
    ]
    return label_metrics(counts).agg(
        (F.sum("tp") / F.max("total")).alias("accuracy"), *weighted
    )


def rmse(df: DataFrame, label: str, prediction: str) -> DataFrame:
    gap = F.col(label) - F.col(prediction)
    return df.agg(F.sqrt(F.avg(gap * gap)).alias("rmse"))


def _f_beta(p: Column, r: Column, beta: float) -> Column:
    b2 = beta * beta
    return zero_safe_div(F.lit(1.0 + b2) * p * r, F.lit(b2) * p + r)


def score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """score, pos, neg: rows per distinct score."""
    return df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )


def threshold_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score taken as threshold: counts, precision, recall, f1, f05, fpr.

    A row counts as positive where its score reaches the threshold.
    """
    curve = running_totals(
        score_counts(df, score, label),
        F.col("score").desc(),
        {"pos": "tp", "neg": "fp"},
        {"pos": "p", "neg": "n"},
    )
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    return (
        curve.withColumn("precision", zero_safe_div(tp, tp + fp))
        .withColumn("recall", zero_safe_div(tp, F.col("p")))
        .withColumn("fpr", zero_safe_div(fp, F.col("n")))
        .withColumn("f1", _f_beta(F.col("precision"), F.col("recall"), 1.0))
        .withColumn("f05", _f_beta(F.col("precision"), F.col("recall"), 0.5))
    )


def curve_areas(curve: DataFrame) -> DataFrame:
    """One row: area under the ROC and the precision-recall curve, by trapezoids.

    A point's predecessor follows from its own counts, so no row looks at another.
    The precision-recall curve starts at recall 0 with the first point's precision.
    """
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    recall0, fpr0 = zero_safe_div(tp0, F.col("p")), zero_safe_div(fp0, F.col("n"))
    precision0 = F.when(tp0 + fp0 > 0, zero_safe_div(tp0, tp0 + fp0)).otherwise(F.col("precision"))
    return curve.agg(
        F.sum((F.col("fpr") - fpr0) * (F.col("recall") + recall0) / 2.0).alias("auroc"),
        F.sum((F.col("recall") - recall0) * (F.col("precision") + precision0) / 2.0).alias("aupr"),
    )
