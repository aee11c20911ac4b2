"""Quality by a sparse rule ensemble, compiled into column expressions.

Statistics of a text are column expressions. Boosted trees are fitted on the
statistics of a bounded sample of labelled rows; every path from a root is a
conjunctive rule. A lasso logistic regression weighs the rules and most weights
become zero. What is left is one column expression over the statistics, so scoring
needs no Python and no model object.

Null and empty texts have all statistics 0 and are scored like others. Without two
classes of labels every score is the share of label 1 (0.5 without any). Repeated
rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathkin.llm.base import DOC_COLUMNS, fold, labelled_sample, table, whole_text
from pathkin.session import stage as written

Rule = tuple[tuple[int, bool, float], ...]  # (statistic, is it at most the bound, bound)
STATISTICS = ["chars", "words", "distinct", "upper", "symbols", "repeats", "word_length", "digits", "lines"]


def statistics(df: DataFrame) -> DataFrame:
    """Adds one array column ``stats`` of doubles for ``text``."""
    text = F.col("text")
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    words = F.split(text, "\\s+")
    many = lambda pattern: F.regexp_count(text, F.lit(pattern)) / n
    counted = df.withColumn("words_", words)
    size = F.greatest(F.size("words_"), F.lit(1)).cast("double")
    follows = F.zip_with(
        F.col("words_"), F.slice("words_", 2, F.size("words_")), lambda a, b: (a == b).cast("int")
    )
    repeats = F.aggregate(follows, F.lit(0), lambda acc, x: acc + F.coalesce(x, F.lit(0)))
    values = [
        F.log1p(n),
        F.log1p(size),
        F.size(F.array_distinct("words_")) / size,
        many("[A-Z]"),
        many("[^\\p{L}\\p{N}\\s.,;:'\"()-]"),
        repeats / size,
        n / size,
        many("[0-9]"),
        many("\n"),
    ]
    empty = F.array(*[F.lit(0.0)] * len(values))
    stats = F.when(text == "", empty).otherwise(F.array(*[v.cast("double") for v in values]))
    return counted.withColumn("stats", stats).drop("words_")


def tree_rules(model) -> list[Rule]:
    """Every path from a root to a node of the fitted trees, without repeats."""
    rules: dict[Rule, None] = {}

    def walk(node, path):
        if path:
            rules[tuple(path)] = None
        if "LeafNode" in node.getClass().getName():
            return
        split = node.split()
        at, bound = split.featureIndex(), split.threshold()
        walk(node.leftChild(), [*path, (at, True, bound)])
        walk(node.rightChild(), [*path, (at, False, bound)])

    for tree in model.trees:
        walk(tree._call_java("rootNode"), [])
    return list(rules)


def holds(rule: Rule, stats: Column) -> Column:
    out = F.lit(True)
    for at, at_most, bound in rule:
        out = out & ((stats[at] <= bound) if at_most else (stats[at] > bound))
    return out.cast("double")


def fit(
    spark: SparkSession, sf_dir: str, sample: int = 4000, trees: int = 8, depth: int = 3, lasso: float = 2e-3
) -> Column:
    """Score of a row that has ``stats``; learned from at most ``sample`` rows of each label."""
    rows = statistics(labelled_sample(spark, sf_dir, "quality", sample)).select("stats", "label")
    rows = written(rows.select(*[F.col("stats")[i].alias(s) for i, s in enumerate(STATISTICS)], "label"), "quality")
    counts = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return F.lit(float(next(iter(counts), 0.5)))
    vectors = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(rows).coalesce(2).cache()
    rules = tree_rules(GBTClassifier(maxDepth=depth, maxIter=trees, seed=5).fit(vectors))
    vectors.unpersist()
    if not rules:
        return F.lit(counts[1] / sum(counts.values()))
    stats = F.array(*STATISTICS)
    names = [f"rule{i}" for i in range(len(rules))]
    ruled = rows.select("label", *[holds(r, stats).alias(n) for r, n in zip(rules, names)])
    ruled = VectorAssembler(inputCols=names, outputCol="features").transform(ruled).coalesce(2)
    model = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60).fit(ruled)
    total = F.lit(float(model.intercept))
    for rule, weight in zip(rules, model.coefficients.toArray()):
        if weight != 0:
            total = total + holds(rule, F.col("stats")) * F.lit(float(weight))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def op4_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = fit(spark, sf_dir)
    docs = table(spark, sf_dir, "documents")
    docs = statistics(docs.select("doc_id", whole_text(docs).alias("text")))
    return docs.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with a score below 0.3 go."""
    score = fit(spark, sf_dir)
    scored = statistics(docs.withColumn("text", whole_text(docs)))
    return scored.where(score >= 0.3).select(*DOC_COLUMNS)
