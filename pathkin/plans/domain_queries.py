"""Queries for interest, trust, features, similarity, recommendation and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathkin.functions.scalars import quantise
from pathkin.operators import evaluate as ev
from pathkin.operators import features as fe
from pathkin.operators import interest as it
from pathkin.operators import recommend as rc
from pathkin.operators import similarity as si
from pathkin.operators import trust as tr
from pathkin.operators.relational import hot_join
from pathkin.params import Params
from pathkin.plans.testdata import gathered, load_domain, query_students, table
from pathkin.session import scratch_path, stage
from pathkin.sources import stores
from pathkin.sources.schemas import COLLECTIONS

QUERIES = {}
SIX = 6


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _asking(spark: SparkSession, sf: str):
    """The domain and the asking students, a parameter table of one row per department."""
    domain = load_domain(spark, sf)
    return domain, stage(query_students(domain), "asking")


def _in_run(spark: SparkSession, sf: str, make) -> DataFrame:
    """``make(facts, asking)`` over facts gathered once; the run's tables are removed, its result stays."""
    with gathered(spark, sf) as (facts, asking):
        return stage(make(facts, asking), "result")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, SIX) for c in columns})


def _day(name: str):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


# ---- interest ----------------------------------------------------------------------


@query
def interest_applied(spark, sf):
    return it.applied_companies(load_domain(spark, sf)).select("std_no", _day("reg_date"), "company")


@query
def interest_searched(spark, sf):
    return it.searched_companies(load_domain(spark, sf)).select(
        "std_no", _day("reg_date"), "company"
    )


@query
def interest_same_dept_gender(spark, sf):
    return it.same_group_companies(*_asking(spark, sf))


@query
def interest_bundle(spark, sf):
    return it.interest_bundle(*_asking(spark, sf))


@query
def interest_cascade(spark, sf):
    return it.interest_cascade(*_asking(spark, sf))


@query
def company_graduates(spark, sf):
    """How many graduates each company of interest has."""
    domain, asking = _asking(spark, sf)
    people = it.company_graduates(domain, it.interest_cascade(domain, asking))
    return people.groupBy("query_std", "company").agg(F.count("*").alias("n"))


# ---- trust ----------------------------------------------------------------------------


@query
def company_trust(spark, sf):
    """Best employer trust of each graduate, per asking student."""
    best = F.round(F.max("company_trust"), SIX).alias("best")

    def make(facts, asking):
        people = tr.company_trust(facts, asking).groupBy("query_std", "std_no")
        return people.agg(best, F.count("*").alias("employers"))

    return _in_run(spark, sf, make)


@query
def company_trust_all(spark, sf):
    return _rounded(tr.company_trust_all(load_domain(spark, sf)), "company_trust")


@query
def content_trust(spark, sf):
    return _rounded(tr.content_trust(load_domain(spark, sf)), "star")


@query
def activity_score(spark, sf):
    domain = load_domain(spark, sf)
    exact = tr.activity_score(domain, Params(exact_activity=True))
    whole = F.floor("act_score").cast("double")
    return exact.select("std_no", whole.alias("act_score"), F.round("act_score", SIX).alias("exact"))


@query
def user_trust(spark, sf):
    return _rounded(_in_run(spark, sf, tr.user_trust), "trust")


@query
def user_trust_exact(spark, sf):
    exact = Params(exact_activity=True)
    return _rounded(_in_run(spark, sf, lambda facts, asking: tr.user_trust(facts, asking, exact)), "trust")


# ---- features -----------------------------------------------------------------------------


@query
def cohort(spark, sf):
    return fe.cohort(*_asking(spark, sf))


def _entries_text(df: DataFrame, column: str, scale: int) -> DataFrame:
    """A sparse vector as ``size|position:value,...`` with whole values."""
    v = F.col(column)
    pairs = F.zip_with(
        v["positions"], v["values"], lambda p, x: F.concat_ws(":", p.cast("string"), quantise(x, scale).cast("string"))
    )
    return df.withColumn(column, F.concat_ws("|", v["size"].cast("string"), F.array_join(pairs, ",")))


@query
def course_vector(spark, sf):
    return _entries_text(fe.course_vectors(load_domain(spark, sf)), "SUBJECT_STAR", 10)


@query
def course_vector_3state(spark, sf):
    return _entries_text(fe.course_vectors(load_domain(spark, sf), three_state=True), "SUBJECT_STAR", 10)


@query
def area_vector(spark, sf):
    return _entries_text(fe.area_vectors(load_domain(spark, sf)), "NCR_STAR", 10)


@query
def activity_vector(spark, sf):
    return _entries_text(fe.activity_vectors(load_domain(spark, sf)), "ACTING_COUNT", 1)


@query
def took_flags(spark, sf):
    return _entries_text(fe.took_vectors(load_domain(spark, sf)), "TOOK", 1)


_FEATURES = [("SUBJECT_STAR", 10), ("NCR_STAR", 10), ("ACTING_COUNT", 1)]


@query
def feature_join(spark, sf):
    """Every student's three vectors, sparse."""
    vectors = _in_run(spark, sf, lambda facts, asking: fe.feature_table(facts))
    for column, scale in _FEATURES:
        vectors = _entries_text(vectors, column, scale)
    return vectors


@query
def feature_dense(spark, sf):
    """The stored, dense form for the asking students."""
    dense = _in_run(spark, sf, lambda facts, asking: fe.dense_features(fe.feature_table(facts), asking))
    for column, scale in _FEATURES:
        whole = F.transform(column, lambda v: quantise(v, scale).cast("string"))
        dense = dense.withColumn(column, F.array_join(whole, ","))
    return dense


# ---- similarity ---------------------------------------------------------------------------


def _similar(spark, sf, *columns):
    similar = _in_run(spark, sf, si.similarity).select("query_std", "dept", "std_no", *columns)
    return _rounded(similar, *columns)


@query
def cosine_course(spark, sf):
    return _similar(spark, sf, "sbjt_similarity")


@query
def cosine_total(spark, sf):
    return _similar(
        spark, sf, "sbjt_similarity", "ncr_similarity", "acting_similarity", "similarity"
    )


@query
def cosine_concat(spark, sf):
    return _similar(spark, sf, "concat_similarity")


# ---- blend and recommendation ------------------------------------------------------------


def _blend(facts, asking):
    return rc.blend(tr.user_trust(facts, asking), si.similarity(facts, asking))


@query
def blend_score(spark, sf):
    blended = _in_run(spark, sf, _blend).select("query_std", "std_no", "similarity", "trust", "score")
    return _rounded(blended, "similarity", "trust", "score")


@query
def top_neighbours(spark, sf):
    return _rounded(_in_run(spark, sf, rc.neighbours), "score")


def _ranked(spark, sf, kinds: list[str], params: Params = Params()):
    def make(facts, asking):
        people = rc.neighbours(facts, asking, params)
        return rc.ranked_items(facts, people, asking, params).filter(F.col("what").isin(kinds))

    ranked = _in_run(spark, sf, make)
    return _rounded(ranked.select("query_std", "what", "item", "n", "score", "rank"), "score")


@query
def rec_courses(spark, sf):
    return _ranked(spark, sf, [rc.COURSE])


@query
def rec_courses_multiset(spark, sf):
    return _ranked(spark, sf, [rc.COURSE], Params(exclude="multiset", include_self=True))


@query
def rec_programmes(spark, sf):
    return _ranked(spark, sf, [rc.PROGRAMME])


@query
def rec_titles(spark, sf):
    return _ranked(spark, sf, ["OAMTYPCD01", "OAMTYPCD02"])


@query
def mean_participation(spark, sf):
    return _in_run(spark, sf, lambda facts, asking: rc.participation(facts, rc.neighbours(facts, asking)))


@query
def rec_assembled(spark, sf):
    return _in_run(spark, sf, rc.recommend)


@query
def recommend_first_run(spark, sf):
    """Every switch set as in the original run."""
    first = Params.as_first_run()
    return _in_run(spark, sf, lambda facts, asking: rc.recommend(facts, asking, first))


@query
def result_roundtrip(spark, sf):
    """All asking students' results are stored, then those of some are replaced by shorter ones."""
    root, name = scratch_path(spark, "results"), "Recommend_Result"
    counts = [c for c in rc.RESULT_COLUMNS.values() if c.endswith("_AVG")]
    with gathered(spark, sf) as (facts, asking):
        whole = rc.recommend(facts, asking).withColumnRenamed("query_std", "QUERY_STD")
        stored = whole.withColumns({c: F.col(c).cast("int") for c in counts})
        stored = facts.keep(stored, "whole")
        stores.replace_results(stored, root, name, "QUERY_STD", facts.workspace)
        shorter = stored.filter((F.col("QUERY_STD").cast("bigint") % 3 == 0) & (F.col("Rank") <= 4))
        stores.replace_results(shorter, root, name, "QUERY_STD", facts.workspace)
    back = stores.read_results(spark, root, name, COLLECTIONS[name])
    return back.withColumns({c: F.col(c).cast("bigint") for c in counts})


# ---- evaluation ---------------------------------------------------------------------------


@query
def ground_truth(spark, sf):
    return ev.popular_courses(load_domain(spark, sf))


@query
def ground_truth_programmes(spark, sf):
    return ev.popular_programmes(load_domain(spark, sf))


@query
def eval_prf(spark, sf):
    def make(facts, asking):
        recommended = rc.ranked_items(facts, rc.neighbours(facts, asking), asking)
        return ev.hit_metrics(recommended.filter(F.col("what") == rc.COURSE), ev.truth_for(facts, asking))

    metrics = _in_run(spark, sf, make)
    return _rounded(metrics, "precision", "recall", "f_measure", "ref_precision", "ref_recall")


def _scored_docs(spark, sf):
    """Quality as label, toxic as prediction, document length as score."""
    labels = table(spark, sf, "labels")
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return labels.join(docs, "doc_id").select(
        F.col("quality").alias("label"), F.col("toxic").alias("prediction"), "n_chars"
    )


@query
def confusion_counts(spark, sf):
    return ev.confusion_counts(_scored_docs(spark, sf))


@query
def confusion_matrix(spark, sf):
    return ev.confusion_matrix(ev.confusion_counts(_scored_docs(spark, sf)), [0, 1])


@query
def per_label_metrics(spark, sf):
    metrics = ev.label_metrics(ev.confusion_counts(_scored_docs(spark, sf)))
    return _rounded(metrics, "precision", "recall", "fpr", "f1")


@query
def weighted_metrics(spark, sf):
    metrics = ev.weighted_metrics(ev.confusion_counts(_scored_docs(spark, sf)))
    return _rounded(metrics, *metrics.columns)


@query
def metrics_by_threshold(spark, sf):
    curve = ev.threshold_curve(_scored_docs(spark, sf), "n_chars", "label")
    columns = ["precision", "recall", "f1", "f05", "fpr"]
    return _rounded(curve.select("score", "tp", "fp", *columns), *columns)


@query
def pr_roc_areas(spark, sf):
    areas = ev.curve_areas(ev.threshold_curve(_scored_docs(spark, sf), "n_chars", "label"))
    return _rounded(areas, "auroc", "aupr")


@query
def rmse(spark, sf):
    """Each star against the mean star of its item."""
    domain = load_domain(spark, sf)
    means = tr.content_trust(domain).withColumnRenamed("star", "mean_star")
    both = hot_join(domain.ratings, means, ["item"], ["std_no", "star"])
    return _rounded(ev.rmse(both, "star", "mean_star"), "rmse")
