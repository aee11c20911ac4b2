"""Blend, neighbours and ranked recommendations for many query students at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathkin.domain import Domain
from pathkin.functions.scalars import COMPLETED, COUNT_CODES, TITLE_CODES, int_div
from pathkin.operators.facts import Facts, facts_of
from pathkin.operators.interest import interest_cascade
from pathkin.operators.relational import top_k
from pathkin.operators.similarity import similarity
from pathkin.operators.trust import content_trust, user_trust
from pathkin.params import Params

COURSE, PROGRAMME = "course", "programme"
# Column names of the saved result, in order.
RESULT_COLUMNS = {
    COURSE: "SBJT_KEY_CD",
    PROGRAMME: "NPI_KEY_ID",
    "OAMTYPCD01": "OAMTYPCD01",
    "OAMTYPCD02": "OAMTYPCD02",
    "OAMTYPCD03": "OAMTYPCD03_AVG",
    "OAMTYPCD04": "OAMTYPCD04_AVG",
    "OAMTYPCD05": "OAMTYPCD05_AVG",
}


def blend(trust: DataFrame, similar: DataFrame, params: Params = Params()) -> DataFrame:
    """query_std, std_no, similarity, trust, score; a missing side counts as 0."""
    both = trust.join(
        similar.select("query_std", "std_no", "similarity"), ["query_std", "std_no"], "full"
    ).na.fill(0.0, ["similarity", "trust"])
    return both.withColumn(
        "score",
        F.col("similarity") * F.lit(params.blend_similarity_share)
        + F.col("trust") * F.lit(params.blend_trust_share),
    )


def nearest(blended: DataFrame, params: Params = Params()) -> DataFrame:
    """query_std, std_no, score, rank of the best people per query student.

    ``k`` is how many people the query student got; it rides along so that later
    steps need this frame only once.
    """
    people = blended
    if not params.include_self:
        people = people.filter(F.col("std_no") != F.col("query_std"))
    order = [F.col("score").desc(), F.col("std_no")]
    if "company" in people.columns:
        order.append(F.col("company"))
    best = top_k(people, ["query_std"], order, params.neighbours)
    return best.select(
        "query_std",
        "std_no",
        "score",
        "rank",
        F.count("*").over(Window.partitionBy("query_std")).alias("k"),
    )


def neighbours(domain: Domain | Facts, users: DataFrame, params: Params = Params()) -> DataFrame:
    """``nearest`` over trust and similarity.

    With one trust row per employer, the best rows are those of people whose best row
    is among the best people's: these are found first, by one row a person, and only
    their rows by employer are blended and ranked.
    """
    facts = facts_of(domain)
    similar = similarity(domain, users, params)
    if params.trust_agg == "max":
        people = nearest(blend(user_trust(domain, users, params), similar, params), params)
        return facts.keep_in_run(people, "neighbours")
    chosen = facts.keep(interest_cascade(domain, users, params), "chosen")
    by_person = params.with_(trust_agg="max")
    first = blend(user_trust(domain, users, by_person, chosen), similar, params)
    if not params.include_self:
        first = first.filter(F.col("std_no") != F.col("query_std"))
    first = top_k(first, ["query_std"], [F.col("score").desc(), F.col("std_no")], params.neighbours)
    # at most ``neighbours`` rows a query student
    first = facts.keep(first.select("query_std", "std_no", "similarity"), "best-people")
    trust = user_trust(domain, users, params, chosen, first)
    trust = trust.join(first.select("query_std", "std_no"), ["query_std", "std_no"], "left_semi")
    return facts.keep_in_run(nearest(blend(trust, first, params), params), "neighbours")


def doings(domain: Domain | Facts, people: DataFrame) -> DataFrame:
    """std_no, what, item, done, n of the given people (std_no, distinct).

    Distinct courses and enrolments count once; ``done`` is false for enrolments that
    are not completed. Titles of codes 01-02 and the codes 03-05 count all rows. The
    people come first, so each table is read once and only their rows go on.
    """
    facts = facts_of(domain)
    code = F.col("act_type")
    one = F.lit(1).cast("bigint").alias("n")
    yes = F.lit(True).alias("done")
    courses = facts.taken.join(people, "std_no").select(
        "std_no", F.lit(COURSE).alias("what"), F.col("course").alias("item"), yes, one
    )
    programmes = (
        facts.enrolments.join(people, "std_no")
        .select("std_no", "enrol_id", "programme", "state")
        .distinct()
        .select(
            "std_no", F.lit(PROGRAMME).alias("what"), F.col("programme").alias("item"),
            F.coalesce(F.col("state") == COMPLETED, F.lit(False)).alias("done"), one,
        )
    )
    activities = (
        facts.acts.filter(code.isin(TITLE_CODES + COUNT_CODES))
        .join(people, "std_no")
        .select("std_no", code.alias("what"), F.when(code.isin(TITLE_CODES), F.col("title")).otherwise(code).alias("item"), yes, "n")
    )
    return courses.unionByName(programmes).unionByName(activities)


def _doings_of_all(domain: Domain | Facts, people: DataFrame, users: DataFrame) -> DataFrame:
    involved = people.select("std_no").unionByName(users.select("std_no")).distinct()
    return facts_of(domain).keep_in_run(doings(domain, involved), "doings")


def item_counts(done: DataFrame, people: DataFrame) -> DataFrame:
    """query_std, what, item, n, k: how often the k neighbours did each thing.

    Neighbours are at most k rows per query student; one join and one grouping serve
    all kinds of items.
    """
    return (
        done.filter("done")
        .join(people.select("query_std", "std_no", "k"), "std_no")
        .groupBy("query_std", "what", "item")
        .agg(F.sum("n").alias("n"), F.max("k").alias("k"))
    )


def exclude_own(done: DataFrame, counts: DataFrame, users: DataFrame, params: Params = Params()) -> DataFrame:
    """Take out courses and programmes the query student already has.

    "anti" removes the item; "multiset" lowers its count by one, as a bag
    difference does.
    """
    own = (
        done.filter(F.col("what").isin(COURSE, PROGRAMME))
        .join(users.select("std_no").distinct(), "std_no")
        .select(F.col("std_no").alias("query_std"), "what", "item")
        .distinct()
    )
    key = ["query_std", "what", "item"]
    if params.exclude == "anti":
        return counts.join(own, key, "left_anti")
    return (
        counts.join(own.withColumn("_own", F.lit(1)), key, "left")
        .withColumn("n", F.col("n") - F.coalesce("_own", F.lit(0)))
        .filter(F.col("n") > 0)
        .drop("_own")
    )


def weigh(domain: Domain | Facts, counts: DataFrame) -> DataFrame:
    """Add ``score``: count times mean star for courses and programmes, else the count."""
    stars = content_trust(domain)
    weight = F.when(F.col("what").isin(COURSE, PROGRAMME), F.coalesce("star", F.lit(1.0)))
    return counts.join(stars, "item", "left").select(
        "query_std",
        "what",
        "item",
        "n",
        "k",
        (F.col("n") * weight.otherwise(F.lit(1.0))).alias("score"),
    )


def ranked_items(
    domain: Domain | Facts, people: DataFrame, users: DataFrame, params: Params = Params()
) -> DataFrame:
    """query_std, what, item, n, k, score, rank: the best items of each kind."""
    done = _doings_of_all(domain, people, users)
    counts = exclude_own(done, item_counts(done, people), users, params)
    order = [F.col("score").desc(), F.col("item")]
    return top_k(weigh(domain, counts), ["query_std", "what"], order, params.max_items)


def _mean_participation(params: Params) -> Column:
    return F.col("n") / F.col("k") if params.exact_activity else int_div(F.col("n"), F.col("k"))


def participation(domain: Domain | Facts, people: DataFrame, params: Params = Params()) -> DataFrame:
    """query_std, what, n, mean_n: mean participation of the neighbours per code."""
    near = people.select("std_no").distinct()
    counts = item_counts(doings(domain, near), people).filter(F.col("what").isin(COUNT_CODES))
    return counts.select("query_std", "what", "n", _mean_participation(params).alias("mean_n"))


def assemble(
    domain: Domain | Facts, people: DataFrame, users: DataFrame, params: Params = Params()
) -> DataFrame:
    """query_std, Rank and one column per kind of recommendation.

    The seven ranked lists sit in one long frame, so lining them up by rank is a
    single grouping by (query student, rank).
    """
    ranked = ranked_items(domain, people, users, params)
    rows = ranked.withColumn("_mean", _mean_participation(params))
    columns = []
    for what, name in RESULT_COLUMNS.items():
        value = F.col("_mean") if what in COUNT_CODES else F.col("item")
        columns.append(F.max(F.when(F.col("what") == what, value)).alias(name))
    return rows.groupBy("query_std", F.col("rank").alias("Rank")).agg(*columns)


def recommend(domain: Domain | Facts, users: DataFrame, params: Params = Params()) -> DataFrame:
    """The whole recommendation for a frame of query students (column std_no)."""
    return assemble(domain, neighbours(domain, users, params), users, params)
