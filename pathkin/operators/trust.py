"""How far to trust people and items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathkin.domain import Domain
from pathkin.functions.scalars import int_div, safe_int_ratio, safe_ratio, units_mean
from pathkin.operators.facts import Facts, facts_of
from pathkin.operators.interest import interest_cascade
from pathkin.operators.relational import numbered, spread_join
from pathkin.params import Params


def company_score(params: Params = Params()) -> Column:
    return (
        F.col("w_company") * F.lit(params.company_share) * F.lit(params.company_scale)
        + F.col("w_headcount") * F.lit(params.headcount_share) * F.lit(params.headcount_scale)
    )


def rate_employers(pairs: DataFrame, ratings: DataFrame, params: Params = Params()) -> DataFrame:
    """Add ``company_trust`` to rows with a ``company``; unrated companies get 0.0."""
    scores = (
        ratings.groupBy("company")
        .agg(F.max(F.struct("w_company", "w_headcount")).alias("w"))
        .select("company", "w.*")
        .select("company", company_score(params).alias("_score"))
    )
    spread_by = [c for c in pairs.columns if c != "company"] or ["company"]
    return spread_join(pairs, scores, ["company"], spread_by, "left").withColumn(
        "company_trust", F.coalesce("_score", F.lit(0.0))
    ).drop("_score")


def company_trust_all(domain: Domain | Facts, params: Params = Params()) -> DataFrame:
    """company, std_no, company_trust for every graduate and employer."""
    pairs = facts_of(domain).graduates.select("company", "std_no").distinct()
    return rate_employers(pairs, domain.company_ratings, params)


def _set_bits() -> Column:
    return F.expr("filter(sequence(0, 63), b -> (mask & shiftleft(1L, b)) != 0)")


def _asked_companies(
    facts: Facts, users: DataFrame, params: Params, chosen: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """Two frames: query_std, block, bit; and company, block, mask, company_trust.

    Query students go in blocks of 64 as the bits of one number. ``chosen`` are their
    companies of interest (std_no, company) if the caller has them.
    """
    ids = users.select(F.col("std_no").alias("query_std")).filter("query_std is not null").distinct()
    at = F.col("position") - 1
    asking = facts.keep(
        numbered(ids, [], ["query_std"]).select(
            "query_std", int_div(at, F.lit(64).cast("bigint")).alias("block"), (at % 64).cast("int").alias("bit")
        ),
        "query-bits",
    )
    if chosen is None:
        chosen = interest_cascade(facts, users, params)
    bits = (
        chosen.select(F.col("std_no").alias("query_std"), "company")
        .join(asking, "query_std")
        .groupBy("company", "block")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
    )
    return asking, rate_employers(bits, facts.company_ratings, params)


def company_trust(
    domain: Domain | Facts,
    users: DataFrame,
    params: Params = Params(),
    chosen: DataFrame | None = None,
    people: DataFrame | None = None,
) -> DataFrame:
    """query_std, company, std_no, company_trust for employers the query student cares about.

    A graduate meets a company once for a block of query students and the rows are placed
    by graduate before they are multiplied, so that the larger result needs no shuffle
    where it is grouped or joined by graduate. ``people`` (std_no) limits the graduates.
    """
    facts = facts_of(domain)
    asking, rated = _asked_companies(facts, users, params, chosen)
    graduates = facts.graduates.select("std_no", "company")
    if people is not None:
        graduates = graduates.join(people.select("std_no").distinct(), "std_no", "left_semi")
    met = spread_join(graduates, rated, ["company"], ["std_no"], buckets=4).repartition("std_no").distinct()
    answered = met.select("std_no", "company", "block", "company_trust", F.explode(_set_bits()).alias("bit"))
    return answered.join(asking, ["block", "bit"]).select("query_std", "company", "std_no", "company_trust")


def content_trust(domain: Domain | Facts) -> DataFrame:
    """item, star: mean star of each course or programme."""
    sums = facts_of(domain).stars.groupBy("item").agg(F.sum("units").alias("units"), F.sum("rated").alias("rated"))
    return sums.select("item", F.when(F.col("rated") > 0, units_mean(F.col("units"), F.col("rated"))).alias("star"))


def activity_score(domain: Domain | Facts, params: Params = Params()) -> DataFrame:
    """std_no, stars, done, act_score for every student on the register.

    The four tables are stacked and counted in one grouping, so there is one
    shuffle of partial counts instead of four joins.
    """
    facts = facts_of(domain)
    one = F.lit(1).cast("bigint")
    stacked = facts.students.select("std_no", F.lit("student").alias("what"), one.alias("n"))
    for frame, what, number in [
        (facts.ratings, "star", one),
        (facts.courses, "done", one),
        (facts.enrolments, "done", one),
        (facts.acts, "done", F.col("n")),
    ]:
        stacked = stacked.unionByName(frame.select("std_no", F.lit(what).alias("what"), number.alias("n")))
    of = lambda what: F.coalesce(F.sum(F.when(F.col("what") == what, F.col("n"))), F.lit(0))
    counts = (
        stacked.groupBy("std_no")
        .agg(of("student").alias("_listed"), of("star").alias("stars"), of("done").alias("done"))
        .filter(F.col("_listed") > 0)
    )
    ratio = safe_ratio if params.exact_activity else safe_int_ratio
    return counts.select(
        "std_no",
        "stars",
        "done",
        ratio(F.col("stars"), F.col("done")).cast("double").alias("act_score"),
    )


def best_employers(
    domain: Domain | Facts, users: DataFrame, params: Params = Params(), chosen: DataFrame | None = None
) -> DataFrame:
    """query_std, std_no, company_trust: the best employer each query student cares about.

    Query students go in blocks of 64 as the bits of one number, so a graduate meets a
    company once for a block, not once for every query student. A company's trust is
    the same for all of them: a graduate's companies are merged by trust, and from the
    highest trust downward each query student is answered once, at their first bit.
    """
    facts = facts_of(domain)
    asking, rated = _asked_companies(facts, users, params, chosen)
    people = facts.graduates.select("std_no", "company").distinct()
    levels = (
        spread_join(people, rated, ["company"], ["std_no"])
        .groupBy("std_no", "block", "company_trust")
        .agg(F.bit_or("mask").alias("mask"))
        # as many entries as there are different values of trust
        .groupBy("std_no", "block")
        .agg(F.sort_array(F.collect_list(F.struct("company_trust", "mask")), asc=False).alias("levels"))
    )
    none = F.array().cast("array<struct<company_trust:double,mask:bigint>>")
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), none.alias("first"))

    def step(state: Column, level: Column) -> Column:
        new = level["mask"].bitwiseAND(F.bitwise_not(state["seen"]))
        return F.struct(
            state["seen"].bitwiseOR(level["mask"]).alias("seen"),
            F.when(new != 0, F.concat(state["first"], F.array(F.struct(level["company_trust"].alias("company_trust"), new.alias("mask")))))
            .otherwise(state["first"]).alias("first"),
        )

    answered = (
        levels.select("std_no", "block", F.explode(F.aggregate("levels", start, step)["first"]).alias("l"))
        .select("std_no", "block", "l.*")
        .select("std_no", "block", "company_trust", F.explode(_set_bits()).alias("bit"))
    )
    return answered.join(asking, ["block", "bit"]).select("query_std", "std_no", "company_trust")


def user_trust(
    domain: Domain | Facts,
    users: DataFrame,
    params: Params = Params(),
    chosen: DataFrame | None = None,
    people: DataFrame | None = None,
) -> DataFrame:
    """query_std, std_no, trust of the graduates of the companies of interest.

    One row per person (their best employer) unless ``trust_agg`` is "none", which
    keeps one row per employer, of the graduates in ``people`` only if it is given.
    """
    if params.trust_agg == "max":
        employers = best_employers(domain, users, params, chosen)
    else:
        employers = company_trust(domain, users, params, chosen, people)
    scores = activity_score(domain, params).select("std_no", "act_score")
    return employers.join(scores, "std_no").select(
        "query_std",
        "std_no",
        *(["company"] if params.trust_agg == "none" else []),
        (
            F.lit(params.trust_company_share) * F.col("company_trust")
            + F.lit(params.trust_activity_share) * F.col("act_score")
        ).alias("trust"),
    )
