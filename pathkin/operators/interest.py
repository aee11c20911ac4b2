"""Companies a query student is interested in, and the people who work there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathkin.domain import Domain
from pathkin.functions.scalars import short_gender
from pathkin.operators.facts import Facts, facts_of
from pathkin.operators.relational import spread_join
from pathkin.params import Params

APPLIED, SEARCHED, SAME_GROUP = 1, 2, 3


def _only(df: DataFrame, users: DataFrame | None) -> DataFrame:
    return df if users is None else df.join(users.select("std_no"), "std_no", "left_semi")


def applied_companies(domain: Domain | Facts, users: DataFrame | None = None) -> DataFrame:
    """std_no, reg_date, company of applications that were sent."""
    sent = (
        _only(domain.applications.filter(F.col("applied") == "Y"), users)
        .select("posting_id", "reg_date", "std_no")
        .distinct()
    )
    postings = domain.postings.select("posting_id", "company").distinct()
    return sent.join(postings, "posting_id").select("std_no", "reg_date", "company")


def searched_companies(domain: Domain | Facts, users: DataFrame | None = None) -> DataFrame:
    """std_no, reg_date, company of job searches."""
    return (
        _only(domain.searches, users)
        .select("search_id", "std_no", "reg_date", "company")
        .distinct()
        .select("std_no", "reg_date", "company")
    )


def same_group_companies(domain: Domain | Facts, users: DataFrame) -> DataFrame:
    """std_no, company: employers of graduates of the student's department and gender."""
    wanted = (
        domain.students.join(users.select("std_no"), "std_no", "left_semi")
        .select("std_no", "dept", short_gender(F.col("gender")).alias("gender"))
        .distinct()
    )
    employers = facts_of(domain).graduates.select("dept", "gender", "company").distinct()
    return spread_join(employers, wanted, ["dept", "gender"], ["company"]).select(
        "std_no", "company"
    )


def interest_bundle(domain: Domain | Facts, users: DataFrame) -> DataFrame:
    """std_no, company, source: all three lists, tagged 1 applied, 2 searched, 3 same group."""
    lists = [
        (applied_companies(domain, users), APPLIED),
        (searched_companies(domain, users), SEARCHED),
        (same_group_companies(domain, users), SAME_GROUP),
    ]
    tagged = [df.select("std_no", "company", F.lit(tag).alias("source")) for df, tag in lists]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2]).distinct()


def interest_cascade(domain: Domain | Facts, users: DataFrame, params: Params = Params()) -> DataFrame:
    """std_no, company, source of the lists a student needs to reach enough companies.

    Applications alone if there are enough; else searches too; else also the
    employers of the same department and gender, which are looked up only for the
    students who get that far. A company in two lists counts in both and is kept
    once, under its first source.
    """
    direct = (
        applied_companies(domain, users)
        .select("std_no", "company", F.lit(APPLIED).alias("source"))
        .unionByName(
            searched_companies(domain, users).select(
                "std_no", "company", F.lit(SEARCHED).alias("source")
            )
        )
        .distinct()
    )
    direct = facts_of(domain).keep_in_run(direct, "direct")
    sizes = direct.groupBy("std_no").agg(
        F.count_if(F.col("source") == APPLIED).alias("n1"),
        F.count("*").alias("n12"),
    )
    enough = params.enough_companies
    levels = (
        users.select("std_no")
        .distinct()
        .join(sizes, "std_no", "left")
        .select(
            "std_no",
            F.when(F.col("n1") >= enough, APPLIED)
            .when(F.col("n12") >= enough, SEARCHED)
            .otherwise(SAME_GROUP)
            .alias("level"),
        )
    )
    kept = direct.join(levels, "std_no").filter(F.col("source") <= F.col("level"))
    rest = same_group_companies(domain, levels.filter(F.col("level") == SAME_GROUP))
    return (
        kept.select("std_no", "company", "source")
        .unionByName(rest.select("std_no", "company", F.lit(SAME_GROUP).alias("source")))
        .groupBy("std_no", "company")
        .agg(F.min("source").alias("source"))
    )


def company_graduates(domain: Domain | Facts, chosen: DataFrame, keep: list[str] = []) -> DataFrame:
    """query_std, company, std_no: graduates of each chosen company.

    ``chosen`` has one row per (std_no, company); columns named in ``keep`` ride
    along. The join multiplies rows.
    """
    people = facts_of(domain).graduates.select("std_no", "company").distinct()
    chosen = chosen.select(F.col("std_no").alias("query_std"), "company", *keep)
    return spread_join(people, chosen, ["company"], ["std_no"], buckets=4).select(
        "query_std", "company", "std_no", *keep
    )
