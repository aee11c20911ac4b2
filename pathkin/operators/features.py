"""Cohorts and the per-student features compared inside a department.

Features stay in long form: one row per entry a student really has, never one
per student and possible item. Every missing entry has the same fill value, which
the similarity operators account for in closed form. Vectors are sparse: a size,
ascending positions and their values. Positions come from a distributed numbering
of each department's features. Dense arrays are built for asking students only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathkin.domain import Domain
from pathkin.functions.scalars import (
    COUNT_CODES,
    COURSE_STAR,
    PROGRAMME_STAR,
    TITLE_CODES,
    units_mean,
)
from pathkin.operators.facts import Facts, facts_of
from pathkin.operators.relational import numbered, outer_join_all, spread_join
from pathkin.params import Params

COURSE, AREA, CODE, TITLE = "course", "area", "act_code", "act_title"
KINDS = [COURSE, AREA, CODE, TITLE]
UNKNOWN_AREA = "__unknown__"


def members(domain: Domain | Facts) -> DataFrame:
    """dept, std_no: students with a completed course in the department."""
    known = F.col("dept").isNotNull() & F.col("std_no").isNotNull()
    return facts_of(domain).taken.filter(known).select("dept", "std_no").distinct()


def course_universe(domain: Domain | Facts) -> DataFrame:
    """dept, course: every course somebody of the department completed."""
    known = F.col("dept").isNotNull() & F.col("course").isNotNull()
    return facts_of(domain).taken.filter(known).select("dept", "course").distinct()


def cohort(domain: Domain | Facts, users: DataFrame, params: Params = Params()) -> DataFrame:
    """query_std, dept, std_no: everybody in the query student's department."""
    people = members(domain)
    asking = people.join(users.select("std_no"), "std_no", "left_semi").select(
        "dept", F.col("std_no").alias("query_std")
    )
    return spread_join(people, asking, ["dept"], ["std_no"]).select("query_std", "dept", "std_no")


def _star_per_item(domain: Domain | Facts, kind: str, params: Params) -> DataFrame:
    """std_no, item, units, n: stars of one student for one item; null stars don't count."""
    stars = facts_of(domain).stars.filter((F.col("kind") == kind) & (F.col("rated") > 0))
    if params.duplicate_star == "max":
        return stars.select("std_no", "item", F.col("top").alias("units"), F.lit(1).cast("bigint").alias("n"))
    return stars.select("std_no", "item", "units", F.col("rated").alias("n"))


def _course_stars(domain: Domain, params: Params) -> DataFrame:
    """std_no, kind, feature, value: mean star per rated course."""
    return _star_per_item(domain, COURSE_STAR, params).select(
        "std_no",
        F.lit(COURSE).alias("kind"),
        F.col("item").alias("feature"),
        units_mean(F.col("units"), F.col("n")).alias("value"),
    )


def course_entries(domain: Domain | Facts, params: Params = Params()) -> DataFrame:
    """dept, std_no, feature, value: mean star per rated course of the department.

    Stars for courses nobody of the department completed are dropped. A course may be
    everybody's, so entries are dealt over buckets of each course.
    """
    rated = _course_stars(domain, params).join(members(domain), "std_no")
    known = course_universe(domain).withColumnRenamed("course", "feature")
    return spread_join(rated, known, ["dept", "feature"], ["std_no"], "left_semi").select(
        "dept", "std_no", "feature", "value"
    )


def course_entries_three_state(domain: Domain, params: Params = Params()) -> DataFrame:
    """Star if rated, -1 if completed but not rated; all other courses mean 0.

    Only students who rated some course appear, as in the earlier variant. Stars
    and completions are stacked and grouped once.
    """
    rated = course_entries(domain, params)
    taken = facts_of(domain).taken.filter("dept is not null and course is not null").select(
        "dept", "std_no", F.col("course").alias("feature"), F.lit(None).cast("double").alias("value")
    )
    merged = (
        rated.unionByName(taken)
        .groupBy("dept", "std_no", "feature")
        .agg(F.max("value").alias("value"))
    )
    own = Window.partitionBy("dept", "std_no")
    return (
        merged.withColumn("_stars", F.count("value").over(own))
        .filter(F.col("_stars") > 0)
        .select("dept", "std_no", "feature", F.coalesce("value", F.lit(-1.0)).alias("value"))
    )


def _area_stars(domain: Domain, params: Params) -> DataFrame:
    """std_no, kind, feature, value: mean programme star per area.

    Stars are first summed per student and programme, then per area, so both
    shuffles carry partial sums.
    """
    infos = domain.programmes.select(F.col("programme").alias("item"), "area").distinct()
    stars = _star_per_item(domain, PROGRAMME_STAR, params)
    with_area = spread_join(stars, infos, ["item"], ["std_no"], "left")
    if params.drop_unknown_area:
        with_area = with_area.filter(F.col("area").isNotNull())
    return (
        with_area.groupBy("std_no", F.coalesce("area", F.lit(UNKNOWN_AREA)).alias("feature"))
        .agg(F.sum("units").alias("units"), F.sum("n").alias("n"))
        .select(
            "std_no",
            F.lit(AREA).alias("kind"),
            "feature",
            units_mean(F.col("units"), F.col("n")).alias("value"),
        )
    )


def area_entries(domain: Domain, params: Params = Params()) -> DataFrame:
    """dept, std_no, feature, value: mean programme star per area."""
    return (
        _area_stars(domain, params)
        .join(members(domain), "std_no")
        .select("dept", "std_no", "feature", "value")
    )


def _activity_values(domain: Domain | Facts, params: Params) -> DataFrame:
    """std_no, kind, feature, value: participation counts and title flags.

    One grouping serves both: codes 03-05 are counted (each title once, or each row),
    certificate and language titles give a flag of 1 however often they occur.
    """
    is_title = F.col("act_type").isin(TITLE_CODES)
    return (
        facts_of(domain).acts
        .filter(F.col("act_type").isin(TITLE_CODES + COUNT_CODES))
        .groupBy(
            "std_no",
            F.when(is_title, TITLE).otherwise(CODE).alias("kind"),
            F.when(is_title, F.col("title")).otherwise(F.col("act_type")).alias("feature"),
        )
        .agg((F.sum("n") if params.count_activity_rows else F.count("*")).alias("n"))
        .select(
            "std_no",
            "kind",
            "feature",
            F.when(F.col("kind") == TITLE, 1.0).otherwise(F.col("n").cast("double")).alias("value"),
        )
    )


def activity_entries(domain: Domain, params: Params = Params()) -> DataFrame:
    """dept, std_no, kind, feature, value of the activities."""
    return (
        _activity_values(domain, params)
        .join(members(domain), "std_no")
        .select("dept", "std_no", "kind", "feature", "value")
    )


def all_entries(domain: Domain | Facts, params: Params = Params()) -> DataFrame:
    """dept, std_no, kind, feature, value over all feature kinds.

    Every member also has one row with kind null, so members without any entry
    stay visible. Only course stars go through the join with the known courses.
    """
    others = _area_stars(domain, params).unionByName(_activity_values(domain, params))
    people = members(domain)
    blank = people.select(
        "dept",
        "std_no",
        F.lit(None).cast("string").alias("kind"),
        F.lit(None).cast("string").alias("feature"),
        F.lit(None).cast("double").alias("value"),
    )
    columns = ["dept", "std_no", "kind", "feature", "value"]
    courses = course_entries(domain, params).withColumn("kind", F.lit(COURSE))
    return (
        courses.select(*columns)
        .unionByName(others.join(people, "std_no").select(*columns))
        .unionByName(blank)
    )


# ---- sparse vectors -----------------------------------------------------------------


def positions(universe: DataFrame) -> DataFrame:
    """dept, feature, position: the features of a department numbered from 1 in text order."""
    known = universe.select("dept", "feature").filter("dept is not null and feature is not null")
    return numbered(known.distinct(), ["dept"], ["feature"])


def sparse_vectors(entries: DataFrame, people: DataFrame | None, places: DataFrame, out: str) -> DataFrame:
    """dept, std_no and ``out``: struct(size, positions, values), positions ascending from 1.

    ``entries`` has dept, std_no, feature, value; ``places`` dept, feature, position. A
    list holds one student's own entries, whatever the size of the department.
    Without ``people`` only students with entries get a row.
    """
    at = spread_join(entries, places, ["dept", "feature"], ["std_no"])
    return _lined_up(at.select("dept", "std_no", "position", "value"), people, places, out)


def _lined_up(at: DataFrame, people: DataFrame | None, places: DataFrame, out: str, first: int = 0) -> DataFrame:
    """``at`` has dept, std_no, position, value; ``first`` positions stand before those of ``places``."""
    pairs = F.array_sort(F.collect_list(F.struct("position", "value")))
    own = at.groupBy("dept", "std_no").agg(pairs.alias("_own"))
    sizes = places.groupBy("dept").agg((F.max("position") + first).alias("size"))
    rows = own if people is None else people.join(own, ["dept", "std_no"], "left")
    empty = F.array().cast("array<struct<position:bigint,value:double>>")
    filled = F.coalesce("_own", empty)
    return spread_join(rows, sizes, ["dept"], ["std_no"], "left").select(
        "dept",
        "std_no",
        F.struct(
            F.coalesce("size", F.lit(first)).cast("bigint").alias("size"),
            F.transform(filled, lambda e: e["position"]).alias("positions"),
            F.transform(filled, lambda e: e["value"]).alias("values"),
        ).alias(out),
    )


def course_vectors(domain: Domain | Facts, params: Params = Params(), three_state: bool = False):
    """dept, std_no, SUBJECT_STAR over the courses of the department."""
    places = positions(course_universe(domain).withColumnRenamed("course", "feature"))
    if three_state:
        return sparse_vectors(course_entries_three_state(domain, params), None, places, "SUBJECT_STAR")
    return sparse_vectors(course_entries(domain, params), members(domain), places, "SUBJECT_STAR")


def area_vectors(domain: Domain | Facts, params: Params = Params()) -> DataFrame:
    """dept, std_no, NCR_STAR over the areas seen in the department."""
    entries = facts_of(domain).keep_in_run(area_entries(domain, params), "areas")
    return sparse_vectors(entries, members(domain), positions(entries), "NCR_STAR")


def activity_vectors(domain: Domain | Facts, params: Params = Params()) -> DataFrame:
    """dept, std_no, ACTING_COUNT: three counts, then one flag per title."""
    entries = facts_of(domain).keep_in_run(activity_entries(domain, params), "activities")
    titles = entries.filter(F.col("kind") == TITLE)
    places = positions(titles)
    code = F.array_position(F.array(*[F.lit(c) for c in COUNT_CODES]), F.col("feature"))
    counts = entries.filter(F.col("kind") == CODE).select("dept", "std_no", code.alias("position"), "value")
    flags = spread_join(titles, places, ["dept", "feature"], ["std_no"]).select(
        "dept", "std_no", (F.col("position") + len(COUNT_CODES)).alias("position"), "value"
    )
    return _lined_up(counts.unionByName(flags), members(domain), places, "ACTING_COUNT", len(COUNT_CODES))


def took_vectors(domain: Domain | Facts) -> DataFrame:
    """dept, std_no, TOOK: value 1 at every completed course; all others mean 0."""
    places = positions(course_universe(domain).withColumnRenamed("course", "feature"))
    taken = facts_of(domain).taken.select(
        "dept", "std_no", F.col("course").alias("feature"), F.lit(1.0).alias("value")
    )
    return sparse_vectors(taken.distinct(), members(domain), places, "TOOK")


def feature_table(domain: Domain | Facts, params: Params = Params()) -> DataFrame:
    """dept, std_no and the three sparse vectors of every member."""
    return outer_join_all(
        [course_vectors(domain, params), area_vectors(domain, params), activity_vectors(domain, params)],
        ["dept", "std_no"],
    )


def dense(vector: str | Column, fill: float, counted: int = 0) -> Column:
    """The array of a sparse vector; the first ``counted`` positions are 0.0 where empty.

    For few rows: an array is as long as the department's list of features.
    """
    v = F.col(vector) if isinstance(vector, str) else vector
    own = F.map_from_arrays(v["positions"], v["values"])
    every = F.sequence(F.lit(1).cast("bigint"), v["size"])
    at = lambda p: F.coalesce(
        F.try_element_at(own, p), F.when(p <= counted, F.lit(0.0)).otherwise(F.lit(fill))
    )
    return F.when(v["size"] > 0, F.transform(every, at)).otherwise(F.array().cast("array<double>"))


def dense_features(vectors: DataFrame, users: DataFrame, params: Params = Params()) -> DataFrame:
    """The stored form of ``feature_table`` for asking students: three dense arrays."""
    asked = vectors.join(users.select("std_no").distinct(), "std_no", "left_semi")
    return asked.select(
        "dept",
        "std_no",
        dense("SUBJECT_STAR", params.fill).alias("SUBJECT_STAR"),
        dense("NCR_STAR", params.fill).alias("NCR_STAR"),
        dense("ACTING_COUNT", params.fill, len(COUNT_CODES)).cast("array<int>").alias("ACTING_COUNT"),
    )


def densify_courses(
    domain: Domain | Facts, users: DataFrame | None = None, params: Params = Params()
) -> DataFrame:
    """dept, std_no, course, value of every member, the fill value where there is no star.

    With ``users``, of these students only. A student's stars travel as one map of
    their own entries, so that the rows of student and course need no shuffle.
    """
    people, stars = members(domain), course_entries(domain, params)
    if users is not None:
        asked = users.select("std_no").distinct()
        people, stars = (df.join(asked, "std_no", "left_semi") for df in (people, stars))
    entries = F.map_from_entries(F.collect_list(F.struct("feature", "value")))
    own = stars.groupBy("dept", "std_no").agg(entries.alias("_own"))
    rows = people.join(own, ["dept", "std_no"], "left")
    return spread_join(rows, course_universe(domain), ["dept"], ["std_no"]).select(
        "dept",
        "std_no",
        "course",
        F.coalesce(F.try_element_at("_own", F.col("course")), F.lit(params.fill)).alias("value"),
    )
