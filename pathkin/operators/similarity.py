"""Cosine similarity of a query student with everybody in the department.

A vector is its real entries plus a constant fill ``f`` for the other
``U - n`` features of the department. With sums over shared features only,

    x.y  = S_xy + f(S_x - Sh_x) + f(S_y - Sh_y) + f^2 (U - n_x - n_y + n_shared)
    |x|2 = Q_x + f^2 (U - n_x)

so the work is one join of entries on (department, kind, feature) with the query
students' entries, and one row per (query student, member). Values are quantised
to whole numbers first, which makes every sum exact in any order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathkin.domain import Domain
from pathkin.functions.scalars import int_div, quantise
from pathkin.functions.vectors import cosine_from_sums
from pathkin.operators.features import (
    AREA,
    CODE,
    COURSE,
    KINDS,
    TITLE,
    all_entries,
    course_universe,
)
from pathkin.operators.facts import Facts, facts_of
from pathkin.operators.relational import spread_join
from pathkin.params import Params

# Whole-number scale of star entries and of activity entries.
STAR_SCALE = 10
ACTIVITY_SCALE = -100
ACTIVITY_KINDS = [CODE, TITLE]


def _fills(params: Params) -> dict[str, int]:
    return {
        COURSE: int(params.fill * STAR_SCALE),
        AREA: int(params.fill * STAR_SCALE),
        CODE: 0,
        TITLE: int(params.fill * ACTIVITY_SCALE),
    }


def quantised_entries(domain: Domain | Facts, params: Params = Params()) -> DataFrame:
    """dept, std_no, kind, feature, q."""
    scaled = F.when(
        F.col("kind").isin(ACTIVITY_KINDS), quantise(F.col("value"), ACTIVITY_SCALE)
    ).otherwise(quantise(F.col("value"), STAR_SCALE))
    return all_entries(domain, params).select(
        "dept", "std_no", "kind", "feature", scaled.alias("q")
    )


def universe_sizes(domain: Domain | Facts, entries: DataFrame) -> DataFrame:
    """dept, u_course, u_area, u_act_title, u_act_code: number of features per kind."""
    features = (
        course_universe(domain)
        .select("dept", F.lit(COURSE).alias("kind"), F.col("course").alias("feature"))
        .unionByName(
            entries.filter(F.col("kind").isin(AREA, TITLE)).select("dept", "kind", "feature")
        )
        .distinct()
    )
    return features.groupBy("dept").agg(
        *[F.count_if(F.col("kind") == k).alias(f"u_{k}") for k in (COURSE, AREA, TITLE)]
    ).withColumn(f"u_{CODE}", F.lit(3).cast("bigint"))


def _profiles(entries: DataFrame) -> DataFrame:
    """dept, std_no and per kind n_, s_, q_: entry count, sum, sum of squares."""
    sums = []
    for k in KINDS:
        hit = F.col("kind") == k
        sums += [
            F.count_if(hit).alias(f"n_{k}"),
            F.coalesce(F.sum(F.when(hit, F.col("q"))), F.lit(0)).alias(f"s_{k}"),
            F.coalesce(F.sum(F.when(hit, F.col("q") * F.col("q"))), F.lit(0)).alias(f"q_{k}"),
        ]
    return entries.groupBy("dept", "std_no").agg(*sums)


def _shared(entries: DataFrame, users: DataFrame) -> DataFrame:
    """Per (query_std, dept, std_no) and kind: sums over features both have."""
    entries = entries.filter(F.col("kind").isNotNull())
    mine = entries.join(users.select("std_no"), "std_no", "left_semi").select(
        "dept", "kind", "feature", F.col("std_no").alias("query_std"), F.col("q").alias("q0")
    )
    both = spread_join(entries, mine, ["dept", "kind", "feature"], ["std_no"])
    sums = []
    for k in KINDS:
        hit = F.col("kind") == k
        sums += [
            F.count_if(hit).alias(f"h_{k}"),
            F.sum(F.when(hit, F.col("q") * F.col("q0"))).alias(f"xy_{k}"),
            F.sum(F.when(hit, F.col("q0"))).alias(f"hx_{k}"),
            F.sum(F.when(hit, F.col("q"))).alias(f"hy_{k}"),
        ]
    return both.groupBy("query_std", "dept", "std_no").agg(*sums)


def _dot(k: str, f: int) -> Column:
    z = lambda name: F.coalesce(F.col(name), F.lit(0).cast("bigint"))
    open_features = (
        F.col(f"u_{k}") - F.col(f"x_n_{k}") - F.col(f"n_{k}") + z(f"h_{k}")
    )
    return (
        z(f"xy_{k}")
        + F.lit(f) * (F.col(f"x_s_{k}") - z(f"hx_{k}"))
        + F.lit(f) * (F.col(f"s_{k}") - z(f"hy_{k}"))
        + F.lit(f * f) * open_features
    )


def _squares(k: str, f: int, side: str) -> Column:
    return F.col(f"{side}q_{k}") + F.lit(f * f) * (F.col(f"u_{k}") - F.col(f"{side}n_{k}"))


def similarity(
    domain: Domain | Facts,
    users: DataFrame,
    params: Params = Params(),
    entries: DataFrame | None = None,
) -> DataFrame:
    """query_std, std_no, sbjt_, ncr_, acting_, concat_similarity and similarity.

    ``similarity`` is the weighted sum of the three; ``concat_similarity`` is one
    cosine over the vectors laid end to end. The query student is included.

    The entries are read four times, so they are written once to the shared folder
    (or passed in, if the caller has them already).
    """
    fills = _fills(params)
    if entries is None:
        entries = facts_of(domain).keep(quantised_entries(domain, params), "entries")
    profiles = _profiles(entries)
    query_side = (
        profiles.join(users.select("std_no"), "std_no", "left_semi")
        .withColumnsRenamed(
            {f"{s}_{k}": f"x_{s}_{k}" for k in KINDS for s in ("n", "s", "q")}
            | {"std_no": "query_std"}
        )
        .join(universe_sizes(domain, entries), "dept")
    )
    pairs = spread_join(profiles, query_side, ["dept"], ["std_no"])
    sums = pairs.join(_shared(entries, users), ["query_std", "dept", "std_no"], "left")

    total = lambda columns: reduce(lambda a, b: a + b, columns)
    dots = {k: _dot(k, fills[k]) for k in KINDS}
    xs = {k: _squares(k, fills[k], "x_") for k in KINDS}
    ys = {k: _squares(k, fills[k], "") for k in KINDS}
    act_dot = total(dots[k] for k in ACTIVITY_KINDS)
    act_x = total(xs[k] for k in ACTIVITY_KINDS)
    act_y = total(ys[k] for k in ACTIVITY_KINDS)
    # activity products carry the factor ACTIVITY_SCALE^2; the joined vector uses STAR_SCALE
    shrink = F.lit((ACTIVITY_SCALE // STAR_SCALE) ** 2).cast("bigint")
    share = F.lit(params.similarity_share)
    scored = sums.select(
        "query_std",
        "dept",
        "std_no",
        cosine_from_sums(dots[COURSE], xs[COURSE], ys[COURSE]).alias("sbjt_similarity"),
        cosine_from_sums(dots[AREA], xs[AREA], ys[AREA]).alias("ncr_similarity"),
        cosine_from_sums(act_dot, act_x, act_y).alias("acting_similarity"),
        cosine_from_sums(
            dots[COURSE] + dots[AREA] + int_div(act_dot, shrink),
            xs[COURSE] + xs[AREA] + int_div(act_x, shrink),
            ys[COURSE] + ys[AREA] + int_div(act_y, shrink),
        ).alias("concat_similarity"),
    )
    return scored.withColumn(
        "similarity",
        F.col("sbjt_similarity") * share
        + F.col("ncr_similarity") * share
        + F.col("acting_similarity") * share,
    )
