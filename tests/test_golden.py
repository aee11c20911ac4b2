"""Worked examples with known answers."""

import pytest
from pyspark.sql import functions as F

from pathkin.functions.scalars import safe_int_ratio
from pathkin.operators import evaluate as ev
from pathkin.operators import features as fe
from pathkin.operators import interest as it
from pathkin.operators import recommend as rc
from pathkin.operators import trust as tr
from pathkin.params import Params
from small import make, rows, users

FIRST = [("P03_C01", 4.2), ("P01_C01", 4.5), ("P03_C03", 4.0), ("P04_C03", 3.8),
         ("P02_C03", 3.2), ("P02_C03", 4.5)]
SECOND = [("P01_C03", 2.9), ("P05_C02", 4.8), ("P04_C03", 4.7), ("P01_C01", 5.0), ("P03_C01", 3.9)]
THIRD = [("P01_C03", 3.6), ("P05_C02", 2.7), ("P04_C03", 4.0), ("P04_C07", 3.4), ("P01_C01", 4.1)]


def test_area_means(spark):
    ratings, infos = [], []
    for who, entries in [("s1", FIRST), ("s2", SECOND), ("s3", THIRD)]:
        for i, (area, star) in enumerate(entries):
            ratings.append((who, f"{who}-{i}", star, "N"))
            infos.append((f"{who}-{i}", area))
    ratings.append(("s1", "no info", 1.0, "N"))
    ratings.append(("s1", "s1-0", 1.0, "C"))  # a course star is no programme star
    courses = [(s, "D", "c") for s in ("s1", "s2", "s3")]
    domain = make(spark, ratings=ratings, programmes=infos, courses=courses)
    got = {(r.std_no, r.feature): r.value for r in fe.area_entries(domain).collect()}
    for who, entries in [("s2", SECOND), ("s3", THIRD)]:
        for area, star in entries:
            assert got[who, area] == pytest.approx(star)
    assert got["s1", "P02_C03"] == pytest.approx(3.85)
    assert got["s1", fe.UNKNOWN_AREA] == 1.0
    known = fe.area_entries(domain, Params(drop_unknown_area=True))
    assert known.filter(F.col("feature") == fe.UNKNOWN_AREA).count() == 0


def _three_students(spark):
    taken = {"ga": "ab", "na": "c", "da": "abc", "ra": "de"}
    stars = {("ga", "a"): 4.0, ("ga", "b"): 3.0, ("na", "c"): 3.0,
             ("da", "a"): 2.0, ("da", "b"): 7.0, ("da", "c"): 5.0}
    return make(
        spark,
        courses=[(s, "D", c) for s, cs in taken.items() for c in cs],
        ratings=[(s, c, v, "C") for (s, c), v in stars.items()] + [("ga", "zz", 5.0, "C")],
    )


def _dense(vectors, column, fill=-1.0, counted=0):
    return {r.std_no: r.v for r in vectors.select("std_no", fe.dense(column, fill, counted).alias("v")).collect()}


def test_course_vectors(spark):
    vectors = fe.course_vectors(_three_students(spark))
    own = {r.std_no: r.SUBJECT_STAR for r in vectors.collect()}
    assert own["na"].asDict() == {"size": 5, "positions": [3], "values": [3.0]}
    assert own["ra"].asDict() == {"size": 5, "positions": [], "values": []}
    got = _dense(vectors, "SUBJECT_STAR")
    assert got == {
        "ga": [4.0, 3.0, -1.0, -1.0, -1.0],
        "na": [-1.0, -1.0, 3.0, -1.0, -1.0],
        "da": [2.0, 7.0, 5.0, -1.0, -1.0],
        "ra": [-1.0] * 5,
    }


def test_three_state_vectors_leave_out_students_without_stars(spark):
    domain = make(
        spark,
        courses=[("a", "D", "x"), ("a", "D", "y"), ("b", "D", "z")],
        ratings=[("a", "x", 4.0, "C")],
    )
    got = _dense(fe.course_vectors(domain, three_state=True), "SUBJECT_STAR", 0.0)
    assert got == {"a": [4.0, -1.0, 0.0]}


def test_repeated_star_mean_or_max(spark):
    domain = make(spark, courses=[("a", "D", "x")], ratings=[("a", "x", 2.0, "C"), ("a", "x", 5.0, "C")])
    assert rows(fe.course_entries(domain), "value") == [(3.5,)]
    assert rows(fe.course_entries(domain, Params(duplicate_star="max")), "value") == [(5.0,)]


def test_activity_vector_counts_distinct_rows_unless_told_otherwise(spark):
    acts = [("a", "OAMTYPCD03", "t"), ("a", "OAMTYPCD03", "t"), ("a", "OAMTYPCD05", "u"),
            ("a", "OAMTYPCD01", "x"), ("b", "OAMTYPCD02", "y")]
    domain = make(spark, courses=[("a", "D", "c"), ("b", "D", "c")], activities=acts)
    got = _dense(fe.activity_vectors(domain), "ACTING_COUNT", -1.0, 3)
    assert got == {"a": [1, 0, 1, 1, -1], "b": [0, 0, 0, -1, 1]}
    every = fe.activity_vectors(domain, Params(count_activity_rows=True))
    assert _dense(every, "ACTING_COUNT", -1.0, 3)["a"][0] == 2


def test_took_vectors_and_dense_features_of_asking_students(spark):
    domain = _three_students(spark)
    took = {r.std_no: r.TOOK for r in fe.took_vectors(domain).collect()}
    assert took["ra"].asDict() == {"size": 5, "positions": [4, 5], "values": [1.0, 1.0]}
    dense = fe.dense_features(fe.feature_table(domain), users(spark, "ga", "nobody")).collect()
    assert [(r.std_no, r.SUBJECT_STAR, r.NCR_STAR, r.ACTING_COUNT) for r in dense] == [
        ("ga", [4.0, 3.0, -1.0, -1.0, -1.0], [], [0, 0, 0])
    ]
    every = fe.densify_courses(domain, users(spark, "na"))
    assert rows(every, "std_no", "course", "value") == [("na", c, 3.0 if c == "c" else -1.0) for c in "abcde"]


def test_hit_metrics(spark):
    recommended = spark.createDataFrame([("q", x) for x in "abcde"], "query_std string, item string")
    truth = spark.createDataFrame([("q", x) for x in "abcfghijkl"] + [("r", "z")],
                                  "query_std string, item string")
    got = {r.query_std: r for r in ev.hit_metrics(recommended, truth).collect()}
    assert got["q"].ref_precision == pytest.approx(0.3)
    assert got["q"].ref_recall == pytest.approx(0.6)
    assert got["q"].f_measure == pytest.approx(0.4)
    assert (got["q"].precision, got["q"].recall) == (got["q"].ref_recall, got["q"].ref_precision)
    assert got["r"].f_measure == 0.0


def test_company_trust_values(spark):
    pairs = spark.createDataFrame([("best",), ("least",), ("unrated",)], "company string")
    ratings = spark.createDataFrame([("best", 5, 8), ("least", 1, 2)],
                                    "company string, w_company int, w_headcount int")
    got = dict(rows(tr.rate_employers(pairs, ratings), "company", "company_trust"))
    assert got == {"best": 1.0, "least": pytest.approx(0.225), "unrated": 0.0}


def _interest(spark, applied, searched):
    return make(
        spark,
        students=[("u", "D", "남성")],
        graduates=[("g1", "D", "남", "G"), ("g2", "D", "여", "H"), ("g3", "E", "남", "I")],
        applications=[(f"p{i}", "t", "u", "Y") for i in range(applied)] + [("pn", "t", "u", "N")],
        postings=[(f"p{i}", f"A{i}") for i in range(applied)] + [("pn", "never sent")],
        searches=[(f"s{i}", "u", "t", f"S{i}") for i in range(searched)],
    )


@pytest.mark.parametrize(
    "applied,searched,sources",
    [(10, 3, {1: 10}), (4, 6, {1: 4, 2: 6}), (4, 5, {1: 4, 2: 5, 3: 1}), (0, 0, {3: 1})],
)
def test_cascade(spark, applied, searched, sources):
    domain = _interest(spark, applied, searched)
    got = it.interest_cascade(domain, users(spark, "u")).groupBy("source").count()
    assert dict(rows(got, "source", "count")) == sources


def test_cascade_counts_a_company_in_both_lists_twice_but_keeps_it_once(spark):
    domain = make(
        spark,
        students=[("u", "D", "여성")],
        applications=[(f"p{i}", "t", "u", "Y") for i in range(5)],
        postings=[(f"p{i}", f"A{i}") for i in range(5)],
        searches=[(f"s{i}", "u", "t", f"A{i}") for i in range(5)],
        graduates=[("g", "D", "여", "G")],
    )
    got = rows(it.interest_cascade(domain, users(spark, "u")), "company", "source")
    assert got == [(f"A{i}", 1) for i in range(5)]


def test_unknown_student_gives_nothing(spark):
    domain = _interest(spark, 3, 3)
    assert it.interest_bundle(domain, users(spark, "nobody")).count() == 0
    assert fe.cohort(domain, users(spark, "nobody")).count() == 0


def test_safe_ratio(spark):
    df = spark.createDataFrame([(3, 0), (3, 2), (0, 4)], "a bigint, b bigint")
    got = df.select("a", "b", safe_int_ratio(F.col("a"), F.col("b")).alias("r"))
    assert rows(got, "a", "b", "r") == [(0, 4, 0), (3, 0, 3), (3, 2, 1)]


def test_trust_per_person_or_per_employer(spark):
    domain = make(
        spark,
        students=[("u", "D", "남성"), ("g", "D", "남성")],
        applications=[(f"p{i}", "t", "u", "Y") for i in range(10)],
        postings=[(f"p{i}", f"A{i}") for i in range(10)],
        graduates=[("g", "D", "남", "A0"), ("g", "D", "남", "A1"), ("x", "D", "남", "A1")],
        company_ratings=[("A0", 5, 8), ("A1", 1, 2)],
        ratings=[("g", "c", 1.0, "C")] * 3,
    )
    asking = users(spark, "u")
    one = rows(tr.user_trust(domain, asking), "query_std", "std_no", "trust")
    assert one == [("u", "g", 0.5 * 1.0 + 0.5 * 3.0)]  # x is not on the register
    each = tr.user_trust(domain, asking, Params(trust_agg="none"))
    assert [r[0] for r in rows(each, "company")] == ["A0", "A1"]


def test_exclusion_modes(spark):
    domain = make(spark, courses=[("q", "D", "A"), ("n1", "D", "A"), ("n2", "D", "A"), ("n2", "D", "B")])
    people = spark.createDataFrame([("q", "n1", 2), ("q", "n2", 2)],
                                   "query_std string, std_no string, k bigint")
    asking = users(spark, "q")
    anti = rc.ranked_items(domain, people, asking)
    assert rows(anti, "item", "n", "rank") == [("B", 1, 1)]
    bag = rc.ranked_items(domain, people, asking, Params(exclude="multiset"))
    assert rows(bag, "item", "n", "rank") == [("A", 1, 1), ("B", 1, 2)]
