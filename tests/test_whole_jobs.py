"""Whole cohorts, and employers met without shuffling the multiplied rows."""

import re

import pytest
from pyspark.sql import functions as F

from pathkin import Params
from pathkin.operators import features as fe
from pathkin.operators import recommend as rc
from pathkin.operators import trust as tr
from pathkin.plans import testdata
from small import make, rows, users


@pytest.fixture(scope="module")
def domain(spark):
    people = [f"s{i:02d}" for i in range(12)]
    return make(
        spark,
        students=[(p, "d", "남성") for p in people],
        courses=[(p, "d", "abc"[i % 3]) for i, p in enumerate(people)],
        ratings=[(p, "abc"[i % 3], 1.0 + i % 4, "C") for i, p in enumerate(people)],
        # repeated pairs, and a graduate of one company only
        graduates=[(p, "d", "남", f"c{j}") for i, p in enumerate(people) for j in range(1 + i % 4)] * 2,
        company_ratings=[("c0", 1, 2), ("c1", 5, 4), ("c2", 5, 4)],
        applications=[("x", "2020", "s00", "Y"), ("y", "2020", "s01", "Y")],
        postings=[("x", "c2"), ("y", "c9")],
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_member_meets_every_course(domain):
    found = fe.densify_courses(domain)
    stars = {f"s{i:02d}": ("abc"[i % 3], 1.0 + i % 4) for i in range(12)}
    assert rows(found, "std_no", "course", "value") == sorted(
        (p, c, star if c == mine else -1.0) for p, (mine, star) in stars.items() for c in "abc"
    )


def test_company_trust_needs_no_shuffle_by_graduate(spark, domain):
    found = tr.company_trust(domain, users(spark, "s00", "s01"))
    score = {"c0": 0.225, "c1": 0.75, "c2": 0.75, "c3": 0.0}
    assert [(q, p, c, round(t, 6)) for q, p, c, t in rows(found, "query_std", "std_no", "company", "company_trust")] == sorted(
        (q, f"s{i:02d}", f"c{j}", score[f"c{j}"]) for q in ("s00", "s01") for i in range(12) for j in range(1 + i % 4)
    )
    grouped = found.groupBy("query_std", "std_no").agg(F.max("company_trust"))
    assert not re.search(r"hashpartitioning\(query_std#\d+, std_no#", plan(grouped))


def test_first_run_ranks_as_over_all_rows(spark, domain, monkeypatch):
    params = Params.as_first_run().with_(neighbours=5)
    asking = users(spark, "s00", "s01")
    similar = rc.similarity(domain, asking, params)
    want = rc.nearest(rc.blend(rc.user_trust(domain, asking, params), similar, params), params)
    columns = ["query_std", "rank", "std_no", "score", "k"]
    blended, plain = [], rc.blend

    def counted(trust, *others):
        if "company" in trust.columns:
            blended.append((trust.count(), trust.select("query_std", "std_no").distinct().count()))
        return plain(trust, *others)

    monkeypatch.setattr(rc, "blend", counted)
    got = rc.neighbours(domain, asking, params)
    # rows by employer of five people at most for either query student, not of all twelve
    assert len(blended) == 1 and blended[0][1] <= 10
    assert rows(got, *columns) == rows(want, *columns)
    # several rows of one person are among the first
    assert len({r[2] for r in rows(got, *columns)}) < len(rows(got, *columns))


def test_lines_are_not_sorted_to_meet_their_orders(spark, tmp_path):
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        made = spark.range(6).select(F.col("id").alias(key))
        for field in spark.createDataFrame([], testdata.TABLES[name]).schema:
            if field.name != key:
                made = made.withColumn(field.name, F.lit(None).cast(field.dataType))
        made.write.parquet(str(tmp_path / f"{name}.parquet"))
    lines = testdata._lines(spark, str(tmp_path))
    assert "ShuffledHashJoin" in plan(lines) and "Sort " not in plan(lines)
    assert lines.count() == 6
