"""The closed form against dense vectors, and properties of the result."""

import math
import random

import pytest

from pathkin.operators import features as fe
from pathkin.operators import recommend as rc
from pathkin.operators import similarity as si
from pathkin.params import Params
from small import make, rows, users


@pytest.fixture(scope="module")
def domain(spark):
    rng = random.Random(17)
    people = [(f"s{i}", f"D{i % 3}") for i in range(36)]
    courses, ratings, acts, enrolments = [], [], [], []
    for who, dept in people:
        for c in rng.sample(range(12), rng.randint(1, 8)):
            courses.append((who, dept, f"{dept}c{c}"))
            if rng.random() < 0.7:
                ratings.append((who, f"{dept}c{c}", rng.randint(0, 50) / 10, "C"))
        for p in rng.sample(range(9), rng.randint(0, 5)):
            ratings.append((who, f"p{p}", rng.randint(0, 50) / 10, "N"))
            enrolments.append((who, f"e{p}", f"p{p}", "NCR_T07_P05" if p % 2 else "NCR_T07_P01"))
        for _ in range(rng.randint(0, 9)):
            acts.append((who, f"OAMTYPCD0{rng.randint(1, 5)}", f"t{rng.randint(0, 6)}"))
    return make(
        spark,
        students=[(w, d, "남성") for w, d in people],
        courses=courses,
        ratings=ratings,
        programmes=[(f"p{p}", f"area{p % 4}") for p in range(8)],
        enrolments=enrolments,
        activities=acts,
        graduates=[(w, d, "남", f"co{i % 5}") for i, (w, d) in enumerate(people)],
        company_ratings=[(f"co{i}", i + 1, i + 2) for i in range(4)],
        applications=[(f"a{i}", "t", f"s{i % 36}", "Y") for i in range(80)],
        postings=[(f"a{i}", f"co{i % 5}") for i in range(80)],
    )


def _cosine(x, y):
    norm = math.sqrt(sum(a * a for a in x)) * math.sqrt(sum(b * b for b in y))
    return sum(a * b for a, b in zip(x, y)) / norm if norm else 0.0


def _cut(v, scale):
    return [int(a * scale) for a in v]


@pytest.mark.parametrize("params", [Params(), Params(fill=0.0), Params(count_activity_rows=True)])
def test_closed_form_equals_dense(spark, domain, params):
    asking = users(spark, "s0", "s1", "s5", "s9")
    everybody = domain.students.select("std_no")
    dense = {r.std_no: r for r in fe.dense_features(fe.feature_table(domain, params), everybody, params).collect()}
    checked = 0
    for r in si.similarity(domain, asking, params).collect():
        x, y = dense[r.query_std], dense[r.std_no]
        assert x.dept == y.dept
        parts = [
            (r.sbjt_similarity, "SUBJECT_STAR", 10),
            (r.ncr_similarity, "NCR_STAR", 10),
            (r.acting_similarity, "ACTING_COUNT", -100),
        ]
        for got, column, scale in parts:
            assert got == pytest.approx(_cosine(_cut(x[column], scale), _cut(y[column], scale)))
        whole = [sum((_cut(v[c], 10) for _, c, _ in parts), []) for v in (x, y)]
        assert r.concat_similarity == pytest.approx(_cosine(*whole))
        assert r.similarity == pytest.approx(0.33 * sum(p[0] for p in parts))
        checked += 1
    assert checked == 4 * 12  # everybody of the department, the asking student too


def test_symmetric_and_one_with_oneself(spark, domain):
    asking = users(spark, *[f"s{i}" for i in range(36)])
    got = {(r.query_std, r.std_no): r.similarity for r in si.similarity(domain, asking).collect()}
    for (a, b), value in got.items():
        assert got[b, a] == pytest.approx(value)
        assert got[a, a] <= 0.99 + 1e-9


def test_recommendations_are_new_and_ranked_from_one(spark, domain):
    asking = users(spark, *[f"s{i}" for i in range(12)])
    people = rc.neighbours(domain, asking)
    assert all(r.std_no != r.query_std and 1 <= r.rank <= 10 for r in people.collect())
    ranked = rc.ranked_items(domain, people, asking).collect()
    taken = {(c.std_no, c.course) for c in domain.courses.collect()}
    assert ranked
    ranks = {}
    for r in ranked:
        if r.what == rc.COURSE:
            assert (r.query_std, r.item) not in taken
        ranks.setdefault((r.query_std, r.what), []).append(r["rank"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in ranks.values())
    table = rc.recommend(domain, asking)
    assert table.columns[:2] == ["query_std", "Rank"]
    assert table.groupBy("query_std", "Rank").count().filter("count > 1").count() == 0


def test_self_may_be_a_neighbour_on_request(spark, domain):
    asking = users(spark, "s3")
    people = rc.neighbours(domain, asking, Params(include_self=True))
    assert ("s3", "s3") in rows(people, "query_std", "std_no")


def test_a_run_gives_what_lazy_facts_give(spark, domain):
    from pathkin.operators.facts import gather
    from pathkin.session import Workspace

    asking = users(spark, *[f"s{i}" for i in range(0, 36, 5)])
    want = rows(rc.recommend(domain, asking), "query_std", "Rank", "SBJT_KEY_CD", "OAMTYPCD01")
    with Workspace(spark) as workspace:
        facts = gather(domain, workspace)
        got = rows(rc.recommend(facts, asking), "query_std", "Rank", "SBJT_KEY_CD", "OAMTYPCD01")
        stored = facts.taken.inputFiles()
    assert got == want and stored
    import os

    assert not os.path.exists(workspace.path)


def test_best_employers_are_the_best_of_all_pairs(spark, domain):
    from pathkin.operators import trust as tr
    from pyspark.sql import functions as F

    asking = users(spark, *[f"s{i}" for i in range(36)], *[f"none{i}" for i in range(100)])
    every = tr.company_trust(domain, asking).groupBy("query_std", "std_no").agg(F.max("company_trust").alias("company_trust"))
    columns = ["query_std", "std_no", "company_trust"]
    assert rows(tr.best_employers(domain, asking), *columns) == rows(every, *columns)


def test_facts_are_scanned_twice_at_most(spark, monkeypatch):
    from pathkin.plans import domain_queries
    from pathkin.session import Workspace

    plans = []

    def watched(write):
        def run(*args, **kw):
            df = next(a for a in args if hasattr(a, "_jdf"))
            plans.append(df._jdf.queryExecution().sparkPlan().toString())
            return write(*args, **kw)

        return run

    monkeypatch.setattr(Workspace, "stage", watched(Workspace.stage))
    monkeypatch.setattr(domain_queries, "stage", watched(domain_queries.stage))
    for name in ("rec_assembled", "eval_prf", "top_neighbours", "user_trust"):
        plans.clear()
        domain_queries.QUERIES[name](spark, "/root/testdata/sf0.001")
        for raw in ("lineitem", "orders", "events"):
            assert sum(p.count(f"/{raw}.parquet]") for p in plans) in (1, 2), (name, raw)
