"""The same queries in SQL, over the whole given tables, for side-by-side checks.

Similarities are computed here the long way, over dense vectors, so the closed
form used on Spark is checked against an independent calculation.
"""

from __future__ import annotations

import re

# Views in dependency order; a query gets those it names, directly or not.
VIEWS: dict[str, str] = {
    "students": """
        SELECT CAST(c_custkey AS VARCHAR) AS std_no, CAST(c_nationkey AS VARCHAR) AS dept,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '남성' ELSE '여성' END AS gender
        FROM customer""",
    "lines": """
        SELECT CAST(o_custkey AS VARCHAR) AS std_no, o_custkey, o_orderstatus, l_orderkey, l_partkey,
               l_suppkey, l_quantity, l_returnflag
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "courses": """
        SELECT std_no, CAST(c_nationkey AS VARCHAR) AS dept, CAST(l_partkey % 100 AS VARCHAR) AS course
        FROM lines JOIN customer ON o_custkey = c_custkey""",
    "ratings": """
        SELECT std_no, CAST(l_partkey % 100 AS VARCHAR) AS item, l_quantity / 1e1 AS star,
               CAST(floor(l_quantity / 1e1 * 10000 + 5e-1) AS BIGINT) AS units,
               CASE WHEN l_returnflag IN ('A', 'R') THEN 'C' ELSE 'N' END AS kind
        FROM lines""",
    "programmes": """
        SELECT CAST(p_partkey % 100 AS VARCHAR) AS programme, min(p_brand) AS area
        FROM part GROUP BY 1""",
    "enrolments": """
        SELECT std_no, CAST(l_orderkey AS VARCHAR) AS enrol_id,
               CAST(l_partkey % 100 AS VARCHAR) AS programme,
               CASE WHEN o_orderstatus = 'F' THEN 'NCR_T07_P05' ELSE 'NCR_T07_P01' END AS state
        FROM lines""",
    "activities": """
        SELECT CAST(user_id AS VARCHAR) AS std_no,
               CASE event_type WHEN 'click' THEN 'OAMTYPCD01' WHEN 'view' THEN 'OAMTYPCD02'
                    WHEN 'signup' THEN 'OAMTYPCD03' WHEN 'purchase' THEN 'OAMTYPCD04'
                    WHEN 'error' THEN 'OAMTYPCD05' END AS act_type,
               json_extract_string(props, '$.k') AS title
        FROM events""",
    "graduates": """
        SELECT std_no, CAST(c_nationkey AS VARCHAR) AS dept,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '남' ELSE '여' END AS gender,
               CAST(l_suppkey AS VARCHAR) AS company
        FROM lines JOIN customer ON o_custkey = c_custkey""",
    "company_ratings": """
        SELECT CAST(s_suppkey AS VARCHAR) AS company, CAST(s_suppkey % 5 + 1 AS INTEGER) AS w_company,
               CAST(s_suppkey % 7 + 2 AS INTEGER) AS w_headcount
        FROM supplier WHERE s_suppkey % 10 <> 0""",
    "applications": """
        SELECT CAST(o_orderkey AS VARCHAR) AS posting_id, o_orderdate AS reg_date,
               CAST(o_custkey AS VARCHAR) AS std_no,
               CASE WHEN o_orderpriority < '3' THEN 'Y' ELSE 'N' END AS applied
        FROM orders""",
    "postings": """
        SELECT CAST(l_orderkey AS VARCHAR) AS posting_id, CAST(min(l_suppkey) AS VARCHAR) AS company
        FROM lineitem GROUP BY l_orderkey""",
    "searches": """
        SELECT CAST(event_id AS VARCHAR) AS search_id, CAST(user_id AS VARCHAR) AS std_no,
               ts AS reg_date, CAST(event_id % 100 AS VARCHAR) AS company
        FROM events WHERE event_type IN ('view', 'click')""",
    "asking": "SELECT min(std_no) AS std_no FROM students GROUP BY dept",
    # interest
    "sent": """
        SELECT std_no, reg_date, company FROM applications JOIN postings USING (posting_id)
        WHERE applied = 'Y'""",
    "same_group": """
        SELECT DISTINCT s.std_no, g.company
        FROM students s JOIN asking USING (std_no)
        JOIN graduates g ON g.dept = s.dept
            AND g.gender = CASE WHEN s.gender = '남성' THEN '남' ELSE '여' END""",
    "bundle": """
        SELECT DISTINCT std_no, company, 1 AS source FROM sent JOIN asking USING (std_no)
        UNION ALL SELECT DISTINCT std_no, company, 2 FROM searches JOIN asking USING (std_no)
        UNION ALL SELECT std_no, company, 3 FROM same_group""",
    "levels": """
        SELECT a.std_no,
               CASE WHEN count(*) FILTER (source = 1) >= 10 THEN 1
                    WHEN count(*) FILTER (source IN (1, 2)) >= 10 THEN 2 ELSE 3 END AS lvl
        FROM asking a LEFT JOIN bundle USING (std_no) GROUP BY a.std_no""",
    "chosen": """
        SELECT std_no, company, min(source) AS source
        FROM bundle JOIN levels USING (std_no) WHERE source <= lvl GROUP BY std_no, company""",
    # trust
    "grads": "SELECT DISTINCT std_no, company FROM graduates",
    "company_scores": """
        SELECT g.std_no, g.company,
               coalesce(w_company * 5e-1 * 2e-1 + w_headcount * 5e-1 * 125e-3, 0e0) AS company_trust
        FROM grads g LEFT JOIN company_ratings USING (company)""",
    "stars": """
        SELECT item, sum(units) / (count(*) * 1e4) AS star FROM ratings GROUP BY item""",
    "act_counts": """
        SELECT s.std_no, coalesce(r.n, 0) AS stars,
               coalesce(c.n, 0) + coalesce(e.n, 0) + coalesce(a.n, 0) AS done
        FROM students s
        LEFT JOIN (SELECT std_no, count(*) AS n FROM ratings GROUP BY 1) r USING (std_no)
        LEFT JOIN (SELECT std_no, count(*) AS n FROM courses GROUP BY 1) c USING (std_no)
        LEFT JOIN (SELECT std_no, count(*) AS n FROM enrolments GROUP BY 1) e USING (std_no)
        LEFT JOIN (SELECT std_no, count(*) AS n FROM activities GROUP BY 1) a USING (std_no)""",
    "asked_trust": """
        SELECT c.std_no AS query_std, g.std_no, g.company, g.company_trust
        FROM chosen c JOIN company_scores g USING (company)""",
    "best_trust": """
        SELECT query_std, std_no, max(company_trust) AS company_trust
        FROM asked_trust GROUP BY 1, 2""",
    "trust": """
        SELECT query_std, std_no,
               5e-1 * company_trust + 5e-1 * CAST(stars // greatest(done, 1) AS DOUBLE) AS trust
        FROM best_trust JOIN act_counts USING (std_no)""",
    # features
    "taken": "SELECT DISTINCT std_no, dept, course FROM courses",
    "members": "SELECT DISTINCT dept, std_no FROM courses",
    "universe": "SELECT DISTINCT dept, course FROM courses",
    "course_stars": """
        SELECT m.dept, r.std_no, r.item AS feature, sum(units) / (count(*) * 1e4) AS value
        FROM ratings r JOIN members m USING (std_no)
        JOIN universe u ON u.dept = m.dept AND u.course = r.item
        WHERE r.kind = 'C' GROUP BY ALL""",
    "area_stars": """
        SELECT m.dept, r.std_no, coalesce(p.area, '__unknown__') AS feature,
               sum(units) / (count(*) * 1e4) AS value
        FROM ratings r JOIN members m USING (std_no) LEFT JOIN programmes p ON p.programme = r.item
        WHERE r.kind = 'N' GROUP BY ALL""",
    "acts": """
        SELECT DISTINCT m.dept, a.std_no, a.act_type, a.title
        FROM activities a JOIN members m USING (std_no)""",
    "act_codes": """
        SELECT dept, std_no, act_type AS feature, CAST(count(*) AS DOUBLE) AS value FROM acts
        WHERE act_type IN ('OAMTYPCD03', 'OAMTYPCD04', 'OAMTYPCD05') GROUP BY ALL""",
    "act_titles": """
        SELECT DISTINCT dept, std_no, title AS feature, 1e0 AS value FROM acts
        WHERE act_type IN ('OAMTYPCD01', 'OAMTYPCD02')""",
    "entries": """
        SELECT 'course' AS kind, *, CAST(trunc(value * 10) AS BIGINT) AS q FROM course_stars
        UNION ALL SELECT 'area', *, CAST(trunc(value * 10) AS BIGINT) FROM area_stars
        UNION ALL SELECT 'act_code', *, CAST(trunc(value * -100) AS BIGINT) FROM act_codes
        UNION ALL SELECT 'act_title', *, CAST(trunc(value * -100) AS BIGINT) FROM act_titles""",
    "slots": """
        SELECT dept, 'course' AS kind, course AS feature, -10 AS fill FROM universe
        UNION ALL SELECT DISTINCT dept, 'area', feature, -10 FROM area_stars
        UNION ALL SELECT DISTINCT dept, 'act_title', feature, 100 FROM act_titles
        UNION ALL SELECT dept, 'act_code', code, 0
            FROM (SELECT DISTINCT dept FROM members),
                 (SELECT unnest(['OAMTYPCD03', 'OAMTYPCD04', 'OAMTYPCD05']) AS code)""",
    "dense": """
        SELECT s.dept, m.std_no, s.kind, s.feature, coalesce(e.q, s.fill) AS q
        FROM slots s JOIN members m USING (dept)
        LEFT JOIN entries e USING (dept, std_no, kind, feature)""",
    "places": """
        SELECT *, row_number() OVER (PARTITION BY dept, part ORDER BY kind, feature) AS position,
               count(*) OVER (PARTITION BY dept, part) AS size
        FROM (SELECT dept, kind, feature, CASE WHEN kind LIKE 'act%' THEN 'act' ELSE kind END AS part FROM slots)""",
    "placed": """
        SELECT m.dept, m.std_no, p.part, p.position, p.size, e.q
        FROM members m JOIN places p USING (dept)
        LEFT JOIN entries e ON e.dept = m.dept AND e.std_no = m.std_no AND e.kind = p.kind AND e.feature = p.feature""",
    "products": """
        SELECT x.std_no AS query_std, y.dept, y.std_no,
               CASE WHEN y.kind LIKE 'act%' THEN 'act' ELSE y.kind END AS part,
               CAST(sum(x.q * y.q) AS DOUBLE) AS xy, CAST(sum(x.q * x.q) AS DOUBLE) AS xx,
               CAST(sum(y.q * y.q) AS DOUBLE) AS yy
        FROM dense x JOIN asking a ON a.std_no = x.std_no JOIN dense y USING (dept, kind, feature)
        GROUP BY ALL""",
    "cosines": """
        SELECT query_std, dept, std_no,
               coalesce(max(xy / nullif(sqrt(xx) * sqrt(yy), 0)) FILTER (part = 'course'), 0e0) AS s,
               coalesce(max(xy / nullif(sqrt(xx) * sqrt(yy), 0)) FILTER (part = 'area'), 0e0) AS n,
               coalesce(max(xy / nullif(sqrt(xx) * sqrt(yy), 0)) FILTER (part = 'act'), 0e0) AS a,
               sum(CASE part WHEN 'act' THEN xy / 100 ELSE xy END) AS xy,
               sum(CASE part WHEN 'act' THEN xx / 100 ELSE xx END) AS xx,
               sum(CASE part WHEN 'act' THEN yy / 100 ELSE yy END) AS yy
        FROM products GROUP BY 1, 2, 3""",
    "likeness": """
        SELECT query_std, dept, std_no, s, n, a, s * 33e-2 + n * 33e-2 + a * 33e-2 AS similarity,
               coalesce(xy / nullif(sqrt(xx) * sqrt(yy), 0), 0e0) AS concat_similarity
        FROM cosines""",
    # recommendation
    "blended": """
        SELECT query_std, std_no, coalesce(similarity, 0e0) AS similarity,
               coalesce(trust, 0e0) AS trust,
               coalesce(similarity, 0e0) * 5e-1 + coalesce(trust, 0e0) * 5e-1 AS score
        FROM trust FULL JOIN (SELECT query_std, std_no, similarity FROM likeness)
        USING (query_std, std_no)""",
    "near": """
        SELECT query_std, std_no, score, rank, count(*) OVER (PARTITION BY query_std) AS k
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_std ORDER BY score DESC, std_no) AS INTEGER) AS rank
              FROM blended WHERE query_std <> std_no) WHERE rank <= 10""",
    "near_self": """
        SELECT query_std, std_no, score, rank, count(*) OVER (PARTITION BY query_std) AS k
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_std ORDER BY score DESC, std_no) AS INTEGER) AS rank
              FROM blended) WHERE rank <= 10""",
    "employer_trust": """
        SELECT query_std, std_no, company,
               5e-1 * company_trust + 5e-1 * CAST(stars // greatest(done, 1) AS DOUBLE) AS trust
        FROM asked_trust JOIN act_counts USING (std_no)""",
    "near_first": """
        SELECT query_std, std_no, rank, count(*) OVER (PARTITION BY query_std) AS k
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_std
                                           ORDER BY score DESC, std_no, company NULLS FIRST) AS INTEGER) AS rank
              FROM (SELECT query_std, std_no, company,
                           coalesce(similarity, 0e0) * 5e-1 + coalesce(trust, 0e0) * 5e-1 AS score
                    FROM employer_trust FULL JOIN likeness USING (query_std, std_no)))
        WHERE rank <= 10""",
    "done": """
        SELECT std_no, 'course' AS what, course AS item FROM taken
        UNION ALL SELECT std_no, 'programme', programme
            FROM (SELECT DISTINCT * FROM enrolments) WHERE state = 'NCR_T07_P05'""",
    "own": """
        SELECT DISTINCT std_no AS query_std, 'course' AS what, course AS item FROM courses
        UNION ALL SELECT DISTINCT std_no, 'programme', programme FROM enrolments""",
    "doings": """
        SELECT * FROM done
        UNION ALL SELECT std_no, act_type,
            CASE WHEN act_type IN ('OAMTYPCD01', 'OAMTYPCD02') THEN title ELSE act_type END
        FROM activities""",
    "counts": """
        SELECT query_std, what, item, count(*) AS n, max(k) AS k
        FROM near JOIN doings USING (std_no) GROUP BY ALL""",
    "ranked": """
        SELECT * FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_std, what ORDER BY score DESC, item) AS INTEGER) AS rank
            FROM (SELECT c.query_std, c.what, c.item, c.n, c.k,
                         c.n * CASE WHEN c.what IN ('course', 'programme') THEN coalesce(s.star, 1e0)
                               ELSE 1e0 END AS score
                  FROM counts c LEFT JOIN stars s USING (item)
                  WHERE NOT EXISTS (SELECT 1 FROM own o WHERE o.query_std = c.query_std
                                    AND o.what = c.what AND o.item = c.item)))
        WHERE rank <= 10""",
    "ranked_self": """
        SELECT *, CAST(row_number() OVER (PARTITION BY query_std, what ORDER BY score DESC, item) AS INTEGER) AS rank
        FROM (SELECT c.query_std, c.what, c.item, c.left_over AS n,
                     c.left_over * coalesce(s.star, 1e0) AS score
              FROM (SELECT query_std, what, item,
                           count(*) - max(CASE WHEN o.item IS NULL THEN 0 ELSE 1 END) AS left_over
                    FROM near_self JOIN doings USING (std_no)
                    LEFT JOIN own o USING (query_std, what, item)
                    WHERE what = 'course' GROUP BY ALL) c
              LEFT JOIN stars s USING (item) WHERE c.left_over > 0)""",
    "ranked_first": """
        SELECT *, CAST(row_number() OVER (PARTITION BY query_std, what ORDER BY score DESC, item) AS INTEGER) AS rank
        FROM (SELECT c.query_std, c.what, c.item, c.left_over AS n, c.k,
                     c.left_over * CASE WHEN c.what IN ('course', 'programme')
                                   THEN coalesce(s.star, 1e0) ELSE 1e0 END AS score
              FROM (SELECT query_std, what, item, max(k) AS k,
                           count(*) - max(CASE WHEN o.item IS NULL THEN 0 ELSE 1 END) AS left_over
                    FROM near_first JOIN doings USING (std_no)
                    LEFT JOIN own o USING (query_std, what, item) GROUP BY ALL) c
              LEFT JOIN stars s USING (item) WHERE c.left_over > 0)""",
    # evaluation
    "popular": """
        SELECT * FROM (SELECT dept, course AS item, count(*) AS n,
                              CAST(row_number() OVER (PARTITION BY dept ORDER BY count(*) DESC, course) AS INTEGER) AS rank
                       FROM taken GROUP BY dept, course) WHERE rank <= 30""",
    "docs": """
        SELECT quality AS label, toxic AS prediction, n_chars
        FROM labels JOIN documents USING (doc_id)""",
    "cells": "SELECT label, prediction, count(*) AS n FROM docs GROUP BY ALL",
    "per_label": """
        SELECT label, actual, tp, total, coalesce(tp / nullif(predicted, 0), 0e0) AS precision,
               coalesce(tp / nullif(actual, 0), 0e0) AS recall,
               coalesce((predicted - tp) / nullif(total - actual, 0), 0e0) AS fpr
        FROM (SELECT l.label, CAST(count(*) FILTER (d.label = l.label) AS DOUBLE) AS actual,
                     CAST(count(*) FILTER (d.prediction = l.label) AS DOUBLE) AS predicted,
                     CAST(count(*) FILTER (d.label = l.label AND d.prediction = l.label) AS DOUBLE) AS tp,
                     CAST(count(*) AS DOUBLE) AS total
              FROM docs d, (SELECT label FROM docs UNION SELECT prediction FROM docs) l GROUP BY l.label)""",
    "label_scores": """
        SELECT *, coalesce(2e0 * precision * recall / nullif(precision + recall, 0), 0e0) AS f1
        FROM per_label""",
    "curve": """
        SELECT *, tp / (tp + fp) AS precision, tp / p AS recall, fp / n AS fpr
        FROM (SELECT n_chars AS score, count(*) FILTER (label = 1) AS pos,
                     count(*) FILTER (label <> 1) AS neg,
                     CAST(sum(count(*) FILTER (label = 1)) OVER w AS DOUBLE) AS tp,
                     CAST(sum(count(*) FILTER (label <> 1)) OVER w AS DOUBLE) AS fp,
                     CAST(sum(count(*) FILTER (label = 1)) OVER () AS DOUBLE) AS p,
                     CAST(sum(count(*) FILTER (label <> 1)) OVER () AS DOUBLE) AS n
              FROM docs GROUP BY n_chars WINDOW w AS (ORDER BY n_chars DESC))""",
}


def _ranked(view: str, where: str) -> str:
    return f"""SELECT query_std, what, item, n, round(score, 6) AS score, rank FROM {view}
               WHERE rank <= 10 AND {where}"""


def _assembled(view: str) -> str:
    columns = []
    for what, name in [("course", "SBJT_KEY_CD"), ("programme", "NPI_KEY_ID"),
                       ("OAMTYPCD01", "OAMTYPCD01"), ("OAMTYPCD02", "OAMTYPCD02")]:
        columns.append(f"max(item) FILTER (what = '{what}') AS {name}")
    for code in ("OAMTYPCD03", "OAMTYPCD04", "OAMTYPCD05"):
        columns.append(f"max(n // k) FILTER (what = '{code}') AS {code}_AVG")
    return f"""SELECT query_std, rank AS "Rank", {", ".join(columns)} FROM {view}
               WHERE rank <= 10 GROUP BY query_std, rank"""


def _vector(kinds: str, scale: int) -> str:
    """Dense vector of a student as text, features in text order."""
    return f"""string_agg(CAST(q // {scale} AS VARCHAR), ',' ORDER BY feature) FILTER (kind IN ({kinds}))"""


_COUNTS = "string_agg(CAST(q // -100 AS VARCHAR), ',' ORDER BY feature) FILTER (kind = 'act_code')"
_FLAGS = "string_agg(CAST(q // -100 AS VARCHAR), ',' ORDER BY feature) FILTER (kind = 'act_title')"
_ACTING = f"concat_ws(',', {_COUNTS}, {_FLAGS})"


def _sparse(part: str, scale: int = 1) -> str:
    """A student's own entries as text: size, then position and whole value of each."""
    own = f"part = '{part}' AND q IS NOT NULL"
    return f"""max(CASE WHEN part = '{part}' THEN size ELSE {3 if part == "act" else 0} END) || '|' || coalesce(string_agg(
                   position || ':' || (q // {scale}), ',' ORDER BY position) FILTER ({own}), '')"""


def _fold(text: str) -> str:
    """The fold of a key given as text, as in ``learn.fold`` with its defaults."""
    return f"(CAST('0x' || substr(md5('11|' || {text}), 1, 8) AS BIGINT) % 100)"


SQL: dict[str, str] = {
    # scans, filters, projections
    "scan_project": "SELECT c_custkey, c_name, c_nationkey FROM customer",
    "rename_columns": "SELECT n_nationkey AS dept, n_name AS dept_name FROM nation",
    "filter_eq": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'",
    "filter_in": """SELECT act_type, title, count(*) AS n FROM activities
                    WHERE act_type IN ('OAMTYPCD01', 'OAMTYPCD02') GROUP BY ALL""",
    "filter_status": "SELECT DISTINCT std_no, programme FROM enrolments WHERE state = 'NCR_T07_P05'",
    "recode_gender": """SELECT std_no, CASE WHEN gender = '남성' THEN '남' ELSE '여' END AS gender
                        FROM students""",
    "user_attributes": "SELECT std_no, dept, gender FROM students JOIN asking USING (std_no)",
    "missing_user": "SELECT count(*) AS n FROM students WHERE std_no = 'no such student'",
    "collection_roundtrip": """
        SELECT dept, 2 * count(*) AS n, 'raw' AS namespace FROM students GROUP BY dept
        UNION ALL SELECT dept, count(*), 'clean' FROM students GROUP BY dept""",
    "csv_clean": """
        SELECT CAST(s_suppkey AS INTEGER) AS no, s_name AS company,
               CAST(trunc(abs(s_acctbal) * 10) AS INTEGER) AS headcount,
               CAST(s_suppkey % 5 + 1 AS INTEGER) AS w_company,
               CAST(s_suppkey % 7 + 2 AS INTEGER) AS w_headcount FROM supplier""",
    "charset_roundtrip": """
        SELECT CAST(s_suppkey AS INTEGER) AS no, '대기업' AS company_type, '가나 ' || s_name AS company, 1234 AS headcount,
               '제조업' AS sector, '서울' AS location, CAST(s_suppkey % 5 + 1 AS INTEGER) AS w_company,
               CAST(s_suppkey % 7 + 2 AS INTEGER) AS w_headcount FROM supplier""",
    "delimited_parse": """
        SELECT CAST(l_orderkey AS INTEGER) AS id, count(*) AS n, sum(trunc(l_quantity)) AS sim,
               sum(CAST(l_suppkey AS DOUBLE)) AS result
        FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1""",
    "delimited_rejects": """
        SELECT concat_ws('::', CAST(l_orderkey AS VARCHAR), CAST(CAST(trunc(l_quantity) AS INTEGER) AS VARCHAR),
                         CAST(l_linenumber AS VARCHAR)) AS line, count(*) AS n
        FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1""",
    "libsvm_scan": """
        SELECT label, count(*) AS n, round(sum(list_sum(CAST(embedding AS DOUBLE[]))), 4) AS total
        FROM embeddings GROUP BY label""",
    "row_records": "SELECT n_nationkey, n_name FROM nation",
    # joins
    "join_inner": """SELECT posting_id, std_no, company FROM applications JOIN postings USING (posting_id)
                     WHERE applied = 'Y'""",
    "join_named_keys": """
        SELECT gender, act_type, count(*) AS n
        FROM activities a JOIN students s ON a.std_no = s.std_no GROUP BY ALL""",
    "join_left_drop": """
        SELECT r.item, r.n, p.area
        FROM (SELECT item, count(*) AS n FROM ratings WHERE kind = 'N' GROUP BY item) r
        LEFT JOIN programmes p ON p.programme = r.item""",
    "join_full_fill": """
        SELECT std_no, round(coalesce(star, 0e0), 6) AS star, coalesce(n, 0) AS n
        FROM (SELECT std_no, sum(units) / (count(*) * 1e4) AS star FROM ratings GROUP BY 1) r
        FULL JOIN (SELECT std_no, count(*) AS n FROM activities GROUP BY 1) a USING (std_no)""",
    "join_semi": """SELECT std_no, dept FROM students
                    WHERE std_no IN (SELECT std_no FROM ratings)""",
    "join_anti": """
        SELECT DISTINCT std_no, course FROM courses c
        WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.kind = 'C' AND r.std_no = c.std_no
                          AND r.item = c.course)""",
    "mark_join": """
        SELECT std_no, CASE WHEN std_no IN (SELECT std_no FROM activities WHERE act_type = 'OAMTYPCD01')
                            THEN 1 ELSE -1 END AS flag FROM students""",
    "left_default_multiply": """
        SELECT c.dept, c.item, round(c.n * coalesce(s.star, 1e0), 6) AS value
        FROM (SELECT dept, course AS item, CAST(count(*) AS DOUBLE) AS n FROM courses GROUP BY ALL) c
        LEFT JOIN (SELECT item, sum(units) / (count(*) * 1e4) AS star FROM ratings
                   WHERE kind = 'N' AND star > 49e-1 GROUP BY item) s USING (item)""",
    "densify_cohort": """
        SELECT m.dept, m.std_no, u.course, round(coalesce(c.value, -1e0), 6) AS value
        FROM members m JOIN universe u USING (dept)
        LEFT JOIN course_stars c ON c.dept = m.dept AND c.std_no = m.std_no AND c.feature = u.course""",
    # grouping and distinct
    "avg_star_per_item": """
        SELECT item, kind, round(sum(units) / (count(*) * 1e4), 6) AS star FROM ratings GROUP BY ALL""",
    "count_per_group": "SELECT dept, course, count(*) AS n FROM courses GROUP BY ALL",
    "user_activity_counts": "SELECT std_no, stars, done FROM act_counts",
    "distinct_rows": "SELECT std_no, dept, course FROM taken",
    "distinct_on_subset": "SELECT min(std_no) AS std_no, dept, course FROM courses GROUP BY dept, course",
    "dedupe_keep_last": """
        SELECT user_id, event_id, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "collect_items": """
        SELECT std_no, string_agg(course, ',' ORDER BY course) AS courses
        FROM (SELECT DISTINCT std_no, course FROM courses) GROUP BY std_no""",
    "stars_by_student": """
        SELECT std_no, string_agg(e, ';' ORDER BY e) AS stars
        FROM (SELECT std_no, feature || '=' || CAST(CAST(trunc(value * 1000) AS BIGINT) AS VARCHAR) AS e
              FROM course_stars) GROUP BY std_no""",
    "item_universe": """SELECT dept, string_agg(course, ',' ORDER BY course) AS courses
                        FROM universe GROUP BY dept""",
    "freq_table": """SELECT act_type, title, count(*) AS n FROM activities
                     WHERE act_type IN ('OAMTYPCD01', 'OAMTYPCD02') GROUP BY ALL""",
    "pivot_activity_counts": """
        SELECT std_no, count(*) FILTER (act_type = 'OAMTYPCD03') AS OAMTYPCD03,
               count(*) FILTER (act_type = 'OAMTYPCD04') AS OAMTYPCD04,
               count(*) FILTER (act_type = 'OAMTYPCD05') AS OAMTYPCD05
        FROM (SELECT DISTINCT * FROM activities) GROUP BY std_no""",
    "mean_per_person": """
        SELECT act_type, count(*) AS n, count(DISTINCT std_no) AS people,
               count(*) // count(DISTINCT std_no) AS mean_n FROM activities GROUP BY act_type""",
    # order, rank, set operations
    "rank_items": """
        SELECT dept, course, count(*) AS n,
               CAST(row_number() OVER (PARTITION BY dept ORDER BY count(*) DESC, course) AS INTEGER) AS rank
        FROM courses GROUP BY dept, course""",
    "sort_orders": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
                      ORDER BY o_totalprice DESC, o_orderkey""",
    "topk_people": """
        SELECT * FROM (SELECT dept, std_no, count(*) AS n,
                              CAST(row_number() OVER (PARTITION BY dept ORDER BY count(*) DESC, std_no) AS INTEGER) AS rank
                       FROM courses GROUP BY dept, std_no) WHERE rank <= 10""",
    "union_by_name": """
        SELECT std_no, what, count(*) AS n
        FROM (SELECT std_no, 'applied' AS what FROM applications
              UNION ALL SELECT std_no, 'searched' FROM searches) GROUP BY ALL""",
    "array_concat": """
        SELECT std_no, concat_ws(',', count(*) FILTER (act_type = 'OAMTYPCD03'),
               count(*) FILTER (act_type = 'OAMTYPCD04'), count(*) FILTER (act_type = 'OAMTYPCD05'),
               CASE WHEN count(*) FILTER (act_type = 'OAMTYPCD01') > 0 THEN 1 ELSE -1 END,
               CASE WHEN count(*) FILTER (act_type = 'OAMTYPCD02') > 0 THEN 1 ELSE -1 END) AS v
        FROM activities GROUP BY std_no""",
    "multiset_except": """
        SELECT dept, course, count(*) AS n
        FROM (SELECT dept, course FROM courses
              EXCEPT ALL SELECT u.dept, u.course FROM universe u JOIN programmes p ON p.programme = u.course)
        GROUP BY ALL""",
    # scalar functions
    "safe_cast": """
        SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
               TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number FROM orders""",
    "text_functions": """
        SELECT n_nationkey, n_name || ',' || CAST(n_regionkey AS VARCHAR) AS stripped, n_name AS head,
               'dept-' || CAST(n_nationkey AS VARCHAR) AS label FROM nation""",
    "quantise_values": """
        SELECT CAST(trunc(l_discount * 10 * 10) AS BIGINT) AS q,
               CAST(trunc(-(l_discount * 10) * 10) AS BIGINT) AS q_neg,
               CAST(trunc(l_discount * 10 * -100) AS BIGINT) AS q_act, count(*) AS n
        FROM lineitem GROUP BY 1, 2, 3""",
    "date_roundtrip": """
        SELECT event_id, strftime(ts, '%d-%b-%Y (%H:%M:%S.%f)') AS "REG_DATE", true AS same,
               true AS bad_is_null FROM events""",
    "publish_messages": """
        SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"REG_DATE":"'
               || strftime(ts, '%d-%b-%Y (%H:%M:%S.%f)') || '","event_type":"' || event_type || '"}' AS value
        FROM events""",
    "json_roundtrip": """
        SELECT event_id, strftime(ts, '%d-%b-%Y (%H:%M:%S.%f)') AS reg_text, event_type FROM events""",
    "lob_text": "SELECT doc_id, length(text) AS n_chars, md5(text) AS digest FROM documents",
    "safe_ratio": """
        SELECT s.std_no, 100 // greatest(count(a.std_no), 1) AS ratio
        FROM students s LEFT JOIN activities a ON a.std_no = s.std_no GROUP BY s.std_no""",
    "random_scores": "SELECT count(*) AS n, true AS low_ok, true AS high_ok FROM students",
    "round_scores": "SELECT item, round(star, 2) AS s2 FROM stars",
    "array_positions": """
        SELECT t.std_no, t.dept, t.course, u.pos
        FROM taken t JOIN (SELECT dept, course, row_number() OVER (PARTITION BY dept ORDER BY course) - 1 AS pos
                           FROM universe) u USING (dept, course)""",
    "flatten_lists": """
        SELECT std_no, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT std_no, kind, item FROM ratings) GROUP BY std_no""",
    "dense_cosine": """
        SELECT v.vec_id, v.label, round(
                   list_sum(list_transform(range(1, 65), lambda i: CAST(v.embedding[i] AS DOUBLE) * f.first[i]))
                   / (sqrt(list_sum(list_transform(v.embedding, lambda e: CAST(e AS DOUBLE) * e)))
                      * sqrt(list_sum(list_transform(f.first, lambda e: CAST(e AS DOUBLE) * e)))), 6) AS cosine
        FROM embeddings v
        JOIN (SELECT label, arg_min(embedding, vec_id) AS first FROM embeddings GROUP BY label) f USING (label)""",
    # registers
    "dept_students": """SELECT dept, std_no, row_number() OVER (PARTITION BY dept ORDER BY std_no) AS position
                        FROM (SELECT DISTINCT dept, std_no FROM students)""",
    "dept_courses": "SELECT dept, course FROM universe",
    "college_departments": """
        SELECT CAST(n_regionkey AS VARCHAR) AS college,
               string_agg(CAST(n_nationkey AS VARCHAR), ',' ORDER BY CAST(n_nationkey AS VARCHAR)) AS depts
        FROM nation GROUP BY 1""",
    "company_graduate_lists": """SELECT company, std_no,
                                        row_number() OVER (PARTITION BY company ORDER BY std_no) AS position
                                 FROM grads""",
    # interest
    "interest_applied": """SELECT std_no, strftime(reg_date, '%Y-%m-%d %H:%M:%S') AS reg_date, company FROM sent""",
    "interest_searched": """SELECT std_no, strftime(reg_date, '%Y-%m-%d %H:%M:%S') AS reg_date, company
                            FROM searches""",
    "interest_same_dept_gender": "SELECT std_no, company FROM same_group",
    "interest_bundle": "SELECT std_no, company, source FROM bundle",
    "interest_cascade": "SELECT std_no, company, source FROM chosen",
    "company_graduates": """SELECT c.std_no AS query_std, company, count(*) AS n
                            FROM chosen c JOIN grads g USING (company) GROUP BY ALL""",
    # trust
    "company_trust": """SELECT query_std, std_no, round(max(company_trust), 6) AS best, count(*) AS employers
                        FROM asked_trust GROUP BY ALL""",
    "company_trust_all": "SELECT company, std_no, round(company_trust, 6) AS company_trust FROM company_scores",
    "content_trust": "SELECT item, round(star, 6) AS star FROM stars",
    "activity_score": """
        SELECT std_no, CAST(stars // greatest(done, 1) AS DOUBLE) AS act_score,
               round(stars / CAST(greatest(done, 1) AS DOUBLE), 6) AS exact FROM act_counts""",
    "user_trust": "SELECT query_std, std_no, round(trust, 6) AS trust FROM trust",
    "user_trust_exact": """
        SELECT query_std, std_no,
               round(5e-1 * company_trust + 5e-1 * (stars / CAST(greatest(done, 1) AS DOUBLE)), 6) AS trust
        FROM best_trust JOIN act_counts USING (std_no)""",
    # features
    "cohort": """
        SELECT a.std_no AS query_std, m.dept, m.std_no
        FROM asking a JOIN members q ON q.std_no = a.std_no JOIN members m ON m.dept = q.dept""",
    "course_vector": f"""SELECT dept, std_no, {_sparse("course")} AS "SUBJECT_STAR"
                         FROM placed GROUP BY dept, std_no""",
    "course_vector_3state": """
        SELECT m.dept, m.std_no, max(u.size) || '|' || string_agg(
                   u.position || ':' || CASE WHEN c.value IS NOT NULL THEN CAST(trunc(c.value * 10) AS BIGINT) ELSE -10 END,
                   ',' ORDER BY u.position) FILTER (c.value IS NOT NULL OR t.course IS NOT NULL) AS "SUBJECT_STAR"
        FROM (SELECT DISTINCT dept, std_no FROM course_stars) m
        JOIN (SELECT dept, feature AS course, position, size FROM places WHERE kind = 'course') u USING (dept)
        LEFT JOIN course_stars c ON c.dept = m.dept AND c.std_no = m.std_no AND c.feature = u.course
        LEFT JOIN taken t ON t.dept = m.dept AND t.std_no = m.std_no AND t.course = u.course
        GROUP BY 1, 2""",
    "area_vector": f"""SELECT dept, std_no, {_sparse("area")} AS "NCR_STAR"
                       FROM placed GROUP BY dept, std_no""",
    "activity_vector": f"""SELECT dept, std_no, {_sparse("act", -100)} AS "ACTING_COUNT"
                           FROM placed GROUP BY dept, std_no""",
    "took_flags": """
        SELECT dept, std_no, max(size) || '|' || string_agg(position || ':1', ',' ORDER BY position) AS "TOOK"
        FROM taken JOIN (SELECT dept, feature AS course, position, size FROM places WHERE kind = 'course')
        USING (dept, course) GROUP BY dept, std_no""",
    "feature_join": f"""
        SELECT dept, std_no, {_sparse("course")} AS "SUBJECT_STAR", {_sparse("area")} AS "NCR_STAR",
               {_sparse("act", -100)} AS "ACTING_COUNT"
        FROM placed GROUP BY dept, std_no""",
    "feature_dense": f"""
        SELECT dept, std_no, {_vector("'course'", 1)} AS "SUBJECT_STAR",
               coalesce({_vector("'area'", 1)}, '') AS "NCR_STAR", {_ACTING} AS "ACTING_COUNT"
        FROM dense JOIN asking USING (std_no) GROUP BY dept, std_no""",
    # similarity
    "cosine_course": "SELECT query_std, dept, std_no, round(s, 6) AS sbjt_similarity FROM likeness",
    "cosine_total": """
        SELECT query_std, dept, std_no, round(s, 6) AS sbjt_similarity, round(n, 6) AS ncr_similarity,
               round(a, 6) AS acting_similarity, round(similarity, 6) AS similarity FROM likeness""",
    "cosine_concat": """SELECT query_std, dept, std_no, round(concat_similarity, 6) AS concat_similarity
                        FROM likeness""",
    # recommendation
    "blend_score": """SELECT query_std, std_no, round(similarity, 6) AS similarity, round(trust, 6) AS trust,
                             round(score, 6) AS score FROM blended""",
    "top_neighbours": "SELECT query_std, std_no, round(score, 6) AS score, rank, k FROM near",
    "rec_courses": _ranked("ranked", "what = 'course'"),
    "rec_courses_multiset": _ranked("ranked_self", "what = 'course'"),
    "rec_programmes": _ranked("ranked", "what = 'programme'"),
    "rec_titles": _ranked("ranked", "what IN ('OAMTYPCD01', 'OAMTYPCD02')"),
    "mean_participation": """SELECT query_std, what, n, n // k AS mean_n FROM counts
                             WHERE what IN ('OAMTYPCD03', 'OAMTYPCD04', 'OAMTYPCD05')""",
    "rec_assembled": _assembled("ranked"),
    "recommend_first_run": _assembled("ranked_first"),
    "result_roundtrip": f"""
        SELECT query_std AS "QUERY_STD", * EXCLUDE (query_std) FROM ({_assembled("ranked")})
        WHERE "Rank" <= 4 OR CAST(query_std AS BIGINT) % 3 <> 0""",
    # evaluation
    "ground_truth": "SELECT dept, item, n, rank FROM popular",
    "ground_truth_programmes": """
        SELECT * FROM (SELECT dept, programme AS item, count(*) AS n,
                              CAST(row_number() OVER (PARTITION BY dept ORDER BY count(*) DESC, programme) AS INTEGER) AS rank
                       FROM (SELECT DISTINCT * FROM enrolments WHERE state = 'NCR_T07_P05')
                       JOIN members USING (std_no) GROUP BY dept, programme) WHERE rank <= 30""",
    "eval_prf": """
        SELECT query_std, hits, n_recommended, n_truth, round(p, 6) AS precision, round(r, 6) AS recall,
               round(coalesce(2 * (r * p) / nullif(r + p, 0), 0e0), 6) AS f_measure,
               round(r, 6) AS ref_precision, round(p, 6) AS ref_recall
        FROM (SELECT *, coalesce(hits / CAST(nullif(n_recommended, 0) AS DOUBLE), 0e0) AS p,
                     coalesce(hits / CAST(nullif(n_truth, 0) AS DOUBLE), 0e0) AS r
              FROM (SELECT query_std, count(*) FILTER (got AND want) AS hits,
                           count(*) FILTER (got) AS n_recommended, count(*) FILTER (want) AS n_truth
                    FROM (SELECT query_std, item, bool_or(got) AS got, bool_or(want) AS want
                          FROM (SELECT query_std, item, true AS got, false AS want FROM ranked WHERE what = 'course'
                                UNION ALL SELECT a.std_no, p.item, false, true
                                FROM asking a JOIN members m ON m.std_no = a.std_no JOIN popular p ON p.dept = m.dept)
                          GROUP BY ALL) GROUP BY query_std))""",
    "confusion_counts": "SELECT label, prediction, n FROM cells",
    "confusion_matrix": """
        SELECT label, CAST(coalesce(sum(n) FILTER (prediction = 0), 0) AS BIGINT) AS pred_0,
               CAST(coalesce(sum(n) FILTER (prediction = 1), 0) AS BIGINT) AS pred_1,
               CAST(coalesce(sum(n) FILTER (prediction IS NULL OR prediction NOT IN (0, 1)), 0) AS BIGINT) AS pred_other
        FROM cells GROUP BY label""",
    "per_label_metrics": """
        SELECT label, actual, tp, total, round(precision, 6) AS precision, round(recall, 6) AS recall,
               round(fpr, 6) AS fpr, round(f1, 6) AS f1 FROM label_scores""",
    "weighted_metrics": """
        SELECT round(sum(tp) / max(total), 6) AS accuracy,
               round(sum(precision * (actual / total)), 6) AS weighted_precision,
               round(sum(recall * (actual / total)), 6) AS weighted_recall,
               round(sum(f1 * (actual / total)), 6) AS weighted_f1,
               round(sum(fpr * (actual / total)), 6) AS weighted_fpr FROM label_scores""",
    "metrics_by_threshold": """
        SELECT score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(precision, 6) AS precision,
               round(recall, 6) AS recall,
               round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0e0), 6) AS f1,
               round(coalesce(125e-2 * precision * recall / nullif(25e-2 * precision + recall, 0), 0e0), 6) AS f05,
               round(fpr, 6) AS fpr FROM curve""",
    "pr_roc_areas": """
        SELECT round(sum((fpr - fpr0) * (recall + recall0) / 2), 6) AS auroc,
               round(sum((recall - recall0) * (precision + precision0) / 2), 6) AS aupr
        FROM (SELECT *, lag(fpr, 1, 0e0) OVER w AS fpr0, lag(recall, 1, 0e0) OVER w AS recall0,
                     coalesce(lag(precision) OVER w, precision) AS precision0
              FROM curve WINDOW w AS (ORDER BY score DESC))""",
    "rmse": """SELECT round(sqrt(avg((r.star - s.star) * (r.star - s.star))), 6) AS rmse
               FROM ratings r JOIN stars s USING (item)""",
    # models and streams
    "random_split_sizes": f"""
        SELECT CASE WHEN {_fold("std_no || '|' || item")} < 60 THEN 0 ELSE 1 END AS part, count(*) AS n
        FROM (SELECT DISTINCT std_no, item FROM ratings) GROUP BY 1""",
    "als_topk": """
        SELECT DISTINCT std_no, CAST(10 AS BIGINT) AS n, 10 AS last_rank, CAST(10 AS BIGINT) AS different, true AS falling
        FROM asking JOIN ratings USING (std_no)""",
    "als_top_users": """
        SELECT DISTINCT item, CAST(10 AS BIGINT) AS n, 10 AS last_rank, CAST(10 AS BIGINT) AS different, true AS falling
        FROM ratings WHERE item LIKE '%0'""",
    "als_rmse": f"""
        SELECT count(*) AS n, true AS nearer_than_mean FROM (SELECT DISTINCT std_no, item FROM ratings)
        WHERE {_fold("std_no || '|' || item")} < 80""",
    "logistic_accuracy": f"""
        SELECT count(*) AS n, true AS probabilities, true AS known_classes, true AS as_good_as_usual
        FROM labels JOIN documents USING (doc_id) WHERE {_fold("doc_id")} >= 60""",
    "logistic_multiclass": f"""
        SELECT count(*) AS n, true AS probabilities, true AS known_classes, true AS as_good_as_usual
        FROM embeddings WHERE {_fold("vec_id")} >= 60""",
    "stream_ingest": """
        SELECT event_id, strftime(ts, '%d-%b-%Y (%H:%M:%S.%f)') AS reg_text, event_type FROM events""",
    "stream_rejects": """
        SELECT CASE WHEN event_id % 10 < 2 THEN 'reject' ELSE 'row' END AS what,
               CASE event_id % 10 WHEN 0 THEN '{"event_id":' || event_id || ',"event_'
                    WHEN 1 THEN '{"event_type":"' || event_type || ' ' || event_id || '"}'
                    ELSE event_id || ' ' || event_type END AS value
        FROM events WHERE event_id % 10 <> 2""",
    "stream_resume": """
        SELECT event_id, strftime(ts, '%d-%b-%Y (%H:%M:%S.%f)') AS reg_text, event_type FROM events""",
    "stream_dedupe": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_insert_if_absent": """
        SELECT user_id, event_id, event_type FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
}


def _needed(text: str) -> list[str]:
    found: set[str] = set()
    todo = [text]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & VIEWS.keys() - found:
            found.add(name)
            todo.append(VIEWS[name])
    return [name for name in VIEWS if name in found]


def with_views(body: str) -> str:
    views = _needed(body)
    if not views:
        return body
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in views) + "\n" + body


def all_sql() -> dict[str, str]:
    return {name: with_views(body) for name, body in SQL.items()}
