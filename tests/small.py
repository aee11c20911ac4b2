"""A small made-up domain; every table can be replaced."""

from pathkin.domain import Domain

SCHEMAS = {
    "students": "std_no string, dept string, gender string",
    "courses": "std_no string, dept string, course string",
    "ratings": "std_no string, item string, star double, kind string",
    "programmes": "programme string, area string",
    "enrolments": "std_no string, enrol_id string, programme string, state string",
    "activities": "std_no string, act_type string, title string",
    "graduates": "std_no string, dept string, gender string, company string",
    "company_ratings": "company string, w_company int, w_headcount int",
    "applications": "posting_id string, reg_date string, std_no string, applied string",
    "postings": "posting_id string, company string",
    "searches": "search_id string, std_no string, reg_date string, company string",
}


def make(spark, **rows) -> Domain:
    frames = {
        name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in SCHEMAS.items()
    }
    return Domain(**frames)


def users(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "std_no string")


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
