"""The domain tables expressed over the given star-schema tables.

Every view is a plain projection, join or recode of whole tables:
customers are students, their nation the department, line items the courses they
completed and rated, suppliers the companies, orders the job applications and
events the activities and job searches.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathkin.domain import Domain
from pathkin.functions.scalars import COMPLETED
from pathkin.operators.facts import Facts, gather
from pathkin.session import Workspace

# the given parts are mapped onto this many course codes, as the SQL twins do
COURSE_CODES = 100


# Schemas of the given tables, so that opening one starts no inference job.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
    " props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _course_code(part_key: str) -> Column:
    return (F.col(part_key) % COURSE_CODES).cast("string")


def _activity_type() -> Column:
    kinds = ["click", "view", "signup", "purchase", "error"]
    code = F.lit(None).cast("string")
    for i, kind in enumerate(kinds, start=1):
        code = F.when(F.col("event_type") == kind, f"OAMTYPCD{i:02d}").otherwise(code)
    return code


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order.

    A task holds its orders in a hash table and need not sort its lines, which take
    several times the memory.
    """
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.join(orders.hint("shuffle_hash"), lineitem.l_orderkey == orders.o_orderkey).withColumn("std_no", _text("o_custkey"))


def _bought(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return lines.join(customer, F.col("o_custkey") == F.col("c_custkey"))


def _stored_lines(spark: SparkSession, sf_dir: str, workspace: Workspace) -> DataFrame:
    """Lines, orders and customers joined once for a run; only the columns that it needs."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    joined = _lines(spark, sf_dir).join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return workspace.stage(
        joined.select(
            "std_no", "o_custkey", "o_orderstatus", "l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
            "l_returnflag", "c_custkey", "c_nationkey", "c_mktsegment",
        ),
        "lines",
    )


def load_domain(spark: SparkSession, sf_dir: str, stored: DataFrame | None = None) -> Domain:
    """The domain; over lines already joined and stored, if there are such."""
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    events = table(spark, sf_dir, "events")
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")

    lines = _lines(spark, sf_dir) if stored is None else stored
    bought = _bought(spark, sf_dir, lines) if stored is None else stored.filter("c_custkey is not null")
    # an order without lines has no posting, and a line without order no application to it
    posted = lineitem if stored is None else stored
    male = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")

    return Domain(
        students=customer.select(
            _text("c_custkey").alias("std_no"),
            _text("c_nationkey").alias("dept"),
            F.when(male, "남성").otherwise("여성").alias("gender"),
        ),
        courses=bought.select(
            "std_no",
            _text("c_nationkey").alias("dept"),
            _course_code("l_partkey").alias("course"),
        ),
        ratings=lines.select(
            "std_no",
            _course_code("l_partkey").alias("item"),
            (F.col("l_quantity") / 10.0).alias("star"),
            F.when(F.col("l_returnflag").isin("A", "R"), "C").otherwise("N").alias("kind"),
        ),
        programmes=part.groupBy(_course_code("p_partkey").alias("programme")).agg(
            F.min("p_brand").alias("area")
        ),
        enrolments=lines.select(
            "std_no",
            _text("l_orderkey").alias("enrol_id"),
            _course_code("l_partkey").alias("programme"),
            F.when(F.col("o_orderstatus") == "F", COMPLETED).otherwise("NCR_T07_P01").alias("state"),
        ),
        activities=events.select(
            _text("user_id").alias("std_no"),
            _activity_type().alias("act_type"),
            F.get_json_object("props", "$.k").alias("title"),
        ),
        graduates=bought.select(
            "std_no",
            _text("c_nationkey").alias("dept"),
            F.when(male, "남").otherwise("여").alias("gender"),
            _text("l_suppkey").alias("company"),
        ),
        company_ratings=supplier.filter(F.col("s_suppkey") % 10 != 0).select(
            _text("s_suppkey").alias("company"),
            (F.col("s_suppkey") % 5 + 1).cast("int").alias("w_company"),
            (F.col("s_suppkey") % 7 + 2).cast("int").alias("w_headcount"),
        ),
        applications=orders.select(
            _text("o_orderkey").alias("posting_id"),
            F.col("o_orderdate").alias("reg_date"),
            _text("o_custkey").alias("std_no"),
            F.when(F.col("o_orderpriority") < "3", "Y").otherwise("N").alias("applied"),
        ),
        postings=posted.groupBy(_text("l_orderkey").alias("posting_id")).agg(
            F.min("l_suppkey").cast("string").alias("company")
        ),
        searches=events.filter(F.col("event_type").isin("view", "click")).select(
            _text("event_id").alias("search_id"),
            _text("user_id").alias("std_no"),
            F.col("ts").alias("reg_date"),
            (F.col("event_id") % 100).cast("string").alias("company"),
        ),
    )


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """college, dept."""
    return table(spark, sf_dir, "nation").select(
        _text("n_regionkey").alias("college"), _text("n_nationkey").alias("dept")
    )


@contextmanager
def gathered(spark: SparkSession, sf_dir: str) -> Iterator[tuple[Facts, DataFrame]]:
    """The facts of one run and its asking students; all tables of the run go with it."""
    with Workspace(spark) as workspace:
        facts = gather(load_domain(spark, sf_dir, _stored_lines(spark, sf_dir, workspace)), workspace)
        yield facts, workspace.stage(query_students(facts), "asking")


def query_students(domain: Domain | Facts) -> DataFrame:
    """std_no of one asking student per department.

    The asking student is the parameter of every recommendation; with one in each
    department every student of the whole table is compared exactly once.
    """
    return domain.students.groupBy("dept").agg(F.min("std_no").alias("std_no")).select("std_no")
