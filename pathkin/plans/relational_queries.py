"""Queries for scans, filters, joins, groupings, windows and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pathkin.functions.scalars import (
    COMPLETED,
    COUNT_CODES,
    TITLE_CODES,
    date_to_text,
    int_div,
    mean_star,
    quantise,
    random_score,
    round_places,
    safe_int_ratio,
    short_gender,
    text_to_date,
)
from pathkin.functions.vectors import cosine
from pathkin.operators import features as fe
from pathkin.operators import relational as rel
from pathkin.operators import trust as tr
from pathkin.plans.testdata import departments, load_domain, query_students, table
from pathkin.session import scratch_path
from pathkin.sources import stores

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _joined(array_column: str):
    return F.array_join(F.col(array_column), ",")


# ---- scans, filters, projections -------------------------------------------------


@query
def scan_project(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")


@query
def rename_columns(spark, sf):
    return (
        table(spark, sf, "nation")
        .withColumnRenamed("n_nationkey", "dept")
        .select("dept", F.col("n_name").alias("dept_name"), "n_regionkey")
        .drop("n_regionkey")
    )


@query
def filter_eq(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")


@query
def filter_in(spark, sf):
    acts = load_domain(spark, sf).activities
    return acts.filter(F.col("act_type").isin(TITLE_CODES)).groupBy("act_type", "title").agg(
        F.count("*").alias("n")
    )


@query
def filter_status(spark, sf):
    done = load_domain(spark, sf).enrolments.filter(F.col("state") == COMPLETED)
    return done.select("std_no", "programme").distinct()


@query
def recode_gender(spark, sf):
    return load_domain(spark, sf).students.select(
        "std_no", short_gender(F.col("gender")).alias("gender")
    )


@query
def user_attributes(spark, sf):
    domain = load_domain(spark, sf)
    return domain.students.join(query_students(domain), "std_no").select("std_no", "dept", "gender")


@query
def missing_user(spark, sf):
    """A student number that is not on the register gives an empty result."""
    nobody = spark.createDataFrame([("no such student",)], "std_no string")
    found = load_domain(spark, sf).students.join(nobody, "std_no")
    return found.agg(F.count("*").alias("n"))


@query
def collection_roundtrip(spark, sf):
    """Append to a stored collection, overwrite another, read both by schema and namespace."""
    root = scratch_path(spark, "collections")
    students = load_domain(spark, sf).students.select(
        F.col("std_no").alias("STD_NO"),
        F.lit(None).cast("string").alias("KOR_NM"),
        F.col("dept").alias("SUST_CD_NM"),
        F.col("gender").alias("GEN_FG_NM"),
        F.lit("N").alias("GRADT_YN"),
        F.lit(None).cast("int").alias("COLG_CD"),
        F.lit(None).cast("string").alias("COLG_CD_NM"),
        F.lit(None).cast("string").alias("SUST_CD"),
    )
    for namespace, mode in [("raw", "append"), ("clean", "overwrite")]:
        for _ in range(2):
            stores.write_collection(students, root, "V_STD_CDP_SREG", mode, namespace)
    counted = [
        stores.load_collections(spark, root, ["V_STD_CDP_SREG"], namespace=ns)["V_STD_CDP_SREG"]
        .groupBy(F.col("SUST_CD_NM").alias("dept"))
        .agg(F.count("*").alias("n"))
        .withColumn("namespace", F.lit(ns))
        for ns in ("raw", "clean")
    ]
    return counted[0].unionByName(counted[1])


@query
def csv_clean(spark, sf):
    """Suppliers as a padded rating file with quoted thousands, read back clean."""
    path = scratch_path(spark, "ratings-csv")
    headcount = (F.abs("s_acctbal") * 10).cast("int")
    table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("No"),
        F.lit("A").alias("기업형태"),
        F.col("s_name").alias("기업명"),
        F.concat(F.lit(" "), F.format_number(headcount, 0), F.lit(" ")).alias(" 직원수 "),
        F.lit("B").alias("업종"),
        F.lit("C").alias("소재지"),
        (F.col("s_suppkey") % 5 + 1).alias("기업가중치"),
        (F.col("s_suppkey") % 7 + 2).alias("직원수 가중치"),
    ).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return stores.read_company_ratings(spark, path).select(
        "no", "company", "headcount", "w_company", "w_headcount"
    )


def _records(spark, sf):
    """a::b::c::d lines; rows returned as N lose their last field."""
    return table(spark, sf, "lineitem").select(
        F.concat_ws(
            "::",
            F.col("l_orderkey").cast("string"),
            F.col("l_quantity").cast("int").cast("string"),
            F.col("l_linenumber").cast("string"),
            F.when(F.col("l_returnflag") != "N", F.col("l_suppkey").cast("string")),
        ).alias("line")
    )


def _parsed(spark, sf):
    return stores.parse_delimited(
        _records(spark, sf), "line", ["id", "sim", "trust", "result"], ["int"] + ["double"] * 3
    )


@query
def delimited_parse(spark, sf):
    return _parsed(spark, sf)[0].groupBy("id").agg(
        F.count("*").alias("n"), F.sum("sim").alias("sim"), F.sum("result").alias("result")
    )


@query
def delimited_rejects(spark, sf):
    return _parsed(spark, sf)[1].groupBy("line").agg(F.count("*").alias("n"))


@query
def libsvm_scan(spark, sf):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    path = scratch_path(spark, "libsvm")
    table(spark, sf, "embeddings").select(
        F.col("label").cast("double").alias("label"),
        array_to_vector("embedding").alias("features"),
    ).write.format("libsvm").save(path)
    values = vector_to_array("features")
    total = F.aggregate(values, F.lit(0.0), lambda s, v: s + v)
    return (
        stores.read_libsvm(spark, path, 64)
        .groupBy(F.col("label").cast("int").alias("label"))
        .agg(F.count("*").alias("n"), F.round(F.sum(total), 4).alias("total"))
    )


@query
def row_records(spark, sf):
    """Each row as one name/value record, read back by name."""
    nation = table(spark, sf, "nation").select(F.struct("*").alias("record"))
    return nation.select(
        F.col("record.n_nationkey").alias("n_nationkey"),
        F.col("record")["n_name"].alias("n_name"),
    )


# ---- joins -----------------------------------------------------------------------


@query
def join_inner(spark, sf):
    domain = load_domain(spark, sf)
    sent = domain.applications.filter(F.col("applied") == "Y").select("posting_id", "std_no")
    return sent.join(domain.postings, ["posting_id"], "inner")


@query
def join_named_keys(spark, sf):
    """Inner join where the key has another name on each side."""
    domain = load_domain(spark, sf)
    people = domain.students.select(F.col("std_no").alias("key"), "gender")
    acts = domain.activities
    return (
        acts.join(people, acts.std_no == people.key)
        .groupBy("gender", "act_type")
        .agg(F.count("*").alias("n"))
    )


@query
def join_left_drop(spark, sf):
    domain = load_domain(spark, sf)
    stars = domain.ratings.filter(F.col("kind") == "N").groupBy("item").agg(
        F.count("*").alias("n")
    )
    infos = domain.programmes.withColumnRenamed("programme", "key")
    return stars.join(infos, stars.item == infos.key, "left").drop("key")


@query
def join_full_fill(spark, sf):
    """Score and activity count per student, 0 on the missing side."""
    domain = load_domain(spark, sf)
    stars = domain.ratings.groupBy("std_no").agg(mean_star(F.col("star")).alias("star"))
    acts = domain.activities.groupBy("std_no").agg(F.count("*").alias("n"))
    return (
        stars.join(acts, "std_no", "full")
        .na.fill(0.0, ["star"])
        .na.fill(0, ["n"])
        .withColumn("star", F.round("star", 6))
    )


@query
def join_semi(spark, sf):
    domain = load_domain(spark, sf)
    rated = domain.ratings.select("std_no")
    return domain.students.join(rated, "std_no", "left_semi").select("std_no", "dept")


@query
def join_anti(spark, sf):
    """Courses completed but never rated by the same student."""
    domain = load_domain(spark, sf)
    taken = domain.courses.select("std_no", "course").distinct()
    rated = domain.ratings.filter(F.col("kind") == "C").select(
        "std_no", F.col("item").alias("course")
    )
    return taken.join(rated, ["std_no", "course"], "left_anti")


@query
def mark_join(spark, sf):
    """Flag 1 for students with a certificate, -1 for the others."""
    domain = load_domain(spark, sf)
    certified = domain.activities.filter(F.col("act_type") == "OAMTYPCD01")
    return rel.mark_members(
        domain.students.select("std_no"), certified, ["std_no"], "flag", 1, -1
    )


@query
def left_default_multiply(spark, sf):
    """Completions times mean rating of programme stars; unrated items keep the count."""
    domain = load_domain(spark, sf)
    counts = domain.courses.groupBy("dept", F.col("course").alias("item")).agg(
        F.count("*").cast("double").alias("value")
    )
    stars = domain.ratings.filter((F.col("kind") == "N") & (F.col("star") > 4.9)).groupBy(
        "item"
    ).agg(mean_star(F.col("star")).alias("star"))
    return rel.multiply_or_keep(counts, stars, ["item"], "value", "star").withColumn(
        "value", F.round("value", 6)
    )


@query
def densify_cohort(spark, sf):
    """Every course of the department against every student of it."""
    dense = fe.densify_courses(load_domain(spark, sf))
    return dense.withColumn("value", F.round("value", 6))


# ---- grouping and distinct -------------------------------------------------------


@query
def avg_star_per_item(spark, sf):
    stars = load_domain(spark, sf).ratings.groupBy("item", "kind")
    return stars.agg(F.round(mean_star(F.col("star")), 6).alias("star"))


@query
def count_per_group(spark, sf):
    return load_domain(spark, sf).courses.groupBy("dept", "course").agg(F.count("*").alias("n"))


@query
def user_activity_counts(spark, sf):
    return tr.activity_score(load_domain(spark, sf)).select("std_no", "stars", "done")


@query
def distinct_rows(spark, sf):
    return load_domain(spark, sf).courses.select("std_no", "dept", "course").distinct()


@query
def distinct_on_subset(spark, sf):
    """One course per name and department: the smallest student number stands for it."""
    taken = load_domain(spark, sf).courses
    return rel.keep_last(taken, ["dept", "course"], [F.col("std_no")])


@query
def dedupe_keep_last(spark, sf):
    """The last event of each user."""
    events = table(spark, sf, "events")
    last = rel.keep_last(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return last.select("user_id", "event_id", "event_type")


@query
def collect_items(spark, sf):
    """Each student's distinct courses as one sorted list."""
    taken = load_domain(spark, sf).courses.select("std_no", "course").distinct()
    return taken.groupBy("std_no").agg(
        F.array_join(F.array_sort(F.collect_list("course")), ",").alias("courses")
    )


@query
def stars_by_student(spark, sf):
    """Each student's (course, star) entries as a map, shown as sorted text."""
    entries = fe.course_entries(load_domain(spark, sf))
    entry = F.concat_ws("=", "feature", quantise(F.col("value"), 1000).cast("string"))
    return entries.groupBy("std_no").agg(
        F.array_join(F.array_sort(F.collect_list(entry)), ";").alias("stars")
    )


@query
def item_universe(spark, sf):
    lists = fe.course_universe(load_domain(spark, sf)).groupBy("dept").agg(
        F.array_sort(F.collect_list("course")).alias("courses")
    )
    return lists.select("dept", _joined("courses").alias("courses"))


@query
def freq_table(spark, sf):
    acts = load_domain(spark, sf).activities.filter(F.col("act_type").isin(TITLE_CODES))
    return rel.frequency(acts, ["act_type"], "title").orderBy(F.col("n").desc(), "title")


@query
def pivot_activity_counts(spark, sf):
    acts = load_domain(spark, sf).activities
    return (
        acts.select("std_no", "act_type", "title")
        .distinct()
        .groupBy("std_no")
        .pivot("act_type", COUNT_CODES)
        .count()
        .na.fill(0)
    )


@query
def mean_per_person(spark, sf):
    """Whole-number mean of activities per student of a code."""
    acts = load_domain(spark, sf).activities
    per_code = acts.groupBy("act_type", "std_no").agg(F.count("*").alias("n")).groupBy("act_type")
    return per_code.agg(F.sum("n").alias("n"), F.count("*").alias("people")).withColumn(
        "mean_n", int_div(F.col("n"), F.col("people"))
    )


# ---- order, rank, set operations --------------------------------------------------


@query
def rank_items(spark, sf):
    """Courses of each department ranked from 1 by completions."""
    counts = load_domain(spark, sf).courses.groupBy("dept", "course").agg(F.count("*").alias("n"))
    window = Window.partitionBy("dept").orderBy(F.col("n").desc(), "course")
    return counts.withColumn("rank", F.row_number().over(window))


@query
def sort_orders(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey")


@query
def topk_people(spark, sf):
    """The ten students with most completions in each department."""
    counts = load_domain(spark, sf).courses.groupBy("dept", "std_no").agg(F.count("*").alias("n"))
    return rel.top_k(counts, ["dept"], [F.col("n").desc(), F.col("std_no")], 10)


@query
def union_by_name(spark, sf):
    domain = load_domain(spark, sf)
    applied = domain.applications.select("std_no", F.lit("applied").alias("what"))
    searched = domain.searches.select(F.lit("searched").alias("what"), "std_no")
    return applied.unionByName(searched).groupBy("std_no", "what").agg(F.count("*").alias("n"))


@query
def array_concat(spark, sf):
    """Counts and flags of a student laid end to end."""
    domain = load_domain(spark, sf)
    codes = [F.count_if(F.col("act_type") == c) for c in COUNT_CODES]
    flags = [
        F.when(F.count_if(F.col("act_type") == c) > 0, 1).otherwise(-1).cast("bigint")
        for c in TITLE_CODES
    ]
    out = domain.activities.groupBy("std_no").agg(
        F.concat(F.array(*codes), F.array(*flags)).alias("v")
    )
    return out.select("std_no", F.array_join(F.col("v").cast("array<string>"), ",").alias("v"))


@query
def multiset_except(spark, sf):
    """Completions minus one copy of each course that is a programme, too, as counted bags."""
    domain = load_domain(spark, sf)
    done = domain.courses.select("dept", "course")
    rated = (
        domain.courses.select("dept", "course")
        .distinct()
        .join(domain.programmes.select(F.col("programme").alias("course")), "course")
    )
    return rel.multiset_minus(done, rated)


# ---- scalar functions --------------------------------------------------------------


@query
def safe_cast(spark, sf):
    """Text to number where it is a number, else null."""
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.substring("o_orderpriority", 1, 1).try_cast("int").alias("priority"),
        F.col("o_orderpriority").try_cast("int").alias("not_a_number"),
    )


@query
def text_functions(spark, sf):
    """Bracket stripping, substring, split and join of text."""
    nation = table(spark, sf, "nation")
    shown = F.concat(F.lit("["), F.concat_ws(",", "n_name", F.col("n_regionkey").cast("string")), F.lit("]"))
    inner = F.expr("substring(shown, 2, length(shown) - 2)")
    return nation.withColumn("shown", shown).select(
        "n_nationkey",
        F.regexp_replace("shown", r"\[|\]", "").alias("stripped"),
        F.get(F.split(inner, ","), 0).alias("head"),
        F.concat_ws("-", F.lit("dept"), F.col("n_nationkey").cast("string")).alias("label"),
    )


@query
def quantise_values(spark, sf):
    lines = table(spark, sf, "lineitem")
    star = F.col("l_discount") * 10
    return lines.groupBy(
        quantise(star).alias("q"), quantise(-star).alias("q_neg"), quantise(star, -100).alias("q_act")
    ).agg(F.count("*").alias("n"))


@query
def date_roundtrip(spark, sf):
    """Event time to text and back; a broken text gives null."""
    text = date_to_text(F.col("ts"))
    back = text_to_date(F.col("REG_DATE"))
    return (
        table(spark, sf, "events")
        .select("event_id", "ts", text.alias("REG_DATE"))
        .select(
            "event_id",
            "REG_DATE",
            (back == F.col("ts")).alias("same"),
            text_to_date(F.concat(F.lit("x"), F.col("REG_DATE"))).isNull().alias("bad_is_null"),
        )
    )


@query
def publish_messages(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", "user_id", F.col("ts").alias("REG_DATE"), "event_type"
    )
    return stores.to_messages(events)


@query
def json_roundtrip(spark, sf):
    from pyspark.sql import types as T

    schema = (
        T.StructType().add("event_id", "long").add("REG_DATE", "timestamp").add("event_type", "string")
    )
    events = table(spark, sf, "events").select(
        "event_id", F.col("ts").alias("REG_DATE"), "event_type"
    )
    back = stores.from_messages(stores.to_messages(events), schema)
    return back.select("event_id", date_to_text(F.col("REG_DATE")).alias("reg_text"), "event_type")


@query
def lob_text(spark, sf):
    """Binary large objects decoded to text."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("lob"))
    text = F.decode("lob", "UTF-8")
    return docs.select("doc_id", F.length(text).cast("bigint").alias("n_chars"), F.md5(text).alias("digest"))


@query
def safe_ratio(spark, sf):
    domain = load_domain(spark, sf)
    counts = domain.students.join(
        domain.activities.groupBy("std_no").agg(F.count("*").alias("n")), "std_no", "left"
    ).na.fill(0, ["n"])
    return counts.select(
        "std_no", safe_int_ratio(F.lit(100).cast("bigint"), F.col("n")).alias("ratio")
    )


@query
def random_scores(spark, sf):
    scores = load_domain(spark, sf).students.select(random_score(11).alias("r"))
    return scores.agg(
        F.count("*").alias("n"),
        (F.min("r") >= 0).alias("low_ok"),
        (F.max("r") < 1).alias("high_ok"),
    )


@query
def round_scores(spark, sf):
    stars = load_domain(spark, sf).ratings.groupBy("item").agg(mean_star(F.col("star")).alias("s"))
    return stars.select("item", round_places(F.col("s"), 2).alias("s2"))


@query
def array_positions(spark, sf):
    """Position of each completed course in the department's sorted list, from 0."""
    domain = load_domain(spark, sf)
    lists = fe.course_universe(domain).groupBy("dept").agg(
        F.array_sort(F.collect_list("course")).alias("list")
    )
    taken = domain.courses.select("std_no", "dept", "course").distinct()
    placed = rel.spread_join(taken, lists, ["dept"], ["std_no"])
    return placed.select(
        "std_no", "dept", "course", (F.array_position("list", F.col("course")) - 1).alias("pos")
    )


@query
def flatten_lists(spark, sf):
    """Lists of distinct rated items per kind, flattened to one list per student."""
    rated = load_domain(spark, sf).ratings.select("std_no", "kind", "item").distinct()
    per_kind = rated.groupBy("std_no", "kind").agg(F.collect_list("item").alias("items"))
    flat = per_kind.groupBy("std_no").agg(
        F.array_sort(F.flatten(F.collect_list("items"))).alias("items")
    )
    return flat.select("std_no", _joined("items").alias("items"))


@query
def dense_cosine(spark, sf):
    """Each vector against the first vector of its label."""
    vectors = table(spark, sf, "embeddings")
    first = vectors.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("first"))
    return rel.hot_join(vectors, first, ["label"], ["vec_id"]).select(
        "vec_id", "label", F.round(cosine(F.col("embedding"), F.col("first")), 6).alias("cosine")
    )


@query
def charset_roundtrip(spark, sf):
    """The rating file written and read in EUC-KR."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")  # as in build_session
    path = scratch_path(spark, "charset")
    text = lambda name: F.col(name).cast("string")
    rated = table(spark, sf, "supplier").select(
        text("s_suppkey").alias("No"), F.lit("대기업").alias("기업형태"),
        F.concat(F.lit("가나 "), F.col("s_name")).alias("기업명"), F.lit(' 1,234 ').alias("직원수"), F.lit("제조업").alias("업종"),
        F.lit("서울").alias("소재지"), (F.col("s_suppkey") % 5 + 1).alias("기업가중치"), (F.col("s_suppkey") % 7 + 2).alias("직원수 가중치"),
    )
    rated.write.option("header", True).option("encoding", "EUC-KR").csv(path)
    return stores.read_company_ratings(spark, path, encoding="EUC-KR")


# ---- registers ----------------------------------------------------------------------


@query
def dept_students(spark, sf):
    """Students of each department in order, one row each."""
    people = load_domain(spark, sf).students.select("dept", "std_no").distinct()
    return rel.numbered(people, ["dept"], ["std_no"])


@query
def dept_courses(spark, sf):
    return fe.course_universe(load_domain(spark, sf))


@query
def college_departments(spark, sf):
    lists = departments(spark, sf).distinct().groupBy("college").agg(
        F.array_sort(F.collect_list("dept")).alias("depts")
    )
    return lists.select("college", _joined("depts").alias("depts"))


@query
def company_graduate_lists(spark, sf):
    """Graduates of every company in order, one row each."""
    pairs = load_domain(spark, sf).graduates.select("company", "std_no").distinct()
    return rel.numbered(pairs, ["company"], ["std_no"])
