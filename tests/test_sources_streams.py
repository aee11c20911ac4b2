import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathkin.domain import Domain
from pathkin.functions.scalars import date_to_text
from pathkin.operators import recommend as rc
from pathkin.sources import stores
from pathkin.sources.schemas import COLLECTIONS
from pathkin.streaming import ingest as st
from small import rows, users

SCHEMA = T.StructType().add("STD_NO", "string").add("REG_DATE", "timestamp").add("N", "long")


def _message(std_no, date="05-Mar-2020 (13:45:10.123456)", n=1):
    return json.dumps({"STD_NO": std_no, "REG_DATE": date, "N": n})


def _put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_rating_file(spark, tmp_path):
    text = (
        "No,기업형태,기업명, 직원수 ,업종,소재지,기업가중치,직원수 가중치\n"
        '1,대기업,가나전자," 105,342 ",제조업,서울,5,8\n'
        "2,중소기업, 다라상사 , 168 ,도매업,부산,1,3\n"
        "3,중소기업,마바, - ,도매업,부산,x,3\n"
    )
    (tmp_path / "r.csv").write_text(text)
    got = rows(
        stores.read_company_ratings(spark, str(tmp_path / "r.csv")).na.fill(-1),
        "no", "company", "headcount", "w_company", "w_headcount",
    )
    assert got == [(1, "가나전자", 105342, 5, 8), (2, "다라상사", 168, 1, 3), (3, "마바", -1, -1, 3)]


def test_rating_file_in_another_encoding(spark, tmp_path):
    text = "No,기업형태,기업명, 직원수 ,업종,소재지,기업가중치,직원수 가중치\n1,대기업,가나전자,10,제조업,서울,5,8\n"
    (tmp_path / "r.csv").write_bytes(text.encode("euc-kr"))
    got = stores.read_company_ratings(spark, str(tmp_path / "r.csv"), encoding="EUC-KR")
    assert rows(got, "company") == [("가나전자",)]


def test_delimited_records(spark):
    lines = spark.createDataFrame([("1::2::3::4",), ("1::2::3",), ("a::2::3::4",), ("5::6.5::7::8::9",)],
                                  "line string")
    names, kinds = ["id", "a", "b", "c"], ["int", "double", "double", "double"]
    good, bad = stores.parse_delimited(lines, "line", names, kinds)
    assert rows(good, *names) == [(1, 2.0, 3.0, 4.0)]
    assert rows(bad, "line") == [("1::2::3",), ("5::6.5::7::8::9",), ("a::2::3::4",)]


def test_database_extract_options():
    plain = stores.jdbc_options("jdbc:x", "T", partitions=1)
    with pytest.raises(ValueError):
        stores.jdbc_options("jdbc:x", "T")
    assert plain["dbtable"] == "T" and "numPartitions" not in plain
    ranged = stores.jdbc_options("jdbc:x", "T", "ID", ("0", "99"), 8)
    assert ranged["partitionColumn"] == "ID" and ranged["numPartitions"] == "8"


def test_messages_restore_each_date_on_its_own(spark):
    schema = T.StructType().add("A_DATE", "timestamp").add("B_DATE", "timestamp").add("X", "string")
    lines = [
        json.dumps({"A_DATE": "not a date", "B_DATE": "05-Mar-2020 (13:45:10.123456)", "X": "x"}),
        "{}", "null", "",
    ]
    messages = spark.createDataFrame([(v,) for v in lines] + [(None,)], "value string")
    got = stores.from_messages(messages, schema)
    assert rows(got.select(F.col("A_DATE").isNull().alias("bad"), date_to_text(F.col("B_DATE")).alias("b"), "X"),
                "bad", "b", "X") == [(True, "05-Mar-2020 (13:45:10.123456)", "x")]


def test_published_file_reads_back(spark, tmp_path):
    df = spark.sql("SELECT '1' AS STD_NO, timestamp'2020-03-05 13:45:10.123456' AS REG_DATE, 7L AS N")
    stores.publish(df, str(tmp_path / "out"))
    back = stores.from_messages(spark.read.text(str(tmp_path / "out")), SCHEMA)
    assert back.collect() == df.collect()


def test_ingest_restart_adds_nothing(spark, tmp_path):
    src, sink, cp = tmp_path / "in", str(tmp_path / "sink"), str(tmp_path / "cp")
    _put(src, "1.json", [_message("a"), _message("b", "broken"), "{}"])
    for _ in range(2):
        st.ingest(st.file_messages(spark, str(src), 1), SCHEMA, sink, cp).awaitTermination()
        stored = spark.read.schema(SCHEMA).parquet(sink)
        assert rows(stored.select("STD_NO", F.col("REG_DATE").isNull().alias("bad")), "STD_NO", "bad") == [
            ("a", False), ("b", True)]
    _put(src, "2.json", [_message("c")])
    st.ingest(st.file_messages(spark, str(src), 1), SCHEMA, sink, cp).awaitTermination()
    assert spark.read.schema(SCHEMA).parquet(sink).count() == 3


def test_first_seen_across_batches(spark, tmp_path):
    src = tmp_path / "in"
    _put(src, "1.json", [_message("a"), _message("a"), _message("b")])
    _put(src, "2.json", [_message("a"), _message("c"), _message("c")])
    for within in (None, "1 hour"):
        parsed = stores.from_messages(st.file_messages(spark, str(src), 1), SCHEMA)
        kept = st.first_seen(parsed, ["STD_NO"], "REG_DATE", within)
        out = str(tmp_path / f"out-{within}".replace(" ", ""))
        kept.writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", out + "-cp"
        ).trigger(availableNow=True).start().awaitTermination()
        assert rows(spark.read.parquet(out), "STD_NO") == [("a",), ("b",), ("c",)]


def test_insert_if_absent(spark, tmp_path):
    src, sink = tmp_path / "in", str(tmp_path / "sink")
    _put(src, "1.json", [_message("a", n=2), _message("a", n=1), _message("b", n=3)])
    order = [F.col("N")]

    def run(checkpoint):
        parsed = stores.from_messages(st.file_messages(spark, str(src), 1), SCHEMA)
        st.insert_if_absent(
            parsed, ["STD_NO"], order, sink, str(tmp_path / checkpoint)
        ).awaitTermination()
        return rows(spark.read.parquet(sink), "STD_NO", "N")

    assert run("cp") == [("a", 1), ("b", 3)]
    _put(src, "2.json", [_message("a", n=0), _message("c", n=4)])
    assert run("cp") == [("a", 1), ("b", 3), ("c", 4)]
    assert run("cp") == [("a", 1), ("b", 3), ("c", 4)]
    assert run("fresh-cp") == [("a", 1), ("b", 3), ("c", 4)]


def test_new_checkpoint_over_an_old_sink_keeps_stored_rows(spark, tmp_path):
    sink = str(tmp_path / "sink")
    for i, names in enumerate((["a", "b"], ["c", "a"])):
        _put(tmp_path / f"in{i}", "1.json", [_message(n, n=i) for n in names] + ["not json", ""])
        parsed = stores.from_messages(st.file_messages(spark, str(tmp_path / f"in{i}")), SCHEMA)
        checkpoint = str(tmp_path / f"cp{i}")
        st.insert_if_absent(parsed, ["STD_NO"], [F.col("N")], sink, checkpoint).awaitTermination()
    assert rows(spark.read.parquet(sink), "STD_NO", "N") == [("a", 0), ("b", 0), ("c", 1)]


def test_rejected_messages(spark):
    values = [_message("a", n=1), "not json", "", None, "{}", '{"N": 3}']
    messages = spark.createDataFrame([(v,) for v in values], "value string")
    bad = stores.rejected_messages(messages, SCHEMA, ["STD_NO"])
    assert sorted(r.value for r in bad.collect()) == sorted(["not json", '{"N": 3}'])


def test_repeated_batch_writes_the_same_rows(spark, tmp_path):
    sink = str(tmp_path / "sink")
    stored = []
    src = tmp_path / "in"
    _put(src, "1.json", [_message("a", n=1), _message("a", n=2)])
    for cp in ("cp1", "cp2"):  # a new checkpoint gives the batch the same number again
        parsed = stores.from_messages(st.file_messages(spark, str(src)), SCHEMA)
        st.insert_if_absent(parsed, ["STD_NO"], [F.col("N")], sink, str(tmp_path / cp)).awaitTermination()
        stored.append(rows(spark.read.parquet(sink), "STD_NO", "N"))
    assert stored[0] == stored[1] == [("a", 1)]


def test_a_batch_reads_only_the_buckets_it_touches(spark, tmp_path):
    src, sink = tmp_path / "in", str(tmp_path / "sink")
    names = [f"n{i}" for i in range(40)]

    def run(checkpoint):
        parsed = stores.from_messages(st.file_messages(spark, str(src)), SCHEMA)
        st.insert_if_absent(parsed, ["STD_NO"], [F.col("N")], sink, str(tmp_path / checkpoint), 8).awaitTermination()

    _put(src, "1.json", [_message(n) for n in names])
    run("cp")
    homes = {r.STD_NO: r.bucket for r in spark.read.parquet(sink).collect()}
    assert len(homes) == 40 and len(set(homes.values())) > 4
    # what is stored in any other bucket can't even be read
    for part in (tmp_path / "sink").glob("bucket=*/batch=*/*.parquet"):
        if f"bucket={homes['n0']}" not in str(part):
            part.write_bytes(b"no parquet file")
            part.with_name(f".{part.name}.crc").unlink()
    keys = st.known_keys(spark, sink, SCHEMA, ["STD_NO"], [homes["n0"]], "other")
    assert sorted(r.STD_NO for r in keys.collect()) == sorted(n for n in names if homes[n] == homes["n0"])
    plan = keys._jdf.queryExecution().sparkPlan().toString()
    assert "(bucket#" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    _put(src, "2.json", [_message("n0", n=0)])
    run("cp")
    stored = spark.read.parquet(f"{sink}/bucket={homes['n0']}")
    assert rows(stored, "STD_NO", "N") == sorted((n, 1) for n in names if homes[n] == homes["n0"])


def test_every_message_arrives_or_is_rejected_once(spark, tmp_path):
    src, sink, bad = tmp_path / "in", str(tmp_path / "sink"), str(tmp_path / "bad")
    _put(src, "1.json", [_message("a"), "not json", "", "{}", '{"N": 3}', "[1]", '{"STD_NO": "x"'])
    for turn in range(2):
        for _ in range(2):
            st.ingest_or_reject(
                st.file_messages(spark, str(src), 1), SCHEMA, ["STD_NO"], sink, bad, str(tmp_path / "cp")
            ).awaitTermination()
        _put(src, "2.json", [_message("b"), "null", "also not json"])
    assert rows(spark.read.schema(SCHEMA).parquet(sink), "STD_NO") == [("a",), ("b",)]
    assert [v for v, in rows(spark.read.schema("value string").parquet(bad), "value")] == sorted(
        ["not json", '{"N": 3}', "[1]", '{"STD_NO": "x"', "also not json"]
    )


def test_plain_ingest_keeps_no_row_of_malformed_messages(spark, tmp_path):
    _put(tmp_path / "in", "1.json", [_message("a"), "not json", '{"other": 1}'])
    st.ingest(st.file_messages(spark, str(tmp_path / "in")), SCHEMA, str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
    assert rows(spark.read.schema(SCHEMA).parquet(str(tmp_path / "s")), "STD_NO") == [("a",)]


def test_results_of_saved_students_are_replaced(spark, tmp_path):
    from pathkin.session import Workspace

    def save(data):
        with Workspace(spark) as workspace:
            df = spark.createDataFrame(data, "QUERY_STD string, Rank int")
            stores.replace_results(df, str(tmp_path), "R", "QUERY_STD", workspace, buckets=3)
        back = stores.read_results(spark, str(tmp_path), "R", df.schema)
        return rows(back, "QUERY_STD", "Rank")

    first = [(f"s{i}", r) for i in range(10) for r in (1, 2)]
    assert save(first) == sorted(first)
    again = [("s3", 7), ("new", 1), (None, 1)]
    want = sorted([x for x in first if x[0] != "s3"] + again[:2])
    assert save(again) == want
    assert save(again) == want
    assert save([]) == want


@pytest.fixture(scope="module")
def raw(spark):
    def frame(name, data):
        return spark.createDataFrame(data, COLLECTIONS[name])

    none = None
    return {
        "V_STD_CDP_SREG": frame("V_STD_CDP_SREG", [
            (s, none, "D", "남성", "N", 1, "C", "d") for s in ("q", "n")]),
        "V_STD_CDP_PASSCURI": frame("V_STD_CDP_PASSCURI", [
            ("q", "D", "x", "x1", 1, "C"), ("n", "D", "x", "x1", 1, "C"), ("n", "D", "y", "y1", 1, "C")]),
        "CPS_STAR_POINT": frame("CPS_STAR_POINT", [("n", "y1", 4.0, "C"), ("n", "p1", 3.0, "N")]),
        "CPS_NCR_PROGRAM_INFO": frame("CPS_NCR_PROGRAM_INFO", [("p1", "area")]),
        "CPS_NCR_PROGRAM_STD": frame("CPS_NCR_PROGRAM_STD", [("n", "e1", "p1", "NCR_T07_P05")]),
        "CPS_OUT_ACTIVITY_MNG": frame("CPS_OUT_ACTIVITY_MNG", [
            ("n", "OAMTYPCD01", "cert"), ("n", "OAMTYPCD03", "help"), ("n", "OAMTYPCD03", "help2")]),
        "CPS_GRADUATE_CORP_INFO": frame("CPS_GRADUATE_CORP_INFO", [("n", "D", "남", "k", "Co")]),
        "CPS_RATING": frame("CPS_RATING", [("Co", "5", "8")]),
        "CPS_SCHOOL_EMPLOY_STD_INFO": frame("CPS_SCHOOL_EMPLOY_STD_INFO", []),
        "CPS_SCHOOL_EMPLOY_INFO": frame("CPS_SCHOOL_EMPLOY_INFO", []),
        "CPS_EMPLOY_SEARCH_HIS": frame("CPS_EMPLOY_SEARCH_HIS", []),
    }


def test_collections_to_recommendation(spark, raw, tmp_path):
    root = str(tmp_path / "store")
    for name, df in raw.items():
        stores.write_collection(df, root, name, "overwrite", namespace="school")
    tables = stores.load_collections(spark, root, list(raw), register=True, namespace="school")
    assert spark.table("CPS_RATING").count() == 1
    got = rc.recommend(Domain.from_collections(tables), users(spark, "q")).collect()
    assert len(got) == 1
    row = got[0].asDict()
    assert row == {
        "query_std": "q", "Rank": 1, "SBJT_KEY_CD": "y1", "NPI_KEY_ID": "p1", "OAMTYPCD01": "cert",
        "OAMTYPCD02": None, "OAMTYPCD03_AVG": 2, "OAMTYPCD04_AVG": None, "OAMTYPCD05_AVG": None,
    }
