"""Readers and writers for collections, databases, files and messages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathkin.functions.scalars import date_to_text, text_to_date
from pathkin.session import Workspace
from pathkin.sources.schemas import COLLECTIONS, RATING_HEADER


def _address(root: str, namespace: str | None, name: str) -> str:
    return "/".join(p for p in (root.rstrip("/"), namespace, name) if p)


def read_collection(
    spark: SparkSession,
    root: str,
    name: str,
    namespace: str | None = None,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """One collection with its explicit schema; ``fmt`` is any installed source."""
    reader = spark.read.format(fmt).schema(schema or COLLECTIONS[name]).options(**options)
    if fmt == "mongodb":
        return reader.option("database", namespace).option("collection", name).load()
    return reader.load(_address(root, namespace, name))


def write_collection(
    df: DataFrame,
    root: str,
    name: str,
    mode: str = "append",
    namespace: str | None = None,
    fmt: str = "parquet",
    **options: str,
) -> None:
    """Append to or overwrite a collection."""
    writer = df.write.format(fmt).mode(mode).options(**options)
    if fmt == "mongodb":
        writer.option("database", namespace).option("collection", name).save()
    else:
        writer.save(_address(root, namespace, name))


def load_collections(
    spark: SparkSession, root: str, names: list[str], register: bool = False, **kwargs
) -> dict[str, DataFrame]:
    """Several collections by name, optionally as temporary views."""
    frames = {name: read_collection(spark, root, name, **kwargs) for name in names}
    if register:
        for name, df in frames.items():
            df.createOrReplaceTempView(name)
    return frames


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options for a whole-table extract read in parallel ranges of one column.

    Reading in one piece is an explicit choice, ``partitions=1``; otherwise the column,
    its bounds and the number of ranges must be given.
    """
    ranged = partition_column and bounds and partitions
    if partitions != 1 and not ranged:
        raise ValueError("give partition_column, bounds and partitions, or partitions=1")
    out = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if ranged:
        out |= {
            "partitionColumn": partition_column,
            "lowerBound": bounds[0],
            "upperBound": bounds[1],
            "numPartitions": str(partitions),
        }
    return out


def extract_table(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """``SELECT *`` of one table. User and password come from Spark's own options."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()


def read_company_ratings(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """The rating file: padded headings and values, quoted thousands separators."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in RATING_HEADER])
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("encoding", encoding)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    whole = lambda c: F.regexp_replace(F.trim(F.col(f"`{c}`")), ",", "").try_cast("int")
    return raw.select(
        whole("No").alias("no"),
        F.col("기업형태").alias("company_type"),
        F.trim("기업명").alias("company"),
        whole("직원수").alias("headcount"),
        F.col("업종").alias("sector"),
        F.col("소재지").alias("location"),
        whole("기업가중치").alias("w_company"),
        whole("직원수 가중치").alias("w_headcount"),
    )


def read_libsvm(spark: SparkSession, path: str, features: int) -> DataFrame:
    """label, features; the feature count is given so the file is not scanned for it."""
    return spark.read.format("libsvm").option("numFeatures", str(features)).load(path)


def parse_delimited(
    lines: DataFrame, text: str, names: list[str], kinds: list[str], separator: str = "::"
) -> tuple[DataFrame, DataFrame]:
    """Split text records; records of the wrong width or type go to the second frame."""
    parts = F.split(F.col(text), separator)
    fields = [
        F.get(F.col("_p"), i).try_cast(kind).alias(name)
        for i, (name, kind) in enumerate(zip(names, kinds))
    ]
    split = lines.select(text, parts.alias("_p")).select(text, F.size("_p").alias("_n"), *fields)
    good = F.col("_n") == len(names)
    for name in names:
        good = good & F.col(name).isNotNull()
    return split.filter(good).select(*names), split.filter(~good).select(text)


def _message_value(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return date_to_text(F.col(field.name)).alias(field.name)
    if isinstance(field.dataType, T.BinaryType):
        return F.decode(F.col(field.name), "UTF-8").alias(field.name)
    return F.col(field.name)


def to_messages(df: DataFrame) -> DataFrame:
    """value: each row as a JSON object, date-times and large objects as text."""
    return df.select(
        F.to_json(F.struct(*[_message_value(f) for f in df.schema.fields])).alias("value")
    )


def _filled(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("value").isNotNull() & ~F.trim("value").isin("", "null", "{}"))


def _is_record(row: Column, schema: T.StructType, key: list[str]) -> Column:
    """A JSON object with all key columns; without a key, with some column."""
    held = [row[k].isNotNull() for k in key or schema.fieldNames()]
    join = (lambda a, b: a & b) if key else (lambda a, b: a | b)
    return reduce(join, held)


def decoded(messages: DataFrame, schema: T.StructType, key: list[str] = []) -> DataFrame:
    """value, ok and the columns of ``schema`` of all non-empty messages, parsed once.

    A column whose name contains ``DATE`` is parsed from its text form and is null
    where the text is not a date; other columns take the type in ``schema``. ``ok`` is
    false for what is no JSON object, lacks a key column or has none of the columns.
    """
    wire = T.StructType(
        [T.StructField(f.name, T.StringType() if "DATE" in f.name else f.dataType) for f in schema.fields]
    )
    parsed = _filled(messages).select(
        "value", F.from_json(F.col("value").cast("string"), wire).alias("r")
    )
    columns = [
        (text_to_date(F.col("r")[f.name]) if "DATE" in f.name else F.col("r")[f.name]).alias(f.name)
        for f in schema.fields
    ]
    return parsed.select("value", _is_record(F.col("r"), schema, key).alias("ok"), *columns)


def from_messages(messages: DataFrame, schema: T.StructType, key: list[str] = []) -> DataFrame:
    """Rows of the messages that hold a record; see ``decoded``."""
    return decoded(messages, schema, key).filter("ok").select(*schema.fieldNames())


def rejected_messages(messages: DataFrame, schema: T.StructType, key: list[str] = []) -> DataFrame:
    """The non-empty messages that ``from_messages`` leaves out."""
    return decoded(messages, schema, key).filter(~F.col("ok")).select("value")


def replace_results(
    df: DataFrame, root: str, name: str, key: str, workspace: Workspace, buckets: int = 64, namespace: str | None = None
) -> None:
    """Store results with their asking student; those of the students in ``df`` are replaced.

    The stored table is partitioned by a hash of ``key``. Only the buckets of the
    students saved are read, merged and overwritten; rows of all other students in
    them stay. The merged rows are written to the workspace first, so that a bucket is
    never read while it is replaced. ``key`` must not be null. A student without
    rows in ``df`` keeps the stored ones.
    """
    spark = df.sparkSession
    path = _address(root, namespace, name)
    fresh = workspace.stage(df.filter(F.col(key).isNotNull()).withColumn("bucket", bucket_of([key], buckets)), "fresh")
    if exists(spark, path):
        touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets``
        stored = spark.read.schema(fresh.schema).parquet(path).filter(F.col("bucket").isin(touched))
        kept = stored.join(fresh.select(key).distinct(), key, "left_anti")
        fresh = workspace.stage(fresh.unionByName(kept), "merged")
    write_buckets(fresh, path, ["bucket"])


def read_results(spark: SparkSession, root: str, name: str, schema: T.StructType | str, namespace: str | None = None) -> DataFrame:
    """Stored results without their bucket."""
    return spark.read.schema(schema).parquet(_address(root, namespace, name)).drop("bucket")


def bucket_of(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, by: list[str]) -> None:
    """Write partitions; those that ``df`` has rows for are replaced, all others stay."""
    df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)


def publish(df: DataFrame, target: str, fmt: str = "text", topic: str | None = None, **options):
    """Write messages to files, or to a topic with ``fmt="kafka"``."""
    writer = to_messages(df).write.format(fmt).mode("append").options(**options)
    if fmt == "kafka":
        writer.option("kafka.bootstrap.servers", target).option("topic", topic).save()
    else:
        writer.save(target)
