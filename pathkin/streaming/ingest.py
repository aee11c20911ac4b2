"""Message streams into stored collections."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pathkin.operators.relational import keep_last
from pathkin.sources.stores import bucket_of, decoded, exists, from_messages, write_buckets


def file_messages(spark: SparkSession, path: str, files_per_trigger: int | None = None):
    """Stream of ``value`` text lines from files; the cap per trigger is the throttle."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.load(path)


def topic_messages(
    spark: SparkSession, servers: str, topic: str, offsets_per_trigger: int | None = None
) -> DataFrame:
    """Stream of ``value`` from a topic, from its earliest message.

    Progress is kept in the checkpoint, in place of a consumer group's commits.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(offsets_per_trigger))
    return reader.load().select(F.col("value").cast("string").alias("value"))


def ingest(messages: DataFrame, schema: T.StructType, sink: str, checkpoint: str) -> StreamingQuery:
    """Decode messages, restore dates and append every record to the sink."""
    return (
        from_messages(messages, schema)
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def ingest_or_reject(
    messages: DataFrame, schema: T.StructType, key: list[str], sink: str, rejects: str, checkpoint: str
) -> StreamingQuery:
    """Records go to ``sink``, malformed messages and those without key to ``rejects``.

    A batch is read and parsed once and writes a folder of its own, named by stream and
    batch number, in both places. A batch that is repeated after a failure replaces
    its folders, so every message arrives in one of the two exactly once.
    """

    def write(batch: DataFrame, name: str) -> None:
        batch = batch.persist()
        try:
            for rows, place in (
                (batch.filter("ok").select(*schema.fieldNames()), sink),
                (batch.filter(~F.col("ok")).select("value"), rejects),
            ):
                rows.write.mode("overwrite").parquet(f"{place}/batch={name}")
        finally:
            batch.unpersist()

    return foreach_batch(decoded(messages, schema, key), write, checkpoint)


def first_seen(
    rows: DataFrame, key: list[str], event_time: str | None = None, within: str | None = None
) -> DataFrame:
    """Pass on the first row of each key.

    Keys stay in the state store for ever, or for ``within`` of event time if both
    options are given. The key is a person or record number, so state is spread
    evenly however hot one key is.
    """
    if event_time and within:
        return rows.withWatermark(event_time, within).dropDuplicatesWithinWatermark(key)
    return rows.dropDuplicates(key)


def insert_if_absent(
    rows: DataFrame,
    key: list[str],
    order: list[Column],
    sink: str,
    checkpoint: str,
    buckets: int = 256,
) -> StreamingQuery:
    """Insert rows whose key is not in the sink yet; the earliest row of a batch wins.

    The sink is partitioned by a hash of the key, and a batch reads the keys of the
    buckets it touches only; nothing is kept in state. Inside a bucket every batch has
    a folder of its own and looks only at other batches' folders, so a batch that is
    repeated after a failure writes the same rows again. The folder is named by the
    stream's id, which Spark keeps in the checkpoint, and the batch number: a stream
    with a new checkpoint has a new id and never writes over what another stream has
    stored. Rows without a key are left out; see ``rejected_messages``. The number of
    buckets of a sink must not change.
    """

    def write(batch: DataFrame, name: str) -> None:
        spark = batch.sparkSession
        fresh = keep_last(batch.dropna(subset=key), key, order).withColumn("bucket", bucket_of(key, buckets))
        if exists(spark, sink):
            touched = [r.bucket for r in fresh.select("bucket").distinct().collect()]  # at most ``buckets``
            fresh = fresh.join(known_keys(spark, sink, batch.schema, key, touched, name), key, "left_anti")
        write_buckets(fresh.withColumn("batch", F.lit(name)), sink, ["bucket", "batch"])

    return foreach_batch(rows, write, checkpoint)


def known_keys(
    spark: SparkSession, sink: str, schema: T.StructType, key: list[str], touched: list[int], batch: str
) -> DataFrame:
    """The keys other batches have stored in some buckets."""
    stored = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("batch", T.StringType())])
    at = F.col("bucket").isin(touched) & (F.col("batch") != batch)
    return spark.read.schema(stored).parquet(sink).filter(at).select(*key)


def foreach_batch(
    rows: DataFrame, write: Callable[[DataFrame, str], None], checkpoint: str
) -> StreamingQuery:
    """``write(batch, name)`` for every batch, named by the stream's id and the batch number."""
    started: Future[str] = Future()

    def run(batch: DataFrame, batch_id: int) -> None:
        write(batch, f"{started.result()}_{batch_id}")

    stream = (
        rows.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.set_result(str(stream.id))
    return stream
