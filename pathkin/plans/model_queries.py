"""Queries that fit a model or run a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.errors import StreamingQueryException
from pyspark.sql import types as T

from pathkin.functions.scalars import date_to_text, mean_star
from pathkin.operators import evaluate as ev
from pathkin.operators import learn
from pathkin.plans.testdata import TABLES, load_domain, query_students, table
from pathkin.session import scratch_path, stage
from pathkin.sources import stores
from pathkin.streaming import ingest as st

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ---- models -------------------------------------------------------------------------------


SHARES = [0.8, 0.2]


def _stars(spark, sf):
    """std_no, item, rating: each student's mean star of each item."""
    return (
        load_domain(spark, sf)
        .ratings.groupBy("std_no", "item")
        .agg(mean_star(F.col("star")).alias("rating"))
    )


class _Factors:
    """Star table, its split and a factor model over distributed row numbers of the text ids."""

    def __init__(self, spark, sf):
        self.stars = stage(_stars(spark, sf), "stars")
        self.users = stage(learn.indexed(self.stars, "std_no").withColumnRenamed("index", "user"), "users")
        self.items = stage(learn.indexed(self.stars, "item").withColumnRenamed("index", "thing"), "items")
        known = self.stars.join(self.users, "std_no").join(self.items, "item")
        self.train, self.test = learn.split(known, ["std_no", "item"], SHARES)
        self.model = learn.fit_als(self.train, "user", "thing", "rating")


@query
def random_split_sizes(spark, sf):
    """How many star rows each part of a split holds."""
    parts = learn.split(_stars(spark, sf), ["std_no", "item"], [0.6, 0.4])
    sizes = [p.agg(F.count("*").alias("n")).select(F.lit(i).alias("part"), "n") for i, p in enumerate(parts)]
    return sizes[0].unionByName(sizes[1])


def _summary(best: DataFrame, key: str, other: str) -> DataFrame:
    """Per asked id: how many are returned, the last rank, how many differ, scores never rising with the rank."""
    before = F.lag("score").over(Window.partitionBy(key).orderBy("rank"))
    return best.withColumn("_rises", F.coalesce(F.col("score") > before, F.lit(False))).groupBy(key).agg(
        F.count("*").alias("n"),
        F.max("rank").alias("last_rank"),
        F.count_distinct(other).alias("different"),
        (~F.bool_or("_rises")).alias("falling"),
    )


@query
def als_topk(spark, sf):
    """The 10 best items of the asking students: whole, ranked from 1, best first."""
    fitted = _Factors(spark, sf)
    asking = query_students(load_domain(spark, sf)).join(fitted.users, "std_no")
    best = stage(learn.top_items(fitted.model, asking.select("user")), "best")
    out = _summary(best, "user", "item").join(fitted.users, "user")
    return out.select("std_no", "n", "last_rank", "different", "falling")


@query
def als_top_users(spark, sf):
    """The 10 best students of every tenth item code."""
    fitted = _Factors(spark, sf)
    asked = fitted.items.filter(F.col("item").endswith("0")).select(F.col("thing").alias("item"))
    best = stage(learn.top_users(fitted.model, asked), "best")
    out = _summary(best, "item", "user").withColumnRenamed("item", "thing").join(fitted.items, "thing")
    return out.select("item", "n", "last_rank", "different", "falling")


@query
def als_rmse(spark, sf):
    """Predictions are whole, and nearer to the stars they were fitted to than the mean star is."""
    fitted = _Factors(spark, sf)
    error = lambda df, column: ev.rmse(df, "rating", column).first()["rmse"]
    mean = fitted.train.agg(F.avg("rating")).first()[0]
    predicted = fitted.model.transform(fitted.train)
    better = error(predicted, "prediction") < error(fitted.train.withColumn("mean", F.lit(mean)), "mean")
    return fitted.model.transform(fitted.train).agg(
        F.count("prediction").alias("n"), F.lit(better).alias("nearer_than_mean")
    )


def _model_facts(model, train: DataFrame, test: DataFrame, classes: int) -> DataFrame:
    """Test rows scored, whether scores are probabilities, and whether the fit is no worse than the usual class."""
    most = train.groupBy("label").count().agg(F.max("count") / F.sum("count")).first()[0]
    fitted = learn.model_accuracy(model, train).first()["accuracy"]
    return learn.scored(model, test).agg(
        F.count("*").alias("n"),
        F.every((F.col("score") >= 0) & (F.col("score") <= 1)).alias("probabilities"),
        F.every((F.col("prediction") >= 0) & (F.col("prediction") < classes)).alias("known_classes"),
        F.lit(fitted >= most).alias("as_good_as_usual"),
    )


@query
def logistic_accuracy(spark, sf):
    """Two classes: document quality from its length and toxicity."""
    from pyspark.ml.feature import VectorAssembler

    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    rows = table(spark, sf, "labels").join(docs, "doc_id").withColumnRenamed("quality", "label")
    rows = VectorAssembler(inputCols=["n_chars", "toxic"], outputCol="features").transform(rows)
    train, test = learn.split(rows, ["doc_id"], [0.6, 0.4])
    return _model_facts(learn.fit_logistic(train), train, test, 2)


@query
def logistic_multiclass(spark, sf):
    """Several classes: the label of a vector from its values."""
    from pyspark.ml.functions import array_to_vector

    rows = table(spark, sf, "embeddings").select("vec_id", "label", array_to_vector("embedding").alias("features"))
    train, test = learn.split(rows, ["vec_id"], [0.6, 0.4])
    return _model_facts(learn.fit_logistic(train, iterations=20), train, test, 10)


# ---- streams ------------------------------------------------------------------------------

MESSAGE = (
    T.StructType()
    .add("event_id", "long")
    .add("REG_DATE", "timestamp")
    .add("user_id", "long")
    .add("event_type", "string")
)


def _message_stream(spark, sf):
    """The events as a stream of JSON messages."""
    events = spark.readStream.schema(TABLES["events"]).option("pathGlobFilter", "events.parquet").parquet(sf)
    return stores.to_messages(
        events.select("event_id", F.col("ts").alias("REG_DATE"), "user_id", "event_type")
    )


def _run(stream) -> None:
    stream.awaitTermination()


@query
def stream_ingest(spark, sf):
    sink = scratch_path(spark, "ingest")
    _run(st.ingest(_message_stream(spark, sf), MESSAGE, sink, sink + "-checkpoint"))
    rows = spark.read.schema(MESSAGE).parquet(sink)
    return rows.select("event_id", date_to_text(F.col("REG_DATE")).alias("reg_text"), "event_type")


@query
def stream_dedupe(spark, sf):
    """The distinct users of the stream, kept by state."""
    sink = scratch_path(spark, "dedupe")
    users = stores.from_messages(_message_stream(spark, sf), MESSAGE).select("user_id", "event_type")
    stream = (
        st.first_seen(users, ["user_id", "event_type"])
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", sink + "-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    _run(stream)
    return spark.read.parquet(sink).select("user_id", "event_type")


@query
def stream_rejects(spark, sf):
    """Each tenth message is cut short, another tenth lacks its key and another is empty."""
    sink = scratch_path(spark, "ingest")
    kind = F.col("event_id") % 10
    events = spark.readStream.schema(TABLES["events"]).option("pathGlobFilter", "events.parquet").parquet(sf)
    keyed = F.concat(F.lit('{"event_id":'), F.col("event_id"), F.lit(',"event_type":"'), F.col("event_type"), F.lit('"}'))
    lost = F.concat(F.lit('{"event_type":"'), F.col("event_type"), F.lit(' '), F.col("event_id"), F.lit('"}'))
    cut = F.concat(F.lit('{"event_id":'), F.col("event_id"), F.lit(',"event_'))
    value = F.when(kind == 0, cut).when(kind == 1, lost).when(kind == 2, "{}").otherwise(keyed)
    _run(st.ingest_or_reject(
        events.select(value.alias("value")), MESSAGE, ["event_id", "event_type"], sink, sink + "-rejects", sink + "-checkpoint"
    ))
    good = spark.read.schema(MESSAGE).parquet(sink).select(F.lit("row").alias("what"), F.concat_ws(" ", "event_id", "event_type").alias("value"))
    bad = spark.read.schema("value string").parquet(sink + "-rejects").select(F.lit("reject").alias("what"), "value")
    return good.unionByName(bad)


@query
def stream_resume(spark, sf):
    """Throttled to a file a batch, stopped after some batches and resumed from the checkpoint."""
    source, sink = scratch_path(spark, "messages"), scratch_path(spark, "resumed")
    events = table(spark, sf, "events").select("event_id", F.col("ts").alias("REG_DATE"), "user_id", "event_type")
    stores.to_messages(events).repartition(6).write.text(source)
    throttled = lambda: st.file_messages(spark, source, files_per_trigger=1)
    batches = []

    def fail_at_third(batch, name):
        batches.append(name)
        if len(batches) == 3:
            raise RuntimeError("stopped between two batches")
        stores.from_messages(batch, MESSAGE).write.mode("overwrite").parquet(f"{sink}/batch={name}")

    stopped = st.foreach_batch(throttled(), fail_at_third, sink + "-checkpoint")
    try:
        stopped.awaitTermination()
    except StreamingQueryException:
        pass  # the stop asked for
    _run(st.foreach_batch(throttled(), fail_at_third, sink + "-checkpoint"))
    if len(batches) < 6 or batches[2] != batches[3]:
        raise RuntimeError("the stream didn't go on with the batch it was stopped at")
    return spark.read.schema(MESSAGE).parquet(sink).select("event_id", date_to_text(F.col("REG_DATE")).alias("reg_text"), "event_type")


@query
def stream_insert_if_absent(spark, sf):
    """First event of each user, inserted once although the stream is replayed."""
    sink = scratch_path(spark, "absent")
    order = [F.col("REG_DATE"), F.col("event_id")]
    for attempt in range(2):
        rows = stores.from_messages(_message_stream(spark, sf), MESSAGE)
        _run(st.insert_if_absent(rows, ["user_id"], order, sink, f"{sink}-{attempt}"))
    return spark.read.parquet(sink).select("user_id", "event_id", "event_type")
