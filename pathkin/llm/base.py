"""What the text operators share: tables, fold, shipping the package to the workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the workers this package, as ``spark-submit --py-files`` would."""
    if spark.conf.get("pathkin.shipped", None) == spark.sparkContext.applicationId:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="pathkin-ship-"), "pathkin_files.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(PACKAGE):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(PACKAGE)))
    spark.sparkContext.addPyFile(archive)
    spark.conf.set("pathkin.shipped", spark.sparkContext.applicationId)


_table: list = [None, None]


def worker_table(key, make):
    """What a worker keeps from task to task: the table of one operator, made when its key is new.

    Spark hands a worker on from one operator to the next, so another's table goes first.
    """
    if _table[0] != key:
        _table[:] = None, None
        _table[:] = key, make()
    return _table[1]


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds


def whole_text(docs: DataFrame) -> Column:
    """The text column, empty where it is null."""
    return F.coalesce(docs["text"], F.lit(""))


def labelled_sample(
    spark: SparkSession, sf_dir: str, label: str, per_class: int, max_chars: int | None = None
) -> DataFrame:
    """Texts and labels of at most ``per_class`` training rows of each class.

    Training rows are those outside fold 0. The sample is the first rows in the
    order of a hash of the id, so it is the same on every run. ``labels`` rows
    that repeat an id or hold a null take no part.
    """
    labels = (
        table(spark, sf_dir, "labels")
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)")
        .where(fold(F.col("doc_id")) != 0)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"), F.min("label").alias("other"))
        .where("label = other")
        .drop("other")
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = None
    for value in (0, 1):
        part = labels.where(F.col("label") == value).orderBy(*order).limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", whole_text(docs).alias("text"))
    if max_chars:
        docs = docs.where(F.length("text") <= max_chars)
    # at most 2 * per_class narrow rows: the sample's bound is the broadcast's bound
    return docs.join(F.broadcast(picked), "doc_id")


def meet(index: DataFrame, asked: DataFrame, on: list[str]) -> DataFrame:
    """Equi-join of blocks with the blocks that ask them; both sides are shuffled.

    Spark judges repeated or packed blocks by the size of the table they come from, and
    would send all the copies to the driver for a broadcast.
    """
    return index.join(asked.hint("merge"), on)
