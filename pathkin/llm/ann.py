"""Approximate nearest neighbours by an adaptive dimension scan of inverted lists.

Vectors are scaled to length one, rotated by a fixed random rotation and dealt to
the list of their nearest centre; centres are fitted by k-means on a sample of
at most ``sample_rows`` rows (the first in the order of a hash of the id). A list
is dealt by a hash of the id over chunks of about ``chunk_rows``, each held as column
blocks, and queries come in blocks of about ``query_rows``. A query probes its
nearest lists. In a chunk the partial distance over the first column blocks is
tested: a candidate is abandoned once ``partial * dims / seen`` exceeds
``limit * (1 + epsilon / sqrt(seen)) ** 2``, where the limit is the k-th best exact
distance among the candidates that look nearest after the first block (16 k of them). What is
left is scored by its exact cosine on the original vectors.

Lists are at most ``max_lists``, so centres and chunk counts have a fixed bound.
Chunks of one list go to up to ``spread`` different tasks. Vectors null, empty, zero or holding null
or non-finite components take no part, nor do vectors whose length is not that of
most sample rows. Rows repeated in id and vector count once.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pathkin.llm.base import meet, ship, table
from pathkin.session import stage


def k_means(x: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = (x @ centres.T).argmax(axis=1)
        for j in range(len(centres)):
            if (mine := x[near == j]).size:
                total = mine.sum(axis=0)
                centres[j] = total / max(np.linalg.norm(total), 1e-12)
    return centres


def scan(blocks: list[np.ndarray], query: np.ndarray, k: int, epsilon: float) -> np.ndarray:
    """Rows of a chunk that the tests keep; ``blocks`` hold (columns, rows)."""
    dims = sum(len(b) for b in blocks)
    rows = np.arange(blocks[0].shape[1])
    partial = ((blocks[0] - query[: len(blocks[0]), None]) ** 2).sum(axis=0)
    seen = len(blocks[0])
    if len(rows) <= k:
        return rows
    trial = min(len(rows), 16 * k)
    first = np.argpartition(partial, trial - 1)[:trial]
    exact, at = partial[first].copy(), seen
    for block in blocks[1:]:
        exact += ((block[:, first] - query[at : at + len(block), None]) ** 2).sum(axis=0)
        at += len(block)
    limit = np.partition(exact, k - 1)[k - 1]
    for block in blocks[1:]:
        keep = partial * (dims / seen) <= limit * (1 + epsilon / math.sqrt(seen)) ** 2
        rows, partial = rows[keep], partial[keep]
        partial = partial + ((block[:, rows] - query[seen : seen + len(block), None]) ** 2).sum(axis=0)
        seen += len(block)
    return rows[partial <= limit * (1 + 1e-9)]


def unit_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
        .where("id is not null and size(v) > 0")
        .where(finite & F.exists(v, lambda c: c != 0))
        .dropDuplicates(["id", "v"])
    )


def _stack(cells) -> tuple[np.ndarray, np.ndarray]:
    x = np.array([np.asarray(c, dtype=np.float64) for c in cells])
    return x, x / np.linalg.norm(x, axis=1, keepdims=True)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    probe_share: float = 0.6,
    sample_rows: int = 8192,
    max_lists: int = 4096,
    chunk_rows: int = 4096,
    query_rows: int = 1024,
    block_dims: int = 16,
    epsilon: float = 2.1,
    spread: int = 16,
) -> DataFrame:
    """query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    ship(spark)
    # chosen by the tasks and stored: else each partition sends so many rows to the driver
    first = stage(vectors.orderBy(F.xxhash64("id"), "id").limit(sample_rows), "ann-sample")
    sample = [r.v for r in first.collect()]
    schema = "query_id long, rank int, vec_id long, score double"
    if not sample:
        return spark.createDataFrame([], schema)
    lengths, counts = np.unique([len(v) for v in sample], return_counts=True)
    dims = int(lengths[counts.argmax()])
    vectors, queries = (d.where(F.size("v") == dims) for d in (vectors, queries))
    unit = _stack([v for v in sample if len(v) == dims])[1]
    rotation = np.linalg.qr(np.random.default_rng(11).standard_normal((dims, dims)))[0]
    lists = max(1, min(max_lists, int(math.sqrt(len(unit)))))
    centres = k_means(unit @ rotation, lists)
    probes = max(1, math.ceil(probe_share * len(centres)))

    def assign(batches):
        for batch in batches:
            batch["list_id"] = (_stack(batch["v"])[1] @ rotation @ centres.T).argmax(axis=1).astype(np.int32)
            yield batch

    placed = stage(vectors.mapInPandas(assign, "id long, v array<double>, list_id int"), "ann-lists")
    # a list is dealt over as many slots as it fills chunks: one row a list, so at most max_lists rows
    slots = placed.groupBy("list_id").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("slots"))
    dealt = (
        placed.join(slots, "list_id")
        .withColumn("slot", F.pmod(F.xxhash64("id"), F.col("slots")).cast("int"))
        .drop("slots")
        .repartition("list_id", "slot")
        .sortWithinPartitions("list_id", "slot")
    )

    def build(batches):
        held, now = [], None

        def pack():
            ids, cells = zip(*held)
            x, u = _stack(cells)
            row = (*now, len(ids), np.array(ids, dtype=np.int64).tobytes(), x.tobytes(), (u @ rotation).T.tobytes())
            held.clear()
            return pd.DataFrame([row], columns=["list_id", "slot", "n", "ids", "vectors", "columns_"])

        for batch in batches:
            for j, slot, key, cell in zip(batch["list_id"].tolist(), batch["slot"].tolist(), batch["id"], batch["v"]):
                if held and ((j, slot) != now or len(held) == 2 * chunk_rows):
                    yield pack()
                now = (j, slot)
                held.append((key, cell))
        if held:
            yield pack()

    chunks = dealt.mapInPandas(build, "list_id int, slot int, n int, ids binary, vectors binary, columns_ binary")
    index = stage(chunks, "ann-index")

    def ask(batches):
        for batch in batches:
            x, u = _stack(batch["v"])
            u = u @ rotation
            order = np.argsort(-(u @ centres.T), axis=1, kind="stable")[:, :probes]
            ids = batch["id"].to_numpy(dtype=np.int64)
            rows = []
            for j in np.unique(order):
                mine = (order == j).any(axis=1)
                rows.append((int(j), ids[mine].tobytes(), x[mine].tobytes(), u[mine].tobytes()))
            yield pd.DataFrame(rows, columns=["list_id", "q_ids", "q_vectors", "q_rotated"])

    # queries are asked in blocks of about query_rows
    blocks = max(1, math.ceil(queries.count() / query_rows))
    blocked = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))).repartition("block").drop("block")
    asked = blocked.mapInPandas(ask, "list_id int, q_ids binary, q_vectors binary, q_rotated binary")
    # a long list lies in up to ``spread`` buckets, and what asks it comes once for each
    dealt_to = F.least(F.col("slots"), F.lit(spread))
    asked = (
        asked.join(slots, "list_id")
        .withColumn("bucket", F.explode(F.sequence(F.lit(0), dealt_to - 1)))
        .drop("slots")
    )
    bucketed = index.withColumn("bucket", F.pmod("slot", F.lit(spread)))
    pairs = meet(bucketed, asked, ["list_id", "bucket"]).select(
        "ids", "vectors", "columns_", "q_ids", "q_vectors", "q_rotated"
    )

    def search(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                ids = np.frombuffer(row.ids, dtype=np.int64)
                x = np.frombuffer(row.vectors).reshape(-1, dims)
                columns = np.frombuffer(row.columns_).reshape(dims, -1)
                blocks = [columns[i : i + block_dims] for i in range(0, dims, block_dims)]
                norms = np.linalg.norm(x, axis=1)
                q_ids = np.frombuffer(row.q_ids, dtype=np.int64)
                for key, q, r in zip(
                    q_ids,
                    np.frombuffer(row.q_vectors).reshape(-1, dims),
                    np.frombuffer(row.q_rotated).reshape(-1, dims),
                ):
                    # one more, for the query's own row
                    rows = scan(blocks, r, k + int((ids == key).sum()), epsilon)
                    rows = rows[ids[rows] != key]
                    scores = (x[rows] @ q) / (norms[rows] * np.linalg.norm(q))
                    best = np.lexsort((ids[rows], -scores))[:k]
                    out += [(int(key), int(ids[rows[i]]), float(scores[i])) for i in best]
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = pairs.mapInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op5_adaptive_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = unit_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return nearest(vectors, vectors.where("id % 50 = 0"), k=5)
