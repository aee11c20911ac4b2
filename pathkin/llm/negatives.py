"""Hard negatives from exact scores by residue arithmetic.

Components are whole numbers. A block of anchors meets a block of rows in float32
matrix products of residues modulo small primes, few enough dimensions at a time
that every partial sum is exact in 24 bits. Chinese remaindering puts the signed
64-bit scores together; as many primes are taken as the blocks' longest vectors
ask for. Selection then goes by score windows: first the anchor's best rows of its
own label (positives), then, for every positive, the best rows of other labels
whose score lies between two shares of the positive's.

Rows are a written table of blocks, anchors travel in blocks and meet every row
block through an equi-join on a slot number; each task keeps the few best rows per
anchor, and those are ranked over all tasks. An anchor's list is never longer than
``positives`` or ``negatives`` per task.

Rows with a null id or label, or a vector that is null, empty or holds a null or
non-finite component take no part. Of rows that share an id the least by label and
vector counts. Shorter vectors count as padded with zeros. Equal scores go to the
smaller id. Extra columns are ignored; an empty table gives no rows. Scores must
fit 62 bits.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pathkin.llm.base import meet, ship, table
from pathkin.session import stage

# fixed values: primes below 2^10, so that 64 products of centred residues stay below 2^24
PRIMES = [1021, 1019, 1013, 1009, 997, 991, 983]
DEPTH = 64

PAIR = "anchor_id long, vec_id long, score long"
TRIPLE = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"


def primes_for(bound: int) -> list[int]:
    """The fewest primes whose product tells all scores in [-bound, bound] apart."""
    product, out = 1, []
    for p in PRIMES:
        out.append(p)
        product *= p
        if product > 2 * bound + 1:
            return out
    raise OverflowError("scores don't fit 62 bits")


def centred(values: np.ndarray, p: int) -> np.ndarray:
    rest = values % p
    return np.where(rest > p // 2, rest - p, rest).astype(np.float32)


def residues(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """``a @ b.T`` modulo ``p`` from float32 products."""
    left, right = centred(a, p), centred(b, p)
    total = np.zeros((len(a), len(b)), dtype=np.int64)
    for at in range(0, a.shape[1], DEPTH):
        part = left[:, at : at + DEPTH] @ right[:, at : at + DEPTH].T
        total += part.astype(np.int32)
    return total % p


def longest(values: np.ndarray) -> int:
    """A whole number not below the Euclidean length of any row."""
    if not len(values):
        return 0
    top = int(np.abs(values).max())
    if values.shape[1] * top * top < 1 << 62:
        return math.isqrt(int((values * values).sum(axis=1).max())) + 1
    return top * (math.isqrt(values.shape[1]) + 1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact signed inner products of the rows of ``a`` and ``b``."""
    primes = primes_for(longest(a) * longest(b))
    value, radix = residues(a, b, primes[0]), primes[0]
    for p in primes[1:]:
        step = (residues(a, b, p) - value) % p * pow(radix, -1, p) % p
        value += radix * step
        radix *= p
    return np.where(value > radix // 2, value - radix, value)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, equal ones by ascending id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def whole_rows(df: DataFrame, id_col: str, vec_col: str, label: Column, scale: int) -> DataFrame:
    """id, label, q of the rows that take part."""
    v = F.col("v")
    return (
        df.select(
            F.col(id_col).cast("long").alias("id"),
            label.cast("long").alias("label"),
            F.col(vec_col).cast("array<double>").alias("v"),
        )
        .where("id is not null and label is not null and size(v) > 0")
        .where(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
        .select("id", "label", F.transform(v, lambda c: F.floor(c * F.lit(float(scale)))).alias("q"))
        .groupBy("id")
        .agg(F.min(F.struct("label", "q")).alias("r"))
        .select("id", "r.label", "r.q")
    )


def _padded(cells) -> np.ndarray:
    out = np.zeros((len(cells), max(map(len, cells))), dtype=np.int64)
    for i, cell in enumerate(cells):
        out[i, : len(cell)] = cell
    return out


BLOCK = "n int, dims int, ids binary, labels binary, cells binary, windows binary"


def _blocks(rows: DataFrame, limit: int, name: str, per_anchor: int = 0) -> DataFrame:
    """Blocks of at most ``limit`` rows of a partition; ``windows`` holds (id, score) pairs."""

    def run(batches):
        held: list[tuple] = []

        def pack():
            ids = np.array([h[0] for h in held], dtype=np.int64)
            labels = np.array([h[1] for h in held], dtype=np.int64)
            cells = _padded([h[2] for h in held])
            windows = np.full((len(held), per_anchor, 2), -1, dtype=np.int64)
            counts = np.zeros(len(held), dtype=np.int64)
            for i, h in enumerate(held):
                for j, (key, score) in enumerate(h[3]):
                    windows[i, j] = key, score
                counts[i] = len(h[3])
            row = (len(held), cells.shape[1], ids.tobytes(), labels.tobytes(), cells.tobytes(),
                   counts.tobytes() + windows.tobytes())
            held.clear()
            return pd.DataFrame([row], columns=["n", "dims", "ids", "labels", "cells", "windows"])

        for batch in batches:
            found = batch["found"] if per_anchor else [()] * len(batch)
            for key, label, cell, windows in zip(batch["id"], batch["label"], batch["q"], found):
                held.append((key, label, cell, [(w["vec_id"], w["score"]) for w in windows]))
                if len(held) == limit:
                    yield pack()
        if held:
            yield pack()

    return stage(rows.mapInPandas(run, BLOCK), name)


class Block:
    def __init__(self, n, dims, ids, labels, cells, windows=b"", per_anchor=0):
        self.ids = np.frombuffer(ids, dtype=np.int64)
        self.labels = np.frombuffer(labels, dtype=np.int64)
        self.cells = np.frombuffer(cells, dtype=np.int64).reshape(n, dims)
        if per_anchor:
            flat = np.frombuffer(windows, dtype=np.int64)
            self.counts, self.windows = flat[:n], flat[n:].reshape(n, per_anchor, 2)

    def fitted(self, dims: int) -> np.ndarray:
        out = np.zeros((len(self.ids), dims), dtype=np.int64)
        out[:, : self.cells.shape[1]] = self.cells
        return out


def _meet(index: DataFrame, asked: DataFrame, slots: int, per_anchor: int, choose, schema: str) -> DataFrame:
    """Every row block with every anchor block, through a slot number both carry."""
    names = ["n", "dims", "ids", "labels", "cells", "windows"]
    left = index.select(*names, F.pmod(F.xxhash64("ids"), F.lit(slots)).alias("slot"))
    right = asked.select(
        *[F.col(c).alias(f"a_{c}") for c in names],
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))).alias("slot"),
    )

    def run(batches):
        key, rows = None, None
        for batch in batches:
            for r in batch.itertuples(index=False):
                if key != r.ids:
                    key, rows = r.ids, Block(r.n, r.dims, r.ids, r.labels, r.cells)
                anchors = Block(r.a_n, r.a_dims, r.a_ids, r.a_labels, r.a_cells, r.a_windows, per_anchor)
                yield choose(anchors, rows)

    pairs = meet(left, right, ["slot"]).select(*names, *[f"a_{c}" for c in names])
    return pairs.mapInPandas(run, schema)


def _positives(k: int):
    def choose(anchors: Block, rows: Block) -> pd.DataFrame:
        dims = max(anchors.cells.shape[1], rows.cells.shape[1])
        a, b, out = anchors.fitted(dims), rows.fitted(dims), []
        for label in np.intersect1d(anchors.labels, rows.labels):
            mine = np.flatnonzero(anchors.labels == label)
            theirs = np.flatnonzero(rows.labels == label)
            scores = products(a[mine], b[theirs])
            ids = rows.ids[theirs]
            for i, row in zip(mine, scores):
                other = np.flatnonzero(ids != anchors.ids[i])
                for j in other[best(row[other], ids[other], k)]:
                    out.append((int(anchors.ids[i]), int(ids[j]), int(row[j])))
        return pd.DataFrame(out, columns=["anchor_id", "vec_id", "score"])

    return choose


def _negatives(k: int, low: tuple[int, int], high: tuple[int, int]):
    """``low`` and ``high`` are shares (numerator, denominator) of the positive's score."""

    def choose(anchors: Block, rows: Block) -> pd.DataFrame:
        dims = max(anchors.cells.shape[1], rows.cells.shape[1])
        scores = products(anchors.fitted(dims), rows.fitted(dims))
        out = []
        for i, row in enumerate(scores):
            apart = np.flatnonzero(rows.labels != anchors.labels[i])
            s, ids = row[apart], rows.ids[apart]
            for positive, score in anchors.windows[i, : anchors.counts[i]].tolist():
                least, most = -(-low[0] * score // low[1]), high[0] * score // high[1]
                fit = np.flatnonzero((s >= least) & (s <= most))
                for j in fit[best(s[fit], ids[fit], k)]:
                    out.append((int(anchors.ids[i]), positive, score, int(ids[j]), int(s[j])))
        return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score", "vec_id", "score"])

    return choose


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    low: tuple[int, int] = (50, 100),
    high: tuple[int, int] = (95, 100),
    block_rows: int = 8192,
    anchor_block: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` and ``anchors`` are frames of (id, label, q), see ``whole_rows``.
    """
    spark = rows.sparkSession
    ship(spark)
    slots = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    index = _blocks(rows, block_rows, "rns-rows")
    asked = _blocks(anchors, anchor_block, "rns-anchors")
    near = _first(_meet(index, asked, slots, 0, _positives(positives), PAIR), ["anchor_id"], positives)
    # at most ``positives`` entries a list
    windows = near.groupBy("anchor_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("found"))
    with_windows = anchors.join(windows.withColumnRenamed("anchor_id", "id"), "id")
    asked = _blocks(with_windows.select("id", "label", "q", "found"), anchor_block, "rns-windows", positives)
    found = _meet(index, asked, slots, positives, _negatives(negatives, low, high), TRIPLE)
    return _first(found, ["anchor_id", "positive_id"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def op13_residue_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    rows = stage(whole_rows(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label, 256), "rns-vectors")
    return hard_negatives(rows, rows.where("id % 50 = 0"))


OP13_SQL = """
WITH v AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           CAST(list_sum([a.q[i] * b.q[i] FOR i IN range(1, len(a.q) + 1)]) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), p AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n FROM s WHERE same)
    WHERE n <= 5
), w AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score,
           s.vec_id AS negative_id, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM w WHERE rank <= 3
"""
