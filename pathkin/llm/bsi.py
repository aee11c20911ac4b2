"""Exact top-k inner products on a bit-sliced index.

Components are turned into whole numbers. Rows are kept in blocks; a block holds,
for every dimension, one bitmap for each binary digit of ``x - lowest`` above the
``drop_bits`` lowest (the quantised attribute). For a query the slices are added
with bitmap adders, once for each signed binary digit of the query's component,
so the sum of a block is itself a stack of slices. The top rows are taken from the
most significant slice downward. The dropped digits bound the error of that sum:
rows within the bound of the k-th row are the boundary, and their inner products
are worked out exactly.

Blocks are a written table; queries travel in blocks of ``query_block`` vectors and
meet every index block through an equi-join on a slot number. Vectors null, empty
or holding null or non-finite components take no part. Shorter vectors count as
padded with zeros. Rows repeated in id and vector count once. Equal scores go to
the smaller id. Scores must fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pathkin.llm.base import meet, ship, table
from pathkin.session import stage


def slices_of(values: np.ndarray) -> np.ndarray:
    """Bitmaps (dims, digits, words) of whole numbers >= 0 given as (rows, dims)."""
    rows = -(-len(values) // 64) * 64
    width = max(1, int(values.max(initial=0)).bit_length())
    padded = np.zeros((rows, values.shape[1]), dtype=np.int64)
    padded[: len(values)] = values
    digits = (padded[:, :, None] >> np.arange(width)) & 1
    packed = np.packbits(digits.astype(np.uint8), axis=0, bitorder="little")
    return np.ascontiguousarray(packed.transpose(1, 2, 0)).view(np.uint64)


def signed_digits(value: int) -> list[tuple[int, int]]:
    """(power, sign) of the non-adjacent binary form."""
    out, power, left = [], 0, abs(value)
    while left:
        if left & 1:
            digit = 2 - (left & 3)
            out.append((power, digit if value > 0 else -digit))
            left -= digit
        left >>= 1
        power += 1
    return out


def added(slices: np.ndarray, query: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Slices of sum(query * u) + offset, lowest first, and that offset."""
    width = slices.shape[1]
    columns: dict[int, list[np.ndarray]] = {}
    offset = 0
    flipped = ~slices
    for dim, value in enumerate(query):
        for power, sign in signed_digits(int(value)):
            source = slices if sign > 0 else flipped
            # -u = complement(u) - (2^width - 1)
            offset += 0 if sign > 0 else ((1 << width) - 1) << power
            for digit in range(width):
                columns.setdefault(power + digit, []).append(source[dim, digit])
    out: list[np.ndarray] = []
    power = 0
    zero = np.zeros(slices.shape[2], dtype=np.uint64)
    while columns:
        stack = columns.pop(power, [])
        rows = np.array(stack) if stack else np.empty((0, len(zero)), dtype=np.uint64)
        carries: list[np.ndarray] = columns.get(power + 1, [])
        while len(rows) > 1:
            if len(rows) == 2:
                carries.append(rows[0] & rows[1])
                rows = (rows[0] ^ rows[1])[None]
                break
            n = len(rows) // 3
            a, b, c = rows[:n], rows[n : 2 * n], rows[2 * n : 3 * n]
            half = a ^ b
            carries.extend((a & b) | (half & c))
            rows = np.concatenate([half ^ c, rows[3 * n :]])
        if carries:
            columns[power + 1] = carries
        out.append(rows[0] if len(rows) else zero)
        power += 1
    return out, offset


def _count(bits: np.ndarray) -> int:
    return int(np.bitwise_count(bits).sum())


def kth_value(total: list[np.ndarray], valid: np.ndarray, k: int) -> int:
    """The k-th largest value, read from the most significant slice downward."""
    equal, above, value = valid, 0, 0
    for power in range(len(total) - 1, -1, -1):
        ones = equal & total[power]
        n = _count(ones)
        if above + n >= k:
            equal, value = ones, value | (1 << power)
        else:
            above += n
            equal = equal & ~total[power]
    return value


def at_least(total: list[np.ndarray], valid: np.ndarray, bound: int) -> np.ndarray:
    if bound <= 0:
        return valid
    if bound >> len(total):
        return np.zeros_like(valid)
    greater, equal = np.zeros_like(valid), valid
    for power in range(len(total) - 1, -1, -1):
        if bound >> power & 1:
            equal = equal & total[power]
        else:
            greater = greater | (equal & total[power])
            equal = equal & ~total[power]
    return greater | equal


class Block:
    def __init__(self, ids: np.ndarray, values: np.ndarray, drop_bits: int):
        self.ids, self.values, self.drop = ids, values, drop_bits
        self.low = values.min(axis=0)
        self.slices = slices_of((values - self.low) >> drop_bits)
        rows = np.zeros(self.slices.shape[2] * 64, dtype=np.uint8)
        rows[: len(ids)] = 1
        self.valid = np.packbits(rows, bitorder="little").view(np.uint64)

    def top(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """(score, id) of the block's k best rows whose id is not ``own``."""
        valid = self.valid
        if (mine := np.flatnonzero(self.ids == own)).size:
            valid = valid.copy()
            for row in mine:
                valid[row // 64] &= ~(np.uint64(1) << np.uint64(row % 64))
        n = _count(valid)
        if not n:
            return []
        total, _ = added(self.slices, query)
        reach = int(np.abs(query).sum()) * ((1 << self.drop) - 1)
        bound = kth_value(total, valid, min(k, n)) - (reach >> self.drop) - 1
        chosen = at_least(total, valid, bound)
        rows = np.flatnonzero(np.unpackbits(chosen.view(np.uint8), bitorder="little"))
        scores = self.values[rows] @ query
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return [(int(scores[i]), int(self.ids[rows[i]])) for i in best]


def _matrix(cells, dims: int) -> np.ndarray:
    out = np.zeros((len(cells), dims), dtype=np.int64)
    for i, cell in enumerate(cells):
        out[i, : len(cell)] = cell
    return out


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    x = F.col("v")
    return (
        df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
        .where("id is not null and size(v) > 0")
        .where(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
        .select("id", F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("q"))
        .dropDuplicates(["id", "q"])
    )


def top_products(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    block_rows: int = 32_768,
    query_block: int = 256,
    drop_bits: int = 2,
) -> DataFrame:
    """query_id, rank, vec_id, score over frames of (id, q)."""
    spark = vectors.sparkSession
    ship(spark)

    def blocks(limit, kind):
        def run(batches):
            ids: list[int] = []
            cells: list = []

            def pack():
                width = max(map(len, cells))
                m = _matrix(cells, width)
                row = (kind, len(ids), width, np.array(ids, dtype=np.int64).tobytes(), m.tobytes())
                ids.clear()
                cells.clear()
                return pd.DataFrame([row], columns=["kind", "n", "dims", "ids", "cells"])

            for batch in batches:
                for key, cell in zip(batch["id"], batch["q"]):
                    ids.append(key)
                    cells.append(cell)
                    if len(ids) == limit:
                        yield pack()
            if ids:
                yield pack()

        return run

    schema = "kind string, n int, dims int, ids binary, cells binary"
    index = stage(vectors.mapInPandas(blocks(block_rows, "index"), schema), "bsi-index")
    asked = stage(queries.mapInPandas(blocks(query_block, "query"), schema), "bsi-queries")
    slots = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    index = index.withColumn("slot", F.pmod(F.xxhash64("ids"), F.lit(slots)))
    asked = asked.select(
        F.col("ids").alias("q_ids"),
        F.col("cells").alias("q_cells"),
        F.col("dims").alias("q_dims"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))).alias("slot"),
    )
    pairs = meet(index, asked, ["slot"]).select("n", "dims", "ids", "cells", "q_dims", "q_ids", "q_cells")

    def score(batches):
        kept_key, block = None, None
        for batch in batches:
            for row in batch.itertuples(index=False):
                q_ids = np.frombuffer(row.q_ids, dtype=np.int64)
                q = np.frombuffer(row.q_cells, dtype=np.int64).reshape(len(q_ids), row.q_dims)
                if kept_key != row.ids:
                    values = np.frombuffer(row.cells, dtype=np.int64).reshape(row.n, row.dims)
                    block = Block(np.frombuffer(row.ids, dtype=np.int64), values, drop_bits)
                    kept_key = row.ids
                dims = block.values.shape[1]
                out = []
                for key, vector in zip(q_ids, q):
                    fitted = np.zeros(dims, dtype=np.int64)
                    fitted[: min(dims, len(vector))] = vector[:dims]
                    out += [(int(key), i, s) for s, i in block.top(fitted, int(key), k)]
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = pairs.mapInPandas(score, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.select("query_id", "vec_id", "score")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op1_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 1024)
    return top_products(vectors, vectors.where("id % 100 = 0"), k=10)


OP1_SQL = """
WITH v AS (
    SELECT DISTINCT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT a.vec_id AS query_id, b.vec_id,
           CAST(list_sum([a.q[i] * b.q[i] FOR i IN range(1, len(a.q) + 1)]) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""
