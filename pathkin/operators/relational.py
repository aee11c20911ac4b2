"""Join, rank and grouping helpers that stay even when one key is hot.

Plain ``select``/``filter``/``groupBy`` need no helper; only shapes that go wrong
on skewed keys or that several operators share are here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathkin.session import shared_dir


def spread_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "inner",
    buckets: int = 16,
) -> DataFrame:
    """Join on few or hot keys without piling a key into one task.

    Rows of ``big`` are dealt over ``buckets`` by a hash of ``spread_by`` (stable
    under task retries) and ``small`` is repeated once per bucket. Spark still
    broadcasts ``small`` where its measured size allows. ``how`` may be inner,
    left, left_semi or left_anti.
    """
    dealt = big.withColumn("_bucket", F.pmod(F.xxhash64(*spread_by), F.lit(buckets)).cast("int"))
    repeated = small.withColumn("_bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return dealt.join(repeated, [*on, "_bucket"], how).drop("_bucket")


def hot_keys(df: DataFrame, on: list[str], share: float = 0.01, tracked: int = 4096) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of the rows, most frequent first.

    One pass with a frequent-items sketch of ``tracked`` counters, merged over the
    tasks: its size does not depend on the data. The sketch misses no key that holds
    more than about 1 / (0.75 * tracked) of the rows. At most 1 / share hashes return.
    """
    most = int(1 / share)
    found = df.agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(xxhash64({', '.join(on)}), {most}, {tracked})").alias("top")
    ).first()
    return [t["item"] for t in found["top"] or [] if t["count"] >= share * found["n"]]


def hot_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    spread_by: list[str],
    how: str = "inner",
    buckets: int = 64,
    share: float = 0.01,
    hot: list[int] | None = None,
) -> DataFrame:
    """Join that deals only the keys measured to be hot over ``buckets``.

    Rows of a hot key go to a bucket by a hash of ``spread_by`` and the key's rows of
    ``small`` are repeated once per bucket; all other keys keep one bucket and one
    copy. Null keys join nothing. ``big`` is read once more for the measurement, so
    pass a stored frame, or the hashes themselves as ``hot``. ``how`` may be inner,
    left, left_semi or left_anti.
    """
    hot = hot_keys(big, on, share) if hot is None else hot
    if not hot:
        return big.join(small, on, how)
    is_hot = F.xxhash64(*[F.col(c) for c in on]).isin(hot)
    bucket = F.when(is_hot, F.pmod(F.xxhash64(*spread_by), F.lit(buckets))).otherwise(0).cast("int")
    last = F.when(is_hot, buckets - 1).otherwise(0)
    dealt = big.withColumn("_bucket", bucket)
    repeated = small.withColumn("_bucket", F.explode(F.sequence(F.lit(0), last)))
    return dealt.join(repeated, [*on, "_bucket"], how).drop("_bucket")


def mark_members(df: DataFrame, members: DataFrame, on: list[str], flag: str, yes=1, no=0):
    """Add ``flag`` = ``yes`` where the key occurs in ``members``, else ``no``."""
    keys = members.select(*on).distinct().withColumn("_hit", F.lit(True))
    return df.join(keys, on, "left").withColumn(
        flag, F.when(F.col("_hit"), F.lit(yes)).otherwise(F.lit(no))
    ).drop("_hit")


def multiply_or_keep(df: DataFrame, factors: DataFrame, on: list[str], value: str, factor: str):
    """``value * factor``; rows without a factor keep ``value``."""
    return df.join(factors, on, "left").withColumn(
        value, F.col(value) * F.coalesce(F.col(factor), F.lit(1.0))
    ).drop(factor)


def outer_join_all(frames: list[DataFrame], on: list[str]) -> DataFrame:
    """Full outer join of frames that are each unique on ``on``."""
    return reduce(lambda left, right: left.join(right, on, "full"), frames)


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank"):
    """First ``k`` rows per group, ranked from 1; trimmed before the shuffle.

    The filter on ``row_number`` lets Spark keep only ``k`` rows per group and
    task on the map side, so a hot group costs ``k`` rows per task.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def keep_last(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first under ``order`` (pass descending columns for the last)."""
    return top_k(df, key, order, 1, "_n").drop("_n")


def frequency(df: DataFrame, by: list[str], item: str) -> DataFrame:
    return df.groupBy(*by, item).agg(F.count("*").alias("n"))


def multiset_minus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bag difference as a counted bag: the columns of ``left`` and ``n``.

    Each right row cancels one equal left row. Only counts are subtracted, in one
    grouping with partial sums, so the copies of a row are never written out again.
    Nulls are equal to each other.
    """
    signed = left.withColumn("n", F.lit(1)).unionByName(right.select(*left.columns).withColumn("n", F.lit(-1)))
    return signed.groupBy(*left.columns).agg(F.sum("n").alias("n")).filter(F.col("n") > 0)


def numbered(df: DataFrame, key: list[str], order: list[str], out: str = "position") -> DataFrame:
    """Number the rows of every key from 1, in ascending order of ``order``.

    Rows are range-partitioned by key and order, so a hot key lies in many slabs that
    are numbered side by side; the rows of the key in earlier slabs are then added.
    Slabs are checkpointed once, since their numbers must not change under
    recomputation. Only keys that go on from an earlier slab have an offset: no more
    rows than there are slabs, whatever the data size.
    """
    shared_dir(df.sparkSession)
    slabs = df.repartitionByRange(*key, *order).withColumn("_slab", F.spark_partition_id()).checkpoint()
    earlier = Window.partitionBy(*key).orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slabs.groupBy("_slab", *key).agg(F.count("*").alias("_n"))
        .withColumn("_before", F.sum("_n").over(earlier))
        .filter(F.col("_before") > 0)
        .select("_slab", "_before", *[F.col(k).alias(f"_k_{k}") for k in key])
    )
    inside = Window.partitionBy("_slab", *key).orderBy(*order)
    placed = slabs.withColumn(out, F.row_number().over(inside))
    same = placed["_slab"] == offsets["_slab"]
    for k in key:
        same = same & placed[k].eqNullSafe(offsets[f"_k_{k}"])
    joined = placed.join(offsets, same, "left")
    return joined.select(*[placed[c] for c in df.columns], (placed[out] + F.coalesce("_before", F.lit(0))).alias(out))


def running_totals(
    df: DataFrame, order: Column, sums: dict[str, str], totals: dict[str, str] | None = None
) -> DataFrame:
    """Whole-frame running sums in the given order, without a one-task window.

    ``df`` must be unique on the ordering column. Rows are range-partitioned into
    slabs and checkpointed once (slab numbers must not change under recomputation);
    sums run inside each slab and the totals of earlier slabs are added. The slab
    table has one row per partition, whatever the data size. ``sums`` maps columns
    to the names of their running sums, ``totals`` to the names of their full sums.
    """
    shared_dir(df.sparkSession)
    totals = totals or {}
    slabs = df.repartitionByRange(order).withColumn("_slab", F.spark_partition_id()).checkpoint()
    earlier = Window.orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_slab").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    per_slab = slabs.groupBy("_slab").agg(
        *[F.sum(c).alias(f"_t_{c}") for c in {*sums, *totals}]
    )
    offsets = per_slab.select(
        "_slab",
        *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}") for c in sums],
        *[F.sum(f"_t_{c}").over(whole).alias(name) for c, name in totals.items()],
    )
    inside = Window.partitionBy("_slab").orderBy(order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = {
        name: F.sum(column).over(inside) + F.col(f"_o_{column}") for column, name in sums.items()
    }
    out = slabs.join(offsets, "_slab").withColumns(running)
    return out.drop("_slab", *[f"_o_{c}" for c in sums])
