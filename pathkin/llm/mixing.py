"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

A document of a source is to be taken ``target / source_size`` times. The whole
part of that number is taken as it is; the rest is a probability. Two documents of
a source meet: words are moved between their probabilities, at random in one of the
two directions and as many as it takes until one of them becomes 0 or 1. Expected
copies and the words of the pair stay what they were. The other document goes on to
meet the next one. Documents are dealt into groups of about ``fan_in``, each group
leaves one fractional document, and these go through the next level of groups until
a source has one: a reduction tree with one shuffle of narrow rows per level.
The last document of a source is rounded, too, and the words this adds or takes away
are passed on to a few documents of the source, the longest first, that change by one
copy where this brings the source nearer to its target; of both ways to round the last
document the one that ends nearer is taken.

Chance comes from hashes of (seed, document), so reruns agree however rows are
partitioned. Rows that agree in id, source and size are interchangeable; they are
counted, rounded one by one and unfolded again.

Null and empty texts have size 0 and are taken 0 times over. Null sources are one
source, the last. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathkin.llm.base import table
from pathkin.operators.relational import running_totals, spread_join
from pathkin.session import stage

WORD = "[^\\x20\\x09-\\x0D]++"
SOURCE = ["no_source", "source"]
UNIT = [*SOURCE, "doc_id", "size", "copy"]
GONE = "struct<doc_id:bigint,size:bigint,copy:bigint,p:double>"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def chance(seed: int, *columns) -> Column:
    """A number in [0, 1) that depends on the columns' values alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / F.lit(float(1 << 53))


def source_targets(sizes: DataFrame, weights: list[int], share: float, cap: float) -> DataFrame:
    """no_source, source, n, source_size, target.

    ``sizes`` has no_source, source, n, source_size. Targets are ``weight * level``
    where that is no more than ``cap`` source sizes, and the cap elsewhere; the level
    is such that they sum to ``share`` of all sizes. A source is at its cap exactly
    if the targets at the level of its own cap sum to no more than that.
    """
    ordered = running_totals(sizes.withColumn("one", F.lit(1)), F.struct(*SOURCE), {"one": "place"})
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = stage(
        ordered.select(*SOURCE, "n", "source_size", weight.alias("weight"))
        .withColumn("most", F.col("source_size") * F.lit(cap))
        .withColumn("level", F.col("most") / F.col("weight")),
        "mix-sources",
    )
    by_level = weighed.groupBy("level").agg(F.sum("most").alias("most"), F.sum("weight").alias("weight"))
    totals = running_totals(
        by_level, F.col("level"), {"most": "most_to", "weight": "weight_to"}, {"most": "most_all", "weight": "weight_all"}
    )
    wanted = F.col("most_all") * F.lit(share / cap)
    at_level = F.col("most_to") + F.col("level") * (F.col("weight_all") - F.col("weight_to"))
    full = totals.where(at_level <= wanted).agg(F.max("most_to").alias("most"), F.max("weight_to").alias("weight")).first()
    whole = weighed.agg(F.sum("most").alias("most"), F.sum("weight").alias("weight")).first()
    left = (whole["most"] or 0.0) * share / cap - (full["most"] or 0.0)
    open_weight = (whole["weight"] or 0) - (full["weight"] or 0)
    level = left / open_weight if open_weight else float("inf")
    target = F.least(F.col("most"), F.col("weight") * F.lit(level)) if open_weight else F.col("most")
    return weighed.select(*SOURCE, "n", "source_size", target.alias("target"))


def _meeting(seed: int):
    """Fold of one group: the carried document meets the next; the settled one joins ``done``."""

    def settled(done: Column, unit: Column, taken: Column) -> Column:
        return F.concat(done, F.array(F.struct(unit["doc_id"], unit["size"], unit["copy"], taken.cast("double").alias("p"))))

    def step(state: Column, unit: Column) -> Column:
        a, b = state["carried"], unit
        a_up = F.least(a["size"] * (1 - a["p"]), b["size"] * b["p"])
        b_up = F.least(a["size"] * a["p"], b["size"] * (1 - b["p"]))
        u = chance(seed, a["doc_id"], a["size"], a["copy"], b["doc_id"], b["size"], b["copy"])
        first = u * (a_up + b_up) < b_up
        # is it the carried document that becomes whole
        a_ends = F.when(first, a["size"] * (1 - a["p"]) <= b["size"] * b["p"]).otherwise(
            a["size"] * a["p"] <= b["size"] * (1 - b["p"])
        )
        moved = F.when(first, a_up).otherwise(-b_up)
        bounded = lambda p: F.greatest(F.least(p, F.lit(1.0)), F.lit(0.0))
        kept = lambda x, p: F.struct(x["doc_id"], x["size"], x["copy"], bounded(p).alias("p"))
        met = F.struct(
            F.when(a_ends, settled(state["done"], a, F.when(first, 1).otherwise(0)))
            .otherwise(settled(state["done"], b, F.when(first, 0).otherwise(1)))
            .alias("done"),
            F.when(a_ends, kept(b, b["p"] - moved / b["size"])).otherwise(kept(a, a["p"] + moved / a["size"])).alias("carried"),
        )
        begin = F.struct(state["done"].alias("done"), b.alias("carried"))
        return F.when(a["size"].isNull(), begin).otherwise(met)

    return step


def _level(units: DataFrame, groups: Column, seed: int) -> DataFrame:
    """One row per group: ``done`` and the one document ``carried`` on."""
    unit = F.struct("doc_id", "size", "copy", "p")
    by = chance(seed, "doc_id", "size", "copy")
    dealt = units.withColumn("group_", F.least(F.floor(by * groups), groups - 1))
    gathered = dealt.groupBy(*SOURCE, "n", "group_").agg(
        F.array_sort(F.collect_list(F.struct(chance(seed + 1, "doc_id", "size", "copy").alias("turn"), unit.alias("unit")))).alias("units")
    )
    start = F.struct(F.array().cast(f"array<{GONE}>").alias("done"), F.lit(None).cast(GONE).alias("carried"))
    ordered = F.transform("units", lambda x: x["unit"])
    return gathered.withColumn("state", F.aggregate(ordered, start, _meeting(seed + 2))).select(*SOURCE, "n", "state.*")


def _closed(settled: DataFrame, last: DataFrame, per_class: int) -> DataFrame:
    """The last document of every source and those that change by a copy for it: UNIT columns and ``taken``.

    Of every source ``per_class`` settled documents are looked at for each power of two
    of the size and either state, so a source's list is bounded.
    """
    place = F.struct(chance(7, "doc_id", "size", "copy").alias("turn"), "doc_id", "size", "copy")
    part = F.pmod(F.xxhash64("doc_id", "copy"), F.lit(per_class)).alias("part")
    some = (
        settled.groupBy(*SOURCE, "taken", F.floor(F.log2("size")).alias("class"), part)
        .agg(F.min(place).alias("unit"))
        .groupBy(*SOURCE)
        .agg(F.sort_array(F.collect_list(F.struct("unit.size", "unit.doc_id", "unit.copy", "taken")), asc=False).alias("able"))
    )

    def step(state: Column, x: Column) -> Column:
        change = F.when(x["taken"] == 1, -1).otherwise(1)
        after = state["over"] + change * x["size"]
        # never past the target: what is left then is below the shortest of the list
        better = (F.abs(after) < F.abs(state["over"])) & (x["size"] <= F.abs(state["over"]))
        flip = F.struct(x["doc_id"], x["size"], x["copy"], change.alias("taken"))
        return F.struct(
            F.when(better, after).otherwise(state["over"]).alias("over"),
            F.when(better, F.concat(state["flips"], F.array(flip))).otherwise(state["flips"]).alias("flips"),
        )

    def way(taken: int) -> Column:
        own = F.struct("doc_id", "size", "copy", F.lit(taken).alias("taken"))
        start = F.struct((F.col("size") * (F.lit(taken) - F.col("p"))).alias("over"), F.array(own).alias("flips"))
        return F.when(F.col("able").isNull(), start).otherwise(F.aggregate("able", start, step))

    both = last.join(some, SOURCE, "left").select(
        *SOURCE, way(1).alias("up"), way(0).alias("down"), (chance(5, "doc_id", "size", "copy") < F.col("p")).alias("by_chance")
    )
    up, down = F.abs(F.col("up.over")), F.abs(F.col("down.over"))
    nearer = F.when((up < down) | ((up == down) & F.col("by_chance")), F.col("up.flips")).otherwise(F.col("down.flips"))
    return both.select(*SOURCE, F.explode(nearer).alias("f")).select(*SOURCE, "f.*")


def rounded(units: DataFrame, largest: int, fan_in: int = 48, seed: int = 1, per_class: int = 256) -> DataFrame:
    """UNIT columns and ``taken`` 0 or 1 of fractional units (UNIT, n, p), ``largest`` = the greatest n."""
    ends, carried, width, level = None, units, largest, 0
    while True:
        groups = F.ceil(F.col("n") / F.lit(fan_in))
        tree = stage(_level(carried, groups, seed + 10 * level), "mix-level")
        done = tree.select(*SOURCE, F.explode("done").alias("d")).select(*SOURCE, "d.*")
        ends = done if ends is None else ends.unionByName(done)
        carried = tree.select(*SOURCE, groups.alias("n"), "carried.*")
        width, level = -(-width // fan_in), level + 1
        if width <= 1:
            break
    settled = ends.withColumn("taken", F.col("p").cast("int"))
    # a settled document changes once at most, so the sum is 0 or 1
    return (
        settled.select(*UNIT, "taken").unionByName(_closed(settled, carried, per_class).select(*UNIT, "taken"))
        .groupBy(*UNIT).agg(F.sum("taken").alias("taken"))
    )


def _one_by_one(rated: DataFrame, at_once: int = 1000) -> DataFrame:
    """Row ``copy`` = 1 .. ``rows`` of every row; many copies are unfolded by many tasks."""
    to = lambda first, last: F.explode(F.sequence(first.cast("long"), last.cast("long")))
    one = F.lit(1)
    few = rated.where(F.col("rows") <= at_once).withColumn("copy", to(one, F.col("rows")))
    many = rated.where(F.col("rows") > at_once).withColumn("part", to(one, F.ceil(F.col("rows") / at_once)))
    many = many.repartition(*UNIT[:-1], "part").withColumn(
        "copy", to((F.col("part") - 1) * at_once + 1, F.least(F.col("rows"), F.col("part") * at_once))
    )
    return few.unionByName(many.drop("part")).drop("rows")


def mix(
    docs: DataFrame, weights: list[int] = [5, 2, 1], share: float = 1.5, cap: float = 2.0, seed: int = 1
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: one row per row of ``docs``."""
    counted = stage(
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"),
            docs["source"].isNull().alias("no_source"),
            F.coalesce(docs["source"].cast("string"), F.lit("")).alias("source"),
            words(docs["text"]).alias("size"),
        )
        .groupBy(*SOURCE, "doc_id", "size").agg(F.count("*").alias("rows")),
        "mix-sizes",
    )
    sizes = counted.groupBy(*SOURCE).agg(
        F.sum(F.when(F.col("size") > 0, F.col("rows")).otherwise(0)).alias("n"),
        F.sum(F.col("size") * F.col("rows")).alias("source_size"),
    )
    targets = stage(source_targets(sizes, weights, share, cap), "mix-targets")
    largest = targets.agg(F.max("n")).first()[0] or 0
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rated = spread_join(counted, targets, SOURCE, ["doc_id", "size"]).withColumns(
        {"whole": F.floor(rate), "p": rate - F.floor(rate)}
    )
    units = stage(_one_by_one(rated), "mix-units")
    open_units = units.where("size > 0 and p > 0").select(*UNIT, "n", "p")
    chosen = rounded(open_units, largest, seed=seed)
    # every unit once, with the copy its rounding adds
    extra = chosen.select(*UNIT, "taken").where("taken > 0")
    copies = F.col("whole") + F.coalesce("taken", F.lit(0))
    return _joined(units, extra, copies)


def _joined(units: DataFrame, extra: DataFrame, copies: Column) -> DataFrame:
    """Null ids must meet, too: the join goes by a filled id and a mark."""
    keyed = lambda df: df.withColumn("no_id", F.col("doc_id").isNull()).withColumn(
        "key_", F.coalesce("doc_id", F.lit(0))
    )
    on = [*SOURCE, "no_id", "key_", "size", "copy"]
    return (
        keyed(units).join(keyed(extra).drop("doc_id"), on, "left")
        .withColumn("copies", copies.cast("long"))
        .select(
            "doc_id", F.when(~F.col("no_source"), F.col("source")).alias("source"), "size", "source_size",
            "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        )
    )


def op11_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
