"""Native spans: where a pattern's matches stand in a text, in code points."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<kind:string,at:int,end:int,value:string,inner:string>>"


def matches(text: Column, kind: str, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches; ``inner`` is the given group.

    The pieces between the matches and the matches themselves give the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    inner = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    between = F.split(text, pattern, -1)
    zipped = F.arrays_zip(found.alias("m"), inner.alias("g"), between.alias("b"))
    start = F.struct(F.lit(0).alias("pos"), F.array().cast(SPAN).alias("out"))

    def step(acc, x):
        at = acc["pos"] + F.length(x["b"])
        end = at + F.length(x["m"])
        one = F.struct(
            F.lit(kind).alias("kind"), at.alias("at"), end.alias("end"),
            x["m"].alias("value"), x["g"].alias("inner"),
        )
        return F.struct(end.alias("pos"), F.concat(acc["out"], F.array(one)).alias("out"))

    # the last piece has no match after it
    pairs = F.slice(zipped, 1, F.size(found))
    spans = F.aggregate(pairs, start, step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPAN))


def in_order(spans: Column, kinds: list[str]) -> Column:
    """By start, then by kind as listed, then by end."""
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(kinds) for x in (k, i)])
    keyed = F.transform(
        spans, lambda s: F.struct(s["at"].alias("at"), rank[s["kind"]].alias("r"), s["end"].alias("end"), s.alias("s"))
    )
    return F.transform(F.array_sort(keyed), lambda k: k["s"])


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["at"], s["end"])), ","
    )


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column, mark: str) -> Column:
    """The text with every span, in order of start, replaced; overlaps are replaced once."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("pos"))

    def step(acc, s):
        fresh = s["at"] >= acc["pos"]
        piece = F.concat(acc["out"], F.substring(text, acc["pos"] + 1, s["at"] - acc["pos"]), F.lit(mark))
        return F.struct(
            F.when(fresh, piece).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["pos"], s["end"]).alias("pos"),
        )

    tail = lambda acc: F.concat(acc["out"], F.substring(text, acc["pos"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, tail)).otherwise(text)


def together(parts: list[Column]) -> Column:
    return reduce(lambda a, b: F.concat(a, b), parts)
