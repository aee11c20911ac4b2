"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text's elements are its runs of five words (a shorter text is one run), lower
case, split at white space. An element weighs its count times the mean inverse
document frequency of its words. Frequencies are counted over all documents, by
word hash in a table of ``BUCKETS`` places: its size is fixed, whatever the corpus.
Frequencies of words rather than of runs keep a large group of copies from
outvoting its own text.

``bands * rows`` samples are drawn for each distinct text: the element least in
``ln c - r (t - b) - r`` with ``t = floor(ln w / r + b)``, its ``r``, ``c`` and ``b`` read by the
element's hash from a table of random values. As many are drawn with all weights one, so that
texts alike only by the plain similarity (a repeated body, rare words changed) meet too.
Texts that agree on a band's samples and their ``t`` meet in a bucket. The bucket's leader is the member that
meets most others over all bands, which in a group of copies is the text they
were made from or one near it. Every member is compared with the leader by the
exact weighted Jaccard similarity; the plain similarity of the sets of elements
counts too, so that copies whose changed words are rare ones are not lost.

Members that are not joined to it that way may still be links of each other or of
joined members. All that two members of one leader share is told by how each differs
from the leader: what one holds less what it adds and the other lacks, plus what
both add or both lack. So the first comparison keeps every member's differences, and
these pairs are decided exactly without their texts. Two bounds go before: one minus
either similarity is a metric, so the distances of a link to the leader differ by at most
one minus the threshold; and the differences are kept as bits, too, where a bit that only
one member has is an element that only the other, or only it, holds. Blocks of about
``SLOT`` members meet in a grid, so no task holds a group. A pair whose classes are joined
already tells nothing, so a block emits no more links than it has members.

A text is shuffled once to be looked up by those that name it, and once in every slot
that it is compared in. What is kept for the run is removed when its classes are written.

Classes are the connected parts of the links. Exact copies share a text, are
sampled once, and get its class. Null texts count as empty; empty texts are copies
of each other. Repeated rows are copies. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathkin.llm.base import DOC_COLUMNS, ship, table, whole_text, worker_table
from pathkin.session import Workspace
from pathkin.session import stage as written

BUCKETS = 1 << 16
SIZE = 5
SLOT = 512
# characters of a leader's members in one slot
SLOT_CHARS = 4_000_000
_PRIME = np.uint64(0x100000001B3)


def word_hashes(text: str) -> np.ndarray:
    """One 64-bit hash for each word."""
    data = np.frombuffer((" ".join(text.lower().split()) + " ").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if len(data) < 2:
        return np.zeros(0, dtype=np.uint64)
    ends = np.flatnonzero(data == 32)
    starts = np.r_[0, ends[:-1] + 1]
    at = np.arange(len(data)) - np.repeat(starts, np.diff(np.r_[starts, len(data)]))
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(at.max()) + 1, _PRIME, dtype=np.uint64))
        parts = (data.astype(np.uint64) + np.uint64(1)) * powers[at]
        sums = np.add.reduceat(parts, starts)
        return mixed(sums)


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def elements(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements in order, the weight of one occurrence, and their counts."""
    words = word_hashes(text)
    if not len(words):
        return words, np.zeros(0), np.zeros(0, dtype=np.int64)
    value = idf[(words >> np.uint64(48)).astype(np.int64)]
    n = max(1, len(words) - SIZE + 1)
    width = min(SIZE, len(words))
    with np.errstate(over="ignore"):
        runs = np.zeros(n, dtype=np.uint64)
        weight = np.zeros(n)
        for i in range(width):
            runs = runs * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
            weight += value[i : i + n]
    runs, back, counts = np.unique(mixed(runs), return_inverse=True, return_counts=True)
    out = np.zeros(len(runs))
    out[back] = weight / width  # equal runs hold the same words
    return runs, out, counts


def weighted(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct elements in order, and their weights."""
    runs, value, counts = elements(text, idf)
    return runs, value * counts


# least weights of the classes of occurrences; a last class holds first occurrences
LEAST = np.array([1.0, 2.5, 3.3])
PLACES = 512
# what the first comparison keeps of a member's differences
TOLD = ["names", "costs", "firsts", "w_adds", "w_lacks", "n_adds", "n_lacks"]


def occurrences(runs: np.ndarray, value: np.ndarray, counts: np.ndarray):
    """Every occurrence as a hash in order, its weight, and whether it is its element's first."""
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    with np.errstate(over="ignore"):
        names = mixed(np.repeat(runs, counts) + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(names)
    return names[order], np.repeat(value, counts)[order], nth[order] == 0


def differences(leader, member) -> bytes:
    """Bits of the leader's occurrences that the member lacks, then of those it adds."""

    def bits(names, value, first):
        out = np.zeros((len(LEAST) + 1, PLACES), dtype=bool)
        place = (names >> np.uint64(55)).astype(np.int64)
        out[np.searchsorted(LEAST[1:], value, side="right"), place] = True
        out[-1, place[first]] = True
        return np.packbits(out).tobytes()

    lacks = ~np.isin(leader[0], member[0], assume_unique=True)
    adds = ~np.isin(member[0], leader[0], assume_unique=True)
    return bits(*(x[lacks] for x in leader)) + bits(*(x[adds] for x in member))


def apart(leader, member) -> tuple[bytes, bytes, bytes, float, float, int, int]:
    """What the member adds or lacks: names, weights, firsts; then the sums of adds and of lacks."""
    lacks = ~np.isin(leader[0], member[0], assume_unique=True)
    adds = ~np.isin(member[0], leader[0], assume_unique=True)
    names, weight, first = (np.r_[l[lacks], m[adds]] for l, m in zip(leader, member))
    order = np.argsort(names)
    n = int(lacks.sum())
    sums = float(weight[n:].sum()), float(weight[:n].sum()), int(first[n:].sum()), int(first[:n].sum())
    return names[order].tobytes(), weight[order].tobytes(), first[order].tobytes(), *sums


def told(x: dict, i: int, y: dict, j: int) -> float:
    """The greater similarity of two members of one leader, from their differences alone."""
    a, b = x["names"][i], y["names"][j]
    _, at, _ = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    both, firsts = x["costs"][i][at].sum(), int(x["firsts"][i][at].sum())
    shared = x["weight"][i] - x["w_adds"][i] - y["w_lacks"][j] + both
    plain = x["n"][i] - x["n_adds"][i] - y["n_lacks"][j] + firsts
    # sums in another order differ in the last places
    return max((shared + 1e-9) / (x["weight"][i] + y["weight"][j] - shared), plain / (x["n"][i] + y["n"][j] - plain))


def joining(x: dict, y: dict, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links between the classes of two blocks, one at most for every two classes not yet joined."""
    i, j = np.nonzero(
        possible(x, y, threshold)
        & (x["part"][:, None] != y["part"][None, :])
        # a pair of two open members is met from both sides
        & (~y["open"][None, :] | (x["mark"][:, None] < y["mark"][None, :]))
    )
    to: dict[str, str] = {}

    def top(part):
        while part in to:
            part = to[part]
        return part

    kept = []
    for at, (k, m) in enumerate(zip(i.tolist(), j.tolist())):
        one, other = top(x["part"][k]), top(y["part"][m])
        if one != other and told(x, k, y, m) >= threshold:
            to[one] = other
            kept.append(at)
    return x["mark"][i[kept]], y["mark"][j[kept]]


def possible(x: dict, y: dict, threshold: float) -> np.ndarray:
    """Which pairs of two blocks with one leader may be links; never false for a link."""

    def only(a, b):  # bits of b that a lacks, by class
        return np.stack(
            [np.bitwise_count(b[None, :, k] & ~a[:, None, k]).sum(axis=2, dtype=np.int64) for k in range(a.shape[1])], axis=2
        )

    # what x holds and y does not, and the reverse
    x_only = only(x["lacks"], y["lacks"]) + only(y["adds"], x["adds"]).transpose(1, 0, 2)
    y_only = only(y["lacks"], x["lacks"]).transpose(1, 0, 2) + only(x["adds"], y["adds"])
    out = np.zeros(x_only.shape[:2], dtype=bool)
    for size, cost, far in (("weight", np.r_[LEAST, 0.0], "far"), ("n", np.r_[0.0 * LEAST, 1.0], "apart")):
        a, b = x[size][:, None], y[size][None, :]
        shared = np.minimum(a - x_only @ cost, b - y_only @ cost)
        near = np.abs(x[far][:, None] - y[far][None, :]) <= 1 - threshold + 1e-9
        out |= near & (shared * (1 + threshold) >= (threshold - 1e-9) * (a + b))
    return out


def similarity(a, b) -> tuple[float, float]:
    """Weighted Jaccard similarity, and the plain one of the sets of elements."""
    if not len(a[0]) or not len(b[0]):
        same = float(len(a[0]) == len(b[0]))
        return same, same
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][i], b[1][j]).sum()
    plain = len(i) / (len(a[0]) + len(b[0]) - len(i))
    return float(low / (a[1].sum() + b[1].sum() - low)), float(plain)


_rng = np.random.default_rng(20240229)
_R = _rng.gamma(2.0, size=BUCKETS)
_LOG_C = np.log(_rng.gamma(2.0, size=BUCKETS))
_B = _rng.random(BUCKETS)
_ODD = _rng.integers(0, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# what a sample minimises is _PLAIN - r * t; where every weight is one, t is 0
_PLAIN = (_LOG_C + _R * _B - _R).astype(np.float32)
_STEP, _RATE, _SHIFT = _R.astype(np.float32), (1 / _R).astype(np.float32), _B.astype(np.float32)
# places looked at in one go, so that they stay in the processor's cache
_AT_ONCE = 1 << 15


def _drawn(runs: np.ndarray, first: int, count: int):
    """Places of the random table for some samples at a time, and which samples they are."""
    step = max(1, _AT_ONCE // len(runs))
    for k in range(0, count, step):
        odd = _ODD[first + k : first + min(count, k + step), None]
        with np.errstate(over="ignore"):
            yield slice(k, k + len(odd)), ((runs[None, :] * odd) >> np.uint64(48)).astype(np.intp)


def samples(runs: np.ndarray, weights: np.ndarray, count: int) -> np.ndarray:
    """One 64-bit value for each sample: the element and its t."""
    logs = np.log(weights).astype(np.float32)
    out = np.zeros(count, dtype=np.uint64)
    for which, at in _drawn(runs, 0, count):
        t = _RATE.take(at)
        t *= logs
        t += _SHIFT.take(at)
        np.floor(t, out=t)
        best = (_PLAIN.take(at) - _STEP.take(at) * t).argmin(axis=1)
        steps = t[np.arange(len(best)), best].astype(np.int64).view(np.uint64) & np.uint64(0xFFFF)
        with np.errstate(over="ignore"):
            out[which] = runs[best] + steps * _ODD[:count][which]
    return mixed(out)


def plain_samples(runs: np.ndarray, count: int) -> np.ndarray:
    """As ``samples`` with unit weights, by other places of the table."""
    out = np.zeros(count, dtype=np.uint64)
    for which, at in _drawn(runs, 128, count):
        out[which] = runs[_PLAIN.take(at).argmin(axis=1)]
    return mixed(out)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Inverse document frequency of each place; the collected table has BUCKETS rows at most."""

    def run(batches):
        worker_table("neardup", dict)  # lets go of the table of an operator before
        counts = np.zeros(BUCKETS + 1, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                seen = np.unique((word_hashes(text) >> np.uint64(48)).astype(np.int64))
                counts[seen] += 1
                counts[BUCKETS] += 1
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"place": at, "n": counts[at]})

    rows = docs.select("text").mapInPandas(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(BUCKETS + 1)
    counts[rows["place"]] = rows["n"]
    total = counts[BUCKETS]
    return 1 + np.log((1 + total) / (1 + counts[:BUCKETS])), int(total)


def chosen(block: dict, which: np.ndarray) -> dict:
    """Some members of a block."""
    at = np.flatnonzero(which)
    return {k: [v[n] for n in at] if isinstance(v, list) else v[at] for k, v in block.items()}


def components(links: DataFrame, written=written) -> DataFrame:
    """(node, part): the least node of each connected part; ``links`` has a and b.

    Rounds go on until no node changes; each passes on what a part's least node has
    reached, so a chain takes about the logarithm of its length.
    """
    both = written(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    parts = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("part")).withColumnRenamed("a", "node"), "parts")
    while True:
        near = (
            both.join(parts.select(F.col("node").alias("b"), "part"), "b")
            .groupBy("a").agg(F.min("part").alias("near"))
        )
        step = parts.join(near, parts["node"] == near["a"]).select(
            "node", F.col("part").alias("old"), F.least("part", "near").alias("part")
        )
        # what the part's own least node has reached
        jump = step.select(F.col("node").alias("part"), F.col("part").alias("further"))
        new = written(
            step.join(jump, "part", "left").select("node", "old", F.least("part", F.coalesce("further", "part")).alias("part")),
            "parts",
        )
        parts = new.select("node", "part")
        if not new.where("old <> part").limit(1).count():
            return parts


def near_classes(docs: DataFrame, threshold: float = 0.8, bands: int = 12, rows: int = 3) -> DataFrame:
    """Adds class_id (the least row key of the class, by doc_id) to key, doc_id."""
    with Workspace(docs.sparkSession, "neardup") as space:
        return written(classes_within(space, docs, threshold, bands, rows), "near-classes")


def classes_within(
    space: Workspace, docs: DataFrame, threshold: float = 0.8, bands: int = 12, rows: int = 3
) -> DataFrame:
    """As ``near_classes``; the frame reads tables of ``space``."""
    spark, written = docs.sparkSession, space.stage
    ship(spark)
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))
    idf, _ = document_frequencies(docs)
    shared = spark.sparkContext.broadcast(idf)

    def sketch(batches):
        for batch in batches:
            keys = []
            for text in batch["text"]:
                runs, weights = weighted(text, shared.value)
                if not len(runs):
                    keys.append([])
                    continue
                s = np.r_[samples(runs, weights, bands * rows), plain_samples(runs, bands * rows)].reshape(2 * bands, rows)
                with np.errstate(over="ignore"):
                    band = mixed((s * _ODD[:rows]).sum(axis=1) + _ODD[100 : 100 + 2 * bands])
                keys.append(band.view(np.int64).tolist())
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"].astype("Int64"), "mark": batch["mark"], "size": batch["size"], "bands": keys}
            )

    marked = docs.withColumns({"mark": F.sha2(F.col("text").cast("binary"), 256), "size": F.length("text")})
    all_rows = written(marked.mapInPandas(sketch, "doc_id long, mark string, size int, bands array<long>"), "sketch")
    # exact copies: one text, named by its least id
    texts = written(
        all_rows.groupBy("mark")
        .agg(F.min("doc_id").alias("doc_id"), F.any_value("size").alias("size"), F.any_value("bands").alias("bands"))
        .withColumn("row", F.monotonically_increasing_id()),
        "texts",
    )
    # most bands are met once: they are looked through by number, the others get their marks
    member = texts.select("row", F.explode("bands").alias("band"))
    crowded = written(
        member.join(member.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"), "band")
        .join(texts.select("row", "mark"), "row")
        .select("band", "mark", "n"),
        "crowded",
    )
    # the text that meets most others is the one the others were copied from, or near it
    met = crowded.groupBy("mark").agg(F.sum("n").alias("met"))
    leaders = crowded.join(met, "mark").groupBy("band").agg(F.max(F.struct("met", "mark"))["mark"].alias("leader"))
    buckets = written(crowded.select("band", "mark").join(leaders, "band"), "buckets")

    def verify(batches):
        # a leader's row comes before those of its members in the slot
        for batch in batches:
            out = []
            for a, b, slot, slots, leads, text in batch[["a", "b", "slot", "slots", "leads", "text"]].itertuples(index=False):
                runs, value, counts = elements(text, shared.value)
                whole, mine = (runs, value * counts), occurrences(runs, value, counts)
                if leads:
                    leader, of_leader = whole, mine
                    continue
                size = len(runs), float((value * counts).sum())
                out.append(
                    (a, b, slot, slots, *similarity(leader, whole), *size, differences(of_leader, mine), *apart(of_leader, mine))
                )
            yield pd.DataFrame(out, columns=["a", "b", "slot", "slots", "s", "plain", "n", "weight", "bits", *TOLD])

    pairs = written(
        buckets.where("mark <> leader").select(F.col("leader").alias("a"), F.col("mark").alias("b")).distinct(), "pairs"
    )
    # a leader is dealt over as many slots as its members and their texts fill
    slots = written(
        pairs.join(texts.select(F.col("mark").alias("b"), "size"), "b")
        .groupBy("a")
        .agg(F.greatest(F.ceil(F.count("*") / SLOT), F.ceil(F.sum("size") / SLOT_CHARS), F.lit(1)).cast("int").alias("slots")),
        "slots",
    )
    every_slot = F.explode(F.sequence(F.lit(0), F.col("slots") - 1))
    dealt = pairs.join(slots, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("slots")).cast("int").alias("slot"), "slots", "b", F.lit(False).alias("leads")
    )
    dealt = written(
        dealt.union(slots.select("a", every_slot.alias("slot"), "slots", F.col("a").alias("b"), F.lit(True).alias("leads"))),
        "dealt",
    )
    # one copy of each text that a pair names, then one for each slot it is compared in
    asked = dealt.select(F.col("b").alias("mark")).distinct()
    kept_texts = marked.join(asked, "mark", "left_semi").groupBy("mark").agg(F.any_value("text").alias("text"))
    first = written(
        dealt.join(kept_texts.withColumnRenamed("mark", "b"), "b")
        .repartition("a", "slot")
        .sortWithinPartitions("a", "slot", F.col("leads").desc())
        .mapInPandas(
            verify,
            "a string, b string, slot int, slots int, s double, plain double, n long, weight double, bits binary, "
            "names binary, costs binary, firsts binary, w_adds double, w_lacks double, n_adds long, n_lacks long",
        ),
        "first",
    )
    linked = F.greatest("s", "plain") >= threshold
    links = first.where(linked).select("a", "b")
    parts = components(links, written)
    # members without a link to their leader meet the others that the leader has
    member_rows = first.select(
        F.col("a").alias("leader"), "slot", "slots", F.col("b").alias("mark"),
        (~linked).alias("open"), (1 - F.col("s")).alias("far"), (1 - F.col("plain")).alias("apart"),
        "n", "weight", "bits", *TOLD,
    )
    unsettled = member_rows.where("open").select("leader", "slots").distinct().select("leader", every_slot.alias("slot"))
    many = member_rows.where("slots > 1").join(unsettled, ["leader", "slot"], "left_semi")
    # what is wide goes to its blocks once; the classes' names are narrow and meet it there
    wide = member_rows.where("slots = 1").union(many.select(*member_rows.columns))
    narrow = (
        member_rows.select("leader", "slot", "slots", "mark").join(unsettled, ["leader", "slot"], "left_semi")
        .join(parts.withColumnRenamed("node", "mark"), "mark", "left")
        .withColumn("part", F.coalesce("part", "mark"))
    )

    def blocks(rows: DataFrame, columns: list[str], name: str) -> DataFrame:
        # two slots of a leader, or one with itself
        pair = rows.withColumn("other", every_slot).withColumns({"i": F.least("slot", "other"), "j": F.greatest("slot", "other")})
        return pair.groupBy("leader", "i", "j").agg(F.collect_list(F.struct(*columns)).alias(name))

    met_blocks = blocks(wide, ["mark", "slot", "open", "far", "apart", "n", "weight", "bits", *TOLD], "members").join(
        blocks(narrow, ["mark", "part"], "parts"), ["leader", "i", "j"]
    )

    def unpacked(rows, parts) -> dict:
        part = {r["mark"]: r["part"] for r in parts}
        numbers = ("far", "apart", "n", "weight", "w_adds", "w_lacks", "n_adds", "n_lacks")
        out = {k: np.array([r[k] for r in rows], dtype=float) for k in numbers}
        bits = np.frombuffer(b"".join(bytes(r["bits"]) for r in rows), dtype=np.uint64)
        bits = bits.reshape(len(rows), 2, len(LEAST) + 1, PLACES // 64)
        out |= {"lacks": bits[:, 0], "adds": bits[:, 1], "open": np.array([r["open"] for r in rows], dtype=bool)}
        for k, kind in (("names", np.uint64), ("costs", np.float64), ("firsts", bool)):
            out[k] = [np.frombuffer(bytes(r[k]), dtype=kind) for r in rows]
        names = [r["mark"] for r in rows]
        return out | {"mark": np.array(names), "part": np.array([part[m] for m in names]), "slot": np.array([r["slot"] for r in rows])}

    def candidates(batches):
        for batch in batches:
            for i, j, members, parts in batch[["i", "j", "members", "parts"]].itertuples(index=False):
                block = unpacked(members, parts)
                for mine, other in {(i, j), (j, i)}:
                    x, y = chosen(block, block["open"] & (block["slot"] == mine)), chosen(block, block["slot"] == other)
                    if len(x["mark"]) and len(y["mark"]):
                        a, b = joining(x, y, threshold)
                        yield pd.DataFrame({"a": a, "b": b}, dtype=object)

    more = met_blocks.select("i", "j", "members", "parts").mapInPandas(candidates, "a string, b string")
    parts = components(links.union(more), written)
    named = texts.select("mark", "doc_id").join(parts.withColumnRenamed("node", "mark"), "mark", "left").withColumn(
        "part", F.coalesce("part", "mark")
    )
    least = named.groupBy("part").agg(F.min("doc_id").alias("class_id"))
    classes = named.join(least, "part").select("mark", "part", "class_id")
    return all_rows.select("doc_id", "mark").join(classes, "mark").select("doc_id", "class_id", "mark", "part")


def op6_consistent_weighted_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of every class the document with the least id stays, once.

    A row is named by its id and its text, so an id that stands on several texts is
    judged for each of them. Null ids come last; of rows that agree in id and text one stays.
    """
    no_id, key = F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("key_")
    with Workspace(spark, "neardup") as space:
        kept = written(
            classes_within(space, docs)
            .groupBy("part").agg(F.min(F.struct(no_id, key, "mark")).alias("k"))
            .select("k.*"),
            "kept",
        )
    text = F.coalesce(docs["text"], F.lit(""))
    named = docs.select(*DOC_COLUMNS).withColumns(
        {"no_id": docs["doc_id"].isNull(), "key_": F.coalesce(docs["doc_id"].cast("long"), F.lit(0)), "mark": F.sha2(text.cast("binary"), 256)}
    )
    same = named.join(kept, ["no_id", "key_", "mark"], "left_semi")
    return same.dropDuplicates(["no_id", "key_", "mark"]).select(*DOC_COLUMNS)
