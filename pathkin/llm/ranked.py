"""Ranked lexical search by groups of equal presence masks.

Documents are tokenised once into blocks: for every term that some item asks for,
the documents of the block that hold it and how often. Per item the terms'
presence bitmaps are turned into one mask of matched terms per document, and
documents with the same mask are a group. A group's highest possible score is the
sum of its terms' best parts in the block. Groups are evaluated by that bound,
highest first, with exact whole-number scores, and a block is finished once the
k-th score found so far lies above the next group's bound. What a task has found
carries over to its next blocks, so later blocks stop sooner; tasks return their
k best per item and these are ranked over all tasks.

Terms are runs of ASCII letters and digits and non-ASCII characters; only A-Z are
lower-cased. Every row counts as a document, repeated rows and null ids too; null
and empty texts hold no term and count nowhere. Equal scores go by ascending id,
null ids last (the largest 64-bit id is taken for null). Item rows repeated in id
and text count once; an item without a term, or empty tables, give no rows. Extra
columns are ignored.

Items are dealt into groups of about ``term_limit`` terms and each group is one
pass over the documents, so the terms sent to the tasks are bounded.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pathkin.llm.base import ship, table
from pathkin.session import stage

NO_ID = (1 << 63) - 1
BLOCK = "n int, n_terms long, n_docs long, ids binary, lengths binary, docs binary, terms binary, counts binary"
_TERM_BYTES = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
# what is no part of a term becomes a blank, A-Z become small
_FOLD = bytes(
    (b | 0x20 if 0x41 <= b <= 0x5A else b) if b in set(_TERM_BYTES) else 0x20 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8").translate(_FOLD).split() if text else []


def _postings(docs: DataFrame, places, block_docs: int, block_postings: int) -> DataFrame:
    """Blocks of documents with their postings of the asked terms."""

    def run(batches):
        known = places.value
        ids: list[int] = []
        lengths: list[int] = []
        at: list[int] = []
        terms: list[int] = []
        counts: list[int] = []

        def pack():
            whole = np.array(lengths, dtype=np.int64)
            row = (
                len(ids), int(whole.sum()), int((whole > 0).sum()), np.array(ids, dtype=np.int64).tobytes(),
                whole.tobytes(), np.array(at, dtype=np.int32).tobytes(), np.array(terms, dtype=np.int32).tobytes(),
                np.array(counts, dtype=np.int32).tobytes(),
            )
            for held in (ids, lengths, at, terms, counts):
                held.clear()
            return pd.DataFrame([row], columns=[c.split()[0] for c in BLOCK.split(", ")])

        for batch in batches:
            for key, text in zip(batch["id"], batch["text"]):
                words = terms_of(text)
                if not words:
                    continue
                row = len(ids)
                ids.append(key)
                lengths.append(len(words))
                for word, n in Counter(words).items():
                    if (place := known.get(word)) is not None:
                        at.append(row)
                        terms.append(place)
                        counts.append(n)
                if len(ids) >= block_docs or len(at) >= block_postings:
                    yield pack()
        if ids:
            yield pack()

    keyed = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("id"), docs["text"].alias("text"))
    return stage(keyed.mapInPandas(run, BLOCK), "ranked-blocks")


def _document_frequencies(blocks: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for cell in batch["terms"]:
                place, n = np.unique(np.frombuffer(cell, dtype=np.int32), return_counts=True)
                yield pd.DataFrame({"place": place, "df": n.astype(np.int64)})

    counted = blocks.select("terms").mapInPandas(run, "place int, df long")
    return counted.groupBy("place").agg(F.sum("df").alias("df"))


class Postings:
    """One block by term: documents, parts of the score, presence bitmaps."""

    def __init__(self, row, docs_all: int, terms_all: int):
        self.ids = np.frombuffer(row.ids, dtype=np.int64)
        lengths = np.frombuffer(row.lengths, dtype=np.int64)
        docs = np.frombuffer(row.docs, dtype=np.int32)
        terms = np.frombuffer(row.terms, dtype=np.int32)
        tf = np.frombuffer(row.counts, dtype=np.int32).astype(np.int64)
        m = 25 + 75 * lengths * docs_all // terms_all
        order = np.argsort(terms, kind="stable")
        self.docs = docs[order]
        tf = tf[order]
        self.parts = 1_000_000_000 * tf // (1000 * tf + 8 * m[self.docs])
        places, starts = np.unique(terms[order], return_index=True)
        ends = np.append(starts[1:], len(terms))
        self.span = {p: (s, e) for p, s, e in zip(places.tolist(), starts.tolist(), ends.tolist())}
        self.top = dict(zip(places.tolist(), np.maximum.reduceat(self.parts, starts).tolist() if len(starts) else []))

    def bitmap(self, place: int) -> np.ndarray:
        bits = np.zeros(-(-len(self.ids) // 8) * 8, dtype=np.uint8)
        start, end = self.span[place]
        bits[self.docs[start:end]] = 1
        return np.packbits(bits)

    def masks(self, places: list[int], bitmaps: dict[int, np.ndarray]) -> np.ndarray:
        """(documents, words) of 64-bit masks, bit j for the j-th place."""
        for p in places:
            if p not in bitmaps:
                bitmaps[p] = self.bitmap(p)
        bits = np.unpackbits(np.array([bitmaps[p] for p in places]), axis=1)[:, : len(self.ids)]
        padded = np.zeros((-(-len(places) // 64) * 64, len(self.ids)), dtype=np.uint8)
        padded[: len(places)] = bits
        packed = np.packbits(padded, axis=0, bitorder="little")
        return np.ascontiguousarray(packed.T).view("<u8")

    def scores(self, docs: np.ndarray, places: list[int], weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(docs), dtype=np.int64)
        for place, weight in zip(places, weights.tolist()):
            start, end = self.span[place]
            held = self.docs[start:end]
            at = np.searchsorted(held, docs)
            hit = np.flatnonzero(at < len(held))
            hit = hit[held[at[hit]] == docs[hit]]
            out[hit] += weight * self.parts[start + at[hit]]
        return out


def merged(old: tuple[np.ndarray, np.ndarray], scores, ids, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of two lists, by score and ascending id."""
    scores, ids = np.concatenate([old[0], scores]), np.concatenate([old[1], ids])
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def search_block(
    block: Postings, places: list[int], weights: np.ndarray, best, k: int, bitmaps, batch_docs: int = 512
):
    """``best`` and the block's documents, ranked; groups that can't enter are not evaluated."""
    here = [j for j, p in enumerate(places) if p in block.span]
    places, weights = [places[j] for j in here], weights[here]
    if not places:
        return best
    groups, members = np.unique(block.masks(places, bitmaps), axis=0, return_inverse=True)
    bits = np.unpackbits(groups.view(np.uint8), axis=1, bitorder="little")[:, : len(places)]
    bounds = bits @ (weights * np.array([block.top[p] for p in places], dtype=np.int64))
    by_bound = np.argsort(-bounds, kind="stable")
    rows = np.argsort(members.ravel(), kind="stable")
    sizes = np.bincount(members.ravel(), minlength=len(groups))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(by_bound):
        bound = bounds[by_bound[at]]
        if bound <= 0 or (len(best[0]) == k and best[0][-1] > bound):
            break
        chosen, n = [], 0
        while at < len(by_bound) and n < batch_docs:
            g = by_bound[at]
            chosen.append(rows[starts[g] : starts[g + 1]])
            n += int(sizes[g])
            at += 1
        docs = np.concatenate(chosen)
        scores = block.scores(docs, places, weights)
        able = np.flatnonzero(scores > 0)
        best = merged(best, scores[able], block.ids[docs[able]], k)
    return best


def _group_search(docs: DataFrame, items: DataFrame, k: int, block_docs: int, block_postings: int) -> DataFrame:
    """Search for a bounded group of items, one pass over the documents."""
    spark = docs.sparkSession
    asked = [(row["item_id"], Counter(terms_of(row["text"]))) for row in items.toLocalIterator()]
    vocabulary = sorted({t for _, terms in asked for t in terms})
    places = {t: i for i, t in enumerate(vocabulary)}
    blocks = _postings(docs, spark.sparkContext.broadcast(places), block_docs, block_postings)
    n_docs, n_terms = blocks.agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))
    ).first()
    weight = np.zeros(len(vocabulary), dtype=np.int64)
    for place, df in _document_frequencies(blocks).toLocalIterator():
        weight[place] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    wanted = []
    for number, (_, terms) in enumerate(asked):
        held = [(places[t], n * int(weight[places[t]])) for t, n in terms.items() if weight[places[t]] > 0]
        held.sort(key=lambda h: -h[1])
        wanted.append((number, [p for p, _ in held], np.array([w for _, w in held], dtype=np.int64)))
    wanted = spark.sparkContext.broadcast(wanted)

    def run(batches):
        best = {}
        nothing = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
        for batch in batches:
            for row in batch.itertuples(index=False):
                block, bitmaps = Postings(row, n_docs, n_terms), {}
                for number, where, weights in wanted.value:
                    best[number] = search_block(block, where, weights, best.get(number, nothing), k, bitmaps)
        out = [(n, int(i), int(s)) for n, (scores, ids) in best.items() for s, i in zip(scores, ids)]
        yield pd.DataFrame(out, columns=["number", "doc_id", "score"])

    found = blocks.mapInPandas(run, "number int, doc_id long, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(n, key) for n, (key, _) in enumerate(asked)], "number int, item_id long")
    return ranked.join(names, "number").select(
        "item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score"
    )


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    term_limit: int = 1_000_000,
    block_docs: int = 8192,
    block_postings: int = 2_000_000,
) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents (doc_id, text) of every item (item_id, text)."""
    ship(docs.sparkSession)
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).distinct()
    # a term takes two characters of the text at least
    total = items.agg(F.coalesce(F.sum(F.length("text") + 1), F.lit(0))).first()[0] // 2
    groups = -(-total // term_limit)
    dealt = items.withColumn("group_", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(groups, 1))))
    out = None
    for group in range(max(groups, 1)):
        part = _group_search(docs, dealt.where(F.col("group_") == group), k, block_docs, block_postings)
        out = part if out is None else out.unionByName(part)
    return out


def op12_mask_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH word AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[0-9a-z\x{80}-\x{10FFFF}]+') AS t
    FROM documents
), doc AS (SELECT r, doc_id, CAST(len(t) AS BIGINT) AS n, t FROM word WHERE len(t) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM doc),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM doc) GROUP BY r, term),
item AS (
    SELECT item_id, term, count(*) AS q
    FROM (SELECT item_id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
          FROM (SELECT DISTINCT item_id, text FROM benchmark))
    GROUP BY item_id, term
), w AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM tf, total WHERE term IN (SELECT term FROM item) GROUP BY term, docs
), s AS (
    SELECT item_id, tf.r,
           CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
    FROM item JOIN w USING (term) JOIN tf USING (term) JOIN doc ON doc.r = tf.r, total
    GROUP BY item_id, tf.r
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT item_id, doc_id, score,
             row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM s JOIN doc ON doc.r = s.r WHERE score > 0)
WHERE rank <= 10
"""
