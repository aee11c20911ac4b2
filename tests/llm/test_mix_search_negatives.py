"""Mixing, ranked search and hard negatives against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from pathkin.llm import mixing, negatives, ranked

DOCS = "doc_id long, text string, source string, size long, n long, target double, p double"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, 7, 0.5, 0.5) for i, t, s in rows], DOCS)


def targets_by_hand(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """The excess over a cap is shared out again until no source is above its own."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, out, free = share * sum(sizes.values()), {}, set(order)
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > cap * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = cap * sizes[s]
            free.remove(s)
        left = share * sum(sizes.values()) - sum(out.values())
    return out


@pytest.fixture(scope="module")
def mixed_rows():
    rng = np.random.default_rng(4)
    rows = []
    for i in range(420):
        source = [None, "b", "é", "a", "😀", "z"][0 if i < 140 else i % 6]
        n = int(rng.integers(1, 40)) if i % 29 else 300
        rows.append((i, "\tw x " * n, source))
    rows += [(900, None, "a"), (901, "", "a"), (None, "one two", "b"), (None, "one two", "b")]
    return rows + [(950, "same row here", "z")] * 60 + [(960, " \n\t ", "only blank")]


def test_mix_meets_targets(spark, mixed_rows):
    docs = docs_of(spark, mixed_rows)
    out = mixing.mix(docs).collect()
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    assert Counter((r.doc_id, r.source, r.size) for r in out) == Counter(
        (i, s, size(t)) for i, t, s in mixed_rows
    )
    sizes = Counter()
    for i, t, s in mixed_rows:
        sizes[s] += size(t)
    want = targets_by_hand(sizes)
    taken = Counter()
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r.size <= 2 * r.size
        assert r.copies in (math.floor(r.target / max(r.source_size, 1)), math.floor(r.target / max(r.source_size, 1)) + 1)
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.01 * t + 3
    again = mixing.mix(docs.repartition(13, "text")).collect()
    assert Counter(tuple(r) for r in again) == Counter(tuple(r) for r in out)
    other = mixing.mix(docs, seed=2).collect()
    assert Counter(tuple(r) for r in other) != Counter(tuple(r) for r in out)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_words_move_until_one_is_whole(spark):
    units = [(False, "s", i, 5 + i % 7, 1, 100, 0.3) for i in range(100)]
    frame = spark.createDataFrame(
        units, "no_source boolean, source string, doc_id long, size long, copy long, n long, p double"
    )
    tree = mixing._level(frame, mixing.F.lit(3), 1).collect()
    assert len(tree) == 3
    for g in tree:
        before = sum(0.3 * (5 + d.doc_id % 7) for d in [*g.done, g.carried])
        assert {d.p for d in g.done} <= {0.0, 1.0} and 0 <= g.carried.p <= 1
        assert sum(d.p * d["size"] for d in [*g.done, g.carried]) == pytest.approx(before)


def test_one_row_may_hold_most_rows(spark):
    rows = [(None, "a b c", None)] * 2500 + [(1, "x", "s"), (2, "y z", "s")]
    out = mixing.mix(docs_of(spark, rows)).collect()
    assert len(out) == 2502
    hot = [r for r in out if r.source is None]
    assert abs(sum(r.taken for r in hot) - hot[0].target) <= 3


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
SMALL = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def search_by_hand(docs, items, k=10):
    found = [(i, Counter(TERM.findall((t or "").translate(SMALL)))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n_docs, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for key, text in set(items):
        terms = Counter(TERM.findall((text or "").translate(SMALL)))
        scored = []
        for i, c in found:
            m = 25 + 75 * sum(c.values()) * n_docs // total
            s = sum(
                q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t, q in terms.items()
            )
            if s > 0:
                scored.append((-s, ranked.NO_ID if i is None else i))
        for rank, (s, i) in enumerate(sorted(scored)[:k], 1):
            out.append((key, rank, None if i == ranked.NO_ID else i, -s))
    return Counter(out)


@pytest.mark.parametrize("block_docs, limit", [(8192, 1_000_000), (7, 20)])
def test_search_is_brute_force(spark, block_docs, limit):
    rng = np.random.default_rng(6)
    words = ["the", "Ünder", "ünder", "a1", "İx", "日本", "x-y", "B", "b", "zz", "q", "😀", *[f"w{i}" for i in range(60)]]
    texts = [" ".join(rng.choice(words, int(rng.integers(1, 50)))) for _ in range(150)]
    docs = list(enumerate(texts)) + [(7, texts[3]), (7, texts[3]), (None, texts[5]), (None, None), (600, ""), (601, "!? \x00")]
    docs += [(602, "the " * 40_000), (603, "long" * 20_000)] + [(700 + i, "same copy of w1 w2") for i in range(40)]
    items = [(i, " ".join(rng.choice(words, 9))) for i in range(12)] + [(3, "W1 w1, w2"), (3, "W1 w1, w2")]
    items += [(20, None), (21, "..."), (22, "not found anywhere"), (None, "w3 日本"), (23, " ".join(words))]
    frame = docs_of(spark, [(i, t, "s") for i, t in docs]).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = ranked.ranked_search(frame, asked, term_limit=limit, block_docs=block_docs)
    assert Counter(tuple(r) for r in got.collect()) == search_by_hand(docs, items)
    assert ranked.ranked_search(frame.limit(0), asked).count() == 0
    assert ranked.ranked_search(frame, asked.limit(0)).count() == 0


def test_groups_that_cannot_enter_are_not_evaluated(spark):
    docs = docs_of(spark, [(i, "rare word" if i < 5 else f"common {i}", "s") for i in range(3000)])
    places = {b"rare": 0, b"common": 1}
    row = ranked._postings(docs.coalesce(1), spark.sparkContext.broadcast(places), 8192, 10**6).toPandas().iloc[0]
    block = ranked.Postings(row, 3000, 6000)
    evaluated, inner = [], block.scores
    block.scores = lambda d, *rest: (evaluated.extend(d), inner(d, *rest))[1]
    nothing = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
    best = ranked.search_block(block, [0, 1], np.array([7000, 1]), nothing, 5, {}, batch_docs=4)
    assert sorted(best[1].tolist()) == [0, 1, 2, 3, 4] and len(evaluated) == 5


def test_residues_give_the_products():
    rng = np.random.default_rng(8)
    for reach, dims in [(3, 1), (300, 64), (10**6, 130), (10**8, 5)]:
        a = rng.integers(-reach, reach + 1, (9, dims))
        b = rng.integers(-reach, reach + 1, (11, dims))
        a[0], b[0], b[1] = reach, reach, -reach
        assert (negatives.products(a, b) == a @ b.T).all()
    assert (negatives.products(np.zeros((2, 3), dtype=np.int64), np.ones((1, 3), dtype=np.int64)) == 0).all()
    with pytest.raises(OverflowError):
        negatives.primes_for(1 << 80)


def negatives_by_hand(rows):
    out = []
    for a, (la, va) in rows.items():
        if a % 50:
            continue
        scores = {b: sum(x * y for x, y in zip(va, vb)) for b, (_, vb) in rows.items() if b != a}
        order = sorted(scores, key=lambda b: (-scores[b], b))
        for p in [b for b in order if rows[b][0] == la][:5]:
            fit = [b for b in order if rows[b][0] != la and 50 * scores[p] <= 100 * scores[b] <= 95 * scores[p]]
            out += [(a, p, i, b, scores[p], scores[b]) for i, b in enumerate(fit[:3], 1)]
    return Counter(out)


def test_negatives_are_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = {i: (int(rng.integers(0, 3)), [int(x) for x in rng.integers(-40, 60, 6)]) for i in range(260)}
    for i in range(60, 130):
        rows[i] = (rows[i][0], rows[60][1])
    rows[150] = (1, [0] * 6)
    rows[300] = (9, [1, 2, 3, 4, 5, 6])
    rows[350] = (1, [5, 5])
    data = [(i, [x / 256 for x in v], l, "x", 1) for i, (l, v) in rows.items()]
    data += data[50:70] + [(900, None, 1, "x", 1), (950, [1.0, None], 1, "x", 1), (1000, [float("nan")] * 6, 1, "x", 1)]
    data += [(1050, [], 1, "x", 1), (1100, [1.0] * 6, None, "x", 1), (None, [1.0] * 6, 1, "x", 1)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int, id string, score int")
    whole = negatives.whole_rows(frame.repartition(3), "vec_id", "embedding", negatives.F.col("label"), 256)
    want = negatives_by_hand(rows)
    for block in (8192, 17):
        got = negatives.hard_negatives(whole, whole.where("id % 50 = 0"), block_rows=block, anchor_block=2)
        assert Counter(tuple(r) for r in got.collect()) == want
    none = whole.limit(0)
    assert negatives.hard_negatives(none, none).count() == 0


def test_an_id_on_several_texts_is_judged_for_each(spark):
    from pathkin.llm import neardup

    rng = np.random.default_rng(3)
    a, b, c = (" ".join(f"{name}{rng.integers(0, 50)}x{i}" for i in range(60)) for name in "abc")
    near_b = b + " and one more"
    rows = [(2, b), (5, a), (5, b), (5, a), (9, near_b), (None, c), (None, c), (None, b), (7, ""), (8, None)]
    docs = spark.createDataFrame(
        [(i, t, "en", "s", len(t or ""), "p", 1) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, part string, mark int",
    )
    got = sorted(((r.doc_id, r.text) for r in neardup.stage(spark, docs, "").collect()), key=str)
    assert got == sorted([(2, b), (5, a), (7, ""), (None, c)], key=str)
    chain = spark.range(70).select(mixing.F.col("id").cast("string").alias("a"), (mixing.F.col("id") + 1).cast("string").alias("b"))
    assert {r.part for r in neardup.components(chain).collect()} == {"0"}
    assert neardup.stage(spark, docs.limit(0), "").count() == 0
