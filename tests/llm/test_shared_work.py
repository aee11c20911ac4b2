"""The forms that share work give what the plain forms give."""

import base64
import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pathkin.llm import ann, base, bsi, neardup, negatives, pii, secrets, toxicity, transducer
from pathkin.session import Workspace, shared_dir


@pytest.fixture(scope="module")
def ranks():
    lines = Path(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).read_bytes().splitlines()
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def test_pairs_stand_as_plain_merging_leaves_them(ranks):
    machine, chance = transducer.Transducer(ranks), random.Random(11)
    every = sorted(machine.tokens)
    short = [i for i in every if len(machine.tokens[i]) <= 3]
    # runs of one or two characters, where merges of one rank overlap
    even = [i for i in every if len(set(machine.tokens[i])) <= 2]
    seen = set()
    for pool in (every, short, even):
        for _ in range(4000):
            left, right = chance.choice(pool), chance.choice(pool)
            want = transducer.merge_bytes(ranks, machine.tokens[left] + machine.tokens[right]) == [left, right]
            assert machine._allowed(left, right) == want
            seen.add(want)
    assert seen == {True, False}


def test_words_encode_as_plain_merging(ranks):
    machine, chance = transducer.Transducer(ranks, max_states=50), random.Random(12)
    letters = ["a", "e", "t", "é", "ß", "日", "😀", " ", "0", "-", "ing", "tion"]
    words = ["".join(chance.choices(letters, k=chance.randrange(1, 25))).encode() for _ in range(600)]
    words += [b"a" * n for n in (1, 2, 3, 17, 500)]
    for word in words:
        assert machine.encode(word) == transducer.merge_bytes(ranks, word)


def test_words_met_again_encode_alike(ranks):
    # the first time the end is decided directly, then states are made, then bytes are jumped over
    machine, chance = transducer.Transducer(ranks), random.Random(15)
    heads = ["stati", "heitl", "aaaaa", "éßé"]
    words = [(chance.choice(heads) + "".join(chance.choices("aeinst-é", k=chance.randrange(80)))).encode() for _ in range(150)]
    for _ in range(4):
        for word in words:
            assert machine.encode(word) == transducer.merge_bytes(ranks, word)
    assert machine.heads


def test_forgotten_words_encode_alike():
    path = transducer.public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    few, many, chance = transducer.TextIds(path, keep=40), transducer.TextIds(path), random.Random(16)
    for _ in range(60):
        text = " ".join("".join(chance.choices("ab.é1\n", k=chance.randrange(0, 5))) for _ in range(40))
        assert few.ids(text) == many.ids(text)
        assert len(few.known) <= 20 and len(few.older) <= 20
    assert few.older


def test_toxic_units_are_remembered_in_halves():
    model = toxicity.Model(["you utter moronic fool"] * 4, ["a quiet street near the river"] * 4)
    texts = [f"word{i} moronic street number{i % 7}" for i in range(40)] + ["", "a"]
    whole = model.scores(texts, [{}, {}])
    known, apart = [{}, {}], []
    for text in texts * 2:
        apart += model.scores([text], known, keep=12)
        assert len(known[0]) <= 6 and len(known[1]) <= 6
    assert known[1]
    assert all(abs(a - b) < 1e-4 for a, b in zip(apart, whole * 2))


def test_merges_that_tie_go_to_the_left():
    # "aa" can stand at two places of "aaa"; "ab" is never made from "a" and "b" once "aa" is
    ranks = {b"a": 0, b"b": 1, b"aa": 2, b"ab": 3, b"aab": 4, b"ba": 5, b"zz": 7, b"z": 6, b"zzq": 8, b"q": 9}
    machine, chance = transducer.Transducer(ranks), random.Random(13)
    for _ in range(2000):
        word = bytes(chance.choices(b"abzq", k=chance.randrange(1, 12)))
        assert machine.encode(word) == transducer.merge_bytes(ranks, word)


def test_kernel_shares_beginnings():
    marks = ["^idiot", "^moron", "^trash", "ab", "^a-b-c-d"]
    kernel, chance = toxicity.Kernel(marks), random.Random(14)
    words = ["".join(chance.choices("^idotmrnashbc-é😀", k=chance.randrange(1, 13))) for _ in range(700)] + marks
    words += words[:20]
    got = kernel.alike(words, chunk=64)

    def plain(a: str, b: str) -> float:
        # every pair of places of three characters each, weighed by the span of both
        n, m = len(a), len(b)
        total = 0.0
        for i in range(n):
            for j in range(m):
                if a[i] != b[j]:
                    continue
                for k in range(i + 1, n):
                    for o in range(j + 1, m):
                        if a[k] != b[o]:
                            continue
                        for e in range(k + 1, n):
                            for f in range(o + 1, m):
                                if a[e] == b[f]:
                                    total += 0.6 ** (e - i + 1 + f - j + 1)
        return total

    # the kernel's own weights: one decay for each matched place and each place skipped
    own = {w: max(plain(w, w), 0.0) for w in words[:60] + marks}
    for i, word in enumerate(words[:60]):
        for j, mark in enumerate(marks):
            size = (own[word] * own[mark]) ** 0.5
            want = plain(word, mark) / size if size else 0.0
            if own[word] and own[mark]:
                assert got[i, j] == pytest.approx(want, abs=2e-4)
    assert np.allclose(got[700:705, :3].diagonal(), 1, atol=1e-4)
    assert np.array_equal(got[:20], got[-20:])


def test_differences_tell_the_similarity():
    rng = np.random.default_rng(15)
    idf = 1 + rng.random(neardup.BUCKETS) * 4
    base = [f"w{i}" for i in rng.integers(0, 50, 90)]

    def edited(k: int) -> str:
        words = list(base)
        for at in rng.integers(0, len(words), k):
            words[at] = f"x{rng.integers(0, 7)}"
        return " ".join(words + "one line that comes again ".split() * int(rng.integers(0, 5)))

    texts = [edited(int(k)) for k in rng.integers(0, 9, 50)] + ["nothing of it at all here", "two words", ""]
    known = [neardup.elements(t, idf) for t in [" ".join(base), *texts]]
    full = [(r, v * c) for r, v, c in known]
    leader = neardup.occurrences(*known[0])
    rows = [neardup.apart(leader, neardup.occurrences(*k)) for k in known[1:]]
    block = {k: [np.frombuffer(r[i], dtype=d) for r in rows] for i, (k, d) in enumerate((("names", np.uint64), ("costs", float), ("firsts", bool)))}
    block |= {k: np.array([r[i] for r in rows], dtype=float) for i, k in enumerate(neardup.TOLD) if i > 2}
    block |= {"n": np.array([len(k[0]) for k in known[1:]], dtype=float), "weight": np.array([w.sum() for _, w in full[1:]])}
    links = 0
    for i in range(len(texts) - 1):  # the empty text has no element and meets nobody
        for j in range(len(texts) - 1):
            want = max(neardup.similarity(full[i + 1], full[j + 1]))
            assert neardup.told(block, i, block, j) == pytest.approx(want, abs=1e-7)
            links += want >= 0.8
    assert 0 < links < len(texts) ** 2


def test_classes_are_those_of_all_pairs(spark, monkeypatch):
    """A group around a leader, chains away from it, over many slots: classes by brute force."""
    monkeypatch.setattr(neardup, "SLOT", 7)
    rng = np.random.default_rng(16)
    base = [f"b{i}" for i in range(160)]
    texts, at = [" ".join(base)], []
    for k in rng.integers(0, 7, 40):
        words = list(base)
        for place in rng.integers(0, len(words), k):
            words[place] = f"y{rng.integers(0, 1000)}"
        texts.append(" ".join(words))
        at.append(words)
    # families that are near each other and further from the base
    for f in range(6):
        words = list(base)
        for place in range(f * 20, f * 20 + 20, 3):
            words[place] = f"family{f}-{place}"
        for v in range(5):
            more = list(words)
            more[(f * 29 + v * 13) % 160] = f"variant{v}"
            texts.append(" ".join(more))
    texts += ["", "", texts[3], "far from all of the others in every word it has"]
    docs = spark.createDataFrame([(i, t, "far") for i, t in enumerate(texts)], "doc_id long, text string, part string")
    rows = {r.doc_id: r.class_id for r in neardup.near_classes(docs).collect()}
    idf, _ = neardup.document_frequencies(docs)
    known = [neardup.weighted(t, idf) for t in texts]
    top = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if max(neardup.similarity(known[i], known[j])) >= 0.8 and top[i] != top[j]:
                low, high = sorted((top[i], top[j]))
                top = [low if x == high else x for x in top]
    assert rows == dict(enumerate(top))
    assert len(set(top)) > 3


def test_blocks_meet_without_a_broadcast(spark):
    chance = np.random.default_rng(9)
    made = [(i, i % 3, [float(a) for a in chance.standard_normal(8)]) for i in range(120)]
    frame = spark.createDataFrame(made, "vec_id long, label int, embedding array<double>")
    whole = bsi.whole_vectors(frame, "vec_id", "embedding", 64)
    unit = ann.unit_vectors(frame, "vec_id", "embedding")
    rows = negatives.whole_rows(frame, "vec_id", "embedding", F.col("label"), 64)
    few = F.col("id") % 50 == 0
    # lists of more chunks than buckets
    near = ann.nearest(unit, unit.where(few), 5, probe_share=1.0, chunk_rows=2, spread=3)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for found in (bsi.top_products(whole, whole.where(few), 10), negatives.hard_negatives(rows, rows.where(few))):
        assert "BroadcastHashJoin" not in plan(found)
    assert "SortMergeJoin [list_id" in plan(near)
    x = {i: np.array(v) / np.linalg.norm(v) for i, _, v in made}
    for i in (0, 50, 100):
        want = sorted((k for k in x if k != i), key=lambda k: -float(x[i] @ x[k]))[:5]
        got = sorted((r.rank, r.vec_id) for r in near.where(F.col("query_id") == i).collect())
        assert [k for _, k in got] == want


def test_a_batch_of_texts_is_taken_apart_in_parts():
    class Counted(toxicity.Model):
        def __init__(self):
            self.middle, self.line, self.most = 0.0, 8.0, 0

        def decisions(self, words):
            self.most = max(self.most, len(words))
            return np.array([len(w) / 100 for w in words])

    texts = [" ".join(f"word{i:03d}x{k:04d}" for k in range(1000)) for i in range(200)] + ["", "longer" * 3]
    whole, parts = Counted(), Counted()
    want = whole.scores(texts, [{}, {}], most_chars=10**9)
    assert parts.scores(texts, [{}, {}]) == want
    # 200,000 units in all
    assert whole.most > 200_000 and parts.most < 100_000


def test_personal_data_is_learned_from_every_base_span(spark, monkeypatch):
    rows = [(i, f"write to mail{i}@site{i % 7}.org now") for i in range(1300)]
    seen, plain = [], pii.rewrites
    monkeypatch.setattr(pii, "rewrites", lambda told: seen.append(told.count()) or plain(told))
    found = pii.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert seen == [1300 + pii.SEEDS]
    assert found.where(F.size("base_") == 1).count() == 1300


def test_near_duplicates_leave_only_their_classes_behind(spark, tmp_path):
    chance = random.Random(21)
    words = [f"w{i}" for i in range(80)]
    base = chance.choices(words, k=60)
    texts = [" ".join(base[:k] + ["new"] + base[k:]) for k in range(0, 60, 4)]
    texts += [" ".join(chance.choices(words, k=60)) for _ in range(10)] + [texts[0], "", None]
    docs = spark.createDataFrame(
        [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    kept = neardup.stage(spark, docs, "")
    left = set(folder.iterdir()) - before
    assert [p.name.split("-")[0] for p in left] == ["kept"]
    assert sorted(r.doc_id for r in kept.collect()) == [0, *range(15, 25), 26]
    neardup.near_classes(docs)
    assert sorted(p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before) == ["kept", "near-classes"]


def test_bands_are_looked_through_without_marks(spark, monkeypatch):
    # rows that go through a shuffle by band hold numbers only
    plans = []
    stage = Workspace.stage

    def watched(self, df, name, by=[]):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stage(self, df, name, by)

    monkeypatch.setattr(Workspace, "stage", watched)
    docs = spark.createDataFrame([(1, "one two three", "en"), (2, "one two three", "en")], "doc_id long, text string, lang string")
    assert [r.class_id for r in neardup.near_classes(docs).collect()] == [1, 1]
    crowded = dict(plans)["crowded"]
    generated = [line for line in crowded.splitlines() if "Generate explode" in line]
    assert generated and not any("mark" in line for line in generated)


def test_texts_without_candidates_meet_nothing(spark):
    texts = ["plain words", 'x password = "abc12345" y', None, "", "0a" * 16, "more plain words"]
    docs = spark.createDataFrame(
        [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    done = secrets.stage(spark, docs, "")
    want = ["plain words", 'x [secret]" y', "", "", "[secret]", "more plain words"]
    assert [r.text for r in done.orderBy("doc_id").collect()] == want
    plan = done._jdf.queryExecution().optimizedPlan().toString()
    first = next(line for line in plan.splitlines() if "Union" in line or "Join" in line)
    assert "Union" in first


def test_a_worker_keeps_one_operators_table():
    import weakref

    class Table:
        pass

    first = base.worker_table("one", Table)
    assert base.worker_table("one", Table) is first
    seen = weakref.ref(first)
    del first
    # the table of the operator before is gone when the next is made
    assert base.worker_table("two", lambda: [seen()]) == [None]
