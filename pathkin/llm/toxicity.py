"""Toxicity by a subsequence string kernel with Nystrom landmarks and a linear machine.

The kernel of two strings counts common subsequences of ``order`` characters, each
gap shrinking a match by ``decay``; it is normalised to one for equal strings and
sharpened to ``exp((k - 1) / spread)``, a Gaussian of the kernel's distance. So a word with dots, blanks or other characters put between its letters stays close to
the word itself. A unit is a blank-separated word in lower case; a run of single
characters is joined to one unit, and a long unit is read in overlapping windows,
so texts are processed whole.

Training takes labelled sentences from a bounded sample of labelled documents: a
sentence of a document with label 0 is negative, and of a document with label 1 the
sentence with the most telling unit is positive (chosen again after each round).
Units that tell the labels apart are the landmarks; the kernel values to them,
whitened, are the features of a linear machine with squared hinge loss. A text's
score is the sigmoid of its most toxic unit.

Null and empty texts score as texts without a telling unit. Without two classes of
labels every score is 0. Repeated rows give repeated results; extra columns are
ignored.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathkin.llm.base import DOC_COLUMNS, fold, labelled_sample, ship, table, whole_text, worker_table

WINDOW, STEP = 24, 12
_SPACED = re.compile(r"(?<!\S)\S(?:\s\S)+(?!\S)")
_EDGE = re.compile(r"^\W+|\W+$")


def units(text: str) -> set[str]:
    text = text.lower()
    words = set(text.split())
    words.update(re.sub(r"\s", "", run) for run in _SPACED.findall(text))
    out = set()
    for word in words:
        if not (word[0].isalnum() and word[-1].isalnum()):
            word = _EDGE.sub("", word)
        if len(word) > 2:
            word = "^" + word  # where a word begins tells, too
        if len(word) <= WINDOW:
            if len(word) > 3:
                out.add(word)
        else:
            out.update(word[at : at + WINDOW] for at in range(0, len(word) - STEP, STEP))
    return out


def parts(unit: str, n: int = 5) -> set[str]:
    return {unit[i : i + n] for i in range(max(1, len(unit) - n + 1))}


class Kernel:
    """Subsequence kernel of many words against fixed landmarks."""

    def __init__(self, landmarks: list[str], order: int = 3, decay: float = 0.6, spread: float = 0.3):
        self.spread = spread
        self.landmarks, self.order, self.decay = landmarks, order, decay
        self.width = max(map(len, landmarks))
        alphabet = sorted(set("".join(landmarks)))
        self.alphabet = np.array([ord(c) for c in alphabet], dtype=np.uint32)
        codes = {c: i + 1 for i, c in enumerate(alphabet)}
        self.same = np.zeros((len(alphabet) + 1, len(landmarks), self.width), dtype=np.float32)
        for m, word in enumerate(landmarks):
            for j, c in enumerate(word):
                self.same[codes[c], m, j] = decay**2
        reach = np.arange(self.width)
        # weight that what ended at j has for the place after it
        gap = reach[None, :] - reach[:, None] - 1
        self.before = np.where(gap >= 0, decay ** np.maximum(gap, 0), 0).astype(np.float32)
        # rows by character: its places in every landmark, and the weight these have further on
        self.flat = self.same.reshape(len(self.same), -1)
        self.onward = (self.same @ self.before).reshape(len(self.same), -1)
        self.own = np.sqrt([self._self(np.array([[ord(c) for c in w]]))[0] for w in landmarks])

    def _encode(self, letters: np.ndarray) -> np.ndarray:
        """Numbers of the landmarks' letters; 0 for all others."""
        at = np.minimum(np.searchsorted(self.alphabet, letters), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == letters, at + 1, 0)

    def _run(self, steps) -> np.ndarray:
        sums, total = None, 0
        for match in steps:
            if sums is None:
                sums = [np.zeros_like(match) for _ in range(self.order - 1)]
            ends = match
            fresh = []
            for held in sums:
                fresh.append(ends)
                ends = match * held
            total = total + ends.sum(axis=-1)
            for held, new in zip(sums, fresh):
                held *= self.decay
                held += new @ self.before
        return total

    def _cross(self, codes: np.ndarray) -> np.ndarray:
        """What ``_run`` gives for sorted words of one length against all landmarks.

        Words that begin alike share their sums: a step works on distinct beginnings.
        """
        words, n = codes.shape
        width = self.flat.shape[1]
        begins = np.ones((words, n), dtype=bool)
        np.logical_or.accumulate(codes[1:] != codes[:-1], axis=1, out=begins[1:])
        node = np.cumsum(begins, axis=0) - 1
        held = [np.zeros((1, width), dtype=np.float32) for _ in range(self.order - 1)]
        total = np.zeros((1, width), dtype=np.float32)
        for i in range(n):
            heads = np.flatnonzero(begins[:, i])
            letters = codes[heads, i]
            if len(heads) > len(total):
                parent = node[heads, i - 1] if i else np.zeros(len(heads), dtype=np.int64)
                held, total = [h[parent] for h in held], total[parent]
            match = self.flat[letters]
            ends = [match * h for h in held]
            total += ends[-1]
            for k, before in enumerate(held):
                before *= self.decay
                if k:
                    before += (ends[k - 1].reshape(-1, self.width) @ self.before).reshape(before.shape)
                else:
                    before += self.onward[letters]
        return total.reshape(len(total), -1, self.width).sum(axis=-1)[node[:, -1]]

    def _self(self, codes: np.ndarray) -> np.ndarray:
        n = codes.shape[1]
        same = (codes[:, :, None] == codes[:, None, :]).astype(np.float32) * self.decay**2
        kept, self.before = self.before, None
        reach = np.arange(n)
        gap = reach[None, :] - reach[:, None] - 1
        self.before = np.where(gap >= 0, self.decay ** np.maximum(gap, 0), 0).astype(np.float32)
        out = self._run(same[:, i] for i in range(n))
        self.before = kept
        return np.maximum(out, 1e-12)

    def values(self, words: list[str]) -> np.ndarray:
        return np.exp((self.alike(words) - 1) / self.spread)

    def alike(self, words: list[str], chunk: int = 512) -> np.ndarray:
        out = np.zeros((len(words), len(self.landmarks)), dtype=np.float32)
        by_length: dict[int, list[int]] = {}
        for i in sorted(range(len(words)), key=words.__getitem__):
            by_length.setdefault(len(words[i]), []).append(i)
        for n, same in by_length.items():
            for at in range(0, len(same), chunk):
                mine = same[at : at + chunk]
                text = "".join([words[i] for i in mine]).encode("utf-32-le", "surrogatepass")
                letters = np.frombuffer(text, dtype="<u4").reshape(len(mine), n)
                own = self._self(letters)
                out[mine] = self._cross(self._encode(letters)) / (np.sqrt(own)[:, None] * self.own)
        return out


def squared_hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weights of a linear machine by Newton steps on the rows inside the margin."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        inside = y * (x @ w) < 1
        a = x[inside] * cost[inside, None]
        new = np.linalg.solve(np.eye(len(w)) + a.T @ x[inside], a.T @ y[inside])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


class Model:
    """Kernel, whitened weights and the sigmoid's line."""

    def __init__(self, toxic: list[str], clean: list[str], landmarks: int = 48):
        bags = [units(t) for t in toxic]
        seen = Counter(u for b in bags for u in b)
        clean_units = Counter(u for t in clean for u in units(t))
        share = len(toxic) / max(1, len(clean))
        # inflected words are rare one by one: a unit tells as much as its best part does
        in_toxic = Counter(p for b in bags for p in {p for u in b for p in parts(u)})
        in_clean = Counter(p for t in clean for p in {p for u in units(t) for p in parts(u)})
        telling = {
            u: max(in_toxic[p] - 3 * share * in_clean[p] for p in parts(u)) - 2 for u in seen
        }
        ranked = sorted((u for u in seen if telling[u] > 0), key=lambda u: (-telling[u], -seen[u], u))
        usual = sorted(clean_units, key=lambda u: (-clean_units[u], u))
        # telling units unlike each other, so that every stem has a landmark
        mine: list[str] = []
        for u in ranked[:2000]:
            if len(mine) < landmarks * 2 // 3 and not (mine and Kernel(mine).alike([u]).max() > 0.5):
                mine.append(u)
        marks = (mine + usual[: landmarks // 3]) or ["---"]
        self.kernel = Kernel([m for m in dict.fromkeys(marks)])
        gram = self.kernel.values(self.kernel.landmarks).astype(float)
        values, vectors = np.linalg.eigh((gram + gram.T) / 2)
        self.root = vectors / np.sqrt(np.maximum(values, 1e-3))
        # sentences of clean texts by their units: frequent ones, and those most like a landmark
        rare = sorted(set(clean_units) - set(usual[:3000]), key=lambda u: hash_of(u))[:20_000]
        near = self.kernel.values(rare)[:, : max(1, len(mine))].max(axis=1) if rare else []
        close = [rare[i] for i in np.argsort(-np.asarray(near))[:3000]]
        negative = usual[:3000] + close
        chosen = [max(b, key=lambda u: (telling[u], u)) for b in bags if b]
        x_neg = self._features(negative)
        clean_bags = [b for b in map(units, clean) if b]
        every = sorted(clean_units)
        for _ in range(3):
            positive = [u for u in chosen if telling[u] > 0] or chosen
            x = np.vstack([self._features(positive), self._features(negative)])
            y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
            cost = np.r_[np.full(len(positive), 1.0), np.full(len(negative), 10.0)]
            self.weights = squared_hinge(x, y, cost)
            # the clean units nearest to the margin become negatives, and bags choose anew
            decided = dict(zip(every, self.decisions(every).tolist()))
            hard = sorted(every, key=lambda u: (-decided[u], u))[:1500]
            negative = list(dict.fromkeys(negative + hard))
            chosen = []
            for b in bags:
                if b:
                    near = sorted(b, key=lambda u: (-telling[u], u))[:5]
                    chosen.append(near[int(np.argmax(self.decisions(near)))])
        top = [max(decided[u] for u in b) for b in clean_bags] or [-1.0]
        bad = [float(self.decisions(sorted(b)).max()) for b in bags if b] or [1.0]
        # the cut lies between what clean texts reach and what toxic texts reach
        self.middle = (float(np.quantile(top, 0.995)) + float(np.quantile(bad, 0.05))) / 2
        self.line = 8.0

    def _features(self, words: list[str]) -> np.ndarray:
        x = self.kernel.values(words).astype(float) @ self.root
        return np.hstack([x, np.ones((len(x), 1))])

    def decisions(self, words: list[str]) -> np.ndarray:
        return self._features(words) @ self.weights if words else np.zeros(0)

    def scores(
        self, texts: list[str], known: list[dict[str, float]], keep: int = 800_000, most_chars: int = 1_000_000
    ) -> list[float]:
        """Scores of texts; ``known`` are two halves, newer and older, of units met before.

        When the newer half has ``keep / 2`` units it becomes the older one. The units of
        texts take many times their memory, so at most ``most_chars`` characters are
        taken apart at once, or one text.
        """
        out: list[float] = []
        some: list[str] = []
        chars = 0
        for text in texts:
            if some and chars + len(text) > most_chars:
                out += self._scores(some, known, keep)
                some, chars = [], 0
            some.append(text)
            chars += len(text)
        return out + (self._scores(some, known, keep) if some else [])

    def _scores(self, texts: list[str], known: list[dict[str, float]], keep: int) -> list[float]:
        bags = [units(t) for t in texts]
        newer, older = known
        met = set().union(*bags) - newer.keys()
        fresh = {u: older[u] for u in met & older.keys()}
        new = list(met - fresh.keys())
        if new:
            fresh.update(zip(new, self.decisions(new).tolist()))
        if len(newer) + len(fresh) > keep // 2:
            known[:] = fresh, newer
        else:
            newer.update(fresh)
        out = []
        for bag in bags:
            best = max([newer[u] if (value := fresh.get(u)) is None else value for u in bag], default=-1.0)
            out.append(1 / (1 + math.exp(-self.line * max(-20.0, min(20.0, best - self.middle)))))
        return out


def hash_of(word: str) -> int:
    import zlib

    return zlib.crc32(word.encode())


def fit(spark: SparkSession, sf_dir: str, sample: int = 1000, max_chars: int = 20_000) -> Model | None:
    """Learned from at most ``sample`` rows of each label, of ``max_chars`` characters at most."""
    rows = labelled_sample(spark, sf_dir, "toxic", sample, max_chars).orderBy("doc_id").collect()
    toxic = [r.text for r in rows if r.label == 1]
    clean = [r.text for r in rows if r.label == 0]
    return Model(toxic, clean) if toxic and clean else None


def scored(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    docs = docs.withColumn("text", whole_text(docs)).select(*keep, *(["text"] if "text" not in keep else []))
    if model is None:
        return docs.withColumn("score", F.lit(0.0))
    shared, key = spark.sparkContext.broadcast(model), uuid.uuid4().hex

    def score(batches):
        # units that this worker has scored with this model
        known = worker_table(key, lambda: [{}, {}])
        for texts in batches:
            yield pd.Series(shared.value.scores(texts.tolist(), known), dtype=float)

    # an iterator function, so that a worker's tasks share the words that it has scored
    from collections.abc import Iterator

    score.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn("score", F.pandas_udf(score, "double")("text"))


def op3_subsequence_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scored(table(spark, sf_dir, "documents"), fit(spark, sf_dir), ["doc_id"])
    return docs.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score"
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with a score of 0.5 or more go."""
    return scored(docs, fit(spark, sf_dir), DOC_COLUMNS).where("score < 0.5").select(*DOC_COLUMNS)
