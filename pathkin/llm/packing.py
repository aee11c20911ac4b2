"""Packing by attention cost: token pieces are dealt to the cheapest open sequence.

A document's ids plus the closing id are cut into full sequences and a rest. The
rest is cut once more at a multiple of ``unit`` ids, so that most pieces fit each
other without a gap and only short crumbs are left over. Every run of
``group_pieces`` pieces of a partition is packed on its own: pieces go in
descending length to the sequence of lowest estimated cost
(``linear * n + quadratic * n * n`` summed over its pieces) that still has room.
Nothing is shuffled, no task holds more than one group, and a repeated task
gives the same sequences.

Null and empty texts hold the closing id only. Repeated rows are packed once
each. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from pathlib import Path

from pathkin.llm.base import ship, table, whole_text, worker_table

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
    " sequence_id long, offset long"
)
SPECIAL = "<|endoftext|>"
_BESIDE_SPACE = re.compile(r" \s|\s ")


class ChunkIds:
    """Ids of a text as little-endian bytes, by chunks that begin at a space.

    The pre-tokenizer always breaks before a single space that stands between
    other characters, so such chunks can be encoded one by one and remembered.
    At most ``keep`` chunks are remembered; others are encoded again.
    """

    def __init__(self, json_path: str, ranks_path: str, keep: int = 250_000):
        import tiktoken

        ranks = {
            base64.b64decode(a): int(b)
            for a, b in map(bytes.split, Path(ranks_path).read_bytes().splitlines())
        }
        coding = tiktoken.Encoding(
            "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._encode = coding.encode_ordinary
        self._json_path = json_path
        self._whole = None
        self._known: dict[str, bytes] = {}
        self._keep = keep

    def _chunk(self, chunk: str) -> bytes:
        ids = np.asarray(self._encode(chunk), dtype="<u4").tobytes()
        if len(self._known) < self._keep and len(chunk) < 64:
            self._known[chunk] = ids
        return ids

    def _with_special(self, text: str) -> bytes:
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self._json_path)
        ids = self._whole.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, dtype="<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if SPECIAL in text:
            return self._with_special(text)
        if _BESIDE_SPACE.search(text):
            return np.asarray(self._encode(text), dtype="<u4").tobytes()
        known = self._known.get
        first, *rest = text.split(" ")
        out = [known(first) or self._chunk(first)] if first else []
        for word in rest:
            chunk = " " + word
            out.append(known(chunk) or self._chunk(chunk))
        return b"".join(out)


def _coder(json_path: str, ranks_path: str) -> ChunkIds:
    return worker_table((json_path, ranks_path), lambda: ChunkIds(json_path, ranks_path))


def cut(total: int, capacity: int, unit: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    pieces = [(at, capacity) for at in range(0, total - capacity + 1, capacity)]
    at = capacity * len(pieces)
    rest = total - at
    even = rest - rest % unit
    if even:
        pieces.append((at, even))
    if rest > even:
        pieces.append((at + even, rest - even))
    return pieces


def assign(
    lengths: np.ndarray, capacity: int, linear: float, quadratic: float
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; longest first, ties in the given order."""
    order = np.argsort(-lengths, kind="stable")
    sequence = np.zeros(len(lengths), dtype=np.int64)
    offset = np.zeros(len(lengths), dtype=np.int64)
    whole = lengths[order] == capacity
    n_whole = int(whole.sum())
    sequence[order[:n_whole]] = np.arange(n_whole)
    rest = order[n_whole:]
    open_count = -(-int(lengths[rest].sum()) // capacity)
    used = np.zeros(open_count, dtype=np.int64)
    cost = np.zeros(open_count)
    for piece in rest:
        n = int(lengths[piece])
        open_cost = np.where(used + n <= capacity, cost, np.inf)
        best = int(open_cost.argmin()) if len(open_cost) else 0
        if not len(open_cost) or open_cost[best] == np.inf:
            best = len(used)
            used, cost = np.append(used, 0), np.append(cost, 0.0)
        sequence[piece], offset[piece] = n_whole + best, used[best]
        used[best] += n
        cost[best] += linear * n + quadratic * n * n
    return sequence, offset


def pack_documents(
    docs: DataFrame,
    json_path: str,
    ranks_path: str,
    capacity: int = 1024,
    unit: int = 128,
    group_pieces: int = 6000,
    linear: float = 1.0,
    quadratic: float = 1.0 / 1024,
) -> DataFrame:
    """Pieces of all documents with their places in sequences of ``capacity`` ids.

    ``json_path`` and ``ranks_path`` are one vocabulary for two libraries.
    """
    ship(docs.sparkSession)

    def run(batches):
        coder = _coder(json_path, ranks_path)
        part = TaskContext.get().partitionId()
        done = 0
        rows: list[tuple] = []

        def flush():
            nonlocal done
            lengths = np.array([r[2] for r in rows], dtype=np.int64)
            sequence, offset = assign(lengths, capacity, linear, quadratic)
            frame = pd.DataFrame(
                rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            )
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            frame["sequence_id"] = (part << 36) + done + sequence
            frame["offset"] = offset
            done += int(sequence.max()) + 1
            rows.clear()
            return frame

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = coder.ids(text) + b"\0\0\0\0"
                total = len(ids) // 4
                key = None if pd.isna(doc_id) else int(doc_id)
                for start, n in cut(total, capacity, unit):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + n)])
                    rows.append((key, start, n, crc, total))
                if len(rows) >= group_pieces:
                    yield flush()
        if rows:
            yield flush()

    return docs.select(docs["doc_id"].cast("long"), whole_text(docs).alias("text")).mapInPandas(
        run, SCHEMA
    )


def _default_paths() -> tuple[str, str]:
    return (
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


def op8_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), *_default_paths())


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of every document it is given."""
    return pack_documents(docs, *_default_paths())
