"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

For every prefix of a word the last token of its encoding is fixed by the merges:
it is the one suffix token that may stand beside the last token of what precedes
it. A state is the last emitted token and the bytes not yet decided; reading a
byte moves to the next state and emits the tokens that every continuation shares.
Continuations can only start at the longest suffix that begins some token, so the
lookahead is bounded by the longest token. States and transitions are kept in a
table of bounded size. A transition's state is made when the transition is met a
second time: most ends of words are met once, so the first time what is left of a
short word is decided from the state reached, byte by byte, without further states.

Null texts count as empty. A repeated row gives a repeated result; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from pathkin.llm.base import ship, table, whole_text

_BESIDE_SPACE = re.compile(r" \s|\s ")


def merge_bytes(ranks: dict[bytes, int], word: bytes) -> list[int]:
    """Plain merging, lowest rank first and leftmost on ties; decides token pairs."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    def __init__(self, ranks: dict[bytes, int], max_states: int = 300_000):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.sizes = {i: len(t) for t, i in ranks.items()}
        self.starts = {t[:n] for t in ranks for n in range(1, len(t))}
        self.max_states = max_states
        self.beside: dict[tuple[int, int], bool] = {}
        # the two tokens whose merge makes a token, and the reverse; one byte stands for itself
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.clear()

    def clear(self) -> None:
        # a state: [last emitted token, undecided bytes, last token of each prefix, moves,
        # for each prefix the places where its tokens begin or end, as bits, and the length
        # of the longest end of the undecided bytes that begins a longer token]
        self.root = [-1, b"", (-1,), {}, (1,), 0]
        self.states = {(-1, b""): self.root}
        # what the first bytes of long words lead to: the state and the tokens emitted so far
        self.heads: dict[bytes, tuple[list, list[int]]] = {}

    def _halves(self, token: int) -> tuple[int, int]:
        """The last merge of a token's own bytes; the token twice, if merging doesn't make it."""
        known = self.halves.get(token)
        if known is None:
            text = self.tokens[token]
            ends = [(i, j) for i in range(len(text)) for j in range(i + 1, len(text) + 1)]
            found = {text[i:j]: self.ranks.get(text[i:j]) for i, j in ends}
            # single bytes are there from the start, whatever their rank
            below = {t: r for t, r in found.items() if r is not None and (r < token or len(t) == 1)}
            parts = merge_bytes(below, text) if len(text) > 1 else [token]
            known = self.halves[token] = (parts[0], parts[1]) if len(parts) == 2 else (token, token)
        return known

    def _allowed(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both, or of ``right`` alone, leaves just these tokens."""
        pair = (left, right)
        known = self.beside.get(pair)
        if known is None:
            if len(self.beside) > 1_000_000:
                self.beside.clear()
            if left < 0:
                known = self.sizes[right] == 1 or self._halves(right)[0] != right
            else:
                known = self._apart(left, right)
            self.beside[pair] = known
        return known

    def _apart(self, left: int, right: int) -> bool:
        """No merge across the border comes before the merges that make both tokens.

        The tokens at the border are undone step by step, the later merge first. While
        two stand there, they'd merge unless one was already taken into a larger token.
        """
        if not (self._allowed(-1, left) and self._allowed(-1, right)):
            return False
        ranks, tokens, sizes = self.ranks, self.tokens, self.sizes
        # rank at which the left or the right border token goes into a larger one, and which it was
        left_gone = right_gone = 1 << 62
        while True:
            across = ranks.get(tokens[left] + tokens[right])
            # ties between equal ranks go to the left: the left token's own merge comes first
            if across is not None and across < left_gone and across <= right_gone:
                return False
            whole_left, whole_right = sizes[left] == 1, sizes[right] == 1
            if whole_left and whole_right:
                return True
            if whole_right or (not whole_left and left > right):
                left_gone, left = left, self._halves(left)[1]
            else:
                right_gone, right = right, self._halves(right)[0]

    def _tokens(self, lasts: tuple[int, ...], end: int) -> list[int]:
        """Tokens up to ``end``, in order."""
        out = []
        sizes = self.sizes
        while end > 0:
            out.append(lasts[end])
            end -= sizes[lasts[end]]
        return out[::-1]

    def move(self, state: list, byte: int) -> tuple[list, tuple[int, ...]]:
        emitted_last, before, lasts, moves, places, depth = state
        text = before + bytes((byte,))
        n = len(text)
        # what ends here and is a token, or begins one, began by the byte before
        ranks, allowed = self.ranks, self._allowed
        for at in range(n - depth - 1, n):
            last = ranks.get(text[at:])
            if last is not None and allowed(lasts[at], last):
                break
        else:
            raise ValueError("the vocabulary lacks a single byte")
        starts = self.starts
        depth += 1
        while depth and text[n - depth :] not in starts:
            depth -= 1
        lasts += (last,)
        shared = place = 1 << n | places[n - self.sizes[last]]
        places += (place,)
        for live in range(n - depth, n):
            shared &= places[live]
            if shared == 1:
                break
        # the last place that every continuation shares
        cut = (shared & ((2 << (n - depth)) - 1)).bit_length() - 1
        if cut:
            emitted = tuple(self._tokens(lasts, cut))
            emitted_last, text, lasts = lasts[cut], text[cut:], lasts[cut:]
            places = tuple([p >> cut for p in places[cut:]])
        else:
            emitted = ()
        key = (emitted_last, text)
        target = self.states.get(key)
        if target is None:
            target = self.states[key] = [emitted_last, text, lasts, {}, places, depth]
        moves[byte] = move = (target, emitted)
        return move

    def _rest(self, state: list, rest: bytes) -> list[int]:
        """Tokens of what the state has not decided and ``rest``, which ends the word."""
        _, before, lasts, _, _, depth = state
        text, lasts = before + rest, list(lasts)
        size = len(text)
        ranks, starts, beside, allowed = self.ranks.get, self.starts, self.beside.get, self._allowed
        for n in range(len(before) + 1, size + 1):
            for at in range(n - depth - 1, n):
                last = ranks(text[at:n])
                if last is not None:
                    left = lasts[at]
                    fits = beside((left, last))
                    if allowed(left, last) if fits is None else fits:
                        break
            else:
                raise ValueError("the vocabulary lacks a single byte")
            lasts.append(last)
            # nothing goes on after the last byte
            if n < size:
                depth += 1
                while depth and text[n - depth : n] not in starts:
                    depth -= 1
        return self._tokens(lasts, size)

    def encode(self, word: bytes, short: int = 64, head: int = 5) -> list[int]:
        whole = self.ranks.get(word)
        if whole is not None:
            return [whole]
        if max(len(self.states), len(self.heads)) > self.max_states:
            self.clear()
        met = self.heads.get(word[:head])
        if met is None:
            state, out, at = self.root, [], 0
        else:
            (state, out), at = met, head
            out = out[:]
        size = len(word)
        while at < size:
            byte = word[at]
            move = state[3].get(byte)
            if not move:
                if move is None and size - at <= short:
                    state[3][byte] = ()
                    return out + self._rest(state, word[at:])
                move = self.move(state, byte)
            state = move[0]
            if move[1]:
                out += move[1]
            at += 1
            if at == head:
                self.heads[word[:head]] = state, out[:]
        return out + self._tokens(state[2], len(state[1]))


class TextIds:
    """Ids of whole texts as little-endian bytes.

    At most ``keep`` pieces and chunks are remembered, in two halves: when the newer half
    is full it becomes the older one, and what is met again there goes to the newer.
    """

    def __init__(self, ranks_path: str, keep: int = 1_200_000):
        import regex

        lines = Path(ranks_path).read_bytes().splitlines()
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.transducer = Transducer(self.ranks)
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.keep = keep
        # a piece and a chunk of the same characters have the same ids
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _remember(self, piece: str, ids: bytes) -> bytes:
        if len(piece) < 64:
            if len(self.known) >= self.keep // 2:
                self.older, self.known = self.known, {}
            self.known[piece] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        before = self.older.get(piece)
        if before:
            return self._remember(piece, before)
        ids = self.transducer.encode(piece.encode())
        return self._remember(piece, struct.pack(f"<{len(ids)}I", *ids))

    def _chunk(self, chunk: str) -> bytes:
        before = self.known.get(chunk) or self.older.get(chunk)
        if before:
            return self._remember(chunk, before)
        pieces = self.split(chunk)
        if len(pieces) == 1:
            return self._piece(chunk)
        ids = b"".join([self.known.get(p) or self._piece(p) for p in pieces])
        return self._remember(chunk, ids)

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if _BESIDE_SPACE.search(text):
            return b"".join([self.known.get(p) or self._piece(p) for p in self.split(text)])
        # the pattern always breaks before a lone space, so these chunks are whole pieces
        first, *rest = text.split(" ")
        chunks = [" " + word for word in rest]
        if first:
            chunks.insert(0, first)
        get = self.known.get
        # what is not in the newer half now is looked for, or encoded, in its turn
        return b"".join([get(chunk) or self._chunk(chunk) for chunk in chunks])


class StreamDecoder:
    """Text from ids that come in pieces; the state is the unfinished character's bytes."""

    def __init__(self, tokens: list[bytes]):
        self.tokens, self.pending = tokens, b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """Bytes at the end that begin a character but don't complete it."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead & 0xC0 == 0x80:
                continue
            need = 4 if lead >= 0xF0 else 3 if lead >= 0xE0 else 2 if lead >= 0xC0 else 1
            return back if need > back else 0
        return 0

    def feed(self, ids: list[int]) -> str:
        tokens = self.tokens
        data = self.pending + b"".join([tokens[i] for i in ids])
        held = self._unfinished(data)
        self.pending = data[len(data) - held :]
        return data[: len(data) - held].decode("utf-8")

    def close(self) -> None:
        if self.pending:
            raise ValueError("the ids end inside a character")


@lru_cache(maxsize=2)
def _coder(ranks_path: str) -> tuple[TextIds, list[bytes]]:
    coder = TextIds(ranks_path)
    tokens = [b""] * (max(coder.ranks.values()) + 1)
    for token, i in coder.ranks.items():
        tokens[i] = token
    return coder, tokens


def encode_decode(docs: DataFrame, ranks_path: str, step: int = 65_536) -> DataFrame:
    """Ids' count and hash for each text, and the hash of the bytes they decode to."""
    ship(docs.sparkSession)

    def run(batches):
        coder, tokens = _coder(ranks_path)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                data = coder.ids(text)
                ids = np.frombuffer(data, dtype="<u4")
                decoder, digest = StreamDecoder(tokens), hashlib.sha256()
                for at in range(0, len(ids), step):
                    digest.update(decoder.feed(ids[at : at + step].tolist()).encode())
                decoder.close()
                rows.append((len(ids), hashlib.sha256(data).hexdigest(), digest.hexdigest()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").values)
            yield out

    return docs.select(docs["doc_id"].cast("long"), whole_text(docs).alias("text")).mapInPandas(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op9_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_decode(table(spark, sf_dir, "documents"), path)
