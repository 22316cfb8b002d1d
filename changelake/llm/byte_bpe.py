"""Byte-level BPE by longest matches and backtracking.

A sequence of tokens is the one that the merges give exactly if each two adjacent
tokens are compatible: encoding the bytes of the two together gives these two. The
encoder walks a piece of text, takes the longest token at each place, and steps back
to shorter ones where two neighbours aren't compatible. A place once given up is not
tried again, so the number of steps grows with the length of the piece.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces whose ids, and pairs of tokens whose compatibility, are kept per Python worker;
#: when full, a memo starts anew. An entry takes about 200 bytes.
MEMO = 200_000
PAIRS = 150_000
#: Longer pieces are encoded but not kept.
MEMO_LENGTH = 64
#: Rows encoded before their results are sent on.
ROWS = 64
NONE = -1


def read_ranks(lines: bytes) -> list[bytes]:
    """Token bytes by rank, from lines of base64 and rank."""
    ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines.splitlines()) if token}
    return [ranks[rank] for rank in range(len(ranks))]


class ByteBpe:
    """Encoder and decoder of one vocabulary, given by token bytes in the order of their ranks."""

    def __init__(self, tokens: list[bytes], pattern: str) -> None:
        self.tokens = tokens
        self.pieces = regex.compile(pattern)
        self.rank = {token: rank for rank, token in enumerate(tokens)}
        # Latin-1 gives each byte one character, so the automaton's places are byte places.
        self.automaton = ahocorasick.Automaton()
        for rank, token in enumerate(tokens):
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.shorter = [self._longest_proper_prefix(token) for token in tokens]
        self.left: list[int] = []
        self.right: list[int] = []
        self.merged: dict[tuple[int, int], int] = {}
        for rank in range(len(tokens)):
            self._split(rank)
        self.known: dict[int, bool] = {}
        self.memo = _Memo(self)

    def _longest_proper_prefix(self, token: bytes) -> int:
        for size in range(len(token) - 1, 0, -1):
            if (rank := self.rank.get(token[:size])) is not None:
                return rank
        return NONE

    def _split(self, rank: int) -> None:
        """The two tokens whose merge makes this one, or itself twice for a single byte."""
        token, head = self.tokens[rank], self.shorter[rank]
        while head != NONE:
            tail = self.rank.get(token[len(self.tokens[head]) :])
            if tail is not None and head < rank and tail < rank and self._check(head, tail):
                self.merged[head, tail] = rank
                self.left.append(head)
                self.right.append(tail)
                return
            head = self.shorter[head]
        self.left.append(rank)
        self.right.append(rank)

    def _check(self, one: int, two: int) -> bool:
        """Whether no merge across the border of the two comes before the merges inside them.

        The inner border parts are undone from the latest merge on; a merge across the
        border with a lower rank than the last one undone would have come first.
        """
        limit = len(self.tokens)
        while True:
            across = self.merged.get((one, two))
            if across is not None and across < limit:
                return False
            if one > two:
                limit, one = one, self.right[one]
                if one == limit:
                    limit, two = two + 1, self.left[two]
                    if two + 1 == limit:
                        return True
            else:
                limit, two = two + 1, self.left[two]
                if two + 1 == limit:
                    limit, one = one, self.right[one]
                    if one == limit:
                        return True

    def compatible(self, one: int, two: int) -> bool:
        pair = one << 32 | two
        found = self.known.get(pair)
        if found is None:
            if len(self.known) >= PAIRS:
                self.known.clear()
            found = self.known[pair] = self._check(one, two)
        return found

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        tokens, size = self.tokens, len(piece)
        longest = [NONE] * size
        for end, rank in self.automaton.iter(piece.decode("latin-1")):
            start = end + 1 - len(tokens[rank])
            if longest[start] == NONE or len(tokens[longest[start]]) < len(tokens[rank]):
                longest[start] = rank
        open_places = bytearray(b"\x01") * (size + 1)
        out: list[int] = []
        place, token = 0, longest[0]
        while place < size:
            end = place + len(tokens[token])
            if open_places[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                place = end
                token = longest[place] if place < size else NONE
            elif self.shorter[token] != NONE:
                token = self.shorter[token]
            else:
                open_places[place] = 0
                token = out.pop()
                place -= len(tokens[token])
        return out

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, self.pieces.findall(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def forget(self) -> None:
        """Free the memos; an idle Python worker then holds the vocabulary only."""
        self.memo.clear()
        self.known.clear()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class _Memo(dict):
    """Packed ids of the pieces met so far."""

    def __init__(self, bpe: ByteBpe) -> None:
        super().__init__()
        self.bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        ids = self.bpe.encode_piece(piece.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= MEMO:
                self.clear()
            self[piece] = packed
        return packed


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBpe:
    with open(path, "rb") as file:
        return ByteBpe(read_ranks(file.read()), pattern)


def vocabulary_file(df: DataFrame, path: str) -> str:
    """The file sent once to every executor with the job; gives its name there."""
    df.sparkSession.sparkContext.addFile(path)
    return path.rpartition("/")[2]


def encode(df: DataFrame, ranks: str, pattern: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `df`: id, `ids` (binary, little-endian unsigned 32-bit), `decoded` (binary).

    `ranks` names a rank file. A null text counts as empty and gives no ids. Ids may be
    null or repeated; each row gets its own result. Other columns are not read. No shuffle:
    a text is encoded where it is read, and nothing but the vocabulary outlives a task.
    """
    name = vocabulary_file(df, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(SparkFiles.get(name), pattern)
        for batch in batches:
            for row in range(0, batch.num_rows, ROWS):
                part = batch.slice(row, ROWS)
                ids = [bpe.encode_bytes(value or "") for value in part.column(1).to_pylist()]
                decoded = [bpe.decode(np.frombuffer(packed, "<u4").tolist()) for packed in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], ["id", "ids", "decoded"]
                )
        bpe.forget()
        pa.default_memory_pool().release_unused()

    kind = df.schema[id].dataType.simpleString()
    found = df.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, ids binary, decoded binary")
    return found.withColumnRenamed("id", id)
