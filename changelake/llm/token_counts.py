"""Token counts by a tokenizer compiled to a deterministic finite-state transducer.

Reading a word byte by byte, the number of tokens of what has been read changes by an
amount that depends only on a bounded context: the places where a vocabulary entry may
still be under way, the last token before each of them, and the counts there. That
context is a state; a transition carries the change of the count as its output. States
are interned as they are met, so only the part of the machine that texts use is built.

A text is cut into chunks of equal length. A chunk maps the unfinished word it is entered
with to the count and the unfinished word it is left with; white space forgets what was
before, so the map needs only the chunk's first run, the count of the whole words inside,
and its last run. These maps compose associatively and are combined by a prefix scan.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.byte_bpe import vocabulary_file

#: Characters of a chunk.
CHUNK = 1 << 15
#: Words whose counts are kept per Python worker; when full, the memo starts anew.
MEMO = 300_000
MEMO_LENGTH = 64
#: States and transitions kept; beyond, the machine is built anew as texts need it.
STATES = 150_000
ROWS = 256
NONE = -1

#: Python's white space that Unicode doesn't count as such.
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, to the byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + place): byte for place, byte in enumerate(others)}


class WordTransducer:
    """Counts the tokens of one word; a word's last byte is a symbol of its own kind."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        self.letters = byte_letters()
        self.left = {rank: rank for rank in vocabulary.values()}
        self.right = dict(self.left)
        self.merged: dict[tuple[int, int], int] = {}
        self.children: dict[tuple[int, int], int] = {}
        self.inner: list[int] = [NONE]
        self.final: list[int] = [NONE]
        self.parent: list[bool] = [False]
        pairs = {one + two: (vocabulary[one], vocabulary[two]) for one, two in merges}
        for token, rank in sorted(vocabulary.items(), key=lambda item: item[1]):
            if token in pairs:
                one, two = pairs[token]
                if not (one < rank and two < rank):
                    raise ValueError("a merge has to come after the merges of its parts")
                if not self._compatible(one, two, rank):
                    continue  # other merges always come first, so no text gives this token
                self.left[rank], self.right[rank] = one, two
                self.merged[one, two] = rank
            ends = token.endswith(suffix)
            self._add([self.letters[letter] for letter in (token[: -len(suffix)] if ends else token)], rank, ends)
        self._restart()

    def _add(self, path: list[int], rank: int, ends: bool) -> None:
        node = 0
        for byte in path:
            self.parent[node] = True
            node = self.children.setdefault((node, byte), len(self.inner))
            if node == len(self.inner):
                self.inner.append(NONE)
                self.final.append(NONE)
                self.parent.append(False)
        (self.final if ends else self.inner)[node] = rank

    def _restart(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        #: (state, byte) to the next state and the change of the count.
        self.next: dict[int, tuple[int, int]] = {}
        #: (state, last byte of the word) to the change of the count.
        self.last: dict[int, int] = {}
        self._state(((0, NONE, 0),))

    def _state(self, key: tuple) -> int:
        found = self.number.get(key)
        if found is None:
            found = self.number[key] = len(self.states)
            self.states.append(key)
        return found

    def _compatible(self, one: int, two: int, limit: int = 1 << 62) -> bool:
        """Whether no merge across the border of the two comes before the merges inside them."""
        if one == NONE:
            return True
        while True:
            if self.merged.get((one, two), limit) < limit:
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

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        open_, token, count = [], NONE, 0
        for node, before, relative in self.states[state]:
            child = self.children.get((node, byte))
            if child is None:
                continue
            open_.append((child, before, relative))
            if self.inner[child] != NONE and self._compatible(before, self.inner[child]):
                token, count = self.inner[child], relative + 1
        key = tuple((node, before, relative - count) for node, before, relative in open_ if self.parent[node])
        found = self.next[state << 8 | byte] = self._state((*key, (0, token, 0))), count
        return found

    def _compile_last(self, state: int, byte: int) -> int:
        for node, before, relative in self.states[state]:
            child = self.children.get((node, byte))
            if child is not None and self.final[child] != NONE and self._compatible(before, self.final[child]):
                found = self.last[state << 8 | byte] = relative + 1
                return found
        raise ValueError("the vocabulary lacks a byte")

    def count(self, word: bytes) -> int:
        if len(self.states) > STATES:
            self._restart()
        state = total = 0
        following = self.next.get
        for byte in word[:-1]:
            state, change = following(state << 8 | byte) or self._compile(state, byte)
            total += change
        change = self.last.get(state << 8 | word[-1])
        return total + (self._compile_last(state, word[-1]) if change is None else change)


@dataclass(frozen=True)
class Chunk:
    """What a chunk does to the unfinished word it is entered with.

    Without white space inside, `tail` is None: the word goes on through all of `head`.
    """

    head: str
    count: int
    tail: str | None


class TokenCounter:
    def __init__(self, config: dict) -> None:
        model = config["model"]
        known = [part["type"] for part in config["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or model.get("dropout") or known != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("not a lower-casing BPE vocabulary with word ends")
        split = config["pre_tokenizer"]["pretokenizers"][0]
        specials = sorted((token["content"] for token in config["added_tokens"]), key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.marks = {special[:2] for special in specials}
        self.pieces = regex.compile(split["pattern"]["Regex"])
        self.words = WordTransducer(model["vocab"], [tuple(merge) for merge in model["merges"]], model["end_of_word_suffix"])
        self.memo = _Memo(self)

    def run_count(self, run: str) -> int:
        """Tokens of a run without white space."""
        if self.specials and any(mark in run for mark in self.marks):
            parts = self.specials.split(run)
            return len(parts) - 1 + sum(map(self._plain, parts))
        return self._plain(run)

    def _plain(self, run: str) -> int:
        run = unicodedata.normalize("NFC", run)
        # Lower case letter by letter: the form of a letter doesn't depend on its neighbours.
        run = "".join(map(str.lower, run)) if "Σ" in run else run.lower()
        count = self.words.count
        if run.isascii():
            return sum(count(piece.encode()) for piece in self.pieces.findall(run))
        # Characters that Unicode has assigned lately are no letters for the tokenizer yet.
        shown = "".join("\ufffe" if unicodedata.category(letter) == "Cn" else letter for letter in run)
        return sum(count(run[slice(*piece.span())].encode()) for piece in self.pieces.finditer(shown))

    def chunk(self, text: str) -> Chunk:
        if any(mark in text for mark in _SEPARATORS):
            runs = regex.split(r"\s+", regex.sub(r"[\x1c-\x1f]", "﷐", text))
            runs = [run for run in _split_white(text)]
        else:
            runs = text.split()
        if not runs:
            return Chunk("", 0, "" if text else None)
        head = "" if _white(text[0]) else runs.pop(0)
        if len(head) == len(text):
            return Chunk(head, 0, None)
        tail = "" if _white(text[-1]) else runs.pop()
        return Chunk(head, sum(map(self.memo.__getitem__, runs)), tail)

    def joined(self, one: Chunk, two: Chunk) -> Chunk:
        """First `one`, then `two`; associative."""
        if one.tail is None:
            return Chunk(one.head + two.head, two.count, two.tail)
        if two.tail is None:
            return Chunk(one.head, one.count, one.tail + two.head)
        between = one.tail + two.head
        return Chunk(one.head, one.count + two.count + (self.memo[between] if between else 0), two.tail)

    def scan(self, maps: list[Chunk]) -> Chunk:
        """All maps in order, by pairs, then pairs of pairs: as deep as the logarithm of their number."""
        while len(maps) > 1:
            maps = [reduce(self.joined, maps[place : place + 2]) for place in range(0, len(maps), 2)]
        return maps[0] if maps else Chunk("", 0, None)

    def count(self, text: str, size: int = CHUNK) -> int:
        whole = self.scan([self.chunk(text[place : place + size]) for place in range(0, len(text), size)])
        return whole.count + sum(self.memo[run] for run in (whole.head, whole.tail) if run)


def _white(letter: str) -> bool:
    return letter.isspace() and letter not in _SEPARATORS


def _split_white(text: str) -> list[str]:
    """Runs between white space, the four separators being no white space."""
    return regex.findall(r"(?:[^\s]|[\x1c-\x1f])+", text)


class _Memo(dict):
    """Counts of the runs met so far."""

    def __init__(self, counter: TokenCounter) -> None:
        super().__init__()
        self.counter = counter

    def __missing__(self, run: str) -> int:
        count = self.counter.run_count(run)
        if len(run) <= MEMO_LENGTH:
            if len(self) >= MEMO:
                self.clear()
            self[run] = count
        return count


@lru_cache(maxsize=2)
def load(path: str) -> TokenCounter:
    with open(path, encoding="utf-8") as file:
        return TokenCounter(json.load(file))


def count_tokens(df: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text", limit: int | None = None) -> DataFrame:
    """One row per row of `df`: id, `n_bytes` (UTF-8), `n_tokens` and, with a limit, `over_limit`.

    `vocabulary` names a tokenizer file. A null text counts as empty. Ids may be null or
    repeated. Other columns are not read. No shuffle: a text is counted where it is read.
    """
    name = vocabulary_file(df, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(SparkFiles.get(name))
        for batch in batches:
            for row in range(0, batch.num_rows, ROWS):
                part = batch.slice(row, ROWS)
                counts = [counter.count(value or "") for value in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"]
                )

    kind = df.schema[id].dataType.simpleString()
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")
    source = df.select(F.col(id).alias("id"), size.alias("n_bytes"), F.col(text).alias("text"))
    found = source.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id)
    return found if limit is None else found.withColumn("over_limit", F.col("n_tokens") > limit)
