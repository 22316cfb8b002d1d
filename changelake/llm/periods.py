"""Runs: maximal periodic stretches of a text's words, found by block convolution.

A run is a stretch of words with smallest period q, at least `LEAST` words and `TIMES` q long,
that no neighbouring word extends keeping the period.

1. The words of each text are numbered, equal words alike.
2. At each dyadic scale B the text is cut into blocks of B words. A run of a period q from B
   to 2 B - 1 is 3 q words long at least, so its first 2 q words hold a whole block, which
   occurs again q words on. At the smallest scale, `SMALL`, the shorter periods are sought as
   well: a run of `LEAST` words holds a whole block and its copy there too.
3. A block x occurs at a distance d in what follows, y, if the sum of (x_i - y_(i+d))^2 is
   zero: the squares of x, the running squares of y, less twice their correlation. That is
   computed for all distances at once by a number-theoretic transform, exactly: numbers of words are
   small and the products of as many primes as needed exceed any sum of squares, so that a
   sum is zero only if it is so modulo each of them. All texts' blocks are transformed together.
4. Each such distance seeds an extension: the words on both sides are compared as far as
   they stay d apart. Seeds within a run of a period that divides d are passed over, since
   all they extend to has that period. So what is long enough otherwise is a run of period d.

Texts are read where they lie, nothing is shuffled. Memory is bounded by `CHUNK` bytes of text
or one longer text, and by `CELLS` numbers of a transform or one larger block.

Words are compared by 64-bit hashes; two different words share one with odds of 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.columns import chunks, text_or_empty
from changelake.llm.words import words

#: A run's least number of words, and of periods.
LEAST = 24
TIMES = 3
#: Words of the smallest block. LEAST >= 3 SMALL - 2 and TIMES >= 3 make step 2 hold.
SMALL = 8
#: Bytes of texts, or one longer text, handled together.
CHUNK = 1 << 21
#: Numbers transformed together, or one larger block.
CELLS = 1 << 20
#: Primes k 2^24 + 1 below 2^30 with a primitive root: fixed values. Products of two numbers
#: below 2 p and p fit 64 bits.
PRIMES = ((469762049, 3), (167772161, 3), (754974721, 11))


class Run(NamedTuple):
    """`length` words from word number `start` on, of smallest period `period`."""

    start: int
    length: int
    period: int


_roots: dict[tuple[int, int, bool], list[np.ndarray]] = {}


def _stages(size: int, prime: int, root: int, inverse: bool) -> list[np.ndarray]:
    """For each stage of a transform of `size` numbers, the powers of its root of unity."""
    if (size, prime, inverse) not in _roots:
        stages, span = [], size
        while span > 1:
            unit = pow(root, (prime - 1) // span, prime)
            unit = pow(unit, -1, prime) if inverse else unit
            powers = np.ones(1, np.uint64)
            while len(powers) < span // 2:
                # The powers so far, then the same ones times the next.
                powers = np.concatenate([powers, powers * np.uint64(pow(unit, len(powers), prime)) % np.uint64(prime)])
            stages.append(powers[: span // 2])
            span //= 2
        _roots[size, prime, inverse] = stages
    return _roots[size, prime, inverse]


def _reduced(values: np.ndarray, p: np.uint64, out: np.ndarray) -> None:
    """Values below 2 p modulo p: what is less than p wraps around to large numbers."""
    np.minimum(values, values - p, out=out)


def transform(rows: np.ndarray, prime: int, root: int) -> np.ndarray:
    """Each row's number-theoretic transform modulo `prime`, in bit-reversed order; rows are powers of two long."""
    count, size = rows.shape
    p, out = np.uint64(prime), rows.astype(np.uint64)
    for powers in _stages(size, prime, root, False):
        parts = out.reshape(count, -1, 2, len(powers))
        low, high = parts[:, :, 0], parts[:, :, 1]
        new = np.empty_like(parts)
        _reduced(low + high, p, new[:, :, 0])
        np.remainder((low + (p - high)) * powers, p, out=new[:, :, 1])
        out = new.reshape(count, size)
    return out


def restore(rows: np.ndarray, prime: int, root: int) -> np.ndarray:
    """The rows whose `transform` these are."""
    count, size = rows.shape
    p, out = np.uint64(prime), rows
    for powers in reversed(_stages(size, prime, root, True)):
        parts = out.reshape(count, -1, 2, len(powers))
        low, high = parts[:, :, 0], parts[:, :, 1] * powers % p
        new = np.empty_like(parts)
        _reduced(low + high, p, new[:, :, 0])
        _reduced(low + (p - high), p, new[:, :, 1])
        out = new.reshape(count, size)
    return out * np.uint64(pow(size, -1, prime)) % p


def zero_distances(blocks: np.ndarray, following: np.ndarray, bound: int) -> np.ndarray:
    """Whether each row of `blocks` equals the numbers from place d of its row of `following` on.

    Rows of `following` are twice as long as blocks; the result has a column for each d from 0 to the
    length of a block. `bound` is above all numbers.
    """
    length, count = blocks.shape[1], len(blocks)
    zero, rows, product = np.ones((count, length + 1), bool), np.arange(count), 1
    for prime, root in PRIMES:
        p = np.uint64(prime)
        x, y = blocks[rows] % p, following[rows] % p
        # Correlation is the product with the reversed block; places length - 1 and on don't wrap.
        padded = np.zeros_like(y)
        padded[:, :length] = x[:, ::-1]
        both = transform(padded, prime, root) * transform(y, prime, root) % p
        crossed = restore(both, prime, root)[:, length - 1 : 2 * length]
        sums = np.zeros((len(y), 2 * length + 1), np.uint64)
        np.cumsum(y * y % p, axis=1, out=sums[:, 1:])
        squares = (x * x % p).sum(axis=1, dtype=np.uint64)[:, None] + sums[:, length:] - sums[:, : length + 1]
        zero[rows] &= (squares + (p - crossed) * np.uint64(2)) % p == 0
        product *= prime
        # Only rows with a zero so far need the next prime, if sums may exceed those so far.
        rows = rows[zero[rows].any(axis=1)]
        if product > length * bound * bound or not len(rows):
            return zero
    raise ValueError("a block is too long for three primes")


def seeds(ids: np.ndarray, first: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text, place in `ids` and distance of the blocks of `length` words that occur again.

    `ids` are the numbers of all words, from 1 on; those of text t begin at `first[t]`.
    Distances are `length` to 2 `length` - 1, at the smallest scale from 1 on.
    """
    sizes = np.diff(first)
    blocks = sizes // length
    text = np.repeat(np.arange(len(sizes)), blocks)
    place = first[text] + length * (np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
    # A copy ends within the text.
    near = 1 if length == SMALL else length
    keep = place + near + length <= first[text + 1]
    text, place = text[keep], place[keep]
    step = max(1, CELLS // (2 * length))
    steps = np.arange(2 * length)
    for begin in range(0, len(text), step):
        at, of = place[begin : begin + step], text[begin : begin + step]
        rows = ids[at[:, None] + np.arange(length)]
        for shift in (1, length + 1) if near == 1 else (length,):
            places = at[:, None] + shift + steps
            inside = places < first[of + 1][:, None]
            following = np.where(inside, ids[np.minimum(places, len(ids) - 1)], np.uint64(0))
            # Outside the text there are zeros, which no word's number is.
            bound = max(int(rows.max()), int(following.max())) + 1
            block, distance = np.nonzero(zero_distances(rows, following, bound)[:, :length])
            distance = distance + shift
            found = distance < 2 * length
            yield of[block[found]], at[block[found]], distance[found]


def _agree(left: np.ndarray, right: np.ndarray) -> int:
    """Length of the common beginning, compared in growing pieces."""
    size, done, piece = min(len(left), len(right)), 0, 64
    while done < size:
        end = min(size, done + piece)
        differ = np.flatnonzero(left[done:end] != right[done:end])
        if len(differ):
            return done + int(differ[0])
        done, piece = end, 2 * piece
    return size


def _extended(ids: np.ndarray, runs: list[Run], place: np.ndarray, distance: np.ndarray, length: int) -> None:
    """Adds to `runs` those that the seeds of one text and scale extend to."""
    order = np.lexsort((place, distance))
    place, distance = place[order], distance[order]
    edges = np.flatnonzero(np.diff(distance)) + 1
    for places, d in zip(np.split(place, edges), distance[np.concatenate([[0], edges])].tolist()):
        for run in runs:
            if d % run.period == 0 and len(places):
                places = places[(places < run.start) | (places + d + length > run.start + run.length)]
        done = -1
        for at in places.tolist():
            if at < done:
                continue
            back = _agree(ids[:at][::-1], ids[: at + d][::-1])
            ahead = _agree(ids[at:], ids[at + d :])
            # Blocks that start before this word extend to the same stretch.
            done = at + ahead - length + 1
            if back + ahead + d >= max(LEAST, TIMES * d):
                runs.append(Run(at - back, back + ahead + d, d))


def find(ids: np.ndarray, first: np.ndarray) -> dict[int, list[Run]]:
    """The runs of each text that has any, sorted; places are counted within the text."""
    found: dict[int, list[Run]] = {}
    sizes = np.diff(first)
    length = SMALL
    while len(sizes) and sizes.max() >= max(LEAST, TIMES * (1 if length == SMALL else length)):
        # Texts too short for a run of this scale's periods are left out.
        wanted = np.flatnonzero(sizes >= max(LEAST, TIMES * (1 if length == SMALL else length)))
        part = np.concatenate([ids[first[t] : first[t + 1]] for t in wanted.tolist()]) if len(wanted) < len(sizes) else ids
        begin = np.concatenate([[0], np.cumsum(sizes[wanted])])
        parts = list(seeds(part, begin, length))
        if parts:
            text, place, distance = (np.concatenate(column) for column in zip(*parts))
            order = np.argsort(text, kind="stable")
            text, place, distance = text[order], place[order], distance[order]
            edges = np.flatnonzero(np.diff(text)) + 1
            for of, places, distances in zip(np.split(text, edges), np.split(place, edges), np.split(distance, edges)):
                if len(of):
                    t = int(of[0])
                    runs = found.setdefault(int(wanted[t]), [])
                    _extended(part[begin[t] : begin[t + 1]], runs, places - begin[t], distances, length)
        length *= 2
    return {text: sorted(runs, key=lambda run: (run.start, run.period)) for text, runs in found.items() if runs}


def dropped(runs: Iterable[Run], size: int) -> np.ndarray:
    """Whether each of a text's words lies in a run after its first period."""
    edges = np.zeros(size + 1, np.int64)
    for run in runs:
        edges[run.start + run.period] += 1
        edges[run.start + run.length] -= 1
    return np.cumsum(edges[:-1]) > 0


def text_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[Run]], list[bytes], list[int]]]:
    """For each batch of whole rows, the runs, the words kept, joined by a space, and the number of words."""
    for batch, data, offsets in chunks(batches, "text", CHUNK):
        held = words(data, offsets)
        # Equal words of a chunk have one number; numbers are small, so few primes do.
        ids = np.unique(held.hash, return_inverse=True)[1].astype(np.uint64) + np.uint64(1)
        runs = find(ids, held.first)
        raw, kept = data.tobytes(), []
        for row, (begin, end) in enumerate(zip(held.first[:-1].tolist(), held.first[1:].tolist())):
            spans = zip(held.start[begin:end].tolist(), held.end[begin:end].tolist())
            if row in runs:
                gone = dropped(runs[row], end - begin).tolist()
                spans = (span for span, out in zip(spans, gone) if not out)
            kept.append(b" ".join([raw[a:b] for a, b in spans]))
        yield batch, [runs.get(row, []) for row in range(batch.num_rows)], kept, np.diff(held.first).tolist()


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `df`: id, `n_words`, `runs` (start, length, period, sorted by start, then period), `collapsed`.

    Words are runs without ASCII white space, numbered from 0. `collapsed` is the text of the
    words that no run contains after its first period, joined by one space. A null or empty
    text has no words and no runs, its collapsed text is empty. Rows are independent, so
    repeated ones and null ids are rows of their own. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, runs, kept, sizes in text_runs(batches):
            found = pa.array([[each._asdict() for each in of] for of in runs], pa.list_(_RUN))
            collapsed = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), found, collapsed], ["id", "n_words", "runs", "collapsed"])

    kind = df.schema[id].dataType.simpleString()
    schema = f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    found = df.select(F.col(id).alias("id"), text_or_empty(text).alias("text")).mapInArrow(run, schema)
    return found.withColumnRenamed("id", id)
