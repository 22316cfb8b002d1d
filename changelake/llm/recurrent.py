"""A gated recurrent language model, learned over all texts and applied to whole ones.

1. **Counts.** Each task counts the tokens of its texts, one shuffle adds them up. Tokens are
   words and one end for each text. The `HEAD` most frequent ones, two occurrences at least,
   are known to every task; the counts of all others stay a table.
2. **Symbols.** The `WORDS` most frequent tokens are symbols of their own, in classes of `CLASS`.
   The rest of the head makes bands by rank, each a class and a symbol; all other tokens, unknown
   ones too, are one more. Texts are stored as symbols.
3. **Output.** P(token) is P(class | state) times P(symbol | class, state), both softmaxes of
   the state; in a band it is the token's share of the band's tokens. Of the last class, unknown tokens have a
   fixed part, by how many of its tokens occur once, and others their share of the rest. All
   unknown tokens count as one type, so probabilities add up to one.
4. **Learning.** Texts lie end to end in `LANES` lanes of about equal length. Windows of `WINDOW`
   steps or more are learned by backpropagation, truncated at the window; the state goes on to the
   next one and starts anew with each text. Biases start at the tokens' shares, so an
   unlearned model gives the tokens' frequencies. All texts are dealt by hash to `ROUNDS` of growing
   size; in each, every task learns from its own, and the parameters are averaged by tokens, added up
   in two steps so that no task reads those of more than a part of the tasks.
5. **Scores.** The same lanes run over whole texts. What depends on the count of a token
   outside the head comes from a join with the table of counts, by shuffle.

Tokens are 64-bit hashes; two different ones share one with odds of 2^-64 for a pair. Memory
of a task is bounded by `BUFFER` tokens or one longer text, that of a model by `HEAD` and `WORDS`.
"""

from __future__ import annotations

import copy
import heapq
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm.columns import chunks, stored
from changelake.llm.words import LOWER, words

#: Tokens whose counts all tasks know, at most; symbols of their own, and those of a class.
HEAD = 1 << 18
WORDS = 1024
CLASS = 32
#: A band ends at this many times the rank at which it begins.
BAND = 4
#: Numbers of the state.
UNITS = 16
#: Texts run side by side, least and most steps of a window, and tokens of a plan of lanes. Where
#: few lanes go on, windows are as many times longer.
LANES = 256
WINDOW = 16
LONGEST = 128
BUFFER = 1 << 22
#: Where the parts end that the rounds learn from, of `PARTS`, and their rates.
PARTS = 64
ROUNDS = ((4, 0.01), (20, 0.006), (64, 0.003))
#: Bytes of texts whose words are counted or looked up together, and counts that a task holds.
CHUNK = 1 << 20
HELD = 1 << 21
#: Stands for the end of a text; words aren't empty. Fixed value.
END = -1
#: What the counts of unknown tokens are taken for in the base score. Fixed by the task.
ADDED = 0.1
#: Log counts are cut into so many bins for each doubling when the head's least count is sought.
BINS = 64

_PAD = np.float32(-1e9)


# Counts and symbols


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = rows = 0

    def added() -> tuple[np.ndarray, np.ndarray]:
        values, place = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        return values, np.bincount(place, np.concatenate([c for _, c in held])).astype(np.int64)

    def batch_of(values: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["token", "c"])

    for batch, data, offsets in chunks(batches, "text", CHUNK):
        rows += batch.num_rows
        found = np.unique(words(data, offsets, LOWER).hash, return_counts=True)
        held.append(found)
        size += len(found[0])
        if size > HELD:
            held = [added()]
            size = len(held[0][0])
            if size > HELD // 2:
                yield batch_of(*held.pop())
                size = 0
    if held:
        yield batch_of(*added())
    if rows:
        yield batch_of(np.array([END]), np.array([rows]))


def token_counts(texts: DataFrame) -> DataFrame:
    """`token`, `c`: hashes and occurrences of all tokens of a column `text`."""
    return texts.select("text").mapInArrow(_count, "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Totals of the learned tokens, and the head, the end first and then by falling counts."""

    total: int
    types: int
    once: int
    tokens: np.ndarray
    counts: np.ndarray

    def __post_init__(self) -> None:
        size = len(self.tokens)
        self.own = min(WORDS, size)
        self.classes = -(-self.own // CLASS)
        edges, low = [], self.own
        while low < size:
            edges.append(min(size, max(low * BAND, low + 1)))
            low = edges[-1]
        #: Last ranks of the bands; their symbols and classes come after the own ones.
        self.edges = np.array(edges, np.int64)
        self.outputs = self.classes + len(edges) + 1
        self.symbols = self.own + len(edges) + 1
        rank = np.arange(size)
        band = np.searchsorted(self.edges, rank, "right")
        self.symbol = np.where(rank < self.own, rank, self.own + band).astype(np.uint16)
        self.class_of = np.concatenate([np.arange(self.own) // CLASS, self.classes + np.arange(len(edges) + 1)])
        #: Tokens that are learned of each symbol; the last are those outside the head.
        self.rest = self.total - int(self.counts.sum())
        mass = np.bincount(self.symbol, self.counts, self.symbols) if size else np.zeros(self.symbols)
        mass[-1] = self.rest
        self.mass = mass
        # Logarithm of the share within the band.
        with np.errstate(divide="ignore", invalid="ignore"):
            self.share = np.where(rank < self.own, 0.0, np.log(self.counts) - np.log(mass[self.symbol])) if size else np.zeros(0)
        self.base = np.log10((self.counts + ADDED) / self.whole)
        order = np.argsort(self.tokens.view(np.uint64))
        self.order, self.sorted = order, self.tokens.view(np.uint64)[order]

    @property
    def whole(self) -> float:
        return self.total + ADDED * (self.types + 1)

    @property
    def unknown(self) -> float:
        """The part of the last class that unknown tokens have."""
        return (self.once + 0.5) / (self.rest + self.once + 1) if self.rest else 1.0

    def rank(self, tokens: np.ndarray) -> np.ndarray:
        """Place in the head, or -1."""
        if not len(self.sorted):
            return np.full(len(tokens), -1)
        place = np.minimum(np.searchsorted(self.sorted, tokens), len(self.sorted) - 1)
        return np.where(self.sorted[place] == tokens, self.order[place], -1)


def _bin() -> Column:
    return F.floor(F.log2("c") * BINS)


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, DataFrame]:
    """The totals and the head of stored counts, and the counts of the other tokens."""
    bins = counts.filter(F.col("token") != END).groupBy(_bin().alias("bin")).agg(
        F.count(F.lit(1)).alias("types"), F.sum("c").alias("total"), F.count_if(F.col("c") == 1).alias("once")
    ).collect()
    least, taken = BINS, 0
    # Whole bins from the top, as long as there is room beside the end.
    for row in sorted(bins, key=lambda row: -row["bin"]):
        taken += row["types"]
        if taken > HEAD - 1:
            least = max(least, row["bin"] + 1)
            break
    ends = sum(row["c"] for row in counts.filter(F.col("token") == END).collect())
    inside = _bin() >= least
    head = counts.filter((F.col("token") != END) & inside).toArrow()
    tokens, found = head["token"].to_numpy().astype(np.int64), head["c"].to_numpy().astype(np.int64)
    order = np.lexsort((tokens, -found))
    known = Vocabulary(
        sum(row["total"] for row in bins) + ends,
        sum(row["types"] for row in bins) + (ends > 0),
        sum(row["once"] for row in bins),
        np.concatenate([[END], tokens[order]]).astype(np.int64),
        np.concatenate([[ends], found[order]]).astype(np.int64),
    )
    return known, counts.filter((F.col("token") != END) & ~inside)


def encode(df: DataFrame, known: Vocabulary) -> DataFrame:
    """Rows of `df` (`id`, `learned`, `text`) as symbols, numbered, with what the head gives; stored.

    `row`, `id`, `learned`, `n_tokens`, `n_known`, `base` (log10) and `share` (ln, within bands) of the tokens in the
    head, `symbols` (unsigned 16-bit), `rest`: the other tokens, each with how often it occurs.
    """
    held = df.sparkSession.sparkContext.broadcast(known)
    entry = pa.struct([("token", pa.int64()), ("times", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch, data, offsets in chunks(batches, "text", CHUNK):
            found = words(data, offsets, LOWER)
            rows = np.arange(batch.num_rows)
            tokens = np.insert(found.hash, found.first[1:], np.uint64(END & 0xFFFFFFFFFFFFFFFF))
            first = found.first[:-1] + rows
            size = np.diff(found.first) + 1
            rank = known.rank(tokens)
            inside = rank >= 0
            symbols = np.where(inside, known.symbol[rank], known.symbols - 1).astype("<u2")
            base = np.add.reduceat(np.where(inside, known.base[rank], 0.0), first)
            share = np.add.reduceat(np.where(inside, known.share[rank], 0.0), first)
            counted = np.add.reduceat((inside & (known.counts[rank] > 0)).astype(np.int64), first)
            rest = []
            for begin, end in zip(first.tolist(), (first + size).tolist()):
                values, times = np.unique(tokens[begin:end][~inside[begin:end]], return_counts=True)
                rest.append((values.view(np.int64), times))
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum([len(values) for values, _ in rest])]), pa.int32()),
                pa.StructArray.from_arrays(
                    [pa.array(np.concatenate([part[place] for part in rest]), pa.int64()) for place in (0, 1)], fields=list(entry)
                ),
            )
            raw = symbols.tobytes()
            texts = [raw[2 * begin : 2 * end] for begin, end in zip(first.tolist(), (first + size).tolist())]
            arrays = [batch.column("id"), batch.column("learned"), pa.array(size), pa.array(counted), pa.array(base), pa.array(share)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.binary()), lists], names)

    names = ["id", "learned", "n_tokens", "n_known", "base", "share", "symbols", "rest"]
    kind = df.schema["id"].dataType.simpleString()
    schema = (
        f"id {kind}, learned boolean, n_tokens long, n_known long, base double, share double, symbols binary,"
        " rest array<struct<token: long, times: long>>"
    )
    found = df.select("id", "learned", "text").mapInArrow(run, schema)
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "symbols")


# Network


def _sigmoid(values: np.ndarray) -> np.ndarray:
    half = values.dtype.type(0.5)
    out = np.tanh(values * half)
    out *= half
    out += half
    return out


def _log_softmax(logits: np.ndarray) -> np.ndarray:
    """Of each column."""
    logits -= logits.max(axis=0)
    logits -= np.log(np.exp(logits).sum(axis=0))
    return logits


class Network:
    """Parameters, forward and backward pass of one window.

    Lanes and tokens are the last axis, so that numbers of a gate lie together. `table` holds
    what each symbol adds to the gates: update, reset and candidate.
    """

    NAMES = ("table", "gates", "class_out", "class_bias", "word_out", "word_bias")

    def __init__(self, known: Vocabulary, units: int = UNITS, kind: type = np.float32) -> None:
        draw = np.random.default_rng(1)
        self.own, self.units, self.class_of = known.own, units, known.class_of
        # The end comes first, so there is a symbol of its own at least.
        mass = known.mass + 0.5
        by_class = np.bincount(known.class_of, mass, known.outputs)
        word_bias = np.full((known.classes, CLASS, 1), _PAD, kind)
        word_bias.reshape(-1)[: known.own] = np.log(mass[: known.own] / by_class[known.class_of[: known.own]])
        self.parts = {
            "table": draw.normal(0, 0.1, (3 * units, known.symbols)).astype(kind),
            "gates": draw.normal(0, 1 / math.sqrt(units), (3 * units, units)).astype(kind),
            "class_out": np.zeros((known.outputs, units), kind),
            "class_bias": np.log(by_class / by_class.sum()).astype(kind)[:, None],
            "word_out": np.zeros((known.classes, CLASS, units), kind),
            "word_bias": word_bias,
        }

    def copy(self) -> Network:
        other = copy.copy(self)
        other.parts = {name: part.copy() for name, part in self.parts.items()}
        return other

    @property
    def flat(self) -> np.ndarray:
        return np.concatenate([self.parts[name].ravel() for name in self.NAMES])

    @flat.setter
    def flat(self, values: np.ndarray) -> None:
        at = 0
        for name in self.NAMES:
            part = self.parts[name]
            self.parts[name] = values[at : at + part.size].reshape(part.shape).astype(part.dtype)
            at += part.size

    def states(self, inputs: np.ndarray, keep: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
        """States (units x steps x lanes) after each step of a window (steps x lanes), and what the way back needs."""
        n, gates = self.units, self.parts["gates"]
        out = np.empty((n, *inputs.shape), state.dtype)
        table, saved = np.take(self.parts["table"], inputs, axis=1), []
        for step in range(len(inputs)):
            before = state * keep[step]
            passed = gates @ before
            own = passed[2 * n :]
            opened = _sigmoid(table[: 2 * n, step] + passed[: 2 * n])
            update, reset = opened[:n], opened[n:]
            new = reset * own
            new += table[2 * n :, step]
            np.tanh(new, out=new)
            state = before - new
            state *= update
            state += new
            out[:, step] = state
            saved.append((before, update, reset, own, new))
        return out, saved

    def _classes(self, targets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """Class of each target, and for each class with own words the places of its targets."""
        found = self.class_of[targets]
        own = np.flatnonzero(targets < self.own)
        order = own[np.argsort(found[own].astype(np.uint16), kind="stable")]
        edges = np.flatnonzero(np.diff(found[order])) + 1
        return found, [(int(found[part[0]]), part) for part in np.split(order, edges) if len(part)]

    def log_probabilities(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """ln P(class) + ln P(symbol | class) of each target; a column of `states` for each."""
        found, groups = self._classes(targets)
        scores = _log_softmax(self.parts["class_out"] @ states + self.parts["class_bias"])
        out = scores[found, np.arange(len(targets))]
        for number, part in groups:
            inner = self.parts["word_out"][number] @ states[:, part]
            inner = _log_softmax(inner + self.parts["word_bias"][number])
            out[part] += inner[targets[part] % CLASS, np.arange(len(part))]
        return out

    def gradients(self, inputs, keep, state, targets, valid, scale: float) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of `scale` times the sum of -ln P over a window's valid targets, and the last state."""
        p, n = self.parts, self.units
        out, saved = self.states(inputs, keep, state)
        hidden, wanted, whole = out.reshape(n, -1), targets.ravel(), valid.all()
        if not whole:
            places = np.flatnonzero(valid.ravel())
            hidden, wanted = hidden[:, places], wanted[places]
        found, groups = self._classes(wanted)
        error = np.exp(_log_softmax(p["class_out"] @ hidden + p["class_bias"]))
        error[found, np.arange(len(wanted))] -= 1
        error *= scale
        grads = {name: np.zeros_like(p[name]) for name in ("gates", "word_out", "word_bias", "table")}
        grads["class_out"], grads["class_bias"] = error @ hidden.T, error.sum(axis=1, keepdims=True)
        back = p["class_out"].T @ error
        for number, part in groups:
            some = hidden[:, part]
            inner = np.exp(_log_softmax(p["word_out"][number] @ some + p["word_bias"][number]))
            inner[wanted[part] % CLASS, np.arange(len(part))] -= 1
            inner *= scale
            grads["word_out"][number] = inner @ some.T
            grads["word_bias"][number] = inner.sum(axis=1, keepdims=True)
            back[:, part] += p["word_out"][number].T @ inner
        if not whole:
            through = np.zeros((n, inputs.size), state.dtype)
            through[:, places] = back
            back = through
        back = back.reshape(n, *inputs.shape)
        errors = np.empty((3 * n, *inputs.shape), state.dtype)
        carried = np.zeros_like(state)
        for step in range(len(inputs) - 1, -1, -1):
            before, update, reset, own, new = saved[step]
            carried += back[:, step]
            passed = np.empty((3 * n, inputs.shape[1]), state.dtype)
            shut = 1 - update
            kept = carried * update
            inner = carried * shut
            np.multiply(kept * shut, before - new, out=passed[:n])
            inner *= 1 - new * new
            np.multiply(inner, reset, out=passed[2 * n :])
            np.multiply(passed[2 * n :] * own, 1 - reset, out=passed[n : 2 * n])
            grads["gates"] += passed @ before.T
            carried = p["gates"].T @ passed
            carried += kept
            carried *= keep[step]
            errors[: 2 * n, step] = passed[: 2 * n]
            # The table adds to the candidate outside the reset gate.
            errors[2 * n :, step] = inner
        rows = inputs.ravel()
        order = np.argsort(rows.astype(np.uint16), kind="stable")
        rows = rows[order]
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        summed = np.add.reduceat(np.take(errors.reshape(3 * n, -1), order, axis=1), first, axis=1)
        grads["table"][:, rows[first]] = summed
        return grads, np.ascontiguousarray(out[:, -1])


class Adam:
    def __init__(self, network: Network, rate: float) -> None:
        self.network, self.rate, self.steps = network, rate, 0
        self.first = {name: np.zeros_like(part) for name, part in network.parts.items()}
        self.second = {name: np.zeros_like(part) for name, part in network.parts.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.steps += 1
        rate = self.rate * math.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        for name, grad in grads.items():
            first, second = self.first[name], self.second[name]
            first += 0.1 * (grad - first)
            second += 0.01 * (grad * grad - second)
            self.network.parts[name] -= (rate * first / (np.sqrt(second) + 1e-8)).astype(first.dtype)


@dataclass
class Lanes:
    """Texts laid end to end in lanes, the longest lane first; `text` of each token, `begins` at a text's first."""

    symbols: np.ndarray
    text: np.ndarray
    begins: np.ndarray
    first: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, texts: list[np.ndarray], lanes: int) -> Lanes:
        """Each text, the longest first, goes to the lane that is shortest so far."""
        sizes = np.array([len(text) for text in texts])
        loads = [(0, lane) for lane in range(min(lanes, len(texts)))]
        held: list[list[int]] = [[] for _ in loads]
        for number in np.argsort(-sizes, kind="stable").tolist():
            load, lane = loads[0]
            heapq.heapreplace(loads, (load + int(sizes[number]), lane))
            held[lane].append(number)
        totals = np.array([sizes[numbers].sum() for numbers in held])
        ranked = np.argsort(-totals, kind="stable")
        order = np.array([number for lane in ranked.tolist() for number in held[lane]])
        begins = np.zeros(int(sizes.sum()), bool)
        begins[np.cumsum(sizes[order]) - sizes[order]] = True
        totals = totals[ranked]
        return cls(np.concatenate([texts[number] for number in order]), np.repeat(order, sizes[order]), begins, np.cumsum(totals) - totals, totals)

    def windows(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of the lanes that go on: inputs, kept states, targets and validity (steps x lanes), and places of the targets."""
        begin, end = 0, int(self.sizes[0])
        while begin < end:
            active = int(np.searchsorted(-self.sizes, -begin, "left"))
            steps = np.arange(begin, min(end, begin + min(LONGEST, WINDOW * max(1, LANES // active))))
            begin += len(steps)
            valid = steps[:, None] < self.sizes[:active]
            places = np.where(valid, self.first[:active] + steps[:, None], self.first[:active] + self.sizes[:active] - 1)
            starts = self.begins[places]
            # A text begins after an end, symbol 0.
            inputs = np.where(starts, 0, self.symbols[np.maximum(places - 1, 0)]).astype(np.int64)
            yield inputs, (~starts).astype(np.float32), self.symbols[places].astype(np.int64), valid, places


def _buffered(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[list[pa.RecordBatch], list[np.ndarray]]]:
    """Batches together up to `BUFFER` tokens, with their rows' symbols."""
    held, texts, size = [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        texts += [np.frombuffer(raw, "<u2") for raw in batch.column(column).to_pylist()]
        size += sum(len(text) for text in texts[-batch.num_rows :])
        if size >= BUFFER:
            yield held, texts
            held, texts, size = [], [], 0
    if held:
        yield held, texts


def learn_texts(network: Network, texts: list[np.ndarray], adam: Adam) -> int:
    """Learns from each window of the texts; the number of their tokens."""
    lanes = Lanes.of(texts, LANES)
    state = np.zeros((network.units, len(lanes.sizes)), network.parts["gates"].dtype)
    for inputs, keep, targets, valid, _ in lanes.windows():
        grads, state = network.gradients(inputs, keep, state[:, : inputs.shape[1]], targets, valid, 1 / (LANES * WINDOW))
        adam.step(grads)
    return len(lanes.symbols)


def score_texts(network: Network, texts: list[np.ndarray]) -> np.ndarray:
    """ln P of the symbols of each text, summed up."""
    lanes = Lanes.of(texts, LANES)
    found = np.zeros(len(lanes.symbols))
    state = np.zeros((network.units, len(lanes.sizes)), network.parts["gates"].dtype)
    for inputs, keep, targets, valid, places in lanes.windows():
        out, _ = network.states(inputs, keep, state[:, : inputs.shape[1]])
        state, valid = out[:, -1], valid.ravel()
        found[places.ravel()[valid]] = network.log_probabilities(out.reshape(network.units, -1)[:, valid], targets.ravel()[valid])
    return np.bincount(lanes.text, found, len(texts))


# Learning and scoring on Spark


#: Pieces of the parameters that are added up apart, and groups of tasks in the first step.
_PIECES, _GROUPS = 8, 16


def _added(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    piece, group, tokens, total = 0, 0, 0, 0.0
    for batch in rows:
        for piece, group, number, raw in zip(*[column.to_pylist() for column in batch.columns]):
            tokens, total = tokens + number, total + np.frombuffer(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array([piece], pa.int32()), pa.array([group], pa.int32()), pa.array([tokens]), pa.array([total.tobytes()], pa.binary())],
        ["piece", "task", "tokens", "sums"],
    )


def learn(encoded: DataFrame, known: Vocabulary) -> Network:
    """Learns from the `learned` rows of `encode`, all of them in one round or another."""
    network, context = Network(known), encoded.sparkSession.sparkContext
    schema = "piece int, task int, tokens long, sums binary"
    part = F.pmod(F.xxhash64("row"), F.lit(PARTS))
    begin = 0
    for end, rate in ROUNDS:
        held = context.broadcast(network)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            local = held.value.copy()
            adam, tokens = Adam(local, rate), 0
            for _, texts in _buffered(batches, "symbols"):
                tokens += learn_texts(local, texts, adam)
            if tokens:
                # Weighted sums of 64 bits; their order doesn't show in the averages' 32 bits.
                sums = np.array_split(local.flat.astype(np.float64) * tokens, _PIECES)
                task = [TaskContext.get().partitionId() % _GROUPS] * _PIECES
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(_PIECES), pa.int32()), pa.array(task, pa.int32()), pa.array([tokens] * _PIECES), pa.array([s.tobytes() for s in sums], pa.binary())],
                    ["piece", "task", "tokens", "sums"],
                )

        chosen = encoded.filter(F.col("learned") & (part >= begin) & (part < end)).select("symbols")
        sums = chosen.mapInArrow(run, schema).groupBy("piece", "task").applyInArrow(_added, schema)
        rows = sorted(sums.groupBy("piece").applyInArrow(_added, schema).collect())
        if rows:
            network = network.copy()
            network.flat = np.concatenate([np.frombuffer(row["sums"]) for row in rows]) / rows[0]["tokens"]
        begin = end
    return network


def score(encoded: DataFrame, known: Vocabulary, network: Network, others: DataFrame) -> DataFrame:
    """`id`, `learned`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score` of the rows of `encode`."""
    held = encoded.sparkSession.sparkContext.broadcast(network)
    kept = ["row", "id", "learned", "n_tokens", "n_known", "base", "share"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _buffered(batches, "symbols"):
            found = score_texts(held.value, texts)
            begin = 0
            for batch in rows:
                part = pa.array(found[begin : begin + batch.num_rows])
                yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in kept], part], [*kept, "ln"])
                begin += batch.num_rows

    kind = encoded.schema["id"].dataType.simpleString()
    schema = f"row long, id {kind}, learned boolean, n_tokens long, n_known long, base double, share double, ln double"
    rows = encoded.select(*kept, "symbols").mapInArrow(run, schema)
    c = F.coalesce("c", F.lit(0))
    ln_known = F.log(F.col("c") * F.lit((1 - known.unknown) / max(known.rest, 1)))
    rest = encoded.select("row", F.explode("rest").alias("of")).select("row", "of.token", "of.times").join(others, "token", "left")
    rest = rest.groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((c + ADDED) / known.whole)).alias("more_base"),
        F.sum(F.col("times") * F.when(c > 0, ln_known).otherwise(F.lit(math.log(known.unknown)))).alias("more_share"),
    )
    rows = rows.join(rest, "row", "left").fillna(0, ["more_known", "more_base", "more_share"])
    return rows.select(
        "id",
        "learned",
        "n_tokens",
        (F.col("n_known") + F.col("more_known")).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("more_base")).alias("base_score"),
        ((F.col("ln") + F.col("share") + F.col("more_share")) / math.log(10)).alias("score"),
    )


def log_likelihoods(df: DataFrame, learned: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `df`: id, `learned`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`.

    The model is learned from the rows where `learned` holds (null doesn't); all rows are scored whole.
    Tokens are words, A-Z lower-cased, and one end. `base_score` is log10 of the product of the
    tokens' smoothed frequencies, `score` log10 of the model's probability of the text. A null or
    empty text is its end alone. Rows are independent; repeated ones and null ids are rows of
    their own. Without a row to learn from all tokens are unknown, and the base scores are 0.
    Other columns are not read.
    """
    texts = df.select(F.col(id).alias("id"), F.coalesce(learned, F.lit(False)).alias("learned"), F.col(text).alias("text"))
    known, others = vocabulary(stored(token_counts(texts.filter("learned")), "counts"))
    encoded = encode(texts, known)
    return score(encoded, known, learn(encoded, known), others).withColumnRenamed("id", id)
