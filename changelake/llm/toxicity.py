"""Toxicity scores by a factorization machine over hashed terms.

Terms are lower-cased words, hashed to a fixed number of buckets. The buckets that tell
the labels apart best are the machine's inputs: each has a weight, and a vector whose
product with another one's is the weight of the two occurring together. A pair that is
toxic only together, such as an insult and the mention of a group, is learned from its
vectors, which weights alone can't express.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm.columns import chunks, stored, text_or_empty
from changelake.llm.words import CHUNK, NO_LETTER, words

#: Buckets of terms, as a power of two.
BITS = 18
#: Labelled rows that the machine is fitted on at most, drawn by a hash of their id.
SAMPLE = 20_000
#: Buckets that become inputs, and the length of their vectors.
INPUTS = 1024
FACTORS = 8
#: Occurrences in the sample below which a bucket isn't considered.
FEWEST = 5
#: Chi-squared statistic below which a bucket isn't considered: odds of 0.001 by chance.
LEAST_CHI = 10.83
#: The fit: steps, rows of a step, rate, and decay of weights and vectors.
STEPS = 2000
STEP = 256
RATE = 0.02
DECAY = 1e-4


@dataclass
class Machine:
    #: Input of each bucket, or -1.
    inputs: np.ndarray
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def scores(self, row: np.ndarray, input_: np.ndarray, rows: int) -> np.ndarray:
        """Probability for each row, whose distinct inputs are given beside it in `row` order."""
        return _sigmoid(_logits(self.bias, self.weights, self.vectors, row, input_, rows)[0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _logits(bias: float, weights: np.ndarray, vectors: np.ndarray, row: np.ndarray, input_: np.ndarray, rows: int):
    """Bias + weights + products of all pairs, the pairs by half of (square of the sum - sum of squares)."""
    sums = np.stack([np.bincount(row, vectors[input_, factor], minlength=rows) for factor in range(vectors.shape[1])], axis=1)
    squares = np.bincount(row, (vectors**2).sum(axis=1)[input_], minlength=rows)
    linear = np.bincount(row, weights[input_], minlength=rows)
    return bias + linear + ((sums**2).sum(axis=1) - squares) / 2, sums


def fit(inputs: np.ndarray, row: np.ndarray, input_: np.ndarray, labels: np.ndarray, number: int) -> Machine:
    """Machine of least log loss by Adam steps in an order fixed by a seed."""
    draw = np.random.default_rng(17)
    positive = labels.mean() if len(labels) else 0.5
    clipped = np.clip(positive, 1e-3, 1 - 1e-3)
    state = [np.array([np.log(clipped / (1 - clipped))]), np.zeros(number), draw.normal(0, 0.01, (number, FACTORS))]
    machine = lambda: Machine(inputs, float(state[0][0]), state[1], state[2])
    if not len(labels) or not 0 < positive < 1:
        return machine()
    first = np.searchsorted(row, np.arange(len(labels) + 1))
    means, squares = [np.zeros_like(p) for p in state], [np.zeros_like(p) for p in state]
    step = 0
    while step < STEPS:
        order = draw.permutation(len(labels))
        for start in range(0, len(order), STEP):
            chosen = order[start : start + STEP]
            sizes = first[chosen + 1] - first[chosen]
            of = np.repeat(np.arange(len(chosen)), sizes)
            at = np.repeat(first[chosen] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(of))
            here = input_[at]
            logits, sums = _logits(state[0][0], state[1], state[2], of, here, len(chosen))
            error = (_sigmoid(logits) - labels[chosen]) / len(chosen)
            along = error[of]
            slopes = [
                np.array([error.sum()]),
                np.bincount(here, along, minlength=number) + DECAY * state[1],
                np.stack(
                    [np.bincount(here, along * (sums[of, f] - state[2][here, f]), minlength=number) for f in range(FACTORS)], axis=1
                )
                + DECAY * state[2],
            ]
            step += 1
            for part, slope in enumerate(slopes):
                means[part] = 0.9 * means[part] + 0.1 * slope
                squares[part] = 0.99 * squares[part] + 0.01 * slope**2
                state[part] = state[part] - RATE * (means[part] / (1 - 0.9**step)) / (np.sqrt(squares[part] / (1 - 0.99**step)) + 1e-8)
    return machine()


def plain(text: str) -> Column:
    """Lower case, with punctuation beyond ASCII as white space."""
    return F.regexp_replace(F.lower(text_or_empty(text)), r"[\u00A0-\u00BF\u2000-\u206F\u3000-\u303F]", " ")


def _buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every term."""
    found = words(data, offsets, separators=NO_LETTER)
    return found.row, (found.hash >> np.uint64(64 - BITS)).astype(np.int64)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in chunks(batches, "text", CHUNK):
        row, bucket = _buckets(data, offsets)
        pairs = np.unique(row << BITS | bucket)
        starts = np.searchsorted(pairs >> BITS, np.arange(batch.num_rows + 1))
        lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array((pairs & ((1 << BITS) - 1)).astype(np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["label", "buckets"])


def learn(df: DataFrame, labels: DataFrame, id: str, text: str, label: str, sample: int = SAMPLE) -> Machine:
    """Machine fitted on at most `sample` labelled rows of `df`, `labels` holding id and label 0 or 1.

    Labels that are null, or whose id is null or not in `df`, are left out; of several for
    an id the highest counts. Without labels of both kinds, all texts get one score.
    """
    drawn = labels.select(F.col(id).alias("id"), F.col(label).cast("double").alias("label")).dropna()
    drawn = drawn.groupBy("id").agg(F.max("label").alias("label"))
    drawn = drawn.orderBy(F.xxhash64(F.col("id").cast("string"), F.lit("sample")), "id").limit(sample)
    texts = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    # `sample` rows of 16 bytes at most.
    rows = texts.join(F.broadcast(drawn), "id").select("label", plain("text").alias("text"))
    rows = stored(rows.mapInArrow(_terms, "label double, buckets array<int>"), "terms")
    toxic, number = rows.agg(F.sum("label"), F.count("label")).first()
    toxic, number = toxic or 0.0, max(number, 1)
    # A bucket's worth is its chi-squared statistic against the label.
    counted = rows.select("label", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(
        F.sum("label").alias("a"), F.count("label").alias("n")
    )
    n, a = F.col("n"), F.col("a")
    chi = number * F.pow(a * number - n * toxic, 2) / (n * (number - n + 1e-9) * (toxic + 1e-9) * (number - toxic + 1e-9))
    best = counted.filter((n >= FEWEST) & (chi >= LEAST_CHI)).orderBy(F.desc(chi), "bucket").limit(INPUTS).select("bucket").collect()
    inputs = np.full(1 << BITS, -1, np.int32)
    inputs[[row.bucket for row in best]] = np.arange(len(best))
    known = F.array(*[F.lit(row.bucket) for row in best]) if best else F.array().cast("array<int>")
    gathered = rows.select("label", F.array_intersect("buckets", known).alias("buckets")).toArrow()
    lists = gathered.column("buckets").combine_chunks()
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    input_ = inputs[lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)]
    return fit(inputs, row, input_, gathered.column("label").to_numpy(), len(best))


def score(df: DataFrame, machine: Machine, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `df`: id and `score`, the probability of label 1.

    Whole texts count, each distinct term once. A null or empty text, or one without a
    known term, gets the score that the bias alone gives. Ids may be null or repeated;
    other columns are not read.
    """
    held = df.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        number = max(1, len(known.weights))
        for batch, data, offsets in chunks(batches, "text", CHUNK):
            row, bucket = _buckets(data, offsets)
            input_ = known.inputs[bucket]
            pairs = np.unique(row[input_ >= 0] * number + input_[input_ >= 0])
            scores = known.scores(pairs // number, pairs % number, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["id", "score"])

    kind = df.schema[id].dataType.simpleString()
    rows = df.select(F.col(id).alias("id"), plain(text).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id)
