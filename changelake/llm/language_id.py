"""Language identification by interpolated Kneser-Ney character models.

Each language has one model over letters, runs of other characters being one break. The
models' n-grams are hashed and kept in sorted arrays, one per order, with a column of
log probabilities for each language, so that one binary search serves all of them. A text
gets the language of lowest cross-entropy per character.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.columns import stored

#: Longest n-gram.
ORDER = 5
#: Characters of training text for a language, about, and for all together: a bound on the
#: model's size, as an n-gram takes 8 bytes and 4 for each language.
SAMPLE = 3_000_000
WHOLE_SAMPLE = 30_000_000
#: Letters below which a text is never rejected: its cross-entropy varies too much.
FEWEST = 24
#: Languages that can be learned; a column with more values is refused.
MOST_LANGUAGES = 4096
#: Characters scored at a time.
CHUNK = 1 << 18
UNKNOWN = "und"

_MULTIPLIERS = np.array([pow(0x9E3779B97F4A7C15, 2 * place + 1, 1 << 64) for place in range(ORDER)], np.uint64)


@cache
def _letters() -> np.ndarray:
    """Each code point, or 0 if it is no letter."""
    return np.array([point if chr(point).isalpha() else 0 for point in range(sys.maxunicode + 1)], np.uint32)


def sequences(texts: list[str | None], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all texts behind one another, the places to score, and the text of each of these.

    Before each text stand `order` breaks, so that no n-gram reaches into another one; a
    text ends with a break.
    """
    pad = "\x00" * order
    joined = pad + pad.join(f"{(text or '').lower()}\x00" for text in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    codes = _letters()[points]
    sizes = np.array([len((text or "").lower()) + 1 for text in texts], np.int64)
    starts = np.cumsum(sizes + order) - sizes
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    padding = (starts[:, None] - order + np.arange(order)).ravel()
    keep[padding] = True
    keep[starts] = codes[starts] != 0
    scored = keep.copy()
    scored[padding] = False
    text = np.repeat(np.arange(len(texts)), sizes + order)[keep]
    codes, scored = codes[keep], np.flatnonzero(scored[keep])
    return codes, scored, text[scored]


def hashes(codes: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` codes that end at each place."""
    total = np.full(len(places), size, np.uint64)
    for back in range(size):
        total += (codes[places - back].astype(np.uint64) + np.uint64(1)) * _MULTIPLIERS[back]
    return total


def _row_hashes(codes: np.ndarray) -> np.ndarray:
    """The same of rows of codes."""
    size = codes.shape[1]
    total = np.full(len(codes), size, np.uint64)
    for back in range(size):
        total += (codes[:, size - 1 - back].astype(np.uint64) + np.uint64(1)) * _MULTIPLIERS[back]
    return total


def _find(sorted_: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value, or -1."""
    if not len(sorted_):
        return np.full(len(wanted), -1)
    place = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
    return np.where(sorted_[place] == wanted, place, -1)


@dataclass
class Model:
    languages: list[str]
    #: By order less one: sorted hashes, and log probabilities by language.
    grams: list[tuple[np.ndarray, np.ndarray]]
    #: By order less one: sorted hashes of contexts, and log weights of the shorter order by language.
    contexts: list[tuple[np.ndarray, np.ndarray]]
    #: Log probability of a letter that no language has.
    unseen: np.ndarray
    #: Cross-entropy above which a text is rejected, by language.
    limits: np.ndarray

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character by text and language, and the letters of each text."""
        codes, places, text = sequences(texts)
        letters = np.bincount(text[codes[places] != 0], minlength=len(texts))
        total = np.zeros((len(texts), len(self.languages)))
        for start in range(0, len(places), CHUNK):
            part = slice(start, start + CHUNK)
            logs = self._logs(codes, places[part])
            for column in range(len(self.languages)):
                total[:, column] += np.bincount(text[part], logs[:, column], minlength=len(texts))
        return -total / np.maximum(np.bincount(text, minlength=len(texts)), 1)[:, None], letters

    def _logs(self, codes: np.ndarray, places: np.ndarray) -> np.ndarray:
        out = np.zeros((len(places), len(self.languages)), np.float32)
        left = np.arange(len(places))
        for order in range(len(self.grams), 0, -1):
            sorted_, logs = self.grams[order - 1]
            at = places[left]
            place = _find(sorted_, hashes(codes, at, order))
            found = place >= 0
            out[left[found]] += logs[place[found]]
            left, at = left[~found], at[~found]
            if not len(left):
                return out
            if order > 1:
                sorted_, weights = self.contexts[order - 1]
                place = _find(sorted_, hashes(codes, at - 1, order - 1))
                found = place >= 0
                out[left[found]] += weights[place[found]]
        out[left] += self.unseen
        return out


def _unique(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in the order of their hashes, the hashes, and the summed counts."""
    found, first, which = np.unique(_row_hashes(codes), return_index=True, return_inverse=True)
    return codes[first], found, np.bincount(which, counts, len(found))


def kneser_ney(counted: dict[str, tuple[np.ndarray, np.ndarray]], order: int = ORDER) -> Model:
    """Model from each language's distinct n-grams of the highest order (rows of codes) and their counts."""
    languages = sorted(counted)
    own: dict[tuple[int, str], tuple] = {}
    for language in languages:
        codes, counts = counted[language]
        for size in range(order, 0, -1):
            own[size, language] = _unique(codes, counts)
            # The count of a shorter n-gram is that of the different letters before it.
            codes = own[size, language][0][:, 1:]
            counts = np.ones(len(codes))
    letters = _unique(np.concatenate([own[1, each][0] for each in languages]), np.ones(sum(len(own[1, each][0]) for each in languages)))[0]
    uniform = 1 / (len(letters) + 1)
    grams, contexts = [], []
    lower_hash, lower = np.zeros(0, np.uint64), np.zeros((0, len(languages)))
    unseen = np.zeros(len(languages))
    for size in range(1, order + 1):
        joint, joint_hash, _ = _unique(
            np.concatenate([own[size, each][0] for each in languages]), np.zeros(sum(len(own[size, each][0]) for each in languages))
        )
        _, context_hash, _ = _unique(joint[:, :-1], np.zeros(len(joint)))
        context_of = _find(context_hash, _row_hashes(joint[:, :-1]))
        below = _find(lower_hash, _row_hashes(joint[:, 1:])) if size > 1 else None
        logs, weights = np.zeros((len(joint), len(languages))), np.ones((len(context_hash), len(languages)))
        for column, language in enumerate(languages):
            codes, _, counts = own[size, language]
            once, twice = (counts == 1).sum(), (counts == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            at = _find(joint_hash, own[size, language][1])
            here = context_of[at]
            totals = np.bincount(here, counts, len(context_hash))
            kinds = np.bincount(here, minlength=len(context_hash))
            seen = totals > 0
            weights[seen, column] = discount * kinds[seen] / totals[seen]
            probability = weights[context_of, column] * (uniform if below is None else lower[below, column])
            probability[at] += np.maximum(counts - discount, 0) / totals[here]
            logs[:, column] = probability
        if size == 1:
            unseen = np.log(weights[0] * uniform)
        lower_hash, lower = joint_hash, logs
        grams.append((joint_hash, np.log(logs).astype(np.float32)))
        contexts.append((context_hash, np.log(weights).astype(np.float32)))
    model = Model(languages, grams, contexts, unseen.astype(np.float32), np.zeros(len(languages)))
    # Letters thrown at random in words of five set the limit until it is calibrated.
    known = [chr(code) for code in letters[:, 0].tolist() if code] or ["?"]
    thrown = np.random.default_rng(5).integers(0, len(known), (2000, 5))
    model.limits = model.entropies([" ".join("".join(known[place] for place in word) for word in thrown.tolist())])[0][0]
    return model


def learn(labelled: DataFrame, id: str, text: str, language: str, sample: int = SAMPLE) -> Model:
    """Models of all languages of `labelled`; rows without id, text or language are left out.

    Texts are drawn by a hash of their id so that about `sample` characters stand for each
    language; a tenth of them, again by hash, sets the limits of rejection. N-grams are
    counted on Spark, each batch's first, and only the distinct ones of that sample are gathered.
    """
    rows = labelled.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(language).alias("language")).dropna()
    share = rows.groupBy("language").agg(F.greatest(F.sum(F.length("text")), F.lit(1)).alias("characters"))
    share = stored(share, "languages")
    number = share.count()
    if number > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    share = share.withColumn("share", min(sample, WHOLE_SAMPLE / max(1, number)) / F.col("characters"))
    place = (F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))).alias("place")
    drawn = rows.withColumn("place", place).join(F.broadcast(share), "language").filter(F.col("place") < F.col("share"))
    calibrating = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("calibrate")), F.lit(10)) == 0
    counted = (
        drawn.filter(~calibrating)
        .select("language", "text")
        .mapInArrow(_count, "language string, gram binary, n long")
        .groupBy("language", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    by_language: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    names = np.array(counted.column("language").to_pylist(), object)
    grams, numbers = counted.column("gram").to_pylist(), counted.column("n").to_numpy()
    codes = np.frombuffer(b"".join(grams), np.uint32).reshape(-1, ORDER)
    for name in sorted(set(names)):
        here = names == name
        by_language[name] = codes[here], numbers[here].astype(float)
    if not by_language:
        return Model([], [], [], np.zeros(0, np.float32), np.zeros(0))
    model = kneser_ney(by_language)
    entropies = identify(drawn.filter(calibrating), model, id="id")
    limits = entropies.filter(F.col("letters") >= FEWEST).groupBy(F.col("lang_pred").alias("language")).agg(
        F.percentile("entropy", 0.999).alias("high")
    )
    for name, high in limits.collect():
        # Half-way between the texts of the language and letters thrown at random.
        column = model.languages.index(name)
        model.limits[column] = (high + model.limits[column]) / 2
    return model


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = np.array(batch.column(0).to_pylist(), object)
        texts = batch.column(1).to_pylist()
        for name in sorted(set(names)):
            codes, places, _ = sequences([texts[row] for row in np.flatnonzero(names == name)])
            value, first, counts = np.unique(hashes(codes, places, ORDER), return_index=True, return_counts=True)
            windows = codes[places[first][:, None] + np.arange(1 - ORDER, 1)]
            grams = [row.tobytes() for row in windows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(grams), pa.string()), pa.array(grams, pa.binary()), pa.array(counts, pa.int64())],
                ["language", "gram", "n"],
            )


def identify(df: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `df`: id, `lang_pred`, `score`, `entropy`, `letters`, `rejected`.

    A text that is null or has no letter is `und` with score 0, and rejected. Equal
    cross-entropies go to the first language by name. A text of `FEWEST` letters or more is
    rejected if even its language's cross-entropy is beyond that language's limit. If no
    language was learned, all are `und`, and only those without letters rejected. Ids may
    be null or repeated; other columns are not read.
    """
    held = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            for start, end in _cuts(batch.column(1)):
                yield _scored(known, batch.slice(start, end - start))

    kind = df.schema[id].dataType.simpleString()
    schema = f"id {kind}, lang_pred string, score double, entropy double, letters long, rejected boolean"
    return df.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id)


def accepted(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of `df`, all columns, whose texts `identify` does not reject. No shuffle."""
    held = df.sparkSession.sparkContext.broadcast(model)
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in _cuts(batch.column(place)):
                part = batch.slice(start, end - start)
                texts = pa.RecordBatch.from_arrays([part.column(place)] * 2, ["id", "text"])
                yield part.filter(pc.invert(_scored(held.value, texts).column("rejected")))
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, df.schema)


def _cuts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of rows of about `CHUNK` characters at most, or one longer row."""
    sizes = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        done = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, done + CHUNK, "right")))
        yield start, end
        start = end


def _scored(model: Model, batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = batch.column(1).to_pylist()
    if not model.languages:
        letters = np.array([sum(map(str.isalpha, text or "")) for text in texts])
        best, score, entropy = np.zeros(len(texts), int), np.zeros(len(texts)), np.zeros(len(texts))
        known, names = np.zeros(len(texts), bool), [UNKNOWN]
    else:
        entropies, letters = model.entropies(texts)
        best = entropies.argmin(axis=1)
        entropy = entropies[np.arange(len(texts)), best]
        evidence = np.minimum(letters, 50)[:, None]
        score = 1 / np.exp((entropy[:, None] - entropies) * evidence).sum(axis=1)
        known, names = letters > 0, model.languages
    languages = [names[column] if here else UNKNOWN for column, here in zip(best, known)]
    limits = model.limits[best] if model.languages else entropy
    rejected = (letters == 0) | ((letters >= FEWEST) & (entropy > limits))
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            pa.array(languages, pa.string()),
            pa.array(np.where(known, score, 0.0)),
            pa.array(entropy),
            pa.array(letters.astype(np.int64)),
            pa.array(rejected),
        ],
        ["id", "lang_pred", "score", "entropy", "letters", "rejected"],
    )
