"""Removal of word passages that an earlier document has, by prefix-partitioned suffix trees.

A suffix starts at each word that has a window of `size` words; a node at that depth with
leaves in several documents is a repeated passage.

1. Of the short prefixes inside each window, the one with the least hash stands for it,
   so equal windows are found under equal prefixes, and a prefix stands for a run of
   neighbouring windows. Prefixes are counted by document; a filter of bounded size holds
   those that several documents have.
2. Rows of these prefixes are read again with the words around them. Prefixes split the
   suffixes into groups; the group of a common prefix is dealt out to several tasks.
3. A task sorts the suffixes of its groups, which gives each group's subtree: neighbours
   that agree in `size` words hang below one deep node. Windows of a node are removed from
   all documents but its first.
4. For a common prefix, what is left of each task's part, one document for each window, is
   grouped again by a longer prefix: the whole window.

Words are compared by 64-bit hashes, whole windows of common prefixes by 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.bloom import bloom, maybe
from changelake.llm.columns import bytes_of, chunks, stored, text_hash
from changelake.llm.words import CHUNK, Words, mix, ngrams, words

#: Words of a window and of a prefix inside it.
SIZE = 13
PREFIX = 6
#: Rows of a prefix above which its group is dealt out, and to how many tasks.
COMMON = 1000
PARTS = 64
#: Rows of prefixes whose subtrees are built together.
GROUP = 40_000


def _prefixes(found: Words, size: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first and last window, and row, of each run of windows that one prefix stands for.

    Of equal hashes the one read first stands for a window.
    """
    number = len(found.hash) - size + 1
    none = np.zeros(0, np.int64)
    if number <= 0:
        return none.astype(np.uint64), none, none, none
    start = np.arange(number)
    start = start[found.row[:number] == found.row[size - 1 :]]
    if not len(start):
        return none.astype(np.uint64), none, none, none
    hashes = ngrams(found.hash, prefix)
    views = np.lib.stride_tricks.sliding_window_view(hashes, size - prefix + 1)
    place = start + views[start].argmin(axis=1)
    first = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)))
    last = np.append(first[1:], len(start)) - 1
    return hashes[place[first]], start[first], start[last], found.row[start[first]]


def _counted(texts: DataFrame, size: int, prefix: int) -> DataFrame:
    """`prefix` and its number of rows, of prefixes that several documents have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches, "text", CHUNK):
            hashes, _, _, row = _prefixes(words(data, offsets), size, prefix)
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32()), pa.array(hashes.view(np.int64))
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["id", "prefixes"])

    rows = texts.select("id", "text").mapInArrow(run, "id long, prefixes array<long>").select("id", F.explode("prefixes").alias("prefix"))
    counted = rows.groupBy("prefix").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("id").alias("n"))
    return stored(counted.filter("low < high").select("prefix", "n"), "prefixes")


_ROW = "prefix long, common boolean, id long, text_hash long, first int, windows int, anchor int, context string"


def _candidates(texts: DataFrame, counted: DataFrame, size: int, prefix: int, common: int) -> DataFrame:
    """A row for each run of windows whose prefix several documents may have, with the words it spans."""
    context = texts.sparkSession.sparkContext
    several = context.broadcast(bloom(counted.select("prefix")))
    frequent = context.broadcast(bloom(counted.filter(F.col("n") > common).select("prefix")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches, "text", CHUNK):
            found = words(data, offsets)
            hashes, first, last, row = _prefixes(found, size, prefix)
            kept = maybe(several.value, hashes)
            hashes, first, last, row = hashes[kept], first[kept], last[kept], row[kept]
            raw = data.tobytes()
            spans = zip(found.start[first].tolist(), found.end[last + size - 1].tolist())
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes.view(np.int64)),
                    pa.array(maybe(frequent.value, hashes)),
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array((first - found.first[row]).astype(np.int32)),
                    pa.array((last - first + 1).astype(np.int32)),
                    pa.array(_places(found, hashes, first, prefix).astype(np.int32)),
                    pa.array([raw[begin:end] for begin, end in spans], pa.binary()).cast(pa.string()),
                ],
                [part.split()[0] for part in _ROW.split(", ")],
            )

    return texts.select("id", "text_hash", "text").mapInArrow(run, _ROW)


def _places(found: Words, hashes: np.ndarray, first: np.ndarray, prefix: int) -> np.ndarray:
    """How many words after the first window's start its prefix begins."""
    grams = ngrams(found.hash, prefix)
    place, left = np.zeros(len(first), np.int64), np.arange(len(first))
    while len(left):
        left = left[grams[first[left] + place[left]] != hashes[left]]
        place[left] += 1
    return place


def subtree_repeats(suffixes: np.ndarray, groups: list[np.ndarray], documents: np.ndarray) -> np.ndarray:
    """For each suffix the least document below its deep node.

    `suffixes` has a row of words for each suffix; only those equal in all `groups` can
    share a node. Sorted suffixes are the leaves of the tree from left to right.
    """
    order = np.lexsort((*suffixes.T[::-1], *groups))
    differs = np.zeros(len(order), bool)
    differs[:1] = True
    for values in (*suffixes.T, *groups):
        sorted_ = values[order]
        differs[1:] |= sorted_[1:] != sorted_[:-1]
    node = np.flatnonzero(differs)
    least = np.minimum.reduceat(documents[order], node) if len(node) else documents
    out = np.empty_like(documents)
    out[order] = least[np.cumsum(differs) - 1]
    return out


_FOUND = "id long, text_hash long, window int, windows int, one long, two long"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows come in the order of their prefixes; a piece ends where a prefix does, or anywhere in a common one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(part.num_rows for part in held) < GROUP:
            continue
        together = pa.Table.from_batches(held)
        prefixes = together.column("prefix").to_numpy()
        if together.column("common")[-1].as_py():
            end = len(prefixes)
        else:
            ends = np.flatnonzero(prefixes != prefixes[-1])
            end = int(ends[-1]) + 1 if len(ends) else 0
        if end:
            yield together.slice(0, end)
        held = together.slice(end).to_batches()
    if sum(part.num_rows for part in held):
        yield pa.Table.from_batches(held)


def _searched(size: int):
    """Runs of removed windows, and the windows of common prefixes that are left, with their hashes."""
    names = [part.split()[0] for part in _FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            piece = piece.combine_chunks()
            data, offsets = bytes_of(piece.column("context").chunk(0))
            found = words(data, offsets)
            number, anchor, first = (piece.column(name).to_numpy() for name in ("windows", "anchor", "first"))
            ids, hashes = (piece.column(name).to_numpy() for name in ("id", "text_hash"))
            row = np.repeat(np.arange(piece.num_rows), number)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            start = found.first[row] + nth
            suffixes = found.hash[start[:, None] + np.arange(size)]
            groups = [anchor[row] - nth, piece.column("prefix").to_numpy()[row]]
            removed = subtree_repeats(suffixes, groups, ids[row]) < ids[row]
            # Neighbouring removed windows of a row are one run.
            begins = removed.copy()
            begins[1:] &= ~(removed[:-1] & (row[1:] == row[:-1]))
            begin = np.flatnonzero(begins)
            counts = np.diff(np.append(np.cumsum(removed)[begin] - 1, removed.sum()))
            of = row[begin]
            arrays = [pa.array(v) for v in (ids[of], hashes[of], (first[of] + nth[begin]).astype(np.int32), counts.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*arrays, *[pa.nulls(len(of), pa.int64())] * 2], names)
            left = np.flatnonzero(piece.column("common").to_numpy()[row] & ~removed)
            if len(left):
                of = row[left]
                one, two = ngrams(found.hash, size)[start[left]], mix(ngrams(mix(found.hash), size))[start[left]]
                window, ones = (first[of] + nth[left]).astype(np.int32), np.ones(len(left), np.int32)
                arrays = [pa.array(v) for v in (ids[of], hashes[of], window, ones, one.view(np.int64), two.view(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def repeated_windows(texts: DataFrame, size: int = SIZE, prefix: int = PREFIX, common: int = COMMON) -> DataFrame:
    """`id`, `text_hash`, `window`, `windows`: runs of windows whose words also start in a document of smaller id.

    `texts` has id, text_hash and text; rows without id take no part.
    """
    texts = texts.filter(F.col("id").isNotNull())
    rows = _candidates(texts, _counted(texts, size, prefix), size, prefix, common)
    part = F.when(F.col("common"), F.pmod(F.xxhash64("id"), F.lit(PARTS))).otherwise(0)
    rows = rows.withColumn("part", part).repartition("prefix", "part").sortWithinPartitions("prefix").drop("part")
    found = stored(rows.mapInArrow(_searched(size), _FOUND), "windows")
    left = found.filter(F.col("one").isNotNull())
    least = left.groupBy("one", "two").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most")
    again = left.join(least, ["one", "two"]).filter("id > least")
    run = ["id", "text_hash", "window", "windows"]
    return found.filter(F.col("one").isNull()).select(run).unionByName(again.select(run))


def _without(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches, "text", CHUNK):
            found = words(data, offsets)
            lists = batch.column("runs")
            window, windows = (lists.flatten().field(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("window", "windows"))
            row = np.repeat(np.arange(batch.num_rows), np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))
            covered = np.zeros(len(found.hash) + 1, np.int64)
            begin = found.first[row] + window
            np.add.at(covered, begin, 1)
            np.add.at(covered, begin + windows + size - 1, -1)
            kept = np.flatnonzero(np.cumsum(covered[:-1]) == 0)
            # Each kept word takes the white space after it along, but for its row's last.
            more = np.append(found.row[kept][1:] == found.row[kept][:-1], False) if len(kept) else np.zeros(0, bool)
            mark = np.zeros(len(data) + 2, np.int8)
            np.add.at(mark, found.start[kept], 1)
            np.add.at(mark, found.end[kept] + more, -1)
            inside = np.cumsum(mark[: len(data)], dtype=np.int8) > 0
            out = data.copy()
            out[found.end[kept[more]]] = 0x20
            sizes = np.append(0, np.cumsum(inside))[offsets]
            text = pa.Array.from_buffers(
                pa.large_binary(), batch.num_rows, [None, pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(out[inside].tobytes())]
            )
            total = np.diff(found.first)
            left = np.bincount(found.row[kept], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total), pa.array(total - left), text.cast(pa.binary())], ["id", "n_words", "n_removed", "kept"]
            )

    return run


def remove_repeats(df: DataFrame, id: str = "doc_id", text: str = "text", size: int = SIZE, common: int = COMMON) -> DataFrame:
    """One row per row of `df`: id, `n_words`, `n_removed`, `kept` (the words left, joined by one space, UTF-8).

    A word is a run without ASCII white space. It is removed if a window of `size` words
    that covers it also starts in a document with a smaller id. A null text has no words.
    A row with a null id keeps all and takes nothing from others; rows of the same id
    take nothing from one another. Other columns are not read.
    """
    texts = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    texts = texts.select("id", text_hash().alias("text_hash"), "text")
    runs = repeated_windows(texts, size, common=common)
    runs = runs.groupBy("id", "text_hash").agg(F.collect_list(F.struct("window", "windows")).alias("runs"))
    rows = texts.join(runs, ["id", "text_hash"], "left").select("id", "runs", "text")
    out = rows.mapInArrow(_without(size), "id long, n_words long, n_removed long, kept binary")
    return out.withColumn("id", F.col("id").cast(df.schema[id].dataType)).withColumnRenamed("id", id)
