"""Exact deduplication by recursive hash partitioning and complete comparison.

1. Each task runs its rows through a bounded open-addressing table, so that of copies
   read together only one text goes on, with a number of its rows and its first id; the
   others keep a pointer to it. The result is written to the shared scratch folder.
2. Texts are partitioned by the leading bits of a 64-bit hash, first by as many bits as
   the total size asks for. Partitions that hold more than the memory of a table are
   partitioned again by further bits, until they fit or hold one hash only.
3. Partition by partition, one table compares complete contents and finds each group's
   size and the row that stays. Rows learn it by their pointers.

A group of copies costs one text per task that read one, however many rows it has, and a
table holds each different text once.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm.columns import bytes_of, stored, text_hash, text_or_empty

#: Bytes of text that one table holds.
MEMORY = 12 << 20
#: Further bits by which a partition that is too large is split.
STEP = 4
#: Large partitions up to this number are named to all tasks; a row of them takes 16 bytes.
NAMED = 1 << 16
#: The smallest id wins; null ids come last, and of equal ids the row read first.
_LAST = (1 << 63) - 1


class ContentTable:
    """Open addressing with linear probing; two entries are equal only if all their bytes are."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.slots = np.full(1 << 10, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, value: int, content: bytes) -> tuple[int, bool]:
        """Number of the entry with this content, and whether it is new."""
        mask = len(self.slots) - 1
        place = value & mask
        while (entry := int(self.slots[place])) >= 0:
            if self.hashes[entry] == value and self.contents[entry] == content:
                return entry, False
            place = (place + 1) & mask
        entry = len(self.contents)
        self.slots[place] = entry
        self.hashes.append(value)
        self.contents.append(content)
        self.bytes += len(content) + 64
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return entry, True

    def _grow(self) -> None:
        self.slots = np.full(4 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for entry, value in enumerate(self.hashes):
            place = value & mask
            while self.slots[place] >= 0:
                place = (place + 1) & mask
            self.slots[place] = entry


def normalized(text: str = "text") -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(text_or_empty(text), r"[\x20\x09-\x0D]+", " ")


_SPILLED = "id long, row long, pointer long, text_hash long, sha string, first long, first_row long, copies long, hash long, content binary"


def _collapsed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A pointer for each row, and each table's different texts."""
    table = ContentTable()
    entries: list[list[int]] = []
    for batch in batches:
        ids, rows, values = (batch.column(place).to_pylist() for place in range(3))
        data, offsets = bytes_of(batch.column(5))
        pointers = []
        for place, (id, row, value) in enumerate(zip(ids, rows, values)):
            entry, new = table.find(value, data[offsets[place] : offsets[place + 1]].tobytes())
            rank = _LAST if id is None else id
            if new:
                entries.append([row, rank, row, 0])
            best = entries[entry]
            best[3] += 1
            if (rank, row) < (best[1], best[2]):
                best[1:3] = rank, row
            pointers.append(best[0])
            if table.bytes >= MEMORY:
                yield _texts(table, entries)
                table.clear()
                entries = []
        yield _spilled(len(ids), id=ids, row=rows, pointer=pointers, text_hash=batch.column(3), sha=batch.column(4))
    if entries:
        yield _texts(table, entries)
    pa.default_memory_pool().release_unused()


def _texts(table: ContentTable, entries: list[list[int]]) -> pa.RecordBatch:
    pointers, firsts, rows, copies = zip(*entries)
    return _spilled(
        len(entries), pointer=pointers, first=firsts, first_row=rows, copies=copies, hash=table.hashes, content=table.contents
    )


def _spilled(size: int, **columns: Iterable) -> pa.RecordBatch:
    kinds = {"sha": pa.string(), "content": pa.binary()}
    names = [part.split()[0] for part in _SPILLED.split(", ")]
    arrays = []
    for name in names:
        column, kind = columns.get(name), kinds.get(name, pa.int64())
        arrays.append(pa.nulls(size, kind) if column is None else column if isinstance(column, pa.Array) else pa.array(column, kind))
    return pa.RecordBatch.from_arrays(arrays, names)


def _partitioned(texts: DataFrame, memory: int) -> DataFrame:
    """`texts` with `bits` and `prefix`, the partition each row belongs to."""
    prefix = F.expr("if(bits = 0, 0L, shiftrightunsigned(hash, 64 - bits))")
    total = texts.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, total / memory))) + 1) if total > memory else 0
    texts = texts.withColumn("bits", F.lit(bits)).withColumn("prefix", prefix)
    while bits < 64:
        sizes = texts.groupBy("bits", "prefix").agg(
            F.sum(F.octet_length("content")).alias("size"), F.min("hash").alias("low"), F.max("hash").alias("high")
        )
        large = stored(sizes.filter((F.col("size") > memory) & (F.col("low") != F.col("high"))).select("bits", "prefix"), "large")
        number = large.count()
        if not number:
            break
        named = F.broadcast(large) if number <= NAMED else large
        texts = texts.join(named.withColumn("split", F.lit(STEP)), ["bits", "prefix"], "left")
        texts = texts.withColumn("bits", F.least(F.col("bits") + F.coalesce("split", F.lit(0)), F.lit(64))).drop("split")
        texts = texts.withColumn("prefix", prefix)
        bits += STEP
    return texts


def _compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each pointer of a partition its group's first id and row and its size; rows come by partition."""
    table, groups, waiting, current = ContentTable(), [], [], None
    for batch in batches:
        columns = [batch.column(place).to_pylist() for place in range(8)]
        for bits, prefix, value, pointer, first, first_row, copies, content in zip(*columns):
            if (bits, prefix) != current:
                yield from _groups(waiting, groups)
                table.clear()
                groups, waiting, current = [], [], (bits, prefix)
            entry, new = table.find(value, content)
            if new:
                groups.append([first, first_row, 0])
            group = groups[entry]
            group[2] += copies
            if (first, first_row) < (group[0], group[1]):
                group[:2] = first, first_row
            waiting.append((pointer, entry))
    yield from _groups(waiting, groups)
    pa.default_memory_pool().release_unused()


def _groups(waiting: list[tuple[int, int]], groups: list[list[int]]) -> Iterator[pa.RecordBatch]:
    if waiting:
        found = [(pointer, None if groups[entry][0] == _LAST else groups[entry][0], *groups[entry][1:]) for pointer, entry in waiting]
        columns = [pa.array(column, pa.int64()) for column in zip(*found)]
        yield pa.RecordBatch.from_arrays(columns, ["pointer", "keep_id", "keep_row", "group_size"])


def deduplicate(df: DataFrame, id: str = "doc_id", text: str = "text", memory: int = MEMORY) -> DataFrame:
    """One row per row of `df`: id, `keep_id`, `group_size`, `kept`, `text_sha256`, `text_hash`.

    Texts are equal if they are so after each run of ASCII white space has become one
    space; a null is an empty text. Of each group the row with the smallest id is kept;
    a null id comes last, and of rows with the same id one is kept. Other columns are not
    read. An empty table gives an empty result.
    """
    rows = df.select(F.col(id).cast("long").alias("id"), text_hash(text).alias("text_hash"), normalized(text).alias("content"))
    rows = rows.select(
        "id",
        F.monotonically_increasing_id().alias("row"),
        F.xxhash64("content").alias("hash"),
        "text_hash",
        F.sha2("content", 256).alias("sha"),
        "content",
    )
    spilled = stored(rows.mapInArrow(_collapsed, _SPILLED), "spilled")
    texts = spilled.filter(F.col("content").isNotNull()).select("pointer", "first", "first_row", "copies", "hash", "content")
    texts = _partitioned(texts, memory).repartition("bits", "prefix").sortWithinPartitions("bits", "prefix")
    groups = texts.select("bits", "prefix", "hash", "pointer", "first", "first_row", "copies", "content").mapInArrow(
        _compared, "pointer long, keep_id long, keep_row long, group_size long"
    )
    pointers = spilled.filter(F.col("row").isNotNull()).select("id", "row", "pointer", "text_hash", "sha")
    return pointers.join(groups, "pointer").select(
        F.col("id").cast(df.schema[id].dataType).alias(id),
        F.col("keep_id").cast(df.schema[id].dataType).alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "text_hash",
    )
