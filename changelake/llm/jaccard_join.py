"""N-gram Jaccard join by T-occurrence search.

A document that links with a set of n shingles shares `T` = ceil(t n) of them at least, so
it occurs T times on the inverted lists of the set's shingles. Leaving out the T - 1 most
frequent shingles, it still occurs once on the others: on these, the prefix, candidates
are found.

1. Equal sets are one. Of all sets, the shingles in a fixed part of the hash space are
   grouped; a set that has more than n - T of them to itself can link with none and is
   out. Unlike a prefix of each set, that part is the same for all, so "to itself" holds.
2. For the sets left, a sketch of fixed size counts the documents of each shingle. Any
   order of all shingles gives the same result; this one puts the rare ones first.
   Prefix shingles that two sets of like size share put these sets in one candidate group:
   sets fall into size classes of which only neighbours can link, and for each two
   neighbouring classes groups are formed anew, so chains of sets that grow in size don't
   make one large group. All links lie within groups.
3. A group is cut by its size classes and by hash into blocks of bounded size. Small groups are one block and one task's work. Of a large group,
   each block is first searched together with one other block, which connects most of a
   group of near copies. Then only the sets outside its largest part, packed into blocks,
   are searched against all blocks: sets of that part are connected already.
4. Within a task's blocks each set is a query on the inverted lists of the others. By
   DivideSkip, short lists are merged with a heap, and candidates that occur on them often
   enough are looked up in the long ones by binary search. Sets known to be connected are
   passed over, and only links that connect two parts are returned.

Shingles are 64-bit hashes, sets 128-bit ones; two differ and share a hash with odds of
2^-64 and 2^-128 for a pair.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.llm.bloom import bloom, maybe
from changelake.llm.columns import chunks, stored, text_hash
from changelake.llm.components import components
from changelake.llm.words import CHUNK, LOWER, mix, ngrams, words

#: Words of a shingle, and the similarity that links, in hundredths.
SHINGLE = 4
PERCENT = 85
#: The part of the hash space in which shingles are grouped, of 256.
PART = 80
#: Shingles of a block.
BLOCK = 1 << 18
#: Largest sketch: 2^24 counters of 4 bytes.
SKETCH_BITS = 24
#: Sets handled together.
ROWS = 256
#: Sets remembered by a task so as not to send copies twice; beyond, some are sent again.
SEEN = 200_000
#: The share of the occurrences asked for that DivideSkip leaves to the long lists falls
#: with the length of the longest list, by this factor.
SKIP = 0.01


def shingle_sets(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Each row's sorted distinct shingles; the text is the batch's last column.

    Fewer words than `size` are one shingle, no word none.
    """
    for batch, data, offsets in chunks(batches, "text", CHUNK):
        found = words(data, offsets, LOWER)
        grams = ngrams(found.hash, size)
        sets = []
        for begin, end in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
            if end - begin >= size:
                sets.append(np.unique(grams[begin : end - size + 1]))
            elif end > begin:
                # Lengths are told apart from one another and from full shingles.
                short = ngrams(found.hash[begin:end], end - begin)
                sets.append(mix(short + np.uint64(end - begin)))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield batch, sets


def _key(shingles: np.ndarray) -> bytes:
    one = mix(shingles).sum(dtype=np.uint64)
    two = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(one).to_bytes(8, "big") + int(two).to_bytes(8, "big")


def _half(key: str) -> Column:
    """The first half of a set's key as a number."""
    return F.conv(F.hex(F.substring(key, 1, 8)), 16, -10).cast("long")


def needed(n: int, percent: int) -> int:
    """Shingles that any set linked with one of `n` shares with it at least."""
    return -(-percent * n // 100)


def frequencies(sets: DataFrame, bits: int) -> np.ndarray:
    """Sets by the leading bits of a shingle's hash: `2^bits` counters."""
    parts = min(1 << bits, 64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                raw = b"".join(batch.column(0).slice(start, ROWS).to_pylist())
                total += np.bincount((np.frombuffer(raw, np.uint64) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        if total.any():
            slices = [part.astype("<u4").tobytes() for part in np.split(total, parts)]
            yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array(slices, pa.binary())], ["part", "counts"])

    def add(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = None, 0
        for batch in rows:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total = total + np.frombuffer(counts, "<u4").astype(np.uint64)
        capped = np.minimum(total, np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([capped], pa.binary())], ["part", "counts"])

    schema = "part int, counts binary"
    rows = sets.select("shingles").mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect()
    out = np.zeros(1 << bits, np.uint32)
    for part, counts in rows:
        step = (1 << bits) // parts
        out[part * step : (part + 1) * step] = np.frombuffer(counts, "<u4")
    return out


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """id, text hash, `n`, `set`, and of each set that a task meets first the shingles in `PART`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch, sets in shingle_sets(batches, size):
            keys, parts = [_key(shingles) for shingles in sets], []
            for key, shingles in zip(keys, sets):
                # Shingles are sorted, so the part is where they begin.
                parts.append(None if key in seen else shingles[: np.searchsorted(shingles, np.uint64(PART << 56))].view(np.int64))
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(key)
            arrays = [batch.column(0), batch.column(1), pa.array(list(map(len, sets)), pa.int64()), pa.array(keys, pa.binary())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(parts, pa.list_(pa.int64()))], ["id", "text_hash", "n", "set", "part"])

    return texts.mapInArrow(run, "id long, text_hash long, n long, set binary, part array<long>")


def _linkable(sets: DataFrame, percent: int) -> DataFrame:
    """`set` of those that have no more than n - T shingles to themselves, as far as `PART` shows."""
    spread = sets.select(F.xxhash64("set").alias("h"), F.explode("part").alias("token")).repartition("token")
    alone = spread.groupBy("token").agg(F.min("h").alias("h"), F.max("h").alias("high")).filter("h = high")
    alone = alone.groupBy("h").agg(F.count("token").alias("alone"))
    distinct = sets.filter("n > 0").select("set", "n").distinct()
    known = distinct.join(alone, F.xxhash64("set") == F.col("h"), "left")
    spare = F.col("n") - F.ceil(F.col("n") * percent / 100)
    return known.filter(F.coalesce("alone", F.lit(0)) <= spare).select("set")


def _prefixes(full: DataFrame, counts: np.ndarray, percent: int) -> DataFrame:
    """`set`, `n` and `prefix` of all sets."""
    bits = len(counts).bit_length() - 1
    held = full.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                sets = [np.frombuffer(raw, np.uint64) for raw in part.column(1).to_pylist()]
                prefixes = []
                for shingles in sets:
                    # Equal counts stay in the order of the hashes: one order for all sets.
                    order = np.argsort(held.value[shingles >> np.uint64(64 - bits)], kind="stable")
                    prefixes.append(shingles[order[: len(shingles) - needed(len(shingles), percent) + 1]].view(np.int64))
                arrays = [part.column(0), pa.array(list(map(len, sets)), pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, ["set", "n", "prefix"])

    return full.select("set", "shingles").mapInArrow(run, "set binary, n long, prefix array<long>")


def _shared_postings(prefixes: DataFrame) -> DataFrame:
    """`token`, `set`, `n`: the prefix shingles that two sets or more have."""
    postings = prefixes.select(F.explode("prefix").alias("token"), "set", "n")
    shared = postings.groupBy("token").agg(F.count("set").alias("sets")).filter("sets > 1").select("token")
    return postings.join(shared, "token")


def _class(percent: int) -> Column:
    """Size class of a set of `n`: a linked set has t times the size at least, so classes further apart hold no links."""
    return F.floor(F.log("n") / max(math.log(100 / percent) * 1.0001, 1e-7))


def _groups(postings: DataFrame, percent: int) -> DataFrame:
    """`set`, `n`, `group` of all sets that share a prefix shingle with another one of their size class or the next.

    For each class and the one above it, sets are grouped apart, so a set may be in two groups.
    """
    dealt = postings.withColumn("class", _class(percent)).repartition("token")
    centres = dealt.groupBy("token", F.col("class").alias("lower")).agg(F.min("set").alias("v"))
    near = (F.col("lower") == F.col("class")) | (F.col("lower") == F.col("class") - 1)
    lower = F.unhex(F.lpad(F.hex("lower"), 8, "0"))
    edges = dealt.join(centres, "token").filter(near).select(F.concat("set", lower).alias("u"), F.concat("v", lower).alias("v"))
    grouped = components(edges).select(F.expr("substring(node, 1, length(node) - 4)").alias("set"), F.col("component").alias("group"))
    return postings.select("set", "n").distinct().join(grouped, "set")


_PAIR = ("group", "c", "r", "d", "i")


def _pair(**parts: Column) -> Column:
    none = F.lit(None).cast("long")
    return F.struct(*[parts.get(name, none).cast("binary" if name == "group" else "long").alias(name) for name in _PAIR]).alias("pair")


def _small(members: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """The work of small groups, and the members of large ones."""
    whole = members.groupBy("group").agg(F.sum("n").alias("total"))
    members = members.join(whole, "group")
    small = members.filter(F.col("total") <= block)
    return small.select("set", _pair(group=F.col("group")), F.lit(0).alias("side")), members.filter(F.col("total") > block).drop("total")


def _with_counts(rows: DataFrame, counted: DataFrame, name: str) -> DataFrame:
    """`rows` with the number `name` of their class, and of the classes before and after it."""
    for shift, suffix in ((-1, "_before"), (0, ""), (1, "_after")):
        other = counted.select("group", (F.col("class") - shift).alias("class"), F.col(name).alias(f"{name}{suffix}"))
        rows = rows.join(other, ["group", "class"], "left").fillna(0, f"{name}{suffix}")
    return rows


def _cut(large: DataFrame, percent: int, block: int) -> DataFrame:
    """Large groups' sets with their size `class`, and their block `own` of the class's `blocks`."""
    large = large.withColumn("class", _class(percent))
    counted = large.groupBy("group", "class").agg(F.ceil(F.sum("n") / block).alias("blocks"))
    return _with_counts(large, counted, "blocks").withColumn("own", F.pmod(F.xxhash64("set"), F.col("blocks")))


def _first_round(cut: DataFrame) -> DataFrame:
    """Each block by itself and beside the first one of its class; the first ones beside those of the class below."""
    group, size, own = F.col("group"), F.col("class"), F.col("own")
    alone = cut.select("set", _pair(group=group, c=size, i=own), F.lit(0).alias("side"))
    first = cut.filter("own = 0")
    others = first.filter("blocks > 1").withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("blocks") - 1)))
    others = others.select("set", _pair(group=group, c=size, i=F.col("i")), F.lit(2).alias("side"))
    above = first.filter("blocks_after > 0").select("set", _pair(group=group, c=size + 1, i=F.lit(0)), F.lit(2).alias("side"))
    return alone.unionByName(others).unionByName(above)


def _second_round(cut: DataFrame, linked: DataFrame, block: int) -> DataFrame:
    """Sets outside the largest part of their group, in blocks, against all blocks; `known` are the parts so far."""
    known = cut.join(linked, "set", "left").withColumn("known", F.coalesce("component", "set")).drop("component")
    parts = known.groupBy("group", "known").agg(F.count(F.lit(1)).alias("size"))
    largest = parts.groupBy("group").agg(F.max(F.struct("size", "known")).alias("largest"))
    known = known.join(largest, "group").withColumn("out", F.col("known") != F.col("largest.known")).drop("largest")
    counted = known.filter("out").groupBy("group", "class").agg(F.ceil(F.sum("n") / block).alias("packs"))
    known = _with_counts(known, counted, "packs")
    group, size, own = F.col("group"), F.col("class"), F.col("own")

    def spread(rows: DataFrame, name: str) -> DataFrame:
        """A row for each of the numbered things in the class and its neighbours."""

        def numbered(column: str, shift: int) -> Column:
            numbers = F.sequence(F.lit(0).cast("long"), F.col(column) - 1)
            found = F.transform(numbers, lambda k: F.struct(F.lit(shift).alias("shift"), k.alias("k")))
            return F.when(F.col(column) > 0, found).otherwise(F.array().cast("array<struct<shift: int, k: bigint>>"))

        each = [numbered(f"{name}_before", -1), numbered(name, 0), numbered(f"{name}_after", 1)]
        return rows.withColumn("at", F.explode(F.concat(*each)))

    pack = F.pmod(F.xxhash64("set", F.lit("pack")), F.col("packs"))
    queries = spread(known.filter("out").withColumn("pack", pack), "blocks").select(
        "set", _pair(group=group, c=size, r=F.col("pack"), d=size + F.col("at.shift"), i=F.col("at.k")), F.lit(1).alias("side"), "known"
    )
    indexed = spread(known, "packs").select(
        "set", _pair(group=group, c=size + F.col("at.shift"), r=F.col("at.k"), d=size, i=own), F.lit(2).alias("side"), "known"
    )
    return queries.unionByName(indexed)


def _full_sets(texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """`set` and its `shingles` for all those wanted, each set once."""
    held = texts.sparkSession.sparkContext.broadcast(bloom(wanted.select(_half("set"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for _, sets in shingle_sets(batches, size):
            keys = [_key(shingles) for shingles in sets]
            may = maybe(held.value, np.frombuffer(b"".join(keys), ">u8")[::2].astype(np.uint64))
            places = []
            for place in np.flatnonzero(may).tolist():
                key = keys[place]
                if key not in seen and len(sets[place]):
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(key)
                    places.append(place)
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[place] for place in places], pa.binary()), pa.array([sets[place].tobytes() for place in places], pa.binary())],
                ["set", "shingles"],
            )

    return texts.select("text").mapInArrow(run, "set binary, shingles binary").join(wanted, "set").dropDuplicates(["set"])


def _filtered(full: DataFrame, wanted: DataFrame) -> DataFrame:
    """`full` without most sets that are not `wanted`, so that these are not shuffled."""
    held = full.sparkSession.sparkContext.broadcast(bloom(wanted.select(_half("set"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = np.frombuffer(b"".join(batch.column("set").to_pylist()), ">u8")[::2].astype(np.uint64)
                yield batch.filter(pa.array(maybe(held.value, keys)))

    return full.mapInArrow(run, full.schema)


class Index:
    """Inverted lists over the sets of a block."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sets = sets
        self.sizes = np.array([len(each) for each in sets], np.int64)
        tokens = np.concatenate([*sets, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.tokens, first = np.unique(tokens[order], return_index=True)
        self.owners = owner[order]
        self.first = np.append(first, len(order))

    def lists(self, query: np.ndarray) -> list[np.ndarray]:
        """The non-empty lists of the query's shingles, the short ones first."""
        if not len(self.tokens):
            return []
        place = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        place = place[self.tokens[place] == query]
        lengths = self.first[place + 1] - self.first[place]
        place = place[np.argsort(lengths, kind="stable")]
        return [self.owners[self.first[p] : self.first[p + 1]] for p in place.tolist()]

    def search(self, query: np.ndarray, percent: int, open_: np.ndarray) -> Iterator[int]:
        """Sets among the `open_` ones that link with the query, by DivideSkip."""
        t = needed(len(query), percent)
        lists = self.lists(query)
        if len(lists) < t or not open_.any():
            return
        skipped = min(t - 1, int(t / (SKIP * math.log2(len(lists[-1]) + 1) + 1)))
        short, long = lists[: len(lists) - skipped], lists[len(lists) - skipped :]
        left = [part for part in (part[open_[part]].tolist() for part in short) if part]
        candidates, counts = [], []
        for owner, times in groupby(heapq.merge(*left)):
            count = sum(1 for _ in times)
            if count >= t - skipped:
                candidates.append(owner)
                counts.append(count)
        if not candidates:
            return
        found, shared = np.array(candidates), np.array(counts)
        for place, part in enumerate(long):
            at = np.minimum(np.searchsorted(part, found), len(part) - 1)
            shared = shared + (part[at] == found)
            # Those that no longer can reach T are dropped now and then.
            if place % 16 == 15:
                may = shared + len(long) - place - 1 >= t
                found, shared = found[may], shared[may]
                if not len(found):
                    return
        union = len(query) + self.sizes[found] - shared
        yield from found[100 * shared >= percent * union].tolist()


class _Forest:
    def __init__(self, labels: np.ndarray) -> None:
        self.label = labels

    def join(self, one: int, two: int) -> bool:
        a, b = self.label[one], self.label[two]
        if a != b:
            self.label[self.label == b] = a
        return a != b


def block_links(sides: list[int], sets: list[np.ndarray], percent: int, parts: list | None = None) -> list[tuple[int, int]]:
    """Links of a task's sets as far as they connect parts not connected yet.

    Sets of side 1 are queries on the others, those of side 2 are only indexed, and those
    of side 0 are both. `parts` names the known part of each set.
    """
    labels = np.arange(len(sets)) if parts is None else np.unique(parts, return_inverse=True)[1]
    forest, links = _Forest(labels), []
    indexed = np.array([number for number, side in enumerate(sides) if side != 1], np.int64)
    always = np.array([sides[number] == 2 for number in indexed], bool)
    index = Index([sets[number] for number in indexed])
    for query, side in enumerate(sides):
        if side == 2:
            continue
        open_ = forest.label[indexed] != forest.label[query]
        if side == 0:
            open_ &= always | (indexed < query)
        for found in index.search(sets[query], percent, open_):
            other = int(indexed[found])
            if forest.join(query, other):
                links.append((query, other))
    return links


def _links(blocks: DataFrame, percent: int) -> DataFrame:
    """`u`, `v`: links that connect all linked sets of each task, as far as they are not `known` to be."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sides, parts, sets = [], [], [], []
        for batch in rows:
            keys += batch.column("set").to_pylist()
            sides += batch.column("side").to_pylist()
            parts += batch.column("known").to_pylist()
            sets += [np.frombuffer(raw, np.uint64) for raw in batch.column("shingles").to_pylist()]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        known = np.array([parts[n] for n in order], object)
        links = block_links([sides[n] for n in order], [sets[n] for n in order], percent, known)
        yield pa.RecordBatch.from_arrays(
            [pa.array([keys[order[pair[end]]] for pair in links], pa.binary()) for end in (0, 1)], ["u", "v"]
        )

    return blocks.select("pair", "set", "side", "known", "shingles").groupBy("pair").applyInArrow(run, "u binary, v binary")


def _all_links(full: DataFrame, members: DataFrame, percent: int, block: int) -> DataFrame:
    small, large = _small(members, block)
    cut = stored(_cut(large, percent, block), "cut")
    first = small.unionByName(_first_round(cut)).withColumn("known", F.col("set"))
    links = stored(_links(full.join(first, "set"), percent), "links")
    if cut.isEmpty():
        return links
    linked = components(links).select(F.col("node").alias("set"), "component")
    second = _second_round(cut, linked, block)
    # Stored, as `components` works on them in Python too: a task then has one Python worker, not two at once.
    return links.unionByName(stored(_links(_filtered(full, cut).join(second, "set"), percent), "links"))


def jaccard_components(
    df: DataFrame, id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK
) -> DataFrame:
    """One row per row of `df`: id, `n_shingles`, `component_id`, `kept`, `text_hash`.

    Words are runs without ASCII white space, A-Z lower-cased; a set holds the distinct
    shingles of `size` words, or the whole sequence if it is shorter. Sets link if 100
    times the intersection is at least `percent` times the union. `component_id` is the
    smallest id that links lead to; of each class its row is kept, of several with that id
    the one with the smallest text hash. A text without words, or null, has an empty set,
    links with nothing and is kept. A null id doesn't count as smallest unless there is no other;
    repeated ids are rows of their own. Other columns are not read.
    """
    kind = df.schema[id].dataType
    texts = df.select(F.col(id).cast("long").alias("id"), text_hash(text).alias("text_hash"), F.col(text).alias("text"))
    sets = stored(_sets(texts, size), "sets")
    wanted = stored(_linkable(sets, percent), "linkable")
    full = stored(_full_sets(texts, wanted, size), "full")
    number = max(1, wanted.count())
    counts = frequencies(full, min(SKETCH_BITS, max(12, math.ceil(math.log2(16 * number)))))
    postings = stored(_shared_postings(_prefixes(full, counts, percent)), "postings")
    members = stored(_groups(postings, percent), "members")
    linked = components(_all_links(full, members, percent, block)).select(F.col("node").alias("set"), "component")
    rank = F.struct(F.coalesce("id", F.lit((1 << 63) - 1)).alias("id"), "text_hash")
    by_set = sets.filter("n > 0").groupBy("set").agg(F.min(rank).alias("least"))
    by_set = by_set.join(linked, "set", "left").withColumn("component", F.coalesce("component", "set"))
    classes = by_set.groupBy("component").agg(F.min("least").alias("first"))
    classes = by_set.join(classes, "component").select("set", "first")
    rows = sets.withColumn("rank", rank).select("id", "text_hash", "n", "set", "rank")
    empty = rows.filter("n = 0").withColumn("first", F.col("rank")).drop("set")
    rows = rows.filter("n > 0").join(classes, "set").drop("set").unionByName(empty)
    component = F.when(F.col("first.id") < (1 << 63) - 1, F.col("first.id"))
    return rows.select(
        F.col("id").cast(kind).alias(id),
        F.col("n").alias("n_shingles"),
        component.cast(kind).alias("component_id"),
        (F.col("rank") == F.col("first")).alias("kept"),
        "text_hash",
    )
