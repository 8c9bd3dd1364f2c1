"""Set-similarity self-join of documents on word n-grams, by chosen paths.

Every text is the set of its word n-grams; equal sets form one class, which one row stands
for. A run splits all sets by tokens they share: a node of the tree picks a few of 64 min-hash
functions, and the sets with the same least token under one of them go on together. The
chance of that is their Jaccard similarity, so similar sets stay together and others part.
Small nodes are compared pair by pair; as many runs are made as the target recall needs.

Two sets may meet in several leaves. Only the least leaf they have in common counts the
pair, so links are counted without listing pairs, and none is counted twice.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import free_name, gather, intersections, list_array, lookup, mixed, shingles, slices, strings, written
from lakeops.llm.components import components

NGRAM = 5
SIMILARITY = Fraction(4, 5)
RECALL = 0.9999
#: Min-hash functions, and how many of them a node splits by.
HASHES, SPLITS = 64, 2
#: Nodes up to SMALL sets are compared at once. Larger ones are split up to DEPTH times; what
#: stays large, or holds sets so alike that a split keeps DENSE of them, is compared in blocks
#: of about BLOCK sets.
SMALL, BLOCK, DEPTH, DENSE = 512, 256, 6, 0.75
_MIX = np.random.default_rng(4).integers(1, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)


def met(similarity: float, depth: int) -> float:
    """The chance that a run of this depth brings two sets of the similarity into a common leaf."""
    chance = 1.0
    for _ in range(depth):
        chance = 1 - (1 - similarity * chance) ** SPLITS
    return chance


def runs_for(recall: float, similarity: float) -> int:
    """Runs after which two sets at the threshold have met with the target chance, at any depth."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - met(similarity, DEPTH + 1))))


def least_equal(similarity: float) -> int:
    """Equal min-hashes below which a pair is not compared exactly: five standard deviations under the mean."""
    return max(1, math.floor(HASHES * similarity - 5 * math.sqrt(HASHES * similarity * (1 - similarity))))


def _node(parent: np.ndarray, function: np.ndarray, value: np.ndarray) -> np.ndarray:
    return mixed(mixed(parent + function.astype(np.uint64)) ^ value.astype(np.uint64)).view(np.int64)


def sketch(grams: np.ndarray) -> np.ndarray:
    """The least token of the set under each hash function."""
    with np.errstate(over="ignore"):
        return np.array([(grams * m).min() for m in _MIX], np.uint64)


def _sketched(runs: int, ngram: int):
    """Kernel (row, text) -> (row, digest, sketch, nodes): the nodes are the first split of every run."""
    functions = np.arange(runs * SPLITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows, digests, sketches, nodes = [], [], [], []
            for row, grams in zip(batch.column(0).to_pylist(), shingles(strings(batch.column(1)), ngram)):
                if len(grams):
                    least = sketch(grams)
                    rows.append(row)
                    digests.append(xxhash.xxh3_128_digest(grams.tobytes()))
                    sketches.append((least >> np.uint64(48)).astype(np.uint16).tobytes())
                    nodes.append(_node(functions.astype(np.uint64) // np.uint64(SPLITS), functions, least[functions]))
            flat = np.concatenate(nodes) if nodes else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary()),
                 list_array(flat, np.full(len(rows), len(functions)), pa.int64())], ["row", "digest", "sketch", "nodes"],
            )

    return run


def _picked(nodes: np.ndarray, used: np.ndarray) -> np.ndarray:
    """SPLITS functions for each node, none of those used on its path (a bit each)."""
    functions = np.arange(HASHES, dtype=np.uint64)
    order = mixed(nodes.view(np.uint64)[:, None] + mixed(functions + np.uint64(1)))
    taken = (used.view(np.uint64)[:, None] >> functions) & np.uint64(1)
    order = np.where(taken == 1, np.uint64(np.iinfo(np.uint64).max), order)
    return np.argsort(order, axis=1)[:, :SPLITS]


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kernel (rep, sketch, node, used, n) -> (rep, node, used, parent, of): one split further."""
    for whole in batches:
        for at in range(0, whole.num_rows, 20_000):
            batch = whole.slice(at, 20_000)
            rep, node, used, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3, 4))
            values = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, HASHES)
            picked = _picked(node, used)
            for s in range(SPLITS):
                f = picked[:, s]
                child = _node(node.view(np.uint64), f, values[np.arange(len(f)), f])
                bits = used | (np.int64(1) << f.astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (rep, child, bits, node, n)], ["rep", "node", "used", "parent", "of"])


def _leaves(reps: DataFrame, runs: int) -> DataFrame:
    """(rep, node, n): the leaves with two sets or more that every set ends in."""
    bits = F.array(*[F.lit(1 << i).cast("long") for i in range(runs * SPLITS)])
    both = F.arrays_zip(F.col("nodes").alias("node"), bits.alias("used"))
    level = written(reps.select("rep", F.inline(both)), "paths")
    counts = level.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    level = written(lookup(level, counts, "node", "n", max(1, level.count())), "nodes")
    leaves = [level.filter(F.col("n") <= SMALL).select("rep", "node", "n")]
    large = level.filter(F.col("n") > SMALL)
    for depth in range(DEPTH):
        rows = large.count()
        if rows == 0:
            return _union(leaves)
        withs = reps.select("rep", "sketch").join(large, "rep").select("rep", "sketch", "node", "used", "n")
        kids = written(withs.mapInArrow(_split, "rep long, node long, used long, parent long, of long"), "split")
        counts = written(kids.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("parent").alias("parent"), F.min("of").alias("of")), "sizes")
        dense = counts.filter(F.col("n") >= DENSE * F.col("of")).groupBy(F.col("parent").alias("node")).agg(F.max("of").alias("size"))
        dense = written(dense, "dense")
        leaves.append(lookup(large, dense, "node", "size", rows).select("rep", "node", "n"))
        open_ = counts.filter("n > 1").join(dense.select(F.col("node").alias("parent")), "parent", "left_anti").select("node", "n")
        level = written(lookup(kids.select("rep", "node", "used"), open_, "node", "n", max(1, kids.count())), "nodes")
        leaves.append(level.filter(F.col("n") <= SMALL).select("rep", "node", "n"))
        large = level.filter(F.col("n") > SMALL)
    return _union([*leaves, large.select("rep", "node", "n")])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _units(df: DataFrame) -> DataFrame:
    """Rows (.., rep, node, n) with the pairs of blocks (i, j) that they take part in.

    A node of up to SMALL sets is one unit. In a larger one every block meets every block,
    itself included: each unit has two blocks' sets at most, of about BLOCK sets each.
    """
    blocks = F.when(F.col("n") <= SMALL, F.lit(1)).otherwise(F.ceil(F.col("n") / BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("rep", F.lit(7)), F.col("__blocks")).cast("int")
    rows = df.withColumn("__blocks", blocks).withColumn("block", own)
    rows = rows.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    return rows.withColumn("i", F.least("block", "__other")).withColumn("j", F.greatest("block", "__other")).drop("__blocks", "__other")


def _by_unit(df: DataFrame) -> DataFrame:
    return df.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j", "rep")


def _whole_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables that end where a unit ends, from batches sorted by unit."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        node, i, j = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "i", "j"))
        change = np.flatnonzero((np.diff(node) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0))
        first = (node[0], i[0], j[0])
        if kept:
            last = kept[-1]
            if first != tuple(last.column(c)[last.num_rows - 1].as_py() for c in ("node", "i", "j")):
                yield pa.Table.from_batches(kept)
                kept = []
        if len(change):
            cut = int(change[-1]) + 1
            yield pa.Table.from_batches([*kept, batch.slice(0, cut)])
            kept = [batch.slice(cut)]
        else:
            kept.append(batch)
    if kept:
        yield pa.Table.from_batches(kept)


class _Pairs:
    """The candidate pairs in a table of whole units, some at a time."""

    def __init__(self, table: pa.Table, least: int):
        table = table.combine_chunks()
        self.node, self.i, self.j, self.block = (table.column(c).to_numpy() for c in ("node", "i", "j", "block"))
        self.values = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(-1, HASHES)
        leaves = table.column("leaves").combine_chunks()
        counts = pc.list_value_length(leaves).to_numpy(zero_copy_only=False)
        self.leaves = np.full((len(counts), max(1, int(counts.max(initial=1)))), np.iinfo(np.int64).max)
        self.leaves[np.arange(self.leaves.shape[1]) < counts[:, None]] = pc.list_flatten(leaves).to_numpy(zero_copy_only=False)
        self.least = least
        cuts = np.flatnonzero((np.diff(self.node) != 0) | (np.diff(self.i) != 0) | (np.diff(self.j) != 0)) + 1
        self.starts = np.concatenate([[0], cuts])
        self.ends = np.concatenate([cuts, [len(self.node)]])

    def units(self) -> Iterator[tuple[int, int]]:
        return zip(self.starts.tolist(), self.ends.tolist())

    def _all(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows of the same unit; of two different blocks if the unit has two."""
        n = self.ends - self.starts
        # Row r pairs with the rows behind it in its unit.
        behind = np.repeat(self.ends, n) - np.arange(len(self.node)) - 1
        upto = np.cumsum(behind)
        done = 0
        while done < len(behind):
            stop = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + 200_000, "right")))
            rows = np.arange(done, stop)
            a = np.repeat(rows, behind[rows])
            b = gather(np.arange(len(self.node)), rows + 1, behind[rows])
            done = stop
            keep = (self.i[a] == self.j[a]) | (self.block[a] != self.block[b])
            yield a[keep], b[keep]

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for a, b in self._all():
            equal = (self.values[a] == self.values[b]).sum(1) >= self.least
            a, b = a[equal], b[equal]
            if len(a):
                keep = self._first_meeting(a, b)
                yield a[keep], b[keep]

    def _first_meeting(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs whose least common leaf is this one: none before it is common."""
        earlier = np.zeros(len(a), bool)
        own = self.node[a]
        for k in range(self.leaves.shape[1]):
            leaf = self.leaves[a, k]
            open_ = np.flatnonzero((leaf < own) & ~earlier)
            if len(open_) == 0:
                if (leaf >= own).all():
                    break
                continue
            earlier[open_] = (self.leaves[b[open_]] == leaf[open_, None]).any(1)
        return ~earlier


def _candidates(least: int):
    """Kernel over units -> (rep, node, i, j, block): sets with a candidate in the unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_units(batches):
            pairs = _Pairs(table, least)
            some = np.zeros(table.num_rows, bool)
            for a, b in pairs.candidates():
                some[a] = some[b] = True
            if some.any():
                picked = table.select(["rep", "node", "i", "j", "block", "leaves"]).filter(pa.array(some)).combine_chunks()
                yield from picked.to_batches()

    return run


def _grams(ngram: int):
    """Kernel (rep, size, units, text) -> the same with sketch and n-grams in place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingles(strings(batch.column("text")), ngram)
            sketches = [(sketch(s) >> np.uint64(48)).astype(np.uint16).tobytes() for s in sets]
            columns = [batch.column(c) for c in ("rep", "size", "units")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sketches, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["rep", "size", "units", "sketch", "grams"],
            )

    return run


def _verified(least: int, similarity: Fraction):
    """Kernel over units -> (rep, texts, docs, root): links found in the unit, and the least
    set that is linked to this one within the unit."""
    p, q = similarity.numerator, similarity.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_units(batches):
            pairs = _Pairs(table, least)
            rep, size = (table.column(c).to_numpy() for c in ("rep", "size"))
            sets = [np.frombuffer(g, np.uint64) for g in table.column("grams").to_pylist()]
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            texts, docs = np.zeros(len(rep), np.int64), np.zeros(len(rep), np.int64)
            root = np.arange(len(rep))
            found = list(pairs.candidates())
            a_all = np.concatenate([a for a, _ in found]) if found else np.empty(0, np.int64)
            b_all = np.concatenate([b for _, b in found]) if found else np.empty(0, np.int64)
            for start, end in pairs.units():
                lo, hi = np.searchsorted(a_all, [start, end])
                if lo == hi:
                    continue
                a, b = a_all[lo:hi], b_all[lo:hi]
                both = intersections(sets[start:end], a - start, b - start)
                # |x & y| / |x | y| >= p / q in whole numbers.
                alike = both * (p + q) >= p * (sizes[a] + sizes[b])
                a, b = a[alike], b[alike]
                for x, y in ((a, b), (b, a)):
                    np.add.at(texts, x, 1)
                    np.add.at(docs, x, size[y])
                while len(a):
                    low = np.minimum(root[a], root[b])
                    before = root[start:end].copy()
                    np.minimum.at(root, a, low)
                    np.minimum.at(root, b, low)
                    if (before == root[start:end]).all():
                        break
            some = texts > 0
            if some.any():
                # Rows of a unit are sorted by rep, so the first is the least.
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (rep[some], texts[some], docs[some], rep[root[some]])], ["rep", "texts", "docs", "root"]
                )

    return run


def linked(
    docs: DataFrame, key: str = "doc_id", text: str = "text", ngram: int = NGRAM, similarity: Fraction = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """One row per row of `docs`: key, class_id, text_id, n_links, n_text_links, `__row` and `__class`.

    Words are what ASCII white space separates, in lower case. Rows whose sets of n-grams are
    equal have the same text_id, the least key among them; rows that any chain of links joins
    have the same class_id, the least key in the class. n_text_links counts the other sets
    with the similarity or more, n_links the rows that have them and those with the same
    set. Texts of fewer than `ngram` words are one n-gram. Null texts and those without words
    are linked to nothing: class_id and text_id are their own key. Keys may be null or
    repeated; rows are told apart by their place, so `docs` must be a scan or another frame
    whose partitions are the same when computed again. `__row` numbers them, `__class` is the
    least of these numbers in the class.
    """
    spark = docs.sparkSession
    limit, runs = float(similarity), runs_for(recall, float(similarity))
    if runs * SPLITS > HASHES:
        raise ValueError("the recall asks for more hash functions than there are")
    least = least_equal(limit)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    drawn = written(rows.mapInArrow(_sketched(runs, ngram), "row long, digest binary, sketch binary, nodes array<long>"), "sketches")
    reps = drawn.groupBy("digest").agg(
        F.min("row").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("sketch").alias("sketch"), F.first("nodes").alias("nodes")
    )
    reps = written(reps, "texts")
    leaves = written(_leaves(reps, runs), "leaves")
    paths = leaves.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("node", "n"))).alias("paths"))
    placed = reps.select("rep", "sketch").join(paths, "rep").select("rep", "sketch", F.col("paths.node").alias("leaves"), F.inline("paths"))
    kind = "rep long, node long, i int, j int, block int, leaves array<long>"
    units = _by_unit(_units(placed)).select("rep", "node", "i", "j", "block", "sketch", "leaves")
    close = written(units.mapInArrow(_candidates(least), kind), "candidates")
    # The n-grams of those sets are made again from their texts: cheaper than to keep all.
    wanted = close.groupBy("rep").agg(F.collect_list(F.struct("node", "i", "j", "block", "leaves")).alias("units"))
    wanted = wanted.join(reps.select("rep", "size"), "rep")
    again = wanted.join(rows.withColumnRenamed("row", "rep"), "rep").select("rep", "size", "units", "text")
    inner = "array<struct<node:long,i:int,j:int,block:int,leaves:array<long>>>"
    sets = again.mapInArrow(_grams(ngram), f"rep long, size long, units {inner}, sketch binary, grams binary")
    sets = _by_unit(sets.select("rep", "size", "sketch", "grams", F.inline("units")))
    found = sets.select("rep", "size", "node", "i", "j", "block", "sketch", "leaves", "grams")
    links = written(found.mapInArrow(_verified(least, similarity), "rep long, texts long, docs long, root long"), "links-found")
    counted = links.groupBy("rep").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    joined = components(links.filter("rep != root").select(F.col("rep").alias("u"), F.col("root").alias("v")))
    stands = (
        reps.select("rep", "digest", "size")
        .join(counted, "rep", "left")
        .join(joined.withColumnRenamed("u", "rep"), "rep", "left")
        .select("digest", "size", F.coalesce("root", "rep").alias("root"), F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("docs", F.lit(0)).alias("docs"))
    )
    total = max(1, drawn.count())
    member = written(lookup(drawn.select("row", "digest"), stands, "digest", "size", total), "members")
    keys = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"))
    every = written(keys.join(member, "row", "left"), "rows")
    lone = every.filter("digest is null")
    full = every.filter("digest is not null")
    same = full.groupBy("digest").agg(F.min("key").alias("text_id"), F.first("root").alias("root"), F.count(F.lit(1)).alias("own"))
    classes = written(same, "classes")
    whole = classes.groupBy("root").agg(F.min("text_id").alias("class_id"), F.count(F.lit(1)).alias("parts"))
    known = lookup(classes, whole, "root", "parts", max(1, classes.count())).select("digest", "text_id", "class_id", "own")
    out = lookup(full, known, "digest", "own", total)
    alone, none = F.col("key"), F.lit(0).cast("long")
    return out.select(
        F.col("key").alias(key), "class_id", "text_id", (F.col("docs") + F.col("size") - 1).alias("n_links"),
        F.col("texts").alias("n_text_links"), F.col("row").alias("__row"), F.col("root").alias("__class"),
    ).unionByName(
        lone.select(
            alone.alias(key), alone.alias("class_id"), alone.alias("text_id"), none.alias("n_links"), none.alias("n_text_links"),
            F.col("row").alias("__row"), F.col("row").alias("__class"),
        )
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Of each class of `linked` the row with the least key (null last, then the first row); columns unchanged."""
    row = free_name(docs, "__row")
    order = F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"), F.col("__row").alias("r"))
    kept = linked(docs, key, text, **options).groupBy("__class").agg(F.min(order).alias("first")).select(F.col("first.r").alias(row))
    return docs.withColumn(row, F.monotonically_increasing_id()).join(kept, row, "left_semi").select(docs.columns)
