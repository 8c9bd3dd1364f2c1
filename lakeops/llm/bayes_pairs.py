"""Near-duplicate components by min-hash bands and sequential Bayesian verification.

Texts with equal sets of word n-grams are one set, which one row stands for. Every set has HASHES
min-hashes; sets that agree in all of a band's are candidates. A candidate pair's signatures are
compared batch by batch: with a uniform prior, the equal ones so far give the posterior of the
pair's similarity, and the pair goes as soon as the chance that it reaches the threshold is under the
chosen miss probability. Survivors are confirmed on their full sets.

A band's bucket may hold very many sets, so its pairs are never listed. First each set meets its
buckets' head only, the set that shares most buckets with most others: of near copies that is
what they were copied from. What the confirmed links have joined needs no further comparison.
In buckets that still hold several components, sets outside the largest one meet all others, in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import gather, intersections, lookup, mixed, shingles, slices, strings, written
from lakeops.llm.components import components
from lakeops.operators.joins import broadcast_checked

NGRAM = 5
SIMILARITY = Fraction(85, 100)
#: The chance to reach the threshold under which a pair is dropped.
MISS = 1e-7
#: Min-hashes, those of a band, and those compared at a time. Two sets at the threshold share no
#: band with a chance of (1 - 0.85 ** 5) ** 24, about one in a million.
HASHES, BAND, STEP = 120, 5, 15
#: Sets of a bucket that meet at once, and sets of a block in larger buckets.
SMALL, BLOCK = 256, 128
_MIX = np.random.default_rng(13).integers(1, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_UNIT = "rep long, unit long, band int, i int, j int, block int, part long"
_PLACE = ["unit", "band", "i", "j", "block", "part"]


def least_matches(similarity: float, miss: float = MISS) -> list[int]:
    """After each batch, the equal min-hashes from which a pair may still reach the similarity.

    m of n equal ones make the posterior Beta(m + 1, n - m + 1); its part above s is the chance of at
    most m heads in n + 1 throws of a coin that shows them with chance s.
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        upto, m = 0.0, -1
        while upto < miss:
            m += 1
            upto += math.comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
        out.append(m)
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """16 bits of each min-hash of sets that are not empty, all sets side by side."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), HASHES), np.uint16)
    with np.errstate(over="ignore"):
        for k, m in enumerate(_MIX):
            out[:, k] = mixed(np.minimum.reduceat(flat * m, starts)).astype(np.uint16)
    return out


def _drawn(ngram: int, schema: pa.Schema):
    """Kernel (row, key, text) -> (row, key, n, digest, signature); no digest where there are no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingles(strings(batch.column(2)), ngram, ascii_only=True)
            some = [s for s in sets if len(s)]
            drawn = iter(signatures(some) if some else ())
            both = [(xxhash.xxh3_128_digest(s.tobytes()), next(drawn).tobytes()) if len(s) else (None, None) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(map(len, sets), pa.int64()),
                 pa.array([d for d, _ in both], pa.binary()), pa.array([s for _, s in both], pa.binary())], schema=schema,
            )

    return run


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole units, from batches sorted by unit, i, j."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        unit = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("unit", "i", "j")], 1)
        change = np.flatnonzero((unit[1:] != unit[:-1]).any(1)) + 1
        if kept and (unit[0] != last).any():
            yield pa.Table.from_batches(kept)
            kept = []
        if len(change):
            yield pa.Table.from_batches([*kept, batch.slice(0, int(change[-1]))])
            kept = [batch.slice(int(change[-1]))]
        else:
            kept.append(batch)
        last = unit[-1]
    if kept:
        yield pa.Table.from_batches(kept)


def _pairs(table: pa.Table, least: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a unit that are of different parts (and blocks, if it has two) and survive the posterior.

    A pair may meet in several bands' buckets, all of them open if one is: the first band counts it.
    """
    unit, band, i, j, block, part = (table.column(c).to_numpy() for c in _PLACE)
    drawn = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, HASHES)
    cuts = np.flatnonzero((unit[1:] != unit[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
    ends = np.repeat(np.append(cuts, len(unit)), np.diff(np.concatenate([[0], cuts, [len(unit)]])))
    behind = ends - np.arange(len(unit)) - 1
    upto, done, rows = np.cumsum(behind), 0, np.arange(len(unit))
    while done < len(unit):
        stop = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + 200_000, "right")))
        some = rows[done:stop]
        a, b = np.repeat(some, behind[some]), gather(rows, some + 1, behind[some])
        done = stop
        open_ = (part[a] != part[b]) & ((i[a] == j[a]) | (block[a] != block[b]))
        a, b = a[open_], b[open_]
        equal = np.zeros(len(a), np.int64)
        for k, m in enumerate(least):
            at = slice(k * STEP, k * STEP + STEP)
            equal += (drawn[a, at] == drawn[b, at]).sum(1)
            keep = equal >= m
            a, b, equal = a[keep], b[keep], equal[keep]
        first = (drawn[a] == drawn[b]).reshape(-1, HASHES // BAND, BAND).all(2).argmax(1)
        keep = (band[a] < 0) | (band[a] == first)
        if keep.any():
            yield a[keep], b[keep]


def _survivors(least: list[int]):
    """Kernel over units with signatures -> their rows that are in a surviving pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _units(batches):
            table = table.combine_chunks()
            some = np.zeros(table.num_rows, bool)
            for a, b in _pairs(table, least):
                some[a] = some[b] = True
            if some.any():
                yield from table.select(["rep", *_PLACE]).filter(pa.array(some)).combine_chunks().to_batches()

    return run


def _sets(ngram: int):
    """Kernel (rep, text) -> (rep, grams)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingles(strings(batch.column(1)), ngram, ascii_only=True)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["rep", "grams"])

    return run


def _confirmed(least: list[int], similarity: Fraction):
    """Kernel over units with sets -> (u, v): confirmed links that join what the unit's links join."""
    p, q = similarity.numerator, similarity.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _units(batches):
            table = table.combine_chunks()
            rep = table.column("rep").to_numpy()
            sets = [np.frombuffer(g, np.uint64) for g in table.column("grams").to_pylist()]
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            root = np.arange(len(rep))
            for a, b in _pairs(table, least):
                # Sets that other links of the unit have joined, and sizes too far apart, need no look.
                small, large = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
                open_ = (root[a] != root[b]) & (q * small >= p * large)
                a, b = a[open_], b[open_]
                for start in range(0, len(a), 20_000):
                    x, y = a[start : start + 20_000], b[start : start + 20_000]
                    x, y = (v[root[x] != root[y]] for v in (x, y))
                    if len(x) == 0:
                        continue
                    held, place = np.unique(np.concatenate([x, y]), return_inverse=True)
                    both = intersections([sets[h] for h in held], place[: len(x)], place[len(x) :])
                    # |x & y| / |x | y| >= p / q in whole numbers.
                    alike = both * (p + q) >= p * (sizes[x] + sizes[y])
                    _join(root, x[alike], y[alike])
            linked = np.flatnonzero(root != np.arange(len(rep)))
            linked = linked[rep[linked] != rep[root[linked]]]
            if len(linked):
                yield pa.RecordBatch.from_arrays([pa.array(rep[linked]), pa.array(rep[root[linked]])], ["u", "v"])

    return run


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give all rows that links join the least of their numbers."""
    while len(a):
        low = np.minimum(root[a], root[b])
        if (root[a] == low).all() and (root[b] == low).all():
            return
        for x in (a, b):
            # A row's root takes the lower one too, so that all of its rows follow.
            np.minimum.at(root, root[x], low)
            np.minimum.at(root, x, low)
        while (root[root] != root).any():
            root[:] = root[root]


def _links(units: DataFrame, drawn: DataFrame, sets: DataFrame, least: list[int], similarity: Fraction, name: str) -> DataFrame:
    """(u, v): confirmed links of units (rep, unit, band, i, j, block, part)."""
    by_unit = lambda df: df.repartition("unit", "i", "j").sortWithinPartitions("unit", "i", "j", "rep")
    met = by_unit(units.join(drawn, "rep")).select("rep", *_PLACE, "signature")
    close = written(met.mapInArrow(_survivors(least), _UNIT), f"{name}-survivors")
    whole = by_unit(close.join(drawn, "rep").join(sets, "rep")).select("rep", *_PLACE, "signature", "grams")
    return written(whole.mapInArrow(_confirmed(least, similarity), "u long, v long"), f"{name}-links")


def _star_units(members: DataFrame) -> DataFrame:
    """Every set with the head of each of its buckets, a head's sets dealt to units of about BLOCK."""
    degree = members.groupBy("rep").agg(F.sum("n").alias("degree"))
    head = F.max_by("rep", F.struct("degree", -F.col("rep"))).alias("head")
    heads = members.join(degree, "rep").groupBy("key").agg(head, F.max("n").alias("n"))
    pairs = lookup(members.select("key", "rep"), written(heads, "heads"), "key", "n", max(1, members.count()))
    pairs = written(pairs.filter("rep != head").select("rep", F.col("head").alias("unit")).distinct(), "head-pairs")
    counts = pairs.groupBy("unit").agg(F.count(F.lit(1)).alias("size"))
    counts = written(counts.withColumn("units", F.ceil(F.col("size") / BLOCK).cast("int")), "head-sizes")
    dealt = lookup(pairs, counts, "unit", "size", max(1, pairs.count()))
    own = F.pmod(F.xxhash64("rep", F.lit(13)), F.col("units")).cast("int")
    mine = dealt.select("rep", "unit", F.lit(-1).alias("band"), (2 * own).alias("i"), (2 * own + 1).alias("j"), (2 * own + 1).alias("block"), F.col("rep").alias("part"))
    theirs = counts.select(F.col("unit").alias("rep"), "unit", F.explode(F.sequence(F.lit(0), 2 * F.col("units") - 2, F.lit(2))).alias("i"))
    theirs = theirs.select("rep", "unit", F.lit(-1).alias("band"), "i", (F.col("i") + 1).alias("j"), F.col("i").alias("block"), F.col("rep").alias("part"))
    return mine.unionByName(theirs)


def _open_units(members: DataFrame, joined: DataFrame) -> DataFrame:
    """Buckets with several components: those outside the largest one meet each other and it, block by block."""
    parts = members.join(joined.withColumnRenamed("u", "rep"), "rep", "left")
    parts = written(parts.select("key", "band", "rep", F.coalesce("root", "rep").alias("part")), "bucket-parts")
    each = parts.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    open_ = each.groupBy("key").agg(F.sum("n").alias("size"), F.max(F.struct("n", "part")).alias("most")).filter("size > most.n")
    rows = lookup(parts, written(open_, "open-buckets"), "key", "size", max(1, parts.count()))
    large, largest = F.col("size") > SMALL, F.col("part") == F.col("most.part")
    rest = F.when(large, F.ceil((F.col("size") - F.col("most.n")) / BLOCK)).otherwise(1).cast("int")
    main = F.when(large, F.ceil(F.col("most.n") / BLOCK)).otherwise(0).cast("int")
    rows = rows.select("key", "band", "rep", "part", largest.alias("largest"), rest.alias("rest"), main.alias("main"))
    spread = F.xxhash64("rep", F.lit(17))
    inside = F.col("largest") & (F.col("main") > 0)
    block = F.when(inside, F.col("rest") + F.pmod(spread, F.greatest("main", F.lit(1)))).otherwise(F.pmod(spread, F.col("rest"))).cast("int")
    others = F.when(inside, F.col("rest")).otherwise(F.col("rest") + F.col("main"))
    rows = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), others - 1)))
    return rows.select("rep", F.col("key").alias("unit"), "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "part")


def near_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", ngram: int = NGRAM, similarity: Fraction = SIMILARITY, miss: float = MISS
) -> DataFrame:
    """One row per row of `docs`: key, n_shingles, component_id, kept.

    Words are what ASCII white space separates, with A to Z in lower case; a text's set are its
    distinct n-grams of words, of fewer words all of them as one. Sets with the similarity or more
    are linked, as are equal ones; component_id is the least key that links reach. Null texts and
    those without words have no n-grams and are linked with nothing. kept says that a row's key is
    its component's: repeated keys are all kept, null keys only where no other is in the
    component. Rows are told apart by their place, so `docs` must be a scan or another frame
    whose partitions are the same when computed again. An empty table gives no rows.

    Sets are compared as 64-bit hashes of their n-grams. Links below the threshold are never
    made; one at it is lost with a chance of about 1e-6 by the bands, and `miss` by each batch.
    """
    least = least_matches(float(similarity), miss)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = docs.schema[key].dataType
    out = rows.select("row", "key").schema.add("n", "long").add("digest", "binary").add("signature", "binary")
    arrow = pa.schema([("row", pa.int64()), ("key", _arrow(kind)), ("n", pa.int64()), ("digest", pa.binary()), ("signature", pa.binary())])
    drawn = written(rows.mapInArrow(_drawn(ngram, arrow), out), "signatures")
    reps = drawn.filter("digest is not null").groupBy("digest").agg(
        F.min("row").alias("rep"), F.count(F.lit(1)).alias("size"), F.min("key").alias("key"), F.first("signature").alias("signature")
    )
    reps = written(reps, "sets")
    count = max(1, reps.count())
    bands = HASHES // BAND
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("signature", 2 * BAND * b + 1, 2 * BAND)) for b in range(bands)])
    keyed = reps.select("rep", F.posexplode(keys).alias("band", "key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = written(lookup(keyed, written(shared, "shared-buckets"), "key", "n", bands * count), "buckets")
    # The sets of those in buckets are made again from their texts: cheaper than to keep all.
    some = broadcast_checked(written(members.select("rep").distinct(), "in-buckets"))
    texts = rows.select(F.col("row").alias("rep"), "text").join(some, "rep", "left_semi")
    sets = written(texts.mapInArrow(_sets(ngram), "rep long, grams binary"), "grams")
    drawn_reps = written(reps.select("rep", "signature").join(some, "rep", "left_semi"), "drawn")
    links = _links(_star_units(members), drawn_reps, sets, least, similarity, "head")
    joined = written(components(links), "head-components")
    more = _links(_open_units(members, joined), drawn_reps, sets, least, similarity, "open")
    if not more.isEmpty():
        joined = components(joined.select("u", F.col("root").alias("v")).unionByName(more))
    stands = written(reps.join(joined.withColumnRenamed("u", "rep"), "rep", "left").select("digest", "size", "key", F.coalesce("root", "rep").alias("root")), "roots")
    classes = written(stands.groupBy("root").agg(F.min("key").alias("component_id"), F.count(F.lit(1)).alias("parts")), "classes")
    known = lookup(stands.select("digest", "size", "root"), classes, "root", "parts", count).select("digest", "size", "component_id")
    known = written(known, "components")
    full = drawn.filter("digest is not null").select("key", "n", "digest")
    both = lookup(full, known, "digest", "size", max(1, drawn.count())).select("key", "n", "component_id")
    both = both.unionByName(drawn.filter("digest is null").select("key", "n", F.col("key").alias("component_id")))
    return both.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
