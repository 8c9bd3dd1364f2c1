"""What several operators share: lineage cut by written tables, joins that survive hot keys, words as numbers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.session import scratch_path, shuffle_partitions

#: Bytes of text that a kernel takes at a time.
SLICE_BYTES = 4 << 20


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, and again by nobody."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def without(df: DataFrame, *names: str) -> DataFrame:
    """The frame without columns of these names in any case: a result of the same name replaces them."""
    gone = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def free_name(df: DataFrame, name: str) -> str:
    """The name, or the first one with underscores in front that no column has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def lookup(rows: DataFrame, unique: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of rows to one row per key, where one key may hold most rows.

    `unique` has in `size` how many of the `total` rows each key holds. Keys with more than a
    task's mean share are fewer than there are tasks, so those go by broadcast; the rest
    are shuffled, and none of them fills a task.
    """
    most = max(1.0, total / shuffle_partitions(rows.sparkSession))
    hot = F.broadcast(unique.filter(F.col(size) > most))
    cool = rows.join(hot.select(key), key, "left_anti").hint("merge")
    return rows.join(hot, key).unionByName(cool.join(unique.filter(F.col(size) <= most), key))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (xor-shift and multiply)."""
    with np.errstate(over="ignore"):
        for _ in range(2):
            x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(texts: list[str], k: int, ascii_only: bool = False) -> list[np.ndarray]:
    """Of each text in lower case (or with A to Z only in it) the sorted distinct hashes of its
    runs of k words; of fewer words, of all together."""
    words, counts = word_hashes(texts if ascii_only else [t.lower() for t in texts], ascii_only)
    ends = np.cumsum(counts)
    out = []
    if len(words) >= k:
        whole = _run_hashes(words, k)
    for end, n in zip(ends.tolist(), counts.tolist()):
        if n >= k:
            out.append(np.unique(whole[end - n : end - k + 1]))
        else:
            out.append(_run_hashes(words[end - n : end], n) if n else np.empty(0, np.uint64))
    return out


def _run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    n = len(words) - k + 1
    out = np.full(n, np.uint64(k))
    with np.errstate(over="ignore"):
        for i in range(k):
            out = mixed(out * np.uint64(_STEP) + words[i : i + n])
    return out


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that `column` has about `most` bytes in each; a longer row stands alone."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        if batch.num_rows == 0:
            continue
        sizes = np.frombuffer(pc.binary_length(values).fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False), np.int64)
        group = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def strings(values: pa.Array) -> list[str]:
    return [v or "" for v in values.to_pylist()]


def list_array(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from all its values in order and the number of them in each row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def gather(pool: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """pool[start : start + count] for each pair, one after the other."""
    total = int(counts.sum())
    if total == 0:
        return pool[:0]
    before = np.cumsum(counts) - counts
    return pool[np.repeat(starts - before, counts) + np.arange(total)]


def intersections(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs of sets (a, b): a set's tokens are marked, and
    counted in all the sets that it is paired with."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    tokens, flat = np.unique(np.concatenate(sets), return_inverse=True) if sets else (np.empty(0), np.empty(0, np.int64))
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(len(a), np.int64)
    marked = np.zeros(len(tokens), bool)
    order = np.argsort(a, kind="stable")
    cuts = np.flatnonzero(np.diff(a[order])) + 1
    for rows in np.split(order, cuts) if len(order) else []:
        own = flat[starts[a[rows[0]]] :][: sizes[a[rows[0]]]]
        marked[own] = True
        others = b[rows]
        found = np.concatenate([[0], np.cumsum(marked[gather(flat, starts[others], sizes[others])])])
        upto = np.cumsum(sizes[others])
        out[rows] = found[upto] - found[upto - sizes[others]]
        marked[own] = False
    return out


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    numbers = rng.integers(1, 1 << 63, 256, np.uint64)
    blank = np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    return numbers, blank


_BYTES, _BLANK = _byte_tables()
_STEP = 0x9E3779B97F4A7C15


def running(values: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and factors by which any run of the values has a polynomial hash: `run_hash`."""
    with np.errstate(over="ignore"):
        powers = np.full(len(values) + 1, np.uint64(step))
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[:-1], dtype=np.uint64)])
        back = np.full(len(values) + 1, np.uint64(pow(step, -1, 1 << 64)))
        back[0] = 1
        return sums, np.cumprod(back, dtype=np.uint64)


def run_hash(sums: np.ndarray, back: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of texts: what ASCII white space separates.

    data: bytes of all texts, a newline before each and behind the last; begins: of the
    texts in it; starts, ends: of the words; counts: words in each text; hashes: 64 bits
    each, a polynomial of the word's bytes by running sums, so no word is looked at by itself.
    """

    def __init__(self, texts: list[str], ascii_lower: bool = False):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        if ascii_lower:
            raw = [t.lower() for t in raw]
        self.data = np.frombuffer(b"\n".join([b"", *raw, b""]), np.uint8)
        blank = _BLANK[self.data]
        self.starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        self.ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        self.hashes = run_hash(*running(_BYTES[self.data], _STEP), self.starts, self.ends)
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
        self.begins = 1 + np.cumsum(sizes) - sizes
        self.counts = np.diff(np.searchsorted(self.starts, np.append(self.begins, len(self.data) + 1)))


def word_hashes(texts: list[str], ascii_lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and the number of words in each."""
    words = Words(texts, ascii_lower)
    return words.hashes, words.counts
