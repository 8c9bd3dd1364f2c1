"""Byte-level BPE: encoding over a segment tree of pair ranks, and decoding.

The vocabulary file is read on the driver and sent to the executors whole; its size is that
of the file (`VOCABULARY_BYTES` at most).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import gather, list_array, slices, strings, without

VOCABULARY_BYTES = 64 << 20

# Fixed value: the pattern that cuts text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: Signs that the pattern never parts from each other.
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

#: White space but for the blank and the newline.
OTHER_SPACE = [c for c in map(chr, range(1 << 16)) if c.isspace() and c not in " \n"]


def _utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _marked(codes: list[int]) -> np.ndarray:
    return np.isin(np.arange(256), codes)


#: Bytes that are white space, and by their number of bytes the first bytes and the codes of wider white space.
SPACE_BYTES = _marked([*b" \n", *(ord(c) for c in OTHER_SPACE if ord(c) < 128)])
WIDE_SPACE = {
    n: (_marked([c[0] for c in some]), np.array([int.from_bytes(c, "big") for c in some], np.int64))
    for n in (2, 3)
    if (some := [c for c in map(_utf8, OTHER_SPACE) if len(c) == n])
}


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: printable bytes stand for
    themselves, the others follow from 256 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class PairRanks:
    """Open-addressed table from a pair of token ids to its merge rank."""

    def __init__(self, left: np.ndarray, right: np.ndarray, size: int):
        self.size = size
        self.bits = max(4, int(len(left) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, -1, np.int64)
        keys, ranks = left.astype(np.int64) * size + right, np.arange(len(left), dtype=np.int64)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == -1
            first = np.unique(np.where(free, slots, -1 - np.arange(len(slots))), return_index=True)[1]
            put = first[free[first]]
            self.keys[slots[put]], self.ranks[slots[put]] = keys[put], ranks[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, ranks, slots = keys[rest], ranks[rest], (slots[rest] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, -1 for those that do not merge."""
        keys = left.astype(np.int64) * self.size + right
        slots = self._slots(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.ranks[slots], -1)
        todo = np.flatnonzero((found != keys) & (found != -1))
        while len(todo):
            at = (slots[todo] + 1) & (len(self.keys) - 1)
            slots[todo] = at
            found = self.keys[at]
            hit = found == keys[todo]
            out[todo[hit]] = self.ranks[at[hit]]
            todo = todo[~hit & (found != -1)]
        return out


class Vocabulary:
    """Merges and tokens of a byte-level BPE file."""

    def __init__(self, raw: bytes):
        file = json.loads(raw)
        letters, vocab = byte_letters(), file["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        token = [b""] * size
        for text, i in vocab.items():
            token[i] = bytes(letters[c] for c in text)
        for text, i in self.special.items():
            token[i] = text.encode()
        self.size = size
        self.of_byte = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.of_byte[b] = vocab[letter]
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.pairs = PairRanks(np.array([vocab[a] for a, _ in merges], np.int64), np.array([vocab[b] for _, b in merges], np.int64), size)
        self.counts = np.array([len(t) for t in token], np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.bytes = np.frombuffer(b"".join(token), np.uint8)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None


def merge_all(vocabulary: Vocabulary, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of each piece, one after the other, and their number in each piece."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    classes = np.maximum(1, lengths - 1)
    classes = 1 << np.ceil(np.log2(classes)).astype(np.int64)
    flat = vocabulary.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
    starts = np.cumsum(lengths) - lengths
    counts = np.zeros(len(pieces), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for size in np.unique(classes).tolist():
        own = np.flatnonzero(classes == size)
        step = max(1, (1 << 19) // size)
        for i in range(0, len(own), step):
            some = own[i : i + step]
            ids, n = _merge_block(vocabulary, flat, starts[some], lengths[some], size)
            counts[some] = n
            parts.append((some, ids))
    to = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.int32)
    for some, ids in parts:
        n = counts[some]
        before = np.cumsum(n) - n
        out[np.repeat(to[some] - before, n) + np.arange(len(ids))] = ids
    return out, counts


def _merge_block(v: Vocabulary, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, size: int):
    """Merge pieces of up to size + 1 bytes side by side, each in a segment tree of its own.

    Leaf i holds rank * size + i of the pair that begins with symbol i, or the largest number, and a node
    the smaller of its two children: so the root is the lowest rank, leftmost first. A
    merge changes three leaves, each with the path above it.
    """
    rows, width = len(starts), size + 2
    kind = np.int32 if size <= 1 << 13 else np.int64
    none = np.iinfo(kind).max
    at = np.arange(width, dtype=kind)
    inside = at < lengths[:, None]
    symbols = np.where(inside, flat[np.minimum(starts[:, None] + at, len(flat) - 1)] if len(flat) else 0, -1).astype(kind)
    following = np.broadcast_to(at + 1, (rows, width)).copy()
    before = np.broadcast_to(at - 1, (rows, width)).copy()
    paired = (at[:size] + 1) < lengths[:, None]
    tree = np.full((rows, 2 * size), none, kind)
    ranks = np.full((rows, size), -1, kind)
    ranks[paired] = v.pairs(symbols[:, :size][paired], symbols[:, 1 : size + 1][paired])
    tree[:, size:] = np.where(ranks >= 0, ranks * size + at[:size], none)
    level = size
    while level > 1:
        half = level >> 1
        tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level = half
    symbols, following, before, tree = symbols.ravel(), following.ravel(), before.ravel(), tree.ravel()
    base, root = np.arange(rows) * width, np.arange(rows) * 2 * size

    def put(trees: np.ndarray, leaves: np.ndarray, values: np.ndarray | int) -> None:
        node = leaves + size
        tree[trees + node] = values
        node >>= 1
        while size > 1 and node[0]:
            tree[trees + node] = np.minimum(tree[trees + 2 * node], tree[trees + 2 * node + 1])
            node >>= 1

    def leaf(left: np.ndarray, right: np.ndarray, position: np.ndarray) -> np.ndarray:
        rank = v.pairs(left, right)
        return np.where(rank >= 0, rank * size + position, none)

    active = np.arange(rows)
    while True:
        top = tree[root[active] + 1]
        more = top < none
        active, top = active[more], top[more]
        if len(active) == 0:
            break
        r, b, length = root[active], base[active], lengths[active]
        i = top % size
        j = following[b + i]
        k = following[b + j]
        new = v.merged[top // size]
        symbols[b + i], symbols[b + j] = new, -1
        following[b + i] = k
        last = k >= length
        before[b + np.minimum(k, width - 1)] = i
        after = symbols[b + np.minimum(k, width - 1)]
        put(r, i, np.where(last, none, leaf(new, np.maximum(after, 0), i)))
        inner = j < size
        if inner.any():
            put(r[inner], j[inner], none)
        p = before[b + i]
        some = p >= 0
        if some.any():
            q = p[some]
            put(r[some], q, leaf(symbols[b[some] + q], new[some], q))
    symbols = symbols.reshape(rows, width)
    alive = symbols >= 0
    return symbols[alive], alive.sum(1)


def appended(values: np.ndarray, more: np.ndarray) -> np.ndarray:
    """The values with more behind them, as the head of an array with room for as many again: it is
    copied when that is full. Only the longest such head may be appended to."""
    room, n = values if values.base is None else values.base, len(values) + len(more)
    if n > len(room):
        room = np.empty(2 * n, values.dtype)
        room[: len(values)] = values
    room[len(values) : n] = more
    return room[:n]


def spaces(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 are white space or part of it."""
    out = SPACE_BYTES[data]
    for n, (leads, codes) in WIDE_SPACE.items():
        at = np.flatnonzero(leads[data[: max(0, len(data) - n + 1)]])
        code = sum(data[at + i].astype(np.int64) << 8 * (n - 1 - i) for i in range(n))
        at = at[np.isin(code, codes)]
        for i in range(n):
            out[at + i] = True
    return out


class Encoder:
    """Encodes texts; remembers the ids of the words it has met. With more than `most` it
    forgets those that came only once since it last did so.

    A blank or newline behind anything but white space always begins a new piece, so what lies
    between two of them can be encoded alone. Where it has other white space, the pattern
    itself cuts it. Equal pieces of the texts are looked up once for all of them.
    """

    def __init__(self, vocabulary: Vocabulary, most: int = 500_000):
        self.v, self.most = vocabulary, most
        self.pattern = regex.compile(PATTERN)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}  # pieces, with the blank before them
        self.starts, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool = np.empty(0, np.int32)
        self.hits = np.empty(0, np.int64)

    def _thin(self) -> None:
        keep = self.hits > 1
        if keep.sum() > self.most // 2:
            self._forget()
            return
        number, kept = (np.cumsum(keep) - 1).tolist(), keep.tolist()
        self.known = {w: number[i] for w, i in self.known.items() if kept[i]}
        self.pool = gather(self.pool, self.starts[keep], self.counts[keep])
        self.counts = self.counts[keep]
        self.starts = np.cumsum(self.counts) - self.counts
        self.hits = np.zeros(len(self.counts), np.int64)

    def _encoded(self, chunks: list[str], prefix: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks behind the prefix, and the number of them in each."""
        whole = [self.pattern.findall(prefix + c) if not c.isalpha() else (prefix + c,) for c in chunks]
        per = np.fromiter(map(len, whole), np.int64, len(whole))
        ids, n = merge_all(self.v, [_utf8(p) for w in whole for p in w])
        return ids, np.diff(np.concatenate([[0], np.cumsum(n)])[np.cumsum(per)], prepend=0)

    def _learn(self, keys: list[bytes]) -> None:
        """New pieces. Of words behind blanks, letters with signs behind them are the letters' ids, then the signs'."""
        words: dict[str, bytes] = {}  # words behind blanks
        others: dict[str, bytes] = {}
        whole, parts = [], []
        for key in keys:
            text = key.decode("utf-8", "surrogatepass")
            word = text[1:]
            if text[0] != " ":
                others[text] = key
            elif word.isalpha():
                words[word] = key
            elif text.split() != [word]:
                others[text] = key
            elif len(core := word.rstrip(SIGNS)) == len(word) or not core.isalpha():
                words[word] = key
            else:
                tail = word[len(core) :]
                two = key[: len(key) - len(tail)], key[len(key) - len(tail) :]  # a sign is one byte
                whole.append(key)
                parts += two
                for known, chunk, part in ((words, core, two[0]), (others, tail, two[1])):
                    if part not in self.known:
                        known[chunk] = part
        for known, prefix in ((words, " "), (others, "")):
            if known:
                self._put(list(known.values()), *self._encoded(list(known), prefix))
        if whole:
            numbers = np.array([self.known[p] for p in parts], np.int64)
            counts = self.counts[numbers]
            self._put(whole, gather(self.pool, self.starts[numbers], counts), counts.reshape(-1, 2).sum(1))

    def _put(self, keys: list[bytes], ids: np.ndarray, counts: np.ndarray) -> None:
        self.known.update(zip(keys, range(len(self.counts), len(self.counts) + len(keys))))
        self.starts = appended(self.starts, len(self.pool) + np.cumsum(counts) - counts)
        self.counts = appended(self.counts, counts)
        self.hits = appended(self.hits, np.zeros(len(keys), np.int64))
        self.pool = appended(self.pool, ids)

    def _cuts(self, data: bytes, places: np.ndarray) -> np.ndarray:
        """Where pieces begin, of texts that lie one behind the other at these places, and where the last one ends."""
        codes = np.frombuffer(data, np.uint8)
        space = spaces(codes)
        gap = (codes == 0x20) | (codes == 0x0A)
        cut = np.zeros(len(codes) + 1, bool)
        cut[1:-1] = gap[1:] & ~space[:-1]
        cut[places] = True
        other = np.flatnonzero(space & ~(gap & cut[:-1]))
        # A newline is a piece of its own, but for other white space behind it.
        cut[1 + np.flatnonzero((codes[:-1] == 0x0A) & cut[:-2] & ~space[1:])] = True
        at = np.flatnonzero(cut)
        if len(other):
            run = np.unique(np.searchsorted(at, other, "right") - 1)
            for a, b in zip(at[run].tolist(), at[run + 1].tolist()):
                for piece in self.pattern.findall(data[a:b].decode("utf-8", "surrogatepass")):
                    cut[a] = True
                    a += len(_utf8(piece))
            at = np.flatnonzero(cut)
        return at

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and how many each has."""
        if len(self.counts) > self.most:
            self._thin()
        parts: list[bytes] = []
        ends, specials = [0], {}
        for text in texts:
            last = 0
            for m in self.v.cut.finditer(text) if self.v.cut else ():
                parts.append(_utf8(text[last : m.start()]))
                specials[len(parts)] = self.v.special[m[0]]
                last = m.end()
            parts.append(_utf8(text[last:]))
            ends.append(len(parts))
        places = np.zeros(len(parts) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)), out=places[1:])
        data = b"".join(parts)
        at = self._cuts(data, places)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)]).dictionary_encode()
        keys, which = pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), pieces.indices.to_numpy()
        index = np.fromiter(map(self.known.get, keys, repeat(-1)), np.int64, len(keys))
        if missing := np.flatnonzero(index < 0).tolist():
            new = [keys[i] for i in missing]
            self._learn(new)
            index[missing] = [self.known[k] for k in new]
        self.hits[index] += np.bincount(which, minlength=len(keys))
        index = index[which]
        counts = self.counts[index]
        ids = gather(self.pool, self.starts[index], counts)
        upto = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(at, places)]
        if specials:
            where = np.array(list(specials))
            ids = np.insert(ids, upto[where], list(specials.values()))
            upto += np.searchsorted(where, np.arange(len(upto)), "left")
        return ids, np.diff(upto[ends])


def decode_all(v: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[str] | pa.Array:
    """The text of each row's ids; bytes that are no UTF-8 become U+FFFD, ids without a token nothing."""
    ids = ids.astype(np.int64)
    known = (ids >= 0) & (ids < v.size)
    ids = np.where(known, ids, 0)
    sizes = np.where(known, v.counts[ids], 0)
    raw = gather(v.bytes, v.starts[ids], sizes)
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
    begin = ends[:-1][ends[:-1] < ends[1:]]
    data = raw.tobytes()
    if not ((raw[begin] & 0xC0) == 0x80).any():
        try:
            data.decode()
        except UnicodeDecodeError:
            pass
        else:
            return pa.StringArray.from_buffers(len(counts), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data))
    return pa.array([data[a:b].decode(errors="replace") for a, b in zip(ends[:-1], ends[1:])], pa.string())


_loaded: dict[str, tuple[Vocabulary, Encoder]] = {}


def loaded(raw: bytes) -> tuple[Vocabulary, Encoder]:
    """The vocabulary and encoder of this Python worker."""
    name = hashlib.sha256(raw).hexdigest()
    if name not in _loaded:
        vocabulary = Vocabulary(raw)
        _loaded[name] = vocabulary, Encoder(vocabulary)
    return _loaded[name]


def sent(df: DataFrame, path: str) -> Broadcast:
    """The vocabulary file for the executors."""
    with open(path, "rb") as file:
        raw = file.read(VOCABULARY_BYTES + 1)
    if len(raw) > VOCABULARY_BYTES:
        raise ValueError("a vocabulary file of this size is not broadcast")
    return df.sparkSession.sparkContext.broadcast(raw)


def _grown(df: DataFrame, **columns: str) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema] + [T.StructField(k, T._parse_datatype_string(v)) for k, v in columns.items()])


def _added(df: DataFrame, text: str, path: str, both: bool, ids: str, decoded: str) -> DataFrame:
    raw = sent(df, path)
    df = without(df, ids, *([decoded] if both else []))
    schema = _grown(df, **{ids: "array<int>"}, **({decoded: "string"} if both else {}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, encoder = loaded(raw.value)
        for batch in slices(batches, text):
            flat, counts = encoder(strings(batch.column(text)))
            columns = [*batch.columns, list_array(flat, counts, pa.int32())]
            if both:
                columns.append(decode_all(vocabulary, flat, counts))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(run, schema)


def encoded(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The frame with the token ids of each text, as the file's tokenizer gives them.

    Strings of special tokens become their ids, nothing is added. Null and empty texts have
    no ids (an empty list). A column named as the result is replaced.
    """
    return _added(df, text, path, False, ids, "")


def encoded_and_decoded(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """`encoded`, with the ids decoded again in the same pass."""
    return _added(df, text, path, True, ids, decoded)


def decoded(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The frame with the text of each list of ids; null ids give null, an empty list the empty text."""
    raw = sent(df, path)
    df = without(df, text)
    schema = _grown(df, **{text: "string"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, _ = loaded(raw.value)
        for batch in batches:
            column = batch.column(ids)
            counts = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
            flat = pc.list_flatten(column).fill_null(-1).to_numpy(zero_copy_only=False)
            texts = decode_all(vocabulary, flat, counts)
            texts = pc.if_else(column.is_valid(), texts, pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=schema.names)

    return df.mapInArrow(run, schema)


def ids_digest(ids: str = "ids") -> Column:
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), ",").cast("binary"), 256)
