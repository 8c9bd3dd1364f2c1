"""Token ids as Arrow stream files of equal-length sequences.

A shard is a file in Arrow's stream format whose record batches hold fixed-size lists: `ids`,
and a `mask` that is false behind the shard's last token. Every batch but the last has
the same number of sequences, so a memory-mapped file gives any sequence without copying or
reading others. A second file beside it lists the documents: key, offset, number of ids.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm.bpe import Encoder, Vocabulary, sent
from lakeops.llm.common import slices, strings, text_of
from lakeops.session import shuffle_partitions

LENGTH, BATCH = 2048, 64
MANIFEST = "part int, path string, documents string, n_tokens long, n_documents long"


class LibraryEncoder(Encoder):
    """Ids by the tokenizers library, which is asked once for each word while it is remembered.

    That holds for byte-level BPE that cuts text by the usual pattern; any other tokenizer
    is given each text whole.
    """

    def __init__(self, raw: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        self.library = Tokenizer.from_str(raw.decode())
        self.library.no_truncation()
        self.library.no_padding()
        file = json.loads(raw)
        cut, model = file.get("pre_tokenizer") or {}, file["model"]
        self.by_words = (
            file.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
            and not cut.get("add_prefix_space") and model["type"] == "BPE" and not model.get("dropout")
            and all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in file.get("added_tokens", []))
        )
        if self.by_words:
            super().__init__(Vocabulary(raw))
            # A word behind a blank begins with the blank's byte, and has no other.
            heads = self.v.bytes[np.minimum(self.v.starts, len(self.v.bytes) - 1)]
            self.blank_head = (heads == 0x20) & (self.v.counts > 0)

    def _encoded(self, chunks: list[str], prefix: str) -> tuple[np.ndarray, np.ndarray]:
        if prefix == " ":
            joined = self.library.encode_batch_fast([" " + " ".join(chunks)], add_special_tokens=False)
            ids = np.array(joined[0].ids, np.int32)
            begins = np.flatnonzero(self.blank_head[ids])
            if len(begins) == len(chunks):
                return ids, np.diff(begins, append=len(ids))
        found = [e.ids for e in self.library.encode_batch_fast([prefix + c for c in chunks], add_special_tokens=False)]
        return np.array([i for f in found for i in f], np.int32), np.fromiter(map(len, found), np.int64, len(found))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.by_words:
            return super().__call__(texts)
        found = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for f in found for i in f], np.int64), np.fromiter(map(len, found), np.int64, len(found))


_encoders: dict[int, LibraryEncoder] = {}


def _encoder(raw: bytes) -> LibraryEncoder:
    key = zlib.crc32(raw)
    if key not in _encoders:
        _encoders[key] = LibraryEncoder(raw)
    return _encoders[key]


class ShardWriter:
    """Writes one shard, a batch at a time."""

    def __init__(self, uri: str, length: int, batch: int, kind: pa.DataType):
        self.length, self.batch = length, batch
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.kind, self.waiting, self.n = kind, [], 0
        self.out, self.writer = _stream(uri, self.schema)

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.n += len(ids)
        full = self.length * self.batch
        if self.n >= full:
            rest = np.concatenate(self.waiting)
            while len(rest) >= full:
                self._write(rest[:full], full)
                rest = rest[full:]
            self.waiting, self.n = [rest], len(rest)

    def _write(self, ids: np.ndarray, size: int) -> None:
        values, mask = np.zeros(size, self.kind.to_pandas_dtype()), np.zeros(size, bool)
        values[: len(ids)], mask[: len(ids)] = ids, True
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (values, mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        if self.n:
            self._write(np.concatenate(self.waiting), -(-self.n // self.length) * self.length)
        self.writer.close()
        self.out.close()


def _stream(uri: str, schema: pa.Schema):
    files, path = pa.fs.FileSystem.from_uri(uri)
    files.create_dir(path.rsplit("/", 1)[0], recursive=True)
    out = files.open_output_stream(path)
    return out, pa.ipc.new_stream(out, schema)


class Shard:
    """Random access to the sequences of a shard. A local file is mapped, and nothing of it copied."""

    def __init__(self, uri: str):
        files, path = pa.fs.FileSystem.from_uri(uri)
        self.source = pa.memory_map(path) if isinstance(files, pa.fs.LocalFileSystem) else files.open_input_file(path)
        self.batches = list(pa.ipc.open_stream(self.source))
        self.size = self.batches[0].num_rows if self.batches else 1

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids and mask of sequence i, as views of the file."""
        batch, row = self.batches[i // self.size], i % self.size
        ids, mask = (batch.column(c)[row].values for c in (0, 1))
        return ids.to_numpy(zero_copy_only=True), mask

    def values(self, start: int, count: int) -> Iterator[np.ndarray]:
        """Views of the ids from a place in the shard on, a batch at a time."""
        if not self.batches:
            return
        whole = self.size * self.batches[0].schema.field("ids").type.list_size
        while count > 0:
            batch, at = divmod(start, whole)
            part = self.batches[batch].column(0).flatten().to_numpy(zero_copy_only=True)[at : at + count]
            yield part
            start, count = start + len(part), count - len(part)


def write_shards(
    docs: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text", end: int = 0, length: int = LENGTH, batch: int = BATCH
) -> DataFrame:
    """Write the ids of all texts, each with `end` behind it, in ascending order of the keys.

    Texts are dealt by ranges of (key, place of the row), so rows that share a key can
    be in several shards; null keys come last. `folder` must be a place that all executors
    reach and that Arrow can write to (a local or shared path, hdfs, s3 or gs). A task that runs
    again writes files with other names: the manifest, committed by Spark, lists those of
    the attempts that count. Null and empty texts have the end id alone; no rows give no
    shards. Returns the manifest, in order of `part`.
    """
    spark = docs.sparkSession
    raw = sent(docs, path)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.monotonically_increasing_id().alias("row"), text_of(text).alias("text"))
    order = [F.col("key").isNull(), F.col("key"), F.col("row")]
    dealt = rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, total, count = _encoder(raw.value), None, 0, 0
        part = TaskContext.get().partitionId()
        name = f"{folder.rstrip('/')}/shard-{part:06d}-{uuid.uuid4().hex}"
        schema = pa.schema([("key", pa.int64()), ("offset", pa.int64()), ("n", pa.int64())])
        for some in slices(batches, "text"):
            if shard is None:
                size = encoder.library.get_vocab_size(with_added_tokens=True)
                shard = ShardWriter(f"{name}.arrow", length, batch, pa.uint16() if max(size, end + 1) <= 1 << 16 else pa.uint32())
                out, index = _stream(f"{name}-documents.arrow", schema)
            flat, counts = encoder(strings(some.column(1)))
            ids = np.insert(flat, np.cumsum(counts), end)
            counts = counts + 1
            shard.add(ids)
            index.write_batch(pa.RecordBatch.from_arrays([some.column(0), pa.array(total + np.cumsum(counts) - counts), pa.array(counts)], schema=schema))
            total, count = total + len(ids), count + len(counts)
        if shard is not None:
            shard.close()
            index.close()
            out.close()
            row = [part, f"{name}.arrow", f"{name}-documents.arrow", total, count]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
                ["part", "path", "documents", "n_tokens", "n_documents"],
            )

    dealt.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shard, with `start`: the ids of all shards before it."""
    shards = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_documents(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """Of every document in the shards: key, start (ids of all documents before it), n_tokens, and
    ids_crc32 of its ids as little-endian 32-bit numbers."""
    shards = manifest(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            shard = Shard(row["path"])
            files, path = pa.fs.FileSystem.from_uri(row["documents"])
            with files.open_input_stream(path) as source:
                for some in pa.ipc.open_stream(source):
                    offsets, counts = some.column(1).to_numpy(), some.column(2).to_numpy()
                    crc = []
                    for at, n in zip(offsets.tolist(), counts.tolist()):
                        now = 0
                        for part in shard.values(at, n):
                            now = zlib.crc32(part.astype("<u4").tobytes(), now)
                        crc.append(now)
                    yield pa.RecordBatch.from_arrays(
                        [some.column(0), pa.array(offsets + row["start"]), some.column(2), pa.array(crc, pa.int64())],
                        ["key", "start", "n_tokens", "ids_crc32"],
                    )

    dealt = shards.repartition(max(1, shards.count()), "part")
    return dealt.mapInArrow(run, "key long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("key", key)
