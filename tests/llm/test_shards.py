import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakeops.llm.arrow_shards import LibraryEncoder, Shard, ShardWriter, manifest, read_documents, write_shards
from lakeops.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.cases import TEXTS, edge, empty
from tests.llm.test_bpe import TRICKY

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, rows):
    at, out = 0, []
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_word_by_word_is_the_whole_text(library):
    with open(PATH, "rb") as f:
        flat, counts = LibraryEncoder(f.read())(TRICKY * 2)
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [e.ids for e in library.encode_batch(TRICKY * 2, add_special_tokens=False)]


def test_another_kind_of_tokenizer_is_given_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, "rb") as f:
        encoder = LibraryEncoder(f.read())
    texts = ["Hello there", "", "a  b\nc"]
    flat, counts = encoder(texts)
    assert not encoder.by_words
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def test_query_on_the_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").sort("doc_id").collect()
    assert sorted(tuple(r) for r in QUERIES["op7_arrow_sequences"](spark, SF).collect()) == expected(library, docs)


def test_edge_cases(spark, library, folder):
    path = folder("shards")
    write_shards(edge(spark), path, PATH, length=16, batch=4)
    rows = sorted(((i, n, t) for n, (i, t) in enumerate(TEXTS)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    got = sorted((tuple(r) for r in read_documents(spark, path).collect()), key=lambda r: r[1])
    assert got == expected(library, [(i, t) for i, _, t in rows])
    none = folder("shards")
    assert write_shards(empty(spark), none, PATH).count() == 0 and read_documents(spark, none).count() == 0


def test_random_access_without_copies(tmp_path):
    import pyarrow as pa

    ids = np.arange(1, 1000, dtype=np.uint16)
    writer = ShardWriter(str(tmp_path / "s.arrow"), 16, 4, pa.uint16())
    for part in np.array_split(ids, 7):
        writer.add(part)
    writer.close()
    shard = Shard(str(tmp_path / "s.arrow"))
    assert len(shard) == 63 and [b.num_rows for b in shard.batches] == [4] * 15 + [3]
    for i in (0, 5, 40, 62, 17):
        values, mask = shard[i]
        n = min(16, len(ids) - 16 * i)
        assert values[:n].tolist() == ids[16 * i : 16 * i + n].tolist() and mask.to_pylist() == [True] * n + [False] * (16 - n)
    mapped = shard.source.read_buffer()
    assert mapped.address <= shard[40][0].ctypes.data < mapped.address + mapped.size or not shard[40][0].flags.owndata
    assert np.concatenate(list(shard.values(100, 500))).tolist() == ids[100:600].tolist()


def test_files_of_attempts_that_do_not_count_are_not_read(spark, folder):
    path = folder("shards")
    frame = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string").coalesce(1)
    write_shards(frame, path, PATH)
    stray = ShardWriter(f"{path}/shard-000000-stray.arrow", 16, 4, __import__("pyarrow").uint16())
    stray.add(np.arange(50, dtype=np.uint16))
    stray.close()
    assert read_documents(spark, path).count() == 2
    assert manifest(spark, path).agg({"n_documents": "sum"}).first()[0] == 2
