import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakeops.llm.bpe import Encoder, Vocabulary, decode_all, decoded, encoded, encoded_and_decoded, merge_all
from lakeops.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.cases import CLASHING, TEXTS, edge, empty

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as f:
        return Vocabulary(f.read())


def split(flat, counts):
    return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]


TRICKY = [
    "", " ", "\n", " a", "a ", "a  b", "a\tb\n\n c", "it's I'LL we're", "x<|endoftext|>y <|endoftext|>\n", "a" * 3000, "ab" * 2000 + "c",
    "\x1c a\x1d b \x85 c d　e", "a\r\nb\r\n", "f\n\xa0g", "​z 日本語 🙂🙂 ١٢٣ 12ab", " \n a\n", "'s 'sup '",
]


def test_ids_and_texts_are_those_of_the_library(library, vocabulary):
    rng = random.Random(3)
    alphabet = [*"abcdeh ABC 123 .,!'\n\t\xa0  éüñß日🙂  ", "'s", "'ll", "<|endoftext|>"]
    texts = TRICKY + ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(1500)]
    flat, counts = Encoder(vocabulary)(texts)
    found = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert split(flat, counts) == found
    assert decode_all(vocabulary, flat, counts).to_pylist() == [library.decode(i, skip_special_tokens=False) for i in found]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(library, vocabulary, texts):
    flat, counts = Encoder(vocabulary)(texts)
    assert (split(flat, counts) if texts else []) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_forgetting_changes_nothing(library, vocabulary):
    encoder, rng = Encoder(vocabulary, most=20), random.Random(4)
    for _ in range(10):
        texts = [" ".join(rng.choices(["low", "lower", "newest", "widest"], k=5)) + str(rng.random()) for _ in range(20)]
        assert split(*encoder(texts)) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_the_root_gives_the_leftmost_lowest_rank(vocabulary):
    """Against merging by the definition, one pair at a time."""
    rng = random.Random(5)
    pieces = [bytes(rng.choices(b"abehinrt o", k=rng.randint(1, 40))) for _ in range(300)]
    flat, counts = merge_all(vocabulary, pieces)
    for piece, ids in zip(pieces, split(flat, counts)):
        own = [int(vocabulary.of_byte[b]) for b in piece]
        while len(own) > 1:
            ranks = vocabulary.pairs(np.array(own[:-1]), np.array(own[1:]))
            if (ranks < 0).all():
                break
            i = int(np.where(ranks < 0, 1 << 40, ranks).argmin())
            own[i : i + 2] = [int(vocabulary.merged[ranks[i]])]
        assert ids == own


def test_ids_that_make_no_text(library, vocabulary):
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 50257, (200, 12))
    got = decode_all(vocabulary, ids.ravel(), np.full(200, 12))
    assert (got.to_pylist() if hasattr(got, "to_pylist") else got) == [library.decode(r.tolist(), skip_special_tokens=False) for r in ids]


def test_frame_with_edge_cases(spark, library):
    docs = edge(spark)
    out = encoded_and_decoded(docs, PATH).collect()
    assert len(out) == len(TEXTS)
    for r in out:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)
    assert set(CLASHING) <= set(out[0].asDict())
    assert encoded_and_decoded(empty(spark), PATH).collect() == []


def test_decoding_lists(spark, library):
    frame = spark.createDataFrame([([15496, 995], 1), ([], 2), (None, 3), ([50256, 99999], 4), ([15496, None], 5)], "ids array<int>, i int")
    got = {r.i: r.decoded for r in decoded(frame, PATH).collect()}
    assert got == {1: "Hello world", 2: "", 3: None, 4: "<|endoftext|>", 5: "Hello"}
    docs = edge(spark, clashing=False)
    assert {(r.text or "", r.decoded) for r in decoded(encoded(docs, PATH), PATH).collect()} == {(t or "", t or "") for _, t in TEXTS}


def test_query_on_the_whole_table(spark, library):
    got = {r.doc_id: r for r in QUERIES["op5_bpe_encode_decode"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        assert (got[d.doc_id].n_tokens, got[d.doc_id].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_new_words_do_not_copy_the_known_ones(vocabulary):
    """Their ids are kept with room for more: an array is copied each time its length doubles, not for every slice of text."""
    encoder, pools = Encoder(vocabulary), []
    for i in range(60):
        encoder([f"new{i} word{i}x {i}th"])
        pools.append((encoder.pool, encoder.starts, encoder.counts))
    for kept in zip(*pools):
        assert sum(not np.shares_memory(a, b) for a, b in zip(kept, kept[1:])) <= 8
    assert all(np.array_equal(now[: len(then)], then) for then, now in zip(pools[0], pools[-1]))


def test_every_kind_of_white_space(library, vocabulary):
    blanks = [c for c in map(chr, range(1 << 16)) if c.isspace()]
    texts = [t for c in blanks for t in (f"ab{c}cd ef", f"ab cd{c}", f"{c}ab cd", f"ab{c}{c}cd\nef", f"ab {c}cd", f"a\n{c}b c", f"é {c} ü")]
    assert split(*Encoder(vocabulary)(texts)) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_equal_pieces_of_a_slice_are_looked_up_once(library, vocabulary):
    class Counted(dict):
        asked = 0

        def get(self, *args):
            Counted.asked += 1
            return super().get(*args)

    encoder, texts = Encoder(vocabulary), ["low lower\nlow  newest, low"] * 500 + ["low lower"]
    encoder.known = Counted()
    found = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        assert split(*encoder(texts)) == found
    # "low", " lower", "\n", " ", " newest", ",", " low"
    assert Counted.asked == 2 * 7


def test_white_space_and_special_tokens_anywhere(library, vocabulary):
    rng = random.Random(6)
    alphabet = [*"abc \n\t\r\x1c\x85\xa0    　​.é日🙂", "'s", "  ", "\n\n", " word", "...", "<|endoftext|>"]
    encoder = Encoder(vocabulary, most=200)
    for _ in range(10):
        texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(150)]
        assert split(*encoder(texts)) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
