import hashlib

from lakeops.llm.digest_index import DigestIndex, first_copies, judged
from tests.conftest import plan
from tests.llm.cases import TEXTS, edge, empty, unchanged


def digest(text):
    return hashlib.sha256("".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r").encode()).hexdigest()


def test_edge_cases(spark, folder):
    docs = edge(spark)
    got = judged(docs, DigestIndex(spark, folder("index"), 4), "a").collect()
    assert len(got) == len(TEXTS)
    groups = {}
    for i, t in TEXTS:
        groups.setdefault(digest(t), []).append((-len(t or ""), i is None, i))
    by = {}
    for r in got:
        by.setdefault(r.text_sha256, []).append(r)
    assert by.keys() == groups.keys()
    for h, rows in by.items():
        best = min(groups[h], key=lambda x: (x[0], x[1], x[2] or 0))
        assert [r.kept for r in rows].count(True) == 1
        assert {(r.keep_id, r.group_size) for r in rows} == {(best[2], len(groups[h]))}
        assert next(r.doc_id for r in rows if r.kept) == best[2]
    kept = first_copies(docs, DigestIndex(spark, folder("index"), 4), "a")
    unchanged(kept, docs)
    assert kept.count() == len(groups)


def test_empty_table(spark, folder):
    index = DigestIndex(spark, folder("index"), 4)
    assert judged(empty(spark), index, "a").collect() == []
    assert index.read().count() == 0


def test_batches_replay_and_reopening(spark, folder):
    path = folder("index")
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    first, second = frame([(1, "a b"), (2, "ab"), (3, "c")]), frame([(4, "c "), (5, "d"), (6, "d")])
    index = DigestIndex(spark, path, 4)
    assert {(r.doc_id, r.keep_id, r.kept) for r in judged(first, index, "one").collect()} == {(1, 1, True), (2, 1, False), (3, 3, True)}
    expected = {(4, 3, 2, False), (5, 5, 2, True), (6, 5, 2, False)}
    show = lambda i: {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in judged(second, i, "two").collect()}
    assert show(index) == expected
    index.close()
    # Another session's handle, with another bucket count in mind: the index keeps its own.
    again = DigestIndex(spark, path, 16)
    assert again.buckets == 4 and again.read().count() == 3
    # The batch runs again: the same answers, nothing added.
    assert show(again) == expected and again.read().count() == 3
    again.close()


def test_the_index_is_not_shuffled(spark, folder):
    index = DigestIndex(spark, folder("index"), 4)
    judged(spark.createDataFrame([(1, "a")], "doc_id long, text string"), index, "one")
    new = spark.createDataFrame([("x", 1, 1)], "digest string, keep_id long, group_size long")
    text = plan(index.fresh(new, "two"))
    assert text.count("Exchange") <= 2 * 1 and "SortMergeJoin LeftAnti" in text  # named in the tree and in the details


def test_a_hot_text(spark, folder):
    docs = spark.range(3000).selectExpr("id doc_id", "CASE WHEN id % 3 = 0 THEN 'same text' ELSE concat('t', id) END text")
    got = judged(docs, DigestIndex(spark, folder("index"), 4), "a")
    assert got.filter("kept").count() == 2001 and got.filter("keep_id = 0 AND group_size = 1000").count() == 1000
