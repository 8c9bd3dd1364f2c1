import zlib

import pytest

from lakeops.llm import langid
from lakeops.llm.queries import QUERIES
from tests.llm.cases import TEXTS, edge, empty, unchanged


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def languages(docs):
    return langid.learned(docs)


def test_held_out_accuracy(spark):
    out = QUERIES["op9_language_mixtures"](spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    assert len(out) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held) > 200


def test_proportions_of_a_mixture(spark, docs, languages):
    texts = {r.lang: r.text for r in docs.filter("n_chars > 3000").collect()}
    words = {k: t.split() for k, t in texts.items()}
    both = " ".join(words["fr"][:300] + words["de"][:100])
    row = langid.identified(spark.createDataFrame([(both,)], "text string"), languages).first()
    assert row.languages[:2] == ["fr", "de"] and row.lang_pred == "fr"
    assert row.shares[:2] == pytest.approx([0.75, 0.25], abs=0.12) and row.score == row.shares[0]
    one = langid.identified(spark.createDataFrame([(" ".join(words["es"][:200]),)], "text string"), languages).first()
    assert one.lang_pred == "es" and one.score > 0.9


def test_languages_do_not_depend_on_what_stands_beside_a_text(docs, languages):
    texts = [r.text for r in docs.limit(60).collect()]
    together = langid.mixtures(texts, languages)
    for t, row in zip(texts, together):
        assert langid.mixtures([t], languages)[0] == pytest.approx(row, abs=1e-4)


def test_edge_cases(spark, languages):
    docs = edge(spark)
    out = langid.identified(docs, languages).collect()
    assert len(out) == len(TEXTS)
    for r in out:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score, r.languages, r.shares) == ("und", 0.0, [], [])
        else:
            assert r.lang_pred in languages.names and 0 < r.score <= 1
    kept = langid.accepted(docs, languages)
    unchanged(kept, docs)
    assert kept.filter("text IS NULL OR trim(text) = ''").count() == 0


def test_nothing_learned(spark):
    model = langid.learned(empty(spark))
    assert model.names == []
    assert {r.lang_pred for r in langid.identified(edge(spark), model).collect()} == {"und"}
    assert langid.identified(empty(spark), model).collect() == []


def test_prediction_looks_at_the_text_only(spark, languages, docs):
    some = docs.limit(40)
    plain = {r.doc_id: r.lang_pred for r in langid.identified(some, languages).collect()}
    other = some.selectExpr("doc_id + 7 AS doc_id", "text", "'xx' AS lang")
    assert {r.doc_id - 7: r.lang_pred for r in langid.identified(other, languages).collect()} == plain


def test_texts_in_no_learned_language_are_rejected(spark, docs, languages):
    """Other languages, other scripts and gibberish go; several learned languages in equal parts stay."""
    words = {r.lang: r.text.split()[:150] for r in docs.filter("n_chars > 3000").collect()}
    others = [
        "To jest zupełnie inny język, którego model nie zna, a mimo to zostaje przyjęty bez żadnego powodu.",
        "Tämä on suomenkielinen teksti, jota malli ei ole koskaan nähnyt, ja siksi se pitäisi hylätä heti.",
        "Bu metin Türkçe yazılmış ve model bu dili hiç öğrenmedi, bu yüzden reddedilmesi gerekir.",
        "Это русский текст, который модель никогда не видела.", "xqzv kjwpt zzqx vbnmk qwrtp lkjhg xcvbz pqowi",
    ]
    stay = [" ".join(sum(words.values(), [])), " ".join(words["de"]), " ".join(words["fr"] + others[0].split() * 5)]
    assert len(words) == 4
    rows = list(enumerate(stay + others + [None, "", "42 !"]))
    kept = langid.accepted(spark.createDataFrame(rows, "doc_id long, text string"), languages).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == rows[:3]
    found = langid.identified(spark.createDataFrame(rows[:1], "doc_id long, text string"), languages).first()
    assert len(found.languages) == 4 and found.score < 0.31
