"""Rows that every operator has to bear."""

import random

from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977} v{i}." for i in range(30_000))
TEXTS = [
    (1, "alpha beta gamma delta epsilon zeta eta. Theta iota kappa!"),
    (1, "alpha beta gamma delta epsilon zeta eta. Theta iota kappa!"),
    (6, "alpha  beta gamma delta epsilon zeta\neta. Theta iota kappa!"),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (None, "x y"),
    (None, None),
    (7, "42 ... !!"),
    (8, LONG),
    (9, LONG + " end"),
    (10, "ÜBER 日本語 🙂 a b <|endoftext|> c"),
]
#: Names that the operators use for their own columns.
CLASHING = (
    "row __row ids decoded lang_pred score languages shares n_sentences n_removed n_entities copies rate p tokens digest key kept rep node h "
    "__copies __new __a __b __key value size"
).split()


def edge(spark, clashing=True):
    """The rows, with columns of clashing names that hold an x."""
    frame = spark.createDataFrame([(i, t, "en" if i else None) for i, t in TEXTS], "doc_id long, text string, lang string").repartition(1)
    return frame.select("*", *[F.lit("x").alias(c) for c in CLASHING]) if clashing else frame


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def unchanged(out, docs):
    """The other columns are the input's, in order."""
    assert out.columns == docs.columns
    for c in CLASHING:
        if c in out.columns:
            assert {r[0] for r in out.select(c).collect()} <= {"x"}


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
