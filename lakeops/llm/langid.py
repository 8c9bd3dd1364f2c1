"""Language identification of documents as mixtures of languages.

Each word has a likelihood in each language from its character trigrams. Expectation-
maximisation finds the shares of the languages in a document, and a penalised likelihood
picks how many languages it is written in.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import list_array, slices, strings, without

#: Trigrams are counted in so many slots, and learned from about so many documents of a language.
SLOTS = 1 << 16
TRAIN_DOCS = 4000
#: Counting tasks, each of which sends SLOTS numbers for a language to the driver.
TRAIN_TASKS = 8
SMOOTHING = 0.05
ROUNDS = 40
UNKNOWN = "und"

_kinds: list[np.ndarray] = []


def letter_kinds() -> np.ndarray:
    """2 for the code points of letters, 1 for marks, 0 for the rest."""
    if not _kinds:
        first = {"L": 2, "M": 1}
        _kinds.append(np.fromiter((first.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)), np.uint8, 0x110000))
    return _kinds[0]


@dataclass(frozen=True)
class Languages:
    """What is learned: names in order, for each slot the log-probability in each language,
    and the mean of that over each language's own training trigrams."""

    names: list[str]
    logs: np.ndarray
    usual: np.ndarray


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Slots of the trigrams of all words, where each word begins among them, the text it
    is in, and which texts have a letter. A word of n letters has n trigrams, padded at both ends."""
    kinds = letter_kinds()
    lowered = [t.lower() for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
    points = np.frombuffer((" " + " ".join(lowered) + "  ").encode("utf-32-le", "replace"), np.uint32)
    kind = kinds[points]
    points = np.where(kind > 0, points, 0)
    at = np.flatnonzero(points)
    with np.errstate(over="ignore"):
        mix = points[at - 1] * np.uint32(0x9E3779B1) + points[at] * np.uint32(0x85EBCA77) + points[at + 1] * np.uint32(0xC2B2AE3D)
        mix = (mix ^ (mix >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    slots = (mix >> np.uint32(16)).astype(np.int64) % SLOTS
    starts = np.flatnonzero(points[at - 1] == 0)
    begin = 1 + np.cumsum(sizes) - sizes
    doc = np.searchsorted(begin, at[starts], "right") - 1
    lettered = np.zeros(len(texts), bool)
    lettered[np.searchsorted(begin, np.flatnonzero(kind == 2), "right") - 1] = True
    return slots, starts, doc, lettered


def in_training(key: str = "doc_id", lang: str = "lang") -> Column:
    """Rows to learn from: a language, and a key whose crc32 leaves a remainder other than 1 by 3."""
    return F.col(lang).isNotNull() & (F.crc32(F.col(key).cast("string").cast("binary")) % 3 != 1)


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learned(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", most: int = TRAIN_DOCS) -> Languages:
    """Trigram models from about `most` training documents of each language, picked by a hash of
    the key; languages with fewer give all. No training rows give no languages."""
    rows = docs.filter(in_training(key, lang) & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}  # one row per language
    if not counts:
        return Languages([], np.empty((SLOTS, 0), np.float32), np.empty(0))
    names = sorted(counts)
    cut = F.lit(None).cast("double")
    for name in names:
        cut = F.when(F.col(lang) == name, F.lit(min(1.0, most / counts[name]))).otherwise(cut)
    share = (F.xxhash64(F.col(key)) % 1_000_000 + 1_000_000) / 2_000_000
    picked = rows.filter(share < cut).select(F.col(lang).alias("lang"), F.col(text).alias("text")).repartition(TRAIN_TASKS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text"):
            slots, starts, doc, _ = trigrams(strings(batch.column(1)))
            of = np.repeat(doc, np.diff(starts, append=len(slots)))
            langs = batch.column(0).to_pylist()
            for name in set(langs):
                own = np.array([x == name for x in langs])
                sums[name] = sums.get(name, 0) + np.bincount(slots[own[of]], minlength=SLOTS)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.astype(np.int64).tobytes() for v in sums.values()], pa.binary())], ["lang", "counts"]
            )

    table = np.full((SLOTS, len(names)), SMOOTHING)
    for row in picked.mapInArrow(count, "lang string, counts binary").toLocalIterator():
        table[:, names.index(row.lang)] += np.frombuffer(row.counts, np.int64)
    logs = np.log(table / table.sum(0))
    counted = table - SMOOTHING
    return Languages(names, logs.astype(np.float32), (counted * logs).sum(0) / np.maximum(1, counted.sum(0)))


def _fitted(odds: np.ndarray, starts: np.ndarray, sizes: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the allowed languages in each text, and the log-likelihood beyond the words' best ones.

    odds: of each word, relative to its best language; starts, sizes: of the texts among the words.
    """
    shares = allowed / allowed.sum(1, keepdims=True)
    level = np.full(len(sizes), -np.inf)
    todo = np.arange(len(sizes))
    o, s, n = odds, starts, sizes
    for _ in range(ROUNDS):
        joint = o * np.repeat(shares[todo].astype(np.float32), n, axis=0)
        total = np.maximum(joint.sum(1), 1e-30)
        now = np.add.reduceat(np.log(total), s).astype(np.float64)
        joint /= total[:, None]
        new = np.add.reduceat(joint, s, axis=0) / n[:, None]
        moved = np.abs(new - shares[todo]).max(1) > 1e-3
        shares[todo], level[todo] = new, now
        if not moved.any():
            break
        if not moved.all():
            keep = np.repeat(moved, n)
            o, n, todo = o[keep], n[moved], todo[moved]
            s = np.cumsum(n) - n
    return shares, level


def mixtures(texts: list[str], languages: Languages) -> np.ndarray:
    """Shares of the selected languages in each text; zeros for texts without letters.

    With k languages the likelihood pays (k - 1) * log(number of words). A set that could not
    make up for that even with the likelihood of all languages together is not tried.
    """
    count = len(languages.names)
    out = np.zeros((len(texts), count))
    slots, starts, doc, lettered = trigrams(texts)
    if count == 0 or len(starts) == 0:
        return out
    logs = np.add.reduceat(languages.logs[slots], starts, axis=0)
    best = logs.max(1, keepdims=True)
    logs -= best
    odds = np.exp(logs)
    present, first, words = np.unique(doc, return_index=True, return_counts=True)
    alone = np.add.reduceat(logs, first, axis=0).astype(np.float64)
    shares, level = _fitted(odds, first, words, np.ones((len(present), count)))
    order = np.argsort(-shares, axis=1, kind="stable")
    chosen = np.zeros_like(shares)
    single = alone.argmax(1)
    chosen[np.arange(len(present)), single] = 1
    score = alone.max(1)
    fee = np.log(words + 1.0)
    for k in range(2, count + 1):
        todo = np.flatnonzero(level - (k - 1) * fee > score)
        if len(todo) == 0:
            break
        allowed = np.zeros((len(todo), count))
        np.put_along_axis(allowed, order[todo, :k], 1, axis=1)
        keep = np.repeat(np.isin(np.arange(len(present)), todo), words)
        n = words[todo]
        fitted, now = _fitted(odds[keep], np.cumsum(n) - n, n, allowed)
        gain = now - (k - 1) * fee[todo] > score[todo]
        chosen[todo[gain]] = fitted[gain]
        score[todo[gain]] = (now - (k - 1) * fee[todo])[gain]
    out[present] = chosen
    out[~lettered] = 0
    return out


RESULT = ("lang_pred", "score", "languages", "shares")


def identified(docs: DataFrame, languages: Languages, text: str = "text", result: tuple[str, ...] = RESULT) -> DataFrame:
    """The frame with lang_pred, score, languages and shares (or as `result` names them).

    lang_pred is the language with the greatest share (the first by name among equals), score
    that share; languages and shares list the selected ones, greatest first. Texts that are
    null or have no letters, and all texts if nothing was learned, get `und`, 0.0 and empty
    lists. Columns of these names are replaced; whole texts count, however long.
    """
    sent = docs.sparkSession.sparkContext.broadcast(languages)  # SLOTS numbers a language
    docs = without(docs, *result)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])
    for name, kind in zip(result, ("string", "double", "array<string>", "array<double>")):
        schema = schema.add(name, T._parse_datatype_string(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = np.array([*model.names, UNKNOWN], object)
        for batch in slices(batches, text):
            shares = mixtures(strings(batch.column(text)), model)
            order = np.argsort(-shares, axis=1, kind="stable")
            sorted_shares = np.take_along_axis(shares, order, 1)
            some = sorted_shares > 0
            score = sorted_shares[:, 0] if shares.shape[1] else np.zeros(len(shares))
            top = np.where(score > 0, order[:, 0], len(model.names)) if shares.shape[1] else np.zeros(len(shares), np.int64)
            columns = [
                *batch.columns, pa.array(names[top], pa.string()), pa.array(np.minimum(score, 1.0)),
                list_array(names[order[some]], some.sum(1), pa.string()), list_array(sorted_shares[some], some.sum(1), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def evidence(texts: list[str], languages: Languages) -> np.ndarray:
    """The part of each text's letters in words that one of its selected languages explains; 0 without letters.

    A language explains a word whose mean log-likelihood by trigram is nearer to what is
    usual in its training text than to that of a background where all trigrams are alike.
    """
    out = np.zeros(len(texts))
    chosen = mixtures(texts, languages) > 0
    slots, starts, doc, _ = trigrams(texts)
    if not chosen.any():
        return out
    size = np.diff(starts, append=len(slots))
    means = np.add.reduceat(languages.logs[slots], starts, axis=0) / size[:, None]
    explained = ((means >= (languages.usual - np.log(SLOTS)) / 2) & chosen[doc]).any(1)
    total = np.bincount(doc, size, len(texts))
    return np.bincount(doc, size * explained, len(texts)) / np.maximum(1, total) * chosen.any(1)


def accepted(docs: DataFrame, languages: Languages, text: str = "text", least: float = 0.3) -> DataFrame:
    """The rows of which learned languages, all together, explain `least` of the text (`evidence`); columns are unchanged."""
    sent = docs.sparkSession.sparkContext.broadcast(languages)  # SLOTS numbers a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            keep = evidence(strings(batch.column(text)), sent.value) >= least
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema]))
