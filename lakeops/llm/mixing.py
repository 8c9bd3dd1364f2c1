"""Mixing by soft membership: document rates whose expected token totals by domain match targets.

A classifier learned from a labelled table gives every document a probability for each
domain. The rates r >= 0 minimise the distance of sum(r * tokens * probabilities) from the
targets by projected gradient; a round is one aggregation over the documents, which brings
one number per domain to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import SLICE_BYTES, free_name, list_array, slices, strings, word_hashes, written

#: Hashed words, and bins for the text's shape behind them.
WORDS, BINS, SHAPES = 1 << 15, 12, 4
FEATURES = WORDS + BINS * SHAPES
#: The classifier learns from about so many labelled documents (or all, if fewer).
TRAIN_DOCS = 10_000
STEPS, RATE, DECAY = 150, 0.05, 1e-5
#: Standard errors by which a feature must set a domain apart to be used.
TELLING = 4
#: Rounds of the projected gradient, and the miss in parts of the total that ends them.
ROUNDS, MISS = 60, 1e-6

# Of bytes: upper-case letters, and signs that are neither letters, digits nor blanks.
_UPPER = np.array([0x41 <= b <= 0x5A for b in range(256)])
_SIGN = np.array([0x21 <= b <= 0x7E and not chr(b).isalnum() for b in range(256)])


@dataclass(frozen=True)
class Classifier:
    domains: list[str]
    weights: np.ndarray
    bias: np.ndarray


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct features of each text one after the other, their number, and the number of words.

    The features are hashed words as they stand, and the bins of four measures: repeated
    words, upper-case letters, signs, and the logarithm of the length.
    """
    hashes, words = word_hashes(texts)
    doc = np.repeat(np.arange(len(texts)), words)
    pairs = np.unique(doc * WORDS + (hashes >> np.uint64(40)).astype(np.int64) % WORDS)
    distinct = np.bincount(pairs // WORDS, minlength=len(texts))
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(r) for r in raw], dtype=np.int64)

    def share(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[data])])[np.concatenate([[0], ends])]
        return np.diff(sums) / np.maximum(1, np.diff(ends, prepend=0))

    measures = [1 - distinct / np.maximum(1, words), share(_UPPER), 2 * share(_SIGN), np.log2(words + 1.0) / 20]
    shapes = [WORDS + BINS * m + np.minimum(BINS - 1, (x * BINS).astype(np.int64)) for m, x in enumerate(measures)]
    every = np.concatenate([np.stack([pairs // WORDS, pairs % WORDS], 1), *(np.stack([np.arange(len(texts)), s], 1) for s in shapes)])
    order = np.argsort(every[:, 0], kind="stable")
    return every[order, 1], distinct + SHAPES, words


def _logits(slots: np.ndarray, counts: np.ndarray, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    return np.add.reduceat(weights[slots], np.cumsum(counts) - counts, axis=0) + bias


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _telling(slots: np.ndarray, owner: np.ndarray, domain: np.ndarray, k: int) -> np.ndarray:
    """Features whose log-odds of being in a domain's documents are TELLING standard errors from those elsewhere."""
    has = np.stack([np.bincount(slots[domain[owner] == d], minlength=FEATURES) for d in range(k)], 1) + 0.5
    size = np.bincount(domain, minlength=k) + 1.0
    rest, rest_size = has.sum(1, keepdims=True) - has + 0.5, size.sum() - size
    odds = np.log(has / np.maximum(0.5, size - has)) - np.log(rest / np.maximum(0.5, rest_size - rest))
    error = np.sqrt(1 / has + 1 / rest)
    return (np.abs(odds) / error >= TELLING).any(1)


def _trained(domains: list[str], slots: np.ndarray, counts: np.ndarray, domain: np.ndarray) -> Classifier:
    """Multinomial logistic regression over the telling features, on all rows at once, by
    Adam from zero: no chance involved."""
    k = len(domains)
    weights, bias = np.zeros((FEATURES, k), np.float32), np.log(np.bincount(domain, minlength=k) / len(domain)).astype(np.float32)
    owner = np.repeat(np.arange(len(counts)), counts)
    keep = _telling(slots, owner, domain, k)[slots]
    slots, owner = slots[keep], owner[keep]
    order = np.argsort(slots, kind="stable")
    by = owner[order]
    used, first = np.unique(slots[order], return_index=True)
    rows, start = np.unique(owner, return_index=True)
    truth = np.zeros((len(counts), k), np.float32)
    truth[np.arange(len(counts)), domain] = 1
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(bias), np.zeros_like(bias)]
    for step in range(1, STEPS + 1):
        logits = np.tile(bias, (len(counts), 1))
        if len(used):
            logits[rows] += np.add.reduceat(weights[slots], start, axis=0)
        error = (_softmax(logits) - truth) / len(counts)
        slope = DECAY * weights
        if len(used):
            slope[used] += np.add.reduceat(error[by], first, axis=0)
        for x, g, m, v in ((weights, slope, *moments[:2]), (bias, error.sum(0), *moments[2:])):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Classifier(domains, weights, bias)


def learned(docs: DataFrame, labels: DataFrame, domain: Column, key: str = "doc_id", text: str = "text", most: int = TRAIN_DOCS) -> Classifier:
    """A classifier of the labels' domains from about `most` labelled documents, picked by a hash of the key.

    `domain` is a text expression over `labels`; rows where it is null teach nothing. A key
    counts once, with the first of its domains and of its texts in order. The
    picked labels are broadcast and their features come to the driver: `most` rows of at
    most FEATURES numbers. No labelled documents give a classifier without domains.
    """
    known = labels.select(F.col(key).alias("__key"), domain.alias("__domain")).filter("__key IS NOT NULL AND __domain IS NOT NULL")
    known = known.groupBy("__key").agg(F.min("__domain").alias("__domain"))
    total = known.count()
    share = (F.xxhash64("__key", F.lit(10)) % 1_000_000 + 1_000_000) / 2_000_000
    picked = F.broadcast(known.filter(share < F.lit(min(1.0, most / max(1, total)))))
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("text")).join(picked, "__key")
    rows = rows.groupBy("__key").agg(F.min("__domain").alias("domain"), F.min("text").alias("text")).select("domain", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            slots, counts, _ = features(strings(batch.column(1)))
            ends = np.cumsum(counts)
            lists = [slots[e - n : e].astype(np.uint16).tobytes() for e, n in zip(ends.tolist(), counts.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.binary())], ["domain", "slots"])

    domains, flat = [], []
    for row in rows.mapInArrow(run, "domain string, slots binary").sort("domain", "slots").toLocalIterator():
        domains.append(row.domain)
        flat.append(np.frombuffer(row.slots, np.uint16))
    names = sorted(set(domains))
    if not names:
        return Classifier([], np.zeros((FEATURES, 0), np.float32), np.zeros(0, np.float32))
    index = {n: i for i, n in enumerate(names)}
    return _trained(names, np.concatenate(flat).astype(np.int64), np.array([len(f) for f in flat]), np.array([index[d] for d in domains]))


def posteriors(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """(row, tokens, p): place, number of words, and probability of each domain of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES numbers a domain
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in slices(batches, "text", SLICE_BYTES):
            slots, counts, words = features(strings(batch.column(1)))
            p = _softmax(_logits(slots, counts, m.weights, m.bias).astype(np.float64)) if m.domains else np.zeros((batch.num_rows, 0))
            flat = list_array(p.ravel(), np.full(batch.num_rows, p.shape[1]), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words.astype(np.int64)), flat], ["row", "tokens", "p"])

    return rows.mapInArrow(run, "row long, tokens long, p array<double>")


def totals(rows: DataFrame, n: int, rate: Column | None = None) -> np.ndarray:
    """Expected tokens by domain: sum(rate * tokens * p), the rate being 1 if there is none."""
    weight = F.col("tokens") if rate is None else rate * F.col("tokens")
    sums = rows.agg(*[F.coalesce(F.sum(weight * F.col("p")[k]), F.lit(0.0)).alias(f"s{k}") for k in range(n)]).first()
    return np.array(sums, float)


def fitted(rows: DataFrame, target: np.ndarray, lower: Column | None = None) -> DataFrame:
    """`rows` with the column rate, which is not below `lower` (from 0 to 1; 0 if there is none).

    Rates start at 1. A step moves them against the gradient of the distance from the
    targets, scaled by the Gram matrix G = sum(tokens * p p') of the documents whose rate is
    above its bound: r = max(lower, r + p . G^-1 (target - totals)). Without the bound one step would
    match the targets with the least change of tokens; further steps make up for what the
    bound cuts off. A step that comes no nearer is taken back for one by the inverse of G's
    greatest eigenvalue, which always does. Targets out of reach end with the last round.
    """
    n = len(target)
    lower = F.lit(0.0) if lower is None else lower
    above = [(i, j) for i in range(n) for j in range(i, n)]
    rate, kept, since, best, longest = F.lit(1.0), F.lit(1.0), 0, None, 0.0
    for _ in range(ROUNDS if n else 0):
        now = rows.withColumn("rate", rate)
        weight, p = F.col("tokens"), [F.col("p")[k] for k in range(n)]
        free = F.when(F.col("rate") > lower, weight)
        sums = [F.sum(F.col("rate") * weight * x) for x in p] + [F.sum(free * p[i] * p[j]) for i, j in above]
        found = np.array(now.agg(*[F.coalesce(x, F.lit(0.0)).alias(f"s{k}") for k, x in enumerate(sums)]).first(), float)
        miss = target - found[:n]
        if best is None or np.linalg.norm(miss) < np.linalg.norm(best):
            best, kept = miss, rate
            if np.abs(miss).max() <= MISS * max(1.0, np.abs(target).sum()):
                break
            gram = np.zeros((n, n))
            gram[tuple(zip(*above))] = found[n:]
            gram += np.triu(gram, 1).T
            longest = longest or max(np.linalg.eigvalsh(gram)[-1], 1e-300)
            step = np.linalg.pinv(gram, rcond=1e-12, hermitian=True) @ miss
        else:
            step = best / longest
        if since == 8:  # keeps the plan short
            rows = written(rows.withColumn("rate", kept), "rates")
            kept, since = F.col("rate"), 0
        move = sum((F.lit(float(s)) * x for s, x in zip(step, p)), F.lit(0.0))
        rate, since = F.greatest(lower, kept + move), since + 1
    return rows.withColumn("rate", kept)


def mixed_rates(
    docs: DataFrame, model: Classifier, weights: Mapping[str, float], text: str = "text", tokens: float | None = None, keep: str | None = None,
    steady: float = 0.0, spare: str | None = None,
) -> DataFrame:
    """(row, tokens, p, rate, copies) for every row of `docs`.

    `weights` are the target shares of the domains, put in proportion to add up to 1; domains that
    are not named get none. The total is `tokens`, or what leaves the expected tokens of the
    domain `keep` as they are, or the tokens there are. copies is the rate rounded up or
    down by a hash of the row's place, up as often as its fraction says; a rate within `steady`
    of 1 is 1 copy. Documents that most likely belong to the domain
    `spare` have a rate of 1 at least, should the targets be missed for that. Texts without
    words weigh nothing and follow their probabilities; without domains all rates are 1.
    Null texts count as empty. `docs` must be a scan or another frame whose partitions are the
    same when computed again.
    """
    rows = written(posteriors(docs, model, text), "posteriors")
    n = len(model.domains)
    shares = np.array([float(weights.get(d, 0.0)) for d in model.domains])
    if n == 0 or shares.sum() <= 0:
        out = rows.withColumn("rate", F.lit(1.0))
    else:
        shares = shares / shares.sum()
        now = totals(rows, n)
        if tokens is None and keep in model.domains and shares[model.domains.index(keep)] > 0:
            tokens = now[model.domains.index(keep)] / shares[model.domains.index(keep)]
        lower = None
        if spare in model.domains:
            likely = F.array_position("p", F.array_max("p")) == model.domains.index(spare) + 1
            lower = F.when(likely, 1.0).otherwise(0.0)
        out = fitted(rows, shares * (now.sum() if tokens is None else tokens), lower)
    chance = (F.xxhash64("row", F.lit(11)) % 1_000_000 + 1_000_000) / 2_000_000
    copies = F.when(F.abs(F.col("rate") - 1) <= steady, 1).otherwise(F.floor(F.col("rate") + chance))
    return out.withColumn("copies", copies.cast("int"))


def mixed(docs: DataFrame, model: Classifier, weights: Mapping[str, float], text: str = "text", **options) -> DataFrame:
    """The rows of `docs`, each as often as `copies` of `mixed_rates` says; columns unchanged."""
    row = free_name(docs, "__row")
    times = mixed_rates(docs, model, weights, text, **options).select(F.col("row").alias(row), "copies")
    number = free_name(docs, "__copies")
    found = docs.withColumn(row, F.monotonically_increasing_id()).join(times.withColumnRenamed("copies", number).filter(f"{number} > 0"), row)
    return found.withColumn(row, F.explode(F.sequence(F.lit(1), F.col(number)))).select(docs.columns)
