"""Substring deduplication on sliding spans of sentences.

A text is cut into sentences: after words that end with a full stop, exclamation or question
mark, and at newlines. Sentences of more than LONG words are cut further, after words that
their hash picks, so that the cuts depend on the words alone and a passage is cut alike
wherever it stands. A span is every run of two sentences, however short; only where pieces of
long sentences are among them does it go on to MIN_WORDS words, as pieces may be single words.
Spans with the same words are one; all but the first by key, row and place are repeated, and the
sentences they cover are removed.

With `ends` a span also ends at every sentence, the shortest such run backwards, so that the
tail of a repeated passage is covered like its head; and long sentences are cut behind the
least hash of every PICK words in a row, so that no PICK words of them are without a cut. A
repeated passage then keeps at most what is in front of its first and behind its last common cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import Words, free_name, list_array, lookup, run_hash, running, slices, strings, without, written

MIN_WORDS, MIN_SENTENCES = 20, 2
LONG, PICK = 16, 8

_END = np.isin(np.arange(256), [0x21, 0x2E, 0x3F])
_STEP = 0xD1342543DE82EF95


def _least(hashes: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which words have the least hash (the last among equals) of some PICK words in a row of one group."""
    out = np.zeros(len(hashes), bool)
    if len(hashes) >= PICK:
        rows = np.lib.stride_tricks.sliding_window_view(hashes, PICK)[:, ::-1]
        whole = np.flatnonzero(group[PICK - 1 :] == group[: 1 - PICK])
        out[whole + PICK - 1 - rows[whole].argmin(1)] = True
    return out


class Sentences:
    """The sentences of texts, as runs of words.

    first: of each sentence its first word, and behind the last one the number of words;
    counts: sentences in each text; at: bytes where sentences begin, with what stands
    between texts' beginnings and their first words.
    """

    def __init__(self, texts: list[str], ends_too: bool = False):
        w = self.words = Words(texts)
        self.ends_too = ends_too
        n = len(w.starts)
        doc = np.repeat(np.arange(len(texts)), w.counts)
        newlines = np.concatenate([[0], np.cumsum(w.data == 0x0A)])
        following = np.append(w.starts[1:], len(w.data))
        last = np.ones(n, bool)
        last[:-1] = doc[1:] != doc[:-1]
        ends = _END[w.data[w.ends - 1]] | (newlines[following] > newlines[w.ends]) | last
        number = np.cumsum(ends) - ends
        long = np.bincount(number, minlength=1)[number] > LONG if n else np.zeros(0, bool)
        ends |= long & (_least(w.hashes, number) if ends_too else w.hashes % np.uint64(PICK) == 0)
        self.first = np.concatenate([[0], np.flatnonzero(ends) + 1])
        self.counts = np.bincount(doc[ends], minlength=len(texts))
        self.upto = np.cumsum(self.counts)
        self.at = w.starts[self.first[:-1]]
        self.cut = long[self.first[:-1]]

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First sentence, sentence behind the last, and hash of every span, by sentence over all texts.

        A span is a run of MIN_SENTENCES; with a piece of a long sentence in it, it goes on to MIN_WORDS.
        """
        first = self.first
        start = np.arange(len(first) - 1)
        cuts = np.concatenate([[0], np.cumsum(self.cut)])
        near = start + MIN_SENTENCES
        pieces = cuts[np.minimum(near, len(start))] > cuts[start]
        stop = np.where(pieces, np.maximum(np.searchsorted(first, first[:-1] + MIN_WORDS), near), near)
        limit = np.repeat(self.upto, self.counts)
        keep = stop <= limit
        if self.ends_too:
            behind = start + 1
            near = behind - MIN_SENTENCES
            pieces = cuts[behind] > cuts[np.maximum(near, 0)]
            back = np.where(pieces, np.minimum(np.searchsorted(first, first[1:] - MIN_WORDS, "right") - 1, near), near)
            # Not those that a span from their first sentence on already is.
            more = (back >= limit - np.repeat(self.counts, self.counts)) & (stop[np.maximum(back, 0)] != behind)
            start, stop = np.concatenate([start[keep], back[more]]), np.concatenate([stop[keep], behind[more]])
            order = np.argsort(start, kind="stable")
            start, stop = start[order], stop[order]
        else:
            start, stop = start[keep], stop[keep]
        return start, stop, run_hash(*running(self.words.hashes, _STEP), first[start], first[stop])


def _spans(batches: Iterator[pa.RecordBatch], ends: bool) -> Iterator[pa.RecordBatch]:
    """Kernel (row, key, text) -> (row, key, h): hashes of the spans of each text, in order."""
    for batch in slices(batches, "text"):
        s = Sentences(strings(batch.column(2)), ends)
        start, _, h = s.spans()
        n = np.bincount(np.searchsorted(s.upto, start, "right"), minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], list_array(h.view(np.int64), n, pa.int64())], ["row", "key", "h"])


def _cleaned(row_text: str, schema: T.StructType, places: str, ends: bool):
    """Kernel (columns, places of spans to go) -> columns with the text that is left, and sentence counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, row_text):
            column = batch.column(row_text)
            texts = strings(column)
            s = Sentences(texts, ends)
            data = s.words.data.tobytes()
            removed = np.zeros(batch.num_rows, np.int64)
            left = column.to_pylist()
            start, stop, _ = s.spans()
            begins = np.searchsorted(start, s.upto - s.counts)
            for i, gone in enumerate(batch.column(places).to_pylist()):
                if not gone:
                    continue
                n = int(s.counts[i])
                base = int(s.upto[i]) - n
                a, b = (x[begins[i] + np.array(gone)] - base for x in (start, stop))
                change = np.zeros(n + 1, np.int64)
                np.add.at(change, a, 1)
                np.add.at(change, b, -1)
                out = np.cumsum(change[:-1]) > 0
                begin = int(s.words.begins[i])
                end = begin + len(texts[i].encode("utf-8", "surrogatepass"))
                cuts = [begin, *s.at[base + 1 : base + n].tolist(), end]
                left[i] = b"".join(data[cuts[k] : cuts[k + 1]] for k in np.flatnonzero(~out)).decode("utf-8", "surrogatepass")
                removed[i] = out.sum()
            keep = [pa.array(left, pa.string()) if c == row_text else batch.column(c) for c in schema.names[:-2]]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(s.counts.astype(np.int64)), pa.array(removed)], names=schema.names)

    return run


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", ends: bool = False) -> DataFrame:
    """The frame with the text that is left, n_sentences (before) and n_removed.

    A span is every run of MIN_SENTENCES sentences. Sentences of more than LONG words are cut into
    pieces, and a span with such a piece has MIN_WORDS words at least. Of equal spans the one of
    the least key stays (null last), then of the first row, then of the first place; also within a
    text. Sentences that are left stand as they stood, with the white space behind them; a text
    without repeated spans stays as it is, null too, and the text of a whole copy becomes empty.
    Texts of one sentence have no span. Words are what ASCII white space separates, and compared as
    they are written. Columns named n_sentences or n_removed are replaced. `docs` must be a scan or
    another frame whose partitions are the same when computed again. `ends` adds the spans that
    end at every sentence, and cuts in every PICK words of long sentences: repeated passages go whole.

    Spans are compared as 64-bit hashes. Only the hashes are grouped; a span's place travels once
    more, with those that occur twice.
    """
    docs = without(docs, "n_sentences", "n_removed")
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    kind = docs.select(key).schema[0].dataType.simpleString()
    lists = texts.mapInArrow(lambda batches: _spans(batches, ends), f"row long, key {kind}, h array<long>")
    lists = written(lists, "span-lists")
    spans = lists.select("row", "key", F.posexplode("h").alias("k", "h"))
    repeated = spans.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first")).filter("n > 1")
    total = lists.agg(F.sum(F.size("h"))).first()[0] or 1
    found = lookup(spans, written(repeated, "repeated-spans"), "h", "n", total)
    # Spans of another key than the least go; of those of the least key, all but the first.
    leads = F.when(F.col("key").eqNullSafe(F.col("first")), F.col("h"))
    found = written(found.select("row", "k", leads.alias("h")), "found-spans")
    leading = found.filter("h is not null")
    several = leading.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "k")).alias("at")).filter("n > 1")
    again = lookup(leading, written(several, "leading-spans"), "h", "n", total).filter(F.struct("row", "k") != F.col("at"))
    gone = found.filter("h is null").select("row", "k").unionByName(again.select("row", "k"))
    row, places = (free_name(docs, n) for n in ("__row", "__places"))
    gone = gone.groupBy("row").agg(F.collect_list("k").alias(places)).withColumnRenamed("row", row)
    whole = docs.withColumn(row, F.monotonically_increasing_id()).join(gone, row, "left").drop(row)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema]).add("n_sentences", "long").add("n_removed", "long")
    return whole.mapInArrow(_cleaned(text, schema, places, ends), schema)
