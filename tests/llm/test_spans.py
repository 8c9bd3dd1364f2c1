import random
import re

from lakeops.llm import sentence_spans as ss
from lakeops.llm.common import Words
from tests.conftest import SF
from tests.llm.cases import LONG, TEXTS, edge, empty

BLANK = " \t\n\r\x0b\x0c"


def pieces(text):
    """Sentences by the definition: lists of matches of words."""
    out, now = [], []
    for m in re.finditer(f"[^{BLANK}]+", text):
        now.append(m)
        gap = re.compile(f"[{BLANK}]*").match(text, m.end())[0]
        if m[0][-1] in ".!?" or "\n" in gap or m.end() + len(gap) >= len(text):
            out.append(now)
            now = []
    parts, cuts = [], []
    for s in out:
        if len(s) <= ss.LONG:
            parts.append(s)
            cuts.append(False)
            continue
        now = []
        for m, h in zip(s, Words([" ".join(m[0] for m in s)]).hashes):
            now.append(m)
            if int(h) % ss.PICK == 0:
                parts.append(now)
                now = []
        if now:
            parts.append(now)
        cuts += [True] * (len(parts) - len(cuts))
    return parts, cuts


def brute(rows):
    first, out = {}, []
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0, n))
    for n in order:
        text = rows[n][1] or ""
        p, cuts = pieces(text)
        gone = [False] * len(p)
        for a in range(len(p)):
            words, b = 0, a
            floor = ss.MIN_WORDS if any(cuts[a : a + ss.MIN_SENTENCES]) else 0
            while b < len(p) and (words < floor or b - a < ss.MIN_SENTENCES):
                words += len(p[b])
                b += 1
            if words >= floor and b - a >= ss.MIN_SENTENCES:
                span = tuple(m[0] for s in p[a:b] for m in s)
                if first.setdefault(span, (n, a)) != (n, a):
                    gone[a:b] = [True] * (b - a)
        at = [0, *(s[0].start() for s in p[1:]), len(text)]
        left = "".join(text[at[i] : at[i + 1]] for i in range(len(p)) if not gone[i]) if any(gone) else rows[n][1]
        out.append((rows[n][0], left, len(p), sum(gone)))
    return sorted(out, key=repr)


def found(frame):
    return sorted(((r.doc_id, r.text, r.n_sentences, r.n_removed) for r in ss.deduplicated(frame).collect()), key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = found(docs)
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sum(g[3] > 0 for g in got) > 20


def test_edge_cases(spark):
    got = found(edge(spark))
    assert got == brute(TEXTS)
    by = {g[0]: g for g in got if g[0] in (8, 9)}
    assert by[8][1] != LONG or by[8][3] == 0
    assert ss.deduplicated(empty(spark)).collect() == []


def test_a_passage_is_found_wherever_it_stands(spark):
    """One of 55 words, as one sentence or several, behind a newline, a full stop or in mid-sentence."""
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(10**6)}"
    for stops in (55, 11, 9):
        passage = " ".join(word() + ("." if (i + 1) % stops == 0 else "") for i in range(55))
        around = lambda: " ".join(word() for _ in range(30))
        rows = [(i, f"{around()}{gap}{passage} {around()}.") for i, gap in enumerate(["\n", ". ", " ", "\n\n"] * 3)]
        rows += [(100 + i, around() + ". " + around()) for i in range(10)]
        for i, text, _, removed in found(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)):
            if i == 0 or i >= 100:
                assert removed == 0
            else:
                left = set(text.split())
                # Up to a sentence's rest at each end may stay.
                assert sum(w in left for w in passage.split()) <= 35 and removed > 0
                assert sum(w in left for w in rows[i][1].split()[:25]) == 25


def _ending_too(text):
    """Bounds of all spans with `ends`, by the definition."""
    p, cuts = cut(text)
    out = set()
    for a in range(len(p)):
        for step in (1, -1):
            i, words, n = a, 0, 0
            near = cuts[a : a + ss.MIN_SENTENCES] if step > 0 else cuts[max(0, a + 1 - ss.MIN_SENTENCES) : a + 1]
            floor = ss.MIN_WORDS if any(near) else 0
            while 0 <= i < len(p) and (words < floor or n < ss.MIN_SENTENCES):
                words, n, i = words + len(p[i]), n + 1, i + step
            if words >= floor and n >= ss.MIN_SENTENCES:
                out.add((a, i) if step > 0 else (i + 1, a + 1))
    return p, sorted(out)


def cut(text):
    """Sentences with `ends`: those of more than LONG words end behind the least hash of every PICK words in a row."""
    out, cuts, now = [], [], []
    words = re.findall(f"[^{BLANK}]+", text)
    for i, w in enumerate(words):
        now.append(w)
        if w[-1] in ".!?" or i + 1 == len(words):
            if len(now) > ss.LONG:
                h = Words([" ".join(now)]).hashes.tolist()
                at = {max(range(i, i + ss.PICK), key=lambda j: (-h[j], j)) for i in range(len(h) - ss.PICK + 1)} | {len(h) - 1}
                bounds = [0, *sorted(j + 1 for j in at)]
                out += [now[a:b] for a, b in zip(bounds, bounds[1:])]
            else:
                out.append(now)
            cuts += [len(now) > ss.LONG] * (len(out) - len(cuts))
            now = []
    return out, cuts


def test_spans_with_ends_by_the_definition():
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(60)}" + rng.choice(["", "", "", "", ".", ""]) for _ in range(n)) for n in (0, 1, 7, 25, 60, 300)]
    texts += [" ".join(f"v{rng.randrange(9)}" for _ in range(200)), "again " * 70]
    s = ss.Sentences(texts, True)
    start, stop, _ = s.spans()
    base = s.upto - s.counts
    for i, t in enumerate(texts):
        p, spans = _ending_too(t)
        mine = (start >= base[i]) & (start < s.upto[i])
        assert s.counts[i] == len(p)
        assert sorted(zip((start[mine] - base[i]).tolist(), (stop[mine] - base[i]).tolist())) == spans


def test_the_tail_of_a_repeated_passage_goes(spark):
    """Sentences of 10, 10 and 5 words: the span from the second one runs on into what is not shared."""
    rng = random.Random(4)
    sentence = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) + "."
    passage = " ".join(sentence(n) for n in (10, 10, 5))
    rows = [(i, f"{sentence(12)} {passage} {sentence(12)}") for i in range(4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    for r in ss.deduplicated(frame, ends=True).collect():
        assert (passage in r.text) == (r.doc_id == 0) and len(r.text.split()) == (49 if r.doc_id == 0 else 24)


def test_a_passage_in_mid_sentence_keeps_its_ends_only(spark):
    """Without stops, 200 passages of 51 words: less than two windows stay at each end, and no passage whole."""
    rng = random.Random(5)
    words = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    passages = [words(51) for _ in range(200)]
    rows = [(2 * i + j, f"{words(30)} {p} {words(30)}.") for i, p in enumerate(passages) for j in range(2)]
    out = {r.doc_id: r.text for r in ss.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), ends=True).collect()}
    for i, p in enumerate(passages):
        left, at = set(out[2 * i + 1].split()), p.split()
        assert out[2 * i] == rows[2 * i][1]
        assert not any(w in left for w in at[2 * ss.PICK - 1 : 1 - 2 * ss.PICK])
        own = [w for w in rows[2 * i + 1][1].split() if w not in set(at)]
        assert [w for w in out[2 * i + 1].split() if w not in set(at)] == own


def test_short_sentences_in_a_row_are_a_span(spark):
    """Three whole sentences of fifteen words, and two of four; a single one stays."""
    rows = [
        (1, "One two three four five. Six seven eight nine ten! And some more of them? Alone here."),
        (2, "First. One two three four five. Six seven eight nine ten! And some more of them? Other there."),
        (3, "Alone here. Something else. Not again. So it is."),
        (4, "Nobody. Not again. So it is. Somebody."),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for ends in (False, True):
        out = {r.doc_id: (r.text, r.n_removed) for r in ss.deduplicated(frame, ends=ends).collect()}
        assert out[1] == (rows[0][1], 0) and out[3] == (rows[2][1], 0)
        assert out[2] == ("First. Other there.", 3) and out[4] == ("Nobody. Somebody.", 2)
