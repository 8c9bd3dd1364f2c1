"""Conversation repair against every edit tried in order, and long conversations against short ones."""

import hashlib
import heapq
import random
import re
import zlib

from pyspark.sql import functions as F

from lakeops.llm.conversations import cheapest, damaged, judged, repaired_turns
from lakeops.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\x0c\r"
#: Initials that may follow one another in (s?(ua)+)?, whose strings are empty or end in a.
FOLLOWS = {"": "su", "s": "u", "u": "a", "a": "u"}


def hurt(rows):
    """{conv: rows after damage}, by the definition."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        rule = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        kept = out.setdefault(conv, [])
        if rule == 1:
            text = ""
        elif rule == 2:
            text = re.sub("[.!?]", "", text)
        elif rule == 4:
            role = "user"
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(rule, 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, v in out.items()}


def search(faults, initials):
    """Cheapest edits by Dijkstra over (cost, string), with no lattice of ours."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, have = heapq.heappop(heap)
        if i == len(faults) and have in ("", "a"):
            return cost, audit
        if (i, have) in seen:
            continue
        seen.add((i, have))
        steps = [("I", 3, 0, "u"), ("I", 3, 0, "a")]
        if i < len(faults):
            steps.append(("D", 4, 1, ""))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                steps += [("K", more, 1, initials[i] or "?"), ("R", 3 + more, 1, "u"), ("R", 3 + more, 1, "a")]
        for letter, price, on, role in steps:
            if not role or role in FOLLOWS[have]:
                heapq.heappush(heap, (cost + price, audit + letter, i + on, role or have))


def expected(conv, rows):
    faults, seen = [], set()
    for _, role, text in rows:
        rest = text.rstrip(SPACE)
        faults.append("blank" if not rest else "duplicate" if (role, text) in seen else "truncated" if rest[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    cost, audit = search(faults, initials)
    out, have, k = [], "", 0
    for letter in audit:
        if letter in "IR":
            role = "assistant" if have.endswith("u") else "user"
        else:
            role = rows[k][1]
        if letter != "D":
            out.append((role, "" if letter == "I" else rows[k][2]))
            have += role[0]
        k += letter != "I"
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    text = "\n".join(f"{r}:{t}" for r, t in out)
    count = faults.count
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    summary = (conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return summary, [(conv, i + 1, r, t) for i, (r, t) in enumerate(out)]


def check(spark, rows, **cut):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {c: expected(c, r) for c, r in hurt(rows).items()}
    bad = damaged(frame)
    assert sorted(map(tuple, judged(bad, **cut).collect()), key=repr) == sorted((s for s, _ in want.values()), key=repr)
    turns = repaired_turns(bad, **cut).select("conv", "place", "role", "text").collect()
    assert sorted(map(tuple, turns), key=repr) == sorted((t for _, ts in want.values() for t in ts), key=repr)


def invented(rng, convs, most):
    roles = ["user", "assistant"] * 4 + ["system", "tool", None, "", "unit"]
    texts = ["Yes.", "No!", "Well", "", None, " \n", "Why? ", "été.", "a.b"]
    out = []
    for c in convs:
        for t in range(rng.randrange(most + 1)):
            turn = None if rng.random() < 0.05 else t * rng.choice([1, 1, 2])
            # Rows of one turn are told apart by their first letters here, as the definition leaves them open.
            out.append((c, turn, rng.choice(roles), rng.choice(texts)))
    return out


def test_every_conversation_against_the_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)
    out = QUERIES["op11_auction_repair"](spark, SF)
    assert out.count() == len({r[0] for r in rows})
    assert [d for _, d in out.dtypes] == ["bigint"] * 7 + ["string"] * 2


def test_invented_conversations_nulls_and_repeated_rows(spark):
    rng = random.Random(11)
    check(spark, invented(rng, [None, *range(120)], 9) + [(500, None, None, None)] * 3 + [(501, 1, "user", "Yes.")] * 5)


def test_long_conversations_in_blocks(spark):
    rng = random.Random(12)
    check(spark, invented(rng, range(8), 60), long=6, block=4)


def test_one_conversation_of_very_many_rows(spark):
    rows = spark.range(5_000).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.expr("if(id % 3 = 0, 'user', 'assistant')").alias("role"),
        F.concat(F.col("id").cast("string"), F.lit(".")).alias("text"),
    )
    (row,) = judged(damaged(rows)).collect()
    assert (row.conv, len(row.audit) > 4_500, row.cost > 3_000) == (1, True, True)
    whole = [tuple(r) for r in rows.collect()]
    assert tuple(row) == expected(1, hurt(whole)[1])[0]


def test_empty_table_and_clashing_columns(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert judged(damaged(none)).collect() == []
    one = spark.createDataFrame([(2, 1, "user", "Hi." + "x " * 500_000)], "conv_id long, turn long, role string, text string")
    more = one.select("*", *[F.lit("x").alias(c) for c in ("c", "conv", "n", "rule", "key", "fault", "number", "block")])
    assert judged(damaged(more)).collect() == judged(damaged(one)).collect()


def test_least_string_of_equal_costs():
    assert cheapest(((1, 1), (1, 1))) == search(["", ""], ["u", "u"])[1]
    assert cheapest(()) == ""
