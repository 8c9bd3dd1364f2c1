"""Repair of conversations: the cheapest edits that bring their roles into order, found by auction.

A conversation is a lattice: a node is a place between its rows together with what stands before
(nothing, a system, user or assistant turn), an arc is an edit with its whole-number cost. The
auction keeps a price on every node, never above an arc's cost plus the price behind it, and a
path of arcs where both are equal. The path's last node either goes on along such an arc, or
raises its price to the least it can and falls back by one. When the path meets a node whose
price has converged, all of its own have, and they are the costs of the way to the end. Origins
are taken from the last row backward, so each path is short. The arcs that the converged prices
make tight are all cheapest edits; taking the least letter at every node gives the least string.

Ordinary conversations stay in one group of a task. Long ones are cut into blocks: a block's
costs between its ends are 16 numbers, one sweep over these gives the prices at the blocks'
ends, and with them each block traces its edits for itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import lookup, written
from lakeops.operators.windows import ordered_numbers

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
KEEP, REROLE, DELETE, INSERT, UNTRUNCATED = 0, 3, 4, 3, 3
#: Rows of a conversation from which it is cut into blocks (or so many letters), and rows of a block.
LONG, BLOCK = 2048, 512
_LONG_CHARS = 1 << 24

_SPACE = " \t\n\x0b\x0c\r"
#: What stands before a place: nothing, a system, user or assistant turn. What an inserted or
#: reroled turn leads to, and what a kept one does, by the row's initial.
_NOTHING, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_KEPT = {0: {_NOTHING: _SYSTEM}, 1: {_NOTHING: _USER, _SYSTEM: _USER, _ASSISTANT: _USER}, 2: {_USER: _ASSISTANT}, 3: {}}
_LEGAL = {(0, 1), (1, 2), (2, 1)}
_GONE, _END, _CUT = 8, 9, 4
_FAR = 1 << 60
_LEADS = ({_NOTHING}, {_NOTHING, _SYSTEM}, {0, 1, 2, 3}, {0, 1, 2, 3})


def _arcs(step: tuple[int, int], state: int, here: int) -> list[tuple[str, int, int]]:
    """(letter, cost, node) of the edits at a node, letters ascending; `here` is the place's first node.

    A step is a row's initial (and _CUT if it is truncated), a run of rows that have to go, or the end.
    """
    kind, n = step
    insert = ("I", INSERT, here + _NEXT[state])
    if kind == _END:
        return [insert, *([("", 0, here + 4 + state)] if state in (_NOTHING, _ASSISTANT) else [])]
    out = [("D", DELETE * n, here + 4 + state), insert]
    if kind != _GONE:
        more = UNTRUNCATED if kind & _CUT else 0
        to = _KEPT[kind & 3].get(state)
        if to is not None:
            out.append(("K", KEEP + more, here + 4 + to))
        out.append(("R", REROLE + more, here + 4 + _NEXT[state]))
    return out


@lru_cache(maxsize=1024)
def _place(kind: int, n: int) -> list[list[tuple[str, int, int]]]:
    """The arcs of a place's four nodes, to these and the next place's."""
    return [_arcs((kind, n), s, 0) for s in range(4)]


def auction(origin: int, arcs: Callable[[int], list[tuple[str, int, int]]], price: list[int], done: list[bool]) -> None:
    """Raise the prices until the origin's is the cost of its cheapest way to a node that is done."""
    path = [origin]
    while not done[path[-1]]:
        node = path[-1]
        best, to = min((cost + price[j], j) for _, cost, j in arcs(node))
        if price[node] >= best and best < _FAR:
            path.append(to)
            continue
        price[node] = min(best, _FAR)
        if best >= _FAR:
            done[node] = True
        if len(path) > 1:
            path.pop()
    if price[path[-1]] < _FAR:
        for node in path:
            done[node] = True


@lru_cache(maxsize=64)
def prices(steps: tuple[tuple[int, int], ...], ends: tuple[int, ...]) -> list[int]:
    """Costs from every node (place times four plus state) to the end, whose states cost `ends`."""
    n = len(steps)
    price = [0] * (4 * n) + list(ends)
    open_ = set().union(*(_LEADS[s] for s in range(4) if ends[s] < _FAR))
    for i in range(n - 1, -1, -1):
        # No way to the end is cheaper than from the best node behind, so prices start there.
        behind = price[4 * i + 4 : 4 * i + 8]
        least = min(behind)
        near = [least if s in open_ else _FAR for s in range(4)] + behind
        done = [s not in open_ for s in range(4)] + [True] * 4
        arcs = _place(*steps[i]).__getitem__
        for s in range(4):
            auction(s, arcs, near, done)
        price[4 * i : 4 * i + 4] = near[:4]
    return price


def traced(steps: tuple[tuple[int, int], ...], price: list[int], state: int) -> tuple[str, int]:
    """The least string of tight arcs from the beginning in this state, and the state it ends in."""
    letters, node = [], state
    while node < 4 * len(steps):
        i, s = divmod(node, 4)
        letter, _, to = next(arc for arc in _place(*steps[i])[s] if price[node] == arc[1] + price[4 * i + arc[2]])
        node = 4 * i + to
        letters.append(letter * steps[i][1] if letter == "D" else letter)
    return "".join(letters), node % 4


#: Costs behind the last row: what is missing has to be inserted.
_ENDS = tuple(prices(((_END, 1),), (0, _FAR, _FAR, 0))[:4])


@lru_cache(maxsize=65536)
def _remembered(steps: tuple[tuple[int, int], ...]) -> str:
    return _cheapest(steps)


def cheapest(steps: tuple[tuple[int, int], ...]) -> str:
    """Edits of a whole conversation; those of a few rows are remembered, as many conversations go alike."""
    return _remembered(steps) if len(steps) <= 16 else _cheapest(steps)


def _cheapest(steps: tuple[tuple[int, int], ...]) -> str:
    whole = (*steps, (_END, 1))
    return traced(whole, prices(whole, (0, _FAR, _FAR, 0)), _NOTHING)[0]


def _steps(rows: list[tuple[int, int, int]]) -> tuple[tuple[int, int], ...]:
    """Steps of rows (fault, initial, copies); copies of a row behind it are duplicates."""
    out: list[tuple[int, int]] = []
    for fault, initial, n in rows:
        gone = n
        if fault not in (BLANK, DUPLICATE):
            out.append((initial + (_CUT if fault == TRUNCATED else 0), 1))
            gone -= 1
        if gone and out and out[-1][0] == _GONE:
            out[-1] = (_GONE, out[-1][1] + gone)
        elif gone:
            out.append((_GONE, gone))
    return tuple(out)


class _Repaired:
    """One conversation, row by row, as the edits make it."""

    def __init__(self, conv):
        self.conv, self.state, self.place, self.cost = conv, _NOTHING, 0, 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.low = self.high = self.before = None
        self.turns_seen = 0
        self.audit: list[str] = []
        self.digest = hashlib.sha256()

    def _out(self, edit: str, turn, role: str, text: str):
        if edit != "D":
            self.digest.update(("\n" * (self.place > 0) + role + ":" + text).encode("utf-8", "surrogatepass"))
            self.place += 1
            return (self.conv, self.place, edit, turn, role, text)
        return None

    def _inserted(self):
        role = "assistant" if _NEXT[self.state] == _ASSISTANT else "user"
        self.state, self.cost = _NEXT[self.state], self.cost + INSERT
        return self._out("I", None, role, "")

    def row(self, letters: Iterator[str], turn, role: str, text: str, fault: int, initial: int, n: int):
        """Turns that this row's edits give; `letters` stands before them."""
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns_seen += turn != self.high
            self.high = turn
        self.blank += n * (fault == BLANK)
        self.duplicate += n if fault == DUPLICATE else (n - 1) * (fault != BLANK)
        self.truncated += fault == TRUNCATED
        self.illegal += n - 1
        if self.before is not None:
            self.illegal += (self.before, initial) not in _LEGAL
        self.before = initial
        while (edit := next(letters)) == "I":
            yield self._inserted()
        if edit == "R":
            role = "assistant" if _NEXT[self.state] == _ASSISTANT else "user"
            self.state = _NEXT[self.state]
        elif edit == "K":
            self.state = _KEPT[initial][self.state]
        self.cost += {"R": REROLE, "K": KEEP, "D": DELETE}[edit] + (UNTRUNCATED if edit != "D" and fault == TRUNCATED else 0)
        if edit != "D":
            yield self._out(edit, turn, role, text)
        for _ in range(n - 1):
            next(letters)
        self.cost += DELETE * (n - 1)

    def end(self, letters: Iterator[str]):
        for _ in letters:
            yield self._inserted()

    def summary(self):
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns_seen, (1 << 63) - 1)
        return (
            self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()
        )


_KEYED = ["c", "conv", "turn", "role", "text", "fault", "initial", "n"]
_SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_TURNS = ["place", "edit", "turn", "role", "text"]


def _groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[list[tuple]]:
    """Rows of each group in turn, from batches sorted by the keys; the list goes on being filled."""
    group, now = [], None
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in keys]
        for key, row in zip(zip(*columns), zip(*(c.to_pylist() for c in batch.columns))):
            if key != now and group:
                yield group
                group = []
            now = key
            group.append(row)
    if group:
        yield group


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096, most_chars: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    out, chars = [], 0
    for row in rows:
        out.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str))
        if len(out) == most or chars > most_chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out, chars = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _short(turns: bool, schema: pa.Schema):
    """Kernel over rows sorted by conversation -> summaries or repaired turns of whole conversations."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for group in _groups(batches, "c"):
            one = _Repaired(group[0][1])
            present = [r for r in group if r[7]]
            audit = cheapest(_steps([r[5:8] for r in present]))
            one.audit.append(audit)
            letters = iter(audit)
            for r in present:
                for out in one.row(letters, *r[2:8]):
                    if turns:
                        yield out
            for out in one.end(letters):
                if turns:
                    yield out
            if not turns:
                yield one.summary()

    return lambda batches: _batches(rows(batches), schema)


def _matrices(schema: pa.Schema):
    """Kernel (c, block, fault, initial, n) by block -> (c, block, costs): from each state before to each behind."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for group in _groups(batches, "c", "block"):
            steps = _steps([r[2:5] for r in group])
            columns = [prices(steps, tuple(0 if s == x else _FAR for s in range(4)))[:4] for x in range(4)]
            yield *group[0][:2], [columns[x][s] for s in range(4) for x in range(4)]

    return lambda batches: _batches(rows(batches), schema)


def _swept(schema: pa.Schema):
    """Kernel over blocks' costs, last block first -> (c, block, ends): prices behind each block."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        conversation, ends = None, _ENDS
        for batch in batches:
            for c, block, costs in zip(*(x.to_pylist() for x in batch.columns)):
                if c != conversation:
                    conversation, ends = c, _ENDS
                yield c, block, list(ends)
                price, done = [min(ends)] * 4 + list(ends), [False] * 4 + [True] * 4
                for s in range(4):
                    auction(s, lambda node, costs=costs: [("", costs[4 * node + x], 4 + x) for x in range(4)], price, done)
                ends = tuple(price[:4])

    return lambda batches: _batches(rows(batches), schema)


def _moves(schema: pa.Schema, block: int):
    """Kernel (c, block, fault, initial, n, ends) by block -> (c, number, moves): the block's edits
    from each state before it, and the number of its first row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for group in _groups(batches, "c", "block"):
            steps = _steps([r[2:5] for r in group])
            price = prices(steps, tuple(group[0][5]))
            yield group[0][0], group[0][1] * block + 1, [traced(steps, price, s)[0] if price[s] < _FAR else "" for s in range(4)]

    return lambda batches: _batches(rows(batches), schema)


def _streamed(turns: bool, schema: pa.Schema):
    """Kernel over rows sorted by conversation and number, with blocks' edits -> summaries or
    repaired turns. Only the running state is kept, whatever the conversation's length."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        one, c, letters = None, None, iter("")

        def closed():
            audit = "I" * (_ENDS[one.state] // INSERT)
            one.audit.append(audit)
            outs = list(one.end(iter(audit)))
            return outs if turns else [one.summary()]

        for batch in batches:
            for r in zip(*(x.to_pylist() for x in batch.columns)):
                if r[0] != c:
                    if one:
                        yield from closed()
                    one, c = _Repaired(r[1]), r[0]
                if r[8] is not None:
                    audit = r[8][one.state]
                    one.audit.append(audit)
                    letters = iter(audit)
                for out in one.row(letters, *r[2:8]):
                    if turns:
                        yield out
        if one:
            yield from closed()

    return lambda batches: _batches(rows(batches), schema)


def _text(column: str | Column) -> Column:
    return F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(" "))


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, n): faults put into rows by crc32 of `conv:turn` modulo 20.

    0 leaves the row out (n is 0, role and text null), 1 empties its text, 2 takes its sentence
    ends away, 3 repeats it (n is 2), 4 makes it a user's. Nulls count as one blank, in the key as
    well; a null turn stays null. Other columns are left out.
    """
    key = F.concat(_text(conv), F.lit(":"), _text(turn))
    rule = F.crc32(key.cast("binary")) % 20
    rows = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), _text(role).alias("role"), _text(text).alias("text"), rule.alias("rule")
    )
    gone, there = F.col("rule") == 0, F.col("rule") != 0
    return rows.select(
        "conv",
        F.when(there, F.col("turn")).alias("turn"),
        F.when(gone, F.lit(None)).when(F.col("rule") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone, F.lit(None)).when(F.col("rule") == 1, "").when(F.col("rule") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(gone, 0).when(F.col("rule") == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def _faulty(rows: DataFrame) -> DataFrame:
    """Distinct rows with their copies, fault and initial; the least turn of equal role and text is
    the first, blank rows aside."""
    same = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))
    c = F.when(F.col("conv").isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col("conv").cast("string")))
    rest = F.rtrim(F.col("text"), F.lit(_SPACE))
    initial = F.coalesce(F.array_position(F.lit(list("sua")), F.substring("role", 1, 1)) - 1, F.lit(3))
    key = F.sha2(F.concat_ws(":", "c", F.length("role"), "role", "text"), 256)
    same = same.withColumns({"c": c, "blank": rest == "", "whole": F.right(rest, F.lit(1)).isin(*".!?")})
    same = same.withColumns({"key": key, "initial": F.when(initial < 0, 3).otherwise(initial).cast("int")})
    same = written(same, "turns")
    first = F.min(F.struct("turn")).alias("first")
    firsts = written(same.groupBy("key").agg(first, F.count(F.lit(1)).alias("size")), "first-turns")
    known = lookup(same, firsts, "key", "size", max(1, same.count()))
    later = ~F.col("turn").eqNullSafe(F.col("first.turn"))
    fault = F.when(F.col("blank"), BLANK).when(later, DUPLICATE).when(~F.col("whole"), TRUNCATED).otherwise(0)
    # The role and the first letters decide between rows of one turn, then a digest.
    return known.select(*[k for k in _KEYED if k not in ("fault", "initial", "n")], F.coalesce(fault, F.lit(0)).cast("int").alias("fault"), "initial", "n",
                        F.substring("text", 1, 64).alias("head"), "key")


def _repaired(rows: DataFrame, turns: bool, long: int, block: int) -> DataFrame:
    kind = rows.schema["conv"].dataType
    out = T.StructType([T.StructField("conv", kind)])
    for name in _TURNS if turns else _SUMMARY:
        out.add(name, "string" if name in ("edit", "role", "text", "audit", "repaired_sha256") else "long")
    arrow = pa.schema([(f.name, _arrow(f.dataType)) for f in out])
    every = written(_faulty(rows), "faults")
    sizes = every.groupBy("c").agg(F.count(F.lit(1)).alias("size"), F.sum(F.length("text")).alias("chars"))
    sizes = written(sizes.withColumn("long", (F.col("size") >= long) | (F.coalesce("chars", F.lit(0)) >= _LONG_CHARS)), "lengths")
    order = ["turn", "role", "head", "key"]
    if sizes.filter("long").isEmpty():
        return every.repartition("c").sortWithinPartitions("c", *order).select(*_KEYED).mapInArrow(_short(turns, arrow), out)
    known = written(lookup(every, sizes, "c", "size", max(1, every.count())), "sized")
    short = known.filter("not long").repartition("c").sortWithinPartitions("c", *order).select(*_KEYED)
    present = known.filter("long and n > 0")
    numbered = ordered_numbers(present, ["c"], order, "number", all_large=True)
    numbered = written(numbered.select(*_KEYED, "number", F.expr(f"(number - 1) div {block}").alias("block")), "numbered")
    lattice = numbered.select("c", "block", "fault", "initial", "n", "number").repartition("c", "block")
    lattice = lattice.sortWithinPartitions("c", "block", "number").drop("number")
    costs = pa.schema([("c", pa.string()), ("block", pa.int64()), ("costs", pa.list_(pa.int64()))])
    cells = written(lattice.mapInArrow(_matrices(costs), "c string, block long, costs array<long>"), "block-costs")
    ends = pa.schema([("c", pa.string()), ("block", pa.int64()), ("ends", pa.list_(pa.int64()))])
    back = cells.repartition("c").sortWithinPartitions("c", F.desc("block"))
    behind = written(back.mapInArrow(_swept(ends), "c string, block long, ends array<long>"), "block-ends")
    again = numbered.select("c", "block", "fault", "initial", "n", "number").join(behind, ["c", "block"]).repartition("c", "block")
    again = again.sortWithinPartitions("c", "block", "number").select("c", "block", "fault", "initial", "n", "ends")
    found = pa.schema([("c", pa.string()), ("number", pa.int64()), ("moves", pa.list_(pa.string()))])
    moves = written(again.mapInArrow(_moves(found, block), "c string, number long, moves array<string>"), "block-moves")
    whole = numbered.join(moves, ["c", "number"], "left").repartition("c").sortWithinPartitions("c", "number").select(*_KEYED, "moves")
    return short.mapInArrow(_short(turns, arrow), out).unionByName(whole.mapInArrow(_streamed(turns, arrow), out))


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def judged(rows: DataFrame, long: int = LONG, block: int = BLOCK) -> DataFrame:
    """One row per conversation of rows (conv, turn, role, text, n): its faults, the cheapest edits and a digest.

    n counts copies of a row, 0 only names its conversation. Rows go by turn (nulls first), role,
    the text's first 64 characters and a digest. A row is blank without a character other than
    white space, duplicate if role and text were there before, truncated if it does not end in
    `.`, `!` or `?`: the first of these counts. Keep costs 0, Rerole to user or assistant 3, Delete
    4 (blank and duplicate rows have to go), Insert an empty user's or assistant's turn 3; truncated
    rows that stay cost 3 more. Roles have to read (s?(ua)+)? by their initials afterwards; an empty
    role has none that fits. `audit` are the edits' initials, of equal cost the least string.
    gaps: turns missing between the least and the greatest (beyond 64 bits the greatest long);
    illegal: neighbours other than su, ua, au; repaired_sha256: of the repaired `role:text` lines.
    Conversations without rows have zeros and the digest of an empty text; a null conversation is
    one of its own. Conversations of `long` rows or more are cut into blocks of `block`.
    """
    return _repaired(rows, False, long, block)


def repaired_turns(rows: DataFrame, long: int = LONG, block: int = BLOCK) -> DataFrame:
    """(conv, place, edit, turn, role, text): the turns of every conversation after the edits of `judged`."""
    return _repaired(rows, True, long, block)
