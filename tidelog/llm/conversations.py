"""Repair of conversations by bidirectional Dijkstra over the edit lattice.

A conversation is to read ``(s?(ua)+)?`` by the initials of its roles. A node of the lattice is (rows consumed,
what was read last); edges keep a row, give it the role user or assistant, delete it, or insert an empty turn. One
heap grows from the first node, one from the last; when both have met, every crossing that can still cost
no more is finished, and of the cheapest the least audit (initials of the edits, in order) wins. Of paths to a
node only the least by (cost, audit) lives: an audit of the same rows and cost is never the beginning of another.

Rows come sorted and are read as a stream. A conversation is taken in blocks of ``BLOCK`` rows: for
each entry and exit of a block the search gives cost and audit, and a label for each exit keeps the best way there
with the hash of the text so far. So a conversation of any length needs one block and four labels, and its audit, in
memory. All its rows do pass through one task, for the hash of its text has to read them in order.

Defined results: nulls in ``role`` and ``text`` are a space; rows without a turn come first; rows of one turn go
by role, then text. Rows alike are rows of their own, the later ones duplicates. A null conversation id is a
conversation. An empty table gives no rows. Other columns of the input are not returned.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 256
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
BLANK, DUPLICATE, TRUNCATED = "b", "d", "t"
START, SYSTEM, USER, ASSISTANT = range(4)  # what was read last
NEXT = {(START, "s"): SYSTEM, (USER, "a"): ASSISTANT, **{(q, "u"): USER for q in (START, SYSTEM, ASSISTANT)}}
ENDS = (START, ASSISTANT)
SPEAKS = {USER: "user", ASSISTANT: "assistant"}
CHAINS = {USER: "assistant", START: "user", SYSTEM: "user", ASSISTANT: "user"}  # the only turn that may be made next


def _steps(rows: str, faults: str, node: tuple[int, int]):
    """(cost, edit, next node) of every edge from a node. No insertion follows the last row but in ``_tail``."""
    i, q = node
    if i == len(rows):
        return
    made = NEXT[q, CHAINS[q][0]]
    yield INSERT_COST, INSERT, (i, made)
    yield DELETE_COST, DELETE, (i + 1, q)
    if faults[i] in (BLANK, DUPLICATE):
        return
    more = TRUNCATED_COST if faults[i] == TRUNCATED else 0
    if (q, rows[i]) in NEXT:
        yield more, KEEP, (i + 1, NEXT[q, rows[i]])
    yield more + REROLE_COST, REROLE, (i + 1, made)


@lru_cache(1 << 16)
def _block(rows: str, faults: str, entry: int, exit: int):
    """(cost, audit) of the cheapest way through a block, least by audit; None where there is none."""
    n = len(rows)
    back: dict[tuple[int, int], list] = {}
    for i in range(n):
        for q in range(4):
            for cost, edit, to in _steps(rows, faults, (i, q)):
                back.setdefault(to, []).append((cost, edit, (i, q)))

    def forward(node):
        return _steps(rows, faults, node)

    def backward(node):
        return back.get(node, ())

    # A heap's entries go by cost, then by rows consumed: an edge without cost leads one row on, so a node is final when popped.
    sides = [({(0, entry): (0, "")}, {}, [(0, 0, (0, entry))], forward), ({(n, exit): (0, "")}, {}, [(0, 0, (n, exit))], backward)]
    best = None
    while sides[0][2] and sides[1][2]:
        if best is not None and sides[0][2][0][0] + sides[1][2][0][0] > best[0]:
            break
        side = 0 if sides[0][2][0][0] <= sides[1][2][0][0] else 1
        found, done, heap, edges = sides[side]
        other = sides[1 - side][1]
        cost, _, node = heappop(heap)
        if node in done:
            continue
        done[node] = label = found[node]
        if node in other:
            best = _less(best, _crossing(side, label, 0, "", other[node]))
        for more, edit, to in edges(node):
            if to in other:
                best = _less(best, _crossing(side, label, more, edit, other[to]))
            reached = (cost + more, label[1] + edit if side == 0 else edit + label[1])
            if to not in done and (to not in found or reached < found[to]):
                found[to] = reached
                heappush(heap, (reached[0], to[0] if side == 0 else n - to[0], to))
    return best


def _crossing(side, label, more, edit, far):
    audit = label[1] + edit + far[1] if side == 0 else far[1] + edit + label[1]
    return label[0] + more + far[0], audit


def _less(a, b):
    return b if a is None or b < a else a


def _tail(q: int):
    """(cost, insertions) that end a conversation after its last row."""
    return {START: (0, 0), ASSISTANT: (0, 0), USER: (INSERT_COST, 1), SYSTEM: (2 * INSERT_COST, 2)}[q]


class _Label:
    """The best way to a node between blocks: cost, its audit's parts, its place among the labels' audits, the text so far."""

    def __init__(self, cost=0, parts=None, place=0, text=None, state=START):
        self.cost, self.parts, self.place, self.text, self.state = cost, parts, place, text or _Text(), state


class _Text:
    """Lines of ``role:text``, hashed and, where asked for, kept."""

    def __init__(self, keep: bool = False):
        self.hash, self.lines, self.empty = hashlib.sha256(), [] if keep else None, True

    def copy(self):
        new = _Text.__new__(_Text)
        new.hash, new.empty = self.hash.copy(), self.empty
        new.lines = None if self.lines is None else list(self.lines)
        return new

    def add(self, role: str, text: str) -> None:
        line = f"{role}:{text}"
        self.hash.update((line if self.empty else "\n" + line).encode("utf-8", "surrogatepass"))
        self.empty = False
        if self.lines is not None:
            self.lines.append(line)


def _edited(text: _Text, state: int, audit: str, rows: list) -> int:
    """Write what an audit makes of some rows; returns what was read last."""
    i = 0
    for edit in audit:
        if edit == KEEP:
            state = NEXT[state, rows[i][0][:1]]
            text.add(*rows[i])
        elif edit in (REROLE, INSERT):
            speaker = CHAINS[state]
            state = NEXT[state, speaker[0]]
            text.add(speaker, rows[i][1] if edit == REROLE else "")
        i += edit != INSERT
    return state


class _Conversation:
    """One conversation, row after row."""

    def __init__(self, key, keep: bool):
        self.key, self.keep = key, keep
        self.rows: list[tuple[str, str]] = []
        self.faults: list[str] = []
        self.labels = {START: _Label(text=_Text(keep))}
        self.counts = dict.fromkeys((BLANK, DUPLICATE, TRUNCATED, ""), 0)
        self.illegal, self.before = 0, None
        self.turns, self.least, self.last = 0, None, None

    def add(self, turn, role: str, text: str, fault: str) -> None:
        if turn is not None and turn != self.last:
            self.turns += 1
            self.least = turn if self.least is None else self.least
            self.last = turn
        self.counts[fault] += 1
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        self.rows.append((role, text))
        self.faults.append(fault)
        if len(self.rows) == BLOCK:
            self._close()

    def _close(self) -> None:
        if not self.rows:
            return
        initials = "".join(r[:1] if r[:1] in ("s", "u", "a") else "?" for r, _ in self.rows)
        faults = "".join(f or "-" for f in self.faults)
        ways: dict[int, tuple] = {}
        for entry, label in self.labels.items():
            for exit in range(4):
                way = _block(initials, faults, entry, exit)
                if way is not None:
                    offered = (label.cost + way[0], label.place, way[1], entry)
                    if exit not in ways or offered < ways[exit]:
                        ways[exit] = offered
        places = {exit: i for i, exit in enumerate(sorted(ways, key=lambda x: ways[x][1:3]))}
        labels = {}
        for exit, (cost, _, audit, entry) in ways.items():
            come = self.labels[entry]
            text = come.text.copy()
            _edited(text, entry, audit, self.rows)
            labels[exit] = _Label(cost, (come.parts, audit), places[exit], text, exit)
        self.labels, self.rows, self.faults = labels, [], []

    def result(self) -> tuple:
        self._close()
        ends = []
        for q, label in self.labels.items():
            cost, made = _tail(q)
            # Labels differ before their ends, so their places decide between equal costs.
            ends.append((label.cost + cost, label.place, INSERT * made, q))
        cost, _, tail, q = min(ends)
        label = self.labels[q]
        _edited(label.text, q, tail, [])
        parts, at = [tail], label.parts
        while at:
            at, part = at
            parts.append(part)
        gaps = 0 if self.least is None else self.last - self.least + 1 - self.turns
        return (self.key, gaps, *(self.counts[f] for f in (BLANK, DUPLICATE, TRUNCATED)), self.illegal, cost,
                "".join(reversed(parts)), label.text.hash.hexdigest(), "\n".join(label.text.lines) if self.keep else None)


def damage(rows: DataFrame) -> DataFrame:
    """The rows of conversations with faults put in: (conv_id, turn, role, text, gone), ``gone`` for rows that were dropped."""
    def plain(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), kind.alias("__kind"))
    text = F.when(F.col("__kind") == 1, "").when(F.col("__kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("__kind") == 3, 2).otherwise(1)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("__kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (F.col("__kind") == 0).alias("gone"), times.alias("__copy")).drop("__copy")


def repair(rows: DataFrame, keep_text: bool = False) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, repaired) of each conversation;
    ``repaired`` is null unless ``keep_text``. A boolean column ``gone`` marks rows that only name their conversation."""
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    kind, turn = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))

    def plain(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(" "))

    rows = rows.select("conv_id", F.col("turn").alias("turn"), plain("role").alias("role"), plain("text").alias("text"), gone.alias("gone"))
    rows = rows.repartition("conv_id")
    # The same shuffle serves: copies of a row share its conversation.
    nth = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    fault = F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(F.col("__nth") > 1, DUPLICATE).when(
        ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED).otherwise("")
    rows = rows.withColumn("__nth", nth).select("conv_id", "turn", "role", "text", "gone", fault.alias("fault"), "__nth")
    rows = rows.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "__nth").drop("__nth")
    key_type: list[pa.DataType] = []

    def run(batches):
        now, out = None, []

        def emit():
            columns = list(zip(*out)) if out else [[]] * 10
            types = [key_type[0], *[pa.int64()] * 6, *[pa.string()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=_NAMES)

        for batch in batches:
            key_type[:] = [batch.schema.field(0).type]
            for key, turn, role, text, gone, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or key != now.key:
                    if now is not None:
                        out.append(now.result())
                    now = _Conversation(key, keep_text)
                if not gone:
                    now.add(turn, role, text, fault)
            if len(out) > 1000:
                yield emit()
                out = []
        if now is not None:
            out.append(now.result())
            yield emit()

    numbers = ", ".join(f"{c} bigint" for c in _NAMES[1:7])
    return rows.mapInArrow(run, f"conv_id {kind}, {numbers}, audit string, repaired_sha256 string, repaired string")


_NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "repaired"]
