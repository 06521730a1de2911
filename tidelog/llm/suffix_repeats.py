"""Substring dedup by the common-prefix interval tree of enhanced suffix arrays.

A byte goes when a string of ``least`` bytes that covers it also starts in a document with a smaller
key. Every string of that length has an anchor, the leftmost least hash among its short grams, so
equal strings share their anchor and meet under its hash. Starts in a row with one anchor are a run;
the bytes they span are the run's context.

Documents are dealt into groups by ranges of their keys, so the order of groups decides between
them and no key travels with an anchor. The steps, all joined by anchor or by group:

1. each group sends its distinct (anchor hash, context hash) once;
2. windows over the anchors find contexts that an earlier group has too (they go whole), and anchors
   that have several contexts in several groups: only of those are the contexts themselves sent;
3. per anchor, all suffixes of its contexts are sorted, and a stack scan over the common prefixes of
   neighbours walks the interval tree. An interval whose suffixes do not all continue to the left by one
   byte is a maximal repeat: every occurrence in a group that is not the first is covered by it;
4. each group meets its answers, finds the repeats within itself the same way (there the keys
   decide), and cuts its texts.

An anchor with over ``MOST_CONTEXTS`` rows is not gathered: each of its strings becomes a key of its
own, whose rows are one a group at most. A key that fills several groups is dealt over them by its texts.
Context hashes are compared by 96 bits (the anchor's 64 and 32 more), everything else by bytes.

Defined results: null texts count as empty and keep nothing. A null key counts as the greatest key;
documents with equal keys never remove bytes from each other. Rows alike come out alike, each on
its own. Texts shorter than ``least`` bytes are kept. An empty table gives no rows. ``kept``
may end inside a character, so it is binary. Columns of the input named like a result are left out.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import columns_but

LEAST = 50
GROUP_BYTES = 16 << 20  # of text in a group, more where there would be over MOST_GROUPS of them
MOST_GROUPS = 1 << 20  # the task closures hold one key for each
MOST_CONTEXTS = 4096
STEP = 1 << 20  # bytes that are hashed at a time
SUB_BITS = 11  # of a group's number: its part of a key that fills several groups
MADE = ("n_bytes", "n_removed", "n_spans", "spans", "kept")
WHOLE, KNOWN = -1, -2  # in place of a start: a whole context, answers that are known
_LOW = np.int64(0xFFFFFFFF)


@cache
def _tables():
    """Random values of bytes, powers of an odd number, and their inverses (modulo 2**64)."""
    odd, n = 0x9E3779B97F4A7C15, STEP + 4096
    values = np.random.default_rng(13).integers(0, 1 << 64, 256, dtype=np.uint64)
    powers, inverses = np.full(n, odd, np.uint64), np.full(n, pow(odd, -1, 1 << 64), np.uint64)
    powers[0] = inverses[0] = 1
    return values, np.cumprod(powers), np.cumprod(inverses)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two."""
    return _mix(a.view(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + b.view(np.uint64))


def runs(data: np.ndarray, offsets: np.ndarray, least: int):
    """(anchor hash, context hash, first start, starts, document) of every run, as arrays.

    ``data`` is the documents' bytes on end, ``offsets`` where each begins and the last ends. A run that
    crosses a multiple of STEP counts as two.
    """
    values, powers, inverses = _tables()
    k = max(1, least // 3)
    span, found = least - k + 1, []
    for x in range(0, max(0, len(data) - least + 1), STEP):
        part = data[x:x + STEP + least - 1]
        m = len(part)
        starts = m - least + 1
        sums = np.zeros(m + 1, np.uint64)
        np.cumsum(values[part] * powers[:m], out=sums[1:])
        grams = _mix((sums[k:] - sums[:-k]) * inverses[:m - k + 1])
        low = np.uint64((1 << 21) - 1)
        least_of, width = (grams & ~low) | np.arange(len(grams), dtype=np.uint64), 1
        while 2 * width <= span:
            least_of = np.minimum(least_of[:-width], least_of[width:])
            width *= 2
        if width < span:
            least_of = np.minimum(least_of[:len(least_of) - (span - width)], least_of[span - width:])
        at = (least_of & low).astype(np.int64)
        # Starts in the last bytes of a document have no whole string.
        ends = offsets[1:][(offsets[1:] > x) & (offsets[1:] < x + m)] - x
        step = np.zeros(starts + 1, np.int32)
        np.add.at(step, np.clip(ends - least + 1, 0, starts), 1)
        np.add.at(step, np.clip(ends, 0, starts), -1)
        valid = np.flatnonzero(np.cumsum(step[:-1]) == 0)
        if not len(valid):
            continue
        at = at[valid]
        first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)])
        begin, count = valid[first], np.diff(np.r_[first, len(valid)])
        last = begin + count - 1
        whole = _join(_mix((sums[begin + least] - sums[begin]) * inverses[begin]),
                      _mix((sums[last + least] - sums[last]) * inverses[last]))
        whole = _join(whole, count.astype(np.uint64))
        found.append((grams[at[first]].view(np.int64), whole.view(np.int64), begin + x, count,
                      np.searchsorted(offsets, begin + x, "right") - 1))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(c).astype(np.int64) for c in zip(*found))


def _gather(data: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``width`` bytes from each place on; ``data`` reaches that far."""
    return np.lib.stride_tricks.sliding_window_view(data, width)[places]


def _words(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as 64-bit numbers that sort like the bytes."""
    short = -rows.shape[1] % 8
    if short:
        rows = np.pad(rows, ((0, 0), (0, short)))
    return np.ascontiguousarray(rows).view(">u8").astype(np.uint64)


def intervals(lcp: list[int], left: list[int], ranks: list[int], least: int):
    """(common prefix, first, last, least rank) of the maximal repeats with occurrences of unlike rank.

    ``lcp[i]`` is the common prefix of suffixes i - 1 and i, ``left[i]`` the byte before suffix i. A stack holds the
    open intervals of the tree, each with what it must know of its suffixes.
    """
    stack: list[list[int]] = []  # prefix, first, least rank, greatest rank, left byte, left bytes differ
    n = len(left)
    for i in range(1, n + 1):
        shared = lcp[i] if i < n and lcp[i] >= least else 0
        node = [0, i - 1, ranks[i - 1], ranks[i - 1], left[i - 1], 0]
        while stack and stack[-1][0] > shared:
            top = stack.pop()
            _merge(top, node)
            if top[5] and top[2] < top[3]:
                yield top[0], top[1], i - 1, top[2]
            node = top
        if shared:
            if stack and stack[-1][0] == shared:
                _merge(stack[-1], node)
            else:
                node[0] = shared
                stack.append(node)


def _merge(into: list[int], node: list[int]) -> None:
    into[2] = min(into[2], node[2])
    into[3] = max(into[3], node[3])
    into[5] |= node[5] | (into[4] != node[4])


def covered(groups: np.ndarray, ranks: np.ndarray, data: np.ndarray, begin: np.ndarray, count: np.ndarray, least: int,
            at_once: int = 100_000) -> np.ndarray:
    """A bit for each start of each context: whether its string also starts in a context of the same
    group with a lower rank. Contexts lie in ``data`` from ``begin`` on and have ``count`` starts (63 at most)."""
    masks = np.zeros(len(groups), np.uint64)
    if not len(groups):
        return masks
    widest = int(count.max()) + least - 1
    data = np.concatenate([data, np.zeros(widest + 8, np.uint8)])
    # Suffixes whose first bytes are theirs alone lie in no interval.
    parts, some = [], max(1, at_once // int(count.max()))
    for x in range(0, len(groups), some):
        c = count[x:x + some]
        owner = np.repeat(np.arange(x, x + len(c)), c)
        shift = np.arange(len(owner)) - np.repeat(np.cumsum(c) - c, c)
        words = _words(_gather(data, begin[owner] + shift, least))
        key = groups[owner].view(np.uint64)
        for column in words.T:
            key = _join(key, np.ascontiguousarray(column))
        parts.append((owner, shift, key))
    owner, shift, key = (np.concatenate(p) for p in zip(*parts))
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
    of = ranks[owner[order]]
    unlike = np.minimum.reduceat(of, first) < np.maximum.reduceat(of, first)
    picked = order[np.repeat(unlike, np.diff(np.r_[first, len(order)]))]
    if not len(picked):
        return masks
    owner, shift = owner[picked], shift[picked]
    order = np.argsort(groups[owner], kind="stable")
    owner, shift = owner[order], shift[order]
    edges = np.r_[np.flatnonzero(np.r_[True, groups[owner][1:] != groups[owner][:-1]]), len(owner)]
    x = 0
    while x < len(owner):  # whole groups at a time
        end = int(edges[max(np.searchsorted(edges, x + at_once, "right") - 1, np.searchsorted(edges, x, "right"))])
        _scan(groups, ranks, data, begin, count, owner[x:end], shift[x:end], least, widest, masks)
        x = end
    return masks


def _scan(groups, ranks, data, begin, count, owner, shift, least, widest, masks) -> None:
    """Sort the suffixes, find the common prefixes, walk the tree, and set the bits of what it covers."""
    room = count[owner] - shift + least - 1
    rows = _gather(data, begin[owner] + shift, widest).copy()
    rows[np.arange(widest) >= room[:, None]] = 0
    words = _words(rows)
    order = np.lexsort((room, *words.T[::-1], groups[owner]))
    owner, shift, room, rows = owner[order], shift[order], room[order], rows[order]
    same = rows[1:] == rows[:-1]
    lcp = np.where(same.all(axis=1), widest, same.argmin(axis=1))
    lcp = np.minimum(lcp, np.minimum(room[1:], room[:-1]))
    lcp[groups[owner[1:]] != groups[owner[:-1]]] = 0
    before = np.where(shift > 0, data[begin[owner] + shift - 1].astype(np.int64), -1 - np.arange(len(owner)))
    of = ranks[owner]
    reach = np.zeros(len(owner), np.int64)
    for shared, lo, hi, least_rank in intervals([0, *lcp.tolist()], before.tolist(), of.tolist(), least):
        part = reach[lo:hi + 1]
        np.maximum(part, np.where(of[lo:hi + 1] > least_rank, shared, 0), out=part)
    hit = np.flatnonzero(reach)
    bits = (np.uint64(1) << (reach[hit] - least + 1).astype(np.uint64)) - np.uint64(1)
    np.bitwise_or.at(masks, owner[hit], bits << shift[hit].astype(np.uint64))


def _classes(anchor: np.ndarray, context: np.ndarray, ranks: np.ndarray):
    """Runs alike in anchor and context: (a run of the least rank of each class, class of each run)."""
    name = _join(anchor, context)
    order = np.lexsort((ranks, name))
    new = np.r_[True, name[order][1:] != name[order][:-1]] if len(order) else np.zeros(0, bool)
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], of


def _within(anchor, context, ranks, data, begin, count, least) -> np.ndarray:
    """The bits of ``covered`` for every run, all runs being at hand."""
    full = np.uint64((1 << 64) - 1)
    rep, of = _classes(anchor, context, ranks)
    masks = np.zeros(len(rep), np.uint64)
    if len(rep):
        order = np.argsort(anchor[rep], kind="stable")
        a, r = anchor[rep][order], ranks[rep][order]
        first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        unlike = np.minimum.reduceat(r, first) < np.maximum.reduceat(r, first)
        some = order[np.repeat(unlike, np.diff(np.r_[first, len(a)]))]
        masks[some] = covered(anchor[rep][some], ranks[rep][some], data, begin[rep][some], count[rep][some], least)
    return np.where(ranks > ranks[rep][of], full, masks[of]) if len(rep) else np.zeros(0, np.uint64)


def _texts(table: pa.Table, key: str, text: str):
    """The documents' bytes on end, their offsets, and their keys."""
    column = table[text].combine_chunks() if table.num_rows else pa.array([], pa.string())
    column = (column.chunk(0) if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary()).fill_null(b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset:column.offset + len(column) + 1]
    size = int(offsets[-1]) if len(column) else 0
    data = np.frombuffer(buffers[2], np.uint8)[:size] if size else np.zeros(0, np.uint8)
    keys = table[key].cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy()
    return data[offsets[0]:] if len(column) else data, offsets - offsets[0] if len(column) else np.zeros(1, np.int64), keys


def _dealt(docs: DataFrame, key: str, text: str, group_bytes: int) -> DataFrame:
    """The documents with their group: ranges of keys in ``__group`` >> SUB_BITS, in the keys' order."""
    size = docs.agg(F.sum(F.octet_length(text).cast("bigint"))).first()[0] or 0
    n = min(MOST_GROUPS, size // group_bytes + 1)
    cuts = None
    if n > 1:
        cuts = docs.agg(F.percentile_approx(
            F.coalesce(F.col(key).cast("bigint"), F.lit((1 << 63) - 1)), [i / n for i in range(1, n)], max(10_000, 10 * n))).first()[0]
    cuts, times = np.unique(np.array(cuts or [], np.int64), return_counts=True)
    inner = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def deal(batches):
        import xxhash

        for batch in batches:
            keys = batch.column(key).cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
            group = 2 * np.searchsorted(cuts, keys)
            if len(cuts):
                at = np.minimum(group // 2, len(cuts) - 1)
                hot = (cuts[at] == keys) & (times[at] > 1)
                group = (group + hot) << SUB_BITS
                for i in np.flatnonzero(hot):
                    body = batch.column(text)[int(i)].as_py() or ""
                    group[i] += xxhash.xxh32_intdigest(body) % min(int(times[at[i]]), 1 << SUB_BITS)
            yield pa.RecordBatch.from_arrays([pa.array(group, pa.int64()), *batch.columns], names=["__group", *batch.schema.names])

    return docs.mapInArrow(deal, f"__group bigint{', ' + inner if inner else ''}")


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, group_bytes: int = GROUP_BYTES,
          most_contexts: int = MOST_CONTEXTS) -> DataFrame:
    """The rows of ``docs`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (start:end of each
    removed run, in bytes, comma-joined) and ``kept`` (the remaining bytes)."""
    docs = docs.select(*columns_but(docs, *MADE))
    dealt = _dealt(docs, key, text, group_bytes)

    def distinct(table: pa.Table) -> pa.Table:
        data, offsets, _ = _texts(table, key, text)
        anchor, context, *_rest = runs(data, offsets, least)
        context &= _LOW
        rep, _of = _classes(anchor, context, np.zeros(len(anchor), np.int64))
        group = table["__group"][0].as_py() if table.num_rows else 0
        return pa.table({"a": anchor[rep], "cg": (context[rep] << 32) | group})

    met = dealt.groupBy("__group").applyInArrow(distinct, "a bigint, cg bigint").select(
        "a", F.shiftright("cg", 32).cast("int").alias("c"), F.col("cg").bitwiseAND(0xFFFFFFFF).alias("g"))
    rank, one, alike = F.shiftright("g", SUB_BITS), Window.partitionBy("a"), Window.partitionBy("a", "c")
    met = met.select(
        "*", F.min(rank).over(one).alias("lo"), F.max(rank).over(one).alias("hi"), F.count(F.lit(1)).over(one).alias("n"),
        (F.min("c").over(one) < F.max("c").over(one)).alias("several"), F.min(rank).over(alike).alias("first")).where("lo < hi")
    # 1: an earlier group has the same context; 2 and 3: contexts must be compared, all of an anchor's or string by string.
    kind = F.when(F.col("first") < rank, 1).when(F.col("several"), F.when(F.col("n") <= most_contexts, 2).otherwise(3))
    met = met.select(F.col("g").alias("__group"), "a", "c", kind.alias("kind")).where("kind is not null")

    def contexts(table: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["key", "a", "c", "g", "shift", "context"]
        if not asked.num_rows:
            return pa.table([pa.array([], t) for t in _TYPES], names=names)
        data, offsets, _ = _texts(table, key, text)
        anchor, context, begin, count, _doc = runs(data, offsets, least)
        context &= _LOW
        rep, _of = _classes(anchor, context, np.zeros(len(anchor), np.int64))
        name = _join(anchor[rep], context[rep])
        order = np.argsort(name)
        a, c, kinds = (asked[x].to_numpy().astype(np.int64) for x in ("a", "c", "kind"))
        group, known = table["__group"][0].as_py(), kinds == 1
        told = a[known].tobytes() + c[known].astype(np.int32).tobytes()
        a, c, kinds = a[~known], c[~known], kinds[~known]
        at = rep[order[np.searchsorted(name[order], _join(a, c & _LOW))]]
        each = np.where(kinds == 3, count[at], 1)  # rows that an answer needs
        row = np.repeat(np.arange(len(at)), each)
        shift = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
        single = kinds[row] == 3
        place = begin[at][row] + shift
        size = np.where(single, least, count[at][row] + least - 1)
        keys = a[row].copy()
        if single.any():
            words = _words(_gather(data, place[single], least))
            own = a[row][single].view(np.uint64)
            for column in words.T:
                own = _join(own, np.ascontiguousarray(column))
            keys[single] = own.view(np.int64)
        bodies = [data[p:p + s].tobytes() for p, s in zip(place.tolist(), size.tolist())]
        columns = keys, a[row], c[row].astype(np.int32), np.full(len(row), group), np.where(single, shift, WHOLE).astype(np.int32)
        rows = pa.table([*[pa.array(x, t) for x, t in zip(columns, _TYPES)], pa.array(bodies, pa.binary())], names=names)
        if not told:
            return rows
        whose = int(_mix(np.array([group], np.uint64)).view(np.int64)[0])
        known = pa.table([pa.array([x], t) for x, t in zip((whose, 0, 0, group, KNOWN, told), _TYPES)], names=names)
        return pa.concat_tables([rows, known])

    # Answers that are known already come along, packed in one row of their group, so that the windows are worked out once.
    sent = dealt.groupBy("__group").cogroup(met.groupBy("__group")).applyInArrow(
        contexts, "key bigint, a bigint, c int, g bigint, shift int, context binary")

    def answers(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            keys = rows["key"].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            held = rows.slice(cut)  # the last key may go on
            if cut:
                yield _answered(rows.slice(0, cut), least)
        if held is not None and held.num_rows:
            yield _answered(held, least)

    replies = sent.repartition("key").sortWithinPartitions("key").mapInArrow(
        answers, "__group bigint, a bigint, c int, mask bigint, known binary")

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        data, offsets, keys = _texts(table, key, text)
        anchor, context, begin, count, doc = runs(data, offsets, least)
        masks = _within(anchor, context, keys[doc], data, begin, count, least)
        if replies.num_rows and len(anchor):
            (known, told), mine = _told(replies), _join(anchor, context & _LOW)
            at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            masks = np.where(known[at] == mine, masks | told[at], masks)
        return _cut(table, data, offsets, begin, count, masks, least)

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields)
    return dealt.groupBy("__group").cogroup(replies.groupBy("__group")).applyInArrow(
        cut, schema + "n_bytes bigint, n_removed bigint, n_spans bigint, spans string, kept binary")


_TYPES = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())


def _answered(rows: pa.Table, least: int) -> pa.RecordBatch:
    """What the contexts of whole keys cover of each other, as bits of each context's starts."""
    column = rows["context"].combine_chunks()
    column = (column.chunk(0) if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    group, shift, size = rows["g"].to_numpy(), rows["shift"].to_numpy(), np.diff(offsets)
    ask = np.flatnonzero(shift != KNOWN)
    masks = np.zeros(rows.num_rows, np.uint64)
    masks[ask] = covered(
        rows["key"].to_numpy()[ask], group[ask] >> SUB_BITS, data, offsets[:-1][ask], size[ask] - least + 1, least)
    masks <<= np.maximum(shift, 0).astype(np.uint64)
    hit = np.flatnonzero((masks != 0) | (shift == KNOWN))
    known = pa.array([column[i].as_py() if shift[i] == KNOWN else None for i in hit.tolist()], pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(group[hit]), pa.array(rows["a"].to_numpy()[hit]), pa.array(rows["c"].to_numpy()[hit]),
         pa.array(masks[hit].view(np.int64)), known], names=["__group", "a", "c", "mask", "known"])


def _told(replies: pa.Table):
    """(hash of anchor and context, bits) of every answer a group got."""
    full = np.uint64((1 << 64) - 1)
    a, c, masks = [replies["a"].to_numpy()], [replies["c"].to_numpy()], [replies["mask"].to_numpy().view(np.uint64)]
    for packed in replies["known"].drop_null().to_pylist():
        n = len(packed) // 12
        a.append(np.frombuffer(packed, np.int64, n))
        c.append(np.frombuffer(packed, np.int32, n, 8 * n))
        masks.append(np.full(n, full))
    name, masks = _join(np.concatenate(a), np.concatenate(c).astype(np.int64) & _LOW), np.concatenate(masks)
    order = np.argsort(name, kind="stable")
    first = np.flatnonzero(np.r_[True, name[order][1:] != name[order][:-1]])
    return name[order][first], np.bitwise_or.reduceat(masks[order], first)


def _cut(table, data, offsets, begin, count, masks, least) -> pa.Table:
    """The documents without the bytes that the runs' masks cover."""
    bits = np.minimum(count, 63).astype(np.uint64)
    every = (np.uint64(1) << bits) - np.uint64(1)
    masks = masks & every
    whole = masks == every
    edge = np.zeros(len(data) + 1, np.int32)
    np.add.at(edge, begin[whole], 1)
    np.add.at(edge, begin[whole] + count[whole] - 1 + least, -1)
    some = np.flatnonzero((masks != 0) & ~whole)
    for j in range(int(count[some].max()) if len(some) else 0):
        at = begin[some[(masks[some] >> np.uint64(j)) & np.uint64(1) == 1]] + j
        np.add.at(edge, at, 1)
        np.add.at(edge, at + least, -1)
    gone = np.cumsum(edge[:-1]) > 0
    size = np.diff(offsets)
    change = gone.copy()  # where a removed run begins: no run crosses from one document into the next
    change[1:] &= ~gone[:-1]
    starts_at = offsets[:-1][(size > 0)]
    change[starts_at] = gone[starts_at]
    stop = gone.copy()
    stop[:-1] &= ~gone[1:]
    stop[offsets[1:][size > 0] - 1] = gone[offsets[1:][size > 0] - 1]
    lo, hi = np.flatnonzero(change), np.flatnonzero(stop) + 1
    doc = np.searchsorted(offsets, lo, "right") - 1
    n = len(size)
    n_spans = np.bincount(doc, minlength=n).astype(np.int64)
    n_removed = np.bincount(doc, weights=(hi - lo), minlength=n).astype(np.int64)
    told = [""] * n
    ends = np.cumsum(n_spans)
    for i in np.flatnonzero(n_spans).tolist():
        a, b = int(ends[i] - n_spans[i]), int(ends[i])
        told[i] = ",".join(f"{x}:{y}" for x, y in zip((lo[a:b] - offsets[i]).tolist(), (hi[a:b] - offsets[i]).tolist()))
    left = data[~gone].tobytes()
    cuts = np.r_[0, np.cumsum(size - n_removed)].tolist()
    kept = pa.array([left[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary())
    names = [c for c in table.column_names if c != "__group"]
    return pa.table([*[table[c] for c in names], pa.array(size), pa.array(n_removed), pa.array(n_spans),
                     pa.array(told, pa.string()), kept], names=[*names, *MADE])
