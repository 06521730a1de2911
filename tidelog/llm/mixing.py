"""Mixing sources to target weights by a time-varying curriculum.

Each source has a target number of words and a schedule: how densely it is drawn as training goes
from time 0 to 1. The integral of the schedule is the source's cumulative demand. A source's
documents, in a fixed random order, lie on the axis of that demand; the inverse of the integral
turns a document's place on the axis into its training position. Sorting by position mixes sources.

Only column expressions, grouping, joins, and windows. Running sums inside a source are taken over
hash bins of a bounded expected size and over the bins' sums, so a source with a third of all rows
is spread over as many tasks as its size asks for.

Defined results: a null text has size 0, and a document of size 0 takes nothing. A null source is a
source of its own, sorted last. Repeated rows and rows with equal ids are served one by one; a hash of
the whole row gives its place, so only rows alike in every column share a bin. Columns of the input
keep their names and values whatever they are called, but for the text that is cut and ``n_chars``. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import columns_but, materialize, row_hash, text_of, unit_hash, words

# Weights by rank of source, share of all words to take, most passes over a source.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
PASSES = 2.0

# Density of draws at equally spaced times, by weight class; linear in between, and above 0.
# The heaviest sources lead in, the lightest come to their full density late.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))

ROWS_PER_BIN = 4096
# The table of sources is broadcast up to this size, and joined by a sort and merge beyond it.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 8 << 20


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: float = PASSES) -> DataFrame:
    """One row per source: its ``source_size``, its rank, and its ``target``.

    ``sizes`` has (source, source_size, rows). Targets share ``share`` of all words by weight; a
    target stops at ``passes`` times its source, and the excess is shared anew by weight among the
    others until none is above. A target is min(cap, level * weight) for one level for all, the one
    at which they add up to the goal: sources sorted by cap / weight fill up one after the other, so
    the level follows from running sums of caps and of weights.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    rank = F.row_number().over(by_name) - 1
    pick = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    table = sizes.select(
        "source", "source_size", "rows", rank.alias("rank"), pick.alias("weight"),
        (F.col("source_size") * F.lit(passes)).alias("cap"))
    every = Window.partitionBy(F.lit(0))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    table = table.select(
        "*", (F.sum("source_size").over(every) * F.lit(share)).alias("goal"),
        F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("full"),
        F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)).alias("open_weight"))
    # The level as it would be if this source and all after it were the ones still open.
    table = table.withColumn("level", (F.col("goal") - F.col("full")) / F.col("open_weight"))
    is_open = F.col("level") * F.col("weight") <= F.col("cap")
    level = F.first(F.when(is_open, F.col("level")), ignorenulls=True).over(
        fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return table.select(
        "source", "source_size", "rows", "rank",
        F.coalesce(F.least("cap", level * F.col("weight")), F.col("cap")).alias("target"))


def _integral(values: tuple[float, ...]) -> list[float]:
    """The integral of the piecewise linear schedule up to each of its knots."""
    out = [0.0]
    for a, b in zip(values, values[1:]):
        out.append(out[-1] + (a + b) / 2 / (len(values) - 1))
    return out


def time_of(fraction: Column, rank: Column, schedules=SCHEDULES) -> Column:
    """The time at which a source has met a fraction of its demand: the inverse of the integral.

    Within a segment of width w from density a to b, the area up to x is a*x + (b-a)*x*x/(2w).
    """
    time = None
    for k, values in enumerate(schedules):
        sums, width = _integral(values), 1.0 / (len(values) - 1)
        area, segment = fraction * F.lit(sums[-1]), None
        for j in reversed(range(len(values) - 1)):
            a, slope = values[j], (values[j + 1] - values[j]) / width
            rest = area - F.lit(sums[j])
            x = (rest * 2 / (F.lit(a) + F.sqrt(F.greatest(F.lit(0.0), F.lit(a * a) + rest * F.lit(2 * slope)))))
            at = F.lit(j * width) + F.least(x, F.lit(width))
            segment = at if segment is None else F.when(area < F.lit(sums[j + 1]), at).otherwise(segment)
        test = rank % len(schedules) == k
        time = F.when(test, segment) if time is None else time.when(test, segment)
    return time


def plan(docs: DataFrame, key: str = "doc_id", size: str = "size", source: str = "source", seed: int = 9,
         rows_per_bin: int = ROWS_PER_BIN, **rules) -> DataFrame:
    """Append to each row ``source_size``, ``target`` (its source's), ``place`` (words of its source
    before it, in the source's random order), ``taken``, ``whole`` (passes that take all of it) and
    ``part`` (words of one more pass).

    A source's target, as whole words, is met exactly where that many words exist: all its rows are
    taken ``target div source_size`` times, and those at the start of its order once more, the row
    at the cut in part.
    """
    mine = ("source_size", "target", "place", "taken", "whole", "part", "rank", "__bin", "__u", "__n")
    source_of, size_of = F.col(source).alias("source"), F.col(size).cast("long").alias("source_size")
    sizes = docs.select(source_of, size_of).groupBy("source").agg(
        F.sum("source_size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    goal = materialize(targets(sizes, **rules).select(
        F.col("source").alias("__source"), "source_size", "target", "rank",
        F.greatest(F.lit(1), F.ceil(F.col("rows") / rows_per_bin)).alias("__n")))
    # Texts need not be shuffled by source, a hot key, while the table of sources is small.
    held = goal.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("__source")).alias("bytes")).first()
    if held["rows"] <= BROADCAST_ROWS and (held["bytes"] or 0) <= BROADCAST_BYTES:
        goal = F.broadcast(goal)
    u = unit_hash(seed, row_hash(docs, key, *mine))
    rows = docs.select(*columns_but(docs, *mine), u.alias("__u")).join(
        goal, F.col(source).eqNullSafe(F.col("__source")), "inner")
    rows = rows.withColumn("__bin", F.floor(F.col("__u") * F.col("__n")))
    before = Window.partitionBy("rank").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = rows.groupBy("rank", "__bin").agg(F.sum(size).alias("__sum")).select(
        F.col("rank").alias("__r"), F.col("__bin").alias("__b"),
        F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("rank", "__bin").orderBy("__u", key, size).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("place", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    rows = rows.join(bins, (F.col("rank") == F.col("__r")) & (F.col("__bin") == F.col("__b")), "inner")
    place = F.col("__before") + F.col("place")
    words = F.floor(F.col("target"))
    whole = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    part = F.greatest(F.lit(0), F.least(F.col(size), words - whole * F.col("source_size") - place)).cast("long")
    keep = columns_but(docs, *mine)
    return rows.select(
        *keep, "source_size", "target", "rank", place.alias("place"), whole.alias("whole"), part.alias("part"),
        (whole * F.col(size) + part).cast("long").alias("taken"))


def schedule(planned: DataFrame, size: str = "size", schedules=SCHEDULES, idle: bool = False) -> DataFrame:
    """One row per document and pass that takes words of it, with ``words`` (how many, from its
    start), ``pass``, and ``position`` in [0, 1]: the time at which its source's demand, in the
    order of passes and places, reaches the middle of its words. With ``idle``, a document that
    takes nothing has one row too, of no words and no position."""
    one = F.transform(
        F.sequence(F.lit(0), F.col("whole").cast("int")),
        lambda k: F.struct(k.alias("pass"), F.when(k < F.col("whole"), F.col(size)).otherwise(F.col("part")).alias("words")))
    keep = columns_but(planned, "pass", "words", "position", "__one")
    rows = planned.select(*keep, F.explode(one).alias("__one")).where(
        F.expr("__one.words > 0" + (" or taken = 0" if idle else "")))
    middle = F.col("__one.pass") * F.col("source_size") + F.col("place") + F.col("__one.words") / 2
    fraction = F.when(F.col("__one.words") > 0, F.least(F.lit(1.0), middle / F.col("target")))
    return rows.select(
        *keep, F.col("__one.pass").alias("pass"), F.col("__one.words").cast("long").alias("words"),
        time_of(fraction, F.col("rank"), schedules).alias("position"))


def first_words(text: Column, n: Column) -> Column:
    """A text up to the end of its first n words, white space as it is."""
    pieces = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    lead = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    start = F.array_join(F.slice(pieces, F.lit(1), (n + lead).cast("int")), "")
    return F.regexp_replace(start, r"(?<![\x20\x09-\x0D])[\x20\x09-\x0D]++$", "")


def ordered(docs: DataFrame, seed: int = 9, key: str = "doc_id", text: str = "text", source: str = "source",
            idle: bool = False, **rules) -> DataFrame:
    """The training order with its account: ``row`` (the row of ``docs``, its text cut where only part
    is taken), ``size``, ``source_size``, ``target``, ``place``, ``pass``, ``words`` and ``position``,
    range-sorted by position, ties by id and pass."""
    names = [n.replace("`", "``") for n in docs.columns]
    sized = docs.select(
        F.col(key).alias("__key"), F.col(source).alias("__of"), F.size(words(text_of(text))).cast("long").alias("size"),
        F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"))
    slots = schedule(plan(sized, "__key", "size", "__of", seed, **rules), idle=idle)
    whole = F.col(f"row.`{text}`")
    slots = slots.withColumn("__cut", F.when(F.col("words") < F.col("size"), first_words(whole, F.col("words"))).otherwise(whole))
    made = {text: F.col("__cut"), "n_chars": F.length("__cut").cast("long")}
    row = F.struct(*[made.get(n, F.col(f"row.`{n}`")).alias(n) for n in names])
    slots = slots.select("__key", row.alias("row"), "size", "source_size", "target", "place", "pass", "words", "position")
    return slots.repartitionByRange("position", "__key", "pass").sortWithinPartitions("position", "__key", "pass")


def mix(docs: DataFrame, seed: int = 9, key: str = "doc_id", text: str = "text", source: str = "source", **rules) -> DataFrame:
    """The training order: the rows of ``docs``, each as often as it is taken, cut where only part of
    it is, range-sorted by position (ties by id and pass). Columns of ``docs`` only."""
    return ordered(docs, seed, key, text, source, **rules).select("row.*")
