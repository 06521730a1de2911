"""Personal data by bootstrapped contextual extraction.

Seeds are what fixed forms find: emails, IPv4 addresses, card numbers that pass Luhn's test, phone
numbers. The words around a seed are a lexical pattern. Other strings that look like identifiers
(with an @ or several digits) are instances of the patterns they stand in, too. Over the graph of
patterns and instances, scores go to and fro for some rounds: a pattern's confidence in a kind is
the share of its distinct instances that are of that kind, known ones in full and others by belief;
an instance's belief is the mean confidence of its patterns. Patterns with enough distinct seeds and
a high confidence then name unseen identifiers.

Only column expressions, grouping, and joins. Patterns and instances are counted as distinct values,
so copies of a document weigh nothing, and no group of the graph is gathered: aggregates combine
before the shuffle. Only a document's own spans come together.

The forms are written so that a text of any length is matched in linear time and without recursion:
runs are possessive and start where a run starts, or where the last match ended.

Defined results: a null text is empty: no spans. Spans are code points, end exclusive. Repeated rows
get the same spans each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import columns_but, materialize, text_of

# The kinds in order, and the form of each.
KINDS = ("email", "ip", "card", "phone")
FORMS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
# Strings that may be identifiers, seeds or not: with an @ or at least MIN_DIGITS digits.
LOOKS = r"(?<![A-Za-z0-9@._+-])(?=[A-Za-z._+-]*+[0-9@])[A-Za-z0-9@._+-]++"
MIN_DIGITS = 4

CONTEXT = 48  # characters on each side in which the words of a pattern are looked for
CHUNK = 64  # elements of an array that are folded in one go
LAST = 2**31 - 1
ROUNDS = 3
MIN_SEEDS = 3  # distinct seeds of a kind that a pattern must have
CONFIDENT = 0.8


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes: from the right, every second digit counts double."""
    back = F.reverse(digits)

    def worth(i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), lambda a, i: a + worth(i))
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return ~value.rlike(r"(?:^|\.)0*+(?:[1-9][0-9]{3}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])")
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _chunks(values: Column, use) -> Column:
    """An array's slices of CHUNK elements, each as use(slice, its number); none of an empty array."""
    numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int"))
    made = F.transform(numbers, lambda c: use(F.slice(values, c * CHUNK + 1, F.lit(CHUNK)), c))
    return F.when(F.size(values) > 0, made).otherwise(F.slice(made, F.lit(1), F.lit(0)))


def _running(values: Column, start: int, merge) -> Column:
    """``start`` merged with the first 0, 1, ... all integers of an array.

    An array that is built element by element is copied for each of them, so only the results inside
    a chunk and those of the chunks are built that way.
    """
    def fold(array: Column, first: Column) -> Column:
        return F.aggregate(array, F.array(first), lambda done, x: F.concat(done, F.array(merge(F.element_at(done, -1), x))))

    first = F.lit(start)

    def all_of(given: Column) -> Column:
        totals = _chunks(given, lambda part, c: F.aggregate(part, first, merge))
        return _let(fold(totals, first), lambda firsts: F.concat(
            F.flatten(_chunks(given, lambda part, c: F.slice(fold(part, F.get(firsts, c)), F.lit(1), F.size(part)))),
            F.array(F.element_at(firsts, -1))))

    return _let(values, all_of)


def _apart(base: Column, others: Column) -> Column:
    """The spans of ``others`` that overlap none of ``base``, in their order of start."""
    def least(array: Column, flag: int) -> Column:
        index = (lambda s, i: i) if flag else (lambda s, i: F.lit(0))
        return F.transform(array, lambda s, i: F.struct(
            s["start"].alias("start"), F.lit(flag).alias("other"), s["end"].alias("end"), index(s, i).alias("index")))

    def look(given: Column) -> Column:
        ends = F.transform(given, lambda s: F.when(s["other"] == 0, s["end"]).otherwise(F.lit(0)))
        starts = F.transform(F.reverse(given), lambda s: F.when(s["other"] == 0, s["start"]).otherwise(F.lit(LAST)))
        return _let(_running(ends, 0, lambda a, x: F.greatest(a, x)), lambda end: _let(
            _running(starts, LAST, lambda a, x: F.least(a, x)), lambda start: F.filter(given, lambda s, i: (
                (s["other"] == 1) & (F.get(end, i) <= s["start"]) & (F.get(start, F.size(given) - 1 - i) >= s["end"])))))

    free = _let(F.sort_array(F.concat(least(base, 0), least(others, 1))), look)
    return F.when(F.size(base) == 0, others).otherwise(_let(others, lambda all_: F.transform(
        free, lambda s: F.get(all_, s["index"]))))


def _located(found: Column, pieces: Column) -> Column:
    """Matches with their places: what lies between matches, and the matches, alternate in a text.

    An array of (value, start, end, before, after); the last two are the nearby text.
    """
    empty = F.expr("cast(array() as array<struct<value: string, start: int, end: int, before: string, after: string>>)")

    def one(at: Column):
        def made(value, k):
            start = F.get(at, k) + F.length(F.get(pieces, k))
            return F.struct(
                value.alias("value"), start.alias("start"), (start + F.length(value)).alias("end"),
                F.right(F.get(pieces, k), F.lit(CONTEXT)).alias("before"),
                F.left(F.get(pieces, k + 1), F.lit(CONTEXT)).alias("after"))
        return made

    steps = F.transform(found, lambda value, k: F.length(F.get(pieces, k)) + F.length(value))
    located = _let(_running(steps, 0, lambda a, x: a + x), lambda at: F.transform(found, one(at)))
    return F.when(F.size(found) > 0, located).otherwise(empty)


def _named(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"), s["value"].alias("value"),
        s["before"].alias("before"), s["after"].alias("after")))


def seeds(docs: DataFrame, text: str = "text") -> DataFrame:
    """Append ``__seeds``: an array of (start, kind, end, value, before, after) of the four forms in
    order, and ``__looks``, the same without kind of other strings that look like identifiers."""
    keep = [F.col(f"`{c}`") for c in docs.columns]
    body = text_of(text)
    forms = {**FORMS, "looks": LOOKS}
    needs = {**NEEDS, "looks": "[0-9@]"}
    none = F.expr("cast(array() as array<string>)")
    table = docs.select(*keep, *[
        F.when(body.rlike(needs[k]), F.regexp_extract_all(body, F.lit(form), F.lit(0))).otherwise(none).alias(f"__f_{k}")
        for k, form in forms.items()])
    table = table.select(*keep, *[f"__f_{k}" for k in forms], *[
        F.when(F.size(f"__f_{k}") > 0, F.split(body, form)).otherwise(none).alias(f"__p_{k}") for k, form in forms.items()])
    table = table.select(*keep, *[_located(F.col(f"__f_{k}"), F.col(f"__p_{k}")).alias(f"__l_{k}") for k in forms])

    def valid(kind: str) -> Column:
        return F.filter(f"__l_{kind}", lambda s: _valid(kind, s["value"]))

    named = [_named(valid(k), n) for n, k in enumerate(KINDS)]

    def bare(s):
        value = F.trim(s["value"], F.lit("._+-"))
        lead = F.length(s["value"]) - F.length(F.ltrim(s["value"], F.lit("._+-")))
        return F.struct(
            (s["start"] + lead).alias("start"), (s["start"] + lead + F.length(value)).alias("end"), value.alias("value"),
            s["before"].alias("before"), s["after"].alias("after"))

    likely = F.filter(F.transform("__l_looks", bare), lambda s: (
        (F.length(_digits(s["value"])) >= MIN_DIGITS) | s["value"].contains("@")) & ~s["value"].rlike(
        f"{FORMS['email']}|{FORMS['ip']}") & ~s["value"].rlike(r"^[0-9]{14,19}$"))
    table = table.select(*keep, F.sort_array(F.concat(*named)).alias("__seeds"), likely.alias("__likely"))
    # What stands in a seed, such as the last digits of a phone number, is no instance of its own.
    return table.select(*keep, "__seeds", _apart(F.col("__seeds"), F.col("__likely")).alias("__looks"))


def _patterns(before: Column, after: Column) -> Column:
    """The lexical patterns of a mention: two words before it; the word before and the word after it."""
    left = F.split(F.lower(F.regexp_replace(F.trim(before), "[0-9]+", "0")), r"[\x20\x09-\x0D]+")
    right = F.split(F.lower(F.regexp_replace(F.trim(after), "[0-9]+", "0")), r"[\x20\x09-\x0D]+")
    one, two, nxt = F.element_at(left, -1), F.try_element_at(left, F.lit(-2)), F.element_at(right, 1)
    made = F.array(
        F.when((one != "") & (two != ""), F.concat_ws(" ", two, one, F.lit("_"))),
        F.when((one != "") & (nxt != ""), F.concat_ws(" ", one, F.lit("_"), nxt)))
    return F.array_compact(made)


def _score(edges: DataFrame, rounds: int) -> tuple[DataFrame, DataFrame]:
    """Patterns and beliefs after some rounds over the graph.

    ``edges`` is distinct (pattern, value, kind); kind is null for what is no seed. Returns
    (pattern, c0..c3) and (value, b0..b3) of the values that are no seeds.
    """
    kinds = range(len(KINDS))
    unknown = edges.where("kind is null").select("pattern", "value")
    known = edges.groupBy("pattern").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum((F.col("kind") == k).cast("long")).alias(f"s{k}") for k in kinds])
    known = known.select("pattern", "n", *[F.coalesce(f"s{k}", F.lit(0)).alias(f"s{k}") for k in kinds])
    # Without enough seeds of any kind a pattern is sure of nothing, whatever its other instances are.
    known = materialize(known.where(F.greatest(*[f"s{k}" for k in kinds]) >= MIN_SEEDS))

    def confidence(beliefs: DataFrame | None) -> DataFrame:
        table = known
        if beliefs is not None:
            more = unknown.join(beliefs, "value").groupBy("pattern").agg(*[F.sum(f"b{k}").alias(f"b{k}") for k in kinds])
            table = known.join(more, "pattern", "left")
        return table.select("pattern", *[
            F.when(F.col(f"s{k}") >= MIN_SEEDS,
                   (F.col(f"s{k}") + (F.coalesce(f"b{k}", F.lit(0.0)) if beliefs is not None else F.lit(0.0))) / F.col("n"))
            .otherwise(F.lit(0.0)).alias(f"c{k}") for k in kinds])

    def belief(patterns: DataFrame) -> DataFrame:
        scored = unknown.join(patterns, "pattern", "left").groupBy("value").agg(
            *[(F.sum(F.coalesce(f"c{k}", F.lit(0.0))) / F.count(F.lit(1))).alias(f"b{k}") for k in kinds])
        return scored.where(F.greatest(*[f"b{k}" for k in kinds]) > 0)

    patterns, beliefs = confidence(None), None
    for _ in range(rounds):
        beliefs = materialize(belief(patterns))
        patterns = materialize(confidence(beliefs))
    return patterns, beliefs


def discover(found: DataFrame, rounds: int = ROUNDS, confident: float = CONFIDENT) -> DataFrame:
    """(__key, start, kind, end) of the unseen identifiers in ``found`` (__key, __seeds, __looks)."""
    seeded = found.select(F.inline("__seeds")).select(
        F.explode(_patterns(F.col("before"), F.col("after"))).alias("pattern"), F.lower("value").alias("value"), "kind")
    looks = found.select("__key", F.inline("__looks")).select(
        "__key", "start", "end", F.lower("value").alias("value"), _patterns(F.col("before"), F.col("after")).alias("patterns"))
    looks = looks.select("__key", "start", "end", "value", F.explode("patterns").alias("pattern"))
    edges = seeded.distinct().unionByName(looks.select("pattern", "value", F.lit(None).cast("int").alias("kind")).distinct())
    patterns, beliefs = _score(materialize(edges), rounds)
    if beliefs is None:
        beliefs = patterns.select(F.lit(None).cast("string").alias("value")).limit(0)
    kinds = range(len(KINDS))
    best = F.greatest(*[f"c{k}" for k in kinds])
    kind = F.coalesce(*[F.when(F.col(f"c{k}") == best, F.lit(k)) for k in kinds])
    sure = patterns.where(best >= confident).select("pattern", kind.alias("kind"))
    likely = beliefs.select("value", F.array(*[f"b{k}" for k in kinds]).alias("belief"))
    hits = looks.join(sure, "pattern").join(likely, "value").where(F.get("belief", F.col("kind")) >= confident / 2)
    return hits.groupBy("__key", "start", "end").agg(F.min("kind").alias("kind"))


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS,
           confident: float = CONFIDENT) -> DataFrame:
    """(key, base, spans) of every row: arrays of (start, kind, end), kinds by number, in order.

    ``base`` has what the forms find; ``spans`` has it and what the patterns add. An added span that
    would overlap a base span is left out.
    """
    row = F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("text"))
    found = seeds(docs.select(F.col(key), F.col(text)), text)
    found = materialize(found.select(row.alias("__key"), "__seeds", "__looks"))
    base = F.transform("__seeds", lambda s: F.struct(s["start"], s["kind"], s["end"]))
    added = discover(found, rounds, confident).groupBy("__key").agg(
        F.collect_set(F.struct("start", "kind", "end")).alias("__added"))
    rows = found.select("__key", base.alias("base")).join(
        added.withColumnRenamed("__key", "__added_key"), F.col("__key").eqNullSafe(F.col("__added_key")), "left")
    free = _apart(F.col("base"), F.col("__added"))
    spans = F.when(F.col("__added").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", free)))
    return rows.select(F.col("__key"), F.col("__key.key").alias(key), "base", spans.alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` with every span replaced by its kind in brackets; a column ``n_chars`` is
    brought up to date. Overlapping spans become one, of the first one's kind."""
    mine = ("__key", "__spans", "__clean")
    row = F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("text"))
    found = detect(docs, key, text, **how).where(F.size("spans") > 0)
    found = found.select(F.col("__key").alias("__found"), F.col("spans").alias("__spans")).dropDuplicates(["__found"])
    rows = docs.select(*columns_but(docs, *mine), row.alias("__key")).join(
        found, F.col("__key").eqNullSafe(F.col("__found")), "left")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    spans, whole = F.col("__spans"), F.col(text)

    def cut_with(at: Column) -> Column:
        """``at``: where the spans before each one end. A text is cut by chunks of spans first, since
        finding a place takes a walk from the start."""
        def cut_chunk(part: Column, c: Column) -> Column:
            first = c * CHUNK
            low, high = F.get(at, first), F.get(at, first + F.size(part))

            def cut_one(piece: Column):
                def one(s, i):
                    here = F.get(at, first + i)
                    between = F.substring(piece, here - low + 1, F.greatest(here, s["start"]) - here)
                    return F.concat(between, F.when(s["start"] < here, F.lit("")).otherwise(F.get(names, s["kind"])))
                return one

            return _let(F.substring(whole, low + 1, high - low), lambda piece: F.array_join(F.transform(part, cut_one(piece)), ""))

        last = F.element_at(at, -1)
        return F.concat(
            F.array_join(_chunks(spans, cut_chunk), ""), F.substring(whole, last + 1, F.length(whole) - last))

    cut = _let(_running(F.transform(spans, lambda s: s["end"]), 0, lambda a, x: F.greatest(a, x)), cut_with)
    clean = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(cut)
    rows = rows.select(*columns_but(docs, *mine, text), clean.alias("__clean"))
    columns = [F.col("__clean").alias(c) if c == text else F.length("__clean").cast("long").alias(c) if c == "n_chars"
               else F.col(f"`{c}`") for c in docs.columns if c.lower() not in mine]
    return rows.select(*columns)
