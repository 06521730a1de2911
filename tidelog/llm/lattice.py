"""LM scoring by a subword lattice.

An existing subword vocabulary gives the arcs: every piece that matches a stretch of a word is an arc,
bytes without a piece of their own are covered by byte pieces, and a forward recursion in log space
adds up the probability of all segmentations of the word. Pieces cannot cross white space, so the
lattice of a document is its words' lattices one after the other, and each distinct word is computed
once. The vocabulary's own scores (its merge ranks) start the piece scores; expectation maximisation
over the distinct training words seen twice or more fits them. Words end with a stop probability, so the scores are a
distribution over words.

Two more arcs span a word as a whole. One is the word as the training texts have it, with absolute
discounting: what it leaves over goes to the pieces. One is the word as this document already has
it, with weight ``ADAPT``. :func:`score` returns the marginal with (``score``) and without
(``piece_score``) the two.

Counts and scores of frequent words (at most ``FREQUENT``, a bound) go to every task; rare words meet
theirs in a join, and a document's parts are added up by document. No text is shuffled.

Defined results: a null or empty text is the end token alone. Repeated rows are scored alike, each on
its own. An empty training set gives N = V = 0 and a finite score.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import materialize

VOCABULARY = "piece_bpe_32k.model"
ROUNDS = 2
SMOOTHING = 0.1
DISCOUNT = 0.7
ADAPT = 0.2
FREQUENT = 1 << 18
PARTS = ["key", "hash", "held", "part", "word", "copies", "tokens", "known", "base", "score", "pieces", "seen"]
BLOCK_WORDS = 500_000  # of the documents that a task scores at once; a longer document is a block of its own
HELD_WORDS = 300_000  # of the counts a task holds before it hands them on
MARK = "▁".encode()
LN10 = math.log(10)


class Vocabulary:
    """Pieces as bytes: ``ids`` maps every piece to its id and every proper prefix of one to -1."""

    def __init__(self, file: str):
        import sentencepiece

        if "/" not in file:
            import public_tokenizers

            file = public_tokenizers.path(file)
        model = sentencepiece.SentencePieceProcessor(model_file=file)
        self.ids: dict[bytes, int] = {}
        self.starts = np.zeros(model.get_piece_size(), dtype=bool)
        self.usable = np.zeros(model.get_piece_size(), dtype=bool)
        self.rank = np.arange(1, model.get_piece_size() + 1, dtype=float)
        single = {}
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k).encode()
            if model.is_byte(k):
                single[bytes([int(piece[3:5], 16)])] = k
            elif not (model.is_control(k) or model.is_unknown(k)) and MARK not in piece[1:] and piece:
                self.ids[piece] = k
                self.rank[k] = 1 - model.get_score(k)
        for byte, k in single.items():
            self.ids.setdefault(byte, k)
        for piece, k in list(self.ids.items()):
            self.usable[k] = True
            self.starts[k] = piece.startswith(MARK)
            for n in range(1, len(piece)):
                self.ids.setdefault(piece[:n], -1)
        self.ids.setdefault(MARK, -1)


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(file: str) -> Vocabulary:
    if file not in _VOCABULARIES:
        _VOCABULARIES[file] = Vocabulary(file)
    return _VOCABULARIES[file]


class Pieces:
    """Natural log scores of pieces and of the stop, from expected counts."""

    def __init__(self, file: str, counts: np.ndarray | None = None, words: float = 0.0):
        v = vocabulary(file)
        self.file = file
        if counts is None:  # the vocabulary's own order: a piece's weight falls with its rank
            counts, words = 1.0 / v.rank, None
        counts = np.where(v.usable, counts + SMOOTHING / len(counts) if words is None else counts + SMOOTHING, 0.0)
        begin, inner = np.where(v.starts, counts, 0.0), np.where(v.starts, 0.0, counts)
        stop = 0.3 if words is None else (words + 1) / (words + 1 + inner.sum())
        with np.errstate(divide="ignore"):
            self.log = np.log(np.where(v.starts, begin / begin.sum(), (1 - stop) * inner / inner.sum()))
        self.stop = math.log(stop)


def _arcs(words: list[bytes], ids: dict[bytes, int]) -> np.ndarray:
    """Rows (word, from, to, piece) of every arc of every word."""
    look, flat = ids.get, []
    add = flat.extend
    for n, word in enumerate(words):
        word = MARK + word
        size = len(word)
        for i in (0, *range(len(MARK), size)):
            for j in range(i + 1, size + 1):
                k = look(word[i:j])
                if k is None:
                    break
                if k >= 0:
                    add((n, i, j, k))
    return np.array(flat, dtype=np.int64).reshape(-1, 4)


def _groups(words: list[bytes]):
    """Indices of words of like length, so that a group's table of positions is small."""
    order, group, width = sorted(range(len(words)), key=lambda n: len(words[n])), [], 0
    for n in order:
        size = len(words[n]) + 4
        if group and (size > 2 * width or size * len(group) > 200_000):
            yield group
            group = []
        if not group:
            width = size
        group.append(n)
    if group:
        yield group


def _recur(arcs, log, table, to, source):
    """table[word, to] = log-sum over arcs of table[word, source] + log[piece]; arcs sorted by (step, word)."""
    if not len(arcs):
        return
    cuts = np.flatnonzero(np.diff(arcs[:, to])) + 1
    for part in np.split(arcs, cuts):
        word = part[:, 0]
        first = np.concatenate(([0], np.flatnonzero(np.diff(word)) + 1))
        values = table[word, part[:, source]] + log[part[:, 3]]
        top = np.maximum.reduceat(values, first)
        spread = np.repeat(top, np.diff(np.concatenate((first, [len(word)]))))
        table[word[first], part[0, to]] = top + np.log(np.add.reduceat(np.exp(values - spread), first))


def marginals(words: list[bytes], pieces: Pieces, expected: np.ndarray | None = None) -> np.ndarray:
    """Natural log of each word's probability over all segmentations; with ``expected``, the expected
    counts of pieces are added to it."""
    ids, out = vocabulary(pieces.file).ids, np.zeros(len(words))
    for group in _groups(words):
        part = [words[n] for n in group]
        arcs = _arcs(part, ids)
        last = np.array([len(w) + len(MARK) for w in part])
        forward = np.full((len(part), last.max() + 1), -np.inf)
        forward[:, 0] = 0.0
        arcs = arcs[np.lexsort((arcs[:, 0], arcs[:, 2]))]
        _recur(arcs, pieces.log, forward, 2, 1)
        total = forward[np.arange(len(part)), last]
        out[group] = total + pieces.stop
        if expected is not None:
            back = np.full(forward.shape, -np.inf)
            back[np.arange(len(part)), last] = 0.0
            arcs = arcs[np.lexsort((arcs[:, 0], -arcs[:, 1]))]
            _recur(arcs, pieces.log, back, 1, 2)
            word, i, j, k = arcs.T
            weight = np.exp(forward[word, i] + pieces.log[k] + back[word, j] - total[word])
            expected += np.bincount(k, weights=weight, minlength=len(expected))
    return out


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case."""
    return (text or "").encode().lower().split()


def count_words(docs: DataFrame, text: str, held: str) -> DataFrame:
    """(word, n): every distinct word (binary) with its count in the rows that are not held out."""

    def run(batches):
        seen: Counter = Counter()

        def flush():
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), type=pa.binary()), pa.array(list(seen.values()), type=pa.int64())], names=["word", "n"])
            seen.clear()
            return made

        for batch in batches:
            for i in range(batch.num_rows):
                words = tokens(batch.column(0)[i].as_py())
                if batch.column(1)[i].as_py():
                    for w in words:
                        seen.setdefault(w, 0)
                else:
                    seen.update(words)
                if len(seen) > HELD_WORDS:
                    yield flush()
        yield flush()

    return docs.select(text, held).mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def fit_pieces(counts: DataFrame, file: str = VOCABULARY, rounds: int = ROUNDS) -> Pieces:
    """Piece scores after some rounds of expectation maximisation over the distinct training words that occur
    twice or more: most distinct words occur once, and many of those are accidents.

    Each task adds up the expected counts of its words; what comes back is one number per piece.
    """
    pieces = Pieces(file)
    words = counts.where("n > 1").select("word")
    n_words = words.count()
    for _ in range(rounds if n_words else 0):
        def run(batches, pieces=pieces):
            expected = np.zeros(len(pieces.log))
            for batch in batches:
                marginals(batch.column(0).to_pylist(), pieces, expected)
            used = np.flatnonzero(expected)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(expected[used])], names=["piece", "n"])

        rows = words.mapInArrow(run, "piece bigint, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        expected = np.zeros(len(pieces.log))
        for r in rows:
            expected[r["piece"]] = r["n"]
        pieces = Pieces(file, expected, n_words)
    return pieces


def score_words(counts: DataFrame, pieces: Pieces) -> DataFrame:
    """(word, n, log10 probability over all segmentations) of every distinct word."""

    def run(batches):
        for batch in batches:
            made = marginals(batch.column(0).to_pylist(), pieces) / LN10
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made)], names=["word", "n", "lattice"])

    return counts.select("word", "n").mapInArrow(run, "word binary, n bigint, lattice double")


def _threshold(counts: DataFrame, most: int) -> int:
    """The least of some counts, a tenth apart, such that at most ``most`` words are as frequent."""
    step = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(1.1)))
    rows = counts.where("n > 0").groupBy(step.alias("step")).agg(
        F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).collect()  # some hundred rows at most
    total, least = 0, 1 << 62
    for row in sorted(rows, key=lambda r: -r["step"]):
        total += row["words"]
        if total > most:
            break
        least = row["least"]
    return least


class Model:
    """Corpus totals and the weights of the arcs that span a word."""

    def __init__(self, ends: int, words: int, distinct: int):
        self.n, self.v = ends + words, distinct + (ends > 0)
        self.words = max(words, 1)
        self.ends = ends
        self.left = DISCOUNT * distinct / self.words if words else 1.0  # what discounting leaves to the pieces
        self.p_end = (ends + 0.5) / (self.n + 1.0)
        self.log_word = math.log10(1 - self.p_end)
        self.base_norm = math.log10(self.n + 0.5 * (self.v + 1))

    def base(self, n: Column) -> Column:
        return F.log10(n + F.lit(0.5)) - F.lit(self.base_norm)

    def static(self, n: int, lattice: float) -> float:
        return max(n - DISCOUNT, 0.0) / self.words + self.left * 10.0 ** lattice


class _Codes(dict):
    """Numbers of words: the given ones come first, any other gets the next number and is listed in ``fresh``."""

    def __init__(self, words: list[bytes]):
        super().__init__(zip(words, range(len(words))))
        self.given, self.fresh = len(words), []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number

    def forget(self) -> None:
        for word in self.fresh:
            del self[word]
        self.fresh = []


def _parts(rows, numbers: list[np.ndarray], codes: _Codes, base, static, lattice):
    """The parts of some documents, each given by its words' numbers: one row a document with the sums over
    its frequent words, and one for each rare word of it, with that word's share of the document so far at
    each of its places (-1 at the document's first place, where there is none)."""
    sizes = np.array([len(x) for x in numbers], dtype=np.int64)
    code = np.concatenate(numbers)
    doc = np.repeat(np.arange(len(numbers)), sizes)
    place = np.arange(len(code)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    # Sorted by word and place; places are in the order of documents, so a word's places in one of them are a run.
    bits = max(1, len(code).bit_length())
    order = np.sort((code << bits) | np.arange(len(code))) & ((1 << bits) - 1)
    code, doc, place = code[order], doc[order], place[order]
    first = np.ones(len(code), dtype=bool)
    first[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
    run = np.flatnonzero(first)
    before = np.arange(len(code)) - np.repeat(run, np.diff(np.append(run, len(code))))
    ratio = np.where(place > 0, before / np.maximum(place, 1), -1.0)

    often = int(np.searchsorted(code, codes.given))  # the frequent words come first
    weight = static[code[:often]]
    share = ratio[:often]
    full = np.log10(np.where(share < 0, weight, (1 - ADAPT) * weight + ADAPT * share))

    def by_document(values):
        return np.bincount(doc[:often], weights=values, minlength=len(numbers)).astype(float)  # of no words it is whole numbers

    whole = len(numbers)
    yield pa.RecordBatch.from_arrays(
        [rows.column(0), rows.column(3), rows.column(2), pa.array(np.ones(whole, dtype=np.int32)),
         rows.column(3).cast(pa.string()).cast(pa.binary()), pa.array(np.ones(whole, dtype=np.int64)), pa.array(sizes + 1),
         pa.array(np.bincount(doc[:often], minlength=whole)), pa.array(by_document(base[code[:often]])),
         pa.array(by_document(full)), pa.array(by_document(lattice[code[:often]])),
         pa.nulls(whole, pa.list_(pa.float64()))], names=PARTS)

    run = run[np.searchsorted(run, often):]
    if not len(run):
        return
    of, none, zero = pa.array(doc[run]), pa.array(np.zeros(len(run), dtype=np.int64)), pa.array(np.zeros(len(run)))
    word = pa.array(codes.fresh, type=pa.binary()).take(pa.array(code[run] - codes.given))
    seen = pa.ListArray.from_arrays(
        pa.array(np.append(run, len(code)) - often, type=pa.int32()), pa.array(ratio[often:]))
    yield pa.RecordBatch.from_arrays(
        [rows.column(0).take(of), rows.column(3).take(of), rows.column(2).take(of),
         pa.array(np.zeros(len(run), dtype=np.int32)), word, none, none, none, zero, zero, zero, seen], names=PARTS)


def score(docs: DataFrame, held: Column, key: str = "doc_id", text: str = "text", file: str = VOCABULARY) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score, piece_score) of every row.

    ``held`` marks rows that the model must not learn from. ``base_score`` is the add-half unigram.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(held, F.lit(False)).alias("held"),
                       F.xxhash64(text).alias("hash"))
    counts = materialize(count_words(rows, "text", "held"))
    totals = counts.agg(F.sum("n"), F.sum((F.col("n") > 0).cast("long"))).first()
    ends = rows.where("not held").count()
    model = Model(ends, totals[0] or 0, totals[1] or 0)
    scored = materialize(score_words(counts, fit_pieces(counts, file)))
    often = _threshold(scored, FREQUENT)
    frequent = scored.where(F.col("n") >= often).collect()  # FREQUENT rows at most
    lattices = np.array([r["lattice"] for r in frequent], dtype=float)
    known = docs.sparkSession.sparkContext.broadcast((
        [bytes(r["word"]) for r in frequent],
        np.array([math.log10(r["n"] + 0.5) - model.base_norm for r in frequent], dtype=float),
        np.array([model.static(r["n"], r["lattice"]) for r in frequent], dtype=float), lattices))
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        codes = _Codes(known.value[0])
        for batch in batches:
            at, numbers, total = 0, [], 0
            for i in range(batch.num_rows):
                words = tokens(batch.column(1)[i].as_py())
                numbers.append(np.fromiter(map(codes.__getitem__, words), dtype=np.int64, count=len(words)))
                total += len(words)
                if total > BLOCK_WORDS or i + 1 == batch.num_rows:
                    yield from _parts(batch.slice(at, len(numbers)), numbers, codes, *known.value[1:])
                    codes.forget()
                    at, numbers, total = i + 1, [], 0

    parts = rows.mapInArrow(run, f"key {kind}, hash bigint, held boolean, part int, word binary, copies bigint, "
                                 "tokens bigint, known bigint, base double, score double, pieces double, seen array<double>")
    # Rows of whole documents carry a hash in place of a word, so that they spread; only parts = 0 find a match.
    found = scored.where(F.col("n") < often).select(
        F.lit(0).alias("__part"), F.col("word").alias("__word"), "n", "lattice")
    parts = parts.join(found, (F.col("part") == F.col("__part")) & (F.col("word") == F.col("__word")), "left")
    static = F.greatest(F.col("n") - F.lit(DISCOUNT), F.lit(0.0)) / F.lit(float(model.words)) \
        + F.lit(model.left) * F.pow(F.lit(10.0), F.col("lattice"))
    # A long word's probability is 0 as a plain number, but not its logarithm.
    log_static = F.when(static > 0, F.log10(static)).otherwise(
        F.lit(math.log10(max(model.left, 1e-300))) + F.col("lattice"))

    def one(ratio: Column) -> Column:
        mixed = F.lit(1 - ADAPT) * static + F.lit(ADAPT) * ratio
        first = F.when(ratio < 0, log_static)
        return first.when(mixed > 0, F.log10(mixed)).otherwise(F.lit(math.log10(1 - ADAPT)) + log_static)

    rare = F.col("seen").isNotNull()
    many = F.size("seen")
    sums = parts.select(
        "key", "hash", "held", "copies", "tokens",
        F.when(rare, F.when(F.col("n") > 0, many).otherwise(0)).otherwise(F.col("known")).alias("known"),
        F.when(rare, many * model.base(F.coalesce("n", F.lit(0)))).otherwise(F.col("base")).alias("base"),
        F.when(rare, F.aggregate("seen", F.lit(0.0), lambda a, r: a + one(r))).otherwise(F.col("score")).alias("score"),
        F.when(rare, many * F.col("lattice")).otherwise(F.col("pieces")).alias("pieces"))
    sums = sums.groupBy("key", "hash", "held").agg(*[F.sum(c).alias(c) for c in (
        "copies", "tokens", "known", "base", "score", "pieces")])
    # Rows alike in key and text were added up together; each gets its share back.
    each = sums.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("__copy"))
    n_words = F.expr("tokens div copies") - 1
    end_base = math.log10(ends + 0.5) - model.base_norm
    log_end = math.log10(model.p_end)
    return each.select(
        F.col("key").alias(key), F.col("held").alias("held_out"), (n_words + 1).cast("long").alias("n_tokens"),
        (F.expr("known div copies") + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies") + F.lit(end_base)).alias("base_score"),
        (F.col("score") / F.col("copies") + n_words * F.lit(model.log_word) + F.lit(log_end)).alias("score"),
        (F.col("pieces") / F.col("copies") + n_words * F.lit(model.log_word) + F.lit(log_end)).alias("piece_score"))
