"""Sum-of-squares online packing of tokenized documents into windows.

Each task streams its documents: what is left of a document after its full windows goes to the fill
level that minimises the sum, over levels, of the squared count of windows filled up to there. The
counts are one array of window length; a placement looks at every level at once. A task's windows
that are still open at its end (or once there are many) are filled up by cutting their pieces, so a
task pads one window at most.

Nothing is shuffled, and a task holds one batch of texts and its open windows.

Defined results: a null text is empty and gives one piece, the end id alone. Repeated rows are packed
each on their own. An empty table gives no pieces. Other columns are left out.
"""

from __future__ import annotations

import gc
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 4096
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
MAX_OPEN = 1024  # open windows a task keeps, at most; beyond, they are filled up from each other
ENDS = ".,;:!?#*$%&|"  # punctuation that stands at the end of words
CACHE_WORDS = 800_000  # of the map from a word to its ids, which starts anew when full


class _Words(dict):
    """Ids of words, made at the first look at each and kept until there are too many."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self._encoder, self._cores, self._ends = encoder, {}, {}

    def __missing__(self, word: str) -> bytes:
        if len(self) > CACHE_WORDS:
            self.forget()
        encoder = self._encoder
        core = word.rstrip(ENDS)
        if not (core.isalpha() and encoder.by_letters):
            made = encoder.whole(word)
        else:
            if core.isascii():
                core, plain = core.lower(), True
            else:
                plain = core == core.lower() and unicodedata.is_normalized("NFC", core)
            if plain:
                made = self._cores.get(core)
                if made is None:
                    self._cores[core] = made = encoder.letters(core)
                if len(core) < len(word):
                    end = word[len(core):]
                    tail = self._ends.get(end)
                    if tail is None:
                        self._ends[end] = tail = encoder.whole(end)
                    made += tail
            else:
                made = encoder.whole(word)
        self[word] = made
        return made

    def forget(self) -> None:
        self.clear()
        self._cores.clear()
        self._ends.clear()


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes.

    A vocabulary that drops white space never joins what white space separates: the ids of a text
    are those of its words, one after another, and each word is encoded once and then looked up.
    One that also cuts letters from punctuation is asked for the letters alone, past its
    normalization, which leaves letters as they are. Samples tell which kind a file is; texts for
    any other are encoded whole.
    """

    # Words that tell the kinds of vocabularies apart.
    SAMPLES = ("the", "Thand", "été", "Ünd", "ser,", "x1", "don't", "a.b", "ñandú!!", "ßtz?", "5%", "###", "it...", "Zu&&&")

    def __init__(self, file: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(file)
        self._model = self._tokenizer.model
        self._bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self._spelt: dict[int, str] = {}  # code points beyond ASCII as the vocabulary spells them
        joined = "  ".join(self.SAMPLES) + " \n" + " ".join(self.SAMPLES)
        self.by_word = self.whole(joined) == b"".join(self.whole(w) for w in self.SAMPLES) * 2
        self.by_letters = self.by_word
        self.by_letters = self.by_word and all(_Words(self)[w] == self.whole(w) for w in self.SAMPLES)
        self._words = _Words(self)

    def whole(self, text: str) -> bytes:
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def letters(self, core: str) -> bytes:
        """Ids of a run of letters."""
        if not core.isascii():
            for c in core:
                if not c.isascii() and ord(c) not in self._spelt:
                    self._spelt[ord(c)] = self._bytes_of(c)[0][0]
            core = core.translate(self._spelt)
        return array("I", [t.id for t in self._model.tokenize(core)]).tobytes()

    def forget(self) -> None:
        """Drop the words met so far, up to some 200 MB: a worker process outlives its tasks, and what it
        keeps stands beside whatever runs in the executor next."""
        self._words.forget()

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [self.whole(t) for t in texts]
        look = self._words.__getitem__
        return [b"".join(map(look, t.replace("\n", " ").split(" "))) for t in texts]


_ENCODERS: dict[str, Encoder] = {}


def encoder(file: str) -> Encoder:
    """The worker process's encoder of a tokenizer file: a path, or the name of an installed public one."""
    if file not in _ENCODERS:
        if "/" in file:
            path = file
        else:
            import public_tokenizers

            path = public_tokenizers.path(file)
        _ENCODERS[file] = Encoder(path)
    return _ENCODERS[file]


class Windows:
    """Windows under construction, by fill level. Pieces are (key, start, ids, tokens of the document)."""

    def __init__(self, length: int, first_id: int):
        self.length, self.next_id = length, first_id
        self.count = np.zeros(length, dtype=np.int64)  # of open windows at each level
        self.at: dict[int, list[list[tuple]]] = {}
        self.n_open = 0

    def level_for(self, size: int) -> int:
        """The level (0: a new window) where a piece raises the sum of squares least; the fullest of equals."""
        below, n = self.count, self.length
        best, least = 0, 2 * below[size] + 1
        open_ = below[1:n - size]
        if len(open_):
            change = np.where(open_ > 0, 2 * (below[size + 1:] - open_) + 2, np.iinfo(np.int64).max)
            k = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[k] <= least:
                best, least = k + 1, change[k]
        fit = n - size
        if below[fit] and 1 - 2 * below[fit] <= least:
            best = fit
        return best

    def put(self, piece: tuple) -> Iterator[tuple[int, list[tuple]]]:
        """Place a piece; yields the windows that are finished by it."""
        size = len(piece[2]) // 4
        if size == self.length:
            yield self._close([piece])
            return
        level = self.level_for(size)
        window = self.at[level].pop() if level else []
        if level:
            self.count[level] -= 1
            self.n_open -= 1
        window.append(piece)
        if level + size == self.length:
            yield self._close(window)
            return
        self.at.setdefault(level + size, []).append(window)
        self.count[level + size] += 1
        self.n_open += 1
        if self.n_open > MAX_OPEN:
            yield from self.finish(keep_last=True)

    def _close(self, window: list[tuple]) -> tuple[int, list[tuple]]:
        self.next_id += 1
        return self.next_id - 1, window

    def finish(self, keep_last: bool = False) -> Iterator[tuple[int, list[tuple]]]:
        """Fill the open windows up from each other, fullest first, cutting pieces where a window ends."""
        waiting = [p for level in sorted(self.at, reverse=True) for w in self.at[level] for p in w]
        self.at, self.n_open = {}, 0
        self.count[:] = 0
        window, room = [], self.length
        for key, start, ids, tokens in waiting:
            while len(ids):
                part, ids = ids[:4 * room], ids[4 * room:]
                window.append((key, start, part, tokens))
                start, room = start + len(part) // 4, room - len(part) // 4
                if not room:
                    yield self._close(window)
                    window, room = [], self.length
        if window and keep_last:
            self.at[self.length - room] = [window]
            self.count[self.length - room], self.n_open = 1, 1
        elif window:
            yield self._close(window)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, tokenizer: str = TOKENIZER,
         end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """One row per piece: the document's key, ``start`` (its ids before the piece), ``length``,
    ``ids_crc32`` of its ids (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id``, and
    ``offset`` there; with ``with_ids`` also ``ids``. Every id of every document, ``end_id`` last, lies
    in one piece; offsets of a sequence are gapless from 0.
    """
    key_type = docs.schema[key].dataType
    fields = [T.StructField(key, key_type)] + [T.StructField(n, T.LongType()) for n in (
        "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    end = array("I", [end_id]).tobytes()

    def run(batches):
        encode = encoder(tokenizer)
        windows = Windows(window, TaskContext.get().partitionId() << 40)
        out: list[tuple] = []
        kind = None

        def note(finished):
            for sequence, pieces in finished:
                offset = 0
                for k, start, ids, tokens in pieces:
                    n = len(ids) // 4
                    row = (k, start, n, zlib.crc32(ids), tokens, sequence, offset)
                    out.append(row + (np.frombuffer(ids, dtype=np.int32),) if with_ids else row)
                    offset += n

        def flush():
            columns = list(zip(*out)) if out else [[] for _ in fields]
            types = [kind] + [pa.int64()] * 6 + ([pa.list_(pa.int32())] if with_ids else [])
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, types)], names=[f.name for f in fields])
            out.clear()
            return made

        gc.disable()  # the maps below have no cycles, and walking through them costs a tenth of the time
        try:
            for batch in batches:
                kind = batch.column(0).type
                keys, texts = batch.column(0).to_pylist(), batch.column(1)
                for at in range(0, len(keys), 256):
                    part = [t or "" for t in texts[at:at + 256].to_pylist()]
                    for k, ids in zip(keys[at:at + 256], encode(part)):
                        ids += end
                        tokens = len(ids) // 4
                        for start in range(0, tokens, window):
                            note(windows.put((k, start, ids[4 * start:4 * (start + window)], tokens)))
                    if len(out) > 4096:
                        yield flush()
        finally:
            gc.enable()
            encode.forget()
        if kind is not None:
            note(windows.finish())
            yield flush()

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, T.StructType(fields))
