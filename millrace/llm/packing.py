"""Packing: token sequences of a fixed length, filled from whole documents where they fit.

Each partition keeps ``OPEN_WINDOWS`` windows open. What is left of a document after its full windows
goes where it fits best; if it fits nowhere, the fullest window is emitted and the document starts a
new one. Cutting is free, so the emitted window's gap is filled with the beginning of that document
when the gap is larger than ``MAX_GAP``. Windows still open at a partition's end are leftovers: they
are merged in groups of ``MERGE_PARTITIONS`` partitions, fullest first, each filled up by cutting the
next; the one that stays short per group is cut at powers of two, where sequences need no padding.

Tokens are made whole text by whole text. A text is split at ASCII white space first and each distinct
word is encoded once: the tokenizer's normaliser and splitter work within words that such white space
separates, so the ids are those of the whole text (tested). Texts in which an added token occurs, in
any case of letters, go to the tokenizer as they are.

Defined results: a NULL text counts as empty and yields the end id alone. Rows that repeat, or share a
doc_id, are each packed. An empty table gives no piece. Further columns are not part of the pieces.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.staging import staged

SEQUENCE_TOKENS = 2048
END_ID = 1
OPEN_WINDOWS = 64
MAX_GAP = 8
MERGE_PARTITIONS = 8
# Words kept with their ids, per Python worker: twice so many at most.
CACHED_WORDS = 300_000

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
_FIRST_PASS = f"{PIECES}, partition int, slot int, ids binary"

_ENCODERS: dict[str, Encoder] = {}

# Byte-level vocabularies write a byte as the character of that number, unless it is no
# printable character of Latin-1; those take the characters from 256 on, in order.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_LETTERS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


_MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())


class Encoder(dict):
    """Ids of words by the tokenizer file, remembered; called with a text, all its ids.

    Words and ids are bytes (UTF-8, and little-endian unsigned 32-bit), so a text's ids are one join.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(file)
        self.added = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.older: dict[bytes, bytes] = {}

    def word_ids(self, word: bytes) -> bytes:
        text = word.decode(errors="replace")
        lowered = text.lower()
        # a run of Latin letters is one unit for the splitter, so the model can have it at once
        if lowered.isalpha() and max(text) < "\u0250":
            if not lowered.isascii():
                lowered = lowered.encode().decode("latin-1").translate(_LETTERS)
            return array("I", [x.id for x in self.model.tokenize(lowered)]).tobytes()
        return self.encoded(word)

    def encoded(self, text: bytes) -> bytes:
        ids = self.tokenizer.encode(text.decode(errors="replace"), add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        # behind an ASCII letter or digit, marks at the end are a unit of their own for the splitter
        core = word.rstrip(_MARKS)
        if core and len(core) < len(word) and core[-1:].isalnum():
            return self[core] + self[word[len(core) :]]
        ids = self.older.get(word)
        if ids is None:
            ids = self.word_ids(word)
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def __call__(self, text: bytes) -> bytes:
        lowered = text.lower()
        if any(x in lowered for x in self.added):
            return self.encoded(text)
        # Lower case comes after composition in the normaliser; only with combining marks that matters.
        words = text.split() if b"\xcc" in text or b"\xcd" in text else lowered.split()
        return b"".join(map(self.__getitem__, words))


def encoder(file: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if file not in _ENCODERS:
        _ENCODERS[file] = Encoder(file)
    return _ENCODERS[file]


_ID = 4  # bytes of an id


class Windows:
    """The open windows of one partition; ``emit`` gets each closed one as a list of pieces.

    A piece is (doc_id, start, ids, doc_tokens), the ids as bytes.
    """

    def __init__(self, emit: Callable[[list], None], size: int = SEQUENCE_TOKENS, slots: int = OPEN_WINDOWS, max_gap: int = MAX_GAP):
        self.emit, self.size, self.slots, self.max_gap = emit, size, slots, max_gap
        self.room: list[tuple[int, int]] = []  # (free tokens, slot), ascending
        self.held: dict[int, list] = {}
        self.next_slot = 0

    def add(self, doc_id, ids) -> None:
        total, at = len(ids) // _ID, 0
        while total - at >= self.size:
            self.emit([(doc_id, at, ids[_ID * at : _ID * (at + self.size)], total)])
            at += self.size
        if at < total:
            self._place(doc_id, at, ids[_ID * at :], total)

    def _place(self, doc_id, start, ids, total) -> None:
        length = len(ids) // _ID
        best = bisect_left(self.room, (length, -1))
        if best < len(self.room):
            self._put(best, (doc_id, start, ids, total))
            return
        if len(self.room) >= self.slots:
            gap, slot = self.room[0]
            if gap > self.max_gap:  # smaller than the piece, which fits nowhere
                self._put(0, (doc_id, start, ids[: _ID * gap], total))
                self._place(doc_id, start + gap, ids[_ID * gap :], total)
                return
            self.room.pop(0)
            self.emit(self.held.pop(slot))
        slot, self.next_slot = self.next_slot, self.next_slot + 1
        self.held[slot] = [(doc_id, start, ids, total)]
        insort(self.room, (self.size - length, slot))

    def _put(self, at: int, piece) -> None:
        free, slot = self.room.pop(at)
        self.held[slot].append(piece)
        free -= len(piece[2]) // _ID
        if free:
            insort(self.room, (free, slot))
        else:
            self.emit(self.held.pop(slot))

    def leftovers(self) -> Iterator[list]:
        for _, slot in self.room:
            yield self.held[slot]


def _rows(window: list, sequence: int) -> Iterator[tuple]:
    offset = 0
    for doc_id, start, ids, total in window:
        length = len(ids) // _ID
        yield doc_id, start, length, zlib.crc32(ids), total, sequence, offset
        offset += length


def _fill(file: str, size: int, slots: int, end_id: int):
    """A task that packs its documents: closed windows as pieces, open ones with their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, partition, end = encoder(file), TaskContext.get().partitionId(), array("I", [end_id]).tobytes()
        done: list[tuple] = []
        sequences = 0

        def emit(window):
            nonlocal sequences
            sequence = (partition << 33) + sequences
            sequences += 1
            done.extend((*x, partition, None, None) for x in _rows(window, sequence))

        def flush():
            rows = pd.DataFrame(done, columns=[x.split()[0] for x in _FIRST_PASS.split(", ")])
            done.clear()
            return pa.RecordBatch.from_pandas(rows, schema=_arrow_schema(), preserve_index=False)

        windows = Windows(emit, size, slots)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                windows.add(doc_id.as_py(), encode(text.as_buffer().to_pybytes() if text.is_valid else b"") + end)
                if len(done) >= 10_000:
                    yield flush()
        for slot, window in enumerate(windows.leftovers()):
            for doc_id, start, ids, total in window:
                done.append((doc_id, start, len(ids) // _ID, zlib.crc32(ids), total, None, None, partition, slot, ids))
        if done:
            yield flush()

    return run


def _arrow_schema() -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in _FIRST_PASS.split(", "))])


def _merge(size: int, first_group_sequence: int):
    """A task that makes full sequences of a group's leftover windows."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["partition", "slot", "doc_id", "start"], kind="stable")
        windows = [
            [(r.doc_id, r.start, bytes(r.ids), r.doc_tokens) for r in w.itertuples()]
            for _, w in part.groupby(["partition", "slot"], sort=True)
        ]
        windows.sort(key=lambda w: -sum(len(p[2]) for p in w))
        base = (first_group_sequence + int(part["group"].iloc[0])) << 33
        out, sequences = [], 0

        def close(window):
            nonlocal sequences
            out.extend(_rows(window, base + sequences))
            sequences += 1

        current, filled = [], 0
        for doc_id, start, ids, total in chain.from_iterable(windows):
            while ids:
                taken = ids[: _ID * (size - filled)]
                current.append((doc_id, start, taken, total))
                ids, length = ids[len(taken) :], len(taken) // _ID
                start, filled = start + length, filled + length
                if filled == size:
                    close(current)
                    current, filled = [], 0
        for window in at_powers_of_two(current):
            close(window)
        return pd.DataFrame(out, columns=[x.split()[0] for x in PIECES.split(", ")])

    return run


def at_powers_of_two(window: list) -> Iterator[list]:
    """The window cut into windows whose lengths are falling powers of two."""
    left = sum(len(p[2]) for p in window) // _ID
    pieces = list(window)
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        part = []
        while size:
            doc_id, start, ids, total = pieces.pop(0)
            part.append((doc_id, start, ids[: _ID * size], total))
            if len(ids) > _ID * size:
                pieces.insert(0, (doc_id, start + size, ids[_ID * size :], total))
            size -= len(part[-1][2]) // _ID
        yield part


def packed(
    docs: DataFrame, tokenizer: str, size: int = SEQUENCE_TOKENS, slots: int = OPEN_WINDOWS, end_id: int = END_ID
) -> DataFrame:
    """A row per piece of every row of (doc_id, text)."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    first = staged(texts.mapInArrow(_fill(tokenizer, size, slots, end_id), _FIRST_PASS), "packed")
    names = [x.split()[0] for x in PIECES.split(", ")]
    closed = first.where("sequence_id is not null").select(*names)
    left = first.where("sequence_id is null").withColumn("group", F.floor(F.col("partition") / MERGE_PARTITIONS))
    # Numbers of groups begin behind those that partitions use: a partition's number has at most 24 bits here.
    merged = left.groupBy("group").applyInPandas(_merge(size, 1 << 24), PIECES)
    return closed.unionByName(merged)


def query(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return packed(spark.read.parquet(f"{folder}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
