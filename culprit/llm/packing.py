"""Packing documents into sequences: sum-of-squares placement over an array of fill levels.

A task packs the documents of its partition as they come. ``levels[h]`` counts the open
windows that hold ``h`` tokens; a document goes to the level that leaves the least sum of
squared counts. No text is shuffled, and a task keeps only its open windows in memory.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culprit.llm.common import kept_table, texts_of, word_blocks

WINDOW = 4_096
END_ID = 2
CACHED = 500_000  # strings of a generation of those whose ids a worker remembers
LONG_CHUNK = 1 << 16
ID_BYTES = 4
DIGIT = re.compile(rb"[0-9]")
# White space and printable ASCII, and the letters of Latin-1 as UTF-8.
PLAIN = re.compile(rb"(?:[\t-\r -~]++|(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])++)*+")
PARTS = re.compile(rb"[a-z\x80-\xff]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^a-z0-9\s\x80-\xff]+")
# A byte as the vocabulary writes it: itself where it is printable in Latin-1, else one from 256 up.
PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
WRITTEN = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in PRINTABLE)}


class Piece(NamedTuple):
    """A run of a document's ids in one window; ``ids`` are little-endian unsigned 32-bit numbers."""

    doc: object
    start: int
    ids: bytes
    doc_tokens: int

    @property
    def length(self) -> int:
        return len(self.ids) // ID_BYTES

    def cut(self, low: int, high: int) -> Piece:
        return Piece(self.doc, self.start + low, self.ids[low * ID_BYTES : high * ID_BYTES], self.doc_tokens)


class SumOfSquares:
    """Open windows by fill level, and the placement that keeps their squared counts least.

    Moving a window from level h to h + s changes the sum of squares by
    2 (levels[h + s] - levels[h] + 1), opening one changes it by 2 levels[s] + 1 and filling
    one up by 1 - 2 levels[h]. The fullest of equally good levels is taken.
    """

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.levels = np.zeros(window + 1, dtype=np.int64)
        self.open: dict[int, list[list[Piece]]] = defaultdict(list)

    def place(self, piece: Piece) -> list[Piece] | None:
        """Put a piece below the window size in its window; the window, where that fills it."""
        size = piece.length
        levels = self.levels
        after = levels[size:] - levels[: self.window + 1 - size]
        change = 2 * after + 2
        change[0] = 2 * levels[size] + 1
        change[-1] = 1 - 2 * levels[self.window - size]
        change[1:][levels[1 : self.window + 1 - size] == 0] = np.iinfo(np.int64).max
        level = len(change) - 1 - int(change[::-1].argmin())
        held = self.open[level].pop() if level else []
        levels[level] -= level > 0
        held.append(piece)
        if level + size == self.window:
            return held
        levels[level + size] += 1
        self.open[level + size].append(held)
        return None

    def close(self) -> Iterator[list[Piece]]:
        """What is left: windows at a power of two stay, the others are cut to sizes without padding.

        Their pieces are strung together and cut into full windows and, at the end, windows
        of falling powers of two.
        """
        rest: list[Piece] = []
        for level in sorted(self.open, reverse=True):
            for held in self.open[level]:
                if level & (level - 1) == 0:
                    yield held
                else:
                    rest += held
        left = sum(p.length for p in rest)
        rest.reverse()
        while left:
            room = self.window if left >= self.window else 1 << (left.bit_length() - 1)
            left -= room
            held = []
            while room:
                piece = rest.pop()
                if piece.length > room:
                    rest.append(piece.cut(room, piece.length))
                    piece = piece.cut(0, room)
                held.append(piece)
                room -= piece.length
            yield held


class Remembered:
    """Ids of recent strings, in two generations of ``CACHED`` entries, so that memory stays bounded."""

    def __init__(self):
        self.newer: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def __len__(self) -> int:
        return len(self.newer)

    def missing(self, strings: set[bytes]) -> set[bytes]:
        """Those of the strings that are in neither generation; the others are in the newer one then."""
        if len(self) > CACHED:
            self.newer, self.older = {}, self.newer
        new = strings.difference(self.newer)
        if not self.older:
            return new
        unknown = new.difference(self.older)
        self.newer.update((s, self.older[s]) for s in new - unknown)
        return unknown


class Encoder:
    """Ids of a text as bytes, put together from those of its parts, which are remembered.

    A text of ASCII and letters of Latin-1, without special tokens, is made of runs of letters,
    single digits, English contractions and runs of other characters, which go to the byte-pair
    model byte by byte. Any other text is looked up by chunk: the vocabulary drops white space
    and no rule looks across it, so a white-space separated chunk has the same ids in every
    text. Its plain chunks are made of parts as well; the others take the whole way. A chunk
    without any white space for long is cut after ASCII digits.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.chunks, self.parts = Remembered(), Remembered()

    def learn_parts(self, parts: set[bytes]) -> None:
        """Remember the ids of these parts."""
        tokenize = self.model.tokenize
        for part in self.parts.missing(parts):
            self.parts.newer[part] = array("I", [t.id for t in tokenize(byte_letters(part))]).tobytes()

    def learn(self, chunks: set[bytes]) -> None:
        """Remember the ids of these chunks."""
        new = self.chunks.missing(chunks)
        plain = {c: parts_of(c) for c in new if is_plain(c)}
        self.learn_parts(set().union(*plain.values()))
        known = self.parts.newer.__getitem__
        self.chunks.newer.update((c, b"".join(map(known, parts))) for c, parts in plain.items())
        other = [c for c in new if c not in plain]
        if not other:
            return
        found = self.tokenizer.encode_batch_fast([c.decode("utf-8", "replace") for c in other], add_special_tokens=False)
        self.chunks.newer.update((c, array("I", e.ids).tobytes()) for c, e in zip(other, found))

    def ids(self, text: bytes) -> bytes:
        return next(self.every([text]))

    def every(self, texts: Iterable[bytes], size: int = 1 << 20) -> Iterator[bytes]:
        """Ids of every text; texts share a look-up up to ``size`` bytes, and longer ones are cut to that."""
        waiting: list[tuple[bool, list[bytes]]] = []
        held = 0
        for text in texts:
            if len(text) > size:
                yield from self.looked_up(waiting)
                waiting, held = [], 0
                yield b"".join(ids for chunks in word_blocks(text, size) for ids in self.looked_up([(False, chunks)]))
                continue
            plain = is_plain(text)
            waiting.append((plain, parts_of(text) if plain else text.split()))
            held += len(text)
            if held > size:
                yield from self.looked_up(waiting)
                waiting, held = [], 0
        yield from self.looked_up(waiting)

    def looked_up(self, texts: list[tuple[bool, list[bytes]]]) -> Iterator[bytes]:
        """Ids of texts that are given as parts (where the flag is set) or as chunks."""
        different = set().union(*[chunks for plain, chunks in texts if not plain])
        long = {c: list(digit_blocks(c)) for c in different if len(c) > LONG_CHUNK}
        for c, blocks in long.items():
            different.remove(c)
            different.update(blocks)
        self.learn(different)
        self.learn_parts(set().union(*[parts for plain, parts in texts if plain]))
        of_part, of_chunk = self.parts.newer.__getitem__, self.chunks.newer.__getitem__
        for plain, strings in texts:
            if long and not plain:
                strings = [block for c in strings for block in long.get(c, (c,))]
            yield b"".join(map(of_part if plain else of_chunk, strings))


def is_plain(text: bytes) -> bool:
    return PLAIN.fullmatch(text) is not None and b"<|" not in text


def parts_of(text: bytes) -> list[bytes]:
    """Parts of a plain text in lower case."""
    return PARTS.findall(text.lower() if text.isascii() else text.decode().lower().encode())


def byte_letters(part: bytes) -> str:
    """A part as the byte-pair model reads it, one character a byte."""
    return part.decode() if part.isascii() else part.decode("latin-1").translate(WRITTEN)


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """The encoder of this worker, shared by the tasks that it runs."""
    return Encoder(path)


def digit_blocks(chunk: bytes, size: int = LONG_CHUNK) -> Iterator[bytes]:
    """Parts of at least ``size`` bytes that end in an ASCII digit, and the rest."""
    at = 0
    while at < len(chunk):
        digit = DIGIT.search(chunk, at + size)
        stop = digit.end() if digit else len(chunk)
        yield chunk[at:stop]
        at = stop


def _packer(path: str, window: int, end_id: int, key: pa.DataType):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    end = np.array([end_id], dtype="<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, places = encoder_of(path), SumOfSquares(window)
        sequence = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def add(held: list[Piece]) -> None:
            nonlocal sequence
            offset = 0
            for p in held:
                rows.append((p.doc, p.start, p.length, zlib.crc32(p.ids), p.doc_tokens, sequence, offset))
                offset += p.length
            sequence += 1

        def batch_of() -> pa.RecordBatch:
            kinds = [key, *[pa.int64()] * 6]
            arrays = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names=columns)

        for batch in batches:
            where, data = texts_of(batch.column("text"))
            texts = (data[low:high].tobytes() for low, high in zip(where[:-1], where[1:]))
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.every(texts)):
                ids += end
                whole = Piece(doc, 0, ids, len(ids) // ID_BYTES)
                full = whole.length - whole.length % window
                for at in range(0, full, window):
                    add([whole.cut(at, at + window)])
                if full < whole.length:
                    done = places.place(whole.cut(full, whole.length))
                    if done:
                        add(done)
            if rows:
                yield batch_of()
        for held in places.close():
            add(held)
        if rows:
            yield batch_of()

    return pack


def pack(
    df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID
) -> DataFrame:
    """Pieces of documents in sequences: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``tokenizer`` is the path of a ``tokenizers`` file that drops white space, the same on
    every worker. A document is its ids and ``end_id``. Whole windows of it are sequences of
    their own, and what is left of it is placed by the sum of squares. Windows that stay open
    in a partition are closed at powers of two, which need no padding, so that only documents
    in those are cut a further time.

    The result is written once, so a task that runs again cannot mix two packings of its
    rows. Sequence ids name the partition in their upper bits; they are unique, not gapless.

    A null or empty text is the end id alone. Rows that repeat an id are documents of their
    own; a null id stays null; the key keeps its type. An empty table gives no pieces. Other
    columns are not read.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    rows = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType
    schema = f"doc_id {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return kept_table(rows.mapInArrow(_packer(tokenizer, window, end_id, to_arrow_type(kind)), schema), "packed")
