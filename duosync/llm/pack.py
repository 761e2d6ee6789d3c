"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Lengths fall into reciprocal-capacity classes: class k holds pieces of capacity / k tokens, and a
bin of that class takes exactly k of them, whatever else there is. A bin's content therefore
depends only on how many pieces of its class came before, so workers fill bins independently:
each task numbers its own pieces by class, and a sum over the small table of counts per task and
class turns that into bin numbers. No task sees another one's documents.

Documents may be cut, so a document of n tokens becomes n // capacity whole sequences and, of the
rest, one piece for each power of two in it. These lengths are capacity / k for k = 1, 2, 4, ...:
every full bin is full to the last token. The pieces left over in a class, fewer than k, are
split again by powers of two, so every sequence has a power of two of tokens and none is padded.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duosync.llm.common import Scratch

CAPACITY = 2048
END_ID = 1
# Distinct strings a worker remembers; then it starts over. About 200 bytes each.
REMEMBERED = 500_000

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
    " _task int, _class int, _nth long"
)

# Beyond these characters lower case and normal forms depend on neighbours, or on tables that
# the tokenizer's library has in another version; one letter among them becomes two.
_FAR = re.compile("[^\x00-\u012f\u0131-\u017f]")
# The pre-tokens of other lower-case text, as the vocabulary file defines them.
_LETTER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017f"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = "\t-\r \x85\xa0"
_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_LETTER}{_NUMBER}{_SPACE}]+"
)


class Remembered(dict):
    """What ``make`` gives for a string, kept for short strings up to a bound."""

    def __init__(self, make):
        self.make = make

    def __missing__(self, string: str) -> bytes:
        made = self.make(string)
        if len(string) < 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[string] = made
        return made


class TokenBytes:
    """The ids of a text as little-endian 32-bit numbers, equal to one call of the tokenizer.

    The vocabulary splits at white space and takes all cases as one, so a text is lower-cased and
    cut there, and each distinct string is tokenised once. Its pre-tokens go to the vocabulary's
    merges directly, and are strings to remember, too; a string with other than Latin characters
    goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.strings = Remembered(self._string)
        # Byte-level vocabularies name each byte by a printable character.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in set(plain)]
        self.names = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _merged(self, word: str) -> bytes:
        if not (word.isascii() and word.isprintable()):
            word = word.encode().decode("latin-1").translate(self.names)
        ids = [t.id for t in self.model.tokenize(word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _string(self, string: str) -> bytes:
        if _FAR.search(string):
            return self._whole(string)
        words = _WORDS.findall(string.lower())
        if words == [string]:
            return self._merged(string)
        return b"".join(map(self.strings.__getitem__, words))

    def __call__(self, text: str) -> bytes:
        if "<|" in text:  # a special token's string may hold no white space, but cut nothing here
            return self._whole(text)
        if not _FAR.search(text):
            text = text.lower()
        return b"".join(map(self.strings.__getitem__, text.replace("\n", " ").split(" ")))


_tokenizers: dict[str, TokenBytes] = {}


def token_bytes(path: str) -> TokenBytes:
    """One tokenizer per worker process."""
    if path not in _tokenizers:
        _tokenizers[path] = TokenBytes(path)
    return _tokenizers[path]


def cut(tokens: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces, in order: whole sequences, then falling powers of two."""
    rest = tokens % capacity
    bits = [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
    return [capacity] * (tokens // capacity) + bits


def _tokenise(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        encode, seen = token_bytes(path), [0] * capacity.bit_length()
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows: list[tuple] = []
            for doc_id, text in zip(ids, batch.column(1), strict=True):
                raw = encode(text.as_py() or "") + end
                view, start, n = memoryview(raw), 0, len(raw) // 4
                for length in cut(n, capacity):
                    crc = zlib.crc32(view[4 * start : 4 * (start + length)])
                    kind = length.bit_length() - 1
                    rows.append((doc_id, start, length, crc, n, task, kind, seen[kind]))
                    seen[kind] += 1
                    start += length
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(c, pa.int32() if i in (5, 6) else pa.int64())
                        for i, c in enumerate(zip(*rows, strict=True))
                    ],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_task", "_class", "_nth"],
                )

    return run


def pack(
    docs: DataFrame, scratch: Scratch, tokenizer: str, capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece: its place in the document and in its sequence.

    ``tokenizer`` is the path of a ``tokenizers`` file that every worker can read; ``capacity`` is
    a power of two. A document ends with id 1; a null or empty text is that id alone. Rows
    that repeat or share an id are packed each on their own; a null id stays null. The longest
    text is held by one task as a whole. An empty table gives no rows. Only ``doc_id`` and
    ``text`` are read. ``sequence_id`` is unique but not dense: bin * 256 + class * 16 + block.
    """
    if capacity & (capacity - 1) or capacity < 2:
        raise ValueError("capacity must be a power of two")
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    pieces = scratch(source.mapInArrow(_tokenise(tokenizer, capacity), PIECES))
    top = capacity.bit_length() - 1
    counts = pieces.groupBy("_class", "_task").agg(F.count("*").alias("_n"))
    before = counts.selectExpr(
        "_class",
        "_task",
        "coalesce(sum(_n) OVER (PARTITION BY _class ORDER BY _task"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before",
        "sum(_n) OVER (PARTITION BY _class) AS _all",
    )
    # In the class's last, open bin: the block of a piece is the highest bit in which its place
    # differs from the number of pieces there, and the block starts at that number's higher bits.
    return (
        pieces.join(before, ["_class", "_task"])
        .withColumn("_place", F.expr("_before + _nth"))
        .withColumn("_bits", F.expr(f"{top} - _class"))
        .withColumn("_bin", F.expr("shiftright(_place, _bits)"))
        .withColumn("_slot", F.expr("_place - shiftleft(_bin, _bits)"))
        .withColumn("_left", F.expr("_all - shiftleft(_bin, _bits)"))
        .withColumn("_open", F.expr("_left < shiftleft(1L, _bits)"))
        .withColumn("_block", F.expr("IF(_open, length(bin(_slot ^ _left)), 0)"))
        .withColumn(
            "_first", F.expr("IF(_open, shiftleft(shiftright(_left, _block), _block), 0)")
        )
        .selectExpr(
            "doc_id",
            "start",
            "length",
            "ids_crc32",
            "doc_tokens",
            "_bin * 256 + _class * 16 + _block AS sequence_id",
            "(_slot - _first) * length AS offset",
        )
    )
