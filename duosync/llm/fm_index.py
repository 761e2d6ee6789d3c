"""Benchmark decontamination with an FM-index per shard of the training text.

A shard is some million words of neighbouring documents. Its index is the Burrows-Wheeler
transform of the words' numbers, held in a wavelet matrix (ranks of any word up to any row in
one step per bit of the vocabulary), the words' first rows, and every 16th text position's row.
Test phrases, which are windows of ten consecutive words of a benchmark item, are searched backwards,
all at once. An occurrence's rows are followed back to a sampled position, which gives its place;
overlapping occurrences are merged into spans to remove.

An index is built, asked and dropped inside one task, without a shuffle. Phrases go to the tasks
by broadcast, in blocks of at most ``PHRASE_BYTES``; further blocks are further passes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duosync.llm.common import Scratch

WINDOW = 10
SHARD_WORDS = 1 << 20
SAMPLED = 16
PHRASE_BYTES = 32 << 20

# Word characters: digits, lower-case letters and all beyond ASCII; the others become spaces.
_KEPT = bytes(c if c >= 128 or chr(c).isalnum() and chr(c).lower() == chr(c) else 32 for c in range(256))

SCAN = "doc_id long, n_words long, spans array<struct<start:long,stop:long>>, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text after lower-casing A-Z."""
    return text.lower().translate(_KEPT).split()


class Vocabulary(dict):
    """Numbers words in the order they come; 0 ends the text and 1 ends a document."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) + 2
        return number


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order. The last symbol must be the only 0.

    Three symbols are sorted at first, then twice as many each round, but only where the order is still open.
    """
    n, bits = len(text), int(text.max()).bit_length()
    width = max(1, min(3, 62 // max(bits, 1)))
    key = np.zeros(n, np.int64)
    padded = np.concatenate([text.astype(np.int64), np.zeros(width, np.int64)])
    for i in range(width):
        key = (key << bits) | padded[i : i + n]
    order = np.argsort(key, kind="stable")
    key = key[order]
    fresh = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    single = fresh & np.concatenate([fresh[1:], [True]])
    at = np.flatnonzero(~single)  # places in the order that are still open
    while len(at):
        rows = order[at]
        ahead = rows + width
        # An open suffix is longer than what was compared, as the last symbol is unique.
        key = (rank[rows] << 32) | rank[np.minimum(ahead, n - 1)]
        by = np.argsort(key, kind="stable")
        rows, key = rows[by], key[by]
        order[at] = rows
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        rank[rows] = np.maximum.accumulate(np.where(fresh, at, 0))
        single = fresh & np.concatenate([fresh[1:], [True]])
        at = at[~single]
        width *= 2
    return order


class BitRanks:
    """Counts of ones before a place, from 64-bit words and their running sums."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate([[0], np.cumsum(counts, dtype=np.int32)[:-1]]).astype(np.int32)

    def __call__(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)


class WaveletMatrix:
    """Access and rank over a sequence of numbers, one bit vector per bit of them."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max()).bit_length())
        self.levels, self.zeros = [], []
        for b in reversed(range(self.bits)):
            ones = (values >> b) & 1 == 1
            self.levels.append(BitRanks(ones))
            low = values[~ones]
            self.zeros.append(len(low))
            values = np.concatenate([low, values[ones]])

    def _down(self, level: int, at: np.ndarray, one: np.ndarray) -> np.ndarray:
        ones = self.levels[level](at)
        return np.where(one, self.zeros[level] + ones, at - ones)

    def rank(self, symbol: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        """How often each symbol stands before each of the places."""
        at = np.stack([np.zeros(len(symbol), np.int64), *places])
        for level in range(self.bits):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            at = self._down(level, at, one[None, :])
        return [p - at[0] for p in at[1:]]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at places, and how often each stands before its place."""
        symbol, place = np.zeros(len(at), np.int64), at
        for level in range(self.bits):
            one = self.levels[level].get(place) == 1
            symbol = (symbol << 1) | one
            place = self._down(level, place, one)
        distinct, back = np.unique(symbol, return_inverse=True)
        start = np.zeros(len(distinct), np.int64)
        for level in range(self.bits):
            one = (distinct >> (self.bits - 1 - level)) & 1 == 1
            start = self._down(level, start, one)
        return symbol, place - start[back]


class FmIndex:
    """Backward search and location in a text of numbers that ends with its only 0."""

    def __init__(self, text: np.ndarray):
        order = suffix_array(text)
        self.size = len(text)
        self.bwt = WaveletMatrix(text[order - 1])
        counts = np.bincount(text)
        self.first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        sampled = order % SAMPLED == 0
        self.marked = BitRanks(sampled)
        self.samples = order[sampled].astype(np.int32)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that start with each phrase (one per line)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        live = np.arange(len(phrases))
        for column in reversed(range(phrases.shape[1])):
            symbol = phrases[live, column]
            a, b = self.bwt.rank(symbol, low[live], high[live])
            low[live], high[live] = self.first[symbol] + a, self.first[symbol] + b
            live = live[b > a]
            if not len(live):
                break
        found = np.zeros(len(phrases), bool)
        found[live] = True
        return np.where(found, low, 0), np.where(found, high, 0)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back in the text until a sampled position."""
        out, steps = np.empty(len(rows), np.int64), 0
        open_rows, at = np.arange(len(rows)), rows.astype(np.int64)
        while len(open_rows):
            known = self.marked.get(at) == 1
            out[open_rows[known]] = self.samples[self.marked(at[known])] + steps
            open_rows, at = open_rows[~known], at[~known]
            if len(at):
                symbol, before = self.bwt.access(at)
                at = self.first[symbol] + before
            steps += 1
        return out


class Phrases:
    """The test phrases of a block of items: word numbers by length, and the items of each."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.words, holders = {}, {}
        for item, text in items:
            words = [self.words.setdefault(w, len(self.words)) for w in words_of(text)]
            length = min(window, len(words))
            for i in range(len(words) - length + 1 if words else 0):
                holders.setdefault(tuple(words[i : i + length]), set()).add(item)
        self.by_length: dict[int, tuple[np.ndarray, list[list[str]]]] = {}
        for length in {len(p) for p in holders}:
            own = [p for p in holders if len(p) == length]
            self.by_length[length] = np.array(own, np.int64), [sorted(holders[p]) for p in own]
        self.longest = max(self.by_length, default=1)

    def find(self, numbers: Vocabulary, text: np.ndarray) -> Iterator[tuple[int, int, list[str]]]:
        """(position, length, items) of every occurrence in a shard."""
        known = np.array([numbers.get(w, -1) for w in self.words], np.int64)
        index = None
        for length, (phrases, items) in self.by_length.items():
            asked = known[phrases]
            live = np.flatnonzero((asked >= 0).all(axis=1))
            if not len(live):
                continue
            index = index or FmIndex(text)
            low, high = index.search(asked[live])
            counts = high - low
            which = np.repeat(live, counts)
            starts = np.repeat(low - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
            places = index.locate(starts + np.arange(counts.sum()))
            for place, phrase in zip(places.tolist(), which.tolist(), strict=True):
                yield place, length, items[phrase]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


class Shard:
    """Pieces of documents that are indexed together."""

    def __init__(self, phrases: Phrases):
        self.phrases = phrases
        self.clear()

    def clear(self) -> None:
        self.numbers, self.size = Vocabulary(), 0
        self.parts: list[np.ndarray] = []
        self.pieces: list[tuple[int, int]] = []  # key, place of its first word in the document
        self.starts: list[int] = []

    def add(self, key: int, first: int, words: list[bytes]) -> None:
        numbers = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
        self.pieces.append((key, first))
        self.starts.append(self.size)
        self.parts += [numbers, np.ones(1, np.int32)]
        self.size += len(words) + 1

    def search(self, found: dict[int, tuple[list, set]]) -> None:
        """Adds spans and items to ``found`` by the pieces' keys, and empties the shard."""
        if self.size:
            text = np.concatenate([*self.parts, np.zeros(1, np.int32)])
            starts = np.array(self.starts)
            for place, length, items in self.phrases.find(self.numbers, text):
                piece = int(np.searchsorted(starts, place, "right")) - 1
                key, first = self.pieces[piece]
                at = first + place - self.starts[piece]
                spans, names = found.setdefault(key, ([], set()))
                spans.append((at, at + length))
                names.update(items)
        self.clear()


def _search(phrases: Phrases, shard_words: int, texts: pa.Array) -> list[tuple]:
    """(words, merged spans, items) of every text of a batch; equal texts are indexed once."""
    shard, found = Shard(phrases), {}
    overlap = phrases.longest - 1
    step = max(shard_words, 2 * overlap + 1)
    same: dict[bytes, int] = {}
    rows = []
    for text in texts:
        words = words_of(text.as_py() or b"")
        digest = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
        new = digest not in same
        key = same.setdefault(digest, len(same))
        if new and words:
            for first in range(0, max(1, len(words) - overlap), step):
                # Pieces of a long document overlap by a phrase less one word.
                shard.add(key, first, words[first : first + step + overlap])
                if shard.size >= shard_words:
                    shard.search(found)
        rows.append((len(words), key))
    shard.search(found)
    report = {key: (merged(spans), sorted(items)) for key, (spans, items) in found.items()}
    return [(n, *report.get(key, ([], []))) for n, key in rows]


def _scan(phrases, shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            found = _search(phrases.value, shard_words, batch.column(2).cast(pa.binary()))
            spans = [[{"start": a, "stop": b} for a, b in s] for _, s, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([n for n, *_ in found], pa.int64()),
                    pa.array(spans, kind),
                    pa.array([items for *_, items in found], pa.list_(pa.string())),
                ],
                ["_row", "doc_id", "n_words", "spans", "items"],
            )

    return run


def _clean(phrases, shard_words: int, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _search(phrases.value, shard_words, batch.column(column).cast(pa.binary()))
            yield batch.filter(pa.array([not spans for _, spans, _ in found], pa.bool_()))

    return run


def phrase_blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Phrases]:
    """The items' phrases in blocks of about ``block_bytes`` of text; one block at least."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    total = items.agg(F.sum(F.length("text") + 8)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for block in range(blocks):
        own = items.filter(F.expr(f"pmod(xxhash64(item, text), {blocks}) = {block}"))
        yield Phrases([(r.item, bytes(r.text)) for r in own.collect()], window)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_bytes: int = PHRASE_BYTES,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text holds no phrase.

    Nulls, empty texts and repeats as in ``scan``; nothing is shuffled.
    """
    column = docs.columns.index("text")
    for phrases in phrase_blocks(benchmark, window, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(phrases)
        docs = docs.mapInArrow(_clean(sent, shard_words, column), docs.schema)
    return docs


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    scratch: Scratch,
    window: int = WINDOW,
    block_bytes: int = PHRASE_BYTES,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """One row per document: (doc_id, n_words, spans, items), see ``SCAN``.

    ``spans`` are the merged word ranges [start, stop) inside occurrences of a phrase; ``items``
    are the ids, as text, of the items that such a phrase comes from. A null or empty text has no
    words; so has such an item, which no document matches. A null item_id reads as an empty id;
    items that share an id are one item with several texts. Repeated rows each give a row. Empty
    tables give no rows or no hits. Only ``doc_id`` and ``text``, ``item_id`` and ``text`` are read.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
    )
    blocks = list(phrase_blocks(benchmark, window, block_bytes))
    if len(blocks) > 1:
        source = scratch(source)  # so that rows keep their numbers
    passes = []
    for phrases in blocks:
        sent = spark.sparkContext.broadcast(phrases)
        passes.append(source.mapInArrow(_scan(sent, shard_words), "_row long, " + SCAN))
    if len(blocks) == 1:
        return passes[0].drop("_row")
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    joined = scratch(every).groupBy("_row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return joined.select("doc_id", "n_words", F.expr(MERGED).alias("spans"), "items")


# Sorted spans merged, as in ``merged``.
MERGED = """
aggregate(spans, CAST(array() AS array<struct<start:bigint,stop:bigint>>), (a, s) -> CASE
  WHEN size(a) = 0 OR s.start > element_at(a, -1).stop THEN a || array(s)
  ELSE slice(a, 1, size(a) - 1) || array(named_struct('start', element_at(a, -1).start,
    'stop', greatest(element_at(a, -1).stop, s.stop))) END)
"""


def hits(scanned: DataFrame) -> DataFrame:
    """The report on ``scan`` rows: counts, a digest of the items, and the verdict."""
    n_hit = F.expr("aggregate(spans, 0L, (a, s) -> a + s.stop - s.start)")
    return scanned.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
