"""Cross-tokenizer alignment: which tokens of two tokenizers stand for the same bytes.

Each distinct text is tokenised and aligned once. Documents are shuffled by their full text and
counted (equal texts meet already before the shuffle); a text's pair counts weigh as much as it
has documents; its measures are joined back to the documents by the text's SHA-256.

Alignment. Both tokenizers' tokens cover the same bytes. Where a token of A and one of B end at the same
byte, a group ends. The ends of both cut the text into segments that lie in one token of A and
one of B each, and two tokens overlap in exactly one segment: the segments are the links.
Both tokenizers start anew at some places, such as a single space between two other characters:
A's pattern begins a pre-token there, and no piece of B holds both neighbours. So a text is
aligned in chunks cut there, and a worker remembers the chunks it has met.

The counts' table. Links are counted per id pair in Spark. To bring the counts back, the frequent
pairs are broadcast: those with a 1/``OFTEN`` of all links, so there are at most ``OFTEN`` of them, at
any size of the corpus. The occurrences of all other pairs are shuffled to their counts. So no hot pair
is ever a join key, and each pair is counted in full.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duosync.llm.common import Scratch

OFTEN = 200_000
# Chunks a worker remembers, and the longest one; about 500 bytes each.
REMEMBERED = 150_000
LONGEST = 48
# Characters whose chunks are looked up together, and chunks that are aligned together.
BATCH_CHARS = 1 << 21
MERGED = 20_000

ALIGNED = (
    "text_no long, key binary, times long, n_a long, n_b long, n_groups long, n_links long,"
    " groups_sha256 string, pairs array<long>, links array<long>"
)
_KINDS = [pa.int64(), pa.binary(), *[pa.int64()] * 5, pa.string(), *[pa.list_(pa.int64())] * 2]
_NAMES = [f.split()[0] for f in ALIGNED.split(", ")]

_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_TAIL = ".,;:!?"
# Before a space or line break between two other characters, and before a mark that ends a word.
_CUT = re.compile(rf"(?<=\S)(?= \S|\n\S)|(?<=[{_LETTER}])(?=[{_TAIL}](?:\s|\Z))")
# One pre-token of a byte-level vocabulary, whose merges can be asked directly.
_PLAIN = re.compile(f" ?[{_LETTER}]+")
_SPACE = "▁"  # sentencepiece's space


class Chunk(NamedTuple):
    """A chunk's tokens, groups and links; none if its bytes don't come back."""

    exact: bool
    n_a: int
    n_b: int
    n_groups: int
    pairs: tuple[int, ...]
    groups: str


INEXACT = Chunk(False, 0, 0, 0, (), "")


class Aligner:
    """Both tokenizers and the chunks met so far."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=b_path)
        # Byte-level vocabularies name each byte by a printable character.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [byte for byte in range(256) if byte not in set(plain)]
        self.byte_of = {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(other)}
        self.a_bytes = {i: self._level(t) for t, i in self.a.get_vocab().items()}
        self.b_bytes = [self._piece(i) for i in range(len(self.b))]
        top = max(self.a_bytes) + 1
        self.a_length = np.array([len(self.a_bytes.get(i, b"")) for i in range(top)])
        self.b_length = np.array([len(p) for p in self.b_bytes])
        self.digits = [f"{i}{mark}" for mark in ",|" for i in range(top)]
        self.digits += [f"{i}{mark}" for mark in ",;\n" for i in range(len(self.b))]
        before = json.loads(self.a.to_str())["pre_tokenizer"] or {}
        self.splits = self._starts_anew(before)
        self.name_of = {c: name for name, c in self.byte_of.items()}
        # A chunk without a space before it gets a line break instead, whose tokens are taken off.
        self.lead = len(self.b.encode("\n"))
        self.known: dict[str, Chunk] = {}

    def _starts_anew(self, before: dict) -> bool:
        level = before.get("type") == "ByteLevel" and before.get("use_regex")
        pieces = [self.b.id_to_piece(i) for i in range(len(self.b))]
        two = {pair for p in pieces for pair in zip(p, p[1:])}
        mixed = any(right == _SPACE != left or "\n" in (left, right) for left, right in two)
        ends = any(re.match(f"[{_LETTER}]", left) and right in _TAIL for left, right in two)
        return bool(level and not before.get("add_prefix_space") and not mixed and not ends)

    def _level(self, token: str) -> bytes:
        if all(c in self.byte_of for c in token):
            return bytes(map(self.byte_of.__getitem__, token))
        return token.encode()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace(_SPACE, " ").encode()

    def _align(self, chunks: list[str]) -> list[Chunk]:
        ids = [(self._a_ids(chunks), self.a_bytes), (self._b_ids(chunks), self.b_bytes)]
        exact = np.ones(len(chunks), bool)
        wholes = [c.encode() for c in chunks]
        for each, known in ids:
            back = [b"".join(map(known.__getitem__, of)) for of in each]
            exact &= np.fromiter(map(eq, back, wholes), bool, len(chunks))
        good = np.flatnonzero(exact).tolist()
        out = [INEXACT] * len(chunks)
        if good:
            a, b = ([each[k] for k in good] for each, _ in ids)
            for k, chunk in zip(good, self._merge(a, b), strict=True):
                out[k] = chunk
        return out

    def _a_ids(self, chunks: list[str]) -> list[list[int]]:
        plain = [self.splits and _PLAIN.fullmatch(c) is not None for c in chunks]
        others = [c for c, is_plain in zip(chunks, plain, strict=True) if not is_plain]
        encoded = iter(self.a.encode_batch_fast(others, add_special_tokens=False))
        merges, names = self.a.model.tokenize, self.name_of
        return [
            [t.id for t in merges(c.encode().decode("latin-1").translate(names))] if is_plain else next(encoded).ids
            for c, is_plain in zip(chunks, plain, strict=True)
        ]

    def _b_ids(self, chunks: list[str]) -> list[list[int]]:
        spaced = [c.startswith(" ") for c in chunks]
        given = [c[1:] if s else "\n" + c for c, s in zip(chunks, spaced, strict=True)]
        found = self.b.encode(given, num_threads=1)
        return [ids if s else ids[self.lead :] for ids, s in zip(found, spaced, strict=True)]

    def _merge(self, a: list[list[int]], b: list[list[int]]) -> Iterator[Chunk]:
        """Align the tokens of many chunks, laid end to end: each chunk's end is common to both."""
        n_a, n_b = ([len(of) for of in side] for side in (a, b))
        a, b = (np.fromiter(chain.from_iterable(side), np.int64) for side in (a, b))
        ends_a, ends_b = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        chunk_ends = ends_a[np.cumsum(n_a) - 1]
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        ends = np.union1d(ends_a, ends_b)
        pairs = (a[np.searchsorted(ends_a, ends)] << 32 | b[np.searchsorted(ends_b, ends)]).tolist()
        last = (np.searchsorted(ends, chunk_ends) + 1).tolist()
        n_groups = np.diff(np.searchsorted(common, chunk_ends) + 1, prepend=0).tolist()
        # Each id's digits with what follows them; a group's A ids come before its B ids.
        closes_a, closes_b = np.isin(ends_a, common), np.isin(ends_b, common)
        after_b = closes_b.astype(np.int64) + np.isin(ends_b, chunk_ends)
        size_a, size_b = len(self.a_length), len(self.b_length)
        written = np.empty(len(a) + len(b), np.int64)
        groups_before = np.cumsum(closes_a) - closes_a
        b_before = np.concatenate([[0], np.flatnonzero(closes_b) + 1])[groups_before]
        written[np.arange(len(a)) + b_before] = a + size_a * closes_a
        groups_before = np.cumsum(closes_b) - closes_b
        a_upto = (np.flatnonzero(closes_a) + 1)[groups_before]
        written[np.arange(len(b)) + a_upto] = 2 * size_a + b + size_b * after_b
        groups = "".join(map(self.digits.__getitem__, written.tolist())).split("\n")
        # Every chunk's text ends with the separator, so an empty string follows the last one.
        for k, start in enumerate([0, *last[:-1]]):
            yield Chunk(True, n_a[k], n_b[k], n_groups[k], tuple(pairs[start : last[k]]), groups[k])

    def chunks(self, texts: list[str]) -> list[list[Chunk]]:
        """Each text's chunks, in order; an empty text has none."""
        cut = [(_CUT.split(" " + t) if self.splits else [" " + t]) if t else [] for t in texts]
        seen = Counter(chain.from_iterable(cut))
        known = {c: self.known[c] for c in seen if c in self.known}
        fresh = [c for c in seen if c not in known]
        for start in range(0, len(fresh), MERGED):
            part = fresh[start : start + MERGED]
            known.update(zip(part, self._align(part), strict=True))
        # Words that stand here once are hardly met again.
        often = {c: known[c] for c in fresh if seen[c] > 1 and len(c) <= LONGEST}
        if len(self.known) + len(often) > REMEMBERED:
            self.known.clear()
        self.known.update(often)
        return [list(map(known.__getitem__, text)) for text in cut]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker process."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def _row(chunks: list[Chunk]) -> tuple:
    """The measures of a text; a byte that either tokenizer changes leaves it without tokens."""
    exact, n_a, n_b, n_groups, pairs, groups = zip(*chunks, strict=True) if chunks else [()] * 6
    if not chunks or not all(exact):
        return 0, 0, 0, 0, "", [], []
    counts = Counter(chain.from_iterable(pairs))
    return (
        sum(n_a),
        sum(n_b),
        sum(n_groups),
        sum(map(len, pairs)),
        hashlib.sha256(";".join(groups).encode()).hexdigest(),
        list(counts.keys()),
        list(counts.values()),
    )


def _aligned(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model, made = aligner(a_path, b_path), TaskContext.get().partitionId() << 40

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            nonlocal made
            texts = [t for t, _, _ in rows]
            out = [
                (made + i, key, times, *_row(chunks))
                for i, ((_, key, times), chunks) in enumerate(zip(rows, model.chunks(texts), strict=True))
            ]
            made += len(rows)
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], _NAMES
            )

        # Chunks hold no cycles; looking for some would take a fifth of the time.
        gc.disable()
        for batch in batches:
            rows, size = [], 0
            for text, key, times in zip(*batch.columns, strict=True):
                rows.append((text.as_py(), key.as_py(), times.as_py()))
                size += len(rows[-1][0])
                if size >= BATCH_CHARS:
                    yield flush(rows)
                    rows, size = [], 0
            if rows:
                yield flush(rows)

    return run


def align_texts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per distinct text, as in ``ALIGNED``; null and empty texts have none.

    ``pairs`` holds the text's id pairs (A's id * 2**32 + B's id), ``links`` how often each is linked in it,
    ``times`` the number of documents with this text.
    """
    texts = docs.select(F.col("text").cast("string")).filter("text <> ''")
    distinct = texts.groupBy("text").agg(F.count("*").alias("times"))
    keyed = distinct.select("text", _key("text").alias("key"), "times")
    return keyed.mapInArrow(_aligned(a_path, b_path), ALIGNED)


def _key(text: str):
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): how many links of all documents hold each id pair."""
    return (
        aligned.select("times", F.explode(F.arrays_zip("pairs", "links")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair"))
        .agg(F.sum(F.col("times") * F.col("p.links")).alias("n"))
    )


def _sums(occurrences: DataFrame) -> DataFrame:
    best = F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best")
    return occurrences.groupBy("text_no").agg(best, F.sum(F.col("links") * F.col("n")).alias("count_sum"))


def align_documents(
    docs: DataFrame, scratch: Scratch, a_path: str, b_path: str, often: int = OFTEN
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``a_path`` is a byte-level ``tokenizers`` file, which gets a space and the text; ``b_path`` a sentencepiece file that
    puts the space there itself. Strings of special tokens are plain text. A text that is null or empty,
    or whose bytes don't come back from both (one with U+2581, say), has no tokens: zeros and an empty digest.
    ``n_best`` counts the links whose pair is the most frequent one of its B id over all documents,
    ties included; ``count_sum`` adds up the pairs' counts. Rows that repeat or share an id count each and have a
    row each; a null id stays null. The longest text is held by one task. An empty table gives no rows.
    Only ``doc_id`` and ``text`` are read, whatever other columns there are.
    """
    aligned = scratch(align_texts(docs, a_path, b_path))
    counts = scratch(pair_counts(aligned))
    # One row per id of B's vocabulary.
    most = counts.groupBy((F.col("pair") % (1 << 32)).alias("b")).agg(F.max("n").alias("most"))
    flagged = scratch(
        counts.withColumn("b", F.col("pair") % (1 << 32))
        .join(F.broadcast(most), "b")
        .select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    )
    total = flagged.agg(F.sum("n")).first()[0] or 0
    # At most ``often`` pairs can have such a share.
    is_often = F.col("n") * often >= total
    frequent, rare = F.broadcast(flagged.filter(is_often)), flagged.filter(~is_often)
    links = aligned.select("text_no", F.explode(F.arrays_zip("pairs", "links")).alias("p")).select(
        "text_no", F.col("p.pairs").alias("pair"), F.col("p.links").alias("links")
    )
    others = links.join(frequent, "pair", "left_anti").join(rare, "pair")
    parts = _sums(links.join(frequent, "pair")).unionByName(_sums(others))
    sums = parts.groupBy("text_no").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    measures = scratch(
        aligned.drop("pairs", "links", "times")
        .join(sums, "text_no", "left")
        .select("key", *columns[:4], *zero, "groups_sha256")
    )
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    named = source.filter("text <> ''").select("doc_id", _key("text").alias("key"))
    found = named.join(measures, "key").drop("key")
    without = source.filter("coalesce(text, '') = ''").select(
        "doc_id", *[F.lit(0).cast("long").alias(c) for c in columns], F.lit("").alias("groups_sha256")
    )
    return found.unionByName(without)
