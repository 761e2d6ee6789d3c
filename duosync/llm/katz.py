"""Katz backoff language model over pairs of tokens, and the scores of whole texts.

The model. A pair (h, w) that was seen r times has P(w|h) = d_r * r / (c(h) + e); any other w has
P(w|h) = a(h) * P(w), where a(h) shares out exactly what the seen pairs leave. P(w) is built in
the same way from single tokens, and its rest goes to one class of unknown tokens. d_r comes from Good
and Turing's estimate on smoothed counts for r <= 5 and is 1 above. e is a small constant, so a history without
rare successors leaves something too. After an unknown history P(w|h) = P(w).

Where things are. Token counts are a table. Pairs and where they occur are dealt by their second token,
so a part knows c(w), P(w) and c(h, w) of all its pairs; a frequent token is spread over several
parts by the first. A text's score is a sum over its tokens, in which every term needs what one part knows:

    seen pair:    log d_r r         - log(c(h) + e)
    other pair:   log P(w) + log b(h) - log(c(h) + e)     with b(h) = a(h) * (c(h) + e)

A pair that stands in very many documents would fill a part by itself. A sender that sees it in more than
its share of a block sends the part a count only, and the documents elsewhere; the part answers
with the pair's terms, which a join brings to the documents.

The last term belongs to the token h itself, wherever it is counted. d_r depends on counts of
counts of all parts, so texts and histories carry how many of their pairs were seen 1 to 5
times. Only b(h) takes a join: of the backed-off pairs with the table of histories.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duosync.llm.common import Scratch

RARE = 5
RESERVED = 0.1
BASE = 0.1
FOLDS = 10
# Tokens a sender handles at a time, and about as many meet in one part.
BLOCK_TOKENS = 2_000_000
PART_TOKENS = 1_000_000
BLOCK_DOCS = 1 << 18
# A pair is hot where it fills a quarter of what a block sends to a part, but in so many documents at least.
HOT_DOCS = 64
REMEMBERED = 400_000

# No word holds a space.
END = xxhash.xxh3_64_intdigest(b" end")
START = xxhash.xxh3_64_intdigest(b" start")


class Hashes(dict):
    """64-bit hash of each word, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = Hashes()


def tokens_of(text: bytes | None) -> np.ndarray:
    """Hashes of a UTF-8 text's tokens after lower-casing A-Z: its words, then one end."""
    words = (text or b"").lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    out[-1] = END
    return out


def is_held_out(doc_id: int | None) -> bool:
    """A tenth of the ids; a null id reads as an empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == 0


def discounts(counts: list[int]) -> list[float]:
    """d_1 .. d_5 from the numbers of types seen 1 .. 6 times.

    Katz's form of Good-Turing: types seen once give their mass to unseen ones, those seen more
    than five times keep theirs. The counts of counts are smoothed first, by a line through their logs
    against log r in which each weighs as much as its own accuracy. A line that falls faster than 1 / r
    gives factors in (0, 1). Without one, as in small samples, an absolute discount takes their place.
    """
    r, n = np.arange(1, RARE + 2), np.array(counts, float)
    some = n > 0
    if n[0] and some.sum() > 1:
        # The log of a count n has a variance of about 1 / n.
        x, y, weight = np.log(r[some]), np.log(n[some]), n[some]
        x, y = x - np.average(x, weights=weight), y - np.average(y, weights=weight)
        slope = (weight * x * y).sum() / (weight * x * x).sum()
        if slope < -1 - 1e-9:
            # (r + 1) n_(r + 1) / (r n_r) on the line.
            turing = ((r[:-1] + 1) / r[:-1]) ** (slope + 1)
            rest = (RARE + 1) ** (slope + 1)
            return ((turing - rest) / (1 - rest)).tolist()
    share = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    return [float(1 - share / r) for r in range(1, RARE + 1)]


class Tokens:
    """What every part knows about single tokens: totals, discounts, and the frequent ones."""

    def __init__(self, tokens: int, types: int, counts: list[int], texts: int):
        self.tokens, self.types, self.texts = tokens, types, texts
        self.discounts = discounts(counts)
        left = sum((1 - d) * r * n for r, (d, n) in enumerate(zip(self.discounts, counts), 1))
        self.unknown = (left + RESERVED) / (tokens + RESERVED)
        self.parts = max(8, -(-tokens // PART_TOKENS))
        self.hot = max(HOT_DOCS, BLOCK_TOKENS // (4 * self.parts))
        self.frequent: dict[int, int] = {}  # hash: count

    def probability(self, counts: np.ndarray) -> np.ndarray:
        """P(w) for tokens seen so often."""
        factor = np.ones(RARE + 2)
        factor[1:-1] = self.discounts
        seen = factor[np.minimum(counts, RARE + 1)] * counts / (self.tokens + RESERVED)
        return np.where(counts > 0, seen, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + BASE) / (self.tokens + BASE * (self.types + 1)))

    def spread(self, count: int) -> int:
        """Parts that a frequent token's pairs are dealt to."""
        return min(self.parts, -(-2 * count * self.parts // max(self.tokens, 1)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) over a task's texts outside the held-out fold, partly summed."""
    waiting: list[np.ndarray] = []
    size = 0

    def flush() -> pa.RecordBatch:
        words, n = np.unique(np.concatenate(waiting), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"]
        )

    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for doc_id, text in zip(batch.column(0), texts, strict=True):
            if not is_held_out(doc_id.as_py()):
                waiting.append(tokens_of(text.as_py()))
                size += len(waiting[-1])
                if size >= BLOCK_TOKENS:
                    yield flush()
                    waiting, size = [], 0
    if waiting:
        yield flush()


def count_tokens(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, Tokens]:
    """The table of token counts (word, n), and its totals."""
    counted = docs.mapInArrow(_count, "word long, n long").groupBy("word")
    table = scratch(counted.agg(F.sum("n").alias("n")))
    seen = [F.count(F.when(F.col("n") == r, 1)).alias(f"n{r}") for r in range(1, RARE + 2)]
    end = np.uint64(END).astype(np.int64).item()
    texts = F.sum(F.when(F.col("word") == end, F.col("n")))
    row = table.agg(F.sum("n"), F.count("*"), texts, *seen).first()
    tokens = Tokens(row[0] or 0, row[1], list(row[3:]), row[2] or 0)
    # At most twice as many as there are parts have such a share.
    often = table.filter(F.col("n") * 2 * tokens.parts >= max(tokens.tokens, 1)).collect()
    tokens.frequent = {r.word & (1 << 64) - 1: r.n for r in often}
    return table, tokens


# Columns of a block's share of one part. The arrays are compressed. Events are (word, history, doc, times); the
# hot ones are pairs with a count, and documents on the way to the result (word, history, doc, times).
SHARE = (
    "part int, block long, docs int, held binary, words binary, counts binary, histories binary,"
    " history binary, doc binary, times binary, hot_pairs binary, hot_docs binary, doc_ids binary, lengths binary"
)
_SHARE_NAMES = [f.split()[0] for f in SHARE.split(", ")]
_SHARE_KINDS = [pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 11


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpacked(raw: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype)


def _least_type(size: int):
    return np.uint16 if size <= 1 << 16 else np.uint32


def _scatter(word: np.ndarray) -> np.ndarray:
    """Spreads hashes once more, for the salt of a frequent token."""
    return (word * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)


def _events(texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """A block's vocabulary, and its distinct (word, history, doc) as places with how often each is."""
    lengths = np.array([len(t) for t in texts])
    words, word = np.unique(np.concatenate([*texts, [np.uint64(START)]]), return_inverse=True)
    begin = word[-1]
    word = word[:-1].astype(np.uint64)
    history = np.concatenate([[begin], word[:-1]]).astype(np.uint64)
    history[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = begin
    doc = np.repeat(np.arange(len(texts), dtype=np.uint64), lengths)
    bits, doc_bits = int(len(words)).bit_length(), int(len(texts)).bit_length()
    if 2 * bits + doc_bits <= 64:
        shift = np.uint64(bits + doc_bits), np.uint64(doc_bits)
        key = word << shift[0] | history << shift[1] | doc
        del word, history, doc
        key, times = np.unique(key, return_counts=True)
        word, history = key >> shift[0], key >> shift[1] & np.uint64((1 << bits) - 1)
        doc = key & np.uint64((1 << doc_bits) - 1)
    else:  # a text much longer than a block
        order = np.lexsort((doc, history, word))
        word, history, doc = word[order], history[order], doc[order]
        fresh = np.ones(len(word), bool)
        fresh[1:] = (np.diff(word) != 0) | (np.diff(history) != 0) | (np.diff(doc) != 0)
        at = np.flatnonzero(fresh)
        times = np.diff(np.append(at, len(word)))
        word, history, doc = word[at], history[at], doc[at]
    return words, *(v.astype(np.int32) for v in (word, history, doc, times))


def _send(tokens):
    def shares(block: int, ids: list, texts: list[np.ndarray]) -> Iterator[tuple]:
        known = tokens.value
        words, word, history, doc, times = _events(texts)
        held = np.array([is_held_out(i) for i in ids], bool)
        part = (words % np.uint64(known.parts)).astype(np.int32)[word]
        at = np.searchsorted(words, np.array(list(known.frequent), np.uint64))
        for place, (value, count) in zip(at.tolist(), known.frequent.items(), strict=True):
            if place < len(words) and words[place] == value:
                own = slice(*np.searchsorted(word, [place, place + 1]))
                salt = _scatter(words[history[own]]) % np.uint64(known.spread(count))
                part[own] = (part[own] + salt.astype(np.int32)) % known.parts
        # Events are sorted by pair: its documents stand side by side.
        first = np.flatnonzero((np.diff(word, prepend=-1) != 0) | (np.diff(history, prepend=-1) != 0))
        size = np.diff(np.append(first, len(word)))
        hot, hot_docs = np.zeros(len(word), bool), {}
        for a, n in zip(first[size > known.hot].tolist(), size[size > known.hot].tolist(), strict=True):
            own = slice(a, a + n)
            pair = np.uint64(words[word[a]]), np.uint64(words[history[a]])
            learned = times[own][~held[doc[own]]].sum()
            hot[own] = True
            there, to = hot_docs.setdefault(int(part[a]), ([], [])), (int(part[a]) + 1 + block) % known.parts
            there[0].append([*pair, np.uint64(learned)])
            passed = np.empty((n, 4), np.uint64)
            passed[:, 0], passed[:, 1], passed[:, 2], passed[:, 3] = *pair, doc[own], times[own]
            hot_docs.setdefault(to, ([], []))[1].append(passed)
        if hot.any():
            word, history, doc, times, part = (v[~hot] for v in (word, history, doc, times, part))
        order = np.argsort(part, kind="stable")
        part, word, history, doc, times = (v[order] for v in (part, word, history, doc, times))
        bounds = np.searchsorted(part, np.arange(known.parts + 1))
        home = block % known.parts
        number = np.empty(len(words), np.int64)
        for p in range(known.parts):
            a, b = bounds[p], bounds[p + 1]
            pairs, passed = hot_docs.get(p, ((), ()))
            if a == b and p != home and p not in hot_docs:
                continue
            fresh = np.flatnonzero(np.diff(word[a:b], prepend=-1))
            used = np.unique(history[a:b])
            number[used] = np.arange(len(used))
            yield (
                p,
                block,
                len(ids),
                _packed(np.packbits(held)),
                _packed(words[word[a:b][fresh]]),
                _packed(np.diff(np.append(fresh, b - a)).astype(np.uint32)),
                _packed(words[used]),
                _packed(number[history[a:b]].astype(_least_type(len(used)))),
                _packed(doc[a:b].astype(_least_type(len(ids)))),
                _packed(times[a:b].astype(np.uint32)),
                _packed(np.array(pairs, np.uint64)) if pairs else None,
                _packed(np.concatenate(passed)) if passed else None,
                # One part passes on who the documents are.
                _packed(np.array([[i is None, i or 0] for i in ids], np.int64)) if p == home else None,
                _packed(np.array([len(t) for t in texts], np.int64)) if p == home else None,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            for share in shares((task << 36) | (made << 20), ids, texts):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], k) for v, k in zip(share, _SHARE_KINDS, strict=True)],
                    _SHARE_NAMES,
                )

        for batch in batches:
            column = batch.column(1).cast(pa.binary())
            for doc_id, text in zip(batch.column(0), column, strict=True):
                ids.append(doc_id.as_py())
                texts.append(tokens_of(text.as_py()))
                size += len(texts[-1])
                if size >= BLOCK_TOKENS or len(ids) == BLOCK_DOCS:
                    yield from flush()
                    made, ids, texts, size = made + 1, [], [], 0
        if ids:
            yield from flush()

    return run


# Rows that parts give, by kind: TEXT (key document; n known tokens, x pairs by count, a base
# score, b score), HISTORY (key history; n tokens, x pairs by count, a their P(w)), BACKOFF (key document, other
# history, n pairs), PAIRS (x and n: types by count), NAME (key document, other id, n tokens), HOT (key document,
# other word, x1 history, n pairs), ANSWER (key history, other word; n times seen, x1 whether the word is known,
# a base score, b score).
TEXT, HISTORY, BACKOFF, PAIRS, NAME, HOT, ANSWER = range(7)
X = [f"x{r}" for r in range(1, RARE + 1)]
FOUND = "kind int, key long, other long, n long, " + ", ".join(f"{x} long" for x in X)
FOUND += ", a double, b double"


def _rows(kind: int, key: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    names = [f.split()[0] for f in FOUND.split(", ")]
    size, arrays = len(key), []
    for name in names:
        if name == "kind":
            arrays.append(pa.array(np.full(size, kind, np.int32)))
        elif name == "key":
            arrays.append(pa.array(key.astype(np.int64)))
        else:
            like = np.float64 if name in "ab" else np.int64
            values = columns.get(name)
            arrays.append(
                pa.nulls(size, pa.float64() if name in "ab" else pa.int64())
                if values is None
                else values
                if isinstance(values, pa.Array)
                else pa.array(values.astype(like))
            )
    return pa.RecordBatch.from_arrays(arrays, names)


def _meet(tokens):
    """All blocks' shares of one part to the rows described at ``FOUND``."""

    def sums(at: np.ndarray, weights: np.ndarray | None, size: int) -> np.ndarray:
        return np.bincount(at, weights, minlength=size)

    def run(table: pa.Table) -> pa.Table:
        known, out = tokens.value, []
        docs, held, hot = [], [], []
        words, counts, histories, history, doc, times = [], [], [], [], [], []
        first_doc, first_history = 0, 0
        for n in range(len(table)):
            s = {name: table.column(name)[n].as_py() for name in _SHARE_NAMES}
            docs.append(s["block"] + np.arange(s["docs"], dtype=np.int64))
            held.append(np.unpackbits(_unpacked(s["held"], np.uint8))[: s["docs"]].astype(bool))
            words.append(_unpacked(s["words"], np.uint64))
            counts.append(_unpacked(s["counts"], np.uint32))
            own = _unpacked(s["histories"], np.uint64)
            histories.append(own)
            kind = _least_type(len(own))
            history.append(_unpacked(s["history"], kind).astype(np.int32) + first_history)
            kind = _least_type(s["docs"])
            doc.append(_unpacked(s["doc"], kind).astype(np.int32) + first_doc)
            times.append(_unpacked(s["times"], np.uint32))
            first_doc += s["docs"]
            first_history += len(own)
            if s["hot_pairs"] is not None:
                hot.append(_unpacked(s["hot_pairs"], np.uint64).reshape(-1, 3))
            if s["hot_docs"] is not None:
                passed = _unpacked(s["hot_docs"], np.uint64).reshape(-1, 4)
                to, of = passed[:, 0].view(np.int64), passed[:, 1].view(np.int64)
                out.append(_rows(HOT, docs[-1][passed[:, 2].astype(np.int64)], other=to, x1=of, n=passed[:, 3]))
            if s["doc_ids"] is not None:
                ids = _unpacked(s["doc_ids"], np.int64).reshape(-1, 2)
                who = pa.array(ids[:, 1], mask=ids[:, 0].astype(bool))
                out.append(_rows(NAME, docs[-1], other=who, n=_unpacked(s["lengths"], np.int64)))
        if hot:  # their counts are events of a learned document that isn't there
            hot = np.concatenate(hot)
            words.append(hot[:, 0])
            counts.append(np.ones(len(hot), np.uint32))
            histories.append(hot[:, 1])
            history.append(np.arange(len(hot), dtype=np.int32) + first_history)
            doc.append(np.full(len(hot), first_doc, np.int32))
            times.append(hot[:, 2])
        docs, held = np.concatenate(docs), np.concatenate([*held, [False]])
        history, doc, times = np.concatenate(history), np.concatenate(doc), np.concatenate(times).astype(float)
        if len(doc):
            vocabulary, place = np.unique(np.concatenate(words), return_inverse=True)
            word = np.repeat(place.astype(np.int32), np.concatenate(counts))
            del words, counts, place
            before, place = np.unique(np.concatenate(histories), return_inverse=True)
            history = place.astype(np.int32)[history]
            del histories, place
            out += rows_of(known, docs, held, doc, vocabulary, word, before, history, times)
        return pa.Table.from_batches(out)

    def rows_of(known, docs, held, doc, vocabulary, word, before, history, times):
        weight = np.where(held[doc], 0.0, times)
        count = sums(word, weight, len(vocabulary)).astype(np.int64)
        at = np.searchsorted(vocabulary, np.array(list(known.frequent), np.uint64))
        for where, (value, n) in zip(at.tolist(), known.frequent.items(), strict=True):
            if where < len(vocabulary) and vocabulary[where] == value:
                count[where] = n
        chance = known.probability(count)
        base = known.base(count)
        # As a history of the next token, whatever that is.
        left = np.where((count > 0) & (vocabulary != END), -np.log10(count + RESERVED), 0.0)

        pair, back = np.unique((word.astype(np.int64) << 32) | history, return_inverse=True)
        seen = sums(back, weight, len(pair))
        del weight
        pair_word, pair_history = (pair >> 32).astype(np.int32), (pair & 0xFFFFFFFF).astype(np.int32)
        del pair
        rare = np.minimum(seen, RARE + 1).astype(np.int8)
        # A pair's own term: now for frequent and unseen ones, by its class for rare ones.
        own = np.where(seen > RARE, np.log10(np.maximum(seen, 1)), 0.0)
        own = np.where(seen == 0, np.log10(chance[pair_word]), own) + left[pair_word]
        size = len(docs)
        there = doc < size
        asked = np.unique(back[~there])
        if len(asked):
            w, h = pair_word[asked], pair_history[asked]
            yield _rows(
                ANSWER,
                before[h].view(np.int64),
                other=vocabulary[w].view(np.int64),
                n=seen[asked],
                x1=count[w] > 0,
                a=base[w],
                b=own[asked],
            )
        doc, word, history, back, times = (v[there] for v in (doc, word, history, back, times))
        kind = rare[back]
        texts = {
            "n": sums(doc, (count > 0)[word] * times, size),
            "a": sums(doc, base[word] * times, size),
            "b": sums(doc, own[back] * times, size),
        }
        for r, name in enumerate(X, 1):
            texts[name] = sums(doc[kind == r], times[kind == r], size)
        # Only documents with a token in this part.
        some = np.flatnonzero(np.bincount(doc, minlength=size))
        yield _rows(TEXT, docs[some], **{k: v[some] for k, v in texts.items()})
        del texts

        apart = kind == 0
        events, inverse = np.unique(
            (doc[apart].astype(np.int64) << 32) | history[apart], return_inverse=True
        )
        if len(events):
            yield _rows(
                BACKOFF,
                docs[events >> 32],
                other=before[events & 0xFFFFFFFF].view(np.int64),
                n=sums(inverse, times[apart], len(events)),
            )
        del events, inverse, doc, word, history, back, times

        here = np.flatnonzero(seen)
        total = len(before)
        of = pair_history[here]
        parts = {
            "n": sums(of, seen[here], total),
            "a": sums(of, chance[pair_word[here]], total),
        }
        types = {}
        for r, name in enumerate(X, 1):
            parts[name] = sums(of[seen[here] == r], None, total)
            types[name] = np.array([(seen == r).sum()])
        some = parts["n"] > 0
        yield _rows(HISTORY, before[some].view(np.int64), **{k: v[some] for k, v in parts.items()})
        yield _rows(PAIRS, np.zeros(1), n=np.array([(seen == RARE + 1).sum()]), **types)

    return run


def score_texts(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per document: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    The model learns from the documents outside the held-out fold and scores all; scores are log10. A null or
    empty text is its end token alone. A null id is in the held-out fold. Rows that repeat
    count and are scored each on their own. Without any text to learn from all tokens are of the
    unknown class, at probability 1. An empty table gives no rows. Only ``doc_id`` and ``text``
    are read.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    _, tokens = count_tokens(source, scratch)
    sent = spark.sparkContext.broadcast(tokens)
    found = scratch(
        source.mapInArrow(_send(sent), SHARE).groupBy("part").applyInArrow(_meet(sent), FOUND)
    )
    pairs = found.filter(F.col("kind") == PAIRS).agg(*[F.sum(x) for x in [*X, "n"]]).first()
    factors = discounts([n or 0 for n in pairs])
    # Log of a(h) * (c(h) + e): what seen pairs leave over what they would get as single tokens.
    leaves = sum((F.col(x) * (r * (1 - d)) for r, (x, d) in enumerate(zip(X, factors), 1)), F.lit(RESERVED))
    histories = scratch(
        found.filter(F.col("kind") == HISTORY)
        .groupBy(F.col("key").alias("history"))
        .agg(F.sum("n").alias("n"), F.sum("a").alias("a"), *[F.sum(x).alias(x) for x in X])
        .select("history", "n", F.log10(leaves / (1 - F.col("a"))).alias("backoff"))
    )
    # Documents of hot pairs: the larger side comes from a table, so Spark splits a pair's rows in the join.
    answers = scratch(
        found.filter(F.col("kind") == ANSWER).selectExpr(
            "key AS history", "other AS word", "n AS seen", "x1 AS known", "a AS base", "b AS own"
        )
    )
    hot = (
        found.filter(F.col("kind") == HOT)
        .selectExpr("key", "x1 AS history", "other AS word", "n AS times")
        .join(answers, ["history", "word"])
    )
    times = F.col("times")
    hot_texts = hot.select(
        "key",
        (times * F.col("known")).alias("n"),
        (times * F.col("base")).alias("a"),
        (times * F.col("own")).alias("b"),
        *[F.when(F.col("seen") == r, times).otherwise(0).alias(x) for r, x in enumerate(X, 1)],
    )
    apart = (
        found.filter(F.col("kind") == BACKOFF)
        .select("key", F.col("other").alias("history"), F.col("n").alias("times"))
        .unionByName(hot.filter("seen = 0").select("key", "history", "times"))
        .join(histories.drop("n"), "history")
        .groupBy("key")
        .agg(F.sum(times * F.col("backoff")).alias("backoff"))
    )
    terms = sum((F.col(x) * math.log10(r * d) for r, (x, d) in enumerate(zip(X, factors), 1)), F.col("b"))
    texts = (
        found.filter(F.col("kind") == TEXT)
        .select("key", "n", "a", "b", *X)
        .unionByName(hot_texts)
        .groupBy("key")
        .agg(*[F.sum(c).alias(c) for c in ("n", "a", "b", *X)])
        .select("key", F.col("n").alias("n_known"), F.col("a").alias("base_score"), terms.alias("own"))
    )
    named = found.filter(F.col("kind") == NAME).selectExpr("key", "other AS doc_id", "n AS n_tokens")
    begin = -math.log10(tokens.texts + RESERVED) if tokens.texts else 0.0
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0
    score = F.col("own") + F.coalesce("backoff", F.lit(0.0)) + F.lit(begin)
    return (
        named.join(texts, "key")
        .join(apart, "key", "left")
        .select(
            "doc_id",
            held.alias("held_out"),
            "n_tokens",
            "n_known",
            F.lit(tokens.tokens).cast("long").alias("train_tokens"),
            "base_score",
            score.alias("score"),
        )
    )
