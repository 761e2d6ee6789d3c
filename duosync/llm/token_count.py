"""Token counts of whole texts: batches of equal bytes, long texts cut where no token can cross.

Only lengths leave the workers. Each task cuts its texts into parts of at most ``PART_BYTES``, fills
batches of ``BATCH_BYTES`` with them, encodes a batch with one call of the library, and adds the parts'
lengths up again. So a call's memory is bounded by bytes, not by rows, whatever the texts' lengths.

Where a text may be cut. A byte-pair model joins neighbouring symbols only into pieces of its
vocabulary. Two characters that stand side by side in no piece are therefore never in one token,
and what is left of them doesn't influence what is right of them: the parts' tokens are the text's. This
holds for a model that takes the text as it is; one that normalises is given whole texts. A part
that starts inside the text must not get the space that the library puts before a text, so it is
led by a character that no piece holds, and the tokens of that lead are taken off again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 4096
PART_BYTES = 1 << 16
BATCH_BYTES = 1 << 18
# Rows whose sums are open at a time.
BATCH_ROWS = 4096

COUNTED = "doc_id long, n_bytes long, n_tokens long"


class Pieces:
    """Token counts by a sentencepiece ``.model`` file."""

    SPACE = "▁"  # what the library writes for a space

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.model = SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.model.serialized_model_proto())
        pieces = [p.piece.replace(self.SPACE, " ") for p in proto.pieces]
        self.neighbours = {two for p in pieces for two in zip(p, p[1:])}
        held = set().union(*pieces)
        self.lead = next((c for c in "\n\x00\x01\x02" if c not in held), None)
        spec, trained = proto.normalizer_spec, proto.trainer_spec
        as_is = not spec.precompiled_charsmap and not spec.remove_extra_whitespaces
        user = any(p.type == p.USER_DEFINED for p in proto.pieces)
        pairs = trained.model_type == trained.BPE and not trained.treat_whitespace_as_suffix
        self.splits = as_is and pairs and not user and self.lead is not None
        self.lead_tokens = len(self.model.encode(self.lead)) if self.splits else 0

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]

    def cuts(self, text: str, size: int) -> list[int]:
        """Safe places, each the last one at most ``size`` characters after the one before.

        A stretch without any safe place stays whole.
        """
        places, start = [], 0
        while self.splits and len(text) - start > size:
            inside = range(start + size, start, -1)
            beyond = range(start + size + 1, len(text))
            at = next((i for r in (inside, beyond) for i in r if self.safe(text[i - 1], text[i])), None)
            if at is None:
                break
            places.append(at)
            start = at
        return places

    def safe(self, left: str, right: str) -> bool:
        left, right = (" " if c == self.SPACE else c for c in (left, right))
        return (left, right) not in self.neighbours


class Tokens:
    """Token counts by a tokenizers ``.json`` file; its texts are never cut."""

    lead, lead_tokens = "", 0

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def cuts(self, text: str, size: int) -> list[int]:
        return []


_counters: dict[str, Pieces | Tokens] = {}


def counter(path: str) -> Pieces | Tokens:
    """One per file and worker process."""
    if path not in _counters:
        _counters[path] = Tokens(path) if path.endswith(".json") else Pieces(path)
    return _counters[path]


def parts_of(model: Pieces | Tokens, text: str, n_bytes: int, size: int) -> list[str]:
    """The text's parts of about ``size`` bytes; all but the first have the lead before them."""
    if n_bytes <= size:
        return [text]
    # As many characters as have ``size`` bytes on average.
    places = model.cuts(text, max(1, size * len(text) // n_bytes))
    ends = [*places, len(text)]
    return [
        (model.lead if start else "") + text[start:end]
        for start, end in zip([0, *places], ends, strict=True)
    ]


def _count(path: str, part_bytes: int, batch_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(path)
        ids: list[int | None] = []
        sizes: list[int] = []
        totals: list[int] = []
        parts: list[str] = []
        owners: list[int] = []
        waiting = 0

        def encode() -> None:
            nonlocal waiting
            for owner, n in zip(owners, model.lengths(parts), strict=True):
                totals[owner] += n
            parts.clear()
            owners.clear()
            waiting = 0

        def flush() -> pa.RecordBatch:
            encode()
            columns = [pa.array(c, pa.int64()) for c in (ids, sizes, totals)]
            for c in (ids, sizes, totals):
                c.clear()
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens"])

        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for doc_id, value in zip(batch.column(0), texts, strict=True):
                raw = value.as_py() or b""
                text = raw.decode(errors="replace")
                cut = parts_of(model, text, len(raw), part_bytes)
                ids.append(doc_id.as_py())
                sizes.append(len(raw))
                totals.append(-model.lead_tokens * (len(cut) - 1))
                for part in cut:
                    parts.append(part)
                    owners.append(len(ids) - 1)
                    waiting += min(len(raw), part_bytes)
                    if waiting >= batch_bytes:
                        encode()
                if len(ids) == BATCH_ROWS:
                    yield flush()
        if ids:
            yield flush()

    return run


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    limit: int = LIMIT,
    part_bytes: int = PART_BYTES,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """One row per document: (doc_id, n_bytes, n_tokens, over_limit).

    ``tokenizer`` is the path, readable by every worker, of a ``.model`` or ``.json`` file. Counts are those of
    the library for the whole text, without begin, end or added special tokens and without
    truncation; strings of special tokens inside a text are read as the library does by default. A
    null text is empty: no bytes and no tokens. Rows that repeat or share an id are counted each on
    their own; a null id stays null. ``over_limit`` holds above ``limit`` tokens, not at it. A very long text is
    held by one task, but encoded in parts; one without any safe place is encoded whole. Invalid UTF-8
    is read as U+FFFD, its bytes are counted as they are. An empty table gives no rows. Only
    ``doc_id`` and ``text`` are read, whatever other columns there are. Nothing is shuffled.
    """
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counted = source.mapInArrow(_count(tokenizer, part_bytes, batch_bytes), COUNTED)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
