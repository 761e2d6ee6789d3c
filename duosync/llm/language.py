"""Language identification that fuses several pieces of evidence by Bayes' rule.

    P(language | page) ~ P(language | host) * P(text | language) ** t
                         * P(declared | language) * P(suffix | language)

* The text's likelihood comes from byte trigrams in ``BUCKETS`` classes, learned from a bounded sample of
  each language's labelled texts. Trigrams overlap, so the exponent t counts them as less than independent.
* The host's prior is smoothed hierarchically: a host leans on its domain, a domain on all pages,
  the more so the fewer pages it has.
* A declared language without labelled texts is a candidate for the pages that declare it. All such languages
  share one class, with priors and tables like the others; its texts are half like all known languages
  together and half like anything.
* How far a declared language and an address suffix may be trusted is learned, too.

Priors and tables count the languages that the text alone gives, by grouped sums that are built up
before the shuffle. A page needs one row of each table, joined by key; hot keys are split.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duosync.llm.common import Scratch

BUCKETS = 1 << 16
# Labelled texts that each language's likelihoods are learned from, about.
SAMPLE = 1_000
# Languages whose counts a task holds at a time.
HELD = 64
# Label of declared languages that have no likelihood of their own.
OTHER = ""
# Pages that a parent's prior counts for, and a table's weight for what it hasn't seen.
STRENGTH, SMOOTH = 20.0, 1.0
TEMPER = 0.1
# Below this probability a text has no language; so has one with fewer letters than this.
LEAST_PROBABILITY, LEAST_LETTERS = 0.5, 2
BROADCAST_BYTES = 32 << 20

_TAGS = re.compile(
    r"<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[/!?a-zA-Z][^>]*(?:>|\Z)", re.S | re.I
)
_DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-zA-Z]{2,3})\b", re.I)
_META = re.compile(
    r"<meta\b(?=[^>]*\bcontent-language\b)[^>]*?\bcontent\s*=\s*[\"']?\s*([a-zA-Z]{2,3})\b", re.I
)


def visible(source: str) -> str:
    """A page without tags, scripts, styles and comments."""
    return _TAGS.sub(" ", source)


def declared_language(source: str) -> str:
    """The page's own statement: primary subtag in lower case, or empty."""
    head = _DECLARED.search(source) or _META.search(source)
    return head[1].lower() if head else ""


def letters(text: str) -> int:
    """How many letters a text has, counted no further than needed."""
    count = 0
    for c in text:
        if c.isalpha():
            count += 1
            if count >= LEAST_LETTERS:
                break
    return count


def trigrams(text: str) -> np.ndarray:
    """Classes of the byte trigrams of a text's lower-case letters; other runs are one space."""
    raw = np.frombuffer((" " + text.lower() + " ").encode(), np.uint8)
    letter = (raw >= 128) | ((raw >= 97) & (raw <= 122))
    keep = letter | np.concatenate([[True], letter[:-1]])
    raw = np.where(letter, raw, 32)[keep].astype(np.uint32)
    if len(raw) < 3:
        return np.empty(0, np.uint32)
    codes = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    return (codes * np.uint32(0x9E3779B1)) >> np.uint32(16)


class Likelihoods:
    """Log probabilities of trigram classes by language."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.languages = sorted(counts)
        self.lower = frozenset(x.lower() for x in counts)
        table = np.array([counts[x] for x in self.languages], float).reshape(-1, BUCKETS) + 0.05
        table /= table.sum(axis=1, keepdims=True)
        any_known = table.sum(axis=0, keepdims=True) / max(len(table), 1)
        table = np.concatenate([table, 0.5 * any_known + 0.5 / BUCKETS])
        self.table = np.log(table).T.astype(np.float32, order="C")

    def foreign(self, declared: str) -> bool:
        """Whether this is a language without a likelihood of its own."""
        return declared != "" and declared.lower() not in self.lower

    def __call__(self, text: str | None) -> np.ndarray:
        """Tempered log likelihood by language; flat if there is nothing to go by."""
        return self.with_other(text)[:-1]

    def with_other(self, text: str | None) -> np.ndarray:
        """The same, and at the end that of a language that isn't known."""
        found = trigrams(text) if text else ()
        total = np.zeros(len(self.languages) + 1)
        for part in range(0, len(found), 1 << 16):
            total += self.table[found[part : part + (1 << 16)]].sum(axis=0, dtype=np.float64)
        return TEMPER * total


def posterior(*logs: np.ndarray) -> np.ndarray:
    """Normalised product of evidence given as logs."""
    total = np.sum(logs, axis=0)
    total = np.exp(total - total.max())
    return total / total.sum()


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}

    def flush() -> pa.RecordBatch:
        packed = [_packed(own) for own in counts.values()]
        return pa.RecordBatch.from_arrays(
            [pa.array(counts, pa.string()), pa.array(packed, pa.binary())], ["label", "counts"]
        )

    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if label not in counts and len(counts) >= HELD:
                yield flush()
                counts = {}
            own = counts.setdefault(label, np.zeros(BUCKETS, np.int64))
            own += np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
    if counts:
        yield flush()


def _packed(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.astype(np.int64).tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.int64)


def _summed(table: pa.Table) -> pa.Table:
    """A label's counts of all tasks in one row."""
    total = np.zeros(BUCKETS, np.int64)
    for raw in table.column("counts"):
        total += _unpacked(raw.as_py())
    return pa.table({"label": table.column("label").slice(0, 1), "counts": [_packed(total)]})


def learn(labelled: DataFrame, sample: int = SAMPLE) -> Likelihoods:
    """Likelihoods from about ``sample`` rows a label of (doc_id, label, text), the same ones each time.

    Rows are drawn by a hash at the rate that gives so many, and the first of each label. Null and empty
    labels and texts are left out; every label counts.
    """
    known = labelled.select("doc_id", "label", "text").filter("label > '' AND length(text) > 0")
    known = known.withColumn("draw", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / (1 << 30))
    sizes = known.groupBy("label").agg((sample / F.count("*")).alias("rate"), F.min("draw").alias("first"))
    # As few rows as the model has languages.
    drawn = known.join(F.broadcast(sizes), "label").filter("draw < rate OR draw = first")
    counts = "label string, counts binary"
    rows = drawn.select("label", "text").mapInArrow(_learn, counts)
    sums = rows.groupBy("label").applyInArrow(_summed, counts).collect()
    return Likelihoods({r.label: _unpacked(r.counts) for r in sums})


EVIDENCE = ["_text", "_declared", "_suffix", "_domain", "_host"]


def _labels(model):
    """(host, domain, suffix, declared, label, n): a task's pages by what the text alone says."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        likelihoods = model.value
        for batch in batches:
            text, *keys = (batch.column(c) for c in EVIDENCE)
            counts = Counter()
            for value, *key in zip(text, *(k.to_pylist() for k in keys), strict=True):
                value = value.as_py()
                if value and letters(value) >= LEAST_LETTERS:
                    likely = likelihoods.with_other(value)
                    if not likelihoods.foreign(key[0]):
                        likely = likely[:-1]
                    label = [*likelihoods.languages, OTHER][int(np.argmax(likely))]
                    counts[(*key[::-1], label)] += 1
            if counts:
                rows = [(*k, n) for k, n in counts.items()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(c, pa.int64() if i == 5 else pa.string())
                        for i, c in enumerate(zip(*rows, strict=True))
                    ],
                    ["host", "domain", "suffix", "declared", "label", "n"],
                )

    return run


def _by_language(counts: DataFrame, keys: list[str], languages: list[str]) -> DataFrame:
    """Counts per key as one array over the languages."""
    sums = [F.sum(F.when(F.col("label") == x, F.col("n")).otherwise(0)) for x in languages]
    return counts.groupBy(*keys).agg(F.array(*sums).alias("counts"))


def tables(counts: DataFrame, languages: list[str]) -> tuple[list[float], dict[str, DataFrame]]:
    """Evidence by key: log P(language | host) with its parents, log P(key | language) for others."""
    k = len(languages)
    row = _by_language(counts, [], languages).first()
    total = [float(n or 0) for n in row.counts]
    everywhere = [(n + STRENGTH / k) / (sum(total) + STRENGTH) for n in total]
    base = F.array(*[F.lit(p) for p in everywhere])
    lean = (
        "zip_with(counts, parent, (n, p) ->"
        f" (n + {STRENGTH}D * p) / (aggregate(counts, 0L, (a, n) -> a + n) + {STRENGTH}D))"
    )
    domain = (
        _by_language(counts, ["domain"], languages)
        .withColumn("parent", base)
        .select("domain", F.expr(lean).alias("parent"))
    )
    host = (
        _by_language(counts, ["host", "domain"], languages)
        .join(domain, "domain")
        .select("host", "domain", F.expr(lean).alias("prior"))
    )
    out = {"host": host.select("host", "domain", F.expr("transform(prior, p -> ln(p))").alias("_host_log"))}
    sizes = F.array(*[F.lit(n) for n in total])
    for key in ("declared", "suffix"):
        # Of a language's pages, those with this key; one more page speaks for keys not seen.
        share = f"zip_with(counts, sizes, (n, s) -> ln((n + {SMOOTH / k}D) / (s + {SMOOTH}D)))"
        out[key] = (
            _by_language(counts.filter(f"{key} <> ''"), [key], languages)
            .withColumn("sizes", sizes)
            .select(key, F.expr(share).alias(f"_{key}_log"))
        )
    return [math.log(p) for p in everywhere], out


def _decide(model, base: list[float], kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        likelihoods = model.value
        names = likelihoods.languages
        for batch in batches:
            columns = ("_text", "_declared", "_host_log", "_declared_log", "_suffix_log")
            found, probability = [], []
            for text, declared, host, *others in zip(*(batch.column(c) for c in columns), strict=True):
                text, declared, host = text.as_py(), declared.as_py(), host.as_py()
                best, chance = None, 0.0
                if names and text and letters(text) >= LEAST_LETTERS:
                    size = len(names) + likelihoods.foreign(declared)
                    logs = [host or base, *(o.as_py() for o in others if o.is_valid)]
                    logs = [np.array(x[:size]) for x in logs]
                    p = posterior(likelihoods.with_other(text)[:size], *logs)
                    best, chance = [*names, declared][int(np.argmax(p))], float(p.max())
                found.append(best if chance >= LEAST_PROBABILITY else None)
                probability.append(chance)
            own = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(found, pa.string()), pa.array(probability, pa.float64())],
                [*kept, "language", "probability"],
            )

    return run


def identify(rows: DataFrame, model: Likelihoods, scratch: Scratch) -> DataFrame:
    """Rows with ``EVIDENCE`` columns (text) to the other columns, ``language`` and ``probability``.

    Null evidence is no evidence: such a text has no language, such a key says nothing. ``language``
    is null, with probability 0, for a text with fewer than two letters, and null where no
    language reaches a probability of one half. Repeated rows each give a row; empty tables give none.
    """
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(model)
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in EVIDENCE})
    kept = [c for c in rows.columns if c not in EVIDENCE]
    fields = "host string, domain string, suffix string, declared string, label string, n long"
    if model.languages:
        counted = rows.select(EVIDENCE).mapInArrow(_labels(sent), fields)
        counted = counted.groupBy("host", "domain", "suffix", "declared", "label").agg(F.sum("n").alias("n"))
        counts = scratch(counted)
        foreign = (F.col("declared") != "") & ~F.lower("declared").isin(*sorted(model.lower))
        other = [OTHER] if counts.filter(foreign).limit(1).count() else []
        base, evidence = tables(counts, [*model.languages, *other])
    else:
        base, evidence = [], {}
    joined = rows
    for key in ("host", "declared", "suffix"):
        if not evidence:
            joined = joined.withColumn(f"_{key}_log", F.lit(None).cast("array<double>"))
            continue
        side = scratch(evidence[key])
        on = ["host", "domain"] if key == "host" else [key]
        size = side.agg(F.sum(sum((F.length(c) for c in on), F.lit(8 * len(base) + 16)))).first()[0]
        side = side.withColumnsRenamed({c: f"_{c}" for c in on})
        side = F.broadcast(side) if (size or 0) <= BROADCAST_BYTES else side
        joined = joined.join(side, [f"_{c}" for c in on], "left")
    schema = rows.select(kept).schema.add("language", "string").add("probability", "double")
    columns = [*kept, "_text", "_declared", "_host_log", "_declared_log", "_suffix_log"]
    return joined.select(columns).mapInArrow(_decide(sent, base, kept), schema)


def _page_evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sources = [s.as_py() or "" for s in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(map(visible, sources), pa.string()),
                pa.array(map(declared_language, sources), pa.string()),
            ],
            ["page_id", "url", "_text", "_declared"],
        )


def identify_pages(pages: DataFrame, model: Likelihoods, scratch: Scratch) -> DataFrame:
    """(page_id, url, host, declared, language, probability) of every page.

    Host, domain (its last two labels) and suffix (its last) are empty for an unreadable address.
    """
    raw = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    ).mapInArrow(_page_evidence, "page_id long, url string, _text string, _declared string")
    host = F.coalesce(F.lower(F.expr("try_parse_url(url, 'HOST')")), F.lit(""))
    rows = raw.withColumn("_host", host).select(
        "page_id",
        "url",
        F.col("_host").alias("host"),
        F.col("_declared").alias("declared"),
        "_text",
        "_declared",
        F.substring_index("_host", ".", -1).alias("_suffix"),
        F.substring_index("_host", ".", -2).alias("_domain"),
        "_host",
    )
    return identify(rows, model, scratch)


def with_language(docs: DataFrame, model: Likelihoods, scratch: Scratch) -> DataFrame:
    """Documents with ``language`` and ``probability``: (_doc, language, probability).

    ``lang`` is what a document declares and ``source`` is its host. ``_doc`` holds all columns
    as they are, whatever their names.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.col("text").cast("string").alias("_text"),
        F.lower(F.col("lang").cast("string")).alias("_declared"),
        F.lit("").alias("_suffix"),
        F.lit("").alias("_domain"),
        F.col("source").cast("string").alias("_host"),
    )
    return identify(rows, model, scratch)
