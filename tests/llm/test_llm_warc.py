import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

import duosync.llm.warc as warc
from duosync.llm.common import Scratch

SCHEMA = "page_id long, url string, html string, block string, id string, place string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "b", "i", "p") for r in rows], SCHEMA).repartition(3)


def rows():
    random.seed(1)
    copy, other = "c" * 1200, "é" * 500  # the second is 1,000 bytes of UTF-8
    out = [(i, f"http://h/{i}", copy) for i in range(5)] + [(9, "http://h/9", copy)]
    out += [(20, None, other), (21, "u", other), (22, "u", "x" * 999), (23, "u", "x" * 999)]
    out += [(30, "u\r\nX: 1", None), (31, "u", ""), (None, None, copy), (32, "u", "short")]
    # Longer than a segment, with text that looks like a record, at random segment borders.
    fake = "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"
    out += [
        (40 + i, "u", "".join(random.choices(["a", "é", "日本", "\n", fake], k=400 + i)))
        for i in range(20)
    ]
    return out + [(60, "u", "r" * 3000)] * 2


def want(rows, least=1000):
    last = {}
    for i, _, t in rows:
        if i is not None:
            last[t or ""] = max(last.get(t or "", i), i)
    for i, _, t in rows:
        raw = (t or "").encode()
        again = len(raw) >= least and i != last.get(t or "", i)
        yield (
            i, len(raw), hashlib.sha1(raw).hexdigest(),
            *(("revisit", last[t]) if again else ("response", None)),
        )


def test_archive_pages(spark, monkeypatch):
    small = dict(segment_bytes=700, archive_bytes=4000)
    write = warc.write_archives
    monkeypatch.setattr(warc, "write_archives", lambda *a: write(*a, **small))
    got = warc.archive_pages(frame(spark, rows()), Scratch(spark)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want(rows()), key=key)
    assert got[0].asDict().keys() == {
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    }


def test_empty(spark):
    assert warc.archive_pages(frame(spark, []), Scratch(spark)).count() == 0


@pytest.fixture
def archived(spark):
    scratch = Scratch(spark)
    path = f"{scratch.folder}/warc"
    warc.write_archives(warc.plan_records(frame(spark, rows()), scratch), path, 700, 4000)
    return path


def test_payloads_round_trip(spark, archived):
    files = spark.read.format("binaryFile").load(archived).collect()
    assert len(files) > 5
    for f in files:  # each file is a sound archive of its own
        records = list(warc.read_records(bytes(f.content)))
        assert records[0][0]["warc-type"] == "warcinfo" and len(records) > 1
        plain = gzip.decompress(f.content)
        assert plain.endswith(b"\r\n\r\n") and list(warc.read_records(plain)) == records
    read = warc.read_archives(spark, archived)
    assert read.filter("type = 'continuation'").count() > 40
    # The order of segments must not matter.
    shuffled = read.orderBy(F.rand(3)).unionByName(read.filter("number = 2"))
    got = warc.payloads(warc.reassemble(shuffled)).filter("type = 'response'").collect()
    stored = sorted((str(i), (t or "").encode()) for (i, _, t), w in zip(rows(), want(rows())) if w[3] == "response")
    assert sorted((str(r.page_id), bytes(r.payload)) for r in got) == stored
    assert not [r for r in got if r.fault]


@pytest.mark.parametrize(
    "cut, fault",
    [
        ("number = 1", "no first segment"),
        ("number = 2 AND total IS NULL", "missing segment"),
        ("total IS NOT NULL", "no last segment"),
    ],
)
def test_lost_segments(spark, archived, cut, fault):
    read = warc.read_archives(spark, archived)
    got = warc.reassemble(read.filter(f"NOT coalesce({cut}, false)")).filter("fault IS NOT NULL")
    assert {r.fault for r in got.collect()} == {fault}
    assert got.filter("block IS NOT NULL").count() == 0


def test_wrong_total(spark, archived):
    read = warc.read_archives(spark, archived).withColumn("total", F.col("total") + 1)
    assert {r.fault for r in warc.reassemble(read).select("fault").collect()} == {
        None, "wrong total length"
    }


def test_chunks():
    for n in (0, 1, 5, 8, 9, 100):
        raw = bytes(range(n))
        assert warc.dechunked(warc.chunked(raw, 8)) == raw
    assert warc.dechunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for broken in (b"", b"5\r\nab", b"2\r\nabc\r\n0\r\n\r\n", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.dechunked(broken)


def test_cut_archive():
    record = warc.header([("WARC-Type", "response"), ("Content-Length", 10)])
    with pytest.raises(ValueError):
        list(warc.read_records(record + b"123"))
    with pytest.raises(ValueError):
        list(warc.read_records(b"junk\r\n"))
