"""The pipeline against brute-force versions of its stages."""

import os
import uuid

import pytest
from test_llm_fm_index import brute as contaminated
from test_llm_minhash import brute as near
from test_llm_pack import check as packed

import corpus_pipeline
from duosync.llm.common import Scratch
from duosync.plans.lineage import checkpoint_folder

SF = "/root/testdata/sf0.001"
LONG = "the quick brown fox went over that lazy old dog again and again and again until it slept"


@pytest.fixture(scope="module")
def sf_dir(spark):
    """The given documents with odd ones: nulls, repeats, shared ids, no letters, a leak."""
    folder = f"{checkpoint_folder(spark)}/sf-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    leak = items.filter("item_id = 2").first().text
    odd = [
        (10_000, None, None, None, None),
        (10_001, "", "en", "src0", 0),
        (10_002, "12 34 .. !!", "en", "src0", 11),
        (10_003, LONG, "en", None, 1),
        (10_003, LONG, "en", None, 1),
        (10_004, LONG.upper().replace(" ", "\n"), None, "src1", 1),
        (10_005, f"{LONG[:40]} {leak} {LONG[40:]}", "en", "src1", 1),
        (None, "a document that nobody has given any number at all", "en", "src1", 1),
        (None, "a document that nobody has given any number at all", "en", "src1", 1),
        (10_006, "word " * 30_000, "en", "src2", 1),
    ]
    more = spark.createDataFrame(odd, docs.schema)
    docs.unionByName(more).repartition(3).write.parquet(f"{folder}/documents.parquet")
    items.write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_and_run(spark, sf_dir):
    scratch, docs = Scratch(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, after = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch(stage(spark, docs, sf_dir))
        after[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns

    given = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    spoken = [r for r in given if sum(c.isalpha() for c in r.text or "") > 1]
    left = after["language"]
    assert sorted(map(str, ((r.doc_id, r.text, r.source) for r in left))) == sorted(
        map(str, ((r.doc_id, r.text, r.source) for r in spoken))
    )
    said = {r.doc_id: r.lang for r in spoken if r.lang}
    assert sum(said.get(r.doc_id, r.lang) == r.lang for r in left) >= 0.98 * len(left)

    groups = near([(r.doc_id, r.text) for r in left if r.doc_id is not None])
    want = sorted(i for i, (_, root) in groups.items() if i == root)
    kept = after["near_dedup"]
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == want
    assert sum(r.doc_id is None for r in kept) == 1 and 10_004 not in want and 10_003 in want

    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    found = contaminated([(r.doc_id, r.text) for r in kept], [(r.item_id, r.text) for r in items])
    clean = sorted((str(doc) for doc, *_, hit in found if not hit))
    assert sorted(str(r.doc_id) for r in after["decontamination"]) == clean
    assert "10005" not in clean

    rows = [(r.doc_id, r.text) for r in after["decontamination"]]
    packed(rows, after["packing"], 2048)
    whole = corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "length", "ids_crc32")
    key = lambda r: (str(r.doc_id), r.start, r.length, r.ids_crc32)
    assert sorted(map(key, whole.collect())) == sorted(map(key, after["packing"]))


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("false")
    scratch = Scratch(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = scratch(stage(spark, docs, SF))
        assert docs.count() == 0


def test_rows_with_null_and_shared_ids(spark):
    other = "a wholly unlike text about ships, harbours, winds, sails and the long way home over the sea"
    third = "nobody gave this third one a number, though it also has words enough for many shingles in it"
    rows = [
        (5, LONG, 1), (None, LONG, 2), (None, LONG + " then", 3),  # copies of a named document
        (7, other, 4), (7, third, 5), (7, other, 6),  # one id, two texts
        (None, third + " indeed", 7),
        (9, None, 8), (None, None, 9),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int").repartition(3)
    got = corpus_pipeline.near_dedup(spark, docs, SF)
    assert got.columns == docs.columns
    kept = sorted((str(r.doc_id), str(r.text)) for r in got.collect())
    assert kept == sorted([("5", LONG), ("7", other), ("7", third), ("9", "None"), ("None", "None")])


def test_near_dedup_keeps_its_copy_and_its_choice_only(spark):
    folder = checkpoint_folder(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    docs = spark.createDataFrame([(1, LONG), (2, LONG), (3, "other")], "doc_id long, text string")
    got = corpus_pipeline.near_dedup(spark, docs, SF)
    (made,) = set(os.listdir(folder)) - before
    assert len(os.listdir(f"{folder}/{made}")) == 2
    assert sorted(r.doc_id for r in got.collect()) == [1, 3]
