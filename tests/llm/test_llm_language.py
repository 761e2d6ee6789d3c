import collections
import math

import numpy as np
import pytest

import corpus_pipeline
from duosync.llm.common import Scratch, table
from duosync.llm.language import (
    SMOOTH,
    STRENGTH,
    Likelihoods,
    declared_language,
    identify_pages,
    learn,
    posterior,
    trigrams,
    visible,
)

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string, label string, _text string, language string"


@pytest.fixture(scope="module")
def model(spark):
    return learn(table(spark, SF, "documents").withColumnRenamed("lang", "label"), 150)


def test_held_out_accuracy(spark, model):
    """Texts alone; most weren't in the sample."""
    docs = table(spark, SF, "documents").filter("length(text) > 200").collect()
    right = [model.languages[int(np.argmax(model(r.text)))] == r.lang for r in docs]
    assert np.mean(right) > 0.98


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)


def brute(rows, model):
    """The same fusion from plain counts."""
    from urllib.parse import urlsplit

    k, cells = len(model.languages), []
    for i, url, html in rows:
        try:
            host = (urlsplit(url or "").hostname or "").lower()
        except ValueError:
            host = ""
        text, said = visible(html or ""), declared_language(html or "")
        likely = model(text) if sum(c.isalpha() for c in text) > 1 else None
        cells.append((i, host, said, likely))
    counts = collections.Counter()
    for _, host, said, likely in cells:
        if likely is not None:
            x = int(np.argmax(likely))
            domain, suffix = ".".join(host.split(".")[-2:]), host.split(".")[-1]
            for key in [("all", ""), ("host", host), ("domain", domain), ("said", said), ("suffix", suffix)]:
                counts[key, x] += 1
    of = lambda *key: np.array([counts[key, x] for x in range(k)], float)
    lean = lambda n, p: (n + STRENGTH * p) / (n.sum() + STRENGTH)
    base = lean(of("all", ""), np.full(k, 1 / k))
    for i, host, said, likely in cells:
        if likely is None:
            yield i, said, None, 0.0
            continue
        domain, suffix = ".".join(host.split(".")[-2:]), host.split(".")[-1]
        logs = [np.log(lean(of("host", host), lean(of("domain", domain), base))), likely]
        for key in (("said", said), ("suffix", suffix)):
            if key[1] and of(*key).any():
                logs.append(np.log((of(*key) + SMOOTH / k) / (of("all", "") + SMOOTH)))
        p = posterior(*logs)
        yield i, said, model.languages[int(np.argmax(p))] if p.max() >= 0.5 else None, p.max()


def test_against_brute_force(spark, model):
    given = table(spark, SF, "pages").limit(60).collect()
    rows = [(r.page_id, r.url, r.html) for r in given]
    rows += [(1000, "http://x.fr", "<html lang='FR-ca'>la"), (1001, "no address", "<p>the")]
    rows += [(1002, None, None), (1003, "http://x.fr", ""), (1004, "http://x.fr", "<p>123 ...")]
    rows += [(1005, "http://solo.de/", "ü"), rows[0], (None, None, "le de")]
    got = identify_pages(frame(spark, rows), model, Scratch(spark)).collect()
    key = lambda r: (str(r[0]), r[1])
    got = sorted(((r.page_id, r.declared, r.language, r.probability) for r in got), key=key)
    for g, w in zip(got, sorted(brute(rows, model), key=key), strict=True):
        assert g[:3] == w[:3] and g[3] == pytest.approx(w[3], abs=1e-6)


def test_declared_language_decides_short_texts(spark, model):
    """The same two letters, said to be in one language or another."""
    page = "<html lang={}><p>" + "x y"
    rows = [(i, f"http://h{i}.org", page.format(x)) for i, x in enumerate(["fr", "de"])]
    long = [(10 + i, f"http://g{i}.org", r.html) for i, r in enumerate(table(spark, SF, "pages").limit(90).collect())]
    got = identify_pages(frame(spark, rows + long), model, Scratch(spark)).collect()
    assert {r.page_id: r.language for r in got if r.page_id < 2} == {0: "fr", 1: "de"}


def test_visible_and_declared():
    html = "<HTML data-x='1' LANG=En-gb><script>le</script>a<!-- b --><b>c</b> 1 < 2<style>"
    assert visible(html).split() == ["a", "c", "1", "<", "2"] and declared_language(html) == "en"
    meta = "<meta content=de-AT http-equiv=content-language>"
    assert declared_language(meta) == "de" and declared_language("<p lang=fr>") == ""


def test_trigrams():
    assert len(trigrams("ab")) == 2 and len(trigrams("")) == 0 and len(trigrams("1 2 -")) == 0
    assert list(trigrams("Éa, B")) == list(trigrams("éa b"))


def test_nothing_to_learn_from(spark):
    empty = learn(spark.createDataFrame([(1, None, "x"), (2, "en", "")], "doc_id long, label string, text string"))
    assert empty.languages == []
    got = identify_pages(frame(spark, [(1, "u", "<p>text")]), empty, Scratch(spark)).collect()
    assert got[0].language is None and got[0].probability == 0
    model = Likelihoods({"en": np.ones(1 << 16)})
    assert identify_pages(frame(spark, []), model, Scratch(spark)).count() == 0


def test_posterior_is_a_distribution():
    p = posterior(np.array([-1000.0, -1001.0]), np.array([math.log(0.5), math.log(0.5)]))
    assert p.sum() == pytest.approx(1) and p[0] == pytest.approx(1 / (1 + math.exp(-1)))


def test_language_stage_keeps_columns(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _doc string, language int"
    rows = [(i, t, "en", "s", 1, "k", 7) for i, t in enumerate(["the rest of the text was in it"] * 5)]
    rows += [(90, None, None, None, None, None, None), (91, "", "en", "s", 0, "", 1), (92, "12 34", "en", "s", 5, "", 1)]
    docs = spark.createDataFrame(rows, schema)
    got = corpus_pipeline.language(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == list(range(5))
    assert corpus_pipeline.language(spark, docs.filter("false"), SF).count() == 0


def test_every_label_is_a_language(spark):
    """70 languages of which most have one text among thousands."""
    rows = [(i, "en", f"the rest of text {i}") for i in range(3000)]
    rows += [(9000 + i, f"l{i:02}", chr(0x4E00 + i) * 9) for i in range(70)]
    rows += [(None, "same", "same")] * 300
    labelled = spark.createDataFrame(rows, "doc_id long, label string, text string").repartition(3)
    model = learn(labelled, 50)
    assert model.languages == sorted({r[1] for r in rows})
    assert model.languages[int(np.argmax(model(chr(0x4E00 + 33) * 5)))] == "l33"


def test_declared_language_without_likelihood_is_a_candidate(spark, model):
    greek = "<html lang=el><p>\u03ba\u03b1\u03bb\u03b7\u03bc\u03ad\u03c1\u03b1 \u03ba\u03cc\u03c3\u03bc\u03b5 " * 4
    given = table(spark, SF, "pages").limit(60).collect()
    rows = [(1, "http://a.gr/", greek), (2, "http://b.gr/", greek)]
    # A known language's text that says that it is in another one; a text that says nothing.
    long = max(given, key=lambda r: len(visible(r.html)))
    rows += [(3, "http://c.org/", f"<html lang=xx><p>{visible(long.html)}"), (4, "http://d.org", greek.replace("lang=el", ""))]
    rows += [(100 + r.page_id, r.url, r.html) for r in given]
    got = {r.page_id: r for r in identify_pages(frame(spark, rows), model, Scratch(spark)).collect()}
    assert got[1].language == got[2].language == "el"
    assert got[3].language == got[100 + long.page_id].language in model.languages
    assert got[4].language in (None, *model.languages)
