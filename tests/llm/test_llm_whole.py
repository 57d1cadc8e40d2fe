"""Rows and texts that an earlier form left out."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from qaloom.llm import extraction, quality, shared, vectors
from test_llm_records import plain_vectors


def test_only_raw_elements_are_skipped():
    blocks = extraction.leaf_blocks
    texts = lambda page: [b.text for b in blocks(page)]
    for tag in ("<svg width='1'/>", "<math/>", "<noscript />", '<script src="x"/>', "<title/>"):
        assert texts(f"<p>a</p>{tag}<p>b</p><p>c</p>") == ["a", "b", "c"]
    assert texts("<p>a</p><title-bar>t</title-bar><math-box>m<p>b</p>") == ["a", "tm", "b"]
    assert texts("<article><p>so <math><mi>x</mi>=<mn>1</mn></math> holds</p></article>") == ["so x=1 holds"]
    assert texts("<div>x<noscript>n</noscript><svg><text>s</text></svg></div>") == ["xns"]
    assert [b.path[-1].split()[0] for b in blocks("<div><svg>s</svg></div><div><svg/>t</div>")] == ["svg", "div"]
    assert texts("<title>t</title ><textarea><p>u</textarea x><style>v</STYLE><p>b") == ["b"]
    assert texts("<script src=\"a>alert()</script><p>b") == ["b"]
    linked = blocks("<p><a href=/x/>text</a> and <a name='y'/>more")[0]
    assert linked.text == "text and more" and linked.linked == 4


@pytest.mark.parametrize("block", [vectors.BLOCK, 4])
def test_vectors_of_any_length(spark, block, monkeypatch):
    rng = np.random.default_rng(8)
    rows = []
    for size in (1024, 1025, 1536, 3072):
        centres = rng.normal(size=(3, size))
        near = lambda i: centres[i % 3] + rng.normal(size=size) * rng.choice([0.1, 0.4, 1])  # noqa: B023, E731
        rows += [(len(rows) + i, near(i).tolist(), i % 2) for i in range(24)]
    # vectors that differ past the leading components only
    rows += [(900 + i, [1.0] * 1024 + [3.0 * i] * 512, 5) for i in range(-3, 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = vectors.vector_groups(df, block=block).collect()
    want = plain_vectors(rows)
    assert sorted(map(tuple, found), key=repr) == want and sum(r[1] > 0 for r in want) > 10


def texts_of(page):
    return [b.text for b in extraction.leaf_blocks(page)]


def test_quotes_in_tags():
    assert texts_of("<p don't>hello</p><p>world</p>") == ["hello", "world"]
    assert texts_of("<p title=it's>kept?</p><p>later it's</p>") == ["kept?", "later it's"]
    assert texts_of("""<p a="x>y" b='>' c = "1>2">one</p>""") == ["one"]
    assert texts_of("""<p title="never closed>two</p><p>three</p>""") == ["two", "three"]
    assert texts_of("""<p a"b='c'd">four</p><p =">five</p>""") == ["four", "five"]
    assert texts_of("<p " + "a='b' " * 20_000 + ">six</p>") == ["six"]


def test_pages_with_odd_column_names(spark):
    df = spark.createDataFrame([(1, "u", "<article><p>some words here.</p></article>", 3)], "page_id long, `my col` string, html string, `a.b` int")
    rows = extraction.extract(df, keep=("my col", "a.b")).select("id", "row.*").collect()
    assert [(r["id"], r["my col"], r["a.b"]) for r in rows] == [(1, "u", 3)]


def test_sizes_with_units():
    told = {"67108864b": 64 << 20, "64m": 64 << 20, "1g": 1 << 30, "512kb": 512 << 10, "100": 100, "-1": -1}
    assert {k: shared.size_in_bytes(k) for k in told} == told


def plain_distance(p, q):
    p, q = ([x / sum(v) for x in v] for v in (p, q))
    parts = [sum(a * math.log2(2 * a / (a + b)) for a, b in zip(x, y) if a) for x, y in ((p, q), (q, p))]
    return math.sqrt(max(0.0, sum(parts) / 2))


def test_distances_and_verdicts_by_hand(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    rows = [r for r in docs.collect() if r["lang"] is not None]
    refs = {}
    for lang in {r["lang"] for r in rows}:
        words, classes = Counter(), Counter()
        for r in rows:
            if r["lang"] == lang:
                words.update(w for w in re.split(r"[\x20\x09-\x0D]+", (r["text"] or "").lower()) if w)
                classes.update(quality.TABLE[min(ord(c), 0x250)] for c in r["text"] or "")
        refs[lang] = (dict(sorted(words.items(), key=lambda x: (-x[1], x[0].encode()))[: quality.COMMON_WORDS]), sum(words.values()), classes)
    limits, kinds = quality.Limits(), range(len(quality.CLASSES))
    want = {}
    for r in rows:
        top, total, classes = refs[r["lang"]]
        text = r["text"] or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
        mine, own = Counter(words), Counter(quality.TABLE[min(ord(c), 0x250)] for c in text)
        by_class = plain_distance([own[k] for k in kinds], [classes[k] for k in kinds]) if len(text) >= limits.min_chars else 0
        inside = [mine[w] for w in top]
        by_word = plain_distance([*inside, len(words) - sum(inside)], [*top.values(), total - sum(top.values())]) if len(words) >= limits.min_words else 0
        want[r["doc_id"]] = (by_class, by_word)
    got = quality.quality(docs.where("lang is not null")).collect()
    assert len(got) == len(rows)
    for r in got:
        by_class, by_word = want[r["row_id"]]
        assert r["class_distance"] == pytest.approx(by_class, abs=1e-9) and r["word_distance"] == pytest.approx(by_word, abs=1e-9)
        assert r["kept"] == (not r["base_failed"] and by_class <= limits.class_distance and by_word <= limits.word_distance)


def test_verdicts_depend_on_text_and_reference_alone(spark, monkeypatch):
    # more languages than travel with the tasks: the rest is joined, with the same result
    text = "the cat sat on the mat and the dog ran off to the hill. " * 12
    rows = [(i, f"l{i % 50}", text if i % 3 else text.replace("e", "#")) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    references = quality.language_references(df)
    told = sorted(map(tuple, quality.quality(df, references).collect()))
    assert {r[-1] for r in told} == {True, False} or any(r[6] for r in told)
    monkeypatch.setattr(quality, "MAX_LANGUAGES", 7)
    assert sorted(map(tuple, quality.quality(df, references, keep_row=True).drop("row").collect())) == told
    one = df.where("doc_id = 4")
    assert [tuple(r) for r in quality.quality(one, references).collect()] == [r for r in told if r[0] == 4]
