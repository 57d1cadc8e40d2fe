"""SentencePiece, quality rules and line dedup against the library, brute force and SQL."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

import compare
from qaloom.llm import lines, pieces, quality, queries

PLAIN_WORD = re.compile("[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())


@pytest.fixture(scope="module")
def encoder():
    with open(queries.piece_model(), "rb") as file:
        return pieces.Encoder(file.read())


def made_texts(library):
    rng = random.Random(3)
    chars = "ab cdeéthinr  \n\t▁ﬁ日本\U0001f600<0x41>  .,'\"\u0000́aaaa"
    texts = ["", " ", "   ", "▁x", "<s></s><unk>", "a" * 3000, " " * 3000, "ab" * 500, " " * 40 + "x"]
    texts += ["".join(rng.choice(chars) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    known = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000, 7)]
    return texts + ["".join(rng.choice(known) for _ in range(rng.randint(1, 12))) for _ in range(3000)]


def test_encodes_and_decodes_like_the_library(library, encoder):
    texts = made_texts(library)
    flat, counts = encoder.encode(texts)
    for text, end, n in zip(texts, np.cumsum(counts), counts):
        ids = flat[end - n : end].tolist()
        assert ids == library.encode(text), text
        assert pieces.decode_ids(encoder.model, ids) == library.decode(ids)


def test_decodes_any_ids_like_the_library(library, encoder):
    rng = random.Random(5)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(1, 32000), rng.randrange(1, 259)]) for _ in range(rng.randint(0, 12))]
        assert pieces.decode_ids(encoder.model, ids) == library.decode(ids)


def test_long_words_end_in_the_heap(library, encoder, monkeypatch):
    monkeypatch.setattr(pieces, "ROUNDS", 2)
    words = ["▁internationalisation", "▁" * 100, "▁" + "the" * 50]
    flat, sizes = pieces.merge_words(encoder.model, words)
    for word, end, n in zip(words, np.cumsum(sizes), sizes):
        assert flat[end - n : end].tolist() == library.encode(word[1:].replace("▁", " "))


def test_round_trip_of_tables(spark, sf_dir, library, odd_docs, no_docs):
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), odd_docs):
        texts = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=repr)
        want = [(i, library.encode(t), library.decode(library.encode(t))) for i, t in texts]
        found = pieces.round_trip(docs, queries.piece_model())
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
        again = pieces.decode(found, queries.piece_model())
        assert sorted(map(tuple, again.collect()), key=repr) == sorted(((i, d) for i, _, d in want), key=repr)
    assert pieces.round_trip(no_docs, queries.piece_model()).count() == 0


def plain_counts(text):
    text = text or ""
    words = PLAIN_WORD.findall(text)
    places = defaultdict(list)
    for k in range(len(words) - 7):
        places[tuple(words[k : k + 8])].append(k)
    covered = {w for at in places.values() if len(at) > 1 for k in at for w in range(k, k + 8)}
    full = [x for x in text.split("\n") if PLAIN_WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, len(full) - len(set(full)), len(covered), failed


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_quality_counts(spark, sf_dir, odd_docs, no_docs):
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), odd_docs):
        found = quality.quality(docs).select("row_id", *COUNTS).collect()
        want = [(r["doc_id"], *plain_counts(r["text"])) for r in docs.collect()]
        assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
    assert quality.quality(no_docs).count() == 0
    assert quality.keep_good(no_docs).columns == no_docs.columns
    assert [r["doc_id"] for r in quality.keep_good(odd_docs).collect()] == []


def test_distances(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    references = quality.language_references(docs).collect()
    rows = docs.collect()
    for ref in references:
        own = [r["text"].lower() for r in rows if r["lang"] == ref["lang"]]
        counts = defaultdict(int)
        for text in own:
            for w in PLAIN_WORD.findall(text):
                counts[w] += 1
        top = sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[: quality.COMMON_WORDS]
        assert list(zip([bytes(w).decode() for w in ref["words"]], ref["counts"])) == top
        assert ref["n_words"] == sum(counts.values())
    p, q = np.array([3, 0, 1]), np.array([1, 2, 1])
    a, b = p / 4, q / 4
    m = (a + b) / 2
    want = sum(x * np.log2(x / y) for d in (a, b) for x, y in zip(d, m) if x) / 2
    assert quality.js_distance(p, q) == pytest.approx(want**0.5)
    assert quality.js_distance(p, p) == 0 and quality.js_distance(p, 0 * p) == 0


def test_verdicts_agree_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    judged = quality.quality(docs).join(labels, quality.F.col("row_id") == labels["doc_id"]).collect()
    good = [r for r in judged if r["quality"] == 1 and not r["base_failed"]]
    bad = [r for r in judged if r["quality"] == 0]
    assert all(r["kept"] for r in good) and sum(not r["kept"] for r in bad) > 0.8 * len(bad)


def plain_line_dedup(rows, min_sites):
    sites, first = defaultdict(set), {}
    for i, text, site in rows:
        for line in (text or "").split("\n"):
            if line.strip(" ") and site is not None:
                sites[line.strip(" ")].add(site)
                if i is not None:
                    first[line.strip(" ")] = min(i, first.get(line.strip(" "), i))
    out = []
    for i, text, _ in rows:
        gone = [
            len(sites[x.strip(" ")]) >= min_sites and (first.get(x.strip(" ")) is None or first[x.strip(" ")] != i)
            for x in (text or "").split("\n")
        ]
        kept = "\n".join(x for x, g in zip((text or "").split("\n"), gone) if not g)
        out.append((i, None if text is None else kept, sum(gone)))
    return sorted(out, key=repr)


def test_line_dedup(spark, odd_docs, no_docs):
    rng = random.Random(8)
    common = ["Licensed.", "  Licensed. ", "", "seven sites", "eight sites"]
    rows = [(i, "\n".join([f"own {i}", *rng.sample(common[:3], 2)]), f"s{i % 20}") for i in range(300)]
    rows += [(1000 + i, "seven sites", f"s{i % 7}") for i in range(40)]
    rows += [(2000 + i, "eight sites\nx\n", f"s{i % 8}") for i in range(40)]
    rows += [(None, "Licensed.\nmine", "s1"), (None, "Licensed.", None), (3000, None, "s2"), (3001, "Licensed.", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = lines.drop_boilerplate(df).select("row.doc_id", "clean", "n_dropped").collect()
    assert sorted(map(tuple, found), key=repr) == plain_line_dedup(rows, lines.MIN_SITES)
    for min_sites in (1, 3):
        odd = [(r["doc_id"], r["text"], r["source"]) for r in odd_docs.collect()]
        cleaned = lines.drop_boilerplate(odd_docs, min_sites=min_sites).select("row.doc_id", "clean", "n_dropped")
        assert sorted(map(tuple, cleaned.collect()), key=repr) == plain_line_dedup(odd, min_sites)
    assert lines.without_boilerplate(odd_docs).columns == odd_docs.columns
    assert lines.without_boilerplate(no_docs).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_as_sql(spark, sf_dir, name):
    con = compare.connection(sf_dir)
    assert compare.differences(queries.QUERIES[name](spark, sf_dir), con, queries.ORACLE[name]) is None
