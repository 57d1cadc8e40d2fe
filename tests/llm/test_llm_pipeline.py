"""The pipeline: what each stage takes, gives and decides."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__
import corpus_pipeline
from qaloom.llm import lines, mixing, pieces, quality, queries, simhash

ROOT = Path(__file__).parents[2]


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    """The documents and what each stage makes of its predecessor's table."""
    out = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stages_are_the_operators(tables):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "simhash_near_dedup", "mixing", "sentencepiece"]
    assert all(t.columns == tables[0].columns for t in tables[:-1])


def test_each_stage_decides_as_its_operator(spark, sf_dir, tables):
    docs, good, cleaned, single, mixed, encoded = tables
    kept = {r["row_id"] for r in quality.quality(docs).where("kept").collect()}
    assert rows(good) == [r for r in rows(docs) if r[0] in kept] and 0 < good.count() < docs.count()
    texts = {r["doc_id"]: r["clean"] for r in lines.drop_boilerplate(good).select("row.doc_id", "clean").collect()}
    assert {r["doc_id"]: r["text"] for r in cleaned.collect()} == texts
    names = {r["component_id"] for r in simhash.simhash_groups(cleaned).collect()}
    assert rows(single) == [r for r in rows(cleaned) if r[0] in names]
    assert single.count() < cleaned.count()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rated = mixing.mixing_rates(single, labels)
    times = {r["id"]: r["n"] for r in rated.select("id", mixing.copies(rated["rate"], rated["id"]).alias("n")).collect()}
    assert rows(mixed) == [r for r in rows(single) for _ in range(times[r[0]])]
    want = pieces.round_trip(mixed, queries.piece_model())
    assert rows(encoded) == rows(want)
    assert {r["doc_id"]: r["decoded"] for r in encoded.collect()} == {r["doc_id"]: r["text"] for r in mixed.collect()}


def test_run(spark, sf_dir, tables):
    assert rows(corpus_pipeline.run(spark, sf_dir)) == rows(tables[-1])


def test_odd_documents_pass_every_stage(spark, sf_dir, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf_dir).columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_registered():
    found = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {name.split("_")[0] for name in found} and "pipeline" in found
    assert set(queries.ORACLE) <= set(__spark_entry__.oracle_sql())


def test_nothing_else_imports_the_subpackage():
    allowed = {ROOT / "__spark_entry__.py", ROOT / "corpus_pipeline.py"}
    others = [p for p in ROOT.rglob("*.py") if "llm" not in p.parts and p not in allowed]
    assert not [p for p in others if re.search(r"qaloom\.llm|corpus_pipeline|from qaloom import llm", p.read_text())]
