"""Readers, writers, rules and encodings on small fixtures."""

from __future__ import annotations

import json
import math

import pytest
from pyspark.sql import functions as F

from qaloom import fixed_values as fv
from qaloom.functions.text import training_text
from qaloom.operators import encode, monitor, reports, rules
from qaloom.operators.selection import split_exact
from qaloom.session import work_dir
from qaloom.sources import dataset
from qaloom.sources.files import list_files
from qaloom.sources.logs import read_training_log


def texts(df):
    return sorted(r.text for r in df.collect())


def test_dataset_reuse(spark, tmp_path):
    path = f"{tmp_path}/data"
    first = split_exact(dataset.from_rows(spark, ["a", "b", "c", "d", "e"]), ["sample_id"])
    second = split_exact(dataset.from_rows(spark, ["z"] * 3), ["sample_id"])
    assert texts(dataset.write_dataset(first, path)) == list("abcde")
    assert texts(dataset.write_dataset(second, path)) == list("abcde")
    assert dataset.verify_written(spark, path).first().passed
    sizes = reports.check_dataset(dataset.read_dataset(spark, path)).first()
    assert tuple(sizes) == (4, 1, True)
    assert texts(dataset.write_dataset(second, path, overwrite=True)) == ["z"] * 3
    plan = dataset.read_dataset(spark, path, "train")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_unreadable_data_is_rebuilt(spark, tmp_path):
    path = tmp_path / "data" / "split=train"
    path.mkdir(parents=True)
    (path / "part-0.parquet").write_bytes(b"not parquet")
    df = split_exact(dataset.from_rows(spark, ["a", "b"]), ["sample_id"])
    assert texts(dataset.write_dataset(df, str(tmp_path / "data"))) == ["a", "b"]


def test_a_write_that_fails_leaves_the_old_version(spark, tmp_path):
    path = f"{tmp_path}/data"
    old = split_exact(dataset.from_rows(spark, list("abcde")), ["sample_id"])
    dataset.write_dataset(old, path)
    reader = dataset.read_dataset(spark, path)
    fails = F.when(F.col("sample_id") < 3, F.col("text")).otherwise(F.raise_error(F.lit("broken off")))
    new = split_exact(dataset.from_rows(spark, list("vwxyz")), ["sample_id"]).withColumn("text", fails)
    with pytest.raises(Exception, match="broken off"):
        dataset.write_dataset(new, path, overwrite=True)
    assert texts(dataset.read_dataset(spark, path)) == texts(dataset.write_dataset(new, path)) == list("abcde")
    dataset.write_dataset(old.withColumn("text", F.upper("text")), path, overwrite=True)
    assert texts(dataset.read_dataset(spark, path)) == list("ABCDE")
    assert texts(reader) == list("abcde")  # a reader of the old version keeps its files


def test_a_lost_file_is_noticed(spark, tmp_path):
    path = tmp_path / "data"
    df = split_exact(dataset.from_rows(spark, list("abcde")), ["sample_id"])
    dataset.write_dataset(df, str(path))
    next((path / "_versions").glob("*/split=test/*.parquet")).unlink()
    assert texts(dataset.write_dataset(df, str(path))) == list("abcde")


def test_a_plain_folder_is_read(spark, tmp_path):
    path = f"{tmp_path}/data"
    split_exact(dataset.from_rows(spark, list("abc")), ["sample_id"]).write.partitionBy("split").parquet(path)
    assert texts(dataset.read_dataset(spark, path)) == texts(dataset.write_dataset(dataset.from_rows(spark, ["z"]), path)) == list("abc")


def test_measures_come_from_the_write(spark, tmp_path):
    rows = [f"{fv.HUMAN}\nq{i}?\n{fv.ASSISTANT}\n" + "a" * i for i in range(100)] + ["plain"]
    df = split_exact(dataset.from_rows(spark, rows), ["sample_id"])
    path = f"{tmp_path}/data"
    written = dataset.write_dataset(df, path, measures=reports.written_measures(target=110))
    got = reports.verdict(dataset.read_measures(spark, path)).first().asDict()
    train = written.where("split = 'train'")
    want = reports.verdict(reports.quality_report(reports.sample_flags(train))).first().asDict()
    assert {k: got[k] for k in want} == want
    assert (got["n_rows"], got["train_size"], got["test_size"], got["status"]) == (101, 80, 21, "near_target")
    assert "FileScan" not in dataset.read_measures(spark, path)._jdf.queryExecution().executedPlan().toString()
    empty = dataset.write_dataset(df.limit(0), f"{tmp_path}/none", measures=reports.written_measures())
    assert empty.count() == 0 and dataset.read_measures(spark, f"{tmp_path}/none").first().total == 0


def test_only_one_split(spark):
    df = dataset.from_rows(spark, ["a"]).withColumn("split", F.lit("train"))
    assert not reports.check_dataset(df).first().is_valid


@pytest.mark.parametrize("nested", [False, True])
def test_training_log(spark, tmp_path, nested):
    steps = [
        {"loss": 9.5, "grad_norm": math.nan, "epoch": 0.5, "step": 5},
        {"loss": math.inf, "step": 10},
        {"train_runtime": 60.5, "train_loss": 3.25, "epoch": 1.0, "step": 12},
    ]
    for run in ("r1", "r2"):
        (tmp_path / run).mkdir()
        log = {"log_history": steps, "best_metric": None} if nested else steps
        (tmp_path / run / "log.json").write_text(json.dumps(log, indent=2))
    df = read_training_log(spark, f"{tmp_path}/*/log.json")
    rows = df.where("run_id = 'r1'").orderBy("step").collect()
    assert [r.step for r in rows] == [5, 10, 12]
    assert [r.is_summary for r in rows] == [False, False, True]
    assert math.isnan(rows[0].grad_norm) and rows[1].loss == math.inf
    summary = monitor.run_summary(df).orderBy("run_id").collect()
    assert [(r.run_id, r.first_loss, r.train_runtime) for r in summary] == [("r1", 9.5, 60.5), ("r2", 9.5, 60.5)]


def test_manifest(spark, tmp_path):
    for folder, names in {
        "full": ["config.json", "tokenizer_config.json", "pytorch_model.bin", "model.safetensors"],
        "part": ["config.json", "notes.txt"],
    }.items():
        (tmp_path / folder).mkdir()
        for n in names:
            (tmp_path / folder / n).write_bytes(b"x" * 1024)
    files = list_files(spark, str(tmp_path))
    got = {r.folder: r for r in rules.check_manifest(files, fv.DOWNLOAD_REQUIRED, fv.DOWNLOAD_ANY_OF).collect()}
    assert (got["full"].missing, got["full"].chosen, got["full"].is_complete) == ([], "model.safetensors", True)
    assert (got["part"].missing, got["part"].chosen, got["part"].is_complete) == (["tokenizer_config.json"], None, False)
    assert got["full"].total_mb == pytest.approx(4 / 1024)


def test_latest_version(spark):
    names = ["checkpoint-25", "checkpoint-156", "checkpoint-9", "checkpoint-x", "other-900", "checkpoint"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert tuple(rules.latest_version(df).first()) == ("checkpoint-156", 156, 3)


def test_rules(spark):
    sizes = (0, 99, 100, 149, 150, 199, 200, 299, 300, 399, 400)
    rows = [(c, s) for c in ("small", "medium", "large") for s in sizes]
    df = spark.createDataFrame(rows, "class string, size bigint")
    got = {(r["class"], r["size"]): r.option for r in rules.rule_join(df, rules.epoch_rules(spark)).collect()}
    assert len(got) == len(rows)
    assert [got["small", s] for s in (0, 99, 100, 400)] == [3, 3, 2, 2]
    assert [got["medium", s] for s in (149, 150, 299, 300)] == [4, 3, 3, 2]
    assert [got["large", s] for s in (199, 200, 399, 400)] == [2, 3, 3, 4]
    names = [r.name for r in rules.available_presets(spark, None).collect()]
    assert names == ["cpu_optimized"]
    assert [r.name for r in rules.available_presets(spark, 6).collect()][0] == "balanced_gpu"


def test_time_estimate(spark):
    df = spark.createDataFrame([(205,)], "size bigint")
    got = {(r.option, r.device): (r.hours, r.minutes, r.cpu_epochs) for r in rules.time_estimate(df).collect()}
    assert got[4, "GPU"] == (1, 40, 5) and got[4, "CPU"] == (5, 0, 5) and got[1, "GPU"] == (0, 30, 4)


def test_quality_of_nothing(spark):
    empty = dataset.from_rows(spark, ["x"]).limit(0)
    row = reports.verdict(reports.quality_report(reports.sample_flags(empty))).first()
    assert (row.total, row.pct, row.avg_len, row.n_flags, row.verdict) == (0, None, 0.0, 0, "POOR")


def test_verdicts(spark):
    rows = [(95.0, 150.0, 0), (95.0, 150.0, 1), (90.0, 100.0, 5), (90.0, 100.0, 6), (79.9, 500.0, 0)]
    df = spark.createDataFrame(rows, "pct double, avg_len double, n_flags bigint")
    assert [r.verdict for r in reports.verdict(df).collect()] == ["EXCELLENT", "GOOD", "GOOD", "MODERATE", "POOR"]


def test_first_flags(spark):
    df = spark.createDataFrame([(i, ["a", "b"] if i % 2 else []) for i in range(20)], "i bigint, flags array<string>")
    got = reports.first_flags(df, ["i"], 3).collect()
    assert [(r.i, r.flag, r.n_more) for r in got] == [(1, "a", 17), (1, "b", 17), (3, "a", 17)]


def test_encode(spark):
    rows = [(1, "a b a c"), (2, "a b" + fv.END_TOKEN), (3, "d"), (4, "")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    vocab = encode.learn_vocab(df, 2)
    assert [(r.token, r.token_id) for r in vocab.orderBy("token_id").collect()] == [("a", 1), ("b", 2)]
    end = fv.END_TOKEN_ID
    want = {1: [1, 2, 1, 0], 2: [1, 2, end, end], 3: [0, end, end, end], 4: [end] * 4}
    one = encode.encode(df, vocab, 4, multiple=1)
    two = encode.encode_by_join(df, vocab, 4, ["id"], multiple=1)
    for got in (one, two):
        rows = {r.id: r for r in got.collect()}
        assert {i: r.input_ids for i, r in rows.items()} == want
        assert rows[2].attention_mask == [1, 1, 1, 0] and rows[2].labels == want[2]
    assert encode.encode(df, vocab, 4).orderBy("id").first().input_ids == want[1] + [end] * 4
    decoded = {r.id: r.decoded for r in encode.decode(one, vocab, ["id"]).collect()}
    assert decoded == {1: "a b a <unk>", 2: "a b", 3: "<unk>", 4: ""}
    checked = ("input_ids,attention_mask,labels", 4, 4, 4, True, True, "2x4")
    assert tuple(encode.check_encoded(one).first()) == checked
    assert tuple(encode.check_round_trip(df, vocab, ["id"]).first()) == (4, 2, 2)
    assert tuple(encode.check_round_trip(df, encode.learn_vocab(df, None), ["id"]).first()) == (4, 4, 4)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "scalar-subquery" not in plan and "Join" in plan


def test_round_trip(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 400")
    df = docs.select("doc_id", training_text("text").alias("text"))
    vocab = encode.learn_vocab(df, 50_000)
    rows = encode.decode(encode.encode(df, vocab, 512), vocab)
    want = {r.doc_id: r.text for r in df.collect()}
    for r in rows.collect():
        assert r.decoded == " ".join(want[r.doc_id].replace(fv.END_TOKEN, " ").split())


def test_work_dir_is_stable(spark):
    assert work_dir(spark) == work_dir(spark)


def test_encoding_goes_row_by_row(spark):
    # repeated, null and missing ids: every row comes back, and so does its own text
    rows = [(i % 3 or None, f"w{i} x{i} w{i}" if i % 7 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "`my id` int, text string")
    vocab = encode.learn_vocab(df, None)
    for ids in (["my id"], []):
        coded = encode.encode(df, vocab, 8, ids)
        assert coded.count() == 40 and coded.columns == [*ids, "input_ids", "attention_mask", "labels"]
    back = encode.decode(encode.encode(df, vocab, 8, ["my id"]), vocab, ["my id"]).collect()
    assert sorted(map(repr, back)) == sorted(f"Row(my id={i!r}, decoded={(t or '')!r})" for i, t in rows)
    assert tuple(encode.check_round_trip(df.dropna(subset=["text"]), vocab).first()) == (34, 34, 68)


def test_a_text_goes_with_one_of_its_words(spark):
    df = spark.createDataFrame([(1, "a b a " * 500), (2, None), (3, "")], "id int, text string")
    dealt = encode._dealt(df, ["id", "text"], F.col("text"))
    kept = encode._places(dealt, encode.tokens("_given"), "token").where("_keep IS NOT NULL").select("_keep.id").collect()
    assert sorted(r.id for r in kept) == [1, 2, 3]


def test_round_trip_of_words_is_that_of_whole_texts(spark):
    end = fv.END_TOKEN
    texts = ["a b a", f"a{end}b", "a  lost", "", " ", None, "two one", "lost a lost", f"{end}{end}", "b a", "<unk>", "twice a"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    words = [("a", 1), ("b", 2), ("one", 3), ("two", 3), ("twice", 5), ("closing", fv.END_TOKEN_ID), (None, 9)]
    vocab = spark.createDataFrame(words, "token string, token_id long")
    whole = df.select("text", F.array_join(F.filter(encode.tokens("text"), lambda w: w != end), " ").alias("asked"))
    back = encode.decode(encode.token_ids(whole, vocab, ["asked"]), vocab, ["asked"], "token_ids").collect()
    assert tuple(encode.check_round_trip(df, vocab).first()) == (len(texts), sum(r.decoded == r.asked for r in back), len(words))


def test_round_trip_of_a_long_text_moves_its_words_once(spark):
    # as many copies of the text as it has words would be 20 GB
    df = spark.createDataFrame([(" ".join(f"word{i:08}" for i in range(40_000)),)], "text string")
    vocab = encode.learn_vocab(df, None)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        assert tuple(encode.check_round_trip(df, vocab).first()) == (1, 1, 40_000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_texts_are_dealt_out_in_small_parts(spark):
    df = spark.createDataFrame([(1, "a b a")], "id int, text string")
    parts = encode.PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = encode.token_ids(df, encode.learn_vocab(df, None), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert f", {parts}), REPARTITION_BY_NUM" in plan


def test_words_and_positions_stay_where_their_text_is(spark):
    df = spark.createDataFrame([(1, "a b a")], "id int, text string")
    vocab = encode.learn_vocab(df, None)
    for coded in (encode.token_ids(df, vocab, ["id"]), encode.decode(encode.token_ids(df, vocab, ["id"]), vocab, ["id"], "token_ids")):
        plan = coded._jdf.queryExecution().executedPlan().toString()
        moves = [line for line in plan.splitlines() if "Exchange hash" in line]
        assert moves and all("hashpartitioning(_row" in line and "REPARTITION" in line for line in moves)


def test_rules_of_many_bands_meet_without_a_broadcast(spark):
    # bands of many widths, overlapping and open ones among them
    bands = spark.range(200_000).selectExpr("'c' || id % 2 AS class", "id * 10 - 500 AS lo", "id * 10 - 500 + 1 + id % 40 AS hi", "id AS option")
    bands = bands.unionByName(spark.createDataFrame([("c0", 1_000_000, None, -1), ("c1", -(2**40), 3, -2), ("c1", 5, 5, -3)], "class string, lo bigint, hi bigint, option bigint"))
    sizes = spark.range(3000).selectExpr("'c' || id % 3 AS class", "CASE WHEN id % 100 > 0 THEN id * 701 - 600 END AS size")
    key = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        joined = rules.rule_join(sizes, bands)
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
        got = sorted((r["class"], r["size"], r["option"]) for r in joined.collect())
    finally:
        spark.conf.set(key, kept)
    want = []
    for i in range(3000):
        size = i * 701 - 600
        if i % 100 and i % 3 < 2:
            near = range(max(0, (size + 500) // 10 - 6), min(200_000, (size + 500) // 10 + 2))
            want += [(f"c{i % 3}", size, b) for b in near if b % 2 == i % 3 and b * 10 - 500 <= size < b * 10 - 500 + 1 + b % 40]
            want += [("c0", size, -1)] if i % 3 == 0 and size >= 1_000_000 else []
            want += [("c1", size, -2)] if i % 3 == 1 and size < 3 else []
    assert got == sorted(want)
