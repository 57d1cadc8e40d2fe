"""Streams fed in several micro-batches give what the batch form gives."""

from __future__ import annotations

import math
import time

import pytest
from pyspark.sql import functions as F

from qaloom.fixed_values import ASSISTANT as A
from qaloom.fixed_values import HUMAN as H
from qaloom.functions import text as X
from qaloom.operators import chat, curate, monitor
from qaloom.streaming.known import NewTexts
from qaloom.streaming import stateful
from qaloom.streaming.tables import run_to_table, stream_of, stream_table, write_slices
from qaloom.plans import generation, streams  # noqa: F401
from qaloom.plans.registry import QUERIES
from test_monitor import SCHEMA, runs


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def fed(df, key, order, path, operator):
    """A table through a stream in four micro-batches at least."""
    write_slices(df, key, order, f"{path}/in")
    stream = stream_table(df.sparkSession, f"{path}/in", per_trigger=2)
    rows = run_to_table(operator(stream), str(path)).collect()
    assert len(list((path / "checkpoint/commits").glob("[0-9]*"))) >= 3
    return rows


def test_health_stream(spark, tmp_path):
    df = spark.createDataFrame(runs(n=40), SCHEMA)
    got = fed(df, "run_id", "step", tmp_path, stateful.health_stream)
    want = {(r.run_id, r.step): r for r in monitor.health(df).collect()}
    means = {(r.run_id, r.step): r.avg_loss for r in monitor.rolling_loss(df).collect()}
    assert {(r.run_id, r.step) for r in got} == set(want)
    for r in got:
        key = (r.run_id, r.step)
        assert (r.bad_count, r.status) == (want[key].bad_count, want[key].status)
        assert same(r.avg_loss, means.get(key)) or r.avg_loss == pytest.approx(means[key])


def test_a_key_with_most_rows_goes_through_the_state(spark, tmp_path):
    # one run in many Arrow batches of shuffled rows, in one micro-batch
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    kept = spark.conf.get(size)
    rows = [(1, s, float(s % 7 + 1), None) for s in range(0, 9000, 3)] + [(2, s, 1.0, 1.0) for s in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).orderBy(F.rand(3))
    df.write.parquet(f"{tmp_path}/in")
    try:
        spark.conf.set(size, 400)
        got = run_to_table(stateful.health_stream(stream_table(spark, f"{tmp_path}/in")), str(tmp_path)).collect()
    finally:
        spark.conf.set(size, kept)
    want = {(r.run_id, r.step): (r.status, r.bad_count) for r in monitor.health(df).collect()}
    means = {(r.run_id, r.step): r.avg_loss for r in monitor.rolling_loss(df).collect()}
    assert {(r.run_id, r.step): (r.status, r.bad_count) for r in got} == want and len(got) == len(rows)
    assert all(r.avg_loss == pytest.approx(means.get((r.run_id, r.step))) for r in got if r.avg_loss is not None)
    assert sum(r.avg_loss is not None for r in got) == len(means)


def test_a_timer_drops_the_state_of_an_idle_key(spark, tmp_path):
    def hour(h):
        return f"2024-01-01 {h:02d}:00:00"

    batches = [[(1, 5, hour(0)), (2, 5, hour(0))], [(2, 6, hour(5))], [(2, 7, hour(6))], [(1, 3, hour(7)), (2, 4, hour(7))]]
    for i, batch in enumerate(batches):
        df = spark.createDataFrame(batch, "run_id bigint, step bigint, at string")
        df.selectExpr("run_id", "step", "1.0D loss", "NULL :: double grad_norm", "at :: timestamp at").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(1.1)
    stream = stream_table(spark, f"{tmp_path}/in", per_trigger=1).withWatermark("at", "0 seconds")
    watched = stateful.health_stream(stream, idle_ms=2 * 3600 * 1000, clock="event")
    got = {(r.run_id, r.step): r.status for r in run_to_table(watched, f"{tmp_path}/out").collect()}
    # run 1 was idle for longer than two hours, so its step 3 starts anew; run 2 was not, so 4 is late
    assert got == {(1, 5): "ok", (2, 5): "ok", (2, 6): "ok", (2, 7): "ok", (1, 3): "ok", (2, 4): "late"}


def test_a_table_of_one_or_many_files_is_a_stream(spark, tmp_path):
    folder = f"{tmp_path}/many/documents.parquet"
    spark.range(50).repartition(5).write.parquet(folder)
    (file,) = (tmp_path / "many/documents.parquet").glob("part-00000*")
    (tmp_path / "one").mkdir()
    for name in ("documents.parquet", "documents.parquet.old"):
        (tmp_path / "one" / name).write_bytes(file.read_bytes())
    one = spark.read.parquet(str(file)).count()
    for path, rows in ((folder, 50), (f"{tmp_path}/one/documents.parquet", one), (f"file://{folder}/", 50)):
        assert run_to_table(stream_of(spark, path), f"{tmp_path}/out{len(path)}").count() == rows


def test_shared_steps_are_worked_out_once(spark):
    texts = ["", " ", None, "a. b", "x" * 30 + ". " + "y" * 30 + ".z", "-**--", f"{H}q{A} (a) ** b\n\nc ### d. e", "`" * 7 + " a\tb"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    got = streams.stateless(rows, ["id"])
    answer = X.extract_answer("text")
    alone = rows.select("id", X.clean_answer(answer), X.answer_ok(X.clean_answer(answer)), X.clean_chat(answer))
    assert sorted(map(tuple, got.select("id", "clean", "ok_answer", "chat").collect())) == sorted(map(tuple, alone.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") <= 9 and plan.count("split(") <= 1  # nine in clean_technical and clean_answer


def test_clean_stream_reads_a_folder_of_files(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got, want = (QUERIES["clean_stream"](spark, d) for d in (str(tmp_path), sf_dir))
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_late_events(spark, tmp_path):
    df = spark.createDataFrame([(1, 5, 1.0, None), (1, 9, 1.0, None)], SCHEMA)
    late = spark.createDataFrame([(1, 7, math.nan, None), (1, 10, 2.0, 120.0)], SCHEMA)
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    time.sleep(1.1)
    late.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = stream_table(spark, f"{tmp_path}/in", per_trigger=1)
    got = run_to_table(stateful.health_stream(stream), f"{tmp_path}/out").collect()
    assert {r.step: r.status for r in got} == {5: "ok", 9: "ok", 7: "late", 10: "warn_grad_high"}


def test_chat_stream(spark, tmp_path):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c}.{t}") for c in range(3) for t in range(16)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = fed(df, "conv_id", "turn", tmp_path, stateful.chat_stream)
    for span in (100_000, 3):
        batch = chat.chat_context(curate.compose_qa(df, span), span=span).collect()
        assert sorted((r.conv_id, r.turn, r.exchange_no, r.n_past, r.context) for r in got) == sorted(
            (r.conv_id, r.turn, r.exchange_no, r.n_past, r.context) for r in batch
        )
    assert {r.occupancy for r in got if r.exchange_no >= 5} == {"5/5"}
    memory = chat.chat_memory(curate.compose_qa(df)).collect()
    assert all([e.question for e in r.memory] == [f"{r.conv_id}.{t}" for t in (6, 8, 10, 12, 14)] for r in memory)


def test_late_turns(spark, tmp_path):
    schema = "conv_id bigint, turn bigint, role string, text string"
    spark.createDataFrame([(1, 5, "user", "q")], schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    time.sleep(1.1)
    rows = [(1, 3, "user", "old"), (1, 9, "assistant", "a")]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = stream_table(spark, f"{tmp_path}/in", per_trigger=1)
    got = run_to_table(stateful.chat_stream(stream), f"{tmp_path}/out").collect()
    assert {(r.turn, r.is_late, r.exchange_no) for r in got} == {(3, True, None), (5, False, 1)}


def test_render_chat_is_one_row(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(25_000)] + [(2, 1, "user", None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r.rendered for r in chat.render_chat(df, "|").collect()}
    assert got == {1: "".join(f"t{t}|" for t in range(25_000)), 2: "|"}


def _new_texts(spark, path):
    texts = NewTexts(spark, path, "text", ["id"])
    texts.seed(spark.createDataFrame([(1, "old")], "id long, text string"))
    return texts


def _batch(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, text string")


def test_new_texts_over_batches_and_replays(spark, tmp_path):
    texts = _new_texts(spark, str(tmp_path))
    batches = [
        _batch(spark, (3, "a"), (2, "a"), (1, "old"), (4, None)),
        _batch(spark, (5, "a"), (6, "b"), (7, "b")),
        _batch(spark, (8, "old"), (9, "c"), (10, "b")),
    ]
    for number, batch in enumerate(batches):
        texts.add(batch, number)
    want = [(2, "a", 0), (6, "b", 1), (9, "c", 2)]
    assert sorted(map(tuple, texts.rows(batches[0]).collect())) == want
    texts.add(_batch(spark, (11, "d")), 1)  # a committed batch comes again
    assert sorted(map(tuple, texts.rows(batches[0]).collect())) == want


def test_new_texts_after_a_broken_batch(spark, tmp_path, monkeypatch):
    texts = _new_texts(spark, str(tmp_path))
    texts.add(_batch(spark, (1, "a")), 0)
    monkeypatch.setattr(texts, "_commit", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        texts.add(_batch(spark, (2, "a"), (3, "b")), 1)
    monkeypatch.undo()
    like = _batch(spark, (0, ""))
    assert [tuple(r) for r in texts.rows(like).collect()] == [(1, "a", 0)]
    texts.add(_batch(spark, (2, "a"), (3, "b")), 1)
    assert sorted(map(tuple, texts.rows(like).collect())) == [(1, "a", 0), (3, "b", 1)]


def test_new_texts_without_any(spark, tmp_path):
    like = _batch(spark, (0, ""))
    texts = NewTexts(spark, str(tmp_path), "text", ["id"])
    assert texts.rows(like).count() == 0
    texts.add(like.limit(0), 0)
    texts.add(_batch(spark, (1, "a")), 1)
    assert [tuple(r) for r in texts.rows(like).collect()] == [(1, "a", 1)]


def test_known_digests_meet_a_bloom_filter(spark, tmp_path):
    settings = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    plans = []
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        texts = _new_texts(spark, str(tmp_path))
        write = texts._write
        texts._write = lambda df, name, batch: (plans.append((name, df._jdf.queryExecution().optimizedPlan().toString())), write(df, name, batch))
        texts.add(_batch(spark, (1, "old"), (2, "new")), 0)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "might_contain" in dict(plans)["rows"]
    assert texts.rows(_batch(spark, (0, ""))).first().text == "new"


def test_new_texts_carry_any_columns(spark, tmp_path):
    batch = spark.createDataFrame([(1, "a", ("x",))], "id long, text string, `odd name` struct<`a.b`: string>")
    texts = NewTexts(spark, str(tmp_path), "text", ["id"])
    texts.add(batch, 0)
    assert texts.rows(batch).first()["odd name"]["a.b"] == "x"
