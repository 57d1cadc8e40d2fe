"""Plans that have to hold at any size."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  registers the queries
from qaloom.plans.registry import QUERIES
from qaloom.operators import monitor
from qaloom.operators.curate import compose_qa
from qaloom.operators.ordered import number_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_coalescing(spark):
    key = "spark.sql.adaptive.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def partitions_of(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_one_hot_key_is_spread(spark, no_coalescing):
    hot = spark.range(4000).select(F.lit(1).cast("bigint").alias("run_id"), F.col("id").alias("step"))
    assert partitions_of(number_rows(hot, ["run_id"], "step", "n", span=100)) > 4
    events = hot.withColumn("loss", F.lit(1.0)).withColumn("grad_norm", F.lit(1.0))
    assert partitions_of(monitor.health(events, span=100)) > 4
    turns = hot.select(
        F.col("run_id").alias("conv_id"),
        F.col("step").alias("turn"),
        F.when(F.col("step") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.lit("t").alias("text"),
    )
    pairs = compose_qa(turns, span=100)
    assert partitions_of(pairs) > 4 and pairs.count() == 2000


@pytest.mark.parametrize("name", ["dedup_first", "new_only", "trim_quantiles"])
def test_copies_meet_before_the_shuffle(spark, sf_dir, name):
    assert "partial_min(" in plan(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["chat_memory"])
def test_rank_limits_before_the_shuffle(spark, sf_dir, name):
    steps = plan(QUERIES[name](spark, sf_dir))
    assert "WindowGroupLimit" in steps and "Partial" in steps


@pytest.mark.parametrize(
    "name", ["is_qa", "flags_inspect", "clean_technical", "page_scan", "mask"]
)
def test_scans_read_only_what_is_used(spark, sf_dir, name):
    assert "struct<doc_id:bigint,text:string>" in plan(QUERIES[name](spark, sf_dir))


def test_ids_alone_decide_a_split(spark, sf_dir):
    assert "text" not in plan(QUERIES["split_exact"](spark, sf_dir)).split("FileScan")[1]


@pytest.mark.parametrize("name", ["classify_error", "mask", "previews", "split_by_hash", "artifact_name"])
def test_row_work_does_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan(QUERIES[name](spark, sf_dir))


def test_health_moves_its_rows_once(spark, sf_dir):
    df = QUERIES["health"](spark, sf_dir)
    df.collect()
    rows = [x for x in plan(df).split("Final Plan")[-1].split("Initial Plan")[0].splitlines() if "ShuffleQueryStage" in x]
    assert rows
    final = plan(df).split("Initial Plan")[0]
    assert "ReusedExchange" in final
