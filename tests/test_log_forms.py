"""Training logs written as files of a bounded number of records."""

from __future__ import annotations

import json
from pathlib import Path

import compare
from qaloom.plans import monitoring
from qaloom.plans.registry import ORACLE, QUERIES


def test_files_grow_with_the_events(spark, tmp_path):
    rows = [(i % 40, i, float(i)) for i in range(4000)]
    metrics = spark.createDataFrame(rows, "run_id long, step long, loss double").selectExpr("*", "run_id % 10 AS run")
    monitoring.write_log_forms(metrics, str(tmp_path / "logs"), records=50)
    files = sorted(Path(tmp_path / "logs").rglob("part-*.txt"))
    logs = [json.loads(f.read_text()) for f in files]
    sizes = [len(x) if isinstance(x, list) else len(x["log_history"]) for x in logs]
    assert len(files) == 80 and sum(sizes) == 4010 and max(sizes) < 100


def test_many_files_give_the_same_runs(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(monitoring.write_log_forms, "__defaults__", (7,))
    found = QUERIES["training_log_forms"](spark, sf_dir)
    assert compare.differences(found, compare.connection(sf_dir), ORACLE["training_log_forms"]) is None
