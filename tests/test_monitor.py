"""The monitor against a plain walk over the events of each run."""

from __future__ import annotations

import math
import random

import pytest

from qaloom.operators import monitor
from qaloom.operators.reports import check_finite
from qaloom.streaming.stateful import RunHealth

PATIENCE = 3
LOSSES = [math.nan, math.inf, 0.0, 0.01, 0.5, 1.0, 3.0, 200.0, 5000.0, -1.0]
SCHEMA = "run_id bigint, step bigint, loss double, grad_norm double"


def runs(n=400, length=30, seed=5):
    rng = random.Random(seed)
    rows = []
    for run in range(n):
        usual = rng.choice([LOSSES, [0.01, 5000.0, 0.0, math.nan], [1.0, 0.5, 0.0], [1.0, 2.0]])
        step = 0
        for _ in range(length):
            step += rng.choice([1, 1, 1, 4])
            grad = rng.choice([None, math.nan, rng.uniform(0, 150), rng.uniform(0, 150), 1.0])
            rows.append((run, step, rng.choice(usual), grad))
    return rows


def walk(rows):
    """Verdict per event, by the monitor's contract."""
    out, state = {}, {}
    for run, step, loss, grad in sorted(rows, key=lambda r: r[:2]):
        s = state.setdefault(run, {"history": 0, "count": 0, "last": None, "over": False})
        if s["over"]:
            out[run, step] = (None, "after_stop")
            continue
        s["history"] += 1
        found = []
        bad = math.isnan(loss) or math.isinf(loss)
        if bad:
            s["count"] += 1
            found.append(("nan", s["count"] >= PATIENCE))
        elif loss == 0 and s["history"] > 10:
            found.append(("zero", True))
        elif s["last"] and loss > 100 * s["last"]:
            s["count"] += 1
            found.append(("explode", s["count"] >= PATIENCE))
        if not (found and found[-1][1]) and grad is not None:
            if math.isnan(grad) or math.isinf(grad):
                s["count"] += 1
                found.append(("grad", s["count"] >= PATIENCE))
            elif grad > 100:
                found.append(("grad_high", False))
        healthy = not bad and loss != 0
        stops = [name for name, stop in found if stop]
        if stops:
            s["over"] = True
            out[run, step] = (None if healthy else -1, "stop_" + stops[0])
            continue
        if healthy:
            s["count"], s["last"] = 0, loss
        name = found[0][0] if found else None
        label = "ok" if name is None else "warn_" + {"grad": "grad_nan"}.get(name, name)
        out[run, step] = (s["count"], label)
    return out


@pytest.fixture(scope="module")
def events(spark):
    rows = runs()
    return spark.createDataFrame(rows, SCHEMA), rows


@pytest.mark.parametrize("span", [100_000, 4, 1])
def test_health(events, span):
    df, rows = events
    want = walk(rows)
    got = {(r.run_id, r.step): r for r in monitor.health(df, PATIENCE, span=span).collect()}
    assert got.keys() == want.keys()
    for key, (count, status) in want.items():
        assert got[key].status == status, key
        if not status.startswith("stop"):
            assert got[key].bad_count == count, key
    stops = {s for _, s in want.values() if s.startswith("stop")}
    assert stops == {"stop_nan", "stop_zero", "stop_explode", "stop_grad"}


def test_state_machine_agrees():
    rows = runs(seed=6)
    want = walk(rows)
    machines = {}
    for run, step, loss, grad in sorted(rows, key=lambda r: r[:2]):
        machine = machines.get(run) or RunHealth(PATIENCE, None)
        count, status, _ = machine.observe(step, loss, grad)
        machines[run] = RunHealth(PATIENCE, machine.saved())
        assert status == want[run, step][1]
        if not status.startswith("stop"):
            assert count == want[run, step][0]
    late = machines[0].observe(1, 1.0, None)
    assert late[1] == "late" and machines[0].late == 1


def test_verdict(events):
    df, rows = events
    want = walk(rows)
    got = monitor.health_verdict(monitor.health(df)).collect()
    for r in got:
        mine = sorted((step, s) for (run, step), (_, s) in want.items() if run == r.run_id)
        stop = next(((step, s[5:]) for step, s in mine if s.startswith("stop_")), (None, "none"))
        assert (r.stop_step, r.stop) == stop
        assert r.n_seen == sum(s != "after_stop" for _, s in mine)
        assert r.n_warnings == sum(s.startswith("warn_") for _, s in mine)


@pytest.mark.parametrize("span", [100_000, 9])
def test_rolling(events, span):
    df, rows = events
    got = {(r.run_id, r.step): r.avg_loss for r in monitor.rolling_loss(df, span=span).collect()}
    by_run, verdicts = {}, walk(rows)
    for run, step, loss, _ in sorted(rows, key=lambda r: r[:2]):
        seen = by_run.setdefault(run, [])
        seen.append(loss)
        _, status = verdicts[run, step]
        if math.isfinite(loss) and loss != 0 and step % 10 == 0 and not status.startswith(("stop", "after")):
            mean = sum(seen[-10:]) / len(seen[-10:])
            value = got.pop((run, step))
            assert (math.isnan(mean) and math.isnan(value)) or value == pytest.approx(mean)
    assert not got


def test_run_summary(spark):
    rows = [("a", 5, 2.0, None), ("a", 10, 1.0, None), ("a", 12, None, 9.5)]
    df = spark.createDataFrame(rows, "run_id string, step bigint, loss double, train_runtime double")
    row = monitor.run_summary(df).first()
    assert (row.n_logged, row.last_step, row.first_loss, row.last_loss, row.train_runtime) == (2, 12, 2.0, 1.0, 9.5)


def test_check_finite(spark):
    inf, nan = math.inf, math.nan
    rows = [(1, "a", [1.0]), (2, "a", [inf, nan]), (3, "a", [inf]), (4, "b", [0.0]), (5, "c", [-inf])]
    df = spark.createDataFrame(rows, "id bigint, g string, v array<double>")
    got = {r.g: (r.n_bad, r.is_finite, r.first_bad, r.first_kind) for r in check_finite(df, "v", "id", ["g"]).collect()}
    assert got == {"a": (2, False, 2, "nan"), "b": (0, True, None, None), "c": (1, False, 5, "inf")}


def test_null_runs_are_runs(spark):
    rows = [(None, 1, 1.0, None), (None, 2, math.nan, None), (1, 1, 2.0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.run_id, r.step): r.status for r in monitor.health(df).collect()}
    assert got == {(None, 1): "ok", (None, 2): "warn_nan", (1, 1): "ok"}
