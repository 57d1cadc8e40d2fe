"""Event-at-a-time operators on streams, with a small typed state per key.

They run on ``transformWithState``. A micro-batch may bring a key's rows in any order and
any number: rows of more than one Arrow batch are laid into a map state by ranges of their
position and taken out range by range, so that a task holds one batch and one range,
whatever share of the rows a key has. A row at or before the last position applied
is late: it is reported and not applied.

With ``idle_ms`` a timer drops the state of a key without rows for so long, so that states
don't add up for ever; a later row of it starts anew. ``clock`` says whether that
is processing time or, for streams with a watermark, event time. Streams that go on should
set it (``IDLE_MS`` is a week). One that runs over what is there and ends must not use
processing time, since Spark goes on with empty batches as long as a timer may fire.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import chain, islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from qaloom import fixed_values as fv
from qaloom.operators import chat, monitor

HEALTH_OUT = (
    "run_id bigint, step bigint, bad_count bigint, status string, avg_loss double, no_mean boolean"
)
CONTEXT_OUT = (
    "conv_id bigint, turn bigint, exchange_no bigint, n_past bigint, context string, "
    "occupancy string, is_late boolean"
)

IDLE_MS = 7 * 24 * 3600 * 1000
OUT_ROWS = 10_000
#: positions that share an entry of the map state
RANGE = 1_000
CLOCKS = {"processing": "ProcessingTime", "event": "EventTime"}
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _in_frames(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Rows as frames of bounded length."""
    while part := list(islice(rows, OUT_ROWS)):
        yield pd.DataFrame(part, columns=columns)


def use_rocks(spark: SparkSession) -> None:
    """These operators need the RocksDB state store, which takes the place of the default one in the session."""
    if spark.conf.get(PROVIDER).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(PROVIDER, ROCKS)


class _InOrder(StatefulProcessor):
    """Rows of a key by position, and the end of keys that stay idle.

    ``columns`` names the columns and their types, the position first.
    """

    columns: dict[str, str] = {}

    def __init__(self, idle_ms: int | None, clock: str):
        self.idle_ms, self.clock = idle_ms, clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        fields = ", ".join(f"{c} array<{kind}>" for c, kind in self.columns.items())
        self.waiting = handle.getMapState("waiting", "part bigint", fields)

    def by_position(self, frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        """The rows of a micro-batch in order; one frame is sorted at once, more go through the state."""
        names = list(self.columns)
        first = next(frames, None)
        second = next(frames, None)
        if second is None:
            if first is not None:
                yield from _sorted_rows([first[c].tolist() for c in names])
            return
        for frame in chain((first, second), frames):
            for part, rows in frame.groupby(frame[names[0]] // RANGE, sort=False):
                key = (int(part),)
                held = self.waiting.getValue(key) if self.waiting.containsKey(key) else ([],) * len(names)
                self.waiting.updateValue(key, tuple(list(h) + rows[c].tolist() for h, c in zip(held, names)))
        for key in sorted(self.waiting.keys()):
            yield from _sorted_rows([list(c) for c in self.waiting.getValue(tuple(key))])
        self.waiting.clear()

    def keep_alive(self, timers) -> None:
        """Move the key's timer to ``idle_ms`` from now."""
        if self.idle_ms is None:
            return
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        now = timers.getCurrentProcessingTimeInMs() if self.clock == "processing" else timers.getCurrentWatermarkInMs()
        self.handle.registerTimer(now + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.forget()
        return iter(())

    def forget(self) -> None:
        raise NotImplementedError

    def close(self) -> None:
        pass


def _sorted_rows(columns: list[list]) -> Iterator[tuple]:
    for i in sorted(range(len(columns[0])), key=columns[0].__getitem__):
        yield tuple(c[i] for c in columns)


def _run(rows: DataFrame, key: str, processor: _InOrder, out: str) -> DataFrame:
    use_rocks(rows.sparkSession)
    mode = "None" if processor.idle_ms is None else CLOCKS[processor.clock]
    return rows.groupBy(key).transformWithStateInPandas(processor, out, "Append", mode)


class RunHealth:
    """The monitor's state for one run."""

    def __init__(self, patience: int, saved: tuple | None, recent: Sequence[float] = ()):
        self.patience = patience
        if saved is None:
            saved = (0, 0, None, False, None, 0)
        self.n_seen, self.bad, self.last, self.stopped, self.step, self.late = saved
        self.recent = list(recent)

    def saved(self) -> tuple:
        return (self.n_seen, self.bad, self.last, self.stopped, self.step, self.late)

    def observe(self, step: int, loss: float, grad: float | None) -> tuple:
        """``(bad_count, status, avg_loss)`` of the next event."""
        if self.step is not None and step <= self.step:
            self.late += 1
            return None, "late", None
        self.step = step
        if self.stopped:
            return None, "after_stop", None
        self.n_seen += 1
        self.recent = (self.recent + [loss])[-10:]
        sign = self._loss_sign(loss)
        bad_grad = grad is not None and not math.isfinite(grad)
        stop = None
        if sign == "zero":
            stop = "zero"
        elif sign is not None:
            self.bad += 1
            stop = sign if self.bad >= self.patience else None
        if bad_grad:
            self.bad += 1
            if stop is None and self.bad >= self.patience:
                stop = "grad"
        healthy = math.isfinite(loss) and loss != 0
        if healthy and stop is None:
            self.bad, self.last = 0, loss
        count = 0 if healthy else self.bad
        if stop is not None:
            self.stopped = True
            return count, f"stop_{stop}", None
        mean = None
        if healthy and step > 0 and step % 10 == 0:
            mean = sum(self.recent) / len(self.recent)
        high = grad is not None and grad > monitor.GRADIENT_WARNING
        warning = sign or ("grad_nan" if bad_grad else "grad_high" if high else None)
        return count, f"warn_{warning}" if warning else "ok", mean

    def _loss_sign(self, loss: float) -> str | None:
        if not math.isfinite(loss):
            return "nan"
        if loss == 0 and self.n_seen > monitor.HISTORY_BEFORE_ZERO_STOP:
            return "zero"
        if self.last is not None and loss > self.last * monitor.EXPLOSION_FACTOR:
            return "explode"
        return None


class _Health(_InOrder):
    columns = {"step": "bigint", "loss": "double", "grad_norm": "double", "has_grad": "boolean"}

    def __init__(self, patience: int, idle_ms: int | None, clock: str):
        super().__init__(idle_ms, clock)
        self.patience = patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        kinds = "n_seen bigint, bad_count bigint, last_loss double, stopped boolean, last_step bigint, n_late bigint"
        self.run = handle.getValueState("run", kinds)
        self.recent = handle.getListState("recent", "loss double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        saved = self.run.get() if self.run.exists() else None
        recent = [r[0] for r in self.recent.get()] if saved is not None else []
        run = RunHealth(self.patience, saved, recent)

        def seen() -> Iterator[tuple]:
            for step, loss, grad, has in self.by_position(rows):
                row = run.observe(int(step), float(loss), float(grad) if has else None)
                yield (key[0], int(step), *row, row[-1] is None)

        for frame in _in_frames(seen(), ["run_id", "step", "bad_count", "status", "avg_loss", "no_mean"]):
            yield frame.astype({"bad_count": "Int64", "avg_loss": "float64"})
        self.run.update(run.saved())
        if run.recent:
            self.recent.put([(x,) for x in run.recent])
        self.keep_alive(timerValues)

    def forget(self) -> None:
        self.run.clear()
        self.recent.clear()


def health_stream(
    events: DataFrame, patience: int = monitor.PATIENCE, idle_ms: int | None = None, clock: str = "processing"
) -> DataFrame:
    """Health of every run, event by event, with the rolling loss where it is due.

    ``events`` holds ``run_id, step, loss, grad_norm``; on events in order the
    result equals the batch form. Late events have the status ``late``.
    """
    # pandas holds a null number as NaN, so both ways a column of its own tells them apart
    told = events.where(F.col("loss").isNotNull()).select(
        "run_id",
        F.col("step").cast("bigint").alias("step"),
        F.col("loss").cast("double").alias("loss"),
        F.col("grad_norm").cast("double").alias("grad_norm"),
        F.col("grad_norm").isNotNull().alias("has_grad"),
    )
    watched = _run(told, "run_id", _Health(patience, idle_ms, clock), HEALTH_OUT)
    mean = F.when(~F.col("no_mean"), F.coalesce("avg_loss", F.lit(float("nan"))))
    return watched.withColumn("avg_loss", mean).drop("no_mean")


class _Chat(_InOrder):
    columns = {"turn": "bigint", "role": "string", "text": "string"}

    def __init__(self, cap: int, k: int, idle_ms: int | None, clock: str):
        super().__init__(idle_ms, clock)
        self.cap, self.k = cap, k

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.talk = handle.getValueState("talk", "n_exchanges bigint, asked string, last_turn bigint")
        self.memory = handle.getListState("memory", "question string, answer string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, asked, last = self.talk.get() if self.talk.exists() else (0, None, None)
        memory = [tuple(r) for r in self.memory.get()] if n else []

        def finished() -> Iterator[tuple]:
            nonlocal n, asked, last, memory
            for turn, role, text in self.by_position(rows):
                if last is not None and turn <= last:
                    yield (key[0], turn, None, None, None, None, True)
                    continue
                if role == "assistant" and asked is not None:
                    past = [f"{fv.HUMAN} {q}\n{fv.ASSISTANT} {a}" for q, a in memory[-self.k :]]
                    n += 1
                    memory = [*memory, (asked, text)][-self.cap :]
                    context = "\n".join([*past, f"{fv.HUMAN} {asked}\n{fv.ASSISTANT}"])
                    yield (key[0], last, n, len(past), context, f"{len(memory)}/{self.cap}", False)
                asked = text if role == "user" else None
                last = turn

        names = ["conv_id", "turn", "exchange_no", "n_past", "context", "occupancy", "is_late"]
        for frame in _in_frames(finished(), names):
            yield frame.astype({"exchange_no": "Int64", "n_past": "Int64"})
        self.talk.update((n, asked, last))
        if memory:
            self.memory.put(memory)
        self.keep_alive(timerValues)

    def forget(self) -> None:
        self.talk.clear()
        self.memory.clear()


def chat_stream(
    turns: DataFrame,
    cap: int = chat.MEMORY,
    k: int = chat.CONTEXT,
    idle_ms: int | None = None,
    clock: str = "processing",
) -> DataFrame:
    """Per finished exchange: its context and how full the conversation's memory then is.

    ``turns`` holds ``conv_id, turn, role, text``. An assistant turn finishes
    the user turn directly before it. A late turn comes out with ``is_late`` and nothing else.
    """
    told = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    return _run(told, "conv_id", _Chat(cap, k, idle_ms, clock), CONTEXT_OUT)
