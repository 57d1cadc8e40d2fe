"""Watching training metrics: divergence, rolling loss, run summaries.

The monitor is a state machine over a run's events in step order. Its state
between two events is small (an event count, the last good loss, a counter), so
a large run is cut into blocks of events, each block is summarised, and the state at
the start of a block comes from the summaries of the blocks before it. A run
with a third of all events is thus spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaloom.operators.ordered import SPAN, key_of, number_rows, with_blocks, with_neighbours

PATIENCE = 3
HISTORY_BEFORE_ZERO_STOP = 10
EXPLOSION_FACTOR = 100
GRADIENT_WARNING = 100


def not_finite(col: Column) -> Column:
    return F.isnan(col) | (F.abs(col) == float("inf"))


def _ok(loss: Column) -> Column:
    return ~not_finite(loss) & (loss != 0)


def _in_block() -> Window:
    return Window.partitionBy("_key", "_block").orderBy("step")


def _with_history(events: DataFrame) -> DataFrame:
    """Adds the event's number in its run and the last good loss before it."""
    before_row = _in_block().rowsBetween(Window.unboundedPreceding, -1)
    before_block = (
        Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    good_step = F.when(_ok(F.col("loss")), F.col("step"))
    blocks = (
        events.groupBy("_key", "_block")
        .agg(F.count(F.lit(1)).alias("_n"), F.max_by("loss", good_step).alias("_last"))
        .select(
            "_key",
            "_block",
            F.coalesce(F.sum("_n").over(before_block), F.lit(0)).alias("_n_before"),
            F.last("_last", ignorenulls=True).over(before_block).alias("_last_before"),
        )
    )
    good = F.when(_ok(F.col("loss")), F.col("loss"))
    return (
        events.withColumn("_loss_good", good)
        .select(
            "*",
            F.row_number().over(_in_block()).alias("_n_here"),
            F.last("_loss_good", ignorenulls=True).over(before_row).alias("_last_here"),
        )
        .join(blocks, ["_key", "_block"])
        .withColumn("n_seen", F.col("_n_before") + F.col("_n_here"))
        .withColumn("last_loss", F.coalesce("_last_here", "_last_before"))
        .drop("_loss_good", "_n_before", "_n_here", "_last_here", "_last_before")
    )


def health(
    events: DataFrame, patience: int = PATIENCE, run: str = "run_id", span: int = SPAN
) -> DataFrame:
    """Per event: the counter, the warning it raises and the stop it causes.

    Input ``run, step, loss, grad_norm`` with unique (run, step); events without
    a loss are ignored. ``status`` is ``after_stop`` for events the monitor no
    longer sees, else ``stop_nan``, ``stop_zero``, ``stop_explode``,
    ``stop_grad``, a ``warn_...`` or ``ok``.
    """
    loss, grad, step = F.col("loss"), F.col("grad_norm"), F.col("step")
    so_far = _in_block().rowsBetween(Window.unboundedPreceding, 0)
    before_row = _in_block().rowsBetween(Window.unboundedPreceding, -1)
    bad = not_finite(loss)
    collapsed = (loss == 0) & (F.col("n_seen") > HISTORY_BEFORE_ZERO_STOP)
    # a NaN loss compares as larger than any number, so `bad` is tested first
    exploded = ~bad & ~collapsed & F.coalesce(
        loss > F.col("last_loss") * EXPLOSION_FACTOR, F.lit(False)
    )
    bad_grad = F.coalesce(not_finite(grad), F.lit(False))
    loss_sign = F.when(bad, "nan").when(collapsed, "zero").when(exploded, "explode")
    signs = (bad | exploded).cast("bigint") + bad_grad.cast("bigint")

    seen = with_blocks(
        events.select(run, "step", "loss", "grad_norm").where(loss.isNotNull()), [run], "step", span
    )
    # _here counts the bad signs since the last good event of the block; where the
    # block has had none (_open), those carried in from earlier blocks come on top
    marked = (
        _with_history(seen)
        .withColumn("_sign", loss_sign)
        .withColumn("_signs", signs)
        .withColumn("_sum", F.sum("_signs").over(so_far))
        .withColumn(
            "_sum_good", F.last(F.when(_ok(loss), F.col("_sum")), ignorenulls=True).over(before_row)
        )
        .withColumn("_open", F.col("_sum_good").isNull())
        .withColumn("_here", F.col("_sum") - F.coalesce("_sum_good", F.lit(0)))
    )

    def stop_at(count: Column) -> Column:
        at_loss = count - bad_grad.cast("bigint")
        many = F.col("_sign").isin("nan", "explode") & (at_loss >= patience)
        return F.when(many | (F.col("_sign") == "zero"), F.concat(F.lit("stop_"), "_sign")).when(
            bad_grad & (count >= patience), "stop_grad"
        )

    def counted(carry: Column) -> Column:
        return F.col("_here") + F.when(F.col("_open"), carry).otherwise(0)

    # a run that goes on enters a block with fewer than `patience` signs, so the
    # block's first stop is looked up for each of these counts
    by_block = Window.partitionBy("_key").orderBy("_block")
    stop_if = [
        F.min(F.when(stop_at(counted(F.lit(c))).isNotNull(), step)) for c in range(patience)
    ]
    good_step = F.when(_ok(loss), step)
    blocks = (
        marked.groupBy("_key", "_block")
        .agg(
            F.max(_ok(loss).cast("int")).alias("_good"),
            (F.max("_sum") - F.coalesce(F.max_by("_sum", good_step), F.lit(0))).alias("_tail"),
            F.array(*stop_if).alias("_stop_if"),
        )
        .withColumn("_era", F.sum("_good").over(by_block))
        .withColumn("_left", F.sum("_tail").over(Window.partitionBy("_key", "_era").orderBy("_block")))
        .withColumn("_carry", F.lag("_left", 1, 0).over(by_block))
        .withColumn("_stop", F.get("_stop_if", F.least("_carry", F.lit(patience - 1)).cast("int")))
        .select(
            "_key", "_block", "_carry",
            F.min("_stop").over(Window.partitionBy("_key")).alias("_stop_step"),
        )
    )
    count = counted(F.col("_carry"))
    over = F.coalesce(step > F.col("_stop_step"), F.lit(False))
    warning = (
        F.when(F.col("_sign").isNotNull(), F.concat(F.lit("warn_"), "_sign"))
        .when(bad_grad, "warn_grad_nan")
        .when(F.coalesce(grad > GRADIENT_WARNING, F.lit(False)), "warn_grad_high")
    )
    return marked.join(blocks, ["_key", "_block"]).select(
        run,
        "step",
        "loss",
        "grad_norm",
        F.when(~over, F.when(_ok(loss), 0).otherwise(count)).cast("bigint").alias("bad_count"),
        F.when(over, "after_stop")
        .otherwise(F.coalesce(stop_at(count), warning, F.lit("ok")))
        .alias("status"),
    )


def health_verdict(checked: DataFrame, run: str = "run_id") -> DataFrame:
    """Per run: events seen, warnings, where and why it was stopped."""
    status = F.col("status")
    stop = F.max(F.when(status.startswith("stop_"), F.struct("step", "status")))
    return (
        checked.groupBy(run)
        .agg(
            F.count_if(status != "after_stop").alias("n_seen"),
            F.count_if(status.startswith("warn_")).alias("n_warnings"),
            stop.alias("_stop"),
        )
        .select(
            run,
            "n_seen",
            "n_warnings",
            F.col("_stop.step").alias("stop_step"),
            F.coalesce(F.substring_index("_stop.status", "_", -1), F.lit("none")).alias("stop"),
        )
    )


def rolling_loss(
    events: DataFrame,
    n: int = 10,
    every: int = 10,
    run: str = "run_id",
    span: int = SPAN,
    patience: int = PATIENCE,
) -> DataFrame:
    """Mean of the last ``n`` losses, at healthy events whose step is a multiple of ``every``.

    Only events the monitor passes have one: not the one that stops the run, and none
    after it. A NaN in the frame makes the mean NaN.
    """
    losses = events.select(run, "step", "loss").where(F.col("loss").isNotNull())
    numbered = number_rows(losses, [run], "step", "_nth", span)
    frame = Window.partitionBy(run, "_block").orderBy("_nth").rowsBetween(1 - n, 0)
    healthy = _ok(F.col("loss")) & (F.col("step") > 0) & (F.col("step") % every == 0)
    status = F.col("status")
    event = key_of([run, "step"]).alias("_event")
    passed = health(events, patience, run, span).where(
        (status != "after_stop") & ~status.startswith("stop_")
    )
    return (
        with_neighbours(numbered, "_nth", back=n - 1, span=span)
        .withColumn("avg_loss", F.avg("loss").over(frame))
        .where(F.col("_own") & healthy)
        .select(run, "step", "avg_loss", event)
        .join(passed.select(event), "_event", "left_semi")
        .drop("_event")
    )


def run_summary(events: DataFrame, run: str = "run_id") -> DataFrame:
    """First and last loss by step, the last step, and the closing metrics if logged."""
    step = F.when(F.col("loss").isNotNull(), F.col("step"))
    closing = [
        "train_runtime",
        "train_samples_per_second",
        "train_steps_per_second",
        "total_flos",
        "train_loss",
    ]
    return events.groupBy(run).agg(
        F.count("loss").alias("n_logged"),
        F.max("step").alias("last_step"),
        F.min_by("loss", step).alias("first_loss"),
        F.max_by("loss", step).alias("last_loss"),
        *[F.max(c).alias(c) for c in closing if c in events.columns],
    )
