"""Queries over metric events and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaloom.functions.text import render_messages
from qaloom.operators import chat, monitor
from qaloom.operators.ordered import number_rows
from qaloom.plans import relations as R
from qaloom.plans.registry import query
from qaloom.plans.relations import A, H, SQL_METRICS, SQL_PAIRS, big, sql_round, table
from qaloom.session import work_path
from qaloom.sources.logs import read_training_log

# --- training health -------------------------------------------------------------------

_BAD = "(isnan(loss) OR isinf(loss))"
_OK = f"(NOT {_BAD} AND loss <> 0)"
SQL_HEALTH = f"""{SQL_METRICS},
seen AS (
  SELECT *, row_number() OVER w AS n_seen,
    last_value(CASE WHEN {_OK} THEN loss END IGNORE NULLS) OVER before AS last_loss,
    count(CASE WHEN {_OK} THEN 1 END) OVER before AS stretch
  FROM metrics WINDOW w AS (PARTITION BY run_id ORDER BY step),
    before AS (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
signed AS (
  SELECT *, coalesce(isnan(grad_norm) OR isinf(grad_norm), false) AS bad_grad,
    loss = 0 AND n_seen > 10 AS collapsed,
    NOT {_BAD} AND NOT (loss = 0 AND n_seen > 10)
      AND coalesce(loss > last_loss * 100, false) AS exploded
  FROM seen),
counted AS (
  SELECT *, sum(CAST({_BAD} OR exploded AS INT) + CAST(bad_grad AS INT))
    OVER (PARTITION BY run_id, stretch ORDER BY step) AS c FROM signed),
stops AS (
  SELECT *, CASE WHEN {_BAD} AND c - CAST(bad_grad AS INT) >= 3 THEN 'stop_nan'
    WHEN collapsed THEN 'stop_zero'
    WHEN exploded AND c - CAST(bad_grad AS INT) >= 3 THEN 'stop_explode'
    WHEN bad_grad AND c >= 3 THEN 'stop_grad' END AS stop
  FROM counted),
health AS (
  SELECT run_id, step, loss, CASE WHEN over THEN NULL WHEN {_OK} THEN 0 ELSE {big('c')} END AS bad_count,
    CASE WHEN over THEN 'after_stop' WHEN stop IS NOT NULL THEN stop WHEN {_BAD} THEN 'warn_nan'
      WHEN exploded THEN 'warn_explode' WHEN bad_grad THEN 'warn_grad_nan'
      WHEN coalesce(grad_norm > 100, false) THEN 'warn_grad_high' ELSE 'ok' END AS status
  FROM (SELECT *, coalesce(max(stop IS NOT NULL) OVER (PARTITION BY run_id ORDER BY step
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS over FROM stops))"""
SQL_VERDICT = f"""WITH {SQL_HEALTH} SELECT run_id,
  count(*) FILTER (WHERE status <> 'after_stop') AS n_seen,
  count(*) FILTER (WHERE starts_with(status, 'warn_')) AS n_warnings,
  max(step) FILTER (WHERE starts_with(status, 'stop_')) AS stop_step,
  coalesce(max(replace(status, 'stop_', '')) FILTER (WHERE starts_with(status, 'stop_')), 'none')
    AS stop
FROM health GROUP BY run_id"""


@query(
    "number_rows",
    """SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS nth
    FROM events""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id")
    return number_rows(events, ["user_id"], "event_id", "nth")


# a mean as text, so that NaN stays NaN: millionths, past the ties of sums of hundredths
SQL_MEAN = "CASE WHEN isnan(avg_loss) THEN 'NaN' ELSE CAST(CAST(round(avg_loss * 1000000) AS BIGINT) AS VARCHAR) END"


def mean_as_text(mean):
    return F.when(F.isnan(mean), "NaN").otherwise(F.round(F.col(mean) * 1000000).cast("bigint").cast("string"))


@query("health", f"WITH {SQL_HEALTH} SELECT run_id, step, bad_count, status FROM health")
def _(spark, sf):
    return monitor.health(R.metrics(spark, sf)).select("run_id", "step", "bad_count", "status")


@query("health_verdict", SQL_VERDICT)
def _(spark, sf):
    return monitor.health_verdict(monitor.health(R.metrics(spark, sf)))


@query(
    "rolling_loss",
    f"""WITH {SQL_HEALTH}, m AS (SELECT *, avg(loss) OVER (PARTITION BY run_id ORDER BY step
        ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS avg_loss FROM metrics)
    SELECT run_id, step, {SQL_MEAN} AS avg_loss
    FROM m JOIN (SELECT run_id, step, status FROM health) USING (run_id, step)
    WHERE {_OK} AND step > 0 AND step % 10 = 0 AND status <> 'after_stop' AND NOT starts_with(status, 'stop_')""",
)
def _(spark, sf):
    rolled = monitor.rolling_loss(R.metrics(spark, sf))
    return rolled.select("run_id", "step", mean_as_text("avg_loss").alias("avg_loss"))


@query(
    "run_summary",
    """SELECT user_id AS run_id, count(*) AS n_logged, max(event_id) AS last_step,
      arg_min(value, event_id) AS first_loss, arg_max(value, event_id) AS last_loss
    FROM events GROUP BY user_id""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select(
        F.col("user_id").alias("run_id"), F.col("event_id").alias("step"), F.col("value").alias("loss")
    )
    return monitor.run_summary(events)


# --- conversations -----------------------------------------------------------------------

SQL_CONTEXT = f"""{SQL_PAIRS},
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS exchange_no FROM pairs),
context AS (
  SELECT conv_id, turn, exchange_no, len(past) AS n_past,
    coalesce(array_to_string(past, chr(10)) || chr(10), '') || '{H} ' || question || chr(10) || '{A}'
      AS context
  FROM (SELECT *, list(text) OVER (PARTITION BY conv_id ORDER BY turn
          ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS past FROM numbered))"""


@query(
    "chat_context",
    f"""WITH {SQL_CONTEXT} SELECT conv_id, turn, exchange_no, coalesce(n_past, 0) AS n_past, context
    FROM context""",
)
def _(spark, sf):
    return chat.chat_context(R.pairs(spark, sf)).withColumn("n_past", F.col("n_past").cast("bigint"))


SQL_MEMORY = f"""{SQL_PAIRS},
newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM pairs)
  WHERE r <= 5),
memory AS (
  SELECT conv_id, count(*) AS n_kept, count(*) || '/5' AS occupancy,
    sum(length(text) + 1) FILTER (WHERE r <= 3)
      + length('{H} [Your next question]') + 1 + length('{A}') AS context_length,
    string_agg(question || '=>' || answer, '|' ORDER BY turn) AS memory
  FROM newest GROUP BY conv_id)"""
SQL_MEMORY_QUERY = f"""WITH {SQL_MEMORY} SELECT conv_id, n_kept, occupancy,
  {big('context_length')} AS context_length, memory FROM memory"""


def memory_as_text(memory):
    shown = F.transform("memory", lambda e: F.concat(e["question"], F.lit("=>"), e["answer"]))
    return memory.select(
        "conv_id",
        F.col("n_kept").cast("bigint").alias("n_kept"),
        "occupancy",
        F.col("context_length").cast("bigint").alias("context_length"),
        F.array_join(shown, "|").alias("memory"),
    )


@query("chat_memory", SQL_MEMORY_QUERY)
def _(spark, sf):
    return memory_as_text(chat.chat_memory(R.pairs(spark, sf)))


@query(
    "render_chat",
    """SELECT conv_id, string_agg(text || '<|endoftext|>', '' ORDER BY turn) AS rendered
    FROM conversations GROUP BY conv_id""",
)
def _(spark, sf):
    return chat.render_chat(table(spark, sf, "conversations"))


# message lists as they come in one row: each exchange is a list of two messages
@query(
    "render_messages",
    f"""WITH {SQL_PAIRS} SELECT conv_id, turn,
      question || '<|endoftext|>' || answer || '<|endoftext|>' AS rendered FROM pairs""",
)
def _(spark, sf):
    messages = F.array(
        F.struct(F.lit("user").alias("role"), F.col("question").alias("content")),
        F.struct(F.lit("assistant").alias("role"), F.col("answer").alias("content")),
    )
    return R.pairs(spark, sf).select("conv_id", "turn", render_messages(messages).alias("rendered"))


#: about so many records make one file of a log
LOG_RECORDS = 10_000


def write_log_forms(metrics, path, records=LOG_RECORDS):
    """Write each ``run`` of ``metrics`` as files below ``path/run=.../part=...``, of about ``records`` records each."""
    record = F.struct("step", "loss", "train_runtime", "train_loss")
    none = F.lit(None).cast("double")
    totals = metrics.groupBy("run").agg(F.count("*").alias("n"), F.max("step").alias("last"))
    part = F.pmod(F.xxhash64("run_id", "step", "loss"), F.ceil(F.col("n") / records)).alias("part")
    sizes = totals.select(F.col("run").alias("of"), "n")
    events = metrics.join(sizes, F.col("run").eqNullSafe(F.col("of"))).select(
        "run", part, "step", "loss", none.alias("train_runtime"), none.alias("train_loss")
    )
    closing = totals.select(
        "run", F.lit(0).alias("part"), F.col("last").alias("step"), none.alias("loss"),
        (F.col("n") * 2.0).alias("train_runtime"), (F.col("last") / 4).alias("train_loss"),
    )
    files = events.unionByName(closing).groupBy("run", "part").agg(F.collect_list(record).alias("log_history"))
    whole = F.when(F.col("run") % 2 == 0, F.to_json("log_history")).otherwise(F.to_json(F.struct("log_history")))
    files.select("run", "part", whole.alias("value")).write.partitionBy("run", "part").text(path)


# ten runs' events, written as files of a bounded number of records: an array of records for even
# runs, an object with a nested history for odd ones, both closed by a record with the run's totals
@query(
    "training_log_forms",
    f"""WITH {SQL_METRICS}, ten AS (SELECT run_id % 10 AS run, step, loss FROM metrics)
    SELECT 'run=' || run AS run_id, count(*) AS n_logged, max(step) AS last_step,
      CAST(arg_min(CASE WHEN isnan(loss) THEN 'NaN' ELSE CAST(CAST(round(loss * 1000) AS BIGINT) AS VARCHAR) END, step) AS VARCHAR) AS first_loss,
      CAST(arg_max(CASE WHEN isnan(loss) THEN 'NaN' ELSE CAST(CAST(round(loss * 1000) AS BIGINT) AS VARCHAR) END, step) AS VARCHAR) AS last_loss,
      CAST(count(*) AS DOUBLE) * 2 AS train_runtime, CAST(max(step) AS DOUBLE) / 4 AS train_loss
    FROM ten GROUP BY run""",
)
def _(spark, sf):
    path = work_path(spark, "logs")
    write_log_forms(R.metrics(spark, sf).withColumn("run", F.col("run_id") % 10), path)
    log = read_training_log(
        spark, f"{path}/run=*/part=*", run=F.regexp_extract("_metadata.file_path", "/(run=[^/]+)/part=", 1)
    )
    summary = monitor.run_summary(log)
    shown = lambda c: F.when(F.isnan(c), "NaN").otherwise(F.round(F.col(c) * 1000).cast("bigint").cast("string")).alias(c)
    return summary.select(
        "run_id", "n_logged", "last_step", shown("first_loss"), shown("last_loss"), "train_runtime", "train_loss"
    )
