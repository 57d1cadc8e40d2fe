"""Queries over generation, the end-to-end jobs and the streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaloom import fixed_values as fv
from qaloom.functions.checks import quality_flags
from qaloom.functions.text import clean_technical
from qaloom.operators import curate, generate
from qaloom.plans import jobs
from qaloom.plans import relations as R
from qaloom.plans.curation import CANDIDATE_ORDER
from qaloom.plans.monitoring import SQL_CONTEXT, SQL_HEALTH, SQL_MEAN, mean_as_text
from qaloom.plans.registry import query
from qaloom.plans.relations import SQL_PAGES, big, q, sql_answer, sql_any, sql_is_qa, sql_round, table
from qaloom.plans.texts import SQL_GATE, sql_technical
from qaloom.session import work_path
from qaloom.sources.pages import page_scan
from qaloom.streaming import stateful
from qaloom.streaming.tables import run_to_table, stream_of, stream_table


def extract(prompt: str) -> str:
    """The extractive generator as a plain function, called per row."""
    head, dot, rest = prompt.partition(".")
    if not dot:
        raise ValueError("no sentence")
    return f"{fv.HUMAN}\n{head.strip(' ')}?\n{fv.ASSISTANT}\n{rest.strip(' ')}"


def sql_extract(e: str) -> str:
    return f"""CASE WHEN contains({e}, '.') THEN
      '### Human:' || chr(10) || trim(split_part({e}, '.', 1)) || '?' || chr(10)
      || '### Assistant:' || chr(10) || trim(substr({e}, instr({e}, '.') + 1))
    ELSE 'Error occurred while calling the model: no sentence' END"""


@query(
    "generate",
    f"""WITH {SQL_PAGES} SELECT doc_id, {big('page_ix')} AS page_ix, {sql_extract('text')} AS response,
      CASE WHEN NOT contains(text, '.') THEN 'no sentence' END AS error FROM page""",
)
def _(spark, sf):
    pages = page_scan(R.documents(spark, sf)).select(
        "doc_id", F.col("page_ix").cast("bigint").alias("page_ix"), F.col("text").alias("prompt")
    )
    return generate.generate(pages, extract).select(
        "doc_id", "page_ix", "response", F.col("response_error").alias("error")
    )


# the page itself is the prompt; the second answer sees the retry text as well
SQL_RETRIED = f"""{SQL_PAGES},
firsts AS (SELECT doc_id, page_ix, n_pages, text AS prompt, {sql_extract('text')} AS text FROM page),
gated AS (
  SELECT *, CASE WHEN {sql_is_qa('text')} THEN {SQL_GATE} ELSE [] END AS flags FROM firsts),
prompts AS (
  SELECT *, prompt || {q(fv.RETRY_PREFIX)} || array_to_string(flags, ', ') || {q(fv.RETRY_SUFFIX)}
    AS retry FROM gated),
answered AS (
  SELECT doc_id, page_ix, n_pages, len(flags) > 0 AS retried,
    {sql_technical(f"CASE WHEN len(flags) > 0 THEN {sql_extract('retry')} ELSE text END")} AS response
  FROM prompts)"""


def _pages_as_prompts(spark, sf):
    return page_scan(R.documents(spark, sf)).select(
        "doc_id", F.col("page_ix").cast("bigint").alias("page_ix"), F.col("text").alias("prompt")
    )


@query(
    "generate_with_retry",
    f"WITH {SQL_RETRIED} SELECT doc_id, {big('page_ix')} AS page_ix, retried, response FROM answered",
)
def _(spark, sf):
    made = generate.generate_with_retry(_pages_as_prompts(spark, sf), extract, R.GATE)
    return made.select("doc_id", "page_ix", "retried", "response")


def extract_column(prompt):
    """The same generator as a Column."""
    return F.when(prompt.contains("."), curate.extractive_pair(prompt)).when(
        prompt.isNotNull(), "Error occurred while calling the model: no sentence"
    )


@query(
    "generate_with_retry_native",
    f"WITH {SQL_RETRIED} SELECT doc_id, {big('page_ix')} AS page_ix, retried, response FROM answered",
)
def _(spark, sf):
    made = generate.generate_with_retry(
        _pages_as_prompts(spark, sf), extract_column, R.GATE, native=True
    )
    return made.select("doc_id", "page_ix", "retried", "response")


# --- end to end --------------------------------------------------------------------------

_N = 1500
SQL_BUILT = f"""{SQL_RETRIED},
attempts AS (
  SELECT doc_id, page_ix, response,
    unnest(range(1, greatest(1, {_N} // (SELECT count(*) FROM page)) + 1)) AS attempt
  FROM answered WHERE {sql_is_qa('response')}),
built AS (
  SELECT doc_id, page_ix, attempt, response AS text FROM (
    SELECT *, row_number() OVER (PARTITION BY response ORDER BY doc_id, page_ix, attempt) AS c
    FROM attempts) WHERE c = 1 ORDER BY doc_id, page_ix, attempt LIMIT {_N}),
samples AS (
  SELECT * EXCLUDE (r, n), CASE WHEN r <= ceil(CAST(0.2 AS DOUBLE) * n) THEN 'test' ELSE 'train' END
    AS split
  FROM (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY
          left(md5('42:' || doc_id || ':' || page_ix || ':' || attempt), 15),
          doc_id, page_ix, attempt) AS r FROM built))"""


def _built(spark, sf):
    return jobs.build_dataset(
        R.documents(spark, sf), extract_column, _N, R.GATE, native=True, template="{text}"
    )


@query(
    "build_dataset",
    f"""WITH {SQL_BUILT} SELECT doc_id, {big('page_ix')} AS page_ix, attempt, text, split FROM samples""",
)
def _(spark, sf):
    return _built(spark, sf).withColumn("page_ix", F.col("page_ix").cast("bigint"))


SQL_BUILT_QUALITY = f"""WITH {SQL_BUILT}, marked AS (
  SELECT length({sql_answer('text')}) AS answer_len, len({R.SQL_REPORT_FLAGS}) AS n FROM samples
  WHERE split = 'train'),
r AS (SELECT count(*) AS total, count(*) AS good, 100.0 AS pct, avg(answer_len) AS avg_len,
        {big('sum(n)')} AS n_flags FROM marked)
SELECT total, good, {sql_round('pct')} AS pct, {sql_round('avg_len')} AS avg_len, n_flags,
  CASE WHEN avg_len >= 150 AND n_flags = 0 THEN 'EXCELLENT'
       WHEN avg_len >= 100 AND n_flags <= 5 THEN 'GOOD' ELSE 'MODERATE' END AS verdict FROM r"""


@query("dataset_quality", SQL_BUILT_QUALITY)
def dataset_quality(spark, sf):
    report = jobs.quality_of(_built(spark, sf), R.REPORT)
    for c in ("pct", "avg_len"):
        report = report.withColumn(c, F.round(F.col(c).cast("double"), 4))
    return report


# every benchmark item answers the core suite with its own text
@query(
    "evaluate_suite",
    f"""WITH squeezed AS (SELECT item_id, {R.sql_clean_answer(R.sql_strip('text'))} AS c FROM benchmark),
    placed AS (SELECT item_id, c, CASE WHEN contains(c, '.') THEN length(c) - instr(reverse(c), '.')
      ELSE -1 END AS dot FROM squeezed),
    cleaned AS (SELECT item_id, CASE WHEN c = '' OR right(c, 1) IN ('.', '!', '?') THEN c
      WHEN dot > length(c) * CAST(0.7 AS DOUBLE) THEN left(c, dot + 1) ELSE c || '.' END AS clean
      FROM placed)
    SELECT item_id, {big('5')} AS total,
      {big(f"CASE WHEN {R.SQL_ANSWER_OK} THEN 5 ELSE 0 END")} AS successes,
      CAST(CASE WHEN {R.SQL_ANSWER_OK} THEN 100 ELSE 0 END AS DOUBLE) AS success_pct,
      CAST(CASE WHEN {R.SQL_ANSWER_OK} THEN length(clean) ELSE 0 END AS DOUBLE) AS avg_len,
      CASE WHEN NOT {R.SQL_ANSWER_OK} THEN 'POOR' WHEN length(clean) >= 100 THEN 'EXCELLENT'
           ELSE 'GOOD_MORE_DETAIL' END AS verdict,
      CASE WHEN NOT {R.SQL_ANSWER_OK} THEN 'short' WHEN length(clean) > 200 THEN 'good' ELSE 'none' END
        AS length_note
    FROM cleaned""",
)
def _(spark, sf):
    subjects = table(spark, sf, "benchmark").select("item_id", "text")
    answer = lambda prompt: F.concat(prompt, F.lit(" "), F.col("text"))
    return jobs.evaluate(subjects, answer, by=["item_id"], native=True)


# --- streams -------------------------------------------------------------------------------


def _fed(df, path):
    """A table as a stream of its files, written once; the operators put rows in order themselves."""
    df.write.parquet(f"{path}/in")
    return stream_table(df.sparkSession, f"{path}/in")


@query(
    "health_stream",
    f"""WITH {SQL_HEALTH}, rolled AS (SELECT run_id, step, avg(loss) OVER (PARTITION BY run_id
        ORDER BY step ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS avg_loss FROM metrics)
    SELECT h.run_id, h.step, bad_count, status,
      CASE WHEN NOT starts_with(status, 'stop_') AND status <> 'after_stop' AND h.step > 0 AND h.step % 10 = 0
            AND NOT isnan(h.loss) AND NOT isinf(h.loss) AND h.loss <> 0
           THEN {SQL_MEAN} END AS avg_loss
    FROM health h JOIN rolled USING (run_id, step)""",
)
def _(spark, sf):
    path = work_path(spark, "health")
    events = _fed(R.metrics(spark, sf), path)
    watched = run_to_table(stateful.health_stream(events), path)
    return watched.withColumn("avg_loss", mean_as_text("avg_loss"))


@query(
    "chat_stream",
    f"""WITH {SQL_CONTEXT} SELECT conv_id, turn, exchange_no, coalesce(n_past, 0) AS n_past, context,
      least(exchange_no, 5) || '/5' AS occupancy, false AS is_late FROM context""",
)
def _(spark, sf):
    path = work_path(spark, "chat")
    turns = _fed(table(spark, sf, "conversations"), path)
    return run_to_table(stateful.chat_stream(turns), path)


# the column functions as they are, on a stream
@query(
    "clean_stream",
    f"""SELECT doc_id, {sql_technical('text')} AS cleaned,
      array_to_string({R.sql_flags(
          f"CASE WHEN {sql_any('text', R.INSPECT.experts)} THEN {q(fv.FLAG_EXPERT)} END",
          f"CASE WHEN {sql_any('text', R.INSPECT.parameters)} THEN {q(fv.FLAG_PARAMETER)} END",
          "CASE WHEN length(text) < 50 THEN 'Too short (' || length(text) || ' chars)' END",
      )}, '|') AS flags FROM documents""",
)
def _(spark, sf):
    docs = stream_of(spark, f"{sf}/documents.parquet").select(
        "doc_id",
        clean_technical("text").alias("cleaned"),
        F.array_join(quality_flags("text", "inspect", R.INSPECT), "|").alias("flags"),
    )
    return run_to_table(docs, work_path(spark, "cleaned"))
