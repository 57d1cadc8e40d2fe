"""Queries over streams whose rows need no state: every predicate and text function as it is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom import fixed_values as fv
from qaloom.functions import checks as C
from qaloom.functions import text as X
from qaloom.plans import relations as R
from qaloom.plans.registry import query
from qaloom.plans.relations import A, H, SQL_MIXED, big, q, sql_any, sql_answer, sql_clean_answer, sql_flags, sql_is_qa, sql_strip, table
from qaloom.plans.texts import _PROMPT_HEAD, _PROMPT_TAIL, SQL_GATE, _case, sql_technical
from qaloom.session import work_path
from qaloom.streaming.known import NewTexts
from qaloom.streaming.tables import run_to_table, stream_table

MIN_SAMPLE = 200


def stateless(rows: DataFrame, ids: Sequence[str], text: str = "text") -> DataFrame:
    """``ids`` and one column per predicate and text function, over a text alone.

    What several columns are made of, or one reads several times, is a column of a step before, so that Spark works it out once.
    """
    answer, gate = X.extract_answer(text).alias("answer"), C.quality_flags(text, "gate", R.GATE).alias("_gate")
    rows = rows.select(*ids, text, answer, gate)
    rows = rows.select("*", X.without_markup("answer").alias("_plain"), X.chat_sentences("answer").alias("_sentences"))
    rows = rows.select("*", X.ended("_plain").alias("clean"))
    return rows.select(*ids, *(c.alias(name) for name, c in _stateless_columns(text).items()))


def _stateless_columns(text: str) -> dict[str, Column]:
    gate = F.col("_gate")
    flags = {name: C.quality_flags(text, name, rules) for name, rules in (("existing", R.EXISTING), ("report", R.REPORT), ("inspect", R.INSPECT))}
    parsed = X.parse_qa(text)
    return {
        "ok_format": X.is_qa(text),
        "has_text": X.non_blank(text),
        "is_valid": C.valid_sample(text, MIN_SAMPLE),
        "gate": F.array_join(gate, "|"),
        **{name: F.array_join(found, "|") for name, found in flags.items()},
        "ok_answer": X.answer_ok("clean"),
        "question": parsed["question"],
        "second_part": parsed["answer"],
        "answer": F.col("answer"),
        "technical": X.clean_technical(text),
        "clean": F.col("clean"),
        "chat": X.chat_of("answer", "_sentences"),
        "p60": X.preview(text, 60, always=True),
        "prompt_md5": F.md5(X.build_prompt(text)),
        "retry": F.when(F.size(gate) > 0, X.retry_prompt(X.preview(text, 60), gate)),
        "training": X.training_text(text),
    }


_SQL_PIECES = f"""[p FOR p IN [{sql_strip('s')} FOR s IN string_split({sql_strip(f"replace(answer, '{H}', '')")}, '.')]
      IF length(p) > 15 AND length(p) < 200 AND NOT starts_with(p, '###')]"""
_SQL_INSPECT = sql_flags(
    _case(sql_any("text", R.INSPECT.experts), fv.FLAG_EXPERT),
    _case(sql_any("text", R.INSPECT.parameters), fv.FLAG_PARAMETER),
    "CASE WHEN length(text) < 50 THEN 'Too short (' || length(text) || ' chars)' END",
)
_SQL_EXISTING = sql_flags(
    _case(sql_any("text", R.EXISTING.experts), fv.FLAG_EXPERT),
    _case(sql_any("text", R.EXISTING.parameters), fv.FLAG_PARAMETER),
    _case(sql_any("text", R.EXISTING.tools), fv.FLAG_TOOL),
)


def _gated(flags: str) -> str:
    return f"array_to_string(CASE WHEN {sql_is_qa('text')} THEN {flags} ELSE [] END, '|')"


SQL_STATELESS = f"""WITH {SQL_MIXED},
answered AS (SELECT *, {sql_answer('text')} AS answer FROM mixed),
squeezed AS (SELECT *, {sql_clean_answer('answer')} AS c, {_SQL_PIECES} AS pieces FROM answered),
placed AS (SELECT *, CASE WHEN contains(c, '.') THEN length(c) - instr(reverse(c), '.') ELSE -1 END AS dot FROM squeezed),
cleaned AS (
  SELECT *, CASE WHEN c = '' OR right(c, 1) IN ('.', '!', '?') THEN c
                 WHEN dot > length(c) * CAST(0.7 AS DOUBLE) THEN left(c, dot + 1)
                 ELSE c || '.' END AS clean,
    CASE WHEN {sql_is_qa('text')} THEN {SQL_GATE} ELSE [] END AS gate_flags
  FROM placed)
SELECT kind, id, part, {sql_is_qa('text')} AS ok_format, {sql_strip('text')} <> '' AS has_text,
  {sql_is_qa('text')} AND length({sql_strip('text')}) > {MIN_SAMPLE} AS is_valid,
  array_to_string(gate_flags, '|') AS gate, {_gated(_SQL_EXISTING)} AS existing, {_gated(R.SQL_REPORT_FLAGS)} AS report,
  array_to_string({_SQL_INSPECT}, '|') AS inspect,
  {R.SQL_ANSWER_OK} AS ok_answer,
  CASE WHEN {sql_is_qa('text')} THEN {sql_strip(f"replace(split_part(text, '{A}', 1), '{H}', '')")} END AS question,
  CASE WHEN {sql_is_qa('text')} THEN {sql_strip(f"split_part(text, '{A}', 2)")} END AS second_part,
  answer, {sql_technical('text')} AS technical, clean,
  CASE WHEN answer = '' THEN {q(fv.CHAT_EMPTY)} WHEN len(pieces) = 0 THEN {q(fv.CHAT_NOTHING_KEPT)}
       ELSE array_to_string(pieces[1:2], '. ') || '.' END AS chat,
  left(text, 60) || '...' AS p60, md5({q(_PROMPT_HEAD)} || text || {q(_PROMPT_TAIL)}) AS prompt_md5,
  CASE WHEN len(gate_flags) > 0 THEN (CASE WHEN length(text) > 60 THEN left(text, 60) || '...' ELSE text END)
    || {q(fv.RETRY_PREFIX)} || array_to_string(gate_flags, ', ') || {q(fv.RETRY_SUFFIX)} END AS retry,
  CASE WHEN {sql_strip('text')} = '' THEN {q(fv.FALLBACK_SAMPLE + fv.END_TOKEN)}
       WHEN ends_with({sql_strip('text')}, '{fv.END_TOKEN}') THEN {sql_strip('text')}
       ELSE {sql_strip('text')} || '{fv.END_TOKEN}' END AS training
FROM cleaned"""


@query("stateless_stream", SQL_STATELESS)
def _(spark, sf):
    path = work_path(spark, "stateless")
    R.mixed(spark, sf).write.parquet(f"{path}/in")
    rows = stream_table(spark, f"{path}/in")
    return run_to_table(stateless(rows, R.MIXED_IDS), path)


BATCHES = 3


# texts of other sources that src0 does not hold, in three micro-batches of the whole table; which copy comes
# first is the stream's affair, so that the row says the text and how many rows stand for it
@query(
    "new_only_stream",
    f"""SELECT md5(text) AS text_md5, length(text) AS n_chars, {big('1')} AS n_rows FROM (
      SELECT DISTINCT text FROM documents WHERE source <> 'src0'
        AND text NOT IN (SELECT text FROM documents WHERE source = 'src0'))""",
)
def _(spark, sf):
    path = work_path(spark, "new")
    docs = table(spark, sf, "documents")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs.where("source <> 'src0'").select("doc_id", "text").repartition(parts, "doc_id").write.parquet(f"{path}/in")
    texts = NewTexts(spark, path, "text", ["doc_id"])
    texts.seed(docs.where("source = 'src0'"))
    new = texts.run(stream_table(spark, f"{path}/in", per_trigger=-(-parts // BATCHES)))
    n_chars = F.first(F.length("text").cast("bigint")).alias("n_chars")
    return new.groupBy(F.md5("text").alias("text_md5")).agg(n_chars, F.count(F.lit(1)).alias("n_rows"))
