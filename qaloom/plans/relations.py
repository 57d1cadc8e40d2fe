"""Relations the queries share, as DataFrames and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qaloom import fixed_values as fv
from qaloom.functions.checks import PROFILES
from qaloom.functions.text import evaluation_prompt, qa_text
from qaloom.operators.curate import compose_qa


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The documents with their texts, or with the columns asked for."""
    return table(spark, sf_dir, "documents").select("doc_id", *(columns or ("text",)))


# --- SQL helpers ---------------------------------------------------------------

WS = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
H, A = fv.HUMAN, fv.ASSISTANT


def q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def sql_strip(e: str) -> str:
    return f"regexp_replace({e}, '^{WS}+|{WS}+$', '', 'g')"


def sql_collapse(e: str) -> str:
    return f"trim(regexp_replace({e}, '{WS}+', ' ', 'g'))"


def sql_is_qa(e: str) -> str:
    return f"(contains({e}, '{H}') AND contains({e}, '{A}'))"


def sql_count(e: str, needle: str) -> str:
    n = len(needle)
    return f"((length({e}) - length(replace({e}, {q(needle)}, ''))) // {n})"


def sql_any(e: str, needles) -> str:
    return "(" + " OR ".join(f"contains({e}, {q(n)})" for n in needles) + ")"


def sql_answer(e: str) -> str:
    """Text after the last assistant marker."""
    return sql_strip(f"list_extract(string_split({e}, '{A}'), -1)")


def sql_round(e: str, digits: int = 4) -> str:
    return f"round(CAST({e} AS DOUBLE), {digits})"


def big(e: str) -> str:
    return f"CAST({e} AS BIGINT)"


# --- question/answer pairs of the conversations ----------------------------------

SQL_PAIRS = f"""pairs AS (
  SELECT conv_id, turn, text AS question, next_text AS answer,
         '{H} ' || text || chr(10) || '{A} ' || next_text AS text
  FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
        FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant')"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compose_qa(table(spark, sf_dir, "conversations"))


PAIR_IDS = ["conv_id", "turn"]

# pairs and documents as one sample table: rows with and without markers
SQL_MIXED = f"""{SQL_PAIRS},
mixed AS (
  SELECT 'pair' AS kind, conv_id AS id, turn AS part, text FROM pairs
  UNION ALL SELECT 'document', doc_id, 0, text FROM documents)"""
MIXED_IDS = ["kind", "id", "part"]


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    qa = pairs(spark, sf_dir).select(
        F.lit("pair").alias("kind"),
        F.col("conv_id").alias("id"),
        F.col("turn").alias("part"),
        "text",
    )
    docs = documents(spark, sf_dir).select(
        F.lit("document").alias("kind"),
        F.col("doc_id").alias("id"),
        F.lit(0).cast("bigint").alias("part"),
        "text",
    )
    return qa.unionByName(docs)


# --- the driver texts are invented words, so the queries bring their own lists ----

EXPERTS = ("Der ", "Les ", "Los ")
PARAMETERS = ("***", "&&&")
TOOLS = ("%%%", "und ", "que ")
KEYWORDS = ("heap", "the ", " la ", " und ", "ción")
GATE = PROFILES["gate"].with_words(experts=EXPERTS[:2], tools=TOOLS, keywords=KEYWORDS[:4])
EXISTING = PROFILES["existing"].with_words(
    experts=EXPERTS[:1], parameters=PARAMETERS, tools=TOOLS
)
REPORT = PROFILES["report"].with_words(experts=EXPERTS, tools=TOOLS, keywords=KEYWORDS)
INSPECT = PROFILES["inspect"].with_words(experts=EXPERTS[:1], parameters=PARAMETERS)


def sql_flags(*checks: str) -> str:
    """Flags as a list, without the checks that did not fire."""
    return f"[x FOR x IN [{', '.join(checks)}] IF x IS NOT NULL]"


SQL_REPORT_FLAGS = sql_flags(
    f"CASE WHEN {sql_any('text', EXPERTS)} THEN {q(fv.FLAG_EXPERT)} END",
    f"CASE WHEN {sql_any('text', TOOLS)} THEN {q(fv.FLAG_TOOL_OR_PARAMETER)} END",
    f"CASE WHEN length({sql_answer('text')}) < 100 THEN 'Answer too short (' || "
    f"length({sql_answer('text')}) || ' chars)' END",
    f"CASE WHEN NOT {sql_any('lower(text)', KEYWORDS)} THEN {q(fv.FLAG_NO_KEYWORD)} END",
    f"CASE WHEN {sql_count('text', H)} > 1 OR {sql_count('text', A)} > 1 "
    f"THEN {q(fv.FLAG_MULTIPLE)} END",
)
# flags of the mixed samples under the report profile
SQL_FLAGGED = f"""{SQL_MIXED},
flagged AS (
  SELECT kind, id, part, text, {sql_is_qa('text')} AS ok_format,
         CASE WHEN {sql_is_qa('text')} THEN length({sql_answer('text')}) END AS answer_len,
         CASE WHEN {sql_is_qa('text')} THEN {SQL_REPORT_FLAGS} ELSE [] END AS flags
  FROM mixed)"""


# --- model answers: each pair's answer as if a model had returned it -----------------

# odd conversations echo the question behind a bare prompt, so that short answers and
# texts without markers occur
SQL_ANSWERS = f"""{SQL_PAIRS},
answers AS (
  SELECT conv_id, turn, question, prompt, raw FROM (
    SELECT conv_id, turn, question,
           '{H} ' || question || chr(10) || '{A}' AS prompt,
           CASE WHEN conv_id % 2 = 0 THEN text
                ELSE repeat('x', length(question) + length('{H} ' || chr(10) || '{A}'))
                     || ' ' || question END AS raw
    FROM pairs)),
extracted AS (
  SELECT conv_id, turn, question,
         CASE WHEN contains(raw, '{A}') THEN {sql_answer('raw')}
              ELSE {sql_strip("substr(raw, length(prompt) + 1)")} END AS answer
  FROM answers)"""


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = evaluation_prompt("question")
    bare = F.concat(F.repeat(F.lit("x"), F.length(prompt)), F.lit(" "), F.col("question"))
    return pairs(spark, sf_dir).select(
        "conv_id",
        "turn",
        "question",
        prompt.alias("prompt"),
        F.when(F.col("conv_id") % 2 == 0, qa_text("question", "answer")).otherwise(bare).alias("raw"),
    )


def sql_clean_answer(e: str) -> str:
    c = sql_strip(f"replace({sql_strip(e)}, '{H}', '')")
    for junk in fv.ANSWER_DELETIONS:
        c = f"replace({c}, {q(junk)}, '')"
    for junk in fv.ANSWER_ARTIFACTS:
        c = f"replace({c}, {q(junk)}, ' ')"
    return sql_collapse(c)


SQL_CLEANED = f"""{SQL_ANSWERS},
squeezed AS (SELECT conv_id, turn, question, answer, {sql_clean_answer('answer')} AS c FROM extracted),
placed AS (
  SELECT *, CASE WHEN contains(c, '.') THEN length(c) - instr(reverse(c), '.') ELSE -1 END AS dot
  FROM squeezed),
cleaned AS (
  SELECT conv_id, turn, question, answer,
         CASE WHEN c = '' OR right(c, 1) IN ('.', '!', '?') THEN c
              WHEN dot > length(c) * CAST(0.7 AS DOUBLE) THEN left(c, dot + 1)
              ELSE c || '.' END AS clean
  FROM placed)"""
SQL_ANSWER_OK = f"""(length(clean) >= 50 AND {sql_count('clean', ' ')} >= 8
  AND NOT (starts_with(clean, 'Error') OR starts_with(clean, 'Failed')
           OR starts_with(clean, 'Cannot')))"""


# --- pages and generated candidates --------------------------------------------------

SQL_PAGES = f"""pages_all AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS page_no,
         unnest(string_split(text, chr(10))) AS text
  FROM documents),
page AS (
  SELECT doc_id, page_no, row_number() OVER (PARTITION BY doc_id ORDER BY page_no) - 1 AS page_ix,
         count(*) OVER (PARTITION BY doc_id) AS n_pages, text
  FROM pages_all WHERE {sql_strip('text')} <> '')"""


# --- metric events: run = user, step = event id, which grows with time -------------------------------


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as training metrics. Some event types stand for bad signs, so stops occur."""
    kind, value = F.col("event_type"), F.col("value")
    loss = (
        F.when((kind == "error") & (value > 20), F.lit(float("nan")))
        .when((kind == "signup") & (value < 5), F.lit(0.0))
        .when((kind == "purchase") & (value > 40), value * 1000)
        .otherwise(value)
    )
    grad = F.when(kind == "click", F.lit(None).cast("double")).when(
        (kind == "error") | ((kind == "view") & (value < 10)), F.lit(float("inf"))
    ).otherwise(value)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("step"),
        loss.alias("loss"),
        grad.alias("grad_norm"),
    )


SQL_METRICS = """metrics AS (
  SELECT user_id AS run_id, event_id AS step,
         CASE WHEN event_type = 'error' AND value > 20 THEN 'nan'::DOUBLE
              WHEN event_type = 'signup' AND value < 5 THEN 0.0
              WHEN event_type = 'purchase' AND value > 40 THEN value * 1000
              ELSE value END AS loss,
         CASE WHEN event_type = 'click' THEN NULL
              WHEN event_type = 'error' OR (event_type = 'view' AND value < 10) THEN 'inf'::DOUBLE
              ELSE value END AS grad_norm
  FROM events)"""
