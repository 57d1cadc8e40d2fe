"""Queries over predicates and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaloom import fixed_values as fv
from qaloom.functions import checks as C
from qaloom.functions import text as X
from qaloom.operators import curate, reports
from qaloom.plans import relations as R
from qaloom.plans.registry import query
from qaloom.plans.relations import (
    A, H, SQL_ANSWERS, SQL_CLEANED, SQL_MIXED, SQL_PAGES, SQL_PAIRS, WS, big, q, sql_any,
    sql_answer, sql_collapse, sql_flags, sql_is_qa, sql_strip, table,
)
from qaloom.sources.pages import page_scan

# --- predicates ------------------------------------------------------------------


@query("is_qa", f"WITH {SQL_MIXED} SELECT kind, id, part, {sql_is_qa('text')} AS ok FROM mixed")
def _(spark, sf):
    return R.mixed(spark, sf).select(*R.MIXED_IDS, X.is_qa("text").alias("ok"))


@query(
    "non_blank",
    f"""WITH {SQL_PAGES} SELECT doc_id, {big('page_no')} AS page_no,
    {sql_strip('text')} <> '' AS ok FROM pages_all""",
)
def _(spark, sf):
    lines = R.documents(spark, sf).select(
        "doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "text")
    )
    return lines.select(
        "doc_id", (F.col("i") + 1).cast("bigint").alias("page_no"), X.non_blank("text").alias("ok")
    )


@query(
    "valid_samples",
    f"""WITH {SQL_MIXED} SELECT kind, id, part FROM mixed
    WHERE {sql_is_qa('text')} AND length({sql_strip('text')}) > 200""",
)
def _(spark, sf):
    return curate.valid_samples(R.mixed(spark, sf), min_len=200).select(*R.MIXED_IDS)


def _flag_query(name, profile, rules, sql_list, gated=True):
    flags = f"CASE WHEN {sql_is_qa('text')} THEN {sql_list} ELSE [] END" if gated else sql_list
    sql = f"""WITH {SQL_MIXED} SELECT kind, id, part, array_to_string({flags}, '|') AS flags
    FROM mixed"""

    @query(name, sql)
    def _(spark, sf):
        return R.mixed(spark, sf).select(
            *R.MIXED_IDS,
            F.array_join(C.quality_flags("text", profile, rules), "|").alias("flags"),
        )


def _case(test: str, flag: str) -> str:
    return f"CASE WHEN {test} THEN {q(flag)} END"


_flag_query(
    "flags_gate", "gate", R.GATE,
    sql_flags(
        _case(f"length({sql_answer('text')}) < 100", fv.GATE_FLAGS[0]),
        _case(sql_any("text", R.GATE.experts), fv.GATE_FLAGS[1]),
        _case(sql_any("text", R.GATE.tools), fv.GATE_FLAGS[2]),
        _case(f"NOT {sql_any('lower(text)', R.GATE.keywords)}", fv.GATE_FLAGS[3]),
    ),
)
_flag_query(
    "flags_existing", "existing", R.EXISTING,
    sql_flags(
        _case(sql_any("text", R.EXISTING.experts), fv.FLAG_EXPERT),
        _case(sql_any("text", R.EXISTING.parameters), fv.FLAG_PARAMETER),
        _case(sql_any("text", R.EXISTING.tools), fv.FLAG_TOOL),
    ),
)
_flag_query("flags_report", "report", R.REPORT, R.SQL_REPORT_FLAGS)
_flag_query(
    "flags_inspect", "inspect", R.INSPECT,
    sql_flags(
        _case(sql_any("text", R.INSPECT.experts), fv.FLAG_EXPERT),
        _case(sql_any("text", R.INSPECT.parameters), fv.FLAG_PARAMETER),
        "CASE WHEN length(text) < 50 THEN 'Too short (' || length(text) || ' chars)' END",
    ),
    gated=False,
)


@query(
    "answer_ok",
    f"WITH {SQL_CLEANED} SELECT conv_id, turn, {R.SQL_ANSWER_OK} AS ok FROM cleaned",
)
def _(spark, sf):
    clean = X.clean_answer(X.extract_answer("raw", "prompt"))
    return R.answers(spark, sf).select("conv_id", "turn", X.answer_ok(clean).alias("ok"))


def _sql_class(profile: str) -> str:
    cases = " ".join(
        f"WHEN {sql_any('lower(message)', phrases)} THEN '{name}'"
        for name, phrases in fv.ERROR_CLASSES[profile]
    )
    return f"CASE {cases} ELSE 'other' END AS {profile}"


# a service's message per event: a status code from `props`, a cause from the event type
_CAUSES = {"error": "Connection lost", "click": "token expired", "view": "Out of Memory"}


@query(
    "classify_error",
    f"""WITH m AS (SELECT event_id, 'HTTP 4' || lpad(regexp_extract(props, '([0-9]+)', 1), 2, '0')
      || ' ' || CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _CAUSES.items())}
      ELSE event_type END AS message FROM events)
    SELECT event_id, {', '.join(_sql_class(p) for p in fv.ERROR_CLASSES)} FROM m""",
)
def _(spark, sf):
    kind = F.col("event_type")
    cause = kind
    for name, text in _CAUSES.items():
        cause = F.when(kind == name, text).otherwise(cause)
    code = F.lpad(F.regexp_extract("props", "([0-9]+)", 1), 2, "0")
    return (
        table(spark, sf, "events")
        .withColumn("message", F.concat(F.lit("HTTP 4"), code, F.lit(" "), cause))
        .select("event_id", *[C.classify_error("message", p).alias(p) for p in fv.ERROR_CLASSES])
    )


# every word of every document that looks like a credential with prefix `th` or `"`
@query(
    "credential_shape",
    """SELECT doc_id, word, count(*) AS n FROM (
      SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents)
    WHERE starts_with(word, 'th') AND length(word) >= 20 GROUP BY doc_id, word""",
)
def _(spark, sf):
    found = (
        R.documents(spark, sf)
        .select("doc_id", F.explode(F.split("text", " ", -1)).alias("word"))
        .where(C.credential_shape("word", "th"))
    )
    return found.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


@query(
    "mask",
    """SELECT doc_id, left(text, 10) || '...' || right(text, 4) AS masked FROM documents""",
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", C.mask("text").alias("masked"))


@query("length_filter", "SELECT doc_id, length(text) AS length FROM documents WHERE length(text) > 100")
def _(spark, sf):
    return curate.text_features(table(spark, sf, "documents")).where("length > 100").select(
        "doc_id", "length"
    )


# --- text functions ---------------------------------------------------------------


@query("compose_qa", f"WITH {SQL_PAIRS} SELECT conv_id, turn, text FROM pairs")
def _(spark, sf):
    return R.pairs(spark, sf).select("conv_id", "turn", "text")


@query(
    "parse_qa",
    f"""WITH {SQL_MIXED} SELECT kind, id, part,
      CASE WHEN {sql_is_qa('text')}
           THEN {sql_strip(f"replace(split_part(text, '{A}', 1), '{H}', '')")} END AS question,
      CASE WHEN {sql_is_qa('text')} THEN {sql_strip(f"split_part(text, '{A}', 2)")} END AS answer,
      CASE WHEN NOT {sql_is_qa('text')} THEN text END AS raw
    FROM mixed""",
)
def _(spark, sf):
    return (
        R.mixed(spark, sf)
        .withColumn("qa", X.parse_qa("text"))
        .select(*R.MIXED_IDS, "qa.question", "qa.answer", "qa.raw")
    )


@query("extract_answer", f"WITH {SQL_ANSWERS} SELECT conv_id, turn, answer FROM extracted")
def _(spark, sf):
    return R.answers(spark, sf).select(
        "conv_id", "turn", X.extract_answer("raw", "prompt").alias("answer")
    )


def sql_technical(e: str) -> str:
    for pattern, new in fv.TECHNICAL_REWRITES:
        p = pattern.replace("{ws}", WS).replace("{name}", f"[^,{WS[1:-1]}]")
        r = new.replace("$", "\\")
        e = f"regexp_replace({e}, {q(p)}, {q(r)}, 'g')"
    return sql_strip(e)


# tool and flag words of the rewrites are put in front, so that they fire on these texts
_TOOLS_IN_TEXT = " -Xmx512m -Xms4k jstack  <pid> jmap  -dump:live,file=a.b "


@query(
    "clean_technical",
    f"""WITH {SQL_MIXED} SELECT kind, id, part,
    {sql_technical(f"({q(_TOOLS_IN_TEXT)} || text)")} AS cleaned FROM mixed""",
)
def _(spark, sf):
    return R.mixed(spark, sf).select(
        *R.MIXED_IDS,
        X.clean_technical(F.concat(F.lit(_TOOLS_IN_TEXT), "text")).alias("cleaned"),
    )


@query("clean_answer", f"WITH {SQL_CLEANED} SELECT conv_id, turn, clean FROM cleaned")
def _(spark, sf):
    return R.answers(spark, sf).select(
        "conv_id", "turn", X.clean_answer(X.extract_answer("raw", "prompt")).alias("clean")
    )


@query(
    "clean_chat",
    f"""WITH {SQL_ANSWERS}, kept AS (
      SELECT conv_id, turn, answer, [p FOR p IN
          [{sql_strip('s')} FOR s IN
           string_split({sql_strip(f"replace(answer, '{H}', '')")}, '.')]
          IF length(p) > 15 AND length(p) < 200 AND NOT starts_with(p, '###')] AS pieces
      FROM extracted)
    SELECT conv_id, turn,
      CASE WHEN answer = '' THEN {q(fv.CHAT_EMPTY)}
           WHEN len(pieces) = 0 THEN {q(fv.CHAT_NOTHING_KEPT)}
           ELSE array_to_string(pieces[1:2], '. ') || '.' END AS clean FROM kept""",
)
def _(spark, sf):
    return R.answers(spark, sf).select(
        "conv_id", "turn", X.clean_chat(X.extract_answer("raw", "prompt")).alias("clean")
    )


@query(
    "previews",
    """SELECT doc_id,
      CASE WHEN length(text) > 400 THEN left(text, 400) || '...' ELSE text END AS whole_or_400,
      left(text, 60) || '...' AS p60, left(text, 100) || '...' AS p100,
      left(text, 150) || '...' AS p150, left(text, 200) || '...' AS p200
    FROM documents""",
)
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        X.preview("text", 400).alias("whole_or_400"),
        *[X.preview("text", n, always=True).alias(f"p{n}") for n in (60, 100, 150, 200)],
    )


_PROMPT_HEAD, _, _PROMPT_TAIL = fv.GENERATION_PROMPT.partition("{text}")


@query(
    "build_prompt",
    f"""WITH {SQL_PAGES} SELECT doc_id, {big('page_ix')} AS page_ix,
      md5({q(_PROMPT_HEAD)} || text || {q(_PROMPT_TAIL)}) AS prompt_md5,
      '{H} ' || text || chr(10) || '{A}' AS evaluation_prompt FROM page""",
)
def _(spark, sf):
    return page_scan(R.documents(spark, sf)).select(
        "doc_id",
        F.col("page_ix").cast("bigint").alias("page_ix"),
        F.md5(X.build_prompt("text")).alias("prompt_md5"),
        X.evaluation_prompt("text").alias("evaluation_prompt"),
    )


SQL_GATE = sql_flags(
    _case(f"length({sql_answer('text')}) < 100", fv.GATE_FLAGS[0]),
    _case(sql_any("text", R.GATE.experts), fv.GATE_FLAGS[1]),
    _case(sql_any("text", R.GATE.tools), fv.GATE_FLAGS[2]),
    _case(f"NOT {sql_any('lower(text)', R.GATE.keywords)}", fv.GATE_FLAGS[3]),
)


@query(
    "retry_prompt",
    f"""WITH {SQL_PAIRS}, f AS (SELECT conv_id, turn, question, {SQL_GATE} AS flags FROM pairs)
    SELECT conv_id, turn, question || {q(fv.RETRY_PREFIX)} || array_to_string(flags, ', ')
      || {q(fv.RETRY_SUFFIX)} AS retry FROM f WHERE len(flags) > 0""",
)
def _(spark, sf):
    return (
        R.pairs(spark, sf)
        .withColumn("flags", C.quality_flags("text", "gate", R.GATE))
        .where(F.size("flags") > 0)
        .select("conv_id", "turn", X.retry_prompt("question", "flags").alias("retry"))
    )


# the documents, and each of them once more without and with a blank text
SQL_TRAINING = f"""given AS (
  SELECT doc_id, 0 AS part, text FROM documents
  UNION ALL SELECT doc_id, 1, NULL FROM documents WHERE n_chars % 50 = 0
  UNION ALL SELECT doc_id, 2, '  ' || chr(10) FROM documents WHERE n_chars % 50 = 1),
trained AS (
  SELECT doc_id * 4 + part AS doc_id, CASE WHEN text IS NULL OR {sql_strip('text')} = '' THEN {q(fv.FALLBACK_SAMPLE + fv.END_TOKEN)}
    WHEN ends_with({sql_strip('text')}, '{fv.END_TOKEN}') THEN {sql_strip('text')}
    ELSE {sql_strip('text')} || '{fv.END_TOKEN}' END AS text
  FROM given)"""


def training_texts(spark, sf):
    """Training texts of all documents; copies of some, with a missing or blank text, ask for the fallback."""
    blank = F.when(F.col("n_chars") % 50 == 1, "  \n")
    again = F.when(F.col("n_chars") % 50 < 2, F.struct((F.col("n_chars") % 50 + 1).alias("part"), blank.alias("text")))
    parts = F.array_compact(F.array(F.struct(F.lit(0).cast("long").alias("part"), "text"), again))
    docs = R.documents(spark, sf, "text", "n_chars").select("doc_id", F.explode(parts).alias("p"))
    return docs.select(
        (F.col("doc_id") * 4 + F.col("p.part")).alias("doc_id"), X.training_text(F.col("p.text")).alias("text")
    )


@query("training_text", f"WITH {SQL_TRAINING} SELECT doc_id, text FROM trained")
def _(spark, sf):
    return training_texts(spark, sf)


CARD = """# {artifact}
- **Base Model**: {base_model}
- **Method**: {training_regime} ({training_description}), {finetune_method}
- **Provider**: {ai_provider}
- **Examples**: {train_size} + {test_size} = {total_size}
- **Epochs**: {num_epochs}, **Accuracy**: {accuracy}
- {left_open} stays
"""


def _cards(spark, sf):
    stats = table(spark, sf, "documents").groupBy("source").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.length("text") < 500).alias("test_size")
    )
    method = F.when(F.col("source").endswith("1"), "LoRA").otherwise("full")
    values = X.card_values(
        {
            "base_model": F.concat(F.lit("base/"), "source"),
            "finetune_method": method,
            "ai_provider": F.when(F.col("source") != "src0", F.col("source")),
            "train_size": F.col("total") - F.col("test_size"),
            "test_size": F.col("test_size"),
            "num_epochs": F.lit(6),
        }
    )
    return stats.select("source", X.render(CARD, values).alias("card"))


_SQL_CARD = q(CARD)
for _name, _value in {
    "base_model": "'base/' || source",
    "finetune_method": "regime",
    "training_regime": "regime",
    "training_description": "description",
    "ai_provider": "CASE WHEN source <> 'src0' THEN upper(source) ELSE 'UNKNOWN' END",
    "train_size": "CAST(total - test_size AS VARCHAR)",
    "test_size": "CAST(test_size AS VARCHAR)",
    "total_size": "CAST(total AS VARCHAR)",
    "num_epochs": "'6'",
    "accuracy": q(fv.NOT_EVALUATED),
}.items():
    _SQL_CARD = f"replace({_SQL_CARD}, '{{{_name}}}', {_value})"
_SQL_CARDS = f"""cards AS (
  SELECT source, {_SQL_CARD} AS card FROM (
    SELECT source, count(*) AS total, count(*) FILTER (WHERE length(text) < 500) AS test_size,
      CASE WHEN ends_with(source, '1') THEN {q(fv.REGIME_LORA)} ELSE {q(fv.REGIME_FULL)} END
        AS regime,
      CASE WHEN ends_with(source, '1') THEN {q(fv.DESCRIPTION_LORA)}
           ELSE {q(fv.DESCRIPTION_FULL)} END AS description
    FROM documents GROUP BY source))"""


@query("render_card", f"WITH {_SQL_CARDS} SELECT source, card FROM cards")
def _(spark, sf):
    return _cards(spark, sf)


@query(
    "unfilled_lines",
    f"""WITH {_SQL_CARDS} SELECT source, array_to_string([x FOR x IN string_split(card, chr(10))
      IF contains(x, '{{') AND contains(x, '}}')], chr(10)) AS lines FROM cards""",
)
def _(spark, sf):
    return _cards(spark, sf).select(
        "source", F.array_join(X.unfilled_lines("card"), "\n").alias("lines")
    )


@query(
    "artifact_name",
    """SELECT page_id, 'model_' || lower(list_extract(string_split(url, '/'), -1)) || '_'
      || CASE WHEN page_id % 2 = 0 THEN 'lora' ELSE 'full' END AS name FROM pages""",
)
def _(spark, sf):
    method = F.when(F.col("page_id") % 2 == 0, "lora").otherwise("other")
    return table(spark, sf, "pages").select("page_id", X.artifact_name("url", method).alias("name"))


# pairs with what the shipped lists look for put in by column code, a different thing per row
def _put_in(text: str, question: str, n: str) -> str:
    return f"""CASE {n} WHEN 1 THEN '{R.H} ' || {question} || chr(10) || '{R.A} ok'
      WHEN 2 THEN {text} || ' {R.H} more' WHEN 3 THEN {text} || {q(' ' + fv.REPORT_EXPERTS[0])}
      WHEN 4 THEN {text} || {q(' ' + fv.REPORT_TOOLS[0])} WHEN 5 THEN {text} || {q(' ' + fv.REPORT_KEYWORDS[0].upper())}
      WHEN 6 THEN {question} WHEN 7 THEN {text} || {q(' ' + fv.GATE_TOOLS[0] + ' ' + fv.GATE_EXPERTS[-1])}
      WHEN 8 THEN {text} || {q(' ' + fv.FAKE_EXPERT[0] + fv.FAKE_PARAMETER[0] + fv.FAKE_TOOL[0])} ELSE {text} END"""


_DEFAULT_FLAGS = {
    "gate": sql_flags(
        _case(f"length({sql_answer('text')}) < 100", fv.GATE_FLAGS[0]),
        _case(sql_any("text", fv.GATE_EXPERTS), fv.GATE_FLAGS[1]),
        _case(sql_any("text", fv.GATE_TOOLS), fv.GATE_FLAGS[2]),
        _case(f"NOT {sql_any('lower(text)', fv.GATE_KEYWORDS)}", fv.GATE_FLAGS[3]),
    ),
    "existing": sql_flags(
        _case(sql_any("text", fv.FAKE_EXPERT), fv.FLAG_EXPERT),
        _case(sql_any("text", fv.FAKE_PARAMETER), fv.FLAG_PARAMETER),
        _case(sql_any("text", fv.FAKE_TOOL), fv.FLAG_TOOL),
    ),
    "report": sql_flags(
        _case(sql_any("text", fv.REPORT_EXPERTS), fv.FLAG_EXPERT),
        _case(sql_any("text", fv.REPORT_TOOLS), fv.FLAG_TOOL_OR_PARAMETER),
        f"CASE WHEN length({sql_answer('text')}) < 100 THEN 'Answer too short (' || length({sql_answer('text')}) || ' chars)' END",
        _case(f"NOT {sql_any('lower(text)', fv.REPORT_KEYWORDS)}", fv.FLAG_NO_KEYWORD),
        _case(f"{R.sql_count('text', R.H)} > 1 OR {R.sql_count('text', R.A)} > 1", fv.FLAG_MULTIPLE),
    ),
}


@query(
    "flags_default",
    f"""WITH {SQL_PAIRS}, put AS (SELECT conv_id, turn, {_put_in('text', 'question', '(conv_id + turn) % 10')} AS text FROM pairs)
    SELECT conv_id, turn, {', '.join(
        f"CASE WHEN {R.sql_is_qa('text')} THEN array_to_string({flags}, '|') ELSE '' END AS {name}"
        for name, flags in _DEFAULT_FLAGS.items()
    )} FROM put""",
)
def _(spark, sf):
    text = F.expr(_put_in("text", "question", "(conv_id + turn) % 10"))
    put = R.pairs(spark, sf).select("conv_id", "turn", text.alias("text"))
    flags = (F.array_join(C.quality_flags("text", name), "|").alias(name) for name in _DEFAULT_FLAGS)
    return put.select("conv_id", "turn", *flags)
