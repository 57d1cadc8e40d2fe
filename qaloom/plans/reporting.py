"""Queries over reports, rule tables, suites and versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaloom import fixed_values as fv
from qaloom.functions.text import clean_answer, extract_answer
from qaloom.operators import reports, rules
from qaloom.plans import relations as R
from qaloom.plans.registry import query
from qaloom.plans.relations import (
    MIXED_IDS, SQL_CLEANED, SQL_FLAGGED, SQL_MIXED, big, q, sql_any, sql_flags, sql_is_qa,
    sql_round, table,
)


def flagged(spark, sf):
    return reports.sample_flags(R.mixed(spark, sf), "report", R.REPORT)


# --- quality -----------------------------------------------------------------------

_SQL_REPORT = f"""{SQL_FLAGGED},
report AS (
  SELECT kind, count(*) AS total, count(*) FILTER (WHERE ok_format) AS good,
    100.0 * count(*) FILTER (WHERE ok_format) / count(*) AS pct,
    coalesce(avg(answer_len), 0) AS avg_len, {big('sum(len(flags))')} AS n_flags
  FROM flagged GROUP BY ROLLUP (kind))"""
_ROUNDED = f"{sql_round('pct')} AS pct, {sql_round('avg_len')} AS avg_len"


def _rounded(df):
    for c in ("pct", "avg_len", "success_pct"):
        if c in df.columns:
            df = df.withColumn(c, F.round(F.col(c).cast("double"), 4))
    return df


@query(
    "quality_report",
    f"WITH {_SQL_REPORT} SELECT total, good, {_ROUNDED}, n_flags FROM report WHERE kind IS NULL",
)
def _(spark, sf):
    return _rounded(reports.quality_report(flagged(spark, sf)))


@query(
    "verdict",
    f"""WITH {_SQL_REPORT} SELECT kind, total, good, {_ROUNDED}, n_flags,
      CASE WHEN pct >= 95 AND avg_len >= 150 AND n_flags = 0 THEN 'EXCELLENT'
           WHEN pct >= 90 AND avg_len >= 100 AND n_flags <= 5 THEN 'GOOD'
           WHEN pct >= 80 THEN 'MODERATE' ELSE 'POOR' END AS verdict
    FROM report WHERE kind IS NOT NULL""",
)
def _(spark, sf):
    return _rounded(reports.verdict(reports.quality_report(flagged(spark, sf), by=["kind"])))


@query(
    "flag_histogram",
    f"""WITH {SQL_FLAGGED} SELECT flag AS flag_type, count(*) AS n_samples
    FROM (SELECT unnest(flags) AS flag FROM flagged) GROUP BY flag""",
)
def _(spark, sf):
    return reports.flag_histogram(flagged(spark, sf))


@query(
    "first_flags",
    f"""WITH {SQL_FLAGGED}, f AS (
      SELECT kind, id, part, generate_subscripts(flags, 1) - 1 AS flag_pos, unnest(flags) AS flag
      FROM flagged)
    SELECT kind, id, part, CAST(flag_pos AS INT) AS flag_pos, flag,
      greatest((SELECT count(*) FROM f) - 10, 0) AS n_more
    FROM f ORDER BY kind, id, part, flag_pos LIMIT 10""",
)
def _(spark, sf):
    return reports.first_flags(flagged(spark, sf), MIXED_IDS)


@query(
    "first_samples",
    f"""WITH {SQL_MIXED}, top AS (SELECT * FROM mixed ORDER BY id, part, kind LIMIT 3)
    SELECT id, part, kind,
      CASE WHEN {sql_is_qa('text')} THEN left(trim(replace(split_part(text, '{R.A}', 1), '{R.H}', ''), ' ' || chr(10)), 100)
        || '...' END AS question,
      CASE WHEN {sql_is_qa('text')} THEN left({R.sql_strip(f"split_part(text, '{R.A}', 2)")}, 150) || '...' END AS answer,
      CASE WHEN NOT {sql_is_qa('text')} THEN left(text, 200) || '...' END AS raw
    FROM top""",
)
def _(spark, sf):
    return reports.first_samples(R.mixed(spark, sf), ["id", "part", "kind"])


_SQL_EXISTING = sql_flags(
    f"CASE WHEN {sql_any('text', R.EXISTING.experts)} THEN 1 END",
    f"CASE WHEN {sql_any('text', R.EXISTING.parameters)} THEN 1 END",
    f"CASE WHEN {sql_any('text', R.EXISTING.tools)} THEN 1 END",
)


@query(
    "existing_report",
    f"""WITH {SQL_MIXED} SELECT count(*) AS total,
      count(*) FILTER (WHERE {sql_is_qa('text')}) AS good,
      {sql_round(f"100.0 * count(*) FILTER (WHERE {sql_is_qa('text')}) / count(*)")} AS pct,
      {big(f"sum(CASE WHEN {sql_is_qa('text')} THEN len({_SQL_EXISTING}) ELSE 0 END)")} AS n_flags
    FROM mixed""",
)
def _(spark, sf):
    return _rounded(reports.existing_report(R.mixed(spark, sf), R.EXISTING))


# --- evaluation -----------------------------------------------------------------------


@query(
    "evaluation_report",
    f"""WITH {SQL_CLEANED}, r AS (
      SELECT count(*) AS total, count(*) FILTER (WHERE {R.SQL_ANSWER_OK}) AS successes,
        100.0 * count(*) FILTER (WHERE {R.SQL_ANSWER_OK}) / count(*) AS success_pct,
        coalesce(sum(length(clean)) FILTER (WHERE {R.SQL_ANSWER_OK}), 0)
          / greatest(count(*) FILTER (WHERE {R.SQL_ANSWER_OK}), 1) AS avg_len
      FROM cleaned)
    SELECT total, successes, {sql_round('success_pct')} AS success_pct,
      {sql_round('avg_len')} AS avg_len,
      CASE WHEN success_pct >= 80 AND avg_len >= 100 THEN 'EXCELLENT'
           WHEN success_pct >= 80 AND avg_len >= 50 THEN 'GOOD_MORE_DETAIL'
           WHEN success_pct >= 60 THEN 'GOOD_MINOR' WHEN success_pct >= 40 THEN 'FAIR'
           ELSE 'POOR' END AS verdict,
      CASE WHEN avg_len < 50 THEN 'short' WHEN avg_len > 200 THEN 'good' ELSE 'none' END
        AS length_note FROM r""",
)
def _(spark, sf):
    cleaned = R.answers(spark, sf).select(
        clean_answer(extract_answer("raw", "prompt")).alias("clean")
    )
    return _rounded(reports.evaluation_report(cleaned))


@query(
    "check_finite",
    """SELECT label, count(*) AS n_rows, count(*) FILTER (WHERE bad) AS n_bad,
      count(*) FILTER (WHERE bad) = 0 AS is_finite, min(vec_id) FILTER (WHERE bad) AS first_bad,
      CASE WHEN count(*) FILTER (WHERE bad) > 0 THEN 'inf' END AS first_kind
    FROM (SELECT *, list_min(embedding) < -0.35 AS bad FROM embeddings) GROUP BY label""",
)
def _(spark, sf):
    # the vectors are finite; a component below -0.35 stands for an overflow
    overflow = F.transform(
        "embedding", lambda x: F.when(x < -0.35, F.lit(float("-inf"))).otherwise(x)
    )
    vectors = table(spark, sf, "embeddings").withColumn("embedding", overflow)
    return reports.check_finite(vectors, "embedding", "vec_id", by=["label"])


# --- rules ------------------------------------------------------------------------------


def _sources(spark, sf):
    sizes = table(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    # 5 times the documents, so that several size bands occur
    names = F.array(*[F.lit(f"base/Model-{c}") for c in ("small", "medium", "large", "tiny")])
    return sizes.select(
        "source", (F.col("n") * 5).alias("size"), F.explode(names).alias("base_model")
    )


_SQL_SOURCES = """sources AS (
  SELECT source, 5 * count(*) AS size, unnest(['base/Model-small', 'base/Model-medium',
    'base/Model-large', 'base/Model-tiny']) AS base_model
  FROM documents GROUP BY source)"""


def _sql_class(other: str) -> str:
    return f"""CASE WHEN contains(lower(base_model), 'small') THEN 'small'
      WHEN contains(lower(base_model), 'medium') THEN 'medium'
      WHEN contains(lower(base_model), 'large') THEN 'large' ELSE '{other}' END"""


_SQL_EPOCH_RULES = "epoch_rules(class, lo, hi, option, risk, epochs) AS (VALUES " + ", ".join(
    f"('{c}', {lo}, {'NULL' if hi is None else hi}, {o}, {q(r)}, {fv.EPOCH_OPTIONS[o - 1]})"
    for c, lo, hi, o, r in fv.EPOCH_RULES
) + ")"


@query(
    "epoch_rule",
    f"""WITH {_SQL_SOURCES}, {_SQL_EPOCH_RULES}
    SELECT source, base_model, size, r.option, r.epochs, r.risk
    FROM sources s JOIN epoch_rules r
      ON r.class = {_sql_class('large')} AND size >= lo AND (hi IS NULL OR size < hi)""",
)
def _(spark, sf):
    sized = _sources(spark, sf).withColumn("class", rules.model_class("base_model", "large"))
    return rules.rule_join(sized, rules.epoch_rules(spark)).select(
        "source", "base_model", "size", "option", "epochs", "risk"
    )


_SQL_SIZE_RULES = "size_rules(class, option, optimal_lo, optimal_hi, examples) AS (VALUES " + ", ".join(
    f"('{c}', {o}, {lo}, {hi}, {fv.SIZE_OPTIONS[o - 1]})" for c, o, lo, hi in fv.SIZE_RULES
) + ")"


@query(
    "size_rule",
    f"""WITH {_SQL_SOURCES}, {_SQL_SIZE_RULES}
    SELECT source, base_model, r.option, r.examples, size BETWEEN optimal_lo AND optimal_hi AS is_optimal
    FROM sources s JOIN size_rules r ON r.class = {_sql_class('medium')}""",
)
def _(spark, sf):
    sized = _sources(spark, sf).withColumn("class", rules.model_class("base_model", "medium"))
    return sized.join(F.broadcast(rules.size_rules(spark)), "class").select(
        "source",
        "base_model",
        "option",
        "examples",
        F.col("size").between(F.col("optimal_lo"), F.col("optimal_hi")).alias("is_optimal"),
    )


_SQL_PRESETS = "presets(name, base, examples, epochs, method, gb) AS (VALUES " + ", ".join(
    f"('{n}', '{b}', {x}, {e}, '{m}', {'NULL' if g is None else g})" for n, b, x, e, m, g in fv.PRESETS
) + ")"


# which presets ask for at most the examples a source can give
@query(
    "presets_in_reach",
    f"""WITH {_SQL_PRESETS}, s AS (SELECT source, 5 * count(*) AS size FROM documents GROUP BY source)
    SELECT source, name, p.examples, p.epochs, p.method FROM s JOIN presets p
    ON p.examples <= s.size WHERE gb IS NULL OR gb <= 4""",
)
def _(spark, sf):
    sizes = table(spark, sf, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    choices = rules.available_presets(spark, 4.0).select("name", "examples", "epochs", "method")
    listed = choices.agg(F.collect_list(F.struct(*choices.columns))).scalar()
    return (
        sizes.withColumn("p", F.explode(listed))
        .where(F.col("p.examples") <= F.col("n") * 5)
        .select("source", "p.*")
    )


@query(
    "time_estimate",
    f"""WITH s AS (SELECT source, 5 * count(*) AS size FROM documents GROUP BY source),
      o(option, epochs) AS (VALUES {', '.join(f'({i}, {e})' for i, e in enumerate(fv.EPOCH_OPTIONS, 1))}),
      d(device, factor) AS (VALUES ('GPU', 1), ('CPU', 3))
    SELECT source, size, option, epochs, device, (size // 20) * epochs * factor // 60 AS hours,
      (size // 20) * epochs * factor % 60 AS minutes, {big('greatest(4, epochs // 2)')} AS cpu_epochs
    FROM s, o, d""",
)
def _(spark, sf):
    sizes = table(spark, sf, "documents").groupBy("source").agg(
        (F.count(F.lit(1)) * 5).alias("size")
    )
    return rules.time_estimate(sizes).select(
        "source", "size", "option", "epochs", "device", "hours", "minutes", "cpu_epochs"
    )


# --- suites, manifests, versions ---------------------------------------------------------

_SQL_SUITE = ", ".join(f"({i}, {q(x)})" for i, x in enumerate(fv.EXTENDED_QUESTIONS, 1))


@query(
    "cross_suite",
    f"""SELECT item_id, {big('question_no')} AS question_no, question
    FROM benchmark, (VALUES {_SQL_SUITE}) AS s(question_no, question)""",
)
def _(spark, sf):
    return rules.cross_suite(table(spark, sf, "benchmark")).select(
        "item_id", "question_no", "question"
    )


@query("first_questions", "SELECT item_id, text FROM benchmark ORDER BY item_id LIMIT 5")
def _(spark, sf):
    return rules.first_questions(table(spark, sf, "benchmark").select("item_id", "text"), "item_id")


# a web host as a folder: its pages are files named by language, sized by their html
_REQUIRED, _ANY_OF = ("en", "fr"), ("de", "es")


@query(
    "check_manifest",
    f"""WITH files AS (SELECT split_part(url, '/', 3) AS folder, split_part(url, '/', 4) AS name,
        length(html) AS size FROM pages),
      f AS (SELECT folder, count(*) AS n_files, {sql_round('sum(size) / (1024.0 * 1024.0)', 6)} AS total_mb,
        array_to_string([r FOR r IN ['en', 'fr'] IF NOT list_contains(list(name), r)], ',') AS missing,
        CASE WHEN list_contains(list(name), 'de') THEN 'de'
             WHEN list_contains(list(name), 'es') THEN 'es' END AS chosen
      FROM files GROUP BY folder)
    SELECT *, missing = '' AND chosen IS NOT NULL AS is_complete FROM f""",
)
def _(spark, sf):
    files = table(spark, sf, "pages").select(
        F.split_part("url", F.lit("/"), F.lit(3)).alias("folder"),
        F.split_part("url", F.lit("/"), F.lit(4)).alias("name"),
        F.length("html").alias("size"),
    )
    return (
        rules.check_manifest(files, _REQUIRED, _ANY_OF)
        .withColumn("missing", F.array_join("missing", ","))
        .withColumn("total_mb", F.round("total_mb", 6))
    )


@query(
    "latest_version",
    """WITH v AS (SELECT split_part(url, '/', 4) AS lang, name,
        TRY_CAST(split_part(name, '-', 2) AS BIGINT) AS n
      FROM (SELECT url, 'checkpoint-' || list_extract(string_split(url, '/'), -1) AS name FROM pages))
    SELECT lang, arg_max(name, (n, name)) AS latest, max(n) AS version, count(*) AS n_versions
    FROM v WHERE n IS NOT NULL GROUP BY lang""",
)
def _(spark, sf):
    names = table(spark, sf, "pages").select(
        F.split_part("url", F.lit("/"), F.lit(4)).alias("lang"),
        F.concat(F.lit("checkpoint-"), F.substring_index("url", "/", -1)).alias("name"),
    )
    return rules.latest_version(names, by=["lang"])
