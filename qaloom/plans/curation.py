"""Queries over sources, curation, splits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaloom.functions.checks import valid_sample
from qaloom.functions.text import is_qa
from qaloom.operators import curate, reports, selection
from qaloom.plans import relations as R
from qaloom.plans.registry import query
from qaloom.plans.relations import (
    PAIR_IDS, SQL_MIXED, SQL_PAGES, SQL_PAIRS, WS, big, sql_is_qa, sql_round, sql_strip, table,
)
from qaloom.session import materialise, work_path
from qaloom.sources import dataset
from qaloom.sources.logs import read_training_log
from qaloom.sources.pages import page_scan, page_summary

# --- pages -----------------------------------------------------------------------


@query(
    "page_scan",
    f"""WITH {SQL_PAGES} SELECT doc_id, {big('page_no')} AS page_no, {big('page_ix')} AS page_ix,
    {big('n_pages')} AS n_pages, text FROM page""",
)
def _(spark, sf):
    return page_scan(R.documents(spark, sf)).select(
        "doc_id", *[F.col(c).cast("bigint").alias(c) for c in ("page_no", "page_ix", "n_pages")],
        "text",
    )


@query(
    "page_summary",
    f"""WITH {SQL_PAGES} SELECT doc_id, count(*) AS pages_seen,
      count(*) FILTER (WHERE {sql_strip('text')} <> '') AS pages_kept,
      count(*) FILTER (WHERE {sql_strip('text')} = '') AS pages_blank,
      {big(f"coalesce(sum(CASE WHEN {sql_strip('text')} <> '' THEN length(text) END), 0)")} AS chars
    FROM pages_all GROUP BY doc_id""",
)
def _(spark, sf):
    return page_summary(R.documents(spark, sf))


@query(
    "text_features",
    f"""SELECT doc_id, length(text) AS length,
    len([w FOR w IN regexp_split_to_array(text, '{WS}+') IF w <> '']) AS word_count
    FROM documents""",
)
def _(spark, sf):
    return curate.text_features(R.documents(spark, sf)).select(
        "doc_id", "length", "word_count"
    )


# --- generation attempts ------------------------------------------------------------

MAX_EXAMPLES = 30_000


@query(
    "fan_out",
    f"""WITH {SQL_PAGES} SELECT doc_id, {big('page_ix')} AS page_ix,
      unnest(range(1, greatest(1, {MAX_EXAMPLES} // (SELECT count(*) FROM page)) + 1)) AS attempt
    FROM page""",
)
def _(spark, sf):
    pages = page_scan(R.documents(spark, sf))
    return curate.fan_out(pages, MAX_EXAMPLES).select(
        "doc_id", F.col("page_ix").cast("bigint").alias("page_ix"), "attempt"
    )


@query(
    "fan_out_per_document",
    f"""WITH {SQL_PAGES} SELECT doc_id, {big('page_ix')} AS page_ix,
      unnest(range(1, greatest(1, 50 // n_pages) + 1)) AS attempt FROM page""",
)
def _(spark, sf):
    pages = page_scan(R.documents(spark, sf))
    return curate.fan_out(pages, 50, "n_pages").select(
        "doc_id", F.col("page_ix").cast("bigint").alias("page_ix"), "attempt"
    )


# one candidate per page and attempt, from the extractive generator; pages without a
# second sentence give no answer and are not well formed
SQL_CANDIDATES = f"""{SQL_PAGES},
candidates AS (
  SELECT doc_id, page_ix, attempt,
    CASE WHEN contains(text, '.') THEN
      '### Human:' || chr(10) || trim(split_part(text, '.', 1)) || '?' || chr(10)
      || '### Assistant:' || chr(10) || trim(substr(text, instr(text, '.') + 1))
    ELSE text END AS response
  FROM (SELECT *, unnest(range(1, greatest(1, 50 // n_pages) + 1)) AS attempt FROM page)),
fresh AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY response
                                              ORDER BY doc_id, page_ix, attempt) AS copy_no
                 FROM candidates WHERE {sql_is_qa('response')}) WHERE copy_no = 1)"""
CANDIDATE_ORDER = ["doc_id", "page_ix", "attempt"]


def candidates(spark, sf):
    pages = curate.fan_out(page_scan(R.documents(spark, sf)), 50, "n_pages")
    made = F.when(F.col("text").contains("."), curate.extractive_pair("text")).otherwise(
        F.col("text")
    )
    return pages.select(
        "doc_id", F.col("page_ix").cast("bigint").alias("page_ix"), "attempt", made.alias("response")
    )


@query(
    "accept",
    f"""WITH {SQL_CANDIDATES} SELECT doc_id, page_ix, attempt, response FROM fresh
    ORDER BY doc_id, page_ix, attempt LIMIT 500""",
)
def _(spark, sf):
    return curate.accept(candidates(spark, sf), 500, CANDIDATE_ORDER)


@query(
    "accept_per_document",
    f"""WITH {SQL_CANDIDATES}, own AS (
      SELECT *, row_number() OVER (PARTITION BY doc_id, response ORDER BY page_ix, attempt) AS c
      FROM candidates WHERE {sql_is_qa('response')})
    SELECT doc_id, page_ix, attempt, response FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page_ix, attempt) AS r
      FROM own WHERE c = 1) WHERE r <= 5""",
)
def _(spark, sf):
    return curate.accept(candidates(spark, sf), 5, CANDIDATE_ORDER, by=["doc_id"])


@query(
    "attainment",
    f"""WITH {SQL_CANDIDATES} SELECT count(*) AS n_samples, {big(MAX_EXAMPLES)} AS target,
      CASE WHEN count(*) < {MAX_EXAMPLES} * 0.8 THEN 'below_target'
           WHEN count(*) >= {MAX_EXAMPLES} THEN 'reached' ELSE 'near_target' END AS status
    FROM fresh""",
)
def _(spark, sf):
    accepted = curate.dedup_first(
        candidates(spark, sf).where(is_qa("response")),
        "response",
        CANDIDATE_ORDER,
        keep=CANDIDATE_ORDER,
    )
    return curate.attainment(accepted, MAX_EXAMPLES)


# --- duplicates and set operations ------------------------------------------------------


@query(
    "dedup_first",
    """SELECT doc_id, text FROM (SELECT doc_id, text, row_number() OVER (
      PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return curate.dedup_first(docs, "text", ["doc_id"])


# documents of sources other than src0 that src0 does not hold
@query(
    "new_only",
    """SELECT doc_id, text FROM (SELECT doc_id, text, row_number() OVER (
      PARTITION BY text ORDER BY doc_id) AS r FROM documents WHERE source <> 'src0') WHERE r = 1
      AND text NOT IN (SELECT text FROM documents WHERE source = 'src0')""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents")
    new = docs.where("source <> 'src0'").select("doc_id", "text")
    return curate.new_only(new, docs.where("source = 'src0'"), "text", ["doc_id"])


# --- splits --------------------------------------------------------------------------------

SQL_SPLIT = f"""{SQL_PAIRS},
hashed AS (SELECT *, left(md5('42:' || conv_id || ':' || turn), 15) AS h FROM pairs),
split AS (
  SELECT conv_id, turn, text, CASE WHEN r <= ceil(CAST(0.2 AS DOUBLE) * n)
         THEN 'test' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY h, conv_id, turn) AS r, count(*) OVER () AS n
        FROM hashed))"""


def split_pairs(spark, sf):
    qa = materialise(R.pairs(spark, sf).select(*PAIR_IDS, "text"))
    return selection.split_exact(qa, PAIR_IDS)


@query("split_exact", f"WITH {SQL_SPLIT} SELECT conv_id, turn, split FROM split")
def _(spark, sf):
    return split_pairs(spark, sf).select(*PAIR_IDS, "split")


_BOUND = format(int(0.2 * 2**60), "015x")


@query(
    "split_by_hash",
    f"""SELECT doc_id, CASE WHEN left(md5('42:' || doc_id), 15) < '{_BOUND}' THEN 'test'
      ELSE 'train' END AS split FROM documents""",
)
def _(spark, sf):
    return selection.split_by_hash(table(spark, sf, "documents"), ["doc_id"]).select(
        "doc_id", "split"
    )


@query("split_union", f"WITH {SQL_SPLIT} SELECT conv_id, turn, text, split FROM split")
def _(spark, sf):
    return curate.split_union(split_pairs(spark, sf))


@query("split_sizes", f"WITH {SQL_SPLIT} SELECT split, count(*) AS n_samples FROM split GROUP BY split")
def _(spark, sf):
    return reports.split_sizes(split_pairs(spark, sf))


@query(
    "check_dataset",
    f"""WITH {SQL_SPLIT} SELECT count(*) FILTER (WHERE split = 'train') AS train_size,
      count(*) FILTER (WHERE split = 'test') AS test_size,
      count(DISTINCT split) = 2 AS is_valid FROM split""",
)
def _(spark, sf):
    return reports.check_dataset(split_pairs(spark, sf))


# written, kept on the second write, and read back
@query("write_read_dataset", f"WITH {SQL_SPLIT} SELECT conv_id, turn, text, split FROM split")
def _(spark, sf):
    path = work_path(spark, "dataset")
    samples = split_pairs(spark, sf)
    dataset.write_dataset(samples, path)
    return dataset.write_dataset(samples.limit(0), path)


@query("read_one_split", f"WITH {SQL_SPLIT} SELECT conv_id, turn, text FROM split WHERE split = 'test'")
def _(spark, sf):
    path = work_path(spark, "dataset")
    dataset.write_dataset(split_pairs(spark, sf), path)
    return dataset.read_dataset(spark, path, "test").drop("split")


@query("verify_written", f"WITH {SQL_SPLIT} SELECT count(*) > 0 AS passed FROM split WHERE split = 'train'")
def _(spark, sf):
    path = work_path(spark, "dataset")
    dataset.write_dataset(split_pairs(spark, sf), path)
    return dataset.verify_written(spark, path)


# the report, sizes and target of a dataset, measured by its write alone
@query(
    "written_quality",
    f"""WITH {SQL_SPLIT}, m AS (SELECT split, text, {sql_is_qa('text')} AS ok, {R.SQL_REPORT_FLAGS} AS flags,
        length({R.sql_answer('text')}) AS len FROM split),
      r AS (SELECT count(*) FILTER (WHERE split = 'train') AS total,
        count(*) FILTER (WHERE split = 'train' AND ok) AS good,
        avg(len) FILTER (WHERE split = 'train' AND ok) AS avg_len,
        {R.big("sum(CASE WHEN ok THEN len(flags) ELSE 0 END) FILTER (WHERE split = 'train')")} AS n_flags,
        count(*) FILTER (WHERE split = 'train') AS train_size, count(*) FILTER (WHERE split = 'test') AS test_size,
        CASE WHEN count(*) < 800 THEN 'below_target' WHEN count(*) >= 1000 THEN 'reached' ELSE 'near_target' END AS status
      FROM m)
    SELECT total, good, {sql_round('100.0 * good / total')} AS pct, {sql_round('avg_len')} AS avg_len, n_flags,
      train_size, test_size, status,
      CASE WHEN 100.0 * good / total >= 95 AND avg_len >= 150 AND n_flags = 0 THEN 'EXCELLENT'
           WHEN 100.0 * good / total >= 90 AND avg_len >= 100 AND n_flags <= 5 THEN 'GOOD'
           WHEN 100.0 * good / total >= 80 THEN 'MODERATE' ELSE 'POOR' END AS verdict FROM r""",
)
def _(spark, sf):
    path = work_path(spark, "dataset")
    dataset.write_dataset(split_pairs(spark, sf), path, measures=reports.written_measures(R.REPORT, 1000))
    report = reports.verdict(dataset.read_measures(spark, path)).drop("n_rows")
    for c in ("pct", "avg_len"):
        report = report.withColumn(c, F.round(F.col(c).cast("double"), 4))
    return report


# --- logs and files ---------------------------------------------------------------------------


# metric events written as one JSON record per line, then read as a training log
@query(
    "training_log",
    f"""WITH {R.SQL_METRICS} SELECT CAST(run_id AS VARCHAR) AS run_id, step,
      CASE WHEN isnan(loss) THEN 'NaN' ELSE CAST({sql_round('loss')} * 10000 AS BIGINT)::VARCHAR END AS loss,
      grad_norm IS NULL AS no_grad FROM metrics""",
)
def _(spark, sf):
    path = work_path(spark, "log")
    R.metrics(spark, sf).write.json(path)
    log = read_training_log(spark, path, lines=True)
    scaled = F.round(F.round("loss", 4) * 10000).cast("bigint").cast("string")
    return log.select(
        "run_id",
        "step",
        F.when(F.isnan("loss"), "NaN").otherwise(scaled).alias("loss"),
        F.col("grad_norm").isNull().alias("no_grad"),
    )


# --- statistics ----------------------------------------------------------------------------------


def _labelled(spark, sf):
    features = curate.text_features(R.mixed(spark, sf))
    return selection.split_by_hash(features, ["kind", "id", "part"]).withColumn(
        "is_valid", valid_sample("text")
    )


@query(
    "describe_by_split",
    f"""WITH {SQL_MIXED}, s AS (
      SELECT CASE WHEN left(md5('42:' || kind || ':' || id || ':' || part), 15) < '{_BOUND}'
             THEN 'test' ELSE 'train' END AS split,
             length(text) AS length, {sql_is_qa('text')} AND length({sql_strip('text')}) > 50 AS v
      FROM mixed)
    SELECT split, count(*) AS n_rows, count(*) FILTER (WHERE v) AS n_valid,
      {sql_round('avg(CAST(v AS INT))')} AS valid_mean, {sql_round('avg(length)')} AS length_mean,
      {sql_round('median(length)')} AS length_median,
      {sql_round('stddev_samp(length)')} AS length_std
    FROM s GROUP BY split""",
)
def _(spark, sf):
    stats = curate.describe_by_split(_labelled(spark, sf))
    rounded = ("valid_mean", "length_mean", "length_median", "length_std")
    return stats.select(
        "split", "n_rows", "n_valid", *[F.round(F.col(c).cast("double"), 4).alias(c) for c in rounded]
    )


@query(
    "trim_quantiles",
    """WITH first AS (SELECT doc_id, text FROM (SELECT doc_id, text, row_number() OVER (
        PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1),
      q AS (SELECT quantile_cont(length(text), 0.05) AS lo, quantile_cont(length(text), 0.95) AS hi
            FROM first)
    SELECT doc_id, length(text) AS length FROM first, q WHERE length(text) BETWEEN lo AND hi""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").withColumn("length", F.length("text").cast("bigint"))
    first = curate.dedup_first(docs, "text", ["doc_id"], keep=["doc_id", "length"])
    return curate.trim_quantiles(first).select("doc_id", "length")
