"""Queries over vocabularies and encoded training rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from qaloom import fixed_values as fv
from qaloom.operators import encode as E
from qaloom.plans import jobs
from qaloom.plans.curation import SQL_SPLIT, split_pairs
from qaloom.plans.registry import query
from qaloom.plans.relations import PAIR_IDS, WS, big, q, sql_strip, table
from qaloom.plans.texts import SQL_TRAINING, training_texts

VOCAB, LENGTH = 2000, 512
EOS, EOS_ID = fv.END_TOKEN, fv.END_TOKEN_ID

SQL_TOKENS = f"""{SQL_TRAINING},
split_texts AS (
  SELECT doc_id, [w FOR w IN regexp_split_to_array(replace(text, '{EOS}', ' {EOS} '), '{WS}+')
                  IF w <> ''] AS toks FROM trained),
vocab AS (
  SELECT token, n, row_number() OVER (ORDER BY n DESC, token) AS token_id FROM (
    SELECT token, count(*) AS n FROM (SELECT unnest(toks) AS token FROM split_texts)
    WHERE token <> '{EOS}' GROUP BY token ORDER BY n DESC, token LIMIT {VOCAB})),
places AS (
  SELECT doc_id, generate_subscripts(toks, 1) AS pos, unnest(toks) AS token FROM split_texts),
ids AS (
  SELECT p.doc_id, list(CASE WHEN p.token = '{EOS}' THEN {EOS_ID}
                             ELSE coalesce(v.token_id, {fv.UNKNOWN_ID}) END ORDER BY pos) AS ids,
         list(CASE WHEN v.token IS NULL THEN '<unk>' ELSE p.token END ORDER BY pos)
           FILTER (WHERE p.token <> '{EOS}') AS seen
  FROM (SELECT * FROM places WHERE pos <= {LENGTH}) p LEFT JOIN vocab v ON p.token = v.token
  GROUP BY p.doc_id),
rows AS (
  SELECT doc_id, seen, list_concat(ids, [{EOS_ID} FOR i IN range({LENGTH} - len(ids))]) AS input_ids,
         list_concat([1 FOR i IN ids], [0 FOR i IN range({LENGTH} - len(ids))]) AS mask
  FROM ids)"""


def vocabulary(spark, sf):
    return E.learn_vocab(training_texts(spark, sf), VOCAB)


def training_rows(spark, sf):
    return E.encode(training_texts(spark, sf), vocabulary(spark, sf), LENGTH)


@query("learn_vocab", f"WITH {SQL_TOKENS} SELECT token, n, {big('token_id')} AS token_id FROM vocab")
def _(spark, sf):
    return vocabulary(spark, sf).withColumn("token_id", F.col("token_id").cast("bigint"))


_SQL_ROWS = f"""WITH {SQL_TOKENS} SELECT doc_id, array_to_string(input_ids, ' ') AS input_ids,
  array_to_string(mask, '') AS attention_mask, array_to_string(input_ids, ' ') AS labels FROM rows"""


def _as_text(rows):
    return rows.select(
        "doc_id",
        F.array_join("input_ids", " ").alias("input_ids"),
        F.array_join("attention_mask", "").alias("attention_mask"),
        F.array_join("labels", " ").alias("labels"),
    )


@query("encode", _SQL_ROWS)
def _(spark, sf):
    return _as_text(training_rows(spark, sf))


@query("encode_by_join", _SQL_ROWS)
def _(spark, sf):
    rows = E.encode_by_join(
        training_texts(spark, sf), vocabulary(spark, sf), LENGTH, ids=["doc_id"]
    )
    return _as_text(rows)


@query(
    "decode",
    f"WITH {SQL_TOKENS} SELECT doc_id, coalesce(array_to_string(seen, ' '), '') AS decoded FROM rows",
)
def _(spark, sf):
    vocab = vocabulary(spark, sf)
    return E.decode(E.encode(training_texts(spark, sf), vocab, LENGTH), vocab)


# the vocabulary of all documents meets their own texts and those of the conversations, so both outcomes occur
@query(
    "check_round_trip",
    f"""WITH {SQL_TOKENS}, known AS (SELECT DISTINCT unnest(toks) AS token FROM split_texts),
    asked AS (SELECT row_number() OVER () AS r, toks FROM (
      SELECT toks FROM split_texts UNION ALL
      SELECT [w FOR w IN regexp_split_to_array(replace(coalesce(text, ''), '{EOS}', ' {EOS} '), '{WS}+') IF w <> ''] FROM conversations)),
    missing AS (SELECT DISTINCT r FROM (SELECT r, unnest(toks) AS token FROM asked)
      WHERE token <> '{EOS}' AND token NOT IN (SELECT token FROM known))
    SELECT count(*) AS n_rows, count(*) FILTER (r NOT IN (SELECT r FROM missing)) AS n_exact,
      (SELECT count(*) FROM known WHERE token <> '{EOS}') AS vocab_size FROM asked""",
)
def _(spark, sf):
    texts = training_texts(spark, sf)
    turns = table(spark, sf, "conversations").select(F.coalesce("text", F.lit("")).alias("text"))
    return E.check_round_trip(texts.select("text").unionByName(turns), E.learn_vocab(texts, None))


@query(
    "check_encoded",
    f"""WITH {SQL_TOKENS} SELECT count(*) AS n_rows, min(len(input_ids)) AS min_length,
      max(len(input_ids)) AS max_length, min(len(input_ids)) = max(len(mask)) AS is_uniform,
      true AS labels_match, 'input_ids,attention_mask,labels' AS keys,
      least(count(*), 2) || 'x' || max(len(input_ids)) AS batch_shape FROM rows""",
)
def _(spark, sf):
    return E.check_encoded(training_rows(spark, sf))


# split samples to training rows: the vocabulary comes from the train part alone
_WORDS, _WIDTH = 300, 64


@query(
    "prepare_training",
    f"""WITH {SQL_SPLIT}, closed AS (
      SELECT conv_id, turn, split, CASE WHEN {sql_strip('text')} = '' THEN {q(fv.FALLBACK_SAMPLE + EOS)}
        WHEN ends_with({sql_strip('text')}, '{EOS}') THEN {sql_strip('text')} ELSE {sql_strip('text')} || '{EOS}' END AS text
      FROM split),
    cut AS (SELECT *, [w FOR w IN regexp_split_to_array(replace(text, '{EOS}', ' {EOS} '), '{WS}+') IF w <> ''] AS toks FROM closed),
    known AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS token_id FROM (
      SELECT token, count(*) AS n FROM (SELECT unnest(toks) AS token FROM cut WHERE split = 'train')
      WHERE token <> '{EOS}' GROUP BY token ORDER BY n DESC, token LIMIT {_WORDS})),
    words AS (SELECT conv_id, turn, split, generate_subscripts(toks, 1) AS pos, unnest(toks) AS token FROM cut),
    listed AS (SELECT conv_id, turn, split, list(CASE WHEN w.token = '{EOS}' THEN {EOS_ID}
        ELSE coalesce(token_id, {fv.UNKNOWN_ID}) END ORDER BY pos) AS ids
      FROM (SELECT * FROM words WHERE pos <= {_WIDTH}) w LEFT JOIN known k ON w.token = k.token GROUP BY ALL)
    SELECT conv_id, turn, split, len(ids) AS n_words,
      array_to_string(list_concat(ids, [{EOS_ID} FOR i IN range({_WIDTH} - len(ids))]), ' ') AS input_ids FROM listed""",
)
def _(spark, sf):
    rows = jobs.prepare_training(split_pairs(spark, sf), _WORDS, _WIDTH, PAIR_IDS)
    n = F.size(F.filter("attention_mask", lambda x: x == 1)).cast("bigint")
    return rows.select(*PAIR_IDS, "split", n.alias("n_words"), F.array_join("input_ids", " ").alias("input_ids"))
