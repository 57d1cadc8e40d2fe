"""Mixing by soft membership: domain posteriors and document rates that meet token targets."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.llm.quality import CLASSES, class_counts
from qaloom.llm.shared import map_texts, text_of, whole
from qaloom.session import materialise

BUCKETS = 1 << 16
SHARES = list(range(BUCKETS - 4, BUCKETS))
MIN_ROWS = 5
SAMPLE = 8_000
STEPS = 150
PENALTY = 1e-3
SEED = 7
ITERATIONS = 60
TOLERANCE = 1e-6

#: Share of all tokens that each domain is to have.
TARGETS = {"good": 0.95, "poor": 0.02, "toxic": 0.03}


def domain_of(labels: DataFrame) -> Column:
    """The domain of a labelled row; null where a label is null."""
    return (
        F.when(labels["toxic"] == 1, "toxic")
        .when(labels["quality"] == 0, "poor")
        .when((labels["quality"] == 1) & (labels["toxic"] == 0), "good")
    )


def features(text: str) -> tuple[list[int], list[float], int]:
    """Buckets, their weights, and the number of words of a text.

    A hashed word weighs one however often it occurs; words are runs of anything but
    ASCII space characters, in lower case, without ``.`` and ``,`` at their ends. The
    last buckets hold the shares of upper-case letters, of symbols and of words that
    repeat an earlier one, and a constant.
    """
    words = text.lower().encode().split()
    distinct = {w.rstrip(b".,") for w in words}
    buckets = [crc32(w) % (BUCKETS - len(SHARES)) for w in distinct]
    counts = class_counts(text)
    n_chars, n_words = max(1, int(counts.sum())), len(words)
    shares = [
        4 * counts[CLASSES.index("upper")] / n_chars,
        4 * counts[CLASSES.index("symbol")] / n_chars,
        4 * (1 - len(set(words)) / max(1, n_words)),
        1.0,
    ]
    return buckets + SHARES, [1.0] * len(buckets) + shares, n_words


def _flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    found = [features(t) for t in texts]
    sizes = np.array([len(b) for b, _, _ in found], dtype=np.int64)
    return (
        np.array([b for bs, _, _ in found for b in bs], dtype=np.int64),
        np.array([w for _, ws, _ in found for w in ws], dtype=np.float64),
        np.cumsum(sizes) - sizes,
        np.array([n for _, _, n in found], dtype=np.int64),
    )


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], domains: np.ndarray, n_domains: int) -> np.ndarray:
    """Weights ``(BUCKETS, n_domains)`` of a multinomial logistic regression, fitted by Adam.

    Buckets of fewer than ``MIN_ROWS`` rows keep weight zero.
    """
    bucket, weight, start, _ = _flat(texts)
    row = np.repeat(np.arange(len(texts)), np.diff(np.append(start, len(bucket))))
    used, at, rows = np.unique(bucket, return_inverse=True, return_counts=True)
    weight = weight * (rows >= MIN_ROWS)[at]
    goal = np.eye(n_domains)[domains]
    w = np.zeros((len(used), n_domains))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        wrong = softmax(np.add.reduceat(weight[:, None] * w[at], start, axis=0)) - goal
        push = weight[:, None] * wrong[row]
        grad = np.stack([np.bincount(at, weights=push[:, k], minlength=len(used)) for k in range(n_domains)], axis=1)
        grad = grad / len(texts) + PENALTY * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    out = np.zeros((BUCKETS, n_domains))
    out[used] = w
    return out


def fit_classifier(
    docs: DataFrame, labels: DataFrame, domains: list[str], id_col: str = "doc_id", sample: int = SAMPLE
) -> np.ndarray | None:
    """Classifier weights from at most ``sample`` labelled rows, those whose ids hash lowest.

    The sample is the only part of the data that reaches the driver. Null if no
    labelled row has a document.
    """
    named = labels.select(F.col("doc_id").cast("long").alias("lid"), domain_of(labels).alias("domain"))
    chosen = named.where(F.col("domain").isin(domains)).orderBy(F.xxhash64("lid", F.lit(SEED)), "lid", "domain")
    rows = (
        docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of("text").alias("text"))
        .join(F.broadcast(chosen.limit(sample)), F.col("id") == F.col("lid"))
        .select("id", "text", "domain")
        .orderBy(F.xxhash64("id", F.lit(SEED)), "id", F.xxhash64("text"))
        .limit(sample)
        .toLocalIterator()
    )
    texts, found = [], []
    for r in rows:
        texts.append(r["text"])
        found.append(domains.index(r["domain"]))
    return train(texts, np.array(found), len(domains)) if texts else None


def posteriors(
    docs: DataFrame, weights: np.ndarray | None, n_domains: int, id_col: str = "doc_id", keep_row: bool = False
) -> DataFrame:
    """``id``, ``n_tokens`` (words) and ``p`` (one posterior per domain) for every row.

    A null text is read as empty. Without weights every domain is as likely.
    """

    def job(batch: pa.RecordBatch) -> pa.RecordBatch:
        bucket, weight, start, n = _flat(batch.column("text").to_pylist())
        if weights is None:
            p = np.full((len(n), n_domains), 1 / n_domains)
        else:
            p = softmax(np.add.reduceat(weight[:, None] * weights[bucket], start, axis=0))
        ends = np.arange(0, p.size + 1, n_domains)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(p.ravel()))
        more = [batch.column("row")] if keep_row else []
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(n), lists, *more], ["id", "n_tokens", "p", *(["row"] if keep_row else [])]
        )

    given = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        text_of("text").alias("text"),
        *([whole(docs)] if keep_row else []),
    )
    schema = T.StructType.fromDDL("id long, n_tokens long, p array<double>")
    if keep_row:
        schema.add(given.schema["row"])
    return map_texts(given, "text", schema, job)


def rate_of(p: Column, moves: list[list[float]]) -> Column:
    """A document's rate after the projected steps ``moves``: start at 1, never below 0."""
    if not moves:
        return F.lit(1.0)
    steps = F.array(*(F.array(*(F.lit(float(x)) for x in move)) for move in moves))
    dot = lambda move: F.aggregate(F.zip_with(move, p, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return F.aggregate(steps, F.lit(1.0), lambda r, move: F.greatest(F.lit(0.0), r - dot(move)))


def fit_rates(members: DataFrame, targets: dict[str, float], iterations: int = ITERATIONS) -> list[list[float]]:
    """Steps of projected-gradient least squares for rates of the rows ``(n_tokens, p)``.

    Wanted: rates ``r >= 0`` near 1 with ``sum(n_tokens * p[k] * r)`` equal to the
    target of every domain ``k``. Targets are the given shares of the total at which
    the first domain keeps the tokens it has. The unknowns are scaled by the square root
    of the tokens and the squared error by the inverse Gram matrix of the domains, for
    which the step length 1 is safe; a row's step then depends on its posteriors and
    a vector of one number per domain. So an iteration is one aggregate over a slim
    table, and only those vectors are kept.
    """
    names = list(targets)
    ks = range(len(names))
    p = [F.col("p")[k] for k in ks]
    tokens = F.col("n_tokens").cast("double")
    sums = members.agg(
        *(F.sum(tokens * p[k]).alias(f"s{k}") for k in ks),
        *(F.sum(tokens * p[k] * p[j]).alias(f"g{k}_{j}") for k in ks for j in ks),
    ).first()
    have = np.array([sums[f"s{k}"] or 0.0 for k in ks])
    if not have.sum():
        return []
    shares = np.array([targets[n] for n in names]) / sum(targets.values())
    want = shares * have[0] / shares[0]
    gram = np.array([[sums[f"g{k}_{j}"] for j in ks] for k in ks])
    metric = np.linalg.pinv(gram, rcond=1e-9, hermitian=True)
    moves: list[list[float]] = []
    for _ in range(iterations):
        miss = have - want
        if np.abs(miss).max() <= TOLERANCE * want.sum():
            break
        moves.append((metric @ miss).tolist())
        rate = rate_of(F.col("p"), moves)
        got = members.select(rate.alias("r"), tokens.alias("t"), "p").agg(
            *(F.sum(F.col("r") * F.col("t") * F.col("p")[k]).alias(f"s{k}") for k in ks)
        )
        before, have = have, np.array(list(got.first()))
        if np.abs(have - before).max() <= TOLERANCE * want.sum():
            break  # no rates come closer to the targets
    return moves


def mixing_rates(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, id_col: str = "doc_id"
) -> DataFrame:
    """``id``, ``n_tokens``, ``p`` and ``rate`` for every row of ``docs``.

    Labels are joined by ``doc_id``; labelled rows with a null id or label aren't used.
    Null text: no tokens, a rate by its posteriors. Repeated rows and null ids are
    rated row by row. Without labels all domains are as likely; an empty table gives
    an empty table.
    """
    weights = fit_classifier(docs, labels, list(targets), id_col)
    members = materialise(posteriors(docs, weights, len(targets), id_col))
    moves = fit_rates(members, targets)
    return members.withColumn("rate", rate_of(F.col("p"), moves))


def copies(rate: Column, row_id: Column) -> Column:
    """How often a row of that rate is taken: the whole part, and one more by a hash of the id."""
    part = F.pmod(F.xxhash64(row_id, F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + part).cast("int")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, id_col: str = "doc_id") -> DataFrame:
    """``docs`` mixed to the targets: a row appears as often as its rate says, columns as they were."""
    weights = fit_classifier(docs, labels, list(targets), id_col)
    rows = materialise(posteriors(docs, weights, len(targets), id_col, keep_row=True))
    moves = fit_rates(rows.select("n_tokens", "p"), targets)
    times = copies(rate_of(F.col("p"), moves), F.col("id"))
    return rows.select(F.explode(F.array_repeat(F.lit(1), times)).alias("one"), "row").select("row.*")
