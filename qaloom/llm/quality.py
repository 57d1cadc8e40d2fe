"""Quality rules: word and repetition counts, and divergence from language references."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom.llm.shared import bound_batches, map_texts, slices, text_of, whole
from qaloom.session import materialise

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
COMMON_WORDS = 200
MAX_LANGUAGES = 4096
HELD_WORDS = 200_000

CLASSES = ("lower", "upper", "letter", "digit", "space", "stop", "symbol", "other")


def _class_table() -> np.ndarray:
    """The class of every code point up to 0x250; the last entry, a letter, stands for all later ones."""
    table = np.full(0x251, CLASSES.index("letter"), dtype=np.uint8)
    for c in range(0x250):
        ch = chr(c)
        if ch in SYMBOLS:
            name = "symbol"
        elif ch in SPACES:
            name = "space"
        elif ch in ".,;:!?'\"()-":
            name = "stop"
        elif ch.isdigit():
            name = "digit"
        elif ch.islower():
            name = "lower"
        elif ch.isupper():
            name = "upper"
        else:
            name = "letter" if ch.isalpha() else "other"
        table[c] = CLASSES.index(name)
    return table


TABLE = _class_table()


@dataclass(frozen=True)
class Limits:
    """Verdict limits: distances are Jensen-Shannon distances (base 2, 0 to 1)."""

    class_distance: float = 0.28
    word_distance: float = 0.5
    min_chars: int = 500
    min_words: int = 100


def class_counts(text: str) -> np.ndarray:
    """How many characters of each class a text has."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return np.bincount(TABLE[np.minimum(points, len(TABLE) - 1)], minlength=len(CLASSES))


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms of counts; 0 if one of them is empty."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def part(a: np.ndarray) -> float:
        there = a > 0
        return float((a[there] * np.log2(a[there] / m[there])).sum())

    return float(np.sqrt(max(0.0, (part(p) + part(q)) / 2)))


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words that lie in a window of ``size`` words found twice or more in the text, the first included.

    Windows get exact numbers by doubling: a pair of words, then of pairs, then of fours.
    """
    n = len(words)
    if n <= size:
        return 0
    place: defaultdict[bytes, int] = defaultdict()
    place.default_factory = place.__len__
    ids = np.fromiter(map(place.__getitem__, words), dtype=np.int64, count=n)
    if len(place) == n:
        return 0
    hashes = np.zeros(n - size + 1, dtype=np.uint64)
    for k in range(size):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + len(hashes)].astype(np.uint64)
    hashes.sort()
    if not (hashes[1:] == hashes[:-1]).any():
        return 0  # equal windows have equal hashes
    width = 1
    while width < size:
        step = min(width, size - width)
        ids = np.unique(ids[:-step] * (ids.max() + 1) + ids[step:], return_inverse=True)[1]
        width += step
    twice = np.bincount(ids)[ids] > 1
    if not twice.any():
        return 0
    edges = np.zeros(n + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + size, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def duplicate_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in data.split(b"\n") if line.strip(SPACES.encode())]
    return len(lines) - len(set(lines))


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word and class totals by language of a task's rows, given out when many words are held."""
    words: dict[str, Counter] = defaultdict(Counter)
    classes: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(CLASSES), dtype=np.int64))

    def out() -> pa.RecordBatch:
        rows = [(lang, w, n, -1) for lang, found in words.items() for w, n in found.items()]
        rows += [(lang, None, int(n), k) for lang, found in classes.items() for k, n in enumerate(found)]
        words.clear()
        classes.clear()
        columns = list(zip(*rows)) or [[], [], [], []]
        types = [pa.string(), pa.binary(), pa.int64(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], ["lang", "word", "n", "class"]
        )

    for batch in batches:
        for part in slices(batch, "text"):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                words[lang].update(text.lower().encode().split())
                classes[lang] += class_counts(text)
            if sum(map(len, words.values())) > HELD_WORDS:
                yield out()
    yield out()


def language_references(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", common: int = COMMON_WORDS
) -> DataFrame:
    """One row per language: ``lang``, ``classes``, ``words`` with ``counts``, and ``n_words``.

    ``classes`` are character-class counts, ``words`` the ``common`` most frequent
    lower-cased words (ties by the word itself), over all rows and whole texts. Rows
    with a null language have no reference; null texts add nothing. Each task adds up
    its own words before anything is shuffled.
    """
    given = docs.select(F.col(f"`{lang_col}`").alias("lang"), text_of(F.col(f"`{text_col}`")).alias("text"))
    bound_batches(docs.sparkSession)
    parts = given.where("lang is not null").mapInArrow(_totals, "lang string, word binary, n long, class int")
    totals = materialise(parts.groupBy("lang", "word", "class").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = totals.where("word is not null").withColumn("r", rank).where(F.col("r") <= common)
    words = top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("r", "word", "n"))).alias("w"))
    sums = totals.groupBy("lang").agg(
        F.sum(F.when(F.col("word").isNotNull(), F.col("n"))).alias("n_words"),
        F.array_sort(F.collect_list(F.when(F.col("word").isNull(), F.struct("class", "n")))).alias("c"),
    )
    return sums.join(words, "lang").select(
        "lang",
        F.col("c.n").alias("classes"),
        F.col("w.word").alias("words"),
        F.col("w.n").alias("counts"),
        "n_words",
    )


class Reference:
    """A language's histograms, ready to be compared with a document's."""

    def __init__(self, row):
        self.classes = np.array(row["classes"])
        self.place = {bytes(w): i for i, w in enumerate(row["words"])}
        self.words = np.array([*row["counts"], row["n_words"] - sum(row["counts"])])

    def word_distance(self, words: list[bytes]) -> float:
        other = len(self.words) - 1
        places = np.fromiter(map(self.place.get, words, repeat(other)), dtype=np.int64, count=len(words))
        return js_distance(np.bincount(places, minlength=len(self.words)), self.words)


OUT = (
    "row_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "class_distance double, word_distance double, base_failed boolean, kept boolean"
)


def judge(text: str, reference: Reference | None, limits: Limits) -> tuple:
    """All counts, distances and verdicts of one text, in the order of ``OUT`` after the id."""
    data = text.encode()
    words = data.split()
    counts = class_counts(text)
    n_chars = int(counts.sum())
    n_symbols = int(counts[CLASSES.index("symbol")])
    repeats = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PCT * len(words)
    by_class = by_word = 0.0
    if reference is not None:
        if n_chars >= limits.min_chars:
            by_class = js_distance(counts, reference.classes)
        if len(words) >= limits.min_words:
            by_word = reference.word_distance(text.lower().encode().split())
    kept = not failed and by_class <= limits.class_distance and by_word <= limits.word_distance
    spaces = int(counts[CLASSES.index("space")])
    return (
        len(words), n_chars - spaces, n_symbols, duplicate_lines(data), repeats,
        by_class, by_word, failed, kept,
    )


def quality(
    docs: DataFrame,
    references: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    limits: Limits = Limits(),
    keep_row: bool = False,
) -> DataFrame:
    """Counts, distances to the language reference and verdicts for every row of ``docs``.

    A row fails the base rules with under 20 words or over 30 % of its words in
    repeated 8-word windows. Otherwise it is kept if the Jensen-Shannon distances of
    its character classes and of its common words to its language's reference are
    within ``limits``; a text below the minimum lengths, of a null language or of one
    without a reference is judged by the base rules alone. A verdict depends on the text and
    the reference only. ``references`` defaults to those of ``docs`` itself, over all rows. Null text:
    read as empty, fails. Repeated rows and null ids are judged row by row; an empty
    table gives an empty table. With ``keep_row`` the whole row comes along as ``row``.
    References are a few kilobytes a language: those of the ``MAX_LANGUAGES`` languages with
    most words travel with the tasks, those of any others are joined to their rows.
    """
    if references is None:
        references = language_references(docs, lang_col, text_col)
    by_size = references.orderBy(F.desc("n_words"), "lang")
    rows = by_size.limit(MAX_LANGUAGES + 1).collect()
    known = {r["lang"]: Reference(r) for r in rows[:MAX_LANGUAGES]}
    rare = len(rows) > MAX_LANGUAGES

    def own(row: dict | None) -> Reference | None:
        return Reference(row) if row is not None else None

    def job(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        others = map(own, batch.column("reference").to_pylist()) if rare else repeat(None)
        found = list(zip(*(judge(t, known.get(lang) or r, limits) for lang, t, r in zip(langs, texts, others))))
        types = [pa.int64()] * 5 + [pa.float64()] * 2 + [pa.bool_()] * 2
        names = [c.split()[0] for c in OUT.split(", ")]
        arrays = [batch.column("row_id"), *(pa.array(c, t) for c, t in zip(found, types))]
        if keep_row:
            arrays.append(batch.column("row"))
            names.append("row")
        return pa.RecordBatch.from_arrays(arrays, names)

    given = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("row_id"),
        F.col(f"`{lang_col}`").alias("lang"),
        text_of(F.col(f"`{text_col}`")).alias("text"),
        *([whole(docs)] if keep_row else []),
    )
    if rare:
        last = rows[MAX_LANGUAGES - 1]
        beyond = (F.col("n_words") < last["n_words"]) | ((F.col("n_words") == last["n_words"]) & (F.col("lang") > last["lang"]))
        reference = F.struct("classes", "words", "counts", "n_words").alias("reference")
        given = given.join(references.where(beyond).select(F.col("lang").alias("of"), reference), F.col("lang") == F.col("of"), "left").drop("of")
    schema = T.StructType.fromDDL(OUT)
    if keep_row:
        schema.add(given.schema["row"])
    return map_texts(given, "text", schema, job)


def keep_good(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that pass all rules, columns as they were."""
    return quality(docs, limits=limits, keep_row=True).where("kept").select("row.*")
