"""The three end-to-end jobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qaloom import fixed_values as fv
from qaloom.functions.checks import Rules
from qaloom.functions.text import (
    answer_ok, clean_answer, evaluation_prompt, extract_answer, training_text,
)
from qaloom.operators import encode, reports, rules, selection
from qaloom.operators.generate import candidates_of, generate, generate_until
from qaloom.session import materialise
from qaloom.sources.pages import page_scan

ORDER = ["doc_id", "page_ix", "attempt"]


def build_dataset(
    documents: DataFrame,
    generator: Callable,
    max_examples: int,
    rules: Rules | None = None,
    native: bool = False,
    partitions: int | None = None,
    template: str = fv.GENERATION_PROMPT,
) -> DataFrame:
    """Documents -> pages -> attempts -> accepted, split samples."""
    attempts = candidates_of(page_scan(documents), max_examples, template=template)
    accepted = generate_until(
        attempts, generator, max_examples, ORDER, rules, native, partitions
    )
    samples = materialise(accepted.select(*ORDER, F.col("response").alias("text")))
    return selection.split_exact(samples, ORDER)


def quality_of(samples: DataFrame, rules: Rules | None = None) -> DataFrame:
    """Report and verdict of the train part."""
    train = samples.where(F.col("split") == "train")
    return reports.verdict(reports.quality_report(reports.sample_flags(train, "report", rules)))


def prepare_training(
    samples: DataFrame, vocab_size: int = 50_000, max_length: int = 768, ids: Sequence[str] = ORDER
) -> DataFrame:
    """Split samples -> fixed-length rows, with a vocabulary from the train part."""
    texts = samples.select(*ids, "split", training_text("text").alias("text"))
    vocab = encode.learn_vocab(texts.where(F.col("split") == "train"), vocab_size)
    return encode.encode(texts, vocab, max_length, [*ids, "split"])


def evaluate(
    subjects: DataFrame,
    generator: Callable,
    by: Sequence[str] = (),
    questions: Sequence[str] = fv.CORE_QUESTIONS,
    native: bool = False,
) -> DataFrame:
    """A suite put to every subject, its answers cleaned, judged and counted."""
    asked = rules.cross_suite(subjects, questions).withColumn(
        "prompt", evaluation_prompt("question")
    )
    answered = generate(asked, generator, "prompt", "raw", native)
    clean = clean_answer(extract_answer("raw", "prompt"))
    return reports.evaluation_report(answered.withColumn("clean", clean), "clean", by)
