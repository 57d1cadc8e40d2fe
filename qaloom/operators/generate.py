"""Question/answer generation with a caller's function, gated and retried once."""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qaloom import fixed_values as fv
from qaloom.functions.checks import Rules, quality_flags
from qaloom.functions.text import build_prompt, clean_technical, is_qa, retry_prompt
from qaloom.operators.curate import accept, fan_out
from qaloom.operators.selection import after, nth_ranked, ranked_keys, up_to
from qaloom.session import materialise

Generator = Callable[[str], str]
ERROR_TEXT = "Error occurred while calling the model: {error}"


def generate(
    df: DataFrame,
    generator: Generator | Callable[[Column], Column],
    prompt: str = "prompt",
    out: str = "response",
    native: bool = False,
) -> DataFrame:
    """Adds ``out`` and ``<out>_error``. Rows with a null prompt are passed through.

    A Python function is called once per row inside Arrow batches; its exception
    becomes the row's response text, which the format check rejects later. With
    ``native`` the generator builds a Column and stays in the JVM.
    """
    error = f"{out}_error"
    if native:
        return df.withColumn(out, generator(F.col(prompt))).withColumn(
            error, F.lit(None).cast("string")
        )

    def call(text: str | None) -> dict[str, str | None]:
        if text is None:
            return {"text": None, "error": None}
        try:
            return {"text": generator(text), "error": None}
        except Exception as e:  # the row records it
            return {"text": ERROR_TEXT.format(error=e), "error": str(e)}

    kind = T.StructType([T.StructField("text", T.StringType()), T.StructField("error", T.StringType())])
    answer = pa.struct([("text", pa.string()), ("error", pa.string())])

    @F.arrow_udf(returnType=kind)
    def ask(prompts: pa.Array) -> pa.Array:
        return pa.array([call(p) for p in prompts.to_pylist()], answer)

    # the prompt alone goes to Python, once per row
    asked = df.withColumn("_answer", ask.asNondeterministic()(F.col(prompt)))
    return asked.select(*df.columns, F.col("_answer.text").alias(out), F.col("_answer.error").alias(error))


def generate_with_retry(
    df: DataFrame,
    generator: Generator | Callable[[Column], Column],
    rules: Rules | None = None,
    prompt: str = "prompt",
    native: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Generate, look at the raw text, ask again where it is flagged, then clean.

    Only well-formed flagged answers are retried; the second answer replaces the
    first even if it is worse. ``partitions`` spreads slow calls over tasks.
    """
    dealt = df if partitions is None else df.repartition(partitions)
    first = generate(dealt, generator, prompt, "first", native)
    if native:
        gated = first.withColumn("flags", quality_flags("first", "gate", rules))
        retried = F.size("flags") > 0
        asked = gated.withColumn("_retry", F.when(retried, retry_prompt(prompt, "flags")))
        return _final(generate(asked, generator, "_retry", "second", native), retried)
    # first answers are written, so that no call is repeated for the sake of the second
    gated = materialise(first).withColumn("flags", quality_flags("first", "gate", rules))
    retried = F.size("flags") > 0
    asked = gated.where(retried).withColumn("_retry", retry_prompt(prompt, "flags"))
    none = F.lit(None).cast("string")
    rest = gated.where(~retried | retried.isNull()).select(
        "*", none.alias("_retry"), none.alias("second"), none.alias("second_error")
    )
    return _final(generate(asked, generator, "_retry", "second").unionByName(rest), retried)


def _final(answered: DataFrame, retried: Column) -> DataFrame:
    return (
        answered.withColumn("retried", retried)
        .withColumn("response", clean_technical(F.when(retried, F.col("second")).otherwise(F.col("first"))))
        .withColumn("error", F.when(retried, F.col("second_error")).otherwise(F.col("first_error")))
        .drop("_retry", "first", "first_error", "second", "second_error")
    )


def candidates_of(
    pages: DataFrame,
    max_examples: int,
    pages_per_run: str | None = None,
    template: str = fv.GENERATION_PROMPT,
) -> DataFrame:
    """Pages times attempts, each with its prompt."""
    return fan_out(pages, max_examples, pages_per_run).withColumn(
        "prompt", build_prompt("text", template)
    )


def generate_until(
    candidates: DataFrame,
    generator: Generator | Callable[[Column], Column],
    max_examples: int,
    order: list[str],
    rules: Rules | None = None,
    native: bool = False,
    partitions: int | None = None,
    factor: float = 1.5,
) -> DataFrame:
    """Accepted samples, without calling the generator far beyond the cap.

    Candidates are taken in generation order, in rounds sized by what is still
    missing, until the cap is met or no candidate is left. The result is the same as
    generating everything and accepting the first ``max_examples``. The candidates'
    keys are sorted once; a round reads the rows between two keys.
    """
    ranked = ranked_keys(candidates.select(*order), order)
    total = ranked.count()
    made = last = None
    missing, taken = max_examples, 0
    while True:
        # the share accepted so far says how many candidates the rest will need
        share = max(max_examples - missing, 1) / taken if taken else 1.0
        taken = min(total, taken + max(1, math.ceil(missing / share * factor)))
        batch = candidates if last is None else candidates.where(after(candidates, order, last))
        if taken < total:
            last = nth_ranked(ranked, taken).key[:-1]
            batch = batch.where(up_to(candidates, order, last))
        answered = generate_with_retry(batch, generator, rules, "prompt", native, partitions)
        # a generator may answer differently when asked again; the format check comes
        # after the write, since a filter before it would evaluate the cleaning twice
        kept = materialise(answered).where(is_qa("response"))
        made = kept if made is None else made.unionByName(kept)
        accepted = accept(made, max_examples, order)
        missing = max_examples - accepted.count()
        if missing <= 0 or taken >= total:
            return accepted
