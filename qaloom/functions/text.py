"""Text functions: markers, cleaning, previews, prompts, templates.

Every function maps Columns to a Column built from Spark's own expressions, so
the same code runs on batch tables and on streams, inside generated code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from qaloom import fixed_values as fv


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def whole_division(a: Column, b: Column | int) -> Column:
    """Integer quotient as bigint; exact where a division of doubles is not."""
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)


def strip(col: Column | str) -> Column:
    """Drop Unicode whitespace at both ends; linear in the length of the text."""
    return F.trim(as_column(col), F.lit(fv.SPACE_CHARS))


def collapse_spaces(col: Column | str) -> Column:
    """Words joined by single spaces."""
    return F.trim(F.regexp_replace(as_column(col), fv.SPACE_CLASS + "+", " "))


def non_blank(col: Column | str) -> Column:
    """True when something is left after :func:`strip`; null counts as blank."""
    return F.coalesce(F.length(strip(col)) > 0, F.lit(False))


def words(col: Column | str, first: int | None = None) -> Column:
    """Whitespace-separated words; with ``first`` only that many, and no more are cut off."""
    c = strip(col)
    if first is None:
        cut = F.split(c, fv.SPACE_CLASS + "+")
    else:
        cut = F.slice(F.split(c, fv.SPACE_CLASS + "+", first + 1), 1, first)
    return F.when(c == "", F.array().cast("array<string>")).otherwise(cut)


def count_of(col: Column | str, needle: str) -> Column:
    """How often ``needle`` occurs, without overlaps."""
    c = as_column(col)
    rest = F.length(F.replace(c, F.lit(needle), F.lit("")))
    return ((F.length(c) - rest) / F.lit(len(needle))).cast("int")


def contains_any(col: Column | str, needles: Sequence[str]) -> Column:
    c = as_column(col)
    return reduce(lambda a, b: a | b, (c.contains(n) for n in needles), F.lit(False))


# --- question/answer text ----------------------------------------------------


def is_qa(col: Column | str) -> Column:
    """Holds both markers, in any order."""
    c = as_column(col)
    return F.coalesce(c.contains(fv.HUMAN) & c.contains(fv.ASSISTANT), F.lit(False))


def qa_text(question: Column | str, answer: Column | str) -> Column:
    return F.concat(
        F.lit(fv.HUMAN + " "), as_column(question),
        F.lit("\n" + fv.ASSISTANT + " "), as_column(answer),
    )


def parse_qa(col: Column | str) -> Column:
    """``struct<question, answer, raw>``.

    The answer is the part between the first and the second assistant marker;
    text after a second marker is lost. Rows without both markers keep ``raw``.
    """
    c = as_column(col)
    head = F.split_part(c, F.lit(fv.ASSISTANT), F.lit(1))
    tail = F.split_part(c, F.lit(fv.ASSISTANT), F.lit(2))
    ok = is_qa(c)
    return F.struct(
        F.when(ok, strip(F.replace(head, F.lit(fv.HUMAN), F.lit("")))).alias("question"),
        F.when(ok, strip(tail)).alias("answer"),
        F.when(~ok, c).alias("raw"),
    )


def extract_answer(col: Column | str, prompt: Column | str | None = None) -> Column:
    """Text after the last assistant marker, else what follows the prompt's length."""
    c = as_column(col)
    answer = strip(F.substring_index(c, fv.ASSISTANT, -1))
    if prompt is None:
        return answer
    rest = F.substring(c, F.length(as_column(prompt)) + 1, F.length(c))
    return F.when(c.contains(fv.ASSISTANT), answer).otherwise(strip(rest))


def clean_technical(col: Column | str, fix_sizes: bool = False) -> Column:
    """The ordered rewrites for stored samples.

    The two size rewrites damage some valid sizes (``-Xmx512m`` becomes
    ``-Xmx51gm``); ``fix_sizes=True`` appends a unit only where none stands.
    """
    c = as_column(col)
    *tools, spaces, sentences = fv.TECHNICAL_REWRITES

    def rewrite(text: Column, pattern: str, new: str) -> Column:
        if fix_sizes and pattern.startswith("-Xm"):
            flag, unit = pattern[:4], new[-1]
            pattern, new = rf"{flag}(\p{{Nd}}+)(?![\p{{Nd}}kKmMgGtT])", f"{flag}$1{unit}"
        pattern = pattern.replace("{ws}", fv.SPACE_CLASS).replace("{name}", fv.NO_SPACE_OR_COMMA)
        return F.regexp_replace(text, pattern, new)

    # each tool rewrite needs its own word, and none of them makes another's word
    rewritten = reduce(lambda text, step: rewrite(text, *step), tools, c)
    c = F.when(contains_any(c, fv.TECHNICAL_WORDS), rewritten).otherwise(c)
    return strip(rewrite(rewrite(c, *spaces), *sentences))


def without_markup(col: Column | str) -> Column:
    """First step of :func:`clean_answer`: no markup, single spaces."""
    c = strip(F.replace(strip(col), F.lit(fv.HUMAN), F.lit("")))
    plain = reduce(lambda text, junk: F.replace(text, F.lit(junk), F.lit("")), fv.ANSWER_DELETIONS, c)
    plain = reduce(lambda text, junk: F.replace(text, F.lit(junk), F.lit(" ")), fv.ANSWER_ARTIFACTS, plain)
    # a text without any of them, as most are, is only looked through
    junk = dict.fromkeys((*fv.ANSWER_DELETIONS, *fv.ANSWER_ARTIFACTS))
    return collapse_spaces(F.when(contains_any(c, list(junk)), plain).otherwise(c))


def ended(col: Column | str) -> Column:
    """Second step of :func:`clean_answer`: end on a sentence. It reads its column several times."""
    c = as_column(col)
    last_dot = F.length(c) - F.length(F.substring_index(c, ".", -1)) - 1
    is_ended = reduce(lambda a, b: a | b, (c.endswith(e) for e in fv.SENTENCE_ENDS))
    return (
        F.when((c == "") | is_ended, c)
        .when(last_dot > F.length(c) * F.lit(0.7), F.substring(c, F.lit(1), last_dot + 1))
        .otherwise(F.concat(c, F.lit(".")))
    )


def clean_answer(col: Column | str) -> Column:
    """Answer cleaner for batch evaluation: drop markup, end on a sentence."""
    return ended(without_markup(col))


def chat_sentences(col: Column | str) -> Column:
    """First step of :func:`clean_chat`: the sentences of a sensible length."""
    body = strip(F.replace(strip(col), F.lit(fv.HUMAN), F.lit("")))
    pieces = F.transform(F.split(body, r"\.", -1), strip)
    return F.filter(
        pieces,
        lambda p: (F.length(p) > 15) & (F.length(p) < 200) & ~p.startswith("###"),
    )


def chat_of(col: Column | str, sentences: Column | str) -> Column:
    """Second step of :func:`clean_chat`: two sentences of those found in a text. It reads them several times."""
    kept = as_column(sentences)
    return (
        F.when(F.coalesce(strip(col), F.lit("")) == "", F.lit(fv.CHAT_EMPTY))
        .when(F.size(kept) == 0, F.lit(fv.CHAT_NOTHING_KEPT))
        .otherwise(F.concat(F.array_join(F.slice(kept, 1, 2), ". "), F.lit(".")))
    )


def clean_chat(col: Column | str) -> Column:
    """Answer cleaner for chats: the first two sentences of a sensible length."""
    return chat_of(col, chat_sentences(col))


def answer_ok(col: Column | str) -> Column:
    """Long enough, several words, and not an error message."""
    c = as_column(col)
    starts = reduce(lambda a, b: a | b, (c.startswith(s) for s in fv.ERROR_STARTS))
    return F.coalesce((F.length(c) >= 50) & (count_of(c, " ") >= 8) & ~starts, F.lit(False))


def preview(col: Column | str, n: int, always: bool = False) -> Column:
    """First ``n`` characters and ``...``; a text that fits is kept unless ``always``."""
    c = as_column(col)
    cut = F.concat(F.left(c, F.lit(n)), F.lit("..."))
    return cut if always else F.when(F.length(c) > n, cut).otherwise(c)


# --- prompts, training text, templates ----------------------------------------


def build_prompt(col: Column | str, template: str = fv.GENERATION_PROMPT) -> Column:
    """The template with ``{text}`` replaced by the page text."""
    head, _, tail = template.partition("{text}")
    return F.concat(F.lit(head), as_column(col), F.lit(tail))


def retry_prompt(prompt: Column | str, flags: Column | str) -> Column:
    return F.concat(
        as_column(prompt), F.lit(fv.RETRY_PREFIX),
        F.array_join(as_column(flags), ", "), F.lit(fv.RETRY_SUFFIX),
    )


def generation_messages(prompt: Column | str, system: str = fv.SYSTEM_PROMPT) -> Column:
    """The prompt as a chat model's message list, after the system message."""
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")),
        F.struct(F.lit("user").alias("role"), as_column(prompt).alias("content")),
    )


def evaluation_prompt(question: Column | str) -> Column:
    return F.concat(F.lit(fv.HUMAN + " "), as_column(question), F.lit("\n" + fv.ASSISTANT))


def training_text(col: Column | str, eos: str = fv.END_TOKEN) -> Column:
    """Stripped text closed by the end token; blank or null becomes the fallback sample."""
    c = strip(col)
    closed = F.when(c.endswith(eos), c).otherwise(F.concat(c, F.lit(eos)))
    return F.when(non_blank(col), closed).otherwise(F.lit(fv.FALLBACK_SAMPLE + eos))


def artifact_name(base: Column | str, method: Column | str, prefix: str = "model") -> Column:
    """``prefix_<last path part, lower case>_<lora or full>``."""
    short = F.lower(F.substring_index(as_column(base), "/", -1))
    suffix = F.when(as_column(method) == "lora", "lora").otherwise("full")
    return F.concat_ws("_", F.lit(prefix), short, suffix)


def card_values(values: Mapping[str, Column]) -> dict[str, Column]:
    """All card placeholders from the given ones.

    Derives the training regime and its description from ``finetune_method``,
    the upper-cased provider, and the total from the two split sizes.
    """
    lora = F.lower(values["finetune_method"]) == "lora"
    regime = F.when(lora, fv.REGIME_LORA).otherwise(fv.REGIME_FULL)
    provider = values.get("ai_provider", F.lit(None).cast("string"))
    derived = {
        "finetune_method": regime,
        "training_regime": regime,
        "training_description": F.when(lora, fv.DESCRIPTION_LORA).otherwise(fv.DESCRIPTION_FULL),
        "ai_provider": F.when(F.length(provider) > 0, F.upper(provider)).otherwise("UNKNOWN"),
        "total_size": values["train_size"] + values["test_size"],
        "accuracy": F.lit(fv.NOT_EVALUATED),
        "perplexity": F.lit(fv.NOT_EVALUATED),
    }
    merged = {**values, **derived}
    return {name: merged[name] for name in fv.CARD_PLACEHOLDERS if name in merged}


def render(template: Column | str, values: Mapping[str, Column]) -> Column:
    """Replace each ``{name}`` in turn by its value, in the order given."""
    text = F.lit(template) if isinstance(template, str) else template
    for name, value in values.items():
        text = F.replace(text, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return text


def unfilled_lines(col: Column | str) -> Column:
    """Lines that still hold both braces."""
    lines = F.split(as_column(col), "\n", -1)
    return F.filter(lines, lambda x: x.contains("{") & x.contains("}"))


def render_messages(messages: Column | str, eos: str = fv.END_TOKEN) -> Column:
    """Chat template over ``array<struct<..., content>>``: each content, then the end token."""
    pieces = F.transform(as_column(messages), lambda m: F.concat(m["content"], F.lit(eos)))
    return F.array_join(pieces, "")
