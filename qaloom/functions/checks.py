"""Row predicates and classifiers."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from qaloom import fixed_values as fv
from qaloom.functions.text import as_column, contains_any, count_of, extract_answer, is_qa, strip


def classify_error(col: Column | str, profile: str) -> Column:
    """Class of an error message; the first class with a matching phrase wins."""
    lowered = F.lower(as_column(col))
    chain = None
    for name, phrases in fv.ERROR_CLASSES[profile]:
        hit = contains_any(lowered, phrases)
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain.otherwise("other")


def credential_shape(col: Column | str, prefix: str, min_len: int = 20) -> Column:
    c = as_column(col)
    return F.coalesce(c.startswith(prefix) & (F.length(c) >= min_len), F.lit(False))


def mask(col: Column | str, head: int = 10, tail: int = 4) -> Column:
    c = as_column(col)
    return F.concat(F.left(c, F.lit(head)), F.lit("..."), F.right(c, F.lit(tail)))


def valid_sample(col: Column | str, min_len: int = 50) -> Column:
    """Both markers and more than ``min_len`` characters after stripping."""
    return is_qa(col) & (F.length(strip(col)) > min_len)


@dataclass(frozen=True)
class Rules:
    """What a quality profile looks for."""

    experts: tuple[str, ...] = ()
    parameters: tuple[str, ...] = ()
    tools: tuple[str, ...] = ()
    keywords: tuple[str, ...] = ()
    min_len: int = 100

    def with_words(self, **words) -> "Rules":
        return replace(self, **words)


PROFILES = {
    "gate": Rules(experts=fv.GATE_EXPERTS, tools=fv.GATE_TOOLS, keywords=fv.GATE_KEYWORDS),
    "existing": Rules(
        experts=fv.FAKE_EXPERT, parameters=fv.FAKE_PARAMETER, tools=fv.FAKE_TOOL
    ),
    "report": Rules(
        experts=fv.REPORT_EXPERTS, tools=fv.REPORT_TOOLS, keywords=fv.REPORT_KEYWORDS
    ),
    "inspect": Rules(experts=fv.FAKE_EXPERT, parameters=fv.FAKE_PARAMETER, min_len=50),
}


def quality_flags(col: Column | str, profile: str, rules: Rules | None = None) -> Column:
    """``array<string>`` of the flags a text raises under a profile.

    All profiles but ``inspect`` look only at texts with both markers; a badly
    formatted text raises nothing there.
    """
    c = as_column(col)
    r = rules or PROFILES[profile]
    answer = extract_answer(c)
    no_keyword = ~contains_any(F.lower(c), r.keywords)
    if profile == "gate":
        short, expert, tool, off_topic = fv.GATE_FLAGS
        checks = [
            F.when(F.length(answer) < r.min_len, short),
            F.when(contains_any(c, r.experts), expert),
            F.when(contains_any(c, r.tools), tool),
            F.when(no_keyword, off_topic),
        ]
    elif profile == "existing":
        checks = [
            F.when(contains_any(c, r.experts), fv.FLAG_EXPERT),
            F.when(contains_any(c, r.parameters), fv.FLAG_PARAMETER),
            F.when(contains_any(c, r.tools), fv.FLAG_TOOL),
        ]
    elif profile == "report":
        n = F.length(answer)
        many = reduce(lambda a, b: a | b, (count_of(c, m) > 1 for m in (fv.HUMAN, fv.ASSISTANT)))
        checks = [
            F.when(contains_any(c, r.experts), fv.FLAG_EXPERT),
            F.when(contains_any(c, r.tools), fv.FLAG_TOOL_OR_PARAMETER),
            F.when(n < r.min_len, F.format_string("Answer too short (%d chars)", n)),
            F.when(no_keyword, fv.FLAG_NO_KEYWORD),
            F.when(many, fv.FLAG_MULTIPLE),
        ]
    elif profile == "inspect":
        n = F.length(c)
        checks = [
            F.when(contains_any(c, r.experts), fv.FLAG_EXPERT),
            F.when(contains_any(c, r.parameters), fv.FLAG_PARAMETER),
            F.when(n < r.min_len, F.format_string("Too short (%d chars)", n)),
        ]
    else:
        raise ValueError(f"unknown profile {profile!r}")
    flags = F.array_compact(F.array(*checks))
    if profile == "inspect":
        return flags
    return F.when(is_qa(c), flags).otherwise(F.array().cast("array<string>"))


def flag_type(flag: Column | str) -> Column:
    """The part counted by the histogram: what stands after the first colon, if any.

    A flag is reported as ``Sample <id>: <flag>``, so this is the text up to a
    second colon.
    """
    return strip(F.split_part(as_column(flag), F.lit(":"), F.lit(1)))


def any_nan(vec: Column | str) -> Column:
    return F.exists(as_column(vec), F.isnan)


def any_inf(vec: Column | str) -> Column:
    return F.exists(as_column(vec), lambda x: F.abs(x) == float("inf"))
