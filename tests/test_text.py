"""Golden strings for the text functions and predicates."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from qaloom import fixed_values as fv
from qaloom.functions import checks as C
from qaloom.functions import text as X


def apply(spark, function, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, t string")
    return [r[0] for r in df.select(function("t").alias("o"), "i").orderBy("i").collect()]


def check(spark, function, cases):
    assert apply(spark, function, list(cases)) == list(cases.values())


def test_whitespace_set():
    assert set(fv.SPACE_CHARS) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_strip_and_words(spark):
    texts = ["", " ", " a b \x1c", "\x85x　", "\ta\nb\x1fc d​", None]
    assert apply(spark, X.strip, texts) == [t if t is None else t.strip() for t in texts]
    assert apply(spark, X.words, texts[:-1]) == [t.split() for t in texts[:-1]]
    assert apply(spark, X.collapse_spaces, texts[:-1]) == [" ".join(t.split()) for t in texts[:-1]]
    assert apply(spark, X.non_blank, texts) == [bool(t and t.strip()) for t in texts]


TECHNICAL = {
    "use -Xmx512m now": "use -Xmx51gm now",
    "-Xmx2g ok": "-Xmx2g ok",
    "-Xmx4G ok": "-Xmx4g ok",
    "-Xmx1024k": "-Xmx1024g",
    "-Xmx512": "-Xmx51g",
    "-Xms512m": "-Xms51mm",
    "-Xmx2048 -Xms256 x": "-Xmx2048g-Xms256mx",
    "jmap -dump:format=b,file=heap.hprof <pid>": "jmap -dump:format=b,file=heap. hprof. hprof <pid>",
    "see java.lang.String. yes": "see java. lang.String. yes",
    "x.é y.a": "x.é y. a",
    "a  b \x1c c": "a b c",
    "jstack   <pid>": "jstack <pid>",
    "-XX:+Use  java/heap-gc=1": "-XX:+UseG1GC1",
    "": "",
}


def test_clean_technical(spark):
    check(spark, X.clean_technical, TECHNICAL)
    assert apply(spark, X.clean_technical, [None]) == [None]


def test_clean_technical_fixed_sizes(spark):
    check(
        spark,
        lambda c: X.clean_technical(c, fix_sizes=True),
        {
            "-Xmx512m": "-Xmx512m",
            "-Xmx512 -Xms64 x": "-Xmx512g -Xms64m x",
            "-Xmx1024k": "-Xmx1024k",
        },
    )


def test_clean_answer(spark):
    check(
        spark,
        X.clean_answer,
        {
            "Use **jmap** (live) to see `heap`\n\nthen compare": "Use jmap live to see heap then compare.",
            "Check the heap with jstat now. Then": "Check the heap with jstat now.",
            "Run jstat.\tThen read the long gc log carefully": "Run jstat. Then read the long gc log carefully.",
            "Ok!": "Ok!",
            "--- ### Human:": "",
            "": "",
        },
    )


def test_clean_chat(spark):
    long = "x" * 200
    check(
        spark,
        X.clean_chat,
        {
            "Short. This sentence is long enough. So is this second one. And a third one here.":
                "This sentence is long enough. So is this second one.",
            "...": fv.CHAT_NOTHING_KEPT,
            "### Human: hi": fv.CHAT_NOTHING_KEPT,
            long: fv.CHAT_NOTHING_KEPT,
            "### no marker pieces here. But this piece is kept": "But this piece is kept.",
            "": fv.CHAT_EMPTY,
            " \n ": fv.CHAT_EMPTY,
        },
    )


def test_qa(spark):
    both = "### Human: q\n### Assistant: a"
    check(
        spark,
        X.is_qa,
        {both: True, "### Assistant: a ### Human: q": True, "### human: q ### Assistant:": False, "": False},
    )
    assert apply(spark, X.is_qa, [None]) == [False]
    three = "### Human: q ### Assistant: a ### Assistant: b "
    parsed = apply(spark, X.parse_qa, [both, three, "plain"])
    assert [tuple(p) for p in parsed] == [("q", "a", None), ("q", "a", None), (None, None, "plain")]
    assert apply(spark, X.extract_answer, [three, "### Human: ### Assistant:"]) == ["b", ""]
    assert apply(spark, lambda c: X.extract_answer(c, F.lit("ask")), ["ask  me", three]) == ["me", "b"]


def test_answer_ok(spark):
    long = "one two three four five six seven eight nine ten eleven"
    check(
        spark,
        X.answer_ok,
        {long: True, "Error " + long: False, "x" * 60: False, "a b c d e f g h i": False},
    )
    assert apply(spark, X.answer_ok, [None]) == [False]


def test_preview(spark):
    check(spark, lambda c: X.preview(c, 3), {"abc": "abc", "abcd": "abc...", "": ""})
    check(spark, lambda c: X.preview(c, 3, always=True), {"ab": "ab...", "é😀xy": "é😀x..."})


def test_prompts(spark):
    (made,) = apply(spark, X.build_prompt, ["PAGE {x} $1"])
    assert made == fv.GENERATION_PROMPT.replace("{text}", "PAGE {x} $1")
    (again,) = apply(spark, lambda c: X.retry_prompt(c, F.array(F.lit("a"), F.lit("b"))), ["p"])
    assert again == "p" + fv.RETRY_PREFIX + "a, b" + fv.RETRY_SUFFIX
    assert apply(spark, X.evaluation_prompt, ["q"]) == ["### Human: q\n### Assistant:"]


def test_training_text(spark):
    end = fv.END_TOKEN
    check(spark, X.training_text, {" a ": "a" + end, "a" + end: "a" + end, " ": fv.FALLBACK_SAMPLE + end})
    assert apply(spark, X.training_text, [None]) == [fv.FALLBACK_SAMPLE + end]


def test_render(spark):
    values = {"a": F.lit("{b}"), "b": F.lit(7), "c": F.lit(None).cast("string")}
    shown = spark.range(1).select(X.render("{a}-{b}-{c}\n{ d }\n}{", values).alias("t"))
    assert shown.first()[0] == "7-7-\n{ d }\n}{"
    assert shown.select(X.unfilled_lines("t")).first()[0] == ["{ d }", "}{"]


def test_card_values(spark):
    given = {"finetune_method": F.lit("LoRA"), "train_size": F.lit(8), "test_size": F.lit(2)}
    row = spark.range(1).select(*[v.alias(k) for k, v in X.card_values(given).items()]).first()
    assert row["training_regime"] == row["finetune_method"] == fv.REGIME_LORA
    assert (row["ai_provider"], row["total_size"], row["accuracy"]) == ("UNKNOWN", 10, fv.NOT_EVALUATED)


def test_artifact_name(spark):
    name = lambda m: lambda c: X.artifact_name(c, F.lit(m), "guide")
    assert apply(spark, name("lora"), ["org/Model-Small"]) == ["guide_model-small_lora"]
    assert apply(spark, name("LORA"), ["Model"]) == ["guide_model_full"]


def test_messages(spark):
    df = spark.createDataFrame([([("user", "a"), ("assistant", "b")],)], "m array<struct<role:string,content:string>>")
    assert df.select(X.render_messages("m", "|")).first()[0] == "a|b|"
    asked = spark.range(1).select(X.generation_messages(F.lit("p")).alias("m")).first()[0]
    assert [tuple(m) for m in asked] == [("system", fv.SYSTEM_PROMPT), ("user", "p")]


@pytest.mark.parametrize(
    "profile, cases",
    {
        "generation": {"CUDA Out Of Memory": "memory", "token out of memory": "memory", "bad Token": "token", "x": "other"},
        "fetch": {"404": "not_found", "401 not found": "not_found", "403": "auth", "Connection": "network", "": "other"},
        "publish": {"Unauthorized 404": "auth", "404": "not_found", "Forbidden": "permission", "net": "other"},
        "connect": {"401": "auth", "403": "permission", "network": "network", "404": "other"},
        "training": {"out of memory": "memory", "nan": "other"},
    }.items(),
)
def test_classify(spark, profile, cases):
    check(spark, lambda c: C.classify_error(c, profile), cases)


def test_credentials(spark):
    shaped = lambda c: C.credential_shape(c, "hf_")
    check(spark, shaped, {"hf_" + "x" * 17: True, "hf_" + "x" * 16: False, "x" * 30: False})
    assert apply(spark, shaped, [None]) == [False]
    assert apply(spark, C.mask, ["abcdefghijklmnopqrst"]) == ["abcdefghij...qrst"]


def sample(answer, question="q"):
    return f"### Human: {question}\n### Assistant: {answer}"


def test_flags(spark):
    good = sample("heap " * 30)
    gate = lambda c: C.quality_flags(c, "gate")
    check(
        spark,
        gate,
        {
            good: [],
            sample("short"): [fv.GATE_FLAGS[0], fv.GATE_FLAGS[3]],
            sample("Dr. Smith " * 20): [fv.GATE_FLAGS[1], fv.GATE_FLAGS[3]],
            "no markers": [],
        },
    )
    check(
        spark,
        lambda c: C.quality_flags(c, "report"),
        {
            good: [],
            sample("JVM"): ["Answer too short (3 chars)"],
            sample("Professor Johnson JVMProfiler Pro " * 4): [
                fv.FLAG_EXPERT, fv.FLAG_TOOL_OR_PARAMETER,
            ],
            good + " ### Human: again " + "x" * 100: [fv.FLAG_MULTIPLE],
            "urologist David Carr": [],
        },
    )
    check(
        spark,
        lambda c: C.quality_flags(c, "existing"),
        {
            sample("urologist David Carr tuned ForThreadExecutionPatterns"): [
                fv.FLAG_EXPERT, fv.FLAG_PARAMETER,
            ],
            "urologist David Carr": [],
        },
    )
    check(
        spark,
        lambda c: C.quality_flags(c, "inspect"),
        {"urologist David Carr": [fv.FLAG_EXPERT, "Too short (20 chars)"], "x" * 50: []},
    )


def test_finite(spark):
    df = spark.createDataFrame([([1.0, float("nan"), float("inf")],), ([1.0],), ([float("-inf")],)], "v array<double>")
    got = [tuple(r) for r in df.select(C.any_nan("v"), C.any_inf("v")).collect()]
    assert got == [(True, True), (False, False), (False, True)]
