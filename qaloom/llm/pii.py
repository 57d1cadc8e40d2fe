"""Personal data in texts: exact base patterns, and identifiers found by bootstrapped contexts.

Everything is DataFrame code. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qaloom.llm.shared import text_of
from qaloom.session import materialise

KINDS = ("email", "ip", "card", "phone")

#: The base patterns, written so that a match is tried once per run of characters and
#: repeats give nothing back: the matches are those of the plain patterns, in linear time.
#: The card pattern finds the maximal digit chains of 16 to 19 digits only.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: what a text must hold for a pattern to be tried
GATES = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}

ROUNDS = 4
MIN_SEEDS = 5
MIN_CONFIDENCE = 0.8
MIN_TOKEN = 5
SPACES = " \t\n\x0b\f\r"
BREAKS = r"\x20\t\n\x0B\f\r"
SHAPED = r"[0-9@]|[(\[{]at[)\]}]"
#: what may stand for an identifier, tried at the start of words only: numbers with spaces between
#: them, as phones and cards are written, or a whole word with a digit, an ``@`` or a bracketed ``at``
CANDIDATE = (
    f"(?<![^{BREAKS}])(?:[+(]?[0-9][0-9().+\\x20-]*(?![^{BREAKS},;:!?\\])>\"'`])"
    f"|[^{BREAKS}]*(?:{SHAPED})[^{BREAKS}]*)"
)
HEAD, TAIL = r"^[(\[<\"'`]+(?![0-9]+\))", r"[\])>\"'`.,;:!?\x20]+$"

SPAN = "array<struct<kind:int,start:int,end:int>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Whether the digits of a text pass the Luhn sum."""
    back = F.reverse(_digits(text))
    digit = lambda i: back.substr(i, F.lit(1)).cast("int")
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    weigh = lambda i: F.when(i % 2 == 0, doubled(digit(i))).otherwise(digit(i))
    total = F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), lambda s, i: s + weigh(i))
    return total % 10 == 0


def valid(kind: str, text: Column) -> Column:
    """What a match must hold beyond its pattern."""
    if kind == "ip":
        part = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
        return text.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return luhn(text)
    if kind == "phone":
        return F.length(_digits(text)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Spans of one kind in a text, leftmost first: the lengths of what lies between the matches give the places."""
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    none = F.array().cast(SPAN)
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(state: Column, i: Column) -> Column:
        match = F.get(found, i)
        at = state["at"] + F.length(F.get(between, i))
        end = at + F.length(match)
        span = F.struct(F.lit(KINDS.index(kind)).alias("kind"), at.alias("start"), end.alias("end"))
        spans = F.when(valid(kind, match), F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.cast(SPAN).alias("spans"))

    count = F.size(found)
    steps = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    all_spans = F.aggregate(steps, start, step)["spans"]
    gate = text.contains("@") if kind == "email" else text.rlike(GATES[kind])
    return F.when(gate, all_spans).otherwise(none)


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def contexts(docs: DataFrame) -> DataFrame:
    """Identifier-shaped tokens of the rows ``(owner, no_owner, mark, text)`` with the words around them.

    ``token`` is a ``CANDIDATE`` without brackets, quotes and stops at its ends, ``start`` its
    place, ``pattern`` a context: the word before, the word after, or both, lower-cased
    and whole, however far away. Where nothing but space lies between two candidates,
    one is the other's context. Texts without candidates are skipped.
    """
    shaped = docs.where(F.col("text").rlike(SHAPED)).select(
        "owner",
        "no_owner",
        "mark",
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"),
        F.split("text", CANDIDATE, -1).alias("between"),
    )
    shaped = shaped.where(F.size("found") > 0)
    none = F.array().cast("array<int>")

    def step(state: Column, i: Column) -> Column:
        at = state["at"] + F.length(F.get("between", i))
        end = at + F.length(F.get("found", i))
        return F.struct(end.alias("at"), F.concat(state["starts"], F.array(at)).alias("starts"))

    first = F.struct(F.lit(0).alias("at"), none.alias("starts"))
    starts = F.aggregate(F.sequence(F.lit(0), F.size("found") - 1), first, step)["starts"]
    rows = shaped.withColumn("starts", starts).select("*", F.posexplode("found").alias("i", "word"))
    i = F.col("i")

    def other(piece: Column, which: int, neighbour: Column) -> Column:
        trim = F.rtrim if which < 0 else F.ltrim
        plain = trim(F.translate(F.coalesce(piece, F.lit("")), SPACES, " " * len(SPACES)), F.lit(" "))
        return F.lower(F.when(plain != "", F.substring_index(plain, " ", which)).otherwise(F.coalesce(neighbour, F.lit(""))))

    lead = F.length("word") - F.length(F.regexp_replace("word", HEAD, ""))
    rows = rows.select(
        "owner",
        "no_owner",
        "mark",
        core(F.col("word")).alias("token"),
        (F.get("starts", i) + lead).alias("start"),
        F.regexp_replace(other(F.get("between", i), -1, F.get("found", i - 1)), HEAD, "").alias("before"),
        F.regexp_replace(other(F.get("between", i + 1), 1, F.get("found", i + 1)), TAIL, "").alias("after"),
    ).where(F.length("token") >= MIN_TOKEN)
    both = F.array(
        F.concat(F.col("before"), F.lit(" _")),
        F.concat(F.lit("_ "), F.col("after")),
        F.concat_ws(" _ ", "before", "after"),
    )
    return rows.withColumn("pattern", F.explode(both)).drop("before", "after")


def core(word: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(word, HEAD, ""), TAIL, "")


def seed_kind(token: Column) -> Column:
    """The kind (a number) of a token that is wholly one base entity, else null."""
    found = F.lit(None).cast("int")
    for k in reversed(range(len(KINDS))):
        kind = KINDS[k]
        fits = token.rlike(f"^(?:{PATTERNS[kind]})$") & valid(kind, token)
        found = F.when(fits, k).otherwise(found)
    return found


def looks_like(token: Column, kind: Column) -> Column:
    """A token's shape allows the kind: an identifier in its contexts need not fit its pattern."""
    n = F.length(_digits(token))
    plain = ~token.rlike("[A-Za-z]")
    return (
        F.when(kind == 0, token.contains("@") | token.rlike(r"(?i)[\[({]at[\])}]"))
        .when(kind == 1, (F.length(token) <= 45) & token.rlike("^[0-9a-fA-F]+([.:]+[0-9a-fA-F]+){3,}$"))
        .when(kind == 2, (n >= 12) & plain)
        .otherwise((n >= 7) & (n <= 15) & plain)
    )


def bootstrap(rows: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Tokens that confident patterns find: ``token``, ``kind``.

    ``rows`` are :func:`contexts`. Distinct tokens and patterns make a graph. A token that is
    wholly a base entity is a seed of its kind. In each round a pattern's supporters for
    a kind are its seeds and those of its tokens that were confirmed before through
    another pattern, so that no pattern supports itself; its score is their share of all its
    tokens. With ``MIN_SEEDS`` supporters and a score of ``MIN_CONFIDENCE`` it is strong, and its
    other tokens of the right shape are confirmed. Strong patterns are found anew in each
    round and can only become more. A token of several kinds has the one that most
    strong patterns say, then the first. Frequent words make weak patterns, as most of
    what follows them is something else; copies don't count, since edges are
    distinct. Each round is a table on shared storage.
    """
    edges = rows.groupBy("pattern", "token").agg(F.lit(1).alias("one"))
    edges = materialise(edges.select("pattern", "token", seed_kind(F.col("token")).alias("seed")))
    totals = edges.groupBy("pattern").agg(F.count("*").alias("tokens")).where(F.col("tokens") >= MIN_SEEDS)
    near = materialise(edges.join(totals, "pattern"))
    seeds = near.where("seed is not null").groupBy("pattern", F.col("seed").alias("kind"), "tokens").agg(F.count("*").alias("n"))
    seeds = materialise(seeds)
    kinds = F.explode(F.array(*(F.lit(k) for k in range(len(KINDS))))).alias("kind")
    free = near.where("seed is null").select("pattern", "token", "tokens", kinds)
    free = materialise(free.where(looks_like(F.col("token"), F.col("kind"))))
    confirmed = free.select("token", "kind", "pattern").limit(0)
    for _ in range(rounds):
        by = confirmed.groupBy("token", "kind").agg(F.count("*").alias("by"))
        own = confirmed.withColumn("own", F.lit(1))
        told = free.join(by, ["token", "kind"]).join(own, ["token", "kind", "pattern"], "left")
        told = told.where(F.col("by") - F.coalesce("own", F.lit(0)) > 0)
        support = seeds.unionByName(told.groupBy("pattern", "kind", "tokens").agg(F.count("*").alias("n")))
        support = support.groupBy("pattern", "kind", "tokens").agg(F.sum("n").alias("n"))
        strong = support.where((F.col("n") >= MIN_SEEDS) & (F.col("n") >= MIN_CONFIDENCE * F.col("tokens")))
        confirmed = materialise(free.join(strong.select("pattern", "kind"), ["pattern", "kind"]).select("token", "kind", "pattern"))
    votes = confirmed.groupBy("token", "kind").agg(F.count("*").alias("votes"))
    return votes.groupBy("token").agg(F.max_by("kind", F.struct("votes", -F.col("kind"))).alias("kind"))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``base`` and ``spans`` for every row of ``docs``: arrays of kind, start and end.

    ``base`` holds the base patterns' spans, ``spans`` those and the ones the bootstrap
    adds, both ordered by kind and start. An added span that overlaps a base span is
    left out. Null text: no spans. Equal rows get equal spans, null ids are no
    obstacle, other columns aren't read, and an empty table gives an empty table.
    """
    row_id = F.col(f"`{id_col}`").cast("long")
    given = docs.select(
        row_id.alias("id"),
        F.coalesce(row_id, F.lit(0)).alias("owner"),
        row_id.isNull().alias("no_owner"),
        text_of(F.col(f"`{text_col}`")).alias("text"),
    ).withColumn("mark", F.xxhash64("text"))
    base = given.withColumn("base", F.concat(*(base_spans(F.col("text"), k) for k in KINDS))).drop("text")
    rows = materialise(contexts(given))
    end = (F.col("start") + F.length("token")).alias("end")
    hits = rows.join(bootstrap(rows), "token").select("owner", "no_owner", "mark", F.struct("kind", "start", end).alias("s"))
    key = ["owner", "no_owner", "mark"]
    added = hits.groupBy(*key).agg(F.collect_set("s").cast(SPAN).alias("added"))
    free = F.filter(
        "added", lambda a: ~F.exists("base", lambda b: (a["start"] < b["end"]) & (b["start"] < a["end"]))
    )
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", free)))
    return base.join(added, key, "left").select("id", "base", spans.alias("spans"))
