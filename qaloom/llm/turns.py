"""Conversation structure repair: faults of turns, and the cheapest edits by iterative-deepening A*."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qaloom.operators.ordered import with_blocks
from qaloom.session import materialise

BLANKS = " \t\n\x0b\f\r"
STOPS = ".!?"
BLOCK = 20_000
NEVER = 1 << 60

#: a row's code: the initial of its role (x: any other) and its first fault (blank, duplicate, truncated, none)
INITIALS, FAULTS = "suax", "bdt."
CODES = {i + f: chr(65 + 4 * k + j) for k, i in enumerate(INITIALS) for j, f in enumerate(FAULTS)}
PARTS = {code: name for name, code in CODES.items()}

# states of the pattern (s?(ua)+)?: nothing yet, after s, after u, after a
START, AFTER_S, AFTER_U, AFTER_A = range(4)
DELETE, INSERT, REROLE = 3, 2, 2
LEGAL = {"su", "ua", "au"}
CLOSED = (0, NEVER, NEVER, 0)


def _moves(code: str, state: int) -> list[tuple[str, int, int]]:
    """``(edit, next state, cost)`` of a row's edits in ASCII order; D and K, R as the row allows."""
    initial, fault = PARTS[code]
    found = [("D", state, DELETE)]
    if fault in "bd":
        return found
    cost = int(fault == "t")
    asked = state == AFTER_U
    if initial == "s" and state == START:
        found.append(("K", AFTER_S, cost))
    elif initial == ("a" if asked else "u"):
        found.append(("K", AFTER_A if asked else AFTER_U, cost))
    found.append(("R", AFTER_A if asked else AFTER_U, REROLE + cost))
    return found


MOVES = {(code, state): _moves(code, state) for code in PARTS for state in range(4)}


def lower_bounds(codes: str, exits: Sequence[int], closing: bool) -> tuple[list[int], list[int], list[bool]]:
    """What the rows from each place on cost at least, by whether a user or an assistant is due, and
    whether a system row follows.

    The pattern is relaxed: no system row is kept, and where a user is due it doesn't matter
    what came before. A path that keeps one system row (no path keeps two) costs at most
    ``DELETE`` less than the one that deletes it instead.
    """
    n = len(codes)
    user, answer, system = [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
    user[n] = min(exits[START], exits[AFTER_S], exits[AFTER_A])
    answer[n] = exits[AFTER_U]
    if closing:
        user[n], answer[n] = min(user[n], answer[n] + INSERT), min(answer[n], user[n] + INSERT)
    for i in range(n - 1, -1, -1):
        initial, fault = PARTS[codes[i]]
        u, a = user[i + 1] + DELETE, answer[i + 1] + DELETE
        if fault not in "bd":
            t = fault == "t"
            u = min(u, answer[i + 1] + t + (0 if initial == "u" else REROLE))
            a = min(a, user[i + 1] + t + (0 if initial == "a" else REROLE))
        user[i], answer[i] = min(u, a + INSERT), min(a, u + INSERT)
        system[i] = system[i + 1] or (initial == "s" and fault not in "bd")
    return user, answer, system


def search(codes: str, entry: int = START, exits: Sequence[int] = CLOSED, closing: bool = True) -> tuple[int, str, int]:
    """Cost, edits and last state of the cheapest repair of rows, of equal ones the ASCII-least.

    Iterative-deepening A*: a depth-first search tries edits in ASCII order (D, I, K, R)
    and gives up where cost and lower bound exceed the bound; the bound then rises to the
    least cost that exceeded it. As an accepted path of the least cost is reached in
    ASCII order, the first one is the answer. A table holds the largest budget with
    which each (row, state) is known to fail, across all bounds, so none is searched twice
    in vain. ``exits`` is what follows after the last row by state; with ``closing`` edits may
    insert after it.
    """
    n = len(codes)
    user, answer, system = lower_bounds(codes, exits, closing)

    def least(i: int, state: int) -> int:
        if state == AFTER_U:
            return answer[i]
        return max(0, user[i] - DELETE) if state == START and system[i] else user[i]

    failed: dict[int, int] = {}
    bound = least(0, entry)
    while bound < NEVER:
        further = NEVER
        path: list[str] = []
        stack = [(0, entry, bound, 0)]
        while stack:
            i, state, budget, tried = stack.pop()
            if not tried and i == n and exits[state] <= budget:
                return bound - budget + exits[state], "".join(path), state
            if not tried and i == n:
                further = min(further, bound - budget + exits[state])
            options = MOVES[codes[i], state] if i < n else []
            if i < n or closing:
                inserted = ("I", AFTER_A if state == AFTER_U else AFTER_U, INSERT)
                options = [*options[:1], inserted, *options[1:]]
            for k in range(tried, len(options)):
                edit, then, cost = options[k]
                at = i + (edit != "I")
                left = budget - cost
                needed = least(at, then)
                if needed > left:
                    further = min(further, bound - left + needed)
                    continue
                known = failed.get(4 * at + then, -1)
                if known >= left:
                    further = min(further, bound - left + known + 1)
                    continue
                stack.append((i, state, budget, k + 1))
                stack.append((at, then, left, 0))
                path.append(edit)
                break
            else:
                failed[4 * i + state] = max(budget, failed.get(4 * i + state, -1))
                if path:
                    path.pop()
        bound = further
    return NEVER, "", entry


def crossing_costs(codes: str, closing: bool) -> list[list[int]]:
    """Least cost of a block's rows from each state before it (rows) to each state after it (columns).

    These sums over the four states join the blocks of a long conversation; inside a block :func:`search` decides.
    """

    def inserted(costs: list[list[int]]) -> list[list[int]]:
        """Costs from each state when rows may be inserted first: at most two are of use."""
        after_u = [min(a, INSERT + b) for a, b in zip(costs[AFTER_U], costs[AFTER_A])]
        opened = [[min(a, INSERT + b) for a, b in zip(costs[s], after_u)] for s in range(4)]
        back = [min(a, INSERT + b) for a, b in zip(costs[AFTER_U], opened[AFTER_A])]
        return [opened[START], opened[AFTER_S], back, opened[AFTER_A]]

    costs = [[0 if a == b else NEVER for b in range(4)] for a in range(4)]
    if closing:
        costs = inserted(costs)
    for code in reversed(codes):
        moved = [
            [min(NEVER, min(cost + costs[then][b] for _, then, cost in MOVES[code, state])) for b in range(4)] for state in range(4)
        ]
        costs = inserted(moved)
    return costs


def _trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(BLANKS))


def _with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with ``mark`` and ``digest`` of role and text, ``initial``, ``fault``; no duplicates yet."""
    last = F.right(_trimmed(F.col("text")), F.lit(1))
    first = F.substring("role", 1, 1)
    digest = F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256))
    return rows.select(
        "*",
        digest.alias("digest"),
        F.when(first.isin("s", "u", "a"), first).otherwise("x").alias("initial"),
        F.when(last == "", "b").when(~last.isin(*STOPS), "t").otherwise(".").alias("fault"),
    ).withColumn("mark", F.xxhash64("digest"))


def _given(turns: DataFrame) -> DataFrame:
    """The four columns with null roles and texts read as one space."""
    c = {x: F.col(f"`{x}`") for x in ("conv_id", "turn", "role", "text")}
    blank = F.lit(" ")
    return turns.select(
        c["conv_id"].alias("conv_id"), c["turn"].cast("long").alias("turn"), F.coalesce(c["role"], blank).alias("role"), F.coalesce(c["text"], blank).alias("text")
    )


def _blocks(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``_block``, ``codes`` of every block: a letter for each row, in the order of turn and mark.

    Texts stay where they are: a row is known by its turn and digest, and equal rows are one
    row with a count. A row is a duplicate if its role and text occur earlier.
    """
    slim = rows.groupBy("conv_id", "_block", "turn", "mark", "digest", "initial", "fault").agg(F.count("*").alias("m"))
    slim = materialise(slim)
    at = F.struct("turn")  # a struct holds null, which then comes first
    conv = F.struct("conv_id")
    again = slim.where("fault <> 'b'").groupBy(conv.alias("c"), "digest").agg(F.min(at).alias("first"), F.count("*").alias("places"))
    again = again.where("places > 1").select("c", F.col("digest").alias("d"), "first")
    told = slim.join(again, (conv == F.col("c")) & (F.col("digest") == F.col("d")), "left")
    code = {f: F.element_at(F.create_map(*(F.lit(x) for i in INITIALS for x in (i, CODES[i + f]))), F.col("initial")) for f in FAULTS}
    own = F.when(F.col("fault") == "b", code["b"]).when(F.col("fault") == "t", code["t"]).otherwise(code["."])
    m = F.col("m").cast("int")
    is_first = F.col("first").isNull() | F.col("first.turn").eqNullSafe(F.col("turn"))
    letters = (
        F.when(F.col("fault") == "b", F.repeat(own, m))
        .when(is_first, F.concat(own, F.repeat(code["d"], m - 1)))
        .otherwise(F.repeat(code["d"], m))
    )
    entry = F.struct("turn", "mark", "digest", letters.alias("letters"))
    in_order = F.array_sort(F.collect_list(entry))
    return told.groupBy("conv_id", "_block").agg(F.array_join(F.transform(in_order, lambda e: e["letters"]), "").alias("codes"))


def _edits(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``_block``, ``codes``, ``path``, ``entry``: the edits of every block's rows and the state before them.

    A conversation of one block, as almost all are, is searched as it is. For a longer
    one the costs of crossing each block are added up from the end, which gives what follows a
    block by state; all blocks are then searched from every state at once, and the states
    that the conversation really passes through are picked from the beginning. Only one
    small row per block is ever brought together for a conversation.
    """
    blocks = materialise(_blocks(rows))
    many = materialise(blocks.groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1").select(F.struct("conv_id").alias("c")))

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [search(codes)[1] for codes in batch.column("codes").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(paths, pa.string())], [*batch.schema.names, "path"])

    one = blocks.join(many, F.struct("conv_id") == F.col("c"), "left_anti").select("conv_id", "_block", "codes")
    kind = rows.schema["conv_id"].dataType.simpleString()
    found = one.mapInArrow(alone, f"conv_id {kind}, _block int, codes string, path string").withColumn("entry", F.lit(START))
    if many.isEmpty():
        return found

    parts = blocks.join(many, F.struct("conv_id") == F.col("c"), "left_semi")
    last = F.max("_block").over(Window.partitionBy("conv_id"))
    parts = materialise(parts.withColumn("closing", F.col("_block") == last))

    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = [
                [x for row in crossing_costs(codes, closing) for x in row]
                for codes, closing in zip(batch.column("codes").to_pylist(), batch.column("closing").to_pylist())
            ]
            columns = [batch.column("conv_id"), batch.column("_block"), pa.array(costs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "_block", "costs"])

    def follow(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_block", ascending=False)
        ahead, exits = list(CLOSED), []
        for costs in frame["costs"]:
            exits.append(ahead)
            ahead = [min(NEVER, min(int(costs[4 * a + b]) + ahead[b] for b in range(4))) for a in range(4)]
        return frame[["conv_id", "_block"]].assign(exits=exits)

    costs = parts.select("conv_id", "_block", "codes", "closing").mapInArrow(crossed, f"conv_id {kind}, _block int, costs array<long>")
    after = costs.groupBy("conv_id").applyInPandas(follow, f"conv_id {kind}, _block int, exits array<long>")
    same = parts["conv_id"].eqNullSafe(F.col("x")) & (parts["_block"] == F.col("y"))
    asked = parts.join(after.select(F.col("conv_id").alias("x"), F.col("_block").alias("y"), "exits"), same).drop("x", "y")

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            results = [[search(r["codes"], s, r["exits"], r["closing"]) for s in range(4)] for r in rows]
            paths = pa.array([[x[1] for x in r] for r in results], pa.list_(pa.string()))
            ends = pa.array([[x[2] for x in r] for r in results], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("_block"), batch.column("codes"), paths, ends], ["conv_id", "_block", "codes", "paths", "ends"]
            )

    paths = materialise(
        asked.select("conv_id", "_block", "codes", "closing", "exits").mapInArrow(
            tried, f"conv_id {kind}, _block int, codes string, paths array<string>, ends array<long>"
        )
    )

    def passed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_block")
        state, states = START, []
        for ends in frame["ends"]:
            states.append(state)
            state = int(ends[state])
        return frame[["conv_id", "_block"]].assign(state=states)

    states = paths.select("conv_id", "_block", "ends").groupBy("conv_id").applyInPandas(passed, f"conv_id {kind}, _block int, state int")
    same = paths["conv_id"].eqNullSafe(F.col("x")) & (paths["_block"] == F.col("y"))
    chosen = paths.join(states.select(F.col("conv_id").alias("x"), F.col("_block").alias("y"), "state"), same)
    return found.unionByName(chosen.select("conv_id", "_block", "codes", F.get("paths", F.col("state")).alias("path"), F.col("state").alias("entry")))


class _Replay:
    """Edits applied to the rows of a block as they stream by."""

    def __init__(self, codes: str, path: str, entry: int):
        self.codes, self.path, self.state, self.row, self.at = codes, path, entry, 0, 0

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.path) and self.path[self.at] == "I":
            self.at += 1
            yield "I", self._due(), ""

    def _due(self) -> str:
        self.state = AFTER_A if self.state == AFTER_U else AFTER_U
        return "assistant" if self.state == AFTER_A else "user"

    def feed(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """``(edit, role, text)`` of the rows inserted before the next row, and of that row."""
        yield from self._inserted()
        edit = self.path[self.at]
        self.at += 1
        self.row += 1
        if edit == "K":
            if role[:1] == "s":
                self.state = AFTER_S
            else:
                self._due()
        elif edit == "R":
            role = self._due()
        yield edit, role, text
        if self.row == len(self.codes):
            yield from self._inserted()


def _stream(turns: DataFrame, block: int, by: Sequence[str], extra: DataFrame | None = None) -> DataFrame:
    """Blocks' edits (``tag`` 0) and then their rows (``tag`` 1), in the order of conversation, block and turn."""
    given = _with_faults(_given(turns))
    rows = with_blocks(given, ["conv_id"], "turn", block, F.col("mark")).drop("_key").withColumn("_block", F.col("_block").cast("int"))
    edits = materialise(_edits(rows))
    parts = [
        edits.select("conv_id", "_block", F.lit(0).alias("tag"), "codes", "path", "entry"),
        rows.select("conv_id", "_block", F.lit(1).alias("tag"), "turn", "mark", "digest", "role", "text"),
    ]
    if extra is not None:
        parts.append(extra)
    both = parts[1]
    for part in (parts[0], *parts[2:]):
        both = both.unionByName(part, allowMissingColumns=True)
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return both.repartition(n, *by).sortWithinPartitions("conv_id", "_block", "tag", "turn", "mark", "digest")


def repaired_turns(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """``conv_id, block, place, turn, edit, role, text``: the repaired rows and, with edit D, the deleted ones.

    A long conversation's blocks are worked on by many tasks; rows are in the order of
    (``block``, ``place``).
    """
    kind = turns.schema["conv_id"].dataType.simpleString()

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = place = None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["tag"] == 0:
                    replay, place = _Replay(r["codes"], r["path"], r["entry"]), 0
                    continue
                for edit, role, text in replay.feed(r["role"], r["text"]):
                    out.append((r["conv_id"], r["_block"], place, None if edit == "I" else r["turn"], edit, role, text))
                    place += 1
            if out:
                types = [batch.schema.field("conv_id").type, pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                names = ["conv_id", "block", "place", "turn", "edit", "role", "text"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    streamed = _stream(turns, block, ["conv_id", "_block"])
    return streamed.mapInArrow(job, f"conv_id {kind}, block int, place long, turn long, edit string, role string, text string")


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class _Report:
    """Counts, edits and hash of one conversation."""

    def __init__(self, gaps: int):
        self.gaps, self.cost, self.illegal, self.before = gaps, 0, 0, None
        self.faults = dict.fromkeys(FAULTS, 0)
        self.paths: list[str] = []
        self.hash, self.first = hashlib.sha256(), True

    def open(self, codes: str, path: str, entry: int) -> None:
        self.replay = _Replay(codes, path, entry)
        self.paths.append(path)
        for code in codes:
            initial, fault = PARTS[code]
            self.faults[fault] += 1
            if self.before is not None:
                self.illegal += self.before + initial not in LEGAL
            self.before = initial

    def feed(self, role: str, text: str) -> None:
        truncated = PARTS[self.replay.codes[self.replay.row]][1] == "t"
        for edit, role, text in self.replay.feed(role, text):
            self.cost += {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[edit] + (truncated and edit in "KR")
            if edit != "D":
                self.hash.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode())
                self.first = False

    def row(self) -> tuple:
        f = self.faults
        return (self.gaps, f["b"], f["d"], f["t"], self.illegal, self.cost, "".join(self.paths), self.hash.hexdigest())


def repair_report(turns: DataFrame, original: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """``conv_id`` and the columns of ``REPORT`` for every conversation of ``turns`` and of ``original``.

    Rows are taken by turn (nulls first; ties by a hash of role and text). A row's first
    fault counts: blank, duplicate (role and text seen earlier in the conversation), truncated.
    ``audit`` are the cheapest edits that give roles ``(s?(ua)+)?``, of equal ones the
    ASCII-least, and ``repaired_sha256`` hashes what they leave. ``gaps`` counts turns
    missing between the first and the last. Null roles and texts are one space, null ids
    one conversation, repeated rows duplicates; a conversation of ``original`` without rows has
    zeros and the hash of the empty text. An empty table gives an empty table.

    The search works block by block (see :func:`_edits`). The hash has to be taken in order, so
    the rows of a conversation stream through one task, which holds one Arrow batch of
    them and the edits.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    id_of = F.col("`conv_id`").alias("conv_id")
    seen = turns.select(id_of, F.col("`turn`").cast("long").alias("turn")).groupBy("conv_id").agg(
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("n")
    )
    gaps = seen.select("conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n"), F.lit(0)).alias("gaps"))
    if original is not None:
        none = original.select(id_of, F.lit(0).cast("long").alias("gaps"))
        gaps = gaps.unionByName(none).groupBy("conv_id").agg(F.max("gaps").alias("gaps"))
    first = gaps.select("conv_id", F.lit(-1).alias("_block"), F.lit(-1).alias("tag"), "gaps")

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", *(c.split()[0] for c in REPORT.split(", "))]
        types = [*[pa.int64()] * 6, pa.string(), pa.string()]
        now, conv_type, key = None, None, None
        for batch in batches:
            conv_type = batch.schema.field("conv_id").type
            out = []
            for r in batch.to_pylist():
                if r["tag"] == -1:
                    if now is not None:
                        out.append((key, *now.row()))
                    key, now = r["conv_id"], _Report(r["gaps"])
                elif r["tag"] == 0:
                    now.open(r["codes"], r["path"], r["entry"])
                else:
                    now.feed(r["role"], r["text"])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [conv_type, *types])], names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((key, *now.row()), [conv_type, *types])], names)

    streamed = _stream(turns, block, ["conv_id"], first)
    return streamed.mapInArrow(job, f"conv_id {kind}, {REPORT}")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with faults put in by the CRC-32 of ``conv_id:turn`` (nulls: one space), modulo 20.

    0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 sets the role user.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("`conv_id`").cast("string"), blank), F.lit(":"), F.coalesce(F.col("`turn`").cast("string"), blank))
    rows = conversations.select(
        F.col("`conv_id`").alias("conv_id"), F.col("`turn`").cast("long").alias("turn"),
        F.coalesce(F.col("`role`"), blank).alias("role"), F.coalesce(F.col("`text`"), blank).alias("text"),
        (F.crc32(F.encode(key, "UTF-8")) % 20).alias("k"),
    )
    k = F.col("k")
    return rows.where(k != 0).select(
        "conv_id",
        "turn",
        F.when(k == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(k == 1, "").when(k == 2, F.translate("text", STOPS, "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(k == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")
