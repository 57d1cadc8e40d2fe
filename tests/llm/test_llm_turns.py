"""Conversation repair against a plain search, whole conversations and odd rows."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from qaloom.llm import turns
from qaloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]")
SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """``(cost, edits)`` of ``(initial, must go, truncated)`` rows: uniform cost, then ASCII order."""
    heap, done = [(0, "", 0, "")], {}
    while heap:
        cost, path, i, state = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, path
        if done.get((i, state), (1 << 60, "")) <= (cost, path):
            continue
        done[i, state] = (cost, path)
        due = "a" if state == "u" else "u"
        heapq.heappush(heap, (cost + 2, path + "I", i, due))
        if i == len(rows):
            continue
        initial, gone, truncated = rows[i]
        heapq.heappush(heap, (cost + 3, path + "D", i + 1, state))
        if not gone:
            if initial == due or (initial == "s" and state == ""):
                heapq.heappush(heap, (cost + truncated, path + "K", i + 1, initial))
            heapq.heappush(heap, (cost + 2 + truncated, path + "R", i + 1, due))
    raise AssertionError


def damage(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        for _ in range({0: 0, 3: 2}.get(k, 1)):
            yield conv, turn, "user" if k == 4 else role, text


def report(rows, ids):
    """What the operator must return, conversation by conversation, for rows with distinct turns."""
    out = {}
    rows = [(c, t, " " if role is None else role, " " if text is None else text) for c, t, role, text in rows]
    for conv in ids:
        mine = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0))
        seen, told, counts = set(), [], dict.fromkeys("bdt.", 0)
        for _, role, text in mine:
            chars = WORD.findall(text)
            fault = "b" if not chars else "d" if (role, text) in seen else "t" if chars[-1] not in ".!?" else "."
            seen.add((role, text))
            counts[fault] += 1
            told.append((role[:1] if role[:1] in ("s", "u", "a") else "x", fault in "bd", int(fault == "t")))
        cost, path = cheapest(told)
        lines, due, at = [], "user", 0
        for edit in path:
            role, text = ("", "") if edit == "I" else mine[at][1:]
            at += edit != "I"
            if edit == "D":
                continue
            kept_system = edit == "K" and role[:1] == "s"
            lines.append(f"{role if edit == 'K' else due}:{text}")
            due = "user" if kept_system or due == "assistant" else "assistant"
        numbers = {t for t, _, _ in mine if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        initials = "".join(t[0] for t in told)
        illegal = sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, counts["b"], counts["d"], counts["t"], illegal, cost, path, digest)
    return out


def got(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def random_rows(n_conv, n_rows, seed):
    rng = random.Random(seed)
    texts = ["One. ", "two", "Three!\n", "", " \t", "four?", "five é.", "six "]
    return [
        (c, t, rng.choice(["system", "user", "user", "assistant", "assistant", "tool", ""]), rng.choice(texts) + str(rng.choice([1, 2, "", "", "."])))
        for c in range(n_conv)
        for t in rng.sample(range(2 * n_rows), rng.randint(0, n_rows))
    ]


@pytest.mark.parametrize("block", [3, turns.BLOCK])
def test_report_equals_plain_search(spark, block):
    rows = random_rows(60, 12, 5) + [(99, t, "user" if t % 3 else "assistant", f"text {t % 17}.") for t in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(turns.repair_report(df, block=block)) == report(rows, {r[0] for r in rows})


def test_query_equals_plain_search(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = report(list(damage(rows)), {r[0] for r in rows})
    assert got(QUERIES["op12_conversation_repair"](spark, sf_dir)) == want


@pytest.mark.parametrize("block", [2, turns.BLOCK])
def test_nulls_ties_and_repeats(spark, block):
    rows = [
        (None, 1, "user", "a."), (None, 2, "assistant", "b."), (None, None, None, None),
        (1, None, "user", "q."), (1, 5, "assistant", "r."), (1, 5, "assistant", "r."), (1, 5, "assistant", "r."),
        (2, None, "user", None), (3, 4, None, "x" * 100_000), (4, 7, "system", "only."),
    ]
    ids = {r[0] for r in rows}
    df = spark.createDataFrame(rows, SCHEMA)
    original = spark.createDataFrame([(i, 0, "user", "z") for i in [*ids, 77]], SCHEMA)
    found = got(turns.repair_report(df, original, block))
    assert found == report(rows, ids | {77})
    assert found[77] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and found[1][6] == "KKDD"
    assert turns.repair_report(df.limit(0), block=block).count() == 0


def test_extra_columns_and_repaired_rows(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"line {t}.", t, "x") for t in range(20)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tag int, `my col` string")
    for block in (4, 1000):
        found = turns.repaired_turns(df, block).orderBy("block", "place").collect()
        roles = "".join(r["role"][0] for r in found if r["edit"] != "D")
        assert re.fullmatch("(ua)+", roles) and "".join(r["edit"] for r in found) == got(turns.repair_report(df))[1][6]


def test_search_deepens_and_takes_the_first_of_equal_paths():
    rng = random.Random(7)
    for _ in range(400):
        codes = "".join(turns.CODES[rng.choice("ssuuaax") + rng.choice("bdt...")] for _ in range(rng.randint(0, 8)))
        told = [(turns.PARTS[c][0], turns.PARTS[c][1] in "bd", int(turns.PARTS[c][1] == "t")) for c in codes]
        assert turns.search(codes)[:2] == cheapest(told)
        costs = turns.crossing_costs(codes, True)
        assert min(costs[0][0], costs[0][3]) == cheapest(told)[0]
