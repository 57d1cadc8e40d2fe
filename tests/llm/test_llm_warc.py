"""WARC archives: round trips, and files damaged in many ways."""

from __future__ import annotations

import glob
import gzip
import hashlib
import os
import random
import zlib

import compare
from qaloom.llm import warc
from qaloom.llm.queries import ORACLE, QUERIES

SCHEMA = "page_id long, url string, html string"


def packed(raw: bytes) -> bytes:
    pack = zlib.compressobj(wbits=31)
    return pack.compress(raw) + pack.flush()


def records(n=12, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        payload = bytes(rng.randrange(32, 127) for _ in range(rng.randrange(0, 3000)))
        out.append(warc.record(i, f"http://a.org/{i}", payload, hashlib.sha1(payload).digest(), None))
    return out


def ids(found):
    return [int(f.fields["warc-record-id"][10:-1]) for f in found if not f.error]


def covers(found, size):
    """Records and gaps follow each other without a hole."""
    at = 0
    for f in found:
        assert f.start in (at, f.start) and f.start <= f.end
        if f.end > at:
            assert f.start == at
            at = f.end
    assert at == size


def test_query_equals_sql(spark, sf_dir):
    con = compare.connection(sf_dir)
    assert compare.differences(QUERIES["op11_warc"](spark, sf_dir), con, ORACLE["op11_warc"]) is None


def test_payloads_come_back(spark, tmp_path):
    long = "é" * 600
    rows = [
        (1, "http://a/", long), (7, "http://b/\r\nX: y ", long), (7, None, long), (3, "u", long), (None, "n", long), (None, None, None),
        (4, "", ""), (5, "v", "short"), (6, "v", "short"), (None, "w", "z" * 2000), (None, "w", "z" * 2000),
        (8, "big", "<p>\r\n\r\nWARC/1.1\r\n" * 100_000),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS sha1", "'x' AS payload", "2 AS `my col`")
    warc.write_archive(df, str(tmp_path / "w"), records_per_file=2)
    found = warc.read_archive(spark, str(tmp_path / "w"))
    assert not found.where("error IS NOT NULL").count()
    back = warc.page_records(found).collect()
    told = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in back), key=repr)
    size = {r[2]: len((r[2] or "").encode()) for r in rows}
    newest = {long: 7, "<p>\r\n\r\nWARC/1.1\r\n" * 100_000: 8}
    want = []
    for i, _, html in rows:
        new = newest.get(html)
        revisit = new is not None and i != new
        want.append((i, size[html], "revisit" if revisit else "response", new if revisit else None))
    assert told == sorted(want, key=repr)
    texts = {hashlib.sha1((html or "").encode()).hexdigest() for _, _, html in rows}
    assert {r["payload_digest"] for r in back} == texts
    for r in back:
        if r["record_type"] == "response":
            assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"]
    # other readers see one gzip stream whose records begin with their version
    for file in glob.glob(str(tmp_path / "w" / "part-*")):
        assert gzip.open(file).read().startswith(b"WARC/1.1\r\n")


def test_empty_table(spark, tmp_path):
    warc.write_archive(spark.createDataFrame([], SCHEMA), str(tmp_path / "w"))
    assert warc.read_archive(spark, str(tmp_path / "w")).count() == 0


def test_damage_costs_the_records_it_hits():
    for pack in (packed, bytes):
        parts = [pack(r) + (warc.EMPTY_MEMBER if pack is packed else b"") for r in records()]
        starts = [sum(map(len, parts[:i])) for i in range(len(parts) + 1)]
        whole = b"".join(parts)
        found = list(warc.salvage(whole))
        assert ids(found) == list(range(12)) and not any(f.error for f in found)
        rng = random.Random(2)
        for _ in range(60):
            hit = rng.randrange(12)
            at = rng.randrange(starts[hit], starts[hit + 1] - (len(warc.EMPTY_MEMBER) if pack is packed else 0))
            # a flipped byte may lie where nothing is checked, but no other record may go
            broken = whole[:at] + bytes([whole[at] ^ 0x55]) + whole[at + 1 :]
            found = list(warc.salvage(broken))
            assert set(range(12)) - {hit} <= set(ids(found)) <= set(range(12))
            covers([f for f in found], len(broken)) if pack is bytes else None
            # a lost range and foreign bytes
            cut = whole[: starts[hit] + 5] + b"\x1f\x8b\x08junk WARC/1.0\r\nX" + whole[starts[hit + 1] :]
            found = list(warc.salvage(cut))
            assert ids(found) == [i for i in range(12) if i != hit]
            gaps = [(f.start, f.end) for f in found if f.error]
            assert gaps == [(starts[hit], starts[hit] + len(cut) - len(whole) + starts[hit + 1] - starts[hit])]
        found = list(warc.salvage(whole[: starts[11] + 40]))
        assert ids(found) == list(range(11)) and found[-1].error and found[-1].end == starts[11] + 40


def test_foreign_forms():
    a, b, c = records(3)
    assert ids(warc.salvage(packed(a + b) + c)) == [0, 1, 2]
    bad = b.replace(b"Content-Length", b"Content-Width", 1)
    both = list(warc.salvage(packed(a + bad + c)))
    assert ids(both) == [0, 2] and sum(bool(f.error) for f in both) == 1
    lower = b"WARC/1.0\r\nwarc-type: resource\r\ncontent-length: 3\r\nfolded: x\r\n  y\r\n\r\nabc\r\n\r\n"
    (one,) = warc.salvage(lower)
    assert one.payload == b"abc" and one.fields["folded"] == "x y"
    hexed = hashlib.sha1(b"abd").hexdigest().encode()
    (gap,) = warc.salvage(lower.replace(b"folded: x\r\n  y", b"WARC-Block-Digest: sha1:" + hexed))
    assert gap.error == "block digest"
    assert list(warc.salvage(b"")) == [] and [f.error for f in warc.salvage(b"nothing")] == ["no version line"]


def test_gaps_are_logged(spark, tmp_path):
    parts = [packed(r) for r in records(4)]
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "a.warc.gz").write_bytes(parts[0] + parts[1][:-9] + parts[2] + parts[3])
    (tmp_path / "in" / "b.warc.gz").write_bytes(b"")
    found = warc.read_archive(spark, str(tmp_path / "in"), "*.warc.gz")
    warc.log_gaps(found, str(tmp_path / "log"))
    (gap,) = spark.read.json(str(tmp_path / "log")).collect()
    assert (gap["start"], gap["end"]) == (len(parts[0]), len(parts[0]) + len(parts[1]) - 9)
    assert gap["file"].endswith("a.warc.gz") and sorted(r["page_id"] for r in warc.page_records(found).collect()) == [0, 2, 3]
