"""Archives read back whole, however their files are cut."""

import gzip
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from tidepool.llm import warc as W
from tidepool.llm.queries import QUERIES

DATE = "2024-01-01T00:00:00Z"


def _member(i, payload, kind="response", refers=None):
    return W.record(DATE, f"urn:page:{i}", f"http://x/{i}", kind, refers, len(payload), hashlib.sha1(payload).hexdigest(), payload)


def _scan(data):
    return W.Scan(lambda at, n: data[at : at + n], len(data))


def _payloads(rnd):
    out = [rnd.randbytes(rnd.choice([0, 3, 900, 5_000])) for _ in range(30)]
    out += [b"\x1f\x8b\x08" * 400, gzip.compress(b"WARC/1.0\r\n\r\n"), b"WARC/1.1\r\n\r\n\r\n\r\n"]
    return out + [b"".join(_member(900 + i, rnd.randbytes(300)) for i in range(3))]  # an archive inside


@pytest.mark.parametrize("size", [37, 500, 4_096, 10**9])
def test_every_record_is_owned_by_one_range(size, monkeypatch):
    monkeypatch.setattr(W, "READ_BYTES", 1_000)
    monkeypatch.setattr(W, "PIECE_BYTES", 64)
    payloads = _payloads(random.Random(size))
    data = b"".join(_member(i, p) for i, p in enumerate(payloads))
    found = []
    for start in range(0, len(data), size):
        found += [W.described(head, block) for _, head, block in _scan(data).records(start, min(start + size, len(data)))]
    assert [r["record_id"] for r in found] == [f"urn:page:{i}" for i in range(len(payloads))]
    assert [r["payload"] for r in found] == payloads
    assert all(r["intact"] for r in found)


def test_no_magic_inside_of_a_member():
    for p in _payloads(random.Random(1)):
        assert _member(1, p).find(W.MAGIC, 1) < 0


def test_members_are_plain_gzip():
    text = gzip.decompress(_member(1, b"abc") + _member(2, b"d" * 2000))
    assert text.count(b"WARC/1.1\r\n") == 2
    head, block = W.parse(text)[1]
    assert head["content-length"] == str(len(block)) and block.endswith(b"d" * 2000)


def test_damage_costs_only_its_own_record():
    members = [_member(i, os.urandom(400)) for i in range(5)]
    broken = bytearray(members[2])
    broken[len(broken) // 2] ^= 255
    data = members[0] + members[1] + bytes(broken) + members[3] + members[4][:-9]
    for size in (50, 10**6):
        found = [h["warc-record-id"] for s in range(0, len(data), size) for _, h, _ in _scan(data).records(s, min(s + size, len(data)))]
        assert found == ["<urn:page:0>", "<urn:page:1>", "<urn:page:3>"]


def test_wrong_digest_and_lengths_are_seen():
    good = _member(1, b"x" * 50)
    plain = gzip.decompress(good)
    (_, head, block), = _scan(gzip.compress(plain.replace(b"x" * 50, b"y" * 50))).records(0, len(good) + 99)
    assert W.described(head, block)["intact"] is False
    assert not list(_scan(gzip.compress(plain + b"rest")).records(0, 10**6))
    assert not list(_scan(gzip.compress(b"no archive")).records(0, 10**6))


def test_members_of_several_records():
    whole = gzip.compress(b"".join(gzip.decompress(_member(i, b"p%d" % i)) for i in range(4)))
    assert [b.rpartition(b"\r\n\r\n")[2] for _, _, b in _scan(whole).records(0, len(whole))] == [b"p0", b"p1", b"p2", b"p3"]


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def _brute(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        last = max(same, default=None)
        again = len(data) >= 1000 and last is not None and (i is None or i < last)
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", last if again else None))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/1", "é" * 600), (2, "http://a/\r\nWARC-Type: x", "é" * 600), (3, None, "é" * 600),
    (4, "u", "a" * 999), (5, "u", "a" * 999), (6, "u", "b" * 1000), (7, "u", "b" * 1000),
    (8, "u", None), (9, "", ""), (None, "u", "c" * 2000), (None, "u", "c" * 2000), (10, "u", "d" * 2000), (None, "u", "d" * 2000),
    (11, "u", "e" * 3000), (11, "u", "e" * 3000), (12, "u", "\r\n\r\nWARC/1.1\r\n" * 100),
]


def test_query(spark, tmp):
    _pages(spark, ROWS).write.parquet(str(tmp / "pages.parquet"))
    got = [tuple(r)[:5] for r in QUERIES["op12_warc"](spark, str(tmp)).collect()]
    assert sorted(got, key=str) == _brute(ROWS)


def test_round_trip_of_whole_rows_cut_into_small_ranges(spark, tmp):
    folder = str(tmp / "w")
    W.write(W.with_revisits(_pages(spark, ROWS), "page_id", F.encode("html", "UTF-8")), folder, fileBytes="700")
    assert len(os.listdir(folder)) > 3 and not [x for x in os.listdir(folder) if x.startswith("_")]
    records = W.read(spark, folder, splitBytes="101").where("record_type <> 'warcinfo'").collect()
    assert len(records) == len(ROWS)
    by_id = {r.record_id: r for r in records}
    assert by_id["urn:page:2"].uri == "http://a/%0D%0AWARC-Type:%20x" and by_id["urn:page:3"].uri is None
    assert by_id["urn:page:1"].payload is None and by_id["urn:page:3"].payload.decode() == "é" * 600
    assert all(r.intact for r in records if r.record_type == "response")


def test_append_overwrite_and_empty(spark, tmp):
    folder = str(tmp / "w")
    assert W.read(spark, str(tmp / "none")).count() == 0
    W.write(W.with_revisits(_pages(spark, []), "page_id", F.encode("html", "UTF-8")), folder)
    assert W.read(spark, folder).count() == 0
    few = W.with_revisits(_pages(spark, ROWS[:2]), "page_id", F.encode("html", "UTF-8"))
    W.write(few, folder)
    W.write(few, folder)
    assert W.read(spark, folder).where("record_type <> 'warcinfo'").count() == 4
    few.write.format("warc").mode("overwrite").save(folder)
    assert W.read(spark, folder).where("record_type <> 'warcinfo'").count() == 2


def test_a_failing_task_leaves_nothing(spark, tmp):
    folder = str(tmp / "w")
    rows = W.with_revisits(_pages(spark, ROWS[:6]), "page_id", F.encode("html", "UTF-8"))
    bad = rows.withColumn("payload_digest", F.when(F.col("record_id") == "urn:page:5", "no hex").otherwise(F.col("payload_digest")))
    with pytest.raises(Exception, match="hex"):
        W.write(bad, folder)
    assert W.read(spark, folder).count() == 0
    assert not [x for x in os.listdir(folder)] if os.path.exists(folder) else True
