import glob
import hashlib
import random

import numpy as np
import pytest

from rivulet.llm import warc


def plain_reader(data):
    """Records of one file, one after the other, by their declared lengths."""
    out, at = [], 0
    while at < len(data):
        assert data.startswith(b"WARC/1.0\r\n", at)
        cut = data.index(b"\r\n\r\n", at)
        fields = dict(line.split(b": ", 1) for line in data[at:cut].split(b"\r\n")[1:])
        n = int(fields[b"Content-Length"])
        out.append((fields[b"WARC-Record-ID"].decode()[10:-1], fields[b"WARC-Type"].decode(), data[cut + 4:cut + 4 + n]))
        assert data[cut + 4 + n:cut + 8 + n] == b"\r\n\r\n"
        at = cut + 8 + n
    return out


def forged(rnd):
    """A payload that holds magic, whole records, and headers that point anywhere."""
    inner = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: %d\r\n\r\nabc\r\n\r\n" % rnd.randrange(400)
    return "".join(rnd.choices(["WARC/1.0\r\n", inner.decode(), "<p>text</p>\r\n\r\n", "x" * 300, "é", "WARC/1.0\r\n\r\n"], k=rnd.randrange(12)))


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, record_type string")


@pytest.mark.parametrize("split", ["128m", "2000", "400"])
def test_round_trip_with_forged_payloads(spark, tmp_path, split):
    rnd = random.Random(8)
    rows = [(i, f"http://a/{i} b\r\nc", forged(rnd)) for i in range(60)] + [(100, None, None), (101, "u", ""), (102, "u", "\r\n\r\n" * 50)]
    path = str(tmp_path / "a")
    warc.write(warc.records(pages(spark, rows).coalesce(3)), path)
    kept = [r for f in glob.glob(path + "/part-*") for r in plain_reader(open(f, "rb").read())]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = [(r["record_id"], r["record_type"], bytes(r["payload"])) for r in warc.read(spark, path).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got) == sorted(kept) and len(got) == len(rows)
    texts = {str(i): (h or "").encode() for i, _, h in rows}
    assert all(body == texts[i] for i, kind, body in got if kind == "response")


def test_splits_may_change_after_reading_began(spark, tmp_path):
    rnd = random.Random(4)
    path = str(tmp_path / "a")
    warc.write(warc.records(pages(spark, [(i, "u", forged(rnd) + "y" * 300) for i in range(120)]).coalesce(1)), path)
    kept = sorted((i, kind, body) for f in glob.glob(path + "/part-*") for i, kind, body in plain_reader(open(f, "rb").read()))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
        found = warc.read(spark, path)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        assert sorted((r["record_id"], r["record_type"], bytes(r["payload"])) for r in found.collect()) == kept
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_revisits_and_odd_rows(spark, tmp_path):
    big, other = "b" * 1000, "é" * 600
    rows = [(1, "u", big), (5, "u", big), (3, "u", big), (7, "u", "s" * 999), (8, "u", "s" * 999), (None, "u", other), (2, "u", other), (9, "u", "v" * 2000),
            (9, "u", "v" * 2000), (None, "u", "w" * 1500), (None, "u", "w" * 1500)]
    path = str(tmp_path / "a")
    warc.write(warc.records(pages(spark, rows)), path)
    got = sorted(((r["record_id"], r["record_type"], r["refers_to"], r["digest"]) for r in warc.read(spark, path).collect()), key=str)
    sha = lambda s: hashlib.sha1(s.encode()).hexdigest()
    assert got == sorted([("1", "revisit", "5", sha(big)), ("3", "revisit", "5", sha(big)), ("5", "response", None, sha(big)), ("7", "response", None, sha("s" * 999)),
                          ("8", "response", None, sha("s" * 999)), ("", "revisit", "2", sha(other)), ("2", "response", None, sha(other)),
                          ("9", "response", None, sha("v" * 2000)), ("9", "response", None, sha("v" * 2000)), ("", "response", None, sha("w" * 1500)),
                          ("", "response", None, sha("w" * 1500))], key=str)


def test_very_long_payload_and_no_rows(spark, tmp_path):
    text = ("WARC/1.0\r\n" + "x" * 1000) * 3_000
    warc.write(warc.records(pages(spark, [(1, "u", text), (2, "u", "after")])), str(tmp_path / "a"))
    got = {r["record_id"]: r["payload"].decode() for r in warc.read(spark, str(tmp_path / "a")).collect()}
    assert got == {"1": text, "2": "after"}
    warc.write(warc.records(pages(spark, [(1, "u", "x")]).where("page_id > 1")), str(tmp_path / "b"))
    assert warc.read(spark, str(tmp_path / "b")).count() == 0


def test_pointer_doubling_is_a_walk():
    rnd = np.random.default_rng(1)
    at = np.unique(rnd.integers(1, 5000, 300))
    at[0] = 0
    to = np.where(rnd.random(len(at)) < 0.8, at[np.minimum(np.arange(len(at)) + rnd.integers(1, 5, len(at)), len(at) - 1)], at + 1)
    to = np.where(to <= at, at + 7, to)
    mark, walk, now = warc._reached(at, to, 0), set(), 0
    while now in set(at.tolist()):
        walk.add(now)
        now = int(to[list(at).index(now)])
    assert set(at[mark].tolist()) == walk and warc._leave(at, to)[0] == now


def test_query(agrees):
    agrees("op2_warc")
