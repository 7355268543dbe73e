"""Operator 6: exact round trips, validation, and the smallest table against plain Python."""
import hashlib
import base64
import os

import pytest

from fraudflow.llm import catalog, warc

from .conftest import SMALL

PAGE = "page_id long, html string, archive string, digest string, first long"


def pages(spark, rows, parts=2):
    return spark.createDataFrame([(i, h, "a", "b", 3) for i, h in rows], PAGE).repartition(parts)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def trip(df, tmp_path, **kw):
    path = str(tmp_path / "archives")
    warc.write_archives(warc.with_originals(df), **kw).write.parquet(path)
    return warc.read_archives(df.sparkSession.read.parquet(path)).collect()


def test_registered_query(spark):
    got = {r["page_id"]: r for r in catalog.QUERIES["op6_warc"](spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    first = {}
    for r in sorted(rows, key=lambda r: r["page_id"]):
        first.setdefault(r["html"] or "", r["page_id"])
    assert set(got) == {r["page_id"] for r in rows}
    for r in rows:
        html, x = r["html"] or "", got[r["page_id"]]
        again = first[html] != r["page_id"]
        assert (x["payload_bytes"], x["payload_digest"]) == (len(html.encode()), digest(html))
        assert (x["record_type"], x["refers_to"]) == (("revisit", first[html]) if again else ("response", None))


@pytest.mark.parametrize("archive_bytes", [300, 1 << 20])
def test_edge_cases(spark, tmp_path, archive_bytes):
    rows = [(1, None), (2, ""), (3, "<p>ü</p>\r\n\r\nWARC/1.1\r\n"), (4, "x" * 3_000_000), (5, "<p>ü</p>\r\n\r\nWARC/1.1\r\n"),
            (None, "x"), (None, ""), (7, "q"), (7, "q"), (8, "q"), (7, "r")] + [(100 + i, f"<html>{'common ' * 40}{i}</html>") for i in range(60)]
    got = trip(pages(spark, rows, 1), tmp_path, archive_bytes=archive_bytes)
    assert not [r for r in got if r["error"]]
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["record_id"], []).append((r["record_type"], r["refers_to"], bytes(r["payload"])))
    assert by["urn:page:1"] == [("response", None, b"")]
    assert by["urn:page:2"] == [("revisit", "urn:page:1", b"")]
    assert by["urn:page:4"] == [("response", None, b"x" * 3_000_000)]
    assert by["urn:page:5"] == [("revisit", "urn:page:3", b"")]
    assert sorted(by["urn:page:7"]) == [("response", None, b"q")] * 2 + [("response", None, b"r")]
    assert by["urn:page:8"] == [("revisit", "urn:page:7", b"")]
    assert sorted(x[2] for x in by["urn:page:"]) == [b"", b"x"]


def test_small_payloads_stay_responses(spark):
    rows = warc.with_originals(pages(spark, [(1, "ab"), (2, "ab"), (3, "abc"), (4, "abc")]), min_bytes=3).collect()
    assert {r["page_id"]: r["refers_to"] for r in rows} == {1: None, 2: None, 3: None, 4: 3}


def test_empty_table(spark, tmp_path):
    assert trip(pages(spark, []), tmp_path) == []


def test_files_and_damage(spark, tmp_path):
    rows = [(i, f"<html>{'common words ' * 30}{i}</html>") for i in range(100)]
    content = bytes(warc.write_archives(warc.with_originals(pages(spark, rows, 1))).first()["content"])
    trained, at = warc.dictionary(content)
    assert trained and at > 8
    ends = [at]
    while ends[-1] < len(content):
        ends.append(warc.frame_end(content, ends[-1]))
    assert len(ends) == 101
    bad = bytearray(content)
    bad[ends[5] - 5] ^= 0xFF  # a record's data or checksum
    import zstandard
    wrong = zstandard.ZstdCompressor().compress(warc.record("response", "urn:page:1", "u", b"abc").replace(b"Content-Length: 3", b"Content-Length: 4"))
    for name, data in {"good": content, "bad": bytes(bad), "cut": content[: ends[50] + 7], "wrong": wrong, "none": b"", "junk": b"junk" * 9}.items():
        (tmp_path / f"{name}.warc.zst").write_bytes(data)
    files = spark.read.format("binaryFile").load(f"file://{tmp_path}/*.warc.zst")
    out = {}
    for r in warc.read_archives(files, "path").collect():
        out.setdefault(os.path.basename(r["archive"]).split(".")[0], []).append(r["error"])
    assert out["good"] == [None] * 100
    assert sum(e is None for e in out["bad"]) == 99 and len(out["bad"]) == 100
    assert out["cut"][:50] == [None] * 50 and out["cut"][50] and len(out["cut"]) == 51
    assert out["wrong"] == ["length differs from content-length"]
    assert out["junk"] == ["no frame"] and "none" not in out


def test_streamed_and_skippable_frames(spark):
    """Frames that don't state their size, with and without the dictionary, and skippable frames anywhere."""
    import io
    import struct

    import zstandard

    rows = [(i, f"<html>{'common words ' * 30}{i}</html>") for i in range(40)]
    content = bytes(warc.write_archives(warc.with_originals(pages(spark, rows, 1))).first()["content"])
    trained, at = warc.dictionary(content)
    records = [warc.record("response", f"urn:page:{i}", f"page:{i}", b"payload %d" % i * (1 + i * 9000 % 70001)) for i in range(12)]

    def streamed(raw, data=None):
        out = io.BytesIO()
        c = zstandard.ZstdCompressor(dict_data=data, write_content_size=False)
        with c.stream_writer(out, closefd=False) as w:
            for i in range(0, len(raw), 1000):
                w.write(raw[i: i + 1000])
        return out.getvalue()

    skip = lambda kind, data: struct.pack("<II", 0x184D2A50 + kind, len(data)) + data
    plain = [streamed(r) for r in records]
    assert zstandard.frame_content_size(plain[0]) == -1
    with_dict = [streamed(r, zstandard.ZstdCompressionDict(trained)) for r in records]
    archives = {"plain": b"".join(plain), "dictionary": content[:at] + b"".join(with_dict),
                "skips": skip(0, b"note") + b"".join(x + skip(i, b"x" * i) for i, x in enumerate(plain)),
                "cut": plain[0] + skip(3, b"12345")[:-2]}
    got = {}
    for r in warc.read_archives(spark.createDataFrame(list(archives.items()), "archive string, content binary")).collect():
        got.setdefault(r["archive"], []).append((r["record_id"], r["error"]))
    want = [(f"urn:page:{i}", None) for i in range(12)]
    assert got["plain"] == got["dictionary"] == got["skips"] == want
    assert got["cut"][0] == want[0] and len(got["cut"]) == 2 and got["cut"][1][1]


def test_few_records_have_a_dictionary(spark):
    rows = [(i, f"<html>{' '.join(f'word{j * i % 97}' for j in range(400))}</html>") for i in range(4)]
    content = bytes(warc.write_archives(warc.with_originals(pages(spark, rows, 1))).first()["content"])
    assert warc.dictionary(content)[0]
    assert [r["error"] for r in warc.read_archives(spark.createDataFrame([("a", content)], "archive string, content binary")).collect()] == [None] * 4
