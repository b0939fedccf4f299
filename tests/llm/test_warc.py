import base64
import glob
import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tidepool.llm import warc
from tidepool.llm.queries import QUERIES
from tidepool.session import local_path

NASTY = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n\r\n\r\nWARC/1.1\r\n\r\n"
PAGES = [(3, "http://a/ b\r\nX: y", "<p>é</p>"), (1, "http://b", "<p>é</p>"), (2, None, None), (5, "", ""), (7, "http://c", NASTY),
         (8, "http://d", "long " * 60_000), (9, "http://e", NASTY), (9, "http://e", NASTY), (None, "http://f", "x")]


def pages(spark):
    return spark.createDataFrame([p + ("x", "y") for p in PAGES], "page_id long, url string, html string, name string, digest string")


def test_round_trip(spark, workdir):
    warc.write(pages(spark), f"{workdir}/w")
    found = warc.captures(warc.read(spark, f"{workdir}/w", with_payload=True)).collect()
    assert len(found) == len(PAGES)
    first = {r["capture"]: r["metadata"]["page_id"] for r in found}
    for r in found:
        page, response = r["metadata"], r["response"]
        assert response["sound"] and r["request"]["concurrent_to"] == r["capture"] == page["concurrent_to"]
        html = next(h or "" for i, u, h in PAGES if i == page["page_id"] and u == page["url"])
        assert response["payload_bytes"] == len(html.encode())
        assert response["payload_digest"] == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        if response["type"] == "response":
            assert bytes(response["payload"]).decode() == html
    kinds = sorted((str(r["metadata"]["page_id"]), r["response"]["type"], str(first.get(r["response"]["refers_to"]))) for r in found)
    assert kinds == sorted([("1", "response", "None"), ("3", "revisit", "1"), ("2", "response", "None"), ("5", "revisit", "2"),
                            ("7", "response", "None"), ("8", "response", "None"), ("9", "revisit", "7"), ("9", "revisit", "7"),
                            ("None", "response", "None")])


def test_files_are_plain_warc(spark, workdir):
    warc.write(pages(spark), f"{workdir}/w")
    data = b"".join(gzip.open(f).read() for f in sorted(glob.glob(f"{local_path(workdir)}/w/*.gz")))
    at = count = 0
    while at < len(data):
        assert data.startswith(b"WARC/1.1\r\n", at)
        end = data.index(b"\r\n\r\n", at)
        size = int(next(line for line in data[at:end].split(b"\r\n") if line.startswith(b"Content-Length")).split()[1])
        at = end + 4 + size
        assert data[at:at + 4] == b"\r\n\r\n"
        at, count = at + 4, count + 1
    assert count == 3 * len(PAGES)


def test_small_payloads_need_not_be_revisits(spark, workdir):
    warc.write(pages(spark), f"{workdir}/w", least_bytes=5)
    kinds = {r["response"]["type"] for r in warc.captures(warc.read(spark, f"{workdir}/w")).collect() if r["response"]["payload_bytes"] < 5}
    assert kinds == {"response"}


def test_missing_records_and_empty_archives(spark, workdir):
    warc.write(pages(spark), f"{workdir}/w")
    records = warc.read(spark, f"{workdir}/w")
    partial = warc.captures(records.filter("type <> 'metadata'")).collect()
    assert len(partial) == len(PAGES) and all(r["metadata"] is None for r in partial)
    warc.write(pages(spark).limit(0), f"{workdir}/none")
    assert warc.captures(warc.read(spark, f"{workdir}/none")).count() == 0


def test_query_over_edge_rows(spark, workdir):
    pages(spark).select("page_id", "url", "html").write.parquet(f"{workdir}/pages.parquet")
    rows = QUERIES["op2_warc"](spark, workdir).collect()
    assert len(rows) == len(PAGES) and sum(r["record_type"] == "response" for r in rows) == 5
    assert {r["refers_to"] for r in rows if r["record_type"] == "revisit"} == {1, 2, 7}


def records(data):
    """The stored records of an unpacked file, each with its separator."""
    at, out = 0, []
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        size = int(next(line for line in data[at:end].split(b"\r\n") if line.startswith(b"Content-Length")).split()[1])
        out.append(data[at:end + 4 + size + 4])
        at = end + 4 + size + 4
    return out


def test_all_layouts_are_read(spark, workdir):
    """One member a file, one a record, several records a member, plain files, zeros at the end: the same records."""
    warc.write(pages(spark), f"{workdir}/w")
    want = sorted(map(str, warc.read(spark, f"{workdir}/w", with_payload=True).collect()))
    assert len(want) == 3 * len(PAGES)
    parts = [records(gzip.open(f).read()) for f in sorted(glob.glob(f"{local_path(workdir)}/w/*.gz"))]
    layouts = {"each": lambda p: b"".join(gzip.compress(r) for r in p), "pairs": lambda p: b"".join(gzip.compress(b"".join(p[i:i + 2])) for i in range(0, len(p), 2)),
               "zeros": lambda p: gzip.compress(b"".join(p)) + b"\0" * 512, "plain": b"".join}
    for name, stored in layouts.items():
        folder = f"{local_path(workdir)}/{name}"
        os.makedirs(folder)
        for k, part in enumerate(parts):
            with open(f"{folder}/{k}.warc" + ("" if name == "plain" else ".gz"), "wb") as out:
                out.write(stored(part))
        assert sorted(map(str, warc.read(spark, f"{workdir}/{name}", with_payload=True).collect())) == want, name


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 20])
def test_pieces_of_any_size(spark, workdir, monkeypatch, size):
    warc.write(pages(spark).filter("page_id IN (1, 3, 7)").coalesce(1), f"{workdir}/w")
    stored = b"".join(open(f, "rb").read() for f in sorted(glob.glob(f"{local_path(workdir)}/w/*.gz")))
    whole = list(warc.parse(gzip.decompress(stored), True))
    monkeypatch.setattr(warc, "PIECE", size)
    monkeypatch.setattr(warc, "FED", size)
    assert list(warc.parse(warc.unpacked(stored), True)) == whole and len(whole) == 9
    assert list(warc.parse(warc.unpacked(gzip.decompress(stored)), True)) == whole


def test_a_truncated_archive_is_an_error(spark, workdir):
    warc.write(pages(spark).filter("page_id = 1"), f"{workdir}/w")
    data = b"".join(gzip.open(f).read() for f in glob.glob(f"{local_path(workdir)}/w/*.gz"))
    for cut in (data[:-20], data[:30], data[:len(data) - len(records(data)[-1]) + 40]):
        with pytest.raises(ValueError, match="ends inside"):
            list(warc.parse(warc.unpacked(cut)))
        with pytest.raises(ValueError, match="ends inside"):
            list(warc.parse(warc.unpacked(gzip.compress(cut))))
    with pytest.raises(ValueError, match="ends inside a gzip member"):
        list(warc.parse(warc.unpacked(gzip.compress(data)[:-30])))
    assert list(warc.parse(warc.unpacked(b""))) == []


def test_one_of_several_metadata_records_is_taken_by_its_id(spark, workdir):
    warc.write(pages(spark).filter("page_id = 1"), f"{workdir}/w")
    seen = warc.read(spark, f"{workdir}/w")
    more = seen.filter("type = 'metadata'").withColumn("record_id", F.lit("<urn:uuid:zz>")).withColumn("page_id", F.lit(99).cast("long"))
    for both in (seen.unionByName(more), more.unionByName(seen)):
        assert [r["metadata"]["page_id"] for r in warc.captures(both).collect()] == [1]
