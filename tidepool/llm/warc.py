"""WARC archives: writing captures, reading records back, assembling transactions.

A capture is three records: request, response (or revisit) and metadata. Request and
metadata name the response's record id in WARC-Concurrent-To. A payload that occurs
more than once is stored once: the capture with the smallest id is the response, the
others are revisits that refer to it and keep the HTTP headers only.

Writing: Spark's text writer, one record per row, with the record separator (two line
ends) as line separator, gzipped. Files hold about ``FILE_BYTES`` of payload. Works on any
file system that Spark can write. Reading: gzip files of one or many members, and plain
files, are unpacked piece by piece and parsed record by record by Content-Length, so
payloads may contain anything, record headers included; a task holds a file as it is
stored and one record. A file that ends inside a member or a record is an error. Assembly is
one grouping by the response's record id; payloads are left out of it unless asked for.

Defined results: a null or empty payload has 0 bytes and the digest of nothing; a null id or
URL is left out of the archive and comes back null; line ends and blanks in a URL are
percent-encoded in the record header; rows that repeat id and payload are captures of
their own, of which the first is the response and the rest revisit it; ids sort
smallest first, null last; an empty table gives an archive without records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import written

FILE_BYTES = 16 << 20
END = "\r\n"
#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: every five hex digits are four base-32 digits."""
    sha = F.sha1(payload)
    fours = [F.lpad(F.conv(F.substring(sha, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*fours), *EMPTY_BASE32)


def _urn(kind: str, capture: Column) -> Column:
    h = F.md5(F.concat(F.lit(kind), capture).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _record(kind: str | Column, record_id: Column, block: Column, *headers: tuple[str, Column | str]) -> Column:
    """A record as text, without the separator after it. Headers whose value is null are left out."""
    lines = [(VERSION, None), ("WARC-Type", kind), ("WARC-Record-ID", record_id), *headers, ("Content-Length", F.octet_length(block))]
    text = [F.lit(name) if value is None else F.concat(F.lit(f"{name}: "), (F.lit(value) if isinstance(value, str) else value).cast("string"))
            for name, value in lines]
    return F.concat(F.concat_ws(END, *text), F.lit(END * 2), block)


def write(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
          least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write an archive of all rows to ``path``. Payloads of fewer than ``least_bytes`` bytes are never revisits."""
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = (rows.withColumn("digest", base32_sha1(F.col("payload").cast("binary")))
            .withColumn("bytes", F.octet_length("payload").cast("long"))
            .withColumn("name", F.coalesce(F.col("id").cast("string"), F.lit("null"))))
    narrow = written(rows.groupBy("id", "name", "digest", "bytes").agg(F.count("*").alias("copies")), "digests")
    firsts = written(narrow.filter(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.min("id").alias("first")), "firsts")
    known = (narrow.select("name", "digest").join(firsts, "digest")
             .select(F.col("name").alias("n"), F.col("digest").alias("d"), F.coalesce(F.col("first").cast("string"), F.lit("null")).alias("first")))
    total = narrow.agg(F.sum(F.col("bytes") * F.col("copies"))).first()[0] or 0
    files = max(1, -(-total // FILE_BYTES))
    dealt = rows.repartition(files, "name", "digest")
    joined = dealt.join(known.hint("merge"), (F.col("name") == F.col("n")) & (F.col("digest") == F.col("d")), "left")
    copy = F.row_number().over(Window.partitionBy("name", "digest").orderBy("url"))
    capture = F.concat_ws("/", "name", "digest", "copy")
    whole = joined.withColumn("copy", copy).withColumn("again", F.coalesce((F.col("first") != F.col("name")) | (F.col("copy") > 1), F.lit(False)))
    original = F.concat_ws("/", "first", "digest", F.lit(1))
    response = _urn("response/", capture)
    target = F.regexp_replace(F.regexp_replace("url", "[\\x00-\\x20\\x7F]", "%20"), "^$", "about:blank")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("bytes").cast("string"), F.lit(END * 2))
    asked = F.concat(F.lit("GET "), F.coalesce(target, F.lit("/")), F.lit(f" HTTP/1.1{END * 2}"))
    noted = F.concat_ws(END, F.concat(F.lit("page-id: "), F.col("id").cast("string")),
                        F.concat(F.lit("url: "), F.base64(F.col("url").cast("binary"))), F.lit(""))
    common = [("WARC-Date", date), ("WARC-Target-URI", target)]
    records = F.array(
        _record("request", _urn("request/", capture), asked, *common, ("WARC-Concurrent-To", response),
                ("Content-Type", "application/http;msgtype=request")),
        _record(F.when(F.col("again"), "revisit").otherwise("response"), response,
                F.when(F.col("again"), http).otherwise(F.concat(http, "payload")), *common,
                ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
                ("WARC-Refers-To", F.when(F.col("again"), _urn("response/", original))),
                ("WARC-Profile", F.when(F.col("again"), F.lit(PROFILE))),
                ("Content-Type", "application/http;msgtype=response")),
        _record("metadata", _urn("metadata/", capture), noted, *common, ("WARC-Concurrent-To", response),
                ("Content-Type", "application/warc-fields")))
    whole.select(F.explode(records).alias("value")).write.option("lineSep", END * 2).option("compression", "gzip").text(path)


RECORD = ("type string, record_id string, concurrent_to string, refers_to string, target string, "
          "payload_bytes long, payload_digest string, sound boolean, page_id long, url string")


#: Records that a task hands on at once.
READ_ROWS = 200
#: Bytes that come out of a file at once, and bytes of a gzip member that go in.
PIECE, FED = 1 << 20, 1 << 14


def unpacked(content: bytes) -> Iterator[bytes]:
    """The bytes of a stored file, in pieces: all members of a gzip file, or a plain file as it is."""
    if not content.startswith(b"\x1f\x8b"):
        yield from (content[at:at + PIECE] for at in range(0, len(content), PIECE))
        return
    at, stored = 0, memoryview(content)
    while at < len(content):
        if content[at] == 0 and not content[at:].strip(b"\0"):   # members may be followed by zeros
            return
        member = zlib.decompressobj(31)
        while not member.eof:
            piece = stored[at:at + FED]
            if not len(piece):
                raise ValueError("the archive ends inside a gzip member")
            yield member.decompress(piece, PIECE)
            while member.unconsumed_tail and not member.eof:
                yield member.decompress(member.unconsumed_tail, PIECE)
            at += len(piece) - len(member.unused_data)


def _fields(block: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in block.decode("utf-8", "replace").split(END))
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _records(pieces: Iterable[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """(header lines, block) of every record."""
    held, at = bytearray(), 0
    more = iter(pieces)

    def grow() -> bool:
        nonlocal held, at
        piece = next(more, None)
        if piece is None:
            return False
        held, at = held[at:] + piece, 0
        return True

    while True:
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            if not grow():
                if held[at:].strip():
                    raise ValueError("the archive ends inside a record's header")
                return
        top = bytes(held[at:end])
        size = int(_fields(top)["content-length"])
        length = end - at + 4 + size
        while len(held) - at < length:
            if not grow():
                raise ValueError(f"the archive ends inside a record of {size} bytes")
        block = bytes(held[at + length - size:at + length])
        at += length
        while len(held) - at < 4 and grow():
            pass
        if held[at:at + 4] == b"\r\n\r\n":
            at += 4
        yield top, block


def parse(data: bytes | Iterable[bytes], with_payload: bool = False) -> Iterator[tuple]:
    """The records of an unpacked archive file (whole or in pieces), in order, as ``RECORD`` (and payload) tuples."""
    for top, block in _records([data] if isinstance(data, bytes) else data):
        head = _fields(top)
        kind, digest, count, sound, page, url, body = head["warc-type"], head.get("warc-payload-digest", "").removeprefix("sha1:") or None, None, True, None, None, None
        if kind in ("response", "revisit"):
            top = block.find(b"\r\n\r\n")
            count = int(_fields(block[:top])["content-length"])
            if kind == "response":
                body = block[top + 4:]
                sound = count == len(body) and digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        elif kind == "metadata":
            own = _fields(block)
            page, url = own.get("page-id"), own.get("url")
            page = int(page) if page else None
            url = base64.b64decode(url).decode() if url is not None else None
        row = (kind, head["warc-record-id"], head.get("warc-concurrent-to"), head.get("warc-refers-to"), head.get("warc-target-uri"),
               count, digest, sound, page, url)
        yield row + ((body,) if with_payload else ())


def read(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row per record of all files under ``path``."""
    schema = RECORD + ", payload binary" * with_payload
    names = [c.split()[0] for c in schema.split(", ")]

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = parse(unpacked(content), with_payload)
                while found := list(islice(rows, READ_ROWS)):
                    yield pd.DataFrame(found, columns=names).astype({"payload_bytes": "Int64", "page_id": "Int64", "sound": "boolean"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{gz,warc}").load(path).select("content")
    return files.mapInPandas(records, schema)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture (the response's record id), request, response, metadata.

    Request and metadata records meet their response or revisit through the
    concurrent-to identifier. A record that is missing leaves its struct null; of several
    of a kind that with the smallest record id is taken.
    """
    own = F.struct(*records.columns)
    of = lambda *kinds: F.min_by(own, F.when(F.col("type").isin(*kinds), F.col("record_id")))
    return (records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture"))
            .agg(of("request").alias("request"), of("response", "revisit").alias("response"), of("metadata").alias("metadata")))
