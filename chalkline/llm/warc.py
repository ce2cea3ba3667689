"""WARC derivatives: responses to linked metadata and plain-text conversion records.

Every response gives a metadata record (``application/warc-fields``: the source's WARC and HTTP
headers, its digests, title and links) and, if its payload is text, a conversion record (``text/plain``).
Both name the response in WARC-Refers-To and keep its target, date and digests; each names the other
in WARC-Concurrent-To. Ids of derived records come from the source's id alone, so a repeated or retried
run gives the same records.

Records are rows (key, headers, block) between the steps; ``read_warc`` and ``write_warc`` stream
them from and to WARC files, one record in memory at a time. No step shuffles.

Pages are read in one pass from tag to tag, so time grows with a page's length, whatever stands in it. A very long page is one record
in memory, and so is what its content encoding unpacks to. A charset that isn't known, or that no page is written in, is read as UTF-8.
"""

from __future__ import annotations

import base64
import codecs
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import session, ship

Headers = list[tuple[str, str]]
_HEADERS = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
RECORDS = "key long, headers array<struct<name:string,value:string>>, block binary"
TEXT_TYPES = ("text/html", "application/xhtml+xml", "text/plain")
#: Tags that end a line of the text. Fixed values of the HTML standard's flow elements.
BREAKS = "address article aside blockquote br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol option p pre section table td th title tr ul"
#: Elements whose content isn't text.
SILENT = "script style noscript template svg iframe head"
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in [*SILENT.split(), "title"]}
_BREAKS = frozenset(BREAKS.split())
_MARK, _NAME = re.compile(r"<(?=/?[A-Za-z!?])"), re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_OPEN_TITLE, _OPEN_LINK = re.compile(r"<title\b", re.I), re.compile(r"<a\b", re.I)
_HREF, _VALUE = re.compile(r"\bhref\s*=\s*", re.I), re.compile(r"""\"([^"]*)"|'([^']*)'|([^\s>]+)""")
#: Codecs of Python that no page is written in; some of them fail on, or take a square of time for, what they can't read.
_NO_CHARSETS = frozenset("idna punycode undefined unicode_escape raw_unicode_escape mbcs oem".split())
_META_CHARSET = re.compile(rb"""<meta\b[^>]*?charset\s*=\s*["']?([A-Za-z0-9_.:-]+)""", re.I)
_BLANK = re.compile(r"[ \t\r\f\v\xa0]+")


def header(headers: Headers, name: str) -> str | None:
    return next((v for n, v in headers if n.lower() == name.lower()), None)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def digest_holds(label: str | None, data: bytes) -> bool | None:
    """Whether a labelled digest is that of ``data``; None for a missing label or an unknown algorithm."""
    algorithm, _, value = (label or "").partition(":")
    if algorithm.lower() not in ("sha1", "sha256", "md5") or not value:
        return None
    raw = hashlib.new(algorithm.lower(), data).digest()
    return value.upper() in (base64.b32encode(raw).decode(), raw.hex().upper())


def record_bytes(headers: Headers, block: bytes) -> bytes:
    lines = "".join(f"{n}: {v}\r\n" for n, v in headers)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def parse_records(source: BinaryIO | _Lines) -> Iterator[tuple[Headers, bytes]]:
    """Records of an uncompressed stream; folded header lines are joined, a cut last record is left out."""
    while True:
        line = source.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue
        headers: Headers = []
        while (line := source.readline()) not in (b"\r\n", b"\n", b""):
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[:1] in " \t" and headers:
                headers[-1] = (headers[-1][0], f"{headers[-1][1]} {text.strip()}")
            else:
                name, _, value = text.partition(":")
                headers.append((name.strip(), value.strip()))
        length = header(headers, "Content-Length") or ""
        if not length.isdigit():
            continue
        block = source.read(int(length))
        if len(block) < int(length):
            return
        yield headers, block


def split_http(block: bytes) -> tuple[str, Headers, bytes]:
    """Status line, headers and body of an HTTP message; all is body without a status line."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    found = re.search(rb"\r?\n\r?\n", block)
    head, body = (block[: found.start()], block[found.end() :]) if found else (block, b"")
    status, *lines = head.decode("iso-8859-1").splitlines()
    headers: Headers = []
    for line in lines:
        name, _, value = line.partition(":")
        headers.append((name.strip(), value.strip()))
    return status, headers, body


def _unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end > 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            return body if not out else b"".join(out)
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2


def content(http: Headers, body: bytes) -> bytes:
    """The body without transfer and content encodings; as it is where it doesn't follow them."""
    if (header(http, "Transfer-Encoding") or "").lower() == "chunked":
        body = _unchunked(body)
    kind = (header(http, "Content-Encoding") or "").lower()
    try:
        if kind in ("gzip", "x-gzip"):
            return gzip.decompress(body)
        if kind == "deflate":
            return zlib.decompress(body)
    except (OSError, EOFError, zlib.error):
        pass
    return body


def decoded(http: Headers, body: bytes) -> tuple[str, str]:
    """Text and charset: of the HTTP header, else of a meta tag, else UTF-8."""
    found = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", header(http, "Content-Type") or "", re.I)
    meta = None if found else _META_CHARSET.search(body[:4096])
    charset = found[1] if found else meta[1].decode() if meta else "utf-8"
    try:
        if codecs.lookup(charset).name.replace("-", "_") not in _NO_CHARSETS:
            return body.decode(charset, "replace"), charset.lower()
    except (LookupError, UnicodeError):
        pass
    return body.decode("utf-8", "replace"), "utf-8"


def _pieces(page: str) -> Iterator[str]:
    """Text between tags, in one pass: a line break for tags that end a line, a space for what isn't text.

    Silent elements, comments and marked sections without an end go on to the end of the page; a ``<`` that no ``>`` follows is text.
    """
    at = 0
    while mark := _MARK.search(page, at):
        opened = mark.start()
        yield page[at:opened]
        for start, end in (("<!--", "-->"), ("<![CDATA[", "]]>")):
            if page.startswith(start, opened):
                closed = page.find(end, opened + len(start))
                at = len(page) if closed < 0 else closed + len(end)
                yield " "
                break
        else:
            named = _NAME.match(page, opened)
            closed = page.find(">", opened)
            if closed < 0:
                yield page[opened:]
                return
            at = closed + 1
            name = named[2].lower() if named else ""
            if name in _CLOSE and name != "title" and not named[1]:
                end = _CLOSE[name].search(page, at)
                at = end.end() if end else len(page)
                yield " "
            elif name in _BREAKS:
                yield "\n"
    yield page[at:]


def plain_text(page: str) -> str:
    """Text of an HTML page, a line for each block; white space inside lines is one space, blank lines go."""
    text = "".join(_pieces(page.replace("\n", " ")))
    lines = (_BLANK.sub(" ", line).strip() for line in html.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def title_of(page: str) -> str | None:
    """The text of the first title element that has an end."""
    opened = _OPEN_TITLE.search(page)
    start = page.find(">", opened.end()) if opened else -1
    end = _CLOSE["title"].search(page, start + 1) if start >= 0 else None
    return _one_line(html.unescape("".join(p for p in _pieces(page[start + 1 : end.start()]) if p != "\n"))) if end else None


def links_of(page: str) -> Iterator[str]:
    """Targets of the anchors, in order. An anchor without a target ends where its tag does, so that nothing is read twice."""
    at = 0
    while opened := _OPEN_LINK.search(page, at):
        closed = page.find(">", opened.end())
        href = _HREF.search(page, opened.end(), closed if closed >= 0 else len(page))
        value = _VALUE.match(page, href.end()) if href else None
        if value:
            yield _one_line(html.unescape(value[1] or value[2] or value[3] or ""))
        at = value.end() if value else href.end() if href else closed
        if at < 0:
            return


def _one_line(text: str) -> str:
    return " ".join(text.split())


def derive(headers: Headers, block: bytes) -> list[tuple[Headers, bytes]]:
    """The metadata record of a response and, if it is text, the conversion record; nothing for other records."""
    if (header(headers, "WARC-Type") or "").lower() != "response":
        return []
    status, http, body = split_http(block)
    payload = content(http, body)
    kind = (header(http, "Content-Type") or "text/html").split(";")[0].strip().lower()
    source = header(headers, "WARC-Record-ID")
    named = source or digest(block)
    make_id = lambda what: f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{named}#{what}').urn}>"
    meta_id, text_id = make_id("metadata"), make_id("conversion")
    payload_digest = header(headers, "WARC-Payload-Digest") or digest(body)
    block_digest = header(headers, "WARC-Block-Digest") or digest(block)

    def linked(what: str, own: str, other: str | None, content_type: str, data: bytes) -> tuple[Headers, bytes]:
        rest = [("WARC-Refers-To", source), ("WARC-Target-URI", header(headers, "WARC-Target-URI")), ("WARC-Date", header(headers, "WARC-Date")),
                ("WARC-Warcinfo-ID", header(headers, "WARC-Warcinfo-ID")), ("WARC-Concurrent-To", other), ("WARC-Payload-Digest", payload_digest if what == "metadata" else None),
                ("WARC-Source-Payload-Digest", payload_digest if what == "conversion" else None)]
        return [("WARC-Type", what), ("WARC-Record-ID", own), *((n, v) for n, v in rest if v is not None), ("WARC-Block-Digest", digest(data)),
                ("Content-Type", content_type), ("Content-Length", str(len(data)))], data

    fields = [*((f"source-{n}", v) for n, v in headers), ("http-status", status), *((f"http-{n}", v) for n, v in http), ("payload-digest", payload_digest), ("block-digest", block_digest)]
    for name, label, data in (("payload", header(headers, "WARC-Payload-Digest"), body), ("block", header(headers, "WARC-Block-Digest"), block)):
        if (holds := digest_holds(label, data)) is not None:
            fields.append((f"{name}-digest-holds", str(holds).lower()))
    text = None
    if kind in TEXT_TYPES:
        page, charset = decoded(http, payload)
        fields.append(("charset", charset))
        if kind == "text/plain":
            text = page
        else:
            text = plain_text(page)
            title = title_of(page)
            if title is not None:
                fields.append(("title", title))
            fields += [("outlink", target) for target in links_of(page)]
        fields.append(("conversion", text_id))
    data = "".join(f"{n}: {_one_line(v)}\r\n" for n, v in fields).encode("utf-8", "replace")
    out = [linked("metadata", meta_id, text_id if text is not None else None, "application/warc-fields", data)]
    if text is not None:
        out.append(linked("conversion", text_id, meta_id, "text/plain; charset=utf-8", text.encode("utf-8", "replace")))
    return out


def page_responses(pages: DataFrame, *, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows of crawled pages as response records (``RECORDS``), their key the page's id.

    The record's id comes from id, url and content. A null page is an empty payload, and a null url gives
    no target; repeated rows give equal records.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.length(body).cast("string"), F.lit("\r\n\r\n")).cast("binary")
    block = F.concat(http, body)
    h = F.sha1(F.concat_ws("\n", F.col("key").cast("string"), F.coalesce(F.col("url"), F.lit("")), F.sha1(body)).cast("binary"))
    part = lambda a, n: F.substring(h, a, n)
    urn = F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-8"), part(18, 3), F.lit("-"), part(21, 12), F.lit(">"))
    pair = lambda n, v: F.struct(F.lit(n).alias("name"), v.alias("value"))
    listed = [pair("WARC-Type", F.lit("response")), pair("WARC-Record-ID", urn), pair("WARC-Date", F.lit(date)), pair("WARC-Target-URI", F.col("url")),
              pair("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1(body))), pair("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.sha1(block))),
              pair("Content-Type", F.lit("application/http; msgtype=response")), pair("Content-Length", F.length(block).cast("string"))]
    rows = pages.select(pages[id_col].cast("long").alias("key"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    return rows.select("key", F.filter(F.array(*listed), lambda x: x.value.isNotNull()).alias("headers"), block.alias("block"))


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    keys, headers, blocks = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([[{"name": n, "value": v} for n, v in h] for h in headers], _HEADERS), pa.array(blocks, pa.binary())], names=["key", "headers", "block"])


def _flushed(rows: Iterator[tuple], most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2]) + 1000
        if size >= most:
            yield _record_batch(held)
            held, size = [], 0
    if held:
        yield _record_batch(held)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    for key, headers, block in zip(batch.column("key"), batch.column("headers"), batch.column("block")):
        yield key.as_py(), [(h["name"], h["value"]) for h in headers.as_py() or []], block.as_py() or b""


def derivatives(records: DataFrame) -> DataFrame:
    """Derived records (``RECORDS``) of all responses among ``records``; a derived record keeps its source's key.

    Records of other types give none; null headers are a record without type and so none; a null
    block is empty; an empty table gives no rows; other columns are not read.
    """
    ship(session(records))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _flushed((key, h, b) for key, headers, block in _rows(batch) for h, b in derive(headers, block))

    return records.select("key", "headers", "block").mapInArrow(work, RECORDS)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of all WARC files (plain or gzip) under a path, streamed; the key is a record's number in its file."""
    ship(spark)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("path").to_pylist():
                where, place = pafs.FileSystem.from_uri(name)
                with where.open_input_stream(place, compression="gzip" if name.endswith(".gz") else None) as source:
                    yield from _flushed((i, h, b) for i, (h, b) in enumerate(parse_records(_Lines(source))))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    return files.mapInArrow(work, RECORDS)


class _Lines:
    """Buffered lines and blocks of an Arrow stream."""

    def __init__(self, source: pa.NativeFile) -> None:
        self.source, self.held = source, b""

    def _more(self) -> bool:
        got = self.source.read(1 << 20)
        self.held += got
        return bool(got)

    def readline(self) -> bytes:
        at = 0
        while (end := self.held.find(b"\n", at)) < 0:
            at = len(self.held)
            if not self._more():
                end = len(self.held) - 1
                break
        line, self.held = self.held[: end + 1], self.held[end + 1 :]
        return line

    def read(self, n: int) -> bytes:
        parts, missing = [self.held[:n]], n - len(self.held)
        self.held = self.held[n:]
        while missing > 0 and (got := self.source.read(missing)):
            parts.append(got)
            missing -= len(got)
        return b"".join(parts)


def write_warc(records: DataFrame, path: str) -> list[str]:
    """One file for each partition, every record a gzip member of its own; returns the files' names."""
    ship(session(records))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, out, name = TaskContext.get(), None, ""
        for batch in batches:
            for _, headers, block in _rows(batch):
                if out is None:
                    where, base = pafs.FileSystem.from_uri(path)
                    where.create_dir(base, recursive=True)
                    name = f"{base}/part-{context.partitionId():06d}.warc.gz"
                    out = where.open_output_stream(f"{name}.{context.taskAttemptId()}", compression=None)
                out.write(gzip.compress(record_bytes(headers, block), mtime=0))
        if out is not None:
            out.close()
            where.move(f"{name}.{context.taskAttemptId()}", name)
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["name"])

    return sorted(r.name for r in records.select("key", "headers", "block").mapInArrow(work, "name string").collect())


def digests(records: DataFrame) -> DataFrame:
    """(key, warc_type, record_id, refers_to, concurrent_to, target_uri, content_length, block_digest, payload_digest, block_crc32)."""
    value = lambda n: F.get(F.filter("headers", lambda x: x["name"] == n), 0)["value"]
    return records.select("key", value("WARC-Type").alias("warc_type"), value("WARC-Record-ID").alias("record_id"), value("WARC-Refers-To").alias("refers_to"),
                          value("WARC-Concurrent-To").alias("concurrent_to"), value("WARC-Target-URI").alias("target_uri"), value("Content-Length").cast("long").alias("content_length"),
                          value("WARC-Block-Digest").alias("block_digest"), F.coalesce(value("WARC-Payload-Digest"), value("WARC-Source-Payload-Digest")).alias("payload_digest"),
                          F.crc32("block").alias("block_crc32"))
