from __future__ import annotations

import base64
import gzip
import hashlib
import html
import io
import math
import re
import time
import uuid
import zlib

import duckdb
import numpy as np
import pytest

from chalkline.llm import queries, rabitq, warc

SF = "/root/testdata/sf0.01"


def brute(rows, k=5, every=50):
    fine = {i: [float(np.float32(x)) for x in v] for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, v in fine.items():
        if q % every == 0:
            near = []
            for i, w in fine.items():
                if i != q:
                    dot = na = nb = 0.0
                    for a, b in zip(w, v):
                        dot, na, nb = dot + a * b, na + a * a, nb + b * b
                    near.append((-dot / (math.sqrt(na) * math.sqrt(nb)), i))
            out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("bound", [rabitq.BOUND, 8.0])
def test_recall_and_exact_scores(spark, bound):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(8, 32))
    rows = [(i, (centres[i % 8] + 0.7 * rng.normal(size=32)).tolist()) for i in range(900)]
    rows += [(2000 + i, rows[3][1]) for i in range(60)]  # a hot group of equal vectors
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got, wanted = found(rabitq.nearest(table, bound=bound)), brute(rows)
    assert got.keys() == wanted.keys()
    hits = [len({i for i, _ in got[q]} & {i for i, _ in wanted[q]}) / 5 for q in wanted]
    assert np.mean(hits) >= 0.9
    if bound == 8.0:
        assert got == wanted


def test_very_large_and_small_components(spark):
    rows = [(0, [1e200, 0.0]), (50, [1e-200, 1e-200]), (1, [1e-310, 0.0]), (2, [3.0, 4.0]), (3, [-1e308, 1e308]), (4, [0.0, 0.0]), (5, [float("inf"), 1.0]), (6, [5e-324, 0.0])]
    got = found(rabitq.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    assert [i for i, _ in got[0]] == [1, 6, 50, 2, 3] and [i for i, _ in got[50]] == [2, 0, 1, 6, 3]
    assert [s for _, s in got[0]] == pytest.approx([1, 1, 0.5**0.5, 0.6, -(0.5**0.5)])


def test_a_task_keeps_one_best_list(spark, monkeypatch):
    monkeypatch.setattr(rabitq, "ROW_BLOCK", 16)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(600)] + [(1000 + i, [1.0] * 8) for i in range(20)] + [(50, [1.0] * 8)]
    table = spark.createDataFrame(rows[:50] + rows[51:], "vec_id long, embedding array<float>").coalesce(2)
    written, seen = rabitq.written, []
    monkeypatch.setattr(rabitq, "written", lambda df, label: (seen.append((label, (made := written(df, label)).count())), made)[1])
    assert found(rabitq.nearest(table, bound=8.0)) == brute(rows[:50] + rows[51:])
    assert dict(seen)["codes"] >= 39 and dict(seen)["best"] <= 5 * 13 * 8


def test_estimates_stay_in_their_bounds():
    rng = np.random.default_rng(1)
    rows, queries_ = rng.normal(size=(3000, 64)), rng.normal(size=(40, 64))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    queries_ /= np.linalg.norm(queries_, axis=1)[:, None]
    q = rabitq.quantizer(64, rows[:500])
    near, error = rabitq.estimate(q, rabitq.encode(q, rows), queries_)
    off = near - queries_ @ rows.T
    assert (np.abs(off) <= 3 * error + 1e-6).mean() > 0.99 and abs(off.mean()) < 0.01


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [1.0, None]), (6, [float("inf"), 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (9, [-1.0, 0.0]), (100, [0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found(rabitq.nearest(table))
    assert got == {0: [(1, 1.0), (50, 1.0), (9, -1.0)], 50: [(0, 1.0), (1, 1.0), (9, -1.0)]}
    assert rabitq.nearest(table.limit(0)).count() == 0
    assert rabitq.nearest(spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")).count() == 0
    assert rabitq.nearest(spark.createDataFrame([(1, [1.0]), (2, [1.0])], "vec_id long, embedding array<float>")).count() == 0


def test_queries_in_several_blocks(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(400)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found(rabitq.nearest(table, every=10, bound=8.0, query_block=7)) == brute(rows, every=10)


def test_sql_agrees(spark):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    relation = duck.sql(rabitq.SQL)
    got = queries.op8_nearest_neighbours(spark, SF)
    assert sorted(tuple(r) for r in got.select(relation.columns).collect()) == sorted(relation.fetchall())


PAGE = """<html><head><title> A &amp; B </title><script>var x = "<p>no</p>";</script></head><body><!-- c --><h1>Head</h1>
<p>One<br>two &lt;3 <a href="/x">link</a> <a href='y z'>q</a></p><style>p{}</style><div>three   four</div></body></html>"""


def test_text_of_a_page():
    assert warc.plain_text(PAGE) == "Head\nOne\ntwo <3 link q\nthree four"
    assert warc.plain_text("") == "" and warc.plain_text("a < b and c") == "a < b and c"


def response(body, http="Content-Type: text/html; charset=utf-8", more=()):
    block = f"HTTP/1.1 200 OK\r\n{http}\r\n\r\n".encode() + body
    return [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>"), ("WARC-Date", "2020-01-01T00:00:00Z"), ("WARC-Target-URI", "http://a/"), ("WARC-Payload-Digest", warc.digest(body)), *more, ("Content-Length", str(len(block)))], block


def fields(block):
    return [tuple(line.split(": ", 1)) for line in block.decode().split("\r\n") if line]


def test_derived_records_are_linked():
    headers, block = response(PAGE.encode())
    (meta, info), (text, plain) = warc.derive(headers, block)
    get = warc.header
    assert get(meta, "WARC-Refers-To") == get(text, "WARC-Refers-To") == "<urn:uuid:1>"
    assert get(meta, "WARC-Concurrent-To") == get(text, "WARC-Record-ID") and get(text, "WARC-Concurrent-To") == get(meta, "WARC-Record-ID")
    assert get(text, "Content-Length") == str(len(plain)) and get(text, "WARC-Block-Digest") == warc.digest(plain) and get(text, "WARC-Date") == "2020-01-01T00:00:00Z"
    assert get(text, "WARC-Source-Payload-Digest") == get(meta, "WARC-Payload-Digest") == warc.digest(PAGE.encode())
    found = fields(info)
    assert ("title", "A & B") in found and [v for n, v in found if n == "outlink"] == ["/x", "y z"] and ("payload-digest-holds", "true") in found
    assert ("source-WARC-Target-URI", "http://a/") in found and ("http-Content-Type", "text/html; charset=utf-8") in found
    assert warc.derive(headers, block) == warc.derive(headers, block)
    assert warc.derive([("WARC-Type", "request")], b"") == [] and warc.derive([], b"x") == []


def test_encodings_and_other_types():
    body = "<p>é</p>".encode("iso-8859-1")
    headers, block = response(body, "Content-Type: text/html; charset=iso-8859-1")
    assert warc.derive(headers, block)[1][1].decode() == "é"
    headers, block = response(gzip.compress(b"<p>zip</p>"), "Content-Type: text/html\r\nContent-Encoding: gzip")
    assert warc.derive(headers, block)[1][1] == b"zip"
    headers, block = response(b"4\r\n<p>a\r\n3\r\nbc \r\n0\r\n\r\n", "Content-Type: text/html\r\nTransfer-Encoding: chunked")
    assert warc.derive(headers, block)[1][1] == b"abc"
    headers, block = response(b"\x89PNG", "Content-Type: image/png")
    assert len(warc.derive(headers, block)) == 1 and warc.header(warc.derive(headers, block)[0][0], "WARC-Concurrent-To") is None
    headers, block = response(b"<p>x", "Content-Type: text/html; charset=no-such")
    assert warc.derive(headers, block)[1][1] == b"x"
    headers, block = response(b"not gzip", "Content-Type: text/plain\r\nContent-Encoding: gzip")
    assert warc.derive(headers, block)[1][1] == b"not gzip"
    wrong = [(n, "sha1:AAAA" if n == "WARC-Payload-Digest" else v) for n, v in response(b"x")[0]]
    assert ("payload-digest-holds", "false") in fields(warc.derive(wrong, response(b"x")[1])[0][1])


def test_records_round_trip():
    records = [response(PAGE.encode()), ([("WARC-Type", "metadata"), ("X", "a b"), ("Content-Length", "0")], b"")]
    data = b"".join(warc.record_bytes(h, b) for h, b in records)
    assert list(warc.parse_records(io.BytesIO(data))) == records
    folded = b"WARC/1.0\r\nA: x\r\n  y\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n" + data[:40]
    assert list(warc.parse_records(io.BytesIO(folded))) == [([("A", "x y"), ("Content-Length", "2")], b"hi")]


def test_pages_to_files_and_back(spark, tmp_path):
    rows = [(1, "http://a/", PAGE), (2, None, "<p>x</p>"), (3, "http://c/", None), (None, "http://d/", ""), (1, "http://a/", PAGE)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    made = warc.page_responses(pages)
    derived = warc.derivatives(made)
    assert derived.count() == 2 * len(rows)
    warc.write_warc(derived, f"file://{tmp_path}/out")
    back = warc.read_warc(spark, f"file://{tmp_path}/out")
    plain = lambda df: sorted(([(h["name"], h["value"]) for h in r.headers], bytes(r.block)) for r in df.collect())
    assert plain(back) == plain(derived)
    sources = {[h["value"] for h in r.headers if h["name"] == "WARC-Record-ID"][0] for r in made.collect()}
    assert {[h["value"] for h in r.headers if h["name"] == "WARC-Refers-To"][0] for r in derived.collect()} == sources and len(sources) == 4
    for r in made.collect():
        headers = [(h["name"], h["value"]) for h in r.headers]
        assert warc.digest_holds(warc.header(headers, "WARC-Block-Digest"), bytes(r.block))
    assert warc.derivatives(made.limit(0)).count() == 0
    table = warc.digests(derived)
    assert table.where("warc_type = 'conversion' and content_length = 0").count() == 2 and table.where("record_id is null").count() == 0


def test_null_records(spark):
    table = spark.createDataFrame([(1, None, None), (2, [("WARC-Type", "response")], None)], warc.RECORDS)
    assert [r.key for r in warc.derivatives(table).collect()] == [2, 2]


def expected_text(page):
    """By patterns over the whole page: right for pages whose elements end."""
    silent = re.compile(rf"<({'|'.join(warc.SILENT.split())})\b[^>]*>.*?</\1\s*>|<!--.*?-->|<!\[CDATA\[.*?\]\]>", re.I | re.S)
    breaks = re.compile(rf"</?(?:{'|'.join(warc.BREAKS.split())})\b[^>]*>", re.I)
    text = re.sub(r"</?[A-Za-z!?][^>]*>", "", breaks.sub("\n", silent.sub(" ", page.replace("\n", " "))))
    rows = (re.sub(r"[ \t\r\f\v\xa0]+", " ", row).strip() for row in html.unescape(text).split("\n"))
    return "\n".join(row for row in rows if row)


def test_query_equals_brute_force(spark):
    """Every column of every record of op7, from the pages alone."""
    sha = lambda data: "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
    want = []
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        body = (r.html or "").encode()
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body
        h = hashlib.sha1("\n".join([str(r.page_id), r.url or "", hashlib.sha1(body).hexdigest()]).encode()).hexdigest()
        source = f"<urn:uuid:{h[:8]}-{h[8:12]}-5{h[13:16]}-8{h[17:20]}-{h[20:32]}>"
        meta, text = (f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{source}#{what}').urn}>" for what in ("metadata", "conversion"))
        plain = expected_text(r.html or "").encode()
        payload, hexed = "sha1:" + hashlib.sha1(body).hexdigest(), "sha1:" + hashlib.sha1(block).hexdigest()
        names = [("WARC-Type", "response"), ("WARC-Record-ID", source), ("WARC-Date", "2024-01-01T00:00:00Z"), *([("WARC-Target-URI", r.url)] if r.url is not None else []), ("WARC-Payload-Digest", payload),
                 ("WARC-Block-Digest", hexed), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
        title = re.search(r"<title\b[^>]*>(.*?)</title\s*>", r.html or "", re.I | re.S)
        links = re.findall(r"""<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", r.html or "", re.I)
        one = lambda t: " ".join(html.unescape(t).split())
        fields = [*((f"source-{n}", v) for n, v in names), ("http-status", "HTTP/1.1 200 OK"), ("http-Content-Type", "text/html; charset=utf-8"), ("http-Content-Length", str(len(body))), ("payload-digest", payload),
                  ("block-digest", hexed), ("payload-digest-holds", "true"), ("block-digest-holds", "true"), ("charset", "utf-8"), *([("title", one(re.sub(r"</?[A-Za-z!?][^>]*>", "", title[1])))] if title else []),
                  *(("outlink", one(a or b or c)) for a, b, c in links), ("conversion", text)]
        info = "".join(f"{n}: {' '.join(v.split())}\r\n" for n, v in fields).encode()
        for kind, own, other, data in (("metadata", meta, text, info), ("conversion", text, meta, plain)):
            want.append((r.page_id, kind, own, source, other, r.url, len(data), sha(data), payload, zlib.crc32(data)))
    got = queries.op7_warc_derivatives(spark, SF)
    assert got.columns == ["page_id", "warc_type", "record_id", "refers_to", "concurrent_to", "target_uri", "content_length", "block_digest", "payload_digest", "block_crc32"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("unit", ["<script>", "<!--", "<a ", "<title>", "<![CDATA[", "<p", "<", "<title", "<svg "])
def test_pages_without_ends_take_linear_time(unit):
    for page in (unit * (1_000_000 // len(unit)), unit * (1_000_000 // len(unit)) + ">"):
        began = time.process_time()
        warc.plain_text(page)
        assert warc.title_of(page) is None
        assert len(list(warc.links_of(page))) == 0
        assert time.process_time() - began < 3


def test_elements_without_ends():
    assert warc.plain_text("a<script>b <p>c") == "a" and warc.plain_text("a<!-- b") == "a" and warc.plain_text("a<b") == "a<b"
    assert warc.plain_text("1 < 2 <i>x</i> <header>y</header></script>z") == "1 < 2 x\ny\nz"
    assert list(warc.links_of('<a <a href=1 <a href="2>3"><a name=x><a href=\'4')) == ["1", "2>3", "'4"]


@pytest.mark.parametrize("name", ["idna", "punycode", "undefined", "hex", "rot13", "unicode_escape", "no-such", "ü", "utf-16", "cp037", "x" * 400])
def test_no_charset_ends_the_job(name):
    body = f'<meta charset="{name}">é'.encode() + bytes(range(256))
    for http in ([("Content-Type", f"text/html; charset={name}")], []):
        text, charset = warc.decoded(http, body)
        assert text and charset in (name.lower(), "utf-8")


def test_a_very_long_page():
    page = "<p>word &amp; more</p>\n" * 200_000
    headers, block = response(page.encode())
    (_, _), (_, plain) = warc.derive(headers, block)
    assert plain.decode() == "\n".join(["word & more"] * 200_000)
