import base64
import glob
import gzip
import hashlib
import html
import os
import time
import zlib
from html.parser import HTMLParser
from itertools import combinations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from factorspark.llm import queries, warc
from factorspark.sources.staging import run_folder, stage
from test_exact import plain_fingerprint, union_find

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
PAGE = (
    '<!DOCTYPE html><html lang="de"><head><title> A &amp;\n B </title><style>p{}</style><script>var x="</p>";</script></head>'
    "<body><!-- no --><h1>Head</h1><p title='a > b'>One <b>two</b>&nbsp;&lt;3</p><a href=\"/x?a=1&amp;b=2\">link</a>"
    "<script>open"
)


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.fixture(scope="module")
def records(spark):
    pages = [(1, "http://a.example/x", PAGE), (2, None, "plain"), (None, "http://b.example/", None), (4, "u", "")]
    pages += [(5, "http://c.example/", "<p>" + "é ü<br>" * 50_000), (1, "http://a.example/x", PAGE)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    return warc.derive(warc.responses(frame.withColumns({"block": F.lit(1), "key": F.lit("x")})))


def test_records_are_linked_and_digested(records):
    rows = records.collect()
    assert len(rows) == 12
    by_id = {r.record_id: r for r in rows}
    assert len(by_id) == 10  # the repeated page gives the same two records again
    for r in rows:
        other = by_id[r.concurrent_to]
        assert other.concurrent_to == r.record_id and other.record_type != r.record_type
        assert other.refers_to == r.refers_to and r.refers_to not in by_id
        assert r.block_digest == sha1(r.block.encode()) and r.content_length == len(r.block.encode())
    first = next(r for r in rows if r.key == 1 and r.record_type == "metadata")
    assert first.source_payload_digest == sha1(PAGE.encode())
    assert "title: A & B\r\n" in first.block and "language: de\r\n" in first.block
    assert "outlink: /x?a=1&b=2\r\n" in first.block and "http-status: 200\r\n" in first.block
    text = next(r for r in rows if r.key == 1 and r.record_type == "conversion")
    assert text.block == "A & B\nHead\nOne two <3\nlink"
    assert {r.block for r in rows if r.record_type == "conversion" and r.key in (None, 4)} == {""}


def test_hostile_markup_is_linear():
    assert warc.plain_text("<!--" * 50_000) == ""
    assert warc.plain_text("<a '" * 20_000) is not None
    assert warc.plain_text("<script>" * 20_000) == ""


def test_long_attributes_are_no_text():
    value = "data:image/png;base64," + "iVBORw0KGgo>" * 9_000
    for quote in "\"'":
        assert warc.plain_text(f"one<img src={quote}{value}{quote}> two<p style={quote}{value}{quote}>three") == "one two\nthree"


def test_tags_without_an_end_are_linear():
    began = time.process_time()
    for page in ("<a '", '<a "', "<a '\"", "<a", "<a '<b \"", "<p title='\"'"):
        assert warc.plain_text(page * 100_000 + "x").endswith("x")
    assert time.process_time() - began < 20


def test_only_hidden_elements_are_hidden():
    assert warc.plain_text("a<svg-icon name='x'></svg-icon> b <template-card>c</template-card><style-guide> d") == "a b c d"
    assert warc.plain_text("a<svg/>b<svg width='1' title='>'/>c<svg><path/>no</svg>d") == "a b c d"
    assert warc.plain_text("a<SVG\n>no</svg >b<script src='x'>no</Script>c<style>no") == "a b c"
    assert warc.plain_text("<svg '</svg>" * 50_000 + "x") == "x"


@pytest.mark.parametrize(
    "page", ["<a " * 20_000, "<title>" * 20_000, "<html " * 20_000, "<a href='" * 20_000, "<a x= " * 20_000 + ">", "<a b=\"'" * 20_000, "x" * 1_000_000]
)
def test_hostile_pages_are_linear(page):
    began = time.process_time()
    warc.derivatives(page.encode())
    assert time.process_time() - began < 1.5


def test_header_fields_and_digests_go_on():
    block = b"HTTP/1.1 200 OK\r\nSet-Cookie: a\r\nSet-Cookie: b\r\nX-Long: one\r\n two\r\n\r\nhi"
    source = f"WARC-IP-Address: 192.0.2.1\r\nWARC-Payload-Digest: {sha1(b'hi')}\r\nWARC-Block-Digest: sha1:OTHER\r\n"
    fields, text, of_block, of_payload = warc.derivatives(block, source)
    lines = fields.split("\r\n")
    assert [x for x in lines if x.startswith("http-set")] == ["http-set-cookie: a", "http-set-cookie: b"]
    assert "http-x-long: one two" in lines and "source-warc-ip-address: 192.0.2.1" in lines
    assert (text, of_block, of_payload) == ("hi", "sha1:OTHER", sha1(b"hi"))
    assert "source-block-digest-agrees: false" in lines and "source-payload-digest-agrees: true" in lines


def test_transfer_and_content_codings_are_undone():
    page = "<title>T</title><p>é " + "body " * 500 + "<a href=/x>y</a>"
    packed = gzip.compress(page.encode())
    chunks = b"".join(f"{len(c):x};ext=1\r\n".encode() + c + b"\r\n" for c in (packed[:7], packed[7:60], packed[60:])) + b"0\r\n\r\n"
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nContent-Encoding: gzip\r\n\r\n"
    fields, text, _, of_payload = warc.derivatives(head + chunks)
    assert text == warc.plain_text(page) and "outlink: /x\r\n" in fields and of_payload == sha1(packed)
    # cut short, or not coded as stated
    assert warc.plain_text(page).startswith(warc.derivatives(head + chunks[:-20])[1][:40])
    assert warc.derivatives(head + chunks[:90])[1].startswith("T\né body")  # as far as it can be read
    assert warc.derivatives(head + b"zz plain")[1] == "zz plain"
    for coding, data in (("deflate", zlib.compress(b"abc")), ("deflate", zlib.compress(b"abc")[2:-4]), ("br", b"abc"), ("gzip", b"abc")):
        assert warc.uncompressed(data, coding) == b"abc"


class _Facts(HTMLParser):
    """Title, language and links by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.language, self.links, self.hidden, self.in_title = None, None, [], 0, False

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "noscript", "template", "svg"):
            self.hidden += 1
        if self.hidden:
            return
        values = dict(reversed(attrs))
        if tag == "a" and values.get("href") is not None:
            self.links.append(values["href"])
        if tag == "html" and not self.language:
            self.language = values.get("lang")
        self.in_title = tag == "title" and self.title is None
        if self.in_title:
            self.title = ""

    def handle_endtag(self, tag):
        if tag in ("script", "style", "noscript", "template", "svg"):
            self.hidden = max(0, self.hidden - 1)
        if tag == "title":
            self.in_title = False

    def handle_data(self, data):
        if self.in_title:
            self.title += data


def _facts(page):
    title, language, links = warc.page_facts(warc.without_hidden(page))
    return html.unescape(title) if title else title, language, [html.unescape(x) for x in links]


def test_facts_of_a_page():
    page = (
        "<!-- <a href=no> --><html class=x LANG='pt-BR'><title a='>'>A &amp; B</title><title>C</title>"
        "<script>'<a href=no>'</script><a title='>' href=\"/1\">a</a><abbr href=no></abbr><a href=/2 href=no>"
        "<a\n HREF = '/3'><a data-href=no><a href=''><svg><a href=no></a></svg><a href=/4"
    )
    assert _facts(page) == ("A & B", "pt-BR", ["/1", "/2", "/3", ""])


@needs_data
def test_facts_of_all_pages(spark):
    for row in spark.read.parquet(f"{DATA}/pages.parquet").collect():
        plain = _Facts()
        plain.feed(row.html or "")
        assert _facts(row.html or "") == (plain.title, plain.language, plain.links)


def test_other_character_sets():
    fields, text, *_ = warc.derivatives(b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\n\r\n<p>caf\xe9")
    assert text == "café" and "charset: latin-1" in fields
    assert warc.derivatives(b"no header \xff")[1] == "no header �"


def test_files_hold_the_records(records, tmp_path):
    warc.write(records, str(tmp_path / "out"), "2024-02-02T00:00:00Z")
    found = []
    for path in glob.glob(str(tmp_path / "out" / "part-*")):
        data = gzip.open(path).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[size : size + 4] == b"\r\n\r\n"
            assert sha1(rest[:size]) == fields["WARC-Block-Digest"]
            found.append((fields["WARC-Record-ID"], fields["WARC-Refers-To"], fields["WARC-Type"]))
            data = rest[size + 4 :]
    assert sorted(found) == sorted((r.record_id, r.refers_to, r.record_type) for r in records.collect())


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.derive(warc.responses(empty)).count() == 0


# queries with SQL


@needs_data
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_its_sql(spark, name):
    found = queries.QUERIES[name](spark, DATA).toPandas()
    with duckdb.connect() as con:
        for table in ("documents", "embeddings"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
        expected = con.execute(queries.SQL[name]).df()
    columns = sorted(expected.columns)
    assert sorted(found.columns) == columns
    one, other = (x[columns].sort_values(columns).reset_index(drop=True) for x in (found, expected))
    assert len(one) == len(other) and (one == other).all().all()


# pipeline


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = [("documents", docs)]
    for name, apply in corpus_pipeline.STAGES:
        found.append((name, stage(apply(spark, found[-1][1], DATA), name)))
    return found


@needs_data
def test_stages_take_effect(stages, spark):
    (_, docs), (_, clean), (_, good), (_, single), (_, mixed), (_, packed) = stages
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "mixture", "packing"]
    assert all(frame.columns == docs.columns for frame in (clean, good, single, mixed))
    assert 0 < good.count() < clean.count() < docs.count()
    # near-duplicates: what stays is the first row of each component, found from all pairs
    prints = {r.doc_id: plain_fingerprint(r.text) for r in good.collect()}
    near = [(a, b) for a, b in combinations(sorted(prints), 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    assert near and {r.doc_id for r in single.collect()} == set(union_find(near, prints).values())
    # the mix: words by source add up to the total
    words = F.size(F.filter(F.split("text", r"[ \t-\r]+"), lambda w: w != ""))
    total = single.agg(F.sum(words)).first()[0]
    assert mixed.agg(F.sum(words)).first()[0] == pytest.approx(total, abs=20)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0
    assert packed.filter("piece = 0").count() == mixed.count()


@needs_data
def test_run_gives_the_rows_of_the_stages(stages, spark):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    before = set(glob.glob(f"{_folder(run_folder(spark))}/shared/*"))
    got = sorted(map(tuple, corpus_pipeline.run(spark, DATA).select(*columns).collect()))
    assert got == sorted(map(tuple, stages[-1][1].select(*columns).collect()))
    # the input of the last stage is left, and what that one stores
    left = {os.path.basename(path).split("-")[0] for path in set(glob.glob(f"{_folder(run_folder(spark))}/shared/*")) - before}
    assert "mixture" in left and not left & {"toxicity", "quality", "near_duplicates", "marked", "links", "sizes"}


def _folder(path):
    return path.removeprefix("file:")


def test_stages_of_messy_and_of_no_documents(spark, messy, no_docs, tmp_path):
    labels = spark.createDataFrame([(k, k % 2, int(k % 7 == 0)) for k in range(100, 140)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (messy, no_docs):
        for name, apply in corpus_pipeline.STAGES:
            out = stage(apply(spark, docs, str(tmp_path)), name)
            if name != "packing":
                assert out.columns == docs.columns
            docs = out
