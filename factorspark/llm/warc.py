"""WARC derivatives: a linked metadata and plain-text conversion record for every response.

Both records refer to the response by its id, address and date, carry its digests on, and name each
other. Ids are name-based UUIDs of the response's id, so a repeated build gives the same records.
Records are rows; ``write`` stores them as WARC files through Spark's text sink, whose line separator
is the end of a WARC record.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorspark.llm.batches import small_batches

SOURCE_DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"

# Elements without readable text, and elements that end a line.
HIDDEN = re.compile(r"<!--|<(script|style|noscript|template|svg)(?=[\s/>]|\Z)", re.I)
HIDDEN_END = {
    name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style", "noscript", "template", "svg")
} | {"": re.compile("-->")}
LINE_TAG = re.compile(
    r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|figcaption|footer|form|h[1-6]|head|header|hr|li|main|nav|"
    r"ol|option|p|pre|section|table|title|td|th|tr|ul)\b",
    re.I,
)
ANY_TAG = re.compile(r"<[a-z/!?]", re.I)
SIGN = re.compile(r"[>\"']")
NAMED_TAG = re.compile(r"<(a|html|title)(?=[\s/>])", re.I)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
TITLE_END = re.compile("</title", re.I)
SUBTAG = re.compile(r"[\w-]+")
CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
SPACES = re.compile(r"\s+")
BLANKS = re.compile(r"[^\S\n]+")
EMPTY_LINES = re.compile(r" ?\n\s*")

# ``fields``: the source record's own header, as the lines of the file
RESPONSE = "key long, record_id string, target_uri string, date string, fields string, block binary"
RECORD = (
    "key long, record_type string, record_id string, refers_to string, refers_to_uri string, refers_to_date string, "
    "concurrent_to string, content_type string, content_length long, block_digest string, source_block_digest string, "
    "source_payload_digest string, block string"
)


def responses(pages: DataFrame, date: str = SOURCE_DATE) -> DataFrame:
    """``pages(page_id, url, html)`` as response records; a null page is an empty payload."""
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    head = F.format_string(
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n", F.length(payload)
    )
    name = F.md5(F.to_json(F.struct("page_id", "url")))
    parts = [F.substring(name, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return pages.select(
        F.col("page_id").alias("key"),
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.lit(None).cast("string").alias("fields"),
        F.concat(F.encode(head, "utf-8"), payload).alias("block"),
    )


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


class _TagEnds:
    """Where tags end: at the first ``>`` outside quoted values, however long these are.

    Tags are asked for from left to right. All of them together take time linear in the page: a sign
    from which no end was reached is never followed again.
    """

    def __init__(self, page: str):
        self.page, self.first = page, -1
        self.endless: set[int] = set()

    def _sign(self, at: int) -> int:
        found = SIGN.search(self.page, at)
        return found.start() if found else len(self.page)

    def end(self, start: int) -> int:
        """The place behind the tag that begins at ``start``; 0 if it has no end."""
        if self.first < start:
            self.first = self._sign(start)
        at, passed = self.first, []
        while at < len(self.page) and at not in self.endless:
            if self.page[at] == ">":
                return at + 1
            passed.append(at)
            closing = self.page.find(self.page[at], at + 1)
            if closing < 0:
                break
            at = self._sign(closing + 1)
        self.endless.update(passed)
        return 0


def without_hidden(page: str) -> str:
    """A space for every comment and hidden element; one without an end reaches to the end of the page.

    Names are whole names, so ``<svg-icon>`` is not hidden, and ``<svg .../>`` has no content.
    """
    parts, at, ends = [], 0, _TagEnds(page)
    while found := HIDDEN.search(page, at):
        parts += (page[at : found.start()], " ")
        name = (found[1] or "").lower()
        own = ends.end(found.start()) if name == "svg" else 0
        if own and page[own - 2] == "/":
            at = own
        else:
            closing = HIDDEN_END[name].search(page, found.end())
            at = closing.end() if closing else len(page)
    return "".join(parts) + page[at:]


def _without_tags(page: str) -> str:
    """A line end for every tag that ends a line, nothing for others; what has no end is text."""
    parts, kept, at, ends = [], 0, 0, _TagEnds(page)
    while found := ANY_TAG.search(page, at):
        start = found.start()
        at = ends.end(start)
        if at:
            parts.append(page[kept:start])
            if LINE_TAG.match(page, start):
                parts.append("\n")
            kept = at
        else:
            at = start + 1
    return "".join(parts) + page[kept:]


def plain_text(page: str) -> str:
    """Readable text: a line per block element, other white space folded, entities resolved."""
    return _readable(without_hidden(page))


def _readable(page: str) -> str:
    page = _without_tags(SPACES.sub(" ", page))
    if "&" in page:
        page = html.unescape(page)
    return EMPTY_LINES.sub("\n", BLANKS.sub(" ", page)).strip()


Fields = list[tuple[str, str]]


def header_fields(lines: list[str]) -> Fields:
    """(name in lower case, value) of every line, in order, repeated names included. A line that begins
    with white space goes on with the field before it."""
    found: Fields = []
    for line in lines:
        if line[:1] in (" ", "\t") and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {line.strip()}")
        elif line.strip():
            name, _, value = line.partition(":")
            found.append((name.strip().lower(), value.strip()))
    return found


def value_of(fields: Fields, name: str) -> str:
    """The last value of a field, or ''."""
    return next((value for key, value in reversed(fields) if key == name), "")


def split_response(block: bytes) -> tuple[str, Fields, bytes]:
    """(status line, header fields, payload) of an HTTP response; a block without an empty line is all
    payload."""
    head, end, payload = block.partition(b"\r\n\r\n")
    if not end or not head.startswith(b"HTTP/"):
        return "", [], block
    status, *lines = head.decode("latin-1").split("\r\n")
    return status, header_fields(lines), payload


def unchunked(payload: bytes) -> bytes:
    """The payload of a chunked transfer, as far as it goes; from the first chunk on that is none, bytes
    stay as they are."""
    parts, at = [], 0
    while True:
        line = payload.find(b"\r\n", at, at + 4096)
        if parts and line < 0 and len(payload) - at < 4096:
            return b"".join(parts)  # cut short in the line of a size
        size = payload[at:line].split(b";")[0].strip() if line >= 0 else b""
        if not size or len(size) > 16 or size.strip(b"0123456789abcdefABCDEF"):
            return b"".join(parts) + payload[at:]
        n = int(size, 16)
        if not n:
            return b"".join(parts)
        parts.append(payload[line + 2 : line + 2 + n])
        at = line + 2 + n + 2
        if at >= len(payload):
            return b"".join(parts)


def uncompressed(payload: bytes, coding: str) -> bytes:
    """The content of a gzip or deflate payload, as far as it can be read; other codings, and payloads
    that are not coded as they say, stay as they are."""
    for name in reversed([part.strip() for part in coding.lower().split(",")]):
        kinds = {"gzip": (31,), "x-gzip": (31,), "deflate": (15, -15)}.get(name, ())
        for kind in kinds:
            reader = zlib.decompressobj(kind)
            parts, sound = [], bool(payload)
            try:
                for at in range(0, len(payload), 1 << 16):
                    parts.append(reader.decompress(payload[at : at + (1 << 16)]))
            except zlib.error:
                sound = any(parts)
            if sound:
                payload = b"".join(parts)
                break
    return payload


def page_facts(page: str) -> tuple[str | None, str | None, list[str]]:
    """(title, language, outlinks) by the tags of a page without its comments and hidden elements; links
    are those of ``a`` in their order. Takes time linear in the page."""
    title = language = None
    links: list[str] = []
    at, ends, untitled = 0, _TagEnds(page), True
    while found := NAMED_TAG.search(page, at):
        at = ends.end(found.start())
        if not at:
            at = found.end()
            continue
        name = found[1].lower()
        if name == "title":
            if untitled:
                untitled = False  # asked once: the first title, if it ends
                closing = TITLE_END.search(page, at)
                title = page[at : closing.start()] if closing else None
            continue
        if name == "html" and language:
            continue
        wanted = "href" if name == "a" else "lang"
        for attribute in ATTRIBUTE.finditer(page, found.end(), at - 1):
            if attribute[1].lower() == wanted:
                value = next((v for v in attribute.groups()[1:] if v is not None), None)
                if wanted == "href" and value is not None:
                    links.append(value)
                elif value and (tag := SUBTAG.match(value.strip())):
                    language = tag[0]
                break
    return title, language, links


def decoded(payload: bytes, fields: Fields) -> tuple[str, str]:
    """(text, character set) by the header, else by the page's own statement, else UTF-8."""
    stated = CHARSET.search(value_of(fields, "content-type")) or CHARSET.search(payload[:1024].decode("latin-1"))
    name = stated[1].lower() if stated else "utf-8"
    try:
        return payload.decode(name, "replace"), name
    except LookupError:
        return payload.decode("utf-8", "replace"), "utf-8"


def _one_line(value: str) -> str:
    return " ".join(value.split())


def derivatives(block: bytes, source: str = "") -> tuple[str, str, str, str]:
    """(metadata, text, block digest, payload digest) of a response.

    ``source`` is the header of its record. The digests that it states are carried on as they are, next
    to whether the bytes agree; else they are taken from the bytes. The payload is that after any
    transfer coding; for text and links its content coding is undone, too."""
    status, fields, payload = split_response(block)
    if "chunked" in value_of(fields, "transfer-encoding").lower():
        payload = unchunked(payload)
    page, charset = decoded(uncompressed(payload, value_of(fields, "content-encoding")), fields)
    page = without_hidden(page)
    text = _readable(page)
    of_record = header_fields(source.splitlines())
    stated = [value_of(of_record, f"warc-{kind}-digest") for kind in ("block", "payload")]
    own = [digest(block), digest(payload)]
    of_block, of_payload = (a or b for a, b in zip(stated, own))
    title, language, links = page_facts(page)
    lines = [f"http-status: {status.split(' ', 2)[1]}"] if status.count(" ") else []
    lines += [f"http-{name}: {_one_line(value)}" for name, value in fields]
    lines += [f"source-{name}: {_one_line(value)}" for name, value in of_record]
    lines += [
        f"source-{kind}-digest-agrees: {str(a == b).lower()}"
        for kind, a, b in zip(("block", "payload"), stated, own)
        if a.lower().startswith("sha1:")
    ]
    lines += [f"charset: {charset}", f"source-block-digest: {of_block}", f"source-payload-digest: {of_payload}"]
    lines += [f"title: {_one_line(html.unescape(title))}"] if title is not None else []
    lines += [f"language: {language}"] if language else []
    lines += [f"text-length: {len(text)}"]
    lines += [f"outlink: {_one_line(html.unescape(link))}" for link in links]
    return "\r\n".join(lines) + "\r\n", text, of_block, of_payload


def derive(records: DataFrame) -> DataFrame:
    """Two records (``RECORD``) per response of ``records`` (``RESPONSE``).

    All header fields of the response go on as ``http-..`` and those of its record as ``source-..`` lines
    of the metadata, repeated ones as often as they occur. Null blocks are empty ones, so their text is empty; null ids, addresses and dates stay null in
    what refers to them; a repeated response gives the same two records again; an empty table gives
    an empty result; other columns are ignored. Bytes outside the character set become U+FFFD.
    """
    names = [column.split()[0] for column in RECORD.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64() if name in ("key", "content_length") else pa.string() for name in names]
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch, out = whole.slice(first, 512), []
                for key, own, uri, date, source, block in zip(*(column.to_pylist() for column in batch.columns)):
                    fields, text, of_block, of_payload = derivatives(block or b"", source or "")
                    ids = [f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{own} {kind}')}>" for kind in ("metadata", "conversion")]
                    for kind, mine, other, content, data in (
                        ("metadata", ids[0], ids[1], "application/warc-fields", fields),
                        ("conversion", ids[1], ids[0], "text/plain; charset=utf-8", text),
                    ):
                        raw = data.encode(errors="replace")
                        out.append(
                            (key, kind, mine, own, uri, date, other, content, len(raw), digest(raw), of_block, of_payload, raw.decode())
                        )
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names)

    return small_batches(records).select("key", "record_id", "target_uri", "date", "fields", "block").mapInArrow(rows, RECORD)


def rendered(date: str) -> Column:
    """A record as the text of a WARC file, without the line ends that close it."""

    def field(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))

    return F.concat(
        F.lit("WARC/1.1\r\n"),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", F.col("record_id")),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", F.col("refers_to_uri")),
        field("WARC-Refers-To", F.col("refers_to")),
        field("WARC-Refers-To-Target-URI", F.col("refers_to_uri")),
        field("WARC-Refers-To-Date", F.col("refers_to_date")),
        field("WARC-Concurrent-To", F.col("concurrent_to")),
        field("WARC-Block-Digest", F.col("block_digest")),
        field("Content-Type", F.col("content_type")),
        field("Content-Length", F.col("content_length").cast("string")),
        F.lit("\r\n"),
        F.col("block"),
    )


def write(records: DataFrame, folder: str, date: str, compression: str = "gzip") -> None:
    """Store records as WARC files, one per task, in a folder that Spark can write."""
    text = records.select(rendered(date).alias("value"))
    text.write.option("lineSep", END).option("compression", compression).text(folder)
