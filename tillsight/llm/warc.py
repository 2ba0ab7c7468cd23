"""WARC derivatives: linked metadata and plain-text conversion records of responses.

A response becomes two records that point back at it:

* ``metadata``: the capture's facts as ``application/warc-fields`` (HTTP status, title,
  declared language, outlinks, text length);
* ``conversion``: the plain text of an HTML or text payload.

Both carry ``WARC-Refers-To`` (the response's record id), ``WARC-Refers-To-Target-URI``
and ``-Date``, the source's WARC headers that describe the capture, the source's payload
digest as ``WARC-Refers-To-Payload-Digest`` (as stated, else computed; metadata says whether
a stated one is right), and payload and block digests of their own.  Record ids are name-based
on (response id, type), so reruns give the same ids.

Markup is read in one pass, in time proportional to its length whatever it holds.

All work is one map over the responses, in bounded batches, with no shuffle.  Files are
written by Spark's text writer (records are UTF-8), the two line ends that close a record
being its line separator, as plain or gzipped WARC; :func:`read_warc` parses files through ``binaryFile``.

Defined cases: a null payload is empty; a null URI is left out of the headers; a payload
that is neither HTML nor text has no conversion; bytes that are not UTF-8 are decoded by
the declared charset, with replacement (by UTF-8 if it names no character set); equal rows give equal records; unclosed markup
ends with the text; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillsight.llm.common import ship

CRLF = "\r\n"
#: Headers of the capture that derivatives carry over from the response.
CARRIED = ("WARC-Target-URI", "WARC-Date", "WARC-IP-Address", "WARC-Warcinfo-ID",
           "WARC-Identified-Payload-Type")
#: Elements that end a line of text, and elements without readable text.
BLOCKS = set("address article aside blockquote br dd div dl dt fieldset figcaption figure "
             "footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol option p pre section "
             "select table tbody td tfoot th thead title tr ul".split())
#: Elements whose whole content is no readable text.
SKIPPED = ("script", "style", "noscript", "template", "svg")
#: Python codecs that are no character sets of documents.
NO_CHARSETS = {"idna", "punycode", "undefined", "unicode-escape", "raw-unicode-escape", "utf-7"}
# every quantifier is possessive and every match is consumed, so a page is read once
_OPEN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][a-zA-Z0-9]*+))")
_REST = re.compile(
    r"[^>\"'=]*+(?:=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+[^>\"'=]*+|[\"'][^>\"'=]*+)*+>?")
_ATTRIBUTE = re.compile(
    r"([^\s/>=\"'][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>]*+)))?+")
_END = {name: re.compile(rf"</{name}\s*+>", re.I) for name in SKIPPED}
_TITLE_END = re.compile(r"</title", re.I)
_NUMBER = re.compile(r"&#(?:0*+([0-9]{8,}+)|[xX]0*+([0-9a-fA-F]{8,}+));?")
_CHARSET = re.compile(r"charset=[\"']?([\w-]+)", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(parts))}>"


def unescape(text: str) -> str:
    """Character references resolved; numbers beyond Unicode become U+FFFD."""
    return html.unescape(_NUMBER.sub("\ufffd", text))


class Page:
    """What one pass over an HTML document finds: text, title, language and outlinks.

    Unclosed comments, tags, quoted values and skipped elements reach to the end.
    """

    def __init__(self, markup: str):
        self.title: str | None = None
        self.language: str | None = None
        self.outlinks: list[str] = []
        kept, at = [], 0
        while (start := markup.find("<", at)) >= 0:
            kept.append(markup[at:start])
            m = _OPEN.match(markup, start)
            if m is None:
                kept.append("<")
                at = start + 1
            elif m[1] or m[2]:
                close = "-->" if m[1] else ">"
                end = markup.find(close, m.end())
                at = len(markup) if end < 0 else end + len(close)
            else:
                name = m[4].lower()
                at = _REST.match(markup, m.end()).end()
                if not m[3]:
                    self._opened(name, markup, m.end(), at)
                if name in BLOCKS:
                    kept.append("\n")
                elif name in _END and not m[3]:
                    end = _END[name].search(markup, m.end())
                    at = end.end() if end else len(markup)
        kept.append(markup[at:])
        lines = (" ".join(line.split()) for line in unescape("".join(kept)).split("\n"))
        self.text = "\n".join(line for line in lines if line)

    def _opened(self, name: str, markup: str, begin: int, end: int) -> None:
        if name == "title" and self.title is None:
            close = _TITLE_END.search(markup, end)
            self.title = " ".join(unescape(
                markup[end:close.start() if close else len(markup)]).split())
        elif name == "a" and (link := _attribute("href", markup, begin, end)):
            # a field is one line: URLs hold no line ends
            self.outlinks.append("".join(unescape(link).strip().splitlines()))
        elif name == "html" and self.language is None:
            self.language = " ".join((_attribute("lang", markup, begin, end) or "").split()) or None


def _attribute(name: str, markup: str, begin: int, end: int) -> str | None:
    """Value of a tag's first attribute of this name."""
    for m in _ATTRIBUTE.finditer(markup, begin, end):
        if m[1].lower() == name:
            return next((v for v in m.group(2, 3, 4) if v is not None), None)
    return None


def plain_text(markup: str) -> str:
    """Readable lines of an HTML document."""
    return Page(markup).text


def split_head(block: bytes) -> tuple[list[tuple[str, str]], bytes, str]:
    """(headers, body, first line) of a WARC record or an HTTP message."""
    head, _, body = block.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "replace").split(CRLF)
    pairs = [(k.strip(), v.strip()) for k, sep, v in (x.partition(":") for x in lines) if sep]
    return pairs, body, first


def _get(headers, name: str, default: str | None = None) -> str | None:
    return next((v for k, v in headers if k.lower() == name.lower()), default)


def _decode(body: bytes, content_type: str) -> str:
    """The text by its declared character set; by UTF-8 where there is none of that name."""
    m = _CHARSET.search(content_type)
    try:
        name = codecs.lookup(m[1]).name if m else "utf-8"
        return body.decode("utf-8" if name in NO_CHARSETS else name, "replace")
    except (LookupError, ValueError):
        return body.decode("utf-8", "replace")


def derive_records(headers: list[tuple[str, str]], block: bytes) -> Iterator[dict]:
    """The derivative records of one response (its WARC headers and its HTTP block)."""
    http, body, status = split_head(block)
    kind = (_get(http, "Content-Type") or "").lower()
    source = _get(headers, "WARC-Record-ID", "")
    payload = digest(body)
    stated = _get(headers, "WARC-Payload-Digest")
    carried = [(k, v) for k in CARRIED if (v := _get(headers, k)) is not None]
    linked = [("WARC-Refers-To", source)]
    for name in ("Target-URI", "Date"):
        if (v := _get(headers, f"WARC-{name}")) is not None:
            linked.append((f"WARC-Refers-To-{name}", v))
    markup = _decode(body, kind) if "html" in kind or kind.startswith("text/") else None
    page = Page(markup) if markup is not None and "html" in kind else None
    text = page.text if page else markup

    facts = [("source-status", status), ("source-payload-digest", payload),
             ("source-digest-valid", "unstated" if stated is None
              else str(stated == payload).lower()),
             *((f"source-{k.lower()}", v) for k, v in http)]
    if page:
        facts += [(k, v) for k, v in (("title", page.title), ("language", page.language))
                  if v is not None]
        facts += [("outlink", x) for x in page.outlinks]
    if text is not None:
        facts += [("text-bytes", str(len(text.encode("utf-8", "replace")))),
                  ("text-words", str(len(text.split())))]
    parts = [("metadata", "application/warc-fields",
              "".join(f"{k}: {v}{CRLF}" for k, v in facts))]
    if text is not None:
        parts.append(("conversion", "text/plain; charset=UTF-8", text))
    for record_type, content_type, content in parts:
        data = content.encode("utf-8", "replace")
        mine = [("WARC-Type", record_type), ("WARC-Record-ID", record_id(source, record_type)),
                *linked, *carried, ("WARC-Refers-To-Payload-Digest", stated or payload),
                # the payload of these records is their block
                ("WARC-Payload-Digest", digest(data)), ("WARC-Block-Digest", digest(data)), ("Content-Type", content_type),
                ("Content-Length", str(len(data)))]
        yield {"record_type": record_type, "headers": mine, "block": data.decode(),
               "source_payload_digest": payload, "n_words": len(content.split())}


_HEADERS = pa.list_(pa.struct([("k", pa.string()), ("v", pa.string())]))
OUT = ("record_type string, record_id string, refers_to string, target_uri string, "
       "headers array<struct<k:string,v:string>>, block string, content_length long, "
       "block_digest string, source_payload_digest string, n_words long")


def _derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part, key, rows = batch.slice(at, 256), [], []
            for i, (head, block) in enumerate(zip(
                    part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)):
                got = list(derive_records([(x["k"], x["v"]) for x in head or []], block or b""))
                rows += got
                key += [i] * len(got)
            field = lambda name: pa.array([_get(r["headers"], name) for r in rows], pa.string())  # noqa: B023, E731
            yield pa.record_batch({
                part.schema.names[0]: part.column(0).take(pa.array(key, pa.int64())),
                "record_type": pa.array([r["record_type"] for r in rows], pa.string()),
                "record_id": field("WARC-Record-ID"), "refers_to": field("WARC-Refers-To"),
                "target_uri": field("WARC-Target-URI"),
                "headers": pa.array([[{"k": k, "v": v} for k, v in r["headers"]]
                                     for r in rows], _HEADERS),
                "block": pa.array([r["block"] for r in rows], pa.string()),
                "content_length": pa.array([len(r["block"].encode()) for r in rows], pa.int64()),
                "block_digest": field("WARC-Block-Digest"),
                "source_payload_digest": pa.array(
                    [r["source_payload_digest"] for r in rows], pa.string()),
                "n_words": pa.array([r["n_words"] for r in rows], pa.int64())})


def derive(responses: DataFrame, key: str) -> DataFrame:
    """Derivative records of ``responses`` (``key``, ``headers`` array of name/value
    structs, ``block`` binary: the HTTP message)."""
    ship(responses.sparkSession)
    kind = responses.schema[key].dataType.simpleString()
    return responses.select(key, "headers", "block") \
        .mapInArrow(_derive, f"`{key}` {kind}, {OUT}")


def page_responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """The pages table (page_id, url, html) as response records."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    http = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}")
    sha = F.sha1(F.concat_ws("|", F.col("page_id").cast("string"), "url"))
    piece = lambda a, n: F.substring(sha, a, n)
    name = F.concat(F.lit("<urn:uuid:"), F.concat_ws(
        "-", piece(1, 8), piece(9, 4), F.concat(F.lit("5"), piece(14, 3)),
        F.concat(F.lit("8"), piece(18, 3)), piece(21, 12)), F.lit(">"))
    header = lambda k, v: F.struct(F.lit(k).alias("k"), v.alias("v"))
    headers = F.filter(F.array(
        header("WARC-Type", F.lit("response")), header("WARC-Record-ID", name),
        header("WARC-Target-URI", F.col("url")), header("WARC-Date", F.lit(date)),
        header("Content-Type", F.lit("application/http; msgtype=response"))),
        lambda x: x["v"].isNotNull())
    return pages.select("page_id", headers.alias("headers"),
                        F.concat(http.cast("binary"), body).alias("block"))


def parse_warc(data: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """(headers, block) of the records of an uncompressed WARC file."""
    at = 0
    while True:
        while data[at:at + 2] == b"\r\n":
            at += 2
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        headers, _, _ = split_head(data[at:end + 4])
        size = int(_get(headers, "Content-Length", "0"))
        yield headers, data[end + 4:end + 4 + size]
        at = end + 4 + size


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files (one file per task): file, headers, block.  Split crawls
    into files that fit a task, as WARC tools do (about 1 GB)."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip
        for batch in batches:
            for name, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                for headers, block in parse_warc(data):
                    yield pa.record_batch({
                        "file": pa.array([name], pa.string()),
                        "headers": pa.array([[{"k": k, "v": v} for k, v in headers]], _HEADERS),
                        "block": pa.array([block], pa.binary())})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(
        run, "file string, headers array<struct<k:string,v:string>>, block binary")


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """Write records (``headers``, ``block``: text) as WARC files, one per partition."""
    lines = F.array_join(F.transform(
        "headers", lambda x: F.concat(x["k"], F.lit(": "), x["v"])), CRLF)
    text = F.concat(F.lit("WARC/1.1" + CRLF), lines, F.lit(CRLF * 2), F.col("block"))
    records.select(text.alias("value")).write.mode("overwrite") \
        .option("lineSep", CRLF * 2).option("compression", compression).text(path)
