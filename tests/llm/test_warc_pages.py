"""WARC derivatives of hostile, foreign and fully described records."""

import time

import pytest

from tillsight.llm import warc

HTML = "text/html"


def records(body, kind=HTML, headers=()):
    block = f"HTTP/1.1 200 OK\r\nContent-Type: {kind}\r\n\r\n".encode() + body
    got = warc.derive_records([("WARC-Record-ID", "<urn:x>"), *headers], block)
    return {r["record_type"]: r for r in got}


def fields(record):
    return [tuple(x.split(": ", 1)) for x in record["block"].split("\r\n") if x]


@pytest.mark.parametrize("unit", [
    "<a ", '<a "', "<a href='", "<a href=\"x", "<a =", "<a a", "<!--", "<!", "<script>", "<title>",
    "<html lang=", "</script ", "<a " + " " * 40, "&#1", "&#", "<", "<a href=x\"", "='\"", "&#9"])
def test_time_grows_with_the_page(unit):
    def seconds(n):
        page = "<a " + unit * (n // len(unit)) + '"'
        begin = time.process_time()
        warc.Page(page)
        return time.process_time() - begin
    seconds(1000)
    # quadratic scanners took 13 s for 24 KB
    assert seconds(1_000_000) < 4


def test_one_pass_finds_title_language_and_links():
    page = warc.Page(
        "<!-- <title>no</title><a href=no> --><HTML data-lang=no LANG = 'pt-BR'><Title a='>'>A &lt; "
        "B</TITLE><script><a href=no></script><a data-href=no HREF=' /x?a=1&amp;b=2\n'>1</a>"
        "<a title='href=no' href=/y>2 < 3</a><a name=z>4<a href>5<p don't>6</p><a href=\"/z")
    assert (page.title, page.language) == ("A < B", "pt-BR")
    assert page.outlinks == ["/x?a=1&b=2", "/y", "/z"]
    assert page.text == "A < B\n12 < 345\n6"
    assert warc.plain_text("x<b title='never closed") == "x"
    assert warc.plain_text("&#65;&#0000000066;&#" + "9" * 9000 + ";") == "AB\ufffd"


@pytest.mark.parametrize("charset", ["idna", "undefined", "utf-7", "punycode", "base64", "é", "no-such",
                                     "unicode_escape", "utf-16", "koi8-r"])
def test_any_declared_charset(charset):
    got = records("Привет +2AA-".encode("koi8-r" if charset == "koi8-r" else "utf-8"),
                  f"text/html; charset={charset}")
    assert set(got) == {"metadata", "conversion"}
    if charset != "utf-16":
        assert got["conversion"]["block"].startswith("Привет")


def test_stated_digests_and_capture_headers():
    body = b"<p>one</p>"
    described = [("WARC-Payload-Digest", warc.digest(body)), ("WARC-IP-Address", "192.0.2.1"),
                 ("WARC-Warcinfo-ID", "<urn:info>"), ("WARC-Date", "2024-01-01T00:00:00Z")]
    for r in records(body, headers=described).values():
        h = dict(r["headers"])
        assert h["WARC-Refers-To"] == "<urn:x>" and h["WARC-IP-Address"] == "192.0.2.1"
        assert h["WARC-Warcinfo-ID"] == "<urn:info>"
        assert h["WARC-Refers-To-Date"] == h["WARC-Date"] == "2024-01-01T00:00:00Z"
        assert h["WARC-Refers-To-Payload-Digest"] == warc.digest(body)
        assert h["WARC-Payload-Digest"] == warc.digest(r["block"].encode())
    valid = lambda d: dict(fields(records(body, headers=d)["metadata"]))["source-digest-valid"]
    assert valid(described) == "true" and valid([]) == "unstated"
    assert valid([("WARC-Payload-Digest", "sha1:OTHER")]) == "false"
    assert set(records(b"\x89PNG", "image/png")) == {"metadata"}
