"""Derived web archive records: linked metadata and plain-text conversions of responses.

A response gives two records. The metadata record describes it (status, type,
digests, title, links) as JSON; the conversion record holds its readable text as
UTF-8. Both name the response in WARC-Refers-To, keep its URI, date and payload
digest, and carry a block digest of their own. Their ids are hashes of the
response's id and their kind, so a rerun makes the same records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from contextlib import suppress
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import named

VERSION = b"WARC/1.1"
SOFTWARE = "recordflow-derivatives/1"
# Source headers that both derived records repeat.
KEPT_HEADERS = ("WARC-Target-URI", "WARC-Date", "WARC-IP-Address", "WARC-Payload-Digest", "WARC-Identified-Payload-Type")
RECORD = "record_id string, kind string, refers_to string, headers map<string,string>, block binary"

# Elements whose content is never read, and elements that begin a new line.
# A tag without end goes to the end of the page, so that no part of a page is looked through twice.
_opens = re.compile(r"(?is)<!--|<(script|style|noscript|template|svg|head)(?=[\s/>])[^>]*(?:>|\Z)")
_closes = {n: re.compile(rf"(?i)</{n}\s*>") for n in ("script", "style", "noscript", "template", "svg", "title")}
# What a head may hold, up to the content of an element; whatever else follows begins the body.
_heads = re.compile(
    r"(?is)\s+|<!--.*?(?:-->|\Z)|<(?:!doctype|meta|link|base|basefont|bgsound)(?=[\s/>])[^>]*(?:>|\Z)"
    r"|</(?!(?:head|body|html)[\s/>])[a-z][^>]*(?:>|\Z)|<(title|script|style|noscript|template)(?=[\s/>])[^>]*(?:>|\Z)"
)
_head_end = re.compile(r"(?i)</head\s*>")
_title = re.compile(r"(?is)<title(?=[\s/>])[^>]*(?:>|\Z)(?:(.*?)</title\s*>|([^<]*))")
_anchor = re.compile(r"(?i)<a\b[^>]*")
_href = re.compile(r"""(?i)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
# Targets that only need the base's host before them, and those that stand as they are.
_way = r"/(?:[\w%~-][\w.,!%~-]*/)*(?:[\w%~-][\w.,!%~-]*)?(?:\?[\w%=&+-]+)?(?:#[\w-]+)?"
_rooted = re.compile(_way)
_absolute = re.compile(rf"https?://[a-z0-9.-]+(?::\d+)?(?:{_way})?")
_host = re.compile(r"https?://[a-z0-9.-]+(?::\d+)?(?=[/?#]|\Z)")
_break = re.compile(
    r"(?i)</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|tr|table|h[1-6]|article|section|nav|header|footer|main|aside|form|pre|blockquote|option|figure)\b[^>]*(?:>|\Z)"
)
_tag = re.compile(r"(?s)<(?:[a-zA-Z/!?][^>]*(?:>|\Z))")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    """An id that depends on the parts alone."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(31).join(parts))}>"


def _after_head(page: str, at: int, endless: set[str]) -> int:
    """Where the head that begins at a place ends: behind its end tag, or before what begins the body.

    ``endless`` gets the elements for which no end tag follows: the page is searched for it once.
    """
    while (m := _heads.match(page, at)) is not None:
        at = m.end()
        if m[1]:
            name = m[1].lower()
            if name not in endless and (end := _closes[name].search(page, at)) is not None:
                at = end.end()
                continue
            endless.add(name)
            if name == "title":
                at = found if (found := page.find("<", at)) >= 0 else len(page)
    end = _head_end.match(page, at)
    return at if end is None else end.end()


def read_part(page: str) -> str:
    """The page without comments and the content of unread elements.

    A head without end tag ends where the body begins. Of another element without
    end tag only the tag goes, as its content could be the rest of the page.
    """
    kept, at, endless = [], 0, set()
    while (m := _opens.search(page, at)) is not None:
        kept.append(page[at : m.start()])
        name, at = (m[1] or "").lower(), m.end()
        if not name:
            at = found + 3 if (found := page.find("-->", at)) >= 0 else len(page)
        elif name == "head":
            at = _after_head(page, at, endless)
        elif name not in endless and not (name == "svg" and m[0].endswith("/>")):
            end = _closes[name].search(page, at)
            if end is None:  # nor will one follow later: the page is not searched again
                endless.add(name)
            else:
                at = end.end()
    return " ".join([*kept, page[at:]])


def _text_of(part: str) -> str:
    part = _tag.sub("", _break.sub("\n", part))
    lines = (" ".join(line.split()) for line in entities.unescape(part).replace("\r", "\n").split("\n"))
    return "\n".join(filter(None, lines))


def _targets(part: str) -> Iterator[str]:
    """What the first readable href of each anchor says; looked at from left to right, each anchor once."""
    at = 0
    while (m := _anchor.search(part, at)) is not None:
        at = m.end()
        # An href begins within its tag; what it quotes may hold anything.
        found = _href.search(part, m.start() + 2)
        if found is not None and found.start() < m.end():
            at = max(at, found.end())
            yield entities.unescape(found[1] if found[1] is not None else found[2] if found[2] is not None else found[3]).strip()


def _resolved(part: str, base: str) -> list[str]:
    host = _host.match(base)
    out = []
    for target in _targets(part):
        if host is not None and _rooted.fullmatch(target):
            target = host[0] + target
        elif not (host is not None and _absolute.fullmatch(target)):
            with suppress(ValueError):
                target = urljoin(base, target)
        out.append(target)
    return out


def plain_text(page: str) -> str:
    """Readable text of a page: unread elements and tags gone, entities resolved, a line for each block."""
    return _text_of(read_part(page))


def links(page: str, base: str) -> list[str]:
    """Targets of the anchors, resolved against the page; those that cannot be are left as they stand."""
    return _resolved(read_part(page), base)


def written(headers: dict[str, str], block: bytes) -> bytes:
    """A record as it stands in an archive; line ends within a header value become blanks."""
    lines = [VERSION]
    for name, value in headers.items():
        lines.append(f"{name}: {' '.join(value.split())}".encode())
    return b"\r\n".join([*lines, b"Content-Length: " + str(len(block)).encode(), b"", block]) + b"\r\n\r\n"


def _parts(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of a file, unpacked a part at a time where it is gzipped, member by member."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    at, unpack = 0, zlib.decompressobj(wbits=31)
    while at < len(data):
        rest = data[at : at + size]
        at += len(rest)
        while rest:
            with suppress(zlib.error):
                yield unpack.decompress(rest, size)
                rest = unpack.unconsumed_tail if not unpack.eof else unpack.unused_data
                if unpack.eof:
                    unpack = zlib.decompressobj(wbits=31)
                continue
            return  # what follows is no gzip member


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive file, plain or with a gzip member per record. A cut-off end is left out.

    Unpacked bytes are held for one record at a time.
    """
    parts, held, at = _parts(data), b"", 0

    def more() -> bool:
        nonlocal held, at
        part = next(parts, None)
        if part is not None:
            held, at = held[at:] + part if held else part, 0
        return part is not None

    while True:
        begin = held.find(b"WARC/", at)
        if begin < 0:
            at = max(at, len(held) - 4)
            if not more():
                return
            continue
        at = begin
        end = held.find(b"\r\n\r\n", at)
        if end < 0:
            if not more():
                return
            continue
        headers: dict[str, str] = {}
        for line in held[at:end].split(b"\r\n")[1:]:
            name, found, value = line.decode("utf-8", "replace").partition(":")
            if found:
                headers[name.strip()] = value.strip()
        try:
            size = int(headers.get("Content-Length", ""))
        except ValueError:
            at = end + 4
            continue
        if len(held) < end + 4 + size:
            block = [held[end + 4 :]]
            missing = size - len(block[0])
            while missing > 0 and (part := next(parts, None)) is not None:
                block.append(part)
                missing -= len(part)
            if missing > 0:
                return
            whole = b"".join(block)
            held, at = whole[size:], 0
            yield headers, whole[:size]
        else:
            at = end + 4 + size
            yield headers, held[end + 4 : at]


def parse_response(block: bytes) -> tuple[int | None, dict[str, str], bytes]:
    """Status, headers (lower-case names) and payload of an HTTP response; without a status line all is payload."""
    head, found, payload = block.partition(b"\r\n\r\n")
    first, *rest = head.split(b"\r\n")
    if not found or not first.startswith(b"HTTP/"):
        return None, {}, block
    parts = first.split(None, 2)
    status = int(parts[1]) if len(parts) > 1 and parts[1].isdigit() else None
    pairs = (line.decode("latin-1").partition(":") for line in rest)
    return status, {n.strip().lower(): v.strip() for n, f, v in pairs if f}, payload


def derived(headers: dict[str, str], block: bytes) -> list[tuple[str, str, str, dict[str, str], bytes]]:
    """The metadata and conversion record of one response: id, kind, refers-to, headers, block."""
    source, uri = headers.get("WARC-Record-ID", ""), headers.get("WARC-Target-URI", "")
    status, http, payload = parse_response(block)
    declared = re.search(r"charset=\"?([\w.-]+)", http.get("content-type", ""), re.I)
    try:
        page = payload.decode(declared[1] if declared else "utf-8", "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    title, part = _title.search(page), read_part(page)
    text = _text_of(part).encode("utf-8", "replace")
    described = {
        "http_status": status,
        "http_headers": http,
        "title": " ".join(entities.unescape(title[1] or title[2] or "").split()) if title else None,
        "links": _resolved(part, uri),
        "payload_length": len(payload),
        "text_length": len(text),
    }
    kept = {h: headers[h] for h in KEPT_HEADERS if h in headers}
    if "WARC-Payload-Digest" not in kept:
        kept["WARC-Payload-Digest"] = digest(payload)
    out = []
    for kind, content_type, body in (
        ("metadata", "application/json", json.dumps(described, ensure_ascii=False, sort_keys=True).encode()),
        ("conversion", "text/plain; charset=UTF-8", text),
    ):
        own = {
            "WARC-Type": kind,
            "WARC-Record-ID": record_id(source, kind),
            "WARC-Refers-To": source,
            **kept,
            "WARC-Block-Digest": digest(body),
            "Content-Type": content_type,
            "WARC-Creator": SOFTWARE,
        }
        out.append((own["WARC-Record-ID"], kind, source, own, body))
    return out


def read_archives(files: DataFrame) -> DataFrame:
    """Records of archive files read by Spark's ``binaryFile`` source (column ``content``): kind, headers, block.

    A file is one row, so files stay below two gigabytes as stored (the usual archive file has one). A task
    holds a file as it is stored, and unpacks it record by record. Null and empty files have no records.
    """

    def run(batches):
        for batch in batches:
            for data in batch["content"]:
                for headers, block in records_of(data.as_py() or b""):
                    row = {
                        "kind": [headers.get("WARC-Type", "")],
                        "headers": [list(headers.items())],
                        "block": [block],
                    }
                    yield pa.RecordBatch.from_pydict(row, schema=_SOURCE)

    return files.select("content").mapInArrow(run, "kind string, headers map<string,string>, block binary")


_MAP = pa.map_(pa.string(), pa.string())
_SOURCE = pa.schema([("kind", pa.string()), ("headers", _MAP), ("block", pa.binary())])
_DERIVED = pa.schema(
    [("record_id", pa.string()), ("kind", pa.string()), ("refers_to", pa.string()), ("headers", _MAP), ("block", pa.binary())]
)
_WRITTEN = pa.schema([*_DERIVED, ("record", pa.binary())])


def _response(number, uri: str | None, page: str | None, date: str) -> tuple[dict[str, str], bytes]:
    payload = (page or "").encode()
    block, found = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload, digest(payload)
    headers = {
        "WARC-Type": "response",
        "WARC-Record-ID": record_id(str(number), uri or "", found),
        "WARC-Date": date,
        "WARC-Target-URI": uri or "",
        "WARC-Payload-Digest": found,
        "WARC-Block-Digest": digest(block),
        "Content-Type": "application/http; msgtype=response",
    }
    return headers, block


DATE = "2024-01-01T00:00:00Z"


def responses(pages: DataFrame, url: str = "url", body: str = "html", page_id: str = "page_id", date: str = DATE) -> DataFrame:
    """Crawled pages as response records: page_id, kind, headers, block. Null url or body count as empty.

    A record's id comes from page id, url and body, so repeated rows have one id. An empty table gives
    no records. A page of any length is one record; pages stay where they are read.
    """
    rows = named(pages, {"page_id": page_id, "_url": url, "_body": body})

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                t = batch.slice(at, 128)
                made = [_response(*row, date) for row in zip(*(t[c].to_pylist() for c in ("page_id", "_url", "_body")))]
                headers = pa.array([list(h.items()) for h, _ in made], _MAP)
                columns = [t["page_id"], pa.array(["response"] * t.num_rows), headers, pa.array([b for _, b in made], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "kind", "headers", "block"])

    return rows.mapInArrow(run, f"page_id {dict(rows.dtypes)['page_id']}, kind string, headers map<string,string>, block binary")


def _derived_batch(t: pa.RecordBatch, carried: list[str], sources: list[tuple[dict[str, str], bytes]], write: bool) -> pa.RecordBatch:
    """The derived records of a batch's responses, beside the columns carried along."""
    made, of = [], []
    for i, (headers, block) in enumerate(sources):
        for r in derived(headers, block):
            made.append((*r, written(r[3], r[4])) if write else r)
            of.append(i)
    schema = _WRITTEN if write else _DERIVED
    columns = [pa.array(list(c), k.type) for c, k in zip(zip(*made), schema) if k.name != "headers"] if made else [pa.array([], k.type) for k in schema if k.name != "headers"]
    columns.insert(3, pa.array([list(r[3].items()) for r in made], _MAP))
    first = [t[c].take(pa.array(of, pa.int64())) for c in carried]
    return pa.RecordBatch.from_arrays([*first, *columns], [*carried, *schema.names])


def derive_pages(pages: DataFrame, url: str = "url", body: str = "html", page_id: str = "page_id", date: str = DATE) -> DataFrame:
    """What ``derive`` gives for the ``responses`` of pages, and each record as it stands in an archive (``record``),
    in one step: page_id, record_id, kind, refers_to, headers, block, record. The same cases hold as for those."""
    rows = named(pages, {"page_id": page_id, "_url": url, "_body": body})

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                t = batch.slice(at, 128)
                made = [_response(*row, date) for row in zip(*(t[c].to_pylist() for c in ("page_id", "_url", "_body")))]
                yield _derived_batch(t, ["page_id"], made, True)

    return rows.mapInArrow(run, f"page_id {dict(rows.dtypes)['page_id']}, {RECORD}, record binary")


def derive(records: DataFrame, keep: str | None = None) -> DataFrame:
    """Metadata and conversion records of all response records: record_id, kind, refers_to, headers, block.

    ``keep`` names a column of ``records`` to carry along. Records of other kinds are left as
    they are, that is, not derived from. A response without headers or block gives records
    of an empty page; repeated responses give repeated records with equal ids; an
    empty table gives none. No shuffle: each response is derived from on its own.
    """
    carried = [] if keep is None else [keep]
    rows = records.filter(F.lower("kind") == "response").select(*carried, "headers", "block")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                t = batch.slice(at, 128)
                sources = [(dict(h or []), b or b"") for h, b in zip(t["headers"].to_pylist(), t["block"].to_pylist())]
                yield _derived_batch(t, carried, sources, False)

    ddl = RECORD if keep is None else f"`{keep}` {dict(rows.dtypes)[keep]}, {RECORD}"
    return rows.mapInArrow(run, ddl)


def written_records(records: DataFrame, compress: bool = False) -> DataFrame:
    """Adds ``record``: the bytes of each record as it stands in an archive, a gzip member of its own if asked.

    Null headers or blocks count as empty; an empty table stays empty; a record is one value of below two gigabytes.
    """

    def run(batches):
        for t in batches:
            made = [written(dict(h or []), b or b"") for h, b in zip(t["headers"].to_pylist(), t["block"].to_pylist())]
            made = [gzip.compress(x, mtime=0) for x in made] if compress else made
            yield pa.RecordBatch.from_arrays([*t.columns, pa.array(made, pa.binary())], [*t.schema.names, "record"])

    schema = ", ".join(f"`{n}` {k}" for n, k in records.dtypes)
    return records.mapInArrow(run, f"{schema}, record binary")
