"""WARC derivatives: metadata and plain-text conversion records of response records.

``responses`` makes response records of a table of pages; ``derivatives`` turns
each response into two linked records: a ``metadata`` record (JSON with the
title, the links, the source's headers and digests) and a ``conversion`` record
(the page's visible text). Both carry ``WARC-Refers-To`` with the response's
identifier, its target and date, a digest of their own block, and in
``WARC-Source-Payload-Digest`` that of the source. Identifiers are name-based
(version 5 UUIDs of the source identifier and the record type), so that a task
that is run again writes the same records. ``record_bytes`` lays a record out as
in a file.

Cases: a null payload is empty and still gives both records; a null target is
left out of the headers and links stay as written; repeated rows give repeated
records; null headers count as none; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slim
from .html_text import Rules, attributes, layout, tokens

_BREAKS = re.compile(r"[\r\n]+")
_CANDIDATE = re.compile(r"[ \t\n\f\r,]*([^ \t\n\f\r]+)")
#: Elements with links and the attributes that hold them.
LINKS = {"a": ("href",), "area": ("href",), "link": ("href",), "img": ("src",), "script": ("src",), "iframe": ("src",), "embed": ("src",), "source": ("src",), "video": ("src", "poster"), "audio": ("src",), "form": ("action",)}
SCHEMA = "record_type string, record_id string, refers_to string, linked_id string, target_uri string, warc_date string, content_type string, content_length long, block_digest string, source_payload_digest string, source_headers string, warc_headers string, block string"


def digest(block: bytes) -> str:
    """A labelled digest as WARC headers have it: SHA-1 in base 32."""
    return "sha1:" + base64.b32encode(hashlib.sha1(block, usedforsecurity=False).digest()).decode()


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date_col: str | None = None, status_col: str | None = None, date: str = "2024-01-01T00:00:00Z", status: str = "200 OK") -> DataFrame:
    """Response records of pages: (id, record_id, target_uri, warc_date, http_headers, payload).

    Date and status line come from ``date_col`` and ``status_col`` where given and not null.
    """
    rows = slim(pages, *dict.fromkeys(c for c in (id_col, url_col, html_col, date_col, status_col) if c))
    given = lambda c, other: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(other)) if c else F.lit(other)
    at, line = given(date_col, date), given(status_col, status)
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    headers = F.concat(F.lit("HTTP/1.1 "), line, F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    name = [F.col(f"`{id_col}`").cast("string"), F.col(f"`{url_col}`"), at, line, F.sha2(F.col(f"`{html_col}`"), 256)]
    return rows.select(F.col(f"`{id_col}`"), _record_id(*name).alias("record_id"), F.col(f"`{url_col}`").alias("target_uri"), at.alias("warc_date"), headers.alias("http_headers"), html.alias("payload"))


def _record_id(*parts: Column) -> Column:
    """A version 5 UUID of the parts, each with its length or a mark of null."""
    marked = [F.when(p.isNull(), "-").otherwise(F.concat(F.length(p).cast("string"), F.lit(":"), p)) for p in parts]
    h = F.sha1(F.concat_ws(" ", F.lit("response"), *marked))
    # the variant's two bits are 10, so its digit is one of 8, 9, a, b
    variant = F.substring(F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab" * 4), 1, 1)
    pieces = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def _child_id(source: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source} {kind}')}>"


def page_facts(found: list[tuple[str, str, str]], address: str | None) -> tuple[str, list[dict]]:
    """Title and links of a page's tokens; links are resolved against its first ``base`` or else its address."""
    title, in_title, links, base = [], False, [], None
    for kind, name, attrs in found:
        if kind == "text":
            if in_title:
                title.append(name)
            continue
        if name == "title":
            in_title = kind == "start" and not title
        elif kind == "start":
            in_title = False
            if name == "base" and base is None and attrs:
                base = attributes(attrs).get("href")
            if name in LINKS and attrs:
                own = attributes(attrs)
                links += [(f"{name}@/{a}", own[a].strip(" \t\n\f\r")) for a in LINKS[name] if own.get(a)]
                if name in ("img", "source") and own.get("srcset"):
                    links += [(f"{name}@/srcset", url) for url in srcset_urls(own["srcset"])]
    base = address if base is None else _resolved(address, base.strip())
    return " ".join(entities.unescape("".join(title)).split()), [{"path": path, "url": _resolved(base, url)} for path, url in links]


def srcset_urls(value: str) -> list[str]:
    """Addresses of a list of images: each ends at white space, and what describes it at a comma."""
    out, at = [], 0
    while m := _CANDIDATE.match(value, at):
        out.append(m[1].rstrip(","))
        at = m.end()
        if not m[1].endswith(","):
            comma = value.find(",", at)
            at = len(value) if comma < 0 else comma + 1
    return [x for x in out if x]


def _resolved(base: str | None, link: str) -> str:
    try:
        return urljoin(base, link) if base else link
    except ValueError:
        return link


def parse_headers(http_headers: str) -> tuple[str, list[list[str]]]:
    """Status line and (name, value) of each field of an HTTP header block, in order."""
    first, *rest = http_headers.split("\r\n") if http_headers else [""]
    return first, [[k.strip(), v.strip()] for k, _, v in (x.partition(":") for x in rest) if k.strip()]


def derive(record_id: str, target: str | None, date: str | None, http_headers: str | None, payload: str | None) -> list[dict]:
    """The metadata and conversion records of one response."""
    payload, http_headers = payload or "", http_headers or ""
    raw = payload.encode("utf-8", "surrogatepass")
    payload_digest = digest(raw)
    found = list(tokens(payload))
    title, links = page_facts(found, target)
    status, fields = parse_headers(http_headers)
    ids = {kind: _child_id(record_id, kind) for kind in ("metadata", "conversion")}
    facts = {"source": {"record_id": record_id, "target_uri": target, "date": date, "status": status, "headers": fields, "payload_digest": payload_digest, "block_digest": digest(http_headers.encode() + raw), "payload_length": len(raw)}, "html": {"title": title, "links": links}, "conversion": ids["conversion"]}
    out = []
    for kind, content_type, block in (("metadata", "application/json", json.dumps(facts, ensure_ascii=False, sort_keys=True)), ("conversion", "text/plain; charset=utf-8", layout(found, Rules(payload)))):
        own = block.encode("utf-8", "surrogatepass")
        other = ids["conversion" if kind == "metadata" else "metadata"]
        head = {"WARC-Type": kind, "WARC-Record-ID": ids[kind], "WARC-Date": date, "WARC-Target-URI": target, "WARC-Refers-To": record_id, "WARC-Concurrent-To": other, "WARC-Block-Digest": digest(own), "WARC-Source-Payload-Digest": payload_digest, "Content-Type": content_type, "Content-Length": str(len(own))}
        out.append({
            "record_type": kind, "record_id": ids[kind], "refers_to": record_id, "linked_id": other, "target_uri": target, "warc_date": date, "content_type": content_type, "content_length": len(own),
            "block_digest": head["WARC-Block-Digest"], "source_payload_digest": payload_digest, "source_headers": http_headers, "warc_headers": "".join(f"{k}: {_BREAKS.sub(" ", v)}\r\n" for k, v in head.items() if v is not None), "block": block,
        })
    return out


def record_bytes(warc_headers: str, block: str) -> bytes:
    """A record as in a WARC file, not compressed."""
    return b"WARC/1.1\r\n" + warc_headers.encode() + b"\r\n" + block.encode("utf-8", "surrogatepass") + b"\r\n\r\n"


def derivatives(records: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Two rows for each response record, with its ``id_col``."""
    rows = slim(records, id_col, "record_id", "target_uri", "warc_date", "http_headers", "payload")
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(1, 6)]
            made = [derive(*row) for row in zip(*columns, strict=True)]
            ids = batch.column(0).take(pa.array([i for i, x in enumerate(made) for _ in x], pa.int64()))
            flat = [r for x in made for r in x]
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            data = [pa.array([r[n] for r in flat], pa.int64() if n == "content_length" else pa.string()) for n in names]
            yield pa.RecordBatch.from_arrays([ids, *data], names=[id_col, *names])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, {SCHEMA}")
