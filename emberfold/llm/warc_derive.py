"""Derived WARC records: metadata and plain text of response records.

From every response two records are made, each naming the response in WARC-Refers-To and keeping its
target URI, date and payload digest: a ``metadata`` record, whose JSON block holds the source
record's WARC and HTTP headers, the page's title, meta fields and links, and a ``conversion`` record
with the page's text. Record ids are derived from the response's id, so a rerun makes the same ones.
Everything is a map over the responses; pages of any size are worked on one at a time.

Defined cases: a missing block is an empty one without HTTP headers; a block without an empty line
is all payload; a missing target URI or digest leaves its header out (the digest is then computed);
bytes that are not UTF-8 are read with replacement characters; an empty page gives an empty text
and no links; repeated responses give repeated records; records of a
response without an id are named by its target URI, date and payload digest and refer to nothing;
pages without page_id and URL are named by their content; hidden elements and titles that are never
closed are ordinary text, found out in time linear in the page; an empty table gives no rows; columns other
than those of a response record are not looked at.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import html
import json
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RESPONSE = "record_id string, target_uri string, date string, payload_digest string, block binary"
RECORDS = (
    "record_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
    "payload_digest string, block_digest string, block binary"
)
_NAMES = [c.split()[0] for c in RECORDS.split(", ")]

_HIDDEN = re.compile(r"<!--|<(script|style|noscript|template)\b", re.IGNORECASE)
_TAG = re.compile(r"<(?:(/?)([a-zA-Z][a-zA-Z0-9]*+)|[!?])")
_REST = re.compile(r"((?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>")
_MARK = re.compile(r"['\">]")
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*+)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))")
_TITLE = re.compile(r"<(title)\b", re.IGNORECASE)
_ENDS = {"": re.compile("-->")} | {
    name: re.compile(rf"</{name}\s*+>", re.IGNORECASE) for name in ("script", "style", "noscript", "template", "title")
}
# Elements that end a line of text, and attributes that hold links.
_BLOCKS = frozenset(
    "address article aside blockquote body br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hr html li main nav ol option p pre section table tbody td tfoot th thead title tr ul".split()
)
_LINKS = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "form": "action"}


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def derived_id(record_id: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{record_id} {kind}')}>"


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """(status line, headers, payload) of an HTTP response."""
    head, mark, payload = block.partition(b"\r\n\r\n")
    if not mark:
        return "", [], block
    status, *lines = head.decode("utf-8", "replace").split("\r\n")
    pairs = [line.partition(":") for line in lines]
    return status, [(k.strip(), v.strip()) for k, c, v in pairs if c], payload


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def _elements(page: str, opening: re.Pattern) -> Iterator[tuple[int, int, int, int]]:
    """(start, start of the content, end of it, end) of the closed elements that ``opening`` begins.

    An end that is not found from one place on is not looked for from a later one, so the time is
    linear in the page whatever is left open.
    """
    at, missing = 0, set()
    while found := opening.search(page, at):
        name, at = (found[1] or "").casefold(), found.end()
        if name in missing:
            continue
        content = page.find(">", at) + 1 if name else at
        end = _ENDS[name].search(page, content) if content or not name else None
        if end is None:
            missing.add(name)
        else:
            at = end.end()
            yield found.start(), content, end.start(), at


def _tag_ends(page: str) -> Callable[[int], int]:
    """Where a tag ends whose name ends at a place (0: nowhere), worked out from the back of the page."""
    marks = [m.start() for m in _MARK.finditer(page)]
    ends, following = [0] * (len(marks) + 1), {"'": len(marks), '"': len(marks)}
    for i in range(len(marks) - 1, -1, -1):
        mark = page[marks[i]]
        if mark == ">":
            ends[i] = marks[i] + 1
        else:
            ends[i] = ends[min(following[mark] + 1, len(marks))]
            following[mark] = i
    return lambda at: ends[bisect.bisect_left(marks, at)]


def _tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, whether it closes, lower-case name, attributes) of tags, with no name for declarations."""
    at, end_of = 0, None
    while found := _TAG.search(page, at):
        start, at = found.start(), found.end()
        if not found[2]:
            end = page.find(">", at) + 1
            if not end:
                return
        elif end_of:
            end = end_of(at)
        elif rest := _REST.match(page, at):
            end = rest.end()
        else:
            # Something is left open up to the end of the page; do not read that far again.
            end_of, end = _tag_ends(page), 0
        if end:
            yield start, end, bool(found[1]), (found[2] or "").lower(), page[at : end - 1]
            at = end


def _without(page: str, opening: re.Pattern, instead: str) -> str:
    out, at = [], 0
    for start, _, _, end in _elements(page, opening):
        out += [page[at:start], instead]
        at = end
    return "".join([*out, page[at:]])


def page_text(page: str) -> str:
    """Visible text, a line per block element, runs of white space as one space."""
    bare = _without(_without(page, _TITLE, ""), _HIDDEN, " ")
    shown, at = [], 0
    for start, end, _, name, _ in _tags(bare):
        shown += [bare[at:start], "\n" if name in _BLOCKS else ""]
        at = end
    lines = (" ".join(line.split()) for line in html.unescape("".join([*shown, bare[at:]])).split("\n"))
    return "\n".join(line for line in lines if line)


def page_metadata(page: str) -> dict:
    """Title, meta fields and links, in the order of the page."""
    title = next(_elements(page, _TITLE), None)
    metas, links = [], []
    for _, _, closes, name, attributes in _tags(page):
        if closes or not (name == "meta" or name in _LINKS):
            continue
        found = _attributes(attributes)
        if name == "meta":
            metas.append(found)
        elif found.get(_LINKS[name]):
            links.append({"path": f"{name.upper()}@/{_LINKS[name]}", "url": found[_LINKS[name]]})
    return {"title": html.unescape(page[title[1] : title[2]]).strip() if title else None, "metas": metas, "links": links}


def derive_records(response: dict) -> list[dict]:
    """The metadata and the conversion record of one response."""
    status, headers, payload = split_http(response["block"] or b"")
    source_digest = response["payload_digest"] or digest(payload)
    page = payload.decode("utf-8", "replace")
    envelope = {
        "warc": {k: response[k] for k in ("record_id", "target_uri", "date")} | {"payload_digest": source_digest},
        "http": {"status": status, "headers": [list(h) for h in headers], "payload_length": len(payload)},
        "html": page_metadata(page),
    }
    blocks = {
        "metadata": ("application/json", json.dumps(envelope, ensure_ascii=False).encode("utf-8", "replace")),
        "conversion": ("text/plain; charset=utf-8", page_text(page).encode("utf-8", "replace")),
    }
    name = response["record_id"]
    if name is None:
        name = f"{response['target_uri']} {response['date']} {source_digest}"
    return [
        {
            "record_type": kind, "record_id": derived_id(name, kind), "refers_to": response["record_id"],
            "target_uri": response["target_uri"], "date": response["date"], "content_type": content,
            "payload_digest": source_digest, "block_digest": digest(block), "block": block,
        }
        for kind, (content, block) in blocks.items()
    ]


def warc_bytes(record: dict) -> bytes:
    """A record as it stands in a WARC file."""
    fields = [
        ("WARC-Type", record["record_type"]), ("WARC-Record-ID", record["record_id"]),
        ("WARC-Refers-To", record.get("refers_to")), ("WARC-Target-URI", record["target_uri"]),
        ("WARC-Date", record["date"]), ("WARC-Payload-Digest", record["payload_digest"]),
        ("WARC-Block-Digest", record["block_digest"]), ("Content-Type", record["content_type"]),
        ("Content-Length", str(len(record["block"]))),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return b"WARC/1.0\r\n" + head.encode() + b"\r\n" + record["block"] + b"\r\n\r\n"


def read_warc(data: bytes) -> list[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records in a WARC file's bytes."""
    out, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")[1:]
        headers = dict(line.split(": ", 1) for line in lines)
        size = int(headers["Content-Length"])
        out.append((headers, data[end + 4 : end + 4 + size]))
        at = end + 4 + size + 4
    return out


def page_responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of raw pages (page_id, url, html), with ``page_id``; ids follow page and URL."""
    named = F.concat_ws("\n", F.col("page_id").cast("string"), F.col("url"))
    key = F.sha1(F.when(F.coalesce(F.col("page_id").cast("string"), F.col("url")).isNotNull(), named).otherwise(F.concat(F.lit("\n\n"), F.coalesce("html", F.lit("")))))
    part = lambda a, n: F.substring(key, a, n)
    name = F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12))
    body = F.coalesce("html", F.lit(""))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return pages.select(
        "page_id", F.concat(F.lit("<urn:uuid:"), name, F.lit(">")).alias("record_id"), F.col("url").alias("target_uri"),
        F.lit(date).alias("date"), F.lit(None).cast("string").alias("payload_digest"),
        F.concat(F.encode(head, "UTF-8"), F.encode(body, "UTF-8")).alias("block"),
    )


def _derive(batches):
    for batch in batches:
        rows = [{**r, "_id": response["_id"]} for response in batch.to_pylist() for r in derive_records(response)]
        kinds = {"block": pa.binary(), "_id": batch.schema.field("_id").type}
        names = ["_id", *_NAMES]
        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in names], names=names)


def derive(responses: DataFrame, id_column: str = "record_id") -> DataFrame:
    """Two records for every response, with the response's ``id_column`` as ``source``."""
    kind = responses.schema[id_column].dataType.simpleString()
    columns = [c.split()[0] for c in RESPONSE.split(", ")]
    return (
        responses.select(F.col(id_column).alias("_id"), *columns)
        .mapInArrow(_derive, f"_id {kind}, {RECORDS}").withColumnRenamed("_id", "source")
    )


def warc_files(records: DataFrame) -> DataFrame:
    """``records`` with ``warc``, their bytes in a WARC file; a file is any concatenation of them."""

    def run(batches):
        for batch in batches:
            data = [warc_bytes(r) for r in batch.select(_NAMES).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], names=names)

    schema = StructType(list(records.schema.fields)).add("warc", "binary")
    names = schema.names
    return records.mapInArrow(run, schema)
