"""Web archives: writing, normalising whole-file gzip, reading back.

``write`` makes archives of pages, each a single gzip stream over all its
records, as some crawlers leave them: nothing in such a file can be reached
without inflating all before it.  ``normalise`` inflates each stream once,
piece by piece, writes every record as a gzip member of its own, and leaves an
offset index beside the file (a line of JSON a record).  ``read`` goes to single
records by that index.

Records with equal payloads of at least ``least`` bytes: the one with the
smallest page id is the response, the others are revisits that refer to it and
repeat its HTTP head, with the payload's length, but not the payload.  Smaller
payloads are always responses.

Definitions: the payload of a null page is empty; a null page id is written as
``null``, orders after all ids and is read back as null; rows that share an id
are separate records, each with a record id of its own (the page id, a digest of
what the row holds, the number of the copy); a null url is left out; blanks and control characters in
a url are percent-encoded.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import urllib.parse
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import materialize, shuffles_freed, small_batches, utf8
from .files import own_name, random_reader, reader, writer

FILE_BYTES = 16 << 20       # inflated bytes of an archive
_PIECE = 1 << 20
_DATE = "1970-01-01T00:00:00Z"
_PAGE = "urn:page:"

INDEX = "path string, at long, length long, record_type string, page_id long, uri string"
ROWS = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, path string, at long")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None, tail: str) -> str:
    return f"<{_PAGE}{'null' if page_id is None else page_id}#{tail}>"


def _id(name: str) -> int | None:
    tail = name.strip("<>").split("#")[0].removeprefix(_PAGE)
    return None if tail == "null" else int(tail)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool,
           own: str = "", lead: str = "") -> bytes:
    """One record, as bytes; ``own`` and ``lead`` tell its id and that of the
    record it refers to from others of the same pages."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id, own)}",
            f"WARC-Date: {_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]|{}\\^`\"<>"))
    if revisit:
        head += [f"WARC-Refers-To: {_name(refers_to, lead)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def _head(raw: bytes) -> dict[str, str]:
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in raw.decode().split("\r\n")[1:])}


_LENGTH = re.compile(rb"\r\ncontent-length: *(\d+)", re.I)


def records(stream, piece: int = _PIECE):
    """The records of a gzip stream of one or more members, inflated piece by
    piece; holds one record at a time.  Zero bytes between or behind members are
    padding.  An archive that is cut, within a member or a record, is an error."""
    inflate, held, need = zlib.decompressobj(31), bytearray(), 0
    pending, begun = b"", False
    while True:
        raw = pending or stream.read(piece)
        if not raw:
            # all input is read: what the member still holds comes out, and its end
            left = inflate.decompress(b"", piece) if begun else b""
            if begun and not left and not inflate.eof:
                raise ValueError("the archive ends within a gzip member")
            if not begun:
                if held:
                    raise ValueError("the archive ends within a record")
                return
            held += left
        else:
            if not begun:
                raw = raw.lstrip(b"\0")
                pending = b""
            if raw:
                begun = True
                held += inflate.decompress(raw, piece)
                pending = inflate.unconsumed_tail
        if inflate.eof:
            pending, begun = inflate.unused_data, False
            inflate = zlib.decompressobj(31)
        while True:
            if not need:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                need = end + 4 + int(_LENGTH.search(held, 0, end).group(1)) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = 0


def _member(raw: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(raw) + deflate.flush()


# --------------------------------------------------------------------- Spark

def write(pages: DataFrame, folder: str, least: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archives of one gzip stream each under ``folder``: their (path, records).
    ``pages`` needs page_id, url, html."""
    payload = F.coalesce(utf8("html"), F.lit(b""))
    number = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    # Rows alike in id, url and payload are interchangeable: one name for them.
    rows = small_batches(pages).select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        payload.alias("payload"), F.sha1(payload).alias("key")) \
        .withColumn("name", F.concat_ws(" ", number, "key", F.col("url").isNull().cast("string"), "url"))
    # Which of them leads its payload is settled without the payloads ...
    light = rows.where(F.octet_length("payload") >= least).select("name", "page_id", "key").distinct()
    lead = light.groupBy("key").agg(F.min(F.struct(F.col("page_id").isNull().alias("late"), "page_id", "name")).alias("lead"))
    roles = light.join(lead, "key").select(
        "name", (F.col("lead.name") == F.col("name")).alias("leads"), F.col("lead.page_id").alias("refers_to"),
        F.sha1("lead.name").alias("lead"))
    # ... which are dealt out once, by name.
    alike = rows.groupBy("name").agg(F.first("page_id").alias("page_id"), F.first("url").alias("url"),
                                     F.first("payload").alias("payload"), F.count("*").alias("n"))
    marked = alike.join(roles, "name", "left").select(
        "page_id", "url", "payload", "n", "leads", "refers_to", F.sha1("name").alias("own"), "lead")

    def task(batches):
        # a file is written as one stream, closed when it is full
        count, state = 0, None

        def close():
            path, out, context, deflate, n, _ = state
            out.write(deflate.flush())
            context.__exit__(None, None, None)
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], ["path", "records"])

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "n", "leads", "refers_to", "own", "lead"))):
                i, url, payload, n, leads, to, own, lead = (x.as_py() for x in row)
                for k in range(n):
                    if state is None:
                        path = own_name(folder, count, ".warc.gz")
                        context = writer(path)
                        state = [path, context.__enter__(), context, zlib.compressobj(6, zlib.DEFLATED, 31), 0, 0]
                        count += 1
                    # no role: a payload too small to be shared
                    raw = record(i, url, payload, to, leads is not None and not (leads and k == 0), f"{own}-{k}", f"{lead}-0")
                    state[1].write(state[3].compress(raw))
                    state[4] += 1
                    state[5] += len(raw)
                    if state[5] >= file_bytes:
                        yield close()
                        state = None
        if state is not None:
            yield close()

    return marked.mapInArrow(task, "path string, records long")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Every archive of ``archives`` (path) rewritten with a gzip member a
    record, and its index written beside it; returns the index's rows."""
    def task(batches):
        count = 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                target = own_name(folder, count, ".warc.gz")
                count += 1
                at, lines, rows = 0, [], []
                with reader(path) as source, writer(target) as out:
                    for raw in records(source):
                        head = _head(raw[:raw.index(b"\r\n\r\n")])
                        member = _member(raw)
                        out.write(member)
                        rows.append((target, at, len(member), head["warc-type"], _id(head["warc-record-id"]),
                                     head.get("warc-target-uri")))
                        lines.append(json.dumps(dict(zip(("offset", "length", "type", "page_id", "uri"), rows[-1][1:]))))
                        at += len(member)
                with writer(target + ".idx") as out:
                    out.write(("\n".join(lines) + "\n").encode())
                cols = list(zip(*rows)) or [[]] * 6
                types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 ["path", "at", "length", "record_type", "page_id", "uri"])

    return archives.select("path").mapInArrow(task, INDEX)


def parse(raw: bytes) -> tuple:
    """(page_id, url, payload bytes, payload digest, type, refers to) of one
    record; a response's payload must have the digest it states."""
    cut = raw.index(b"\r\n\r\n")
    head, block = _head(raw[:cut]), raw[cut + 4:-4]
    cut = block.index(b"\r\n\r\n")
    payload = block[cut + 4:]
    size, stated = int(_LENGTH.search(block, 0, cut).group(1)), head["warc-payload-digest"].removeprefix("sha1:")
    revisit = head["warc-type"] == "revisit"
    if not revisit and (len(payload) != size or digest(payload) != stated):
        raise ValueError(f"damaged record {head['warc-record-id']}")
    url = head.get("warc-target-uri")
    return (_id(head["warc-record-id"]), url, size, stated, head["warc-type"],
            _id(head["warc-refers-to"]) if revisit else None)


def read(index: DataFrame) -> DataFrame:
    """The records that ``index`` points at, one by one."""
    def task(batches):
        for batch in batches:
            rows, current, source = [], None, None
            for path, at, length in zip(*(batch.column(c).to_pylist() for c in ("path", "at", "length"))):
                if path != current:
                    if source is not None:
                        source.close()
                    current, source = path, random_reader(path)
                raw = zlib.decompress(source.read_at(length, at), 31)
                rows.append((*parse(raw), path, at))
            if source is not None:
                source.close()
            cols = list(zip(*rows)) or [[]] * 8
            types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "path", "at"])

    return index.select("path", "at", "length").mapInArrow(task, ROWS)


def round_trip(pages: DataFrame, least: int = 0, folder: str | None = None) -> DataFrame:
    """Write ``pages``, normalise the archives, read them back: a row a page."""
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    run = uuid.uuid4().hex[:8]
    # the shuffled payloads have to go before they are written a second time
    with shuffles_freed(pages.sparkSession):
        archives = materialize(write(pages, f"{folder}/whole-{run}", least), "warc-files")
    index = materialize(normalise(archives, f"{folder}/members-{run}"), "warc-index")
    return read(index)
