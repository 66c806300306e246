"""Web archives: legacy ARC records converted to WARC, written, and read back.

`arc_record` writes a page as a record of ARC version 1 or 2, `parse_arc` reads either version by
its header line and declared length, and `to_warc` turns an entry into a WARC/1.0 record with
a synthesised record id, date, type and digests. `convert_arcs` does so for archives on disk, `write_arc` writes such, and
`write_warc` goes from pages to WARC through ARC entries. Spark's own text writer lays records end to end with their
separator as its line separator, byte for byte, so each part file is a gzip-compressed archive of about ARCHIVE_BYTES (before
compression) and RECORDS_PER_FILE records at most. `read_warc` reads archives of any size by declared lengths.

Of records with equal payloads of at least `least_bytes` bytes, the one of the largest page_id is
the response and the others are revisits of it, written without the payload; smaller ones are all
responses. Null html is an empty payload. Rows that repeat the largest page_id are all responses.
Pages without an id are written and read back with a null id, as revisits where an equal payload
has an id. Null urls become "-"; white space in urls is percent-encoded. An empty table gives no record. Very long pages are
records like others; further columns, whatever their names, are not read.

No two records share a WARC-Record-ID: the one response of a payload has an id made from its page_id and digest, by which revisits
refer to it; all others have ids made from their url, too, and their place. Revisits of a payload with several responses
refer to it by page and URI.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, parts, slices, table

LEAST_BYTES = 0
RECORDS_PER_FILE, ARCHIVE_BYTES, WHOLE_BYTES = 4_000, 64 << 20, 256 << 20
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122
ARCHIVED = "20240101000000"
#: The header lines of both ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
BACK = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


# -- ARC ---------------------------------------------------------------------------------------


def arc_version_block(version: int, name: str = "pages.arc") -> bytes:
    body = f"{version} 0 readtrack\n{ARC_FIELDS[version]}\n".encode()
    head = [f"filedesc://{name}", "0.0.0.0", ARCHIVED, "text/plain"]
    if version == 2:
        head += ["200", "-", "-", "0", name]
    return f"{' '.join([*head, str(len(body))])}\n".encode() + body + b"\n"


def arc_record(url: str | None, body: bytes, version: int, ip: str = "0.0.0.0", date: str = ARCHIVED, mime: str = "text/html") -> bytes:
    """An ARC entry whose network document is an HTTP response around `body`."""
    url = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "-")
    doc = f"HTTP/1.1 200 OK\r\nContent-Type: {mime}; charset=UTF-8\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body
    head = [url, ip, date, mime]
    if version == 2:
        head += ["200", hashlib.md5(doc).hexdigest(), "-", "0", "pages.arc"]
    return f"{' '.join([*head, str(len(doc))])}\n".encode() + doc + b"\n"


MOST_HEAD = 1 << 16


def arc_fields(line: str, version: int | None) -> dict | None:
    """A header line's fields, counted from the right, since addresses of pages may hold spaces; None where it is no header."""
    width = {1: 5, 2: 10}
    for v in (version,) if version else (2, 1):
        parts_ = line.rsplit(" ", width[v] - 1)
        if len(parts_) == width[v] and parts_[-1].isdecimal() and parts_[2].isdecimal() and 4 <= len(parts_[2]) <= 14:
            return dict(zip(ARC_FIELDS[v].split(), parts_, strict=True))
    return None


def parse_arc(pieces: bytes | Iterator[bytes], version: int | None = None) -> Iterator[dict]:
    """Entries of an ARC file or of bare records, a piece of bytes at a time: one entry is in memory.

    The version block, where there is one, names the version of all that follow. What can't be read is an entry with `error` (why), `at` (its place) and
    `line` alone: a line where a header should be, an entry that is cut off by the file's end. Reading goes on at the next line that is a header.
    """
    pieces = iter([pieces]) if isinstance(pieces, bytes) else pieces
    held, at, lost = bytearray(), 0, False

    def more() -> bool:
        piece = next(pieces, None)
        held.extend(piece or b"")
        return piece is not None

    def drop(n: int) -> None:
        nonlocal at
        del held[:n]
        at += n

    while True:
        while (end := held.find(b"\n")) < 0 and len(held) <= MOST_HEAD and more():
            pass
        if not held:
            return
        if end < 0:
            end = len(held)
        line = held[:end].decode("utf-8", "replace").removesuffix("\r")
        fields = arc_fields(line, version) if end <= MOST_HEAD else None
        if fields is None:
            if line.strip() and not lost:
                yield {"error": "no header", "at": at, "line": line[:200]}
            lost = lost or bool(line.strip())
            drop(end + 1)
            continue
        lost, length = False, int(fields["Archive-length"])
        while len(held) < end + 1 + length and more():
            pass
        block = bytes(held[end + 1 : end + 1 + length])
        if len(block) < length:
            yield {"error": f"{length} bytes declared, {len(block)} there", "at": at, "line": line[:200]}
            return
        drop(end + 1 + length)
        if line.startswith("filedesc:"):
            version = 2 if b"Result-code" in block or block[:2] == b"2 " else 1
            continue
        yield fields | {"block": block}


# -- WARC --------------------------------------------------------------------------------------


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, '/'.join(map(str, parts)))}>"


def split_block(block: bytes) -> tuple[bytes, bytes, bytes]:
    """HTTP head, gap and payload; no head where the document isn't a response."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    return (head, gap, payload) if head.startswith(b"HTTP/") else (b"", b"", block)


def to_warc(entry: dict, page_id: int | None, refers_to: int | None = None, revisit: bool = False, place: str | None = None, several: bool = False) -> bytes:
    """The WARC record of an ARC entry, without the separator that ends it. place: None for the one response of its payload;
    several: whether the payload has more than one response."""
    head, gap, payload = split_block(entry["block"])
    block, digest = head + gap + payload, base32_sha1(payload)
    if revisit:
        block = head + gap
    d = entry["Archive-date"].ljust(14, "0")
    lines = [
        "WARC/1.0",
        f"WARC-Type: {'revisit' if revisit else 'response' if head else 'resource'}",
        f"WARC-Record-ID: {record_id(page_id, digest) if place is None else record_id(page_id, digest, entry['URL'], place)}",
        f"WARC-Date: {d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z",
        f"WARC-Target-URI: {entry['URL']}",
        f"WARC-IP-Address: {entry['IP-address']}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"Content-Type: {'application/http; msgtype=response' if head else entry['Content-type']}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")
        if not several:
            lines.append(f"WARC-Refers-To: {record_id(refers_to, digest)}")
        lines.append(f"X-Refers-To-Page-ID: {refers_to}")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def parse_warc(pieces: Iterator[bytes]) -> Iterator[tuple[dict, bytes]]:
    """(headers, block) of every record of a stream of bytes, by declared lengths."""
    held = bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        if piece is None:
            return False
        held.extend(piece)
        return True

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("the archive ends within a record's header")
                return
        lines = held[:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        heads = dict(x.split(": ", 1) for x in lines[1:])
        length = int(heads["Content-Length"])
        while len(held) < end + 8 + length:
            if not more():
                raise ValueError("the archive ends within a record")
        block = bytes(held[end + 4 : end + 4 + length])
        if held[end + 4 + length : end + 8 + length] != b"\r\n\r\n":
            raise ValueError("a record isn't followed by its separator")
        del held[: end + 8 + length]
        yield heads, block


def unzipped(chunks: Iterable[bytes], step: int = 1 << 20) -> Iterator[bytes]:
    """The contents of a gzip file of one or many members, or of a plain one, a bounded piece at a time."""
    z, plain = None, None
    for data in chunks:
        if plain is None and data:
            plain = data[:1] != b"\x1f"
        if plain:
            yield data
            continue
        while data:
            z = z or zlib.decompressobj(31)
            out = z.decompress(data, step)
            data = z.unused_data if z.eof else z.unconsumed_tail
            if z.eof:
                z = None
            if out:
                yield out
    if z:
        yield z.flush()


def chunks_of(path: str, step: int = 1 << 20) -> Iterator[bytes]:
    """A file as Spark names it, read in order where it lies."""
    store, name = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    with store.open_input_stream(name, compression=None) as f:
        while data := f.read(step):
            yield data


# -- Spark -------------------------------------------------------------------------------------


def with_revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, url, body, refers_to, revisit, alone (the one response of its payload), several (responses of its payload): the largest
    id of each payload answers for the others."""
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("body"))
    p = p.withColumn("digest", F.sha1("body"))
    by_page = p.where(F.octet_length("body") >= least_bytes).groupBy(F.col("digest").alias("m_digest"), "page_id").agg(F.count("*").alias("n"))
    most = (
        by_page.groupBy("m_digest")
        .agg(F.max(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "n"))).alias("m"), F.sum("n").alias("rows"))
        .where("rows > 1 and m is not null")
        .select("m_digest", F.col("m.page_id").alias("last"), (F.col("m.n") > 1).alias("many"))
    )
    j = p.join(most, F.col("digest") == F.col("m_digest"), "left")
    met = F.col("last").isNotNull()
    own = F.coalesce(F.col("page_id") == F.col("last"), F.lit(False))
    several = F.coalesce("many", F.lit(False))
    small = F.octet_length("body") < least_bytes  # unmatched, and perhaps repeated
    alone = ((met & own & ~several) | ~met) & ~small & F.col("page_id").isNotNull()
    return j.select("page_id", "url", "body", F.when(met & ~own, F.col("last")).alias("refers_to"), (met & ~own).alias("revisit"), alone.alias("alone"), several.alias("several"))


def version_of(page_id: int | None) -> int:
    return 2 if (page_id or 0) % 2 else 1


def convert(batches):
    """Rows become ARC entries, of version 2 for odd ids, and these WARC records."""
    from pyspark import TaskContext

    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        for rows in slices(batch, 2):
            out = []
            for r in rows.to_pylist():
                version, n = version_of(r["page_id"]), n + 1
                arc = arc_version_block(version) + arc_record(r["url"], r["body"], version)
                (entry,) = parse_arc(arc)
                out.append(to_warc(entry, r["page_id"], r["refers_to"], r["revisit"], None if r["alone"] else f"{part}/{n}", r["several"]))
            yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.binary())})


def write_records(records: DataFrame, path: str, separator: str) -> None:
    """Binary values as archives; a value's bytes are written as they are."""
    text = records.select(F.col("value").cast("string").alias("value"))
    text.write.option("lineSep", separator).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def write_warc(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Writes archives of about ARCHIVE_BYTES, one a task at least where there are fewer."""
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    archives = parts(total, ARCHIVE_BYTES, pages.sparkSession.sparkContext.defaultParallelism)
    rows = with_revisits(pages, least_bytes).coalesce(archives)  # never more than the join has made
    write_records(rows.mapInArrow(convert, "value binary"), path, "\r\n\r\n")


def write_arc(pages: DataFrame, path: str, version: int = 1) -> None:
    """Pages as ARC archives without version blocks; each entry is a line of its header and its document. A page's id is lost, its url stays."""

    def run(batches):
        for batch in batches:
            for rows in slices(batch, 1):
                found = [arc_record(url, (html or "").encode(), version)[:-1] for url, html in zip(*(c.to_pylist() for c in rows.columns), strict=True)]
                yield pa.RecordBatch.from_pydict({"value": pa.array(found, pa.binary())})

    write_records(pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "value binary"), path, "\n")


def arc_entries(spark: SparkSession, arcs: str, make, schema: str, whole: int = WHOLE_BYTES) -> DataFrame:
    """What `make` gives of the entries of ARC archives (plain or gzip); it takes a file's name and entries, and yields batches. Archives of up to `whole` bytes come as rows, longer ones are read where they lie."""

    def short(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from make(name, parse_arc(unzipped([data.as_py()])))

    def long(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                yield from make(name, parse_arc(unzipped(chunks_of(name))))

    files = spark.read.format("binaryFile").load(arcs)
    some = files.where(F.col("length") <= whole).select("path", "content").mapInArrow(short, schema)
    return some.unionByName(files.where(F.col("length") > whole).select("path").mapInArrow(long, schema))


def convert_arcs(spark: SparkSession, arcs: str, path: str, whole: int = WHOLE_BYTES) -> None:
    """ARC archives to WARC archives: every entry a response, or a resource where it isn't HTTP. Entries that can't be read are left to `bad_entries`."""

    def make(name, entries):
        rows, size = [], 0
        for n, entry in enumerate(entries):
            if "error" in entry:
                continue
            rows.append(to_warc(entry, None, place=f"{name}/{n}"))
            size += len(rows[-1])
            if size > 4 << 20:
                yield pa.RecordBatch.from_pydict({"value": pa.array(rows, pa.binary())})
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pydict({"value": pa.array(rows, pa.binary())})

    write_records(arc_entries(spark, arcs, make, "value binary", whole), path, "\r\n\r\n")


def bad_entries(spark: SparkSession, arcs: str, whole: int = WHOLE_BYTES) -> DataFrame:
    """path, at, error, line of what `convert_arcs` leaves out: its place in the unzipped archive, why, and what its line begins with."""

    def make(name, entries):
        bad = [x for x in entries if "error" in x]
        columns = [[name] * len(bad), *([x[c] for x in bad] for c in ("at", "error", "line"))]
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["path", "at", "error", "line"])

    return arc_entries(spark, arcs, make, "path string, at long, error string, line string", whole)


def records_back(chunks: Iterable[bytes]) -> Iterator[pa.RecordBatch]:
    rows = []
    for heads, block in parse_warc(unzipped(chunks)):
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = heads["WARC-Payload-Digest"].removeprefix("sha1:")
        length = re.search(rb"(?im)^content-length: *(\d+)", http)
        size = int(length[1]) if length else len(payload)
        if heads["WARC-Type"] == "resource":
            payload, size = block, len(block)
        if heads["WARC-Type"] != "revisit" and (base32_sha1(payload), len(payload)) != (digest, size):
            raise ValueError(f"{heads['WARC-Record-ID']}: the payload isn't what its headers declare")
        page, refers = heads.get("X-Page-ID"), heads.get("X-Refers-To-Page-ID")
        rows.append((page and int(page), size, digest, heads["WARC-Type"], refers and int(refers)))
        if len(rows) == 5000:
            yield back(rows)
            rows = []
    if rows:
        yield back(rows)


def read_back(batches):
    for batch in batches:
        for data in batch.column(0):
            yield from records_back([data.as_py()])


def read_streams(batches):
    for batch in batches:
        for path in batch.column(0).to_pylist():
            yield from records_back(chunks_of(path))


def back(rows: list) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], [x.split()[0] for x in BACK.split(", ")])


def read_warc(spark: SparkSession, path: str, whole: int = WHOLE_BYTES) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record; each response's payload is checked against its digest.

    Archives of up to `whole` bytes come as rows; longer ones are read in order where they lie, one record in memory.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    short = files.where(F.col("length") <= whole).select("content").mapInArrow(read_back, BACK)
    return short.unionByName(files.where(F.col("length") > whole).select("path").mapInArrow(read_streams, BACK))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    write_warc(table(spark, sf_dir, "pages"), scratch.path("archives"))
    scratch.release()
    return read_warc(spark, scratch.path("archives"))


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), g AS (
  SELECT hex, max(page_id) AS last, count(*) AS n FROM p GROUP BY hex
), r AS (
  SELECT p.*, CASE WHEN g.n > 1 AND g.last IS NOT NULL AND page_id IS DISTINCT FROM g.last THEN g.last END AS refers
  FROM p JOIN g USING (hex)
)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN refers IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       refers AS refers_to
FROM r
"""
