"""Legacy archives: ARC files converted to WARC, duplicates as revisits.

``write_arc`` writes HTTP responses as ARC files, version 1 or 2 (as the legacy
side to convert, and for tests). ``read_arc`` reads ARC files of either version:
a file's first record, the version block, tells the version and so the fields
of the header lines; records are cut by their declared lengths. ``convert``
synthesises what WARC has and ARC lacks: record ids (UUIDs derived from
file and place, so no two are equal and a rerun gives the same), ISO timestamps,
payload and block digests and record types, and writes WARC files of one gzip
member a record, so that a record can be read by its offset. ``read_warc`` reads
those back.

Of records with equal payloads of ``min_revisit`` bytes or more, the one with
the smallest page_id keeps its payload; the others become revisit records that
name its id, URI and date. Who is a revisit of whom is found from digests and
places alone, without payloads: a digest that a large share of all records have
meets them by broadcast (such digests are few), the others by shuffle. The files
then meet the list of their own revisits, and are converted file by file.

Files are written by Spark's text writer, so that they reach any file system
Spark does; every file has at most ``records`` records, which bounds what a
task holds.

Defined cases: null html is the empty payload; a null url is written as
urn:page:<id>; a null page_id is never the smallest and is a revisit if a
numbered record has its payload; rows that repeat a page_id with the same
payload are alike; an empty table gives files without records and an empty
result; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caldim.llm.common import prepare, settings, stored
from caldim.session import work_dir

#: Header fields by version. Fixed values.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: [
        "URL",
        "IP-address",
        "Archive-date",
        "Content-type",
        "Result-code",
        "Checksum",
        "Location",
        "Offset",
        "Filename",
        "Archive-length",
    ],
}
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # that of URLs
#: Level of compression: pages take 4 % more room than by the usual one, and half of its time.
LEVEL = 2
#: Records of a file, at most.
RECORDS = 2000
#: Digests that may be broadcast: any other has fewer than FEW records, or than
#: a share of 1 / HOT_DIGESTS of all records with a shared payload.
HOT_DIGESTS, FEW = 100_000, 256
#: Archive date of rows that have none.
NO_DATE = "19700101000000"

RECORD = "page_id long, url string, ip string, date string, mime string, digest string, length long, http string, payload string"


def arc_line(version: int, url: str, ip: str, date: str, mime: str, length: int, checksum: str = "-") -> str:
    """A header line; white space in a URL is percent-encoded."""
    url = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)
    known = {"URL": url, "IP-address": ip, "Archive-date": date, "Content-type": mime, "Result-code": "200"}
    known |= {"Checksum": checksum, "Offset": "0", "Filename": "pages.arc", "Archive-length": str(length)}
    return " ".join(known.get(f, "-") for f in ARC_FIELDS[version])


def version_block(version: int) -> str:
    body = f"{version} 0 caldim\n{' '.join(ARC_FIELDS[version])}\n"
    return arc_line(version, "filedesc://pages.arc", "0.0.0.0", NO_DATE, "text/plain", len(body)) + "\n" + body


def write_arc(pages: DataFrame, path: str, version: int, records: int = RECORDS) -> None:
    """ARC files of page_id, url and html below ``path``."""
    prepare(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))

    def run(batches):
        n = 0
        for b in batches:
            out = []
            for page, url, html in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if n % records == 0:
                    out.append(version_block(version))
                n += 1
                body = html or ""
                size = len(body.encode())
                page_line = "" if page is None else f"X-Page-Id: {page}\r\n"
                doc = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n{page_line}Content-Length: {size}\r\n\r\n"
                line = arc_line(version, url or f"urn:page:{page}", "0.0.0.0", NO_DATE, "text/html", len(doc.encode()) + size)
                out.append(f"{line}\n{doc}{body}")
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    _files(rows.mapInArrow(run, "value string"), path, "\n", records)


def _files(rows: DataFrame, path: str, separator: str, records: int) -> None:
    """One leading record and ``records`` others a file."""
    w = rows.write.option("lineSep", separator).option("compression", "gzip").option("zlib.compress.level", "TWO")
    w.option("maxRecordsPerFile", records + 1).text(path)


def _content(path: str, raw: bytes) -> bytes:
    """A file's bytes, of one or several gzip members or plain."""
    if raw[:2] != b"\x1f\x8b":
        return raw
    out = []
    while raw:
        d = zlib.decompressobj(31)
        out.append(d.decompress(raw))
        raw = d.unused_data
    return b"".join(out)


def parse_arc(raw: bytes):
    """(url, ip, date, mime, document) of each record of an ARC file."""
    at = raw.find(b"\n")
    if at < 0:
        return
    head = raw[:at].decode().split(" ")
    size = int(head[-1])
    body = raw[at + 1 : at + 1 + size].decode()
    version = int(body.split(" ", 1)[0])
    fields = ARC_FIELDS.get(version)
    if fields is None or len(head) != len(fields):
        raise ValueError(f"not an ARC version block: {body[:80]!r}")
    at += 1 + size
    where = {f: fields.index(f) for f in fields}
    while at < len(raw):
        if raw[at] == 10:  # records are set apart by line feeds
            at += 1
            continue
        end = raw.index(b"\n", at)
        line = raw[at:end].decode().split(" ")
        if len(line) != len(fields):
            raise ValueError(f"not a header line of version {version}: {raw[at:end][:200]!r}")
        size = int(line[where["Archive-length"]])
        doc = raw[end + 1 : end + 1 + size]
        if len(doc) < size:
            raise ValueError("a record is shorter than declared")
        yield line[0], line[1], line[2], line[where["Content-type"]], doc
        at = end + 1 + size


def _records(path: str, raw: bytes):
    """(page_id, url, ip, date, mime, digest, http headers, payload) of each record of an ARC file."""
    for url, ip, date, mime, doc in parse_arc(_content(path, raw)):
        http, _, payload = doc.partition(b"\r\n\r\n")
        page = re.search(rb"(?im)^X-Page-Id: (-?\d+)\r?$", http)
        yield int(page[1]) if page else None, url, ip, date, mime, hashlib.sha256(payload).hexdigest(), http, payload


def _arc_files(spark, paths: list[str]) -> DataFrame:
    prepare(spark)
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(paths).select("path", "content")


def read_arc(spark, paths: list[str]) -> DataFrame:
    """The records of ARC files, as RECORD; http holds the response's headers."""

    def run(batches):
        for b in batches:
            for path, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = []
                for *known, http, payload in _records(path, raw.as_py()):
                    rows.append((*known, len(payload), http.decode(), payload.decode()))
                    if len(rows) == 256:
                        yield _batch(rows, RECORD)
                        rows = []
                yield _batch(rows, RECORD)

    return _arc_files(spark, paths).mapInArrow(run, RECORD)


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    names = [f.split(" ") for f in ddl.split(", ")]
    cols = list(zip(*rows, strict=True)) or [()] * len(names)
    types = [pa.int64() if kind == "long" else pa.string() for _, kind in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[n for n, _ in names]
    )


def record_id(kind: str, path: str, place: int) -> str:
    """Id of a record made from the one at ``place`` in the file at ``path``."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{kind} {path} {place}')}>"


def iso(date: str) -> str:
    """14 digits of an ARC date as a WARC timestamp; shorter ones are padded."""
    d = date + NO_DATE[len(date) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


PLACE = "page_id long, path string, place long, url string, date string, digest string, length long"
REVISIT = ["place", "first_page", "first_path", "first_place", "first_url", "first_date"]


def _places(files: DataFrame) -> DataFrame:
    """PLACE rows of the records of ARC files: all but headers and payloads."""

    def run(batches):
        for b in batches:
            for path, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = []
                for place, (page, url, _, date, _, digest, _, payload) in enumerate(_records(path, raw.as_py())):
                    rows.append((page, path, place, url, date, digest, len(payload)))
                yield _batch(rows, PLACE)

    return files.mapInArrow(run, PLACE)


def revisits(places: DataFrame, min_revisit: int) -> DataFrame:
    """(path, revisits) of files that hold records with the payload of another
    one, of a smaller page_id: for each its place, and the other's page, path,
    place, url and date."""
    long = places.filter(F.col("length") >= min_revisit)
    own = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "path", "place", "url", "date"))
    firsts = long.groupBy("digest").agg(F.count("*").alias("n"), F.min(own).alias("first"))
    firsts = stored(firsts.filter("n > 1 and first is not null"), "shared-payloads")
    most = max(FEW, (firsts.agg(F.sum("n")).first()[0] or 0) // HOT_DIGESTS)
    hot = firsts.filter(F.col("n") > most).select("digest", F.col("first").alias("hot"))
    rest = firsts.filter(F.col("n") <= most).select("digest", F.lit(0).alias("salt"), F.col("first").alias("cold"))
    met = long.select("digest", "page_id", "path", "place").join(F.broadcast(hot), "digest", "left")
    # records with a hot digest need no partner and go anywhere
    salt = F.when(F.col("hot").isNotNull(), F.pmod(F.xxhash64("path", "place"), F.lit(1 << 20)).cast("int") + 1).otherwise(0)
    met = met.withColumn("salt", salt).join(rest, ["digest", "salt"], "left").withColumn("first", F.coalesce("hot", "cold"))
    met = met.filter(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id")))
    one = F.struct(F.col("place"), *(F.col(f"first.{c}").alias(n) for c, n in zip(("page_id", "path", "place", "url", "date"), REVISIT[1:], strict=True)))
    return met.groupBy("path").agg(F.collect_list(one).alias("revisits"))  # as many as a file has records


def convert(spark, paths: list[str], path: str, min_revisit: int = 100, per_file: int = RECORDS) -> None:
    """WARC files below ``path`` of the records of the ARC files below ``paths``."""
    files = _arc_files(spark, paths)
    again = revisits(stored(_places(files), "record-places"), min_revisit)
    rows = files.join(again.hint("shuffle_hash"), "path", "left")

    def run(batches):
        n = 0
        for b in batches:
            for arc, raw, known in zip(*b.columns, strict=True):
                arc, known = arc.as_py(), {r["place"]: r for r in known.as_py() or ()}
                out = []
                for place, (page, url, ip, date, mime, digest, http, payload) in enumerate(_records(arc, raw.as_py())):
                    if n % per_file == 0:
                        info = b"software: caldim\r\nformat: WARC File Format 1.1"
                        out.append(member(warc("warcinfo", record_id("warcinfo", arc, place), iso(date), [], "application/warc-fields", info)))
                    n += 1
                    refers = known.get(place)
                    kind, block = ("response", payload) if refers is None else ("revisit", b"")
                    more = [("WARC-Target-URI", url), ("WARC-IP-Address", ip), ("WARC-Payload-Digest", f"sha256:{digest}")]
                    more += [("WARC-Identified-Payload-Type", mime)] + ([] if page is None else [("Page-Id", page)])
                    if refers is not None:
                        more += [
                            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                            ("WARC-Refers-To", record_id("record", refers["first_path"], refers["first_place"])),
                            ("WARC-Refers-To-Target-URI", refers["first_url"]), ("WARC-Refers-To-Date", iso(refers["first_date"])),
                            ("Refers-To-Page-Id", refers["first_page"]),
                        ]
                    block = http + b"\r\n\r\n" + block
                    out.append(member(warc(kind, record_id("record", arc, place), iso(date), more, "application/http; msgtype=response", block)))
                    if len(out) >= 256:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                        out = []
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    # the text writer puts its separator behind each row: the zero byte that every member ends with
    members = rows.select("path", "content", "revisits").mapInArrow(run, "value binary").select(F.col("value").cast("string"))
    with settings(spark, {"spark.sql.castBinaryToString.validateUtf8.enabled": "false"}):
        members.write.option("lineSep", "\0").option("maxRecordsPerFile", per_file + 1).text(path)


#: A gzip member of nothing.
_EMPTY = gzip.compress(b"", mtime=0)


def member(record: bytes) -> bytes:
    """A record as a gzip member without its last byte, which is zero: the
    highest one of its length, or of that of an empty member behind it."""
    out = gzip.compress(record, LEVEL, mtime=0)
    return out[:-1] if out[-1] == 0 else out + _EMPTY[:-1]


def warc(kind: str, ident: str, date: str, more: list[tuple], mime: str, block: bytes) -> bytes:
    """A record with its closing empty lines."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", ident), ("WARC-Date", date), *more]
    head += [("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Type", mime), ("Content-Length", len(block))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def parse_warc(raw: bytes):
    """(header fields, block) of each record of a WARC file."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        size = int(head["Content-Length"])
        yield head, raw[end + 4 : end + 4 + size]
        at = end + 4 + size + 4


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_warc(spark, path: str) -> DataFrame:
    """READ rows of the response and revisit records; a response's payload is
    digested anew and held against its header."""
    prepare(spark)

    def run(batches):
        for b in batches:
            for name, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows = []
                for head, block in parse_warc(_content(name, raw.as_py())):
                    kind = head["WARC-Type"]
                    if kind not in ("response", "revisit"):
                        continue
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                    size = int(re.search(rb"(?im)^Content-Length: (\d+)\r?$", http)[1])
                    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"{head['WARC-Record-ID']}: the payload is not the one that was archived")
                    page, refers = head.get("Page-Id"), head.get("Refers-To-Page-Id")
                    rows.append((page and int(page), size, digest, kind, refers and int(refers)))
                yield _batch(rows, READ)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, READ)


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written as ARC files of both versions, converted, read back."""
    spark = pages.sparkSession
    old = [work_dir(spark, f"arc{v}") for v in (1, 2)]
    odd = F.pmod(F.coalesce(F.col("page_id").cast("long"), F.lit(0)), F.lit(2))
    for v, path in zip((1, 2), old, strict=True):
        write_arc(pages.filter(odd == v - 1), path, v)
    new = work_dir(spark, "warc")
    convert(spark, old, new)
    return read_warc(spark, new)


ORACLE_SQL = """
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
    f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
    SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
           CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
    FROM p LEFT JOIN f ON p.d = f.d AND p.n >= 100"""
