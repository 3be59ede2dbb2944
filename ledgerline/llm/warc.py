"""Legacy web archives (ARC, versions 1 and 2) and their conversion to WARC.

An ARC file opens with a `filedesc://` record that names its version; every record is one header line of space-separated
fields, whose last is the declared length, then so many bytes and a newline. The converter follows version and lengths
and gives each record a WARC identifier, an ISO timestamp, a type and block and payload digests. Records whose payload
was met elsewhere become `revisit` records of the one with the largest page id; that is decided in Spark by digest. The
WARC files are written and read back by Spark's own file sources, so they can lie in any store.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import join_sized, shared_dir

#: Fixed values of the formats: field names of the two ARC versions and the WARC version and profile written here.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
WARC_VERSION = b"WARC/1.0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
PAGE_HEADER = "X-Page-Id"
UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def base32_sha1(raw: bytes) -> str:
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    """The same identifier for the same page and payload, so that a revisit can name it without looking it up."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>"


def arc_header(version: int, url: str, ip: str, date: str, kind: str, code: str, checksum: str, filename: str, offset: int, length: int) -> bytes:
    values = {"URL": url, "IP-address": ip, "Archive-date": date, "Content-type": kind, "Result-code": code, "Checksum": checksum, "Location": "-", "Offset": str(offset), "Filename": filename, "Archive-length": str(length)}
    return (" ".join(values[f] for f in ARC_FIELDS[version]) + "\n").encode()


def write_arc(rows, version: int, name: str, date: str = "19960101000000") -> bytes:
    """One ARC file of (page_id, url, payload) rows; the HTTP head carries page id and length."""
    names = f"{version} 0 ledgerline\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
    out = [arc_header(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", "200", "-", name, 0, len(names)), names, b"\n"]
    offset = sum(map(len, out))
    for page_id, url, payload in rows:
        uri = UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{'' if page_id is None else page_id}"
        block = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{PAGE_HEADER}: {'' if page_id is None else page_id}\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload
        out += [arc_header(version, uri, "0.0.0.0", date, "text/html", "200", "-", name, offset, len(block)), block, b"\n"]
        offset += sum(map(len, out[-3:]))
    return b"".join(out)


def read_arc(raw: bytes):
    """(fields, block) of every record after the file's own; raises on a header that its version does not know."""
    at, version, names = 0, None, []
    while at < len(raw):
        if raw[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = raw.index(b"\n", at)
        line = raw[at:end].decode("utf-8").rstrip("\r").split(" ")
        if version is None:
            if not line[0].startswith("filedesc://"):
                raise ValueError("an ARC file begins with its version record")
            length = int(line[-1])
            body = raw[end + 1 : end + 1 + length].decode("utf-8").split("\n")
            version = int(body[0].split(" ")[0])
            names = ARC_FIELDS.get(version) or body[1].split(" ")
            at = end + 1 + length
            continue
        if len(line) != len(names):
            raise ValueError(f"{len(line)} fields in a header of ARC version {version}")
        fields = dict(zip(names, line, strict=True))
        length = int(fields["Archive-length"])
        block = raw[end + 1 : end + 1 + length]
        if len(block) < length:
            raise ValueError("a record ends before its declared length")
        yield fields, block
        at = end + 1 + length


def http_parts(block: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """Head with its empty line, payload, and the head's fields in lower case."""
    cut = block.find(b"\r\n\r\n")
    head, payload = (block[: cut + 4], block[cut + 4 :]) if cut >= 0 else (b"", block)
    pairs = (x.split(":", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:] if ":" in x)
    return head, payload, {k.strip().lower(): v.strip() for k, v in pairs}


def iso_date(arc_date: str) -> str:
    d = arc_date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


CONVERTED = "page_id long, uri string, ip string, date string, head binary, payload binary, digest string"


def to_arc(pages: DataFrame, version: int | None = None, segment_rows: int = 500, segment_bytes: int = 4_000_000) -> DataFrame:
    """pages (page_id, url, html) -> (arc binary): ARC files of bounded size; without a version both are used in turn."""

    def run(batches):
        made = 0
        for pdf in batches:
            rows, size = [], 0
            for page_id, url, html in zip(pdf["page_id"], pdf["url"], pdf["html"], strict=True):
                payload = (html or "").encode("utf-8", "surrogatepass")
                rows.append((None if pd.isna(page_id) else int(page_id), url, payload))
                size += len(payload)
                if len(rows) >= segment_rows or size >= segment_bytes:
                    made += 1
                    yield pd.DataFrame({"arc": [write_arc(rows, version or 1 + made % 2, f"{made}.arc")]})
                    rows, size = [], 0
            if rows:
                made += 1
                yield pd.DataFrame({"arc": [write_arc(rows, version or 1 + made % 2, f"{made}.arc")]})

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInPandas(run, "arc binary")


def convert(arcs: DataFrame) -> DataFrame:
    """(arc binary) -> one row for each record, with what its WARC record needs."""

    def run(batches):
        for pdf in batches:
            for raw in pdf["arc"]:
                out = []
                for fields, block in read_arc(bytes(raw)):
                    head, payload, http = http_parts(block)
                    page = http.get(PAGE_HEADER.lower(), "")
                    out.append((int(page) if page else None, fields["URL"], fields["IP-address"], iso_date(fields["Archive-date"]), head, payload, base32_sha1(payload)))
                yield pd.DataFrame(out, columns=[c.split()[0] for c in CONVERTED.split(", ")]).astype({"page_id": "Int64"})

    return arcs.mapInPandas(run, CONVERTED)


def warc_record(r) -> bytes:
    """The bytes of one record; r has the columns of CONVERTED and `first`, the page it revisits or None."""
    revisit = r.first is not None
    block = r.head if revisit else r.head + r.payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(r.page_id, r.digest)),
        ("WARC-Date", r.date),
        ("WARC-Target-URI", r.uri),
        ("WARC-IP-Address", r.ip),
        ("WARC-Payload-Digest", f"sha1:{r.digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
    ]
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(r.first, r.digest)), ("X-Refers-To-Page-Id", str(r.first))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return WARC_VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def read_warc(raw: bytes):
    """(fields in lower case, block) of every record."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:end].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = {k.strip().lower(): v.strip() for k, v in (x.decode("utf-8").split(":", 1) for x in lines[1:])}
        length = int(fields["content-length"])
        yield fields, raw[end + 4 : end + 4 + length]
        at = end + 4 + length + 4


def write_warcs(records: DataFrame, path: str, records_per_file: int = 2000, most_broadcast: int = 200_000) -> None:
    """Write converted records as gzipped WARC files of at most records_per_file records under path.

    Of records with equal payloads that with the largest page id is a response and the others revisit it (rows that
    share that page id are all responses; payloads whose page ids are all null too).
    """
    repeated = records.groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 and first is not null").select("digest", "first")
    marked = join_sized(records, repeated, ["digest"], "left", most_broadcast)
    marked = marked.withColumn("first", F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first")))

    def run(batches):
        for pdf in batches:
            page, first = ([None if pd.isna(x) else int(x) for x in pdf[c]] for c in ("page_id", "first"))
            rows = pdf.assign(page_id=pd.Series(page, dtype=object, index=pdf.index), first=pd.Series(first, dtype=object, index=pdf.index))
            # the text source ends each row with a newline, which is a record's last byte
            yield pd.DataFrame({"record": [warc_record(r)[:-1] for r in rows.itertuples()]})

    written = marked.select("page_id", "uri", "ip", "date", "head", "payload", "digest", "first").mapInPandas(run, "record binary")
    written.select(F.col("record").cast("string").alias("value")).write.option("maxRecordsPerFile", records_per_file).option("compression", "gzip").option("lineSep", "\n").text(path)


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string, payload binary"


def read_warcs(spark, path: str, with_payload: bool = True) -> DataFrame:
    """Records of the WARC files under path; a response's payload is checked against its digest, a revisit has none."""

    def run(batches):
        for pdf in batches:
            for content in pdf["content"]:
                out = []
                for fields, block in read_warc(zlib.decompress(bytes(content), 31)):
                    _, payload, http = http_parts(block)
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    response = fields["warc-type"] == "response"
                    if response and base32_sha1(payload) != digest:
                        raise ValueError("a payload does not match its digest")
                    page, first = http.get(PAGE_HEADER.lower(), ""), fields.get("x-refers-to-page-id")
                    out.append((int(page) if page else None, len(payload) if response else int(http["content-length"]), digest, fields["warc-type"], int(first) if first else None, fields["warc-target-uri"], payload if response and with_payload else None))
                yield pd.DataFrame(out, columns=[c.split()[0] for c in READ.split(", ")]).astype({"page_id": "Int64", "refers_to": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInPandas(run, READ)


def archive(pages: DataFrame, path: str) -> DataFrame:
    """pages -> ARC -> WARC files under path -> the records read back.

    A null html is an empty payload, a null url the name urn:page:<id>, a null page id stays null (and is never revisited);
    white space and control characters of a url are percent-encoded. Repeated rows are written as often as given. No
    rows: no records. Other columns are ignored.
    """
    records = convert(to_arc(pages))
    write_warcs(records, path)
    return read_warcs(pages.sparkSession, path)


def op7_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    read = archive(pages, f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}")
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
