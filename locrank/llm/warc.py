"""WARC records in ZIP packages: written by tasks, read back by byte ranges.

A package is a ZIP archive with one stored member of gzipped WARC records, archive/data.warc.gz, and
one stored index, indexes/index.cdxj, whose lines say where each record starts. Readers find the
members through the central directory, in its ZIP64 form if there is one, and read single records
out of the archive: nothing is extracted, and an archive may be larger than memory.
"""

import gzip
import hashlib
import json
import posixpath
import struct
import zipfile
from contextlib import contextmanager
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import functions as F

from locrank.llm.words import keep
from locrank.storage import scratch_dir

#: Payload bytes after which a task starts another package.
PACKAGE_BYTES = 128_000_000
#: Smaller payloads are stored in every record that has them.
MIN_REVISIT_BYTES = 100
#: Bytes of neighbouring records that are fetched at once.
RANGE_BYTES = 4_000_000

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"

_END, _END64, _LOCATOR64, _ENTRY, _LOCAL = (
    b"PK\x05\x06",
    b"PK\x06\x06",
    b"PK\x06\x07",
    b"PK\x01\x02",
    b"PK\x03\x04",
)


def _system(folder):
    """The file system of a folder and its path there; plain paths are local ones."""
    if "://" in folder or folder.startswith("file:"):
        return pa.fs.FileSystem.from_uri(folder)
    return pa.fs.LocalFileSystem(), folder


# Writing


def _record(kind, headers, http, payload):
    block = http + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers.items())]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", 3, mtime=0)


def _page_record(page, url, payload, digest, first):
    """The record of a page; first is the page whose payload it repeats, or None."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    headers = {
        "WARC-Record-ID": f"<urn:page:{quote(json.dumps(page))}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": quote(url or "", safe=":/?#[]@!$&'()*+,;="),
        "WARC-Payload-Digest": f"sha256:{digest}",
    }
    if first is None:
        return _record("response", headers, http, payload)
    headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    headers["WARC-Refers-To"] = f"<urn:page:{quote(json.dumps(first))}>"
    return _record("revisit", headers, http, b"")


@contextmanager
def _package(system, path):
    """A stream for the data member and a list for index lines; the archive appears when complete."""
    part = f"{path}.part"
    with system.open_output_stream(part) as out:
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as archive:
            lines = []
            with archive.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as stream:
                yield stream, lines
            archive.writestr(zipfile.ZipInfo(INDEX), "".join(lines))
    system.move(part, path)


def _write(folder, package_bytes):
    def write(batches):
        system, root = _system(folder)
        context = TaskContext.get()
        number, package, size, paths = 0, None, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if package is None:
                    path = f"{root}/part-{context.partitionId():06d}-{number:04d}-{context.taskAttemptId()}.wacz"
                    package = _package(system, path)
                    stream, lines = package.__enter__()
                    paths.append(posixpath.join(folder, posixpath.basename(path)))
                    number, size, offset = number + 1, 0, 0
                payload = (row["html"] or "").encode()
                record = _page_record(row["page_id"], row["url"], payload, row["digest"], row["first"])
                stream.write(record)
                lines.append(json.dumps({"offset": offset, "length": len(record)}) + "\n")
                size, offset = size + len(payload), offset + len(record)
                if size >= package_bytes:
                    package.__exit__(None, None, None)
                    package = None
        if package is not None:
            package.__exit__(None, None, None)
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], names=["path"])

    return write


def planned(pages):
    """pages(page_id, url, html) with digest and first: the page a record repeats, else null.

    Digests are grouped with their smallest page in the map tasks; only those of several pages are
    joined back, as a written table, so that a payload of very many pages is one row per task in the
    grouping and can be split in the join.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html", F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("size"))
    large = rows.where(F.col("size") >= MIN_REVISIT_BYTES).select("digest", "page_id")
    several = large.groupBy("digest").agg(F.min("page_id").alias("smallest"), F.count("*").alias("pages"))
    several = keep(several.where("pages > 1").select("digest", "smallest"), "warc-repeated")
    joined = rows.join(several, "digest", "left")
    first = F.when((F.col("size") >= MIN_REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("smallest")), F.col("smallest"))
    return joined.select("page_id", "url", "html", "digest", first.alias("first"))


def write_packages(pages, folder, package_bytes=PACKAGE_BYTES):
    """Write a record per row of pages(page_id, url, html) into ZIP packages; returns their paths.

    Of records with equal payloads of MIN_REVISIT_BYTES or more, that of the smallest page_id is a
    response, the others revisit it.

    * A null html is an empty payload, a null url an empty one. A null page_id is never the
      smallest; pages without any page_id and equal payloads are all responses.
    * Repeated rows of the smallest page_id are all responses.
    * Empty pages give no package; other columns are ignored.

    A task streams its rows to files of about package_bytes, which get their names when complete. A
    task that runs again may see its rows in another order, so each attempt has files of its own; the
    paths are those of the attempts whose results count, and other files are never read.
    """
    system, root = _system(folder)
    system.create_dir(root, recursive=True)
    return keep(planned(pages).mapInArrow(_write(folder, package_bytes), "path string"), "warc-packages")


# Reading


def members(source):
    """Name -> (offset, size) of the stored members of an open ZIP archive, from its directories."""
    size = source.size()
    source.seek(max(0, size - 65_557))
    tail = source.read()
    at = tail.rfind(_END)
    if at < 0:
        raise ValueError("not a ZIP archive")
    count, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
    if at >= 20 and tail[at - 20 : at - 16] == _LOCATOR64:
        source.seek(struct.unpack("<Q", tail[at - 12 : at - 4])[0])
        record = source.read(56)
        if record[:4] != _END64:
            raise ValueError("the ZIP64 directory is not where its locator says")
        count, length, start = struct.unpack("<QQQ", record[32:56])
    source.seek(start)
    directory, at, found = source.read(length), 0, {}
    for _ in range(count):
        if directory[at : at + 4] != _ENTRY:
            raise ValueError("the central directory is damaged")
        method = struct.unpack("<H", directory[at + 10 : at + 12])[0]
        stored, full = struct.unpack("<II", directory[at + 20 : at + 28])
        name_size, extra_size, comment_size = struct.unpack("<HHH", directory[at + 28 : at + 34])
        header = struct.unpack("<I", directory[at + 42 : at + 46])[0]
        name = directory[at + 46 : at + 46 + name_size].decode()
        extra = directory[at + 46 + name_size : at + 46 + name_size + extra_size]
        full, stored, header = _wide(extra, full, stored, header)
        if method == 0:
            source.seek(header)
            local = source.read(30)
            if local[:4] != _LOCAL:
                raise ValueError("a member is not where the directory says")
            found[name] = (header + 30 + sum(struct.unpack("<HH", local[26:30])), stored)
        at += 46 + name_size + extra_size + comment_size
    return found


def _wide(extra, *values):
    """Sizes and offset, those that do not fit into 32 bits taken from the ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack("<HH", extra[at : at + 4])
        if kind == 1:
            wide = iter(struct.unpack(f"<{size // 8}Q", extra[at + 4 : at + 4 + size // 8 * 8]))
            return [next(wide) if value == 0xFFFFFFFF else value for value in values]
        at += 4 + size
    return list(values)


def _parsed(data):
    """Headers, HTTP headers and payload of a gzipped record."""
    head, _, block = gzip.decompress(data).partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = block[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    return headers, fields, payload


def _page(urn):
    return json.loads(unquote(urn[len("<urn:page:") : -1]))


def _page_row(data):
    headers, http, payload = _parsed(data)
    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].split(":")[1]
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload and digest of {headers['WARC-Record-ID']} differ")
    first = _page(headers["WARC-Refers-To"]) if kind == "revisit" else None
    size = len(payload) if kind == "response" else int(http["Content-Length"])
    html = payload.decode() if kind == "response" else None
    return _page(headers["WARC-Record-ID"]), unquote(headers["WARC-Target-URI"]), size, digest, kind, first, html


def _locate(batches):
    """Byte ranges of neighbouring records, from the index of each package."""
    for batch in batches:
        for path in batch.column("path").to_pylist():
            system, name = _system(path)
            with system.open_input_file(name) as source:
                found = members(source)
                (data, _), (index, size) = found[DATA], found[INDEX]
                source.seek(index)
                rows = [json.loads(line) for line in source.read(size).splitlines()]
            ranges = []
            for row in rows:
                if not ranges or ranges[-1][1] + row["length"] > RANGE_BYTES:
                    ranges.append([data + row["offset"], 0, []])
                ranges[-1][1] += row["length"]
                ranges[-1][2].append(row["length"])
            starts, lengths, records = zip(*ranges) if ranges else ((), (), ())
            columns = [pa.array([path] * len(starts), pa.string()), pa.array(starts, pa.int64())]
            columns += [pa.array(lengths, pa.int64()), pa.array(records, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "start", "length", "records"])


def _fetch(kind):
    def fetch(batches):
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]
        kinds = [kind, pa.string(), pa.int64(), pa.string(), pa.string(), kind, pa.string()]
        for batch in batches:
            for part in batch.to_pylist():
                system, name = _system(part["path"])
                with system.open_input_file(name) as source:
                    source.seek(part["start"])
                    data = source.read(part["length"])
                rows, at = [], 0
                for length in part["records"]:
                    rows.append(_page_row(data[at : at + length]))
                    at += length
                arrays = [pa.array(values, k) for values, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return fetch


def read_packages(packages, page_id="long"):
    """Records of packages(path): page_id, url, payload_bytes, payload_digest, record_type, refers_to, html.

    payload_bytes and payload_digest are of the full payload, also for a revisit, whose html is null.
    A digest that does not fit its payload is an error. page_id names the type of the ids.

    The indexes are read first and give byte ranges of RANGE_BYTES at most; these are dealt out to
    tasks, each of which fetches its ranges, so one large package is read by many tasks.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    spark = packages.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges = packages.repartition(parts, "path").mapInArrow(_locate, "path string, start long, length long, records array<long>")
    layout = f"page_id {page_id}, url string, payload_bytes long, payload_digest string, record_type string, refers_to {page_id}, html string"
    dealt = ranges.repartition(parts, "path", "start")
    return dealt.mapInArrow(_fetch(to_arrow_type(_parse_datatype_string(page_id))), layout)


def op7_warc(spark, sf_dir):
    """Write the pages to packages in the shared folder and read their records back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    packages = write_packages(pages, scratch_dir(spark, "warc"))
    return read_packages(packages, dict(pages.dtypes)["page_id"]).drop("url", "html")


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p GROUP BY html)
SELECT page_id, octet_length(encode(p.html)) AS payload_bytes, sha256(p.html) AS payload_digest,
  CASE WHEN octet_length(encode(p.html)) >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN octet_length(encode(p.html)) >= 100 AND page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (html)
"""
