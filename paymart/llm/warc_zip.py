"""WARC records in ZIP-packaged archives, written by tasks and read by ranges.

An archive is a ZIP file with stored WARC members (every record compressed on
its own) and an index member that names member, offset and length of each
record. Reading fetches the end of the file, the (ZIP64) central directory and
the index, and then each record by its own range; nothing is extracted.

Files are reached through ``pyarrow.fs``, by the URI of the shared folder. A
task writes under a name of its own and then moves the file, so a task that is
run again only replaces a whole file by an equal one.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import struct
import urllib.parse
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paymart.llm.shared import staged
from paymart.session import scratch_path

ARCHIVE_BYTES = 16 << 20  # of payload; a group of that size is held in memory
MEMBER_BYTES = 8 << 20  # of compressed records
READ_RECORDS = 256  # that one read task item covers
INDEX = "indexes/index.cdxj"
DATE = "2024-01-01T00:00:00Z"  # pages have no date; a fixed one keeps archives equal on every run
ARCHIVES = "archive string, records long, bytes long"
RECORD = "archive string, member string, offset long, length long, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def _page_id(name: str | None) -> int | None:
    number = (name or "none").strip("<>").rpartition(":")[2]
    return None if number == "none" else int(number)


def warc_record(page_id: int | None, url: str | None, payload: bytes, response: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP header, with the full length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _name(page_id),
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]"),
        "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
        "WARC-Refers-To": _name(response) if revisit else None,
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None,
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _open(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


def _write(folder: str):
    def run(pages: pa.Table, decisions: pa.Table) -> pa.Table:
        if not pages.num_rows:
            return pa.table({"archive": pa.array([], pa.string()), "records": pa.array([], pa.int64()), "bytes": pa.array([], pa.int64())})
        number = pages["archive"][0].as_py()
        response = {(r["page_id"], r["digest"]): r["response"] for r in decisions.to_pylist()}
        out, index, member, packed, count, size = io.BytesIO(), [], 0, [], 0, 0
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:

            def add(name: str, data: bytes) -> None:
                archive.writestr(zipfile.ZipInfo(name), data)

            for row in pages.sort_by([("page_id", "ascending"), ("digest", "ascending")]).to_pylist():
                page_id = row["page_id"]
                first = response[page_id, row["digest"]]
                record = warc_record(page_id, row["url"], (row["html"] or "").encode(), first, first != page_id)
                data = _gzip(record)
                name = f"archive/data-{member:05d}.warc.gz"
                index.append(f"{urllib.parse.quote(row['url'] or '-')} {json.dumps({'filename': name, 'offset': size, 'length': len(data)})}")
                packed.append(data)
                size += len(data)
                count += 1
                if size >= MEMBER_BYTES:
                    add(name, b"".join(packed))
                    member, packed, size = member + 1, [], 0
            if packed:
                add(f"archive/data-{member:05d}.warc.gz", b"".join(packed))
            add(INDEX, "".join(f"{line}\n" for line in index).encode())
            add("datapackage.json", json.dumps({"profile": "data-package", "wacz_version": "1.1.1"}).encode())
        data = out.getvalue()
        fs, path = _open(folder)
        fs.create_dir(path, recursive=True)
        target = f"{path}/part-{number:08d}.wacz"
        temporary = f"{path}/.{uuid.uuid4().hex}"
        with fs.open_output_stream(temporary) as file:
            file.write(data)
        fs.move(temporary, target)
        uri = f"{folder}/part-{number:08d}.wacz"
        return pa.table({"archive": [uri], "records": [count], "bytes": [len(data)]})

    return run


def write_archives(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) to archives; one row per archive (archive, records, bytes).

    Of rows with equal html the one with the largest page_id becomes the
    response and the others revisit it; a null html is empty, a null page_id is
    smaller than all others. Rows that share that page_id are all responses.
    Blanks, control characters and the like in a url are percent-encoded. An
    empty table gives no archives. ``folder`` must be reachable from all
    executors and defaults to a fresh one in the shared folder.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "archives")
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    size = pages.agg(F.sum(F.octet_length("html") + 256).alias("size")).first()["size"] or 0
    number = F.pmod(F.xxhash64("page_id"), F.lit(max(1, -(-size // archive_bytes)))).cast("int")
    pages = pages.withColumn("archive", number)
    known = staged(pages.select("page_id", "digest", "archive"), "page-digests")
    largest = staged(known.groupBy("digest").agg(F.max("page_id").alias("response")), "responses")
    decisions = known.join(largest, "digest").select("archive", "page_id", "digest", "response").distinct()
    written = (
        pages.groupBy("archive").cogroup(decisions.groupBy("archive")).applyInArrow(_write(folder), ARCHIVES)
    )
    return staged(written, "archive-list")


@dataclass
class Member:
    name: str
    method: int
    size: int  # as stored
    header: int  # offset of the local header


class ZipDirectory:
    """The central directory of a ZIP file, ZIP64 or not, read from its end."""

    def __init__(self, file: pa.NativeFile):
        self.file, size = file, file.size()
        tail_at = max(0, size - (1 << 16) - 22 - 20)
        tail = self.read(tail_at, size - tail_at)
        end = tail.rfind(b"PK\x05\x06")
        if end < 0:
            raise ValueError("not a ZIP file: no end of central directory")
        entries, length, start = struct.unpack_from("<10xHII", tail, end)
        locator = end - 20
        if locator >= 0 and tail[locator : locator + 4] == b"PK\x06\x07":
            (at,) = struct.unpack_from("<8xQ", tail, locator)
            entries, length, start = struct.unpack("<32xQQQ", self.read(at, 56))
        self.members: dict[str, Member] = {}
        directory, at = self.read(start, length), 0
        for _ in range(entries):
            if directory[at : at + 4] != b"PK\x01\x02":
                raise ValueError("damaged central directory")
            flags, method, packed, full, n_name, n_extra, n_comment, header = struct.unpack_from(
                "<8xHH8xIIHHH8xI", directory, at
            )
            at += 46
            name = directory[at : at + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            extra = directory[at + n_name : at + n_name + n_extra]
            at += n_name + n_extra + n_comment
            packed, header = self._wide(extra, full, packed, header)
            self.members[name] = Member(name, method, packed, header)

    @staticmethod
    def _wide(extra: bytes, full: int, packed: int, header: int) -> tuple[int, int]:
        """Stored size and offset, from the ZIP64 field where the short ones are full."""
        at = 0
        while at + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, at)
            if kind == 1:
                place = at + 4
                values = []
                for short in (full, packed, header):
                    if short == 0xFFFFFFFF:
                        values.append(struct.unpack_from("<Q", extra, place)[0])
                        place += 8
                    else:
                        values.append(short)
                return values[1], values[2]
            at += 4 + n
        return packed, header

    def read(self, offset: int, length: int) -> bytes:
        data = self.file.read_at(length, offset)
        if len(data) != length:
            raise ValueError("the file ends too early")
        return data

    def start(self, member: Member) -> int:
        """Where the data of a member begin; its local header says how long it is itself."""
        head = self.read(member.header, 30)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"damaged local header of {member.name}")
        n_name, n_extra = struct.unpack_from("<26xHH", head)
        return member.header + 30 + n_name + n_extra

    def content(self, member: Member) -> bytes:
        """A whole member, for indexes."""
        data = self.read(self.start(member), member.size)
        if member.method == 8:
            return zlib.decompress(data, -15)
        if member.method:
            raise ValueError(f"{member.name} has compression method {member.method}")
        return data


def _list_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads the indexes and hands out ranges of a few hundred records each."""
    for batch in batches:
        for uri in batch.column("archive").to_pylist():
            fs, path = _open(uri)
            with fs.open_input_file(path) as file:
                directory = ZipDirectory(file)
                starts, rows = {}, []
                for member in directory.members.values():
                    if not (member.name.startswith("indexes/") and member.name.endswith((".cdx", ".cdxj"))):
                        continue
                    for line in directory.content(member).decode().splitlines():
                        entry = json.loads(line[line.index("{") :])
                        name = entry["filename"]
                        if name not in starts:
                            if directory.members[name].method:
                                raise ValueError(f"{name} is not stored")
                            starts[name] = directory.start(directory.members[name])
                        rows.append((name, starts[name] + int(entry["offset"]), int(entry["length"])))
            for first in range(0, len(rows), READ_RECORDS):
                names, offsets, lengths = zip(*rows[first : first + READ_RECORDS], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([uri]),
                        pa.array([list(names)], pa.list_(pa.string())),
                        pa.array([list(offsets)], pa.list_(pa.int64())),
                        pa.array([list(lengths)], pa.list_(pa.int64())),
                    ],
                    ["archive", "members", "offsets", "lengths"],
                )


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields (names in lower case) and payload of one record."""
    head, _, rest = zlib.decompress(data, 31).partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(": ")
        fields[name.lower()] = value
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    web = {}
    for line in http.decode().split("\r\n")[1:]:
        name, _, value = line.partition(": ")
        web[name.lower()] = value
    return fields, web, payload


def _read_records(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RECORD.split(", ")] + ["payload"] * with_payload
        kinds = [{"string": pa.string(), "long": pa.int64()}[f.split()[1]] for f in RECORD.split(", ")]
        kinds += [pa.binary()] * with_payload
        for batch in batches:
            for item in batch.to_pylist():
                fs, path = _open(item["archive"])
                rows = []
                with fs.open_input_file(path) as file:
                    for member, offset, length in zip(item["members"], item["offsets"], item["lengths"], strict=True):
                        fields, web, payload = parse_record(file.read_at(length, offset))
                        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "response" and base32_sha1(payload) != digest:
                            raise ValueError(f"{path}: record at {offset} does not match its digest")
                        row = (
                            item["archive"], member, offset, length, _page_id(fields["warc-record-id"]),
                            fields.get("warc-target-uri"), kind,
                            _page_id(fields["warc-refers-to"]) if kind == "revisit" else None,
                            int(web["content-length"]), digest,
                        )
                        rows.append(row + (payload if kind == "response" else None,) * with_payload)
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def read_records(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of ``archives`` (archive: URI): its place, fields and, unless left out, payload.

    archive, member, offset (in the file), length, page_id, url, record_type,
    refers_to, payload_bytes, payload_digest, payload (null for a revisit). The
    payload of a response is checked against its digest. A damaged archive or a
    compressed WARC member fails the job. An archive's records are shared out
    in ranges, so a large one is read by many tasks.
    """
    ranges = archives.select("archive").mapInArrow(
        _list_records, "archive string, members array<string>, offsets array<long>, lengths array<long>"
    )
    # A range is a few bytes for a lot of reading: a number keeps the adaptive plan from packing them together.
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges.repartition(tasks, "archive", F.col("offsets")[0])
    return ranges.mapInArrow(_read_records(with_payload), RECORD + ", payload binary" * with_payload)
