import io
import zipfile

import pyarrow as pa
import pytest

from paymart.llm import warc_zip


def pages(spark, *rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id LONG, url STRING, html STRING, text STRING")


def test_records_come_back(spark):
    rows = [(i, f"http://h/{i} ü{{}}\n", f"<p>{i % 5} é</p>" * (1 + i % 3)) for i in range(60)] + [(100, None, None), (101, "u", ""), (None, "u", "")]
    archives = warc_zip.write_archives(pages(spark, *rows), archive_bytes=2000)
    assert archives.count() > 3
    found = warc_zip.read_records(archives).collect()
    assert len(found) == len(rows)
    largest = {}
    for i, _, html in rows:
        largest[html or ""] = max(largest.get(html or "", -1), -1 if i is None else i)
    by_id = {r["page_id"]: r for r in found}
    for i, _, html in rows:
        row, data = by_id[i], (html or "").encode()
        first = largest[html or ""] == i
        assert (row["record_type"], row["refers_to"]) == (("response", None) if first else ("revisit", largest[html or ""]))
        assert (row["payload_bytes"], row["payload_digest"]) == (len(data), warc_zip.base32_sha1(data))
        assert (None if row["payload"] is None else bytes(row["payload"])) == (data if first else None)
    assert by_id[0]["url"] == "http://h/0%20%C3%BC%7B%7D%0A" and by_id[100]["url"] is None


def test_writing_again_gives_equal_archives(spark, tmp_path):
    rows = [(i, "u", f"{i % 3}") for i in range(20)]
    sizes = []
    for _ in range(2):
        folder = f"file://{tmp_path}/out"
        warc_zip.write_archives(pages(spark, *rows), folder)
        sizes.append({p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()})
    assert sizes[0] == sizes[1] and all(n.endswith(".wacz") for n in sizes[0])


def test_ties_of_ids_and_empty_table(spark):
    found = warc_zip.read_records(warc_zip.write_archives(pages(spark, (1, "a", "p"), (1, "b", "p"), (0, "c", "p")))).collect()
    assert sorted((r["page_id"], r["record_type"]) for r in found) == [(0, "revisit"), (1, "response"), (1, "response")]
    assert warc_zip.read_records(warc_zip.write_archives(pages(spark))).collect() == []


@pytest.mark.parametrize("wide", [False, True])
def test_directories_with_and_without_zip64(monkeypatch, wide):
    if wide:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        for k in range(5):
            archive.writestr(f"archive/{k}-é.warc.gz", bytes([k]) * (20 + k))
        archive.writestr("indexes/index.cdx", b"text " * 50, zipfile.ZIP_DEFLATED)
        archive.comment = b"PK\x05 comment"
    data = out.getvalue()
    assert (b"PK\x06\x06" in data) == wide
    directory = warc_zip.ZipDirectory(pa.PythonFile(io.BytesIO(data), "r"))
    for k in range(5):
        member = directory.members[f"archive/{k}-é.warc.gz"]
        assert directory.read(directory.start(member) + 1, 3) == bytes([k]) * 3 and member.size == 20 + k
    assert directory.content(directory.members["indexes/index.cdx"]) == b"text " * 50


def test_what_is_no_archive_fails():
    with pytest.raises(ValueError, match="no end of central directory"):
        warc_zip.ZipDirectory(pa.PythonFile(io.BytesIO(b"nothing"), "r"))
