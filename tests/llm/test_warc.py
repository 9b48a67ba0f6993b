import hashlib
import struct

import pytest
import zstandard

from ledgerlens.llm import warc

PAGES = "page_id long, url string, html string, payload string, content string"


def pages(spark):
    big, other = "<p>é</p>" * 400, "x" * 1000
    rows = [(1, "http://a/", big), (2, None, big), (3, "http://b/\r\nX: 1", big), (4, "u", "short"), (5, "u", "short"),
            (6, "", None), (7, "u", ""), (8, "u", other), (8, "u", other), (None, "u", other), (9, "u", "y" * 999),
            (10, "u", "y" * 999), (None, "u", "z" * 2000), (11, "u", "w" * 400_000)]
    return rows, spark.createDataFrame([(*r, "p", "c") for r in rows], PAGES)


def expected(rows):
    newest = {}
    for page, _, html in rows:
        if page is not None:
            newest[html] = max(newest.get(html, page), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = newest.get(html) if len(data) >= 1000 else None
        revisit = first is not None and page != first
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    rows, df = pages(spark)
    found = warc.round_trip(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_files_and_payloads(spark, tmp_path):
    rows, df = pages(spark)
    for r in warc.write_archives(warc.plan_records(df), archive_bytes=4000).collect():
        (tmp_path / r["archive"]).write_bytes(r["content"])
    assert len(list(tmp_path.iterdir())) > 1
    found = warc.read_files(spark, str(tmp_path)).where("record_type = 'response'").select("page_id", "payload")
    kept = {(e[0], e[2]) for e in expected(rows) if e[3] == "response"}
    assert sorted(((r[0], bytes(r[1])) for r in found.collect()), key=repr) == sorted(
        ((p, (h or "").encode()) for p, _, h in rows if (p, hashlib.sha1((h or "").encode()).hexdigest()) in kept), key=repr)


def records(n=400):
    out = []
    for i in range(n):
        body = (f"<html>page {i} " + "shared words of every page " * 20 + "</html>").encode()
        out.append(warc.encode_record(i, f"http://h/{i}", body, len(body), hashlib.sha1(body).hexdigest(), None, "2024-01-01T00:00:00Z"))
    return out


def test_dictionary_leads_in_a_skippable_frame():
    made = records()
    archive = warc.encode_archive(made)
    assert struct.unpack_from("<I", archive)[0] == warc.SKIPPABLE
    assert list(warc.frames(archive)) == made
    size = struct.unpack_from("<I", archive, 4)[0]
    raw = zstandard.ZstdDecompressor().decompress(archive[8:8 + size])
    plain = struct.pack("<II", warc.SKIPPABLE, len(raw)) + raw + archive[8 + size:]
    assert list(warc.frames(plain)) == made  # an uncompressed dictionary is allowed too
    assert list(warc.frames(warc.encode_archive(made[:1]))) == made[:1]  # too little to train on
    assert list(warc.frames(b"")) == []


@pytest.mark.parametrize("harm", [
    lambda r: r.replace(b"WARC/1.1", b"WRONG/1.1"), lambda r: r[:-2], lambda r: r + b"x",
    lambda r: r.replace(b"page 3 ", b"page X "), lambda r: r.replace(b"WARC-Date", b"Other-Name"),
    lambda r: r.replace(b"sha1:", b"md5:"), lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: unknown"),
    lambda r: r.replace(b"Content-Length: ", b"Content-Length: 9", 1)])
def test_broken_records_are_named(harm):
    with pytest.raises(warc.BadArchive):
        warc.decode_record(harm(records(4)[3]))


def test_broken_archives_are_named():
    archive = warc.encode_archive(records())
    for broken in (archive[:-3], archive[:20], archive + b"rest", archive[:-40] + b"\0" * 40):
        with pytest.raises(warc.BadArchive):
            list(warc.frames(broken))
