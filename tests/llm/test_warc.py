from __future__ import annotations

import hashlib

import pytest
import zstandard
from pyspark.sql import functions as F

from vaultline.llm import warc
from vaultline.llm.warc import archive_head, archived_pages, build_dictionary, parse, read_archive, read_archives, record, write_archives
from vaultline.session import scratch_dir

LONG = "<p>some words of a page</p>" * 20


def pages(spark, *rows):
    return spark.createDataFrame([(*row, "extra") for row in rows], "page_id bigint, url string, html string, digest string")


def test_record_round_trip():
    data = record(7, "http://h/ä b%?\r\nX: y", b"pay\r\n\r\nload", "d" * 64, 11, None)
    headers, block = parse(data)
    assert headers["WARC-Type"] == "response"
    assert headers["WARC-Target-URI"] == "http://h/%C3%A4%20b%25?%0D%0AX:%20y"
    assert block.endswith(b"\r\n\r\npay\r\n\r\nload")
    headers, block = parse(record(8, None, b"", "d" * 64, 11, 7))
    assert headers["WARC-Type"] == "revisit"
    assert headers["WARC-Refers-To-Page"] == "7"
    assert headers["WARC-Refers-To"] == warc.record_id(7)
    with pytest.raises(ValueError, match="cut short"):
        parse(data[:-5])


@pytest.mark.parametrize("samples", [0, 3, 400])
def test_archive_carries_its_dictionary(samples):
    records = [record(i, f"http://h/{i}", (LONG + str(i)).encode(), "d" * 64, 1, None) for i in range(400)]
    dictionary = build_dictionary(records[:samples])
    packer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    data = archive_head(dictionary) + b"".join(packer.compress(r) for r in records)
    assert [parse(r) for r in records] == list(read_archive(data))
    if samples == 400:
        assert data[:4] == b"\x5d\x2a\x4d\x18"
        plain = zstandard.ZstdCompressor()
        assert len(data) - len(dictionary) < sum(len(plain.compress(r)) for r in records)
    with pytest.raises(ValueError, match="cut short"):
        list(read_archive(data[:-3]))


def test_pages_round_trip(spark):
    rows = [(5, "u5", LONG), (3, "u3", LONG), (9, None, LONG), (1, "u1", "short"), (2, "u2", "short"), (4, "u4", None)]
    rows += [(6, "u6", "ä" * 60 + "\x00"), (None, "u", LONG), (None, "u", LONG), (8, "", "y" * 300_000)]
    got = archived_pages(pages(spark, *rows)).collect()
    expected = []
    for page, url, html in rows:
        data = (html or "").encode()
        first = min((p for p, _, h in rows if p is not None and (h or "") == (html or "")), default=None)
        revisit = len(data) >= 100 and page is not None and first < page
        kind, refers = ("revisit", first) if revisit else ("response", None)
        expected.append((page, url, len(data), hashlib.sha256(data).hexdigest(), kind, refers))
    columns = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got))) == sorted(map(str, expected))


def test_small_archives_and_empty_table(spark):
    rows = pages(spark, *((i, f"u{i}", f"{LONG}{i}") for i in range(60)))
    folder = f"file://{scratch_dir(spark, 'warc-test').removeprefix('file://')}"
    written = write_archives(rows, folder, archive_bytes=500)
    assert written.count() > 5
    assert written.agg(F.sum("records")).first()[0] == 60
    assert read_archives(spark, folder).count() == 60
    assert archived_pages(rows.limit(0)).count() == 0


def test_damage_is_found(spark, monkeypatch):
    rows = pages(spark, (1, "u", LONG))
    folder = f"file://{scratch_dir(spark, 'warc-test').removeprefix('file://')}"
    monkeypatch.setattr(warc, "record", lambda *a: record(*a[:2], b"other", *a[3:]))
    write_archives(rows, folder)
    with pytest.raises(Exception, match="differs from its digest"):
        read_archives(spark, folder).collect()
