import hashlib

import pytest
import zstandard
import pyarrow.fs as pafs

from aurum.llm import warc as W
from aurum.session import scratch_path
from conftest import SF_SMALL

SCHEMA = "page_id bigint, url string, html string, digest int"
LONG = "x" * 120


def test_responses_and_revisits(spark):
    rows = [(5, "u", LONG, 0), (3, None, LONG, 0), (4, "a\r\nWARC-Type: metadata", LONG, 0), (None, "u", LONG, 0), (6, "u", "short", 0),
            (7, "u", "short", 0), (8, "u", None, 0), (9, "é", "é" * 60, 0), (10, "u", "é" * 60, 0), (3, "u", LONG, 0)]
    out = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in
                  W.warc_round_trip(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    want = [(5, 120, "revisit", 3), (3, 120, "response", None), (4, 120, "revisit", 3), (None, 120, "revisit", 3), (6, 5, "response", None),
            (7, 5, "response", None), (8, 0, "response", None), (9, 120, "response", None), (10, 120, "revisit", 9), (3, 120, "response", None)]
    assert out == sorted(want, key=str)
    assert W.warc_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_archives_open_with_a_plain_reader(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    folder = scratch_path(spark, "warc")
    manifest = W.write_warc(pages, folder, archive_bytes=100_000).collect()
    assert len(manifest) > 1 and sum(m.records for m in manifest) == pages.count()
    html = {r.page_id: r.html for r in pages.collect()}
    fs, base = pafs.FileSystem.from_uri(folder)
    for m in manifest:
        raw = fs.open_input_file(f"{base}/{m.file}").read()
        assert raw[:4] == (0x184D2A5D).to_bytes(4, "little")
        size = int.from_bytes(raw[4:8], "little")
        d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8:8 + size]))
        one = d.decompressobj()                                # the first record alone
        assert one.decompress(raw[8 + size:]).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    seen = 0
    for m in manifest:
        for head, block in W.read_archive(folder, m.file):
            if head["WARC-Type"] == "response":
                payload = block.split(b"\r\n\r\n", 1)[1]
                assert payload.decode() == html[int(head["X-Page-Id"])]
                assert head["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(payload).hexdigest()
                seen += 1
    assert seen > 0


def test_the_dictionary_pays(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    d = W.train_dictionary(pages)
    texts = [r.html.encode() for r in pages.collect()]
    plain, with_d = zstandard.ZstdCompressor(3), zstandard.ZstdCompressor(3, dict_data=zstandard.ZstdCompressionDict(d))
    assert sum(len(with_d.compress(t)) for t in texts) < sum(len(plain.compress(t)) for t in texts)


def test_damage_is_noticed(spark):
    folder = scratch_path(spark, "warc")
    file = W.write_warc(spark.createDataFrame([(1, "u", LONG, 0)], SCHEMA), folder).first().file
    fs, base = pafs.FileSystem.from_uri(folder)
    raw = fs.open_input_file(f"{base}/{file}").read()
    with fs.open_output_stream(f"{base}/cut.warc.zst", compression=None) as out:
        out.write(raw[:-9])
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(W.read_archive(folder, "cut.warc.zst"))


def test_the_driver_gets_no_more_payload_than_the_sample_bound(spark, monkeypatch):
    monkeypatch.setattr(W, "SAMPLE_BYTES", 30_000)
    rows = [(i, "u", f"<p>page {i}</p>" + "some common words " * (5000 if i % 3 == 0 else 40), 0) for i in range(60)]
    pages, got = spark.createDataFrame(rows, SCHEMA), []
    real = type(pages).toLocalIterator

    def counted(self, *args, **kw):
        for r in real(self, *args, **kw):
            got.append(len(r.html.encode()))
            yield r
    monkeypatch.setattr(type(pages), "toLocalIterator", counted)
    assert W.train_dictionary(pages)
    assert 16 <= len(got) and sum(got) <= 30_000
