"""Archive files are bounded without cutting a record."""

from __future__ import annotations

import hashlib

import pytest

from depotlens.llm import warc_chunks
from depotlens.session import settle


@pytest.mark.parametrize("session_bound", ["0", "2"])
def test_files_end_between_records(spark, tmp_path, monkeypatch, session_bound):
    monkeypatch.setattr(warc_chunks, "FILE_CHUNKS", 3)
    texts = [f"page {i} " + "\r\n\r\nword " * (i * 7) for i in range(40)]
    pages = spark.createDataFrame([(i, f"http://h/{i}", t) for i, t in enumerate(texts)], "page_id long, url string, html string")
    chunks = settle(warc_chunks.chunk_table(pages, size=64))
    longest = max(len(t.encode()) for t in texts)
    assert chunks.count() > 3 * 200 and longest > 3 * 64
    spark.conf.set("spark.sql.files.maxRecordsPerFile", session_bound)
    try:
        warc_chunks.write_archives(chunks, warc_chunks.decide_types(chunks), f"{tmp_path}/archives")
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert len(list((tmp_path / "archives").glob("part-*"))) > 20
    back = {r.page_id: r for r in warc_chunks.read_archives(spark, f"{tmp_path}/archives").collect()}
    assert {i: r.payload_digest for i, r in back.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in enumerate(texts)}
