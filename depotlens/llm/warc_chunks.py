"""WARC archives from and to a chunked record table.

Payloads become rows of (record, chunk number, bytes), each with the digest of the payload up to and with the
chunk, so no step but the reading of the input row holds a payload whole. A payload of several chunks is
written as WARC segments: a first record and its continuations. Spark's text writer makes the archives, as
compressed files in which CR LF CR LF ends every record, and its line reader streams them back; a parser
follows the declared lengths, so payloads may hold any bytes.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.session import checkpoint_folder, settle

#: Bytes of a chunk at most, chunks of an archive file on average at most, and payload bytes from which copies are revisits.
CHUNK, FILE_CHUNKS, REVISIT_FROM = 1 << 16, 1 << 14, 100
CRLF = b"\r\n"
CHUNK_COLUMNS = "record string, page_id long, url string, chunk_no int, last boolean, data binary, upto long, digest string"
#: Date of every record unless given; a clock would make equal runs differ.
DATE = "2024-01-01T00:00:00Z"


CHUNK_SCHEMA = pa.schema(
    [
        ("record", pa.string()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("chunk_no", pa.int32()),
        ("last", pa.bool_()),
        ("data", pa.binary()),
        ("upto", pa.int64()),
        ("digest", pa.string()),
    ]
)


def _chunker(size: int):
    def chunk(batches):
        held, room = [], 16 * size
        for batch in batches:
            rows = zip(*(batch.column(c) for c in ("record", "page_id", "url", "payload")))
            for record, page_id, url, payload in rows:
                whole = memoryview(payload.as_buffer())
                running = hashlib.sha256()
                cuts = range(0, max(len(whole), 1), size)
                for number, at in enumerate(cuts):
                    part = whole[at : at + size]
                    running.update(part)
                    held.append(
                        {
                            "record": record.as_py(),
                            "page_id": page_id.as_py(),
                            "url": url.as_py(),
                            "chunk_no": number,
                            "last": number + 1 == len(cuts),
                            "data": part.tobytes(),
                            "upto": at + len(part),
                            "digest": running.copy().hexdigest(),
                        }
                    )
                    room -= len(part) + 256
                    if room <= 0:
                        yield pa.RecordBatch.from_pylist(held, CHUNK_SCHEMA)
                        held, room = [], 16 * size
        if held:
            yield pa.RecordBatch.from_pylist(held, CHUNK_SCHEMA)

    return chunk


def chunk_table(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", size: int = CHUNK) -> DataFrame:
    """One row for each chunk of each page's payload; an empty or null payload has one empty chunk.

    ``record`` is unique for a row of the input; store the table before it is used twice.
    """
    rows = pages.select(
        F.monotonically_increasing_id().cast("string").alias("record"),
        F.col(page_id).cast("bigint").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html).cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )
    return rows.mapInArrow(_chunker(size), CHUNK_COLUMNS)


def decide_types(chunks: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """(record, payload_bytes, payload_digest, refers_to) from the last chunks; refers_to only for revisits.

    Of equal payloads the one with the smallest page_id, then record, is kept; a page without an id comes last.
    """
    done = chunks.where("last").select("record", "page_id", F.col("upto").alias("payload_bytes"), F.col("digest").alias("payload_digest"))
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "record")
    kept = done.where(F.col("payload_bytes") >= revisit_from).groupBy("payload_digest", "payload_bytes").agg(F.min(order).alias("first"))
    joined = done.join(kept, ["payload_digest", "payload_bytes"], "left")
    again = F.col("first").isNotNull() & (F.col("first.record") != F.col("record"))
    return joined.select(
        "record",
        "payload_bytes",
        "payload_digest",
        F.when(again, F.col("first.record")).alias("refers_record"),
        F.when(again, F.col("first.page_id")).alias("refers_to"),
        again.alias("revisit"),
    )


def _urn(record: str, chunk: int = 0) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{record}/{chunk}').urn}>"


def _one_line(text: str) -> str:
    return text.replace("\r", "%0D").replace("\n", "%0A")


def _header(row: dict) -> bytes:
    """Header of one WARC record; segments after the first are continuations."""
    revisit, number, length = row["revisit"], row["chunk_no"], len(row["data"])
    kind = "revisit" if revisit else "response" if number == 0 else "continuation"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", _urn(row["record"], number)), ("WARC-Date", DATE)]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", _one_line(row["url"])))
    fields += [("Content-Type", "text/html; charset=UTF-8"), ("Content-Length", "0" if revisit else str(length))]
    if row["page_id"] is not None:
        fields.append(("X-Page-ID", str(row["page_id"])))
    if revisit:
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.append(("WARC-Refers-To", _urn(row["refers_record"])))
        if row["refers_to"] is not None:
            fields.append(("X-Refers-To-Page-ID", str(row["refers_to"])))
    elif number or not row["last"]:
        fields.append(("WARC-Segment-Number", str(number + 1)))
        if number:
            fields.append(("WARC-Segment-Origin-ID", _urn(row["record"])))
        if number and row["last"]:
            fields.append(("WARC-Segment-Total-Length", str(row["payload_bytes"])))
    if number == 0:
        digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
        fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(row["payload_bytes"]))]
    return b"WARC/1.1" + CRLF + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields) + CRLF


def _records(batches):
    for batch in batches:
        rows = batch.to_pylist()
        made = [_header(r) + (b"" if r["revisit"] else r["data"]) for r in rows]
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["record"])


def write_archives(chunks: DataFrame, types: DataFrame, folder: str) -> None:
    """Write compressed archives, chunks of a record in order and in one file's run.

    A revisit writes a header without payload. Rows travel by record, which is unique for a page, so
    copies and hosts of any number are spread evenly. A task writes one file, and files are bounded by the
    number of tasks, so no file ends inside a record.
    """
    rows = chunks.join(types, "record").where("not revisit or chunk_no = 0")
    files = -(-chunks.count() // FILE_CHUNKS)
    enough = files <= int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition("record") if enough else rows.repartition(files, "record")
    placed = dealt.sortWithinPartitions("record", "chunk_no")
    records = placed.mapInArrow(_records, "record binary")
    (
        records.select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", "\r\n\r\n")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", 0)
        .text(folder)
    )


class _Reader:
    """Follows the lines of one archive; counts and digests payloads without keeping them."""

    def __init__(self):
        self.fields: dict[str, str] | None = None
        self.left = -1
        self.open: dict | None = None
        self.done: list[dict] = []

    def line(self, line: bytes) -> None:
        """A line without its CR LF: of a header, of a block, or the empty one after a block."""
        if self.left >= 0:
            self._block(line)
        elif self.fields is None:
            if line == b"WARC/1.1":
                self.fields = {}
            elif line:
                raise ValueError(f"no record starts with {line[:40]!r}")
        elif line:
            name, _, value = line.decode().partition(": ")
            self.fields[name] = value
        else:
            self._start()

    def _start(self) -> None:
        fields = self.fields
        if fields["WARC-Type"] == "continuation":
            if self.open is None or fields["WARC-Segment-Origin-ID"] != self.open["fields"]["WARC-Record-ID"]:
                raise ValueError(f"segment without its first record: {fields['WARC-Segment-Origin-ID']}")
        else:
            self._finish()
            self.open = {"fields": fields, "bytes": 0, "sha": hashlib.sha256()}
        self.left = int(fields["Content-Length"])

    def _block(self, line: bytes) -> None:
        if len(line) > self.left:
            raise ValueError("a block is longer than declared")
        self._take(line)
        self.left -= len(line)
        if self.left == 0:
            self.left, self.fields = -1, None
            return
        # The line feed pair belonged to the block, unless the block ends within it.
        self._take(CRLF[: self.left])
        self.left -= 2
        if self.left < 0:
            raise ValueError("a block ends inside a line end")

    def _take(self, data: bytes) -> None:
        self.open["bytes"] += len(data)
        self.open["sha"].update(data)

    def _finish(self) -> None:
        if self.open is None:
            return
        fields, one = self.open["fields"], self.open
        revisit = fields["WARC-Type"] == "revisit"
        declared = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha256:")).hex()
        size = int(fields["X-Payload-Length"])
        if not revisit and (one["sha"].hexdigest() != declared or one["bytes"] != size):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
        number = fields.get("X-Page-ID")
        refers = fields.get("X-Refers-To-Page-ID")
        self.done.append(
            {
                "page_id": None if number is None else int(number),
                "payload_bytes": size,
                "payload_digest": declared,
                "record_type": fields["WARC-Type"],
                "refers_to": None if refers is None else int(refers),
                "url": fields.get("WARC-Target-URI"),
            }
        )
        self.open = None

    def finish(self) -> None:
        if self.left > 0 or (self.fields is not None and self.left < 0):
            raise ValueError("an archive ends inside a record")
        self._finish()


RECORD_SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("url", pa.string()),
    ]
)


def _parse(batches):
    reader, file = _Reader(), None
    for batch in batches:
        for name, line in zip(batch.column("file").to_pylist(), batch.column("line")):
            if name != file:
                reader.finish()
                reader, file, old = _Reader(), name, reader
                if old.done:
                    yield pa.RecordBatch.from_pylist(old.done, RECORD_SCHEMA)
            reader.line(line.as_py())
        if reader.done:
            yield pa.RecordBatch.from_pylist(reader.done, RECORD_SCHEMA)
            reader.done = []
    reader.finish()
    if reader.done:
        yield pa.RecordBatch.from_pylist(reader.done, RECORD_SCHEMA)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each page record of the archives; digests and lengths of all payloads are verified.

    Compressed files are not split, so a task sees the lines of a file in order. A damaged archive is an error.
    """
    lines = spark.read.option("lineSep", "\r\n").text(folder)
    named = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"))
    kinds = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    return named.mapInArrow(_parse, kinds)


def archive_round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write every page as a record and read the archives back.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to and url. A null payload is an empty
    one, a null id or address is left out of the header. Repeated rows become records of their own. An empty
    table gives an empty folder of archives and no rows.
    """
    folder = folder or f"{checkpoint_folder(spark)}/archives-{uuid.uuid4().hex}"
    chunks = settle(chunk_table(pages), compression="zstd")
    write_archives(chunks, decide_types(chunks), folder)
    return read_archives(spark, folder)
