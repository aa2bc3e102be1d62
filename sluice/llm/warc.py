"""Dictionary-compressed web archives.

An archive file begins with a skippable frame that holds a Zstandard
dictionary, trained on records of that file, and goes on with one frame for
each record, so that a reader can start at any record once it has the
dictionary.  Equal payloads are stored once: the record with the largest
page_id is a response, the others are revisits without payload that name it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import keep, open_folder, shared_folder, ship

#: Magic number of the skippable frame that holds the dictionary.
DICT_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
#: Bytes of records, before compression, at which an archive is closed (a larger record has one to itself).
ARCHIVE_BYTES = 16 << 20
#: The dictionary: its size, and the bytes of an archive's records on which it is trained (a record from every
#: stretch of the archive, LEAST_SAMPLES of them at least, their beginnings if they are large).  Archives with fewer
#: records than that have none.
DICT_BYTES, SAMPLE_BYTES, LEAST_SAMPLES = 64 << 10, 4 << 20, 16
LEVEL = 6
#: Bytes that a reader takes at a time.
SLICE = 32 << 10
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # of addresses, RFC 4122

MANIFEST = "name string, n_records long, n_bytes long"
RECORDS = ("name string, page_id long, uri string, payload binary, payload_bytes long, payload_digest string, "
           "record_type string, refers_to long, intact boolean")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}')}>"


def clean(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, uri: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A WARC/1.1 record of an HTTP response, or a revisit record without payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-Length: {len(payload)}"]
    if uri is not None:
        head.append(f"WARC-Target-URI: {clean(uri)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}"]
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-ID: {refers_to}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers (lower-case names) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
    return {"fields": fields, "block": rest[:int(fields["content-length"])]}


def archive(records: list[bytes]) -> bytes:
    """The file of these records: dictionary in a leading skippable frame, a frame for each record."""
    total = sum(map(len, records))
    step = max(1, min(-(-total // SAMPLE_BYTES), len(records) // LEAST_SAMPLES))
    samples, trained = records[::step], None
    if len(records) >= LEAST_SAMPLES:
        samples = [r[:max(1, SAMPLE_BYTES // len(samples))] for r in samples]
        try:
            trained = zstandard.train_dictionary(min(DICT_BYTES, max(1024, total // 10)), samples, level=LEVEL)
        except zstandard.ZstdError:  # too little to learn from
            trained = None
    raw = trained.as_bytes() if trained else b""
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True) if trained else zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
    out = io.BytesIO()
    out.write(struct.pack("<II", DICT_MAGIC, len(raw)) + raw)
    for r in records:
        out.write(press.compress(r))
    return out.getvalue()


def read_archive(data: bytes) -> Iterator[bytes]:
    """The records of a file, one frame after another."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICT_MAGIC:
        raise ValueError("no dictionary frame")
    raw, at = data[8:8 + size], 8 + size
    dictionary = zstandard.ZstdCompressionDict(raw) if raw else None
    press = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    view = memoryview(data)
    while at < len(data):
        if data[at:at + 4] != FRAME_MAGIC:
            raise ValueError("not a frame")
        one, parts = press.decompressobj(), []
        while not one.eof:  # in slices: what a frame leaves of its last one is all that is copied
            if at >= len(data):
                raise ValueError("a frame that does not end")
            parts.append(one.decompress(view[at:at + SLICE]))
            at = min(at + SLICE, len(data))
        at -= len(one.unused_data)
        yield b"".join(parts)


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write (page_id, url, html) rows as archives into a shared folder; returns the manifest.

    Of the rows with equal payloads of at least ``least_bytes`` bytes the one with
    the largest page_id becomes a response and the others revisits of it; smaller
    payloads are all responses.  A null html is an empty payload.  A null page_id
    is smaller than any; of rows that share the largest page_id and the payload
    each is a response.  Only files in the manifest, which Spark commits, count.
    """
    ship(pages.sparkSession)
    payload = F.coalesce(F.encode("html", "utf-8"), F.lit(b""))
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    p = p.withColumn("sha", F.unhex(F.sha1("payload"))).withColumn("size", F.length("payload"))
    kept = p.groupBy("sha", "size").agg(F.max("page_id").alias("response"))
    # the kept side has a payload once, so adaptive execution can split a frequent payload's rows
    marked = p.join(kept, ["sha", "size"]).select(
        "page_id", "url", "response",
        ((F.col("size") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("response"))).alias("revisit"), "payload")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = path = None
        records, size, seq, part = [], 0, 0, TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            nonlocal store, path, records, size, seq
            if store is None:
                store, path = open_folder(folder)
            name = f"pages-{part:06d}-{seq:06d}-{uuid.uuid4().hex[:12]}.warc.zst"
            data = archive(records)
            with store.open_output_stream(f"{path}/{name}", compression=None) as out:
                out.write(data)
            row = {"name": [name], "n_records": [len(records)], "n_bytes": [len(data)]}
            records, size, seq = [], 0, seq + 1
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for page_id, url, response, revisit, body in zip(*(batch.column(i) for i in range(5)), strict=True):
                r = record(page_id.as_py(), url.as_py(), body.as_py(), response.as_py(), revisit.as_py(), date)
                if records and size + len(r) > archive_bytes:
                    yield flush()
                records.append(r)
                size += len(r)
        if records:
            yield flush()

    return keep(marked.mapInArrow(write, MANIFEST), "warc-manifest")


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """A row for each record of the manifest's files.

    A revisit's payload is null; its length and digest are those its header
    gives.  ``intact`` tells whether a response's payload has the length and
    digest of its header.
    """
    ship(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("name", pa.string()), ("page_id", pa.int64()), ("uri", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("intact", pa.bool_())])
        for batch in batches:
            for path, data in zip(batch.column(0), batch.column(1), strict=True):
                rows = []
                for raw in read_archive(data.as_py()):
                    r = parse(raw)
                    f, name = r["fields"], path.as_py().rsplit("/", 1)[-1]
                    number = lambda k: int(f[k]) if k in f else None  # noqa: B023, E731
                    told = f["warc-payload-digest"].removeprefix("sha1:"), int(f["x-payload-length"])
                    body = r["block"].partition(b"\r\n\r\n")[2] if f["warc-type"] == "response" else None
                    found = told if body is None else (digest(body), len(body))
                    rows.append({"name": name, "page_id": number("x-page-id"), "uri": f.get("warc-target-uri"), "payload": body, "payload_bytes": found[1],
                                 "payload_digest": found[0], "record_type": f["warc-type"], "refers_to": number("x-refers-to-page-id"), "intact": found == told})
                    if len(rows) >= 500:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    if manifest.isEmpty():
        return spark.createDataFrame([], RECORDS).drop("name")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    # a row a file: of a repeated or lost attempt's files none is in the manifest
    listed = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", "content").join(manifest.select("name"), "name", "left_semi")
    return listed.select("path", "content").mapInArrow(read, RECORDS).drop("name")


def warc_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    folder = shared_folder(pages.sparkSession, "warc")
    return read_archives(pages.sparkSession, folder, write_archives(pages, folder, least_bytes))
