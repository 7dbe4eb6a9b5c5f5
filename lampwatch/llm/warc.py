"""Dictionary-compressed WARC archives (operator 10).

Writer: one WARC/1.1 record per row, its payload the HTML in UTF-8 behind a
small HTTP head.  Of records with equal payloads the one with the smallest
id is a ``response``; the others are ``revisit`` records that name it and
hold no payload.  Payloads shorter than ``least_bytes`` are never
deduplicated (0: all are).  The payload digests are counted in slim rows,
with map-side combining, so a payload shared by a third of the rows is one
row per task; pages then meet the repeated digests in one join whose skewed
side adaptive execution can split.

Each task gathers records up to ``ARCHIVE_BYTES``, trains a Zstandard
dictionary on an even spread of at most ``TRAIN_BYTES`` of these very
records, and writes one file: a leading skippable frame (magic 0x184D2A5D)
that holds the dictionary, a frame with the ``warcinfo`` record, then one
frame per record.  Too few or too small records to train on give a
raw-content dictionary from their heads; an archive of empty payloads still
has its own heads.  Files appear whole, by rename.

Reader: skips to the dictionary, inflates the frames, parses each record and
checks every stored payload against its digest.

Null html counts as empty; a null url has no target line; line breaks in a
url are percent-escaped.  A null id is written as ``none`` and sorts last:
it is a response unless a row with an id has its payload.  Rows that repeat
id and payload are each a response.  Other columns are ignored; an empty
table writes no file.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lampwatch.llm.common import as_uri, write_atomic
from lampwatch.session import scratch_path

ARCHIVE_BYTES = 32 << 20
TRAIN_BYTES = 1 << 20
DICTIONARY_BYTES = 32 << 10
#: frame number that the WARC-Zstandard convention gives to dictionaries
SKIP_MAGIC = 0x184D2A5D
LEVEL = 3
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REVISIT, RESPONSE = "revisit", "response"


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields),
            f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8") + block + b"\r\n\r\n"


def urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_record(page_id: int | None, url: str | None, payload: bytes, sha1: bytes,
                first: int | None, date: str) -> bytes:
    """A page's record; ``first`` is the response's id if this one revisits it."""
    fields = [("WARC-Record-ID", urn(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if first is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", urn(first))]
    fields += [("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha1).decode()),
               ("Content-Type", "application/http;msgtype=response")]
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    return record(RESPONSE if first is None else REVISIT, fields,
                  http + payload if first is None else http)


def trained(records: list[bytes]) -> bytes:
    """A dictionary from an even spread of the records."""
    import zstandard

    step = max(1, sum(map(len, records)) // TRAIN_BYTES)
    samples, size = [], 0
    for r in records[::step]:
        if size + len(r) <= TRAIN_BYTES:
            samples.append(r)
            size += len(r)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL, k=512, d=8).as_bytes()
    except zstandard.ZstdError:  # too little to train on
        return b"".join(r[:1024] for r in records[:DICTIONARY_BYTES // 1024])


def archive(records: list[bytes], date: str) -> tuple[bytes, list[tuple[int, int]]]:
    """The file's bytes, and offset and length of each record's frame."""
    import zstandard

    dictionary = trained(records)
    info = record("warcinfo", [("WARC-Record-ID", "<urn:warcinfo>"), ("WARC-Date", date),
                               ("Content-Type", "application/warc-fields")],
                  b"format: WARC File Format 1.1\r\n")
    pack = zstandard.ZstdCompressor(
        level=LEVEL, write_checksum=True,
        dict_data=zstandard.ZstdCompressionDict(dictionary)).compress
    out = [struct.pack("<II", SKIP_MAGIC, len(dictionary)), dictionary, pack(info)]
    at, places = sum(map(len, out)), []
    for r in records:
        out.append(pack(r))
        places.append((at, len(out[-1])))
        at += len(out[-1])
    return b"".join(out), places


def parse(data: bytes):
    """``page_id, payload length, base32 digest, type, refers_to, payload``
    of each page record of an archive."""
    import zstandard

    magic, size = struct.unpack_from("<II", data)
    if magic != SKIP_MAGIC:
        raise ValueError("the archive does not begin with its dictionary")
    unpack = zstandard.ZstdDecompressor(
        dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
    stream = io.BufferedReader(
        unpack.stream_reader(io.BytesIO(memoryview(data)[8 + size:]), read_across_frames=True), 1 << 16)
    while line := stream.readline():
        if line.rstrip() != b"WARC/1.1":
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            k, _, v = line.partition(b": ")
            fields[k.decode()] = v.decode("utf-8")
        block = stream.read(int(fields["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        if fields["WARC-Type"] == "warcinfo":
            continue
        http, _, payload = block.partition(b"\r\n\r\n")
        length = int(http.rpartition(b"Content-Length: ")[2])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if fields["WARC-Type"] == RESPONSE and (
                len(payload) != length
                or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
        yield (_page(fields["WARC-Record-ID"]), length, digest, fields["WARC-Type"],
               _page(fields.get("WARC-Refers-To")), payload)


def _page(name: str | None) -> int | None:
    last = (name or "").rpartition(":")[2].rstrip(">")
    return int(last) if last and last != "none" else None


def written(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
            folder: str | None = None) -> DataFrame:
    """Write the archives below ``folder`` (default: a fresh one in the shared
    folder) and return their index: ``page_id, record_type, path, offset,
    length`` per record.  The files are written once, here."""
    spark = pages.sparkSession
    folder = as_uri(folder or scratch_path(spark, "llm-warc"))
    html = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "utf-8")
    slim = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"), html.alias("payload"))
    slim = slim.select("*", F.unhex(F.sha1("payload")).alias("sha1"))
    repeated = (slim.where(F.length("payload") >= least_bytes).groupBy("sha1")
                .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                .where("n > 1 and first is not null").select("sha1", "first"))
    joined = (slim.join(repeated, "sha1", "left")
              .select("page_id", "url", "payload", "sha1",
                      F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
                      .alias("first")))

    def write(batches):
        import uuid

        import pyarrow as pa

        from lampwatch.llm.warc import ARCHIVE_BYTES, RESPONSE, REVISIT, archive, page_record
        rows, records, held = [], [], 0

        def flush():
            nonlocal rows, records, held
            data, places = archive(records, date)
            path = write_atomic(folder, f"pages-{uuid.uuid4().hex}.warc.zst", data)
            cols = [[r[0] for r in rows], [r[1] for r in rows], [path] * len(rows),
                    [p[0] for p in places], [p[1] for p in places]]
            rows, records, held = [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.string(), pa.string(),
                                                       pa.int64(), pa.int64()])],
                names=["page_id", "record_type", "path", "offset", "length"])

        for b in batches:
            ids, urls, firsts = (b.column(i).to_pylist() for i in (0, 1, 4))
            for i, u, p, s, f in zip(ids, urls, b.column(2), b.column(3), firsts):
                r = page_record(i, u, p.as_py(), s.as_py(), f, date)
                if records and held + len(r) > ARCHIVE_BYTES:
                    yield flush()
                rows.append((i, RESPONSE if f is None else REVISIT))
                records.append(r)
                held += len(r)
        if records:
            yield flush()

    index = joined.mapInArrow(
        write, "page_id long, record_type string, path string, offset long, length long")
    out = scratch_path(spark, "llm-warc-index")
    index.write.parquet(out)
    return spark.read.schema(index.schema).parquet(out)


def read_back(index: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` per
    record, from the archives that ``index`` lists.  Only listed files are
    read: an attempt that lost a race leaves no record behind."""
    spark = index.sparkSession
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    head = index.select("path").first()
    if head is None:
        return spark.createDataFrame([], schema)

    def read(batches):
        import pyarrow as pa

        from lampwatch.llm.warc import parse
        for b in batches:
            for path, raw in zip(b.column(0).to_pylist(), b.column(1)):
                rows = [r[:5] for r in parse(raw.as_buffer().to_pybytes())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path.rpartition("/")[2]] * len(rows), pa.string()),
                     *(pa.array(c, t) for c, t in zip(zip(*rows), [
                         pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]))],
                    names=["file", "page_id", "payload_bytes", "payload_digest", "record_type",
                           "refers_to"])

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst")
             .load(head["path"].rpartition("/")[0]).select("path", "content"))
    listed = index.select(F.element_at(F.split("path", "/"), -1).alias("file")).distinct()
    return (files.mapInArrow(read, f"file string, {schema}")
            .join(listed, "file", "left_semi").drop("file"))
