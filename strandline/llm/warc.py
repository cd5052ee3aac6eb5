"""WARC archives of single-record Zstandard frames with a shared dictionary: writer and reader.

An archive (.warc.zst) begins with one skippable frame that holds the dictionary (itself a Zstandard frame, or
plain), and then has one frame for each record. The reader loads the dictionary from that leading frame, decodes
one frame at a time, and checks every record's version line, required headers, content length, end marks and
payload digest.

A payload that several pages share is written once, as a `response`; the others are `revisit` records that refer
to it. Pages are grouped by SHA-1, a second 64-bit hash and length with one aggregation, never gathered: a group
of any size is one row on the joined side. Each task writes archives of at most `ARCHIVE` bytes of payload (or one
record) into the shared folder, under names that no other attempt of it has; the folder may be any store that
pyarrow opens. The archives of tasks that succeeded are listed in a manifest (a Parquet table that Spark commits), and
only those are read, so that a lost executor's files count for nothing. Reading is Spark's binaryFile scan.

Ids are percent-encoded in record ids. A null payload is empty. Payloads shorter than `least` bytes are all responses. Of rows with equal payloads and
the same smallest id every one is a response; null ids come after all others. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import passing, shared_dir

#: Magic number of the skippable frame with the dictionary, and of a Zstandard frame.
SKIPPABLE, FRAME = 0x184D2A5D, 0xFD2FB528
ARCHIVE = 16 << 20
DICTIONARY_BYTES, SAMPLES = 32 << 10, 256
MANIFEST = "_manifest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()  # noqa: S324


class FormatError(ValueError):
    """An archive that breaks the format."""


def record(kind: str, headers: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers.items()], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record, which must be all of raw."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not mark or not lines[0].startswith("WARC/1."):
        raise FormatError("no WARC version line or no end of the headers")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or name.strip() in headers:
            raise FormatError(f"bad or repeated header {name!r}")
        headers[name.strip()] = value.strip()
    if missing := [h for h in REQUIRED if h not in headers]:
        raise FormatError(f"missing headers {missing}")
    length = headers["Content-Length"]
    if not length.isdigit() or len(rest) != int(length) + 4 or rest[int(length) :] != b"\r\n\r\n":
        raise FormatError("the content length doesn't match the record")
    return headers, rest[: int(length)]


class Writer:
    """Bytes of one archive. The dictionary is trained on the first payloads; too few or too small, and there is none."""

    def __init__(self, samples: list[bytes]):
        self.parts, trained = [], None
        if sum(map(len, samples)) > 8 * DICTIONARY_BYTES and len(samples) >= 16:
            try:
                trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples)
            except zstandard.ZstdError:
                trained = None
        if trained is not None:
            held = zstandard.ZstdCompressor().compress(trained.as_bytes())
            self.parts.append(struct.pack("<II", SKIPPABLE, len(held)) + held)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=trained, write_content_size=True)

    def add(self, raw: bytes) -> None:
        self.parts.append(self.compressor.compress(raw))

    def bytes(self) -> bytes:
        return b"".join(self.parts)


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Every record of an archive, one frame each."""
    view, at, dictionary = memoryview(archive), 0, None
    if len(archive) >= 8 and struct.unpack_from("<I", archive)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", archive, 4)[0]
        if len(archive) < 8 + size:
            raise FormatError("the dictionary frame is cut short")
        held = bytes(view[8 : 8 + size])
        if held[:4] == struct.pack("<I", FRAME):
            held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
        dictionary, at = zstandard.ZstdCompressionDict(held), 8 + size
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(archive):
        if len(archive) - at < 4 or struct.unpack_from("<I", archive, at)[0] != FRAME:
            raise FormatError(f"no frame at byte {at}")
        one = decompressor.decompressobj()
        raw = one.decompress(view[at:])
        if not one.eof:
            raise FormatError(f"the frame at byte {at} is cut short")
        at = len(archive) - len(one.unused_data)
        yield parse(raw)


def _write(folder: str):  # noqa: ANN202
    from pyarrow import fs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, path = fs.FileSystem.from_uri(folder)
        part, attempt, number = TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal held, number
            writer = Writer([r[2] for r in held if r[2]][:SAMPLES])
            for page, url, payload, sha, refers, length in held:
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                common = {"WARC-Record-ID": _urn(page), "WARC-Date": "1970-01-01T00:00:00Z", "WARC-Payload-Digest": f"sha1:{digest}"}
                if url:
                    common["WARC-Target-URI"] = quote(url, safe=":/?#[]@!$&'()*+,;=%~")
                if refers is None:
                    writer.add(record("response", common | {"Content-Type": "text/html; charset=utf-8"}, payload))
                else:
                    profile = {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": _urn(refers), "X-Payload-Length": str(length)}
                    writer.add(record("revisit", common | profile, b""))
            name = f"part-{part:06d}-{attempt}-{number:04d}.warc.zst"
            with store.open_output_stream(f"{path}/{name}", compression=None) as out:
                out.write(writer.bytes())
            batch = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(held)], pa.int64())], ["archive", "records"])
            held, number = [], number + 1
            return batch

        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                size += len(row[2])
                if size >= ARCHIVE or len(held) >= 100_000:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str | None = "url", payload_col: str = "html", least: int = 0) -> int:
    """Writes one record for each row into archives of a (shared) folder; the number of records in the folder."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    url = F.col(url_col).cast("string") if url_col else F.lit(None).cast("string")
    raw = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page"), url.alias("url"), raw.alias("payload"))
    keyed = rows.withColumn("sha", F.sha1("payload")).withColumn("hash", F.xxhash64("payload")).withColumn("size", F.octet_length("payload"))
    keys = ["sha", "hash", "size"]
    first = keyed.filter(F.col("size") >= least).groupBy(*keys).agg(F.min("page").alias("first"))
    joined = keyed.join(first, keys, "left")
    refers = F.when(F.col("page").isNull() & F.col("first").isNotNull() | (F.col("page") != F.col("first")), F.col("first"))
    out = joined.select("page", "url", F.when(refers.isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"), "sha", refers.cast("string").alias("refers"), "size")
    out.mapInArrow(_write(folder), "archive string, records long").write.mode("append").parquet(f"{folder}/{MANIFEST}")
    return pages.sparkSession.read.parquet(f"{folder}/{MANIFEST}").agg(F.coalesce(F.sum("records"), F.lit(0)).alias("n")).first()["n"]


def read_archives(spark, folder: str) -> DataFrame:  # noqa: ANN001
    """record_id (null for a null id), url, record_type, payload_bytes, payload_digest, refers_to and (of responses) payload of
    every record of the archives that the folder's manifest lists; without a manifest, of all its archives."""
    from pyspark.errors import AnalysisException

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                rows: list[tuple] = []
                size = 0
                for h, block in records(archive):
                    digest, kind = h.get("WARC-Payload-Digest", "").removeprefix("sha1:"), h["WARC-Type"]
                    if kind == "response" and base32_sha1(block) != digest:
                        raise FormatError(f"the payload of {h['WARC-Record-ID']} doesn't have its digest")
                    revisit = kind == "revisit"
                    rows.append((_named(h["WARC-Record-ID"]), h.get("WARC-Target-URI"), kind, int(h["X-Payload-Length"]) if revisit else len(block), digest, _named(h["WARC-Refers-To"]) if revisit else None, None if revisit else block))
                    size += len(block)
                    if size > 4 << 20 or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = "record_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string, payload binary"
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    try:
        listed = spark.read.parquet(f"{folder}/{MANIFEST}").select("archive").distinct()
        files = files.withColumn("archive", F.element_at(F.split("path", "/"), -1)).join(listed, "archive", "left_semi")
    except AnalysisException:
        pass
    return files.select("content").mapInArrow(run, schema)


def _urn(name: object) -> str:
    return "<urn:no-page>" if name is None else f"<urn:page:{quote(str(name), safe='')}>"


def _named(x: str) -> str | None:
    return unquote(x.removeprefix("<urn:page:").removesuffix(">")) if x.startswith("<urn:page:") else None


def archive_folder(spark) -> str:  # noqa: ANN001
    """A new folder for archives, as a URI in the shared folder."""
    base = shared_dir(spark)
    return passing(spark, f"{base if '://' in base or base.startswith('file:') else 'file://' + base}/archives-{uuid.uuid4().hex}")
