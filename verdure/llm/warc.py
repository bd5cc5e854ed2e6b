"""WARC archives: one gzip member per record, written and read as streams.

Pages with equal payloads of at least ``REVISIT_BYTES`` bytes are stored once:
the one with the smallest ``page_id`` is the response, the others are revisits
that name it. Each task writes archives of its own, of about ``ARCHIVE_BYTES``
of payload, into a shared folder under names that no other attempt uses; only
archives in the returned manifest count, so a lost or repeated task leaves
nothing that is read twice. Files are opened through Arrow's file systems, by
the scheme of the folder's address.

The reader holds one piece of compressed bytes and one piece of a payload at a
time: it inflates member by member, takes exactly the announced length from
each, checks that the member ends there, and compares the digest.

Defined results: NULL html is an empty payload; rows that share the smallest
``page_id`` of a payload are all responses; a NULL ``page_id`` is larger than all
others; an empty table writes no archive. Other columns are not stored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdure.operators.joins import join_by_key
from verdure.sources.lineage import cut_lineage

REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20
PIECE = 1 << 16
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2026-01-01T00:00:00Z"


class WarcError(ValueError):
    """An archive that is cut off or not what its headers say."""


def plan_records(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, digest, record_type, refers_to`` for every page."""
    text = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        text.alias("html"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("digest"),
        F.octet_length(text).cast("bigint").alias("payload_bytes"),
    )
    shared = (
        rows.where(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("owner"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND owner IS NOT NULL")
        .select(F.col("digest").alias("_digest"), "owner")
    )
    joined = join_by_key(rows, "digest", shared, "_digest", "left", salt_from=["page_id"])
    again = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    return joined.select(
        "page_id",
        "url",
        "html",
        "digest",
        "payload_bytes",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("owner")).alias("refers_to"),
    )


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _number(name: str) -> int | None:
    value = name.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "none" else int(value)


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool
) -> bytes:
    """One record, compressed as a gzip member of its own."""
    body = b"" if revisit else payload
    # A line end in an address would end the header.
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html",
        f"Content-Length: {len(body)}",
    ]
    if revisit:
        headers += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    head = "\r\n".join(headers).encode() + b"\r\n\r\n"
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(head) + press.compress(body) + press.compress(b"\r\n\r\n") + press.flush()


#: Names that Spark's file systems have beside those of the reader's.
_SAME_STORE = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs"}


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store behind a URI as Spark writes it, and the path in it."""
    scheme, mark, rest = uri.partition("://")
    return pafs.FileSystem.from_uri(f"{_SAME_STORE.get(scheme, scheme)}{mark}{rest}")


def _write(folder: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(folder)
        stream, name, held, records = None, "", 0, 0

        def done() -> pa.RecordBatch:
            stream.close()
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [records]})

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                for row in batch.slice(at, 200).to_pylist():
                    if stream is None:
                        system.create_dir(root, recursive=True)
                        name, held, records = f"pages-{uuid.uuid4().hex}.warc.gz", 0, 0
                        stream = system.open_output_stream(f"{root}/{name}", compression=None)
                    payload = row["html"].encode()
                    stream.write(
                        record_bytes(
                            row["page_id"], row["url"], payload, row["digest"],
                            row["refers_to"], row["record_type"] == "revisit",
                        )
                    )
                    held += len(payload)
                    records += 1
                    if held >= limit:
                        yield done()
                        stream = None
        if stream is not None:
            yield done()

    return run


def write_archives(pages: DataFrame, folder: str, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` and return the manifest: ``path, records`` of each archive."""
    planned = plan_records(pages).drop("payload_bytes")
    return cut_lineage(planned.mapInArrow(_write(folder, limit), "path string, records bigint"))


class Members:
    """Decompressed bytes of a stream of gzip members, one member after the other."""

    def __init__(self, stream):
        self.stream = stream
        self.packed = b""
        self.open = None
        self.ready = b""

    def next(self) -> bool:
        """Begin the next member; False at the end of the stream."""
        if not self.packed:
            self.packed = self.stream.read(PIECE)
        if not self.packed:
            return False
        self.open, self.ready = zlib.decompressobj(31), b""
        return True

    def more(self) -> bool:
        """Get at most a piece more; False at the end of the member."""
        while not self.open.eof:
            if not self.packed:
                self.packed = self.stream.read(PIECE)
                if not self.packed:
                    raise WarcError("the archive ends inside a record")
            got = self.open.decompress(self.packed, PIECE)
            self.packed = self.open.unused_data if self.open.eof else self.open.unconsumed_tail
            if got:
                self.ready += got
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        while mark not in self.ready:
            if not self.more():
                raise WarcError("a record has no end of its headers")
        found, _, self.ready = self.ready.partition(mark)
        return found

    def pieces(self, length: int) -> Iterator[bytes]:
        """Exactly ``length`` bytes, in pieces."""
        while length:
            if not self.ready and not self.more():
                raise WarcError("a record is shorter than its Content-Length")
            piece, self.ready = self.ready[:length], self.ready[length:]
            length -= len(piece)
            yield piece

    def rest(self) -> bytes:
        while self.more():
            if len(self.ready) > PIECE:
                raise WarcError("a record is longer than its Content-Length")
        return self.ready


def read_records(stream, keep: bool = False) -> Iterator[dict]:
    """Records of an archive in order, verified; the payload only if ``keep``."""
    members = Members(stream)
    while members.next():
        lines = members.until(b"\r\n\r\n").decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise WarcError("a record does not begin with a version")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        digest, size, kept = hashlib.sha256(), 0, []
        for piece in members.pieces(int(headers["Content-Length"])):
            digest.update(piece)
            size += len(piece)
            if keep:
                kept.append(piece)
        if members.rest() != b"\r\n\r\n":
            raise WarcError("a record does not end after its Content-Length")
        announced = headers["WARC-Payload-Digest"].removeprefix("sha256:")
        kind = headers["WARC-Type"]
        if kind == "response" and announced != digest.hexdigest():
            raise WarcError(f"digest of {headers['WARC-Record-ID']} differs")
        yield {
            "page_id": _number(headers["WARC-Record-ID"]),
            "url": headers["WARC-Target-URI"],
            "payload_bytes": size if kind == "response" else int(headers["X-Payload-Length"]),
            "payload_digest": announced,
            "record_type": kind,
            "refers_to": _number(headers["WARC-Refers-To"]) if kind == "revisit" else None,
            "payload": b"".join(kept) if keep else None,
        }


_FIELDS = pa.schema(
    [
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
    ]
)


def _read(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, name = file_system(path)
                with system.open_input_stream(name, compression=None) as stream:
                    held, size = [], 0
                    for record in read_records(stream, keep):
                        held.append(record)
                        size += 500 + len(record["payload"] or b"")
                        if size > 1 << 22:
                            yield pa.RecordBatch.from_pylist(held, _FIELDS)
                            held, size = [], 0
                    yield pa.RecordBatch.from_pylist(held, _FIELDS)

    return run


def read_archives(manifest: DataFrame, keep: bool = False) -> DataFrame:
    """All records of the archives of a manifest; each archive is read by one task."""
    archives = max(1, manifest.count())
    paths = manifest.select("path").repartition(archives)
    schema = (
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, url string, payload binary"
    )
    return paths.mapInArrow(_read(keep), schema)


def archive_report(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages into archives under ``folder`` and read them back."""
    return read_archives(write_archives(pages, folder)).drop("url", "payload")
