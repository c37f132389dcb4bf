"""WARC archives and revisit resolution.

1. ``write_archives`` writes every page as a response record, archive by
   archive, and gives an index of headers (archive, place, digest, length).
2. ``resolve`` shuffles the headers alone by payload digest: of equal payloads
   of at least ``MIN_PAYLOAD`` bytes the record with the largest page_id is the
   original, and the others are joined to it as its revisits.
3. ``write_resolved`` reads each archive once, in order, and writes its
   deduplicated twin with fresh headers; a revisit keeps no payload.
4. ``read_archives`` reads archives back, checking payloads against digests.

Payloads never take part in a shuffle.  Headers are dealt by archive over so many
tasks as there are archives, up to ``TASKS``; an archive has a bounded size.  A task writes files whose names no
other attempt shares, and only the rows that it commits name them: a task that
runs again after a lost executor harms nothing.

Defined cases: null html is an empty payload; a null page_id sorts below all
others; rows that repeat a page_id and payload are separate records, the last
written of them being the original; a null url leaves the target out; other
columns are not written.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import read_table, shared_dir, small_batches, stored

MIN_PAYLOAD = 1000
#: An archive ends at this many compressed bytes or records.
ARCHIVE_BYTES = 8 << 20
ARCHIVE_RECORDS = 4096
#: Most tasks that rewrite or read archives.
TASKS = 10_000
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "archive string, record long, page_id long, payload_bytes long, payload_digest string"


def _digest(payload: bytes) -> bytes:
    return hashlib.sha1(payload).digest()  # noqa: S324


def record_name(page_id: int | None, archive: str, record: int) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}:{archive}:{record}>"


def page_of(name: str) -> int | None:
    page = name.removeprefix("<urn:x-page:").split(":", 1)[0]
    return int(page) if page else None


def build_record(kind: str, name: str, url: str | None, payload: bytes, digest: bytes, length: int, refers_to: str = "", date: str = DATE) -> bytes:
    """One record; payload is left out of a revisit, digest and length are always of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}")
    head.append(f"X-Payload-Length: {length}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, payload)"""
    end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode("utf-8", "surrogatepass").split("\r\n")
    head = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = raw[end + 4 : end + 4 + int(head["content-length"])]
    return head, block[block.index(b"\r\n\r\n") + 4 :]


def members(stream, chunk: int = 1 << 18) -> Iterator[bytes]:
    """The gzip members of a stream, one after another, holding one member at a time."""
    inflate, parts = zlib.decompressobj(31), []
    while data := stream.read(chunk):
        while data:
            parts.append(inflate.decompress(data))
            data = b""
            if inflate.eof:
                yield b"".join(parts)
                data, inflate, parts = inflate.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends inside a record")


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _file(folder: str, archive: str):
    fs, path = pafs.FileSystem.from_uri(folder)
    return fs, f"{path}/{archive}.warc.gz"


class ArchiveWriter:
    """Writes records to a file that gets its name at the end, whole."""

    def __init__(self, folder: str, archive: str) -> None:
        self.fs, self.path = _file(folder, archive)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.archive, self.n, self.bytes = archive, 0, 0
        self.out = self.fs.open_output_stream(self.path + ".open", compression=None)

    def add(self, record: bytes) -> None:
        data = _gzip(record)
        self.out.write(data)
        self.n += 1
        self.bytes += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.path + ".open", self.path)


def _index(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    cols = list(zip(*rows, strict=True)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["archive", "record", "page_id", "payload_bytes", "payload_digest"])


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages as response records below folder (a URI that executors share); the index of what was written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, rows = None, []
        for b in small_batches(batches, 2):
            for page_id, url, html in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if writer is None:
                    writer = ArchiveWriter(folder, uuid.uuid4().hex)
                payload = (html or "").encode("utf-8", "surrogatepass")
                digest = _digest(payload)
                writer.add(build_record("response", record_name(page_id, writer.archive, writer.n), url, payload, digest, len(payload)))
                rows.append((writer.archive, writer.n - 1, page_id, len(payload), digest.hex()))
                if writer.bytes > ARCHIVE_BYTES or writer.n >= ARCHIVE_RECORDS:
                    writer.close()
                    yield _index(rows)
                    writer, rows = None, []
        if writer is not None:
            writer.close()
            yield _index(rows)

    columns = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return stored(columns.mapInArrow(run, INDEX), "warc-index")


#: Share of all records, and least number of them, from which on a digest is hot: there are no more than 1 / HOT of them.
HOT, MIN_HOT = 0.001, 200


def resolve(index: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """The index with the original of each revisit: columns o_page, o_archive, o_record, null for responses."""
    place = F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("p"), "archive", "record")
    groups = index.where(F.col("payload_bytes") >= min_payload).groupBy("payload_digest").agg(F.max(F.struct(place.alias("at"), F.col("page_id").alias("o_page"))).alias("o"), F.count("*").alias("n"))
    groups = groups.where("n > 1").select("payload_digest", "o.o_page", F.col("o.at.archive").alias("o_archive"), F.col("o.at.record").alias("o_record"), "n")
    # short payloads need no original; those of the few digests that many records share get it from a broadcast
    bar = max(MIN_HOT, HOT * index.count())
    long = index.where(F.col("payload_bytes") >= min_payload)
    names = ["o_page", "o_archive", "o_record"]
    hot = long.join(F.broadcast(groups.where(F.col("n") > bar).drop("n")), "payload_digest", "left")
    rest = hot.where("o_archive is null").drop(*names).join(groups.where(F.col("n") <= bar).drop("n"), "payload_digest", "left")
    none = [F.lit(None).cast(groups.schema[c].dataType).alias(c) for c in names]
    cols = [*index.columns, *names]
    joined = rest.select(*cols).union(hot.where("o_archive is not null").select(*cols))
    joined = joined.union(index.where(~F.coalesce(F.col("payload_bytes") >= min_payload, F.lit(False))).select(*index.columns, *none))
    own = (F.col("archive") == F.col("o_archive")) & (F.col("record") == F.col("o_record"))
    keep = F.col("o_archive").isNotNull() & ~own
    return joined.select(*index.columns, *(F.when(keep, F.col(c)).alias(c) for c in ("o_page", "o_archive", "o_record")))


def by_archive(rows: DataFrame, archives: int) -> DataFrame:
    """Rows are few bytes that stand for whole archives, so their number of tasks is set and not left to their size."""
    return rows.repartition(max(1, min(TASKS, archives)), "archive")


def write_resolved(resolved: DataFrame, source: str, folder: str, archives: int) -> DataFrame:
    """Write the deduplicated twin of every archive (there are so many); the names of the archives written (column archive)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

        done: list[str] = []
        writer = stream = reader = None

        def finish() -> None:
            if writer is not None:
                writer.close()
                stream.close()
                done.append(writer.archive)

        now = None
        for archive, record, o_page, o_archive, o_record in rows():
            if archive != now:
                finish()
                fs, path = _file(source, archive)
                stream = fs.open_input_stream(path, compression=None)
                reader = enumerate(members(stream))
                writer, now = ArchiveWriter(folder, f"{archive}-{uuid.uuid4().hex[:8]}"), archive
            n, raw = next(reader)
            if n != record:
                raise ValueError(f"archive {archive} holds record {n} where {record} is due")
            head, payload = parse_record(raw)
            digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:"))
            kind = "response" if o_archive is None else "revisit"
            refers = "" if o_archive is None else record_name(o_page, o_archive, o_record)
            writer.add(build_record(kind, head["warc-record-id"], head.get("warc-target-uri"), payload, digest, len(payload), refers))
        finish()
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["archive"])

    ordered = by_archive(resolved.select("archive", "record", "o_page", "o_archive", "o_record"), archives).sortWithinPartitions("archive", "record")
    return stored(ordered.mapInArrow(run, "archive string"), "warc-archives")


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, record_id string, refers_to_record string"


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """A row for each record of the named archives; response payloads are hashed anew and checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive in b.column(0).to_pylist():
                rows = []
                fs, path = _file(folder, archive)
                with fs.open_input_stream(path, compression=None) as stream:
                    for raw in members(stream):
                        head, payload = parse_record(raw)
                        digest, length = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")), int(head["x-payload-length"])
                        kind = head["warc-type"]
                        if kind == "response":
                            if _digest(payload) != digest:
                                raise ValueError(f"a payload of {archive} differs from its digest")
                            length = len(payload)
                        ref = head.get("warc-refers-to")
                        rows.append((page_of(head["warc-record-id"]), length, digest.hex(), kind, page_of(ref) if ref else None, head.get("warc-target-uri"), head["warc-record-id"], ref))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "record_id", "refers_to_record"]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return by_archive(archives.select("archive"), archives.count()).mapInArrow(run, READ)


def deduplicated_archives(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> tuple[DataFrame, str]:
    """Write pages to archives and their deduplicated twins: (names, folder) of the twins."""
    spark = pages.sparkSession
    raw, out = shared_dir(spark, "warc-raw"), shared_dir(spark, "warc")
    index = write_archives(pages, raw)
    # each archive has one record 0
    return write_resolved(resolve(index, min_payload), raw, out, index.where("record = 0").count()), out


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, folder = deduplicated_archives(read_table(spark, sf_dir, "pages"))
    return read_archives(names, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages
), g AS (
    SELECT *, max(page_id) OVER (PARTITION BY body) AS original FROM p
)
SELECT page_id, payload_bytes, sha1(body) AS payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN original END AS refers_to
FROM g
"""
