"""Bringing inputs to a folder, once: downloads, clones and archives.  Whoever has no network fills the folder by hand."""

from __future__ import annotations

import logging
import os
import subprocess
import tempfile
import urllib.error
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)
CHUNK = 1 << 20


def download(url: str, path: str, timeout: float = 60) -> bool:
    """Whether path is there, fetched from url if it was not; it gets its name when it is whole, and an error is logged, not raised."""
    if os.path.exists(path):
        return True
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    handle, part = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)))
    try:
        with os.fdopen(handle, "wb") as out, urllib.request.urlopen(url, timeout=timeout) as src:  # noqa: S310  (the caller names the address)
            while data := src.read(CHUNK):
                out.write(data)
        os.replace(part, path)
    except (OSError, ValueError, urllib.error.URLError) as e:
        log.warning("download of %s failed: %s", url, e)
        os.unlink(part)
        return False
    return True


def clone(url: str, folder: str, sign: str = "") -> bool:
    """Whether folder (or sign, a path below it) is there, cloned from url if it was not."""
    if os.path.exists(os.path.join(folder, sign)):
        return True
    done = subprocess.run(["git", "clone", "--quiet", "--depth", "1", url, folder], capture_output=True, text=True, check=False)  # noqa: S603, S607
    if done.returncode:
        log.warning("clone of %s failed: %s", url, done.stderr.strip())
    return done.returncode == 0 and os.path.exists(os.path.join(folder, sign))


def unzipped(spark: SparkSession, path: str, pattern: str = "*.zip") -> DataFrame:
    """The files in zip archives: archive, path (inside it), length, content, error; an archive that can not be read is a row with an error."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    names = ["archive", "path", "length", "content", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io
        import zipfile
        import zlib

        def rows(archive: str, data: bytes) -> Iterator[tuple]:
            try:
                with zipfile.ZipFile(io.BytesIO(data)) as z:
                    for m in z.infolist():
                        if not m.is_dir():
                            body = z.read(m)
                            yield archive, m.filename, len(body), body, None
            except (zipfile.BadZipFile, zlib.error, NotImplementedError, RuntimeError, EOFError) as e:
                yield archive, None, None, None, f"{type(e).__name__}: {e}"

        for b in batches:
            for archive, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for row in rows(archive, data):  # one file at a time, however many an archive holds
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, (pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string()), strict=True)], names=names)

    return files.select(F.col("path"), "content").mapInArrow(run, "archive string, path string, length long, content binary, error string")
