"""Files: listings, JSON records, manifests, run logs, page images."""

from __future__ import annotations

import fnmatch
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.manifest import last_of_each
from quire.schema import DOCUMENT, check_columns


def _opened(root: str) -> tuple[pafs.FileSystem, str, str]:
    """(file system, its path of root, what stands before its paths to make them URIs)."""
    if "://" not in root and not root.startswith("file:"):
        return pafs.LocalFileSystem(), root.rstrip("/"), "file:"
    fs, base = pafs.FileSystem.from_uri(root)
    base = base.rstrip("/")
    return fs, base, "file:" if root.startswith("file:") else root.rstrip("/").removesuffix(base)


def _for_tasks(path: str, pattern: str) -> bool:
    """Whether Arrow opens the path too; globs and file systems of Hadoop alone are for Spark's reader."""
    try:
        return not re.search(r"[*?\[{]", path) and "{" not in pattern and bool(_opened(path))
    except (pa.ArrowException, OSError):
        return False


def listing(spark: SparkSession, path: str, pattern: str = "*", content: bool = False) -> DataFrame:
    """path, length and, with content, the SHA-256 of each file below a folder; hidden ones (. or _ first) are left out.

    The driver lists the folder alone; what is in the folders below is listed and read by tasks, piece by piece.  Where
    only Spark can open the path, Spark's reader lists all on the driver.
    """
    if not _for_tasks(path, pattern):
        found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
        return found.select("path", "length", F.sha2("content", 256).alias("content_hash")) if content else found.select("path", "length")
    fs, top, _ = _opened(path)
    below = [i.path for i in fs.get_file_info(pafs.FileSelector(top)) if i.type == pafs.FileType.Directory and not i.base_name.startswith((".", "_"))]
    folders = spark.createDataFrame(list(enumerate([top, *below])), "n long, folder string").repartitionByRange(min(len(below) + 1, 2000), "n")

    def run(batches):
        fs, base, scheme = _opened(path)
        for b in batches:
            for folder in b.column(1).to_pylist():
                for some in _walk(fs, folder, folder != base, pattern):
                    cols = [pa.array([scheme + i.path for i in some], pa.string()), pa.array([i.size for i in some], pa.int64())]
                    if content:
                        cols.append(pa.array([_sha256(fs, i.path) for i in some], pa.string()))
                    yield pa.RecordBatch.from_arrays(cols, names=["path", "length", "content_hash"][: len(cols)])

    return folders.mapInArrow(run, "path string, length long" + (", content_hash string" if content else ""))


def _walk(fs: pafs.FileSystem, folder: str, deep: bool, pattern: str, most: int = 1000) -> Iterator[list[pafs.FileInfo]]:
    """The files of a folder and, deep, of those below it, whose names match a pattern, at most so many at a time."""
    open_, out = [folder], []
    while open_:
        for i in fs.get_file_info(pafs.FileSelector(open_.pop())):
            if i.base_name.startswith((".", "_")):
                continue
            if i.type == pafs.FileType.Directory:
                open_ += [i.path] if deep else []
            elif fnmatch.fnmatchcase(i.base_name, pattern):
                out.append(i)
                if len(out) == most:
                    yield out
                    out = []
    if out:
        yield out


def _sha256(fs: pafs.FileSystem, path: str) -> str:
    h = hashlib.sha256()
    with fs.open_input_stream(path, compression=None) as f:
        while part := f.read(1 << 20):
            h.update(part)
    return h.hexdigest()


def field_json(spark: SparkSession, path: str) -> DataFrame:
    """*.json files of one document or an array of them; derived columns are dropped, unknown ones are an error."""
    seen = spark.read.option("multiLine", True).json(path)
    check_columns(seen.columns)
    return spark.read.option("multiLine", True).schema(DOCUMENT).json(path)


def manifest_documents(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the manifests in files of one manifest or an array of them, with their place in their manifest."""
    return spark.read.option("multiLine", True).json(path).select(F.posexplode("documents").alias("ord", "d")).select("ord", "d.*")


def run_log(spark: SparkSession, path: str) -> DataFrame:
    """The last row of each doc_id; of several files those whose names sort later are later."""
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return last_of_each(spark.read.json(path).withColumn("__line", place), "doc_id", "__line").drop("__line")


#: Partitions of an image folder that one task reads, where there are many; it holds a batch of images at a time.
TOGETHER = 16


def images(spark: SparkSession, path: str, nested: bool = False) -> DataFrame:
    """path, h, w, data (RGB bytes, row by row) and error: a row for each file of a folder; nested: of those below it too.

    Grey images get three equal channels, of images with an alpha channel it is left out.  A file that is no image has
    an error and no data.
    """
    raw = spark.read.format("image").option("recursiveFileLookup", nested).load(path).select("image.*")
    # Spark counts a file as 4 MB at least, so small ones make a task of every 32
    parts = raw.rdd.getNumPartitions()
    raw = raw.coalesce(max(1, parts // TOGETHER, min(parts, 4 * spark.sparkContext.defaultParallelism)))

    def rgb(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            d = b.to_pydict()
            out, errors = [], []
            for n, h, w, x in zip(d["nChannels"], d["height"], d["width"], d["data"], strict=True):
                ok = n in (1, 3, 4) and x is not None and len(x) == h * w * n
                errors.append(None if ok else f"no image of 1, 3 or 4 channels of 8 bits ({n})")
                px = np.frombuffer(x, np.uint8).reshape(-1, n) if ok else None
                out.append(None if px is None else (np.repeat(px, 3, 1) if n == 1 else px[:, 2::-1]).tobytes())
            sizes = [pa.array([v if e is None else None for v, e in zip(d[c], errors, strict=True)], pa.int32()) for c in ("height", "width")]
            yield pa.RecordBatch.from_arrays([pa.array(d["origin"], pa.string()), *sizes, pa.array(out, pa.binary()), pa.array(errors, pa.string())], names=["path", "h", "w", "data", "error"])

    return raw.select("origin", "height", "width", "nChannels", "data").mapInArrow(rgb, "path string, h int, w int, data binary, error string")
