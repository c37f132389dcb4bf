"""Files of many records, listings that tasks make."""

import hashlib
import json

from pyspark.sql import functions as F

from quire import file_queries
from quire.sources import files, forms


def local(path):
    from pathlib import Path

    return Path(path.removeprefix("file://"))


def test_json_files_hold_many_records(spark, monkeypatch):
    monkeypatch.setattr(file_queries, "PACKED", 100)
    rows = spark.range(450).select("id", F.to_json(F.struct(F.struct("id").alias("a"))).alias("j"))
    path = file_queries._packed(rows, F.col("id"), F.col("j"), "packed", "x.json")
    there = list(local(path).rglob("*.json"))
    assert 0 < len(there) <= 5
    assert sorted(r["a"]["id"] for p in there for r in json.loads(p.read_text())) == list(range(450))
    assert sorted(r.id for r in spark.read.option("multiLine", True).json(f"{path}/*").select("a.id").collect()) == list(range(450))


def test_match_types_of_files_with_line_breaks(spark, tmp_path):
    (tmp_path / "meta.json").write_text(json.dumps({"a": "X", "b": {"match_type": "Y"}, "c": {}, "d": 1}, indent=1))
    assert {r.field_id: r.match_type for r in forms.match_types(spark, str(tmp_path)).collect()} == {"a": "X", "b": "Y", "c": "StringMatch"}


def test_a_key_that_repeats_is_in_several_files(spark, tmp_path):
    part = spark.createDataFrame([(1, 0, "A"), (1, 1, "B"), (2, 2, "C")], "p_partkey long, p_size int, p_brand string")
    part.write.parquet(str(tmp_path / "part.parquet"))
    got = sorted(tuple(r) for r in file_queries.match_type_files(spark, str(tmp_path)).collect())
    assert got == [("f1", "A"), ("f1", "B"), ("f2", "StringMatch")]


def test_listing_below_a_folder(spark, tmp_path):
    put = {"a.bin": b"x", "1/b.bin": b"", "1/2/3/c.bin": b"y" * 3_000_000, "1/c.txt": b"t", ".h/d.bin": b"h", "1/_e.bin": b"h", "2/.f.bin": b"h"}
    for name, data in put.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    for path in (str(tmp_path), f"file://{tmp_path}", f"file:{tmp_path}/"):
        got = files.listing(spark, path, "*.bin", content=True)
        assert "binaryFile" not in got._jdf.queryExecution().toString()  # the driver holds no list of all files
        want = {(f"file:{tmp_path}/{n}", len(put[n]), hashlib.sha256(put[n]).hexdigest()) for n in ("a.bin", "1/b.bin", "1/2/3/c.bin")}
        assert {tuple(r) for r in got.collect()} == want
    assert {r.path.split("/")[-1] for r in files.listing(spark, f"{tmp_path}/1*", "*.{txt}").collect()} == {"c.txt"}


def test_small_images_share_tasks(spark, tmp_path):
    import numpy as np

    from quire.sources import sinks

    data = sinks.png(np.zeros((2, 2), np.uint8))
    for i in range(400):
        (tmp_path / f"{i}.png").write_bytes(data)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        got = files.images(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() <= 400 // files.TOGETHER and got.where("h = 2 and error is null").count() == 400
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
