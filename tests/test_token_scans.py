"""Boxes of the token query where its table holds odd numbers."""

import duckdb

from quire.page_queries import token_scan_fields
from quire.queries import ORACLE_SQL


def test_boxes_off_the_page_and_parts_of_pixels(spark, tmp_path):
    rows = [(1, n, q, f, s) for n, q, f, s in ((1, 2.5, "A", "O"), (12, 3.5, "R", "F"), (13, 95.7, "N", "O"), (13, 95.7, "N", "O"), (200_000_000, 17.0, "A", "F"))]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string").write.parquet(str(tmp_path / "lineitem.parquet"))
    duck = duckdb.connect()
    duck.sql("set threads = 1")
    duck.sql(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    got = token_scan_fields(spark, str(tmp_path))
    want = duck.sql(ORACLE_SQL["token_scan_fields"])
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall())
