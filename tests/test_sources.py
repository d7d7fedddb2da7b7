from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import EDGE_SCHEMA
from helpers import rows

from propgraph import read_edge_list, read_table
from propgraph.staging import shared_dir, stage, staging


def test_edge_list_keeps_bad_lines(spark, tmp_path):
    path = tmp_path / "edges.csv"
    path.write_text("1,2,3.5,100\nx,2,5,6\n3,4\n")
    df = read_edge_list(spark, str(path), EDGE_SCHEMA)
    assert df.columns == ["source_id", "target_id", "rating", "timestamp", "_corrupt"]
    got = {tuple(r)[:4]: r["_corrupt"] for r in df.collect()}
    assert set(got) == {(1, 2, 3.5, 100), (None, 2, 5.0, 6), (3, 4, None, None)}
    assert got[(1, 2, 3.5, 100)] is None
    assert got[(None, 2, 5.0, 6)] == "x,2,5,6"


def test_table_with_header(spark, tmp_path):
    path = tmp_path / "flights.csv"
    path.write_text("year,airline\n1999,AA\n2000,BB\n")
    assert read_table(spark, str(path)).dtypes == [("year", "int"), ("airline", "string")]
    pinned = read_table(spark, str(path), "year bigint, airline string")
    assert pinned.dtypes == [("year", "bigint"), ("airline", "string")]
    assert rows(pinned) == [(1999, "AA"), (2000, "BB")]


class FakeSession:
    def __init__(self, **conf):
        self.conf = {f"spark.{k}": v for k, v in conf.items()}


def test_staging_uses_the_folder_that_the_session_names():
    session = FakeSession(**{"checkpoint.dir": "hdfs://shared/points/", "master": "yarn"})
    assert shared_dir(session) == "hdfs://shared/points"


def test_staging_without_a_folder_fails():
    unset = SimpleNamespace(isDefined=lambda: False)
    context = SimpleNamespace(_jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: unset)))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(conf={}, sparkContext=context))


def test_staged_table_reads_back_and_goes_with_its_block(spark, tmp_path):
    kept = stage(spark.range(3), "kept")
    with staging(spark):
        df = stage(spark.range(10).selectExpr("id", "id % 2 AS half"), "t", ["half"])
        assert df.columns == ["id", "half"]
        assert rows(df) == sorted((i, i % 2) for i in range(10))
        folder = Path(df.inputFiles()[0].removeprefix("file:")).parents[1]
        assert str(folder).lstrip("/").startswith(shared_dir(spark).lstrip("/"))
    assert not folder.exists()
    assert kept.count() == 3
    with staging(spark, str(tmp_path)):
        assert stage(spark.range(3), "t").inputFiles()[0].removeprefix("file://").startswith(str(tmp_path))
